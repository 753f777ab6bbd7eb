"""The operators against plain versions on small tables, with nulls, empty texts, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidegate.llm import bpe, brown, cnn, embeddings, minhash, mixing, pii, queries, rules, urls, wrappers

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, score double, size long, id long, kept boolean"


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents with the odd cases, and columns that clash with the operators' own."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(words, n))
    base = text(200)
    near = base.split()
    near[17], near[90] = "x", "y"
    rows = [(1, base, "src1"), (2, " ".join(near), "src1"), (3, base.upper().replace(" ", "\n "), "src2"), (4, None, "src1"), (5, "", None),
            (6, " \t\n", ""), (7, "one two", "src2"), (8, "One  TWO", "src9"), (9, text(3000), "src1"), (None, base, "src3"),
            (10, text(60), None), (10, text(60), None), (11, "$$$ ### " * 40, "src1"), (11, "$$$ ### " * 40, "src1"),
            (12, f"mail a.b+c@mail.example.com ip 10.0.0.1 no 999.1.1.1 card 4111 1111 1111 1111 call +1 (555) 010-1234 {text(50)}", "src1")]
    rows += [(20 + i, text(60 + i), f"src{i % 4}") for i in range(30)]
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 7, 0.5, -1, 99, False) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def nothing(corpus):
    return corpus.filter("false")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components_of(items, linked):
    root = {x: x for x in items}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in items:
        for b in items:
            if a < b and linked(a, b):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {x: top(x) for x in items}


def test_minhash_finds_the_links(corpus):
    got = {(r.doc_id, r.n_shingles): r for r in minhash.near_duplicates(corpus).collect()}
    sets = {}
    for r in corpus.filter("doc_id IS NOT NULL").collect():
        sets.setdefault(r.doc_id, shingles(r.text))
    want = components_of(list(sets), lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
    for (i, n), r in got.items():
        if i is None:
            assert r.component_id is None and r.kept
        elif i != 10:
            assert (n, r.component_id, r.kept) == (len(sets[i]), want[i], want[i] == i)
    assert want[2] == want[3] == 1 and want[8] == 7


def test_minhash_among_loose_variants_equals_brute_force(spark, monkeypatch):
    """Variants around the similarity of a link, many of them too far from the original: links between them are found, without meeting in pairs."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    texts = []
    for _ in range(700):
        words = list(base)
        for at in rng.sample(range(5, 115), rng.choice([1, 3, 4, 5, 6])):
            words[at] = rng.choice(["", f"x{rng.randrange(3)}"])
        texts.append(" ".join(words))
    sets = [set(minhash.shingle_set(t.encode(), 5).tolist()) for t in texts]
    root = list(range(len(sets)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    tried = []
    measured = minhash._measured
    monkeypatch.setattr(minhash, "_measured", lambda pairs, *how: (tried.append(pairs.count()), measured(pairs, *how))[1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert got == {i: top(i) for i in range(len(sets))}
    assert sum(tried) < 700 * 699 / 2 / 4


def test_minhash_links_a_group_through_its_original(spark):
    """Variants that are not alike each other, only like the original, form one group."""
    rng = np.random.default_rng(1)
    original = [f"o{i}" for i in range(300)]
    rows = []
    for k in range(40):
        own = list(original)
        for at in rng.choice(300, 7, replace=False):
            own[at] = f"v{k}_{at}"
        rows.append((k + 1, " ".join(own)))
    docs = spark.createDataFrame([*rows, (100, " ".join(original))], "doc_id long, text string")
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    want = components_of(list(sets), lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()} == want
    assert minhash.keep_one(docs).count() == len(set(want.values()))


def test_circulant_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[1000:])
    agree = (minhash.signature(a, 400) == minhash.signature(b, 400)).mean()
    assert abs(agree - 1 / 3) < 0.1


def test_mixing(corpus):
    rows = mixing.mix(corpus).collect()
    assert len(rows) == corpus.count()
    size = Counter()
    for r in corpus.collect():
        size[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full = set()
    while True:
        rest = sum(size.values()) - sum(3 * size[s] for s in full)
        share = sum(weight[s] for s in order if s not in full)
        above = {s for s in order if s not in full and rest * weight[s] > 3 * size[s] * share}
        if not above:
            break
        full |= above
    taken = Counter()
    for r in rows:
        goal = 3.0 * size[r.source] if r.source in full else rest * weight[r.source] / share
        assert r.source_size == size[r.source] and math.isclose(r.target, goal)
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    for s in order:
        goal = next(r.target for r in rows if r.source == s)
        assert abs(taken[s] - goal) <= 2 * max(r.size for r in rows if r.source == s)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(corpus.repartition(5)).collect()))
    assert mixing.repeat(corpus).count() == sum(r.copies for r in rows)


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            fine = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")), "phone": lambda: 9 <= len(digits) <= 15,
                    "card": lambda: 12 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in twice) % 10 == 0}[kind]()
            if fine:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@pytest.mark.parametrize("text", [
    "a@b.c@d.e", "a@b", "x@@y.z", ".@a.b", "a@b.c.", "1.2.3.4.5", "1.2.3.256", "0001.2.3.4", "12.34.56.78.90.12.34.56", "é@b.co ü+49 (0)30 1234567",
    "4111-1111-1111-1111 4111 1111 1111 1111 0", "+1 2", "++49 30 123456789.", "+1 555 010 1234 +", "a" * 5000 + "@b.cd", "1" * 5000])
def test_base_formats(text):
    assert pii.base_spans(text) == base_spans(text)


def test_personal_data_query_and_context(spark, corpus):
    for r in pii.find(corpus).collect():
        pass
    got = {r.doc_id: r for r in pii.find(corpus).collect()}
    text = {r.doc_id: r.text for r in corpus.collect()}
    assert [tuple(s) for s in got[12].base] == base_spans(text[12]) and len(got[12].base) == 4
    seeds = [f"reach hotline: +1 (555) 010-{1000 + i} today" for i in range(9)] + ["hotline: 555-010-7777 now", "room 555-010-8888 now"]
    docs = spark.createDataFrame(list(enumerate(seeds)), "doc_id long, text string")
    found = {r.doc_id: [seeds[r.doc_id][s.start:s.end] for s in r.spans] for r in pii.find(docs).collect()}
    assert found[9] == ["555-010-7777"] and found[10] == []
    assert "[PHONE]" in {r.doc_id: r.text for r in pii.redact(docs).collect()}[9]


def test_personal_data_candidates_are_whole(spark):
    def offered(text):
        return {text[a:b] for a, _, b in pii.loose_spans(text, sorted((a, b) for a, _, b in pii.base_spans(text)))}
    assert {"555-010-7777", "555-010-8888"} <= offered("hotline: 555-010-7777 555-010-8888")
    assert {"555-010-7777", "555-010-7777 2026"} <= offered("hotline: 555-010-7777 2026")
    assert "555-010-7777" in offered("555-010-7777 10.0.0.1 end") and offered("10.0.0.1 555-010-7777") == {"555-010-7777"}
    long = "a" * 200 + "@" + "b" * 200
    assert offered(f"to {long} now") == {long}
    around = pii._Around("x" * 100 + " 1234567 " + " " * 90 + "y" * 100 + " z")
    assert around.read(101, 108) == [pii._hash("<", "x" * 100), pii._hash(">", "y" * 100)]
    seeds = [f"reach hotline: +1 (555) 010-{1000 + i} today" for i in range(9)] + ["hotline: 555-010-7777 2026 x", "hotline: 555-010-6666 10.0.0.1 x"]
    found = {r.doc_id: [seeds[r.doc_id][s.start:s.end] for s in r.spans]
             for r in pii.find(spark.createDataFrame(list(enumerate(seeds)), "doc_id long, text string")).collect()}
    assert found[9] == ["555-010-7777"] and found[10] == ["555-010-6666", "10.0.0.1"]


def test_quality_rules(spark, corpus):
    for text in (None, "", "a b c a b c d", "a a a a a", "x\nx\n\n\ny é#\nx"):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\f\r")]
        got = rules.describe(text.encode() if text else None)
        assert got[:5] == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))
    labels = spark.createDataFrame([(11, 0), *[(20 + i, 1) for i in range(30)], (999, 0), (None, 1), (12, None)], "doc_id long, quality int")
    judged = {r.doc_id: r for r in rules.judge(corpus, labels).collect()}
    assert judged[4].base_failed and not judged[11].kept and judged[25].kept
    kept = {r.doc_id for r in rules.keep(corpus, labels).collect()}
    assert 25 in kept and 4 not in kept


def test_decision_list_learns_a_conjunction():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 2))
    bad = (x[:, 0] > 0.7) & (x[:, 1] <= 0.4)
    learned = rules.learn_list(x, bad, ("a", "b"))
    hit = np.zeros(len(x), bool)
    for rule in learned:
        hit |= np.all([t.mask(x, ("a", "b")) for t in rule], axis=0)
    assert (hit == bad).mean() > 0.99


def test_network_scores_whole_texts():
    good, bad = ["the calm sea and the quiet land %d" % i for i in range(60)], ["BUY!! NOW!! CHEAP!! %d" % i for i in range(60)]
    net = cnn.train([t.encode() for t in good + bad], np.array([1.0] * 60 + [0.0] * 60), epochs=30)
    pair = net.tables()
    score = lambda t: cnn._score(t.encode(), net, pair)
    assert score("the quiet sea and land") > 0.8 > 0.2 > score("CHEAP!! BUY!!")
    rows = cnn.chunks(b"x" * 5000)
    seen = np.zeros(5000, int)
    for k, row in enumerate(rows):
        for w in range(cnn.CHUNK - cnn.WIDTH + 1):
            if k * cnn.STEP + w + cnn.WIDTH <= 5000:
                seen[k * cnn.STEP + w] += 1
    assert (seen[:5000 - cnn.WIDTH + 1] == 1).all()  # every window once
    assert 0 <= score("") <= 1


def test_network_is_fitted_on_whole_texts(spark):
    rng = np.random.default_rng(3)
    calm = lambda n: " ".join(rng.choice(["the", "calm", "sea", "and", "quiet", "land"], n))
    def text(bad):  # the only difference lies in bytes 700 to 1,400 of about 12,000
        start = calm(400)[:700]
        return start + (" BUY!! NOW!! CHEAP!!" * 35 if bad else calm(400)[:700]) + calm(2400)[:10_600]
    docs = spark.createDataFrame([(i, text(i % 2)) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in cnn.score(docs, cnn.fit(docs, labels, steps=80)).collect()}
    assert all((got[i] > 0.5) == (i % 2 == 0) for i in got)
    # A sum over parts is the gradient of the whole.
    net, texts, y = cnn.Network(1), [b"", b"abc", b"x" * 40_000, b"some text " * 300], np.array([1.0, 0.0, 1.0, 0.0])
    net.out += np.float32(0.1)
    whole, parts = cnn.gradient(net, texts, y), [cnn.gradient(net, texts[i:i + 1], y[i:i + 1]) for i in range(4)]
    for k in cnn.NAMES:
        assert np.allclose(whole[k], sum(p[k] for p in parts), atol=1e-5)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op3_quality_classifier(spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.9


@pytest.mark.parametrize("url, host, path", [
    (None, "", ""), ("no scheme/x", "", ""), ("http://A.Ex.com", "a.ex.com", ""), ("x://h?q=/a", "h", ""), ("a://b/c/://d#e?f", "b", "/c/://d"), ("://", "", "")])
def test_url_parts_and_rules(spark, url, host, path):
    row = urls.judge(spark.createDataFrame([(1, url, "x")], "page_id long, url string, host string"), queries.URL_RULES).first()
    assert (row.host, row.path, row.verdict) == (host, path, "allow")


def test_url_rules_longest_wins(spark):
    pages = spark.createDataFrame([(1, "http://www.example.com/en/1"), (2, "http://blog.example.com/en/"), (3, "http://example.com/de/"),
                                   (4, "http://xexample.com/en/"), (5, "https://a.net/es/"), (6, "https://a.net/de/")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge(pages, queries.URL_RULES).collect()}
    assert [got[i] for i in range(1, 6)] == [("www.example.com/en/", "allow"), ("example.com/en/", "block"), ("com/", "allow"),
                                             ("com/", "allow"), ("net/es/", "block")]
    assert got[6][0] is None


def test_brown_scores(corpus):
    words = {}
    for r in corpus.collect():
        words.setdefault((r.doc_id, r.text), (r.text or "").lower().split())
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts, ends = Counter(), 0
    for r in corpus.collect():
        if not held(r.doc_id):
            counts.update((r.text or "").lower().split())
            ends += 1
    total, types = sum(counts.values()) + ends, len(counts) + 1
    by_doc = {}
    for r in brown.score(corpus).collect():
        by_doc.setdefault(r.doc_id, r)
    for (i, _), own in words.items():
        if i == 10:
            continue
        seen = [counts[w] for w in own] + [ends]
        r = by_doc[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(seen), sum(c > 0 for c in seen), total, held(i))
        assert math.isclose(r.base_score, sum(math.log10((c + 1) / (total + types + 1)) for c in seen))
        assert r.score < 0


def test_brown_model_is_normalised_and_exchange_helps():
    rng = np.random.default_rng(4)
    n = rng.integers(0, 9, (brown.CLASSES, brown.CLASSES)).astype(float)
    right, left = n[3] / 2, n[:, 3] / 2
    to = brown.best_class(n, 3, right, left, 0.0)
    after = n.copy()
    after[3] -= right
    after[:, 3] -= left
    after[to] += right
    after[:, to] += left
    assert to == 3 or brown.objective(after) >= brown.objective(n) - 1e-6


@pytest.fixture(scope="module")
def ranks():
    import public_tokenizers
    return bpe.load_ranks(None, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def test_bpe_equals_the_library(corpus, ranks):
    import public_tokenizers
    import tiktoken
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = ["", None, "<|endoftext|>", "a" * 3000, "aba" * 200, " " * 70 + "x", "\u2003\u1680 x\x85\x1c", "中文字" * 90, "👩‍👩‍👧 ﬁ", "tiations" * 30]
    docs = corpus.sparkSession.createDataFrame(list(enumerate(odd)), "doc_id long, text string").unionByName(corpus.select("doc_id", "text"))
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, keys=("doc_id", "text")).collect()
    assert len(coded) == docs.count()
    for r in coded:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == library.encode_ordinary(r.text or "") and r.n_tokens == len(ids)
        assert bytes(r.decoded) == (r.text or "").encode()
    back = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN, keys=("doc_id", "text")), ranks, keys=("text",)).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back)


def test_embedding_links(spark):
    rng = np.random.default_rng(6)
    rows = []
    for c in range(40):
        centre = rng.normal(size=16)
        for _ in range(8):
            v = centre + rng.normal(size=16) * 0.12 * np.linalg.norm(centre) / 4
            rows.append((len(rows), [float(x) for x in v], c % 3))
    rows += [(len(rows) + k, rows[5][1], rows[5][2]) for k in range(300)]  # one very common vector
    rows += [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, rows[5][1], None), (1004, [], 0), (1005, [1.0, None], 0),
             (None, rows[5][1], rows[5][2])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS rep", "'x' AS name")
    able = [(i, np.array(v), c) for i, v, c in rows if i is not None and i < 1000]
    unit = np.stack([v / np.linalg.norm(v) for _, v, _ in able])
    label = np.array([c for _, _, c in able])
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    want = components_of(range(len(able)), lambda a, b: near[a, b])
    for kind in ({}, {"leaf": 20, "block": 64}):
        got = {r.vec_id: r for r in embeddings.near_duplicates(frame, **kind).collect()}
        assert len(got) == len(rows)
        links = np.array([got[i].n_links for i, _, _ in able])
        assert links.sum() >= 0.9 * near.sum() and (links <= near.sum(1)).all()
        if not kind:
            assert all(got[i].component_id == want[i] for i, _, _ in able)
        assert all(got[i].n_links == 0 and got[i].kept for i in (1000, 1001, 1002, 1003, 1004, 1005, None))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>%s<article><h1>Head %d</h1>
%s</article><div class="comments"><p>reader says</p></div><footer>&copy; me</footer></body></html>"""


def test_wrappers_extract_the_article(spark):
    nav = '<nav><ul><li><a href="/a">A</a></li><li><a>B</a></li></ul></nav>'
    rows, want = [], {}
    for i in range(30):
        body = "".join(f"<p>Text {k} &amp; {'more ' * (i % 4)}<b>bold</b>" + ("</p>" if k % 2 else "") for k in range(i % 5 + 1))
        aside = '<aside>see also</aside><form><input name="q">Send</form><div class="cookie-notice">ok</div>' if i % 3 == 0 else ""
        rows.append((i, f"http://{'big' if i < 20 else f'h{i}'}.org/{i}", PAGE % (nav * (i % 2) + aside, i, body)))
        want[i] = "\n".join([f"Head {i}", *[" ".join(f"Text {k} & {'more ' * (i % 4)}bold".split()) for k in range(i % 5 + 1)]])
    rows += [(100, None, None), (101, "x", ""), (102, "http://h/", "<p>a < b<br>c <y"), (103, "http://q/", "<article><p>one<script>"), (103, "http://q/", "<!-- x")]
    want |= {100: "", 101: "", 102: "a < b c"}
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host")).collect()}
    assert {k: got[k] for k in want} == want


def test_alignment_makes_groups_optional_and_repeated():
    a, b = wrappers.collapse(["n", "h", "p", "p", "f"]), wrappers.collapse(["h", "p", "s", "f"])
    assert wrappers.align(a, b) == [["n", True, False], ["h", False, False], ["p", False, True], ["s", True, False], ["f", False, False]]
    assert wrappers.collapse(["x", "y", "x", "y"]) == [[[["x", False, False], ["y", False, False]], False, True]]


def test_wrapper_slots_tell_the_template_from_the_article(spark):
    for tokens in (["n", "h", "p", "p", "f"], list("xyxyxz"), list("abbabbc"), ["a"] * 5, []):
        items, places = wrappers.numbered(tokens)
        assert items == wrappers.collapse(tokens) and sum(map(len, places)) == len(tokens)
        for item, own in zip(items, places):
            flat = list(wrappers.tokens_of([item]))
            assert [flat[k] for k in own] == tokens[:len(own)]
            tokens = tokens[len(own):]
    wrapper = [["d", True, False], ["p", False, True], ["d", False, False]]
    assert wrappers.parse([["d", False, False]], wrapper) == [2] and wrappers.parse([["p", False, False], ["d", False, False]], wrapper) == [1, 2]
    # The same path before and after the text: only the first is the template's. Classes of body say nothing.
    page = '<body class="has-sidebar"><div>All rights of the site</div><p>Own %d</p><div>Last %d</div></body>'
    inside = "<article><h1>Title</h1><div>Written by the staff</div><p>Own %d</p></article>"
    rows = [(i, "http://plain/", page % (i, i)) for i in range(15)] + [(20 + i, "http://inside/", inside % i) for i in range(15)]
    rows += [(40 + i, "http://copies/", "<p>same</p>") for i in range(15)]
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Own {i}\nLast {i}" for i in range(15)} | {20 + i: f"Title\nOwn {i}" for i in range(15)} | {40 + i: "same" for i in range(15)}


def test_wrapper_decides_per_page_and_from_sums_over_the_host(spark):
    # One page with main empties no other page of its host, and one page of links removes no slot.
    rows = [(i, None, f"<div><p>Plain {i}</p></div>") for i in range(5)] + [(5, "no host", "<main><p>Main</p></main><p>rest</p>")]
    rows += [(10 + i, "http://h/", f"<div><p>Words of page {i} <a>x</a></p></div>") for i in range(5)] + [(15, "http://h/", "<div><p><a>A short link</a></p></div>")]
    rows += [(30 + i, "http://c/", f"<nav>{i}</nav><article><p>copied</p></article>") for i in range(12)]
    rows += [(20 + i, "http://l/", f"<div><p>Text {i}</p><dl><dt><a>To page {i}</a></dl></div>") for i in range(3)]
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Plain {i}" for i in range(5)} | {5: "Main"} | {10 + i: f"Words of page {i} x" for i in range(5)} | {15: "A short link"} \
        | {20 + i: f"Text {i}" for i in range(3)} | {30 + i: "copied" for i in range(12)}


def test_empty_tables(spark, nothing, ranks):
    import public_tokenizers
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert minhash.near_duplicates(nothing).count() == minhash.keep_one(nothing).count() == 0
    assert mixing.mix(nothing).count() == mixing.repeat(nothing).count() == 0
    assert pii.find(nothing).count() == pii.redact(nothing).count() == 0
    assert rules.judge(nothing, labels).count() == rules.keep(nothing, labels).count() == 0
    assert brown.score(nothing).count() == 0
    assert cnn.score(nothing, cnn.fit(nothing, labels)).count() == 0
    assert bpe.encode(nothing, ranks, public_tokenizers.PATTERN).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge(pages, queries.URL_RULES).count() == wrappers.extract(pages).count() == 0
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_queries_give_the_contracts_columns(spark):
    want = {"op4_personal_data": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
            "op8_byte_level_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]}
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for name, columns in want.items():
        frame = queries.QUERIES[name](spark, SF)
        assert frame.columns == columns
        for r in frame.collect():
            if name.startswith("op8"):
                assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
            else:
                text = ",".join(f"{list(BASE)[k]}:{s}:{e}" for s, k, e in base_spans(docs[r.doc_id]))
                assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_mixing_query_matches_its_sql(spark):
    from tests.oracle import compare, duck
    message, fine = compare(spark, duck(SF), "op2_source_mixing", queries.op2_source_mixing, queries.SQL["op2_source_mixing"], SF)
    assert fine, message
