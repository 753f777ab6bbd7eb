"""Chat formatting, spelling variants and collocations against plain versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import bpe, brown, chat, cnn, embeddings, minhash, mixing, phrases, pii, variants, wrappers
from tidegate.llm.quotient import QuotientFilter

WORDS = ["colour", "color", "colours", "colouur", "collour", "harbour", "harbor", "harbours", "élevée", "élevés", "élever", "naïveté"]


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(3)
    weight = 1 / np.arange(1, len(WORDS) + 1)
    plain = rng.choice(WORDS, 4000, p=weight / weight.sum())
    marks = rng.choice([" ", " ", " ", ". ", "\n", "\t", "; "], 4000)
    texts = ["".join(w + m for w, m in zip(plain[i::40], marks[i::40])) for i in range(40)]
    rows = [(i, t.upper() if i % 9 == 0 else t, "en" if i % 3 else None) for i, t in enumerate(texts)]
    rows += [(None, "colour colour harbour", "en"), (50, None, "en"), (51, "", "fr"), (52, texts[1], "en"), (52, texts[1], "en"), (53, " . \t\n!", "")]
    return spark.createDataFrame([(*r, 1, "x", 0, "y") for r in rows],
                                 "doc_id long, text string, lang string, n int, word string, h1 int, phrase string")


CHATS = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo [INST] \\ [\\INST] <s> <\\\\/s> [\\/OUT]"), (1, 1, "assistant", None), (1, 1, "assistant", None),
         (2, None, "tool", "x[/ROLE]"), (2, 3, None, "</s>"), (2, 2, "we[ROLE]ird\n", "é😀</s"), (None, 1, "user", ""), (None, 2, "assistant", "<<s>s>"),
         (3, 0, "assistant", "a [/OUT]</s><s>[INST] b"), (3, 1, "system", "[[/SYS]]"), (4, 0, "assistant", "é" * 70_000 + "[OUT]"),
         (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (6, 5, "user", "<\\\\s> only looks escaped")]
CHATS += [(9, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(2600)]


def test_chats_read_back(spark):
    table = spark.createDataFrame([(*r, "f") for r in CHATS], "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_chats(table)
    want = defaultdict(list)
    for c, t, role, text in sorted(CHATS, key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        want[c].append((role or "", text or ""))
    got = {r.conv_id: r for r in chat.read(out).collect()}
    assert got.keys() == want.keys()
    for c, r in got.items():
        assert [(t.role, t.text) for t in r.parsed] == want[c]
        learned = [r.formatted[m.start:m.stop] for m in r["mask"]]
        assert len(learned) == sum(role == "assistant" for role, _ in want[c])
        assert not any(re.search(chat.CONTROL, t) for t in learned)
        assert re.sub(r"(<)\\(\\*/?s>)|(\[)\\(\\*/?(?:SYS|INST|OUT|ROLE)\])", r"\1\3\2\4", "".join(learned)) == "".join(t for role, t in want[c] if role == "assistant")
    assert got[9].formatted.count("<s>") == 2600 and "[\\INST]" in got[-7].formatted
    for r in chat.digests(out).collect():
        learned = "".join(t for role, t in want[r.conv_id] if role == "assistant")
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in want[r.conv_id]).encode()).hexdigest()
        assert (r.n_turns, r.loss_chars, r.formatted_chars) == (len(want[r.conv_id]), len(learned), len(got[r.conv_id].formatted))
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert chat.digests(chat.format_chats(table.filter("false"))).count() == 0


@pytest.mark.parametrize("text", ["x", "<s>[INST]a[/OUT]</s>", "<s>[INST]a[/INST]</s>x", "<s>[INST]a[/INST]b</s>", "<s>[INST]a", "<s> [SYS]a[/SYS]</s>",
                                  "<s>[/INST]a[/INST]</s>", "<s>[INST]a[INST]</s>", "[INST]a[/INST]"])
def test_other_grammars_are_not_read(spark, text):
    assert chat.read(spark.createDataFrame([(text,)], "formatted string")).first().parsed is None


def test_variants(spark, docs):
    counts = Counter()
    for r in docs.collect():
        for w in re.findall("[a-zÀ-ÿ]+", lower(r.text)):
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{w}".encode())
            k = h % len(w)
            counts[w[:k] + w[k + 1:] if h % 199 == 0 else w] += 1
    kept = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def edited(a, b):
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    near = {w: [o for o in kept if edited(w, o)] for w in kept}
    form = {}
    for w, n in kept.items():
        best = min(near[w], key=lambda o: (-kept[o], o), default=None)
        form[w] = best if best and kept[best] >= 5 * n else None
    want = {}
    for w, n in kept.items():
        root = w
        while form[root]:
            root = form[root]
        want[w] = (w, form[w], root, n, len(near[w]), kept[form[w]] if form[w] else None)
    got = variants.group_variants(docs).collect()
    assert {r.word: tuple(r) for r in got} == want and len(got) == len(want)
    assert any(form.values()) and variants.group_variants(docs.filter("false")).count() == 0


def test_roots_follow_long_chains(spark):
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)], "word string, form string")
    assert {r.root for r in variants.roots(chain).collect()} == {"w9"}


def test_words_met_by_one_letter_are_counted_once(spark):
    counted = spark.createDataFrame([("aabbcc", 9), ("aaabbcc", 5), ("aabbcd", 7), ("abbcc", 5), ("zzzzzz", 5)], "word string, n long")
    got = {r.word: (r.n_near, r.best.word) for r in variants.near(counted).collect()}
    assert got == {"aabbcc": (3, "aabbcd"), "aaabbcc": (1, "aabbcc"), "aabbcd": (1, "aabbcc"), "abbcc": (1, "aabbcc")}


@pytest.mark.parametrize("limbs, bits", [(1, 57), (1, 7), (1, 63), (3, 64)])
def test_quotient_filter_is_lossless(limbs, bits):
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2 ** min(bits, 62), (5000, limbs)).astype(np.uint64)
    keys = np.concatenate([keys, keys[:700], *[keys[:1]] * 400])
    want = Counter(map(tuple, keys.tolist()))
    held = QuotientFilter.of(bits, keys)
    pieces = [QuotientFilter.from_bytes(bits, f.to_bytes()) for _, f in held.parts(3)]
    both = QuotientFilter.merged(bits, [*pieces, QuotientFilter.from_bytes(bits, held.to_bytes())], limbs)
    got, counts = both.at_least(1)
    assert dict(zip(map(tuple, got.tolist()), counts.tolist())) == {k: 2 * n for k, n in want.items()}
    assert len(QuotientFilter.from_bytes(bits, QuotientFilter.merged(bits, [], limbs).to_bytes())) == 0
    if bits == 57:
        assert len(held.to_bytes()) < 9 * len(held)


def plain_collocations(rows):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(text)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= 10}
        found = []
        for p, a in cand.items():
            if any(100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in cand.items() if len(q) == 3):
                continue
            score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:2000])]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"dense": 3}, {"hash_bits": 9}])
def test_collocations(docs, options):
    """Dense ids, hashes as ids, and hashes that collide under the first seeds."""
    want = plain_collocations([(r.lang, r.text) for r in docs.collect()])
    assert len(want) > 50 and sorted(map(tuple, phrases.collocations(docs, **options).collect())) == want


def test_collocations_over_small_buffers(docs, monkeypatch):
    """Phrases that cross a buffer's end, and filters written out early."""
    packing = phrases.Packing(np.arange(1, 40))
    ids = np.random.default_rng(1).integers(0, 20, 3000)
    import pyarrow as pa

    def counted():
        shards = phrases._shards([pa.record_batch({"ids": pa.array([ids.tolist()], pa.list_(pa.int64()))})], packing, 4)
        held = QuotientFilter.merged(packing.bits, [QuotientFilter.from_bytes(packing.bits, b) for s in shards for b in s.column(1).to_pylist()], 1)
        keys, counts = held.at_least(1)
        return dict(zip(keys[:, 0].tolist(), counts.tolist()))
    whole = counted()
    monkeypatch.setattr(phrases, "BUFFER", 7)
    monkeypatch.setattr(phrases, "SPILL", 50)
    assert counted() == whole


def test_collocations_of_nothing(docs):
    assert phrases.collocations(docs.filter("false")).count() == 0
    assert phrases.collocations(docs.withColumn("text", F.lit(None).cast("string"))).count() == 0


def test_keep_one_judges_texts_of_one_id_apart(spark):
    rng = np.random.default_rng(8)
    a, b = (" ".join(rng.choice([f"{c}{i}" for i in range(200)], 80)) for c in "ab")
    rows = [(1, a, {"k": 1}, 0), (1, b, {"k": 2}, 1), (3, b, {"k": 3}, 2), (3, b, {"k": 3}, 3), (None, b, None, 4), (7, None, None, 5), (7, None, None, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra map<string, int>, __row int")
    assert sorted(r["__row"] for r in minhash.keep_one(docs).collect()) == [0, 1, 4, 5, 6]


def test_redact_beside_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "mail a@b.example now", "s", 1, 2), (1, "none", "t", 3, 4)],
                                 "doc_id long, text string, spans string, __row int, base int")
    assert sorted(map(tuple, pii.redact(docs).collect())) == [(1, "mail [EMAIL] now", "s", 1, 2), (1, "none", "t", 3, 4)]


def test_repeat_keeps_rows_that_differ_elsewhere(spark):
    rows = [(i % 4, "one two three", "s", {"k": i}, i) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra map<string, int>, __copies int")
    got = mixing.repeat(docs).collect()
    assert {r["__copies"] for r in got} == set(range(12)) and len(got) == 12


def test_cache_keeps_frequent_pieces(monkeypatch):
    monkeypatch.setattr(bpe, "HELD", 10)
    cache = bpe.Cache()
    for turn in range(20):
        held, fresh = cache.known({"often", *(f"p{turn}_{i}" for i in range(6))})
        assert ("often" in fresh) == (turn == 0)
        held.update({x: (b"", b"") for x in fresh})
        assert len(cache.young) + len(cache.old) <= 40


def test_class_matrix_counts_neighbours(spark):
    rows = [(i, [(i + 1) % 6, i], [2.0, 1.0]) for i in range(6)] + [(6, None, None)]
    frame = spark.createDataFrame(rows, "item int, rj array<int>, rn array<double>").repartition(5)
    classes = np.array([0, 0, 1, 1, 2, 2, 63])
    want = np.zeros((brown.CLASSES, brown.CLASSES))
    for i, js, ns in rows[:6]:
        for j, n in zip(js, ns):
            want[classes[i], classes[j]] += n
    assert (brown._matrix(frame, classes) == want).all()


def test_vectors_of_any_finite_length_link(spark):
    rows = [(1, [1.0, 1.0], "a"), (2, [1e200, 1e200], "a"), (3, [1e-200, 1.01e-200], "a"), (4, [1e308, -1e308], "a"), (5, [5e-324, 0.0], "a"), (6, [7.0, 0.01], "a")]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (1, 5), 6: (1, 5)}


def test_long_streams_align_like_short_ones():
    shared = [f"s{i}" for i in range(1100)]
    a = wrappers.collapse(["a", *(t for s in shared for t in (s, f"a{s}")), "b"])
    b = wrappers.collapse(["c", *(t for s in shared for t in (f"b{s}", s)), "d"])
    assert len(a) * len(b) > 1_000_000
    made = wrappers.align(a, b)
    assert [token for token, optional, _ in made if not optional] == shared
    assert len(made) == len(a) + len(b) - len(shared)


def test_steps_of_the_classifier_read_few_parts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(cnn, "cut_lineage", lambda df: df.repartition(40))  # as many parts as a cluster's shuffle makes
    monkeypatch.setattr(cnn, "_total", lambda rows, net: seen.append(rows.rdd.getNumPartitions()) or (0, {}))
    docs = spark.range(60).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text")
    cnn.fit(docs, spark.range(60).selectExpr("id AS doc_id", "id % 2 AS quality"), steps=2)
    assert seen and max(seen) <= cnn.PARTS
