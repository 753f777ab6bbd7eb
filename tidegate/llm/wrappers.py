"""Main text of pages by wrapper inference: union-free regular expressions over same-host pages.

A page is read as a stream of block tokens; a token is the path of its block
elements with their classes, and stands before a text slot. Neighbouring copies
of a group of tokens become a repeated group, so pages of one template mostly
share one stream. The distinct streams of a host are aligned one after the other:
what both sides have stays, what one side lacks becomes optional, what one side
repeats becomes repeated. The result, a wrapper, is a sequence of tokens and
groups without alternatives. Every page is then parsed by its host's wrapper: each
of its blocks takes one position of it, a slot, so one path before and after the
article makes two slots. Spark sums up what stands in a slot over all pages of the
host: link and other characters, different pages and different texts. A slot whose
texts stand on ``FIXED`` pages each, on average, is part of the template, unless it is
the title (h1) of an article or a page has no other text to keep. Names of elements, roles and classes,
except those of html and body, tell menus, adverts, footers and the like.
Text in the remaining slots is kept, in page order.

Work. Only distinct streams are aligned. They are dealt by (host, stream), folded
in a stream of rows, and the few partial wrappers of a host are folded again, so a
host with a third of all pages costs no task more than its share. Wrappers are
written to the shared folder; the planner broadcasts them only if that table is
small, and otherwise joins by host.

Defined cases. A null or empty page, and one without article text, gives an empty
text. A null url, or one without a host, belongs to the empty host. Comments,
scripts and unclosed elements never fail: a tag left open at the end is closed
there, a stray ``<`` is text. A page of which no block is in an article or main element,
whatever the other pages of its host have, keeps its text of all slots outside the
excluded regions in which, summed over the host's pages, links are not the most text.
Repeated rows give repeated results; equal pages count as one for a template.
"""

from __future__ import annotations

import html
import json
import re
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.common import text_slices
from tidegate.session import scratch_folder

# Element names of HTML by their role here.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul head""".split())
RAW = frozenset("script style textarea title noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
OUTSIDE = frozenset("nav header footer aside form menu dialog search head".split())
MUTE = frozenset("button select svg math object template".split())  # inside a line, but no text of it
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
OUTSIDE_WORDS = frozenset("""ad ads advert advertisement advertising adbox banner promo promotion sponsor sponsored nav navbar navigation menu
breadcrumb breadcrumbs header masthead footer sidebar aside widget notice notices cookie cookies consent gdpr popup modal overlay newsletter
subscribe signup login share sharing social related recommended comment comments commentlist respond disqus replies reply pagination pager toolbar
form search skip copyright""".split())
CENTRE = frozenset(("article", "main"))
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_QUOTE_OR_END = re.compile("[\"'>]")
_TAG = re.compile(r"<(?=[A-Za-z/!?])")
MAX_PERIOD = 6
FIXED = 10  # pages that a text of a template's slot stands on


def _tag_end(page: str, at: int, open_quotes: dict[str, bool]) -> int:
    """Where the tag that starts before ``at`` ends; quotes may hide its end."""
    first = page.find(">", at)
    while True:
        m = _QUOTE_OR_END.search(page, at)
        if not m:
            return first
        if m[0] == ">":
            return m.start()
        close = -1 if open_quotes.get(m[0]) else page.find(m[0], m.end())
        if close < 0:  # no such quote follows: quotes of this kind hide nothing from here on
            open_quotes[m[0]] = True
            return first
        at = close + 1


def blocks(page: str) -> list[tuple[str, str, int]]:
    """(path, text, characters in links) of the text blocks of a page, in order."""
    out: list[tuple[str, str, int]] = []
    stack: list[tuple[str, str]] = []  # (element, label)
    held: list[str] = []
    links, in_link, path = 0, False, ""
    lower = None
    quotes: dict[str, bool] = {}

    def flush():
        nonlocal links
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append((path, text, links))
            held.clear()
            links = 0

    def cut(depth: int):
        nonlocal path
        del stack[depth:]
        path = ">".join(label for _, label in stack)

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        stop = m.start() if m else n
        if stop > at:
            if not any(element not in BLOCKS for element, _ in stack):  # not inside a muted stretch of a line
                piece = html.unescape(page[at:stop])
                held.append(piece)
                if in_link:
                    links += len(piece)
        if not m:
            break
        if page.startswith("<!--", stop):
            end = page.find("-->", stop + 4)
            at = n if end < 0 else end + 3
            continue
        end = _tag_end(page, stop + 1, quotes)
        if end < 0:  # a tag that never ends closes the page
            break
        at = end + 1
        closing = page[stop + 1] == "/"
        name = _NAME.match(page, stop + 1 + closing, end)
        if not name:
            continue  # a declaration
        name = name[0].lower()
        if name in RAW and not closing:
            if page[end - 1] == "/":
                continue
            if lower is None:
                lower = page.lower() if len(page.lower()) == n else "".join(c.lower() if c.isascii() else c for c in page)
            close = lower.find(f"</{name}", at)
            if close < 0:
                break
            end = page.find(">", close)
            at = n if end < 0 else end + 1
            continue
        if name == "a":
            in_link = not closing
            continue
        if name == "br":
            held.append(" ")
            continue
        if name in BLOCKS:
            flush()
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    cut(depth)
                    break
            continue
        if name in VOID or name in RAW:
            continue
        marks = sorted({w for a in _ATTRIBUTE.finditer(page, stop, end) for w in (a[2] or a[3] or a[4] or "").lower().split()})
        if name not in BLOCKS and name not in MUTE and not (marks and _outside(".".join([name, *marks]))):
            continue  # inline mark-up of the text
        if name == "body":  # ends a head that was left open
            cut(0)
        if name in BLOCKS:
            for depth in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph; items end their siblings
                if stack[depth][0] == "p" or stack[depth][0] in CLOSES.get(name, ()):
                    cut(depth)
                    break
                if stack[depth][0] in ("ul", "ol", "dl", "table", "article", "div", "section"):
                    break
        stack.append((name, ".".join([name, *marks])))
        path = ">".join(label for _, label in stack)
    flush()
    return out


# A stream, and a wrapper, is a list of items [token or list of items, optional, repeated].
def collapse(tokens: list) -> list:
    """Neighbouring copies of a group of up to MAX_PERIOD items become one repeated group."""
    return numbered(tokens)[0]


def numbered(tokens: list) -> tuple[list, list[list[int]]]:
    """The items of ``collapse`` and, for each, the place inside it of every token it covers."""
    items, places, widths = [[t, False, False] for t in tokens], [[0] for _ in tokens], [1] * len(tokens)
    for period in range(1, MAX_PERIOD + 1):
        out, at, wide = [], [], []
        i = 0
        while i < len(items):
            group = items[i:i + period]
            j = i + period
            while len(group) == period and items[j:j + period] == group:
                j += period
            if j > i + period:
                out.append([group[0][0] if period == 1 else group, group[0][1] if period == 1 else False, True])
                starts = [sum(widths[i:i + k]) for k in range(period)]  # copies are equal, so their widths are
                at.append([starts[(k - i) % period] + place for k in range(i, j) for place in places[k]])
                wide.append(sum(widths[i:i + period]))
                i = j
            else:
                out.append(items[i])
                at.append(places[i])
                wide.append(widths[i])
                i += 1
        items, places, widths = out, at, wide
    return items, places


def _path(x: list, y: list):
    """Steps ("both", "left", "right") along a longest common subsequence, for lists of any length.

    Row i has a bit for every j where the subsequence of x[i:] and y[j:] is longer than that of x[i:] and
    y[j + 1:]; a row follows from the one below by an addition of long integers. Every ``gap``-th row is kept,
    the rows between two of them are made again when the path passes, so about 2 sqrt(len(x)) rows are held.
    """
    m = len(y)
    name: dict[str, int] = {}
    right = [name.setdefault(json.dumps(token), len(name)) for token in y]
    places: dict[int, list[int]] = {}
    for j, own in enumerate(right):  # bit m - 1 - j stands for j, so that carries run towards the start
        places.setdefault(own, []).append(m - 1 - j)
    often = {own: sum(1 << p for p in at) for own, at in places.items() if len(at) > 64}  # the others cost less made when met
    codes = [name.get(json.dumps(token), -1) for token in x]
    full, gap = (1 << m) - 1, int(len(x) ** 0.5) + 1

    def above(row: int, code: int) -> int:
        still = full ^ row
        met = still & (often[code] if code in often else sum(1 << p for p in places.get(code, ())))
        return full ^ (((still + met) | (still - met)) & full)
    kept, row = {len(x): 0}, 0
    for i in range(len(x) - 1, -1, -1):
        row = above(row, codes[i])
        if i % gap == 0:
            kept[i] = row
    i = j = 0
    rows: dict[int, int] = {}
    while i < len(x) and j < m:
        if codes[i] == right[j]:
            yield "both"
            i, j = i + 1, j + 1
            continue
        if i not in rows or i + 1 not in rows:
            low = i - i % gap
            high = min(low + gap, len(x))
            rows = {high: kept[high]}
            for k in range(high - 1, low - 1, -1):
                rows[k] = above(rows[k + 1], codes[k])
        rest = (1 << (m - j)) - 1
        if rows[i] >> (m - 1 - j) & 1 or (rows[i] & rest).bit_count() == (rows[i + 1] & rest).bit_count():
            yield "left"
            i += 1
        else:
            yield "right"
            j += 1
    yield from ["left"] * (len(x) - i) + ["right"] * (m - j)


def align(a: list, b: list) -> list:
    """The wrapper of both: shared items in order, the others optional."""
    head = 0
    while head < min(len(a), len(b)) and a[head][0] == b[head][0]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail][0] == b[-1 - tail][0]:
        tail += 1
    both = lambda x, y: [x[0], x[1] or y[1], x[2] or y[2]]
    maybe = lambda x: [x[0], True, x[2]]
    out = [both(x, y) for x, y in zip(a[:head], b[:head])]
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    i = j = 0
    for step in _path([item[0] for item in x], [item[0] for item in y]):
        out.append(both(x[i], y[j]) if step == "both" else maybe(x[i]) if step == "left" else maybe(y[j]))
        i, j = i + (step != "right"), j + (step != "left")
    out += [both(x, y) for x, y in zip(a[len(a) - tail:], b[len(b) - tail:])]
    return _joined(out)


def _joined(items: list) -> list:
    """Equal neighbours, which alignment can bring together, become one repeated item."""
    out: list = []
    for item in items:
        if out and out[-1][0] == item[0]:
            out[-1] = [item[0], out[-1][1] and item[1], True]
        else:
            out.append(item)
    return out


def tokens_of(items: list):
    for token, _, _ in items:
        if isinstance(token, str):
            yield token
        else:
            yield from tokens_of(token)


def parse(stream: list, wrapper: list) -> list[int]:
    """The wrapper's item for each item of a stream, -1 if it has none; as few items as can be that are not optional stay empty."""
    head, ends = 0, (len(stream), len(wrapper))
    while head < min(ends) and stream[head][0] == wrapper[head][0] and not wrapper[head][1]:
        head += 1
    tail = 0
    while tail < min(ends) - head and stream[-1 - tail][0] == wrapper[-1 - tail][0] and not wrapper[-1 - tail][1]:
        tail += 1
    x, y = stream[head:ends[0] - tail], wrapper[head:ends[1] - tail]
    none = 1 + len(wrapper)  # worse than any empty items
    rows = [[0] * (len(y) + 1)]
    for j in range(len(y) - 1, -1, -1):
        rows[0][j] = rows[0][j + 1] + (not y[j][1])
    for item in reversed(x):
        below = rows[-1]
        row = [below[-1] + none] * (len(y) + 1)
        for j in range(len(y) - 1, -1, -1):
            row[j] = min(row[j + 1] + (not y[j][1]), below[j] + none)
            if item[0] == y[j][0] and below[j + 1] < row[j]:
                row[j] = below[j + 1]
        rows.append(row)
    rows.reverse()
    out, j = list(range(head)), 0
    for i, item in enumerate(x):
        while j < len(y) and not (item[0] == y[j][0] and rows[i][j] == rows[i + 1][j + 1]) and rows[i][j] == rows[i][j + 1] + (not y[j][1]):
            j += 1
        if j < len(y) and item[0] == y[j][0] and rows[i][j] == rows[i + 1][j + 1]:
            out.append(head + j)
            j += 1
        else:
            out.append(-1)
    return out + list(range(ends[1] - tail, ends[1]))


class Parser:
    """The slot of every block of a page, by its host's wrapper."""

    def __init__(self):
        self.wrappers: dict[str, tuple[list, list[int]]] = {}
        self.known: dict[tuple, list[int]] = {}

    def slots(self, paths: list[str], wrapper: str) -> list[int]:
        if len(self.known) > 10_000 or len(self.wrappers) > 1_000:
            self.known.clear()
            self.wrappers.clear()
        name = (wrapper, *paths)
        if name not in self.known:
            if wrapper not in self.wrappers:
                items = json.loads(wrapper)
                starts = [0]
                for item in items:
                    starts.append(starts[-1] + sum(1 for _ in tokens_of([item])))
                self.wrappers[wrapper] = items, starts
            items, starts = self.wrappers[wrapper]
            stream, places = numbered(paths)
            self.known[name] = [-1 if to < 0 else starts[to] + place for to, own in zip(parse(stream, items), places) for place in own]
        return self.known[name]


def _labels(path: str) -> list[tuple[str, set[str]]]:
    return [(p.partition(".")[0], set(p.split(".")[1:])) for p in path.split(">") if p]


def _outside(path: str) -> bool:
    inner = False
    for name, marks in _labels(path):
        if name in ("html", "body"):  # their classes are about the whole page
            continue
        if name in OUTSIDE and not (name == "header" and inner):  # an article's own header holds its title
            return True
        words = {w for m in marks for w in re.split(r"[-_\d]+", m)} | marks
        if words & OUTSIDE_WORDS or marks & OUTSIDE_ROLES:
            return True
        inner = inner or name in CENTRE
    return False


@lru_cache(100_000)
def _role(path: str) -> str:
    """What the names of a path say: outside, title, centre or nothing."""
    if _outside(path):
        return "outside"
    names = [name for name, _ in _labels(path)]
    if not CENTRE.intersection(names):
        return ""
    return "title" if names[-1] == "h1" else "centre"


def article_blocks(slots: list[int], paths: list[str], linked: set[int], fixed: set[int]) -> list[bool]:
    """Which blocks of a page are article text; ``linked`` slots hold more link text than other text, ``fixed`` ones the template's."""
    roles = [_role(path) for path in paths]
    if "title" in roles or "centre" in roles:
        held = [r in ("title", "centre") for r in roles]
    else:
        held = [not r and slot not in linked for r, slot in zip(roles, slots)]
    own = [h and slot not in fixed for h, slot in zip(held, slots)]
    if not any(own):  # many pages share all their text, as copies in different frames do
        return held
    return [o or (h and r == "title") for o, h, r in zip(own, held, roles)]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _streams(batches):
    """(host, stream) of every page."""
    for part, pages in text_slices(batches, "html"):
        streams = [json.dumps(collapse([path for path, _, _ in blocks(page or "")])) for page in pages]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(streams, pa.string())], names=["host", "stream"])


def _fold(batches):
    """Rows sorted by (host, salt) -> one partial wrapper per (host, salt)."""
    now, wrapper = None, []
    for batch in batches:
        done = []
        for host, salt, stream in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (host, salt) != now:
                if now is not None:
                    done.append((now[0], json.dumps(wrapper)))
                now, wrapper = (host, salt), json.loads(stream)
            else:
                wrapper = align(wrapper, json.loads(stream))
        yield _partial(done)
    if now is not None:
        yield _partial([(now[0], json.dumps(wrapper))])


def _partial(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())],
                                      names=["host", "stream"])


def infer(pages: DataFrame, *, url: str = "url", page: str = "html", salts: int = 32) -> DataFrame:
    """(host, stream): one wrapper per host, as JSON."""
    kinds = "host string, stream string"
    streams = pages.select(host_of(F.col(url)).alias("host"), F.col(page).alias("html")).mapInArrow(_streams, kinds).distinct()
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for salt in (F.pmod(F.xxhash64("stream"), F.lit(salts)), F.lit(0)):
        dealt = streams.select("host", salt.cast("int").alias("salt"), "stream").repartition(parts, "host", "salt") \
            .sortWithinPartitions("host", "salt", "stream")
        streams = dealt.mapInArrow(_fold, kinds)
    return streams


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _contents(batches):
    """(host, slot, page, words, chars, links) of every slot that a page fills; page and words are hashes."""
    parser = Parser()
    for part, pages in text_slices(batches, "html"):
        rows: list[tuple] = []
        for host, wrapper, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), pages):
            own = blocks(page or "")
            whole = _hash("\n".join(text for _, text, _ in own))
            held: dict[int, list] = {}
            for slot, (_, text, links) in zip(parser.slots([path for path, _, _ in own], wrapper), own):
                cell = held.setdefault(slot, [set(), 0, 0])
                cell[0].add(text)
                cell[1] += len(text)
                cell[2] += links
            rows += [(host, slot, whole, _hash("\n".join(sorted(texts))), n, links) for slot, (texts, n, links) in held.items() if slot >= 0]
        columns = list(zip(*rows)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 0 else pa.int64()) for i, c in enumerate(columns)],
                                         names=["host", "slot", "page", "words", "chars", "links"])


def measure(pages: DataFrame) -> DataFrame:
    """(host, linked, fixed): the slots of ``pages(host, stream, html)`` that are mostly links, and those of the template."""
    rows = pages.select("host", "stream", "html").mapInArrow(_contents, "host string, slot long, page long, words long, chars long, links long")
    # Counts of different values are estimates, exact to a few in a hundred; sums merge before the shuffle.
    slots = rows.groupBy("host", "slot").agg(F.approx_count_distinct("page", 0.03).alias("pages"), F.approx_count_distinct("words", 0.03).alias("texts"),
                                             F.sum(2 * F.col("links") - F.col("chars")).alias("surplus"))
    return slots.groupBy("host").agg(F.collect_list(F.when(F.col("surplus") > 0, F.col("slot"))).alias("linked"),
                                     F.collect_list(F.when(F.col("pages") >= FIXED * F.col("texts"), F.col("slot"))).alias("fixed"))


def extract(pages: DataFrame, *, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(key, url, text) of every page."""
    spark = pages.sparkSession
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(page).alias("html"), host_of(F.col(url)).alias("host"))
    # Written frames have a known size, so the planner broadcasts them only when small.
    folder = scratch_folder(spark, "wrappers")
    infer(pages, url=url, page=page).write.parquet(folder)
    wrappers = spark.read.parquet(folder)
    folder = scratch_folder(spark, "slots")
    measure(rows.join(wrappers, "host")).write.parquet(folder)
    decided = wrappers.join(spark.read.parquet(folder), "host", "left")
    kind = dict(pages.dtypes)[key]

    def run(batches):
        parser = Parser()
        for part, texts in text_slices(batches, "html"):
            out = []
            for text, wrapper, linked, fixed in zip(texts, *(part.column(i).to_pylist() for i in (2, 3, 4))):
                own = blocks(text or "")
                paths = [path for path, _, _ in own]
                keep = article_blocks(parser.slots(paths, wrapper), paths, set(linked or ()), set(fixed or ()))
                out.append("\n".join(t for (_, t, _), kept in zip(own, keep) if kept))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.string())], names=["key", "url", "text"])
    joined = rows.join(decided, "host", "left").select("key", "url", "stream", "linked", "fixed", "html")
    return joined.mapInArrow(run, f"key {kind}, url string, text string").withColumnRenamed("key", key)
