"""Byte-level BPE: recursive DuckDB queries inside Spark tasks.

A task splits its texts with the tokenizer's pattern and holds the distinct
pieces it has not met before. One recursive query contracts all of them together:
rows of (piece, position, token) join the merge table, each piece's leftmost pair
of minimum rank becomes one token, and the recursion ends when no piece has a pair
left. A second query decodes: tokens join the vocabulary and are aggregated in
order of position. Texts are then put together from their pieces.

Long pieces. A step that contracts one pair makes a piece of n bytes cost n steps,
so pieces of more than ``SHORT`` bytes contract every occurrence of their minimum
pair that does not overlap an earlier one. That gives the same tokens unless a
merged token, with a neighbour, forms a token of lower rank; ranks for which the
vocabulary allows this are marked ``lone`` and contract leftmost only. These
queries stop after ``STEPS`` steps and resume from the last state, so that the
recursion's rows stay bounded.

Memory. A worker caches pieces in two generations of ``HELD`` entries or so: when the
young one is full it becomes the old one, and pieces met again move to the new young
one, so that frequent pieces stay. Pieces of more than ``SHORT`` bytes are cached for
their slice only. Texts pass one slice of ``SLICE`` bytes at a time.

Defined cases. A null text is an empty one: no tokens. Text that looks like a
special token is ordinary text. Ids outside the vocabulary fail in ``decode``.
Null ids and repeated rows are passed through row by row.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm.common import text_slices

SHORT, STEPS, HELD, BATCH, SLICE = 48, 24, 150_000, 20_000, 2 << 20
# Fixed value: Unicode white space, which the pattern's \s stands for.
_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def load_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """The vocabulary: token bytes by rank, from lines of base64 and rank (a few hundred thousand at most)."""
    lines = path_lines(path) if "://" not in path else [r[0] for r in spark.read.text(path).collect()]
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def path_lines(path: str) -> list[str]:
    with open(path, encoding="ascii") as f:
        return f.read().splitlines()


def own_pattern(pattern: str) -> str:
    """The pattern with its white-space escapes spelt out."""
    return (pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{_SPACE}\p{{L}}\p{{N}}]")
            .replace(r"(?!\S)", rf"(?![^{_SPACE}])").replace(r"\s+", rf"[{_SPACE}]+"))


# Each step: neighbours by position, their merges, and the leftmost of the least rank per piece.
_ENCODE = """
WITH RECURSIVE steps(n, w, p, e, t) AS (
  SELECT 0, w, p, p + 1, t FROM start
  UNION ALL
  SELECT s.n + 1, s.w, s.p, CASE WHEN s.p = b.p THEN b.e ELSE s.e END, CASE WHEN s.p = b.p THEN b.r ELSE s.t END
  FROM steps s JOIN (
    SELECT w, x.r AS r, x.p AS p, x.q AS q, x.e AS e
    FROM (SELECT one.w, min({'r': m.r, 'p': one.p, 'q': two.p, 'e': two.e}) AS x
          FROM steps one JOIN steps two ON two.w = one.w AND two.p = one.e JOIN merges m ON m.a = one.t AND m.b = two.t
          GROUP BY one.w)) b ON b.w = s.w
  WHERE s.p <> b.q
)
"""
_LONG = """
WITH RECURSIVE steps(n, w, p, t) AS (
  SELECT 0, w, p, t FROM start
  UNION ALL
  SELECT n + 1, w, p, CASE WHEN hit THEN r ELSE t END
  FROM (SELECT *, coalesce(lag(hit) OVER (PARTITION BY w ORDER BY p), false) AS eaten
        FROM (SELECT *, coalesce(r = best AND CASE WHEN lone THEN p = first ELSE (i - run) % 2 = 0 END, false) AS hit
              FROM (SELECT *, max(CASE WHEN r IS DISTINCT FROM best THEN i ELSE -1 END) OVER (PARTITION BY w ORDER BY p) + 1 AS run,
                           min(CASE WHEN r = best THEN p END) OVER (PARTITION BY w) AS first
                    FROM (SELECT *, min(r) OVER (PARTITION BY w) AS best
                          FROM (SELECT s.*, m.r, m.lone
                                FROM (SELECT *, lead(t) OVER (PARTITION BY w ORDER BY p) AS u,
                                             row_number() OVER (PARTITION BY w ORDER BY p) - 1 AS i
                                      FROM steps WHERE n < 24) s
                                LEFT JOIN merges m ON m.a = s.t AND m.b = s.u))
                    WHERE best IS NOT NULL)))
  WHERE NOT eaten
)
"""
_LAST = """
SELECT s.w, s.p, s.t FROM steps s JOIN (SELECT w, max(n) AS n FROM steps GROUP BY w) z ON z.w = s.w AND z.n = s.n
"""
_DECODE = """
SELECT i.w, string_agg(v.body, '' ORDER BY i.p) AS body FROM ids i LEFT JOIN vocabulary v ON v.t = i.t GROUP BY i.w
"""


class Codec:
    """One DuckDB connection with the merge table and the vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        import duckdb

        left, right, rank, lone = [], [], [], set()
        for token, r in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(r)
                    lone.update(x for x in (a, b) if x > r)  # as a merged token it could precede its own rank
        self.bytes = np.zeros(256, np.int32)
        for token, r in ranks.items():
            if len(token) == 1:
                self.bytes[token[0]] = r
        self.ranks = ranks
        con = self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "250MB"})
        con.register("pairs", pa.table({"a": pa.array(left, pa.int32()), "b": pa.array(right, pa.int32()), "r": pa.array(rank, pa.int32()),
                                        "lone": pa.array([r in lone for r in rank])}))
        con.register("words", pa.table({"t": pa.array(list(ranks.values()), pa.int32()), "body": pa.array([b.hex() for b in ranks])}))
        con.execute("CREATE TABLE merges AS SELECT * FROM pairs")
        con.execute("CREATE TABLE vocabulary AS SELECT * FROM words")

    def _rows(self, pieces: list[bytes]) -> pa.Table:
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        begin = np.cumsum(size) - size
        return pa.table({"w": np.repeat(np.arange(len(pieces)), size).astype(np.int32),
                         "p": (np.arange(size.sum()) - np.repeat(begin, size)).astype(np.int32),
                         "t": self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]})

    def encode(self, pieces: list[bytes]) -> pa.Table:
        """(w, p, t): the tokens t of piece number w, ordered by p within w."""
        con = self.con
        # A piece that is itself a token is that token, whatever merges lead to it.
        whole = [i for i, x in enumerate(pieces) if x in self.ranks]
        rest = [i for i, x in enumerate(pieces) if x not in self.ranks]
        short = [i for i in rest if len(pieces[i]) <= SHORT]
        parts = [(np.array(whole, np.int64), np.zeros(len(whole), np.int64), np.array([self.ranks[pieces[i]] for i in whole], np.int64))]
        for start in range(0, len(short), BATCH):
            chosen = short[start:start + BATCH]
            con.register("start", self._rows([pieces[i] for i in chosen]))
            got = con.sql(_ENCODE + _LAST).to_arrow_table()
            parts.append((np.array(chosen, np.int64)[got["w"].to_numpy()], got["p"].to_numpy(), got["t"].to_numpy()))
        for i in (i for i in rest if len(pieces[i]) > SHORT):
            rows = self._rows([pieces[i]])
            while True:
                con.register("start", rows)
                got = con.sql(_LONG.replace("24", str(STEPS)) + _LAST).to_arrow_table()
                if got.num_rows == rows.num_rows:
                    break
                rows = got
            parts.append((np.full(got.num_rows, i), got["p"].to_numpy(), got["t"].to_numpy()))
        w, p, t = (np.concatenate([x[k] for x in parts]) for k in range(3))
        order = np.lexsort((p, w))
        return pa.table({"w": w[order].astype(np.int32), "p": p[order].astype(np.int32), "t": t[order].astype(np.int32)})

    def decode(self, ids: pa.Table) -> dict[int, bytes]:
        """Bytes of every w in ``ids(w, p, t)``."""
        self.con.register("ids", ids)
        unknown = self.con.execute("SELECT count(*) FROM ids i ANTI JOIN vocabulary v ON v.t = i.t").fetchall()[0][0]
        if unknown:
            raise ValueError(f"{unknown} ids are not in the vocabulary")
        got = self.con.sql(_DECODE).to_arrow_table()
        return {w: bytes.fromhex(b) for w, b in zip(got["w"].to_pylist(), got["body"].to_pylist())}


class Cache:
    """Pieces with their ids and decoded bytes, in two generations."""

    def __init__(self):
        self.young: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}

    def known(self, pieces: set[str]) -> tuple[dict, list[str]]:
        """The cache to read ``pieces`` from, and those it still lacks."""
        if len(self.young) > HELD:
            self.old, self.young = self.young, {}
        young, old, fresh = self.young, self.old, []
        for x in pieces:
            if x not in young:
                if x in old:
                    young[x] = old[x]
                else:
                    fresh.append(x)
        return young, fresh

    def forget(self, pieces: list[str]) -> None:
        for x in pieces:
            if len(x) > SHORT:
                self.young.pop(x, None)


_OPEN: dict[int, tuple[Codec, Cache]] = {}  # codecs and caches of this worker, by vocabulary


def _codec(ranks: dict[bytes, int]) -> tuple[Codec, Cache]:
    name = hash(tuple(sorted(ranks.items())))
    if name not in _OPEN:
        _OPEN[name] = (Codec(ranks), Cache())
    return _OPEN[name]


def _learn(codec: Codec, fresh: list[str], held: dict) -> None:
    """Encode and decode pieces and put them into the cache."""
    for start in range(0, len(fresh), BATCH):
        part = fresh[start:start + BATCH]
        table = codec.encode([x.encode() for x in part])
        packed, w = table["t"].to_numpy().astype("<u4").tobytes(), table["w"].to_numpy()
        edges = np.searchsorted(w, np.arange(len(part) + 1)) * 4
        bodies = codec.decode(table)
        for i, x in enumerate(part):
            held[x] = (packed[edges[i]:edges[i + 1]], bodies[i])


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """(keys, n_tokens, ids, decoded) of every row: ids as little-endian unsigned 32-bit integers, decoded bytes."""
    types = dict(docs.dtypes)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ranks)  # a vocabulary, of a fixed size

    def run(batches):
        codec, cache = _codec(shared.value)
        split = regex.compile(own_pattern(pattern)).findall
        for part, texts in text_slices(batches, "__text", SLICE):
            pieces = [split(t) if t else [] for t in texts]
            held, fresh = cache.known({x for own in pieces for x in own})
            if fresh:
                _learn(codec, fresh, held)
            packed = [b"".join([held[x][0] for x in own]) for own in pieces]
            bodies = [b"".join([held[x][1] for x in own]) for own in pieces]
            cache.forget(fresh)
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(part.num_columns - 1)]
                + [pa.array([len(x) // 4 for x in packed], pa.int64()), pa.array(packed, pa.binary()), pa.array(bodies, pa.binary())],
                names=[*part.schema.names[:-1], "n_tokens", "ids", "decoded"])
    fields = ", ".join([f"`{k}` {types[k]}" for k in keys] + ["n_tokens long, ids binary, decoded binary"])
    return docs.select(*keys, F.col(text).alias("__text")).mapInArrow(run, fields)


def decode(encoded: DataFrame, ranks: dict[bytes, int], *, keys: tuple[str, ...] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """(keys, decoded) of rows of packed ids, by ordered aggregation."""
    types = dict(encoded.dtypes)
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        codec = _codec(shared.value)[0]
        for part, values in text_slices(batches, "__ids", 1 << 20):
            arrays = [np.frombuffer(v or b"", "<u4") for v in values]
            size = np.array([len(a) for a in arrays], np.int64)
            table = pa.table({"w": np.repeat(np.arange(len(arrays)), size).astype(np.int32), "p": np.arange(size.sum()).astype(np.int64),
                              "t": np.concatenate([*arrays, np.empty(0, "<u4")]).astype(np.int64)})
            got = codec.decode(table)
            yield pa.RecordBatch.from_arrays([part.column(i) for i in range(part.num_columns - 1)]
                                             + [pa.array([got.get(i, b"") for i in range(len(arrays))], pa.binary())],
                                             names=[*part.schema.names[:-1], "decoded"])
    fields = ", ".join([f"`{k}` {types[k]}" for k in keys] + ["decoded binary"])
    return encoded.select(*keys, F.col(ids).alias("__ids")).mapInArrow(run, fields)
