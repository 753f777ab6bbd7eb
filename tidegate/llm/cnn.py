"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters of width 4 slide over overlapping chunks that
cover the whole text, each filter's output is max-pooled within a chunk, chunk
maxima are pooled over the text (mean and maximum), and a logistic unit combines
them into one probability.

Inference multiplies embeddings and filters once into two tables over byte pairs,
so a position costs two gathers of one short row. Texts are scored chunk by
chunk; memory is bounded by a chunk, whatever the length of the text.

Training uses about ``FIT_ROWS`` labelled rows at most, outside the held-out fold, and
every byte of them. A step is one Spark aggregate: tasks run over the whole texts of
its batch and return one gradient of fixed size each; no text reaches the driver.

Defined cases. A null text is an empty one; an empty text is scored as one chunk
of padding. Null labels are ignored. With labels of one class only, the score is
their rate (smoothed). Null ids hash as empty text. Repeated rows score alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidegate.llm.common import bounded_sample, fold, text_slices
from tidegate.session import cut_lineage

FIT_ROWS = 2_000
BATCH, STEPS = 256, 150
PARTS = 8  # of the sample; a batch costs as many tasks
FOLDS = 5
CHUNK, WIDTH = 512, 4
FILTERS, DIMS = 16, 8
STEP = CHUNK - (WIDTH - 1)  # neighbouring chunks share the bytes of one window


class Network:
    """Weights: byte embeddings, filters, and the logistic unit over [mean, max] of chunk maxima."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.5, (257, DIMS)).astype(np.float32)  # byte 256 pads
        self.filters = rng.normal(0, 0.35, (WIDTH, DIMS, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = np.zeros(2 * FILTERS, np.float32)
        self.base = np.float32(0)

    def responses(self) -> np.ndarray:
        """Filter responses by window place and byte."""
        return np.einsum("bd,wdf->wbf", self.embed, self.filters)

    def tables(self) -> list[np.ndarray]:
        """Summed filter responses of every byte pair at window places (0, 1) and (2, 3)."""
        one = self.responses()
        return [(one[w][:, None, :] + one[w + 1][None, :, :]).reshape(257 * 257, FILTERS).astype(np.float32) for w in (0, 2)]


def chunks(text: bytes) -> np.ndarray:
    """Rows of CHUNK bytes as numbers, overlapping so that every window lies in a row; the last is padded."""
    raw = np.frombuffer(text, np.uint8)
    n = max(1, -(-(len(raw) - (WIDTH - 1)) // STEP))
    padded = np.full(n * STEP + WIDTH - 1, 256, np.int64)
    padded[:len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


def _maxima(rows: np.ndarray, one: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunk maxima of every filter, before the bias, and where they are; ``one`` holds responses by place and byte."""
    length = rows.shape[1] - WIDTH + 1
    response = one[0][rows[:, :length]]
    for w in range(1, WIDTH):
        response += one[w][rows[:, w:w + length]]
    at = response.argmax(axis=1)
    return np.take_along_axis(response, at[:, None, :], 1)[:, 0, :], at


def _score(text: bytes, net: Network, pair: list[np.ndarray]) -> float:
    rows = chunks(text)
    total, top = np.zeros(FILTERS, np.float64), np.full(FILTERS, -np.inf)
    for start in range(0, len(rows), 64):
        part = rows[start:start + 64]
        codes = part[:, :-1] * 257 + part[:, 1:]
        response = pair[0][codes[:, :-2]]
        response += pair[1][codes[:, 2:]]
        best = np.maximum(response.max(axis=1) + net.bias, 0)
        total += best.sum(axis=0)
        top = np.maximum(top, best.max(axis=0))
    pooled = np.concatenate([total / len(rows), top])
    return float(1 / (1 + np.exp(-np.clip(pooled @ net.out + net.base, -30, 30))))


NAMES = ("embed", "filters", "bias", "out", "base")


def gradient(net: Network, texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
    """Sum over the texts of the gradient of the log loss; it passes through the maxima to their windows."""
    one = net.responses()
    raws, sizes, seen = [], [], []
    held: list[np.ndarray] = []

    def flush():
        rows = np.concatenate(held)
        held.clear()
        raw, at = _maxima(rows, one)
        raws.append(raw)
        seen.append(np.stack([np.take_along_axis(rows, at + w, 1) for w in range(WIDTH)]).astype(np.int16))
    for text in texts:
        own = chunks(text)
        sizes.append(len(own))
        for start in range(0, len(own), 64):
            held.append(own[start:start + 64])
            if sum(map(len, held)) >= 64:
                flush()
    if held:
        flush()
    raw, windows = np.concatenate(raws), np.concatenate(seen, axis=1)
    count = np.array(sizes)
    doc = np.repeat(np.arange(len(count)), count)
    edge = np.concatenate([[0], np.cumsum(count)[:-1]])
    act = np.maximum(raw + net.bias, 0)
    mean = np.add.reduceat(act, edge) / count[:, None]
    top = np.maximum.reduceat(act, edge)
    pooled = np.concatenate([mean, top], axis=1)
    p = 1 / (1 + np.exp(-(pooled @ net.out + net.base)))
    err = p - labels
    down = err[:, None] * net.out
    d_act = down[doc, :FILTERS] / count[doc, None] + down[doc, FILTERS:] * (act == top[doc])
    d_act *= act > 0
    grads = {"out": pooled.T @ err, "base": err.sum(), "bias": d_act.sum(axis=0),
             "filters": np.zeros(net.filters.shape), "embed": np.zeros(net.embed.shape)}
    for w in range(WIDTH):  # the byte at place w of each filter's best window
        by_byte = np.bincount((windows[w].astype(np.int64) * FILTERS + np.arange(FILTERS)).ravel(), d_act.ravel(), 257 * FILTERS).reshape(257, FILTERS)
        grads["filters"][w] = net.embed.T @ by_byte
        grads["embed"] += by_byte @ net.filters[w].T
    return grads


def _descend(batches, rate_of_ones: float, n: int, *, rate: float, seed: int) -> Network:
    """Adam over ``batches``, functions from a network to (rows, gradient sum)."""
    net = Network(seed)
    if rate_of_ones in (0.0, 1.0):  # one class only
        p = (rate_of_ones * n + 1) / (n + 2)
        net.base = np.float32(np.log(p / (1 - p)))
        return net
    first = {k: np.zeros_like(getattr(net, k)) for k in NAMES}
    second = {k: np.zeros_like(getattr(net, k)) for k in NAMES}
    net.base = np.float32(np.log(rate_of_ones / (1 - rate_of_ones)))
    net.out = np.random.default_rng(seed).normal(0, 0.1, 2 * FILTERS).astype(np.float32)
    step = 0
    for batch in batches:
        rows, total = batch(net)
        if not rows:
            continue
        step += 1
        for k in NAMES:
            grad = total[k] / rows + (1e-4 * net.out if k == "out" else 0)
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad ** 2
            move = rate / 3 * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-7)
            setattr(net, k, (getattr(net, k) - move).astype(np.float32))
    return net


def train(texts: list[bytes], labels: np.ndarray, *, epochs: int = 10, rate: float = 0.03, seed: int = 7) -> Network:
    """A network fitted to texts at hand, in batches of 32."""
    rng = np.random.default_rng(seed)

    def batches():
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for start in range(0, len(order), 32):
                at = order[start:start + 32]
                yield lambda net, at=at: (len(at), gradient(net, [texts[i] for i in at], labels[at]))
    return _descend(batches(), float(labels.mean()), len(labels), rate=rate, seed=seed)


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
        rows: int = FIT_ROWS, steps: int = STEPS, rate: float = 0.06, seed: int = 7) -> Network:
    """Train on the whole texts of a bounded sample of the labelled rows outside the held-out fold."""
    known = labels.select(F.col(key), F.col(label).cast("double").alias("__label")) \
        .filter(F.col("__label").isNotNull() & F.col(key).isNotNull() & (fold(F.col(key), FOLDS) != 0))
    sample = bounded_sample(known, key, rows)
    texts = docs.select(F.col(key), F.col(text).cast("binary").alias("text")).join(F.broadcast(sample), key) \
        .select(F.xxhash64(F.col(key), "text").alias("k"), F.col("__label").alias("label"), "text")
    # However many parts the shuffle made, a step reads PARTS of them: it costs a task each.
    held = cut_lineage(texts.repartition(PARTS, "k").sortWithinPartitions("k", "label")).coalesce(PARTS)
    n, ones = held.agg(F.count("*"), F.coalesce(F.avg("label"), F.lit(1.0))).first()
    groups = -(-n // BATCH)

    def batches():
        for step in range(steps if n else 0):
            part = held.filter(F.pmod("k", F.lit(groups)) == step % groups) if groups > 1 else held
            yield lambda net, part=part: _total(part, net)
    return _descend(batches(), float(ones), max(n, 1), rate=rate, seed=seed)


def _total(rows: DataFrame, net: Network) -> tuple[int, dict[str, np.ndarray]]:
    """Rows and sum of their gradients: one vector from every task."""
    def run(batches):
        n, total = 0, np.zeros(sum(np.size(getattr(net, k)) for k in NAMES))
        for part, texts in text_slices(batches, "text", 1 << 20):
            own = gradient(net, [t or b"" for t in texts], part.column(0).to_numpy())
            total += np.concatenate([np.ravel(own[k]) for k in NAMES])
            n += len(texts)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total], pa.list_(pa.float64()))], names=["n", "total"])
    got = rows.select("label", "text").mapInArrow(run, "n long, total array<double>").collect()
    out, at = {}, 0
    total = np.sum([r["total"] for r in got], axis=0) if got else np.zeros(0)
    for k in NAMES if got else ():
        shape = np.shape(getattr(net, k))
        size = int(np.prod(shape))
        out[k] = total[at:at + size].reshape(shape)
        at += size
    return sum(r["n"] for r in got), out


def score(docs: DataFrame, net: Network, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row."""
    def run(batches):
        pair = net.tables()
        for part, texts in text_slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([_score(t or b"", net, pair) for t in texts], pa.float64())],
                                             names=[key, "score"])
    kind = dict(docs.dtypes)[key]
    return docs.select(key, F.col(text).cast("binary").alias("text")).mapInArrow(run, f"`{key}` {kind}, score double")
