"""Quality classifier: random-indexing word vectors pooled per document, and a
two-layer network with temperature-calibrated probabilities.

Random indexing: every word slot has a fixed sparse random index vector; a
word's vector is the sum of the index vectors of its neighbours over the whole
corpus, so it comes out of one pass of additions. Words fall into a fixed
number of slots, which bounds the table that travels to every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearframe.llm.common import slices

SLOTS = 1 << 15
DIMS = 24
NONZERO = 4
WINDOW = 2
FEATURES = 3 * DIMS + 1

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes that belong to one token: letters and digits with everything above
#: ASCII, or other signs; "word###" is two tokens.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64))


def index_vectors(slots: int = SLOTS, dims: int = DIMS, nonzero: int = NONZERO) -> np.ndarray:
    """The random index vectors: ``nonzero`` entries of +1 or -1 each."""
    out = np.zeros((slots, dims), np.int8)
    rows = np.arange(slots)
    for i in range(nonzero):
        h = _mix(rows.astype(np.uint64) * np.uint64(nonzero) + np.uint64(i + 1))
        out[rows, (h % np.uint64(dims)).astype(np.int64)] = np.where(h >> np.uint64(63), 1, -1)
    return out


def token_slots(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of a buffer of texts (``bounds`` are their ends): slot and text
    index of each, in order."""
    kind = np.where(_SPACE[data], 0, np.where(_LETTER[data], 1, 2)).astype(np.int8)
    head = np.empty(len(data), bool)
    head[:1] = True
    head[1:] = kind[1:] != kind[:-1]
    head[bounds[:-1][bounds[:-1] < len(data)]] = True
    start = np.flatnonzero(head)
    end = np.concatenate([start[1:], [len(data)]])
    word = kind[start] != 0
    start, end = start[word], end[word]
    # a token's hash: sum of byte codes times odd powers of its inner positions
    inner = np.arange(len(data), dtype=np.uint64)
    inner -= np.repeat(np.flatnonzero(head).astype(np.uint64), np.diff(np.append(np.flatnonzero(head), len(data))))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[data] * (np.uint64(2) * _mix(inner) + np.uint64(1)))])
    slot = (_mix(sums[end] - sums[start]) % np.uint64(SLOTS)).astype(np.int32)
    return slot, np.searchsorted(bounds, start, side="right")


def _buffers(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for s, e in slices(batch, column):
        parts = [(t.as_py() or "").encode("utf-8", "replace") for t in batch.column(column)[s:e]]
        yield s, e, np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts], dtype=np.int64)


#: A text of more bytes is taken in parts of about this size, cut at white space.
LONG = 4 << 20


def _parts(data: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of one long text; a token never spans two of them."""
    start = 0
    while len(data) - start > LONG:
        gap = start + LONG
        while gap < len(data):
            space = np.flatnonzero(_SPACE[data[gap : gap + 4096]])
            if len(space):
                gap += int(space[0])
                break
            gap += 4096
        yield data[start:gap]
        start = min(gap, len(data))
    yield data[start:]


def _token_runs(data: np.ndarray, bounds: np.ndarray, carry: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Slots and text indexes of the tokens of a buffer, and how many of the first
    tokens came before: a long text comes in parts, each with the last ``carry``
    tokens of the part before it."""
    if len(bounds) > 1 or len(data) <= LONG:
        yield *token_slots(data, bounds), 0
        return
    old = np.zeros(0, np.int32)
    for part in _parts(data):
        slot = np.concatenate([old, token_slots(part, np.array([len(part)]))[0]])
        yield slot, np.zeros(len(slot), np.int64), len(old)
        old = slot[len(slot) - min(carry, len(slot)) :]


def _add_neighbours(slot: np.ndarray, doc: np.ndarray, old: int, index: np.ndarray, total: np.ndarray) -> None:
    """Add to ``total`` the index vectors of each token's neighbours; pairs of the
    first ``old`` tokens were added before."""
    if len(slot) < 2:
        return
    order = np.argsort(slot, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], slot[order][1:] != slot[order][:-1]]))
    near = np.zeros((len(slot), DIMS), np.int16)
    own = index[slot]
    for d in range(1, WINDOW + 1):
        same = ((doc[d:] == doc[:-d]) & (np.arange(d, len(doc)) >= old))[:, None]
        near[d:] += own[:-d] * same
        near[:-d] += own[d:] * same
    total[slot[order][heads]] += np.add.reduceat(near[order], heads, axis=0, dtype=np.int64)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Random-indexing vectors of all word slots over all documents: unit rows.

    Each task adds up one ``SLOTS x DIMS`` table and emits its non-zero rows;
    Spark adds the rows of a slot (partial sums first). The result has at most
    ``SLOTS`` rows whatever the corpus, and comes to the driver as one table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_vectors()
        total = np.zeros((SLOTS, DIMS), np.int64)
        for batch in batches:
            for _, _, data, bounds in _buffers(batch, "text"):
                for slot, doc, old in _token_runs(data, bounds, WINDOW):
                    _add_neighbours(slot, doc, old, index, total)
        rows = np.flatnonzero(total.any(axis=1))
        names = ["slot", *[f"d{i}" for i in range(DIMS)]]
        yield pa.RecordBatch.from_arrays([pa.array(rows), *[pa.array(total[rows, i]) for i in range(DIMS)]], names=names)

    schema = "slot long, " + ", ".join(f"d{i} long" for i in range(DIMS))
    partial = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
    rows = partial.groupBy("slot").agg(*[F.sum(f"d{i}").cast("double").alias(f"d{i}") for i in range(DIMS)]).toPandas()
    table = np.zeros((SLOTS, DIMS), np.float32)
    table[rows["slot"].to_numpy()] = rows.drop(columns="slot").to_numpy()
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return np.divide(table, norm, out=table, where=norm > 0)


def pooled(data: np.ndarray, bounds: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Pooled features of each text: mean, spread and mean product with the
    next token's vector, per dimension, and the log of the token count."""
    n = len(bounds)
    if n == 1 and len(data) > LONG:
        return _pooled_long(data, vectors)
    slot, doc = token_slots(data, bounds)
    out = np.zeros((n, FEATURES), np.float32)
    if len(slot):
        v = vectors[slot]
        head = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        count = np.diff(np.append(head, len(doc)))[:, None].astype(np.float32)
        who = doc[head]
        mean = np.add.reduceat(v, head, axis=0) / count
        square = np.add.reduceat(v * v, head, axis=0) / count
        step = np.zeros_like(v)
        step[:-1] = v[:-1] * v[1:] * (doc[1:] == doc[:-1])[:, None]
        out[who, :DIMS] = mean
        out[who, DIMS : 2 * DIMS] = np.sqrt(np.maximum(square - mean * mean, 0))
        out[who, 2 * DIMS : 3 * DIMS] = np.add.reduceat(step, head, axis=0) / np.maximum(count - 1, 1)
        out[who, -1] = np.log1p(count[:, 0])
    return out


def _pooled_long(data: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """``pooled`` of one long text: its sums are added up part by part."""
    total, square, step, count = np.zeros(DIMS), np.zeros(DIMS), np.zeros(DIMS), 0
    for slot, _, old in _token_runs(data, np.array([len(data)]), 1):
        v = vectors[slot]
        total += v[old:].sum(axis=0, dtype=np.float64)
        square += (v[old:] * v[old:]).sum(axis=0, dtype=np.float64)
        step += (v[:-1] * v[1:]).sum(axis=0, dtype=np.float64)
        count += len(slot) - old
    out = np.zeros((1, FEATURES), np.float32)
    if count:
        mean = total / count
        out[0, :DIMS] = mean
        out[0, DIMS : 2 * DIMS] = np.sqrt(np.maximum(square / count - mean * mean, 0))
        out[0, 2 * DIMS : 3 * DIMS] = step / max(count - 1, 1)
        out[0, -1] = np.log1p(count)
    return out


@dataclass
class Network:
    """Two layers: ``tanh`` hidden units, one logit, and a temperature."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(((x - self.shift) / self.scale) @ self.w1 + self.b1)
        return h @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.logits(x) / self.temperature, -60, 60)
        return 1 / (1 + np.exp(-z.astype(np.float64)))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 40, batch: int = 256, rate: float = 3e-3, decay: float = 1e-4, seed: int = 7) -> Network:
    """Train on four fifths of the rows (Adam, logistic loss) and set the
    temperature on the rest by minimising its loss."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    hold, use = order[: len(x) // 5], order[len(x) // 5 :]
    shift = x[use].mean(axis=0) if len(use) else np.zeros(x.shape[1])
    scale = x[use].std(axis=0) + 1e-3 if len(use) else np.ones(x.shape[1])
    xs = (x - shift) / scale
    p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 0.1, hidden), np.zeros(1)]
    m, v, t = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    for _ in range(epochs):
        for s in range(0, len(use), batch):
            i = use[s : s + batch] if s else (use := rng.permutation(use))[:batch]
            h = np.tanh(xs[i] @ p[0] + p[1])
            err = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3][0], -60, 60))) - y[i]) / len(i)
            back = np.outer(err, p[2]) * (1 - h * h)
            grads = [xs[i].T @ back + decay * p[0], back.sum(axis=0), h.T @ err + decay * p[2], np.array([err.sum()])]
            t += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    net = Network(shift, scale, p[0], p[1], p[2], float(p[3][0]))
    if len(hold) >= 20 and 0 < y[hold].mean() < 1:
        z, target = net.logits(x[hold]), y[hold]
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        loss = [np.mean(np.logaddexp(0, np.clip(z / c, -500, 500)) - target * z / c) for c in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_quality(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, text: str = "text", doc_id: str = "doc_id", label: str = "quality", max_rows: int = 20_000) -> Network:
    """Fit on at most about ``max_rows`` labelled documents (a documented bound;
    which ones is decided by a hash of the id). Only ids whose
    ``crc32(text of id) mod 4`` is not 2 are learnt from; an id with several
    different labels, or none, is left out. Without a usable label every text
    scores one half."""
    marked = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
    marked = marked.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top").where(~held_out("id"))
    n = marked.count()
    if n > max_rows:
        cut = int(max_rows / n * (1 << 31))
        marked = marked.where(F.pmod(F.xxhash64("id"), F.lit(1 << 31)) < cut)
    chosen = marked.select("id", "y").toPandas()  # about max_rows ids
    if not len(chosen):
        return Network(np.zeros(FEATURES), np.ones(FEATURES), np.zeros((FEATURES, 1)), np.zeros(1), np.zeros(1), 0.0)
    small = docs.sparkSession.createDataFrame(chosen)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, e, data, bounds in _buffers(b, "text"):
                x = pooled(data, bounds, shared.value)
                yield pa.RecordBatch.from_arrays([b.column("id")[s:e], b.column("y")[s:e].cast(pa.int32()), pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "y", "x"])

    ids = docs.select(F.col(doc_id).cast(marked.schema["id"].dataType).alias("id"), F.col(text).cast("string").alias("text"))
    # the broadcast side has about max_rows short rows
    rows = ids.join(F.broadcast(small.withColumn("y", F.col("y").cast("int"))), "id").mapInArrow(run, "id long, y int, x binary")
    # a repeated id counts once, whatever the number of its rows
    fit = rows.groupBy("id").agg(F.min("y").alias("y"), F.min("x").alias("x")).toPandas().sort_values("id")
    if not len(fit):
        return train_quality(docs, labels.limit(0), vectors, text, doc_id, label, max_rows)
    x = np.stack([np.frombuffer(r, np.float32) for r in fit["x"]]).astype(np.float64)
    return fit_network(x, fit["y"].to_numpy().astype(np.float64))


def score_udf(docs: DataFrame, vectors: np.ndarray, net: Network):
    """A column function: whole text -> calibrated probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast((vectors, net))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        table, model = shared.value
        out = np.empty(len(texts))
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string(), from_pandas=True)], names=["text"])
        for s, e, data, bounds in _buffers(batch, "text"):
            out[s:e] = model.scores(pooled(data, bounds, table))
        return pd.Series(out)

    return score


def with_quality(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", name: str = "score", max_rows: int = 20_000) -> DataFrame:
    """``docs`` with a column ``name``: probability that the label is 1.

    Scores depend on the text alone. Defined results: null and empty text
    score as a document without tokens; equal texts score equally; null ids
    and ids without a label are scored and not learnt from; an empty table
    gives an empty result; other columns stay as they are.
    """
    vectors = word_vectors(docs, text)
    net = train_quality(docs, labels, vectors, text, doc_id, label, max_rows)
    return docs.withColumn(name, score_udf(docs, vectors, net)(F.col(text).cast("string")))
