"""Exact substring deduplication by distributed prefix doubling.

Every repeat of at least ``length`` bytes after its first place is removed.
Positions are ranked by growing prefixes, Spark sorts (rank, position) pairs,
and what is unique at one prefix length does not enter the next:

1. *Sampled positions, rank of a short prefix.* Sorting all byte positions
   would shuffle twenty times the text. A window of ``length`` bytes is
   therefore represented by one position inside it, chosen by content alone:
   the smallest hash of a ``gram``-byte prefix (the leftmost one of equals).
   Equal windows choose the same offset, so only windows whose chosen
   positions have equal ranks can be equal. Neighbouring windows mostly choose
   the same position and travel as one *run*.
2. *Rank at the doubled offset.* Runs sorted by (rank, rank of the whole run):
   a run equal to an earlier one is a repeat in full; a rank with a single run
   is unique and done.
3. *Past the threshold.* Runs that share the short rank but differ as a whole
   are ranked once more at ``length`` bytes, window by window.

Ranks are 64-bit polynomial hashes computed from prefix sums, so a rank at any
offset costs two look-ups and no self-join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearframe.llm.common import materialize, row_key, shuffle_width, slices

LENGTH = 100
GRAM = 24
#: Bytes of text ranked at once: array temporaries are some eighty times that.
SLICE = 1 << 19
NO_ID = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


class Ranks:
    """Prefix sums of one buffer: the rank of any of its substrings."""

    _up = np.ones(1, np.uint64)
    _down = np.ones(1, np.uint64)

    @classmethod
    def _powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls._up) < n:
            n = max(n, 2 * len(cls._up))
            inverse = pow(_BASE, -1, 1 << 64)
            for name, base in (("_up", _BASE), ("_down", inverse)):
                steps = np.full(n, base & _MASK, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))
        return cls._up[:n], cls._down[:n]

    def __init__(self, data: np.ndarray):
        up, self.down = self._powers(len(data) + 1)
        self.sums = np.empty(len(data) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(_BYTES[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return _mix((self.sums[width:] - self.sums[:n]) * self.down[:n])


def _chosen(grams: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest gram rank in each window of ``width`` grams."""
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if width > span:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    return (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


def runs_of(data: np.ndarray, bounds: np.ndarray, length: int, gram: int):
    """Runs of a buffer of documents (``bounds`` are their ends): document
    index, first window, number of windows, offset of the chosen gram in the
    first window; and the ranks of the chosen gram and of the run as a whole."""
    ranks = Ranks(data)
    starts = np.concatenate([[0], bounds[:-1]])
    sizes = bounds - starts
    if len(data) < length:
        return np.empty((0, 4), np.int64), np.empty((0, 2), np.uint64)
    grams = ranks.all(gram)
    at = _chosen(grams, length - gram + 1)
    ends = np.repeat(bounds, sizes)[: len(at)]
    places = np.arange(len(at))
    places = places[places + length <= ends]
    chosen = at[places]
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]])) if len(places) else np.empty(0, np.int64)
    last = np.concatenate([first[1:], [len(places)]]) - 1 if len(first) else first
    i0, i1, anchor = places[first], places[last], chosen[first]
    doc = np.searchsorted(bounds, i0, side="right")
    shape = ((anchor - i0).astype(np.uint64) << np.uint64(32)) | (i1 - i0).astype(np.uint64)
    whole = _mix(ranks.of(i0, i1 + length) + _mix(shape))
    return np.stack([doc, i0 - starts[doc], i1 - i0 + 1, anchor - i0], axis=1), np.stack([grams[anchor], whole], axis=1)


#: Windows per block of the last ranking.
BLOCK = 8
_PLACE = "oid long, row_key long, a long, b long"


def _texts(batch: pa.RecordBatch, column: int, s: int, e: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``s:e`` of a text column as one byte buffer and the rows' ends."""
    # ``replace`` keeps lone surrogates from failing; UTF-8 otherwise
    parts = [(t.as_py() or "").encode("utf-8", "replace") for t in batch.column(column)[s:e]]
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts], dtype=np.int64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _columns(names: str, *arrays: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_signed(x) if x.dtype == np.uint64 else pa.array(x.astype(np.int64)) for x in arrays], names=names.split())


def _scan_runs(length: int, gram: int):
    """Texts -> runs ``(kh, ch, oid, row_key, a, b)`` with a = first window and
    b = offset of the chosen position * 256 + windows; repeats that a slice
    shows by itself leave as merged spans (b = -end) and take no part in the
    sort, which also combines large groups of copies before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            oid, key = batch.column("oid").to_numpy(), batch.column("row_key").to_numpy()
            for s, e in slices(batch, "text", SLICE):
                order = s + np.lexsort((key[s:e], oid[s:e]))
                data, bounds = _texts(batch.take(pa.array(order)), batch.schema.get_field_index("text"), 0, e - s)
                runs, ranks = runs_of(data, bounds, length, gram)
                if not len(runs):
                    continue
                doc, first, n, place = runs.T
                # documents are in order here, so the first of equal runs is the earliest
                _, lead = np.unique(ranks[:, 0] + _mix(ranks[:, 1]), return_inverse=True)
                seen = np.full(lead.max() + 1, len(lead))
                np.minimum.at(seen, lead, np.arange(len(lead)))
                lead = seen[lead]
                own = lead == np.arange(len(lead))
                rows = order[doc]
                again = ~own & ((oid[rows] != oid[rows[lead]]) | (key[rows] != key[rows[lead]]) | (first != first[lead]))
                yield _columns("kh ch oid row_key a b", ranks[own, 0], ranks[own, 1], oid[rows[own]], key[rows[own]], first[own], (place * 256 + n)[own])
                if again.any():
                    d, a, b = doc[again], first[again], first[again] + n[again] - 1 + length
                    head = np.concatenate([[True], (d[1:] != d[:-1]) | (a[1:] > b[:-1])])
                    d0, a0 = d[head], a[head]
                    b0 = np.maximum.reduceat(b, np.flatnonzero(head))
                    spread = _mix(_mix(a0.astype(np.uint64)) + key[order[d0]].view(np.uint64))
                    yield _columns("kh ch oid row_key a b", spread, spread, oid[order[d0]], key[order[d0]], a0, -b0)

    return run


def _sorted_runs(length: int):
    """Runs sorted by (kh, ch, place) -> spans of repeated runs (b = -end), and
    the first run of each content whose short rank has several contents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # first run of the current content; whether it has left; whether its rank has several contents
        for batch in batches:
            cols = [c.to_numpy() for c in batch.columns]
            span = cols[5] < 0
            if span.any():
                yield _columns("oid row_key a b", *(c[span] for c in cols[2:]))
                cols = [c[~span] for c in cols]
            if not len(cols[0]):
                continue
            gone = several = False
            if held is not None:
                row, gone, several = held
                cols = [np.concatenate([[v], c]) for v, c in zip(row, cols, strict=True)]
            kh, ch, oid, key, a, b = cols
            idx = np.arange(len(kh))
            new_k = np.concatenate([[True], kh[1:] != kh[:-1]])
            new_c = new_k | np.concatenate([[True], ch[1:] != ch[:-1]])
            lead = np.maximum.accumulate(np.where(new_c, idx, 0))
            again = ~new_c & ((oid != oid[lead]) | (key != key[lead]) | (a != a[lead]))
            group = np.cumsum(new_k) - 1
            many = np.bincount(group[new_c]) >= 2
            # the held run may be the tail of a group whose several contents have passed
            many[0] |= several
            cand = new_c & many[group]
            cand[0] &= not gone
            if again.any():
                yield _columns("oid row_key a b", oid[again], key[again], a[again], -(a[again] + b[again] % 256 - 1 + length))
            if cand.any():
                yield _columns("oid row_key a b", oid[cand], key[cand], a[cand], b[cand])
            last = lead[-1]
            held = ([c[last] for c in cols], bool(many[group[-1]]), bool(many[group[-1]]))

    return run


def _scan_blocks(length: int):
    """Texts with candidate runs -> blocks of up to ``BLOCK`` windows: rank of
    the bytes they share, and the few bytes on either side of those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            oid, key = batch.column("oid").to_numpy(), batch.column("row_key").to_numpy()
            for s, e in slices(batch, "text", SLICE):
                data, bounds = _texts(batch, batch.schema.get_field_index("text"), s, e)
                starts = np.concatenate([[0], bounds[:-1]])
                ranks = Ranks(data)
                lists = [x.values for x in batch.column("runs")[s:e]]
                doc = np.repeat(np.arange(e - s), [len(x) for x in lists])
                a = np.concatenate([x.field("a").to_numpy() for x in lists])
                b = np.concatenate([x.field("b").to_numpy() for x in lists])
                high, n = b // 256, b % 256
                low = high - n + 1
                q0, q1 = low // BLOCK, high // BLOCK
                rep = np.repeat(np.arange(len(a)), q1 - q0 + 1)
                q = q0[rep] + np.arange(len(rep)) - np.repeat(np.cumsum(q1 - q0 + 1) - (q1 - q0 + 1), q1 - q0 + 1)
                t0 = np.maximum(low[rep] - q * BLOCK, 0)
                t1 = np.minimum(high[rep] - q * BLOCK, BLOCK - 1)
                d = doc[rep]
                core = starts[d] + a[rep] + high[rep] - q * BLOCK
                end = core + length - (BLOCK - 1)
                rank = _mix(ranks.of(core, end) + _mix(q.astype(np.uint64) + np.uint64(1)))
                padded = np.concatenate([np.zeros(BLOCK, np.uint8), data, np.zeros(BLOCK, np.uint8)])
                left, right = np.zeros(len(core), np.uint64), np.zeros(len(core), np.uint64)
                for i in range(BLOCK - 1):
                    left |= padded[BLOCK + core - 1 - i].astype(np.uint64) << np.uint64(8 * i)
                    right |= padded[BLOCK + end + i].astype(np.uint64) << np.uint64(8 * i)
                left |= t0.astype(np.uint64) << np.uint64(56)
                right |= t1.astype(np.uint64) << np.uint64(56)
                rows = s + d
                yield _columns("core l r oid row_key at", rank, left, right, oid[rows], key[rows], core - starts[d])

    return run


def _sorted_blocks(length: int):
    """Blocks sorted by (core, place) -> spans of windows that occur earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_core, held = None, np.empty(0, np.uint64)
        low = np.array([(1 << (8 * i)) - 1 for i in range(BLOCK)], np.uint64)
        for batch in batches:
            core, left, right, oid, key, at = (c.to_numpy() for c in batch.columns)
            core, left, right = core.view(np.uint64), left.view(np.uint64), right.view(np.uint64)
            if not len(core):
                continue
            t0, t1 = (left >> np.uint64(56)).astype(np.int64), (right >> np.uint64(56)).astype(np.int64)
            row = np.repeat(np.arange(len(core)), t1 - t0 + 1)
            t = t0[row] + np.arange(len(row)) - np.repeat(np.cumsum(t1 - t0 + 1) - (t1 - t0 + 1), t1 - t0 + 1)
            rank = _mix(core[row] + _mix((left[row] & low[t]) + np.uint64(_BASE) * t.astype(np.uint64)))
            rank = _mix(rank + (right[row] & low[BLOCK - 1 - t]))
            _, back = np.unique(rank, return_inverse=True)
            lead = np.full(back.max() + 1, len(back))
            np.minimum.at(lead, back, np.arange(len(back)))
            again = lead[back] != np.arange(len(back))
            if held_core == core[0]:
                again |= np.isin(rank, held)
            tail = core[row] == core[-1]
            held = np.union1d(held, rank[tail]) if held_core == core[-1] else np.unique(rank[tail])
            held_core = core[-1]
            if again.any():
                row, t = row[again], t[again]
                head = np.concatenate([[True], (row[1:] != row[:-1]) | (t[1:] != t[:-1] + 1)])
                tail_ = np.concatenate([head[1:], [True]])
                r = row[head]
                yield _columns("oid row_key a b", oid[r], key[r], at[r] - t[tail_], -(at[r] - t[head] + length))

    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the spans of each text and cut them out."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        kept, spans, sizes, gone = [], [], [], []
        for text, found in zip(batch.column("text"), batch.column("runs"), strict=True):
            data = (text.as_py() or "").encode("utf-8", "replace")
            merged: list[list[int]] = []
            if found.is_valid and len(found.values):
                a, b = found.values.field("a").to_numpy(), -found.values.field("b").to_numpy()
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order])
                head = np.concatenate([[True], a[1:] > b[:-1]])
                merged = list(zip(a[head].tolist(), b[np.concatenate([head[1:], [True]])].tolist(), strict=True))
            parts, at = [], 0
            for s, e in merged:
                parts.append(data[at:s])
                at = e
            parts.append(data[at:])
            kept.append(b"".join(parts))
            spans.append([{"start": s, "end": e} for s, e in merged])
            sizes.append(len(data))
            gone.append(sum(e - s for s, e in merged))
        yield pa.RecordBatch.from_arrays(
            [batch.column("oid"), batch.column("has_id"), batch.column("n"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
            names=["oid", "has_id", "n", "n_bytes", "n_removed", "spans", "kept"],
        )


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts
    earlier (smaller id, or same document and smaller start); strings never
    cross documents and are judged on the input.

    Returns ``doc_id, n_bytes, n_removed, spans (array of start, end), kept``
    (binary: the remaining bytes), one row per input row.

    Defined results: null text is empty; texts shorter than ``length`` lose
    nothing; null ids come last, ties of ids are ordered by a digest of the
    row; of rows equal in every column the first stays and the others lose
    everything (if long enough); an empty table gives an empty result. Other
    columns only enter the row digest, whatever their names.

    One text may be as long as a task can hold; all else streams.
    """
    if not (BLOCK < gram < length and length - gram + 1 < 256):
        raise ValueError("gram must lie between the block size and the length, less than 255 below it")
    spark = docs.sparkSession
    width = shuffle_width(spark)
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("oid"),
        row_key(docs).alias("row_key"),
        F.col(doc_id).isNotNull().alias("has_id"),
        F.col(text).cast("string").alias("text"),
    )
    runs = rows.select("oid", "row_key", "text").mapInArrow(_scan_runs(length, gram), "kh long, ch long, " + _PLACE)
    order = ["kh", "ch", "oid", "row_key", "a"]
    first = runs.repartition(width, "kh").sortWithinPartitions(*order).select(*order, "b").mapInArrow(_sorted_runs(length), _PLACE)
    first = materialize(first, "substr-runs")
    _sweep(spark)

    places = F.collect_list(F.struct("a", "b")).alias("runs")
    todo = first.where("b >= 0").groupBy("oid", "row_key").agg(places)
    # grouped by exactly the keys of the joins below, so that texts move once in each
    once = rows.groupBy("oid", "row_key").agg(F.first("has_id").alias("has_id"), F.first("text").alias("text"), F.count("*").alias("n"))
    some = once.join(todo, ["oid", "row_key"]).select("oid", "row_key", "text", "runs")
    blocks = some.mapInArrow(_scan_blocks(length), "core long, l long, r long, oid long, row_key long, at long")
    order = ["core", "oid", "row_key", "at"]
    second = blocks.repartition(width, "core").sortWithinPartitions(*order).select("core", "l", "r", "oid", "row_key", "at")
    second = materialize(second.mapInArrow(_sorted_blocks(length), _PLACE), "substr-blocks")
    _sweep(spark)

    spans = first.where("b < 0").unionByName(second).groupBy("oid", "row_key").agg(places)
    cut = once.join(spans, ["oid", "row_key"], "left").select("oid", "has_id", "n", "text", "runs")
    cut = cut.mapInArrow(_remove, "oid long, has_id boolean, n long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
    copy = cut.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    whole = (F.col("copy") > 1) & (F.col("n_bytes") >= length)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return copy.select(
        F.when(F.col("has_id"), F.col("oid")).alias("doc_id"),
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, everything).otherwise(F.col("spans")).alias("spans"),
        F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )


def _sweep(spark) -> None:
    """Let Spark drop shuffle files of finished steps: it does so when the
    driver's JVM collects its garbage, which on a driver at rest is late."""
    spark.sparkContext._jvm.System.gc()
