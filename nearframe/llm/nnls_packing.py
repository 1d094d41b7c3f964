"""Packing by non-negative least squares over the histogram of piece lengths.

Documents become token ids in one pass, in pieces of at most ``size``. Only a
histogram of at most ``size / STEP`` bins reaches the driver. There all length
combinations of up to three bins that fill a window are enumerated, a
non-negative least-squares fit says how often to repeat each, and the counts are
rounded down. Pieces are numbered within their bin (a running number per task
plus a prefix sum over tasks), and the number alone names the piece's sequence
and slot. What the combinations leave over is packed greedily in the task that
reads it, cutting a document where a window ends.
"""

from __future__ import annotations

import itertools
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearframe.llm.common import materialize, slices

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: Lengths are counted in steps of this many tokens (rounded up).
STEP = 8
#: Cached white-space-delimited words of one task, and the longest that is kept.
CACHE, LONGEST = 500_000, 64
#: Longer texts are taken in parts that end before white space.
PART = 1 << 20
GAP = re.compile(r"[\t-\r ]")
AFTER_LETTER = re.compile(rb"(?<=[a-z])(?=[.,])")
AFTER_OTHER = re.compile(rb"[.,](?:(?<=[^a-z0-9\x80-\xbf][.,])|(?<=[^\xc3][\x80-\xbf][.,])|(?<=\xc3[\x97\xb7][.,])|(?<!..))", re.DOTALL)
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
#: A last window with at most this much room is padded instead of cut.
ROOM = 32


class WordIds(dict):
    """Token ids of texts as little-endian 32-bit bytes; a dict of words.

    No token of this vocabulary holds white space, its normalization works word
    by word and lower-cases, and a letter and a following stop or comma never
    share a token. So a text's ids are those of its words in a row, and each
    distinct word is encoded once and kept. A word of lower-case Latin-1 letters
    is already normalized and one pre-token, and goes straight to the merges.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.encoder = Tokenizer.from_file(path)
        self.merge = self.encoder.model.tokenize
        # byte-level stand-ins: printable bytes as they are, the rest from U+0100 on
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = iter(range(0x100, 0x200))
        self.stand_in = {b: b if b in printable else next(rest) for b in range(256)}

    def __missing__(self, word: bytes) -> bytes:
        if PLAIN.fullmatch(word):
            ids = [t.id for t in self.merge(word.decode("latin-1").translate(self.stand_in))]
        else:
            ids = self.encoder.encode_batch_fast([word.decode()], add_special_tokens=False)[0].ids
        body = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= LONGEST:
            self[word] = body
        return body

    def ids(self, text: str | None) -> bytes:
        text = text or ""
        if len(text) <= PART:
            return self._ids(text)
        out, start = [], 0
        while start < len(text):
            gap = GAP.search(text, start + PART)
            end = gap.start() if gap else len(text)
            out.append(self._ids(text[start:end]))
            start = end
        return b"".join(out)

    def _ids(self, text: str) -> bytes:
        raw = text.encode("utf-8", "replace")
        if not (b"<|" in raw or b"\xcc" in raw or b"\xcd" in raw):
            # special tokens are found, and accents joined, before lower-casing
            raw = raw.lower()
            # where each stop and comma follows a letter or digit, plain replacement will do
            raw = AFTER_LETTER.sub(b" ", raw) if AFTER_OTHER.search(raw) else raw.replace(b".", b" .").replace(b",", b" ,")
        if len(self) > CACHE:
            self.clear()
        return b"".join(map(self.__getitem__, raw.split()))


def combinations(units: int) -> np.ndarray:
    """All ways to fill ``units`` with one to three bins, largest first; unused
    slots are 0."""
    rows = [(units, 0, 0)]
    rows += [(a, units - a, 0) for a in range((units + 1) // 2, units)]
    rows += [(a, b, units - a - b) for a in range(1, units - 1) for b in range(1, min(a, units - a - 1) + 1) if 1 <= units - a - b <= b]
    return np.array(rows, np.int64)


def nnls(columns: np.ndarray, target: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """``min |A x - target|, x >= 0`` by an active set; column j of A has a one
    for every non-zero entry of ``columns[j]`` in that row (1-based)."""
    m, n = len(target), len(columns)
    dense = np.zeros((m + 1, n))
    np.add.at(dense, (columns.ravel(), np.repeat(np.arange(n), columns.shape[1])), 1.0)
    a = dense[1:]
    x = np.zeros(n)
    scale = max(float(target.max(initial=0.0)), 1e-300)
    b = target / scale
    passive = np.zeros(n, bool)
    for _ in range(rounds):
        grad = a.T @ (b - a @ x)
        grad[passive] = -np.inf
        best = int(np.argmax(grad))
        if grad[best] <= 1e-7:
            break
        passive[best] = True
        while True:
            at = np.flatnonzero(passive)
            p = a[:, at]
            s = np.linalg.solve(p.T @ p + 1e-11 * np.eye(len(at)), p.T @ b)
            if (s > 0).all():
                x[:] = 0
                x[at] = s
                break
            low = s <= 0
            ratio = x[at][low] / np.maximum(x[at][low] - s[low], 1e-300)
            x[at] += ratio.min() * (s - x[at])
            drop = at[(x[at] <= 1e-12) & low]
            x[drop] = 0
            passive[drop] = False
    return x * scale


def repeats(histogram: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray]:
    """Combinations and how often to use each: the fit rounded down, and never
    more of a bin than there is."""
    ways = combinations(units)
    fit = np.floor(nnls(ways, histogram.astype(float)) + 1e-6).astype(np.int64)
    left = np.concatenate([[0], histogram]).astype(np.int64)
    used = []
    for s in np.argsort(-fit, kind="stable"):
        if not fit[s]:
            break
        bins, need = np.unique(ways[s][ways[s] > 0], return_counts=True)
        n = min(int(fit[s]), int((left[bins] // need).min()))
        if n:
            left[bins] -= n * need
            used.append((s, n))
    return ways[[s for s, _ in used]].reshape(-1, 3), np.array([n for _, n in used], np.int64)


PIECE = "slice long, bin int, nth long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long"
DONE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _pieces(docs: DataFrame, size: int, end: int, vocabulary: str) -> DataFrame:
    """Documents cut into windows of ``size`` and a rest. A full window is a
    sequence by itself; a rest has a bin and its number among the task's rests
    of that bin."""
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, part = WordIds(vocabulary), TaskContext.get().partitionId()
        full, nth = 0, [0] * (size // STEP + 2)
        for b in batches:
            for lo, hi in slices(b, "text"):
                rows = []
                for who, text in zip(b.column(0).slice(lo, hi - lo).to_pylist(), b.column(1).slice(lo, hi - lo), strict=True):
                    ids = words.ids(text.as_py()) + tail
                    n = len(ids) // 4
                    for s in range(0, n, size):
                        length = min(size, n - s)
                        body = ids[4 * s : 4 * (s + length)]
                        if length == size:
                            where = (None, 0, 4 * ((part << 31) + full))
                            full += 1
                        else:
                            k = -(-length // STEP)
                            where = (k, nth[k], None)
                            nth[k] += 1
                        # ids of a whole window are not needed again
                        rows.append((part, where[0], where[1], who, s, length, zlib.crc32(body), n, where[2], body))
                if rows:
                    yield _batch(rows, PIECE + ", ids binary")

    return docs.mapInArrow(run, PIECE + ", ids binary")


def _cut_greedily(rest: DataFrame, size: int, keep_ids: bool) -> DataFrame:
    """Left-over pieces laid end to end and cut where a window ends. The last
    window of a task is cut at the binary digits of its length, since sequences
    whose length is a power of two need no padding."""
    schema = DONE + (", ids binary" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 31, 0
        held: list[tuple] = []  # (doc_id, start, doc_tokens, ids) of the open window
        filled = 0

        def emit(pieces: list[tuple]) -> list[tuple]:
            nonlocal made
            rows, at = [], 0
            for who, start, total, ids in pieces:
                n = len(ids) // 4
                row = (who, start, n, zlib.crc32(ids), total, 4 * (base + made) + 2, at)
                rows.append((*row, ids) if keep_ids else row)
                at += n
            made += 1
            return rows

        def cut(pieces: list[tuple], n: int) -> tuple[list[tuple], list[tuple]]:
            first, i = [], 0
            while n and i < len(pieces):
                who, start, total, ids = pieces[i]
                have = len(ids) // 4
                if have > n:
                    first.append((who, start, total, ids[: 4 * n]))
                    return first, [(who, start + n, total, ids[4 * n :]), *pieces[i + 1 :]]
                first.append(pieces[i])
                n -= have
                i += 1
            return first, pieces[i:]

        for b in batches:
            rows = []
            for who, start, total, ids in zip(*(b.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")), strict=True):
                held.append((who, start, total, ids))
                filled += len(ids) // 4
                if filled >= size:
                    whole, held = cut(held, size)
                    rows += emit(whole)
                    filled -= size
            if rows:
                yield _batch(rows, schema)
        rows = []
        if filled + ROOM >= size:
            rows += emit(held)
            filled = 0
        while filled:
            n = 1 << (filled.bit_length() - 1)
            first, held = cut(held, n)
            rows += emit(first)
            filled -= n
        if rows:
            yield _batch(rows, schema)

    return rest.select("doc_id", "start", "doc_tokens", "ids").mapInArrow(run, schema)


def pack_by_lengths(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 2048, end: int = 1, vocabulary: str = VOCABULARY, keep_ids: bool = False
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` (and ``ids``, little-endian 32-bit, on request).

    A document is its ids and the id ``end``; its pieces cover them without gap
    or overlap. The pieces of a sequence lie from 0 without gap. A sequence holds
    at most ``size`` ids and is meant to be padded to ``size`` unless its length
    is a power of two.

    Defined results: null and empty text are the id ``end`` alone; texts of any
    length are cut into windows; rows that repeat or share an id are packed once
    each; a null id stays null; an empty table gives an empty result; other
    columns are ignored. Equal input in equal partitions gives equal sequences.
    """
    if size % STEP:
        raise ValueError(f"size must be a multiple of {STEP}")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    pieces = materialize(_pieces(rows, size, end, vocabulary), "nnls-pieces")
    extra = ["ids"] if keep_ids else []

    # the histogram: per task and bin, and over all
    counts = materialize(pieces.where("bin is not null").groupBy("bin", "slice").agg(F.count("*").alias("n")), "nnls-counts")
    units = size // STEP
    histogram = np.zeros(units, np.int64)
    for r in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect():
        histogram[r["bin"] - 1] = r["n"]
    ways, times = repeats(histogram, units)

    # for each bin the runs of pieces that go to one slot of one combination
    first_sequence = np.concatenate([[0], np.cumsum(times)])
    runs: dict[int, list[tuple[int, int, int]]] = {}
    taken = np.zeros(units + 1, np.int64)
    for s, way in enumerate(ways):
        for slot, bin_ in enumerate(int(x) for x in way):
            if bin_:
                runs.setdefault(bin_, []).append((int(taken[bin_]), int(first_sequence[s]), slot))
                taken[bin_] += times[s]

    before = Window.partitionBy("bin").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bin", "slice", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    # where the pieces that combinations use end: one (slice, number) per bin
    demand = F.create_map(*itertools.chain.from_iterable((F.lit(b), F.lit(int(taken[b]))) for b in range(1, units + 1)))
    last = offsets.withColumn("want", demand[F.col("bin")]).where("first <= want and want < first + n").select("bin", "slice", (F.col("want") - F.col("first")).alias("cut")).collect()
    # a bin without such a row is used to the last piece
    end_of = {r["bin"]: (r["slice"], r["cut"]) for r in last}
    never = (1 << 62, 0)
    by_bin = [end_of.get(b, never) for b in range(units + 1)]
    at = F.element_at(F.array(*[F.struct(F.lit(s).cast("long").alias("s"), F.lit(c).cast("long").alias("c")) for s, c in by_bin]), F.col("bin") + 1)
    used = (F.col("slice") < at["s"]) | ((F.col("slice") == at["s"]) & (F.col("nth") < at["c"]))

    rests = pieces.where("bin is not null")
    placed = rests.where(used).drop("sequence_id")
    if not keep_ids:
        placed = placed.drop("ids")
    numbered = placed.join(offsets.select("bin", "slice", "first"), ["bin", "slice"]).withColumn("nth", F.col("first") + F.col("nth")).drop("first", "slice")
    starts = {b: np.array([x[0] for x in r], np.int64) for b, r in runs.items()}
    heads = {b: np.array([x[1] for x in r], np.int64) for b, r in runs.items()}
    slots = {b: np.array([x[2] for x in r], np.int64) for b, r in runs.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins, nth = b.column("bin").to_numpy(), b.column("nth").to_numpy()
            sequence, slot = np.empty(len(bins), np.int64), np.empty(len(bins), np.int64)
            for k in np.unique(bins).tolist():
                here = np.flatnonzero(bins == k)
                run = np.searchsorted(starts[k], nth[here], side="right") - 1
                sequence[here] = 4 * (heads[k][run] + nth[here] - starts[k][run]) + 1
                slot[here] = slots[k][run]
            keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *extra]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(sequence), pa.array(slot)], names=[*keep, "sequence_id", "slot"])

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, " + ("ids binary, " if keep_ids else "") + "sequence_id long, slot long"
    in_sequence = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    columns = [f.split()[0] for f in DONE.split(", ")] + extra
    combined = numbered.mapInArrow(place, kind).withColumn("offset", F.coalesce(F.sum("length").over(in_sequence), F.lit(0))).select(*columns)
    whole = pieces.where("bin is null").withColumn("offset", F.lit(0).cast("long")).select(*columns)
    greedy = _cut_greedily(rests.where(~used), size, keep_ids).select(*columns)
    return whole.unionByName(combined).unionByName(greedy)


def sequence_rows(pieces: DataFrame, size: int = 2048, pad: int = 0) -> DataFrame:
    """The id matrix of ``pack_by_lengths(keep_ids=True)``: one row per sequence,
    ``ids`` padded to ``size`` unless the length is a power of two,
    ``cu_seqlens`` the cumulative segment lengths and ``doc_ids`` its documents."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    rows = pieces.groupBy("sequence_id").agg(parts.alias("p"), F.sum("length").cast("int").alias("n_tokens"))
    n = F.col("n_tokens")
    joined = F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    power = F.bit_count(n) == 1
    filler = F.lit(np.full(size, pad, "<u4").tobytes())
    ids = F.when(power, joined).otherwise(F.concat(joined, F.substring(filler, 1, 4 * (F.lit(size) - n))))
    ends = F.transform("p", lambda x: (x["offset"] + x["length"]).cast("int"))
    return rows.select("sequence_id", ids.alias("ids"), "n_tokens", F.concat(F.array(F.lit(0)), ends).alias("cu_seqlens"), F.col("p.doc_id").alias("doc_ids"))
