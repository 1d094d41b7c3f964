"""Token-ID output: whole documents tokenized and packed into rows of a fixed
length by best-fit-decreasing, with a segment tree over free capacities.

Packing needs no shuffle: each task packs the pieces it has read in bounded
groups, so memory does not depend on the size of the corpus.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokenization of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Texts longer than this are tokenized in parts, cut where a word ends: no
#: pre-token has white space behind another character, so ids stay the same.
PART = 1 << 18
SEAM = re.compile(r"(?<=\S)[ \t\r\n]")
#: The white space of the pattern's \s (Unicode White_Space), in runs
#: far below what its matcher can stand.
WIDE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    lines = Path(path).read_bytes().splitlines()
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}


def encoder(ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _encode_parts(enc, text: str) -> list[int]:
    if len(text) <= PART:
        return enc.encode_ordinary(text)
    out: list[int] = []
    start = 0
    while start < len(text):
        seam = SEAM.search(text, start + PART)
        end = seam.start() if seam else len(text)
        out += enc.encode_ordinary(text[start:end])
        start = end
    return out


def encode(enc, text: str) -> list[int]:
    """Ids of a text of any length. A run of white space is one pre-token, less
    its last character where something follows; long runs overflow the stack of
    the pattern's matcher, so they are cut out here and merged by themselves."""
    out: list[int] = []
    start = 0
    for run in WIDE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += _encode_parts(enc, text[start : run.start()])
        out += enc._encode_single_piece(text[run.start() : end])
        start = end
    return out + _encode_parts(enc, text[start:]) if start else _encode_parts(enc, text)


class Capacities:
    """Segment tree over free capacities 0..size: counts of open rows with each
    capacity; finds the smallest capacity that is at least ``need``."""

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.count = [0] * (2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        i = free + self.width
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (capacity, row) of the best fit."""
        i = need + self.width
        while not self.count[i]:
            # climb to the next subtree on the right
            while i & 1:
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.width:
            i = 2 * i if self.count[2 * i] else 2 * i + 1
        free = i - self.width
        while i:
            self.count[i] -= 1
            i >>= 1
        return free, self.rows[free].pop()


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Rows of item numbers; every length is at most ``size``."""
    rows: list[list[int]] = []
    open_ = Capacities(size)
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[item]
        fit = open_.take(n)
        if fit is None:
            rows.append([item])
            free = size - n
        else:
            free = fit[0] - n
            rows[fit[1]].append(item)
        row = len(rows) - 1 if fit is None else fit[1]
        if free:
            open_.put(free, row)
    return rows


SCHEMA = "row_id long, ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, pieces array<int>, last_piece array<boolean>"


def pack_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 2048, vocabulary: str = VOCABULARY, group: int = 4096) -> DataFrame:
    """Packed rows of ``size`` token ids.

    ``ids`` is the row of the id matrix as little-endian 16-bit integers (32-bit
    if the vocabulary needs them), filled up with the end id; ``n_tokens`` of
    them are real. ``cu_seqlens`` are the cumulative segment lengths from 0,
    ``position_resets`` the offsets at which positions start anew. Segment i
    is piece ``pieces[i]`` of document ``doc_ids[i]``, and its last piece where
    ``last_piece[i]``; the pieces of a document in order give its ids and one
    end id (the first id after the vocabulary).

    Defined results: null and empty text are one end id; overlong documents
    are split at multiples of ``size``, nothing is dropped; null ids stay null;
    rows that repeat are packed once each; an empty table gives an empty
    result; other columns are ignored.
    """
    ranks = load_ranks(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, end = encoder(shared.value), max(shared.value.values()) + 1
        kind = np.dtype("<u2") if end < 1 << 16 else np.dtype("<u4")
        base, made = TaskContext.get().partitionId() << 32, 0
        held: list[tuple[int | None, int, bool, np.ndarray]] = []

        def pack() -> pa.RecordBatch:
            nonlocal made
            rows = best_fit_decreasing([len(x[3]) for x in held], size)
            cols: list[list] = [[] for _ in range(8)]
            for row in rows:
                items = [held[i] for i in row]
                cu = np.concatenate([[0], np.cumsum([len(x[3]) for x in items])]).astype(np.int32)
                ids = np.full(size, end, kind)
                ids[: cu[-1]] = np.concatenate([x[3] for x in items])
                for c, v in zip(cols, (base + made, ids.tobytes(), int(cu[-1]), cu, cu[:-1], [x[0] for x in items], [x[1] for x in items], [x[2] for x in items]), strict=True):
                    c.append(v)
                made += 1
            held.clear()
            kinds = [pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[c.split()[0] for c in SCHEMA.split(", ")])

        for b in batches:
            for who, t in zip(b.column(0), b.column(1), strict=True):
                ids = np.array([*encode(enc, t.as_py() or ""), end], kind)
                for piece, s in enumerate(range(0, len(ids), size)):
                    held.append((who.as_py(), piece, s + size >= len(ids), ids[s : s + size]))
                    if len(held) >= group:
                        yield pack()
        if held:
            yield pack()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet: one binary matrix row per record, with its
    segment tables beside it."""
    packed.write.parquet(path)


def matrix(rows: list[bytes], size: int) -> np.ndarray:
    """The id matrix of collected ``ids`` values."""
    width = len(rows[0]) // size if rows else 2
    return np.frombuffer(b"".join(rows), np.dtype(f"<u{width}")).reshape(-1, size)
