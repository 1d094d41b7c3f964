"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words over all documents give the IDF.
2. A distributed randomised SVD of the benchmark's TF-IDF passages gives a
   latent space: passages are rows of a Spark table, each power step is one
   aggregation of sparse rows, and only tables of ``BUCKETS x rank`` numbers
   reach the driver.
3. Every passage of every document is folded into that space and compared by
   cosine with the benchmark's passages.
4. Candidates pass a longest-common-subsequence check of the item's words, and
   below near-identity also a check of the item's answer (its last sentence),
   so paraphrases count and chance likeness does not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearframe.llm.common import materialize, slices

BUCKETS = 1 << 16
RANK = 256
PARTS = 64
#: Words of a benchmark passage; document passages are three steps long, so
#: that each run of ``PASSAGE`` words lies within one.
PASSAGE, STEP = 32, 16
BLOCK_BYTES = 8 << 20
#: Passages per side of one product of folded vectors, and steps folded at once.
ROWS, GATHER = 2048, 256

#: Lower-cased byte codes; 0 for bytes that belong to no word.
_CODE = np.zeros(256, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_WORD = np.array([*range(48, 58), *range(97, 123), *range(128, 256)])
_CODE[_WORD] = _mix(_WORD.astype(np.uint64)) | np.uint64(1)
_CODE[65:91] = _CODE[97:123]
_ODD = 0x9E3779B97F4A7C15


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(base, ())) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        _POWERS[base] = np.multiply.accumulate(steps)
    return _POWERS[base][:n]


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (runs of letters and digits, A-Z lower-cased)
    of a buffer of texts, and the text index of each."""
    code = _CODE[data]
    inside = code != 0
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[-1] = True, True
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[bounds[:-1]] = True
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    word = inside[start] if len(data) else np.empty(0, bool)
    start, end = start[word], end[word]
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(code * _powers(_ODD, max(len(data), 1))[: len(data)], out=sums[1:])
    # powers of the inverse bring every word to the same origin
    down = _powers(pow(_ODD, -1, 1 << 64), len(data) + 1)
    hashes = _mix((sums[end] - sums[start]) * down[start])
    return hashes, np.searchsorted(bounds, start, side="right")


def _buffers(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for s, e in slices(batch, column):
        parts = [(t.as_py() or "").encode("utf-8", "replace") for t in batch.column(column)[s:e]]
        yield s, e, np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts], dtype=np.int64)


def _bucket(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(48)).astype(np.int64)


def inverse_frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """IDF of every word bucket over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, _, data, bounds in _buffers(batch, "text"):
                words, doc = word_hashes(data, bounds)
                pairs = np.sort(doc * BUCKETS + _bucket(words))
                first = np.concatenate([[True], pairs[1:] != pairs[:-1]])[: len(pairs)]
                total += np.bincount(pairs[first] % BUCKETS, minlength=BUCKETS)
        rows = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(rows, -1)), pa.array(np.append(total[rows], n))], names=["bucket", "n"])

    counts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    rows = counts.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # at most BUCKETS + 1 rows
    seen = np.zeros(BUCKETS)
    here = rows["bucket"] >= 0
    seen[rows["bucket"][here].to_numpy()] = rows["n"][here]
    return np.log((rows["n"][~here].sum() + 1.0) / (seen + 1.0)) + 0.1


def _passages(words: np.ndarray) -> list[np.ndarray]:
    """Overlapping passages of one item; the last one ends with the item."""
    if len(words) <= PASSAGE:
        return [words] if len(words) else []
    starts = [*range(0, len(words) - PASSAGE, STEP), len(words) - PASSAGE]
    return [words[s : s + PASSAGE] for s in starts]


def _hash_text(text: str) -> np.ndarray:
    raw = text.encode("utf-8", "replace")
    return word_hashes(np.frombuffer(raw, np.uint8), np.array([len(raw)]))[0] if raw else np.empty(0, np.uint64)


def answer_words(text: str) -> np.ndarray:
    """Words of an item's answer: its last sentence or line."""
    parts = [p for p in re.split(r"[.!?\n]+", text) if len(_hash_text(p))]
    return _hash_text(parts[-1]) if parts else np.empty(0, np.uint64)


def latent_space(benchmark: DataFrame, idf: np.ndarray, text: str = "text", rank: int = RANK, power: int = 2, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (``BUCKETS x rank``) of the TF-IDF passages by a
    randomised SVD. Each step multiplies the basis by the Gram matrix of all
    passages: tasks emit the rows of their share that are not zero, and Spark
    adds them up in ``PARTS`` groups of buckets, each of bounded size per task."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col(text).cast("string").alias("text"))
    names = ["part", "bucket", "z"]

    def add(table: pa.Table) -> pa.Table:
        bucket, back = np.unique(table.column("bucket").to_numpy(), return_inverse=True)
        z = np.zeros((len(bucket), rank))
        np.add.at(z, back, np.frombuffer(b"".join(table.column("z").to_pylist())).reshape(-1, rank))
        return pa.table([table.column("part")[: len(bucket)], pa.array(bucket), pa.array([r.tobytes() for r in z], pa.binary())], names=names)

    used, basis = np.empty(0, np.int64), np.empty((0, rank))
    for step in range(power + 1):
        shared = spark.sparkContext.broadcast((idf, used, basis))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, first=step == 0) -> Iterator[pa.RecordBatch]:
            weight, used, basis = shared.value
            q = {} if first else dict(zip(used.tolist(), basis, strict=True))
            z: dict[int, np.ndarray] = {}
            for batch in batches:
                for t in batch.column("text"):
                    for p in _passages(_hash_text(t.as_py() or "")):
                        bucket, n = np.unique(_bucket(p), return_counts=True)
                        a = n * weight[bucket]
                        a /= np.linalg.norm(a) or 1.0
                        for b in bucket.tolist() if first else ():
                            if b not in q:  # the random start, the same in every task
                                q[b] = np.random.default_rng([seed, b]).standard_normal(rank)
                        y = a @ np.stack([q[b] for b in bucket.tolist()])
                        for b, x in zip(bucket.tolist(), a, strict=True):
                            z[b] = z.get(b, 0.0) + x * y
            yield pa.RecordBatch.from_arrays([pa.array([b % PARTS for b in z], pa.int64()), pa.array(list(z), pa.int64()), pa.array([r.tobytes() for r in z.values()], pa.binary())], names=names)

        summed = rows.mapInArrow(run, "part long, bucket long, z binary").groupBy("part").applyInArrow(add, "part long, bucket long, z binary").select("bucket", "z").toPandas().sort_values("bucket")
        used = summed["bucket"].to_numpy(dtype=np.int64)
        z = np.frombuffer(b"".join(summed["z"])).reshape(-1, rank)
        if step < power:
            basis = np.linalg.qr(z)[0] if len(z) else z
            if basis.shape[1] < rank:
                basis = np.pad(basis, ((0, 0), (0, rank - basis.shape[1])))
        shared.destroy()
    rows_ = np.zeros((0, rank), np.float32)
    if len(used):
        values, turn = np.linalg.eigh(basis.T @ z)
        rows_ = (basis @ (turn * (values > 1e-9 * max(values.max(), 1e-300)))).astype(np.float32)
    some = np.flatnonzero(np.abs(rows_).sum(axis=1) > 1e-9)
    return used[some], rows_[some]


def word_masks(item: np.ndarray) -> dict[int, int]:
    """For every word of an item, the bits of its places."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | (1 << i)
    return masks


def common_subsequence(masks: dict[int, int], n: int, words: list[int]) -> int:
    """Length of the longest common subsequence of an item of ``n`` words, given
    by its masks, and ``words`` (bit-parallel)."""
    full = (1 << n) - 1
    row = full
    for w in words:
        m = masks.get(w)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return n - row.bit_count()


class Index:
    """Benchmark items of one block, ready for the search in a task."""

    def __init__(self, items: list[tuple[int, str]], idf: np.ndarray, space: tuple[np.ndarray, np.ndarray]):
        # where each used bucket's row is
        used, rows = space
        self.table = (rows * idf[used, None]).astype(np.float32)
        self.row = np.full(BUCKETS, -1, np.int32)
        self.row[used] = np.arange(len(used))
        self.ids, self.sizes, self.masks, self.counts, self.answers, owner, vectors = [], [], [], [], [], [], []
        for item, text in items:
            words = _hash_text(text or "")
            if not len(words):
                continue
            for p in _passages(words):
                owner.append(len(self.ids))
                vectors.append(self.fold(p))
            answer = answer_words(text)
            self.ids.append(item)
            self.sizes.append(len(words))
            self.masks.append(word_masks(words))
            self.counts.append([(w, m.bit_count()) for w, m in self.masks[-1].items()])
            self.answers.append((word_masks(answer), len(answer)))
        self.owner = np.array(owner, np.int64)
        v = np.stack(vectors) if vectors else np.zeros((0, rows.shape[1]), np.float32)
        self.unit = v / np.maximum(np.linalg.norm(v, axis=1), 1e-12)[:, None]

    def fold(self, words: np.ndarray) -> np.ndarray:
        row = self.row[_bucket(words)]
        return self.table[row[row >= 0]].sum(axis=0)

    def fold_steps(self, row: np.ndarray, step: np.ndarray, n: int) -> np.ndarray:
        """Folded sums of ``n`` steps; ``row`` and ``step`` of each word."""
        out = np.zeros((n, self.table.shape[1]), np.float32)
        known = row >= 0
        row, step = row[known], step[known]
        cuts = np.searchsorted(step, np.arange(0, n + GATHER, GATHER))
        for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if x < y:
                first = np.flatnonzero(np.concatenate([[True], step[x + 1 : y] != step[x : y - 1]]))
                out[step[x:y][first]] = np.add.reduceat(self.table[row[x:y]], first, axis=0)
        return out

    def candidates(self, words: np.ndarray, owner: np.ndarray, head: np.ndarray, p: dict) -> Iterator[tuple[int, int, float]]:
        """(step, benchmark passage, cosine) of the passages near each other in
        the latent space: all passages of the texts against all of the block."""
        row = self.row[_bucket(words)]
        ends = np.append(head, len(words))
        for s in range(0, len(head), ROWS):
            e = min(s + ROWS, len(head))
            far = min(e + 2, len(head))
            step = np.repeat(np.arange(far - s), np.diff(ends[s : far + 1]))
            part = self.fold_steps(row[ends[s] : ends[far]], step, far - s)
            # a passage is a step and the next two of the same text
            vec = part[: e - s].copy()
            for d in (1, 2):
                on = np.flatnonzero(owner[s : max(min(e, len(head) - d), s)] == owner[s + d : min(e + d, len(head))])
                vec[on] += part[on + d]
            norm = np.linalg.norm(vec, axis=1)
            some = np.flatnonzero(norm > 0)
            vec, norm = vec[some], norm[some]
            for t in range(0, len(self.unit), ROWS):
                dot = vec @ self.unit[t : t + ROWS].T
                for i, j in zip(*(x.tolist() for x in np.nonzero((dot >= p["cosine"] * norm[:, None]) & (dot > 0))), strict=True):
                    yield s + int(some[i]), t + j, float(dot[i, j] / norm[i])

    def search(self, data: np.ndarray, bounds: np.ndarray, p: dict) -> list[list[dict]]:
        found: list[list[dict]] = [[] for _ in bounds]
        words, doc = word_hashes(data, bounds)
        if not len(words) or not len(self.unit):
            return found
        first = np.searchsorted(doc, np.arange(len(bounds) + 1))
        place = np.arange(len(words)) - first[doc]
        head = np.flatnonzero(place % STEP == 0)
        owner = doc[head]
        best: dict[tuple[int, int], dict] = {}
        tried: set[tuple[int, int]] = set()
        for b, j, cosine in self.candidates(words, owner, head, p):
            k, d = int(self.owner[j]), int(owner[b])
            if (b, k) in tried:
                continue
            tried.add((b, k))
            at, n = int(place[head[b]]), self.sizes[k]
            lo = max(0, at - n)
            window = words[first[d] + lo : min(first[d] + at + 3 * STEP + n, first[d + 1])].tolist()
            # no common subsequence is longer than the item's words that occur here
            here = set(window)
            if sum(c for w, c in self.counts[k] if w in here) < p["share"] * n:
                continue
            share = common_subsequence(self.masks[k], n, window) / n
            if share < p["share"]:
                continue
            masks, m = self.answers[k]
            answered = common_subsequence(masks, m, window) / m >= p["answer"]
            if share < p["verbatim"] and not answered:
                continue
            hit = {"item_id": self.ids[k], "cosine": cosine, "lcs_share": share, "answered": bool(answered), "word": lo}
            old = best.get((d, k))
            if old is None or (share, cosine) > (old["lcs_share"], old["cosine"]):
                best[d, k] = hit
        for (d, _), hit in sorted(best.items(), key=lambda x: (x[0][0], x[1]["item_id"])):
            found[d].append(hit)
        return found


MATCH = "array<struct<item_id:long,cosine:double,lcs_share:double,answered:boolean,word:int>>"
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs_share", pa.float64()), ("answered", pa.bool_()), ("word", pa.int32())]))


class Matcher:
    """The benchmark in blocks of at most about ``BLOCK_BYTES`` of text (it is the
    stated query set). A block's index is sent to the tasks when its column is
    made, and can be dropped from them when the result is written."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", rank: int = RANK, cosine: float = 0.6, share: float = 0.6, verbatim: float = 0.8, answer: float = 0.6):
        self.spark = docs.sparkSession
        self.items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
        size = self.items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.blocks = 1 + size // BLOCK_BYTES
        self.idf = inverse_frequencies(docs, text)
        self.space = latent_space(self.items, self.idf, "text", rank)
        self.p = {"cosine": cosine, "share": share, "verbatim": verbatim, "answer": answer}
        self.sent = None

    def column(self, k: int, text: Column) -> Column:
        """Matches of block ``k`` in a whole text; the block before is dropped."""
        if self.sent is not None:
            self.sent.destroy()
        part = self.items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(self.blocks)) == k).distinct().orderBy("item_id", "text").collect()
        shared = self.sent = self.spark.sparkContext.broadcast(Index([(r["item_id"], r["text"]) for r in part], self.idf, self.space))
        p = self.p

        @F.arrow_udf(MATCH)
        def match(texts: pa.Array) -> pa.Array:
            index, out = shared.value, []
            batch = pa.RecordBatch.from_arrays([texts.cast(pa.string())], names=["text"])
            for _, _, data, bounds in _buffers(batch, "text"):
                out += index.search(data, bounds, p)
            return pa.array(out, _ARROW)

        return match(text.cast("string"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``doc_id, item_id, cosine, lcs_share, answered, word``: one row per row of
    ``docs`` and benchmark item that it contains (best place).

    Defined results: null and empty text contain nothing; null or empty items
    are contained nowhere; rows that repeat are reported once each; items with
    equal texts are all reported; an empty table on either side gives an empty
    result; other columns are ignored.
    """
    m = Matcher(docs, benchmark, text, **options)
    found = None
    for k in range(m.blocks):
        part = docs.select(F.col(doc_id).alias("doc_id"), F.explode(m.column(k, F.col(text))).alias("m")).select("doc_id", "m.*")
        if m.blocks > 1:  # written before the next block replaces this one
            part = materialize(part, "leaks")
        found = part if found is None else found.unionByName(part)
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item."""
    m = Matcher(docs, benchmark, text, **options)
    for k in range(m.blocks):
        docs = docs.where(F.size(m.column(k, F.col(text))) == 0)
        if m.blocks > 1:
            docs = materialize(docs, "clean")
    return docs
