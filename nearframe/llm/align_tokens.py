"""Alignment of two tokenizers over the same texts.

Byte offsets at which tokens of both sides end cut a text into groups. Most
groups hold one token of either side with the same bytes: an identity map from
A ids to B ids, made once from the two vocabularies, recognizes them, and they
are counted in vectors as long as A's vocabulary. Only the pairs of the other
groups are counted by a shuffle, summed per slice of texts before it.

The texts are tokenized once. A slice (a few megabytes of text in one task) keeps
its documents' identity ids and irregular pairs as packed bytes; the corpus-wide
counts come back to it as one table of that slice's distinct pairs, so a pair
that a third of all documents hold moves once per slice and not per document.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearframe.llm.common import materialize, slices, spread_join
from nearframe.llm.packing import encode, encoder

VOCABULARY_A = "/opt/tokenizers/byte_bpe_50k.json"
VOCABULARY_B = "/opt/tokenizers/piece_bpe_32k.model"
#: About this much text per slice, and texts longer than this are tokenized in parts.
SLICE, PART = 4 << 20, 1 << 18
#: One space between characters that are no white space: a token of either side
#: may start there, and none goes across.
SEAM = re.compile(r"(?<=\S) (?=\S)")
SPACE = "▁"


def byte_level() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others for code points from 256 on."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(same)]
    return {chr(b): b for b in same} | {chr(256 + i): b for i, b in enumerate(rest)}


def a_bytes(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary (JSON), without added tokens'."""
    import json

    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    table, out = byte_level(), [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        if all(c in table for c in token):
            out[i] = bytes(table[c] for c in token)
    return out


def b_bytes(model) -> list[bytes]:
    """Bytes of each id of a piece vocabulary with byte fallback."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        else:
            out.append(piece.replace(SPACE, " ").encode())
    return out


def identity_map(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """For each A id the B id with the same bytes (a whole piece before a byte
    token), else -1."""
    by_bytes: dict[bytes, int] = {}
    for i, x in enumerate(b):
        by_bytes[x] = i  # byte tokens come first in the vocabulary, pieces replace them
    return np.array([by_bytes.get(x, -1) if x else -1 for x in a], np.int64)


class Aligner:
    """Both tokenizers, their token bytes and the identity map."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = a_bytes(path_a), b_bytes(self.b)
        # the same vocabulary as ranks: same ids, several times faster
        special = {i for i, x in enumerate(self.bytes_a) if x == b"<|endoftext|>"}
        self.a = encoder({x: i for i, x in enumerate(self.bytes_a) if x and i not in special})
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.same = identity_map(self.bytes_a, self.bytes_b)
        # no piece has a space behind another character: parts can be cut at seams
        self.local = all(" " not in x.lstrip(b" ").decode("latin-1") for x in self.bytes_b)
        # ids in decimal, with the sign that follows: within a side, between sides, between groups
        n = max(len(self.bytes_a), len(self.bytes_b))
        self.signs = [f"{i}{s}" for s in ",|;" for i in range(n)]
        self.n = n

    def parts(self, text: str) -> Iterator[str]:
        """A long text cut at seams, without the space of the seam (each side
        puts one in front); the tokens of the parts are those of the text."""
        start = 0
        while len(text) - start > PART and self.local:
            seam = SEAM.search(text, start + PART)
            if not seam:
                break
            yield text[start : seam.start()]
            start = seam.end()
        yield text[start:]

    def tokens(self, part: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, or none where either does not spell the text."""
        a, b = encode(self.a, " " + part), self.b.encode(part, num_threads=1)
        want = b" " + part.encode("utf-8", "replace")
        if b"".join(map(self.bytes_a.__getitem__, a)) != want or b"".join(map(self.bytes_b.__getitem__, b)) != want:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


class Held:
    """What a document's parts have given so far."""

    def __init__(self, with_groups: bool):
        self.counts, self.groups = np.zeros(4, np.int64), [] if with_groups else None
        self.digest, self.ident, self.codes, self.times = hashlib.sha256(), [], [], []

    def add(self, found: dict) -> None:
        text = found["groups"] if not self.counts[0] else ";" + found["groups"]
        self.digest.update(text.encode())
        if self.groups is not None:
            self.groups.append(text)
        self.counts += [found[k] for k in ("n_a", "n_b", "n_groups", "n_links")]
        for k in ("ident", "codes", "times"):
            getattr(self, k).append(found[k])

    def row(self) -> list:
        """Values of ``KEPT`` after the slice and the id."""
        if not self.counts[0]:
            return [0, 0, 0, 0, "", b"", b"", b"", ""]
        codes, times = np.concatenate(self.codes), np.concatenate(self.times)
        if len(self.codes) > 1:
            codes, at = np.unique(codes, return_inverse=True)
            summed = np.zeros(len(codes), np.int64)
            np.add.at(summed, at, times)
            times = summed
        ident = np.sort(np.concatenate(self.ident))
        return [*self.counts.tolist(), self.digest.hexdigest(), ident.astype("<u4").tobytes(), codes.astype("<u8").tobytes(), times.astype("<u8").tobytes(), "".join(self.groups or ())]


def groups_of(tokens: list[tuple[np.ndarray, np.ndarray]], al: Aligner) -> list[dict]:
    """Groups and links of several texts at once: their tokens are laid end to
    end, and since both sides end with every text, no group spans two texts."""
    n_a = np.array([len(a) for a, _ in tokens])
    n_b = np.array([len(b) for _, b in tokens])
    a, b = np.concatenate([x for x, _ in tokens]), np.concatenate([x for _, x in tokens])
    end_a, end_b = np.cumsum(al.size_a[a]), np.cumsum(al.size_b[b])
    cut = np.intersect1d(end_a, end_b, assume_unique=True)
    ga, gb = np.searchsorted(cut, end_a), np.searchsorted(cut, end_b)
    ca, cb = np.bincount(ga, minlength=len(cut)), np.bincount(gb, minlength=len(cut))
    first_a, first_b = np.cumsum(ca) - ca, np.cumsum(cb) - cb
    group_end = np.searchsorted(cut, end_a[np.cumsum(n_a) - 1], side="right")  # groups up to the end of each text
    one = (ca == 1) & (cb == 1)
    one[one] = al.same[a[first_a[one]]] == b[first_b[one]]
    ident = np.where(one, a[np.minimum(first_a, len(a) - 1)], -1)

    # irregular groups: all pairs of their tokens
    odd = np.flatnonzero(~one)
    wide = ca[odd] * cb[odd]
    pair_group: list[np.ndarray] = []
    pair_code: list[np.ndarray] = []
    pair_times: list[np.ndarray] = []
    small = odd[wide <= 4096]
    if len(small):
        times = ca[small] * cb[small]
        at = np.repeat(np.arange(len(small)), times)
        k = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
        width = cb[small][at]
        left, right = a[first_a[small][at] + k // width], b[first_b[small][at] + k % width]
        pair_group.append(small[at])
        pair_code.append(left << 32 | right)
        pair_times.append(np.ones(len(at), np.int64))
    for g in odd[wide > 4096]:
        # a long group: distinct ids of either side with their repeats
        left, nl = np.unique(a[first_a[g] : first_a[g] + ca[g]], return_counts=True)
        right, nr = np.unique(b[first_b[g] : first_b[g] + cb[g]], return_counts=True)
        pair_code.append((left[:, None] << 32 | right[None, :]).ravel())
        pair_times.append((nl[:, None] * nr[None, :]).ravel())
        pair_group.append(np.full(len(left) * len(right), g))
    empty = np.zeros(0, np.int64)
    pg, pc, pt = (np.concatenate(x) if x else empty for x in (pair_group, pair_code, pair_times))
    pair_doc = np.searchsorted(group_end, pg, side="right")
    order = np.lexsort((pc, pair_doc))
    pair_doc, pc, pt = pair_doc[order], pc[order], pt[order]
    new = np.ones(len(pc), bool)
    new[1:] = (pc[1:] != pc[:-1]) | (pair_doc[1:] != pair_doc[:-1])
    heads = np.flatnonzero(new)
    pt = np.add.reduceat(pt, heads) if len(heads) else empty
    pair_doc, pc = pair_doc[heads], pc[heads]
    pair_end = np.searchsorted(pair_doc, np.arange(len(tokens)), side="right")

    # the sign behind each token, and the tokens in the order of groups, A first
    key = np.concatenate([2 * ga, 2 * gb + 1])
    order = np.argsort(key, kind="stable")
    key = key[order]
    sign = np.zeros(len(key), np.int64)
    last = np.ones(len(key), bool)
    last[:-1] = key[1:] != key[:-1]
    sign[last] = np.where(key[last] % 2 == 0, 1, 2)
    codes = (np.concatenate([a, b])[order] + al.n * sign).tolist()
    token_end = np.cumsum(n_a + n_b)

    links = np.concatenate([[0], np.cumsum(ca * cb)])
    out, g0, t0, p0 = [], 0, 0, 0
    for i in range(len(tokens)):
        g1, t1, p1 = int(group_end[i]), int(token_end[i]), int(pair_end[i])
        text = "".join(map(al.signs.__getitem__, codes[t0:t1]))[:-1]
        x = ident[g0:g1]
        out.append({
            "n_a": int(n_a[i]), "n_b": int(n_b[i]), "n_groups": g1 - g0, "n_links": int(links[g1] - links[g0]),
            "groups": text, "ident": x[x >= 0], "codes": pc[p0:p1], "times": pt[p0:p1],
        })
        g0, t0, p0 = g1, t1, p1
    return out


KEPT = "slice long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, ident binary, codes binary, times binary"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _aligned(docs: DataFrame, path_a: str, path_b: str, with_groups: bool) -> DataFrame:
    schema = KEPT + (", groups string" if with_groups else "")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        al, part, seen = Aligner(path_a, path_b), TaskContext.get().partitionId() << 31, 0
        for b in batches:
            for lo, hi in slices(b, "text"):
                docs_ = [Held(with_groups) for _ in range(lo, hi)]
                units: list[tuple[Held, tuple]] = []
                size = 0

                def work() -> None:
                    for (d, _), found in zip(units, groups_of([x for _, x in units], al) if units else [], strict=True):
                        d.add(found)
                    units.clear()

                for i, t in enumerate(b.column(1).slice(lo, hi - lo)):
                    text = t.as_py()
                    if not text:
                        continue
                    seen += len(text)
                    for p in al.parts(text):
                        tokens = al.tokens(p)
                        if tokens is None:
                            # not spelled: no tokens at all
                            units = [u for u in units if u[0] is not docs_[i]]
                            docs_[i] = Held(with_groups)
                            break
                        units.append((docs_[i], tokens))
                        size += len(p)
                        if size >= 1 << 20:
                            work()
                            size = 0
                work()
                rows = [d.row() for d in docs_]
                columns = [pa.array([part + seen // SLICE] * len(rows), pa.int64()), b.column(0).slice(lo, hi - lo)]
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.string()]
                columns += [pa.array(c, k) for c, k in zip(list(zip(*rows))[: len(names) - 2], kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, schema)


def _pair_counts(kept: DataFrame, same: np.ndarray, table_rows: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """Documents per identity pair ``(a, n)``: vectors summed, one per task; and
    per irregular pair of a slice ``(slice, code, n)``."""

    def parse(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for where, ident, codes in zip(b.column("slice").to_pylist(), b.column("ident"), b.column("codes"), strict=True):
            x, c = np.unique(np.frombuffer(ident.as_py(), "<u4")).astype(np.int64), np.frombuffer(codes.as_py(), "<u8").astype(np.int64)
            left = c >> 32
            known = same[left] == (c & 0xFFFFFFFF)  # an identity pair inside an irregular group
            yield where, np.union1d(x, left[known]) if known.any() else x, c[~known]

    def vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(same), np.int64)
        for b in batches:
            for _, x, _c in parse(b):
                count[x] += 1
        a = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(count[a])], names=["a", "n"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, where = 0, None

        def flush() -> pa.RecordBatch:
            nonlocal size
            code, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            size = 0
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(code), where)), pa.array(code), pa.array(n.astype(np.int64))], names=["slice", "code", "n"])

        for b in batches:
            for s, _x, c in parse(b):
                if size and (s != where or size > 10 * table_rows):
                    yield flush()
                where = s
                if len(c):
                    held.append(c)
                    size += len(c)
        if size:
            yield flush()

    rows = kept.select("slice", "ident", "codes")
    return rows.mapInArrow(vector, "a long, n long").groupBy("a").agg(F.sum("n").alias("n")), rows.mapInArrow(pairs, "slice long, code long, n long")


def align_tokenizers(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path_a: str = VOCABULARY_A, path_b: str = VOCABULARY_B, with_groups: bool = False
) -> DataFrame:
    """One row per document: tokens of either side (``n_a``, ``n_b``), groups,
    links, ``n_best`` links whose pair is in as many documents as any pair of
    their A id, ``count_sum`` of the links' document counts, and the digest of the
    groups (``groups`` itself on request: ``a1,a2|b1;a3|b2``).

    Defined results: null and empty texts, and texts that either side does not
    spell byte for byte after a leading space, have zeros and an empty digest;
    texts of any length are one text; rows that repeat or share an id are
    documents each; a null id stays null; an empty table gives an empty result;
    other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    kept = materialize(_aligned(rows, path_a, path_b, with_groups), "align")
    al = Aligner(path_a, path_b)
    same = al.same
    vector, pairs = _pair_counts(kept, same)
    pairs = materialize(pairs, "align-pairs")
    total = materialize(pairs.groupBy("code").agg(F.sum("n").alias("count"), F.count("*").alias("n")), "align-counts")
    # both tables have at most one row per A id
    ident = {r["a"]: r["n"] for r in vector.collect()}
    best = {r["a"]: r["m"] for r in total.groupBy(F.shiftright("code", 32).alias("a")).agg(F.max("count").alias("m")).collect()}
    count = np.zeros(len(same), np.int64)
    count[list(ident)] = list(ident.values())
    top = count.copy()
    for a, m in best.items():
        top[a] = max(top[a], m)
    shared = docs.sparkSession.sparkContext.broadcast((count, top, same))

    n_rows = pairs.count()
    counted = spread_join(pairs.select("code", "slice"), total.select("code", "count"), ["code"], total.select("code", "n"), n_rows)
    schema = RESULT + (", groups string" if with_groups else "")
    names = [f.split()[0] for f in schema.split(", ")]

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        count, top, same = shared.value
        code, n = right.column("code").to_numpy(), right.column("count").to_numpy()
        order = np.argsort(code)
        code, n = code[order], n[order]
        best_of, sum_of = [], []
        for i, c, t in zip(*(left.column(x) for x in ("ident", "codes", "times")), strict=True):
            x, c, t = np.frombuffer(i.as_py(), "<u4"), np.frombuffer(c.as_py(), "<u8").astype(np.int64), np.frombuffer(t.as_py(), "<u8").astype(np.int64)
            a = c >> 32
            known = same[a] == (c & 0xFFFFFFFF)
            of = np.zeros(len(c), np.int64)
            of[known] = count[a[known]]
            if len(code):
                of[~known] = n[np.searchsorted(code, c[~known])]
            best_of.append(int((count[x] == top[x]).sum() + t[of == top[a]].sum()))
            sum_of.append(int(count[x].sum() + (t * of).sum()))
        done = left.append_column("n_best", pa.array(best_of, pa.int64())).append_column("count_sum", pa.array(sum_of, pa.int64()))
        return done.select(names)

    return kept.groupBy("slice").cogroup(counted.groupBy("slice")).applyInArrow(finish, schema)
