"""Hard negatives by Fagin's threshold algorithm.

Rows are cut into blocks, each of one label where the label is large. A block
holds, for every dimension, its rows sorted by that component. An anchor reads
these lists in the direction of its own sign, so that what comes first adds most
to the inner product; a row met on any list is scored at once from its whole
vector (integers, so exact). The sum over the dimensions of the anchor's component
times the last value read bounds the score of every row not met yet: reading stops
when that threshold is strictly below the k-th score of each window the anchor
looks for, since an equal score could still win by its id.

Two rounds: the positives (one window, open at both ends) read the blocks of the
anchor's label, and their scores make the windows of the negatives, which read the
other blocks. Anchors travel in packs; a pack and a block meet in one task, and
the k best of every block are merged by a windowed rank. A block whose first
threshold is already below a window is left without a read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearframe.llm.common import materialize

#: Rows of a block and anchors of a pack, about.
BLOCK, PACK = 4096, 2048
#: Scaled components are held within this bound, so that scores fit a long.
LARGEST = 1 << 27
#: List depths after which the threshold is looked at: this, then twice as deep.
FIRST_DEPTH = 8
LOWEST = -(1 << 63)


class Lists:
    """The sorted lists of a block: ``order[j]`` has its rows by component j."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.n, self.d = x.shape
        self.order = np.argsort(x, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(x, self.order.T, axis=0)
        depths, t = [0], FIRST_DEPTH
        while t < self.n:
            depths.append(t)
            t *= 2
        self.depths = depths

    def thresholds(self, a: np.ndarray) -> np.ndarray:
        """(anchors, depths): the most that a row can score which lies deeper
        than ``depth`` on all of the anchor's lists."""
        up, down = np.maximum(a, 0), np.minimum(a, 0)
        from_top = self.values[[self.n - 1 - t for t in self.depths]]
        from_bottom = self.values[self.depths]
        return product(up, from_top) + product(down, from_bottom)


def product(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer ``a @ x.T``, in doubles where their 53 bits are enough."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0**53:
        return (a.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    return a @ x.T


def threshold_search(
    lists: Lists, ids: np.ndarray, rows: np.ndarray, allowed: np.ndarray | None, a: np.ndarray, limits: np.ndarray, windows: list[tuple[int, int]], k: int
) -> tuple[list[np.ndarray], int]:
    """For each window ``(low, high)`` of scores the positions of its first k rows
    by (score descending, id, row), and how many rows were scored.

    ``limits`` are the anchor's thresholds at ``lists.depths``; ``allowed`` marks
    the rows that may be returned."""
    n, d = lists.n, lists.d
    met = np.zeros(n, bool)
    at = np.zeros(0, np.int64)
    score = np.zeros(0, np.int64)
    plus, minus = np.flatnonzero(a > 0), np.flatnonzero(a < 0)
    kth = [LOWEST] * len(windows)  # score of the k-th row found, per window
    reach = [low for low, _ in windows]
    depth = 0
    for step, limit in enumerate([*limits.tolist(), None]):
        if limit is not None and all(limit < max(q, low) for q, low in zip(kth, reach)):
            break
        if limit is None:
            break
        # read the lists down to the next depth
        nxt = lists.depths[step + 1] if step + 1 < len(lists.depths) else n
        if len(plus) + len(minus) == 0:
            new = np.arange(n) if depth == 0 else np.zeros(0, np.int64)
        elif nxt >= n:
            new = np.flatnonzero(~met)
        else:
            seen = np.concatenate([lists.order[plus, n - nxt : n - depth].ravel(), lists.order[minus, depth:nxt].ravel()])
            new = np.unique(seen)
            new = new[~met[new]]
        depth = nxt
        met[new] = True
        if len(new):
            s = product(a[None, :], lists.x[new])[0]
            ok = s >= min(reach)
            if allowed is not None:
                ok &= allowed[new]
            at, score = np.concatenate([at, new[ok]]), np.concatenate([score, s[ok]])
            for w, (low, high) in enumerate(windows):
                inside = score[(score >= low) & (score <= high)]
                kth[w] = int(np.partition(inside, len(inside) - k)[len(inside) - k]) if len(inside) >= k else LOWEST
        if depth >= n:
            break
    found = []
    order = np.lexsort((rows[at], ids[at], -score))
    at, score = at[order], score[order]
    for low, high in windows:
        found.append(at[(score >= low) & (score <= high)][:k])
    return found, int(met.sum())


def _vector_matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of integers as one matrix; shorter ones are filled with zeros."""
    column = column.combine_chunks()
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.asarray(column.value_lengths())
    if len(ends) and (ends == width).all():
        return flat.reshape(-1, width).astype(np.int64)
    out = np.zeros((len(ends), width), np.int64)
    start = 0
    for i, n in enumerate(ends.tolist()):
        out[i, :n] = flat[start : start + n]
        start += n
    return out


def _widths(*tables: pa.Table) -> int:
    return max([1, *(int(np.asarray(t.column("v").combine_chunks().value_lengths()).max(initial=1)) for t in tables)])


POSITIVE = "anchor long, anchor_id long, positive long, positive_id long, score long"
NEGATIVE = "anchor long, high long, negative long, negative_id long, score long"


def _pack(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """One row per block or pack: its rows as an Arrow stream."""

    def run(table: pa.Table) -> pa.Table:
        sink = pa.BufferOutputStream()
        body = table.select(columns)
        with pa.ipc.new_stream(sink, body.schema) as out:
            out.write_table(body)
        heads = {c: table.column(c).slice(0, 1) for c in by}
        return pa.table(heads | {"body": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    types = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in by)
    return rows.groupBy(*by).applyInArrow(run, f"{types}, body binary")


def _open(table: pa.Table) -> pa.Table | None:
    return pa.ipc.open_stream(table.column("body")[0].as_py()).read_all() if table.num_rows else None


def _meet(packs: DataFrame, blocks: DataFrame, search, schema: str) -> DataFrame:
    empty = pa.table({n: pa.array([], pa.int64()) for n in (f.split()[0] for f in schema.split(", "))})

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        anchors, rows = _open(left), _open(right)
        if anchors is None or rows is None:
            return empty
        width = _widths(anchors, rows)
        lists = Lists(_vector_matrix(rows.column("v"), width))
        a = _vector_matrix(anchors.column("v"), width)
        found = search(anchors, a, lists, rows, lists.thresholds(a))
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(empty.column_names, zip(*found, strict=True))}) if found else empty

    return packs.groupBy("block", "pack").cogroup(blocks.groupBy("block", "pack")).applyInArrow(run, schema)


def scaled(vector: str, scale: int) -> Column:
    """Components as integers: floor(scale * x)."""
    held = lambda x: F.greatest(F.least(F.floor(F.lit(float(scale)) * x.cast("double")), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int")
    return F.transform(vector, held)


def mine_hard_negatives(
    rows: DataFrame, anchors: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
    positives: int = 5, negatives: int = 5, least: tuple[int, int] = (4, 5), scale: int = 256, block: int = BLOCK, pack: int = PACK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for every row for which ``anchors`` holds, its first
    ``positives`` other rows of the same label, and for each of them the first
    ``negatives`` rows of another label that score at most as much as the positive
    and at least ``least`` of it (a fraction). A score is the inner product of the
    scaled components; more comes first, ties by the smaller id.

    Defined results: rows with a null label, vector or id, or with a null or
    non-finite component take no part; vectors of different lengths count missing
    components as zero, and an empty vector scores 0; scaled components are held
    within 2**27; rows that repeat or share an id are rows each (a copy of the
    anchor is another row, and an anchor that occurs twice is mined twice); a
    window without a row gives none; an empty table gives an empty result; other
    columns are ignored.
    """
    spark = rows.sparkSession
    lab = F.col(label) if isinstance(label, str) else label
    good = F.col(vec_id).isNotNull() & lab.isNotNull() & F.col(vector).isNotNull()
    finite = F.forall(vector, lambda x: F.coalesce((x.cast("double") > float("-inf")) & (x.cast("double") < float("inf")), F.lit(False)))
    kept = rows.where(good & finite).select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("id"), lab.cast("string").alias("label"), scaled(vector, scale).alias("v"), F.coalesce(anchors, F.lit(False)).alias("is_anchor")
    )
    kept = materialize(kept, "mine")  # the row number is fixed from here on

    # blocks: a label of more than a quarter of a block's rows has its own, the others share
    per_label = materialize(kept.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.col("is_anchor").cast("long")).alias("anchors")), "mine-labels")
    sums = per_label.agg(F.sum("n").alias("n"), F.sum("anchors").alias("a"), F.sum(F.when(F.col("n") <= block // 4, F.col("n"))).alias("small")).first()
    if not sums["a"]:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    n_small = -(-(sums["small"] or 0) // block)
    packs = max(1, -(-sums["a"] // pack))
    large = per_label.where(F.col("n") > block // 4).withColumn("parts", F.ceil(F.col("n") / block).cast("int"))
    # at most four rows per block's worth of rows: numbered in one small window
    before = Window.orderBy("label").rowsBetween(Window.unboundedPreceding, -1)
    large = materialize(large.select("label", "parts", "anchors", F.coalesce(F.sum("parts").over(before), F.lit(0)).alias("first")), "mine-blocks")
    n_large = large.agg(F.coalesce(F.sum("parts"), F.lit(0))).first()[0]
    blocks = n_large + n_small
    if large.count() <= 1 << 20:
        large = F.broadcast(large)
    placed = kept.join(large.select("label", "parts", "first"), "label", "left")
    shared = F.lit(n_large) + F.pmod(F.xxhash64("label"), F.lit(max(1, n_small)))
    number = F.when(F.col("parts").isNull(), shared).otherwise(F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts"))).cast("int")
    own = F.col("parts").isNotNull()
    body = materialize(_pack(placed.withColumn("block", number), ["block"], ["row", "id", "label", "v"]), "mine-lists")

    # positives: an anchor meets the blocks of its label, in packs of that label
    who = placed.where("is_anchor")
    of_label = per_label.select("label", F.greatest(F.ceil(F.col("anchors") / pack), F.lit(1)).cast("int").alias("subs"))
    if per_label.count() <= 1 << 20:
        of_label = F.broadcast(of_label)
    home = F.when(own, F.col("first")).otherwise(shared).cast("int")
    ends = F.when(own, F.col("first") + F.col("parts") - 1).otherwise(shared).cast("int")
    who = who.join(of_label, "label").withColumn("home", home).withColumn("end", ends)
    # small labels of one block share its packs
    sub = F.when(own, F.pmod(F.xxhash64("row"), F.col("subs"))).otherwise(0).cast("int")
    at_home = who.withColumn("pack", sub)
    met = F.explode(F.sequence("home", "end")).alias("block")
    first_packs = _pack(at_home, ["home", "end", "pack"], ["row", "id", "label", "v"]).select(met, "pack", "body")
    first_blocks = body.join(at_home.select("home", "end", "pack").distinct().select(met, "pack"), "block")

    def find_positives(anchors: pa.Table, a: np.ndarray, lists: Lists, rows: pa.Table, limits: np.ndarray) -> list[tuple]:
        ids, nums, labels = rows.column("id").to_numpy(), rows.column("row").to_numpy(), np.array(rows.column("label").to_pylist(), object)
        out = []
        for i, (row, who, lab) in enumerate(zip(*(anchors.column(c).to_pylist() for c in ("row", "id", "label")), strict=True)):
            allowed = (labels == lab) & (nums != row)
            (hits,), _ = threshold_search(lists, ids, nums, allowed, a[i], limits[i], [(LOWEST, -LOWEST - 1)], positives)
            s = product(a[i][None, :], lists.x[hits])[0]
            out += zip([row] * len(hits), [who] * len(hits), nums[hits].tolist(), ids[hits].tolist(), s.tolist(), strict=True)
        return out

    def first(df: DataFrame, by: list[str], other: str, k: int) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(F.col("score").desc(), f"{other}_id", other)
        return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    best = materialize(first(_meet(first_packs, first_blocks, find_positives, POSITIVE), ["anchor"], "positive", positives), "mine-positives")

    # negatives: an anchor with its windows meets every block but those of its label
    highs = best.groupBy("anchor").agg(F.sort_array(F.collect_set("score")).alias("highs"))  # at most ``positives`` scores
    second = who.withColumnRenamed("row", "anchor").join(highs, "anchor").withColumn("pack", F.pmod(F.xxhash64("anchor"), F.lit(packs)).cast("int"))
    second_packs = _pack(second.withColumn("own", own), ["pack"], ["anchor", "label", "own", "home", "end", "v", "highs"])
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    second_packs = second_packs.withColumn("block", every)
    second_blocks = body.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1))))

    def find_negatives(anchors: pa.Table, a: np.ndarray, lists: Lists, rows: pa.Table, limits: np.ndarray) -> list[tuple]:
        ids, nums, labels = rows.column("id").to_numpy(), rows.column("row").to_numpy(), np.array(rows.column("label").to_pylist(), object)
        out = []
        mixed = len(set(labels.tolist())) > 1
        for i, (row, lab, highs) in enumerate(zip(*(anchors.column(c).to_pylist() for c in ("anchor", "label", "highs")), strict=True)):
            if not mixed and labels[0] == lab:
                continue
            # least * high <= score <= high, in whole numbers
            windows = [(-(-least[0] * h // least[1]), h) for h in highs]
            windows = [(low, h) for low, h in windows if low <= h]
            if not windows:
                continue
            hits, _ = threshold_search(lists, ids, nums, labels != lab if mixed else None, a[i], limits[i], windows, negatives)
            for (_, h), at in zip(windows, hits, strict=True):
                s = product(a[i][None, :], lists.x[at])[0]
                out += zip([row] * len(at), [h] * len(at), nums[at].tolist(), ids[at].tolist(), s.tolist(), strict=True)
        return out

    near = first(_meet(second_packs.select("block", "pack", "body"), second_blocks, find_negatives, NEGATIVE), ["anchor", "high"], "negative", negatives)
    pairs = best.select("anchor", "anchor_id", "positive_id", F.col("score").alias("high"))
    joined = pairs.join(near, ["anchor", "high"])
    return joined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", F.col("high").alias("positive_score"), F.col("score").alias("negative_score"))
