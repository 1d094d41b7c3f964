"""``pivots``: exact kNN for wide vectors by pivots and the triangle inequality.

1. **Pivots.** A bounded sample of train (``SAMPLE`` rows, chosen by a hash) is
   clustered on the driver into at most ``MAX_PIVOTS`` centres. Any choice is
   correct; it only decides how much is pruned.
2. **Packs.** Each train row goes to its nearest pivot; a pivot with many rows is
   cut into rings of its distance (and, where many rows share one distance, by a
   hash) of about ``PACK_ROWS`` rows. A pack is one row: its points as an Arrow
   stream, with the least and the greatest distance to its pivot.
3. **Bound.** Queries are packed like train and meet one pack, that of their own
   ring: its k-th distance bounds each query's k-th distance from above.
4. **Reach.** With ``b`` the bound, ``h`` the query's nearest pivot and ``p`` a
   pack's pivot, no row ``t`` of the pack is closer than any of

       d(q, p) - greatest,    least - d(q, p),    (d(q, p)^2 - d(q, h)^2) / (2 d(p, h))

   (the last: ``t`` is nearer to ``p`` than to ``h``). Packs whose bound exceeds
   ``b`` for all queries of a query pack never meet it, and inside a tile only the
   queries that reach it are scored. Bounds get an allowance far above rounding.
5. **Groups.** Query packs that lie together form groups, a few a core. A group's
   partition holds its query packs and, one after the other, every train pack that any
   of them needs; each is met by the queries that reach it with the k-th distance found
   so far, so lists are final. A query row moves once and a train row once a group at
   most: volume follows the number of rows, not that of pairs of packs.

What is broadcast: pivots (``MAX_PIVOTS`` rows) and one short row per pack
(``N / PACK_ROWS``), checked against the broadcast limit before it is collected;
beyond the limit the caller takes ``blocks``.
"""

from __future__ import annotations

import logging
import sys
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .brute import rank_neighbours, unit_hash
from .choose import parallelism
from .kernel import RunningTopK, Search
from .prepare import DIST, LABEL, QUERY_ID, TRAIN_ID, Prepared
from .vectorized import matrix, neighbour_schema, packed, unpacked, values

log = logging.getLogger(__name__)

MAX_PIVOTS = 1024
SAMPLE = 16_384
PACK_ROWS = 4_096
#: Rings of one pivot are cut at these steps of its distances.
RING_STEPS = 64
#: Query packs meet train in so many groups a core, of at most some ``GROUP_ROWS`` queries.
GROUPS_PER_CORE = 2
GROUP_ROWS = 1 << 17
#: Relative allowance of every geometric bound.
SLACK = 1e-9

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def centres(sample: np.ndarray, n: int, rounds: int = 6) -> np.ndarray:
    """At most ``n`` centres of a sample: far-apart starts, then Lloyd rounds."""
    points = np.unique(sample, axis=0)
    if len(points) <= n:
        return points
    rng = np.random.default_rng(7)
    start = points[rng.choice(len(points), n, replace=False)]
    for _ in range(rounds):
        near = nearest(points, start)[0]
        sums = np.zeros_like(start)
        np.add.at(sums, near, points)
        size = np.bincount(near, minlength=n)
        start = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], start)
    return np.unique(start, axis=0)


def distances(M: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(rows, pivots) distances by one product; rounding is covered by ``SLACK``
    of the norms, which callers add."""
    sq = (M * M).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2.0 * (M @ pivots.T)
    return np.sqrt(np.maximum(sq, 0.0, out=sq), out=sq)


def exact_distance(M: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Distance of each row to its own point, by differences."""
    diff = M - to
    return np.sqrt((diff * diff).sum(axis=1))


def nearest(M: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest pivot, distance to it) of each row, in bounded blocks."""
    at = np.empty(len(M), np.int64)
    step = max(1, 4_000_000 // max(1, len(pivots)))
    for s in range(0, len(M), step):
        at[s : s + step] = distances(M[s : s + step], pivots).argmin(axis=1)
    return at, exact_distance(M, pivots[at])


def chain(pivots: np.ndarray) -> np.ndarray:
    """Each pivot's place in a row in which one follows a near one."""
    between = distances(pivots, pivots)
    place, left, at = np.zeros(len(pivots), int), np.ones(len(pivots), bool), 0
    for i in range(len(pivots)):
        place[at], left[at] = i, False
        rest = np.flatnonzero(left)
        if len(rest):
            at = rest[between[at][rest].argmin()]
    return place


def reach(Q: np.ndarray, home: np.ndarray, bound: np.ndarray, pivots: np.ndarray, packs: dict[str, np.ndarray]) -> np.ndarray:
    """(queries, packs): whether a pack may hold a row within the query's bound."""
    used, p = np.unique(packs["pivot"], return_inverse=True)
    to = distances(Q, pivots[used])
    norms = np.sqrt((pivots * pivots).sum(axis=1))
    length = np.sqrt((Q * Q).sum(axis=1))
    size = length[:, None] + norms.max(initial=0.0)
    # products of near-equal vectors lose half of the digits: allow for it in absolute terms
    fuzz = 4.0 * np.sqrt((Q.shape[1] + 8) * 2.0**-52) * size
    own = exact_distance(Q, pivots[home])[:, None]
    gap = distances(pivots, pivots[used])[home]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (to * to - own * own) / (2.0 * gap)
    # too close to divide well: no bound
    plane = np.where(gap > 1e-2 * size, plane, -np.inf)
    with np.errstate(invalid="ignore"):
        low = np.maximum(np.maximum(to[:, p] - packs["high"][None, :], packs["low"][None, :] - to[:, p]), plane[:, p])
        # a value that is no number (overflow) prunes nothing
        return ~(low > bound[:, None] * (1.0 + SLACK) + fuzz)


def _assign(df: DataFrame, cols: list[str], pivots: np.ndarray) -> DataFrame:
    """The rows with their nearest pivot and the distance to it."""

    def run(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            if b.num_rows:
                at, dist = nearest(matrix(t, cols), pivots)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at.astype(np.int32)), pa.array(dist)], names=[*b.schema.names, "_p", "_d"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{kinds}, _p int, _d double")


def _rings(assigned: DataFrame, rows: int) -> list:
    """Per pivot the distances at which its rings end: at most ``MAX_PIVOTS``
    rows of at most ``RING_STEPS`` numbers, so bounded for the driver."""
    steps = [i / RING_STEPS for i in range(1, RING_STEPS)]
    per = assigned.groupBy("_p").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_d", steps, 10_000).alias("q"))
    out = []
    for r in per.collect():
        parts = -(-r["n"] // rows)
        rings = min(parts, RING_STEPS)
        cuts = [r["q"][RING_STEPS * i // rings - 1] for i in range(1, rings)]
        # more rows than the finest ring: the rest is cut by a hash
        out.append((r["_p"], sorted(set(cuts)), -(-parts // rings)))
    return out


def knn_pivots(
    p: Prepared, k: int, *, n_queries: int, n_train: int, broadcast_max_bytes: int, pivots: int | None = None, pack_rows: int = PACK_ROWS, counter=None
) -> DataFrame | None:
    """Exact k nearest train rows of every query, or None where the table of packs
    fails the size check. ``counter`` (a Spark accumulator) adds up the pairs whose
    filter value or distance was computed."""
    from pyspark.sql.pandas.types import to_arrow_schema

    if not n_train or not n_queries:
        return rank_neighbours(p.queries.sparkSession.createDataFrame([], neighbour_schema(p, False)), k)
    d = p.dim
    n_pivots = min(pivots or max(1, round(n_train**0.5 / 2)), MAX_PIVOTS, SAMPLE)
    if 64 * (n_train // pack_rows + 2 * n_pivots * RING_STEPS) > broadcast_max_bytes:
        return None
    sample = p.train.select(*p.tcols).orderBy(unit_hash(TRAIN_ID, 31)).limit(SAMPLE) if n_train > SAMPLE else p.train.select(*p.tcols)
    body = sample.toArrow()
    P = centres(matrix(body, p.tcols), n_pivots)
    log.info("pivots %d of %d train rows", len(P), n_train)

    # 2. train packs, kept for both rounds
    train = _assign(p.train.select(TRAIN_ID, LABEL, *p.tcols), p.tcols, P)
    train = checkpoint(train)
    rings = {r[0]: r[1:] for r in _rings(train, pack_rows)}

    def with_pack(df: DataFrame, key: str) -> DataFrame:
        """Adds ``_r`` (ring) and ``_s`` (part of a ring); small literal tables."""
        ends = F.create_map(*[x for q, (cuts, _) in rings.items() if cuts for x in (F.lit(q), F.array(*[F.lit(float(c)) for c in cuts]))]) if any(c for c, _ in rings.values()) else None
        ring = F.lit(0) if ends is None else F.size(F.filter(F.coalesce(ends[F.col("_p")], F.array().cast("array<double>")), lambda c: c < F.col("_d")))
        parts = {q: s for q, (_, s) in rings.items() if s > 1}
        part = F.lit(0)
        if parts:
            cut = F.coalesce(F.create_map(*[F.lit(x) for q, s in parts.items() for x in (q, s)])[F.col("_p")], F.lit(1))
            part = F.pmod(F.xxhash64(key), cut)
        return df.withColumn("_r", ring.cast("int")).withColumn("_s", part.cast("int"))

    tcols, qcols, exclude_self = p.tcols, p.qcols, p.exclude_self
    keys = ["_p", "_r", "_s"]

    def pack_train(table: pa.Table) -> pa.Table:
        dist = table.column("_d").to_numpy()
        one = {c: table.column(c).slice(0, 1) for c in keys}
        rows = packed(table.drop_columns([*keys, "_d"]).combine_chunks())
        return pa.table(one | {"low": [float(dist.min())], "high": [float(dist.max())], "n": [table.num_rows], "train": pa.array([rows], pa.binary())})

    packs = checkpoint(with_pack(train, TRAIN_ID).groupBy(*keys).applyInArrow(pack_train, "_p int, _r int, _s int, low double, high double, n long, train binary"))
    known = packs.select(*keys, "low", "high", "n").orderBy(*keys).toArrow()  # passed the size check
    table = {"pivot": known.column("_p").to_numpy(), "low": known.column("low").to_numpy(), "high": known.column("high").to_numpy()}
    number = {x: i for i, x in enumerate(zip(*(known.column(c).to_pylist() for c in keys)))}
    shared = p.queries.sparkSession.sparkContext.broadcast((P, table, number))

    # 3. queries, packed like train: those of one ring meet its first part
    queries = checkpoint(with_pack(_assign(p.queries.select(QUERY_ID, *p.qcols), p.qcols, P), QUERY_ID).drop("_s"))
    per_ring = checkpoint(queries.groupBy("_p", "_r").agg(F.count(F.lit(1)).alias("_n")))
    cuts = per_ring.select("_p", "_r", F.greatest(F.ceil(F.col("_n") / pack_rows), F.lit(1)).cast("int").alias("_cuts"))
    queries = queries.join(F.broadcast(cuts), ["_p", "_r"]).withColumn("_c", F.pmod(F.xxhash64(QUERY_ID, F.lit(5)), F.col("_cuts")).cast("int"))
    # a query pack has one home: a ring without train rows looks for its pivot's next one
    by_pivot: dict[int, list[tuple[int, int]]] = {}
    for (q, r, s), i in number.items():
        by_pivot.setdefault(q, []).append((r, i))

    def home_of(q: int, r: int) -> int:
        """The number of a pack next to ring r of pivot q (any pack if the pivot has none)."""
        near = by_pivot.get(q)
        return min(near, key=lambda x: (abs(x[0] - r), x[1]))[1] if near else 0

    # near query packs share a group; at most one short row a pack
    spark = p.queries.sparkSession
    groups = max(GROUPS_PER_CORE * parallelism(spark), -(-n_queries // GROUP_ROWS))
    place, homes, before = chain(P), [], 0
    rings_of = sorted(((x["_p"], x["_r"], x["_n"]) for x in per_ring.collect()), key=lambda x: (place[x[0]], x[1]))
    total = max(1, sum(n for _, _, n in rings_of))
    for q, r, n in rings_of:
        cut = max(1, -(-n // pack_rows))
        homes += [(q, r, c, home_of(q, r), groups * (before + n * c // cut) // total) for c in range(cut)]
        before += n
    home = spark.createDataFrame(homes, "_p int, _r int, _c int, _home int, _g int")
    numbers = spark.createDataFrame([(*x, i) for x, i in number.items()], "_p int, _r int, _s int, _t int")
    trains = packs.join(F.broadcast(numbers), keys).select("_t", "train")

    def pack_queries(t: pa.Table) -> pa.Table:
        one = {c: t.column(c).slice(0, 1) for c in ("_g", "_home")}
        return pa.table(one | {"query": pa.array([packed(t.select([QUERY_ID, "_p", *qcols]).combine_chunks())], pa.binary())})

    mine = queries.join(F.broadcast(home), ["_p", "_r", "_c"]).groupBy("_p", "_r", "_c", "_g", "_home").applyInArrow(pack_queries, "_g int, _home int, query binary")

    def bound_and_reach(batches):
        """Each query pack at home: bounds, and the packs it still has to meet."""
        for b in batches:
            out = []
            for query, train in zip(b.column("query"), b.column("train"), strict=True):
                pivot, table, _ = shared.value
                q, t = unpacked(query), unpacked(train)
                Q = matrix(q, qcols)
                s = Search(Q, values(q, QUERY_ID), k, exclude_self)
                s.push(matrix(t, tcols), values(t, TRAIN_ID), values(t, LABEL))
                if counter is not None:
                    counter.add(s.scored)
                bound = s.kth()
                step = max(1, 4_000_000 // max(1, len(table["pivot"])))
                needed = np.zeros(len(table["pivot"]), bool)
                home = q.column("_p").to_numpy()
                for a in range(0, len(Q), step):
                    needed |= reach(Q[a : a + step], home[a : a + step], bound[a : a + step], pivot, table).any(axis=0)
                out.append((packed(q.append_column("_b", pa.array(bound)).combine_chunks()), np.flatnonzero(needed).astype(np.int32)))
            bodies, needs = pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("_g"), bodies, needs], names=["_g", "query", "needs"])

    met = mine.join(trains.withColumnRenamed("_t", "_home"), "_home").select("_g", "query", "train").mapInArrow(bound_and_reach, "_g int, query binary, needs array<int>")
    met = checkpoint(met)

    # 5. a group's query packs (``_t`` is -1) and the train packs that they need
    asked = met.select("_g", F.explode("needs").alias("_t")).distinct()
    both = met.select("_g", F.lit(-1).alias("_t"), F.col("query").alias("body"), "needs").unionByName(
        asked.join(trains, "_t").select("_g", "_t", F.col("train").alias("body"), F.lit(None).cast("array<int>").alias("needs"))
    )
    both = both.repartitionById(groups, F.col("_g")).sortWithinPartitions("_g", "_t")
    out = neighbour_schema(p, with_rank=False)
    schema = to_arrow_schema(out)

    def meet(batches):
        for mine in grouped(batches):
            pivot, table, _ = shared.value
            packs = []
            for t, body, needs in mine:
                rows = unpacked(body)
                if t < 0:
                    packs.append(Pack(matrix(rows, qcols), values(rows, QUERY_ID), values(rows, "_p"), values(rows, "_b"), set(needs.as_py())))
                    continue
                one = {x: v[[t]] for x, v in table.items()}
                X, tid, lab = matrix(rows, tcols), values(rows, TRAIN_ID), values(rows, LABEL)
                for q in packs:
                    if t in q.needs:
                        scored = q.meet(X, tid, lab, k, exclude_self, lambda q, at, b: reach(q, at, b, pivot, one)[:, 0])  # noqa: B023
                        if counter is not None:
                            counter.add(scored)
            for q in packs:
                if q.lists is not None:
                    yield q.found(schema)

    # lists are final but for query ids that repeat, whose rows share one list
    return rank_neighbours(both.mapInArrow(meet, out), k)


def grouped(batches):
    """The rows (train pack or -1, body, needs) of one group after the other."""
    rows = (row for b in batches for row in zip(*(b.column(c).to_pylist() if c in ("_g", "_t") else b.column(c) for c in ("_g", "_t", "body", "needs")), strict=True))
    for _, mine in groupby(rows, key=lambda row: row[0]):
        yield (row[1:] for row in mine)


class Pack:
    """The queries of one pack with their lists so far."""

    def __init__(self, Q: np.ndarray, ids: np.ndarray, home: np.ndarray, bound: np.ndarray, needs: set[int]):
        # copies: views would keep the whole batch
        self.Q, self.ids, self.home, self.bound, self.needs = Q, ids.copy(), home.copy(), bound.copy(), needs
        self.lists: RunningTopK | None = None

    def meet(self, X: np.ndarray, tid: np.ndarray, lab: np.ndarray, k: int, exclude_self: bool, reached) -> int:
        """One train pack, met by the queries that reach it; the pairs looked at."""
        if self.lists is None:
            self.lists = RunningTopK(len(self.Q), k, tid.dtype, lab.dtype)
        bound = np.minimum(self.bound, self.lists.d[:, k - 1])
        at = np.flatnonzero(reached(self.Q, self.home, bound))
        if not len(at):
            return 0
        s = Search(self.Q[at], self.ids[at], k, exclude_self, bound[at])
        s.push(X, tid, lab)
        pos, _, ids, labels, dist = s.result()
        self.lists._merge(at[pos], dist, ids, labels)
        return s.scored

    def found(self, schema: pa.Schema) -> pa.RecordBatch:
        r, c = self.lists.hits()
        cols = {QUERY_ID: self.ids[r], TRAIN_ID: self.lists.i[r, c], LABEL: self.lists.lab[r, c], DIST: self.lists.d[r, c]}
        return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in schema], schema=schema)
