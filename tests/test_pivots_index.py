"""Pivot search, the matrix-product filter, the stored index, range pairs, updates
of neighbour lists, row ids by position, observed summaries, ML vectors and sparse
ARFF rows, each against brute force or the plain route."""

import io
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import nearframe as nf
from nearframe.operators.ml import NearestNeighbours, NearestNeighboursModel
from nearframe.operators.shape import assemble, with_row_id
from nearframe.plans import grid, kernel, pivots
from nearframe.sources import read_points_arff, write_points_arff

from tests.conftest import SF


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def brute(Q, X, qids, tids, k, exclude_self):
    D = kernel.root_block(Q, X)
    if exclude_self:
        D[qids[:, None] == tids[None, :]] = np.inf
    out = []
    for i in range(len(Q)):
        order = np.lexsort((tids, D[i]))[:k]
        out += [(int(qids[i]), r + 1, int(tids[j]), float(D[i, j])) for r, j in enumerate(order) if np.isfinite(D[i, j])]
    return out


# ------------------------------------------------------------------ kernel
@pytest.mark.parametrize("d", [1, 7, 8, 64, 200])
@pytest.mark.parametrize("kind", ["plain", "ties", "far", "tiny", "mixed"])
def test_filter_gives_the_bits_of_the_plain_block(d, kind):
    rng = np.random.default_rng(d)
    X = rng.normal(size=(700, d))
    if kind == "ties":
        X = np.round(X)
        X[::3] = X[0]
    elif kind == "far":
        X = X + 1e9  # norms far above the distances: all digits cancel
    elif kind == "tiny":
        X = X * 1e-160
    elif kind == "mixed":
        X = X * 10.0 ** rng.integers(-8, 155, size=(700, 1))
    ids = rng.permutation(700)
    for exclude in (False, True):
        s = kernel.Search(X, ids, 4, exclude)
        for a in range(0, 700, 150):
            s.push(X[a : a + 150], ids[a : a + 150], ids[a : a + 150] % 5)
        pos, rank, tid, lab, dist = s.result()
        got = sorted(zip(ids[pos].tolist(), rank.tolist(), tid.tolist(), dist.tolist()))
        with np.errstate(over="ignore"):
            assert got == sorted(brute(X, X, ids, ids, 4, exclude))


def test_filter_with_ids_of_any_type_and_repeated():
    rng = np.random.default_rng(1)
    X = rng.normal(size=(90, 16))
    ids = np.array([f"id{i % 60}" for i in range(90)], object)
    r, c = kernel.same_ids(ids, ids)
    assert sorted(zip(r.tolist(), c.tolist())) == [(i, j) for i in range(90) for j in range(90) if ids[i] == ids[j]]
    n = np.arange(90) % 60
    assert sorted(zip(*(x.tolist() for x in kernel.same_ids(n, n)))) == sorted(zip(r.tolist(), c.tolist()))
    s = kernel.Search(X, ids, 2, True)
    s.push(X, ids, np.arange(90))
    pos, _, tid, _, _ = s.result()
    assert len(pos) == 180 and all(ids[p] != t for p, t in zip(pos, tid))


# ------------------------------------------------------------------ pivots
def clustered(spark, n=6000, d=16, centres=30, seed=0):
    rng = np.random.default_rng(seed)
    C = rng.normal(size=(centres, d)) * 5
    L = rng.integers(0, centres, n)
    L[: n // 3] = 0  # a third of all rows in one cluster
    X = C[L] + rng.normal(size=(n, d)) * 0.3
    X[: n // 10] = X[0]  # and many on one point
    return spark.createDataFrame([(i, x.tolist(), int(c)) for i, (x, c) in enumerate(zip(X, L))], "id long, v array<double>, label int").repartition(3).cache()


def test_pivots_equal_blocks_and_score_few_pairs(spark):
    df = clustered(spark)
    pairs = spark.sparkContext.accumulator(0)
    got = rows_of(nf.knn_join(df, df, "v", 3, exclude_self=True, strategy="pivots", pack_rows=300, counter=pairs))
    assert got == rows_of(nf.knn_join(df, df, "v", 3, exclude_self=True, strategy="blocks"))
    n = df.count()
    assert 0 < pairs.value < 0.5 * n * n
    df.unpersist()


@pytest.mark.parametrize("n_train", [0, 1, 2, 500])
def test_pivots_small_and_strange(spark, n_train):
    rng = np.random.default_rng(3)
    q = [(i, (rng.normal(size=9) * 10.0 ** int(rng.integers(-3, 4))).tolist()) for i in range(120)] + [(900, None), (901, [float("nan")] * 9), (902, [1e200] * 9)]
    t = [(i, (rng.normal(size=9) * 10.0 ** int(rng.integers(-3, 4))).tolist(), "a") for i in range(n_train)] + [(5000, [float("inf")] * 9, "b"), (5001, [0.0] * 9, None)]
    queries = spark.createDataFrame(q, "id long, v array<double>")
    train = spark.createDataFrame(t, "id long, v array<double>, label string")
    a = rows_of(nf.knn_join(queries, train, "v", 4, strategy="pivots", pack_rows=20, pivots=12))
    assert a == rows_of(nf.knn_join(queries, train, "v", 4, strategy="broadcast"))


def test_reach_never_leaves_out_a_row_within_the_bound():
    rng = np.random.default_rng(5)
    for scale in (1.0, 1e-6, 1e6):
        X, Q = rng.normal(size=(800, 12)) * scale + scale * 100, rng.normal(size=(60, 12)) * scale + scale * 100
        P = pivots.centres(X, 15)
        at, dist = pivots.nearest(X, P)
        home, _ = pivots.nearest(Q, P)
        D = kernel.root_block(Q, X)
        bound = np.sort(D, axis=1)[:, 4]
        packs = [np.flatnonzero(at == p) for p in range(len(P))]
        packs = [(p, x) for p, x in enumerate(packs) if len(x)]
        table = {"pivot": np.array([p for p, _ in packs]), "low": np.array([dist[x].min() for _, x in packs]), "high": np.array([dist[x].max() for _, x in packs])}
        near = pivots.reach(Q, home, bound, P, table)
        for j, (_, x) in enumerate(packs):
            assert near[(D[:, x] <= bound[:, None]).any(axis=1), j].all()


def test_auto_beyond_the_limit_goes_by_pivots(spark):
    df = clustered(spark, n=900)
    a = rows_of(nf.knn_join(df, df, "v", 2, exclude_self=True, broadcast_max_bytes=100_000))
    assert a == rows_of(nf.knn_join(df, df, "v", 2, exclude_self=True, strategy="vectorized"))
    # a table of packs that does not fit: blocks
    assert a == rows_of(nf.knn_join(df, df, "v", 2, exclude_self=True, strategy="pivots", broadcast_max_bytes=10))
    df.unpersist()


def test_no_side_through_the_drivers_pandas():
    import inspect

    from nearframe.plans import index, tiles, vectorized

    for module in (vectorized, tiles, pivots, grid, index):
        assert "toPandas" not in inspect.getsource(module)


# ------------------------------------------------------------------ grid: hot points and cells
def test_grid_with_a_third_of_all_queries_on_one_point(spark, monkeypatch):
    monkeypatch.setattr(grid, "BUSY_ROWS", 50)
    monkeypatch.setattr(grid, "HOT_QUERIES", 60)
    monkeypatch.setattr(grid, "HOT_ROWS", 100)
    rng = np.random.default_rng(2)
    n = 3000
    X = np.round(rng.normal(size=(n, 2)), 2)
    X[: n // 3] = (0.5, 0.25)
    X[n // 3 : n // 2] = np.round(X[n // 3 : n // 2] / 50, 4)  # a dense spot
    ids = rng.permutation(n)
    df = spark.createDataFrame([(int(i), float(a), float(b), int(i) % 7) for i, (a, b) in zip(ids, X)], "id long, f0 double, f1 double, label int").cache()
    want = sorted(brute(X, X, ids, ids, 3, True))
    got = nf.knn_join(df, df, ["f0", "f1"], 3, exclude_self=True, strategy="grid")
    assert sorted((r["query_id"], r["rank"], r["train_id"], r["dist"]) for r in got.collect()) == want
    # another table as train, some of it on the same point, and queries that are not in it
    q = df.select((F.col("id") + 10_000).alias("id"), "f0", "f1")
    got = nf.knn_join(q, df, ["f0", "f1"], 3, strategy="grid")
    assert sorted((r["query_id"] - 10_000, r["rank"], r["train_id"], r["dist"]) for r in got.collect()) == sorted(brute(X, X, ids, ids, 3, False))
    df.unpersist()


def test_cell_expression_is_monotone(spark):
    rng = np.random.default_rng(4)
    x = np.sort(np.concatenate([rng.normal(size=500) * 10.0 ** rng.integers(-5, 6, 500), [0.0, -0.0, 1e300, -1e300, 5e-324]]))
    q = sorted(set(np.quantile(x, grid.QUANTILES).tolist()))
    knots = [(a, b, 1.0 / (len(q) - 1)) for a, b in zip(q, q[1:])]
    df = spark.createDataFrame([(float(v),) for v in x], "x double").coalesce(1)
    for m in (1, 2, 17, 1000, 10**9):
        cells = [r[0] for r in df.select(F.expr(grid._cell("x", knots, m))).collect()]
        assert cells == sorted(cells) and 0 <= cells[0] and cells[-1] <= m - 1


# ------------------------------------------------------------------ stored index
def test_index_answers_like_the_plain_join(spark, tmp_path):
    rng = np.random.default_rng(6)
    n = 2500
    X = np.round(rng.normal(size=(n, 2)), 2)
    X[:900] = (1.0, 2.0)
    df = spark.createDataFrame([(i, float(a), float(b), i % 5) for i, (a, b) in enumerate(X)], "id long, f0 double, f1 double, label int")
    built = nf.build_index(df, ["f0", "f1"], str(tmp_path / "index"), 3, exclude_self=True)
    want = rows_of(nf.knn_join(df, df, ["f0", "f1"], 3, exclude_self=True, strategy="broadcast"))
    for index in (built, nf.load_index(spark, str(tmp_path / "index"))):
        assert rows_of(nf.knn_join(df, None, ["f0", "f1"], 3, exclude_self=True, index=index)) == want
    other = df.where("id % 3 = 0").select((F.col("id") + 7).alias("id"), (F.col("f0") + 0.1).alias("f0"), "f1")
    assert rows_of(nf.knn_join(other, None, ["f0", "f1"], 4, index=built)) == rows_of(nf.knn_join(other, df, ["f0", "f1"], 4, strategy="broadcast"))
    with pytest.raises(ValueError, match="too few"):
        nf.knn_join(df, None, ["f0", "f1"], 4, exclude_self=True, index=built)
    with pytest.raises(ValueError, match="width"):
        nf.knn_join(df, None, ["f0"], 2, index=built)


def test_index_is_joined_without_an_exchange_of_train(spark, tmp_path):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("id", F.monotonically_increasing_id())
    index = nf.build_index(li, ["l_extendedprice", "l_quantity"], str(tmp_path / "index"), 3, label="l_returnflag")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        q = spark.range(50).selectExpr("id", "id % 7 AS _c0", "id % 5 AS _c1", "cast(id % 2 as int) AS _salt")
        txt = plan(q.join(index.grid.part, ["_c0", "_c1", "_salt"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Bucketed: true" in txt
    # one exchange only: that of the queries
    tree = txt[: txt.index("\n\n\n")]
    assert tree.count("Exchange") == 1 and "SortMergeJoin" in tree


# ------------------------------------------------------------------ pairs within a radius
@pytest.mark.parametrize("radius", [0.0, 0.05, 0.7])
@pytest.mark.parametrize("d", [1, 2, 4])
def test_pairs_within(spark, radius, d, monkeypatch):
    monkeypatch.setattr(grid, "HOT_ROWS", 80)
    monkeypatch.setattr(grid, "HOT_QUERIES", 80)
    rng = np.random.default_rng(d)
    X = np.round(rng.normal(size=(500, d)) * 2, 2)
    X[:150] = X[0]
    cols = [f"f{j}" for j in range(d)]
    data = [(i, *map(float, x)) for i, x in enumerate(X)] + [(900, *[float("nan")] * d), (901, *[None] * d)]
    df = spark.createDataFrame(data, "id long, " + ", ".join(f"{c} double" for c in cols))
    D = kernel.root_block(X, X)
    want = sorted((i, j, float(D[i, j])) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(D <= radius))) if i != j)
    assert rows_of(nf.pairs_within(df, df, cols, radius, exclude_self=True)) == want
    txt = plan(nf.pairs_within(df, df, cols, radius))
    assert "CartesianProduct" not in txt and "NestedLoopJoin" not in txt


def test_pairs_within_at_rounding_edges(spark):
    # distances that equal the radius, cells far from zero
    df = spark.createDataFrame([(i, 1e8 + i * 0.1) for i in range(200)], "id long, f double")
    x = np.array([[1e8 + i * 0.1] for i in range(200)])
    D = kernel.root_block(x, x)
    for radius in (0.1, float(D[0, 1]), float(D[5, 8])):
        want = sorted((i, j, float(D[i, j])) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(D <= radius))))
        assert rows_of(nf.pairs_within(df, df, ["f"], radius)) == want
    with pytest.raises(ValueError):
        nf.pairs_within(df, df, ["f"], -1.0)


# ------------------------------------------------------------------ lists kept up to date
@pytest.mark.parametrize("d", [2, 12])
def test_update_neighbours(spark, d):
    rng = np.random.default_rng(d)
    X = np.round(rng.normal(size=(600, d)), 1)
    cols = [f"f{j}" for j in range(d)]
    df = spark.createDataFrame([(i, *map(float, x), i % 4) for i, x in enumerate(X)], "id long, " + ", ".join(f"{c} double" for c in cols) + ", label int")
    old, new, few = df.where("id < 300"), df.where("id >= 300"), df.where("id in (1, 2)")
    full = rows_of(nf.knn_join(df, df, cols, 3, exclude_self=True, strategy="broadcast"))
    stored = nf.knn_join(df, old, cols, 3, exclude_self=True)
    assert rows_of(nf.update_neighbours(stored, df, new, cols, 3, exclude_self=True)) == full
    # lists that are not full, queries without any, and a batch without rows
    short = nf.knn_join(df, few, cols, 3, exclude_self=True)
    assert rows_of(nf.update_neighbours(short, df, df.where("id not in (1, 2)"), cols, 3, exclude_self=True)) == full
    assert rows_of(nf.update_neighbours(stored, df, new.limit(0), cols, 3, exclude_self=True)) == rows_of(stored)


# ------------------------------------------------------------------ ids by position
def test_row_ids_by_position(spark, tmp_path):
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    df.repartitionByRange(5, "id").write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    got = with_row_id(read, "row", by="position", start=0)
    rows = [(r["_f"], r["row"], r["id"]) for r in got.join(read.select("id", F.col("_metadata.file_path").alias("_f")), "id").collect()]
    assert sorted(r[1] for r in rows) == list(range(1000))
    # files by path, rows of a file in their order
    assert [r[2] for r in sorted(rows, key=lambda r: r[1])] == [r[2] for r in sorted(rows, key=lambda r: (r[0], r[2]))]
    txt = plan(got)
    assert "Exchange hashpartitioning" not in txt and "rangepartitioning" not in txt and "Sort" not in txt
    assert with_row_id(read.where("id < 0"), "row", by="position").count() == 0
    with pytest.raises(ValueError):
        with_row_id(read, "row", ["id"], by="position")


# ------------------------------------------------------------------ observed summary
def test_summary_in_the_pass_of_the_write(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i % 10), i % 3) for i in range(60)], "id long, f double, label int")
    pred = nf.knn_classify(df, df, ["f"], 3, label="label", query_label="label", exclude_self=True)
    want = nf.evaluation_summary(pred, df, 3).collect()
    ran = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            ran.add(b.num_rows)
            yield b

    for fmt in ("csv", "tsv"):
        ran.value = 0
        watched = pred.mapInArrow(counted, pred.schema)
        assert nf.write_evaluated(watched, str(tmp_path / fmt), df, 3, fmt).collect() == want
        assert ran.value == 60  # every prediction was made once
        assert rows_of(nf.read_predictions(spark, str(tmp_path / fmt), fmt)) == rows_of(pred.select("query_id", "prediction"))


# ------------------------------------------------------------------ ML vectors
def test_vectors_as_features_and_model(spark, tmp_path):
    rng = np.random.default_rng(9)
    data = [(i, *map(float, np.round(rng.normal(size=3), 1) * (rng.random(3) > 0.4)), i % 3) for i in range(200)]
    df = spark.createDataFrame(data, "id long, a double, b double, c double, label int")
    dense = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)  # sparse where zeros prevail
    mine = assemble(df, ["a", "b", "c"], keep=["id", "label"], form="vector")
    want = rows_of(nf.knn_join(df, df, ["a", "b", "c"], 3, exclude_self=True))
    for rows in (dense, mine):
        assert rows_of(nf.knn_join(rows, rows, "features", 3, exclude_self=True)) == want
    odd = spark.createDataFrame([(0, Vectors.sparse(3, {1: 2.0}), 1), (1, Vectors.dense([0.0, 2.0, 0.0]), 2), (2, None, 1), (3, Vectors.dense([0.0, float("nan"), 1.0]), 1)], ["id", "features", "label"])
    assert rows_of(nf.knn_join(odd, odd, "features", 3)) == [(0, 1, 0, 1, 0.0), (0, 2, 1, 2, 0.0), (1, 1, 0, 1, 0.0), (1, 2, 1, 2, 0.0)]
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"), NearestNeighbours(k=1)])
    model = pipe.fit(df)
    assert rows_of(model.transform(df).select("id", "a", "b", "c", "label")) == rows_of(df)  # every row once
    nearest = NearestNeighbours(k=3, predictionCol="guess").fit(dense)
    nearest.save(str(tmp_path / "model"))
    loaded = NearestNeighboursModel.load(str(tmp_path / "model"))
    q = dense.select("id", "features")
    got = rows_of(loaded.transform(q).select("id", "guess"))
    assert got == rows_of(nearest.transform(q).select("id", "guess"))
    direct = nf.knn_classify(df, df, ["a", "b", "c"], 3, label="label")
    # the model orders equal distances by a digest, not by an id
    same = sum(a == b for a, b in zip(got, rows_of(direct)))
    assert len(got) == 200 and same > 150
    NearestNeighbours(k=5).save(str(tmp_path / "estimator"))
    assert NearestNeighbours.load(str(tmp_path / "estimator")).getOrDefault("k") == 5


# ------------------------------------------------------------------ sparse ARFF
HEADER = "@relation r\n@attribute a numeric\n@attribute 'b c' integer\n@attribute kind {red, 'dark blue', green}\n@attribute note string\n@attribute class {2,5}\n@data\n"


def test_arff_sparse_and_dense_rows(spark, tmp_path):
    folder = tmp_path / "arff"
    folder.mkdir()
    (folder / "x.arff").write_text(HEADER + "1.5,2,red,'hi',5\n{0 3.5, 2 'dark blue', 4 5}\n{}\n  { 1 7 ,3 'it\\'s, {odd}' }\n% none\n\n{0 ?, 4 5}\n")
    got = read_points_arff(spark, str(folder)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([
        (1.5, 2, "red", "'hi'" if got[0][3] == "'hi'" else "hi", 5), (3.5, 0, "dark blue", None, 5), (0.0, 0, "red", None, 2), (0.0, 7, "red", "it's, {odd}", 2), (None, 0, "red", None, 5),
    ], key=repr)


@pytest.mark.parametrize("row", ["{0 1.5, 0 2.5}", "{9 1}", "{0 x}", "{0 1.5", "{0}", "{a 1}"])
def test_arff_malformed_sparse_rows_fail(spark, tmp_path, row):
    (tmp_path / "x.arff").write_text(HEADER + row + "\n")
    with pytest.raises(Exception):
        read_points_arff(spark, str(tmp_path)).collect()


def test_arff_sparse_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(0.0, 0, "x y", 1), (None, 3, "it's \\ {a}, b", 2), (-1.5, None, None, 1)], "a double, b long, s string, n int")
    write_points_arff(df, str(tmp_path / "s"), sparse=True)
    back = read_points_arff(spark, str(tmp_path / "s")).select("a", "b", "s", F.col("n").cast("int").alias("n"))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
