"""JOIN-1/2/3, TOP-1/2, AGG-3 and the contract rules C3, C5, C6, C10."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import nearframe as nf
from nearframe.plans.vectorized import RunningTopK
from tests.conftest import points

EXACT = ["broadcast", "broadcast_train", "bounded", "vectorized", "blocks", "grid"]


def brute(qrows, trows, k, exclude_self=False):
    """Reference answer by plain Python: sequential sum, (dist, id) order."""
    out = []
    for qid, *qf in qrows:
        cand = []
        for tid, *tf, lab in trows:
            if exclude_self and tid == qid:
                continue
            vals = [*qf, *tf]
            if lab is None or any(v is None or not math.isfinite(v) for v in vals):
                continue
            s = 0.0
            for a, b in zip(qf, tf):
                s += (a - b) * (a - b)
            cand.append((math.sqrt(s), tid, lab))
        cand.sort(key=lambda c: (c[0], c[1]))
        for r, (d, tid, lab) in enumerate(cand[:k], 1):
            out.append((qid, r, tid, lab, d))
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "train_id", "label", "dist").collect())


def random_points(n, seed, dup=0.0, grid=None):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        if out and rnd.random() < dup:
            _, a, b, _ = out[rnd.randrange(len(out))]
        elif grid:
            a, b = float(rnd.randrange(grid)), float(rnd.randrange(grid))
        else:
            a, b = rnd.uniform(-5, 5), rnd.gauss(0, 2)
        out.append((i, a, b, rnd.randrange(4)))
    return out


@pytest.mark.parametrize("strategy", EXACT)
def test_strategies_equal_brute_force(spark, strategy):
    data = random_points(300, 1, dup=0.1)
    df = points(spark, data).repartition(5)
    got = rows(nf.knn_join(df, df, ["f0", "f1"], 3, exclude_self=True, strategy=strategy))
    want = brute([(i, a, b) for i, a, b, _ in data], data, 3, exclude_self=True)
    assert got == want


@pytest.mark.parametrize("strategy", ["grid", "vectorized", "bounded"])
def test_integer_grid_ties_break_by_train_id(spark, strategy):
    """C3: many equal distances; the lower train id must win every tie."""
    data = random_points(400, 2, grid=6)
    df = points(spark, data)
    got = rows(nf.knn_join(df, df, ["f0", "f1"], 4, exclude_self=True, strategy=strategy))
    assert got == brute([(i, a, b) for i, a, b, _ in data], data, 4, exclude_self=True)


def test_separate_query_and_train_tables(spark):
    train = random_points(200, 3)
    queries = [(1000 + i, a + 0.3, b - 0.1) for i, a, b, _ in random_points(40, 4)]
    t = points(spark, train)
    q = spark.createDataFrame(queries, "id long, f0 double, f1 double")
    want = brute(queries, train, 5)
    for s in EXACT:
        assert rows(nf.knn_join(q, t, ["f0", "f1"], 5, strategy=s)) == want, s


def test_fewer_train_rows_than_k(spark):
    """C5: vote among the neighbours that exist."""
    t = points(spark, [(1, 0.0, 0.0, 1), (2, 1.0, 0.0, 2)])
    q = spark.createDataFrame([(10, 0.1, 0.0)], "id long, f0 double, f1 double")
    for s in EXACT:
        got = rows(nf.knn_join(q, t, ["f0", "f1"], 5, strategy=s))
        assert [(r[1], r[2]) for r in got] == [(1, 1), (2, 2)], s


def test_non_finite_and_null_never_rank(spark):
    """C6: NaN, infinity and null features or labels never become neighbours;
    a query with such a feature gets none (C7 brings it back in classify)."""
    inf, nan = float("inf"), float("nan")
    t = points(
        spark,
        [(1, nan, 0.0, 1), (2, inf, 0.0, 1), (3, None, 0.0, 1), (4, 5.0, 5.0, 2), (5, 6.0, 6.0, None), (6, 7.0, 7.0, 3)],
    )
    q = spark.createDataFrame([(10, 0.0, 0.0), (11, nan, 1.0), (12, None, 1.0)], "id long, f0 double, f1 double")
    for s in EXACT:
        got = rows(nf.knn_join(q, t, ["f0", "f1"], 3, strategy=s))
        assert [(r[0], r[2]) for r in got] == [(10, 4), (10, 6)], s
    pred = nf.knn_classify(q, t, ["f0", "f1"], 3).orderBy("query_id").collect()
    assert [(r.query_id, r.prediction) for r in pred] == [(10, 2), (11, None), (12, None)]


def test_width_and_k_are_checked(spark):
    """C10: k >= 1, equal widths, equal array lengths."""
    df = points(spark, [(1, 0.0, 0.0, 1)])
    with pytest.raises(ValueError):
        nf.knn_join(df, df, ["f0", "f1"], 0)
    with pytest.raises(ValueError):
        nf.knn_join(df, df, ["f0", "f1"], 3, train_features=["f0"])
    arr = spark.createDataFrame([(1, [0.0, 1.0], 1), (2, [0.0], 1)], "id long, v array<double>, label int")
    with pytest.raises(Exception):
        nf.knn_join(arr, arr, "v", 1, dim=2, strategy="broadcast").collect()


def test_array_features_and_float_arrays(spark):
    rnd = random.Random(5)
    data = [(i, [rnd.uniform(-1, 1) for _ in range(8)], rnd.randrange(3)) for i in range(120)]
    df = spark.createDataFrame(data, "id long, v array<float>, label int")
    f32 = [(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in data]
    want = brute([(i, *v) for i, v, _ in f32], [(i, *v, lab) for i, v, lab in f32], 3, exclude_self=True)
    for s in ["vectorized", "broadcast", "grid", "blocks"]:
        assert rows(nf.knn_join(df, df, "v", 3, exclude_self=True, strategy=s)) == want, s
    vt = nf.knn_join(df, df, "v", 3, exclude_self=True, strategy="vectorized", replicate="train")
    assert rows(vt) == want


def test_self_match_k1_returns_itself(spark):
    """T5: train as query with unique points, k=1 -> itself at distance 0."""
    data = random_points(150, 6)
    df = points(spark, data)
    got = rows(nf.knn_join(df, df, ["f0", "f1"], 1))
    assert all(r[0] == r[2] and r[4] == 0.0 for r in got) and len(got) == 150


def test_invariant_under_partitioning(spark):
    data = random_points(250, 7, dup=0.2)
    one = points(spark, data).coalesce(1)
    many = points(spark, data).repartition(13)
    a = rows(nf.knn_join(one, one, ["f0", "f1"], 3, exclude_self=True))
    b = rows(nf.knn_join(many, many.orderBy(F.desc("id")), ["f0", "f1"], 3, exclude_self=True))
    assert a == b


def test_hot_cell_is_salted(spark, monkeypatch):
    """A third of the rows in one tiny region: the hot-cell path (salting)
    must give the exact answer."""
    import nearframe.plans.grid as G

    monkeypatch.setattr(G, "HOT_ROWS", 20)
    rnd = random.Random(8)
    data = [(i, rnd.uniform(0, 0.01), rnd.uniform(0, 0.01), rnd.randrange(3)) for i in range(100)]
    data += [(100 + i, rnd.uniform(-50, 50), rnd.uniform(-50, 50), rnd.randrange(3)) for i in range(200)]
    df = points(spark, data)
    got = rows(nf.knn_join(df, df, ["f0", "f1"], 3, exclude_self=True, strategy="grid"))
    assert got == brute([(i, a, b) for i, a, b, _ in data], data, 3, exclude_self=True)


def test_hot_cells_without_broadcast(spark, monkeypatch):
    """Same skew with a byte limit too small for any broadcast: the hot-cell
    lookup and the coarse sample go through shuffle joins, same answer."""
    import nearframe.plans.grid as G

    monkeypatch.setattr(G, "HOT_ROWS", 20)
    rnd = random.Random(9)
    data = [(i, rnd.uniform(0, 0.01), rnd.uniform(0, 0.01), rnd.randrange(3)) for i in range(100)]
    data += [(100 + i, rnd.uniform(-50, 50), rnd.uniform(-50, 50), rnd.randrange(3)) for i in range(200)]
    df = points(spark, data)
    nb = nf.knn_join(df, df, ["f0", "f1"], 3, exclude_self=True, strategy="grid", broadcast_max_bytes=1)
    assert rows(nb) == brute([(i, a, b) for i, a, b, _ in data], data, 3, exclude_self=True)


def test_exact_duplicates_collapse(spark):
    """One point holding most rows: duplicates beyond the kk lowest ids are
    dropped before the search and the result is still exact."""
    data = [(i, 1.0, 1.0, i % 3) for i in range(300)] + [(300 + i, float(i), 2.0, 1) for i in range(30)]
    df = points(spark, data)
    got = rows(nf.knn_join(df, df, ["f0", "f1"], 3, exclude_self=True, strategy="grid"))
    assert got == brute([(i, a, b) for i, a, b, _ in data], data, 3, exclude_self=True)


def test_merge_top_k_is_exact(spark):
    """T4: the reference's merge kept [1,3,4] for [1,5,9] + [2,3,4]."""
    a = spark.createDataFrame([(1, r, 10 + r, 0, float(d)) for r, d in enumerate([1, 5, 9], 1)], "query_id long, rank long, train_id long, label int, dist double")
    b = spark.createDataFrame([(1, r, 20 + r, 0, float(d)) for r, d in enumerate([2, 3, 4], 1)], "query_id long, rank long, train_id long, label int, dist double")
    got = [r.dist for r in nf.merge_top_k([a, b], 3).orderBy("rank").collect()]
    assert got == [1.0, 2.0, 3.0]


def test_running_top_k_new_minimum():
    """T4: a new minimum into [a, b, d] must give [x, a, b] (the reference's
    GPU insert produced [x, a, x])."""
    st = RunningTopK(1, 3, np.int64, np.int64)
    st.push(np.array([[1.0, 2.0, 4.0]]), np.array([1, 2, 4]), np.array([0, 0, 0]))
    st.push(np.array([[0.5]]), np.array([9]), np.array([1]))
    assert st.d.tolist() == [[0.5, 1.0, 2.0]] and st.i.tolist() == [[9, 1, 2]]


def test_top_k_per_group_and_lists_roundtrip(spark):
    data = random_points(60, 9)
    df = points(spark, data)
    nb = nf.knn_join(df, df, ["f0", "f1"], 3, exclude_self=True)
    back = nf.lists_to_neighbours(nf.neighbours_to_lists(nb))
    assert rows(back) == rows(nb)
    top = nf.top_k_per_group(df, "label", [F.col("f0").desc(), "id"], 2)
    assert top.groupBy("label").count().where("count > 2").count() == 0


def test_attach_labels(spark):
    data = random_points(50, 10)
    df = points(spark, data)
    nb = nf.knn_join(df, df, ["f0", "f1"], 2, exclude_self=True)
    again = nf.attach_labels(nb.drop("label"), df)
    assert rows(again) == rows(nb)


def test_pairwise_distances(spark):
    q = spark.createDataFrame([(1, 0.0, 0.0)], "id long, f0 double, f1 double")
    t = points(spark, [(2, 3.0, 4.0, 1), (3, 1.0, 0.0, 1)])
    got = sorted((r.train_id, r.dist) for r in nf.pairwise_distances(q, t, ["f0", "f1"]).collect())
    assert got == [(2, 5.0), (3, 1.0)]
    sq = sorted(r.sq_dist for r in nf.pairwise_distances(q, t, ["f0", "f1"], squared=True).collect())
    assert sq == [1.0, 25.0]


def test_running_top_k_exact_under_heavy_ties_and_any_split():
    """S3 state: equals a full (dist, train_id) sort for integer grids with
    many ties, unsorted ids, NaN rows and random batch boundaries."""
    from nearframe.plans.vectorized import squared_block

    rng = np.random.default_rng(7)
    for _ in range(200):
        nq, n, d, k = rng.integers(1, 20), rng.integers(1, 120), rng.integers(1, 3), int(rng.integers(1, 6))
        Q = rng.integers(0, 4, size=(nq, d)).astype(float)
        X = rng.integers(0, 4, size=(n, d)).astype(float)
        X[rng.integers(0, n)] = np.nan
        tid = rng.permutation(n * 3)[:n].astype(np.int64)
        lab = rng.integers(0, 5, size=n)
        D = np.sqrt(squared_block(Q, X))
        st = RunningTopK(nq, k, tid.dtype, lab.dtype)
        cuts = [0, *np.sort(rng.integers(0, n + 1, size=rng.integers(0, 4))), n]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                st.push(D[:, a:b], tid[a:b], lab[a:b])
        for qi in range(nq):
            want = sorted((D[qi, j], tid[j]) for j in range(n) if np.isfinite(D[qi, j]))[:k]
            got = [(st.d[qi, c], st.i[qi, c]) for c in range(k) if np.isfinite(st.d[qi, c])]
            assert got == want
