"""What large tables broke: plans and memory that grow with the input."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

import nearframe as nf
from nearframe.plans import vectorized


def points(spark, X, label=0):
    names = [f"f{j}" for j in range(X.shape[1])]
    schema = "id long, " + ", ".join(f"{n} double" for n in names) + ", label int"
    return spark.createDataFrame([(i, *map(float, x), label) for i, x in enumerate(X)], schema), names


def test_range_pairs_are_never_broadcast(spark):
    X = np.random.default_rng(1).random((300, 2)) * 5
    df, names = points(spark, X)
    got = nf.pairs_within(df, df, names, 0.5, query_id="id", exclude_self=True)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    want = {(i, j) for i in range(300) for j in range(300) if i != j and np.sqrt((X[i, 0] - X[j, 0]) ** 2 + (X[i, 1] - X[j, 1]) ** 2) <= 0.5}
    assert {(r["query_id"], r["train_id"]) for r in got.collect()} == want


def test_packs_are_searched_one_at_a_time():
    made, seen = [], []

    class Search:
        def __init__(self, name):
            made.append(name)

        def push(self, block):
            seen.append(block)

    def rows():
        for pack, block in itertools.product("ab", range(3)):
            seen.append((pack, block))
            yield pack, pack if block == 0 else None, block, block

    found = vectorized.search_packs(rows(), Search, lambda block: (block,))
    next(found)
    # the second pack's search is not made before the first one is given out
    assert made == ["a"] and seen[-1] == ("b", 0)
    assert len(list(found)) == 1 and made == ["a", "b"]


def test_pivot_groups_move_train_once_a_group(spark, monkeypatch):
    from nearframe.plans import pivots

    X = np.random.default_rng(3).normal(size=(600, 12))
    df = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(X)], "id long, v array<double>, label int")
    monkeypatch.setattr(pivots, "GROUPS_PER_CORE", 1)
    args = {"query_id": "id", "label": "label", "exclude_self": True}
    got = nf.knn_join(df, df, "v", 3, strategy="pivots", pack_rows=20, pivots=30, **args)
    # no prunable rows here: nearly every pair of packs meets, in one pass a group
    plan = got._jdf.queryExecution().toString()
    assert "CoGroup" not in plan and "REPARTITION_BY_NUM" in plan
    want = nf.knn_join(df, df, "v", 3, strategy="blocks", **args)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("copies", [1, 60])
def test_chunks_equal_brute_force(spark, monkeypatch, copies):
    from nearframe.plans import chunks

    monkeypatch.setattr(chunks, "LEAST_ROWS", 200)
    rng = np.random.default_rng(copies)
    X = np.repeat(np.column_stack([rng.integers(1, 20, 3000 // copies), (rng.random(3000 // copies) * 900).round(2)]).astype(float), copies, axis=0)
    df, names = points(spark, X)
    got = nf.knn_join(df, df, names, 3, query_id="id", label="label", exclude_self=True, strategy="grid")

    rows = {}
    for r in sorted(got.collect(), key=lambda r: (r["query_id"], r["rank"])):
        rows.setdefault(r["query_id"], []).append((r["train_id"], r["dist"]))
    for i in range(0, 3000, 7):
        D = np.sqrt((X[i, 0] - X[:, 0]) ** 2 + (X[i, 1] - X[:, 1]) ** 2)
        D[i] = np.inf
        assert rows[i] == [(int(j), float(D[j])) for j in np.lexsort((np.arange(len(X)), D))[:3]]


def test_chunk_searches_score_few_rows():
    """Equal points and all: a query looks at the leaves in reach, not at its chunk."""
    from nearframe.plans.chunks import BLOCK, Leaves, in_halves

    X = np.random.default_rng(5).random((20_000, 3))
    tree, scored = Leaves(X, np.arange(len(X))), []
    whole = tree._squares
    tree._squares = lambda Q, q, leaf: scored.append(len(q)) or whole(Q, q, leaf)
    at = in_halves(X, BLOCK)[:BLOCK]
    q, row, _ = tree.search(X[at], at, 3, np.full(len(at), np.inf))
    assert len(q) == 3 * len(at) and not (row == at[q]).any()
    assert sum(scored) < 40 * len(at) < len(tree.row) * len(at)


def brute_lists(X, Q, ids, qids, k, exclude_self, labelled):
    out = set()
    for q, x in zip(qids, Q):
        D = np.zeros(len(X))
        for j in range(X.shape[1]):
            D = D + (x[j] - X[:, j]) ** 2
        D = np.sqrt(D)
        use = [i for i in np.lexsort((ids, D)) if labelled[i] and not (exclude_self and ids[i] == q)]
        out |= {(q, r + 1, ids[i], float(D[i])) for r, i in enumerate(use[:k])}
    return out


@pytest.mark.parametrize("case", ["crowd", "twice", "often", "unlabelled", "two tables", "crowd of queries", "plain"])
def test_chunks_of_odd_tables(spark, monkeypatch, case):
    """Crowded points, ids that repeat, rows without a label, cut chunks, balls that reach
    other chunks: the lists are those of brute force."""
    from nearframe.plans import chunks

    for name, n in (("LEAST_ROWS", 100), ("CHUNK_ROWS", 100), ("CROWD", 10), ("PACK_ROWS", 300), ("FEW", 4)):
        monkeypatch.setattr(chunks, name, n)
    rng = np.random.default_rng(8)
    n = 900
    X = np.column_stack([rng.integers(1, 12, n), (rng.random(n) * 50).round(1)]).astype(float)
    ids = np.arange(n)
    if case.startswith("crowd"):
        X[rng.choice(n, n // 2, replace=False)] = [5.0, 25.0]
    if case in ("twice", "often"):
        times = 2 if case == "twice" else 9
        X, ids = np.repeat(X[: n // times], times, axis=0), np.repeat(ids[: n // times], times)
    labelled = np.arange(len(X)) % 5 > 0 if case == "unlabelled" else np.ones(len(X), bool)
    cols = "id long, f0 double, f1 double, label int"
    train = spark.createDataFrame([(int(i), *map(float, x), int(i) % 3 if ok else None) for i, x, ok in zip(ids, X, labelled)], cols)
    queries, Q, qids, exclude = train, X, ids, True
    if case in ("two tables", "crowd of queries"):
        Q = np.concatenate([X[:200] + 0.03, np.full((400 if case == "crowd of queries" else 5, 2), 7.01)])
        qids, exclude = np.arange(len(Q)), False
        queries = spark.createDataFrame([(int(i), *map(float, x), 0) for i, x in zip(qids, Q)], cols)
    args = {"query_id": "id", "train_id": "id", "label": "label", "exclude_self": exclude, "strategy": "grid"}
    want = brute_lists(X, Q, ids, qids, 3, exclude, labelled)
    for dedupe in (True, False):
        got = nf.knn_join(queries, train, ["f0", "f1"], 3, dedupe=dedupe, **args)
        assert {(r["query_id"], r["rank"], r["train_id"], r["dist"]) for r in got.collect()} == want
        assert all(r["label"] == r["train_id"] % 3 for r in got.select("label", "train_id").distinct().collect())


def test_chunk_searches_equal_rows_once():
    import pyarrow as pa

    from nearframe.plans.chunks import Chunk

    X = np.repeat(np.random.default_rng(2).random((500, 2)), 40, axis=0)
    rows = pa.table({"id": np.arange(len(X)), "x0": X[:, 0], "x1": X[:, 1], "label": np.zeros(len(X), int)})
    chunk = Chunk(rows.select(["id", "x0", "x1"]), rows, 2, 3, True)
    assert len(chunk.at) == 500 and len(chunk.row) == 4 * 500
    found = [chunk.search(at, np.full(len(at), np.inf))[0] for at in chunk.blocks(np.arange(500))]
    query, (place, rank, row, dist) = chunk.lists(found)
    assert len(row) == 3 * len(X) and (dist == 0).all() and (row != query[place]).all()


def test_lists_of_a_plain_search_are_not_stored(spark):
    """Neighbours stream out of the search; before, they were checkpointed twice."""
    df, names = points(spark, np.random.default_rng(6).random((5000, 2)))
    got = nf.knn_join(df, df, names, 3, query_id="id", label="label", exclude_self=True, strategy="grid")
    assert "FlatMapGroupsInArrow" in got._jdf.queryExecution().toString()


def test_borders_are_searched_within_their_bounds(monkeypatch):
    """Queries along a border lie far apart: each keeps the bound of its own block."""
    from nearframe.plans.chunks import Leaves

    X = np.random.default_rng(5).random((20_000, 2)) * [1, 100]
    tree, scored = Leaves(X, np.arange(len(X))), []
    whole = tree._squares
    tree._squares = lambda Q, q, leaf: scored.append(len(q)) or whole(Q, q, leaf)
    at = np.argsort(X[:, 0])[:128]
    bound = np.array([np.partition(np.sqrt(((x - X) ** 2).sum(axis=1)), 3)[3] for x in X[at]])
    q, row, _ = tree.search(X[at], np.full(len(at), -1), 4, bound)
    assert len(q) == 4 * len(at) and sum(scored) < 40 * len(at)
    assert tree.box_bound(X[at[0]], X[at[0]], 4) >= bound[0]


def test_pivot_queries_that_share_an_id_share_a_list(spark):
    X = np.random.default_rng(4).normal(size=(200, 9))
    train = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(X)], "id long, v array<double>, label int")
    queries = train.where("id < 10").unionByName(train.where("id < 5"))
    args = {"query_id": "id", "label": "label", "exclude_self": True}
    got = nf.knn_join(queries, train, "v", 3, strategy="pivots", pack_rows=20, pivots=8, **args)
    assert got.groupBy("query_id").count().where("count <> 3").count() == 0
