"""Grid search at cell borders, with outliers, dense spots and duplicates,
against brute force in NumPy; and ids that are strings."""

from __future__ import annotations

import numpy as np
import pytest

import nearframe as nf


def brute(q, t, k):
    out = []
    for i, x in enumerate(q):
        acc = np.zeros(len(t))
        for j in range(t.shape[1]):
            acc = acc + (x[j] - t[:, j]) * (x[j] - t[:, j])
        d = np.sqrt(acc)
        out += [(i, r + 1, int(n), float(d[n])) for r, n in enumerate(np.lexsort((np.arange(len(t)), d))[:k])]
    return out


def run(spark, q, t, k, strategy="grid"):
    names = [f"f{j}" for j in range(t.shape[1])]
    cols = "id long, " + ", ".join(f"{n} double" for n in names)
    qs = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(q)], cols)
    ts = spark.createDataFrame([(i, *map(float, x), 0) for i, x in enumerate(t)], cols + ", label int")
    got = nf.knn_join(qs, ts, names, k, query_id="id", train_id="id", label="label", strategy=strategy)
    return sorted((r["query_id"], r["rank"], r["train_id"], r["dist"]) for r in got.collect())


def test_rounded_border_keeps_its_neighbour(spark):
    r, t, q = 1.33287619482162, 0.01248959163629496, 0.035633742536429244
    train = np.concatenate([[0.0, t], np.linspace(0.4 * r, 0.9 * r, 399), [r]])[:, None]
    assert run(spark, np.array([[q]]), train, 1) == brute(np.array([[q]]), train, 1)


@pytest.mark.parametrize("dim", [1, 2, 4])
def test_points_one_ulp_around_each_other(spark, dim):
    rng = np.random.default_rng(dim)
    base = rng.random((120, dim))
    train = np.concatenate([base, np.nextafter(base, 2), np.nextafter(base, -2)])
    query = np.concatenate([base[:40] * 2 - base[40:80], np.nextafter(base[:20], 0)])
    assert run(spark, query, train, 3) == brute(query, train, 3)


@pytest.mark.parametrize("shape", ["outlier", "dense", "duplicates"])
def test_uneven_tables(spark, shape):
    rng = np.random.default_rng(9)
    train = rng.random((3000, 2))
    if shape == "outlier":
        train[7] = 1e6
    elif shape == "dense":
        train[:1000] = 0.5 + 1e-4 * rng.random((1000, 2))
    else:
        train[:1000] = 0.25
    query = train[::10]
    assert run(spark, query, train, 3) == brute(query, train, 3)


def test_string_ids(spark):
    t = spark.createDataFrame([(f"t{i}", float(i), i % 2) for i in range(20)], "id string, f0 double, label int")
    for strategy in ("auto", "vectorized", "blocks"):
        got = nf.knn_join(t, t, ["f0"], 1, query_id="id", label="label", exclude_self=True, strategy=strategy)
        assert {r["query_id"]: r["train_id"] for r in got.collect()}["t5"] == "t4"


def test_unknown_options_are_refused(spark):
    t = spark.createDataFrame([(1, 0.0, 0)], "id long, f0 double, label int")
    with pytest.raises(TypeError):
        nf.knn_join(t, t, ["f0"], 1, query_id="id", label="label", no_such_option=1)
