"""PRJ-1 .. PRJ-6 and the distance functions (FN-1, FN-2)."""

import math
import random

from pyspark.sql import functions as F

import nearframe as nf
from nearframe.functions.distance import array_euclidean
from nearframe.operators.shape import assemble, profile_points, split_label, with_row_id
from tests.conftest import SF


def test_split_label_last_column_and_cast(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    out = split_label(df, cast="int")
    assert out.columns == ["a", "b", "label"] and out.first().label == 3
    assert split_label(df, "a").columns == ["b", "c", "label"]


def test_assemble(spark):
    df = spark.createDataFrame([(7, 1, 2.5)], "id long, x int, y double")
    out = assemble(df, ["x", "y"])
    assert out.columns == ["id", "features"] and out.first().features == [1.0, 2.5]


def test_with_row_id_contiguous_and_ordered(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(50), rnd.random()) for _ in range(500)]
    df = spark.createDataFrame(rows, "a long, b double").repartition(7)
    out = with_row_id(df, "rid", ["a", "b"], partitions=5).orderBy("rid").collect()
    assert [r.rid for r in out] == list(range(1, 501))
    assert [(r.a, r.b) for r in out] == sorted(rows)
    plain = with_row_id(df, "rid")
    assert plain.select("rid").distinct().count() == 500


def test_profile_points(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    r = profile_points(e, "embedding", "label").first()
    assert (r.n_instances, r.n_features, r.n_attributes, r.n_classes) == (500, 64, 65, 10)


def test_distances(spark):
    df = spark.createDataFrame([(0.0, 0.0, 3.0, 4.0, [0.0, 0.0], [3.0, 4.0])], "a double, b double, c double, d double, u array<double>, v array<double>")
    r = df.select(
        nf.euclidean(["a", "b"], ["c", "d"]).alias("e"),
        nf.squared_euclidean(["a", "b"], ["c", "d"]).alias("s"),
        array_euclidean("u", "v").alias("ae"),
    ).first()
    assert (r.e, r.s, r.ae) == (5.0, 25.0, 5.0)


def test_distance_sum_order_matches_sequential_loop(spark):
    rnd = random.Random(4)
    a = [rnd.uniform(-1e3, 1e3) for _ in range(16)]
    b = [rnd.uniform(-1e-3, 1e-3) for _ in range(16)]
    df = spark.createDataFrame([tuple(a + b)], ", ".join([f"a{i} double" for i in range(16)] + [f"b{i} double" for i in range(16)]))
    got = df.select(nf.euclidean([f"a{i}" for i in range(16)], [f"b{i}" for i in range(16)]).alias("d")).first().d
    s = 0.0
    for x, y in zip(a, b):
        s += (x - y) * (x - y)
    assert got == math.sqrt(s)
    assert F is not None


def test_ordered_row_ids_are_kept_by_column(spark):
    """One compressed copy, of which a plan reads the columns it uses; rows that Parquet
    does not hold are checkpointed."""
    rows = [(i * 7 % 500, f"s{i % 3}", float(i), [i]) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b string, c double, d array<int>").repartition(6)
    out = with_row_id(df, "rid", ["a", "c"])
    plan = out.select("rid", "c")._jdf.queryExecution().toString()
    scan = [x for x in plan.splitlines() if "FileScan parquet" in x]
    assert scan and "b#" not in scan[0] and "d#" not in scan[0]
    got = out.orderBy("rid").collect()
    assert [r["rid"] for r in got] == list(range(1, 501))
    assert [tuple(r)[:4] for r in got] == sorted(rows, key=lambda r: (r[0], r[2]))
    assert with_row_id(df.where("a < 0"), "rid", ["a"]).count() == 0
    odd = with_row_id(df.withColumn("e", F.lit(None)), "rid", ["a"], start=0)
    assert [r["rid"] for r in odd.orderBy("a").collect()] == list(range(500)) and odd.columns[-2:] == ["e", "rid"]
