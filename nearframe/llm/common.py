"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearframe.session import ensure_checkpoint_dir

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as a table in the shared checkpoint folder and read it
    back: lineage is cut, each row is computed once, and a lost executor costs
    nothing because the files are on shared storage. What the table was made from
    is garbage then: Spark's cleaner drops its shuffle files and broadcasts when
    the driver's JVM collects, which keeps the driver's heap small as well."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the files of a materialized table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(df: DataFrame) -> F.Column:
    """A 64-bit digest of the whole row: tells rows that share an id apart."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def slices(batch: pa.RecordBatch, column: str, budget: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch holding about ``budget`` bytes of text each (one
    row at least), so that array temporaries stay bounded."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > budget:
            yield start, i
            start, held = i, 0
        held += int(n)
    if start < len(sizes):
        yield start, len(sizes)


def spread_join(left: DataFrame, right: DataFrame, key: list[str], counts: DataFrame, total: int, how: str = "inner") -> DataFrame:
    """Equi-join of rows with a table of one row per key, where a key may hold
    a third of ``left``.

    ``counts`` has the key columns and ``n``, the key's rows in ``left``, and
    ``total`` is their sum (or more). Keys above half of a mean shuffle
    partition are cut into salts of about that many rows by a hash of the row's
    other columns, and their row of ``right`` is copied once per salt. There are
    at most two such keys per shuffle partition, whatever the size of the data,
    which is the proven bound of what is broadcast."""
    limit = max(1, total // (2 * shuffle_width(left.sparkSession)))
    hot = F.broadcast(counts.where(F.col("n") > limit).select(*key, F.ceil(F.col("n") / limit).cast("int").alias("__parts")))
    rest = [c for c in left.columns if c not in key]
    salt = F.pmod(F.xxhash64(*rest), F.coalesce("__parts", F.lit(1))).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))
    a = left.join(hot, key, "left").withColumn("__salt", salt).drop("__parts")
    b = right.join(hot, key, "left").withColumn("__salt", salts).drop("__parts")
    return a.join(b, [*key, "__salt"], how).drop("__salt")


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Components of an undirected graph: ``edges(a, b)`` -> ``(node, component)``
    with the smallest node of each component as its name. Nodes without an edge
    are not listed.

    Alternating large-star / small-star rounds: each round is two plain
    aggregates (with map-side combine) and two equi-joins that cut the edges of
    a hub into salts; the edge table of each round is written to the shared
    folder, and the previous one is removed.
    """
    cur = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    n_edges = cur.count()
    seen = None
    for _ in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n"))
        large = spread_join(both, low.drop("n"), ["u"], low, 2 * n_edges).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # large-star keeps u > v for every edge it emits
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = (
            spread_join(large, low.drop("n"), ["u"], low, n_edges)
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.*").where("u <> v").distinct()
        )
        nxt = materialize(small, "cc")
        state = tuple(nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        release(cur)
        cur, n_edges = nxt, state[0]
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
