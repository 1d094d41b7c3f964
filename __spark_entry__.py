"""

Every query reads whole tables. kNN queries are leave-one-out: each row of
a table is a query against every *other* row of the same table
(``exclude_self=True``), so both sides grow with the data. k = 3 throughout.

Datasets (features -> class, id):

    embeddings  embedding (64 floats)                   -> label        vec_id
    part        p_size (and p_retailprice)              -> brand number p_partkey
    lineitem    l_quantity, l_extendedprice,
                l_discount, l_tax                       -> l_returnflag row id over the full row order

Distances are computed the same way on both sides (doubles, sum of squared
differences left to right, then sqrt), so they agree to the bit and no
rounding is applied.
"""

from __future__ import annotations

import importlib.util
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import nearframe as nf
from nearframe.operators.neighbors import top_k_per_group
from nearframe.operators.shape import assemble, profile_points, split_label, with_row_id
from nearframe.session import ensure_checkpoint_dir
from nearframe.sources import (
    read_points_arff,
    read_points_csv,
    read_points_text,
    read_predictions,
    write_points_arff,
    write_points_text,
    write_predictions,
)

K = 3
RADIUS = 0.5
EMB_DIM = 64
LI_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
    "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
FLAGSHIP_SF = "/root/testdata/sf0.001"


# ----------------------------------------------------------------- loading
def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part with the integer brand number as class (``Brand#17`` -> 17)."""
    return _t(spark, sf_dir, "part").withColumn("brand", F.substring("p_brand", 7, 10).cast("int"))


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with a contiguous row id over the full row order (rows are
    distinct, ``(l_orderkey, l_linenumber)`` is not)."""
    return with_row_id(_t(spark, sf_dir, "lineitem"), "row_id", LI_ORDER)


def _io_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/io-{tag}-{uuid.uuid4().hex}"


# ----------------------------------------------------------------- neighbours
def _nb_embeddings(spark, sf_dir, strategy="auto"):
    e = _t(spark, sf_dir, "embeddings")
    return nf.knn_join(e, e, "embedding", K, query_id="vec_id", label="label", exclude_self=True, strategy=strategy)


def _nb_part(spark, sf_dir, features=("p_size",), strategy="auto"):
    p = _part(spark, sf_dir)
    return nf.knn_join(p, p, list(features), K, query_id="p_partkey", label="brand", exclude_self=True, strategy=strategy)


def _nb_lineitem(spark, sf_dir, strategy="auto"):
    li = _lineitem(spark, sf_dir)
    return nf.knn_join(li, li, LI_FEATURES, K, query_id="row_id", label="l_returnflag", exclude_self=True, strategy=strategy)


def _classify_embeddings(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings")
    return nf.knn_classify(e, e, "embedding", K, query_id="vec_id", label="label", query_label="label", exclude_self=True)


def _classify_part(spark, sf_dir):
    p = _part(spark, sf_dir)
    return nf.knn_classify(p, p, ["p_size"], K, query_id="p_partkey", label="brand", query_label="brand", exclude_self=True)


def _classify_lineitem(spark, sf_dir):
    li = _lineitem(spark, sf_dir)
    return nf.knn_classify(
        li, li, LI_FEATURES, K, query_id="row_id", label="l_returnflag", query_label="l_returnflag", exclude_self=True
    )


# ----------------------------------------------------------------- queries
def q_points_profile(spark, sf_dir):
    e = profile_points(_t(spark, sf_dir, "embeddings"), "embedding", "label").withColumn("dataset", F.lit("embeddings"))
    p = profile_points(_part(spark, sf_dir), ["p_size", "p_retailprice"], "brand").withColumn("dataset", F.lit("part"))
    li = profile_points(_t(spark, sf_dir, "lineitem"), LI_FEATURES, "l_returnflag").withColumn("dataset", F.lit("lineitem"))
    return e.unionByName(p).unionByName(li)


def q_split_label_part(spark, sf_dir):
    p = _part(spark, sf_dir).select("p_partkey", "p_size", "p_retailprice", F.col("brand").cast("double").alias("cls"))
    return split_label(p, cast="int")


def q_assemble_part(spark, sf_dir):
    return assemble(_part(spark, sf_dir), ["p_size", "p_retailprice"], "features", keep=["p_partkey"])


def q_row_ids_lineitem(spark, sf_dir):
    return _lineitem(spark, sf_dir).select(
        "row_id", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )


def q_distance_to_next(spark, sf_dir):
    """FN-1 / FN-2 on one equi-joined pair per row: each vector and the
    vector with the next id."""
    e = _t(spark, sf_dir, "embeddings")
    a = e.select(F.col("vec_id"), *[F.col("embedding")[i].cast("double").alias(f"a{i}") for i in range(EMB_DIM)])
    b = e.select(
        (F.col("vec_id") - 1).alias("vec_id"),
        F.col("vec_id").alias("next_id"),
        *[F.col("embedding")[i].cast("double").alias(f"b{i}") for i in range(EMB_DIM)],
    )
    ac = [f"a{i}" for i in range(EMB_DIM)]
    bc = [f"b{i}" for i in range(EMB_DIM)]
    return a.join(b, "vec_id").select(
        "vec_id", "next_id", nf.euclidean(ac, bc).alias("dist"), nf.squared_euclidean(ac, bc).alias("sq_dist")
    )


def q_topk_per_query_part(spark, sf_dir):
    return _nb_part(spark, sf_dir)


def q_merge_partial_topk(spark, sf_dir):
    """TOP-2: k-lists against two disjoint halves of train, merged."""
    p = _part(spark, sf_dir)
    half = F.pmod(F.xxhash64("p_partkey"), F.lit(2))
    parts = [
        nf.knn_join(p, p.where(half == h), ["p_size", "p_retailprice"], K, query_id="p_partkey", label="brand", exclude_self=True)
        for h in (0, 1)
    ]
    return nf.merge_top_k(parts, K)


def q_knn_join_embeddings(spark, sf_dir):
    return _nb_embeddings(spark, sf_dir, strategy="vectorized")


def q_knn_join_embeddings_lay2(spark, sf_dir):
    """LAY-2: queries streamed, train replicated."""
    e = _t(spark, sf_dir, "embeddings")
    return nf.knn_join(
        e, e, "embedding", K, query_id="vec_id", label="label", exclude_self=True, strategy="vectorized", replicate="train"
    )


def q_knn_join_embeddings_blocks(spark, sf_dir):
    """LAY-3: both sides split into packed blocks, every pair of blocks a tile."""
    return _nb_embeddings(spark, sf_dir, strategy="blocks")


def q_knn_join_embeddings_pivots(spark, sf_dir):
    """Packs by nearest pivot, met where the k-th distance reaches them."""
    return _nb_embeddings(spark, sf_dir, strategy="pivots")


def q_knn_join_part_index(spark, sf_dir):
    """LAY-4: the train side stored once as a bucketed index, then joined."""
    p = _part(spark, sf_dir)
    features = ["p_size", "p_retailprice"]
    index = nf.build_index(p, features, _io_dir(spark, "index"), K, train_id="p_partkey", label="brand", exclude_self=True)
    return nf.knn_join(p, None, features, K, query_id="p_partkey", exclude_self=True, index=index)


def q_update_neighbours_part(spark, sf_dir):
    """TOP-2 over time: lists over one half of train, then the other half arrives."""
    p = _part(spark, sf_dir)
    features = ["p_size", "p_retailprice"]
    half = F.pmod(F.xxhash64("p_partkey"), F.lit(2))
    args = {"query_id": "p_partkey", "label": "brand", "exclude_self": True}
    stored = nf.knn_join(p, p.where(half == 0), features, K, **args)
    return nf.update_neighbours(stored, p, p.where(half == 1), features, K, **args)


def q_pairs_within_part(spark, sf_dir):
    """JOIN-1 as a relation: parts of nearly the same size and price."""
    p = _part(spark, sf_dir)
    return nf.pairs_within(p, p, ["p_size", "p_retailprice"], RADIUS, query_id="p_partkey", label="brand", exclude_self=True)


def q_row_position_lineitem(spark, sf_dir):
    """PRJ-4 by file position, without a sort."""
    li = with_row_id(_t(spark, sf_dir, "lineitem"), "row_id", by="position")
    return li.select("row_id", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def q_summary_of_written(spark, sf_dir):
    """SNK-1 and SNK-3 in one pass."""
    e = _t(spark, sf_dir, "embeddings")
    return nf.write_evaluated(_classify_embeddings(spark, sf_dir), _io_dir(spark, "observed"), e, K)


def q_knn_classify_vectors(spark, sf_dir):
    """PRJ-2 and API-1 on ML vectors, through the estimator."""
    from nearframe.operators.ml import NearestNeighbours

    c, s = _two_tables(spark, sf_dir)
    c, s = assemble(c, ["bal"], keep=["id"], form="vector"), assemble(s, ["bal"], keep=["label"], form="vector")
    return NearestNeighbours(k=K).fit(s).transform(c).select("id", "prediction")


def q_arff_sparse_roundtrip(spark, sf_dir):
    """SRC-3 with sparse rows: zeros left out, then read back."""
    path = _io_dir(spark, "arff-sparse")
    pts = _part(spark, sf_dir).select("p_partkey", (F.col("p_size") % 3).alias("f"), "p_retailprice", "brand")
    write_points_arff(pts, path, "part", sparse=True)
    return split_label(read_points_arff(spark, path), cast="int")


def q_knn_join_lineitem(spark, sf_dir):
    return _nb_lineitem(spark, sf_dir, strategy="grid")


def q_knn_join_part_grid(spark, sf_dir):
    return _nb_part(spark, sf_dir, features=("p_size", "p_retailprice"), strategy="grid")


def q_neighbour_labels(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings")
    nb = _nb_embeddings(spark, sf_dir).drop("label")
    return nf.attach_labels(nb, e, train_id="vec_id", label="label").select("query_id", "rank", "train_id", "label", "dist")


def q_vote_counts(spark, sf_dir):
    return nf.vote_counts(_nb_embeddings(spark, sf_dir))


def q_majority_vote(spark, sf_dir):
    return nf.majority_vote(_nb_embeddings(spark, sf_dir))


def q_neighbour_lists_roundtrip(spark, sf_dir):
    return nf.lists_to_neighbours(nf.neighbours_to_lists(_nb_embeddings(spark, sf_dir)))


def q_knn_classify_embeddings(spark, sf_dir):
    return _classify_embeddings(spark, sf_dir)


def q_knn_classify_part(spark, sf_dir):
    return _classify_part(spark, sf_dir)


def q_knn_classify_lineitem(spark, sf_dir):
    return _classify_lineitem(spark, sf_dir)


def q_confusion_matrix_long(spark, sf_dir):
    return nf.confusion_matrix(_classify_embeddings(spark, sf_dir), "long")


def q_confusion_matrix_dense(spark, sf_dir):
    return nf.confusion_matrix(_classify_embeddings(spark, sf_dir), "dense")


def q_confusion_matrix_wide(spark, sf_dir):
    """AGG-4 wide form: one row per true class, one column per predicted class."""
    return nf.confusion_matrix(_classify_embeddings(spark, sf_dir), "wide")


def q_accuracy(spark, sf_dir):
    return nf.accuracy(_classify_embeddings(spark, sf_dir))


def q_evaluation_summary(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings")
    return nf.evaluation_summary(_classify_embeddings(spark, sf_dir), e, K)


def q_csv_points_roundtrip(spark, sf_dir):
    path = _io_dir(spark, "csv")
    write_points_text(_part(spark, sf_dir).select("p_size", "p_retailprice", "brand"), path)
    return split_label(read_points_csv(spark, path))


def q_numeric_text_roundtrip(spark, sf_dir):
    path = _io_dir(spark, "txt")
    write_points_text(_part(spark, sf_dir).select("p_size", "p_retailprice", "brand"), path)
    return split_label(read_points_text(spark, path, 3), cast="int")


def q_arff_roundtrip(spark, sf_dir):
    path = _io_dir(spark, "arff")
    pts = _part(spark, sf_dir).select("p_partkey", "p_size", "p_retailprice", "brand")
    write_points_arff(pts, path, "part")
    return split_label(read_points_arff(spark, path), cast="int")


def _two_tables(spark, sf_dir):
    """Another table as train: customers by their nearest suppliers' balance."""
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"), "c_nationkey")
    s = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal"), F.col("s_nationkey").alias("label"))
    return c, s


def q_knn_join_two_tables(spark, sf_dir):
    c, s = _two_tables(spark, sf_dir)
    return nf.knn_join(c, s, ["bal"], K, query_id="id", train_id="id", label="label")


def q_knn_classify_two_tables(spark, sf_dir):
    c, s = _two_tables(spark, sf_dir)
    return nf.knn_classify(c, s, ["bal"], K, query_id="id", train_id="id", label="label", query_label="c_nationkey")


def q_top_prices_per_part(spark, sf_dir):
    """TOP-1 itself: the three dearest lines of each part, ties by line order."""
    li = _t(spark, sf_dir, "lineitem")
    top = top_k_per_group(li, "l_partkey", [F.col("l_extendedprice").desc(), *LI_ORDER], K)
    return top.select("l_partkey", "rank", "l_orderkey", "l_linenumber", "l_extendedprice")


def q_predictions_csv_roundtrip(spark, sf_dir):
    path = _io_dir(spark, "pred-csv")
    write_predictions(_classify_part(spark, sf_dir), path, "csv")
    return read_predictions(spark, path, "csv")


def q_predictions_tsv_roundtrip(spark, sf_dir):
    path = _io_dir(spark, "pred-tsv")
    write_predictions(_classify_part(spark, sf_dir), path, "tsv")
    return read_predictions(spark, path, "tsv")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "points_profile": q_points_profile,
    "split_label_part": q_split_label_part,
    "assemble_part": q_assemble_part,
    "row_ids_lineitem": q_row_ids_lineitem,
    "distance_to_next": q_distance_to_next,
    "topk_per_query_part": q_topk_per_query_part,
    "merge_partial_topk": q_merge_partial_topk,
    "knn_join_embeddings": q_knn_join_embeddings,
    "knn_join_embeddings_lay2": q_knn_join_embeddings_lay2,
    "knn_join_embeddings_blocks": q_knn_join_embeddings_blocks,
    "knn_join_lineitem": q_knn_join_lineitem,
    "knn_join_part_grid": q_knn_join_part_grid,
    "neighbour_labels": q_neighbour_labels,
    "vote_counts": q_vote_counts,
    "majority_vote": q_majority_vote,
    "neighbour_lists_roundtrip": q_neighbour_lists_roundtrip,
    "knn_classify_embeddings": q_knn_classify_embeddings,
    "knn_classify_part": q_knn_classify_part,
    "knn_classify_lineitem": q_knn_classify_lineitem,
    "confusion_matrix_long": q_confusion_matrix_long,
    "confusion_matrix_dense": q_confusion_matrix_dense,
    "confusion_matrix_wide": q_confusion_matrix_wide,
    "accuracy": q_accuracy,
    "evaluation_summary": q_evaluation_summary,
    "csv_points_roundtrip": q_csv_points_roundtrip,
    "numeric_text_roundtrip": q_numeric_text_roundtrip,
    "arff_roundtrip": q_arff_roundtrip,
    "predictions_csv_roundtrip": q_predictions_csv_roundtrip,
    "predictions_tsv_roundtrip": q_predictions_tsv_roundtrip,
    "knn_join_two_tables": q_knn_join_two_tables,
    "knn_classify_two_tables": q_knn_classify_two_tables,
    "top_prices_per_part": q_top_prices_per_part,
    "arff_sparse_roundtrip": q_arff_sparse_roundtrip,
    "knn_classify_vectors": q_knn_classify_vectors,
    "summary_of_written": q_summary_of_written,
    "row_position_lineitem": q_row_position_lineitem,
    "pairs_within_part": q_pairs_within_part,
    "update_neighbours_part": q_update_neighbours_part,
    "knn_join_part_index": q_knn_join_part_index,
    "knn_join_embeddings_pivots": q_knn_join_embeddings_pivots,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: leave-one-out 3-NN classification of ``embeddings`` at sf0.001."""
    return _classify_embeddings(spark, FLAGSHIP_SF)


def _llm() -> tuple[dict, dict]:
    """Queries and SQL of the text operators, if that subpackage is there."""
    try:
        from nearframe.llm.queries import ORACLES, QUERIES
    except ModuleNotFoundError as e:
        if e.name not in ("nearframe.llm", "nearframe.llm.queries"):
            raise
        return {}, {}
    return QUERIES, ORACLES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(_QUERIES) | _llm()[0]
    if importlib.util.find_spec("corpus_pipeline") is None:
        out.pop("pipeline", None)
    return out


# ----------------------------------------------------------------- oracle SQL
def _sq(terms: list[tuple[str, str]]) -> str:
    """Sum of squared differences, left to right (same order as the engine)."""
    return " + ".join(f"({a} - {b}) * ({a} - {b})" for a, b in terms)


def _emb_terms(q: str = "q", t: str = "t") -> list[tuple[str, str]]:
    return [(f"{q}.embedding[{i + 1}]::DOUBLE", f"{t}.embedding[{i + 1}]::DOUBLE") for i in range(EMB_DIM)]


def _cols_terms(cols: list[str], q: str = "q", t: str = "t") -> list[tuple[str, str]]:
    return [(f"{q}.{c}::DOUBLE", f"{t}.{c}::DOUBLE") for c in cols]


_PART = "(SELECT *, CAST(substring(p_brand, 7) AS INTEGER) AS brand FROM part)"
_LI = "(SELECT row_number() OVER (ORDER BY " + ", ".join(LI_ORDER) + ") AS row_id, * FROM lineitem)"


def _brute_nb(src: str, idc: str, labelc: str, terms: list[tuple[str, str]]) -> str:
    """Leave-one-out 3-NN by brute force: rank by (dist, train_id)."""
    return f"""
    SELECT query_id, rank, train_id, label, dist FROM (
      SELECT query_id, train_id, label, dist,
             CAST(row_number() OVER (PARTITION BY query_id ORDER BY dist, train_id) AS BIGINT) AS rank
      FROM (SELECT q.{idc} AS query_id, t.{idc} AS train_id, t.{labelc} AS label, sqrt({_sq(terms)}) AS dist
            FROM {src} q, {src} t WHERE q.{idc} <> t.{idc}) pairs
    ) r WHERE rank <= {K}"""


def _li_nb() -> str:
    """Leave-one-out 3-NN on lineitem, exact, without scoring all pairs:
    the 3 predecessors and 3 successors in price order give each row an
    upper bound B on its 3rd distance; the price difference never exceeds
    the distance, so a price band of +-B (slightly widened for rounding)
    holds every true neighbour."""
    terms = _cols_terms(LI_FEATURES)
    d = f"sqrt({_sq(terms)})"
    lags = ", ".join(f"lag(row_id, {i}) OVER w AS p{i}, lead(row_id, {i}) OVER w AS n{i}" for i in (1, 2, 3))
    return f"""
    WITH p AS {_LI},
    nbr AS (SELECT row_id, unnest([p1, p2, p3, n1, n2, n3]) AS cid
            FROM (SELECT row_id, {lags} FROM p WINDOW w AS (ORDER BY l_extendedprice, row_id)) x),
    cand0 AS (SELECT q.row_id, {d} AS d,
                     row_number() OVER (PARTITION BY q.row_id ORDER BY {d}, t.row_id) AS r
              FROM nbr n JOIN p q ON q.row_id = n.row_id JOIN p t ON t.row_id = n.cid),
    bnd AS (SELECT row_id, max(d) AS b FROM cand0 WHERE r <= {K} GROUP BY row_id),
    cand AS (SELECT q.row_id AS query_id, t.row_id AS train_id, t.l_returnflag AS label, {d} AS dist, bnd.b
             FROM p q JOIN bnd ON bnd.row_id = q.row_id
             JOIN p t ON t.l_extendedprice BETWEEN q.l_extendedprice - (bnd.b * (1 + 1e-9) + 1e-9)
                                              AND q.l_extendedprice + (bnd.b * (1 + 1e-9) + 1e-9)
             WHERE q.row_id <> t.row_id)
    SELECT query_id, rank, train_id, label, dist FROM (
      SELECT query_id, train_id, label, dist,
             CAST(row_number() OVER (PARTITION BY query_id ORDER BY dist, train_id) AS BIGINT) AS rank
      FROM cand WHERE dist <= b) r WHERE rank <= {K}"""


def _classify(nb_sql: str, base_sql: str) -> str:
    """Vote: most frequent class, ties to the lowest; every query row kept."""
    return f"""
    WITH nb AS ({nb_sql}),
    votes AS (SELECT query_id, label, count(*) AS n FROM nb GROUP BY query_id, label),
    pred AS (SELECT query_id, label AS prediction FROM (
               SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, label) AS r FROM votes) v WHERE r = 1)
    SELECT b.query_id, b.true_label, pred.prediction FROM ({base_sql}) b LEFT JOIN pred ON pred.query_id = b.query_id"""


def _emb_nb() -> str:
    return _brute_nb("embeddings", "vec_id", "label", _emb_terms())


def _part_nb(cols: list[str]) -> str:
    return _brute_nb(_PART, "p_partkey", "brand", _cols_terms(cols))


def _two_nb() -> str:
    return f"""
    SELECT query_id, rank, train_id, label, dist FROM (
      SELECT query_id, train_id, label, dist,
             CAST(row_number() OVER (PARTITION BY query_id ORDER BY dist, train_id) AS BIGINT) AS rank
      FROM (SELECT c.c_custkey AS query_id, s.s_suppkey AS train_id, s.s_nationkey AS label,
                   sqrt({_sq([("c.c_acctbal::DOUBLE", "s.s_acctbal::DOUBLE")])}) AS dist
            FROM customer c, supplier s) pairs
    ) r WHERE rank <= {K}"""


def _two_by_row() -> str:
    """Suppliers without an id; no two of different nations are equally far where it
    would decide (the model orders those by a digest, here by the place in the file)."""
    return f"""
    SELECT query_id, rank, train_id, label, dist FROM (
      SELECT query_id, train_id, label, dist,
             CAST(row_number() OVER (PARTITION BY query_id ORDER BY dist, train_id) AS BIGINT) AS rank
      FROM (SELECT c.c_custkey AS query_id, s.train_id, s.s_nationkey AS label,
                   sqrt({_sq([("c.c_acctbal::DOUBLE", "s.s_acctbal::DOUBLE")])}) AS dist
            FROM customer c, (SELECT row_number() OVER () AS train_id, * FROM supplier) s) pairs
    ) r WHERE rank <= {K}"""


def _emb_classify() -> str:
    return _classify(_emb_nb(), "SELECT vec_id AS query_id, label AS true_label FROM embeddings")


def _part_classify() -> str:
    return _classify(_part_nb(["p_size"]), f"SELECT p_partkey AS query_id, brand AS true_label FROM {_PART}")


def _li_classify() -> str:
    return _classify(_li_nb(), f"SELECT row_id AS query_id, l_returnflag AS true_label FROM {_LI}")


def _confusion(pred_sql: str) -> str:
    return f"SELECT true_label, prediction AS predicted, count(*) AS n FROM ({pred_sql}) p GROUP BY true_label, prediction"


def _profile(table: str, width: str, label: str, name: str) -> str:
    return (
        f"SELECT count(*) AS n_instances, CAST({width} AS INTEGER) AS n_features, CAST({width} + 1 AS INTEGER) AS n_attributes, "
        f"count(DISTINCT {label}) AS n_classes, '{name}' AS dataset FROM {table}"
    )


def oracle_sql() -> dict[str, str]:
    emb_pred = _emb_classify()
    part_pred = _part_classify()
    dense = f"""
    WITH p AS ({emb_pred}),
    cls AS (SELECT true_label AS c FROM p UNION SELECT prediction FROM p WHERE prediction IS NOT NULL),
    cells AS ({_confusion(emb_pred)})
    SELECT a.c AS true_label, b.c AS predicted, CAST(coalesce(cells.n, 0) AS BIGINT) AS n
    FROM cls a CROSS JOIN cls b LEFT JOIN cells ON cells.true_label = a.c AND cells.predicted = b.c"""
    acc = f"""
    SELECT CAST(sum(CASE WHEN true_label = prediction THEN 1 ELSE 0 END) AS BIGINT) AS n_correct, count(*) AS n_test,
           CAST(100.0 * sum(CASE WHEN true_label = prediction THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS accuracy
    FROM ({emb_pred}) p"""
    summary = f"""
    SELECT CAST({K} AS INTEGER) AS k, a.n_test, (SELECT count(*) FROM embeddings) AS n_train, a.n_correct, a.accuracy
    FROM ({acc}) a"""
    emb_dist = [(f"a.embedding[{i + 1}]::DOUBLE", f"b.embedding[{i + 1}]::DOUBLE") for i in range(EMB_DIM)]
    return _llm()[1] | {
        "points_profile": " UNION ALL ".join(
            [
                _profile("embeddings", "max(len(embedding))", "label", "embeddings"),
                _profile(_PART + " x", "2", "brand", "part"),
                _profile("lineitem", "4", "l_returnflag", "lineitem"),
            ]
        ),
        "split_label_part": f"SELECT p_partkey, p_size, p_retailprice, brand AS label FROM {_PART} x",
        "assemble_part": f"SELECT p_partkey, [p_size::DOUBLE, p_retailprice::DOUBLE] AS features FROM part",
        "row_ids_lineitem": f"SELECT CAST(row_id AS BIGINT) AS row_id, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM {_LI} x",
        "distance_to_next": f"""
            SELECT a.vec_id, b.vec_id AS next_id, sqrt({_sq(emb_dist)}) AS dist, {_sq(emb_dist)} AS sq_dist
            FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
        "topk_per_query_part": _part_nb(["p_size"]),
        "merge_partial_topk": _part_nb(["p_size", "p_retailprice"]),
        "knn_join_embeddings": _emb_nb(),
        "knn_join_embeddings_lay2": _emb_nb(),
        "knn_join_embeddings_blocks": _emb_nb(),
        "knn_join_lineitem": _li_nb(),
        "knn_join_part_grid": _part_nb(["p_size", "p_retailprice"]),
        "neighbour_labels": _emb_nb(),
        "vote_counts": f"SELECT query_id, label, count(*) AS n FROM ({_emb_nb()}) nb GROUP BY query_id, label",
        "majority_vote": f"""
            SELECT query_id, label AS prediction FROM (
              SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, label) AS r
              FROM (SELECT query_id, label, count(*) AS n FROM ({_emb_nb()}) nb GROUP BY query_id, label) v) w WHERE r = 1""",
        "neighbour_lists_roundtrip": _emb_nb(),
        "knn_classify_embeddings": emb_pred,
        "knn_classify_part": part_pred,
        "knn_classify_lineitem": _li_classify(),
        "confusion_matrix_long": _confusion(emb_pred),
        "confusion_matrix_dense": dense,
        "confusion_matrix_wide": "SELECT true_label, "
        + ", ".join(f'CAST(sum(CASE WHEN predicted = {c} THEN n ELSE 0 END) AS BIGINT) AS "{c}"' for c in range(10))
        + f" FROM ({dense}) d GROUP BY true_label",
        "accuracy": acc,
        "evaluation_summary": summary,
        "csv_points_roundtrip": f"SELECT p_size AS _c0, p_retailprice AS _c1, brand AS label FROM {_PART} x",
        "numeric_text_roundtrip": f"SELECT CAST(p_size AS FLOAT) AS f0, CAST(p_retailprice AS FLOAT) AS f1, brand AS label FROM {_PART} x",
        "arff_roundtrip": f"SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, p_retailprice, brand AS label FROM {_PART} x",
        "knn_join_two_tables": _two_nb(),
        "knn_join_embeddings_pivots": _emb_nb(),
        "knn_join_part_index": _part_nb(["p_size", "p_retailprice"]),
        "update_neighbours_part": _part_nb(["p_size", "p_retailprice"]),
        "pairs_within_part": f"""
            SELECT q.p_partkey AS query_id, t.p_partkey AS train_id, t.brand AS label, sqrt({_sq(_cols_terms(["p_size", "p_retailprice"]))}) AS dist
            FROM {_PART} q JOIN {_PART} t ON q.p_partkey <> t.p_partkey AND sqrt({_sq(_cols_terms(["p_size", "p_retailprice"]))}) <= {RADIUS}""",
        "row_position_lineitem": "SELECT row_number() OVER () AS row_id, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem",
        "summary_of_written": summary,
        "knn_classify_vectors": _classify(_two_by_row(), "SELECT c_custkey AS query_id, c_nationkey AS true_label FROM customer").replace("SELECT b.query_id, b.true_label, pred.prediction", "SELECT b.query_id AS id, pred.prediction"),
        "arff_sparse_roundtrip": f"SELECT p_partkey, CAST(p_size % 3 AS BIGINT) AS f, p_retailprice, brand AS label FROM {_PART} x",
        "knn_classify_two_tables": _classify(_two_nb(), "SELECT c_custkey AS query_id, c_nationkey AS true_label FROM customer"),
        "top_prices_per_part": f"""
            SELECT l_partkey, rank, l_orderkey, l_linenumber, l_extendedprice FROM (
              SELECT *, CAST(row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, {", ".join(LI_ORDER)}) AS BIGINT) AS rank
              FROM lineitem) t WHERE rank <= {K}""",
        "predictions_csv_roundtrip": f"SELECT query_id, prediction FROM ({part_pred}) p",
        "predictions_tsv_roundtrip": f"SELECT query_id, prediction FROM ({part_pred}) p",
    }
