"""Evaluation of predictions (AGG-4 confusion matrix, AGG-5 accuracy, SNK-3
one-row summary).

Input: a predictions frame with ``true_label`` and ``prediction`` (as made by
``knn_classify``). A query without neighbours has a null prediction; it is
counted in the total and never as correct (C7, C8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import checkpoint
from ..sources.sinks import write_predictions
from .shape import with_row_id

TRUE = "true_label"
PRED = "prediction"


def confusion_matrix(pred: DataFrame, form: str = "long", *, true_col: str = TRUE, pred_col: str = PRED) -> DataFrame:
    """AGG-4, row = true class, column = predicted class.

    ``long``  (true_label, predicted, n), only observed cells
    ``dense`` (true_label, predicted, n) over the union of true and
              predicted classes, zeros included (C9), and the observed cells
              of queries without a prediction or label (null), so that all
              cells add up to the number of queries
    ``wide``  one row per true class, one column per predicted class
    """
    cells = pred.groupBy(F.col(true_col).alias(TRUE), F.col(pred_col).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    if form == "long":
        return cells
    if form == "dense":
        return _dense(pred, cells, true_col, pred_col)
    if form == "wide":
        dense = confusion_matrix(pred, "dense", true_col=true_col, pred_col=pred_col)
        # the classes are known by now: no extra job, and no limit on their number
        classes = [r[0] for r in dense.select("predicted").distinct().orderBy("predicted").collect()]
        return dense.groupBy(TRUE).pivot("predicted", classes).agg(F.sum("n")).na.fill(0)
    raise ValueError(f"unknown form {form!r}; use long, dense or wide")


def _dense(pred: DataFrame, cells: DataFrame, true_col: str, pred_col: str) -> DataFrame:
    """Every (true, predicted) cell over the union of classes, zeros kept.

    The observed cells are checkpointed first, so the predictions (a whole
    kNN pipeline) are computed once however many small jobs follow. The
    classes get contiguous indexes 0..C-1 (distributed ``with_row_id``),
    the C*C grid is generated by ``range`` and mapped back to class values by
    two equi-joins, then the observed counts are left-joined on. The class
    table is broadcast only after its row count is known to fit.
    """
    from ..plans.choose import broadcast_limit, row_bytes

    # one pass over the predictions: the observed cells (at most C*C + C
    # rows) are written once, and everything below reads only them; every
    # true or predicted class occurs in some cell
    cells = checkpoint(cells)
    classes = (
        cells.select(F.col(TRUE).alias("c"))
        .unionByName(cells.select(F.col("predicted").alias("c")))
        .where(F.col("c").isNotNull())
        .distinct()
    )
    indexed = with_row_id(classes, "_i", order_by=["c"], start=0)
    n = indexed.count()
    if n * row_bytes(2) * 4 <= broadcast_limit(pred.sparkSession):  # labels may be strings: 4x slack
        indexed = F.broadcast(indexed)
    spark = pred.sparkSession
    grid = spark.range(n * n).select((F.col("id") / n).cast("long").alias("_ti"), (F.col("id") % n).alias("_pi"))
    t = indexed.select(F.col("_i").alias("_ti"), F.col("c").alias(TRUE))
    pcls = indexed.select(F.col("_i").alias("_pi"), F.col("c").alias("predicted"))
    named = grid.join(t, "_ti").join(pcls, "_pi").select(TRUE, "predicted")
    full = named.join(cells, [TRUE, "predicted"], "left").select(
        TRUE, "predicted", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")
    )
    # observed cells without a class, so that all cells add up to the queries
    return full.unionByName(cells.where(F.col(TRUE).isNull() | F.col("predicted").isNull()))


def _correct(true_col: str, pred_col: str):
    return F.when(F.col(true_col) == F.col(pred_col), 1).otherwise(0)


def accuracy(pred: DataFrame, *, true_col: str = TRUE, pred_col: str = PRED) -> DataFrame:
    """AGG-5: one row (n_correct, n_test, accuracy) with accuracy in percent."""
    return pred.agg(
        F.sum(_correct(true_col, pred_col)).cast("long").alias("n_correct"),
        F.count(F.lit(1)).alias("n_test"),
    ).select(
        "n_correct",
        "n_test",
        F.try_divide(F.lit(100.0) * F.col("n_correct"), F.col("n_test")).alias("accuracy"),
    )


def evaluation_summary(pred: DataFrame, train: DataFrame, k: int, *, true_col: str = TRUE, pred_col: str = PRED) -> DataFrame:
    """SNK-3: one row (k, n_test, n_train, n_correct, accuracy): the summary
    line of a classifier run, as a DataFrame. Test and train rows are
    counted in one aggregate over their union (no join)."""
    tests = pred.select(F.lit(1).alias("_t"), _correct(true_col, pred_col).alias("_c"))
    trains = train.select(F.lit(0).alias("_t"), F.lit(0).alias("_c"))
    tot = tests.unionByName(trains).agg(
        F.count(F.lit(1)).alias("_all"),
        F.sum("_t").cast("long").alias("n_test"),
        F.sum("_c").cast("long").alias("n_correct"),
    )
    return tot.select(
        F.lit(k).cast("int").alias("k"),
        F.coalesce(F.col("n_test"), F.lit(0)).alias("n_test"),
        (F.col("_all") - F.coalesce(F.col("n_test"), F.lit(0))).alias("n_train"),
        F.coalesce(F.col("n_correct"), F.lit(0)).alias("n_correct"),
        F.try_divide(F.lit(100.0) * F.col("n_correct"), F.col("n_test")).alias("accuracy"),
    )


def write_evaluated(
    pred: DataFrame, path: str, train: DataFrame, k: int, fmt: str = "csv", *, mode: str = "errorifexists", id_col: str = "query_id", true_col: str = TRUE, pred_col: str = PRED
) -> DataFrame:
    """SNK-1/SNK-2 and SNK-3 in one pass: write the predictions and return the
    summary row of ``evaluation_summary``.

    The counts are observed on the rows as they are written, so the search behind
    ``pred`` runs once. A ``tsv`` is sorted, and sorting samples its input first, so
    there the observed rows are checkpointed and the copy is sorted."""
    seen = Observation()
    watched = pred.observe(seen, F.count(F.lit(1)).alias("n_test"), F.coalesce(F.sum(_correct(true_col, pred_col)), F.lit(0)).cast("long").alias("n_correct"))
    watched = watched.select(id_col, pred_col)
    write_predictions(checkpoint(watched) if fmt == "tsv" else watched, path, fmt, mode=mode, id_col=id_col, pred_col=pred_col)
    got = seen.get
    n, right = got["n_test"], got["n_correct"]
    rows = [(k, n, train.count(), right, 100.0 * right / n if n else None)]
    return pred.sparkSession.createDataFrame(rows, "k int, n_test long, n_train long, n_correct long, accuracy double")
