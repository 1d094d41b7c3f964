"""Mixing sources to target weights.

Every document gets a hash-random key; documents are range-sorted by key
within their source; distributed prefix sums of word counts place each
document on its source's line of words; the line is cut at the source's
budget, whole epochs first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nearframe.llm.common import WORD, materialize, row_key, shuffle_width


def word_count(text: Column) -> Column:
    """Number of words; null and empty text have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_epochs: int) -> DataFrame:
    """``sizes(source, source_size)`` -> the same with ``target``.

    Sources in code-point order (null last) take ``weights`` in turn and split
    ``share`` times all words; a target stops at ``max_epochs`` times its
    source and the excess goes to the others by weight until none is above.
    The fixed point is ``min(cap, level * weight)``: with sources ordered by
    ``cap / weight``, the capped ones are a prefix, found with two running
    sums. One row per source is all that this window sees.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("rank", F.row_number().over(order) - 1).withColumn("weight", pick)
    ranked = ranked.withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, everything = by_ratio.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    level = (F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    # a source is capped if the level, with all sources before it capped, reaches its cap;
    # the level of the first one that is not capped is the highest of those not capped
    levels = ranked.withColumn("level", level)
    levels = levels.withColumn("above", F.col("level") * F.col("weight") >= F.col("cap"))
    final = F.coalesce(F.max(F.when(~F.col("above"), F.col("level"))).over(everything), F.lit(0.0))
    return levels.withColumn("final", final).select(
        "source", "source_size", F.when(F.col("above"), F.col("cap")).otherwise(F.col("final") * F.col("weight")).alias("target")
    )


def mix_sources(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    max_epochs: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """Words that a weighted mix takes from each document.

    Returns ``doc_id, row_key, source, size, source_size, target, taken``, one
    row per input row. ``taken`` is ``size`` for every whole epoch of the
    source plus the document's part of the last, cut epoch: the words before
    the cut. Taken words of a source add up to ``floor(target)``.

    Defined results: null or empty text has size 0 and takes 0; null sources
    form one source, ordered last; a source without words has target 0;
    rows that repeat are counted and placed one by one; an empty table gives
    an empty result. Other columns are ignored, whatever their names.

    The key is ``md5(seed | doc_id)``, so reruns agree. Ranges are cut on
    (source, key, position): a source or an id that holds a third of all rows
    spreads over as many ranges as its rows need. Ranks among fully equal rows
    cannot change the result as a set of rows.
    """
    slim = docs.select(
        F.col(doc_id).alias("doc_id"),
        row_key(docs).alias("row_key"),
        F.col(source).cast("string").alias("source"),
        word_count(F.col(text).cast("string")).alias("size"),
        F.md5(F.concat_ws("|", F.lit(seed), F.col(doc_id).cast("string"))).alias("key"),
        F.monotonically_increasing_id().alias("pos"),
    )
    order = ["key", "doc_id", "size", "row_key", "pos"]
    width = shuffle_width(docs.sparkSession)
    ranged = slim.repartitionByRange(width, F.col("source"), *order).withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, "mix")
    parts = ranged.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    line = W.partitionBy("source").orderBy("part")
    parts = parts.withColumn("offset", F.coalesce(F.sum("part_size").over(line.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    targets = source_targets(ranged.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_epochs)
    parts = parts.alias("p").join(targets.alias("t"), F.expr("p.source <=> t.source")).select("p.source", "p.part", "offset", "source_size", "target")
    within = W.partitionBy("source", "part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    placed = ranged.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.alias("d").join(parts.alias("p"), F.expr("d.source <=> p.source AND d.part = p.part"))
    budget = F.floor("target")
    epochs = F.coalesce(F.floor(budget / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)).cast("long")
    rest = budget - epochs * F.col("source_size")
    taken = epochs * F.col("size") + F.least(F.greatest(rest - F.col("offset") - F.col("inner"), F.lit(0)), F.col("size"))
    return placed.select("doc_id", "row_key", F.col("d.source").alias("source"), "size", "source_size", "target", taken.cast("long").alias("taken"))


def materialize_mix(docs: DataFrame, plan: DataFrame, text: str = "text", doc_id: str = "doc_id", length: str | None = "n_chars") -> DataFrame:
    """The documents of a mix, repeats as repeated rows, with the columns of
    ``docs``. The one document per source that the cut goes through appears
    with its leading words (``length`` is then its new length); documents of
    which the mix takes nothing are left out. Equal rows are handled as one row
    with the sum of their copies, so that a row repeated many times over is
    combined before the shuffle."""
    cols = docs.columns
    once = docs.withColumn("__key", row_key(docs)).withColumn("__id", F.col(doc_id).cast("string")).dropDuplicates(["__id", "__key"])
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("long")
    copies = (
        plan.where("taken > 0").withColumn("whole", whole)
        .groupBy(F.col("doc_id").cast("string").alias("__pid"), F.col("row_key").alias("__pkey"))
        .agg(F.sum("whole").alias("__whole"), F.max(F.col("taken") - F.col("whole") * F.col("size")).alias("__part"))
    )
    joined = once.join(copies, F.col("__id").eqNullSafe(F.col("__pid")) & (F.col("__key") == F.col("__pkey")))
    last = F.col("__whole") + F.when(F.col("__part") > 0, 1).otherwise(0)
    rows = joined.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), last)))
    # what follows the first words: the last piece of a split into one piece more
    space = "[\\x20\\x09-\\x0D]+"
    body = F.regexp_replace(F.col(text), F.lit("^" + space), F.lit(""))
    rest = F.element_at(F.split(body, space, F.col("__part").cast("int") + 1), -1)
    cut = F.col("__copy") > F.col("__whole")
    head = F.substring(F.col(text), F.lit(1), F.length(F.col(text)) - F.length(rest))
    rows = rows.withColumn("__text", F.when(cut, head).otherwise(F.col(text)))
    out = []
    for c in cols:
        if c == text:
            out.append(F.col("__text").alias(c))
        elif c == length:
            out.append(F.when(cut, F.length("__text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return rows.select(*out)
