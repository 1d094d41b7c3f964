"""Sinks (SNK-1, SNK-2, SRT-1) and the ARFF writer used for round trips.

Writers are Spark writes into a directory (one part file per task); the
only ordered write (tsv, SRT-1) uses a range-partitioned global sort, so the
part files concatenate in query order without moving rows to one task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_predictions(pred: DataFrame, path: str, fmt: str = "csv", *, mode: str = "errorifexists", id_col: str = "query_id", pred_col: str = "prediction") -> None:
    """SNK-1 ``csv``: ``id,class`` rows, no header; fails if the folder exists
    (default mode). SNK-2 ``tsv``: ``id<TAB>class`` sorted by id (SRT-1)."""
    out = pred.select(F.col(id_col), F.col(pred_col))
    if fmt == "csv":
        out.write.mode(mode).csv(path)
    elif fmt == "tsv":
        out.orderBy(F.col(id_col)).write.mode(mode).option("sep", "\t").csv(path)
    else:
        raise ValueError(f"unknown format {fmt!r}; use csv or tsv")


def read_predictions(spark, path: str, fmt: str = "csv", *, id_type: str = "long", class_type: str = "int") -> DataFrame:
    """Read a folder written by ``write_predictions`` back as (query_id, prediction)."""
    sep = "\t" if fmt == "tsv" else ","
    return spark.read.schema(f"query_id {id_type}, prediction {class_type}").option("sep", sep).option("mode", "FAILFAST").csv(path)


def write_points_text(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Comma-separated numeric lines, class last, no header (SRC-1/SRC-2 input)."""
    df.write.mode(mode).option("header", "false").csv(path)


def _arff_type(dt: T.DataType) -> str:
    if isinstance(dt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return "integer"
    if isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "numeric"
    return "string"


def _arff_name(name: str) -> str:
    """Names with white space, quotes, commas, braces or % are quoted."""
    return name if re.fullmatch(r"[^\s'\"%{},]+", name) else "'" + name.replace("'", "\\'") + "'"


def _sparse_line(df: DataFrame) -> Column:
    """``{1 3.5, 4 2}``: numbers from 0, zeros left out, nulls as ``?``, texts quoted."""
    entries = []
    for i, f in enumerate(df.schema.fields):
        c = F.col("`" + f.name.replace("`", "``") + "`")
        text = isinstance(f.dataType, T.StringType)
        value = F.concat(F.lit("'"), F.regexp_replace(c, r"(['\\\\])", r"\\$1"), F.lit("'")) if text else c.cast("string")
        entry = F.concat(F.lit(f"{i} "), F.coalesce(value, F.lit("?")))
        entries.append(entry if text else F.when(c.isNull() | (c != 0), entry))
    return F.concat(F.lit("{"), F.concat_ws(", ", *entries), F.lit("}"))


def write_points_arff(df: DataFrame, path: str, relation: str = "points", *, mode: str = "errorifexists", sparse: bool = False) -> None:
    """An ARFF folder: one header file (written from the schema, not from
    data) plus the body as CSV part files, or as ``sparse`` rows without their
    zeros; ``read_points_arff`` reads the folder back. Nulls are written as the
    ARFF missing marker ``?``."""
    spark = df.sparkSession
    header = [f"@relation {relation}"] + [f"@attribute {_arff_name(f.name)} {_arff_type(f.dataType)}" for f in df.schema.fields] + ["@data"]
    if sparse:
        df.select(_sparse_line(df).alias("value")).write.mode(mode).text(path)
    else:
        df.write.mode(mode).option("header", "false").option("nullValue", "?").csv(path)
    spark.createDataFrame([(line,) for line in header], "value string").coalesce(1).write.mode("append").text(path)
