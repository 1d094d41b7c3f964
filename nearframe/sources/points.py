"""Point sources (SRC-1 .. SRC-3): labelled points from text files.

All three are Spark scans; no file is parsed on the driver except the ARFF
header (attribute lines only, bounded by the schema width, not the data).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_points_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, *, sep: str = ",") -> DataFrame:
    """SRC-1: headerless CSV. Without ``schema`` the types are inferred (an
    extra pass over the file, columns ``_c0 .. _cN``); with a DDL schema the
    read is a single pass and malformed lines fail the job."""
    r = spark.read.option("header", "false").option("sep", sep)
    if schema is None:
        return r.option("inferSchema", "true").csv(path)
    return r.schema(schema).option("mode", "FAILFAST").csv(path)


def numeric_schema(width: int, *, label: bool = True, dtype: str = "float") -> str:
    """DDL for ``width`` numeric columns f0..; the last one named ``label``."""
    names = [f"f{i}" for i in range(width - 1 if label else width)]
    cols = [f"{n} {dtype}" for n in names]
    if label:
        cols.append(f"label {dtype}")
    return ", ".join(cols)


def read_points_text(spark: SparkSession, path: str, width: int, *, dtype: str = "float") -> DataFrame:
    """SRC-2: comma-separated numeric lines, all ``dtype``, class last.

    Any non-numeric line fails the job (FAILFAST) rather than being dropped."""
    return read_points_csv(spark, path, numeric_schema(width, dtype=dtype))


_ATTR = re.compile(r"^\s*@attribute\s+('(?:[^']|\\')*'|\"[^\"]*\"|\S+)\s+(.+?)\s*$", re.IGNORECASE)

#: A line of the header, and not a data row that happens to start with ``@``.
_DECLARATION = r"(?i)^\s*@(?:(?:relation|attribute)\s|data\s*(?:%.*)?$)"

# ARFF attribute type keywords and the Spark type each maps to.
ARFF_NUMERIC_TYPES = {"numeric": "double", "real": "double", "integer": "bigint"}


def arff_schema(header_lines: list[str]) -> T.StructType:
    """StructType from ``@attribute`` lines in file order.

    Numeric/real -> double, integer -> long, a last nominal attribute ``{0,1}``
    of integers only (a class) -> int, other nominal ones and string -> string.
    The ARFF missing marker ``?`` is read as null by the body parse.
    """
    header_lines = [x for x in header_lines if _ATTR.match(x)]
    fields = []
    for line in header_lines:
        m = _ATTR.match(line)
        if not m:
            continue
        name = m.group(1)
        if name[0] in "'\"":
            name = name[1:-1].replace("\\'", "'")
        kind = m.group(2).strip()
        low = kind.lower()
        if low in ARFF_NUMERIC_TYPES:
            dt = T.LongType() if ARFF_NUMERIC_TYPES[low] == "bigint" else T.DoubleType()
        elif line is header_lines[-1] and re.fullmatch(r"\{\s*-?\d+\s*(,\s*-?\d+\s*)*\}", kind):
            dt = T.IntegerType()
        else:
            dt = T.StringType()
        fields.append(T.StructField(name, dt, True))
    if not fields:
        raise ValueError("no @attribute lines found")
    return T.StructType(fields)


#: An entry of a sparse row: the attribute's number and its value, quoted or plain.
_ENTRY = r"""(\d+)\s+('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^,}\s]+)"""
_SPARSE = r"""^\{\s*(?:\d+\s+(?:'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^,}\s'"]+)\s*(?:,\s*(?=\d)|(?=\})))*\}$"""


def _absent(header_line: str, dt: T.DataType):
    """The value of an attribute that a sparse row leaves out: zero, or the first
    of the listed values; a free string has none."""
    kind = _ATTR.match(header_line).group(2).strip()
    if not isinstance(dt, T.StringType) and not kind.startswith("{"):
        return F.lit(0).cast(dt)
    if kind.startswith("{"):
        first = re.match(r"""\{\s*('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^,}\s]+)""", kind)
        if first:
            v = first.group(1)
            v = re.sub(r"\\(.)", r"\1", v[1:-1]) if v[0] in "'\"" else v
            return F.lit(v).cast(dt)
    return F.lit(None).cast(dt)


def _sparse_row(line: Column, schema: T.StructType, header: list[str]) -> Column:
    """``{1 3.5, 4 2}`` (numbers from 0) as a struct of ``schema``. A malformed row,
    a repeated or unknown number or a value of another type fails the job."""
    numbers = F.transform(F.regexp_extract_all(line, F.lit(_ENTRY), F.lit(1)), lambda x: x.cast("int"))
    values = F.transform(F.regexp_extract_all(line, F.lit(_ENTRY), F.lit(2)), lambda x: F.when(x.rlike("""^['"]"""), F.regexp_replace(F.substring(x, F.lit(2), F.length(x) - 2), r"\\(.)", "$1")).otherwise(x))
    bad = ~line.rlike(_SPARSE) | (F.size(F.array_distinct(numbers)) != F.size(numbers)) | F.exists(numbers, lambda i: i >= len(schema))
    where = F.when(bad, F.raise_error(F.concat(F.lit("malformed sparse ARFF row: "), line)).cast("array<int>")).otherwise(numbers)
    fields = []
    for i, (f, head) in enumerate(zip(schema.fields, header)):
        at = F.array_position(where, F.lit(i).cast("int"))
        v = F.element_at(values, at.cast("int"))
        fields.append(F.when(at == 0, _absent(head, f.dataType)).when(v == "?", F.lit(None)).otherwise(v.cast(f.dataType)).alias(f.name))
    return F.struct(*fields)


def read_points_arff(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3: ARFF as a Spark load.

    Header: the lines that start with one of the three declarations, bounded
    by files x attributes; several files with the same header are one table,
    and different headers fail. Body: every other line that is not blank or a
    ``%`` comment is parsed with ``from_csv`` against that schema, in parallel
    across the file splits; values may start with ``@``, and quoted ones with
    ``%``. Rows in braces are sparse (``{1 3.5, 4 2}``): attributes they leave out
    are zero, or the first listed value; both kinds of rows may be mixed.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    declared = F.col("value").rlike(_DECLARATION)
    heads: dict[str, list[str]] = {}
    for r in lines.where(declared).orderBy("file", "at").collect():
        if _ATTR.match(r["value"]):
            heads.setdefault(r["file"], []).append(r["value"])
    found = list(heads.values())
    if any(h != found[0] for h in found):
        raise ValueError("the files have different headers")
    schema = arff_schema(found[0] if found else [])
    trimmed = F.trim(F.col("value"))
    body = lines.where((F.length(trimmed) > 0) & ~declared & ~trimmed.startswith("%"))
    opts = {"nullValue": "?", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "mode": "FAILFAST"}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    header = [x for x in found[0] if _ATTR.match(x)]
    body = body.select("value", F.trim("value").alias("line"))
    # the dense parser never sees a sparse row
    dense = F.from_csv(F.when(~F.col("line").startswith("{"), F.col("value")), ddl, opts)
    row = F.when(F.col("line").startswith("{"), _sparse_row(F.col("line"), schema, header)).otherwise(dense)
    return body.select(row.alias("r")).select("r.*")
