"""Secret scans: fixed patterns, and character Markov models of random strings
and ordinary identifiers compared by log-likelihood ratio.

Column expressions only: no Python runs on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the contract.
KINDS = ("assign", "access", "hex")
ASSIGN = "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"

#: Characters of a candidate; anything else is state 0.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
STATES = len(ALPHABET) + 1
TOKEN = "[A-Za-z0-9+/_=-]{20,}"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row: inside a lambda an
    expression would be computed again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Elements that a running sum is built of one by one.
RUN = 64


def _running(values: Column, levels: int = 3) -> Column:
    """Running sums of an array of longs. Sums are built in runs of ``RUN`` and the
    runs' totals are summed the same way, so no array grows element by element
    over the whole length."""
    empty = F.expr("CAST(array() AS array<bigint>)")

    def chain(xs: Column) -> Column:
        return F.aggregate(xs, empty, lambda acc, x: F.concat(acc, F.array(x + F.when(F.size(acc) > 0, F.element_at(acc, -1)).otherwise(F.lit(0).cast("long")))))

    if not levels:
        return chain(values)

    def whole(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.floor((F.size(v) - 1) / F.lit(RUN)), F.lit(0)).cast("int"))
        return _let(F.transform(starts, lambda i: chain(F.slice(v, i * RUN + 1, F.lit(RUN)))), lambda runs: _let(_before(runs, levels), lambda offset: F.flatten(F.zip_with(runs, offset, lambda r, o: F.transform(r, lambda x: x + o)))))

    return _let(values, whole)


def _before(runs: Column, levels: int) -> Column:
    """What lies before each run: the running sums of the totals, moved by one."""
    totals = F.transform(runs, lambda r: F.when(F.size(r) > 0, F.element_at(r, -1)).otherwise(F.lit(0).cast("long")))
    return F.concat(F.array(F.lit(0).cast("long")), F.slice(_running(totals, levels - 1), F.lit(1), F.greatest(F.size(runs) - 1, F.lit(0))))


def _spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as ``array<struct<start,end>>`` in code
    points. The pieces between matches and the matches themselves alternate, so
    positions are running sums of their lengths. Each array is made once."""
    # one gap more than matches: the last pair has no match
    lengths = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda gap, m: F.struct(F.length(gap).cast("long").alias("gap"), F.length(m).cast("long").alias("match")))
    matched = lambda p: F.slice(p, F.lit(1), F.size(p) - 1)

    def spans(p: Column) -> Column:
        ends = _running(F.transform(p, lambda x: x["gap"] + x["match"]))
        return F.zip_with(p, ends, lambda x, end: F.struct((end - x["match"]).alias("start"), end.alias("end")))

    return _let(lengths, lambda p: _let(matched(p), spans))


def _clear_of(items: Column, base: Column) -> Column:
    """The items (``s`` with start and end) that overlap no span of ``base``, which
    is sorted by start. Base spans are cut into runs of about the root of their
    number; an item looks into the few runs whose hull it meets."""

    def against(b: Column) -> Column:
        size = F.greatest(F.ceil(F.sqrt(F.size(b).cast("double"))), F.lit(1)).cast("int")

        def run(i: Column) -> Column:
            part = F.slice(b, i * size + 1, size)
            return F.struct(F.element_at(part, 1)["start"].alias("start"), F.array_max(F.transform(part, lambda x: x["end"])).alias("end"), part.alias("spans"))

        runs = F.when(F.size(b) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(b) - 1) / size).cast("int")), run)).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,spans:array<struct<start:bigint,kind_no:int,kind:string,end:bigint>>>>"))
        meets = lambda x, y: (x["start"] < y["end"]) & (y["start"] < x["end"])
        return _let(runs, lambda rs: F.filter(items, lambda i: ~F.exists(rs, lambda r: meets(r, i["s"]) & F.exists(r["spans"], lambda x: meets(x, i["s"])))))

    return _let(base, against)


def _state(char: Column) -> Column:
    return F.instr(F.lit(ALPHABET), char)


def labelled_samples(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", max_docs: int = 500, n_random: int = 1000) -> DataFrame:
    """Labelled strings ``(token, random 0/1)``.

    Random ones are digests in the three usual spellings (hex, base64, upper
    case with digits); ordinary ones are words of at most about ``max_docs``
    documents, a documented bound, chosen by a hash of the id, and identifiers
    made from neighbouring words (``a_b_c``, ``A_B_C``, ``aBC``, ``a/b/c``, and
    ``a_b_c`` with a number at the end).
    """
    spark = docs.sparkSession
    n = max(docs.count(), 1)
    digest = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 256)
    b64 = F.base64(F.unhex(digest))
    spellings = F.array(F.substring(digest, 1, 40), F.translate(b64, "=", ""), F.upper(F.translate(F.substring(b64, 1, 24), "+/=", "")))
    random = spark.range(n_random).select(F.explode(spellings).alias("token"))
    cut = min(1.0, max_docs / n)
    some = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).cast("string").alias("t")).where(
        F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(cut * (1 << 30))
    )
    words = F.regexp_extract_all("t", F.lit("[\\p{L}_-]{2,}"), F.lit(0))
    lists = some.select(words.alias("w"))

    def joined(sep: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - 3, F.lit(0)), F.lit(3)), lambda i: F.array_join(F.slice("w", i + 1, 3), sep))

    camel = F.transform(joined(" "), lambda s: F.replace(F.initcap(s), F.lit(" "), F.lit("")))
    # a number of one to four digits by a hash of the name
    numbered = F.transform(joined("_"), lambda s: F.concat(s, F.lit("_"), F.substring(F.pmod(F.xxhash64(s), F.lit(10_000)).cast("string"), 1, 4)))
    ordinary = lists.where(F.size("w") >= 3).select(F.explode(F.concat("w", joined("_"), joined("/"), F.transform(joined("_"), F.upper), camel, numbered)).alias("token"))
    return random.withColumn("random", F.lit(1)).unionByName(ordinary.withColumn("random", F.lit(0)))


def train_markov(samples: DataFrame, smoothing: float = 0.5) -> list[float]:
    """Log-likelihood ratio of each transition, random over ordinary, as a flat
    table of ``STATES x STATES`` (all that reaches the driver)."""
    chars = samples.where(F.length("token") > 1).select("random", F.transform(F.split("token", ""), _state).alias("s"))
    n = F.size("s") - 1
    moves = F.zip_with(F.slice("s", F.lit(1), n), F.slice("s", F.lit(2), n), lambda a, b: a * STATES + b)
    counts = chars.select("random", F.explode(moves).alias("m")).groupBy("random", "m").count().collect()
    model = [[smoothing] * (STATES * STATES) for _ in range(2)]
    for r in counts:
        model[r["random"]][r["m"]] += r["count"]
    rows = [[sum(m[i * STATES : (i + 1) * STATES]) for i in range(STATES)] for m in model]
    return [math.log(model[1][m] / rows[1][m // STATES]) - math.log(model[0][m] / rows[0][m // STATES]) for m in range(STATES * STATES)]


def _ratio(token: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio per transition of a string."""
    # one folded literal instead of thousands of expressions
    lookup = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")
    s = F.transform(F.split(token, ""), _state)
    n = F.length(token) - 1
    moves = F.zip_with(F.slice(s, F.lit(1), n), F.slice(s, F.lit(2), n), lambda a, b: F.element_at(lookup, a * STATES + b + 1))
    return F.aggregate(moves, F.lit(0.0), lambda acc, x: acc + x) / n


def find_secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", samples: DataFrame | None = None, min_ratio: float = 1.5) -> DataFrame:
    """Secrets of every whole text: ``doc_id, base, extra``, arrays of
    ``struct<start, kind_no, kind, end>`` sorted by start, then kind.

    ``base`` has the three fixed kinds. ``extra`` (kind ``markov``) has strings
    of 20 or more token characters, with or without digits, whose mean
    log-likelihood ratio of the two models reaches ``min_ratio``, and which
    overlap no base span.

    Defined results: null and empty text have no spans; offsets are code
    points, end exclusive; rows that repeat are reported once each; an empty
    table gives an empty result; other columns are ignored.
    """
    table = train_markov(samples if samples is not None else labelled_samples(docs, text, doc_id))
    none = F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)")
    t = F.col("t")
    low = F.lower(t)
    # a cheap word search decides whether the patterns have to run at all
    named = low.contains("password") | low.contains("passwd") | low.contains("secret") | low.contains("token") | low.contains("apikey") | low.contains("api_key")
    out = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    out = out.select("*", F.when(named, _spans(t, ASSIGN)).otherwise(none).alias("s_assign"), F.when(named, F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2))).otherwise(F.expr("CAST(array() AS array<string>)")).alias("v_assign"))
    # greedy runs of one class: a run that is long enough is its own leftmost match
    out = out.select("*", F.when(t.contains("AKIA"), _spans(t, "AKIA[A-Z0-9]{16,}")).otherwise(none).alias("s_access"))
    long_hex = "[0-9a-f]{24,}"
    out = out.select("*", F.when(t.rlike(long_hex), _spans(t, long_hex)).otherwise(none).alias("s_hex"))
    out = out.select("*", F.when(t.rlike(TOKEN), F.regexp_extract_all(t, F.lit(TOKEN), F.lit(0))).otherwise(F.expr("CAST(array() AS array<string>)")).alias("v_token"))
    suspect = F.transform("v_token", lambda m: _ratio(m, table) >= min_ratio)
    out = out.select("*", suspect.alias("hit"))
    out = out.select("*", F.when(F.exists("hit", lambda h: h), _spans(t, TOKEN)).otherwise(none).alias("s_token"))

    def kind(name: str, no: int, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(no).alias("kind_no"), F.lit(name).alias("kind"), s["end"].alias("end")))

    long_value = F.filter(F.arrays_zip(F.col("s_assign").alias("s"), F.col("v_assign").alias("v")), lambda x: F.length(x["v"]) >= 6)
    base = F.array_sort(F.concat(kind("assign", 0, F.transform(long_value, lambda x: x["s"])), kind("access", 1, F.col("s_access")), kind("hex", 2, F.col("s_hex"))))
    out = out.select("doc_id", base.alias("base"), "s_token", "hit")
    suspects = F.filter(F.arrays_zip(F.col("s_token").alias("s"), F.col("hit").alias("h")), lambda x: x["h"] & x["s"].isNotNull())
    fresh = _clear_of(suspects, F.col("base"))
    return out.select("doc_id", "base", kind("markov", 3, F.transform(fresh, lambda x: x["s"])).alias("extra"))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
