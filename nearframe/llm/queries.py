"""Registered queries of the text operators, each over its whole tables.

``QUERIES`` maps names to ``(spark, sf_dir) -> DataFrame``; ``ORACLES`` holds
DuckDB SQL for those that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearframe.llm.align_tokens import align_tokenizers
from nearframe.llm.common import table
from nearframe.llm.decontaminate import find_leaks
from nearframe.llm.hard_negatives import mine_hard_negatives
from nearframe.llm.html_blocks import extract_main_text
from nearframe.llm.mix import mix_sources
from nearframe.llm.multiindex import embedding_links
from nearframe.llm.nnls_packing import pack_by_lengths
from nearframe.llm.packing import pack_documents
from nearframe.llm.quality import held_out, with_quality
from nearframe.llm.secrets import count_kind, find_secrets, spans_text
from nearframe.llm.simhash import simhash_groups
from nearframe.llm.suffix_dedup import remove_repeats
from nearframe.llm.url_graph import judge_urls

# The rules of the contract, (host, path, verdict).
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
KEEP_SCORE = 0.7


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return docs.select("doc_id", held_out().alias("held_out"), "score").withColumn("predicted", (F.col("score") >= KEEP_SCORE).cast("int"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    both = F.array_sort(F.concat("base", "extra"))
    kinds = [count_kind(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *kinds, F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(both).alias("spans"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op9_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_url_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def op12_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_by_lengths(table(spark, sf_dir, "documents").select("doc_id", "text"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_quality, op3_secrets, op4_decontaminate, op5_simhash, op6_embedding_links,
        op7_main_text, op8_pack_tokens, op9_remove_repeats, op10_url_graph,
        op11_hard_negatives, op12_align_tokens, op13_nnls_packing, pipeline,
    )
}

ORACLES: dict[str, str] = {
    "op1_mix_sources": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix|' || doc_id::VARCHAR) AS key
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk FROM per),
capped AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(rnk % 3 + 1)::INT] AS weight, (source_size * 2)::DOUBLE AS cap FROM ranked),
levels AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER w, 0)) /
            (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM capped WINDOW w AS (ORDER BY cap / weight, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         CASE WHEN level * weight >= cap THEN cap
              ELSE coalesce(max(CASE WHEN level * weight < cap THEN level END) OVER (), 0) * weight END AS target
  FROM levels),
placed AS (
  SELECT s.*, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
         coalesce(floor(floor(t.target) / nullif(t.source_size, 0)), 0)::BIGINT AS epochs
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + least(greatest(floor(target)::BIGINT - epochs * source_size - before, 0), size))::BIGINT AS taken
FROM placed""",
    "op11_hard_negatives": """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, t.vec_id AS id, a.label = t.label AS same,
         coalesce(list_sum(list_transform(generate_series(1, least(len(a.v), len(t.v))), lambda i: a.v[i] * t.v[i])), 0)::BIGINT AS score
  FROM r a JOIN r t ON a.vec_id <> t.vec_id WHERE a.vec_id % 100 = 0),
pos AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS n FROM s WHERE same) x WHERE n <= 5),
neg AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank
  FROM pos p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 5""",
    "op6_embedding_links": """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
   AND list_sum(list_transform(e, lambda x: x * x)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT a AS node, b AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
low AS (SELECT node, min(other) AS other FROM reach GROUP BY node),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(v.vec_id, coalesce(low.other, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(low.other, v.vec_id)) AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id LEFT JOIN low ON low.node = v.vec_id""",
    "op9_remove_repeats": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, s, md5(substr(h, 2 * s + 1, 200)) AS k
  FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 99, 0))) AS s FROM d) x),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM w) x WHERE n > 1),
g AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS fresh FROM r),
n AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM g),
spans AS (SELECT doc_id, run, min(s) AS a, max(s) + 100 AS b FROM n GROUP BY doc_id, run),
pieces AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y FROM spans
  UNION ALL SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id),
kept AS (
  SELECT p.doc_id, string_agg(substr(d.h, 2 * x + 1, 2 * (coalesce(y, length(d.h) // 2) - x)), '' ORDER BY x) AS h
  FROM pieces p JOIN d ON d.doc_id = p.doc_id GROUP BY p.doc_id),
cut AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, (length(d.h) // 2)::BIGINT AS n_bytes, coalesce(cut.n_removed, 0)::BIGINT AS n_removed,
       coalesce(cut.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN cut ON cut.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id""",
    "op10_url_graph": """
WITH u AS (
  SELECT page_id, coalesce(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(rule_host, rule_path, said) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
judged AS (
  SELECT p.page_id, p.host, p.path, max({'size': len(rule_host || rule_path), 'rule': rule_host || rule_path, 'said': said}) AS best
  FROM p LEFT JOIN rules ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)
  GROUP BY p.page_id, p.host, p.path),
-- the given pages link to no other host: a host's score is its own seed
seeds AS (
  SELECT j.host, 0.15 * (count(*) FILTER (j.best.said = 'block') - count(*) FILTER (j.best.said = 'allow')) / count(*) AS excess
  FROM p JOIN judged j ON j.page_id = p.page_id WHERE j.host <> '' GROUP BY j.host)
SELECT j.page_id, j.host, j.path, j.best.rule AS rule, coalesce(j.best.said, CASE WHEN s.excess > 0.05 THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN seeds s ON s.host = j.host""",
}
