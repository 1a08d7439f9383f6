"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    chat, drift, hardneg, hosts, html, langid, mips, mixing, packing, quality, simhash, toxicity, warc,
)
from tessera.session import ensure_checkpoint_dir, ship_package
from tessera.sources.tables import load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL if it has one."""
    def register(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            ship_package(spark)
            return f(spark, sf_dir)
        run.__doc__, run.__name__ = f.__doc__, f.__name__
        QUERIES[f.__name__] = run
        if sql:
            ORACLE[f.__name__] = sql
        return run
    return register


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS n, sha256(h) AS digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f""")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records in ZIP packages and read back by range reads."""
    return warc.round_trip(load(spark, sf_dir, "pages"), spark)


@query()
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to target source weights by pivotal dependent rounding."""
    return mixing.mix(load(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


@query("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5""")
def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest inner products of every 50th vector with all others, exactly."""
    return mips.top_inner_products(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents tokenised, cut and packed into sequences of at most 4096 tokens."""
    return packing.pack(load(spark, sf_dir, "documents"), VOCABULARY)


@query()
def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html.extract(load(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query()
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash component of every document (three-word shingles, at most two bits)."""
    groups = simhash.simhash_groups(load(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), simhash.fingerprint_hex().alias("fingerprint"),
                         F.col("component").alias("component_id"))


@query()
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    out = quality.judge(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "score")


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query()
def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return langid.identify(load(spark, sf_dir, "documents"))


TEMPLATE_PROBE = "</s>[INST] ok [/INST]"


@query(r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g') AS et,
             regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'),
                            '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g') AS er FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), ''))
           AS loss_sha256,
       CAST(sum(length(er) + length(et) + 24) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""")
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, and their digests read back from the formatted text."""
    turns = load(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TEMPLATE_PROBE).alias("text"))
    return chat.read_back(chat.format_conversations(turns.union(probe)))


_WHOLE = """list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE)))"""
_FINITE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


@query(f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  {_WHOLE.format(scale=256)} AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND {_FINITE}),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
             CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS n
      FROM p JOIN s USING (anchor_id)
      WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE n <= 3""")
def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector's positives, by residue-number scores of all vectors."""
    vectors = load(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


@query("""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM u),
r AS (SELECT *, CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1')
                       THEN 'example.org/en/1'
                     WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/')
                       THEN 'example.org/es/'
                     WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
                     WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
                     WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
      FROM s),
j AS (SELECT *, rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') AS bad,
             split_part(host, '.', -1) AS suffix,
             array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain FROM r),
h AS (SELECT host, domain, suffix, count(bad) AS n, coalesce(count_if(bad), 0) AS bad FROM j GROUP BY ALL),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
x AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL),
xm AS (SELECT *, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM d) AS m FROM x),
xr AS (SELECT coalesce(least(0.999, greatest(0.001, sum(n * (bad / n - m) * (bad / n - m) - m * (1 - m))
                / CASE WHEN sum(m * (1 - m) * (n - 1)) > 0 THEN sum(m * (1 - m) * (n - 1)) END)), 0.5) AS rho
       FROM xm WHERE n > 0),
xp AS (SELECT suffix, ((1 - rho) / rho * m + bad) / ((1 - rho) / rho + n) AS mean FROM xm, xr),
dm AS (SELECT d.*, xp.mean AS m FROM d JOIN xp USING (suffix)),
dr AS (SELECT coalesce(least(0.999, greatest(0.001, sum(n * (bad / n - m) * (bad / n - m) - m * (1 - m))
                / CASE WHEN sum(m * (1 - m) * (n - 1)) > 0 THEN sum(m * (1 - m) * (n - 1)) END)), 0.5) AS rho
       FROM dm WHERE n > 0),
dp AS (SELECT domain, suffix, ((1 - rho) / rho * m + bad) / ((1 - rho) / rho + n) AS mean FROM dm, dr),
hm AS (SELECT h.*, dp.mean AS m FROM h JOIN dp USING (domain, suffix)),
hr AS (SELECT coalesce(least(0.999, greatest(0.001, sum(n * (bad / n - m) * (bad / n - m) - m * (1 - m))
                / CASE WHEN sum(m * (1 - m) * (n - 1)) > 0 THEN sum(m * (1 - m) * (n - 1)) END)), 0.5) AS rho
       FROM hm WHERE n > 0),
hp AS (SELECT host, n, bad, (1 - rho) / rho + n AS weight, ((1 - rho) / rho * m + bad) / ((1 - rho) / rho + n) AS mean
       FROM hm, hr),
b AS (SELECT *, mean - 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) AS bound FROM hp)
SELECT page_id, j.host, path, rule,
       CASE WHEN rule IS NOT NULL THEN CASE WHEN j.bad THEN 'block' ELSE 'allow' END
            WHEN bound >= 0.5 THEN 'block' ELSE 'allow' END AS verdict,
       b.n AS host_outcomes, CAST(b.bad AS BIGINT) AS host_blocked, round(bound, 6) AS bound
FROM j JOIN b ON j.host = b.host""")
def op12_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rules, or by the reputation of its host."""
    return hosts.judge(load(spark, sf_dir, "pages", "page_id", "url"))


def _clusters_sql(k: int, rounds: int) -> str:
    """Lloyd's rounds written out, one pair of tables per round."""
    parts = [f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, {_WHOLE.format(scale=64)} AS e
     FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), e) - 1 AS k,
             e AS c FROM v QUALIFY k < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (SELECT row, any_value(vec_id) AS vec_id, any_value(e) AS e,
              min(row(list_dot_product(e, e) + list_dot_product(c, c) - 2 * list_dot_product(e, c), k)) AS best
       FROM v, c{i} GROUP BY row)""")
        if i < rounds:
            parts.append(f"""
c{i + 1} AS MATERIALIZED (SELECT k, coalesce(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
         SELECT k, list(floor(total / n) ORDER BY axis) AS c FROM (
           SELECT best[2] AS k, axis, sum(e[axis]) AS total, count(*) AS n
           FROM a{i}, range(1, 65) t(axis) GROUP BY ALL) GROUP BY k) m USING (k))""")
    return ",".join(parts) + f"""
SELECT vec_id, CAST(best[2] AS INTEGER) AS cluster, CAST(best[1] AS BIGINT) AS distance,
       CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia,
       CAST(sum(best[1]) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON best[2] = k"""


@query(_clusters_sql(16, 3))
def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of 64 components in 16 clusters, three rounds, with exact whole-number distances."""
    return drift.cluster(load(spark, sf_dir, "embeddings", "vec_id", "embedding"))
