"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexmart.llm import bond, crosspolytope, language, lines, minhash, mixing, packing, quality, recompression, simhash, suffix, token_count, whitening
from hexmart.llm.frames import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op3_mixing", r"""
WITH sized AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5('7:' || doc_id) AS draw
  FROM documents),
sources AS (
  SELECT *, ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::BIGINT AS weight, 3 * source_size AS cap
  FROM (SELECT source, SUM(size)::BIGINT AS source_size FROM sized GROUP BY source)),
ranked AS (
  SELECT *, (SUM(source_size) OVER () - COALESCE(SUM(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS rest,
    SUM(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sharing, row_number() OVER o AS place
  FROM sources WINDOW o AS (ORDER BY cap / weight, source IS NULL, source)),
opened AS (SELECT MIN(place) AS place FROM ranked WHERE cap::HUGEINT * sharing > weight::HUGEINT * rest),
level AS (SELECT rest, sharing FROM ranked WHERE place = (SELECT place FROM opened)),
targets AS (
  SELECT source, source_size, CASE WHEN (SELECT place FROM opened) IS NULL OR place < (SELECT place FROM opened) THEN cap::DOUBLE
    ELSE (weight * (SELECT rest FROM level))::DOUBLE / (SELECT sharing FROM level) END AS target FROM ranked),
planned AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
placed AS (
  SELECT s.*, p.source_size, p.target, p.whole, SUM(size) OVER (PARTITION BY s.source ORDER BY draw, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source),
counted AS (
  SELECT *, (whole + CASE WHEN 2 * upto - size <= 2 * (target - whole * source_size) AND target - whole * source_size > 0 THEN 1 ELSE 0 END)::BIGINT AS repeats
  FROM placed)
SELECT doc_id, source, size, source_size, target, repeats, size * repeats AS taken FROM counted
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@query("op9_recompression")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.repeat_digest(table(spark, sf_dir, "documents"))


@query("op6_suffix")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.shared_digest(table(spark, sf_dir, "documents"))


@query("op1_minhash", r"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
    WHEN len(w) = 1 THEN w ELSE [] END) AS s FROM cut),
flat AS (SELECT doc_id, unnest(s) AS g FROM sets),
sizes AS (SELECT doc_id, COALESCE(len(s), 0)::BIGINT AS n FROM sets),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS k FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT * FROM (WITH RECURSIVE r(x, y) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT r.x, b.y FROM r JOIN both_ways b ON b.x = r.y) SELECT * FROM r)),
least AS (SELECT x, MIN(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN least ON x = doc_id
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2)


@query("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_language")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs))


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op2_token_count")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"))


@query("op8_cross_polytope")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("bigint"))


@query("op12_lines", r"""
WITH cut AS (SELECT doc_id, string_split(COALESCE(text, ''), chr(10)) AS parts FROM documents),
flat AS (
  SELECT doc_id, number, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS number FROM cut)),
found AS (SELECT k, MAX(doc_id) AS keeper FROM flat WHERE length(k) >= 20 GROUP BY k HAVING COUNT(DISTINCT doc_id) >= 3),
marked AS (SELECT f.*, COALESCE(f.doc_id <> g.keeper, FALSE) AS gone FROM flat f LEFT JOIN found g USING (k))
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (gone) AS n_dropped,
  sha256(COALESCE(string_agg(line, chr(10) ORDER BY number) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    return lines.drop_repeated_lines(docs).select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


@query("op13_hard_negatives", r"""
WITH raw AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS lab, embedding FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
rows_ AS (SELECT vec_id, lab, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM raw),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.lab = b.lab AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM rows_ a JOIN rows_ b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
liked AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM liked p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 5
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return bond.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)
