"""Each operator as a query over its whole table, and its SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm import (decontamination, fertility, fim, mixing, neardup, notices, packing, pii, repeats, toxicity,
                           url_cascade, warc, whitening)
from visitlens.llm.common import table
from visitlens.session import scratch_path

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


@query("op1_packed_ids")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.written_documents(table(spark, sf_dir, "documents"), scratch_path(spark, "packed"))


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_latent_leaks")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_notices")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices.notice_report(notices.find_notices(table(spark, sf_dir, "documents")))


@query("op5_fertility")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(table(spark, sf_dir, "documents"))


@query("op6_pivotal_mix")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(mixing.decide(table(spark, sf_dir, "documents")))


URL_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block"))


@query("op7_bloom_cascade", r"""
WITH parsed AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path
  FROM parsed),
rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
ruled AS (
  SELECT page_id, host, path, (SELECT max({'n': length(h) + length(p), 'r': h || p, 'v': v}) FROM rules
    WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best FROM split),
bad AS (
  SELECT host FROM ruled WHERE host <> '' GROUP BY host
  HAVING 2 * count(*) FILTER (best.v = 'block') >= count(*))
SELECT page_id, host, path, best.r AS rule,
  coalesce(best.v, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "rule string, verdict string")
    return url_cascade.judge_pages(table(spark, sf_dir, "pages"), rules)


@query("op8_minhash", r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 OR w IS NULL THEN [] ELSE list_distinct(list_transform(
    range(1, greatest(len(w) - 3, 2)), lambda i: hash(array_to_string(w[i:i + 4], ' ')))) END AS s FROM split),
shingle AS (SELECT doc_id, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY ALL),
link AS (
  SELECT x, y FROM common JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y
  WHERE 100 * n >= 85 * (len(p.s) + len(q.s) - n)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(doc_id, other) AS (
  SELECT x, y FROM edge UNION SELECT r.doc_id, e.y FROM reach r JOIN edge e ON r.other = e.x),
least_one AS (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(sets.doc_id, coalesce(m, sets.doc_id)) AS component_id,
  sets.doc_id = least(sets.doc_id, coalesce(m, sets.doc_id)) AS kept
FROM sets LEFT JOIN least_one USING (doc_id)""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_pii")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digest(pii.find_personal_data(table(spark, sf_dir, "documents")))


@query("op10_warc", """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
h AS (SELECT d, max(page_id) AS head FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
  CASE WHEN page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> head THEN head END AS refers_to
FROM p LEFT JOIN h ON p.d = h.d AND n >= 1000""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op11_fill_in_middle", """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
h AS (
  SELECT *, CAST('0x' || k[1:8] AS BIGINT) % (n + 1) AS a, CAST('0x' || k[9:16] AS BIGINT) % (n + 1) AS b,
    CAST('0x' || k[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || k[25:32] AS BIGINT) % 100 AS h4 FROM t),
f AS (
  SELECT *, least(a, b) AS lo, greatest(a, b) AS hi,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
      WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT *, '<P>' || substr(t, 1, lo) AS prefix, '<M>' || substr(t, lo + 1, hi - lo) AS middle,
    '<S>' || substr(t, hi + 1) AS suffix FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN prefix || suffix || middle
    ELSE suffix || prefix || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.fill_in_middle(table(spark, sf_dir, "documents")))


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components_of(whitening.whiten(table(spark, sf_dir, "embeddings")))


@query("op13_repeats", r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
  FROM documents),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM w),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w WHERE len(w) >= 20)),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM win)
  WHERE r > 1),
marked AS (
  SELECT word.doc_id, word.i, x, max(CASE WHEN again.i IS NULL THEN 0 ELSE 1 END) OVER (
    PARTITION BY word.doc_id ORDER BY word.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM word LEFT JOIN again ON word.doc_id = again.doc_id AND word.i = again.i),
cut AS (
  SELECT doc_id, sum(gone) AS n, string_agg(x, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM marked GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN cut ON w.doc_id = cut.doc_id""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
