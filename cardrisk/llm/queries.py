"""The dealt operators as registered queries over whole tables, with SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.llm import (
    alignment,
    ann,
    chat,
    decontam,
    linededup,
    packing,
    quality,
    secrets,
    simhash,
    structure,
    token_counts,
    urls,
    warc,
)
from cardrisk.llm.tokens import vocabulary
from cardrisk.session import scratch

#: Fixed values: (action, host, path).
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Names whose pages make up the list of canonical URLs.
LISTED_NAMES = ["spam-farm", "cheap-pills", "casino-win", "ads-track", "free-bets"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents inserted with an estimate, revised by their exact counts, labelled toxic ones taken down again.

    The exact counts are committed a second time, as after a restart, which changes nothing.
    """
    docs = table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    version_of = token_counts.tokenizer_version(vocabulary("byte_bpe_50k.json"))

    def events(op: str, version: int, tokenizer: str, tokens) -> DataFrame:
        return docs.select("doc_id", F.lit(tokenizer).alias("tokenizer"), F.lit(version).alias("version"), F.lit(op).alias("op"),
                           "source", "lang", tokens.alias("tokens"))

    exact = events("revise", 2, version_of, token_counts.count_tokens(F.col("text"), vocabulary("byte_bpe_50k.json")))
    estimates = events("insert", 1, version_of, F.ceil(size / 4)).unionByName(events("insert", 1, "utf8_bytes", size))
    gone = table(spark, sf_dir, "labels").filter("toxic = 1").select(
        "doc_id", F.explode(F.array(F.lit(version_of), F.lit("utf8_bytes"))).alias("tokenizer"), F.lit(3).alias("version"),
        F.lit("delete").alias("op"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("lang"),
        F.lit(None).cast("long").alias("tokens"))
    rollup = token_counts.TokenRollup(spark, scratch(spark, "token-rollup"))
    for batch, changes in (("1-estimates", estimates), ("2-exact", exact), ("3-takedowns", gone), ("2-exact", exact)):
        rollup.apply(batch, changes)
    return rollup.totals()


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.scan(docs, secrets.fit(docs)))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digest(packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(linededup.dedup(table(spark, sf_dir, "documents")))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    host, path = urls.host_of(F.col("url")), urls.path_of(F.col("url"))
    named = F.exists(F.split(host, r"\."), lambda label: label.isin(LISTED_NAMES))
    listed = pages.filter(named).select(urls.canonical(host, path).alias("canonical"))
    return urls.judge(pages, listed, URL_RULES)


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with one turn in twenty dropped, emptied, robbed of its sentence ends, repeated, or set to user each."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    hurt = turns.filter(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"))
    return hurt.drop("_copy")


def op11_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return structure.digest(turns, structure.repair(damaged(turns)))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = scratch(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), archive)
    return warc.digest(warc.read(spark, archive))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.measures(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                              vocabulary("piece_bpe_32k.model"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_secret_scan": op3_secret_scan,
    "op4_simhash": op4_simhash,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_decontamination": op8_decontamination,
    "op9_line_dedup": op9_line_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_structure": op11_structure,
    "op12_warc": op12_warc,
    "op13_alignment": op13_alignment,
}

CHAT_SQL = """
WITH d AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
p AS (
  SELECT conv_id, turn,
    string_agg(turn || ':' || length(role) || ':' || role || length(text) || ':' || text, '|')
      OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS prefix,
    count(*) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS n,
    count(*) OVER (PARTITION BY conv_id) AS n_all
  FROM d
),
k AS (
  SELECT min(conv_id) AS conv_id, max(n) AS n_turns, count(*) AS copies
  FROM p WHERE n = n_all AND prefix NOT IN (SELECT prefix FROM p WHERE n < n_all)
  GROUP BY prefix
)
SELECT k.conv_id, CAST((n.at - 1) // 256 AS BIGINT) AS part, k.n_turns, k.copies,
  string_agg('<|' || n.role || '|>' || chr(10) || n.text || '<|end|>' || chr(10), '' ORDER BY n.at) AS text
FROM k JOIN (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS at FROM d
) n USING (conv_id) GROUP BY ALL
"""

URL_SQL = """
WITH r AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
h AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM r
),
c AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '') END AS canonical,
    len(list_intersect(string_split(host, '.'),
      ['spam-farm', 'cheap-pills', 'casino-win', 'ads-track', 'free-bets'])) > 0 AS named
  FROM h
),
rules AS (
  SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) AS t(action, name, start)
),
best AS (
  SELECT c.page_id, c.host, c.path, arg_max(name || start, length(name || start)) AS rule,
    arg_max(action, length(name || start)) AS action
  FROM c JOIN rules ON (c.host = name OR c.host LIKE '%.' || name) AND starts_with(c.path, start)
  GROUP BY ALL
),
l AS (SELECT DISTINCT canonical FROM c WHERE named)
SELECT c.page_id, c.host, c.path, b.rule,
  coalesce(b.action, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  l.canonical IS NOT NULL AS listed
FROM c LEFT JOIN best b ON b.page_id = c.page_id LEFT JOIN l ON l.canonical = c.canonical
"""

WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS newest FROM pages
),
d AS (SELECT *, sha1(payload) AS hex FROM p)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  array_to_string([translate(to_base(CAST('0x' || substr(hex, 5 * i + 1, 5) AS BIGINT), 32, 4),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') FOR i IN range(8)], '') AS payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM d
"""

ORACLES = {
    "op2_chat_formatting": CHAT_SQL,
    "op10_url_filter": URL_SQL,
    "op12_warc": WARC_SQL,
}
