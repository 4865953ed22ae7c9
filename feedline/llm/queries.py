"""The registered queries of this subpackage: thin digests of the operators' results over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: name -> query, and name -> DuckDB SQL where SQL can express it.
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    from feedline.llm.sentencepiece_ids import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, read back from packed token-id files."""
    from feedline.llm.token_files import token_file_rows

    return token_file_rows(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    from feedline.llm.quality_classifier import quality_scores

    scores = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    from feedline.llm.toxicity import toxicity_scores

    scores = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


#: Host, path and verdict of the url rules.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query
def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    from feedline.llm.url_rules import judge

    return judge(table(spark, sf_dir, "pages"), spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))


ORACLE_SQL["op3_url_rules"] = r"""
WITH rules(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
rest AS (
  SELECT row_number() OVER () AS row_id, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
cut AS (SELECT row_id, page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest),
page AS (
  SELECT row_id, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM cut
),
fits AS (
  SELECT page.*, rules.host || rules.path AS rule, verdict,
         row_number() OVER (PARTITION BY row_id ORDER BY length(rules.host || rules.path) DESC NULLS LAST) AS place
  FROM page LEFT JOIN rules ON (page.host = rules.host OR ends_with(page.host, '.' || rules.host)) AND starts_with(page.path, rules.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""


@query
def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    from feedline.llm.main_text import extract

    return extract(table(spark, sf_dir, "pages"))


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of documents that the labels call good: the target of the quality rules."""
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    from feedline.llm.quality_rules import judge

    rows = judge(table(spark, sf_dir, "documents"), trusted_ids(spark, sf_dir))
    return rows.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows of benchmark items."""
    from feedline.llm.decontamination import contaminated, contamination

    rows = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


ORACLE_SQL["op1_decontamination"] = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[s : s + 12], ' ') AS run
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM item WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM win),
runs AS (
  SELECT doc_id, s, size, array_to_string(w[s : s + size - 1], ' ') AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS s FROM doc) JOIN sizes ON s + size - 1 <= len(w)
),
found AS (SELECT doc_id, s, runs.size, item_id FROM runs JOIN win USING (size, run)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM found) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without later copies of line runs."""
    from feedline.llm.line_dedup import dedup

    return dedup(table(spark, sf_dir, "documents")).select("row.doc_id", "n_lines", "n_removed", "text")


ORACLE_SQL["op10_line_dedup"] = r"""
WITH raw AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (
  SELECT doc_id, spot, trim(lines[spot], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line, len(lines) AS ending
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS spot FROM raw)
),
real AS (
  SELECT doc_id, spot, line, coalesce(lead(spot) OVER d - 1, ending) AS until, row_number() OVER d AS pos,
         len(regexp_extract_all(line, '[^ 	-
]+')) AS n
  FROM line WHERE line <> '' WINDOW d AS (PARTITION BY doc_id ORDER BY spot)
),
doc AS (SELECT doc_id, list(line ORDER BY pos) AS l, list(n ORDER BY pos) AS n FROM real GROUP BY doc_id),
spans AS (
  SELECT doc_id, s, m, l[s : s + m - 1] AS run, list_sum(n[s : s + m - 1]) AS w, n[s] AS w_first, n[s + m - 1] AS w_last
  FROM (SELECT doc_id, l, n, s, unnest(range(1, least(50, len(l) - s + 1) + 1)) AS m FROM (SELECT doc_id, l, n, unnest(range(1, len(l) + 1)) AS s FROM doc))
),
wins AS (SELECT doc_id, s, m, array_to_string(run, chr(10)) AS run FROM spans WHERE w >= 50 AND (w - w_first < 50 OR w - w_last < 50)),
later AS (SELECT doc_id, s, m FROM (SELECT *, min((doc_id, s)) OVER (PARTITION BY run) AS earliest FROM wins) WHERE (doc_id, s) > earliest),
gone AS (
  SELECT doc_id, list(DISTINCT spot) AS gone
  FROM (SELECT doc_id, unnest(range(spot, until + 1)) AS spot FROM real JOIN (SELECT DISTINCT doc_id, unnest(range(s, s + m)) AS pos FROM later) USING (doc_id, pos))
  GROUP BY doc_id
)
SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(lines) END::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed,
       CASE WHEN gone IS NULL THEN text ELSE array_to_string([lines[i] for i in range(1, len(lines) + 1) if NOT list_contains(gone, i)], chr(10)) END AS text
FROM raw LEFT JOIN gone USING (doc_id)
"""


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of 5-word shingle sets."""
    from feedline.llm.jaccard_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    from feedline.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every damaged conversation."""
    from feedline.llm.conversation_repair import repair_damaged

    return repair_damaged(table(spark, sf_dir, "conversations"))


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of rebuilt conversations."""
    from feedline.llm.conversation_trie import prefix_trie, rebuilt

    return prefix_trie(rebuilt(table(spark, sf_dir, "conversations")))
