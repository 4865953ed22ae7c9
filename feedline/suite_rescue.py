"""Queries over feeds with records that a reader cannot place whole: nothing of them is lost."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedline.suite import _landing, _new, _run, _single_feed, _t

QUERIES = {}
ORACLE_SQL = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _schema(**columns: T.DataType) -> str:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()]).json()


def _rescued(key: str):
    return F.get_json_object("_rescued_data", f"$.{key}").alias(f"rescued_{key}")


@_query
def ingest_json_explicit_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON Lines under an explicit schema: decimals and leading zeros as written, text in a number and a
    column beyond the schema rescued, malformed lines kept."""
    ws, reg = _new(spark)
    schema = _schema(c_custkey=T.LongType(), c_code=T.StringType(), c_acctbal=T.DecimalType(30, 4))
    raw = _single_feed(spark, ws, reg, "customer", "jsonl", "*", source_kw={"object_schema": schema}, schema_evolution_mode="none")
    line = F.format_string(
        '{"c_custkey": %d, "c_code": "00%d", "c_acctbal": %s, "c_mktsegment": "%s"}', "c_custkey", "c_nationkey",
        F.when(F.col("c_nationkey") == 3, '"unknown"').otherwise(F.concat(F.lit("12345678901234567"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit(".1250"))), "c_mktsegment")
    cut = F.when(F.col("c_nationkey") == 5, F.concat(F.lit("{bad "), F.col("c_custkey").cast("string"))).otherwise(line)
    _t(spark, sf_dir, "customer").select(cut.alias("value")).repartition(3).write.text(raw)
    _run(ws, "op_customer")
    return _landing(spark, ws, "customer").select(
        "c_custkey", "c_code", F.col("c_acctbal").cast("string").alias("c_acctbal"), _rescued("c_acctbal"), _rescued("c_mktsegment"), _rescued("_corrupt_record"))


ORACLE_SQL["ingest_json_explicit_schema"] = """SELECT CASE WHEN c_nationkey <> 5 THEN c_custkey END AS c_custkey,
  CASE WHEN c_nationkey <> 5 THEN '00' || c_nationkey END AS c_code,
  CASE WHEN c_nationkey NOT IN (3, 5) THEN '12345678901234567' || lpad(c_nationkey::VARCHAR, 2, '0') || '.1250' END AS c_acctbal,
  CASE WHEN c_nationkey = 3 THEN 'unknown' END AS rescued_c_acctbal,
  CASE WHEN c_nationkey <> 5 THEN c_mktsegment END AS rescued_c_mktsegment,
  CASE WHEN c_nationkey = 5 THEN '{bad ' || c_custkey END AS rescued__corrupt_record
FROM customer"""


@_query
def ingest_xml_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XML under an explicit schema: a value that does not fit and an element beyond the schema are rescued."""
    ws, reg = _new(spark)
    schema = _schema(p_partkey=T.LongType(), p_size=T.IntegerType(), p_code=T.StringType())
    raw = _single_feed(spark, ws, reg, "part", "xml", "*", source_kw={"row_tag": "part", "object_schema": schema}, schema_evolution_mode="none")
    size = F.when(F.col("p_size") > 25, F.concat(F.col("p_size").cast("string"), F.lit(" cm"))).otherwise(F.col("p_size").cast("string"))
    rows = _t(spark, sf_dir, "part").select("p_partkey", size.alias("p_size"), F.concat(F.lit("00"), F.col("p_size").cast("string")).alias("p_code"), "p_brand")
    rows.repartition(2).write.format("xml").option("rootTag", "parts").option("rowTag", "part").save(raw)
    _run(ws, "op_part")
    return _landing(spark, ws, "part").select("p_partkey", "p_size", "p_code", _rescued("p_size"), _rescued("p_brand"))


ORACLE_SQL["ingest_xml_rescue"] = """SELECT p_partkey, CASE WHEN p_size <= 25 THEN p_size::INTEGER END AS p_size, '00' || p_size AS p_code,
  CASE WHEN p_size > 25 THEN p_size || ' cm' END AS rescued_p_size, p_brand AS rescued_p_brand FROM part"""


@_query
def ingest_csv_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with tokens beyond the columns are kept as written; short lines have nothing to rescue."""
    ws, reg = _new(spark)
    schema = _schema(o_orderkey=T.LongType(), o_orderstatus=T.StringType(), o_totalprice=T.DoubleType())
    raw = _single_feed(spark, ws, reg, "orders", "csv", "*", source_kw={"object_schema": schema, "delimiter": "|"}, schema_evolution_mode="none")
    full = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", F.col("o_totalprice").cast("string"))
    line = F.when(F.col("o_orderstatus") == "F", F.concat(full, F.lit("|late|"), F.col("o_custkey").cast("string")))
    line = line.when(F.col("o_orderstatus") == "P", F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus")).otherwise(full)
    _t(spark, sf_dir, "orders").select(line.alias("value")).repartition(3).write.text(raw)
    _run(ws, "op_orders")
    surplus = F.element_at(F.split(_rescued("_corrupt_record"), r"\|"), -1).alias("surplus")
    return _landing(spark, ws, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", surplus)


ORACLE_SQL["ingest_csv_ragged"] = """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
  CASE WHEN o_orderstatus = 'F' THEN o_custkey::VARCHAR END AS surplus FROM orders"""


@_query
def ingest_parquet_type_clash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that disagree on a column's type land in one run: whole and real numbers as real, numbers and text as text; a
    later file with text in a tracked number is rescued."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "part", "parquet", "*.parquet")
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice", "p_name")
    size = F.col("p_size")
    p.where("p_partkey % 3 = 0").select("p_partkey", size.cast("int").alias("p_size"), size.cast("int").alias("tag"), "p_retailprice", "p_name").write.parquet(raw)
    p.where("p_partkey % 3 = 1").select("p_partkey", size.cast("double").alias("p_size"), F.concat(size.cast("string"), F.lit(" cm")).alias("tag"), "p_retailprice", "p_name").write.mode("append").parquet(raw)
    _run(ws, "op_part")
    p.where("p_partkey % 3 = 2").select("p_partkey", F.concat(F.lit("s"), size.cast("string")).alias("p_size"), size.cast("string").alias("tag"), "p_retailprice", "p_name").write.mode("append").parquet(raw)
    _run(ws, "op_part")
    return _landing(spark, ws, "part").select("p_partkey", "p_size", "tag", "p_retailprice", "p_name", _rescued("p_size"))


ORACLE_SQL["ingest_parquet_type_clash"] = """SELECT p_partkey, CASE WHEN p_partkey % 3 <> 2 THEN p_size::DOUBLE END AS p_size,
  p_size || CASE WHEN p_partkey % 3 = 1 THEN ' cm' ELSE '' END AS tag, p_retailprice, p_name,
  CASE WHEN p_partkey % 3 = 2 THEN 's' || p_size END AS rescued_p_size FROM part"""
