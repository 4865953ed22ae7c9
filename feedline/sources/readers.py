"""Batch readers for one micro-batch's files.

The discovery stream hands us a bounded list of new paths; each reader turns
them into a DataFrame *of raw values* plus hidden provenance columns.  Text
formats are read without type coercion where possible, so the schema step
can type them, rescue what does not fit and keep values such as ``0050`` or
``2.50`` exactly as written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedline.plans.registry import IngestConfig
from feedline.sources.headers import csv_headers, literal_paths

# Formats, and XML attribute prefix / value tag of the landing contract.
FILE_FORMATS = ("csv", "json", "jsonl", "parquet", "avro", "xml")
XML_ATTRIBUTE_PREFIX = "_"
XML_VALUE_TAG = "_VALUE"

# Hidden provenance columns carried from the scan to the sink.
SRC = "__src_file"
MTIME = "__src_mtime"
BLOCK = "__src_block"
POS = "__src_pos"
# The record as written, where the reader could not place all of it (rescued by the schema step).
CORRUPT = "__src_corrupt"
HIDDEN = (SRC, MTIME, BLOCK, POS, CORRUPT)


def check_format(cfg: IngestConfig) -> None:
    """S15 + the XML guard: fail before any I/O."""
    if cfg.file_format not in FILE_FORMATS:
        raise ValueError(f"Unsupported file format: '{cfg.file_format}'")
    if cfg.file_format == "xml" and not cfg.row_tag:
        raise ValueError("XML sources require a row_tag in the object metadata.")


def _with_provenance(df: DataFrame) -> DataFrame:
    """Hidden file metadata: path, mtime, split start and a row position.

    ``monotonically_increasing_id`` grows with the row order inside one split;
    (mtime, path, split start, position) is therefore a total order of the rows of
    a batch that follows the files' content (W2)."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(SRC),
        F.col("_metadata.file_modification_time").alias(MTIME),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(POS),
    )


def _reader(spark: SparkSession, cfg: IngestConfig):
    """A DataFrameReader; for hive-style layouts the base path keeps the ``key=value``
    folders as partition columns (S10)."""
    reader = spark.read
    if cfg.hive_partitioned and cfg.base_path:
        reader = reader.option("basePath", cfg.base_path)
    return reader


def string_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def as_written(schema: T.StructType) -> T.StructType:
    """``schema`` with top-level values as strings, so that they are kept as written until the schema step types
    them and rescues what does not fit; nested values keep their types.  With room for malformed records."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    fields = [T.StructField(f.name, f.dataType if isinstance(f.dataType, nested) else T.StringType(), True)
              for f in schema.fields if f.name != CORRUPT]
    return T.StructType(fields + [T.StructField(CORRUPT, T.StringType(), True)])


def _with_extras(explicit: T.StructType, found: T.StructType) -> T.StructType:
    """The explicit schema, and behind it what the files hold beyond it, so that it is rescued and not dropped."""
    from feedline.operators.schema import merge_nested

    have = {f.name.lower() for f in explicit.fields}
    extra = [f for f in found.fields if f.name.lower() not in have and f.name != CORRUPT]
    return T.StructType(merge_nested(T.StructType(explicit.fields), T.StructType(
        [f for f in found.fields if f.name.lower() in have])).fields + extra)


def _typed_as(found: T.StructType):
    """The inferred types of columns read as written, by name."""
    types = {f.name: f.dataType for f in found.fields}
    return lambda columns: {c: types[c] for c in columns if c in types}


class Batch:
    """A batch read: the raw frame and, for formats read as strings, a way to type
    columns that enter the tracked schema."""

    def __init__(self, df: DataFrame, infer=None):
        self.df = df
        self.infer = infer  # callable(list of column names) -> {name: DataType}


def _widen(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    numeric = (T.LongType, T.DoubleType)
    if isinstance(a, numeric) and isinstance(b, numeric):
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def csv_type_inference(spark: SparkSession, groups, cfg: IngestConfig):
    """Spark's own CSV schema inference (one distributed pass) over the header groups
    that hold the requested columns; integral columns are widened to bigint and
    types that disagree between groups are widened (else string)."""
    opts = {"sep": cfg.delimiter, "encoding": cfg.encoding, "nullValue": cfg.null_value,
            "header": "true", "inferSchema": "true"}

    def infer(columns: list[str]) -> dict[str, T.DataType]:
        wanted = {c.lower() for c in columns}
        out: dict[str, T.DataType] = {}
        for names, group_paths in groups:
            if not wanted & {n.lower() for n in names}:
                continue
            schema = spark.read.options(**opts).csv(literal_paths(group_paths)).schema
            for name, f in zip(names, schema.fields):
                if name.lower() not in wanted:
                    continue
                dt = f.dataType
                if isinstance(dt, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
                    dt = T.LongType()
                elif isinstance(dt, (T.FloatType, T.DecimalType)):
                    dt = T.DoubleType()
                elif isinstance(dt, T.TimestampNTZType):
                    dt = T.TimestampType()
                out[name] = _widen(out[name], dt) if name in out else dt
        return out

    return infer


def read_csv(spark: SparkSession, paths: list[str], cfg: IngestConfig) -> Batch | None:
    """Header CSV is grouped by header line so every file is read by name, not position.

    Each group is read with an all-string schema built from its own header (no
    inference pass); groups are combined with ``unionByName(allowMissingColumns)``.
    An explicit schema means headerless files read by position (S11)."""
    opts = {"sep": cfg.delimiter, "encoding": cfg.encoding, "nullValue": cfg.null_value,
            "mode": "PERMISSIVE"}
    opts["columnNameOfCorruptRecord"] = CORRUPT

    def read(names: list[str], header: str, files: list[str]) -> DataFrame:
        schema = T.StructType(string_schema(names).fields + [T.StructField(CORRUPT, T.StringType(), True)])
        df = _reader(spark, cfg).options(header=header, enforceSchema="true", **opts).schema(schema).csv(literal_paths(files))
        return _with_provenance(df).withColumn(CORRUPT, _surplus(len(names), cfg))

    if cfg.schema is not None:
        return Batch(read([f.name for f in cfg.schema.fields], "false", paths))
    groups = csv_headers(spark, paths, cfg.delimiter, cfg.encoding)
    frames = [read(names, "true", group_paths) for names, group_paths in groups]
    if not frames:
        return None
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    infer = None if cfg.cast_all_as_string else csv_type_inference(spark, groups, cfg)
    return Batch(df, infer)


_END = "\x01end of record\x01"


def _surplus(columns: int, cfg: IngestConfig) -> Column:
    """The line of a record with more tokens than columns, else NULL.  The reader marks short records too: in these a
    token put at the end still falls on a column."""
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(columns)])
    again = F.from_csv(F.concat(F.col(CORRUPT), F.lit(cfg.delimiter + _END)), F.lit(schema.toDDL()), {"sep": cfg.delimiter})
    short = F.coalesce(F.array_contains(F.array(*[again[f"c{i}"] for i in range(columns)]), _END), F.lit(False))
    return F.when(F.col(CORRUPT).isNotNull() & ~short, F.col(CORRUPT))


def read_json(spark: SparkSession, paths: list[str], cfg: IngestConfig, lines: bool) -> Batch:
    """JSON (multiLine from config, comments allowed) or JSON Lines.

    Spark's own distributed pass finds the columns (and their types); the records are then read as
    written.  With ``cast_all_as_string`` nested leaves are strings too (``primitivesAsString``)."""
    reader = _reader(spark, cfg).option("primitivesAsString", str(cfg.cast_all_as_string).lower())
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if lines:
        reader = reader.option("multiLine", "false")
    else:
        reader = reader.option("multiLine", str(cfg.multiline).lower()).option("allowComments", "true")
    files = literal_paths(paths)
    found = reader.json(files).schema
    wanted = _with_extras(cfg.schema, found) if cfg.schema is not None else found
    return Batch(_with_provenance(reader.schema(as_written(wanted)).json(files)), _typed_as(found))


def _parquet_groups(spark: SparkSession, paths: list[str], cfg: IngestConfig) -> list[tuple[list[str], T.StructType]]:
    """The files in groups whose schemas merge: all of them, or else those of either half.  Spark reads the footers."""
    try:
        return [(paths, _reader(spark, cfg).option("mergeSchema", "true").parquet(*literal_paths(paths)).schema)]
    except Exception as exc:  # noqa: BLE001 - only a clash of types is handled
        if len(paths) == 1 or "CANNOT_MERGE" not in str(exc):
            raise
    half = len(paths) // 2
    merged: dict[str, tuple[list[str], T.StructType]] = {}
    for files, schema in _parquet_groups(spark, paths[:half], cfg) + _parquet_groups(spark, paths[half:], cfg):
        merged.setdefault(schema.json(), ([], schema))[0].extend(files)
    return list(merged.values())


def read_parquet(spark: SparkSession, paths: list[str], cfg: IngestConfig) -> Batch:
    """Self-describing; additive drift across files merges (``mergeSchema``).  A column whose type clashes between
    files is read as text, typed by the widest of its types, and rescued where a tracked type does not hold it."""
    groups = _parquet_groups(spark, paths, cfg)
    if len(groups) == 1:
        return Batch(_with_provenance(_reader(spark, cfg).schema(groups[0][1]).parquet(*literal_paths(groups[0][0]))))
    types: dict[str, list[T.StructField]] = {}
    for _, schema in groups:
        for f in schema.fields:
            types.setdefault(f.name.lower(), []).append(f)
    wide = {n: reduce(_widen, [_plain(f.dataType) for f in fields]) if any(f.dataType != fields[0].dataType for f in fields) else fields[0].dataType
            for n, fields in types.items()}
    clashing = {n for n, fields in types.items() if any(f.dataType != fields[0].dataType for f in fields)}

    def read(files: list[str], schema: T.StructType) -> DataFrame:
        df = _reader(spark, cfg).schema(schema).parquet(*literal_paths(files))
        nested = (T.StructType, T.ArrayType, T.MapType)
        text = {f.name: (F.to_json(f.name) if isinstance(f.dataType, nested) else F.col(f.name).cast("string")) for f in schema.fields if f.name.lower() in clashing}
        return _with_provenance(df).withColumns(text) if text else _with_provenance(df)

    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [read(*g) for g in groups])
    return Batch(df, lambda columns: {c: wide[c.lower()] for c in columns if c.lower() in clashing})


def _plain(dt: T.DataType) -> T.DataType:
    """The widest type of a family, as of columns that are inferred from text."""
    if isinstance(dt, (T.IntegerType, T.ShortType, T.ByteType)):
        return T.LongType()
    return T.DoubleType() if isinstance(dt, T.FloatType) else dt


def read_avro(spark: SparkSession, paths: list[str], cfg: IngestConfig) -> DataFrame:
    """Needs the external spark-avro module on the classpath."""
    try:
        return _with_provenance(_reader(spark, cfg).format("avro").load(literal_paths(paths)))
    except Exception as exc:  # noqa: BLE001 - translate the missing-module error
        msg = str(exc).lower()
        if "avro" in msg and ("find data source" in msg or "not found" in msg
                              or "avro_not_loaded" in msg):
            raise RuntimeError("Avro sources need the spark-avro package on the classpath "
                               "(spark.jars.packages=org.apache.spark:spark-avro_2.13:<version>).") from exc
        raise


def read_xml(spark: SparkSession, paths: list[str], cfg: IngestConfig) -> Batch:
    """Built-in XML source; attributes get prefix ``_``, element text ``_VALUE``.

    One pass finds the elements (and types); records are then read as written, so a value that does not
    fit and an element that an explicit schema lacks are rescued."""
    reader = (_reader(spark, cfg).format("xml").option("rowTag", cfg.row_tag)
              .option("attributePrefix", XML_ATTRIBUTE_PREFIX).option("valueTag", XML_VALUE_TAG)
              .option("columnNameOfCorruptRecord", CORRUPT)
              .option("inferSchema", str(not cfg.cast_all_as_string).lower()))
    files = literal_paths(paths)
    found = reader.load(files).schema
    wanted = _with_extras(cfg.schema, found) if cfg.schema is not None else found
    return Batch(_with_provenance(reader.schema(as_written(wanted)).load(files)), _typed_as(found))


def read_batch(spark: SparkSession, paths: list[str], cfg: IngestConfig) -> Batch | None:
    """Dispatch on ``file_format``; None for an empty path list."""
    check_format(cfg)
    if not paths:
        return None
    fmt = cfg.file_format
    if fmt == "csv":
        return read_csv(spark, paths, cfg)
    if fmt == "json":
        return read_json(spark, paths, cfg, lines=False)
    if fmt == "jsonl":
        return read_json(spark, paths, cfg, lines=True)
    if fmt == "parquet":
        return read_parquet(spark, paths, cfg)
    if fmt == "avro":
        return Batch(read_avro(spark, paths, cfg))
    return read_xml(spark, paths, cfg)
