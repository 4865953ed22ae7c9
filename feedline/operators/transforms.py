"""Per-row transforms between the scan and the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedline.functions.columns import AUDIT_COLUMNS, RESCUE_COLUMN
from feedline.sources.readers import BLOCK, HIDDEN, MTIME, POS, SRC


def cast_all_as_string(df: DataFrame, keep: tuple = HIDDEN) -> DataFrame:
    """Every top-level column becomes a string (hidden columns untouched)."""
    return df.select([F.col(c) if c in keep else F.col(c).cast("string").alias(c)
                      for c in df.columns])


def explode_records(df: DataFrame, key: str) -> DataFrame:
    """One row per element of the top-level array ``key``, then only the element's
    fields.  NULL or empty arrays give no row.  Unlike the reference (D9) the
    ``_rescued_data`` column and provenance survive the explode."""
    if key not in df.columns:
        raise ValueError(f"explode_key '{key}' is not a top-level column")
    dt = df.schema[key].dataType
    if not isinstance(dt, T.ArrayType):
        raise ValueError(f"explode_key '{key}' must be an array, got {dt.simpleString()}")
    carry = [c for c in df.columns if c == RESCUE_COLUMN or c in HIDDEN]
    records = F.col(key)
    if RESCUE_COLUMN in carry:
        # A malformed record has no elements; it stays as one row that holds what was rescued.
        malformed = records.isNull() & F.get_json_object(RESCUE_COLUMN, "$._corrupt_record").isNotNull()
        records = F.when(malformed, F.array(F.lit(None).cast(dt.elementType))).otherwise(records)
    exploded = df.select(F.explode(records).alias("__record"), *carry)
    if isinstance(dt.elementType, T.StructType):
        fields = [F.col(f"__record.`{f.name}`").alias(f.name) for f in dt.elementType.fields]
    else:
        fields = [F.col("__record").alias(key)]
    return exploded.select(*fields, *carry)


def add_audit_columns(df: DataFrame, operation_id: str, source_file=None) -> DataFrame:
    """``_source_file``, ``_ingested_at``, ``_operation_id`` (replacing same-named
    columns, which matters when a landing table is itself the source)."""
    src = source_file if source_file is not None else (
        F.col(SRC) if SRC in df.columns else F.lit(None).cast("string"))
    keep = [c for c in df.columns if c not in AUDIT_COLUMNS]
    return df.select(*keep, src.alias("_source_file"),
                     F.current_timestamp().alias("_ingested_at"),
                     F.lit(operation_id).alias("_operation_id"))


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def latest_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The last version of each key inside one batch.

    Order = (file modification time, path, split start, row position), unique per
    row.  Written as an aggregate rather than a window: the partial aggregate runs
    map-side, so a key holding a third of the batch collapses to one row per task
    before the shuffle instead of landing whole in one window partition.

    One scan of the batch: rows whose key has a NULL never match anything, so each
    gets a group of its own (a unique id next to the keys) and all of them are kept,
    spread over the shuffle by that id however many there are.  Each column travels
    once: ``max(struct(order, values))`` picks the row by its order fields; when a
    value cannot be ordered (a map), ``max_by`` with the order fields repeated."""
    if not keys:
        raise ValueError("merge needs merge_keys")
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"Merge keys not in the data: {missing}")
    order_cols = [c for c in (MTIME, SRC, BLOCK, POS) if c in df.columns]
    if POS not in order_cols:
        df = df.select("*", F.monotonically_increasing_id().alias("__ord"))
        order_cols.append("__ord")
    has_null = None
    for k in keys:
        cond = F.col(k).isNull()
        has_null = cond if has_null is None else (has_null | cond)
    value_cols = [c for c in df.columns if c not in keys and c not in order_cols]
    solo = df.select("*", F.when(has_null, F.monotonically_increasing_id()).alias("__solo"))
    row = F.struct(*order_cols, *value_cols)
    if all(_orderable(df.schema[c].dataType) for c in value_cols):
        pick = F.max(row)
    else:
        pick = F.max_by(row, F.struct(*order_cols))
    latest = (solo.groupBy(*keys, "__solo").agg(pick.alias("__v"))
              .select(*keys, *[F.col(f"__v.`{c}`").alias(c) for c in order_cols + value_cols]))
    return latest.select(*[c for c in df.columns if c != "__ord"])


#: Tasks that a merge batch's rows are dealt over.
MERGE_TASKS = 64


def dealt(df: DataFrame) -> DataFrame:
    """The rows of a batch over ``MERGE_TASKS`` tasks, their order in ``POS``: an aggregate of whole rows sorts a task's rows,
    and a scan's task has at least a row group of a file, however many rows that is."""
    if POS not in df.columns:
        df = df.withColumn(POS, F.monotonically_increasing_id())
    deal = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(16 * MERGE_TASKS))
    return df.withColumn("__deal", deal).repartition(MERGE_TASKS, "__deal").drop("__deal")
