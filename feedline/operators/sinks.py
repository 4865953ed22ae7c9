"""Landing-table sinks (K1-K8, K10, K13, T7) on plain parquet tables.

* append    -- table partitioned by ``_batch_id`` (+ the user's partition
               columns); each micro-batch is ``INSERT OVERWRITE ... PARTITION
               (_batch_id='<op>-<generation>-<batch>')`` so a re-delivered batch
               replaces itself instead of duplicating (T7).
* merge     -- the batches of a run wait in folders (``stage``) and are merged at its end, so
               the target is rewritten once a run and not once a batch.  New snapshot = (target rows whose key is not in the batch) ∪ batch,
               written to a fresh directory, then the table is re-pointed.  The
               snapshot is bucketed on the merge keys, so the next merge's anti-join
               reads the target bucket by bucket and shuffles only the batch (AQE
               may still broadcast a batch whose measured size is under the
               threshold).  When the partition columns are merge keys, only the
               touched partitions are rebuilt instead.
* overwrite -- the first non-empty batch of a run starts a fresh snapshot; later
               batches of the same run add their ``_batch_id`` partitions to it,
               so a snapshot spread over several micro-batches stays whole (D8), also when
               the run dies between them and is taken up again: the snapshot stays open in
               the commit log until the run ends.

Merge and overwrite write their versions to a commit log before they show them
(``feedline.operators.commits``); a run that dies at any step is completed by the next.

Delta Lake is not on this classpath; these sinks keep its observable contract
(append / upsert / replace, additive schema merge) with parquet + the catalog.
"""

from __future__ import annotations

import functools
import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedline.functions.columns import BATCH_COLUMN
from feedline.operators import commits, tables
from feedline.operators.commits import CommitLog, batch_of
from feedline.operators.schema import convert, merge_nested
from feedline.operators.transforms import latest_per_key
from feedline.sources.readers import MTIME
from feedline.workspace import quote, sql_string

def step(name: str) -> None:
    commits.step(name)


LOAD_TYPES = ("append", "merge", "overwrite")


class Target:
    """A landing table: catalog name, base location, partition columns."""

    def __init__(self, name: str, location: str, partition_cols: list[str]):
        self.name = name
        self.location = location.rstrip("/")
        self.partition_cols = list(partition_cols)

        self._log: CommitLog | None = None

    def log(self, spark: SparkSession) -> CommitLog:
        if self._log is None:
            self._log = CommitLog(spark, self.name, self.location)
        return self._log


def _check_partition_cols(df: DataFrame, cols: list[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Partition columns not in the data: {missing}")


def _evolve_table(spark: SparkSession, target: Target, df: DataFrame, merge_schema: bool) -> None:
    """Additive schema merge of the landing table: new top-level columns are added; a
    nested column that gained fields gets the wider type (table re-created in place)."""
    table_schema = spark.table(target.name).schema
    have = {f.name.lower(): f for f in table_schema.fields}
    new = [f for f in df.schema.fields if f.name.lower() not in have]
    widened = {}
    for f in df.schema.fields:
        old = have.get(f.name.lower())
        if old is not None and isinstance(old.dataType, (T.StructType, T.ArrayType, T.MapType)):
            merged = merge_nested(old.dataType, f.dataType)
            if merged != old.dataType:
                widened[old.name] = merged
    if not new and not widened:
        return
    if not merge_schema:
        raise ValueError(f"Batch has columns {[f.name for f in new] + list(widened)} that "
                         f"{target.name} lacks and merge_schema is false.")
    if widened:
        parts = tables.partition_columns(spark, target.name)
        data = [T.StructField(f.name, widened.get(f.name, f.dataType), True)
                for f in table_schema.fields if f.name not in parts]
        tables.replace_schema(spark, target.name, T.StructType(
            data + [T.StructField(f.name, f.dataType, True) for f in new]
            + [table_schema[p] for p in parts]))
    else:
        tables.add_missing_columns(spark, target.name, T.StructType(new))


def _insert_batch_partition(spark: SparkSession, target: Target, df: DataFrame, token: str) -> None:
    """INSERT OVERWRITE the partition ``_batch_id = token`` (static) with the user's
    partition columns dynamic: a retry of the same batch replaces exactly its rows."""
    schema = spark.table(target.name).schema
    pcols = target.partition_cols
    by_lower = {c.lower(): c for c in df.columns}
    data_cols = [f for f in schema.fields if f.name != BATCH_COLUMN and f.name not in pcols]
    select = []
    for f in data_cols + [schema[p] for p in pcols]:
        src = by_lower.get(f.name.lower())
        if src is None:
            select.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[src].dataType == f.dataType:
            select.append(F.col(src).alias(f.name))
        else:
            select.append(convert(F.col(src), df.schema[src].dataType, f.dataType).alias(f.name))
    view = f"feedline_batch_{uuid.uuid4().hex}"
    df.select(*select).createOrReplaceTempView(view)
    session = df.sparkSession
    spec = ", ".join([f"{quote(BATCH_COLUMN)} = {sql_string(token)}"] + [quote(p) for p in pcols])
    try:
        session.sql(f"INSERT OVERWRITE TABLE {target.name} PARTITION ({spec}) "
                    f"SELECT * FROM {quote(view)}")
    finally:
        session.catalog.dropTempView(view)


def append(spark: SparkSession, df: DataFrame, target: Target, token: str,
           merge_schema: bool = True) -> None:
    """K1/K2 + T7."""
    _check_partition_cols(df, target.partition_cols)
    staged = df.withColumn(BATCH_COLUMN, F.lit(token))
    if not tables.table_exists(spark, target.name):
        tables.create_table(spark, target.name, staged.schema,
                            [BATCH_COLUMN] + target.partition_cols, target.location)
    else:
        _evolve_table(spark, target, staged, merge_schema)
    _insert_batch_partition(spark, target, staged, token)


def overwrite(spark: SparkSession, df: DataFrame, target: Target, token: str,
              run_state: dict) -> None:
    """K6: full replace (schema included) by the run's snapshot.  With ``resume`` in
    ``run_state`` a snapshot that an earlier, broken run of the same stream left open is gone on with."""
    _check_partition_cols(df, target.partition_cols)
    staged = df.withColumn(BATCH_COLUMN, F.lit(token))
    parts = [BATCH_COLUMN] + target.partition_cols
    log = target.log(spark)
    if run_state.get("overwrite_table") != target.name:
        log.recover()
        last = log.last()
        if not (run_state.get("resume") and last and last["is_open"] and batch_of(last["token"])[0] == batch_of(token)[0]):
            location = tables.new_snapshot_dir(target.location, "o")
            staged.write.mode("overwrite").partitionBy(*parts).parquet(location)
            log.commit("overwrite", token, location, _table_order(staged.schema, parts), parts, is_open=True)
            run_state["overwrite_table"] = target.name
            return
        run_state["overwrite_table"] = target.name
    _evolve_table(spark, target, staged, True)
    step("evolved")
    _insert_batch_partition(spark, target, staged, token)
    step("inserted")


def stage(spark: SparkSession, df: DataFrame, target: Target, token: str, empty: Callable[[], bool]) -> None:
    """Keeps a merge batch for ``merge_staged``; a batch that the table holds already is not kept again."""
    _check_partition_cols(df, target.partition_cols)
    log = target.log(spark)
    if not log.holds(token):
        log.stage(df, token, empty)


def read_staged(spark: SparkSession, staged: list, file_as: str | None = None) -> DataFrame:
    """The rows of staged batches; ``MTIME`` is the place of a row's batch among them."""
    schema = functools.reduce(_merged_schema, [T.StructType.fromJson(json.loads(r["table_schema"])) for r in staged])
    df = spark.read.schema(schema).parquet(*[r["location"] for r in staged])
    order = F.create_map(*[F.lit(x) for i, r in enumerate(staged) for x in (r["location"].rsplit("/", 1)[1], i)])
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    file = [F.col("_metadata.file_path").alias(file_as)] if file_as else []
    return df.select("*", F.element_at(order, F.url_decode(folder)).alias(MTIME), *file)


def merge_staged(spark: SparkSession, target: Target, keys: list[str], merge_schema: bool = True,
                 replaces: tuple[str, str, int] | None = None) -> None:
    """One merge of all batches that wait, the newest version of each key among them; batches that a
    broken run left are taken along.  With ``replaces`` (operation, stream, batch number), the waiting batches of that
    stream from that number on take the place of all rows that the operation wrote before."""
    log = target.log(spark)
    log.recover()
    waiting = log.waiting()
    if replaces:
        operation, stream, number = replaces
        place = {r["token"]: batch_of(r["token"]) for r in waiting}
        if (stream, number) in place.values():
            waiting = [r for r in waiting if place[r["token"]][0] != stream or place[r["token"]][1] >= number]
        else:
            replaces = None  # it was merged by an earlier run
    if not waiting:
        return
    df = read_staged(spark, waiting)
    df = latest_per_key(df, keys).drop(MTIME) if len(waiting) > 1 else df.drop(MTIME)
    tokens = [r["token"] for r in waiting]
    # A row keeps the token of the run's last batch, as it was merged with that one.
    merge(spark, df, target, keys, tokens[-1], merge_schema, tokens, operation if replaces else None)


def merge(spark: SparkSession, df: DataFrame, target: Target, keys: list[str], token: str,
          merge_schema: bool = True, tokens: list[str] = (), instead_of: str | None = None) -> None:
    """K3/K4/K5 (+ J2): upsert the (already de-duplicated) batch on ``keys``; ``tokens`` are the batches in it.
    With ``instead_of``, the rows that this operation wrote before are left out of the new version.

    A batch that the table holds already changes nothing, also its NULL-key rows are not added again."""
    if not keys:
        raise ValueError("merge needs merge_keys")
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"Merge keys not in the data: {missing}")
    _check_partition_cols(df, target.partition_cols)
    log = target.log(spark)
    log.recover()
    if not tokens and log.holds(token):
        return
    staged = df.withColumn(BATCH_COLUMN, F.lit(token))
    pcols = target.partition_cols
    scoped = bool(pcols) and set(pcols) <= set(keys)
    if (scoped and not instead_of and tables.table_exists(spark, target.name)
            and tables.partition_columns(spark, target.name) == pcols):
        if _merge_touched_partitions(spark, staged, target, keys, merge_schema, token, tokens):
            return
    buckets = None
    # Bucketed on the merge keys only when none of them is a partition column: Spark keeps
    # bucket and partition columns apart, and buckets on a subset of the join keys would
    # not spare the target's shuffle (co-partitioning needs all join keys) while every
    # task of that shuffle would write a file for every bucket.
    part_lower = {p.lower() for p in pcols}
    bucket_cols = list(keys)
    bucketable = not any(k.lower() in part_lower for k in keys)
    if not tables.table_exists(spark, target.name):
        if bucketable:
            buckets = (bucket_cols, merge_buckets(spark))
        merged = _by_bucket(staged, buckets)  # K4: first batch seeds the table
    else:
        current = spark.table(target.name)
        if instead_of:
            current = current.where(~F.col("_operation_id").eqNullSafe(F.lit(instead_of)))
        new_cols = [c for c in staged.columns if c.lower() not in {x.lower() for x in current.columns}]
        if new_cols and not merge_schema:
            raise ValueError(f"Batch has columns {new_cols} that {target.name} lacks "
                             "and merge_schema is false.")
        spec = tables.bucket_spec(spark, target.name)
        co_bucketed = bool(spec) and {c.lower() for c in spec[0]} == {k.lower() for k in bucket_cols}
        if bucketable:
            # Bucketed target: the batch is hash-partitioned like the buckets, so the
            # anti-join reads the target bucket by bucket and shuffles the batch only.
            # A target not (yet) bucketed on these keys is shuffled this once; the
            # snapshot written now is bucketed, so later merges are not.
            buckets = spec if co_bucketed else (bucket_cols, spec[1] if spec else merge_buckets(spark))
        batch = _by_bucket(staged, buckets)
        key_null = None
        for k in keys:
            cond = F.col(k).isNull()
            key_null = cond if key_null is None else (key_null | cond)
        # NULL keys never match: those target rows pass through without joining
        # (a NULL-key hot spot would otherwise pile up in one shuffle partition).
        untouched = (current.where(~key_null)
                     .join(_by_keys(staged, buckets).select(*keys).where(~key_null), keys, "left_anti")
                     .unionByName(current.where(key_null)))
        schema = _merged_schema(current.schema, staged.schema)  # K5
        kept = _align(untouched, schema)
        if buckets and not co_bucketed:
            kept = _by_bucket(kept, buckets)  # one file per bucket, not one per task and bucket
        merged = kept.unionByName(_align(batch, schema))
    location = tables.new_snapshot_dir(target.location, "m")
    order = _table_order(merged.schema, target.partition_cols)
    if buckets:
        buckets = _write_bucketed(spark, merged.select(*order.fieldNames()), target, order, buckets, location)
    else:
        writer = merged.write.mode("overwrite")
        if target.partition_cols:
            writer = writer.partitionBy(*target.partition_cols)
        writer.parquet(location)
    step("snapshot written")
    log.commit("merge", token, location, order, target.partition_cols, buckets, tokens=tokens)


# Session setting that sizes the buckets of new merge targets (a table keeps its count).
MERGE_BUCKETS_CONF = "spark.feedline.merge.buckets"


def merge_buckets(spark: SparkSession) -> int:
    """Bucket count of a new merge target: ``spark.feedline.merge.buckets`` when set (size
    it so one bucket of the grown table is a comfortable task), else the session's
    shuffle parallelism; kept by the table from then on."""
    value = spark.conf.get(MERGE_BUCKETS_CONF, None) or spark.conf.get(
        "spark.sql.shuffle.partitions", "200")
    try:
        return max(1, int(value))
    except ValueError:  # a non-numeric setting some deployments allow (e.g. "auto")
        return 200


def _by_bucket(df: DataFrame, buckets: tuple[list[str], int] | None) -> DataFrame:
    """Rows hash-partitioned like the target's buckets: one file per bucket per side.

    Rows with a NULL in a key never match: they are not shuffled by key (a hot NULL key would
    land in one task) but dealt round-robin."""
    if not buckets:
        return df
    key_null = _any_null(df, buckets[0])
    return _by_keys(df, buckets).unionByName(df.where(key_null).repartition(buckets[1]))


def _by_keys(df: DataFrame, buckets: tuple[list[str], int] | None) -> DataFrame:
    """The rows of ``_by_bucket`` without a NULL key; without buckets all rows."""
    if not buckets:
        return df
    by_lower = {c.lower(): c for c in df.columns}
    return (df.where(~_any_null(df, buckets[0]))
            .repartition(buckets[1], *[by_lower[c.lower()] for c in buckets[0]]))


def _any_null(df: DataFrame, keys: list[str]) -> Column:
    by_lower = {c.lower(): c for c in df.columns}
    return functools.reduce(lambda a, b: a | b, [F.col(by_lower[k.lower()]).isNull() for k in keys])


def _write_bucketed(spark: SparkSession, merged: DataFrame, target: Target, schema: T.StructType,
                    buckets: tuple[list[str], int], location: str) -> tuple[list[str], int]:
    """Write a snapshot bucketed on the merge keys (Spark writes bucketed files only
    through a catalog table: a staging entry over the snapshot folder); gives the bucket
    spec under the table's column names."""
    stage = target.name[:-1] + f"__stage_{uuid.uuid4().hex[:12]}`"
    table_names = {f.name.lower(): f.name for f in schema.fields}
    spec = ([table_names[c.lower()] for c in buckets[0]], buckets[1])
    tables.create_table(spark, stage, schema, target.partition_cols, location, spec)
    try:
        merged.write.insertInto(stage)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {stage}")  # external: the files stay
    return spec


def _merge_touched_partitions(spark: SparkSession, staged: DataFrame, target: Target,
                              keys: list[str], merge_schema: bool, token: str, tokens: list[str]) -> bool:
    """Partition-scoped merge, valid when the partition columns are merge keys: a key
    never moves between partitions, so only the partitions the batch touches change.

    Those partitions are rebuilt (their rows not in the batch ∪ the batch) into a
    fresh folder, then each is re-pointed in place, or added if it is new;
    untouched partitions are neither read nor rewritten.  The touched partition
    values reach the driver first (metadata, one row per touched partition) and
    come back as a literal partition filter, so the catalog prunes the target's
    partitions when the scan is planned: a join against the batch would not prune
    (no selective filter for dynamic pruning) and would read every partition.
    Returns False (caller falls back to a full snapshot) for NULL partition values."""
    pcols = target.partition_cols
    touched = [tuple(r) for r in staged.select(*pcols).distinct().collect()]
    if any(v is None for row in touched for v in row):
        return False
    if not touched:
        return True
    _evolve_table(spark, target, staged, merge_schema)
    current = spark.table(target.name)
    key_null = None
    for k in keys:
        cond = F.col(k).isNull()
        key_null = cond if key_null is None else (key_null | cond)
    if len(pcols) == 1:
        in_partitions = F.col(pcols[0]).isin([row[0] for row in touched])
    else:
        in_partitions = F.struct(*pcols).isin(
            [F.struct(*[F.lit(v).alias(p) for p, v in zip(pcols, row)]) for row in touched])
    in_touched = current.where(in_partitions)
    kept = (in_touched.where(~key_null)
            .join(staged.select(*keys).where(~key_null), keys, "left_anti")
            .unionByName(in_touched.where(key_null)))
    table_schema = current.schema
    staged_types = {f.name.lower(): f for f in staged.schema.fields}
    aligned = staged.select(*[
        (convert(F.col(staged_types[f.name.lower()].name), staged_types[f.name.lower()].dataType,
                 f.dataType) if f.name.lower() in staged_types else F.lit(None).cast(f.dataType))
        .alias(f.name) for f in table_schema.fields])
    rebuilt = kept.select(*table_schema.fieldNames()).unionByName(aligned)
    location = tables.new_snapshot_dir(target.location, "mp")
    rebuilt.write.mode("overwrite").partitionBy(*pcols).parquet(location)
    # The new partition folders, from a listing of the snapshot (no file is opened).
    # Their values are taken from the folder names as written: partition discovery
    # would infer types and turn a string value such as '0050' into 50.
    folders = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .load(location).select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("d"))
               .distinct().collect())
    log = target.log(spark)
    last = log.last()
    moved = dict(last["folders"] or {}) if last and last["kind"] == "partitions" else {}
    moved.update({"/".join(r["d"].rstrip("/").split("/")[-len(pcols):]): r["d"] for r in folders})
    step("snapshot written")
    log.commit("partitions", token, tables.table_location(spark, target.name), _table_order(table_schema, pcols), pcols,
               folders=moved, tokens=tokens)
    return True


def _merged_schema(current: T.StructType, incoming: T.StructType) -> T.StructType:
    """Current columns (nested types widened by the incoming ones) + new columns."""
    inc = {f.name.lower(): f for f in incoming.fields}
    have = {f.name.lower() for f in current.fields}
    fields = [T.StructField(f.name, merge_nested(f.dataType, inc[f.name.lower()].dataType)
                            if f.name.lower() in inc else f.dataType, True) for f in current.fields]
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True)
                                  for f in incoming.fields if f.name.lower() not in have])


def _align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` projected onto ``schema`` (by name; missing -> NULL; nested converted)."""
    by_lower = {f.name.lower(): f for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(convert(F.col(src.name), src.dataType, f.dataType).alias(f.name))
    return df.select(*cols)


def _table_order(schema: T.StructType, parts: list[str]) -> T.StructType:
    data = [f for f in schema.fields if f.name not in parts]
    return T.StructType(data + [schema[p] for p in parts])


def write_counted(spark: SparkSession, df: DataFrame, location: str, name: str) -> int:
    """A2: writes ``df`` to a folder, reads the count back from there and fails on mismatch."""
    obs = Observation(f"publish_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(location)
    expected = int(obs.get.get("rows", 0))
    got = spark.read.schema(df.schema).parquet(location).count()
    if got != expected:
        raise RuntimeError(f"Publish of {name}: wrote {expected} rows, read back {got}.")
    return got


def publish_snapshot(spark: SparkSession, name: str, df: DataFrame, base: str) -> int:
    """K10 + A2: replace ``name`` with ``df`` (empty input clears it), its count read back."""
    location = tables.new_snapshot_dir(base, "p")
    got = write_counted(spark, df, location, name)
    tables.point_table_at(spark, name, df.schema, [], location)
    return got


def drop_batch(spark: SparkSession, target: Target, token: str) -> None:
    """Takes one appended batch out of the table."""
    shown = spark.sql(f"SHOW PARTITIONS {target.name} PARTITION ({quote(BATCH_COLUMN)} = {sql_string(token)})").collect()
    tables.drop_partitions(spark, target.name, [r[0] for r in shown])


def drop_batches_before(spark: SparkSession, target: Target, token: str, operation_id: str) -> None:
    """Takes the batches that an operation appended before ``token`` out of the table, by one statement."""
    if not tables.table_exists(spark, target.name):
        return
    stream, number = batch_of(token)
    older = []
    for r in spark.sql(f"SHOW PARTITIONS {target.name}").collect():
        found = batch_of(tables.partition_values(r[0])[BATCH_COLUMN] or "")
        if re.fullmatch(re.escape(operation_id) + r"-g\d+", found[0]) and (found[0] != stream or found[1] < number):
            older.append(r[0])
    tables.drop_partitions(spark, target.name, older)


def write_batch(spark: SparkSession, df: DataFrame, load_type: str, target: Target,
                keys: list[str], token: str, merge_schema: bool, run_state: dict) -> None:
    """Route one micro-batch by ``load_type`` (K8: unknown type is an error)."""
    if load_type == "append":
        append(spark, df, target, token, merge_schema)
    elif load_type == "merge":
        merge(spark, df, target, keys, token, merge_schema)
    elif load_type == "overwrite":
        overwrite(spark, df, target, token, run_state)
    else:
        raise ValueError(f"Unknown load_type: '{load_type}'")
