"""Run one operation (C7) or all of them (C8), with one audit row per run (K9).

``run_operation`` = registry config -> discovery stream (or table stream) ->
``foreachBatch``: read the batch's files, evolve/rescue, transform, sink ->
audit row in ``finally``.  ``trigger(availableNow=True)`` processes everything
available once, then stops (T1).  Rows written and rows with rescued data are
counted exactly with ``observe()`` on the single write of each batch (A1, D6).
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedline.functions.columns import AUDIT_COLUMNS, RESCUE_COLUMN
from feedline.operators import schema as schema_ops
from feedline.operators import commits, tables
from feedline.operators.commits import CommitLog
from feedline.operators.sinks import Target, drop_batch, drop_batches_before, merge_staged, stage, write_batch
from feedline.operators.transforms import (add_audit_columns, cast_all_as_string,
                                           dealt, explode_records, latest_per_key)
from feedline.plans.registry import FILE_SOURCE, TABLE_SOURCES, IngestConfig, Registry
from feedline.sources.discovery import incremental_files, stream_table
from feedline.sources.readers import HIDDEN, SRC, check_format, read_batch
from feedline.streaming.changes import ChangeFeed
from feedline.workspace import Workspace



@dataclass
class RunResult:
    operation_id: str
    status: str
    rows_written: int
    rescued_rows: int
    duration_ms: int
    error: str | None = None

    def as_dict(self) -> dict:
        return asdict(self)


class Runner:
    def __init__(self, ws: Workspace):
        self.ws = ws
        self.spark: SparkSession = ws.spark
        self.registry = Registry(ws)

    # -- names -----------------------------------------------------------------------
    def target_of(self, cfg: IngestConfig) -> Target:
        name = self.ws.table(cfg.target_catalog, cfg.target_schema, cfg.target_table)
        location = cfg.table_path or self.ws.table_location(
            cfg.target_catalog, cfg.target_schema, cfg.target_table)
        return Target(name, location, list(cfg.partition_cols))

    def source_table_name(self, fq: str) -> str:
        parts = [p.strip("`") for p in fq.split(".")]
        if len(parts) == 3:
            return self.ws.table(*parts)
        return fq

    # -- C7 ----------------------------------------------------------------------------
    def run_operation(self, operation_id: str, raise_errors: bool = True) -> RunResult:
        start = time.time()
        status, error = "SUCCESS", None
        counters = {"rows": 0, "rescued": 0}
        try:
            cfg = self.registry.config(operation_id)
            self._run(cfg, counters)
        except Exception as exc:  # noqa: BLE001 - recorded, then re-raised
            status, error = "FAILED", str(exc)
            if raise_errors:
                raise
        finally:
            result = RunResult(operation_id, status, counters["rows"], counters["rescued"],
                               int((time.time() - start) * 1000), error)
            self.registry.append_audit({
                "operation_id": operation_id, "run_ts": dt.datetime.now(),
                "status": status, "duration_ms": result.duration_ms,
                "rows_written": result.rows_written, "error_message": error,
                "rescued_rows": result.rescued_rows})
        return result

    def _run(self, cfg: IngestConfig, counters: dict) -> None:
        generation = self.registry.generation(cfg.operation_id)
        ck = self.ws.checkpoint_root(cfg.operation_id, generation)
        target = self.target_of(cfg)
        self.ws.ensure_database(cfg.target_catalog, cfg.target_schema)
        run_state: dict = {"resume": True}
        if cfg.load_type != "append":
            target.log(self.spark).recover()  # what a broken run committed and did not show
        token_prefix = f"{cfg.operation_id}-g{generation}-b"

        feed = self._change_feed(cfg, f"{ck}/changes") if cfg.source_format in TABLE_SOURCES else None
        if feed:
            for change in feed.batches():
                df = cast_all_as_string(change.rows) if cfg.cast_all_as_string else change.rows
                if cfg.explode_key:
                    df = explode_records(df, cfg.explode_key)
                token = f"{token_prefix}{change.number}"
                self._sink(df, cfg, target, token, counters, run_state)
                if change.replaces and cfg.load_type == "append":
                    drop_batches_before(self.spark, target, token, cfg.operation_id)
                commits.step("change written")
                change.done()
            self._finish(cfg, target, (cfg.operation_id, token_prefix[:-2], feed.replaced_at()))
            return
        if cfg.source_format in TABLE_SOURCES:
            # not a landing table of this registry
            stream = stream_table(self.spark, self.source_table_name(cfg.full_path))

            def process(batch: DataFrame, batch_id: int) -> None:
                df = batch
                if cfg.cast_all_as_string:
                    df = cast_all_as_string(df)
                if cfg.explode_key:
                    df = explode_records(df, cfg.explode_key)
                self._sink(df, cfg, target, f"{token_prefix}{batch_id}", counters, run_state)
        elif cfg.source_format == FILE_SOURCE:
            check_format(cfg)
            stream = incremental_files(self.spark, cfg.full_path, cfg.max_files_per_trigger)

            def process(batch: DataFrame, batch_id: int) -> None:
                session = batch.sparkSession
                # Metadata only, bounded by maxFilesPerTrigger.
                # A file whose name reads like a pattern can be listed with the files it matches.
                paths = list(dict.fromkeys(r["path"] for r in batch.select("path").collect()))
                batch_read = read_batch(session, paths, cfg)
                if batch_read is None:
                    return
                raw = batch_read.df
                tracked = cfg.schema or self.registry.tracked_schema(cfg.operation_id, generation)
                keep_array = cfg.cast_all_as_string and cfg.explode_key
                target_schema, rescue = schema_ops.evolve(
                    raw, tracked, cfg.effective_evolution_mode,
                    cast_all=cfg.cast_all_as_string and not keep_array,
                    infer=batch_read.infer)
                df = schema_ops.conform(raw, target_schema, rescue)
                if cfg.explode_key:
                    df = explode_records(df, cfg.explode_key)
                    if cfg.cast_all_as_string:
                        df = cast_all_as_string(df)
                self._sink(df, cfg, target, f"{token_prefix}{batch_id}", counters, run_state)
                if cfg.schema is None and target_schema != tracked:
                    # S13, only after the sink succeeded
                    self.registry.save_tracked_schema(cfg.operation_id, generation, target_schema)
        else:
            raise ValueError(f"Unsupported source_format: '{cfg.source_format}'")

        query = (stream.writeStream.trigger(availableNow=True)
                 .option("checkpointLocation", f"{ck}/stream")
                 .foreachBatch(process).start())
        query.awaitTermination()
        self._finish(cfg, target)

    def _change_feed(self, cfg: IngestConfig, path: str) -> ChangeFeed | None:
        """The changes of a table that operations of this registry write; None for any other table."""
        producers = (self.registry.resolve_operations().where(F.col("fq_table") == cfg.full_path)
                     .select("target_catalog", "target_schema", "target_table", "table_path", "load_type"))
        producer = producers.orderBy(F.col("load_type") == "append").first()
        if producer is None:
            return None
        parts = (producer["target_catalog"], producer["target_schema"], producer["target_table"])
        name, location = self.ws.table(*parts), producer["table_path"] or self.ws.table_location(*parts)
        log = None if producer["load_type"] == "append" else CommitLog(self.spark, name, location)
        return ChangeFeed(self.spark, name, path, log, cfg.load_type == "merge", cfg.max_files_per_trigger)

    def _finish(self, cfg: IngestConfig, target: Target, replaces: tuple | None = None) -> None:
        """What a run does after its last batch."""
        if cfg.load_type == "merge":
            merge_staged(self.spark, target, list(cfg.merge_keys), cfg.merge_schema,
                         replaces if replaces and replaces[2] is not None else None)
        elif cfg.load_type == "overwrite":
            target.log(self.spark).close()

    def _sink(self, df: DataFrame, cfg: IngestConfig, target: Target, token: str,
              counters: dict, run_state: dict) -> None:
        session = df.sparkSession
        if cfg.load_type == "merge":
            # before the audit columns: their constants need not travel through the shuffle
            own = {k.lower() for k in cfg.merge_keys}
            replaced = [c for c in df.columns if c in AUDIT_COLUMNS and c.lower() not in own]  # a source table's
            df = latest_per_key(dealt(df.drop(*replaced)), list(cfg.merge_keys))
        df = add_audit_columns(df, cfg.operation_id,
                               F.col(SRC) if SRC in df.columns else None)
        df = df.drop(*[h for h in HIDDEN if h in df.columns])
        rescued = (F.count_if(F.col(RESCUE_COLUMN).isNotNull()) if RESCUE_COLUMN in df.columns
                   else F.lit(0))
        obs = Observation(f"batch_{token}")
        observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), rescued.alias("rescued"))
        rows = lambda: int(obs.get.get("rows") or 0)
        if cfg.load_type == "merge":
            # Written once, read by the merge at the end of the run (K7: empty batches are not kept).
            stage(session, observed, target, token, lambda: rows() == 0)
        elif cfg.load_type == "overwrite" or not tables.table_exists(session, target.name):
            # K7: an empty batch neither replaces nor creates a table.  One row tells; the batch is not kept for its write.
            if df.isEmpty():
                return
            write_batch(session, observed, cfg.load_type, target, list(cfg.merge_keys), token,
                        cfg.merge_schema, run_state)
        else:
            write_batch(session, observed, cfg.load_type, target, list(cfg.merge_keys), token,
                        cfg.merge_schema, run_state)
            if rows() == 0:  # K7, told by the write itself: nothing is left of an empty batch
                drop_batch(session, target, token)
        metrics = obs.get
        counters["rows"] += int(metrics.get("rows") or 0)
        counters["rescued"] += int(metrics.get("rescued") or 0)

    # -- C8 ----------------------------------------------------------------------------
    def run_all(self, parallelism: int = 1) -> list[RunResult]:
        """Every enabled operation in dependency order; a failure does not stop the rest.

        ``parallelism`` 1 runs one operation at a time, wave by wave and by id within a wave.
        With more, each dependency wave runs on a thread pool: the operations' Spark jobs
        share the cluster, operations that write the same table stay sequential."""
        from feedline.plans.deps import run_waves  # warns of feeds that read each other in a circle
        if parallelism <= 1:
            return [self.run_operation(op, raise_errors=False) for wave in run_waves(self.registry) for op, _ in wave]
        from concurrent.futures import ThreadPoolExecutor
        results: list[RunResult] = []
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            for wave in run_waves(self.registry):
                by_table: dict = {}
                for op, table in wave:
                    by_table.setdefault(table, []).append(op)
                chains = [pool.submit(lambda ops: [self.run_operation(o, raise_errors=False)
                                                   for o in ops], ops)
                          for ops in by_table.values()]
                for chain in chains:
                    results.extend(chain.result())
        return results

    # -- K13 ---------------------------------------------------------------------------
    def reset(self, operation_ids: list[str] | None = None) -> None:
        """Drop the landing tables of the operations and forget their file history
        (a new checkpoint generation); data files are left in place."""
        resolved = self.registry.resolve_operations()
        if operation_ids is not None:
            resolved = resolved.where(F.col("operation_id").isin(*operation_ids))
        rows = resolved.select("operation_id", "target_catalog", "target_schema",
                               "target_table", "table_path", "load_type").collect()
        for r in rows:
            if r["target_table"]:
                name = self.ws.table(r["target_catalog"], r["target_schema"], r["target_table"])
                location = r["table_path"] or self.ws.table_location(
                    r["target_catalog"], r["target_schema"], r["target_table"])
                if r["load_type"] != "append":
                    CommitLog(self.spark, name, location).write("reset")  # the drop is meant: nothing is recovered
                if tables.table_exists(self.spark, name):
                    self.spark.sql(f"DROP TABLE {name}")
        self.registry.bump_generation([r["operation_id"] for r in rows])
