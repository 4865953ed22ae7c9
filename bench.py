"""Benchmark the headline ingestion paths and reports.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints ONE JSON line.  Raw feeds are prepared before timing; each timed
query is one framework run (discovery stream -> read -> rescue projection
-> sink -> audit row) or one report evaluated to the end.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from feedline import suite  # noqa: E402
from feedline.plans import reports, rules  # noqa: E402
from feedline.streaming.runner import Runner  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("feedline-bench")
             .config("spark.sql.shuffle.partitions", str(max(8, cpus * 2)))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    ws, reg = suite._new(spark, "bench")
    raw = f"{ws.root}/raw"
    li = suite._t(spark, sf_dir, "lineitem")
    orders = suite._t(spark, sf_dir, "orders")
    n_li = li.count()
    n_orders = orders.count()
    parts = max(8, cpus * 2)
    li.repartition(parts).write.parquet(f"{raw}/li_parquet")
    li.repartition(parts).write.option("header", "true").csv(f"{raw}/li_csv")
    li.repartition(parts).write.json(f"{raw}/li_jsonl")
    orders.repartition(parts).write.json(f"{raw}/orders")

    objects = [suite._source("src_pq", f"{raw}/li_parquet", "*.parquet", "parquet"),
               suite._source("src_csv", f"{raw}/li_csv", "*.csv", "csv"),
               suite._source("src_jsonl", f"{raw}/li_jsonl", "*.json", "jsonl"),
               suite._source("src_orders", f"{raw}/orders", "*.json", "jsonl"),
               suite._target("tgt_pq", ws, "li_parquet", partition_cols="l_returnflag"),
               suite._target("tgt_csv", ws, "li_csv"),
               suite._target("tgt_jsonl", ws, "li_jsonl"),
               suite._target("tgt_orders", ws, "orders", merge_keys="o_orderkey")]
    operations = [suite._operation("op_pq", "src_pq", "tgt_pq"),
                  suite._operation("op_csv", "src_csv", "tgt_csv"),
                  suite._operation("op_jsonl", "src_jsonl", "tgt_jsonl"),
                  suite._operation("op_orders", "src_orders", "tgt_orders", load_type="merge")]
    suite._register(spark, reg, objects, operations)
    runner = Runner(ws)
    # untimed warm-up: one tiny feed through the whole path (JVM JIT, Python workers)
    wws, wreg = suite._new(spark, "warm")
    wraw = suite._single_feed(spark, wws, wreg, "nation", "csv", "*.csv")
    suite._t(spark, sf_dir, "nation").write.option("header", "true").csv(wraw)
    Runner(wws).run_operation("op_nation")
    timings: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        timings[name] = round(time.time() - t, 3)
        return out

    def run(op):
        res = runner.run_operation(op)
        if res.status != "SUCCESS":
            raise RuntimeError(res.error)
        return res

    rows["append_parquet"] = timed("append_parquet", lambda: run("op_pq")).rows_written
    rows["append_csv"] = timed("append_csv", lambda: run("op_csv")).rows_written
    rows["append_jsonl"] = timed("append_jsonl", lambda: run("op_jsonl")).rows_written
    rows["empty_rerun"] = timed("empty_rerun", lambda: run("op_pq")).rows_written
    run("op_orders")  # seed the merge target (untimed)
    # a 10 % update batch: orders of the first tenth of the key range, price changed
    cut = orders.agg(F.percentile_approx("o_orderkey", 0.1).alias("k")).first()["k"]
    (orders.where(F.col("o_orderkey") <= cut)
     .withColumn("o_totalprice", F.col("o_totalprice") + 1.0)
     .repartition(max(2, parts // 4)).write.mode("append").json(f"{raw}/orders"))
    rows["merge_10pct"] = timed("merge_10pct", lambda: run("op_orders")).rows_written

    events = suite._t(spark, sf_dir, "events")
    audit = suite.audit_from_events(events)
    ops = suite.operations_from_events(spark, sf_dir)

    def rollups():
        n = reports.audit_latest(audit).count()
        n += reports.audit_history(audit, ops, suite.AS_OF, 30).count()
        n += reports.audit_daily(audit, ops, suite.AS_OF, 14).count()
        return n

    rows["audit_rollups"] = timed("audit_rollups", rollups)

    def violations():
        return suite.registry_violations(spark, sf_dir).count()

    rows["registry_rules"] = timed("registry_rules", violations)

    total = round(sum(timings.values()), 3)
    out = {"metric": "total_sec", "value": total, "unit": "sec", "queries": timings,
           "rows": rows, "rows_per_sec": {k: round(rows[k] / timings[k], 1)
                                          for k in ("append_parquet", "append_csv", "append_jsonl")
                                          if timings[k] > 0},
           "input_rows": {"lineitem": n_li, "orders": n_orders},
           "sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": cpus}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
