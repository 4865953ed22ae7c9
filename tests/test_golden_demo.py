"""The reference demo end to end: ten seeded operations, golden row counts, restart."""

import json

from demo_feeds import LOYALTY_2025, _write, register, write_feeds
from feedline.plans import reports
from feedline.plans.registry import Registry
from feedline.streaming.runner import Runner


def _count(spark, ws, table):
    return spark.table(ws.table(ws.catalog, "bronze", table)).count()


def test_demo_registry_end_to_end(spark, ws, tmp_path):
    raw = str(tmp_path / "raw")
    write_feeds(spark, raw, loyalty_2025=False)
    assert register(spark, ws, raw) == {"object": 20, "operation": 10}
    runner = Runner(ws)
    results = runner.run_all()
    status = {r.operation_id: r.status for r in results}
    assert "op_abfss_template" not in status  # disabled
    assert all(s == "SUCCESS" for s in status.values()), [r.error for r in results if r.error]
    # producer before its table-sourced consumer
    order = [r.operation_id for r in results]
    assert order.index("op_pos_transactions") < order.index("op_pos_bronze_stream")

    expected = {"pos_transactions": 20, "supplier_acme_inventory": 4, "crm_customers": 3,
                "supplier_edi_orders": 2, "clickstream_events": 3, "loyalty_history": 4,
                "product_catalog": 12, "store_locations": 10,
                "pos_transactions_stream_replica": 20}
    assert {t: _count(spark, ws, t) for t in expected} == expected
    written = {r.operation_id: r.rows_written for r in results}
    assert written["op_clickstream"] == 3  # exact rows written, not records read (D6)
    assert written["op_pos_bronze_stream"] == 20

    # a later loyalty wave with an extra column: schema frozen, region rescued (D3)
    _write(f"{raw}/crm/loyalty_history/loyalty_2025.csv", LOYALTY_2025)
    second = {r.operation_id: r for r in runner.run_all()}
    assert second["op_loyalty_history"].rows_written == 3
    assert second["op_loyalty_history"].rescued_rows == 3
    assert all(r.rows_written == 0 for k, r in second.items() if k != "op_loyalty_history")
    loyalty = spark.table(ws.table(ws.catalog, "bronze", "loyalty_history"))
    assert loyalty.count() == 7
    assert "region" not in loyalty.columns
    rescued = {r["customer_id"]: json.loads(r["_rescued_data"])
               for r in loyalty.where("_rescued_data IS NOT NULL").collect()}
    assert rescued == {f"k{n}": {"region": f"zone{n}"} for n in (5, 6, 7)}
    assert dict(loyalty.dtypes)["points"] == "string"

    # third run, nothing new: counts stable
    third = runner.run_all()
    assert all(r.rows_written == 0 for r in third)
    assert _count(spark, ws, "loyalty_history") == 7
    assert _count(spark, ws, "crm_customers") == 3

    audit = Registry(ws).audit_log()
    assert audit.count() == 27
    latest = {r["operation_id"]: r for r in reports.audit_latest(audit).collect()}
    assert set(latest) == set(status)


def test_demo_values(spark, ws, tmp_path):
    raw = str(tmp_path / "raw")
    write_feeds(spark, raw)
    register(spark, ws, raw)
    Runner(ws).run_all()
    t = lambda name: spark.table(ws.table(ws.catalog, "bronze", name))

    acme = {r["sku"]: r for r in t("supplier_acme_inventory").collect()}
    assert acme["art-1"]["qty_on_hand"] is None and acme["art-1"]["_rescued_data"] is None
    assert acme["art-2"]["qty_on_hand"] == 108 and acme["art-2"]["unit_cost"] == 2.25
    assert dict(t("supplier_acme_inventory").dtypes)["qty_on_hand"] == "int"

    crm = {r["customer_id"]: r for r in t("crm_customers").collect()}
    assert crm["k1"]["name"] == "Tomasz (moved)"  # the later file wins (W2, D1)

    edi = t("supplier_edi_orders")
    assert sorted(r["_id"] for r in edi.collect()) == ["B-17", "B-18"]
    assert dict(edi.dtypes)["quantity"] == "bigint"

    clicks = t("clickstream_events")
    assert sorted(r["event_id"] for r in clicks.collect()) == ["ev-1", "ev-2", "ev-3"]
    assert {"event_id", "user", "type", "ts", "_rescued_data", "_source_file",
            "_ingested_at", "_operation_id"} <= set(clicks.columns)
    assert "export_id" not in clicks.columns

    products = dict(t("product_catalog").dtypes)
    assert products["unit_price"] == "double" and products["in_stock"] == "boolean"
    assert products["updated_date"] == "date"

    stores = t("store_locations")
    assert all(d == "string" for c, d in stores.dtypes if not c.startswith("_"))
    # all three loyalty files in one batch: the inferred schema includes region
    assert t("loyalty_history").count() == 7

    src = t("pos_transactions").select("_source_file", "_operation_id").distinct().collect()
    assert len(src) == 1 and src[0]["_source_file"].endswith(".parquet")
    assert src[0]["_operation_id"] == "op_pos_transactions"
