"""Small feeds with the shapes and counts of FIXTURES.md; the rows are our own.

Files are tiny and written directly; the registry mirrors the ten seeded
operations (nine enabled), pointing at these folders.
"""

from __future__ import annotations

import json
import os

# Rows of our own, with the columns and counts of FIXTURES.md.
POS_ROWS = 20
ACME_LINES = [f"NORD|art-{n}|{'bolt nut washer hinge'.split()[n]} M{4 + 2 * n}|{'NULL' if n == 1 else 36 * (n + 1)}|{0.25 + n}|2031-11-0{n + 1}" for n in range(4)]
PEOPLE = ["Ines", "Tomasz", "Tomasz (moved)", "Yuki"]
CRM_1 = [{"customer_id": f"k{n}", "name": PEOPLE[n], "email": f"k{n}@mail.invalid", "segment": "trial"} for n in (0, 1)]
CRM_2 = [{"customer_id": f"k{n - 1}", "name": PEOPLE[n], "email": f"new{n}@mail.invalid", "segment": "paying"} for n in (2, 3)]
EDI_XML = "<?xml version='1.0' encoding='UTF-8'?>\n<Orders>" + "".join(
    f"<Order id='{oid}'><supplier>Kontor {n}</supplier><sku>art-{n}</sku><quantity>{75 * n}</quantity>"
    f"<delivery_date>2031-12-{n:02d}</delivery_date></Order>" for n, oid in ((4, "B-17"), (9, "B-18"))) + "</Orders>\n"
CLICKS = [{"export_id": f"batch{k}", "events": [
    {"event_id": f"ev-{n}", "user": f"k{k}", "type": "open" if n % 2 else "close", "ts": f"2031-11-02T08:0{n}:30Z"} for n in some]}
    for k, some in ((0, (1, 2)), (1, (3,)))]
_LOYALTY = "customer_id,customer_tier,points,updated_at"
LOYALTY_2018 = f"{_LOYALTY}\nk0,1,10,2027-02-03\nk1,4,20,2027-02-04\n"
LOYALTY_2024 = f"{_LOYALTY}\nk0,tin,30,2030-02-03\nk3,zinc,40,2030-02-04\n"
LOYALTY_2025 = f"{_LOYALTY},region\n" + "".join(f"k{n},lead,{n * 11},2031-0{n}-20,zone{n}\n" for n in (5, 6, 7))
PRODUCTS = [(f"art-{n}", f"article number {n}", "tools" if n % 3 else "paint", f"{n}.{n:02d}", str(n % 4 > 0).lower()) for n in range(1, 13)]
STORES = [(f"shop{n}", f"Shop on street {n}", f"Town {n % 4}", f"District {n % 3}", "Nowhere", f"20{n + 10}-01-0{n % 9 + 1}") for n in range(10)]

ACME_SCHEMA = json.dumps({"type": "struct", "fields": [
    {"name": n, "type": t, "nullable": True, "metadata": {}} for n, t in [
        ("supplier_id", "string"), ("sku", "string"), ("product_name", "string"),
        ("qty_on_hand", "integer"), ("unit_cost", "double"), ("last_updated", "string")]]})


def _write(path: str, content: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(content)


def write_feeds(spark, raw: str, loyalty_2025: bool = True) -> None:
    """Write every demo feed under ``raw`` (loyalty 2025 optional: a later wave)."""
    rows = [(f"till-{i}", f"shop{i % 7}", f"art-{i % 12}", 20 - i, i * i / 8, "2031-11-05") for i in range(POS_ROWS)]
    (spark.createDataFrame(rows, "transaction_id string, store_id string, sku string, qty bigint, "
                                 "amount double, load_date string")
     .coalesce(1).write.mode("overwrite").parquet(f"{raw}/pos/transactions"))
    _write(f"{raw}/suppliers/acme/acme_inventory_20260601.csv", "\n".join(ACME_LINES) + "\n")
    _write(f"{raw}/crm/customers/customers_001.json", json.dumps(CRM_1, indent=2))
    _write(f"{raw}/crm/customers/customers_002.json", json.dumps(CRM_2, indent=2))
    _write(f"{raw}/suppliers/edi/edi_orders_20260601.xml", EDI_XML)
    _write(f"{raw}/clickstream/events/clickstream_20260601.jsonl",
           "\n".join(json.dumps(c) for c in CLICKS) + "\n")
    _write(f"{raw}/crm/loyalty_history/loyalty_2018.csv", LOYALTY_2018)
    _write(f"{raw}/crm/loyalty_history/loyalty_2024.csv", LOYALTY_2024)
    if loyalty_2025:
        _write(f"{raw}/crm/loyalty_history/loyalty_2025.csv", LOYALTY_2025)
    _write(f"{raw}/product_catalog/product_catalog_20260601.csv",
           "product_id,product_name,category,unit_price,in_stock,updated_date\n"
           + "".join(",".join(p) + ",2026-06-01\n" for p in PRODUCTS))
    _write(f"{raw}/store_locations/store_locations_20260601.csv",
           "store_id,store_name,city,region,country,opened_date\n"
           + "".join(",".join(s) + "\n" for s in STORES))


def registry_rows(ws, raw: str):
    cat = ws.catalog

    def src(oid, path, glob, fmt, **kw):
        return {"object_id": oid, "object_type": "source", "source_format": "cloudFiles",
                "file_path": f"{raw}/{path}/", "wildcard_pattern": glob, "file_format": fmt, **kw}

    def tgt(oid, table, **kw):
        return {"object_id": oid, "object_type": "target", "target_catalog": cat,
                "target_schema": "bronze", "target_table": table, **kw}

    objects = [
        src("src_pos_transactions", "pos/transactions", "*.parquet", "parquet"),
        src("src_supplier_acme", "suppliers/acme", "*.csv", "csv", object_schema=ACME_SCHEMA,
            delimiter="|", encoding="UTF-8", null_value="NULL"),
        src("src_crm_customers", "crm/customers", "*.json", "json"),
        src("src_supplier_edi", "suppliers/edi", "*.xml", "xml", row_tag="Order"),
        src("src_clickstream", "clickstream/events", "*.jsonl", "jsonl"),
        src("src_loyalty_history", "crm/loyalty_history", "*.csv", "csv", delimiter=",",
            encoding="UTF-8", null_value=""),
        src("src_product_catalog", "product_catalog", "*.csv", "csv", delimiter=",",
            encoding="UTF-8", null_value=""),
        src("src_store_locations", "store_locations", "*.csv", "csv", delimiter=",",
            encoding="UTF-8", null_value=""),
        {"object_id": "src_pos_bronze_stream", "object_type": "source", "source_format": "delta",
         "file_path": f"{cat}.bronze.pos_transactions"},
        {"object_id": "src_abfss_template", "object_type": "source", "source_format": "cloudFiles",
         "storage_account": "examplestorageacct", "container": "raw", "file_path": "/vendor/orders/",
         "wildcard_pattern": "year=*/month=*/*.parquet", "file_format": "parquet"},
        tgt("tgt_pos_transactions", "pos_transactions", partition_cols="load_date"),
        tgt("tgt_supplier_acme", "supplier_acme_inventory"),
        tgt("tgt_crm_customers", "crm_customers", merge_keys="customer_id"),
        tgt("tgt_supplier_edi", "supplier_edi_orders"),
        tgt("tgt_clickstream", "clickstream_events"),
        tgt("tgt_loyalty_history", "loyalty_history"),
        tgt("tgt_product_catalog", "product_catalog"),
        tgt("tgt_store_locations", "store_locations"),
        tgt("tgt_pos_stream_replica", "pos_transactions_stream_replica"),
        tgt("tgt_abfss_template", "abfss_vendor_orders"),
    ]

    def op(oid, s, t, load="append", mode="addNewColumns", cast=False, multiline=False,
           mft=1000, explode=None, enabled=True):
        return {"operation_id": oid, "enabled": enabled, "source_object_id": s,
                "target_object_id": t, "load_type": load, "merge_schema": True,
                "schema_evolution_mode": mode, "cast_all_as_string": cast, "multiline": multiline,
                "case_sensitive": False, "max_files_per_trigger": mft, "explode_key": explode}

    operations = [
        op("op_pos_transactions", "src_pos_transactions", "tgt_pos_transactions"),
        op("op_supplier_acme", "src_supplier_acme", "tgt_supplier_acme", mode="none"),
        op("op_crm_customers", "src_crm_customers", "tgt_crm_customers", load="merge", multiline=True),
        op("op_supplier_edi", "src_supplier_edi", "tgt_supplier_edi"),
        op("op_clickstream", "src_clickstream", "tgt_clickstream", explode="events"),
        op("op_loyalty_history", "src_loyalty_history", "tgt_loyalty_history", mode="rescue",
           cast=True),
        op("op_product_catalog", "src_product_catalog", "tgt_product_catalog", load="overwrite"),
        op("op_store_locations", "src_store_locations", "tgt_store_locations", cast=True),
        op("op_pos_bronze_stream", "src_pos_bronze_stream", "tgt_pos_stream_replica", mode="none",
           mft=None),
        op("op_abfss_template", "src_abfss_template", "tgt_abfss_template", enabled=False),
    ]
    return objects, operations


def register(spark, ws, raw: str):
    from feedline.plans.registry import OBJECT_SCHEMA, OPERATION_SCHEMA, Registry, _nullable

    objects, operations = registry_rows(ws, raw)
    objs = spark.createDataFrame([tuple(o.get(f) for f in OBJECT_SCHEMA.fieldNames()) for o in objects],
                                 _nullable(OBJECT_SCHEMA))
    ops = spark.createDataFrame([tuple(o.get(f) for f in OPERATION_SCHEMA.fieldNames())
                                 for o in operations], _nullable(OPERATION_SCHEMA))
    return Registry(ws).publish(objs, ops)
