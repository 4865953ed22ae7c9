"""Column expressions shared by the registry, the rules and the reports.

All of them are built-in Catalyst expressions: they run inside whole-stage
codegen on the executors, never as Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed names that must match the reference's landing tables.
RESCUE_COLUMN = "_rescued_data"
AUDIT_COLUMNS = ("_source_file", "_ingested_at", "_operation_id")
# Ours: the micro-batch a row was landed by (idempotent re-delivery, T7).
BATCH_COLUMN = "_batch_id"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """Trim; an empty string becomes NULL."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def split_list(c) -> Column:
    """P10: 'a, b,,c' -> ['a', 'b', 'c'] (trimmed, empties dropped, NULL -> [])."""
    parts = F.transform(F.split(F.coalesce(_c(c), F.lit("")), ","), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != F.lit(""))


def qualified_name(catalog, schema, table) -> Column:
    """Catalog.schema.table."""
    return F.concat_ws(".", _c(catalog), _c(schema), _c(table))


def resolve_path(storage_account, container, file_path, wildcard_pattern) -> Column:
    """Abfss URI when a storage account is set, else the path verbatim; glob appended."""
    glob = F.coalesce(blank_to_null(wildcard_pattern), F.lit(""))
    account = blank_to_null(storage_account)
    remote = F.concat(F.lit("abfss://"), F.coalesce(_c(container), F.lit("")), F.lit("@"),
                      account, F.lit(".dfs.core.windows.net"),
                      F.coalesce(_c(file_path), F.lit("")), glob)
    local = F.concat(F.coalesce(_c(file_path), F.lit("")), glob)
    return F.when(account.isNotNull(), remote).otherwise(local)


def is_audit_column(name, exact: bool = True) -> Column:
    """Is a column one the framework adds?  ``exact`` matches the framework's own
    names (XML attributes such as ``_id`` also start with '_', D17); ``exact=False`` is
    the plain prefix rule."""
    name = _c(name)
    if exact:
        return name.isin(*AUDIT_COLUMNS, RESCUE_COLUMN, BATCH_COLUMN)
    return name.startswith("_")
