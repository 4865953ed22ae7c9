from feedline.functions.columns import (
    blank_to_null, split_list, qualified_name, resolve_path, is_audit_column,
    AUDIT_COLUMNS, RESCUE_COLUMN, BATCH_COLUMN,
)

__all__ = ["blank_to_null", "split_list", "qualified_name", "resolve_path",
           "is_audit_column", "AUDIT_COLUMNS", "RESCUE_COLUMN", "BATCH_COLUMN"]
