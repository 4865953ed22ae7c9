"""Schema tracking, evolution and rescue.

Decided on schemas only (no data pass) except when columns *enter* the
tracked schema from a format read as strings: then Spark's own
inference types them in one distributed pass.

Contract
--------
* tracked schema = explicit schema, else the schema saved by the last
  successful batch of this operation (the ``schema_history`` control table),
  else inferred from this batch.
* new columns: ``addNewColumns`` adds them; ``rescue`` / ``none`` keep their
  values in ``_rescued_data``; ``failOnNewColumns`` raises (the batch is not
  committed, so the next run sees the same files again).
* a value that does not fit its tracked type becomes NULL in its column and
  is kept, as written, in ``_rescued_data``.
* a record that the reader could not place whole (malformed JSON or XML, surplus CSV tokens) is kept, as
  written, in ``_rescued_data`` under ``_corrupt_record``, beside what could be read of it.
* ``cast_all_as_string``: every landed column is a string.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedline.functions.columns import RESCUE_COLUMN
from feedline.sources.readers import CORRUPT, HIDDEN

# The name in ``_rescued_data`` of a whole record.
CORRUPT_KEY = "_corrupt_record"


class SchemaDriftError(RuntimeError):
    """failOnNewColumns met a column that is not in the tracked schema."""


# -- P6: evolution -----------------------------------------------------------------------

def data_fields(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema.fields if f.name not in HIDDEN and f.name != RESCUE_COLUMN]


def evolve(raw: DataFrame, tracked: T.StructType | None, mode: str, cast_all: bool,
           infer=None) -> tuple[T.StructType, list[str]]:
    """(target schema, names of raw columns to rescue).

    ``infer``: for formats read as strings (CSV), types the columns entering the
    schema from the data; other formats carry their own types."""
    raw_fields = data_fields(raw)
    if tracked is None:
        entering = raw_fields
        base: list[T.StructField] = []
        rescue_names: list[str] = []
    else:
        known = {f.name.lower() for f in tracked.fields}
        new = [f for f in raw_fields if f.name.lower() not in known]
        base = list(tracked.fields)
        if new and mode == "failOnNewColumns":
            raise SchemaDriftError(
                "New columns not in the tracked schema: " + ", ".join(f.name for f in new))
        if mode == "addNewColumns":
            entering, rescue_names = new, []
            raw_types = {f.name.lower(): f.dataType for f in raw_fields}
            base = [T.StructField(f.name, merge_nested(f.dataType, raw_types[f.name.lower()]), True)
                    if f.name.lower() in raw_types else f for f in base]
        else:
            entering, rescue_names = [], [f.name for f in new]
    if cast_all:
        added = [T.StructField(f.name, T.StringType(), True) for f in entering]
    else:
        types = infer([f.name for f in entering]) if (infer and entering) else {}
        added = [T.StructField(f.name, types.get(f.name, f.dataType), True) for f in entering]
    target = T.StructType(base + added)
    if cast_all:
        target = T.StructType([T.StructField(f.name, T.StringType(), True) for f in target.fields])
    return target, rescue_names


# -- P4 / P5 / P1: projection onto the target schema --------------------------------------

def _as_text(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


_NESTED = (T.StructType, T.ArrayType, T.MapType)


def merge_nested(tracked: T.DataType, incoming: T.DataType) -> T.DataType:
    """Additive evolution inside nested types: struct fields the tracked type lacks are
    appended (recursively through arrays and map values); leaf types stay tracked."""
    if isinstance(tracked, T.StructType) and isinstance(incoming, T.StructType):
        inc = {f.name.lower(): f for f in incoming.fields}
        known = {f.name.lower() for f in tracked.fields}
        fields = [T.StructField(f.name, merge_nested(f.dataType, inc[f.name.lower()].dataType), True)
                  if f.name.lower() in inc else f for f in tracked.fields]
        fields += [T.StructField(f.name, f.dataType, True) for f in incoming.fields
                   if f.name.lower() not in known]
        return T.StructType(fields)
    if isinstance(tracked, T.ArrayType) and isinstance(incoming, T.ArrayType):
        return T.ArrayType(merge_nested(tracked.elementType, incoming.elementType), True)
    if isinstance(tracked, T.MapType) and isinstance(incoming, T.MapType) \
            and tracked.keyType == incoming.keyType:
        return T.MapType(tracked.keyType, merge_nested(tracked.valueType, incoming.valueType), True)
    return tracked


def convert(c: Column, src: T.DataType, dst: T.DataType) -> Column:
    """Value of type ``src`` as type ``dst``: struct fields by name (missing -> NULL,
    unknown dropped), arrays and map values element-wise, leaves by ``try_cast`` of
    their text; shapes that cannot convert give NULL."""
    if src == dst:
        return c
    if isinstance(dst, T.StringType):
        return _as_text(c, src)
    if isinstance(src, T.StructType) and isinstance(dst, T.StructType):
        by_lower = {f.name.lower(): f for f in src.fields}
        parts = []
        for f in dst.fields:
            sf = by_lower.get(f.name.lower())
            parts.append((convert(c.getField(sf.name), sf.dataType, f.dataType) if sf
                          else F.lit(None).cast(f.dataType)).alias(f.name))
        return F.when(c.isNull(), F.lit(None).cast(dst)).otherwise(F.struct(*parts))
    if isinstance(src, T.ArrayType) and isinstance(dst, T.ArrayType):
        return F.transform(c, lambda x: convert(x, src.elementType, dst.elementType))
    if isinstance(src, T.MapType) and isinstance(dst, T.MapType) and src.keyType == dst.keyType:
        return F.transform_values(c, lambda k, v: convert(v, src.valueType, dst.valueType))
    if not isinstance(src, _NESTED) and not isinstance(dst, _NESTED):
        return c.cast("string").try_cast(dst)
    return F.lit(None).cast(dst)


def lossy(src: T.DataType, dst: T.DataType) -> bool:
    """Can converting a nested value from ``src`` to ``dst`` lose anything?"""
    if src == dst or isinstance(dst, T.StringType):
        return False
    if isinstance(src, T.StructType) and isinstance(dst, T.StructType):
        by_lower = {f.name.lower(): f for f in dst.fields}
        return any(f.name.lower() not in by_lower
                   or lossy(f.dataType, by_lower[f.name.lower()].dataType) for f in src.fields)
    if isinstance(src, T.ArrayType) and isinstance(dst, T.ArrayType):
        return lossy(src.elementType, dst.elementType)
    if isinstance(src, T.MapType) and isinstance(dst, T.MapType) and src.keyType == dst.keyType:
        return lossy(src.valueType, dst.valueType)
    return True


def conform(raw: DataFrame, target: T.StructType, rescue_names: list[str]) -> DataFrame:
    """Target columns in order, ``_rescued_data`` (JSON object or NULL), hidden columns."""
    by_lower = {f.name.lower(): f for f in data_fields(raw)}
    cols, entries, conds = [], [], []
    for f in target.fields:
        src = by_lower.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(src.name)
        if src.dataType == f.dataType:
            cols.append(c.alias(f.name))
            continue
        if isinstance(f.dataType, T.StringType):
            cols.append(_as_text(c, src.dataType).alias(f.name))
            continue
        converted = convert(c, src.dataType, f.dataType)
        cols.append(converted.alias(f.name))
        if isinstance(src.dataType, _NESTED) or isinstance(f.dataType, _NESTED):
            if not lossy(src.dataType, f.dataType):
                continue
            lost = c.isNotNull()  # keep the whole nested value as written
        else:
            lost = c.isNotNull() & converted.isNull()
        conds.append(lost)
        entries += [F.lit(src.name), F.when(lost, _as_text(c, src.dataType))]
    for name in rescue_names:
        src = by_lower[name.lower()]
        conds.append(F.col(src.name).isNotNull())
        entries += [F.lit(src.name), _as_text(F.col(src.name), src.dataType)]
    if CORRUPT in raw.columns:
        # What the reader could not place, as written.
        conds.append(F.col(CORRUPT).isNotNull())
        entries += [F.lit(CORRUPT_KEY), F.col(CORRUPT)]
    if entries:
        # The map (a higher-order function, evaluated without codegen) is only built
        # for rows that have something to rescue; the test before it is plain codegen.
        m = F.map_filter(F.create_map(*entries), lambda k, v: v.isNotNull())
        anything = conds[0]
        for cond in conds[1:]:
            anything = anything | cond
        rescued = F.when(anything, F.to_json(m))
    else:
        rescued = F.lit(None).cast("string")
    hidden = [F.col(h) for h in HIDDEN if h in raw.columns and h != CORRUPT]
    return raw.select(*cols, rescued.alias(RESCUE_COLUMN), *hidden)
