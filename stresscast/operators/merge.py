"""Keyed merge (upsert) of an incoming batch into a stored table.

Semantics of the source's per-document upsert, re-expressed as one join:

* incoming rows with an absent/NULL/empty key field are not merged; they are
  appended as they are (``_action = 'unkeyed'``) so nothing is lost;
* several incoming rows with the same key: the latest by ``order_cols`` wins, so
  the result always has one row per key (order columns given by name are batch
  metadata and not stored; expressions leave the columns as fields). The order is
  required, so that the winner never depends on the order of arrival;
* only fields *present in the batch* are set: a column missing from the
  incoming schema, or not listed in a row's ``fields_col`` array, keeps the
  stored value; a present field that is NULL overwrites with NULL;
* nested documents are merged field by field at any depth: a struct of the batch
  sets its own fields and keeps the stored ones it lacks (``fields_col`` may name single
  fields as ``struct.field``; a struct named itself is present with all its fields). A present
  struct that is NULL as a whole overwrites with NULL;
* ``created_at_utc`` is set on first insert and kept afterwards;
  ``updated_at`` is refreshed for every matched or inserted key;
* ``_action``: insert / update (some value changed) / unchanged / keep
  (stored key not in the batch) / unkeyed.

Merging the same batch twice changes nothing the second time except
``updated_at``. The plan is one full outer join on the keys (a shuffle of
both sides on the key; AQE splits skewed key partitions).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from stresscast.operators.dedupe import keep_last

META = ("created_at_utc", "updated_at")

#: Values of ``_action`` and what their number is called.
ACTIONS = {"insert": "inserted", "update": "modified", "unchanged": "unchanged", "keep": "kept", "unkeyed": "unkeyed"}


def bad_key(keys: Sequence[str], fields_col: str | None = None, columns: Sequence[str] = ()) -> Column:
    """Row predicate: some key field is absent, NULL or empty text."""
    cond = F.lit(False)
    for k in keys:
        if k not in columns:
            return F.lit(True)
        v = F.col(k)
        c = v.isNull() | (v.cast("string") == "")
        if fields_col:
            c = c | ~F.array_contains(F.col(fields_col), k)
        cond = cond | c
    return cond


def _same(old: DataType | None, new: DataType | None) -> bool:
    """Whether merging leaves the stored type as it is, so that old and new value can be compared."""
    if old is None or new is None:
        return True
    if isinstance(old, StructType) and isinstance(new, StructType):
        names = set(old.fieldNames())
        return all(f.name in names and _same(old[f.name].dataType, f.dataType) for f in new)
    return old == new or not isinstance(old, StructType) and not isinstance(new, StructType)


def _names(fields: Column, path: str) -> Column:
    """Whether a row's field list has the field or one inside it."""
    return F.exists(fields, lambda f: (f == path) | f.startswith(path + "."))


def merged_field(path: str, old: Column, old_type: DataType | None, new: Column, new_type: DataType, matched: Column,
                 fields: Column | None) -> Column:
    """The stored value, or the incoming one where the row is matched and names the field; structs field by field."""
    named = matched if fields is None else matched & F.array_contains(fields, path)
    if not (isinstance(new_type, StructType) and (old_type is None or isinstance(old_type, StructType))):
        return F.when(named, new).otherwise(old)
    held = {f.name: f.dataType for f in old_type} if old_type is not None else {}
    sent = {f.name: f.dataType for f in new_type}
    # a struct that is named has all its fields named; otherwise its fields may be
    parts, any_named = [], named
    for name in dict.fromkeys([*held, *sent]):
        before = old[name] if name in held else F.lit(None).cast(sent.get(name))
        if name not in sent:
            parts.append(before.alias(name))
            continue
        single = F.lit(False) if fields is None else matched & _names(fields, f"{path}.{name}")
        inner = None if fields is None else F.when(named, F.array_append(fields, f"{path}.{name}")).otherwise(fields)
        parts.append(merged_field(f"{path}.{name}", before, held.get(name), new[name], sent[name], matched, inner).alias(name))
        any_named = any_named | single
    merged = F.struct(*parts)
    kept = old if set(held) >= set(sent) and old_type is not None else F.when(old.isNotNull(), merged)
    return F.when(named & new.isNull(), F.lit(None)).when(any_named, merged).otherwise(kept)


def flattened(df: DataFrame, separator: str = "_") -> DataFrame:
    """Every field of every struct as a column of its own (``struct_field``); the order of fields is kept."""
    def leaves(column: Column, data_type: DataType, name: str):
        if not isinstance(data_type, StructType):
            return [column.alias(name)]
        return [leaf for f in data_type for leaf in leaves(column[f.name], f.dataType, f"{name}{separator}{f.name}")]
    return df.select(*[leaf for f in df.schema for leaf in leaves(F.col(f"`{f.name}`"), f.dataType, f.name)])


def keyed_merge(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], now,
                order_cols: Sequence, fields_col: str | None = None) -> DataFrame:
    if not order_cols:
        raise ValueError("order_cols must say which of several rows of a key wins")
    keys = list(keys)
    now_c = F.lit(now).cast("timestamp_ntz")
    order_names = {c for c in order_cols if isinstance(c, str)}
    inc_cols = [c for c in incoming.columns if c != fields_col and c not in META and c not in order_names]
    ex_cols = [c for c in existing.columns if c not in META]
    value_cols = [c for c in dict.fromkeys(ex_cols + inc_cols) if c not in keys]
    bad = bad_key(keys, fields_col, incoming.columns)
    unkeyed = incoming.where(bad)
    good = incoming.where(~bad)
    good = keep_last(good, keys, list(order_cols))

    e = existing.select(*keys, *[F.col(c).alias(f"_e_{c}") for c in value_cols if c in ex_cols],
                        *[F.col(m).alias(f"_e_{m}") if m in existing.columns else F.lit(None).cast("timestamp_ntz")
                          .alias(f"_e_{m}") for m in META], F.lit(True).alias("_in_e"))
    i = good.select(*keys, *[F.col(c).alias(f"_i_{c}") for c in value_cols if c in inc_cols],
                    *([F.col(fields_col).alias("_i_fields")] if fields_col else []), F.lit(True).alias("_in_i"))
    j = e.join(i, keys, "full_outer")
    in_e, in_i = F.col("_in_e").isNotNull(), F.col("_in_i").isNotNull()

    out, changed = [], F.lit(False)
    types = {c: (existing.schema[c].dataType if c in ex_cols else None,
                 incoming.schema[c].dataType if c in inc_cols else None) for c in value_cols}
    for c in value_cols:
        old, new = types[c]
        # the incoming type decides between two simple types, as a later write does
        old_col = F.col(f"_e_{c}") if old is not None else F.lit(None).cast(new)
        value = old_col if new is None else merged_field(
            c, old_col, old, F.col(f"_i_{c}"), new, in_i, F.col("_i_fields") if fields_col else None)
        out.append(value.alias(c))
        changed = changed | ~old_col.eqNullSafe(value) if _same(old, new) else changed | (in_i & value.isNotNull())
    created = F.when(in_e, F.col("_e_created_at_utc")).otherwise(now_c)
    created = F.when(in_i, F.coalesce(F.col("_e_created_at_utc"), now_c)).otherwise(created)
    updated = F.when(in_i, now_c).otherwise(F.col("_e_updated_at"))
    action = (F.when(~in_e, "insert").when(~in_i, "keep").when(changed, "update").otherwise("unchanged"))
    merged = j.select(*keys, *out, created.alias("created_at_utc"), updated.alias("updated_at"),
                      action.alias("_action"))
    unk = unkeyed.drop(*([fields_col] if fields_col else []), *order_names)
    unk = unk.select(*[F.col(c) if c in unk.columns else F.lit(None).alias(c) for c in keys + value_cols],
                     now_c.alias("created_at_utc"), now_c.alias("updated_at"), F.lit("unkeyed").alias("_action"))
    return merged.unionByName(unk, allowMissingColumns=True)


def merge_stats(merged: DataFrame) -> DataFrame:
    """Counts per action and the source's 'upserted or modified' number."""
    a = F.col("_action")
    n = lambda *of: F.sum(F.when(a.isin(*of), 1).otherwise(0)).cast("bigint")
    return merged.agg(*[n(action).alias(name) for action, name in ACTIONS.items()],
                      n("insert", "update").alias("upserts_or_updates"))


def stored(merged: DataFrame) -> DataFrame:
    """The table to write back (the action column dropped)."""
    return merged.drop("_action")
