"""Keyed upsert (MERGE INTO ... UPDATE / INSERT) and SCD type 2, as plans.

Plain Parquet tables have no row-level MERGE, so both operators compute the
*new contents* of the target as a DataFrame; a writer then replaces the
target (or only its touched partitions) with it.

Plan shape of `upsert`:

* rows whose key has a NULL can never match (MERGE's `=`), so they bypass
  the join: NULL-key target rows pass through, NULL-key source rows are
  inserted.  Hash partitioning would otherwise put all of them in one task.
* the remaining rows meet in one full outer join on the keys; target keys
  are unique.
* with `check_duplicates`, the rows of each source key are counted by a window
  over the keys, which the join's partitioning serves as well: the source is
  read and shuffled once.  If several source rows match one target row the
  plan raises (MERGE's rule); several without a match are all inserted, as
  MERGE does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DUPLICATE_ERROR = "upsert: several source rows match one target row for key "


def _any_null(keys: list[str], prefix: str = "") -> Column:
    return reduce(lambda a, b: a | b, [F.col(prefix + k).isNull() for k in keys])


def _align(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source columns in target order and types; missing columns are NULL."""
    types = {f.name: f.dataType for f in target.schema.fields}
    have = set(source.columns)
    return source.select(*[
        (F.col(c).cast(t) if c in have else F.lit(None).cast(t)).alias(c)
        for c, t in types.items()
    ])


def _stand_in(kind: str) -> Column:
    """Any value of a key's type, in place of a NULL that is told apart by a column of its own."""
    return F.lit("1970-01-01" if kind.startswith(("date", "timestamp")) else "0").cast(kind)


def upsert(target: DataFrame, source: DataFrame, keys: list[str],
           update_cols: list[str] | None = None,
           insert_cols: list[str] | None = None,
           update_exprs: dict[str, Column] | None = None,
           insert_exprs: dict[str, Column] | None = None,
           target_filter: Column | None = None,
           null_safe_keys: bool = False,
           check_duplicates: bool = True) -> DataFrame:
    """New target contents after MERGE ON keys (AND target_filter).

    update_cols   columns set from the source on a match (default: all
                  non-key columns present in the source)
    insert_cols   columns taken from the source on insert (default: all
                  present in the source; the rest are NULL)
    update_exprs / insert_exprs
                  column -> expression overriding the value on update /
                  insert (e.g. ``{"updated_at": run_ts}``)
    target_filter target rows failing it never match and pass through
    null_safe_keys
                  NULL keys match each other (idempotent re-runs for
                  NULL-group rows); default is MERGE's `=`.
    """
    cols = target.columns
    src_cols = set(source.columns)
    update_cols = [c for c in (update_cols or [c for c in cols if c in src_cols])
                   if c not in keys]
    insert_cols = insert_cols or [c for c in cols if c in src_cols]
    update_exprs = update_exprs or {}
    insert_exprs = insert_exprs or {}
    src = _align(source, target)

    passthrough = []
    if target_filter is not None:
        passthrough.append(target.where(~F.coalesce(target_filter, F.lit(False))))
        target = target.where(F.coalesce(target_filter, F.lit(False)))

    inserts = []

    def as_insert(rows: DataFrame) -> DataFrame:
        return rows.select(*[
            (insert_exprs[c] if c in insert_exprs
             else F.col(c) if c in insert_cols else F.lit(None))
            .cast(dict(target.dtypes)[c]).alias(c)
            for c in cols
        ])

    if not null_safe_keys:
        passthrough.append(target.where(_any_null(keys)))
        target = target.where(~_any_null(keys))
        inserts.append(as_insert(src.where(_any_null(keys))))
        src = src.where(~_any_null(keys))

    # NULL keys that match each other: a stand-in and a flag take the key's place until the rows
    # have met.  The count and the join go by the same columns, so one shuffle serves both.
    types = dict(target.dtypes)
    by = list(keys)
    if null_safe_keys:
        by += [f"_null_{k}" for k in keys]
        target, src = [df.withColumns({f"_null_{k}": F.col(k).isNull() for k in keys}).withColumns(
            {k: F.coalesce(F.col(k), _stand_in(types[k])) for k in keys}) for df in (target, src)]
    rows = (F.count(F.lit(1)).over(Window.partitionBy(*by)) if check_duplicates else F.lit(1))
    src = src.withColumn("_rows", rows)

    held = [*cols, *by[len(keys):]]
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in held]).withColumn("_t", F.lit(True))
    s = src.select(*[F.col(c).alias(f"s__{c}") for c in held], F.col("_rows").alias("_s"))
    on = [F.col(f"t__{k}") == F.col(f"s__{k}") for k in by]
    joined = t.join(s, reduce(lambda a, b: a & b, on), "full_outer")
    if null_safe_keys:
        joined = joined.withColumns({f"{side}__{k}": F.when(~F.col(f"{side}___null_{k}"), F.col(f"{side}__{k}"))
                                     for side in "ts" for k in keys})
    in_t, in_s = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    if check_duplicates:
        # A filter, not a column: a column nobody reads would be pruned away.
        key_text = F.concat_ws(",", *[F.coalesce(F.col(f"s__{k}").cast("string"), F.lit("NULL"))
                                      for k in keys])
        joined = joined.where(F.when(in_t & (F.col("_s") > 1), F.raise_error(
            F.concat(F.lit(DUPLICATE_ERROR), key_text)).cast("boolean")).otherwise(F.lit(True)))
    out = []
    for c in cols:
        tc, sc = F.col(f"t__{c}"), F.col(f"s__{c}")
        if c in keys:
            value = F.when(in_t, tc).otherwise(sc)
        else:
            on_update = update_exprs.get(c, sc if c in update_cols else tc)
            on_insert = insert_exprs.get(c, sc if c in insert_cols else F.lit(None))
            value = F.when(in_t & in_s, on_update).when(in_t, tc).otherwise(on_insert)
        out.append(value.cast(types[c]).alias(c))
    merged = joined.select(*out)
    return reduce(DataFrame.unionByName, [merged, *[p.select(*cols) for p in passthrough], *inserts])


def changed(compare: list[str], null_safe: bool = False, t: str = "t__", s: str = "s__") -> Column:
    """OR over `compare` of "target differs from source".

    Default is SQL `<>`: a NULL on either side is not a change.  With
    null_safe, NULL -> value and value -> NULL count as changes.
    """
    parts = [(~F.col(t + c).eqNullSafe(F.col(s + c))) if null_safe
             else (F.col(t + c) != F.col(s + c)) for c in compare]
    return F.coalesce(reduce(lambda a, b: a | b, parts), F.lit(False))


def scd2(target: DataFrame, source: DataFrame, key: str | list[str], compare: list[str],
         run_ts, null_safe: bool = False,
         stamp_new: tuple[str, ...] = ("start_date", "created_at", "updated_at"),
         check_duplicates: bool = True) -> DataFrame:
    """New contents of a type-2 dimension after one load, in one pass.

    Closed versions (is_current false) pass through.  Current versions meet
    the source (one row per key) in a full outer join:

    * key only in the target, or unchanged: the current row stays;
    * changed in any `compare` column: the current row is closed
      (is_current false, end_date and updated_at = run_ts) and a new current
      version is added;
    * key only in the source (also a key whose versions are all closed): a
      new current version.

    New versions take their attributes from the source, `stamp_new` columns
    = run_ts, end_date NULL, is_current true.  With `check_duplicates` the
    plan raises if a key occurs more than once in the source (it would open
    two current versions); the per-key count shares the source's shuffle with
    the main join.  A NULL key matches nothing, as in MERGE: every such source
    row is a new version.
    """
    keys = [key] if isinstance(key, str) else list(key)
    now = F.lit(str(run_ts)).cast("timestamp")
    cols = target.columns
    types = dict(target.dtypes)
    src = _align(source, target)
    # NULL keys match nothing: such source rows become new versions, such target rows stay.
    # They go around the join, where they would all meet in one task.
    unmatched = src.where(_any_null(keys))
    src = src.where(~_any_null(keys))
    if check_duplicates:
        key_text = F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
        # A filter, not a column: a column nobody reads would be pruned away.
        src = src.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(*keys))).where(
            F.when(F.col("_rows") > 1, F.raise_error(F.concat(
                F.lit("scd2: several source rows for key "), key_text)).cast("boolean"))
            .otherwise(F.lit(True))).select(*cols)
    history = target.where(~F.coalesce(F.col("is_current"), F.lit(False)))
    current = target.where(F.coalesce(F.col("is_current"), F.lit(False)))
    history = history.unionByName(current.where(_any_null(keys)))
    current = current.where(~_any_null(keys))

    t = current.select(*[F.col(c).alias(f"t__{c}") for c in cols]).withColumn("_t", F.lit(True))
    s = src.select(*[F.col(c).alias(f"s__{c}") for c in cols]).withColumn("_s", F.lit(True))
    on = reduce(lambda a, b: a & b, [F.col(f"t__{k}") == F.col(f"s__{k}") for k in keys])
    joined = t.join(s, on, "full_outer")
    in_t, in_s = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    diff = in_t & in_s & changed(compare, null_safe)

    def version(prefix: str, closing: bool) -> Column:
        fields = []
        for c in cols:
            v = F.col(prefix + c)
            if closing:
                if c == "is_current":
                    v = F.when(diff, F.lit(False)).otherwise(v)
                elif c in ("end_date", "updated_at"):
                    v = F.when(diff, now).otherwise(v)
            else:
                if c == "is_current":
                    v = F.lit(True)
                elif c == "end_date":
                    v = F.lit(None)
                elif c in stamp_new:
                    v = now
            fields.append(v.cast(types[c]).alias(c))
        return F.struct(*fields)

    old = F.when(in_t, version("t__", closing=True))
    new = F.when(in_s & (~in_t | diff), version("s__", closing=False))
    versions = joined.select(
        F.explode(F.filter(F.array(old, new), lambda v: v.isNotNull())).alias("v")
    ).select("v.*")
    added = unmatched.select(version("", closing=False).alias("v")).select("v.*")
    return history.select(*cols).unionByName(versions).unionByName(added)
