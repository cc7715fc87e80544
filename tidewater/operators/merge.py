"""Applying changes to tables: merges, upserts, snapshots and slowly changing dimensions.

Tables are plain Parquet, so a merge is a function from old rows and changes to
new rows; `sources.sinks` writes the result next to the old version.  Every
operator reduces the changes to one row per key before the single full join,
so a key with many changes never makes a large join group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.ordered import HOT_ROWS, ordered, running, shift
from tidewater.operators.quality import row_hash
from tidewater.operators.ranking import latest


def _row(names: Sequence[str]) -> Column:
    return F.struct(*[F.col(n) for n in names])


def _paired(target: DataFrame, source: DataFrame, key: str, cols: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    t = target.select(F.col(key), _row(cols).alias("t"))
    s = source.select(F.col(key), F.struct(*[F.col(c) for c in [*cols, *extra]]).alias("s"))
    return t.join(s, key, "full")


def cdc_merge(target: DataFrame, changes: DataFrame, key: str, op: str, order: Sequence[str]) -> DataFrame:
    """Latest change per key: DELETE removes the row, anything else (null too) inserts or replaces it."""
    cols = [c for c in target.columns if c != key]
    last = latest(changes.select(key, *cols, op, *order), [key], order)
    both = _paired(target, last, key, cols, [op])
    kept = both.where(F.col("s").isNull() | ~F.col(f"s.{op}").eqNullSafe("DELETE"))
    return kept.select(key, *[F.when(F.col("s").isNull(), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in cols])


def merge_upsert(target: DataFrame, changes: DataFrame, key: str, op: str, order: Sequence[str]) -> DataFrame:
    """MERGE rules: matched DELETE deletes, matched UPDATE sets, unmatched INSERT inserts, the rest does nothing."""
    cols = [c for c in target.columns if c != key]
    last = latest(changes.select(key, *cols, op, *order), [key], order)
    both = _paired(target, last, key, cols, [op])
    matched, does = F.col("t").isNotNull() & F.col("s").isNotNull(), F.coalesce(F.col(f"s.{op}"), F.lit(""))
    gone = matched & (does == "DELETE")
    absent = F.col("t").isNull() & (does != "INSERT")
    use_s = (matched & (does == "UPDATE")) | F.col("t").isNull()
    kept = both.where(F.col("s").isNull() | ~(gone | absent))
    pick = F.col("s").isNotNull() & use_s
    return kept.select(key, *[F.when(pick, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in cols])


def insert_on_conflict(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Upsert that reports what it did: inserted, updated (only when something differs) or unchanged."""
    cols = [c for c in target.columns if c != key]
    both = _paired(target, source, key, cols)
    action = (
        F.when(F.col("t").isNull(), "inserted")
        .when(F.col("s").isNull() | F.col("t").eqNullSafe(F.col("s")), "unchanged")
        .otherwise("updated")
    )
    take = [F.when(F.col("s").isNull(), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in cols]
    return both.select(key, *take, action.alias("action"))


def latest_state(changes: DataFrame, key: str, op: str, order: Sequence[str]) -> DataFrame:
    """The newest row per key, without the keys whose last change is a delete."""
    return latest(changes, [key], order).where(~F.col(op).eqNullSafe("DELETE"))


ENVELOPE = "op string, before struct<id bigint, name string, city_code double>, after struct<id bigint, name string, city_code double>"


def parse_envelopes(messages: DataFrame, value: str = "value") -> DataFrame:
    """Change envelopes (op c/u/d/r, before, after) to flat changes; null values are tombstones and skipped."""
    parsed = messages.where(F.col(value).isNotNull()).withColumn("__e", F.from_json(value, ENVELOPE))
    e = F.col("__e")
    return parsed.select(
        *[c for c in messages.columns if c != value],
        F.coalesce(e["after"]["id"], e["before"]["id"]).alias("id"),
        e["after"]["name"].alias("name"),
        e["after"]["city_code"].alias("city_code"),
        F.when(e["op"] == "d", "DELETE").when(e["op"] == "u", "UPDATE").otherwise("INSERT").alias("op"),
    )


def change_feed(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Difference of two snapshots as insert, update_pre, update_post and delete rows."""
    cols = [c for c in old.columns if c != key]
    both = _paired(old, new, key, cols).where(~F.col("t").eqNullSafe(F.col("s")))
    line = lambda kind, side: F.struct(F.lit(kind).alias("change"), F.col(side).alias("row"))
    lines = (
        F.when(F.col("t").isNull(), F.array(line("insert", "s")))
        .when(F.col("s").isNull(), F.array(line("delete", "t")))
        .otherwise(F.array(line("update_pre", "t"), line("update_post", "s")))
    )
    fed = both.select(key, F.explode(lines).alias("c"))
    return fed.select(key, "c.change", *[F.col("c.row")[c].alias(c) for c in cols])


# ---- deletes, duplicates, retention, collapsing ----

def delete_duplicates(df: DataFrame, group: Column, keep: str) -> DataFrame:
    """Keep the row with the smallest `keep` of each group; rows without a group all stay."""
    keyed = df.withColumn("__g", group)
    first = latest(keyed.where("__g IS NOT NULL"), ["__g"], [keep], newest=False)
    return first.unionByName(keyed.where("__g IS NULL")).drop("__g")


def retention(df: DataFrame, date: str, cutoff: Column, keys: Sequence[str], value: str) -> DataFrame:
    """Rows from the cutoff on stay, and rows without a date; older rows are rolled up per key and month."""
    fresh = df.where(F.col(date).isNull() | (F.col(date) >= cutoff)).select(*keys, F.col(date).alias("period"), F.lit("detail").alias("grain"), F.lit(1).cast("bigint").alias("n"), F.round(value, 2).alias(value))
    old = df.where(F.col(date) < cutoff).groupBy(*keys, F.trunc(date, "month").alias("period"))
    return fresh.unionByName(old.agg(F.lit("month").alias("grain"), F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 2).alias(value)))


def collapse_sign(df: DataFrame, keys: Sequence[str], sign: str, version: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows with signs +1/-1: keys whose signs sum above zero, with the values of their newest version.

    A cancel row takes away a state row of the same version; only a state row that
    is left can give the values.
    """
    held = F.max(F.when(F.col(sign) > 0, F.struct(*values))).alias("__held")
    versions = df.groupBy(*keys, *version).agg(F.sum(sign).alias("__net"), held)
    state = F.struct(*[F.col(v).alias(f"__v{i}") for i, v in enumerate(version)], *[F.col("__held")[v].alias(v) for v in values])
    alive = versions.groupBy(*keys).agg(F.sum("__net").alias("__sign"), F.max(F.when(F.col("__net") > 0, state)).alias("__s")).where("__sign > 0")
    return alive.select(*keys, *[F.col("__s")[v].alias(v) for v in values])


# ---- slowly changing dimensions ----

def scd2_apply(
    dim: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], effective: str, order: Sequence[str] | None = None
) -> DataFrame:
    """Close changed current rows at `effective`, add new versions, keep all other rows as they are.

    Only current rows are compared, null-safe.  With `order`, the last change of a
    key in the batch counts.
    """
    if order:
        incoming = latest(incoming, [key], order)
    cols = [c for c in dim.columns if c not in (key, "valid_from", "valid_to", "is_current")]
    history = dim.where(~F.coalesce("is_current", F.lit(False)))  # a row that does not say so is not current
    current = dim.where("is_current").select(key, F.struct("*").alias("d"))
    fresh = incoming.select(key, F.struct(*cols).alias("i"))
    both = current.join(fresh, key, "full")
    same = F.col("d").isNotNull() & F.col("i").isNotNull()
    for c in tracked:
        same = same & F.col(f"d.{c}").eqNullSafe(F.col(f"i.{c}"))
    when = F.lit(effective).cast("date")
    old = lambda to, now: F.struct(*[F.col(f"d.{c}").alias(c) for c in cols], F.col("d.valid_from").alias("valid_from"), to.cast("date").alias("valid_to"), now.alias("is_current"))
    new = F.struct(*[F.col(f"i.{c}").alias(c) for c in cols], when.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
    versions = (
        F.when(F.col("i").isNull() | same, F.array(old(F.col("d.valid_to"), F.lit(True))))
        .when(F.col("d").isNull(), F.array(new))
        .otherwise(F.array(old(when, F.lit(False)), new))
    )
    written = both.select(key, F.explode(versions).alias("v")).select(key, "v.*")
    return history.unionByName(written.select(*dim.columns))


def scd2_with_keys(dim: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Add a hash of the tracked columns and a surrogate key of natural key and start date."""
    surrogate = F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.col("valid_from").cast("string")), 256)
    return dim.withColumn("row_hash", row_hash(tracked)).withColumn("surrogate_key", surrogate)


def scd_snapshot(dim: DataFrame, snapshot: DataFrame, key: str, strategy: str, columns: Sequence[str], effective: str, updated_at: str | None = None) -> DataFrame:
    """Snapshot of a source: `check` compares columns, `timestamp` trusts a newer update date."""
    if strategy == "check":
        return scd2_apply(dim, snapshot, key, columns, effective)
    if strategy != "timestamp":
        raise ValueError(f"unknown snapshot strategy {strategy}")
    known = dim.where("is_current").select(key, F.col("valid_from").alias("__since"))
    newer = snapshot.join(known, key, "left").where(F.col("__since").isNull() | (F.col(updated_at) > F.col("__since")))
    stamped = newer.drop("__since")
    cols = [c for c in dim.columns if c not in (key, "valid_from", "valid_to", "is_current")]
    touched = stamped.select(key).distinct()
    closed = dim.where("is_current").join(touched, key, "left_semi").withColumn("valid_to", F.lit(effective).cast("date")).withColumn("is_current", F.lit(False))
    opened = stamped.select(key, *cols).withColumn("valid_from", F.lit(effective).cast("date")).withColumn("valid_to", F.lit(None).cast("date")).withColumn("is_current", F.lit(True))
    rest = dim.where(~F.col("is_current")).unionByName(dim.where("is_current").join(touched, key, "left_anti"))
    return rest.unionByName(closed).unionByName(opened.select(*dim.columns))


def scd_type0(dim: DataFrame, incoming: DataFrame, key: str, column: str) -> DataFrame:
    """The first value ever stored stays."""
    new = incoming.select(key, F.col(column).alias("__new"))
    return dim.join(new, key, "full").select(key, F.coalesce(column, "__new").alias(column))


def scd_type1(dim: DataFrame, incoming: DataFrame, key: str, column: str) -> DataFrame:
    """The newest value replaces the old one."""
    new = incoming.select(key, F.col(column).alias("__new"), F.lit(True).alias("__has"))
    return dim.join(new, key, "full").select(key, F.when(F.col("__has"), F.col("__new")).otherwise(F.col(column)).alias(column))


def scd_type3(dim: DataFrame, incoming: DataFrame, key: str, column: str) -> DataFrame:
    """The newest value, with the one before it in a column of its own."""
    new = incoming.select(key, F.col(column).alias("__new"), F.lit(True).alias("__has"))
    both = dim.select(key, column, F.lit(True).alias("__had")).join(new, key, "full")
    changed = F.col("__has") & F.col("__had") & ~F.col(column).eqNullSafe(F.col("__new"))
    now = F.when(F.col("__has"), F.col("__new")).otherwise(F.col(column))
    return both.select(key, now.alias(column), F.when(changed, F.col(column)).alias(f"previous_{column}"))


def scd_type4(dim: DataFrame, incoming: DataFrame, key: str, column: str, effective: str) -> DataFrame:
    """The rows that move to the history table when the current table is overwritten."""
    new = incoming.select(key, F.col(column).alias("__new"))
    moved = dim.join(new, key).where(~F.col(column).eqNullSafe(F.col("__new")))
    return moved.select(key, column, F.lit(effective).cast("date").alias("archived_on"))


def scd_type6(dim: DataFrame, incoming: DataFrame, key: str, column: str, effective: str) -> DataFrame:
    """Type 2 versions that also carry the current value on every version."""
    versions = scd2_apply(dim, incoming, key, [column], effective)
    now = versions.where("is_current").select(key, F.col(column).alias(f"current_{column}"))
    return versions.join(now, key, "left")


def scd2_validate(dim: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys that break a rule: overlapping validity, or not exactly one current row."""
    open_end = F.coalesce("valid_to", F.lit("9999-12-31").cast("date"))
    v = dim.select(key, "valid_from", open_end.alias("__to"), "is_current", F.xxhash64(*dim.columns).alias("__tie"))
    o = running(ordered(v, [key], ["valid_from", "__tie"], hot_rows=hot_rows), {"__reach": ("max", F.col("__to"))}, exclusive=True)
    overlap = F.max(F.coalesce(F.col("valid_from") < F.col("__reach"), F.lit(False))).alias("has_overlap")
    per_key = o.result().groupBy(key).agg(overlap, F.count_if("is_current").alias("current_rows"))
    return per_key.where("has_overlap OR current_rows <> 1")


# ---- facts ----

def periodic_snapshot(df: DataFrame, key: str, date: str, value: str, last: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per key and month from its first month to `last`, with the running total at month end.

    Months without rows are filled by stretching each total up to the next active
    month, so no calendar is crossed with the keys.
    """
    months = df.groupBy(key, F.trunc(date, "month").alias("m")).agg(F.sum(value).alias("v"))
    o = ordered(months, [key], ["m"], hot_rows=hot_rows)
    o = running(o, {"balance": ("sum", F.col("v"))})
    rows = shift(o, {"next": F.col("m")}, ["m"], ahead=True).result()
    until = F.coalesce(F.add_months("next", -1), F.trunc(last, "month"))
    filled = rows.select(key, F.explode(F.sequence("m", until, F.expr("interval 1 month"))).alias("month"), "balance")
    return filled.select(key, "month", F.round("balance", 2).alias("balance"))


def vault_hub(df: DataFrame, key: str, existing: DataFrame | None = None) -> DataFrame:
    """Business keys with their hash; keys already in the hub are left out."""
    hub = df.select(F.sha2(F.col(key).cast("string"), 256).alias("hub_key"), F.col(key).alias("business_key")).distinct()
    return hub if existing is None else hub.join(existing.select("hub_key"), "hub_key", "left_anti")


def vault_link(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Relations between business keys, by hash."""
    hashed = [F.sha2(F.col(k).cast("string"), 256).alias(f"{k}_hub") for k in keys]
    joint = F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]), 256).alias("link_key")
    return df.select(joint, *hashed).distinct()


def vault_satellite(df: DataFrame, key: str, columns: Sequence[str], existing: DataFrame | None = None) -> DataFrame:
    """Descriptions of a business key; only versions that the satellite lacks are added."""
    sat = df.select(F.sha2(F.col(key).cast("string"), 256).alias("hub_key"), row_hash(columns).alias("row_hash"), *columns).distinct()
    return sat if existing is None else sat.join(existing.select("hub_key", "row_hash"), ["hub_key", "row_hash"], "left_anti")
