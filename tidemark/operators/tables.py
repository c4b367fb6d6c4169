"""Row semantics of table maintenance, as joins over plain tables.

Every function returns the whole next state as one plan, so nothing reads a
table that the same job is changing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import all_of, any_of, same
from tidemark.operators.windows import latest

SOURCE = "s_"


class DuplicateKeyError(ValueError):
    """A source table repeats a key that must be unique."""


class NullKeyError(ValueError):
    """A source table lacks a key where a rerun could not recognise the row."""


def require_unique(df: DataFrame, keys: list[str], nulls: bool = True) -> None:
    """Raise when a key occurs twice, or, without ``nulls``, is NULL; counted map-side, one row back.

    With ``nulls``, rows without a key may repeat.
    """
    missing = any_of(F.col(k).isNull() for k in keys)
    counted = df.filter(~missing) if nulls else df
    wrong = (F.col("n") > 1) if nulls else (F.col("n") > 1) | missing
    found = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(wrong).first()
    if found is None:
        return
    key = [found[k] for k in keys]
    if None in key:
        raise NullKeyError(f"{found['n']} row(s) with the key {key}")
    raise DuplicateKeyError(f"key {key} occurs {found['n']} times")


def _matched(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows with the update columns as ``s_*`` and a ``__hit`` flag."""
    source = updates.withColumnsRenamed({c: f"{SOURCE}{c}" for c in updates.columns}).withColumn("__hit", F.lit(True))
    on = all_of(F.col(k) == F.col(f"{SOURCE}{k}") for k in keys)
    return target.join(source, on, "left").withColumn("__hit", F.coalesce("__hit", F.lit(False)))


def _unseen(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Update rows whose key the target lacks.

    The target is cut to its distinct keys first, so a key repeated there a
    billion times weighs one row.
    """
    return updates.join(target.select(*keys).distinct(), keys, "left_anti").select(*updates.columns)


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    set_cols: list[str] | None = None,
    when: Column | None = None,
) -> DataFrame:
    """Update matched rows, insert new ones, keep the rest.

    ``set_cols`` limits the updated columns; ``when`` is an extra condition for
    the update over the target columns and the update columns named ``s_*``.
    A NULL key matches nothing, as in MERGE.
    """
    require_unique(updates, keys)
    set_cols = [c for c in (set_cols or target.columns) if c not in keys]
    apply = F.col("__hit") if when is None else F.col("__hit") & F.coalesce(when, F.lit(False))
    kept = _matched(target, updates, keys).select(
        *[F.when(apply, F.col(f"{SOURCE}{c}")).otherwise(F.col(c)).alias(c) if c in set_cols else F.col(c)
          for c in target.columns]
    )
    return kept.unionByName(_unseen(target, updates, keys).select(*target.columns))


def delete_matched(target: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    """Target without the rows whose key is listed."""
    return target.join(keys_df.select(*keys).distinct(), keys, "left_anti").select(*target.columns)


def merge_metrics(target: DataFrame, updates: DataFrame, keys: list[str], delete: Column | None = None) -> DataFrame:
    """One row: rows a merge would update, insert, delete and leave alone.

    ``delete`` is a condition under which a matched row is deleted instead.
    """
    require_unique(updates, keys)
    gone = F.lit(False) if delete is None else F.coalesce(delete, F.lit(False))
    hit = F.col("__hit")
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    existing = _matched(target, updates, keys).select(
        F.when(hit & ~gone, one).otherwise(none).alias("rows_updated"),
        none.alias("rows_inserted"),
        F.when(hit & gone, one).otherwise(none).alias("rows_deleted"),
        F.when(~hit, one).otherwise(none).alias("rows_unchanged"),
    )
    fresh = _unseen(target, updates, keys).select(none, one, none, none)
    return existing.union(fresh).agg(*[F.coalesce(F.sum(c), none).alias(c) for c in existing.columns])


def insert_new(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Append only the keys not yet present; loading a batch twice changes nothing.

    A batch row without a key is refused: a second load could not find it.
    """
    require_unique(batch, keys, nulls=False)
    return target.unionByName(_unseen(target, batch, keys))


class SchemaMismatchError(ValueError):
    """An append carries columns the table does not have."""


def evolve_append(table: DataFrame, batch: DataFrame, allow_new: bool = False) -> DataFrame:
    """Append; new columns raise unless allowed, and are then NULL in old rows.

    This never matches rows: an existing key comes out twice.  Use ``upsert``
    to update.
    """
    clash = {n for n, t in batch.dtypes if dict(table.dtypes).get(n, t) != t}
    if clash:
        raise SchemaMismatchError(f"types differ for {sorted(clash)}")
    if set(batch.columns) != set(table.columns) and not allow_new:
        raise SchemaMismatchError(f"columns differ: {table.columns} and {batch.columns}")
    return table.unionByName(batch, allowMissingColumns=allow_new)


# --- versioned tables -------------------------------------------------------
# A history holds the keys and payload of every change with ``version``,
# ``op`` ('upsert' or 'delete') and ``committed_at``.  After an expiry it also
# holds one row with the op 'expired': nothing before its version and commit
# time can be told any more, and readers are refused there.

META = ["version", "op", "committed_at"]
EXPIRED = "expired"


def _changes(history: DataFrame) -> DataFrame:
    """The history without its expiry mark."""
    return history.filter(F.col("op") != EXPIRED)


def _mark(history: DataFrame, column: str) -> Column:
    """Highest ``column`` of the expiry marks, NULL without one; part of the plan, not a job."""
    return history.filter(F.col("op") == EXPIRED).agg(F.max(column)).scalar()


def _seen(history: DataFrame, version: int | None = None, timestamp=None) -> Column:
    """Whether a change was made by then.  Fails on every row, the mark included, if that time was folded away."""
    if version is not None:
        told, cut, asked = F.col("version") <= version, _mark(history, "version"), F.lit(version)
    else:
        kind = dict(history.dtypes)["committed_at"]
        asked = F.lit(timestamp).cast(kind)
        told, cut = F.col("committed_at") <= asked, _mark(history, "committed_at")
    late = F.raise_error(
        F.concat(F.lit("the state at "), asked.cast("string"), F.lit(" was folded away; the first kept is "), cut.cast("string"))
    )
    return F.when(asked < cut, late.cast("boolean")).otherwise(told)


def as_of(history: DataFrame, keys: list[str], version: int | None = None, timestamp=None) -> DataFrame:
    """The table at a version or at a point in time; reading a state that was folded away fails."""
    if (version is None) == (timestamp is None):
        raise ValueError("give a version or a timestamp")
    return current(history.filter(_seen(history, version, timestamp)), keys)


def current(history: DataFrame, keys: list[str]) -> DataFrame:
    return latest(_changes(history), keys, ["version"], []).filter("op <> 'delete'").drop(*META)


def history_log(history: DataFrame) -> DataFrame:
    """One row per version: when, and how many upserts and deletes.

    Versions that were folded away, the one they were folded into included,
    are no longer known change by change and left out.
    """
    cut = _mark(history, "version")
    known = history.filter(cut.isNull() | (F.col("version") > cut))
    return known.groupBy("version").agg(
        F.max("committed_at").alias("committed_at"),
        F.count_if(F.col("op") == "upsert").alias("upserts"),
        F.count_if(F.col("op") == "delete").alias("deletes"),
    )


def restore(history: DataFrame, keys: list[str], version: int, committed_at) -> DataFrame:
    """Append a version that makes the table equal to an earlier one.

    Only differing rows are written, and the earlier versions stay readable;
    a state that was folded away cannot be restored.  Both states of a key come
    from one grouping of its changes.
    """
    payload = [c for c in history.columns if c not in META and c not in keys]
    change = F.struct(F.col("op"), *[F.col(c) for c in payload])
    then = _seen(history, version)
    states = (
        history.withColumn("__then", then)
        .filter(F.col("op") != EXPIRED)
        .groupBy(*keys)
        .agg(
            F.max_by(change, "version").alias("new"),
            F.max_by(change, F.when(F.col("__then"), F.col("version"))).alias("old"),
        )
    )
    in_new = F.col("new.op") != "delete"
    in_old = F.coalesce(F.col("old.op") != "delete", F.lit(False))
    differs = any_of([in_old != in_new, *[in_old & ~same(F.col(f"old.{c}"), F.col(f"new.{c}")) for c in payload]])
    last = history.agg(F.max("version")).scalar()
    back = states.filter(differs).select(
        *keys,
        *[F.when(in_old, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")).alias(c) for c in payload],
        (last + 1).cast(dict(history.dtypes)["version"]).alias("version"),
        F.when(in_old, "upsert").otherwise("delete").alias("op"),
        F.lit(committed_at).cast(dict(history.dtypes)["committed_at"]).alias("committed_at"),
    )
    return history.unionByName(back)


def expire_history(
    history: DataFrame, keys: list[str], cutoff: int, now=None, min_age_days: int = 7, force: bool = False
) -> DataFrame:
    """Fold all versions up to ``cutoff`` into the state at ``cutoff`` and mark the cut.

    Unless forced, versions younger than ``min_age_days`` before ``now`` are
    protected.  The mark makes ``as_of`` and ``restore`` refuse earlier states.
    """
    old = history.filter(F.col("version") <= cutoff)
    if not force:
        if now is None:
            raise ValueError("name the present time, or force the expiry")
        young = F.lit(now).cast("timestamp") - F.make_interval(days=F.lit(min_age_days))
        newest = old.agg((F.max(F.col("committed_at").cast("timestamp")) > young).alias("young"))
        if newest.first()["young"]:
            raise ValueError(f"versions up to {cutoff} are younger than {min_age_days} days")
    types = dict(history.dtypes)
    values = {
        "version": F.lit(cutoff).cast(types["version"]),
        "op": F.lit(EXPIRED),
        "committed_at": F.max("committed_at"),
    }
    # An older mark is among the rows folded now.
    mark = old.agg(*[values.get(c, F.lit(None).cast(types[c])).alias(c) for c in history.columns])
    state = latest(_changes(old), keys, ["version"], []).filter("op <> 'delete'")
    return state.unionByName(history.filter(F.col("version") > cutoff)).unionByName(mark)
