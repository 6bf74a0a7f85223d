"""Update columns of a table from a second table by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparecost.operators.latest import latest_per_key

_SLOTS = 1024
_NO_KEY = "\u0000"
LINE_KEY = "unique_link_key"


def with_spread(df: DataFrame, key: str, name: str, by: str = LINE_KEY) -> DataFrame:
    """Add `name`: the join key, or where it is null one of many values that no source row has.

    Lines without a tag or part are a large share of all lines. As nulls they would meet in one
    partition of every join on that key; this way they spread over all of them. The value depends on
    the row only, so a recomputed task puts every row in the same place.
    """
    slot = F.pmod(F.xxhash64(F.col(by)), F.lit(_SLOTS)).cast("string")
    return df.withColumn(name, F.coalesce(F.col(key), F.concat(F.lit(_NO_KEY), slot)))


def unique_source(src: DataFrame, keys, on_duplicate: str = "error", order=(), tiebreak=(), near=()) -> DataFrame:
    """Make `src` one row per key.

    error: a second row for a key fails the job. first: keep the first by the order given.
    unique: the caller's plan already groups by the key, nothing to do.
    near: those of the keys that the other side of the join is partitioned by. Rows are checked where they join, so they are
    shuffled once and not by all keys before.
    """
    if on_duplicate == "unique":
        return src
    if on_duplicate == "first":
        return latest_per_key(src, keys, order, tiebreak)
    if on_duplicate != "error":
        raise ValueError(on_duplicate)
    values = [c for c in src.columns if c not in keys]
    if not values:
        return src.distinct()
    if near:
        src = src.repartition(*near)
    grouped = src.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in values]
    )
    failed = F.raise_error(F.concat_ws(" ", F.lit("two source rows for key"), *[F.col(k).cast("string") for k in keys]))
    checked = [F.when(F.col("__n") > 1, failed).otherwise(F.col(c)).alias(c) for c in values]
    return grouped.select(*keys, *checked)


def merge_update(
    df: DataFrame,
    src: DataFrame,
    on,
    set_: dict,
    *,
    where: Column | None = None,
    unmatched: str = "keep",
    on_duplicate: str = "error",
    order=(),
    tiebreak=(),
    near=(),
) -> DataFrame:
    """Set `set_` columns of `df` from the row of `src` with the same key.

    on       list of common column names, or {source column: name or expression of df}
    set_     {target: source column name, or an expression over df and src_<source column>}
    where    rows of df that may change; expressions see the values before the update
    unmatched  'keep' leaves the target of rows without a source row, 'null' clears it
    near     source columns whose partners `df` is already partitioned by, if that is not all of them

    A key that is null on many rows is given as the column with_spread() made of it.
    """
    on = on if isinstance(on, dict) else {k: k for k in on}
    src = unique_source(src, list(on), on_duplicate, order, tiebreak, near)
    values = [c for c in src.columns if c not in on]
    right = src.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(on)],
        *[F.col(c).alias(f"src_{c}") for c in values],
        F.lit(True).alias("__hit"),
    )
    left, keys = df, []
    for i, expr in enumerate(on.values()):
        if isinstance(expr, str):
            keys.append(F.col(f"l.{expr}") == F.col(f"r.__k{i}"))
        else:
            left = left.withColumn(f"__e{i}", expr)
            keys.append(F.col(f"l.__e{i}") == F.col(f"r.__k{i}"))
    condition = keys[0]
    for key in keys[1:]:
        condition = condition & key
    joined = left.alias("l").join(right.alias("r"), condition, "left")
    hit = F.col("__hit").isNotNull()
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    changed = {}
    for target, value in set_.items():
        value = F.col(f"src_{value}") if isinstance(value, str) else value
        if unmatched == "null":
            new = F.when(F.col("__hit").isNotNull(), value)
            changed[target] = new if where is None else F.when(where, new).otherwise(_old(df, target))
        else:
            changed[target] = F.when(hit, value).otherwise(_old(df, target))
    kept = [changed.pop(c).alias(c) if c in changed else F.col(f"l.{c}") for c in df.columns]
    return joined.select(*kept, *[v.alias(c) for c, v in changed.items()])


def _old(df: DataFrame, target: str) -> Column:
    return F.col(target) if target in df.columns else F.lit(None)
