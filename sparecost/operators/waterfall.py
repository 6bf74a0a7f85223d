"""Fill columns from several sources in order; a later source fills only what is still missing."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparecost.operators.merge import unique_source


@dataclass
class Step:
    """One source of a waterfall.

    on       {source column: column name of the table}
    set_     {target: source column name or constant Column}
    where    further condition on the table's row
    """

    src: DataFrame
    on: dict
    set_: dict
    where: Column | None = None
    on_duplicate: str = "error"
    order: tuple = ()
    tiebreak: tuple = ()


def _source(step: Step, number: int, near: set = frozenset()) -> DataFrame:
    src = unique_source(
        step.src, list(step.on), step.on_duplicate, step.order, step.tiebreak, [k for k, name in step.on.items() if name in near])
    used = {v for v in step.set_.values() if isinstance(v, str)}
    return src.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(step.on)],
        *[F.col(c).alias(f"s{number}_{c}") for c in sorted(used)],
        F.lit(True).alias(f"s{number}_hit"),
    )


def waterfall_lookup(df: DataFrame, steps: list[Step], missing: Column) -> DataFrame:
    """Apply `steps` in order; each changes only rows where `missing` still holds.

    Steps that use the same key columns are first joined among themselves, so the large table is
    shuffled once per distinct key and not once per source; the order is then a select per step.
    Shorter keys are joined first: their partitioning also serves a longer key that contains them.
    """
    groups: dict[tuple, list[int]] = {}
    for number, step in enumerate(steps):
        groups.setdefault(tuple(step.on.values()), []).append(number)
    joined, near = df, set()
    for names, numbers in sorted(groups.items(), key=lambda group: len(group[0])):
        keys = [f"__k{i}" for i in range(len(names))]
        # a full join of several sources is by all keys
        sources = [_source(steps[n], n, near if near < set(names) and len(numbers) == 1 else set()) for n in numbers]
        near = near if near and near < set(names) else set(names)
        right = reduce(lambda a, b: a.join(b, keys, "full"), sources)
        condition = F.lit(True)
        for key, name in zip(keys, names):
            equal = F.col(f"l.{name}") == F.col(f"r.{key}")
            condition = equal if key == "__k0" else condition & equal
        kept = joined.columns
        joined = joined.alias("l").join(right.alias("r"), condition, "left").select(
            *[F.col(f"l.{c}") for c in kept],
            *[F.col(f"r.{c}") for c in right.columns if c not in keys],
        )
    for number, step in enumerate(steps):
        fires = F.col(f"s{number}_hit").isNotNull() & missing
        if step.where is not None:
            fires = fires & F.coalesce(step.where, F.lit(False))
        new = {}
        for target, value in step.set_.items():
            value = F.col(f"s{number}_{value}") if isinstance(value, str) else value
            new[target] = F.when(fires, value).otherwise(F.col(target))
        joined = joined.withColumns(new)
    return joined.select(*df.columns)
