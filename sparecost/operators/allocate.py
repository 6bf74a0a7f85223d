"""Spread the amount of a pool over lines in proportion to a weight."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparecost.functions.semantics import col, exact_sum
from sparecost.operators.merge import merge_update, unique_source


@dataclass
class Pool:
    """Amounts by key. on: {pool column: column of the lines, or an expression over them}.

    few: the keys are a closed list, such as regions, countries, product lines or payers. Their rates are then broadcast: a
    shuffle by such a key would bring all lines of a region to one task, and write all lines before the bytes of the rates are known.
    """

    df: DataFrame
    on: dict
    amount: str
    on_duplicate: str = "error"
    few: bool = False


def rate_by_group(
    lines: DataFrame, pool: Pool, weight, base: Column, *, zero_base: str = "skip"
) -> DataFrame:
    """Amount per unit of weight for every key of the pool that has lines.

    The weights are summed per key with map-side partial sums, so one hot key costs one row per
    task. The result has at most as many rows as the pool.
    zero_base, for keys without a total: 'skip' drops zero totals, 'positive' also negative ones,
    'zero' rates both 0, 'any' keeps the keys with a null rate.
    """
    totals = (
        lines.filter(base)
        .groupBy(*[col(n).alias(k) for k, n in pool.on.items()])
        .agg(exact_sum(weight).alias("__total"))
    )
    amounts = unique_source(
        pool.df.select(*pool.on, F.col(pool.amount).cast("double").alias("__amount")), list(pool.on), pool.on_duplicate
    )
    rates = amounts.join(totals, list(pool.on), "inner")
    ratio = F.col("__amount") / F.nullif(F.col("__total"), F.lit(0.0))
    if zero_base == "zero":
        rate = F.when(F.col("__total") > 0, ratio).otherwise(F.lit(0.0))
    elif zero_base == "positive":
        rates, rate = rates.filter(F.col("__total") > 0), ratio
    elif zero_base == "any":
        rate = ratio
    else:
        rates, rate = rates.filter(F.col("__total") != 0), ratio
    return rates.select(*pool.on, "__total", rate.alias("__rate"))


def allocate_pool(
    lines: DataFrame,
    pool: Pool,
    weight,
    out: str,
    *,
    base: Column,
    target: Column | None = None,
    share=None,
    zero_base: str = "skip",
    extra: dict | None = None,
    sums_from: DataFrame | None = None,
) -> DataFrame:
    """out = amount of the key / sum of weight over `base` lines of the key x share of the line.

    target  lines that receive a share (default: the base lines)
    share   what the line's part is measured by, if not the weight
    extra   further constants to set on the lines that receive a share
    sums_from  the same lines as a stored stage, if `base` and `weight` use only its columns: the
            totals then read that table and not the plan of the allocations before this one

    Rates are aggregates of a master and small: adaptive execution broadcasts them once their bytes are known, so
    few and hot keys do not decide where lines are shuffled to. It takes a join of two aggregates for larger than it is, so
    pools by such keys say that they are `few`. Larger rates join by shuffle, where it splits hot keys.
    """
    rates = rate_by_group(lines if sums_from is None else sums_from, pool, weight, base, zero_base=zero_base)
    if pool.few:
        rates = F.broadcast(rates)
    share = col(weight if share is None else share)
    return merge_update(
        lines,
        rates,
        pool.on,
        {out: F.col("src___rate") * share, **(extra or {})},
        where=base if target is None else target,
        on_duplicate="unique",
    )
