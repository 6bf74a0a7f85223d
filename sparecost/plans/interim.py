"""Interim costing: estimate the coming quarter from the averages of the last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparecost import rules as R
from sparecost.functions import semantics as S
from sparecost.operators import merge_update
from sparecost.sources import Published

KEYS = R.Options().interim_keys
COMPONENTS = {
    "interim_cons_cost": "cons_cost", "interim_nppo_cost": "nppo_cost", "interim_relabel_cost": "relabel_cost",
    "interim_dekit_cost": "dekit_cost", "interim_taxes": "taxes",
}
TOTAL = "interim_total"
# what the estimate reads of a history of lines: all that a history kept for it alone has to hold
READS = tuple(dict.fromkeys((
    "unique_link_key", *KEYS, "region", "event_spl", "part_qty_consumed", "part_qty_demanded", "event_pn_nrs", *COMPONENTS.values(),
    "total_matl_cost", "data_period",
)))
_OPTIONS = ("Option 1 - PART CONS", "Option 1 - DEMAND BUT NO CONS")
_OPTION = "interim_option"


def interim_label(period: str) -> str:
    return f"{S.previous_period(period)}-{period}"


def _option() -> Column:
    """Which of the two averages a line takes part in; null for a line without consumption and demand."""
    consumed, demanded = F.col("part_qty_consumed"), F.col("part_qty_demanded")
    return F.when(consumed > 0, _OPTIONS[0]).when((consumed == 0) & (demanded > 0), _OPTIONS[1])


def averages(previous: DataFrame, keys=KEYS, components: bool = True, null_as_zero: bool = True) -> DataFrame:
    """Cost per record of the last quarter by option and key, in one table. Components always weigh by consumed
    quantity, so they are 0 for lines that were demanded and not consumed; the total weighs by demand there.

    components=False and null_as_zero=False give the first version of the model.
    """
    def per_record(cost, qty):
        cost = F.col(cost).cast("double")
        cost = S.zero(cost) if null_as_zero else cost
        return S.exact_sum(F.coalesce(qty, F.lit(0)) * cost) / F.count(F.lit(1))

    consumed = F.col("part_qty_consumed")
    wanted = {out: per_record(c, consumed) for out, c in COMPONENTS.items()} if components else {}
    wanted[TOTAL] = per_record("total_matl_cost", F.when(F.col(_OPTION) == _OPTIONS[0], consumed).otherwise(F.col("part_qty_demanded")))
    rows = previous.withColumn(_OPTION, _option()).filter(F.col(_OPTION).isNotNull())
    return rows.groupBy(_OPTION, *keys).agg(*[v.alias(c) for c, v in wanted.items()])


def option_one(current: DataFrame, previous: DataFrame, number: int, keys=KEYS, components: bool = True,
               null_as_zero: bool = True) -> DataFrame:
    """Lines of the quarter with an average of one option and the same key; a null key matches nothing."""
    lines = current.withColumn(_OPTION, _option()).filter(F.col(_OPTION) == _OPTIONS[number]).select("unique_link_key", _OPTION, *keys)
    found = averages(previous, keys, components, null_as_zero)
    return lines.join(found, [_OPTION, *keys], "inner").select(
        "unique_link_key", *keys, *[c for c in found.columns if c not in (_OPTION, *keys)], _OPTION)


def adders_of(adders: DataFrame, period: str, previous: str) -> tuple[DataFrame, DataFrame]:
    own = adders.filter((F.col("data_period") == period) & S.not_blank("event_spl"))
    others = adders.filter((F.col("data_period") == previous) & (F.col("event_spl") == R.ALL_OTHERS))
    return own.select("region", "event_spl", "non_nrs_rate"), others.select("region", "non_nrs_rate").distinct()


def second_total(lines: DataFrame, adders: DataFrame | None, period: str) -> DataFrame:
    """Add `second_total`: net standard and an adder per consumed unit, of the product line, else the region's last 'All Others'."""
    qty = S.zero(F.col("part_qty_consumed").cast("double"))
    if adders is None:
        return lines.withColumn("second_total", F.col("part_qty_consumed") * F.col("event_pn_nrs"))
    own, others = adders_of(adders, period, S.previous_period(period))
    lines = merge_update(lines, own, ["region", "event_spl"], {"own_rate": S.zero(F.col("src_non_nrs_rate").cast("double"))})
    lines = merge_update(lines, others, ["region"], {"other_rate": F.col("src_non_nrs_rate").cast("double")})
    adder = F.coalesce("own_rate", "other_rate")
    return lines.withColumn("second_total", qty * S.zero("event_pn_nrs") + qty * adder).drop("own_rate", "other_rate")


def interim_costs(history: DataFrame, adders: DataFrame | None, period: str, keys=KEYS, components: bool = True,
                  null_as_zero: bool = True) -> DataFrame:
    """Option one for consumed and for demanded lines, option two for the rest, with totals as money.

    One join with the averages of both options decides: a line that finds its option and key takes option one, any other
    line with a link key option two. So each quarter is read once, and no line is looked up among those already done.
    history is partitioned by period, so each quarter is read alone.
    """
    current = history.filter(F.col("data_period") == period).withColumn(_OPTION, _option())
    found = averages(history.filter(F.col("data_period") == S.previous_period(period)), keys, components, null_as_zero)
    values = [c for c in found.columns if c not in (_OPTION, *keys)]
    wanted = ["unique_link_key", _OPTION, *keys, "region", "event_spl", "part_qty_consumed", "event_pn_nrs"]
    lines = second_total(current.select(*dict.fromkeys(wanted)), adders, period)
    joined = lines.join(found.withColumn("__found", F.lit(True)), [_OPTION, *keys], "left")
    joined = joined.filter(F.col("__found") | F.col("unique_link_key").isNotNull())
    first = F.col("__found").isNotNull()
    joined = joined.withColumns({
        TOTAL: F.when(first, F.col(TOTAL)).otherwise(F.col("second_total")), _OPTION: F.when(first, F.col(_OPTION)).otherwise(F.lit("Option 2")),
    })
    return finish(joined.select("unique_link_key", *keys, *values, _OPTION), period)


def publish_interim(history: DataFrame, adders: DataFrame | None, period: str, table: Published, keys=KEYS) -> int:
    """Replace the estimate of one quarter, under the label derived from it and the quarter before; other labels stay.

    `history` may be read from the same table: its snapshot stays readable while the label is replaced.
    """
    label = interim_label(period)
    costs = interim_costs(history, adders, period, keys).withColumn(table.column, F.lit(label))
    return table.replace(costs, [label], spread=False)  # one value, so a task writes one file


def finish(costs: DataFrame, period: str) -> DataFrame:
    amounts = [c for c in (*COMPONENTS, TOTAL) if c in costs.columns]
    costs = costs.withColumns({c: S.money(c) for c in amounts})
    return costs.withColumns({
        "interim_non_event_cost": F.lit(None).cast(S.MONEY), "interim_period": F.lit(interim_label(period)),
    }).withColumn(
        "interim_total_non_event",
        (F.coalesce(F.col(TOTAL), F.lit(0)) + F.coalesce(F.col("interim_non_event_cost"), F.lit(0))).cast(S.MONEY),
    )
