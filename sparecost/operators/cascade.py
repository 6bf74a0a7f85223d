"""Ordered business rules where the last matching rule wins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Rule:
    """Set `values` where `when` is true.

    reads: the condition or a value looks at a column that the cascade changes, so the rule must
    see the outcome of all rules before it.
    """

    when: Column
    values: dict
    reads: bool = False


def _levels(rules: list[Rule]) -> list[list[Rule]]:
    levels: list[list[Rule]] = []
    for rule in rules:
        if rule.reads or not levels:
            levels.append([])
        levels[-1].append(rule)
    return levels


def rule_cascade(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Apply rules in order, last match wins, as one projection per dependency level.

    Within a level the list is reversed: the first match of the reversed list is the last match of
    the given one. A matching rule with a null value clears the target.
    """
    for level in _levels(rules):
        targets = list(dict.fromkeys(t for rule in level for t in rule.values))
        new = {}
        for target in targets:
            branches = [(r.when, r.values[target]) for r in reversed(level) if target in r.values]
            chain = F.when(*_pair(branches[0]))
            for branch in branches[1:]:
                chain = chain.when(*_pair(branch))
            new[target] = chain.otherwise(F.col(target))
        df = df.withColumns(new)
    return df


def _pair(branch):
    condition, value = branch
    return condition, value if isinstance(value, Column) else F.lit(value)
