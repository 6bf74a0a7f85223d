"""Keep the newest row of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(c) -> Column:
    return F.desc_nulls_last(c) if isinstance(c, str) else c


def latest_per_key(df: DataFrame, keys, order, tiebreak=()) -> DataFrame:
    """One row per non-null key: the first by `order` (names mean newest first), then by `tiebreak`.

    The rank is filtered to 1, so each map task already drops all but its best row of a key
    before the shuffle (partial window-group limit). A hot key therefore sends one row per task.
    Rows with a null key are dropped; they would share one rank group.
    """
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    ranking = Window.partitionBy(*keys).orderBy(*[_order(c) for c in [*order, *tiebreak]])
    return (
        df.filter(present)
        .withColumn("__rank", F.row_number().over(ranking))
        .filter(F.col("__rank") == 1)
        .drop("__rank")
    )
