"""Steps over wide lines that carry the columns they do not look at as one value."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REST = "__rest"


def with_rest_packed(lines: DataFrame, used: Iterable[str], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The step over `lines`; columns that are not `used` pass through its joins as one struct.

    Every join copies the rows of the lines, column by column, where its code is too large to be compiled with the joins around
    it; a struct is copied as one block of bytes. used: all columns that the step reads or sets, if the lines have them. A column
    that is missing there fails the step, whether it is read or made anew.
    """
    used = set(used)
    apart = [c for c in lines.columns if c in used]
    rest = [c for c in lines.columns if c not in used]
    if not apart or len(rest) < 2:
        return step(lines)
    done = step(lines.select(*apart, F.struct(*rest).alias(REST)))
    again = sorted(set(done.columns) & set(rest))
    if again:
        raise ValueError(f"the step makes columns that the lines have: {', '.join(again)}")
    kept = [F.col(c) if c in used else F.col(f"{REST}.{c}") for c in lines.columns if c in rest or c in done.columns]
    return done.select(*kept, *[F.col(c) for c in done.columns if c not in apart and c != REST])
