"""Column expressions with the null, blank, date and rounding rules of the cost model."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(28,6)"
MONEY = "decimal(19,4)"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- null, blank and zero tests -------------------------------------------------

def is_blank(c) -> Column:
    """Text that is null or empty (blanks do not count as text)."""
    c = col(c)
    return c.isNull() | (F.trim(c) == "")


def not_blank(c) -> Column:
    return ~is_blank(c)


def is_null_or_zero(c) -> Column:
    c = col(c)
    return c.isNull() | (c == 0)


def has_amount(c) -> Column:
    return ~is_null_or_zero(c)


def is_null_or_negative(c) -> Column:
    c = col(c)
    return c.isNull() | (c < 0)


def not_value(c, value) -> Column:
    """True where the text is null or differs from value."""
    return F.coalesce(col(c) != value, F.lit(True))


def name_key(c) -> Column:
    """Names of suppliers, vendors and makers compare, join and group by this: without case and trailing blanks."""
    return F.lower(F.rtrim(col(c)))


def is_named(c, *names) -> Column:
    return name_key(c).isin(*[n.lower() for n in names])


def name_starts(c, *prefixes) -> Column:
    """A name that begins with one of the prefixes; null for a null name."""
    return reduce(or_, [name_key(c).startswith(p.lower()) for p in prefixes])


def zero(c) -> Column:
    return F.coalesce(col(c), F.lit(0.0))


def starts_with_any(c, prefixes) -> Column:
    c = F.coalesce(col(c), F.lit(""))
    result = F.lit(False)
    for prefix in prefixes:
        result = result | c.startswith(prefix)
    return result


def pick_b_over_a(b, a) -> Column:
    """The second receipt's value unless it is blank."""
    return F.when(is_blank(b), col(a)).otherwise(col(b))


# ---- numbers --------------------------------------------------------------------

def exact_sum(c) -> Column:
    """Sum that does not depend on row order: every addend is rounded to six decimals first, money having four."""
    return F.sum(col(c).cast(EXACT)).cast("double")


def exact_avg(c) -> Column:
    c = col(c)
    return F.sum(c.cast(EXACT)).cast("double") / F.nullif(F.count(c), F.lit(0))


def safe_ratio(a, b) -> Column:
    return col(a).cast("double") / F.nullif(col(b).cast("double"), F.lit(0.0))


def money(c) -> Column:
    return col(c).cast(MONEY)


# ---- text -----------------------------------------------------------------------

def text_length(c) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(col(c)))


def hyphenate(c) -> Column:
    return F.replace(col(c), F.lit(" "), F.lit("-"))


def unhyphenate(c) -> Column:
    return F.replace(col(c), F.lit("-"), F.lit(""))


def is_repair_tag(c) -> Column:
    c = col(c)
    return c.contains("FT") | c.startswith("$T") | c.startswith("0T")


def normalise_tag(c) -> Column:
    """Cut a tag at its FT; a tag that starts $T or 0T starts with FT in truth."""
    c = col(c)
    return (
        F.when(c.contains("FT"), F.substring(c, F.instr(c, "FT"), F.length(c)))
        .when(c.startswith("$T") | c.startswith("0T"), F.concat(F.lit("F"), F.substring(c, F.lit(2), F.length(c))))
        .otherwise(c)
    )


def recode_region(c) -> Column:
    c = col(c)
    return F.when(c == "AMS", F.lit("AME")).otherwise(c)


# ---- dates and periods ----------------------------------------------------------

def year_month(c) -> Column:
    return F.date_format(col(c), "yyyyMM")


def add_to_month(c, months: int) -> Column:
    """Real month arithmetic on YYYYMM text."""
    return F.date_format(F.add_months(F.to_date(col(c), "yyyyMM"), months), "yyyyMM")


def days_between(start, end) -> Column:
    return F.datediff(F.to_date(col(end)), F.to_date(col(start)))


def month_boundaries(start, end) -> Column:
    """Calendar month boundaries crossed, whatever the day of month."""
    start, end = col(start), col(end)
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def fiscal_period(date) -> Column:
    """YYYYQn of a date; the fiscal year starts in November."""
    shifted = F.add_months(F.to_date(col(date)), 2)
    return F.concat(F.year(shifted).cast("string"), F.lit("Q"), F.quarter(shifted).cast("string"))


def fiscal_quarter_label(month) -> Column:
    """Qnyy of a YYYYMM text."""
    shifted = F.add_months(F.to_date(col(month), "yyyyMM"), 2)
    return F.concat(F.lit("Q"), F.quarter(shifted).cast("string"), F.date_format(shifted, "yy"))


def previous_period(period: str) -> str:
    year, quarter = int(period[:4]), int(period[5])
    return f"{year - 1}Q4" if quarter == 1 else f"{year}Q{quarter - 1}"


def previous_period_col(c) -> Column:
    c = col(c)
    year = F.substring(c, 1, 4).cast("int")
    quarter = F.substring(c, 6, 1).cast("int")
    return F.when(quarter == 1, F.concat((year - 1).cast("string"), F.lit("Q4"))).otherwise(
        F.concat(year.cast("string"), F.lit("Q"), (quarter - 1).cast("string"))
    )


def last_full_week(today) -> tuple[Column, Column]:
    """Saturday and Friday that bound the last complete week before the day given."""
    today = F.to_date(today if isinstance(today, Column) else F.lit(today))
    weekday = F.dayofweek(today)
    return F.date_add(today, -7 - weekday), F.date_add(today, -1 - weekday)
