"""Column expressions for cleaning and reporting.

All are built-in functions, so they stay inside generated code. Bad input gives
NULL rather than an error, whatever ``spark.sql.ansi.enabled`` says.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_money(text: Column) -> Column:
    """``$134.09`` -> 134.09; a sign after the symbol is kept. Wide enough for any
    amount, so that one too large for the table is told from one that is no number."""
    return F.regexp_replace(text, r"\$", "").try_cast("decimal(38,2)")


def parse_int(text: Column) -> Column:
    """C4: whole number, a fraction part being cut off."""
    return F.regexp_replace(text, r"\.\d*\s*$", "").try_cast("int")


def parse_date(day: Column, month: Column, year: Column) -> Column:
    """A date out of three integers; NULL if one is missing or impossible."""
    midnight = [F.lit(0)] * 3
    moment = F.try_make_timestamp_ntz(year, month, day, *midnight)
    return F.when(year.between(1000, 9999), moment.cast("date"))


def complete_time(text: Column) -> Column:
    """``HH:MM`` -> ``HH:MM:00``."""
    return F.concat(text, F.lit(":00"))


def to_vnd(amount_usd: Column, rate: Column) -> Column:
    """Whole dong, halves away from zero."""
    return F.round(amount_usd * rate).try_cast("bigint")


def hour_of_day(time: Column) -> Column:
    """C11: hour of a time of day, read without a time zone and on a fixed date,
    so neither the session zone nor a clock change today can shift it."""
    moment = F.concat(F.lit("1970-01-01 "), time).try_cast("timestamp_ntz")
    return F.when(F.contains(time, F.lit(":")), F.hour(moment))


def day_type(date: Column) -> Column:
    """Saturday and Sunday are the weekend; a NULL date is a weekday."""
    return F.when(F.dayofweek(date).isin(1, 7), "Weekend").otherwise("Weekday")


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, two decimals."""
    return F.round(F.try_divide(part, whole) * 100, 2)

