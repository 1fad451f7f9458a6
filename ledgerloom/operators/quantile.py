"""Quantile of a whole-number column (A10), exact or approximate."""

from dataclasses import dataclass
from fractions import Fraction

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: Equal slices counted per step once the range is narrow.
SLICES = 4096
#: Slices per doubling in the first step: 128 * 63 over all 64-bit values.
SLICES_PER_DOUBLING = 64


def approximate_quantile(df: DataFrame, column: str, p: float, error: float = 0.01) -> DataFrame:
    """One row, one pass: a value whose rank is within ``error`` of ``p``."""
    accuracy = max(1, round(1 / error))
    return df.agg(F.percentile_approx(column, p, accuracy).alias("threshold"))


def exact_quantile(df: DataFrame, column: str, p: float) -> int | None:
    """The smallest value with at least a share ``p`` of the rows at or below it.

    Sorting or collecting the values would put them into one task. Instead the
    rows are counted per slice of the value range, on a scale that needs no
    minimum or maximum, and the slice with the wanted rank is narrowed down to
    one value. The table is scanned twice, each time for this column alone; what
    is shuffled is one count per task and slice, then one per task and distinct
    value of a slice about 1% wide. A value that fills a third of the table is
    one count like any other.
    """
    values = df.select(F.col(column).cast("bigint").alias("v"))
    slices = _counted(values, logarithmic(F.col("v")), F.count("v"))
    found = slice_at(slices, p)
    if found is None or found.low == found.high:
        return found and found.low
    inside = values.where(F.col("v").between(found.low, found.high))
    return value_in(inside.groupBy("v").agg(F.count("*").alias("n")), found)


@dataclass(frozen=True)
class Slice:
    """The slice of values that holds a rank."""

    low: int
    high: int
    below: int
    rank: int


def slice_at(slices: list[Row], p: float) -> Slice | None:
    """The slice that holds the quantile, out of (slice, n, low, high) in value order; None without values."""
    total = sum(piece.n for piece in slices)
    if not total:
        return None
    rank = _wanted_rank(p, total)
    return Slice(*_slice_of(slices, rank, 0), rank)


def value_in(counts: DataFrame, found: Slice) -> int:
    """The value of the slice's rank, from (v, n): its values and how often each occurs."""
    low, high, below, rank = found.low, found.high, found.below, found.rank
    counts = counts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        while low < high:
            width = -(-(high - low + 1) // SLICES)
            inside = counts.where(F.col("v").between(low, high))
            number = F.expr(f"(CAST(v AS DECIMAL(20,0)) - {low}) DIV {width}")
            low, high, below = _slice_of(_counted(inside, number, F.sum("n")), rank, below)
        return low
    finally:
        counts.unpersist()


def logarithmic(value: Column) -> Column:
    """Slice number growing with the value, fine around every magnitude."""
    x = value.cast("double")
    return F.floor(F.signum(x) * F.log2(F.abs(x) + 1) * SLICES_PER_DOUBLING)


def _counted(values: DataFrame, number: Column, count: Column) -> list[Row]:
    """Rows per slice with the slice's least and greatest value, in value order;
    as many as there are slices, whatever the size of the table."""
    rows = (
        values.groupBy(number.alias("slice"))
        .agg(count.alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .where("slice IS NOT NULL")
        .collect()
    )
    return sorted(rows, key=lambda row: row.slice)


def _slice_of(slices: list[Row], rank: int, below: int) -> tuple[int, int, int]:
    """Bounds of the slice holding ``rank``, and how many rows lie below it."""
    for piece in slices:
        if below + piece.n >= rank:
            return piece.low, piece.high, below
        below += piece.n
    raise ValueError(f"rank {rank} beyond {below} rows")


def _wanted_rank(p: float, total: int) -> int:
    """ceil(p * total), without the error of multiplying a large count by a float."""
    share = Fraction(str(p)) * total
    return max(1, -(-share.numerator // share.denominator))
