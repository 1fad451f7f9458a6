"""Latest day, month and year of a transaction table."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schema import UNDATED
from ledgerloom.sinks import generations, paths

GRAINS = ("day", "month", "year")


def latest_bounds_frame(df: DataFrame) -> DataFrame:
    """One row: the latest ``ds`` and the first day of its month and year.

    Only the partition column is read, so on a stored table this opens every file for
    its row count. ``LatestBounds.of_lake`` opens none.
    """
    return df.agg(F.max("ds").cast("date").alias("latest_day")).select(
        "latest_day",
        F.trunc("latest_day", "MM").alias("month_start"),
        F.trunc("latest_day", "YEAR").alias("year_start"),
    )


@dataclass(frozen=True)
class LatestBounds:
    """Start of each grain. Nothing is later than ``day``, so a start is enough
    to say which rows belong; ``None`` stands for an empty table."""

    day: date | None
    month: date | None
    year: date | None

    @classmethod
    def of(cls, df: DataFrame) -> "LatestBounds":
        (row,) = latest_bounds_frame(df).collect()
        return cls(*row)

    @classmethod
    def of_lake(cls, spark: SparkSession, lake: str) -> "LatestBounds":
        """From the names of the partition folders, newest first until one has a file that counts."""
        folders = paths.matching(spark, f"{lake}/outcome=clean/ds=*")
        days = sorted({f.rsplit("ds=", 1)[1] for f in folders} - {UNDATED}, reverse=True)
        known = generations.committed(spark, lake)

        def has_rows(day: str) -> bool:
            files = paths.matching(spark, f"{lake}/outcome=clean/ds={day}/*/*.parquet")
            batches = {f.split("/")[-2].removeprefix("batch=") for f in files}
            return any(known.counts(("clean", day), batch) for batch in batches)

        day = next(filter(has_rows, days), None)
        if day is None:
            return cls(None, None, None)
        day = date.fromisoformat(day)
        return cls(day, day.replace(day=1), day.replace(month=1, day=1))

    def contains(self, grain: str) -> Column:
        """Range filter on ``ds``; literal bounds, so partitions are pruned."""
        start = getattr(self, grain)
        if start is None:
            return F.lit(False)
        return F.col("ds").between(F.lit(start), F.lit(self.day))

    def grains_of_row(self, grains: tuple[str, ...] = GRAINS) -> Column:
        """The grains a row belongs to, as an array to explode."""
        return F.array_compact(
            F.array(*[F.when(self.contains(grain), F.lit(grain)) for grain in grains])
        )
