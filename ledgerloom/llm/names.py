"""Column names for what operators add on the way."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as it takes for it to be new."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def columns(df: DataFrame) -> list[Column]:
    """The columns as they are, whatever their names contain."""
    return [F.col(f"`{c}`") for c in df.columns]
