"""Row filters and plain projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.schemas import PLAY11


def plays(events: DataFrame, page: str = "NextSong") -> DataFrame:
    """Only the events in which a song was played."""
    return events.filter(F.col("page") == page)


def non_empty(df: DataFrame, column: str) -> DataFrame:
    """Only rows whose `column` is neither null nor ''."""
    return df.filter(F.col(column) != "")


def project_play11(df: DataFrame) -> DataFrame:
    """The 11 columns of the merged play file, in its order."""
    return df.select(*PLAY11.fieldNames())


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """The first `n` rows in a stated order."""
    return df.orderBy(*order_by).limit(n)
