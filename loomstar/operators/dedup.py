"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pick_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], keep: str = "first"
) -> DataFrame:
    """The first or last row of each key in the order of `order_by`.

    Ties fall to the remaining columns, so the choice never depends on which
    task ran first or ran twice.  min/max of a struct combines before the
    shuffle: a map task sends one row per key, however hot the key is.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    ranked = F.struct(*[c for c in order_by if c not in keys], *rest)
    choose = F.min if keep == "first" else F.max
    return df.groupBy(*keys).agg(choose(ranked).alias("_row")).select(
        *[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )
