"""Star-schema reports.

Each report first counts the fact per foreign key, which combines before the
shuffle, and only then joins the dimensions.  The join sees one row per key
instead of every play, so a hot artist or user costs no more than any other,
and a key that repeats in its dimension counts once per repeat, as it would if
joined first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def star_counts(
    fact: DataFrame,
    dims: Sequence[tuple[DataFrame, str]],
    by: Sequence[str],
    alias: str,
    counted: str = "*",
) -> DataFrame:
    """Count fact rows by dimension attributes, over inner joins on each key."""
    counts = fact.groupBy(*[key for _, key in dims]).agg(F.count(counted).alias("_n"))
    for dim, key in dims:
        wanted = [c for c in by if c in dim.columns and c not in counts.columns]
        counts = counts.join(dim.select(key, *wanted), key)
    return counts.groupBy(*by).agg(F.sum("_n").alias(alias))


def day_counts(fact: DataFrame, keys: Sequence[str], day: str = "event_date") -> DataFrame:
    """Plays by day and foreign keys: `n_rows`, and `n_plays` that have an id.

    Counts of days add up, so a report over any days needs these rows and not the fact.
    """
    return fact.groupBy(day, *keys).agg(F.count("*").alias("n_rows"), F.count("songplay_id").alias("n_plays"))


def counts_by(
    counts: DataFrame, dims: Sequence[tuple[DataFrame, str]], by: Sequence[str], alias: str, counted: str = "n_plays"
) -> DataFrame:
    """`star_counts` from the rows of `day_counts` instead of the fact."""
    keys = [key for _, key in dims]
    total = counts.groupBy(*keys).agg(F.sum(counted).alias("_n")).where("_n > 0")
    for dim, key in dims:
        wanted = [c for c in by if c in dim.columns and c not in total.columns]
        total = total.join(dim.select(key, *wanted), key)
    return total.groupBy(*by).agg(F.sum("_n").alias(alias))


def order_by_count(df: DataFrame, count: str) -> DataFrame:
    """Most frequent first, ties by the remaining columns."""
    return df.orderBy(F.desc(count), *[c for c in df.columns if c != count])


def top_k(df: DataFrame, count: str, k: int = 10) -> DataFrame:
    return order_by_count(df, count).limit(k)


def top_artists_all(fact: DataFrame, artists: DataFrame) -> DataFrame:
    """Plays by artist name, all of them, most played first."""
    named = artists.select("artist_id", F.col("name").alias("artist_name"))
    counts = star_counts(fact, [(named, "artist_id")], ["artist_name"], "number_of_plays")
    return order_by_count(counts, "number_of_plays")


def plays_by_weekday_hour(fact: DataFrame, time: DataFrame) -> DataFrame:
    """Plays by weekday and hour, most frequent first."""
    counts = star_counts(fact, [(time, "start_time")], ["weekday", "hour"], "number_of_plays")
    return order_by_count(counts, "number_of_plays")


def top_users(fact: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    by = ["user_id", "first_name", "last_name"]
    counts = star_counts(fact, [(users, "user_id")], by, "songplay_count", "songplay_id")
    return top_k(counts, "songplay_count", k)


def top_artists(fact: DataFrame, artists: DataFrame, k: int = 10) -> DataFrame:
    counts = star_counts(
        fact, [(artists, "artist_id")], ["name"], "songplay_count", "songplay_id"
    )
    return top_k(counts, "songplay_count", k)


def top_songs(fact: DataFrame, artists: DataFrame, songs: DataFrame, k: int = 10) -> DataFrame:
    """The most played (artist, title) pairs, over a three-way star join."""
    dims = [(artists.select("artist_id", "name"), "artist_id"), (songs.select("song_id", "title"), "song_id")]
    counts = star_counts(fact, dims, ["name", "title"], "songplay_count", "songplay_id")
    return top_k(counts, "songplay_count", k)
