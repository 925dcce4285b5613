"""Query-first tables and the lookups they answer.

Writing a later row over an earlier one of the same key is `pick_per_key` with
keep="last".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstar.operators.dimensions import dimension

PLAY_ORDER = ("sessionId", "itemInSession")


def _user_id() -> Column:
    return F.col("userId").try_cast("bigint")


def song_data_by_session(plays: DataFrame, order_by: Sequence[str] = PLAY_ORDER) -> DataFrame:
    columns = {
        "session_id": "sessionId",
        "item_in_session": "itemInSession",
        "artist_name": "artist",
        "song_title": "song",
        "length": F.col("length").cast("float"),
    }
    return dimension(plays, columns, ["session_id", "item_in_session"], "last", order_by)


def song_data_by_user_and_session(
    plays: DataFrame, order_by: Sequence[str] = PLAY_ORDER
) -> DataFrame:
    columns = {
        "user_id": _user_id(),
        "session_id": "sessionId",
        "item_in_session": "itemInSession",
        "artist_name": "artist",
        "song_title": "song",
        "user_first_name": "firstName",
        "user_last_name": "lastName",
    }
    keys = ["user_id", "session_id", "item_in_session"]
    return dimension(plays, columns, keys, "last", order_by)


def user_data_by_song(plays: DataFrame, order_by: Sequence[str] = PLAY_ORDER) -> DataFrame:
    columns = {
        "song_title": "song",
        "user_id": _user_id(),
        "user_first_name": "firstName",
        "user_last_name": "lastName",
    }
    return dimension(plays, columns, ["song_title", "user_id"], "last", order_by)


def q_session_item(table: DataFrame, session_id: int, item_in_session: int) -> DataFrame:
    """What was heard as one item of one session."""
    return table.filter(
        (F.col("session_id") == session_id) & (F.col("item_in_session") == item_in_session)
    ).select("artist_name", "song_title", "length")


def q_user_session(table: DataFrame, user_id: int, session_id: int) -> DataFrame:
    """What a user heard in a session, in the order heard."""
    return (
        table.filter((F.col("user_id") == user_id) & (F.col("session_id") == session_id))
        .orderBy("item_in_session")
        .select("artist_name", "song_title", "user_first_name", "user_last_name")
    )


def q_users_by_song(table: DataFrame, song_title: str) -> DataFrame:
    """Every user who heard a song."""
    return (
        table.filter(F.col("song_title") == song_title)
        .orderBy("user_id")
        .select("user_first_name", "user_last_name")
    )
