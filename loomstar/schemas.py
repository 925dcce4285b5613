"""Explicit schemas of the raw sources, the star and the query-first tables.

Ids are 64-bit throughout so that they hold at any scale.
"""

from pyspark.sql.types import (
    DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)

_STR, _INT, _LONG, _DBL, _FLT = StringType(), IntegerType(), LongType(), DoubleType(), FloatType()
_TS = TimestampNTZType()


def _schema(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


# Field names and order of the raw records.
SONG = _schema(
    num_songs=_INT, artist_id=_STR, artist_latitude=_DBL, artist_longitude=_DBL,
    artist_location=_STR, artist_name=_STR, song_id=_STR, title=_STR, duration=_DBL, year=_INT,
)
EVENT = _schema(
    artist=_STR, auth=_STR, firstName=_STR, gender=_STR, itemInSession=_INT, lastName=_STR,
    length=_DBL, level=_STR, location=_STR, method=_STR, page=_STR, registration=_DBL,
    sessionId=_LONG, song=_STR, status=_INT, ts=_LONG, userAgent=_STR, userId=_STR,
)
# The CSV export has no userAgent, and its ts and registration are rounded
# decimals such as 1.54111E+12, so they are read as doubles.
EVENT_CSV = _schema(
    artist=_STR, auth=_STR, firstName=_STR, gender=_STR, itemInSession=_INT, lastName=_STR,
    length=_DBL, level=_STR, location=_STR, method=_STR, page=_STR, registration=_DBL,
    sessionId=_LONG, song=_STR, status=_INT, ts=_DBL, userId=_STR,
)
PLAY11 = _schema(
    artist=_STR, firstName=_STR, gender=_STR, itemInSession=_INT, lastName=_STR, length=_DBL,
    level=_STR, location=_STR, sessionId=_LONG, song=_STR, userId=_STR,
)

# The star.
USERS = _schema(user_id=_LONG, first_name=_STR, last_name=_STR, gender=_STR, level=_STR)
SONGS = _schema(song_id=_STR, title=_STR, artist_id=_STR, year=_INT, duration=_DBL)
ARTISTS = _schema(artist_id=_STR, name=_STR, location=_STR, latitude=_DBL, longitude=_DBL)
TIME = _schema(
    start_time=_TS, hour=_INT, day=_INT, week=_INT, month=_INT, year=_INT, weekday=_STR,
)
SONGPLAYS = _schema(
    songplay_id=_STR, start_time=_TS, user_id=_LONG, level=_STR, song_id=_STR, artist_id=_STR,
    session_id=_LONG, location=_STR, user_agent=_STR,
)
STAR = {"users": USERS, "songs": SONGS, "artists": ARTISTS, "time": TIME, "songplays": SONGPLAYS}
STAR_KEYS = {
    "users": ["user_id"], "songs": ["song_id"], "artists": ["artist_id"],
    "time": ["start_time"], "songplays": ["songplay_id"],
}

# The query-first tables.
SONG_DATA_BY_SESSION = _schema(
    session_id=_LONG, item_in_session=_INT, artist_name=_STR, song_title=_STR, length=_FLT,
)
SONG_DATA_BY_USER_AND_SESSION = _schema(
    user_id=_LONG, session_id=_LONG, item_in_session=_INT, artist_name=_STR, song_title=_STR,
    user_first_name=_STR, user_last_name=_STR,
)
USER_DATA_BY_SONG = _schema(
    song_title=_STR, user_id=_LONG, user_first_name=_STR, user_last_name=_STR,
)
