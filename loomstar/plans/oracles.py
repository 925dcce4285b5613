"""The registered queries as plain SQL over the given tables."""

from __future__ import annotations

from loomstar.plans.queries import RUN_DATE, TABLES

_LOG = """log AS (
  SELECT
    CASE l_returnflag
      WHEN 'R' THEN CASE l_linestatus WHEN 'F' THEN upper(p_brand) ELSE p_brand END
      WHEN 'A' THEN '' END AS artist,
    'Logged In' AS auth,
    c_mktsegment AS "firstName",
    o_orderstatus AS gender,
    l_linenumber AS "itemInSession",
    c_name AS "lastName",
    CASE l_returnflag WHEN 'R' THEN p_size + l_discount END AS length,
    o_orderpriority AS level,
    l_linestatus AS location,
    'PUT' AS method,
    l_returnflag AS page,
    o_totalprice AS registration,
    l_orderkey AS "sessionId",
    CASE l_returnflag
      WHEN 'R' THEN 'Track ' || CAST(p_partkey // 8 AS VARCHAR)
      WHEN 'A' THEN '' END AS song,
    200 AS status,
    epoch_ms(l_shipdate) + l_linenumber * 3600000 + l_suppkey AS ts,
    '"agent ' || p_brand || '"' AS "userAgent",
    CAST(o_custkey AS VARCHAR) AS "userId"
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
)"""
_PLAYS = """plays AS (
  SELECT *, CAST("userId" AS BIGINT) AS user_id,
    make_timestamp(ts * 1000) AS at_ms, make_timestamp(ts // 1000 * 1000000) AS at_s
  FROM log WHERE page = 'R'
)"""
_SONG = """song AS (
  SELECT 1 AS num_songs, replace(p_brand, 'Brand#', 'AR') AS artist_id,
    CAST(CASE WHEN p_type <> 'PROMO' THEN length(p_type) * 7.25 END AS DOUBLE) AS artist_latitude,
    CAST(NULL AS DOUBLE) AS artist_longitude,
    p_type AS artist_location, p_brand AS artist_name,
    'S' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS song_id,
    'Track ' || CAST(p_partkey // 8 AS VARCHAR) AS title,
    CAST(p_size AS DOUBLE) AS duration,
    CAST(length(p_type) + 1990 AS INTEGER) AS year
  FROM part
)"""
_STREAM = """stream AS (
  SELECT 'Brand#' || json_extract_string(props, '$.k') AS artist,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS "itemInSession",
    value AS length,
    CASE WHEN value < 50 THEN 'free' ELSE 'paid' END AS level,
    event_type AS page,
    event_id AS "sessionId",
    'Track ' || json_extract_string(props, '$.k') AS song,
    epoch_us(ts) // 1000 AS ts,
    CAST(user_id AS VARCHAR) AS "userId"
  FROM events
)"""
_STREAM_PLAYS = """plays AS (
  SELECT *, CAST("userId" AS BIGINT) AS user_id, CAST(NULL AS VARCHAR) AS first_name,
    CAST(NULL AS VARCHAR) AS last_name, 'X' AS gender, CAST(NULL AS VARCHAR) AS location,
    CAST(NULL AS VARCHAR) AS "userAgent", make_timestamp(ts // 1000 * 1000000) AS at_s
  FROM stream WHERE page = 'purchase'
)"""
_ARTISTS = """artists AS (
  SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location,
    artist_latitude AS latitude, artist_longitude AS longitude FROM song
)"""
_ARTISTS_FIRST = """artists_first AS (
  SELECT artist_id, artist_name AS name, artist_location AS location,
    artist_latitude AS latitude, artist_longitude AS longitude
  FROM song QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY song_id) = 1
)"""
_SONGS_TWICE = """songs_twice AS (
  SELECT * FROM song UNION ALL
  SELECT * REPLACE (regexp_replace(song_id, '^S', 'R') AS song_id) FROM song WHERE song_id LIKE '%3'
)"""
_SONG_ONE = """song_one AS (
  SELECT * FROM songs_twice
  QUALIFY row_number() OVER (PARTITION BY title, artist_name, duration ORDER BY song_id) = 1
)"""
# The inner fact on two keys, under its md5 key.
_FACT = """fact AS (
  SELECT md5(CAST("sessionId" AS VARCHAR) || CAST(at_s AS VARCHAR)) AS songplay_id,
    at_s AS start_time, user_id, level, song_id, artist_id, "sessionId" AS session_id
  FROM plays JOIN song ON song = title AND artist = artist_name
)"""
# What a user row is, with the log's order for first and last.
_USER_COLUMNS = 'user_id, "firstName" AS first_name, "lastName" AS last_name, gender, level'
_USERS_FIRST = f"""users_first AS (
  SELECT {_USER_COLUMNS} FROM plays
  QUALIFY row_number() OVER (PARTITION BY user_id
    ORDER BY ts, "sessionId", "itemInSession", "firstName", "lastName", gender, level) = 1
)"""

_PLAY11 = """artist, "firstName", gender, "itemInSession", "lastName", length, level, location,
  "sessionId", song, "userId\""""
_EVENT_CSV = """artist, auth, "firstName", gender, "itemInSession", "lastName", length, level,
  location, method, page, registration, "sessionId", song, status, CAST(ts AS DOUBLE) AS ts, "userId\""""
_EVENT_NAMELESS = """artist, auth, CAST(NULL AS VARCHAR) AS "firstName", gender, "itemInSession",
  CAST(NULL AS VARCHAR) AS "lastName", length, level, location, method, page, registration,
  "sessionId", song, status, ts, "userAgent", "userId\""""
_LINE_REST = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
)
_LINE_REST_DESC = ", ".join(f"{c} DESC" for c in _LINE_REST.split(", "))


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _parts(start: str, weekday: str) -> str:
    return f"""CAST(hour({start}) AS INTEGER) AS hour, CAST(day({start}) AS INTEGER) AS day,
  CAST(week({start}) AS INTEGER) AS week, CAST(month({start}) AS INTEGER) AS month,
  CAST(year({start}) AS INTEGER) AS year, {weekday} AS weekday"""


def _full(start: str) -> str:
    return f"dayname({start})"


def _short(start: str) -> str:
    return f"strftime({start}, '%a')"


def _number(start: str) -> str:
    return f"CAST(dayofweek({start}) AS INTEGER)"


def _time(start: str, source: str, weekday: str, distinct: bool = True) -> str:
    starts = f"SELECT {'DISTINCT' if distinct else ''} {start} AS start_time FROM {source}"
    return f"SELECT start_time, {_parts('start_time', weekday)} FROM ({starts})"


def _fact(start: str, extra: str = "") -> str:
    return f"""{extra}{start} AS start_time, user_id, level, song_id, artist_id,
  "sessionId" AS session_id, location, "userAgent" AS user_agent"""


_MD5 = 'md5(CAST("sessionId" AS VARCHAR) || CAST(at_s AS VARCHAR)) AS songplay_id, '
_ON2 = "ON song = title AND artist = artist_name"
_ON3 = f"{_ON2} AND length = duration"
_ON3_WHOLE = f"{_ON2} AND trunc(length) = trunc(duration)"
_BASE = (_LOG, _PLAYS, _SONG)

_UPSERTED = f"""SELECT * FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY CASE l_linestatus WHEN 'F' THEN 1 ELSE 0 END DESC, l_shipdate DESC, {_LINE_REST_DESC}) = 1"""
_INSERTED = f"""SELECT * FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY CASE l_linestatus WHEN 'O' THEN 0 ELSE 1 END, l_shipdate, {_LINE_REST}) = 1"""


def _last(columns: str, keys: str, ties: str = "") -> str:
    ties = "".join(f", {c} DESC" for c in ties.split(", ") if c)
    return f"""SELECT {columns} FROM plays QUALIFY row_number() OVER (
  PARTITION BY {keys} ORDER BY "sessionId" DESC, "itemInSession" DESC{ties}) = 1"""


# The day whose file holds an event: one in ten comes a day late.
_FILED = """CAST(CAST(make_timestamp(ts * 1000) AS DATE) + CASE WHEN "sessionId" % 10 = 0 THEN 1 ELSE 0 END AS DATE)"""
_SONGS_ONCE = """songs_once AS (
  SELECT * FROM song
  QUALIFY row_number() OVER (PARTITION BY title, artist_name, duration ORDER BY song_id) = 1
)"""
_BY_SESSION = _last(
    """"sessionId" AS session_id, "itemInSession" AS item_in_session, artist AS artist_name,
  song AS song_title, round(CAST(CAST(length AS FLOAT) AS DOUBLE), 2) AS length""",
    '"sessionId", "itemInSession"', "artist, song, CAST(length AS FLOAT)",
)
_BY_USER_SESSION = _last(
    """user_id, "sessionId" AS session_id, "itemInSession" AS item_in_session,
  artist AS artist_name, song AS song_title, "firstName" AS user_first_name,
  "lastName" AS user_last_name""",
    'user_id, "sessionId", "itemInSession"', 'artist, song, "firstName", "lastName"',
)
_BY_SONG = _last(
    'song AS song_title, user_id, "firstName" AS user_first_name, "lastName" AS user_last_name',
    "song, user_id", '"firstName", "lastName"',
)
# The log, and its closed plays logged again later under another title.
_PLAYS_TWICE = """log_once AS (
  SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY "sessionId", "itemInSession"
    ORDER BY ts, artist NULLS FIRST, length NULLS FIRST, song NULLS FIRST) = 1
),
both_files AS (
  SELECT *, 0 AS file FROM log_once UNION ALL
  SELECT * REPLACE (song || chr(10) || '(live)' AS song), 1 AS file FROM log_once WHERE location = 'F'
),
heard AS (SELECT *, CAST("userId" AS BIGINT) AS user_id FROM both_files WHERE artist <> '')"""


def _later(table_name: str, columns: dict[str, str], keys: str) -> str:
    every = "session_id item_in_session user_id artist_name song_title length user_first_name user_last_name".split()
    cells = ", ".join(f"{columns.get(c, 'NULL')} AS {c}" for c in every)
    return f"""SELECT '{table_name}' AS table_name, {cells} FROM heard
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY file DESC) = 1"""


_WIDE_COLUMNS = {
    "session_id": '"sessionId"', "item_in_session": '"itemInSession"', "artist_name": "artist", "song_title": "song",
}
_WIDE_NAMES = {"user_id": "user_id", "user_first_name": '"firstName"', "user_last_name": '"lastName"'}
_WIDE = "\nUNION ALL ".join([
    _later(
        "song_data_by_session",
        {**_WIDE_COLUMNS, "length": "round(CAST(CAST(length AS FLOAT) AS DOUBLE), 2)"},
        '"sessionId", "itemInSession"',
    ),
    _later(
        "song_data_by_user_and_session", {**_WIDE_COLUMNS, **_WIDE_NAMES},
        'user_id, "sessionId", "itemInSession"',
    ),
    _later("user_data_by_song", {"song_title": "song", **_WIDE_NAMES}, "song, user_id"),
])
_LEFT_ONE = _with(*_BASE, _SONGS_TWICE, _SONG_ONE) + f"SELECT {_fact('at_ms')} FROM plays LEFT JOIN song_one {_ON3}"
_INNER_LAKE = (
    f"SELECT {_fact('at_s')} FROM plays JOIN (SELECT s.song_id, s.artist_id, title, name AS artist_name "
    f"FROM song s JOIN artists a ON s.artist_id = a.artist_id) {_ON2}"
)
_TOP_SONGS = """SELECT a.name, s.title, count({counted}) AS songplay_count
FROM fact f JOIN {artists} a ON a.artist_id = f.artist_id JOIN song s ON s.song_id = f.song_id
GROUP BY a.name, s.title ORDER BY songplay_count DESC, a.name, s.title LIMIT 10"""
_USER_REPORT = """SELECT u.user_id, u.first_name, u.last_name, count(f.songplay_id) AS songplay_count
FROM fact f JOIN {users} u ON u.user_id = f.user_id
GROUP BY u.user_id, u.first_name, u.last_name
ORDER BY songplay_count DESC, u.user_id, u.first_name, u.last_name LIMIT 10"""
_SONGS_SELECT = "SELECT song_id, title, artist_id, year, duration FROM song"
_ARTISTS_SELECT = "SELECT artist_id, name, location, latitude, longitude FROM"
_DISTINCT_FACT = f"SELECT DISTINCT {_fact('at_ms')} FROM plays JOIN song {_ON2}"
_DAILY = f"SELECT {_fact('at_s', _MD5)} FROM plays LEFT JOIN song {_ON3_WHOLE}"


def _count(name: str, source: str) -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"


ORACLES: dict[str, str] = {
    "plays_filter": "SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'",
    "non_empty_filter": _with(_LOG)
    + 'SELECT "sessionId", "itemInSession", artist, song FROM log WHERE artist <> \'\'',
    "project_rename": _with(_LOG) + f"SELECT {_PLAY11} FROM log WHERE page = 'R'",
    "preview": "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_custkey LIMIT 5",
    "numeric_casts": _with(_LOG)
    + """SELECT TRY_CAST(CASE "itemInSession" WHEN 1 THEN '' WHEN 2 THEN 'no ' || "userId" ELSE "userId" END AS BIGINT)
    AS user_id, level, CAST(NULL AS VARCHAR) AS gender,
  count(*) AS n, count(DISTINCT "userId") AS n_names FROM log GROUP BY 1, 2""",
    "missing_values": _with(_LOG)
    + """SELECT page, count(*) AS n, count(nullif(artist, '')) AS n_artist,
  count(length) AS n_length FROM log GROUP BY page""",
    "users_dim_distinct": _with(_LOG, _PLAYS) + f"SELECT DISTINCT {_USER_COLUMNS} FROM plays",
    "users_dim_first": _with(_LOG, _PLAYS, _USERS_FIRST) + "SELECT * FROM users_first",
    "users_dim_last": _with(_LOG, _PLAYS)
    + f"""SELECT {_USER_COLUMNS} FROM plays QUALIFY row_number() OVER (PARTITION BY user_id
  ORDER BY ts DESC, "sessionId" DESC, "itemInSession" DESC, "firstName" DESC, "lastName" DESC,
    gender DESC, level DESC) = 1""",
    "songs_dim": _with(_SONG) + _SONGS_SELECT.replace("SELECT", "SELECT DISTINCT", 1),
    "artists_dim": _with(_SONG, _ARTISTS) + f"{_ARTISTS_SELECT} artists",
    "artists_dim_first": _with(_SONG, _ARTISTS_FIRST) + f"{_ARTISTS_SELECT} artists_first",
    "time_dim_fullname": _with(_LOG, _PLAYS) + _time("at_ms", "plays", _full("start_time")),
    "time_dim_short": _with(_LOG, _PLAYS) + _time("at_s", "plays", _short("start_time")),
    "time_dim_sunday0": _with(_LOG, _PLAYS) + _time("at_ms", "plays", _number("start_time")),
    "time_dim_seconds": _with(_STREAM)
    + _time(
        "make_timestamp(ts // 1000 * 1000000)", "stream WHERE page = 'purchase'", _full("start_time")
    ),
    "time_scalars": f"""SELECT event_id, at_ms,
  date_trunc('second', at_ms) AS at_s, {_parts('at_ms', _full('at_ms'))},
  {_short('at_ms')} AS weekday_short, {_number('at_ms')} AS weekday_number
FROM (SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS at_ms FROM events)""",
    "time_from_fact_dups": _with(*_BASE, _FACT)
    + _time("start_time", "fact", _number("start_time"), distinct=False),
    "catalogue_join": _with(_SONG, _ARTISTS)
    + """SELECT s.song_id, s.artist_id, s.title, a.name AS artist_name, s.duration
FROM (SELECT DISTINCT song_id, title, artist_id, year, duration FROM song) s
JOIN artists a ON s.artist_id = a.artist_id""",
    "fact_left_one": _LEFT_ONE,
    "fact_left_one_split": _LEFT_ONE,
    "fact_inner_distinct": _with(*_BASE) + _DISTINCT_FACT,
    "fact_inner": _with(*_BASE, _ARTISTS) + _INNER_LAKE,
    "fact_inner_bucketed": _with(*_BASE, _ARTISTS) + _INNER_LAKE,
    "fact_left_fanout": _with(*_BASE, _SONGS_TWICE)
    + f"SELECT {_fact('at_s')} FROM plays LEFT JOIN songs_twice {_ON3}",
    "fact_left_truncated": _with(*_BASE)
    + f"SELECT {_fact('at_s')} FROM plays LEFT JOIN song {_ON3_WHOLE}",
    "fact_md5_key": _with(*_BASE) + _DAILY,
    "fact_partition_cols": _with(*_BASE)
    + f"""SELECT {_fact('at_s')}, CAST(year(at_s) AS INTEGER) AS year,
  CAST(month(at_s) AS INTEGER) AS month FROM plays JOIN song {_ON2}""",
    "surrogate_id": _with(*_BASE, _FACT) + "SELECT count(*) AS n_rows, count(*) AS n_ids FROM fact",
    "dense_id": _with(*_BASE, _FACT)
    + "SELECT count(*) AS n_ids, CAST(1 AS BIGINT) AS first_id, count(*) AS last_id FROM fact",
    "top_artists_all": _with(*_BASE, _FACT, _ARTISTS_FIRST)
    + """SELECT a.name AS artist_name, count(*) AS number_of_plays
FROM fact f JOIN artists_first a ON a.artist_id = f.artist_id GROUP BY a.name""",
    "plays_by_weekday_hour": _with(_LOG, _PLAYS)
    + """SELECT dayname(at_ms) AS weekday, CAST(hour(at_ms) AS INTEGER) AS hour,
  count(*) AS number_of_plays FROM plays GROUP BY 1, 2""",
    "top_users": _with(*_BASE, _FACT, _USERS_FIRST) + _USER_REPORT.format(users="users_first"),
    "top_users_distinct_rows": _with(*_BASE, _FACT)
    + _USER_REPORT.format(users=f"(SELECT DISTINCT {_USER_COLUMNS} FROM plays)"),
    "top_artists": _with(*_BASE, _FACT, _ARTISTS)
    + """SELECT a.name, count(f.songplay_id) AS songplay_count
FROM fact f JOIN artists a ON a.artist_id = f.artist_id
GROUP BY a.name ORDER BY songplay_count DESC, a.name LIMIT 10""",
    "top_songs": _with(*_BASE, _FACT, _ARTISTS_FIRST)
    + _TOP_SONGS.format(counted="f.songplay_id", artists="artists_first"),
    "song_data_by_session": _with(_LOG, _PLAYS) + _BY_SESSION,
    "song_data_by_user_and_session": _with(_LOG, _PLAYS) + _BY_USER_SESSION,
    "user_data_by_song": _with(_LOG, _PLAYS) + _BY_SONG,
    "lookup_session_item": _with(_LOG, _PLAYS)
    + f"SELECT artist_name, song_title, length FROM ({_BY_SESSION}) WHERE session_id = 14 AND item_in_session = 6",
    "lookup_user_session": _with(_LOG, _PLAYS)
    + f"""SELECT artist_name, song_title, user_first_name, user_last_name
FROM ({_BY_USER_SESSION}) WHERE user_id = 1122 AND session_id = 56 ORDER BY item_in_session""",
    "lookup_users_by_song": _with(_LOG, _PLAYS)
    + f"SELECT user_first_name, user_last_name FROM ({_BY_SONG}) WHERE song_title = 'Track 3' ORDER BY user_id",
    "insert_if_absent": _INSERTED,
    "insert_if_absent_by_digest": _INSERTED,
    "upsert_last": _UPSERTED,
    "upsert_compacted": f"""WITH versions AS (SELECT *, 0 AS version FROM lineitem
  UNION ALL SELECT * REPLACE (0.0::DOUBLE AS l_extendedprice), 1 FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT * REPLACE (0.0::DOUBLE AS l_extendedprice), 2 FROM lineitem WHERE l_returnflag = 'A')
SELECT * EXCLUDE (version) FROM versions QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY version DESC, l_shipdate DESC, {_LINE_REST_DESC}) = 1""",
    "upsert_partitions": """SELECT c_custkey, c_name, c_nationkey,
  CASE c_mktsegment WHEN 'BUILDING' THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer""",
    "append_fact": "SELECT * FROM lineitem",
    "overwrite_dim": "SELECT * FROM lineitem WHERE l_linestatus = 'F'",
    "load_dimension_append": _with(_LOG, _PLAYS)
    + f"""SELECT DISTINCT {_USER_COLUMNS} FROM plays
UNION ALL SELECT DISTINCT {_USER_COLUMNS} FROM plays""",
    "insert_by_name": _with(_SONG)
    + "SELECT song_id, title, artist_id, CAST(0 AS INTEGER) AS year, duration FROM song",
    "insert_by_position": _with(_SONG)
    + """SELECT song_id, artist_name AS title, artist_location AS artist_id,
  CAST(duration AS INTEGER) AS year, CAST(year AS DOUBLE) AS duration FROM song""",
    "reset_tables": _with(_LOG, _PLAYS)
    + "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(0 AS BIGINT) AS row_count"
        for t in ("users", "songs", "artists", "time", "songplays")
    )
    + f"\nUNION ALL SELECT 'users_again', count(*) FROM (SELECT DISTINCT {_USER_COLUMNS} FROM plays)",
    "parquet_plain_roundtrip": _with(_SONG, _ARTISTS) + f"{_ARTISTS_SELECT} artists",
    "parquet_partition_roundtrip": _with(_SONG) + _SONGS_SELECT.replace("SELECT", "SELECT DISTINCT", 1),
    "layout_roundtrip": _with(_LOG, _PLAYS) + _BY_USER_SESSION,
    "bucketed_roundtrip": _with(_LOG, _PLAYS) + _BY_USER_SESSION,
    "csv_quoted_roundtrip": _with(_LOG)
    + f"SELECT {_PLAY11.replace('location', '\"userAgent\" AS location')} FROM log WHERE artist <> ''",
    "csv_events_roundtrip": _with(_LOG) + f"SELECT {_EVENT_CSV} FROM log WHERE artist <> ''",
    "json_roundtrip": _with(_LOG) + f"SELECT {_EVENT_NAMELESS} FROM log",
    "json_glob_roundtrip": _with(_LOG) + f"SELECT {_EVENT_NAMELESS} FROM log",
    "json_songs_roundtrip": _with(_SONG) + "SELECT * FROM song",
    "file_census": "SELECT CAST(count(*) AS BIGINT) AS n_records, true AS none_empty FROM lineitem",
    "stage_mapping": _with(_LOG)
    + """SELECT artist, auth, CAST(NULL AS VARCHAR) AS first_name, gender,
  "itemInSession" AS item_in_session, CAST(NULL AS VARCHAR) AS last_name, length, level, location,
  method, page, registration, "sessionId" AS session_id, song, status,
  make_timestamp(ts * 1000) AS ts, "userAgent" AS user_agent, CAST("userId" AS BIGINT) AS user_id
FROM log""",
    "stage_auto": _with(_SONG) + "SELECT * FROM song",
    "union_sources": _with(_LOG, _STREAM)
    + """SELECT page, count(*) AS n, count("userAgent") AS n_agents, count(song) AS n_songs
FROM (SELECT page, "userAgent", song FROM log
  UNION ALL SELECT page, CAST(NULL AS VARCHAR), song FROM stream) GROUP BY page""",
    "date_incremental": _with(_STREAM)
    + f"""SELECT "sessionId", "userId", page, song, artist, length, ts FROM stream
WHERE {_FILED} = DATE '{RUN_DATE}'""",
    "stream_ingest": _with(*_BASE, _SONGS_ONCE)
    + f"""SELECT md5(CAST(session_id AS VARCHAR) || CAST(start_time AS VARCHAR)) AS songplay_id, *,
  CAST(year(start_time) AS INTEGER) AS year, CAST(month(start_time) AS INTEGER) AS month
FROM (SELECT {_fact('at_s').replace('"sessionId" AS', 'CASE WHEN "sessionId" % 50 <> 0 THEN "sessionId" END AS')}
  FROM plays LEFT JOIN songs_once {_ON3})""",
    "rerun_idempotent": _with(_STREAM, _SONG, _STREAM_PLAYS)
    + f"SELECT {_fact('at_s', _MD5)}, {_FILED} AS event_date FROM plays LEFT JOIN song {_ON3}",
    "row_counts": "\nUNION ALL ".join(_count(t, t) for t in TABLES),
    "quality_report": _with(_LOG) + "\nUNION ALL ".join([
        *[f"SELECT '{t}_has_rows' AS test_name, count(*) > 0 AS passed FROM {t}" for t in TABLES],
        """SELECT 'lineitem_key_unique', count(*) = 0 FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
        """SELECT 'order_key_unique', count(*) = 0 FROM (
  SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)""",
        """SELECT 'no_unlabelled_document', count(*) = 0 FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
        "SELECT 'a_free_part_exists', count(*) > 0 FROM part WHERE p_retailprice = 0",
        "SELECT 'quiet_page_has_artist', coalesce(max(artist), '') <> '' FROM log WHERE page = 'N'",
        "SELECT 'blank_page_has_artist', coalesce(max(artist), '') <> '' FROM log WHERE page = 'A'",
        "SELECT 'some_discount_in_sql', count(*) > 0 AND coalesce(max(l_discount), 0) <> 0 FROM lineitem",
        "SELECT 'some_loss_in_sql', count(*) > 0 FROM lineitem WHERE l_extendedprice < 0",
    ]),
    "report_day_counts": _with(_STREAM, _SONG, _STREAM_PLAYS)
    + "\nUNION ALL ".join([
        f"""SELECT '{key}' AS report, CAST({key} AS VARCHAR) AS key, count(*) AS n_rows, count(songplay_id) AS n_plays
FROM (SELECT {_fact('at_s', _MD5)} FROM plays LEFT JOIN song {_ON3}) GROUP BY {key}""" for key in ("artist_id", "user_id")
    ]),
    "star_violations": _with(_LOG)
    + "\nUNION ALL ".join([
        """SELECT 'orders_key_unique' AS test_name, count(*) = 0 AS passed FROM (
  SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)""",
        """SELECT 'lines_key_unique', count(*) = 0 FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)""",
        "SELECT 'lines_required', count(*) = 0 FROM lineitem WHERE l_orderkey IS NULL",
        "SELECT 'log_required', count(*) = 0 FROM log WHERE ts IS NULL OR length IS NULL",
        """SELECT 'lines_o_orderkey_in_orders', count(*) = 0 FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
        """SELECT 'lines_p_partkey_in_parts', count(*) = 0 FROM lineitem
  WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 2 = 0)""",
    ]),
    "pk_violations": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "null_violations": _with(_LOG)
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count(\"{c}\") AS n_nulls FROM log"
        for c in ("artist", "song", "length", "ts", "userId")
    ),
    "fk_violations": """SELECT d.doc_id, count(*) AS n_rows FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY d.doc_id""",
    "star_first_wins": _with(*_BASE, _ARTISTS_FIRST)
    + f"""SELECT {_fact('at_ms')} FROM plays LEFT JOIN (
  SELECT s.song_id, s.artist_id, title, name AS artist_name, duration
  FROM song s JOIN artists_first a ON s.artist_id = a.artist_id
  QUALIFY row_number() OVER (PARTITION BY title, name, duration ORDER BY song_id) = 1) {_ON3}""",
    "star_first_wins_rerun": _with(_LOG, _PLAYS)
    + "\nUNION ALL ".join([
        _count("songs", "part"),
        _count("artists", "(SELECT DISTINCT p_brand FROM part)"),
        _count("users", "(SELECT DISTINCT user_id FROM plays)"),
        _count("time", "(SELECT DISTINCT at_ms FROM plays)"),
        "SELECT 'songplays' AS table_name, 2 * count(*) AS row_count FROM plays",
        "SELECT 'repeated_ids' AS table_name, CAST(0 AS BIGINT) AS row_count",
    ]),
    "star_distinct": _with(*_BASE, _ARTISTS, f"fact AS ({_DISTINCT_FACT})")
    + _TOP_SONGS.format(counted="*", artists="artists"),
    "star_lake": _with(*_BASE, _ARTISTS)
    + f"""SELECT *, CAST(year(start_time) AS INTEGER) AS year,
  CAST(month(start_time) AS INTEGER) AS month FROM ({_INNER_LAKE})""",
    "star_daily": _with(_STREAM, _SONG, _STREAM_PLAYS) + _DAILY,
    "star_distinct_fact": _with(*_BASE) + _DISTINCT_FACT,
    "star_daily_rerun": _with(_STREAM, _SONG, _STREAM_PLAYS)
    + f"SELECT {_fact('at_s', _MD5)}, {_FILED} AS event_date FROM plays LEFT JOIN song {_ON3_WHOLE}",
    "star_daily_times": _with(_STREAM, _SONG, _STREAM_PLAYS)
    + f"""SELECT start_time, {_parts('start_time', _number('start_time'))}, event_date FROM (
  SELECT at_s AS start_time, {_FILED} AS event_date FROM plays LEFT JOIN song {_ON3_WHOLE})""",
    "star_daily_users": _with(_STREAM, _SONG, _STREAM_PLAYS) + "SELECT DISTINCT user_id, first_name, last_name, gender, level FROM plays",
    "star_daily_tables": _with(_STREAM, _SONG, _STREAM_PLAYS, _ARTISTS)
    + "\nUNION ALL ".join([
        _count("users", "(SELECT DISTINCT user_id, level FROM plays)"),
        _count("songs", f"({_SONGS_SELECT.replace('SELECT', 'SELECT DISTINCT', 1)})"),
        _count(
            "artists",
            "(SELECT DISTINCT artist_id, name, location, trunc(latitude), trunc(longitude) FROM artists)",
        ),
        _count("time", f"({_DAILY})"),
        _count("songplays", f"({_DAILY})"),
    ]),
    "wide_tables": _with(_LOG, _PLAYS_TWICE) + _WIDE,
}
ORACLES["stage_table"] = ORACLES["stage_mapping"]
ORACLES["date_incremental_file"] = ORACLES["date_incremental"]
ORACLES["lookups_clustered"] = _with(_LOG, _PLAYS) + f"""SELECT 'session_item' AS lookup, artist_name, song_title, length,
  CAST(NULL AS VARCHAR) AS user_first_name, CAST(NULL AS VARCHAR) AS user_last_name
FROM ({_BY_SESSION}) WHERE session_id = 14 AND item_in_session = 6
UNION ALL SELECT 'user_session', artist_name, song_title, NULL, user_first_name, user_last_name
FROM ({_BY_USER_SESSION}) WHERE user_id = 1122 AND session_id = 56
UNION ALL SELECT 'users_by_song', NULL, NULL, NULL, user_first_name, user_last_name
FROM ({_BY_SONG}) WHERE song_title = 'Track 3'"""
ORACLES["star_violations_fused"] = ORACLES["star_violations"]
ORACLES["failed_checks"] = (
    f"SELECT count(*) AS n_failed FROM ({ORACLES['quality_report']}) WHERE NOT passed"
)
