"""Small hand-made inputs with known answers."""

import json
import os

from loomstar.schemas import EVENT, SONG

SONGS = [
    ("s1", "T1", "A1", "Ann", 100.9),
    ("s2", "T1", "A1", "Ann", 200.0),
    ("s3", "T2", "A2", "Bob", 150.25),
    ("s4", "T2", "A2", "Bob", 150.25),
    ("s5", "T3", "A1", "Ann", 100.4),
]
EVENTS = [
    ("NextSong", 1541121934796, "1", "free", 10, 0, "T1", "Ann", 100.9),
    ("NextSong", 1541122000123, "1", "paid", 10, 1, "T2", "Bob", 150.25),
    ("NextSong", 1541122000999, "2", "free", 11, 0, "T1", "Ann", 100.2),
    ("NextSong", 1541122000123, "3", "free", 12, 0, "T9", "Zed", 10.0),
    ("Home", 1541122001000, "", "free", 13, 0, None, None, None),
    ("NextSong", 1541121934796, "1", "free", 10, 0, "T1", "Ann", 100.9),
]


def song_rows():
    names = ("song_id", "title", "artist_id", "artist_name", "duration")
    return [{**dict(zip(names, row)), "num_songs": 1, "year": 0, "artist_location": ""} for row in SONGS]


def event_rows(rows=None):
    names = (
        "page", "ts", "userId", "level", "sessionId", "itemInSession", "song", "artist", "length"
    )
    return [dict(zip(names, row)) for row in (EVENTS if rows is None else rows)]


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def songs(spark):
    return frame(spark, song_rows(), SONG)


def events(spark, rows=None):
    return frame(spark, event_rows(rows), EVENT)


def write_lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(json.dumps(r) for r in rows))  # no newline at the end


def write_raw(root):
    """The two sources as a tree of JSON files: one song each, two days of events."""
    for i, row in enumerate(song_rows()):
        write_lines(f"{root}/song_data/A/{'AB'[i % 2]}/C/{row['song_id']}.json", [row])
    rows = event_rows()
    write_lines(f"{root}/log_data/2018/11/2018-11-02-events.json", rows)
    later = [{**rows[0], "ts": rows[0]["ts"] + 86_400_000, "userId": "7", "sessionId": 20}]
    write_lines(f"{root}/log_data/2018/11/2018-11-03-events.json", later)
    with open(f"{root}/log_data/2018/11/notes.txt", "w") as f:
        f.write("not a log")
