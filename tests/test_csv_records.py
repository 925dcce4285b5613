"""CSV records: compressed files read by Spark's own parser, others joined from lines, to the same rows."""

import csv
import gzip
import random

import pytest
from pyspark.sql import functions as F

from loomstar import operators as op
from loomstar import sources
from loomstar.schemas import EVENT_CSV

NAMES = EVENT_CSV.fieldNames()
ODD = ["plain", 'says "x"', "a\n\nb", '"', "comma, and\nbreak", "", None, " blank ", "é ü\u0085", "many\n" * 40, '\n"\n"', "back\\slash", "#"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(n, seed=5):
    pick = random.Random(seed)
    for k in range(n):
        yield [pick.choice(ODD), "in", "É", None, k, "L", pick.choice([1.5, None, "1E+3"]), "free", "x", "PUT", "NextSong", 1, k % 9, pick.choice(ODD), 200, 3, 4]


def write(path, records, ending="\n", packed=False, tail=""):
    path.parent.mkdir(parents=True, exist_ok=True)
    with (gzip.open if packed else open)(path, "wt", newline="", encoding="utf-8") as file:
        out = csv.writer(file, lineterminator=ending)
        out.writerow(NAMES)
        out.writerows(records)
        file.write(tail)


def read(spark, root):
    log = sources.read_events_csv(spark, str(root), multi_line=True, arrival=True)
    found = log.orderBy(F.regexp_replace(sources.ARRIVAL[0], r"^.*/|\.gz$", ""), *sources.ARRIVAL[1:]).collect()
    return [tuple(r)[: len(NAMES)] for r in found]


@pytest.mark.parametrize("endings", [["\n", "\n"], ["\n", "\r\n"]])
def test_compressed_files_give_the_records_of_plain_ones_in_their_order(spark, tmp_path, endings):
    for name, ending, tail in zip("ab", endings, ("\n\n", "")):
        for packed in (False, True):
            file = tmp_path / ("gz" if packed else "plain") / name / f"{name}.csv{'.gz' if packed else ''}"
            write(file, rows(300, ord(name)), ending, packed, tail)
    for packed in (False, True):
        write(tmp_path / ("gz" if packed else "plain") / f"z.csv{'.gz' if packed else ''}", [], "\n", packed)
    got = read(spark, tmp_path / "gz")
    assert got == read(spark, tmp_path / "plain")
    assert [r[4] for r in got] == [*range(300)] * 2


def test_compressed_files_are_parsed_as_they_are_read(spark, tmp_path):
    write(tmp_path / "lf" / "a.csv.gz", rows(9), packed=True)
    write(tmp_path / "crlf" / "a.csv.gz", rows(9), "\r\n", packed=True)
    direct = plan(sources.read_events_csv(spark, str(tmp_path / "lf"), multi_line=True))
    assert "FileScan csv" in direct and "MapInArrow" not in direct and "Exchange" not in direct
    assert "MapInArrow" in plan(sources.read_events_csv(spark, str(tmp_path / "crlf"), multi_line=True))


@pytest.mark.parametrize("packed", [False, True])
def test_a_malformed_record_fails_every_read_of_its_file(spark, tmp_path, packed):
    good = ["", "in", "F", "F", 1, "L", 1.5, "free", "x", "PUT", "NextSong", 1, 2, "s", 200, 3, 4]
    bad = [*good[:4], "no number", *good[5:]]
    write(tmp_path / f"a.csv{'.gz' if packed else ''}", [good, bad, good], packed=packed)
    log = sources.read_events_csv(spark, str(tmp_path), multi_line=True)
    for found in (log, log.select("song"), op.non_empty(log, "artist"), op.non_empty(log, "artist").select("song")):
        with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
            found.collect()


def test_a_filter_does_not_parse_records_once_more(spark, tmp_path):
    write(tmp_path / "a.csv", rows(9))
    log = sources.read_events_csv(spark, str(tmp_path), multi_line=True)
    one_parse = plan(log).count("from_csv(")
    assert plan(op.non_empty(log, "artist")).count("from_csv(") == one_parse


def test_records_that_cross_batches_of_lines_and_blocks_are_whole(spark, tmp_path):
    write(tmp_path / "plain" / "a.csv", rows(200), tail='"open\n\n')
    write(tmp_path / "gz" / "a.csv.gz", rows(200), packed=True, tail='"open\n\n')
    want = sources.csv_records(spark, str(tmp_path / "gz")).orderBy("line").collect()
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": "3", "spark.sql.files.maxPartitionBytes": "300"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert spark.read.text(str(tmp_path / "plain")).rdd.getNumPartitions() > 20
        got = sources.csv_records(spark, str(tmp_path / "plain")).orderBy("block", "line").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert [r.text for r in got] == [r.text for r in want]
    assert len(got) == 201 and got[-1].text.rstrip("\n") == '"open'
