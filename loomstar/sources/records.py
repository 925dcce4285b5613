"""CSV records with line breaks inside quotes, read by as many tasks as a file has blocks.

The scan reads lines, which can be split anywhere.  A line break ends a record where the
number of quotes before it in its file is even: a doubled quote counts twice and so leaves
the parity as it is.  Quotes are counted per block of a file and added up over the file's
blocks, a row each, which tells every block whether it begins inside quotes.  Lines then
become records within their block, and only the pieces of records that cross a block's
edge, two a block at most, meet in a second, small step.

A compressed file has one block, and Spark's own parser reads it in one pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial, reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Where a record begins: its file, block and line.
PLACE = ("arrival_file", "arrival_block", "arrival_row")
#: Endings of compressed files that cannot be split.
_ONE_BLOCK = (".gz", ".deflate", ".lz4", ".snappy", ".zst")
_GROUP = "file string, block bigint, nth bigint, line bigint, text string, quotes bigint"
_GROUP_ARROW = pa.schema([
    ("file", pa.string()), ("block", pa.int64()), ("nth", pa.int64()), ("line", pa.int64()), ("text", pa.string()), ("quotes", pa.int64()),
])


def _scan(spark: SparkSession, root: str | list[str]) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(root)


def _lines(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """Every line with its place and its number of quotes; a carriage return before the break is part of it."""
    value = F.col("value")
    bare = F.when(F.endswith(value, F.lit("\r")), F.left(value, F.length(value) - 1)).otherwise(value)
    return _scan(spark, root).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        bare.alias("text"),
        (F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"'), F.lit("")))).cast("bigint").alias("quotes"),
    )


def _text(column: str = "text") -> F.Column:
    """The lines of a group in their order."""
    parts = F.sort_array(F.collect_list(F.struct("block", "line", column)))
    return F.array_join(F.transform(parts, lambda p: p[column]), "\n").alias("text")


def _batch(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, _GROUP_ARROW)], schema=_GROUP_ARROW)


def _joined(lines: pa.Array, ends: np.ndarray) -> pa.Array:
    """The lines from each of `ends` to the next as one text."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lines), "\n")


def _grouped(batches: Iterable[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """Lines of blocks, each block's in its order, to the records that they make within their block.

    The `nth` record of a block has number 0 if it began in an earlier one.  `whole` gives
    the records that begin and end in their block, else the pieces of those that cross its edge.
    """
    place, last, above, nth = None, -1, 0, 0  # of the block in hand
    begun: list = []  # the record in hand: file, block, nth, line, its lines so far, quotes

    def closed(record: list) -> Iterator[pa.RecordBatch]:
        file, block, n, line, texts, quotes = record
        if (n > 0 and quotes % 2 == 0) == whole:
            yield _batch([file], [block], [n], [line], ["\n".join(texts)], [quotes])

    for batch in batches:
        if not batch.num_rows:
            continue
        files, texts = batch.column("file"), batch.column("text")
        blocks, befores, lines, counts = (batch.column(c).to_numpy() for c in ("block", "before", "line", "quotes"))
        other = pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False) | (np.diff(blocks) != 0)
        for low, high in pairwise([0, *(np.flatnonzero(other) + 1).tolist(), batch.num_rows]):
            file, block, line, quotes = files[low].as_py(), int(blocks[low]), lines[low:high], counts[low:high]
            begins = (file, block) != place
            if begins:
                place, last, above, nth = (file, block), -1, 0, 0
            if line[0] <= last or (np.diff(line) <= 0).any():
                raise ValueError(f"lines of {file} came out of order")
            starts = (befores[low] + above + np.cumsum(quotes) - quotes) % 2 == 0
            number = nth + np.cumsum(starts)
            starts[0] |= begins
            at = np.flatnonzero(starts)
            ends = [*at.tolist(), high - low]
            if ends[0]:  # more lines of the record in hand
                begun[4] += _joined(texts[low:high], [0, ends[0]]).to_pylist()
                begun[5] += int(quotes[: ends[0]].sum())
            if len(at):
                if begun:
                    yield from closed(begun)
                sums = np.add.reduceat(quotes, at)
                kept = ((number[at] > 0) & (sums % 2 == 0)) == whole
                kept[-1] = False  # it may go on
                if kept.any():
                    found = at[kept]
                    yield _batch(
                        files.take(pa.array(low + found)), np.full(len(found), block), number[found], line[found],
                        _joined(texts[low:high], at).filter(pa.array(kept[:-1])), sums[kept],
                    )
                text = _joined(texts[low:high], ends[-2:]).to_pylist()
                begun = [file, block, int(number[at[-1]]), int(line[at[-1]]), text, int(sums[-1])]
            above, nth, last = above + int(quotes.sum()), int(number[-1]), line[-1]
    if begun:
        yield from closed(begun)


def csv_records(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """(file, block, line, text): the records of all files below `root` without the first of each, their header.

    Quotes must stand around whole fields and be doubled inside them.  Line breaks are LF or
    CRLF, and LF inside a record that comes back.  Empty lines between records are no records.
    A quote that is never closed makes the rest of its file one record, as in any parser.
    """
    lines = _lines(spark, root)
    per_block = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("before")
    blocks = per_block.select("file", "block", before)

    placed = lines.join(F.broadcast(blocks), ["file", "block"])  # a row each; lines stay in their task, in order
    groups = lambda whole: placed.mapInArrow(partial(_grouped, whole=whole), _GROUP)

    begun = F.sum((F.col("nth") > 0).cast("int")).over(Window.partitionBy("file").orderBy("block", "nth"))
    pieces = groups(False).withColumn("record", begun)
    begins = F.min(F.struct("block", "line", "nth")).alias("begins")
    crossing = pieces.groupBy("file", "record").agg(_text(), begins)
    crossing = crossing.select("file", "begins.block", "begins.line", "begins.nth", "text")
    records = groups(True).select("file", "block", "line", "nth", "text").unionByName(crossing)
    header = (F.col("block") == 0) & (F.col("nth") == 1)
    return records.where(~header & (F.col("text") != "")).drop("nth")


def _whole_files(spark: SparkSession, root: str | list[str]) -> bool:
    """Whether every file below `root` is one block, and its line breaks are LF."""
    lines = _scan(spark, root)
    files = lines.inputFiles()
    if not files or not all(f.endswith(_ONE_BLOCK) for f in files):
        return False
    return lines.where(F.contains("value", F.lit("\r"))).isEmpty()


def read_csv_records(
    spark: SparkSession, root: str | list[str], schema: StructType, mode: str = "FAILFAST"
) -> DataFrame:
    """The records of all files below `root`, but for headers, as columns of `schema` with PLACE beside them.

    Compressed files are parsed as they are read if a look through their text finds no
    carriage return, which `csv_records` takes for part of a line break and Spark's parser does not.
    """
    options = {"quote": '"', "escape": '"', "mode": mode, "multiLine": "true"}
    always = F.monotonically_increasing_id() >= 0  # no later filter moves below it
    if _whole_files(spark, root):
        reader = spark.read.schema(schema).options(**options, header=True, lineSep="\n", recursiveFileLookup=True)
        # A parse that leaves out columns or rows cannot see that a record is malformed: this names all columns.
        scan = reader.csv(root).where(reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in schema.names], always))
        places = ("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
        return scan.select("*", *((F.col(a) if isinstance(a, str) else a).alias(b) for a, b in zip(places, PLACE)))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = csv_records(spark, root).select(
        F.from_csv(F.when(always, F.col("text")), ddl, options).alias("record"),  # else a filter parses it once more
        *(F.col(a).alias(b) for a, b in zip(("file", "block", "line"), PLACE)),
    )
    return parsed.select("record.*", *PLACE)
