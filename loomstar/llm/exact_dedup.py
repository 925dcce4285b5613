"""Exact copies, with heavy hitters split off: DataFrame functions only.

Texts are equal when identical without white space.  A digest that a large part of all
rows share would land in one task; Misra-Gries finds the few digests that can be so
frequent, an exact count verifies them, and their winners go to every task by broadcast.
All other digests take an ordinary shuffle, in groups that are then small by proof.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstar.llm.common import WHITE, drop_unkept, narrow, store, text_md5

#: A digest of at least this share of all rows is frequent; so at most 1 / SUPPORT are.
SUPPORT = 0.001


def normalized(text: Column) -> Column:
    """Text without white space; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for c in WHITE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _digested(docs: DataFrame) -> DataFrame:
    one = narrow(docs, doc_id="long", text="string")
    return one.select(
        "doc_id",
        F.sha2(normalized(F.col("text")), 256).alias("digest"),
        F.length(F.coalesce("text", F.lit(""))).alias("chars"),
        text_md5(F.col("text")).alias("text_md5"),
    )


def _winner() -> list[Column]:
    """Per digest: its rows, and the row that stays."""
    order = F.struct(
        (-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("row")
    )
    return [F.count(F.lit(1)).alias("group_size"), F.min(order).alias("best")]


def frequent_winners(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """(digest, group_size, best) of digests on at least `support` of all rows: 1 / support rows at most.

    `freqItems` is the Misra-Gries summary: it misses no frequent digest but may name
    rare ones, so each candidate is counted before it counts as frequent.
    """
    least = rows.count() * support
    candidates = rows.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("digest"))
    held = rows.join(F.broadcast(candidates.distinct()), "digest", "left_semi")
    return held.groupBy("digest").agg(*_winner()).where(F.col("group_size") >= max(least, 2))


def exact_dedup(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256, text_md5.

    Of equal texts the row with the most code points stays, then the smallest doc_id (a
    null one last); of rows that repeat even that, exactly one.  Null texts equal empty
    ones.  An empty table gives an empty result; other columns are not read.
    """
    rows = store(_digested(docs).withColumn("row", F.monotonically_increasing_id()), "digests")
    hot = store(frequent_winners(rows, support), "frequent-digests")
    rest = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    single = rest.groupBy("digest").agg(*_winner())
    judged = rows.join(F.broadcast(hot), "digest").unionByName(rest.join(single, "digest"))
    return judged.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
        "text_md5",
    )


def drop_exact_copies(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """`docs`, all its columns, without the rows that `exact_dedup` drops."""
    return drop_unkept(docs, exact_dedup(docs, support))
