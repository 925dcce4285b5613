"""Rows that operators must take: nulls, empty and very long texts, ties, repeats, clashing columns."""

import random

SYLLABLES = "ka lo mi ren tas ul vo shi per dun".split()


def words(n, seed=0):
    pick = random.Random(seed)
    return ["".join(pick.choices(SYLLABLES, k=pick.randint(1, 3))) for _ in range(n)]


def text(n, seed=0):
    return " ".join(words(n, seed))


# Names that operators use inside; the tables may have them as well.
CLASHING = "words row unit kept score digest bands host n cell word stays rows text_md5 sketch ids conv kind".split()

DOCUMENTS = [
    (1, text(60, 1), "aa"), (2, text(60, 1), "aa"), (2, text(60, 1), "aa"), (3, None, "aa"), (4, "", "bb"),
    (5, " \n\t ", None), (None, text(60, 2), "bb"), (None, None, None), (6, "é", "bb"), (7, "!!! ***", "aa"),
    (8, text(30_000, 3), "bb"), (9, "x" * 120_000, "aa"), (10, text(4, 4), "aa"), (11, text(4, 4), "bb"),
    (12, "tab\tand  two blanks \n end ", "aa"), (13, "▁ mark \U0001f642 <s> \\n", "bb"), (2**62, text(40, 5), "aa"),
]
SCHEMA = "doc_id long, text string, lang string"


def documents(spark, rows=DOCUMENTS):
    """The rows with a column of each clashing name."""
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", *(f"'other' as `{name}`" for name in CLASHING))


def labels(spark, rows=((1, 1), (2, 1), (8, 1), (None, 1), (3, None), (4, 0), (4, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int").selectExpr("*", "0 as toxic", "'x' as text")


def key(row):
    return tuple((v is None, str(v)) for v in row)
