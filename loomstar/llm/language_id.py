"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A letter n-gram is the product (binding)
of its letters' vectors, each rotated by its place; a text is the sum (bundle) of its
n-grams, and a language the sum of its training texts.  A text gets the language whose
prototype has the largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.llm.common import bounded, crc32_mod, narrow
from loomstar.llm.words import mix

DIMENSIONS = 1024
ORDER = 3
SEED = 20_240_501
FOLDS = 5
UNDETERMINED = "und"
#: n-grams bound at once: DIMENSIONS * CHUNK floats are 16 MB.
CHUNK = 4096
#: Characters whose n-grams are laid out at the same time, about 70 bytes each.
CHARACTERS = 1 << 20
#: In the pipeline a text goes if it is undetermined or so unlike every language.
MIN_SCORE = 0.1


@lru_cache(1)
def _letters() -> np.ndarray:
    """By code point: is it a letter (or a mark that belongs to one)?"""
    import unicodedata

    return np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)), bool, 0x110000)


def letter_vectors(codes: np.ndarray) -> np.ndarray:
    """Rows of +1 and -1 that depend on the code point and the seed alone."""
    words = np.arange(DIMENSIONS // 64, dtype=np.uint64)
    bits = mix(mix(codes.astype(np.uint64)[:, None] + np.uint64(SEED)) + words[None, :] * np.uint64(0x9E3779B97F4A7C15))
    return np.unpackbits(bits.view(np.uint8).reshape(len(codes), -1), axis=1).astype(np.int8) * 2 - 1


def gram_vectors(grams: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Bind: the product of the letters' vectors, rotated by their place in the n-gram.

    `grams` holds numbers of ORDER digits to the base len(letters).
    """
    own = letter_vectors(letters)
    out, rest = None, grams
    for place in range(ORDER):
        rest, digit = np.divmod(rest, len(letters))
        turned = np.roll(own, place, axis=1)[digit]
        out = turned if out is None else out * turned
    return out


def grams_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram, text, letters): n-grams of lower-cased letters; any run of others, and either end, is one blank."""
    joined = "".join("\n" + (t or "").replace("\n", " ") + " " for t in texts).lower()
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
    begins = codes == 10
    codes = np.where(_letters()[np.minimum(codes, 0x10FFFF)], codes, np.uint32(32))
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32) | begins[1:]
    owner = np.cumsum(begins)[keep] - 1
    codes = codes[keep]
    seen = np.zeros(int(codes.max()) + 1, bool)
    seen[codes] = True
    letters = np.flatnonzero(seen).astype(np.uint32)
    digit = np.zeros(len(seen), np.int64)
    digit[letters] = np.arange(len(letters))
    digits = digit[codes]
    n = len(digits) - ORDER + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), letters
    gram = np.zeros(n, np.int64)
    blank = np.ones(n, bool)
    for place in range(ORDER):
        gram += digits[place : place + n] * len(letters) ** place
        blank &= codes[place : place + n] == 32
    inside = (owner[:n] == owner[ORDER - 1 :]) & ~blank
    return gram[inside], owner[:n][inside], letters


def _parts(texts: list[str | None]) -> list[slice]:
    """Runs of texts of CHARACTERS characters, or one text."""
    ends = np.cumsum([len(t or "") for t in texts])
    cuts = np.flatnonzero(np.diff((ends - 1).clip(0) // CHARACTERS)) + 1
    return [slice(a, b) for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)])]


def bundles(texts: list[str | None], group: np.ndarray, groups: int) -> np.ndarray:
    """The bundle of each group of texts, exact whole numbers; memory is fixed per batch."""
    gram, owner, letters = grams_of(texts)
    out = np.zeros((groups, DIMENSIONS))
    if not len(gram):
        return out
    index, unique = pd.factorize(gram)
    row = group[owner]
    order = np.argsort(index // CHUNK, kind="stable") if len(unique) > CHUNK else None
    if order is not None:
        index, row = index[order], row[order]
    for start in range(0, len(unique), CHUNK):
        part = unique[start : start + CHUNK]
        a, b = np.searchsorted(index // CHUNK, [start // CHUNK, start // CHUNK + 1]) if order is not None else (0, len(index))
        counts = np.bincount(row[a:b] * len(part) + index[a:b] - start, minlength=groups * len(part))
        # float32 sums of counts under 2^24 are exact; larger ones only move a cosine's last digits
        out += counts.reshape(groups, len(part)).astype(np.float32) @ gram_vectors(part, letters).astype(np.float32)
    return out


def _train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's bundle per language: languages x DIMENSIONS numbers."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        group, names = pd.factorize(batch["lang"])
        texts = batch["text"].tolist()
        for part in _parts(texts):
            for name, vector in zip(names, bundles(texts[part], group[part], len(names))):
                total[name] = total.get(name, 0) + np.rint(vector).astype(np.int64)
    for name, vector in total.items():
        yield pd.DataFrame({"lang": name, "place": np.arange(DIMENSIONS), "value": vector})


def prototypes(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Language names in order and their unit vectors, from every training document.

    The driver gets DIMENSIONS numbers for each language.
    """
    held_out = crc32_mod(F.col("doc_id"), FOLDS) == 0
    train = narrow(docs, doc_id="long", text="string", lang="string").where(~held_out & F.col("lang").isNotNull())
    sums = bounded(train.select("text", "lang")).mapInPandas(_train, "lang string, place int, value long")
    rows = sums.groupBy("lang", "place").agg(F.sum("value").alias("value")).toPandas()
    names = sorted(rows["lang"].unique())
    out = np.zeros((len(names), DIMENSIONS))
    for k, name in enumerate(names):
        own = rows[rows["lang"] == name]
        out[k, own["place"]] = own["value"]
    norms = np.linalg.norm(out, axis=1)
    real = norms > 0
    return [n for n, r in zip(names, real) if r], (out / np.maximum(norms, 1e-300)[:, None])[real]


def predict(texts: list[str | None], names: list[str], vectors: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and cosine of each text; `und` and 0 without a letter or without languages."""
    own = [bundles(texts[p], np.arange(p.stop - p.start), p.stop - p.start) for p in _parts(texts)]
    own = np.concatenate(own) if own else np.zeros((0, DIMENSIONS))
    norms = np.linalg.norm(own, axis=1)
    if not names:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    cosine = own @ vectors.T / np.maximum(norms, 1e-300)[:, None]
    best = np.round(cosine, 9).argmax(axis=1)
    score = np.clip(cosine[np.arange(len(texts)), best], 0, 1)
    # Combining marks make n-grams too, but no language without a letter.
    known = np.array([n > 0 and any(map(str.isalpha, t)) for n, t in zip(norms, texts)], bool)
    return [names[b] if k else UNDETERMINED for b, k in zip(best, known)], np.where(known, score, 0.0)


def language_id(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, lang_pred, score (the cosine, 0 at least).

    Null and empty texts and texts without a letter are `und` with score 0, as is every
    text when no training document names a language.  Ties go to the first name.  Repeated
    rows are predicted alike.  Only text is read for a prediction.
    """
    share = docs.sparkSession.sparkContext.broadcast(prototypes(docs))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lang, cosine = predict(batch["text"].tolist(), *share.value)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].array, "held_out": batch["held_out"], "lang_pred": lang, "score": cosine
            })

    one = narrow(docs, doc_id="long", text="string").withColumn("held_out", crc32_mod(F.col("doc_id"), FOLDS) == 0)
    return bounded(one).mapInPandas(score, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known_language(docs: DataFrame) -> DataFrame:
    """`docs`, all its columns, without texts that are `und` or unlike every learned language."""
    share = docs.sparkSession.sparkContext.broadcast(prototypes(docs))

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        lang, cosine = predict(texts.tolist(), *share.value)
        return pd.Series([x != UNDETERMINED for x in lang]) & (cosine >= MIN_SCORE)

    return bounded(docs).where(known(F.col("text").cast("string")))
