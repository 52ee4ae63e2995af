"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1.  A letter n-gram is bound
into one vector: the product of its letters' vectors, each rotated by its place.
A text's vector is the sum (bundle) of its n-grams' vectors; a language's
prototype is the bundle of all its training texts.  A text gets the language
whose prototype has the largest cosine with it.

Counts come first: a text is reduced to its distinct n-grams with counts, so
binding costs one product per distinct n-gram.  Prototypes are sums of exact
integers, pre-summed within each task; only one vector per (task, language)
is shuffled.  The learned languages' prototypes reach the driver: at most
`MAX_LANGS` vectors of `DIM` numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIM = 1_024
NGRAM = 3
MAX_LANGS = 2_048
LETTERS = 256
SEED = 20_240_229
UNKNOWN = "und"


def _codes() -> np.ndarray:
    """Letter number of each code point of the first plane: 0 not a letter, else 1 to 255
    (a-z fixed; other letters by their code point, so different letters may share one)."""
    chars = [chr(i) if not 0xD800 <= i < 0xE000 else " " for i in range(0x10000)]
    return np.array([0 if not c.isalpha() else (ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % (LETTERS - 27))
                     for c in chars], np.uint8)


def _rotated(dim: int = DIM) -> list[np.ndarray]:
    """The letters' vectors as they stand at each place of an n-gram."""
    base = np.random.default_rng(SEED).integers(0, 2, (LETTERS, dim)).astype(np.int8) * 2 - 1
    return [np.roll(base, place, axis=1) for place in range(NGRAM)]


class Encoder:
    """Texts to vectors; built once in each task."""

    def __init__(self, dim: int = DIM):
        self.dim, self.codes, self.vectors = dim, _codes(), _rotated(dim)

    def letters(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        own = self.codes[np.minimum(points, 0xFFFF)]
        if len(points) and points.max() > 0xFFFF:
            high = np.flatnonzero(points > 0xFFFF)
            own[high] = [27 + int(p) % (LETTERS - 27) if chr(p).isalpha() else 0 for p in points[high]]
        return own

    def vector(self, text: str | None) -> np.ndarray | None:
        """The bundle of a whole text's n-grams (word borders count as a letter);
        None if the text is null or has no letter."""
        own = self.letters(text or "")
        if not own.any():
            return None
        own = np.concatenate(([0], own, [0])).astype(np.int64)
        own = own[(own > 0) | (np.concatenate(([1], own[:-1])) > 0)]  # one border between words
        own = np.concatenate(([0], own, [0]))
        grams, counts = np.unique((own[:-2] * LETTERS + own[1:-1]) * LETTERS + own[2:], return_counts=True)
        out = np.zeros(self.dim)
        for i in range(0, len(grams), 4_096):
            g = grams[i:i + 4_096]
            bound = self.vectors[0][g // (LETTERS * LETTERS)] * self.vectors[1][g // LETTERS % LETTERS] * self.vectors[2][g % LETTERS]
            out += counts[i:i + 4_096].astype(np.float32) @ bound.astype(np.float32) if counts.max() < 4_096 else counts[i:i + 4_096] @ bound.astype(np.float64)
        return out


def prototypes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dim: int = DIM) -> dict[str, np.ndarray]:
    """The bundle of all texts of each non-null language of `docs`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, sums = Encoder(dim), {}
        for b in batches:
            for text, lang in zip(b["text"], b["lang"], strict=True):
                if (v := encoder.vector(text)) is not None:
                    v = np.rint(v).astype(np.int64)
                    sums[lang] = sums[lang] + v if lang in sums else v
            if len(sums) > MAX_LANGS:
                raise ValueError(f"more than {MAX_LANGS} languages")
        places = np.arange(dim, dtype=np.int32)
        for lang, v in sums.items():
            yield pd.DataFrame({"lang": lang, "place": places, "v": v})

    known = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("lang is not null")
    summed = (known.mapInPandas(run, "lang string, place int, v bigint").groupBy("lang", "place").agg(F.sum("v").alias("v"))
              .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "v")))["v"].alias("v"))  # DIM numbers each
              .limit(MAX_LANGS + 1).collect())
    if len(summed) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    return {r["lang"]: np.array(r["v"], np.float64) for r in summed}


def predict(docs: DataFrame, protos: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score` (cosine with the prototype, below 0 as 0).

    `und` and 0 for texts that are null or have no letter, and for all if no
    language was learned.  Ties go to the first language in code point order.
    Columns of `docs` with these two names are replaced.
    """
    langs = sorted(protos)
    dim = len(protos[langs[0]]) if langs else DIM
    unit = np.array([protos[x] / max(np.linalg.norm(protos[x]), 1e-300) for x in langs]).reshape(len(langs), dim)
    docs = docs.drop("lang_pred", "score")

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(dim)
        for texts in batches:
            found = []
            for text in texts:
                v = encoder.vector(text) if langs else None
                norm = np.linalg.norm(v) if v is not None else 0.0
                if norm == 0:
                    found.append((UNKNOWN, 0.0))
                    continue
                cos = unit @ v / norm
                best = int(cos.argmax())
                found.append((langs[best], float(min(1.0, max(0.0, cos[best])))))
            yield pd.DataFrame(found, columns=["lang", "score"])

    return docs.withColumn("lang_pred", run(F.col(text_col))).select(
        *docs.columns, F.col("lang_pred.lang").alias("lang_pred"), F.col("lang_pred.score").alias("score"))


def held_out(fold: Column) -> Column:
    """Remainder 2 of 4 is held out (null ids: not)."""
    return F.coalesce(fold == 2, F.lit(False))
