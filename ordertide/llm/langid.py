"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram's vector binds its three letters: the
first rotated by two places, the second by one, the third as it is, multiplied together. A text
bundles (adds up) the vectors of its trigrams; a language bundles its training texts, each
weighing one whatever its length. A text speaks the language whose profile has the greatest
cosine with it. The score is the softmax of the cosines, at ``SHARPNESS``, for that language.

Letters are lower-cased; everything else is one blank, and runs of blanks count once. A null
text, or one without a letter, is ``und`` with score 0. A null language is never learned. If
nothing could be learned all texts are ``und``. Equal cosines go to the first language by name.
Long texts are bundled in slices, so memory is bounded. Profiles are languages times
dimensions numbers; texts are counted where they lie, and only sums of vectors are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import bounded_batches

DIMENSIONS, SEED = 1024, 9
BLANK = 0
UNKNOWN = "und"
#: Trigrams bundled at once, trigram vectors kept per worker, characters counted at once.
SLICE, MAX_KNOWN, TEXT_SLICE = 4096, 40_000, 1 << 20
SHARPNESS = 40.0


@cache
def letter_table() -> np.ndarray:
    """True for the code points that are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


@cache
def letter_vector(code: int) -> np.ndarray:
    """The letter's own random signs, the same in every process."""
    bits = np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS, dtype=np.int8)
    return (2 * bits - 1).astype(np.int8)


def bind(keys: np.ndarray) -> np.ndarray:
    """Vectors of trigrams given as three code points of 21 bits each."""
    codes = np.stack([(keys >> 42) & 0x1FFFFF, (keys >> 21) & 0x1FFFFF, keys & 0x1FFFFF])
    letters, at = np.unique(codes, return_inverse=True)
    vectors, at = np.stack([letter_vector(int(c)) for c in letters]), at.reshape(codes.shape)
    return np.roll(vectors, 2, axis=1)[at[0]] * np.roll(vectors, 1, axis=1)[at[1]] * vectors[at[2]]


class TrigramVectors:
    """Remembers the vectors of trigrams seen so far, up to a bound."""

    def __init__(self):
        self.vectors = np.empty((MAX_KNOWN, DIMENSIONS), np.int8)
        self.keys, self.rows = np.empty(0, np.int64), np.empty(0, np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Vectors of at most ``SLICE`` distinct sorted keys."""
        at = np.searchsorted(self.keys, keys)
        new = keys[(at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != keys)] if len(self.keys) else keys
        if len(new):
            if len(self.keys) + len(new) > MAX_KNOWN:
                self.keys = self.rows = np.empty(0, np.int64)
                new = keys
            rows = np.arange(len(self.keys), len(self.keys) + len(new))
            self.vectors[rows] = bind(new)
            where = np.searchsorted(self.keys, new)
            self.keys, self.rows = np.insert(self.keys, where, new), np.insert(self.rows, where, rows)
            at = np.searchsorted(self.keys, keys)
        return self.vectors[self.rows[at]]


@cache
def known() -> TrigramVectors:
    return TrigramVectors()


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of a text, sorted, and how often each occurs; none without a letter."""
    keys, counts, carried = [np.empty(0, np.int64)], [np.empty(0, np.int64)], np.array([BLANK], dtype=np.int64)
    for i in range(0, len(text or ""), TEXT_SLICE):
        codes = np.frombuffer(text[i : i + TEXT_SLICE].lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        codes = np.concatenate([carried, np.where(letter_table()[codes], codes, BLANK)])
        if i + TEXT_SLICE >= len(text):
            codes = np.append(codes, BLANK)
        # A blank after a blank is dropped.
        codes = codes[np.concatenate([[True], (codes[1:] != BLANK) | (codes[:-1] != BLANK)])]
        carried = codes[-2:]
        if len(codes) > 2:
            k, n = np.unique((codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:], return_counts=True)
            keys.append(k)
            counts.append(n)
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    if len(keys) > 2:
        all_keys, at = np.unique(all_keys, return_inverse=True)
        all_counts = np.bincount(at, weights=all_counts).astype(np.int64)
    return all_keys, all_counts


def bundle(text: str | None) -> np.ndarray | None:
    """The text's vector, or null if it has no letter."""
    keys, counts = trigrams(text)
    if not len(keys):
        return None
    out = np.zeros(DIMENSIONS, dtype=np.float64)
    for i in range(0, len(keys), SLICE):
        out += counts[i : i + SLICE].astype(np.float32) @ known().of(keys[i : i + SLICE]).astype(np.float32)
    return out


def profiles(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Each language's unit vector, learned from all rows with a language."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, dict[int, float]] = {}
        for batch in batches:
            for value, name in zip(batch["text"], batch["lang"], strict=True):
                keys, n = trigrams(value)
                weights, own = n / max(n.sum(), 1), counts.setdefault(name, {})
                for k, w in zip(keys.tolist(), weights.tolist(), strict=True):
                    own[k] = own.get(k, 0.0) + w
                if len(own) > 25 * MAX_KNOWN:
                    yield _summed(name, counts.pop(name))
        for name in [*counts]:
            yield _summed(name, counts.pop(name))

    rows = bounded_batches(labelled).where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    parts = rows.mapInPandas(run, "lang string, dim int, value double")
    # As many rows as languages times dimensions.
    found = parts.groupBy("lang", "dim").agg(F.sum("value").alias("value")).collect()
    out = {name: np.zeros(DIMENSIONS) for name in sorted({r["lang"] for r in found})}
    for r in found:
        out[r["lang"]][r["dim"]] = r["value"]
    return {name: v / np.linalg.norm(v) for name, v in out.items() if v.any()}


def _summed(name: str, weights: dict[int, float]) -> pd.DataFrame:
    """One language's bundle of weighted trigrams, as rows of one dimension each."""
    keys = np.array(sorted(weights), dtype=np.int64)
    amounts, total = np.array([weights[k] for k in keys.tolist()]), np.zeros(DIMENSIONS)
    for i in range(0, len(keys), SLICE):
        total += amounts[i : i + SLICE] @ bind(keys[i : i + SLICE]).astype(np.float64)
    return pd.DataFrame({"lang": name, "dim": np.arange(DIMENSIONS, dtype=np.int32), "value": total})


def predictor(learned: dict[str, np.ndarray]):
    """A column function: text to (lang, score)."""
    names, matrix = [*learned], np.array([*learned.values()]).reshape(len(learned), DIMENSIONS)

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            v = bundle(text) if names else None
            if v is None or not v.any():
                out.append((UNKNOWN, 0.0))
                continue
            cosines = matrix @ (v / np.linalg.norm(v))
            shares = np.exp(SHARPNESS * (cosines - cosines.max()))
            best = int(cosines.argmax())
            out.append((names[best], float(shares[best] / shares.sum())))
        return pd.DataFrame(out, columns=["lang", "score"])

    return predict


def held_out(doc_id: Column, fold: int = 2, folds: int = 4) -> Column:
    """Whether a document is kept from training; a null id never is."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == fold, F.lit(False))


def identify(df: DataFrame, learned: dict[str, np.ndarray], text: str = "text", out: str = "predicted") -> DataFrame:
    """``df`` with a struct (lang, score)."""
    return bounded_batches(df).withColumn(out, predictor(learned)(F.col(text)))


def learn(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Profiles from the rows of ``df`` that are not held out."""
    return profiles(df.where(~held_out(F.col(doc_id))), text, lang)
