"""Language identification by hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.words import chunks

#: Components of a hypervector.
WIDTH = 512
#: Expected labelled rows that profiles are learned from.
TRAIN_ROWS = 20_000
UNKNOWN = "und"

# Fold 0 of the code points is everything that is no letter.
_LETTERS: dict[int, int] = {}


def _letter_table(points: np.ndarray) -> np.ndarray:
    """Letters as lower-case code points, anything else as 0."""
    distinct, inverse = np.unique(points, return_inverse=True)
    for p in distinct.tolist():
        if p not in _LETTERS:
            c = chr(p)
            _LETTERS[p] = ord(c.lower()[0]) if c.isalpha() else 0
    return np.array([_LETTERS[p] for p in distinct.tolist()], dtype=np.int64)[inverse]


def _letter_vectors(letters: np.ndarray, width: int) -> np.ndarray:
    """A random vector of +1 and -1 per letter, made from the letter alone."""
    columns = np.arange(width, dtype=np.uint64)
    x = letters.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + columns * np.uint64(
        0xD1342543DE82EF95
    )
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return ((x >> np.uint64(63)).astype(np.int8) * 2 - 1).astype(np.float32)


def _gram_vectors(grams: np.ndarray, width: int) -> np.ndarray:
    """Letter trigrams (packed, 21 bits a letter): letters permuted by place, then bound."""
    mask = (1 << 21) - 1
    parts = [(grams >> 42) & mask, (grams >> 21) & mask, grams & mask]
    letters, inverse = np.unique(np.concatenate(parts), return_inverse=True)
    vectors = _letter_vectors(letters, width)
    first, second, third = np.split(inverse, 3)
    return np.roll(vectors, 2, axis=1)[first] * np.roll(vectors, 1, axis=1)[second] * vectors[third]


def bundles(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(vector of each text, whether it has a letter): its trigrams' vectors added up.

    Letters are lower-cased; a run of other characters is one blank; a text
    begins and ends with a blank. A null text has no letter.
    """
    held = [t or "" for t in texts.to_pylist()]
    # Two blanks apart, so that no trigram with letters of two texts exists.
    points = np.frombuffer(("\0\0" + "\0\0".join(held) + "\0\0").encode("utf-32-le", "replace"), "<u4")
    lengths = np.fromiter((len(t) + 2 for t in held), np.int64, len(held))
    owner = np.concatenate([[0, 0], np.repeat(np.arange(len(held)), lengths)])
    letters = _letter_table(points)
    # The two blanks before a text are its own neighbours' end; keep one blank of a run.
    keep = np.ones(len(letters), dtype=bool)
    keep[1:] = (letters[1:] > 0) | (letters[:-1] > 0)
    letters, owner = letters[keep], owner[keep]
    a, b, c = letters[:-2], letters[1:-1], letters[2:]
    # A trigram belongs to the owner of its middle letter; the middle is never a blank.
    use = b > 0
    grams = (a[use] << 42) | (b[use] << 21) | c[use]
    of = owner[1:-1][use]
    distinct, inverse = np.unique(grams, return_inverse=True)
    vectors = np.zeros((len(held), width), dtype=np.float32)
    counted, counts = np.unique(of * len(distinct) + inverse, return_counts=True)
    docs, gram = counted // max(1, len(distinct)), counted % max(1, len(distinct))
    for low in range(0, len(held), 64):
        a, b = np.searchsorted(docs, [low, low + 64])
        here, column = np.unique(gram[a:b], return_inverse=True)
        dense = np.zeros((min(64, len(held) - low), len(here)), dtype=np.float32)
        dense[docs[a:b] - low, column] = counts[a:b]
        vectors[low : low + 64] = dense @ _gram_vectors(distinct[here], width)
    has_letter = np.bincount(of, minlength=len(held)) > 0
    return vectors, has_letter


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms > 0, norms, 1)


def learn_profiles(
    labelled: DataFrame, train_rows: int = TRAIN_ROWS, width: int = WIDTH
) -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and their profiles from (doc_id, text, lang).

    Learns from about ``train_rows`` rows with a language, picked by a hash
    of doc_id. Every document is bundled to unit length and added to its
    language; one vector per language and task is shuffled.
    """
    known = labelled.filter(F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    total = known.select("doc_id").count()
    share = min(1.0, train_rows / total) if total else 1.0
    picked = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in (part for whole in batches for part in chunks(whole, "text")):
            vectors = _unit(bundles(batch.column("text"), width)[0])
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for lang in set(langs.tolist()):
                sums[lang] = sums.get(lang, 0) + vectors[langs == lang].sum(axis=0, dtype=np.float64)
        if sums:
            values = pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), values], ["lang", "sums"])

    parts = picked.mapInArrow(add, "lang string, sums array<double>")
    added = (
        parts.select("lang", F.posexplode("sums").alias("place", "value"))
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("sums"))
        .orderBy("lang")
        .collect()
    )
    languages = [row["lang"] for row in added]
    profiles = np.array([[p["value"] for p in row["sums"]] for row in added], dtype=np.float32)
    return languages, _unit(profiles.reshape(len(languages), width))


def language_id(
    docs: DataFrame, languages: list[str], profiles: np.ndarray, width: int = WIDTH
) -> DataFrame:
    """The language whose profile has the largest cosine with each document.

    Returns doc_id, lang_pred, score (the cosine, 0 at least), one row per
    row. A text that is null or has no letter is ``und`` with score 0, as is
    every text when no profile was learned. Ties go to the first language in
    order. Rows that repeat are judged alike; a null doc_id is returned as it
    is; only doc_id and text are read. The whole text counts.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*languages, UNKNOWN], dtype=object)
        for batch in (part for whole in batches for part in chunks(whole, "text", 1 << 20)):
            vectors, has_letter = bundles(batch.column("text"), width)
            if languages:
                cosines = _unit(vectors) @ profiles.T
                best = np.where(has_letter, cosines.argmax(axis=1), len(languages))
                score = np.where(has_letter, np.clip(cosines.max(axis=1), 0, 1), 0)
            else:
                best, score = np.zeros(len(vectors), int), np.zeros(len(vectors))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(names[best].tolist(), pa.string()),
                    pa.array(score.astype(np.float64)),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        judge, f"doc_id {kind}, lang_pred string, score double"
    )


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that training leaves out: crc32 of doc_id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict_languages(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Learn from the documents outside the held-out fold and judge all of them.

    Returns doc_id, held_out, lang_pred, score. A null doc_id is in no fold
    and so is not held out.
    """
    languages, profiles = learn_profiles(docs.filter(~held_out()), train_rows)
    judged = language_id(docs, languages, profiles)
    return judged.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
