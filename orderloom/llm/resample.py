"""Importance resampling: documents drawn in proportion to their likeness to a target set.

Hashed word runs of a document earn the logarithm of how much commoner their
bucket is in the target texts than in the corpus. Gumbel noise on the sum makes
the highest scores a weighted draw without replacement.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.ranking import number_rows
from orderloom.llm.scratch import Scratch
from orderloom.llm.words import chunks

BUCKETS = 10_000
PERCENT = 10
LEAST_WORDS = 20
LONGEST_RUN = 1
SEED = "2024"
#: Pivot keys of one quickselect round; each divides the candidates once more.
PIVOTS = 8
#: Bytes of a text whose words are held at once.
SPAN = 4 << 20

# Words are ASCII letters and digits and everything beyond ASCII, A-Z lower-cased.
_FOLD = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower()
)


def spans(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, those of ``SPAN`` bytes at a time."""
    folded = text.translate(_FOLD)
    start = 0
    while len(folded) - start > SPAN:
        stop = folded.find(b" ", start + SPAN)
        if stop < 0:
            break
        yield folded[start:stop].split()
        start = stop
    yield folded[start:].split()


def bucket_numbers(text: bytes, buckets: int, longest: int) -> Iterator[tuple[np.ndarray, int]]:
    """Buckets of all runs of up to ``longest`` words, and the words beside them, span by span."""
    before: list[bytes] = []
    for words in spans(text):
        runs = list(map(crc32, words))
        for size in range(2, longest + 1):
            # Runs that end in this span may begin in the one before.
            joined = before[max(0, len(before) - size + 1) :] + words
            runs += [crc32(b" ".join(joined[i : i + size])) for i in range(len(joined) - size + 1)]
        if longest > 1:
            before = (before + words)[1 - longest :]
        yield np.array(runs, dtype=np.int64) % buckets, len(words)


def _bytes(texts: pa.Array) -> Iterator[bytes]:
    for text in texts.cast(pa.large_binary()):
        yield text.as_py() or b""


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> np.ndarray:
    """How many features of all texts fall into each bucket.

    Each task counts its texts and sends one row per bucket; what reaches the
    driver are the ``buckets`` sums.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, dtype=np.int64)
        for batch in (part for whole in batches for part in chunks(whole, "text")):
            for text in _bytes(batch.column("text")):
                for numbers, _ in bucket_numbers(text, buckets, longest):
                    totals += np.bincount(numbers, minlength=buckets)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], ["bucket", "n"])

    sums = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n"))
    found = np.zeros(buckets, dtype=np.int64)
    for bucket, n in sums.collect():
        found[bucket] = n
    return found


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    wide = float(len(corpus))
    s_all, t_all = float(corpus.sum()) + wide, float(target.sum()) + wide
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        dtype=np.int64,
    )


def noise(seed: str, doc_id: object) -> int:
    """Thousandths of a Gumbel draw that the document's id fixes."""
    name = "null" if doc_id is None else doc_id
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(
    docs: DataFrame, gains: np.ndarray, seed: str = SEED, longest: int = LONGEST_RUN
) -> DataFrame:
    """doc_id, words, n_features, weight and score of every row, from an array of gains."""
    id_type = docs.schema["doc_id"].dataType
    buckets = len(gains)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in chunks(whole, "text")):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), _bytes(batch.column("text"))):
                words = features = weight = 0
                for numbers, found in bucket_numbers(text, buckets, longest):
                    words += found
                    features += len(numbers)
                    weight += int(gains[numbers].sum())
                rows.append((words, features, weight, weight + noise(seed, doc_id)))
            columns = [pa.array(v, pa.int64()) for v in zip(*rows)] if rows else [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns],
                ["doc_id", "words", "n_features", "weight", "score"],
            )

    out = f"doc_id {id_type.simpleString()}, words long, n_features long, weight long, score long"
    return docs.select("doc_id", "text").mapInArrow(score, out)


def _key() -> Column:
    """Highest score first, then the smaller doc_id (null first), then the row's place."""
    return F.struct((-F.col("score")).alias("down"), F.col("doc_id"), F.col("row"))


def kth_key(scratch: Scratch, rows: DataFrame, k: int, pivots: int = PIVOTS):
    """The k-th smallest ``key`` of the rows, by quickselect; keys are distinct.

    A round draws random pivots, one per seed, in one pass, counts the rows
    below and at each of them in another, and goes on with the rows between the
    two neighbours of the k-th. Those are written, so that each round reads only
    what the one before left, about a ninth of its input.
    """
    step = 0
    name = None
    kind = rows.schema["key"].dataType.simpleString()
    while True:
        draws = [
            F.min(F.struct(F.xxhash64(F.lit(step * pivots + i), "key.row").alias("draw"), F.col("key")))
            for i in range(pivots)
        ]
        drawn = rows.agg(*[d["key"].alias(f"p{i}") for i, d in enumerate(draws)]).first()
        keys = sorted({tuple(p) for p in drawn}, key=str)
        literals = [
            F.struct(*[F.lit(v).alias(n) for n, v in zip(("down", "doc_id", "row"), key)]).cast(kind)
            for key in keys
        ]
        counts = rows.agg(
            *[F.count_if(F.col("key") < p).alias(f"l{i}") for i, p in enumerate(literals)],
            *[F.count_if(F.col("key") == p).alias(f"e{i}") for i, p in enumerate(literals)],
        ).first()
        low, high, skipped = None, None, 0
        for i in sorted(range(len(keys)), key=lambda i: counts[f"l{i}"]):
            below, equal = counts[f"l{i}"], counts[f"e{i}"]
            if below < k <= below + equal:
                if name is not None:
                    scratch.drop(name)
                return literals[i]
            if below + equal < k:
                low, skipped = literals[i], below + equal
            elif high is None:
                high = literals[i]
        inside = F.lit(True)
        if low is not None:
            inside = inside & (F.col("key") > low)
        if high is not None:
            inside = inside & (F.col("key") < high)
        step += 1
        rows = scratch.store(f"candidates-{step}", rows.filter(inside))
        if name is not None:
            scratch.drop(name)
        name = f"candidates-{step}"
        k -= skipped


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    longest: int = LONGEST_RUN,
    seed: str = SEED,
) -> DataFrame:
    """Draw ``percent`` of the documents with enough words, likest to the target first.

    Returns one row per document: doc_id, n_features, weight, score, and rank,
    from 1 in the order of the draw, null for a document not drawn.

    A null text is empty: no features, weight 0, never drawn. A null doc_id
    draws its noise from the word null and precedes others on a tie. Rows that
    repeat a doc_id are documents of their own; where they also tie, the one
    that comes first in the scored table goes first. An empty table gives an
    empty result, an empty target leaves every gain to the corpus alone. Long
    texts are read whole, some megabytes at a time. Only doc_id and text are
    read, so other columns cannot clash.
    """
    scratch = Scratch(docs.sparkSession, "resample")
    gains = bucket_gains(
        bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest)
    )
    scored = scratch.store(
        "scored",
        score_documents(docs, gains, seed, longest).withColumn("row", F.monotonically_increasing_id()),
    )
    enough = scored.filter(F.col("words") >= least_words)
    drawn = percent * enough.count() // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    if not drawn:
        return scratch.finish(scored.select(*columns, unranked))
    last = kth_key(scratch, enough.select(_key().alias("key")), drawn)
    wins = (F.col("words") >= least_words) & (_key() <= last)
    winners = scored.filter(wins).withColumns({"all": F.lit(""), "down": -F.col("score")})
    ranked = number_rows(scratch, "winners", winners, "all", ["down", "doc_id", "row"])
    result = ranked.select(*columns, (F.col("n") + 1).alias("rank")).unionByName(
        scored.filter(~wins).select(*columns, unranked)
    )
    return scratch.finish(result)
