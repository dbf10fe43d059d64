"""Quality scores learned from preference pairs (Bradley-Terry)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.language_id import held_out
from orderloom.llm.scratch import Scratch
from orderloom.llm.words import Words, chunks, rolling

#: Pairs that each labelled row is in, the least number of all, and those compared at once.
PARTNERS, PAIRS = 4, 60_000
#: Rows of a group that pairs are made in, and least expected ones of the rarer label.
GROUP_ROWS, RARE = 4096, 64
#: Tasks that partial sums meet in, and parts of a range that ranks are counted in.
MERGERS, BINS = 8, 1024
#: A document is predicted good from this score on.
CUT = 0.7

_FIRST, _LAST = 0x20, 0x7F
N_FEATURES = (_LAST - _FIRST) + 10


def _distinct(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """How many different values each owner has."""
    order = np.lexsort((values, owner))
    o, v = owner[order], values[order]
    fresh = np.ones(len(o), dtype=bool)
    fresh[1:] = (o[1:] != o[:-1]) | (v[1:] != v[:-1])
    return np.bincount(o[fresh], minlength=n)


def features(texts: pa.Array) -> np.ndarray:
    """One row per text, from the whole text alone; zeros where it has no word.

    Roots of the shares of printable ASCII characters, then lengths, the
    share of upper-case words, and how much of the words, word pairs, 3-word
    windows and lines is repetition.
    """
    words = Words(texts)
    n, data = len(words.counts), words.data
    sizes = np.diff(words.offsets)
    owner = np.repeat(np.arange(n), sizes)
    shares = np.zeros((n, N_FEATURES))
    printable = (data >= _FIRST) & (data < _LAST)
    seen = np.bincount(
        owner[printable] * (_LAST - _FIRST) + (data[printable].astype(np.int64) - _FIRST),
        minlength=n * (_LAST - _FIRST),
    ).reshape(n, -1)
    shares[:, : _LAST - _FIRST] = np.sqrt(seen / np.maximum(1, sizes)[:, None])
    counts = np.maximum(1, words.counts)
    of = np.repeat(np.arange(n), words.counts)
    hashes = words.hashes()
    lengths = words.ends - words.starts
    upper = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data >= 65) & (data <= 90), out=upper[1:])
    capitals = upper[words.ends] - upper[words.starts]
    extra = [
        np.log1p(words.counts),
        np.log1p(sizes),
        np.bincount(of, weights=lengths, minlength=n) / counts,
        np.sqrt(np.bincount(of, weights=lengths.astype(float) ** 2, minlength=n) / counts),
        np.bincount(of, weights=capitals * 2 > lengths, minlength=n) / counts,
        1 - _distinct(of, hashes, n) / counts,
    ]
    for size in (2, 3):
        room = words.window_room(size)
        windows = np.maximum(1, np.bincount(of[room], minlength=n))
        extra.append(1 - _distinct(of[room], rolling(hashes, size)[room], n) / windows)
    # A line is named by the hash of its words: position of the last break before them.
    breaks = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(data == 0x0A, out=breaks[1:])
    line = breaks[words.starts] + of
    fresh = np.flatnonzero(np.diff(line, prepend=-1))
    place = np.arange(len(line)) - np.repeat(fresh, np.diff(np.append(fresh, len(line))))
    if len(fresh):
        # Wrapping sums of word hashes times odd places name the lines.
        named = np.add.reduceat(hashes * (2 * place.astype(np.uint64) + np.uint64(1)), fresh)
    else:
        named = np.empty(0, dtype=np.uint64)
    lines = np.bincount(of[fresh], minlength=n)
    extra.append(1 - _distinct(of[fresh], named, n) / np.maximum(1, lines))
    extra.append(np.log1p(words.counts / np.maximum(1, lines)))
    shares[:, _LAST - _FIRST :] = np.stack(extra, axis=1)
    shares[words.counts == 0] = 0
    return shares


@dataclass(frozen=True)
class Ranking:
    """A linear score on standardized features and the score that is the cut."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    at_cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = self.raw(x) - self.at_cut + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _rows_of(blobs: pa.Array) -> np.ndarray:
    """The stored feature rows of a column as one array."""
    held = np.frombuffer(b"".join(blobs.to_pylist()), dtype=np.float32)
    return held.reshape(-1, N_FEATURES).astype(float)


def _collect_parts(
    frame: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], merge: Callable
) -> np.ndarray | None:
    """Merge what ``part`` makes of every batch: in each task, in a few tasks, on the driver.

    ``merge`` joins two parts. None if the frame has no rows.
    """

    def merged(found: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        total = None
        for one in found:
            total = one if total is None else merge(total, one)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return merged(part(batch) for batch in batches if batch.num_rows)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Neither the order of tasks nor of parts is fixed; sorted ones always have the same sum.
        blobs = [blob for batch in batches for blob in batch.column("part").to_pylist()]
        return merged(np.frombuffer(blob) for blob in sorted(blobs))

    parts = frame.mapInArrow(first, "part binary").repartition(MERGERS).mapInArrow(again, "part binary")
    found = sorted(bytes(row["part"]) for row in parts.collect())
    return reduce(merge, map(np.frombuffer, found)) if found else None


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(mark, quality, x, w): the features of every labelled row, w equal rows as one.

    Labels that repeat a doc_id count once, the largest quality. Features are
    taken before the join, as texts are many times their size, and labels, which
    grow with the documents, are not broadcast at any size.
    """
    known = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.max("quality").cast("int").alias("quality")
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in chunks(whole, "text")):
            x = features(batch.column("text")).astype(np.float32)
            blobs = pa.array([v.tobytes() for v in x], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), blobs], ["doc_id", "mark", "x"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        docs.filter("doc_id IS NOT NULL")
        .select("doc_id", F.xxhash64("doc_id", "text").alias("mark"), "text")
        .mapInArrow(rows, f"doc_id {kind}, mark long, x binary")
        .join(known.hint("merge"), "doc_id")
        .groupBy("mark", "quality", "x")
        .agg(F.count("*").alias("w"))
    )


def _moments(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Mean and deviation of every feature over all labelled rows."""

    def part(batch: pa.RecordBatch) -> np.ndarray:
        x, w = _rows_of(batch.column("x")), batch.column("w").to_numpy().astype(float)
        mean = w @ x / w.sum()
        return np.concatenate([[w.sum()], mean, w @ (x - mean) ** 2])

    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n, shift = a[0] + b[0], b[1 : N_FEATURES + 1] - a[1 : N_FEATURES + 1]
        mean = a[1 : N_FEATURES + 1] + shift * (b[0] / n)
        rest = a[N_FEATURES + 1 :] + b[N_FEATURES + 1 :] + shift**2 * (a[0] * b[0] / n)
        return np.concatenate([[n], mean, rest])

    total = _collect_parts(labelled.select("x", "w"), part, merge)
    if total is None:
        return None
    scale = np.sqrt(total[N_FEATURES + 1 :] / total[0])
    return total[1 : N_FEATURES + 1], np.where(scale > 1e-9, scale, 1.0)


def _groups(labelled: DataFrame, good: int, bad: int) -> DataFrame:
    """(g, goods, bads): rows of both labels dealt into groups of bounded size.

    A row's group is named by its hash. Every group gets about ``RARE`` rows of
    the rarer label or more, so those stand in several groups where they are few.
    """
    count = max(1, -(-(good + bad) // GROUP_ROWS))
    fewer = min(good, bad)
    copies = min(count, -(-RARE * count // fewer))
    home = F.pmod(F.xxhash64("mark", "x"), F.lit(count))
    times = F.when(F.col("quality") == int(good <= bad), copies).otherwise(1)
    spread = F.explode(F.sequence(F.lit(0), times - 1)).alias("copy")
    dealt = labelled.select("quality", "x", "w", home.alias("home"), spread).withColumn(
        "g", F.pmod(F.col("home") + F.col("copy") * (count // copies), F.lit(count))
    )
    rows = F.struct("x", "w")
    return dealt.groupBy("g").agg(
        *[
            # Sorted rows make the same pairs every time.
            F.sort_array(F.collect_list(F.when(F.col("quality") == q, rows))).alias(name)
            for name, q in (("goods", 1), ("bads", 0))
        ]
    )


def _pair_sums(
    groups: DataFrame, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, partners: int
) -> np.ndarray | None:
    """Gradient and Hessian of the pairs' likelihood at the weights, over all groups.

    Both labels of a group are shuffled and go round side by side ``partners``
    times the longer list, so every row is in as many pairs or more.
    """

    def part(batch: pa.RecordBatch) -> np.ndarray:
        total = np.zeros(N_FEATURES * (N_FEATURES + 1))
        for g, *lists in zip(*(batch.column(c) for c in ("g", "goods", "bads"))):
            random = np.random.default_rng(g.as_py())
            z, w = [], []
            for held in (one.values for one in lists):
                order = random.permutation(len(held))
                x = _rows_of(held.field("x"))
                z.append(np.clip((x - mean) / scale, -8, 8)[order])
                w.append(held.field("w").to_numpy().astype(float)[order])
            if not (len(z[0]) and len(z[1])):
                continue
            n = max(len(z[0]), len(z[1]))
            # Each round moves one list on, or rows would meet the same row again.
            turn = np.repeat(random.integers(0, n, partners), n)
            at = np.tile(np.arange(n), partners)
            a, b = at % len(z[0]), (at + turn) % n % len(z[1])
            for low in range(0, len(a), PAIRS):
                i, j = a[low : low + PAIRS], b[low : low + PAIRS]
                d, times = z[0][i] - z[1][j], w[0][i] * w[1][j]
                p = 1 / (1 + np.exp(-np.clip(d @ weights, -30, 30)))
                total[:N_FEATURES] += d.T @ (times * (p - 1))
                total[N_FEATURES:] += ((d * (times * p * (1 - p))[:, None]).T @ d).ravel()
        return total

    return _collect_parts(groups, part, np.add)


def _at_rank(scores: DataFrame, rank: int) -> float:
    """The value at a rank from 0 of ``raw``, each standing ``w`` times; exact.

    Counts in ``BINS`` equal parts of the range tell which part holds the rank,
    and that part is divided again until it holds one value.
    """
    low, high = scores.agg(F.min("raw"), F.max("raw")).first()
    while low < high:
        width = (high - low) / BINS
        held = scores.filter(F.col("raw").between(low, high))
        # A width too small for a double puts every value but the largest apart from it.
        place = F.floor((F.col("raw") - low) / width) if width else (F.col("raw") == high).cast("long")
        before = rank
        bins = held.groupBy(F.least(place, F.lit(BINS - 1)).alias("bin")).agg(
            F.sum("w").alias("n"), F.min("raw").alias("low"), F.max("raw").alias("high")
        )
        for part in sorted(bins.collect(), key=lambda r: r["bin"]):
            if before < part["n"]:
                rank, low, high = before, part["low"], part["high"]
                break
            before -= part["n"]
    return low


def _quantile(scores: DataFrame, share: float, n: int) -> float:
    """The quantile of ``raw`` between its two neighbours in rank, as numpy takes it."""
    place = share * (n - 1)
    first = min(int(place), n - 1)
    value = _at_rank(scores, first)
    if first + 1 >= n or place == first:
        return value
    return value + (place - first) * (_at_rank(scores, first + 1) - value)


def learn_ranking(
    docs: DataFrame, labels: DataFrame, partners: int = PARTNERS, penalty: float = 1.0
) -> Ranking:
    """Bradley-Terry by Newton steps: P(a preferred to b) = sigmoid(score a - score b).

    Every labelled row counts for mean and deviation, is in ``partners`` pairs of
    a good and a bad row or more (at least ``PAIRS`` pairs are made), and counts
    for the cut, the score quantile at the share of bad rows. Each is a Spark job
    over the stored features; sums reach the driver. Without both labels every
    score is at the cut.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    labelled = scratch.store("labelled", _labelled(docs, labels))
    counts = labelled.groupBy("quality").agg(F.count("*").alias("rows"), F.sum("w").alias("n"))
    found = {row["quality"]: row for row in counts.collect()}
    moments = _moments(labelled)
    if moments is None:
        scratch.drop("labelled")
        return Ranking(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0)
    mean, scale = moments
    weights = np.zeros(N_FEATURES)
    if len(found) == 2:
        good, bad = found[1]["rows"], found[0]["rows"]
        times = max(partners, -(-PAIRS // max(good, bad)))
        groups = scratch.store("groups", _groups(labelled, good, bad))
        for _ in range(12):
            sums = _pair_sums(groups, mean, scale, weights, times)
            gradient = sums[:N_FEATURES] + penalty * weights
            hessian = sums[N_FEATURES:].reshape(N_FEATURES, -1) + penalty * np.eye(N_FEATURES)
            step = np.linalg.solve(hessian, gradient)
            weights = weights - step
            if np.abs(step).max() < 1e-6:
                break
        scratch.drop("groups")
    flat = Ranking(mean, scale, weights, 0.0)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(flat.raw(_rows_of(batch.column("x"))))
            yield pa.RecordBatch.from_arrays([scores, batch.column("w")], ["raw", "w"])

    scores = scratch.store("raw", labelled.select("x", "w").mapInArrow(raw, "raw double, w long"))
    n = sum(row["n"] for row in found.values())
    share = found[0]["n"] / n if 0 in found else 0.0
    at_cut = _quantile(scores, share, n)
    scratch.drop("labelled", "raw")
    return Ranking(mean, scale, weights, at_cut)


def score_quality(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """Score every document by a fitted ranking.

    Returns doc_id, score, predicted, one row per row of ``docs``. A text
    that is null or has no word scores 0. Repeated rows score alike; a null
    doc_id is returned as it is; only doc_id and text are read.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in chunks(whole, "text")):
            x = features(batch.column("text"))
            scores = np.where(x.any(axis=1), ranking.scores(x), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), pa.array((scores >= CUT).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        score, f"doc_id {kind}, score double, predicted int"
    )


def classify_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from all labels outside the held-out fold and score all documents.

    Returns doc_id, held_out, score, predicted.
    """
    ranking = learn_ranking(docs.filter(~held_out()), labels.filter(~held_out()))
    return score_quality(docs, ranking).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted"
    )
