"""Fuzzy line deduplication by MinHash; shingles are cut by numpy, batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.components import link_rounds
from orderloom.llm.scratch import Scratch
from orderloom.llm.words import SPAN, mix

#: Bytes of UTF-8 in a character shingle; similarity in percent.
SHINGLE, PERCENT = 8, 80
#: Top bits of a hash that choose its bin, and bits of a bin that choose its
#: band: 64 bins in 16 bands. Two lines of similarity 0.8 miss every band with
#: probability (1 - 0.8**4)**16, about 2 in 10,000.
BIN_BITS, BAND_BITS = 6, 4
#: A line's sketch: so many bits of each bin's minimum, in 64-bit words. Lines of similarity
#: 0.8 differ in 25.6 of its 256 bits, with a deviation of 7.3; pairs that differ in more
#: than ``APART``, 1 or 2 in 100,000 of these, are not verified.
SKETCH_BITS, SKETCH_WORDS, APART = 4, 4, 58
#: Parts in which tokens are brought together.
PASSES = 2
SKETCH = [f"s{i}" for i in range(SKETCH_WORDS)]


def _lines(docs: DataFrame) -> Column:
    return F.split(F.coalesce(F.col("text"), F.lit("")), "\n")


def _spans(lines: pa.Array, *others: pa.Array) -> Iterator[slice]:
    """Consecutive rows of about ``SPAN`` bytes of text, one row at least."""
    sizes = sum(pc.binary_length(a).to_numpy().astype(np.int64) for a in (lines, *others))
    span = (np.cumsum(sizes) - sizes) // SPAN
    edges = [0, *(np.flatnonzero(np.diff(span)) + 1).tolist(), len(sizes)]
    for begin, end in zip(edges, edges[1:]):
        if begin < end:
            yield slice(begin, end)


def _shingles(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all lines, and where each line's begin.

    A shingle is its bytes as a number, mixed without loss. A line shorter than a
    shingle has none: it is like no other line.
    """
    lines = lines.cast(pa.large_string())
    bounds = np.frombuffer(lines.buffers()[1], dtype=np.int64)
    bounds = bounds[lines.offset : lines.offset + len(lines) + 1]
    counts = np.maximum(np.diff(bounds) - (SHINGLE - 1), 0)
    first = np.concatenate([[0], np.cumsum(counts)])
    if not first[-1]:
        return np.empty(0, dtype=np.uint64), first
    data = np.frombuffer(lines.buffers()[2], dtype=np.uint8)
    grams = np.ndarray(len(data) - (SHINGLE - 1), dtype="<u8", buffer=data, strides=(1,))
    hashes = mix(grams[np.arange(first[-1]) + np.repeat(bounds[:-1] - first[:-1], counts)])
    edges = first.tolist()
    for begin, end in zip(edges, edges[1:]):
        hashes[begin:end].sort()
    new = np.empty(len(hashes), dtype=bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[first[:-1][counts > 0]] = True
    return hashes[new], np.concatenate([[0], np.cumsum(new)])[first]


def _tokens(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One hash per line and band that has a value, of the band's minima; where each line's begin.

    A minimum is the smallest hash of a bin; the bin is the hash's top bits, so
    the minima of a band are neighbours.
    """
    lines = len(bounds) - 1
    owner = np.repeat(np.arange(lines), np.diff(bounds))

    def opens(bits: int) -> np.ndarray:
        top = hashes >> np.uint64(64 - bits)
        new = np.ones(len(top), dtype=bool)
        new[1:] = (top[1:] != top[:-1]) | (owner[1:] != owner[:-1])
        return new

    low = opens(BIN_BITS)
    hashes, owner = hashes[low], owner[low]
    begin = np.flatnonzero(opens(BAND_BITS))
    length = np.diff(np.append(begin, len(hashes)))
    tokens = mix(hashes[begin])
    for k in range(1, 1 << (BIN_BITS - BAND_BITS)):
        more = length > k
        tokens[more] = mix(tokens[more] ^ hashes[begin[more] + k])
    held = np.bincount(owner[begin], minlength=lines)
    return tokens.view(np.int64), np.concatenate([[0], np.cumsum(held)])


def _sketches(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The words of each line's sketch: the low bits of its bins' minima, 0 for an empty bin."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    top = (hashes >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    low = np.ones(len(top), dtype=bool)
    low[1:] = (top[1:] != top[:-1]) | (owner[1:] != owner[:-1])
    per_word = 64 // SKETCH_BITS
    bits = hashes[low] & np.uint64((1 << SKETCH_BITS) - 1)
    words = np.zeros((len(bounds) - 1, SKETCH_WORDS), dtype=np.uint64)
    shift = (top[low] % per_word * SKETCH_BITS).astype(np.uint64)
    np.bitwise_or.at(words, (owner[low], top[low] // per_word), bits << shift)
    return words.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(c, line) to (c, n, tokens, s0, ...): a line's number of shingles, its tokens and its sketch."""
    for batch in batches:
        for span in _spans(batch["line"]):
            part = batch.slice(span.start, span.stop - span.start)
            hashes, bounds = _shingles(part["line"])
            tokens, edges = _tokens(hashes, bounds)
            listed = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(tokens))
            words = [pa.array(w.copy()) for w in _sketches(hashes, bounds).T]
            yield pa.RecordBatch.from_arrays(
                [part["c"], pa.array(np.diff(bounds), pa.int64()), listed, *words],
                ["c", "n", "tokens", *SKETCH],
            )


def _near(one: str, two: str) -> Column:
    """Whether the sizes and sketches of two signed lines allow the similarity."""
    bits = " + ".join(f"bit_count({one}.{s} ^ {two}.{s})" for s in SKETCH)
    sizes = f"100 * least({one}.n, {two}.n) >= {PERCENT} * greatest({one}.n, {two}.n)"
    return F.expr(f"{sizes} AND {bits} <= {APART}")


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, line, other) to the (a, b) whose whole shingle sets have the similarity."""
    for batch in batches:
        for span in _spans(batch["line"], batch["other"]):
            part = batch.slice(span.start, span.stop - span.start)
            (one, at), (two, to) = _shingles(part["line"]), _shingles(part["other"])
            held, met = np.diff(at) + np.diff(to), []
            for i in range(len(part)):
                pair = np.concatenate((one[at[i] : at[i + 1]], two[to[i] : to[i + 1]]))
                pair.sort()
                met.append(np.count_nonzero(pair[1:] == pair[:-1]))
            both = np.array(met, dtype=np.int64)
            links = pa.array((both > 0) & (100 * both >= PERCENT * (held - both)))
            yield part.select(["a", "b"]).filter(links)


def _postings(scratch: Scratch, signed: DataFrame) -> DataFrame:
    """(token, c, pivot) of the tokens that several items have; the pivot is the smallest.

    Tokens go through in ``PASSES`` parts, so a shuffle holds one part only.
    """
    parts = []
    for part in range(PASSES):
        mine = F.filter("tokens", lambda t: F.pmod(t, F.lit(PASSES)) == part)
        tokens = signed.select("c", F.explode(mine).alias("token"))
        counted = tokens.groupBy("token").agg(
            F.count("*").alias("items"),
            F.min("c").alias("pivot"),
            F.max("c").alias("top"),
            F.bit_xor("c").alias("rest"),
        )
        shared = scratch.store(f"shared-{part}", counted.filter("items > 1"))
        # Two or three items are known from the counts: only other tokens are met again.
        middle = F.col("rest").bitwiseXOR(F.col("pivot")).bitwiseXOR(F.col("top"))
        few = F.when(F.col("items") == 2, F.array("pivot", "top")).otherwise(F.array("pivot", middle, "top"))
        few = shared.filter("items < 4").select("token", F.explode(few).alias("c"), "pivot")
        many = shared.filter("items > 3").select("token", "pivot")
        many = tokens.join(many, "token").select("token", "c", "pivot")
        parts.append(scratch.store(f"met-{part}", few.unionByName(many)))
        scratch.drop(f"shared-{part}")
    return reduce(DataFrame.unionByName, parts)


def line_dedup(docs: DataFrame) -> DataFrame:
    """Keep one line of each group of nearly equal lines in the corpus.

    Equal lines are one item. Items whose shingle sets have a Jaccard
    similarity of at least 0.8 are linked, and of each connected component
    the first line (smallest doc_id, then place) stays. Candidates come from
    one-permutation MinHash bands; those whose sizes and sketches are near
    enough are verified on the whole shingle sets, and components are joined round by round, so a group of a third of
    all lines makes stars and no pairs.

    Returns doc_id, n_lines, n_removed, text (the lines that stay), one row
    per row. Lines without a visible character always stay. A null text is
    one empty line. A null doc_id counts as the largest; rows that repeat a
    doc_id are told apart by their text, and rows that repeat both are cut
    alike. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "line-dedup")
    no_id = F.lit((1 << 63) - 1)
    texts = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), no_id).alias("doc"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("mark"),
        _lines(docs).alias("lines"),
    )
    placed = texts.select("doc", "mark", F.posexplode("lines").alias("place", "line")).filter(
        F.col("line").rlike(r"[^\x20\x09-\x0D]")
    )
    items = scratch.store(
        "items", placed.select(F.xxhash64("line").alias("c"), "line").distinct()
    )
    signed = scratch.store(
        "signed",
        items.mapInArrow(_signed, "c long, n long, tokens array<long>, " + ", ".join(f"{s} long" for s in SKETCH)),
    )
    postings = _postings(scratch, signed)
    met = postings.select("c").distinct()
    sketches = scratch.store(
        "sketches", signed.join(met, "c", "left_semi").select("c", F.struct("n", *SKETCH).alias("m"))
    )
    # Hashes are many times the text, so lines travel and are cut again.
    lines = scratch.store("lines", items.join(met, "c", "left_semi"))
    scratch.drop("signed", "items")
    pivots = lines.select(F.col("c").alias("pivot"), F.col("line").alias("other"))

    def verify(pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(lines, "c")
            .join(pivots, "pivot")
            .select(F.col("pivot").alias("a"), F.col("c").alias("b"), "line", "other")
            .mapInArrow(_alike, "a long, b long")
        )

    labels = link_rounds(scratch, "round", postings, sketches, _near("m", "pivot_m"), verify)
    own = placed.select("doc", "mark", "place", F.xxhash64("line").alias("c"))
    if labels is not None:
        own = own.join(labels, own["c"] == labels["node"], "left").select(
            "doc", "mark", "place", F.coalesce("label", "c").alias("label")
        )
    else:
        own = own.withColumnRenamed("c", "label")
    own = scratch.store("own", own)
    scratch.drop("lines", "sketches")
    # Most lines are alone in their group; only the others look for the first one.
    several = own.groupBy("label").count().filter("count > 1").select("label")
    several = scratch.store("several", own.join(several, "label"))
    kept = several.groupBy("label").agg(F.min(F.struct("doc", "mark", "place")).alias("keep"))
    removed = (
        several.join(kept, "label")
        .filter(F.struct("doc", "mark", "place") != F.col("keep"))
        .groupBy("doc", "mark")
        .agg(F.collect_set("place").alias("gone"))
    )
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone)
    return scratch.finish(
        texts.join(scratch.store("removed", removed), ["doc", "mark"], "left").select(
            "doc_id",
            F.size("lines").cast("long").alias("n_lines"),
            F.size(gone).cast("long").alias("n_removed"),
            F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n").alias("text"),
        )
    )
