"""Substring deduplication with difference-cover anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.scratch import Scratch
from orderloom.llm.words import Words, chunks, rolling, text_marks

#: Words in a window.
WINDOW = 20
#: A perfect difference set: any two places modulo the period can be moved on
#: by the same number of words, less than the period, so that both are covered.
PERIOD, COVER = 13, (0, 1, 3, 9)

_NO_ID = (1 << 63) - 1


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    """doc_id with null as the largest number."""
    return batch.column("doc_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)


def _anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the covered words that begin an anchor, their hashes)."""
    size = window - PERIOD + 1
    covered = np.zeros(PERIOD, dtype=bool)
    covered[list(COVER)] = True
    at = np.flatnonzero(covered[words.places() % PERIOD] & words.window_room(size))
    return at, rolling(words.hashes(), size)[at].view(np.int64)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        yield from chunks(whole, "text")


def _anchor_counts(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            values, counts = np.unique(_anchors(Words(batch.column("text")), window)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values), pa.array(np.minimum(counts, 2).astype(np.int32))], ["anchor", "n"]
            )

    return run


def _anchor_places(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            words = Words(batch.column("text"))
            at, anchors = _anchors(words, window)
            of = np.repeat(np.arange(len(words.counts)), words.counts)[at]
            place = (words.places()[at] << 31) | text_marks(batch.column("text"))[of]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors), pa.array(_ids(batch)[of]), pa.array(place)],
                ["anchor", "doc", "place"],
            )

    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(owner, value) of a list column; a null list is empty."""
    lists = column.fill_null([]) if column.null_count else column
    sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten().to_numpy(zero_copy_only=False)


def _open_windows(words: Words, owner: np.ndarray, anchors: np.ndarray, window: int) -> np.ndarray:
    """Numbers of the words from which a window holds a shared anchor."""
    marks = np.zeros(len(words.starts) + 1, dtype=np.int64)
    at = words.bounds[owner] + anchors
    # An anchor opens the windows that begin up to PERIOD - 1 words before it.
    low = np.maximum(words.bounds[owner], at - (PERIOD - 1))
    np.add.at(marks, low, 1)
    np.add.at(marks, at + 1, -1)
    return np.flatnonzero((np.cumsum(marks)[:-1] > 0) & words.window_room(window))


def _digest(words: Words, d: int, keep: np.ndarray | None = None) -> str:
    """SHA-256 of a document's kept words joined by one space."""
    a, b = words.bounds[d], words.bounds[d + 1]
    starts, ends = words.starts[a:b], words.ends[a:b]
    if keep is not None:
        starts, ends = starts[keep], ends[keep]
    raw = words.raw
    if len(starts) == 0:
        return hashlib.sha256(b"").hexdigest()
    low, high = starts[0], ends[-1]
    part = raw[low:high]
    # Space outside words goes, except one blank before each word but the first.
    marks = np.zeros(high - low + 1, dtype=np.int8)
    marks[starts - low] += 1
    marks[ends - low] -= 1
    inside = np.cumsum(marks[:-1]) > 0
    joined = np.where(inside, part, np.uint8(0x20))
    take = inside.copy()
    take[starts[1:] - low - 1] = True
    return hashlib.sha256(joined[take].tobytes()).hexdigest()


def _open_documents(window: int):
    """Finished rows of documents without an open window; the others with their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            words = Words(batch.column("text"))
            owner, anchors = _flat(batch.column("anchors"))
            opened = np.zeros(len(words.counts), dtype=bool)
            windows = _open_windows(words, owner, anchors, window)
            opened[np.searchsorted(words.bounds, windows, "right") - 1] = True
            digests = [None if opened[d] else _digest(words, d) for d in range(len(opened))]
            closed = pa.array(~opened)
            hide = pa.nulls(len(opened))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(words.counts.astype(np.int64)),
                    pa.array(digests, pa.string()),
                    pc.if_else(closed, hide.cast(pa.string()), batch.column("text").cast(pa.string())),
                    pc.if_else(closed, hide.cast(pa.list_(pa.int32())), batch.column("anchors").cast(pa.list_(pa.int32()))),
                ],
                ["doc_id", "n_words", "kept_sha256", "text", "anchors"],
            )

    return run


def _window_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            words = Words(batch.column("text"))
            at = _open_windows(words, *_flat(batch.column("anchors")), window)
            of = np.searchsorted(words.bounds, at, "right") - 1
            place = ((at - words.bounds[of]) << 31) | text_marks(batch.column("text"))[of]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rolling(words.hashes(0), window)[at].view(np.int64)),
                    pa.array(rolling(words.hashes(1), window)[at].view(np.int64)),
                    pa.array(_ids(batch)[of]),
                    pa.array(place),
                ],
                ["a", "b", "doc", "place"],
            )

    return run


def _cut_documents(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            words = Words(batch.column("text"))
            owner, starts = _flat(batch.column("repeats"))
            marks = np.zeros(len(words.starts) + window + 1, dtype=np.int64)
            at = words.bounds[owner] + starts
            np.add.at(marks, at, 1)
            np.add.at(marks, at + window, -1)
            removed = np.cumsum(marks)[: len(words.starts)] > 0
            rows = []
            for d, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:])):
                gone = removed[a:b]
                rows.append((int(gone.sum()), _digest(words, d, ~gone)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_words"),
                    pa.array([n for n, _ in rows], pa.int64()),
                    pa.array([s for _, s in rows], pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return run


def _marked(frame: DataFrame) -> DataFrame:
    """The join keys of a document: doc (null last) and the mark of its text."""
    return frame.withColumns(
        {
            "doc": F.coalesce("doc_id", F.lit(_NO_ID)),
            "mark": F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).bitwiseAND(F.lit(0x7FFFFFFF)),
        }
    )


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Remove words that lie in a window of words which also starts earlier.

    A window is ``window`` consecutive words of one document; earlier means a
    smaller doc_id, or the same document and an earlier word. Windows are
    judged on the input. All repeats are found:

    1. Anchors, short windows at cover places modulo the period, are hashed
       and counted. Two equal windows always share an aligned anchor, so a
       window without a shared anchor is unique.
    2. Windows around shared anchors are extended to their full length,
       hashed with 128 bits, and compared with the first place of that hash.
    3. Documents with repeats are cut.

    Counts combine before the shuffle and joins are plain equalities against
    written tables, so adaptive execution splits a passage that is
    everywhere; no pair of documents is ever made.

    Returns doc_id, n_words, n_removed, kept_sha256, one row per row. A null
    or empty text has no words. A null doc_id counts as the largest. Rows
    that repeat a doc_id are judged as one document whose rows lie side by
    side: equal windows at equal places do not remove each other. Other
    columns are not read.
    """
    if window < PERIOD:
        raise ValueError(f"a window has at least {PERIOD} words")
    scratch = Scratch(docs.sparkSession, "substring-dedup")
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = scratch.store(
        "anchors",
        texts.select("text")
        .mapInArrow(_anchor_counts(window), "anchor long, n int")
        .groupBy("anchor")
        .agg(F.sum("n").alias("n"))
        .filter("n > 1")
        .select("anchor"),
    )
    places = scratch.store(
        "places",
        texts.mapInArrow(_anchor_places(window), "anchor long, doc long, place long")
        .join(shared, "anchor")
        .groupBy("doc", F.col("place").bitwiseAND(F.lit(0x7FFFFFFF)).alias("mark"))
        .agg(F.collect_set(F.shiftright("place", 31).cast("int")).alias("anchors")),
    )
    opened = scratch.store(
        "opened",
        _marked(texts)
        .join(places, ["doc", "mark"], "left")
        .select("doc_id", "text", "anchors")
        .mapInArrow(
            _open_documents(window),
            "doc_id long, n_words long, kept_sha256 string, text string, anchors array<int>",
        ),
    )
    whole = opened.filter("kept_sha256 is not null").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256"
    )
    cut = opened.filter("kept_sha256 is null")
    windows = cut.select("doc_id", "text", "anchors").mapInArrow(
        _window_rows(window), "a long, b long, doc long, place long"
    )
    first = scratch.store(
        "first",
        windows.groupBy("a", "b")
        .agg(F.min(F.struct("doc", "place")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("a", "b", F.col("first.doc").alias("first_doc"), F.shiftright("first.place", 31).alias("first_start")),
    )
    start = F.shiftright("place", 31)
    repeats = scratch.store(
        "repeats",
        windows.join(first, ["a", "b"])
        .filter((F.col("doc") > F.col("first_doc")) | (start > F.col("first_start")))
        .groupBy("doc", F.col("place").bitwiseAND(F.lit(0x7FFFFFFF)).alias("mark"))
        .agg(F.collect_set(start.cast("int")).alias("repeats")),
    )
    pruned = (
        _marked(cut)
        .join(repeats, ["doc", "mark"], "left")
        .select("doc_id", "text", "n_words", "repeats")
        .mapInArrow(
            _cut_documents(window), "doc_id long, n_words long, n_removed long, kept_sha256 string"
        )
    )
    return scratch.finish(
        whole.unionByName(pruned).withColumn("doc_id", F.col("doc_id").cast(kind))
    )
