"""N-gram Jaccard join on prefix trees, and the classes it links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.components import components
from orderloom.llm.scratch import Scratch, free_name
from orderloom.llm.words import Words, chunks, mix, rolling, text_marks

#: Words in a shingle; similarity in percent.
SHINGLE, PERCENT = 5, 80
#: Tokens of the sets in one trie, about.
BLOCK = 1 << 18

_NO_ID = (1 << 63) - 1
#: What tells one row from others: its doc_id, its text's mark and a hash of the text.
AT = ["doc", "mark", "key"]


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, sorted distinct 64-bit shingle hashes) of each text's set.

    Fewer words than a shingle make one shingle; no words make an empty set.
    """
    words = Words(texts, lower=True)
    hashes, n = words.hashes(), len(words.counts)
    whole = rolling(hashes, size)
    room = words.window_room(size)
    of = np.repeat(np.arange(n), words.counts)
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    # A short text's one shingle also knows its length.
    lone = np.array(
        [mix(rolling(hashes[words.bounds[d] : words.bounds[d + 1]], k)[:1] + np.uint64(k))[0]
         for d, k in zip(short, words.counts[short])],
        dtype=np.uint64,
    )
    owner = np.concatenate([of[room], short])
    value = np.concatenate([whole[room], lone]).view(np.int64)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(owner), dtype=bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[fresh], value[fresh]
    return np.searchsorted(owner, np.arange(n + 1)), value


def _needed(n: np.ndarray) -> np.ndarray:
    """Smallest overlap of a set of n with any set it links to."""
    return -(-PERCENT * n // 100)


def _extra(n: np.ndarray) -> np.ndarray:
    """Tokens by which prefixes are longer than they must be."""
    return n // 10


def _set_class(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A fingerprint of each set; equal sets are one class."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(mix(values.view(np.uint64) ^ np.uint64(0xA5A5A5A5)), out=sums[1:])
    counts = np.diff(bounds).astype(np.uint64)
    return mix((sums[bounds[1:]] - sums[bounds[:-1]]) + counts * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each set's class, size and first tokens in the global (hash) order."""
    for batch in (part for whole in batches for part in chunks(whole, "text")):
        bounds, values = shingle_sets(batch.column("text"))
        n = np.diff(bounds)
        length = np.where(n > 0, n - _needed(n) + 1 + _extra(n), 0)
        ends = np.cumsum(length)
        take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(bounds[:-1] - (ends - length), length)
        tokens = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values[take])
        )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(text_marks(batch.column("text"))),
                batch.column("key"),
                pa.array(n.astype(np.int64)),
                pa.array(_set_class(values, bounds)),
                tokens,
            ],
            ["doc_id", "mark", "key", "n", "c", "prefix"],
        )


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in chunks(whole, "text")):
        bounds, values = shingle_sets(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("c"),
                pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values)),
            ],
            ["c", "tokens"],
        )


class Node:
    """A run of tokens on the way from the root, and the sets that end there."""

    __slots__ = ("run", "children", "ends", "least", "below")

    def __init__(self, run: np.ndarray):
        self.run, self.children, self.ends = run, {}, []
        self.least, self.below = 1 << 62, 0


class Probes:
    """Sets that traverse a trie together."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = np.array([len(tokens) for tokens in sets])
        owner = np.repeat(np.arange(len(sets)), self.n)
        self.tokens, place = np.unique(np.concatenate(sets), return_inverse=True)
        self.places = owner * len(self.tokens) + place
        self.starts = np.cumsum(self.n) - self.n
        order = np.argsort(place, kind="stable")
        self.owners = owner[order]
        self.bounds = np.searchsorted(place[order], np.arange(len(self.tokens) + 1))

    def holding(self, run: np.ndarray) -> np.ndarray:
        """How many tokens of the run each probe has."""
        at = np.searchsorted(self.tokens, run)
        at = at[self.tokens[np.minimum(at, len(self.tokens) - 1)] == run]
        rows = self.bounds[at + 1] - self.bounds[at]
        ends = np.cumsum(rows)
        take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.bounds[at] - (ends - rows), rows)
        return np.bincount(self.owners[take], minlength=len(self.n))

    def used(self, probes: np.ndarray, last: int) -> np.ndarray:
        """How many tokens these probes have up to the last one of a run."""
        rank = np.searchsorted(self.tokens, last, "right")
        return np.searchsorted(self.places, probes * len(self.tokens) + rank) - self.starts[probes]


class Trie:
    """Sets in one global order, sharing what they have in common at the front."""

    def __init__(self):
        self.root = Node(np.empty(0, dtype=np.int64))

    def insert(self, key: int, tokens: np.ndarray) -> None:
        node, rest, n = self.root, tokens, len(tokens)
        while True:
            node.least = min(node.least, n)
            node.below = max(node.below, len(rest))
            if not len(rest):
                node.ends.append((key, n))
                return
            child = node.children.get(int(rest[0]))
            if child is None:
                child = node.children[int(rest[0])] = Node(rest)
                child.least = n
                child.ends.append((key, n))
                return
            k = min(len(rest), len(child.run))
            unlike = np.flatnonzero(rest[:k] != child.run[:k])
            same = int(unlike[0]) if len(unlike) else k
            if same < len(child.run):
                upper = Node(child.run[:same])
                upper.least = child.least
                upper.below = child.below + len(child.run) - same
                child.run = child.run[same:]
                upper.children[int(child.run[0])] = child
                node.children[int(rest[0])] = upper
                child = upper
            node, rest = child, rest[same:]

    def linked(self, probes: Probes) -> Iterator[tuple[int, np.ndarray]]:
        """(key, probes) of the sets whose Jaccard similarity with some probes suffices.

        All probes go through the trie in one traversal. A node's overlaps
        count for every set below it. A probe leaves a subtree when its
        overlap so far and what both sides have left cannot reach the overlap
        that the smallest set there needs; a subtree without probes is left.
        """
        n = probes.n
        everyone = np.arange(len(n))
        stack = [(self.root, everyone, np.zeros(len(n), dtype=np.int64), np.zeros(len(n), dtype=np.int64))]
        while stack:
            node, alive, overlap, used = stack.pop()
            if len(node.run):
                overlap = overlap + probes.holding(node.run)[alive]
                used = probes.used(alive, node.run[-1])
            for key, m in node.ends:
                hit = alive[100 * overlap >= PERCENT * (n[alive] + m - overlap)]
                if len(hit):
                    yield key, hit
            for child in node.children.values():
                most = overlap + np.minimum(n[alive] - used, len(child.run) + child.below)
                keep = (100 + PERCENT) * most >= PERCENT * (n[alive] + child.least)
                if keep.any():
                    stack.append((child, alive[keep], overlap[keep], used[keep]))


def _block_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) between the labels of a block: each to the smallest it is joined with.

    Rows that are ``stored`` make a trie, rows that are ``probe`` traverse it.
    """
    labels, of = np.unique(rows["label"].to_numpy(dtype=np.int64), return_inverse=True)
    sets = [np.asarray(tokens, dtype=np.int64) for tokens in rows["tokens"]]
    trie = Trie()
    for i in np.flatnonzero(rows["stored"].to_numpy(dtype=bool)):
        trie.insert(int(i), sets[i])
    asking = np.flatnonzero(rows["probe"].to_numpy(dtype=bool))
    merged = np.arange(len(labels))
    if len(asking):
        for i, hit in trie.linked(Probes([sets[j] for j in asking])):
            met = np.unique(merged[np.append(of[asking[hit]], of[i])])
            if len(met) > 1:
                merged[np.isin(merged, met)] = met[0]
    moved = np.flatnonzero(merged != np.arange(len(labels)))
    return pd.DataFrame({"a": labels[moved], "b": labels[merged[moved]]})


def _block_of(size: str) -> Column:
    """Which of so many blocks a set is in."""
    return F.pmod(F.xxhash64("c"), F.col(size))


def _linked_classes(scratch: Scratch, postings: DataFrame, whole: DataFrame) -> DataFrame:
    """Labels (node, label) of the classes that link through ``postings`` (token, c, n).

    The smallest class of a token names its group, so the tokens that a family
    of near copies shares make few groups, and two classes that share a token
    meet in one. Groups of more than ``BLOCK`` tokens are split into blocks.

    First each block joins itself. Then, in groups of several blocks that are
    not one component, the classes outside the group's largest component go
    through the tries of all of its blocks. What links inside a block leaves it
    as a star.
    """
    low = postings.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high"))
    met = scratch.store(
        "met",
        postings.join(low.filter("low <> high").select("token", "low"), "token").select("low", "c", "n").distinct(),
    )
    large = scratch.store(
        "large",
        met.groupBy("low").agg(F.ceil(F.sum("n") / BLOCK).alias("blocks")).filter("blocks > 1"),
    )
    placed = met.join(large, "low", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    own = placed.select(
        "low", "c", _block_of("blocks").alias("block"), F.col("c").alias("label"),
        F.lit(True).alias("stored"), F.lit(True).alias("probe"),
    )
    links = own.join(whole, "c").groupBy("low", "block").applyInPandas(_block_links, "a long, b long")
    labels = scratch.store("labels-1", components(scratch, "inside", links))
    if not large.isEmpty():
        known = scratch.store(
            "known",
            met.join(large, "low")
            .join(labels, F.col("c") == F.col("node"), "left")
            .select("low", "c", "n", "blocks", F.coalesce("label", "c").alias("label")),
        )
        counted = known.groupBy("low", "label").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
        main = (
            counted.groupBy("low")
            .agg(F.max(F.struct("rows", "label", "n")).alias("main"), F.sum("n").alias("n"), F.count("*").alias("k"))
            .filter("k > 1")
            .select("low", F.col("main.label").alias("main"), F.ceil((F.col("n") - F.col("main.n")) / BLOCK).alias("parts"))
        )
        live = scratch.store("live", known.join(main, "low"))
        last = F.lit(1).cast("long")
        stored = live.select(
            "low", "c", "label", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - last)).alias("part"),
            _block_of("blocks").alias("block"), F.lit(True).alias("stored"), F.lit(False).alias("probe"),
        )
        probes = live.filter("label <> main").select(
            "low", "c", "label", _block_of("parts").alias("part"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - last)).alias("block"),
            F.lit(False).alias("stored"), F.lit(True).alias("probe"),
        )
        across = (
            stored.unionByName(probes)
            .join(whole, "c")
            .groupBy("low", "part", "block")
            .applyInPandas(_block_links, "a long, b long")
        )
        stars = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        labels = scratch.store("labels-2", components(scratch, "across", across.unionByName(stars)))
        scratch.drop("known", "live", "labels-1")
    scratch.drop("met", "large")
    return labels


def _candidates(scratch: Scratch, sets: DataFrame) -> DataFrame:
    """Classes (c) whose prefix has enough tokens that other classes have in theirs."""
    tokens = sets.select("c", "n", F.explode("prefix").alias("token"))
    shared = scratch.store(
        "shared",
        tokens.groupBy("token")
        .agg(F.min("c").alias("low"), F.max("c").alias("high"))
        .filter("low <> high")
        .select("token"),
    )
    least = F.floor(F.ceil(F.col("n") * PERCENT / 100) / 10) + 1
    held = tokens.join(shared, "token").groupBy("c", "n").agg(F.count_distinct("token").alias("held"))
    alive = scratch.store("alive", held.filter(F.col("held") >= least).select("c").distinct())
    scratch.drop("shared")
    return alive


def _postings(scratch: Scratch, whole: DataFrame) -> DataFrame:
    """(token, c, n) of the rarest tokens of each set, as many as any link must meet.

    Ordered by how many candidates have them, the first n - 0.8 n + 1 tokens of
    two sets that link have one in common. A passage of many texts stands at the
    end of that order, so it brings no pairs together.
    """
    tokens = whole.select("c", F.size("tokens").cast("long").alias("n"), F.explode("tokens").alias("token"))
    spread = tokens.groupBy("token").agg(F.count("*").alias("df"))
    ordered = (
        tokens.join(spread, "token")
        .groupBy("c", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("ordered"))
    )
    length = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1
    first = F.slice("ordered", F.lit(1), length.cast("int"))
    met = F.filter(first, lambda t: t["df"] > 1)
    return scratch.store(
        "postings", ordered.select("c", "n", F.explode(met).alias("t")).select("t.token", "c", "n")
    )


def _covered(scratch: Scratch, whole: DataFrame) -> DataFrame:
    """Classes (c) that may link: most of their tokens occur in other such classes.

    A set that links with another shares at least 80 % of its tokens with it. So
    a class with fewer tokens in all other candidates together links with none
    of them and is no candidate either; this is repeated while it pays. Texts
    that only share a passage with many others go here, however many they are,
    before any pair is made.
    """
    alive, step, left = whole.select("c"), 0, whole.count()
    while left:
        step += 1
        sets = whole.join(alive, "c", "left_semi") if step > 1 else whole
        tokens = sets.select("c", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
        met = tokens.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high"))
        counted = (
            tokens.join(met.filter("low <> high").select("token"), "token")
            .groupBy("c", "n")
            .agg(F.count("*").alias("k"))
        )
        alive = scratch.store(
            f"covered-{step}", counted.filter(100 * F.col("k") >= PERCENT * F.col("n")).select("c")
        )
        if step > 1:
            scratch.drop(f"covered-{step - 1}")
        before, left = left, alive.count()
        if 10 * left >= 9 * before:
            break
    return alive


def text_key() -> Column:
    return F.xxhash64(F.col("text").cast("binary"))


def row_key() -> list[Column]:
    """The columns ``AT`` of a row with doc_id and text."""
    mark = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).bitwiseAND(F.lit(0x7FFFFFFF))
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)), mark, text_key()]


def _judged(scratch: Scratch, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The set of each row, and of each class (c) its component's smallest row (kept)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = scratch.store(
        "sets",
        texts.withColumn("key", text_key()).mapInArrow(
            _prefixes, "doc_id long, mark long, key long, n long, c long, prefix array<long>"
        ),
    )
    # The prefix is emptied where there is no set, so only real sets are exploded.
    alive = _candidates(scratch, sets)
    doc = F.coalesce("doc_id", F.lit(_NO_ID))
    first = (
        sets.filter("n > 0")
        .groupBy("c")
        .agg(F.min(F.struct(doc.alias("doc"), "mark", "key")).alias("at"))
        .select("c", "at.*")
    )
    whole = scratch.store(
        "whole",
        texts.withColumns(dict(zip(AT, row_key())))
        .join(first.join(alive, "c"), AT)
        .dropDuplicates(["c"])
        .select("c", "text")
        .mapInArrow(_whole_sets, "c long, tokens array<long>"),
    )
    covered = _covered(scratch, whole)
    whole = scratch.store("candidates", whole.join(covered, "c", "left_semi"))
    scratch.drop("whole", "alive")
    postings = _postings(scratch, whole)
    labels = _linked_classes(scratch, postings, whole)
    scratch.drop("candidates", "postings")
    own = first.select("c", F.struct(*AT).alias("at"))
    labelled = own.join(labels, own["c"] == labels["node"], "left").select(
        "c", "at", F.coalesce("label", "c").alias("label")
    )
    labelled = scratch.store("labelled", labelled)
    least = labelled.groupBy("label").agg(F.min("at").alias("kept"))
    return sets, scratch.store("classes", labelled.join(least, "label").select("c", "kept"))


def ngram_components(docs: DataFrame) -> DataFrame:
    """Link documents by shingle similarity and give each its component.

    A document's set is its distinct 5-word shingles, ASCII lower-cased.
    Equal sets form a class and are joined once. Linked classes share tokens
    in the first part of their sets under any global order, so:

    1. Tokens of set prefixes that occur in two classes are kept, and classes
       with too few of them to link are done.
    2. Of these classes, those go whose whole set is not covered to 80 % by the
       others together, again and again: what shares a passage with many texts
       but resembles none makes no pairs.
    3. The rarest tokens of each set, by how many of these classes have them,
       are 20 % of the set and one; linked classes have one of them in common.
       Classes that share one meet in a group, and each block of a group is a
       prefix trie that its sets traverse together, sharing partial overlaps
       and leaving subtrees by remaining length.
    4. Links leave a block as stars and are contracted to components. In groups
       of several blocks, only classes outside the group's largest component
       still go through the other blocks; so two classes that share a token
       end in one component or have been compared.

    No posting is cut, and no table holds the pairs of a group.

    Returns doc_id, n_shingles, component_id, one row per row. A text
    without words has an empty set and is linked with nothing. A null doc_id
    counts as the largest, and stands in component_id only where no other
    exists. Rows that repeat a doc_id are judged by their own texts. Other
    columns are not read; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "ngram-join")
    kind = docs.schema["doc_id"].dataType.simpleString()
    sets, classes = _judged(scratch, docs)
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(
        F.nullif("kept.doc", F.lit(_NO_ID))
    )
    return scratch.finish(
        sets.select("doc_id", "n", "c")
        .join(classes, "c", "left")
        .select(
            F.col("doc_id").cast(kind).alias("doc_id"),
            F.col("n").alias("n_shingles"),
            component.cast(kind).alias("component_id"),
        )
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``: one of each component, and those without words.

    The row with the smallest doc_id stays, of several (a repeated or null
    doc_id) the one whose text has the smallest mark, and of rows equal in
    doc_id and text one. A null doc_id counts as the largest.
    """
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    sets, classes = _judged(scratch, docs)
    doc = F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc")
    rows = sets.select(doc, "mark", "key", "n").groupBy(*AT).agg(F.count("*").alias("rows"), F.max("n").alias("n"))
    chosen = classes.select("kept.*").distinct().unionByName(rows.filter("n = 0").select(*AT))
    kept = scratch.finish(rows.join(chosen, AT).select(*AT, "rows"), "kept")
    names = {name: free_name(docs, f"_near_{name}") for name in AT}
    keyed = docs.withColumns(dict(zip(names.values(), row_key())))
    found = keyed.join(kept.select(*AT).withColumnsRenamed(names), [*names.values()], "left_semi")
    if not kept.filter("rows > 1").isEmpty():
        found = found.dropDuplicates([*names.values()])
    return found.drop(*names.values())
