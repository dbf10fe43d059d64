"""Exact duplicates by deterministic block naming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.scratch import Scratch

#: Bytes in a block. Most documents are one block; longer ones take log2 rounds.
BLOCK_BYTES = 4096


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """One row per block: row, doc_id, sha, position, block count, text."""
    raw = F.col("raw")
    count = F.greatest(F.lit(1), F.ceil(F.octet_length(raw) / block_bytes)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), F.col("n_blocks") - 1),
        lambda i: F.substring(raw, i * block_bytes + 1, F.lit(block_bytes)),
    )
    whole = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("text_sha256"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw"),
    ).withColumn("n_blocks", count)
    return whole.select(
        "row", "doc_id", "text_sha256", "n_blocks", F.posexplode(cut).alias("pos", "block")
    ).withColumn("mark", F.xxhash64("block"))


def _names(scratch: Scratch, name: str, keys: DataFrame) -> DataFrame:
    """Distinct keys in sorted order with the integer each is named by.

    Tasks hold rising ranges and sort their keys, so the number is the key's
    place. Ranges are cut by a block's first bytes (and a hash among equal
    ones), so that the sample from which they are chosen holds no whole
    blocks. The table is written before it is read, so every reader sees the
    same numbers.
    """
    columns = keys.columns
    distinct = keys.distinct()
    ranges = (
        [F.substring("block", 1, 16), F.xxhash64("block")] if columns == ["block"] else columns
    )
    ordered = distinct.repartitionByRange(*ranges).sortWithinPartitions(*columns)
    return scratch.store(name, ordered.withColumn("name", F.monotonically_increasing_id()))


def _pairs(names: Column) -> Column:
    """Adjacent names two by two; the last may stand alone."""
    return F.transform(
        F.sequence(F.lit(0), ((F.size(names) - 1) / 2).cast("int")),
        lambda i: F.struct(
            F.get(names, i * 2).alias("first"), F.get(names, i * 2 + 1).alias("second")
        ),
    )


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Group documents with equal text and say which row of each group stays.

    A text is cut into fixed-size blocks of bytes. Blocks are sorted, and a
    block's integer name is its place; adjacent names are paired, the pairs
    sorted and named in turn, until each document has one name. Two documents
    have the same name after the same number of rounds if and only if their
    bytes are equal: no hash decides.

    A block whose fingerprint occurs once cannot equal another block, so it
    is not sorted: its document stands alone. That spares moving most text
    through the sort; blocks that share a fingerprint are told apart by their
    bytes.

    Returns doc_id, keep_id, group_size, kept, text_sha256, one row per row.
    A null text counts as empty, empty texts are equal to each other. The
    largest doc_id stays; a null doc_id is smaller than any; of rows that
    repeat a doc_id and its text one stays. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    shared = scratch.store(
        "shared",
        _blocks(docs, block_bytes).groupBy("mark").count().filter("count > 1").select("mark"),
    )
    marked = (
        _blocks(docs, block_bytes)
        .join(shared.withColumn("twin", F.lit(True)), "mark", "left")
        .withColumn("block", F.when(F.col("twin"), F.col("block")))
        .drop("mark", "twin")
    )
    # A single-block document with a block of its own is settled here.
    blocks = scratch.store("blocks", marked)
    alone = blocks.filter("n_blocks = 1 and block is null")
    open_blocks = blocks.filter("n_blocks > 1 or block is not null")

    names = _names(scratch, "names", open_blocks.filter("block is not null").select("block"))
    named = open_blocks.join(names, "block", "left").drop("block")
    single = named.filter("n_blocks = 1").select(
        "row", "doc_id", "text_sha256", F.lit(0).alias("rounds"), "name"
    )
    placed = named.filter("n_blocks > 1").groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("text_sha256").alias("text_sha256"),
        F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("placed"),
    )
    spelled = scratch.store(
        "spelled",
        placed.select(
            "row", "doc_id", "text_sha256", F.col("placed.name").alias("names")
        ).unionByName(single.select(
            "row", "doc_id", "text_sha256", F.array("name").alias("names")
        )),
    )
    # An unnamed block occurs nowhere else, and neither does its document.
    lone = F.exists("names", lambda n: n.isNull())
    settled = [
        alone.select("row", "doc_id", "text_sha256"),
        spelled.filter(lone).select("row", "doc_id", "text_sha256"),
    ]
    rest, done, rounds = spelled.filter(~lone), [], 0
    while True:
        done.append(
            rest.filter(F.size("names") == 1).select(
                "row", "doc_id", "text_sha256", F.lit(rounds).alias("rounds"),
                F.col("names")[0].alias("name"),
            )
        )
        longer = rest.filter(F.size("names") > 1)
        if longer.isEmpty():
            break
        rounds += 1
        paired = longer.select(
            "row", "doc_id", "text_sha256", F.posexplode(_pairs(F.col("names"))).alias("pos", "pair")
        ).select(
            "row", "doc_id", "text_sha256", "pos", F.col("pair.first").alias("first"),
            # Names count from 0; -1 stands for the missing half of a last pair.
            F.coalesce(F.col("pair.second"), F.lit(-1)).alias("second"),
        )
        pair_names = _names(scratch, f"names-{rounds}", paired.select("first", "second"))
        rest = scratch.store(
            f"spelled-{rounds}",
            paired.join(pair_names, ["first", "second"])
            .groupBy("row")
            .agg(
                F.first("doc_id").alias("doc_id"),
                F.first("text_sha256").alias("text_sha256"),
                F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("placed"),
            )
            .select("row", "doc_id", "text_sha256", F.col("placed.name").alias("names")),
        )
    identified = done[0]
    for frame in done[1:]:
        identified = identified.unionByName(frame)
    groups = scratch.store(
        "groups",
        identified.groupBy("rounds", "name").agg(
            F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size")
        ),
    )
    grouped = identified.join(groups, ["rounds", "name"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
    )
    unique = settled[0].unionByName(settled[1]).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    return scratch.finish(grouped.unionByName(unique))
