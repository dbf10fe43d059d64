"""A Merkle tree over a table whose parents keep hash states, and proofs that fold.

A node is the lower-case hex text of a SHA-256 digest. Leaves of one group are
ordered by id; every run of ``fan_out`` neighbours becomes its hash, until one
node, the subroot, is left. Subroots, ordered by group, give the root the same
way.

A parent absorbs its children in order and keeps a copy of its hash state before
each of them. Putting another child in a slot resumes the state kept there with
the new child and its right siblings only; what stands left of the slot is not
hashed again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.ranking import number_rows
from orderloom.llm.scratch import Scratch

#: Leaves of one task's subtree; a power of the fan-out.
BLOCK = 1024
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# A step is one parent on the way up: the child's slot in a byte, then the
# digests of its siblings from left to right.
_NODES = "g string, n long, size long, digest binary"
_STEPS = "g string, n long, steps array<binary>"


def leaf_digest(values: Iterable[Column]) -> Column:
    """SHA-256 of the values, each as byte count, colon and text; null is a hyphen."""
    texts = [v.cast("string") for v in values]
    parts = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
        for t in texts
    ]
    return F.unhex(F.sha2(F.concat(*parts), 256))


class Subtree:
    """The levels above a block of nodes, with the states its parents keep."""

    def __init__(self, nodes: list[bytes], size: int, block: int, fan_out: int):
        self.fan_out = fan_out
        self.levels: list[tuple[list[bytes], list]] = []
        height = _height(block, fan_out) if size > block else _height(size, fan_out)
        for _ in range(height):
            states, parents = [], []
            for start in range(0, len(nodes), fan_out):
                state = hashlib.sha256()
                for child in nodes[start : start + fan_out]:
                    states.append(state.copy())
                    state.update(child)
                parents.append(state.hexdigest().encode())
            self.levels.append((nodes, states))
            nodes = parents
        self.root = nodes[0]

    def fold(self, place: int, node: bytes) -> bytes:
        """The block's root with ``node`` at a place."""
        for nodes, states in self.levels:
            state = states[place].copy()
            state.update(node)
            for right in nodes[place + 1 : place - place % self.fan_out + self.fan_out]:
                state.update(right)
            node = state.hexdigest().encode()
            place //= self.fan_out
        return node

    def steps(self, place: int) -> list[bytes]:
        found = []
        for nodes, _ in self.levels:
            slot = place % self.fan_out
            run = nodes[place - slot : place - slot + self.fan_out]
            siblings = run[:slot] + run[slot + 1 :]
            found.append(bytes([slot]) + b"".join(bytes.fromhex(s.decode()) for s in siblings))
            place //= self.fan_out
        return found


class Path:
    """Parents above a block, each with the state kept before the block's slot."""

    def __init__(self, steps: Iterable[bytes]):
        self.kept, self.siblings = [], []
        for step in steps:
            digests = step_siblings(step)
            state = hashlib.sha256()
            for left in digests[: step[0]]:
                state.update(left)
            self.kept.append((state, b"".join(digests[step[0] :])))
            self.siblings += digests

    def fold(self, node: bytes) -> bytes:
        for before, right in self.kept:
            state = before.copy()
            state.update(node)
            state.update(right)
            node = state.hexdigest().encode()
        return node


def step_siblings(step: bytes) -> list[bytes]:
    """A step's siblings as hex, from left to right."""
    return [step[at : at + 32].hex().encode() for at in range(1, len(step), 32)]


def _height(size: int, fan_out: int) -> int:
    """Levels until a single node is left."""
    height = 0
    while size > 1:
        size = -(-size // fan_out)
        height += 1
    return height


def _hex(digests: Iterable[bytes]) -> list[bytes]:
    return [bytes(d).hex().encode() for d in digests]


def _block(block: int) -> Column:
    return F.expr(f"n div {block}").alias("b")


def _next_round(nodes: DataFrame, block: int, fan_out: int) -> DataFrame:
    """The roots of all blocks of groups that have more than one node."""

    def root(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("n")
        size = int(rows["size"].iloc[0])
        top = Subtree(_hex(rows["digest"]), size, block, fan_out).root
        row = (key[0], int(key[1]), -(-size // block), bytes.fromhex(top.decode()))
        return pd.DataFrame([row], columns=["g", "n", "size", "digest"])

    return nodes.filter("size > 1").groupBy("g", _block(block)).applyInPandas(root, _NODES)


def _rounds(scratch: Scratch, name: str, nodes: DataFrame, block: int, fan_out: int) -> list[DataFrame]:
    """The nodes, the roots of their blocks, the roots of the blocks of those, and so on."""
    rounds = [nodes.select("g", "n", "size", "digest")]
    while True:
        up = scratch.store(f"{name}-{len(rounds)}", _next_round(rounds[-1], block, fan_out))
        if up.isEmpty():
            return rounds
        rounds.append(up)


def _roots(rounds: list[DataFrame]) -> DataFrame:
    """One row per group: its subroot."""
    tops = [r.filter("size = 1").select("g", "digest") for r in rounds]
    found = tops[0]
    for top in tops[1:]:
        found = found.unionByName(top)
    return found


def _paths(rounds: list[DataFrame], block: int, fan_out: int) -> DataFrame:
    """The steps from every node of the first round to its group's root."""

    def steps(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("n")
        tree = Subtree(_hex(rows["digest"]), int(rows["size"].iloc[0]), block, fan_out)
        return pd.DataFrame(
            {"g": key[0], "n": rows["n"], "steps": [tree.steps(i) for i in range(len(rows))]}
        )

    above = None
    for nodes in reversed(rounds):
        ended = nodes.filter("size = 1").select(
            "g", "n", F.array().cast("array<binary>").alias("steps")
        )
        if above is None:
            above = ended
            continue
        inside = nodes.filter("size > 1").groupBy("g", _block(block)).applyInPandas(steps, _STEPS)
        higher = above.select("g", F.col("n").alias("b"), F.col("steps").alias("higher"))
        joined = inside.withColumn("b", _block(block)).join(higher, ["g", "b"])
        above = ended.unionByName(
            joined.select("g", "n", F.concat("steps", "higher").alias("steps"))
        )
    return above


def merkle_manifest(
    docs: DataFrame,
    changed: Mapping[str, Column] | None = None,
    id_column: str = "doc_id",
    group_column: str = "lang",
    fields: Iterable[str] = FIELDS,
    fan_out: int = 2,
    block: int = BLOCK,
) -> DataFrame:
    """Leaves, roots and proofs of a table, and the root that a changed row folds to.

    ``changed`` gives other values of fields; a row's changed leaf then takes the
    place of its own, alone, and the root is folded from it. Without it each
    leaf folds to the root again, which checks the proof.

    Returns one row per row: the id, leaf, subroot, root and folded_root as hex
    text, and proof, the siblings from the leaf to the root, left to right.

    Rows with a null id come first in their group, rows with a null group form
    the first group. Rows that share an id are ordered by leaf; equal rows have
    equal leaves, so any order of theirs is the same tree. A null text is a
    hyphen in its leaf, an empty one ``0:``. A long text is hashed by the JVM in
    one pass. An empty table has no tree and gives an empty result. Only the
    named columns are read, so other columns cannot clash.

    One task builds the subtree of ``block`` neighbours, however large their
    group is; the roots of blocks are the leaves of the next round.
    """
    if fan_out**_height(block, fan_out) != block:
        raise ValueError("the block must be a power of the fan-out")
    scratch = Scratch(docs.sparkSession, "merkle")
    fields, changed = list(fields), changed or {}
    own = leaf_digest(F.col(c) for c in fields)
    other = leaf_digest(changed.get(c, F.col(c)) for c in fields)
    # A prefix keeps the null group apart from the empty text, and before it.
    group = F.coalesce(F.concat(F.lit("="), F.col(group_column).cast("string")), F.lit(""))
    leaves = scratch.store(
        "leaves",
        docs.select(
            F.col(id_column).alias("id"),
            group.alias("g"),
            own.alias("digest"),
            F.nullif(other, own).alias("other"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )
    nodes = number_rows(scratch, "nodes", leaves, "g", ["id", "digest", "row"])
    scratch.drop("leaves")
    rounds = _rounds(scratch, "round", nodes, block, fan_out)
    subroots = scratch.store("subroots", _roots(rounds))
    tops = number_rows(
        scratch, "tops", subroots.select(F.lit("").alias("g"), F.col("g").alias("of"), "digest"), "g", ["of"]
    )
    over = _rounds(scratch, "over", tops, block, fan_out)
    to_root = _paths(over, block, fan_out).select("n", F.col("steps").alias("last"))
    top = _roots(over).first()
    root = "" if top is None else bytes(top["digest"]).hex()
    # Every group's subroot with the steps from it to the root.
    crowns = (
        tops.select(F.col("of").alias("g"), "n", F.col("digest").alias("subroot"))
        .join(to_root, "n")
        .select("g", "subroot", "last")
    )
    # A lone leaf is its group's subroot and has no block above it.
    nothing = F.array().cast("array<binary>")
    lone = nodes.filter("size = 1").select("g", "n", nothing.alias("steps"))
    below = lone if len(rounds) == 1 else lone.unionByName(_paths(rounds[1:], block, fan_out))
    paths = scratch.store(
        "paths",
        below.join(crowns, "g").select(
            "g", F.col("n").alias("b"), "subroot", F.concat("steps", "last").alias("steps")
        ),
    )
    kept = {"nodes", "paths"}
    scratch.drop(*[name for name in scratch.paths if name not in kept])
    id_type = leaves.schema["id"].dataType.simpleString()

    def fold(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("n")
        first = above.iloc[0]
        tree = Subtree(_hex(rows["digest"]), int(rows["size"].iloc[0]), block, fan_out)
        path = Path(bytes(s) for s in first["steps"])
        proofs, folded = [], []
        for place, (own, other) in enumerate(zip(rows["digest"], rows["other"])):
            node = bytes(own if other is None else other).hex().encode()
            folded.append(path.fold(tree.fold(place, node)).decode())
            siblings = [s for step in tree.steps(place) for s in step_siblings(step)]
            proofs.append([s.decode() for s in siblings + path.siblings])
        return pd.DataFrame(
            {
                "id": rows["id"],
                "leaf": [bytes(d).hex() for d in rows["digest"]],
                "subroot": bytes(first["subroot"]).hex(),
                "root": root,
                "proof": proofs,
                "folded_root": folded,
            }
        )

    # Ids travel as text: pandas would turn whole numbers beside a null into floats.
    out = "id string, leaf string, subroot string, root string, proof array<string>, folded_root string"
    folds = (
        nodes.select(F.col("id").cast("string").alias("id"), "g", "n", "size", "digest", "other")
        .groupBy("g", _block(block))
        .cogroup(paths.groupBy("g", "b"))
        .applyInPandas(fold, out)
    )
    return folds.select(F.col("id").cast(id_type).alias(id_column), *folds.columns[1:])
