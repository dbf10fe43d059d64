"""Best-fit packing of token sequences with a bounded number of open bins."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.scratch import Scratch
from orderloom.llm.words import Words, chunks

#: Tokens in a sequence.
CAPACITY = 2048
#: Open bins of one packer. More waste less and hold a little more memory.
OPEN_BINS = 1024
#: Input partitions whose open bins one task packs again.
FAN_IN = 64
#: Units whose tokens a worker remembers; then it starts again.
MEMO = 2_000_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", bin long, offset long, open boolean"


# The non-ASCII white space of Unicode, in UTF-8 (fixed values).
_WIDE_SPACE = re.compile(
    rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)


class UnitMemo:
    """Token ids by unit hash: sorted hashes in a few runs, ids in one array."""

    def __init__(self):
        self.runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.flat, self.used, self.count = np.empty(1 << 16, dtype="<u4"), 0, 0

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, size) in ``flat`` of each key; size -1 where unknown."""
        begin, size = np.zeros(len(keys), np.int64), np.full(len(keys), -1, np.int64)
        for held, starts, sizes in self.runs:
            at = np.minimum(np.searchsorted(held, keys), len(held) - 1)
            hit = np.flatnonzero(held[at] == keys)
            begin[hit], size[hit] = starts[at[hit]], sizes[at[hit]]
        return begin, size

    def add(self, keys: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Sorted new keys with the sizes of their ids, ids in the keys' order."""
        if not len(keys):
            return
        if self.used + len(ids) > len(self.flat):
            grown = np.empty(2 * (self.used + len(ids)), dtype="<u4")
            grown[: self.used] = self.flat[: self.used]
            self.flat = grown
        self.flat[self.used : self.used + len(ids)] = ids
        self.runs.append((keys, self.used + np.cumsum(sizes) - sizes, sizes))
        self.used += len(ids)
        self.count += len(keys)
        if len(self.runs) > 8:
            columns = [np.concatenate(part) for part in zip(*self.runs)]
            order = np.argsort(columns[0], kind="stable")
            self.runs = [tuple(column[order] for column in columns)]


class TokenBytes:
    """Token ids of texts as little-endian 32-bit bytes, remembered by unit.

    The vocabulary's first step begins a new unit at each blank, unless
    further white space stands beside it. Texts whose blanks each stand
    between two visible characters are cut at their blanks: units not met
    before are tokenized once, all in one text, and ids are gathered. All
    other texts go to the tokenizer whole. Both give the same ids.
    """

    def __init__(self, path: str, end_id: int):
        # Spark gives each task its core; a pool of threads per worker only spins.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = end_id.to_bytes(4, "little")
        self.memo = UnitMemo()
        vocab = self.tokenizer.get_vocab()
        # Byte-level vocabularies write a blank as this letter; it begins a unit.
        self.begins_unit = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.begins_unit[[i for token, i in vocab.items() if token.startswith("\u0120")]] = True
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = re.compile(b"|".join(re.escape(t.content.encode()) for t in added) or b"(?!)")

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4") for e in found]

    def _learn(self, units: Words, at: np.ndarray, keys: np.ndarray) -> None:
        """Tokenize the units ``at``, each after a blank, and remember them."""
        if not len(at):
            return
        sizes = units.ends[at] - units.starts[at] + 1
        spelled = np.full(sizes.sum(), 0x20, dtype=np.uint8)
        ends = np.cumsum(sizes)
        take = np.arange(len(spelled)) + np.repeat(units.starts[at] - 1 - (ends - sizes), sizes)
        inner = np.ones(len(spelled), dtype=bool)
        inner[ends - sizes] = False
        spelled[inner] = units.data[take[inner]]
        ids = self._ids([spelled.tobytes().decode()])[0]
        heads = np.flatnonzero(self.begins_unit[ids])
        self.memo.add(keys, np.diff(np.append(heads, len(ids))), ids)

    def _irregular(self, units: Words) -> np.ndarray:
        """Texts whose white space may form a run across a cut, or with special tokens."""
        data, offsets = units.data, units.offsets
        found = np.zeros(len(offsets) - 1, dtype=bool)
        sizes = np.diff(offsets)
        full = np.flatnonzero(sizes)
        space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
        beside = np.flatnonzero(space[1:] & space[:-1] & ((data[1:] == 0x20) | (data[:-1] == 0x20)))
        found[np.searchsorted(offsets, beside, "right") - 1] = True
        found[full] |= space[offsets[full]] | space[offsets[full + 1] - 1]
        raw = data.tobytes()
        for pattern in (_WIDE_SPACE, self.special):
            for hit in pattern.finditer(raw):
                found[np.searchsorted(offsets, hit.start(), "right") - 1] = True
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text followed by the end id; a null text is empty."""
        units = Words(texts, only_blanks=True)
        whole = self._irregular(units)
        # The first unit of a text follows no blank and is tokenized for itself.
        usual = np.repeat(~whole, units.counts)
        usual[units.bounds[:-1][units.counts > 0]] = False
        use = np.flatnonzero(usual)
        distinct, at, inverse = np.unique(units.hashes()[use], return_index=True, return_inverse=True)
        if self.memo.count > MEMO:
            self.memo = UnitMemo()
        new = np.flatnonzero(self.memo.find(distinct)[1] < 0)
        self._learn(units, use[at[new]], distinct[new])
        begin, size = self.memo.find(distinct)
        lengths = size[inverse]
        ends = np.cumsum(lengths)
        shift = begin[inverse] - (ends - lengths)
        found = self.memo.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(shift, lengths)]
        bounds = np.concatenate([[0], ends])[np.searchsorted(use, units.bounds)]
        alone = [
            texts[d].as_py() if whole[d] else units.data[units.starts[k] : units.ends[k]].tobytes().decode()
            for d, (k, n) in enumerate(zip(units.bounds[:-1], units.counts))
            if n or whole[d]
        ]
        heads = iter(self._ids(alone))
        return [
            (next(heads).tobytes() if n or odd else b"") + found[a:b].tobytes() + self.end
            for n, odd, a, b in zip(units.counts, whole, bounds[:-1], bounds[1:])
        ]


_ENCODERS: dict[tuple[str, int], TokenBytes] = {}


def encoder(path: str, end_id: int) -> TokenBytes:
    """One encoder per worker process and vocabulary."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = TokenBytes(path, end_id)
    return _ENCODERS[path, end_id]


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; only the first may be short."""
    head = length % capacity or capacity
    return [(0, head), *((s, capacity) for s in range(head, length, capacity))]


class BestFit:
    """Online best fit over a fixed number of open bins.

    A bit for each free space says whether an open bin has it, so the
    tightest bin that takes a piece is the lowest set bit from its length on.
    When all bins are open and none takes the piece, the fullest one closes.
    """

    def __init__(self, capacity: int, open_bins: int, first: int = 0):
        self.capacity, self.most, self.next = capacity, open_bins, first
        self.bits, self.free = 0, {}
        self.count = 0

    def _push(self, bin_id: int, free: int) -> None:
        self.free.setdefault(free, []).append(bin_id)
        self.bits |= 1 << free
        self.count += 1

    def _pop(self, free: int) -> int:
        bins = self.free[free]
        bin_id = bins.pop()
        if not bins:
            del self.free[free]
            self.bits ^= 1 << free
        self.count -= 1
        return bin_id

    def add(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece."""
        fit = self.bits >> length
        if fit:
            free = length + (fit & -fit).bit_length() - 1
            bin_id = self._pop(free)
        else:
            free, bin_id = self.capacity, self.next
            self.next += 1
        if free > length:
            if self.count >= self.most:
                self._pop((self.bits & -self.bits).bit_length() - 1)
            self._push(bin_id, free - length)
        return bin_id, self.capacity - free

    def open(self) -> set[int]:
        return {b for bins in self.free.values() for b in bins}


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 0,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Pack the tokens of all documents into sequences of ``capacity`` tokens.

    Each task tokenizes its documents and packs the pieces as they come, by
    best fit over ``open_bins`` open bins; the fullest bin closes first. The
    pieces of bins still open at a task's end are packed again, longest first
    and ``fan_in`` tasks together, until one round has a single packer. So
    only the last packer's open bins stay partly empty.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset. A null text counts as empty and is one piece, the
    end id. Repeated rows are packed each for itself; a null doc_id is
    returned as it is; only doc_id and text are read. An empty table gives an
    empty result. Sequence numbers have gaps.
    """
    scratch = Scratch(docs.sparkSession, "packing")

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer_path, end_id).encode
        packer = BestFit(capacity, open_bins, TaskContext.get().partitionId() << 32)
        held: dict[int, list[tuple]] = {}
        for batch in (part for whole in batches for part in chunks(whole, "text")):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"))):
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    bin_id, offset = packer.add(length)
                    held.setdefault(bin_id, []).append(
                        (doc_id, piece, start, length, crc, bin_id, offset)
                    )
            open_now = packer.open()
            yield from _rows([r for b in held if b not in open_now for r in held[b]], False)
            held = {b: rows for b, rows in held.items() if b in open_now}
        yield from _rows([r for rows in held.values() for r in rows], True)

    placed = scratch.store(
        "placed-0", docs.select("doc_id", "text").mapInArrow(first_round, PLACED)
    )
    done = [placed.filter("not open")]
    rest = placed.filter("open")
    packers = placed.sparkSession.read.parquet(scratch.paths["placed-0"]).select(
        F.max(F.shiftright("bin", 32))
    ).first()[0]
    packers = 0 if packers is None else packers + 1
    step = 0
    while packers > 1:
        step += 1
        group = (F.shiftright("bin", 32) / fan_in).cast("long")
        packers = -(-packers // fan_in)
        again = rest.withColumn("packer", group).groupBy("packer")
        placed = scratch.store(
            f"placed-{step}",
            again.applyInPandas(_repacker(capacity, open_bins, step, packers), PLACED),
        )
        done.append(placed.filter("not open"))
        rest = placed.filter("open")
    result = rest
    for frame in done:
        result = result.unionByName(frame)
    return scratch.finish(
        result.select(
            "doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset"
        )
    )


def _rows(rows: list[tuple], is_open: bool) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset"]
    types = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
    for start in range(0, len(rows), 10_000):
        part = rows[start : start + 10_000]
        columns = [pa.array(values, kind) for values, kind in zip(zip(*part), types)]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array([is_open] * len(part))], [*names, "open"]
        )


def _repacker(capacity: int, open_bins: int, step: int, packers: int):
    """Packs the open pieces of ``FAN_IN`` packers, at most ``open_bins`` bins each."""

    def repack(key, rows):
        number = int(key[0])
        # The round in the top bits keeps bin numbers apart between rounds.
        packer = BestFit(capacity, open_bins, (step << 56) | (number << 32))
        rows = rows.sort_values(
            ["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True]
        )
        spots = [packer.add(int(n)) for n in rows["length"]]
        still = packer.open() if packers > 1 else set()
        return rows.assign(
            bin=[b for b, _ in spots],
            offset=[o for _, o in spots],
            open=[b in still for b, _ in spots],
        )[["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset", "open"]]

    return repack
