"""Words and word windows of whole Arrow batches as numpy arrays.

Everything works on the bytes of many texts at once; there is no loop over
words and, but for long results, none over documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes whose hashes are computed together; bounds the temporary arrays.
SPAN = 1 << 20

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

# Odd multipliers of the byte hashes with their inverses modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_POWERS: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    found = _POWERS.get((base, size))
    if found is None:
        inverse = pow(base, -1, 1 << 64)
        found = tuple(
            np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, b, dtype=np.uint64))])
            for b in (base, inverse)
        )
        if size == SPAN:
            _POWERS[base, size] = found
    return found


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a batch of texts; a null text has none.

    ``bounds[d]`` to ``bounds[d + 1]`` are the numbers of document d's words;
    word k is the bytes ``starts[k]`` to ``ends[k]`` of ``data``. Words lie
    between ASCII white space, or between blanks alone if ``only_blanks``.
    """

    def __init__(self, texts: pa.Array, lower: bool = False, only_blanks: bool = False):
        texts = texts.fill_null("").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
            texts.offset : texts.offset + len(texts) + 1
        ]
        held = texts.buffers()[2]
        raw = np.frombuffer(held, dtype=np.uint8) if held is not None else np.empty(0, np.uint8)
        first = int(offsets[0]) if len(offsets) else 0
        last = int(offsets[-1]) if len(offsets) else 0
        data = raw[first:last]
        self.raw = data
        self.offsets = offsets - first
        self.data = _LOWER[data] if lower else data
        filled = data != 0x20 if only_blanks else ~_IS_SPACE[data]
        inner = self.offsets[(self.offsets > 0) & (self.offsets < len(data))]
        before = np.ones(len(data), dtype=bool)
        before[1:] = ~filled[:-1]
        before[inner] = True
        after = np.ones(len(data), dtype=bool)
        after[:-1] = ~filled[1:]
        after[inner - 1] = True
        self.starts = np.flatnonzero(filled & before)
        self.ends = np.flatnonzero(filled & after) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.bounds)

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes, computed span by span."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        base = BASES[which]
        done = 0
        while done < len(self.starts):
            low = self.starts[done]
            upto = max(done + 1, int(np.searchsorted(self.ends, low + SPAN, "right")))
            high = self.ends[upto - 1]
            power, inverse = _powers(base, max(SPAN, int(high - low)))
            sums = np.zeros(high - low + 1, dtype=np.uint64)
            values = self.data[low:high].astype(np.uint64)
            values += np.uint64(1)
            values *= power[: high - low]
            np.cumsum(values, out=sums[1:])
            a, b = self.starts[done:upto] - low, self.ends[done:upto] - low
            out[done:upto] = (sums[b] - sums[a]) * inverse[a]
            done = upto
        return mix(out)

    def window_hashes(self, size: int, hashes: np.ndarray) -> np.ndarray:
        """Hash of the ``size`` words from each word on; the last ones are short."""
        return rolling(hashes, size)

    def window_room(self, size: int) -> np.ndarray:
        """Whether the window from each word on ends inside its document."""
        ends = np.repeat(self.bounds[1:], self.counts)
        return np.arange(len(self.starts)) + size <= ends

    def places(self) -> np.ndarray:
        """Each word's number inside its document."""
        return np.arange(len(self.starts)) - np.repeat(self.bounds[:-1], self.counts)


def rolling(hashes: np.ndarray, size: int, factor: int = 0xF1357AEA2E62A9C5) -> np.ndarray:
    """Order-dependent hash of ``size`` neighbours from each place, by doubling."""
    total = np.zeros(len(hashes), dtype=np.uint64)
    block, span, at, left = hashes.copy(), 1, 0, size
    while left:
        if left & 1:
            # total covers ``at`` words so far; append this block behind them
            total *= np.uint64(pow(factor, span, 1 << 64))
            total[: len(hashes) - at] += block[at:] if at else block
            at += span
        left >>= 1
        if left:
            doubled = block * np.uint64(pow(factor, span, 1 << 64))
            doubled[: len(block) - span if span < len(block) else 0] += block[span:]
            block, span = doubled, span * 2
    return mix(total)


def chunks(batch: pa.RecordBatch, column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each; a longer text is alone."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_marks(texts: pa.Array) -> np.ndarray:
    """A 31-bit fingerprint of each text, to tell rows that repeat a doc_id apart."""
    from zlib import crc32

    return np.fromiter(
        (crc32(t.as_buffer() or b"") & 0x7FFFFFFF for t in texts),
        dtype=np.int64,
        count=len(texts),
    )


def blobs(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value per document from the values of all documents in a row."""
    width = values.dtype.itemsize
    offsets = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]) * width
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        len(counts),
        [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))],
    ).cast(pa.binary())
