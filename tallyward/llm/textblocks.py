"""Words, lines and hashes of whole batches of texts, as numpy arrays over the bytes of an Arrow column.

A block is a slice of a batch with a few megabytes of text, so that memory in a task is bounded by a block or by
one text, whichever is longer. No Python runs for each row or word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
WHITE_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"

_U = np.uint64
_GOLD, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = np.array(x, dtype=np.uint64)
    x ^= x >> _U(30)
    x *= _M1
    x ^= x >> _U(27)
    x *= _M2
    x ^= x >> _U(31)
    return x


def table_of(chars: bytes) -> np.ndarray:
    """256 booleans, true at the given bytes."""
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


_IS_SPACE = table_of(WHITE_SPACE)


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
           block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """Each batch in slices of about ``block_bytes`` of text (one row at least), with the slice's texts."""
    for batch in batches:
        texts = pc.fill_null(batch.column(column), "")
        sizes = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))])
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + block_bytes, "right")) - 1)
            part = batch.slice(at, end - at)
            yield part, Block(texts.slice(at, end - at))
            at = end


def spans_of(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes that do not cross the limits of a text."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] |= inside[cuts]
    last[cuts - 1] |= inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class Block:
    """The texts of some rows: ``data`` holds their UTF-8 bytes end to end, ``offsets`` the limits. NULL is empty."""

    def __init__(self, texts: pa.Array):
        self.rows = len(texts)
        if not pa.types.is_large_string(texts.type):
            texts = texts.cast(pa.large_string())
        _, limits, values = texts.buffers()
        offsets = np.frombuffer(limits, np.int64, self.rows + 1, texts.offset * 8)
        data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
        self.padded = np.concatenate([data[offsets[0] : offsets[-1]], np.zeros(8, np.uint8)])
        self.data = self.padded[:-8]
        self.offsets = offsets - offsets[0]

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of the mask each text holds."""
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def code_points(self) -> np.ndarray:
        return (self.data & 0xC0) != 0x80

    def words(self) -> Spans:
        """Maximal runs of other bytes than ASCII white space."""
        return Spans(self, *spans_of(~_IS_SPACE[self.data], self.offsets))

    def lines(self) -> Spans:
        """What ``\\n`` separates, without the empty lines."""
        return Spans(self, *spans_of(self.data != 10, self.offsets))

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of the bytes of each span (spans are not empty)."""
        if len(starts) == 0:
            return np.zeros(0, np.uint64)
        lengths = ends - starts
        pieces = (lengths + 7) >> 3
        first = np.cumsum(pieces) - pieces
        nth = np.arange(int(pieces.sum()), dtype=np.int64) - np.repeat(first, pieces)
        left = np.repeat(lengths, pieces) - 8 * nth
        view = np.ndarray((len(self.padded) - 7,), "<u8", self.padded, 0, (1,))
        values = view[np.repeat(starts, pieces) + 8 * nth]
        short = left < 8
        values[short] &= (_U(1) << (_U(8) * left[short].astype(np.uint64))) - _U(1)
        values = mix(values + _GOLD * (nth.astype(np.uint64) + _U(1)))
        return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))


class Spans:
    """Byte spans in a block, in order; ``counts`` says how many each text holds, ``row`` in which text each lies."""

    def __init__(self, block: Block, starts: np.ndarray, ends: np.ndarray):
        self.block, self.starts, self.ends = block, starts, ends
        self.first = np.searchsorted(starts, block.offsets)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(block.rows), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        return self.block.hashes(self.starts, self.ends)

    def windows(self, hashes: np.ndarray, size: int, shorter: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """First spans and hashes of all runs of ``size`` spans within one text.

        With ``shorter`` a text of fewer spans (one at least) gives one run of all it has.
        """
        n = len(self)
        at = np.arange(n, dtype=np.int64)
        left = self.first[1:][self.row] - at
        keep = left >= size
        total = np.zeros(n, np.uint64)
        for k in range(size):
            step = _U((int(_M1) * (2 * k + 3)) & 0xFFFFFFFFFFFFFFFF)
            if k == 0:
                total += hashes * step
            else:
                part = hashes[k:] * step
                if shorter:
                    part = np.where(left[: n - k] > k, part, _U(0)) if n > k else part
                total[: max(n - k, 0)] += part
        if shorter:
            keep |= (at == self.first[:-1][self.row])
        return at[keep], mix(total[keep] + _GOLD)


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """True at all but one of the equal keys, and true at every key that another key equals."""
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    spare = np.zeros(len(keys), bool)
    shared = np.zeros(len(keys), bool)
    spare[order[1:]] = same
    shared[order[1:]] = same
    shared[order[:-1]] |= same
    return spare, shared


def of_row(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes that differ between the texts of a block."""
    return mix(hashes + _GOLD * (row.astype(np.uint64) + _U(1)))
