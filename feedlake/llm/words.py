"""Words of many texts at once, as numpy arrays over Arrow buffers.

Texts are read as UTF-8 bytes straight from the Arrow batch.  A word is a run of
bytes of a class; its hash is a chain over its lower-cased bytes, eight at a time, each
step of which spreads every bit (xxHash does the long ones), so two words are compared by
eight bytes.  A sum of powers would be quicker for long words only, and modulo 2**64 it
gives some different words one hash, whatever its base.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)

# Spans of more bytes than this are hashed one by one.
LONG = 64

# An upper-case ASCII letter counts as its lower case in words; EXACT keeps all bytes.
EXACT = np.arange(256, dtype=np.uint8)
LOWER = EXACT.copy()
LOWER[65:91] += 32

# The first k bytes of a little-endian value of eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

# Bytes of words that are parted by ASCII white space: [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

# Bytes of words of letters, digits and anything beyond ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x41:0x5B] = ALPHANUMERIC[0x61:0x7B] = True
ALPHANUMERIC[0x80:] = True


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@dataclass
class Block:
    """Words of the rows ``first`` to ``first + len(counts)`` of a batch.

    ``hashes`` has all words in order, ``counts`` how many each row has, and
    ``starts`` and ``ends`` where each lies in ``data``; ``bounds`` has the byte
    positions of the rows.
    """

    first: int
    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray

    @property
    def edges(self) -> np.ndarray:
        """Index of the first word of each row, and of the end."""
        return np.concatenate(([0], np.cumsum(self.counts)))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row bounds of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8), bounds


def text_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and row bounds of blocks of texts; a text is never split."""
    if not len(column):
        return
    data, bounds = text_buffers(column)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        end = int(np.searchsorted(bounds, bounds[row] + block_bytes, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]
        row = end


def word_blocks(
    column: pa.Array, letters: np.ndarray = SPACED, block_bytes: int = BLOCK_BYTES
) -> Iterator[Block]:
    """The words of a text column, block by block; a text is never split."""
    for row, data, bounds in text_blocks(column, block_bytes):
        yield _block(data, bounds, letters, row)


def word_spans(data: np.ndarray, bounds: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of the texts between ``bounds`` begin and end."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = letters[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    before[bounds[:-1]] = False
    starts = np.flatnonzero(inside & ~before)
    # A word ends where a byte of no word follows, or the next text begins.
    after = inside.copy()
    after[bounds] = False
    return starts, np.flatnonzero(inside[:-1] & ~after[1:]) + 1


def _block(data: np.ndarray, bounds: np.ndarray, letters: np.ndarray, first: int) -> Block:
    starts, ends = word_spans(data, bounds, letters)
    hashes = span_hashes(data, starts, ends)
    counts = np.diff(np.searchsorted(starts, bounds))
    return Block(first, data, bounds, starts, ends, hashes, counts)


def _lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each byte, as one value; zeros follow the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def span_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, letters: np.ndarray = LOWER
) -> np.ndarray:
    """Hashes of the spans of ``data`` from ``starts`` to ``ends``, by what ``letters`` makes of their bytes."""
    data = letters[data]
    lanes, sizes = _lanes(data), ends - starts
    out = mixed(sizes.astype(np.uint64) + _ODD)
    at = np.arange(len(sizes))
    for begin in range(0, LONG, 8):
        at = at[(sizes[at] > begin) & (sizes[at] <= LONG)]
        if not len(at):
            break
        value = lanes[starts[at] + begin] & _FIRST[np.minimum(sizes[at] - begin, 8)]
        out[at] = mixed((out[at] ^ value) * _ODD)
    for i in np.flatnonzero(sizes > LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return out


def differ(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Which spans do not have the bytes of the span that ``model`` names."""
    lanes, sizes = _lanes(data), ends - starts
    wrong = sizes != sizes[model]
    at = np.flatnonzero(~wrong & (model != np.arange(len(model))))
    begin = 0
    while len(at):
        left = _FIRST[np.minimum(sizes[at] - begin, 8)]
        same = (lanes[starts[at] + begin] & left) == (lanes[starts[model[at]] + begin] & left)
        wrong[at[~same]] = True
        begin += 8
        at = at[same & (sizes[at] > begin)]
    return wrong


def text_hashes(text: str, letters: np.ndarray = SPACED) -> np.ndarray:
    """Word hashes of one text."""
    return next(iter(word_blocks(pa.array([text]), letters))).hashes


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; the run at position i starts there."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    last = len(hashes) - size + 1
    out = hashes[:last].copy()
    for i in range(1, size):
        out = mixed(out * _ODD + hashes[i : last + i])
    return out


def joined(hashes: np.ndarray) -> int:
    """Hash of a whole sequence of words."""
    out = 0
    for value in hashes.tolist():
        out = int(mixed(np.array([(out * int(_ODD) + value) % (1 << 64)], np.uint64))[0])
    return out
