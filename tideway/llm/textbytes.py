"""Vectorised helpers over the UTF-8 buffers of Arrow text columns.

A text column of a record batch is one run of bytes and an array of offsets, so
that words and their hashes are found for all rows of a batch at once.
"""

import ctypes
import functools
import hashlib

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h




def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    if n:
        out[0] = 1
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


_cache: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; tables of block size are kept."""
    if n > 2 * BLOCK_BYTES:
        return _powers(base, n)
    if int(base) not in _cache:
        _cache[int(base)] = _powers(base, 2 * BLOCK_BYTES)
    return _cache[int(base)][:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null row is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_binary(column.type):
        column = column.view(pa.string())
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        column, width = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES, rows: int = 1 << 20):
    """Row ranges (a, b) of at most limit bytes and that many rows each, or of one longer row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, min(a + rows, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1))
        yield a, b
        a = b


def releasing(run):
    """run for mapInArrow, which at the end of each task gives freed memory back to the system: Python workers live on and keep it otherwise."""

    @functools.wraps(run)
    def out(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
            if trim:
                trim(0)

    return out


def byte_class(keep) -> np.ndarray:
    """A table of 256 flags from a predicate over byte values."""
    return np.array([bool(keep(b)) for b in range(256)])


#: Everything but ASCII white space (tab, line feed, vertical tab, form feed, return, space).
NON_SPACE = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Letters, digits and every byte of a non-ASCII character.
ALNUM = byte_class(lambda b: b >= 0x80 or chr(b).isalnum())
#: Lower-cases A-Z and leaves every other byte.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


#: Words up to this length are hashed by eight bytes at a time, all of a block together; longer ones by blake2b.
SHORT = 64
_MASK = np.array([(1 << (8 * r)) - 1 for r in range(9)], np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes and length. Every eight bytes are mixed into the state, so that no two words of one length collide by their structure."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))  # the eight bytes from every place on
    size = ends - starts
    h, at = size.astype(np.uint64) * _STEP, np.arange(len(size))
    for k in range(0, SHORT, 8):
        at = at[size[at] > k]
        if not len(at):
            break
        h[at] = mix(h[at] ^ (eight[starts[at] + k] & _MASK[np.minimum(size[at] - k, 8)]))
    for i in np.flatnonzero(size > SHORT):
        h[i] = int.from_bytes(hashlib.blake2b(padded[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


class Words:
    """The words of a block of texts: first and last byte + 1, hash, and the first word of each text."""

    __slots__ = ("starts", "ends", "hashes", "first")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word: np.ndarray, lower: bool = True):
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = word[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        change = inside[1:] != inside[:-1]
        self.starts = np.flatnonzero((change | edge) & inside[1:])
        self.ends = np.flatnonzero((change | edge) & inside[:-1])
        self.hashes = word_hashes(LOWER[data] if lower else data, self.starts, self.ends)
        self.first = np.searchsorted(self.starts, offsets)

    def windows(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; those that leave the text are to be left out by the caller."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        h = np.zeros(n, np.uint64)
        for j in range(k):
            h = h * _STEP + self.hashes[j : j + n]
        return mix(h + np.uint64(k * int(_BASE) % (1 << 64)))
