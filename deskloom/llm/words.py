"""Words, folds and hashes shared by the operators of this package."""

import sys
from collections.abc import Iterator

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A word is a run of other characters than these; bytes.split() without arguments cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = b" \t\n\x0b\x0c\r"


def in_fold(doc_id: str, folds: int, fold: int) -> Column:
    """Whether crc32(id as text) mod ``folds`` is ``fold``; a null id counts as the empty text."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return (F.crc32(key.cast("binary")) % F.lit(folds)) == fold


# Hashing of all words of a text at once: a random number per byte, weighed by powers of an odd number.
_RANDOM = np.random.RandomState(20)
_LETTER = _RANDOM.randint(0, 1 << 62, 256, np.int64).astype(np.uint64) * np.uint64(4) + _RANDOM.randint(0, 4, 256).astype(np.uint64)
_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_IN_WORD = np.array([chr(c).encode("latin-1") not in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r") for c in range(256)])


class _Kept(dict):
    """A memory of one process; it travels empty."""

    def __reduce__(self):
        return _Kept, ()


_POWERS = _Kept()


def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the next text."""
    if len(_POWERS.get("up", ())) < length:
        size = max(length, 1 << 16)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def word_hashes(texts: list[bytes], piece: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the words of all texts, number of words of each text), without a Python object per word."""
    hashes, lengths, start = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) < piece):
            size += len(texts[end]) + 1
            end += 1
        found = _hash_piece(texts[start:end])
        hashes.append(found[0])
        lengths.append(found[1])
        start = end
    return np.concatenate(hashes), np.concatenate(lengths)


def run_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes from ``first`` up to ``last`` (not included)."""
    up, down = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTER[data] * up[:len(data)], out=sums[1:])
    return mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))


def scan(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, last byte + 1, hash) of the runs of bytes that are inside words; the outermost bytes must not be."""
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1  # starts and ends by turns
    first, last = edges[::2], edges[1::2]
    return first, last, run_hashes(data, first, last)


def counts_by_text(first: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """How many words start in each of the texts, which lie one after the other behind one blank each."""
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    return np.diff(np.searchsorted(first, ends + 1), prepend=0)


def _hash_piece(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    first, _, found = scan(data, _IN_WORD[data])
    return found, counts_by_text(first, texts)


def lower_ascii(text: bytes) -> bytes:
    """A-Z in lower case, all else unchanged (what bytes.lower() does)."""
    return text.lower()


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on all input bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` word hashes; empty if there are fewer."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:count].copy()
    for j in range(1, width):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += hashes[j:j + count]
    return mix(total)


def text_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow text column; null counts as empty."""
    import pyarrow as pa

    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]


def short_batches(spark: SparkSession) -> None:
    """Texts are long: fewer rows in an Arrow batch bound what both ends of it hold."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def release() -> None:
    """Give freed memory back to the system: a Python worker outlives its task and would keep it from what runs next."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def slices(batches, max_bytes: int = 4 << 20) -> Iterator:
    """The rows of Arrow batches, or of Arrow arrays, in runs of about ``max_bytes``, a longer single row alone: bounds what a
    task holds."""
    try:
        for batch in batches:
            count = len(batch)
            step = max(1, int(count * max_bytes / max(batch.nbytes, 1)))
            for start in range(0, count, step):
                yield batch.slice(start, step)
    finally:
        release()
