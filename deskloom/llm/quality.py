"""Quality rules: base counts of a text and bands of its compression ratio.

A text that repeats itself compresses too well, random characters too little. The ratio (bytes / compressed bytes) of the
whole text must lie in the band of its length class, and so must the ratios of most of its fixed-size chunks. What is left
behind the last full chunk is measured in a chunk of the same size that ends with the text.
"""

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.llm.words import SPACES, slices, text_bytes, window_hashes, word_hashes

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """Limits of bytes / compressed bytes. ``whole``: (bytes from, lowest, highest), by rising length."""

    whole: tuple = ((0, 0.0, 2.0), (64, 0.0, 1.6), (128, 0.8, 1.95), (256, 1.05, 2.0), (512, 1.2, 2.1), (1024, 1.4, 2.25),
                    (2048, 1.5, 2.35), (4096, 1.6, 2.45), (8192, 1.7, 2.55), (16384, 1.75, 2.6), (32768, 1.75, 2.7))
    chunk_bytes: int = 2048
    chunk: tuple = (1.5, 2.25)
    chunk_share: float = 0.25  # of the chunks that may lie outside
    level: int = 3


@dataclass(frozen=True)
class BaseRules:
    min_words: int = 10
    repeat_width: int = 5
    max_repeat_percent: int = 20


def repeat_words(hashes: np.ndarray, width: int) -> int:
    """Words in ``width``-word windows that occur twice or more, first occurrences included."""
    windows = window_hashes(hashes, width)
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice) == 0:
        return 0
    edges = np.zeros(len(hashes) + 1, np.int64)
    starts = np.flatnonzero(np.isin(windows, twice))
    edges[starts] += 1
    edges[starts + width] -= 1
    return int(np.count_nonzero(np.cumsum(edges)[:-1]))


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def ratio(text: bytes, packer) -> float:
    return len(text) / len(packer.compress(text)) if text else 0.0


def in_bands(text: bytes, whole: float, chunks: list[float], bands: Bands) -> bool:
    _, low, high = max(b for b in bands.whole if b[0] <= len(text))
    outside = sum(not bands.chunk[0] <= r <= bands.chunk[1] for r in chunks)
    return low <= whole <= high and outside <= bands.chunk_share * len(chunks)


def measure(text: bytes, hashes: np.ndarray, packer, base: BaseRules, bands: Bands) -> tuple:
    """All columns of a text; ``hashes`` are those of its words."""
    repeats = repeat_words(hashes, base.repeat_width)
    points = len(text.decode("utf-8", "surrogatepass"))
    word_chars = points - (len(text) - len(text.translate(None, SPACES)))
    failed = len(hashes) < base.min_words or 100 * repeats > base.max_repeat_percent * len(hashes)
    whole = ratio(text, packer)
    starts = [*range(0, len(text) - bands.chunk_bytes + 1, bands.chunk_bytes)]
    if starts and len(text) % bands.chunk_bytes:
        starts.append(len(text) - bands.chunk_bytes)
    chunks = [ratio(text[i:i + bands.chunk_bytes], packer) for i in starts]
    kept = not failed and in_bands(text, whole, chunks, bands)
    return (len(hashes), word_chars, len(text) - len(text.translate(None, SYMBOLS)), duplicate_lines(text), repeats,
            failed, kept, whole, min(chunks, default=None), max(chunks, default=None))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = ("ratio", "lowest_chunk_ratio", "highest_chunk_ratio")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: BaseRules = BaseRules(),
            bands: Bands = Bands()) -> DataFrame:
    """One row per input row: doc_id, the base counts, base_failed, kept and the ratios.

    A null text counts as empty: no words, so it fails the base rules. A text shorter than a chunk has null chunk ratios
    and is judged as a whole only. Repeated rows and null ids give a row each; other columns play no part.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    schema = (f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, kept boolean, "
              + ", ".join(f"{c} double" for c in RATIOS))
    names = [*COUNTS, "base_failed", "kept", *RATIOS]
    types = [pa.int64()] * len(COUNTS) + [pa.bool_()] * 2 + [pa.float64()] * len(RATIOS)

    def rate(batches):
        packer = zstandard.ZstdCompressor(level=bands.level, write_checksum=False)
        for part in slices(batches):
            texts = text_bytes(part.column(1))
            hashes, lengths = word_hashes(texts)
            found = [measure(t, h, packer, base, bands) for t, h in zip(texts, np.split(hashes, np.cumsum(lengths)[:-1]))]
            columns = [pa.array(list(c), t) for c, t in zip(zip(*found), types)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["doc_id", *names])

    return rows.mapInArrow(rate, schema)
