"""Token ids as binary files: frequency-ranked ids in byte-aligned variable-length code.

Documents become ids of a public tokenizer. The ids are replaced by their frequency rank, so common ones take one byte.
A block holds two byte streams: control bytes (two bits per id: its length less one) and data bytes (1 to 4 per id, low
byte first). numpy decodes them by table lookup. Blocks are rows of Parquet files, written in ascending order of the
document id; a second small file maps ranks to ids.

The package must be importable on the executors, where each Python worker keeps a bounded memory of encoded words.
"""

import json
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskloom.llm.words import counts_by_text, run_hashes, slices, text_bytes
from deskloom.session import scratch_path, stored

# The normalisation and word pattern under which blanks separate independent words.
WORD_PIPELINE = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
# Bytes of the simple part of UTF-8: printable ASCII but for the apostrophe, and U+00C0 to U+00FF but for the two signs.
LETTER, DIGIT, OTHER, SPACE = range(4)
CLASS = np.array([SPACE if c in b" \t\n\x0b\x0c\r" else LETTER if c == 0xC3 or 0x80 <= c < 0xC0 or chr(c).isalpha() and c < 128
                  else DIGIT if 48 <= c < 58 else OTHER for c in range(256)], np.int8)
ODD = np.array([c < 32 and c not in b"\t\n\x0b\x0c\r" or c in b"'\x7f" or c >= 0xC0 and c != 0xC3 for c in range(256)])
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def byte_letters() -> dict[int, str]:
    """Code point -> the letter that byte-level vocabularies write for a byte; bytes without a visible one come from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{b: chr(b) for b in visible}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


def pieces_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, lower-cased where simple; first and last byte + 1, hash, whether odd, of each piece; pieces per
    text).

    A simple word falls into runs of letters, single digits and runs of other characters. A word with odd bytes, for
    which more rules hold, is one piece as it stands.
    """
    raw = np.frombuffer(b" " + b" ".join(texts) + b"  ", np.uint8)
    kind = CLASS[raw]
    inside = kind != SPACE
    follows = raw[1:]
    odd = ODD[raw]
    odd[:-1] |= (raw[:-1] == 0xC3) & ((follows == 0x97) | (follows == 0xB7)) | (raw[:-1] == ord("<")) & (follows == ord("|"))
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    words, ends = edges[::2], edges[1::2]
    counts = np.concatenate([[0], np.cumsum(odd)])
    strange = counts[ends] > counts[words]
    whole = np.zeros(len(raw) + 1, np.int8)  # marks the bytes of odd words
    whole[words[strange]] += 1
    whole[ends[strange]] -= 1
    whole = np.cumsum(whole[:-1], dtype=np.int8).astype(bool)
    lower = np.where(whole, raw, LOWER[raw])
    upper = np.zeros(len(raw), bool)
    upper[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & ~whole[1:]
    lower = np.where(upper, lower + 0x20, lower).astype(np.uint8)
    start = inside.copy()
    start[1:] &= ~inside[:-1] | ~whole[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT))
    first = np.flatnonzero(start)
    last = np.append(first[1:], len(raw))
    last = np.minimum(last, ends[np.searchsorted(ends, first, "right")]) if len(first) else last[:0]
    hashes = run_hashes(lower, first, last) ^ np.where(whole[first], np.uint64(0x5851F42D4C957F2D), np.uint64(0))
    return lower, first, last, hashes, whole[first], counts_by_text(first, texts)


class TextEncoder:
    """Texts to ids as the tokenizer gives them, as bytes of ``kind``.

    What a piece becomes is remembered under its 64-bit hash, up to ``remember`` pieces.
    """

    def __init__(self, vocabulary: str, remember: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        config = json.loads(vocabulary)
        self.by_word = all(config[part] == rule for part, rule in WORD_PIPELINE.items())
        size = max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=0) + 1
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.letters, self.remember = byte_letters(), remember
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.rows = np.empty(0, np.uint64), np.empty(0, np.int64)  # sorted hashes and their rows
        self.starts, self.ids = np.zeros(1, np.int64), np.empty(0, self.kind)   # ids of row i: starts[i]:starts[i + 1]

    def _whole(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids

    def _piece(self, piece: bytes, odd: bool) -> list[int]:
        if odd:
            return self._whole(piece)
        return [t.id for t in self.tokenizer.model.tokenize(piece.decode("latin-1").translate(self.letters))]

    def _rows_of(self, hashes: np.ndarray, lower: np.ndarray, first: np.ndarray, last: np.ndarray, odd: np.ndarray) -> np.ndarray:
        """Rows of the pieces; those that are new are encoded first."""
        if len(self.hashes) > self.remember:
            self._forget()
        distinct, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        there = place < len(self.hashes)
        known[there] = self.hashes[place[there]] == distinct[there]
        if not known.all():
            new = where[~known]
            made = [self._piece(lower[a:b].tobytes(), o) for a, b, o in zip(first[new].tolist(), last[new].tolist(), odd[new].tolist())]
            sizes = np.fromiter(map(len, made), np.int64, len(made))
            rows = len(self.starts) - 1 + np.arange(len(made))
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(made), self.kind, int(sizes.sum()))])
            self.hashes = np.insert(self.hashes, place[~known], distinct[~known])
            self.rows = np.insert(self.rows, place[~known], rows)
            place = np.searchsorted(self.hashes, distinct)
        return self.rows[place][back]

    def encode(self, texts: list[bytes], end_id: int) -> list[bytes]:
        """Ids of each text and the end id, as bytes."""
        end = np.array([end_id], self.kind).tobytes()
        if not self.by_word:
            return [np.array(self._whole(t), self.kind).tobytes() + end for t in texts]
        lower, first, last, hashes, odd, counts = pieces_of(texts)
        rows = self._rows_of(hashes, lower, first, last, odd)
        sizes = self.starts[rows + 1] - self.starts[rows]
        totals = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.starts[rows] - totals + sizes, sizes) + np.arange(sizes.sum())]
        edges = np.concatenate([[0], totals])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [ids[a:b].tobytes() + end for a, b in zip(edges[:-1], edges[1:])]


_ENCODERS: dict[int, TextEncoder] = {}


def encoder_of(vocabulary: str) -> TextEncoder:
    """One encoder per Python worker, so that its memory serves all tasks there."""
    key = xxhash.xxh3_64_intdigest(vocabulary)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = TextEncoder(vocabulary)
    return _ENCODERS[key]


# Lengths of the four ids of each control byte.
LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of non-negative integers below 2 ** 32."""
    values = values.astype(np.uint32)
    extra = (values >= 1 << 8).astype(np.uint8) + (values >= 1 << 16) + (values >= 1 << 24)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[:len(values)] = extra
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    used = np.arange(4) <= extra[:, None]
    return control.tobytes(), values.astype("<u4").view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    out = np.zeros((count, 4), np.uint8)
    out[np.arange(4) < lengths[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").reshape(-1)


@dataclass(frozen=True)
class TokenFiles:
    """Where the files of a corpus are: ``path``/blocks and ``path``/ranks."""

    path: str

    def blocks(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/blocks")

    def ids_by_rank(self, spark: SparkSession) -> np.ndarray:
        """At most one entry per id of the vocabulary."""
        rows = spark.read.parquet(f"{self.path}/ranks").collect()
        ids = np.zeros(len(rows), np.uint32)
        for row in rows:
            ids[row["rank"]] = row["id"]
        return ids


def token_rows(docs: DataFrame, vocabulary: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, tie, ids): ids as compressed bytes, the end id included; a null text has that one only."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def encode(batches):
        encoder, packer = encoder_of(shared.value), zstandard.ZstdCompressor(level=1)
        for part in slices(batches, 1 << 18):
            ids = encoder.encode(text_bytes(part.column(1)), end_id)
            ties = [xxhash.xxh3_64_intdigest(x) >> 1 for x in ids]
            packed = pa.array(map(packer.compress, ids), pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ties, pa.int64()), packed], names=["doc_id", "tie", "ids"])

    return rows.mapInArrow(encode, f"doc_id {dict(rows.dtypes)['doc_id']}, tie bigint, ids binary")


def id_counts(tokens: DataFrame, kind: np.dtype) -> DataFrame:
    """(id, n): at most one row per id of the vocabulary from each task."""

    def count(batches):
        total, unpacker = np.zeros(0, np.int64), zstandard.ZstdDecompressor()
        for batch in slices(batches, 2 << 20):
            found = np.bincount(np.frombuffer(b"".join(map(unpacker.decompress, batch.column(0).to_pylist())), kind))
            total, found = (total, found) if len(total) >= len(found) else (found.astype(np.int64), total)
            total[:len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    return tokens.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write_tokens(docs: DataFrame, vocabulary: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
                 path: str | None = None, block_ids: int = 1 << 19) -> TokenFiles:
    """Encode all documents and write them in ascending order of their ids (null first, equal ones by a hash of content).

    Null and empty texts are written as the end id alone; repeated rows are written as often as they occur. An empty
    table gives files without blocks.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    kind = TextEncoder(vocabulary, 1).kind
    tokens = stored(token_rows(docs, vocabulary, end_id, id_col, text_col), "token-rows")
    counted = sorted((-row["n"], row["id"]) for row in id_counts(tokens, kind).collect())
    ids = [i for _, i in counted]
    spark.createDataFrame(list(enumerate(ids)), "rank int, id bigint").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(max(ids, default=0) + 1, np.uint32)
    rank_of[ids] = np.arange(len(ids))
    shared = spark.sparkContext.broadcast(rank_of)
    id_type = dict(tokens.dtypes)["doc_id"]
    schema = (f"part int, start bigint, n bigint, doc_ids array<{id_type}>, counts array<bigint>, control binary, "
              "data binary")

    def blocks(batches):
        part, written, unpacker = TaskContext.get().partitionId(), 0, zstandard.ZstdDecompressor()
        doc_ids, held, size = [], [], 0

        def block():
            control, data = pack(shared.value[np.concatenate(held)])
            return pa.RecordBatch.from_pylist([{
                "part": part, "start": written, "n": size, "doc_ids": doc_ids, "counts": [len(h) for h in held],
                "control": control, "data": data}], pa.schema([
                    ("part", pa.int32()), ("start", pa.int64()), ("n", pa.int64()), ("doc_ids", pa.list_(id_kind)),
                    ("counts", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary())]))

        for batch in slices(batches, 2 << 20):
            id_kind = batch.column(0).type
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                doc_ids.append(doc_id)
                held.append(np.frombuffer(unpacker.decompress(ids), kind))
                size += len(held[-1])
                if size >= block_ids:
                    yield block()
                    written, doc_ids, held, size = written + size, [], [], 0
        if held:
            yield block()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc()]
    ordered = tokens.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered.mapInArrow(blocks, schema).write.parquet(f"{path}/blocks")
    return TokenFiles(path)


def read_tokens(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """(doc_id, start, ids): every document as read back from the files; ``start`` counts the ids before it."""
    blocks = files.blocks(spark)
    shared = spark.sparkContext.broadcast(files.ids_by_rank(spark))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (blocks.groupBy("part").agg(F.sum("n").alias("_n"))  # one row per written partition
               .select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("offset")))
    placed = blocks.join(F.broadcast(offsets), "part").select(
        (F.col("offset") + F.col("start")).alias("start"), "n", "doc_ids", "counts", "control", "data")
    id_type = dict(blocks.dtypes)["doc_ids"][len("array<"):-1]

    def decode(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                start, n, counts, control, data = (batch.column(k)[i].as_py() for k in (0, 1, 3, 4, 5))
                ids = shared.value[unpack(control, data, n)].astype("<u4")
                edges = np.concatenate([[0], np.cumsum(counts)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2)[i].values, pa.array(start + edges[:-1], pa.int64()),
                     pa.array([ids[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())],
                    names=["doc_id", "start", "ids"])

    return placed.mapInArrow(decode, f"doc_id {id_type}, start bigint, ids binary")


def digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of documents that were read back."""

    def digest(batches):
        for batch in batches:
            ids = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([zlib.crc32(x) for x in ids], pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.mapInArrow(digest, f"doc_id {dict(tokens.dtypes)['doc_id']}, start bigint, n_tokens bigint, ids_crc32 bigint")
