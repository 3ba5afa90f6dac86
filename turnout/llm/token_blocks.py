"""Token ids in a binary file of patched frame-of-reference blocks.

A segment holds the ids of some documents in order::

    magic "PFB1", ids (u64), blocks (u32)         header, little endian
    offset of each block in the body (u32 each)   index
    body: blocks of 512 ids (the last is shorter)

    block: minimum (u32), width (u8), exceptions (u16),
           low ``width`` bits of each id less the minimum, packed, padded to a byte,
           places of the exceptions (u16 each), their ids less the minimum (u32 each)

The width of a block is that of the value below which nine tenths of its ids lie; larger values are
the exceptions.  The index lets a reader decode any block by itself.  A file is a sequence of
segments; it is kept as the rows of a Parquet table, with the documents and sizes of each segment
beside it, so that any store that Spark writes to can hold it and lost tasks are written again.
"""

import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from turnout.llm.chunks import ByChunk, KeptWords, special_names, together
from turnout.llm.tables import checked_broadcast, lists, rows_of, scratch_folder
from turnout.llm.worker import kept

VOCABULARY = "byte_bpe_50k.json"
END = 2
BLOCK = 512
PERCENTILE = 90
SEGMENT = 1 << 18  # a segment ends with the document that reaches so many ids
AT_ONCE = 256  # blocks packed at a time

#: Characters encoded together, and runs between spaces that a worker remembers.
LETTERS = 1 << 24
CHUNKS_KEPT = 1_000_000

_MAGIC = b"PFB1"
_HEADER = struct.Struct("<4sQI")
_HEAD = struct.Struct("<IBH")


def _width(values: np.ndarray) -> np.ndarray:
    """Bits that each number takes."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of bytes with the low ``width`` bits of each number; eight numbers fill ``width`` bytes."""
    rows, size = values.shape
    eights = -(-size // 8)
    whole = np.zeros((rows, 8 * eights), np.uint64)
    whole[:, :size] = values
    whole = (whole & np.uint64((1 << width) - 1)).reshape(rows, eights, 8)
    out = np.zeros((rows, eights, width), np.uint8)
    for place in range(8):
        first, shift = divmod(place * width, 8)
        shifted = whole[:, :, place] << np.uint64(shift)
        for byte in range(-(-(shift + width) // 8)):
            out[:, :, first + byte] |= (shifted >> np.uint64(8 * byte)).astype(np.uint8)
    return out.reshape(rows, -1)[:, : -(-size * width // 8)]


def _unpacked(rows: np.ndarray, width: int, size: int) -> np.ndarray:
    """``size`` numbers of ``width`` bits from each row of bytes."""
    padded = np.zeros((len(rows), rows.shape[1] + 8), np.uint8)
    padded[:, : rows.shape[1]] = rows
    at = np.arange(size) * width
    first, shift = at >> 3, (at & 7).astype(np.uint64)
    values = np.zeros((len(rows), size), np.uint64)
    for byte in range(-(-(7 + width) // 8)):
        values |= padded[:, first + byte].astype(np.uint64) << np.uint64(8 * byte)
    return ((values >> shift) & np.uint64((1 << width) - 1)).astype(np.uint32)


def pack(ids: np.ndarray) -> bytes:
    """One segment."""
    ids = np.asarray(ids, np.uint32)
    count = -(-len(ids) // BLOCK)
    blocks = []
    whole = len(ids) // BLOCK * BLOCK
    for start in range(0, whole, BLOCK * AT_ONCE):
        blocks += _pack_blocks(ids[start : min(start + BLOCK * AT_ONCE, whole)].reshape(-1, BLOCK))
    if whole < len(ids):
        blocks += _pack_blocks(ids[None, whole:])
    offsets = np.cumsum([0, *map(len, blocks)])[:-1].astype("<u4")
    return _HEADER.pack(_MAGIC, len(ids), count) + offsets.tobytes() + b"".join(blocks)


def _pack_blocks(rows: np.ndarray) -> list[bytes]:
    low = rows.min(axis=1)
    rest = rows - low[:, None]
    kth = min(rows.shape[1] - 1, rows.shape[1] * PERCENTILE // 100)
    widths = _width(np.partition(rest, kth, axis=1)[:, kth])
    out = [b""] * len(rows)
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        body = _packed(rest[at], width) if width else np.empty((len(at), 0), np.uint8)
        for i, packed in zip(at.tolist(), body, strict=True):
            places = np.flatnonzero(rest[i] >> np.uint32(width) if width < 32 else rest[i] * 0)
            out[i] = (
                _HEAD.pack(int(low[i]), width, len(places)) + packed.tobytes()
                + places.astype("<u2").tobytes() + rest[i, places].astype("<u4").tobytes()
            )
    return out


def block_starts(segment: bytes) -> tuple[int, np.ndarray]:
    """The ids in a segment, and where each block starts in it."""
    magic, n, count = _HEADER.unpack_from(segment)
    if magic != _MAGIC:
        raise ValueError("not a segment of token blocks")
    index = np.frombuffer(segment, "<u4", count, _HEADER.size)
    return n, index.astype(np.int64) + _HEADER.size + 4 * count


def unpack_block(segment: bytes, start: int, size: int) -> np.ndarray:
    """One block by itself."""
    return _unpack_blocks(segment, [start], size)[0]


def _unpack_blocks(segment: bytes, starts: list[int], size: int) -> np.ndarray:
    """Blocks of ``size`` ids, as rows; those of a width together."""
    heads = [_HEAD.unpack_from(segment, start) for start in starts]
    out = np.zeros((len(starts), size), np.uint32)
    data = np.frombuffer(segment, np.uint8)
    widths = np.asarray([width for _, width, _ in heads])
    bodies = np.asarray(starts, np.int64) + _HEAD.size
    for width in set(widths.tolist()) - {0}:
        at = np.flatnonzero(widths == width)
        used = -(-size * width // 8)
        out[at] = _unpacked(data[bodies[at, None] + np.arange(used)], width, size)
    for row, (low, width, count), body in zip(out, heads, bodies.tolist(), strict=True):
        if count:
            end = body + -(-size * width // 8)
            places = np.frombuffer(segment, "<u2", count, end)
            row[places] = np.frombuffer(segment, "<u4", count, end + 2 * count)
        row += np.uint32(low)
    return out


def unpack(segment: bytes) -> np.ndarray:
    """All ids of a segment."""
    n, starts = block_starts(segment)
    whole = n // BLOCK
    starts, parts = starts.tolist(), []
    for first in range(0, whole, AT_ONCE):
        parts.append(_unpack_blocks(segment, starts[first : min(first + AT_ONCE, whole)], BLOCK).ravel())
    if whole < len(starts):
        parts.append(unpack_block(segment, starts[whole], n - whole * BLOCK))
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def _encoder(path: str) -> ByChunk:
    """One for each Python worker."""
    return kept(("token blocks", path), lambda: _new_encoder(path))


def _new_encoder(path: str) -> ByChunk:
    library = Tokenizer.from_file(path)

    def encode(text):
        (found,) = library.encode_batch_fast([text], add_special_tokens=False)
        return np.asarray(found.ids, "<u4")

    vocabulary = library.get_vocab()
    lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for letters, i in vocabulary.items():
        lengths[i] = len(letters)  # a letter for each byte
    names = special_names(path)
    return ByChunk(lambda text: encode(text).tobytes(), KeptWords(encode, lengths, names, CHUNKS_KEPT), names)


SEGMENTS = "part int, seq int, n_ids long, doc_ids array<long>, sizes array<long>, payload binary"


def _segments(path: str):
    def run(batches):
        encode, end = _encoder(path), np.asarray([END], "<u4").tobytes()
        part, seq = TaskContext.get().partitionId(), 0
        held, size = ([], []), 0

        def segment():
            ids = np.frombuffer(b"".join(held[1]), "<u4")
            sizes = np.asarray([len(x) // 4 for x in held[1]], np.int64)
            doc_ids = pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), pa.array(held[0], pa.int64()))
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()),
                doc_ids, lists([sizes], pa.int64()), pa.array([pack(ids)], pa.binary()),
            ], ["part", "seq", "n_ids", "doc_ids", "sizes", "payload"])

        for some, texts in together(batches, LETTERS):
            for doc_id, ids in zip(some, encode(texts), strict=True):
                held[0].append(doc_id)
                held[1].append(ids + end)
                size += len(ids) // 4 + 1
                if size >= SEGMENT:
                    yield segment()
                    held, size, seq = ([], []), 0, seq + 1
        if held[0]:
            yield segment()

    return run


def write_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    vocabulary: str | None = None,
) -> None:
    """Write the ids of all documents, each with the end id after it, in ascending order of the id.

    Rows without an id come first; rows that repeat an id go by their text.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    (
        texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
        .mapInArrow(_segments(vocabulary or public_tokenizers.path(VOCABULARY)), SEGMENTS)
        .write.parquet(path)
    )


def _reader(with_ids: bool):
    def run(batches):
        for batch in batches:
            for base, doc_ids, sizes, payload in rows_of(batch, "base", "doc_ids", "sizes", "payload"):
                ids = unpack(payload).astype("<u4")
                ends = np.cumsum(np.asarray(sizes, np.int64))
                starts = ends - np.asarray(sizes, np.int64)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = {
                    "doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(starts + base),
                    "n_tokens": pa.array(sizes, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                }
                if with_ids:
                    columns["ids"] = lists(np.split(ids.astype(np.int32), ends[:-1]), pa.int32())
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _bases(segments: DataFrame) -> DataFrame:
    """``base``, the ids before each segment: first over the parts, a row each, then inside them."""
    meta = segments.select("part", "seq", "n_ids")
    parts = meta.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = parts.withColumn(
        "before", F.sum("total").over(Window.orderBy("part")) - F.col("total")
    ).select("part", "before")
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    return meta.join(F.broadcast(before), "part").select(
        "part", "seq", (F.col("before") + inside).alias("base")
    )


def read_tokens(spark, path: str, with_ids: bool = True) -> DataFrame:
    """From the file: ``doc_id``, ``start`` (ids before the document), ``n_tokens``, ``ids_crc32``, ``ids``."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    bases = checked_broadcast(_bases(segments), segments.select("seq").count())
    located = segments.join(bases, ["part", "seq"])
    return located.select("base", "doc_ids", "sizes", "payload").mapInArrow(
        _reader(with_ids),
        "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids,
    )


def token_blocks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """Write the documents as token blocks in the shared folder, and what is read back.

    A null or empty text has the end id alone; rows that repeat each other or lack an id
    are written one by one.  Texts are encoded whole; the name of a special token in a text is that
    token, as the library has it.  Other columns are ignored; an empty table gives no rows.
    """
    path = scratch_folder(docs.sparkSession)
    write_tokens(docs, path, id_col, text_col, vocabulary)
    return read_tokens(docs.sparkSession, path, with_ids)
