"""Removal of passages that occur in an earlier document, behind a count-min sketch.

A window is 50 consecutive words.  The sketch counts, for each window, the documents
that hold it or a window of the same cell: the cell comes from the lowest hash of the 25
runs of 26 words inside the window, which is a function of the window's words alone, so no
window is counted too low, and neighbours mostly share a cell.  Each task sketches its documents;
the partial sketches are added up block by block, and what leaves that step is one
bit a cell: counted at least twice or not.

A second pass groups, exactly and by 96-bit hashes, only the windows whose bits are set in both
rows of the sketch, and finds the first document of each.

The sketch has at most ``MAX_CELLS`` cells a row, so the bits never exceed 64 MB.  On a larger
corpus more windows pass it and are grouped; the result stays exact.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from turnout.llm.tables import rows_of, shared_bytes, stored
from turnout.llm.words import distinct, encoded, mix, sliding_min, window_hashes, word_hashes
from turnout.llm.worker import release

WINDOW = 50
RUN = 26
ROWS = 2
BLOCK = 1 << 16
MIN_CELLS, MAX_CELLS = 1 << 18, 1 << 28
#: Cells a byte of text; about four for each distinct lowest run of usual prose.
CELLS_A_BYTE = 0.05
FLUSH = 1_000_000


def sketch_cells(n_bytes: int) -> int:
    """Cells of a row of the sketch for so many bytes of text, a power of two."""
    cells = MIN_CELLS
    while cells < min(MAX_CELLS, CELLS_A_BYTE * n_bytes):
        cells *= 2
    return cells


def _keys(words: np.ndarray) -> np.ndarray:
    """For each window its lowest run."""
    return sliding_min(window_hashes(words, RUN)[0], WINDOW - RUN + 1)


def _cells(keys: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (mix(keys, 41 + row) & np.uint64(cells - 1)).astype(np.int64)


PARTIAL = "part int, cells binary, counts binary"


def _partial_sketches(cells: int):
    """Sparse sketches of some documents: block, places in the block, counts up to two."""
    blocks = cells // BLOCK

    def flush(keys):
        keys = np.concatenate(keys)
        out = ([], [], [])
        for row in range(ROWS):
            at, counts = np.unique(_cells(keys, row, cells), return_counts=True)
            counts = np.minimum(counts, 2).astype(np.uint8)
            cuts = np.searchsorted(at, np.arange(blocks + 1) * BLOCK)
            at = (at % BLOCK).astype("<u2")
            for block in np.flatnonzero(np.diff(cuts)):
                own = slice(cuts[block], cuts[block + 1])
                out[0].append(row * blocks + int(block))
                out[1].append(at[own].tobytes())
                out[2].append(counts[own].tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())],
            ["part", "cells", "counts"],
        )

    def run(batches):
        release()
        held, count = [], 0
        for batch in batches:
            for (text,) in rows_of(batch, "text"):
                words = word_hashes(encoded(text, False))
                if len(words) >= WINDOW:
                    held.append(distinct(_keys(words)))  # a document counts once
                    count += len(held[-1])
                if count >= FLUSH:
                    yield flush(held)
                    held, count = [], 0
        if held:
            yield flush(held)

    return run


def _merged(batches):
    """Add up the partial sketches of each block, which follow one another; one bit a cell."""
    def bits(part, total):
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([np.packbits(total >= 2).tobytes()], pa.binary())],
            ["part", "bits"],
        )

    now, total = None, None
    for batch in batches:
        for part, cells, counts in rows_of(batch, "part", "cells", "counts"):
            if part != now:
                if now is not None:
                    yield bits(now, total)
                now, total = part, np.zeros(BLOCK, np.uint8)
            at = np.frombuffer(cells, "<u2")
            total[at] = np.minimum(total[at] + np.frombuffer(counts, np.uint8), 2)
    if now is not None:
        yield bits(now, total)


def repeated_cells(texts: DataFrame) -> tuple[np.ndarray, int]:
    """The bits of the merged sketch, all rows after one another, and the cells of a row."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = sketch_cells(size)
    blocks = stored(
        texts.mapInArrow(_partial_sketches(cells), PARTIAL)
        .repartition("part").sortWithinPartitions("part")
        .mapInArrow(_merged, "part int, bits binary")
    )
    bits = np.zeros(ROWS * cells // 8, np.uint8)
    for block in blocks.toLocalIterator():  # at most MAX_CELLS * ROWS / 8 bytes in all
        bits[block.part * BLOCK // 8 : (block.part + 1) * BLOCK // 8] = np.frombuffer(block.bits, np.uint8)
    return bits, cells


#: ``place`` holds the version in its upper and the start of the window in its lower 32 bits.
WINDOWS = "doc_id long, place long, h1 long, h2 int"


def _suspects(bits, cells: int):
    """Windows estimated in two documents or more."""
    def flush(held):
        columns = [np.concatenate(x) for x in zip(*held, strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in columns], ["doc_id", "place", "h1", "h2"]
        )

    def run(batches):
        release()
        held, count, set_bits = [], 0, bits.value
        for batch in batches:
            for doc_id, version, text in rows_of(batch, "doc_id", "version", "text"):
                words = word_hashes(encoded(text, False))
                if len(words) < WINDOW:
                    continue
                keys = _keys(words)
                seen = np.ones(len(keys), bool)
                for row in range(ROWS):
                    at = _cells(keys, row, cells)
                    seen &= (set_bits[(row * cells + at) >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
                at = np.flatnonzero(seen)
                if not len(at):
                    continue
                h1, h2 = window_hashes(words, WINDOW)
                held.append((
                    np.full(len(at), doc_id), (version << 32) | at, h1[at].view(np.int64),
                    (h2[at] & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32),
                ))
                count += len(at)
                if count >= FLUSH:
                    yield flush(held)
                    held, count = [], 0
        if held:
            yield flush(held)

    return run


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``version`` and ``starts``: where windows start that an earlier document holds.

    ``docs`` has ``doc_id``, ``version`` (32 bits that tell apart rows that repeat an id) and ``text``.
    """
    bits, cells = repeated_cells(docs.select("text"))
    suspects = docs.where("doc_id is not null").mapInArrow(
        _suspects(shared_bytes(docs.sparkSession, bits), cells), WINDOWS
    )
    # Reduced before the shuffle: a passage that a third of the documents hold is one row a task.
    first = suspects.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"))
    return (
        suspects.join(first, ["h1", "h2"]).where("doc_id > first")
        .groupBy("doc_id", F.expr("int(place >> 32)").alias("version"))
        .agg(F.collect_set(F.expr("int(place & 4294967295L)")).alias("starts"))
    )


KEPT = "doc_id long, n_words long, n_removed long, kept string"
DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _covered(n: int, starts) -> np.ndarray:
    edges = np.zeros(n + 1, np.int32)
    starts = np.asarray(starts, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + WINDOW, n), -1)
    return np.cumsum(edges[:n]) > 0


def _removed(digest: bool):
    def run(batches):
        release()
        for batch in batches:
            held = ([], [], [], [])
            for doc_id, text, starts in rows_of(batch, "doc_id", "text", "starts"):
                words = encoded(text, False).split()
                n, gone = len(words), 0
                if starts:
                    covered = _covered(n, starts)
                    gone = int(covered.sum())
                    words = [w for w, c in zip(words, covered, strict=True) if not c]
                kept = b" ".join(words)
                value = hashlib.sha256(kept).hexdigest() if digest else kept.decode()
                for column, x in zip(held, (doc_id, n, gone, value), strict=True):
                    column.append(x)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(held, types, strict=True)],
                ["doc_id", "n_words", "n_removed", "kept_sha256" if digest else "kept"],
            )

    return run


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (or its SHA-256) for each row.

    Each word covered by a window whose words also start a window in a document
    with a smaller id is removed; windows are judged on the input.  Words are kept as they are and
    joined by one space.  Null and blank texts have no words.  A document never loses a passage to
    itself, nor to a row with the same id; such rows are judged one by one.  A row without an
    id keeps all its words and removes nothing elsewhere.  An empty table gives an empty result; other columns
    are ignored; texts are read whole.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).withColumn("version", F.hash("text"))
    starts = stored(repeated_windows(texts))
    return (
        texts.join(starts, ["doc_id", "version"], "left").select("doc_id", "text", "starts")
        .mapInArrow(_removed(digest), DIGEST if digest else KEPT)
    )


def stripped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the same columns, whatever their names, and repeated passages removed from the text.

    A text that loses nothing stays as it is, null included; of the others the kept words remain, joined by one
    space.  Rows that share an id, or lack one, are as in ``without_repeats``.
    """
    # Other columns travel in one struct, so that none can clash.
    rest = [c for c in docs.columns if c != text_col]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"), F.hash(F.col(f"`{text_col}`")).alias("version"),
    )
    starts = stored(repeated_windows(rows.select("doc_id", "version", "text")))

    @F.pandas_udf("string")
    def kept(texts, spans):
        def one(text, starts):
            words = encoded(text, False).split()
            covered = _covered(len(words), starts)
            return b" ".join(w for w, c in zip(words, covered, strict=True) if not c).decode()

        release()
        return pd.Series([one(t, s) if s is not None else t for t, s in zip(texts, spans, strict=True)])

    joined = rows.join(starts, ["doc_id", "version"], "left").select("rest", kept("text", "starts").alias("kept"))
    return joined.select(*[
        F.col("kept").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in docs.columns
    ])
