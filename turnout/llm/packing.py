"""Documents packed into sequences of bounded length by harmonic classes.

A document's ids are cut into pieces: whole sequences, then descending powers of two
down to ``LEAST``, then the rest.  A piece of length n belongs to class k = CAPACITY div n, for
lengths from CAPACITY / (k + 1), exclusive, to CAPACITY / k; a bin of the class takes k pieces, whatever
they are.  Which bin a piece goes to follows from its number in its class alone, so every worker
numbers its own pieces and needs nothing of the others but how many they have.  A class of powers of
two wastes nothing, a class below ``LEAST`` at most one part in k + 1.

Pieces that do not fill a last bin are fewer than k of each class, so there are fewer than
CAPACITY * ln(LEAST) or so in a corpus of any size; they go into common bins, the longest first.
"""

import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from turnout.llm.chunks import together
from turnout.llm.tables import checked_broadcast, stored
from turnout.llm.word_ids import VOCABULARY, word_ids

CAPACITY = 2048
#: Rests below this length are not cut further.
LEAST = 64
END = 1

FIELDS = {
    "doc_id": "long", "start": "long", "length": "long", "ids_crc32": "long", "doc_tokens": "long",
    "class": "int", "worker": "int", "number": "long",
}
RESULT = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def cuts(n: int, capacity: int = CAPACITY, least: int = LEAST) -> list[int]:
    """Lengths of the pieces of a document with ``n`` ids."""
    lengths = [capacity] * (n // capacity)
    rest = n % capacity
    while rest >= least:
        lengths.append(1 << (rest.bit_length() - 1))
        rest -= lengths[-1]
    return lengths + [rest] * (rest > 0)


def _cut(path: str, capacity: int, least: int):
    kinds = {"long": pa.int64(), "int": pa.int32()}

    def run(batches):
        encode, end = word_ids(path), np.asarray([END], "<u4").tobytes()
        worker, seen = TaskContext.get().partitionId(), {}
        for doc_ids, texts in together(batches):
            rows = []
            for doc_id, ids in zip(doc_ids, encode(texts), strict=True):
                ids, start = ids + end, 0
                for length in cuts(len(ids) // 4, capacity, least):
                    k = capacity // length
                    number = seen[k] = seen.get(k, -1) + 1
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc_id, start, length, crc, len(ids) // 4, k, worker, number))
                    start += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kinds[t]) for c, t in zip(zip(*rows), FIELDS.values(), strict=True)],
                list(FIELDS),
            )

    return run


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
    capacity: int = CAPACITY, least: int = LEAST,
) -> DataFrame:
    """The pieces of all documents with class, worker and number in the worker's class, stored."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    return stored(texts.mapInArrow(
        _cut(path, capacity, least), ", ".join(f"{name} {kind}" for name, kind in FIELDS.items())
    ))


def common_bins(lengths: list[int], capacity: int) -> list[int]:
    """A bin for each length: descending lengths, each into the first bin with room."""
    bins, room = [0] * len(lengths), []
    open_from = 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = next((b for b in range(open_from, len(room)) if room[b] >= lengths[i]), len(room))
        if at == len(room):
            room.append(capacity)
        room[at] -= lengths[i]
        bins[i] = at
        while open_from < len(room) and not room[open_from]:
            open_from += 1
    return bins


def _common(capacity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["class", "rank"], kind="stable")
        bins = pd.Series(common_bins(rows["length"].tolist(), capacity), index=rows.index)
        return rows.assign(sequence_id=rows["sequence_id"] + bins)

    return run


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id`` and ``offset`` for each stored piece; sequences count from 0 without gaps."""
    counts = stored(cut.groupBy("class", "worker").agg(F.count("*").alias("n")))
    before = F.sum("n").over(Window.partitionBy("class").orderBy("worker")) - F.col("n")
    totals = counts.groupBy("class").agg(F.sum("n").alias("total"))  # a row for each class
    full = F.floor(F.col("total") / F.col("class"))
    totals = totals.select(
        "class", full.alias("full"), (F.sum(full).over(Window.orderBy("class")) - full).alias("base"),
        F.sum(full).over(Window.partitionBy()).alias("bins"),
    )
    offsets = stored(counts.select("class", "worker", before.alias("before")).join(totals, "class"))
    numbered = cut.join(checked_broadcast(offsets), ["class", "worker"]).withColumn(
        "rank", F.col("before") + F.col("number"))
    whole = F.col("rank") < F.col("full") * F.col("class")
    columns = [*RESULT[:5], "class", "rank", "sequence_id"]
    in_class = numbered.where(whole).withColumn(
        "sequence_id", F.col("base") + F.floor(F.col("rank") / F.col("class"))).select(columns)
    rest = numbered.where(~whole).withColumn("sequence_id", F.col("bins")).select(columns)
    rest = rest.groupBy("sequence_id").applyInPandas(
        _common(capacity), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest.schema))
    earlier = Window.partitionBy("sequence_id").orderBy("class", "rank").rowsBetween(
        Window.unboundedPreceding, -1)
    return in_class.unionByName(rest).withColumn(
        "offset", F.coalesce(F.sum("length").over(earlier), F.lit(0).cast("long"))).select(*RESULT)


def packing(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
    capacity: int = CAPACITY, least: int = LEAST,
) -> DataFrame:
    """A row for each piece: ``doc_id``, ``start`` (ids of its document before it), ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and ``offset`` in the sequence.

    Ids are those of the library without added special tokens, then the end id.  A null or empty text has
    the end id alone.  Every row is a document: rows that repeat each other or lack an id are packed one
    by one.  A text of any length is cut into whole sequences first.  Other columns are ignored; an empty table
    gives no rows.  Which sequence a piece goes to depends on how the table is split into tasks.
    """
    return pack(pieces(docs, id_col, text_col, vocabulary, capacity, least), capacity)
