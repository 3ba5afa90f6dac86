"""Ranked lexical search by the Best Position Algorithm.

The documents are indexed in segments: the terms of some hundreds of thousands of words, and for each the documents
that hold it.  A segment's lists are put in descending order of impact, and an item is searched for in the
lists of its terms together: blocks of the next unseen positions are read, each document met is looked up
directly in all other lists, and every position so seen counts.  A list's best position is the
end of its unbroken run of seen positions.  No unseen document can score more than the sum of the
impacts just behind the best positions, so the search of a segment stops when that sum is strictly below the
kth score found: a tie with the kth is still met.

Every segment is searched for every item; each task keeps its k best of an item, whose last score also
stops the search of its later segments, and the best of all tasks are ranked.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from turnout.llm.tables import checked_broadcast, lists, rows_of, shared_bytes, stored
from turnout.llm.words import word_hashes

K = 10
#: Words of the documents of a segment; it ends with the document that reaches them.
SEGMENT = 1 << 20
#: Items and terms of items that are searched for together.
ITEMS, ITEM_TERMS = 1024, 1 << 20
#: Positions read from each list in the first round; twice as many in each following one.
STEP, MOST_STEP = 32, 2048
#: Pairs of a list and a position, or of a list and a document, that are looked at together.
CELLS = 1 << 20

SHIFT = 36  # bits of an impact: below 1000 * ln(2**64) * 10**6
_NO_ID = np.iinfo(np.int64).max

#: Bytes of terms: digits, letters in lower case, and all beyond ASCII; the others separate.
LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

INDEX = (
    "doc_ids array<long>, lengths array<long>, terms array<long>, sizes array<int>, "
    "docs array<int>, tfs array<int>"
)


def term_hashes(text: str | None) -> np.ndarray:
    """The 64-bit hash of each term of a text, in order."""
    return word_hashes((text or "").encode("utf-8", "replace").translate(LETTERS)).view(np.int64)


def _edges(x: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers start."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.empty(0, np.int64)


def _segment(doc_ids: list, hashes: list[np.ndarray]) -> pa.RecordBatch:
    lengths = np.asarray([len(h) for h in hashes], np.int64)
    terms = np.concatenate(hashes)
    order = np.argsort(terms, kind="stable")
    terms, docs = terms[order], np.repeat(np.arange(len(lengths)), lengths)[order]
    change = np.concatenate([[True], (terms[1:] != terms[:-1]) | (docs[1:] != docs[:-1])])
    postings = np.flatnonzero(change)
    tfs = np.diff(postings, append=len(terms))
    terms, docs = terms[postings], docs[postings]
    first = _edges(terms)
    ids = pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), pa.array(doc_ids, pa.int64()))
    return pa.RecordBatch.from_arrays(
        [ids, lists([lengths], pa.int64()), lists([terms[first]], pa.int64()),
         lists([np.diff(first, append=len(terms))], pa.int32()), lists([docs], pa.int32()), lists([tfs], pa.int32())],
        ["doc_ids", "lengths", "terms", "sizes", "docs", "tfs"],
    )


def _indexed(batches):
    ids, hashes, words = [], [], 0
    for batch in batches:
        for doc_id, text in rows_of(batch, "doc_id", "text"):
            found = term_hashes(text)
            if not len(found):
                continue
            ids.append(doc_id)
            hashes.append(found)
            words += len(found)
            if words >= SEGMENT:
                yield _segment(ids, hashes)
                ids, hashes, words = [], [], 0
    if ids:
        yield _segment(ids, hashes)


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A stored row for each segment: its documents, terms and postings by term and document.

    Each is a row group, so that a task has one decoded at a time, however many its files hold.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return stored(texts.mapInArrow(_indexed, INDEX), group_rows=1)


def _item_terms(batches):
    key = block = TaskContext.get().partitionId() << 33
    items = terms = 0
    for batch in batches:
        for item_id, text in rows_of(batch, "item_id", "text"):
            hashes, counts = np.unique(term_hashes(text), return_counts=True)
            if items == ITEMS or items and terms + len(hashes) > ITEM_TERMS:
                block, items, terms = block + 1, 0, 0
            items, terms = items + 1, terms + len(hashes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([key], pa.int64()), pa.array([item_id], pa.int64()),
                 lists([hashes], pa.int64()), lists([counts], pa.int64())],
                ["block", "key", "item_id", "terms", "repeats"],
            )
            key += 1


def _term_sizes(batches):
    """Each term of each segment; to explode the arrays would make an object of every term of a segment at once."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            yield pa.RecordBatch.from_arrays([row.column(c).flatten() for c in ("terms", "sizes")], ["term", "size"])


def _weighted(items: DataFrame, segments: DataFrame, n_docs: int) -> DataFrame:
    """A row for each item with the lists of its terms that some document holds, stored."""
    pairs = items.select(
        "block", "key", "item_id", F.explode(F.arrays_zip("terms", "repeats")).alias("t")
    ).select("block", "key", "item_id", F.col("t.terms").alias("term"), F.col("t.repeats").alias("repeats"))
    wanted = stored(pairs.select("term").distinct())
    sizes = segments.select("terms", "sizes").mapInArrow(_term_sizes, "term long, size int")
    df = sizes.join(checked_broadcast(wanted), "term", "left_semi").groupBy("term").agg(F.sum("size").alias("df"))
    odds = F.lit(2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
    weights = df.select("term", F.floor(1000 * F.log(odds)).cast("long").alias("weight"))
    return stored(
        pairs.join(weights.where("weight > 0"), "term").groupBy("block", "key", "item_id").agg(
            F.sort_array(F.collect_list(F.struct("term", "weight", "repeats"))).alias("terms"))
    )


def length_norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of each document, in integers."""
    if int(lengths.max(initial=0)) * n_docs * 75 < 2**63:
        return 25 + 75 * n_docs * lengths // n_terms
    return np.asarray([25 + 75 * int(n) * n_docs // n_terms for n in lengths], np.int64)


class Lists:
    """The impact lists of a segment for the terms of a block of items."""

    def __init__(self, row: dict, terms: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int):
        own, sizes = np.asarray(row["terms"]), np.asarray(row["sizes"], np.int64)
        starts = np.cumsum(sizes) - sizes
        at = np.searchsorted(own, terms)
        at[at == len(own)] = 0
        self.number = np.where(own[at] == terms, 0, -1)
        held = np.flatnonzero(self.number == 0)
        self.number[held] = np.arange(len(held))
        sizes, starts = sizes[at[held]], starts[at[held]]
        self.end = np.cumsum(sizes)
        self.start = self.end - sizes
        flat = np.repeat(starts - self.start, sizes) + np.arange(sizes.sum())
        owner = np.repeat(np.arange(len(held)), sizes)
        self.docs = np.asarray(row["docs"], np.int64)[flat]
        tf = np.asarray(row["tfs"], np.int64)[flat]
        norm = length_norms(np.asarray(row["lengths"], np.int64), n_docs, n_terms)
        self.impact = weights[held][owner] * (1_000_000_000 * tf // (1000 * tf + 8 * norm[self.docs]))
        self.n_docs = len(norm)
        self.place = owner * self.n_docs + self.docs  # ascending: direct access by list and document
        self.by_impact = np.argsort((owner << SHIFT) - self.impact, kind="stable")
        self.position = np.empty(len(flat), np.int64)
        self.position[self.by_impact] = np.arange(len(flat))

    def search(self, numbers: np.ndarray, repeats: np.ndarray, ids: np.ndarray, k: int, floor: int):
        """Scores and documents of the k best above or at ``floor``, best first, ties by ``ids``."""
        best, end = self.start[numbers].copy(), self.end[numbers]
        seen, met = np.zeros(len(self.docs), bool), np.zeros(self.n_docs, bool)
        top, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        most = max(1, min(MOST_STEP, CELLS // len(numbers)))
        step = min(STEP, most)
        while True:
            live = np.flatnonzero(best < end)
            bound = int((repeats[live] * self.impact[self.by_impact[best[live]]]).sum())
            if not bound or bound < floor:
                return scores, top
            reads = best[live, None] + np.arange(step)
            reads = self.by_impact[reads[reads < end[live, None]]]
            new = np.unique(self.docs[reads])
            new = new[~met[new]]
            met[new] = True
            for some in np.array_split(new, len(numbers) * len(new) // CELLS + 1):
                # Direct access to every list of the item.
                wanted = numbers[:, None] * self.n_docs + some
                at = np.minimum(np.searchsorted(self.place, wanted), len(self.place) - 1)
                found = self.place[at] == wanted
                seen[self.position[at[found]]] = True
                gained = (np.where(found, self.impact[at], 0) * repeats[:, None]).sum(axis=0)
                keep = gained >= max(floor, 1)
                top, scores = np.concatenate([top, some[keep]]), np.concatenate([scores, gained[keep]])
            if len(top) > k:
                order = np.lexsort((ids[top], -scores))[:k]
                top, scores = top[order], scores[order]
            if len(top) == k:
                floor = max(floor, int(scores.min()))
            self._advance(best, end, seen, step)
            step = min(2 * step, most)

    @staticmethod
    def _advance(best: np.ndarray, end: np.ndarray, seen: np.ndarray, width: int) -> None:
        """Move each best position over the seen ones behind it."""
        todo = np.flatnonzero(best < end)
        while len(todo):
            ahead = best[todo, None] + np.arange(width)
            inside = ahead < end[todo, None]
            run = seen[np.where(inside, ahead, 0)] & inside
            whole = run.all(axis=1)
            best[todo] += np.where(whole, width, run.argmin(axis=1))
            todo = todo[whole]


class Block:
    """Items that are searched for together, with the weights of their terms."""

    def __init__(self, rows: list):
        weights = {t.term: t.weight for r in rows for t in r.terms}
        self.terms = np.asarray(sorted(weights), np.int64)
        self.weights = np.asarray([weights[t] for t in self.terms.tolist()], np.int64)
        self.items = [
            (r.key, r.item_id, np.searchsorted(self.terms, [t.term for t in r.terms]),
             np.asarray([t.repeats for t in r.terms], np.int64)) for r in rows
        ]


def _searched(shared, n_docs: int, n_terms: int, k: int):
    def run(batches):
        block = shared.value
        best = {key: [] for key, *_ in block.items}
        names = ["doc_ids", "lengths", "terms", "sizes", "docs", "tfs"]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in names[1:]}
                doc_ids = batch.column("doc_ids")[i].as_py()
                ids = np.asarray([_NO_ID if d is None else d for d in doc_ids], np.int64)
                held = Lists(row, block.terms, block.weights, n_docs, n_terms)
                for key, _, terms, repeats in block.items:
                    numbers = held.number[terms]
                    here = numbers >= 0
                    if not here.any():
                        continue
                    floor = best[key][-1][0] if len(best[key]) == k else 0
                    scores, top = held.search(numbers[here], repeats[here], ids, k, floor)
                    # Ascending ids at equal scores; a document without an id comes last.
                    found = [(s, i, doc_ids[d]) for s, i, d in zip(scores.tolist(), ids[top].tolist(), top.tolist())]
                    best[key] = sorted(best[key] + found, key=lambda f: (-f[0], f[1]))[:k]
        rows = [(key, item_id, d, s) for key, item_id, *_ in block.items for s, _, d in best[key]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], ["key", "item_id", "doc_id", "score"])

    return run


def ranked(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", k: int = K,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the ``k`` best documents of each item.

    Terms, weights and scores are those of the contract: integers throughout but for the weight's
    logarithm.  Texts are taken whole, however long.  A null or empty text has no terms: such a document
    is not counted, such an item has no rows.  Every row is a document or an item of its own: repeated
    documents hold a rank each, a repeated item has its rows twice.  Equal scores go by ascending id, rows
    without an id last.  Other columns are ignored; if either table is empty there are no rows.
    """
    spark = docs.sparkSession
    segments = index(docs, id_col, text_col)
    n_docs, n_terms = segments.agg(
        F.coalesce(F.sum(F.size("lengths")), F.lit(0)),
        F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0)),
    ).first()
    texts = items.select(
        F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    asked = stored(texts.mapInArrow(
        _item_terms, "block long, key long, item_id long, terms array<long>, repeats array<long>"))
    weighted = _weighted(asked, segments, n_docs)
    best = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    found = []
    # One pass over the index, not the texts, for each block of items.
    for (number,) in sorted(weighted.select("block").distinct().collect()):
        block = shared_bytes(spark, Block(weighted.where(F.col("block") == number).collect()))
        hits = segments.mapInArrow(
            _searched(block, n_docs, n_terms, k), "key long, item_id long, doc_id long, score long")
        found.append(stored(
            hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score")))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out
