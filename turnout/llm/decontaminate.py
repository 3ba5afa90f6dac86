"""Documents that hold a benchmark item, by SimHash over windows of the items' sizes.

Every item, and every window with as many words as some item, gets a 64-bit SimHash: each five-word
shingle votes on all bits with its weight, one over the number of items of the benchmark that hold it.  Four
blocks of 16 bits index the items' fingerprints: two fingerprints within ``RADIUS`` = 19 bits differ in at most
four bits of some block, and each block's table lists the items within four bits of any value, so that
no item of the window's size within the radius is missed.  These pairs are verified by the exact weighted
similarity of their shingles, the sum of the smaller weights over that of the larger ones; what the item does not
hold weighs as much as the mean of the item's own.

SimHash only makes it likely that a similar window lies within the radius.  A second look therefore takes the
items of which a text holds one of the rarest shingles, those that make up more than a quarter of the item's
weight, and verifies each window whose shared weight allows the similarity.  A text shorter than an item is one window.

A window without any shingle of an item has no similarity to one, so windows are
fingerprinted only around shingles that the items hold; whole texts are looked through for these.

Items go to the executors in blocks of ``ITEMS``, one pass over the documents for each block.
"""

import functools
import itertools
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from turnout.llm.tables import rows_of, shared_bytes, stored
from turnout.llm.words import encoded, mix, shingle_hashes, word_hashes
from turnout.llm.worker import kept

SIMILARITY = 0.75
SHINGLE = 5
RADIUS = 19
BLOCKS, BITS = 4, 16
ITEMS = 1000
REGION = 4096  # words fingerprinted at a time
SEEN_BITS = 1 << 22


def _votes(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(mix(shingles, 61).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.where(bits, weights[:, None], -weights[:, None])


def _fingerprints(votes: np.ndarray) -> np.ndarray:
    return np.packbits(votes > 1e-9, axis=1, bitorder="little").view(np.uint64)[:, 0]


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y)


@functools.cache
def _near_values() -> np.ndarray:
    """All 16-bit numbers with at most RADIUS // BLOCKS bits set."""
    ones = range(RADIUS // BLOCKS + 1)
    return np.asarray([
        sum(1 << b for b in bits) for k in ones for bits in itertools.combinations(range(BITS), k)
    ])


class HammingIndex:
    """Finds all fingerprints within RADIUS of a query."""

    def __init__(self, fingerprints: np.ndarray):
        self.fingerprints = fingerprints
        near, self.tables = _near_values(), []
        for block in range(BLOCKS):
            values = self._block(fingerprints, block)[:, None] ^ near[None, :]
            # Numbers as small as they may be: every worker keeps the tables.
            owners = np.repeat(np.arange(len(fingerprints), dtype=np.min_scalar_type(len(fingerprints))), len(near))
            order = np.argsort(values.ravel(), kind="stable")
            starts = np.searchsorted(values.ravel()[order], np.arange((1 << BITS) + 1))
            self.tables.append((starts, owners[order]))

    @staticmethod
    def _block(fingerprints: np.ndarray, block: int) -> np.ndarray:
        return ((fingerprints >> np.uint64(BITS * block)) & np.uint64((1 << BITS) - 1)).astype(np.int64)

    def within(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, item) within the radius."""
        found = []
        for block, (starts, owners) in enumerate(self.tables):
            values = self._block(queries, block)
            sizes = starts[values + 1] - starts[values]
            who = np.repeat(np.arange(len(queries)), sizes)
            inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            items = owners[starts[values][who] + inside]
            near = distance(queries[who], self.fingerprints[items]) <= RADIUS
            found.append(who[near] * len(self.fingerprints) + items[near])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.fingerprints), pairs % len(self.fingerprints)


class Items:
    """A block of benchmark items, ready to be looked for in texts."""

    def __init__(self, rows: list[tuple[int, str, dict[int, int]]]):
        """``rows`` are ids, texts, and the holders in the whole benchmark of each shingle that has several."""
        words = [word_hashes(encoded(text, True)) for _, text, _ in rows]
        kept = [i for i, w in enumerate(words) if len(w)]
        self.ids = [rows[i][0] for i in kept]
        self.sizes = np.asarray([len(words[i]) for i in kept], np.int64)
        bags = [shingle_hashes(words[i], SHINGLE) for i in kept]
        holders = {s: 1 for bag in bags for s in bag.tolist()}
        for *_, shared in rows:
            holders |= {s % 2**64: n for s, n in shared.items()}
        self.known = np.asarray(sorted(holders), np.uint64)
        self.known_weights = np.asarray([1 / holders[s] for s in self.known.tolist()])
        self.bags = [Counter(bag.tolist()) for bag in bags]
        self.weight = {s: 1 / n for s, n in holders.items()}
        self.totals = [sum(self.weight[s] * n for s, n in bag.items()) for bag in self.bags]
        self.means = [total / bag.total() for total, bag in zip(self.totals, self.bags, strict=True)]
        self.own = [np.asarray(sorted(bag), np.uint64) for bag in self.bags]
        self.rare = {}
        for i, bag in enumerate(self.bags):
            left = self.totals[i]
            for s in sorted(bag, key=lambda s: (-self.weight[s], s)):
                self.rare.setdefault(s, []).append(i)
                left -= self.weight[s] * bag[s]
                if left < (SIMILARITY - 1e-9) * self.totals[i]:
                    break
        self.seen = np.zeros(SEEN_BITS, bool)
        self.seen[(self.known & np.uint64(SEEN_BITS - 1)).astype(np.int64)] = True
        self.by_size = {}
        for size in np.unique(self.sizes).tolist():
            own = np.flatnonzero(self.sizes == size)
            prints = np.concatenate([
                _fingerprints(_votes(bags[i], self.weights(bags[i])).sum(axis=0, keepdims=True)) for i in own
            ])
            self.by_size[size] = own, HammingIndex(prints)
        self.by_width = {}
        for size in self.by_size:
            self.by_width.setdefault(min(size, SHINGLE), []).append(size)

    def held(self, shingles: np.ndarray) -> np.ndarray:
        """Which shingles some item holds."""
        hit = self.seen[(shingles & np.uint64(SEEN_BITS - 1)).astype(np.int64)]
        at = np.flatnonzero(hit)
        if len(at):
            place = np.minimum(np.searchsorted(self.known, shingles[at]), len(self.known) - 1)
            hit[at] = self.known[place] == shingles[at]
        return hit

    def weights(self, shingles: np.ndarray) -> np.ndarray:
        """Votes of shingles: those that no item holds weigh as much as the mean of the held ones around."""
        at = np.minimum(np.searchsorted(self.known, shingles), max(len(self.known) - 1, 0))
        if not len(self.known):
            return np.ones(len(shingles))
        held = self.known[at] == shingles
        rest = self.known_weights[at[held]].mean() if held.any() else 1.0
        return np.where(held, self.known_weights[at], rest)

    def similarity(self, window: np.ndarray, item: int) -> float:
        bag, own = Counter(window.tolist()), self.bags[item]
        weight, mean = self.weight, self.means[item]
        both = sum(weight[s] * min(n, own[s]) for s, n in bag.items() if s in own)
        total = sum((weight[s] if s in own else mean) * n for s, n in bag.items()) + self.totals[item]
        return round(both / (total - both), 12)

    def _matches(self, shingles, sums, votes, size, step):
        """(start, item, similarity) in a stretch; a window has ``step`` shingles, ``sums`` counts held ones."""
        own, index = self.by_size[size]
        if len(shingles) < step:
            return
        starts = np.flatnonzero(sums[step:] - sums[:-step])
        if not len(starts):
            return
        queries, items = index.within(_fingerprints(votes[starts + step] - votes[starts]))
        for q, i in zip(starts[queries].tolist(), own[items].tolist(), strict=True):
            similar = self.similarity(shingles[q : q + step], i)
            if similar >= SIMILARITY:
                yield q, i, similar

    def _overlaps(self, shingles, hits, width):
        """(start, item, similarity) of all windows of items of this shingle width, by the weight they share."""
        held = shingles[hits]
        for item in sorted({i for s in set(held.tolist()) & self.rare.keys() for i in self.rare[s]}):
            if min(self.sizes[item], SHINGLE) != width:
                continue
            own, total = self.own[item], self.totals[item]
            at = hits[own[np.minimum(np.searchsorted(own, held), len(own) - 1)] == held]
            step = min(int(self.sizes[item]) - width + 1, len(shingles))
            shared = np.zeros((2, len(shingles) + 1))
            shared[0, at + 1], shared[1, at + 1] = [self.weight[s] for s in shingles[at].tolist()], 1
            shared = np.cumsum(shared, axis=1)
            weight, count = shared[:, step:] - shared[:, :-step]
            most = np.minimum(weight, total) / (total + (step - count) * self.means[item])
            for start in np.flatnonzero(most >= SIMILARITY - 1e-9).tolist():
                similar = self.similarity(shingles[start : start + step], item)
                if similar >= SIMILARITY:
                    yield start, item, similar

    def find(self, text: str | None) -> dict[int, tuple[float, int, int]]:
        """For each item found: the best similarity, the first word where it is reached, the words."""
        words = word_hashes(encoded(text, True))
        best = {}
        for width, sizes in self.by_width.items():
            shingles = shingle_hashes(words, width)
            if len(words) < width:
                continue
            hit = self.held(shingles)
            longest = max(sizes) - width + 1
            for lo, hi in _stretches(np.flatnonzero(hit), longest, len(shingles)):
                part = shingles[lo:hi]
                sums = np.concatenate([[0], np.cumsum(hit[lo:hi])])
                votes = np.zeros((len(part) + 1, 64))
                np.cumsum(_votes(part, self.weights(part)), axis=0, out=votes[1:])
                for size in sizes:
                    for start, item, similar in self._matches(part, sums, votes, size, size - width + 1):
                        best[item] = max(best.get(item, (0, 0)), (similar, -(lo + start)))
            for start, item, similar in self._overlaps(shingles, np.flatnonzero(hit), width):
                best[item] = max(best.get(item, (0, 0)), (similar, -start))
        return {
            item: (similar, -start, min(int(self.sizes[item]), len(words)))
            for item, (similar, start) in best.items()
        }


def _stretches(hits: np.ndarray, step: int, n: int):
    """Stretches with all windows of up to ``step`` shingles that cover a hit, at most REGION and a window long."""
    if not len(hits):
        return
    cuts = np.flatnonzero(np.diff(hits) >= 2 * step)
    for first, last in zip(hits[np.r_[0, cuts + 1]].tolist(), hits[np.r_[cuts, len(hits) - 1]].tolist(), strict=True):
        lo, end = max(0, first - step + 1), min(n, last + step)
        while lo < end:
            yield lo, min(end, lo + REGION + step)
            lo += REGION + 1


def _finder(rows, key: str):
    def run(batches):
        items = kept(("benchmark items", key), lambda: Items(rows.value))
        for batch in batches:
            out = [
                (doc_id, items.ids[item], start, size, similar)
                for doc_id, text in rows_of(batch, "doc_id", "text")
                for item, (similar, start, size) in sorted(items.find(text).items())
            ]
            columns = zip(*out, strict=True) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                ["doc_id", "item_id", "start_word", "n_words", "similarity"],
            )

    return run


def _bags(batches):
    for batch in batches:
        rows = [
            (i, t, np.unique(shingle_hashes(word_hashes(encoded(t, True)), SHINGLE).view(np.int64)).tolist())
            for i, t in rows_of(batch, "item_id", "text")
        ]
        columns = zip(*rows, strict=True) if rows else [[]] * 3
        kinds = (pa.int64(), pa.string(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["item_id", "text", "shingles"]
        )


def _with_holders(items: DataFrame) -> DataFrame:
    """The items with ``shared``: how many items of the whole benchmark hold a shingle, where several do."""
    bags = stored(items.mapInArrow(_bags, "item_id long, text string, shingles array<long>"))
    each = bags.select("item_id", "text", F.explode("shingles").alias("shingle"))
    holders = each.select("item_id", "shingle").distinct().groupBy("shingle").agg(
        F.count("*").alias("holders")
    ).where("holders > 1")
    shared = each.join(holders, "shingle").groupBy("item_id", "text").agg(
        F.collect_list(F.struct("shingle", "holders")).alias("shared")
    )
    return stored(bags.select("item_id", "text").join(shared, ["item_id", "text"], "left"))


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``item_id``, ``start_word``, ``n_words`` and ``similarity``: items found in documents.

    One row for each row of ``docs`` and item with a window of similarity 0.75 or more, with the best
    window, the first of equals; a text shorter than an item is compared as a whole.  A-Z count as lower case.  Items of fewer than five words are one shingle.
    Null, empty and blank texts and items match nothing; repeated rows of ``docs`` give repeated rows, and a
    row without an id gives rows without one; items without an id are left out.  Texts of any length are read whole, other columns are ignored, and an
    empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    schema = "doc_id long, item_id long, start_word long, n_words long, similarity double"
    items = (
        benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
        .where("item_id is not null and text is not null").distinct()
    )
    items = _with_holders(items).orderBy("item_id", "text")
    found, block = None, []

    def passed(rows):
        sent = shared_bytes(spark, rows)
        return texts.mapInArrow(_finder(sent, f"{spark.sparkContext.applicationId} {id(sent)} {rows[0][:2]}"), schema)

    for row in items.toLocalIterator():  # one block at a time
        block.append((row.item_id, row.text, {x.shingle: x.holders for x in row.shared or []}))
        if len(block) == ITEMS:
            found, block = passed(block) if found is None else found.union(passed(block)), []
    if block or found is None:
        found = passed(block or [(0, "", {})]) if found is None else found.union(passed(block))
    return found
