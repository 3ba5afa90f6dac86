"""Documents whose word shingles are alike, by filters under several token orders.

Two sets of sizes a and b with a Jaccard similarity of 0.75 share at least
``need(a) = ceil(0.75 a)`` and ``need(b)`` tokens.  Hence, in *any* order of all tokens, their
first ``n - need(n) + l`` tokens share l.  Candidates must pass this test under
three orders:

1. by token hash, with l a twelfth of the set: each document posts only about a third
   of its tokens, and stays only if enough of them occur in another document;
2. rarest first, with l = 1, on the whole sets of the documents that stay.  A passage that many
   documents share makes candidates only of those that consist of such passages, and a document with
   more than a quarter of its tokens to itself has no candidates at all;
3. by token hash from the highest down, with l = 1, on the sets of a candidate pair.

Before the sets of a pair meet, a bit for each token's hash, two bits or more a token,
bounds the overlap: a bit set for one document only stands for a token that the other lacks.
Pairs that pass are verified on the whole sets.

Equal sets are one class, so copies cost nothing.  Candidates are first tied to one
document of each token's group (in ROUNDS rounds, each with another choice), and the verified
links contracted; afterwards only pairs that share a rare token and lie in different
components are made.  A large group of near copies thus takes about as many pairs as
it has members, and no link that joins two components is missed.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from turnout.llm.components import components
from turnout.llm.tables import (
    checked_broadcast,
    free_shuffles,
    lists,
    only,
    rows_of,
    shared_bytes,
    stored,
)
from turnout.llm.words import mix, set_hash, shingle_set
from turnout.llm.worker import release

PERCENT = 75
ROUNDS = 4  # of candidates tied to one document of a group
FLUSH = 1_000_000  # tokens in an output batch
LEAST_MARKS, MOST_MARKS = 1 << 16, 1 << 26  # bits; full ones let more tokens through to the exact join


def need(n):
    return -(-PERCENT * n // 100)


def extra(n):
    """How many shared tokens order 1 asks for."""
    return -(-n // 12)


def posted(n):
    return n - need(n) + extra(n) if n else 0


def _bits(tokens: np.ndarray) -> np.ndarray:
    """A bit for each token in a power of two of bits, two a token at least."""
    size = 128
    while size < 2 * len(tokens):
        size *= 2
    at = tokens & (size - 1)
    words = np.zeros(size // 64, np.uint64)
    np.bitwise_or.at(words, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    return words.view(np.int64)


SKETCH = "doc_id long, n long, h1 long, h2 long, posted array<long>"
SETS = "doc_id long, n long, h1 long, h2 long, tokens array<long>, bits array<long>"


def _mapper(size: int, whole: bool):
    def run(batches):
        def flush():
            ids, ns, h1, h2, *arrays = zip(*held, strict=True)
            columns = [pa.array(x, pa.int64()) for x in (ids, ns, h1, h2)]
            columns += [lists(list(x), pa.int64()) for x in arrays]
            names = ["doc_id", "n", "h1", "h2"] + (["tokens", "bits"] if whole else ["posted"])
            return pa.RecordBatch.from_arrays(columns, names)

        release()
        held, count = [], 0
        for batch in batches:
            for doc_id, text in rows_of(batch, "doc_id", "text"):
                tokens = shingle_set(text, size)
                n = len(tokens)
                own = (tokens, _bits(tokens)) if whole else (tokens[: posted(n)],)
                held.append((doc_id, n, *set_hash(tokens), *own))
                count += sum(map(len, own))
                if count >= FLUSH or len(held) >= 5000:
                    yield flush()
                    held, count = [], 0
        if held:
            yield flush()

    return run


def _places(tokens: np.ndarray, size: int) -> list[np.ndarray]:
    return [(mix(tokens.view(np.uint64), seed) & np.uint64(size - 1)).astype(np.int64) for seed in (51, 52)]


def _marking(size: int):
    def run(batches):
        release()
        for batch in batches:
            if batch.num_rows:
                at = np.concatenate(_places(batch.column("token").to_numpy(), size))
                words = np.unique(at >> 6)
                masks = np.zeros(len(words), np.uint64)
                np.bitwise_or.at(masks, np.searchsorted(words, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words), pa.array(masks.view(np.int64))], ["word", "mask"])

    return run


def _marks(shared: DataFrame) -> np.ndarray:
    """Two marked bits for each token; other tokens pass by chance, the more the fuller the bits are."""
    size, n = LEAST_MARKS, shared.count()
    while size < min(MOST_MARKS, 16 * n):
        size *= 2
    found = shared.mapInArrow(_marking(size), "word long, mask long").groupBy("word").agg(
        F.bit_or("mask").alias("mask")).toArrow()  # at most size / 64 rows
    bits = np.zeros(size // 64, np.int64)
    bits[found["word"].to_numpy()] = found["mask"].to_numpy()
    return bits.view(np.uint64)


def _marked(marks):
    """Postings of tokens whose two bits are marked."""
    def run(batches):
        release()
        for batch in batches:
            if not batch.num_rows:
                continue
            bits, posted = marks.value, batch.column("posted")
            tokens = posted.flatten().to_numpy()
            keep = np.ones(len(tokens), bool)
            for at in _places(tokens, 64 * len(bits)):
                keep &= (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            owner = np.repeat(batch.column("doc_id").to_numpy(), posted.value_lengths().to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner[keep]), pa.array(tokens[keep])], ["doc_id", "token"])

    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).where("doc_id is not null")


def _alike(a: str, b: str):
    """Sizes that allow the similarity."""
    return F.expr(f"100 * least({a}, {b}) >= {PERCENT} * greatest({a}, {b})")


def _sides(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    def side(name):
        return sets.select(
            F.col("doc_id").alias(name), F.col("n").alias(f"n_{name}"),
            F.col(column).alias(f"x_{name}"),
        )

    return pairs.join(side("a"), "a").join(side("b"), "b")


#: Bits of one document that the other does not have; the longer row of bits is folded in two.
ONLY = """
    aggregate(zip_with({x}, {y}, (p, q) -> bit_count(p & ~q)), 0, (sum, k) -> sum + k)
"""
FOLDED = """
    if(size({x}) > size({y}), zip_with(
        slice({x}, 1, size({y})), slice({x}, size({y}) + 1, size({y})), (p, q) -> p | q), {x})
"""


def _room(x: str, y: str, n_x: str, n_y: str):
    """Whether the bits ``x`` and ``y`` leave room for enough shared tokens."""
    one, other = FOLDED.format(x=x, y=y), FOLDED.format(x=y, y=x)
    most = f"least({n_x} - {ONLY.format(x=one, y=other)}, {n_y} - {ONLY.format(x=other, y=one)})"
    return F.expr(f"transform(array({most}), m -> 100 * m >= {PERCENT} * ({n_x} + {n_y} - m))[0]")


def _possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    both = _sides(pairs, sets, "bits").where(_alike("n_a", "n_b"))
    return both.where(_room("x_a", "x_b", "n_a", "n_b")).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that share tokens in orders 1 and 3 and are similar on their whole sets."""
    both = _sides(pairs, sets, "tokens")

    def first(side, order):
        size = f"int(n_{side} - ({PERCENT} * n_{side} + 99) div 100 + 1)"
        return F.expr(f"slice(x_{side}, {'1' if order == 1 else f'-{size}'}, {size})")

    shared = F.size(F.array_intersect("x_a", "x_b"))
    return both.where(
        F.arrays_overlap(first("a", 1), first("b", 1)) & F.arrays_overlap(first("a", 3), first("b", 3))
    ).where(100 * shared >= PERCENT * (F.col("n_a") + F.col("n_b") - shared)).select("a", "b")


def _ordered_pairs(df: DataFrame, one: str, other: str) -> DataFrame:
    return df.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct()


def _star_pairs(rare: DataFrame, key) -> DataFrame:
    """Each document with the first document, by ``key``, of each of its tokens' groups."""
    first = rare.groupBy("token").agg(F.min(F.struct(key.alias("k"), "doc_id", "n")).alias("f"))
    tied = rare.join(first.select(
        "token", F.col("f.doc_id").alias("first"), F.col("f.n").alias("n_first")
    ), "token")
    return _ordered_pairs(
        tied.where("doc_id <> first").where(_alike("n", "n_first")), "doc_id", "first"
    )


def _grown(parts: DataFrame | None, found: DataFrame) -> DataFrame:
    """Components of the new links and of what the components so far tie together."""
    if parts is not None:
        found = found.union(parts.select("node", "component"))
    return components(found, "a", "b")


def _labelled(rare: DataFrame, parts: DataFrame) -> DataFrame:
    """Postings with their documents' components, of tokens that still join several."""
    own = rare.join(parts.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )
    mixed = own.groupBy("token").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi")
    ).where("lo < hi").select("token")
    return stored(own.join(mixed, "token", "left_semi"))


def _crossing_pairs(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of different components that share a rare token and have room for enough others.

    A pair comes once, from the first of the rare tokens that it shares.
    """
    own = rest.groupBy("doc_id").agg(F.collect_list("token").alias("tokens")).join(
        sets.select("doc_id", "bits"), "doc_id"
    )
    rows = rest.join(own, "doc_id")
    x, y = rows.alias("x"), rows.alias("y")
    return x.join(
        y, (F.col("x.token") == F.col("y.token"))
        & (F.col("x.component") < F.col("y.component")) & _alike("x.n", "y.n")
        & _room("x.bits", "y.bits", "x.n", "y.n")
        & (F.col("x.token") == F.array_min(F.array_intersect("x.tokens", "y.tokens"))),
    ).select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b"))


def similar_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for each document.

    Documents are linked if the Jaccard similarity of their sets of ``size``-word
    shingles is 0.75 or more; the component is the lowest id reachable by links.
    A text of fewer words is one shingle; an empty, blank or null text has no shingles, no link
    and a component of its own.  Rows without an id are left out.  Rows that repeat an
    id count as one document, that with the highest set hash.  Other columns are ignored, an empty
    table gives an empty result, and texts of any length are read whole.
    """
    texts = _texts(docs, id_col, text_col)
    sketch = stored(texts.mapInArrow(_mapper(size, False), SKETCH))
    own = stored(
        sketch.groupBy("doc_id")
        .agg(F.max(F.struct("h1", "h2", "n")).alias("s"))
        .select("doc_id", "s.h1", "s.h2", "s.n")
    )
    classes = own.where("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("class_id"))
    member = stored(
        own.join(classes, ["h1", "h2"], "left")
        .withColumn("class_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")))
    )
    # Rows that post nothing: copies, and what an id has besides its own text.
    silent = stored(
        sketch.select("doc_id", "h1", "h2").join(
            member.where("doc_id = class_id").select("doc_id", "h1", "h2"),
            ["doc_id", "h1", "h2"], "left_anti",
        ).distinct()
    )
    posting = sketch.join(checked_broadcast(silent), ["doc_id", "h1", "h2"], "left_anti").select("doc_id", "posted")

    # Order 1: tokens posted by several documents, and documents with enough of them.  Only tokens that may
    # be among the former are looked up with their documents.
    shared = stored(
        posting.select(F.explode("posted").alias("token")).groupBy("token")
        .agg(F.count("*").alias("df")).where("df > 1").select("token")
    )
    free_shuffles(docs.sparkSession)
    marks = shared_bytes(docs.sparkSession, _marks(shared))
    likely = posting.mapInArrow(_marked(marks), "doc_id long, token long")
    counted = likely.join(shared, "token").groupBy("doc_id").agg(F.count("*").alias("c"))
    # extra(need(n)): what the smallest possible partner asks for.
    chosen = stored(
        counted.join(checked_broadcast(own.select("doc_id", "n")), "doc_id")
        .where(f"c >= (({PERCENT} * n + 99) div 100 + 11) div 12").select("doc_id")
    )
    free_shuffles(docs.sparkSession)
    sets = only(texts, chosen).mapInArrow(_mapper(size, True), SETS)
    sets = stored(
        sets.join(own.select("doc_id", "h1", "h2"), ["doc_id", "h1", "h2"], "left_semi")
        .dropDuplicates(["doc_id"])
    )
    free_shuffles(docs.sparkSession)

    # Order 2: the rarest tokens of what stayed; tokens of one document alone come first of all.
    whole = sets.select("doc_id", F.explode("tokens").alias("token"))
    frequent = whole.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    own_tokens = Window.partitionBy("doc_id")
    required = F.expr(f"({PERCENT} * n + 99) div 100")
    rare = stored(
        whole.join(frequent, "token")
        .join(checked_broadcast(sets.select("doc_id", "n")), "doc_id")
        .withColumn("c", F.count("*").over(own_tokens))
        .withColumn("place", F.row_number().over(own_tokens.orderBy("df", "token")))
        .where((F.col("c") >= required) & (F.col("place") <= F.col("c") - required + 1))
        .select("doc_id", "n", "token")
    )

    free_shuffles(docs.sparkSession)
    parts, rest = None, rare.withColumn("component", F.col("doc_id"))
    for seed in range(ROUNDS):
        key = F.xxhash64("doc_id", F.lit(seed)) if seed else F.col("doc_id")
        pairs = stored(_possible(_star_pairs(rest, key), sets))
        free_shuffles(docs.sparkSession)
        found = stored(_verified(pairs, sets))
        free_shuffles(docs.sparkSession)
        if found.isEmpty():
            break
        parts = _grown(parts, found)
        rest = _labelled(rest.select("doc_id", "n", "token"), parts)
        free_shuffles(docs.sparkSession)
        if rest.isEmpty():
            break
    if not rest.isEmpty():
        pairs = stored(_crossing_pairs(rest, sets))
        free_shuffles(docs.sparkSession)
        found = stored(_verified(pairs, sets))
        free_shuffles(docs.sparkSession)
        if not found.isEmpty():
            parts = _grown(parts, found)

    if parts is None:
        return member.select("doc_id", F.col("n").alias("n_shingles"), F.col("class_id").alias("component_id"))
    parts = parts.withColumnRenamed("node", "class_id")
    return member.join(parts, "class_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component", "class_id").alias("component_id"),
    )
