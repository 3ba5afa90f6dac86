"""The trie of conversations' first turns, with sums over its subtrees, by an Euler tour.

A node is a distinct sequence of first turns.  Its members' lowest id and its depth name it, and
numbered by both, the nodes of a conversation follow each other.  Each node has an enter and an
exit arc, and each arc points to the one before it on the tour: an enter arc to the
exit of the sibling before, or to the enter of the parent; an exit arc to the exit of the last child, or to
its own enter.  Ranking that list gives every arc its position, prefix sums over the positions
give the leaves and savings of a subtree as the difference between its exit and its enter.

Ranking: arcs are dealt by ranges of nodes, and runs of the tour that stay inside a range, most of
it, are walked there.  What is left, a link for each run, is ranked in one task if it is of a stated
size, and else first made shorter: coins choose links of which no two are neighbours, which are taken out and put
back in reverse order.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from turnout.llm.running import running
from turnout.llm.tables import checked_broadcast, rows_of, stored

#: Links that one task ranks.
AT_ONCE = 1 << 18
#: Low bits of the conversation ids that lie in one chunk of a digest.
CHUNK_BITS = 12
#: Conversations with one base and the most turns that they share with it.
FAMILY, SHARED = 20, 4

WORD = r"[^\x20\x09-\x0D]+"
RESULT = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
)


def numbered_turns(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id``, ``depth`` (from 1), a hash ``h1``, ``h2`` of role and text, and ``words``, for each turn.

    Turns go by number, those without one first, equal ones by the hash.
    """
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("h1"), F.xxhash64(F.lit(2), role, text).alias("h2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.lit(1).cast("long").alias("one"),
        F.monotonically_increasing_id().alias("row"),
    )
    # ``row`` only spreads rows that repeat each other.
    ordered = running(turns, ["conv_id"], ["turn", "h1", "h2", "row"], before=("sum", "one"))
    return ordered.select("conv_id", (F.col("before") + 1).alias("depth"), "h1", "h2", "words")


def lengths_of(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``n``, its turns."""
    return stored(turns.groupBy("conv_id").agg(F.count("*").alias("n")))


def regrown(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation after the first turns of its family's base: its turns, and all conversations.

    Conversation c takes the first h turns of c - c % 20, h = crc32(c) % 4, or all if there are fewer, and goes on
    with its own after the first h.
    """
    own = convs.select(
        "conv_id", F.col("n").alias("own"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).alias("h"),
    )
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0).cast("long")))
    grown = stored(own.join(bases, "base", "left").select(
        "conv_id", "base", "h", taken.alias("taken"),
        (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0).cast("long"))).alias("n"),
    ))
    first = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("depth") < SHARED)).withColumnRenamed(
        "conv_id", "base")
    shared = first.join(grown, "base").where("depth <= taken").select(
        "conv_id", "depth", "h1", "h2", "words", "n")
    rest = turns.join(checked_broadcast(grown), "conv_id").where("depth > h").select(
        "conv_id", (F.col("depth") - F.col("h") + F.col("taken")).alias("depth"), "h1", "h2", "words", "n")
    return rest.unionByName(shared), grown.select("conv_id", "n")


def _keyed(turns: DataFrame) -> DataFrame:
    """Turns with the key of their prefix, ``a`` and ``b``, and of the one before, ``pa`` and ``pb``."""
    ta, tb = (F.xxhash64(F.lit(seed), "depth", "h1", "h2") for seed in (3, 4))
    # The key of a prefix is the exclusive or of its turns' hashes with their places.
    keyed = running(
        turns.select("conv_id", "depth", "words", "n", ta.alias("ta"), tb.alias("tb")),
        ["conv_id"], ["depth"], pa=("xor", "ta"), pb=("xor", "tb"))
    return stored(keyed.select(
        "conv_id", "depth", "words", "n", F.col("pa").bitwiseXOR(F.col("ta")).alias("a"),
        F.col("pb").bitwiseXOR(F.col("tb")).alias("b"), "pa", "pb"))


def _zero(name: str) -> Column:
    return F.lit(0).cast("long").alias(name)


def _nodes(keyed: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes with their number ``g`` by id and depth."""
    inner = keyed.groupBy("depth", "a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        *[_zero(c) for c in ("depth", "a", "b")], "conv_id", "n_convs", *[_zero(c) for c in ("words", "pa", "pb")])
    every = inner.unionByName(root).withColumn("one", F.lit(1).cast("long"))
    return stored(running(every, [], ["conv_id", "depth"], g=("sum", "one")).drop("one"))


def _digests(batches):
    key = digest = None

    def row():
        return pa.RecordBatch.from_arrays(
            [*[pa.array([k], pa.int64()) for k in key], pa.array([digest.hexdigest()])],
            ["depth", "a", "b", "ends_sha256"])

    for batch in batches:
        for *now, ids in rows_of(batch, "depth", "a", "b", "ids"):
            if now != key:
                if key:
                    yield row()
                key, digest = now, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(",".join(map(str, ids)).encode())
    if key:
        yield row()


def _ends(keyed: DataFrame, convs: DataFrame) -> DataFrame:
    """The digest of the conversations that end at a node, in ascending order, a chunk of ids at a time."""
    ends = keyed.where("depth = n").select("depth", "a", "b", "conv_id").unionByName(
        convs.where("n = 0").select(_zero("depth"), _zero("a"), _zero("b"), "conv_id"))
    chunks = ends.groupBy("depth", "a", "b", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"))
    return chunks.repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "chunk").mapInArrow(
        _digests, "depth long, a long, b long, ends_sha256 string")


def _jumped(before: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each item's run and the way to it; a first one points to itself with weight 0."""
    while True:
        further = before[before]
        if np.array_equal(further, before):
            return before, weight
        weight = weight + weight[before]
        before = further


def _runs(batches):
    """The runs of the tour inside a range of nodes."""
    parts = [pa.table([b.column(c) for c in ("g", "enter", "exit")], ["g", "enter", "exit"]) for b in batches]
    whole = pa.concat_tables(parts) if parts else None
    if whole is None or not len(whole):
        return
    g = whole["g"].to_numpy()
    pred = np.stack([whole["enter"].to_numpy(), whole["exit"].to_numpy()], axis=1).ravel()
    arcs = np.stack([2 * g, 2 * g + 1], axis=1).ravel()
    at = np.minimum(np.searchsorted(arcs, pred), len(arcs) - 1)
    inside = arcs[at] == pred
    first, way = _jumped(np.where(inside, at, np.arange(len(arcs))), inside.astype(np.int64))
    for start in range(0, len(arcs), 1 << 16):
        part = slice(start, start + (1 << 16))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[part]) for x in (arcs, arcs[first], way, np.where(inside, -2, pred))],
            ["arc", "run", "way", "pred"])


def _ranked_at_once(batches):
    """The rank of every link of a list."""
    rows = [(b.column("id").to_numpy(), b.column("pred").to_numpy(), b.column("way").to_numpy()) for b in batches]
    if not rows:
        return
    ids, pred, way = (np.concatenate(x) for x in zip(*rows, strict=True))
    order = np.argsort(ids)
    ids, pred, way = ids[order], pred[order], way[order]
    before = np.where(pred < 0, np.arange(len(ids)), np.searchsorted(ids, pred))
    _, rank = _jumped(before, way)
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(rank)], ["id", "rank"])


def ranks(links: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """``id`` and ``rank``: for links ``id``, ``pred`` (-1 for the first) and ``way``, the sum of ways from the first."""
    links, out = stored(links), []
    while links.count() > at_once:
        def coin(column, turn=len(out)):
            return F.xxhash64(F.lit(turn), column).bitwiseAND(1) == 1

        # No two neighbours go: one that goes has a head and the one before it a tail.
        goes = coin("id") & ~coin("pred") & (F.col("pred") >= 0)
        gone = stored(links.where(goes))
        out.append(gone)
        links = stored(
            links.where(~goes).alias("l")
            .join(gone.select(F.col("id").alias("pred"), F.col("pred").alias("p"), F.col("way").alias("w")), "pred", "left")
            .select("id", F.coalesce("p", "pred").alias("pred"), (F.col("way") + F.coalesce("w", F.lit(0))).alias("way"))
        )
    found = stored(links.coalesce(1).mapInArrow(_ranked_at_once, "id long, rank long"))
    for gone in reversed(out):
        back = gone.join(found.select(F.col("id").alias("pred"), "rank"), "pred").select(
            "id", (F.col("rank") + F.col("way")).alias("rank"))
        found = stored(found.unionByName(back))
    return found


def _positions(tour: DataFrame, at_once: int) -> DataFrame:
    """``arc`` and ``pos``, its place on the tour, from 0."""
    runs = stored(
        tour.repartitionByRange("g").sortWithinPartitions("g")
        .mapInArrow(_runs, "arc long, run long, way long, pred long"))
    firsts = runs.where("arc = run").select(F.col("run").alias("id"), F.col("pred").alias("arc"))
    # Where the arc before a run lies in its own.
    links = firsts.join(runs.select("arc", "run", "way"), "arc", "left").select(
        "id", F.coalesce("run", F.lit(-1).cast("long")).alias("pred"),
        F.coalesce(F.col("way") + 1, F.lit(0).cast("long")).alias("way"))
    found = ranks(links, at_once).withColumnRenamed("id", "run")
    return runs.join(checked_broadcast(found), "run").select("arc", (F.col("rank") + F.col("way")).alias("pos"))


def trie(turns: DataFrame, convs: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """The nodes for numbered turns with ``n`` and for all conversations."""
    keyed = _keyed(turns)
    nodes = _nodes(keyed, convs)
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"),
        F.col("g").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    children = stored(
        nodes.where("depth > 0").join(parents, ["depth", "pa", "pb"]).select("g", "parent", "parent_conv_id"))
    siblings = stored(running(children, ["parent"], ["g"], sibling=("previous", "g")))
    families = siblings.groupBy(F.col("parent").alias("g")).agg(
        F.count("*").alias("n_children"), F.max("g").alias("last_child"))
    linked = stored(
        nodes.join(siblings, "g", "left").join(families, "g", "left").select(
            *nodes.columns, "parent", "parent_conv_id", "sibling",
            F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "last_child"))
    enter = F.when(F.col("sibling") >= 0, 2 * F.col("sibling") + 1).otherwise(2 * F.col("parent"))
    tour = linked.select(
        "g", F.coalesce(enter, F.lit(-1)).cast("long").alias("enter"),
        F.coalesce(2 * F.col("last_child") + 1, 2 * F.col("g")).cast("long").alias("exit"))
    positions = _positions(tour, at_once)
    values = linked.select(
        (2 * F.col("g")).alias("arc"), (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    along = stored(positions.join(values, "arc", "left").select(
        "arc", "pos", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("leaf", "saved")]))
    sums = running(along, [], ["pos"], leaves=("sum", "leaf"), savings=("sum", "saved"))
    sign = F.when(F.col("arc") % 2 == 1, 1).otherwise(-1)
    subtrees = sums.groupBy(F.shiftright("arc", 1).alias("g")).agg(
        F.sum(sign * F.col("leaves")).alias("n_leaves"), F.sum(sign * F.col("savings")).alias("saved_tokens"))
    empty = F.lit(hashlib.sha256().hexdigest())
    return (
        linked.join(subtrees, "g").join(_ends(keyed, convs), ["depth", "a", "b"], "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", empty)).select(*RESULT)
    )


def prefix_trie(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", regrow: bool = False,
) -> DataFrame:
    """A row for each node of the trie of conversations, the textless root included.

    ``conv_id`` (lowest member) and ``depth`` name the node, ``parent_conv_id`` its parent (null for the root);
    ``n_convs`` counts the members, ``n_children`` the children, ``n_leaves`` the childless nodes of its subtree;
    ``saved_tokens`` sums over the subtree the words of a node's last text for every member but one;
    ``ends_sha256`` digests the ids of conversations that end there.  With ``regrow`` conversations are first
    rebuilt as ``regrown`` does.

    Turns go by number, null first, equal ones by a hash of role and text; null role or text counts as empty, and a
    row that repeats another is a turn of its own.  Rows without a conversation are left out, an empty table gives no
    rows, other columns are ignored, texts of any length count whole.
    """
    turns = stored(numbered_turns(conversations, conv_col, turn_col, role_col, text_col))
    convs = lengths_of(turns)
    if regrow:
        turns, convs = regrown(turns, convs)
    else:
        turns = turns.join(checked_broadcast(convs), "conv_id")
    return trie(turns, convs)
