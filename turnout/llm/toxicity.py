"""Toxicity scores by non-negative positive-unlabelled learning in numpy.

Confirmed toxic rows are positives; all other rows count as unlabelled, of which a share, the
class prior, is toxic too.  With logistic losses, the risk of a linear model is

    prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)])

where the second term is the corrected estimate of the risk on clean text; a step that would
drive it below zero goes back up instead, which keeps the model from learning the
unlabelled rows by heart.

Features are the distinct lower-cased words of the whole text and their first 4, 5 and 6 bytes (stems),
hashed to ``BINS`` bins.  A word's weight never depends on the length of the text, so that a few words decide
in a long text too.  Only bins that occur in several positives can get a weight.
The model is fitted on at most ``POSITIVES`` and ``UNLABELLED`` rows, those with the
lowest hash of their id; every row is scored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from turnout.llm.tables import rows_of, shared_bytes, stored
from turnout.llm.words import distinct, mix, word_hashes
from turnout.llm.worker import release

BINS = 1 << 18
POSITIVES, UNLABELLED = 6_000, 18_000
STEMS = (4, 5, 6)
DEVIATIONS = 2
THRESHOLD = 0.3
STEPS, BATCH, RATE, DECAY = 800, 1024, 0.2, 5e-4


def features(text: str | None, bins: int = BINS) -> np.ndarray:
    """Bins of the distinct words and stems, without punctuation around them."""
    raw = (text or "").lower().encode("utf-8", "replace").translate(_PLAIN)
    hashes = [mix(word_hashes(raw, most), 51 + (most or 0)) for most in (None, *STEMS)]
    return distinct((np.concatenate(hashes) & np.uint64(bins - 1)).astype(np.int32))


#: ASCII other than letters and digits separates words here.
_PLAIN = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def _featured(batches):
    release()
    for batch in batches:
        rows = [(d, p, features(t)) for d, p, t in rows_of(batch, "doc_id", "positive", "text")]
        ids, positive, bins = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(positive, pa.bool_()),
             pa.array([b.tobytes() for b in bins], pa.binary())],
            ["doc_id", "positive", "bins"],
        )


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class _Rows:
    """Rows of bins, back to back."""

    def __init__(self, rows: list[np.ndarray]):
        self.starts = np.cumsum([0, *map(len, rows)])
        self.bins = np.concatenate([*rows, np.empty(0, np.int32)])

    def __len__(self):
        return len(self.starts) - 1

    def pick(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bins of some rows, and for each the place of its row in ``at``."""
        sizes = self.starts[at + 1] - self.starts[at]
        owner = np.repeat(np.arange(len(at)), sizes)
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.bins[self.starts[at][owner] + inside], owner


class Model:
    """A linear model over bins."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def score(self, bins: np.ndarray) -> float:
        return float(_sigmoid(self.weights[bins].sum() + self.bias))


def _counts(rows: list[np.ndarray], bins: int) -> np.ndarray:
    """How many rows have each bin; a number for each bin of a thousand rows at a time."""
    total = np.zeros(bins, np.int64)
    for first in range(0, len(rows), 1000):
        total += np.bincount(np.concatenate(rows[first : first + 1000]), minlength=bins)
    return total


def _frequent(positive: list[np.ndarray], unlabelled: list[np.ndarray], bins: int) -> np.ndarray:
    """Bins in a hundredth of the positives, three at least, and more often than chance allows."""
    here, there = (_counts(x, bins) for x in (positive, unlabelled))
    expected = len(positive) * there / len(unlabelled)
    often = here >= max(3, 0.01 * len(positive))
    return np.flatnonzero(often & (here - expected > DEVIATIONS * np.sqrt(expected + 1)))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, bins: int = BINS,
        steps: int = STEPS, seed: int = 5) -> Model:
    """Minimise the non-negative risk by stochastic steps with a step size for each weight."""
    weights = np.zeros(bins)
    if not positive or not unlabelled:
        return Model(weights, -30.0)  # nothing is known to be toxic
    chosen = _frequent(positive, unlabelled, bins)
    place = np.full(bins, -1, np.int32)
    place[chosen] = np.arange(len(chosen))

    def narrowed(rows):
        return _Rows([x[x >= 0] for x in (place[r] for r in rows)])

    pos, unl = narrowed(positive), narrowed(unlabelled)
    size = len(chosen)
    w, squares, bias_squares = np.zeros(size), np.full(size, 1e-8), 1e-8
    bias = float(np.log(prior / (1 - prior)))
    rng = np.random.default_rng(seed)
    for _ in range(steps):
        p_bins, p_of = pos.pick(rng.integers(0, len(pos), BATCH))
        u_bins, u_of = unl.pick(rng.integers(0, len(unl), BATCH))
        p = _sigmoid(np.bincount(p_of, w[p_bins], BATCH) + bias)
        u = _sigmoid(np.bincount(u_of, w[u_bins], BATCH) + bias)
        # Losses: -log s(x) for toxic, -log(1 - s(x)) for clean; their slopes are s - 1 and s.
        clean = -np.log1p(-u + 1e-12).mean() + prior * np.log1p(-p + 1e-12).mean()
        if clean >= 0:
            p_slope, u_slope = np.full(BATCH, -prior), u
        else:
            p_slope, u_slope = prior * p, -u
        grad = np.bincount(p_bins, p_slope[p_of] / BATCH, size)
        grad += np.bincount(u_bins, u_slope[u_of] / BATCH, size) + DECAY * w
        squares += grad * grad
        w -= RATE * grad / np.sqrt(squares)
        slope = p_slope.mean() + u_slope.mean()
        bias_squares += slope * slope
        bias -= RATE * slope / np.sqrt(bias_squares)
    weights[chosen] = w
    return Model(weights, bias)


def held_out(id_column: str = "doc_id"):
    """The fold that no label is learnt from."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on documents outside the held-out fold.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``toxic``.  The prior is the
    share of toxic rows among the labelled ones, held between 0.005 and 0.5.
    """
    known = stored(
        labels.where("doc_id is not null and toxic is not null").where(~held_out())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    total, toxic = known.agg(F.count("*"), F.sum("toxic")).first()
    if not toxic:
        return fit([], [], 0.0)
    prior = min(max(toxic / total, 0.005), 0.5)

    def lowest(ids, limit):
        return stored(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))

    texts = docs.select("doc_id", "text").where("text is not null")
    chosen = lowest(known.where("toxic = 1").select("doc_id"), POSITIVES).withColumn("positive", F.lit(True))
    # Unlabelled: any document whose label may be used or that has none.
    pool = lowest(
        docs.select("doc_id").where("doc_id is not null").where(~held_out()).distinct(), UNLABELLED
    ).withColumn("positive", F.lit(False))
    both = chosen.union(pool)  # at most POSITIVES + UNLABELLED rows
    rows = stored(texts.join(F.broadcast(both), "doc_id").select("doc_id", "positive", "text").mapInArrow(
        _featured, "doc_id long, positive boolean, bins binary"
    ))
    sides, every = ([], []), bytearray()  # in one piece, which the driver gets back whole
    for row in rows.toLocalIterator():
        sides[row.positive].append((row.doc_id, len(row.bins) // 4, len(every) // 4))
        every += row.bins
    bins = np.frombuffer(every, np.int32)
    unlabelled, positive = ([bins[start : start + n] for _, n, start in sorted(side)] for side in sides)
    return fit(positive, unlabelled, prior)


def scores(docs: DataFrame, model: Model):
    """A column with the score of ``text``."""
    own = shared_bytes(docs.sparkSession, (model.weights.astype(np.float32), model.bias))

    @F.pandas_udf("double")
    def score(texts):
        release()
        judge = Model(*own.value)
        return texts.map(lambda t: judge.score(features(t)))

    return score("text")


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for each row.

    Labels of the held-out fold are not learnt from; language, source, id and labels
    are no input of a score.  A null or empty text gets the score of a text without words.  Equal
    texts have equal scores; rows that repeat an id are scored one by one; a row without an id
    is scored and not held out.  Without a toxic label all scores are next to 0.  Texts of any length
    are read whole, other columns are ignored, and an empty table gives no rows.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    model = train(texts, labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")))
    return texts.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        scores(texts, model).alias("score"),
    ).withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
