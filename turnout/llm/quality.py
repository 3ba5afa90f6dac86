"""Document quality by a classifier and a hierarchy of site posteriors.

A logistic classifier in numpy, fitted on at most ``FITTED`` labelled rows, gives each document a
probability.  These are evidence for the sites too: all documents of a path (and of its host) are
summed up, a labelled one with its label, an unlabelled one with its probability at the weight ``SOFT``.
Hosts are shrunk toward the global share of good documents and paths toward their host,

    host = (good + k global) / (n + k),    path = (good + j host) / (n + j)

where k and j follow from how much the shares of hosts (of paths within hosts) differ beyond what their
sizes explain (method of moments), so that sparse sites stay close to the level above.  The final
score adds the log odds that the path's posterior has over the global share to those of the document.

The sums are grouped aggregations, combined before the shuffle: a host with a third of all
documents is a few rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from turnout.llm.tables import checked_broadcast, rows_of, shared_bytes, stored
from turnout.llm.toxicity import held_out
from turnout.llm.words import encoded, mix, word_hashes

BINS = 1 << 16
FITTED = 20_000
SOFT = 0.2
THRESHOLD = 0.5
STEPS, BATCH, RATE, DECAY = 600, 1024, 0.1, 1e-3
LEAST, MOST = 1.0, 10_000.0  # bounds of the strengths k and j
COUNTS = 24


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bins and values: shares of hashed words, and what the text as a whole looks like."""
    raw = encoded(text, True)
    words = word_hashes(raw)
    n = max(len(words), 1)
    at, counts = np.unique((mix(words, 71) % np.uint64(BINS - COUNTS)).astype(np.int64) + COUNTS, return_counts=True)
    data = np.frombuffer(raw, np.uint8)
    size = max(len(data), 1)
    classes = [
        (data >= 97) & (data <= 122), (data >= 48) & (data <= 57), data == 32, data == 10, data > 127,
        (data > 32) & (data < 48), (data > 57) & (data < 65), (data > 90) & (data < 97), (data > 122) & (data < 128),
    ]
    shares = [c.sum() / size for c in classes]
    repeats = 1 - len(at) / n
    lines = raw.split(b"\n")
    whole = [
        1.0, np.log1p(len(words)) / 5, len(data) / n / 10, repeats, 1 - len(set(lines)) / len(lines),
        np.log1p(counts.max() if len(counts) else 0) / 5, float(len(words) < 20), *shares,
        float(shares[3] > 0.03), float(shares[1] > 0.05), float(shares[5] + shares[6] > 0.08), repeats**2,
    ]
    values = np.sqrt(counts / n)
    return np.concatenate([np.arange(len(whole)), at]), np.concatenate([whole, values])


class Classifier:
    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def logit(self, text: str | None) -> float:
        at, values = features(text)
        return float(np.clip((self.weights[at] * values).sum(), -12, 12))


def _featured(batches):
    for batch in batches:
        rows = [(d, y, *features(t)) for d, y, t in rows_of(batch, "doc_id", "good", "text")]
        ids, good, at, values = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(good, pa.int32()),
             pa.array([a.astype(np.int32).tobytes() for a in at], pa.binary()),
             pa.array([v.astype(np.float32).tobytes() for v in values], pa.binary())],
            ["doc_id", "good", "at", "values"],
        )


def fit(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, seed: int = 7) -> Classifier:
    """Logistic regression by stochastic steps with a step size for each weight."""
    w, squares = np.zeros(BINS), np.full(BINS, 1e-8)
    if not len(rows) or good.min() == good.max():
        w[0] = 0.0 if not len(rows) else (4.0 if good[0] else -4.0)
        return Classifier(w)
    share = good.mean()
    w[0] = np.log(share / (1 - share))
    rng = np.random.default_rng(seed)
    for _ in range(STEPS):
        chosen = rng.integers(0, len(rows), BATCH)
        at = np.concatenate([rows[i][0] for i in chosen])
        values = np.concatenate([rows[i][1] for i in chosen])
        who = np.repeat(np.arange(BATCH), [len(rows[i][0]) for i in chosen])
        z = np.bincount(who, w[at] * values, BATCH)
        slope = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - good[chosen]
        grad = np.bincount(at, slope[who] * values / BATCH, BINS) + DECAY * w * (w != 0)
        squares += grad * grad
        w -= RATE * grad / np.sqrt(squares)
    return Classifier(w)


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Fit on the labelled rows outside the held-out fold with the lowest hashes of their ids."""
    known = (
        labels.where("doc_id is not null and good is not null").where(~held_out())
        .groupBy("doc_id").agg(F.max("good").alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(FITTED)
    )
    found = stored(
        docs.select("doc_id", "text").join(F.broadcast(stored(known)), "doc_id")  # at most FITTED rows
        .select("doc_id", "good", "text")
        .mapInArrow(_featured, "doc_id long, good int, at binary, values binary")
    )
    rows = sorted(found.toLocalIterator(), key=lambda r: (r[0], len(r[2])))
    return fit(
        [(np.frombuffer(r.at, np.int32), np.frombuffer(r["values"], np.float32)) for r in rows],
        np.asarray([r.good for r in rows], np.float64),
    )


def _strength(groups: DataFrame, above: str) -> float:
    """How many documents the level above counts for, from the spread of shares around it.

    With n documents and a true spread v, a share varies by m (1 - m) / n + v (1 - 1/n); v over
    all groups gives m (1 - m) / v - 1.
    """
    m = F.col(above)
    noise, spread = m * (1 - m) / F.col("n"), F.pow(F.col("good") / F.col("n") - m, 2)
    level, excess, weight = groups.where("n > 0").agg(
        F.sum(m * (1 - m) * F.col("n")), F.sum((spread - noise) * F.col("n")), F.sum("n"),
    ).first()
    if not weight or excess is None or excess <= 0:
        return MOST
    return float(min(MOST, max(LEAST, level / excess - 1)))


def site_posteriors(evidence: DataFrame) -> tuple[DataFrame, float]:
    """``host``, ``path`` and ``posterior`` from rows of ``host``, ``path``, ``n`` and ``good``; the global share."""
    paths = stored(evidence.groupBy("host", "path").agg(F.sum("n").alias("n"), F.sum("good").alias("good")))
    total = paths.agg(F.sum("n"), F.sum("good")).first()
    share = min(max((total[1] or 0.0) / total[0], 1e-4), 1 - 1e-4) if total[0] else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).withColumn(
        "above", F.lit(share)
    )
    k = _strength(hosts, "above")
    hosts = hosts.select(
        F.col("host").alias("h"), ((F.col("good") + k * share) / (F.col("n") + k)).alias("above")
    )
    inner = stored(paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h"))
    j = _strength(inner, "above")
    posterior = (F.col("good") + j * F.col("above")) / (F.col("n") + j)
    return stored(inner.select("host", "path", posterior.alias("posterior"))), share


def quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    host: str = "source", path: str = "lang", label: str = "quality", threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``document_score``, ``site_score``, ``score`` and ``keep`` for each row.

    ``host`` and ``path`` are SQL expressions over ``docs``; documents without a host (path) form
    one of their own.  Labels of the held-out fold are not learnt from.  A null or empty text is scored by its
    features, like any other.  Rows that repeat an id are scored one by one; rows without an id have no label.
    Without labels every document has odds of one.  Other columns are ignored; an empty table gives no
    rows; texts are read whole.
    """
    own = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.expr(host).cast("string").alias("host"), F.expr(path).cast("string").alias("path"),
    )
    known = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("good"))
    model = train(own, known)
    sent = shared_bytes(docs.sparkSession, model.weights.astype(np.float32))

    @F.pandas_udf("double")
    def logit(texts):
        judge = Classifier(sent.value)
        return texts.map(judge.logit)

    # Texts are read once: what follows needs the ids, sites and log odds only.
    judged = stored(own.select("doc_id", "host", "path", logit("text").alias("logit")))
    learnt = stored(
        known.where("good is not null and doc_id is not null").where(~held_out())
        .groupBy("doc_id").agg(F.max("good").alias("good"))
    )
    chance = 1 / (1 + F.exp(-F.col("logit")))
    evidence = judged.join(learnt, "doc_id", "left").select(
        "host", "path", F.when(F.col("good").isNull(), SOFT).otherwise(1.0).alias("n"),
        F.when(F.col("good").isNull(), SOFT * chance).otherwise(F.col("good").cast("double")).alias("good"),
    )
    sites, share = site_posteriors(evidence)
    base = float(np.log(share / (1 - share)))
    sites = checked_broadcast(sites.select(
        F.col("host").alias("h"), F.col("path").alias("p"), F.col("posterior").alias("site_score")
    ))
    score = 1 / (1 + F.exp(-(F.col("logit") + F.ln(F.col("site_score") / (1 - F.col("site_score"))) - base)))
    return (
        judged.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
        .select(
            "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), chance.alias("document_score"),
            "site_score", score.alias("score"),
        )
        .withColumn("keep", F.col("score") >= threshold)
    )
