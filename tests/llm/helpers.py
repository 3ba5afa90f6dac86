"""Small tables with all that may go wrong in them, and plain versions of what operators promise."""

import random
import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(rng, n):
    return [rng.choice("abcdefghij") + rng.choice("klmnop") + str(rng.randrange(400)) for _ in range(n)]


def corpus(seed=3):
    """(id, text): prose, copies, near copies, a passage that many share, and odd rows."""
    rng = random.Random(seed)
    rows, passage, base = [], prose(rng, 55), prose(rng, 120)
    for i in range(12):
        rows.append((10 * i, " ".join(prose(rng, rng.randrange(3, 150)))))
    for i in range(10):  # near copies: a few words changed
        near = list(base)
        for _ in range(i % 4):
            near[rng.randrange(len(near))] = f"x{rng.randrange(10**6)}"
        rows.append((500 - i, " ".join(near)))
    for i in range(8):  # the passage between own words
        rows.append((300 + i, " ".join(prose(rng, 30) + passage + prose(rng, 25))))
    rows += [(701, rows[0][1]), (702, rows[0][1].upper()), (703, "One Two three"), (704, "one two THREE")]
    rows += [(801, None), (802, ""), (803, " \t\n "), (804, "a"), (None, "no id here at all, none"), (None, None)]
    rows += [(805, rows[3][1])] * 2
    rows.append((900, " ".join(prose(rng, 6000)) + " " + " ".join(passage)))
    return rows


def table(spark, rows, *clashing):
    """A table of documents with more columns, named like ones that operators use themselves."""
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({name: F.lit("x") for name in clashing}) if clashing else df


def unique_ids(rows):
    """Rows without those that repeat an id or have none."""
    seen = {}
    for doc_id, text in rows:
        if doc_id is not None:
            seen.setdefault(doc_id, text)
    return seen
