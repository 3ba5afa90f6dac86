"""The prefix trie against a plain one, ranking of lists, and scans over ranges."""

import hashlib
import random
import re
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from turnout.llm import running as scans, trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string"


def spark_hash(seed, role, text):
    """As the library hashes a turn."""
    state = 42
    for part in (seed.to_bytes(4, "little"), role.encode(), text.encode()):
        state = xxhash.xxh64_intdigest(part, seed=state)
    return state - 2**64 if state >= 2**63 else state


def brute(rows, regrow=True):
    turns = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns.setdefault(conv_id, []).append((turn, role or "", text or ""))
    for own in turns.values():
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, spark_hash(1, *t[1:]), spark_hash(2, *t[1:])))
    grown = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4 if regrow else 0
        base = turns.get(c - c % 20 if c >= 0 else c + -c % 20, [])
        grown[c] = tuple(t[1:] for t in (*base[:h], *own[h:]))
    members = {}
    for c, path in grown.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        kids = lambda p: sum(len(q) == len(p) + 1 and q[: len(p)] == p for q in members)
        ends = sorted(c for c in convs if grown[c] == path)
        out.append((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), kids(path),
            sum(kids(p) == 0 for p in below),
            sum((len(members[p]) - 1) * len(WORD.findall(p[-1][1])) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def talks(seed=5):
    """Conversations that share first turns, with odd rows."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 160), 90):
        for turn in range(rng.choice([1, 1, 2, 3, 5, 9])):
            word = rng.choice("abc") if turn < 4 else str(rng.random())
            rows.append((c, turn * 3 - 4, rng.choice(["user", "bot"]) if turn else "user", f"say {word}  {word}"))
    rows += [(200, None, None, None), (200, None, "user", "x"), (200, 0, "user", ""), (201, 5, "a", "b")]
    rows += [(202, 1, "user", "again")] * 3 + [(203, 7, "b", "t"), (203, 7, "a", "t"), (203, 7, "a", "s")]
    rows += [(None, 0, "user", "say a  a"), (204, 0, "user", "long " * 100_000)]
    rows += [(300 + i, t, "user", f"copy {t}") for i in range(40) for t in range(3)]
    return rows


def found(spark, rows, **names):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("x") for n in ("depth", "part", "g", "h1")})
    return sorted(map(tuple, trie.prefix_trie(df.repartition(4), **names).collect()), key=str)


@pytest.mark.parametrize("regrow", [True, False])
def test_as_brute_force(spark, regrow):
    assert found(spark, talks(), regrow=regrow) == brute(talks(), regrow)


def test_one_conversation_holds_most_turns(spark):
    rows = [(7, t, "user", f"turn {t % 50}") for t in range(3000)] + [(c, 0, "user", "turn 0") for c in range(30)]
    nodes = found(spark, rows)
    assert len(nodes) == len({r[:2] for r in nodes})
    assert max(r[1] for r in nodes) >= 2997
    by_depth = {r[1]: r for r in nodes if r[0] == 7 and r[1] > 100}
    assert all(r[5] == 1 and r[2] == 7 for r in by_depth.values())


@pytest.mark.parametrize("rows", [[], [(None, 1, "a", "b")], [(20, 0, "user", "x")], [(1, 0, "user", "x")]])
def test_small_tables(spark, rows):
    assert found(spark, rows, regrow=True) == (brute(rows) if any(r[0] is not None for r in rows) else [])


@pytest.mark.parametrize("at_once", [1 << 18, 5])
def test_ranks(spark, at_once):
    rng = random.Random(1)
    ids = rng.sample(range(1000), 300)
    ways = [0] + [rng.randrange(1, 5) for _ in ids[1:]]
    links = list(zip(ids, [-1, *ids], ways))
    rank, expected = 0, []
    for i, _, way in links:
        rank += way
        expected.append((i, rank))
    rng.shuffle(links)
    df = spark.createDataFrame(links, "id long, pred long, way long")
    assert sorted(map(tuple, trie.ranks(df, at_once).collect())) == sorted(expected)


def test_running(spark):
    rng = random.Random(2)
    rows = [(rng.choice([1, 1, 1, 2, 3, 4]), i, rng.randrange(-50, 50)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, i long, v long").repartition(6)
    for group in (["k"], []):
        out = scans.running(df, group, ["i"], s=("sum", "v"), x=("xor", "v"), p=("previous", "i")).collect()
        state, expected = {}, {}
        for k, i, v in rows:
            s, x, p = state.get(k if group else 0, (0, 0, -1))
            expected[i] = s, x, p
            state[k if group else 0] = s + v, x ^ v, i
        assert {r.i: (r.s, r.x, r.p) for r in out} == expected
