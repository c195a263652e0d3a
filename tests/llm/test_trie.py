"""The prefix trie against rebuilt texts, whole tables against SQL, running values by themselves."""
import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from tests.oracle import compare, connect
from tidemark.llm import scans, trie
from tidemark.llm.queries import ORACLES, QUERIES

SHAPE = "conv_id long, turn long, role string, text string, depth int, owner string, words int"


def plain(rows):
    """Node rows by putting every conversation together."""
    stored = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            stored[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    turns = {c: [x for _, x in sorted(t, key=lambda r: r[0])] for c, t in stored.items()}
    members = defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = turns.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])
        path = tuple(base[:h] + own[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, len(path) == d))
    below = {p: [q for q in members if q[:len(p)] == p] for p in members}
    leaf = {p: not any(len(q) == len(p) + 1 for q in below[p]) for p in members}
    words = lambda p: len(p[-1][1].split()) if p else 0
    out = []
    for p, who in members.items():
        ends = ",".join(map(str, sorted(c for c, last in who if last)))
        out.append((min(who)[0], len(p), min(members[p[:-1]])[0] if p else None, len(who),
                    sum(len(q) == len(p) + 1 for q in below[p]), sum(leaf[q] for q in below[p]),
                    sum((len(members[q]) - 1) * words(q) for q in below[p]), sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SHAPE).repartition(5)


@pytest.mark.parametrize("seed", range(2))
def test_random_conversations(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-45, 130), 60):
        n = rng.choice([1, 1, 2, 3, 5, 40 if c % 20 == 0 else 4])
        rows += [(c, t if t else None, rng.choice(["user", "assistant", None]),
                  rng.choice(["hi there", "a b c", "", None, "x", "\t y  z"])) for t in range(n)]
    rows.append((None, 0, "user", "no conversation"))
    rng.shuffle(rows)
    got = nodes(trie.prefix_trie(made(spark, rows)))
    assert got == plain(rows)
    if seed:
        assert nodes(trie.prefix_trie(made(spark, rows), seed=99)) == got


def test_long_and_equal_conversations_over_many_tasks(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    rows = [(40, t, "user", f"turn {t % 7}") for t in range(300)]
    rows += [(c, t, "user", f"turn {t % 7}") for c in range(41, 90) for t in range(3)]
    rows += [(c, t, "user", f"turn {t % 7}") for c in (100, 119) for t in range(150)]
    assert nodes(trie.prefix_trie(made(spark, rows))) == plain(rows)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_odd_rows(spark):
    only = [(5, None, None, None)]
    assert nodes(trie.prefix_trie(made(spark, only))) == plain(only)
    bare = [(c, 0, "user", "lost") for c in range(1, 20)]
    got = nodes(trie.prefix_trie(made(spark, bare)))
    assert got == plain(bare) and got[0][3] == 19
    twice = [(7, 1, "user", "again"), (7, 1, "user", "again"), (7, 1, "user", "again"), (0, 0, "a", "b")]
    assert nodes(trie.prefix_trie(made(spark, twice))) == plain(twice)
    assert not trie.prefix_trie(made(spark, only).limit(0)).collect()
    assert not trie.prefix_trie(made(spark, [(None, 1, "a", "b")])).collect()


def test_tied_turns_stand_in_one_order(spark):
    rows = [(0, 1, "user", w) for w in "abcdef"] + [(1, 0, "x", "y")]
    df = made(spark, rows)
    assert nodes(trie.prefix_trie(df)) == nodes(trie.prefix_trie(df.repartition(2)))


def test_a_collision_stops_the_job(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(F, "xxhash64", lambda *_: F.lit(4).cast("bigint"))
    with pytest.raises(ArithmeticError):
        trie.prefix_trie(made(spark, [(0, 0, "a", "b"), (0, 1, "a", "c")]))


@pytest.mark.parametrize("sf", ["0.01"])
def test_whole_table(spark, sf):
    path = f"/root/testdata/sf{sf}"
    assert compare(connect(path), QUERIES["op12_prefix_trie"](spark, path), ORACLES["op12_prefix_trie"]) == ""


def test_running_values(spark):
    rng = random.Random(2)
    rows = [(rng.choice([1, 1, 1, 2, 3, -4]), i, rng.randrange(1000)) for i in range(700)]
    df = spark.createDataFrame(rows, "k long, i long, v long").repartition(3)
    lanes = [scans.SUM, (97, 5)]
    got, _ = scans.running(df, "k", ["i"], ["v", "v"], lanes, "running")
    state, want = {}, []
    for k, i, v in sorted(rows):
        n, s, h = state.get(k, (0, 0, 0))
        n, t, g = n + 1, s + v, (h + v * 5 ** (n + 1)) % 97
        want.append((k, i, n, t, g, s, h))
        state[k] = n, t, g
    assert sorted((r["k"], r["i"], r["place"], r["upto_0"], r["upto_1"], r["before_0"], r["before_1"])
                  for r in got.collect()) == want
