"""The prefix trie against brute force over rebuilt texts."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwatch.llm import prefix_trie as trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def sha(ids):
    return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, role, hashlib.md5(f"0:{len(role)}:{role}:{text}".encode()).hexdigest(), text))
    own = {c: [(x[2], x[4]) for x in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - int(np.fmod(c, 20)), [])[:h] + x[h:]
    members = defaultdict(set)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].add(c)
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    n_children = defaultdict(int)
    for p in members:
        if p:
            n_children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * words(p)
            leaves[p[:d]] += not n_children[p]
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), n_children[p], leaves[p], saved[p],
                   sha([c for c in m if len(rebuilt[c]) == len(p)])) for p, m in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def run(df):
    out = trie.prefix_trie(df)
    assert out.columns == COLUMNS
    return sorted(tuple(r) for r in out.collect())


def conversations(n=300, seed=3, kinds=3, most=6):
    """Conversations of few different turns, so that most prefixes are shared."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 2 * n), n):
        for i in range(rng.randrange(1, most)):
            rows.append((c, i, rng.choice(["user", "assistant"]), " ".join(["word"] * rng.randrange(1, kinds))))
    return rows


@pytest.mark.parametrize("partitions", [1, 8, 60])
def test_equals_brute_force_however_ranges_cut_conversations(spark, partitions):
    conf = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        # Two long conversations hold half of all turns, and one ends inside the other.
        long = [(40, i, "user", f"t {i}") for i in range(400)] + [(41, i, "user", f"t {i}") for i in range(350)]
        rows = conversations(150) + [r for r in long]
        assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_nulls_ties_repeats_and_empty_texts(spark):
    rows = [(0, None, None, None), (0, 0, "user", ""), (0, 1, None, "a b"), (0, 1, None, "a b"), (1, 0, "user", "x"), (None, 0, "user", "lost"),
            (7, 3, "b", "x"), (7, 3, "a", "x"), (20, 0, "user", None), (21, 0, "user", "word " * 5000), (22, 5, "user", " \n\t"), (-3, 0, "u", "é")]
    rows += [(r[0], r[1], r[2], r[3]) for r in rows[4:6]]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_every_conversation_the_same(spark):
    rows = [(c, i, "user", f"turn {i}") for c in range(0, 4000, 20) for i in range(5)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_ends_are_hashed_as_a_stream(spark, monkeypatch):
    ids = spark.range(-5, 5000).select(F.lit(3).cast("long").alias("rep"), F.lit(1).cast("long").alias("depth"), F.col("id").alias("conv"))
    monkeypatch.setattr(trie, "CHUNK", 100)
    trie.ship_code()
    assert [tuple(r) for r in trie._ends(ids).collect()] == [(3, 1, sha(range(-5, 5000)))]


def test_no_turns_and_clashing_columns(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    rows = conversations(40)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("conv", "pos", "m", "w", "g0", "depth", "REP"):
        df = df.withColumn(name, F.lit("x"))
    assert run(df) == brute(rows)


def test_runs_compose():
    bases = trie._bases(0)
    rng = np.random.default_rng(1)
    x, w = rng.integers(0, 1 << 32, (50, 4)), rng.integers(0, 9, 50)
    conv = np.zeros(50, np.int64)
    whole = trie.RunScanner(bases).scan(conv, x, w)
    parts = trie.RunScanner(bases)
    pieces = [parts.scan(conv[a:b], x[a:b], w[a:b]) for a, b in ((0, 1), (1, 20), (20, 50))]
    for i in range(1, 5):
        assert np.array_equal(np.concatenate([p[i] for p in pieces]), whole[i])
    # A product by itself, moved by the power of the base, continues the one before it.
    tail = trie.RunScanner(bases).scan(conv[20:], x[20:], w[20:])[3][-1]
    p = np.array(trie.PRIMES)
    moved = (whole[3][19] + trie.powers(np.array([20]), bases)[0] * tail % p) % p
    assert np.array_equal(moved, whole[3][-1])


def test_a_hash_that_stands_for_two_is_found(spark, monkeypatch):
    ids = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 4 == 0][:3]  # with no head of another
    rows = [(ids[0], 0, "u", "a"), (ids[1], 0, "u", "b"), (ids[2], 0, "u", "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    used = []
    real = trie._bases

    def weak_first(seed):
        used.append(seed)
        return [0, 0, 0, 0] if seed == 0 else real(seed)  # every fingerprint is 0

    monkeypatch.setattr(trie, "_bases", weak_first)
    monkeypatch.setattr(trie, "pow", lambda b, e, p: 1 if not b else pow(b, e, p), raising=False)
    assert run(df) == brute(rows)
    assert used == [0, 1]
