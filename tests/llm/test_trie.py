from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def token(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    """Every prefix of every rebuilt conversation, by dictionaries."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, token(role or "", text or ""), (role or "", text or "")))
    own = {c: [x[-1] for x in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole[c] = own.get(base, [])[:h] + turns[h:]
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for prefix in members:
        if prefix:
            children[prefix[:-1]] = children.get(prefix[:-1], 0) + 1
    leaves, saved = {}, {}
    for prefix, cs in members.items():
        for d in range(len(prefix) + 1):
            leaves[prefix[:d]] = leaves.get(prefix[:d], 0) + (prefix not in children)
            saved[prefix[:d]] = saved.get(prefix[:d], 0) + ((len(cs) - 1) * len(prefix[-1][1]) if prefix else 0)
    out = []
    for prefix, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(whole[c]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        out.append((min(cs), len(prefix), parent, len(cs), children.get(prefix, 0), leaves[prefix], saved[prefix], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def made(seed, convs, turns, kinds):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(rng.randint(0, turns)):
            text = rng.choice(["a", "bb", "", None, "ccc 🙂"][:kinds]) if rng.random() < 0.8 else f"own {c} {t}"
            rows.append((c, None if rng.random() < 0.05 else t // 2 * 2, rng.choice(["user", None, "x"][: max(1, kinds - 1)]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk, part_turns", [(2, 7), (3, 1_000_000), (64, 15)])
def test_same_as_dictionaries(spark, chunk, part_turns):
    rows = made(chunk, [*range(0, 60), *range(100, 160), *range(1240, 1260), -3, -100, 5000, 7700], 9, 3)
    rows += made(5, [9000, 9001], 90, 2) + [(None, 1, "user", "no conversation")] + [(300 + k % 3, k, "user", "same") for k in range(40)]
    rows += [(8000 + k, t, "user", f"copy {t}") for k in range(30) for t in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("conv", "pos", "depth", "part", "k", "least", "key"):
        df = df.withColumn(name, F.lit("x"))
    out = prefix_trie.trie(df, chunk, part_turns)
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows)


def test_empty_and_turnless(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.trie(none).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0
    one = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1)  # its base isn't there, so its turn is cut off
    rows = [(one, 0, "a", "b")]
    assert [tuple(x) for x in prefix_trie.trie(spark.createDataFrame(rows, SCHEMA)).collect()] == brute(rows)


def test_range_minima():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 64, 200):
        values = rng.integers(0, 6, size)
        values[0] = -1
        table = prefix_trie.RangeMinimum(values)
        first = rng.integers(0, size, 300)
        last = np.minimum(first + rng.integers(0, size, 300), size - 1)
        assert table.of(first, last).tolist() == [values[a : b + 1].min() for a, b in zip(first, last)]
        depth = rng.integers(1, 7, 300)
        for at, d, left, right in zip(first, depth, *table.extents(first, depth)):
            a = b = at
            while values[a] >= d:
                a -= 1
            while b + 1 < size and values[b + 1] >= d:
                b += 1
            assert (left, right) == (a, b)
