from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.helpers import empty, frame, odd_rows
from tripmart.llm import divergence
from tripmart.llm.tables import read

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=3, top=200):
    """rows of (text, lang, source), term by term."""
    docs = [(lang or "", source or "", re.findall(divergence.TERM, (text or "").translate(FOLD))) for text, lang, source in rows]
    out = []
    for lang in {x[0] for x in docs}:
        own = [x for x in docs if x[0] == lang]
        having = Counter(t for _, _, terms in own for t in set(terms))
        kept = {t for t, n in having.items() if n >= least}
        counts = defaultdict(Counter)
        for _, source, terms in own:
            counts[source].update(t for t in terms if t in kept)
        whole = sum(counts.values(), Counter())

        def shares(c):
            n = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // n for t in kept}

        of, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for source, p in of.items():
            pairs = [(s, sum((p[t] - r[t]) ** 2 // r[t] for t in kept)) for s, r in of.items() if s != source]
            terms = [(t, (p[t] - q[t]) ** 2 // q[t]) for t in kept if counts[source][t] and p[t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, source, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def rows_of(df):
    return [(r["text"], r["lang"], r["source"]) for r in df.select("text", "lang", "source").collect()]


@pytest.mark.parametrize("least", [1, 2, 3])
def test_odd_rows(spark, least):
    more = [
        (50, "One,two;THREE one\x1cone x É é", "en", "a"), (51, "one two three", "en", "b"), (52, "one. \"two\" three!", "en", "b"),
        (53, "ONE (one) o'ne", "en", "c"), (54, "zwei zwei", "de", "a"), (55, "12 34 --", "de", "b"), (56, None, "de", None), (57, "nur hier", "fi", "a"),
        (58, "日本語 テキスト 日本語", None, None), (59, "日本語", None, "a"), (60, "日本語,日本語", "", "b"),
    ]
    rows = odd_rows() + [(*x, None) for x in more]
    df = frame(spark, rows)
    assert sorted(map(tuple, divergence.audit(df, least).collect())) == brute([x[1:4] for x in rows], least)


def test_given_documents_and_small_blocks(spark, monkeypatch):
    docs = read(spark, SMALL, "documents")
    expected = brute(rows_of(docs))
    assert sorted(map(tuple, divergence.audit(docs).collect())) == expected
    monkeypatch.setattr(divergence, "CELLS", 500)  # many blocks of terms
    again = docs.withColumn("lang", F.when(F.col("lang") != "en", F.col("lang")))
    assert sorted(map(tuple, divergence.audit(again).collect())) == brute(rows_of(again))


def test_nothing(spark):
    assert divergence.audit(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        divergence.audit(empty(spark), least=4)


def test_counts_that_fill_64_bits(spark):
    big = np.array([[10**13, 3], [0, 2**62]], np.int64)
    totals = big.sum(axis=1)
    assert divergence.shares(big, totals, 2).tolist() == [[1 + 10**9 * (int(c) + 1) // (int(n) + 2) for c in row] for row, n in zip(big, totals)]
    df = spark.createDataFrame([(10**13, 10**14, 7), (5, 100, 3)], "count long, total long, kept long")
    found = [r[0] for r in df.select(divergence.share(F.col("count"), F.col("total"), F.col("kept"))).collect()]
    assert found == [1 + 10**9 * (c + 1) // (n + v) for c, n, v in ((10**13, 10**14, 7), (5, 100, 3))]


def test_flushes_count_alike():
    held = divergence.ChunkCounts(2)
    for number, text in enumerate([b"a b a", b"A c", b"b", b"a"]):
        held.add(number, "en", "t" if number == 1 or number == 2 else "s", text)
    chunks, groups = ([x.to_pylist() for x in columns] for columns in held.columns())
    found = {chunk: (dict(zip(sources, counts)), *rest) for chunk, sources, counts, *rest in zip(*chunks[1:])}
    assert found == {b"a": ({"s": 3, "t": 1, None: 0}, 2, 0, 1), b"b": ({"s": 1, "t": 1, None: 0}, 2, 0, 2), b"c": ({"t": 1, None: 0}, 1, 1, 1)}
    assert groups == [["en"], [None], [["s", "t"]], [[0, 0]], [0], [None], [None]]


def test_tasks_count_terms(spark):
    """What stands beside a term makes no rows of its own, and no other byte is taken for a letter or a space."""
    rows = [(1, 'Word, word. (WORD) "word" word-word\x1cword\x7fword', "en", "a", 1), (2, "É é\xa0é\u3000@[`{ÀZ", "en", "a", 1)]
    found = {bytes(r["chunk"]).decode(): (r["counts"], r["n_documents"]) for r in divergence.count_chunks(frame(spark, rows)).collect() if r["chunk"]}
    assert found == {"word": ([8, 0], 1), "É": ([1, 0], 1), "é\xa0é\u3000": ([1, 0], 1), "Àz": ([1, 0], 1)}
    known = set("".join(map(chr, range(0x250))))
    for letter in known:
        assert (letter.encode().translate(divergence._TERM_BYTES).split() != []) == bool(re.fullmatch(divergence.TERM, letter))
