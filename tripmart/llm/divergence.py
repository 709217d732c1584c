"""How sources of a language differ in their words: each source against each other, and against the language.

In UTF-8 a term ends at any ASCII byte but a letter, so a text with those made spaces is cut at its spaces into terms.
Tasks count chunks of the text so made, which are terms: how often each stands in a (lang, source) group, and how many
documents have it. Terms are few beside their occurrences; those that too few documents have go where counts first meet.

Counts are compared as integer shares of 10**9, each kept term counted once more than it occurs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.tables import written

#: Documents of a language that a term needs to be kept; ranks of the report on single terms.
LEAST_DOCUMENTS, TOP = 3, 200
SCALE = 10**9
#: Different chunks by group that a task counts before it hands them on, and cells (source, term) of a block of terms.
HELD, CELLS = 1_000_000, 1 << 20
#: Counts from here on would overflow when scaled in 64 bits.
_SMALL = (2**63 - 1) // SCALE - 1

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of texts with A-Z as a-z, and a space for what no term has.
_TERM_BYTES = bytes(k if k >= 128 or 97 <= k <= 122 else k + 32 if 65 <= k <= 90 else 32 for k in range(256))


# Counting -------------------------------------------------------------------------------------------------------


class ChunkCounts:
    """Chunks of documents by group, and for each language how many documents have each chunk, up to ``least``, and the
    first and last of those."""

    def __init__(self, least: int):
        self.least = least
        self.counts: dict[tuple[str, str], Counter] = {}
        self.documents: dict[str, dict[bytes, list[int]]] = {}
        self.enough: dict[str, set[bytes]] = {}

    def add(self, number: int, lang: str, source: str, text: bytes) -> None:
        chunks = text.translate(_TERM_BYTES).split()
        self.counts.setdefault((lang, source), Counter()).update(chunks)
        known, enough = self.documents.setdefault(lang, {}), self.enough.setdefault(lang, set())
        for chunk in set(chunks) - enough:
            found = known.setdefault(chunk, [])
            found.append(number)
            if len(found) == self.least:
                enough.add(chunk)

    def size(self) -> int:
        return sum(map(len, self.counts.values()))

    def columns(self) -> Iterator[list[pa.Array]]:
        """lang, chunk, sources, counts, n_documents, low, high: for each chunk of a language the sources that have it and
        how often, and a last null source with count 0 for the documents. Without chunk: all sources."""
        by_lang: dict[str, list[tuple[str, Counter]]] = {}
        for (lang, source), counts in self.counts.items():
            by_lang.setdefault(lang, []).append((source, counts))
        for lang, groups in by_lang.items():
            known, names = self.documents[lang], [source for source, _ in groups]
            place = dict(zip(known, range(len(known)))).__getitem__
            # all (chunk, source, count), sorted by chunk; the documents' mark is one source more
            chunks = [np.fromiter(map(place, counts), np.int64, len(counts)) for _, counts in groups] + [np.arange(len(known))]
            numbers = [np.fromiter(counts.values(), np.int64, len(counts)) for _, counts in groups] + [np.zeros(len(known), np.int64)]
            codes = np.repeat(np.arange(len(chunks)), [len(x) for x in chunks])
            chunks = np.concatenate(chunks)
            order = np.argsort(chunks, kind="stable")
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(chunks, minlength=len(known)))]), pa.int32())
            sources = pa.array([*names, None], pa.string()).take(pa.array(codes[order]))
            found = known.values()
            numbers_of = lambda get: np.fromiter(map(get, found), np.int64, len(known))
            yield [
                pa.array([lang] * len(known), pa.string()), pa.array(known, pa.binary()), pa.ListArray.from_arrays(ends, sources),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate(numbers)[order])), *(pa.array(numbers_of(get)) for get in (len, itemgetter(0), itemgetter(-1))),
            ]
            none = pa.array([None], pa.int64())
            yield [pa.array([lang]), pa.array([None], pa.binary()), pa.array([names], pa.list_(pa.string())), pa.array([[0] * len(names)], pa.list_(pa.int64())), pa.array([0]), none, none]


def count_chunks(documents: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """What tasks count in ``documents`` (text, lang, source; nulls are empty): lang, chunk, sources, counts, n_documents.
    Rows of one language and chunk never speak of the same document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = ChunkCounts(least)
        number = TaskContext.get().partitionId() << 40  # a document's number, its own as long as the table is read alike

        def handed() -> Iterator[pa.RecordBatch]:
            for columns in held.columns():
                whole = pa.RecordBatch.from_arrays(columns[: len(schema)], schema=schema)
                for at in range(0, whole.num_rows, 20_000):
                    yield whole.slice(at, 20_000)

        for batch in batches:
            for text, lang, source in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                held.add(number, lang, source, text.as_py())
                number += 1
            if held.size() > HELD:
                yield from handed()
                held = ChunkCounts(least)
        yield from handed()

    lists = [("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]
    schema = pa.schema([("lang", pa.string()), ("chunk", pa.binary()), *lists, ("n_documents", pa.int64())])
    rows = documents.select(*(F.coalesce(documents[x], F.lit("")).cast(kind).alias(x) for x, kind in (("text", "binary"), ("lang", "string"), ("source", "string"))))
    return rows.mapInArrow(run, "lang string, chunk binary, sources array<string>, counts array<long>, n_documents long")


def kept_counts(documents: DataFrame, least: int = LEAST_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """Occurrences of kept terms by group: lang, source, term, count; and all groups: lang, source.

    A task tells of up to ``least`` documents with a term, and tasks have no documents in common, so their sum tells
    whether there are as many.
    """
    if not 1 <= least <= 3:
        raise ValueError("terms are kept from one, two or three documents on")
    # a task has one row for a term; where they meet, they are dealt out to sources and added up without moving again
    met = count_chunks(documents, least).repartition("lang", "chunk")
    met = met.select("lang", "chunk", "n_documents", F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("n"))))
    counts = met.groupBy("lang", "source", "chunk").agg(F.sum("n").alias("n"), F.sum("n_documents").alias("n_documents"))
    of_term = F.max(F.when(F.col("source").isNull(), F.col("n_documents"))).over(Window.partitionBy("lang", "chunk"))
    counts = counts.withColumn("all_documents", of_term).filter(F.col("source").isNotNull())
    counts = counts.filter(F.col("chunk").isNull() | (F.col("all_documents") >= least))
    counts = written(counts.select("lang", "source", F.col("chunk").cast("string").alias("term"), F.col("n").alias("count")))
    groups = counts.filter(F.col("term").isNull()).select("lang", "source")
    return counts.filter(F.col("term").isNotNull()), written(groups)


# Shares and divergences -----------------------------------------------------------------------------------------


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + kept)), exactly."""
    small = F.lit(SCALE) * F.when(count < _SMALL, count + 1)
    big = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    of = total + kept
    div = lambda a, b: F.call_function("div", a, b)
    return F.lit(1) + F.when(count < _SMALL, div(small, of)).otherwise(div(big, of.cast("decimal(20,0)")))


def distance(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / q)"""
    return F.call_function("div", (p - q) * (p - q), q)


def shares(counts: np.ndarray, totals: np.ndarray, kept: int) -> np.ndarray:
    """As ``share``, for a row of counts of each source."""
    if len(counts) and counts.max() >= _SMALL:
        exact = (SCALE * (counts.astype(object) + 1)) // (totals.astype(object) + kept)[:, None] + 1
        return exact.astype(np.int64)
    return SCALE * (counts + 1) // (totals + kept)[:, None] + 1


def _pairs(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """lang, source, item, value: sums over kept terms for each two sources of a language.

    Terms are dealt to blocks of bounded size. A task has the counts of a block for all sources as a matrix and gives
    one sum for each two sources, whatever the number of terms; the sums of the blocks are added up.
    """
    n_blocks = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n_sources") * F.col("kept") / CELLS))

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"lang": [], "source": [], "item": [], "value": []}
        if left.num_rows and right.num_rows:
            lang, kept = right.column("lang")[0].as_py(), right.column("kept")[0].as_py()
            names = right.column("source").to_pylist()
            place = {name: k for k, name in enumerate(names)}
            terms = left.column("term").dictionary_encode().combine_chunks()
            table = np.zeros((len(names), len(terms.dictionary)), np.int64)
            table[[place[x] for x in left.column("source").to_pylist()], terms.indices.to_numpy()] = left.column("count").to_numpy()
            p = shares(table, right.column("total").to_numpy(), kept)
            for k, name in enumerate(names):
                apart = p[k] - p
                sums = (apart * apart // p).sum(axis=1)
                out["lang"] += [lang] * (len(names) - 1)
                out["source"] += [name] * (len(names) - 1)
                out["item"] += names[:k] + names[k + 1 :]
                out["value"] += np.delete(sums, k).tolist()
        return pa.table(out, schema=pa.schema([(x, pa.string()) for x in ("lang", "source", "item")] + [("value", pa.int64())]))

    blocks_of = sizes.select(F.col("lang").alias("its_lang"), n_blocks.alias("blocks")).distinct()
    left = counts.join(blocks_of, F.col("lang") == F.col("its_lang"))
    left = left.select("lang", "source", "term", "count", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"))
    right = sizes.select("lang", "source", "total", "kept", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks - 1)).alias("block"))
    sums = left.groupBy("lang", "block").cogroup(right.groupBy("lang", "block")).applyInArrow(block, "lang string, source string, item string, value long")
    # pairs of a language without kept terms have no block
    none = sizes.filter(F.col("kept") == 0).select("lang", "source")
    others = none.select(F.col("lang").alias("its_lang"), F.col("source").alias("item"))
    zeros = none.join(others, (F.col("lang") == F.col("its_lang")) & (F.col("source") != F.col("item")))
    every = sums.unionByName(zeros.select("lang", "source", "item", F.lit(0).cast("long").alias("value")))
    return every.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(documents: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """How the sources of ``documents`` (text, lang, source) differ: lang, source, part, item, value, rank.

    A row of ``documents`` is a document, repeated rows too; null text, lang and source are ''. Part ``pair`` compares
    each group (lang, source) with every other source of its language, over all kept terms. Part ``term`` has the
    group's terms that are more usual there than in the language, the ``top`` first. Other columns are left out. An
    empty table gives an empty result, and a language with one source or no kept term what is left of that.
    """
    counts, groups = kept_counts(documents, least)
    by_term = counts.groupBy(F.col("lang").alias("all_lang"), F.col("term").alias("all_term")).agg(F.sum("count").alias("all_count"))
    by_lang = by_term.groupBy("all_lang").agg(F.sum("all_count").alias("all_total"), F.count("*").alias("all_kept"))
    totals = counts.groupBy(F.col("lang").alias("its_lang"), F.col("source").alias("its_source")).agg(F.sum("count").alias("its_total"))
    number = groups.groupBy(F.col("lang").alias("number_lang")).agg(F.count("*").alias("n_sources"))
    sizes = (
        groups.join(totals, (F.col("lang") == F.col("its_lang")) & (F.col("source") == F.col("its_source")), "left")
        .join(by_lang, F.col("lang") == F.col("all_lang"), "left")
        .join(number, F.col("lang") == F.col("number_lang"))
        .select(
            "lang", "source", F.coalesce("its_total", F.lit(0)).alias("total"), F.coalesce("all_kept", F.lit(0)).alias("kept"),
            F.coalesce("all_total", F.lit(0)).alias("all_total"), "n_sources",
        )
    )
    sizes = written(sizes)
    within = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pairs(counts, sizes).select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(within).alias("rank"))

    of = sizes.select(F.col("lang").alias("its_lang"), F.col("source").alias("its_source"), "total", "kept", "all_total")
    terms = counts.join(of, (F.col("lang") == F.col("its_lang")) & (F.col("source") == F.col("its_source")))
    terms = terms.join(by_term, (F.col("lang") == F.col("all_lang")) & (F.col("term") == F.col("all_term")))
    p, q = share(F.col("count"), F.col("total"), F.col("kept")), share(F.col("all_count"), F.col("all_total"), F.col("kept"))
    terms = terms.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    terms = terms.select("lang", "source", F.lit("term").alias("part"), "item", distance(F.col("p"), F.col("q")).alias("value"))
    ranked = terms.withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= top)
    return pairs.unionByName(ranked)


SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
found AS (
  SELECT d, lang, source, unnest(w) AS term FROM docs),
groups AS (
  SELECT DISTINCT lang, source FROM docs),
kept AS (
  SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT d) >= {LEAST_DOCUMENTS}),
counts AS (
  SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (
  SELECT g.lang, g.source, coalesce(sum(n), 0) AS total, (SELECT count(*) FROM kept k WHERE k.lang = g.lang) AS v
  FROM groups g LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source),
shares AS (
  SELECT s.lang, s.source, k.term, coalesce(n, 0) AS n,
         1 + ({SCALE}::HUGEINT * (coalesce(n, 0) + 1)) // (s.total + s.v) AS p
  FROM sizes s JOIN kept k ON k.lang = s.lang
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
whole AS (
  SELECT lang, term, 1 + ({SCALE}::HUGEINT * (sum(n) + 1)) // (sum(sum(n)) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang)) AS q
  FROM shares GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, 0 FROM sizes a JOIN sizes b ON a.lang = b.lang AND a.source <> b.source WHERE a.v = 0),
terms AS (
  SELECT s.lang, s.source, 'term' AS part, s.term AS item, ((p - q) * (p - q)) // q AS value
  FROM shares s JOIN whole w ON w.lang = s.lang AND w.term = s.term WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
