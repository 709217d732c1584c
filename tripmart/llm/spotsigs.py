"""Document fingerprints of spot signatures.

A spot is an anchor, one of a few very common words, and the chain of content words that follow it: the next CHAIN
words that aren't common. Spots sit all over a text, but rarely in its boilerplate, so the set of their hashes is a
fingerprint whose Jaccard coefficient tells how alike two texts are. The start of a text is an anchor too, so every
text with a word has a spot.

Tables, lists and other languages have few anchors or none. So in a stretch without one that is longer than GAP words,
or than a SHARE-th of its text, each word is an anchor for the words right after it, common or not: no part of a text
that is long for it is left out of the fingerprint. Words end at ASCII marks and spaces; a script that writes neither
has words as long as its sentences.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm import components
from tripmart.llm.textbytes import U64, Block, Words, alphanumeric, blocks, mix, words
from tripmart.llm.tables import written

# Anchors, and words that don't count as content, for English, German, French and Spanish.
ANCHORS = "the of and to in is der die und das von de la le et les des que el en y los".split()
COMMON = (
    "a an and are as at be by for from has he in is it of on or that the this to was were will with "
    "als auf aus bei das dem den der des die ein eine er es im in ist mit nicht sich sie und von zu "
    "au aux avec ce dans de des du elle en est et il la le les ne pas pour que qui sur un une "
    "al como con del el en es la las lo los no para por que se su un una y"
).split()
CHAIN = 2
#: Stretches without an anchor of more than GAP words, or than the text's words divided by SHARE, are covered word by word.
GAP, SHARE = 32, 8
#: Texts are worked on in groups of about so many bytes.
GROUP_BYTES = 1 << 20
#: Ranges of doc_id are told apart by one expression of twice so many terms.
MOST_RANGES = 4000


def _hashes(names: list[str]) -> np.ndarray:
    column = pa.array([" ".join(names)])
    return np.unique(words(next(blocks(column)), alphanumeric()).hash)


class Spots:
    """Finds spots; one for each task."""

    def __init__(self, chain: int = CHAIN, anchors: list[str] = ANCHORS, common: list[str] = COMMON):
        self.chain, self.table = chain, alphanumeric()
        self.anchors, self.common = _hashes(anchors), _hashes(common + anchors)

    @staticmethod
    def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(known, values), len(known) - 1)
        return known[at] == values

    def _bare(self, found: Words, anchor: np.ndarray) -> np.ndarray:
        """Words in long stretches without an anchor that have a whole chain of words after them."""
        n, first, stop = len(anchor), found.bounds[:-1][found.row], found.bounds[1:][found.row]
        place = np.arange(n)
        last = np.maximum(np.maximum.accumulate(np.where(anchor, place, -1)), first - 1)
        following = np.minimum(np.minimum.accumulate(np.where(anchor, place, n)[::-1])[::-1], stop)
        most = np.minimum(GAP, (stop - first) // SHARE)
        return np.flatnonzero(~anchor & (following - last - 1 > most) & (place + self.chain < stop))

    def of(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Distinct 32-bit spot hashes of each text of a block, sorted by text, and the text of each."""
        found = words(block, self.table)
        if not len(found.hash):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        content = ~self._among(found.hash, self.common)
        before = np.concatenate([[0], np.cumsum(content)])  # content words before a word
        chain = found.hash[content]
        end = before[found.bounds[1:]][found.row]  # content words up to the end of a word's text
        start = np.zeros(len(found.hash), bool)
        start[found.bounds[:-1][np.diff(found.bounds) > 0]] = True
        anchor = self._among(found.hash, self.anchors)
        # an anchor needs a whole chain; a text's start takes its first words whatever they are
        anchor &= before[1:] + self.chain <= end
        at = np.flatnonzero(anchor)
        heads = np.flatnonzero(start)
        bare = self._bare(found, anchor)
        row = np.concatenate([found.row[at], found.row[heads], found.row[bare]])
        spot, head = found.hash[at], np.full(len(heads), 1, U64)
        for k in range(self.chain):
            spot = mix(spot + chain[before[1:][at] + k] + U64(k))
            there = heads + k < found.bounds[1:][found.row[heads]]
            head = mix(head + np.where(there, found.hash[np.minimum(heads + k, len(found.hash) - 1)], U64(0)) + U64(k))
        run = np.full(len(bare), 2, U64)
        for k in range(self.chain + 1):
            run = mix(run + found.hash[bare + k] + U64(k))
        value = (np.concatenate([spot, head, run]) >> U64(32)).astype(np.uint32)
        order = np.lexsort((value, row))
        value, row = value[order], row[order]
        fresh = np.ones(len(value), bool)
        fresh[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
        return value[fresh], row[fresh]

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """The spot hashes of each text, sorted."""
        out: list[np.ndarray] = []
        for block in blocks(pa.array(texts, pa.large_string())):
            value, row = self.of(block)
            out += np.split(value, np.searchsorted(row, np.arange(1, len(block))))
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard coefficient of two sorted sets; two empty ones are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def as_text(spots: np.ndarray) -> str:
    return base64.b64encode(spots.astype("<u4").tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def fingerprints(df: DataFrame) -> DataFrame:
    """doc_id and fingerprint of the texts of ``df`` (doc_id, text); a null text is empty, and its fingerprint too.

    A fingerprint is the base64 of the sorted 32-bit hashes of a text's spots. A row for each input row; other columns
    are left out.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spots = Spots()
        for batch in batches:
            for block in blocks(batch.column(1)):
                value, row = spots.of(block)
                sets = np.split(value, np.searchsorted(row, np.arange(1, len(block))))
                ids = batch.column(0).slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays([ids, pa.array([as_text(x) for x in sets])], ["doc_id", "fingerprint"])

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.select("doc_id", "text").mapInArrow(make, f"doc_id {kind}, fingerprint string")


def _in_ranges(df: DataFrame) -> tuple[DataFrame, int]:
    """Rows with ``range``, 0 for the largest doc_ids; the first row of the next range is also at the end of each.

    Ranges are cut at quantiles of doc_id. A null is below all. Rows: range, guard, doc_id, text.
    """
    spark = df.sparkSession
    count = min(MOST_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [k / count for k in range(1, count)]
    cuts = df.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] if shares else None
    cuts = sorted(set(cuts or []), reverse=True)
    number = F.when(F.col("doc_id").isNull(), len(cuts))
    # a binary search over the cuts, as nested conditions
    def search(low: int, high: int):
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col("doc_id") >= F.lit(cuts[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    ranged = df.withColumn("range", number.otherwise(search(0, len(cuts))).cast("int")).withColumn("guard", F.lit(False))
    tops = ranged.groupBy("range").agg(F.max(F.struct(F.coalesce("doc_id", F.lit(-(2**63))), F.col("doc_id").isNotNull())).alias("top"))
    tops = sorted((row["range"], row["top"][0], row["top"][1]) for row in tops.collect())
    if not tops:
        return ranged, count
    # one row a range: the range before it gets a copy of its first row, the last one that of the very first row
    owners = [(tops[k - 1][0], at, top if known else None) for k, (at, top, known) in enumerate(tops)]
    heads = spark.createDataFrame(owners, "owner int, its_range int, top long")
    first = (
        ranged.join(F.broadcast(heads), (F.col("range") == F.col("its_range")) & F.col("doc_id").eqNullSafe(F.col("top")))
        .groupBy("owner").agg(F.max(F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text"))).alias("head"))
        .select(F.col("head.doc_id").alias("doc_id"), F.col("head.text").alias("text"), F.col("owner").alias("range"), F.lit(True).alias("guard"))
    )
    return ranged.select("doc_id", "text", "range", "guard").unionByName(first), len(tops)


def edited(df: DataFrame, whole: bool = True) -> DataFrame:
    """Fingerprint the texts of ``df`` (doc_id, text) and their edited texts, whose last third is the next document's
    beginning: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and the edited
    text if ``whole``.

    The next document is the one with the next lower doc_id, after the last the first; of one doc_id the higher text
    comes first, a null id last. A null text is empty. One document alone is next to itself. A row for each input row.

    Only texts move, once, to ranges of doc_id, where documents that follow each other meet.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spots = Spots()
        held: list[tuple[int | None, str, bool]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            """Results of all held rows but the last, which waits for the one after it."""
            nonlocal held, size
            texts = [x[1] for x in held]
            changed = []
            for text, after in zip(texts, texts[1:]):
                cut = len(text) // 3
                changed.append(text[: len(text) - cut] + after[:cut])
            own, new = spots.sets(texts), spots.sets(changed)
            rows = [
                (held[k][0], len(texts[k]), hashlib.sha256(changed[k].encode()).hexdigest(), as_text(own[k]), as_text(new[k]))
                + (likeness(own[k], new[k]), likeness(own[k], own[k + 1]))
                + (changed[k],) * whole
                for k in range(len(changed))
                if not held[k][2]
            ]
            held, size = held[-1:], 0
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

        for batch in batches:
            for doc_id, text, guard in zip(*(batch.column(k) for k in range(3))):
                held.append((doc_id.as_py(), text.as_py() or "", guard.as_py()))
                size += len(held[-1][1])
                if size > GROUP_BYTES and len(held) > 1:
                    yield flush()
        if len(held) > 1:
            yield flush()

    fields = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string())]
    fields += [("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    schema = pa.schema(fields + [("edited_text", pa.string())] * whole)
    texts, count = _in_ranges(df.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    # rows of one range meet in one task; its guard comes last
    ordered = texts.repartition(max(1, count), "range").sortWithinPartitions("range", "guard", F.col("doc_id").desc_nulls_last(), F.col("text").desc_nulls_last())
    out = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.select("doc_id", "text", "guard").mapInArrow(make, out + ", edited_text string" * whole)


def near(df: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Documents alike by their spots: doc_id, component_id (the smallest doc_id that links lead to). Two fingerprints
    are linked if their Jaccard coefficient is ``threshold`` or more; empty ones are linked with nothing.

    Classes of equal fingerprints are compared, not copies. They are partitioned by set length: sets that are alike
    differ little in length, so a class meets its own and the next band only, and there those with which it shares one
    of its first few signatures. Pairs whose lengths alone rule the threshold out are dropped before they are compared.
    Each class is first compared with one other of each signature, then with those of other groups that it may be
    linked to, so the pairs within a group are not all made.
    """
    marks = written(fingerprints(df).withColumn("class", F.when(F.col("fingerprint") != "", F.xxhash64("fingerprint"))))
    classes = marks.filter(F.col("class").isNotNull()).groupBy("class")
    classes = written(classes.agg(F.min("doc_id").alias("least_id"), F.first("fingerprint").alias("fingerprint")))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for number, mark in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                spots = np.sort(mix(from_text(mark).astype(U64)))
                band = int(np.floor(np.log(len(spots)) / -np.log(threshold)))
                first = spots[: len(spots) - int(np.ceil(threshold * len(spots) - 1e-9)) + 1]
                for key in np.concatenate([mix(first + U64(band)), mix(first + U64(band + 1))]).view(np.int64).tolist():
                    rows.append((key, number, len(spots)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], ["key", "class", "n"])

    rows = written(classes.select("class", "fingerprint").mapInArrow(prefixes, "key long, class long, n long"))

    def fit(a: str, b: str):
        return (F.col(a) >= F.col(b) * threshold - 1e-9) & (F.col(b) >= F.col(a) * threshold - 1e-9)

    def verified(pairs: DataFrame) -> DataFrame:
        for name in ("a", "b"):
            pairs = pairs.join(classes.select(F.col("class").alias(name), F.col("fingerprint").alias(f"mark_{name}")), name)

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
                alike = pa.array([likeness(from_text(x), from_text(y)) >= threshold - 1e-9 for x, y in both], pa.bool_())
                yield batch.select(["a", "b"]).filter(alike)

        return written(pairs.select("a", "b", "mark_a", "mark_b").mapInArrow(check, "a long, b long"))

    centre = rows.groupBy(F.col("key").alias("its_key")).agg(F.min(F.struct("class", "n")).alias("first"))
    star = rows.join(centre, F.col("key") == F.col("its_key")).filter((F.col("class") != F.col("first.class")) & fit("n", "first.n"))
    label = components.labels(verified(star.select(F.col("class").alias("a"), F.col("first.class").alias("b")).distinct()))
    labelled = rows.join(label, F.col("class") == F.col("node"), "left").withColumn("label", F.coalesce("label", "class"))
    left = labelled.select("key", F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("label").alias("label_a"))
    right = labelled.select("key", F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("label").alias("label_b"))
    cross = left.join(right, "key").filter((F.col("label_a") != F.col("label_b")) & (F.col("a") < F.col("b")) & fit("n_a", "n_b"))
    more = verified(cross.select("a", "b").distinct())
    label = components.labels(label.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more))
    grouped = classes.join(label, F.col("class") == F.col("node"), "left").withColumn("label", F.coalesce("label", "class"))
    least = grouped.groupBy("label").agg(F.min("least_id").alias("component_id"))
    groups = grouped.join(least, "label").select(F.col("class").alias("its_class"), "component_id")
    joined = marks.join(groups, F.col("class") == F.col("its_class"), "left")
    return joined.select("doc_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
