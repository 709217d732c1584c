"""Texts with alike sets of word shingles, by a join on parity sketches.

A parity sketch has a bit for each place a shingle's hash can point to, and each shingle of a set flips its bit. The
bits that differ between the sketches of two sets are at most the shingles that only one of them has. For sets of about
one size, the Jaccard threshold bounds those by a number k. So if the sketch is cut into more than k blocks, two alike
sets have a block in which they don't differ: the pigeonhole principle. With some blocks more, they have several, so a
set can leave out its most usual ones but for one less than those. Blocks are joined by their contents, once for each
band of sizes and once for each border between two, and what meets there is verified: by the Hamming distance of short
sketches, which are longer for larger sets, and then by the sets.

Sets that are equal are one class from the start. Of the classes that share blocks, each is first compared with a few
of them, which finds most groups. What is left, classes that share a block but no group, is compared pair by pair. So
the pairs within a group are not all made, and no link between two groups is missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm import components
from tripmart.llm.tables import written
from tripmart.llm.textbytes import U64, blocks, mix, shingle_sets, space_split, words
from tripmart.llm.workers import task

#: Longs of a short sketch, for small sets and at most. Between, it has BITS_APART bits or more for each shingle that one
#: of two alike sets can have alone: with few, sets that are far from alike seem alike.
SKETCH, LONGEST_SKETCH = 8, 128
BITS_APART = 4
#: Keys that are remembered have a bit each in a map of at least so many bits a key, and of 2**LEAST_BITS to 2**MOST_BITS
#: in all. Where two fall on one bit, more rows are joined; none is missed.
BITS_A_KEY, LEAST_BITS, MOST_BITS = 12, 20, 30
#: If more pairs a row are left to compare, classes are compared with the first of their blocks again, so often at most.
PAIRS_A_ROW, MORE_STARS = 4, 1
#: Keys that are looked through at once for those that come again.
SEGMENT_KEYS = 1 << 22


@dataclass(frozen=True)
class Threshold:
    """Sets are alike if ``whole`` times what they share is at least ``part`` times what they have in all."""

    part: int
    whole: int

    def __post_init__(self):
        if not 0 < self.part <= self.whole <= 2 * self.part:
            raise ValueError("the threshold is from a half to one")

    def most_apart(self, sizes: int) -> int:
        """How many shingles one of two alike sets, with ``sizes`` in all, can have alone."""
        return sizes * (self.whole - self.part) // (self.whole + self.part)

    def block_counts(self, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For the sizes of some sets: band numbers, block counts (0: none), and the most that a set of that size and
        one there that is alike differ.

        Band 2 j has sizes above half of 2**j up to it; band 2 j + 1 has those at both sides of 2**j that can be alike.
        """
        top = np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64)
        for shift, border in ((0, False), (0, True), (-1, True)):
            edge = 1 << np.maximum(top + shift, 0)
            if not border:
                largest, there = edge, size > 0
                apart = self.most_apart(2 * edge)
            else:
                largest = edge * self.whole // self.part
                apart = self.most_apart(edge + largest)
                below = (size <= edge) & (size * self.whole > self.part * edge)
                above = (size > edge) & (size * self.part <= self.whole * edge)
                there = (size > 0) & (top + shift >= 0) & (below if shift == 0 else above)
            # some blocks more than needed, as those without any shingle are of no use
            count = np.where(there, apart + 1 + np.maximum(2, apart // 4), 0)
            own = self.most_apart(size + np.minimum(size * self.whole // self.part, largest))
            yield 2 * (top + shift) + border, count, np.minimum(own, apart)


def block_keys(value: np.ndarray, bounds: np.ndarray, threshold: Threshold) -> tuple[np.ndarray, ...]:
    """Keys of the blocks of each set's sketch, the number of the set, the band, and how many keys the set can spare in
    it. ``value`` and ``bounds`` as of shingle_sets.

    The sketch of a band has a range of 64-bit hashes in each block, so a block's set bits are its shingles' hashes,
    and their exclusive or stands for them. A block with none has a key only if a set could have no other block in
    common with one that is alike.

    Alike sets have ``count - apart`` blocks in common, by the smaller ``apart`` of the two, so at least as many keys as
    those are more than either's empty blocks. If each leaves out the last of its keys in an order of all keys, one
    fewer than that by its own ``apart``, the first key that they have in common stays in both.
    """
    size = np.diff(bounds)
    row = np.repeat(np.arange(len(size)), size)
    keys, owners, bands, spares = [], [], [], []
    for band, count, apart in threshold.block_counts(size):
        used = np.flatnonzero(count[row] > 0)
        if not len(used):
            continue
        hashes, owner = value[used], row[used]
        # hashes of a set are in order, and so are their blocks
        block = ((hashes >> U64(32)) * count[owner].astype(U64)) >> U64(32)
        fresh = np.ones(len(used), bool)
        fresh[1:] = (block[1:] != block[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(fresh)
        content = np.bitwise_xor.reduceat(mix(hashes), at)
        place = mix(block[at] + (band[owner[at]].astype(U64) << U64(40)))
        keys.append(mix(content ^ place))
        owners.append(owner[at])
        filled = np.bincount(owner[at], minlength=len(size))
        spare = np.maximum(filled - apart - 1, 0)
        bands.append(band[owner[at]])
        spares.append(spare[owner[at]])
        for k in np.flatnonzero((count > 0) & (count - filled >= count - apart)):
            empty = np.setdiff1d(np.arange(count[k], dtype=U64), block[at][owner[at] == k])
            keys.append(mix(mix(empty + (U64(band[k]) << U64(40)))))
            owners.append(np.full(len(empty), k))
            bands.append(np.full(len(empty), band[k]))
            spares.append(np.zeros(len(empty), np.int64))
    if not keys:
        return np.empty(0, U64), *[np.empty(0, np.int64)] * 3
    return tuple(np.concatenate(x) for x in (keys, owners, bands, spares))


def set_hashes(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set, 0 for empty ones. Two sets of one hash are taken as equal: at 10**10 different sets
    that befalls about three pairs."""
    out = np.zeros(len(bounds) - 1, U64)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        sums = np.add.reduceat(mix(value ^ U64(0x5851F42D4C957F2D)), bounds[full])
        out[full] = np.maximum(mix(sums + np.diff(bounds)[full].astype(U64)), U64(1))
    return out


def short_sketches(value: np.ndarray, bounds: np.ndarray, threshold: Threshold) -> pa.ListArray:
    """Parity sketches: for each set a list of longs, a power of two of them by the set's size. Sets of which one is at
    most twice as large as the other have sketches of one length or of twice the other's."""
    size = np.diff(bounds)
    a_shingle = BITS_APART * 2 * (threshold.whole - threshold.part) / (threshold.whole + threshold.part) / 64
    top = np.ceil(np.log2(np.maximum(size, 1))) + (np.ceil(np.log2(a_shingle)) if a_shingle else 0)
    longs = np.clip(2.0**top, SKETCH, LONGEST_SKETCH).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(longs)])
    row = np.repeat(np.arange(len(size)), size)
    bit = (mix(value + U64(0x2545F4914F6CDD1D)) % (64 * longs[row]).astype(U64)).astype(np.int64)
    odd = (np.bincount(64 * ends[row] + bit, minlength=64 * ends[-1]) & 1).astype(np.uint8)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.packbits(odd, bitorder="little").view(np.int64)))


def _over_sets(df: DataFrame, width: int, make: Callable, schema: str) -> DataFrame:
    """Rows that ``make(rows, value, bounds, classes, memory)`` gives as a dict of columns for blocks of texts, the
    second column of ``df``. ``memory`` is a set that lasts for an Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = space_split()
        for batch in batches:
            memory: set[int] = set()
            for block in blocks(batch.column(1)):
                value, bounds = shingle_sets(words(block, table), width)
                rows = batch.slice(block.first, len(block))
                made = make(rows, value, bounds, set_hashes(value, bounds).view(np.int64), memory)
                if made:
                    yield pa.RecordBatch.from_pydict(made)

    return df.mapInArrow(task(run), schema)


def _sketched(df: DataFrame, width: int, threshold: Threshold, hashed: bool) -> DataFrame:
    """doc_id, class (null for an empty set), n_shingles, sketch, and the text's hash if asked for."""

    def make(rows, value, bounds, classes, _):
        columns = {"doc_id": rows.column(0), "class": pa.array(classes, mask=classes == 0), "n_shingles": np.diff(bounds)}
        columns["sketch"] = short_sketches(value, bounds, threshold)
        return columns | ({"text_hash": rows.column(2)} if hashed else {})

    kind = df.schema["doc_id"].dataType.simpleString()
    texts = df.select("doc_id", "text", *[F.xxhash64("text").alias("text_hash")] * hashed)
    return _over_sets(texts, width, make, f"doc_id {kind}, class long, n_shingles long, sketch array<long>{', text_hash long' * hashed}")


def _new(classes: np.ndarray, memory: set[int]) -> np.ndarray:
    """Numbers of the sets that aren't empty and whose class the batch hasn't had: copies needn't all be told."""
    first = [k for k, c in enumerate(classes.tolist()) if c and not (c in memory or memory.add(c))]
    return np.array(first, np.int64)


def _chosen(value: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kept = np.zeros(len(bounds) - 1, bool)
    kept[which] = True
    size = np.diff(bounds)
    return value[np.repeat(kept, size)], np.concatenate([[0], np.cumsum(size[kept])])


def _map_bits(keys: int) -> int:
    """Logarithm of the size of a map for so many keys."""
    return min(max((keys * BITS_A_KEY).bit_length(), LEAST_BITS), MOST_BITS)


def _bit_map(keys: DataFrame, bits: int) -> np.ndarray:
    """Bits of the keys (a column ``key``) by their leading bits: at most 2**bits / 8 bytes come to the driver."""
    place = F.shiftrightunsigned("key", 64 - bits)
    rows = keys.select(F.shiftright(place, 15).alias("part"), place.bitwiseAND(F.lit(32767)).alias("bit"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in rows.groupBy("part").agg(F.expr("bitmap_construct_agg(bit)").alias("bits")).collect():
        out[row["part"] * 4096 : (row["part"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return out


def _in_map(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys.view(U64) >> U64(64 - (len(table) * 8).bit_length() + 1)
    return (table[(place >> U64(3)).astype(np.int64)] >> (place & U64(7)).astype(np.uint8)) & 1 > 0


def _repeated_keys(df: DataFrame, width: int, threshold: Threshold, expected: int) -> DataFrame:
    """Leading bits of the block keys that come more than once, in the place of the key: a column ``key``.

    Most keys come once, and are not worth a row. A task packs the 32 bits after those that tell the segment, sorted,
    so that a key takes four bytes on its way; a segment's are sorted together, and what comes again is seen. Keys that
    only begin alike are taken as one that comes again, which costs some rows and loses none. ``expected`` keys set the
    number of segments, so that each stays within memory; a batch hands on a key twice at most.
    """
    bits = max(6, (expected // SEGMENT_KEYS).bit_length())

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = space_split()
        for batch in batches:
            memory: set[int] = set()
            found = []
            for block in blocks(batch.column(0)):
                value, bounds = shingle_sets(words(block, table), width)
                which = _new(set_hashes(value, bounds).view(np.int64), memory)
                if len(which):
                    found.append(block_keys(*_chosen(value, bounds, which), threshold)[0] >> U64(32 - bits))
            if not found:
                continue
            lead = np.sort(np.concatenate(found))
            kept = np.ones(len(lead), bool)
            kept[2:] = lead[2:] != lead[:-2]
            lead = lead[kept]
            ends = np.searchsorted(lead, np.arange((1 << bits) + 1, dtype=U64) << U64(32))
            some = np.flatnonzero(np.diff(ends))
            packed = lead.astype("<u4")
            rows = [packed[ends[k] : ends[k + 1]].tobytes() for k in some]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(rows, pa.binary())], ["segment", "keys"])

    def repeated(table: pa.Table) -> pa.Table:
        low = np.sort(np.frombuffer(b"".join(table.column("keys").to_pylist()), "<u4"))
        again = np.unique(low[1:][low[1:] == low[:-1]]).astype(U64)
        segment = U64(table.column("segment")[0].as_py())
        return pa.table({"key": ((segment << U64(32) | again) << U64(32 - bits)).view(np.int64)})

    return df.select("text").mapInArrow(task(spread), "segment int, keys binary").groupBy("segment").applyInArrow(repeated, "key long")


def _block_rows(df: DataFrame, width: int, threshold: Threshold, only=None) -> DataFrame:
    """key, class, band and spare of the blocks of all sets, or of those whose key is in a broadcast bit map."""

    def make(_, value, bounds, classes, memory):
        which = _new(classes, memory)
        if not len(which):
            return None
        key, owner, band, spare = block_keys(*_chosen(value, bounds, which), threshold)
        owner = classes[which][owner]
        if only is not None:
            kept = _in_map(only.value, key)
            key, owner, band, spare = key[kept], owner[kept], band[kept], spare[kept]
        return {"key": key.view(np.int64), "class": owner, "band": band.astype(np.int32), "spare": spare.astype(np.int32)}

    return _over_sets(df.select("doc_id", "text"), width, make, "key long, class long, band int, spare int")


def _shared_blocks(rows: DataFrame) -> DataFrame:
    """key and class of the blocks that several classes have, but for the most usual that a class can spare.

    What many texts have, such as a line or passage, is in the blocks that most classes share; those are left out where
    alike classes share others too. All classes order their keys alike, as ``block_keys`` asks for.
    """
    several = rows.groupBy(F.col("key").alias("its_key")).agg(F.count("*").alias("n")).filter("n > 1")
    most_usual = Window.partitionBy("class", "band").orderBy(F.desc("n"), F.desc("key"))
    shared = rows.join(several, F.col("key") == F.col("its_key")).withColumn("place", F.row_number().over(most_usual))
    return shared.filter(F.col("place") > F.col("spare")).select("key", "class")


def _texts(df: DataFrame, width: int, only) -> DataFrame:
    """class and text of the sets whose class is in a broadcast bit map, one for each class.

    Texts take less room on their way than sets, whose hashes cannot be compressed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = space_split()
        for batch in batches:
            memory: set[int] = set()
            for block in blocks(batch.column(0)):
                value, bounds = shingle_sets(words(block, table), width)
                classes = set_hashes(value, bounds).view(np.int64)
                which = _new(classes, memory)
                which = which[_in_map(only.value, classes[which])] if len(which) else which
                if len(which):
                    texts = batch.column(0).take(pa.array(which + block.first))
                    yield pa.RecordBatch.from_arrays([pa.array(classes[which]), texts], ["class", "text"])

    found = df.select("text").mapInArrow(task(run), "class long, text string")
    return found.groupBy("class").agg(F.first("text").alias("text"))


def _may_be_alike(a: str, b: str, threshold: Threshold) -> Column:
    """Sizes and short sketches of two classes, aliased so, allow that they are alike."""
    n, m, x, y = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles"), F.col(f"{a}.sketch"), F.col(f"{b}.sketch")
    length = F.least(F.size(x), F.size(y))

    def folded(sketch: Column) -> Column:
        # bits of a sketch twice as long, each with the one that shares its place in a short one
        return F.when(F.size(sketch) == length, sketch).otherwise(
            F.zip_with(F.slice(sketch, 1, length), F.slice(sketch, length + 1, length), lambda p, q: p.bitwiseXOR(q))
        )

    differ = F.zip_with(folded(x), folded(y), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    apart = F.aggregate(differ, F.lit(0), lambda total, bits: total + bits)
    fits = F.least(n, m) * threshold.whole >= F.greatest(n, m) * threshold.part
    return fits & (apart * (threshold.whole + threshold.part) <= (n + m) * (threshold.whole - threshold.part))


def _verified(df: DataFrame, pairs: DataFrame, width: int, threshold: Threshold) -> DataFrame:
    """The pairs (a, b) of classes of ``df`` that are alike. ``pairs`` is a written table."""
    spark = df.sparkSession
    named = written(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct())
    only = spark.sparkContext.broadcast(_bit_map(named, _map_bits(named.count())))
    texts = written(_texts(df, width, only))
    for name in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("class").alias(name), F.col("text").alias(f"text_{name}")), name)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = space_split()

        def sets(column: pa.Array) -> Iterator[np.ndarray]:
            for block in blocks(column):
                value, bounds = shingle_sets(words(block, table), width)
                yield from (value[x:y] for x, y in zip(bounds, bounds[1:]))

        for batch in batches:
            alike = []
            for a, b in zip(sets(batch.column(2)), sets(batch.column(3))):
                both = len(np.intersect1d(a, b, assume_unique=True))
                alike.append(threshold.whole * both >= threshold.part * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    return written(pairs.select("a", "b", "text_a", "text_b").mapInArrow(task(check), "a long, b long"))


def _star_pairs(shared: DataFrame, classes: DataFrame, threshold: Threshold, turn: Column) -> DataFrame:
    """Each class with the first of its block: pairs (a, b) that have different labels and may be alike.

    ``turn``, by the key, sets the order. The first of a block is a minimum, which is summed up on the map side, and a
    block with many classes is a skewed key of a join, which Spark can split.
    """
    first = shared.groupBy(F.col("key").alias("its_key")).agg(F.min(F.col("class").bitwiseXOR(turn)).alias("first"))
    pairs = shared.join(first, F.col("key") == F.col("its_key"))
    centre = F.col("first").bitwiseXOR(turn)
    pairs = pairs.select(F.least("class", centre).alias("a"), F.greatest("class", centre).alias("b"))
    pairs = pairs.filter(F.col("a") != F.col("b")).distinct()
    joined = pairs.join(classes.alias("x"), F.col("a") == F.col("x.class")).join(classes.alias("y"), F.col("b") == F.col("y.class"))
    return joined.filter((F.col("x.label") != F.col("y.label")) & _may_be_alike("x", "y", threshold)).select("a", "b")


def _mixed(shared: DataFrame, label: DataFrame) -> tuple[DataFrame, int, int]:
    """key, class and label of the blocks with several labels; how many rows, and pairs of different labels, they have."""
    rows = _with_label(shared, label)
    of_label = rows.groupBy(F.col("key").alias("its_key"), "label").agg(F.count("*").alias("n"))
    several = of_label.groupBy("its_key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("square"))
    several = written(several.filter(F.col("n") * F.col("n") > F.col("square")))
    sums = several.agg(F.sum("n"), F.sum(F.col("n") * F.col("n") - F.col("square"))).first()
    rows = written(rows.join(several.select("its_key"), F.col("key") == F.col("its_key")).select("key", "class", "label"))
    return rows, sums[0] or 0, (sums[1] or 0) // 2


def _with_label(rows: DataFrame, label: DataFrame) -> DataFrame:
    """Rows with the label of their class, itself if it is in no group yet."""
    label = label.select(F.col("node"), "label")
    return rows.join(label, F.col("class") == F.col("node"), "left").withColumn("label", F.coalesce("label", "class")).drop("node")


def _cross_pairs(mixed: DataFrame, classes: DataFrame, threshold: Threshold) -> DataFrame:
    """Pairs (a, b) of classes that share a block, have different labels, and may be alike."""
    # both sides are the same rows, so that they move once
    rows = mixed.join(classes, "class").select("key", "label", "class", "n_shingles", "sketch")
    met = rows.alias("x").join(
        rows.alias("y"),
        (F.col("x.key") == F.col("y.key")) & (F.col("x.label") != F.col("y.label")) & (F.col("x.class") < F.col("y.class"))
        & _may_be_alike("x", "y", threshold),
    )
    return met.select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct()


def _grouped(df: DataFrame, width: int, threshold: Threshold, hashed: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows with their class, and classes with their group: its_class, label, component_id."""
    spark = df.sparkSession
    members = written(_sketched(df, width, threshold, hashed))
    classes = members.filter(F.col("class").isNotNull()).groupBy("class")
    classes = written(classes.agg(F.min("doc_id").alias("least_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")))

    # blocks that more than one row has, as bits; then the rows of those. A set has up to some two blocks a shingle
    expected = 2 * (members.agg(F.sum("n_shingles")).first()[0] or 0)
    twice = written(_repeated_keys(df, width, threshold, expected))
    known = spark.sparkContext.broadcast(_bit_map(twice, _map_bits(twice.count())))
    rows = written(_block_rows(df, width, threshold, known).distinct())
    shared = written(_shared_blocks(rows))
    sketches = written(classes.select("class", "n_shingles", "sketch").join(shared.select("class").distinct(), "class", "left_semi"))

    def joined(label: DataFrame, pairs: DataFrame) -> DataFrame:
        more = _verified(df, pairs, width, threshold)
        return components.labels(label.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more))

    # a class meets the first of its blocks by one of four orders, so that few are first
    alone = sketches.withColumn("label", F.col("class"))
    stars = written(_star_pairs(shared, alone, threshold, F.shiftleft("key", 62)))
    label = components.labels(_verified(df, stars, width, threshold))
    mixed, rows, pairs = _mixed(shared, label)
    for _ in range(MORE_STARS):
        if pairs <= PAIRS_A_ROW * rows:
            break
        # many are left: each meets others, a first of each of its blocks by an order of the block's own
        stars = written(_star_pairs(mixed, _with_label(sketches, label), threshold, F.xxhash64("key")))
        label = joined(label, stars)
        mixed, rows, pairs = _mixed(mixed.select("key", "class"), label)
    left = written(_cross_pairs(mixed, sketches, threshold))
    if not left.isEmpty():
        label = joined(label, left)

    labelled = classes.join(label, F.col("class") == F.col("node"), "left").withColumn("label", F.coalesce("label", "class"))
    smallest = labelled.groupBy("label").agg(F.min("least_id").alias("component_id"))
    return members, labelled.select(F.col("class").alias("its_class"), "label").join(smallest, "label").select("its_class", "label", "component_id")


def join(df: DataFrame, width: int = 5, threshold: Threshold = Threshold(80, 100)) -> DataFrame:
    """Groups of alike texts in ``df`` (doc_id, text): doc_id, n_shingles, component_id.

    Words are runs of anything but ASCII white space, A-Z as a-z; a text's set has its distinct runs of ``width`` words,
    or its whole sequence if it has fewer. Texts whose sets are alike are linked, and component_id is the smallest
    doc_id that links lead to, the row's own included. A text without words, or null, is linked with nothing. A row for
    each input row; rows with one doc_id and text are copies of each other, and rows without doc_id link like others
    but give no component_id. Other columns are left out.
    """
    members, groups = _grouped(df, width, threshold)
    groups = groups.select("its_class", "component_id")
    joined = members.select("doc_id", "class", "n_shingles").join(groups, F.col("class") == F.col("its_class"), "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))


def keep_one(df: DataFrame, width: int = 5, threshold: Threshold = Threshold(80, 100)) -> DataFrame:
    """The rows of ``df``, all columns, but of each group only one: that with the smallest doc_id, and of several texts
    of that id the one with the lowest hash.

    Groups are of rows, not of ids: of an id with several texts each goes by its own group. Of rows that are the same in
    doc_id and text one stays. Rows without doc_id stay, and so do texts without words.
    """
    members, groups = _grouped(df, width, threshold, hashed=True)
    rows = members.filter(F.col("doc_id").isNotNull()).select("doc_id", "text_hash", "class")
    rows = written(rows.join(groups.select("its_class", "label"), F.col("class") == F.col("its_class"), "left"))
    grouped = rows.filter(F.col("label").isNotNull()).select("label", F.struct("doc_id", "text_hash").alias("row"))
    best = grouped.groupBy(F.col("label").alias("its_label")).agg(F.min("row").alias("best"))
    leave = grouped.join(best, F.col("label") == F.col("its_label")).filter(F.col("row") != F.col("best"))
    leave = leave.select(F.col("row.doc_id").alias("left_id"), F.col("row.text_hash").alias("left_hash")).distinct()
    kept = df.join(leave, (F.col("doc_id") == F.col("left_id")) & (F.xxhash64("text") == F.col("left_hash")), "left_anti")
    again = rows.groupBy(F.col("doc_id").alias("again_id"), F.col("text_hash").alias("again_hash")).agg(F.count("*").alias("n"))
    again = written(again.filter("n > 1").select("again_id", "again_hash"))
    if again.isEmpty():
        return kept
    # rows that are there several times are few or none in a sound table; only they are gathered
    same = (F.col("doc_id") == F.col("again_id")) & (F.xxhash64("text") == F.col("again_hash"))
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    repeated = kept.join(again, same).groupBy("again_id", "again_hash").agg(F.min_by(whole, F.to_json(whole)).alias("whole"))
    return kept.join(again, same, "left_anti").unionByName(repeated.select("whole.*"))


def sql(width: int, threshold: Threshold) -> str:
    """DuckDB SQL for ``join`` over ``documents``: all pairs of classes that share a shingle are counted."""
    places = f"CASE WHEN len(w) >= {width} THEN range(len(w) - {width - 1}) WHEN len(w) > 0 THEN range(1) ELSE range(0) END"
    return f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(list_transform({places}, lambda i: array_to_string(w[i + 1 : i + {width}], ' ')))) AS s
  FROM docs),
classes AS (
  SELECT s, len(s) AS n, min(doc_id) AS id FROM sets WHERE len(s) > 0 GROUP BY s),
shingles AS (
  SELECT id, n, unnest(s) AS sh FROM classes),
links AS (
  SELECT a.id AS x, b.id AS y FROM shingles a JOIN shingles b ON a.sh = b.sh AND a.id <> b.id
  GROUP BY a.id, b.id, a.n, b.n HAVING {threshold.whole} * count(*) >= {threshold.part} * (a.n + b.n - count(*))),
reach(x, y) AS (
  SELECT id, id FROM classes
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
least AS (
  SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT sets.doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(component_id, sets.doc_id) AS component_id
FROM sets LEFT JOIN classes ON classes.s = sets.s LEFT JOIN least ON least.x = classes.id
"""
