"""The prefix trie of conversations, from sorted sequences and range minima.

Conversations are rows of turn hashes. Sorted, those that begin with the same turns follow each other, and the length
of the common prefix of each two neighbours (LCP) tells how far they agree. The members of a prefix of d turns are the
rows around it between which no LCP is below d. A sparse table of range minima over the LCPs gives that interval for
each candidate prefix by itself, by a binary search to the left and one to the right: no stack, no order among
candidates, all of them at once in numpy. Sums over intervals are differences of running sums.

Neither one long conversation nor one usual beginning may fill a task. So a conversation is cut into chunks of CHUNK
turns. A chunk is sorted within the trie of those that have the same turns before it, and all tries are sorted in one
order, which is dealt to parts of bounded size wherever it falls. Prefixes whose interval runs over the border of a part
are counted in each part and added up by their key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.tables import written

#: Turns to a chunk, and turns to a part of the sorted order.
CHUNK, PART_TURNS = 64, 400_000
#: Bytes of a turn's hash.
TOKEN = 16
#: A conversation takes its first turns, at most MOST_SHARED, from the first of its FAMILY.
FAMILY, MOST_SHARED = 100, 5


# Sequences ------------------------------------------------------------------------------------------------------


def placed_turns(conversations: DataFrame) -> DataFrame:
    """conv, pos (from 1), token (a hash of role and text), size (code points of the text). Written.

    Turns are numbered in ranges of the whole order: a conversation of any length is spread over tasks, each of which
    numbers what it has, and gets the numbers before that from the counts by task.
    """
    role, text = (F.coalesce(conversations[x], F.lit("")) for x in ("role", "text"))
    token = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.select(
        conversations["conv_id"].cast("long").alias("conv"), conversations["turn"].alias("turn"), token.alias("token"), F.length(text).cast("long").alias("size")
    ).filter(F.col("conv").isNotNull())
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("token")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ranged = written(ranged.select("conv", "token", "size", "at", F.shiftright("at", 33).alias("task")))
    runs = ranged.groupBy(F.col("conv").alias("its_conv"), F.col("task").alias("its_task")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("its_conv").orderBy("its_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    placed = ranged.join(runs, (F.col("conv") == F.col("its_conv")) & (F.col("task") == F.col("its_task")))
    return written(placed.select("conv", (F.col("at") - F.col("first") + F.col("before") + 1).alias("pos"), "token", "size"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of rebuilt conversations (conv, pos, token, size), and all conversations (conv). See ``trie``."""
    placed = placed_turns(conversations)
    one = F.struct("pos", "token", "size")
    heads = placed.filter(F.col("pos") <= MOST_SHARED).groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(one)).alias("head"))
    convs = placed.select("conv").distinct().withColumn("h", (F.crc32(F.col("conv").cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int"))
    convs = convs.withColumn("its_base", F.col("conv") - F.col("conv") % FAMILY).join(heads, F.col("its_base") == F.col("base"), "left")
    convs = convs.select("conv", "h", F.when(F.col("h") > 0, F.slice("head", 1, F.greatest("h", F.lit(1)))).alias("taken"))
    convs = written(convs.withColumn("n_taken", F.coalesce(F.array_size("taken"), F.lit(0))))
    shared = convs.select("conv", F.inline("taken"))
    known = convs.select(F.col("conv").alias("its_conv"), "h", "n_taken")
    own = placed.join(known, F.col("conv") == F.col("its_conv")).filter(F.col("pos") > F.col("h"))
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("n_taken")).alias("pos"), "token", "size")
    return shared.unionByName(own), convs.select("conv")


def chunked(turns: DataFrame, chunk: int) -> DataFrame:
    """Rows of ``chunk`` turns at most: conv, k, path (their hashes), sizes, p1 and p2 (hash of all turns before), q1 and
    q2 (with its own), after (code points after it), last."""
    k = F.floor((F.col("pos") - 1) / chunk).cast("long")
    rows = turns.groupBy("conv", k.alias("k")).agg(F.sort_array(F.collect_list(F.struct("pos", "token", "size"))).alias("turns"))
    rows = rows.select(
        "conv", "k",
        F.aggregate("turns", F.lit(b""), lambda x, turn: F.concat(x, turn["token"])).alias("path"),
        F.transform("turns", lambda turn: turn["size"]).alias("sizes"),
    )
    rows = rows.withColumn("x1", F.xxhash64("k", "path")).withColumn("x2", F.xxhash64("path", "k"))
    order = Window.partitionBy("conv").orderBy("k")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    text = F.aggregate("sizes", F.lit(0).cast("long"), lambda x, size: x + size)
    rows = rows.withColumn("text", text).select(
        "conv", "k", "path", "sizes", "x1", "x2",
        *(F.coalesce(F.bit_xor(f"x{i}").over(before), F.lit(0)).alias(f"p{i}") for i in (1, 2)),
        F.coalesce(F.sum("text").over(after), F.lit(0)).alias("after"),
        F.lead("k").over(order).isNull().alias("last"),
    )
    return rows.select("conv", "k", "path", "sizes", "p1", "p2", *(F.col(f"p{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"q{i}") for i in (1, 2)), "after", "last")


def ends_of(chunks: DataFrame, convs: DataFrame) -> DataFrame:
    """SHA-256 of the ids of conversations that are the same to the end: e1, e2, ends_sha256. Those without turns have
    e1 and e2 null.

    A digest takes its input in one order, so a class's ids pass through one task, one after the other; none are held.
    """
    full = chunks.filter("last").select(F.col("conv").alias("its_conv"), F.col("q1").alias("e1"), F.col("q2").alias("e2"))
    rows = convs.join(full, F.col("conv") == F.col("its_conv"), "left").select("e1", "e2", "conv")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([state.hexdigest()])], ["e1", "e2", "ends_sha256"])

        for batch in batches:
            done = [[], [], []]
            for e1, e2, conv in zip(*(x.to_pylist() for x in batch.columns)):
                if state is None or key != (e1, e2):
                    if state is not None:
                        for column, value in zip(done, (*key, state.hexdigest())):
                            column.append(value)
                    key, state = (e1, e2), hashlib.sha256(b"%d" % conv)
                else:
                    state.update(b",%d" % conv)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(done, (pa.int64(), pa.int64(), pa.string()))], ["e1", "e2", "ends_sha256"])
        if state is not None:
            yield row()

    return rows.repartition("e1", "e2").sortWithinPartitions("e1", "e2", "conv").mapInArrow(digest, "e1 long, e2 long, ends_sha256 string")


# Intervals ------------------------------------------------------------------------------------------------------


class RangeMinimum:
    """Sparse table: minima of all ranges whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minima of the ranges from ``first`` to ``last``, both within."""
        level = np.frexp((last - first + 1).astype(float))[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.levels[k][first[at]], self.levels[k][last[at] + 1 - (1 << k)])
        return out

    def extents(self, at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row ``at`` the first and last row that can be reached over values of ``depth`` or more, where value
        k lies between the rows k - 1 and k."""
        left, right, n = at.copy(), at.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            step, table = 1 << k, self.levels[k]
            may = np.flatnonzero(right + step < n)
            right[may[table[right[may] + 1] >= depth[may]]] += step
            may = np.flatnonzero(left - step >= 0)
            left[may[table[left[may] - step + 1] >= depth[may]]] -= step
        return left, right


class Part:
    """Sorted chunks of a part, their LCPs with the chunk before, and what is new in each."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("at").combine_chunks()
        get = lambda name: table.column(name).to_numpy()
        self.k, self.p1, self.p2, self.n = get("k"), get("p1"), get("p2"), get("n")
        self.table, self.rows = table, table.num_rows
        self.paths = table.column("path").to_pylist()
        self.length = np.array([len(x) for x in self.paths]) // TOKEN
        self.begin = np.concatenate([[0], np.cumsum(self.length)])
        tokens = np.frombuffer(b"".join(self.paths), "<u8").reshape(-1, 2)
        sizes = np.array([x for row in table.column("sizes").to_pylist() for x in row], np.int64)
        #: Code points before each turn of all rows, and after the last.
        self.before = np.concatenate([[0], np.cumsum(sizes)])
        self.lcp = np.zeros(self.rows, np.int64)
        trie = (self.k[1:] == self.k[:-1]) & (self.p1[1:] == self.p1[:-1]) & (self.p2[1:] == self.p2[:-1])
        both = np.where(trie, np.minimum(self.length[1:], self.length[:-1]), 0)
        row = np.repeat(np.arange(1, self.rows), both)
        turn = np.arange(len(row)) - np.repeat(np.cumsum(both) - both, both)
        differ = np.flatnonzero((tokens[self.begin[row] + turn] != tokens[self.begin[row - 1] + turn]).any(axis=1))
        self.lcp[1:] = both
        np.minimum.at(self.lcp, row[differ], turn[differ])
        #: LCP of the first row with the part before, and of the next part's first row with the last one here.
        self.first_lcp, self.next_lcp = (table.column(x)[0].as_py() for x in ("first_lcp", "next_lcp"))
        self.lcp[0] = self.first_lcp
        self.text = self.before[self.begin[1:]] - self.before[self.begin[:-1]]
        #: Code points of the prefixes that this row is the first to have, and whether nothing goes on from it.
        self.fresh = self.text - self.upto(np.arange(self.rows), self.lcp)
        following = np.concatenate([self.lcp[1:], [self.next_lcp]])
        self.leaf = (following < self.length) & ~table.column("more").to_numpy(zero_copy_only=False)

    def upto(self, row: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """Code points of the first ``turns`` of a row."""
        return self.before[self.begin[row] + turns] - self.before[self.begin[row]]

    def key(self, row: int, depth: int) -> bytes:
        """A name for a prefix that other parts know too."""
        return b"%d:%d:%d:%d:" % (self.k[row], self.p1[row], self.p2[row], depth) + hashlib.md5(self.paths[row][: TOKEN * depth]).digest()


def trie_key(k: int, p1: int, p2: int) -> bytes:
    """The name of the prefix that is all turns before a chunk."""
    return b"%d:%d:%d" % (k, p1, p2)


NODES = pa.schema(
    [(x, pa.int64()) for x in ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "e1", "e2")]
    + [("own_key", pa.binary()), ("parent_key", pa.binary()), ("begins", pa.bool_()), ("top", pa.bool_())]
)
_NODES = "depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, e1 long, e2 long, own_key binary, parent_key binary, begins boolean, top boolean"


def nodes_of(table: pa.Table, chunk: int) -> pa.Table:
    """The prefixes of a part's rows, each once, with what this part knows of them.

    ``own_key`` is there for prefixes that other parts have a share in, and for those of full chunks that go on, where
    the next trie hangs; ``parent_key`` where the prefix before is one of those. ``begins``: no part before has it.
    ``top``: it has one turn.
    """
    part = Part(table)
    get = lambda name: part.table.column(name).to_numpy(zero_copy_only=False)
    own_first = part.lcp.copy()
    own_first[0] = 0  # prefixes that go on from the part before are named by the first row
    count = part.length - own_first
    row = np.repeat(np.arange(part.rows), count)
    base = np.cumsum(count) - count
    depth = np.arange(len(row)) - base[row] + own_first[row] + 1
    inner = part.lcp.copy()
    inner[0] = -1
    minima, least = RangeMinimum(inner), RangeMinimum(get("least"))

    left, right = minima.extents(row, depth)
    begins = depth > part.lcp[row]
    sums = lambda x: np.concatenate([[0], np.cumsum(x)])
    over = lambda x: x[right + 1] - x[left]
    n_convs = over(sums(part.n))
    x = part.upto(row, depth - 1)
    every = over(sums(part.n * part.text + get("after"))) - x * n_convs
    once = over(sums(part.fresh + get("deeper_fresh"))) - np.where(begins, x - part.upto(row, part.lcp[row]), 0)
    leaves = over(sums(part.leaf + get("deeper_leaves")))

    # the prefix before has an interval of its own, found in the same way
    upper = np.maximum(depth - 1, 1)
    up_left, up_right = minima.extents(row, upper)
    inside = depth > 1
    parent = np.where(inside, least.of(up_left, up_right), 0)
    up_node = base[up_left] + upper - own_first[up_left] - 1
    children = np.bincount(up_node[inside & begins], minlength=len(row))

    open_left = (left == 0) & (part.first_lcp >= depth)
    open_right = (right == part.rows - 1) & (part.next_lcp >= depth)
    edge = open_left | open_right
    more, q1, q2 = get("more"), get("q1"), get("q2")
    hangs = (depth == chunk) & more[row]
    own_key, parent_key = [None] * len(row), [None] * len(row)
    for k in np.flatnonzero(edge):
        own_key[k] = part.key(row[k], int(depth[k]))
    for k in np.flatnonzero(hangs):
        own_key[k] = trie_key(part.k[row[k]] + 1, q1[row[k]], q2[row[k]])
    for k in np.flatnonzero(inside & edge[np.where(inside, up_node, 0)]):
        parent_key[k] = part.key(row[k], int(depth[k]) - 1)
    for k in np.flatnonzero(~inside & (part.k[row] > 0)):
        parent_key[k] = trie_key(part.k[row[k]], part.p1[row[k]], part.p2[row[k]])
    deep = part.k[row] * chunk + depth
    ends = begins & (part.length[row] == depth) & (get("n_ends")[row] > 0)
    columns = [
        deep, least.of(left, right), pa.array(parent, mask=~inside), n_convs, children, leaves, every - once,
        pa.array(q1[row], mask=~ends), pa.array(q2[row], mask=~ends), own_key, parent_key, begins, deep == 1,
    ]
    return pa.table([pa.array(c, f.type) if not isinstance(c, pa.Array) else c.cast(f.type) for c, f in zip(columns, NODES)], schema=NODES)


def _borders(rows: DataFrame) -> DataFrame:
    """first_lcp and next_lcp of each part: one row a part."""
    one = F.struct("k", "p1", "p2", "path")
    ends = rows.groupBy("part").agg(F.min_by(one, "at").alias("head"), F.max_by(one, "at").alias("tail"))
    order = Window.orderBy("part")  # one row a part, whose chunks are short
    ends = ends.select("part", "head", "tail", F.lag("tail").over(order).alias("before"), F.lead("head").over(order).alias("next"))

    def common(a: dict | None, b: dict | None) -> int:
        if a is None or b is None or any(a[x] != b[x] for x in ("k", "p1", "p2")):
            return 0
        turns = min(len(a["path"]), len(b["path"])) // TOKEN
        return next((t for t in range(turns) if a["path"][TOKEN * t : TOKEN * (t + 1)] != b["path"][TOKEN * t : TOKEN * (t + 1)]), turns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(x["part"], common(x["before"], x["head"]), common(x["tail"], x["next"])) for x in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)] if found else [pa.array([], pa.int64())] * 3, ["its_part", "first_lcp", "next_lcp"])

    return ends.mapInArrow(run, "its_part long, first_lcp long, next_lcp long")


def _sorted_chunks(chunks: DataFrame, part_turns: int) -> DataFrame:
    """Different chunks of each trie, with n, least (conv), after (of all members), n_ends, more, sorted over parts, with
    the LCPs at the borders of their part. Written."""
    different = chunks.groupBy("k", "p1", "p2", "path").agg(
        F.first("q1").alias("q1"), F.first("q2").alias("q2"), F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv").alias("least"),
        F.sum("after").alias("after"), F.count_if("last").alias("n_ends"), F.bool_or(~F.col("last")).alias("more"),
    )
    different = written(different)
    turns = different.agg(F.sum(F.length("path") / TOKEN)).first()[0] or 0
    order = ["k", "p1", "p2", "path"]
    rows = different.repartitionByRange(int(turns // part_turns) + 1, *order).sortWithinPartitions(*order)
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    rows = written(rows.withColumn("part", F.shiftright("at", 33)))
    return written(rows.join(_borders(rows), F.col("part") == F.col("its_part")).drop("its_part"))


def _with_deeper(rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """Add what lies in the tries below each chunk: code points of their prefixes, each once, and leaves.

    What is new in a chunk is put down to one conversation that has it, its least; a conversation's sums from its end
    up to each of its chunks, added over the members of a chunk, then count everything below once.
    """
    if rows.filter("k > 0").isEmpty():
        return rows.select("*", *(F.lit(0).cast("long").alias(x) for x in ("deeper_fresh", "deeper_leaves")))

    def new(table: pa.Table) -> pa.Table:
        part = Part(table)
        names = ["owner", "its_k", "fresh", "leaves"]
        return pa.table([part.table.column("least"), part.table.column("k"), pa.array(part.fresh), pa.array(part.leaf.astype(np.int64))], names=names)

    owned = rows.groupBy("part").applyInArrow(new, "owner long, its_k long, fresh long, leaves long").filter("its_k > 0")
    long = chunks.filter(~F.col("last") | (F.col("k") > 0)).select("conv", "k", "q1", "q2")
    joined = long.join(owned, (F.col("conv") == F.col("owner")) & (F.col("k") == F.col("its_k")), "left")
    below = Window.partitionBy("conv").orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, -1)
    sums = joined.select("k", "q1", "q2", *(F.coalesce(F.sum(x).over(below), F.lit(0)).alias(x) for x in ("fresh", "leaves")))
    sums = sums.groupBy(*(F.col(x).alias(f"its_{x}") for x in ("k", "q1", "q2"))).agg(F.sum("fresh").alias("fresh"), F.sum("leaves").alias("leaves"))
    same = (F.col("k") == F.col("its_k")) & (F.col("q1") == F.col("its_q1")) & (F.col("q2") == F.col("its_q2"))
    none = F.lit(0).cast("long")
    return written(
        rows.join(sums, same, "left")
        .withColumns({"deeper_fresh": F.coalesce("fresh", none), "deeper_leaves": F.coalesce("leaves", none)})
        .drop("fresh", "leaves", "its_k", "its_q1", "its_q2")
    )


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")


def _joined(nodes: DataFrame, key: Column, other: DataFrame, other_key: str, columns: dict[str, Column]) -> DataFrame:
    """``nodes`` with ``columns`` made from ``other`` where ``key`` is there; the rest doesn't move."""
    found = nodes.filter(key.isNotNull()).join(other, key == F.col(other_key), "left").withColumns(columns).select(*nodes.columns)
    return nodes.filter(key.isNull()).unionByName(found)


def trie(conversations: DataFrame, chunk: int = CHUNK, part_turns: int = PART_TURNS) -> DataFrame:
    """Prefixes of the rebuilt ``conversations`` (conv_id, turn, role, text): conv_id (the least member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns of a conversation are in the order of ``turn``, null first, and equal ones in that of their hash. Null roles
    and texts are empty. Rows without conv_id are left out. A conversation c is rebuilt from the first h turns of the
    conversation c - c % 100, h being crc32 of c as text, modulo 6, and its own after the first h. A row for each
    sequence of turns that a rebuilt conversation begins with, the empty one included, as soon as there is a
    conversation; an empty table gives no row. Other columns are left out.
    """
    spark = conversations.sparkSession
    turns, convs = rebuilt(conversations)
    chunks = written(chunked(turns, chunk))
    rows = _with_deeper(_sorted_chunks(chunks, part_turns), chunks)
    found = written(rows.groupBy("part").applyInArrow(lambda table: nodes_of(table, chunk), _NODES))
    totals = convs.agg(F.count("*").alias("n"), F.min("conv").alias("least")).first()
    if not totals["n"]:
        return spark.createDataFrame([], ", ".join(f"{x} long" for x in COLUMNS) + ", ends_sha256 string")

    # prefixes with shares in several parts
    sums = [F.sum(x).alias(x) for x in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    firsts = [F.max(x).alias(x) for x in ("e1", "e2", "parent_key", "begins", "top")]
    keyed = found.filter(F.col("own_key").isNotNull()).groupBy("own_key", "depth")
    keyed = keyed.agg(F.min("conv_id").alias("conv_id"), F.max("parent_conv_id").alias("parent_conv_id"), *sums, *firsts).select(*found.columns)
    nodes = written(found.filter(F.col("own_key").isNull()).unionByName(keyed))

    # prefixes of full chunks have their children in the next trie, which begins with one turn
    hung = nodes.filter((F.col("depth") % chunk == 1) & F.col("parent_key").isNotNull() & ~F.col("top")) if chunk > 1 else nodes.filter(~F.col("top"))
    hung = hung.groupBy(F.col("parent_key").alias("hung_key")).agg(F.count("*").alias("hung"))
    names = nodes.filter(F.col("own_key").isNotNull()).select(F.col("own_key").alias("its_key"), F.col("conv_id").alias("its_conv"))
    full = _joined(nodes, F.col("own_key"), hung, "hung_key", {"n_children": F.col("n_children") + F.coalesce("hung", F.lit(0))})
    full = _joined(full, F.col("parent_key"), names, "its_key", {"parent_conv_id": F.col("its_conv")})
    full = full.withColumn("parent_conv_id", F.when(F.col("top"), F.lit(totals["least"])).otherwise(F.col("parent_conv_id")))
    top = nodes.filter("top").agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")).first()
    root = [(totals["least"], 0, None, totals["n"], top["children"], top["leaves"] or 1, top["saved"] or 0)]
    root = spark.createDataFrame(root, ", ".join(f"{x} long" for x in COLUMNS))
    ends = written(ends_of(chunks, convs))
    of_root = ends.filter(F.col("e1").isNull()).select(F.col("ends_sha256").alias("of_root"))

    empty = F.lit(hashlib.sha256(b"").hexdigest())
    known = ends.filter(F.col("e1").isNotNull()).select(F.col("e1").alias("its_e1"), F.col("e2").alias("its_e2"), "ends_sha256")
    ended = full.filter(F.col("e1").isNotNull()).join(known, (F.col("e1") == F.col("its_e1")) & (F.col("e2") == F.col("its_e2")), "left")
    none = full.filter(F.col("e1").isNull()).withColumn("ends_sha256", empty)
    root = root.join(of_root, how="left").withColumn("ends_sha256", F.coalesce("of_root", empty))  # one row each
    return root.select(*COLUMNS, "ends_sha256").unionByName(ended.select(*COLUMNS, "ends_sha256")).unionByName(none.select(*COLUMNS, "ends_sha256"))


_CRC = (
    "(xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i, 1))::BIGINT)), "
    "lambda x, b: list_reduce(list_prepend(xor(x, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda y, z: xor(y >> 1, (y & 1) * 3988292384))), 4294967295))"
)

SQL = f"""
WITH originals AS (
  SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
shares AS (
  SELECT c, own, ({_CRC} % 6)::BIGINT AS h FROM originals),
rebuilt AS (
  SELECT s.c, list_concat(coalesce(b.own[1 : s.h], []), s.own[s.h + 1 :]) AS w
  FROM shares s LEFT JOIN originals b ON b.c = s.c - s.c % 100),
prefixes AS (
  SELECT c, len(w) AS own_depth, d AS depth, w[1 : d] AS prefix FROM rebuilt, unnest(range(len(w) + 1)) AS t(d)),
nodes AS (
  SELECT prefix, depth, min(c) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (own_depth = depth), '') AS ends
  FROM prefixes GROUP BY prefix, depth),
children AS (
  SELECT prefix[1 : depth - 1] AS parent, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
whole AS (
  SELECT nodes.*, coalesce(children.n, 0) AS n_children,
         CASE WHEN depth > 0 THEN (n_convs - 1) * length(prefix[depth].text) ELSE 0 END AS saved
  FROM nodes LEFT JOIN children ON children.parent = nodes.prefix),
subtrees AS (
  SELECT prefix[1 : a] AS top, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM whole, unnest(range(depth + 1)) AS t(a) GROUP BY ALL)
SELECT whole.conv_id, whole.depth, p.conv_id AS parent_conv_id, whole.n_convs, whole.n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, sha256(whole.ends) AS ends_sha256
FROM whole JOIN subtrees ON subtrees.top = whole.prefix
LEFT JOIN nodes p ON whole.depth > 0 AND p.depth = whole.depth - 1 AND p.prefix = whole.prefix[1 : whole.depth - 1]
"""
