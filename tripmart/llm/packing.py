"""Best-fit packing of token sequences.

Best-fit decreasing takes the longest piece first and puts it into the fullest sequence that still has room. Pieces
of one length are interchangeable, and so are sequences with the same room left. So the packing is worked out from
the counts of pieces by length, at most ``capacity`` numbers whatever the size of the corpus, with a segment tree
over the room left that finds the tightest open sequence. It says where the pieces of each length go by their rank;
Spark ranks the pieces and looks their places up.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.pieces import KEPT, PieceCache
from tripmart.llm.tables import written
from tripmart.llm.workers import kept, task

#: Pieces of one length and salt are ranked in one task; a salt has about so many pieces in all.
SALT_ROWS = 100_000


class OpenRoom:
    """How many sequences are open for each room left, as a segment tree of sums."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)

    def add(self, room: int, count: int) -> None:
        at = room + self.size
        while at:
            self.tree[at] += count
            at //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest room of an open sequence that is ``least`` or more."""
        at = least + self.size
        if not self.tree[at]:
            while True:  # up to the first subtree on the right with an open sequence
                if at & (at + 1) == 0:
                    return None
                if not at & 1 and self.tree[at + 1]:
                    at += 1
                    break
                at //= 2
            while at < self.size:
                at = 2 * at if self.tree[2 * at] else 2 * at + 1
        return at - self.size


class Run(NamedTuple):
    """Pieces of ``length`` with a rank from ``first_rank`` to before ``end_rank``: ``per_sequence`` of them go into
    each sequence from ``first_sequence`` on, from ``offset`` there."""

    length: int
    first_rank: int
    end_rank: int
    first_sequence: int
    per_sequence: int
    offset: int


def plan(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best-fit decreasing of ``counts[length]`` pieces of each length."""
    room, runs, opened = OpenRoom(capacity), [], 0
    open_runs: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def keep(left: int, first: int, count: int) -> None:
        if count and left:
            open_runs[left].append((first, count))
            room.add(left, count)

    for length in sorted(counts, reverse=True):
        rank, total = 0, counts[length]
        while rank < total:
            left = room.tightest(length)
            if left is None:
                left = capacity
                first, count = opened, -(-(total - rank) // (capacity // length))
                opened += count
            else:
                first, count = open_runs[left].pop()
                room.add(left, -count)
            each = left // length
            full = min(count, (total - rank) // each)
            if full:
                runs.append(Run(length, rank, rank + full * each, first, each, capacity - left))
                rank += full * each
                keep(left - each * length, first, full)
            if full < count and rank < total:  # the last pieces, too few to fill a sequence
                runs.append(Run(length, rank, total, first + full, total - rank, capacity - left))
                keep(left - (total - rank) * length, first + full, 1)
                rank, full = total, full + 1
            keep(left, first + full, count - full)
    return runs


#: Letters that no normalizer takes apart, and a word of them.
LETTERS = "".join(chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)))
_WORD = re.compile(f" ?[{LETTERS}]+").fullmatch


class Batch:
    """Encodes many pieces in one call, told apart by the one id of a mark between them.

    Words of LETTERS go to the tokenizer's model alone, letter by letter as its normalizer and pre-tokenizer leave them,
    if those don't do more to words than that.
    """

    def __init__(self, tokenizer, mark: str):
        self.tokenizer, self.mark = tokenizer, mark
        self.tokenize, self.table = tokenizer.model.tokenize, self._table()
        self.own = mark.strip(" ")
        ids = tokenizer.encode(mark, add_special_tokens=False).ids
        self.id = ids[0] if len(ids) == 1 else None

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _seen(self, text: str) -> list[str]:
        """What the model is given for a text."""
        normalizer, splitter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        text = normalizer.normalize_str(text) if normalizer else text
        return [x for x, _ in splitter.pre_tokenize_str(text)] if splitter else [text]

    def _table(self) -> dict[int, str] | None:
        """What the model is given for each of LETTERS and a space before them; None if words aren't given so."""
        if any(_WORD(x.content) for x in self.tokenizer.get_added_tokens_decoder().values()):
            return None
        table = {ord(x): "".join(self._seen(x)) for x in LETTERS}
        before = self._seen(" a")
        table |= {ord(" "): before[0].removesuffix(table[ord("a")]) if before else "", ord("\n"): "\n"}
        for word in (LETTERS, LETTERS[::-1], " " + LETTERS):
            if self._seen(word) != [word.translate(table)]:
                return None
        return table

    def _words(self, words: list[str]) -> list[bytes]:
        ids, ends, tokenize = [], [0], self.tokenize
        for word in "\n".join(words).translate(self.table).split("\n"):
            ids += [x.id for x in tokenize(word)]
            ends.append(4 * len(ids))
        data = np.array(ids, "<u4").tobytes()
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def __call__(self, texts: list[str]) -> list[bytes]:
        words = list(filter(_WORD, texts)) if self.table else []
        if not words:
            return self._marked(texts)
        found = dict(zip(words, self._words(words)))
        if len(words) < len(texts):
            rest = [x for x in texts if x not in found]
            found.update(zip(rest, self._marked(rest)))
        return [found[x] for x in texts]

    def _marked(self, texts: list[str]) -> list[bytes]:
        if self.id is None or len(texts) < 2:
            return self._each(texts)
        # white space would run into a mark
        mixed = any(map(str.isspace, texts)) or "\0".join(texts).find(self.own) >= 0
        rest = [x for x in texts if not (self.own in x or x.isspace())] if mixed else texts
        if len(rest) < 2:
            return self._each(texts)
        joined = self.tokenizer.encode_batch_fast([self.mark.join(rest)], add_special_tokens=False)[0]
        ids = np.array(joined.ids, "<u4")
        at = np.flatnonzero(ids == self.id)
        if len(at) != len(rest) - 1:  # some piece runs into a mark
            return self._each(texts)
        data, ends = ids.tobytes(), [*(4 * at).tolist(), 4 * len(ids)]
        cut = [data[a:b] for a, b in zip([0, *(4 * at + 4).tolist()], ends)]
        if not mixed:
            return cut
        found = dict(zip(rest, cut))
        alone = [x for x in texts if self.own in x or x.isspace()]
        found.update(zip(alone, self._each(alone)))
        return [found[x] for x in texts]


@kept(4)
def _ids_of(path: str, spaces: bool, known: int = KEPT) -> PieceCache:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for each core
    from tokenizers import Tokenizer

    # a line break stands alone between pieces that begin with a space, and so does a mark between spaces
    return PieceCache(Batch(Tokenizer.from_file(path), "\n" if spaces else " | "), known, spaces, runs=spaces)


def token_ids(texts: pa.Array, path: str, spaces: bool, end: int, known: int = KEPT) -> Iterator[bytes]:
    """Little-endian 32-bit ids of each text by the tokenizers library, and the id ``end``. A null is empty. Of the
    pieces that were met last a worker keeps ``known``, and up to as many from before them."""
    cache, last = _ids_of(path, spaces, known), np.array([end], "<u4").tobytes()
    for at in range(0, len(texts), 200):
        for ids in cache.of_many([x or "" for x in texts.slice(at, 200).to_pylist()]):
            yield ids + last


def cut(df: DataFrame, path: str, capacity: int, end: int, spaces: bool = False, keep_ids: bool = False, known: int = KEPT) -> DataFrame:
    """Tokenize ``doc_id``, ``text`` and cut each document's ids and ``end`` into pieces of ``capacity`` at most:
    doc_id, piece, start, length, ids_crc32, and ids (little-endian, 32 bits) if asked for."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                row, rest = [], []
                for k, ids in enumerate(token_ids(part.column(1), path, spaces, end, known)):
                    for n, begin in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[begin : begin + 4 * capacity]
                        row.append(k)
                        rest.append((n, begin // 4, len(piece) // 4, zlib.crc32(piece), piece if keep_ids else None))
                columns = [pa.array(x, t) for x, t in zip(zip(*rest), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), *columns][: 5 + keep_ids], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + keep_ids]
    kind = df.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return df.select(df["doc_id"], df["text"]).mapInArrow(task(pieces, _ids_of), schema)


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to rows of doc_id, piece, start, length, ids_crc32 and ``row``, a number of its own
    for each row, which is left out.

    ``pieces`` is read several times, so it should be a written table. Every row gets a place, repeated rows and
    null ids too; an empty table gives an empty one. Rows are dealt by their number, so an id or a text that many
    rows share fills no task.
    """
    spark = pieces.sparkSession
    counts = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    salts = max(1, sum(counts.values()) // SALT_ROWS)
    names = ["run_length", "first_rank", "end_rank", "first_sequence", "per_sequence", "run_offset"]
    # as an Arrow table, which no Python workers turn into rows
    columns = np.array(plan(counts, capacity), np.int64).reshape(-1, len(names)).T
    runs = spark.createDataFrame(pa.table([pa.array(x) for x in columns], names))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
    before = (
        salted.groupBy("length", "salt")
        .agg(F.count("*").alias("n"))
        .select(
            F.col("length").alias("salt_length"),
            F.col("salt").alias("its_salt"),
            (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"),
        )
    )
    ranked = salted.withColumn(
        "rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32", "row")) - 1
    )
    ranked = ranked.join(before, (F.col("length") == F.col("salt_length")) & (F.col("salt") == F.col("its_salt")))
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    placed = ranked.join(
        runs,
        (F.col("length") == F.col("run_length"))
        & (F.col("rank") >= F.col("first_rank"))
        & (F.col("rank") < F.col("end_rank")),
    )
    nth = F.col("rank") - F.col("first_rank")
    return placed.select(
        *(x for x in pieces.columns if x != "row"),
        (F.col("first_sequence") + F.floor(nth / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("run_offset") + (nth % F.col("per_sequence")) * F.col("length")).alias("offset"),
    )


def pack(df: DataFrame, path: str, capacity: int = 4096, end: int = 1, spaces: bool = False, known: int = KEPT) -> DataFrame:
    """Pack the documents of ``df`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    ``path`` is a file of the tokenizers library; ``spaces`` says whether its tokens hold spaces. A null or empty
    text is the id ``end`` alone. Longer documents are cut; nothing else is. Columns other than the two are left out.
    ``known`` is for the memory of workers, see ``token_ids``.
    """
    pieces = cut(df, path, capacity, end, spaces, known=known).withColumn("row", F.monotonically_increasing_id())
    return place(written(pieces), capacity)


def sequences(df: DataFrame, packed: DataFrame, path: str, capacity: int = 4096, end: int = 1, spaces: bool = False) -> DataFrame:
    """The ids of each sequence of ``pack``: sequence_id, ids (little-endian, 32 bits), n_tokens.

    Documents are tokenized again and joined to their places, so ``doc_id`` must be distinct and not null.
    """
    pieces = cut(df, path, capacity, end, spaces, keep_ids=True).select("doc_id", "piece", "ids")
    joined = pieces.join(packed.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    rows = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return (
        joined.groupBy("sequence_id")
        .agg(rows.alias("rows"))
        .select("sequence_id", F.aggregate("rows", F.lit(b""), lambda x, row: F.concat(x, row["ids"])).alias("ids"))
        .withColumn("n_tokens", (F.length("ids") / 4).cast("long"))
    )
