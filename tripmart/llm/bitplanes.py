"""Files of token ids as compressed bit or byte planes.

A file holds ids in blocks of a fixed number. A block of 32-bit ids is transposed into 4 planes of bytes or 32 of
bits, and each plane is compressed by zstandard, so that the planes of high bits, all alike, cost next to nothing.
An index at the end says where each plane of each block is; a table there has the documents' ids and lengths.

Layout: ``TMBP`` | planes of block 0, 1, ... | index and documents, compressed JSON and arrays | sizes | ``TMBP``.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.packing import token_ids
from tripmart.llm.tables import shared_folder, written

MAGIC = b"TMBP"
BLOCK_IDS = 1 << 16
#: Characters of a text that order the rows of one doc_id.
HEAD = 64
_TAIL = struct.Struct("<QQQ4s")


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """32-bit ids as planes, the lowest first: bytes, or bits packed by eight."""
    table = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [table[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(table, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], count: int, kind: str) -> np.ndarray:
    if kind == "byte":
        table = np.stack([np.frombuffer(x, np.uint8) for x in planes], axis=1)
    else:
        bits = [np.unpackbits(np.frombuffer(x, np.uint8), count=count, bitorder="little") for x in planes]
        table = np.packbits(np.stack(bits, axis=1), axis=1, bitorder="little")
    return np.ascontiguousarray(table).view("<u4").reshape(-1)


class Writer:
    """Writes one file; ``stream`` takes bytes in order."""

    def __init__(self, stream, kind: str = "byte", block_ids: int = BLOCK_IDS, level: int = 3):
        if kind not in ("byte", "bit"):
            raise ValueError(f"planes are of bytes or bits, not {kind}")
        self.stream, self.kind, self.block_ids = stream, kind, block_ids
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.index: list[list[int]] = []
        self.documents: list[int | None] = []
        self.lengths: list[int] = []
        self.buffer, self.at = bytearray(), len(MAGIC)
        stream.write(MAGIC)

    def _block(self, ids: np.ndarray) -> None:
        sizes = []
        for plane in to_planes(ids, self.kind):
            packed = self.compress(plane)
            self.stream.write(packed)
            sizes.append(len(packed))
        self.index.append([self.at, len(ids), *sizes])
        self.at += sum(sizes)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """Add a document's little-endian 32-bit ids."""
        self.documents.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.buffer += ids
        size = 4 * self.block_ids
        if len(self.buffer) >= size:
            whole = len(self.buffer) // size * size
            ready = np.frombuffer(bytes(self.buffer[:whole]), "<u4")
            del self.buffer[:whole]
            for k in range(0, len(ready), self.block_ids):
                self._block(ready[k : k + self.block_ids])

    def close(self) -> None:
        if self.buffer:
            self._block(np.frombuffer(bytes(self.buffer), "<u4"))
        index = self.compress(json.dumps({"planes": self.kind, "block_ids": self.block_ids, "blocks": self.index}).encode())
        named = np.array([x is not None for x in self.documents], "u1").tobytes()
        ids = np.array([x or 0 for x in self.documents], "<i8").tobytes()
        table = self.compress(named + ids + np.array(self.lengths, "<i8").tobytes())
        for part in (index, table, _TAIL.pack(len(index), len(table), len(self.documents), MAGIC)):
            self.stream.write(part)


class Reader:
    """Reads a file, any range of ids by the blocks that hold it; ``source`` can seek."""

    def __init__(self, source):
        self.source = source
        size = source.seek(0, 2)
        index_size, table_size, count, magic = _TAIL.unpack(self._bytes(size - _TAIL.size, _TAIL.size))
        if magic != MAGIC or self._bytes(0, 4) != MAGIC:
            raise ValueError("not a file of token ids, or cut short")
        at = size - _TAIL.size - table_size - index_size
        self.expand = zstandard.ZstdDecompressor().decompress
        head = json.loads(self.expand(self._bytes(at, index_size)))
        self.kind, self.block_ids, self.blocks = head["planes"], head["block_ids"], head["blocks"]
        table = self.expand(self._bytes(at + index_size, table_size)) if count else b""
        named = np.frombuffer(table, "u1", count)
        ids = np.frombuffer(table, "<i8", count, count)
        self.documents = [int(x) if known else None for x, known in zip(ids, named)]
        self.lengths = np.frombuffer(table, "<i8", count, 9 * count)

    def _bytes(self, at: int, count: int) -> bytes:
        self.source.seek(at)
        return self.source.read(count)

    def block(self, number: int) -> np.ndarray:
        at, count, *sizes = self.blocks[number]
        data = self._bytes(at, sum(sizes))
        ends = np.cumsum([0, *sizes])
        return from_planes([self.expand(data[a:b]) for a, b in zip(ends, ends[1:])], count, self.kind)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to before ``stop`` of the file."""
        if stop <= start:
            return np.empty(0, "<u4")
        first = start // self.block_ids
        found = np.concatenate([self.block(k) for k in range(first, (stop - 1) // self.block_ids + 1)])
        return found[start - first * self.block_ids : stop - first * self.block_ids]

    def each(self) -> Iterator[tuple[int | None, Iterator[np.ndarray]]]:
        """Each document with its ids in parts; a block is read once and one is held at a time."""
        number, block, at = 0, np.empty(0, "<u4"), 0

        def parts(left: int) -> Iterator[np.ndarray]:
            nonlocal number, block, at
            while left:
                if at == len(block):
                    block, at, number = self.block(number), 0, number + 1
                part = block[at : at + left]
                at, left = at + len(part), left - len(part)
                yield part

        for doc_id, length in zip(self.documents, self.lengths.tolist()):
            yield doc_id, parts(length)


def write_ids(df: DataFrame, path: str, folder: str, end: int = 0, kind: str = "byte") -> DataFrame:
    """Write the ids of ``df``'s texts (doc_id, text), each with the id ``end`` after it, as files below ``folder``,
    in ascending doc_id order, nulls first; those of one doc_id by the first HEAD characters of their text, then its
    hash. A null text is empty. Returns the files: path, n_docs, n_tokens, start (ids in all files before).

    Ranges are cut by all these and a number of the row, so rows of one id, or copies of one row, are dealt to as many
    tasks as they fill, and the keys that Spark samples for it are short.

    ``folder`` is a URI that executors reach (a shared file system or an object store). A task writes a file of a new
    name and tells it when done, so files of tasks that were lost or run twice are in no listing.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = pyarrow.fs.FileSystem.from_uri(folder)
        writer, tokens = None, 0
        for batch in batches:
            if writer is None and batch.num_rows:
                files.create_dir(top, recursive=True)
                name = f"{uuid.uuid4().hex}.ids"
                stream = files.open_output_stream(f"{top}/{name}", compression=None)
                writer = Writer(stream, kind)
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                for doc_id, ids in zip(part.column(0).to_pylist(), token_ids(part.column(1), path, True, end)):
                    writer.add(doc_id, ids)
                    tokens += len(ids) // 4
        if writer is not None:
            writer.close()
            stream.close()
            place = TaskContext.get().partitionId()  # ranges are numbered in their order
            yield pa.RecordBatch.from_pylist(
                [{"path": f"{folder}/{name}", "place": place, "n_docs": len(writer.documents), "n_tokens": tokens}], schema=schema
            )

    schema = pa.schema([("path", pa.string()), ("place", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
    texts = df.select(
        df["doc_id"].cast("long").alias("doc_id"), df["text"], F.substring(df["text"], 1, HEAD).alias("head"),
        F.xxhash64(df["text"]).alias("hash"), F.monotonically_increasing_id().alias("row"),
    )
    order = F.col("doc_id").asc_nulls_first(), F.col("head").asc_nulls_first(), F.col("hash"), F.col("row")
    ordered = texts.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    files = written(ordered.mapInArrow(write, "path string, place long, n_docs long, n_tokens long"))
    before = F.sum("n_tokens").over(Window.orderBy("place")) - F.col("n_tokens")
    return files.select("path", "n_docs", "n_tokens", before.alias("start"))  # a row for each file


def read_ids(files: DataFrame) -> DataFrame:
    """Read files that ``write_ids`` lists, each in a task: doc_id, start, n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                system, path = pyarrow.fs.FileSystem.from_uri(file["path"])
                with system.open_input_file(path) as source:
                    reader, rows = Reader(source), []
                    start = file["start"]
                    for (doc_id, parts), length in zip(reader.each(), reader.lengths.tolist()):
                        crc = 0
                        for part in parts:
                            crc = zlib.crc32(part.tobytes(), crc)
                        rows.append((doc_id, start, length, crc))
                        start += length
                for at in range(0, len(rows), 10_000):
                    columns = [pa.array(x, pa.int64()) for x in zip(*rows[at : at + 10_000])]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    count = max(1, files.count())
    return files.select("path", "start").repartition(count).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(df: DataFrame, path: str, end: int = 0, kind: str = "byte", folder: str | None = None) -> DataFrame:
    """Write the ids of ``df`` (doc_id, text) to files and read them back; see ``write_ids`` and ``read_ids``.

    A row for each input row.
    """
    return read_ids(write_ids(df, path, folder or shared_folder(df.sparkSession), end, kind))
