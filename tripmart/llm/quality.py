"""Text quality by votes of the nearest labelled texts in a latent-semantic space.

A text is described by the shapes it is made of: runs of three byte classes (small or capital letter, digit, each mark
by itself), and how much its words repeat. Shape counts are damped and weighted by their rarity among labelled texts, and
projected on the leading singular vectors of those. Every text is compared with all labelled vectors, in blocks of
exact cosine products, and its score is the mean label of the nearest ones, weighted by their cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.textbytes import U64, Block, alphanumeric, blocks, mix, words
from tripmart.llm.workers import task

#: Labelled texts of each label that the model is fitted on, at most. This bounds the model and what fitting collects.
SAMPLE = 2000
#: Hashed shapes, latent dimensions, voters, power of the cosine in a vote.
SHAPES, LATENT, VOTERS, POWER = 1024, 48, 25, 4
#: Texts whose cosines with all labelled texts are held at once.
ROWS = 128
#: Weight of the repetition figures against the shapes.
REPEATS = 6

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = _CLASS[128:] = 97
_CLASS[65:91] = 65
_CLASS[48:58] = 48


def features(block: Block) -> np.ndarray:
    """A row for each text: damped frequencies of shapes, then figures of repetition. An empty text is all zeros."""
    n = len(block)
    out = np.zeros((n, SHAPES + REPEATS), np.float32)
    sizes = np.diff(block.bounds)
    row = np.repeat(np.arange(n), sizes)
    shape = _CLASS[block.data].astype(np.int64)
    if len(shape) > 2:
        inside = row[2:] == row[:-2]
        code = (shape[:-2] << 16 | shape[1:-1] << 8 | shape[2:])[inside]
        bucket = (mix(code.astype(U64)) % U64(SHAPES)).astype(np.int64)
        counts = np.bincount(row[2:][inside] * SHAPES + bucket, minlength=n * SHAPES).reshape(n, SHAPES)
        out[:, :SHAPES] = np.log1p(1000 * counts / np.maximum(sizes, 1)[:, None])
    found = words(block, alphanumeric())
    total = np.maximum(np.diff(found.bounds), 1)
    if len(found.hash):
        order = np.lexsort((found.hash, found.row))
        value, owner = found.hash[order], found.row[order]
        fresh = np.ones(len(value), bool)
        fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        kinds = np.bincount(owner[fresh], minlength=n)
        same = np.zeros(len(value), bool)
        same[1:] = (found.hash[1:] == found.hash[:-1]) & (found.row[1:] == found.row[:-1])
        repeated = np.bincount(found.row[same], minlength=n) / total
        some = np.diff(found.bounds) > 0
        # few kinds of words is only remarkable for the length of the text
        richness = np.log1p(kinds) / np.log1p(total)
        length = (found.stop - found.start).astype(float)
        mean = np.bincount(found.row, length, n) / total
        figures = [repeated, 1 - richness, repeated > 0.3, richness < 0.6, np.minimum(mean / 20, 1), np.ones(n)]
        out[:, SHAPES:] = np.where(some[:, None], np.stack(figures, axis=1), 0)
    return out


@dataclass
class Model:
    """Weights of features, projection, labelled vectors of length one and their labels."""

    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @classmethod
    def fit(cls, rows: np.ndarray, labels: np.ndarray) -> Model:
        rows = rows.astype(np.float64)
        rarity = np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))) + 1
        rarity[SHAPES:] = 8
        weighted = cls._even(rows * rarity)
        values, vectors = np.linalg.eigh(weighted.T @ weighted)
        projection = vectors[:, ::-1][:, :LATENT]
        return cls(rarity, projection, cls._even(weighted @ projection), labels.astype(np.float64))

    @staticmethod
    def _even(rows: np.ndarray) -> np.ndarray:
        length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
        return rows / np.where(length > 0, length, 1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Score of each row of features; texts without any feature have 0, and without labelled texts all have 0.5."""
        some = (rows != 0).any(axis=1)
        if not len(self.labels):
            return np.where(some, 0.5, 0.0)
        latent = self._even(self._even(rows.astype(np.float64) * self.weights) @ self.projection)
        cosine = latent @ self.vectors.T
        k = min(VOTERS, cosine.shape[1])
        nearest = np.partition(cosine, cosine.shape[1] - k, axis=1)[:, -k][:, None]
        # all that are as near as the last voter vote, so the order of labelled texts doesn't matter
        vote = np.where(cosine >= nearest - 1e-9, np.maximum(cosine, 1e-6) ** POWER, 0)
        # rounded, as the products of equal texts may differ in their last bits
        return np.where(some, np.round(np.clip(vote @ self.labels / vote.sum(axis=1), 0, 1), 9), 0.0)


def learnable(doc_id: str = "doc_id"):
    """Whether a row's label may be learnt from: crc32 of its id as text, modulo 5, is not 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled texts of each label, those with the lowest hashes of their ids.

    ``labels`` has doc_id and quality (0 or 1; others and nulls are left out, of several the lowest counts).
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & learnable())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = None
    for label in (0, 1):
        part = known.filter(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    # the sample has at most two times ``sample`` ids and labels
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id", "quality")), "doc_id")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                rows = pa.array([x.tobytes() for x in features(block)], pa.binary())
                columns = [c.slice(block.first, len(block)) for c in (batch.column(0), batch.column(2))]
                yield pa.RecordBatch.from_arrays([columns[0], columns[1].cast(pa.int32()), rows], ["doc_id", "quality", "features"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = texts.select("doc_id", "text", "quality").mapInArrow(task(describe), f"doc_id {kind}, quality int, features binary")
    rows = sorted(rows.dropDuplicates().collect(), key=lambda row: (row["doc_id"], row["features"]))
    if not rows:
        none = np.zeros((0, LATENT))
        return Model(np.ones(SHAPES + REPEATS), np.zeros((SHAPES + REPEATS, LATENT)), none, np.zeros(0))
    matrix = np.stack([np.frombuffer(row["features"], np.float32) for row in rows])
    return Model.fit(matrix, np.array([row["quality"] for row in rows]))


def scorer(model: Model):
    """A column function: the score of a text; a null text is empty."""

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            some = (column.slice(at, ROWS) for at in range(0, len(column), ROWS))
            parts = [model.scores(features(block)) for rows in some for block in blocks(rows)]
            yield pa.array(np.concatenate(parts) if parts else np.empty(0), pa.float64())

    from pyspark.sql.functions import arrow_udf

    score.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(task(score), "double")


def classify(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, least: float = 0.3) -> DataFrame:
    """Score every text: doc_id, held_out, score, predicted (1 from ``least`` on). A row for each input row; a row
    without doc_id is not held out. Other columns are left out."""
    score = scorer(fit(documents, labels, sample))
    return documents.select("doc_id", score("text").alias("score")).select(
        "doc_id",
        F.coalesce(~learnable(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, least: float = 0.3) -> DataFrame:
    """The rows of ``documents``, all columns, with a score of ``least`` or more."""
    score = scorer(fit(documents, labels, sample))
    return documents.filter(score("text") >= least)
