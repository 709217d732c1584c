"""Language of texts and pages by Bayesian evidence fusion.

Four kinds of evidence meet in the logarithm: the text (hashed byte trigrams, one multinomial model for each language),
the language that the page's markup declares, the suffix of its address, and what is usual on its host. The last
three are learned from the table itself by grouped aggregation: each row's first guess, by its text alone, is counted
for each declared language, suffix, host and host's parent domain. A host's prior is smoothed by its parent's, that by
the table's, so a host with few pages says little and one with many says much.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tripmart.llm.textbytes import U64, Block, blocks, fold, mix
from tripmart.llm.tables import written
from tripmart.llm.workers import task

#: Texts of each language that the text model is fitted on, at most.
SAMPLE = 400
BUCKETS = 1 << 14
#: Neighbouring trigrams tell much the same; a text counts as at most so many independent ones.
MOST_TRIGRAMS = 60
#: Strength of a prior, in rows of the level below it.
STRENGTH = 20.0
#: Below this probability a language isn't taken as known.
LEAST = 0.6


def trigrams(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash bucket of the byte trigram around each letter; A-Z count as a-z, digits and marks as spaces,
    and a text has a space at both ends."""
    data = fold(block.data)
    letters = ((data >= 97) & (data <= 122)) | (data >= 128)
    row = np.repeat(np.arange(len(block)), np.diff(block.bounds))
    place = np.arange(len(data)) + 2 * row + 1  # in the texts with their spaces
    padded = np.full(len(data) + 2 * len(block), 32, np.uint8)
    padded[place[letters]] = data[letters]
    at = place[letters]
    code = padded[at - 1].astype(np.int64) << 16 | padded[at].astype(np.int64) << 8 | padded[at + 1]
    return row[letters], (mix(code.astype(U64)) % U64(BUCKETS)).astype(np.int64)


@dataclass
class TextModel:
    """Log probability of each bucket in each language."""

    languages: list[str]
    table: np.ndarray

    @classmethod
    def from_counts(cls, counts: dict[str, np.ndarray]) -> TextModel:
        names = sorted(counts)
        table = np.array([(counts[x] + 0.5) / (counts[x].sum() + 0.5 * BUCKETS) for x in names]).reshape(len(names), BUCKETS)
        return cls(names, np.log(table))

    def log_likelihoods(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """A row for each text: log likelihood of each language, all 0 where there is no trigram; and how many there are."""
        row, bucket = trigrams(block)
        count = np.bincount(row, minlength=len(block))
        weight = np.minimum(1, MOST_TRIGRAMS / np.maximum(count, 1))
        sums = [np.bincount(row, x[bucket], len(block)) * weight for x in self.table]
        return np.stack(sums, axis=1) if sums else np.zeros((len(block), 0)), count


def fit_text(documents: DataFrame, sample: int = SAMPLE) -> TextModel:
    """Fit on the texts of ``documents`` (doc_id, text, lang) with the lowest id hashes, ``sample`` of each language."""
    known = documents.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.select("doc_id", "lang").withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= sample)
    # at most ``sample`` ids of each language
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id", "lang")), "doc_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for block in blocks(batch.column(0)):
                row, bucket = trigrams(block)
                names = langs[block.first : block.first + len(block)]
                for lang in np.unique(names.astype(str)):
                    counts = np.bincount(bucket[(names == lang)[row]], minlength=BUCKETS)
                    at = np.flatnonzero(counts)
                    columns = [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    rows = texts.select("text", "lang").mapInArrow(task(count), "lang string, bucket int, n long")
    counts: dict[str, np.ndarray] = {}
    for row in rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():
        counts.setdefault(row["lang"], np.zeros(BUCKETS))[row["bucket"]] = row["n"]
    return TextModel.from_counts(counts)


def text_evidence(model: TextModel):
    """A column function: log likelihoods of a text in the order of the model's languages, null if it has no trigram, as
    a null text or one without a letter."""

    def evidence(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            parts = [model.log_likelihoods(block) for block in blocks(column)]
            rows = np.concatenate([x for x, _ in parts]) if parts else np.zeros((0, len(model.languages)))
            none = np.concatenate([n == 0 for _, n in parts]) if parts else np.zeros(0, bool)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * len(model.languages)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1)), mask=pa.array(none))

    evidence.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(task(evidence), "array<double>")


# Markup and addresses -------------------------------------------------------------------------------------------


def visible_text(html: Column) -> Column:
    """What a page shows: without scripts, styles, comments, tags and character references.

    A script, style or comment that isn't closed goes to the end, as in browsers, and a tag has no other in it, so no
    place is looked at again from each of many broken tags.
    """
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)", " ")
    return F.regexp_replace(F.regexp_replace(text, r"<[^<>]*>", " "), r"&#?\w{1,12};", " ")


def declared_language(html: Column) -> Column:
    """The language that the html tag or a content-language header in the markup names, without its region."""
    tag = F.regexp_extract(html, r"(?i)<html(?=\s)[^<>]*?\slang\s*=\s*[\"']?\s*([a-z]{2,3})", 1)
    meta = F.regexp_extract(html, r"(?i)<meta(?=\s)(?=[^<>]*content-language)[^<>]*?\scontent\s*=\s*[\"']?\s*([a-z]{2,3})", 1)
    found = F.lower(F.when(tag != "", tag).otherwise(meta))
    return F.when(found != "", found)


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def parent_of(host: Column) -> Column:
    """The last two labels of a host; a name without dots is its own parent."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.when(F.contains(host, F.lit(".")), F.substring_index(host, ".", -1))


# Fusion ---------------------------------------------------------------------------------------------------------


def _shares(counts: Column, smooth: list[Column], strength: float) -> Column:
    """Counts for each language as shares, with ``smooth`` shares worth ``strength`` rows."""
    total = sum((counts[k] for k in range(len(smooth))), F.lit(0.0))
    return F.array(*[(counts[k] + F.lit(strength) * smooth[k]) / (total + F.lit(strength)) for k in range(len(smooth))])


def fused(rows: DataFrame, languages: list[str]) -> DataFrame:
    """Add ``posterior`` (an array by language) to rows with text_evidence, declared, suffix and host.

    Null evidence says nothing. A first guess is made where the evidence prefers a language, or there is but one to
    guess. Levels are counted in Spark with sums on the map side, and joined back by key; Spark
    broadcasts a level if it is small, and splits a hot key of the join if not.
    """
    n = len(languages)
    top = F.array_max("text_evidence")
    prefers = F.size(F.array_distinct("text_evidence")) > 1 if n > 1 else F.col("text_evidence").isNotNull()
    first = rows.withColumn("guess", F.when(prefers, F.array_position("text_evidence", top)))
    first = first.withColumn("parent", parent_of(F.col("host")))
    guessed = first.filter(F.col("guess").isNotNull())
    # one pass over the rows: the counts by all four keys, from which those of each level are summed
    keys = ["declared", "suffix", "host", "parent"]
    cube = written(guessed.groupBy(*keys).agg(F.array(*[F.count_if(F.col("guess") == k + 1).cast("double") for k in range(n)]).alias("n")))

    def level(key: str) -> DataFrame:
        sums = F.array(*[F.sum(F.col("n")[k]) for k in range(n)])
        return cube.filter(F.col(key).isNotNull()).groupBy(key).agg(sums.alias(f"{key}_n")).withColumnRenamed(key, f"{key}_key")

    whole = cube.agg(*[F.sum(F.col("n")[k]).alias(str(k)) for k in range(n)]).first() if n else []
    total = sum(x or 0 for x in whole)
    base = [((x or 0) + 1) / (total + n) for x in whole]

    joined = first
    for key in ("declared", "suffix", "parent", "host"):
        joined = joined.join(level(key), F.col(key) == F.col(f"{key}_key"), "left").drop(f"{key}_key")
    none = F.array(*[F.lit(0.0)] * n)
    literal = [F.lit(x) for x in base]
    parent = _shares(F.coalesce("parent_n", none), literal, STRENGTH)
    joined = joined.withColumn("parent_share", parent)
    host = _shares(F.coalesce("host_n", none), [F.col("parent_share")[k] for k in range(n)], STRENGTH)
    joined = joined.withColumn("prior", host)
    # P(evidence | language) is P(language | evidence) / P(language) but for a factor that all languages share
    for key in ("declared", "suffix"):
        joined = joined.withColumn(f"{key}_share", _shares(F.coalesce(f"{key}_n", none), literal, STRENGTH))
    score = [
        F.coalesce(F.col("text_evidence")[k], F.lit(0.0)) + F.log(F.col("prior")[k])
        + F.log(F.col("declared_share")[k] / base[k]) + F.log(F.col("suffix_share")[k] / base[k])
        for k in range(n)
    ]
    joined = joined.withColumn("score", F.array(*score))
    joined = joined.withColumn("score", F.transform("score", lambda x: F.exp(x - F.array_max("score"))))
    joined = joined.withColumn("posterior", F.transform("score", lambda x: x / F.aggregate("score", F.lit(0.0), lambda a, b: a + b)))
    return joined.drop("score", "prior", "parent_share", "declared_share", "suffix_share", *[f"{key}_n" for key in keys], "parent")


def decided(rows: DataFrame, languages: list[str], least: float) -> DataFrame:
    """lang (null below ``least``, or if there is no text_evidence), confidence and text_lang from the posterior."""
    names = F.array(*[F.lit(x) for x in languages])
    best = F.array_max("posterior")
    at = F.array_position("posterior", best).cast("int")
    sure = (best >= least) & F.col("text_evidence").isNotNull()
    return (
        rows.withColumn("confidence", best)
        .withColumn("lang", F.when(sure, F.element_at(names, at)))
        # element_at takes a null place for one that cannot be null
        .withColumn("text_lang", F.when(F.col("guess").isNotNull(), F.element_at(names, F.col("guess").cast("int"))))
    )


def of_pages(pages: DataFrame, model: TextModel, least: float = LEAST) -> DataFrame:
    """Languages of ``pages`` (page_id, url, html): page_id, host, declared, text_lang, lang, confidence.

    A row for each input row. A null or empty page, or one without a letter, has no lang, and neither has any if the
    model knows no language. Of languages that are equally likely the first by name counts. Other columns are left out.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), declared_language(html).alias("declared"), visible_text(html).alias("shown"))
    if not model.languages:
        none = [F.lit(None).cast(kind).alias(name) for name, kind in (("text_lang", "string"), ("lang", "string"), ("confidence", "double"))]
        return rows.select("page_id", "host", "declared", *none)
    rows = rows.select("page_id", "host", "declared", suffix_of(F.col("host")).alias("suffix"), text_evidence(model)("shown").alias("text_evidence"))
    found = decided(fused(written(rows), model.languages), model.languages, least)
    return found.select("page_id", "host", "declared", "text_lang", "lang", "confidence")


def keep_known(documents: DataFrame, model: TextModel, least: float = LEAST) -> DataFrame:
    """The rows of ``documents``, all columns, whose language is known; the column ``lang`` is what is declared, and
    ``source`` the host. Texts without a letter are left out, and all if the model knows no language."""
    if not model.languages:
        return documents.filter(F.lit(False))
    rows = documents.select(
        F.struct(*documents.columns).alias("whole"),
        F.col("lang").alias("declared"),
        F.lit(None).cast("string").alias("suffix"),
        F.col("source").alias("host"),
        text_evidence(model)("text").alias("text_evidence"),
    )
    found = decided(fused(rows, model.languages), model.languages, least)
    return found.filter(F.col("lang").isNotNull()).select("whole.*")
