"""License notices by diagonal voting, in DataFrame operations only.

Every run of ``GRAM`` words of every text is joined by its hash to the places of such runs in license templates. A
hit votes for the diagonal ``place in the text - place in the template``: a notice that is quoted word for word puts
all its votes on one diagonal, one with words added or left out on neighbouring diagonals. Neighbours that follow
each other in the text are merged to a span, and a span counts if enough of the template is found in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.tables import written

#: Words to a run.
GRAM = 2
#: Diagonals this close belong together if their hits are at most REACH words apart.
NEAR, REACH = 3, 4
#: Share of a template's runs that a span needs.
ENOUGH = 0.75

# Base phrases, and the wording of common notices. Words as the scan sees them.
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("reserved", "all rights reserved"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so",
    ),
    (
        "apache",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0",
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
        "as published by the free software foundation",
    ),
    (
        "bsd",
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but "
        "not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    ),
)

_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Runs that all templates may have together: their hashes are a list in the plan, and the templates are broadcast.
MOST_RUNS = 10_000


def template_runs(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Runs of the templates: template, label, is_base, size (runs in the template), at, run_hash, a, b."""
    rows = []
    if sum(text.count(" ") for _, text in (*phrases, *notices)) > MOST_RUNS:
        raise ValueError(f"the templates have more than {MOST_RUNS} runs")
    for number, (label, text) in enumerate((*phrases, *notices)):
        found = text.split()
        for at, (a, b) in enumerate(zip(found, found[1:])):
            rows.append((number, label, number < len(phrases), len(found) - 1, at, a, b))
    runs = spark.createDataFrame(rows, "template int, label string, is_base boolean, size int, at int, a string, b string")
    return runs.withColumn("run_hash", F.xxhash64("a", "b"))


def runs_of(df: DataFrame, templates: DataFrame) -> DataFrame:
    """Runs of the texts whose hash some template has: doc_id, text_hash, place, run_hash. A last row of each text, without
    run_hash, has the number of its words as place. Each text is cut into words once.

    Words are hashed in lower case, which also changes letters beyond ASCII; none of them becomes an ASCII one, as the
    Kelvin sign is replaced first, so they meet no template's word.
    """
    hashes = [row["run_hash"] for row in templates.select("run_hash").distinct().collect()]  # at most MOST_RUNS
    text = F.replace(F.coalesce("text", F.lit("")), F.lit("\u212a"), F.lit("\u0138"))
    words = df.select("doc_id", F.xxhash64("text").alias("text_hash"), F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)).alias("words"))
    runs = F.zip_with("words", F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))), lambda a, b: F.xxhash64(F.lower(a), F.lower(b)))
    placed = words.select("doc_id", "text_hash", F.posexplode(F.array_append(runs, F.lit(None).cast("long"))).alias("place", "run_hash"))
    return placed.filter(F.col("run_hash").isNull() | F.col("run_hash").isin(hashes))


def spans(found: DataFrame, longest: int) -> DataFrame:
    """Merge hits to spans: doc_id, text_hash, template, label, is_base, first_word, end_word, share of the template.

    The share counts different runs of the template, as bits of masks: one that is found twice is one. ``longest`` is
    the most runs of a template. A base phrase needs all its runs on one diagonal; its neighbours aren't merged.
    """
    names = ["doc_id", "text_hash", "template", "label", "is_base", "size"]
    masks = [f"mask{j}" for j in range(longest // 62 + 1)]
    bit = F.expr("shiftleft(1L, CAST(at % 62 AS INT))")
    diagonals = (
        found.withColumn("diagonal", F.col("place") - F.col("at"))
        .groupBy(*names, "diagonal")
        .agg(
            *(F.bit_or(F.when(F.floor(F.col("at") / 62) == j, bit).otherwise(0)).alias(mask) for j, mask in enumerate(masks)),
            F.min("place").alias("low"), F.max("place").alias("high"),
        )
    )
    within = Window.partitionBy("doc_id", "text_hash", "template").orderBy("low", "diagonal")
    apart = (
        F.col("is_base")
        | (F.abs(F.col("diagonal") - F.lag("diagonal").over(within)) > NEAR)
        | (F.col("low") - F.max("high").over(within.rowsBetween(Window.unboundedPreceding, -1)) > REACH)
    )
    merged = (
        diagonals.withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("apart").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*names, "span")
        .agg(*(F.bit_or(mask).alias(mask) for mask in masks), F.min("low").alias("first_word"), (F.max("high") + GRAM).alias("end_word"))
        .withColumn("share", sum((F.bit_count(mask) for mask in masks), F.lit(0)) / F.col("size"))
    )
    return merged.filter(F.col("share") >= F.when(F.col("is_base"), 1.0).otherwise(ENOUGH)).drop("size", "span", *masks)


def scan(df: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """License notices in the texts of ``df`` (doc_id, text), a row for each input row: doc_id, n_words, n_base,
    first_word and last_word (of base phrases, or null), base_labels, labels, score (largest share of a template).

    A null or empty text has no words and score 0. Rows with a null or repeated doc_id each get their own result.
    Other columns are left out.
    """
    templates = template_runs(df.sparkSession, phrases, notices)
    longest = max((text.count(" ") for _, text in (*phrases, *notices)), default=0)
    runs = written(runs_of(df.select("doc_id", "text"), templates))
    named = templates.withColumnRenamed("run_hash", "its_hash")
    found = runs.filter(F.col("run_hash").isNotNull()).join(F.broadcast(named), F.col("run_hash") == F.col("its_hash"))
    found = spans(found.drop("run_hash", "its_hash", "a", "b"), longest)
    base = F.col("is_base")
    label_if_base = F.when(base, F.col("label"))
    results = (
        found.groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("its_hash"))
        .agg(
            F.count(label_if_base).alias("n_base"),
            F.min(F.when(base, F.col("first_word"))).alias("first_word"),
            F.max(F.when(base, F.col("first_word"))).alias("last_word"),
            F.array_join(F.sort_array(F.collect_set(label_if_base)), ",").alias("base_labels"),
            F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
            F.max("share").alias("score"),
        )
    )
    counts = runs.filter(F.col("run_hash").isNull()).select("doc_id", "text_hash", F.col("place").cast("long").alias("n_words"))
    joined = counts.join(results, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("its_hash")), "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _sql() -> str:
    templates = ",\n    ".join(
        f"({k}, '{label}', {str(k < len(PHRASES)).lower()}, '{text}')" for k, (label, text) in enumerate((*PHRASES, *NOTICES))
    )
    return f"""
WITH templates(template, label, is_base, phrase) AS (VALUES
    {templates}),
template_words AS (
  SELECT template, label, is_base, string_split(phrase, ' ') AS w FROM templates),
runs AS (
  SELECT template, label, is_base, len(w) - 1 AS size, i AS spot, w[i + 1] AS a, w[i + 2] AS b
  FROM template_words, unnest(range(len(w) - 1)) AS t(i)),
docs AS (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
doc_runs AS (
  SELECT doc_id, i AS place, w[i + 1] AS a, w[i + 2] AS b
  FROM docs, unnest(range(greatest(len(w) - 1, 0))) AS t(i)),
diagonals AS (
  SELECT doc_id, template, label, is_base, size, place - spot AS diagonal,
         min(place) AS low, max(place) AS high
  FROM doc_runs JOIN runs USING (a, b)
  GROUP BY ALL),
marked AS (
  SELECT *, CASE WHEN is_base THEN 1
                 WHEN abs(diagonal - lag(diagonal) OVER o) <= {NEAR}
                      AND low - max(high) OVER (PARTITION BY doc_id, template ORDER BY low, diagonal
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {REACH} THEN 0
                 ELSE 1 END AS apart
  FROM diagonals WINDOW o AS (PARTITION BY doc_id, template ORDER BY low, diagonal)),
numbered AS (
  SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY low, diagonal
                             ROWS UNBOUNDED PRECEDING) AS span FROM marked),
hits AS (
  SELECT doc_id, template, place - spot AS diagonal, spot FROM doc_runs JOIN runs USING (a, b)),
spans AS (
  SELECT doc_id, template, label, is_base, min(low) AS first_word, count(DISTINCT spot)::DOUBLE / size AS share
  FROM numbered JOIN hits USING (doc_id, template, diagonal) GROUP BY doc_id, template, label, is_base, size, span
  HAVING count(DISTINCT spot)::DOUBLE / size >= CASE WHEN is_base THEN 1.0 ELSE {ENOUGH} END),
results AS (
  SELECT doc_id, count(*) FILTER (is_base) AS n_base,
         min(first_word) FILTER (is_base) AS first_word, max(first_word) FILTER (is_base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM spans GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM docs LEFT JOIN results USING (doc_id)
"""


SQL = _sql()
