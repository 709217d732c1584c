"""Small tables with all that may be odd in a column."""

from __future__ import annotations

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators might use for columns of their own.
CLASHING = "id key class label value rank salt range guard whole place found host declared n size a b u v surrogate".split()


def odd_rows():
    """Null and empty texts, a null id, repeated rows, two texts of one id, white space alone, and a long text."""
    long = " ".join(f"word{k % 977} the of {k}" for k in range(20_000))
    rows = [
        (1, "The cat sat on the mat and the dog sat on the log of the house.", "en", "a"),
        (2, None, None, None),
        (3, "", "en", "a"),
        (4, " \n\t ", "en", "b"),
        (5, "word", "en", None),
        (6, "The cat sat on the mat and the dog sat on the log of the house.", None, "a"),
        (None, "A text of no id, by nobody, in the city of the sun.", "en", "b"),
        (None, None, "en", "b"),
        (7, "Tied lines\nand  two spaces　wide ones 🙂 and émigrés", "fr", "b"),
        (7, "Tied lines\nand  two spaces　wide ones 🙂 and émigrés", "fr", "b"),
        (8, "one id", "en", "a"),
        (8, "two texts", "en", "a"),
        (9, long, "en", "a"),
    ]
    return [(*row, len(row[1]) if row[1] is not None else None) for row in rows]


def frame(spark, rows=None, clash=True):
    df = spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)
    for name in CLASHING if clash else ():
        df = df.withColumn(name, F.lit("x"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
