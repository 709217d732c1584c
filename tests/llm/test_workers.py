import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from tripmart.llm import languages, packing, workers
from tripmart.llm.tables import prepared

WORDS = public_tokenizers.path("word_bpe_49k.json")


def kept_ids():
    return packing._ids_of.cache_info().currsize


def test_work_of_another_kind_drops_what_is_kept():
    packing._ids_of(WORDS, False)
    assert list(workers.task(iter, packing._ids_of)([1, 2])) == [1, 2]
    assert kept_ids() == 1
    assert list(workers.task(iter)([1, 2])) == [1, 2]
    assert kept_ids() == 0


def test_memory_is_given_back_at_the_end_of_a_task(monkeypatch):
    calls = []
    monkeypatch.setattr(workers, "give_back", lambda: calls.append(1))
    begun = workers.task(iter)([1, 2])
    next(begun)
    assert not calls
    begun.close()
    assert calls == [1]


def test_a_waiting_worker_holds_no_tokenizer_of_the_stage_before(spark):
    """One worker packs, and then tells languages, as in the pipeline."""

    def told(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"kept": [kept_ids()]})

    rows = prepared(spark).range(1, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit("some text of words").alias("text"))
    packing.cut(rows, WORDS, 64, 1).collect()
    model = languages.TextModel.from_counts({"a": languages.np.zeros(languages.BUCKETS)})
    rows.select(languages.text_evidence(model)("text")).collect()
    assert [r.kept for r in rows.mapInArrow(told, "kept long").collect()] == [0]


def test_places_are_worked_out_without_python_workers(spark):
    pieces = spark.createDataFrame([(1, 0, 0, 3, 5, 1)], "doc_id long, piece int, start long, length long, ids_crc32 long, row long")
    pieces = packing.written(pieces)
    plan = packing.place(pieces, 8)._jdf.queryExecution().toString()
    assert "ExistingRDD" not in plan and "LogicalRDD" not in plan
    assert packing.place(pieces, 8).select("sequence_id", "offset").collect() == [(0, 0)]
