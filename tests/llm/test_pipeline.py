from __future__ import annotations

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.helpers import frame
from tests.llm.test_texts import groups
from tripmart.llm import privacy, quality
from tripmart.llm.tables import WORKER_MEMORY, prepared, read, written


def test_stages_apply_their_decisions(spark):
    docs = read(spark, SMALL, "documents")
    columns = docs.columns
    good = written(corpus_pipeline.good_texts(spark, docs, SMALL))
    scored = quality.classify(docs, read(spark, SMALL, "labels"))
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in scored.filter("predicted = 1").collect()}
    known = written(corpus_pipeline.known_languages(spark, good, SMALL))
    assert known.columns == columns and known.count() > 0.95 * good.count()
    one = written(corpus_pipeline.one_of_each(spark, known, SMALL))
    expected = groups([(r["doc_id"], r["text"]) for r in known.collect()], 5, 80, 100)
    assert {r["doc_id"] for r in one.collect()} == {i for i, (_, label) in expected.items() if i == label}
    safe = written(corpus_pipeline.without_private_data(spark, one, SMALL))
    assert safe.columns == columns and safe.count() == one.count()
    before = {r["doc_id"]: r["text"] for r in one.collect()}
    private = {r["doc_id"] for r in one.filter(privacy.has_entity(one["text"])).collect()}
    assert {r["doc_id"] for r in safe.collect() if r["text"] != before[r["doc_id"]]} == private
    packed = corpus_pipeline.sequences(spark, safe, SMALL)
    assert {r["doc_id"] for r in packed.collect()} == set(before)
    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, whole.select("doc_id", "piece", "start", "length", "ids_crc32").collect())) == sorted(
        map(tuple, packed.select("doc_id", "piece", "start", "length", "ids_crc32").collect())
    )


def test_stages_take_odd_rows(spark):
    docs = frame(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SMALL).count() == 0
        docs = written(out)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= docs.count()


def test_registered():
    import __spark_entry__ as contract

    names = contract.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1


def test_workers_give_memory_back(spark):
    def settings(batches):
        import os

        import pyarrow as pa

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"name": list(WORKER_MEMORY), "value": [os.environ.get(x) for x in WORKER_MEMORY]})

    found = prepared(spark).range(1, numPartitions=1).mapInArrow(settings, "name string, value string").collect()
    assert {row.name: row.value for row in found} == WORKER_MEMORY
