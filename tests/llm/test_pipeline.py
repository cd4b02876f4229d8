from __future__ import annotations


import numpy as np
import pytest
from fixtures import DOC_DDL, FOLDER, documents
from test_packing import brute_pieces, check_sequences
from test_secret_scan import brute as brute_secrets
from test_simhash import brute_components, brute_print

import corpus_pipeline
from stakeline.llm import decontamination, quality_model
from stakeline.llm.common import prepare, read


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage is given, and the end result."""
    folder = tmp_path_factory.mktemp("stages")
    docs = read(spark, FOLDER, "documents")
    tables = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(folder / str(i)))
        docs = spark.read.parquet(str(folder / str(i)))
        tables.append(docs)
    return tables


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_keep_the_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    for table in stages[1:5]:
        assert table.dtypes == stages[0].dtypes


def test_the_classifier_rejects(spark, stages):
    docs = stages[0]
    model = quality_model.train(docs, read(spark, FOLDER, "labels"))
    good = {r.doc_id for r in quality_model.score(docs, model).collect() if r.predicted}
    assert {r.doc_id for r in stages[1].collect()} == good
    labels = {r.doc_id: r.quality for r in read(spark, FOLDER, "labels").collect()}
    wrong = np.mean([(i in good) != bool(q) for i, q in labels.items()])
    assert wrong < 0.03


def test_one_of_each_group_stays(stages):
    rows = pairs(stages[1])
    components = brute_components([(i, brute_print(t)) for i, t in rows])
    want = [r for r, c in zip(rows, components, strict=True) if r[0] == c]
    assert pairs(stages[2]) == want and len(want) < len(rows)


def test_no_benchmark_window_is_left(spark, stages):
    found = decontamination.find_contamination(stages[2], read(spark, FOLDER, "benchmark"))
    dirty = {r.doc_id for r in found.collect() if r.contaminated}
    assert dirty and pairs(stages[3]) == [r for r in pairs(stages[2]) if r[0] not in dirty]


def test_secrets_are_redacted(stages):
    before, after = dict(pairs(stages[3])), dict(pairs(stages[4]))
    assert before.keys() == after.keys() and any(brute_secrets(t) for t in before.values())
    for doc_id, text in after.items():
        assert not brute_secrets(text)
        if not brute_secrets(before[doc_id]):
            assert text == before[doc_id]


def test_everything_left_is_packed(stages):
    rows = stages[5].collect()
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got) == sorted(brute_pieces(pairs(stages[4]), 4096))
    check_sequences(rows, 4096)


def test_run_gives_the_same(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, FOLDER).select(*columns)
    assert got.exceptAll(stages[5].select(*columns)).isEmpty()
    assert got.count() == stages[5].count()


def test_odd_rows_pass_through(spark, tmp_path):
    prepare(spark)
    docs = documents(spark)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(i)))
        after = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert after.dtypes == docs.dtypes
        docs = after
    assert docs.select("ids_crc32").where("ids_crc32 IS NULL").isEmpty()


def test_empty_documents(spark):
    prepare(spark)
    docs = spark.createDataFrame([], DOC_DDL)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0
