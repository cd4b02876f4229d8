from __future__ import annotations

import zlib

import numpy as np
import pytest
from fixtures import FOLDER, documents

from stakeline.llm import quality_model as model
from stakeline.llm.common import prepare, read, token_hashes


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = read(spark, FOLDER, "documents"), read(spark, FOLDER, "labels")
    trained = model.train(docs, labels)
    rows = model.score(docs, trained).join(labels, "doc_id", "left").collect()
    return trained, rows


def test_held_out_accuracy(scored):
    rows = [r for r in scored[1] if r.held_out and r.quality is not None]
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_columns_follow_the_contract(scored):
    for r in scored[1]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_held_out_labels_are_not_used(spark, scored):
    docs, labels = read(spark, FOLDER, "documents"), read(spark, FOLDER, "labels")
    turned = labels.selectExpr(
        "doc_id",
        "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality"
        " ELSE quality END AS quality",
    )
    _, network = model.train(docs, turned)
    for got, want in zip(
        (network.first, network.second), (scored[0][1].first, scored[0][1].second), strict=True
    ):
        assert np.allclose(got, want)


def test_odd_rows_get_scores(spark, scored):
    docs = documents(spark)
    rows = model.score(docs, scored[0]).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r.score for r in rows}
    assert by_id[1] == by_id[2] == by_id[3]
    assert by_id[4] == by_id[5]
    kept = model.keep_good(docs, scored[0])
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in rows)


def test_repeated_ids_count_once(spark, monkeypatch):
    prepare(spark)
    rows = [(i, f"some words number {i} of a text") for i in range(40)]
    rows += [(7, f"another text {i % 3} under one id") for i in range(60)] + [(7, None)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    given = []
    monkeypatch.setattr(model, "fit", lambda x, y: given.append((x, y)))
    vectors, _ = model.train(docs, labels)
    model.train(docs.repartition(5), labels)
    (x, y), again = given
    learnt = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    assert 7 in learnt and len(x) == len(y) == len(learnt)
    assert np.array_equal(x, again[0]) and np.array_equal(y, again[1])
    assert model.train(docs, labels, sample=9) and len(given[2][0]) == 9


@pytest.mark.parametrize(("labels", "want"), [([], 0.5), ([(4, 1), (9, 1)], 1.0)])
def test_labels_that_teach_nothing(spark, labels, want):
    prepare(spark)
    docs = documents(spark)
    found = model.train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    assert {r.score for r in model.score(docs, found).collect()} == {want}


def test_word_vectors_by_brute_force(spark):
    prepare(spark)
    texts = ["a b c a", "b , b", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    tokens, owner = token_hashes([t.encode() for t in texts])
    sums = np.zeros((model.ROWS, model.WIDTH))
    seen = np.zeros(model.ROWS)
    drawn = model.mix(tokens)

    def index(i):
        vector = np.zeros(model.WIDTH)
        for k in range(model.NONZERO):
            bits = int(drawn[i]) >> 8 * k
            vector[bits % model.WIDTH] += 1 if bits & 128 else -1
        return vector

    for i in range(len(tokens)):
        seen[int(tokens[i]) % model.ROWS] += 1
        for j in range(len(tokens)):
            if i != j and owner[i] == owner[j] and abs(i - j) <= model.REACH:
                sums[int(tokens[i]) % model.ROWS] += index(j)
    used = seen > 0
    want = sums[used] / seen[used][:, None] - sums.sum(axis=0) / seen.sum()
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    got = model.word_vectors(rows)
    assert np.allclose(got[used], want, atol=1e-5) and not got[~used].any()


def test_steps_do_not_show(monkeypatch):
    tokens, owner = token_hashes([b"a b c d e f g " * 9, b"x y z " * 5, b"", b"one"])
    whole, parts = (np.zeros(model.ROWS * model.WIDTH, np.int64) for _ in range(2))
    model._accumulate(whole, tokens, owner)
    monkeypatch.setattr(model, "STEP", 5)
    model._accumulate(parts, tokens, owner)
    assert whole.any() and (whole == parts).all()


def test_token_hashes_depend_on_the_token_only():
    long = (b"word " * 1_200_000) + b"***end"
    tokens, owner = token_hashes([b"word, end", long, b"", b"*** word"])
    assert [int((owner == i).sum()) for i in range(4)] == [3, 1_200_002, 0, 2]
    own = tokens[owner == 1]
    assert len(np.unique(own)) == 3 and own[0] == tokens[0] == tokens[-1]
    assert own[-1] == tokens[2] and own[-2] == tokens[-2]


def test_columns_of_any_name(spark, scored):
    docs = read(spark, FOLDER, "documents").limit(300)
    labels = read(spark, FOLDER, "labels")
    odd = docs.selectExpr("*", *[f"'own' AS {n}" for n in ("__id", "__y", "__order", "__text", "y", "x")])
    plain, wide = (model.train(d, labels) for d in (docs, odd))
    kept = model.keep_good(odd, wide)
    assert kept.columns == odd.columns
    same = model.keep_good(docs, plain)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in same.collect()}
