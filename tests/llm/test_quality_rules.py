from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from fixtures import FOLDER, documents

from stakeline.llm import quality_rules as rules
from stakeline.llm.common import prepare, read

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    found = WORD.findall(text)
    windows = Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    repeated = {
        k
        for i in range(len(found) - 7)
        if windows[tuple(found[i : i + 8])] > 1
        for k in range(i, i + 8)
    }
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            duplicates += line in seen
            seen.add(line)
    return (
        len(found),
        sum(map(len, found)),
        len(re.findall(r"[#*$%&|<>]", text)),
        duplicates,
        len(repeated),
    )


@pytest.mark.parametrize("source", ["table", "odd"])
def test_counts_and_base_rules(spark, source):
    docs = read(spark, FOLDER, "documents") if source == "table" else documents(prepare(spark))
    good = read(spark, FOLDER, "labels").where("quality = 1")
    found = rules.judge(docs, good).collect()
    got, want = [], []
    for r in found:
        got.append((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words))
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed
        assert r.kept == (not failed and r.score >= rules.THRESHOLD)
    for r in docs.collect():
        want.append((r.doc_id, *brute(r.text)))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_clean_documents_stay_and_junk_goes(spark):
    docs, labels = read(spark, FOLDER, "documents"), read(spark, FOLDER, "labels")
    judged = rules.judge(docs, labels.where("quality = 1")).where("NOT base_failed")
    texts = {r.doc_id: r.text for r in docs.collect()}
    junk = re.compile(r"\*\*\*|\$\$\$|!!| \| ")
    for r in judged.collect():
        assert r.kept != bool(junk.search(texts[r.doc_id])), (r.doc_id, r.score)


def test_repeats_by_brute_force():
    rng = random.Random(6)
    for _ in range(400):
        found = [rng.choice("abc") for _ in range(rng.randrange(60))]
        if rng.random() < 0.5:
            found = found + [str(k) for k in range(rng.randrange(30))] + found[:20]
        text = " ".join(found)
        assert rules.repeated_words([w.encode() for w in found]) == brute(text)[4]


def test_repeats_among_many_distinct_words():
    found = [f"w{i}".encode() for i in range(40_000)]
    assert rules.repeated_words(found + found[:10]) == 20
    assert rules.repeated_words(found) == 0


def test_ratios_are_of_the_whole_corpus(spark):
    prepare(spark)
    docs = documents(spark, [(1, "a b a"), (1, "a b a"), (2, "c"), (3, None)]).repartition(3)
    trusted = spark.createDataFrame([(1,), (1,), (9,)], "doc_id bigint")
    got = rules.log_ratios(docs.select("doc_id", "text"), trusted, "doc_id", "text")
    raw, owner = rules._gram_buckets([b"a b a", b"a b a", b"c"])
    counts = np.bincount(raw, minlength=rules.BUCKETS)
    target = np.bincount(raw[owner < 2], minlength=rules.BUCKETS)
    expected = target.sum() * counts / counts.sum()
    assert np.allclose(got, np.log((target + 100) / (expected + 100)))


def test_without_trusted_documents_only_the_base_rules_decide(spark):
    prepare(spark)
    none = spark.createDataFrame([], "doc_id bigint")
    rows = rules.judge(documents(spark), none).collect()
    assert {r.score for r in rows} == {0.0} and all(r.kept != r.base_failed for r in rows)
