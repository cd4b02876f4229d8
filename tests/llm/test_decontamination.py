from __future__ import annotations

import hashlib
import random
import re

import pytest
from fixtures import documents

from stakeline.llm import decontamination as dec
from stakeline.llm.common import prepare

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items):
    found, hit, named = split(text), set(), set()
    for item, item_text in items:
        own = split(item_text)
        n = min(len(own), 10)
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(found) - n + 1 if n else 0):
            if tuple(found[i : i + n]) in windows:
                hit.update(range(i, i + n))
                named.add(str(item))
    listed = ",".join(sorted(named))
    digest = hashlib.sha256(listed.encode()).hexdigest()
    return len(found), len(hit), len(named), digest, bool(hit)


def case(seed, short):
    rng = random.Random(seed)

    def some(n, vocabulary):
        return [rng.choice(vocabulary) for _ in range(n)]

    few, many = [f"t{i}" for i in range(3)], [f"W{i}é" for i in range(300)]
    items = [(i, " ".join(some(rng.randrange(10, 40), many))) for i in range(12)]
    items += [(50, " ".join(some(30, few))), (51, None), (52, "..."), (53, items[0][1])]
    if short:
        items += [(60, "W1é w2É, W3é"), (61, "solo"), (62, " ".join(some(9, many)))]
    docs = []
    for i in range(60):
        found = some(rng.randrange(60), many if i % 3 else few)
        for _ in range(rng.randrange(3)):
            own = split(rng.choice(items)[1])
            a = rng.randrange(max(len(own), 1))
            part = own[a : a + rng.choice([5, 9, 10, 11, 20])]
            at = rng.randrange(len(found) + 1)
            found[at:at] = [w.upper() if rng.random() < 0.2 and w.isascii() else w for w in part]
        docs.append((i, ", ".join(found)))
    docs += [(1000, None), (1001, ""), (None, docs[1][1]), (5, docs[1][1]), (5, docs[5][1])]
    return docs, items


@pytest.mark.parametrize("short", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_by_brute_force(spark, seed, short):
    prepare(spark)
    docs, items = case(seed, short)
    table = documents(spark, docs).repartition(4)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = [tuple(r) for r in dec.find_contamination(table, bench).collect()]
    want = [(i, *brute(t, items)) for i, t in docs]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert 0 < sum(w[-1] for w in want) < len(want)

    clean = dec.drop_contaminated(table, bench)
    assert clean.columns == table.columns
    left = [(r.doc_id, r.text) for r in clean.collect()]
    kept = [(i, t) for i, t in docs if not brute(t, items)[-1]]
    assert sorted(left, key=str) == sorted(kept, key=str)


def test_without_broadcast(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(dec, "sized", lambda df, most=0: df.hint("merge"))
    docs, items = case(3, True)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = [tuple(r) for r in dec.find_contamination(documents(spark, docs), bench).collect()]
    assert sorted(got, key=str) == sorted([(i, *brute(t, items)) for i, t in docs], key=str)


def test_a_line_of_all_items_makes_no_pairs(spark, monkeypatch):
    """300 items and 300 documents share a line: rows are hit windows, not items x documents."""
    prepare(spark)
    line = " ".join(f"instruction{k}" for k in range(14))
    items = [(i, f"{line} item{i} asks{i} for{i} more{i}") for i in range(300)]
    docs = [(i, f"before{i} {line} after{i} rest{i}") for i in range(300)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    seen = []
    original = dec._per_document

    def counted(rows, hits, lists):
        seen.append((hits.count(), lists.count()))
        return original(rows, hits, lists)

    monkeypatch.setattr(dec, "_per_document", counted)
    got = {tuple(r) for r in dec.find_contamination(documents(spark, docs), bench).collect()}
    assert got == {(i, *brute(t, items)) for i, t in docs}
    # Each of a document's five windows at most once per fingerprint kept inside of it.
    (hits, lists) = seen[0]
    assert hits <= 300 * 5 * 2 and lists <= 301


@pytest.mark.parametrize("items", [[], [(1, None), (2, "?!")]])
def test_benchmarks_without_words_hit_nothing(spark, items):
    prepare(spark)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents(spark)
    rows = dec.find_contamination(docs, bench).collect()
    assert len(rows) == docs.count() and not any(r.contaminated for r in rows)
    assert dec.drop_contaminated(docs, bench).count() == docs.count()


def test_plan_has_no_python(spark):
    prepare(spark)
    docs, items = case(1, False)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = dec.find_contamination(documents(spark, docs), bench)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
