from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from fixtures import FOLDER, documents

from stakeline.llm import simhash
from stakeline.llm.common import prepare, read
from stakeline.llm.components import connected_components


def brute_print(text):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    grams = [b" ".join(found[i : i + 3]) for i in range(max(len(found) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """A number for every row's group, over all pairs."""
    leader = list(range(len(prints)))

    def lead(x):
        while leader[x] != x:
            x = leader[x]
        return x

    bits = np.array([p for _, p in prints], np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= 2) + i + 1:
            leader[lead(int(j))] = lead(i)
    return [lead(i) for i in range(len(prints))]


def brute_components(prints):
    """Least id reachable for every row."""
    groups, least = brute_groups(prints), {}
    for (doc_id, _), g in zip(prints, groups, strict=True):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    return [least.get(g) for g in groups]


def check(found, rows):
    prints = [(i, brute_print(t)) for i, t in rows]
    want = [
        (i, f"{p:016x}", c) for (i, p), c in zip(prints, brute_components(prints), strict=True)
    ]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in found.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_whole_table(spark):
    docs = read(spark, FOLDER, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(simhash.near_duplicates(docs), rows)


def test_odd_rows(spark):
    prepare(spark)
    docs = documents(spark)
    check(simhash.near_duplicates(docs), [(r.doc_id, r.text) for r in docs.collect()])


def test_tree_finds_all_within_the_radius():
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    members = set()
    for _ in range(400):
        flipped = centre
        for bit in rng.sample(range(64), rng.randrange(6)):
            flipped ^= 1 << bit
        members.add(flipped)
    tree = simhash.Tree()
    for m in members:
        tree.add(m)
    for m in list(members)[:50]:
        want = {x for x in members if (x ^ m).bit_count() <= 2}
        assert set(tree.near(m, 2)) == want


@pytest.mark.parametrize("most", [4, 4096])
def test_links_join_up_the_same_groups_when_shards_are_crowded(spark, monkeypatch, most):
    prepare(spark)
    monkeypatch.setattr(simhash, "MOST_MEMBERS", most)
    rng = random.Random(5)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(30):
            flipped = centre
            for bit in rng.sample(range(64), rng.randrange(5)):
                flipped ^= 1 << bit
            prints.add(flipped)
    ordered = sorted(prints)
    signed = np.array(ordered, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint bigint")
    found = connected_components(simhash._links(df, 2)).collect()
    group = {r.node: r.component for r in found}
    want = brute_components([(i, p) for i, p in enumerate(ordered)])
    got = {}
    for p, w in zip(signed, want, strict=True):
        got.setdefault(group.get(p, p), set()).add(w)
    assert all(len(v) == 1 for v in got.values()) and len(got) == len(set(want))


def test_components_of_a_long_path(spark):
    n = 300
    order = random.Random(2).sample(range(n), n)
    edges = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (7, 7)]
    found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    want = {**dict.fromkeys(range(n), 0), 1000: 1000, 1001: 1000}
    assert {r.node: r.component for r in found} == want


def test_one_of_each_group_stays(spark):
    prepare(spark)
    docs = documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    prints = [brute_print(t) for _, t in rows]
    assert not any(
        (a ^ b).bit_count() <= 2 for i, a in enumerate(prints) for b in prints[:i]
    )
    every = [(r.doc_id, r.text) for r in docs.collect()]
    assert len(rows) == len(set(brute_groups([(i, brute_print(t)) for i, t in every])))
    assert (1, None) in rows or (1, "") in rows
    assert (4, every[3][1]) in rows and 5 not in dict(rows)


def test_shingles_in_steps(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(500)).encode()
    whole = simhash.fingerprint(text, 3)
    monkeypatch.setattr(simhash, "STEP", 64)
    assert simhash.fingerprint(text, 3) == whole == brute_print(text.decode())


def test_kept_documents_keep_all_columns(spark):
    prepare(spark)
    names = ("__text_hash", "text_hash", "__id", "__hash", "kept", "n", "group", "id")
    docs = documents(spark, [(1, "a b c d"), (2, "a b c d"), (1, "a b c d"), (3, "other")]).drop("id")
    docs = docs.selectExpr("*", *[f"'own' AS {name}" for name in names])
    rows = simhash.keep_one(docs).collect()
    assert sorted(r.doc_id for r in rows) == [1, 3]
    assert all(r[name] == "own" for r in rows for name in names)
