from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from fixtures import FOLDER, TINY, documents, texts
from tokenizers import Tokenizer

import public_tokenizers
from stakeline.llm import packing
from stakeline.llm.common import prepare, read


def brute_pieces(rows, capacity):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    found = []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            own = np.array(ids[at : at + capacity], "<u4").tobytes()
            found.append((doc_id, piece, at, len(own) // 4, zlib.crc32(own)))
    return found


def check_sequences(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("source", ["table", "odd"])
def test_pieces_and_places(spark, source):
    docs = read(spark, FOLDER, "documents") if source == "table" else documents(prepare(spark))
    rows = packing.pack(docs).collect()
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    want = brute_pieces([(r.doc_id, r.text) for r in docs.collect()], packing.CAPACITY)
    assert sorted(got, key=str) == sorted(want, key=str)
    used = check_sequences(rows, packing.CAPACITY)
    least = -(-sum(r.length for r in rows) // packing.CAPACITY)
    assert used <= least * 1.02 + 1


def test_sequences_hold_the_ids(spark):
    prepare(spark)
    rows = [(1, "a b c"), (2, "hello world " * 40), (3, None), (4, "\x01 marks \x1c and such")]
    packed = packing.pack(documents(spark, rows), capacity=16, keep_ids=True)
    check_sequences(packed.collect(), 16)
    held = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        own = held[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)]
        assert zlib.crc32(own) == r.ids_crc32 and len(own) == 4 * r.length


ODD = [
    "it's WE'LL née <|endoftext|> x",
    "don't 'S ''re rock'n'roll 12a3 ½²³ ªºµ ß ÿŸ × ÷ \xad soft",
    "ΑΣ Σ ß 12a ǅ İstanbul e\u0301 ﬁ １２ 漢字かな \U0001f600\u200d x",
    "\x00\x01\x1c\x1d\x1e\x1f \x7f \x85\xa0 \u2003wide\u3000 \u0301lone \u200b zero",
    "THE!! | a*** b### c$$$",
]


def test_ids_are_the_tokenizers(spark, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    encoder = packing.Encoder(packing.VOCABULARY)
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    rng = random.Random(1)
    rows = ODD * 2
    for top in (0x80, 0x100, 0x250, 0x3000, 0x11000):
        for _ in range(300):
            drawn = [rng.randrange(top) for _ in range(rng.randrange(40))]
            rows.append("".join(chr(c) for c in drawn if not 0xD800 <= c < 0xE000))
    rows += ["".join(rng.choices("aB' sS.,!1é\n", k=30)) for _ in range(500)]
    for text in rows:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, text


def brute_plan(counts, capacity):
    """Sequences of a pass over all items one by one, by the same rules."""
    large = sorted((n for n, k in counts.items() for _ in range(k) if 3 * n > capacity))
    gaps = []
    while large:
        item = large.pop()
        fitting = [x for x in large if x <= capacity - item]
        if fitting:
            large.remove(fitting[-1])
            item += fitting[-1]
        gaps.append(capacity - item)
    small = sorted((n for n, k in counts.items() for _ in range(k) if 3 * n <= capacity))
    while small:
        item = small.pop()
        fitting = [g for g in gaps if g >= item]
        best = min(fitting) if fitting else capacity
        if fitting:
            gaps.remove(best)
        gaps.append(best - item)
    return len(gaps)


@pytest.mark.parametrize("seed", range(60))
def test_plan_equals_one_pass_over_the_items(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 12, 30, 100])
    counts = {n: rng.randint(0, 12) for n in range(1, capacity + 1) if rng.random() < 0.5}
    plan = packing.Plan(counts, capacity)
    assert plan.sequences == brute_plan(counts, capacity)
    placed = defaultdict(list)
    seen = set()
    for length, begin, end, first, each, offset in plan.runs:
        for i in range(begin, end):
            assert i not in seen
            seen.add(i)
            at = offset + (i - begin) % each * length
            placed[first + (i - begin) // each].append((at, length))
    assert len(seen) == sum(counts.values())
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_ids_of_other_vocabularies(spark):
    docs = read(spark, TINY, "documents").select("doc_id", "text")
    name = "byte_bpe_50k.json"
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    encoder = packing.Encoder(name)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + texts()
    for _, text in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids
    packed = packing.pack(docs, vocabulary=name).groupBy("doc_id").sum("length").collect()
    counts = {r.doc_id: len(whole.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs.collect()}
    assert dict(map(tuple, packed)) == counts
    assert packing.Encoder(packing.VOCABULARY).known and not encoder.known
