from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures import TINY, documents, texts

from stakeline.llm import common, phrases
from stakeline.llm.common import read

UPPER = {c: c + 32 for c in range(65, 91)}


def spoken(text):
    for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
        yield [w for w in re.split(r"[ \t]+", piece) if w]


def counted(rows):
    counts, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for found in spoken(text):
            words[lang] += len(found)
            for n in range(1, 5):
                for i in range(len(found) - n + 1):
                    counts[lang][tuple(found[i : i + n])] += 1
    return counts, words


def brute(rows, least, listed):
    counts, words = counted(rows)
    out = []
    for lang, f in counts.items():
        covered = set()
        for longer, places in f.items():
            for n in range(2, len(longer)):
                for i in range(len(longer) - n + 1):
                    part = longer[i : i + n]
                    if places >= least and 100 * places >= 80 * f[part]:
                        covered.add(part)
        kept = []
        for phrase, a in f.items():
            if len(phrase) < 2 or a < least or phrase in covered:
                continue
            cuts = [(f[phrase[:k]], f[phrase[k:]]) for k in range(1, len(phrase))]
            score, k = min((2_000_000 * a // (left + right), k) for k, (left, right) in enumerate(cuts))
            kept.append((-score, -a, " ".join(phrase).encode(), *cuts[k]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:listed], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return out


def check(docs, rows, least=30, listed=2000, **more):
    got = [tuple(r) for r in phrases.collocations(docs, least, listed, **more).collect()]
    want = brute(rows, least, listed)
    assert sorted(got) == sorted(want)
    return got


def test_whole_table(spark):
    docs = read(spark, TINY, "documents")
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    found = phrases.collocations(docs)
    assert found.dtypes == [
        ("lang", "string"), ("rank", "bigint"), ("phrase", "string"), ("a", "bigint"),
        ("l", "bigint"), ("r", "bigint"), ("n", "bigint"), ("score", "bigint"),
    ]
    assert sorted(tuple(r) for r in found.collect()) == sorted(brute(rows, 30, 2000))


def random_rows(seed, n=300):
    rng = random.Random(seed)
    vocabulary = ["New", "york", "times", "the", "of", "ÉTÉ", "a\xa0b", "x", "y"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(12)):
            word = rng.choice(vocabulary)
            parts.append("new york Times square" if rng.random() < 0.2 else word)
            parts.append(rng.choice([" ", "  ", "\t", " ", ". ", ",", "\n", "\x0b", "\x1c"]))
        rows.append((rng.choice(["en", "de", None, "und"]), "".join(parts)))
    return rows


@pytest.mark.parametrize("shards", [1, 2, 3])
def test_random_rows(spark, shards):
    rows = random_rows(shards)
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = check(docs, rows, least=7, listed=40, shards=shards)
    assert {r[0] for r in got} == {"en", "de", "und"}
    assert any(len(r[2].split(" ")) == 4 for r in got)


def test_full_slots_and_small_buffers(spark, monkeypatch):
    """Every slot shared by many phrases, texts cut into many parts: the same result."""
    monkeypatch.setattr(phrases, "SLOTS", 4)
    monkeypatch.setattr(phrases, "HELD_BYTES", 100)
    rows = random_rows(8, 200) + [("en", " ".join(t for _, t in random_rows(9, 200)))]
    docs = spark.createDataFrame(rows, "lang string, text string")
    check(docs, rows, least=7, listed=40, shards=2)


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(common, "PIECE_BYTES", 64)
    rng = random.Random(5)
    text = " ".join("w" * rng.randrange(1, 9) + str(i) for i in range(300)) + " " + "z" * 500 + " end"
    seen = []
    for ((_, part, leading),) in phrases._parts([text.encode()]):
        begins, ends = phrases._words(np.frombuffer(part, np.uint8))
        found = [part[a:b].decode() for a, b in zip(begins, ends, strict=True)]
        assert not leading or found[:leading] == seen[-leading:]
        seen += found[leading:]
    assert seen == text.split(" ")


def test_odd_rows(spark):
    docs = documents(spark, texts())
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    assert any(r[2] == "say say say say" for r in check(docs, rows))


def test_repeated_rows_and_ties(spark):
    rows = [("en", "b c")] * 31 + [("en", "a c")] * 31 + [("en", "c b")] * 29
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = check(docs, rows)
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == ["a c", "b c"]


def test_frequent_phrases(spark):
    rows = random_rows(4)
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = {(r.lang, r.phrase): r.places for r in phrases.frequent_phrases(docs, 9).collect()}
    counts, _ = counted(rows)
    assert got == {
        (lang, " ".join(p)): c for lang, f in counts.items() for p, c in f.items() if c >= 9
    }


def test_score_beyond_64_bits(spark):
    """The expression of the share holds for counts whose product needs more than 64 bits."""
    row = spark.sql(
        "SELECT 8000000000000000000L AS a, 8000000000000000000L AS l, 8500000000000000000L AS r"
    ).selectExpr(f"{phrases.SHARE} AS s").first()
    assert row.s == 2_000_000 * 8 * 10**18 // (16_500_000_000_000_000_000)


def test_empty_table(spark):
    assert phrases.collocations(documents(spark, [])).collect() == []
    assert phrases.collocations(documents(spark, [(1, None), (2, " .,")])).collect() == []


def test_scans_read_what_is_stored_once(spark, monkeypatch):
    """What a scan reads of earlier ones does not grow with their number."""
    stage, read = phrases.stage_table, []

    def watch(df, name, *rest, **options):
        if name == "likely":
            read.append(df._jdf.queryExecution().analyzed().toString().count("Relation "))
        return stage(df, name, *rest, **options)

    monkeypatch.setattr(phrases, "stage_table", watch)
    docs = spark.createDataFrame(random_rows(3, 100), "lang string, text string")
    phrases.frequent_phrases(docs, 7, shards=3)
    # Counts, the list before, and phrases found.
    assert read[0] == 1 and len(read) > 3 and set(read[1:]) == {3}


def test_short_lists_take_few_tasks(spark, monkeypatch):
    """Between two scans, a short list is written by one task, whatever the number of slices."""
    stage, files = phrases.stage_table, []

    def watch(df, name, *rest, **options):
        stored = stage(df, name, *rest, **options)
        if name == "likely" or name.startswith("step=") and "slot" in stored.columns:
            files.append(len(stored.inputFiles()))
        return stored

    monkeypatch.setattr(phrases, "stage_table", watch)
    docs = spark.createDataFrame(random_rows(7, 150), "lang string, text string")
    settings = {
        "spark.sql.shuffle.partitions": "31",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        phrases.frequent_phrases(docs, 7, shards=1)
        assert len(files) > 4 and set(files) == {1}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_scanned_parts_are_small():
    text = b"some words " * 100_000
    parts = list(phrases._parts([text, b"a b"]))
    assert max(len(part) for held in parts for _, part, _ in held) <= 1 << 17


def test_counts_are_moved_and_stored_as_arrays(spark, monkeypatch):
    """What a scan stores is a few rows for each bucket, however many phrases it counts."""
    stage, rows, phrase_rows = phrases.stage_table, [], []

    def watch(df, name, *rest, **options):
        stored = stage(df, name, *rest, **options)
        if name.startswith("step=") and "slot" not in stored.columns:
            rows.append(stored.count())
            phrase_rows.append(stored.selectExpr("sum(octet_length(lasts)) DIV 8").first()[0])
        return stored

    monkeypatch.setattr(phrases, "stage_table", watch)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    docs = [("en", " ".join(rng.choices(words, k=60))) for _ in range(200)]
    check(spark.createDataFrame(docs, "lang string, text string"), docs, least=4, shards=2)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(rows) <= 4 * buckets
    assert max(phrase_rows) > 20 * max(rows)


def scanned(texts, langs, bounds):
    """Stored counts of some texts with all phrases open, by the functions of a scan's tasks."""
    reached = np.ones(phrases.SLOTS, np.uint8)
    names = sorted(set(langs))
    tongues = np.array([names.index(x) for x in langs])
    batches = []
    for at in (slice(0, 2), slice(2, None)):
        held, own = phrases._Held(), [t.encode() for t in texts[at]]
        for part in phrases._parts(own):
            phrases._scan(part, tongues[at].astype(np.uint64), tongues[at], reached, 1, 4, held)
        batches += held.rows(names, bounds)
    found = [r for b in batches for r in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True)]
    assert len(set(found)) < len(found)
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (r["bucket"], r["n"], r["lang"] or ""))
    batch = phrases.pa.RecordBatch.from_pylist(rows, schema=phrases._PACKED_SCHEMA)
    halves = [batch.slice(0, 3), batch.slice(3)]
    return [phrases._summed(n, lang, g, 2) for (_, n, lang), g in phrases._buckets(iter(halves))]


def test_arrays_of_counts(monkeypatch):
    """Words and phrases of tasks are added up bucket by bucket, also with equal 64-bit names."""
    texts = ["a b a b ü", "a b c", "b a b a", "ü ü ü, a"]
    langs = ["en", "de", "en", "de"]
    want, _ = counted(zip(langs, texts, strict=True))
    for same in (False, True):
        if same:
            # All names of words and of phrases are equal.
            monkeypatch.setattr(phrases, "_joined", lambda head, last: head * np.uint64(0))
        bounds = np.array([1 << 62, 1 << 63, 3 << 62], np.uint64)
        got, pairs, often = Counter(), Counter(), Counter()
        for stored in scanned(texts, langs, bounds):
            row = stored.to_pylist()[0]
            places = np.frombuffer(row["places"], f"u{len(row['places']) * 8 // len(row['lasts'])}")
            assert row["total"] == places.sum()
            often[row["n"]] += row["often"]
            assert row["often"] == len(row["often_lasts"]) // 8 == np.count_nonzero(places >= 2)
            if row["n"] == 1:
                pick = np.arange(len(places))
                words = phrases._strings(
                    phrases.pa.py_buffer(row["sizes"]), phrases.pa.py_buffer(row["words"]), pick
                )
                for word, k in zip(words.to_pylist(), places.tolist(), strict=True):
                    got[row["lang"], word] += k
            else:
                heads, lasts = (np.frombuffer(row[c], np.uint64) for c in ("heads", "lasts"))
                for key in zip(heads.tolist(), lasts.tolist(), strict=True):
                    assert (row["n"], *key) not in pairs
                    pairs[row["n"], *key] = 1
        assert got == {(x, p[0]): k for x, f in want.items() for p, k in f.items() if len(p) == 1}
        assert sum(k for n, *_ in pairs for k in [n == 2]) == sum(
            len(p) == 2 for f in want.values() for p in f
        )


def test_words_with_one_name_stay_apart():
    last = np.array([7, 9, 7, 7], np.uint64)
    data = np.frombuffer(b"abcabzab", np.uint8)
    name, places, sizes, words = phrases._added_words(
        last, np.array([1, 2, 3, 4]), np.array([2, 2, 2, 2]), data
    )
    found = dict(zip([words.tobytes()[i : i + 2] for i in range(0, 6, 2)], places.tolist(), strict=True))
    assert name.tolist() == [7, 7, 9] and found == {b"ab": 5, b"bz": 3, b"ca": 2}


def test_bitmap_of_wanted_phrases(spark):
    rng = random.Random(2)
    keys = [(2, rng.getrandbits(64) - (1 << 63), rng.getrandbits(64) - (1 << 63)) for _ in range(500)]
    rows = spark.createDataFrame(keys, "n int, head long, last long")
    for bits in (15, 20):
        bitmap = phrases._wanted(rows, bits)
        set_bits = np.flatnonzero(np.unpackbits(bitmap, bitorder="little")).tolist()
        mask = (1 << 64) - 1
        assert set_bits == sorted(
            {(((h & mask) >> 1) ^ (x & mask)) >> (64 - bits) for _, h, x in keys}
        )


def test_scans_leave_no_shuffle_files(spark):
    """Shuffles of the scans go when they are read; the setting for that ends with the scans."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()

    def shuffles():
        return sum(b.isShuffle() for b in conversion(blocks.diskBlockManager().getAllBlocks()))

    conversion = lambda found: [found.apply(i) for i in range(found.size())]
    before, setting = shuffles(), spark.conf.get(phrases.CLEANUP, None)
    docs = spark.createDataFrame(random_rows(5, 200), "lang string, text string")
    found = phrases.frequent_phrases(docs, 7)
    assert shuffles() <= before + 4
    assert spark.conf.get(phrases.CLEANUP, None) == setting
    assert found.count()
