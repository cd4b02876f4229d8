"""Quality rules: word counts and repeats, and a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed token 1-grams and 2-grams are counted over the whole corpus: one of
all documents (raw), one of the trusted ones (target). A document's score is the mean of
log(target share / raw share) over its n-grams, so length cancels out. A document passes if its
score reaches a fixed threshold; the decision is the same at every corpus size and run.

Null texts have no words; texts without n-grams score 0. Texts are read whole. Repeated rows
count as often as they occur. Without trusted documents every score is 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stakeline.llm.common import as_bytes, batch, mix, sized, token_hashes

# 1-grams and 2-grams share the buckets. The two count tables are all that is gathered.
BUCKETS = 1 << 14
# Counts added to every bucket of the target, spread like the raw corpus: a bucket that holds few
# n-grams says little, so small corpora do not condemn documents for their rare words.
PRIOR_COUNT = 100
# Mean log ratio below which a document reads unlike the trusted text.
THRESHOLD = -0.2

LEAST_WORDS = 20
WINDOW = 8
MOST_REPEATED_PERCENT = 30
# Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_WHITE = b"\t\n\x0b\x0c\r "


def _gram_buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all 1-grams and 2-grams, and the text each belongs to."""
    tokens, owner = token_hashes(texts)
    follow = owner[1:] == owner[:-1]
    pairs = mix(tokens[:-1] * np.uint64(31) + tokens[1:])[follow]
    grams = np.concatenate([tokens, pairs])
    owners = np.concatenate([owner, owner[:-1][follow]])
    return (grams % np.uint64(BUCKETS)).astype(np.int64), owners


COUNTS = pa.schema([("bucket", pa.int32()), ("raw", pa.int64()), ("target", pa.int64())])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for rows in batches:
        buckets, owner = _gram_buckets(as_bytes(rows[0]))
        trusted = np.array(rows[1].to_pylist(), bool)
        raw += np.bincount(buckets, minlength=BUCKETS)
        target += np.bincount(buckets[trusted[owner]], minlength=BUCKETS)
    seen = np.flatnonzero(raw)
    yield batch(COUNTS, seen, raw[seen], target[seen])


def log_ratios(docs: DataFrame, trusted: DataFrame, doc_id: str, text: str) -> np.ndarray:
    """log(target share / raw share) per bucket, from counts over all documents.

    ``trusted`` has the ids of the target's documents.

    Each task adds up its documents; at most one row per task and bucket is shuffled, and the
    driver receives one row per bucket.
    """
    target_ids = trusted.select(F.col(doc_id).alias("__id")).distinct()
    marked = docs.join(
        sized(target_ids.withColumn("__trusted", F.lit(True))),
        F.col(doc_id) == F.col("__id"),
        "left",
    )
    counts = (
        marked.select(text, F.coalesce("__trusted", F.lit(False)))
        .mapInArrow(_count_batches, "bucket int, raw bigint, target bigint")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .collect()
    )
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counts:
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    # The target's counts if it were drawn from the raw corpus.
    expected = target.sum() * raw / raw.sum()
    return np.log((target + PRIOR_COUNT) / (expected + PRIOR_COUNT))


def _joined(ids: np.ndarray, size: int, times: int) -> np.ndarray:
    """Exact numbers for windows made of ``times`` windows of ``size`` words."""
    base, n = int(ids.max()) + 1, len(ids) - size * (times - 1)
    whole = ids[:n]
    for k in range(1, times):
        whole = whole * base + ids[k * size : k * size + n]
    return whole


def repeated_words(words: list[bytes]) -> int:
    """Words lying in a window of WINDOW words that occurs twice or more, the first included.

    Longer windows are named by the names of shorter ones, as exact numbers. Once all windows of
    some length differ, longer ones do too.
    """
    if len(words) <= WINDOW:
        return 0
    names: dict[bytes, int] = {}
    ids = np.array([names.setdefault(w, len(names)) for w in words], np.int64)
    if len(names) == len(words):
        return 0
    size = 1
    while size < WINDOW:
        times = 4 if size == 1 and len(names) < 1 << 15 else 2
        whole = _joined(ids, size, times)
        ordered = np.sort(whole)
        if not (ordered[1:] == ordered[:-1]).any():
            return 0
        _, ids, counts = np.unique(whole, return_inverse=True, return_counts=True)
        size *= times
    starts = np.flatnonzero(counts[ids] > 1)
    step = np.zeros(len(words) + 1, np.int64)
    step[starts] += 1
    step[starts + WINDOW] -= 1
    return int((np.cumsum(step[:-1]) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen = Counter(line for line in text.split(b"\n") if line.split())
    return seen.total() - len(seen)


def measures(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = text.split()
    code_points = len(text) if text.isascii() else len(text.decode())
    return (
        len(words),
        code_points - sum(text.count(bytes([c])) for c in _WHITE),
        len(text) - len(text.translate(None, SYMBOLS)),
        duplicate_lines(text),
        repeated_words(words),
    )


JUDGED = pa.schema(
    [
        ("id", pa.int64()),
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("base_failed", pa.bool_()),
        ("score", pa.float64()),
        ("kept", pa.bool_()),
    ]
)
JUDGED_DDL = (
    "id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
    " n_repeat_words bigint, base_failed boolean, score double, kept boolean"
)


def _judge_batches(
    batches: Iterator[pa.RecordBatch], ratios: np.ndarray, threshold: float
) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        texts = as_bytes(rows[1])
        buckets, owner = _gram_buckets(texts)
        grams = np.bincount(owner, minlength=len(texts))
        score = np.bincount(owner, ratios[buckets], len(texts)) / np.maximum(grams, 1)
        counted = np.array([measures(t) for t in texts], np.int64).reshape(-1, 5)
        n_words, repeated = counted[:, 0], counted[:, 4]
        failed = (n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n_words)
        kept = ~failed & (score >= threshold)
        yield batch(JUDGED, rows[0], *counted.T, failed, score, kept)


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: counts, ``base_failed``, ``score`` and ``kept``.

    ``trusted`` has the ids of the target corpus. The counts are taken when this is called. Ids
    may be null or repeated; other columns of ``docs`` are not read.
    """
    docs = docs.select(F.col(doc_id).cast("bigint").alias(doc_id), text)
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, trusted, doc_id, text))
    return (
        docs
        .mapInArrow(
            lambda batches: _judge_batches(batches, ratios.value, threshold), JUDGED_DDL
        )
        .withColumnRenamed("id", doc_id)
    )

