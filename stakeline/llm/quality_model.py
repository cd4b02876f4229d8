"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Word vectors are gathered from the whole corpus by random indexing: every word has a sparse
random index vector of +1 and -1 drawn from its hash, and a word's vector is the sum of the index
vectors of the words around its occurrences. Words share a table of fixed size by hash, so what
is gathered has a fixed size too; all documents and all words count. A document is the mean and
the spread of the vectors of its words, and how much these agree with those of words near them.

A network of two layers is fitted on a bounded sample of labelled documents, in numpy. A part of
the sample is kept aside to find the temperature that makes its outputs probabilities.

Neither ids nor any other column takes part in a score. Null and empty texts, and texts without
words, have zero vectors and the score that goes with those. Texts are read whole. Repeated rows
are scored like any others. If the labels are all alike, or missing, every score is their mean
(0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stakeline.llm.common import as_bytes, batch, mix, token_hashes

# The table of word vectors: words by hash, and values in a vector.
ROWS, WIDTH = 1 << 13, 64
# Values other than zero in an index vector, and words to either side that count.
NONZERO, REACH = 4, 2
# Distances at which a word is compared with later ones, and values of a pooled document.
LAGS = (1, 2, 3)
POOLED = 2 * WIDTH + len(LAGS)
# Words counted or pooled at a time.
STEP = 1 << 15
# Labelled documents the network is fitted on, at most.
SAMPLE = 20_000
# Every so many-th document of the sample calibrates.
ASIDE = 5
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 3e-3, 1e-4
THRESHOLD = 0.3
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


# --- word vectors -----------------------------------------------------------------------------


def _rows(tokens: np.ndarray) -> np.ndarray:
    return (tokens % np.uint64(ROWS)).astype(np.int64)


def _accumulate(table: np.ndarray, tokens: np.ndarray, owner: np.ndarray) -> None:
    """Adds the index vectors of neighbours to the (flat) table of word vectors.

    A step takes the pairs that begin in it, so it looks a few words ahead.
    """
    for at in range(0, len(tokens), STEP):
        own = tokens[at : at + STEP + REACH]
        text = owner[at : at + STEP + REACH]
        row, drawn = _rows(own) * WIDTH, mix(own)
        places, signs = [], []
        for reach in range(1, REACH + 1):
            first = np.flatnonzero(text[reach:] == text[:-reach])
            first = first[first < STEP]
            for here, there in ((first, first + reach), (first + reach, first)):
                for k in range(NONZERO):
                    bits = (drawn[there] >> np.uint64(8 * k)).astype(np.int64)
                    places.append(row[here] + bits % WIDTH)
                    signs.append(np.where(bits & 128, 1.0, -1.0))
        table += np.bincount(
            np.concatenate(places), np.concatenate(signs), len(table)
        ).astype(np.int64)


SUMS_DDL = "word int, seen bigint, " + ", ".join(f"v{i} bigint" for i in range(WIDTH))


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, seen = np.zeros(ROWS * WIDTH, np.int64), np.zeros(ROWS, np.int64)
    for rows in batches:
        tokens, owner = token_hashes(as_bytes(rows[0]))
        _accumulate(table, tokens, owner)
        seen += np.bincount(_rows(tokens), minlength=ROWS)
    used = np.flatnonzero(seen)
    values = table.reshape(ROWS, WIDTH)[used]
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array(seen[used]), *map(pa.array, values.T.copy())],
        names=["word", "seen", *(f"v{i}" for i in range(WIDTH))],
    )


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The table of word vectors over all documents, each of length one, zero where unseen.

    Tasks add up their own documents; a row per task and used table row is shuffled, and the
    driver receives the table. Sums are of whole numbers, so no order of tasks shows in them.
    """
    sums = (
        docs.select(text)
        .mapInArrow(_sum_batches, SUMS_DDL)
        .groupBy("word")
        .agg(F.sum("seen"), *[F.sum(f"v{i}") for i in range(WIDTH)])
        .toArrow()
    )
    found = np.array([column.to_numpy() for column in sums.columns], np.float64)
    vectors = np.zeros((ROWS, WIDTH))
    if found.size:
        word, seen, values = found[0].astype(np.int64), found[1], found[2:].T
        # Without the common direction, which the most frequent words lend to all.
        values = values / seen[:, None] - values.sum(axis=0) / seen.sum()
        length = np.linalg.norm(values, axis=1, keepdims=True)
        vectors[word] = values / np.maximum(length, 1e-9)
    return vectors.astype(np.float32)


def _pool(rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the vectors of one text's words, and their agreement with near words."""
    total, squares, agreement = np.zeros(WIDTH), np.zeros(WIDTH), np.zeros(len(LAGS))
    far = max(LAGS)
    for at in range(0, len(rows), STEP):
        # The step's words, and those after it that its last ones are compared with.
        found = vectors[rows[at : at + STEP + far]]
        own = found[:STEP]
        total += own.sum(axis=0, dtype=np.float64)
        squares += np.einsum("ij,ij->j", own, own)
        for k, lag in enumerate(LAGS):
            then = found[lag : lag + STEP]
            agreement[k] += np.einsum("ij,ij->", own[: len(then)], then)
    mean = total / len(rows)
    spread = np.sqrt(np.maximum(squares / len(rows) - mean * mean, 0))
    return np.concatenate([mean, spread, agreement / len(rows)])


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """The pooled word vectors of each text; zeros for a text without words."""
    tokens, owner = token_hashes(texts)
    rows = _rows(tokens)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = np.zeros((len(texts), POOLED))
    for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
        if a < b:
            out[i] = _pool(rows[a:b], vectors)
    return out


# --- the network ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Network:
    """Two layers and a temperature over standardised pooled vectors."""

    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.centre) / self.scale @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


@dataclass(frozen=True)
class Constant:
    """The score where there is nothing to tell apart."""

    score: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.score)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _fit_layers(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam over mini-batches in a fixed random order."""
    draw = np.random.default_rng(7)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - centre) / scale
    weights = [
        draw.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        draw.normal(0, HIDDEN**-0.5, HIDDEN),
        np.zeros(1),
    ]
    first_moment = [np.zeros_like(w) for w in weights]
    second_moment = [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(z))
        for at in range(0, len(z), BATCH):
            own = order[at : at + BATCH]
            hidden = np.tanh(z[own] @ weights[0] + weights[1])
            error = (_sigmoid(hidden @ weights[2] + weights[3]) - y[own]) / len(own)
            back = np.outer(error, weights[2]) * (1 - hidden * hidden)
            slopes = [
                z[own].T @ back + DECAY * weights[0],
                back.sum(axis=0),
                hidden.T @ error + DECAY * weights[2],
                error.sum(keepdims=True),
            ]
            step += 1
            for w, g, m, v in zip(weights, slopes, first_moment, second_moment, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(centre, scale, weights[0], weights[1], weights[2], float(weights[3][0]))


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits that makes the labels kept aside likeliest."""
    choices = np.geomspace(0.25, 8, 61)
    loss = [
        -np.mean(np.log(np.where(y == 1, p, 1 - p) + 1e-12))
        for p in (_sigmoid(logits / t) for t in choices)
    ]
    return float(choices[int(np.argmin(loss))])


def fit(x: np.ndarray, y: np.ndarray) -> Network | Constant:
    """The network for pooled vectors and labels of 0 and 1, in a fixed order."""
    if len(np.unique(y)) < 2 or len(y) < 2 * ASIDE:
        return Constant(float(y.mean()) if len(y) else 0.5)
    aside = np.arange(len(y)) % ASIDE == 0
    if len(np.unique(y[~aside])) < 2:
        return Constant(float(y.mean()))
    network = _fit_layers(x[~aside], y[~aside])
    heat = _temperature(network.logits(x[aside]), y[aside])
    return Network(**{**network.__dict__, "temperature": heat})


# --- documents --------------------------------------------------------------------------------

SCORED = pa.schema([("id", pa.int64()), ("score", pa.float64())])


def _pool_batches(
    batches: Iterator[pa.RecordBatch], vectors: np.ndarray
) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        x = pooled(as_bytes(rows[0]), vectors)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(x), pa.list_(pa.float64())), rows[1], rows[2]], names=["x", "y", "o"]
        )


def _score_batches(
    batches: Iterator[pa.RecordBatch], model: tuple[np.ndarray, Network | Constant]
) -> Iterator[pa.RecordBatch]:
    vectors, network = model
    for rows in batches:
        yield batch(SCORED, rows[0], network.scores(pooled(as_bytes(rows[1]), vectors)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
) -> tuple[np.ndarray, Network | Constant]:
    """Word vectors of all documents and a network fitted on at most ``sample`` labelled ones.

    Learns from documents that are not held out. The sample is those first in order of a hash of
    their ids. An id with several labels has the least of them, and one with several rows counts
    once, with the text of the least hash, so that no more rows than that reach the driver.
    """
    sc = docs.sparkSession.sparkContext
    vectors = word_vectors(docs, text)
    chosen = (
        labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
        .where(~held_out(F.col(doc_id)))
        .groupBy(F.col(doc_id).alias("__id"))
        .agg(F.min(label).cast("double").alias("__y"))
        .withColumn("__order", F.xxhash64("__id"))
        .join(docs.select(F.col(doc_id).alias("__id")).distinct(), "__id", "left_semi")
        .orderBy("__order", "__id")
        .limit(sample)
    )
    sent = sc.broadcast(vectors)
    rows = (
        docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
        .join(F.broadcast(chosen), "__id")
        .groupBy("__id", "__y", "__order")
        .agg(F.min(F.struct(F.xxhash64("__text"), F.col("__text").alias("text"))).alias("least"))
        .select("least.text", "__y", "__order")
        .mapInArrow(
            lambda batches: _pool_batches(batches, sent.value),
            "x array<double>, y double, o bigint",
        )
        .toArrow()
    )
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, POOLED)
    y, order = rows["y"].to_numpy(), rows["o"].to_numpy()
    # A fixed order, whatever order the tasks end in.
    order = np.lexsort((*x.T[:2], y, order))
    return vectors, fit(x[order], y[order])


def score(
    docs: DataFrame,
    model: tuple[np.ndarray, Network | Constant],
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return (
        docs.select(F.col(doc_id).cast("bigint"), text)
        .mapInArrow(
            lambda batches: _score_batches(batches, sent.value), "id bigint, score double"
        )
        .select(
            F.col("id").alias(doc_id),
            F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"),
            "score",
            (F.col("score") >= threshold).cast("int").alias("predicted"),
        )
    )


def _keep_batches(
    batches: Iterator[pa.RecordBatch],
    model: tuple[np.ndarray, Network | Constant],
    at: int,
    threshold: float,
) -> Iterator[pa.RecordBatch]:
    vectors, network = model
    for rows in batches:
        scores = network.scores(pooled(as_bytes(rows[at]), vectors))
        yield rows.filter(pa.array(scores >= threshold))


def keep_good(
    docs: DataFrame,
    model: tuple[np.ndarray, Network | Constant],
    text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents that score ``threshold`` or more, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    return docs.mapInArrow(
        lambda batches: _keep_batches(batches, sent.value, at, threshold), docs.schema
    )
