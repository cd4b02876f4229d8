"""Benchmark decontamination by winnowing, in DataFrame functions only.

Every text is turned into hashes of its k-grams of words; of each window of successive k-grams
only the smallest hash is kept as a fingerprint. Two texts that share a window of words share all
its k-grams, so they share a fingerprint at the same place of it. Documents that share one with
the benchmark are looked at again: each fingerprint that an item has as well is extended to the
windows around it, and these are joined with the items' windows on fingerprint and words; words
are compared, so equal hashes of different words cannot make a hit.

A window is listed once, however many items hold it, and so are the items of a window and the
items of a set of windows. So the rows in between grow with the documents' hit windows, not with
the items that share a line.

An item shorter than a window is one window of its own length; winnowing guarantees nothing for
it, so all k-grams of that length are kept on both sides.

Null and wordless texts have no words and no hits; a wordless item hits nothing. Repeated rows
and shared ids are safe: results are kept per id and text. An empty benchmark hits nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stakeline.llm.common import sized
from stakeline.sources.sinks import stage_table

# Words in a window and in a k-gram.
WINDOW, GRAM = 10, 5
# Windows of items carry their words, some 100 bytes; more are not broadcast.
ITEM_ROWS = 100_000
KEYS = ["__id", "__text"]

# What lies between words after lower-casing A-Z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, BETWEEN), "")


@dataclass(frozen=True)
class Scheme:
    """How texts are winnowed for windows of one length."""

    window: int
    gram: int

    @staticmethod
    def of(length: int) -> Scheme:
        return Scheme(length, GRAM if length == WINDOW else length)

    @property
    def competing(self) -> int:
        """k-grams in a window of words, of which the smallest is kept."""
        return self.window - self.gram + 1

    def grams(self, hashed: Column) -> Column:
        """Hashes of the k-grams, from the hashes of the words."""
        return F.transform(
            _starts(hashed, self.gram),
            lambda i: F.xxhash64(
                F.lit(self.window), *[F.get(hashed, i + k) for k in range(self.gram)]
            ),
        )

    def kept(self, grams: Column) -> Column:
        """The smallest hash of every window."""
        return F.transform(_starts(grams, self.competing), lambda i: self._least(grams, i))

    def kept_places(self, grams: Column) -> Column:
        """The places kept: in each window the last one that holds its smallest hash."""
        last = reversed(range(self.competing))
        return F.array_distinct(
            F.transform(
                _starts(grams, self.competing),
                lambda i: F.coalesce(
                    *[
                        F.when(F.get(grams, i + k) == self._least(grams, i), i + k)
                        for k in last
                    ]
                ),
            )
        )

    def _least(self, grams: Column, i: Column) -> Column:
        if self.competing == 1:
            return F.get(grams, i)
        return F.least(*[F.get(grams, i + k) for k in range(self.competing)])

    @property
    def margin(self) -> int:
        """Words beside a k-gram that a window holding it can reach."""
        return self.window - self.gram

    def surroundings(self, column: Column, place: Column) -> Column:
        """The k-gram at ``place`` with its margins; null beyond the ends of the text."""
        return F.transform(
            F.sequence(F.lit(-self.margin), F.lit(self.gram + self.margin - 1)),
            lambda d: F.get(column, place + d),
        )

    def fingerprints(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """One row per fingerprint of ``w`` with its place and surroundings."""
        df = df.withColumn("__h", F.transform("w", lambda word: F.xxhash64(word)))
        df = df.withColumn("__g", self.grams(F.col("__h")))
        found = F.transform(
            self.kept_places(F.col("__g")),
            lambda i: F.struct(
                i.alias("place"),
                F.get(F.col("__g"), i).alias("hash"),
                self.surroundings(F.col("w"), i).alias("near"),
            ),
        )
        return df.select(*keys, F.explode(found).alias("__f")).select(*keys, "__f.*")

    def item_windows(self, items: DataFrame) -> DataFrame:
        """One row per distinct window of the items: its fingerprint, words and sorted items."""
        df = items.withColumn("__h", F.transform("w", lambda word: F.xxhash64(word)))
        df = df.withColumn("__g", self.grams(F.col("__h")))
        found = F.transform(
            _starts(F.col("w"), self.window),
            lambda i: F.struct(
                self._least(F.col("__g"), i).alias("hash"),
                F.slice("w", i + 1, self.window).alias("words"),
            ),
        )
        return (
            df.select("item", F.explode(F.array_distinct(found)).alias("__f"))
            .select("item", "__f.*")
            .groupBy("hash", "words")
            .agg(F.sort_array(F.collect_set("item")).alias("items"))
        )

    def extended(self, hits: DataFrame, keys: list[str]) -> DataFrame:
        """The windows around each fingerprint, with the place of their first word."""
        around = F.transform(
            F.sequence(F.lit(0), F.lit(self.margin)),
            lambda d: F.struct(
                (F.col("place") - self.margin + d).alias("from"),
                F.slice("near", d + 1, self.window).alias("words"),
            ),
        )
        # Beyond the ends of a text there are no words.
        whole = F.filter(around, lambda x: ~F.exists(x["words"], lambda word: word.isNull()))
        return hits.select(*keys, "hash", F.explode(whole).alias("__f")).select(
            *keys, "hash", "__f.*"
        )


def _starts(column: Column, length: int) -> Column:
    """Numbers from 0 of the places where a run of ``length`` elements begins."""
    last = F.size(column) - length
    return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(
        F.array().cast("array<int>")
    )


def _schemes(items: DataFrame) -> list[Scheme]:
    """One per length of window that the benchmark has, at most WINDOW."""
    lengths = items.select(F.least(F.size("w"), F.lit(WINDOW)).alias("n")).where("n > 0")
    return [Scheme.of(row["n"]) for row in lengths.distinct().orderBy("n").collect()]


def _item_windows(items: DataFrame, scheme: Scheme) -> DataFrame:
    """Written, with the items of a window under the name of their list."""
    chosen = items.where(F.least(F.size("w"), F.lit(WINDOW)) == scheme.window)
    found = scheme.item_windows(chosen)
    return stage_table(found.withColumn("list", F.sha2(F.to_json("items"), 256)), "item_windows")


def _sharing(rows: DataFrame, sources: dict[Scheme, DataFrame]) -> DataFrame:
    """One row per document: number of words, and whether it shares a fingerprint."""
    rows = rows.withColumn("__row", F.monotonically_increasing_id())
    rows = rows.withColumn("n_words", F.size("w"))
    if not sources:
        return rows.select(*KEYS, "n_words", F.lit(False).alias("shares"))
    rows = rows.withColumn("__h", F.transform("w", lambda word: F.xxhash64(word)))
    hashes = []
    for scheme in sources:
        grams = f"__g{scheme.window}"
        rows = rows.withColumn(grams, scheme.grams(F.col("__h")))
        hashes.append(scheme.kept(F.col(grams)))
    known = None
    for source in sources.values():
        part = source.select("hash")
        known = part if known is None else known.unionByName(part)
    known = known.distinct().withColumn("__known", F.lit(True))
    per_row = ["__row", *KEYS, "n_words"]
    return (
        rows.select(*per_row, F.explode_outer(F.array_distinct(F.concat(*hashes))).alias("hash"))
        .join(sized(known), "hash", "left")
        .groupBy(*per_row)
        .agg(F.coalesce(F.max("__known"), F.lit(False)).alias("shares"))
        .drop("__row")
    )


def _listed(windows: DataFrame, lists: DataFrame) -> DataFrame:
    """Number and digest of the items per set of lists that a document's windows have."""
    items = F.sort_array(F.array_distinct(F.flatten(F.collect_list("items"))))
    return (
        windows.select("lists")
        .distinct()
        .select("lists", F.explode("lists").alias("list"))
        .join(sized(lists, ITEM_ROWS), "list")
        .groupBy("lists")
        .agg(items.alias("items"))
        .select(
            F.col("lists").alias("__lists"),
            F.size("items").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        )
    )


def _per_document(counted: DataFrame, hits: DataFrame, lists: DataFrame) -> DataFrame:
    """Adds the number of hit words, of items, and their digest to the counted documents."""
    found = hits.groupBy(*KEYS).agg(
        F.collect_set(F.struct("from", "to")).alias("stretches"),
        F.sort_array(F.collect_set("list")).alias("lists"),
    )
    hit = F.flatten(F.transform("stretches", lambda s: F.sequence(s["from"], s["to"] - 1)))
    found = found.select(
        F.col("__id").alias("__hit_id"),
        F.col("__text").alias("__hit_text"),
        F.size(F.array_distinct(hit)).alias("n_hit"),
        "lists",
    )
    found = stage_table(found, "hit_documents")
    listed = stage_table(_listed(found, lists), "listed_items")
    found = found.join(sized(listed, ITEM_ROWS), F.col("lists") == F.col("__lists"))
    found = stage_table(found.drop("lists", "__lists"), "found_items")
    same = F.col("__id").eqNullSafe(F.col("__hit_id")) & (F.col("__text") == F.col("__hit_text"))
    return counted.join(sized(found, ITEM_ROWS), same, "left")


def _contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str, text: str, item_id: str, item_text: str
) -> DataFrame:
    """One row per document with its keys, n_words, and n_hit, n_items and items_sha256, which are
    null without a hit.

    Two scans of the documents: the second one of those that share a fingerprint only. Their list
    is written to the shared folder, and sent to all tasks if a count shows it is short. The
    items' windows are treated alike.
    """
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item"), words(F.col(item_text)).alias("w")
    )
    sources = {s: _item_windows(items, s) for s in _schemes(items)}
    rows = docs.select(
        F.col(doc_id).alias("__id"), _text_hash(text).alias("__text"), F.col(text).alias("text")
    )
    in_words = words(F.col("text")).alias("w")
    counted = _sharing(rows.select(*KEYS, in_words), sources)
    if not sources:
        none = {"n_hit": "int", "n_items": "int", "items_sha256": "string"}
        return counted.withColumns({k: F.lit(None).cast(v) for k, v in none.items()})
    counted = stage_table(counted, "decontamination")
    sharing = counted.where("shares").select(
        F.col("__id").alias("__s_id"), F.col("__text").alias("__s_text")
    )
    chosen = rows.join(
        sized(sharing.distinct()),
        F.col("__id").eqNullSafe(F.col("__s_id")) & (F.col("__text") == F.col("__s_text")),
        "left_semi",
    ).select(*KEYS, in_words)
    hits = lists = None
    for scheme, source in sources.items():
        known = sized(source.select("hash").distinct())
        near = scheme.fingerprints(chosen, KEYS).join(known, "hash", "left_semi")
        part = (
            scheme.extended(near, KEYS)
            .join(sized(source.drop("items"), ITEM_ROWS), ["hash", "words"])
            .select(*KEYS, "list", "from", (F.col("from") + scheme.window).alias("to"))
        )
        hits = part if hits is None else hits.unionByName(part)
        own = source.select("list", "items")
        lists = own if lists is None else lists.unionByName(own)
    lists = stage_table(lists.dropDuplicates(["list"]), "item_lists")
    return _per_document(counted, hits, lists)


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated.

    Other columns are not read.
    """
    found = _contamination(docs, benchmark, doc_id, text, item_id, item_text)
    return found.select(
        F.col("__id").alias(doc_id),
        F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The documents without a hit, with all their columns.

    What goes is listed by id and text; the list is broadcast if a count shows it is short.
    """
    found = _contamination(docs, benchmark, doc_id, text, item_id, item_text)
    listed = found.where("n_hit IS NOT NULL").select(
        F.col("__id").alias("__hit_id"), F.col("__text").alias("__hit_text")
    )
    listed = stage_table(listed.distinct(), "contaminated")
    same = docs[doc_id].eqNullSafe(listed["__hit_id"]) & (_text_hash(text) == listed["__hit_text"])
    return docs.join(sized(listed), same, "left_anti")
