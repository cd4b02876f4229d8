"""Near duplicates by SimHash: fingerprints, linked within a few bits by searching BK-trees.

A BK-tree keys the children of a node by their Hamming distance to it; a search within radius r
follows only the edges from d - r to d + r. The trees are shards: two fingerprints that differ in
r bits or fewer agree on at least one of r + 1 blocks of their bits, so a shard holds all
fingerprints with one value of one block and no pair is lost between shards. A shard's members
are both its tree and its queries, so no tree is sent to rows that cannot match it.

A block value shared by too many fingerprints for one tree is dealt again by finer keys: of many
narrow blocks, all but r are equal in two close fingerprints. What shares all but r of them can
differ in the bits of r blocks only, so these shards are bounded by construction.

A shard hands on one link per member (to the first of its group in the shard), not all pairs;
groups are joined up by connected components. Equal fingerprints count once in all of this.

Null and wordless texts have fingerprint zero, linked like any other. Repeated rows and ids are
safe: each row gets its fingerprint's component. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stakeline.llm.common import as_bytes, batch, sized, unused
from stakeline.llm.components import connected_components
from stakeline.sources.sinks import stage_table

BITS = 64
# Fixed value: seed of the shingles' hash.
SEED = 42
# Members of one tree. Groups above it go the finer way, in FINE blocks.
MOST_MEMBERS = 4096
FINE = 11
# Shingles turned into bits at a time.
STEP = 1 << 16


# --- fingerprints -----------------------------------------------------------------------------


def fingerprint(text: bytes, size: int) -> int:
    """Bits set in over half of the hashes of the text's shingles, as an unsigned number."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(len(words) - size + 1, 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, STEP):
        upto = min(at + STEP, n)
        part = words[at : upto + size - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(size)), strict=False))
        if len(words) < size:
            shingles = [b" ".join(words)]
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


PRINTS = pa.schema(
    [("id", pa.int64()), ("text_hash", pa.int64()), ("fingerprint", pa.int64())]
)
PRINTS_DDL = "id bigint, text_hash bigint, fingerprint bigint"


def _print_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        found = np.array([fingerprint(t, size) for t in as_bytes(rows[1])], np.uint64)
        yield batch(PRINTS, rows[0], rows[2], found.view(np.int64))


# --- trees ------------------------------------------------------------------------------------


class Tree:
    """A BK-tree over fingerprints as unsigned numbers."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def near(self, wanted: int, radius: int) -> list[int]:
        """All members within ``radius`` bits."""
        found, todo = [], [self.root] if self.root else []
        while todo:
            member, children = todo.pop()
            distance = (member ^ wanted).bit_count()
            if distance <= radius:
                found.append(member)
            for edge in range(max(distance - radius, 1), distance + radius + 1):
                if edge in children:
                    todo.append(children[edge])
        return found

    def add(self, new: int) -> None:
        if self.root is None:
            self.root = (new, {})
            return
        member, children = self.root
        while distance := (member ^ new).bit_count():
            if distance not in children:
                children[distance] = (new, {})
                return
            member, children = children[distance]


def links(members: list[int], radius: int) -> list[tuple[int, int]]:
    """For each member linked to another one, a link to the first of its group."""
    leader: dict[int, int] = {}

    def lead(x: int) -> int:
        while leader[x] != x:
            leader[x] = leader[leader[x]]
            x = leader[x]
        return x

    tree = Tree()
    for member in sorted(set(members)):
        leader[member] = member
        for other in tree.near(member, radius):
            a, b = lead(member), lead(other)
            leader[max(a, b)] = min(a, b)
        tree.add(member)
    return [(x, lead(x)) for x in leader if lead(x) != x]


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _link_batches(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        found = []
        for shard in rows[0]:
            members = np.array(shard.values, np.int64).view(np.uint64)
            found += links(members.tolist(), radius)
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        yield batch(LINKS, pairs[:, 0], pairs[:, 1])


# --- shards -----------------------------------------------------------------------------------


def _masks(blocks: int) -> list[int]:
    """The bits of each of a number of blocks of about equal width."""
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _keyed(prints: DataFrame, masks: list[int]) -> DataFrame:
    """Each fingerprint once per mask, with the mask's number and the bits it leaves."""
    keys = [
        F.struct(
            F.lit(i).alias("mask"),
            F.col("fingerprint").bitwiseAND(F.lit(_signed(m)).cast("bigint")).alias("bits"),
        )
        for i, m in enumerate(masks)
    ]
    return prints.select("fingerprint", F.explode(F.array(*keys)).alias("key")).select(
        "fingerprint", "key.mask", "key.bits"
    )


def _search(keyed: DataFrame, radius: int) -> DataFrame:
    shards = (
        keyed.groupBy("mask", "bits")
        .agg(F.collect_list("fingerprint").alias("members"))
        .where(F.size("members") > 1)
        .select("members")
    )
    return shards.mapInArrow(lambda batches: _link_batches(batches, radius), "a bigint, b bigint")


def _links(prints: DataFrame, radius: int) -> DataFrame:
    """Links that join up all distinct fingerprints within ``radius`` bits of each other."""
    keyed = _keyed(prints, _masks(radius + 1))
    crowded = (
        keyed.groupBy("mask", "bits")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > MOST_MEMBERS)
        .select("mask", "bits")
    )
    crowded = stage_table(crowded, "crowded")
    if crowded.isEmpty():
        return _search(keyed, radius)
    narrow = _masks(FINE)
    finer = [
        reduce(int.__or__, kept) for kept in combinations(narrow, FINE - radius)
    ]
    again = keyed.join(sized(crowded), ["mask", "bits"], "left_semi")
    again = again.select("fingerprint").distinct()
    rest = keyed.join(sized(crowded), ["mask", "bits"], "left_anti")
    return _search(rest, radius).unionByName(_search(_keyed(again, finer), radius))


def _classes(docs: DataFrame, doc_id: str, text: str, shingle: int, radius: int) -> DataFrame:
    """One row per document: id, hash of its text, fingerprint, group, and the group's least id.

    A group goes by one of its fingerprints. Fingerprints are written to the shared folder, as the
    texts are read for them once.
    """
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("t"), text_hash(text)
    )
    prints = stage_table(
        rows.mapInArrow(lambda batches: _print_batches(batches, shingle), PRINTS_DDL),
        "fingerprints",
    )
    distinct = prints.groupBy("fingerprint").agg(F.min("id").alias("first"))
    grouped = connected_components(_links(distinct.select("fingerprint"), radius))
    named = distinct.join(grouped, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first", F.coalesce("component", "fingerprint").alias("group")
    )
    # Joins with a sum over their own key cannot be split where a group is large; with a stored
    # table they can. One row per fingerprint here; copies of a text only meet the last join.
    named = stage_table(named, "groups")
    least = named.groupBy("group").agg(F.min("first").alias("component_id"))
    named = named.join(stage_table(least, "least_ids"), "group").drop("first")
    return prints.join(named, "fingerprint")


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    radius: int = 2,
) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the least id reachable over links of ``radius`` or fewer bits. Null ids
    are never the least. Other columns are not read.
    """
    return _classes(docs, doc_id, text, shingle, radius).select(
        F.col("id").alias(doc_id),
        hex_digits(F.col("fingerprint")).alias("fingerprint"),
        "component_id",
    )


def keep_one(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    radius: int = 2,
) -> DataFrame:
    """One document of each group of near duplicates, with all its columns.

    The one of the least id stays; of several with that id, the one whose text has the least hash;
    of rows equal in both, any one. Without ids the hash alone decides. What goes is listed by id
    and text hash, and the list is sent to all tasks if a count shows it is short.
    """
    found = stage_table(_classes(docs, doc_id, text, shingle, radius), "classes")
    own = F.struct(F.col("id").isNull(), "id", "text_hash")
    keepers = stage_table(found.groupBy("group").agg(F.min(own).alias("keeper")), "keepers")
    rows = found.join(keepers, "group").select(
        F.col("id").alias("__id"),
        F.col("text_hash").alias("__hash"),
        (own == F.col("keeper")).alias("kept"),
    )
    listed = stage_table(
        rows.groupBy("__id", "__hash").agg(
            F.first("kept").alias("kept"), F.count(F.lit(1)).alias("n")
        ).where("NOT kept OR n > 1"),
        "listed",
    )
    key = unused(docs, "text_hash")
    here = docs.withColumn(key, text_hash(text))

    def matching(rows: DataFrame, how: str) -> DataFrame:
        same = here[doc_id].eqNullSafe(rows["__id"]) & (here[key] == rows["__hash"])
        return here.join(sized(rows), same, how)

    single = matching(listed, "left_anti")
    repeated = listed.where("kept").select("__id", "__hash")
    if not repeated.isEmpty():
        copies = matching(repeated, "left_semi").dropDuplicates([doc_id, key])
        single = single.unionByName(copies)
    return single.drop(key)


def hex_digits(number: Column) -> Column:
    return F.lpad(F.lower(F.hex(number)), 16, "0")
