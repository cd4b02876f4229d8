"""Repair of conversations: the cheapest edits that make the roles alternate.

A row of a conversation becomes one of sixteen symbols, its role (system, user, assistant, other)
and its first fault (none, blank, duplicate, truncated). What a symbol can do to the roles written
so far is a small transfer matrix: for each pair of states of the pattern ``(s?(ua)+)?`` the least
cost of going from one to the other, over Keep, Rerole, Delete and any Inserts before them. Two
neighbours multiply by min-plus, and a matrix keeps for each entry the state in the middle, so its
edits are a rope: entry (i, j) of a product reads as entry (i, k) of the left one and (k, j) of the
right one.

Conversations repeat themselves, so their sequences are compressed by a Re-Pair grammar, whose
rules replace the most frequent pair of neighbours, counted over all conversations. Every rule has
one matrix, made from those of its two sides, and all conversations share it.

Of equally cheap edits those with the least string of initials win. For a fixed first state two
entries of a row never have the same string, nor is one the beginning of the other: the initials
fix the states, and the last initial of an entry always uses up a row. So the states reached
are ordered by their strings once, and ropes are compared without being read.

Rows are range-partitioned by conversation and turn. A conversation that spans slices has a matrix
per slice, at most as many as there are slices, which are multiplied per conversation; its
edits are then read slice by slice. Only the digest of the repaired rows has to go through a
conversation in order, which it does as a stream.

Rows are ordered by turn (nulls first), those of one turn by a hash of role and text; equal rows
are counted, not listed.
A role without a first character fits nothing, so it cannot be kept. A null conversation id is
a conversation of its own; null roles and texts are one space. Empty texts are blank, very long
ones only pass through. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stakeline.llm.common import batch, prepare, slices
from stakeline.sources.sinks import stage_table

# Bounds of the grammar: rules in all, pairs that become rules per pass, least places of a pair.
RULES = 64
PER_PASS = 16
LEAST_PLACES = 16

ROLES = "sua?"
FAULTS = ("none", "blank", "duplicate", "truncated")
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
SYMBOLS = len(ROLES) * len(FAULTS)
# Symbols are characters, so that a task replaces pairs in whole strings; a gap ends a sequence.
FIRST, FIRST_RULE, GAP = ord("A"), 0x100, "\n"
# Steps of a long sequence whose states are held at a time when its edits are read.
STRETCH = 1024

STATES = 4
# What can be written next, and the state behind it: nothing yet, system, user, assistant.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
INFINITE = 1 << 60
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5


class Row(NamedTuple):
    """What leads from one state to each state: costs, the order of the strings of initials, and
    how to read them: the state in the middle of a product, or the edits of a symbol."""

    cost: tuple[int, ...]
    order: tuple[int, ...]
    via: tuple


Matrix = tuple[Row, ...]


def _walks() -> list[dict[int, str]]:
    """The roles inserted on the way from each state to every other."""
    found = []
    for start in range(STATES):
        walk = {start: ""}
        for _ in range(STATES):
            for state, written in list(walk.items()):
                for role, then in NEXT[state].items():
                    if role != "s":
                        walk.setdefault(then, written + role)
        found.append(walk)
    return found


WALKS = _walks()
_INITIALS = str.maketrans({"U": "I", "A": "I", "k": "K", "u": "R", "a": "R", "-": "D"})


def initials(edits: str) -> str:
    return edits.translate(_INITIALS)


def _ranks(keys: list) -> tuple[int, ...]:
    known = sorted(k for k in keys if k is not None)
    return tuple(STATES if k is None else known.index(k) for k in keys)


def _symbol(number: int) -> Matrix:
    """Matrix of one row of a conversation. Edits are the inserted roles in capitals, then what
    happens to the row: ``k`` kept, ``u`` or ``a`` its new role, ``-`` deleted."""
    role, fault = ROLES[number // len(FAULTS)], number % len(FAULTS)
    late = CUT_OFF if fault == TRUNCATED else 0
    rows = []
    for walk in WALKS:
        best: list = [None] * STATES
        for middle, written in walk.items():
            ways = [(DELETE, middle, "-")]
            if fault not in (BLANK, DUPLICATE):
                then = NEXT[middle]
                if role in then:
                    ways.append((KEEP + late, then[role], "k"))
                ways += [(REROLE + late, then[to], to) for to in "ua" if to in then]
            for price, end, edit in ways:
                edits = written.upper() + edit
                way = (INSERT * len(written) + price, initials(edits), edits)
                best[end] = way if best[end] is None else min(best[end], way)
        rows.append(
            Row(
                tuple(INFINITE if w is None else w[0] for w in best),
                _ranks([None if w is None else w[1] for w in best]),
                tuple(None if w is None else w[2] for w in best),
            )
        )
    return tuple(rows)


def _advance(cost: tuple[int, ...], order: tuple[int, ...], matrix: Matrix) -> Row:
    """Min-plus product of a row and a matrix; ties go to the least string, without reading it."""
    best = []
    for j in range(STATES):
        ways = [
            (cost[k] + matrix[k].cost[j], order[k], k)
            for k in range(STATES)
            if cost[k] < INFINITE and matrix[k].cost[j] < INFINITE
        ]
        best.append(min(ways) if ways else None)
    keys = [None if w is None else (w[1], matrix[w[2]].order[j]) for j, w in enumerate(best)]
    return Row(
        tuple(INFINITE if w is None else w[0] for w in best),
        _ranks(keys),
        tuple(-1 if w is None else w[2] for w in best),
    )


def product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(_advance(row.cost, row.order, b) for row in a)


UNIT: Matrix = tuple(
    Row(
        tuple(0 if i == j else INFINITE for j in range(STATES)),
        tuple(0 if i == j else STATES for j in range(STATES)),
        (None,) * STATES,
    )
    for i in range(STATES)
)


class Grammar:
    """Re-Pair rules over the symbols, with the matrix of every symbol and rule."""

    def __init__(self, rules: list[str]) -> None:
        self.rules = rules
        self.matrices = {chr(FIRST + n): _symbol(n) for n in range(SYMBOLS)}
        for number, (left, right) in enumerate(rules):
            made = product(self.matrices[left], self.matrices[right])
            self.matrices[chr(FIRST_RULE + number)] = made
        self._known = lru_cache(maxsize=1 << 14)(self._relative)

    def __reduce__(self):
        # Tasks get the rules and make the matrices themselves.
        return Grammar, (self.rules,)

    def compress(self, sequences: str) -> str:
        for number, pair in enumerate(self.rules):
            sequences = sequences.replace(pair, chr(FIRST_RULE + number))
        return sequences

    def _relative(self, cost: tuple[int, ...], order: tuple[int, ...], symbol: str) -> Row:
        return _advance(cost, order, self.matrices[symbol])

    def step(self, row: Row, symbol: str) -> Row:
        """One symbol further. Only differences of costs matter for the way, and there are few."""
        least = min(row.cost)
        cost = tuple(c if c == INFINITE else c - least for c in row.cost)
        then = self._known(cost, row.order, symbol)
        return then._replace(
            cost=tuple(c if c == INFINITE else c + least for c in then.cost)
        )

    def matrix(self, compressed: str) -> Matrix:
        rows = []
        for row in UNIT:
            for symbol in compressed:
                row = self.step(row, symbol)
            rows.append(row)
        return tuple(rows)

    def read(self, compressed: str, start: int, end: int) -> list[str]:
        """The edits of every row of a sequence that begins and ends in given states."""
        parts = [compressed[i : i + STRETCH] for i in range(0, len(compressed), STRETCH)]
        row, begins = UNIT[start], []
        for part in parts:
            begins.append(row)
            for symbol in part:
                row = self.step(row, symbol)
        ropes = []
        for part, row in zip(reversed(parts), reversed(begins), strict=True):
            via = []
            for symbol in part:
                row = self.step(row, symbol)
                via.append(row.via)
            for symbol, middles in zip(reversed(part), reversed(via), strict=True):
                ropes.append((symbol, middles[end], end))
                end = middles[end]
        found = []
        while ropes:
            symbol, i, j = ropes.pop()
            via = self.matrices[symbol][i].via[j]
            if ord(symbol) < FIRST_RULE:
                found.append(via)
            else:
                left, right = self.rules[ord(symbol) - FIRST_RULE]
                ropes += [(right, via, j), (left, i, via)]
        return found


def closing(row: Row) -> tuple[int, int, str]:
    """Cost, state before the last inserts and these inserts, of the cheapest whole repair."""
    ways = [
        # Those that end without inserts have the lesser string, as they are its beginning.
        (row.cost[state] + INSERT * len(written), row.order[state], state, written)
        for state in range(STATES)
        for end, written in WALKS[state].items()
        if end in ENDS and row.cost[state] < INFINITE
    ]
    price, _, state, written = min(ways)
    return price, state, written.upper()


# --- rows ----------------------------------------------------------------------------------------

_SOLID = r"[^\x20\x09-\x0D]"
ID = "conv_id"


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) after the faults that a hash of id and turn puts in.

    Nulls of role and text, and in the hashed key, are one space.
    """

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain(ID), F.lit(":"), plain("turn"))) % 20
    rows = conversations.select(
        ID, "turn", plain("role").alias("role"), plain("text").alias("text"), kind.alias("_kind")
    ).where("_kind <> 0")
    text = (
        F.when(F.col("_kind") == 1, F.lit(""))
        .when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    role = F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("_kind") == 3, 2).otherwise(1)
    copy = F.explode(F.array_repeat(F.lit(0), times)).alias("_copy")
    return rows.select(ID, "turn", role.alias("role"), text.alias("text"), copy).drop("_copy")


def _same_conversation(rows: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
    """Joins on the id, nulls alike."""
    other = other.withColumnRenamed(ID, "_id")
    return rows.join(other, F.col(ID).eqNullSafe(F.col("_id")), how).drop("_id")


def _classed(rows: DataFrame) -> DataFrame:
    """Different rows with how often they occur, and the symbols of the first and other copies."""
    blank_space = F.lit(" ")
    counted = (
        rows.select(
            ID, "turn", F.coalesce("role", blank_space).alias("role"),
            F.coalesce("text", blank_space).alias("text"),
        )
        .groupBy(ID, "turn", "role", "text")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    counted = stage_table(counted.withColumn("said", F.unhex(F.md5(said))), "rows")
    # A null turn comes before any other.
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = counted.groupBy(F.col(ID).alias("_id"), F.col("said").alias("_said")).agg(
        F.min(at).alias("_first")
    )
    first = stage_table(first, "first")
    same = F.col(ID).eqNullSafe(F.col("_id")) & (F.col("said") == F.col("_said"))
    blank = ~F.col("text").rlike(_SOLID)
    last = F.regexp_extract("text", rf"({_SOLID})[\x20\x09-\x0D]*\z", 1)
    fault = (
        F.when(blank, BLANK)
        .when(~F.col("turn").eqNullSafe(F.col("_first.turn")), DUPLICATE)
        .when(last.isin(".", "!", "?"), NONE)
        .otherwise(TRUNCATED)
    )
    role = F.when(F.col("role") == "", 0).otherwise(F.instr(F.lit("sua"), F.substring("role", 1, 1)))
    role = F.when(role > 0, role - 1).otherwise(len(ROLES) - 1) * len(FAULTS) + FIRST
    again = F.when(blank, BLANK).otherwise(DUPLICATE)
    return counted.join(first, same).select(
        ID, "turn", "said", "role", "text", "copies",
        F.char(role + fault).alias("symbol"), F.char(role + again).alias("again"),
    )


def _sliced(rows: DataFrame) -> DataFrame:
    """Rows with the number of the slice of the global order they lie in."""
    sliced = rows.repartitionByRange(slices(rows.sparkSession), ID, "turn", "said")
    return stage_table(sliced.withColumn("slice", F.spark_partition_id()), "sliced")


def _sequences(rows: DataFrame) -> DataFrame:
    """The symbols of each conversation and slice; a group is at most a slice, without its texts."""
    symbols = F.concat("symbol", F.repeat("again", (F.col("copies") - 1).cast("int")))
    # Structs sort by turn, nulls first, then hash.
    items = F.sort_array(F.collect_list(F.struct("turn", "said", symbols.alias("symbols"))))
    grouped = rows.groupBy(ID, "slice").agg(items.alias("items"))
    lists = [F.col(f"items.{c}").alias(c) for c in ("turn", "said", "symbols")]
    joined = F.array_join("items.symbols", "").alias("sequence")
    return stage_table(grouped.select(ID, "slice", *lists, joined), "sequences")


_PAIRS = pa.schema([("pair", pa.string()), ("places", pa.int64())])


def learn_grammar(sequences: DataFrame, most: int = RULES) -> Grammar:
    """Re-Pair over all sequences, several pairs without a common symbol per pass.

    What comes to the driver is a count per pair of symbols, so at most (16 + ``most``)^2 rows.
    """
    rules: list[str] = []
    while len(rules) < most:
        grammar = Grammar(list(rules))

        def pairs(
            batches: Iterator[pa.RecordBatch], grammar: Grammar = grammar
        ) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                whole = grammar.compress(GAP.join(rows.column(0).to_pylist()))
                codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32).astype(np.int64)
                inside = (codes[:-1] != ord(GAP)) & (codes[1:] != ord(GAP))
                found, places = np.unique(
                    (codes[:-1][inside] << 32) | codes[1:][inside], return_counts=True
                )
                names = [chr(p >> 32) + chr(p & 0xFFFFFFFF) for p in found.tolist()]
                yield batch(_PAIRS, names, places)

        counts = (
            sequences.select("sequence")
            .mapInArrow(pairs, "pair string, places long")
            .groupBy("pair")
            .agg(F.sum("places").alias("places"))
            .where(F.col("places") >= LEAST_PLACES)
            .collect()
        )
        taken: set[str] = set()
        new = []
        for row in sorted(counts, key=lambda r: (-r.places, r.pair)):
            if not taken & set(row.pair):
                new.append(row.pair)
                taken |= set(row.pair)
        if not new:
            break
        rules += new[: min(PER_PASS, most - len(rules))]
    return Grammar(rules)


_LEGAL = {"su", "ua", "au"}


def _profile(sequence: str) -> tuple[str, str, int, int, int, int]:
    """First and last role, illegal neighbours, and rows per fault of a sequence."""
    numbers = np.frombuffer(sequence.encode(), np.uint8) - FIRST
    roles, faults = numbers // len(FAULTS), numbers % len(FAULTS)
    pairs = np.bincount(roles[:-1] * len(ROLES) + roles[1:], minlength=len(ROLES) ** 2)
    legal = sum(int(pairs[ROLES.index(a) * len(ROLES) + ROLES.index(b)]) for a, b in _LEGAL)
    counts = np.bincount(faults, minlength=len(FAULTS))
    return (
        ROLES[roles[0]], ROLES[roles[-1]], len(sequence) - 1 - legal,
        *(int(counts[f]) for f in (BLANK, DUPLICATE, TRUNCATED)),
    )


_FAULT_COUNTS = ["blank", "duplicate", "truncated"]
_MATRIX = "first string, last string, illegal long, blank long, duplicate long, truncated long, cost array<long>, ranks array<long>"
_LONGS = pa.list_(pa.int64())


def _id_type(rows: DataFrame) -> str:
    return rows.schema[ID].dataType.simpleString()


def _with_id(rows: pa.RecordBatch, *fields: tuple[str, pa.DataType]) -> pa.Schema:
    return pa.schema([rows.schema.field(0), *fields])


def _matrices(sequences: DataFrame, grammar: Grammar) -> DataFrame:
    """Every sequence as one matrix, with what is counted in it."""

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=1 << 12)
        def known(sequence: str) -> tuple:
            matrix = grammar.matrix(grammar.compress(sequence))
            return (
                *_profile(sequence),
                [c for row in matrix for c in row.cost],
                [c for row in matrix for c in row.order],
            )

        for rows in batches:
            schema = _with_id(
                rows, ("slice", pa.int32()), ("first", pa.string()), ("last", pa.string()),
                *[(name, pa.int64()) for name in ("illegal", *_FAULT_COUNTS)],
                ("cost", _LONGS), ("ranks", _LONGS),
            )
            found = [known(sequence) for sequence in rows.column(2).to_pylist()]
            columns = [list(c) for c in zip(*found, strict=True)] if found else [[]] * 8
            yield batch(schema, rows.column(0), rows.column(1), *columns)

    return sequences.select(ID, "slice", "sequence").mapInArrow(
        up, f"{ID} {_id_type(sequences)}, slice int, {_MATRIX}"
    )


def _whole(matrices: DataFrame) -> DataFrame:
    """Per conversation cost, counts, and the states each slice begins and ends in.

    A conversation has one matrix per slice, so a group has at most as many rows as there are
    slices.
    """
    grouped = matrices.groupBy(ID).agg(
        F.sort_array(F.collect_list(F.struct("slice", "first", "last", "cost", "ranks"))).alias("m"),
        *[F.sum(c).alias(c) for c in ("illegal", *_FAULT_COUNTS)],
    )
    ways = pa.list_(
        pa.struct([("slice", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("tail", pa.string())])
    )

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out: list[list] = [[], [], []]
            for parts in rows.column(1).to_pylist():
                row, via = UNIT[0], []
                for part in parts:
                    at = range(0, STATES * STATES, STATES)
                    matrix = tuple(
                        Row(tuple(part["cost"][i : i + STATES]), tuple(part["ranks"][i : i + STATES]), ())
                        for i in at
                    )
                    row = _advance(row.cost, row.order, matrix)
                    via.append(row.via)
                cost, end, tail = closing(row)
                seams = sum(
                    a["last"] + b["first"] not in _LEGAL
                    for a, b in zip(parts, parts[1:], strict=False)
                )
                way = []
                for part, middles in zip(reversed(parts), reversed(via), strict=True):
                    way.append(
                        {"slice": part["slice"], "start": middles[end], "end": end, "tail": tail}
                    )
                    end, tail = middles[end], ""
                for column, item in zip(out, (cost, seams, way), strict=True):
                    column.append(item)
            schema = _with_id(
                rows, ("cost", pa.int64()), ("seams", pa.int64()), ("way", ways),
                *[(name, pa.int64()) for name in ("illegal", *_FAULT_COUNTS)],
            )
            yield batch(schema, rows.column(0), *out, *rows.columns[2:])

    found = grouped.mapInArrow(
        chain,
        f"{ID} {_id_type(matrices)}, cost long, seams long,"
        " way array<struct<slice:int,start:int,end:int,tail:string>>,"
        " illegal long, blank long, duplicate long, truncated long",
    )
    return stage_table(
        found.withColumn("illegal", F.col("illegal") + F.col("seams")).drop("seams"), "whole"
    )


def _edits(sequences: DataFrame, whole: DataFrame, grammar: Grammar) -> DataFrame:
    """The edits of each different row, per conversation and slice, in order."""
    way = whole.select(F.col(ID).alias("_id"), F.inline("way")).withColumnRenamed("slice", "_slice")
    here = F.col(ID).eqNullSafe(F.col("_id")) & (F.col("slice") == F.col("_slice"))
    kind = pa.list_(pa.string())

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=1 << 12)
        def known(sequence: str, start: int, end: int) -> list[str]:
            return grammar.read(grammar.compress(sequence), start, end)

        for rows in batches:
            found = []
            asked = [rows.column(k).to_pylist() for k in range(2, 6)]
            for symbols, start, end, tail in zip(*asked, strict=True):
                edits = known("".join(symbols), start, end)
                ends = np.cumsum([0, *map(len, symbols)]).tolist()
                own = ["".join(edits[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                own[-1] += tail
                found.append(own)
            schema = _with_id(rows, ("slice", pa.int32()), ("edits", kind))
            yield batch(schema, rows.column(0), rows.column(1), found)

    read = sequences.join(way, here).select(
        ID, "slice", "symbols", "start", "end", "tail"
    )
    return read.mapInArrow(down, f"{ID} {_id_type(sequences)}, slice int, edits array<string>")


class Repair(NamedTuple):
    """Per conversation (with rows) faults, cost and audit; and the rows of all repaired ones.

    ``rows`` are in order of (slice, turn, said, part) within their conversation.
    """

    report: DataFrame
    rows: DataFrame


def repair(conversations: DataFrame, rules: int = RULES) -> Repair:
    """The cheapest repair of conversations given as rows (conv_id, turn, role, text)."""
    prepare(conversations.sparkSession)
    rows = _sliced(_classed(conversations))
    sequences = _sequences(rows)
    grammar = learn_grammar(sequences, rules)
    whole = _whole(stage_table(_matrices(sequences, grammar), "matrices"))
    edits = stage_table(_edits(sequences, whole, grammar), "edits")
    pieces = F.sort_array(F.collect_list(F.struct("slice", F.array_join("edits", "").alias("piece"))))
    audits = edits.groupBy(ID).agg(
        F.translate(F.array_join(pieces["piece"], ""), "UAkua-", "IIKRRD").alias("audit")
    )
    turns = rows.select(ID, "turn").distinct().groupBy(ID).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
        .cast("long")
        .alias("gaps")
    )
    report = _same_conversation(_same_conversation(whole.drop("way"), audits), turns)
    return Repair(report, _repaired_rows(rows, sequences, edits))


def _repaired_rows(rows: DataFrame, sequences: DataFrame, edits: DataFrame) -> DataFrame:
    keyed = edits.withColumnRenamed(ID, "_id").withColumnRenamed("slice", "_slice")
    here = F.col(ID).eqNullSafe(F.col("_id")) & (F.col("slice") == F.col("_slice"))
    zipped = F.explode(F.arrays_zip("turn", "said", "edits")).alias("_row")
    edited = (
        sequences.join(keyed, here)
        .select("_id", "_slice", zipped)
        .select("_id", "_slice", "_row.*")
        .toDF("_id", "_slice", "_turn", "_said", "edits")
        # A row that only goes leaves nothing.
        .where(F.translate("edits", "-", "") != "")
    )
    edited = stage_table(edited, "edited")
    same = (
        here
        & F.col("turn").eqNullSafe(F.col("_turn"))
        & (F.col("said") == F.col("_said"))
    )
    letter = F.col("_edit")
    role = (
        F.when(letter.isin("u", "U"), F.lit("user"))
        .when(letter.isin("a", "A"), F.lit("assistant"))
        .otherwise(F.col("role"))
    )
    text = F.when(letter.isin("U", "A"), F.lit("")).otherwise(F.col("text"))
    return (
        rows.join(edited, same)
        .select(
            ID, "slice", "turn", "said", "role", "text",
            F.posexplode(F.split("edits", "")).alias("part", "_edit"),
        )
        .where(letter.isin("k", "u", "a", "U", "A"))
        .select(ID, "slice", "turn", "said", "part", role.alias("role"), text.alias("text"))
    )


def digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines, as a stream in order."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, running, field = None, None, None
        for rows in batches:
            field = rows.schema.field(0)
            done: list[tuple] = []
            for conv, role, text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                line = f"{role}:{text}".encode()
                if running is not None and conv == current:
                    running.update(b"\n" + line)
                    continue
                if running is not None:
                    done.append((current, running.hexdigest()))
                current, running = conv, hashlib.sha256(line)
            yield from _digest_rows(field, done)
        if running is not None:
            yield from _digest_rows(field, [(current, running.hexdigest())])

    ordered = rows.repartition(ID).sortWithinPartitions(ID, "slice", "turn", "said", "part")
    return ordered.select(ID, "role", "text").mapInArrow(
        stream, f"{ID} {_id_type(rows)}, repaired_sha256 string"
    )


def _digest_rows(field: pa.Field, done: list[tuple]) -> Iterator[pa.RecordBatch]:
    if done:
        schema = pa.schema([field, ("repaired_sha256", pa.string())])
        yield batch(schema, *[list(c) for c in zip(*done, strict=True)])


NOTHING = hashlib.sha256(b"").hexdigest()
_REPORT = ["gaps", *_FAULT_COUNTS, "illegal", "cost"]


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """A row per conversation: what ``damage`` left of it and how ``repair`` mends that."""
    mended = repair(damage(conversations))
    found = _same_conversation(mended.report, digests(mended.rows), "left")
    ids = conversations.select(ID).distinct()
    return _same_conversation(ids, found, "left").select(
        ID,
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _REPORT],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(NOTHING)).alias("repaired_sha256"),
    )
