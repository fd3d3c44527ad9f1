"""Repair of conversation structure by weighted interval parsing.

A repaired conversation's role initials are ``(s?(ua)+)?``.  The repair grammar is in Chomsky
normal form: a nonterminal (p, q) derives the spans that lead from state p to state q of
that pattern,

    (p, q) -> (p, r) (r, q)          for all states r
    (p, q) -> row                    kept, re-roled to user or assistant, or deleted
    (p, q) -> nothing                inserted turns (the insertion closure, in every cell)

and a cell of a span holds, for each nonterminal, the cheapest (cost, audit), the ASCII-least
audit of equal cost.  Audits of one span and cost are never prefixes of each other (the longer
one would add paid insertions), so least parts give the least whole.  As the nonterminals
are all pairs of states, every split of a span gives the same cell; one split of each is
enough.  Cells are combined bottom-up by span length: rows, spans of doubled length,
blocks of at most ``BLOCK_ROWS`` rows, conversations.  A span's cell depends only on
its rows' symbols (role initial and fault), so cells of short spans are memoized.

Spark's part: rows are range-partitioned by conversation and turn, so a conversation that
holds a third of all rows is cut over many tasks.  One streaming pass over each sorted
partition makes blocks; each block carries its cell and its rows.  Blocks meet by conversation
in order, and a second streaming pass joins their cells from left to right and hashes the
repaired rows on the way, one digest for each state that the repair may be in, so memory
is one block and four audits.  Repeats of role and text are found before on narrow rows
(hashes, no texts): an aggregation gives the first turn of each, and marks of the later ones
are sorted in front of their rows.

Defined results: null roles and texts are one space, also in the damage key, where a null
conv_id or turn is one space too.  Rows of equal turn follow role and a hash of
the text; a null turn comes first.  The null conv_id is a conversation.  Repeated rows are duplicates.  A role that is
empty or starts with another letter can only be re-roled or deleted.  Empty tables give
empty results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 1024
BLOCK_CHARS = 1 << 20
BLANKS = " \t\n\x0b\x0c\r"
#: States of (s?(ua)+)?: nothing yet, after s, after u, after a (the first and last may end).
STATES = "0SUA"
STEP = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}
FINAL = "0A"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

Cell = dict[tuple[str, str], tuple[int, str]]


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out: Cell = {}
    for (p, r), (c1, a1) in left.items():
        for q in STATES:
            part = right.get((r, q))
            if part is not None:
                whole = (c1 + part[0], a1 + part[1])
                if (p, q) not in out or whole < out[p, q]:
                    out[p, q] = whole
    return out


def insertion_closure() -> Cell:
    """The cell of an empty span: turns inserted before anything is read."""
    cell: Cell = {(p, p): (0, "") for p in STATES}
    one = cell | {(p, q): (INSERT, "I") for (p, x), q in STEP.items() if x in "ua"}
    while (wider := joined(one, one)) != one:
        one = wider
    return one


CLOSURE = insertion_closure()


@lru_cache(maxsize=64)
def row_cell(symbol: str) -> Cell:
    """The cell of one row: s, u, a or x (upper case: truncated), or - (must go)."""
    cell: Cell = {(p, p): (DELETE, "D") for p in STATES}
    if symbol != "-":
        extra = TRUNCATED if symbol.isupper() else 0
        moves = [(symbol.lower(), KEEP, "K"), ("u", REROLE, "R"), ("a", REROLE, "R")]
        for (p, x), q in STEP.items():
            for y, cost, edit in moves:
                if x == y and (cost + extra, edit) < cell.get((p, q), (99, "")):
                    cell[p, q] = (cost + extra, edit)
    return joined(joined(CLOSURE, cell), CLOSURE)


def span_cell(symbols: str) -> Cell:
    """The cell of a span of rows, from spans of doubled length."""
    if not symbols:
        return CLOSURE
    level = [row_cell(x) for x in symbols]
    width = 1  # rows of a span of this level, the last one may have fewer
    while len(level) > 1:
        level = [_pair(symbols[k * width:(k + 2) * width], *level[k:k + 2]) if k + 1 < len(level) else level[k]
                 for k in range(0, len(level), 2)]
        width *= 2
    return level[0]


_PAIRS: dict[str, Cell] = {}


def _pair(symbols: str, left: Cell, right: Cell) -> Cell:
    if len(symbols) > 8:
        return joined(left, right)
    found = _PAIRS.get(symbols)
    if found is None:
        if len(_PAIRS) > 50_000:
            _PAIRS.clear()
        found = _PAIRS[symbols] = joined(left, right)
    return found


def repaired_rows(state: str, audit: str, rows: list[tuple[str, str]]) -> list[str]:
    """``role:text`` of a span's rows after the edits of ``audit``, read from ``state``."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        expected = "assistant" if state == "U" else "user"
        if edit == "I":
            role, text = expected, ""
        else:
            role, text = rows[at]
            at += 1
            if edit == "R":
                role = expected
        out.append(f"{role}:{text}")
        state = STEP[state, role[0]]
    return out


class Repair:
    """A conversation's cheapest repair, its blocks fed from left to right.

    A block's rows are written when the next block comes, the last one's for one state only."""

    def __init__(self):
        # state -> (cost, audit, digest so far, whether a row was written)
        self.paths = {"0": (0, "", hashlib.sha256(), False)}
        self.last: tuple[Cell, list[tuple[str, str]]] = (CLOSURE, [])

    @staticmethod
    def _written(digest, begun: bool, state: str, audit: str, rows: list[tuple[str, str]]):
        lines = repaired_rows(state, audit, rows)
        if not lines:
            return digest, begun
        digest = digest.copy()
        digest.update((("\n" if begun else "") + "\n".join(lines)).encode())
        return digest, True

    def _after(self) -> dict[str, tuple[int, str, str, str]]:
        """state -> (cost, audit, state before the last block, audit of the last block)."""
        best: dict[str, tuple[int, str, str, str]] = {}
        for (r, q), (cost, audit) in self.last[0].items():
            if r in self.paths:
                whole = (self.paths[r][0] + cost, self.paths[r][1] + audit, r, audit)
                if q not in best or whole[:2] < best[q][:2]:
                    best[q] = whole
        return best

    def feed(self, symbols: str, rows: list[tuple[str, str]]) -> None:
        if self.last[1]:
            self.paths = {q: (cost, audit, *self._written(*self.paths[r][2:], r, edits, self.last[1]))
                          for q, (cost, audit, r, edits) in self._after().items()}
        self.last = span_cell(symbols), rows

    def result(self) -> tuple[int, str, str]:
        """(cost, audit, sha256 of the repaired rows)."""
        after = self._after()
        cost, audit, r, edits = min((after[q] for q in FINAL if q in after), key=lambda x: x[:2])
        digest, _ = self._written(*self.paths[r][2:], r, edits, self.last[1])
        return cost, audit, digest.hexdigest()


def crc_key(conv_id: str = "conv_id", turn: str = "turn") -> Column:
    """crc32 of ``conv_id:turn``."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_id, turn)]
    return F.crc32(F.concat_ws(":", *part).cast("binary"))


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage, a row for each copy."""
    kind = crc_key() % 20
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    hurt = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind != 0")
    return hurt.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(
            F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def _marks(hurt: DataFrame) -> DataFrame:
    """Keys and turns of rows whose role and text stand at an earlier turn of the conversation."""
    key = ["conv_id", "role", "h1", "h2"]
    places = hurt.select("conv_id", "role", "h1", "h2", F.struct(F.col("turn").isNotNull().alias("b"), "turn").alias("at")).distinct()
    first = places.groupBy(*key).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = first.select(*(F.col(c).alias(f"_{c}") for c in key), "first")
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return places.join(first, same).filter("at > first").select("conv_id", "at.turn", "role", "h1", "h2")


BLOCKS = ("conv_id {id}, turn_low {turn}, turn_high {turn}, turns long, symbols string, "
          "blank long, duplicate long, truncated long, illegal long, first string, last string, "
          "roles array<string>, texts array<string>")


class _Block:
    def __init__(self, conv, carried: _Block | None):
        self.conv = conv
        same = carried is not None and carried.conv == conv
        self.row = carried.row if same else None
        self.symbols, self.roles, self.texts, self.chars = [], [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turn_low = self.turn_high = None
        self.turns = 0

    def add(self, turn, role: str, text: str, marked: bool) -> None:
        row = (turn, role, text)
        fault = None
        body = text.strip(BLANKS)
        if not body:
            fault = "blank"
        elif marked or row == self.row:
            fault = "duplicate"
        elif body[-1] not in ".!?":
            fault = "truncated"
        initial = role[:1]
        x = initial if initial and initial in "sua" else "x"
        self.symbols.append("-" if fault in ("blank", "duplicate") else x.upper() if fault else x)
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        if self.roles and self.roles[-1][:1] + initial not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None:
            self.turns += turn != self.turn_high
            self.turn_low = turn if self.turn_low is None else self.turn_low
            self.turn_high = turn
        self.row = row
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text) + len(role)

    def full(self, rows: int) -> bool:
        return len(self.roles) >= rows or self.chars >= BLOCK_CHARS

    def record(self) -> tuple:
        return (self.conv, self.turn_low, self.turn_high, self.turns, "".join(self.symbols),
                self.blank, self.duplicate, self.truncated, self.illegal, self.roles[0][:1], self.roles[-1][:1],
                self.roles, self.texts)


def _batches(rows: Iterator[tuple], schema: pa.Schema, chars) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += chars(r)
        if len(held) >= 4096 or size >= 4 << 20:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _records(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        if batch.num_rows:
            yield from zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns))


def _block_schema(id_type: pa.DataType, turn_type: pa.DataType) -> pa.Schema:
    n, s = pa.int64(), pa.string()
    return pa.schema([("conv_id", id_type), ("turn_low", turn_type), ("turn_high", turn_type), ("turns", n),
                      ("symbols", s), ("blank", n), ("duplicate", n), ("truncated", n),
                      ("illegal", n), ("first", s), ("last", s), ("roles", pa.list_(s)), ("texts", pa.list_(s))])


def _blocks(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    """Blocks of a sorted partition's rows, in order.  A partition may begin inside a
    conversation; equal rows and marks never part, as all of the sort key is the range key."""
    kinds: list = []

    def typed() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not kinds:
                kinds.extend(batch.schema.field(c).type for c in ("conv_id", "turn"))
            yield batch

    def made() -> Iterator[tuple]:
        block, mark = None, None
        for conv, turn, role, h1, h2, kind, text in _records(
                typed(), ["conv_id", "turn", "role", "h1", "h2", "kind", "text"]):
            key = (conv, turn, role, h1, h2)
            if kind == 0:
                mark = key
                continue
            if block is None or block.conv != conv or block.full(block_rows):
                if block is not None:
                    yield block.record()
                block = _Block(conv, block)
            block.add(turn, role, text, key == mark)
        if block is not None:
            yield block.record()

    rows = made()
    first = next(rows, None)
    if first is not None:
        def again() -> Iterator[tuple]:
            yield first
            yield from rows
        yield from _batches(again(), _block_schema(*kinds), lambda r: sum(map(len, r[-1])))


RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


class _Conversation:
    def __init__(self, conv):
        self.conv, self.repair = conv, Repair()
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last = None

    def add(self, low, high, turns, symbols, blank, duplicate, truncated, illegal, first, last, roles, texts) -> None:
        if self.last is not None and self.last + first not in ("su", "ua", "au"):
            illegal += 1
        if low is not None:
            turns -= low == self.high  # a turn that goes on from the block before
            self.low = low if self.low is None else self.low
            self.high = high
        self.turns += turns
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.illegal += illegal
        self.last = last
        self.repair.feed(symbols, list(zip(roles, texts)))

    def record(self) -> tuple:
        gaps = 0 if self.low is None else int(self.high - self.low + 1 - self.turns)
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.result())


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds: list = []

    def typed() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not kinds:
                kinds.append(batch.schema.field("conv_id").type)
            yield batch

    def made() -> Iterator[tuple]:
        now = None
        for conv, *rest in _records(typed(), ["conv_id", "turn_low", "turn_high", "turns", "symbols", "blank", "duplicate",
                                              "truncated", "illegal", "first", "last", "roles", "texts"]):
            if now is None or now.conv != conv:
                if now is not None:
                    yield now.record()
                now = _Conversation(conv)
            now.add(*rest)
        if now is not None:
            yield now.record()

    rows = made()
    first = next(rows, None)
    if first is not None:
        def again() -> Iterator[tuple]:
            yield first
            yield from rows
        schema = pa.schema([("conv_id", kinds[0]), *((c, pa.int64()) for c in RESULT[1:7]),
                            ("audit", pa.string()), ("repaired_sha256", pa.string())])
        yield from _batches(again(), schema, lambda r: len(r[7]))


def repair_conversations(rows: DataFrame, damage: bool = True, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row for each conv_id: faults, the cheapest repair's cost, audit and digest."""
    types = dict(rows.dtypes)
    plain = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), F.lit(0).alias("copy"))
    hurt = (damaged(rows) if damage else plain).withColumns(
        {"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(7), F.col("text"))})
    key = ["conv_id", "turn", "role", "h1", "h2"]
    marks = _marks(hurt).checkpoint().select(*key, F.lit(0).alias("kind"), F.lit(None).cast("string").alias("text"))
    both = hurt.select(*key, F.lit(1).alias("kind"), "text").union(marks)
    dealt = both.repartitionByRange(*key).sortWithinPartitions(*key, "kind")
    blocks = dealt.mapInArrow(lambda batches: _blocks(batches, block_rows), BLOCKS.format(id=types["conv_id"], turn=types["turn"]))
    blocks = blocks.withColumn("at", F.monotonically_increasing_id())
    met = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "at")
    schema = f"conv_id {types['conv_id']}, " + ", ".join(f"{c} long" for c in RESULT[1:7])
    out = met.mapInArrow(_conversations, schema + ", audit string, repaired_sha256 string")
    # conversations that the damage took whole
    ids = rows.select(F.col("conv_id").alias("_id")).distinct()
    all_ids = ids.join(out, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    zero = {c: F.coalesce(c, F.lit(0)).alias(c) for c in RESULT[1:7]}
    return all_ids.select(F.col("_id").alias("conv_id"), *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
                          F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
