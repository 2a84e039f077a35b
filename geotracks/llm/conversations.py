"""Repair of conversation structure: cheapest edits by Four-Russians block tables.

A conversation's rows, by turn, are to become rows whose role initials read ``(s?(ua)+)?``. A row
is kept (free), given the role user or assistant (3) or deleted (4); a user or assistant row of
empty text may be put in anywhere (3). Blank rows and repeats must be deleted, and a truncated row
that stays costs 3 more. Of the cheapest edits those whose initials D, I, K, R come first in ASCII
are taken, and they alone fix the repaired rows.

Each row is one of nine symbols, and what is left to pay from a place on, for the four states of
the pattern, is a vector of costs. Less its least entry there are few such vectors, so the vector
before a block of ``BLOCK`` symbols is looked up by the vector behind it and the block, in a table
made once. Vectors go from the end of a conversation to its start. Then each block is expanded
from its end, which gives the vector behind every row, and the edits are read forward from the
start: the ASCII-least one that keeps to the cost left.

Rows are numbered in order over the whole table, and 2 ** ``PIECE_BITS`` consecutive places at most
are one piece of work. A conversation of one piece is done at once. A longer one is done by its pieces:
each gives a map from the vector behind it to the vector before it, and with that known, from the
state before it to the state behind it. ``_scan`` joins such maps by groups of as many, over as
many levels as there must be, so no task meets a whole conversation. Only the digest of the
repaired text, a chain by its nature, passes a conversation's rows through one task, as a stream.

Null role and text are read as one space. A null conversation id is a conversation. Null turns
come first; rows of one turn are ordered by a digest of their role and text. Very long texts are
read by Spark's expressions and never gathered. Equal rows are repeats of the first of them.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotracks.operators.ordering import number_rows
from geotracks.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Symbols: must be deleted; role initial s, u, a or another, whole and (upper case) truncated; no row.
SYMBOLS = "xsuaoSUAO-"
PAD = SYMBOLS.index("-")
BLOCK = 4
#: Rows of a piece, and pieces that are joined at a time, as a power of two.
PIECE_BITS = 12
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The state behind the next user or assistant row, and that row's initial.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
INITIAL = "uuau"
SPACE = r"\x20\x09-\x0D"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) after damage that depends on crc32(conv_id:turn) % 20.

    0 drops a row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats the row, 4 makes it a
    user's. Nulls are read as one space.
    """
    text_of = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")), "utf-8")) % 20
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    return (
        rows.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("_kind"))
        .where("_kind <> 0")
        .withColumn("_copies", F.explode(F.expr("if(_kind = 3, array(1, 2), array(1))")))
        .select("conv_id", "turn", role.alias("role"), text.alias("text"))
    )


class Repair:
    """The faults, edits and repaired rows of conversations (conv_id, turn, role, text).

    ``faults``: counts of each conversation, and its first and last place. ``edits``: for each row
    by ``place`` the edits that end with its own, and the initials of the roles they give, ``-``
    where a row goes. Extra columns are left out.
    """

    def __init__(self, rows: DataFrame):
        self.rows = _ordered(rows)
        self.marked = materialize(_marked(self.rows))
        pieces = _pieces(self.marked)
        self.faults = materialize(_faults(self.marked, pieces))
        self.edits = materialize(_edits(pieces, self.faults))

    def repaired(self) -> DataFrame:
        """(_conv, place, line, role, text): the rows as they are after the edits, in that order."""
        each = F.explode(F.sequence(F.lit(1), F.length("_ops")))
        op, initial = F.col("_ops").substr(F.col("line"), F.lit(1)), F.col("_roles").substr(F.col("line"), F.lit(1))
        full = F.when(F.col("_initial") == "u", "user").otherwise("assistant")
        return (
            self.rows.join(_by_row(self.edits), "place")
            .withColumn("line", each).select("*", op.alias("_op"), initial.alias("_initial")).where("_op <> 'D'")
            .select(
                "_conv", "place", "line", F.when(F.col("_op") == "K", F.col("role")).otherwise(full).alias("role"),
                F.when(F.col("_op") == "I", "").otherwise(F.col("text")).alias("text"),
            )
        )

    def audits(self) -> DataFrame:
        """(_conv, audit, cost): the initials of all edits of a conversation."""
        found = self.edits.groupBy("_conv").agg(
            F.array_sort(F.collect_list(F.struct("_piece", "_audit"))).alias("_all"), F.sum("_paid").alias("cost")
        )
        return found.select("_conv", F.array_join(F.col("_all._audit"), "").alias("audit"), "cost")


def report(rows: DataFrame, of: DataFrame) -> DataFrame:
    """Faults, cost, audit and the digest of the repair, for each conv_id of the table ``of``.

    A conversation without rows has zeros, no edits and the digest of an empty text.
    """
    repair = Repair(rows)
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    ids = of.select(F.struct("conv_id").alias("_conv")).distinct()
    return (
        ids.join(repair.faults, "_conv", "left").join(repair.audits(), "_conv", "left").join(digests(repair.repaired()), "_conv", "left")
        .select(
            "_conv.conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
        )
    )


def digests(repaired: DataFrame) -> DataFrame:
    """(_conv, repaired_sha256): lines ``role:text``, joined by newlines; one stream of rows for each conversation."""
    lines = repaired.select("_conv", "place", "line", F.concat("role", F.lit(":"), "text").alias("_line"))
    together = lines.repartition("_conv").sortWithinPartitions("_conv", "place", "line").select("_conv", "_line")
    schema = f"_conv {repaired.schema['_conv'].dataType.simpleString()}, repaired_sha256 string"
    return together.mapInArrow(_digest, schema)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, chain, kind = None, None, None
    for batch in batches:
        kind, done = batch["_conv"].type, []
        for conv, line in zip(batch["_conv"].to_pylist(), batch["_line"]):
            if chain is None or conv != at:
                if chain is not None:
                    done.append((at, chain.hexdigest()))
                at, chain = conv, hashlib.sha256()
            else:
                chain.update(b"\n")
            chain.update(line.as_buffer())
        if done:
            yield _digest_batch(done, kind)
    if chain is not None:
        yield _digest_batch([(at, chain.hexdigest())], kind)


def _digest_batch(done: list, kind: pa.DataType) -> pa.RecordBatch:
    convs, texts = zip(*done)
    return pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(texts, pa.string())], ["_conv", "repaired_sha256"])


# --- rows to pieces -----------------------------------------------------------------------


def _ordered(rows: DataFrame) -> DataFrame:
    """``rows`` in order, each with its ``place`` in the whole table."""
    text_of = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    bare = F.regexp_replace("text", f"[{SPACE}]+\\z", "")
    last = F.substring(bare, -1, 1)
    keyed = rows.select(F.struct("conv_id").alias("_conv"), F.col("turn").cast("long").alias("turn"), text_of("role").alias("role"), text_of("text").alias("text"))
    keyed = keyed.select(
        "*",
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("_digest"),
        F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o").alias("_class"),
        (F.length(bare) == 0).alias("_blank"), (~last.isin(".", "!", "?")).alias("_truncated"),
        F.monotonically_increasing_id().alias("_tie"),
    )
    # the last key parts rows that are equal, however many they are
    return number_rows(keyed, ["_conv", "turn", "_digest", "_tie"], name="place").drop("_tie")


def _marked(rows: DataFrame) -> DataFrame:
    """Places with their first fault, symbol, role class and turn. Only digests meet, not texts."""
    first = rows.where("not _blank").groupBy("_conv", "_digest").agg(F.min("place").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    seen = rows.select("_conv", "_digest", "place", "turn", "_class", "_blank", "_truncated").join(first, ["_conv", "_digest"], "left")
    fault = F.when(F.col("_blank"), "blank").when(F.col("place") > F.col("_first"), "duplicate").when(F.col("_truncated"), "truncated")
    symbol = F.when(fault.isin("blank", "duplicate"), "x").when(fault == "truncated", F.upper("_class")).otherwise(F.col("_class"))
    return seen.select("_conv", "place", "turn", "_class", fault.alias("_fault"), symbol.alias("_symbol"))


def _pieces(marked: DataFrame) -> DataFrame:
    """(_conv, _piece, _first, _symbols, illegal): runs of rows of a conversation.

    A piece's last row goes on to the next piece too, so that a pair of neighbours is never cut.
    """
    piece = F.shiftright("place", PIECE_BITS)
    onward = F.shiftright(F.col("place") + 1, PIECE_BITS)
    rows = marked.select("_conv", "place", "_class", "_symbol", F.explode(F.array_distinct(F.array(piece, onward))).alias("_piece"))
    row = F.struct("place", "_class", F.when(piece == F.col("_piece"), F.col("_symbol")).otherwise("").alias("_symbol"))
    joined = rows.groupBy("_conv", "_piece").agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    return joined.select(
        "_conv", "_piece", F.greatest(F.col("_rows")[0]["place"], F.shiftleft("_piece", PIECE_BITS)).alias("_first"),
        F.array_join(F.col("_rows._symbol"), "").alias("_symbols"), _illegal(F.array_join(F.col("_rows._class"), "")).alias("_illegal"),
    )


def _illegal(initials: Column) -> Column:
    """Neighbours in ``initials`` that are not su, ua or au."""
    pairs = F.length(initials) - 1
    return (pairs - F.regexp_count(initials, F.lit("[sa](?=u)|u(?=a)"))).cast("long")


def _faults(marked: DataFrame, pieces: DataFrame) -> DataFrame:
    count = lambda fault: F.count_if(F.col("_fault") == fault).alias(fault)
    found = marked.groupBy("_conv").agg(
        F.min("place").alias("_begin"), F.max("place").alias("_end"), count("blank"), count("duplicate"), count("truncated"),
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
    )
    return found.join(pieces.groupBy("_conv").agg(F.sum("_illegal").alias("illegal")), "_conv")


# --- edits --------------------------------------------------------------------------------


def _edits(pieces: DataFrame, faults: DataFrame) -> DataFrame:
    """Pieces with the edits of their rows, _audit and what the edits cost, _paid."""
    spans = faults.select("_conv", F.shiftright("_begin", PIECE_BITS).alias("_from"), F.shiftright("_end", PIECE_BITS).alias("_to"))
    known = pieces.where("_symbols <> ''").select("_conv", "_piece", "_first", "_symbols").join(spans, "_conv")
    short = known.where("_from = _to").select("*", F.lit(0).alias("_behind"), F.lit(START).alias("_before"))
    long = materialize(known.where("_from < _to"))
    if not long.isEmpty():
        maps = long.mapInArrow(_each(lambda t, b: t.maps(b["_symbols"])), "_conv {0}, _piece long, _map binary".format(_kind(long)))
        long = materialize(long.join(_scan(maps, 0, backward=True).withColumnRenamed("_at", "_behind"), ["_conv", "_piece"]))
        maps = long.mapInArrow(_each(lambda t, b: t.walks(b["_symbols"], b["_behind"])), "_conv {0}, _piece long, _map binary".format(_kind(long)))
        long = long.join(_scan(maps, START, backward=False).withColumnRenamed("_at", "_before"), ["_conv", "_piece"])
        short = short.unionByName(long)
    schema = f"_conv {_kind(known)}, _piece long, _first long, _ops array<string>, _roles array<string>, _audit string, _paid long"
    return short.withColumn("_last", F.col("_piece") == F.col("_to")).mapInArrow(_trace, schema)


def _kind(table: DataFrame) -> str:
    return table.schema["_conv"].dataType.simpleString()


def _by_row(edits: DataFrame) -> DataFrame:
    """(place, _ops, _roles) of every row."""
    rows = edits.select("_first", F.posexplode(F.arrays_zip("_ops", "_roles")).alias("_n", "_row"))
    return rows.select((F.col("_first") + F.col("_n")).alias("place"), "_row._ops", "_row._roles")


def _scan(maps: DataFrame, first: int, backward: bool) -> DataFrame:
    """(_conv, _piece, _at): what goes into each piece, if ``first`` goes into a conversation's first one.

    ``_map`` of a piece gives what comes out of it, for each value that goes in. The first piece is
    the last one if ``backward``. Maps of neighbours are joined to the map of a group of them, level
    by level, until a conversation is one group; then values are handed down again.
    """
    group = F.shiftright("_piece", PIECE_BITS)
    levels = [materialize(maps)]
    while not levels[-1].groupBy("_conv").count().where("count > 1").isEmpty():
        levels.append(materialize(_members(levels[-1], group).mapInArrow(_joined(backward), levels[-1].schema)))
    at = levels[-1].select("_conv", "_piece", F.lit(first).alias("_at"))
    for below in reversed(levels[:-1]):
        known = _members(below, group).join(at, ["_conv", "_piece"])
        at = materialize(known.mapInArrow(_handed_down(backward), f"_conv {_kind(maps)}, _piece long, _at int"))
    return at


def _members(level: DataFrame, group: Column) -> DataFrame:
    members = F.array_sort(F.collect_list(F.struct("_piece", "_map")))
    return level.groupBy("_conv", group.alias("_up")).agg(members.alias("_members")).withColumnRenamed("_up", "_piece")


def _joined(backward: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for members in batch["_members"].to_pylist():
                parts = [np.frombuffer(m["_map"], np.uint8) for m in (reversed(members) if backward else members)]
                whole = parts[0]
                for part in parts[1:]:
                    whole = part[whole]
                maps.append(whole.tobytes())
            yield pa.RecordBatch.from_arrays([batch["_conv"], batch["_piece"], pa.array(maps, pa.binary())], ["_conv", "_piece", "_map"])

    return run


def _handed_down(backward: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, pieces, ats = [], [], []
            for row, (members, at) in enumerate(zip(batch["_members"].to_pylist(), batch["_at"].to_pylist())):
                for member in reversed(members) if backward else members:
                    of.append(row)
                    pieces.append(member["_piece"])
                    ats.append(at)
                    at = member["_map"][at]
            yield pa.RecordBatch.from_arrays(
                [batch["_conv"].take(pa.array(of, pa.int64())), pa.array(pieces, pa.int64()), pa.array(ats, pa.int32())], ["_conv", "_piece", "_at"]
            )

    return run


def _each(of):
    """A map for every piece, by the tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables()
        for batch in batches:
            if len(batch):
                maps = pa.array([m.tobytes() for m in of(tables, batch)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch["_conv"], batch["_piece"], maps], ["_conv", "_piece", "_map"])

    return run


def _trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = Tables()
    for batch in batches:
        if not len(batch):
            continue
        steps, offsets, ends = tables.trace(batch["_symbols"], batch["_behind"], batch["_before"])
        ops, roles = tables.ops[steps], tables.roles[steps]
        paid = np.add.reduceat(tables.paid[steps], offsets[:-1])
        more = batch["_last"].to_numpy(zero_copy_only=False)
        at = offsets[1:][more] - 1
        ops[at] += tables.tail_ops[ends[more]]
        roles[at] += tables.tail_roles[ends[more]]
        paid[more] += INSERT * tables.tail_length[ends[more]]
        cuts = pa.array(offsets, pa.int32())
        audits = pa.array(["".join(ops[a:b]) for a, b in zip(offsets, offsets[1:])], pa.string())
        yield pa.RecordBatch.from_arrays(
            [
                batch["_conv"], batch["_piece"], batch["_first"], pa.ListArray.from_arrays(cuts, pa.array(ops, pa.string())),
                pa.ListArray.from_arrays(cuts, pa.array(roles, pa.string())), audits, pa.array(paid, pa.int64()),
            ],
            ["_conv", "_piece", "_first", "_ops", "_roles", "_audit", "_paid"],
        )


class Tables:
    """The vectors of costs, and what symbols and blocks of symbols do to them.

    Vector 0 is that behind the last row. ``before[v, s]``: the vector before symbol ``s`` if ``v``
    is behind it; ``blocks[v, b]`` the same for block ``b``. ``step[v, s, q]`` numbers the edits from
    state ``q`` that end with a row of symbol ``s``: ``ops``, ``roles``, ``paid`` and the state ``to``.
    """

    def __init__(self):
        vectors, found, i = [self._closed([0, None, None, 0])], {}, 0
        found[vectors[0]] = 0
        before: list[list[int]] = []
        while i < len(vectors):
            row = []
            for symbol in SYMBOLS:
                vector = vectors[i] if symbol == "-" else self._less_least(self._before(vectors[i], symbol))
                if vector not in found:
                    found[vector] = len(vectors)
                    vectors.append(vector)
                row.append(found[vector])
            before.append(row)
            i += 1
        self.vectors = vectors
        self.before = np.array(before, np.uint8)
        blocks = self.before
        for _ in range(BLOCK - 1):
            # the symbol further on is met first
            blocks = self.before[blocks[:, None, :], np.arange(len(SYMBOLS))[None, :, None]].reshape(len(vectors), -1)
        self.blocks = blocks
        self.weights = len(SYMBOLS) ** np.arange(BLOCK)[::-1]
        self._make_steps()

    @staticmethod
    def _choices(symbol: str, q: int) -> list[tuple[str, str, int, int]]:
        """(edit, initial, cost, state) of a row of this symbol, in ASCII order of the edits."""
        out = [("D", "-", DELETE, q)]
        if symbol == "x":
            return out
        extra, kind = TRUNCATED * symbol.isupper(), symbol.lower()
        if kind == "s" and q == START:
            out.append(("K", "s", KEEP + extra, AFTER_S))
        elif kind == INITIAL[q]:
            out.append(("K", kind, KEEP + extra, NEXT[q]))
        return [*out, ("R", INITIAL[q], REROLE + extra, NEXT[q])]

    @staticmethod
    def _closed(costs: list) -> tuple[int, ...]:
        """Costs with rows put in first, where that is cheaper: two of them at most lead anywhere."""
        return tuple(
            min(c + INSERT * n for n, c in enumerate((costs[q], costs[NEXT[q]], costs[NEXT[NEXT[q]]])) if c is not None) for q in range(4)
        )

    def _before(self, behind: tuple[int, ...], symbol: str) -> tuple[int, ...]:
        return self._closed([min(cost + behind[to] for _, _, cost, to in self._choices(symbol, q)) for q in range(4)])

    @staticmethod
    def _less_least(vector: tuple[int, ...]) -> tuple[int, ...]:
        return tuple(c - min(vector) for c in vector)

    def _make_steps(self) -> None:
        self.step = np.zeros((len(self.vectors), len(SYMBOLS), 4), np.int64)
        ops, roles, paid, to = [], [], [], []
        for v, behind in enumerate(self.vectors):
            for s, symbol in enumerate(SYMBOLS[:PAD]):
                left = self._before(behind, symbol)
                for start in range(4):
                    q, op, role, cost = start, "", "", 0
                    while "K" not in op and "R" not in op and "D" not in op:
                        choices = self._choices(symbol, q)
                        choices.insert(1, ("I", INITIAL[q], INSERT, NEXT[q]))
                        for edit, initial, price, then in choices:
                            if left[q] == price + (left if edit == "I" else behind)[then]:
                                break
                        op, role, cost, q = op + edit, role + initial, cost + price, then
                    self.step[v, s, start] = len(ops)
                    ops.append(op)
                    roles.append(role)
                    paid.append(cost)
                    to.append(q)
        self.ops, self.roles = np.array(ops, object), np.array(roles, object)
        self.paid, self.to = np.array(paid, np.int64), np.array(to, np.int64)
        self.tail_roles = np.array(["", "ua", "a", ""], object)
        self.tail_length = np.array([len(t) for t in self.tail_roles])
        self.tail_ops = np.array(["I" * n for n in self.tail_length], object)

    def _codes(self, symbols: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all symbols, and where each text's begin; no text is empty."""
        symbols = symbols.cast(pa.large_string())
        offsets = np.frombuffer(symbols.buffers()[1], np.int64, len(symbols) + 1, symbols.offset * 8)
        letters = np.frombuffer(symbols.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        code = np.zeros(256, np.uint8)
        code[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(len(SYMBOLS))
        return code[letters], offsets - offsets[0]

    def _blocked(self, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols in blocks, each text filled up at its front; its first block; each symbol's place."""
        sizes = np.diff(offsets)
        counts = -(-sizes // BLOCK)
        first = np.concatenate(([0], np.cumsum(counts)))
        place = np.arange(len(codes)) + np.repeat(first[1:] * BLOCK - offsets[1:], sizes)
        filled = np.full(first[-1] * BLOCK, PAD, np.uint8)
        filled[place] = codes
        return filled.reshape(-1, BLOCK), first, place

    def _behind_blocks(self, blocks: np.ndarray, first: np.ndarray, behind: np.ndarray) -> np.ndarray:
        """The vectors behind every block, from those behind each text; rows of ``behind`` are texts."""
        numbers = blocks @ self.weights
        counts = np.diff(first)
        order = np.argsort(-counts, kind="stable")
        out = np.zeros((len(blocks), behind.shape[1]), np.uint8)
        now = behind[order]
        for n in range(counts.max(initial=0)):
            open_texts = np.searchsorted(-counts[order], -n, "left")
            at = first[1:][order[:open_texts]] - 1 - n
            out[at] = now[:open_texts]
            now[:open_texts] = self.blocks[now[:open_texts], numbers[at][:, None]]
        self._front = np.empty_like(now)
        self._front[order] = now
        return out

    def maps(self, symbols: pa.Array) -> np.ndarray:
        """For each text the vector before it, by the vector behind it."""
        blocks, first, _ = self._blocked(*self._codes(symbols))
        every = np.tile(np.arange(len(self.vectors), dtype=np.uint8), (len(symbols), 1))
        self._behind_blocks(blocks, first, every)
        return self._front

    def _behind_rows(self, symbols: pa.Array, behind: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes, where texts begin, and the vector behind every symbol: blocks are expanded from their ends."""
        codes, offsets = self._codes(symbols)
        blocks, first, place = self._blocked(codes, offsets)
        ends = self._behind_blocks(blocks, first, behind.to_numpy().astype(np.uint8)[:, None])[:, 0]
        rows = np.empty_like(blocks)
        for n in reversed(range(BLOCK)):
            rows[:, n] = ends
            ends = self.before[ends, blocks[:, n]]
        return codes, offsets, rows.reshape(-1)[place]

    def _forward(self, codes, offsets, vectors, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Steps of every symbol, and the states behind the texts; rows of ``states`` are texts."""
        sizes = np.diff(offsets)
        order = np.argsort(-sizes, kind="stable")
        steps = np.zeros((len(codes), states.shape[1]), np.int64)
        now = states[order]
        for n in range(sizes.max(initial=0)):
            open_texts = np.searchsorted(-sizes[order], -n, "left")
            at = offsets[:-1][order[:open_texts]] + n
            steps[at] = self.step[vectors[at][:, None], codes[at][:, None], now[:open_texts]]
            now[:open_texts] = self.to[steps[at]]
        ends = np.empty_like(now)
        ends[order] = now
        return steps, ends

    def walks(self, symbols: pa.Array, behind: pa.Array) -> np.ndarray:
        """For each text the state behind it, by the state before it, on the chosen edits."""
        codes, offsets, vectors = self._behind_rows(symbols, behind)
        return self._forward(codes, offsets, vectors, np.tile(np.arange(4), (len(symbols), 1)))[1].astype(np.uint8)

    def trace(self, symbols: pa.Array, behind: pa.Array, before: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The step of every row, where the texts' rows begin, and the states behind the texts."""
        codes, offsets, vectors = self._behind_rows(symbols, behind)
        steps, ends = self._forward(codes, offsets, vectors, before.to_numpy().astype(np.int64)[:, None])
        return steps[:, 0], offsets, ends[:, 0]
