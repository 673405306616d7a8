"""Cheapest repair of conversations: an integer minimum over a small DAG.

A repaired conversation is empty, or an optional system turn and then pairs of a
user turn and an assistant turn. Each turn is kept (K), given another role (R) or
deleted (D), and turns without text are inserted (I). Nodes of the DAG are a place
between two turns and the role that the repaired turns end in so far; edges are the
edits of a turn, with an insertion before them or not. The weight of an edge is one
integer: its high digits are the cost, and below them every turn has one digit of
its own for the audit letters of its edits. The codes of the letters keep their
order in ASCII, and no code begins another, so among equal costs the smaller number
is the audit that comes first, and the plain minimum of sums decides everything. A
digit of zero at the end stands for no insertion there, so a shorter audit is less.

One insertion before a turn is enough: of two in a row without a kept turn between
them both can go, which leaves a shorter valid repair, unless they are all there is
behind a system turn, and deleting that is cheaper. None stands right before a
deletion: swapped, the two cost the same and come first.

Long conversations are cut into pieces of ``PIECE`` places. A piece becomes a table
of its cheapest edits from each role to each other, found by tasks side by side.
Pieces are then joined by the same minimum, with one digit a piece for the order of
its audits, and each piece reads off the edits that the cheapest way takes. A
conversation thus meets in one task as one row for ``PIECE`` turns; only its text
runs through one task at the end, streamed into the hash, which has no other way.

Defined results: rows are ordered by turn (without one first), then role, then text;
equal rows are neighbours. Nulls in role and text count as one space, and in the id
and turn that decide on the damage too. Rows without a conversation id are one
conversation without id. A role that begins with none of ``sua`` cannot be kept. An
empty table gives no rows. Columns other than the four are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.sources import discard, fresh_dir, keep

# Places of a piece, as a power of two.
PIECE_BITS = 12
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLANK, DUPLICATE, CUT_OFF = "blank", "duplicate", "truncated"
ROLES = {"s": "system", "u": "user", "a": "assistant"}
# What repaired turns end in: nothing, or a role. Which roles may follow, and which ends are whole.
STATES = ["", "s", "u", "a"]
FOLLOWS = {"": "su", "s": "u", "u": "a", "a": "u"}
WHOLE = ("", "a")
# Codes of the edits of one turn in the order of ASCII; a code is one octal digit, zero is none.
CODES = ["", "D", "IK", "IR", "K", "R"]
DIGIT_BITS = 3
# A piece has at most one audit for each pair of states.
PIECE_DIGIT_BITS = 5

SPACES = " \t\n\x0b\f\r"


def damaged(turns: DataFrame, one_in: int = 20) -> DataFrame:
    """``conv_id, turn, role, text`` with faults by ``crc32(conv_id:turn) % one_in``, nulls as one space.

    0 drops a row, 1 empties its text, 2 takes ``.!?`` from it, 3 repeats it, 4 makes it the user's.
    """
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name) % one_in).alias("fate"))
    fated = rows.where("fate <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "")
        .when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("repeat"),
    )
    return fated.drop("repeat")


def repair(turns: DataFrame, every: DataFrame | None = None, piece_bits: int = PIECE_BITS) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    One row for each conversation id of ``turns``, or of ``every``, if that is given.
    """
    spark, passing = turns.sparkSession, fresh_dir(turns.sparkSession, "repair")
    placed = keep(_placed(turns), "turns", base=passing)
    narrow = placed.select(
        F.shiftright("place", piece_bits).alias("piece"), "place", "conv_id", "first", "fault", "copies"
    )
    by_piece = narrow.repartition("piece").sortWithinPartitions("place")
    id_type = turns.schema["conv_id"].dataType.simpleString()
    pieces = keep(
        by_piece.mapInArrow(
            _summarise,
            f"conv_id {id_type}, piece long, begins string, ends string, illegal long, costs array<long>, orders array<int>",
        ),
        "pieces",
        base=passing,
    )
    ways = keep(
        pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(
            _join_pieces,
            f"conv_id {id_type}, piece long, enter int, leave int, closing boolean, illegal long, cost long",
        ),
        "ways",
        base=passing,
    )
    chosen = ways.select(
        F.col("conv_id").alias("way_id"), F.col("piece").alias("way_piece"), "enter", "leave", "closing"
    )
    led = narrow.join(
        chosen, F.col("conv_id").eqNullSafe(F.col("way_id")) & (F.col("piece") == F.col("way_piece"))
    )
    edits = led.repartition("piece").sortWithinPartitions("place").mapInArrow(
        _read_off, "edited long, letters string, turns string"
    )
    texts = placed.join(edits, F.col("place") == F.col("edited")).select(
        "conv_id", "place", "letters", "turns", "role", "text"
    )
    hashed = texts.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(
        _hash_texts, f"conv_id {id_type}, audit string, repaired_sha256 string"
    )
    counts = placed.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps"),
        *[
            F.sum(F.when(F.col("fault") == name, 1).otherwise(0) + extra).cast("long").alias(name)
            for name, extra in (
                (BLANK, F.when(F.col("fault") == BLANK, F.col("copies") - 1).otherwise(0)),
                (DUPLICATE, F.when(F.col("fault") == BLANK, 0).otherwise(F.col("copies") - 1)),
                (CUT_OFF, F.lit(0)),
            )
        ],
    )
    totals = ways.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    ids = (turns if every is None else every).select("conv_id").distinct()
    # A result of its own: what it was made of can go.
    result = keep(reduce(_with_id, (counts, totals, hashed), ids), "repaired")
    discard(spark, passing)
    return result.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", BLANK, DUPLICATE, CUT_OFF, "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _with_id(left: DataFrame, right: DataFrame) -> DataFrame:
    right = right.withColumnRenamed("conv_id", "right_id")
    return left.join(right, F.col("conv_id").eqNullSafe(F.col("right_id")), "left").drop("right_id")


def _placed(turns: DataFrame) -> DataFrame:
    """Equal rows once, with their number, fault and place in the order of all conversations.

    The fault is that of the first of equal rows; the others are duplicates, or blank too.
    """
    keys = ["conv_id", "turn", "role", "text"]
    single = turns.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    earliest = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    content = F.xxhash64("role", "text")
    # The first turn of each text of a conversation; texts by hash and text, so that few bytes are compared.
    seen = (
        single.groupBy("conv_id", content.alias("content"), "role", "text")
        .agg(F.min(earliest).alias("earliest"), F.count(F.lit(1)).alias("times"))
        .where("times > 1")
        .select(*[F.col(c).alias(f"seen_{c}") for c in ("conv_id", "content", "role", "text", "earliest")])
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(c).eqNullSafe(F.col(f"seen_{c}")) for c in ("conv_id", "content", "role", "text")],
    )
    marked = single.withColumn("content", content).join(seen, same, "left")
    is_again = F.col("seen_earliest").isNotNull() & ~F.col("seen_earliest").eqNullSafe(earliest)
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    fault = (
        F.when(last == "", BLANK).when(is_again, DUPLICATE).when(~last.isin(".", "!", "?"), CUT_OFF)
    )
    rows = marked.select(*keys, F.left("role", F.lit(1)).alias("first"), fault.alias("fault"), "copies")
    order = [F.col(c).asc_nulls_first() for c in keys]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The upper bits are the range, the lower 33 the place in it.
    return ranged.withColumn("place", F.monotonically_increasing_id())


def edits(first: str, fault: str | None, state: str) -> Iterator[tuple[str, str, int]]:
    """Code, new state and cost of each way to go on from ``state`` over a turn."""
    yield "D", state, DELETE
    if fault in (BLANK, DUPLICATE):
        return
    more = TRUNCATED if fault == CUT_OFF else 0
    for inserted in ("", *[r for r in FOLLOWS[state] if r != "s"]):
        code, cost = ("I", INSERT + more) if inserted else ("", more)
        for role in FOLLOWS[inserted or state]:
            if role == first:
                yield code + "K", role, cost + KEEP
            elif role != "s":
                yield code + "R", role, cost + REROLE


_EDITS = {
    (first, fault, state): [(CODES.index(c), STATES.index(s), cost) for c, s, cost in edits(first, fault, state)]
    for first in ("s", "u", "a", "?")
    for fault in (None, BLANK, DUPLICATE, CUT_OFF)
    for state in STATES
}


def _steps(rows: list[dict]) -> list[list[list[tuple[int, int, int]]]]:
    return [
        [_EDITS[row["first"] if row["first"] in ROLES else "?", row["fault"], state] for state in STATES]
        for row in rows
    ]


def _forward(steps: list, enter: int) -> list[list[int | None]]:
    """Least weight at every place and state, from one state before the first turn."""
    digits = DIGIT_BITS * len(steps)
    least: list[list[int | None]] = [[None] * len(STATES)]
    least[0][enter] = 0
    for number, step in enumerate(steps, 1):
        shift = digits - DIGIT_BITS * number
        row: list[int | None] = [None] * len(STATES)
        for state, before in enumerate(least[-1]):
            if before is not None:
                for code, to, cost in step[state]:
                    weight = before + (cost << digits) + (code << shift)
                    if row[to] is None or weight < row[to]:
                        row[to] = weight
        least.append(row)
    return least


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per piece of a conversation: its ends, illegal pairs, and edits from state to state.

    ``costs`` has -1 where no edits lead; ``orders`` numbers the different audits of the piece.
    """
    names = ["conv_id", "piece", "begins", "ends", "illegal", "costs", "orders"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    for groups, kind in _batched(batches, ["piece", "conv_id"]):
        found = []
        for rows in groups:
            steps = _steps(rows)
            weights = [w for enter in range(len(STATES)) for w in _forward(steps, enter)[-1]]
            digits = DIGIT_BITS * len(rows)
            audits = [None if w is None else w & ((1 << digits) - 1) for w in weights]
            order = {audit: number for number, audit in enumerate(sorted({a for a in audits if a is not None}), 1)}
            # Equal rows behind the first are deleted.
            again = sum(row["copies"] - 1 for row in rows)
            pairs = sum(_is_illegal(a["first"], b["first"]) for a, b in zip(rows, rows[1:]))
            found.append(
                (
                    rows[0]["conv_id"],
                    rows[0]["piece"],
                    rows[0]["first"],
                    rows[-1]["first"],
                    again + pairs,
                    [-1 if w is None else (w >> digits) + DELETE * again for w in weights],
                    [0 if a is None else order[a] for a in audits],
                )
            )
        yield _table(found, names, [kind.field("conv_id").type, *types])


def _is_illegal(one: str, other: str) -> bool:
    return one + other not in ("su", "ua", "au")


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states in which the cheapest way enters and leaves each piece of a conversation.

    ``closing`` marks a piece behind which a turn is inserted at the end. A piece has the cost of
    its own edits and the illegal pairs in it and at its beginning.
    """
    names = ["conv_id", "piece", "enter", "leave", "closing", "illegal", "cost"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]
    for groups, kind in _batched(batches, ["conv_id"]):
        out = []
        for pieces in groups:
            for number, (piece, (enter, leave, cost)) in enumerate(zip(pieces, _way(pieces))):
                closing = number == len(pieces) - 1 and STATES[leave] not in WHOLE
                illegal = piece["illegal"]
                if number:
                    illegal += _is_illegal(pieces[number - 1]["ends"], piece["begins"])
                cost += INSERT if closing else 0
                out.append((piece["conv_id"], piece["piece"], enter, leave, closing, illegal, cost))
        yield _table(out, names, [kind.field("conv_id").type, *types])


def _way(pieces: list[dict]) -> list[tuple[int, int, int]]:
    """State before, state behind and cost of each piece on the way of least weight."""
    # One more digit for an insertion at the end.
    digits, size = PIECE_DIGIT_BITS * (len(pieces) + 1), len(STATES)
    least: list[dict[int, int]] = [{0: 0}]
    for number, piece in enumerate(pieces, 1):
        shift = digits - PIECE_DIGIT_BITS * number
        row: dict[int, int] = {}
        for enter, before in least[-1].items():
            for leave in range(size):
                cost = piece["costs"][enter * size + leave]
                if cost >= 0:
                    weight = before + (cost << digits) + (piece["orders"][enter * size + leave] << shift)
                    row[leave] = min(weight, row.get(leave, weight))
        least.append(row)
    ends = {state: least[-1][state] for state in range(size) if STATES[state] in WHOLE and state in least[-1]}
    user = STATES.index("u")
    if user in least[-1]:
        ends[user] = least[-1][user] + (INSERT << digits) + 1
    state, path = min(ends, key=ends.get), []
    for number in range(len(pieces), 0, -1):
        piece, shift = pieces[number - 1], digits - PIECE_DIGIT_BITS * number
        for enter, before in least[number - 1].items():
            cost = piece["costs"][enter * size + state]
            if cost >= 0 and before + (cost << digits) + (piece["orders"][enter * size + state] << shift) == least[number][state]:
                path.append((enter, state, cost))
                state = enter
                break
    return path[::-1]


def _batched(
    batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 5000
) -> Iterator[tuple[list[list[dict]], pa.Schema]]:
    """Groups of neighbouring rows with equal keys, about ``rows`` rows at once, and their schema."""
    kind: pa.Schema | None = None

    def read() -> Iterator[dict]:
        nonlocal kind
        for batch in batches:
            kind = batch.schema
            yield from batch.to_pylist()

    groups, size = [], 0
    for _, group in groupby(read(), key=lambda row: [row[k] for k in keys]):
        groups.append(list(group))
        size += len(groups[-1])
        if size >= rows:
            yield groups, kind
            groups, size = [], 0
    if groups:
        yield groups, kind


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(types)], names=names
    )


def _read_off(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Letters of each turn's edits and the repaired turns they give, by place.

    A repaired turn is ``k`` with its own role and text, ``u`` or ``a`` with that role and its own
    text, ``U`` or ``A`` with that role and no text.
    """
    for groups, _ in _batched(batches, ["piece", "conv_id"]):
        out = []
        for rows in groups:
            steps = _steps(rows)
            least = _forward(steps, rows[0]["enter"])
            digits, state, parts = DIGIT_BITS * len(rows), rows[0]["leave"], []
            for number in range(len(rows), 0, -1):
                shift = digits - DIGIT_BITS * number
                code, before, role = next(
                    (code, before, to)
                    for before, weight in enumerate(least[number - 1])
                    if weight is not None
                    for code, to, cost in steps[number - 1][before]
                    if to == state and weight + (cost << digits) + (code << shift) == least[number][state]
                )
                parts.append((CODES[code], STATES[before], STATES[role]))
                state = before
            for row, (letters, before, role) in zip(rows, reversed(parts)):
                turns = _inserted(before, role).upper() if letters[0] == "I" else ""
                turns += {"K": "k", "R": role, "D": ""}[letters[-1]]
                out.append([row["place"], letters + "D" * (row["copies"] - 1), turns])
            if rows[0]["closing"]:
                out[-1][1] += "I"
                out[-1][2] += "A"
        yield _table(out, ["edited", "letters", "turns"], [pa.int64(), pa.string(), pa.string()])


def _inserted(before: str, role: str) -> str:
    """The role between two states."""
    return next(r for r in FOLLOWS[before] if r != "s" and role in FOLLOWS[r])


def _hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and hash of every conversation; texts run through and are not gathered."""
    names, found, digest = ["conv_id", "audit", "repaired_sha256"], [], None
    for batch in batches:
        types = [batch.schema.field("conv_id").type, pa.string(), pa.string()]
        for row in batch.to_pylist():
            if digest is None or row["conv_id"] != current:
                if digest is not None:
                    found.append((current, "".join(letters), digest.hexdigest()))
                digest, letters, current, between = sha256(), [], row["conv_id"], b""
            letters.append(row["letters"])
            for turn in row["turns"]:
                role = row["role"] if turn == "k" else ROLES[turn.lower()]
                text = "" if turn.isupper() else row["text"]
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
        if len(found) >= 5000:
            yield _table(found, names, types)
            found = []
    if digest is not None:
        found.append((current, "".join(letters), digest.hexdigest()))
        yield _table(found, names, types)
