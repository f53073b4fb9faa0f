"""Conversations repaired by Wagner-Fischer alignment to the alternating grammar `(s?(ua)+)?`.

The roles of a repaired conversation spell nothing, or pairs of user and assistant after at most one system turn. All
such strings are beginnings of two endless ones, `uauaua...` and `suauau...`, so one table of edit costs against each of
them aligns the turns to every length at once. Edits: keep (0), change the role to user or assistant (2), delete (3, required
for blank and repeated turns), insert an empty user or assistant turn (2); a cut-off turn that stays adds 1. Rows of
the table are limited to an Ukkonen band: no cell further off the diagonal than an alignment that is already
known (change or delete each turn in order) can pay for, and the change to the best other end. Backtraces are compared by cost, then by their
letters D, I, K, R in ASCII order.

A conversation of any length is aligned in blocks of `BLOCK` turns. A block is aligned from each state of the grammar
(nothing yet, after s, after u, after a) to each; blocks are then joined in order by least (cost, audit) for each
state. Insertions stand before a turn and the last block alone adds those at the end, so each audit of a block ends with the edit
of its last turn: none is the beginning of another, and the least whole is made of least parts.

Order: by turn (null first), then role, then the text's digest; rows equal in all of these are interchangeable and are
counted before they are shuffled. The alignment moves about 50 bytes a turn; texts are shuffled once, to be hashed in order
along the audit. No step holds the texts of a conversation.

Odd rows: a null conv_id is a conversation of its own; null roles and texts are one space; a null turn sorts first and does
not count for gaps; columns beyond these four are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from metaloom.functions.bind import shuffled
from metaloom.llm.landing import land
from metaloom.shipping import ship_by_value

BLOCK = 32
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1
#: States of the grammar: nothing yet, after a system turn, after a user turn, after an assistant turn.
STATES = "0sua"
BLANK, DUPLICATE, TRUNCATED, SOUND = "blank", "duplicate", "truncated", "sound"
SPACES = r"\x20\x09-\x0D"
FACTS = "rows long, blank long, duplicate long, truncated long, illegal long, low long, high long, turns long"
BLOCKS = f"conv_id {{}}, part int, block long, first string, last string, first_turn long, last_turn long, {FACTS}, costs array<int>, audits array<string>"


# ---- the damage that the query repairs --------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of `conversations` after the contract's damage: dropped, emptied, cut off, said twice, given to the user.

    `copies` says how often a row stands there; a dropped one stays with 0, so that its conversation is still known.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), case.alias("case"))
    text = F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", ""))
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(F.col("case") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.when(F.col("case") == 0, 0).when(F.col("case") == 3, 2).otherwise(1).alias("copies"),
    )


def as_they_are(conversations: DataFrame) -> DataFrame:
    """Rows of `conversations` as this module takes them: each once, nulls as one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    turn = F.col("turn").cast("long").alias("turn")
    return conversations.select("conv_id", turn, blank("role").alias("role"), blank("text").alias("text"), F.lit(1).alias("copies"))


# ---- alignment of one block ---------------------------------------------------------------------------------


def _target(state: str, system: bool, j: int) -> str:
    """The j-th role (from 0) that follows `state` in the endless string; `system` takes s first from the start."""
    if system:
        return "s" if j == 0 else "au"[j % 2]
    return "au"[j % 2] if state == "u" else "ua"[j % 2]


def _end_state(state: str, system: bool, length: int) -> str:
    return state if length == 0 else _target(state, system, length - 1)


def _step(code: str, role: str) -> list[tuple[int, str]]:
    """Edits of one turn that write `role`: cost and letter. Codes are upper case if cut off; X can only be deleted."""
    if code == "X":
        return []
    extra = CUT_OFF * code.isupper()
    out = [(KEEP + extra, "K")] if code.lower() == role else []
    return out + ([(REROLE + extra, "R")] if role in "ua" else [])


def _known(codes: str, state: str, system: bool) -> int:
    """Cost of a plain alignment, turn by turn: change what can be changed, else delete; the incumbent of the band."""
    cost, j = 0, 0
    for code in codes:
        ways = _step(code, _target(state, system, j))
        cost += min(ways)[0] if ways else DELETE
        j += bool(ways)
    return min(cost, DELETE * len(codes))


def _table(codes: str, state: str, system: bool) -> dict[str, tuple[int, str]]:
    """Least (cost, audit) to each end state against one endless string, by Wagner-Fischer inside an Ukkonen band.

    `cost[i][j]`: the turns from i on, with j roles written before; the end may have any number of them. An alignment
    that is d places off the diagonal holds at least d deletions or insertions. To go on from one end state as if it were
    another costs 5 at most (an insertion and the deletion of a system turn), so an end state that costs
    more than the incumbent and 5 takes no part in a least whole, and the band holds all others.
    """
    n = len(codes)
    incumbent = _known(codes, state, system) + INSERT + DELETE
    left, right = incumbent // DELETE, incumbent // INSERT
    best: dict[str, tuple[int, str]] = {}
    roles = [_target(state, system, j) for j in range(n + right + 2)]
    none = 1 << 40
    # Costs of what follows differ by end state, so the table is filled backwards once for each.
    for end in STATES:
        lengths = [j for j in range(max(0, n - left), n + right + 1) if _end_state(state, system, j) == end]
        if not lengths:
            continue
        table: list[dict[int, int]] = [{} for _ in range(n + 1)]
        table[n] = dict.fromkeys(lengths, 0)
        for i in range(n - 1, -1, -1):
            below, row = table[i + 1], table[i]
            for j in range(i + right + 1, max(0, i - left) - 1, -1):
                least = below.get(j, none) + DELETE
                if j < len(roles):
                    for cost, _ in _step(codes[i], roles[j]):
                        least = min(least, cost + below.get(j + 1, none))
                    if roles[j] in "ua":
                        least = min(least, INSERT + row.get(j + 1, none))
                if least < none:
                    row[j] = least
        total = table[0].get(0, none)
        if total >= none:
            continue
        # Forwards: of the edits that keep the least cost, the first letter in ASCII order.
        i, j, audit = 0, 0, []
        while i < n:
            rest, ways = table[i][j], []
            if rest == DELETE + table[i + 1].get(j, none):
                ways.append(("D", i + 1, j))
            if roles[j] in "ua" and rest == INSERT + table[i].get(j + 1, none):
                ways.append(("I", i, j + 1))
            for cost, letter in _step(codes[i], roles[j]):
                if rest == cost + table[i + 1].get(j + 1, none):
                    ways.append((letter, i + 1, j + 1))
            letter, i, j = min(ways)
            audit.append(letter)
        best[end] = (total, "".join(audit))
    return best


@lru_cache(maxsize=1 << 15)
def aligned(codes: str) -> tuple[tuple[int, ...], tuple[str, ...]]:
    """Least cost and audit of a block from each state to each (row by row), -1 and '' where there is no way.

    A code is s, u, a or o (another role), upper case if the turn is cut off, X if it must go.
    """
    costs, audits = [], []
    for state in STATES:
        found: dict[str, tuple[int, str]] = {}
        for system in (False, True) if state == "0" else (False,):
            for end, way in _table(codes, state, system).items():
                found[end] = min(found.get(end, way), way)
        for end in STATES:
            cost, audit = found.get(end, (-1, ""))
            costs.append(cost)
            audits.append(audit)
    return tuple(costs), tuple(audits)


class Joined:
    """The blocks of one conversation so far: least cost and audit to each state, audits as chains of pieces.

    No audit of equal turns begins another, so two audits compare as their states' ranks do, and equal ranks by the new piece.
    """

    def __init__(self) -> None:
        self.best: dict[int, tuple[int, int, tuple | None]] = {0: (0, 0, None)}

    def add(self, costs: list[int], audits: list[str]) -> None:
        ways: dict[int, tuple] = {}
        for state, (cost, rank, chain) in self.best.items():
            for end in range(4):
                more = costs[4 * state + end]
                if more >= 0:
                    way = (cost + more, rank, audits[4 * state + end], chain)
                    if end not in ways or way[:3] < ways[end][:3]:
                        ways[end] = way
        ranks = {key: i for i, key in enumerate(sorted({way[1:3] for way in ways.values()}))}
        self.best = {end: (way[0], ranks[way[1:3]], (way[3], way[2])) for end, way in ways.items()}

    def finished(self) -> tuple[int, str]:
        """Cost and audit, with the insertions that end the last pair."""
        tails = {0: (0, ""), 1: (2 * INSERT, "II"), 2: (INSERT, "I"), 3: (0, "")}
        ways = [(cost + tails[s][0], rank, tails[s][1], s) for s, (cost, rank, _) in self.best.items()]
        cost, _, tail, state = min(ways)
        pieces, chain = [tail], self.best[state][2]
        while chain is not None:
            pieces.append(chain[1])
            chain = chain[0]
        return cost, "".join(reversed(pieces))


# ---- turns to blocks ----------------------------------------------------------------------------------------


def _code(role: str, fault: str) -> str:
    if fault in (BLANK, DUPLICATE):
        return "X"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial.upper() if fault == TRUNCATED else initial


def _order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _digested(rows: DataFrame) -> DataFrame:
    return rows.filter("copies > 0").withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))


def faults(rows: DataFrame) -> DataFrame:
    """One row for equal turns of a conversation: `conv_id`, `turn`, `role`, `digest`, `copies`, `fault`, `first`.

    `fault` is that of the first of them if `first` (no equal role and text came earlier), else all are duplicates;
    the further ones are duplicates in any case, or blank.
    """
    trimmed = F.regexp_extract("text", f"([^{SPACES}])[{SPACES}]*\\z", 1)
    fault = F.when(trimmed == "", BLANK).when(trimmed.isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    narrow = _digested(rows).select("conv_id", "turn", "role", "digest", "copies", fault.alias("fault"))
    keys = ["conv_id", "turn", "role", "digest"]
    counted = land(narrow.groupBy(*keys).agg(F.sum("copies").alias("copies"), F.first("fault").alias("fault")), "turns")
    # A null turn comes before all others: count it in, since the least of turns would leave it out.
    earliest = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn"))
    said = counted.groupBy("conv_id", "role", "digest").agg(earliest["turn"].alias("_first"), F.count("*").alias("_turns"))
    said = land(said.filter("_turns > 1").drop("_turns"), "said").select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "_first"
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    met = counted.join(shuffled(said), same, "left")
    first = F.col("_digest").isNull() | F.col("turn").eqNullSafe(F.col("_first"))
    return met.select(*keys, "copies", "fault", first.alias("first"))


def blocks(flawed: DataFrame) -> DataFrame:
    """Turns in order, cut into blocks of at most `BLOCK`: facts of each and its least alignments.

    The order is dealt out by ranges, so a long conversation lies in several tasks; `part` and `block` keep its order.
    """

    conv = flawed.schema["conv_id"].dataType

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, number, out, state = _block_schema(to_arrow_type(conv)), 0, [], None

        def closed(block: dict) -> dict:
            costs, audits = aligned("".join(block.pop("codes")))
            block["costs"], block["audits"] = list(costs), list(audits)
            return block

        for batch in batches:
            for row in batch.to_pylist():
                left, first = row["copies"], row["first"]
                initial = row["role"][:1]
                while left:
                    same = state is not None and state["conv_id"] == row["conv_id"]
                    if not same or state["rows"] == BLOCK:
                        if state is not None:
                            out.append(closed(state))
                        if len(out) == 1000:
                            yield pa.RecordBatch.from_pylist(out, schema)
                            out = []
                        number += 1
                        state = {
                            "conv_id": row["conv_id"], "part": row["part"], "block": number, "first": initial, "last": None,
                            "first_turn": row["turn"], "last_turn": None, "rows": 0, BLANK: 0, DUPLICATE: 0, TRUNCATED: 0,
                            "illegal": 0, "low": None, "high": None, "turns": 0, "codes": [],
                        }
                    fault = row["fault"] if first or row["fault"] == BLANK else DUPLICATE
                    # The first of equal turns may be sound; the others share a fault and are taken together.
                    some = 1 if first else min(left, BLOCK - state["rows"])
                    if fault != SOUND:
                        state[fault] += some
                    if state["last"] is not None:
                        state["illegal"] += state["last"] + initial not in ("su", "ua", "au")
                    state["illegal"] += (some - 1) * (initial + initial not in ("su", "ua", "au"))
                    turn = row["turn"]
                    if turn is not None:
                        if state["last"] is None or state["last_turn"] != turn:
                            state["turns"] += 1
                        state["low"] = turn if state["low"] is None else state["low"]
                        state["high"] = turn
                    state["rows"] += some
                    state["codes"].append(_code(row["role"], fault) * some)
                    state["last"], state["last_turn"] = initial, turn
                    left, first = left - some, False
        if state is not None:
            out.append(closed(state))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    ordered = flawed.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    ordered = ordered.withColumn("part", F.spark_partition_id())
    return ordered.mapInArrow(rows, BLOCKS.format(conv.simpleString()))


def _block_schema(conv_type: pa.DataType) -> pa.Schema:
    text, number = pa.string(), pa.int64()
    facts = [(n, number) for n in ("rows", BLANK, DUPLICATE, TRUNCATED, "illegal", "low", "high", "turns")]
    head = [("conv_id", conv_type), ("part", pa.int32()), ("block", number), ("first", text), ("last", text)]
    turns = [("first_turn", number), ("last_turn", number)]
    return pa.schema([*head, *turns, *facts, ("costs", pa.list_(pa.int32())), ("audits", pa.list_(text))])


def audits(parts: DataFrame) -> DataFrame:
    """`conv_id`, `gaps`, `blank`, `duplicate`, `truncated`, `illegal`, `cost`, `audit` of conversations that have blocks."""

    conv = parts.schema["conv_id"].dataType

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, total, joined, last = [], None, None, None
        number = [(n, pa.int64()) for n in ("gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost")]
        schema = pa.schema([("conv_id", to_arrow_type(conv)), *number, ("audit", pa.string())])

        def closed() -> dict:
            low, high, turns = (total.pop(k) for k in ("low", "high", "turns"))
            cost, audit = joined.finished()
            return {**total, "gaps": 0 if low is None else high - low + 1 - turns, "cost": cost, "audit": audit}

        for batch in batches:
            for row in batch.to_pylist():
                if total is None or total["conv_id"] != row["conv_id"]:
                    if total is not None:
                        out.append(closed())
                    names = ("conv_id", BLANK, DUPLICATE, TRUNCATED, "illegal", "low", "high", "turns")
                    total, joined = {n: row[n] for n in names}, Joined()
                else:
                    for name in (BLANK, DUPLICATE, TRUNCATED, "illegal", "turns"):
                        total[name] += row[name]
                    total["illegal"] += last[0] + row["first"] not in ("su", "ua", "au")
                    total["turns"] -= last[1] is not None and last[1] == row["first_turn"]
                    total["low"] = row["low"] if total["low"] is None else total["low"]
                    total["high"] = total["high"] if row["high"] is None else row["high"]
                last = (row["last"], row["last_turn"])
                joined.add(row["costs"], row["audits"])
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if total is not None:
            yield pa.RecordBatch.from_pylist([closed()], schema)

    schema = f"conv_id {conv.simpleString()}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    place = [F.col("conv_id").asc_nulls_first(), "part", "block"]
    return parts.repartition("conv_id").sortWithinPartitions(*place).mapInArrow(rows, schema)


# ---- along the audit ----------------------------------------------------------------------------------------


def _along(rows: DataFrame, told: DataFrame) -> DataFrame:
    """Turns in order after the audit of their conversation: `kind` 0 carries the audit, 1 a turn."""
    turns = _digested(rows).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text", "copies", F.lit(None).cast("string").alias("audit"))
    heads = told.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit(None).cast("binary").alias("digest"), F.lit("").alias("text"), F.lit(0).alias("copies"), "audit",
    )
    order = [F.col("conv_id").asc_nulls_first(), "kind", F.col("turn").asc_nulls_first(), "role", "digest"]
    return heads.unionByName(turns).repartition("conv_id").sortWithinPartitions(*order)


class Repair:
    """Follows an audit over the turns of a conversation and yields what the repaired one says."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at = audit, 0
        length = len(audit) - audit.count("D")
        self.system, self.written = length % 2 == 1, 0

    def _role(self) -> str:
        """The next role of the grammar; a system turn is always one that was kept."""
        place = self.written - self.system
        self.written += 1
        return "" if place < 0 else ("user", "assistant")[place % 2]

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._role(), ""

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            written = self._role()
            yield (role if edit == "K" else written), text


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """What repaired conversations say, from the rows of `_along`: `conv_id`, role, text; after each one a role of None."""
    conv_id, repair = None, None
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)) for n in ("conv_id", "kind", "role", "text", "copies", "audit")]
        for i in range(len(batch)):
            conv, kind, role, text, copies, audit = (c[i].as_py() for c in columns)
            if kind == 0:
                if repair is not None:
                    yield from ((conv_id, *said) for said in repair.inserted())
                    yield conv_id, None, None
                conv_id, repair = conv, Repair(audit)
            for _ in range(copies):
                yield from ((conv_id, *said) for said in repair.turn(role, text))
    if repair is not None:
        yield from ((conv_id, *said) for said in repair.inserted())
        yield conv_id, None, None


def repaired_turns(rows: DataFrame, told: DataFrame) -> DataFrame:
    """`conv_id`, `place` (from 0), `role`, `text` of the repaired conversations; `told` comes from `audits`."""
    conv = rows.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place = [], 0
        schema = pa.schema([("conv_id", to_arrow_type(conv)), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
        for conv_id, role, text in _followed(batches):
            if role is None:
                place = 0
                continue
            held.append({"conv_id": conv_id, "place": place, "role": role, "text": text})
            place += 1
            if len(held) == 1000:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        yield pa.RecordBatch.from_pylist(held, schema)

    return _along(rows, told).mapInArrow(run, f"conv_id {conv.simpleString()}, place long, role string, text string")


def repaired_hashes(rows: DataFrame, told: DataFrame) -> DataFrame:
    """`conv_id`, `repaired_sha256`: the digest of `role:text` lines of the repaired conversation, taken turn by turn."""
    conv = rows.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest, mark = [], hashlib.sha256(), ""
        schema = pa.schema([("conv_id", to_arrow_type(conv)), ("repaired_sha256", pa.string())])
        for conv_id, role, text in _followed(batches):
            if role is not None:
                digest.update(f"{mark}{role}:{text}".encode())
                mark = "\n"
                continue
            held.append({"conv_id": conv_id, "repaired_sha256": digest.hexdigest()})
            digest, mark = hashlib.sha256(), ""
            if len(held) == 1000:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        yield pa.RecordBatch.from_pylist(held, schema)

    return _along(rows, told).mapInArrow(run, f"conv_id {conv.simpleString()}, repaired_sha256 string")


def repair_digests(rows: DataFrame) -> DataFrame:
    """One row for each conversation of `rows`, those without any row left as well: faults, cost, audit and digest."""
    ids = rows.select(F.col("conv_id").alias("_id")).distinct()
    told = land(audits(land(blocks(faults(rows)), "blocks")), "audits")
    hashes = repaired_hashes(rows, told).select(F.col("conv_id").alias("_hashed"), "repaired_sha256")
    out = ids.join(shuffled(told), F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    out = out.join(shuffled(hashes), F.col("_id").eqNullSafe(F.col("_hashed")), "left")
    numbers = ("gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost")
    return out.select(
        F.col("_id").alias("conv_id"),
        *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


ship_by_value(__name__)
