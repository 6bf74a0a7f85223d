"""Repair of damaged conversations by the cheapest edits, ties to the ASCII-least list of edits.

A conversation is to become `(s?(ua)+)?` over the initials of its roles. Four states say what the last role was: none,
system, user, assistant. The backward table (least cost from each row and state to the end) is never stored: rows are dealt
in blocks of about the square root of the longest conversation, only the vector behind each block is kept as a
checkpoint, and a block's own vectors are computed again while its edits are written forward. A block is a min-plus matrix of
four by four, so the checkpoints of a long conversation come from one small row per block, and its blocks are worked on by
many tasks. Conversations within one block need no checkpoint.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparecost.llm.common import Scratch, task

SYSTEM, USER, ASSISTANT, OTHER = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# state after a system, user or assistant row, from each state
_AFTER = ((1, 2, None), (None, 2, None), (None, None, 3), (None, 2, None))
# the role that an insert or a rerole can give in each state
_NEXT = (USER, USER, ASSISTANT, USER)
_MAY_END = (True, False, False, True)
_REROLE, _DELETE, _INSERT, _TRUNCATED = 3, 4, 3, 3
_MUST_GO, _CUT = 4, 8
_STATES = range(4)
_INF = 1 << 60
_BLANKS = " \t\n\u000b\u000c\r"
_LEAST_BITS = 10

Vector = tuple[int, ...]


# ---- costs of one row and of one block --------------------------------------------------------------------

def _with_inserts(v: list[int]) -> Vector:
    """Costs once inserts may come before what follows; chains of them are at most three long."""
    for _ in range(3):
        v = [min(v[q], _INSERT + v[_AFTER[q][_NEXT[q]]]) for q in _STATES]
    return tuple(min(_INF, x) for x in v)


def _choices(after: Vector, kind: int, q: int) -> dict[str, int]:
    """Cost to the end by the edit of a row in state q. kind: its initial, and the flags that it must go or is cut off."""
    initial, extra = kind & 3, _TRUNCATED if kind & _CUT else 0
    found = {"D": _DELETE + after[q]}
    if not kind & _MUST_GO:
        if initial != OTHER and _AFTER[q][initial] is not None:
            found["K"] = extra + after[_AFTER[q][initial]]
        found["R"] = _REROLE + extra + after[_AFTER[q][_NEXT[q]]]
    return found


@lru_cache(maxsize=1 << 16)
def _before(after: Vector, kind: int) -> Vector:
    return _with_inserts([min(_choices(after, kind, q).values()) for q in _STATES])


@lru_cache(maxsize=1 << 16)
def _tight(after: Vector, kind: int, q: int) -> tuple[str, tuple, int, int]:
    """ASCII-least tight edits of a row and before it: letters, the role that each gives, the state behind, and their cost.

    D, I, K, R ascend in ASCII and a letter leads to one state, so each place takes the first letter that keeps the cost.
    """
    before, letters, roles, start = _before(after, kind), "", [], q
    choices = _choices(after, kind, q)
    while True:
        tight = [c for c, cost in choices.items() if cost == before[q]]
        onward = _AFTER[q][_NEXT[q]]
        if _INSERT + before[onward] == before[q]:
            tight.append("I")
        letter = min(tight)
        letters += letter
        roles.append(None if letter == "D" else kind & 3 if letter == "K" else _NEXT[q])
        if letter != "D":
            q = _AFTER[q][roles[-1]]
        if letter != "I":
            return letters, tuple(roles), q, before[start] - after[q]
        choices = _choices(after, kind, q)


END = _with_inserts([0 if may else _INF for may in _MAY_END])


def closing(q: int) -> list[int]:
    """Roles inserted behind the last row."""
    roles = []
    while not _MAY_END[q]:
        roles.append(_NEXT[q])
        q = _AFTER[q][roles[-1]]
    return roles


def _less(v: Vector) -> tuple[Vector, int]:
    """The vector less its least value, so that few shapes occur, and that value."""
    least = min(v)
    return tuple(x - least if x < _INF else _INF for x in v), least


def vectors(kinds: list[int], behind: Vector) -> tuple[list[Vector], int]:
    """Vectors before each row of a block and behind it, each less a constant, and the constant of the first."""
    v, total = _less(behind)
    table = [v]
    for kind in reversed(kinds):
        v, least = _less(_before(v, kind))
        total += least
        table.append(v)
    table.reverse()
    return table, total


def matrix(kinds: list[int]) -> list[int]:
    """Least cost of a block from each state before it to each state behind it, row by row."""
    columns = []
    for out in _STATES:
        table, total = vectors(kinds, tuple(0 if q == out else _INF for q in _STATES))
        columns.append([min(_INF, x + total) for x in table[0]])
    return [columns[out][q] for q in _STATES for out in _STATES]


def edits(kinds: list[int], behind: Vector, q: int) -> tuple[list[tuple], int]:
    """Per row of a block (letters, roles, cost), from state q; and the state behind."""
    table, _ = vectors(kinds, behind)
    found = []
    for i, kind in enumerate(kinds):
        letters, roles, q, cost = _tight(table[i + 1], kind, q)
        found.append((letters, roles, cost))
    return found, q


# ---- blocks in tasks --------------------------------------------------------------------------------------

def _groups(batches, keys: tuple[str, ...], values: tuple[str, ...]):
    """(key, rows) of rows that come sorted by their key; one group is held at a time."""
    at, held = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in values]
        for key, *row in zip(zip(*[batch.column(c).to_pylist() for c in keys]), *columns):
            if key != at:
                if held:
                    yield at, held
                at, held = key, []
            held.append(row)
    if held:
        yield at, held


_PIECE = ("__conv", "__block")


def _batches(rows, types: dict[str, pa.DataType], size: int = 5000):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types.values())], names=list(types))
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types.values())], names=list(types))


_CONV = {"__conv": pa.string(), "__block": pa.int64()}
_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())


def _matrices(batches):
    yield from _batches(((*key, matrix([k for k, in rows])) for key, rows in _groups(batches, _PIECE, ("kind",))), _CONV | {"m": _LONGS})


def _checkpoints(batches):
    """The vector behind each block of a conversation, from the matrices of the blocks after it."""
    def found():
        for (conv,), rows in _groups(batches, ("__conv",), ("__block", "m")):
            v = END
            for i, (block, m) in enumerate(reversed(rows)):
                yield conv, block, v, i == 0
                v, _ = _less(tuple(min(min(m[4 * q + out] + v[out] for out in _STATES), _INF) for q in _STATES))

    yield from _batches(found(), _CONV | {"behind": _LONGS, "last": pa.bool_()})


def _exits(batches):
    """The state behind a block for each state before it."""
    def found():
        for key, rows in _groups(batches, _PIECE, ("kind", "behind")):
            kinds, behind = [r[0] for r in rows], tuple(rows[0][1])
            yield *key, [edits(kinds, behind, q)[1] for q in _STATES]

    yield from _batches(found(), _CONV | {"out": _INTS})


def _entries(batches):
    """The state before each block of a conversation."""
    def found():
        for (conv,), rows in _groups(batches, ("__conv",), ("__block", "out")):
            q = 0
            for block, out in rows:
                yield conv, block, q
                q = out[q]

    yield from _batches(found(), _CONV | {"state": pa.int32()})


def _edits(batches):
    """Letters, roles and cost per row; with the last row of a conversation the roles inserted behind it."""
    def found():
        for _, rows in _groups(batches, _PIECE, ("__at", "kind", "behind", "last", "state")):
            _, _, behind, last, state = rows[0]
            whole = behind is None
            done, q = edits([r[1] for r in rows], END if whole else tuple(behind), state or 0)
            for i, (row, (letters, roles, cost)) in enumerate(zip(rows, done)):
                end = closing(q) if (whole or last) and i == len(rows) - 1 else []
                yield row[0], letters + "I" * len(end), [*roles, *end], cost + _INSERT * len(end)

    yield from _batches(found(), {"__at": pa.int64(), "letters": pa.string(), "roles": _INTS, "cost": pa.int64()})


# ---- the operator -------------------------------------------------------------------------------------------

def _key(conv: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("null")).alias("__conv")


def _spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Damage rows by crc32(`conv:turn`) mod 20: 0 drops, 1 empties, 2 takes `.!?` out, 3 repeats, 4 makes the role user.

    Nulls are one space in what is hashed, and in role and text. Returns conv_id, turn, role, text.
    """
    fault = F.crc32(F.concat(_spaced(conv), F.lit(":"), _spaced(turn))) % 20
    value, who = _spaced(text), _spaced(role)
    return conversations.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.when(fault == 4, F.lit("user")).otherwise(who).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(value, ".!?", "")).otherwise(value).alias("text"),
        F.explode(F.when(fault == 0, F.array().cast("array<int>")).when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _ordered(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows by conversation, turn (null first), role and text, sorted by ranges over all partitions; __at follows the order.

    Rows alike in all of these are told apart by a number, so that many of them do not meet in one partition.
    """
    order = [F.col("__conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("__salt")]
    keyed = rows.select(_key("conv_id"), "conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("__salt"))
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("__salt")
    return scratch.keep(ranged.withColumn("__at", F.monotonically_increasing_id()), "rows")


def _faults(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """__at, __conv, initial, fault: the first of blank, duplicate, truncated that a row has."""
    bare = F.rtrim("text", F.lit(_BLANKS))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    marked = scratch.keep(rows.select(
        "__at", "__conv", F.substring("role", 1, 1).alias("initial"), (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"), digest.alias("digest")), "marked")
    firsts = marked.groupBy("__conv", "digest").agg(F.min("__at").alias("__at")).select("__at", F.lit(True).alias("first"))
    return marked.join(firsts, "__at", "left").select(
        "__at", "__conv", "initial",
        F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated").alias("fault"))


def plan_repairs(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Per row of conversations (conv_id, turn, role, text): its place, fault, and edits with their roles and cost, stored.

    `letters` are the edits before and of the row, and behind it where it is the last one: I(nsert), K(eep), R(erole),
    D(elete). `roles` has the role that each letter gives (1 user, 2 assistant, 0 system; null for D).
    """
    rows = _ordered(rows, scratch)
    initial = F.when(F.col("initial") == "s", SYSTEM).when(F.col("initial") == "u", USER).when(F.col("initial") == "a", ASSISTANT).otherwise(OTHER)
    faults = scratch.keep(_faults(rows, scratch).withColumn("kind", (
        initial + F.when(F.col("fault").isin("blank", "duplicate"), _MUST_GO).otherwise(0) + F.when(F.col("fault") == "truncated", _CUT).otherwise(0)
    ).cast("int")), "faults")

    longest = faults.groupBy("__conv").count().agg(F.max("count")).first()[0] or 0
    bits = max(_LEAST_BITS, -(-longest.bit_length() // 2))
    dealt = faults.select("__conv", F.shiftright("__at", bits).alias("__block"), "__at", "kind")
    spanning = dealt.groupBy("__conv").agg(F.min("__block").alias("a"), F.max("__block").alias("b")).filter("a < b").select("__conv")
    long = scratch.keep(dealt.join(spanning, "__conv", "left_semi"), "long")

    def by(df: DataFrame, keys: list[str], *then: str) -> DataFrame:
        return df.repartition(*keys).sortWithinPartitions(*keys, *then)

    checkpoints = entries = None
    if not long.isEmpty():
        blocks = by(long, list(_PIECE), "__at").mapInArrow(task(_matrices), "__conv string, __block long, m array<long>")
        checkpoints = scratch.keep(
            by(blocks, ["__conv"], "__block").mapInArrow(task(_checkpoints), "__conv string, __block long, behind array<long>, last boolean"), "checkpoints")
        ends = by(long.join(checkpoints, list(_PIECE)), list(_PIECE), "__at").mapInArrow(task(_exits), "__conv string, __block long, out array<int>")
        entries = by(ends, ["__conv"], "__block").mapInArrow(task(_entries), "__conv string, __block long, state int")
        dealt = dealt.join(scratch.keep(checkpoints.join(entries, list(_PIECE)), "entries"), list(_PIECE), "left")
    else:
        dealt = dealt.withColumns({"behind": F.lit(None).cast("array<long>"), "last": F.lit(None).cast("boolean"), "state": F.lit(None).cast("int")})
    found = by(dealt, list(_PIECE), "__at").mapInArrow(task(_edits), "__at long, letters string, roles array<int>, cost long")
    done = rows.join(faults.select("__at", "fault"), "__at").join(found, "__at")
    plan = scratch.keep(done, "plan")
    scratch.drop("rows", "marked", "faults", "long", "checkpoints", "entries")
    return plan


def repaired_rows(plan: DataFrame) -> DataFrame:
    """The conversations after their edits: conv_id, place (ascending within a conversation), edit, role, text."""
    step = F.posexplode(F.expr("filter(transform(roles, (r, i) -> struct(substr(letters, i + 1, 1) AS edit, r AS to)), s -> s.edit <> 'D')")).alias("n", "s")
    given = F.when(F.col("s.edit") == "K", F.col("role")).when(F.col("s.to") == USER, ROLES[USER]).otherwise(ROLES[ASSISTANT])
    return plan.select("conv_id", "__at", "role", "text", step).select(
        "conv_id", F.struct("__at", "n").alias("place"), F.col("s.edit").alias("edit"), given.alias("role"),
        F.when(F.col("s.edit") == "I", F.lit("")).otherwise(F.col("text")).alias("text"))


_REPORT = {
    "gaps": pa.int64(), "blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(), "illegal": pa.int64(), "cost": pa.int64(),
    "audit": pa.string(), "repaired_sha256": pa.string()}


def _reports(batches):
    """One row per conversation from its sorted rows, read as a stream: the hash of a conversation cannot be split."""
    def rows():
        for batch in batches:
            yield from zip(*[batch.column(c).to_pylist() for c in ("__conv", "turn", "role", "text", "fault", "letters", "roles", "cost")])

    def found():
        at = None
        for conv, turn, role, text, fault, letters, roles, cost in rows():
            if conv != at:
                if at is not None:
                    yield report()
                at, audit, digest, written, total, illegal = conv, [], hashlib.sha256(), False, 0, 0
                faults, before, low, high, turns = {"blank": 0, "duplicate": 0, "truncated": 0}, None, None, None, 0

                def report():
                    gaps = 0 if low is None else high - low + 1 - turns
                    return at, gaps, *faults.values(), illegal, total, "".join(audit), digest.hexdigest()

            if turn is not None and turn != high:
                low, high, turns = turn if low is None else low, turn, turns + 1
            illegal += before is not None and before + role[:1] not in ("su", "ua", "au")
            before = role[:1]
            if fault:
                faults[fault] += 1
            audit.append(letters)
            total += cost
            for letter, to in zip(letters, roles):
                if letter != "D":
                    line = f"{ROLES[to]}:" if letter == "I" else f"{role if letter == 'K' else ROLES[to]}:{text}"
                    digest.update((("\n" if written else "") + line).encode())
                    written = True
        if at is not None:
            yield report()

    yield from _batches(found(), {"__conv": pa.string()} | _REPORT, 500)


def repair_report(plan: DataFrame) -> DataFrame:
    """__conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 per conversation of a plan."""
    own = plan.select("__conv", "__at", "turn", "role", "text", "fault", "letters", "roles", "cost")
    kinds = ", ".join(f"{c} {'string' if t == pa.string() else 'long'}" for c, t in _REPORT.items())
    return own.repartition("__conv").sortWithinPartitions("__conv", "__at").mapInArrow(task(_reports), f"__conv string, {kinds}")


def repair_damaged(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Damage conversations, repair them, and report per original conversation.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Null values are one space in
    role, text and the damage key; a null conversation id is a conversation of its own, null turns come first and do not
    count as gaps. Rows of one turn go by role, then text, so repeated rows stand together and the later ones are
    duplicates. A role whose initial is not s, u or a (an empty one too) can only be replaced or deleted. Texts may be of
    any length. Conversations without rows after the damage have zeros, an empty audit and the hash of the empty string.
    Other columns are not read, so their names cannot clash. An empty table gives no rows.
    """
    scratch = Scratch(conversations.sparkSession, "conversations")
    found = repair_report(plan_repairs(damage(conversations, conv, turn, role, text), scratch))
    every = conversations.select(F.col(conv).alias("conv_id"), _key(conv)).distinct()
    nothing = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    result = every.join(found, "__conv", "left").select(
        "conv_id", *[F.coalesce(F.col(c), nothing.get(c, F.lit(0).cast("long"))).alias(c) for c in _REPORT])
    return scratch.done(result, "plan")
