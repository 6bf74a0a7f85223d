"""Conversation repair against a search over whole conversations."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from sparecost.llm import conversation_repair as repair
from sparecost.llm.common import Scratch

EMPTY = hashlib.sha256().hexdigest()


def damaged(rows):
    """Rows of one conversation after damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        out += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def best(rows):
    """Report of one conversation: cheapest edits by recursion over prefixes, then the least audit."""
    seen, kinds, counts = set(), [], dict(blank=0, duplicate=0, truncated=0)
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\v\f\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        kinds.append(fault)
        if fault:
            counts[fault] += 1

    def onward(made, c):
        return {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[made].get(c)

    @lru_cache(None)
    def solve(i, made, inserted):
        """(cost, audit, lines)"""
        options = []
        if i == len(rows) and made in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            for c in "ua":
                if onward(made, c):
                    cost, audit, lines = solve(i, c, inserted + 1)
                    options.append((cost + 3, "I" + audit, ({"u": "user:", "a": "assistant:"}[c],) + lines))
        if i < len(rows):
            _, role, text = rows[i]
            extra = 3 if kinds[i] == "truncated" else 0
            cost, audit, lines = solve(i + 1, made, 0)
            options.append((cost + 4, "D" + audit, lines))
            if kinds[i] not in ("blank", "duplicate"):
                if role[:1] and onward(made, role[:1]):
                    cost, audit, lines = solve(i + 1, role[:1], 0)
                    options.append((cost + extra, "K" + audit, (f"{role}:{text}",) + lines))
                for name in ("user", "assistant"):
                    if onward(made, name[0]):
                        cost, audit, lines = solve(i + 1, name[0], 0)
                        options.append((cost + 3 + extra, "R" + audit, (f"{name}:{text}",) + lines))
        return min(options) if options else (10 ** 9, "", ())

    cost, audit, lines = solve(0, "", 0)
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts.values(), sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    return {conv: best(damaged(own)) for conv, own in by.items()}


def sample(seed, conversations, longest):
    random.seed(seed)
    roles, texts = ["user", "assistant", "assistant", "user", "system", "tool", "", None], ["Fine.", "Why?", "no end", " \n", "", None, "Go! ", "Fine."]
    rows = []
    for c in range(conversations):
        for t in range(random.randint(1, longest)):
            role = roles[t % 2] if random.random() < 0.6 else random.choice(roles)
            text = f"text {c} {t}." if random.random() < 0.6 else random.choice(texts)
            rows.append((c if c else None, None if random.random() < 0.05 else t + random.choice([0, 0, 1, 3]), role, text))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def found(df):
    rows = df.collect()
    assert len(rows) == len({r["conv_id"] for r in rows})
    return {r["conv_id"]: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("bits", [10, 2])
def test_repairs(spark, monkeypatch, bits):
    """With blocks of four rows nearly all conversations span several blocks."""
    monkeypatch.setattr(repair, "_LEAST_BITS", bits)
    rows = sample(5, 150, 30)
    table = spark.createDataFrame(rows, SCHEMA).withColumns({"letters": F.lit("x"), "__at": F.lit(1), "cost": F.lit(2)}).repartition(4)
    assert found(repair.repair_damaged(table)) == expected(rows)


def test_one_long_conversation(spark):
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"part {t}" + ("." if t % 9 else "")) for t in range(4000)]
    rows += [(8, 0, "user", "Only.")]
    plan_rows = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = found(repair.repair_damaged(plan_rows))
    assert got[7][0] >= 0 and len(got[7][6]) >= 3900 and got[7][1] > 0
    assert got[8] == best(damaged(rows[-1:]))


def test_repeated_rows_and_clean_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."), (2, None, None, None), (None, None, "user", "A.")]
    assert found(repair.repair_damaged(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_empty_table_and_dropped_conversations(spark):
    assert repair.repair_damaged(spark.createDataFrame([], SCHEMA)).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert found(repair.repair_damaged(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA))) == {gone: (0, 0, 0, 0, 0, 0, "", EMPTY)}


def test_repaired_rows_are_the_hashed_ones(spark):
    rows = sample(6, 40, 12)
    table = spark.createDataFrame(rows, SCHEMA)
    plan = repair.plan_repairs(repair.damage(table), Scratch(spark, "rows"))
    by = {}
    for r in sorted(repair.repaired_rows(plan).collect(), key=lambda r: r["place"]):
        by.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for conv, report in expected(rows).items():
        assert hashlib.sha256("\n".join(by.get(conv, [])).encode()).hexdigest() == report[-1]
        initials = "".join(line[0] for line in by.get(conv, []))
        assert re.fullmatch("(s?(ua)+)?", initials)


def test_block_matrices_chain():
    """The matrix of two blocks is the min-plus product of theirs."""
    random.seed(1)
    kinds = [random.choice([0, 1, 2, 3, 5, 9, 10]) for _ in range(40)]
    a, b, whole = repair.matrix(kinds[:17]), repair.matrix(kinds[17:]), repair.matrix(kinds)
    assert whole == [min(repair._INF, *(a[4 * p + q] + b[4 * q + r] for q in range(4))) for p in range(4) for r in range(4)]
