"""Conversation repair against enumeration of all edits, and with every odd case."""

import random
from functools import lru_cache
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from spendlake.llm import repair

LETTERS = "suax"


def enumerated(symbols):
    """The least (cost, audit) over all edits, state by state without any bound."""

    @lru_cache(None)
    def rest(i, state):
        found = []
        if i == len(symbols):
            if state in ("", "a"):
                found.append((0, ""))
        else:
            role, fault = LETTERS[symbols[i] // 3], symbols[i] % 3
            after = "a" if state == "u" else "u"
            c, a = rest(i + 1, state)
            found.append((c + 3, "D" + a))
            if fault != repair.GONE:
                if state + role in ("s", "u", "su", "ua", "au"):
                    c, a = rest(i + 1, role)
                    found.append((c + (fault == repair.CUT), "K" + a))
                c, a = rest(i + 1, after)
                found.append((c + 2 + (fault == repair.CUT), "R" + a))
        for n, end in ((1, "a" if state == "u" else "u"), (2, "u" if state == "u" else "a")):
            if n == 1 or state != "u":  # two insertions lead back there
                c, a = closed(i, end)
                found.append((c + 2 * n, "I" * n + a))
        return min(found)

    @lru_cache(None)
    def closed(i, state):
        """As ``rest``, without an insertion before row i."""
        found = []
        if i == len(symbols):
            return (0, "") if state == "a" else (1 << 30, "")
        role, fault = LETTERS[symbols[i] // 3], symbols[i] % 3
        after = "a" if state == "u" else "u"
        c, a = rest(i + 1, state)
        found.append((c + 3, "D" + a))
        if fault != repair.GONE:
            if state + role in ("su", "ua", "au"):
                c, a = rest(i + 1, role)
                found.append((c + (fault == repair.CUT), "K" + a))
            c, a = rest(i + 1, after)
            found.append((c + 2 + (fault == repair.CUT), "R" + a))
        return min(found)

    return rest(0, "")


@pytest.mark.parametrize("segment", [1, 3, 64])
def test_search_against_enumeration(monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    r = random.Random(segment)
    for n in [*range(9)] * 60 + [40] * 10:
        symbols = bytes(r.choice((3, 3, 4, 5, 6, 6, 7, 8, 0, 0, 1, 2, 9, 10, 11)) for _ in range(n))
        assert repair.cheapest_repair(symbols) == enumerated(symbols), list(symbols)


def test_dominance_keeps_long_rows_cheap():
    worst = bytes([3, 5, 6, 3, 3, 8, 0, 9, 6] * 3000)  # each alike, hardly any fits
    cost, audit = repair.cheapest_repair(worst)
    assert len(audit.replace("I", "")) == len(worst) and 0 < cost <= 3 * len(worst)
    table = repair.search(bytes([3] * 64), repair.START)
    assert table[repair.USER][0] == 64 and table[repair.ASSISTANT] == (64, "KR" * 32)


def expected(rows):
    """The contract, row by row, for conversations given as (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        damaged = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = (" " if x is None else x for x in (role, text))
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = crc32(key.encode()) % 20
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            damaged += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
        digest = lambda r: sha256(f"{r[1]}\0{r[2]}".encode()).digest()[:16]
        damaged.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
        seen, symbols, faults = set(), [], [0, 0, 0, 0]
        for _, role, text in damaged:
            end = text.strip(" \t\n\x0b\x0c\r")
            fault = 1 if not end else 2 if (role, text) in seen else 3 if end[-1] not in ".!?" else 0
            seen.add((role, text))
            faults[fault] += 1
            initial = "sua".find(role[0]) if role else -1
            symbols.append(3 * (initial if initial >= 0 else 3) + (0, 1, 1, 2)[fault])
        cost, audit = enumerated(tuple(symbols))
        lines, state, rest = [], "", iter(damaged)
        for edit in audit:
            other = "a" if state == "u" else "u"
            if edit == "I":
                state = other
                lines.append({"u": "user:", "a": "assistant:"}[state])
                continue
            _, role, text = next(rest)
            if edit == "K":
                state = role[0]
                lines.append(f"{role}:{text}")
            elif edit == "R":
                state = other
                lines.append({"u": "user:", "a": "assistant:"}[state] + text)
        turns = {t for t, _, _ in damaged if t is not None}
        roles = [r[1][:1] for r in damaged]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *faults[1:],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False)),
            cost,
            audit,
            sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def odd_rows():
    r = random.Random(11)
    texts = [None, "", " \t\n", "Yes.", "No", "What?  ", "é!", "x\x1c", "a" * 3000 + ".", "cut, ", "Hi.\u2028", "Hi. \x85", "Hi.\n\n", "Hi" + " " * 2000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", None, "", "User", "tool", "süd"]
    rows = [
        (c, r.choice([None, *range(12)]), r.choice(roles), r.choice(texts))
        for c in [*range(40), None]
        for _ in range(r.randint(1, 9))
    ]
    rows += [(100, t, ("user", "assistant")[t % 2], f"line {t}.") for t in range(400)]  # a long one
    rows += [(101, None, "user", "the same.")] * 50 + [(102, 3, "assistant", "again")] * 30
    # Found by checksum: every row of this one is dropped.
    rows += [(c, 0, "user", "gone.") for c in range(1000, 1100) if crc32(f"{c}:0".encode()) % 20 == 0]
    return rows


@pytest.mark.parametrize("partitions", ["1", "8", "61"])
def test_summary(spark, partitions):
    rows = odd_rows()
    table = spark.createDataFrame(
        [(*r, "x", 1, 2) for r in rows],
        "conv_id long, turn long, role string, text string, conv string, copies int, digest int",
    )
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", partitions == "8")
    try:
        damaged = repair.damaged_rows(table.repartition(5))
        found = {r.conv_id: tuple(r)[1:] for r in repair.repair_summary(damaged).collect()}
        assert found == expected(rows)
        if partitions == "61":
            lines = repair.repaired_conversations(damaged).groupBy("conv_id").agg(
                F.expr("sha2(concat_ws('\n', transform(array_sort(collect_list(struct(place, role, text))), "
                       "x -> concat(x.role, ':', x.text))), 256)").alias("h")
            )
            assert {r.conv_id: r.h for r in lines.collect()} == {
                c: v[-1] for c, v in found.items() if set(v[-2]) - {"D"}
            }
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    assert repair.repair_summary(repair.damaged_rows(table.where("false"))).count() == 0


def test_ids_of_text(spark):
    rows = [("", 0, "user", "Hi."), (" ", 0, "user", "Hi."), (None, 0, "user", "Hi.")]
    table = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    assert {r.conv_id for r in repair.repair_summary(repair.damaged_rows(table)).collect()} == {"", " ", None}
