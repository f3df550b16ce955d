"""Conversation repair: the cheapest edits that make roles alternate, by branch and bound."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import BLANK, NO_BLANK, query, stored, table
from spendlake.operators.skew import salted_join

SEGMENT = 64  # rows that one search spans; searches are put together by their tables
REMEMBERED = 200_000  # searches whose tables a task keeps
MAX_COST = 1 << 60

# A row in the search: its role's initial (s, u, a, another) times 3 and what is wrong with it.
FINE, GONE, CUT = 0, 1, 2  # nothing; blank or repeated, so to be deleted; without an end
# What the roles so far amount to: nothing, s, ...u, ...a. The first and the last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
KEPT = ((SYSTEM, -1, -1, -1), (USER, USER, -1, USER), (-1, -1, ASSISTANT, -1), (-1, -1, -1, -1))
NEXT = (USER, USER, ASSISTANT, USER)  # the role that an inserted or changed row takes
CLOSING = ("", "II", "I", "")  # what has to be inserted at the end

Table = dict[int, tuple[int, str]]  # state at the end: cost and audit


def _bounds(symbols: bytes) -> tuple[list[int], list[int], list[int], list[int]]:
    """For each suffix: cost that no edit avoids, disjoint conflicts, first row that may be kept.

    Two neighbours that can't follow each other, deleted rows apart, need one of them changed or
    deleted or a row between them: 2 at least. Disjoint such pairs add up.
    """
    n = len(symbols)
    base, pairs, first = [0] * (n + 1), [0] * (n + 2), [-1] * (n + 1)
    after = [n] * (n + 1)  # the row behind the first one that may be kept
    for i in range(n - 1, -1, -1):
        role, fault = divmod(symbols[i], 3)
        if fault == GONE:
            base[i], pairs[i], first[i], after[i] = base[i + 1] + 3, pairs[i + 1], first[i + 1], after[i + 1]
        elif role == 3:
            base[i], pairs[i], first[i] = base[i + 1] + 2 + (fault == CUT), pairs[i + 1], -1
        else:
            base[i], first[i], after[i] = base[i + 1] + (fault == CUT), role, i + 1
            other = first[i + 1]
            clash = other >= 0 and KEPT[other][role + 1] < 0
            pairs[i] = max(pairs[i + 1], pairs[after[i + 1]] + 1 if clash else 0)
    return base, pairs, first, after


def search(symbols: bytes, entry: int) -> Table:
    """The cheapest edits of the rows for each state that they may end in, ties ASCII-least.

    Depth first with an explicit stack. Children are taken in ASCII order, so of two prefixes of
    one node with equal cost the first is the least, and a node's table of dominance holds one
    cost: a prefix that does not lower it is cut off. So is one whose bound exceeds the incumbent,
    from whose state every other is reached by two insertions.
    """
    n = len(symbols)
    base, pairs, first, after = _bounds(symbols)
    state = entry
    limit = 4  # the incumbent: keep what can be kept, change the rest
    for x in symbols:
        role, fault = divmod(x, 3)
        if fault == GONE:
            limit += 3
            continue
        kept = KEPT[role][state]
        limit += (fault == CUT) + (0 if kept >= 0 else 2)
        state = kept if kept >= 0 else NEXT[state]
    least = [MAX_COST] * (4 * n + 4)
    found: dict[int, tuple[int, tuple | None]] = {}
    stack: list[tuple[int, int, int, tuple | None]] = [(0, entry, 0, None)]
    while stack:
        i, state, cost, path = stack.pop()
        node = 4 * i + state
        if cost >= least[node]:
            continue
        if state >= USER:
            clash = first[i] >= 0 and KEPT[first[i]][state] < 0
            more = max(pairs[i], pairs[after[i]] + 1) if clash else pairs[i]
            if cost + base[i] + 2 * more > limit:
                continue
        least[node] = cost
        if i == n:
            found[state] = (cost, path)
            limit = min(limit, cost + 4)
            continue
        role, fault = divmod(symbols[i], 3)
        if fault != GONE:
            extra = cost + (fault == CUT)
            stack.append((i + 1, NEXT[state], extra + 2, (path, "R")))
            if KEPT[role][state] >= 0:
                stack.append((i + 1, KEPT[role][state], extra, (path, "K")))
        stack.append((i, NEXT[state], cost + 2, (path, "I")))
        stack.append((i + 1, state, cost + 3, (path, "D")))
    out = {}
    for state, (cost, path) in found.items():
        edits = []
        while path is not None:
            path, edit = path
            edits.append(edit)
        out[state] = (cost, "".join(reversed(edits)))
    return out


class Searches(dict):
    """Tables by symbols and entry: most conversations look alike."""

    def __missing__(self, key: tuple[bytes, int]) -> Table:
        if len(self) >= REMEMBERED:
            self.clear()
        self[key] = found = search(*key)
        return found


class Front:
    """The best prefix of each state, (cost, audit), over segments that follow each other."""

    def __init__(self, entry: int):
        self.done: list[str] = []
        self.states: Table = {entry: (0, "")}

    def extend(self, tables) -> None:
        """``tables`` gives the table of the next segment for an entry."""
        then: Table = {}
        for entry, (cost, audit) in self.states.items():
            for state, (more, edits) in tables(entry).items():
                new = (cost + more, audit + edits)
                if state not in then or new < then[state]:
                    then[state] = new
        shared = os.path.commonprefix([audit for _, audit in then.values()])
        if len(shared) > SEGMENT:  # what all have in common is not copied again
            self.done.append(shared)
            then = {s: (c, a[len(shared) :]) for s, (c, a) in then.items()}
        self.states = then

    def table(self) -> Table:
        begin = "".join(self.done)
        return {s: (c, begin + a) for s, (c, a) in self.states.items()}

    def closed(self) -> tuple[int, str]:
        """The cheapest whole repair."""
        cost, audit = min(
            (c + 2 * len(CLOSING[s]), a + CLOSING[s]) for s, (c, a) in self.states.items()
        )
        return cost, "".join([*self.done, audit])


def _front(symbols: bytes, entry: int, searches: Searches) -> Front:
    front = Front(entry)
    for i in range(0, len(symbols), SEGMENT):
        part = bytes(symbols[i : i + SEGMENT])
        front.extend(lambda e, part=part: searches[part, e])
    return front


def cheapest_repair(symbols: bytes) -> tuple[int, str]:
    """Cost and audit of one conversation given as symbols."""
    return _front(symbols, START, Searches()).closed()


def damaged_rows(conversations: DataFrame) -> DataFrame:
    """Rows as a faulty export would leave them, one fault in five rows by a checksum of their key.

    Adds ``copies``: 0 for a row that is dropped, 2 for one that is repeated, else 1.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(part("conv_id"), F.lit(":"), part("turn")), "UTF-8")) % 20
    role, text = part("role"), part("text")
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _key() -> Column:
    """A conversation's id as text that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def _digest() -> Column:
    return F.unhex(F.substring(F.sha2(F.concat_ws("\u0000", "role", "text"), 256), 1, 32))


def _facts(rows: DataFrame) -> DataFrame:
    """Different rows, without their texts: conv, turn, role, digest, initial, fault, n.

    Equal rows are one with their number, so that none is too many for a task. A row is repeated if
    its role and text have an earlier turn; only texts of several turns are joined for that.
    """
    live = rows.copies > 0
    blank = ~rows.text.rlike(NO_BLANK)
    cut = ~rows.text.rlike(f"[.!?]{BLANK}*+\\z")  # not $, before which a line's end may stand
    initial = F.instr(F.lit("sua"), F.substring("role", 1, 1)) - 1
    initial = F.when((F.length("role") > 0) & (initial >= 0), initial).otherwise(3)
    narrow = (
        rows.select(
            _key().alias("conv"),
            F.when(live, F.col("turn")).alias("turn"),
            F.when(live, F.col("role")).alias("role"),
            F.when(live, _digest()).alias("digest"),
            F.when(live, initial).otherwise(-1).alias("initial"),
            (live & blank).alias("blank"),
            (live & cut).alias("cut"),
            "copies",
        )
        .groupBy("conv", "turn", "role", "digest", "initial", "blank", "cut")
        .agg(F.sum("copies").alias("n"))
    )
    seen = (
        narrow.where("NOT blank AND digest IS NOT NULL")
        .groupBy("conv", "digest")
        .agg(F.count("*").alias("turns"), F.min("turn").alias("least"), F.bool_or(F.col("turn").isNull()).alias("none"))
        .where("turns > 1")
        .drop("turns")
    )
    later = F.col("turn").isNotNull() & F.coalesce(F.col("none") | (F.col("turn") > F.col("least")), F.lit(False))
    fault = F.when(F.col("blank"), 1).when(later, 2).when(F.col("cut"), 3).otherwise(0)
    return salted_join(narrow, seen, ["conv", "digest"], "left", ["turn"]).select(
        "conv", "turn", "role", "digest", F.col("initial").cast("int").alias("initial"),
        fault.cast("int").alias("fault"), "n",
    )


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PIECE = (
    "conv string, part int, open boolean, lo long, hi long, turns long, head int, tail int, blank long, "
    "duplicate long, truncated long, illegal long, cost long, audit string, "
    "tables array<struct<entry: int, state: int, cost: long, audit: string>>"
)
SOLVED = "conv string, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"


def legal(a: int, b: int) -> bool:
    """Whether the initial ``b`` may follow ``a``: su, ua, au."""
    return (a, b) in ((0, 1), (1, 2), (2, 1))


class _Run:
    """Rows of one conversation that follow each other in a sorted partition."""

    def __init__(self, conv: str, opens: bool):
        self.conv, self.open = conv, opens
        self.symbols = bytearray()
        self.lo = self.hi = None
        self.turns = 0
        self.head = self.tail = -1
        self.faults = [0, 0, 0, 0]
        self.illegal = 0

    def add(self, turn: int | None, initial: int, fault: int, n: int) -> None:
        if n == 0:
            return
        if turn is not None and turn != self.hi:
            self.lo = turn if self.lo is None else self.lo
            self.hi, self.turns = turn, self.turns + 1
        if self.head < 0:
            self.head = initial
        else:
            self.illegal += not legal(self.tail, initial)
        self.tail = initial
        self.symbols.append(3 * initial + (0, GONE, GONE, CUT)[fault])
        self.faults[fault] += 1
        if n > 1:  # more of the same: never the first of their kind, never in order
            self.symbols += bytes([3 * initial + GONE]) * (n - 1)
            self.faults[1 if fault == 1 else 2] += n - 1
            self.illegal += n - 1

    def row(self, part: int, searches: Searches) -> dict:
        row = {
            "conv": self.conv, "part": part, "open": self.open, "lo": self.lo, "hi": self.hi, "turns": self.turns,
            "head": self.head, "tail": self.tail, "blank": self.faults[1], "duplicate": self.faults[2],
            "truncated": self.faults[3], "illegal": self.illegal, "cost": None, "audit": None, "tables": None,
        }
        symbols = bytes(self.symbols)
        if self.open:
            row["tables"] = [
                {"entry": e, "state": s, "cost": c, "audit": a}
                for e in range(4)
                for s, (c, a) in _front(symbols, e, searches).table().items()
            ]
        else:
            row["cost"], row["audit"] = _front(symbols, START, searches).closed()
        return row


def _schema(fields: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    step = pa.struct([("entry", pa.int32()), ("state", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    pairs = [f.split(" ", 1) for f in fields.split(", ") if ":" not in f]
    schema = [(n, kinds[k]) for n, k in pairs]
    return pa.schema(schema + ([("tables", pa.list_(step))] if "tables " in fields else []))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation of a sorted partition; the first and last may go on elsewhere."""
    from pyspark import TaskContext

    part, searches, schema = TaskContext.get().partitionId(), Searches(), _schema(PIECE)
    run, done = None, []
    for batch in batches:
        for conv, turn, initial, fault, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if run is None or conv != run.conv:
                if run is not None:
                    done.append(run.row(part, searches))
                run = _Run(conv, run is None)
            run.add(turn, initial, fault, n)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    if run is not None:
        run.open = True
        yield pa.RecordBatch.from_pylist([run.row(part, searches)], schema)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations whose pieces lie in several partitions: their tables, one after the other."""
    schema = _schema(SOLVED)
    for batch in batches:
        out = []
        for conv, pieces in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            front = Front(START)
            total = dict.fromkeys(COUNTS, 0)
            turns, lo, hi, tail = 0, None, None, -1
            for p in sorted(pieces.as_py(), key=lambda p: p["part"]):
                tables: dict[int, Table] = {e: {} for e in range(4)}
                for t in p["tables"]:
                    tables[t["entry"]][t["state"]] = (t["cost"], t["audit"])
                front.extend(tables.__getitem__)
                for c in ("blank", "duplicate", "truncated", "illegal"):
                    total[c] += p[c]
                if p["lo"] is not None:
                    turns += p["turns"] - (p["lo"] == hi)
                    lo, hi = p["lo"] if lo is None else lo, p["hi"]
                if p["head"] >= 0:
                    total["illegal"] += tail >= 0 and not legal(tail, p["head"])
                    tail = p["tail"]
            total["gaps"] = 0 if lo is None else hi - lo + 1 - turns
            total["cost"], audit = front.closed()
            out.append({"conv": conv, **total, "audit": audit})
        yield pa.RecordBatch.from_pylist(out, schema)


def solved_conversations(rows: DataFrame) -> DataFrame:
    """Counts of faults, cost and audit of each conversation of ``damaged_rows``: see SOLVED.

    Facts without texts are sorted over the cluster by conversation and turn, so that a very long
    conversation is many tasks. Each task solves what lies in it; of the first and last conversation
    of a task it finds the table of all entries and ends, and those tables are put together.
    """
    facts = stored(_facts(rows), "facts")
    pieces = stored(
        facts.repartitionByRange("conv", F.asc_nulls_first("turn"), "role", "digest")
        .sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "digest")
        .select("conv", "turn", "initial", "fault", "n")
        .mapInArrow(_pieces, PIECE),
        "pieces",
    )
    whole = pieces.where("NOT open").select(
        "conv",
        F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("turns"), F.lit(0)).alias("gaps"),
        *COUNTS[1:],
        "audit",
    )
    fields = [c for c in pieces.columns if c not in ("conv", "open", "cost", "audit")]
    spread = pieces.where("open").groupBy("conv").agg(F.collect_list(F.struct(*fields)).alias("pieces"))
    return whole.unionByName(spread.mapInArrow(_together, SOLVED))


class _Repair:
    """Applies an audit to the rows of a conversation as they come, without holding them."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at, self.state = self.at + 1, NEXT[self.state]
            yield ("user" if self.state == USER else "assistant"), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEPT["sua".index(role[0])][self.state]
            yield role, text
        elif edit == "R":
            self.state = NEXT[self.state]
            yield ("user" if self.state == USER else "assistant"), text

    def end(self) -> Iterator[tuple[str, str]]:
        yield from self._inserted()


TEXTS = "conv string, place long, role string, text string"


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows: an audit leads each conversation, its rows follow in order."""
    schema, conv, repair, place = _schema(TEXTS), None, None, 0

    def emit(lines):
        nonlocal place
        for role, text in lines:
            out.append({"conv": conv, "place": place, "role": role, "text": text})
            place += 1

    for batch in batches:
        out: list[dict] = []
        for c, audit, role, text, copies in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if audit is not None:
                if repair is not None:
                    emit(repair.end())
                conv, repair, place = c, _Repair(audit), 0
            else:
                for _ in range(copies):
                    emit(repair.row(role, text))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if repair is not None:
        out = []
        emit(repair.end())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)


HASHED = "conv string, repaired_sha256 string"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each conversation's repaired lines, fed row by row."""
    schema = _schema(HASHED)
    conv = repair = sha = None
    first = True

    def feed(lines):
        nonlocal first
        for role, text in lines:
            sha.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
            first = False

    for batch in batches:
        out = []
        for c, audit, role, text, copies in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if audit is not None:
                if repair is not None:
                    feed(repair.end())
                    out.append({"conv": conv, "repaired_sha256": sha.hexdigest()})
                conv, repair, sha, first = c, _Repair(audit), hashlib.sha256(), True
            else:
                for _ in range(copies):
                    feed(repair.row(role, text))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if repair is not None:
        feed(repair.end())
        yield pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": sha.hexdigest()}], schema)


def _with_audits(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """Rows behind the audit of their conversation, each conversation in one task and in order.

    Nothing is held there: the rows stream past. A blank row is always deleted and leaves its text.
    """
    none = lambda kind: F.lit(None).cast(kind)
    audits = solved.select(
        "conv", "audit", none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"),
        none("binary").alias("digest"), F.lit(0).alias("copies"), F.lit(0).alias("kind"),
    )
    texts = rows.where("copies > 0").select(
        _key().alias("conv"), none("string").alias("audit"), "turn", "role", "text", _digest().alias("digest"),
        "copies", F.lit(1).alias("kind"),
    )
    return (
        audits.unionByName(texts)
        .repartition("conv")
        .sortWithinPartitions("conv", "kind", F.asc_nulls_first("turn"), "role", "digest")
        .select("conv", "audit", "role", "text", "copies")
    )


def _id(kind: str) -> Column:
    return F.when(F.col("conv") != "", F.expr("substring(conv, 2)").cast(kind)).alias("conv_id")


def repair_summary(rows: DataFrame) -> DataFrame:
    """For each conversation of ``rows`` what is wrong, and the cheapest repair.

    ``rows`` has conv_id, turn, role, text and copies (see ``damaged_rows``); other columns are
    ignored. Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256; one row for each conv_id, NULL being one. Rows of one turn stand in order of
    role and a hash of role and text; equal rows repeat each other. A conversation without rows has
    zeros, an empty audit and the hash of nothing; an empty table gives an empty one.

    An audit has a letter for each row of its conversation and must fit in a task; texts need not.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    solved = stored(solved_conversations(rows), "solved")
    hashes = _with_audits(rows, solved).mapInArrow(_hashed, HASHED)
    return solved.join(hashes, "conv").select(_id(kind), *COUNTS, "audit", "repaired_sha256")


def repaired_conversations(rows: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, place (from 0), role, text. See ``repair_summary``."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    solved = solved_conversations(rows).select("conv", "audit")
    return _with_audits(rows, solved).mapInArrow(_repaired, TEXTS).select(_id(kind), "place", "role", "text")


# An independent statement: a checksum by its table, then the cheapest prefix for each state row by row.
SQL = """
WITH RECURSIVE crc(t) AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
    CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END))
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
      string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) % 20 AS kind
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
  FROM keyed, (VALUES (1), (2)) c(copy) WHERE kind <> 0 AND copy <= CASE kind WHEN 3 THEN 2 ELSE 1 END
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), looked AS (
  SELECT *, count(*) OVER (PARTITION BY conv_id) AS n, left(role, 1) AS r,
    CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 3 ELSE 0 END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS two
  FROM placed
), inserted(s, edits, more, t) AS (
  VALUES (0, '', 0, 0), (1, '', 0, 1), (2, '', 0, 2), (3, '', 0, 3),
    (0, 'I', 2, 2), (1, 'I', 2, 2), (2, 'I', 2, 3), (3, 'I', 2, 2),
    (0, 'II', 4, 3), (1, 'II', 4, 3), (2, 'II', 4, 2), (3, 'II', 4, 3)
), kept(s, r, t) AS (
  VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)
), moves AS (
  SELECT i.s, k.r, i.edits || 'K' AS edits, i.more, k.t, 0 AS gone FROM inserted i JOIN kept k ON k.s = i.t
  UNION ALL
  SELECT s, NULL, edits || 'R', more + 2, CASE t WHEN 2 THEN 3 ELSE 2 END, 0 FROM inserted
  UNION ALL
  SELECT s, NULL, edits || 'D', more + 3, t, 1 FROM inserted
), prefix(conv_id, i, s, best) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, '000000000' FROM (SELECT DISTINCT conv_id FROM placed)
  UNION ALL
  SELECT p.conv_id, p.i + 1, m.t, min(
    lpad(CAST(CAST(left(best, 9) AS BIGINT) + more + CASE WHEN fault = 3 AND gone = 0 THEN 1 ELSE 0 END AS VARCHAR),
      9, '0') || substr(best, 10) || edits)
  FROM prefix p JOIN looked l ON l.conv_id IS NOT DISTINCT FROM p.conv_id AND l.i = p.i + 1
  JOIN moves m ON m.s = p.s AND (gone = 1 OR fault IN (0, 3)) AND (m.r IS NULL OR m.r = l.r)
  GROUP BY p.conv_id, p.i, m.t
), best AS (
  SELECT p.conv_id, min(lpad(CAST(CAST(left(best, 9) AS BIGINT) + CASE s WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END
    AS VARCHAR), 9, '0') || substr(best, 10) || CASE s WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END) AS best
  FROM prefix p JOIN (SELECT DISTINCT conv_id, n FROM looked) l
    ON l.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = l.n
  GROUP BY p.conv_id
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal
  FROM looked GROUP BY conv_id
), output(conv_id, i, k, prior, lines) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 10, '', CAST([] AS VARCHAR[]) FROM best
  UNION ALL
  SELECT o.conv_id, o.i + CASE e WHEN 'I' THEN 0 ELSE 1 END, o.k + 1,
    CASE e WHEN 'D' THEN o.prior WHEN 'K' THEN l.r ELSE CASE o.prior WHEN 'u' THEN 'a' ELSE 'u' END END,
    CASE e WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, l.role || ':' || l.text) ELSE list_append(lines,
      CASE o.prior WHEN 'u' THEN 'assistant:' ELSE 'user:' END || CASE e WHEN 'R' THEN l.text ELSE '' END) END
  FROM (SELECT o.*, substr(b.best, o.k, 1) AS e FROM output o JOIN best b
      ON b.conv_id IS NOT DISTINCT FROM o.conv_id WHERE o.k <= length(b.best)) o
  LEFT JOIN looked l ON l.conv_id IS NOT DISTINCT FROM o.conv_id AND l.i = o.i + 1
), repaired AS (
  SELECT o.conv_id, array_to_string(lines, chr(10)) AS whole FROM output o JOIN best b
    ON b.conv_id IS NOT DISTINCT FROM o.conv_id WHERE o.k = length(b.best) + 1
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(CAST(left(best, 9) AS BIGINT), 0) AS cost, coalesce(substr(best, 10), '') AS audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM a.conv_id
"""


@query(SQL)
def op11_conversation_repair(spark, sf_dir):
    return repair_summary(damaged_rows(table(spark, sf_dir, "conversations")))
