"""Repair of conversations at least cost, by an automaton that shares the ends of their signatures.

A conversation's signature has one letter a row: what its role begins with and which fault it has. Two places of any conversations
are one node of the automaton where the rest of their signatures is equal. For each node and each state of the grammar
`(s?(ua)+)?`, the cost to go and the best audit suffix (an edit and a pointer to the node and state behind it) are computed once.
Signatures are sorted from their ends, over ranges: neighbours then share their longest common end, so the nodes in use are a stack.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.session import cut_lineage

FILLED = r"[^\x20\x09-\x0D]"
# states: nothing yet, after s, after u, after a; the conversation may end in the first and the last
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {("u", BEGIN): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT, ("s", BEGIN): SYSTEM}
MADE = {BEGIN: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}  # the one of user and assistant that may follow
ROLE = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
CUT_SHORT = 1
NEVER = 1 << 40


# Letters of a signature: s, u, a or o (any other role) of a sound row, the capital of it for a truncated one, x for one that must go.


@cache
def node_behind(rest: tuple[int, ...] | None, letter: str) -> tuple[tuple[int, ...], int, tuple[str, ...]]:
    """What a node adds before the node ``rest``, both with their costs counted from the cheapest state.

    Gives the costs by state, what the cheapest went up by, and the edits by state: letters I, then one of D, K, R for the row.
    ``rest`` None and an empty letter make the end. Each edit leads to one state only, so edits that tie differ in their first letter.
    """
    if rest is None:
        plain = {q: (0 if q in (BEGIN, ASSISTANT) else NEVER, "") for q in range(4)}
    else:
        plain = {}
        for q in range(4):
            ways = [(rest[q] + DELETE, "D")]
            if letter != "x":
                more = CUT_SHORT if letter.isupper() else 0
                kept = NEXT.get((letter.lower(), q))
                if kept is not None:
                    ways.append((rest[kept] + KEEP + more, "K"))
                ways.append((rest[NEXT[MADE[q], q]] + REROLE + more, "R"))
            plain[q] = min(ways)
    best = dict(plain)
    for _ in range(3):  # more inserts in a row would come back to a state
        for q in range(4):
            cost, edits = best[NEXT[MADE[q], q]]
            best[q] = min(best[q], (cost + INSERT, "I" + edits))
    least = min(cost for cost, _ in best.values())
    return tuple(min(best[q][0], NEVER) - least for q in range(4)), least, tuple(best[q][1] for q in range(4))


class SharedEnds:
    """Stack of the nodes on the way from the end to the start of the last signature."""

    def __init__(self):
        self.nodes: dict[tuple, int] = {}
        self.known: list[tuple] = []
        self.last, self.kind, self.cost = "", array("i"), array("q")
        self.made = 0
        self._push(*node_behind(None, ""), 0)

    def _push(self, costs, more, edits, before) -> None:
        key = (costs, edits)
        if key not in self.nodes:
            self.nodes[key] = len(self.known)
            self.known.append(key)
        self.kind.append(self.nodes[key])
        self.cost.append(before + more)
        self.made += 1

    def repair(self, ending: str) -> tuple[int, str]:
        """Cost and audit of a signature that is given from its end."""
        shared = shared_length(self.last, ending)
        del self.kind[shared + 1 :], self.cost[shared + 1 :]
        for letter in ending[shared:]:
            self._push(*node_behind(self.known[self.kind[-1]][0], letter), self.cost[-1])
        self.last = ending
        audit, state = [], BEGIN
        for at in range(len(ending), -1, -1):
            edits = self.known[self.kind[at]][1][state]
            audit.append(edits)
            letter = ending[at - 1].lower() if at else ""
            for edit in edits:
                state = state_after(state, edit, letter)
        return self.cost[-1] + self.known[self.kind[-1]][0][BEGIN], "".join(audit)


def shared_length(a: str, b: str) -> int:
    """Length of the longest common beginning, by halving."""
    least, most = 0, min(len(a), len(b))
    while least < most:
        half = (least + most + 1) // 2
        if a[least:half] == b[least:half]:
            least = half
        else:
            most = half - 1
    return least


def state_after(state: int, edit: str, letter: str) -> int:
    if edit == "D":
        return state
    return NEXT[letter if edit == "K" else MADE[state], state]


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise(F.lit("o"))


def _turn(turn: Column) -> Column:
    return F.struct(turn.isNotNull().alias("told"), turn.alias("turn"))


def _rows(talks: DataFrame) -> DataFrame:
    copies = F.greatest(F.coalesce(F.col("copies"), F.lit(1)), F.lit(0)) if "copies" in talks.columns else F.lit(1)
    role, text = F.coalesce(F.col("role"), F.lit(" ")), F.coalesce(F.col("text"), F.lit(" "))
    return talks.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"), text.alias("text"), copies.cast("bigint").alias("copies"),
    )


def signatures(talks: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, and its signature, read from the end, as ``ending``.

    Roles and texts take part as digests: equal rows of a turn are counted first, and the first turn of each role and text comes from
    a minimum that is combined before the shuffle, so rows of one conversation meet in one task as some 50 bytes each, in
    order, and only their letters are held.
    """
    last = F.regexp_extract("text", rf"({FILLED})[\x20\x09-\x0D]*\z", 1)
    marked = _rows(talks).select(
        "conv_id", "turn", "role", "copies", F.unhex(F.md5(F.concat(F.col("role"), F.lit("\x00"), F.col("text")))).alias("same"),
        F.when(last == "", "b").when(last.isin(".", "!", "?"), "f").otherwise("t").alias("fault"),
    )
    told = marked.groupBy("conv_id", "turn", "role", "same", "fault").agg(F.sum("copies").alias("copies"))
    told = told.select("conv_id", _turn(F.col("turn")).alias("at"), "role", "same", _initial(F.col("role")).alias("initial"), "fault", "copies")
    first = marked.where("copies > 0").groupBy("conv_id", "role", "same").agg(F.min(_turn(F.col("turn"))).alias("at"))
    first = first.select("conv_id", "at", "role", "same", F.lit("").alias("initial"), F.lit("").alias("fault"), F.lit(0).cast("bigint").alias("copies"))
    lined = told.unionByName(first).repartition("conv_id").sortWithinPartitions("conv_id", "at", "role", "same", "fault")
    lined = lined.select("conv_id", "at.turn", "initial", "fault", "copies")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal"]
    schema = "conv_id bigint, " + ", ".join(f"{n} bigint" for n in names) + ", ending string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        talk, open_ = None, False
        for batch in batches:
            for conv, turn, initial, fault, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if not open_ or conv != talk:
                    if open_:
                        done.append((talk, *sign.told()))
                        if len(done) == 10_000:
                            yield listed(done)
                            done = []
                    talk, open_, sign = conv, True, _Signature()
                sign.add(turn, initial, fault, copies)
        if open_:
            done.append((talk, *sign.told()))
        if done:
            yield listed(done)

    def listed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 6 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["conv_id", *names, "ending"])

    return lined.mapInArrow(run, schema)


class _Signature:
    """Letters and counts of one conversation, from its distinct rows in order."""

    def __init__(self):
        self.letters, self.counts, self.illegal = bytearray(), {"b": 0, "d": 0, "t": 0}, 0
        self.first = self.turn = None
        self.turns = 0
        self.new, self.before = False, ""

    def add(self, turn: int | None, initial: str, fault: str, copies: int) -> None:
        if not fault:  # sorted before the row itself: this is the first turn that has its role and text
            self.new = True
            return
        new, self.new = self.new, False
        if not copies:
            return
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn, self.turns = turn, self.turns + 1
        if fault == "b":
            self.counts["b"] += copies
            self.letters += b"x" * copies
        else:
            again = copies - 1 if new else copies
            self.counts["d"] += again
            if new:
                self.counts["t"] += fault == "t"
                self.letters += (initial.upper() if fault == "t" else initial).encode()
            self.letters += b"x" * again
        legal = {"su", "ua", "au"}
        self.illegal += (self.before != "" and self.before + initial not in legal) + (copies - 1)  # no letter may follow itself
        self.before = initial

    def told(self) -> tuple:
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        return gaps, self.counts["b"], self.counts["d"], self.counts["t"], self.illegal, self.letters[::-1].decode()


def audits(signed: DataFrame) -> DataFrame:
    """The rows of ``signatures`` with ``cost`` and ``audit`` for their ``ending``.

    Rows are dealt over ranges by ending, and by conversation where many have one ending, and sorted, so conversations with a common
    end stand together and a task builds each node of its part of the automaton once.
    """
    ranged = signed.repartitionByRange("ending", "conv_id").sortWithinPartitions("ending")
    schema = ", ".join(f"{n} {t}" for n, t in signed.dtypes if n != "ending") + ", cost bigint, audit string"
    at = signed.columns.index("ending")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = SharedEnds()
        for batch in batches:
            if batch.num_rows:
                costs, found = zip(*map(shared.repair, batch.column(at).to_pylist()))
                rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n != "ending"]
                yield pa.RecordBatch.from_arrays([*(c for _, c in rest), pa.array(costs, pa.int64()), pa.array(found, pa.string())], names=[*(n for n, _ in rest), "cost", "audit"])

    return ranged.mapInArrow(run, schema)


def repair(talks: DataFrame, texts: bool = True) -> DataFrame:
    """Each conversation with its faults and its cheapest repair.

    ``talks`` has rows (conv_id, turn, role, text) and may have ``copies``, how often each row stands there; with 0 it only names its
    conversation. Nulls in role and text are read as one space; rows of a null conv_id are one conversation; null turns come first;
    rows of one turn are ordered by role, then by the MD5 of role and text. Other columns do not enter.

    Result: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, and with ``texts`` the repaired
    `role:text` rows, joined by line ends, as ``repaired``. A row's first fault counts: blank (white space only), duplicate (role and
    text of an earlier row), truncated (the last character that is no white space is none of .!?). Edits: K keeps a row (0), R makes its role user
    or assistant (2), D deletes it (3; blank ones and duplicates must go), I inserts an empty row of user or assistant (2); a truncated
    row that is not deleted costs 1 more. The audit is the cheapest list of edits that leaves roles beginning like `(s?(ua)+)?`, of equally
    cheap ones the least in ASCII. A conversation without rows has zeros and empty texts. Very long conversations: rows stream
    in their order through one task; held are one letter a row, the audit, and with ``texts`` the repaired text.
    """
    signed = cut_lineage(signatures(talks), "signatures")
    told = audits(signed)
    carried = [f for f in told.schema.fieldNames() if f != "conv_id"]
    rows = _rows(talks).where("copies > 0").withColumn(
        "same", F.unhex(F.md5(F.concat(F.col("role"), F.lit("\x00"), F.col("text"))))
    ).select("conv_id", _turn(F.col("turn")).alias("at"), "role", "same", "text", "copies", F.lit(None).cast(told.drop("conv_id").schema).alias("told"))
    heads = told.select(
        "conv_id", F.lit(None).cast(rows.schema["at"].dataType).alias("at"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("same"),
        F.lit(None).cast("string").alias("text"), F.lit(0).cast("bigint").alias("copies"), F.struct(*carried).alias("told"),
    )
    lined = rows.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", "at", "role", "same")
    lined = lined.select("conv_id", "role", "text", "copies", "told")
    schema = "conv_id bigint, " + ", ".join(f"{f} {told.schema[f].dataType.simpleString()}" for f in carried) + ", repaired_sha256 string" + (", repaired string" if texts else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        talk = None
        for batch in batches:
            for conv, role, text, copies, told_ in zip(*(c.to_pylist() for c in batch.columns)):
                if told_ is not None:
                    if talk:
                        done.append(talk.told())
                    talk = _Repair(conv, [told_[f] for f in carried], told_["audit"], texts)
                    if len(done) == 1_000:
                        yield listed(done)
                        done = []
                else:
                    for _ in range(copies):
                        talk.row(role, text)
        if talk:
            done.append(talk.told())
        if done:
            yield listed(done)

    def listed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 7 + [pa.string()] * (3 if texts else 2)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["conv_id", *carried, "repaired_sha256", *(["repaired"] if texts else [])])

    return lined.mapInArrow(run, schema)


class _Repair:
    """Applies an audit to rows as they come."""

    def __init__(self, conv: int | None, counts: list, audit: str, texts: bool):
        self.conv, self.counts, self.audit, self.at, self.state = conv, counts, audit, 0, BEGIN
        self.hash, self.first, self.kept = hashlib.sha256(), True, [] if texts else None

    def _put(self, role: str, text: str) -> None:
        line = f"{'' if self.first else chr(10)}{role}:{text}"
        self.first = False
        self.hash.update(line.encode())
        if self.kept is not None:
            self.kept.append(line)

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            made = MADE[self.state]
            self._put(ROLE[made], "")
            self.state, self.at = NEXT[made, self.state], self.at + 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._put(role, text)
        elif edit == "R":
            self._put(ROLE[MADE[self.state]], text)
        self.state = state_after(self.state, edit, role[:1])

    def told(self) -> tuple:
        self._inserts()
        return (self.conv, *self.counts, self.hash.hexdigest(), *(["".join(self.kept)] if self.kept is not None else []))


def damaged(talks: DataFrame) -> DataFrame:
    """The rows, damaged by CRC-32(`conv_id:turn`) % 20, nulls read as one space: 0 drops a row, 1 empties its text, 2 removes its `.!?`,
    3 repeats it, 4 makes it a user's. Repeats and drops are told by ``copies``."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))) % 20
    text = F.when(h == 1, F.lit("")).when(h == 2, F.translate(or_space("text"), ".!?", "")).otherwise(or_space("text"))
    return talks.select(
        "conv_id", "turn", F.when(h == 4, F.lit("user")).otherwise(or_space("role")).alias("role"), text.alias("text"),
        F.when(h == 0, 0).when(h == 3, 2).otherwise(1).alias("copies"),
    )
