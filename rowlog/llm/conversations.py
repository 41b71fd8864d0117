"""Conversation structure repair with a suffix-shared DAWG.

A row's role initial and fault make one letter, a conversation's rows in order
make its signature, and the cheapest way to a well-formed conversation depends
on the signature alone. Well formed are role initials `(s?(ua)+)?`. Edits: Keep
costs 0, Rerole (to the role that must stand there, user or assistant) 2,
Delete 3 (the only edit of blank and duplicate rows), Insert (an empty user or
assistant text) 2; a truncated row that stays adds 1. Among the cheapest ways
the one with the ASCII-least audit, the edits' initials, is taken.

1. Letters come from narrow rows without texts; a duplicate is found by the
   text's 128-bit hash. Signatures are counted before they go further, so
   conversations of one shape are one row.
2. The distinct signatures are sorted from their ends. A node of the automaton
   is a suffix, found as its last letters' node and one letter before them;
   signatures that share a suffix stand together, and what they share is kept
   from one to the next. For every node and grammar state, the cost to go and
   the first edit of the best audit suffix are computed once (again only
   where two tasks' ranges of signatures meet).
3. A conversation's audit goes before its rows as one more row, and the edits
   are applied row by row while the rows stream by, in order.

Rows are taken by turn (nulls first), ties by role, then by the hash of the
text; so copies of a row stand next to each other. A task holds one letter a
row of the conversation that it reads and of the signatures' common suffixes,
never the texts of a conversation.

Edge cases: null roles and texts are one space (such a row is blank); a role
other than by the initials s, u or a, the empty one too, can't be kept as it
is; a null conv_id is a conversation like any other; a conversation without
rows has an empty audit at no cost; an empty table gives no rows. Other
columns, and their names, don't matter.
"""
from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowlog.llm.common import exact, landed, prepare

BLANK, DUPLICATE, TRUNCATED, SOUND = "blank", "duplicate", "truncated", "sound"
INITIALS = "sua"
GOES = "x"  # the letter of a row that must go
# Letters: role initial, lower case if sound and upper case if truncated; `o` for any other role.
START, SYSTEM, USER, ASSISTANT = range(4)
FORCED = (USER, USER, ASSISTANT, USER)  # the state after the role that Rerole or Insert must give
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1
_STATES = 4


# ---- damage ------------------------------------------------------------------------
def one_space(c: Column | str) -> Column:
    """The column as text; null is one space."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(" "))


def damaged(table: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of `table` after damage by the CRC-32 of
    `conv_id:turn` modulo 20, for trials of the repair. Every conversation
    keeps a row: those of dropped rows are marked `dropped`."""
    rows = exact(table, "conv_id", "turn", "role", "text").select("conv_id", "turn", one_space("role").alias("role"), one_space("text").alias("text"))
    rows = rows.withColumn("hurt", F.crc32(F.concat(one_space("conv_id"), F.lit(":"), one_space("turn")).cast("binary")) % 20)
    text = F.when(F.col("hurt") == 1, "").when(F.col("hurt") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("hurt") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("hurt") == 0).alias("dropped"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("hurt") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


# ---- signatures --------------------------------------------------------------------
def _ordered(rows: DataFrame, dropped: str | None) -> DataFrame:
    """conv_id, turn, role, text, dropped, and h1, h2: the order of rows with one turn and role."""
    names = ["conv_id", "turn", "role", "text", *([dropped] if dropped else [])]
    gone = F.col(dropped) if dropped else F.lit(False)
    rows = exact(rows, *names).select("conv_id", "turn", one_space("role").alias("role"), one_space("text").alias("text"), gone.alias("dropped"))
    return rows.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(7), "text")})


def _lettered(rows: DataFrame) -> DataFrame:
    """Narrow rows: what counts of role and text, without the text."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ends_well = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    narrow = rows.select(
        "conv_id", "turn", "role", "h1", "h2", "dropped", F.substring("role", 1, 1).alias("initial"),
        F.when(blank, BLANK).when(~ends_well, TRUNCATED).otherwise(SOUND).alias("look")).repartition("conv_id")
    seen = Window.partitionBy("conv_id", "role", "h1", "h2", "dropped").orderBy("turn")
    fault = F.when(F.col("look") == BLANK, BLANK).when(F.row_number().over(seen) > 1, DUPLICATE).otherwise(F.col("look"))
    return narrow.select("conv_id", "turn", "role", "h1", "h2", "dropped", "initial", fault.alias("fault"))


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, signature string"
_FIELDS = ["gaps", BLANK, DUPLICATE, TRUNCATED, "illegal"]


def letter(initial: str, fault: str) -> str:
    if fault in (BLANK, DUPLICATE):
        return GOES
    role = initial if initial and initial in INITIALS else "o"
    return role.upper() if fault == TRUNCATED else role


def signatures(rows: DataFrame, dropped: str | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, signature: one row for each conversation."""
    kind = dict(rows.dtypes)["conv_id"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, open_ = None, False
        out: list[tuple] = []

        def fresh() -> None:
            nonlocal counts, low, high, turns, last, before, sign
            counts = dict.fromkeys(_FIELDS, 0)
            low = high = last = before = None
            turns, sign = 0, []

        def close() -> None:
            counts["gaps"] = high - low + 1 - turns if turns else 0
            out.append((conv, *(counts[f] for f in _FIELDS), "".join(sign)))

        counts = low = high = turns = last = before = sign = None
        for b in batches:
            for c, turn, dropped, initial, fault in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if not open_ or c != conv:
                    if open_:
                        close()
                    conv, open_ = c, True
                    fresh()
                if dropped:
                    continue
                if turn is not None and turn != last:
                    low, high, last, turns = (turn if low is None else low), turn, turn, turns + 1
                if fault in counts:
                    counts[fault] += 1
                if before is not None and before + initial not in ("su", "ua", "au"):
                    counts["illegal"] += 1
                before = initial
                sign.append(letter(initial, fault))
                if len(sign) == 4096:
                    sign = ["".join(sign)]
            yield _reports(out, b.schema.field(0).type)
            out = []
        if open_:
            close()
            yield _reports(out, b.schema.field(0).type)

    ordered = _lettered(_ordered(rows, dropped)).sortWithinPartitions("conv_id", "turn", "role", "h1", "h2")
    return ordered.select("conv_id", "turn", "dropped", "initial", "fault").mapInArrow(read, f"conv_id {kind}, {_REPORT}")


def _reports(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * 7
    types = [kind, *[pa.int64()] * 5, pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["conv_id", *_FIELDS, "signature"])


# ---- the automaton -----------------------------------------------------------------
class Dawg:
    """The nodes on the path of the last signature, from the end: node k stands
    for its last k letters. A node has, for each grammar state, the cost to go
    and the first edit of the best audit suffix."""

    def __init__(self) -> None:
        self.letters = ""  # from the end
        # Without letters: only a whole pair, or nothing at all, may stand.
        self.cost = array("q")
        self.first = bytearray()
        self.nodes = 0  # made so far
        self._settle([0, None, None, 0], ["", "", "", ""])

    def _settle(self, cost: list, first: list[str]) -> None:
        """Add Insert to the edits of a node, and keep the node. Inserts lead
        round the two states after user and after assistant, so two rounds do."""
        cost, first = list(cost), list(first)
        for _ in range(2):
            for state in (ASSISTANT, USER, START, SYSTEM):
                if (after := cost[FORCED[state]]) is None:
                    continue
                # At equal cost the ASCII-least first edit is better; no two edits have one initial.
                if cost[state] is None or (after + INSERT_COST, "I") < (cost[state], first[state]):
                    cost[state], first[state] = after + INSERT_COST, "I"
        self.cost.extend(cost)
        self.first.extend(ord(f) if f else 0 for f in first)
        self.nodes += 1

    def _add(self, letter: str) -> None:
        at = len(self.cost) - _STATES
        cost, first = [0] * _STATES, [""] * _STATES
        more = TRUNCATED_COST if letter.isupper() else 0
        for state in range(_STATES):
            ways = [(self.cost[at + state] + DELETE_COST, "D")]
            if letter != GOES:
                if (after := kept(state, letter)) is not None:
                    ways.append((self.cost[at + after] + KEEP_COST + more, "K"))
                ways.append((self.cost[at + FORCED[state]] + REROLE_COST + more, "R"))
            cost[state], first[state] = min(ways)
        self._settle(cost, first)

    def audit(self, signature: str) -> tuple[int, str]:
        """Cost and audit. Signatures given in the order of their reversed
        letters share all nodes of their common suffixes."""
        back = signature[::-1]
        same = _common(self.letters, back)
        del self.cost[_STATES * (same + 1):]
        del self.first[_STATES * (same + 1):]
        for x in back[same:]:
            self._add(x)
        self.letters = back
        k, state, edits = len(back), START, bytearray()
        total = self.cost[_STATES * k + state]
        while edit := self.first[_STATES * k + state]:
            edits.append(edit)
            if edit == 0x49:  # I
                state = FORCED[state]
                continue
            if edit == 0x4B:  # K
                state = kept(state, back[k - 1])
            elif edit == 0x52:  # R
                state = FORCED[state]
            k -= 1
        return total, edits.decode()


def kept(state: int, letter: str) -> int | None:
    """The grammar state after a row that is kept, if it may be."""
    role = letter.lower()
    if role == "s":
        return SYSTEM if state == START else None
    if role == "u":
        return USER if state != USER else None
    return ASSISTANT if role == "a" and state == USER else None


def _common(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def audits(distinct: DataFrame) -> DataFrame:
    """signature, cost, audit of every row of `distinct` (signature)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dawg = Dawg()
        for b in batches:
            found = [dawg.audit(s) for s in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
                names=["signature", "cost", "audit"])

    back = F.reverse("signature")
    return distinct.select("signature").repartitionByRange(back).sortWithinPartitions(back).mapInArrow(
        run, "signature string, cost long, audit string")


# ---- repair ------------------------------------------------------------------------
def report(rows: DataFrame, dropped: str | None = None) -> DataFrame:
    """One row for each conversation: conv_id, gaps, blank, duplicate,
    truncated, illegal, signature, cost, audit. Landed. `dropped` names a
    boolean column: rows that count for the list of conversations only."""
    prepare(rows.sparkSession)
    signed = landed(signatures(rows, dropped), "signatures")
    shapes = landed(audits(signed.select("signature").distinct()), "audits")
    return landed(signed.join(shapes, "signature"), "conversations")


def repaired(rows: DataFrame, reports: DataFrame, dropped: str | None = None) -> DataFrame:
    """conv_id, place, edit, role, text: the repaired rows of each conversation
    in order (K, R and I); deleted rows are left out. Partitions hold whole conversations."""
    kind = dict(rows.dtypes)["conv_id"]
    rows = _ordered(rows, dropped).where("not dropped").select("conv_id", F.lit(1).alias("part"), "turn", "role", "h1", "h2", "text")
    heads = reports.select(
        "conv_id", F.lit(0).alias("part"), F.lit(None).cast(dict(rows.dtypes)["turn"]).alias("turn"), F.lit("").alias("role"),
        F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"), F.col("audit").alias("text"))
    both = heads.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "role", "h1", "h2")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, todo, at, state, place = None, "", 0, START, 0
        out: list[tuple] = []

        def inserts() -> None:
            nonlocal at, state, place
            while at < len(todo) and todo[at] == "I":
                state = FORCED[state]
                out.append((conv, place, "I", ROLE_OF[state], ""))
                at, place = at + 1, place + 1

        for b in batches:
            for c, part, role, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if part == 0:
                    conv, todo, at, state, place = c, text, 0, START, 0
                    inserts()
                    continue
                edit, at = todo[at], at + 1
                if edit != "D":
                    if edit == "K":
                        state = kept(state, role[0])
                    else:
                        state = FORCED[state]
                        role = ROLE_OF[state]
                    out.append((conv, place, edit, role, text))
                    place += 1
                inserts()
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            types = [b.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["conv_id", "place", "edit", "role", "text"])
            out = []

    return both.select("conv_id", "part", "role", "text").mapInArrow(apply, f"conv_id {kind}, place long, edit string, role string, text string")


def digest(reports: DataFrame, rows: DataFrame) -> DataFrame:
    """The reports, and the SHA-256 of each conversation's repaired `role:text`
    lines; `rows` come as `repaired` gives them. A conversation's hash is
    taken while its rows pass, without joining them up."""
    kind = dict(reports.dtypes)["conv_id"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha = None, None
        out: list[tuple] = []
        for b in batches:
            for c, place, role, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if place == 0:
                    if sha is not None:
                        out.append((conv, sha.hexdigest()))
                    conv, sha = c, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            yield _hashes(out, b.schema.field(0).type)
            out = []
        if sha is not None:
            yield _hashes([(conv, sha.hexdigest())], b.schema.field(0).type)

    hashes = rows.select("conv_id", "place", "role", "text").mapInArrow(hashed, f"conv_id {kind}, sha string")
    hashes = hashes.withColumnRenamed("conv_id", "of")
    nothing = hashlib.sha256().hexdigest()
    return reports.join(hashes, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", *_FIELDS, "cost", "audit", F.coalesce("sha", F.lit(nothing)).alias("repaired_sha256"))


def _hashes(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), pa.array(cols[1], pa.string())], names=["conv_id", "sha"])
