"""Repair of the structure of conversations: the cheapest edits that give a legal sequence of roles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import cut, type_of
from keyloom.llm.conversations import positions

#: What the first fault of a row is.
WHOLE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Costs: a row's role set anew, a row deleted, one inserted, and a truncated row that stays.
REROLE, DELETE, INSERT, RAGGED = 3, 4, 3, 3
FAR = 1 << 60
#: Legal roles are ``(s?(ua)+)?``. States: nothing yet, after the system row, after a user row, after an assistant row; and
#: what each initial leads to (-1: nowhere). From every state exactly one of user and assistant is legal.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {"s": (SYSTEM, -1, -1, -1), "u": (USER, USER, -1, USER), "a": (-1, -1, ASSISTANT, -1), "x": (-1, -1, -1, -1)}
TURN = (USER, USER, ASSISTANT, USER)
ENDS = (True, False, False, True)
LEGAL_PAIRS = {"su", "ua", "au"}
#: Rows that are searched at once, from the end of a conversation.
SUFFIX = 8
#: Rows of one piece of a conversation's codes.
PIECE = 4096


def cheapest(initials: str, faults: str) -> tuple[int, str]:
    """The least cost and the ASCII-least of its edit strings, over ``D``, ``I``, ``K`` and ``R``.

    Iterative-deepening A*: depth-first in the order of the letters, within a bound that grows to the least cost that was out of
    reach. The estimate is what the faults of the rows ahead cost at least. A table holds for each row and state the
    cost that a failed search has shown to be too little, over all bounds, so no search fails twice for one reason. It is
    filled from the end, ``SUFFIX`` rows at a time, by the same search.
    """
    n = len(initials)
    least = (0, DELETE, DELETE, RAGGED)
    ahead = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        ahead[i] = ahead[i + 1] + least[int(faults[i])]
    #: by 4 * row + state: no path from there costs less
    known = [ahead[i // 4] for i in range(4 * (n + 1))]

    def edits(i: int, state: int) -> list[tuple[str, int, int]]:
        """Letters in order, with their cost and the place they lead to."""
        found = [] if i == n else [("D", DELETE, 4 * (i + 1) + state)]
        found.append(("I", INSERT, 4 * i + TURN[state]))
        if i < n and faults[i] in "03":
            extra = RAGGED if faults[i] == "3" else 0
            kept = NEXT[initials[i]][state]
            if kept >= 0:
                found.append(("K", extra, 4 * (i + 1) + kept))
            found.append(("R", REROLE + extra, 4 * (i + 1) + TURN[state]))
        return found

    def search(start: int, stop: int) -> tuple[int, str]:
        """Cost and letters of the way from ``start`` to the end, or to row ``stop``, whose table entries are exact."""
        bound = known[start]
        while True:
            # a frame: its place, what may still be spent, its edits, the next of them, and the least cost proven from there
            stack = [[start, bound, edits(start // 4, start % 4), 0, FAR]]
            letters: list[str] = []
            while stack:
                frame = stack[-1]
                at, left, choices, k, low = frame
                if at // 4 == stop and (stop < n or ENDS[at % 4]):
                    known[start] = bound
                    return bound, "".join(letters)
                if k == len(choices):
                    known[at] = max(known[at], low)
                    stack.pop()
                    if stack:
                        letters.pop()
                        above = stack[-1]
                        above[4] = min(above[4], above[2][above[3] - 1][1] + known[at])
                    continue
                frame[3] += 1
                letter, cost, place = choices[k]
                if cost + known[place] > left:
                    frame[4] = min(low, cost + known[place])
                    continue
                letters.append(letter)
                stack.append([place, left - cost, edits(place // 4, place % 4), 0, FAR])
            bound = known[start]

    # a long conversation's last rows are searched first, so its bounds don't start from the root again and again
    stop = n
    for row in range((n - 1) // SUFFIX * SUFFIX, -1, -SUFFIX):
        beyond = min(known[4 * stop : 4 * stop + 4]) - ahead[stop]
        known[4 * row : 4 * stop] = [ahead[i] + beyond for i in range(row, stop) for _ in range(4)]
        for state in range(4 if row else 0):
            search(4 * row + state, stop)
        stop = row
    return search(0, n)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` after the test damage: by crc32 of ``conv_id:turn`` modulo 20 a row is dropped (``gone``), emptied, stripped
    of ``.!?``, repeated, or given to the user. Nulls are one space."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    hit = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    return conversations.select(
        "conv_id", "turn", (hit == 0).alias("gone"),
        F.when(hit == 4, "user").otherwise(role).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


RESULT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
)


class _Open:
    """A conversation whose rows are being read: its counts, its edits, and the hash of what is repaired so far."""

    def __init__(self, conv_id, gaps: int, initials: str, faults: str) -> None:
        cost, self.audit = cheapest(initials, faults)
        illegal = sum(initials[i : i + 2] not in LEGAL_PAIRS for i in range(len(initials) - 1))
        counts = [faults.count(str(f)) for f in (BLANK, DUPLICATE, TRUNCATED)]
        self.row = [conv_id, gaps, *counts, illegal, cost, self.audit]
        self.hash = hashlib.sha256()
        self.at, self.state, self.begun = 0, START, False

    def _write(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode())
        self.begun = True

    def inserts(self) -> None:
        """Writes the rows that are inserted here."""
        while self.audit.startswith("I", self.at):
            self.state = TURN[self.state]
            self._write("user" if self.state == USER else "assistant", "")
            self.at += 1

    def take(self, role: str, text: str) -> None:
        """Reads the next row and does its edit."""
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = NEXT[role[0]][self.state]
            self._write(role, text)
        elif edit == "R":
            self.state = TURN[self.state]
            self._write("user" if self.state == USER else "assistant", text)

    def done(self) -> list:
        self.inserts()
        return [*self.row, self.hash.hexdigest()]


def repair(rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``conv_id, turn, gone, role, text``: the faults found, ``cost``, ``audit`` and ``repaired_sha256``.

    Rows that are not ``gone`` are taken by turn, nulls first, those of one turn by the digest of role and text. ``gaps``
    counts missing turn numbers between the least and the greatest; each row's first fault counts as ``blank``, ``duplicate`` of an
    earlier role and text, or ``truncated``; ``illegal`` counts adjacent roles not su, ua or au. ``audit`` are the letters of
    the cheapest edits (see ``cheapest``), ``repaired_sha256`` the hash of the repaired ``role:text`` lines.

    Texts are reduced to digests and faults before rows get their places, places are joined to codes of one letter a
    row piece by piece, and only these letters and the answer, which has a letter a row as well, are held for a
    whole conversation. The texts are read once more in order, a batch at a time, for their hash.

    A null conv_id is a conversation of its own; a conversation whose rows are all gone has zeros, an empty audit and the hash
    of nothing; a role of another initial, or none, is never kept; an empty table gives no rows; other columns are ignored.
    """
    kind = type_of(rows, "conv_id")
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    rows = rows.select("conv_id", "turn", "gone", "role", "text", digest.alias("digest"))
    initial = F.substring("role", 1, 1)
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(WHOLE)
    codes = rows.where(~F.col("gone")).select("conv_id", "turn", "digest", F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"), fault.cast("string").alias("fault"))
    placed = cut(positions(codes, "conv_id", ["turn", "digest"]))
    repeated = placed.groupBy(F.col("conv_id").alias("again_id"), F.col("digest").alias("again")).agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    again = F.col("first").isNotNull() & (F.col("pos") > F.col("first")) & (F.col("fault") != str(BLANK))
    flagged = placed.join(repeated, F.col("conv_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again")), "left").withColumn("fault", F.when(again, str(DUPLICATE)).otherwise(F.col("fault")))
    in_piece = flagged.groupBy("conv_id", F.floor(F.col("pos") / PIECE).alias("piece")).agg(F.sort_array(F.collect_list(F.struct("pos", "initial", "fault"))).alias("c"))
    pieces = in_piece.select("conv_id", F.struct("piece", F.array_join("c.initial", "").alias("initials"), F.array_join("c.fault", "").alias("faults")).alias("p"))
    whole = pieces.groupBy(F.col("conv_id").alias("code_id")).agg(F.sort_array(F.collect_list("p")).alias("p"))
    here = F.when(~F.col("gone"), F.col("turn"))
    turns = rows.groupBy("conv_id", here.alias("turn")).agg(F.lit(1).alias("one"))
    spans = turns.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    heads = spans.join(whole, F.col("conv_id").eqNullSafe(F.col("code_id")), "left").select(
        "conv_id", F.lit(True).alias("head"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("digest"),
        F.coalesce(F.array_join("p.initials", ""), F.lit("")).alias("role"), F.coalesce(F.array_join("p.faults", ""), F.lit("")).alias("text"), F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"),
    )
    lines = rows.where(~F.col("gone")).select("conv_id", F.lit(False).alias("head"), "turn", "digest", "role", "text", F.lit(0).cast("long").alias("gaps"))
    names = ["conv_id", *(c.split()[0] for c in RESULT.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Open | None = None
        kinds = None
        for batch in batches:
            kinds = kinds or pa.schema([("conv_id", batch.schema.field("conv_id").type), *((n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in names[1:])])
            found = []
            for conv_id, head, role, text, gaps in zip(*(batch.column(c) for c in ("conv_id", "head", "role", "text", "gaps"))):
                if head.as_py():
                    if current:
                        found.append(current.done())
                    current = _Open(conv_id.as_py(), gaps.as_py(), role.as_py(), text.as_py())
                else:
                    current.take(role.as_py(), text.as_py())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), kinds)], names)
        if current:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(current.done(), kinds)], names)

    ordered = heads.unionByName(lines).repartition("conv_id").sortWithinPartitions("conv_id", F.col("head").desc(), "turn", "digest")
    return ordered.mapInArrow(run, f"conv_id {kind}, {RESULT}")
