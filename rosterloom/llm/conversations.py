"""Conversations put into a legal order of roles by the cheapest edits.

Rows travel without their texts until the edits are known: a code for the role, whether the row is blank or ends in the
middle of a sentence, and whether an equal row came before (found by a window over hashes, so equal rows of one long
conversation do not meet its other rows). Edits are searched by branch and bound. Then the texts follow the edits, row by
row in sorted order, into the digest of the repaired conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterloom.llm.storage import stored

_SPACES = " \t\n\x0b\x0c\r"
_KEEP, _REROLE, _DELETE, _INSERT = "K", "R", "D", "I"
_COST = {_REROLE: 2, _DELETE: 3, _INSERT: 2}
#: Where a conversation stands: nothing yet, after the system's row, after the user's, after the assistant's.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
#: What an inserted or reroled row must be, and where it leads to.
_TURN = {state: ("a" if state == _USER else "u") for state in range(4)}
_INITIAL = {_START: "", _SYSTEM: "s", _USER: "u", _ASSISTANT: "a"}
_LEGAL = {"su", "ua", "au"}
_COMPLETE = (_START, _ASSISTANT)
#: Rows searched at a time; longer conversations are put together from the solutions of their segments.
SEGMENT = 48

#: Ids and turns travel as text through Python, where numbers beside nulls would lose digits.
RESULT = (
    "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after damage by a hash of `conv_id:turn`; nulls of role and text become one space.

    Of twenty remainders, 0 drops the row, 1 empties its text, 2 removes `.`, `!` and `?`, 3 repeats it, 4 makes it the
    user's. A null conv_id or turn is a space in the hashed string.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fate = F.crc32(name.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    found = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(fate == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), F.lit(" "))).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("times"),
    )
    return found.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("col")


def _codes() -> list[Column]:
    both = F.struct("role", "text")
    return [F.xxhash64(both).alias("x"), F.xxhash64(F.lit(1), both).alias("y")]


def _order() -> list[Column]:
    """Rows of a conversation: by turn, nulls first; those of one turn by role and text, so that order is never chance."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("x"), F.col("y")]


class _Rows:
    """What the search needs to know of the rows of a conversation or of a segment."""

    def __init__(self, initials: str, faults: str) -> None:
        """`faults`: a letter for each row: b(lank), d(uplicate), t(runcated) or a space."""
        self.initials, self.faults, self.n = initials, faults, len(initials)
        #: At least this much for the rows from here on: what their faults cost, and one for each two neighbours that may
        #: not stand together (an edit of 2 or 3 mends two such pairs at most, an insertion one).
        self.rest = [0] * (self.n + 1)
        #: The initial of the first row from here on that need not be deleted.
        self.first = [""] * (self.n + 1)
        for k in range(self.n - 1, -1, -1):
            must = faults[k] in "bd"
            own = 3 if must else int(faults[k] == "t")
            after = self.first[k + 1]
            clash = 0 if must or not after else int(initials[k] + after not in _LEGAL)
            self.rest[k] = self.rest[k + 1] + own + clash
            self.first[k] = after if must else initials[k]

    def bound(self, at: int, state: int) -> int:
        """A lower bound of what the rows from `at` on cost after `state`."""
        first = self.first[at]
        return self.rest[at] + int(bool(first) and (state, first) not in _NEXT)


def search(rows: _Rows, entry: int, exits: tuple[int, ...], closing: bool) -> tuple[int, str] | None:
    """The least (cost, audit) that leads from `entry` over all rows to one of `exits`.

    Depth first, with a stack. A prefix is left if it cannot beat the incumbent, or if an earlier one reached the same
    node (place and state) with a smaller cost, or an equal one and a smaller audit. Two prefixes of equal cost at one node
    never begin with one another, as what the longer had besides would be insertions; so the smaller prefix stays smaller
    whatever follows. `closing`: whether rows may be inserted after the last one.
    """
    best: tuple[int, str] | None = None
    seen: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        least = cost + rows.bound(at, state)
        # An audit that goes on from here is not smaller than what it begins with.
        if best is not None and (least > best[0] or (least == best[0] and audit > best[1])):
            continue
        known = seen.get((at, state))
        if known is not None and known <= (cost, audit):
            continue
        seen[at, state] = (cost, audit)
        if at == rows.n and state in exits and (best is None or (cost, audit) < best):
            best = (cost, audit)
        after = []
        if at < rows.n:
            fault, initial = rows.faults[at], rows.initials[at]
            after.append((3, at + 1, state, _DELETE))
            if fault not in "bd":
                own = int(fault == "t")
                then = _NEXT.get((state, initial))
                if then is not None:
                    after.append((own, at + 1, then, _KEEP))
                after.append((2 + own, at + 1, _NEXT[state, _TURN[state]], _REROLE))
        if at < rows.n or closing:
            after.append((2, at, _NEXT[state, _TURN[state]], _INSERT))
        # What promises the least is searched first: it is pushed last.
        after.sort(key=lambda e: (e[0] + rows.bound(e[1], e[2]), e[3]), reverse=True)
        stack.extend((then_at, then, cost + own, audit + edit) for own, then_at, then, edit in after)
    return best


def cheapest_edits(initials: str, faults: str) -> tuple[int, str]:
    """Cost and audit of the cheapest edits of a conversation; ties: the least audit."""
    if len(initials) <= SEGMENT:
        return search(_Rows(initials, faults), _START, _COMPLETE, True)
    now: dict[int, tuple[int, str]] = {_START: (0, "")}
    for begin in range(0, len(initials), SEGMENT):
        rows = _Rows(initials[begin : begin + SEGMENT], faults[begin : begin + SEGMENT])
        last = begin + SEGMENT >= len(initials)
        then: dict[int, tuple[int, str]] = {}
        for exit_ in range(4):
            reached = []
            for entry, (cost, audit) in now.items():
                own = search(rows, entry, (exit_,), last)
                if own is not None:
                    reached.append((cost + own[0], audit, own[1]))
            if reached:
                least = min(r[0] for r in reached)
                then[exit_] = min((cost, audit + own) for cost, audit, own in reached if cost == least)
        now = then
    return min(now[state] for state in _COMPLETE if state in now)


def _plans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each conversation, from its rows without texts, which come sorted; a conversation may span batches."""
    columns = [c.split()[0] for c in RESULT.split(", ")]
    state: dict = {}

    def result() -> tuple:
        initials, faults = "".join(state["initials"]), "".join(state["faults"])
        pieces = state["initials"]  # an empty role has no initial, so pairs are of rows and not of letters
        illegal = sum(a + b not in _LEGAL for a, b in zip(pieces, pieces[1:], strict=False))
        if len(initials) != len(pieces):
            initials = "".join(p or " " for p in pieces)
        cost, audit = cheapest_edits(initials, faults)
        gaps = state["high"] - state["low"] + 1 - state["turns"] if state["turns"] else 0
        return (state["id"], gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit)

    for batch in batches:
        done = []
        for conv_id, turn, initial, fault in zip(*(batch[c] for c in ("conv_id", "turn", "initial", "fault")), strict=True):
            turn = None if turn is None else int(turn)
            if not state or state["id"] != conv_id:
                if state:
                    done.append(result())
                state = {"id": conv_id, "initials": [], "faults": [], "turns": 0, "low": None, "high": None}
            state["initials"].append(initial)
            state["faults"].append(fault)
            if turn is not None:
                state["low"] = turn if state["low"] is None else state["low"]
                state["turns"] += turn != state["high"]
                state["high"] = turn
        yield pd.DataFrame(done, columns=columns)
    if state:
        yield pd.DataFrame([result()], columns=columns)


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """conv_id and sha256 of each repaired conversation. Its audit comes first, then its rows with their texts."""
    conv_id, audit, at, before, digest, started = None, "", 0, "", hashlib.sha256(), False

    def put(role: str, text: str) -> None:
        nonlocal before
        digest.update(f"{before}{role}:{text}".encode())
        before = "\n"

    def inserted(state: int) -> tuple[int, int]:
        """Writes the rows inserted at this place."""
        nonlocal at
        while at < len(audit) and audit[at] == _INSERT:
            put("assistant" if _TURN[state] == "a" else "user", "")
            state, at = _NEXT[state, _TURN[state]], at + 1
        return state

    state = _START
    for batch in batches:
        done = []
        for i, plan, role, text in zip(*(batch[c] for c in ("conv_id", "audit", "role", "text")), strict=True):
            if isinstance(plan, str):  # the first row of a conversation
                if started:
                    inserted(state)
                    done.append((conv_id, digest.hexdigest()))
                conv_id, audit, at, before, digest, started = i, plan, 0, "", hashlib.sha256(), True
                state = _START
                continue
            state = inserted(state)
            edit, at = audit[at], at + 1
            if edit == _KEEP:
                put(role, text)
                state = _NEXT[state, role[:1]]
            elif edit == _REROLE:
                put("assistant" if _TURN[state] == "a" else "user", text)
                state = _NEXT[state, _TURN[state]]
        yield pd.DataFrame(done, columns=["conv_id", "repaired_sha256"])
    if started:
        inserted(state)
        yield pd.DataFrame([(conv_id, digest.hexdigest())], columns=["conv_id", "repaired_sha256"])


def _with_faults(rows: DataFrame) -> DataFrame:
    """Of `rows` (conv_id, turn, role, text, x, y): the initial of the role and the first fault; texts stay behind."""
    seen = F.row_number().over(Window.partitionBy("conv_id", "x", "y").orderBy(F.col("turn").asc_nulls_first())) > 1
    trimmed = F.btrim("text", F.lit(_SPACES))
    own = F.when(trimmed == "", "b").when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), " ").otherwise("t")
    compact = rows.select("conv_id", "turn", "role", "x", "y", F.substring("role", 1, 1).alias("initial"), own.alias("own"))
    return compact.withColumn("seen", seen).withColumn("fault", F.when((F.col("own") != "b") & F.col("seen"), "d").otherwise(F.col("own")))


def repaired(conversations: DataFrame) -> DataFrame:
    """What is wrong in each conversation of `conversations` (conv_id, turn, role, text), and its cheapest repair.

    Per conv_id, null included: gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256. Null roles and
    texts are one space. Rows of one turn go by role and then by a hash of role and text; repeated rows are rows of their
    own. Other columns are not read; an empty table gives no rows. A conversation's own work and memory are in proportion
    to its audit, which is one value of the result; texts are read in order and never held.
    """
    space = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), space).alias(c) for c in ("role", "text")],
    ).select("*", *_codes())
    plans = stored(
        _with_faults(rows).repartition("conv_id").sortWithinPartitions("conv_id", *_order(), "seen")
        .select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), "initial", "fault").mapInPandas(_plans, RESULT)
        .withColumn("conv_id", F.col("conv_id").cast("long")),
        "conversation-plans",
    )
    none = lambda kind: F.lit(None).cast(kind)
    heads = plans.select(
        "conv_id", none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"),
        none("long").alias("x"), none("long").alias("y"), "audit",
    )
    digests = (
        heads.union(rows.select("*", none("string").alias("audit"))).repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("audit").isNull(), *_order())
        .select(F.col("conv_id").cast("string"), "audit", "role", "text").mapInPandas(_digests, "conv_id string, repaired_sha256 string")
        .withColumn("conv_id", F.col("conv_id").cast("long"))
    )
    same = plans["conv_id"].eqNullSafe(digests["conv_id"])
    return plans.join(digests, same).select(*[plans[c] for c in plans.columns], "repaired_sha256")


def repaired_after_damage(conversations: DataFrame) -> DataFrame:
    """`repaired` for the rows that `damaged` leaves; conversations that lose all rows have zeros and the empty digest."""
    rows = stored(damaged(conversations), "damaged-conversations")
    found = repaired(rows)
    every = conversations.select(F.col("conv_id").cast("long").alias("every")).distinct()
    joined = every.join(found, every["every"].eqNullSafe(found["conv_id"]), "left")
    empty = hashlib.sha256(b"").hexdigest()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        F.col("every").alias("conv_id"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
