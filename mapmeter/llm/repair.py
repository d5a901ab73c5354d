"""Conversation structure repair by a generalised LR parse that may edit.

A conversation's roles must follow a small grammar. Its parser keeps all stacks that any edits so far can lead to, as
a graph: a stack is a state on top of a shared stack. Reading a row, each stack may keep it, take it in another role
or delete it, and may have rows inserted before and after; stacks that have become equal are merged into the one with
the smallest (cost, audit), the audit being the edits' initials. A stack that even the dearest way back to a common
one could not make up for is given up.

Rows are sorted over the whole table by conversation and turn, so a long conversation lies in several partitions. What
a task sees of a conversation that may go on elsewhere it parses from every stack; the stretches are then put together
in order, from tables of stack to stack.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapmeter.llm.common import settle

# --- fixed values, given by the result contract: (s?(ua)+)? as a grammar, and what edits cost. Talks with and without
# a system row come to the same stack after their first pair.
GRAMMAR = (
    ("talk", ()), ("talk", ("turns",)), ("turns", ("first",)), ("turns", ("turns", "pair")),
    ("first", ("u", "a")), ("first", ("s", "u", "a")), ("pair", ("u", "a")),
)
NEW_ROLES = {"u": "user", "a": "assistant"}  # what rows can be taken as or inserted
RETAKE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
FOLLOWS = {"su", "ua", "au"}
SPACE = " \t\n\v\f\r"
ENDS = (".", "!", "?")
NONE, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3

SEGMENT = 8_192  # rows of a conversation parsed at a time; bounds what audits that never meet cost
SALTS = 8  # parts that a text repeated within a conversation is dealt to
FLUSH = 256  # letters after which what all audits begin with is put aside

Tops = dict[int, tuple[int, str]]  # stack -> (cost, audit)


# --- the automaton ----------------------------------------------------------------------------


class Automaton:
    """LR tables of a grammar and the stacks that its sentences' beginnings lead to.

    A stack is a number: ``stacks[i]`` is its top state and the number of the stack below. ``after[i][symbol]`` lists
    the stacks that ``i`` becomes when the symbol is read, reductions done; ``accepting[i]`` tells whether what was
    read may be all. Grammars whose stacks have no bound (nested ones) are refused.
    """

    def __init__(self, productions=GRAMMAR, most: int = 64):
        start = productions[0][0]
        rules = [("", (start,)), *productions]
        heads = {head for head, _ in rules}
        symbols = sorted({s for _, body in rules for s in body})

        def closure(items: set[tuple[int, int]]) -> frozenset:
            found, todo = set(items), list(items)
            while todo:
                rule, dot = todo.pop()
                body = rules[rule][1]
                if dot < len(body) and body[dot] in heads:
                    new = {(i, 0) for i, (head, _) in enumerate(rules) if head == body[dot]} - found
                    found |= new
                    todo += new
            return frozenset(found)

        states, goto = [closure({(0, 0)})], {}
        for state in states:  # grows while it is read
            for symbol in symbols:
                moved = {(r, d + 1) for r, d in state if d < len(rules[r][1]) and rules[r][1][d] == symbol}
                if moved:
                    target = closure(moved)
                    if target not in states:
                        states.append(target)
                    goto[state, symbol] = target
        self.stacks: list[tuple[int, int]] = [(0, -1)]
        self.after: list[dict[str, tuple[int, ...]]] = []
        numbers = {(0, -1): 0}

        def push(below: int, state: frozenset) -> int:
            top = (states.index(state), below)
            if top not in numbers:
                numbers[top] = len(self.stacks)
                self.stacks.append(top)
            return numbers[top]

        def reduced(stack: int, at_end: bool) -> list[int]:
            """What a stack reduces to: at once where its state can do nothing else, at the end in every way."""
            state = states[self.stacks[stack][0]]
            complete = [r for r, d in state if d == len(rules[r][1]) and r]
            if not complete or not (at_end or len(state) == 1):
                return [stack]
            out = [stack] if at_end else []
            for rule in complete:
                head, body = rules[rule]
                below = stack
                for _ in body:
                    below = self.stacks[below][1]
                out += reduced(push(below, goto[states[self.stacks[below][0]], head]), at_end)
            return out

        terminals = [s for s in symbols if s not in heads]
        for stack, (state, _) in enumerate(self.stacks):  # grows while it is read
            if len(self.stacks) > most:
                raise ValueError("the grammar nests: its stacks have no bound")
            known = states[state]
            self.after.append({s: tuple(reduced(push(stack, goto[known, s]), False)) for s in terminals if (known, s) in goto})
        live = len(self.stacks)
        final = goto[states[0], start]
        self.accepting = [any(self.stacks[end] == (states.index(final), 0) for end in reduced(i, True)) for i in range(live)]
        # stacks that were shifted to but reduced at once are no stop of their own
        self.stops = sorted({0} | {t for moves in self.after for to in moves.values() for t in to})


AUTOMATON = Automaton()
# From any stack, two inserts at most lead to one after whole pairs, which can end as any other stack can, but for a
# leading system row, which can be deleted. Costs further above the least can't be made up for.
WORTH = 2 * INSERT + DELETE


def _add(tops: Tops, stack: int, cost: int, audit: str) -> bool:
    held = tops.get(stack)
    if held is None or (cost, audit) < held:
        tops[stack] = (cost, audit)
        return True
    return False


def _inserted(tops: Tops, automaton: Automaton) -> Tops:
    """With rows inserted as long as that reaches a stack at a smaller (cost, audit); hopeless stacks are left out."""
    most = min(cost for cost, _ in tops.values()) + WORTH
    tops = {stack: top for stack, top in tops.items() if top[0] <= most}
    todo = sorted(tops, key=tops.__getitem__)
    while todo:
        stack = todo.pop(0)
        cost, audit = tops[stack]
        if cost + INSERT <= most:
            moves = automaton.after[stack]
            for symbol in NEW_ROLES:
                for to in moves.get(symbol, ()):
                    if _add(tops, to, cost + INSERT, audit + "I"):
                        todo.append(to)
    return tops


def _read(tops: Tops, symbol: str, fault: int, automaton: Automaton) -> Tops:
    out: Tops = {}
    for stack, (cost, audit) in tops.items():
        _add(out, stack, cost + DELETE, audit + "D")
        if fault != BLANK and fault != DUPLICATE:
            moves = automaton.after[stack]
            undeleted = cost + CUT_SHORT if fault == TRUNCATED else cost
            for to in moves.get(symbol, ()):
                _add(out, to, undeleted, audit + "K")
            for role in NEW_ROLES:
                for to in moves.get(role, ()):
                    _add(out, to, undeleted + RETAKE, audit + "R")
    return _inserted(out, automaton)


def _put_aside(tops: Tops, aside: list[str]) -> Tops:
    """Moves the beginning that all audits share to ``aside``, so that steps don't copy it."""
    shared = os.path.commonprefix([audit for _, audit in tops.values()])
    if not shared:
        return tops
    aside.append(shared)
    return {stack: (cost, audit[len(shared) :]) for stack, (cost, audit) in tops.items()}


def parse(rows, entry: int = 0, automaton: Automaton = AUTOMATON) -> Tops:
    """The cheapest edits of ``rows``, pairs of a role's initial and a fault, from ``entry`` to each stack."""
    aside: list[str] = []
    tops = _inserted({entry: (0, "")}, automaton)
    for n, (symbol, fault) in enumerate(rows, 1):
        tops = _read(tops, symbol, fault, automaton)
        if not n % FLUSH:
            tops = _put_aside(tops, aside)
    begin = "".join(aside)
    return {stack: (cost, begin + audit) for stack, (cost, audit) in tops.items()}


def _finish(tops: Tops, automaton: Automaton = AUTOMATON) -> tuple[int, str]:
    return min(top for stack, top in tops.items() if automaton.accepting[stack])


# --- what a stretch of a conversation tells ---------------------------------------------------

_COUNTS = ("blank", "duplicate", "truncated", "illegal", "n_turns")
_TOLD = "blank long, duplicate long, truncated long, illegal long, n_turns long, first_turn long, last_turn long, first_role string, last_role string"


def _told(initials: list[str], faults: list[int], turns: list[int | None]) -> dict:
    known = [t for t in turns if t is not None]
    return {
        **{name: faults.count(f) for name, f in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))},
        "illegal": sum(a + b not in FOLLOWS for a, b in zip(initials, initials[1:])),
        "n_turns": len(set(known)),
        "first_turn": known[0] if known else None, "last_turn": known[-1] if known else None,
        "first_role": initials[0], "last_role": initials[-1],
    }


def _joined(a: dict, b: dict) -> dict:
    """Of two stretches that follow each other."""
    out = {name: a[name] + b[name] for name in _COUNTS}
    out["illegal"] += a["last_role"] + b["first_role"] not in FOLLOWS
    out["n_turns"] -= a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
    out |= {"first_role": a["first_role"], "last_role": b["last_role"]}
    out["first_turn"] = a["first_turn"] if a["first_turn"] is not None else b["first_turn"]
    out["last_turn"] = b["last_turn"] if b["last_turn"] is not None else a["last_turn"]
    return out


def _gaps(told: dict) -> int:
    return 0 if told["first_turn"] is None else told["last_turn"] - told["first_turn"] + 1 - told["n_turns"]


# --- tasks ------------------------------------------------------------------------------------

_WAYS = "array<struct<entry: int, exit: int, cost: long, audit: string>>"
_SEGMENT = f"part int, seg int, whole boolean, places array<long>, told struct<{', '.join(f.replace(' ', ': ') for f in _TOLD.split(', '))}>, ways {_WAYS}"
_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Output:
    """Rows gathered to Arrow batches of a schema."""

    def __init__(self, schema: pa.Schema, size: int = 1_000_000):
        self.schema, self.size, self.rows, self.held = schema, size, [], 0

    def add(self, row: dict, weight: int) -> bool:
        self.rows.append(row)
        self.held += weight + 64
        return self.held >= self.size

    def take(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pylist(self.rows, schema=self.schema)
        self.rows, self.held = [], 0
        return batch


def _arrow(schema: str, spark_type) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    parsed = _parse_datatype_string(schema)
    return to_arrow_schema(StructType(parsed.fields if spark_type is None else StructType().add("conv", spark_type).fields + parsed.fields))


def _parse_partition(schema: pa.Schema) -> Callable:
    """Sorted rows of a partition to segments: a conversation that lies in it as a whole is settled at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out = _Output(schema)
        nothing = object()
        conv, held, seg, first = nothing, ([], [], [], []), 0, True

        def segment(whole: bool) -> bool:
            turns, initials, faults, places = held
            rows = list(zip(initials, faults, strict=True))
            if whole:
                cost, audit = _finish(parse(rows))
                ways = [{"entry": 0, "exit": 0, "cost": cost, "audit": audit}]
            else:
                ways = [{"entry": e, "exit": x, "cost": c, "audit": a} for e in AUTOMATON.stops for x, (c, a) in parse(rows, e).items()]
            row = {"conv": conv, "part": part, "seg": seg, "whole": whole, "places": list(places), "told": _told(initials, faults, turns), "ways": ways}
            for column in held:
                column.clear()
            return out.add(row, (9 + sum(len(w["audit"]) for w in ways)) * 2)

        for batch in batches:
            data = batch.to_pydict()
            for c, turn, initial, fault, place in zip(data["conv"], data["turn"], data["initial"], data["fault"], data["place"], strict=True):
                if c != conv and conv is not nothing:
                    if segment(whole=not first and seg == 0):
                        yield out.take()
                    conv, seg, first = c, 0, False
                elif len(held[0]) >= SEGMENT:
                    if segment(whole=False):
                        yield out.take()
                    seg += 1
                conv = c
                for column, value in zip(held, (turn, initial, fault, place), strict=True):
                    column.append(value)
        if held[0]:
            segment(whole=False)
        if out.rows:
            yield out.take()

    return run


def _pieces(audit: str, rows: list[int]) -> list[str]:
    """An audit cut behind each of so many rows; what is inserted at its end belongs to the last."""
    pieces, at = [], 0
    for n in rows:
        end = at
        while n:
            n -= audit[end] != "I"
            end += 1
        pieces.append(audit[at:end])
        at = end
    pieces[-1] += audit[at:]
    return pieces


def _fold_partition(schema: pa.Schema) -> Callable:
    """Segments of a partition in order, those of a conversation together, to its result and each segment's edits.

    Held are the audits of a conversation (a letter for each of its rows), not its rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Output(schema)
        nothing = object()
        conv, told, tops, aside, sizes = nothing, None, {}, [], []

        def finish() -> Iterator[pa.RecordBatch]:
            cost, rest = _finish(tops)
            audit = "".join(aside) + rest
            total, at = sum(c != "D" for c in audit), 0
            for (part, seg, n), piece in zip(sizes, _pieces(audit, [n for _, _, n in sizes]), strict=True):
                full = out.add({"conv": conv, "part": part, "seg": seg, "piece": piece, "at": at, "total": total, "result": None}, len(piece))
                at += sum(c != "D" for c in piece)
                if full:
                    yield out.take()
            counts = {name: told[name] for name in ("blank", "duplicate", "truncated", "illegal")}
            if out.add({"conv": conv, "result": {"gaps": _gaps(told), **counts, "cost": cost, "audit": audit}}, len(audit)):
                yield out.take()

        for batch in batches:
            for row in batch.to_pylist():
                if row["conv"] != conv or conv is nothing:
                    if conv is not nothing:
                        yield from finish()
                    conv, told, tops, aside, sizes = row["conv"], row["told"], {0: (0, "")}, [], []
                else:
                    told = _joined(told, row["told"])
                sizes.append((row["part"], row["seg"], row["rows"]))
                reached: dict[int, list[tuple[int, str, str]]] = {}
                for way in row["ways"]:
                    if way["entry"] in tops:
                        cost, audit = tops[way["entry"]]
                        reached.setdefault(way["exit"], []).append((cost + way["cost"], audit, way["audit"]))
                least = {stack: min(ways)[0] for stack, ways in reached.items()}
                tops = {stack: (least[stack], min(a + b for cost, a, b in ways if cost == least[stack])) for stack, ways in reached.items()}
                tops = _put_aside(tops, aside)
        if conv is not nothing:
            yield from finish()
        if out.rows:
            yield out.take()

    return run


def _edits_of(schema: pa.Schema) -> Callable:
    """Segments with their edits to a row for each edit: its number among the rows that come out, the input row's place
    (null: inserted), its initial, and the role given to it (null: its own)."""
    initials = list(NEW_ROLES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Output(schema)
        for batch in batches:
            for row in batch.to_pylist():
                places = iter(row["places"])
                no, odd = row["at"], row["total"] % 2  # an odd number of rows begins with a system row
                for edit in row["piece"]:
                    role = NEW_ROLES[initials[(no - odd) % 2]] if edit in "RI" else None
                    full = out.add({"conv": row["conv"], "no": no if edit != "D" else None, "place": None if edit == "I" else next(places), "edit": edit, "role": role}, 0)
                    no += edit != "D"
                    if full:
                        yield out.take()
        if out.rows:
            yield out.take()

    return run


# --- over tables ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Repair:
    """``results``: a row per conversation with its faults, cost and audit. ``edits``: a row per edit. ``repaired``:
    the rows that come out, ``conv, no`` (from 0), ``role, text, edit``."""

    results: DataFrame
    edits: DataFrame
    repaired: DataFrame


def faults(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, text, place`` to narrow rows with the initial of the role and the first fault.

    A text's repeats are found by its digest: of each that is seen more than once in a conversation and role the first
    is looked up, the rows dealt to ``SALTS`` parts, so that no text's copies meet in one task.
    """
    last = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    narrow = rows.select(
        "conv", "turn", "role", F.substring("text", 1, 64).alias("begin"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), "place",
        (last == "").alias("blank"), (~last.isin(*ENDS)).alias("truncated"),
    )
    same = ["conv", "role", "digest"]
    firsts = (
        narrow.where("NOT blank").groupBy(*same).agg(F.min(F.struct("turn", "place")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select(*same, "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")).alias("f")
    )
    dealt = narrow.withColumn("salt", F.pmod(F.xxhash64("place"), F.lit(SALTS)).cast("int")).alias("n")
    matched = dealt.join(firsts, [F.col("n.conv").eqNullSafe(F.col("f.conv")), *[F.col(f"n.{c}") == F.col(f"f.{c}") for c in ("role", "digest", "salt")]], "left")
    again = F.coalesce(F.struct("n.turn", "n.place") > F.col("f.first"), F.lit(False))
    fault = F.when(F.col("blank"), BLANK).when(again, DUPLICATE).when(F.col("truncated"), TRUNCATED).otherwise(NONE)
    return matched.select("n.conv", "n.turn", "n.role", "n.begin", "n.digest", "n.place", F.substring("n.role", 1, 1).alias("initial"), fault.alias("fault"))


def repair(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> Repair:
    """Repairs each conversation with the cheapest edits, of equally cheap ones those with the least audit.

    Rows are taken by turn, nulls first; those of one turn by role and text. A row's first fault counts: ``blank`` (no
    character but white space), ``duplicate`` (role and text seen earlier), ``truncated`` (ends in none of ``.!?``).
    Blank and duplicate rows must be deleted; a truncated one that is not costs 1. Null roles and texts count as one
    space. Rows without conversation are one conversation, the null one. Turns are read as long. Repeated rows are
    duplicates; roles that begin with another letter than the grammar's (empty ones too) must be taken as another or
    deleted. Empty tables give no rows; other columns are left out.

    ``gaps`` is the number of turns missing between the first and the last; ``illegal`` that of neighbours whose
    initials may not follow each other. Both, and the faults, are those of the rows as they came.
    """
    space = F.lit(" ")
    came = settle(
        rows.select(
            F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
            F.coalesce(F.col(f"`{role}`"), space).alias("role"), F.coalesce(F.col(f"`{text}`"), space).alias("text"),
        ).withColumn("place", F.monotonically_increasing_id()),
        "turns",
    )
    kind = came.schema["conv"].dataType
    order = ["conv", "turn", "role", "begin", "digest", "place"]
    ordered = faults(came).repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "initial", "fault", "place")
    named = f"conv {kind.simpleString()}, "
    segments = settle(ordered.mapInArrow(_parse_partition(_arrow(_SEGMENT, kind)), named + _SEGMENT), "segments")

    # conversations that may lie in several partitions: two to a partition, at most, and those of many rows
    folded = f"part int, seg int, piece string, at long, total long, result struct<{', '.join(f.replace(' ', ': ') for f in _RESULT.split(', '))}>"
    pieces = (
        segments.where("NOT whole").select("conv", "part", "seg", F.size("places").alias("rows"), "told", "ways")
        .repartition("conv").sortWithinPartitions("conv", "part", "seg").mapInArrow(_fold_partition(_arrow(folded, kind)), named + folded)
    )
    pieces = settle(pieces, "pieces")

    whole = segments.where("whole").withColumn("way", F.col("ways")[0])
    told = F.col("told")
    gaps = F.coalesce(told["last_turn"] - told["first_turn"] + 1 - told["n_turns"], F.lit(0).cast("long"))
    results = whole.select("conv", gaps.alias("gaps"), *[f"told.{c}" for c in ("blank", "duplicate", "truncated", "illegal")], "way.cost", "way.audit")
    results = results.unionByName(pieces.where("result IS NOT NULL").select("conv", "result.*"))

    comes_out = F.length(F.regexp_replace("way.audit", "D", "")).cast("long")
    settled = whole.select("conv", "places", F.col("way.audit").alias("piece"), F.lit(0).cast("long").alias("at"), comes_out.alias("total"))
    parted = segments.where("NOT whole").select("conv", "part", "seg", "places").alias("s").join(
        pieces.where("piece IS NOT NULL").alias("p"), [F.col("s.part") == F.col("p.part"), F.col("s.seg") == F.col("p.seg"), F.col("s.conv").eqNullSafe(F.col("p.conv"))]
    )
    settled = settled.unionByName(parted.select("s.conv", "s.places", "p.piece", "p.at", "p.total"))
    edited = "no long, place long, edit string, role string"
    edits = settle(settled.mapInArrow(_edits_of(_arrow(edited, kind)), named + edited), "edits")

    # back to the texts by the rows' places: unique, so no key is hot
    stay = edits.where("no IS NOT NULL AND place IS NOT NULL").alias("e").join(came.alias("c"), "place")
    repaired = stay.select("e.conv", "e.no", F.coalesce("e.role", "c.role").alias("role"), "c.text", "e.edit")
    inserted = edits.where("place IS NULL").select("conv", "no", "role", F.lit("").alias("text"), "edit")
    return Repair(results, edits, repaired.unionByName(inserted))


def digests(repaired: DataFrame) -> DataFrame:
    """``conv, sha256`` of a conversation's ``role:text``, joined by line ends.

    Rows stream through their conversation's task in order; a digest can't be taken in parts, so a conversation goes
    through one task, of which one batch of rows is held.
    """
    kind = repaired.schema["conv"].dataType
    schema = _arrow("sha256 string", kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Output(schema)
        nothing = object()
        conv, sha = nothing, None
        for batch in batches:
            data = batch.to_pydict()
            for c, role, text in zip(data["conv"], data["role"], data["text"], strict=True):
                if c != conv or conv is nothing:
                    if conv is not nothing and out.add({"conv": conv, "sha256": sha.hexdigest()}, 64):
                        yield out.take()
                    conv, sha = c, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        if conv is not nothing:
            out.add({"conv": conv, "sha256": sha.hexdigest()}, 64)
        if out.rows:
            yield out.take()

    rows = repaired.repartition("conv").sortWithinPartitions("conv", "no").select("conv", "role", "text")
    return rows.mapInArrow(run, f"conv {kind.simpleString()}, sha256 string")


def damage(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Breaks conversations by the CRC-32 of ``conv:turn`` modulo 20, to have something to repair: 0 drops a row, 1
    empties its text, 2 takes its full stops, exclamation and question marks, 3 repeats it, 4 makes it a user's.

    Nulls in the four columns count as one space (a null conversation stays null). Other columns are left out.
    """
    space = F.lit(" ")
    c, t = (F.col(f"`{n}`") for n in (conv, turn))
    role_, text_ = (F.coalesce(F.col(f"`{n}`"), space) for n in (role, text))
    key = F.concat(F.coalesce(c.cast("string"), space), F.lit(":"), F.coalesce(t.cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    broken = rows.select(
        c.alias(conv), t.alias(turn), F.when(kind == 4, F.lit("user")).otherwise(role_).alias(role),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text_, ".!?", "")).otherwise(text_).alias(text), kind.alias("_kind"),
    )
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return broken.where("_kind <> 0").withColumn("_copy", F.explode(copies)).drop("_kind", "_copy")


def originals(rows: DataFrame, conv: str) -> DataFrame:
    """Each conversation once, the null one too."""
    return rows.select(F.col(f"`{conv}`").alias("conv")).distinct()


def with_every(found: Repair, ids: DataFrame) -> DataFrame:
    """``results`` and the digests, with zeros, an empty audit and the digest of nothing for ``ids`` without rows."""
    zero, nothing = F.lit(0).cast("long"), F.sha2(F.lit("").cast("binary"), 256)
    blank: dict[str, Column] = {c: F.lit(None).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    text = F.lit(None).cast("string")
    parts = found.results.withColumn("sha256", text)
    parts = parts.unionByName(ids.select("conv", *[v.alias(n) for n, v in blank.items()], text.alias("audit"), text.alias("sha256")))
    parts = parts.unionByName(digests(found.repaired).select("conv", *[v.alias(n) for n, v in blank.items()], text.alias("audit"), "sha256"))
    each = parts.groupBy("conv").agg(*[F.coalesce(F.max(c), zero).alias(c) for c in blank], F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("sha256"), nothing).alias("sha256"))
    return each
