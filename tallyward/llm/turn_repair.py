"""Repair of the turn structure of conversations: least cost and least audit decided by one integer minimum.

A repair is a sequence of edits. Its weight is one big integer: the high digits are its cost, the low digits its audit,
one digit of three bits for each edit from the left, with zeros behind the end. So the least integer is the cheapest
repair and, among these, the one whose letters come first. The nodes of the graph are (row, role state, inserts so far);
their values are plain integer minima over their edges, from the last row to the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import pick, stage

# Rows of one piece of a conversation. Pieces are solved apart for every state before and after them.
PIECE = 1024

# Digits of the edits, in the order of their letters; 0 stands behind the end.
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
_LETTERS = {ord("0") + i: c for i, c in enumerate("0DIKR")}
_DIGITS = {ord(c): str(i) for i, c in enumerate("0DIKR") if i}
COSTS = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TRUNCATED = 1
MUST_DELETE = 2

# States: nothing yet, after the system turn, after a user turn, after an assistant turn; the second may not be the end.
N_STATES = 4
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
TURN = {2: "user", 3: "assistant"}
NEW_TURN = {state: NEXT.get((state, "u"), NEXT.get((state, "a"))) for state in range(N_STATES)}
MOST_INSERTS = 2  # a third one in a row would come back to a state for more cost


class Weights:
    """Integers for audits of at most ``size`` edits."""

    def __init__(self, size: int):
        self.size, self.bits = size, 3 * size
        self.low = (1 << self.bits) - 1

    def before(self, digits: int, count: int, cost: int, rest: int | None) -> int | None:
        """The weight of ``count`` edits followed by those of ``rest``."""
        if rest is None:
            return None
        moved = digits << 3 * (self.size - count) | (rest & self.low) >> 3 * count
        return ((rest >> self.bits) + cost) << self.bits | moved

    def edit(self, letter: int, rest: int | None, more: int = 0) -> int | None:
        return self.before(letter, 1, COSTS[letter] + more, rest)

    def read(self, weight: int) -> tuple[int, str]:
        digits = f"{weight & self.low:o}".zfill(self.size) if self.size else ""
        return weight >> self.bits, digits.rstrip("0").translate(_LETTERS)


def _least(*weights: int | None) -> int | None:
    known = [w for w in weights if w is not None]
    return min(known) if known else None


def _end(weights: Weights) -> list[int | None]:
    """Behind the last row: what is missing to the end of an assistant turn is inserted."""
    at_end: list[int | None] = [0, None, None, 0]
    at_end[2] = weights.edit(INSERT, at_end[3])
    at_end[1] = weights.edit(INSERT, at_end[2])
    return at_end


def _through(rows: list[tuple[str, int]], value: list[int | None], weights: Weights) -> list[int | None]:
    """Least weights from every state before the rows (initial of the role, fault); ``value``: those behind them."""
    for initial, fault in reversed(rows):
        more = int(fault == TRUNCATED)
        step: list[int | None] = []
        for state in range(N_STATES):
            ways = [weights.edit(DELETE, value[state])]
            if fault != MUST_DELETE:
                kept = NEXT.get((state, initial))
                if kept is not None:
                    ways.append(weights.edit(KEEP, value[kept], more))
                ways.append(weights.edit(REROLE, value[NEW_TURN[state]], more))
            step.append(_least(*ways))
        value = step
        for _ in range(MOST_INSERTS):
            value = [_least(step[s], weights.edit(INSERT, value[NEW_TURN[s]])) for s in range(N_STATES)]
    return value


def solve(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """Cost and audit of the best repair of a whole conversation."""
    weights = Weights((MOST_INSERTS + 1) * len(rows) + 2)
    found = _through(rows, _end(weights), weights)[0]
    return weights.read(found)


def solve_piece(rows: list[tuple[str, int]]) -> list[tuple[int, int, int, str]]:
    """(state before, state behind, cost, audit) of the best repair of part of a conversation, for all states."""
    weights = Weights((MOST_INSERTS + 1) * len(rows))
    out = []
    for behind in range(N_STATES):
        value = _through(rows, [0 if s == behind else None for s in range(N_STATES)], weights)
        out += [(before, behind, *weights.read(w)) for before, w in enumerate(value) if w is not None]
    return out


def join_pieces(pieces: list[list[tuple[int, int, int, str]]]) -> tuple[list[tuple[int, str]], str]:
    """The state before and the audit of every piece in the best repair of their whole, and the inserts at its end.

    Audits of one piece with equal states and costs never begin with one another (the longer would go on with inserts
    that come back to its state), so the best whole is made of best parts.
    """
    longest = [max(len(a) for *_, a in piece) for piece in pieces]
    weights = Weights(sum(longest) + 2)
    values = [_end(weights)]
    for piece in reversed(pieces):
        value: list[int | None] = [None] * N_STATES
        for before, behind, cost, audit in piece:
            digits = int(audit.translate(_DIGITS), 8) if audit else 0
            value[before] = _least(value[before], weights.before(digits, len(audit), cost, values[-1][behind]))
        values.append(value)
    values.reverse()
    state, chosen = 0, []
    for i, piece in enumerate(pieces):
        for before, behind, cost, audit in piece:
            digits = int(audit.translate(_DIGITS), 8) if audit else 0
            if before == state and weights.before(digits, len(audit), cost, values[i + 1][behind]) == values[i][state]:
                chosen.append((state, audit))
                state = behind
                break
    return chosen, "I" * {1: 2, 2: 1}.get(state, 0)


def apply_edits(state: int, audit: str, rows: list[tuple[str, str]]) -> list[tuple[int, str, str, str]]:
    """(number of rows taken before, edit, role, text) of every edit of an audit on rows (role, text)."""
    out, taken = [], 0
    for letter in audit:
        if letter == "I":
            state = NEW_TURN[state]
            out.append((taken, letter, TURN[state], ""))
            continue
        role, text = rows[taken]
        if letter == "K":
            state = NEXT[state, role[:1]]
        elif letter == "R":
            state = NEW_TURN[state]
            role = TURN[state]
        out.append((taken, letter, role, text))
        taken += 1
    return out


# -- on Spark -----------------------------------------------------------------------------------------------------

VISIBLE = r"[^\x20\x09-\x0D]"


def _checksum() -> Column:
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    return F.crc32(key) % 20


def damage(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copy, dropped)``: rows damaged by the checksum of their conversation and turn.

    Of twenty rows one is dropped (it stays, marked), one loses its text, one its ends of sentences, one is repeated and
    one gets the role user. A null role or text becomes one space; null ids and turns stay. Equal rows are damaged alike.
    """
    rows = pick(conversations, "conv_id", "turn", "role", "text").withColumns({
        "kind": _checksum(), "role": F.coalesce("role", F.lit(" ")), "text": F.coalesce("text", F.lit(" "))})
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(copies).alias("copy"), (kind == 0).alias("dropped"))


def in_order(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, dropped) with ``at``, which grows by conversation, turn (null first), role and
    text.

    A range partitioning by these columns, so that a conversation of any size spreads over tasks; the last key, a row
    number, spreads equal rows as well. ``at`` is the partition and the row's number inside it.
    """
    keys = ["conv_id", "turn", "role", "text", "__row"]
    keyed = rows.withColumn("__row", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stage(ordered.select("conv_id", "turn", "role", "text", "dropped",
                                F.monotonically_increasing_id().alias("at")), "repair-rows")


_RUN = ("conv_id long, at long, whole boolean, blank long, duplicate long, truncated long, illegal long, "
        "first_turn long, last_turn long, n_turns long, first_role string, last_role string, n_rows long, "
        "before array<int>, behind array<int>, costs array<long>, audits array<string>")
_LEGAL = {"su", "ua", "au"}


def _batch(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "int": pa.int32(),
             "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()),
             "array<string>": pa.list_(pa.string())}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.table({n: pa.array(c, kinds[t]) for c, (n, t) in zip(columns, fields, strict=True)})


def _runs(table: pa.Table) -> Iterator[tuple[int, int]]:
    """Begin and end of the rows of each conversation in a piece; the table is in order."""
    ids = table.column("conv_id").to_pylist()
    cut = [i for i in range(len(ids)) if not i or ids[i] != ids[i - 1]] + [len(ids)]
    yield from zip(cut[:-1], cut[1:], strict=True)


def _plan(table: pa.Table) -> pa.Table:
    """Of one piece of the ordered rows: per conversation its counts and best repairs.

    The first and the last conversation of a piece may go on in other pieces; they are solved for all states.
    """
    table = table.sort_by("at")
    columns = {c: table.column(c).to_pylist() for c in ("conv_id", "at", "turn", "initial", "fault", "dropped")}
    out = []
    for begin, end in _runs(table):
        here = [i for i in range(begin, end) if not columns["dropped"][i]]
        roles = [columns["initial"][i] for i in here]
        faults = [columns["fault"][i] for i in here]
        turns = [t for i in here if (t := columns["turn"][i]) is not None]
        rows = [(r, MUST_DELETE if f in ("blank", "duplicate") else int(f == "truncated"))
                for r, f in zip(roles, faults, strict=True)]
        whole = 0 < begin and end < table.num_rows
        found = [(0, 0, *solve(rows))] if whole else solve_piece(rows)
        out.append((
            columns["conv_id"][begin], columns["at"][begin], whole,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in _LEGAL for a, b in zip(roles[:-1], roles[1:], strict=True)),
            turns[0] if turns else None, turns[-1] if turns else None,
            len(set(turns)), roles[0] if roles else None, roles[-1] if roles else None, len(rows),
            *map(list, zip(*found, strict=True))))
    return _batch(out, _RUN)


_CHOICE = ("conv_id long, at long, state int, audit string, blank long, duplicate long, truncated long, illegal long, "
           "gaps long, cost long")


def _gaps(first: int | None, last: int | None, distinct: int) -> int:
    return 0 if first is None else last - first + 1 - distinct


def _join(table: pa.Table) -> pa.Table:
    """The runs of one conversation that lies in several pieces; each run's choice, the conversation's numbers once."""
    runs = table.sort_by("at").to_pylist()
    chosen, tail = join_pieces([list(zip(r["before"], r["behind"], r["costs"], r["audits"], strict=True)) for r in runs])
    illegal, distinct, first, last, role = 0, 0, None, None, None
    for r in runs:
        illegal += r["illegal"] + (None not in (role, r["first_role"]) and role + r["first_role"] not in _LEGAL)
        role = r["last_role"] if r["last_role"] is not None else role
        if r["first_turn"] is not None:
            distinct += r["n_turns"] - (last == r["first_turn"])
            first, last = r["first_turn"] if first is None else first, r["last_turn"]
    cost = 0
    for r, (state, audit) in zip(runs, chosen, strict=True):
        cost += min(c for b, c, a in zip(r["before"], r["costs"], r["audits"], strict=True) if (b, a) == (state, audit))
    out = []
    for i, (r, (state, audit)) in enumerate(zip(runs, chosen, strict=True)):
        once = (illegal, _gaps(first, last, distinct), cost + COSTS[INSERT] * len(tail)) if not i else (0, 0, 0)
        end = tail if i == len(runs) - 1 else ""
        out.append((r["conv_id"], r["at"], state, audit + end, r["blank"], r["duplicate"], r["truncated"], *once))
    return _batch(out, _CHOICE)


_EDIT = "conv_id long, at long, number long, edit string, role string, text string"


def _applied(rows: pa.Table, choices: pa.Table) -> pa.Table:
    """The edits of one piece, in order: ``at`` of the row that an edit takes or stands before, and a number."""
    rows = rows.sort_by("at")
    chosen = {r["at"]: r for r in choices.select(["at", "state", "audit"]).to_pylist()}
    at, dropped = rows.column("at").to_pylist(), rows.column("dropped").to_pylist()
    roles, texts = rows.column("role").to_pylist(), rows.column("text").to_pylist()
    ids = rows.column("conv_id").to_pylist()
    out = []
    for begin, end in _runs(rows):
        one = chosen.get(at[begin])
        if one is None:
            continue
        here = [i for i in range(begin, end) if not dropped[i]]
        edits = apply_edits(one["state"], one["audit"], [(roles[i], texts[i]) for i in here])
        out += [(ids[begin], at[here[taken]] if taken < len(here) else at[end - 1], n, edit, role, text)
                for n, (taken, edit, role, text) in enumerate(edits)]
    return _batch(out, _EDIT)


def repair(damaged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edits and choices for rows (conv_id, turn, role, text, dropped).

    The edits are ``(conv_id, at, number, edit, role, text)``, one row per edit (K keep, R new role, D delete, I insert),
    deleted rows included, in order of ``at`` and ``number`` within a conversation. The choices are
    ``(conv_id, at, state, audit, blank, duplicate, truncated, illegal, gaps, cost)``, one row or more per conversation,
    also for those whose rows are all dropped: audits join in order of ``at``, numbers add up.

    Rows are taken by turn (null first), then role and text. A row's first fault counts: blank without a visible
    character, duplicate if its role and text stand in an earlier row, truncated if its last visible character ends no
    sentence. A row whose role is empty or begins with another letter cannot be kept as it is. Null conversation ids are one
    conversation. An empty table has no result.

    Rows are ordered by range partitioning and numbered; pieces of ``PIECE`` rows, which hold many small conversations
    or a part of a large one, are solved apart, and only the numbers of conversations that cross pieces meet. First
    occurrences are a minimum with partial aggregation, so equal rows do not gather. The audit of a conversation is one
    value, and so are the strings that its parts offer.
    """
    rows = in_order(damaged)
    words = F.regexp_extract("text", rf"({VISIBLE})[\x20\x09-\x0D]*\z", 1)
    first = rows.where("NOT dropped").groupBy("conv_id", "role", F.sha2("text", 256).alias("digest")).agg(
        F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    fault = F.when(F.length("last") == 0, "blank").when(F.col("first").isNull(), "duplicate").when(
        ~F.col("last").isin(".", "!", "?"), "truncated")
    marked = rows.select("conv_id", "at", "turn", "dropped", F.substring("role", 1, 1).alias("initial"), words.alias("last"))
    marked = marked.join(first, "at", "left").select(
        "conv_id", "at", "turn", "dropped", "initial", fault.alias("fault"), _piece().alias("piece"))
    runs = stage(marked.groupBy("piece").applyInArrow(_plan, _RUN), "repair-runs")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0))
    whole = runs.where("whole").select(
        "conv_id", "at", F.lit(0).alias("state"), F.col("audits")[0].alias("audit"), "blank", "duplicate", "truncated",
        "illegal", gaps.alias("gaps"), F.col("costs")[0].alias("cost"))
    joined = runs.where("NOT whole").groupBy("conv_id").applyInArrow(_join, _CHOICE)
    choices = stage(whole.unionByName(joined), "repair-choices")
    edits = rows.withColumn("piece", _piece()).groupBy("piece").cogroup(
        choices.withColumn("piece", _piece()).groupBy("piece")).applyInArrow(_applied, _EDIT)
    return edits, choices


def _piece() -> Column:
    return F.shiftright("at", PIECE.bit_length() - 1)


def repair_report(conversations: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of every conversation
    after ``damage`` and ``repair``.

    ``gaps`` counts the turns missing between a conversation's first and last, ``illegal`` the neighbours whose roles do
    not follow each other. The digest is that of the repaired ``role:text`` lines; a conversation that lost all rows has
    zeros, an empty audit and the digest of an empty text. Edits and choices meet in one aggregation, where a
    conversation's lines become one value.
    """
    rows = damage(conversations)
    rows = rows.withColumn("conv_id", F.col("conv_id").cast("long")).withColumn("turn", F.col("turn").cast("long"))
    edits, choices = repair(rows.drop("copy"))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    none = F.lit(None)
    lines = edits.select(
        "conv_id", F.when(F.col("edit") != "D", F.struct("at", "number", F.concat("role", F.lit(":"), "text").alias("line")))
        .alias("line"), none.cast("struct<at: bigint, audit: string>").alias("part"),
        *[F.lit(0).cast("long").alias(c) for c in numbers])
    parts = choices.select(
        "conv_id", none.cast(lines.schema["line"].dataType).alias("line"), F.struct("at", "audit").alias("part"), *numbers)
    found = lines.unionByName(parts).groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in numbers], F.sort_array(F.collect_list("part")).alias("parts"),
        F.sort_array(F.collect_list("line")).alias("lines"))
    return found.select(
        "conv_id", *numbers, F.array_join("parts.audit", "").alias("audit"),
        F.sha2(F.array_join("lines.line", "\n"), 256).alias("repaired_sha256"))
