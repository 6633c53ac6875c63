"""Conversations as one training text with a loss mask, checked by parsing them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import pick

START, END = "<|im_start|>", "<|im_end|>"
CLOSE = END + "\n"


def _guard(text):
    """One more backslash between < and |: no control string is left, and taking it away again is exact."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def _unguard(text):
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_text(text):
    return _guard(text)


def escape_role(role):
    """A role ends at its line end, so line ends (and the percent sign that marks them) are escaped as well."""
    return _guard(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role):
    return F.replace(F.replace(_unguard(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def render_turn(role, text):
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(CLOSE))


def parse(formatted):
    """Turns of a formatted text as ``array<struct<role, text, raw>>``; null where the grammar is broken.

    Grammar: (START role LF text END LF)*, without a control string inside role or text. ``raw`` is the text as it
    stands, still escaped.
    """
    pieces = F.split(formatted, r"<\|im_start\|>", -1)
    turns = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    ends_once = F.forall(turns, lambda p: (F.instr(p, END) == F.length(p) - len(CLOSE) + 1) & p.endswith(CLOSE)
                         & F.contains(F.substring_index(p, END, 1), F.lit("\n")))

    def turn(piece):
        body = F.left(piece, F.length(piece) - len(CLOSE))
        role = F.substring_index(body, "\n", 1)
        raw = F.substring(body, F.length(role) + 2, F.length(body))
        return F.struct(unescape_role(role).alias("role"), _unguard(raw).alias("text"), raw.alias("raw"))

    return F.when((F.element_at(pieces, 1) == "") & ends_once, F.transform(turns, turn))


def format_chats(rows: DataFrame) -> DataFrame:
    """``(conv_id, formatted, n_turns, loss_runs, round_trip)``, one row per conversation.

    Rows are ordered by turn, then role, then text (a null turn first); repeated rows stay. A null role or text is
    empty, a null conv_id is a conversation of its own, an empty table has no result. A turn is written as it is if
    parsing its text gives it back, else with its content escaped; ``round_trip`` says that the parsed conversation
    equals its source. ``loss_runs`` is the loss mask as pairs (characters without loss, characters with loss), one
    per turn: only the text of 'assistant' turns has loss.

    A conversation is one training text, so it has to fit into one value (below 2 GB).
    """
    empty = F.lit("")
    turns = pick(rows, "conv_id", "turn", "role", "text").withColumns({
        "role": F.coalesce("role", empty), "text": F.coalesce("text", empty)})
    plain = parse(render_turn(F.col("role"), F.col("text")))
    same = F.coalesce((F.size(plain) == 1) & (plain[0]["role"] == F.col("role")) & (plain[0]["text"] == F.col("text")),
                      F.lit(False))
    one = F.struct("turn", "role", "text", same.alias("plain"))
    talks = turns.select("conv_id", one.alias("one")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("one")).alias("turns"))

    def written(t):
        return F.struct(
            F.when(t["plain"], t["role"]).otherwise(escape_role(t["role"])).alias("role"),
            F.when(t["plain"], t["text"]).otherwise(escape_text(t["text"])).alias("text"),
            (t["role"] == "assistant").alias("loss"))

    out = talks.withColumn("out", F.transform("turns", written)).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), "turns", "out",
        F.array_join(F.transform("out", lambda t: render_turn(t["role"], t["text"])), "").alias("formatted"))
    fixed = len(START) + 1

    def run(t):
        size = F.length(t["text"])
        return F.struct(
            (F.length(t["role"]) + fixed + F.when(t["loss"], 0).otherwise(size + len(CLOSE))).alias("without"),
            F.when(t["loss"], size).otherwise(0).alias("within"),
            F.when(t["loss"], len(CLOSE)).otherwise(0).alias("after"))

    recovered = F.transform(parse(F.col("formatted")), lambda t: F.struct(t["role"], t["text"]))
    source = F.transform("turns", lambda t: F.struct(t["role"], t["text"]))
    return out.select("conv_id", "formatted", "n_turns", F.transform("out", run).alias("loss_runs"),
                      F.coalesce(recovered == source, F.lit(False)).alias("round_trip"))


def under_mask(formatted: str, runs: str):
    """The stretches of a formatted text that a loss mask covers, each as it stands there."""
    begin = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("pieces"))

    def step(held, run):
        piece = F.array(F.substring(F.col(formatted), held["at"] + run["without"], run["within"]))
        return F.struct((held["at"] + run["without"] + run["within"] + run["after"]).alias("at"),
                        F.when(run["within"] > 0, F.concat(held["pieces"], piece)).otherwise(held["pieces"]).alias("pieces"))

    return F.aggregate(runs, begin, step, lambda held: held["pieces"])


def read_back(formatted: DataFrame) -> DataFrame:
    """``(conv_id, turns, loss_text, formatted_chars)`` recovered from (conv_id, formatted, loss_runs, round_trip).

    The turns are parsed from the text. The loss text is cut out of it by the mask, piece by piece, and unescaped: it does
    not look at roles. A conversation whose text did not parse back to its source fails the query.
    """
    proved = F.when(F.col("round_trip"), F.col("formatted")).otherwise(
        F.raise_error(F.lit("a formatted conversation does not parse back to its source")).cast("string"))
    cut = F.transform(under_mask("formatted", "loss_runs"), _unguard)
    return formatted.withColumn("formatted", proved).select(
        "conv_id", parse(F.col("formatted")).alias("turns"), F.array_join(cut, "").alias("loss_text"),
        F.length("formatted").cast("long").alias("formatted_chars"))
