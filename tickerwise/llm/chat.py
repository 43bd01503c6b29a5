"""Chat formatting with a grammar round trip, in DataFrame functions only.

Every conversation is rendered, the rendered text is read back by a deterministic parser, and the recovered turns are
compared with the source.  Where they differ (a text holds strings of the template), the texts are rendered again with
the control strings escaped, and read back again.  The header line says which of the two it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the template
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>"), "system": ("<<SYS>> ", " <</SYS>>")}
OTHER = ("[TURN ", "] ", " [/TURN]")
CONTROL = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[TURN ", "[/TURN]", "]"]
ESCAPE = "~"
PLAIN, ESCAPED = "0\n", "1\n"
GRAMMAR = (r"(?s)<<SYS>> .*? <</SYS>>|\[INST\] .*? \[/INST\]|<s> .*? </s>|\[TURN [^\]]*\] .*? \[/TURN\]")


def escape(text: Column, controls: list[str]) -> Column:
    """Reversible: afterwards no control string is left in the text."""
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "0"))
    for i, c in enumerate(controls):
        out = F.replace(out, F.lit(c), F.lit(f"{ESCAPE}{i + 1}"))
    return out


def unescape(text: Column, controls: list[str]) -> Column:
    out = text
    for i, c in reversed(list(enumerate(controls))):
        out = F.replace(out, F.lit(f"{ESCAPE}{i + 1}"), F.lit(c))
    return F.replace(out, F.lit(ESCAPE + "0"), F.lit(ESCAPE))


def _render(turn: Column, escaped: bool) -> Column:
    text = escape(turn["text"], CONTROL[:-1]) if escaped else turn["text"]
    role = escape(turn["role"], CONTROL) if escaped else turn["role"]
    out = F.concat(F.lit(OTHER[0]), role, F.lit(OTHER[1]), text, F.lit(OTHER[2]))
    for name, (a, b) in MARKS.items():
        out = F.when(turn["role"] == name, F.concat(F.lit(a), text, F.lit(b))).otherwise(out)
    return out


def _read_turn(piece: Column, escaped: Column) -> Column:
    """One matched turn -> (role, text, mark before the text, mark after it)."""
    name = F.substring_index(F.substring(piece, len(OTHER[0]) + 1, 2**31 - 1), "]", 1)
    role = F.when(escaped, unescape(name, CONTROL)).otherwise(name)
    before, after = F.length(name) + len(OTHER[0]) + len(OTHER[1]), F.lit(len(OTHER[2]))
    for r, (a, b) in MARKS.items():
        here = piece.startswith(a)
        role, before, after = F.when(here, F.lit(r)).otherwise(role), F.when(here, len(a)).otherwise(before), F.when(here, len(b)).otherwise(after)
    raw = F.substring(piece, before + 1, F.length(piece) - before - after)
    text = F.when(escaped, unescape(raw, CONTROL[:-1])).otherwise(raw)
    return F.struct(role.alias("role"), text.alias("text"), before.alias("before"), F.length(raw).alias("chars"), F.length(piece).alias("whole"))


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation: array of (role, text, before, chars, whole); the grammar's inverse."""
    escaped = formatted.startswith(ESCAPED)
    pieces = F.regexp_extract_all(F.substring(formatted, len(PLAIN) + 1, 2**31 - 1), F.lit(GRAMMAR), F.lit(0))
    return F.transform(pieces, lambda p: _read_turn(p, escaped))


def _pairs(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def format_chats(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns (read back), loss_spans, escaped, round_trip.

    ``conversations`` needs conv_id, turn, role, text; rows are ordered by turn (ties: by role, then text).  Null text
    or role counts as empty; a null turn sorts first.  Repeated rows are repeated turns.  Rows without a conv_id form
    one conversation whose id is null.  Other columns are ignored.  Empty table: empty result.
    ``loss_spans`` are the (start, length) in code points, from 0, of the assistant texts in ``formatted``;
    ``round_trip`` says that the turns read back equal the source (always true).
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("source"))
    for name, escaped in (("plain", False), ("careful", True)):
        body = F.array_join(F.transform("source", lambda t: _render(t, escaped)), "")  # noqa: B023
        grouped = grouped.withColumn(name, F.concat(F.lit(ESCAPED if escaped else PLAIN), body))
    source = _pairs(F.col("source"))
    same = lambda text: (_pairs(parse(text)) == source) & (F.aggregate(parse(text), F.lit(len(PLAIN)), lambda s, t: s + t["whole"]) == F.length(text))
    out = grouped.withColumn("formatted", F.when(same(F.col("plain")), F.col("plain")).otherwise(F.col("careful")))
    out = out.select("conv_id", "formatted", "source", parse(F.col("formatted")).alias("read"))
    start = lambda i: F.aggregate(F.slice("read", 1, i), F.lit(len(PLAIN)), lambda s, t: s + t["whole"])
    spans = F.transform("read", lambda t, i: F.struct(t["role"].alias("role"), (start(i) + t["before"]).alias("start"), t["chars"].alias("length")))
    return out.select("conv_id", "formatted", _pairs(F.col("read")).alias("turns"),
                      F.transform(F.filter(spans, lambda s: s["role"] == "assistant"), lambda s: F.struct(s["start"], s["length"])).alias("loss_spans"),
                      F.col("formatted").startswith(ESCAPED).alias("escaped"),
                      (_pairs(F.col("read")) == _pairs(F.col("source"))).alias("round_trip"))


def loss_texts(chats: DataFrame) -> Column:
    """The assistant texts, cut from ``formatted`` by ``loss_spans`` and unescaped."""
    cut = lambda s: F.substring(F.col("formatted"), s["start"] + 1, s["length"])
    return F.transform("loss_spans", lambda s: F.when(F.col("escaped"), unescape(cut(s), CONTROL[:-1])).otherwise(cut(s)))


def chat_digests(chats: DataFrame) -> DataFrame:
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(loss_texts(chats), "")
    return chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                        F.length("formatted").cast("long").alias("formatted_chars"), "round_trip")
