"""Chat formatting by event-sourced reconstruction, with built-in functions only.

A conversation log is a table of events ordered by ``seq`` within ``conv_id``:

* ``message``     opens a message at position ``turn`` with a role and a text
* ``delta``       appends its text to the open message of its turn
* ``edit``        replaces the text of the open message of its turn
* ``regenerate``  restarts the message of its turn (its own text is the new
  start) and voids everything logged earlier for later turns

:func:`fold_events` folds a log into final messages: running counts of opening
and restarting events per (conversation, turn) name each text's segment, the
last segment of each message wins, its pieces are joined in order. Only window
and grouping keys of (conversation, turn) carry texts here, so a long
conversation is spread over its turns. :func:`render_chats` then joins the
messages of a conversation, which is one output row by definition.

The template marks each message as ``<|im_start|>role\\ntext<|im_end|>\\n``. Any
control string inside a text gets a backslash after its first character and
every backslash of the text is doubled first, so :func:`unescape` restores the
text exactly; roles have %, newline and ``<`` percent-encoded. The rendered row
keeps ``segments`` (text, loss flag); ``formatted`` is their concatenation and
the loss flag covers the text of assistant messages only.

Defined results: null text or role counts as empty, null kind as ``message``;
null ids form one conversation; ties of ``seq`` are ordered by kind, role and
text; repeated ``message`` rows are kept as messages of their own; a delta, edit
or regenerate without an open message opens one; unknown kinds act as
``message``; extra columns are ignored; an empty log gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"

# Control strings of common chat templates, as first character and rest.
CONTROL = ["<|im_start|>", "<|im_end|>", "<|im_sep|>", "<|endoftext|>", "<|eot_id|>", "<|begin_of_text|>",
           "<|end_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|system|>", "<|user|>",
           "<|assistant|>", "<|end|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<start_of_turn>",
           "<end_of_turn>", "[INST]", "[/INST]"]


def _quoted(s: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in s)


_TAILS = {first: "|".join(sorted(_quoted(c[1:]) for c in CONTROL if c[0] == first)) for first in ("<", "[")}
_HEADS = "|".join(f"{_quoted(first)}(?={tails})" for first, tails in _TAILS.items())
_ESCAPED = f"([<\\[])\\\\(?={'|'.join(_TAILS.values())})"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({_HEADS})", r"$1\\")


def unescape(text: Column) -> Column:
    plain = F.regexp_replace(text, _ESCAPED, "$1")
    return F.replace(plain, F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    out = F.replace(role, F.lit("%"), F.lit("%25"))
    out = F.replace(out, F.lit("\n"), F.lit("%0A"))
    return F.replace(out, F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    out = F.replace(role, F.lit("%3C"), F.lit("<"))
    out = F.replace(out, F.lit("%0A"), F.lit("\n"))
    return F.replace(out, F.lit("%25"), F.lit("%"))


def fold_events(events: DataFrame) -> DataFrame:
    """``conv_id, turn, msg_no, role, text``: the final messages of a log with
    columns conv_id, seq, turn, kind, role, text."""
    known = F.col("kind").isin("delta", "edit", "regenerate")
    e = events.select(
        "conv_id", "seq", "turn",
        F.when(known, F.col("kind")).otherwise(F.lit("message")).alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    # one row per restart; the join compares within a conversation and emits no pairs
    cuts = e.where(F.col("kind") == "regenerate") \
        .select(F.col("conv_id").alias("_conv"), F.col("seq").alias("_cut_seq"), F.col("turn").alias("_redo")).distinct()
    voided = e.join(cuts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_cut_seq") > F.col("seq"))
                    & (F.col("_redo") < F.col("turn")), "left_anti")

    order = [F.col("seq").asc(), F.col("kind").desc(), F.col("role").asc(), F.col("text").asc()]
    w = Window.partitionBy("conv_id", "turn").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = voided.withColumn("msg_no", F.sum((F.col("kind") == "message").cast("int")).over(w)) \
        .withColumn("restart_no", F.sum(F.col("kind").isin("edit", "regenerate").cast("int")).over(w)) \
        .withColumn("event_no", F.row_number().over(w))
    piece = F.struct("event_no", "role", "text")
    segments = cells.groupBy("conv_id", "turn", "msg_no", "restart_no").agg(
        F.sort_array(F.collect_list(piece)).alias("pieces"))
    best = segments.groupBy("conv_id", "turn", "msg_no").agg(
        F.max_by("pieces", "restart_no").alias("pieces"),
        F.min_by(F.get(F.col("pieces"), F.lit(0))["role"], "restart_no").alias("first_role"))
    return best.select("conv_id", "turn", "msg_no", F.col("first_role").alias("role"),
                       F.array_join(F.col("pieces.text"), "").alias("text"))


def render_chats(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``segments`` and ``formatted``."""
    m = messages.select("conv_id", "turn", "msg_no", escape_role(F.col("role")).alias("role"),
                        escape(F.col("text")).alias("text"), (F.col("role") == "assistant").alias("loss"))
    turns = m.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("turn", "msg_no", "role", "text", "loss"))).alias("turns"))
    segs = F.flatten(F.transform("turns", lambda t: F.array(
        F.struct(F.concat(F.lit(START), t["role"], F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
        F.struct(t["text"].alias("text"), t["loss"].alias("loss")),
        F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")))))
    out = turns.select("conv_id", segs.alias("segments"))
    return out.select("conv_id", "segments", F.array_join(F.col("segments.text"), "").alias("formatted"))


def read_back(chats: DataFrame) -> DataFrame:
    """Parse rendered rows: ``turns`` (role, text) from ``formatted`` alone, and
    ``loss_texts``, the unescaped texts under the loss flag, in order."""
    parts = F.split("formatted", _quoted(START), -1)
    raw = chats.select("*", parts.alias("_cut")).withColumn("_parts", F.slice("_cut", 2, F.size("_cut")))
    turn = F.transform("_parts", lambda p: F.struct(
        unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.regexp_replace(F.regexp_replace(p, "^[^\n]*\n", ""), f"{_quoted(END)}\n$", "")).alias("text")))
    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return raw.select("conv_id", "formatted", "segments", turn.alias("turns"), loss.alias("loss_texts"))


def format_conversations(log: DataFrame) -> DataFrame:
    """Fold an event log and render it."""
    return render_chats(fold_events(log))


def messages_as_events(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as a log of ``message`` events."""
    return conversations.select("conv_id", F.col("turn").alias("seq"), "turn", F.lit("message").alias("kind"),
                                "role", "text")
