"""Chat formatting by event-sourced reconstruction. Native: DataFrame functions only.

A log holds events of conversations, ordered by ``seq``:

=============  ===========================================================================================
``message``    a message with its whole text; as a second event of a message it restarts it
``delta``      text appended to the message (a streamed part)
``edit``       the message's text is replaced; later deltas are appended to the new text
``regenerate`` the message is emptied, and every later message that began before this event goes
=============  ===========================================================================================

``fold`` turns the log into the final messages, ``render`` each conversation into one string with a loss mask, and
``read_back`` parses that string again. The template marks a turn as ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a
line feed. Control strings inside roles and texts are broken by a backslash after their first character, and every
backslash is doubled first, so that removing each escaping backslash gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulecheck.llm.common import let, prefix_sums, table

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: Beside this template's own strings, those of other templates: <s>, </s>, [INST], [/INST], <<SYS>>, <</SYS>>.
_CONTROL = r"<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])"


def escape(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, f"({_CONTROL})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """events(conv_id, message, seq, kind, role, text) -> (conv_id, message, role, text): the final messages.

    ``message`` orders the messages of a conversation. Null text: empty; null kind: ``message``; an unknown kind is
    ignored; equal ``seq`` are ordered by kind (message, regenerate, edit, delta), then by text. The role is that of the
    message's first event with one. Null conversation or message ids are values of their own. A message is folded by
    one sort of its own events after a partial aggregate; a conversation is never gathered here.
    """
    kind = F.coalesce(F.lower("kind"), F.lit("message"))
    rank = F.element_at(F.create_map(*[F.lit(x) for k, n in (("message", 0), ("regenerate", 1), ("edit", 2), ("delta", 3)) for x in (k, n)]), kind)
    log = events.select("conv_id", "message", "seq", "role", F.coalesce("text", F.lit("")).alias("text"), rank.alias("rank")).filter("rank IS NOT NULL")
    own = Window.partitionBy("conv_id", "message").orderBy("seq", "rank", "text")
    # a restart begins a new generation of the text; only the last generation is kept
    log = log.withColumn("restart", F.sum((F.col("rank") < 3).cast("int")).over(own))
    by = Window.partitionBy("conv_id", "message")
    last = log.withColumn("last", F.max("restart").over(by)).groupBy("conv_id", "message").agg(
        F.min_by("role", F.when(F.col("role").isNotNull(), F.struct("seq", "rank", "text"))).alias("role"),
        F.min(F.struct("seq", "rank")).alias("began"),
        F.max(F.when(F.col("rank") == 1, F.col("seq"))).alias("redone"),
        F.sort_array(F.collect_list(F.when((F.col("restart") == F.col("last")) & (F.col("rank") != 1), F.struct("seq", "rank", "text")))).alias("parts"))
    # a message goes if an earlier one of its conversation was regenerated after it had begun
    earlier = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    kept = last.withColumn("gone", F.max("redone").over(earlier) > F.col("began.seq"))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    return kept.filter(~F.coalesce("gone", F.lit(False))).select("conv_id", "message", "role", text.alias("text"))


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """messages(conv_id, message, role, text) -> (conv_id, formatted, mask array<struct<turn, start, end>>).

    The mask spans the (escaped) texts of the role ``learn`` as code points of ``formatted``, end exclusive; ``turn`` is
    the position of the turn. Null role: empty. A conversation is one string, so one task holds it: that is the result.
    """
    head = F.concat(F.lit(START), escape(F.coalesce("role", F.lit(""))), F.lit(SEP))
    body = escape(F.coalesce("text", F.lit("")))
    turn = messages.select("conv_id", F.struct(
        "message", F.col("role").eqNullSafe(learn).alias("learn"), F.char_length(head).alias("head"),
        F.char_length(body).alias("body"), F.concat(head, body, F.lit(END)).alias("turn")).alias("t"))
    turns = turn.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    sizes = F.transform("ts", lambda t: (t["head"] + t["body"] + len(END)).cast("bigint"))
    mask = let(prefix_sums(sizes), lambda at: F.filter(
        F.transform("ts", lambda t, i: F.when(t["learn"], F.struct(
            i.alias("turn"), (F.get(at, i) + t["head"]).alias("start"), (F.get(at, i) + t["head"] + t["body"]).alias("end")))),
        lambda s: s.isNotNull()))
    return turns.select("conv_id", F.array_join(F.transform("ts", lambda t: t["turn"]), "").alias("formatted"), mask.alias("mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """render's rows with turns array<struct<role, text>> and learned (the text under the mask), parsed from the string."""
    raw = F.split("formatted", r"<\|im_end\|>\n")
    parts = let(raw, lambda ts: F.slice(ts, F.lit(1), F.size(ts) - 1))  # the string ends with a turn's end
    turns = F.transform("_raw", lambda t: let(F.split(t, r"<\|im_sep\|>"), lambda x: F.struct(
        unescape(F.substring(x[0], len(START) + 1, 2**31 - 1)).alias("role"), unescape(x[1]).alias("text"))))
    at = prefix_sums(F.transform("_raw", lambda t: (F.char_length(t) + len(END)).cast("bigint")))
    learned = let(at, lambda a: F.array_join(F.transform("mask", lambda m: unescape(
        F.get(F.col("_raw"), m["turn"]).substr((m["start"] - F.get(a, m["turn"]) + 1).cast("int"), (m["end"] - m["start"]).cast("int")))), ""))
    return formatted.withColumn("_raw", parts).select(*formatted.columns, turns.alias("turns"), learned.alias("learned"))


def conversation_events(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as a log: each row is one message; equal turns keep a message each.

    Rows of a conversation are numbered by turn, then role and text, so repeated rows stay apart.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select("conv_id", F.row_number().over(order).alias("message"), F.coalesce("turn", F.lit(-1)).alias("seq"),
                                F.lit("message").alias("kind"), "role", "text")


def op7_event_sourced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, folded, rendered and read back."""
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = read_back(render(fold(conversation_events(rows))))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
                       F.char_length("learned").cast("bigint").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("bigint").alias("formatted_chars"))
