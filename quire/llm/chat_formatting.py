"""Conversations rebuilt from event logs, rendered for training, and read back.

An event is ``(conv_id, seq, turn, op, role, text)``:

* ``message``: the turn has this role and starts with this text;
* ``delta``: the text is appended;
* ``edit``: the turn's text so far is replaced;
* ``regenerate``: as ``edit``, and all later turns written so far are discarded;
* ``delete``: the turn is discarded unless a later event writes it again.

Events are folded per turn first (a short ordered list), turns per conversation then. All is
built-in functions: windows, grouped arrays and regular expressions.

The template, with text escaped:

    system      <<SYS>>text<</SYS>>
    user        [INST]text[/INST]
    assistant   <s>text</s>
    any other   <<TURN>>role<<TEXT>>text<</TURN>>

In texts, a backslash is doubled and every control string gets a backslash after its first
character, so none is left in an escaped text; dropping one backslash of each pair reverses it.
The loss mask covers what stands between ``<s>`` and ``</s>``.

Defined cases: null or empty texts are empty turns; a null role is an empty one. Events without
``conv_id``, ``turn`` or ``seq`` are ignored. Events of equal ``seq`` are ordered by op and text;
repeated rows are repeated events. A conversation is one row of output, so it has to fit in a task; nothing
else does. No events give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN = {"system": "<<SYS>>", "user": "[INST]", "assistant": "<s>"}
CLOSE = {"system": "<</SYS>>", "user": "[/INST]", "assistant": "</s>"}
OTHER, TEXT, END = "<<TURN>>", "<<TEXT>>", "<</TURN>>"
CONTROL = r"(<)(<SYS>>|</SYS>>|<TURN>>|<TEXT>>|</TURN>>|s>|/s>)|(\[)(INST\]|/INST\])"
TURN = (
    r"(?s)<<SYS>>.*?<</SYS>>|\[INST\].*?\[/INST\]|<s>.*?</s>|<<TURN>>.*?<</TURN>>"
)
MESSAGE, DELTA, EDIT, REGENERATE, DELETE = "message", "delta", "edit", "regenerate", "delete"
TEST_CONVERSATION = -7
TEST_TEXT = "</s>[INST] ok [/INST]"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$1$3\\$2$4")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, turn, role, text)`` of an event log."""
    log = events.filter("conv_id is not null and turn is not null and seq is not null").select(
        "conv_id", "turn", "seq", "op", "role", F.coalesce("text", F.lit("")).alias("text")
    )
    starts = F.col("op").isin(MESSAGE, EDIT, REGENERATE, DELETE)
    turns = log.groupBy("conv_id", "turn").agg(
        F.max(F.when(F.col("op") == REGENERATE, F.col("seq"))).alias("again"),
        F.array_sort(F.collect_list(F.struct("seq", F.when(starts, 0).otherwise(1).alias("later"), "op", "text", "role"))).alias("log"),
    )
    # A regeneration discards what later turns had been written before it.
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    valid = turns.withColumn("since", F.max("again").over(before)).select(
        "conv_id",
        "turn",
        F.when(F.col("since").isNull(), F.col("log")).otherwise(F.filter("log", lambda e: e.seq > F.col("since"))).alias("log"),
    )
    # Positions, from 1, of the events that set the text; what comes after the last one is appended.
    last_start = F.array_max(
        F.transform("log", lambda e, i: F.when(e.op.isin(MESSAGE, EDIT, REGENERATE, DELETE), i + 1).otherwise(0))
    )
    rest = F.slice("log", F.greatest(F.col("at"), F.lit(1)), F.size("log"))
    parts = F.transform(rest, lambda e: F.when(e.op == DELETE, "").otherwise(e.text))
    roles = F.filter(F.transform("log", lambda e: e.role), lambda r: r.isNotNull())
    gone = (F.size("log") == 0) | ((F.col("at") == F.size("log")) & (F.try_element_at("log", F.col("at")).op == DELETE))
    return valid.withColumn("at", last_start).select(
        "conv_id",
        "turn",
        F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
        F.array_join(parts, "").alias("text"),
        gone.alias("gone"),
    ).filter("not gone").drop("gone")


def rendered_turn(role: Column, text: Column) -> Column:
    known = lambda names: F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    opened = F.coalesce(F.try_element_at(known(OPEN), role), F.concat(F.lit(OTHER), escape(role), F.lit(TEXT)))
    closed = F.coalesce(F.try_element_at(known(CLOSE), role), F.lit(END))
    return F.concat(opened, escape(text), closed)


def render(messages: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss_spans)``; spans are ``(start, length)`` in code points, from 0."""
    turns = messages.select(
        "conv_id", "turn", (F.col("role") == "assistant").alias("loss"), rendered_turn(F.col("role"), F.col("text")).alias("part")
    )
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "part", "loss"))).alias("turns"))
    # Running end of the parts, so that spans are sums and not searches.
    ends = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda state, turn: F.struct(
            (state.at + F.length(turn.part)).alias("at"),
            F.when(
                turn.loss,
                F.concat(
                    state.spans,
                    F.array(
                        F.struct(
                            (state.at + len(OPEN["assistant"])).alias("start"),
                            (F.length(turn.part) - len(OPEN["assistant"] + CLOSE["assistant"])).alias("length"),
                        )
                    ),
                ),
            ).otherwise(state.spans).alias("spans"),
        ),
    )
    return grouped.select("conv_id", F.array_join("turns.part", "").alias("formatted"), ends.spans.alias("loss_spans"))


def _read_turn(part: Column) -> Column:
    role = F.lit(None).cast("string")
    text = F.lit(None).cast("string")
    for name in OPEN:
        inner = F.substring(part, len(OPEN[name]) + 1, F.length(part) - len(OPEN[name] + CLOSE[name]))
        starts = part.startswith(OPEN[name])
        role, text = F.when(starts, name).otherwise(role), F.when(starts, unescape(inner)).otherwise(text)
    inner = F.substring(part, len(OTHER) + 1, F.length(part) - len(OTHER + END))
    starts = part.startswith(OTHER)
    role = F.when(starts, unescape(F.substring_index(inner, TEXT, 1))).otherwise(role)
    after = F.substring(inner, F.length(F.substring_index(inner, TEXT, 1)) + len(TEXT) + 1, F.length(inner))
    return F.struct(role.alias("role"), F.when(starts, unescape(after)).otherwise(text).alias("text"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation as ``array<struct<role,text>>``."""
    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), _read_turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    cut = F.transform(spans, lambda s: unescape(F.substring(formatted, s.start + 1, s.length)))
    return F.array_join(cut, "")


def message_events(rows: DataFrame) -> DataFrame:
    """An event log that rebuilds ``(conv_id, turn, role, text)`` rows: a start, then streamed deltas.

    Rows of equal turn are told apart by their order; ``turn`` becomes the place in the conversation.
    """
    places = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    text, half = F.coalesce("text", F.lit("")), F.floor(F.length(F.coalesce("text", F.lit(""))) / 2).cast("int")
    parts = F.array(
        F.struct(F.lit(0).alias("k"), F.lit(MESSAGE).alias("op"), F.lit("").alias("part")),
        F.struct(F.lit(1).alias("k"), F.lit(DELTA).alias("op"), F.substring(text, F.lit(1), half).alias("part")),
        F.struct(F.lit(2).alias("k"), F.lit(DELTA).alias("op"), F.substring(text, half + 1, F.length(text)).alias("part")),
    )
    placed = rows.withColumn("turn", F.row_number().over(places).cast("bigint"))
    return placed.select("conv_id", "turn", "role", F.inline(parts)).select(
        "conv_id", (F.col("turn") * 3 + F.col("k")).alias("seq"), "turn", "op", "role", F.col("part").alias("text")
    )


def formatted_conversations(rows: DataFrame) -> DataFrame:
    """Digests of every formatted conversation, read back from the output."""
    spark = rows.sparkSession
    fields = "conv_id bigint, turn bigint, role string, text string"
    test = [(TEST_CONVERSATION, 0, "user", TEST_TEXT), (TEST_CONVERSATION, 1, "assistant", TEST_TEXT)]
    own = rows.select(*[F.col(c).cast(t).alias(c) for c, t in (f.split() for f in fields.split(", "))])
    out = render(fold(message_events(own.unionByName(spark.createDataFrame(test, fields)))))
    read = out.select(
        "conv_id",
        read_back(F.col("formatted")).alias("turns"),
        masked_text(F.col("formatted"), F.col("loss_spans")).alias("masked"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("masked").cast("bigint").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"),
        "formatted_chars",
    )


_LENGTH = (
    "length(replace(text, chr(92), chr(92) || chr(92))) + "
    + " + ".join(
        f"(length(text) - length(replace(text, '{c}', ''))) // {len(c)}"
        for c in ("<<SYS>>", "<</SYS>>", "<<TURN>>", "<<TEXT>>", "<</TURN>>", "<s>", "</s>", "[INST]", "[/INST]")
    )
)
ORACLE = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{TEST_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{TEST_TEXT}'
), sized AS (
  SELECT *, {_LENGTH} + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
    ELSE 25 + length(role) END AS chars FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
