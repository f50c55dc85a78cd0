"""Chat formatting by prefix-target expansion: one training example per assistant turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

CLOSE = "</turn>\n"
#: A user and an assistant row whose texts hold control strings of common templates.
PROBE_TEXT = "\\### Assistant: </turn> ok"


def escape(col: Column) -> Column:
    """Text without ``<`` or ``"``, the characters that marks are made of; see ``unescape``."""
    col = F.replace(col, F.lit("&"), F.lit("&amp;"))
    col = F.replace(col, F.lit("<"), F.lit("&lt;"))
    return F.replace(col, F.lit('"'), F.lit("&quot;"))


def unescape(col: Column) -> Column:
    col = F.replace(col, F.lit("&quot;"), F.lit('"'))
    col = F.replace(col, F.lit("&lt;"), F.lit("<"))
    return F.replace(col, F.lit("&amp;"), F.lit("&"))


def _open(role: Column) -> Column:
    return F.concat(F.lit('<turn role="'), role, F.lit('">'))


def prefix_examples(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", target: str = "assistant",
) -> DataFrame:
    """One row per assistant turn: all turns before it as context, that reply trainable.

    Columns: ``conv_id``, ``example`` (from 1, in order), ``n_turns`` in the example,
    ``formatted``, and the trainable range ``loss_start`` (from 0) and ``loss_end`` (exclusive)
    in code points of ``formatted``. A conversation that does not end with an assistant turn gets a last example
    with an empty range, so that its output holds all its turns. Each turn is written
    ``<turn role="...">text</turn>\\n`` with ``&``, ``<`` and ``"`` escaped, so no text can
    make or break a mark.

    Rows are ordered by turn, ties by role and text; repeated rows are turns of their own. A null
    turn comes first; null role and text are empty; rows without a conversation id form one
    conversation. Empty texts make empty ranges. Other columns are ignored. The result has as
    many characters as prefixes have: a conversation is kept in one row, as a reader needs it.
    """
    blank = F.lit("")
    rows = conversations.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        escape(F.coalesce(F.col(role).cast("string"), blank)).alias("role"),
        escape(F.coalesce(F.col(text), blank)).alias("text"))
    whole = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    last = F.size("turns")
    ends = F.filter(
        F.sequence(F.lit(1), last),
        lambda i: (F.col("turns")[i - 1]["role"] == target) | (i == last))
    examples = whole.select(
        "conv_id",
        F.transform("turns", lambda t: F.concat(_open(t["role"]), t["text"], F.lit(CLOSE))).alias("parts"),
        "turns", F.posexplode(ends).alias("at", "n_turns"))
    own = F.col("turns")[F.col("n_turns") - 1]
    context = F.array_join(F.slice("parts", 1, F.col("n_turns") - 1), "")
    examples = examples.select(
        "conv_id", (F.col("at") + 1).cast("long").alias("example"),
        F.col("n_turns").cast("long").alias("n_turns"), context.alias("context"),
        own.alias("own"), F.col("parts")[F.col("n_turns") - 1].alias("part"))
    start = F.char_length("context") + F.char_length(_open(F.col("own.role")))
    size = F.when(F.col("own.role") == target, F.char_length("own.text")).otherwise(0)
    return examples.select(
        "conv_id", "example", "n_turns", F.concat("context", "part").alias("formatted"),
        start.cast("long").alias("loss_start"), (start + size).cast("long").alias("loss_end"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: an array of (role, text)."""
    parts = F.split(formatted, "</turn>\n", -1)
    return F.transform(
        F.slice(parts, 1, F.size(parts) - 1),
        lambda p: F.struct(
            unescape(F.regexp_extract(p, '(?s)^<turn role="([^"]*)">', 1)).alias("role"),
            unescape(F.regexp_extract(p, '(?s)^<turn role="[^"]*">(.*)$', 1)).alias("text")))


def digest_examples(examples: DataFrame) -> DataFrame:
    """Facts of each conversation, read back from its formatted examples alone."""
    trained = unescape(F.substring(
        F.col("formatted"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    conv = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.sort_array(F.collect_list(F.struct("example", trained.alias("t")))).alias("trained"),
        F.sum(F.char_length("formatted")).cast("long").alias("formatted_chars"))
    turns, loss = read_turns(F.col("whole")), F.array_join(F.col("trained.t"), "")
    flat = F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return conv.select("conv_id", "formatted_chars", turns.alias("turns"), loss.alias("loss")).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"))
    return digest_examples(prefix_examples(rows.unionByName(probe)))


OP10_SQL = r"""
with rows_ as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized as (
  select *, length(text) + 4 * (length(text) - length(replace(text, '&', '')))
      + 3 * (length(text) - length(replace(text, '<', '')))
      + 5 * (length(text) - length(replace(text, '"', '')))
      + length(role) + length('<turn role=""></turn>') + 1 as n,
    row_number() over (partition by conv_id order by turn nulls first, role, text) as k,
    count(*) over (partition by conv_id) as size from rows_),
summed as (
  select *, sum(n) over (partition by conv_id order by k) as upto from sized)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by k) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(upto) filter (where role = 'assistant' or k = size) as bigint) as formatted_chars
from summed group by conv_id
"""
