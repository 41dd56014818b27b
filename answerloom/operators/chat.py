"""Chat records: conversations, roles, prompt templates, token budget and packing."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.functions.numbers import hash_bucket, percent
from answerloom.functions.text import token_count
from answerloom.operators.packing import following

# Fixed value: the default training template. Its text up to {OUTPUT} is the inference prompt.
CHAT_TEMPLATE = """Below are some instructions that describe some tasks. Write responses that appropriately complete each request.

### Instruction:
{INPUT}

### Response:
{OUTPUT}"""

# Speaker names and the roles they stand for.
ROLES = {
    "human": "user",
    "user": "user",
    "gpt": "assistant",
    "assistant": "assistant",
    "system": "system",
}

PARAGRAPH = "\n\n"
MAX_TOKENS = 512
TURNS_PER_PART = 64


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """The template with each ``{NAME}`` of ``values`` replaced.

    The template is cut at its placeholders once, so text inside a value is never taken for a placeholder.
    """
    names = "|".join(re.escape(n) for n in values)
    pieces = re.split(rf"\{{({names})\}}", template)
    return F.concat(*[values[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces) if i % 2 or p])


def merge_prompt(df: DataFrame, template: str) -> Column:
    """A template whose ``{column}`` placeholders are columns of ``df``."""
    return fill_template(template, {c: F.col(c) for c in df.columns})


def to_conversation(df: DataFrame, prompt: str = "{instruction}", output: str = "output") -> DataFrame:
    """Add ``conversations``: one exchange of a human and a gpt turn per record."""

    def turn(speaker: str, value: Column) -> Column:
        return F.struct(F.lit(speaker).alias("from"), value.alias("value"))

    exchange = F.array(turn("human", merge_prompt(df, prompt)), turn("gpt", F.col(output)))
    return df.withColumn("conversations", exchange)


def standardize_roles(df: DataFrame, column: str = "conversations") -> DataFrame:
    """Turn ``from`` / ``value`` into ``role`` / ``content``; a speaker without a standard role keeps its name."""
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])

    def turn(t: Column) -> Column:
        role = F.coalesce(F.element_at(names, t["from"]), t["from"])
        return F.struct(role.alias("role"), t["value"].alias("content"))

    return df.withColumn(column, F.transform(column, turn))


def _template_parts(template: str) -> tuple[str, str, str, str]:
    """The template's preface, and what stands before a question, between it and its answer, and after the answer.

    The preface is what precedes the paragraph of ``{INPUT}``.
    """
    found = re.fullmatch(r"(.*?)\{INPUT\}(.*?)\{OUTPUT\}(.*)", template, re.DOTALL)
    if not found or any("{INPUT}" in x or "{OUTPUT}" in x for x in found.groups()):
        raise ValueError("a template holds {INPUT} once and {OUTPUT} once after it")
    preface, gap, opening = found[1].rpartition(PARAGRAPH)
    return preface + gap, opening, found[2], found[3]


def render_chat(
    df: DataFrame, template: str = CHAT_TEMPLATE, column: str = "conversations", end: str = "", part: str | None = None
) -> DataFrame:
    """Add ``text``: the turns in order by role, each answer followed by ``end``.

    The text begins with the template's preface, or with the system turn that opens the conversation in its place. Every
    turn is rendered: assistant turns as answers, later system turns as paragraphs, all others as questions. Text is
    null for a conversation without an assistant turn; ``without_answer`` counts these. With a ``part`` column (see
    ``collect_turns``) the later parts continue the text of part 0, so the texts of all parts, joined, are the
    conversation's; no part's text is null, as its answer may be in another. Null content reads as empty.
    """
    preface, opening, between, after = _template_parts(template)
    first = F.lit(True) if part is None else F.col(part) == 0
    turns = F.col(column)
    led = F.get(turns, F.lit(0))["role"] == "system"

    def rendered(turn: Column, i: Column) -> Column:
        content = F.coalesce(turn["content"], F.lit(""))
        lead = F.when(first & (i == F.when(led, 1).otherwise(0)), "").otherwise(PARAGRAPH)
        return (
            F.when((turn["role"] == "system") & first & (i == 0), F.concat(content, F.lit(PARAGRAPH)))
            .when(turn["role"] == "system", F.concat(lead, content))
            .when(turn["role"] == "assistant", F.concat(F.lit(between), content, F.lit(after + end)))
            .otherwise(F.concat(lead, F.lit(opening), content))
        )

    start = F.when(first & ~F.coalesce(led, F.lit(False)), preface).otherwise("")
    text = F.concat(start, F.array_join(F.transform(turns, rendered), ""))
    return df.withColumn("text", text if part else F.when(has_answer(column), text))


def has_answer(column: str = "conversations") -> Column:
    return F.exists(column, lambda t: t["role"] == "assistant")


def without_answer(df: DataFrame, column: str = "conversations") -> DataFrame:
    """How many conversations there are, and how many of them have no assistant turn and so no text."""
    return df.agg(F.count("*").alias("n"), F.count_if(~F.coalesce(has_answer(column), F.lit(False))).alias("n_unanswered"))


def render_prompt(df: DataFrame, instruction: str = "instruction", template: str = CHAT_TEMPLATE) -> DataFrame:
    """Add ``prompt``: the template up to the answer."""
    before_answer = template.split("{OUTPUT}")[0]
    return df.withColumn("prompt", fill_template(before_answer, {"INPUT": F.col(instruction)}))


def token_budget(df: DataFrame, text: str = "text", budget: int = MAX_TOKENS, tokens: Column | None = None) -> DataFrame:
    """Add ``n_tokens`` and whether the row ``fits``. Tokens are whitespace-separated unless a count is given."""
    counted = token_count(F.col(text)) if tokens is None else tokens
    return df.withColumn("n_tokens", counted.cast("int")).withColumn("fits", F.col("n_tokens") <= budget)


def budget_share(budgeted: DataFrame) -> DataFrame:
    """How many rows fit the budget, as a count and in percent."""
    fits = F.count_if("fits")
    return budgeted.agg(F.count("*").alias("n"), fits.alias("n_fits"), percent(fits, F.count("*")).alias("pct_fits"))


def require_turns(turns: DataFrame) -> DataFrame:
    """``turns`` itself, or ValueError when a turn has no conversation or number, or a number occurs twice in one.

    Counts (conv_id, turn) pairs, combined map-side.
    """
    wrong = turns.groupBy("conv_id", "turn").count().filter("conv_id IS NULL OR turn IS NULL OR count > 1")
    found = wrong.limit(1).collect()
    if found:
        raise ValueError(f"turns need a conversation and a number of their own: {tuple(found[0])}")
    return turns


def collect_turns(turns: DataFrame, per_part: int = TURNS_PER_PART, checked: bool = False) -> DataFrame:
    """Turn-per-row to (conv_id, part, conversations), the turns of a part in order.

    A part holds the turns numbered ``part * per_part`` and on. An ordinary conversation is one part; an endless one
    becomes many rows on many tasks. Turn numbers are distinct within a conversation (``require_turns`` sees to it unless
    the caller has ``checked``), so a part has at most ``per_part`` turns. ``join_parts`` puts parts together again, and
    ``render_chat`` renders them so that their texts join.
    """
    if per_part < 2:
        raise ValueError("a part holds a system turn and what follows it, so two turns at least")
    turns = turns if checked else require_turns(turns)
    part = F.floor(F.col("turn") / per_part).alias("part")
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return (
        turns.groupBy("conv_id", part)
        .agg(ordered.alias("turns"))
        .select(
            "conv_id",
            "part",
            F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias(
                "conversations"
            ),
        )
    )


def join_parts(parts: DataFrame) -> DataFrame:
    """(conv_id, conversations): each conversation whole, for callers whose conversations fit into a row."""
    ordered = F.sort_array(F.collect_list(F.struct("part", "conversations")))
    return parts.groupBy("conv_id").agg(F.flatten(F.transform(ordered, lambda p: p["conversations"])).alias("conversations"))


def pack_sequences(df: DataFrame, key: str, tokens: str, shards: int, budget: int = MAX_TOKENS) -> DataFrame:
    """Pack short rows into sequences: (shard, pack_id, ids, n_tokens).

    Rows are spread over ``shards`` shards by the hash of their key. Within a shard, which one task sorts and packs, they
    are taken in key order, and a sequence is closed when the next row would exceed ``budget``. A row above the budget has a
    sequence to itself. Only keys and counts are shuffled. A null key or count is an error. ``packing.pack_in_order`` needs no
    shards.
    """
    narrow = df.select(
        hash_bucket(F.col(key), shards).alias("shard"),
        F.coalesce(F.col(key), F.raise_error(F.lit("a row to pack has no key"))).alias("id"),
        F.coalesce(F.col(tokens).cast("long"), F.raise_error(F.lit("a row to pack has no token count")).cast("long")).alias("n"),
    )
    schema = f"shard long, pack_id long, ids array<{narrow.schema['id'].dataType.simpleString()}>, n_tokens long"

    packs = following(budget)

    # A closure travels to the Python workers by value, so they need not have this package installed.
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values("id")
        sums, after = packs(ordered["n"].to_numpy())
        ids, starts = ordered["id"].tolist(), [0]
        while (start := int(after[starts[-1]])) < len(ids):
            starts.append(start)
        shard = int(rows["shard"].iloc[0])
        packed = [(shard, k, ids[a:b], int(sums[b] - sums[a])) for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)]))]
        return pd.DataFrame(packed, columns=["shard", "pack_id", "ids", "n_tokens"])

    return narrow.groupBy("shard").applyInPandas(pack, schema)
