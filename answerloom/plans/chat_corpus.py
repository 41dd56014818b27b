"""The chat data set for training, and the prompts for evaluation: from the job's splits, or from one instruction file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from answerloom.operators.chat import CHAT_TEMPLATE, render_chat, render_prompt, standardize_roles, to_conversation
from answerloom.operators.split import sample_k
from answerloom.plans.prepare import Prepared
from answerloom.sources.lines import head_rows, holdout_rows

TRAIN_ROWS = 50_000
POOL_ROWS = 1_000
SAMPLE_ROWS = 50


def chat_records(instructions: DataFrame, template: str = CHAT_TEMPLATE, end: str = "") -> DataFrame:
    """Instruction rows with their conversation and training text."""
    return render_chat(standardize_roles(to_conversation(instructions)), template, end=end)


def training_chat(
    spark: SparkSession, path: str, rows: int | None = TRAIN_ROWS, template: str = CHAT_TEMPLATE, end: str = ""
) -> DataFrame:
    """Chat records of the first ``rows`` valid lines (None: all)."""
    return chat_records(head_rows(spark, path, rows), template, end)


def split_chat(run: Prepared, name: str = "train", template: str = CHAT_TEMPLATE, end: str = "") -> DataFrame:
    """Chat records of all rows of one split, so that what is held out stays out of training."""
    return chat_records(run.split(name), template, end)


def split_prompts(run: Prepared, name: str = "test", k: int | None = SAMPLE_ROWS, seed: int = 42, template: str = CHAT_TEMPLATE) -> DataFrame:
    """A seeded sample of ``k`` rows of one split (None: all): (sample_id, instruction, reference, prompt).

    A row's content hash, which occurs once in the clean rows, is its id.
    """
    rows = run.split(name)
    rows = rows if k is None else sample_k(rows, "content_hash", k, seed)
    named = rows.withColumnsRenamed({"content_hash": "sample_id", "output": "reference"})
    return render_prompt(named, template=template).select("sample_id", "instruction", "reference", "prompt")


def evaluation_prompts(
    spark: SparkSession,
    path: str,
    skip: int = TRAIN_ROWS,
    pool: int = POOL_ROWS,
    k: int = SAMPLE_ROWS,
    seed: int = 42,
    template: str = CHAT_TEMPLATE,
) -> DataFrame:
    """A seeded sample of the lines after the training rows: (sample_id, instruction, reference, prompt)."""
    chosen = sample_k(holdout_rows(spark, path, skip, pool), "line_no", k, seed)
    named = chosen.withColumnsRenamed({"line_no": "sample_id", "output": "reference"})
    return render_prompt(named, template=template).select("sample_id", "instruction", "reference", "prompt")
