"""Corpus sinks. Each write replaces what its path held."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.config import SplitConfig

INSTRUCTION_COLUMNS = ["instruction", "input", "output"]


def write_clean(clean: DataFrame, path: str, fmt: str = "json") -> None:
    """The three instruction columns of the clean corpus."""
    clean.select(*INSTRUCTION_COLUMNS).write.mode("overwrite").format(fmt).save(path)


def write_splits(splits: DataFrame, path: str, fmt: str = "json") -> None:
    """All splits in one job, below ``path/split=<name>``."""
    splits.select(*INSTRUCTION_COLUMNS, "split").write.mode("overwrite").partitionBy("split").format(fmt).save(path)


def write_split_folders(splits: DataFrame, paths: dict[str, str], fmt: str = "json") -> None:
    """Each split to a folder of its own. Reads ``splits`` once per folder, so pass a written table."""
    unknown = set(paths) - set(SplitConfig().shares)
    if unknown:
        raise ValueError(f"unknown splits: {sorted(unknown)}")
    for name, path in paths.items():
        write_clean(splits.filter(F.col("split") == name), path, fmt)


def write_chat(chat: DataFrame, path: str) -> None:
    """The chat records, conversation array included, as Parquet."""
    chat.write.mode("overwrite").parquet(path)
