"""The batch job as a program: raw JSON lines in; clean corpus, splits, profile and run summary out.

    spark-submit --py-files answerloom.zip answerloom/plans/corpus.py --input <jsonl> --output <folder>

The output folder receives ``clean``, ``splits/split=<name>``,
``profile/<part>``, ``leakage`` and ``funnel``; with ``--keep-versions`` a version folder below it does, which becomes current
at once when all is written. The job fails before it writes anything else when the splits do not add up or
a duplicate key occurs in two of them.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from answerloom.config import PrepConfig, SplitConfig
from answerloom.functions.numbers import thousands
from answerloom.operators.split import check_leakage
from answerloom.plans.prepare import Prepared, prepare
from answerloom.sources.jsonl import read_raw
from answerloom.sources.publish import KEEP_VERSIONS, publication
from answerloom.sources.sinks import write_clean, write_splits
from answerloom.storage import run_tables


def build_corpus(
    spark: SparkSession,
    source: str,
    output: str,
    cfg: PrepConfig = PrepConfig(),
    splits: SplitConfig = SplitConfig(),
    fmt: str = "json",
) -> Prepared:
    run = prepare(read_raw(spark, source), cfg, splits)
    run.split_counts()
    check_leakage(run.leakage()).coalesce(1).write.mode("overwrite").json(f"{output}/leakage")
    write_clean(run.clean, f"{output}/clean", fmt)
    write_splits(run.clean, f"{output}/splits", fmt)
    for name, part in run.profile().items():
        part.coalesce(1).write.mode("overwrite").json(f"{output}/profile/{name}")
    run.funnel.coalesce(1).write.mode("overwrite").json(f"{output}/funnel")
    return run


def publish_corpus(
    spark: SparkSession,
    source: str,
    root: str,
    cfg: PrepConfig = PrepConfig(),
    splits: SplitConfig = SplitConfig(),
    fmt: str = "json",
    keep: int = KEEP_VERSIONS,
) -> Prepared:
    """``build_corpus`` into a version folder below ``root`` that readers see whole or not at all; ``publish.current`` finds it."""
    with publication(spark, root, keep) as folder:
        return build_corpus(spark, source, folder, cfg, splits, fmt)


def show_summary(run: Prepared) -> None:
    """Print the run summary: rows per stage and per split."""
    counts = [thousands(F.col(c)).alias(c) for c in ("rows_in", "dropped", "remaining")]
    run.funnel.orderBy("step").select("stage", *counts, F.round("retention_pct", 1).alias("retention_pct")).show()
    run.split_counts().select("split", thousands(F.col("n")).alias("n"), F.round("pct", 1).alias("pct")).show()


def main(arguments: list[str] | None = None) -> None:
    cfg, splits = PrepConfig(), SplitConfig()
    parser = argparse.ArgumentParser(description="Prepare an instruction corpus from question/answer JSON lines.")
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--format", default="json", choices=("json", "parquet"))
    parser.add_argument("--min-question-len", type=int, default=cfg.min_question_len)
    parser.add_argument("--max-question-len", type=int, default=cfg.max_question_len)
    parser.add_argument("--min-answer-len", type=int, default=cfg.min_answer_len)
    parser.add_argument("--max-answer-len", type=int, default=cfg.max_answer_len)
    parser.add_argument("--min-question-score", type=int, default=cfg.min_question_score)
    parser.add_argument("--content-prefix", type=int, default=cfg.content_prefix, help="0: whole texts")
    parser.add_argument("--linked-duplicates", action="store_true", help="one row of all that a uid or content key connects")
    parser.add_argument("--seed", type=int, default=splits.seed)
    parser.add_argument("--keep-versions", type=int, default=0, help="publish below the output folder and keep so many versions; 0: replace in place")
    given = parser.parse_args(arguments)
    cfg = PrepConfig(
        given.min_question_len,
        given.max_question_len,
        given.min_answer_len,
        given.max_answer_len,
        given.min_question_score,
        given.content_prefix or None,
        given.linked_duplicates,
    )
    spark = SparkSession.builder.appName("corpus preparation").getOrCreate()
    with run_tables(spark):
        settings = (spark, given.input, given.output, cfg, SplitConfig(seed=given.seed), given.format)
        show_summary(publish_corpus(*settings, given.keep_versions) if given.keep_versions else build_corpus(*settings))


if __name__ == "__main__":
    main()
