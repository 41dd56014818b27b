"""The preparation job: raw question/answer rows to a clean, split and profiled instruction corpus.

The raw input is read once. Its cleaned rows are written as a stage table, without a shuffle, and counted on the way. Duplicates are settled
on the stage's narrow key columns (two narrow shuffles), and the surviving row ids pick the wide rows. Everything
later reads the written clean table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from answerloom.config import PrepConfig, SplitConfig
from answerloom.functions.text import with_cleaned
from answerloom.operators.dedup import KEY_COLUMNS, dedup_content, dedup_uid
from answerloom.operators.filters import has_text, length_in_band, scored_enough, with_lengths
from answerloom.operators.funnel import funnel, require_rows
from answerloom.operators.linked import dedup_linked
from answerloom.operators.profile import (
    density_profile,
    display_share,
    features,
    length_histogram,
    quantiles,
    score_profile,
    summary,
    truncation_risk,
    value_counts,
)
from answerloom.operators.shape import key_columns, to_instruction
from answerloom.operators.split import assign_split, check_conservation, leakage, split_counts
from answerloom.sources.jsonl import require_columns, with_full_meta
from answerloom.storage import BROADCAST_ROWS, materialize

# How far a raw row got: it failed the empty, length or score filter, or passed all three.
EMPTY, SHORT_OR_LONG, LOW_SCORE, KEPT = range(4)

CLEAN_COLUMNS = ["instruction", "input", "output", "q_len", "a_len", "q_score", "a_count"]


@dataclass(frozen=True)
class Prepared:
    """Results of one run. ``clean`` holds the instruction rows with keys and split, ``stage`` every row's answer length."""

    clean: DataFrame
    stage: DataFrame
    funnel: DataFrame
    remaining: dict[str, int]
    cfg: SplitConfig

    def split(self, name: str) -> DataFrame:
        return self.clean.filter(F.col("split") == name)

    def split_counts(self) -> DataFrame:
        return check_conservation(split_counts(self.clean, self.cfg), self.remaining["content"])

    def leakage(self) -> DataFrame:
        return leakage(self.clean)

    def profile(self) -> dict[str, DataFrame]:
        """The corpus statistics and the data behind each chart of the report."""
        rows = materialize(features(self.clean), "features")
        counts = materialize(value_counts(rows, "q_len", "a_len", "q_score", "latex_total"), "value-counts")
        lengths = counts.filter(F.col("series").isin("q_len", "a_len"))
        return {
            "summary": summary(counts),
            "quantiles": quantiles(lengths),
            "length_histogram": length_histogram(lengths),
            "score_profile": score_profile(rows),
            "density_profile": density_profile(rows),
            "display_share": display_share(rows),
            # Answers that a length limit would cut, counted before the length filter drops them.
            "truncation_risk": truncation_risk(self.stage.filter(F.col("reached") > EMPTY), "answer_chars"),
        }


def stage_rows(raw: DataFrame, cfg: PrepConfig = PrepConfig(), carry: tuple[str, ...] = ()) -> DataFrame:
    """Every raw row with how far it ``reached`` and its ``answer_chars``; cleaned text and keys only where it passed all
    row filters.

    Rows without text are not cleaned, and keys are worked out only for rows that pass.
    """
    rows = with_full_meta(require_columns(raw, "Q", "A")).select(*carry, "Q", "A", "meta")
    present = has_text(F.col("Q"), F.col("A"))
    rows = rows.withColumn("present", present)
    rows = rows.withColumns({c: F.when(F.col("present"), F.col(c)) for c in ("Q", "A")})
    staged = with_lengths(with_cleaned(rows, "Q", "A"))
    reached = (
        F.when(~F.col("present"), EMPTY)
        .when(~length_in_band(F.col("q_len"), F.col("a_len"), cfg), SHORT_OR_LONG)
        .when(~scored_enough(F.col("meta.question_score"), cfg), LOW_SCORE)
        .otherwise(KEPT)
    )
    kept = {c: F.col(c) for c in ("Q", "A", "q_len", "a_len")} | key_columns(cfg.content_prefix)
    return staged.withColumn("reached", reached.cast("byte")).select(
        *carry, "reached", F.col("a_len").alias("answer_chars"), *[F.when(F.col("reached") == KEPT, c).alias(name) for name, c in kept.items()]
    )


def prepare(
    raw: DataFrame,
    cfg: PrepConfig = PrepConfig(),
    splits: SplitConfig = SplitConfig(),
    row_id: str | None = None,
) -> Prepared:
    """Run the job on a frame of Q, A and optional meta.

    ``row_id`` names a column that settles ties between copies and is kept. Ids of the job's own, handed out as the
    stage is written, come last: they decide only between copies that agree in every kept column.
    """
    spark = raw.sparkSession
    carry = (row_id,) if row_id else ()
    ties = (*carry, "a_count", "uid", "stage_id")
    stage = stage_rows(raw, cfg, carry).withColumn("stage_id", F.monotonically_increasing_id())
    # Counted while the stage is written: a task's counts come with its success, so a retry does not count twice.
    seen = Observation()
    stage = materialize(stage.observe(seen, *[F.count_if(F.col("reached") == k).alias(f"reached_{k}") for k in range(KEPT + 1)]), "stage")
    by_reach = {k: seen.get[f"reached_{k}"] for k in range(KEPT + 1)}

    kept = stage.filter(F.col("reached") == KEPT)
    # As bytes the digests order like their hex text at half the size.
    digests = {c: F.unhex(c) for c in ("content_hash", "text_md5")}
    narrow = kept.select(*KEY_COLUMNS, *ties[:-2], "stage_id").withColumns(digests)
    by_uid = materialize(dedup_uid(narrow, ties), "by-uid")
    survivors = dedup_linked(materialize(narrow, "keys"), ties) if cfg.linked_duplicates else dedup_content(by_uid, ties)
    survivors = materialize(survivors.select("stage_id"), "survivors")
    n_uid, n_content = by_uid.count(), survivors.count()

    # Beyond the broadcast bound both sides are sorted, which spills where a hashed side would have to fit in memory.
    chosen = survivors.hint("broadcast" if n_content <= BROADCAST_ROWS else "merge")
    rows = kept.join(chosen, "stage_id", "left_semi")
    clean = assign_split(to_instruction(rows, *carry, "uid", "content_hash"), "content_hash", splits)

    remaining = {"raw": sum(by_reach.values())}
    for stage_name, failed in (("empty", EMPTY), ("length", SHORT_OR_LONG), ("score", LOW_SCORE)):
        remaining[stage_name] = sum(n for reach, n in by_reach.items() if reach > failed)
    remaining |= {"uid": n_uid, "content": n_content}
    require_rows(remaining)
    return Prepared(materialize(clean, "clean"), stage.select("reached", "answer_chars"), funnel(spark, remaining), remaining, splits)
