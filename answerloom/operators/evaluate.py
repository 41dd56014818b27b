"""Scored predictions: per-sample records, model averages, comparison and the most improved samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from answerloom.functions.scoring import exact_match, normalize_answer, rouge_l, rouge_text, step_proxy, token_f1
from answerloom.functions.text import preview

SIDES = ("base", "tuned")
METRICS = ("em", "f1", "rougeL", "has_steps")
QUESTION_CHARS = 200
ANSWER_CHARS = 300


def score_pairs(predictions: DataFrame) -> DataFrame:
    """Add em, f1, rougeL and has_steps to rows of (prediction, reference). A missing prediction scores 0 in each."""
    p, r = F.col("prediction"), F.col("reference")
    normalized = predictions.withColumns(
        {"_p": normalize_answer(p), "_r": normalize_answer(r), "_pt": rouge_text(p), "_rt": rouge_text(r)}
    )
    return normalized.withColumns(
        {
            "em": exact_match(F.col("_p"), F.col("_r")),
            "f1": token_f1(F.col("_p"), F.col("_r")),
            "rougeL": rouge_l(F.col("_pt"), F.col("_rt")),
            "has_steps": step_proxy(p),
        }
    ).drop("_p", "_r", "_pt", "_rt")


def score_summary(scored: DataFrame) -> DataFrame:
    """Sample count and mean of every metric per model, over all samples the model answered."""
    return scored.groupBy("model").agg(F.count("*").alias("n"), *[F.avg(m).alias(m) for m in METRICS])


def score_compare(deltas: DataFrame) -> DataFrame:
    """(metric, base, tuned, delta, n_paired, n_unpaired) from ``score_delta`` rows.

    Both models are averaged over the samples that both answered, so that the difference is one of models and not of
    samples; the others are counted. One aggregation of fixed width.
    """
    means = [F.avg(F.when(F.col("paired"), F.col(f"{side}_{m}"))).alias(f"{m}_{side}") for m in METRICS for side in SIDES]
    counts = [F.count_if("paired").alias("n_paired"), F.count_if(~F.col("paired")).alias("n_unpaired")]
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(f"{m}_base").alias("base"),
            F.col(f"{m}_tuned").alias("tuned"),
            (F.col(f"{m}_tuned") - F.col(f"{m}_base")).alias("delta"),
            "n_paired",
            "n_unpaired",
        )
        for m in METRICS
    ]
    return deltas.agg(*means, *counts).select(F.inline(F.array(*rows)))


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` itself, or ValueError when a key occurs twice."""
    twice = df.groupBy(*keys).count().filter(F.col("count") > 1).select(*keys).limit(1).collect()
    if twice:
        raise ValueError(f"{', '.join(keys)} is not unique: {tuple(twice[0])}")
    return df


def score_delta(scored: DataFrame, base: str = "base", tuned: str = "tuned") -> DataFrame:
    """Both models' results side by side per sample, ``paired`` when both answered, and ``delta``, the gain in F1.

    A sample that one model only answered has null results for the other and a null delta. A missing prediction is an
    answer that scores 0. ``scored`` holds each (model, sample_id) once; check with ``require_unique`` where that is not known.
    """
    results = ["prediction", *METRICS]

    def side(model: str, prefix: str) -> DataFrame:
        named = [F.col(c).alias(f"{prefix}_{c}") for c in ("instruction", "reference", *results)]
        return scored.filter(F.col("model") == model).select("sample_id", F.lit(True).alias(f"{prefix}_there"), *named)

    both = side(base, "base").join(side(tuned, "tuned"), "sample_id", "full")
    return both.select(
        "sample_id",
        *[F.coalesce(f"base_{c}", f"tuned_{c}").alias(c) for c in ("instruction", "reference")],
        *[f"{s}_{c}" for s in SIDES for c in results],
        (F.col("base_there") & F.col("tuned_there")).eqNullSafe(F.lit(True)).alias("paired"),
        (F.col("tuned_f1") - F.col("base_f1")).alias("delta"),
    )


def top_improved(deltas: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` paired samples with the largest F1 gain, ties by sample, ranked from 1, texts cut for reading."""
    top = deltas.filter("paired").orderBy(F.desc("delta"), "sample_id").limit(k)
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("delta"), "sample_id"))
    return top.select(
        rank.alias("rank"),
        "sample_id",
        preview(F.col("instruction"), QUESTION_CHARS).alias("instruction"),
        *[preview(F.col(c), ANSWER_CHARS).alias(c) for c in ("reference", "base_prediction", "tuned_prediction")],
        *[f"{side}_{m}" for side in SIDES for m in ("f1", "rougeL", "has_steps")],
        "delta",
    )


def final_loss(log: DataFrame) -> DataFrame:
    """The loss of the last logged step."""
    logged = log.filter(F.col("loss").isNotNull())
    return logged.agg(F.max("step").alias("step"), F.max_by("loss", "step").alias("loss"))
