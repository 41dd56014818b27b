"""Scores of two models' predictions on the same samples, and the reports made from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from answerloom.operators.evaluate import (
    require_unique,
    score_compare,
    score_delta,
    score_pairs,
    score_summary,
    top_improved,
)
from answerloom.storage import materialize


@dataclass(frozen=True)
class Evaluation:
    """``scored`` holds one record per model and sample."""

    scored: DataFrame
    summary: DataFrame
    comparison: DataFrame
    deltas: DataFrame
    top: DataFrame


def evaluate_predictions(
    predictions: DataFrame, base: str = "base", tuned: str = "tuned", k: int = 5
) -> Evaluation:
    """Score rows of (sample_id, model, instruction, reference, prediction).

    The scores, and the models side by side, are written once; every report reads them.
    """
    scored = materialize(score_pairs(predictions), "scored")
    require_unique(scored, "model", "sample_id")
    deltas = materialize(score_delta(scored, base, tuned), "deltas")
    return Evaluation(scored, score_summary(scored), score_compare(deltas), deltas, top_improved(deltas, k))
