import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from answerloom.operators import profile


@pytest.fixture(scope="module")
def lengths():
    rng = random.Random(5)
    return pd.DataFrame(
        {
            "q_len": [rng.randrange(0, 1500) for _ in range(3001)],
            "a_len": [int(rng.paretovariate(1.2) * 100) for _ in range(3001)],
            "q_score": [rng.choice([5, 6, 9, 10, 49, 50, 120]) for _ in range(3001)],
            "latex_total": [rng.choice([0, 0, 1, 2, 3, 6, 7, 14, 15, 30, 31, 200]) for _ in range(3001)],
        }
    )


@pytest.fixture(scope="module")
def frame(spark, lengths):
    return spark.createDataFrame(lengths.astype("int64")).withColumns({c: F.col(c).cast("int") for c in lengths})


def test_summary_and_quantiles(frame, lengths):
    counts = profile.value_counts(frame, *lengths.columns)
    for row in profile.summary(counts).collect():
        column = lengths[row.series]
        assert (row.n, row.n_zero, row["max"]) == (len(column), (column == 0).sum(), column.max())
        assert (row["mean"], row["median"]) == pytest.approx((column.mean(), column.median()))
    for row in profile.quantiles(counts, 0.99).collect():
        assert row.quantile == pytest.approx(np.quantile(lengths[row.series], 0.99))
    for row in profile.approx_quantiles(frame, "q_len", "a_len").collect():
        assert row.quantile == pytest.approx(np.quantile(lengths[row.series], 0.99), rel=0.05)


def check_histogram(frame, lengths):
    table = profile.length_histogram(profile.value_counts(frame, "q_len", "a_len")).toPandas()
    tops = {c: np.quantile(lengths[c], 0.99) for c in ("q_len", "a_len")}
    edges = np.linspace(0, max(tops.values()), profile.BINS + 1)
    for c, top in tops.items():
        mine = table[table.series == c].sort_values("bin")
        expected, _ = np.histogram(lengths[c].clip(upper=top), bins=edges)
        assert mine.n.tolist() == expected.tolist()
        assert np.allclose(mine.lo, edges[:-1]) and np.allclose(mine.hi, edges[1:])


def test_histogram(frame, lengths):
    check_histogram(frame, lengths)


def test_histogram_of_values_on_bin_edges(spark):
    lengths = pd.DataFrame({"q_len": [*range(0, 391)] * 3, "a_len": [390] * 1173})
    check_histogram(spark.createDataFrame(lengths), lengths)


def test_histogram_of_zeros(spark):
    lengths = pd.DataFrame({"q_len": [0, 0], "a_len": [0, 0]})
    check_histogram(spark.createDataFrame(lengths), lengths)


@pytest.mark.parametrize("top", [0, 4, 7, 49, 50, 199, 200, 1000])
def test_score_profile(frame, lengths, top):
    chosen = lengths.copy()
    chosen["q_score"] = [top, *[min(s, top) for s in lengths.q_score[1:]]]
    rows = profile.score_profile(frame.sparkSession.createDataFrame(chosen.astype("int64"))).collect()
    edges = [e for e in (0, 1, 5, 10, 50, 200) if e <= top] + [top + 1]
    cut = pd.cut(chosen.q_score, bins=edges, right=False)
    expected = chosen.groupby(cut, observed=False).a_len.agg(["size", "mean"]).fillna(0)
    assert [r.n for r in rows] == expected["size"].tolist()
    assert [r.avg_a_len for r in rows] == pytest.approx(expected["mean"].tolist())


def test_negative_scores_have_a_bucket(spark):
    rows = spark.createDataFrame([(-3, 10), (-1, 20), (2, 5)], "q_score int, a_len int")
    found = {r.bucket: (r.n, r.avg_a_len) for r in profile.score_profile(rows).collect()}
    assert found == {"below 0": (2, 15.0), "0": (0, 0.0), "1-4": (1, 5.0)}


def test_density_profile(frame, lengths):
    rows = {r.bucket: (r.n, r.pct) for r in profile.density_profile(frame).collect()}
    bounds = {"0": (0, 0), "1-2": (1, 2), "3-6": (3, 6), "7-14": (7, 14), "15-30": (15, 30), "31+": (31, 10**9)}
    for label, (lo, hi) in bounds.items():
        n = int(lengths.latex_total.between(lo, hi).sum())
        assert rows[label] == (n, pytest.approx(100 * n / len(lengths)))


def test_shares(spark):
    frame = spark.createDataFrame([(0, False, 10), (3, True, 4001), (1, False, 4000), (2, False, 1)], "latex_total int, has_display boolean, len int")
    assert tuple(profile.display_share(frame).first()) == (1, 25.0)
    assert tuple(profile.truncation_risk(frame, "len").first()) == (4, 1, 25.0)
    assert tuple(profile.display_share(frame.limit(0)).first()) == (0, 0.0)


def test_counting_is_one_aggregation(frame):
    plan = profile.summary(profile.value_counts(frame, "q_len", "a_len"))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[series#" in plan and "partial_count" in plan and plan.count("Scan ") == 1
