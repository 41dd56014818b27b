import hashlib
import random

import pytest
from pyspark.sql import functions as F

from answerloom.config import SplitConfig
from answerloom.operators import quota, split


def digest(key):
    return hashlib.md5(f"42|{key}".encode()).hexdigest()


@pytest.mark.parametrize("few", [quota.FEW_ROWS, 3])
def test_samples_are_the_smallest_places(spark, few, monkeypatch):
    monkeypatch.setattr(quota, "FEW_ROWS", few)
    frame = spark.range(4_000).withColumn("place", F.lit("x"))
    want = sorted(range(4_000), key=digest)
    for k in (0, 1, 777, 3_999, 4_000, 9_000):
        assert sorted(r.id for r in quota.sample_exact(frame.repartition(3), "id", k).collect()) == sorted(want[:k])
    assert quota.sample_exact(frame, "id", 5).columns == frame.columns


def test_large_samples_plan_no_sort(spark, folder, monkeypatch):
    spark.range(50_000).write.parquet(folder + "/rows")
    rows = spark.read.parquet(folder + "/rows")
    frame = split.sample_k(rows, "id", 20_000)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("TakeOrdered", "Sort", "Exchange", "Limit")) and frame.count() == 20_000
    few = {r.id for r in split.sample_k(rows, "id", 10_000).collect()}
    assert few <= {r.id for r in frame.collect()}


@pytest.mark.parametrize("few", [quota.FEW_ROWS, 2])
def test_splits_hold_their_shares_on_any_layout(spark, few, monkeypatch):
    """A third of the rows share a key and are alike in all columns; some have no key."""
    monkeypatch.setattr(quota, "FEW_ROWS", few)
    rng = random.Random(5)
    rows = [("hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(1500)}",) for i in range(2_003)]
    frame = spark.createDataFrame(rows, "content_hash string")
    seen = []
    for layout in (frame.repartition(2), frame.repartition(7), frame.orderBy(F.desc_nulls_last("content_hash"))):
        found = quota.assign_split_exact(layout)
        counts = {r["split"]: r["count"] for r in found.groupBy("split").count().collect()}
        assert counts == {"train": 1602, "validation": 201, "test": 200}
        seen.append(sorted((str(r.content_hash), r["split"]) for r in found.collect()))
        assert split.leakage(found, ("content_hash",)).first().leaking_keys <= 2
    assert seen[0] == seen[1] == seen[2]
    odd = quota.assign_split_exact(frame, cfg=SplitConfig(1.0, 0.0, 0.0))
    assert odd.filter("split != 'train'").count() == 0
    assert quota.assign_split_exact(frame.limit(0)).collect() == []
