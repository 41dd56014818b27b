import random

from answerloom.operators import sketches


def near(values, share, found, error=0.01):
    below, up_to = (sum(test(v) for v in values) / len(values) for test in (lambda v: v < found, lambda v: v <= found))
    return below - error <= share <= up_to + error


def test_merged_batches_agree_with_the_whole(spark, folder):
    rng = random.Random(1)
    values = [int(rng.expovariate(0.001)) for _ in range(20_000)] + [7] * 10_000 + [-5, 10**12]
    frame = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)], "a long, part int").selectExpr("a", "part", "a * 2 AS b", "CAST(NULL AS int) AS none").repartition(6)
    store = f"{folder}/store"
    for part in (0, 1, 2):
        sketches.add_batch(frame.filter(f"part = {part}"), store, f"p{part}", "a", "b", "none")
    whole = sketches.sketch(frame, "a", "b")
    for found in (whole, sketches.merged(spark, store)):
        assert {(r.series, r.n, r.low, r.high) for r in found.collect()} == {("a", len(values), -5, 10**12), ("b", len(values), -10, 2 * 10**12)}
        for r in sketches.sketch_quantiles(found, 0.0, 0.01, 0.3, 0.5, 0.99, 1.0).collect():
            assert near(values, r.share, r.quantile if r.series == "a" else r.quantile / 2)
    # A batch that is added again takes its own place.
    sketches.add_batch(frame.filter("part = 1"), store, "p1", "a", "b")
    assert sketches.merged(spark, store).first().n == len(values)
    some = sketches.merged(spark, store, ["p0"]).filter("series = 'a'").first()
    assert some.n == sum(i % 3 == 0 for i in range(len(values)))


def test_histogram(spark):
    values = [i % 100 for i in range(30_000)]
    found = sketches.sketch_histogram(sketches.sketch(spark.createDataFrame([(v,) for v in values], "a int"), "a"), [0, 9, 49, 98, 99, 500])
    counts = {r.bin: r.n for r in found.collect()}
    for k, (lo, hi) in enumerate([(-1, 9), (9, 49), (49, 98), (98, 99), (99, 500)]):
        assert abs(counts[k] - sum(lo < v <= hi for v in values)) <= 0.02 * len(values)
    assert sum(counts.values()) == len(values)


def test_no_rows(spark):
    assert sketches.sketch(spark.createDataFrame([], "a int"), "a").collect() == []
