import random
import zlib
from collections import Counter, defaultdict

from answerloom.llm import sharding


def plain_best_fit(sizes, capacity):
    bins, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fitting = [(room, b) for b, room in enumerate(bins) if room >= sizes[i]]
        if fitting:
            b = min(fitting)[1]
        else:
            b = len(bins)
            bins.append(capacity)
        bins[b] = max(0, bins[b] - sizes[i])
        out[i] = b
    return out


def test_best_fit_against_a_plain_search():
    rng = random.Random(3)
    for _ in range(50):
        sizes = [rng.randint(0, 40) for _ in range(rng.randint(0, 80))]
        assert sharding.best_fit_decreasing(sizes, 50) == plain_best_fit(sizes, 50)


def test_fewest_bins_within_the_capacity():
    sizes = [50, 50, 49, 49, 48, 48, 2, 2, 1, 1]
    assert max(sharding.best_fit_decreasing(sizes, 100)) == 2
    assert max(sharding.pack_into(sizes, 3)) == 2
    assert sharding.pack_into([], 3) == []


def test_all_bins_are_used_beside_an_oversized_item():
    bins = sharding.pack_into([100] + [1] * 90, 10)
    filled = Counter(bins)
    assert filled[bins[0]] == 1 and sorted(filled.values()) == [1] + [10] * 9


def test_shards_of_documents(documents, rows):
    found = sharding.shard(documents, n_shards=4).collect()
    assert Counter((x.doc_id, x.size, x.text_crc32) for x in found) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows
    )
    slots, groups = defaultdict(list), defaultdict(set)
    for x in found:
        slots[x.shard].append(x.slot)
        groups[x.text_crc32].add(x.shard)
    assert set(slots) <= set(range(4))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(g) == 1 for g in groups.values())


def test_a_group_beyond_a_shard_is_split_evenly(spark):
    rows = [(i, "copy " * 20) for i in range(3000)] + [(10_000 + i, f"text {i} " * (i % 30)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sharding.shard(df, n_shards=10).collect()
    sizes, slots = Counter(), defaultdict(list)
    for x in found:
        sizes[x.shard] += x.size
        slots[x.shard].append(x.slot)
    assert len(found) == 6000 and len(sizes) == 10
    assert max(sizes.values()) <= 1.02 * min(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty_table(nothing):
    assert sharding.shard(nothing).collect() == []
