"""Order-preserving packing of all rows, in parallel and without shards.

Next-fit takes rows in order and closes a pack when the next row would exceed the budget. That looks sequential, but what a
run of rows does follows from one number, how full the pack is that is open when the run begins. Each run is
therefore summarised as a map from entry fill to exit fill and packs opened; the maps of a task's runs are composed, the tasks'
maps are followed from the first row on, one look-up a task, and then every run replays with its own entry. The packs are
those of one pass over all rows, however the rows are dealt.

A map is a step function: rising fills let ever fewer rows into the open pack, and all fills that let the same
number in go on alike. Where packs end follows from running sums by binary search, one step a pack.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.storage import BROADCAST_ROWS, discard, materialize

RUN_ROWS = 1 << 17


def following(budget: int) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """A function of token counts: their running sums, and for each row the row after a pack that starts with it.

    Made here rather than defined in the module, so that it travels to Python workers by value.
    """

    def packs(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = np.concatenate([np.zeros(1, n.dtype), np.cumsum(n)])
        fits = np.searchsorted(sums, sums[:-1] + budget, "right") - 1
        return sums, np.maximum(fits, np.arange(1, len(n) + 1))

    return packs


def _run_rows(budget: int, run_rows: int, id_type: pa.DataType):
    packs = following(budget)

    def summary(n: np.ndarray) -> tuple[list, list, list, int]:
        """(least fills, exits, packs opened) of the steps, and the run's sum.

        An exit of -1 stands for entry fill + sum: the open pack takes the whole run. Fills end at budget + 1, a pack that is over.
        """
        sums, after = packs(n)
        size = len(n)
        # Where the pack opened last starts, and how many are opened, from each row on: chains of doubling length.
        jump, opened = np.append(after, size), np.append(np.ones(size, np.int64), 0)
        last = np.arange(size + 1)
        while (jump[:-1] < size).any():
            last = np.where(jump < size, last[jump], last)
            opened = opened + opened[jump]
            jump = jump[jump]
        # Fills above budget - sums[k + 1] do not let row k in, so row k opens a pack.
        exits = np.minimum(sums[-1] - sums[last[:-1]], budget + 1)
        least = np.maximum(budget - sums[1:] + 1, 0)  # falls with k
        steps: dict[int, tuple[int, int]] = {}
        if sums[-1] <= budget:
            steps[0] = (-1, 0)
        for k in np.flatnonzero(np.append(True, least[1:] < least[:-1]))[::-1].tolist():
            steps[min(int(least[k]), budget + 1)] = (int(exits[k]), int(opened[k]))
        steps[budget + 1] = (int(exits[0]), int(opened[0]))
        fills, kept = [], []
        for fill in sorted(steps):
            if not kept or kept[-1] != steps[fill]:
                fills.append(fill)
                kept.append(steps[fill])
        return fills, [k[0] for k in kept], [k[1] for k in kept], int(sums[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        place = rows = 0

        def sent() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            n = table.column("n").to_numpy()
            fills, exits, opened, total = summary(n)
            lists = [(table.column("id").to_pylist(), id_type), (n, pa.int64()), (fills, pa.int64()), (exits, pa.int64()), (opened, pa.int64())]
            columns = [pa.array([table.column("part")[0].as_py()], pa.int32()), pa.array([place], pa.int32()), *(pa.array([v], pa.list_(t)) for v, t in lists), pa.array([total], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["part", "run", "ids", "n", "fills", "exits", "opened", "total"])

        for batch in batches:
            for k in range(0, batch.num_rows, run_rows):
                some = batch.slice(k, run_rows)
                if rows + some.num_rows > run_rows:
                    yield sent()
                    held, rows, place = [], 0, place + 1
                held.append(some)
                rows += some.num_rows
        if held:
            yield sent()

    return run


def _stepped(budget: int):
    """A function that takes one run's map: (fill, packs opened) after a run entered with ``fill``."""
    import bisect

    over = budget + 1

    def step(fill: int, fills: list[int], exits: list[int], opened: list[int], total: int) -> tuple[int, int]:
        k = bisect.bisect_right(fills, fill) - 1
        return (min(fill + total, over) if exits[k] < 0 else exits[k]), opened[k]

    return step


def _composed(budget: int):
    """(part, fills, exits, opened, total) of a part's runs in order, from one row a run."""
    step = _stepped(budget)

    def run(table: pa.Table) -> pa.Table:
        maps = [tuple(m.values()) for m in sorted(table.select(["run", "fills", "exits", "opened", "total"]).to_pylist(), key=lambda m: m["run"])]
        total = sum(m[4] for m in maps)
        # The steps of the whole begin where those of the first run do, or where a later run's are met by fills that pass.
        edges, passed = set(), 0
        for _, fills, exits, _, own in maps:
            edges |= {min(max(f - passed, 0), budget + 1) for f in fills}
            if exits[0] >= 0:
                break
            passed += own
        found: list[tuple[int, int, int]] = []
        for fill in sorted(edges | {0, budget + 1}):
            at, opened = fill, 0
            for _, *m in maps:
                at, more = step(at, *m)
                opened += more
            exit_ = -1 if opened == 0 and fill + total <= budget else at
            if not found or found[-1][1:] != (exit_, opened):
                found.append((fill, exit_, opened))
        parts = table.column("part").slice(0, 1).to_pylist()
        lists = [pa.array([[f[k] for f in found]], pa.list_(pa.int64())) for k in range(3)]
        return pa.Table.from_arrays([pa.array(parts, pa.int32()), *lists, pa.array([total], pa.int64())], names=["part", "fills", "exits", "opened", "total"])

    return run


def _entered(budget: int):
    """(part, run, fill, pack): what each run of a part is entered with, from the part's own entry."""
    step = _stepped(budget)

    def run(table: pa.Table) -> pa.Table:
        out = []
        for m in sorted(table.to_pylist(), key=lambda m: m["run"]):
            if not out:
                fill, pack = m["fill"], m["pack"]
            out.append((m["part"], m["run"], fill, pack))
            fill, more = step(fill, m["fills"], m["exits"], m["opened"], m["total"])
            pack += more
        columns = [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.int64()))]
        return pa.Table.from_arrays(columns, names=["part", "run", "fill", "pack"])

    return run


def _replayed(budget: int, id_type: pa.DataType):
    """(pack_id, part, run, whole, ids, n_tokens) of each run with its entry; the packs at its ends may not be whole."""
    packs = following(budget)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                n = batch.column("n")[k].values.to_numpy()
                ids = batch.column("ids")[k].values
                part, place, fill, pack = (batch.column(c)[k].as_py() for c in ("part", "run", "fill", "pack"))
                sums, after = packs(n)
                at = int(np.searchsorted(sums, budget - fill, "right")) - 1 if fill <= budget else 0
                after = after.tolist()
                starts = [0] if at > 0 else []
                numbers = [pack] if at > 0 else []
                while at < len(n):
                    pack += 1
                    starts.append(at)
                    numbers.append(pack)
                    at = after[at]
                ends = np.array([*starts[1:], len(n)])
                begin = np.array(starts)
                whole = np.ones(len(starts), bool)
                whole[-1] = False
                whole[0] &= numbers[0] != batch.column("pack")[k].as_py()
                columns = [
                    pa.array(numbers, pa.int64()), pa.array([part] * len(starts), pa.int32()), pa.array([place] * len(starts), pa.int32()), pa.array(whole),
                    pa.ListArray.from_arrays(pa.array(np.append(begin, len(n)), pa.int32()), ids.cast(id_type)), pa.array(sums[ends] - sums[begin], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["pack_id", "part", "run", "whole", "ids", "n_tokens"])

    return run


def pack_in_order(df: DataFrame, key: str, tokens: str, budget: int, parts: int | None = None) -> DataFrame:
    """(pack_id, ids, n_tokens): the rows in order of key, then of count, packed one after the other over the whole frame.

    Packs are numbered from 0. A row above the budget has a pack to itself. A null key or count, and a count below 0, is an error.
    The result does not depend on ``parts``, the number of tasks that share the rows. Only keys and counts are shuffled. The
    driver follows one map a part.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def checked(value: Column, what: str, good: Column) -> Column:
        return F.when(good, value).otherwise(F.raise_error(F.lit(f"a row to pack has no {what}")).cast("long" if what != "key" else "string"))

    given = F.col(tokens).cast("long")
    rows = df.select(F.coalesce(F.col(key), F.raise_error(F.lit("a row to pack has no key"))).alias("id"), checked(given, "token count", given >= 0).alias("n"))
    id_type = rows.schema["id"].dataType.simpleString()
    arrow_id = rows.limit(0).toArrow().schema.field("id").type
    ordered = rows.repartitionByRange(parts, "id", "n").sortWithinPartitions("id", "n").select(F.spark_partition_id().alias("part"), "id", "n")
    schema = f"part int, run int, ids array<{id_type}>, n array<long>, fills array<long>, exits array<long>, opened array<long>, total long"
    runs = materialize(ordered.mapInArrow(_run_rows(budget, RUN_ROWS, arrow_id), schema), "runs")
    maps = runs.select("part", "run", "fills", "exits", "opened", "total")
    composed = materialize(maps.groupBy("part").applyInArrow(_composed(budget), "part int, fills array<long>, exits array<long>, opened array<long>, total long"), "maps")

    step = _stepped(budget)
    fill, pack = budget + 1, -1  # nothing is open: the first row opens pack 0
    entries = []
    for m in composed.orderBy("part").toLocalIterator():  # a row per part, one partition at a time
        entries.append((m["part"], fill, pack))
        fill, more = step(fill, m["fills"], m["exits"], m["opened"], m["total"])
        pack += more
    by_part = F.broadcast(df.sparkSession.createDataFrame(entries, "part int, fill long, pack long"))
    entered = maps.join(by_part, "part").groupBy("part").applyInArrow(_entered(budget), "part int, run int, fill long, pack long")
    entered = materialize(entered, "entries")
    few = entered.count() <= BROADCAST_ROWS
    replayed = runs.select("part", "run", "ids", "n").join(F.broadcast(entered) if few else entered, ["part", "run"])
    found = replayed.mapInArrow(_replayed(budget, arrow_id), f"pack_id long, part int, run int, whole boolean, ids array<{id_type}>, n_tokens long")
    found = materialize(found, "packs")
    discard(runs, composed, entered)
    pieces = F.sort_array(F.collect_list(F.struct("part", "run", "ids")))
    cut = found.filter("NOT whole").groupBy("pack_id").agg(F.flatten(F.transform(pieces, lambda p: p["ids"])).alias("ids"), F.sum("n_tokens").alias("n_tokens"))
    return found.filter("whole").select("pack_id", "ids", "n_tokens").unionByName(cut)
