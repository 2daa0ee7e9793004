"""Filling fixed-capacity containers with items (problem 8).

Lengths are rounded up to a grid, so that everything planned is a histogram whose
size depends on the grid alone. Combinations of at most three lengths that fill a
container are enumerated, a non-negative least-squares fit says how often each is
to be used, the counts are rounded down to what the histogram can serve, and what
remains is packed greedily, largest first, again by counts. The plan is a few
thousand rows at any number of items.

Items get their places without ever gathering a length: they are numbered within
(length, bucket), the buckets' sizes give each bucket its offset, and a number looks
up its container in the plan. A length that a third of all items share is spread
over all buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curlew.llm.tokenizer import count_tokens
from curlew.session import materialize, shuffle_partitions

#: Steps of the length grid in a container.
GRID = 512
#: Steps that combinations may leave free in the second fit, and the part of the needed containers by which the first may miss them.
WINDOW, MISS = 16, 0.005


def combinations(units: int, window: int = 0) -> np.ndarray:
    """All length combinations of depth three or less whose sum lies in [units - window, units]; 0 marks an empty place."""
    out = []
    for total in range(units - window, units + 1):
        for a in range((total + 2) // 3, total + 1):
            rest = total - a
            for b in range((rest + 1) // 2, min(a, rest) + 1):
                out.append((a, b, rest - b))
    return np.array(out, np.int64)


def fit_repeats(combos: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares of combination counts against the histogram, by accelerated projected gradient.

    A combination has three places at most, so both products are gathers and
    bincounts. Places of length 0 weigh nothing.
    """
    size = len(histogram)
    weight = np.ones(size)
    weight[0] = 0.0
    cover = lambda x: np.bincount(combos.ravel(), np.repeat(x, combos.shape[1]), size)
    step = 1.0 / max(1e-9, (np.bincount(combos.ravel(), minlength=size) * weight).max() * combos.shape[1])
    x, y, t = np.zeros(len(combos)), np.zeros(len(combos)), 1.0
    for _ in range(rounds):
        miss = (cover(y) - histogram) * weight
        new = np.maximum(0.0, y - step * miss[combos].sum(axis=1))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        x, y, t = new, new + (t - 1) / t_new * (new - x), t_new
    return x


def plan(histogram: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """[(lengths of a container with their numbers, repeats)] that use up a histogram of grid lengths 1..units exactly.

    Combinations that fill a container are fitted first. Where lengths don't come
    out even and the containers are ``MISS`` more than the lengths need, those that
    leave up to ``WINDOW`` steps free are fitted after them, and the better plan holds.
    """
    units = len(histogram) - 1
    size = lambda chosen: sum(times for _, times in chosen)
    full = fitted(histogram, (0,))
    if size(full) <= (1 + MISS) * (histogram.astype(np.int64) @ np.arange(units + 1)) / max(1, units) + 1:
        return full
    return min(full, fitted(histogram, (0, min(WINDOW, units - 1))), key=size)


def fitted(histogram: np.ndarray, windows: tuple[int, ...]) -> list[tuple[dict[int, int], int]]:
    """A plan by one least-squares fit for each window, and the rest greedily."""
    units = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    chosen: list[tuple[dict[int, int], int]] = []

    def use(content: dict[int, int], times: int) -> None:
        times = min([times, *(left[u] // m for u, m in content.items())])
        if times > 0:
            for u, m in content.items():
                left[u] -= times * m
            chosen.append((content, int(times)))

    for window in windows:
        if not left.any():
            break
        combos = combinations(units, window)
        served = (left[combos] > 0) | (combos == 0)
        combos = combos[served.all(axis=1)]
        if len(combos):
            repeats = np.floor(fit_repeats(combos, left.astype(float)) + 1e-6).astype(np.int64)
            for i in np.argsort(-repeats, kind="stable"):
                if repeats[i] <= 0:
                    break
                content: dict[int, int] = {}
                for u in combos[i]:
                    if u:
                        content[int(u)] = content.get(int(u), 0) + 1
                use(content, int(repeats[i]))
    # Greedy, largest first: each round uses up at least one length.
    while left.any():
        space, content = units, {}
        room = left.copy()
        while space:
            fitting = np.flatnonzero(room[: space + 1])
            if not len(fitting):
                break
            u = int(fitting[-1])
            m = int(min(room[u], space // u))
            content[u] = m
            room[u] = 0
            space -= m * u
        use(content, int(left.max()))
    return chosen


def places(chosen: list[tuple[dict[int, int], int]], units: int) -> tuple[dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], int]:
    """For each grid length the starts of its number ranges, their first containers and items in a container; and the number of containers."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    taken = np.zeros(units + 1, np.int64)
    container = 0
    for content, times in chosen:
        for u, m in content.items():
            rows.setdefault(u, []).append((int(taken[u]), container, m))
            taken[u] += m * times
        container += times
    return {u: tuple(np.array(c, np.int64) for c in zip(*r)) for u, r in rows.items()}, container


def split_items(sizes: DataFrame, capacity: int, key: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """(key, piece_no, size): items of at most ``capacity``; a larger one becomes full pieces and a rest."""
    pieces = F.greatest(F.lit(1), F.ceil(F.col(size) / F.lit(capacity))).cast("int")
    return sizes.select(key, size, F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece_no")).select(key, "piece_no", F.least(F.lit(capacity).cast("long"), F.col(size) - F.col("piece_no") * F.lit(capacity).cast("long")).alias(size))


def pack(sizes: DataFrame, capacity: int = 2048, key: str = "doc_id", size: str = "n_tokens", buckets: int | None = None) -> DataFrame:
    """(key, piece_no, size, container_id): every item of (key, size) in a container of ``capacity``.

    An item larger than ``capacity`` is cut into full pieces and a rest; all others
    stay whole. Null sizes count as 0. Items of size 0 need no space and are dealt
    evenly to the containers (to container 0 if there are none). Repeated rows are
    items of their own. An empty table gives an empty result.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    spark = sizes.sparkSession
    step = max(1, -(-capacity // GRID))
    units = -(-capacity // step)
    # A grid length must fit: the last one stands for sizes that only fit alone.
    grid = F.least(F.ceil(F.col(size) / F.lit(step)), F.lit(units)).cast("int")
    buckets = buckets or 4 * shuffle_partitions(spark)
    items = split_items(sizes.select(key, F.coalesce(F.col(size).cast("long"), F.lit(0)).alias(size)), capacity, key, size)
    items = materialize(items.withColumn("_u", grid).withColumn("_b", F.pmod(F.xxhash64(key, "piece_no"), F.lit(buckets)).cast("int")), "items")
    counts = items.groupBy("_u", "_b").agg(F.count(F.lit(1)).alias("_n"))
    offsets = materialize(counts.select("_u", "_b", "_n", (F.sum("_n").over(Window.partitionBy("_u").orderBy("_b")) - F.col("_n")).alias("_offset")), "offsets")
    histogram = np.zeros(units + 1, np.int64)
    for u, n in offsets.groupBy("_u").agg(F.sum("_n")).collect():  # at most GRID + 1 rows
        histogram[u] = n
    # capacity may be less than units * step; grid sums must stay within whole steps of it.
    lookup, containers = places(plan_within(histogram, capacity // step, units), units)
    shared = spark.sparkContext.broadcast((lookup, containers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, total = shared.value
        for batch in batches:
            unit, number = (batch.column(i).to_numpy() for i in (3, 4))
            out = number % max(1, total)
            for u in np.unique(unit[unit > 0]):
                mine = unit == u
                start, first, each = ranges[int(u)]
                at = np.searchsorted(start, number[mine], side="right") - 1
                out[mine] = first[at] + (number[mine] - start[at]) // each[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.int64())], names=[key, "piece_no", size, "container_id"])

    schema = items.select(key, "piece_no", size).schema.add("container_id", "long")
    placed = items.withColumn("_i", F.row_number().over(Window.partitionBy("_u", "_b").orderBy(key, "piece_no")))
    numbered = placed.join(offsets.select("_u", "_b", "_offset"), ["_u", "_b"]).select(key, "piece_no", size, "_u", (F.col("_offset") + F.col("_i") - 1).alias("_number"))
    return numbered.mapInArrow(run, schema)


def plan_within(histogram: np.ndarray, whole: int, units: int) -> list[tuple[dict[int, int], int]]:
    """The plan for containers of ``whole`` grid steps; a length of ``units`` > ``whole`` steps (a last, partial step) goes alone."""
    alone = [({units: 1}, int(histogram[units]))] if units > whole and histogram[units] else []
    return alone + plan(histogram[: whole + 1])


def pack_documents(documents: DataFrame, capacity: int = 2048, path: str | None = None) -> DataFrame:
    """The texts of ``documents`` in containers of ``capacity`` tokens; see ``pack``."""
    return pack(count_tokens(documents, path=path), capacity)
