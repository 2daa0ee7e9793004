"""Packing keeps every item, no container overflows, and little space is left."""

from collections import defaultdict

import numpy as np
import pytest

from curlew.llm.packing import combinations, fitted, pack, plan


def check(rows, capacity, items):
    """rows: (key, piece_no, size, container)."""
    whole, filled = defaultdict(int), defaultdict(int)
    for key, _, size, container in rows:
        assert 0 <= size <= capacity
        whole[key] += size
        filled[container] += size
    assert dict(whole) == {k: n or 0 for k, n in items}
    assert all(n <= capacity for n in filled.values())
    return filled


@pytest.mark.parametrize("capacity,scale", [(2048, 400), (100, 30), (7, 5), (1000, 2), (515, 300)])
def test_items_fit(spark, capacity, scale):
    r = np.random.default_rng(capacity)
    items = [(i, int(n)) for i, n in enumerate(r.lognormal(np.log(scale), 1.0, 2500))]
    rows = pack(spark.createDataFrame([(*x, 1, 2) for x in items], "doc_id long, n_tokens long, _u long, container_id long"), capacity).collect()
    filled = check(rows, capacity, items)
    pieces = defaultdict(set)
    for key, piece, _, _ in rows:
        pieces[key].add(piece)
    assert all(pieces[k] == set(range(max(1, -(-n // capacity)))) for k, n in items)
    needed = -(-sum(n for _, n in items) // capacity)
    assert len([c for c, n in filled.items() if n]) <= needed * 1.05 + 2


def test_zero_null_repeated_and_hot_sizes(spark):
    items = [(i, 300) for i in range(700)] + [(1000, 0), (1001, None), (1002, 0)]
    rows = pack(spark.createDataFrame(items, "doc_id long, n_tokens long"), 1000).collect()
    assert len(rows) == len(items)
    assert len(check(rows, 1000, items)) == 234
    twice = pack(spark.createDataFrame([(1, 600), (1, 600)], "doc_id long, n_tokens long"), 1000).collect()
    assert len({r["container_id"] for r in twice}) == 2
    assert {r["container_id"] for r in pack(spark.createDataFrame([(1, 0), (2, None)], "doc_id long, n_tokens long"), 10).collect()} == {0}


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, n_tokens long"), 10).count() == 0
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([], "doc_id long, n_tokens long"), 0)


def test_plan_uses_up_the_histogram():
    r = np.random.default_rng(3)
    histogram = r.integers(0, 50, 65)
    chosen = plan(histogram)
    used = np.zeros(65, int)
    for content, times in chosen:
        assert sum(u * m for u, m in content.items()) <= 64
        for u, m in content.items():
            used[u] += m * times
    assert (used[1:] == histogram[1:]).all()


def test_combinations_fill_the_window():
    found = {tuple(c) for c in combinations(12, 1)}
    assert found == {(a, b, c) for a in range(13) for b in range(a + 1) for c in range(b + 1) if a + b + c in (11, 12)}


def test_lengths_that_do_not_come_out_even():
    histogram = np.zeros(513, int)
    histogram[[240, 37, 130]] = [100_000, 20_000, 70_000]
    containers = lambda chosen: sum(times for _, times in chosen)
    assert containers(plan(histogram)) < 0.96 * containers(fitted(histogram, (0,)))
    used = np.zeros(513, int)
    for content, times in plan(histogram):
        assert sum(u * m for u, m in content.items()) <= 512
        for u, m in content.items():
            used[u] += m * times
    assert (used == histogram).all()
