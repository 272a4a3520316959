"""Neighbour graph: degree bound, the whole beam, equal vectors, recall, few rows."""

import numpy as np
import pytest

from reclab.operators.graph import NeighbourGraph
from tests.test_indexes import brute, frame, rows


def data():
    rng = np.random.RandomState(3)
    x = rng.standard_normal((150, 6)) * rng.randint(1, 4, size=(150, 1))
    x[100:] = x[7]  # a third of the rows are one vector
    x[0] = 0.0
    return x


def test_a_beam_of_everything_finds_everything_and_degree_is_held(spark):
    x = data()
    graph = NeighbourGraph(frame(spark, x), degree=4, rounds=2)
    assert graph.n_nodes == 100 and graph.n_items == 150
    assert graph.max_degree() <= 2 * 4 + 2
    found, share = graph.search(frame(spark, x[:20]), 5, beam=100, exclude_self=True)
    assert rows(found) == brute(x[:20], x, 5, own=True)
    assert share == pytest.approx(1.0)


def test_a_narrow_beam_scores_few_and_finds_most(spark):
    x = np.random.RandomState(5).standard_normal((400, 8))
    graph = NeighbourGraph(frame(spark, x), degree=8)
    found, share = graph.search(frame(spark, x[:30]), 5, beam=10)
    want = {(i, j) for i, j, _ in brute(x[:30], x, 5)}
    got = {(i, j) for i, j, _ in rows(found)}
    assert len(want & got) >= 0.9 * len(want) and share < 0.6
    assert graph.rounds >= 2


def test_few_and_no_items_and_limits(spark):
    x = np.array([[1.0, 0.0], [0.0, 2.0]])
    for n in (2, 1):
        found, _ = NeighbourGraph(frame(spark, x[:n]), degree=3).search(frame(spark, x), 5, beam=6)
        assert rows(found) == brute(x, x[:n], 5)
    none, share = NeighbourGraph(frame(spark, x).where("id < 0")).search(frame(spark, x))
    assert none.count() == 0 and share == 0.0
    with pytest.raises(ValueError, match="wider"):
        NeighbourGraph(frame(spark, x)).search(frame(spark, x), 5, beam=5)
