import numpy as np
import pytest

from cohortica.operators import cluster, linkage
from tests.test_linkage import ABC, frame, labels_of, matrix, same_parts


@pytest.mark.parametrize("distance", linkage.DISTANCES)
def test_more_rows_than_are_linked_in_one_task_are_linked_exactly(spark, distance, monkeypatch):
    """One mass without gaps: any lumping of rows would move some to other clusters."""
    monkeypatch.setattr(linkage, "CELL_CLUSTERS", 25)
    monkeypatch.setattr(linkage, "MET_ROWS", 16)
    rng = np.random.default_rng(12)
    x = np.round(rng.normal(0, 1, (260, 3)) * [1, 20, 0.2], 6)
    x = np.vstack([x, x[:15], [[30, -300, 9], [34, -300, 9]]])  # copies, and two far rows that merge early and high
    want = cluster.cut(cluster.average_linkage(matrix(x, distance)), len(x), 4)
    got = labels_of(linkage.average_linkage_rows(frame(spark, x), "id", ABC, 4, distance, most=90))
    assert len(got) == len(x) and same_parts(got, want)
