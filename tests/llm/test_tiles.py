"""Many small tiles of embeddings, over several cells of the grid."""

import numpy as np
import pytest

from quire.llm import embeddings


@pytest.mark.parametrize("bits", [0, 2])
def test_tiles_in_cells_find_every_link(spark, monkeypatch, bits):
    monkeypatch.setattr(embeddings, "TILE", 16)
    monkeypatch.setattr(embeddings, "GROUP_BITS", bits)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(25, 12))
    x = np.repeat(centres, 20, axis=0) + 0.12 * rng.normal(size=(500, 12))
    x[40:45] = x[40]  # copies
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.95) & ~np.eye(500, dtype=bool)
    roots = np.arange(500)
    while True:
        lower = np.minimum(roots, np.where(near, roots, 500).min(axis=1))
        if (lower == roots).all():
            break
        roots = lower
    found = sorted(map(tuple, embeddings.near_duplicates(frame).collect()))
    assert found == [(i, int(near[i].sum()), int(roots[i]), bool(roots[i] == i)) for i in range(500)]
    assert near.sum() > 1000
