"""Checking many surviving pairs of wide vectors takes bounded memory."""

import tracemalloc

import numpy as np

from ordertide.llm import pcadedup


def test_pairs_of_wide_near_copies_are_checked_in_slices():
    rng = np.random.default_rng(3)
    u = rng.normal(size=768) + 1e-3 * rng.normal(size=(400, 768))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    side = {"z": u, "u": u}
    tracemalloc.start()
    i, j = pcadedup.close_pairs(side, side, 0.99)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(i) == 400 * 400
    assert peak < 160e6  # all pairs at once: 2 x 0.98 GB
