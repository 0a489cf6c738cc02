from __future__ import annotations

import tracemalloc

import numpy as np

from tallyward.llm.language import FEATURES, _machine


def test_a_machine_holds_no_second_matrix():
    draw = np.random.default_rng(3)
    x, y = draw.random((400, FEATURES)), np.where(np.arange(400) % 2, 1.0, -1.0)
    tracemalloc.start()
    _machine(x, y)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < x.nbytes / 2
