"""The n-gram fit has its whole sample and sums it in parts."""

import numpy as np

from riskspark.llm import quality_rules as Q


def test_sample_and_parts(monkeypatch):
    assert Q.SAMPLE == 2000
    rng = np.random.default_rng(1)
    to, at = rng.integers(0, 50, 1000, dtype=np.int32), rng.integers(0, 80, 1000, dtype=np.int32)
    val, x = rng.random(1000, dtype=np.float32), rng.random(80)
    want = np.bincount(to, val * x[at], minlength=60)
    for part in (1, 7, 1000, 4096):
        monkeypatch.setattr(Q, "PART", part)
        assert np.allclose(Q._summed(to, at, val, x, 60), want, rtol=1e-12)
    assert (Q._summed(to[:0], at[:0], val[:0], x, 60) == np.zeros(60)).all()
