"""The span classifier's fit over large counts."""

import numpy as np

from tutorlake.llm import pii


def test_fit_follows_large_counts(monkeypatch):
    """Where the targets do not follow from the votes one by one, the frequent combinations decide, at any size."""
    rng = np.random.default_rng(4)
    keys = sorted({pii._key(pii.KINDS[rng.integers(3, len(pii.KINDS))], tuple(rng.integers(-1, 2, len(pii.LABELERS)).tolist()), int(rng.integers(1, 40)))
                   for _ in range(400)})
    counts, target = np.exp(rng.uniform(4, 14, len(keys))).astype(int), rng.uniform(size=len(keys))
    monkeypatch.setattr(pii, "reliabilities", lambda *_: (None, target))
    small, large = (pii.train([{"key": k, "n": int(n) * times} for k, n in zip(keys, counts)]) for times in (1, 1000))
    assert max(abs(small[k] - large[k]) for k in keys) < 0.02
    fitted = np.array([large[k] for k in keys])
    assert abs(np.average(fitted, weights=counts) - np.average(target, weights=counts)) < 0.001
