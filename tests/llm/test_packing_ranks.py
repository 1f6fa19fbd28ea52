"""A seed's neighbours against a ranking of all unused tails."""

import numpy as np
import pytest

from gondola.llm import packing


@pytest.mark.parametrize("candidates", [1, 3, 384])
def test_neighbours_are_the_best_of_all_free_tails(candidates):
    """Few tails share a rare id with the seed; the best ones share common ids alone."""
    r = np.random.default_rng(3)
    tails = [np.concatenate([r.choice(40, 25, replace=False), 1000 + r.choice(400, 3, replace=False)]) for _ in range(200)]
    counted = [np.unique(t, return_counts=True) for t in tails]
    held = np.bincount(np.concatenate([c[0] for c in counted]), minlength=packing.IDS)
    idf = np.log(1 + (200 - held + 0.5) / (held + 0.5))
    index = packing.Index(counted, np.array([len(t) for t in tails]), idf, 28.0, candidates)
    free = r.random(200) < 0.8
    for seed in range(50):
        score = index.scores(index.terms[seed], np.arange(200))
        given = index.nearest(index.terms[seed], free)
        assert len(given) == min(candidates, free.sum()) and free[given].all()
        assert np.allclose(score[given], np.sort(score[free])[::-1][: len(given)], rtol=1e-5)
