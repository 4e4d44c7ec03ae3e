import collections

import numpy as np
import pytest

from qaloom.llm import alignment


@pytest.mark.parametrize("wide, held", [(1 << 10, 1 << 22), (2, 64)])
def test_pairs_of_groups_of_every_width(monkeypatch, wide, held):
    monkeypatch.setattr(alignment, "WIDE_GROUP", wide)
    monkeypatch.setattr(alignment, "HELD_PAIRS", held)
    rng = np.random.default_rng(1)
    for groups in (0, 1, 40, 300):
        n_a, n_b = (np.where(rng.random(groups) < 0.7, 1, rng.integers(1, 6, groups)) for _ in "ab")
        a, b = rng.integers(0, 7, n_a.sum()), rng.integers(0, 7, n_b.sum())
        ends_a, ends_b = np.cumsum(n_a), np.cumsum(n_b)
        want = collections.Counter()
        for g in range(groups):
            ours, theirs = (x[e[g] - n[g]: e[g]].tolist() for x, e, n in ((a, ends_a, n_a), (b, ends_b, n_b)))
            want.update(x << 32 | y for x in ours for y in theirs)
        keys, counts = alignment.link_keys(a, b, ends_a, ends_b)
        assert dict(zip(keys.tolist(), counts.tolist())) == want and keys.tolist() == sorted(want)
