import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pointset.operators import kernels


def brute(x, c, skip=None):
    d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    if skip is not None:
        for i, s in enumerate(skip):
            if s >= 0:
                d[i, s] = np.inf
    return d.argmin(axis=1), d.min(axis=1)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 40), st.integers(1, 30), st.integers(1, 9))
def test_nearest_is_exact(seed, n, k, dim):
    rng = np.random.default_rng(seed)
    # Small integers make ties and duplicates common; the shift provokes cancellation.
    x = rng.integers(0, 3, (n, dim)) + 1e6
    c = rng.integers(0, 3, (k, dim)) + 1e6
    pos, d2 = kernels.nearest(x.astype(float), c.astype(float))
    want, best = brute(x, c)
    assert np.array_equal(pos, want)
    assert np.array_equal(d2, best)


def test_ties_go_to_the_lowest_position():
    c = np.array([[1.0, 0.0], [0.0, 1.0], [1.0, 0.0]])
    pos, d2 = kernels.nearest(np.array([[0.0, 0.0], [1.0, 0.0]]), c)
    assert pos.tolist() == [0, 0] and d2.tolist() == [1.0, 0.0]


def test_skip_excludes_own_position():
    c = np.random.default_rng(1).normal(size=(20, 5))
    own = np.arange(20)
    pos, d2 = kernels.nearest(c, c, skip=own)
    want, best = brute(c, c, own)
    assert np.array_equal(pos, want) and np.allclose(d2, best)


def test_lone_centroid_has_no_other():
    pos, d2 = kernels.nearest(np.ones((1, 3)), np.ones((1, 3)), skip=np.array([0]))
    assert np.isinf(d2[0])


def test_row_blocks_do_not_matter(monkeypatch):
    rng = np.random.default_rng(3)
    x, c = rng.normal(size=(500, 6)), rng.normal(size=(17, 6))
    whole = kernels.nearest(x, c)
    monkeypatch.setattr(kernels, "MATRIX_CELLS", 50)
    parts = kernels.nearest(x, c)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])


def test_matrix_rejects_ragged_and_null_vectors():
    with pytest.raises(ValueError):
        kernels.matrix(pa.array([[1.0, 2.0], [3.0]]))
    with pytest.raises(ValueError):
        kernels.matrix(pa.array([[1.0], None]))
    assert kernels.matrix(pa.array([[1.0, 2.0], [3.0, 4.0]]).slice(1)).tolist() == [[3.0, 4.0]]
