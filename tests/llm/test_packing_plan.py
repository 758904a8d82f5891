"""The packing plan's least squares against a plain solver, and what rounding leaves over."""

import numpy as np
import pytest

from tickweave.llm import packing


def plain(a, h, steps=20000):
    """Projected gradient steps of a safe length, many of them."""
    x, size = np.zeros(a.shape[1]), 1 / np.linalg.norm(a, 2) ** 2
    for _ in range(steps):
        x = np.maximum(0, x - size * (a.T @ (a @ x - h)))
    return x


@pytest.mark.parametrize("seed", range(6))
def test_solution_is_the_least_square(seed):
    rng, window = np.random.default_rng(seed), 24
    h = rng.integers(0, 60, window + 1) * rng.integers(0, 2, window + 1)
    h[0] = h[window] = 0
    if seed == 0:
        h[7] = 100_000
    lengths, times = packing.combinations(np.flatnonzero(h), window)
    a = np.zeros((window + 1, len(lengths)))
    np.add.at(a, (lengths.ravel(), np.repeat(np.arange(len(lengths)), 3)), times.ravel())
    x = packing.solve(lengths, times, h, 1e-9)
    error, want = (np.square(a @ y - h).sum() for y in (x, plain(a, h.astype(float))))
    assert (x >= 0).all() and np.count_nonzero(x) <= np.count_nonzero(h)
    assert error <= want + 1e-6 * (h @ h)
    loose = packing.solve(lengths, times, h)
    assert np.square(a @ loose - h).sum() <= want + 1e-2 * (h @ h)


@pytest.mark.parametrize("name", ["even", "short", "hot", "sparse"])
def test_few_tails_are_left_to_the_greedy_part(name):
    rng, window = np.random.default_rng(1), 256
    tails = {"even": rng.integers(1, window, 4000), "short": np.minimum(window - 1, rng.geometric(0.02, 4000)),
             "hot": np.r_[rng.integers(1, window, 4000), np.full(2000, 64)], "sparse": rng.integers(1, window, 300)}[name]
    h = np.bincount(tails, minlength=window + 1)
    plan = packing.Plan(h, window)
    lengths, times = packing.combinations(np.flatnonzero(h), window)
    x = packing.solve(lengths, times, h, 1e-6)
    used = np.bincount(lengths.ravel(), (times * x[:, None]).ravel(), window + 1)
    # even the least squares themselves can't use all tails (long ones lack partners)
    assert plan.left.sum() <= np.abs(h - used).sum() + 0.03 * h.sum()
    lengths, times = packing.combinations(np.flatnonzero(plan.left), window)
    assert not (times <= plan.left[lengths]).all(1).any()
    assert plan.sequences == -(-int((h * np.arange(window + 1)).sum()) // window)


@pytest.mark.parametrize("histogram", [[0, 0, 0, 0, 0], [0, 0, 0, 1, 0], [0, 1, 1, 1, 0], [0, 0, 3, 0, 0]])
def test_small_histograms(histogram):
    h = np.array(histogram)
    plan = packing.Plan(h, 4)
    assert plan.sequences == -(-int((h * np.arange(5)).sum()) // 4)
    length = np.repeat(np.arange(5), h)
    rank = np.concatenate([np.arange(n) for n in h])
    _, _, n, seq, at = plan.place(length, rank)
    held = sorted(s * 4 + o + i for s, o, m in zip(seq.tolist(), at.tolist(), n.tolist()) for i in range(m))
    assert held == list(range(int(length.sum())))
