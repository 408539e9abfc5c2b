import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcast.models import grids, solvers


def optimal(gram, moment, l2, l1, w, slack):
    """The conditions of a minimum: no slope where a weight moves freely, a small one where it is zero."""
    slope = (gram + np.diag(l2 + 1e-9)) @ w - moment
    on = (w != 0) | (l1 == 0)
    assert np.abs(slope[on] + l1[on] * np.sign(w[on])).max(initial=0) < slack
    assert (np.abs(slope[~on]) <= l1[~on] + slack).all()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 12), st.integers(0, 6), st.floats(0.01, 30))
def test_minimum_meets_its_conditions(seed, n, smooth, strength):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(40, n + smooth))
    x[:, :n] = np.cumsum(x[:, :n], axis=0)  # close to each other, like hinges
    y = rng.normal(size=40) * 3
    l1 = np.r_[np.full(n, strength), np.zeros(smooth)]
    l2 = np.r_[np.zeros(n), rng.uniform(0.1, 2, smooth)]
    w = solvers.sparse_ridge(x.T @ x, x.T @ y, l2, l1)
    optimal(x.T @ x, x.T @ y, l2, l1, w, 1e-6 * (1 + np.abs(x.T @ y).max()))


def test_without_a_laplace_prior_it_is_a_ridge():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(30, 4)), rng.normal(size=30)
    np.testing.assert_allclose(solvers.sparse_ridge(x.T @ x, x.T @ y, np.full(4, 2.0), np.zeros(4)),
                               np.linalg.solve(x.T @ x + 2 * np.eye(4), x.T @ y), rtol=1e-6)
    one = solvers.sparse_ridge(np.array([[4.0]]), np.array([10.0]), np.zeros(1), np.array([3.0]))
    np.testing.assert_allclose(one, [(10 - 3) / 4], rtol=1e-6)


def test_stronger_priors_leave_more_knots_straight():
    days, rng = np.arange(300) * 7.0, np.random.default_rng(2)
    y = 100 + 0.1 * np.arange(300) + 0.5 * np.maximum(np.arange(300) - 120, 0) + rng.normal(size=300)
    straight = {}
    for label, bound in (("underfit_1", 25), ("balanced_1", 2), ("balanced_6", 2), ("overfit_1", 2)):
        cfg = grids.pick(grids.additive(), label)[0]
        coefs = solvers.additive_fit(days, y, np.zeros(300), cfg)
        straight[label] = int((coefs[5:30] == 0).sum())
        assert np.median(np.abs(solvers.additive_predict(days, np.zeros(300), coefs, cfg) - y)) < bound
    assert straight["underfit_1"] > straight["balanced_1"] >= 10 and straight["balanced_1"] > straight["overfit_1"]


def test_additive_fit_meets_its_conditions():
    cfg = grids.pick(grids.additive(), "balanced_1")[0]
    days, rng = np.arange(200) * 7.0, np.random.default_rng(3)
    y = 50 + 10 * np.sin(2 * np.pi * days / 365.25) + np.cumsum(rng.normal(size=200))
    hol = (np.arange(200) % 13 == 0) * 1.0
    for rounds in range(3):  # the last weights are those of the last but one noise level
        coefs = solvers.additive_fit(days, y, hol, cfg)
    x = solvers.additive_design(days, cfg, 0.0, days[-1], hol)
    target, w, (gauss, laplace) = y / np.abs(y).max(), coefs[3:], solvers._scales(cfg)
    noise = 0.1
    for _ in range(2):
        step = solvers.sparse_ridge(x.T @ x, x.T @ target, noise ** 2 / gauss ** 2, noise ** 2 / laplace)
        noise = np.std(target - x @ step)
    optimal(x.T @ x, x.T @ target, noise ** 2 / gauss ** 2, noise ** 2 / laplace, w, 1e-6)
    assert 0 < (w[2:27] == 0).sum() < 25
