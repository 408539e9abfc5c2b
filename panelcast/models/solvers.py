"""Small numpy fits for one series, called inside Spark tasks."""

import numpy as np

from .arma import fit as arma_fit  # noqa: F401
from .arma import fitted as arma_fitted  # noqa: F401
from .arma import forecast as arma_forecast  # noqa: F401


def additive_design(days: np.ndarray, cfg: dict, first: float, span: float, holidays: np.ndarray) -> np.ndarray:
    """Intercept, trend with hinges, yearly Fourier pairs and one column per named event."""
    t = (days - first) / span
    knots = np.linspace(0, cfg.get("changepoint_range", 0.8), cfg.get("n_changepoints", 25) + 1)[1:]
    angle = 2 * np.pi * np.outer(days / 365.25, np.arange(1, cfg["yearly_seasonality"] + 1))
    events = np.array([holidays == k for k in range(1, 5)], dtype=float).T
    hinges = np.maximum(t[:, None] - knots[None, :], 0.0)
    return np.hstack([np.ones((len(t), 1)), t[:, None], hinges, np.sin(angle), np.cos(angle), events])


def _trend_columns(cfg: dict) -> int:
    return 2 + cfg.get("n_changepoints", 25)


def _scales(cfg: dict) -> tuple[np.ndarray, np.ndarray]:
    """Widths of the Gaussian priors (level, slope, season, events) and of the Laplace priors of the trend changes.

    Columns without a Gaussian prior have an infinite width and the other way round.
    """
    knots, pairs = cfg.get("n_changepoints", 25), cfg["yearly_seasonality"]
    gauss = [5.0, 5.0] + [np.inf] * knots + [cfg["seasonality_prior_scale"]] * (2 * pairs) + [cfg["holidays_prior_scale"]] * 4
    laplace = [np.inf, np.inf] + [cfg["changepoint_prior_scale"]] * knots + [np.inf] * (2 * pairs + 4)
    return np.array(gauss), np.array(laplace)


def _lasso(gram: np.ndarray, moment: np.ndarray, l1: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Minimum of w'Gw/2 - m'w + sum(l1 |w|), exactly, by signs taken as given and mended.

    With the signs of the moving coordinates given, the minimum solves linear equations.  On the way
    there some may reach zero; the best point on the way is taken and the rest tried again.  Then the
    coordinate joins that is pulled hardest beyond its threshold.  Each step lowers the sum.
    """
    w, signs = start.copy(), np.sign(start)
    slack = 1e-9 * (1 + np.abs(moment).max(initial=0))
    for _ in range(40 * len(moment)):
        while signs.any():
            on = np.flatnonzero(signs)
            part = gram[np.ix_(on, on)]
            goal = np.linalg.solve(part, moment[on] - l1[on] * signs[on])
            here = w[on]
            kept = goal * signs[on] > 0
            if kept.all():
                w[on] = goal
                break
            way = goal - here
            turns = ~kept & (here != 0)
            tried = here + np.r_[-here[turns] / way[turns], 1.0][:, None] * way
            tried[np.abs(tried) < 1e-14] = 0.0
            worth = ((tried @ part) * tried).sum(axis=1) / 2 - tried @ moment[on] + np.abs(tried) @ l1[on]
            w[on] = tried[np.argmin(worth)]
            signs = np.sign(w)
            if (w[on] == here).all():  # no way down is left for these signs
                break
        pull = moment - gram @ w
        beyond = np.where(signs == 0, np.abs(pull) - l1, -np.inf)
        j = int(np.argmax(beyond))
        if beyond[j] <= slack:
            break
        signs[j] = np.sign(pull[j])
    return w


def sparse_ridge(gram: np.ndarray, moment: np.ndarray, l2: np.ndarray, l1: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Minimum of w'Gw/2 - m'w + sum(l2 w^2)/2 + sum(l1 |w|) from the Gram matrix alone.

    Columns without a Laplace prior (``l1`` of 0) are eliminated, which leaves a lasso in the others;
    it begins at ``start``, weights of a similar problem.
    """
    smooth, kinked = np.flatnonzero(l1 == 0), np.flatnonzero(l1)
    full = gram + np.diag(l2 + 1e-9)
    if not len(kinked):
        return np.linalg.solve(full, moment)
    w = np.zeros(len(moment)) if start is None else start.copy()
    cross = full[np.ix_(kinked, smooth)]
    inner = np.linalg.solve(full[np.ix_(smooth, smooth)], np.column_stack([cross.T, moment[smooth]]))
    w[kinked] = _lasso(full[np.ix_(kinked, kinked)] - cross @ inner[:, :-1], moment[kinked] - cross @ inner[:, -1], l1[kinked], w[kinked])
    w[smooth] = inner[:, -1] - inner[:, :-1] @ w[kinked]
    return w


def additive_fit(days: np.ndarray, y: np.ndarray, holidays: np.ndarray, cfg: dict) -> np.ndarray:
    """[first day, span, scale, weights...]: Laplace priors on the trend changes, Gaussian ones on the rest.

    The most likely weights for a noise level, then the level from their errors, a few times over.
    The multiplicative form is trend * (1 + season); its two parts are fitted in turn, which takes
    sales of any sign.
    """
    first, span = float(days[0]), float(max(days[-1] - days[0], 7))
    scale = float(np.abs(y).max()) or 1.0
    target = y / scale
    x = additive_design(days, cfg, first, span, holidays)
    (gauss, laplace), noise = _scales(cfg), 0.1

    def most_likely(part, goal, cols, before):
        return sparse_ridge(part.T @ part, part.T @ goal, noise ** 2 / gauss[cols] ** 2, noise ** 2 / laplace[cols], before)

    if cfg.get("seasonality_mode") != "multiplicative":
        w, gram, moment = None, x.T @ x, x.T @ target
        for _ in range(3):
            w = sparse_ridge(gram, moment, noise ** 2 / gauss ** 2, noise ** 2 / laplace, w)
            noise = max(float(np.std(target - x @ w)), 1e-4)
        return np.concatenate([[first, span, scale], w])
    n = _trend_columns(cfg)
    season, trend_w = np.zeros(len(y)), None
    for _ in range(6):
        trend_w = most_likely(x[:, :n] * (1 + season)[:, None], target, slice(n), trend_w)
        trend = x[:, :n] @ trend_w
        season_w = most_likely(x[:, n:] * trend[:, None], target - trend, slice(n, None), None)
        season = x[:, n:] @ season_w
        noise = max(float(np.std(target - trend * (1 + season))), 1e-4)
    return np.concatenate([[first, span, scale], trend_w, season_w])


def additive_predict(days: np.ndarray, holidays: np.ndarray, coefs: np.ndarray, cfg: dict) -> np.ndarray:
    first, span, scale = coefs[:3]
    x, w, n = additive_design(days, cfg, first, span, holidays), coefs[3:], _trend_columns(cfg)
    if cfg.get("seasonality_mode") == "multiplicative":
        return x[:, :n] @ w[:n] * (1 + x[:, n:] @ w[n:]) * scale
    return x @ w * scale


def basis_fit(days: np.ndarray, y: np.ndarray, cfg: dict) -> np.ndarray:
    """[first day, span, weights...] of a polynomial trend plus yearly harmonics.

    A small ridge on all but the level keeps short inputs from exploding ahead of their end.
    """
    first, span = float(days[0]), float(max(days[-1] - days[0], 7))
    x = _basis(days, first, span, cfg)
    penalty = np.full(x.shape[1], cfg.get("ridge", 1e-4) * len(y))
    penalty[0] = 0.0
    return np.concatenate([[first, span], np.linalg.solve(x.T @ x + np.diag(penalty), x.T @ y)])


def basis_predict(days: np.ndarray, coefs: np.ndarray, cfg: dict) -> np.ndarray:
    return _basis(days, coefs[0], coefs[1], cfg) @ coefs[2:]


def _basis(days: np.ndarray, first: float, span: float, cfg: dict) -> np.ndarray:
    t = (days - first) / span
    powers = np.vander(t, cfg["n_polynomials"] + 1, increasing=True)
    angle = 2 * np.pi * np.outer(days / 365.25, np.arange(1, cfg["n_harmonics"] + 1))
    return np.hstack([powers, np.sin(angle), np.cos(angle)])


def is_plausible(forecast: np.ndarray, y: np.ndarray, factor: float = 50.0) -> bool:
    if forecast.size == 0 or not np.isfinite(forecast).all():
        return False
    known = np.abs(y[np.isfinite(y)])
    return bool(np.abs(forecast).max() <= max(factor * known.max(initial=0.0), 1.0))
