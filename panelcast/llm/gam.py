"""Quality classifier: a generalised additive model with pairwise interactions.

Features are cut into quantile bins.  Boosting visits the features in turn; each visit fits a tree
of depth two on one feature and adds its leaves to the feature's table.  The pairs whose tables
explain most of what is left get tables of their own, boosted in the same way.  A score is the sum
of one table entry a feature and a pair.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import write_once
from .chains import fit_sample
from .rules import text_stats
from .words import words

#: Labelled rows that a fit takes at most, by a hash of the id.
FIT_ROWS = 30_000
BINS, PAIR_BINS, PAIRS = 48, 8, 10
ROUNDS, PAIR_ROUNDS, RATE, MIN_ROWS, RIDGE = 120, 60, 0.15, 20, 1.0

FEATURES = ["log_words", "log_chars", "word_chars", "symbols", "dup_lines", "repeats", "upper", "digits", "marks", "bangs", "bars",
            "other_bytes", "spaces", "types", "stutter", "top_word", "lines", "longest_word", "entropy", "sentence_ends", "stops",
            "short_words", "hyphens"]

_KIND = np.zeros((8, 256))
for _b in range(256):
    _c = chr(_b)
    _KIND[:, _b] = ("A" <= _c <= "Z", "0" <= _c <= "9", 33 <= _b < 127 and not _c.isalnum(), _c == "!", _c == "|", _b >= 128,
                    _c in " \t\n\x0b\x0c\r", _c in "-_=/\\")


def features(text: str | None) -> np.ndarray:
    """Shape of a text, from the text alone; an empty or missing text has all zeros."""
    text = text or ""
    w = words(text)
    out = np.zeros(len(FEATURES))
    if not w:
        return out
    n, chars, symbols, dups, repeats = text_stats(text, w)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    seen = np.bincount(raw, minlength=256).astype(float)
    kinds = _KIND @ seen / len(raw)
    ids: dict = {}
    at = np.fromiter((ids.setdefault(x, len(ids)) for x in w), np.int64, n)
    share = seen[seen > 0] / len(raw)
    size = np.fromiter(map(len, w), np.int64, n)
    last = [x[-1] for x in w]
    out[:] = (np.log1p(n), np.log1p(len(text)), chars / n, symbols / n, dups / n, repeats / n, kinds[0], kinds[1], kinds[2], kinds[3],
              kinds[4], kinds[5], kinds[6], len(ids) / n, float((at[1:] == at[:-1]).mean()) if n > 1 else 0.0,
              np.bincount(at).max() / n, (text.count("\n") + 1) / n, np.log1p(size.max()), float(-(share * np.log2(share)).sum()),
              sum(map(last.count, b".!?")) / n, last.count(46) / n, float((size < 3).mean()), kinds[7])
    return out


def features_column(text):
    """Column: array of the features."""
    @F.pandas_udf("array<double>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for col in batches:
            yield pd.Series([features(t) for t in col])
    return udf(text)


def _value(g, h):
    return g / (h + RIDGE)


def _gain(g, h):
    return g * g / (h + RIDGE)


def _split(g, h, n):
    """Best cut of a row of bins: (gain, bins on the left)."""
    a, b, m = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gain = _gain(a, b) + _gain(g.sum() - a, h.sum() - b) - _gain(g.sum(), h.sum())
    gain[(m < MIN_ROWS) | (n.sum() - m < MIN_ROWS)] = 0
    k = int(np.argmax(gain)) if len(gain) else 0
    return (float(gain[k]), k + 1) if len(gain) else (0.0, 0)


def _tree(g, h, n):
    """Leaf values of a tree of depth two over the bins."""
    gain, k = _split(g, h, n)
    parts = [(0, k), (k, len(g))] if gain > 0 else [(0, len(g))]
    out = np.zeros(len(g))
    for a, b in parts:
        more, j = _split(g[a:b], h[a:b], n[a:b]) if b - a > 1 and gain > 0 else (0.0, 0)
        for x, y in ([(a, a + j), (a + j, b)] if more > 0 else [(a, b)]):
            out[x:y] = _value(g[x:y].sum(), h[x:y].sum())
    return out


def _cross(g, h):
    """Best four leaves of a table cut once each way: (gain, leaf values)."""
    def quarters(x):
        c = np.cumsum(np.cumsum(x, 0), 1)
        a, row, col, total = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        return a, row - a, col - a, total - row - col + a
    gs, hs = quarters(g), quarters(h)
    gain = sum(_gain(x, y) for x, y in zip(gs, hs)) - _gain(g.sum(), h.sum())
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.empty_like(g)
    for (rows, cols), x, y in zip(((slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None)),
                                   (slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None))), gs, hs):
        out[rows, cols] = _value(x[i, j], y[i, j])
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """Tables of the model from rows of features and labels 0 or 1; without both labels, a constant."""
    d = x.shape[1]
    rate = (y.sum() + 0.5) / (len(y) + 1)
    cuts = [np.unique(np.quantile(x[:, j], np.arange(1, BINS) / BINS)) if len(y) else np.zeros(0) for j in range(d)]
    coarse = [c[np.unique(np.linspace(0, len(c) - 1, PAIR_BINS - 1).astype(int))] if len(c) else c for c in cuts]
    model = {"bias": float(np.log(rate / (1 - rate))), "cuts": cuts, "tables": [np.zeros(len(c) + 1) for c in cuts], "coarse": coarse,
             "pairs": [], "pair_tables": []}
    if not len(y) or len(np.unique(y)) < 2:
        return model
    bins = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)]
    small = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(coarse)]
    f = np.full(len(y), model["bias"])

    def residual():
        p = 1 / (1 + np.exp(-f))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    counts = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model["tables"])]
    for _ in range(ROUNDS):
        for j in range(d):
            g, h = residual()
            table = model["tables"][j]
            step = RATE * _tree(np.bincount(bins[j], g, len(table)), np.bincount(bins[j], h, len(table)), counts[j])
            table += step
            f += step[bins[j]]
    g, h = residual()

    def tables(i, j, g, h):
        m, n = len(coarse[i]) + 1, len(coarse[j]) + 1
        at = small[i] * n + small[j]
        return at, np.bincount(at, g, m * n).reshape(m, n), np.bincount(at, h, m * n).reshape(m, n)

    found = [(_cross(*tables(i, j, g, h)[1:])[0], i, j) for i in range(d) for j in range(i) if len(coarse[i]) and len(coarse[j])]
    model["pairs"] = [(i, j) for _, i, j in sorted(found, reverse=True)[:PAIRS]]
    model["pair_tables"] = [np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for i, j in model["pairs"]]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model["pairs"], model["pair_tables"]):
            at, gs, hs = tables(i, j, *residual())
            step = RATE * _cross(gs, hs)[1]
            table += step
            f += step.ravel()[at]
    return model


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of label 1 by adding up bins."""
    f = np.full(len(x), model["bias"])
    for j, (cuts, table) in enumerate(zip(model["cuts"], model["tables"])):
        f += table[np.searchsorted(cuts, x[:, j], "right")]
    for (i, j), table in zip(model["pairs"], model["pair_tables"]):
        f += table[np.searchsorted(model["coarse"][i], x[:, i], "right"), np.searchsorted(model["coarse"][j], x[:, j], "right")]
    return 1 / (1 + np.exp(-f))


def train(marked: DataFrame, known: DataFrame, label: str, fit_rows: int = FIT_ROWS) -> dict:
    """Model from ``marked`` (doc_id, row, features) and ``known`` (doc_id, label); at most ``fit_rows`` rows, by a hash of the id.

    Only ids travel to the labels; the features of the rows drawn are read by row.
    """
    picked = fit_sample(marked, known, [label], fit_rows, "features")
    # at most fit_rows rows of numbers
    fitted = write_once(marked.select("row", "features").join(F.broadcast(picked.drop("doc_id")), "row"), "fit_rows")
    x, y = [], []
    for r in fitted.orderBy("draw", label, "same").select("features", F.col(label).alias("y")).toLocalIterator():
        x.append(r.features)
        y.append(r.y)
    return fit(np.array(x, float).reshape(len(x), len(FEATURES)), np.array(y, float))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", learn_from=None, threshold: float = 0.3,
             fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row: the probability of label 1, and 1 where it reaches ``threshold``.

    ``learn_from`` (a condition on ``doc_id``) says which rows may be learnt from.  Features come
    from the text alone; labels other than 0 and 1, and documents without a label, teach nothing; a
    document labelled both ways teaches both.  Without labels every score is one half.  Missing
    texts are empty, which is a row of zeros.  Features are computed once and written.
    """
    marked = write_once(docs.select(F.col(id_col).alias("doc_id"), features_column(F.col(text_col)).alias("features"),
                                    F.monotonically_increasing_id().alias("row")), "features")
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label).alias("__label")).where(F.col("__label").isin(0, 1))
    if learn_from is not None:
        known = known.where(learn_from)
    model = train(marked, known, "__label", fit_rows)

    @F.pandas_udf("double")
    def score(col: pd.Series) -> pd.Series:
        return pd.Series(predict(model, np.array(col.tolist(), float).reshape(len(col), len(FEATURES))))

    return (marked.select("doc_id", score("features").alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
