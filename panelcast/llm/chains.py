"""Toxicity by classifier chains.

Categories are predicted one after another by linear models over hashed words; each model also sees
the probabilities of the categories before it.  While fitting, those are out-of-fold predictions, so
a later model learns from probabilities as it will meet them.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import write_once
from .words import words

#: Labelled rows that a fit takes at most, by a hash of the id.
FIT_ROWS = 20_000
SPACE_BITS = 22
FOLDS = 3
#: A word is used if the chi-square of its presence with the category reaches this, in so many rows.
MIN_CHI2, MIN_ROWS, MAX_WORDS = 20.0, 4, 4096
PENALTY, STEPS = 0.2, 40
EDGES = b".,;:!?\"'()[]{}<>*#$%&|-_"


def word_ids(text: str | None) -> np.ndarray:
    """Hashed ids of the distinct words, in lower case and without marks at their ends."""
    found = {w.strip(EDGES) for w in set(words((text or "").lower()))} - {b""}
    return np.unique(np.fromiter((xxhash.xxh32_intdigest(w) >> (32 - SPACE_BITS) for w in found), np.int32, len(found)))


def ids_column(text):
    @F.pandas_udf("array<int>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for col in batches:
            yield pd.Series([word_ids(t) for t in col])
    return udf(text)


class Rows:
    """Sets of word ids of many texts, one after another."""

    def __init__(self, sets: list):
        self.n = len(sets)
        self.size = np.array([len(s) for s in sets], np.int64)
        self.ids = np.concatenate([np.asarray(s, np.int64) for s in sets]) if sets else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(self.n), self.size)

    def among(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, place in the sorted ``chosen``) of every word that is chosen."""
        if not len(chosen):
            return self.row[:0], self.row[:0]
        at = np.minimum(np.searchsorted(chosen, self.ids), len(chosen) - 1)
        hit = chosen[at] == self.ids
        return self.row[hit], at[hit]


def choose(rows: Rows, y: np.ndarray, use: np.ndarray) -> np.ndarray:
    """Words whose presence depends on the category among the rows in use."""
    hit = use[rows.row]
    n, pos = use.sum(), y[use].sum()
    ids, where = np.unique(rows.ids[hit], return_inverse=True)
    seen = np.bincount(where, minlength=len(ids)).astype(float)
    both = np.bincount(where, y[rows.row[hit]], len(ids))
    spread = seen * (n - seen) * pos * (n - pos)
    chi2 = np.where(spread > 0, (both * n - seen * pos) ** 2 * n / np.maximum(spread, 1), 0)
    good = np.flatnonzero((chi2 >= MIN_CHI2) & (seen >= MIN_ROWS))
    return np.sort(ids[good[np.argsort(-chi2[good], kind="stable")[:MAX_WORDS]]])


def fit_linear(rows: Rows, extra: np.ndarray, y: np.ndarray, use: np.ndarray) -> dict:
    """Penalised logistic regression by Newton's method with conjugate gradients."""
    rate = (y[use].sum() + 0.5) / (use.sum() + 1)
    chosen = choose(rows, y, use) if use.any() else np.zeros(0, np.int64)
    row, col = rows.among(chosen)
    keep = use[row]
    row, col, m, k = row[keep], col[keep], len(chosen), extra.shape[1]
    w = np.zeros(m + k + 1)
    w[-1] = np.log(rate / (1 - rate))

    def forward(v):
        return np.bincount(row, v[col], rows.n) + extra @ v[m:m + k] + v[-1]

    def back(r):
        r = np.where(use, r, 0.0)
        return np.r_[np.bincount(col, r[row], m), extra.T @ r, r.sum()]

    penalty = np.r_[np.full(m + k, PENALTY), 1e-6]
    for _ in range(STEPS if use.any() else 0):
        p = 1 / (1 + np.exp(-forward(w)))
        grad = back(p - y) + penalty * w
        if np.abs(grad).max() < 1e-3:
            break
        curve = np.maximum(p * (1 - p), 1e-6)
        step, r = np.zeros_like(w), -grad
        d, rr = r.copy(), r @ r
        for _ in range(25):
            hd = back(curve * forward(d)) + penalty * d
            a = rr / (d @ hd)
            step, r = step + a * d, r - a * hd
            rr, old = r @ r, rr
            if rr < 1e-8 * (grad @ grad):
                break
            d = r + rr / old * d
        w = w + step * min(1.0, 10.0 / max(np.abs(step).max(), 1e-9))
    return {"words": chosen, "w": w}


def predict_linear(model: dict, rows: Rows, extra: np.ndarray) -> np.ndarray:
    row, col = rows.among(model["words"])
    m, k = len(model["words"]), extra.shape[1]
    return 1 / (1 + np.exp(-(np.bincount(row, model["w"][col], rows.n) + extra @ model["w"][m:m + k] + model["w"][-1])))


def fit_chain(rows: Rows, y: np.ndarray, fold: np.ndarray) -> list[dict]:
    """One model a category (a column of ``y``, NaN where it is not known), each after the ones before it."""
    extra, out = np.zeros((rows.n, 0)), []
    for c in range(y.shape[1]):
        known = ~np.isnan(y[:, c])
        target, apart = np.nan_to_num(y[:, c]), np.zeros(rows.n)
        for k in range(FOLDS):
            part = fit_linear(rows, extra, target, known & (fold != k))
            apart[fold == k] = predict_linear(part, rows, extra)[fold == k]
        out.append(fit_linear(rows, extra, target, known))
        extra = np.c_[extra, apart]
    return out


def apply_chain(chain: list[dict], rows: Rows) -> np.ndarray:
    """Probabilities, a column a category."""
    extra = np.zeros((rows.n, 0))
    for model in chain:
        extra = np.c_[extra, predict_linear(model, rows, extra)]
    return extra


def fit_sample(marked: DataFrame, known: DataFrame, targets: list[str], fit_rows: int, content: str = "ids") -> DataFrame:
    """The first ``fit_rows`` labelled rows in the order of a hash of the id, without their ``content``.

    Only ids travel to the labels, by one join plan at every size.  Counts over the leading 16 bits
    of the hash tell how far the order has to be looked at, so the task that takes the first rows
    meets little more than those.
    """
    narrow = marked.select("doc_id", "row", F.xxhash64(content).alias("same"))
    labelled = write_once(narrow.join(known.hint("merge"), "doc_id").withColumn("draw", F.xxhash64("doc_id")), "labelled")
    top = F.shiftright("draw", 48)
    upto = (labelled.groupBy(top.alias("top")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("upto", F.sum("n").over(W.orderBy("top"))).where(F.col("upto") >= fit_rows).agg(F.min("top")).first()[0])
    near = labelled if upto is None else labelled.where(top <= upto)
    return (near.orderBy("draw", "doc_id", *targets, "same").limit(fit_rows)
            .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS))))


def classify(docs: DataFrame, labels: DataFrame, categories: list[str], learn_from=None, threshold: float = 0.3,
             fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, p_<category> ..., <category> ...) of every row, in the order of the chain.

    ``categories`` names columns of ``labels`` with 0, 1 or null.  ``learn_from`` is a condition on
    ``doc_id``.  The fit takes at most ``fit_rows`` labelled rows, in the order of a hash of the id;
    every row is scored.  A repeated document teaches as often as it is there.  Missing and empty
    texts have no words and get the chain's bias; without labels every probability is one half.
    Distinct words are hashed once for each text and written.
    """
    ids = ids_column(F.col(text_col))
    marked = write_once(docs.select(F.col(id_col).alias("doc_id"), ids.alias("ids"), F.monotonically_increasing_id().alias("row")), "word_ids")
    targets = [f"y_{c}" for c in categories]
    known = labels.select(F.col(id_col).alias("doc_id"), *[F.col(c).cast("double").alias(f"y_{c}") for c in categories])
    if learn_from is not None:
        known = known.where(learn_from)
    picked = fit_sample(marked, known, targets, fit_rows)
    # at most fit_rows rows of numbers
    fit = write_once(marked.select("row", "ids").join(F.broadcast(picked.drop("doc_id")), "row"), "fit_rows")
    sets, y, fold = [], [], []
    for r in fit.orderBy("draw", "same", *targets).toLocalIterator():
        sets.append(np.array(r.ids, np.int32))
        y.append([np.nan if r[f"y_{c}"] is None else r[f"y_{c}"] for c in categories])
        fold.append(r.fold)
    chain = fit_chain(Rows(sets), np.array(y, float).reshape(len(sets), len(categories)), np.array(fold, np.int64))
    del sets

    @F.pandas_udf(", ".join(f"p_{c} double" for c in categories))
    def score(col: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(apply_chain(chain, Rows(col.tolist())), columns=[f"p_{c}" for c in categories])

    return (marked.withColumn("__p", score("ids")).select("doc_id", *[F.col(f"__p.p_{c}").alias(f"p_{c}") for c in categories])
            .withColumns({c: (F.col(f"p_{c}") >= threshold).cast("int") for c in categories}))
