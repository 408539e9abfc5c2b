"""Quality rules with verdicts on hosts.

Rule failures are counted for each host, each rate is shrunk towards the rate of all hosts by an
empirical beta prior, and a host whose shrunk rate is too high takes its documents with it.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import write_once
from .words import words

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PCT, SPAN = 20, 30, 8
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Rules beside the base ones, as SQL over the statistics; true is a failure.
RULES = {
    "base": f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "20 * n_dup_lines > n_words",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
}


def repeat_words(w: list[bytes], span: int = SPAN) -> int:
    """Words in ``span``-word windows that the text holds twice or more, the first included."""
    n = len(w) - span + 1
    if n < 2:
        return 0
    seen: dict = {}
    ids = np.fromiter((seen.setdefault(x, len(seen)) for x in w), np.int64, len(w))
    if len(seen) == len(w):
        return 0
    size, rank = 1, ids  # equal ranks are equal runs of ``size`` words
    while size < span:
        step = min(size, span - size)
        m = len(w) - size - step + 1
        rank = np.unique(rank[:m] * (int(rank.max()) + 1) + rank[step:step + m], return_inverse=True)[1]
        size += step
    twice = np.flatnonzero(np.bincount(rank)[rank] > 1)
    cover = np.zeros(len(w) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + span, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def text_stats(text: str | None, w: list[bytes] | None = None) -> tuple[int, int, int, int, int]:
    text = text or ""
    w = words(text) if w is None else w
    return (len(w), len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")), sum(map(text.count, SYMBOLS)),
            dup_lines(text), repeat_words(w))


def stats_column(text):
    """Column: struct of the five statistics; a missing text counts as an empty one."""
    @F.pandas_udf(", ".join(f"{c} long" for c in STATS))
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for col in batches:
            yield pd.DataFrame([text_stats(t) for t in col], columns=STATS)
    return udf(text)


def beta_prior(hosts: DataFrame, fail: str, n: str = "n") -> tuple[float, float]:
    """Moments estimate (alpha, beta) of the failure rates of hosts, each seen ``n`` times.

    Without hosts, or where no host or every host fails, the prior is worth one document.
    """
    k, total, squares, failed, spread = hosts.agg(
        F.count(F.lit(1)), F.sum(n), F.sum(F.col(n) * F.col(n)), F.sum(fail), F.sum(F.col(fail) * F.col(fail) / F.col(n))).first()
    total, failed = float(total or 0), float(failed or 0)
    mean = (failed + 0.5) / (total + 1)
    p = failed / total if total else 0.0
    room = total - float(squares or 0) / total - (k - 1) if total else 0.0
    if not 0 < p < 1 or room <= 0:
        return mean, 1 - mean
    rho = ((float(spread) - failed * p) / (p * (1 - p)) - (k - 1)) / room
    strength = 1 / min(max(rho, 1e-4), 0.5) - 1
    return p * strength, (1 - p) * strength


def host_verdicts(marked: DataFrame, host: str, rules: dict[str, str], max_rate: float) -> DataFrame:
    """(host, n, host_rate, host_rejected): one row a host, its worst shrunk rate, rates in ``rules``."""
    hosts = write_once(marked.groupBy(host).agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(F.expr(sql).cast("long")).alias(f"f_{name}") for name, sql in rules.items()]), "hosts")
    rates = []
    for name in rules:
        a, b = beta_prior(hosts, f"f_{name}")
        rates.append((F.col(f"f_{name}") + a) / (F.col("n") + a + b))
    worst = F.greatest(*rates) if len(rates) > 1 else rates[0]
    return hosts.select(host, "n", worst.alias("host_rate"), (worst > max_rate).alias("host_rejected"))


def apply_rules(docs: DataFrame, host_col: str = "source", text_col: str = "text", rules: dict[str, str] | None = None,
                max_rate: float = 0.5) -> DataFrame:
    """Every row of ``docs`` with the five statistics, ``base_failed``, ``host_rate`` and ``kept``.

    A row is kept if it fails no rule itself and its host is not rejected.  A host is rejected if,
    for some rule, the failure rate of its documents, shrunk by the beta prior, is over
    ``max_rate``.  Rows without a host form one host.  A missing or empty text has no words and
    fails.  Columns of ``docs`` that bear the name of a result are replaced.  The texts are read
    twice, once for the counts of hosts and once for the rows, so nothing as large as the texts is
    written or shuffled; counts combine before the shuffle, and the verdicts come back by a join
    that Spark broadcasts if the table of hosts is small and can split at a hot host if not.
    """
    rules = rules or RULES
    new = [*STATS, "base_failed", "host_rate", "kept"]
    old = [c for c in docs.columns if c not in new]
    host = F.struct(F.col(host_col).isNull().alias("missing"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("name"))

    def stats(*cols):
        return (docs.select(*cols, stats_column(F.col(text_col)).alias("__rule_stats"), host.alias("__rule_host"))
                .select(*cols, *[F.col(f"__rule_stats.{c}").alias(c) for c in STATS], "__rule_host"))

    verdict = write_once(host_verdicts(stats(), "__rule_host", rules, max_rate), "verdicts").select(
        "__rule_host", F.col("host_rate").alias("__rule_rate"), F.col("host_rejected").alias("__rule_rejected"))
    failed = F.lit(False)
    for sql in rules.values():
        failed = failed | F.expr(sql)
    return (stats(*old).join(verdict, "__rule_host", "left")
            .select(*old, *STATS, F.expr(RULES["base"]).alias("base_failed"), F.col("__rule_rate").alias("host_rate"),
                    (~failed & ~F.expr(RULES["base"]) & ~F.col("__rule_rejected")).alias("kept")))
