"""Per-series sweep: complete series, stratified sample, shared sweep, winner on all series."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..models import grids, grouped
from ..operators import joins, split
from ..sources.staging import write_once


def sweep(long: DataFrame, horizon: int, family: str, configs: Sequence[dict], n_series: int, seed: int = 42) -> DataFrame:
    """Ledger of every configuration on a stratified sample of the complete series."""
    cutoff = split.cutoff_value(long, horizon, "ds")
    ids = split.complete_series(long, cutoff, horizon)
    past = joins.semi_join_ids(long.filter(F.col("ds") < cutoff), ids)
    sample = split.stratified_sample(past, n_series, seed)
    table = grids.config_table(long.sparkSession, list(configs))
    fits = grouped.sweep_fit(joins.semi_join_ids(long, sample), cutoff, family, table)
    return grouped.sweep_report(fits, table)


def ledger_rows(report: DataFrame, experiment: str, configs: Sequence[dict]) -> DataFrame:
    """Sweep report as run-ledger rows, ``seq`` the place of the configuration in the sweep.

    A configuration without a validation error is a failed run.
    """
    run_id = F.substring(F.md5(F.concat_ws("|", F.lit(experiment), "label", "params")), 1, 12)
    status = F.when(F.col("val_wmae").isNull() | F.isnan("val_wmae"), "FAILED").otherwise("FINISHED")
    seq = F.array_position(F.array(*[F.lit(c["label"]) for c in configs]), F.col("label")).cast("int") - 1
    return report.withColumns({"experiment": F.lit(experiment), "run_status": status, "run_id": run_id, "seq": seq})


def refit(long: DataFrame, horizon: int, family: str, config: dict) -> DataFrame:
    """Model table of the chosen configuration on the whole history of all complete series."""
    cutoff = split.cutoff_value(long, horizon, "ds")
    eligible = joins.semi_join_ids(long, split.complete_series(long, cutoff, horizon))
    return write_once(grouped.final_refit(eligible, family, config), "models")
