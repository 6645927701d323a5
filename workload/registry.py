"""All registered queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adstrata.session import apply_runtime_conf
from workload import attribution, campaigns, logs, monitoring, paths, reach, storage
from workload.views import Inputs

MODULES = [attribution, paths, campaigns, monitoring, reach, logs, storage]


def _over_folder(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Inputs(apply_runtime_conf(spark), str(folder).rstrip("/")))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _over_folder(build) for m in MODULES for name, build in m.QUERIES.items()}


def check_statements() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.CHECKS.items()}
