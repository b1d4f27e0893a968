"""Named plans: each a query over the stand-in views, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cliploom.plans.registry import ORACLES, PLANS
from cliploom.plans.views import Views, prelude
from cliploom.plans import bodies, catalog, embeds, files, frames, rigid, segments, streams  # noqa: F401  fill the registry


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, f=f: f(Views(spark, sf_dir))) for name, f in PLANS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: prelude(sql) for name, sql in ORACLES.items()}
