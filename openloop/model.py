"""The five-table audit star handed to reports, checks and maintenance jobs."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from openloop.functions.clock import within_days
from openloop.schemas import CLOSING_ACTIONS, OPEN_ACTION, TABLES


@dataclass(frozen=True)
class AuditModel:
    """DataFrames in the column names of :mod:`openloop.schemas`.

    A report reads only the columns it names, so a model bound to other tables may leave out
    tables and columns that no wanted report touches.
    """

    policy: DataFrame | None = None
    data_source: DataFrame | None = None
    document_ref: DataFrame | None = None
    scan_run: DataFrame | None = None
    violation: DataFrame | None = None
    open_action: str = OPEN_ACTION
    closing_actions: tuple[str, ...] = CLOSING_ACTIONS

    @classmethod
    def from_parquet(cls, spark: SparkSession, path: str) -> "AuditModel":
        """A model published by :func:`openloop.sources.publish.publish_model`."""
        return cls(**{name: spark.read.parquet(f"{path}/{name}") for name in TABLES})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> "AuditModel":
        return cls(**{name: spark.table(f"{database}.{name}") for name in TABLES})

    def tables(self) -> dict[str, DataFrame]:
        found = {name: getattr(self, name) for name in TABLES}
        return {name: df for name, df in found.items() if df is not None}

    def between(self, first: dt.date, last: dt.date) -> "AuditModel":
        """The same model with the findings of the UTC days ``first`` to ``last`` only."""
        inside = within_days(self.violation, "detected_at", first, last)
        return replace(self, violation=self.violation.filter(inside))
