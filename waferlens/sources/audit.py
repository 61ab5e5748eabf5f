"""Audit rows from what a job's own pass over its rows observes: nothing is counted by a second job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .tables import Sink, notify

AUDIT = "JOB string, STATUS string, ROWS_IN long, ROWS_OUT long, ROWS_REFUSED long, STARTED timestamp, ENDED timestamp, MESSAGE string"
_MESSAGE_LENGTH = 1000  # of a failure's text


@dataclass(frozen=True)
class AuditLog:
    """A log of jobs in a shared folder, a row a run; ``callback`` is told of each end as well."""

    spark: SparkSession
    path: str
    callback: Callable[[dict], None] | None = None

    def run(self, job: str, rows: DataFrame, write: Callable[[DataFrame], None], refused: Column | None = None, metrics: dict[str, Column] | None = None) -> dict:
        """Write ``rows`` without those that are ``refused`` (null: not refused) and log how many came, went and were refused.

        Counts are of the first action of ``write``, which has to consume all
        rows it is given; they are exact under lost tasks if no shuffle stands
        between the rows given here and that write.  ``metrics`` are further
        aggregates of the rows written, and returned with the counts.  A job
        that fails is logged with its message and no counts, and its error is
        raised again.
        """
        came, went = Observation(), Observation()
        bad = F.coalesce(refused, F.lit(False)) if refused is not None else F.lit(False)
        seen = rows.observe(came, F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("refused"))
        kept = seen.filter(~bad).observe(went, F.count(F.lit(1)).alias("n"), *[c.alias(n) for n, c in (metrics or {}).items()])
        began = datetime.now(UTC)
        try:
            write(kept)
        except Exception as e:
            self._log(job, "FAILED", None, None, None, began, str(e)[:_MESSAGE_LENGTH])
            raise
        first, last = came.get, went.get
        self._log(job, "OK", first["n"], last["n"], first["refused"], began, "")
        return {"rows_in": first["n"], "rows_out": last["n"], "rows_refused": first["refused"], **{n: last[n] for n in metrics or {}}}

    def _log(self, job: str, status: str, came: int | None, went: int | None, refused: int | None, began: datetime, message: str) -> None:
        row = (job, status, came, went, refused, began, datetime.now(UTC), message)
        Sink(self.path).write(self.spark.createDataFrame([row], AUDIT).coalesce(1))
        notify(self.callback, job, status, message)

    def read(self) -> DataFrame:
        return self.spark.read.schema(AUDIT).parquet(self.path)
