"""Jobs of several stages that log what they do and resume where they stopped.

Every stage reads its predecessors' written outputs and writes its own. The run log is a Parquet table of
events (running, completed, failed) with row counts, times and errors, the form ``run_states`` reads. A stage counts
as done only by its completed event, which is written after its output; started again under the same execution id,
a job reads finished stages back and computes the others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT = ("execution_id string, pipeline_name string, pipeline_stage string, status string, event_time timestamp_ntz, "
         "records_processed bigint, error_message string")
Stage = tuple[str, Callable[..., DataFrame]]


class Job:
    """``stages`` are (name, function); a function gets the outputs of all stages before it, by name.

    ``now`` gives the time of an event; nothing else reads a clock.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, stages: list[Stage], now: Callable[[], dt.datetime]) -> None:
        self.spark, self.root, self.name, self.stages, self.now = spark, root.rstrip("/"), name, stages, now

    def log(self) -> DataFrame:
        """All events of all runs of all jobs below this root."""
        self.spark.createDataFrame([], EVENT).write.mode("ignore").parquet(f"{self.root}/run_log")
        return self.spark.read.schema(EVENT).parquet(f"{self.root}/run_log")

    def _event(self, execution: str, stage: str, status: str, records: int | None = None, error: str | None = None) -> None:
        row = [(execution, self.name, stage, status, self.now(), records, error)]
        self.spark.createDataFrame(row, EVENT).coalesce(1).write.mode("append").parquet(f"{self.root}/run_log")

    def _path(self, execution: str, stage: str) -> str:
        return f"{self.root}/{self.name}/{execution}/{stage}"

    def finished(self, execution: str) -> set[str]:
        mine = (F.col("execution_id") == execution) & (F.col("pipeline_name") == self.name) & (F.col("status") == "completed")
        return {r["pipeline_stage"] for r in self.log().where(mine).select("pipeline_stage").distinct().collect()}

    def run(self, execution: str) -> DataFrame:
        """Run or resume an execution; the last stage's output. A failing stage is logged and its error raised."""
        done, outputs = self.finished(execution), {}
        for stage, make in self.stages:
            path = self._path(execution, stage)
            if stage not in done:
                self._event(execution, stage, "running")
                try:
                    make(outputs).write.mode("overwrite").parquet(path)
                    records = self.spark.read.parquet(path).count()
                except Exception as error:
                    self._event(execution, stage, "failed", error=f"{type(error).__name__}: {str(error).strip().splitlines()[0] if str(error).strip() else ''}")
                    raise
                self._event(execution, stage, "completed", records)
            outputs[stage] = self.spark.read.parquet(path)
        return outputs[self.stages[-1][0]]
