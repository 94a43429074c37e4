"""Load audit as an append-only list of events; the newest event of a run is its state."""

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart import schemas, session
from gridmart.operators.snapshots import last_per_key

ERROR_LENGTH = 1000


class AuditLog:
    """Writes one event row when a load starts and one when it ends."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root}/{schemas.AUDIT}"

    def read(self) -> DataFrame:
        return self.spark.read.schema(schemas.RAW_TABLES[schemas.AUDIT]).parquet(self.path)

    def start(self, run_id: str, asset: str, source: str) -> dict:
        event = {
            "id": self._next_id(),
            "run_id": run_id,
            "asset_name": asset,
            "source": source,
            "records_written": 0,
            "started_at": _now(),
            "completed_at": None,
            "status": "running",
            "error_message": None,
        }
        return self._append(event)

    def complete(self, started: dict, records: int) -> dict:
        return self._append({**started, "records_written": records, "completed_at": _now(), "status": "success"})

    def fail(self, started: dict, error: str) -> dict:
        message = error[:ERROR_LENGTH]
        return self._append({**started, "completed_at": _now(), "status": "failed", "error_message": message})

    def track(self, run_id: str, asset: str, source: str, load: Callable[[int], int]) -> int:
        """Run ``load`` (given the load number) between a start and an end event.

        An error is recorded and raised again.
        """
        started = self.start(run_id, asset, source)
        try:
            records = load(started["id"])
        except Exception as error:
            self.fail(started, str(error))
            raise
        self.complete(started, records)
        return records

    def _next_id(self) -> int:
        if not session.table_exists(self.spark, self.path):
            return 1
        newest = self.read().agg(F.max("id")).first()[0]
        return 1 if newest is None else newest + 1

    def _append(self, event: dict) -> dict:
        if event["status"] not in schemas.AUDIT_STATES:
            raise ValueError(f"unknown audit status: {event['status']}")
        rows = self.spark.createDataFrame([event], schemas.RAW_TABLES[schemas.AUDIT])
        rows.coalesce(1).write.mode("append").parquet(self.path)
        return event


def _now() -> dt.datetime:
    return dt.datetime.now(tz=dt.timezone.utc)


def current_state(events: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """The state of each run: its newest end event if there is one, else its start event."""
    ended = F.when(F.col("completed_at").isNull(), 0).otherwise(1)
    order = ["_ended", "completed_at", *[c for c in ("id",) if c not in keys]]
    return last_per_key(events.withColumn("_ended", ended), keys, order).drop("_ended")


def valid_states(events: DataFrame) -> DataFrame:
    """Fail on an event whose status is none of the known ones."""
    known = F.coalesce(F.col("status").isin(schemas.AUDIT_STATES), F.lit(False))
    message = F.concat(F.lit("unknown audit status: "), F.coalesce(F.col("status"), F.lit("NULL")))
    return events.filter(F.when(known, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
