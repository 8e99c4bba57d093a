"""Run a cycle for every snapshot announced in a landing folder.

An announcement is a small JSON file, ``{"path": ..., "as_of": ...}``, put there
once the snapshot's files are complete.  Announcements are taken in the order of
their arrival, one per micro-batch; the checkpoint remembers which were done.  A
cycle that was published but not yet remembered is run again after a crash, which
changes nothing: the same snapshot as of the same day leads to the same state.  A snapshot
announced late, as of a day before the one last published, is refused: it is logged and left out.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, functions as F

from snapfold.operators import cdc
from snapfold.plans.cycle import CycleReport, run_cycle
from snapfold.sources.lake import Lake


logger = logging.getLogger(__name__)

TRENDS = "gold.hiring_trends"


def last_as_of(lake: Lake) -> dt.date | None:
    """The day of the last published cycle."""
    if not lake.exists(TRENDS):
        return None
    return lake.table(TRENDS).agg(F.max("last_updated")).first()[0]


def run_arrivals(
    lake: Lake, landing: str, checkpoint: str, rules: cdc.ChangeRules = cdc.EMPLOYEES
) -> list[CycleReport]:
    """Process all announcements not processed before, then return."""
    reports = []

    def take(batch: DataFrame, _batch_id: int) -> None:
        # One announcement per batch, so a single row.
        for row in batch.orderBy("as_of").toLocalIterator():
            last = last_as_of(lake)
            if last and row.as_of and row.as_of < last:
                logger.error("refused: %s as of %s, after %s was published", row.path, row.as_of, last)
                continue
            reports.append(run_cycle(lake, row.path, row.as_of, rules))

    announced = (
        lake.spark.readStream.schema("path string, as_of date")
        .option("maxFilesPerTrigger", 1)
        .json(landing)
    )
    query = (
        announced.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return reports
