"""Progress of running areas from a stream of log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.progress import LAST_STEP, step_of


def furthest_steps(lines: DataFrame, run: str = "run", line: str = "line", time: str = "ts", late: str = "1 hour", every: str = "1 day") -> DataFrame:
    """run, window, step, percent: of each run and window the furthest step so far; lines later than the watermark are dropped.

    State is one number for each run and open window.
    """
    seen = lines.withColumn("step", step_of(F.col(line))).where("step is not null").withWatermark(time, late)
    return seen.groupBy(run, F.window(time, every).alias("window")).agg(F.max("step").alias("step")).withColumn("percent", F.col("step") * 100.0 / LAST_STEP)
