"""Progress of a run, from its log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .topology import block_running_count

# Markers of the ordered sub-steps of one service area.
MARKERS = ("[IGN]", "[CDC]", "[PB QA]", "[ROUTING] Graphe brut", "[WELD]", "[TOPO SNAP]", "[ROUTING] ", "[INFRA QA]", "writer :", "[QML]", "[QGZ]")
STARTED, DONE = r"^=== SRO (\S+) ===", r"^\[OK\] SRO (\S+) traite"
LAST_STEP = len(MARKERS)


def step_of(line: Column) -> Column:
    """0 for a start, 1.. for the first marker that a line holds, the last for a done area, null for other lines."""
    out = F.lit(None).cast("int")
    for k, m in reversed(list(enumerate(MARKERS, 1))):
        out = F.when(line.contains(m), F.lit(k)).otherwise(out)
    return F.when(line.rlike(STARTED), F.lit(0)).when(line.rlike(DONE), F.lit(LAST_STEP)).otherwise(out)


def progress(lines: DataFrame, order: str, line: str, areas: int) -> DataFrame:
    """area_no, area, step, percent: the furthest step of each area in turn, and the run's percentage then."""
    text = F.col(line)
    marked = block_running_count(lines.withColumn("_step", step_of(text)), order, text.rlike(STARTED)).where("running > 0")
    name = F.max(F.when(text.rlike(STARTED), F.regexp_extract(text, STARTED, 1)))
    steps = marked.groupBy(F.col("running").alias("area_no")).agg(name.alias("area"), F.coalesce(F.max("_step"), F.lit(0)).alias("step"))
    return steps.withColumn("percent", F.least(F.lit(100.0), ((F.col("area_no") - 1) * LAST_STEP + F.col("step")) * 100.0 / (areas * LAST_STEP)))
