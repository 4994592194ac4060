"""What steps shuffle or look at, counted, as it decides how they grow."""

from collections import Counter

from pyspark.sql import functions as F

from strandplan.graphs import stored
from strandplan.operators import finalise, script_routes, spatial


def shuffled(spark, run):
    """Rows that run() writes to shuffles."""
    sc = spark.sparkContext
    store, none = sc._jsc.sc().statusStore(), sc._gateway.new_array(sc._jvm.double, 0)

    def stages():
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        found = store.stageList(None, False, False, none, None)
        return {found.apply(i).stageId(): found.apply(i).shuffleWriteRecords() for i in range(found.size())}

    before = max(stages(), default=-1)
    run()
    return sum(n for i, n in stages().items() if i > before)


def apart(spark, n):
    """Lines of 30 m on a lattice of 40 m, off the edges of cells."""
    at = lambda c: (c * 40.0 + 7).cast("double")
    x, y = at(F.col("eid") % 50), at(F.floor(F.col("eid") / 50))
    none = F.array().cast("array<string>").alias("paths")
    return spark.range(n).withColumnRenamed("id", "eid").select(F.lit("A").alias("sro"), "eid", F.lit("ft").alias("src"), F.lit("7").alias("mode_pose"), none, x.alias("x1"), y.alias("y1"), (x + 30).alias("x2"), y.alias("y2"))


def test_twins_are_sought_among_lines_in_few_copies(spark):
    df = apart(spark, 2000)
    a, b = (df.select("sro", F.col("eid").alias(s), *(F.col(c).alias(s + c) for c in finalise.SHAPE)) for s in "ab")
    pairs = spatial.near_twins(a, b, *(tuple(s + c for c in finalise.SHAPE) for s in "ab"), 0.5, ["sro"])
    assert shuffled(spark, lambda: pairs.write.format("noop").mode("overwrite").save()) < 3 * 2000


def test_ends_that_stay_are_not_shuffled_cell_by_cell(spark):
    df = stored(apart(spark, 2000))[0]
    assert shuffled(spark, lambda: finalise.snapped(df).write.format("noop").mode("overwrite").save()) < 7 * 2000


def test_distances_are_not_written_out_in_join_conditions(spark):
    points = spark.createDataFrame([(1, 3.0, 0.3)], "k long, x double, y double")
    lines = spark.createDataFrame([(i, *s) for i, s in enumerate([(0.0, 0.0, 9.0, 0.0), (0.0, 1.0, 9.0, 1.0), (3.0, -200.0, 3.0, 0.0)])], "i long, x1 double, y1 double, x2 double, y2 double")
    df = spatial.beside(points, lines, 0.5, 50.0)
    assert sorted((r.i, round(r.t, 9), r.d) for r in df.collect()) == [(0, round(1 / 3, 9), 0.3), (2, 1.0, 0.3)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert not any("sqrt" in line.lower() for line in plan.splitlines() if "Join" in line)


def test_stored_rows_go_when_they_are_told_to(spark):
    df, forget = stored(spark.range(5).toDF("n"))
    files = df.inputFiles()
    assert sorted(r.n for r in df.collect()) == list(range(5)) and forget()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0])
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def test_a_route_is_not_sought_beyond_its_goal():
    looked = Counter()

    class Out(dict):
        def __missing__(self, n):
            looked[n] += 1
            return [(n + 1, 1.0), (n - 1, 1.0)]

    before = script_routes.search(Out(), 0, {3})
    assert before[3] == 2 and len(looked) < 10
