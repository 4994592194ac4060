"""Routed delivery on small networks: shared trunks, welds, road pieces, budgets, private ground."""

import pytest

from strandplan.operators.delivery import delivered

LINE = "sro string, seq long, src string, statut string, mode_pose string, x1 double, y1 double, x2 double, y2 double"
BOX = "bx0 double, by0 double, bx1 double, by1 double"


def plan(spark, infra, roads, pbs, boxes=((-1e4, -1e4, 1e4, 1e4),), pa=("S", "A", 0.0, 0.0)):
    infra = spark.createDataFrame([("S", i, "ft", "E", "7", *map(float, c)) for i, c in enumerate(infra)], LINE)
    roads = spark.createDataFrame([("S", i, "", "", "", *map(float, c)) for i, c in enumerate(roads)], LINE).drop("src", "statut", "mode_pose")
    pb = spark.createDataFrame([("S", f"B{i}", "A", float(x), float(y)) for i, (x, y) in enumerate(pbs)], "sro string, pb_id string, pa_id string, x double, y double")
    pa = spark.createDataFrame([pa], "sro string, pa_id string, x double, y double")
    out = delivered(infra, roads, spark.createDataFrame([tuple(map(float, b)) for b in boxes], BOX), pa, pb)
    rows = sorted((round(r.length_m, 3), r.infra_type, r.mode_pose, r.statut, r._used_by_paths) for r in out["rows"].collect())
    return rows, {r.pb_id: r.outcome for r in out["outcomes"].collect()}


def test_trunk_is_shared_and_ends_are_welded(spark):
    rows, outcomes = plan(spark, [(0, 0, 100, 0), (101, 0, 150, 40), (100.5, 0.5, 160, -40), (300, 300, 400, 300)], [], [(151, 41), (161, -41), (900, 900)])
    assert outcomes == {"B0": "delivered", "B1": "delivered", "B2": "missing_anchor"}
    assert len(rows) == 3 and [r[4] for r in rows if r[0] == 100] == ["B0|B1"] and all(r[1:4] == ("ft", "7", "E") for r in rows)


def test_roads_fill_gaps_as_works_to_create(spark):
    rows, outcomes = plan(spark, [(0, 0, 60, 0), (100, 0, 200, 0)], [(60, 0, 100, 0)], [(200, 0)])
    assert outcomes == {"B0": "delivered"} and (40.0, "gc_neuf", "C0", None, "B0") in rows and len(rows) == 3


@pytest.mark.parametrize("road,boxes", [((60, 0, 100, 0), ((0, -1, 80, 1),)), ((60, 0, 120, 0), ((-1e3, -1e3, 1e3, 1e3),))])
def test_private_or_long_road_pieces_are_refused(spark, road, boxes):
    rows, outcomes = plan(spark, [(0, 0, 60, 0), (road[2], 0, 200, 0)], [road], [(200, 0)], boxes)
    assert rows == [] and outcomes == {"B0": "non_deliverable_no_alternative"}


def test_area_budget_takes_paths_in_order(spark):
    roads = [(k * 40, 0, k * 40 + 40, 0) for k in range(7)] + [(0, -k * 40, 0, -k * 40 - 40) for k in range(5)]
    infra = [(280, 0, 400, 0), (0, -200, 0, -400)]
    _, outcomes = plan(spark, infra, roads, [(400, 0), (0, -400)])
    assert outcomes == {"B0": "delivered", "B1": "sro_ign_cap_exceeded"}


def test_no_route(spark):
    rows, outcomes = plan(spark, [(0, 0, 50, 0), (200, 0, 300, 0)], [], [(300, 0)])
    assert rows == [] and outcomes == {"B0": "unreachable_after_pass2"}
