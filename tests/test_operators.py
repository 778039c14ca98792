"""Literal cases and properties of the operators."""

import math
import random

import pytest
from pyspark.sql import functions as F

from kelpline import model
from kelpline.functions.geodesy import TransverseMercator, with_grid_position
from kelpline.functions.names import base_name, version
from kelpline.functions.text import format_log_line, normalize_url, strip
from kelpline.functions.times import fix_time, full_date, is_bad_time
from kelpline.operators import catalog as cat
from kelpline.operators import enrichment as en
from kelpline.operators import geo, members, report
from kelpline.operators import masks as mk
from kelpline.operators.lookups import fits_broadcast, lookup_join
from kelpline.plans import steps
from kelpline.policy import Policy, restrict_policy

AREAS = [
    ("RC", 1, 1, 56.0, 12.0), ("RC", 1, 2, 56.0, 16.0), ("RC", 1, 3, 58.0, 16.0), ("RC", 1, 4, 58.0, 12.0),
    ("RO", 1, 1, 54.0, 17.0), ("RO", 1, 2, 54.0, 19.0), ("RO", 1, 3, 55.0, 19.0), ("RO", 1, 4, 55.0, 17.0),
]
AREA_SCHEMA = "area string, polygon_id int, seq int, lat double, lon double"


def texts(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def test_names(spark):
    names = ["a_version_1.zip", "a_version_1_version_2.zip", "x.zip", "plain", "_version_3.zip"]
    assert texts(spark, names, base_name) == ["a", "a", "x", "plain", ""]
    assert texts(spark, names, version) == ["1", "1_version_2", "", "", "3"]


def test_times(spark):
    given = ["9:5", "0905", "09.05", "09:05:30", "25:61", "", None, "24:00", "23:59", "9", "0:0", " 9:5 ", "905"]
    assert texts(spark, given, fix_time) == [
        "09:05", "09:05", "09:05", "09:05", "25:61", "", "", "24:00", "23:59", "9", "00:00", "09:05", "905",
    ]
    bad = texts(spark, given, is_bad_time)
    assert [g for g, b in zip(given, bad) if b] == ["25:61", "24:00", "9", "905"]


def test_dates(spark):
    assert texts(spark, ["1999", "1999-05", "1999-05-06", "", None, "99-05"], full_date) == [
        "1999-01-01", "1999-05-01", "1999-05-06", "", "", "99-05",
    ]


def test_text(spark):
    assert texts(spark, ["  a\t", " b\n", None], strip) == ["a", "b", None]
    urls = [" a\\b/ ", "", "  ", "https://x/", "http://x", "//", None]
    assert texts(spark, urls, normalize_url) == ["https://a/b", "", "", "https://x", "https://http://x", "", ""]
    assert texts(spark, ["Warning", "INFO", "error", None], lambda c: format_log_line(c, F.lit("m"))) == [
        "WARNING: m", "info: m", "ERROR: m", ": m",
    ]


def test_columns_like_are_whole_names_and_case_sensitive():
    columns = ["secchi_depth_m", "visit_Secchi_note", "SECCHI", "substrate", "substrate_extra", "shark_sample_id", "shark_sample_id_md5x"]
    assert mk.select_columns_like(columns, model.SECCHI_COLUMNS) == ["secchi_depth_m", "visit_Secchi_note"]
    assert mk.select_columns_like(columns, model.VALUE_COLUMNS) == ["secchi_depth_m", "visit_Secchi_note", "substrate"]
    assert mk.select_columns_like(columns, model.COMMENT_COLUMNS) == ["shark_sample_id"]


def test_fixed_lists():
    assert len(model.VALUE_COLUMNS) == 30 and len(model.COMMENT_COLUMNS) == 7
    assert len(model.RESTRICTED_PARAMETERS) == 74 and len(set(model.RESTRICTED_PARAMETERS)) == 67
    assert "Rock cove" in model.RESTRICTED_PARAMETERS and "Rock cover" not in model.RESTRICTED_PARAMETERS


def rows(spark, **over):
    base = {
        "data_type_internal": "epibenthos", "parameter": "Rock cove", "value": "5", "quality_flag": "B",
        "scientific_name": "COVER a", "reported_scientific_name": "x COVER", "bottom_depth_m": "1",
        "sample_min_depth_m": "2", "secchi_comment": "c", "sample_latitude_dd": "57.0", "sample_longitude_dd": "13.0",
    }
    cases = [{**base, **{k: v[i] for k, v in over.items()}} for i in range(len(next(iter(over.values()))))]
    schema = ", ".join(f"{c} string" for c in base)
    df = spark.createDataFrame([tuple(c.values()) for c in cases], schema)
    return df.coalesce(1).withColumn("i", F.monotonically_increasing_id())


def restricted(spark, df, **policy):
    areas = spark.createDataFrame(AREAS, AREA_SCHEMA)
    return steps.restrict(df, areas, Policy(restrict=True, **policy))


def test_parameters_mask_by_exact_name(spark):
    found = restricted(spark, rows(spark, parameter=["Rock cove", "Rock cover", "secchi depth", None])).orderBy("i").collect()
    assert [r.value for r in found] == ["999", "5", "5", "5"]
    assert {r.secchi_comment for r in found} == {"NA"} and {r.bottom_depth_m for r in found} == {"999"}


def test_sample_depths_follow_the_reduced_area_only(spark):
    df = rows(spark, sample_latitude_dd=["57.0", "54.5", "60.0", None, ""], sample_longitude_dd=["13.0", "18.0", "18.0", "13.0", "x"])
    found = restricted(spark, df).orderBy("i").collect()
    assert [r.bottom_depth_m for r in found] == ["999", "999", "1", "1", "1"]
    assert [r.sample_min_depth_m for r in found] == ["999", "2", "2", "2", "2"]


def test_blank_and_null_cells_are_overwritten(spark):
    found = restricted(spark, rows(spark, bottom_depth_m=["", None])).collect()
    assert [r.bottom_depth_m for r in found] == ["999", "999"]


def test_secchi_flags(spark):
    df = rows(spark, data_type_internal=["physicalchemical"] * 4 + ["epibenthos"], parameter=["Secchi depth", "QFLAG Secchi depth", "secchi depth", "Secchi depth", "Secchi depth"], quality_flag=["B", "B", "B", None, "B"])
    assert [r.quality_flag for r in restricted(spark, df).orderBy("i").collect()] == ["", "", "B", None, "B"]


def test_rows_outside_areas_are_unchanged_and_restriction_is_idempotent(spark):
    outside = rows(spark, sample_latitude_dd=["60.0"])
    assert restricted(spark, outside).select(outside.columns).collect() == outside.collect()
    once = restricted(spark, rows(spark, parameter=["Rock cove", "x"]))
    twice = restricted(spark, once)
    assert twice.select(once.columns).orderBy("i").collect() == once.orderBy("i").collect()


def test_unrestricted_types_and_profiles(spark):
    df = rows(spark, data_type_internal=["profile", "epibenthos", "sealpathology"])
    found = restricted(spark, df, unrestricted=("sealpathology",)).orderBy("i").collect()
    assert [r.data_type_internal for r in found] == ["epibenthos", "sealpathology"]
    assert [r.bottom_depth_m for r in found] == ["999", "1"] and found[1].location_rc is None
    assert steps.restrict(df, spark.createDataFrame(AREAS, AREA_SCHEMA), Policy()) is df


def test_policy(spark):
    assert restrict_policy() is False and restrict_policy(True) is True

    def allowed(**kw):
        return texts(spark, ["a", "b", "c"], Policy(**kw).allows)

    assert allowed(only=("a",)) == [True] * 3
    assert allowed(restrict=True) == [True] * 3
    assert allowed(restrict=True, only=("a", "b"), dont=("b",)) == [True, False, False]
    assert allowed(restrict=True, unrestricted=("c",)) == [False, False, True]


def test_targets():
    assert cat.publish_targets("prod", True) == [("PROD", True), ("UTVTST", False)]
    assert cat.publish_targets("TEST", False) == [("TEST", False)]
    assert cat.removal_targets("PROD") == ["PROD", "UTV"] and cat.removal_targets("UTV") == ["UTV"]
    with pytest.raises(KeyError):
        cat.publish_targets("nowhere", False)


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def test_replace_latest_keeps_one_version_and_is_idempotent(spark):
    current = names(spark, "a_version_1.zip", "a_version_2.zip", "b_version_1.zip", "x.zip")
    incoming = names(spark, "a_version_3.zip", "a_version_4.zip", "x.zip")
    once = cat.replace_latest(current, incoming)
    assert sorted(r.name for r in once.collect()) == ["a_version_4.zip", "b_version_1.zip", "x.zip"]
    twice = cat.replace_latest(once.select("name"), incoming)
    assert sorted(twice.collect()) == sorted(once.collect())


def test_removal_of_names_without_version(spark):
    left = cat.remove_by_base_name(names(spark, "x.zip", "y_version_1.zip", "z.zip"), names(spark, "x.zip", "y_version_9.zip"))
    assert [r.name for r in left.collect()] == ["z.zip"]
    assert cat.count_waiting_removals(None) == 0


def test_members(spark):
    df = spark.createDataFrame(
        [("p", m, "epibenthos") for m in ["shark_data.txt", "README.txt", "sub/readme", "processed_data/a", "received_data/b", "myreadme.txt"]]
        + [("q", "processed_data/a", "profile")],
        "package string, member string, data_type_internal string",
    )
    left = members.prune_members(df, Policy(restrict=True))
    assert sorted(r.member for r in left.collect()) == ["myreadme.txt", "processed_data/a", "shark_data.txt"]
    assert members.prune_members(df, Policy()).count() == 7
    warned = members.check_members_left(left).collect()
    assert sorted((r.package, r.n_left) for r in warned) == [("p", 2), ("p", 2), ("q", 1)]


def test_log(spark):
    log = spark.createDataFrame([("p", lv, "validation", "m") for lv in model.LOG_LEVELS] + [("p", None, None, None)], report.LOG_SCHEMA)
    assert [r.level for r in report.log_filter(log, "info", "validation").collect()] == ["warning", "error"]
    assert report.live_log(log).count() == 4
    assert report.run_validators(log).count() == 0


def test_enrichment_keeps_rows_and_ignores_absent_columns(spark):
    df = spark.createDataFrame([("epibenthos", "1999", "7", "k1")] * 3, "data_type_internal string, visit_date string, sample_project_code string, k string")
    codes = spark.createDataFrame(
        [("sample_project", "7", "Sju"), ("sample_project", "7", "Zju"), ("sample_project", None, "Ingen")], "field string, code string, name_sv string"
    )
    for folded in (1000, 0):
        named = en.add_names_sv(df, codes, max_folded=folded)
        assert [r.sample_project_name_sv for r in named.collect()] == ["Sju"] * 3
    out = steps.enrich(df, codes).collect()
    assert len(out) == 3 and out[0].sample_date == "1999-01-01" and out[0].reported_visit_date == "1999"
    assert out[0].sample_orderer_name_sv == "" and out[0].delivery_datatype == ""


def test_lookup_join_is_the_same_however_it_runs(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("k"), F.lit("hot").alias("v"))
    table = spark.range(1, 6).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("n"))
    for how in ("left", "inner", "left_anti", "left_semi"):
        small = lookup_join(df, table, ["k"], how, small=True)
        large = lookup_join(df, table, ["k"], how, small=False)
        assert small.columns == large.columns
        assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert fits_broadcast(table) and not fits_broadcast(table, max_rows=3) and not fits_broadcast(table, max_bytes=10)


def inside(ring, y, x):
    hit = False
    for (y1, x1), (y2, x2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            hit = not hit
    return hit


@pytest.mark.parametrize("edges_per_cell,small", [(1000, True), (4, None), (1, False), (geo.EDGES_PER_CELL, None)])
def test_locations_against_brute_force(spark, edges_per_cell, small):
    rng = random.Random(3)
    rings = {}
    for area in ("RC", "RG"):
        for polygon in (1, 2):
            cy, cx = rng.uniform(56, 60), rng.uniform(-3, 18)
            turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(25))
            rings[area, polygon] = [(cy + rng.uniform(0.3, 3) * math.sin(t), cx + rng.uniform(0.3, 3) * math.cos(t)) for t in turns]
    rings["RO", 1] = [(57.0, 15.0), (57.0, 17.0), (59.0, 17.0), (59.0, 15.0)]
    areas = spark.createDataFrame(
        [(a, p, i, y, x) for (a, p), ring in rings.items() for i, (y, x) in enumerate(ring)], AREA_SCHEMA
    )
    points = [(rng.uniform(52, 64), rng.uniform(-8, 23)) for _ in range(1500)]
    points += [(float(y), float(x)) for y in range(56, 60) for x in range(14, 19)]
    points += [v for ring in rings.values() for v in ring]
    df = spark.createDataFrame(points, "sample_latitude_dd double, sample_longitude_dd double")
    found = geo.add_locations(df, areas, edges_per_cell=edges_per_cell, small=small).collect()
    assert len(found) == len(points)
    for r in found:
        y, x = r.sample_latitude_dd, r.sample_longitude_dd
        want = {a: any(inside(ring, y, x) for (b, _), ring in rings.items() if b == a) for a in ("RC", "RG", "RO")}
        assert (r.location_rc, r.location_rg, r.location_ro) == (want["RC"], want["RG"], want["RO"]), (y, x)


def test_crowded_vertices(spark):
    """Rings of hundreds of vertices in a few metres beside coarse ones: cells are cut there, and hold few edges all the same."""
    rng = random.Random(8)
    rings = {("RG", 1): [(50.0, 5.0), (50.0, 25.0), (62.0, 25.0), (62.0, 5.0)]}
    for n, (cy, cx, size) in enumerate([(57.3, 12.4, 1e-2), (57.3001, 12.4002, 1e-4), (58.0, 13.0, 1e-3)]):
        turns = [2 * math.pi * i / 700 for i in range(700)]
        far = [size * (1 + 0.4 * math.sin(9 * t) + 0.05 * rng.random()) for t in turns]
        rings[("RC", "RC", "RO")[n], n + 1] = [(cy + r * math.sin(t), cx + r * math.cos(t)) for t, r in zip(turns, far)]
    areas = spark.createDataFrame([(a, p, i, y, x) for (a, p), ring in rings.items() for i, (y, x) in enumerate(ring)], AREA_SCHEMA)
    points = [(c + rng.gauss(0, s), d + rng.gauss(0, s)) for c, d, s in ((57.3, 12.4, 1e-2), (57.3001, 12.4002, 1e-4), (58.0, 13.0, 1e-3), (57.0, 12.0, 3.0)) for _ in range(300)]
    points += [v for ring in rings.values() for v in ring[::50]]
    df = spark.createDataFrame(points, "sample_latitude_dd double, sample_longitude_dd double")
    tables = geo.area_index(areas, ["RC", "RG", "RO"], few=False)
    assert len(tables) > 3 and [t.count() for t in geo.area_index(areas, ["RC", "RG", "RO"])] == [t.count() for t in tables]
    most = [t.select(F.max(F.greatest(*[F.aggregate(f"_cell_{a}", F.lit(0), lambda n, p: n + F.size(p["edges"])) for a in ("RC", "RG", "RO")]))).first()[0] for t in tables]
    assert max(most) <= geo.EDGES_PER_CELL
    assert sum(t.count() for t in tables) < 60_000
    for r in geo.add_locations(df, areas).collect():
        y, x = r.sample_latitude_dd, r.sample_longitude_dd
        want = [any(inside(ring, y, x) for (b, _), ring in rings.items() if b == a) for a in ("RC", "RG", "RO")]
        assert [r.location_rc, r.location_rg, r.location_ro] == want, (y, x)


def test_many_edges_at_one_point(spark):
    """What no cut can part stays together: forty triangles with a common corner."""
    rings = {}
    for i in range(40):
        t = 2 * math.pi * i / 40
        rings["RC", i] = [(57.0, 12.0), (57 + math.sin(t), 12 + math.cos(t)), (57 + math.sin(t + 0.1), 12 + math.cos(t + 0.1))]
    areas = spark.createDataFrame([(a, p, i, y, x) for (a, p), ring in rings.items() for i, (y, x) in enumerate(ring)], AREA_SCHEMA)
    rng = random.Random(2)
    points = [(57 + rng.gauss(0, s), 12 + rng.gauss(0, s)) for s in (0.5, 1e-3, 1e-6, 1e-8) for _ in range(100)]
    df = spark.createDataFrame(points, "sample_latitude_dd double, sample_longitude_dd double")
    for r in geo.add_locations(df, areas).collect():
        y, x = r.sample_latitude_dd, r.sample_longitude_dd
        assert r.location_rc == any(inside(ring, y, x) for ring in rings.values())


def test_projection(spark):
    grid = TransverseMercator(
        central_meridian=13 + 35 / 60 + 7.692 / 3600, scale=1.00000254, false_northing=-6226307.8640, false_easting=84182.8790
    )
    df = spark.createDataFrame([(66.0, 24.0)], "lat double, lon double")
    r = with_grid_position(df, F.col("lat"), F.col("lon"), "e", "n", grid).first()
    assert abs(float(r.n) - 1135809.413803) < 0.001 and abs(float(r.e) - 555304.016555) < 0.001
    r = with_grid_position(spark.createDataFrame([(57.0, 15.0)], "lat double, lon double"), F.col("lat"), F.col("lon"), "e", "n").first()
    assert str(r.n) == "6317385.921" and str(r.e) == "500000.000"


def test_positions_that_are_none(spark):
    df = spark.createDataFrame([("x", "1"), ("", ""), (None, "NaN"), ("90", "15"), ("95", "400")], "sample_latitude_dd string, sample_longitude_dd string")
    areas = spark.createDataFrame(AREAS, AREA_SCHEMA)
    out = geo.add_locations(geo.add_position_sweref99tm(df), areas).collect()
    assert len(out) == 5 and not any(r.location_rc for r in out)


def test_plan_of_publish(spark, sf_dir):
    """Lookups are broadcast, nothing is a nested loop, the gate and the columns reach the scan."""
    from checks.queries import q_publish

    plan = q_publish(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    assert "l_discount" not in plan
