import io
import zipfile

import pytest
from pyspark.sql import functions as F

from sitespark.functions import geometry as g
from sitespark.functions import rules
from sitespark.operators import relational, resolve
from sitespark.sources import files


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("acres", "tier"), [(99.9, "small"), (100, "moderate"), (250, "large"), (500, "very_large"), (1000, "strategic_scale"), (None, None)])
def test_acreage_boundaries(spark, acres, tier):
    assert value(spark, rules.acreage_tier(F.lit(acres).cast("double"))) == tier


@pytest.mark.parametrize(("metres", "percent"), [(0, 100), (5000, 100), (5000.1, 67), (25000, 33), (50000, 10), (50000.1, 0)])
def test_decay_boundaries(spark, metres, percent):
    assert value(spark, rules.decay_percent(F.lit(metres).cast("double"))) == percent


def test_unknown_values(spark):
    none = F.lit(None).cast("double")
    assert value(spark, rules.slope_tier(none, F.lit(3.0))) == "unknown"
    assert value(spark, rules.near(none)) is False
    assert value(spark, rules.rail_score(none, F.lit(True), F.lit(2))) == 5
    assert value(spark, rules.constraint_score(F.lit(False), F.lit(False), none)) == 0


@pytest.mark.parametrize(("text", "kv"), [("345 kV", 345.0), ("115000;230000", 230.0), ("n/a", None), ("69;bad", 69.0)])
def test_voltage(spark, text, kv):
    assert value(spark, rules.voltage_kv(F.lit(text))) == kv


def test_status_prefixes(spark):
    assert [value(spark, rules.queue_status(F.lit(t))) for t in (" Active", "In Service now", "WITHDRAWN", "Suspended", "other")] == ["active", "energized", "withdrawn", "suspended", "unknown"]


def ring(*points):
    return F.array(*[g.point(F.lit(x), F.lit(y)) for x, y in points])


L_SHAPE = [(0, 0), (4, 0), (4, 1), (1, 1), (1, 3), (0, 3), (0, 0)]


def test_polygon_measures(spark):
    shape = ring(*L_SHAPE)
    assert value(spark, g.area(shape)) == 6
    assert value(spark, g.length(shape)) == 14
    assert value(spark, g.contains(shape, F.lit(0.5), F.lit(2.0))) is True
    assert value(spark, g.contains(shape, F.lit(2.0), F.lit(2.0))) is False
    assert value(spark, g.contains(shape, F.lit(0.0), F.lit(2.0))) is False
    assert value(spark, g.covers(shape, F.lit(0.0), F.lit(2.0))) is True
    assert value(spark, g.distance(shape, F.lit(2.0), F.lit(2.0))) == 1
    assert value(spark, g.area(g.clip_to_box(shape, F.lit(0), F.lit(0), F.lit(2), F.lit(2)))) == 3
    assert value(spark, g.is_valid(shape)) is True


def test_albers_round_trip(spark):
    got = spark.createDataFrame([(-96.0, 23.0), (-75.5, 40.25), (-120.1, 35.0)], "lon double, lat double").withColumn("p", g.albers(F.col("lon"), F.col("lat"))).withColumn("q", g.inverse_albers(F.col("p.x"), F.col("p.y"))).collect()
    assert abs(got[0]["p"]["x"]) < 1e-6 and abs(got[0]["p"]["y"]) < 1e-6
    for r in got:
        assert abs(r["q"]["lon"] - r["lon"]) < 1e-8 and abs(r["q"]["lat"] - r["lat"]) < 1e-7


@pytest.mark.parametrize(("a", "b", "score"), [("OAK HILL", "HILL OAK", 100.0), ("OAK HILL", "OAK HILL NORTH", 100.0), ("", "OAK", 0.0), ("OAKS", "OAKE", 75.0)])
def test_token_set_ratio(a, b, score):
    assert resolve.token_set_ratio(a, b) == pytest.approx(score)


def test_match_cascade(spark):
    q = spark.createDataFrame([(1, "Oak Hill 345 kV Substation", "TX"), (2, "Oakk Hill", "TX"), (3, "Nowhere", "TX"), (4, "Oak Hill", None), (5, "(x)", "TX"), (6, "OAKHILL - PINEWOOD LINE", "TX")], "query_id long, name string, state string")
    p = spark.createDataFrame([(10, "OAK HILL", "TX"), (11, "PINE", "TX")], "place_id long, name string, state string")
    got = {r["query_id"]: (r["place_id"], r["method"]) for r in resolve.match(q, p).collect()}
    assert got == {1: (10, "exact"), 2: (10, "fuzzy_high"), 3: (None, "unmatched"), 4: (None, "no_state_filter"), 5: (None, "empty_after_norm"), 6: (None, "unmatched")}


def test_add_columns_refuses_clashes_and_duplicates(spark):
    a, b = spark.createDataFrame([(1, 2)], "k int, v int"), spark.createDataFrame([(1, 3), (1, 4)], "k int, w int")
    with pytest.raises(ValueError):
        relational.add_columns(a, a, "k")
    with pytest.raises(Exception, match="duplicate key"):
        relational.add_columns(a, b, "k").collect()


def test_geojson_and_wkb(spark, tmp_path):
    (tmp_path / "a.geojson").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"n":"1"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,0]]]}},{"type":"Feature","properties":{},"geometry":{"type":"Point","coordinates":[3,4]}}]}')
    got = files.geojson(spark, str(tmp_path / "a.geojson"))
    back = got.withColumn("again", files.wkb_rings(files.ring_wkb(F.col("rings")))).collect()
    assert [r["kind"] for r in back] == ["Polygon", "Point"] and back[0]["rings"] == back[0]["again"]


def test_xlsx(spark, tmp_path):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheets><sheet name="Q"/></sheets></workbook>')
        z.writestr("xl/worksheets/sheet1.xml", '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row><c r="A1" t="inlineStr"><is><t>id</t></is></c></row><row><c r="A2" t="inlineStr"><is><t>21INR1</t></is></c><c r="C2"><v>5</v></c></row><row><c r="A3"><v>7</v></c></row></sheetData></worksheet>')
    (tmp_path / "q.xlsx").write_bytes(data.getvalue())
    got = files.xlsx(spark, str(tmp_path / "q.xlsx"), ["a", "b", "c"], "Q", 1, r"^\d{2}INR").collect()
    assert [tuple(r) for r in got] == [("21INR1", None, "5")]


def test_convex_hull(spark):
    assert g.hull_ring([(0, 0), (2, 0), (1, 0), (2, 2), (1, 1), (0, 2), (0, 0)]) == [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
    assert g.hull_ring([(0, 0), (1, 1), (2, 2), (0, 0)]) == [] == g.hull_ring([])
    flat = F.array(*(g.point(F.lit(i), F.lit(i)) for i in (0, 1, 0)))
    assert value(spark, g.hull_ratio(flat, g.convex_hull(flat))) == 1
    none = F.lit(None).cast("array<struct<x:double,y:double>>")
    assert value(spark, g.convex_hull(none)) is None
    assert value(spark, g.hull_ratio(none, g.convex_hull(none))) is None
