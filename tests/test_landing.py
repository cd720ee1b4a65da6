import json
import os
import sqlite3

import pytest
from pyspark.sql import functions as F

from sitespark.functions import geometry
from sitespark.sources import landing, sinks


def test_retries_and_their_end():
    calls, waits = [], []

    def fetch(x):
        calls.append(x)
        if len(calls) < 3:
            raise OSError("busy")
        return x

    assert landing.with_retries(fetch, 7, sleep=waits.append) == 7 and waits == [5, 10]
    with pytest.raises(OSError):
        landing.with_retries(lambda: (_ for _ in ()).throw(OSError("down")), sleep=lambda s: None)


def test_pages_resume_where_they_stopped(spark, tmp_path):
    items, asked = [{"attributes": {"id": str(i)}} for i in range(25)], []

    def fetch(offset, size):
        asked.append(offset)
        if offset == 20 and len(asked) == 3:
            raise OSError("cut off")
        return {"features": items[offset : offset + size]}

    folder = f"{tmp_path}/pages"
    with pytest.raises(OSError):
        landing.fetch_pages(fetch, folder, 10, delays=())
    landing.fetch_pages(fetch, folder, 10, delays=())
    assert asked == [0, 10, 20, 20] and sorted(os.listdir(folder)) == [f"page_{i:012d}.json" for i in (0, 10, 20)]
    rows = spark.read.schema("features array<struct<attributes:map<string,string>>>").option("multiLine", True).json(folder).select(F.explode("features").alias("f"))
    assert rows.count() == 25
    limited = [{"features": items[:3], "exceededTransferLimit": True}, {"features": items[3:5], "exceededTransferLimit": False}]
    landing.fetch_pages(lambda o, s: limited.pop(0), f"{tmp_path}/other", 10)
    assert len(os.listdir(f"{tmp_path}/other")) == 2


def test_downloads_age_and_resume(tmp_path):
    path, asked = f"{tmp_path}/file", []

    def fetch(start):
        asked.append(start)
        return (206, b"def") if start else (200, b"abc")

    open(path + ".part", "wb").write(b"abc")
    assert open(landing.download(fetch, path), "rb").read() == b"abcdef"
    landing.download(fetch, path)
    assert asked == [3]
    landing.download(fetch, path, now=lambda: os.path.getmtime(path) + 8 * 86_400)
    assert asked == [3, 0] and open(path, "rb").read() == b"abc"
    assert landing.is_stale(path, now=lambda: os.path.getmtime(path) + 31 * 86_400) and not landing.is_stale(path)


def test_fallback_and_failures(spark):
    def broken():
        raise ValueError("no sheet")

    found, said = landing.first_source([("live", broken), ("local", lambda: spark.range(3))])
    assert found.count() == 3 and said == {"live": "ValueError: no sheet", "local": "ok"}
    late = lambda: spark.range(3).select(F.raise_error(F.lit("broken off")).cast("long").alias("id"))  # noqa: E731  fails when it is read
    found, said = landing.first_source([("live", late), ("local", lambda: spark.range(3))])
    assert found.count() == 3 and "broken off" in said["live"]
    with pytest.raises(ValueError):
        landing.first_source([("live", broken)])
    frames, said = landing.all_sources({"a": broken, "b": lambda: spark.range(2)})
    assert [f.count() for f in frames] == [2] and said["a"].startswith("ValueError")


def test_tabular_readers(spark, tmp_path):
    open(f"{tmp_path}/a.csv", "w").write("id,name,state\n1,x,TX\n2,,CA\n")
    assert landing.csv(spark, f"{tmp_path}/a.csv").dtypes == [("id", "string"), ("name", "string"), ("state", "string")]
    assert landing.csv(spark, f"{tmp_path}/a.csv", "id long, name string, state string", "state = 'TX'").collect() == [(1, "x", "TX")]
    spark.createDataFrame([(1, "b")], "new_id long, Label string").write.parquet(f"{tmp_path}/p")
    assert landing.probed(spark, f"{tmp_path}/p", {"id": ["id", "new_id"], "label": ["Label"], "none": ["z"]}).collect() == [(1, "b", None)]
    os.makedirs(f"{tmp_path}/x.geojson")
    json.dump({}, open(f"{tmp_path}/x.geojson/x.geojson", "w"))
    assert landing.geojson_path(f"{tmp_path}/x.geojson").endswith("x.geojson/x.geojson")
    os.makedirs(f"{tmp_path}/d")
    with pytest.raises(ValueError):
        landing.geojson_path(f"{tmp_path}/d")
    one = landing.files_read(spark, f"{tmp_path}/a.csv").first()
    assert len(one["sha16"]) == 16 and one["modified"] is not None


def test_queue_projects(spark):
    rows = [("7", "Solar", "1,200.5", "900", "Active - study", "2024-05-06", "yes"), ("8", None, "bad", "5", "Withdrawn", "06/07/2023", None)]
    df = spark.createDataFrame(rows, "Id string, Title string, MFO string, MW string, State string, Day string, IA string")
    got = landing.queue_projects(df, "PJM", {"source_id": "Id", "project_name": "Title", "capacity_mw": "MFO|MW", "queue_status": "State", "queue_date": "Day", "ia_executed": "IA"})
    assert tuple(got.columns) == landing.QUEUE_COLUMNS
    assert [(r["source_id"], r["capacity_mw"], r["queue_status"], str(r["queue_date"]), r["ia_executed"], r["county"]) for r in got.orderBy("source_id").collect()] == [("PJM-7", 900.0, "active", "2024-05-06", True, None), ("PJM-8", 5.0, "withdrawn", "2023-06-07", False, None)]


def test_overwrite_in_place_keeps_the_first_backup(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(3).write.parquet(path)
    for k in (1, 2):
        out = sinks.overwrite_in_place(spark.read.parquet(path).withColumn(f"c{k}", F.lit(k)), path)
    assert sorted(out.columns) == ["c1", "c2", "id"] and out.count() == 3
    assert spark.read.parquet(path + ".backup").columns == ["id"]


def test_geopackage_and_actionable(spark, tmp_path):
    ring = geometry.box_ring(F.lit(0), F.lit(0), F.lit(2), F.lit(1))
    rows = spark.createDataFrame([("a", "Shortlist", "x"), ("b", "Reuse Diligence", "EIA-860"), ("c", "Reuse Diligence", "x"), ("d", "Parcel Pull", "EPA-RE-Powering"), ("e", "Monitor", "EIA-860")], "id string, action string, source string").withColumn("ring", ring).withColumn("tags", F.array(F.lit("t")))
    keep = sinks.actionable(rows)
    assert {r["id"] for r in keep.collect()} == {"a", "b", "d"}
    sinks.write_geopackage({"all": rows, "actionable": keep}, f"{tmp_path}/out.gpkg", "ring")
    db = sqlite3.connect(f"{tmp_path}/out.gpkg")
    assert db.execute("SELECT count(*) FROM actionable").fetchone() == (3,) and db.execute("SELECT tags FROM \"all\" LIMIT 1").fetchone() == ('["t"]',)
    assert db.execute("SELECT geom FROM actionable LIMIT 1").fetchone()[0][:2] == b"GP"
    db.close()
