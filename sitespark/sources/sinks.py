"""Writers: versioned Parquet, CSV with JSON lists and WKT, GeoJSON, samples and a Markdown report."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import wkt


def flat(df: DataFrame, ring_col: str | None = None) -> DataFrame:
    """Arrays, maps and structs as JSON text, the ring as WKT: what a CSV can hold."""
    out = []
    for f in df.schema.fields:
        if f.name == ring_col:
            out.append(wkt(F.col(f.name)).alias("geometry_wkt"))
        elif f.dataType.typeName() in ("array", "map", "struct"):
            out.append(F.to_json(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(out)


def write_csv(df: DataFrame, path: str, ring_col: str | None = None) -> None:
    flat(df, ring_col).write.mode("overwrite").option("header", True).csv(path)


def write_version(df: DataFrame, root: str, max_records: int = 100_000) -> str:
    """A new version of a table; earlier ones stay as backups. Returns its path, for a pointer to switch to."""
    path = f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", max_records).parquet(path)
    return path


def write_geojson_lines(df: DataFrame, path: str, ring_col: str) -> None:
    """One GeoJSON feature per line."""
    ring = F.array(F.transform(ring_col, lambda p: F.array(p["x"], p["y"])))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*[c for c in df.columns if c != ring_col]).alias("properties"), F.struct(F.lit("Polygon").alias("type"), ring.alias("coordinates")).alias("geometry"))
    df.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)


def write_ordered(df: DataFrame, path: str, *order) -> None:
    """One total order over all files: names and rows ascend together."""
    df.orderBy(*order).write.mode("overwrite").parquet(path)


def sample(df: DataFrame, *order, n: int = 20) -> DataFrame:
    """The first n rows in an order, so that reruns show the same ones."""
    return df.orderBy(*order).limit(n)


def overwrite_in_place(df: DataFrame, path: str) -> DataFrame:
    """Replace the table that df was read from: it is written beside it, the old one is renamed away and the new one into its
    place, so that the input is never read and overwritten at once. The old one stays as .backup the first time, else it is
    deleted, last of all: whenever this ends early, one of path, path.backup and path.old-* has the whole table."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    new, old, backup = (jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + tail) for tail in (f".new-{uuid.uuid4().hex}", "", ".backup"))
    df.write.parquet(new.toString())
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    away = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}") if fs.exists(backup) else backup
    if not fs.rename(old, away):
        raise OSError(f"{path} can't be renamed")
    if not fs.rename(new, old):
        fs.rename(away, old)
        raise OSError(f"{new.toString()} can't be renamed to {path}")
    if away.toString() != backup.toString():
        fs.delete(away, True)
    return spark.read.schema(df.schema).parquet(path)


def actionable(df: DataFrame) -> DataFrame:
    """Rows somebody should act on: shortlisted ones, diligence on retired plants, and parcels to pull of known programs."""
    act = F.col("action")
    plants = F.col("source").isin("EIA-860", "EIA-860-nuclear")
    return df.filter((act == "Shortlist") | ((act == "Reuse Diligence") & plants) | ((act == "Parcel Pull") & (F.col("source") == "EPA-RE-Powering")))


def write_geopackage(layers: dict[str, DataFrame], path: str, ring_col: str, srs: int = 5070, batch: int = 1000) -> None:
    """Layers of a GeoPackage file, for exports small enough for one file: rows reach the driver partition by partition."""
    import sqlite3
    import struct

    from .files import ring_wkb

    db = sqlite3.connect(path)
    db.executescript(
        "PRAGMA application_id = 1196444487; PRAGMA user_version = 10200;"
        "CREATE TABLE IF NOT EXISTS gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);"
        "CREATE TABLE IF NOT EXISTS gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '', last_change TEXT, min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);"
        "CREATE TABLE IF NOT EXISTS gpkg_geometry_columns (table_name TEXT NOT NULL, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL, PRIMARY KEY (table_name, column_name));"
    )
    db.execute("INSERT OR REPLACE INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined', NULL)", (f"EPSG:{srs}", srs, srs))
    for name, df in layers.items():
        plain = flat(df.drop(ring_col))
        columns = plain.columns
        rows = df.select(ring_wkb(F.array(ring_col)).alias("geom"), *[plain_column(df, c) for c in columns])
        db.execute(f'CREATE TABLE "{name}" (fid INTEGER PRIMARY KEY AUTOINCREMENT, geom BLOB, {", ".join(chr(34) + c + chr(34) for c in columns)})')
        db.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, srs_id) VALUES (?, 'features', ?, ?)", (name, name, srs))
        db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'POLYGON', ?, 0, 0)", (name, srs))
        head = b"GP\x00\x01" + struct.pack("<i", srs)
        insert = f'INSERT INTO "{name}" VALUES (NULL, {", ".join("?" * (len(columns) + 1))})'
        waiting = []
        for row in rows.toLocalIterator():
            waiting.append([head + bytes(row[0]) if row[0] is not None else None, *(v if v is None or isinstance(v, (int, float, str)) else str(v) for v in row[1:])])
            if len(waiting) == batch:
                db.executemany(insert, waiting)
                waiting = []
        db.executemany(insert, waiting)
    db.commit()
    db.close()


def plain_column(df: DataFrame, name: str):
    return F.to_json(name).alias(name) if df.schema[name].dataType.typeName() in ("array", "map", "struct") else F.col(name)


def markdown(title: str, tables: dict[str, DataFrame], most: int = 50) -> str:
    """A report of small aggregates."""
    out = [f"# {title}"]
    for name, df in tables.items():
        rows = df.limit(most).collect()
        out += [f"\n## {name}\n", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *("| " + " | ".join(str(v) for v in r) + " |" for r in rows)]
    return "\n".join(out) + "\n"
