"""Landing of pages and files with retries, resuming and fallbacks, and readers of tabular sources.

Fetching is the landing layer's work and stays outside Spark plans: a fetch is a function of the caller's, which may reach a
network, a folder or a fixture. What has landed is read as tables.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..operators.shared import checkpointed

#: Seconds between attempts: fixed values.
DELAYS = (5, 10, 20, 30, 60)
#: The columns of a queue project, in order: fixed values.
QUEUE_COLUMNS = ("iso_region", "source_id", "project_name", "substation_name", "state", "capacity_mw", "queue_status", "queue_date", "in_service_date", "withdrawal_date", "fuel_type", "ia_executed", "county", "load_zone")


def with_retries(fetch: Callable, *args, delays: tuple = DELAYS, errors: tuple = (OSError,), sleep: Callable = time.sleep):
    """What fetch returns; an error is retried after each delay, and the last one raised."""
    for delay in (*delays, None):
        try:
            return fetch(*args)
        except errors:
            if delay is None:
                raise
            sleep(delay)


def fetch_pages(fetch: Callable[[int, int], dict], folder: str, size: int = 1000, items: str = "features", **retry) -> str:
    """Pages of a service, one JSON file each, until one is empty, short, or says that nothing exceeds its limit.

    fetch(offset, size) gives an object with a list under `items`. Pages that are there already are not fetched again: the
    next offset follows from the last of them. A page is written beside its name and renamed, so a cut-off write leaves no
    page. Returns the folder, for spark.read.json.
    """
    os.makedirs(folder, exist_ok=True)
    offset = 0
    for name in sorted(n for n in os.listdir(folder) if n.startswith("page_") and n.endswith(".json")):
        with open(f"{folder}/{name}") as f:
            offset = int(name[5:-5]) + len(json.load(f)[items])
    while True:
        page = with_retries(fetch, offset, size, **retry)
        found = page.get(items) or []
        if found:
            path = f"{folder}/page_{offset:012d}.json"
            with open(path + ".part", "w") as f:
                json.dump(page, f)
            os.replace(path + ".part", path)
        offset += len(found)
        if not found or page.get("exceededTransferLimit") is False or (len(found) < size and page.get("exceededTransferLimit") is not True):
            return folder


def download(fetch: Callable[[int], tuple[int, bytes]], path: str, most_days: float = 7.0, now: Callable[[], float] = time.time, **retry) -> str:
    """A file that is fetched anew when it is older than most_days, continued where a part of it has landed.

    fetch(start) gives a status and bytes: 206 continues from `start`, any other status is the whole file.
    """
    if os.path.exists(path) and now() - os.path.getmtime(path) < most_days * 86_400:
        return path
    part = path + ".part"
    start = os.path.getsize(part) if os.path.exists(part) else 0
    status, data = with_retries(fetch, start, **retry)
    with open(part, "ab" if status == 206 else "wb") as f:
        f.write(data)
    os.replace(part, path)
    return path


def is_stale(path: str, days: float = 30.0, now: Callable[[], float] = time.time) -> bool:
    return now() - os.path.getmtime(path) > days * 86_400


def first_source(sources: list[tuple[str, Callable[[], DataFrame]]]) -> tuple[DataFrame, dict[str, str]]:
    """The first source that can be read to its end, and what happened to each tried; the last error is raised if none can. A
    source is landed in the shared folder before it is chosen, as a DataFrame is read only when it is used."""
    said: dict[str, str] = {}
    for k, (name, read) in enumerate(sources):
        try:
            found = checkpointed(read(), "landed")
            said[name] = "ok"
            return found, said
        except Exception as e:  # noqa: BLE001  any failure of a source leads to the next one
            said[name] = f"{type(e).__name__}: {e}"
            if k == len(sources) - 1:
                raise
    raise ValueError("no source")


def all_sources(sources: dict[str, Callable[[], DataFrame]]) -> tuple[list[DataFrame], dict[str, str]]:
    """All sources that can be read to their end, landed in the shared folder; a failure is noted and the others go on."""
    found, said = [], {}
    for name, read in sources.items():
        try:
            found.append(checkpointed(read(), "landed"))
            said[name] = "ok"
        except Exception as e:  # noqa: BLE001
            said[name] = f"{type(e).__name__}: {e}"
    return found, said


def csv(spark: SparkSession, path: str, schema: str | None = None, keep: str | None = None) -> DataFrame:
    """A CSV with a header: typed by a schema, else all strings; rows by a condition that the scan can take."""
    reader = spark.read.option("header", True)
    df = (reader.schema(schema) if schema else reader.option("inferSchema", False)).csv(path)
    return df.filter(keep) if keep else df


def probed(spark: SparkSession, path: str, wanted: dict[str, list[str]]) -> DataFrame:
    """Columns by the first of several names that a Parquet file has, null where it has none; only its schema is read for that."""
    names = spark.read.parquet(path).schema.fieldNames()
    chosen = {out: next((n for n in options if n in names), None) for out, options in wanted.items()}
    return spark.read.parquet(path).select(*[(F.col(f"`{n}`") if n else F.lit(None).cast("string")).alias(out) for out, n in chosen.items()])


def geojson_path(path: str) -> str:
    """A file, the file of its own name in a folder, or the folder's only GeoJSON file."""
    if not os.path.isdir(path):
        return path
    own = os.path.join(path, os.path.basename(path.rstrip("/")))
    if os.path.isfile(own):
        return own
    found = sorted(n for n in os.listdir(path) if n.endswith(".geojson"))
    if len(found) != 1:
        raise ValueError(f"{path} has {len(found)} GeoJSON files")
    return os.path.join(path, found[0])


def files_read(spark: SparkSession, path: str) -> DataFrame:
    """Of each file: path, modification time, and the first 16 hex digits of its SHA-256."""
    rows = spark.read.format("binaryFile").load(path)
    return rows.select("path", F.col("modificationTime").alias("modified"), F.substring(F.sha2("content", 256), 1, 16).alias("sha16"))


def queue_projects(df: DataFrame, region: str, names: dict[str, str], formats: tuple[str, ...] = ("yyyy-MM-dd", "MM/dd/yyyy")) -> DataFrame:
    """A region's queue in the fourteen columns: names maps them to the source's, what it lacks is null. The id gets the
    region's prefix, capacity and dates are read leniently, the status is normalised. capacity_mw may name several columns,
    separated by '|': the least counts."""
    def of(column: str):
        return F.col(f"`{names[column]}`") if column in names else F.lit(None).cast("string")

    def day(column: str):
        return F.coalesce(*[F.to_date(F.try_to_timestamp(of(column).cast("string"), F.lit(f))) for f in formats])

    capacities = [F.regexp_replace(F.col(f"`{c}`").cast("string"), ",", "").try_cast("double") for c in names.get("capacity_mw", "").split("|") if c]
    values = {
        "iso_region": F.lit(region), "source_id": F.concat(F.lit(f"{region}-"), of("source_id").cast("string")),
        "capacity_mw": F.least(*capacities) if len(capacities) > 1 else (capacities[0] if capacities else F.lit(None).cast("double")),
        "queue_status": rules.queue_status(of("queue_status").cast("string")), "ia_executed": F.coalesce(of("ia_executed").cast("string").rlike("(?i)^(true|yes|executed|ia executed)"), F.lit(False)),
        **{c: day(c) for c in ("queue_date", "in_service_date", "withdrawal_date")},
    }
    return df.select(*[(values[c] if c in values else of(c).cast("string")).alias(c) for c in QUEUE_COLUMNS])
