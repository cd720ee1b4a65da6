import math

import duckdb
import pytest

from sitespark.plans import registry, sites

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def rows(columns, data):
    def one(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return "null"
        return repr(round(float(v), 4)) if isinstance(v, (int, float)) and not isinstance(v, bool) or type(v).__name__ == "Decimal" else str(v)[:19]

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([one(r[i]) for i in order] for r in data)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_matches_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = db.execute(registry.SQL[name])
    names = [c[0] for c in want.description]
    got = registry.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, map(tuple, got.collect())) == rows(names, want.fetchall())


def test_flagship_uses_an_equi_join(spark):
    plan = sites.site_scores(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_pixel_components_match_a_flood_fill(spark):
    cells = {(r["row"], r["col"]) for r in sites.pixels(spark, DATA).filter("k % 2 = 0").collect()}
    sizes = []
    while cells:
        todo, n = [cells.pop()], 0
        while todo:
            r, c = todo.pop()
            n += 1
            for x in ((r + i, c + j) for i in (-1, 0, 1) for j in (-1, 0, 1)):
                if x in cells:
                    cells.remove(x)
                    todo.append(x)
        sizes.append(n)
    assert sorted(sizes) == sorted(r["pixel_count"] for r in sites.pixel_components(spark, DATA).collect())
