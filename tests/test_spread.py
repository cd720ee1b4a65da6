from sitespark.functions import overlay
from sitespark.operators import shared


def test_small_files_are_dealt_over_tasks(spark):
    df = spark.range(100, numPartitions=1)
    out = shared.spread(df)
    assert out.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and sorted(r.id for r in out.collect()) == list(range(100))


def test_the_ladder_takes_away_once(monkeypatch):
    import numpy as np

    asked, real = [], overlay.overlay
    monkeypatch.setattr(overlay, "overlay", lambda a, b, op: asked.append(op) or real(a, b, op))
    box = lambda x, h: [np.array([(x, 0), (x + h, 0), (x + h, h), (x, h), (x, 0)], float)]
    assert overlay.rings_area(overlay.ladder(box(0, 10), box(5, 10), (1.0,))) == 50 and asked.count("difference") == 1
