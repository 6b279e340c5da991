"""Spans and the buckets they are cut into."""

import random

from pyspark.sql import functions as F

from venuelake.operators import joins


def test_buckets_cover_a_span_exactly(spark):
    rng = random.Random(1)
    spans = [(a, a + n) for a, n in [(rng.randrange(-5000, 5000), rng.choice([0, 1, 14, 15, 16, 17, 255, 256, 300, 5000])) for _ in range(200)]] + [(0, 0), (0, 15), (0, 255), (0, 256), (-16, -1), (-17, 16), (5, 1 << 40)]
    rows = spark.createDataFrame(spans, "a bigint, b bigint").withColumn("x", joins.span_buckets(F.col("a"), F.col("b"))).collect()
    for r in rows:
        covered = sorted((n.number * 16**n.level, (n.number + 1) * 16**n.level) for n in r.x)
        assert covered[0][0] == r.a and covered[-1][1] == r.b + 1 and all(x[1] == y[0] for x, y in zip(covered, covered[1:]))
        assert len(covered) <= 30 * (1 + len(hex(r.b - r.a + 1)) - 2)


def test_points_in_spans_against_all_pairs(spark):
    rng = random.Random(2)
    spans = [(i, a, a + n) for i, (a, n) in enumerate((rng.randrange(-300, 300), rng.choice([0, 3, 40, 600, -1])) for _ in range(60))] + [(99, None, 5), (100, 5, None)]
    points = [(rng.randrange(-400, 400),) for _ in range(300)] + [(None,)]
    got = joins.join_spans(spark.createDataFrame(points, "p int"), F.col("p"), spark.createDataFrame(spans, "i int, a int, b int"), F.col("a"), F.col("b"))
    want = sorted((p, i) for (p,) in points for i, a, b in spans if None not in (p, a, b) and a <= p <= b)
    assert sorted((r.p, r.i) for r in got.collect()) == want and got.columns == ["p", "i", "a", "b"]
    assert joins.join_spans(spark.createDataFrame(points, "p int"), F.col("p"), spark.createDataFrame(spans[:0], "i int, a int, b int"), F.col("a"), F.col("b")).count() == 0
