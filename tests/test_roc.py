"""ROC, partial AUC, precision sweep: hand-worked cases of FIXTURES.md."""

import pytest

from quarry.operators import roc


def scored(spark, scores, labels):
    return spark.createDataFrame([(float(s), int(l)) for s, l in zip(scores, labels)],
                                 "score double, label int")


def curve(df):
    return [(r.fpr, r.tpr) for r in roc.roc_curve(df).orderBy("threshold", ascending=False).collect()]


CASES = [
    ([.9, .8, .7, .6], [1, 0, 1, 0], [(0, 0), (0, .5), (.5, .5), (.5, 1), (1, 1)], .75, .25),
    ([.9, .9, .1, .1], [1, 0, 1, 0], [(0, 0), (.5, .5), (1, 1)], .75, .25),
    ([.9, .8, .7, .6], [1, 1, 0, 0], [(0, 0), (0, .5), (0, 1), (1, 1)], 1.0, None),
    ([.5, .5], [1, 0], [(0, 0), (1, 1)], 1.0, None),
]


@pytest.mark.parametrize("scores,labels,points,area,mid", CASES)
def test_curve_and_area(spark, scores, labels, points, area, mid):
    df = scored(spark, scores, labels)
    assert curve(df) == [(pytest.approx(a), pytest.approx(b)) for a, b in points]
    aucs = {(r.lo, r.hi): r.auc for r in roc.partial_auc(df).collect()}
    assert aucs[(0.0, 1.0)] == pytest.approx(area)
    if mid is not None:
        assert aucs[(0.25, 0.75)] == pytest.approx(mid)


def test_precision_sweep_strict(spark):
    df = scored(spark, [.9, .8, .7, .6], [1, 0, 1, 0])
    sw = sorted(((r.threshold, r.precision, r.accuracy) for r in roc.precision_sweep(df).collect()),
                reverse=True)
    assert [round(p, 6) for _, p, _ in sw] == [0, 0, 1, 0.5, round(2 / 3, 6)]
    assert [a for _, _, a in sw] == [.5, .5, .75, .5, .75]


def test_threshold_at_precision(spark):
    # scores 20..1: nine positives, one negative, one positive, then negatives.
    # The sweep visits kept ROC thresholds only; at t = 10 the rows above are
    # 9 positive + 1 negative -> precision 0.9 (t = 11 gives 1.0).
    scores = list(range(20, 0, -1))
    labels = [1] * 9 + [0, 1] + [0] * 9
    sw = roc.precision_sweep(scored(spark, scores, labels))
    pick = roc.threshold_at_precision(sw).collect()
    assert len(pick) == 1 and pick[0].threshold == 10.0
    assert pick[0].precision == pytest.approx(0.9)


def test_no_negatives_gives_null(spark):
    df = scored(spark, [.3, .2], [1, 1])
    assert all(r.fpr is None for r in roc.roc_curve(df).collect())


def test_adjacent_ranges_add_up(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    s = rng.random(300).round(2)
    l = (rng.random(300) < s).astype(int)
    df = scored(spark, s, l)
    a = {(r.lo, r.hi): r.auc for r in roc.partial_auc(df, ranges=[(0, .5), (.5000001, 1), (0, 1)]).collect()}
    assert a[(0.0, 0.5)] + a[(0.5000001, 1.0)] == pytest.approx(a[(0.0, 1.0)])


@pytest.mark.parametrize("ranges", ["1", "3", "64"])
def test_range_count_invariance(spark, ranges):
    import numpy as np
    rng = np.random.default_rng(7)
    s = rng.random(400).round(3)
    l = (rng.random(400) < s).astype(int)
    df = scored(spark, s, l)
    base = sorted((r.threshold, r.fpr, r.tpr) for r in roc.roc_curve(df).collect())
    a2 = sorted(tuple(r) for r in roc.partial_auc(df).collect())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted((r.threshold, r.fpr, r.tpr) for r in roc.roc_curve(df).collect())
        a1 = sorted(tuple(r) for r in roc.partial_auc(df).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == base
    assert [x[:2] for x in a1] == [x[:2] for x in a2]
    assert all(abs(x[2] - y[2]) < 1e-12 for x, y in zip(a1, a2))
