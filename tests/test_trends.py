"""Moving least squares: gaps, missing values, few points, labels, against a plain fit."""

import datetime as dt

import numpy as np
import pytest

from adcredit.operators import trends

D0 = dt.date(2026, 3, 1)
SCHEMA = "campaign_id string, metric_date date, spend double, attributed_revenue double, conversions long, " \
    "roas double, cac double, inserted_at timestamp"


def frame(spark, rows):
    return spark.createDataFrame(
        [(c, D0 + dt.timedelta(d), 1.0, 1.0, 1, y, 1.0, dt.datetime(2026, 4, 1)) for c, d, y in rows], SCHEMA)


def test_moving_trend_equals_a_plain_fit(spark):
    rng = np.random.default_rng(3)
    rows = [("a", int(d), round(float(y), 6)) for d, y in zip(range(0, 60), rng.normal(5, 2, 60)) if d % 7 != 3]
    rows += [("up", d, 1.0 + d) for d in range(5)] + [("down", d, 9.0 - d) for d in range(5)]
    rows += [("flat", d, 2.0) for d in range(5)] + [("gap", 0, 1.0), ("gap", 40, 2.0)]
    rows += [("odd", 0, 1.0), ("odd", 1, None), ("odd", 2, float("nan")), ("odd", 3, 4.0)]
    got = {(r["campaign_id"], (r["metric_date"] - D0).days): r
           for r in trends.moving_trend(frame(spark, rows), "roas", 14).collect()}
    assert len(got) == len(rows)
    for (c, d), r in got.items():
        points = [(x, y) for k, x, y in rows if k == c and d - 13 <= x <= d and y is not None and y == y]
        assert r["points"] == len(points)
        if len(points) > 1:
            assert r["slope"] == pytest.approx(np.polyfit(*map(np.array, zip(*points)), 1)[0], abs=1e-9)
            assert r["level"] == pytest.approx(np.mean([y for _, y in points]))
        else:
            assert r["slope"] is None
    assert [got[c, 4]["label"] for c in ("up", "down", "flat")] == ["rising", "falling", "stable"]
    assert got["up", 1]["label"] is None and got["up", 0]["level"] == 1.0
    assert (got["gap", 40]["points"], got["gap", 40]["label"]) == (1, None)
    assert got["odd", 3]["slope"] == 1.0 and got["odd", 2]["points"] == 1
    assert trends.moving_trend(frame(spark, rows).limit(0)).count() == 0
    with pytest.raises(ValueError):
        trends.moving_trend(frame(spark, rows), days=1)
