"""Alert snapshot/digest and the data-quality checks, each with a negative
case (FIXTURES §2, cases 22-26)."""

import datetime as dt

import pytest

from signalmart import schemas as S
from signalmart.operators import alerts as A
from signalmart.operators import quality as Q

D = dt.date
MART_DDL = ", ".join(
    f"{c} {t}" for c, t in [
        ("daily_key", "string"), ("market", "string"), ("arrival_date_local", "date"),
        ("arrivals", "bigint"), ("trailing_7day_avg", "double"),
        ("arrivals_vs_7day_avg_pct", "double"), ("temp_max_f", "double"),
        ("temp_min_f", "double"), ("precip_total_mm", "double"), ("wind_max_kmh", "double"),
        ("is_weekend", "int"), ("is_holiday", "int"), ("is_major_event", "int"),
        ("event_name", "string"), ("is_extreme_heat", "int"), ("is_pool_weather", "int"),
        ("is_rain", "int"), ("pressure_score", "int"), ("demand_pressure", "string"),
        ("score_drivers", "string"), ("interpretation", "string"), ("driver_points", "array<int>")])


def _row(market, day, label="NORMAL", score=0, drivers=S.NO_DRIVERS, pct=None):
    return (f"{market}|{day}", market, day, 100, 90.0, pct, None, None, None, None,
            0, 0, 0, None, 0, 0, 0, score, label, drivers, S.INTERPRETATIONS.get(label),
            [score] if score else [])


def _mart(spark, rows_):
    return spark.createDataFrame(rows_, MART_DDL)


def test_snapshot_uses_global_latest_day(spark):
    m = _mart(spark, [_row("LAS", D(2026, 8, 13), "HIGH", 4, "weekend (+1); event: X (+2); rain (+1)"),
                      _row("LAX", D(2026, 8, 12)), _row("LAX", D(2026, 8, 11))])
    snap = A.latest_snapshot(m).collect()
    assert [r.market for r in snap] == ["LAS"]          # lagging LAX is absent
    assert [r.market for r in A.alert_rows(A.latest_snapshot(m)).collect()] == ["LAS"]
    digest = A.alert_digest(A.latest_snapshot(m)).first()
    assert digest.markets == 1 and digest.high_markets == 1
    assert "LAS: HIGH | 100 arrivals, n/a% vs trailing avg" in digest.digest


def test_empty_mart_gives_no_alert(spark):
    m = _mart(spark, [])
    assert A.latest_snapshot(m).count() == 0
    assert A.alert_rows(A.latest_snapshot(m)).count() == 0
    assert A.alert_digest(A.latest_snapshot(m)).count() == 0


def test_top_recent_is_ordered_top_k(spark):
    m = _mart(spark, [_row(mk, D(2026, 8, d)) for d in range(1, 10) for mk in ("LAX", "LAS")])
    got = [(r.arrival_date_local.day, r.market) for r in A.top_recent(m, 3).collect()]
    assert got == [(9, "LAS"), (9, "LAX"), (8, "LAS")]


def _checks(spark, m):
    return {r.check: r for r in Q.suite([
        Q.unique(m, ["daily_key"], "gold", ignore_nulls=True),
        Q.not_null(m, ["daily_key", "interpretation"], "gold"),
        Q.accepted_values(m, "demand_pressure", S.ACCEPTED_LABELS, "gold"),
        Q.warmup_window(m), Q.reconcile(m)]).collect()}


def test_clean_mart_passes_every_check(spark):
    days = [D(2026, 8, d) for d in range(1, 10)]
    m = _mart(spark, [_row("LAS", d, "WARMUP" if i < 7 else "NORMAL") for i, d in enumerate(days)])
    res = _checks(spark, m)
    assert all(r.passed for r in res.values()), res
    Q.assert_passed(Q.suite([Q.warmup_window(m)]))


@pytest.mark.parametrize("case,check", [
    ("dup_key", "gold.unique.daily_key"),
    ("null_key", "gold.not_null.daily_key"),
    ("bad_label", "gold.accepted.demand_pressure"),
    ("null_label", "gold.accepted.demand_pressure"),
    ("late_warmup", "gold.warmup_first_days"),
    ("hand_edited_score", "gold.drivers_reconcile"),
])
def test_each_check_reports_its_bad_row(spark, case, check):
    days = [D(2026, 8, d) for d in range(1, 10)]
    data = [_row("LAS", d, "WARMUP" if i < 7 else "NORMAL") for i, d in enumerate(days)]
    r = list(data[8])
    if case == "dup_key":
        data.append(tuple(data[8]))
        data[-1] = tuple([r[0], "LAX"] + r[2:])
    elif case == "null_key":
        r[0] = None
        data[8] = tuple(r)
    elif case == "bad_label":
        r[18] = "SEVERE"
        data[8] = tuple(r)
    elif case == "null_label":
        r[18] = None
        data[8] = tuple(r)
    elif case == "late_warmup":
        r[18] = "WARMUP"
        data[8] = tuple(r)
    elif case == "hand_edited_score":
        r[17] = 3
        data[8] = tuple(r)
    res = _checks(spark, _mart(spark, data))
    assert res[check].bad_rows == 1 and not res[check].passed
    with pytest.raises(AssertionError):
        Q.assert_passed(Q.suite([Q.unique(_mart(spark, data), ["daily_key"], "gold",
                                          ignore_nulls=True),
                                 Q.not_null(_mart(spark, data), ["daily_key"], "gold"),
                                 Q.accepted_values(_mart(spark, data), "demand_pressure",
                                                   S.ACCEPTED_LABELS, "gold"),
                                 Q.warmup_window(_mart(spark, data)),
                                 Q.reconcile(_mart(spark, data))]))


def test_mart_columns_fixed(spark):
    assert [c.split(" ")[0] for c in MART_DDL.split(", ")][:-1] == S.DAILY_COLUMNS


def test_digest_names_high_markets_and_says_what_labels_mean(spark):
    m = _mart(spark, [_row("LAX", D(2026, 8, 13), "HIGH", 4), _row("LAS", D(2026, 8, 13), "HIGH", 5),
                      _row("SFO", D(2026, 8, 13)), _row("LAS", D(2026, 8, 12))])
    by_day = {r.arrival_date_local.day: r for r in A.alert_digest(m).collect()}
    assert by_day[13].subject == "Demand signals 2026-08-13: HIGH in LAS, LAX"
    assert by_day[12].subject == "Demand signals 2026-08-12: no HIGH market"
    lines = by_day[13].digest.split("\n")
    assert len(lines) == 8 and lines[2] == "  " + S.INTERPRETATIONS["HIGH"] and lines[-1] == S.DIGEST_FOOTER


def test_score_check_ignores_marks_in_event_names(spark):
    m = _mart(spark, [_row("LAS", D(2026, 8, 13), "ELEVATED", 2, "event: Expo (+3) Hall (+2)")])
    assert Q.reconcile(m).first().passed
    assert [r.text_points for r in Q.text_points(m).collect()] == [5]
