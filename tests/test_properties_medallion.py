"""Property tests over the rules, and the medallion build."""

import os

from hypothesis import given, settings
from hypothesis import strategies as st

from signalmart import schemas as S
from signalmart.operators import rules as R
from signalmart.plans import medallion
from tests.conftest import rows

ROW = st.tuples(
    st.one_of(st.none(), st.floats(-100, 300, allow_nan=False).map(lambda x: round(x, 1))),
    st.integers(0, 1), st.integers(0, 1), st.integers(0, 1),
    st.one_of(st.none(), st.sampled_from(["Expo", "Fair (+9)"])),
    st.integers(0, 1), st.integers(0, 1), st.integers(0, 10))


@settings(max_examples=5, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=60))
def test_points_sum_to_score_and_score_in_range(spark, data):
    df = spark.createDataFrame(data, (
        "arrivals_vs_7day_avg_pct double, is_weekend int, is_holiday int, "
        "is_major_event int, event_name string, is_extreme_heat int, is_rain int, "
        "days_in_window long"))
    rules = R.demand_rules()
    out = R.drivers(R.label(R.score(df, rules), warmup=R.warmup_condition()), rules,
                    points_name="pts").collect()
    for r in out:
        assert 0 <= r.pressure_score <= 7
        assert sum(r.pts) == r.pressure_score          # structural reconciliation
        assert (r.score_drivers == S.NO_DRIVERS) == (r.pressure_score == 0)
        assert r.demand_pressure in S.ACCEPTED_LABELS
        assert (r.demand_pressure == "WARMUP") == (r.days_in_window < 7)


def _land(root, dt_, lines):
    os.makedirs(f"{root}/dt={dt_}", exist_ok=True)
    with open(f"{root}/dt={dt_}/a.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_medallion_build_counts_and_tables(spark, tmp_dir):
    fl, wx = f"{tmp_dir}/raw/flights", f"{tmp_dir}/raw/weather"
    _land(fl, "2026-08-12", [
        "LAS,a,CS1,KSFO,2026-08-12 20:00:00,2026-08-12,13,2026-08-12 21:00:00,",
        "LAS,a,CS2,KSFO,2026-08-12 20:00:00,2026-08-12,13,2026-08-12 22:00:00,",
        "LAS,b,,,2026-08-12 21:00:00,2026-08-12,14,2026-08-12 22:00:00,",
        "LAS,short", "LAS,c,CS3,KSFO,2026-08-12 22:00:00,2026-08-12,15,2026-08-12 23:00:00,,too,long"])
    _land(wx, "2026-08-12", [
        "LAS,2026-08-12 13:00:00,2026-08-12,13,109.5,0.0,12.0,2026-08-12 21:00:00,",
        "LAS,2026-08-12 13:00:00,2026-08-12,13,101.0,0.0,12.0,2026-08-13 06:00:00,"])
    cal = spark.createDataFrame([], S.CALENDAR_EVENTS_DDL)
    hol = spark.createDataFrame([], S.HOLIDAYS_DDL)
    counts = medallion.build(spark, fl, wx, cal, hol, f"{tmp_dir}/wh", database="sm_test")
    assert counts["bronze_flights"] == 5 and counts["silver_flights"] == 4
    assert counts["malformed_flights"] == 2 and counts["malformed_weather"] == 0
    assert counts["flights_duplicates_removed"] == 1
    assert counts["bronze_weather"] == 2 and counts["weather_duplicates_removed"] == 1
    g = medallion.gold(spark, "sm_test").filter("arrival_date_local IS NOT NULL").first()
    assert sum(g.driver_points) == g.pressure_score
    assert g.arrivals == 3 and g.temp_max_f == 101.0 and g.is_extreme_heat == 0  # freshest wins
    assert g.demand_pressure == "WARMUP"
    assert spark.table("silver_flights").filter("icao24 = 'a'").first().callsign == "CS2"
    again = medallion.build(spark, fl, wx, cal, hol, f"{tmp_dir}/wh2", database="sm_test_v",
                            silver_as="view")
    assert again == counts


def test_seeds_become_tables_from_header_csv(spark, tmp_dir):
    from signalmart.sources.raw import read_seed
    _land(f"{tmp_dir}/raw/flights", "2026-08-12", [
        "LAS,a,CS1,KSFO,2026-08-12 20:00:00,2026-08-12,13,2026-08-12 21:00:00,"])
    _land(f"{tmp_dir}/raw/weather", "2026-08-12", [
        "LAS,2026-08-12 13:00:00,2026-08-12,13,109.5,0.0,12.0,2026-08-12 21:00:00,"])
    with open(f"{tmp_dir}/events.csv", "w") as fh:
        fh.write("market,event_date,event_name,weight\nLAS,2026-08-12,Expo (+3),1\n")
    with open(f"{tmp_dir}/holidays.csv", "w") as fh:
        fh.write("holiday_date,holiday_name\n2026-08-12,Some Day\n")
    medallion.build(spark, f"{tmp_dir}/raw/flights", f"{tmp_dir}/raw/weather",
                    read_seed(spark, f"{tmp_dir}/events.csv", S.CALENDAR_EVENTS_DDL),
                    read_seed(spark, f"{tmp_dir}/holidays.csv", S.HOLIDAYS_DDL), f"{tmp_dir}/wh", database="sm_seed")
    assert spark.table("sm_seed.seed_calendar_events").first().event_name == "Expo (+3)"
    gold = medallion.gold(spark, "sm_seed")
    from signalmart.operators import quality as Q
    # an event name that looks like points does not upset the check
    assert Q.reconcile(gold).first().passed
    assert rows(Q.text_points(gold), "text_points") == [(gold.first().pressure_score + 3,)]
