"""Airline operators on a hand-made fixture covering the edge cases of the
source program (blank / negative fractional delays, cancelled rows, blank
last field, ties, departure at noon, unpadded times, other years)."""

import datetime as dt

from pyspark.sql import functions as F

from skyframe.operators import flights as fl
from skyframe.sources.files import parse_flight_lines, read_flights

LINES = [
    # year,date,dep,dow,carrier,flt,origin,dest,depdelay,arrtime,arrdelay,cancelled
    "2008,2008-01-17,0930,4,AA,1,JFK,ORD,-0.9,1100,-1.9,0",
    "2008,2008-01-17,1159,4,AA,2,JFK,ORD,10.5,1300,5.5,0",
    "2008,2008-01-17,1200,4,UA,3,JFK,ORD,3,1400,2,0",
    "2008,2008-01-17,930,4,UA,4,JFK,ORD,,1100,,0",
    "2008,2008-01-19,1359,6,DL,5,ORD,LAX,1,1600,3,",
    "2008,2008-01-19,1530,6,AA,6,ORD,LAX,1,1700,4,1",
    "2009,2009-02-04,1000,3,DL,7,ORD,SFO,7,1200,7,0",
    "2008,2008-01-18,1300,5,UA,8,LAX,BOS,2,1500,3,0",
]


def flights(spark, tmp):
    path = f"{tmp}/flights.csv"
    with open(path, "w") as fh:
        fh.write("\n".join(LINES) + "\n")
    return read_flights(spark, path)


def test_delay_cut_towards_zero_and_blank_is_zero(spark, tmp):
    df = flights(spark, tmp)
    got = {r["flt_num"]: r["d"] for r in df.select("flt_num", fl.delay_int("dep_delay").alias("d")).collect()}
    assert got["1"] == 0 and got["4"] == 0 and got["2"] == 10
    got = {r["flt_num"]: r["d"] for r in df.select("flt_num", fl.delay_int("arr_delay").alias("d")).collect()}
    assert got["1"] == -1 and got["4"] == 0


def test_text_lines_parse_like_csv(spark, tmp):
    a = flights(spark, tmp)
    b = parse_flight_lines(spark.createDataFrame([(x,) for x in LINES], "value string"))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_blank_last_field_is_not_cancelled(spark, tmp):
    df = flights(spark, tmp)
    kept = fl.not_cancelled(df).select("flt_num").collect()
    assert {r[0] for r in kept} == {"1", "2", "3", "4", "5", "7", "8"}
    assert fl.not_cancelled(df, "as_coded").count() == len(LINES)


def test_top_airports_counts_origin_and_dest_with_name_tiebreak(spark, tmp):
    rows = fl.top_airports(flights(spark, tmp), 3).collect()
    assert [(r.airport, r.flights) for r in rows] == [("ORD", 7), ("JFK", 4), ("LAX", 3)]


def test_carrier_mean_is_float_of_int_sum(spark, tmp):
    rows = fl.carriers_by_arr_delay(flights(spark, tmp), 10).collect()
    means = {r.carrier: r.mean_arr_delay for r in rows}
    # AA: -1 + 5 (flight 6 cancelled) -> 2.0; UA: 2 + 0 + 3 -> 5/3; DL: 3 + 7 -> 5.0
    assert means["AA"] == 2.0 and abs(means["UA"] - 5 / 3) < 1e-6 and means["DL"] == 5.0
    assert [r.carrier for r in rows] == ["UA", "AA", "DL"]


def test_route_operators(spark, tmp):
    df = flights(spark, tmp)
    r = fl.route_delay(df, "JFK", "ORD").first()
    assert abs(r.mean_arr_delay - (-1 + 5 + 2 + 0) / 4) < 1e-6
    c = fl.carriers_on_route(df, "JFK", "ORD").collect()
    assert [x.carrier for x in c] == ["UA", "AA"]
    d = fl.dests_by_dep_delay(df, "ORD").collect()
    assert [x.dest for x in d] == ["LAX", "SFO"]


def test_leg_rules(spark, tmp):
    """Validator checks: start 17/01/2008; leg 1 same day before noon, leg 2
    two days later after noon; noon fits neither; only the given year."""
    df = flights(spark, tmp)
    l1 = {r.flt_num for r in fl.leg(df, 1, "2008-01-17", 2008).collect()}
    l2 = {r.flt_num for r in fl.leg(df, 2, "2008-01-17", 2008).collect()}
    assert l1 == {"1", "2", "4"}          # 0930, 1159, unpadded 930; 1200 excluded
    assert l2 == {"5", "6"}               # 1359, 1530 on the 19th
    assert fl.leg(df, 1, "2009-02-04", 2008).count() == 0


def test_itinerary_best_per_leg(spark, tmp):
    rows = fl.itinerary(flights(spark, tmp), "JFK", "ORD", "LAX", "2008-01-17", 2008).orderBy("leg").collect()
    assert [(r.leg, r.flt_num) for r in rows] == [(1, "1"), (2, "5")]
    assert rows[0].start_date == dt.date(2008, 1, 17)


def test_daily_delay(spark, tmp):
    rows = fl.daily_delay(flights(spark, tmp), "ORD").collect()
    assert len(rows) == 1 and rows[0].flt_date == dt.date(2008, 1, 17)


def test_equal_means_break_ties_by_name(spark):
    rows = ["2008,2008-01-17,0900,4,ZZ,1,A,B,0,1000,4,0", "2008,2008-01-17,0900,4,AB,2,A,B,0,1000,4.7,0",
            "2008,2008-01-17,0900,4,MM,3,A,B,0,1000,6,0"]
    df = parse_flight_lines(spark.createDataFrame([(x,) for x in rows], "value string"))
    got = [(r.carrier, r.mean_arr_delay) for r in fl.carriers_by_arr_delay(df, 10).collect()]
    assert got == [("AB", 4.0), ("ZZ", 4.0), ("MM", 6.0)]      # 4.7 cut to 4: tie, then by name
    bad = parse_flight_lines(spark.createDataFrame([("2008,17/01/2008,0900,4,ZZ,1,A,B,0,1000,4,0",)], "value string"))
    assert bad.first().flt_date is None and fl.leg(bad, 1, "2008-01-17", 2008).count() == 0
