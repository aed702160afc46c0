"""Airline on-time analytics: busiest airports, delay rankings by carrier,
route and destination, and the two-leg itinerary finder.

Every function takes a flights DataFrame (see ``sources.files.read_flights``
or ``plans.adapters.flights``) and returns a DataFrame, so the same code
serves a batch table and a streaming one (inside ``foreachBatch`` for the
sorted top-k step).

Delays follow the source program: the text value is read as a float and
cut towards zero to an int; a blank counts as 0 and is still counted.  Sums
are kept as long (the source's int could overflow) and the mean is the
float quotient ``total / n``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def delay_int(c: str | Column) -> Column:
    """float delay -> int, truncated towards zero; blank/null -> 0."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("float").cast("int"), F.lit(0))


def not_cancelled(df: DataFrame, mode: str = "intended") -> DataFrame:
    """Drop cancelled flights (cancelled == 1).

    ``mode='as_coded'`` keeps every row, as the source program does (its
    Float-vs-Integer comparison is never true).
    """
    if mode == "as_coded":
        return df
    return df.filter(F.coalesce(F.col("cancelled").cast("float"), F.lit(0.0)) != 1.0)


def on_route(df: DataFrame, origin: str, dest: str | None = None) -> DataFrame:
    cond = F.col("origin") == origin
    if dest is not None:
        cond = cond & (F.col("dest") == dest)
    return df.filter(cond)


def mean_delay(df: DataFrame, keys: list[str], delay: str, name: str) -> DataFrame:
    """(sum, count) per key merged into a float mean -- partial aggregation
    runs map-side, so only one row per key and task crosses the shuffle."""
    d = delay_int(delay).cast("long")
    return (df.groupBy(*keys)
              .agg(F.sum(d).alias("_total"), F.count(F.lit(1)).alias("_n"))
              .select(*keys, (F.col("_total") / F.col("_n")).cast("float").alias(name)))


def top_airports(df: DataFrame, k: int = 10) -> DataFrame:
    """Each flight counts once for its origin and once for its destination."""
    airports = df.select(F.explode(F.array("origin", "dest")).alias("airport"))
    counts = airports.groupBy("airport").agg(F.count(F.lit(1)).alias("flights"))
    return counts.orderBy(F.desc("flights"), F.asc("airport")).limit(k)


def carriers_by_arr_delay(df: DataFrame, k: int = 10, cancelled_mode: str = "intended") -> DataFrame:
    means = mean_delay(not_cancelled(df, cancelled_mode), ["carrier"], "arr_delay", "mean_arr_delay")
    return means.orderBy("mean_arr_delay", "carrier").limit(k)


def dests_by_dep_delay(df: DataFrame, origin: str, k: int = 10) -> DataFrame:
    """No cancelled filter: the source's filter is never applied (B2)."""
    means = mean_delay(on_route(df, origin), ["origin", "dest"], "dep_delay", "mean_dep_delay")
    return means.orderBy("mean_dep_delay", "dest").limit(k)


def carriers_on_route(df: DataFrame, origin: str, dest: str, k: int = 10) -> DataFrame:
    means = mean_delay(on_route(df, origin, dest), ["origin", "dest", "carrier"],
                       "arr_delay", "mean_arr_delay")
    return means.orderBy("mean_arr_delay", "carrier").limit(k)


def route_delay(df: DataFrame, origin: str, dest: str) -> DataFrame:
    return mean_delay(on_route(df, origin, dest), ["origin", "dest"], "arr_delay", "mean_arr_delay")


def _hhmm_value(c: str) -> Column:
    """'HHmm' text (left-padded) -> int HHmm, or null when not a valid time."""
    t = F.lpad(F.trim(F.col(c)), 4, "0")
    ok = t.rlike("^[0-9]{4}$") & (F.substring(t, 1, 2).cast("int") < 24) \
        & (F.substring(t, 3, 2).cast("int") < 60)
    return F.when(ok, t.cast("int"))


def leg(df: DataFrame, leg_no: int, start_date: str | None = None, year: int | None = 2008) -> DataFrame:
    """Rows that can fly leg 1 (date = start, dep < 12:00) or leg 2
    (date = start + 2 days, dep > 12:00).  Noon fits neither leg.

    With ``start_date=None`` every date is a possible start: the result has
    a ``start_date`` column and each row is matched to the start it serves.
    """
    hhmm = _hhmm_value("dep_time")
    offset = 0 if leg_no == 1 else 2
    time_ok = (hhmm < 1200) if leg_no == 1 else (hhmm > 1200)
    out = df.filter(time_ok).withColumn("start_date", F.date_sub(F.col("flt_date"), offset))
    if start_date is not None:
        day = _dt.date.fromisoformat(start_date) + _dt.timedelta(days=offset)
        out = out.filter(F.col("flt_date") == F.lit(day))
    if year is not None:
        out = out.filter(F.year("flt_date") == year)
    return out.withColumn("leg", F.lit(leg_no))


def best_leg(df: DataFrame, group: list[str]) -> DataFrame:
    """Lowest mean arrival delay per group; ties by carrier, then flight
    number.  A struct minimum is an ordinary aggregate (partial + final), so
    a hot group never lands whole in one task."""
    keys = group + ["origin", "dest", "flt_date", "carrier", "flt_num"]
    per_flight = (df.groupBy(*keys)
                    .agg(F.sum(delay_int("arr_delay").cast("long")).alias("_total"),
                         F.count(F.lit(1)).alias("_n"),
                         F.min("dep_time").alias("dep_time"))
                    .withColumn("mean_arr_delay", (F.col("_total") / F.col("_n")).cast("float")))
    best = per_flight.groupBy(*group).agg(F.min(F.struct(
        "mean_arr_delay", "carrier", "flt_num", "origin", "dest", "flt_date", "dep_time")).alias("b"))
    return best.select(*group, "b.*")


def legs(df: DataFrame, origin: str, transit: str, dest: str, start_date: str | None = None,
         year: int | None = 2008) -> DataFrame:
    """Flights that can fly leg 1 (X->Y) or leg 2 (Y->Z), in one pass over
    the data: one filter on both routes, then each row is tagged with the
    legs it fits (a row fitting both, when the routes coincide, is kept
    once per leg) and the start date it serves."""
    c1 = (F.col("origin") == origin) & (F.col("dest") == transit)
    c2 = (F.col("origin") == transit) & (F.col("dest") == dest)
    hhmm = _hhmm_value("dep_time")
    tags = F.filter(F.array(F.when(c1 & (hhmm < 1200), F.lit(1)), F.when(c2 & (hhmm > 1200), F.lit(2))),
                    lambda x: x.isNotNull())
    out = (df.filter(c1 | c2).withColumn("leg", F.explode(tags))
             .withColumn("start_date", F.date_sub(F.col("flt_date"), F.when(F.col("leg") == 1, 0).otherwise(2))))
    if start_date is not None:
        out = out.filter(F.col("start_date") == F.lit(_dt.date.fromisoformat(start_date)))
    if year is not None:
        out = out.filter(F.year("flt_date") == year)
    return out


def itinerary(df: DataFrame, origin: str, transit: str, dest: str,
              start_date: str | None = None, year: int | None = 2008) -> DataFrame:
    """Best flight for X->Y on the start date before noon and for Y->Z two
    days later after noon; one row per leg (and per start date when
    ``start_date`` is None)."""
    return best_leg(legs(df, origin, transit, dest, start_date, year), ["leg", "start_date"])


def daily_delay(df: DataFrame, dest: str) -> DataFrame:
    """Mean departure and arrival delay per day for flights into ``dest``."""
    return (df.filter(F.col("dest") == dest)
              .groupBy("flt_date")
              .agg(F.avg("dep_delay").alias("avg_dep_delay"),
                   F.avg("arr_delay").alias("avg_arr_delay")))
