"""Running versions of the airline queries on a stream of flight records.

Single-aggregation queries (busiest airports, carrier / route delays) run
as they are in complete mode: the state store keeps (sum, count) per key
forever, and the sort + limit is applied to the full result each trigger.
The itinerary finder needs two aggregations in a row, which a stream does
not allow, so the per-flight (sum, count, min departure) is the streaming
state and the best flight per leg is taken inside ``foreachBatch``.
Results go to a versioned table (one version per batch id, so a replayed
batch rewrites its own output).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.operators import flights as fl
from skyframe.streaming import sinks as ssk
from skyframe.streaming.streams import run

BATCH_INTERVAL = "20 seconds"   # the source application's batch interval


def _trigger(interval: str | None):
    return {"availableNow": True} if interval is None else {"processingTime": interval}


def top_airports(stream: DataFrame, out: str, k: int = 10, checkpoint: str | None = None,
                 interval: str | None = BATCH_INTERVAL):
    return run(fl.top_airports(stream, k), "complete", ssk.replace_table(out), checkpoint,
               trigger=_trigger(interval))


def carriers_by_arr_delay(stream: DataFrame, out: str, k: int = 10, checkpoint: str | None = None,
                          interval: str | None = BATCH_INTERVAL, cancelled_mode: str = "intended"):
    return run(fl.carriers_by_arr_delay(stream, k, cancelled_mode), "complete", ssk.replace_table(out),
               checkpoint, trigger=_trigger(interval))


def dests_by_dep_delay(stream: DataFrame, origin: str, out: str, k: int = 10, checkpoint: str | None = None,
                       interval: str | None = BATCH_INTERVAL):
    return run(fl.dests_by_dep_delay(stream, origin, k), "complete", ssk.replace_table(out), checkpoint,
               trigger=_trigger(interval))


def carriers_on_route(stream: DataFrame, origin: str, dest: str, out: str, k: int = 10,
                      checkpoint: str | None = None, interval: str | None = BATCH_INTERVAL):
    return run(fl.carriers_on_route(stream, origin, dest, k), "complete", ssk.replace_table(out), checkpoint,
               trigger=_trigger(interval))


def route_delay(stream: DataFrame, origin: str, dest: str, out: str, checkpoint: str | None = None,
                interval: str | None = BATCH_INTERVAL):
    """Keyed upsert of the route's mean (update mode: only changed keys)."""
    return run(fl.route_delay(stream, origin, dest), "update", ssk.upsert_delta(out, ["origin", "dest"]),
               checkpoint, trigger=_trigger(interval))


def itinerary(stream: DataFrame, origin: str, transit: str, dest: str, out: str, start_date: str | None = None,
              year: int | None = 2008, checkpoint: str | None = None, interval: str | None = BATCH_INTERVAL):
    keys = ["leg", "start_date", "origin", "dest", "flt_date", "carrier", "flt_num"]
    per_flight = (fl.legs(stream, origin, transit, dest, start_date, year).groupBy(*keys)
                    .agg(F.sum(fl.delay_int("arr_delay").cast("long")).alias("_total"),
                         F.count(F.lit(1)).alias("_n"), F.min("dep_time").alias("dep_time")))
    write = ssk.replace_table(out)

    def best(batch_df: DataFrame, batch_id: int) -> None:
        m = batch_df.withColumn("mean_arr_delay", (F.col("_total") / F.col("_n")).cast("float"))
        b = m.groupBy("leg", "start_date").agg(F.min(F.struct(
            "mean_arr_delay", "carrier", "flt_num", "origin", "dest", "flt_date", "dep_time")).alias("b"))
        write(b.select("leg", "start_date", "b.*"), batch_id)

    return run(per_flight, "complete", best, checkpoint, trigger=_trigger(interval))
