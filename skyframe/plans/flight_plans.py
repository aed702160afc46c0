"""Airline queries planned directly on the star schema, with the
aggregation pushed below the joins ("eager aggregation").

Catalyst does not move an aggregate under a join.  When the grouping key
of a query (carrier, airport) is a function of a foreign key of the fact
table (part key, supplier key, order key), the fact rows can first be
reduced per foreign key -- partial aggregation in each task, then one
shuffle of (key, partial) rows -- and only the reduced table is joined to
the dimension.  The result is the same as aggregating the joined flights
(sums and counts merge exactly); the shuffled volume drops from one row
per flight to one row per key and task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe.operators.flights import delay_int
from skyframe.plans.joins import bounded_broadcast
from skyframe.session import table


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounded_broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))


def top_airports_star(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """Busiest airports (origin = supplier nation, destination = customer
    nation) from per-supplier and per-order line counts."""
    li = table(spark, sf_dir, "lineitem")
    nation = _nations(spark, sf_dir)
    # origin side: lines per supplier -> supplier nation
    per_supp = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    origin = (per_supp.join(supp, per_supp.l_suppkey == supp.s_suppkey)
                      .groupBy("s_nationkey").agg(F.sum("n").alias("n"))
                      .select(F.col("s_nationkey").alias("nk"), "n"))
    # destination side: lines per order -> per customer -> customer nation
    per_order = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    per_cust = (per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
                         .groupBy("o_custkey").agg(F.sum("n").alias("n")))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    dest = (per_cust.join(cust, per_cust.o_custkey == cust.c_custkey)
                    .groupBy("c_nationkey").agg(F.sum("n").alias("n"))
                    .select(F.col("c_nationkey").alias("nk"), "n"))
    both = origin.unionByName(dest).groupBy("nk").agg(F.sum("n").alias("flights"))
    named = both.join(nation, both.nk == nation.n_nationkey).select(F.col("n_name").alias("airport"), "flights")
    return named.orderBy(F.desc("flights"), F.asc("airport")).limit(k)


def carriers_by_arr_delay_star(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """Carriers (part brands) by mean arrival delay of flights that are not
    cancelled, from per-part (delay sum, count)."""
    # not cancelled; written as simple predicates so the scan can use them
    li = table(spark, sf_dir, "lineitem").filter((F.col("l_returnflag") != "R") | F.col("l_returnflag").isNull())
    arr = F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_quantity") - 20.25).cast("float")
    per_part = li.groupBy("l_partkey").agg(F.sum(delay_int(arr).cast("long")).alias("t"),
                                           F.count(F.lit(1)).alias("n"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("carrier"))
    per_brand = (per_part.join(part, per_part.l_partkey == part.p_partkey)
                         .groupBy("carrier").agg(F.sum("t").alias("t"), F.sum("n").alias("n")))
    return (per_brand.select("carrier", (F.col("t") / F.col("n")).cast("float").alias("mean_arr_delay"))
                     .orderBy("mean_arr_delay", "carrier").limit(k))


def _suppliers_in(spark: SparkSession, sf_dir: str, nation_name: str) -> DataFrame:
    """Supplier keys of one nation (the origin airport)."""
    from skyframe.plans.joins import broadcast_if_small
    n = table(spark, sf_dir, "nation").filter(F.col("n_name") == nation_name).select("n_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return broadcast_if_small(s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select("s_suppkey"))


def _orders_to(spark: SparkSession, sf_dir: str, nation_name: str | None = None) -> DataFrame:
    """(order key, destination nation key) for all orders, or for the
    orders of one destination nation."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    if nation_name is not None:
        n = table(spark, sf_dir, "nation").filter(F.col("n_name") == nation_name).select("n_nationkey")
        c = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select("c_custkey", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_nationkey")


def _dep_delay():
    return delay_int((F.col("l_quantity") - 25).cast("float")).cast("long")


def _arr_delay():
    arr = F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_quantity") - 20.25).cast("float")
    return delay_int(arr).cast("long")


def dests_by_dep_delay_star(spark: SparkSession, sf_dir: str, origin: str, k: int = 10) -> DataFrame:
    """Destinations from one origin by mean departure delay: lines of the
    origin's suppliers (semi join), reduced per order, then per customer
    nation."""
    li = table(spark, sf_dir, "lineitem").join(_suppliers_in(spark, sf_dir, origin),
                                              F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
    per_order = li.groupBy("l_orderkey").agg(F.sum(_dep_delay()).alias("t"), F.count(F.lit(1)).alias("n"))
    od = _orders_to(spark, sf_dir)
    per_nation = (per_order.join(od, per_order.l_orderkey == od.o_orderkey)
                           .groupBy("c_nationkey").agg(F.sum("t").alias("t"), F.sum("n").alias("n")))
    names = _nations(spark, sf_dir)
    out = per_nation.join(names, per_nation.c_nationkey == names.n_nationkey).select(
        F.lit(origin).alias("origin"), F.col("n_name").alias("dest"),
        (F.col("t") / F.col("n")).cast("float").alias("mean_dep_delay"))
    return out.orderBy("mean_dep_delay", "dest").limit(k)


def route_delay_star(spark: SparkSession, sf_dir: str, origin: str, dest: str) -> DataFrame:
    """Mean arrival delay on one route: origin lines (semi join) reduced per
    order, then joined to the orders of the destination's customers."""
    li = table(spark, sf_dir, "lineitem").join(_suppliers_in(spark, sf_dir, origin),
                                              F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
    per_order = li.groupBy("l_orderkey").agg(F.sum(_arr_delay()).alias("t"), F.count(F.lit(1)).alias("n"))
    od = _orders_to(spark, sf_dir, dest)
    tot = per_order.join(od, per_order.l_orderkey == od.o_orderkey, "left_semi").agg(
        F.sum("t").alias("t"), F.sum("n").alias("n"))
    return tot.filter(F.col("n") > 0).select(F.lit(origin).alias("origin"), F.lit(dest).alias("dest"),
                                             (F.col("t") / F.col("n")).cast("float").alias("mean_arr_delay"))


def carriers_on_route_star(spark: SparkSession, sf_dir: str, origin: str, dest: str, k: int = 10) -> DataFrame:
    """Carriers on one route: origin lines (semi join with the origin's
    suppliers), kept when their order goes to the destination (semi join),
    reduced per part, then per brand."""
    li = (table(spark, sf_dir, "lineitem")
          .join(_suppliers_in(spark, sf_dir, origin), F.col("l_suppkey") == F.col("s_suppkey"), "left_semi"))
    od = _orders_to(spark, sf_dir, dest)
    li = li.join(od, li.l_orderkey == od.o_orderkey, "left_semi")
    per_part = li.groupBy("l_partkey").agg(F.sum(_arr_delay()).alias("t"), F.count(F.lit(1)).alias("n"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("carrier"))
    per_brand = (per_part.join(part, per_part.l_partkey == part.p_partkey)
                         .groupBy("carrier").agg(F.sum("t").alias("t"), F.sum("n").alias("n")))
    return (per_brand.select(F.lit(origin).alias("origin"), F.lit(dest).alias("dest"), "carrier",
                             (F.col("t") / F.col("n")).cast("float").alias("mean_arr_delay"))
                     .orderBy("mean_arr_delay", "carrier").limit(k))
