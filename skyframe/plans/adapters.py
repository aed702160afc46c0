"""Adapters from the shared star-schema tables to the record layouts the
operators expect (flights, page views, log lines, words, ratings, baskets,
vectors, graphs).

Each adapter joins only the dimension tables that the requested columns
need: an inner join is never removed by the optimizer, so asking for
``carrier`` alone must not drag ``orders`` and ``customer`` into the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe.plans.joins import bounded_broadcast
from skyframe.session import table

FLIGHT_COLUMNS = [
    "year", "flt_date", "dep_time", "day_of_week", "carrier", "flt_num",
    "origin", "dest", "dep_delay", "arr_time", "arr_delay", "cancelled",
]


def _hhmm(minutes: Column) -> Column:
    """Minutes after midnight -> 'HHmm' text."""
    return F.lpad(((minutes / 60).cast("int") * 100 + minutes % 60).cast("string"), 4, "0")


def _dep_minutes() -> Column:
    return (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 101) % 1440


def _nation_names(spark: SparkSession, sf_dir: str, alias: str) -> DataFrame:
    # 25 rows in every scale factor -> a bounded broadcast
    return bounded_broadcast(
        table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias(f"{alias}_nationkey"), F.col("n_name").alias(alias)))


def flights(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Flight records derived from ``lineitem``.

    carrier = part brand, flight number = part key, origin = supplier nation,
    destination = customer nation (through the order), flight date = ship
    date, delays from the quantity, cancelled when the return flag is R.
    """
    cols = list(columns or FLIGHT_COLUMNS)
    li = table(spark, sf_dir, "lineitem")
    dep = _dep_minutes()
    exprs = {
        "year": F.year("l_shipdate"),
        "flt_date": F.to_date("l_shipdate"),
        "dep_time": _hhmm(dep),
        "day_of_week": F.weekday("l_shipdate") + 1,
        "flt_num": F.col("l_partkey").cast("string"),
        "dep_delay": (F.col("l_quantity") - 25).cast("float"),
        "arr_time": _hhmm((dep + 60 + F.col("l_linenumber") * 13) % 1440),
        "arr_delay": F.when(F.col("l_linenumber") == 7, F.lit(None))
                      .otherwise(F.col("l_quantity") - 20.25).cast("float"),
        "cancelled": F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).cast("float"),
    }
    # joins go from the most to the least selective dimension: a filter on
    # origin / dest is pushed into the 25-row nation table, so those joins
    # shrink the fact rows before the part join
    df = li
    if "origin" in cols:
        supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        supp = supp.join(_nation_names(spark, sf_dir, "origin"),
                         supp.s_nationkey == F.col("origin_nationkey"))
        df = df.join(supp.select("s_suppkey", "origin"), df.l_suppkey == supp.s_suppkey)
    if "dest" in cols:
        # orders (4x smaller than lineitem) meets customer first, so lineitem
        # is shuffled once, on the order key
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        cust = cust.join(_nation_names(spark, sf_dir, "dest"),
                         cust.c_nationkey == F.col("dest_nationkey"))
        order_dest = orders.join(cust, orders.o_custkey == cust.c_custkey).select("o_orderkey", "dest")
        df = df.join(order_dest, df.l_orderkey == order_dest.o_orderkey)
    if "carrier" in cols:
        part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("carrier"))
        df = df.join(part, df.l_partkey == part.p_partkey)
    out = [exprs[c].alias(c) if c in exprs else F.col(c) for c in cols]
    return df.select(*out)



# ---------------------------------------------------------------- page views
def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (url, status, zip, user_id, ts): url = event type, status
    500 for errors else 200, zip = user id mod 10."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("url"),
                     F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
                     (F.col("user_id") % 10).cast("int").alias("zip"),
                     "user_id", "ts")


# ---------------------------------------------------------------- log lines
def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events written as access-log lines.  Signups have a bare ``-`` user,
    views a quoted ``"-"``; cheap purchases log ``-`` bytes; error events
    are malformed lines that match no pattern."""
    ev = table(spark, sf_dir, "events")
    uid = F.col("user_id")
    ip = F.concat_ws(".", F.lit("10"), F.lit("0"), ((uid / 256).cast("long") % 256).cast("string"),
                     (uid % 256).cast("string"))
    user = (F.when(F.col("event_type") == "signup", F.lit("-"))
             .when(F.col("event_type") == "view", F.lit('"-"'))
             .otherwise(F.concat(F.lit('"u'), uid.cast("string"), F.lit('"'))))
    when = F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")
    request = F.concat(F.lit("GET /"), F.col("event_type"), F.lit("?v="),
                       F.floor("value").cast("long").cast("string"), F.lit(" HTTP/1.1"))
    nbytes = F.when(F.col("value") < 1, F.lit("-")).otherwise(
        F.floor(F.col("value") * 100).cast("long").cast("string"))
    line = F.concat(ip, F.lit(" - "), user, F.lit(" ["), when, F.lit(" +0000] \""), request,
                    F.lit("\" 200 "), nbytes, F.lit(' "http://ref.example/" "agent/1.0" extra'))
    return ev.select(F.when(F.col("event_type") == "error",
                            F.concat(F.lit("malformed "), F.col("event_id").cast("string")))
                      .otherwise(line).alias("line"))


# ---------------------------------------------------------------- words
def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.explode(F.split("text", "\n", -1)).alias("line"))


# ---------------------------------------------------------------- ratings
def ratings(spark: SparkSession, sf_dir: str, by_user: bool = False) -> DataFrame:
    """(user, item, rating) = total quantity per (customer, part); ``by_user``:
    the joined lines move once, by user."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    if by_user:
        j = j.select("o_custkey", "l_partkey", "l_quantity").repartition("o_custkey")
    return (j.groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
             .agg(F.sum("l_quantity").cast("float").alias("rating")))


# ---------------------------------------------------------------- baskets
def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order, items): distinct part brands of each order (at most 7 lines)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(p, li.l_partkey == p.p_partkey)
    return (j.groupBy(F.col("l_orderkey").alias("order_id"))
             .agg(F.array_sort(F.collect_set("p_brand")).alias("items")))


def basket_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer, sequence): the customer's baskets in order-date order."""
    b = baskets(spark, sf_dir)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = b.join(o, b.order_id == o.o_orderkey)
    seq = (j.groupBy(F.col("o_custkey").alias("customer"))
            .agg(F.array_sort(F.collect_list(F.struct("o_orderdate", "order_id", "items"))).alias("s")))
    return seq.select("customer", F.transform("s", lambda x: x["items"]).alias("sequence"))


# ---------------------------------------------------------------- vectors
def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, features vector, label double, binary double = label < 5)."""
    from pyspark.ml.functions import array_to_vector
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"),
                    array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
                    F.col("label").cast("double").alias("label"),
                    (F.col("label") < 5).cast("double").alias("binary"))


# ---------------------------------------------------------------- graphs
def part_chain_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directed edges part(line i) -> part(line i+1) inside each order,
    weight = quantity of line i+1.  One edge per line: linear in the data."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    # an equi-join on (order, line + 1) instead of a window over the order:
    # the key includes the line number, so even a huge order spreads out
    a = li.select("l_orderkey", (F.col("l_linenumber") + 1).alias("_next"), F.col("l_partkey").alias("src"))
    b = li.select(F.col("l_orderkey").alias("_o"), F.col("l_linenumber").alias("_ln"),
                  F.col("l_partkey").alias("dst"), F.col("l_quantity").alias("weight"))
    j = a.join(b, (a.l_orderkey == b._o) & (a._next == b._ln))
    return j.filter(F.col("src") != F.col("dst")).select("src", "dst", "weight")


def nation_trade_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct directed edges supplier nation -> customer nation."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    oc = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_nationkey")
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(oc, li.l_orderkey == oc.o_orderkey)
    return j.select(F.col("s_nationkey").cast("long").alias("src"),
                    F.col("c_nationkey").cast("long").alias("dst")).distinct()
