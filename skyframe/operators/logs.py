"""Apache access-log statistics: count and bytes per (ip, user, query)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the access-log pattern (ip, ident, user, time, request,
# status, bytes, referrer, agent) whose groups the statistics key on.
APACHE_LOG_PATTERN = (
    r'^([\d.]+) (\S+) (\S+) \[([\w\d:/]+\s[+\-]\d{4})\] "(.+?)" (\d{3}) ([\d\-]+) "([^"]+)" "([^"]+)".*'
)
MARK = "\x01\x02"


def parse(df: DataFrame, col: str = "line") -> DataFrame:
    """Columns ip, user, query, bytes; all null when the line does not match.

    A user written ``-`` or ``"-"`` is anonymous, and an anonymous line has
    a null key.  Bytes ``-`` count as 0.
    """
    # One search a line: the pattern spans the whole line, so a match becomes
    # its four fields behind a mark, and a line without one stays as it is.
    fields = F.split(F.regexp_replace(F.col(col), APACHE_LOG_PATTERN, f"{MARK}$1{MARK}$3{MARK}$5{MARK}$7"), MARK)
    df = df.select(fields.alias("_f"))
    g = lambda i: F.get("_f", F.lit(i))
    ok = F.size("_f") == 5
    user = g(2)
    anonymous = user.isin("-", '"-"')
    keyed = ok & ~anonymous
    return df.select(
        F.when(keyed, g(1)).alias("ip"),
        F.when(keyed, user).alias("user"),
        F.when(keyed, g(3)).alias("query"),
        F.when(ok, F.coalesce(g(4).try_cast("int"), F.lit(0))).otherwise(0).alias("bytes"),
    )


def query_stats(df: DataFrame, col: str = "line") -> DataFrame:
    """Count and byte total per (ip, user, query); nulls form one group."""
    p = parse(df, col)
    return (p.groupBy("ip", "user", "query")
             .agg(F.count(F.lit(1)).alias("count"), F.sum("bytes").cast("long").alias("bytes")))
