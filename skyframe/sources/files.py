"""File and in-memory sources.  Each returns a DataFrame with an explicit or
self-described schema; parsing stays in JVM expressions (split / cast /
from_json), never per-row Python."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLIGHT_SCHEMA = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("flt_date", T.DateType()),
    T.StructField("dep_time", T.StringType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("carrier", T.StringType()),
    T.StructField("flt_num", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("dest", T.StringType()),
    T.StructField("dep_delay", T.FloatType()),
    T.StructField("arr_time", T.StringType()),
    T.StructField("arr_delay", T.FloatType()),
    T.StructField("cancelled", T.FloatType()),
])


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    """12 positional comma fields, no header; blank fields are null (and a
    blank last field is kept, unlike a plain string split)."""
    return (spark.read.schema(FLIGHT_SCHEMA)
                 .option("dateFormat", "yyyy-MM-dd").option("mode", "PERMISSIVE")
                 .csv(path))


def parse_flight_lines(df: DataFrame, col: str = "value") -> DataFrame:
    """Text lines (e.g. a stream's ``value``) -> flight columns."""
    parts = F.split(F.col(col), ",", -1)
    out = []
    for i, f in enumerate(FLIGHT_SCHEMA.fields):
        raw = F.nullif(F.trim(F.get(parts, i)), F.lit(""))   # missing trailing field -> null
        if isinstance(f.dataType, T.DateType):
            v = F.try_to_timestamp(raw, F.lit("yyyy-MM-dd")).cast("date")
        elif isinstance(f.dataType, T.StringType):
            v = raw
        else:
            v = raw.try_cast(f.dataType)
        out.append(v.alias(f.name))
    return df.select(*out)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def read_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def json_strings(df: DataFrame, col: str, schema) -> DataFrame:
    """Parse a JSON text column with a DDL or StructType schema into columns."""
    parsed = F.from_json(F.col(col), schema)
    return df.select("*", parsed.alias("_j")).select(*[c for c in df.columns if c != col], "_j.*")


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Union of the files' schemas; ``key=value`` folders become columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def sql_on_file(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def load(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **opts) -> DataFrame:
    r = spark.read.format(fmt).options(**opts)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def read_csv(spark: SparkSession, path: str, header: bool = True, infer: bool = True, **opts) -> DataFrame:
    return spark.read.options(**opts).csv(path, header=header, inferSchema=infer)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    r = spark.read.format("libsvm")
    if num_features:
        r = r.option("numFeatures", num_features)
    return r.load(path)


def parse_dense(df: DataFrame, col: str = "value", labelled: bool = False) -> DataFrame:
    """``f1 f2 ...`` -> features vector; ``label,f1 f2 ...`` -> (label, features)."""
    from pyspark.ml.functions import array_to_vector
    line = F.trim(F.col(col))
    if labelled:
        label = F.split(line, ",").getItem(0).cast("double")
        body = F.split(line, ",").getItem(1)
    else:
        body = line
    nums = F.transform(F.split(F.trim(body), r"\s+"), lambda x: x.cast("double"))
    cols = [array_to_vector(nums).alias("features")]
    if labelled:
        cols.insert(0, label.alias("label"))
    return df.select(*cols)


def read_dense(spark: SparkSession, path: str, labelled: bool = False) -> DataFrame:
    return parse_dense(spark.read.text(path), "value", labelled)


def parse_ratings(df: DataFrame, col: str = "value", sep: str = "::") -> DataFrame:
    import re
    p = F.split(F.col(col), re.escape(sep))
    return df.select(p.getItem(0).cast("int").alias("userId"), p.getItem(1).cast("int").alias("movieId"),
                     p.getItem(2).cast("float").alias("rating"), p.getItem(3).cast("long").alias("timestamp"))


def read_ratings(spark: SparkSession, path: str, sep: str = "::") -> DataFrame:
    return parse_ratings(spark.read.text(path), "value", sep)


def read_jdbc(spark: SparkSession, url: str, table: str, props: dict | None = None) -> DataFrame:
    return spark.read.jdbc(url, table, properties=props or {})


def read_avro(spark: SparkSession, path: str, reader_schema: str | None = None) -> DataFrame:
    """Avro needs the external spark-avro package; fail with a clear message."""
    r = spark.read.format("avro")
    if reader_schema:
        r = r.option("avroSchema", reader_schema)
    try:
        return r.load(path)
    except Exception as e:  # noqa: BLE001
        if "avro" in str(e).lower() and ("not find" in str(e).lower() or "data source" in str(e).lower()):
            raise RuntimeError("Avro source needs the spark-avro package on the classpath "
                               "(--packages org.apache.spark:spark-avro_2.13:<version>)") from e
        raise


def from_rows(spark: SparkSession, rows, schema=None) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def with_schema(spark: SparkSession, rows, names: str) -> DataFrame:
    """Schema from a space-separated list of names, all nullable strings."""
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names.split()])
    return spark.createDataFrame(rows, schema)


def random_normal(spark: SparkSession, n: int, cols: int = 1, seed: int = 42,
                  partitions: int | None = None) -> DataFrame:
    """n rows of i.i.d. N(0,1) columns x0..x{cols-1}."""
    base = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    return base.select("id", *[F.randn(seed + i).alias(f"x{i}") for i in range(cols)])


def int_range(spark: SparkSession, lo: int, hi: int) -> DataFrame:
    """lo..hi-1 as column ``id``."""
    return spark.range(lo, hi)
