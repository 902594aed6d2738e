"""Registry, table loading, and the series that most queries start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadtide.functions.measures import mean_of
from loadtide.functions.timeaxis import MINUTE
from loadtide.operators.rollup import resample

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TYPES = ("signup", "purchase", "view", "click", "error")
SLOT = 30 * MINUTE


def query(name: str, sql: str | None = None, doubles: str = "", ints: str = "", digits: int = 6):
    """Register a query. `doubles` are rounded and `ints` made 64-bit on both sides.

    A name may carry its own number of digits, as in "total:9".
    """
    places = {c.partition(":")[0]: int(c.partition(":")[2] or digits) for c in doubles.split()}

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(spark, sf_dir), places)

        run.__name__, run.__doc__, run.__module__ = name, fn.__doc__, fn.__module__
        QUERIES[name] = run
        if sql is not None:
            same = [f"round({c}, {d}) + 0.0 AS {c}" for c, d in places.items()]
            same += [f"CAST({c} AS BIGINT) AS {c}" for c in ints.split()]
            ORACLES[name] = f"SELECT * REPLACE ({', '.join(same)}) FROM ({sql.strip()})" if same else sql.strip()
        return fn

    return add


def plain(df: DataFrame, doubles: dict[str, int]) -> DataFrame:
    """64-bit integers, times without zone, rounded doubles: what the SQL side returns."""
    def shape(f: T.StructField) -> str:
        if f.name in doubles:
            return f"round(double(`{f.name}`), {doubles[f.name]}) + 0.0D AS `{f.name}`"
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return f"bigint(`{f.name}`) AS `{f.name}`"
        if isinstance(f.dataType, T.TimestampType):
            return f"CAST(`{f.name}` AS timestamp_ntz) AS `{f.name}`"
        return f"`{f.name}`"

    return df.selectExpr(*[shape(f) for f in df.schema])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with zone-less times as instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.selectExpr(*[f"timestamp({f.name}) AS {f.name}" if isinstance(f.dataType, T.TimestampNTZType) else f.name
                           for f in df.schema])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with exact two-decimal values."""
    return table(spark, sf_dir, "events").withColumn("value", F.col("value").cast("decimal(18,2)"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
            .withColumn("year", F.year("o_orderdate")).withColumn("month", F.month("o_orderdate")))


def mix(spark: SparkSession, sf_dir: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Half-hour series: mean value as load, one total per event type (null where there was none)."""
    totals = {t: F.expr(f"double(sum(value) FILTER (WHERE event_type = '{t}'))") for t in TYPES}
    return resample(events(spark, sf_dir), "ts", SLOT, {"load": mean_of("value"), **totals}, keys, "b30")


def user_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-hour series of every user: (user_id, b30, load, n)."""
    return resample(events(spark, sf_dir), "ts", SLOT,
                    {"load": mean_of("value"), "n": F.count(F.lit(1))}, ("user_id",), "b30")


DEC = "CAST(value AS DECIMAL(18,2))"
B30 = "time_bucket(INTERVAL 30 MINUTE, ts)"
S0 = (f"s0 AS (SELECT {B30} AS b30, CAST(sum({DEC}) AS DOUBLE) / count(value) AS load, "
      + ", ".join(f"CAST(sum({DEC}) FILTER (WHERE event_type = '{t}') AS DOUBLE) AS {t}" for t in TYPES)
      + " FROM events GROUP BY 1)")
U0 = (f"u0 AS (SELECT user_id, {B30} AS b30, CAST(sum({DEC}) AS DOUBLE) / count(value) AS load, count(*) AS n "
      "FROM events GROUP BY 1, 2)")
O0 = ("o0 AS (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS price, year(o_orderdate) AS yr, "
      "month(o_orderdate) AS mon FROM orders)")
