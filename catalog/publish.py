"""Publishing: each query writes a table below the scratch folder, changes it, and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadtide.fixed import WAREHOUSE_DAILY_TYPES, WAREHOUSE_FACT_TYPES, WAREHOUSE_MONTHLY_TYPES
from loadtide.plans import layers as plans
from loadtide.sources import layers, publish
from loadtide.sources.scratch import fresh_path, materialize

from .base import O0, S0, events, mix, orders, query, table
from .rollups import _GOLD_SQL, FEATURE_SQL, SERIES, national

CUT = "2000-01-01"
_FEAT = f"WITH {FEATURE_SQL} SELECT * FROM feat"


def _money(value: str, digits: int) -> str:
    """SQL for a value rounded half up, as into a warehouse type."""
    return f"CAST(round(CAST({value} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"



def old_orders(spark, sf):
    """The table before the reload: orders up to mid 2000."""
    return orders(spark, sf).filter(F.col("o_orderdate") < F.lit("2000-07-01").cast("timestamp")).select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("price"), "o_orderdate", "year", "month")


def reload(spark, sf):
    """The batch: orders from 2000 on, with new prices."""
    return orders(spark, sf).filter(F.col("o_orderdate") >= F.lit(CUT).cast("timestamp")).select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice").cast("double") + 1).alias("price"),
        "o_orderdate", "year", "month")


_OLD = ("old AS (SELECT o_orderkey, o_orderstatus, o_totalprice AS price, o_orderdate, year(o_orderdate) AS year, month(o_orderdate) AS month "
        "FROM orders WHERE o_orderdate < TIMESTAMP '2000-07-01')")
_NEW = ("batch AS (SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice + 1 AS price, o_orderdate, year(o_orderdate) AS year, "
        "month(o_orderdate) AS month FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')")
_MERGE = f"WITH {_OLD}, {_NEW} SELECT * FROM old UNION ALL SELECT * FROM batch WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)"
_UPSERT = f"WITH {_OLD}, {_NEW} SELECT * FROM batch UNION ALL SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)"


@query("merge_new", _MERGE, doubles="price")
def _(spark, sf):
    """Insert-if-absent as a frame."""
    return publish.merge_new(old_orders(spark, sf), reload(spark, sf), ["o_orderkey", "o_orderdate"], "o_orderdate")


@query("upsert", _UPSERT, doubles="price")
def _(spark, sf):
    """Insert or update as a frame."""
    return publish.upserted(old_orders(spark, sf), reload(spark, sf), ["o_orderkey"])


@query("anti_join_new", f"WITH {_OLD}, {_NEW} SELECT * FROM batch WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)", doubles="price")
def _(spark, sf):
    return publish.new_rows(old_orders(spark, sf), reload(spark, sf), ["o_orderkey", "o_orderdate"], "o_orderdate")


@query("publish_append", f"WITH {_OLD}, {_NEW} SELECT o_orderkey, price FROM old UNION ALL SELECT o_orderkey, price FROM batch", doubles="price")
def _(spark, sf):
    path = fresh_path(spark, "append")
    publish.publish_append(old_orders(spark, sf), path, ["o_orderkey", "price", "not_there"])
    publish.publish_append(reload(spark, sf), path, ["o_orderkey", "price"])
    return publish.read_table(spark, path)


@query("publish_overwrite", f"WITH {_OLD}, {_NEW} SELECT * FROM batch", doubles="price")
def _(spark, sf):
    path = fresh_path(spark, "overwrite")
    publish.publish_overwrite(old_orders(spark, sf), path, ["year"])
    publish.publish_overwrite(reload(spark, sf), path, ["year"])
    return publish.read_table(spark, path)


@query("publish_merge", _MERGE, doubles="price")
def _(spark, sf):
    """Merging the same batch twice adds nothing the second time."""
    path, keys = fresh_path(spark, "merge"), ["o_orderkey", "o_orderdate"]
    publish.publish_append(old_orders(spark, sf), path, partition_by=["year"])
    for _ in range(2):
        publish.publish_merge(reload(spark, sf), path, keys, "o_orderdate", ["year"])
    return publish.read_table(spark, path)


@query("publish_upsert", _UPSERT, doubles="price")
def _(spark, sf):
    """Upserting the same batch twice gives the same table; untouched years are not rewritten."""
    path = fresh_path(spark, "upsert")
    publish.publish_append(old_orders(spark, sf), path, partition_by=["year"])
    for _ in range(2):
        publish.publish_upsert(reload(spark, sf), path, ["o_orderkey"], ["year"])
    return publish.read_table(spark, path)


@query("publish_upsert_moved", """
    WITH moved AS (SELECT o_orderkey, o_totalprice AS price, year(o_orderdate) + CASE WHEN o_orderstatus = 'F' OR year(o_orderdate) = 2001
    THEN 10 ELSE 0 END AS year FROM orders) SELECT * FROM moved""", doubles="price")
def _(spark, sf):
    """Rows that change partition leave the old one; a partition that becomes empty goes away."""
    path = fresh_path(spark, "moved")
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.year("o_orderdate").alias("year"), "o_orderstatus")
    publish.publish_append(o.drop("o_orderstatus"), path, partition_by=["year"])
    batch = o.filter("o_orderstatus = 'F' OR year = 2001").select("o_orderkey", "price", (F.col("year") + 10).alias("year"))
    publish.publish_upsert(batch, path, ["o_orderkey"], ["year"])
    return publish.read_table(spark, path)


@query("publish_typed", """
    SELECT o_orderkey, CAST(CASE WHEN abs(round(o_totalprice / 150, 3)) < 1000 THEN round(o_totalprice / 150, 3) END AS DOUBLE) AS pct,
        CAST(CASE WHEN round(o_totalprice / 10) <= 32767 THEN round(o_totalprice / 10) END AS BIGINT) AS small FROM orders""",
       doubles="pct", digits=3)
def _(spark, sf):
    """Rounded into NUMERIC(6,3) and SMALLINT; what does not fit is null."""
    o = table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") / 150).alias("pct"),
                                          (F.col("o_totalprice") / 10).alias("small"))
    return publish.typed(o, {"pct": (6, 3), "small": "smallint"})


@query("overflow_counts", """
    SELECT 'pct' AS column_name, count(*) FILTER (round(o_totalprice / 150, 3) >= 1000) AS overflowed FROM orders
    UNION ALL SELECT 'small', count(*) FILTER (round(o_totalprice / 10) > 32767) FROM orders""")
def _(spark, sf):
    o = table(spark, sf, "orders").select((F.col("o_totalprice") / 150).alias("pct"), (F.col("o_totalprice") / 10).alias("small"))
    return publish.overflow_counts(o, {"pct": (6, 3), "small": "smallint"})


@query("publish_silver_typed", f"""
    WITH {FEATURE_SQL} SELECT datetime, CAST(round(CAST(consumption_mw AS DECIMAL(38,12)), 2) AS DOUBLE) AS consumption_mw,
        CASE WHEN abs(nuclear_share_pct) < 999.9995 THEN CAST(round(CAST(nuclear_share_pct AS DECIMAL(38,12)), 3) AS DOUBLE) END AS nuclear_share_pct, quality_score FROM feat""",
       doubles="consumption_mw:2 nuclear_share_pct:3 quality_score:3")
def _(spark, sf):
    """The clean table in warehouse types."""
    s = plans.silver(national(spark, sf), SERIES).select("datetime", "consumption_mw", "nuclear_share_pct", "quality_score")
    return publish.typed(s, WAREHOUSE_FACT_TYPES)


@query("publish_gold_typed", f"""
    WITH g AS ({_GOLD_SQL}), c AS (SELECT *, {_money('consumption_mean_mw', 2)} AS a, {_money('consumption_total_gwh', 3)} AS b,
        {_money('wind_mean_mw', 2)} AS w FROM g)
    SELECT 'daily' AS layer, date::VARCHAR AS period, a AS mean_mw, b AS total, peak_hour::BIGINT AS peak_hour, records_count::BIGINT AS rows, w AS wind FROM c
    UNION ALL SELECT 'monthly', year || '-' || month, {_money('avg(consumption_mean_mw)', 2)}, {_money('sum(consumption_total_gwh) / 1000', 4)}, NULL, count(*),
        {_money('(SELECT sum(wind_mw) * 0.5 / 1000 FROM (' + _FEAT + ') f WHERE year(f.datetime) = c.year AND month(f.datetime) = c.month)', 3)}
    FROM c GROUP BY year, month""", doubles="mean_mw:2 total:4 wind:3")
def _(spark, sf):
    """Daily and monthly tables in warehouse types, the monthly one with the energy of each source."""
    silver = materialize(plans.silver(national(spark, sf), SERIES))
    daily, monthly = plans.gold(silver)
    monthly = plans.with_source_energy(monthly, silver)
    d, m = publish.typed(daily, WAREHOUSE_DAILY_TYPES), publish.typed(monthly, WAREHOUSE_MONTHLY_TYPES)
    return d.select(F.lit("daily").alias("layer"), F.col("date").cast("string").alias("period"), F.col("consumption_mean_mw").alias("mean_mw"),
                    F.col("consumption_total_gwh").alias("total"), F.col("peak_hour").cast("long").alias("peak_hour"),
                    F.col("records_count").cast("long").alias("rows"), F.col("wind_mean_mw").alias("wind")).unionByName(
        m.select(F.lit("monthly").alias("layer"), F.concat_ws("-", "year", "month").alias("period"), F.col("consumption_mean_mw").alias("mean_mw"),
                 F.col("consumption_total_twh").alias("total"), F.lit(None).cast("long").alias("peak_hour"), F.col("trading_days").cast("long").alias("rows"),
                 F.col("wind_total_gwh").alias("wind")))


@query("write_bronze", """
    SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n FROM orders GROUP BY 1, 2""")
def _(spark, sf):
    path = fresh_path(spark, "bronze")
    layers.write_bronze(table(spark, sf, "orders").withColumnRenamed("o_orderdate", "datetime"), path)
    return spark.read.parquet(f"{path}/raw").groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))


@query("read_bronze", """
    SELECT event_id, ts AS datetime, CASE WHEN event_type IN ('signup', 'purchase') THEN value END AS value,
        CASE WHEN event_type IN ('signup', 'purchase') THEN NULL ELSE props END AS props FROM events""", doubles="value")
def _(spark, sf):
    """Batch rows (with values) and streamed rows (times as text, with props) as one table."""
    path = fresh_path(spark, "bronze")
    e = table(spark, sf, "events").withColumnRenamed("ts", "datetime")
    batch = F.col("event_type").isin("signup", "purchase")
    layers.write_bronze(e.filter(batch).select("event_id", "datetime", "value"), path)
    text = F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("datetime")
    e.filter(~batch).select("event_id", text, "props", F.lit("raw").alias("topic")).write.partitionBy("topic").parquet(f"{path}/streaming")
    return layers.read_bronze(spark, path).select("event_id", "datetime", "value", "props")


@query("write_silver", f"WITH {S0} SELECT b30, load, year(b30) AS year, month(b30) AS month FROM s0", doubles="load")
def _(spark, sf):
    path = fresh_path(spark, "silver")
    layers.write_silver(layers.with_month(mix(spark, sf), "b30"), path, ["b30", "load", "year", "month", "not_there"])
    return layers.read_silver(spark, path)


@query("write_gold", f"""
    WITH {O0}, d AS (SELECT yr, mon, CAST(o_orderdate AS DATE) AS dt, count(*) AS n FROM o0 GROUP BY ALL)
    SELECT yr AS year, count(*) AS days, sum(n)::BIGINT AS rows, count(DISTINCT mon) AS months FROM d GROUP BY 1""")
def _(spark, sf):
    """Daily and monthly tables written and read back."""
    path = fresh_path(spark, "gold")
    spec = plans.DailySpec(time="o_orderdate", load="o_totalprice", sources={}, exchanges=None)
    layers.write_gold(*plans.gold(orders(spark, sf).drop("year", "month"), spec), path)
    d = spark.read.parquet(f"{path}/daily").groupBy("year").agg(F.count(F.lit(1)).alias("days"), F.sum("records_count").alias("rows"))
    m = spark.read.parquet(f"{path}/monthly").groupBy("year").agg(F.count(F.lit(1)).alias("months"))
    return d.join(m, "year")
