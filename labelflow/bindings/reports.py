"""Prices by date, reports on several levels, and quantile sketches over orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.bindings import derived as d
from labelflow.operators.asof import valid_at
from labelflow.operators.levels import cost_levels, merged_quantiles, quantile_states
from labelflow.storage import materialise

_PROBABILITIES = (0.5, 0.95, 0.99)
#: Ranks of the sketches' quantiles may be off by so much.
_RANK_ERROR = 0.03


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as requests; one model has a good third of them."""
    key = F.col("o_custkey")
    model = F.when(key % 3 == 0, 0).otherwise(key % 5)
    return d.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("model_"), model.cast("string")).alias("model"),
        F.concat(F.lit("batch_"), (key % 40).cast("string")).alias("batch"),
        F.date_format("o_orderdate", "yyyy").alias("year"),
        "o_custkey",
        F.col("o_orderdate").cast("timestamp_ntz").alias("at"),
        F.col("o_totalprice").alias("seconds"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cost"),
    )


def prices_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order at the price its model had: every model has five in turn, some
    orders come before the first."""
    key = F.col("n_nationkey").cast("int")
    history = d.table(spark, sf_dir, "nation").select(
        F.concat(F.lit("model_"), (key % 5).cast("string")).alias("model"),
        (F.expr("timestamp_ntz'1995-03-01 00:00:00'") + F.make_dt_interval(key * 75)).alias("since"),
        (key + 0.5).cast("double").alias("price"),
    )
    priced = valid_at(_requests(spark, sf_dir), history, "model", "at", "since")
    return priced.select("o_orderkey", "model", "since", "price")


def cost_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By model and year, batch, year, and in all; distinct customers by sketch,
    next to whether they are near the exact number."""
    requests = _requests(spark, sf_dir)
    levels = [["model", "year"], ["batch"], ["year"], []]
    found = cost_levels(requests, levels, "cost", "o_custkey")
    exact = requests.groupingSets(
        [[F.col(c) for c in level] for level in levels], "model", "year", "batch"
    ).agg(F.grouping_id().cast("int").alias("l"), F.count_distinct("o_custkey").alias("customers"))
    same = F.col("l") == F.col("level")
    for name in ("model", "year", "batch"):
        exact = exact.withColumnRenamed(name, f"x_{name}")
        same &= F.col(name).eqNullSafe(F.col(f"x_{name}"))
    near = F.abs(F.col("o_custkey_estimate") - F.col("customers")) <= 0.05 * F.col("customers")
    return found.join(exact, same).select(
        "model", "year", "batch", "level", "n", "cost", "customers", near.alias("near")
    )


def runtime_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles per model of sketches stored per batch, and how far their true
    ranks are off."""
    requests = _requests(spark, sf_dir)
    states = materialise(quantile_states(requests, ["batch", "model"], "seconds"))
    found = merged_quantiles(states, ["model"], _PROBABILITIES)
    ranks = (
        requests.join(F.broadcast(materialise(found)), "model")
        .groupBy("model", "n", "p")
        .agg(
            F.avg((F.col("seconds") < F.col("value")).cast("int")).alias("below"),
            F.avg((F.col("seconds") <= F.col("value")).cast("int")).alias("upto"),
        )
    )
    near = (F.col("below") - _RANK_ERROR <= F.col("p")) & (F.col("p") <= F.col("upto") + _RANK_ERROR)
    return ranks.select("model", "n", "p", near.alias("near"))


QUERIES = {
    "prices_by_date": prices_by_date,
    "cost_by_level": cost_by_level,
    "runtime_quantiles": runtime_quantiles,
}

_REQUESTS = """requests AS (
  SELECT *, 'model_' || CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey % 5 END AS model,
    'batch_' || o_custkey % 40 AS batch, strftime(o_orderdate, '%Y') AS year,
    CAST(round(o_totalprice * 100) AS BIGINT) AS cost
  FROM orders)"""

ORACLE = {
    "prices_by_date": f"""WITH {_REQUESTS}, history AS (
  SELECT 'model_' || n_nationkey % 5 AS model, n_nationkey + 0.5 AS price,
    TIMESTAMP '1995-03-01' + to_days(CAST(n_nationkey * 75 AS INTEGER)) AS since FROM nation)
SELECT o_orderkey, r.model, since, CAST(price AS DOUBLE) AS price
FROM requests r ASOF LEFT JOIN history h ON r.model = h.model AND r.o_orderdate >= h.since""",
    "cost_by_level": f"""WITH {_REQUESTS}
SELECT model, year, batch, CAST(grouping_id(model, year, batch) AS INTEGER) AS level, count(*) AS n,
  CAST(sum(cost) AS BIGINT) AS cost, count(DISTINCT o_custkey) AS customers, true AS near
FROM requests GROUP BY GROUPING SETS ((model, year), (batch), (year), ())""",
    "runtime_quantiles": f"""WITH {_REQUESTS}
SELECT model, count(*) AS n, unnest([0.5, 0.95, 0.99]::DOUBLE[]) AS p, true AS near FROM requests GROUP BY model""",
}
