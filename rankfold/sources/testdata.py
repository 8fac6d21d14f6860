"""Derive an impression table from the TPC-H-like test tables.

The test data holds no recommender impressions, so each order becomes a
request session and each line item an impression:

* ``rid``       = order key as text; ``pos`` = stable position in the session
* ``score``     = discount (11 values, many ties); ``score_alt`` = extended price
* ``events``    = event names derived from status, flags, tax and line number
* ``features``  = sparse ``[[id, value], ...]`` pairs with gaps and a duplicate id

The join order is part first, orders second, so the session clustering reuses
the ``l_orderkey`` partitioning of the orders join when both sides are large;
small sides are broadcast by the planner under
``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankfold.config import DEFAULT_FORMULA_PATH
from rankfold.session import tasks_for

OTHER_FORMULA_PATH = "other-formula"
#: Parts above which they are dealt by key with the lines of a large table; fewer are left to the planner, which may broadcast them.
LARGE_PARTS = 2_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _array_of(*items):
    """Array of the items whose condition holds, in their order; no lambda, so it stays in generated code."""
    return F.concat(*[F.array_repeat(item, F.when(cond, 1).otherwise(0)) for item, cond in items])


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", "o_orderdate")

    # More tasks for more rows (the count reads file footers only): the rows that a task orders by session stay as many.
    tasks = tasks_for(spark, li.count())
    if tasks and part.count() > LARGE_PARTS:
        li, part = li.repartition(tasks, "l_partkey"), part.repartition(tasks, "p_partkey").hint("shuffle_hash")
    j = li.join(part, li.l_partkey == part.p_partkey)
    # Cluster by session: the position window needs exactly this distribution
    # (no second exchange), and it mirrors the stored layout we recommend for
    # impressions (clustered / bucketed by rid), so per-row work is spread over
    # all tasks even when the source file has a single row group.
    if tasks:
        j = j.repartition(tasks, "l_orderkey")
        j = j.join(orders.repartition(tasks, "o_orderkey").hint("shuffle_hash"), li.l_orderkey == orders.o_orderkey)
    else:
        j = j.join(orders, li.l_orderkey == orders.o_orderkey).repartition("l_orderkey")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    ln = F.col("l_linenumber")
    tax = F.col("l_tax")
    events = _array_of(
        (F.lit("actionPlay"), F.col("l_linestatus") == "O"),
        (F.lit("watchCoverageRecord"), F.col("l_returnflag").isin("A", "R")),
        (F.lit("actionLike"), tax >= 0.06),
        (F.lit("actionUnlike"), tax == 0.08),
        (F.lit("actionDislike"), tax == 0.0),
        (F.lit("actionUndislike"), (tax == 0.0) & (F.col("l_discount") == 0.0)),
        (F.lit("firstFrame"), ln % 2 == 1),
        (F.lit("card_view"), F.col("l_returnflag") != "N"),
    )
    pair = lambda i, v: F.array(F.lit(float(i)), v.cast("double"))
    always = F.lit(True)
    features = _array_of(
        (pair(1, F.col("l_quantity")), always),
        (pair(2, F.col("l_discount")), ln % 2 == 0),
        (pair(3, tax), ln % 3 != 0),
        (pair(4, F.col("p_size")), always),
        (pair(5, F.col("p_retailprice")), ln % 2 == 1),
        (pair(1, F.col("l_quantity") + 0.5), ln == 7),
    )
    prio = F.col("o_orderpriority")
    # Numbered before the feature pairs are made: the ordering does not carry them, and a filter comes first.  The events are
    # made before, as a filter on them would else make them again for each of its terms.
    j = j.withColumn("events", events).withColumn("pos", F.row_number().over(w) - 1)
    return j.select(
        F.col("l_orderkey").cast("string").alias("rid"),
        "pos",
        F.col("l_discount").alias("score"),
        F.col("l_extendedprice").alias("score_alt"),
        "events",
        F.when(ln % 4 == 0, F.lit(0)).otherwise(F.col("l_quantity") * 20).cast("bigint").alias("viewTimeSec"),
        (F.col("p_size") * 200).cast("bigint").alias("durationSeconds"),
        F.when(prio.isin("1-URGENT", "3-MEDIUM"), F.lit("vk_video_android"))
         .when(prio.isin("2-HIGH", "5-LOW"), F.lit("android"))
         .otherwise(F.lit("ios")).alias("platform"),
        F.when(F.col("o_orderstatus") == "P", F.lit("main_feed")).otherwise(F.lit("video_for_you")).alias("navScreen"),
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), F.lit(OTHER_FORMULA_PATH))
         .otherwise(F.lit(DEFAULT_FORMULA_PATH)).alias("formulaPath"),
        F.when(F.col("p_size") == 50, F.lit(1777)).otherwise(F.lit(1776)).cast("bigint").alias("typeId"),
        F.lit("vk").alias("userType"),
        F.lit(200).cast("bigint").alias("recommenderId"),
        features.alias("features"),
        F.col("o_orderdate").cast("date").alias("day"),
    )


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second source: every ``events`` row is an impression, a session is a
    (user, day) pair, the event value is the score and the event type is the
    one-element event list."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    return ev.select(
        F.concat(F.col("user_id").cast("string"), F.lit(":"), F.to_date("ts").cast("string")).alias("rid"),
        F.col("event_id").alias("pos"),
        F.col("value").alias("score"),
        F.array(F.col("event_type")).alias("events"),
        F.lit(0).cast("bigint").alias("viewTimeSec"))


EVENT_SESSIONS_DUCKDB = """
impressions AS (
  SELECT CAST(user_id AS VARCHAR) || ':' || CAST(CAST(ts AS DATE) AS VARCHAR) AS rid, event_id AS pos,
         value AS score, [event_type] AS events, CAST(0 AS BIGINT) AS viewTimeSec
  FROM events)"""


# The same derivation in DuckDB SQL, for the oracle queries.
IMPRESSIONS_DUCKDB = f"""
impressions AS (
  SELECT
    CAST(l_orderkey AS VARCHAR) AS rid,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS pos,
    l_discount AS score,
    l_extendedprice AS score_alt,
    list_filter([
      CASE WHEN l_linestatus = 'O' THEN 'actionPlay' END,
      CASE WHEN l_returnflag IN ('A','R') THEN 'watchCoverageRecord' END,
      CASE WHEN l_tax >= 0.06 THEN 'actionLike' END,
      CASE WHEN l_tax = 0.08 THEN 'actionUnlike' END,
      CASE WHEN l_tax = 0.0 THEN 'actionDislike' END,
      CASE WHEN l_tax = 0.0 AND l_discount = 0.0 THEN 'actionUndislike' END,
      CASE WHEN l_linenumber % 2 = 1 THEN 'firstFrame' END,
      CASE WHEN l_returnflag <> 'N' THEN 'card_view' END
    ], lambda x: x IS NOT NULL) AS events,
    CAST(CASE WHEN l_linenumber % 4 = 0 THEN 0 ELSE l_quantity * 20 END AS BIGINT) AS viewTimeSec,
    CAST(p_size * 200 AS BIGINT) AS durationSeconds,
    CASE WHEN o_orderpriority IN ('1-URGENT','3-MEDIUM') THEN 'vk_video_android'
         WHEN o_orderpriority IN ('2-HIGH','5-LOW') THEN 'android' ELSE 'ios' END AS platform,
    CASE WHEN o_orderstatus = 'P' THEN 'main_feed' ELSE 'video_for_you' END AS navScreen,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN '{OTHER_FORMULA_PATH}'
         ELSE '{DEFAULT_FORMULA_PATH}' END AS formulaPath,
    CAST(CASE WHEN p_size = 50 THEN 1777 ELSE 1776 END AS BIGINT) AS typeId,
    'vk' AS userType,
    CAST(200 AS BIGINT) AS recommenderId,
    list_filter([
      [1.0, l_quantity],
      CASE WHEN l_linenumber % 2 = 0 THEN [2.0, l_discount] END,
      CASE WHEN l_linenumber % 3 <> 0 THEN [3.0, l_tax] END,
      [4.0, CAST(p_size AS DOUBLE)],
      CASE WHEN l_linenumber % 2 = 1 THEN [5.0, p_retailprice] END,
      CASE WHEN l_linenumber = 7 THEN [1.0, l_quantity + 0.5] END
    ], lambda x: x IS NOT NULL) AS features,
    CAST(o_orderdate AS DATE) AS day
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN orders ON l_orderkey = o_orderkey
)"""
