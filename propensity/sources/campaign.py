"""Labelled frames derived from the input tables.

The campaign frame is one row per order with a yes/no outcome, nominal, ordinal, sentinel, leaky and
correlated numeric columns and a ready-made score: the same shape as a marketing-campaign table, so
every operator of the library has something real to chew on.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.functions.order import day_bucket, hash_bucket, md5_key, row_number_within
from propensity.functions.sizing import broadcast_if_bounded, small_table
from propensity.session import materialize
from propensity.sources.tables import table

SPLIT_SEED = 42
VAL_PERCENT = 20  # integer percent: ceil(pct * n / 100) stays exact integer arithmetic
TEST_STATUS = "P"  # orders still in progress have no outcome yet: the unlabelled rows

NOMINAL = ["segment", "region"]
ORDINAL = "priority"
# Priority levels in their natural order; the unspecified level is "unknown" (NULL).
PRIORITY_ORDER = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
PRIORITY_UNKNOWN = "4-NOT SPECIFIED"
NUMERIC = ["total_price", "acct_bal", "n_lines", "qty", "disc", "gross", "net", "previous", "days_since"]
SENTINEL_COL, SENTINEL_VALUE, SENTINEL_FLAG = "days_since", -1, "had_prior_order"  # gaps are never negative
LEAKY = ["total_price"]
MAX_CLASSES = 10_000
MODEL_COLUMNS = NOMINAL + [ORDINAL] + NUMERIC


def line_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order line aggregates; partial aggregation runs before the shuffle on ``l_orderkey``."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.round(F.sum("l_quantity"), 2).alias("qty"),
        F.round(F.avg("l_discount"), 6).alias("disc"),
        F.round(F.sum("l_extendedprice"), 2).alias("gross"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("net"),
        F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("any_return"),
    )


def customer_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their region name. Nation and region are fixed-size dimension tables; they are
    broadcast only after their size is checked."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(broadcast_if_bounded(region, 10_000), nation.n_regionkey == region.r_regionkey)
    geo = broadcast_if_bounded(geo.select("n_nationkey", "r_name"), 10_000)
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return cust.join(geo, cust.c_nationkey == geo.n_nationkey).drop("c_nationkey", "n_nationkey")


def campaign_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: id, target, status, nominal/ordinal/numeric features and a score.

    ``previous`` and ``days_since`` need each customer's orders in date order. A customer may own a
    large share of all orders, so the sequence is numbered per (customer, day) with offsets from a count
    table of at most one row per customer and day instead of one window per customer.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    seq = row_number_within(
        orders,
        ["o_custkey"],
        [F.col("o_orderdate"), F.col("o_orderkey")],
        day_bucket(F.col("o_orderdate")),
        out="_rn",
        lag_of="o_orderdate",
        lag_out="_prev_date",
    )
    li = line_summary(spark, sf_dir)
    cust = customer_geo(spark, sf_dir)
    j = seq.join(cust, seq.o_custkey == cust.c_custkey).join(li, seq.o_orderkey == li.l_orderkey, "left")
    days = F.datediff(F.col("o_orderdate"), F.col("_prev_date"))
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.when((F.col("o_totalprice") > 300000) & (F.coalesce(F.col("any_return"), F.lit(0)) == 1), 1)
        .otherwise(0).cast("int").alias("target"),
        F.col("o_orderstatus").alias("status"),
        F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("region"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("total_price"),
        F.col("c_acctbal").alias("acct_bal"),
        "n_lines", "qty", "disc", "gross", "net",
        (F.col("_rn") - 1).cast("int").alias("previous"),
        F.when(F.col("_prev_date").isNull(), F.lit(SENTINEL_VALUE)).otherwise(days).cast("int").alias("days_since"),
        (F.floor(F.col("o_totalprice") / 500).cast("double") / F.lit(1000.0)).alias("score"),
    )


def class_sizes(df: DataFrame, target: str = "target") -> DataFrame:
    """Rows per class, NULL included, for a null-safe join. Broadcast only if there are few classes."""
    sizes = df.groupBy(F.col(target).alias("_class")).agg(F.count(F.lit(1)).alias("_class_n"))
    return small_table(sizes, MAX_CLASSES)


def stratified_split(
    df: DataFrame, id_col: str = "id", target: str = "target", percent: int = VAL_PERCENT, seed: int = SPLIT_SEED
) -> DataFrame:
    """Exact stratified split (C11): rank rows inside their class by ``md5(id-seed)``; the first
    ``ceil(percent * class size / 100)`` ranks are ``val``, the rest ``train``. Deterministic,
    independent of partitioning, and identical in any engine with md5."""
    key = md5_key(id_col, seed)
    ranked = row_number_within(
        df.withColumn("_h", key), [target], [F.col("_h"), F.col(id_col)], hash_bucket(F.col("_h")), out="_rank"
    )
    sizes = class_sizes(df, target)
    cut = F.expr(f"(_class_n * {int(percent)} + 99) div 100")
    return (
        ranked.join(sizes, ranked[target].eqNullSafe(sizes["_class"]))
        .withColumn("split", F.when(F.col("_rank") <= cut, "val").otherwise("train"))
        .drop("_h", "_rank", "_class", "_class_n")
    )


def labelled_and_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign frame with a ``split`` column: train / val among finished orders, test (target NULL)
    for orders still in progress.

    The frame is checkpointed first: the split reads it several times (class sizes, bucket sizes, ranks,
    the test branch), and recomputing the line-item aggregate for each read would multiply the cost of
    the largest table."""
    frame = materialize(campaign_frame(spark, sf_dir))
    labelled = stratified_split(frame.filter(F.col("status") != TEST_STATUS))
    test = frame.filter(F.col("status") == TEST_STATUS).withColumn("target", F.lit(None).cast("int"))
    # written once more: every consumer (scores, fits, metrics) reads the split rows many times
    return materialize(labelled.unionByName(test.withColumn("split", F.lit("test"))))


def model_scores(frame: DataFrame) -> list[tuple[str, Column]]:
    """Deterministic stand-in models for the scores table."""
    return [
        ("m1", F.col("score")),
        ("m2", F.lit(1.0) - F.col("score")),
        ("m3", F.least(F.lit(1.0), F.coalesce(F.col("qty"), F.lit(0.0)) / F.lit(350.0))),
        ("m4", F.lit(0.5)),
    ]


def scores_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long scores table ``(model, split, id, target, proba)``: one row per model and order, keyed by
    id (never by position). The four models fan out with ``inline``: a narrow projection, no shuffle."""
    frame = labelled_and_test(spark, sf_dir)
    models = F.array(*[F.struct(F.lit(name).alias("model"), expr.cast("double").alias("proba"))
                       for name, expr in model_scores(frame)])
    return frame.select("split", "id", "target", F.inline(models)).select("model", "split", "id", "target", "proba")


def documents_frame(spark: SparkSession, sf_dir: str, target: str = "quality") -> DataFrame:
    """Second labelled frame: documents joined with their labels (high imbalance for ``toxic``)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col(target).cast("int").alias("target"))
    return docs.join(labels, "doc_id").withColumnRenamed("doc_id", "id")
