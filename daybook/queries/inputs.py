"""The job's three inputs, derived from the test tables.

The test tables lack some columns the job needs. The expressions here supply
them and plant the awkward cases (missing keys, times and flags, refunds, negative
amounts, profiles with gaps, users with two profiles) on a spread of rows. No row is
left out.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_name(sf_dir: str, name: str) -> str:
    """Catalog-style name of a test table, for the scan operators."""
    return f"parquet.`{sf_dir}/{name}.parquet`"


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.expr("CASE WHEN event_id % 97 <> 0 THEN event_type END").alias("event_type"),
        F.expr("CASE WHEN event_id % 71 <> 0 THEN ts END").alias("event_timestamp"),
        F.expr("CASE WHEN event_id % 53 <> 0 THEN concat(user_id, '-', event_id % 7) END").alias(
            "session_id"
        ),
        F.expr("concat('/page', event_id % 20)").alias("page_url"),
        F.expr("element_at(array('mobile', 'desktop', 'tablet'), int(event_id % 3) + 1)").alias(
            "device_type"
        ),
        F.expr("CASE WHEN event_id % 89 <> 0 THEN string(user_id) END").alias("user_id"),
        F.expr("year(ts) * 10000 + month(ts) * 100 + day(ts)").alias("partition_date"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.expr("CASE WHEN l_orderkey % 211 <> 0 THEN string(l_orderkey) END").alias(
            "transaction_id"
        ),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.expr(
            "if((l_orderkey + l_linenumber) % 101 = 0, -l_extendedprice, l_extendedprice)"
        ).alias("purchase_amount"),
        F.col("l_shipdate").alias("purchase_timestamp"),
        F.expr("element_at(array('credit', 'paypal', 'debit'), l_linenumber % 3 + 1)").alias(
            "payment_method"
        ),
        F.lit("USD").alias("currency"),
        F.expr("CASE WHEN (l_orderkey + l_linenumber) % 29 <> 0 THEN l_returnflag = 'R' END").alias(
            "is_refunded"
        ),
        # Customers whose orders name nobody have profiles, but no purchases.
        F.expr("CASE WHEN o_custkey % 37 <> 0 THEN string(o_custkey) END").alias("user_id"),
        F.expr("int(20240101 + l_orderkey % 30)").alias("partition_date"),
    )


def lookup_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    # Some users have two profiles: equal ones, or of different tiers.
    twice = F.expr("explode(sequence(0, int(c_custkey % 11 = 0 OR c_custkey % 13 = 0)))")
    profiles = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return profiles.withColumn("copy", twice).select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_name").alias("username"),
        F.expr(
            "element_at(array('18-24', '25-34', '35-44', '45+', NULL), int(c_custkey % 5) + 1)"
        ).alias("age_group"),
        F.col("n_name").alias("country"),
        F.expr(
            "CASE WHEN copy = 1 AND c_custkey % 13 = 0 THEN 'trial'"
            " WHEN c_custkey % 7 <> 0 THEN lower(c_mktsegment) END"
        ).alias("subscription_tier"),
        F.expr("concat(lower(c_name), '@example.com')").alias("email"),
        F.expr("TIMESTAMP_NTZ '2020-01-01 00:00:00'").alias("registration_date"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
    )
