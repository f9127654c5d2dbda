"""Finance tables seen through a sales star schema.

The tenant is the customer's nation.  Line items are transactions: returned
ones are income, the others expenses.  Part type, part name and market segment
stand in for category, merchant and account.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.schemas import MONEY

AS_OF = "2001-06-15"
MONTHS = 82
UNBUDGETED = "PROMO"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders meet customers first, so line items shuffle once for their tenant."""
    owner = (read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
             .join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
             .select("o_orderkey", "c_nationkey", "c_mktsegment"))
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    price = F.col("l_extendedprice").cast(MONEY)
    returned = F.col("l_returnflag") == "R"
    return (read(spark, sf_dir, "lineitem")
            .join(owner, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("c_nationkey").cast("long").alias("user_id"),
                    (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
                    F.col("l_shipdate").cast("date").alias("tx_date"),
                    F.col("p_name").alias("description"),
                    F.when(returned, -price).otherwise(price).cast(MONEY).alias("amount"),
                    F.when(returned, "Income").otherwise(F.col("p_type")).alias("category"),
                    F.col("c_mktsegment").alias("account")))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (read(spark, sf_dir, "customer")
            .groupBy(F.col("c_nationkey").cast("long").alias("user_id"),
                     F.col("c_mktsegment").alias("name"))
            .agg(F.sum(F.col("c_acctbal").cast(MONEY)).cast(MONEY).alias("balance"))
            .select("user_id", "name", F.col("name").alias("type"), "balance"))


def budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each tenant's mean monthly spend per category; one category has none."""
    tx = transactions(spark, sf_dir)
    mean = F.floor(F.sum("amount").cast("double") / F.lit(float(MONTHS)))
    return (tx.where((F.col("amount") > 0) & (F.col("category") != UNBUDGETED))
            .groupBy("user_id", "category")
            .agg(mean.cast(MONEY).alias("monthly_limit")))
