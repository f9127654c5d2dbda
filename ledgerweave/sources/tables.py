"""Finance tables: loading, writing, checking, upserting."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerweave import schemas
from ledgerweave.periods import Period, month_start, resolve
from ledgerweave.sources.shared import remove_dir, shared_dir, write_through

#: Folders of a keyed table; a merge rewrites those with a changed key.
KEY_PARTS = 64

# Fixed value: the categories of the data model; not enforced on load.
CATEGORIES = ("Groceries", "Restaurants", "Rent", "Utilities", "Transport", "Entertainment",
              "Shopping", "Health", "Subscriptions", "Income", "Other")


def load_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``transactions``, ``accounts`` and ``budgets`` from Parquet, read with fixed schemas."""
    def read(name: str, schema: T.StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{folder}/{name}")
    accounts = read("accounts", schemas.ACCOUNTS).withColumn(
        "balance", F.coalesce("balance", F.lit(0).cast(schemas.MONEY)))
    return (read("transactions", schemas.TRANSACTIONS), accounts,
            read("budgets", schemas.BUDGETS))


def load_transactions(spark: SparkSession, folder: str, period: str | Period | None = None,
                      as_of: dt.date | str | None = None) -> DataFrame:
    """``transactions`` as ``write_transactions`` laid them out, of one period or all.

    Months outside the period are not listed for reading.  ``hull`` gives the period of
    several questions.
    """
    names = schemas.TRANSACTIONS.names
    rows = (spark.read.schema(T.StructType([*schemas.TRANSACTIONS.fields,
                                            T.StructField("tx_month", T.DateType())]))
            .parquet(f"{folder}/transactions"))
    if period is None:
        return rows.select(*names)
    span = resolve(period, as_of)
    months = Period(month_start(span.start), span.end)
    return rows.where(months.contains("tx_month") & span.contains("tx_date")).select(*names)


def write_transactions(transactions: DataFrame, folder: str) -> None:
    """Monthly folders sorted by tenant, so periods prune files and tenants row groups.

    Rebalancing splits a month that holds far more rows than the others.
    """
    (transactions.withColumn("tx_month", F.trunc("tx_date", "MM"))
     .hint("rebalance", "tx_month").sortWithinPartitions("tx_month", "user_id", "tx_date")
     .write.mode("overwrite").partitionBy("tx_month").parquet(f"{folder}/transactions"))


def write_tables(transactions: DataFrame, accounts: DataFrame, budgets: DataFrame,
                 folder: str) -> None:
    write_transactions(transactions, folder)
    accounts.write.mode("overwrite").parquet(f"{folder}/accounts")
    budgets.write.mode("overwrite").parquet(f"{folder}/budgets")


def check_table(df: DataFrame, table: str, not_null: Sequence[str], key: Sequence[str],
                domains: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Violations per rule: ``(table, rule, violations)``.

    Nulls and foreign values are counted in one pass.  Surplus rows of a key are
    counted after grouping, which combines hot keys on the map side.
    """
    counts: dict[str, Column] = {
        f"{c} not null": F.count_if(F.col(c).isNull()) for c in not_null}
    for c, allowed in (domains or {}).items():
        counts[f"{c} in domain"] = F.count_if(~F.col(c).isin(*allowed))
    rules = list(counts)
    one = df.agg(*[counts[r].alias(f"_{i}") for i, r in enumerate(rules)])
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"_{i}").alias("violations"))
                      for i, r in enumerate(rules)])
    simple = one.select(F.explode(pairs).alias("p")).select("p.rule", "p.violations")
    surplus = (df.groupBy(*key).count()
               .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violations"))
               .select(F.lit(f"{', '.join(key)} unique").alias("rule"), "violations"))
    return simple.unionByName(surplus).select(
        F.lit(table).alias("table"), "rule", F.col("violations").cast("long").alias("violations"))


def check_tables(transactions: DataFrame, accounts: DataFrame, budgets: DataFrame,
                 tenant: Sequence[str] = ("user_id",)) -> DataFrame:
    """Not-null and key rules of all three tables in one report."""
    rows = [c for c in transactions.columns if c not in tenant]
    report = check_table(transactions, "transactions", rows, ["id"])
    report = report.unionByName(
        check_table(accounts, "accounts", ["name", "type", "balance"], [*tenant, "name"]))
    return report.unionByName(
        check_table(budgets, "budgets", ["category", "monthly_limit"], [*tenant, "category"]))


def upsert(base: DataFrame, updates: DataFrame, key: Sequence[str], seq: str) -> DataFrame:
    """``base`` with ``updates`` applied: the last row of a key by ``seq`` wins.

    ``seq`` orders the updates of a key, null first and equal ones by their values; base rows
    come before all of them.  Aggregating keeps one row per key and map task, so many
    updates of one key never meet in one place, which a window over the key would make
    them do.
    """
    values = [c for c in base.columns if c not in key]
    old = (base.withColumn("_seq", F.lit(None).cast(updates.schema[seq].dataType))
           .withColumn("_new", F.lit(False)))
    rows = old.unionByName(updates.withColumnRenamed(seq, "_seq").withColumn("_new", F.lit(True)))
    order = F.struct("_new", "_seq", *values)
    return (rows.groupBy(*key).agg(F.max_by(F.struct(*values), order).alias("_last"))
            .select(*key, *[F.col("_last")[c].alias(c) for c in values]).select(*base.columns))


def _with_part(df: DataFrame, key: Sequence[str], parts: int) -> DataFrame:
    return df.withColumn("key_part", F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int"))


def write_keyed(df: DataFrame, folder: str, key: Sequence[str], parts: int = KEY_PARTS) -> None:
    """A table in ``parts`` folders by hash of its key, as ``merge_keyed`` needs it."""
    (_with_part(df, key, parts).hint("rebalance", "key_part")
     .write.mode("overwrite").partitionBy("key_part").parquet(folder))


def read_keyed(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return (spark.read.schema(T.StructType([*schema.fields, T.StructField("key_part", T.IntegerType())]))
            .parquet(folder).drop("key_part"))


def merge_keyed(updates: DataFrame, folder: str, schema: T.StructType, key: Sequence[str],
                seq: str, parts: int = KEY_PARTS) -> None:
    """``upsert`` into a table written by ``write_keyed``, in place.

    Only folders that hold a key of ``updates`` are read and written; the others keep their
    files.  The numbers of the changed folders, at most ``parts``, pass the driver.  Merged
    rows are written aside first, so a folder is replaced only once its rows are complete, and
    the same updates can be merged again after a failure.  Key columns keep their types.
    """
    spark = updates.sparkSession
    updates = updates.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields],
                             F.col(seq).alias("_merge_seq"))
    changed = [r[0] for r in _with_part(updates, key, parts).select("key_part").distinct().collect()]
    if not changed:
        return
    whole = T.StructType([*schema.fields, T.StructField("key_part", T.IntegerType())])
    old = (spark.read.schema(whole).parquet(folder).where(F.col("key_part").isin(changed))
           .drop("key_part"))
    path = shared_dir(spark)
    merged = write_through(_with_part(upsert(old, updates, key, "_merge_seq"), key, parts), path)
    (merged.hint("rebalance", "key_part").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("key_part").parquet(folder))
    remove_dir(spark, path)
