"""Column layouts of the tables and records the library reads and writes.

``user_id`` is the tenant key.  A single-tenant data set leaves it out and
passes ``by=()`` to the operators.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

TRANSACTIONS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("id", T.LongType()),
    T.StructField("tx_date", T.DateType()),
    T.StructField("description", T.StringType()),
    T.StructField("amount", MONEY),
    T.StructField("category", T.StringType()),
    T.StructField("account", T.StringType()),
])

ACCOUNTS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("balance", MONEY),
])

BUDGETS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("monthly_limit", MONEY),
])

MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("_question", T.StringType()),
])

RAW_EXAMPLE = T.StructType([
    T.StructField("question", T.StringType()),
    T.StructField("sql", T.StringType()),
    T.StructField("rows", T.ArrayType(T.StringType())),
    T.StructField("context_section", T.StringType()),
    T.StructField("full_prompt", T.StringType()),
    T.StructField("llama_answer", T.StringType()),
    T.StructField("gold_answer", T.StringType()),
])

TRAINING_RECORD = T.StructType([
    T.StructField("messages", T.ArrayType(MESSAGE)),
    T.StructField("metadata", T.StructType([
        T.StructField("question", T.StringType()),
        T.StructField("sql", T.StringType()),
    ])),
])

# Messages whose extra keys have to survive a rewrite are read as maps.  Values keep their types;
# only the keys within a nested object lose their order.
OPEN_RECORD = T.StructType([
    T.StructField("messages", T.ArrayType(T.MapType(T.StringType(), T.VariantType()))),
])
