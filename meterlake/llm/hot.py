"""Keys that hold a large share of all rows: finding the few of them, and joins that spread their rows.

Of N rows fewer than HOT_KEYS keys can hold more than N / HOT_KEYS rows each, so the list of hot keys is bounded whatever the
data and may be broadcast.  Rows of a hot key get a salt, the partition they sit in, which is stable under task retry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000
HOT_KEYS = 1_000


def hot_keys(keys: DataFrame, rows: int = HOT_ROWS) -> DataFrame:
    """key, salts of the keys with more than max(rows, all rows / HOT_KEYS) rows of the frame's only column; null is no key."""
    (key,) = keys.columns
    per = keys.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    most = max(rows, keys.count() // HOT_KEYS)
    return per.where(F.col("n") > most).select("key", F.ceil(F.col("n") / most).cast("int").alias("salts"))


def spread_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame, how: str = "left", hint: str = "merge") -> DataFrame:
    """left join right on key (inner or left), rows of the keys in ``hot`` spread over as many tasks as they have salts.

    ``right`` should hold few rows of a key: those of hot keys are repeated once for each salt.  Left rows with a null key go
    by their partition and match nothing.
    """
    salts = F.broadcast(hot.select(F.col("key").alias("_hot"), "salts"))
    left = left.withColumn("_salt_of", F.spark_partition_id())
    left = left.join(salts, F.col(key) == F.col("_hot"), "left").withColumn("_salt", _salt(key)).drop("_hot", "salts", "_salt_of")
    right = right.join(salts, F.col(key) == F.col("_hot"), "left")
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("_hot", "salts")
    return left.join(right.hint(hint), [key, "_salt"], how).drop("_salt")


def _salt(key: str):
    """Salt of a row; rows without a key are dealt by their partition alone."""
    return F.when(F.col(key).isNull(), F.col("_salt_of")).otherwise(F.pmod(F.col("_salt_of"), F.coalesce("salts", F.lit(1))))
