"""Shared column expressions and scan helpers."""

from __future__ import annotations

import pickle

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words.  Fixed value.
WORD = "[^\\x20\\x09-\\x0D]+"
GAP = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Words of a text as an array."""
    return F.filter(F.split(text, GAP), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: A key is hot above this share of all rows; there are 1 / share such keys at most.
HOT_SHARE = 1e-4


def lookup(rows: DataFrame, named: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Left join with a table of distinct, non-null keys, safe for hot ones.

    `count` is the column of `named` with the number of rows of a key.  Keys with
    more than a ten-thousandth of the `total` rows are at most ten thousand, and
    broadcast; no other key can make a partition large, and these are shuffled.
    """
    limit = max(1000, int(total * HOT_SHARE))
    values = [c for c in named.columns if c not in keys and c != count]
    hot = named.filter(F.col(count) > limit).drop(count).withColumn("_hot", F.lit(True))
    rest = named.filter(F.col(count) <= limit).drop(count)
    marked = rows.join(F.broadcast(hot), keys, "left")
    found = marked.filter("_hot").drop("_hot")
    other = marked.filter("_hot is null").drop("_hot", *values).join(rest, keys, "left")
    return found.unionByName(other)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def share(spark: SparkSession, value):
    """Broadcast a value with its classes, so that executors need not have the package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared_value(shared):
    return pickle.loads(shared.value)


class Memo(dict):
    """Bounded cache of a function: two generations, the older one dropped when the younger is full."""

    def __init__(self, fn, limit: int, keeps=None):
        super().__init__()
        self.fn, self.limit, self.keeps, self.old = fn, limit, keeps, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.fn(key)
            if self.keeps is not None and not self.keeps(key):
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def share_kept(spark: SparkSession, value):
    """Like `share`, in a list: `kept_value` puts what it makes of the value in its place."""
    return spark.sparkContext.broadcast([cloudpickle.dumps(value)])


def kept_value(shared, make):
    """What `make` builds from a shared value, once in the life of a Python worker process."""
    box = shared.value
    if isinstance(box[0], bytes):
        box[0] = make(pickle.loads(box[0]))
    return box[0]
