"""Standardisation with population deviation, one-hot columns and splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation of each feature (deviation 0 counts as 1)."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]

    @classmethod
    def fit(cls, df: DataFrame, features) -> "Scaler":
        features = tuple(features)
        row = df.agg(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(features)],
        ).first()
        n = len(features)
        return cls(features, tuple(row[:n]), tuple(s or 1.0 for s in row[n:]))

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        return df.withColumns(
            {
                f"{prefix}{c}": (F.col(c) - F.lit(m)) / F.lit(s)
                for c, m, s in zip(self.features, self.means, self.scales)
            }
        )

    def inverse(self, values) -> list[float]:
        return [v * s + m for v, m, s in zip(values, self.means, self.scales)]


def standardize(df: DataFrame, features, suffix: str = "_z") -> DataFrame:
    """Lazy form: the statistics are a scalar subquery of the same frame."""
    stats = df.agg(
        F.struct(
            *[
                F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c)
                for c in features
            ]
        )
    ).scalar()

    def scaled(c):
        s = stats[c]["s"]
        return (F.col(c) - stats[c]["m"]) / F.when(s == 0, 1.0).otherwise(s)

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in features})


def one_hot(df: DataFrame, col: str, categories, prefix: str) -> DataFrame:
    """0/1 column per given category; unseen values get zeros everywhere."""
    return df.withColumns(
        {f"{prefix}_{c}": F.coalesce((F.col(col) == c).cast("int"), F.lit(0)) for c in categories}
    )


def temporal_split(df: DataFrame, test_year: int, year="year") -> DataFrame:
    """Mark rows before the test year TRAIN, rows of it TEST; drop the others."""
    return df.filter(F.col(year) <= test_year).withColumn(
        "split", F.when(F.col(year) < test_year, "TRAIN").otherwise("TEST")
    )


def hash_split(df: DataFrame, keys, test_share: float = 0.2, seed: int = 42):
    """Repeatable random split by the hash of the keys: (train, test)."""
    u = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(10_000)) / 10_000.0
    return df.filter(u >= test_share), df.filter(u < test_share)
