"""Quality gates that read only what has arrived: a table's profile, kept beside it and added up.

For each part that arrives, ``absorb`` stores its counts (rows, NULL keys, broken rules) and the
128-bit digests of its keys with how often each occurs. The gate's verdict on the whole
table is the sum of the counts; duplicates are those within the part and the keys that an
earlier part holds already, found by a join of digests: 16 bytes a row instead of the rows.
A part absorbed again, being the newest, replaces itself.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstone.operators.quality import Check, Result, measured_counts, results_of


def _key_digest(check: Check) -> list[Column]:
    """Two hashes of the key, NULLs told apart from values and from each other's place."""
    parts = [x for key in check.keys for x in (F.col(key).isNull(), F.col(key))]
    return [F.xxhash64(F.lit(seed), *parts).alias(name) for seed, name in ((1, "_h1"), (2, "_h2"))]


@dataclass(frozen=True)
class Profile:
    """The profile of one table: folders of counts and key digests, one of each per part."""

    root: str
    table: str
    check: Check

    def absorb(self, part: DataFrame, number: int) -> list[Result]:
        """Add a part (numbers go up) and judge the whole table as it is then."""
        spark = part.sparkSession
        if self.check.row_filter is not None:
            part = part.where(self.check.row_filter)
        counts = measured_counts(part, self.check)
        extra = self._duplicates(part, number) if self.check.unique and self.check.keys else 0
        row = {**counts, "extra": extra}
        schema = ", ".join(f"`{name}` BIGINT" for name in row)
        spark.createDataFrame([tuple(row.values())], schema).coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/counts/part={number:012d}"
        )
        return self.verdict(spark)

    def _duplicates(self, part: DataFrame, number: int) -> int:
        """Rows whose key is not new: repeated within the part, or known from an earlier one."""
        keys, folder = _key_digest(self.check), f"{self.root}/keys/part={number:012d}"
        part.select(*keys).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("copies")).write.mode("overwrite").parquet(folder)
        own = part.sparkSession.read.parquet(folder)
        repeated = own.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("n"))
        earlier = part.sparkSession.read.option("basePath", f"{self.root}/keys").parquet(f"{self.root}/keys")
        earlier = earlier.where(F.col("part") < number).select("_h1", "_h2").distinct()
        known = own.join(earlier, ["_h1", "_h2"], "left_semi").agg(F.count(F.lit(1)).alias("n"))
        return sum(row["n"] for row in repeated.unionByName(known).collect())

    def verdict(self, spark: SparkSession) -> list[Result]:
        """The checks of all parts so far, as validating the whole table would give them."""
        stored = spark.read.parquet(f"{self.root}/counts").drop("part")
        total = stored.agg(*[F.sum(F.col(f"`{c}`")).alias(c) for c in stored.columns]).first().asDict()
        extra = total.pop("extra")
        if self.check.unique and self.check.keys:
            total["distinct"] = total["total"] - extra
        return results_of(self.table, self.check, total)


def absorbed(profile: Profile, parts: list[DataFrame]) -> list[Result]:
    """Absorb several parts in order; the verdict after the last."""
    return reduce(lambda _, numbered: profile.absorb(numbered[1], numbered[0]), enumerate(parts), [])
