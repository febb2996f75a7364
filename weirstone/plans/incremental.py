"""The order fact kept up to date by the orders that changed, month by month.

``fact_orders`` joins four silver tables and three dimensions. Instead of joining all of it
again after a batch of changes, ``changed_orders`` finds the orders whose rows can differ, one delta per
input: the orders that events name, those of customers that events name, and those whose dimension keys
have moved. ``OrderFacts.apply`` joins only these, by the builder's own plan, and replaces
the months they are in, before and now; other months' files are left as they are.

Rows have no surrogate key of their own here: ``numbered`` gives it on reading, as the full build does.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstone.functions import cleaning as clean
from weirstone.plans.gold import numbered_order_items, order_item_rows

UNKNOWN_MONTH = 0
INPUTS = ("olist_order_items", "olist_orders", "olist_order_payments", "olist_customers", "dim_customer", "dim_seller", "dim_product")

Tables = Mapping[str, DataFrame]


def _month(stamp: str) -> Column:
    return F.coalesce(F.date_format(stamp, "yyyyMM").cast("int"), F.lit(UNKNOWN_MONTH)).alias("month")


def _named(events: DataFrame, column: str) -> DataFrame:
    """The values of a key column in both images of the events."""
    both = events.select(F.explode(F.array(f"after.{column}", f"before.{column}")).alias(column))
    return both.select(clean.text(F.col(column)).alias(column)).where(F.col(column).isNotNull()).distinct()


def _moved(before: DataFrame, after: DataFrame, business: str, surrogate: str) -> DataFrame:
    """Business keys whose surrogate key is new, another or gone: two narrow columns of a dimension meet, no facts."""
    old = before.select(business, F.col(surrogate).alias("_old"))
    new = after.select(business, F.col(surrogate).alias("_new"))
    return old.join(new, business, "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new"))).select(business)


def changed_orders(events: Tables, before: Tables, after: Tables) -> DataFrame:
    """(order_id) of the orders whose fact rows may differ between two states of the inputs.

    ``events`` are the decoded changes of the batch by source table; a table may be left out. What
    changes through a customer or a dimension is found among the tables as they are now: an order or
    item that is there no longer has an event of its own.
    """
    orders, items = after["olist_orders"], after["olist_order_items"]
    found = [_named(events[t], "order_id") for t in ("olist_orders", "olist_order_items", "olist_order_payments") if t in events]
    customers = [_named(events["olist_customers"], "customer_id")] if "olist_customers" in events else []
    people = _moved(before["dim_customer"], after["dim_customer"], "customer_unique_id", "customer_sk")
    customers.append(after["olist_customers"].join(people, "customer_unique_id", "left_semi").select("customer_id"))
    found.append(orders.join(reduce(DataFrame.union, customers).distinct(), "customer_id", "left_semi").select("order_id"))
    for table, business, surrogate in (("dim_seller", "seller_id", "seller_sk"), ("dim_product", "product_id", "product_sk")):
        found.append(items.join(_moved(before[table], after[table], business, surrogate), business, "left_semi").select("order_id"))
    return reduce(DataFrame.union, found).distinct()


@dataclass(frozen=True)
class OrderFacts:
    """The fact at ``root``, in folders of the month of purchase."""

    root: str

    def _rows(self, tables: Tables) -> DataFrame:
        return order_item_rows(*[tables[name] for name in INPUTS]).withColumn("month", _month("order_purchase_timestamp"))

    def _write(self, rows: DataFrame) -> None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        writer.partitionBy("month").parquet(self.root)

    def rebuild(self, tables: Tables) -> None:
        self._rows(tables).write.mode("overwrite").option("compression", "zstd").partitionBy("month").parquet(self.root)

    def apply(self, changed: DataFrame, before: Tables, after: Tables) -> list[int]:
        """Bring the fact from one state of the inputs to the next; returns the months written or emptied.

        ``changed`` (order_id) should be stored: it is read several times. Applied again, it gives the same.
        """
        spark = changed.sparkSession
        stamps = before["olist_orders"].select("order_id", "order_purchase_timestamp").unionByName(
            after["olist_orders"].select("order_id", "order_purchase_timestamp")
        )
        # a list of months is as long as the shop is old
        months = sorted(
            r["month"] for r in stamps.join(changed, "order_id", "left_semi").select(_month("order_purchase_timestamp")).distinct().collect()
        )
        if not months:
            return []
        narrowed = {
            name: table.join(changed, "order_id", "left_semi") if "order_id" in table.columns else table for name, table in after.items()
        }
        kept = self._stored(spark).where(F.col("month").isin(months)).join(changed, "order_id", "left_anti")
        fresh = self._rows(narrowed)
        self._write(kept.unionByName(fresh.select(*kept.columns)))
        self._drop_emptied(months, changed, fresh)
        return months

    def _drop_emptied(self, months: list[int], changed: DataFrame, fresh: DataFrame) -> None:
        """A month without rows is not overwritten by a dynamic overwrite; its folder then holds changed orders only."""
        spark = changed.sparkSession
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        alive = {r["month"] for r in fresh.select("month").distinct().collect()}
        for month in set(months) - alive:
            if self._stored(spark).where(F.col("month") == month).join(changed, "order_id", "left_anti").isEmpty():
                path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/month={month}")
                path.getFileSystem(conf).delete(path, True)

    def _stored(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.root)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark).drop("month")

    def numbered(self, spark: SparkSession) -> DataFrame:
        """With surrogate keys, those a full build gives."""
        return numbered_order_items(self.read(spark))
