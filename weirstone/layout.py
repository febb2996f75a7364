"""Where each table of each layer lives, and in which storage format."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from weirstone.schemas import SOURCE_TABLES

# Table names per layer, in build order.
SILVER_TABLES = (
    "olist_customers",
    "olist_sellers",
    "olist_products",
    "olist_orders",
    "olist_order_items",
    "olist_order_payments",
    "olist_order_reviews",
    "click_customers",
    "click_products",
    "click_sessions",
    "click_orders",
    "click_order_items",
    "click_events",
    "click_reviews",
)
GOLD_TABLES = (
    "dim_date",
    "dim_customer",
    "dim_seller",
    "dim_product",
    "dim_device",
    "dim_traffic_source",
    "dim_click_customer",
    "dim_click_product",
    "fact_orders",
    "fact_reviews",
    "fact_click_orders",
    "fact_sessions",
    "fact_clickstream_events",
    "fact_click_reviews",
)
LAYERS = {"bronze": tuple(SOURCE_TABLES), "silver": SILVER_TABLES, "gold": GOLD_TABLES}


@dataclass(frozen=True)
class Lake:
    """A root folder (any URI Spark can write) holding the three layers.

    ``storage`` is the table format: parquet by default, delta where its
    connector is on the classpath.
    """

    root: str
    storage: str = "parquet"

    def path(self, layer: str, table: str) -> str:
        if table not in LAYERS[layer]:
            raise KeyError(f"no {layer} table named {table}")
        folder = SOURCE_TABLES[table].topic if layer == "bronze" else table
        return f"{self.root}/{layer}/{folder}/"

    @property
    def metrics_path(self) -> str:
        return f"{self.root}/gold/_pipeline_metrics/"

    @property
    def quality_log_path(self) -> str:
        return f"{self.root}/silver/_data_quality_log/"

    def tables(self, layer: str, table: str | None = None) -> dict[str, str]:
        """Name -> path for a whole layer, or for one table of it."""
        names = LAYERS[layer] if table is None else (table,)
        return {name: self.path(layer, name) for name in names}

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        return self.load(spark, self.path(layer, table))

    def load(self, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.format(self.storage).load(path)
