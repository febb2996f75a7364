"""CSV seeding of the source tables and checks of their declared keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirstone.schemas import SOURCE_TABLES


# CSV file of each table in a seeding folder.
CSV_FILES = {
    "olist_customers": "olist_customers_dataset.csv",
    "olist_sellers": "olist_sellers_dataset.csv",
    "olist_products": "olist_products_dataset.csv",
    "olist_orders": "olist_orders_dataset.csv",
    "olist_order_items": "olist_order_items_dataset.csv",
    "olist_geolocation": "olist_geolocation_dataset.csv",
    "olist_order_payments": "olist_order_payments_dataset.csv",
    "olist_order_reviews": "olist_order_reviews_dataset.csv",
    "product_category_translation": "product_category_name_translation.csv",
    "click_customers": "customers.csv",
    "click_products": "products.csv",
    "click_sessions": "sessions.csv",
    "click_orders": "orders.csv",
    "click_order_items": "order_items.csv",
    "click_events": "events.csv",
    "click_reviews": "reviews.csv",
}

# Tables whose quoted text may span lines; such files cannot be split, the others can.
FREE_TEXT_TABLES = {"olist_order_reviews", "click_reviews"}


def load_order() -> list[str]:
    """Tables sorted so that every table follows the ones it refers to."""
    ordered: list[str] = []

    def place(table: str) -> None:
        for parent, _ in SOURCE_TABLES[table].references.values():
            place(parent)
        if table not in ordered:
            ordered.append(table)

    for table in SOURCE_TABLES:
        place(table)
    return ordered


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A headed CSV in the table's declared types; a row that does not fit stops the load."""
    return (
        spark.read.schema(SOURCE_TABLES[table].typed)
        .options(header=True, mode="FAILFAST", multiLine=table in FREE_TEXT_TABLES, escape='"')
        .csv(path)
    )


LOAD_ORDER = ("_file", "_block", "_row")


def in_load_order(rows: DataFrame) -> DataFrame:
    """Where each row of a file read came from: file, start of its block, and place among the rows its task reads.

    A block is read by one task from front to back, so these columns order rows as the files do,
    whatever the number of tasks.
    """
    return rows.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def absent_rows(incoming: DataFrame, existing: DataFrame, key: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """Incoming rows whose key the target lacks, one per key.

    Of several incoming rows with one key the first by ``prefer`` (then by
    the remaining columns) is kept.
    """
    ties = [c for c in incoming.columns if c not in key and c not in prefer]
    order = Window.partitionBy(*key).orderBy(*prefer, *ties)
    first = incoming.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")
    return first.join(existing.select(*key), list(key), "left_anti").select(*incoming.columns)


def insert_if_absent(
    incoming: DataFrame, target_path: str, key: Sequence[str], storage: str = "parquet", prefer: Sequence[str] = ()
) -> None:
    """Append the absent rows to a stored table."""
    existing = incoming.sparkSession.read.format(storage).load(target_path)
    absent_rows(incoming, existing, key, prefer).write.format(storage).mode("append").save(target_path)


def seed(
    spark: SparkSession, folder: str, target: str, tables: Sequence[str] | None = None, storage: str = "parquet"
) -> list[str]:
    """Replace typed source tables from a folder of CSV files, parents before children.

    Order reviews may repeat a review id; the one loaded first is kept, in the
    order of the files and of the rows in them. Returns the tables in the order they were loaded.
    """
    loaded = [name for name in load_order() if tables is None or name in tables]
    for name in loaded:
        rows = read_csv(spark, f"{folder}/{CSV_FILES[name]}", name)
        if name == "olist_order_reviews":
            placed = in_load_order(rows)
            rows = absent_rows(placed, placed.where(F.lit(False)), ["review_id"], LOAD_ORDER).drop(*LOAD_ORDER)
        rows.write.format(storage).mode("overwrite").save(f"{target}/{name}")
    return loaded


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose (non-NULL) reference has no parent row."""
    known = parent.select(F.col(parent_key).alias(column))
    return child.where(F.col(column).isNotNull()).join(known, column, "left_anti")


def _answers(tables: Mapping[str, DataFrame], parent: str, key: tuple[str, ...]) -> DataFrame:
    """All constraints that one key of ``parent`` decides: its own uniqueness, and every reference to it.

    Parent rows and references are tagged and meet in one aggregation by key,
    which combines before the shuffle: a key holding a third of all references is one row per task. A
    reference without parent rows is an orphan, as many times as it occurs.
    """
    declared = SOURCE_TABLES[parent].primary_key
    asked = [
        (table, column)
        for table in tables
        for column, (of, named) in SOURCE_TABLES[table].references.items()
        if of == parent and (named,) == key
    ]
    names = [f"_k{i}" for i in range(len(key))]
    rows = tables[parent].select(*[F.col(c).alias(n) for c, n in zip(key, names, strict=True)], F.lit(-1).alias("_from"))
    for i, (table, column) in enumerate(asked):
        child = tables[table].where(F.col(column).isNotNull())
        rows = rows.unionByName(child.select(F.col(column).alias(names[0]), F.lit(i).alias("_from")))
    counts = [F.count_if(F.col("_from") == i).alias(f"_n{i + 1}") for i in range(-1, len(asked))]
    met = rows.groupBy(*names).agg(*counts)
    missing = F.col("_n0") == 0
    found = []
    if key == declared:
        found.append((parent, "primary key " + ", ".join(key), F.count_if(F.col("_n0") > 1)))
    for i, (table, column) in enumerate(asked):
        lost = F.coalesce(F.sum(F.when(missing, F.col(f"_n{i + 1}"))), F.lit(0)).cast("bigint")
        found.append((table, f"{column} references {parent}", lost))
    totals = met.agg(*[total.alias(f"_v{i}") for i, (*_, total) in enumerate(found)])
    lines = [
        F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("constraint_name"), F.col(f"_v{i}").alias("violations"))
        for i, (t, c, _) in enumerate(found)
    ]
    return totals.select(F.inline(F.array(*lines)))


def constraint_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, constraint, violations) for every declared key and reference among ``tables``.

    No join: a table's references and its own key are answered by one aggregation each.
    """
    keys = {(name, SOURCE_TABLES[name].primary_key) for name in tables if SOURCE_TABLES[name].primary_key}
    for name in tables:
        keys |= {(of, (named,)) for of, named in SOURCE_TABLES[name].references.values() if of in tables}
    return reduce(DataFrame.unionByName, [_answers(tables, *one) for one in sorted(keys)])
