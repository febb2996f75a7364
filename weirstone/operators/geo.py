"""One coordinate per zip prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.functions.cleaning import code, text
from weirstone.functions.parsing import real
from weirstone.operators.latest import images


def zip_coordinates(geolocation_changes: DataFrame) -> DataFrame:
    """(zip, latitude, longitude): the southernmost city average of each zip.

    Points are averaged per (zip, city, state) after dropping coordinates off
    the globe, then the lowest average latitude wins, longitude breaking ties.
    Both steps combine before they shuffle.
    """
    points = (
        images(geolocation_changes)
        .select(
            text(F.col("geolocation_zip_code_prefix")).alias("zip"),
            code(F.col("geolocation_city")).alias("city"),
            code(F.col("geolocation_state")).alias("state"),
            real(F.col("geolocation_lat")).alias("lat"),
            real(F.col("geolocation_lng")).alias("lng"),
        )
        .where(F.col("zip").isNotNull() & F.col("lat").between(-90, 90) & F.col("lng").between(-180, 180))
    )

    def mean(name: str):
        # decimal sums do not depend on the order of the partitions
        return F.round(F.avg(F.col(name).cast("decimal(18,9)")), 6).cast("double").alias(name)

    cities = points.groupBy("zip", "city", "state").agg(mean("lat"), mean("lng"))
    lowest = cities.groupBy("zip").agg(F.min(F.struct("lat", "lng")).alias("point"))
    return lowest.select("zip", F.col("point.lat").alias("latitude"), F.col("point.lng").alias("longitude"))
