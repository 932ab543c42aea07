"""Clicks by area and product, and the top products of each area."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import jsons, text
from .ranking import top_n_per_group

# The area names of each level, and the level of all other areas.
AREA_LEVELS: dict[str, tuple[str, ...]] = {
    "A级": ("华北", "华东"),
    "B级": ("华南", "华中"),
    "C级": ("西北", "西南"),
}
OTHER_LEVEL = "D级"


def area_level(
    area: Column, levels: Mapping[str, Sequence[str]] = AREA_LEVELS, other: str = OTHER_LEVEL
) -> Column:
    result = F.lit(other)
    for level, areas in reversed(list(levels.items())):
        result = F.when(area.isin(*areas), level).otherwise(result)
    return result


def area_product_clicks(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """``area, product_id, click_count, city_infos`` (sorted ``id:name`` list).

    Clicks are counted by city and product first, in a map-side hash aggregate over two numbers:
    a product with a third of all clicks becomes one row per city, and the join with the cities,
    the text and the set only see those counts.
    """
    counted = clicks.groupBy("city_id", "product_id").agg(F.count("*").alias("clicks"))
    located = counted.join(cities.select("city_id", "city_name", "area"), "city_id")
    return located.groupBy("area", "product_id").agg(
        F.sum("clicks").alias("click_count"),
        text.group_concat_distinct(text.concat_long_string("city_id", "city_name", ":")).alias(
            "city_infos"
        ),
    )


def with_product_info(area_clicks: DataFrame, products: DataFrame) -> DataFrame:
    """Add ``product_name, product_status``; a product without a record is dropped."""
    info = products.select(
        "product_id",
        "product_name",
        jsons.product_status("extend_info").alias("product_status"),
    )
    return area_clicks.join(info, "product_id")


def top_products_by_area(
    clicks: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    levels: Mapping[str, Sequence[str]] = AREA_LEVELS,
    other: str = OTHER_LEVEL,
    n: int = 3,
) -> DataFrame:
    """The n most clicked products of each area; ties go to the smaller product id."""
    full = with_product_info(area_product_clicks(clicks, cities), products)
    top = top_n_per_group(full, ["area"], [F.desc("click_count"), F.col("product_id")], n)
    return top.select(
        "area",
        area_level(F.col("area"), levels, other).alias("area_level"),
        "product_id",
        "click_count",
        "city_infos",
        "product_name",
        "product_status",
    )
