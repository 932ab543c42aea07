from __future__ import annotations

from fixtures import tuples

from trailmill import schemas
from trailmill.operators import products

CITIES = [(1, "a", "华北"), (11, "a", "华北"), (2, "b", "东北"), (3, "c", "华中"), (4, "d", "西南")]


def _cities(spark):
    return spark.createDataFrame(CITIES, schemas.CITY_INFO)


def _clicks(spark, *rows):
    return spark.createDataFrame(list(rows), "city_id long, product_id long")


def _products(spark):
    return spark.createDataFrame(
        [
            (1, "p1", '{"product_status": 0}'),
            (2, "p2", '{"product_status": 1}'),
            (3, "p3", '{"product_status"'),
            (4, "p4", None),
            (5, "p5", "{}"),
        ],
        schemas.PRODUCT_INFO,
    )


def test_city_list_keeps_names_contained_in_others(spark):
    got = products.area_product_clicks(_clicks(spark, (11, 1), (1, 1), (1, 1), (99, 1)), _cities(spark))
    assert tuples(got, "area", "product_id", "click_count", "city_infos") == [
        ("华北", 1, 3, "11:a,1:a")
    ]


def test_status_of_unreadable_records(spark):
    counts = spark.createDataFrame([("x", n, 1, "") for n in range(1, 7)], "area string, product_id long, click_count long, city_infos string")
    got = products.with_product_info(counts, _products(spark))
    assert tuples(got, "product_id", "product_status") == [
        (1, "Self"),
        (2, "Third Party"),
        (3, "Third Party"),
        (4, "Third Party"),
        (5, "Third Party"),
    ]


def test_top_products_break_ties_by_id(spark):
    clicks = _clicks(spark, *[(1, p) for p in (5, 4, 3, 2, 1)], (2, 2), (2, 2), (2, 9), (3, 1), (4, 1))
    got = products.top_products_by_area(clicks, _cities(spark), _products(spark))
    assert tuples(got, "area", "area_level", "product_id", "click_count") == [
        ("东北", "D级", 2, 2),
        ("华中", "B级", 1, 1),
        ("华北", "A级", 1, 1),
        ("华北", "A级", 2, 1),
        ("华北", "A级", 3, 1),
        ("西南", "C级", 1, 1),
    ]
