from decimal import Decimal

import pytest

from tallyguard.operators import catalog
from tallyguard.schemas import PRODUCT


@pytest.fixture(scope="module")
def products(spark):
    rows = [
        (1, "Keyboard", "Electronics", Decimal("49.99"), 3),
        (2, "Coffee Mug", "Kitchen", Decimal("9.99"), 10),
        (3, "Monitor", "Electronics", Decimal("199.99"), 1),
        (4, "Notebook", "Stationery", Decimal("4.50"), 0),
    ]
    return spark.createDataFrame(rows, PRODUCT)


def test_summary_in_order(products):
    got = [
        (r.category, r.product_count, r.total_value, float(r.average_price))
        for r in catalog.category_summary(products).collect()
    ]
    assert got == [
        ("Electronics", 2, Decimal("249.98"), 124.99),
        ("Kitchen", 1, Decimal("9.99"), 9.99),
        ("Stationery", 1, Decimal("4.50"), 4.5),
    ]


def test_equal_totals_keep_first_appearance(spark):
    rows = [(n, "x", c, Decimal("1.00"), 1) for n, c in enumerate(["b", "a", "c"])]
    got = catalog.category_summary(spark.createDataFrame(rows, PRODUCT)).collect()
    assert [r.category for r in got] == ["b", "a", "c"]


@pytest.mark.parametrize(
    ("category", "ids"),
    [("eLECTRONICS", [1, 3]), (None, [1, 2, 3, 4]), ("  ", [1, 2, 3, 4]), (" Kitchen", [])],
)
def test_category_filter(products, category, ids):
    got = catalog.products_by_category(products, category).collect()
    assert sorted(r.id for r in got) == ids


def test_inventory_report_is_one_row(products):
    row = catalog.inventory_report(products).first()
    assert (row.product_count, row.total_inventory_value) == (4, Decimal("449.86"))


def test_pages(products):
    def ids(**options):
        return [r.id for r in catalog.paged_listing(products, "name", "id", **options).collect()]

    assert ids(page=1, page_rows=3) == [2, 1, 3]
    assert ids(page=2, page_rows=3) == [4]
    assert ids(page=1, page_rows=2, ascending=False) == [4, 3]
    assert ids(page=3, page_rows=3) == []


def listing(spark, n=137):
    rows = [(k, None if k % 40 == 7 else f"name {k * 7 % 31}", k) for k in range(n)]
    return spark.createDataFrame(rows, "id int, name string, _n int").repartition(3)


@pytest.mark.parametrize("ascending", [True, False])
def test_pages_by_index_and_by_key_are_the_offset_pages(spark, tmp_path, ascending):
    rows = listing(spark)
    index = catalog.PageIndex(rows, "name", "id", str(tmp_path / "index"), ascending, ranges=7)
    last, n = None, 0
    for page in range(1, 16):
        want = catalog.paged_listing(rows, "name", "id", page, 10, ascending).collect()
        assert index.page(page, 10).collect() == want
        got = catalog.page_after(rows, "name", "id", last, 10, ascending).collect()
        assert got == want
        n += len(got)
        last = (got[-1].name, got[-1].id) if got else last
    assert n == index.total == 137


def test_a_page_reads_only_the_ranges_it_touches(spark, tmp_path):
    index = catalog.PageIndex(listing(spark), "name", "id", str(tmp_path / "index"), ranges=4)
    assert len(index.ranges) > 1
    plan = index.page(1, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "_range" in plan and index.page(99, 5).count() == 0
    empty = catalog.PageIndex(listing(spark).limit(0), "name", "id", str(tmp_path / "none"))
    assert empty.total == 0 and empty.page(1, 5).count() == 0
