"""Pages of a day's users from stored ranges."""

import datetime as dt

import pytest

from churnloom.sources import pages

DAY, OTHER = dt.date(2024, 1, 16), dt.date(2024, 1, 17)


@pytest.fixture(scope="module")
def stored_pages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages"))
    ids = [f"u{i:04}" for i in range(250)]
    users = spark.createDataFrame([(DAY, i) for i in ids + ids[:40]] + [(OTHER, "x")], "day date, msno string")
    pages.write_days(users.repartition(5), path, size=30)
    return path, ids


@pytest.mark.parametrize("page,size", [(1, 20), (2, 20), (9, 30), (13, 20), (1, 1000), (84, 3)])
def test_pages_as_slices(spark, stored_pages, page, size):
    path, ids = stored_pages
    got = pages.read_page(spark, path, DAY, page, size)
    want = ids[(page - 1) * size : page * size]
    rows = got.collect()
    assert [r.msno for r in rows] == want
    assert all((r.total, r.page, r.pages) == (250, page, -(-250 // size)) for r in rows)
    assert len(got.inputFiles()) <= (size - 1) // 30 + 2


def test_outside(spark, stored_pages):
    path, _ = stored_pages
    assert pages.read_page(spark, path, DAY, 14, 20).count() == 0
    assert pages.read_page(spark, path, dt.date(2020, 1, 1)).count() == 0
    assert [r.msno for r in pages.read_page(spark, path, OTHER).collect()] == ["x"]
    with pytest.raises(ValueError):
        pages.read_page(spark, path, DAY, 0)


def test_a_day_written_again_is_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    first = spark.createDataFrame([(DAY, f"a{i}") for i in range(9)] + [(OTHER, "b")], "day date, msno string")
    pages.write_days(first, path, size=4)
    pages.write_days(first.where("msno = 'a1'"), path, size=4)
    assert [r.msno for r in pages.read_page(spark, path, DAY).collect()] == ["a1"]
    assert pages.read_page(spark, path, OTHER).count() == 1
