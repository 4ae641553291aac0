import pytest

from harborlens.sources import paged

FETCH = "tests.paged_fixture:fetch"


def test_pages(spark):
    for query, n in (("good 250", 250), ("good 0", 0), ("good 100", 100), ("shaky 130", 130)):
        rows = paged.search(spark, query, FETCH, pause=0, tries=30).collect()
        assert len({(r.page, r.place) for r in rows}) == len(rows) == n
        assert len({r.record for r in rows}) == n and all(r.page == int(r.record.split(".")[3][:-2]) // 100 + 1 for r in rows)
    assert paged.search(spark, "good 1000", FETCH, most_pages=3).count() == 300


def test_failures(spark):
    with pytest.raises(Exception, match="no answer"):
        paged.search(spark, "broken 250", FETCH, pause=0).collect()
    assert {r.page for r in paged.search(spark, "broken 250", FETCH, pause=0, on_failure="skip").collect()} == {1, 3}
    assert paged.total("good 7", FETCH) == 7 and paged.total("dead 7", FETCH, pause=0) is None
