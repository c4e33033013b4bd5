import pytest

from cairn.plans import queries as lift

from .conftest import rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(lift.oracle_sql()))
def test_matches_sql(spark, duck, name):
    got = rows_of(lift.queries()[name](spark, SF).toPandas())
    want = rows_of(duck.execute(lift.oracle_sql()[name]).fetchdf())
    assert got == want


@pytest.mark.parametrize("name", ["list_files", "balanced_split", "random_split", "fraction_sample", "cap_sample"])
def test_runs(spark, name):
    assert lift.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries())
