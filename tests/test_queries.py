"""Every registered query of the library's own operators against its SQL in DuckDB."""

import pytest

from conftest import oracle_rows, rows_of
from periodica.plans import catalog


def plain(rows):
    return [tuple(str(x) if not isinstance(x, (int, bool, float, type(None))) else x for x in r) for r in rows]


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    frame = catalog.QUERIES[name](spark, sf_dir)
    columns, expected = oracle_rows(duck, catalog.ORACLE_SQL[name])
    assert sorted(frame.columns) == columns
    assert plain(rows_of(frame)) == plain(expected)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)


def test_entry_point(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_every_state_reaches_the_fault_checks(spark, sf_dir, monkeypatch):
    from periodica.plans import series_queries as plans

    seen, check = [], plans.rolling.value_faults
    monkeypatch.setattr(plans.rolling, "value_faults", lambda state, plain: seen.append(state) or check(state, plain))
    catalog.QUERIES["r2_r3_state_faults"](spark, sf_dir)
    assert seen[0].count() == plans.rolling.as_vectors(plans.rolled(spark, sf_dir)).count()
