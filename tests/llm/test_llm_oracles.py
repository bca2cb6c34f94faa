"""Operators that SQL can express give the rows that a second engine gives."""

import pytest

from lexloom.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(name, spark, sf_dir, duck):
    df = Q.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = sorted(tuple(r[c] for c in columns) for r in df.collect())
    cursor = duck.execute(Q.oracle_sql()[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == columns
    assert ours == sorted(tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall())


def test_every_operator_has_a_query():
    names = list(Q.queries())
    assert [int(x.removeprefix("op").split("_")[0]) for x in names] == list(range(1, 11))
