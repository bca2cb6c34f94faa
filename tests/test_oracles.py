"""Every query with SQL gives the rows that a second engine gives for that SQL."""

import math

import pytest

from lexloom.plans import audits, entries, formats, gates, more, queries as Q  # noqa: F401


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if type(v).__name__ == "Decimal":
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_sql(name, spark, sf_dir, duck):
    df = Q.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(Q.SQL[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == columns
    theirs = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=repr)
    assert ours == theirs
