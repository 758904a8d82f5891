"""Every registered query against its DuckDB oracle (the driver's correctness gate) at sf0.001."""

import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tickweave.plans import catalog

# the training-data queries have tests of their own
QUERIES = {k: f for k, f in E.queries().items() if k in catalog.QUERIES}
ORACLE = catalog.ORACLE


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "ma_price_100" in df.columns


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(ORACLE))
    assert missing == [], missing


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "DOUBLE[]": "array<double>"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = duck.sql(ORACLE[name])
    dtypes = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == dtypes
    scols, srows = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(ORACLE[name])
    dcols, drows = _canon([d[0] for d in res.description], res.fetchall())
    assert scols == dcols
    assert len(srows) == len(drows)
    assert srows == drows


def test_entry_schema_is_stable(spark):
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema and a.count() == b.count()
