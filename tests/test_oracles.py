"""Every registered query against its SQL twin in DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from offerledger.plans import registry

SF = "/root/testdata/sf0.001"


def _rows(frame):
    frame = frame[sorted(frame.columns)]
    clean = lambda v: None if pd.isna(v) else round(float(v), 6) if isinstance(v, float) else v
    return sorted((tuple(clean(v) for v in row) for row in frame.astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    got = registry.QUERIES[name](spark, SF).toPandas()
    want = con.sql(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got)
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0
