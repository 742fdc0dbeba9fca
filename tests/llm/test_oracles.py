"""Operators with SQL against DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from tests.conftest import DATA
from walletgraph.llm import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = catalog.QUERIES[name](spark, DATA)
    ref = con.execute(catalog.ORACLES[name])
    at = {d[0]: i for i, d in enumerate(ref.description)}
    assert sorted(at) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(repr(tuple(r[at[c]] for c in df.columns)) for r in ref.fetchall())
