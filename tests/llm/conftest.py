from __future__ import annotations

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def table():
    """Rows of a given table as dictionaries, in a plain list."""

    def read(name: str, sf_dir: str = SF) -> list[dict]:
        relation = duckdb.sql(f"select * from '{sf_dir}/{name}.parquet'")
        return [dict(zip(relation.columns, row)) for row in relation.fetchall()]

    return read


@pytest.fixture
def by():
    """Rows of a DataFrame as dictionaries by the value of a column."""
    return lambda df, key: {row[key]: row.asDict(recursive=True) for row in df.collect()}
