import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = os.environ.get("TEST_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from lodestrata.session import build_session

    s = build_session("tests", "local[4]", spark__sql__shuffle__partitions="6", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tiny():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def same():
    """Runs a query and its oracle on a data folder and asserts equal columns and rows."""
    return _same


def _cell(v):
    if v is None or v is not v:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "tolist"):
        return _cell(v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(_cell(r[k]) for k in order) for r in rows), key=repr)


def _same(spark, query, oracle, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    got = query(spark, sf_dir)
    want = con.execute(oracle)
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    a, b = _rows(got.columns, got.collect()), _rows(names, want.fetchall())
    assert len(a) == len(b)
    assert a == b
