"""Every registered query of the plans against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from tallygrove.plans import places, registry, reports  # noqa: F401
from tallygrove.plans.queries import ORACLE_SQL, QUERIES

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in SF.glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.skipif(not SF.exists(), reason="no tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, tmp_path, name):
    df = QUERIES[name](spark, str(SF))
    columns = ", ".join(f'"{c}"' for c in sorted(df.columns))
    df.coalesce(1).write.parquet(str(tmp_path / "out"))
    con.execute(f"CREATE OR REPLACE TEMP TABLE got AS SELECT {columns} FROM '{tmp_path}/out/*.parquet'")
    if name not in ORACLE_SQL:
        return
    con.execute(f"CREATE OR REPLACE TEMP TABLE want AS SELECT {columns} FROM ({ORACLE_SQL[name]})")
    assert con.execute("SELECT * FROM (FROM want EXCEPT ALL FROM got) LIMIT 3").fetchall() == []
    assert con.execute("SELECT * FROM (FROM got EXCEPT ALL FROM want) LIMIT 3").fetchall() == []
    assert con.execute("DESCRIBE got").fetchall() == con.execute("DESCRIBE want").fetchall()
