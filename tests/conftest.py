import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from betaloom.session import session

    s = session("tests", master="local[4]", shuffle_partitions=4, spark__ui__enabled="false", spark__driver__memory="4g", spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/sf0.001/{t}.parquet'")
    return con


@pytest.fixture(scope="session")
def same(spark, duck):
    """Whether a query and its SQL give the same columns, types and rows."""

    def normal(rows):
        return sorted(tuple("null" if v is None or v != v else repr(float(v)) if isinstance(v, float) else str(v) for v in r) for r in rows)

    def check(query, sql):
        df = query(spark, f"{DATA}/sf0.001")
        cols = sorted(df.columns)
        got = duck.execute(sql)
        types = {c[0]: str(c[1]) for c in got.description}
        assert sorted(types) == cols
        names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
        assert {c: names[t] for c, t in df.dtypes} == types
        at = [list(types).index(c) for c in cols]
        assert normal(df.select(*cols).collect()) == normal([r[i] for i in at] for r in got.fetchall())

    return check
