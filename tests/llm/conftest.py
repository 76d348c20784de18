import duckdb
import pytest

from lumenframe.llm.common import DOCUMENT  # noqa: F401

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source[, lang]]) rows."""

    def make(rows):
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def against_twin(spark, tmp_path):
    """Runs a query over planted documents and holds its rows against those of its SQL twin."""
    from lumenframe.llm import queries

    def run(name, docs):
        docs.write.parquet(str(tmp_path / "documents.parquet"))
        df = queries.QUERIES[name](spark, str(tmp_path))
        got = df.collect()
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        cur = con.execute(queries.ORACLES[name])
        at = [[d[0] for d in cur.description].index(c) for c in df.columns]
        assert sorted(map(str, map(tuple, got))) == sorted(str(tuple(r[i] for i in at)) for r in cur.fetchall())
        return got

    return run
