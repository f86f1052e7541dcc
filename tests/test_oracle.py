"""Every registered query against its SQL on the smallest tables."""

import pytest

from checks.adapters import documents
from checks.compare import connect, difference, oracle_rows, spark_rows
from checks.oracle import ORACLE
from checks.queries import QUERIES
from repopulse.operators import embedding

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal(spark, con, name):
    ours = spark_rows(QUERIES[name](spark, FOLDER))
    assert difference(ours, oracle_rows(con, ORACLE[name])) is None


def test_hashing_encoder_rows(spark):
    texts = embedding.embed_text(documents(spark, FOLDER))
    rows = embedding.hashing_encoder(embedding.fit_hashing(texts))(texts).collect()
    assert rows and {len(row.embedding) for row in rows} == {384}
    for row in rows:
        norm = sum(x * x for x in row.embedding)
        assert abs(norm - 1) < 1e-4 or norm == 0


def test_entry():
    import __spark_entry__ as entry

    assert entry.queries().keys() >= entry.oracle_sql().keys()
