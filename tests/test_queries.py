import pytest

from allelespan.plans import catalog
from tests.oracles import connected, same


@pytest.fixture(scope="module")
def con(sf_dir):
    return connected(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, con, sf_dir, name):
    same(spark, con, catalog.queries()[name], catalog.oracle_sql()[name], sf_dir)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert catalog.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["kmer", "cnt"]
    assert set(e.oracle_sql()) <= set(e.queries())


def test_hotspots_without_an_end_equal_sql(spark, con, sf_dir, tmp_path):
    con.execute("CREATE TEMP TABLE odd AS SELECT * REPLACE (CASE WHEN event_id % 3 = 0 OR event_id % 40 = 7 THEN NULL ELSE user_id END AS user_id) FROM events")
    con.execute(f"COPY odd TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    (tmp_path / "benchmark.parquet").symlink_to(f"{sf_dir}/benchmark.parquet")
    sql = catalog.oracle_sql()["hotspot_sequences"].replace("FROM events)", "FROM odd)")
    same(spark, con, catalog.queries()["hotspot_sequences"], sql, str(tmp_path))
