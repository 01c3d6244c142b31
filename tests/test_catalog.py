import pytest
from oracle import compare

from textloom.plans.catalog import CATALOG


@pytest.mark.parametrize("name", sorted(n for n, q in CATALOG.items() if q.sql))
def test_same_as_sql(spark, sf, name):
    assert compare(spark, sf, CATALOG[name].run, CATALOG[name].sql) == ""


@pytest.mark.parametrize("name", sorted(n for n, q in CATALOG.items() if not q.sql))
def test_has_rows(spark, sf, name):
    assert CATALOG[name].run(spark, sf).count() > 0


def test_pair_texts_are_whole(spark, sf):
    whole = {f"{r.source.strip()}\n{r.text}" for r in spark.read.parquet(f"{sf}/documents.parquet").select("source", "text").collect()}
    got = CATALOG["pair_texts"].run(spark, sf).collect()
    assert {r.positive_text for r in got} | {r.negative_text for r in got} <= whole


def test_sources_of_all_texts_are_looked_up(spark, sf, tmp_path):
    import duckdb

    for t in ("documents", "benchmark"):
        more = " UNION ALL SELECT max(item_id) + 1, '?! zzqqxx' FROM x" if t == "benchmark" else ""
        duckdb.sql(f"COPY (WITH x AS (FROM '{sf}/{t}.parquet') SELECT {'item_id, text' if more else '*'} FROM x{more}) TO '{tmp_path}/{t}.parquet'")
    q = CATALOG["source_chunk_lookup"]
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS FROM '{tmp_path}/{t}.parquet'")
    got = sorted((r.query_id, r.chunk_id, r.found) for r in q.run(spark, str(tmp_path)).collect())
    assert got == sorted(db.sql(q.sql).fetchall()) and [r[1:] for r in got if not r[2]] == [(None, False)] and len(got) == db.sql("SELECT count(*) FROM benchmark").fetchall()[0][0]
