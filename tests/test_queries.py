import hashlib

import duckdb
import pytest

import __spark_entry__ as entry
from vetmill.plans.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_like_sql(spark, sql, name):
    df = QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in names]).collect()), key=repr)
    if name in SQL:
        want = sql.sql("SELECT " + ", ".join(f'"{c}"' for c in names) + f" FROM ({SQL[name]}) q").fetchall()
        assert got == sorted(want, key=repr)
    assert got


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(SQL) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_names_folded_over_all_documents(spark, tmp_path):
    texts = ["Straße", "GROẞ  und\tklein", "ΟΔΟΣ Σοφός", "École", "plain Text", "", None]
    spark.createDataFrame([(i, t, "de") for i, t in enumerate(texts)], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.key for r in QUERIES["names_folded_all"](spark, str(tmp_path)).collect()}
    assert got == {i: hashlib.sha256(" ".join((t or "").split()).casefold().encode()).hexdigest() for i, t in enumerate(texts)}
