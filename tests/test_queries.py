"""Every registered query of the terrain and table operators against its SQL in DuckDB."""

import duckdb
import pytest

from orogen.plans import catalog

TABLES = "nation customer part events documents embeddings labels".split()


def rows_of(df):
    return sorted(str(tuple(None if v is None or v != v else (float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v) for v in r)) for r in df.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def con(data):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_oracle(spark, data, con, name):
    got = catalog.queries()[name](spark, data).toPandas()
    want = con.execute(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    plain = lambda df: df[columns].astype(object).where(df[columns].notna(), None)
    assert rows_of(plain(got)) == rows_of(plain(want))


@pytest.mark.parametrize("name", ["M01_M02_M03_M05_M11_M12_M22_forest_predictions", "M04_boosted_trees", "M18_M19_O02_tree_nodes", "M20_A16_tree_scores", "R04_R05_coarse_metrics", "R07_W51_M28_scale_variants"])
def test_runs(spark, data, name):
    assert catalog.queries()[name](spark, data).columns


def test_boosted_trees_take_all_rows_and_classes(spark, data):
    got = catalog.queries()["M04_boosted_trees"](spark, data).toPandas()
    rows = spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "label").toPandas()
    assert sorted(got["vec_id"]) == sorted(rows["vec_id"]) and got["proba_max"].notna().all()
    assert set(got["pred_label"]) == {str(x) for x in rows["label"].dropna().astype(int)} - {"9"}


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
