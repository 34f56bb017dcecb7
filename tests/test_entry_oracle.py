"""Driver contract: entry runs; every registered query with an oracle matches DuckDB at sf0.001."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def digest(tbl):
    cols = sorted(tbl.column_names)
    return sorted(tuple(repr(norm(r[c])) for c in cols) for r in tbl.to_pylist())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["pipeline", "region_id", "date"]


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF).toArrow()
    o = con.sql(E.oracle_sql()[name]).to_arrow_table()
    assert sorted(s.column_names) == sorted(o.column_names)
    assert s.num_rows == o.num_rows
    assert hashlib.sha256(repr(digest(s)).encode()).digest() == hashlib.sha256(repr(digest(o)).encode()).digest()


def frame_rows(spark, split=None):
    from stresscast.plans.catalogue import BACKTEST_END, model_frame
    f = model_frame(spark, SF)
    return f.where(f"date > date '{BACKTEST_END}'") if split == "test" else f


def check_params(spark, rows, names):
    assert {(r["pipeline"], r["param"]) for r in rows} == {(p, n) for p in {r["pipeline"] for r in rows} for n in names}
    assert len({r["pipeline"] for r in rows}) == 5
    assert all(math.isfinite(r["estimate"]) and (r["std_error"] is None or r["std_error"] > 0) for r in rows)


def check_fit_stress(spark, rows):
    check_params(spark, rows, {"a", "b_hdd_lag1", "b_storage_lag1", "b_cap_avail_lag1", "b_notices_lag1"})


def check_fit_vol(spark, rows):
    check_params(spark, rows, {"a", "b_op", "b_persist", "b_hdd", "b_storage", "log_sigma", "sigma", "nu"})
    assert all(r["estimate"] > 2 for r in rows if r["param"] == "nu")


def check_probabilities(column, some=True):
    def check(spark, rows):
        days = {(r["pipeline"], r["date"]) for r in frame_rows(spark, "test").select("pipeline", "date").collect()}
        assert len(rows) == len(days) and {(r["pipeline"], r["date"]) for r in rows} == days
        known = [r[column] for r in rows if r[column] is not None]
        assert bool(known) == some and all(0 <= p <= 1 for p in known)
    return check


def check_auc(spark, rows):
    assert len(rows) == 5 and all(r["auc"] is None or 0 <= r["auc"] <= 1 for r in rows)


def check_bins(spark, rows):
    assert 1 <= len(rows) <= 5 and all(0 <= r["observed_freq"] <= 1 and r["n"] > 0 for r in rows)


def check_details(spark, rows):
    pages = spark.read.parquet(f"{SF}/pages.parquet").count()
    assert len(rows) == pages and all(r["tsp"] and r["critical"] == "N" and r["n_heading"] > 0 for r in rows)


def check_some(spark, rows):
    assert rows and all(any(v is not None for v in r.asDict().values()) for r in rows)


#: Queries that SQL cannot express, and what must hold of their rows.
ROWS = {
    "fit_stress": check_fit_stress, "fit_vol": check_fit_vol, "score_vol": check_probabilities("p_vol_exceed"),
    "backtest_stress": check_probabilities("p_stress"), "backtest_vol": check_probabilities("p_vol_exceed"),
    # too few test rows at this scale for the 1095-row mean that the source's inputs need
    "backtest_vol_source_inputs": check_probabilities("p_vol_exceed", some=False), "backtest_stress_eval": check_auc,
    "backtest_vol_reliability": check_bins, "page_detail_extract": check_details, "station_documents": check_some,
    "region_documents": check_some,
}


@pytest.mark.parametrize("name", sorted(ROWS))
def test_rows_of_queries_without_oracle(spark, name):
    ROWS[name](spark, E.queries()[name](spark, SF).collect())


def test_every_query_is_checked():
    from stresscast.plans import catalogue, landing
    known = set(catalogue.QUERIES) | set(landing.QUERIES)
    assert known == (known & set(E.oracle_sql())) | set(ROWS)
