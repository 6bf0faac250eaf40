"""Queries beside their SQL on the smallest tables."""

import os

import pytest

from hockeylake.plans import catalog

DATA = "/root/testdata/sf0.001"
#: A query of each kind; the driver compares all of them.
NAMES = (
    "player_rolling_stats goalie_season_timeline team_season_timeline team_corsi dim_standings insights anomalies_player fn_mmss_seconds fn_localised inc_date_batches src_union_by_name upsert_insights "
    "dq_game_rules snk_dynamic_overwrite trf_games trf_roster trf_schedule trf_swe_lineups pdf_source_priority txt_goals txt_on_ice page_games page_events stream_upsert stream_rolling_form"
).split()


def plain(frame):
    import pandas as pd

    def one(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "-"
        v = v.item() if hasattr(v, "item") else v
        if isinstance(v, float):
            return str(int(v)) if v == int(v) else repr(round(v, 9))
        return str(pd.Timestamp(v)) if hasattr(v, "isoformat") else str(v)

    return sorted("|".join(map(one, r)) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in os.listdir(DATA):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{DATA}/{name}')")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    mine = catalog.QUERIES[name](spark, DATA).toPandas()
    theirs = duck.execute(catalog.ORACLE_SQL[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert plain(mine) == plain(theirs)


def test_entry_points():
    import __spark_entry__

    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
