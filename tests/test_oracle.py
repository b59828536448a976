"""A cross-section of the registered queries against their SQL on the smallest tables."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

FOLDER = os.environ.get("PITCHLINE_TESTDATA", "/root/testdata/sf0.001")
TABLES = ["customer", "supplier", "part", "orders", "lineitem", "events"]
CHECKED = [
    "target_slice", "silver_matches", "silver_events", "lineup_position_minutes", "player_stats_normalized", "first_usable_value",
    "inplay_features", "inplay_from_json", "pregame_features", "match_team_stats", "match_player_stats", "upsert_coalesce",
    "core_season_stats", "season_lookup", "temporal_split_rows", "classification_report", "model_metrics", "recent_form",
    "comparison_shares", "coupon", "raw_documents", "raw_routing", "csv_layouts", "inplay_derived", "export_inplay",
    "isotonic_steps", "event_payload_fields", "lineup_payload_fields", "stored_events_second_load", "stored_lineups_second_load",
    "observed_layer_counts", "match_team_stats_stored", "inplay_slice", "feature_medians", "team_mapping", "pregame_by_match",
]

if not os.path.isdir(FOLDER):
    pytest.skip("no test tables", allow_module_level=True)


def canon(value):
    if isinstance(value, float):
        return None if math.isnan(value) else int(value) if value == int(value) else value
    return value


def ordered(rows):
    return sorted((tuple(map(canon, r)) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def test_every_oracle_has_a_query(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(CHECKED) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = con.execute(entry.oracle_sql()[name])
    found = [c[0] for c in result.description]
    assert sorted(found) == columns
    want = [[row[found.index(c)] for c in columns] for row in result.fetchall()]
    assert ordered([row[c] for c in columns] for row in df.collect()) == ordered(want)
