import datetime as dt
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pitchline.operators.history import last_n, team_perspective, with_recent
from pitchline.plans import core, inplay, pregame, silver

MATCH = "match_id long, match_date date, competition_name string, season_name string, home_team_id long, home_team_name string, away_team_id long, away_team_name string, home_score int, away_score int, match_result string"


def match_rows(n, teams, seed=1, hot=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        home = 0 if hot and i % 3 == 0 else rng.randrange(teams)
        away = (home + 1 + rng.randrange(teams - 1)) % teams
        h, a = rng.randrange(4), rng.randrange(4)
        score = (None, None) if i % 13 == 5 else (h, a)
        day = dt.date(2015, 8, 1) + dt.timedelta(days=rng.randrange(300))
        rows.append((i, day, "L", "2015/2016", home, f"T{home}", away, f"T{away}", *score, "H" if h > a else "A" if h < a else "D"))
    return rows


# ---------------------------------------------------------------- silver


def raw_event(match, **payload):
    return ("set", f"C:\\d\\events\\{match}.json", json.dumps(payload))


def test_events_from_payloads(spark):
    rows = [
        raw_event(7, id="a", minute=3, team={"id": 1, "name": "x"}, type={"id": 16, "name": "Shot"}, location=[1.5, 2],
                  shot={"statsbomb_xg": 0.12345678901, "outcome": {"name": "Goal"}}, duration=None, second=""),
        raw_event(8, id="not wanted"),
        ("set", "x.json", "{}"),
    ]
    raw = spark.createDataFrame(rows, "source_dataset string, source_file string, payload string")
    targets = spark.createDataFrame([(7,)], "match_id long")
    curated = silver.curated_by_file(raw, targets)
    assert [r.normalized_source_file for r in curated.collect()] == ["7.json"]
    e = inplay.parse_event_objects(silver.silver_events(curated)).first()
    assert (e.event_id, e.match_id, e.minute, e.second, e.duration, e.location) == ("a", 7, 3, None, None, ["1.5", "2"])
    assert (e.shot_outcome, e.shot_xg, e.card) == ("Goal", Decimal("0.123456789010000000"), None)


def test_bad_number_fails_the_silver_job(spark):
    raw = spark.createDataFrame([("set", "m.json", '{"match_id": "1", "home_score": "abc"}')], "source_dataset string, source_file string, payload string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.silver_matches(silver.curated_matches(raw)).collect()


def test_slice_and_match_columns(spark):
    def payload(i, comp, season, home=2):
        return json.dumps({"match_id": i, "match_date": "2016-01-02", "competition": {"competition_id": "", "competition_name": comp},
                           "season": {"season_id": 27, "season_name": season}, "home_score": home, "away_score": 1})

    raw = spark.createDataFrame([("set", "f", payload(1, "La Liga", "2015/2016")), ("set", "f", payload(2, "La Liga", "2014/2015")),
                                 ("set", "f", payload(3, "Other", "2015/2016")), ("set", "f", payload(4, "Serie A", "2015/2016", None))],
                                "source_dataset string, source_file string, payload string")
    from pitchline.schemas import TARGET_COMPETITIONS, TARGET_SEASON

    rows = {r.match_id: r for r in silver.silver_matches(silver.curated_matches(raw, TARGET_COMPETITIONS, TARGET_SEASON)).collect()}
    assert set(rows) == {1, 4}
    assert (rows[1].match_result, rows[1].competition_id, rows[1].season_id, rows[1].match_date) == ("H", None, 27, dt.date(2016, 1, 2))
    assert rows[4].match_result == "D"
    target = silver.target_matches(silver.curated_matches(raw, TARGET_COMPETITIONS, TARGET_SEASON)).filter("match_id = 1").first()
    assert (target.match_id_text, target.match_file_name) == ("1", "1.json")


def test_lineups(spark):
    def player(i, positions):
        return {"player_id": i, "player_name": "p", "player_nickname": "", "positions": positions}

    body = {"team_id": 5, "team_name": "t", "lineup": [
        player(1, [{"position": "GK", "from": "00:00", "to": "45:10", "start_reason": "Starting XI"}]),
        player(2, [{"position": "CB", "from": 0, "to": 45, "start_reason": "Substitution - On"}]),
        player(3, [{"position": "CB", "from": 0, "to": None, "start_reason": ""}]),
        player(4, []),
    ]}
    raw = spark.createDataFrame([("set", "9.json", json.dumps(body)), ("set", "9.json", json.dumps({"team_id": 6, "lineup": []}))],
                                "source_dataset string, source_file string, payload string")
    curated = silver.curated_by_file(raw, spark.createDataFrame([(9,)], "match_id long"))
    assert silver.silver_lineups(curated).count() == 2
    players = silver.silver_lineup_players(curated)
    got = {r.player_id: (r.player_nickname, *r.f) for r in players.select("player_id", "player_nickname", silver.first_position(F.col("positions")).alias("f")).collect()}
    assert got == {1: (None, "GK", True, None), 2: (None, "CB", True, 45), 3: (None, "CB", False, None), 4: (None, None, False, None)}


def test_lineup_payloads_are_parsed_once(spark, tmp_path):
    body = {"team_id": 5, "team_name": "t", "lineup": [{"player_id": 1, "player_name": "p"}, None]}
    rows = [(9, json.dumps(body)), (9, json.dumps({"team_id": 6})), (9, json.dumps({"team_id": 7, "lineup": []}))]
    spark.createDataFrame(rows, "match_id long, payload string").write.parquet(f"{tmp_path}/lineups")
    players = silver.silver_lineup_players(spark.read.parquet(f"{tmp_path}/lineups")).select("team_id", "player_id", "player_name")
    assert {tuple(r) for r in players.collect()} == {(5, 1, "p"), (5, None, None)}
    filters = [line for line in players._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line]
    assert not [line for line in filters if "from_json" in line]


# ---------------------------------------------------------------- in-play

EVENT = "match_id long, team_id long, minute int, event_type_name string, shot_outcome string, shot_xg decimal(19,18), card string"


def test_inplay_edges(spark):
    matches = spark.createDataFrame([
        (1, dt.date(2016, 1, 1), "L", "S", 10, "a", 20, "b", 2, 1, "H"), (2, dt.date(2016, 1, 2), "L", "S", 10, "a", 20, "b", 0, 0, "D")], MATCH)
    x = Decimal("0.1")
    events = spark.createDataFrame([
        (1, 10, 0, "Shot", "Goal", x, None), (1, 10, 1, "Shot", "Goal", x, None), (1, 10, 90, "Shot", "Saved To Post", None, None),
        (1, 10, 91, "Shot", "Goal", x, None), (1, 10, None, "Shot", "Goal", x, None), (1, None, 5, "Shot", "Goal", x, None),
        (1, 20, 5, "Shot", "Off T", x, None), (1, 20, 15, "Card", None, None, "Red Card"), (1, 20, 15, "Card", None, None, "Yellow Card"),
        (1, 30, 5, "Pass", None, None, None), (3, 10, 5, "Pass", None, None, None)], EVENT)
    f = {(r.match_id, r.minute): r for r in inplay.build(events, matches).collect()}
    assert len(f) == 180
    assert (f[1, 1].home_score_now, f[1, 1].home_shots_cum, f[1, 1].diff_xg_cum) == (1, 1, x)
    last = f[1, 90]
    assert (last.home_shots_cum, last.home_shots_on_target_cum, last.home_xg_cum, last.home_score_now) == (2, 2, x, 1)
    assert (last.away_shots_cum, last.away_shots_on_target_cum, last.away_red_cards, last.away_passes_cum) == (1, 0, 1, 0)
    assert (f[1, 14].away_shots_last_10, f[1, 15].away_shots_last_10) == (1, 0)
    assert (last.remaining_minutes, last.target_result_final) == (0, "H")
    assert all(f[2, m].home_shots_cum == 0 and f[2, m].diff_xg_cum == 0 for m in range(1, 91))


def test_inplay_properties_with_a_hot_match(spark):
    rng = random.Random(3)
    matches = spark.createDataFrame(match_rows(12, 6), MATCH)
    sides = {r[0]: (r[4], r[6]) for r in match_rows(12, 6)}
    rows = []
    for _ in range(3000):
        m = 0 if rng.random() < 0.4 else rng.randrange(12)
        rows.append((m, rng.choice(sides[m]), rng.randrange(96), rng.choice(["Shot", "Pass"]), rng.choice(["Goal", "Saved", "Off T"]), Decimal(rng.randrange(100)) / 1000, None))
    events = spark.createDataFrame(rows, EVENT)
    wide = inplay.build(events, matches).toPandas().sort_values(["match_id", "minute"])
    assert (wide.groupby("match_id").size() == 90).all()
    long = inplay.rollups(inplay.team_minute_grid(inplay.minute_counts(events, matches), matches)).toPandas()
    assert (long.shots_last_10 <= long.shots_cum).all()
    for _, g in wide.groupby("match_id"):
        assert g.home_shots_cum.is_monotonic_increasing and g.away_passes_cum.is_monotonic_increasing
    total = sum(1 for r in rows if 1 <= r[2] <= 90 and r[3] == "Shot")
    end = wide[wide.minute == 90]
    assert end.home_shots_cum.sum() + end.away_shots_cum.sum() == total
    home = long.merge(wide[["match_id", "minute", "home_team_id", "home_xg_cum"]], left_on=["match_id", "minute", "team_id"], right_on=["match_id", "minute", "home_team_id"])
    assert len(home) == 12 * 90 and (home.xg_cum == home.home_xg_cum).all()


# ---------------------------------------------------------------- pre-game


def brute_recent(rows, n):
    """Earlier match ids per (team, match), oldest first, and how many there were."""
    out = {}
    for team in {r[4] for r in rows} | {r[6] for r in rows}:
        mine = sorted(((r[1], r[0]) for r in rows if team in (r[4], r[6])))
        for i, (_, match) in enumerate(mine):
            out[team, match] = ([m for _, m in mine[max(0, i - n): i]], i)
    return out


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_recent_rows_equal_brute_force_with_a_hot_team(spark, ranges):
    rows = match_rows(150, 8, hot=True)
    sides = team_perspective(spark.createDataFrame(rows, MATCH))
    got = with_recent(sides, ["team_id"], ["points"], ranges=ranges).collect()
    want = brute_recent(rows, 5)
    assert {(r.team_id, r.match_id): ([x.match_id for x in r.recent], r.played_before) for r in got} == want
    newest = last_n(sides, ["team_id"], 5).collect()
    for team in range(8):
        mine = sorted(((r[1], r[0]) for r in rows if team in (r[4], r[6])), reverse=True)[:5]
        assert sorted((r.position, r.match_id) for r in newest if r.team_id == team) == [(i + 1, m) for i, (_, m) in enumerate(mine)]


def test_later_matches_change_nothing_and_first_match_is_empty(spark):
    rows = sorted(match_rows(80, 6), key=lambda r: (r[1], r[0]))
    cut = rows[60][1]
    early = [r for r in rows if r[1] < cut]
    every = pregame.history(spark.createDataFrame(rows, MATCH)).drop("recent")
    part = pregame.history(spark.createDataFrame(early, MATCH)).drop("recent")
    assert part.exceptAll(every).isEmpty()
    first = min(r[1] for r in rows)
    opening = every.filter((F.col("match_date") == F.lit(first)) & (F.col("matches_played_before") == 0)).first()
    assert opening.last5_points_avg is None and opening.days_since_last_match is None


def test_pregame_rows(spark):
    rows = match_rows(60, 5)
    matches = spark.createDataFrame(rows, MATCH)
    events = spark.createDataFrame([(r[0], r[4], 5, "Shot", "Goal", Decimal("0.1"), None) for r in rows if r[0] % 2], EVENT)
    lineups = spark.createDataFrame([(r[0], t, 100 * t + k, f"Pláyer {t} {k}") for r in rows for t in (r[4], r[6]) for k in range(3)],
                                    "match_id long, team_id long, player_id long, player_name string")
    columns = ["xg", "xag", "shots_total", "shots_on_target", "tackles", "interceptions", "blocks", "save_pct"]
    stats = spark.createDataFrame([(f"player {t} {k}", "GK" if k == 0 else "DF", *[float(k + 1)] * 6, None if k == 0 else 1.0, 70.0 + t) for t in range(5) for k in range(2)],
                                  "normalized_player_name string, pos string, " + ", ".join(f"{c} double" for c in columns))
    out = {r.match_id: r for r in pregame.build(matches, events, lineups, stats).collect()}
    assert len(out) == 60 and len(pregame.NUMERIC_FEATURES) == 63
    any_row = out[10]
    assert any_row.home_lineup_xg_sum == 3.0 and any_row.home_lineup_blocks_sum == 1.0 and any_row.home_fbref_matched_players == 2
    assert any_row.home_goalkeeper_save_pct == 70.0 + any_row.home_team_id
    first = min(rows, key=lambda r: (r[1], r[0]))
    assert out[first[0]].home_distinct_players_last5 == 0 and out[first[0]].home_last5_shots_avg is None
    late = max(out.values(), key=lambda r: r.home_matches_played_before)
    assert late.home_distinct_players_last5 == 3
    assert [r for r in out.values() if r.target_result is None and r.target_btts is None]


def test_payloads_stay_where_they_are_unless_many_matches_are_unknown(spark, monkeypatch):
    rows = [("data/events/1.json", '{"id": "a", "minute": "3"}'), ("data/events/2.json", '{"id": "b", "minute": "x"}'), ("data/other.json", "{}")]
    raw = spark.createDataFrame(rows, "source_file string, payload string").withColumn("source_dataset", F.lit("t"))
    targets = spark.createDataFrame([(1,), (3,)], "match_id long")
    wanted = None
    for limit in (200_000, 0):
        monkeypatch.setattr(silver, "MEASURED_IDS", limit)
        for files in (None, raw.select("source_file")):
            curated = silver.curated_by_file(raw, targets, files)
            assert ("LeftAnti" in curated._jdf.queryExecution().executedPlan().toString()) == (limit > 0)
            found = silver.silver_events(curated).collect()
            assert [(r.event_id, r.match_id, r.minute) for r in found] == [("a", 1, 3)]
            wanted = wanted or found
            assert found == wanted
    # fields move instead of payloads; bad text of another match fails nothing
    assert silver.target_events(raw, targets).collect() == wanted


def test_the_driver_holds_no_side_of_some_megabytes(spark, tmp_path):
    from pitchline.session import sized_settings

    (tmp_path / "input").mkdir()
    session = spark.newSession()
    sized_settings(session, str(tmp_path / "input"))
    counts = session.range(100_000).groupBy("id").count()  # 2.4 MB as rows
    joined = session.range(1_000_000).groupBy((F.col("id") % 200_000).alias("id")).count().withColumnRenamed("count", "n").join(counts, "id")
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "BroadcastHashJoin" not in plan.split("Initial Plan")[0]


def test_inplay_pieces_follow_the_input(spark):
    """Rows of zeros shrink so far that pieces merged by their bytes would hold millions: the number of pieces is fixed."""
    from pitchline.catalog.queries import REGISTRY

    plan = REGISTRY["inplay_features"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(match_id#" in plan and "REPARTITION_BY_NUM" in plan and "REPARTITION_BY_COL" not in plan


def test_mapping_counters_match_names_once(spark):
    from pitchline.catalog.queries import REGISTRY

    plan = REGISTRY["mapping_counters"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and plan.count("Scan parquet") == 2


def test_core_events_are_parsed_once_and_looked_up_by_name(spark, tmp_path):
    def event(i, team, player, minute="1"):
        return json.dumps({"id": i, "index": 1, "minute": minute, "team": team, "player": {"name": player}, "type": {"name": "Shot"}})

    home = {"id": 10, "name": "Home"}
    raw = spark.createDataFrame([
        (1, "1.json", event("a", home, "P One")), (2, "1.json", event("a", home, "P One", "2")), (3, "1.json", event("b", {"id": 99, "name": " HOME"}, "no one")),
        (4, "1.json", event("c", None, None)), (5, "7.json", event("d", home, "P One")), (6, "no id", event("e", home, "P One")), (7, "1.json", event(None, home, "P One")),
    ], "raw_event_id long, source_file string, payload string")
    raw.write.parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw")
    matches = spark.createDataFrame([("1",)], "source_match_id string").select(
        core.surrogate_key(F.lit(core.SOURCE), F.col("source_match_id")).alias("match_id"), F.lit(core.SOURCE).alias("source_name"), "source_match_id")
    teams = spark.createDataFrame([(5, core.SOURCE, "10", "home")], "team_id long, source_name string, source_team_id string, normalized_team_name string")
    players = spark.createDataFrame([(8, "p one")], "player_id long, normalized_player_name string")
    events, rejects = core.match_events(None, raw, matches, teams, players)
    found = {r.source_event_id: (r.minute, r.team_id, r.player_id, r.match_id is not None) for r in events.collect()}
    assert found == {"a": (2, 5, 8, True), "b": (1, 5, None, True), "c": (1, None, None, True)}
    assert {(r.raw_event_id, r.reason) for r in rejects.collect()} == {(5, "unknown match"), (6, "unknown match"), (7, "no event id")}
    assert "from_json" not in events._jdf.queryExecution().optimizedPlan().toString()  # what was parsed is read by both joins
    assert "raw_payload" in events.columns and "raw_payload" not in core.match_events(None, raw, matches, teams, players, payload=False)[0].columns
    again, _ = core.match_events(events, raw.filter("raw_event_id = 1"), matches, teams, players)
    assert {r.source_event_id: r.minute for r in again.collect()} == {"a": 1, "b": 1, "c": 1}
