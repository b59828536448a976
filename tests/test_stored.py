import json
import os

import pytest
from pyspark.sql import functions as F

from pitchline import jobs
from pitchline.operators import stored
from pitchline.operators.merge import COALESCE, KEEP
from pitchline.sources import sample, writers

FOLDER = os.environ.get("PITCHLINE_TESTDATA", "/root/testdata/sf0.001")
SCHEMA = "k int, season string, v int, at int"


def files(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def table(spark, path):
    rows = stored.read_table(spark, path, "k int, season string, v int").collect()
    return sorted(((r.k, r.season, r.v) for r in rows), key=repr)


def test_updates_rewrite_only_the_partitions_they_touch(spark, tmp_path):
    path = str(tmp_path / "t")
    load = lambda rows, **kw: stored.upsert(spark.createDataFrame(rows, SCHEMA), path, ["k"], ["at"], "season", **kw)
    load([(1, "2014/2015", 1, 0), (2, "2014/2015", 2, 0), (3, "2015", 3, 0), (3, "2015", 33, 1), (4, "2016", 4, 0), (5, None, 5, 0)])
    assert table(spark, path) == [(1, "2014/2015", 1), (2, "2014/2015", 2), (3, "2015", 33), (4, "2016", 4), (5, None, 5)]
    before = files(path)
    updates = [(2, "2014/2015", 20, 1), (6, "2014/2015", 6, 1), (2, "2014/2015", 21, 2)]
    for _ in range(2):  # repeated: the same table
        assert load(updates) == ["2014/2015"]
        assert table(spark, path) == [(1, "2014/2015", 1), (2, "2014/2015", 21), (3, "2015", 33), (4, "2016", 4), (5, None, 5), (6, "2014/2015", 6)]
    assert {f for f in before if "2014" not in f} == {f for f in files(path) if "2014" not in f}
    # a key that changes its season leaves the old one; a season without rows goes
    assert load([(4, "2015", 44, 3), (5, "2015", 55, 3)]) == sorted(["2015", "2016", None], key=repr)
    assert table(spark, path) == [(1, "2014/2015", 1), (2, "2014/2015", 21), (3, "2015", 33), (4, "2015", 44), (5, "2015", 55), (6, "2014/2015", 6)]
    assert load([(1, "2014/2015", None, 1), (7, "2016", 7, 1)], mode=COALESCE) == ["2014/2015", "2016"]
    assert load([(1, "2014/2015", 9, 1)], mode=KEEP) == ["2014/2015"]
    assert [r for r in table(spark, path) if r[0] in (1, 7)] == [(1, "2014/2015", 1), (7, "2016", 7)]


def test_an_update_reads_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    stored.upsert(spark.range(100).selectExpr("CAST(id AS INT) AS k", "concat('s', id % 5) AS season", "1 AS v", "0 AS at"), path, ["k"], ["at"], "season")
    some = stored.read_table(spark, path, "k int, season string, v int").where(F.col("season").isin(["s1"]))
    assert "PartitionFilters: [isnotnull(season#" in some._jdf.queryExecution().executedPlan().toString()
    assert some.select(F.input_file_name()).distinct().count() == 1 < len(files(path))


def test_counts_while_writing(spark, tmp_path):
    layers = {"a": spark.range(10).toDF("x"), "b": spark.range(3).toDF("x")}
    got = sorted(map(tuple, jobs.write_layers(layers, str(tmp_path), F.col("x") > 1).collect()))
    assert got == [("a", 10, 8), ("b", 3, 1)] and spark.read.parquet(str(tmp_path / "b")).count() == 3


def test_sorted_tables_skip_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.rebuild_sorted(spark.range(0, 4000, 2).selectExpr("id AS match_id", "'2015' AS season_name", "id AS v"), path, "match_id", ["season_name"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    bounds = []
    for f in files(path):
        meta = pq.ParquetFile(os.path.join(path, f)).metadata
        bounds += [(c.statistics.min, c.statistics.max) for g in range(meta.num_row_groups) for c in [meta.row_group(g).column(0)]]
    bounds.sort()
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:])) and len(bounds) > 1
    plain = str(tmp_path / "plain")
    spark.read.parquet(path).repartition(len(bounds)).write.parquet(plain)
    size = lambda p: sum(os.path.getsize(os.path.join(p, f)) for f in files(p))
    assert size(path) > size(plain)  # the filters are there
    assert spark.read.parquet(path).where("match_id = 1000").count() == 1 and spark.read.parquet(path).where("match_id = 1001").count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_stored_features_answer_without_windows(spark):
    from pitchline.catalog.queries import REGISTRY

    df = REGISTRY["pregame_by_match"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "PushedFilters: [IsNotNull(match_id), EqualTo(match_id" in plan and df.count() == 1


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_layers_from_files(spark, tmp_path):
    """JSON and CSV files in, all layers out; a broken file is counted and left out."""
    raw, statistics, out = tmp_path / "raw", tmp_path / "stats", str(tmp_path / "out")
    for kind, rows in (("matches", sample.raw_matches(spark, FOLDER)), ("events", sample.raw_events(spark, FOLDER)), ("lineups", sample.raw_lineups(spark, FOLDER))):
        by_file = {}
        for r in rows.select("source_file", "payload").collect():
            by_file.setdefault(r.source_file.replace("\\", "/").split("/")[-1], []).append(json.loads(r.payload))
        (raw / kind).mkdir(parents=True)
        for name, items in by_file.items():
            (raw / kind / (name if name.endswith(".json") else f"{name}.json")).write_text(json.dumps(items))
    (raw / "events" / "broken.json").write_text('[{"id": 1}, {')
    statistics.mkdir()
    table = sample.player_stats(spark, FOLDER).drop("part_key").toPandas()
    table.to_csv(statistics / "players.csv", index=False)
    report = {r.layer: r.rows for r in jobs.build_from_files(spark, str(raw), str(statistics), out).collect()}
    matches = sample.matches(spark, FOLDER).count()
    assert report["rejected"] == 1 and report["silver_matches"] == report["pregame_features"] == matches
    assert report["inplay_features"] == 90 * matches and report["silver_events"] == sample.events(spark, FOLDER).count()
    want = jobs.pregame.build(sample.matches(spark, FOLDER), sample.events(spark, FOLDER), sample.lineup_players(spark, FOLDER), jobs.read(spark, out, "player_stats"))
    shown = ["match_id", "home_last5_points_avg", "away_last5_shots_avg", "home_matches_played_before"]
    key = lambda df: sorted(tuple(r) for r in df.select(*shown).fillna(-1.0).collect())
    assert key(jobs.read(spark, out, "pregame_features")) == key(want)


def test_small_files_are_not_broadcast_unmeasured(spark):
    """Files of a few MB can hold a million rows: no join of the plan may collect a side by its file size."""
    from pitchline.catalog.queries import REGISTRY

    for name in ("pregame_recent_shots", "pregame_distinct_players", "inplay_features"):
        plan = REGISTRY[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" not in plan, name
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 8


def test_updates_are_written_down_compressed(spark, tmp_path, monkeypatch):
    """Rows of an update that pass the shared folder take a small part of a checkpoint's room."""
    from pitchline import session

    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    rows = spark.range(20000).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, F.repeat(F.lit("payload "), 50)).alias("payload"), F.array("id").alias("a"))
    down = session.written_down(rows)
    assert down.schema.simpleString() == rows.schema.simpleString() and down.exceptAll(rows).isEmpty() and down.count() == 20000
    assert sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) < 1_000_000 < 20000 * 200
    assert session.written_down(rows.withColumn("none", F.lit(None))).count() == 20000


def test_updates_of_different_keys_move_no_whole_rows(spark, tmp_path, monkeypatch):
    """Without repeated keys nothing is grouped: a first load is written as it is, a later one meets the table by keys."""
    rows = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    plans, write = [], stored._write
    monkeypatch.setattr(stored, "_write", lambda df, *a: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write(df, *a)))
    for mode, one in ((stored.REPLACE, 11), (KEEP, 1)):
        path = str(tmp_path / mode)
        stored.upsert(rows((1, "a", 1, 0), (None, "a", 2, 0), (3, "b", 3, 0)), path, ["k"], ["at"], "season", mode)
        stored.upsert(rows((1, "a", 11, 1), (None, "a", 2, 1), (4, "c", 4, 1)), path, ["k"], ["at"], "season", mode)
        assert table(spark, path) == sorted([(1, "a", one), (None, "a", 2), (3, "b", 3), (4, "c", 4)], key=repr)
        assert all(".zstd." in f for f in files(path))
    assert len(plans) == 4 and not any("Aggregate" in p for p in plans)
    assert "Join" not in plans[0] and "LeftAnti" in plans[1]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_lineup_payloads_do_not_move_through_lookups(spark):
    from pitchline.plans import core
    from pitchline.session import sized_settings

    sized_settings(spark, FOLDER)
    m = sample.matches(spark, FOLDER)
    known = core.matches(m.filter("match_id % 2 = 0"))
    rows, rejects = core.lineups(None, sample.raw_lineups(spark, FOLDER), known, core.teams(m))
    assert "SortMergeJoin" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() > 0 and rows.join(known, "match_id", "left_anti").isEmpty()
    assert {r.reason for r in rejects.select("reason").distinct().collect()} == {"unknown match"}
