import json

import pytest
from pyspark.sql import functions as F

from pitchline.sources import player_stats, readers, writers


def test_player_stats_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Player,Squad,Age,xG,Save%\nJosé  María,"Real, Club",21.0,0.5,\n ,X,1,1,1\n', encoding="utf-8")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.CSV").write_text("player , TEAM,Season,Min\nBob,,2015/2016,abc\n", encoding="utf-8")
    (tmp_path / "sub" / "c.csv").write_text("Squad,Age\nNobody,3\n", encoding="utf-8")
    rows = {r.player_name: r for r in player_stats.read_player_stats(spark, str(tmp_path)).collect()}
    assert set(rows) == {"José  María", "Bob"}
    a, b = rows["José  María"], rows["Bob"]
    assert (a.season_name, a.squad_name, a.normalized_squad_name, a.normalized_player_name) == ("2025/2026", "Real, Club", "real club", "jose maria")
    assert (a.age, a.xg, a.save_pct, a.source_file) == (21, 0.5, None, "a.csv")
    assert json.loads(a.raw_payload)["Save%"] is None
    assert (b.season_name, b.squad_name, b.normalized_squad_name, b.minutes_played, b.source_file) == ("2015/2016", None, None, None, "b.CSV")


def test_missing_files_are_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        player_stats.read_player_stats(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        readers.list_files(spark, str(tmp_path), "json").collect()


def test_file_listing(spark, tmp_path):
    for name in ("b.JSON", "a.json", "x.txt"):
        (tmp_path / name).write_text("{}")
    found = [r.path.rsplit("/", 1)[-1] for r in readers.list_files(spark, str(tmp_path), "json").collect()]
    assert found == ["a.json", "b.JSON"]


def test_json_files(spark, tmp_path):
    (tmp_path / "list.json").write_text('[{"a": 1}, {"a": 2}]')
    (tmp_path / "one.json").write_text('{"a": {"b": 1, "c": {"d": 2}}, "e": 3}')
    (tmp_path / "text.json").write_text('"x"')
    assert sorted(r.a for r in readers.read_json(spark, str(tmp_path / "list.json")).collect()) == [1, 2]
    one = readers.read_json(spark, str(tmp_path / "one.json"))
    assert one.columns == ["a.b", "a.c.d", "e"] and tuple(one.first()) == (1, 2, 3)
    with pytest.raises(ValueError):
        readers.read_json(spark, str(tmp_path / "text.json"))
    with pytest.raises(ValueError):
        readers.read_json(spark, str(tmp_path / "x.xml"))


def test_raw_rows_are_routed_by_folder(spark, tmp_path):
    bodies = {
        "matches/2": '[{"match_id": 5}]', "events": '\ufeff[\n  {"id": "a",\n   "z": 1, "b": 21.0},\n  {"id": "b"}\n]\n',
        "junk": " {}\n", "lineups": '[{"a": 1},', "players": '"text"', "events/empty": "[]",
    }
    for folder, body in bodies.items():
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / "77.json").write_text(body, encoding="utf-8")
    rows, rejects = readers.read_raw(spark, str(tmp_path), "set")
    got = sorted((r.target_table or "", r.source_match_id, r.row_in_file, r.payload, r.source_dataset) for r in rows.collect())
    assert got == [
        ("", "77", 0, "{}", "set"), ("raw_events", "77", 0, '{"id":"a","z":1,"b":21.0}', "set"), ("raw_events", "77", 1, '{"id":"b"}', "set"),
        ("raw_matches", "77", 0, '{"match_id":5}', "set"),
    ]
    assert sorted(r.source_file.split("/")[-2] for r in rejects.collect()) == ["lineups", "players"]
    assert rows.select("raw_id").distinct().count() == 4 and rows.filter("loaded_at IS NULL").isEmpty()
    events = readers.raw_table(rows, "raw_events")
    assert events.columns == ["raw_event_id", "source_dataset", "source_file", "source_match_id", "payload", "loaded_at"] and events.count() == 2


ARRAYS = {
    "events/1": [{"id": i, "t": 'a}{"b\\\\' * (i % 4), "n": {"k": [1, {"z": "]"}]}} for i in range(400)],
    "events/2": [1, "x}", {"a": {}}, [2, {"b": 3}], None, True, {"c": "{["}, 5.5], "matches/3": [], "lineups/4": [{"a": 1}], "events/5": ["no objects", 2],
}
BROKEN = {
    "events/b1": '[{"a": 1}, {"b"', "events/b2": '[{"a": 1} {"b": 2}]', "events/b3": '[{"a": 1},]', "events/b4": '[{"a": 1}] x', "events/b5": '{"a": 1}',
    "events/b6": '[{"a": 1}, {"b": "x}', "events/b7": '"text"', "events/b8": '[{"a": 1}}]', "events/b9": '[,{"a": 1}]',
}


def test_large_arrays_are_split_and_give_the_same_rows(spark, tmp_path):
    for name, value in ARRAYS.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / f"{name}.json").write_text("\ufeff \n" * (name == "events/2") + json.dumps(value, indent=1 if "1" in name else None, ensure_ascii=False) + "\n", encoding="utf-8")
    for name, text in BROKEN.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        rows, rejects = readers.read_raw(spark, str(tmp_path), "set", split_bytes=0)
        get = lambda df: sorted((r.source_file, r.row_in_file, r.payload, r.raw_id, r.target_table) for r in df.collect())
        whole, lost = readers.read_raw(spark, str(tmp_path), "set")
        assert get(rows) == get(whole) and rows.count() == sum(map(len, ARRAYS.values())) + 1
        found = readers.blocks.pieces(spark, str(tmp_path / "events"), "1.json", "}")
        assert found.select(F.spark_partition_id()).distinct().count() > 5
        names = lambda df: sorted(r.source_file.split("/")[-1] for r in df.collect())
        assert names(rejects) == names(lost) == sorted(f"{n.split('/')[1]}.json" for n in BROKEN if n != "events/b5")
        kept, faults = readers.large_rows(spark, str(tmp_path), "set", F.current_timestamp(), 0, keep_complete=True)
        assert [r.payload for r in kept.where("source_file LIKE '%b1.json'").collect()] == ['{"a":1}'] and faults.count() == len(BROKEN) - 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_json_over_several_lines(spark, tmp_path):
    (tmp_path / "list.json").write_text('\n[\n {"a": 1},\n {"a":\n 2}\n]\n')
    (tmp_path / "one.json").write_text('{\n"a": {\n"b": 1}}')
    assert sorted(r.a for r in readers.read_json(spark, str(tmp_path / "list.json")).collect()) == [1, 2]
    assert readers.read_json(spark, str(tmp_path / "one.json")).columns == ["a.b"]


def test_csv_rows_are_read_once(spark, tmp_path):
    body = "Player,Squad,Age\n" + "".join(f"P{i},S,{i}\n" for i in range(4))
    (tmp_path / "a.csv").write_text(body)
    (tmp_path / "b.csv").write_text(body + "NA,S,1\n\t,S,1\n\u00a0,S,1\nP9,N/A,null\n", encoding="utf-8")
    rows = player_stats.read_player_stats(spark, str(tmp_path)).collect()
    assert sorted((r.source_file, r.player_name, r.age) for r in rows if r.player_name != "P9") == sorted((f, f"P{i}", i) for f in ("a.csv", "b.csv") for i in range(4))
    assert [(r.squad_name, r.age) for r in rows if r.player_name == "P9"] == [(None, None)] and len(rows) == 9


def test_csv_cells_over_several_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Player,Squad,Age\n"A\nB","S, ""x""",3\nC,S,4\n')
    (tmp_path / "b.csv").write_text("Squad,Player\nT,D\n")
    rows = player_stats.read_player_stats(spark, str(tmp_path), multi_line=True).collect()
    assert sorted((r.player_name, r.squad_name, r.age) for r in rows) == [("A\nB", 'S, "x"', 3), ("C", "S", 4), ("D", "T", None)]
    assert sorted(r.Player for r in readers.read_csv(spark, str(tmp_path / "a.csv"), multi_line=True).collect()) == ["A\nB", "C"]


def test_quoted_line_breaks_across_splits(spark, tmp_path):
    cell = lambda i: f'"P{i}\n""{i}"", x\n\n"' if i % 3 else f"P{i}"
    (tmp_path / "a.csv").write_text("Player,Squad,Age\n" + "".join(f"{cell(i)},S,{i}\n" for i in range(900)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        rows = player_stats.read_player_stats(spark, str(tmp_path), multi_line=True).collect()
        assert readers.blocks.pieces(spark, str(tmp_path), "*.csv").select("block").distinct().count() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.age, r.player_name) for r in rows) == [(i, f'P{i}\n"{i}", x\n\n' if i % 3 else f"P{i}") for i in range(900)]


@pytest.mark.parametrize("count", [3, 30])
def test_layouts_share_one_scan(spark, tmp_path, count):
    for k in range(count):
        extra = [f"x{j}" for j in range(k)]
        names = ["Squad", "Player", "Age", *extra]
        names = names[k % 3:] + names[: k % 3]
        cells = {"Squad": f"S{k}", "Player": f"P{k}", "Age": str(k), **{e: "v" for e in extra}}
        body = ",".join(names) + "\n" + ",".join(cells[n] for n in names) + "\n" + (",".join(names) + "\n" if k == 1 else "")
        (tmp_path / f"{k}.csv").write_text(body)
    df = player_stats.read_player_stats(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan text") == 1
    rows = {r.source_file: r for r in df.where("player_name LIKE 'P%' AND age IS NOT NULL").collect()}
    assert len(rows) == count and all((r.player_name, r.squad_name, r.age) == (f"P{k}", f"S{k}", k) for k in range(count) for r in [rows[f"{k}.csv"]])
    assert json.loads(rows["2.csv"].raw_payload) == {"Squad": "S2", "Player": "P2", "Age": "2", "x0": "v", "x1": "v"}
    assert df.where("player_name = 'Player'").count() == 1  # a data line like the header is a row


def test_payload_keeps_nulls(spark):
    df = spark.sql("SELECT CAST('NaN' AS DOUBLE) AS x, CAST(NULL AS STRING) AS y, TIMESTAMP '2020-01-02 03:04:05' AS t, array(1D, CAST('NaN' AS DOUBLE)) AS l")
    assert json.loads(writers.to_payload(df).first().payload) == {"x": None, "y": None, "t": "2020-01-02T03:04:05", "l": [1.0, None]}


def test_writes(spark, tmp_path):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "season_name string, v int")
    path = str(tmp_path / "t")
    writers.rebuild(old, path, ["season_name"])
    writers.replace_seasons(spark.createDataFrame([("b", 3)], "season_name string, v int"), path)
    assert sorted((r.season_name, r.v) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 3)]
    plain = str(tmp_path / "u")
    writers.append(old, plain)
    writers.append(old, plain)
    assert spark.read.parquet(plain).count() == 4


def test_csv_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "match_id long, name string")
    assert writers.export_csv(df, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).columns == ["match_id", "name"]
    with pytest.warns(UserWarning):
        assert not writers.export_csv(df.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
