"""Football frames derived from the star-schema test tables.

customer -> matches, supplier -> teams, orders x lineitem -> match events and lineups,
part -> players and their season statistics. Every frame grows with its tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DATASET = "star"
SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
    "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp",
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def team_count(spark: SparkSession, folder: str) -> int:
    return table(spark, folder, "supplier").count()


def _home(match: str, teams: int) -> str:
    return f"(({match} * 7 + {match} DIV 10) % {teams})"


def _away(match: str, teams: int) -> str:
    return f"(({_home(match, teams)} + 1 + {match} % {teams - 1}) % {teams})"


def _team_name(column: str) -> str:
    return f"concat('Supplier#', lpad(CAST({column} AS STRING), 9, '0'))"


def matches(spark: SparkSession, folder: str) -> DataFrame:
    """Silver matches (without provenance columns)."""
    n = team_count(spark, folder)
    keyed = table(spark, folder, "customer").selectExpr(
        "c_custkey AS match_id",
        "ascii(c_mktsegment) AS competition_id",
        "c_mktsegment AS competition_name",
        "date_add(DATE '2014-08-01', CAST(c_custkey * 11 % 1000 AS INT)) AS match_date",
        "concat(CAST(c_custkey % 10 + 12 AS STRING), ':00:00.000') AS kick_off",
        f"{_home('c_custkey', n)} AS home_team_id",
        f"{_away('c_custkey', n)} AS away_team_id",
        "CASE WHEN c_acctbal >= -900 THEN CAST((c_custkey * 7 + c_nationkey * 3) % 5 AS INT) END AS home_score",
        "CAST((c_custkey * 5 + c_nationkey) % 4 AS INT) AS away_score",
        "CASE WHEN c_custkey % 17 <> 0 THEN CAST(c_nationkey AS LONG) END AS referee_id",
    )
    dated = keyed.selectExpr("*", "year(match_date) - CASE WHEN month(match_date) < 8 THEN 1 ELSE 0 END AS first_year")
    return dated.selectExpr(
        "match_id",
        "competition_id",
        "competition_name",
        "first_year - 1990 AS season_id",
        "concat_ws('/', first_year, first_year + 1) AS season_name",
        "match_date",
        "kick_off",
        "home_team_id",
        f"{_team_name('home_team_id')} AS home_team_name",
        "away_team_id",
        f"{_team_name('away_team_id')} AS away_team_name",
        "home_score",
        "away_score",
        "CASE WHEN home_score > away_score THEN 'H' WHEN home_score < away_score THEN 'A' ELSE 'D' END AS match_result",
        "home_team_id AS stadium_id",
        "concat('Stadium ', home_team_id) AS stadium_name",
        "referee_id",
        "concat('Referee ', referee_id) AS referee_name",
    )


def events(spark: SparkSession, folder: str, names: bool = False) -> DataFrame:
    """Silver events with parsed sub-objects; one row per line item. Player names join the narrow rows, where wanted."""
    n = team_count(spark, folder)
    orders = table(spark, folder, "orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey AS match_id")
    rows = table(spark, folder, "lineitem").join(orders, "l_orderkey")
    if names:
        rows = rows.join(_players(spark, folder).withColumnRenamed("player_id", "l_partkey"), "l_partkey", "left")
    kinded = rows.selectExpr(
        "*",
        "CASE WHEN l_quantity <> 1 THEN CAST((l_partkey * 13 + l_suppkey * 7 + l_linenumber * 11) % 96 AS INT) END AS minute",
        f"""CASE WHEN l_linenumber <> 7 OR l_quantity < 48
            THEN CASE WHEN l_partkey % 2 = 0 THEN {_home('match_id', n)} ELSE {_away('match_id', n)} END END AS team_id""",
        """CASE WHEN l_linenumber <= 2 THEN 'Shot' WHEN l_linenumber <= 4 THEN 'Pass' WHEN l_linenumber = 5 THEN 'Foul Committed'
            WHEN l_linenumber = 6 THEN 'Card'
            ELSE element_at(array('Pressure', 'Interception', 'Clearance', 'Block', 'Duel', 'Dribble', 'Carry'), CAST(l_suppkey % 7 + 1 AS INT))
            END AS event_type_name""",
        "CAST(l_partkey * 3 % 120 AS DOUBLE) AS x",
        "CAST(l_suppkey * 7 % 80 AS DOUBLE) AS y",
    )
    return kinded.selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS LONG)) AS event_id",
        "match_id",
        "l_linenumber AS event_index",
        "CASE WHEN minute > 45 THEN 2 ELSE 1 END AS period",
        "minute",
        "CAST(l_partkey * 17 % 60 AS INT) AS second",
        "team_id",
        f"{_team_name('team_id')} AS team_name",
        "l_partkey AS player_id",
        "event_type_name",
        """CASE WHEN event_type_name = 'Shot' THEN CASE l_returnflag WHEN 'R' THEN 'Goal'
            WHEN 'A' THEN CASE WHEN l_linestatus = 'F' THEN 'Saved To Post' ELSE 'Saved' END ELSE 'Off T' END END AS shot_outcome""",
        "CASE WHEN event_type_name = 'Shot' AND l_discount > 0 THEN CAST(l_discount AS DECIMAL(18, 6)) END AS shot_xg",
        "CASE WHEN event_type_name = 'Card' THEN CASE WHEN l_linestatus = 'F' THEN 'Red Card' ELSE 'Yellow Card' END END AS card",
        "CASE WHEN event_type_name = 'Pass' AND l_returnflag = 'N' THEN 'Incomplete' END AS pass_outcome",
        "event_type_name = 'Pass' AND l_returnflag = 'R' AS pass_goal_assist",
        "event_type_name = 'Pass' AND l_returnflag = 'A' AS pass_shot_assist",
        "CASE WHEN event_type_name = 'Pass' AND l_linestatus = 'F' THEN 'Corner' END AS pass_type",
        "CASE WHEN event_type_name = 'Duel' THEN CASE WHEN l_linestatus = 'F' THEN 'Tackle' ELSE 'Aerial Lost' END END AS duel_type",
        "CASE WHEN event_type_name = 'Dribble' THEN CASE WHEN l_linestatus = 'F' THEN 'Complete' ELSE 'Incomplete' END END AS dribble_outcome",
        "event_type_name = 'Clearance' AND l_returnflag = 'A' AS aerial_won",
        "CASE WHEN l_linenumber = 5 THEN array(x) WHEN l_linenumber <> 6 THEN array(x, y) END AS location",
        "CASE WHEN event_type_name IN ('Pass', 'Carry') THEN array(x + l_linenumber * 4, y + 3) END AS end_location",
        "l_tax > 0.05 AS under_pressure",
        "l_orderkey AS order_key",
        *(["player_name"] if names else []),
    )


def _players(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    """Players with the name the lineups spell."""
    return table(spark, folder, "part").selectExpr("p_partkey AS player_id", "concat_ws(' ', p_name, p_type) AS player_name", *extra)


def lineup_players(spark: SparkSession, folder: str) -> DataFrame:
    """Silver lineup players: who took part for which side of a match."""
    seen = events(spark, folder).filter("team_id IS NOT NULL").select("match_id", "team_id", "player_id").distinct()
    seen = seen.selectExpr("match_id", "team_id", f"{_team_name('team_id')} AS team_name", "player_id")
    details = _players(
        spark, folder,
        "p_size % 30 + 1 AS jersey_number",
        "CASE WHEN p_size <= 5 THEN 'GK' ELSE p_type END AS position_name",
        "p_size AS from_minute",
    )
    return seen.join(details, "player_id")


def player_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Player statistics as a file would hold them: text cells, accents, stray blanks, blank names."""
    return table(spark, folder, "part").selectExpr(
        "CASE WHEN p_size % 3 = 0 THEN '2015/2016' END AS Season",
        "p_type AS Comp",
        "CASE WHEN p_size <> 50 THEN p_brand END AS Squad",
        """CASE WHEN p_size <> 49 THEN concat(' ', CASE WHEN p_size % 2 = 1 THEN replace(p_name, 'o', 'ó') ELSE p_name END, '  ', p_type)
            ELSE '  ' END AS Player""",
        "CASE WHEN p_size <= 5 THEN 'GK' ELSE 'DF,MF' END AS ` pos `",
        "CASE WHEN p_size % 7 = 0 THEN 'abc' ELSE CAST(p_size + 15 AS STRING) END AS Age",
        "CAST(p_size * 10 AS STRING) AS Min",
        "CAST(p_size % 20 + 0.7D AS STRING) AS Starts",
        "CASE WHEN p_size % 11 = 0 THEN 'nan' ELSE CAST(p_partkey % 9 AS STRING) END AS Gls",
        "CAST(p_partkey % 7 AS STRING) AS Ast",
        "CAST(CAST(round(p_retailprice) AS LONG) % 100 / 4 AS STRING) AS xG",
        "CAST(CAST(round(p_retailprice) AS LONG) % 60 / 4 AS STRING) AS xAG",
        "CAST(p_size * 3 AS STRING) AS Sh",
        "CAST(p_size * 2 AS STRING) AS SoT",
        "CAST(p_partkey % 13 AS STRING) AS Tkl",
        "CAST(p_partkey % 11 AS STRING) AS Int",
        "CASE WHEN p_size % 5 <> 0 THEN CAST(p_partkey % 5 AS STRING) END AS Blocks",
        "CASE WHEN p_size <= 5 THEN CAST(p_size * 15 AS STRING) END AS `Save%`",
        "p_partkey AS part_key",
    )


def _payload(value: str) -> str:
    """JSON text as an opaque column, the way a stored raw table hands it to the parser.

    Without the explode the planner would see through to_json and from_json at once and spend
    its time on relations between their fields.
    """
    return f"explode(array(to_json({value}))) AS payload"


def raw_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Matches as nested JSON payloads with provenance."""
    return matches(spark, folder).selectExpr(
        "match_id AS raw_match_id",
        f"'{DATASET}' AS source_dataset",
        "concat('data/matches/', competition_id, '/', season_id, '.json') AS source_file",
        _payload(
            """named_struct('match_id', match_id, 'match_date', date_format(match_date, 'yyyy-MM-dd'), 'kick_off', kick_off,
            'home_score', home_score, 'away_score', away_score,
            'competition', struct(competition_id, competition_name), 'season', struct(season_id, season_name),
            'home_team', struct(home_team_id, home_team_name), 'away_team', struct(away_team_id, away_team_name),
            'stadium', named_struct('id', stadium_id, 'name', stadium_name),
            'referee', CASE WHEN referee_id IS NOT NULL THEN named_struct('id', referee_id, 'name', referee_name) END,
            'metadata', named_struct('data_version', '1.1.0', 'shot_fidelity_version', ''))"""
        ),
    )


def _match_file(kind: str) -> str:
    """Windows path for every third match, POSIX for the rest."""
    return f"""concat(CASE WHEN match_id % 3 = 0 THEN 'C:\\\\data\\\\{kind}\\\\' ELSE '/data/{kind}/' END, match_id, '.json') AS source_file"""


def event_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of the matches with events, which hold those of the lineups, without payloads."""
    return events(spark, folder).select("match_id").distinct().selectExpr(_match_file("events"))


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON payloads; the match id is only in the file name."""
    team = "CASE WHEN team_id IS NOT NULL THEN named_struct('id', team_id, 'name', team_name) END"
    of = lambda kind, value: f"CASE WHEN event_type_name = '{kind}' THEN named_struct({value}) END"
    return events(spark, folder, names=True).selectExpr(
        "order_key * 8 + event_index AS raw_event_id",
        f"'{DATASET}' AS source_dataset",
        _match_file("events"),
        _payload(
            f"""named_struct('id', event_id, 'index', event_index, 'period', period,
            'timestamp', concat('00:', lpad(CAST(coalesce(minute, 0) AS STRING), 2, '0'), ':', lpad(CAST(second AS STRING), 2, '0'), '.000'),
            'minute', minute, 'second', second, 'possession', event_index, 'team', {team}, 'possession_team', {team},
            'player', named_struct('id', player_id, 'name', player_name),
            'position', CASE WHEN player_id % 4 <> 0 THEN named_struct('id', player_id % 25 + 1, 'name', concat('Position ', player_id % 25 + 1)) END,
            'off_camera', CASE WHEN player_id % 13 = 0 THEN true END, 'out', CASE WHEN player_id % 17 = 0 THEN true END,
            'type', named_struct('id', length(event_type_name) + 10, 'name', event_type_name),
            'play_pattern', named_struct('id', 1, 'name', 'Regular Play'), 'duration', second / 8,
            'under_pressure', CASE WHEN under_pressure THEN true END, 'location', location,
            'pass', {of('Pass', '''
                'end_location', end_location, 'goal_assist', CASE WHEN pass_goal_assist THEN true END,
                'shot_assist', CASE WHEN pass_shot_assist THEN true END,
                'outcome', CASE WHEN pass_outcome IS NOT NULL THEN named_struct('name', pass_outcome) END,
                'type', CASE WHEN pass_type IS NOT NULL THEN named_struct('name', pass_type) END''')},
            'shot', {of('Shot', "'statsbomb_xg', shot_xg, 'outcome', named_struct('name', shot_outcome)")},
            'bad_behaviour', {of('Card', "'card', named_struct('name', card)")},
            'duel', {of('Duel', "'type', named_struct('name', duel_type)")},
            'dribble', {of('Dribble', "'outcome', named_struct('name', dribble_outcome)")},
            'carry', {of('Carry', "'end_location', end_location")},
            'interception', {of('Interception', "'outcome', named_struct('id', 4, 'name', 'Won')")},
            'goalkeeper', {of('Block', "'type', named_struct('id', player_id % 9, 'name', 'Save')")},
            'tactics', {of('Pressure', "'formation', 442, 'lineup', array(named_struct('jersey_number', event_index))")},
            'clearance', {of('Clearance', "'aerial_won', CASE WHEN aerial_won THEN true END")})"""
        ),
    )


def raw_lineups(spark: SparkSession, folder: str) -> DataFrame:
    """Lineup payloads: one player per payload, an empty list for every eleventh player."""
    position = """named_struct('position', position_name,
        'from', CASE WHEN from_minute % 4 = 0 THEN '00:00' ELSE CAST(from_minute AS STRING) END,
        'to', CASE WHEN from_minute % 5 <> 0 THEN '90' END,
        'start_reason', CASE WHEN from_minute % 6 = 0 THEN '' ELSE 'Starting XI' END)"""
    player = f"""named_struct('player_id', player_id, 'player_name', player_name,
        'player_nickname', CASE WHEN player_id % 2 = 0 THEN '' ELSE player_name END, 'jersey_number', jersey_number,
        'country', named_struct('id', jersey_number, 'name', concat('Country ', jersey_number)),
        'positions', filter(array({position}), p -> player_id % 9 <> 0),
        'cards', CASE WHEN player_id % 6 = 0 THEN array(named_struct('time', '45:00', 'card_type', 'Yellow Card')) END)"""
    return lineup_players(spark, folder).selectExpr(
        "match_id * 16777216 + player_id AS raw_lineup_id",
        f"'{DATASET}' AS source_dataset",
        _match_file("lineups"),
        _payload(f"named_struct('team_id', team_id, 'team_name', team_name, 'lineup', filter(array({player}), p -> player_id % 11 <> 0))"),
    )
