import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pitchline.plans import inplay, models, pregame, serve


def pregame_frame(spark, n=160):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        numbers = [rng.random() for _ in pregame.NUMERIC_FEATURES]
        lead = numbers[pregame.NUMERIC_FEATURES.index("home_last5_points_avg")]
        label = "H" if lead > 0.6 else "A" if lead < 0.3 else "D"
        for c in ("home_matches_played_before", "away_matches_played_before", "home_fbref_matched_players", "away_fbref_matched_players"):
            numbers[pregame.NUMERIC_FEATURES.index(c)] = 9.0
        numbers[pregame.NUMERIC_FEATURES.index("home_lineup_xg_sum")] = None if i % 5 == 0 else 1.0
        season = f"{2013 + i * 3 // n}/{2014 + i * 3 // n}"
        rows.append((i, dt.date(2013, 1, 1) + dt.timedelta(days=i * 6), rng.choice(["L1", "O'L"]), season, label, *numbers))
    schema = "match_id long, match_date date, competition_name string, season_name string, target_result string, "
    return spark.createDataFrame(rows, schema + ", ".join(f"{c} double" for c in pregame.NUMERIC_FEATURES))


def test_forest_trains_scores_and_survives_saving(spark, tmp_path):
    frame = pregame_frame(spark)
    model, splits = models.train_forest(frame, models.ForestSettings(trees=15, depth=5))
    assert {r.split: r["count"] for r in splits.groupBy("split").count().collect()} == {"train": 112, "valid": 24, "test": 24}
    scored = models.score_forest(model, splits)
    assert scored.filter("abs(p_A + p_D + p_H - 1) > 1e-9").isEmpty()
    metrics = models.evaluate_forest(model, splits)
    assert {r.split for r in metrics.collect()} == {"valid", "test"}
    assert min(r.accuracy for r in metrics.collect()) > 0.5
    models.save_forest(model, metrics, str(tmp_path / "m"))
    again = models.score_forest(models.load_forest(str(tmp_path / "m")), splits)
    assert again.drop("probabilities").exceptAll(scored.drop("probabilities")).isEmpty()
    top = models.top_importances(model, 5).collect()
    assert top[0].feature == "home_last5_points_avg" and len(top) == 5
    unseen = frame.limit(3).withColumn("competition_name", F.lit("never seen"))
    assert models.score_forest(model, unseen).count() == 3
    with pytest.raises(ValueError):
        models.score_forest(model, frame.drop("home_last5_points_avg"))
    lacking = models.score_forest(model, frame.drop("diff_days_rest", "diff_home_strength"))
    assert lacking.count() == 160
    odds = serve.with_odds(scored).first()
    assert odds.odd_H == pytest.approx(1 / odds.p_H) if odds.p_H else odds.odd_text_H == "-"


def test_training_filters(spark):
    frame = pregame_frame(spark, 20)
    with pytest.raises(ValueError):
        models.training_rows(frame.withColumn("home_matches_played_before", F.lit(4.0)))
    with pytest.raises(ValueError):
        models.training_rows(frame.drop("away_last5_shots_avg"))


def test_walk_forward_trains_on_earlier_seasons(spark):
    settings = models.ForestSettings(trees=5, depth=3)
    runs = models.walk_forward(pregame_frame(spark), settings)
    assert [(s, league, reason) for s, league, _, reason in runs] == [("2014/2015", None, None), ("2015/2016", None, None)]
    leagues = models.walk_forward(pregame_frame(spark), settings, per_league=True)
    assert {(league, season) for season, league, _, _ in leagues} == {(x, s) for x in ("L1", "O'L") for s in ("2014/2015", "2015/2016")}


def test_walk_forward_says_why_there_is_no_fit(spark):
    frame = pregame_frame(spark)
    late = frame.where("competition_name = 'L1' OR season_name = '2015/2016'")  # the other league has no earlier season
    rows = {(r.competition_name, r.season_name): r for r in models.walk_forward_scores(late, models.ForestSettings(trees=3, depth=2), per_league=True).collect()}
    assert rows["O'L", "2015/2016"].reason == "fewer than two results in earlier seasons" and rows["O'L", "2015/2016"].rows == 0
    assert rows["O'L", "2014/2015"].reason and rows["L1", "2015/2016"].reason is None and rows["L1", "2015/2016"].rows > 0
    assert 0 <= rows["L1", "2015/2016"].accuracy <= 1 and len(rows) == 4


def test_boosting_and_calibration(spark):
    rng = random.Random(4)
    rows = []
    for m in range(40):
        lead = rng.choice([-1.0, 0.0, 1.0])
        for minute in (10, 50, 90):
            values = [float(minute) if c == "minute" else lead if c == "goal_diff_now" else rng.random() for c in inplay.FEATURES]
            rows.append((m, dt.date(2016, 1, 1) + dt.timedelta(days=m), "H" if lead > 0 else "A" if lead < 0 else "D", *values))
    schema = "match_id long, match_date date, target_result_final string, " + ", ".join(f"{c} double" for c in inplay.FEATURES)
    frame = spark.createDataFrame(rows, schema)
    settings = models.BoostSettings(rounds=3, depth=2, rate=0.3)
    model, splits, results = models.train_inplay(frame, settings)
    assert {r.split: r.accuracy for r in results.collect()}["test"] > 0.8
    assert model.importances(inplay.FEATURES).first().feature == "goal_diff_now"
    fitted = models.Calibrated.fit(splits.filter("split = 'train'"), ["sigmoid", "isotonic"], settings)
    for calibrated in fitted.values():
        out = calibrated.transform(splits)
        assert out.filter("abs(p_A + p_D + p_H - 1) > 1e-9 OR least(p_A, p_D, p_H) < 0").isEmpty()
    with pytest.raises(ValueError):
        models.inplay_rows(frame.withColumn("target_result_final", F.lit("Z")), inplay.FEATURES)
    with pytest.raises(ValueError):
        models.inplay_rows(frame.withColumn("minute", F.lit(None).cast("double")), inplay.FEATURES)


def test_coupons(spark):
    offers = spark.createDataFrame([(1, "H", 0.6, 2.0), (1, "A", 0.2, 9.0), (2, "H", 0.5, 2.0), (3, "D", 0.4, 2.0), (4, "H", 0.9, 5.0)],
                                   "match_id long, outcome string, model_probability double, market_odd double")
    requests = spark.createDataFrame([("u", "low", 2, [1, 2, 3]), ("v", "high", 2, [1, 2, 3]), ("w", "medium", 9, [1, 2, 3])],
                                     "user_id string, target_risk string, max_selections int, match_ids array<long>")
    picks = serve.coupon_picks(requests, offers)
    got = {(r.user_id, r.position): (r.match_id, r.outcome) for r in picks.collect()}
    assert got == {("u", 1): (1, "H"), ("v", 1): (1, "A"), ("v", 2): (2, "H"), ("w", 1): (1, "H"), ("w", 2): (2, "H"), ("w", 3): (3, "D")}
    assert {r.user_id: (r.selections, r.total_odd) for r in serve.coupons(picks).collect()} == {"u": (1, 2.0), "v": (2, 18.0), "w": (3, 8.0)}


def test_insights(spark):
    rows = [(1, "h", "a", 0.6, -0.31, 0.41, 0.5, 0.3), (2, "h", "a", 0.5, None, 0.1, 0.2, 0.5)]
    schema = "match_id long, home_team_name string, away_team_name string, diff_points_avg double, diff_goal_diff_avg double, diff_shots_on_target_avg double, home_last5_win_rate double, away_last5_win_rate double"
    out = {(r.match_id, r.position): r.insight for r in serve.insights(spark.createDataFrame(rows, schema)).collect()}
    assert len(out) == 6 and out[1, 0].startswith("h ") and out[1, 1].startswith("a ") and out[2, 0].startswith("A forma") and out[2, 1].startswith("a tem")
