"""Training, scoring, calibration and persistence of the result models with pyspark.ml."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.functions.labels import PREGAME_CODES, result_code
from pitchline.operators.checks import require_columns, require_domain, require_no_nulls, require_rows
from pitchline.operators.isotonic import IsotonicFit
from pitchline.operators.metrics import scores
from pitchline.operators.ordering import exact_medians, split_by_match, split_by_rows
from pitchline.plans.inplay import DERIVED, FEATURES
from pitchline.plans.pregame import CATEGORICAL_FEATURES, DERIVED_DIFFS, NUMERIC_FEATURES, add_derived, enough_history
from pitchline.session import written_down

CLASSES = ["A", "D", "H"]
LABEL = "target_result"
INPLAY_LABEL = "target_result_final"
SPLITS = ["train", "valid", "test"]


# The settings of the models.


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 500
    depth: int = 10
    min_leaf: int = 4
    seed: int = 42


@dataclass(frozen=True)
class BoostSettings:
    rounds: int = 300
    depth: int = 6
    rate: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    seed: int = 42


CALIBRATION_BOOST = BoostSettings(rounds=200, depth=4, rate=0.03)


# ---------------------------------------------------------------- pre-game forest


def training_rows(features: DataFrame) -> DataFrame:
    """Checked training rows: known result, enough history, derived differences present."""
    derived = {*DERIVED_DIFFS, "diff_home_strength", "diff_lineup_defense"}
    require_columns(features, [LABEL, "match_date", "match_id", *CATEGORICAL_FEATURES])
    require_columns(features, [c for c in NUMERIC_FEATURES if c not in derived])
    # many passes follow (checks, split points, medians, trees): they read this table, not its inputs
    rows = written_down(add_derived(enough_history(features)).filter(F.col(LABEL).isNotNull()))
    require_rows(rows, "after the filters for history and statistics coverage")
    return rows


def class_weights(train: DataFrame, label: str = LABEL) -> dict[str, float]:
    """n / (classes * n_class): every class weighs the same."""
    counts = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}  # at most three rows
    return {c: sum(counts.values()) / (len(counts) * n) for c, n in counts.items()}


def _imputer(medians: dict[str, float | None], modes: dict[str, str | None]) -> SQLTransformer:
    """Medians and modes as literals of a SQL stage, so that a saved pipeline imputes by itself."""
    fills = [f"coalesce(CAST(`{c}` AS DOUBLE), {0.0 if m is None else repr(m)}D) AS `{c}_filled`" for c, m in medians.items()]
    quoted = {c: "NULL" if m is None else "'" + m.replace("\\", "\\\\").replace("'", "\\'") + "'" for c, m in modes.items()}
    fills += [f"coalesce(`{c}`, {m}) AS `{c}_filled`" for c, m in quoted.items()]
    return SQLTransformer(statement=f"SELECT *, {', '.join(fills)} FROM __THIS__")


def modes_of(df: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """Most frequent value, the smallest of equally frequent ones."""
    out = {}
    for c in columns:
        top = df.filter(F.col(c).isNotNull()).groupBy(c).count().orderBy(F.desc("count"), c).first()
        out[c] = top[c] if top else None
    return out


def fit_forest(train: DataFrame, settings: ForestSettings = ForestSettings()) -> PipelineModel:
    """Impute, one-hot encode (unknown competitions are all zeros), balanced random forest."""
    weights = class_weights(train)
    weight = reduce(lambda acc, kv: F.when(F.col(LABEL) == kv[0], F.lit(kv[1])).otherwise(acc), weights.items(), F.lit(1.0))
    labelled = train.withColumn("label_code", result_code(F.col(LABEL), PREGAME_CODES).cast("double")).withColumn("class_weight", weight)
    category = CATEGORICAL_FEATURES[0]
    stages = [
        _imputer(exact_medians(train, NUMERIC_FEATURES), modes_of(train, CATEGORICAL_FEATURES)),
        StringIndexer(inputCol=f"{category}_filled", outputCol=f"{category}_index", handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol=f"{category}_index", outputCol=f"{category}_onehot", dropLast=True),
        VectorAssembler(inputCols=[*[f"{c}_filled" for c in NUMERIC_FEATURES], f"{category}_onehot"], outputCol="features"),
        RandomForestClassifier(
            labelCol="label_code", weightCol="class_weight", numTrees=settings.trees, maxDepth=settings.depth,
            minInstancesPerNode=settings.min_leaf, seed=settings.seed, featureSubsetStrategy="sqrt",
        ),
    ]
    return Pipeline(stages=stages).fit(labelled)


def score_forest(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Prediction, p_A, p_D, p_H and the probability map for every row.

    Missing features are an error; the rest and home-strength differences are made when absent,
    with NULL as 0.
    """
    gap = lambda a, b: F.coalesce(F.col(a).try_cast("double"), F.lit(0.0)) - F.coalesce(F.col(b).try_cast("double"), F.lit(0.0))
    if "diff_days_rest" not in features.columns:
        features = features.withColumn("diff_days_rest", gap("home_days_since_last_match", "away_days_since_last_match"))
    if "diff_home_strength" not in features.columns:
        features = features.withColumn("diff_home_strength", gap("home_home_last5_points_avg", "away_away_last5_points_avg"))
    require_columns(features, [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES])
    keep = [c for c in ("match_id", "match_date", "split", LABEL, "home_team_name", "away_team_name") if c in features.columns]
    scored = model.transform(features).withColumn("_p", vector_to_array("probability"))
    wanted = sorted(PREGAME_CODES, key=PREGAME_CODES.get)
    names = F.array(*[F.lit(c) for c in wanted])
    return scored.select(
        *keep,
        *[F.get("_p", F.lit(i)).alias(f"p_{c}") for i, c in enumerate(wanted)],
        F.element_at(names, (F.col("prediction") + 1).cast("int")).alias("prediction"),
        F.map_from_arrays(names, "_p").alias("probabilities"),
    )


def importances(model: PipelineModel) -> DataFrame:
    """(feature, importance) of the forest, largest first."""
    forest = model.stages[-1]
    encoder = model.stages[1]
    names = [c.removesuffix("_filled") for c in model.stages[-2].getInputCols()[:-1]]
    names += [f"{encoder.getInputCol().removesuffix('_filled')}_{v}" for v in encoder.labels]
    rows = [(n, float(v)) for n, v in zip(names, forest.featureImportances.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def top_importances(model: PipelineModel, n: int = 30) -> DataFrame:
    return importances(model).limit(n)


def evaluate_forest(model: PipelineModel, splits: DataFrame) -> DataFrame:
    """(split, rows, accuracy, balanced_accuracy) of the validation and test rows."""
    return scores(score_forest(model, splits.filter(F.col("split") != "train")), ["split"], label=LABEL)


def train_forest(features: DataFrame, settings: ForestSettings = ForestSettings()) -> tuple[PipelineModel, DataFrame]:
    """(model fitted on the training share, rows with their split)."""
    splits = split_by_rows(training_rows(features))
    return fit_forest(splits.filter(F.col("split") == "train"), settings), splits


def save_forest(model: PipelineModel, metrics: DataFrame, folder: str) -> None:
    """Pipeline, used columns, metrics (JSON) and importances (CSV)."""
    model.write().overwrite().save(f"{folder}/pipeline")
    used = metrics.sparkSession.createDataFrame([(NUMERIC_FEATURES, CATEGORICAL_FEATURES)], "numeric array<string>, categorical array<string>")
    used.coalesce(1).write.mode("overwrite").json(f"{folder}/columns")
    metrics.coalesce(1).write.mode("overwrite").json(f"{folder}/metrics")
    importances(model).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/importances")


def load_forest(folder: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/pipeline")


FITS_IN_FLIGHT = 3


def walk_forward(
    features: DataFrame, settings: ForestSettings, per_league: bool = False, in_flight: int = FITS_IN_FLIGHT
) -> list[tuple[str, str | None, DataFrame | None, str | None]]:
    """For every season but the first: fit on all earlier seasons, score that season; with ``per_league`` league by league.

    (season, league or None, scored rows or None, reason why there are none), in order. A few fits run side by side, each
    in a scheduler pool of its own.
    """
    rows = training_rows(features)
    seasons = [r.season_name for r in rows.select("season_name").distinct().orderBy("season_name").collect()]
    leagues = [r.competition_name for r in rows.select("competition_name").distinct().orderBy("competition_name").collect()]

    def one(place: tuple[str | None, str]):
        league, season = place
        mine = rows if league is None else rows.filter(F.col("competition_name") == league)
        mine.sparkSession.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit {league or 'all'} {season}")
        train, test = mine.filter(F.col("season_name") < season), mine.filter(F.col("season_name") == season)
        if train.select(LABEL).distinct().count() < 2:
            return season, league, None, "fewer than two results in earlier seasons"
        if test.isEmpty():
            return season, league, None, "no rows in the season"
        return season, league, score_forest(fit_forest(train, settings), test), None

    places = [(league, season) for league in (leagues if per_league else [None]) for season in seasons[1:]]
    with ThreadPool(in_flight) as pool:
        return pool.map(one, places, chunksize=1)


def walk_forward_scores(features: DataFrame, settings: ForestSettings, per_league: bool = False) -> DataFrame:
    """(season_name, competition_name, rows, accuracy, balanced_accuracy, log_loss, reason): a row for each fit, and one with
    its reason where there was none."""
    spark = features.sparkSession
    schema = "season_name string, competition_name string, rows long, accuracy double, balanced_accuracy double, log_loss double, reason string"
    out = spark.createDataFrame([], schema)
    for season, league, scored, reason in walk_forward(features, settings, per_league):
        place = [F.lit(season).alias("season_name"), F.lit(league).cast("string").alias("competition_name")]
        if scored is None:
            part = spark.createDataFrame([(season, league, 0, None, None, None, reason)], schema)
        else:
            part = scores(scored, [], label=LABEL, p_true=p_of_truth(LABEL)).select(*place, "rows", "accuracy", "balanced_accuracy", "log_loss", F.lit(None).cast("string").alias("reason"))
        out = out.unionByName(part)
    return out


# ---------------------------------------------------------------- in-play boosting


def inplay_rows(features: DataFrame, columns: list[str]) -> DataFrame:
    """Checked rows: needed columns, result domain, no NULLs; features as doubles."""
    require_columns(features, ["match_id", "minute", "match_date", INPLAY_LABEL, *columns])
    typed = written_down(
        features.selectExpr("match_id", "match_date", INPLAY_LABEL, *[f"CAST({c} AS DOUBLE) AS {c}" for c in columns])
    )
    require_domain(typed, INPLAY_LABEL, CLASSES)
    require_no_nulls(typed, [*columns, INPLAY_LABEL])
    return typed


def assembled_splits(features: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Rows with ``split`` and the feature vector."""
    vectors = VectorAssembler(inputCols=columns, outputCol="features").transform(inplay_rows(features, columns))
    return split_by_match(vectors).select("match_id", "minute", "match_date", INPLAY_LABEL, "split", "features")


@dataclass
class ThreeWayBoost:
    """One binary boosted model per class; class probabilities are their scores over the sum."""

    models: dict = field(default_factory=dict)

    @classmethod
    def fit(cls, train: DataFrame, settings: BoostSettings = BoostSettings(), label: str = INPLAY_LABEL) -> ThreeWayBoost:
        def one(c: str):
            return GBTClassifier(
                labelCol="is_class", maxIter=settings.rounds, maxDepth=settings.depth, stepSize=settings.rate,
                subsamplingRate=settings.rows, featureSubsetStrategy=str(settings.columns), seed=settings.seed,
            ).fit(train.withColumn("is_class", (F.col(label) == c).cast("double")))

        with ThreadPool(len(CLASSES)) as pool:  # rounds are short jobs one after another: the classes' run side by side
            return cls(dict(zip(CLASSES, pool.map(one, CLASSES), strict=True)))

    def raw_scores(self, df: DataFrame) -> DataFrame:
        """s_A, s_D, s_H: each binary model's probability, not normalised."""
        for c, model in self.models.items():
            model.setPredictionCol(f"_y_{c}").setRawPredictionCol(f"_r_{c}").setProbabilityCol(f"_p_{c}")
            df = model.transform(df).withColumn(f"s_{c}", F.get(vector_to_array(f"_p_{c}"), F.lit(1)))
            df = df.drop(f"_y_{c}", f"_r_{c}", f"_p_{c}")
        return df

    def transform(self, df: DataFrame) -> DataFrame:
        return with_probabilities(self.raw_scores(df), {c: F.col(f"s_{c}") for c in CLASSES}).drop(*[f"s_{c}" for c in CLASSES])

    def importances(self, names: list[str]) -> DataFrame:
        """Mean importance over the three models, largest first."""
        arrays = [m.featureImportances.toArray() for m in self.models.values()]
        rows = [(n, float(sum(a[i] for a in arrays) / len(arrays))) for i, n in enumerate(names)]
        return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def with_probabilities(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """p_A, p_D, p_H from non-negative class values (an all-zero row is uniform) and the prediction."""
    total = reduce(lambda a, b: a + b, values.values())
    df = df.withColumns({f"p_{c}": F.when(total > 0, F.try_divide(v, total)).otherwise(1.0 / len(values)) for c, v in values.items()})
    top = F.greatest(*[F.col(f"p_{c}") for c in values])
    first = F.coalesce(*[F.when(F.col(f"p_{c}") == top, F.lit(c)) for c in values])
    return df.withColumn("prediction", first)


def p_of_truth(label: str = INPLAY_LABEL) -> Column:
    return reduce(lambda acc, c: F.when(F.col(label) == c, F.col(f"p_{c}")).otherwise(acc), CLASSES, F.lit(None).cast("double"))


def evaluate_splits(df: DataFrame, label: str = INPLAY_LABEL) -> DataFrame:
    """(split, rows, accuracy, balanced_accuracy, log_loss)."""
    return scores(df, ["split"], label=label, p_true=p_of_truth(label))


def train_inplay(features: DataFrame, settings: BoostSettings = BoostSettings()) -> tuple[ThreeWayBoost, DataFrame, DataFrame]:
    """(model, rows with split, metrics per split)."""
    splits = assembled_splits(features)
    model = ThreeWayBoost.fit(splits.filter(F.col("split") == "train"), settings)
    return model, splits, evaluate_splits(model.transform(splits))


# ---------------------------------------------------------------- calibration


@dataclass
class CalibratedFold:
    base: ThreeWayBoost
    calibrators: dict


class Calibrated:
    """Mean over folds of calibrated, normalised class probabilities.

    As many base models as folds are fitted, each on the other folds; its calibrators learn on
    the fold it has not seen. All of it happens on the rows given, so scores on those same rows
    are in-sample.
    """

    def __init__(self, method: str, folds: list[CalibratedFold]):
        self.method, self.folds = method, folds

    @classmethod
    def fit(cls, df: DataFrame, methods: list[str], settings: BoostSettings = CALIBRATION_BOOST, folds: int = 3, label: str = INPLAY_LABEL) -> dict[str, Calibrated]:
        """All methods share the base models of a fold."""
        df = df.withColumn("fold", F.pmod(F.xxhash64("match_id"), F.lit(folds)))
        parts: dict[str, list[CalibratedFold]] = {m: [] for m in methods}
        for k in range(folds):
            base = ThreeWayBoost.fit(df.filter(F.col("fold") != k), settings, label)
            held = written_down(base.raw_scores(df.filter(F.col("fold") == k)).select(label, *[f"s_{c}" for c in CLASSES]))
            for m in methods:
                parts[m].append(CalibratedFold(base, {c: _calibrator(m, held, c, label) for c in CLASSES}))
        return {m: cls(m, fs) for m, fs in parts.items()}

    def transform(self, df: DataFrame) -> DataFrame:
        sums = {c: F.lit(0.0) for c in CLASSES}
        for k, fold in enumerate(self.folds):
            df = fold.base.raw_scores(df)
            for c in CLASSES:
                df = _apply(fold.calibrators[c], df, f"s_{c}", f"_c{k}_{c}")
            total = reduce(lambda a, b: a + b, [F.col(f"_c{k}_{c}") for c in CLASSES])
            for c in CLASSES:
                sums[c] = sums[c] + F.when(total > 0, F.try_divide(F.col(f"_c{k}_{c}"), total)).otherwise(1.0 / len(CLASSES))
            df = df.drop(*[f"s_{c}" for c in CLASSES])
        out = with_probabilities(df, {c: s / len(self.folds) for c, s in sums.items()})
        return out.drop(*[f"_c{k}_{c}" for k in range(len(self.folds)) for c in CLASSES])


def _calibrator(method: str, held: DataFrame, c: str, label: str):
    """Sigmoid or isotonic map from a class score to a probability; equal scores are merged first."""
    own = held.select(F.col(f"s_{c}").alias("score"), (F.col(label) == c).cast("double").alias("y"))
    if method == "isotonic":
        return IsotonicFit.fit(own, "score", "y")
    points = VectorAssembler(inputCols=["score"], outputCol="x").transform(own.groupBy("score", "y").agg(F.count(F.lit(1)).cast("double").alias("w")))
    return LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", predictionCol="fit").fit(points)


def _apply(model, df: DataFrame, score: str, out: str) -> DataFrame:
    if isinstance(model, IsotonicFit):
        return model.transform(df, score, out)
    df = VectorAssembler(inputCols=[score], outputCol="x").transform(df)
    model.setRawPredictionCol("_r").setProbabilityCol("_p").setPredictionCol("fit")
    return model.transform(df).withColumn(out, F.get(vector_to_array("_p"), F.lit(1))).drop("x", "_r", "_p", "fit")


def compare_calibrations(features: DataFrame, settings: BoostSettings = CALIBRATION_BOOST) -> DataFrame:
    """(model, split, rows, accuracy, balanced_accuracy, log_loss) of the plain, sigmoid and
    isotonic variants. The calibrated ones are fitted on the validation rows alone, so their
    validation scores are in-sample."""
    splits = assembled_splits(features, [*FEATURES, *DERIVED])
    models = {"no_calibration": ThreeWayBoost.fit(splits.filter(F.col("split") == "train"), settings)}
    models |= Calibrated.fit(splits.filter(F.col("split") == "valid"), ["sigmoid", "isotonic"], settings)
    results = [evaluate_splits(m.transform(splits)).select(F.lit(n).alias("model"), "*") for n, m in models.items()]
    return reduce(DataFrame.unionByName, results)


def split_summary(splits: DataFrame, label: str) -> DataFrame:
    """Per split: rows, matches, first and last day, and the count of each result."""
    return splits.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("match_id").alias("matches"),
        F.min("match_date").alias("date_min"),
        F.max("match_date").alias("date_max"),
        *[F.count_if(F.col(label) == c).alias(f"n_{c}") for c in CLASSES],
    )
