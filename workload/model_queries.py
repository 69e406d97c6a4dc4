"""Training, scoring and search on the training set of the whole folder."""

from functools import reduce
from operator import and_

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from arrears.constants import CATEGORICAL_FEATURES, CLICK_COLUMNS, LABEL_SNAPSHOT, NUMERIC_FEATURES, SCORE_BANDS, VALIDATION_REG_PARAM
from arrears.operators.descent import margin_sql
from arrears.operators.discrimination import ranking_metrics
from arrears.operators.joins import join_label_month
from arrears.operators.optimality import descent_left
from arrears.operators.scoring import default_probability, logistic, score_batch as score_frame
from arrears.plans import inference, search, training
from arrears.session import compiled, materialise, scratch_path
from arrears.sources.tables import read_table
from workload.fixtures import Inputs
from workload.reference_sql import CATEGORICAL, NUMERIC
from workload.registry import query
from workload.relational_queries import _OOT_SQL

CUTOFF = "1999-12-01"
KEYS = ("loan_id", LABEL_SNAPSHOT)


def _training(spark, sf_dir):
    """The training set as a table, since fitting reads it many times."""
    with compiled(spark):
        return materialise(Inputs(spark, sf_dir).gold_training(), "gold_training")


def _validation_run(spark, sf_dir):
    return training.train_validation_model(_training(spark, sf_dir), CUTOFF, KEYS)


@query(
    "impute_median",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS filled, count({c}) AS unchanged, true AS near_median FROM gold_training" for c in NUMERIC
    ),
)
def impute_median(spark, sf_dir):
    """Per column the rows filled and left alone, and whether the fill's rank is within the stated error of one half."""
    df = _training(spark, sf_dir)
    imputer, outputs = training.impute_median(NUMERIC_FEATURES)
    model = imputer.fit(df)
    medians = model.surrogateDF.first().asDict()
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(F.col(c).isNull() & F.col(out).isNotNull()).alias("filled"),
            F.count_if(F.col(c) == F.col(out)).alias("unchanged"),
            (
                (F.count_if(F.col(c) < medians[c]) <= F.ceil(0.501 * F.count(c)) + 1)
                & (F.count_if(F.col(c) <= medians[c]) >= F.floor(0.499 * F.count(c)) - 1)
            ).alias("near_median"),
        )
        for c, out in zip(NUMERIC_FEATURES, outputs)
    ]
    return model.transform(df).agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def place_of_one(vector):
    """Index of the only one in a one-hot vector."""
    return F.array_position(vector_to_array(vector), 1.0).cast("double") - 1


@query(
    "encode_categories",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, level, idx, n AS row_count FROM (SELECT {c} AS level, count(*) AS n, "
        f"CASE WHEN {c} IS NULL THEN (SELECT count(DISTINCT {c}) FROM gold_training)::DOUBLE "
        f"ELSE (row_number() OVER (ORDER BY {c} IS NULL, count(*) DESC, {c}) - 1)::DOUBLE END AS idx FROM gold_training GROUP BY {c})"
        for c in CATEGORICAL
    ),
)
def encode_categories(spark, sf_dir):
    df = _training(spark, sf_dir).select(*CATEGORICAL_FEATURES)
    encoder, _ = training.one_hot(CATEGORICAL_FEATURES)
    numbered = training.category_index(df, CATEGORICAL_FEATURES).transform(df)
    encoded = encoder.fit(numbered).transform(numbered)
    # The place of the one in the vector, which has to be the number of the level.
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("level"), place_of_one(F.col(f"hot_{c}")).alias("idx"))
        for c in CATEGORICAL_FEATURES
    ]
    return (
        encoded.select(F.inline(F.array(*pairs)))
        .groupBy("column_name", "level", "idx")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


#: Rows that the scores of a temporal split have to be given for, and what has to be true of the model; the numbers themselves are beyond SQL.
_TESTED = (
    "SELECT loan_id, label_snapshot_date, label, true AS is_probability, true AS loss_is_least FROM gold_training "
    f"WHERE label IS NOT NULL AND label_snapshot_date > DATE '{CUTOFF}'"
)
#: Share of the first gradient that a fitted model may have left; a constant score has all of it.
LEAST_LEFT, DESCENT_LEFT = 0.01, 0.05


def _checked(scores, left, most, score="prediction_score"):
    least = left.select(F.col("left") <= most).scalar()
    return scores.withColumn("is_probability", F.col(score).between(0, 1)).withColumn("loss_is_least", least).drop(score)


@query("train_logreg", _TESTED)
def train_logreg(spark, sf_dir):
    """Scores of the test rows, and whether the gradient of the model's loss over the training rows vanishes."""
    df = _training(spark, sf_dir)
    run = training.train_validation_model(df, CUTOFF, KEYS)
    fitted = run.model.stages[-1]
    learned = training.labelled(df).where(F.col(LABEL_SNAPSHOT) <= F.lit(CUTOFF).cast("date"))
    scored = run.model.transform(learned).select("label", vector_to_array("features").alias("inputs"), vector_to_array("probability")[1].alias("prediction_score"))
    left = descent_left(scored, list(fitted.coefficients), VALIDATION_REG_PARAM, standardised=True)
    return _checked(run.test_scores, left, LEAST_LEFT)


@query(
    "training_run_metrics",
    f"SELECT '{CUTOFF}' AS temporal_cutoff_date, count(*) FILTER (label_snapshot_date <= DATE '{CUTOFF}') AS train_rows, "
    f"count(*) FILTER (label_snapshot_date > DATE '{CUTOFF}') AS test_rows, count(*) FILTER (label = 0) AS label_0_rows, "
    "count(*) FILTER (label = 1) AS label_1_rows, true AS auc_in_range FROM gold_training WHERE label IS NOT NULL",
)
def training_run_metrics(spark, sf_dir):
    metrics = _validation_run(spark, sf_dir).metrics
    counts = ["temporal_cutoff_date", "train_rows", "test_rows", "label_0_rows", "label_1_rows"]
    return metrics.select(*counts, F.col("auc").between(0, 1).alias("auc_in_range"))


def _candidates(spark, sf_dir):
    return training.train_candidates(_training(spark, sf_dir), CUTOFF, keys=KEYS)


@query("train_candidates", _TESTED)
def train_candidates(spark, sf_dir):
    """Scores of the test rows by the champion, and whether its descent has used up the gradient, over the stored training rows."""
    run = _candidates(spark, sf_dir)
    best = run.metrics.first()["model_name"]
    row = run.extras["coefficients"].where(F.col("model_name") == best).first()
    inputs = row["inputs"][:-1]
    margin = margin_sql(row["weights"][:-1], row["weights"][-1], inputs)
    learned = run.extras["prepared"].where("split = 'train'").select("label", F.array(*[F.col(f"`{c}`") for c in inputs]).alias("inputs"), F.expr(logistic(margin)).alias("prediction_score"))
    return _checked(run.test_scores, descent_left(learned, row["weights"][:-1], training.CANDIDATES[best]), DESCENT_LEFT)


@query("leaderboard", "\nUNION ALL ".join(f"SELECT '{name}' AS model_name, true AS in_order, true AS champion_auc_again" for name in training.CANDIDATES))
def leaderboard(spark, sf_dir):
    """The candidates, whether they are in order, and whether the best AUC comes out of the stored test scores again."""
    run = _candidates(spark, sf_dir)
    best = ranking_metrics(run.test_scores).first()["auc"]
    places = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    board = run.metrics.coalesce(1).withColumn("place", F.monotonically_increasing_id())
    listed = F.array_sort(F.collect_list(F.struct("place", "auc")).over(places))["auc"]
    return board.select("model_name", (F.sort_array(listed, False) == listed).alias("in_order"), (listed[0] == F.lit(best)).alias("champion_auc_again"))


@query(
    "reference_scores",
    f"SELECT label, label_snapshot_date, count(*) AS row_count, true AS is_probability FROM gold_training WHERE label IS NOT NULL AND label_snapshot_date <= DATE '{CUTOFF}' GROUP BY 1, 2",
)
def reference_scores(spark, sf_dir):
    scores = _candidates(spark, sf_dir).extras["reference_scores"]
    return scores.groupBy("label", LABEL_SNAPSHOT).agg(F.count(F.lit(1)).alias("row_count"), F.bool_and(F.col("score").between(0, 1)).alias("is_probability"))


@query(
    "model_registry",
    f"SELECT count(*) FILTER (label_snapshot_date <= DATE '{CUTOFF}') AS train_rows, count(*) FILTER (label_snapshot_date > DATE '{CUTOFF}') AS test_rows, "
    f"'{CUTOFF}' AS train_cutoff_date, {len(training.CANDIDATES)}::BIGINT AS candidates, true AS best_leads, true AS model_is_there FROM gold_training WHERE label IS NOT NULL",
)
def model_registry(spark, sf_dir):
    """The stored record against the stored leaderboard and the model at the path it names."""
    bank = scratch_path(spark, "model_bank")
    training.save_model_bank(_candidates(spark, sf_dir), bank)
    board = spark.read.option("header", True).csv(f"{bank}/leaderboard")
    metadata = spark.read.json(f"{bank}/model_metadata")
    loaded = len(training.load_model(spark, metadata.first()["model_path"]).stages) > 0
    return metadata.select(
        "train_rows",
        "test_rows",
        "train_cutoff_date",
        F.lit(board.count()).cast("bigint").alias("candidates"),
        (F.col("best_model") == F.col("leaderboard")[0]["model_name"]).alias("best_leads"),
        F.lit(loaded).alias("model_is_there"),
    )


@query(
    "model_roundtrip",
    "SELECT count(*) AS row_count, 0::BIGINT AS changed_scores FROM gold_training",
)
def model_roundtrip(spark, sf_dir):
    df = _training(spark, sf_dir)
    model = training.train_candidates(df, CUTOFF, keys=KEYS).model
    loaded = training.load_model(spark, training.save_model(model, f"{scratch_path(spark, 'model')}/best_model"))
    before = default_probability(model, df.select(*KEYS, *NUMERIC_FEATURES, *CATEGORICAL_FEATURES), "before")
    both = default_probability(loaded, before, "after")
    return both.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(F.when(F.col("before") != F.col("after"), 1)).alias("changed_scores"),
    )


@query("score_batch", "SELECT loan_id, label_snapshot_date, label, true AS class_follows, true AS band_follows, true AS rate_is_met FROM gold_training")
def score_batch(spark, sf_dir):
    """Scored rows, whether class and band are what the score says (half and more is 1, bands are fifths closed on the right),
    and whether the scores of the training rows have the mean of their labels, as a free intercept makes them."""
    df = _training(spark, sf_dir)
    scored = score_frame(training.train_candidates(df, CUTOFF, keys=KEYS).model, df)
    learned = scored.where(F.col("label").isNotNull() & (F.col(LABEL_SNAPSHOT) <= F.lit(CUTOFF).cast("date")))
    rate_is_met = learned.agg((F.abs(F.avg("prediction_score") - F.avg("label")) < 0.001).alias("met")).scalar()
    fifth = F.greatest(F.ceil(F.col("prediction_score") * 5), F.lit(1)).cast("int")
    names = F.array(*[F.lit(name) for _, name in SCORE_BANDS])
    return scored.select(
        "loan_id",
        LABEL_SNAPSHOT,
        "label",
        (F.col("prediction") == (F.col("prediction_score") >= 0.5).cast("int")).alias("class_follows"),
        (F.col("score_band") == F.get(names, fifth - 1)).alias("band_follows"),
        rate_is_met.alias("rate_is_met"),
    )


@query(
    "batch_inference",
    "SELECT count(*) AS row_count, count(DISTINCT label_snapshot_date) AS prediction_months FROM "
    "(SELECT DISTINCT loan_id, label_snapshot_date FROM gold_training)",
)
def batch_inference(spark, sf_dir):
    df = _training(spark, sf_dir)
    model = training.train_candidates(df, CUTOFF, keys=KEYS).model
    path = scratch_path(spark, "model_predictions")
    inference.run_batch_inference(model, df, path)
    return inference.run_batch_inference(model, df, path, "1999-06-15").select("row_count", "prediction_months")


def _behaviour_rows(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    return materialise(join_label_month(inputs.gold_labels(), inputs.silver_clickstream()), "labels_with_clicks")


def _search(spark, sf_dir):
    return search.train_behaviour_model(_behaviour_rows(spark, sf_dir), F.lit("2000-04-01").cast("date"), KEYS)


@query(
    "random_search_cv",
    f"WITH {_OOT_SQL} SELECT 'credit_model_2000_04_01' AS model_version, split, DATE '1999-02-01' AS train_test_start_date, DATE '2000-01-31' AS train_test_end_date, "
    "DATE '2000-02-01' AS oot_start_date, DATE '2000-03-31' AS oot_end_date, count(*) AS row_count, round(avg(label), 2) AS label_rate, "
    "true AS auc_in_range, true AS gini_follows, true AS chosen_from_space FROM marked GROUP BY split",
)
def random_search_cv(spark, sf_dir):
    """Record of the whole documented search (all draws of the whole space, three folds), with what SQL cannot give as checks:
    that AUC and Gini belong together and that the chosen setting is one of the space."""
    chosen = [F.element_at("hp_params", n).isin([str(v) for v in values]) for n, values in search.SEARCH_SPACE.items()]
    return _search(spark, sf_dir).record.select(
        *["model_version", "split", "train_test_start_date", "train_test_end_date", "oot_start_date", "oot_end_date", "row_count", "label_rate"],
        F.col("auc").between(0, 1).alias("auc_in_range"),
        (F.abs(F.col("gini") - (2 * F.col("auc") - 1)) <= 0.0005 + 1e-12).alias("gini_follows"),
        F.coalesce(reduce(and_, chosen), F.lit(False)).alias("chosen_from_space"),
    )


@query("score_snapshots", "SELECT Customer_ID, snapshot_date, 'credit_model_2000_04_01' AS model_name FROM silver_clickstream")
def score_snapshots(spark, sf_dir):
    """Snapshots that the stored winner of the whole search scores; the scores themselves, which SQL cannot give, stay in the table."""
    root = search.save_search_run(_search(spark, sf_dir), scratch_path(spark, "model_bank"))
    model = training.load_model(spark, f"{root}/model")
    version = read_table(spark, f"{root}/record").first()["model_version"]
    features = Inputs(spark, sf_dir).silver_clickstream().select("Customer_ID", "snapshot_date", *CLICK_COLUMNS)
    path = scratch_path(spark, "snapshot_predictions")
    inference.score_snapshots(model, features, version, path)
    return read_table(spark, path).filter(F.col("model_predictions").isNotNull()).select("Customer_ID", "snapshot_date", "model_name")
