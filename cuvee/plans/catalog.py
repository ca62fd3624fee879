"""The registered queries: every operator run over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuvee.functions import text
from cuvee.operators import clean, encode, evaluate, forest, profile, split
from cuvee.operators.assemble import FeatureSettings, count_terms, feature_dictionary, fit_features, store_features, topic_terms
from cuvee.operators.text import TermCounter, TermWeights, description_tokens, normalize_descriptions
from cuvee.operators.topics import TextTopics, top_terms
from cuvee.plans import rating
from cuvee.plans.fixture import document_reviews, reviews, table
from cuvee.runtime import discard, materialize, new_path
from cuvee.schema import KEY, LABEL, ROLES
from cuvee.sources.features import read_feature_dictionary, read_features, write_feature_dictionary, write_features
from cuvee.sources.reviews import malformed_reviews, read_reviews_csv, read_split, write_reviews_csv, write_split

Query = Callable[[SparkSession, str], DataFrame]

# Thresholds at which the fixture tells frequent from rare values; per column, since the columns differ in size.
POOL_COUNTS = {
    "country": 590, "province": 30, "region_1": 600, "region_2": 30, "taster_name": 30, "variety": 235, "winery": 10,
}
MEAN_MIN_COUNT = 190
TEST_SIZE = 0.2
SYMBOLS = "½ ° € © £ ¡ × • ™ – — “ ” ’ … ± ¿ ÷ º".split()
#: The parameters of the original job: 50, 50 and 20 topics, 300 trees without a limit of depth, steps of ten features down to 29 or, by validation, to
#: one, five folds, and 100 draws from the whole space. The README has the times.
SETTINGS = FeatureSettings(seed=7)
KEEP, STEP, SMALLEST, FOLDS, SEARCHED = 29, 10, 1, 5, 100
_stored: dict[tuple, object] = {}


def forget() -> None:
    """Drop the hand-over tables kept between queries, so that the next query computes its own."""
    _stored.clear()


def _once(spark: SparkSession, sf_dir: str, name: str, make):
    at = (spark.sparkContext.applicationId, sf_dir, name)
    if at not in _stored:
        _stored[at] = make()
    return _stored[at]


# Cleaning


def normalize_categories(spark, sf_dir):
    columns = [*ROLES.categorical, "designation"]
    return clean.normalize_categories(reviews(spark, sf_dir, False).select(KEY, *columns))


def fold_documents(spark, sf_dir):
    folded = text.normalize_category(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", folded.alias("text"))


def title_year(spark, sf_dir):
    return reviews(spark, sf_dir, False).select(KEY, text.title_year(F.col("title")).alias("year"))


def title_clean(spark, sf_dir):
    return reviews(spark, sf_dir, False).select(KEY, text.clean_title(F.col("title")).alias("title"))


def title_geo_mismatch(spark, sf_dir):
    return clean.title_place_mismatch(reviews(spark, sf_dir, False))


def implication_violations(spark, sf_dir):
    return clean.implication_violations(reviews(spark, sf_dir, False), "taster_name", "taster_twitter_handle")


def document_tokens(spark, sf_dir):
    return description_tokens(document_reviews(spark, sf_dir))


def document_words(spark, sf_dir):
    """The words of each document in order, as they are before stemming."""
    kept = text.content_words(F.col("description"))
    return document_reviews(spark, sf_dir).select(KEY, F.array_join(kept, " ").alias("words"))


def document_normalized(spark, sf_dir):
    return normalize_descriptions(document_reviews(spark, sf_dir))


def csv_scan(spark, sf_dir):
    """The review table written as CSV and read back, line breaks in the descriptions included."""
    path = new_path(spark, "reviews-csv")
    write_reviews_csv(reviews(spark, sf_dir), path, compression="gzip")
    return read_reviews_csv(spark, path)


def csv_malformed(spark, sf_dir):
    """Reviews as lines of text, some with a cell too few or too many, with words for numbers, without an id."""
    at = F.col("c_custkey")
    cells = [
        F.when(at % 7 == 1, "").otherwise(at.cast("string")), F.lit("Italy"), F.lit('"one, ""two"""'), F.lit("D"),
        F.when(at % 5 == 1, "many").otherwise(F.lit("90")), F.when(at % 11 == 1, "1O").otherwise(F.lit("12.5")),
        *[F.lit(x) for x in "P R S T @t".split()], F.col("c_name"), F.lit("V"),
    ]
    line = F.when(at % 3 == 1, F.concat_ws(",", *cells)).otherwise(F.concat_ws(",", *cells, F.lit("W")))
    path = new_path(spark, "lines")
    table(spark, sf_dir, "customer").select(F.when(at % 13 == 1, F.concat(line, F.lit(",X,Y"))).otherwise(line)).write.text(path)
    sound = read_reviews_csv(spark, path, malformed="separate", header=False)
    told = malformed_reviews(spark, path, header=False).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return told.unionAll(sound.agg(F.lit("sound").alias("reason"), F.count(F.lit(1)).alias("n")))


def fold_symbols(spark, sf_dir):
    """Part names with a symbol put in."""
    symbols = F.array(*[F.lit(x) for x in SYMBOLS])
    symbol = F.get(symbols, F.pmod("p_partkey", F.lit(len(SYMBOLS))).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", text.fold(F.concat("p_name", symbol, F.lit("é"))).alias("name"))


# Profiles


def profile_columns(spark, sf_dir):
    view = profile.profile_view(reviews(spark, sf_dir, False))
    return profile.profile_columns(view, view.columns)


def distinct_estimates(spark, sf_dir):
    """Distinct values from the united sketches of four parts of the rows: whether the estimate is within 5 % (three standard errors) of the
    exact number."""
    rows = reviews(spark, sf_dir, False)
    view = profile.profile_view(rows)
    parts = profile.distinct_sketches(view.withColumn("_part", F.pmod(F.xxhash64("title", "price"), F.lit(4))), view.columns, F.col("_part"))
    found = profile.distinct_estimates(profile.united(materialize(parts, "sketches")))
    exact = profile.profile_columns(view, view.columns).select("column", F.col("n_distinct").alias("exact"))
    within = F.abs(F.col("n_distinct") - F.col("exact")) <= 0.05 * F.col("exact")
    return found.join(exact, "column").select("column", "n_rows", "n_missing", F.col("exact").alias("n_distinct"), within.alias("within"))


def value_counts_all(spark, sf_dir):
    view = profile.profile_view(reviews(spark, sf_dir, False), "missing").drop("price")
    return profile.value_counts_all(view, view.columns)


def value_counts(spark, sf_dir):
    return profile.value_counts(reviews(spark, sf_dir, False), "variety")


def year_counts(spark, sf_dir):
    view = profile.profile_view(reviews(spark, sf_dir, False))
    return profile.value_counts(view, "year", keep_missing=True)


def event_counts(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "events"), "user_id")


def points_histogram(spark, sf_dir):
    return profile.histogram(reviews(spark, sf_dir, False), LABEL, 10)


def price_histogram(spark, sf_dir):
    """Only prices below a bound, in 25 bins; missing prices fail the comparison."""
    return profile.histogram(reviews(spark, sf_dir, False).where(F.col("price") < 950), "price", 25)


def histogram_nan(spark, sf_dir):
    """Some values are NaN, some null: neither is counted nor moves an edge."""
    value = F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).when(F.col("event_id") % 13 != 0, F.col("value"))
    return profile.histogram(table(spark, sf_dir, "events").select(value.alias("x")), "x", 10)


def lineitem_histogram(spark, sf_dir):
    return profile.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 100)


# Splits and samples


def split_prefix(spark, sf_dir):
    return split.split_prefix(reviews(spark, sf_dir, False), TEST_SIZE).select(KEY, "split")


def split_stored(spark, sf_dir):
    """Both sets written in one pass, the train set read back by partition."""
    path = new_path(spark, "split")
    write_split(split.split_prefix(reviews(spark, sf_dir, False), TEST_SIZE), path)
    return read_split(spark, path, "train").select(KEY, LABEL, "winery")


def split_hash(spark, sf_dir):
    return split.split_hash(reviews(spark, sf_dir, False), TEST_SIZE, seed=7).select(KEY, "split")


def sample_rows(spark, sf_dir):
    return split.sample_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 1000, seed=7, key="o_orderkey")


def kfold_assign(spark, sf_dir):
    return split.kfold(reviews(spark, sf_dir, False).select(KEY), 7)


def _with_gaps(spark, sf_dir):
    return table(spark, sf_dir, "customer").select((F.col("c_custkey") * 10 + 1000).alias(KEY))


def split_gaps(spark, sf_dir):
    """Row ids that begin at 1000 and leave out nine of ten."""
    return split.split_prefix(_with_gaps(spark, sf_dir), TEST_SIZE)


def kfold_gaps(spark, sf_dir):
    return split.kfold(_with_gaps(spark, sf_dir), 7)


def ordered_positions(spark, sf_dir):
    """Positions of rows whose ids have gaps: here the order of customers by name."""
    return split.with_position(table(spark, sf_dir, "customer").select("c_name"), "c_name")


# Encoders


def _prepared(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Train and test rows with normal categories, without text."""
    rows = split.split_prefix(clean.normalize_categories(reviews(spark, sf_dir, False)), TEST_SIZE)
    return rows.where("split = 'train'"), rows.where("split = 'test'")


def impute_median(spark, sf_dir):
    rows = reviews(spark, sf_dir, False).select(KEY, text.title_year(F.col("title")).alias("year"), "price")
    model = encode.ExactMedianImputer(inputCols=["year", "price"]).fit(rows)
    return model.transform(rows).withColumn("price", F.round("price", 6))


def event_median(spark, sf_dir):
    """The same imputation at volume: all event values."""
    value = F.when(F.col("event_type") != "error", F.col("value"))
    rows = table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    model = encode.ExactMedianImputer(inputCols=["value"]).fit(rows)
    return model.transform(rows).withColumn("value", F.round("value", 6))


def target_mean_table(spark, sf_dir):
    train, _ = _prepared(spark, sf_dir)
    means = encode.target_mean_table(train, ROLES.categorical, LABEL, 10)
    return means.withColumn("mean", F.round("mean", 6))


def target_mean_encode(spark, sf_dir):
    train, test = _prepared(spark, sf_dir)
    model = encode.TargetMeanEncoder(inputCols=ROLES.categorical, minCount=MEAN_MIN_COUNT).fit(train)
    return model.transform(test).select(KEY, *[F.round(c, 6).alias(c) for c in model.outputs])


def target_mean_out_of_fold(spark, sf_dir):
    train, _ = _prepared(spark, sf_dir)
    folded = train.withColumn("fold", (F.col(KEY) % 5).cast("int"))
    encoder = encode.TargetMeanEncoder(inputCols=["country", "winery"], minCount=20, foldCol="fold")
    encoded = encoder.encode_training(folded)
    return encoded.select(KEY, *[F.round(f"{c}_avg_{LABEL}", 6).alias(c) for c in ("country", "winery")])


def label_mean_encode(spark, sf_dir):
    """A second target: mean quality of labelled documents by source and language, for all documents."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    labelled = documents.join(table(spark, sf_dir, "labels"), "doc_id")
    model = encode.TargetMeanEncoder(
        inputCols=["source", "lang"], labelCol="quality", minCount=20, keyCol="doc_id"
    ).fit(labelled)
    return model.transform(documents).select("doc_id", *[F.round(c, 6).alias(c) for c in model.outputs])


def lineitem_mean_encode(spark, sf_dir):
    """The encoder at volume, on rows without a unique key: mean quantity by part and by supplier."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    )
    model = encode.TargetMeanEncoder(
        inputCols=["l_partkey", "l_suppkey"], labelCol="l_quantity", minCount=30, keyCol="l_orderkey"
    ).fit(rows)
    outputs = [F.round(c, 6).alias(c) for c in model.outputs]
    return model.transform(rows).select("l_orderkey", "l_quantity", *outputs)


def pool_rare(spark, sf_dir):
    rows = clean.normalize_categories(reviews(spark, sf_dir, False)).select(KEY, *ROLES.categorical)
    return encode.pool_rare(rows, POOL_COUNTS).select(KEY, *ROLES.categorical)


def _pooled(spark, sf_dir):
    train, test = _prepared(spark, sf_dir)
    train, test = train.select(KEY, *ROLES.categorical), test.select(KEY, *ROLES.categorical)
    counts = [int(n * (1 - TEST_SIZE)) for n in POOL_COUNTS.values()]
    model = encode.RareCategoryPooler(inputCols=list(POOL_COUNTS), minCounts=counts).fit(train)
    return model.transform(train), model.transform(test)


def pool_rare_fitted(spark, sf_dir):
    return _pooled(spark, sf_dir)[1].select(KEY, *ROLES.categorical)


def one_hot(spark, sf_dir):
    train, test = _pooled(spark, sf_dir)
    dictionary = encode.category_dictionary(train, ROLES.categorical)
    return encode.one_hot_long(test, dictionary, ROLES.categorical)


# Term weights and topics


def _term_weights(rows: DataFrame, column: str, sublinear: bool) -> DataFrame:
    counted = materialize(TermCounter(inputCols=[column]).transform(rows).select(KEY, "terms"), "terms")
    model = TermWeights(inputCols=[column], sublinearCols=[column] if sublinear else []).fit(counted)
    return model.transform(counted).select(KEY, "term_id", F.round("weight", 6).alias("weight"))


def tfidf_raw(spark, sf_dir):
    rows = clean.normalize_categories(reviews(spark, sf_dir, False).select(KEY, "designation"), ["designation"])
    return _term_weights(rows, "designation", sublinear=False)


def tfidf_sublinear(spark, sf_dir):
    rows = clean.normalize_categories(document_reviews(spark, sf_dir).select(KEY, "description"), ["description"])
    return _term_weights(rows, "description", sublinear=True)


def _document_topics(spark, sf_dir):
    def make():
        documents = document_reviews(spark, sf_dir)
        rows = normalize_descriptions(documents).join(documents.select(KEY, "designation"), KEY)
        columns = ["designation", "description"]
        counted = materialize(TermCounter(inputCols=columns).transform(rows).select(KEY, "terms"), "terms")
        model = TextTopics(
            inputCols=columns, outputCols=[f"{c}_topics" for c in columns], topics=[SETTINGS.topics[c] for c in columns],
            sublinearCols=["description"], seed=7,
        ).fit(counted)
        return model, counted

    return _once(spark, sf_dir, "topics", make)


def topic_weights(spark, sf_dir):
    model, counted = _document_topics(spark, sf_dir)
    return model.weights(counted).select(
        KEY, F.col("source").alias("source_col"), F.transform("w", lambda x: F.round(x, 6)).alias("weights")
    )


def topic_top_terms(spark, sf_dir):
    model, _ = _document_topics(spark, sf_dir)
    return top_terms(model.topic_terms(), 20).withColumn("weight", F.round("weight", 6))


# Features and forests


def _prepared_reviews(spark, sf_dir) -> str:
    def make():
        path = new_path(spark, "prepared")
        rating.prepare(reviews(spark, sf_dir), path, TEST_SIZE)
        return path

    return _once(spark, sf_dir, "prepared", make)


def _features(spark, sf_dir):
    """Fitted features and the stored feature tables of both sets."""

    def make():
        path = _prepared_reviews(spark, sf_dir)
        counted = {
            s: materialize(count_terms(read_split(spark, path, s), SETTINGS).drop(*ROLES.text), s) for s in ("train", "test")
        }
        model = fit_features(counted["train"], SETTINGS)
        found = [store_features(model, counted[s], SETTINGS) for s in ("train", "test")]
        discard(*counted.values())
        return model, *found

    return _once(spark, sf_dir, "features", make)


def _pruned(spark, sf_dir) -> forest.Elimination:
    def make():
        _, train, _ = _features(spark, sf_dir)
        return forest.eliminate(train, forest.forest(seed=7), KEEP, STEP)

    return _once(spark, sf_dir, "pruned", make)


def assemble_features(spark, sf_dir):
    return _features(spark, sf_dir)[2]


def feature_names(spark, sf_dir):
    return feature_dictionary(_features(spark, sf_dir)[0])


def rf_predict(spark, sf_dir):
    _, train, test = _features(spark, sf_dir)
    model = forest.forest(seed=7).fit(train)
    return model.transform(test).select(KEY, "label", "prediction")


def rfe_support(spark, sf_dir):
    return _pruned(spark, sf_dir).support(spark)


def rfecv_scores(spark, sf_dir):
    _, train, _ = _features(spark, sf_dir)
    folded = materialize(split.kfold(train, FOLDS), "folded")
    return forest.elimination_scores(folded, forest.forest(seed=7), FOLDS, STEP, SMALLEST)


def _search(spark, sf_dir):
    def make():
        train = read_split(spark, _prepared_reviews(spark, sf_dir), "train")
        return forest.search(train, SETTINGS, forest.SEARCH_SPACE, n_iter=SEARCHED, folds=FOLDS, seed=7)[0]

    return _once(spark, sf_dir, "search", make)


def search_results(spark, sf_dir):
    return _search(spark, sf_dir)


def feature_importance_topk(spark, sf_dir):
    model, _, _ = _features(spark, sf_dir)
    return forest.top_features(_pruned(spark, sf_dir).model, feature_dictionary(model), 20)


def top_topic_words(spark, sf_dir):
    model, _, _ = _features(spark, sf_dir)
    return forest.words_of_top_topics(feature_importance_topk(spark, sf_dir), topic_terms(model), 20)


def pruned_error_summary(spark, sf_dir):
    return evaluate.error_summary(rating.predict(_pruned(spark, sf_dir).model, _features(spark, sf_dir)[2]))


# Checks of the fitted models: properties that hold whatever the fit, as rows of (name, n)


def _checks(spark, found: dict[str, int]) -> DataFrame:
    return spark.createDataFrame([(k, int(v)) for k, v in found.items()], "name string, n long")


def topic_checks(spark, sf_dir):
    """Texts with topics, weights below zero, weights off the optimum of their row, rounds in which the loss rises."""
    model, counted = _document_topics(spark, sf_dir)
    weights = materialize(model.weights(counted), "checked-weights")
    below = weights.where(F.exists("w", lambda x: x.isNull() | F.isnan(x) | (x < 0))).count()
    rises = sum(b > a * (1 + 1e-9) for x in model.state["losses"].values() for a, b in zip(x, x[1:]))
    texts = weights.where(F.col("source") == "description").select(KEY).distinct().count()
    off = model.residuals(counted).where(~(F.col("off") <= 1e-6)).count()
    return _checks(spark, {"texts": texts, "below zero": below, "off the optimum": off, "rising rounds": rises})


def feature_checks(spark, sf_dir):
    """Rows of both sets, rows whose vector is not as wide as the dictionary, positions named twice, values that are no numbers; all
    from the matrix and the dictionary as they are stored and read back."""
    model, train, test = _features(spark, sf_dir)
    at = new_path(spark, "feature-store")
    for name, rows in (("train", train), ("test", test)):
        write_features(rows, f"{at}/{name}")
    write_feature_dictionary(feature_dictionary(model), topic_terms(model), f"{at}/info")
    names, _ = read_feature_dictionary(spark, f"{at}/info")
    stored = {name: read_features(spark, f"{at}/{name}") for name in ("train", "test")}
    width = names.count()
    vector = vector_to_array("features").alias("x")
    rows = stored["train"].select(vector).unionByName(stored["test"].select(vector))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v))
    wrong, no_number = rows.agg(F.count_if(F.size("x") != width), F.count_if(bad)).first()
    return _checks(
        spark,
        {"train": stored["train"].count(), "test": stored["test"].count(), "wrong width": wrong, "not a number": no_number,
         "names twice": width - names.select("feature_idx").distinct().count()},
    )


def search_checks(spark, sf_dir):
    """Rows, candidates, folds and the best rank of a search, and candidates whose mean isn't that of their folds by rows."""
    results = _search(spark, sf_dir)
    n = read_split(spark, _prepared_reviews(spark, sf_dir), "train").count()
    size = F.lit(n // FOLDS) + (F.col("fold") < n % FOLDS).cast("int")
    means = results.groupBy("candidate").agg((F.sum(F.col("mse") * size) / F.sum(size)).alias("m"), F.first("mean_mse").alias("given"))
    rows, candidates, folds, best = results.agg(
        F.count(F.lit(1)), F.count_distinct("candidate"), F.count_distinct("fold"), F.min("rank")
    ).first()
    off = means.where(F.abs(F.col("m") - F.col("given")) > 1e-9).count()
    return _checks(spark, {"rows": rows, "candidates": candidates, "folds": folds, "best rank": best, "wrong means": off})


def forest_checks(spark, sf_dir):
    """Predictions, those beyond the labels, features kept, features of the support without a name, and what the importance table gets wrong:
    places, names and names as reported that differ from a ranking of what the splits in the stored nodes explain."""
    model, train, test = _features(spark, sf_dir)
    pruned = _pruned(spark, sf_dir)
    low, high = train.agg(F.min("label"), F.max("label")).first()
    found = materialize(pruned.model.transform(test).select("prediction"), "checked-predictions")
    support, names = pruned.support(spark), feature_dictionary(model)
    of_tree = Window.partitionBy("tree")
    gains = pruned.model.stages[0].nodes.where("feature >= 0").groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
    shares = gains.withColumn("share", F.col("gain") / F.sum("gain").over(of_tree)).groupBy("feature").agg(F.sum("share").alias("share"))
    kept = support.where("kept").select(F.col("feature_idx").alias("feature")).join(shares, "feature", "left").fillna(0.0, ["share"])
    # A line per kept feature, 29 in all.
    order = Window.orderBy(F.desc(F.round("share", 9)), "feature")
    ranked = kept.withColumn("place", F.row_number().over(order)).withColumn("at", F.row_number().over(Window.orderBy("feature")) - 1)
    told = ranked.join(names.select(F.col("feature_idx").alias("feature"), "name"), "feature").join(
        names.select(F.col("feature_idx").alias("at"), F.col("name").alias("reported")), "at"
    )
    top = materialize(forest.top_features(pruned.model, names, 20), "checked-top")
    shown = top.withColumn("place", F.row_number().over(Window.orderBy(F.desc(F.round("importance", 9) ), "feature_idx")))
    right = shown.join(told, "place").where((F.col("feature_idx") == F.col("feature")) & (shown["name"] == told["name"]) & (F.col("name_as_reported") == F.col("reported")))
    return _checks(
        spark,
        {"predictions": found.count(), "beyond the labels": found.where(~F.col("prediction").between(low, high)).count(),
         "kept": support.where("kept").count(), "unnamed": support.join(names, "feature_idx", "left_anti").count(), "top": top.count(),
         "misplaced": top.count() - right.count()},
    )


# Evaluation, fed by the training mean of the winery


def _winery_errors(spark, sf_dir) -> DataFrame:
    rows = split.split_prefix(
        clean.normalize_categories(reviews(spark, sf_dir, False).select(KEY, LABEL, "price", "winery"), ["winery"]), TEST_SIZE
    )
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    imputer = encode.ExactMedianImputer(inputCols=["price"]).fit(train)
    means = encode.TargetMeanEncoder(inputCols=["winery"], outputCols=["prediction"], minCount=10).fit(train)
    predicted = imputer.transform(means.transform(test))
    label = F.col(LABEL).cast("double").alias("label")
    return materialize(evaluate.with_errors(predicted.select(KEY, label, "price", "prediction")), "errors")


def error_rows(spark, sf_dir):
    errors = _winery_errors(spark, sf_dir)
    return errors.select(KEY, "label", *[F.round(c, 6).alias(c) for c in ("price", "prediction", "error", "abs_error")])


def error_bands(spark, sf_dir):
    return evaluate.error_bands(_winery_errors(spark, sf_dir))


def error_direction(spark, sf_dir):
    return evaluate.error_direction(_winery_errors(spark, sf_dir))


def error_summary(spark, sf_dir):
    return evaluate.error_summary(_winery_errors(spark, sf_dir))


def error_histogram(spark, sf_dir):
    return profile.histogram(_winery_errors(spark, sf_dir), "error", 10).select("bin", "n")


def price_by_error_direction(spark, sf_dir):
    return evaluate.price_by_direction(_winery_errors(spark, sf_dir))


def bias_by_score(spark, sf_dir):
    return evaluate.bias_by_score(_winery_errors(spark, sf_dir))


def calibration_bins(spark, sf_dir):
    return evaluate.calibration_bins(_winery_errors(spark, sf_dir))


def axis_bounds(spark, sf_dir):
    bounds = evaluate.axis_bounds(_winery_errors(spark, sf_dir))
    return bounds.select(*[F.round(c, 6).alias(c) for c in bounds.columns])


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        normalize_categories, fold_documents, title_year, title_clean, title_geo_mismatch, implication_violations,
        document_tokens, document_words, document_normalized, csv_scan, csv_malformed, fold_symbols,
        profile_columns, distinct_estimates, value_counts_all, value_counts, year_counts, event_counts, points_histogram, price_histogram,
        lineitem_histogram, histogram_nan,
        split_prefix, split_stored, split_hash, split_gaps, sample_rows, kfold_assign, kfold_gaps, ordered_positions,
        impute_median, event_median, target_mean_table, target_mean_encode, target_mean_out_of_fold, label_mean_encode, lineitem_mean_encode,
        pool_rare, pool_rare_fitted, one_hot,
        tfidf_raw, tfidf_sublinear, topic_weights, topic_top_terms,
        assemble_features, feature_names, rf_predict, rfe_support, rfecv_scores, search_results,
        feature_importance_topk, top_topic_words, pruned_error_summary,
        topic_checks, feature_checks, forest_checks, search_checks,
        error_rows, error_bands, error_direction, error_summary, error_histogram, price_by_error_direction,
        bias_by_score, calibration_bins, axis_bounds,
    )
}
