"""The TF-IDF sentiment classifier and the weather
regression, on Spark ML.

Fitting is the only place the library runs jobs while building a result
(ML estimators are eager). Predictions stay distributed; only the fitted
model's coefficients and the accuracy (a handful of numbers) come back to
the driver and are attached as literals. Regression metrics are a lazy
one-row aggregate over the test predictions.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Mapping, Sequence

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import DEFAULT, ENGLISH_STOP_WORDS
from .sampling import split_train_test, stratified_sample, with_split

REGRESSION_FEATURES: tuple[str, ...] = ("avg_temperature", "avg_precipitation", "avg_wind_speed", "avg_humidity")
COEFFICIENT_NAMES: Mapping[str, str] = dict(zip(
    REGRESSION_FEATURES, ("coeff_temp", "coeff_precip", "coeff_wind", "coeff_humidity")))
Stage = Callable[[DataFrame, str], DataFrame]


def token_stages(text_col: str = "review_clean",
                 stop_words: Sequence[str] | None = ENGLISH_STOP_WORDS) -> list:
    """M3–M4: lower-case whitespace tokens (``words_raw``), then stop words
    removed (``words``) unless ``stop_words`` is None."""
    stages = [Tokenizer(inputCol=text_col, outputCol="words_raw")]
    if stop_words is not None:
        stages.append(StopWordsRemover(inputCol="words_raw", outputCol="words",
                                       stopWords=list(stop_words), locale="en_US"))
    return stages


def model_stages(
    *,
    words_col: str = "words",
    label_col: str = "sentiment_label",
    num_features: int = DEFAULT.num_features,
    min_doc_freq: int = DEFAULT.min_doc_freq,
    max_iter: int = DEFAULT.classifier_max_iter,
    reg_param: float = DEFAULT.classifier_reg_param,
    use_idf: bool = True,
) -> list:
    """M5–M7: hashed term counts → (IDF) → multinomial logistic regression."""
    tf_out = "raw_features" if use_idf else "features"
    stages = [HashingTF(inputCol=words_col, outputCol=tf_out, numFeatures=num_features)]
    if use_idf:
        stages.append(IDF(inputCol="raw_features", outputCol="features", minDocFreq=min_doc_freq))
    stages.append(LogisticRegression(featuresCol="features", labelCol=label_col,
                                     maxIter=max_iter, regParam=reg_param))
    return stages


def sentiment_pipeline(
    *,
    text_col: str = "review_clean",
    stop_words: Sequence[str] | None = ENGLISH_STOP_WORDS,
    **model_kw,
) -> Pipeline:
    """M3–M7: tokens → (stop words out) → hashed term counts → (IDF) →
    multinomial logistic regression."""
    words = "words" if stop_words is not None else "words_raw"
    return Pipeline(stages=token_stages(text_col, stop_words) + model_stages(words_col=words, **model_kw))


def sample_split(reviews: DataFrame, *, key: str, fractions: Mapping[int, float] = DEFAULT.sample_fractions,
                 label_col: str = "sentiment_label", train_fraction: float = DEFAULT.train_fraction,
                 seed: int = DEFAULT.seed) -> DataFrame:
    """M1 + M2: the classifier's sample with a ``split`` column."""
    return with_split(stratified_sample(reviews, label_col, fractions, key, seed), key, train_fraction, seed)


def word_weights(reviews: DataFrame, *, key: str, fractions: Mapping[int, float] = DEFAULT.sample_fractions,
                 label_col: str = "sentiment_label", train_fraction: float = DEFAULT.train_fraction,
                 seed: int = DEFAULT.seed, min_doc_freq: int = DEFAULT.min_doc_freq, text_col: str = "review_clean",
                 stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> DataFrame:
    """M3–M6 by word, before hashing: in how many training texts each word
    stands and its weight ln((texts + 1) / (doc_freq + 1)), 0 below
    ``min_doc_freq``, 6 dp."""
    train = sample_split(reviews, key=key, fractions=fractions, label_col=label_col, train_fraction=train_fraction,
                         seed=seed).filter(F.col("split") == "train")
    tokens = PipelineModel(stages=token_stages(text_col, stop_words)).transform(train)
    words = tokens.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("doc_freq"))
    texts = train.agg(F.count(F.lit(1)).alias("texts")).scalar()
    weight = F.round(F.log((texts + 1) / (F.col("doc_freq") + 1)), 6)
    return words.select(
        "word", "doc_freq", F.when(F.col("doc_freq") >= min_doc_freq, weight).otherwise(0.0).alias("weight"))


def _in_place(df: DataFrame, name: str) -> DataFrame:
    return df


def _tokens(reviews: DataFrame, key: str, fractions: Mapping[int, float], label_col: str, train_fraction: float,
            seed: int, stop_words: Sequence[str] | None, stage: Stage) -> tuple[DataFrame, DataFrame]:
    """(train, test) of the sample, tokenised, with only the columns that the
    model and the report read. The IDF fit, the regression's passes and the
    predictions all read what ``stage`` returns."""
    sample = sample_split(reviews, key=key, fractions=fractions, label_col=label_col, train_fraction=train_fraction,
                          seed=seed)
    tokens = PipelineModel(stages=token_stages(stop_words=stop_words)).transform(sample)
    words = [c for c in ("words_raw", "words") if c in tokens.columns]
    tokens = stage(tokens.select(key, "rating", label_col, "category", "split", *words), "classifier_tokens")
    train, test = (tokens.filter(F.col("split") == x).drop("split") for x in ("train", "test"))
    _require_rows(train, "training sample is empty: raise the sample fractions or use more reviews")
    return train, test


def _require_rows(df: DataFrame, message: str) -> None:
    """Fail early with a clear message instead of inside the estimator
    (one-row probe; the model fits scan the data anyway)."""
    if df.isEmpty():
        raise ValueError(message)


def classifier_results(
    reviews: DataFrame,
    *,
    key: str,
    fractions: Mapping[int, float] = DEFAULT.sample_fractions,
    label_col: str = "sentiment_label",
    train_fraction: float = DEFAULT.train_fraction,
    seed: int = DEFAULT.seed,
    stop_words: Sequence[str] | None = ENGLISH_STOP_WORDS,
    stage: Stage = _in_place,
    **model_kw,
) -> DataFrame:
    """M1 + M2 + M7 + M8 + M9: sample per class, split by key, fit, and
    return the test predictions with a 0/1 ``correct`` flag and the test
    accuracy (4 dp) on every row.

    Nothing is cached here. ``stage`` (df, name) → df is the caller's way to
    materialise the tokenised sample and the predictions, such as
    ``session.stage_table``; without it both are computed anew where read."""
    train, test = _tokens(reviews, key, fractions, label_col, train_fraction, seed, stop_words, stage)
    words = "words" if stop_words is not None else "words_raw"
    model = Pipeline(stages=model_stages(words_col=words, label_col=label_col, **model_kw)).fit(train)
    pred = stage(model.transform(test).select(
        key, "rating", label_col, "prediction", "category",
        (F.col(label_col) == F.col("prediction")).cast("int").alias("correct"),
    ), "classifier_predictions")
    # One number, from the predictions as they are returned.
    accuracy = pred.agg(F.avg("correct")).first()[0]
    return pred.withColumn("model_accuracy", F.round(F.lit(accuracy).cast("double"), 4))


# Configurations compared by the ablation (name, use_idf, stop words, features)
ABLATION_GRID: tuple[tuple[str, bool, bool, int], ...] = (
    ("tfidf_stopwords_10000", True, True, 10_000),
    ("tf_stopwords_10000", False, True, 10_000),
    ("tfidf_all_words_10000", True, False, 10_000),
    ("tfidf_stopwords_1000", True, True, 1_000),
)


def classifier_ablation(
    reviews: DataFrame,
    *,
    key: str,
    fractions: Mapping[int, float] = DEFAULT.sample_fractions,
    label_col: str = "sentiment_label",
    train_fraction: float = DEFAULT.train_fraction,
    seed: int = DEFAULT.seed,
    grid: Sequence[tuple[str, bool, bool, int]] = ABLATION_GRID,
    stage: Stage = _in_place,
) -> DataFrame:
    """Test accuracy of each pipeline configuration on the same split.

    The sample is tokenised once (with and without stop words) and given to
    ``stage``, so each configuration only hashes, weights and fits. The fits
    do not depend on each other: their jobs are submitted side by side, from
    threads that inherit the session's properties."""
    train_t, test_t = _tokens(reviews, key, fractions, label_col, train_fraction, seed, ENGLISH_STOP_WORDS, stage)

    def fit(config: tuple[str, bool, bool, int]) -> PipelineModel:
        _, use_idf, stops, n_feat = config
        return Pipeline(stages=model_stages(words_col="words" if stops else "words_raw", label_col=label_col,
                                            use_idf=use_idf, num_features=n_feat)).fit(train_t)

    with ThreadPoolExecutor(max_workers=max(1, len(grid))) as pool:
        # A wrapper each: it carries this thread's properties over.
        models = [pool.submit(inheritable_thread_target(reviews.sparkSession)(fit), config) for config in grid]
        models = [m.result() for m in models]
    rows = None
    for (name, use_idf, stops, n_feat), model in zip(grid, models):
        acc = model.transform(test_t).agg(
            F.count(F.lit(1)).alias("test_rows"),
            F.round(F.avg((F.col(label_col) == F.col("prediction")).cast("int")), 4).alias("accuracy"),
        ).select(
            F.lit(name).alias("config"), F.lit(use_idf).alias("use_idf"),
            F.lit(stops).alias("stop_words_removed"), F.lit(n_feat).alias("num_features"),
            "test_rows", "accuracy",
        )
        rows = acc if rows is None else rows.unionByName(acc)
    return rows


def regression_metrics(
    joined: DataFrame,
    *,
    key: str,
    features: Sequence[str] = REGRESSION_FEATURES,
    label_col: str = "purchase_count",
    train_fraction: float = DEFAULT.train_fraction,
    seed: int = DEFAULT.seed,
    max_iter: int = DEFAULT.regression_max_iter,
    reg_param: float = DEFAULT.regression_reg_param,
    stage: Stage = _in_place,
) -> DataFrame:
    """M10 + M12 + M13: linear regression of daily purchases on the weather
    means (rows with a missing feature skipped), split by key; one row with
    test R² (4 dp), RMSE (2 dp), coefficients and intercept (4 dp). The
    default features have their fixed coefficient names, any other feature f
    gives ``coeff_f``.

    One row per day is given to ``stage``, so that the fit and the metrics
    need not each compute the join."""
    days = stage(joined.select(key, *features, F.col(label_col).cast("double").alias("label")), "regression_days")
    assembled = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip") \
        .transform(days).select(key, "features", "label")
    train, test = split_train_test(assembled, key, train_fraction, seed)
    _require_rows(train, "no training days: the purchase and weather dates do not overlap")
    model = LinearRegression(featuresCol="features", labelCol="label",
                             maxIter=max_iter, regParam=reg_param).fit(train)
    pred = model.transform(test)
    err = F.col("label") - F.col("prediction")
    m = pred.agg(
        F.sum(err * err).alias("sse"),
        (F.var_pop("label") * F.count(F.lit(1))).alias("sst"),
        F.count(F.lit(1)).alias("n"),
    )
    coeffs = {COEFFICIENT_NAMES.get(f, f"coeff_{f}"): float(c)
              for f, c in zip(features, model.coefficients.toArray(), strict=True)}
    return m.select(
        F.lit("LinearRegression").alias("model"),
        F.round(F.lit(1.0) - F.try_divide(F.col("sse"), F.col("sst")), 4).alias("r2"),
        F.round(F.sqrt(F.try_divide(F.col("sse"), F.col("n").cast("double"))), 2).alias("rmse"),
        *[F.round(F.lit(c), 4).alias(name) for name, c in coeffs.items()],
        F.round(F.lit(float(model.intercept)), 4).alias("intercept"),
        F.col("n").alias("test_rows"),
    )
