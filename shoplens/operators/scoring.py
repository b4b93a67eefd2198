"""M7–M9 as tables: the fitted classifier as rows that can be stored, and its
predictions as a join of hashed terms with them.

The model is (class, feature, weight): the coefficient times the feature's
inverse document frequency, one row for each that is not zero, and the
intercept of the class under the feature -1. It has at most classes x
features rows, whatever it was fitted on. A text's terms are (feature,
count), from the same hashing as the fit's.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..settings import DEFAULT, ENGLISH_STOP_WORDS
from .models import token_stages

INTERCEPT = -1
MODEL_SCHEMA = "class int, feature int, weight double"


def model_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Rows of a fitted ``model_stages`` pipeline (with or without IDF)."""
    fitted = model.stages[-1]
    weights = fitted.coefficientMatrix.toArray()
    if len(model.stages) > 2:
        weights = weights * model.stages[-2].idf.toArray()
    if len(weights) == 1:  # two classes: the margin of the second against the first
        weights = np.vstack([np.zeros_like(weights), weights])
        intercepts = [0.0, float(fitted.intercept)]
    else:
        intercepts = fitted.interceptVector.toArray().tolist()
    rows = [(int(c), int(f), float(weights[c, f])) for c, f in zip(*np.nonzero(weights))]
    rows += [(c, INTERCEPT, float(v)) for c, v in enumerate(intercepts)]
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def text_terms(texts: DataFrame, key: str, num_features: int = DEFAULT.num_features, text_col: str = "review_clean",
               stop_words: Sequence[str] | None = ENGLISH_STOP_WORDS) -> DataFrame:
    """(key, feature, count): the hashed terms of every text, as the
    classifier counts them (a text without words has the empty word)."""
    words = "words" if stop_words is not None else "words_raw"
    hashed = HashingTF(inputCol=words, outputCol="_tf", numFeatures=num_features)
    stages = PipelineModel(stages=[*token_stages(text_col, stop_words), hashed])
    # A sparse vector reads "(size,[features],[counts])".
    vector = F.col("_tf").cast("string")
    parts = [F.split(F.regexp_extract(vector, r"\[([^\]]*)\],\[([^\]]*)\]", g), ",") for g in (1, 2)]
    pairs = F.explode(F.arrays_zip(parts[0].alias("feature"), parts[1].alias("count")))
    return (stages.transform(texts).select(key, pairs.alias("t")).filter("t.feature <> ''")
            .select(key, F.col("t.feature").cast("int").alias("feature"), F.col("t.count").cast("double").alias("count")))


def score_texts(texts: DataFrame, model: DataFrame, key: str, num_features: int = DEFAULT.num_features,
                text_col: str = "review_clean", stop_words: Sequence[str] | None = ENGLISH_STOP_WORDS,
                stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> DataFrame:
    """(key, prediction, margin): the class of the greatest margin, the first
    one of equals, for every distinct key; margin is its lead over the next
    class. The terms meet the model in a broadcast join (its rows are bounded
    by classes x features), so one shuffle of partial sums is all."""
    terms = stage(text_terms(texts, key, num_features, text_col, stop_words), "text_terms")
    weights = F.broadcast(model.filter(F.col("feature") != INTERCEPT))
    sums = (terms.join(weights, "feature").groupBy(key, "class")
            .agg(F.sum(F.col("count") * F.col("weight")).alias("sum")))
    start = model.filter(F.col("feature") == INTERCEPT).agg(
        F.collect_list(F.struct("class", F.col("weight").alias("sum")))).scalar()
    each = texts.select(key).distinct().select(key, F.inline(start))
    margins = each.unionByName(sums).groupBy(key, "class").agg(F.sum("sum").alias("margin"))
    # Descending by margin, ascending by class.
    best = F.sort_array(F.collect_list(F.struct("margin", (-F.col("class")).alias("other"))), asc=False)
    return margins.groupBy(key).agg(best.alias("best")).select(
        key, (-F.col("best")[0]["other"]).alias("prediction"),
        (F.col("best")[0]["margin"] - F.get("best", F.lit(1))["margin"]).alias("margin"))
