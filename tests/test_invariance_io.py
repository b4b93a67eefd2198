"""Repartition invariance, payload parsing, sinks and job runners end to end."""

import json
import os

import pytest
from pyspark.sql import functions as F

from shoplens.operators import models as M
from shoplens.operators import prep as P
from shoplens.operators import sampling as S
from shoplens.operators import sentiment as R
from shoplens.plans import catalog, jobs
from shoplens.sinks import write_csv, write_results
from shoplens.sources import fixtures as X
from shoplens.sources import weather as SW
from shoplens.sources.files import read_results

SF = "/root/testdata/sf0.001"


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("n", [1, 7])
def test_sampling_and_keywords_do_not_depend_on_partitioning(spark, n):
    clean = catalog.clean_reviews(spark, SF)
    re = clean.repartition(n)
    f = {0: 0.5, 1: 0.5, 2: 0.2}
    assert as_set(S.stratified_sample(clean, "sentiment_label", f, "doc_id").select("doc_id")) == \
        as_set(S.stratified_sample(re, "sentiment_label", f, "doc_id").select("doc_id"))
    assert as_set(S.with_split(clean, "doc_id").select("doc_id", "split")) == \
        as_set(S.with_split(re, "doc_id").select("doc_id", "split"))
    assert as_set(R.top_keywords(clean, 20)) == as_set(R.top_keywords(re, 20))


@pytest.mark.parametrize("n", [1, 5])
def test_money_results_do_not_depend_on_partitioning(spark, n):
    from shoplens.operators import behaviour as B

    ev = X.shop_events(spark, SF)
    a = B.category_behaviour(P.clean_events(ev, max_events=5))
    b = B.category_behaviour(P.clean_events(ev.repartition(n), max_events=5))
    assert as_set(a) == as_set(b)


def test_weather_payload_roundtrip_missing_key_and_sentinel(spark):
    payload = {"properties": {"parameter": {
        "T2M": {"20191001": 20.5, "20191002": -999.0},
        "PRECTOTCORR": {"20191001": 1.5, "20191002": 0.0},
        "WS2M": {"20191001": 3.0},
        "RH2M": {"20191002": 60.0},
    }}}
    df = spark.createDataFrame([("Chicago", json.dumps(payload))], "city string, payload string")
    rows = {str(r.date): r for r in SW.flatten_weather_payload(df).collect()}
    assert set(rows) == {"2019-10-01", "2019-10-02"}
    a, b = rows["2019-10-01"], rows["2019-10-02"]
    assert (a.temperature, a.precipitation, a.wind_speed, a.humidity) == (20.5, 1.5, 3.0, None)
    assert (b.temperature, b.wind_speed, b.humidity) == (None, None, 60.0)
    coords = SW.attach_city_coordinates(SW.flatten_weather_payload(df), SW.city_dimension(spark))
    assert {r.latitude for r in coords.collect()} == {41.8781}


def test_results_store_is_idempotent(spark, tmp):
    store = os.path.join(tmp, "store")
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    write_results(df, store, "a")
    write_results(df, store, "a")
    write_results(df.limit(2), store, "b")
    assert read_results(spark, store, "a").count() == 5
    assert read_results(spark, store, "b").count() == 2
    assert set(read_results(spark, store, "a").columns) == {"id", "v", "analysis"}
    write_csv(df, os.path.join(tmp, "csv"), single_file=True)
    back = spark.read.option("header", True).csv(os.path.join(tmp, "csv"))
    assert back.count() == 5


def _write_lookalikes(spark, tmp):
    ev = X.shop_events(spark, SF).select(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss 'UTC'").alias("event_time"), "event_type",
        "product_id", F.lit(1).alias("category_id"), "category_code", F.lit("b").alias("brand"), "price",
        "user_id", "user_session")
    ev.write.option("header", True).csv(os.path.join(tmp, "events"))
    X.order_purchases(spark, SF).select(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss 'UTC'").alias("event_time"), "event_type",
        F.lit(1).alias("product_id"), F.lit(1).alias("category_id"), F.lit(None).cast("string").alias("category_code"),
        F.lit("b").alias("brand"), "price", "user_id", F.lit("s").alias("user_session")) \
        .write.option("header", True).csv(os.path.join(tmp, "order_events"))
    X.reviews(spark, SF).drop("doc_id").withColumn("review_id", F.monotonically_increasing_id()) \
        .write.json(os.path.join(tmp, "reviews"))
    X.weather(spark, SF).select("date", "city", F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"),
                                "temperature", "precipitation", "wind_speed", "humidity") \
        .write.option("header", True).csv(os.path.join(tmp, "weather"))


def test_jobs_end_to_end_twice(spark, tmp):
    _write_lookalikes(spark, tmp)
    store = os.path.join(tmp, "store")
    for _ in range(2):
        r1 = jobs.behaviour_job(spark, os.path.join(tmp, "events"), store=store, csv_dir=os.path.join(tmp, "out"))
        r3 = jobs.weather_job(spark, os.path.join(tmp, "order_events"), os.path.join(tmp, "weather"), store=store)
    assert read_results(spark, store, "category_behaviour").count() == r1["category_behaviour"].count()
    assert read_results(spark, store, "regression_metrics").count() == 1
    assert read_results(spark, store, "correlation_matrix").count() == 36
    assert r3["daily_joined_data"].count() > 0
    assert os.path.isdir(os.path.join(tmp, "out", "analysis1_funnel"))


def test_sentiment_job_end_to_end(spark, tmp):
    from shoplens.settings import Settings

    _write_lookalikes(spark, tmp)
    store = os.path.join(tmp, "store")
    settings = Settings(sample_fractions={0: 1.0, 1: 1.0, 2: 1.0}, min_doc_freq=1)
    for _ in range(2):
        r2 = jobs.sentiment_job(spark, os.path.join(tmp, "reviews"), store=store, settings=settings)
    n = r2["rating_distribution"].agg(F.sum("review_count")).first()[0]
    assert n == catalog.clean_reviews(spark, SF).count()
    assert read_results(spark, store, "top_keywords").count() == r2["top_keywords"].count()
    assert read_results(spark, store, "classifier_results").count() == r2["classifier_results"].count()


def test_regression_recovers_noise_free_coefficients(spark):
    rows = [(i, 1.0 * i, float(i % 7), float((i * 3) % 11), float((i * 5) % 13)) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, avg_temperature double, avg_precipitation double, "
                                     "avg_wind_speed double, avg_humidity double")
    df = df.withColumn("purchase_count", (F.col("avg_temperature") * 2 + F.col("avg_precipitation") * 3
                                          - F.col("avg_wind_speed") + 10).cast("long"))
    r = M.regression_metrics(df, key="k", reg_param=0.0).collect()[0]
    assert r.r2 > 0.999
    assert abs(r.coeff_temp - 2) < 1e-2 and abs(r.coeff_precip - 3) < 1e-2 and abs(r.coeff_wind + 1) < 1e-2


def test_classifier_beats_majority_on_separable_text(spark):
    pos = ["great wonderful excellent product love", "amazing great quality love happy"]
    neg = ["broken terrible waste refund awful", "awful broken return waste garbage"]
    rows = []
    for i in range(300):
        label = i % 2
        text = (pos if label else neg)[i % 2 == 0 and 1 or 0]
        rows.append((i, 5.0 if label else 1.0, text + f" item{i % 5}", 2 if label else 0, "Electronics"))
    df = spark.createDataFrame(rows, "doc_id long, rating double, review_clean string, sentiment_label int, "
                                     "category string")
    out = M.classifier_results(df, key="doc_id", fractions={0: 1.0, 2: 1.0}, min_doc_freq=1)
    acc = out.select("model_accuracy").first()[0]
    assert acc > 0.9
    assert out.count() == out.filter(F.col("correct").isin(0, 1)).count()


def test_weather_ingest_job_from_payload_files(spark, tmp):
    src = os.path.join(tmp, "payloads")
    os.makedirs(src)
    for city, t in (("Chicago", 5.5), ("Phoenix", 30.0)):
        payload = {"properties": {"parameter": {
            "T2M": {"20191001": t, "20191002": -999.0},
            "PRECTOTCORR": {"20191001": 2.0, "20191002": 0.5},
            "WS2M": {"20191001": 3.0, "20191002": 4.0},
            "RH2M": {"20191001": 40.0},
        }}}
        with open(os.path.join(src, f"{city}.json"), "w") as fh:
            json.dump(payload, fh)
    out = jobs.weather_ingest_job(spark, src, os.path.join(tmp, "weather"))
    rows = {(r.city, str(r.date)): r for r in out.collect()}
    assert len(rows) == 4
    assert rows[("Chicago", "2019-10-01")].temperature == 5.5
    assert rows[("Chicago", "2019-10-01")].latitude == 41.8781
    assert rows[("Phoenix", "2019-10-02")].temperature is None
    assert rows[("Phoenix", "2019-10-02")].humidity is None
    from shoplens.operators import weather as W

    daily = {str(r.date): r for r in W.daily_weather(P.null_sentinel(out, list(W.MEASURES))).collect()}
    assert daily["2019-10-01"].rain_day == 1 and daily["2019-10-01"].avg_temperature == 17.75


def test_cluster_conf_and_checkpoint_dir(spark):
    from shoplens.session import checkpoint_dir, cluster_conf

    conf = cluster_conf(shuffle_partitions=4000)
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert conf["spark.sql.shuffle.partitions"] == "4000"
    assert checkpoint_dir(spark)  # read from the session (set by the test fixture)


def test_malformed_payload_dates_and_json_do_not_fail(spark):
    good = {"properties": {"parameter": {"T2M": {"20191001": 1.0, "2019-10-02": 2.0}}}}
    df = spark.createDataFrame([("A", json.dumps(good)), ("B", "{not json")], "city string, payload string")
    rows = SW.flatten_weather_payload(df).collect()
    assert sorted((r.city, str(r.date), r.temperature) for r in rows) == \
        [("A", "2019-10-01", 1.0), ("A", "None", 2.0)]


def test_empty_training_data_gives_a_clear_error(spark):
    df = spark.createDataFrame([(1, 5.0, "some review text", 2, "Electronics")],
                               "doc_id long, rating double, review_clean string, sentiment_label int, category string")
    with pytest.raises(ValueError, match="training sample is empty"):
        M.classifier_results(df, key="doc_id", fractions={2: 0.0})


def test_csv_columns_are_taken_by_name(spark, tmp):
    """A header in another order, and extra columns, load right; a header
    without a declared column fails."""
    from shoplens.operators import prep
    from shoplens.schemas import SHOP_EVENTS
    from shoplens.sources.files import read_shop_events

    names = SHOP_EVENTS.fieldNames()
    row = {"event_time": "2019-10-01 10:00:00 UTC", "event_type": "view", "product_id": "1", "price": "2.5", "user_id": "3",
           "user_session": "s", "category_code": "a.b", "brand": "b", "category_id": "9"}
    os.makedirs(f"{tmp}/in")
    with open(f"{tmp}/in/a.csv", "w") as f:
        order = ["extra", *reversed(names)]
        f.write(",".join(order) + "\n" + ",".join(row.get(n, "x") for n in order) + "\n")
    df = read_shop_events(spark, f"{tmp}/in/*.csv")
    assert df.schema == SHOP_EVENTS and prep.prepare_events(df).count() == 1
    assert df.first()["event_type"] == "view" and df.first()["price"] == 2.5
    with open(f"{tmp}/in/b.csv", "w") as f:  # another header than the first file's
        f.write(",".join(names) + "\n" + ",".join(row[n] for n in names) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_shop_events(spark, f"{tmp}/in/*.csv").collect()
    with open(f"{tmp}/c.csv", "w") as f:
        f.write("event_time,event_type\nx,y\n")
    with pytest.raises(ValueError, match="lacks"):
        read_shop_events(spark, f"{tmp}/c.csv")


def test_an_empty_rerun_replaces_the_stored_rows(spark, tmp):
    df = spark.createDataFrame([(i, "x") for i in range(5)], "n long, t string")
    write_results(df, f"{tmp}/store", "some")
    write_results(df, f"{tmp}/store", "other")
    write_results(df.filter("n > 9"), f"{tmp}/store", "some")
    assert read_results(spark, f"{tmp}/store", "some").count() == 0
    assert read_results(spark, f"{tmp}/store", "other").count() == 5
    assert read_results(spark, f"{tmp}/store", "other", n=3, t="x").collect()[0].asDict() == {
        "n": 3, "t": "x", "analysis": "other"}
    assert read_results(spark, f"{tmp}/store").count() == 5
    assert read_results(spark, f"{tmp}/store", "never", n=1).count() == 0
    with pytest.raises(ValueError, match="label"):
        write_results(df, f"{tmp}/store", "../up")


def test_coefficients_are_named_by_their_features(spark):
    import datetime as dt

    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i % 7), float(i % 5), 3.0 * (i % 7) - 2.0 * (i % 5) + 1)
            for i in range(200)]
    df = spark.createDataFrame(rows, "event_date date, avg_humidity double, other double, purchase_count double")
    r = M.regression_metrics(df, key="event_date", features=["avg_humidity", "other"], reg_param=0.0).first().asDict()
    assert (r["coeff_humidity"], r["coeff_other"], r["intercept"]) == (3.0, -2.0, 1.0) and "coeff_temp" not in r


def test_word_weights_recompute_hashing_idf_and_accuracy(spark):
    """The classifier's deterministic half, from Spark's own output."""
    from collections import Counter

    from pyspark.ml.feature import IDF, HashingTF

    from shoplens.settings import ENGLISH_STOP_WORDS

    clean = catalog.clean_reviews(spark, SF)
    split = M.sample_split(clean, key="doc_id", fractions=catalog.FIXTURE_SAMPLE)
    texts = [[w for w in dict.fromkeys(r.review_clean.split()) if w not in set(ENGLISH_STOP_WORDS)]
             for r in split.filter("split = 'train'").collect()]
    df = Counter(w for t in texts for w in t)
    got = {r.word: r for r in M.word_weights(clean, key="doc_id", fractions=catalog.FIXTURE_SAMPLE).collect() if r.word}
    assert {w: r.doc_freq for w, r in got.items()} == dict(df)
    import math

    for w, n in df.items():
        want = round(math.log((len(texts) + 1) / (n + 1)), 6) if n >= 5 else 0.0
        assert abs(got[w].weight - want) < 2e-6
    # With as many features as nearly exclude collisions, Spark's IDF has these weights.
    frame = spark.createDataFrame([(t,) for t in texts], "words array<string>")
    tf = HashingTF(inputCol="words", outputCol="tf", numFeatures=1 << 20)
    idf = IDF(inputCol="tf", outputCol="x", minDocFreq=5).fit(tf.transform(frame)).idf.toArray()
    common = [w for w, n in df.most_common(50)]
    assert all(abs(idf[tf.indexOf(w)] - got[w].weight) < 0.05 for w in common)
    out = M.classifier_results(clean, key="doc_id", fractions=catalog.FIXTURE_SAMPLE).collect()
    assert {r.doc_id for r in out} == {r.doc_id for r in split.filter("split = 'test'").collect()}
    accuracy = sum(r.sentiment_label == r.prediction for r in out) / len(out)
    assert all(r.model_accuracy == round(accuracy + 1e-12, 4) for r in out)
    assert all(r.correct == (r.sentiment_label == r.prediction) for r in out)
