"""DuckDB SQL equal to each registered query (the correctness oracle).

The SQL rebuilds the fixture views (``sources.fixtures``) as CTEs and then
states each operator's semantics directly. Exactness rules shared with the
Spark side: money summed as DECIMAL(28,8), means as one double division,
percentages as HALF_UP integer division, counts and small ints cast to
Spark's types.
"""

from __future__ import annotations

from itertools import combinations

from ..functions.columns import hash_threshold
from ..operators.models import COEFFICIENT_NAMES, REGRESSION_FEATURES
from ..operators.weather import CORRELATION_COLUMNS
from ..settings import DEFAULT, ENGLISH_STOP_WORDS
from ..sources.fixtures import (
    CITIES_SQL,
    EVENT_FAULTS,
    ORDER_PURCHASES_SQL,
    REVIEW_FAULTS,
    REVIEWS_SQL,
    SHOP_EVENTS_SQL,
    WEATHER_SQL,
)
from .catalog import FIXTURE_MAX_EVENTS, FIXTURE_SAMPLE

MONEY = "DECIMAL(28,8)"
WS = r"[ \t\n\x0B\f\r]"  # Java's \s, spelled out for RE2


def pct(part: str, whole: str) -> str:
    """round(100 * part / whole, 2), half away from zero, for either sign."""
    p, w = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    return (f"(CASE WHEN ({p} < 0) <> ({w} < 0) THEN -1 ELSE 1 END * ((abs({p}) * 20000 + abs({w})) "
            f"// NULLIF(abs({w}) * 2, 0)) / 100.0::DOUBLE + 0.0::DOUBLE)")


def units(x: str) -> str:
    """Money as a whole number of its smallest unit."""
    return f"CAST(CAST({x} AS DECIMAL(28,8)) * 100000000::DECIMAL(10,0) AS HUGEINT)"


def mean(total: str, n: str) -> str:
    return f"CAST({total} AS DOUBLE) / NULLIF(CAST({n} AS DOUBLE), 0)"


def msum(x: str) -> str:
    return f"sum(CAST({x} AS {MONEY}))"


def mcount(x: str) -> str:
    return f"count(CAST({x} AS {MONEY}))"


def key_hash(key: str, salt: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{salt}'), 1, 8) AS BIGINT)"


def sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def weekday_name(d: str) -> str:
    return (f"CASE WHEN {d} = 1 THEN 'Sunday' WHEN {d} = 2 THEN 'Monday' WHEN {d} = 3 THEN 'Tuesday' "
            f"WHEN {d} = 4 THEN 'Wednesday' WHEN {d} = 5 THEN 'Thursday' WHEN {d} = 6 THEN 'Friday' "
            f"ELSE 'Saturday' END")


def q(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body.strip()


# RQ1 ------------------------------------------------------------------------
PREPARED = """
prepared AS (
  SELECT *, CAST(hour(event_time) AS INTEGER) AS event_hour,
         CAST(dayofweek(event_time) + 1 AS INTEGER) AS event_weekday,
         CAST(event_time AS DATE) AS event_date,
         CAST(month(event_time) AS INTEGER) AS event_month,
         split_part(category_code, '.', 1) AS category_top
  FROM shop_events
  WHERE event_type IS NOT NULL AND product_id IS NOT NULL AND event_time IS NOT NULL
)"""
SESSIONS = """
sessions AS (
  SELECT user_session, count(*) AS event_count FROM prepared
  WHERE user_session IS NOT NULL GROUP BY user_session
)"""
CLEAN_EVENTS = f"""
clean_events AS (
  SELECT * FROM prepared
  WHERE user_session IN (SELECT user_session FROM sessions WHERE event_count <= {FIXTURE_MAX_EVENTS})
)"""
EV = (SHOP_EVENTS_SQL, PREPARED, SESSIONS, CLEAN_EVENTS)

CATEGORY = f"""
cat AS (
  SELECT category_top, count(*) AS total_purchases, {msum('price')} AS rev,
         {mcount('price')} AS n_priced, count(DISTINCT user_id) AS unique_buyers
  FROM clean_events WHERE event_type = 'purchase' AND category_top IS NOT NULL
  GROUP BY category_top
),
category_behaviour AS (
  SELECT category_top, total_purchases, CAST(rev AS DOUBLE) AS total_revenue,
         {mean('rev', 'n_priced')} AS avg_price, unique_buyers,
         CAST(rank() OVER (ORDER BY rev DESC) AS INTEGER) AS revenue_rank,
         {pct(units('rev'), units('sum(rev) OVER ()'))} AS revenue_share_pct
  FROM cat
)"""

HOURLY = f"""
hourly AS (
  SELECT event_hour, count(*) AS purchase_count, CAST({msum('price')} AS DOUBLE) AS total_revenue,
         {mean(msum('price'), mcount('price'))} AS avg_order_value
  FROM clean_events WHERE event_type = 'purchase' GROUP BY event_hour
)"""

WEEKDAY = f"""
weekday AS (
  SELECT event_weekday, count(*) AS purchase_count, CAST({msum('price')} AS DOUBLE) AS total_revenue,
         {weekday_name('event_weekday')} AS weekday_name
  FROM clean_events WHERE event_type = 'purchase' GROUP BY event_weekday
)"""

JUDGED_EVENTS = f"""
judged_events AS (
  SELECT CASE WHEN event_id % {EVENT_FAULTS["cut"]} = 0 THEN 'malformed' ELSE problems[1] END AS reason,
         CASE WHEN event_id % {EVENT_FAULTS["cut"]} = 0 THEN 'malformed,unparsable:event_time,missing:product_id'
              ELSE array_to_string(problems, ',') END AS problems,
         CASE WHEN event_id % {EVENT_FAULTS["cut"]} = 0 THEN 'cut off,' ELSE '' END || CAST(event_id AS VARCHAR) AS source
  FROM (SELECT event_id, list_filter([
          CASE WHEN event_id % {EVENT_FAULTS["time"]} = 0 THEN 'unparsable:event_time'
               WHEN event_time IS NULL THEN 'missing:event_time' END,
          CASE WHEN event_id % {EVENT_FAULTS["type"]} = 0 OR event_type IS NULL THEN 'missing:event_type' END,
          CASE WHEN product_id IS NULL THEN 'missing:product_id' END,
          CASE WHEN event_id % {EVENT_FAULTS["price"]} = 0 THEN 'unparsable:price' END],
          lambda x: x IS NOT NULL) AS problems FROM shop_events)
)"""

CHART_ORDER = ("CASE weekday_name WHEN 'Monday' THEN 1 WHEN 'Tuesday' THEN 2 WHEN 'Wednesday' THEN 3 "
               "WHEN 'Thursday' THEN 4 WHEN 'Friday' THEN 5 WHEN 'Saturday' THEN 6 WHEN 'Sunday' THEN 7 END")

PEAK_WIDTH = 2


def _rq1() -> dict[str, str]:
    w = PEAK_WIDTH
    return {
        "clean_events": q(*EV, body="SELECT * FROM clean_events"),
        "prefiltered_events": q(*EV, body="SELECT * FROM clean_events"),
        "user_spans": q(*EV, body="""
            SELECT event_type, span, count(DISTINCT user_id) AS unique_users
            FROM (SELECT event_type, user_id, unnest([strftime(event_date, '%Y-%m'), strftime(event_date, '%Y'), 'all']) AS span
                  FROM clean_events WHERE event_date IS NOT NULL) GROUP BY event_type, span"""),
        "bot_filtered_sessions": q(SHOP_EVENTS_SQL, PREPARED, SESSIONS, body=f"""
            SELECT user_session, event_count, event_count > {FIXTURE_MAX_EVENTS} AS is_bot FROM sessions"""),
        "event_distribution": q(*EV, body="""
            SELECT event_type, count(*) AS event_count, count(DISTINCT user_id) AS unique_users
            FROM clean_events GROUP BY event_type"""),
        "conversion_funnel": q(*EV, body=f"""
            SELECT views + carts + purchases AS total_events, views, carts, purchases,
                   coalesce({pct('carts', 'views')}, 0.0::DOUBLE) AS cart_conversion_rate,
                   coalesce({pct('purchases', 'views')}, 0.0::DOUBLE) AS purchase_conversion_rate
            FROM (SELECT CAST(count_if(event_type = 'view') AS BIGINT) AS views,
                         CAST(count_if(event_type = 'cart') AS BIGINT) AS carts,
                         CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchases
                  FROM clean_events)"""),
        "category_behaviour": q(*EV, CATEGORY, body="SELECT * FROM category_behaviour"),
        "top_categories": q(*EV, CATEGORY, body="""
            SELECT category_top, sum(total_revenue) AS total_revenue FROM category_behaviour
            WHERE category_top IS NOT NULL GROUP BY category_top
            ORDER BY total_revenue DESC, category_top LIMIT 10"""),
        "category_preview": q(*EV, CATEGORY, body="SELECT * FROM category_behaviour WHERE revenue_rank <= 10"),
        "hourly_patterns": q(*EV, HOURLY, body="SELECT * FROM hourly"),
        "daily_patterns": q(*EV, WEEKDAY, body="SELECT * FROM weekday"),
        "daily_trend": q(*EV, body=f"""
            SELECT event_date, count(*) AS daily_purchases, CAST({msum('price')} AS DOUBLE) AS daily_revenue,
                   count(DISTINCT user_id) AS active_buyers
            FROM clean_events WHERE event_type = 'purchase' GROUP BY event_date"""),
        "chart_hourly": q(*EV, HOURLY, body="SELECT event_hour, purchase_count FROM hourly ORDER BY event_hour"),
        "chart_weekday": q(*EV, WEEKDAY, body=f"""
            SELECT weekday_name, purchase_count, CAST({CHART_ORDER} AS INTEGER) AS day_order,
                   weekday_name IN ('Saturday', 'Sunday') AS is_weekend
            FROM weekday ORDER BY day_order"""),
        "weekend_uplift": q(*EV, """
            d AS (SELECT event_date, count(*) AS n,
                         dayofweek(event_date) IN (0, 6) AS is_weekend
                  FROM clean_events WHERE event_type = 'purchase' AND event_date IS NOT NULL
                  GROUP BY event_date)""", """
            s AS (SELECT CAST(sum(CASE WHEN is_weekend THEN n END) AS BIGINT) AS s_we,
                         CAST(count_if(is_weekend) AS BIGINT) AS d_we,
                         CAST(sum(CASE WHEN NOT is_weekend THEN n END) AS BIGINT) AS s_wd,
                         CAST(count_if(NOT is_weekend) AS BIGINT) AS d_wd FROM d)""", body=f"""
            SELECT {mean('s_we', 'd_we')} AS weekend_avg_daily_purchases,
                   {mean('s_wd', 'd_wd')} AS weekday_avg_daily_purchases,
                   d_we AS weekend_days, d_wd AS weekday_days,
                   {pct('s_we * d_wd - s_wd * d_we', 's_wd * d_we')} AS weekend_uplift_pct
            FROM s"""),
        "peak_hours": q(*EV, """
            h AS (SELECT event_hour, count(*) AS n FROM clean_events
                  WHERE event_type = 'purchase' AND event_hour IS NOT NULL GROUP BY event_hour)""", f"""
            w AS (SELECT peak_start_hour, sum(n) AS window_purchases FROM (
                    SELECT unnest(generate_series(greatest(event_hour - {w - 1}, 0), least(event_hour, {24 - w})))
                           AS peak_start_hour, n FROM h)
                  GROUP BY peak_start_hour)""", body=f"""
            SELECT CAST(peak_start_hour AS INTEGER) AS peak_start_hour,
                   CAST(peak_start_hour + {w} AS INTEGER) AS peak_end_hour,
                   CAST(window_purchases AS BIGINT) AS window_purchases,
                   {pct('window_purchases', '(SELECT sum(n) FROM h)')} AS window_share_pct
            FROM w ORDER BY window_purchases DESC, peak_start_hour LIMIT 1"""),
        "event_lines": q(SHOP_EVENTS_SQL, body="""
            SELECT strftime(event_time, '%Y-%m-%d %H:%M:%S') || ' UTC' AS event_time, event_type, product_id,
                   product_id * 10 AS category_id, category_code, split_part(category_code, '.', -1) AS brand,
                   price, user_id, user_session
            FROM shop_events"""),
        "event_outcomes": q(SHOP_EVENTS_SQL, JUDGED_EVENTS, body="""
            SELECT coalesce(reason, 'kept') AS outcome, count(*) AS row_count FROM judged_events GROUP BY 1"""),
        "rejected_events": q(SHOP_EVENTS_SQL, JUDGED_EVENTS, body="SELECT * FROM judged_events WHERE reason IS NOT NULL"),
        "stored_results": q(*EV, HOURLY, body="""
            SELECT 'hourly_patterns' AS analysis, CAST(event_hour AS VARCHAR) AS key, purchase_count AS events FROM hourly
            UNION ALL
            SELECT 'event_distribution', event_type, count(*) FROM clean_events
            WHERE event_type = 'purchase' GROUP BY event_type"""),
        "category_profile": q(SHOP_EVENTS_SQL, PREPARED, body=f"""
            SELECT category_top, count(*) AS event_count,
                   {pct('count(*)', 'sum(count(*)) OVER ()')} AS share_pct
            FROM prepared GROUP BY category_top"""),
    }


# RQ2 ------------------------------------------------------------------------
CLEAN_REVIEWS = f"""
clean_reviews AS (
  SELECT *, CAST(CASE WHEN rating <= 2 THEN 0 WHEN rating = 3 THEN 1 ELSE 2 END AS INTEGER) AS sentiment_label,
         CAST(epoch_ms(timestamp) AS DATE) AS review_date, '{DEFAULT.review_category}' AS category
  FROM (
    SELECT *, regexp_replace(lower(review_text), '[^a-zA-Z \\t\\n\\x0B\\f\\r]+', '', 'g') AS review_clean
    FROM (SELECT *, concat_ws(' ', coalesce(title, ''), coalesce(text, '')) AS review_text FROM reviews)
  )
  WHERE rating IS NOT NULL AND review_clean IS NOT NULL AND length(review_clean) >= {DEFAULT.min_review_length}
    AND rating BETWEEN {DEFAULT.min_rating} AND {DEFAULT.max_rating}
)"""
RV = (REVIEWS_SQL, CLEAN_REVIEWS)


def _keywords(n: int) -> str:
    return q(*RV, f"""
        words AS (
          SELECT CASE sentiment_label WHEN 2 THEN 'positive' ELSE 'negative' END AS sentiment_group,
                 unnest(regexp_split_to_array(review_clean, '{WS}')) AS word
          FROM clean_reviews WHERE sentiment_label IN (2, 0))""", f"""
        counts AS (
          SELECT sentiment_group, word, count(*) AS frequency FROM words
          WHERE length(word) >= {DEFAULT.keyword_min_length}
            AND lower(word) NOT IN ({sql_list(ENGLISH_STOP_WORDS)})
          GROUP BY sentiment_group, word)""", body=f"""
        SELECT word, frequency, sentiment_group FROM (
          SELECT *, row_number() OVER (PARTITION BY sentiment_group ORDER BY frequency DESC, word) AS rn
          FROM counts) WHERE rn <= {n}""")


def _rq2() -> dict[str, str]:
    sample_h = key_hash("doc_id", f"sample-{DEFAULT.seed}")
    split_h = key_hash("doc_id", f"split-{DEFAULT.seed}")
    split = f"CASE WHEN {split_h} < {hash_threshold(DEFAULT.train_fraction)} THEN 'train' ELSE 'test' END"
    keep = " OR ".join(f"(sentiment_label = {v} AND {sample_h} < {hash_threshold(f)})"
                       for v, f in FIXTURE_SAMPLE.items())
    return {
        "clean_reviews": q(*RV, body="SELECT * FROM clean_reviews"),
        "review_outcomes": q(REVIEWS_SQL, body=f"""
            SELECT outcome, count(*) AS row_count FROM (
              SELECT CASE WHEN doc_id % {REVIEW_FAULTS["cut"]} = 0 THEN 'malformed'
                          WHEN doc_id % {REVIEW_FAULTS["rating"]} = 0 THEN 'unparsable:rating'
                          WHEN doc_id % {REVIEW_FAULTS["high"]} = 0 THEN 'out_of_range'
                          WHEN rating IS NULL THEN 'missing:rating'
                          WHEN NOT rating BETWEEN {DEFAULT.min_rating} AND {DEFAULT.max_rating} THEN 'out_of_range'
                          WHEN length(regexp_replace(lower(concat_ws(' ', coalesce(title, ''), coalesce(text, ''))),
                                      '[^a-zA-Z \\t\\n\\x0B\\f\\r]+', '', 'g')) < {DEFAULT.min_review_length}
                          THEN 'too_short' ELSE 'kept' END AS outcome FROM reviews) GROUP BY 1"""),
        "rating_distribution": q(*RV, body=f"""
            SELECT rating, count(*) AS review_count, {pct('count(*)', 'sum(count(*)) OVER ()')} AS percentage
            FROM clean_reviews GROUP BY rating"""),
        "verified_stats": q(*RV, body=f"""
            SELECT verified_purchase, count(*) AS review_count, avg(rating) AS avg_rating,
                   {pct('count(*)', 'sum(count(*)) OVER ()')} AS percentage
            FROM clean_reviews GROUP BY verified_purchase"""),
        "monthly_trend": q(*RV, body="""
            SELECT strftime(review_date, '%Y-%m') AS year_month, count(*) AS review_count, avg(rating) AS avg_rating
            FROM clean_reviews WHERE review_date IS NOT NULL GROUP BY 1"""),
        "top_keywords": _keywords(50),
        "frequent_keywords": _keywords(50),
        "top_keywords_chart": _keywords(20),
        "chart_ratings": q(*RV, body="""
            SELECT CAST(rating AS VARCHAR) AS rating_label, rating, count(*) AS review_count
            FROM clean_reviews GROUP BY rating ORDER BY rating"""),
        "review_length_stats": q(*RV, body=f"""
            SELECT sentiment_label, count(*) AS review_count,
                   CAST(min(length(review_clean)) AS INTEGER) AS min_length,
                   {mean('sum(length(review_clean))', 'count(*)')} AS mean_length,
                   CAST(max(length(review_clean)) AS INTEGER) AS max_length
            FROM clean_reviews GROUP BY sentiment_label"""),
        "stratified_sample": q(*RV, body=f"""
            SELECT doc_id, rating, sentiment_label FROM clean_reviews WHERE {keep}"""),
        "review_lines": q(REVIEWS_SQL, body="""
            SELECT rating, title, text, asin, timestamp, helpful_vote, verified_purchase FROM reviews"""),
        "classifier_split": q(*RV, body=f"SELECT doc_id, sentiment_label, {split} AS split FROM clean_reviews WHERE {keep}"),
        "classifier_word_weights": q(*RV, f"""
            train AS (SELECT doc_id, review_clean FROM clean_reviews WHERE ({keep}) AND {split} = 'train')""", f"""
            words AS (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(rtrim(review_clean, chr(9) || chr(10) || chr(11)
                        || chr(12) || chr(13) || ' '), '{WS}')) AS word FROM train)""", f"""
            counts AS (SELECT word, count(*) AS doc_freq FROM words
                       WHERE word NOT IN ({sql_list(ENGLISH_STOP_WORDS)}) GROUP BY word)""", body=f"""
            SELECT word, doc_freq, CASE WHEN doc_freq >= {DEFAULT.min_doc_freq}
                   THEN round(ln((SELECT count(*) + 1 FROM train) / (doc_freq + 1)), 6) ELSE 0.0 END AS weight
            FROM counts"""),
        "train_test_split": q(*RV, body=f"""
            SELECT doc_id, sentiment_label,
                   {split} AS split
            FROM clean_reviews"""),
    }


# RQ3 ------------------------------------------------------------------------
WEATHER_CLEAN = """
weather_clean AS (
  SELECT date, city, nullif(temperature, -999.0) AS temperature, nullif(precipitation, -999.0) AS precipitation,
         nullif(wind_speed, -999.0) AS wind_speed, nullif(humidity, -999.0) AS humidity
  FROM weather
)"""
DAILY_PURCHASES = f"""
daily_exact AS (
  SELECT CAST(event_time AS DATE) AS event_date, count(*) AS purchase_count,
         {msum('price')} AS revenue, count(DISTINCT user_id) AS active_buyers,
         {mean(msum('price'), mcount('price'))} AS avg_order_value
  FROM order_purchases WHERE event_type = 'purchase' AND event_time IS NOT NULL GROUP BY 1
),
daily_purchases AS (
  SELECT event_date, purchase_count, CAST(revenue AS DOUBLE) AS daily_revenue, active_buyers, avg_order_value
  FROM daily_exact
)"""
DAILY_WEATHER = f"""
daily_weather AS (
  SELECT date, avg(temperature) AS avg_temperature, avg(precipitation) AS avg_precipitation,
         avg(wind_speed) AS avg_wind_speed, avg(humidity) AS avg_humidity,
         max(CASE WHEN precipitation > {DEFAULT.rain_threshold} THEN 1 ELSE 0 END) AS rain_day
  FROM weather_clean GROUP BY date
)"""
JOINED = """
joined_daily AS (
  SELECT p.*, w.avg_temperature, w.avg_precipitation, w.avg_wind_speed, w.avg_humidity, w.rain_day
  FROM daily_purchases p JOIN daily_weather w ON p.event_date = w.date
),
joined_exact AS (
  SELECT p.*, w.avg_temperature, w.rain_day FROM daily_exact p JOIN daily_weather w ON p.event_date = w.date
)"""
RAIN = f"""
rain AS (
  SELECT rain_day, avg(purchase_count) AS avg_daily_purchases,
         {mean('sum(revenue)', 'count(revenue)')} AS avg_daily_revenue,
         avg(active_buyers) AS avg_active_buyers, count(*) AS num_days,
         CASE WHEN rain_day = 1 THEN 'Rainy Day' ELSE 'Dry Day' END AS rain_label
  FROM joined_exact GROUP BY rain_day
)"""
WX = (ORDER_PURCHASES_SQL, WEATHER_SQL, WEATHER_CLEAN, DAILY_PURCHASES, DAILY_WEATHER, JOINED)


def _correlation() -> str:
    cols = list(CORRELATION_COLUMNS)
    ok = " AND ".join(f"{c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))" for c in cols)
    aggs = [f"stddev_pop(CAST({c} AS DOUBLE)) AS sd_{i}" for i, c in enumerate(cols)]
    aggs += [f"covar_pop(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS cv_{i}_{j}"
             for (i, a), (j, b) in combinations(list(enumerate(cols)), 2)]
    cells = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                v = "1.0::DOUBLE"
            else:
                x, y = min(i, j), max(i, j)
                v = (f"round(CASE WHEN sd_{x} * sd_{y} = 0 THEN 'NaN'::DOUBLE "
                     f"ELSE cv_{x}_{y} / (sd_{x} * sd_{y}) END, 4)")
            cells.append(f"SELECT '{a}' AS variable_1, '{b}' AS variable_2, {v} AS pearson_corr "
                         f"FROM m WHERE sd_0 IS NOT NULL")
    return q(*WX, f"m AS (SELECT {', '.join(aggs)} FROM joined_daily WHERE {ok})",
             body="\nUNION ALL\n".join(cells))


def _regression() -> str:
    """Ridge regression in closed form. With standardised features and label
    the normal equations are (R + reg / sd(y)) b = r, R and r being Pearson
    correlations; Gaussian elimination, one common table expression a step."""
    n = len(REGRESSION_FEATURES)
    ok = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in REGRESSION_FEATURES)
    split = f"{key_hash('event_date', f'split-{DEFAULT.seed}')} < {hash_threshold(DEFAULT.train_fraction)}"
    x = [f"x{i}" for i in range(n)]
    days = ("days AS (SELECT CAST(purchase_count AS DOUBLE) AS y, "
            + ", ".join(f"{c} AS {v}" for c, v in zip(REGRESSION_FEATURES, x))
            + f", {split} AS train FROM joined_daily WHERE {ok})")
    moments = ("mom AS (SELECT " + ", ".join(
        [f"avg({v}) AS m_{v}, stddev_pop({v}) AS s_{v}" for v in [*x, "y"]]
        + [f"covar_pop({x[i]}, {x[j]}) AS c_{i}_{j}" for i in range(n) for j in range(i, n)]
        + [f"covar_pop({x[i]}, y) AS c_{i}_{n}" for i in range(n)]) + " FROM days WHERE train)")
    cell = {(i, j): f"c_{min(i, j)}_{max(i, j)} / (s_x{i} * s_x{j})" for i in range(n) for j in range(n)}
    cell |= {(i, n): f"c_{i}_{n} / (s_x{i} * s_y)" for i in range(n)}
    steps = ["a0 AS (SELECT *, " + ", ".join(
        f"{cell[i, j]}{f' + {DEFAULT.regression_reg_param} / s_y' if i == j else ''} AS e0_{i}_{j}"
        for i in range(n) for j in range(n + 1)) + " FROM mom)"]
    for k in range(n):  # clear column k from all other rows
        steps.append(f"a{k + 1} AS (SELECT *, " + ", ".join(
            f"e{k}_{k}_{j} / e{k}_{k}_{k} AS e{k + 1}_{i}_{j}" if i == k else
            f"e{k}_{i}_{j} - e{k}_{i}_{k} * e{k}_{k}_{j} / e{k}_{k}_{k} AS e{k + 1}_{i}_{j}"
            for i in range(n) for j in range(n + 1)) + f" FROM a{k})")
    beta = ("beta AS (SELECT " + ", ".join(f"e{n}_{i}_{n} * s_y / s_x{i} AS b{i}" for i in range(n)) + ", m_y - ("
            + " + ".join(f"e{n}_{i}_{n} * s_y / s_x{i} * m_x{i}" for i in range(n)) + f") AS b FROM a{n})")
    error = "y - (" + " + ".join(f"b{i} * x{i}" for i in range(n)) + " + b)"
    names = [COEFFICIENT_NAMES[c] for c in REGRESSION_FEATURES]
    return q(*WX, days, moments, *steps, beta, f"""
        err AS (SELECT sum(({error}) * ({error})) AS sse, var_pop(y) * count(*) AS sst, count(*) AS n
                FROM days, beta WHERE NOT train)""", body=f"""
        SELECT 'LinearRegression' AS model, round(1.0 - sse / sst, 4) AS r2, round(sqrt(sse / n), 2) AS rmse,
               {", ".join(f"round(b{i}, 4) AS {c}" for i, c in enumerate(names))}, round(b, 4) AS intercept,
               n AS test_rows
        FROM err, beta""")


def _rq3() -> dict[str, str]:
    return {
        "sentinel_nulls": q(WEATHER_SQL, WEATHER_CLEAN, body="SELECT * FROM weather_clean"),
        "weather_lines": q(WEATHER_SQL, CITIES_SQL, body="""
            SELECT date, city, latitude, longitude, temperature, precipitation, wind_speed, humidity
            FROM weather LEFT JOIN cities USING (city)"""),
        "regression_metrics": _regression(),
        "weather_payload": q(WEATHER_SQL, CITIES_SQL, """
            wd AS (SELECT city, date, max(temperature) AS t, max(precipitation) AS p,
                          max(wind_speed) AS w, max(humidity) AS h FROM weather GROUP BY city, date)""", body="""
            SELECT city, date, nullif(t, -999.0) AS temperature, nullif(p, -999.0) AS precipitation,
                   nullif(w, -999.0) AS wind_speed,
                   CASE WHEN dayofmonth(date) = 1 THEN NULL ELSE nullif(h, -999.0) END AS humidity,
                   latitude, longitude
            FROM wd LEFT JOIN cities USING (city)"""),
        "daily_purchases": q(ORDER_PURCHASES_SQL, DAILY_PURCHASES, body="SELECT * FROM daily_purchases"),
        "daily_weather": q(WEATHER_SQL, WEATHER_CLEAN, DAILY_WEATHER, body="SELECT * FROM daily_weather"),
        "joined_daily": q(*WX, body="SELECT * FROM joined_daily"),
        "rain_analysis": q(*WX, RAIN, body="SELECT * FROM rain"),
        "temperature_buckets": q(*WX, body=f"""
            SELECT CASE WHEN avg_temperature < 0 THEN 'freezing' WHEN avg_temperature < 10 THEN 'cold'
                        WHEN avg_temperature < 20 THEN 'mild' WHEN avg_temperature < 30 THEN 'warm'
                        ELSE 'hot' END AS temp_bucket,
                   avg(purchase_count) AS avg_daily_purchases,
                   {mean('sum(revenue)', 'count(revenue)')} AS avg_daily_revenue,
                   count(*) AS days_in_group
            FROM joined_exact GROUP BY 1"""),
        "correlation_matrix": _correlation(),
        "stored_correlation": _correlation(),
        "stored_regression": _regression(),
        "rain_gap": q(*WX, """
            s AS (SELECT sum(CASE WHEN rain_day = 0 THEN purchase_count END) AS s_d,
                         count_if(rain_day = 0) AS n_d,
                         sum(CASE WHEN rain_day = 1 THEN purchase_count END) AS s_r,
                         count_if(rain_day = 1) AS n_r FROM joined_daily)""", body=f"""
            SELECT {mean('s_d', 'n_d')} AS dry_avg_daily_purchases,
                   {mean('s_r', 'n_r')} AS rainy_avg_daily_purchases,
                   {pct('s_d * n_r - s_r * n_d', 's_d * n_r')} AS rainy_fewer_pct,
                   {pct('s_d * n_r - s_r * n_d', 's_r * n_d')} AS dry_more_pct
            FROM s"""),
        "weather_coverage": q(WEATHER_SQL, WEATHER_CLEAN, body="""
            SELECT city, count(DISTINCT date) AS days_present, min(date) AS first_day, max(date) AS last_day,
                   count(*) AS observations,
                   CAST(count_if(temperature IS NULL) AS BIGINT) AS null_temperature,
                   CAST(count_if(precipitation IS NULL) AS BIGINT) AS null_precipitation,
                   CAST(count_if(wind_speed IS NULL) AS BIGINT) AS null_wind_speed,
                   CAST(count_if(humidity IS NULL) AS BIGINT) AS null_humidity
            FROM weather_clean GROUP BY city"""),
        "chart_rain": q(*WX, RAIN, body="""
            SELECT rain_day, rain_label, avg_daily_purchases, avg_daily_revenue FROM rain ORDER BY rain_day"""),
        "chart_purchases_temperature": q(*WX, body="""
            SELECT event_date, purchase_count, avg_temperature FROM joined_daily ORDER BY event_date"""),
    }


def row_counts_sql() -> str:
    # stage → columns that its frame has
    stages = {"shop_events": 8, "clean_events": 13, "reviews": 8, "clean_reviews": 13, "daily_purchases": 5,
              "daily_weather": 6, "joined_daily": 10}
    body = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS stage, count(*) AS row_count, {n}::BIGINT AS column_count FROM {t}" for t, n in stages.items())
    return q(*EV, *RV, *WX, body=body)


def oracle_sql() -> dict[str, str]:
    out = {**_rq1(), **_rq2(), **_rq3()}
    out["row_counts"] = row_counts_sql()
    out["exported_csv"] = out["daily_trend"]
    return out
