"""Plain SQL with the same results as the catalog, for an independent engine.

The statements are written from the definitions of the figures, not from the
Spark plans: windows where Spark uses sums, self-contained views, no shared code.
"""

from __future__ import annotations

from loanlens.config import AGE_BANDS, INCOME_BANDS, MODEL_FEATURES, NUMERIC_FEATURES, REASON_CODES, RISK_BANDS
from loanlens.plans.catalog import SCORECARD

_WEIGHTS = dict(SCORECARD.weights)


def _band_case(value: str, bands, closed: str) -> str:
    arms = []
    for label, low, high in bands:
        if closed == "right":
            test = f"{value} > {low} AND {value} <= {high}"
        elif high == float("inf"):
            test = f"{value} >= {low}"
        else:
            test = f"{value} >= {low} AND {value} < {high}"
        arms.append(f"WHEN {test} THEN '{label}'")
    return f"CASE {' '.join(arms)} END"


def _one_hot(column: str, bands) -> str:
    return ", ".join(
        f"CAST(CASE WHEN {column} = '{label}' THEN 1 ELSE 0 END AS INTEGER) "
        f'AS "{column}_{label}"'
        for label, _, _ in bands
    )


_ONE_HOT = f"{_one_hot('age_band', AGE_BANDS)}, {_one_hot('income_band', INCOME_BANDS)}"


def _log_odds(prefix: str = "") -> str:
    terms = "".join(
        f" + CAST({w} AS DOUBLE) * coalesce({prefix}\"{name}\", 0)" for name, w in _WEIGHTS.items()
    )
    return f"CAST({SCORECARD.intercept} AS DOUBLE){terms}"


def _fixed_log_odds() -> str:
    """Log-odds in millionths, of weights and features in thousandths."""
    terms = "".join(
        f" + {round(w * 1000)} * CAST(round_even(coalesce(\"{name}\", 0) * 1000.0::DOUBLE, 0) AS BIGINT)"
        for name, w in _WEIGHTS.items()
    )
    return f"{round(SCORECARD.intercept * 1_000_000)}{terms}"


def _score(p: str) -> str:
    safe = f"least(greatest({p}, 1e-6::DOUBLE), (1 - 1e-6)::DOUBLE)"
    raw = f"600 - 20 / ln(2) * ln(5) - 20 / ln(2) * ln({safe} / (1 - {safe}))"
    return f"CAST(least(greatest(round_even({raw}, 0), 300), 850) AS INTEGER)"


def _risk(score: str) -> str:
    arms = " ".join(
        f"WHEN {score} BETWEEN {low} AND {high} THEN '{label}'" for label, low, high in RISK_BANDS
    )
    return f"CASE {arms} ELSE 'Unknown' END"


def _target(definition: str) -> str:
    hard = "coalesce(upper(status) IN ('FPD', 'FMD'), false)"
    soft = {"par30": 30, "par60": 60, "par90": 90, "combined": 30}
    tests = []
    if definition in ("fpd_fmd", "combined"):
        tests.append(hard)
    if definition in soft:
        tests.append(f"coalesce(dpd, 0) > {soft[definition]}")
    return f"""
      SELECT LOAN_ID, CAST(CASE WHEN {' OR '.join(tests)} THEN 1 ELSE 0 END AS INTEGER) AS target
      FROM (SELECT LOAN_ID,
              arg_max(ACCOUNT_STATUS_L2, SNAPSHOT_DATE) AS status,
              arg_max(coalesce(DAYS_PAST_DUE, 0), SNAPSHOT_DATE) FILTER (WHERE dpd_given) AS dpd
            FROM credit GROUP BY LOAN_ID)"""


def _cell(seed: int) -> str:
    return f"(('0x' || substr(md5(LOAN_ID || '|{seed}'), 1, 8))::BIGINT % 1000000)"


# Views, each using only those before it.
_VIEWS: dict[str, str] = {
    "credit": """
      SELECT CAST(o_custkey AS VARCHAR) AS LOAN_ID,
        CAST(make_date(y, 12, 31) AS TIMESTAMP) AS SNAPSHOT_DATE,
        CASE WHEN (o_custkey + y) % 23 <> 0 AND (o_custkey + y) % 11 <> 0
             THEN CAST(greatest(0, abs(lag) % 91 - 30) AS DOUBLE) END AS DAYS_PAST_DUE,
        (o_custkey + y) % 23 = 0 OR (o_custkey + y) % 11 <> 0 AS dpd_given,
        CASE WHEN (o_custkey + y) % 13 = 0 THEN NULL
             WHEN returned = n THEN CASE (o_custkey + y) % 2 WHEN 0 THEN 'fpd' ELSE 'FPD' END
             WHEN returned * 3 > n * 2 THEN 'FMD' ELSE 'Active' END AS ACCOUNT_STATUS_L2,
        CASE WHEN (o_custkey + y) % 7 = 0 THEN NULL
             WHEN opened * 2 > n THEN CASE (o_custkey + y) % 5 WHEN 0 THEN ' Arrears'
               WHEN 1 THEN 'ARREARS' ELSE 'Arrears' END
             ELSE 'Current' END AS BALANCE_DUE_STATUS,
        CASE WHEN (o_custkey + y) % 19 = 0 THEN due * 2 ELSE paid END / 100.0::DOUBLE AS TOTAL_PAID,
        CASE WHEN (o_custkey + y) % 17 = 0 THEN 0 ELSE due END / 100.0::DOUBLE AS TOTAL_DUE_TODAY
      FROM (
        SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n,
          CAST(sum(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)))
               AS BIGINT) AS lag,
          count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
          count(*) FILTER (WHERE l_linestatus = 'O') AS opened,
          CAST(sum(CAST(floor(l_extendedprice * 100 + 0.5::DOUBLE) AS BIGINT)) AS BIGINT) AS due,
          CAST(sum(CAST(floor((CASE WHEN l_linestatus = 'F'
                 THEN l_extendedprice * (1 - l_discount) ELSE l_extendedprice / 2 END) * 100
                 + 0.5::DOUBLE) AS BIGINT)) AS BIGINT) AS paid
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)""",
    "dob": """
      SELECT CAST(c_custkey AS VARCHAR) AS LOAN_ID,
        CASE WHEN c_custkey % 17 <> 0
             THEN DATE '1930-01-01' + CAST(c_custkey * 97 % 20000 AS INTEGER) END AS date_of_birth
      FROM customer""",
    "income": f"""
      SELECT LOAN_ID, avg_monthly_income,
        {_band_case('avg_monthly_income', INCOME_BANDS, 'left')} AS income_band
      FROM (SELECT CAST(c_custkey AS VARCHAR) AS LOAN_ID,
              round_even(c_acctbal * 10 / CAST(nullif(c_nationkey % 6, 0) AS DOUBLE), 0) + 0.0::DOUBLE
                AS avg_monthly_income
            FROM customer)""",
    "gender": """
      SELECT CAST(c_custkey AS VARCHAR) AS LOAN_ID,
        CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'AUTOMOBILE' THEN 1
             WHEN 'MACHINERY' THEN 0 WHEN 'HOUSEHOLD' THEN 0 END AS DOUBLE) AS is_male
      FROM customer""",
    "sales": """
      SELECT LOAN_ID, sale_date, cash_price, loan_price, loan_term FROM (
        SELECT CAST(o_custkey AS VARCHAR) AS LOAN_ID, o_orderdate AS sale_date,
          o_totalprice * (1 - (o_orderkey % 4) * 0.1::DOUBLE) AS cash_price,
          o_totalprice AS loan_price, CAST(6 + (o_orderkey % 3) * 6 AS DOUBLE) AS loan_term,
          row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
        FROM orders) WHERE rn = 1""",
    "loan_prices": """
      SELECT LOAN_ID, cash_price, loan_price, loan_term, loan_price AS loan_amount,
        round_even((loan_price - cash_price) / nullif(cash_price, 0), 3) + 0.0::DOUBLE AS markup_ratio,
        loan_term AS loan_term_months
      FROM sales""",
    "answers": """
      SELECT event_id, ts, CAST(user_id AS VARCHAR) AS LOAN_ID,
        CAST(CAST(floor(value) AS BIGINT) % 11 AS DOUBLE) AS nps_score,
        CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS DOUBLE) AS phone_locked,
        CAST(CASE WHEN event_type = 'purchase' THEN 1 WHEN event_type = 'view' THEN NULL
             ELSE 0 END AS DOUBLE) AS payment_delay,
        CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 0 END AS DOUBLE) AS happy_device,
        CASE WHEN CAST(floor(value) AS BIGINT) % 11 >= 9 THEN 'Promoter'
             WHEN CAST(floor(value) AS BIGINT) % 11 <= 6 THEN 'Detractor'
             ELSE 'Passive' END AS nps_category
      FROM events""",
    "nps": """
      SELECT LOAN_ID, nps_score, phone_locked, payment_delay, happy_device, nps_category
      FROM (SELECT *, row_number() OVER (PARTITION BY LOAN_ID ORDER BY ts, event_id) AS rn
            FROM answers) WHERE rn = 1""",
    "early_rows": """
      SELECT LOAN_ID, SNAPSHOT_DATE, DAYS_PAST_DUE AS dpd,
        CASE WHEN TOTAL_DUE_TODAY <> 0
             THEN least(greatest(TOTAL_PAID / TOTAL_DUE_TODAY, 0), 1) END AS rate,
        CASE WHEN lower(BALANCE_DUE_STATUS) = 'arrears' THEN 1 ELSE 0 END AS arrears,
        row_number() OVER (PARTITION BY LOAN_ID ORDER BY SNAPSHOT_DATE) - 1 AS pos
      FROM credit
      WHERE SNAPSHOT_DATE IN (TIMESTAMP '1995-12-31', TIMESTAMP '1996-12-31',
                              TIMESTAMP '1997-12-31')""",
    "early": """
      SELECT LOAN_ID, coalesce(max(dpd), 0) AS early_max_dpd,
        round_even(coalesce(avg(dpd), 0), 1) AS early_avg_dpd,
        round_even(coalesce(stddev_samp(dpd), 0), 2) AS early_dpd_std,
        CAST(max(arrears) AS INTEGER) AS early_had_arrears,
        round_even(avg(rate), 3) AS early_avg_collection_rate,
        round_even(min(rate), 3) AS early_min_collection_rate,
        round_even(coalesce(stddev_samp(rate), 0), 3) AS early_std_collection_rate,
        count(SNAPSHOT_DATE) AS n_snapshots_early,
        CASE WHEN count(*) < 2 THEN 0.0::DOUBLE
             ELSE round_even(regr_slope(coalesce(dpd, 0), pos), 3) + 0.0::DOUBLE END
          AS early_dpd_trend
      FROM early_rows GROUP BY LOAN_ID""",
    "ages": f"""
      SELECT *, {_band_case('age_years', AGE_BANDS, 'right')} AS age_band
      FROM (SELECT LOAN_ID, SNAPSHOT_DATE,
              round_even(date_diff('day', date_of_birth, CAST(SNAPSHOT_DATE AS DATE))
                         / 365.25::DOUBLE, 1) AS age_years
            FROM credit LEFT JOIN dob USING (LOAN_ID))""",
    "demographics": """
      SELECT LOAN_ID, age_years, age_band, avg_monthly_income, income_band, is_male
      FROM (SELECT *, row_number() OVER (PARTITION BY LOAN_ID ORDER BY SNAPSHOT_DATE DESC) AS rn
            FROM ages)
      LEFT JOIN income USING (LOAN_ID) LEFT JOIN gender USING (LOAN_ID) WHERE rn = 1""",
    "features": """
      SELECT early.*, cash_price, loan_price, loan_term, loan_amount, markup_ratio,
        loan_term_months, age_years, age_band, avg_monthly_income, income_band, is_male,
        nps_score, phone_locked, payment_delay, happy_device, nps_category,
        CAST(CASE WHEN nps_score >= 9 THEN 1 ELSE 0 END AS DOUBLE) AS is_promoter,
        CAST(CASE WHEN nps_score <= 6 THEN 1 ELSE 0 END AS DOUBLE) AS is_detractor
      FROM early LEFT JOIN loan_prices USING (LOAN_ID) LEFT JOIN demographics USING (LOAN_ID)
      LEFT JOIN nps USING (LOAN_ID)""",
    "target": _target("combined"),
    "encoded": f"SELECT *, {_ONE_HOT} FROM features",
    "probabilities": f"""
      SELECT LOAN_ID, 1 / (1 + exp(-({_log_odds()}))) AS p FROM encoded""",
    "fixed": f"SELECT LOAN_ID, {_fixed_log_odds()} AS millionths FROM encoded",
    "scores": f"""
      SELECT LOAN_ID, round_even(p, 4) AS pd_score, {_score('p')} AS credit_score,
        {_risk(_score('p'))} AS risk_band FROM probabilities""",
    "scored": """
      SELECT LOAN_ID, target, 1 / (1 + exp(-(millionths / 1e6::DOUBLE))) AS p
      FROM fixed JOIN target USING (LOAN_ID)""",
    "points": """
      SELECT p, n, bad, n - bad AS good,
        sum(bad) OVER down AS cum_bad, sum(n - bad) OVER down AS cum_good,
        sum(bad) OVER () AS n_bad, sum(n - bad) OVER () AS n_good
      FROM (SELECT p, count(*) AS n, CAST(sum(target) AS BIGINT) AS bad FROM scored GROUP BY p)
      WINDOW down AS (ORDER BY p DESC ROWS UNBOUNDED PRECEDING)""",
}


def _confusion_views(points: str) -> str:
    return f"""
    best AS (
      SELECT p AS threshold FROM (
        SELECT p, round(cum_bad / n_bad::DOUBLE - cum_good / n_good::DOUBLE, 12) AS j
        FROM {points}) WHERE j > 0 ORDER BY j DESC, p DESC LIMIT 1),
    counts AS (
      SELECT CAST(coalesce(sum(good) FILTER (WHERE p < threshold), 0) AS BIGINT) AS tn,
        CAST(coalesce(sum(good) FILTER (WHERE p >= threshold), 0) AS BIGINT) AS fp,
        CAST(coalesce(sum(bad) FILTER (WHERE p < threshold), 0) AS BIGINT) AS fn,
        CAST(coalesce(sum(bad) FILTER (WHERE p >= threshold), 0) AS BIGINT) AS tp,
        any_value(threshold) AS threshold
      FROM {points}, best),
    figures AS (
      SELECT *, coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS prec,
        coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS rec FROM counts)"""


def _with(last: str | None, body: str, extra: str = "") -> str:
    """``body`` after all views up to ``last``, and further ones in ``extra``."""
    views = []
    for name, sql in _VIEWS.items():
        if last is None:
            break
        views.append(f"{name} AS ({sql})")
        if name == last:
            break
    if extra:
        views.append(extra.strip())
    return f"WITH {', '.join(views)} {body}" if views else body


_METRICS = """
    SELECT '{model}' AS model,
      round_even((SELECT sum(good * (cum_bad - bad / 2.0::DOUBLE))
                    / (any_value(n_bad) * any_value(n_good)::DOUBLE) FROM points), 4) AS roc_auc,
      round_even((SELECT sum(bad / n_bad::DOUBLE * cum_bad / (cum_bad + cum_good)::DOUBLE)
                  FROM points), 4) AS pr_auc,
      round_even((SELECT max(abs(cum_bad / n_bad::DOUBLE - cum_good / n_good::DOUBLE))
                  FROM points), 4) AS ks_stat,
      round_even(prec, 4) AS precision, round_even(rec, 4) AS recall,
      round_even(coalesce(2 * prec * rec / nullif(prec + rec, 0), 0), 4) AS f1,
      round_even(threshold, 4) AS threshold, tn + fp + fn + tp AS n_test,
      round_even((tp + fn) / (tn + fp + fn + tp)::DOUBLE, 4) AS bad_rate
    FROM figures"""

_MEANS = (
    "means AS (SELECT "
    + ", ".join(f'avg(coalesce("{n}", 0)) AS "{n}"' for n in _WEIGHTS)
    + " FROM encoded)"
)
_PARTS = (
    "parts AS (SELECT LOAN_ID, u.i AS i, u.f AS feature, u.v AS value FROM (SELECT e.LOAN_ID, unnest(["
    + ", ".join(
        f"{{'i': {i}, 'f': '{n}', "
        f"'v': CAST({w} AS DOUBLE) * (coalesce(e.\"{n}\", 0) - m.\"{n}\")}}"
        for i, (n, w) in enumerate(_WEIGHTS.items())
    )
    + "]) AS u FROM encoded e, means m))"
)
_CODES = "codes(code, description, direction, rank) AS (VALUES " + ", ".join(
    f"('{f}', '{text}', '{way}', {i})" for i, (f, (text, way)) in enumerate(REASON_CODES.items())
) + ")"

_REASONS = """
    , low AS (SELECT *, row_number() OVER (PARTITION BY LOAN_ID ORDER BY value, i) AS rn FROM parts),
    high AS (SELECT *, row_number() OVER (PARTITION BY LOAN_ID ORDER BY value DESC, i) AS rn
             FROM parts),
    chosen AS (
      SELECT LOAN_ID, feature, value, 'positive' AS direction, 0 AS side, rn FROM low WHERE rn <= 4
      UNION ALL
      SELECT LOAN_ID, feature, value, 'negative', 1, rn FROM high WHERE rn <= 4),
    kept AS (
      SELECT *, row_number() OVER (PARTITION BY LOAN_ID ORDER BY side, rn) AS place
      FROM chosen WHERE abs(value) > 0.001)"""

# Drivers in words, with their place among those of the same direction.
_WORDED = """worded AS (
      SELECT LOAN_ID, kept.direction, row_number() OVER (PARTITION BY LOAN_ID, side ORDER BY rn) AS rn,
        CASE side WHEN 0 THEN '✓ ' ELSE '✗ ' END || coalesce(description, feature) AS driver
      FROM kept LEFT JOIN codes ON code = feature)"""

# Attributions of a request are measured from zero.
_REQUEST_PARTS = (
    "parts AS (SELECT LOAN_ID, u.i AS i, u.f AS feature, u.v AS value FROM (SELECT loan_id AS LOAN_ID, unnest(["
    + ", ".join(
        f"{{'i': {i}, 'f': '{n}', 'v': CAST({w} AS DOUBLE) * coalesce(\"{n}\", 0)}}"
        for i, (n, w) in enumerate(_WEIGHTS.items())
    )
    + "]) AS u FROM requests))"
)

# The early features over all snapshots.
_FALLBACK = ", ".join(
    f"{new} AS ({sql})"
    for new, sql in (
        ("all_rows", _VIEWS["early_rows"].split("WHERE")[0]),
        ("late_early", _VIEWS["early"].replace("early_rows", "all_rows")),
    )
)

# A request without an age or income counts as 0 and is banded as such.
_REQUEST_ROWS = """
    asked AS (
      SELECT features.* REPLACE (coalesce(age_years, 0) AS age_years,
        coalesce(avg_monthly_income, 0) AS avg_monthly_income) FROM features),
    requests AS (
      SELECT LOAN_ID AS loan_id, LOAN_ID LIKE '%7' AS failed, * EXCLUDE (LOAN_ID), {one_hot}
      FROM (SELECT * REPLACE ({age} AS age_band, {income} AS income_band) FROM asked)),
    answers_p AS (SELECT loan_id, failed, 1 / (1 + exp(-({log_odds}))) AS p FROM requests),
    responses AS (
      SELECT loan_id,
        CASE WHEN failed THEN 0 ELSE round_even(p, 4) END AS pd_score,
        CASE WHEN failed THEN 'Error' ELSE format('{{:.2f}}%', p * 100) END AS pd_pct,
        CASE WHEN failed THEN 0 ELSE {score} END AS credit_score,
        CASE WHEN failed THEN 'Error' ELSE {band} END AS risk_band
      FROM answers_p)""".format(
    one_hot=_ONE_HOT,
    age=_band_case("age_years", AGE_BANDS, "right"),
    income=_band_case("avg_monthly_income", INCOME_BANDS, "left"),
    log_odds=_log_odds(),
    score=_score("p"),
    band=_risk(_score("p")),
)

_BAND_ROWS = "bands(risk_band, low, high) AS (VALUES " + ", ".join(
    f"('{label}', {low}, {high})" for label, low, high in RISK_BANDS
) + ")"


def _split_sql(seed: int, cut: str) -> str:
    """Per loan its class, cell, and how many of its class lie in lower cells."""
    return _with(
        "target",
        cut,
        f"""cells AS (SELECT *, {_cell(seed)} AS cell FROM target),
        ranked AS (SELECT *, rank() OVER (PARTITION BY target ORDER BY cell) - 1 AS lower,
                     count(*) OVER (PARTITION BY target) AS total FROM cells)""",
    )


def _imputed(feature: str) -> str:
    return f'coalesce("{feature}", (SELECT median("{feature}") FROM encoded), 0)'


def oracle_sql() -> dict[str, str]:
    sql = {
        "q_snapshot_union": """
          SELECT CAST(o_custkey AS VARCHAR) AS LOAN_ID, o_orderdate AS SNAPSHOT_DATE,
            o_totalprice AS AMOUNT,
            CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN o_orderpriority END AS PRIORITY,
            CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN NULL ELSE o_orderstatus END AS STATUS
          FROM orders""",
        "q_normalise_loan_id": """
          SELECT c_name, CAST(c_custkey AS VARCHAR) AS LOAN_ID FROM customer
          WHERE c_custkey % 13 <> 0 AND c_custkey % 11 <> 0""",
        "q_infer_numeric": """
          SELECT CAST(o_custkey AS VARCHAR) AS LOAN_ID, o_totalprice AS AMOUNT,
            o_orderpriority AS PRIORITY,
            CASE WHEN o_custkey % 7 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS MIXED,
            CASE WHEN o_custkey % 5 <> 0 THEN CAST(o_custkey AS DOUBLE) END AS GAPS
          FROM orders""",
        "q_parse_dates": """
          SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN NULL
            WHEN o_orderkey % 6 = 3 THEN o_orderdate + INTERVAL 5 HOUR
            ELSE o_orderdate END AS parsed FROM orders""",
        "q_nps_flags": _with(
            "answers",
            """SELECT LOAN_ID, nps_score, phone_locked, payment_delay, happy_device, nps_category
            FROM answers""",
        ),
        "q_age_features": _with("ages", "SELECT * FROM ages"),
        "q_income_features": _with(
            "income",
            """SELECT LOAN_ID, SNAPSHOT_DATE, avg_monthly_income, income_band
            FROM credit LEFT JOIN income USING (LOAN_ID)""",
        ),
        "q_gender_flag": _with(
            "gender",
            """SELECT LOAN_ID, SNAPSHOT_DATE, is_male FROM credit
            LEFT JOIN gender USING (LOAN_ID)""",
        ),
        "q_collection_rate": _with(
            "credit",
            """SELECT LOAN_ID, SNAPSHOT_DATE, CASE WHEN TOTAL_DUE_TODAY <> 0 THEN round_even(
              least(greatest(TOTAL_PAID / TOTAL_DUE_TODAY, 0), 1), 6) END AS collection_rate
            FROM credit""",
        ),
        "q_early_arrears": _with(
            "credit",
            """SELECT LOAN_ID, SNAPSHOT_DATE, CAST(CASE WHEN lower(BALANCE_DUE_STATUS) = 'arrears'
              THEN 1 ELSE 0 END AS INTEGER) AS arrears FROM credit""",
        ),
        "q_loan_features": _with(
            "loan_prices",
            """SELECT CAST(c_custkey AS VARCHAR) AS LOAN_ID, loan_amount, markup_ratio,
              loan_term_months
            FROM customer LEFT JOIN loan_prices ON LOAN_ID = CAST(c_custkey AS VARCHAR)""",
        ),
        "q_origination": """
          WITH history AS (
            SELECT CAST(o_custkey AS VARCHAR) AS LOAN_ID, o_orderdate AS d,
              CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS lp,
              CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice / 2 END AS cp,
              CASE WHEN o_orderkey % 5 <> 0 THEN CAST(6 + o_orderkey % 3 * 6 AS DOUBLE) END AS lt
            FROM orders)
          SELECT LOAN_ID,
            (list(lp ORDER BY d, lp) FILTER (WHERE lp IS NOT NULL))[1] AS loan_price,
            (list(cp ORDER BY d, cp) FILTER (WHERE cp IS NOT NULL))[1] AS cash_price,
            (list(lt ORDER BY d, lt) FILTER (WHERE lt IS NOT NULL))[1] AS loan_term
          FROM history GROUP BY LOAN_ID""",
        "q_nps_features": _with(
            "nps",
            """SELECT CAST(c_custkey AS VARCHAR) AS LOAN_ID, nps_score, phone_locked,
              payment_delay, happy_device, nps_category,
              CAST(CASE WHEN nps_score >= 9 THEN 1 ELSE 0 END AS DOUBLE) AS is_promoter,
              CAST(CASE WHEN nps_score <= 6 THEN 1 ELSE 0 END AS DOUBLE) AS is_detractor
            FROM customer LEFT JOIN nps ON LOAN_ID = CAST(c_custkey AS VARCHAR)""",
        ),
        "q_one_hot": _with("demographics", f"SELECT LOAN_ID, {_ONE_HOT} FROM demographics"),
        "q_early_agg": _with("early", "SELECT * FROM early"),
        "q_dpd_trend": _with(
            "credit",
            """SELECT LOAN_ID, CASE WHEN count(*) < 2 THEN 0.0::DOUBLE
              ELSE round_even(regr_slope(coalesce(DAYS_PAST_DUE, 0), pos), 3) + 0.0::DOUBLE END
              AS dpd_trend
            FROM (SELECT *, row_number() OVER (PARTITION BY LOAN_ID ORDER BY SNAPSHOT_DATE) - 1
                    AS pos FROM credit) GROUP BY LOAN_ID""",
        ),
        "q_first_per_loan": _with("sales", "SELECT * FROM sales"),
        "q_last_demographics": _with("demographics", "SELECT * FROM demographics"),
        "q_feature_matrix": _with("features", "SELECT * FROM features"),
        "q_profile": _with(
            "credit",
            """SELECT count(*) AS n_rows, count(DISTINCT LOAN_ID) AS n_loans,
              CAST(7 AS BIGINT) AS n_columns FROM credit""",
        ),
        "q_impute_median": _with(
            "features",
            " UNION ALL ".join(
                f"SELECT '{n}' AS feature, CAST(median({n}) AS DOUBLE) AS median FROM features"
                for n in NUMERIC_FEATURES
            ),
        ),
        "q_labelled": _with(
            "target", "SELECT features.*, target FROM features JOIN target USING (LOAN_ID)"
        ),
        "q_bad_rate": _with(
            "target",
            """SELECT count(*) AS n_loans, CAST(sum(target) AS BIGINT) AS n_bad,
              CAST(sum(1 - target) AS BIGINT) AS n_good, round_even(avg(target), 6) AS bad_rate
            FROM target""",
        ),
        "q_class_weights": _with(
            "target",
            """SELECT n_good, n_bad, round_even(n_good / greatest(n_bad, 1)::DOUBLE, 6) AS pos_weight,
              round_even((n_good + n_bad) / (2 * n_good::DOUBLE), 6) AS weight_good,
              round_even((n_good + n_bad) / (2 * n_bad::DOUBLE), 6) AS weight_bad
            FROM (SELECT count(*) FILTER (WHERE target = 0) AS n_good,
                    count(*) FILTER (WHERE target = 1) AS n_bad FROM target)""",
        ),
        "q_stratified_split": _split_sql(
            42,
            """SELECT LOAN_ID, target,
              CAST(CASE WHEN lower < total * 0.2::DOUBLE THEN 1 ELSE 0 END AS INTEGER) AS is_test
            FROM ranked""",
        ),
        "q_folds": _split_sql(
            43,
            """SELECT LOAN_ID, target, CAST((lower >= total * 0.2::DOUBLE)::INT
              + (lower >= total * 0.4::DOUBLE)::INT + (lower >= total * 0.6::DOUBLE)::INT
              + (lower >= total * 0.8::DOUBLE)::INT AS INTEGER) AS fold FROM ranked""",
        ),
        "q_pd_to_score": f"""
          SELECT l_orderkey, l_linenumber, p, {_score('p')} AS credit_score
          FROM (SELECT l_orderkey, l_linenumber,
                  (CAST(floor(l_extendedprice * 100 + 0.5::DOUBLE) AS BIGINT) % 10001)
                    / 10000::DOUBLE AS p FROM lineitem)""",
        "q_risk_band": f"""
          SELECT o_orderkey, score, {_risk('score')} AS risk_band
          FROM (SELECT o_orderkey, CAST(280 + CAST(floor(o_totalprice * 100 + 0.5::DOUBLE)
                  AS BIGINT) % 600 AS INTEGER) AS score FROM orders)""",
        "q_score_table": _with("scores", "SELECT * FROM scores"),
        "q_score_portfolio": _with(
            "encoded",
            f"""SELECT LOAN_ID, round_even(p, 4) AS pd, {_score('p')} AS score,
              {_risk(_score('p'))} AS risk_band
            FROM (SELECT LOAN_ID, 1 / (1 + exp(-({_log_odds()}))) AS p FROM filled)""",
            "filled AS (SELECT LOAN_ID, "
            + ", ".join(f'{_imputed(n)} AS "{n}"' for n in _WEIGHTS)
            + " FROM encoded)",
        ),
        "q_score_requests": _with("features", "SELECT * FROM responses", _REQUEST_ROWS),
        "q_batch_summary": _with(
            "features",
            """SELECT (SELECT count(*) FROM responses) AS total,
              (SELECT round_even(avg(credit_score) FILTER (WHERE credit_score > 0), 1)
               FROM responses) AS avg_score,
              (SELECT format('{:.2f}%', avg(pd_score) FILTER (WHERE pd_score > 0) * 100)
               FROM responses) AS avg_pd_pct,
              risk_band, count(*) AS n FROM responses GROUP BY risk_band""",
            _REQUEST_ROWS,
        ),
        "q_band_summary": _with(
            "scores",
            """SELECT risk_band, count(*) AS count, round_even(avg(pd_score) * 100, 2) AS avg_pd,
              round_even(count(*) / (SELECT count(*) FROM scores)::DOUBLE * 100, 1) AS pct
            FROM scores GROUP BY risk_band""",
        ),
        "q_score_summary": _with(
            "scores",
            """SELECT b.risk_band, b.low || '–' || b.high AS score_range,
              count(s.LOAN_ID) AS count,
              round_even(count(s.LOAN_ID) * 100.0::DOUBLE / (SELECT count(*) FROM scores)::DOUBLE, 1)
                AS pct,
              round_even(coalesce(avg(pd_score), 0) * 100, 2) AS avg_pd
            FROM bands b LEFT JOIN scores s ON s.credit_score BETWEEN b.low AND b.high
            GROUP BY b.risk_band, b.low, b.high""",
            _BAND_ROWS,
        ),
        "q_score_profile": _with(
            "scores",
            """SELECT count(*) AS n_loans, round_even(avg(credit_score), 0) AS avg_score,
              round_even(avg(pd_score) * 100, 2) AS avg_pd_pct FROM scores""",
        ),
        "q_ks": _with(
            "points",
            """SELECT round_even(max(abs(cum_bad / n_bad::DOUBLE - cum_good / n_good::DOUBLE)), 6)
              AS ks_stat FROM points""",
        ),
        # The definition over pairs: a bad loan ranks above a good one, ties half.
        "q_auc": _with(
            "scored",
            """SELECT round_even(sum(CASE WHEN b.p > g.p THEN 1.0::DOUBLE WHEN b.p = g.p THEN 0.5::DOUBLE
                ELSE 0.0::DOUBLE END * b.n * g.n) / sum(b.n * g.n)::DOUBLE, 6) AS roc_auc
            FROM (SELECT p, count(*) AS n FROM scored WHERE target = 1 GROUP BY p) b,
                 (SELECT p, count(*) AS n FROM scored WHERE target = 0 GROUP BY p) g""",
        ),
        "q_average_precision": _with(
            "points",
            """SELECT round_even(sum(bad / n_bad::DOUBLE * cum_bad / (cum_bad + cum_good)::DOUBLE), 6)
              AS pr_auc FROM points""",
        ),
        "q_youden": _with("points", "SELECT round_even(threshold, 9) AS threshold FROM best", _confusion_views("points")),
        "q_roc_curve": _with(
            "points",
            """SELECT round_even(p, 9) AS threshold, round_even(cum_good / n_good::DOUBLE, 6) AS fpr,
              round_even(cum_bad / n_bad::DOUBLE, 6) AS tpr FROM points
            UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE""",
        ),
        "q_pr_curve": _with(
            "points",
            """SELECT round_even(p, 9) AS threshold, round_even(cum_bad / n_bad::DOUBLE, 6) AS recall,
              round_even(cum_bad / (cum_bad + cum_good)::DOUBLE, 6) AS precision FROM points
            UNION ALL SELECT NULL, 0.0::DOUBLE, 1.0::DOUBLE""",
        ),
        "q_ks_curve": _with(
            "points",
            """SELECT round_even(p, 9) AS p,
              round_even((cum_bad + cum_good - 1) / (n_bad + n_good - 1)::DOUBLE, 6) AS population,
              round_even(cum_bad / n_bad::DOUBLE, 6) AS cum_bad_share,
              round_even(cum_good / n_good::DOUBLE, 6) AS cum_good_share FROM points""",
        ),
        "q_confusion": _with(
            "points", "SELECT tn, fp, fn, tp FROM counts", _confusion_views("points")
        ),
        "q_metrics": _with(
            "points", _METRICS.format(model="scorecard"), _confusion_views("points")
        ),
        "q_metrics_exact": "WITH scored AS (SELECT l_extendedprice / 200000 AS p, "
        "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS target FROM lineitem), "
        f"points AS ({_VIEWS['points']}), {_confusion_views('points')} "
        + _METRICS.format(model="price"),
        "q_class_report": _with(
            "points",
            """SELECT label, round_even(p, 6) AS precision, round_even(r, 6) AS recall,
              round_even(f, 6) AS f1, support FROM (
              SELECT 'Good' AS label, gp AS p, gr AS r, gf AS f, tn + fp AS support FROM lines
              UNION ALL SELECT 'Bad', prec, rec, bf, tp + fn FROM lines
              UNION ALL SELECT 'accuracy', NULL, NULL, (tp + tn) / total, CAST(total AS BIGINT)
                FROM lines
              UNION ALL SELECT 'macro avg', (gp + prec) / 2, (gr + rec) / 2, (gf + bf) / 2,
                CAST(total AS BIGINT) FROM lines
              UNION ALL SELECT 'weighted avg', (gp * (tn + fp) + prec * (tp + fn)) / total,
                (gr * (tn + fp) + rec * (tp + fn)) / total,
                (gf * (tn + fp) + bf * (tp + fn)) / total, CAST(total AS BIGINT) FROM lines)""",
            _confusion_views("points")
            + """,
            goods AS (SELECT *, CAST(tn + fp + fn + tp AS DOUBLE) AS total,
                coalesce(tn / nullif(tn + fn, 0)::DOUBLE, 0) AS gp,
                coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0) AS gr FROM figures),
            lines AS (SELECT *, coalesce(2 * gp * gr / nullif(gp + gr, 0), 0) AS gf,
                coalesce(2 * prec * rec / nullif(prec + rec, 0), 0) AS bf FROM goods)""",
        ),
        "q_calibration": _with(
            "scored",
            """SELECT CAST(greatest(ceil(p * 10), 1) AS INTEGER) AS bin,
              round_even(avg(p), 6) AS mean_predicted, round_even(avg(target), 6) AS bad_share,
              count(*) AS n FROM scored GROUP BY 1""",
        ),
        "q_pd_histogram": _with(
            "scored",
            """SELECT label, bin, round_even(lo + (bin - 1) * ((hi - lo) / 40), 8) AS bin_low,
              round_even(lo + bin * ((hi - lo) / 40), 8) AS bin_high, count(*) AS n
            FROM (SELECT target AS label, lo, hi,
                    CAST(least(floor((p - lo) / (hi - lo) * 40) + 1, 40) AS INTEGER) AS bin
                  FROM scored JOIN (SELECT target, min(p) AS lo, max(p) AS hi FROM scored
                                    GROUP BY target) USING (target))
            GROUP BY label, bin, lo, hi""",
        ),
        "q_linear_attrib": _with(
            "encoded",
            "SELECT LOAN_ID, feature, round_even(value, 6) + 0.0::DOUBLE AS value FROM parts",
            f"{_MEANS}, {_PARTS}",
        ),
        "q_linear_attrib_global": _with(
            "encoded",
            """SELECT feature, round_even(avg(abs(value)), 6) AS mean_abs_shap FROM parts
            GROUP BY feature""",
            f"{_MEANS}, {_PARTS}",
        ),
        "q_reason_codes": _with(
            "encoded",
            """SELECT LOAN_ID, CAST(place AS INTEGER) AS place, feature AS code,
              coalesce(description, feature) AS description, kept.direction,
              round_even(value, 4) + 0.0::DOUBLE AS shap
            FROM kept LEFT JOIN codes ON code = feature""",
            f"{_MEANS}, {_PARTS}, {_CODES} {_REASONS}",
        ),
        "q_explain_portfolio": _with(
            "scores",
            """SELECT s.LOAN_ID, credit_score, s.risk_band, format('{:.2f}%', pd_score * 100) AS pd_pct,
              k.direction, CAST(k.rn AS INTEGER) AS place, k.driver
            FROM scores s LEFT JOIN worded k USING (LOAN_ID)""",
            f"{_MEANS}, {_PARTS}, {_CODES} {_REASONS}, {_WORDED}",
        ),
        "q_score_requests_explained": _with(
            "features",
            """SELECT r.loan_id, r.pd_score, r.credit_score, r.risk_band,
              k.direction, CAST(k.rn AS INTEGER) AS place, k.driver
            FROM responses r LEFT JOIN worded k ON k.LOAN_ID = r.loan_id AND r.risk_band <> 'Error'""",
            f"{_REQUEST_ROWS}, {_REQUEST_PARTS}, {_CODES} {_REASONS}, {_WORDED}",
        ),
        "q_early_fallback": _with("credit", "SELECT * FROM late_early", _FALLBACK),
        "q_merge_target": _with(
            "features",
            """SELECT f.LOAN_ID, early_max_dpd, loan_amount, target,
              (SELECT count(*) FROM features WHERE LOAN_ID NOT IN (SELECT LOAN_ID FROM late)) AS n_dropped
            FROM features f JOIN late USING (LOAN_ID)""",
            """late AS (SELECT LOAN_ID, CAST(CASE WHEN coalesce(DAYS_PAST_DUE, 0) > 30 THEN 1 ELSE 0 END AS INTEGER)
                AS target FROM credit WHERE SNAPSHOT_DATE = TIMESTAMP '2001-12-31')""",
        ),
        "q_fallback_reasons": _with(
            "encoded",
            """SELECT LOAN_ID, direction, CAST(place AS INTEGER) AS place, code, description, value
            FROM (SELECT *, row_number() OVER (PARTITION BY LOAN_ID, direction
                           ORDER BY value DESC, rank) AS place
                  FROM cells JOIN codes ON code = feature
                  WHERE value > 0 AND direction <> 'neutral') WHERE place <= 4""",
            f"{_CODES}, cells AS (SELECT LOAN_ID, u.f AS feature, u.v AS value FROM "
            "(SELECT LOAN_ID, unnest(["
            + ", ".join(f"{{'f': '{n}', 'v': CAST(\"{n}\" AS DOUBLE)}}" for n in REASON_CODES)
            + "]) AS u FROM encoded))",
        ),
    }
    for definition in ("fpd_fmd", "par30", "par60", "par90", "combined"):
        sql[f"q_target_{definition}"] = _with("credit", _target(definition))
    sql["stream_score"] = sql["q_score_requests"]
    sql["ml_tree_additive"] = _with(
        "target",
        f"""SELECT LOAN_ID, CAST({len(MODEL_FEATURES)} AS INTEGER) AS n_features, true AS additive
        FROM features JOIN target USING (LOAN_ID)""",
    )
    return sql
