"""DuckDB statements equivalent to the registered queries (the correctness oracle).

Written directly in SQL over the driver's views (``events``, ``customer``),
independent of the Spark code path: window functions, ``quantile_cont``,
``count(DISTINCT)`` and explicit moment formulas where Spark uses the
distributed primitives.  Output normalisation matches ``catalog.normalise``.
"""
from __future__ import annotations

from ..operators.features import family_columns
from ..schema import DIRECTIONS, FAMILIES, TX_TYPES, WINDOWS, is_count_column
from .scoring import TRACE_ROUNDS

R = 6

BASE_CTES = """
tx AS (
  SELECT user_id AS alert_id, ts AS tx_ts,
         CASE WHEN event_id % 2 = 0 THEN 'in' ELSE 'out' END AS direction,
         CASE event_type WHEN 'click' THEN 'card' WHEN 'view' THEN 'bank'
              WHEN 'purchase' THEN 'cash' WHEN 'signup' THEN 'intl' ELSE 'other' END AS tx_type,
         CASE WHEN isnan((value - 50.0) / 50.0) THEN NULL
              ELSE CAST((value - 50.0) / 50.0 AS DOUBLE) END AS amount
  FROM events),
alerts AS (
  SELECT c_custkey AS alert_id,
         TIMESTAMP '2024-01-15' + to_days(CAST(c_custkey % 16 AS INTEGER)) AS alert_date,
         CASE WHEN c_acctbal < 870 THEN 1 ELSE 0 END AS label,
         CASE WHEN c_custkey % 10 >= 7 THEN 'test' ELSE 'train' END AS split
  FROM customer),
idx AS (SELECT alert_id, min(alert_date) AS alert_date FROM alerts GROUP BY alert_id),
h AS (
  SELECT * FROM (
    SELECT t.alert_id, t.tx_ts, t.direction, t.tx_type, t.amount, i.alert_date,
           CAST(date_diff('microsecond', t.tx_ts, i.alert_date) AS DOUBLE) / 1000000.0 / 86400.0 AS days_before,
           CASE WHEN t.direction = 'out' THEN 1 ELSE 0 END AS out_flag,
           hour(t.tx_ts) AS hr, isodow(t.tx_ts) - 1 AS dow, CAST(t.tx_ts AS DATE) AS tx_date
    FROM tx t JOIN idx i ON t.alert_id = i.alert_id) WHERE days_before >= 0)"""


def with_ctes(*extra: str) -> str:
    parts = [BASE_CTES.strip()] + [e.strip() for e in extra]
    return "WITH " + ",\n".join(parts) + "\n"


def d(expr: str) -> str:
    """Normalised double."""
    return f"round(CAST({expr} AS DOUBLE) + 1e-9, {R})"


def b(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


# ------------------------------------------------------------------ step 1

ORACLE: dict[str, str] = {}

ORACLE["read_alerts"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS alert_id, CAST(o_orderdate AS TIMESTAMP) AS alert_date FROM orders"""

ORACLE["read_transactions"] = f"""
SELECT CAST(user_id AS VARCHAR) AS alert_id, ts AS tx_ts, event_type AS direction, event_type AS tx_type,
       {d('CASE WHEN isnan(value) THEN NULL ELSE value END')} AS amount FROM events"""

ORACLE["prepare_history"] = with_ctes() + f"""
SELECT alert_id, tx_ts, direction, tx_type, {d('amount')} AS amount, {d('days_before')} AS days_before,
       {b('out_flag')} AS out, {b('hr')} AS hour, {b('dow')} AS dow
FROM h"""

ORACLE["prep_audit"] = with_ctes("""
j AS (SELECT CAST(date_diff('microsecond', t.tx_ts, i.alert_date) AS DOUBLE) / 1000000.0 / 86400.0 AS days_before
      FROM tx t LEFT JOIN idx i ON t.alert_id = i.alert_id)""") + f"""
SELECT {b('count(*)')} AS raw_rows, {b('count(*) FILTER (WHERE days_before >= 0)')} AS kept_rows,
       {b('count(*) - count(*) FILTER (WHERE days_before >= 0)')} AS dropped_rows,
       {d('(count(*) - count(*) FILTER (WHERE days_before >= 0)) / count(*)')} AS dropped_share
FROM j"""

ORACLE["silent_alerts"] = with_ctes() + """
SELECT a.alert_id, min(a.split) AS split FROM alerts a
WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.alert_id = a.alert_id)
GROUP BY a.alert_id"""

ORACLE["dedup_alerts"] = with_ctes("""
doubled AS (
  SELECT * FROM alerts UNION ALL
  SELECT alert_id, alert_date + to_days(CASE WHEN alert_id % 2 = 0 THEN 1 ELSE -1 END), 1 - label, split
  FROM alerts WHERE split = 'train')""") + """
SELECT alert_id, alert_date, CAST(label AS BIGINT) AS label, split FROM doubled
QUALIFY row_number() OVER (PARTITION BY alert_id ORDER BY alert_date, label, split) = 1"""


# -------------------------------------------------------------- features

def _family_sql(name: str) -> tuple[list[str], str, dict[str, str]]:
    """(CTEs, source alias, column expressions over the joined frame)."""
    if name == "base":
        cte = """f_base AS (SELECT alert_id, count(amount) AS base_cnt, avg(amount) AS base_mean,
          stddev_samp(amount) AS base_std, min(amount) AS base_min, max(amount) AS base_max,
          coalesce(sum(amount), 0.0) AS base_sum, max(days_before) - min(days_before) AS base_span
          FROM h GROUP BY alert_id)"""
        cols = {c: f"f_base.{c}" for c in family_columns("base")}
        return [cte], "f_base", cols
    if name == "amount_shape":
        cte = """f_amt_mu AS (SELECT alert_id, avg(amount) AS mu FROM h GROUP BY alert_id),
        f_amt AS (SELECT h.alert_id,
          quantile_cont(amount, 0.5) AS amt_med, quantile_cont(amount, 0.1) AS amt_q10,
          quantile_cont(amount, 0.25) AS amt_q25, quantile_cont(amount, 0.75) AS amt_q75,
          quantile_cont(amount, 0.9) AS amt_q90, quantile_cont(amount, 0.99) AS amt_q99,
          CAST(count(amount) AS DOUBLE) AS n,
          sum((amount - mu) * (amount - mu)) AS m2,
          sum((amount - mu) * (amount - mu) * (amount - mu)) AS m3,
          sum((amount - mu) * (amount - mu) * (amount - mu) * (amount - mu)) AS m4,
          avg(CASE WHEN amount > 2 THEN 1.0 ELSE 0.0 END) AS amt_big_share,
          CAST(count(DISTINCT amount) AS DOUBLE) / count(*) AS amt_nuniq_ratio
          FROM h JOIN f_amt_mu USING (alert_id) GROUP BY h.alert_id)"""
        cols = {c: f"f_amt.{c}" for c in ("amt_med", "amt_q10", "amt_q25", "amt_q75", "amt_q90",
                                          "amt_q99", "amt_big_share", "amt_nuniq_ratio")}
        cols["amt_iqr"] = "f_amt.amt_q75 - f_amt.amt_q25"
        cols["amt_skew"] = ("CASE WHEN f_amt.n < 3 THEN NULL WHEN f_amt.m2 < 1e-14 THEN 0.0 ELSE "
                            "f_amt.n * sqrt(f_amt.n - 1) / (f_amt.n - 2) * f_amt.m3 / pow(f_amt.m2, 1.5) END")
        cols["amt_kurt"] = ("CASE WHEN f_amt.n < 4 THEN NULL WHEN f_amt.m2 < 1e-14 THEN 0.0 ELSE "
                            "f_amt.n * (f_amt.n + 1) * (f_amt.n - 1) * f_amt.m4 / "
                            "((f_amt.n - 2) * (f_amt.n - 3) * f_amt.m2 * f_amt.m2) - "
                            "3 * (f_amt.n - 1) * (f_amt.n - 1) / ((f_amt.n - 2) * (f_amt.n - 3)) END")
        return [cte], "f_amt", cols
    if name == "direction_type":
        sel, cols = [], {}
        for column, prefix, cats in (("direction", "dir", DIRECTIONS), ("tx_type", "ty", TX_TYPES)):
            for c in cats:
                sel += [f"count(*) FILTER (WHERE {column} = '{c}') AS {prefix}_n_{c}",
                        f"avg(amount) FILTER (WHERE {column} = '{c}') AS {prefix}_m_{c}",
                        f"coalesce(sum(amount) FILTER (WHERE {column} = '{c}'), 0.0) AS {prefix}_s_{c}",
                        f"CAST(count(*) FILTER (WHERE {column} = '{c}') AS DOUBLE) / count(*) AS {prefix}_sh_{c}"]
        cte = "f_dt AS (SELECT alert_id, " + ", ".join(sel) + " FROM h GROUP BY alert_id)"
        return [cte], "f_dt", {c: f"f_dt.{c}" for c in family_columns("direction_type")}
    if name == "cross":
        sel = []
        for dd in DIRECTIONS:
            for t in TX_TYPES:
                cond = f"direction = '{dd}' AND tx_type = '{t}'"
                sel += [f"count(*) FILTER (WHERE {cond}) AS cross_n_{dd}_{t}",
                        f"CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE) / count(*) AS cross_sh_{dd}_{t}"]
        cte = "f_cross AS (SELECT alert_id, " + ", ".join(sel) + " FROM h GROUP BY alert_id)"
        return [cte], "f_cross", {c: f"f_cross.{c}" for c in family_columns("cross")}
    if name == "flow":
        cte = """f_flow AS (SELECT alert_id,
          coalesce(sum(amount) FILTER (WHERE out_flag = 0), 0.0) AS in_sum,
          coalesce(sum(amount) FILTER (WHERE out_flag = 1), 0.0) AS out_sum,
          count(amount) FILTER (WHERE out_flag = 0) AS in_cnt,
          count(amount) FILTER (WHERE out_flag = 1) AS out_cnt,
          avg(amount) FILTER (WHERE out_flag = 0) AS in_mean,
          avg(amount) FILTER (WHERE out_flag = 1) AS out_mean
          FROM h GROUP BY alert_id)"""
        cols = {"flow_net": "f_flow.in_sum - f_flow.out_sum",
                "flow_ratio": "f_flow.out_sum / (abs(f_flow.in_sum) + 1e-6)",
                "flow_cnt_ratio": "CAST(f_flow.out_cnt AS DOUBLE) / (f_flow.in_cnt + 1)",
                "flow_mean_gap": "f_flow.in_mean - f_flow.out_mean"}
        return [cte], "f_flow", cols
    if name == "windows":
        sel, cols = ["count(*) AS n_all"], {}
        for w in WINDOWS:
            cond = f"days_before <= {w}"
            sel += [f"count(*) FILTER (WHERE {cond}) AS win_n{w}",
                    f"coalesce(sum(amount) FILTER (WHERE {cond}), 0.0) AS win_sum{w}",
                    f"avg(amount) FILTER (WHERE {cond}) AS win_mean{w}",
                    f"max(amount) FILTER (WHERE {cond}) AS win_max{w}",
                    f"avg(out_flag) FILTER (WHERE {cond}) AS win_out{w}"]
            for k in ("n", "sum", "mean", "max", "out"):
                cols[f"win_{k}{w}"] = f"f_win.win_{k}{w}"
            cols[f"win_rate{w}"] = f"CAST(f_win.win_n{w} AS DOUBLE) / (f_win.n_all + 1)"
        sel += ["min(days_before) AS win_recency", "max(days_before) AS win_oldest"]
        cols["win_accel_7_30"] = "CAST(f_win.win_n7 AS DOUBLE) / (CAST(f_win.win_n30 AS DOUBLE) / 4.0 + 0.1)"
        cols["win_accel_30_90"] = "CAST(f_win.win_n30 AS DOUBLE) / (CAST(f_win.win_n90 AS DOUBLE) / 3.0 + 0.1)"
        cols["win_recency"] = "f_win.win_recency"
        cols["win_oldest"] = "f_win.win_oldest"
        cte = "f_win AS (SELECT alert_id, " + ", ".join(sel) + " FROM h GROUP BY alert_id)"
        return [cte], "f_win", {c: cols[c] for c in family_columns("windows")}
    if name == "burst":
        ctes = ["""f_gap AS (SELECT alert_id,
          CAST(date_diff('microsecond', lag(tx_ts) OVER (PARTITION BY alert_id ORDER BY tx_ts), tx_ts) AS DOUBLE)
            / 3600000000.0 AS gap FROM h)""",
                """f_burst AS (SELECT alert_id, avg(gap) AS burst_gap_mean, stddev_samp(gap) AS burst_gap_std,
          min(gap) AS burst_gap_min, quantile_cont(gap, 0.5) AS burst_gap_med,
          quantile_cont(gap, 0.9) AS burst_gap_q90,
          avg(CASE WHEN gap < 1 THEN 1.0 ELSE 0.0 END) AS burst_under_1h
          FROM f_gap GROUP BY alert_id)"""]
        cols = {c: f"f_burst.{c}" for c in family_columns("burst")}
        cols["burst_cv"] = "f_burst.burst_gap_std / (f_burst.burst_gap_mean + 1e-6)"
        return ctes, "f_burst", cols
    if name == "hour":
        cte = """f_hour AS (SELECT alert_id,
          avg(CASE WHEN hr < 6 OR hr >= 22 THEN 1.0 ELSE 0.0 END) AS hour_night_share,
          avg(CASE WHEN dow >= 5 THEN 1.0 ELSE 0.0 END) AS hour_weekend_share,
          avg(hr) AS hour_mean, stddev_samp(hr) AS hour_std,
          count(DISTINCT dow) AS hour_dow_nuniq, count(DISTINCT tx_date) AS hour_active_days,
          CAST(count(*) AS DOUBLE) / count(DISTINCT tx_date) AS hour_tx_per_active_day
          FROM h GROUP BY alert_id)"""
        return [cte], "f_hour", {c: f"f_hour.{c}" for c in family_columns("hour")}
    if name == "signal_date":
        ctes = ["""f_anchor AS (SELECT alert_id, min(alert_date) AS alert_date FROM alerts
                   WHERE split = 'train' GROUP BY alert_id)""",
                """f_sameday AS (SELECT alert_date, count(*) AS n FROM f_anchor GROUP BY alert_date)""",
                """f_sig AS (SELECT i.alert_id, month(i.alert_date) AS sig_month,
          isodow(i.alert_date) - 1 AS sig_dow, day(i.alert_date) AS sig_day,
          CAST(weekofyear(i.alert_date) AS DOUBLE) AS sig_week,
          date_diff('day', CAST((SELECT min(alert_date) FROM f_anchor) AS DATE), CAST(i.alert_date AS DATE)) AS sig_tnum,
          s.n AS sig_same_day_n
          FROM idx i LEFT JOIN f_sameday s ON s.alert_date = i.alert_date)"""]
        return ctes, "f_sig", {c: f"f_sig.{c}" for c in family_columns("signal_date")}
    raise KeyError(name)


_INTEGER_FEATURES = {"sig_month", "sig_dow", "sig_day", "sig_tnum", "sig_same_day_n", "hour_dow_nuniq"}


def feature_parts(families=None, raw: bool = False) -> tuple[list[str], str]:
    """(CTEs, SELECT over idx) of the feature frame; ``raw`` skips rounding."""
    names = list(families) if families else list(FAMILIES)
    ctes, joins, select = [], [], ["idx.alert_id"]
    for n in names:
        c, alias, cols = _family_sql(n)
        ctes += c
        joins.append(f"LEFT JOIN {alias} ON {alias}.alert_id = idx.alert_id")
        for col in family_columns(n):
            expr = cols[col]
            if is_count_column(col):
                select.append(f"CAST(coalesce({expr}, 0) AS BIGINT) AS {col}")
            elif col in _INTEGER_FEATURES:
                select.append(f"CAST({expr} AS BIGINT) AS {col}")
            elif raw:
                select.append(f"CAST({expr} AS DOUBLE) AS {col}")
            else:
                select.append(f"{d(expr)} AS {col}")
    return ctes, "SELECT " + ",\n  ".join(select) + "\nFROM idx\n" + "\n".join(joins)


def features_sql(families=None) -> str:
    ctes, body = feature_parts(families)
    return with_ctes(*ctes) + body


for _family in FAMILIES:
    ORACLE[f"feat_{_family}"] = features_sql([_family])
ORACLE["feat_all"] = features_sql(None)


# ------------------------------------------------------------------ EDA

OUTCOME_SQL = "CASE label WHEN 0 THEN 'Dismissed' WHEN 1 THEN 'Escalated' END"
TRAIN_CTES = ("""ta AS (SELECT * FROM alerts WHERE split = 'train')""",
              """th AS (SELECT h.*, l.label FROM h JOIN (SELECT alert_id, arg_min(label, (alert_date, label)) AS label FROM ta GROUP BY alert_id) l
                 ON h.alert_id = l.alert_id)""")

ORACLE["eda_target"] = with_ctes(*TRAIN_CTES) + f"""
SELECT {OUTCOME_SQL} AS outcome, count(*) AS alerts FROM ta GROUP BY 1"""

ORACLE["eda_weekly_volume"] = with_ctes(*TRAIN_CTES, """
wk AS (SELECT CAST(date_trunc('week', tx_ts) AS DATE) + 6 AS week_end, count(*) AS n FROM th GROUP BY 1),
cal AS (SELECT CAST(unnest(generate_series(min(week_end), max(week_end), INTERVAL 7 DAY)) AS DATE) AS week_end FROM wk)""") + """
SELECT cal.week_end, CAST(coalesce(wk.n, 0) AS BIGINT) AS transactions FROM cal LEFT JOIN wk USING (week_end)"""

ORACLE["eda_direction"] = with_ctes(*TRAIN_CTES, """
cats AS (SELECT * FROM (VALUES ('in'), ('out')) v(direction))""") + """
SELECT cats.direction, c.n AS transactions FROM cats
LEFT JOIN (SELECT direction, count(*) AS n FROM th GROUP BY 1) c USING (direction)"""

ORACLE["eda_types"] = with_ctes(*TRAIN_CTES, """
cats AS (SELECT * FROM (VALUES ('card'), ('bank'), ('cash'), ('intl')) v(type))""") + """
SELECT cats.type, c.n AS transactions FROM cats
LEFT JOIN (SELECT tx_type AS type, count(*) AS n FROM th GROUP BY 1) c USING (type)"""

ORACLE["eda_amount_by_outcome"] = with_ctes(*TRAIN_CTES) + f"""
SELECT {OUTCOME_SQL} AS outcome, count(amount) AS count, {d('avg(amount)')} AS mean,
       {d('quantile_cont(amount, 0.5)')} AS median, {d('stddev_samp(amount)')} AS std
FROM th GROUP BY label"""

ORACLE["history_sketch"] = with_ctes(*TRAIN_CTES, """
lc AS (SELECT label, 'amount' AS c, amount AS v FROM th UNION ALL SELECT label, 'days_before', days_before FROM th)""") + f"""
SELECT {OUTCOME_SQL} AS outcome, c AS "column", {d('p')} AS p, count(v) AS n_values, TRUE AS within_bound
FROM lc, (SELECT unnest([0.25, 0.5, 0.75]) AS p) GROUP BY label, c, p"""

ORACLE["eda_volume_by_outcome"] = with_ctes(*TRAIN_CTES, """
pa AS (SELECT alert_id, label, count(*) AS n FROM th GROUP BY alert_id, label)""") + f"""
SELECT {OUTCOME_SQL} AS outcome, {d('avg(n)')} AS mean, {d('quantile_cont(n, 0.5)')} AS median,
       {d('min(n)')} AS min, {d('max(n)')} AS max
FROM pa GROUP BY label"""

ORACLE["eda_days_before_hist"] = with_ctes(*TRAIN_CTES) + f"""
SELECT {d('floor(days_before / 10) * 10')} AS bucket, {OUTCOME_SQL} AS outcome, count(*) AS transactions
FROM th WHERE days_before < 180 GROUP BY 1, 2"""

ORACLE["eda_type_by_outcome"] = with_ctes(*TRAIN_CTES) + f"""
SELECT tx_type, {OUTCOME_SQL} AS outcome, count(*) AS transactions
FROM th WHERE tx_type IS NOT NULL GROUP BY 1, 2"""

ORACLE["eda_days_before_share"] = with_ctes(*TRAIN_CTES, f"""
hb AS (SELECT floor(days_before / 10) * 10 AS bucket, {OUTCOME_SQL} AS outcome, count(*) AS n
       FROM th WHERE days_before < 180 GROUP BY 1, 2)""") + f"""
SELECT {d('bucket')} AS bucket, outcome, {d('CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY outcome)')} AS share FROM hb"""

ORACLE["eda_type_mix_share"] = with_ctes(*TRAIN_CTES, f"""
tb AS (SELECT tx_type, {OUTCOME_SQL} AS outcome, count(*) AS n FROM th WHERE tx_type IS NOT NULL GROUP BY 1, 2),
sh AS (SELECT tx_type, outcome, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY outcome) AS share FROM tb)""") + f"""
SELECT tx_type, {d("max(share) FILTER (WHERE outcome = 'Dismissed')")} AS Dismissed,
       {d("max(share) FILTER (WHERE outcome = 'Escalated')")} AS Escalated
FROM sh GROUP BY tx_type"""

ORACLE["eda_headline"] = with_ctes(*TRAIN_CTES) + f"""
SELECT {d('avg(CAST(label AS DOUBLE))')} AS escalation_rate, count(*) AS alerts,
       (SELECT count(*) FROM th) AS transactions,
       min(alert_date) AS first_alert_date, max(alert_date) AS last_alert_date
FROM ta"""


def _guarded(table: str, *texts: str) -> str:
    rows = f"({ORACLE[f'eda_{table}']})"
    leak = " OR ".join(f"{c} IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)" for c in texts) or "false"
    return (f"SELECT '{table}' AS \"table\", least(count(*), 5001) AS rows_seen, count(*) < 5000 AS small, true AS no_raw_ids, "
            f"count(*) FILTER (WHERE {leak}) = 0 AS no_id_values FROM {rows} g")


ORACLE["publish_guard"] = " UNION ALL ".join([
    _guarded("target", "outcome"), _guarded("weekly_volume"), _guarded("direction", "direction"), _guarded("types", "type"),
    _guarded("amount_by_outcome", "outcome"), _guarded("volume_by_outcome", "outcome"),
    _guarded("days_before_hist", "outcome"), _guarded("type_by_outcome", "tx_type", "outcome")])

ORACLE["history_profile"] = with_ctes(*TRAIN_CTES) + f"""
SELECT count(days_before) AS count, {d('avg(days_before)')} AS mean, {d('stddev_samp(days_before)')} AS std,
       {d('min(days_before)')} AS min, {d('quantile_cont(days_before, 0.25)')} AS p25,
       {d('quantile_cont(days_before, 0.5)')} AS p50, {d('quantile_cont(days_before, 0.75)')} AS p75,
       {d('max(days_before)')} AS max
FROM th"""


# ------------------------------------------------ ranks, folds, blends, checks

def _model_ctes() -> list[str]:
    from ..operators.features import feature_columns
    cols = feature_columns()
    ctes, body = feature_parts(None, raw=True)
    med = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}" for c in cols)
    imp = ", ".join(f"coalesce(CAST(fl.{c} AS DOUBLE), coalesce(med.{c}, 0.0)) AS {c}" for c in cols)
    return ctes + [
        f"feat AS ({body})",
        "fl AS (SELECT feat.*, a.label, a.split FROM feat JOIN alerts a ON feat.alert_id = a.alert_id)",
        f"med AS (SELECT {med} FROM fl WHERE split = 'train')",
        f"imp AS (SELECT fl.alert_id, fl.label, fl.split, {imp} FROM fl, med)",
        "tr AS (SELECT * FROM imp WHERE split = 'train')",
        "te AS (SELECT * FROM imp WHERE split = 'test')",
    ]


def pct_expr(part: str, score: str) -> str:
    """Average-tie rank percentile over a partition."""
    by = f"PARTITION BY {part}" if part else ""
    sep = ", " if part else ""
    return (f"(rank() OVER ({by} ORDER BY {score}) + (count(*) OVER (PARTITION BY {part}{sep}{score}) - 1) / 2.0 - 1)"
            f" / greatest(count(*) OVER ({by}) - 1, 1)")


def auc_cte(name: str, src: str, keys: list[str], score: str, label: str = "label") -> str:
    """ROC-AUC per group by the Mann-Whitney average-rank formula."""
    part = ", ".join(keys)
    by = f"PARTITION BY {part}" if keys else ""
    sep = ", " if keys else ""
    group = f"GROUP BY {part}" if keys else ""
    sel = f"{part}, " if keys else ""
    return f"""{name}_r AS (SELECT {sel}{label} AS _lab,
        rank() OVER ({by} ORDER BY {score}) + (count(*) OVER (PARTITION BY {part}{sep}{score}) - 1) / 2.0 AS _ar
        FROM {src} WHERE {score} IS NOT NULL AND {label} IS NOT NULL),
    {name} AS (SELECT {sel}
        (sum(_ar) FILTER (WHERE _lab = 1) - count(*) FILTER (WHERE _lab = 1) * (count(*) FILTER (WHERE _lab = 1) + 1) / 2.0)
          / nullif(CAST(count(*) FILTER (WHERE _lab = 1) AS DOUBLE) * count(*) FILTER (WHERE _lab = 0), 0) AS auc,
        count(*) FILTER (WHERE _lab = 1) AS n_pos, count(*) FILTER (WHERE _lab = 0) AS n_neg
        FROM {name}_r {group})"""


STANDIN_MODELS = ("base_mean", "dir_sh_out", "win_rate30", "amt_q90")
GRID_MODELS = STANDIN_MODELS[:3]


def _standin_long(src: str, models=STANDIN_MODELS) -> str:
    return " UNION ALL ".join(f"SELECT alert_id, label, '{m}' AS model, {m} AS score FROM {src}" for m in models)


FOLDS_CTE = """reps AS (SELECT alert_id, label, r FROM tr, (SELECT unnest(range(4)) AS r) s),
folds AS (SELECT alert_id, r, (row_number() OVER (PARTITION BY r, label
            ORDER BY md5(CAST(alert_id AS VARCHAR) || ':' || CAST(42 + r AS VARCHAR))) - 1) % 5 AS fold FROM reps)"""

OOF_CTES = [FOLDS_CTE,
            f"sl AS ({_standin_long('tr')})",
            f"""oof AS (SELECT sl.alert_id, sl.label, f.r, f.fold, sl.model,
                {pct_expr('sl.model, f.r, f.fold', 'sl.score')} AS score
                FROM sl JOIN folds f ON sl.alert_id = f.alert_id)"""]

M = _model_ctes()

ORACLE["stratified_folds"] = with_ctes(*M, FOLDS_CTE) + """
SELECT alert_id, CAST(r AS BIGINT) AS "repeat", CAST(fold AS BIGINT) AS fold FROM folds"""

ORACLE["holdout_split"] = with_ctes(*M) + """
SELECT alert_id, CAST(label AS BIGINT) AS label,
  row_number() OVER (PARTITION BY label ORDER BY md5(CAST(alert_id AS VARCHAR) || ':42'))
    <= ceil(round(CAST(0.2 AS DOUBLE) * count(*) OVER (PARTITION BY label), 9)) AS is_holdout
FROM tr"""

def _imputed_select() -> str:
    from ..operators.features import feature_columns
    return ", ".join(f"{d(c)} AS {c}" for c in feature_columns())


ORACLE["median_impute"] = with_ctes(*M) + f"SELECT alert_id, {_imputed_select()} FROM imp"


def _long_cte() -> str:
    from ..operators.features import feature_columns
    cols = ", ".join(feature_columns())
    return f"""lg AS (UNPIVOT (SELECT alert_id, label, {cols} FROM tr) ON {cols} INTO NAME "column" VALUE "value")"""


ORACLE["roc_auc_by_column"] = with_ctes(*M, _long_cte(), auc_cte("ac", "lg", ['"column"'], '"value"')) + f"""
SELECT "column", {d('auc')} AS auc, n_pos, n_neg FROM ac"""

ORACLE["rank_percentile"] = with_ctes(*M, f"sl AS ({_standin_long('tr')})") + f"""
SELECT alert_id, model, {d(pct_expr('model', 'score'))} AS pct FROM sl"""


def _union_select() -> str:
    from ..operators.features import feature_columns
    return ", ".join(feature_columns())


_FC, _FB = feature_parts(None)
ORACLE["union_split"] = with_ctes(*_FC, f"featr AS ({_FB})") + f"""
SELECT alert_id, {_union_select()}, CAST(CASE WHEN alert_id % 10 >= 7 THEN 1 ELSE 0 END AS BIGINT) AS is_test
FROM featr"""

ORACLE["null_verdict"] = with_ctes(*M, """
nb AS (SELECT alert_id, label, base_mean AS score FROM tr),
pos0 AS (SELECT alert_id, score, row_number() OVER (ORDER BY md5(CAST(alert_id AS VARCHAR))) AS p FROM nb),
seeds AS (SELECT unnest(range(42, 47)) AS seed),
perm AS (SELECT seed, label, row_number() OVER (PARTITION BY seed
          ORDER BY md5(CAST(alert_id AS VARCHAR) || ':' || CAST(seed AS VARCHAR))) AS p FROM nb, seeds),
sh AS (SELECT perm.seed, pos0.score, perm.label FROM pos0 JOIN perm ON pos0.p = perm.p)""",
                                 auc_cte("pa", "sh", ["seed"], "score"), """
agg AS (SELECT avg(auc) AS m, count(auc) AS n_scores, sqrt(1.0 / greatest(CAST((SELECT count(*) FROM nb) AS DOUBLE), 2.0)) AS se,
        (SELECT count(*) FROM nb) AS n_rows FROM pa)""") + f"""
SELECT CASE WHEN abs(m - 0.5) <= 2 * se THEN 'clean' WHEN m - 0.5 > 0.10 THEN 'leaking' ELSE 'optimistic' END AS verdict,
       {d('m')} AS null_mean, {d('2 * se')} AS two_se, CAST(n_rows AS BIGINT) AS n_rows, CAST(n_scores AS BIGINT) AS n_scores
FROM agg"""

ORACLE["cv_summary"] = with_ctes(*M, *OOF_CTES, auc_cte("ra", "oof", ["model", "r"], "score")) + f"""
SELECT model, {d('avg(auc)')} AS cv_mean, {d('stddev_pop(auc)')} AS cv_std, {d('avg(auc) - stddev_pop(auc)')} AS score
FROM ra GROUP BY model"""

_W = 1.0 / len(STANDIN_MODELS)


def _blend_expr(models=STANDIN_MODELS, w=_W) -> str:
    return "0.0 + " + " + ".join(f"{w!r} * max(pct) FILTER (WHERE model = '{m}')" for m in models)


ORACLE["rank_average"] = with_ctes(*M, f"sl AS ({_standin_long('tr')})",
                                   f"pc AS (SELECT alert_id, model, {pct_expr('model', 'score')} AS pct FROM sl)") + f"""
SELECT alert_id, {d(_blend_expr())} AS score FROM pc GROUP BY alert_id"""

ORACLE["blend_by_repeat"] = with_ctes(*M, *OOF_CTES, f"""
bp AS (SELECT alert_id, label, r, model, {pct_expr('r, model', 'score')} AS pct FROM oof)""", f"""
bl AS (SELECT alert_id, min(label) AS label, r, {_blend_expr()} AS score FROM bp GROUP BY alert_id, r)""",
                                      auc_cte("ba", "bl", ["r"], "score")) + f"""
SELECT CAST(r AS BIGINT) AS "repeat", {d('auc')} AS auc,
       {d('avg(auc) OVER ()')} AS blend_mean, {d('stddev_pop(auc) OVER ()')} AS blend_std
FROM ba"""

_WIDE = [f"sg AS ({_standin_long('tr', GRID_MODELS)})",
         f"sp AS (SELECT alert_id, label, model, {pct_expr('model', 'score')} AS pct FROM sg)",
         "wide AS (SELECT alert_id, min(label) AS label, "
         + ", ".join(f"max(pct) FILTER (WHERE model = '{m}') AS {m}" for m in GRID_MODELS)
         + " FROM sp GROUP BY alert_id)",
         """grid AS (SELECT row_number() OVER (ORDER BY a, b) - 1 AS grid_id,
             CAST(a AS DOUBLE) / 10 AS w1, CAST(b AS DOUBLE) / 10 AS w2, CAST(10 - a - b AS DOUBLE) / 10 AS w3
             FROM (SELECT unnest(range(11)) AS a) t1, (SELECT unnest(range(11)) AS b) t2 WHERE a + b <= 10)""",
         f"""gs AS (SELECT grid.grid_id, wide.label,
             0.0 + grid.w1 * wide.{GRID_MODELS[0]} + grid.w2 * wide.{GRID_MODELS[1]} + grid.w3 * wide.{GRID_MODELS[2]} AS s
             FROM wide, grid)""",
         auc_cte("ga", "gs", ["grid_id"], "s"),
         """gj AS (SELECT grid.*, ga.auc FROM grid JOIN ga ON grid.grid_id = ga.grid_id)"""]

ORACLE["weight_grid"] = with_ctes(*M, *_WIDE) + f"""
SELECT CAST(grid_id AS BIGINT) AS grid_id, {d('w1')} AS w_{GRID_MODELS[0]}, {d('w2')} AS w_{GRID_MODELS[1]},
       {d('w3')} AS w_{GRID_MODELS[2]}, {d('auc')} AS auc FROM gj"""

def _refined(delta: int, source: str) -> list[str]:
    """CTEs of one refinement step: the best of `source` and its neighbours, scored as rj<delta>."""
    t1, t2, t3 = GRID_MODELS
    return [
        f"rb{delta} AS (SELECT CAST(round(100 * w1) AS INTEGER) AS h1, CAST(round(100 * w2) AS INTEGER) AS h2 FROM {source} ORDER BY round(auc, 9) DESC, grid_id LIMIT 1)",
        f"""rp{delta} AS (SELECT row_number() OVER (ORDER BY i <> 0 OR j <> 0, i, j) - 1 AS grid_id,
             CAST(h1 + i AS DOUBLE) / 100 AS w1, CAST(h2 + j AS DOUBLE) / 100 AS w2, CAST(100 - h1 - i - h2 - j AS DOUBLE) / 100 AS w3
             FROM rb{delta}, (SELECT unnest([-{delta}, 0, {delta}]) AS i) ti, (SELECT unnest([-{delta}, 0, {delta}]) AS j) tj
             WHERE h1 + i BETWEEN 0 AND 100 AND h2 + j BETWEEN 0 AND 100 AND 100 - h1 - i - h2 - j BETWEEN 0 AND 100)""",
        f"""rs{delta} AS (SELECT p.grid_id, wide.label, 0.0 + p.w1 * wide.{t1} + p.w2 * wide.{t2} + p.w3 * wide.{t3} AS s FROM wide, rp{delta} p)""",
        auc_cte(f"ra{delta}", f"rs{delta}", ["grid_id"], "s"),
        f"rj{delta} AS (SELECT p.*, a.auc FROM rp{delta} p JOIN ra{delta} a ON p.grid_id = a.grid_id)"]


ORACLE["weight_choice"] = with_ctes(*M, *_WIDE, *_refined(5, "gj"), *_refined(2, "rj5"), *_refined(1, "rj2"), f"""
eq AS (SELECT label, ({' + '.join(f'0.0 + wide.{m}' if i == 0 else f'wide.{m}' for i, m in enumerate(GRID_MODELS))}) / {len(GRID_MODELS)} AS s FROM wide)""",
                                    auc_cte("ea", "eq", [], "s"), """
best AS (SELECT w1, w2, w3, auc FROM rj1 ORDER BY round(auc, 9) DESC, grid_id LIMIT 1),
ch AS (SELECT best.*, ea.auc AS equal_auc, best.auc - ea.auc >= 0.001 AS use_fit FROM best, ea)""") + f"""
SELECT CASE WHEN use_fit THEN 'fitted' ELSE 'equal' END AS method, {d('equal_auc')} AS equal_auc,
       {d('auc')} AS fitted_auc,
       {d(f'CASE WHEN use_fit THEN w1 ELSE {1.0 / len(GRID_MODELS)!r} END')} AS w_{GRID_MODELS[0]},
       {d(f'CASE WHEN use_fit THEN w2 ELSE {1.0 / len(GRID_MODELS)!r} END')} AS w_{GRID_MODELS[1]},
       {d(f'CASE WHEN use_fit THEN w3 ELSE {1.0 / len(GRID_MODELS)!r} END')} AS w_{GRID_MODELS[2]}
FROM ch"""

_TEST_SCORES = [f"tl AS ({_standin_long('te')})",
                f"tp AS (SELECT alert_id, model, {pct_expr('model', 'score')} AS pct FROM tl)",
                f"ts AS (SELECT alert_id, {_blend_expr()} AS score FROM tp GROUP BY alert_id)",
                "ex AS (SELECT alert_id FROM alerts WHERE split = 'test')"]

ORACLE["result_check"] = with_ctes(*M, *_TEST_SCORES, """
st AS (SELECT count(*) AS n_rows, count(DISTINCT alert_id) AS n_ids, count(*) FILTER (WHERE alert_id IS NULL) AS null_ids,
       count(*) FILTER (WHERE score IS NULL) AS nulls,
       count(*) FILTER (WHERE score IS NULL OR score < 0 OR score > 1) AS oor, count(DISTINCT score) AS dist,
       (SELECT count(*) FROM (SELECT DISTINCT alert_id FROM ex) e WHERE alert_id NOT IN (SELECT alert_id FROM ts WHERE alert_id IS NOT NULL)) AS missing,
       (SELECT count(*) FROM (SELECT DISTINCT alert_id FROM ts WHERE alert_id IS NOT NULL) g WHERE alert_id NOT IN (SELECT alert_id FROM ex)) AS extra,
       (SELECT count(*) FROM ex) AS n_exp
       FROM ts)""") + """
SELECT * FROM (
  SELECT 1 AS rule_id, 'the columns are alert_id and score, in this order, and no others' AS rule, true AS passed, 'got [alert_id, score]' AS detail FROM st
  UNION ALL SELECT 2, 'as many rows as requested ids', n_rows = n_exp, printf('%d rows vs %d expected', n_rows, n_exp) FROM st
  UNION ALL SELECT 3, 'every requested id has a row', missing = 0, printf('%d missing', missing) FROM st
  UNION ALL SELECT 4, 'no id that was not requested', extra = 0, printf('%d extra', extra) FROM st
  UNION ALL SELECT 5, 'each id at most once', n_rows - n_ids - least(null_ids, 1) = 0,
            printf('%d duplicated', n_rows - n_ids - least(null_ids, 1)) FROM st
  UNION ALL SELECT 6, 'every score is a number', nulls = 0, printf('%d null', nulls) FROM st
  UNION ALL SELECT 7, 'scores lie between 0 and 1', oor = 0, printf('%d out of range', oor) FROM st
  UNION ALL SELECT 8, 'at least two different scores', dist > 1, printf('%d distinct value(s)', dist) FROM st)"""

ORACLE["result_ordered"] = with_ctes(*M, *_TEST_SCORES, """
eo AS (SELECT alert_id, row_number() OVER (ORDER BY md5(CAST(alert_id AS VARCHAR))) AS ordinal FROM ex)""") + f"""
SELECT CAST(eo.ordinal AS BIGINT) AS ordinal, eo.alert_id, {d('ts.score')} AS score
FROM eo LEFT JOIN ts ON eo.alert_id = ts.alert_id"""

ORACLE["top_columns"] = with_ctes(*M, _long_cte(), auc_cte("ac", "lg", ['"column"'], '"value"'), """
rk AS (SELECT "column", auc, row_number() OVER (ORDER BY round(auc, 9) DESC, "column" ASC) AS rn FROM ac)""") + f"""
SELECT "column", {d('auc')} AS auc, CAST(rn AS BIGINT) AS rank FROM rk WHERE rn <= 10"""


def _trace_ctes() -> list[str]:
    offers = [(r, f, family_columns(f)[r - 1]) for r in range(1, TRACE_ROUNDS + 1) for f in FAMILIES]
    listed = ", ".join(f"({r}, '{f}', '{c}')" for r, f, c in offers)
    return [_long_cte(), auc_cte("ac", "lg", ['"column"'], '"value"'), f"""
offer AS (SELECT * FROM (VALUES {listed}) AS v(round, family, "column")),
trace AS (SELECT round, family, round AS n_columns, round(auc, 9) AS score,
                 row_number() OVER (PARTITION BY round ORDER BY round(auc, 9) DESC, family) = 1 AS accepted
          FROM offer JOIN ac USING ("column"))"""]


ORACLE["trace_rounds"] = with_ctes(*M, *_trace_ctes()) + f"""
SELECT {b('round')} AS round, family, {b('n_columns')} AS n_columns, {d('score')} AS mean, {d('0.0')} AS std, {d('score')} AS score,
       accepted, row_number() OVER (PARTITION BY family ORDER BY round) AS family_round FROM trace"""

ORACLE["trace_first_round"] = with_ctes(*M, *_trace_ctes()) + f"""
SELECT row_number() OVER (ORDER BY score DESC, family) AS place, family, {b('n_columns')} AS n_columns, {d('score')} AS mean,
       {d('score')} AS score FROM trace WHERE round = 1"""

ORACLE["trace_ablation"] = with_ctes(*M, *_trace_ctes()) + f"""
SELECT {b('round')} AS round, family, {b('n_columns')} AS n_columns, {d('score')} AS mean,
       CASE WHEN accepted THEN 'kept' ELSE 'rejected' END AS verdict FROM trace"""

ORACLE["trace_verdict"] = with_ctes(*M, *_trace_ctes()) + """
SELECT count(DISTINCT family) FILTER (WHERE score <= 0.5) AS chance_families,
       count(DISTINCT family) - count(DISTINCT family) FILTER (WHERE accepted) AS rejected_families FROM trace"""

ORACLE["expected_ids"] = with_ctes() + """
SELECT CAST(alert_id AS VARCHAR) AS alert_id, row_number() OVER (ORDER BY md5(CAST(alert_id AS VARCHAR))) AS ordinal
FROM alerts WHERE split = 'test'"""
