"""DuckDB SQL for every query that SQL can express, written independently.

The statements share the sample mapping and small text helpers; profile specs
come from the library so that no column can be forgotten, but each statistic
and each derived column is spelled out here in DuckDB terms.
"""

from __future__ import annotations

from itertools import combinations

from cardloom.operators import encode, profiles
from cardloom.operators.calendar import window_name
from cardloom.operators.lags import PREFIX
from cardloom.schemas import LAGS
from cardloom.sources import tpch_cards as X

ORACLES: dict[str, str] = {}

AS_OF = f"TIMESTAMP '{X.AS_OF} 00:00:00'"
ROW = "card_id, CAST(purchase_date AS VARCHAR) AS purchase_date"

BASE = """
t AS (
  SELECT concat('C_', o_custkey, '_', ((2001 - year(o_orderdate)) * 12 + 8 - month(o_orderdate)) // 16) AS card_id,
         CASE WHEN l_suppkey % 20 = 0 THEN NULL ELSE concat('M_', l_suppkey) END AS merchant_id,
         p_size AS merchant_category_id, p_brand AS subsector_id,
         s_nationkey AS city_id, n_regionkey AS state_id,
         CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS authorized_flag,
         CASE WHEN o_orderstatus = 'P' THEN 'Y' ELSE 'N' END AS category_1,
         CASE WHEN o_orderpriority LIKE '4%' THEN NULL
              ELSE CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) END AS category_2,
         CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'B'
              WHEN 'R' THEN CASE WHEN l_linenumber = 7 THEN NULL ELSE 'C' END END AS category_3,
         CASE WHEN l_quantity = 50 THEN 999 WHEN l_quantity = 1 THEN -1
              ELSE l_linenumber - 1 END AS installments,
         l_extendedprice / 60000.0e0 - 0.75e0 AS purchase_amount,
         o_orderdate + to_seconds((l_orderkey * 37 + l_linenumber * 3607) % 86400) AS purchase_date,
         CAST(2 - ((2001 - year(o_orderdate)) * 12 + 8 - month(o_orderdate)) % 16 AS INT) AS month_lag
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
),
hist AS (SELECT * FROM t WHERE month_lag BETWEEN -13 AND 0),
newlog AS (SELECT * FROM t WHERE month_lag IN (1, 2)),
cards AS (
  SELECT concat('C_', c_custkey, '_', w) AS card_id,
         make_date(1998 + CAST(c_custkey % 3 AS INT), 1 + CAST(c_custkey % 12 AS INT), 1)
           AS first_active_month,
         1 + c_nationkey % 5 AS feature_1, 1 + c_nationkey % 3 AS feature_2,
         CAST(c_custkey % 2 AS INT) AS feature_3,
         CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_acctbal < -700 THEN -33.2e0
              ELSE c_acctbal / 2000.0e0 - 2.5e0 END AS target
  FROM customer, range(5) r(w)
),
flagged AS (
  SELECT *, CASE WHEN target IS NULL THEN NULL WHEN target < -30 THEN 1 ELSE 0 END AS outliers
  FROM cards
)
"""


def q(name: str) -> str:
    return f'"{name}"'


def dbl(expr: str, name: str) -> str:
    x = f"CAST({expr} AS DOUBLE)"
    return (
        f"CASE WHEN abs({x}) < 100 THEN round({x} + 3.14159e-8, 6)"
        f" WHEN abs({x}) < 1e6 THEN round({x} + 3.14159e-8, 3)"
        f" ELSE round({x} + 3.14159e-5, 0) END + 0.0e0 AS {q(name)}"
    )


def big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {q(name)}"


def txt(expr: str, name: str) -> str:
    return f"CAST({expr} AS VARCHAR) AS {q(name)}"


def dbls(names, source: str = "") -> str:
    return ", ".join(dbl(source + q(n), n) for n in names)


def bigs(names) -> str:
    return ", ".join(big(q(n), n) for n in names)


def over(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([BASE.strip(), *[c.strip() for c in ctes]]) + "\n" + body


def days(later: str, earlier: str) -> str:
    return f"CAST(floor(date_diff('microsecond', {earlier}, {later}) / 86400000000.0e0) AS BIGINT)"


def months(col: str = "purchase_date") -> str:
    return f"CAST(floor({days(AS_OF, col)} / 30.0e0) AS BIGINT)"


# Cleaning


def clean(log: str, name: str, amount: str = "clip", unknown: bool = False) -> str:
    value = {
        "clip": "CASE WHEN purchase_amount > 0.8e0 THEN 0.8e0 ELSE purchase_amount END",
        "restore": "round_even(purchase_amount / 0.00150265118e0 + 497.06e0, 8)",
    }[amount]
    category = (
        "CASE coalesce(category_3, 'D') WHEN 'D' THEN 0 WHEN 'A' THEN 1 WHEN 'B' THEN 2 ELSE 3 END"
        if unknown
        else "CASE coalesce(category_3, 'A') WHEN 'A' THEN 0 WHEN 'B' THEN 1 ELSE 2 END"
    )
    return f"""{name} AS (
      SELECT card_id, coalesce(merchant_id, 'M_ID_00a6ca8a8a') AS merchant_id,
             merchant_category_id, subsector_id, city_id, state_id,
             CASE authorized_flag WHEN 'Y' THEN 1 ELSE 0 END AS authorized_flag,
             CASE category_1 WHEN 'Y' THEN 1 ELSE 0 END AS category_1,
             coalesce(category_2, 1.0e0) AS category_2, {category} AS category_3,
             CASE WHEN installments IN (-1, 999) THEN NULL ELSE installments END AS installments,
             {value} AS purchase_amount, purchase_date, month_lag
      FROM {log})"""


def holiday_columns(holidays) -> str:
    out = []
    for name, date in holidays.items():
        d = days(f"TIMESTAMP '{date} 00:00:00'", "purchase_date")
        out.append(f"CASE WHEN {d} > 0 AND {d} < 100 THEN {d} ELSE 0 END AS {name}")
    return ", ".join(out)


PARTS = """month(purchase_date) AS month, day(purchase_date) AS day, hour(purchase_date) AS hour,
  weekofyear(purchase_date) AS weekofyear, isodow(purchase_date) - 1 AS weekday"""
WEEKEND = "CASE WHEN isodow(purchase_date) >= 6 THEN 1 ELSE 0 END AS weekend"


def enriched(source: str, name: str, holidays, plus1: bool = False, lag: bool = True) -> str:
    divisor = "(installments + 1)" if plus1 else "installments"
    md = months() + (" + month_lag" if lag else "")
    return f"""{name}_0 AS (
      SELECT *, {PARTS}, {WEEKEND}, purchase_amount / nullif({divisor}, 0) AS price,
             {holiday_columns(holidays)}, {md} AS month_diff,
             avg(purchase_amount) OVER (PARTITION BY category_2) AS category_2_mean,
             avg(purchase_amount) OVER (PARTITION BY category_3) AS category_3_mean
      FROM {source}),
    {name} AS (
      SELECT *, purchase_amount * month_diff AS duration,
             purchase_amount / nullif(month_diff, 0) AS amount_month_ratio
      FROM {name}_0)"""


def amount_source(log: str, name: str) -> str:
    return (
        clean(log, f"{name}_c", "restore", True)
        + f""",
    {name}_0 AS (
      SELECT *, {WEEKEND}, purchase_amount / nullif(installments + 1, 0) AS price,
             {months()} + month_lag AS month_diff, {months()} AS nomonth_diff,
             avg(purchase_amount) OVER (PARTITION BY category_3) AS category_3_mean
      FROM {name}_c),
    {name} AS (
      SELECT *, purchase_amount * month_diff AS duration,
             purchase_amount / nullif(month_diff, 0) AS amount_month_ratio,
             purchase_amount * nomonth_diff AS duration_no,
             purchase_amount / nullif(nomonth_diff, 0) AS amount_month_ratio_no,
             authorized_flag * purchase_amount AS authorized_flag_amount,
             category_1 * purchase_amount AS category_1_amount,
             category_2 * purchase_amount AS category_2_amount,
             category_3 * purchase_amount AS category_3_amount,
             weekend * purchase_amount AS weekend_amount,
             purchase_amount / nullif(month_lag - 1, 0) AS monthlag_amount
      FROM {name}_0)"""
    )


# Profiles

STATS = {
    "sum": "coalesce(sum({c}), 0)",
    "mean": "avg({c})",
    "min": "min({c})",
    "max": "max({c})",
    "var": "var_samp({c})",
    "skew": "CASE WHEN count({c}) < 3 THEN NULL WHEN min({c}) = max({c}) THEN 0 ELSE skewness({c}) END",
    "size": "count(*)",
    "count": "count({c})",
    "nunique": "count(DISTINCT {c})",
    "small_nunique": "count(DISTINCT {c})",
}
DATES = ("purchase_date_max", "purchase_date_min")


def stat_name(prefix: str, column: str, stat: str) -> str:
    return f"{prefix}{column}_{stat.removeprefix('small_')}"


def grouped(source: str, key: str, spec, prefix: str, name: str, where: str = "true") -> str:
    cols = [
        STATS[s].replace("{c}", q(c)) + f" AS {q(stat_name(prefix, c, s))}"
        for c, stats in spec.items()
        for s in stats
    ]
    return f"""{name} AS (SELECT {key}, {', '.join(cols)} FROM {source}
      WHERE {where} AND {key} IS NOT NULL GROUP BY {key})"""


def spec_names(spec, prefix: str) -> list[str]:
    return [stat_name(prefix, c, s) for c, stats in spec.items() for s in stats]


def span(prefix: str, size: str = "card_id_size") -> str:
    lo, hi = q(prefix + "purchase_date_min"), q(prefix + "purchase_date_max")
    return ", ".join(
        [
            f"{days(hi, lo)} AS {q(prefix + 'purchase_date_diff')}",
            f"{days(hi, lo)} / CAST({q(prefix + size)} AS DOUBLE) AS {q(prefix + 'purchase_date_average')}",
            f"{days(AS_OF, hi)} AS {q(prefix + 'purchase_date_uptonow')}",
            f"{days(AS_OF, lo)} AS {q(prefix + 'purchase_date_uptomin')}",
        ]
    )


SPAN = ("diff", "average", "uptonow", "uptomin")


def present_profile(names, key: str = "card_id", dates: bool = True) -> str:
    out = [key]
    for n in names:
        if n.endswith(DATES):
            if dates:
                out.append(txt(q(n), n))
        else:
            out.append(dbl(q(n), n))
    return ", ".join(out)


def profile_ctes(kind: str) -> tuple[list[str], list[str], str]:
    """ctes, column names, name of the last cte."""
    if kind == "hist":
        spec, p = profiles.hist_spec(tuple(X.HOLIDAYS)), "hist_"
        ctes = [clean("hist", "hc"), enriched("hc", "he", X.HOLIDAYS), grouped("he", "card_id", spec, p, "hp0")]
        ctes.append(f"hp AS (SELECT *, {span(p)} FROM hp0)")
        return ctes, spec_names(spec, p) + [f"{p}purchase_date_{x}" for x in SPAN], "hp"
    if kind == "new":
        spec, p = profiles.new_spec(tuple(X.NEW_HOLIDAYS)), "new_"
        ctes = [clean("newlog", "nc"), enriched("nc", "ne", X.NEW_HOLIDAYS), grouped("ne", "card_id", spec, p, "np0")]
        ctes.append(f"np AS (SELECT *, {span(p)} FROM np0)")
        return ctes, spec_names(spec, p) + [f"{p}purchase_date_{x}" for x in SPAN], "np"
    if kind == "hist_merchant":
        spec, p = profiles.merchant_spec(tuple(X.HOLIDAYS)), "hist_"
        ctes = [
            clean("hist", "hmc"),
            enriched("hmc", "hme", X.HOLIDAYS, plus1=True),
            grouped("hme", "merchant_id", spec, p, "hm0"),
        ]
        ctes.append(f"hm AS (SELECT *, {span(p, 'merchant_id_size')} FROM hm0)")
        return ctes, spec_names(spec, p) + [f"{p}purchase_date_{x}" for x in SPAN], "hm"
    spec, p = profiles.merchant_spec(tuple(X.HOLIDAYS)), "new_"
    ctes = [
        clean("newlog", "nmc", "restore"),
        enriched("nmc", "nme", X.HOLIDAYS, plus1=True),
        grouped("nme", "merchant_id", spec, p, "nm0"),
    ]
    ctes.append(f"nm AS (SELECT *, {span(p, 'merchant_id_size')} FROM nm0)")
    return ctes, spec_names(spec, p) + [f"{p}purchase_date_{x}" for x in SPAN], "nm"


HIST, HIST_NAMES, _ = profile_ctes("hist")
NEW, NEW_NAMES, _ = profile_ctes("new")
HM, HM_NAMES, _ = profile_ctes("hist_merchant")
NM, NM_NAMES, _ = profile_ctes("new_merchant")

# Scans, sinks, schema

CARD_COLUMNS = (
    "card_id, "
    + txt("first_active_month", "first_active_month")
    + ", "
    + bigs(["feature_1", "feature_2", "feature_3"])
    + ", "
    + dbl("target", "target")
)
ORACLES["read_cards"] = over(f"SELECT {CARD_COLUMNS} FROM cards")
ORACLES["checkpoint_write_read"] = ORACLES["read_cards"]
ORACLES["read_mixed_headers"] = ORACLES["read_cards"]
_later = days("TIMESTAMP '2001-10-01'", "first_active_month")
ORACLES["checkpoint_resumed"] = over(
    " UNION ALL ".join(
        f"SELECT '{step}' AS step, CAST({made} AS BIGINT) AS made, count(*) AS n_rows,"
        f" CAST(sum({age}) AS BIGINT) AS days FROM cards WHERE {which}"
        for step, made, age, which in (
            ("1 first", 1, days(AS_OF, "first_active_month"), "true"),
            ("2 equal", 1, days(AS_OF, "first_active_month"), "true"),
            ("3 other day", 2, _later, "true"),
            ("4 other cards", 3, _later, "target IS NOT NULL"),
            ("5 equal", 3, _later, "target IS NOT NULL"),
        )
    )
)
ORACLES["read_transactions"] = over(
    f"""SELECT authorized_flag, {ROW}, {bigs(['city_id'])}, category_1, {bigs(['installments'])},
    category_3, {bigs(['merchant_category_id'])}, merchant_id, {bigs(['month_lag'])},
    {dbls(['purchase_amount', 'category_2'])}, {bigs(['state_id'])},
    {big("substr(subsector_id, 7)", 'subsector_id')} FROM hist"""
)
ORACLES["read_limited"] = over("SELECT count(*) AS n FROM (SELECT * FROM hist LIMIT 100)")
ORACLES["read_columns_for_ids"] = over("SELECT card_id FROM cards WHERE target IS NULL")
ORACLES["write_scores_csv"] = over(
    f"SELECT card_id, {dbl('target', 'target')} FROM cards WHERE target IS NOT NULL"
)
ORACLES["hist_merchant_profile"] = over(
    f"SELECT {present_profile(HM_NAMES, 'merchant_id')} FROM hm", *HM
)
ORACLES["merchant_store"] = ORACLES["hist_merchant_profile"]
ORACLES["visited_merchant_profile"] = over(
    f"""SELECT {present_profile(HM_NAMES, 'merchant_id')} FROM hm
    WHERE merchant_id IN (SELECT coalesce(merchant_id, 'M_ID_00a6ca8a8a') FROM newlog)""",
    *HM,
)
ORACLES["prefix_columns"] = over(
    f"""SELECT card_id, {txt('first_active_month', 'kkkfirst_active_month')},
    {big('feature_1', 'kkkfeature_1')}, {big('feature_2', 'kkkfeature_2')},
    {big('feature_3', 'kkkfeature_3')}, {dbl('target', 'kkktarget')} FROM cards"""
)
ORACLES["select_features"] = over(
    f"SELECT {bigs(['feature_1', 'feature_2', 'feature_3'])} FROM cards"
)

MODEL_TABLE = """mt AS (
  SELECT cards.*, coalesce(hist_rows, 0) AS hist_rows, coalesce(hist_amount, 0) AS hist_amount
  FROM cards LEFT JOIN (
    SELECT card_id, count(*) AS hist_rows, sum(purchase_amount) AS hist_amount
    FROM hist GROUP BY card_id) USING (card_id))"""
ORACLES["narrow_types"] = over(
    f"""SELECT card_id, {bigs(['feature_1', 'feature_2', 'feature_3'])},
    {dbl('CAST(target AS FLOAT)', 'target')}, {bigs(['hist_rows'])},
    {dbl('CAST(hist_amount AS FLOAT)', 'hist_amount')} FROM mt""",
    MODEL_TABLE,
)

# Rows

ORACLES["flag_outliers"] = over(
    f"SELECT card_id, {dbl('target', 'target')}, {bigs(['outliers'])} FROM flagged"
)
ORACLES["split_train_test"] = over(
    f"""SELECT card_id, {dbl('target', 'target')},
    CASE WHEN target IS NULL THEN 'test' ELSE 'train' END AS part FROM cards"""
)
ORACLES["fill_defaults"] = over(
    f"""SELECT {ROW}, {dbl('coalesce(category_2, 1)', 'category_2')},
    coalesce(category_3, 'A') AS category_3,
    coalesce(merchant_id, 'M_ID_00a6ca8a8a') AS merchant_id FROM hist"""
)
ORACLES["sentinel_to_null"] = over(
    f"SELECT {ROW}, {big('nullif(nullif(installments, -1), 999)', 'installments')} FROM hist"
)
ORACLES["clip_upper"] = over(
    f"""SELECT {ROW}, {dbl('CASE WHEN purchase_amount > 0.8e0 THEN 0.8e0 ELSE purchase_amount END',
    'purchase_amount')} FROM hist"""
)
ORACLES["yn_to_int"] = over(
    f"""SELECT {ROW}, {big("authorized_flag = 'Y'", 'authorized_flag')},
    {big("category_1 = 'Y'", 'category_1')} FROM hist"""
)
ORACLES["recode_category3"] = over(
    f"""SELECT {ROW}, {big("ascii(category_3) - 65", 'category_3')} FROM hist
    UNION ALL
    SELECT {ROW}, {big("CASE WHEN category_3 IS NULL THEN 0 ELSE ascii(category_3) - 64 END",
    'category_3')} FROM newlog"""
)
ORACLES["restore_amount"] = over(
    f"""SELECT {ROW},
    {dbl('round_even(purchase_amount / 0.00150265118e0 + 497.06e0, 8)', 'purchase_amount')} FROM hist"""
)
ORACLES["parse_dates"] = over(
    f"""SELECT card_id, {txt('first_active_month', 'day')},
    {txt('CAST(first_active_month AS TIMESTAMP)', 'month')} FROM cards"""
)
ORACLES["round_target"] = over(
    f"SELECT card_id, {dbl('round_even(target, 0)', 'rounded_target')} FROM cards WHERE target IS NOT NULL"
)
ORACLES["calendar_parts"] = over(
    f"SELECT {ROW}, {bigs(['month', 'day', 'hour', 'weekofyear', 'weekday'])} FROM p",
    f"p AS (SELECT card_id, purchase_date, {PARTS} FROM hist)",
)
ORACLES["weekend_flag"] = over(
    f"SELECT {ROW}, {big('isodow(purchase_date) >= 6', 'weekend')} FROM hist"
)
ORACLES["quarter"] = over(f"SELECT card_id, {big('quarter(first_active_month)', 'quarter')} FROM cards")
ELAPSED = days(AS_OF, "CAST(first_active_month AS TIMESTAMP)")
ORACLES["elapsed_days"] = over(f"SELECT card_id, {big(ELAPSED, 'elapsed_time')} FROM cards")
ORACLES["elapsed_interactions"] = over(
    "SELECT card_id, "
    + ", ".join(big(f"{ELAPSED} * feature_{i}", f"days_feature{i}") for i in (1, 2, 3))
    + ", "
    + ", ".join(
        dbl(f"feature_{i} / CAST({ELAPSED} AS DOUBLE)", f"days_feature{i}_ratio") for i in (1, 2, 3)
    )
    + " FROM cards"
)
ROWWISE = """feature_1 + feature_2 + feature_3 AS feature_sum,
  (feature_1 + feature_2 + feature_3) / 3.0e0 AS feature_mean,
  greatest(feature_1, feature_2, feature_3) AS feature_max,
  least(feature_1, feature_2, feature_3) AS feature_min,
  list_aggregate([CAST(feature_1 AS DOUBLE), feature_2, feature_3], 'stddev_samp') AS feature_var"""
ROWWISE_NAMES = ["feature_sum", "feature_mean", "feature_max", "feature_min", "feature_var"]
ORACLES["rowwise_stats"] = over(
    f"SELECT card_id, {dbls(ROWWISE_NAMES)} FROM r", f"r AS (SELECT *, {ROWWISE} FROM cards)"
)
ORACLES["one_hot"] = over(
    "SELECT "
    + ROW
    + ", "
    + ", ".join(
        big(f"coalesce({c} = '{v}', false)", f"{c}_{v}")
        for c, values in (("category_3", "ABC"), ("category_1", "NY"))
        for v in values
    )
    + f", {big('category_3 IS NULL', 'category_3_nan')}, {big('category_1 IS NULL', 'category_1_nan')}"
    + " FROM hist"
)
KNOWN = "CASE WHEN installments NOT IN (-1, 999) THEN installments END"
ORACLES["price_ratio"] = over(
    f"SELECT {ROW}, {dbl(f'purchase_amount / nullif({KNOWN}, 0)', 'price')} FROM hist"
)
ORACLES["price_ratio_plus1"] = over(
    f"SELECT {ROW}, {dbl(f'purchase_amount / nullif({KNOWN} + 1, 0)', 'price')} FROM hist"
)
ORACLES["holiday_proximity"] = over(
    f"SELECT {ROW}, {bigs(X.HOLIDAYS)} FROM p",
    f"p AS (SELECT card_id, purchase_date, {holiday_columns(X.HOLIDAYS)} FROM hist)",
)
ORACLES["month_diff"] = over(f"SELECT {ROW}, {big(months() + ' + month_lag', 'month_diff')} FROM hist")
ORACLES["month_diff_nolag"] = over(f"SELECT {ROW}, {big(months(), 'nomonth_diff')} FROM hist")
MD, MDN = f"({months()} + month_lag)", months()
for _name, _expr in {
    "duration": f"purchase_amount * {MD}",
    "amount_month_ratio": f"purchase_amount / nullif({MD}, 0)",
    "duration_no": f"purchase_amount * {MDN}",
    "amount_month_ratio_no": f"purchase_amount / nullif({MDN}, 0)",
}.items():
    ORACLES[_name] = over(f"SELECT {ROW}, {dbl(_expr, _name)} FROM hist")
ORACLES["amount_interactions"] = over(
    "SELECT "
    + ROW
    + ", "
    + dbls(
        [
            f"{c}_amount"
            for c in ("authorized_flag", "category_3", "category_1", "category_2", "weekend")
        ]
    )
    + " FROM a",
    amount_source("hist", "a"),
)
ORACLES["monthlag_amount"] = over(
    f"""SELECT {ROW}, {dbl('CASE WHEN month_lag <> 1 THEN purchase_amount / (month_lag - 1) END',
    'monthlag_amount')} FROM newlog"""
)


def quarter_columns() -> str:
    out = []
    for start in X.QUARTER_STARTS:
        d = days(f"TIMESTAMP '{start} 00:00:00'", "purchase_date")
        flag = f"CASE WHEN {d} BETWEEN 1 AND 90 THEN 1 ELSE 0 END"
        out += [f"{flag} AS {q(window_name(start))}", f"{flag} * price AS {q(window_name(start) + 'price')}"]
    return ", ".join(out)


QUARTERS = [
    clean("hist", "qc"),
    "qp AS (SELECT *, purchase_amount / nullif(installments + 1, 0) AS price FROM qc)",
    f"qf AS (SELECT card_id, purchase_date, {quarter_columns()} FROM qp)",
]
_windows = [window_name(x) for x in X.QUARTER_STARTS]
ORACLES["quarter_window_flags"] = over(
    f"SELECT {ROW}, {bigs(_windows)}, {dbls([w + 'price' for w in _windows])} FROM qf", *QUARTERS
)
ORACLES["filter_lag_from"] = over(
    f"SELECT {ROW}, {bigs(['month_lag'])} FROM hist WHERE month_lag >= -2"
)
ORACLES["filter_lag_range"] = over(
    f"SELECT {ROW}, {bigs(['month_lag'])} FROM hist WHERE month_lag IN (-7, -6, -5, -4, -3)"
)

CARD_TABLE = [
    *[
        f"rate{i} AS (SELECT feature_{i}, avg(outliers) AS rate_{i} FROM flagged GROUP BY feature_{i})"
        for i in (1, 2, 3)
    ],
    f"""ct AS (
      SELECT card_id, first_active_month, target, outliers,
             quarter(first_active_month) AS quarter, {ELAPSED} AS elapsed_time,
             {', '.join(f'{ELAPSED} * feature_{i} AS days_feature{i}, feature_{i} / CAST({ELAPSED} AS DOUBLE) AS days_feature{i}_ratio' for i in (1, 2, 3))},
             rate_1, rate_2, rate_3
      FROM flagged LEFT JOIN rate1 USING (feature_1) LEFT JOIN rate2 USING (feature_2)
      LEFT JOIN rate3 USING (feature_3))""",
    f"""card_features AS (
      SELECT * EXCLUDE (feature_1, feature_2, feature_3), feature_1, feature_2, feature_3, {ROWWISE}
      FROM (SELECT * EXCLUDE (rate_1, rate_2, rate_3), rate_1 AS feature_1, rate_2 AS feature_2,
            rate_3 AS feature_3 FROM ct))""",
]
ORACLES["outlier_rate_encode"] = over(
    f"SELECT card_id, {dbls(['feature_1', 'feature_2', 'feature_3'])} FROM card_features", *CARD_TABLE
)
CARD_NAMES = [
    "feature_1",
    "feature_2",
    "feature_3",
    "target",
    "outliers",
    "quarter",
    "elapsed_time",
    *[f"days_feature{i}" for i in (1, 2, 3)],
    *[f"days_feature{i}_ratio" for i in (1, 2, 3)],
    *ROWWISE_NAMES,
]
BOTH = [*CARD_TABLE, *HIST, *NEW]
JOINED = "card_features LEFT JOIN hp USING (card_id) LEFT JOIN np USING (card_id)"
ORACLES["assemble_features"] = over(
    f"SELECT {present_profile(CARD_NAMES + HIST_NAMES + NEW_NAMES)} FROM {JOINED}", *BOTH
)
_first = "CAST(first_active_month AS TIMESTAMP)"
ORACLES["first_last_buy"] = over(
    "SELECT card_id, "
    + ", ".join(
        big(days(f"{log}_purchase_date_{edge}", _first), f"{log}_{name}_buy")
        for log in ("hist", "new")
        for edge, name in (("min", "first"), ("max", "last"))
    )
    + f" FROM {JOINED}",
    *BOTH,
)
_dates = [f"{log}_purchase_date_{edge}" for log in ("hist", "new") for edge in ("max", "min")]
ORACLES["to_epoch_seconds"] = over(
    "SELECT card_id, " + ", ".join(dbl(f"epoch_us({c}) / 1e6", c) for c in _dates) + f" FROM {JOINED}",
    *BOTH,
)


def combined_columns() -> dict[str, str]:
    def add(c):
        return f"new_{c} + hist_{c}"

    def ratio(c):
        return f"new_{c} / nullif(CAST(hist_{c} AS DOUBLE), 0)"

    out = {
        "card_id_total": add("card_id_size"),
        "card_id_cnt_total": add("card_id_count"),
        "card_id_cnt_ratio": ratio("card_id_count"),
        "purchase_amount_total": add("purchase_amount_sum"),
        "purchase_amount_ratio": ratio("purchase_amount_sum"),
        "month_diff_mean": add("month_diff_mean"),
        "month_diff_ratio": ratio("month_diff_mean"),
        "category_1_mean": add("category_1_mean"),
        "installments_total": add("installments_sum"),
        "installments_mean": add("installments_mean"),
        "installments_max": add("installments_max"),
        "installments_ratio": ratio("installments_sum"),
    }
    for c in ("purchase_amount", "month_lag", "duration", "amount_month_ratio"):
        out |= {f"{c}_{s}": add(f"{c}_{s}") for s in ("mean", "max", "min")}
    for c, s in (("total", "sum"), ("mean", "mean"), ("max", "max")):
        out[f"price_{c}"] = (
            f"({add('purchase_amount_' + s)}) / nullif(CAST({add('installments_' + s)} AS DOUBLE), 0)"
        )
    clv = {
        log: f"{log}_card_id_count * {log}_purchase_amount_sum / nullif({log}_month_diff_mean, 0)"
        for log in ("new", "hist")
    }
    out |= {"new_CLV": clv["new"], "hist_CLV": clv["hist"]}
    out["CLV_ratio"] = f"({clv['new']}) / nullif({clv['hist']}, 0)"
    return out


ORACLES["hist_new_combine"] = over(
    "SELECT card_id, " + ", ".join(dbl(e, n) for n, e in combined_columns().items()) + f" FROM {JOINED}",
    *BOTH,
)

PRICES = f"""prices AS (
  SELECT card_id, target, price_max, price_min FROM cards LEFT JOIN (
    SELECT card_id, max(price) AS price_max, min(price) AS price_min FROM (
      SELECT card_id, CASE WHEN {KNOWN} <> 0 THEN purchase_amount / {KNOWN}
        WHEN {KNOWN} = 0 AND purchase_amount > 0 THEN CAST('inf' AS DOUBLE)
        WHEN {KNOWN} = 0 AND purchase_amount < 0 THEN CAST('-inf' AS DOUBLE) END AS price
      FROM hist) GROUP BY card_id) USING (card_id))"""
FINITE = """bounds AS (
  SELECT {items} FROM prices WHERE target IS NOT NULL)""".format(
    items=", ".join(
        f"max({c}) FILTER (isfinite({c})) AS {c}_hi, min({c}) FILTER (isfinite({c})) AS {c}_lo, "
        f"count(*) FILTER ({c} = CAST('inf' AS DOUBLE)) > 0 AS {c}_up, "
        f"count(*) FILTER ({c} = CAST('-inf' AS DOUBLE)) > 0 AS {c}_down"
        for c in ("price_max", "price_min")
    )
)


def _bounded(c: str) -> str:
    return f"""CASE WHEN {c} = CAST('inf' AS DOUBLE) THEN {c}_hi + CASE WHEN target IS NOT NULL OR {c}_up THEN 1 ELSE 0 END
      WHEN {c} = CAST('-inf' AS DOUBLE) THEN {c}_lo - CASE WHEN target IS NOT NULL OR {c}_down THEN 1 ELSE 0 END
      ELSE {c} END AS {c}"""


BOUNDED = [
    PRICES,
    FINITE,
    f"""bounded AS (SELECT card_id, target, {_bounded('price_max')}, {_bounded('price_min')}
      FROM prices, bounds)""",
]
ORACLES["replace_infinite"] = over(
    f"SELECT card_id, {dbls(['target', 'price_max', 'price_min'])} FROM bounded", *BOUNDED
)
ORACLES["impute_train_mean"] = over(
    f"""SELECT card_id, {dbl('target', 'target')},
    {dbl('coalesce(price_max, (SELECT avg(price_max) FROM bounded WHERE target IS NOT NULL))', 'price_max')},
    {dbl('coalesce(price_min, (SELECT avg(price_min) FROM bounded WHERE target IS NOT NULL))', 'price_min')}
    FROM bounded""",
    *BOUNDED,
)
ORACLES["fill_zero"] = over(
    f"""SELECT card_id, {big('coalesce(n, 0)', 'n')}, {dbl('coalesce(amount, 0)', 'amount')}
    FROM cards LEFT JOIN (SELECT card_id, count(*) AS n, sum(purchase_amount) AS amount
    FROM newlog GROUP BY card_id) USING (card_id)"""
)
ORACLES["nan_pred_to_zero"] = over(
    f"""SELECT card_id, {dbl('CASE WHEN feature_1 <> 1 AND feature_2 > 1 AND target IS NOT NULL THEN target ELSE 0 END',
    'pred')} FROM cards"""
)

# Folds


def fold_ctes(seed: int, k: int, p: str = "") -> list[str]:
    return [
        f"""{p}cls AS (SELECT card_id, target, round_even(target, 0) + 0.0e0 AS rounded_target
          FROM cards WHERE target IS NOT NULL)""",
        f"""{p}counts AS (SELECT rounded_target, count(*) AS class_size,
          row_number() OVER (ORDER BY rounded_target) AS class_index,
          CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM {p}cls GROUP BY rounded_target)""",
        f"""{p}shuffled AS (SELECT *, row_number() OVER (PARTITION BY rounded_target
          ORDER BY md5(card_id || ':{seed}'), card_id) - 1 AS class_rank
          FROM {p}cls JOIN {p}counts USING (rounded_target))""",
        f"""{p}placed AS (SELECT *, CAST(total AS DOUBLE) / (class_size + 1)
          + class_rank * (CAST(total AS DOUBLE) / class_size) + 1e-6 * class_index AS position
          FROM {p}shuffled)""",
        f"""{p}folds AS (
          SELECT card_id, target, row_number() OVER (ORDER BY position, card_id) - 1 AS fold_rank,
                 ntile({k}) OVER (ORDER BY position, card_id) - 1 AS fold FROM {p}placed)""",
        f"""{p}allfolds AS (SELECT card_id, target, fold FROM {p}folds
          UNION ALL SELECT card_id, target, -1 FROM cards WHERE target IS NULL)""",
    ]


F120 = fold_ctes(120, 6)
ORACLES["class_counts"] = over(f"SELECT {dbl('rounded_target', 'rounded_target')}, class_size AS n FROM counts", *F120)
ORACLES["shuffle_in_class"] = over(
    f"""SELECT card_id, {dbl('rounded_target', 'rounded_target')},
    {bigs(['class_size', 'class_index', 'total', 'class_rank'])} FROM shuffled""",
    *F120,
)
ORACLES["stratified_interleave"] = over(
    f"SELECT card_id, {dbls(['rounded_target', 'position'])} FROM placed", *F120
)
ORACLES["kfold_contiguous"] = over(f"SELECT card_id, {bigs(['fold_rank', 'fold'])} FROM folds", *F120)
ORACLES["union_folds"] = over(
    f"SELECT card_id, {dbl('target', 'target')}, {bigs(['fold'])} FROM allfolds", *F120
)
GUESS = "g AS (SELECT cards.*, fold, feature_1 * 0.25e0 - feature_2 * 0.5e0 AS pred FROM cards JOIN folds USING (card_id))"
ORACLES["rmse"] = over(
    f"SELECT {dbl('sqrt(avg((g.target - pred) * (g.target - pred)))', 'rmse')} FROM g", *F120, GUESS
)
ORACLES["fold_rmse"] = over(
    f"SELECT {bigs(['fold'])}, {dbl('rmse', 'rmse')}, {dbl('avg(rmse) OVER ()', 'mean_rmse')} FROM r",
    *F120,
    GUESS,
    "r AS (SELECT fold, sqrt(avg((target - pred) ** 2)) AS rmse FROM g GROUP BY fold)",
)

# Joins

ORACLES["assemble_features_outer"] = over(
    f"""SELECT card_id, {bigs(['feature_1', 'hist_n', 'new_n'])}
    FROM (SELECT card_id, feature_1 FROM cards WHERE target IS NULL)
    FULL JOIN (SELECT card_id, count(*) AS hist_n FROM hist GROUP BY 1) USING (card_id)
    FULL JOIN (SELECT card_id, count(*) AS new_n FROM newlog GROUP BY 1) USING (card_id)"""
)
F10 = fold_ctes(10, 7)
ORACLES["label_transactions"] = over(
    f"""SELECT {ROW}, {dbl('target', 'target')}, {bigs(['fold'])}
    FROM hist LEFT JOIN allfolds USING (card_id)""",
    *F10,
)
RATES = """rates AS (SELECT merchant_id, avg(purchase_amount) AS rate FROM hist
  WHERE merchant_id IS NOT NULL AND month_lag < -9 GROUP BY merchant_id)"""
ORACLES["lookup_encode"] = over(
    f"SELECT {ROW}, merchant_id, {dbl('rate', 'enc')} FROM newlog LEFT JOIN rates USING (merchant_id)",
    RATES,
)
ORACLES["lookup_encode_hot_split"] = over(
    f"SELECT {ROW}, merchant_id, {dbl('rate', 'rate')} FROM hist LEFT JOIN rates USING (merchant_id)",
    RATES,
)
ORACLES["join_encoding_left"] = over(
    f"""SELECT card_id, {dbl('amount_mean', 'amount_mean')} FROM cards LEFT JOIN (
    SELECT card_id, avg(purchase_amount) AS amount_mean FROM hist GROUP BY card_id) USING (card_id)
    WHERE target IS NULL"""
)
LAST = """last AS (
  SELECT card_id, max(month_lag) AS hist_month_lag, max(purchase_date) AS hist_purchase_date,
         CAST(date_trunc('month', max(purchase_date) - to_months(max(month_lag))) + INTERVAL 1 MONTH AS DATE)
           AS observation_date
  FROM hist GROUP BY card_id)"""
_last = f"{bigs(['hist_month_lag'])}, {txt('hist_purchase_date', 'hist_purchase_date')}, {txt('observation_date', 'observation_date')}"
ORACLES["last_observation_date"] = over(f"SELECT card_id, {_last} FROM last", LAST)
ORACLES["join_observation_date"] = over(
    f"SELECT card_id, {dbl('target', 'target')}, {_last} FROM cards FULL JOIN last USING (card_id)", LAST
)
ORACLES["first_new_observation_date"] = over(
    f"""SELECT card_id, {bigs(['new_month_lag'])}, {txt('new_purchase_date', 'new_purchase_date')},
    {txt("CAST(date_trunc('month', new_purchase_date - to_months(new_month_lag - 1)) AS DATE)", 'observation_date')}
    FROM (SELECT card_id, min(month_lag) AS new_month_lag, min(purchase_date) AS new_purchase_date
          FROM newlog GROUP BY card_id)"""
)
ORACLES["new_merchant_profile"] = over(
    f"SELECT {present_profile(NM_NAMES, 'merchant_id')} FROM nm", *NM
)
_few = ["price_sum", "merchant_id_size"]
ORACLES["merchant_full_join"] = over(
    f"""SELECT merchant_id, {dbl('new_price_sum', 'new_price_sum')},
    {big('new_merchant_id_size', 'new_merchant_id_size')}, {dbl('hist_price_sum', 'hist_price_sum')},
    {big('hist_merchant_id_size', 'hist_merchant_id_size')} FROM nm FULL JOIN hm USING (merchant_id)""",
    *NM,
    *HM,
)
MERCHANT_NAMES = [n.removeprefix("hist_") for n in HM_NAMES if not n.endswith(DATES)]
ALL_MERCHANTS = [
    *NM,
    *HM,
    "am AS (SELECT merchant_id, "
    + ", ".join(
        f"coalesce({q('new_' + n)}, 0) + coalesce({q('hist_' + n)}, 0) AS {q('mer+hishist_' + n)}"
        for n in MERCHANT_NAMES
    )
    + " FROM nm FULL JOIN hm USING (merchant_id))",
]
ORACLES["merchant_combined"] = over(
    f"SELECT merchant_id, {dbls(['mer+hishist_' + n for n in MERCHANT_NAMES])} FROM am", *ALL_MERCHANTS
)
ORACLES["merchant_lookup"] = over(
    f"SELECT {ROW}, merchant_id, "
    + ", ".join(dbl(q("mer+hishist_" + n), "mer1mer+hishist_" + n) for n in MERCHANT_NAMES)
    + " FROM newlog LEFT JOIN am USING (merchant_id)",
    *ALL_MERCHANTS,
)
ORACLES["card_merchant_profile"] = over(
    "SELECT card_id, "
    + ", ".join(
        dbl(STATS[s].replace("{c}", q("mer+hishist_" + n)), f"new_mer1mer+hishist_{n}_{s}")
        for n in MERCHANT_NAMES
        for s in ("sum", "mean", "min", "max")
    )
    + " FROM lc LEFT JOIN am USING (merchant_id) GROUP BY card_id",
    *ALL_MERCHANTS,
    clean("newlog", "lc"),
)

STACKS = [
    MODEL_TABLE,
    """stacked AS (SELECT card_id, target, feature_1 * 0.25e0 AS m1_0, hist_amount * 0.5e0 AS m2_0,
      feature_2 - 2.0e0 AS m1_1, (feature_2 - 2.0e0) * target AS m1_2 FROM mt)""",
]
_m = ["m1_0", "m2_0", "m1_1", "m1_2"]
ORACLES["stack_join"] = over(f"SELECT card_id, {dbls(['target', *_m])} FROM stacked", *STACKS)
ORACLES["align_test_predictions"] = over(
    f"SELECT card_id, {dbls(_m)} FROM stacked WHERE target IS NULL", *STACKS
)


def scaled(c: str, source: str, name: str | None = None) -> str:
    lo, hi = (f"(SELECT {f}({c}) FROM {source} WHERE target IS NOT NULL)" for f in ("min", "max"))
    return dbl(f"({c} - {lo}) / CASE WHEN {hi} = {lo} THEN 1 ELSE {hi} - {lo} END", name or c)


ORACLES["stack_features"] = over(
    f"SELECT card_id, {dbl('target', 'target')}, {', '.join(scaled(c, 'filled') for c in _m)} FROM filled",
    *STACKS,
    "filled AS (SELECT * REPLACE (coalesce(m1_2, 0) AS m1_2) FROM stacked)",
)
MODEL_INPUTS = ["feature_1", "feature_2", "feature_3", "hist_rows", "hist_amount"]
ORACLES["minmax_scale"] = over(
    f"""SELECT card_id, {dbl('target', 'target')},
    {', '.join(scaled(f'CAST({c} AS DOUBLE)', 'mt', c) for c in MODEL_INPUTS)},
    {dbl('0', 'flat')} FROM mt""",
    MODEL_TABLE,
)


def standardized(c: str) -> str:
    x = f"CASE WHEN isfinite({c}) THEN {c} END"
    filled = f"coalesce({x}, avg({x}) OVER ())"
    return f"{filled} AS {c}"


ORACLES["standardize"] = over(
    "SELECT card_id, "
    + ", ".join(
        dbl(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()", c) for c in ("price_max", "price_min")
    )
    + " FROM z",
    PRICES,
    f"z AS (SELECT card_id, {standardized('price_max')}, {standardized('price_min')} FROM prices)",
)
ORACLES["blend"] = over(
    f"""SELECT card_id, {dbl('hist_amount * 0.1e0', 'ridge')}, {dbl('feature_1 * 0.2e0', 'nn')},
    {dbl('hist_rows * 0.01e0', 'lgb')},
    {dbl('0.03e0 * hist_amount + 0.12e0 * feature_1 + 0.001e0 * hist_rows', 'pred')} FROM mt""",
    MODEL_TABLE,
)

# Aggregates

_agg = {
    "purchase_amount": ("sum", "max", "min", "mean", "var", "skew"),
    "installments": ("sum", "count", "nunique"),
    "merchant_id": ("nunique", "size"),
}
ORACLES["agg_spec"] = over(
    f"SELECT {dbls(['state_id', *spec_names(_agg, 'p_')])} FROM a",
    grouped("hist", "state_id", _agg, "p_", "a"),
)
ORACLES["hist_card_profile"] = over(f"SELECT {present_profile(HIST_NAMES)} FROM hp", *HIST)
ORACLES["new_card_profile"] = over(f"SELECT {present_profile(NEW_NAMES)} FROM np", *NEW)
_span_spec = {"purchase_date": ("max", "min"), "card_id": ("size",)}
ORACLES["purchase_span"] = over(
    f"""SELECT {present_profile(spec_names(_span_spec, 'new_') + [f'new_purchase_date_{x}' for x in SPAN])}
    FROM (SELECT *, {span('new_')} FROM a)""",
    grouped("newlog", "card_id", _span_spec, "new_", "a"),
)
for _k, _suffix in ((0, ""), (-2, "_2"), (-6, "_6")):
    _spec, _p = profiles.lag_spec(tuple(X.HOLIDAYS)), f"hist_monthlag{_k}"
    _names = spec_names(_spec, _p) + [f"{_p}purchase_date_{x}" for x in SPAN]
    ORACLES["lag_profile" + _suffix] = over(
        f"SELECT {present_profile(_names, dates=False)} FROM (SELECT *, {span(_p)} FROM lp)",
        clean("hist", "lc"),
        enriched("lc", "le", X.HOLIDAYS, lag=False),
        grouped("le", "card_id", _spec, _p, "lp", f"month_lag >= {_k}"),
    )
_cut_ctes = [clean("hist", "lc"), enriched("lc", "le", X.HOLIDAYS, lag=False), amount_source("hist", "a")]
_cut_names, _cut_joins = [], []
for _i, _k in enumerate((0, -2, -6)):
    _spec, _p = profiles.lag_spec(tuple(X.HOLIDAYS)), f"hist_monthlag{_k}"
    _cut_names += spec_names(_spec, _p) + [f"{_p}purchase_date_{x}" for x in SPAN]
    _cut_ctes.append(grouped("le", "card_id", _spec, _p, f"lag{_i}", f"month_lag >= {_k}"))
    _cut_joins.append(f"(SELECT *, {span(_p)} FROM lag{_i})")
for _i, (_lo, _hi) in enumerate(((-7, -3), (-1, 100), (-3, 100), (-100, 100))):
    _p = f"hist_month{_lo}{_hi}_amount"
    _cut_names += spec_names(profiles.amount_spec(), _p)
    _where = f"month_lag BETWEEN {_lo} AND {_hi}"
    _cut_ctes.append(grouped("a", "card_id", profiles.amount_spec(), _p, f"range{_i}", _where))
    _cut_joins.append(f"range{_i}")
ORACLES["cut_profiles"] = over(
    f"SELECT {present_profile(_cut_names, dates=False)} FROM {_cut_joins[0]} t0 "
    + " ".join(f"FULL JOIN {j} t{i} USING (card_id)" for i, j in enumerate(_cut_joins) if i),
    *_cut_ctes,
)
_quarters = profiles.quarter_spec(X.QUARTER_STARTS)
ORACLES["quarter_profile"] = over(
    f"SELECT card_id, {dbls(spec_names(_quarters, 'hist_'))} FROM qg",
    *QUARTERS,
    grouped("qf", "card_id", _quarters, "hist_", "qg"),
)
_amounts = profiles.amount_spec()
ORACLES["new_amount_profile"] = over(
    f"SELECT card_id, {dbls(spec_names(_amounts, 'new_amount'))} FROM ag",
    amount_source("newlog", "a"),
    grouped("a", "card_id", _amounts, "new_amount", "ag"),
)
for _lo, _hi, _suffix in ((-7, -3, ""), (-1, 100, "_1"), (-3, 100, "_3"), (-100, 100, "_all")):
    _p = f"hist_month{_lo}{_hi}_amount"
    ORACLES["hist_amount_profile" + _suffix] = over(
        f"SELECT card_id, {dbls(spec_names(_amounts, _p))} FROM ag",
        amount_source("hist", "a"),
        grouped("a", "card_id", _amounts, _p, "ag", f"month_lag BETWEEN {_lo} AND {_hi}"),
    )
ORACLES["category_amount_stats"] = over(
    f"SELECT {ROW}, "
    + ", ".join(
        dbl(f"{f}(purchase_amount) OVER (PARTITION BY {c})", f"{c}_{s}")
        for c in ("category_2", "category_3")
        for s, f in (("mean", "avg"), ("min", "min"), ("max", "max"), ("sum", "sum"))
    )
    + " FROM cc",
    clean("hist", "cc"),
)

# Encodings

WEIGHT = "1 / (1 + exp(-(count(target) - 85.0e0)))"
ORACLES["smoothed_target_mean"] = over(
    f"""SELECT merchant_id, count(target) AS n,
    {dbl(f'CASE WHEN count(target) > 0 THEN -0.5e0 * (1 - {WEIGHT}) + avg(target) * ({WEIGHT}) END', 'encoding')}
    FROM hist LEFT JOIN cards USING (card_id) WHERE merchant_id IS NOT NULL GROUP BY merchant_id"""
)


def left_out(rows: str, k: int) -> list[str]:
    """All (held fold, row) pairs of the rows outside the held fold, and the prior."""
    held = " UNION ALL ".join(f"SELECT {f} AS held" for f in range(-1, k))
    return [
        f"held AS ({held})",
        f"kept AS (SELECT * FROM {rows} JOIN held ON fold <> held WHERE target IS NOT NULL)",
        "prior AS (SELECT held, avg(target) AS prior FROM kept GROUP BY held)",
    ]


LABELLED = "labelled AS (SELECT hist.*, target, fold FROM hist JOIN allfolds USING (card_id))"
ORACLES["transaction_prior"] = over(
    f"SELECT {big('held', 'fold')}, {dbl('prior', 'prior')} FROM prior",
    *F10,
    LABELLED,
    *left_out("labelled", 7),
)


def encoded_ctes(log: str) -> list[str]:
    ctes = [
        *F10,
        f"labelled AS (SELECT {log}.*, target, fold FROM {log} JOIN allfolds USING (card_id))",
        *left_out("labelled", 7),
    ]
    for i, k in enumerate(encode.ENCODED_KEYS):
        ctes.append(
            f"""e{i} AS (SELECT held, {k}, any_value(prior) * (1 - {WEIGHT}) + avg(target) * ({WEIGHT}) AS enc
            FROM kept JOIN prior USING (held) WHERE {k} IS NOT NULL GROUP BY held, {k})"""
        )
    joins = "\n".join(
        f"LEFT JOIN e{i} ON e{i}.held = l.fold AND e{i}.{k} = l.{k}"
        for i, k in enumerate(encode.ENCODED_KEYS)
    )
    picks = ", ".join(f"e{i}.enc AS {k}taren" for i, k in enumerate(encode.ENCODED_KEYS))
    ctes.append(f"encoded AS (SELECT l.card_id, {picks} FROM labelled l {joins})")
    return ctes


def encoded_query(log: str, prefix: str, ratios: bool) -> str:
    cols = {f"{k}taren": f"{k}taren" for k in encode.ENCODED_KEYS}
    if ratios:
        for a, b in combinations(encode.ENCODED_KEYS, 2):
            cols[f"{a}taren{b}tarensou"] = f"{a}taren / nullif({b}taren, 0)"
    base = ", ".join(f"{e} AS {q(n)}" for n, e in cols.items())
    aggs, names = [], []
    for n in cols:
        for s in ("sum", "mean", "max", "min", "var"):
            names.append(f"{prefix}{n}_{s}")
            aggs.append(STATS[s].replace("{c}", q(n)) + f" AS {q(names[-1])}")
    return over(
        f"SELECT card_id, {dbls(names)} FROM cards LEFT JOIN per_card USING (card_id)",
        *encoded_ctes(log),
        f"pairs AS (SELECT card_id, {base} FROM encoded)",
        f"per_card AS (SELECT card_id, {', '.join(aggs)} FROM pairs GROUP BY card_id)",
    )


ORACLES["oof_target_encode"] = encoded_query("hist", "hist_target_encoding_", False)
ORACLES["oof_target_encode_new"] = encoded_query("newlog", "new_target_encoding_", False)
ORACLES["target_ratio_pairs"] = encoded_query("hist", "hist_target_encoding_", True)
ORACLES["date_target_encode"] = over(
    f"""SELECT card_id, {dbl('enc', 'observation_date_target')}
    FROM dated d LEFT JOIN e ON e.held = d.fold AND e.observation_date = d.observation_date""",
    *fold_ctes(1199, 7),
    LAST,
    "dated AS (SELECT allfolds.*, observation_date FROM allfolds LEFT JOIN last USING (card_id))",
    *left_out("dated", 7),
    f"""e AS (SELECT held, observation_date, any_value(prior) * (1 - {WEIGHT}) + avg(target) * ({WEIGHT}) AS enc
      FROM kept JOIN prior USING (held) WHERE observation_date IS NOT NULL GROUP BY held, observation_date)""",
)

# Lags

RESTORED = "round_even(purchase_amount / 0.00150265118e0 + 497.06e0, 8)"
LAG_CTES = [
    f"""restored AS (SELECT card_id, month_lag, {RESTORED} AS amount FROM t
      WHERE month_lag BETWEEN -13 AND 2)""",
    "sums AS (SELECT card_id, month_lag, sum(amount) AS amount FROM restored GROUP BY ALL)",
    "matrix AS (SELECT card_id, "
    + ", ".join(f"coalesce(sum(amount) FILTER (month_lag = {k}), 0) AS {q(str(k))}" for k in LAGS)
    + " FROM sums GROUP BY card_id)",
    # The running totals in long form, by a window over a full grid.
    f"""grid AS (SELECT c.card_id, l.month_lag, coalesce(amount, 0) AS amount
      FROM (SELECT DISTINCT card_id FROM sums) c
      CROSS JOIN (SELECT CAST(unnest(range(-13, 3)) AS INT) AS month_lag) l
      LEFT JOIN sums s ON s.card_id = c.card_id AND s.month_lag = l.month_lag)""",
    """totals AS (SELECT card_id, month_lag,
      sum(amount) OVER (PARTITION BY card_id ORDER BY month_lag) AS total FROM grid)""",
    """lag_stat AS (SELECT card_id, avg(total) AS month_lag_mean, sum(total) AS month_lag_sum,
      min(total) FILTER (total <> 0) AS month_lag_min, max(total) AS month_lag_max,
      var_samp(total) AS month_lag_var,
      first(month_lag ORDER BY total DESC, month_lag DESC) AS month_lag_maxindex,
      first(month_lag ORDER BY total, month_lag DESC) AS month_lag_minindex
      FROM totals GROUP BY card_id)""",
    "wide AS (SELECT card_id, "
    + ", ".join(f"any_value(total) FILTER (month_lag = {k}) AS {q(str(k))}" for k in LAGS)
    + " FROM totals GROUP BY card_id)",
]
_lags = [str(k) for k in LAGS]
_lag_stats = ["month_lag_mean", "month_lag_sum", "month_lag_min", "month_lag_max", "month_lag_var"]
_share = '("1" + "2") / nullif(month_lag_sum - "1" - "2", 0)'
_shares = [(f"{k}%", f'"{k}" / nullif(month_lag_sum, 0)') for k in _lags]
_deltas = [(f"{a}-{b}", f'"{a}" - "{b}"') for a, b in zip(_lags, _lags[1:])]
ORACLES["combine_lag_tables"] = over(
    f"SELECT card_id, {bigs(['month_lag'])}, {dbl('amount', 'purchase_amount')} FROM restored", *LAG_CTES
)
ORACLES["lag_amount_sum"] = over(
    f"SELECT card_id, {bigs(['month_lag'])}, {dbl('amount', 'amount')} FROM sums", *LAG_CTES
)
ORACLES["lag_pivot"] = over(f"SELECT card_id, {dbls(_lags)} FROM matrix", *LAG_CTES)
ORACLES["running_total_by_lag"] = over(f"SELECT card_id, {dbls(_lags)} FROM wide", *LAG_CTES)
ORACLES["lag_stats"] = over(f"SELECT card_id, {dbls(_lag_stats)} FROM lag_stat", *LAG_CTES)
for _x in ("max", "min"):
    ORACLES[f"lag_arg{_x}"] = over(
        f"SELECT card_id, {bigs([f'month_lag_{_x}index'])} FROM lag_stat", *LAG_CTES
    )
_wide = "wide JOIN lag_stat USING (card_id)"
ORACLES["new_share"] = over(f"SELECT card_id, {dbl(_share, 'new_%')} FROM {_wide}", *LAG_CTES)
ORACLES["lag_shares"] = over(
    f"SELECT card_id, {', '.join(dbl(e, n) for n, e in _shares)} FROM {_wide}", *LAG_CTES
)
ORACLES["lag_deltas"] = over(
    f"SELECT card_id, {', '.join(dbl(e, n) for n, e in _deltas)} FROM wide", *LAG_CTES
)
ORACLES["monthly_change"] = over(
    "SELECT card_id, "
    + ", ".join(
        [dbl(q(n), PREFIX + n) for n in _lags + _lag_stats]
        + [big(f"month_lag_{x}index", f"{PREFIX}month_lag_{x}index") for x in ("max", "min")]
        + [dbl(_share, f"{PREFIX}new_%")]
        + [dbl(e, PREFIX + n) for n, e in _shares + _deltas]
    )
    + f" FROM {_wide}",
    *LAG_CTES,
)

# Sets, order

ORACLES["union_train_test"] = over(f"SELECT {CARD_COLUMNS}, {bigs(['outliers'])} FROM flagged")
ORACLES["distinct_keys"] = over("SELECT DISTINCT card_id FROM hist")
ORACLES["sort_by_key"] = over(f"SELECT card_id, {dbl('target', 'target')} FROM cards ORDER BY card_id")
SPREADS = [
    MODEL_TABLE,
    "folded AS (SELECT mt.*, fold FROM mt JOIN folds USING (card_id))",
    "spreads AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {f} AS fold, ln(1 + var_samp({c})) AS importance FROM folded WHERE fold <> {f}"
        for c in MODEL_INPUTS
        for f in (0, 1)
    )
    + ")",
]
ORACLES["top_k_features"] = over(
    f"""SELECT feature, {dbl('sum(importance)', 'feature_sum')} FROM spreads GROUP BY feature
    ORDER BY sum(importance) DESC, feature LIMIT 3""",
    *F120,
    *SPREADS,
)
ORACLES["concat_columns"] = over(
    f"""SELECT feature, {dbl('max(importance) FILTER (fold = 0)', 'importance0')},
    {dbl('max(importance) FILTER (fold = 1)', 'importance1')} FROM spreads GROUP BY feature""",
    *F120,
    *SPREADS,
)

# Ridge in closed form: two features, intercept free of penalty


def ridge_ctes(seed: int, alpha: float, p: str) -> list[str]:
    return [
        *fold_ctes(seed, 6, p),
        f"""{p}rows AS (SELECT card_id, {p}allfolds.target AS y, fold, CAST(hist_rows AS DOUBLE) AS x1,
          CAST(feature_2 AS DOUBLE) AS x2 FROM {p}allfolds JOIN mt USING (card_id))""",
        f"""{p}sums AS (SELECT held, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2,
          count(*) * var_pop(x1) + {alpha}e0 AS s11, count(*) * var_pop(x2) + {alpha}e0 AS s22,
          count(*) * covar_pop(x1, x2) AS s12, count(*) * covar_pop(x1, y) AS s1y,
          count(*) * covar_pop(x2, y) AS s2y
          FROM {p}rows JOIN (SELECT unnest(range(0, 6)) AS held) ON fold <> held AND fold >= 0
          GROUP BY held)""",
        f"""{p}fits AS (SELECT held, my, m1, m2, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
          (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM {p}sums)""",
        f"""{p}preds AS (SELECT card_id, any_value(y) AS target, any_value(fold) AS fold,
          avg(my + b1 * (x1 - m1) + b2 * (x2 - m2)) AS pred
          FROM {p}rows JOIN {p}fits ON fold = held OR fold = -1 GROUP BY card_id)""",
    ]


def _ridge(alpha: float) -> str:
    return over(
        f"SELECT card_id, {dbl('target', 'target')}, {bigs(['fold'])}, {dbl('pred', 'pred')} FROM r_preds",
        MODEL_TABLE,
        *ridge_ctes(40, alpha, "r_"),
    )


ORACLES["oof_ridge"] = _ridge(0.1)
ORACLES["oof_predict"] = _ridge(10.0)
ORACLES["stack_level1"] = over(
    f"""SELECT card_id, {dbl('a_preds.target', 'target')}, {big('a_preds.fold', 'fold')},
    {dbl('a_preds.pred', 'ridgek')}, {dbl('b_preds.pred', 'stiff')} FROM a_preds JOIN b_preds USING (card_id)""",
    MODEL_TABLE,
    *ridge_ctes(40, 0.1, "a_"),
    *ridge_ctes(40, 1000.0, "b_"),
)
ORACLES["repeat_average"] = over(
    f"""SELECT card_id, {dbl('max(target)', 'target')}, {dbl('avg(pred)', 'pred')} FROM (
    SELECT card_id, target, pred FROM r0_preds UNION ALL SELECT card_id, target, pred FROM r1_preds
    UNION ALL SELECT card_id, target, pred FROM r2_preds) GROUP BY card_id""",
    MODEL_TABLE,
    *[c for r in range(3) for c in ridge_ctes(10835 + r, 1.0, f"r{r}_")],
)



def _determinant(a, b, c) -> str:
    """Of three columns of three values each."""
    return (
        f"({a[0]} * ({b[1]} * {c[2]} - {b[2]} * {c[1]}) - {b[0]} * ({a[1]} * {c[2]} - {a[2]} * {c[1]})"
        f" + {c[0]} * ({a[1]} * {b[2]} - {a[2]} * {b[1]}))"
    )


def _gram_ridge() -> str:
    """Three features by Cramer's rule."""
    pairs = [(i, j) for i in (1, 2, 3) for j in (1, 2, 3)]
    column = {j: [f"s{min(i, j)}{max(i, j)}" for i in (1, 2, 3)] for j in (1, 2, 3)}
    right = ["s1y", "s2y", "s3y"]
    whole = _determinant(column[1], column[2], column[3])
    beta = {
        j: f"({_determinant(*[right if k == j else column[k] for k in (1, 2, 3)])} / {whole})" for j in (1, 2, 3)
    }
    ctes, parts = [], []
    for r in range(3):
        p = f"g{r}_"
        ctes += fold_ctes(10835 + r, 6, p)
        parts.append(
            f"""SELECT {r} AS r, held, alpha, avg(y) AS my, {', '.join(f'avg(x{i}) AS m{i}' for i in (1, 2, 3))},
            {', '.join(f'count(*) * covar_pop(x{i}, x{j}) + {"any_value(alpha)" if i == j else "0"} AS s{i}{j}' for i, j in pairs if i <= j)},
            {', '.join(f'count(*) * covar_pop(x{i}, y) AS s{i}y' for i in (1, 2, 3))}
            FROM (SELECT fold, mt.target AS y, CAST(hist_rows AS DOUBLE) AS x1, CAST(feature_2 AS DOUBLE) AS x2,
                  CAST(hist_amount AS DOUBLE) AS x3 FROM {p}folds JOIN mt USING (card_id))
            JOIN (SELECT unnest(range(0, 6)) AS held) ON fold <> held,
            (VALUES (0.1e0), (1e0), (1000e0)) v(alpha) GROUP BY held, alpha"""
        )
    return over(
        f"""SELECT CAST(r AS BIGINT) AS r, CAST(held AS BIGINT) AS held, {dbl('alpha', 'alpha')},
        {', '.join(dbl(beta[j], f'b{j}') for j in (1, 2, 3))},
        {dbl('my - ' + ' - '.join(f'{beta[j]} * m{j}' for j in (1, 2, 3)), 'b0')}
        FROM ({' UNION ALL '.join(parts)})""",
        MODEL_TABLE,
        *ctes,
    )


ORACLES["gram_ridge"] = _gram_ridge()

# What SQL can state of trained results

_F40 = fold_ctes(40, 6)
_STATED = f"card_id, {dbl('target', 'target')}, {bigs(['fold'])}, 1::BIGINT AS predicted"
ORACLES["oof_gbt_stated"] = over(f"SELECT {_STATED} FROM allfolds", *_F40)
ORACLES["oof_histogram_stated"] = over(f"SELECT {_STATED}, 1::BIGINT AS no_worse FROM allfolds", *_F40)
ORACLES["oof_ordered_stated"] = ORACLES["oof_histogram_stated"]
# The permutation is the order of a hash, cut where its value doubles. A card is told sums over
# levels below its own, never its own; a held-out or test card those over all levels.
_LEVEL = " + ".join(
    f"(substr(md5(card_id || ':0'), 1, 8) >= '{1 << (24 + j):08x}')::INT" for j in range(1, 8)
)
ORACLES["ordered_statistics"] = over(
    f"""SELECT a.card_id, {bigs(['level'])}, a.feature, {big('a.m', 'model')},
      {dbl('(coalesce(t.s, 0) + p.prior) / (coalesce(t.n, 0) + 1)', 'statistic')}
    FROM asked a JOIN priors p ON p.m = a.m AND p.top = a.top
    LEFT JOIN told t ON t.m = a.m AND t.top = a.top AND t.feature = a.feature AND t.value IS NOT DISTINCT FROM a.value""",
    *_F40,
    f"lv AS (SELECT f.*, {_LEVEL} AS level FROM allfolds f)",
    """asks AS (SELECT lv.card_id, lv.target, lv.fold, lv.level, u.feature, u.value FROM lv JOIN (
      SELECT card_id, 'feature_1' AS feature, CAST(feature_1 AS VARCHAR) AS value FROM cards UNION ALL
      SELECT card_id, 'feature_2', CAST(feature_2 AS VARCHAR) FROM cards UNION ALL
      SELECT card_id, 'feature_3', CAST(feature_3 AS VARCHAR) FROM cards) u USING (card_id))""",
    """asked AS (SELECT asks.*, m, CASE WHEN target IS NULL OR fold = m THEN 8 ELSE level END AS top
      FROM asks CROSS JOIN range(6) r(m))""",
    """sums AS (SELECT feature, value, level, fold, sum(target) AS s, count(target) AS n FROM asks
      WHERE target IS NOT NULL GROUP BY ALL)""",
    """told AS (SELECT feature, value, m, top, sum(s) AS s, sum(n) AS n FROM sums, range(6) r(m), range(9) t(top)
      WHERE level < top AND fold <> m GROUP BY ALL)""",
    """priors AS (SELECT m, top, coalesce(avg(target) FILTER (WHERE fold <> m AND
        CASE WHEN top = 0 THEN level > 0 ELSE level < top END), 0) AS prior
      FROM lv, range(6) r(m), range(9) t(top) WHERE target IS NOT NULL GROUP BY ALL)""",
)
ORACLES["oof_forest_stated"] = over(f"SELECT {_STATED}, 1::BIGINT AS inside FROM allfolds", *_F40)
ORACLES["oof_extra_trees_stated"] = ORACLES["oof_forest_stated"]
ORACLES["oof_network_stated"] = ORACLES["oof_gbt_stated"]
ORACLES["score_single_stated"] = over(
    "SELECT card_id, 1::BIGINT AS scored FROM cards WHERE target IS NULL"
)
ORACLES["feature_importance_stated"] = over(
    f"""SELECT feature, 0::BIGINT AS fold, 1::BIGINT AS ok, {dbl('1', 'total')} FROM (VALUES ('feature_1'),
    ('feature_2'), ('feature_3'), ('hist_rows'), ('hist_amount')) v(feature)"""
)
ORACLES["select_by_importance_stated"] = over(
    f"SELECT card_id, {bigs(['outliers'])}, {dbl('target', 'target')}, 2::BIGINT AS features FROM flagged"
)
ORACLES["embed_2d_stated"] = over(
    """SELECT count(*) AS n, count(*) AS n_right, 1::BIGINT AS centred0, 1::BIGINT AS centred1,
    1::BIGINT AS uncorrelated, 1::BIGINT AS ordered FROM cards"""
)
