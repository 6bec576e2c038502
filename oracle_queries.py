"""Independent ANSI-SQL (DuckDB dialect) statements of each registered query.

Written separately from the DataFrame code so the correctness check compares
two implementations.  Tables: the driver's views (orders, ...).
"""

from __future__ import annotations

from churnlake.schema import (
    CONTRACT_FACTORS, EDA_TENURE_EDGES, EDA_TENURE_LABELS, PSI_DECILES, TENURE_GROUP_EDGES,
    TENURE_GROUP_LABELS,
)
from churnlake.sources.fixtures import DIRTY_COLUMNS

NUM = r"(\d+\.?\d*)"
INT_TEXT = r"^([+-]?[0-9]+)([.][0-9]*)?$"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _dirty_sql(i: int, values: list[str]) -> str:
    picks = " ".join(f"WHEN {j} THEN {_q(v)}" for j, v in enumerate(values))
    return (f"CASE (k + {7 * i}) % 60 WHEN 0 THEN NULL WHEN 1 THEN 'Unknown' WHEN 2 THEN 'Not Specified' "
            f"ELSE (CASE (k * {i + 3} + cust) % {len(values)} {picks} END) END")


def _raw_ctes() -> str:
    dirty = {name: _dirty_sql(i, vals) for i, name, vals in DIRTY_COLUMNS}
    feat = ",\n  ".join(
        [
            "'C' || CAST(cust AS VARCHAR) AS customerID",
            "CASE WHEN k % 97 = 0 THEN 'n/a' WHEN k % 89 = 0 THEN NULL ELSE CAST(k % 76 AS VARCHAR) END AS tenure",
        ]
        + [f"{dirty[c]} AS {c}" for c in [
            "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup",
            "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies", "Contract",
            "PaperlessBilling", "PaymentMethod"]]
        + [
            "CASE WHEN k % 83 = 0 THEN '' ELSE '$' || CAST((p % 13000) // 100 AS VARCHAR) || '.' || "
            "lpad(CAST(p % 100 AS VARCHAR), 2, '0') END AS MonthlyCharges",
            "CASE WHEN k % 79 = 0 THEN ' ' ELSE CAST(p % 9000 AS VARCHAR) || '.5' END AS TotalCharges",
            "CAST(sd AS VARCHAR) AS Snapshot_Date",
        ]
    )
    meta = ",\n  ".join([
        "'C' || CAST(cust AS VARCHAR) AS customerID",
        f"{dirty['gender']} AS gender",
        "CASE WHEN k % 67 = 0 THEN '2' WHEN k % 61 = 0 THEN NULL ELSE CAST(k % 2 AS VARCHAR) END AS SeniorCitizen",
        f"{dirty['Partner']} AS Partner",
        f"{dirty['Dependents']} AS Dependents",
        "CAST(sd AS VARCHAR) AS Snapshot_Date",
    ])
    lab = ",\n  ".join([
        "'C' || CAST(cust AS VARCHAR) AS customerID",
        "CASE WHEN k % 71 = 0 THEN NULL WHEN (k * 7919 + cust) % 100 < 27 THEN 'Yes' ELSE 'No' END AS Churn",
        "CAST(sd AS VARCHAR) AS Snapshot_Date",
    ])
    return f"""om AS (
  SELECT o_custkey AS cust, CAST(date_trunc('month', o_orderdate) AS DATE) AS sd,
         min(o_orderkey) AS k, CAST(round(max(o_totalprice)) AS BIGINT) AS p
  FROM orders GROUP BY 1, 2),
raw_features AS (SELECT
  {feat}
  FROM om),
raw_meta AS (SELECT
  {meta}
  FROM om),
raw_labels AS (SELECT
  {lab}
  FROM om)"""


def _int(c: str) -> str:
    return f"TRY_CAST(regexp_extract(trim({c}), '{INT_TEXT}', 1) AS INTEGER)"


def _num(c: str) -> str:
    return f"TRY_CAST(nullif(trim(regexp_extract({c}, '{NUM}', 1)), '') AS DOUBLE)"


def _yn(c: str) -> str:
    return f"CAST(CASE lower({c}) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS INTEGER)"


def _present(c: str) -> str:
    return f"({c} IS NOT NULL AND lower({c}) NOT IN ('not specified', 'unknown'))"


def _date(c: str) -> str:
    return f"TRY_CAST(TRY_STRPTIME({c}, '%Y-%m-%d') AS DATE)"


SIMPLE = ["MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
          "TechSupport", "StreamingTV", "StreamingMovies", "Contract"]
INTERNET = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies"]


def feature_rules_sql() -> list[tuple[str, str]]:
    rules = [
        ("tenure", f"({_int('tenure')} BETWEEN 0 AND 73)"),
        ("PhoneService", f"({_yn('PhoneService')} IS NOT NULL)"),
    ]
    rules += [(c, _present(c)) for c in SIMPLE]
    rules += [("PaperlessBilling", "TRUE"), ("PaymentMethod", "TRUE")]
    rules += [
        ("MonthlyCharges", f"({_num('MonthlyCharges')} > 0 AND {_num('MonthlyCharges')} < 124)"),
        ("TotalCharges", f"({_num('TotalCharges')} > 0)"),
    ]
    return rules


def meta_rules_sql() -> list[tuple[str, str]]:
    return [
        ("gender", "(lower(gender) IN ('male', 'female'))"),
        ("SeniorCitizen", f"({_int('SeniorCitizen')} IN (0, 1))"),
        ("Partner", f"({_yn('Partner')} IS NOT NULL)"),
        ("Dependents", f"({_yn('Dependents')} IS NOT NULL)"),
    ]


def _silver_ctes() -> str:
    fcols = ["customerID", f"{_int('tenure')} AS tenure", f"{_yn('PhoneService')} AS PhoneService"]
    for c in SIMPLE:
        if c == "MultipleLines":
            fcols.append(f"CASE WHEN lower({c}) = 'no phone service' THEN 'No' ELSE {c} END AS {c}")
        elif c in INTERNET:
            fcols.append(f"CASE WHEN lower({c}) = 'no internet service' THEN 'No' ELSE {c} END AS {c}")
        else:
            fcols.append(c)
    fcols += [
        "CAST(CASE lower(CASE WHEN PaperlessBilling IS NULL OR lower(PaperlessBilling) = 'not specified' "
        "THEN 'Unknown' ELSE PaperlessBilling END) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS INTEGER) AS PaperlessBilling",
        "CASE WHEN PaymentMethod IS NULL OR lower(PaymentMethod) = 'not specified' THEN 'Unknown' "
        "ELSE PaymentMethod END AS PaymentMethod",
        f"{_num('MonthlyCharges')} AS MonthlyCharges",
        f"{_num('TotalCharges')} AS TotalCharges",
        f"{_date('Snapshot_Date')} AS Snapshot_Date",
    ]
    fwhere = " AND ".join(r for _, r in feature_rules_sql())
    mcols = [
        "customerID",
        "CAST(CASE lower(gender) WHEN 'male' THEN 1 WHEN 'female' THEN 0 END AS INTEGER) AS gender",
        f"{_int('SeniorCitizen')} AS SeniorCitizen",
        f"{_yn('Partner')} AS Partner",
        f"{_yn('Dependents')} AS Dependents",
        f"{_date('Snapshot_Date')} AS Snapshot_Date",
    ]
    mwhere = " AND ".join(r for _, r in meta_rules_sql())
    return f""",
silver_features AS (SELECT {', '.join(fcols)} FROM raw_features WHERE {fwhere}),
silver_meta AS (SELECT {', '.join(mcols)} FROM raw_meta WHERE {mwhere}),
silver_labels AS (SELECT customerID, {_yn('Churn')} AS Churn, {_date('Snapshot_Date')} AS Snapshot_Date FROM raw_labels)"""


GOLD_COLS = (
    "f.customerID, f.Snapshot_Date, f.tenure, f.PhoneService, f.MultipleLines, f.InternetService, "
    "f.OnlineSecurity, f.OnlineBackup, f.DeviceProtection, f.TechSupport, f.StreamingTV, f.StreamingMovies, "
    "f.Contract, f.PaperlessBilling, f.PaymentMethod, f.MonthlyCharges, f.TotalCharges, "
    "m.gender, m.SeniorCitizen, m.Partner, m.Dependents"
)


def _gold_ctes() -> str:
    return f""",
gold_features AS (SELECT {GOLD_COLS} FROM silver_features f
  JOIN silver_meta m ON f.customerID = m.customerID AND f.Snapshot_Date = m.Snapshot_Date),
gold_labels AS (SELECT customerID, Churn, Snapshot_Date FROM silver_labels),
eda AS (SELECT g.*, l.Churn FROM gold_features g
  JOIN gold_labels l ON g.customerID = l.customerID AND g.Snapshot_Date = l.Snapshot_Date)"""


def with_base(select: str, extra_ctes: str = "") -> str:
    return "WITH " + _raw_ctes() + _silver_ctes() + _gold_ctes() + extra_ctes + "\n" + select


def _tenure_bins_sql(c: str, edges, labels, open_top=False) -> str:
    parts = [f"WHEN {c} > {lo} AND {c} <= {hi} THEN {_q(lab)}"
             for (lo, hi), lab in zip(zip(edges[:-1], edges[1:]), labels)]
    if open_top:
        parts.append(f"WHEN {c} > {edges[-1]} THEN {_q(labels[len(edges) - 1])}")
    return "CASE " + " ".join(parts) + " END"


def tenure_group_sql(c: str = "tenure") -> str:
    return _tenure_bins_sql(c, TENURE_GROUP_EDGES, TENURE_GROUP_LABELS, open_top=True)


def eda_bin_sql(c: str = "tenure") -> str:
    return _tenure_bins_sql(c, EDA_TENURE_EDGES, EDA_TENURE_LABELS)


def contract_factor_sql(c: str = "Contract") -> str:
    parts = " ".join(f"WHEN {c} = {_q(k)} THEN {v}::DOUBLE" for k, v in CONTRACT_FACTORS.items())
    return f"(CASE {parts} ELSE 1.0::DOUBLE END)"


def heuristic_sql(t: str = "tenure", m: str = "MonthlyCharges", c: str = "Contract") -> str:
    raw = (f"(0.2::DOUBLE + (1.0::DOUBLE - CAST({t} AS DOUBLE) / 100.0::DOUBLE) * 0.3::DOUBLE "
           f"+ (CAST({m} AS DOUBLE) / 120.0::DOUBLE) * 0.2::DOUBLE "
           f"+ ({contract_factor_sql(c)} - 1.0::DOUBLE) * 0.3::DOUBLE)")
    return f"greatest(0.01, least(0.99, {raw}))"


DECILES = "[" + ", ".join(f"{d / 100:.1f}" for d in PSI_DECILES) + "]"


ORACLE: dict[str, str] = {}

# ---- silver / gold ---------------------------------------------------------
ORACLE["silver_features"] = with_base("SELECT * FROM silver_features")
ORACLE["silver_meta"] = with_base("SELECT * FROM silver_meta")
ORACLE["silver_labels"] = with_base("SELECT * FROM silver_labels")
ORACLE["gold_feature_store"] = with_base("SELECT * FROM gold_features")
ORACLE["gold_label_store"] = with_base("SELECT * FROM gold_labels")

# ---- exploration -------------------------------------------------------------
ORACLE["churn_distribution"] = with_base("""
SELECT Churn, CAST(count(*) AS BIGINT) AS n,
       round(count(*) * 100.0 / (SELECT count(*) FROM eda), 6) AS pct
FROM eda WHERE Churn IS NOT NULL GROUP BY Churn""")
for _dim, _name in [("Contract", "contract"), ("InternetService", "internet"), ("TechSupport", "techsupport"),
                    ("PaymentMethod", "payment"), ("OnlineSecurity", "onlinesecurity")]:
    ORACLE[f"crosstab_{_name}"] = with_base(f"""
SELECT '{_dim}' AS dimension, CAST({_dim} AS VARCHAR) AS value, Churn, CAST(count(*) AS BIGINT) AS n
FROM eda WHERE {_dim} IS NOT NULL AND Churn IS NOT NULL GROUP BY 2, 3""")


def _rate_sql(by: str, fill: bool) -> str:
    def share(v):
        s = f"CASE WHEN count_if(Churn = {v}) > 0 THEN count_if(Churn = {v}) * 1.0 / count(Churn) END"
        return f"round({'coalesce(' + s + ', 0.0)' if fill else s}, 6) AS churn_{v}"
    return with_base(f"SELECT {by}, {share(0)}, {share(1)} FROM eda GROUP BY {by} HAVING count(Churn) > 0")


ORACLE["rate_by_gender"] = _rate_sql("gender", False)
ORACLE["monthly_rate"] = _rate_sql("Snapshot_Date", True)
ORACLE["tenure_bin_churn"] = with_base(f"""
SELECT {eda_bin_sql()} AS tenure_bin, Churn, CAST(count(*) AS BIGINT) AS n
FROM eda WHERE {eda_bin_sql()} IS NOT NULL AND Churn IS NOT NULL GROUP BY 1, 2""")
ORACLE["snapshot_dates"] = with_base("SELECT DISTINCT Snapshot_Date FROM gold_labels ORDER BY 1")

# ---- monitoring -----------------------------------------------------------------
SCORE = heuristic_sql("coalesce(CAST(tenure AS DOUBLE), 12.0::DOUBLE)",
                      "coalesce(CAST(MonthlyCharges AS DOUBLE), 50.0::DOUBLE)", "Contract")
MON = f""",
mon AS (SELECT g.customerID, g.Snapshot_Date AS snapshot_date,
   CAST(date_trunc('month', g.Snapshot_Date) AS DATE) AS month_start, strftime(g.Snapshot_Date, '%b') AS month,
   round({SCORE.replace('tenure', 'g.tenure').replace('MonthlyCharges', 'g.MonthlyCharges').replace('Contract', 'g.Contract')}, 9)
     AS churn_probability,
   CAST(l.Churn AS INTEGER) AS actual_churn, g.MonthlyCharges AS monthly_charges
 FROM gold_features g JOIN gold_labels l ON g.customerID = l.customerID AND g.Snapshot_Date = l.Snapshot_Date
 WHERE l.Churn IS NOT NULL),
vals AS (SELECT 'churn_probability' AS feature, month_start, churn_probability AS value FROM mon
   UNION ALL SELECT 'monthly_charges', month_start, monthly_charges FROM mon)"""


def with_mon(select: str, extra: str = "") -> str:
    return with_base(select, MON + extra)


ORACLE["heuristic_score"] = with_mon(
    "SELECT customerID, snapshot_date, round(churn_probability, 6) AS churn_probability FROM mon")
ORACLE["target_list"] = with_mon(
    "SELECT customerID, snapshot_date, round(churn_probability, 6) AS churn_probability FROM mon "
    "WHERE churn_probability > 0.7")
ORACLE["scenario_expand"] = with_mon("""
SELECT customerID, snapshot_date AS source_date, s.idx AS scenario, s.month, CAST(s.d AS DATE) AS snapshot_date,
  actual_churn, monthly_charges, round(greatest(0.01, least(0.99, churn_probability + s.idx * 0.02)), 6) AS churn_probability
FROM mon, (VALUES (0, 'Apr', '1998-04-15'), (1, 'May', '1998-05-15'), (2, 'Jun', '1998-06-15'), (3, 'Jul', '1998-07-15'))
  AS s(idx, month, d)""")
ORACLE["pred_truth_join"] = with_base(f"""
SELECT p.customerID, p.snapshot_date, 'heuristic' AS model_name, p.binary_prediction, p.churn_probability,
  t.actual_churn, t.monthly_charges, strftime(p.snapshot_date, '%b') AS month
FROM (SELECT customerID, Snapshot_Date AS snapshot_date, CAST(s > 0.5 AS INTEGER) AS binary_prediction,
        round(s, 6) AS churn_probability
      FROM (SELECT *, {SCORE} AS s FROM gold_features)) p
JOIN (SELECT f.customerID, f.Snapshot_Date AS snapshot_date, l.Churn AS actual_churn, f.MonthlyCharges AS monthly_charges
      FROM silver_features f JOIN gold_labels l ON f.customerID = l.customerID AND f.Snapshot_Date = l.Snapshot_Date
      WHERE l.Churn IS NOT NULL) t
ON p.customerID = t.customerID AND p.snapshot_date = t.snapshot_date""")
ORACLE["customer_only_join"] = with_base("""
SELECT f.customerID, CAST(count(DISTINCT f.k) AS BIGINT) AS feature_rows, CAST(count(DISTINCT l.k) AS BIGINT) AS label_rows,
  CAST(count(*) AS BIGINT) AS joined_rows,
  CAST(count(*) - count_if(f.Snapshot_Date = l.Snapshot_Date) AS BIGINT) AS cross_snapshot_rows
FROM (SELECT customerID, Snapshot_Date, row_number() OVER () AS k FROM silver_features) f
JOIN (SELECT customerID, Snapshot_Date, row_number() OVER () AS k FROM gold_labels) l ON f.customerID = l.customerID
GROUP BY 1""")
ORACLE["label_test_yes"] = with_base(
    "SELECT customerID, Snapshot_Date, CAST(coalesce(Churn, '') = 'Yes' AS INTEGER) AS actual_churn FROM raw_labels")

AUC_CTE = """,
h AS (SELECT month_start, churn_probability AS s, sum(actual_churn) AS pos, count(*) - sum(actual_churn) AS neg
      FROM mon GROUP BY 1, 2),
c AS (SELECT *, sum(neg) OVER (PARTITION BY month_start ORDER BY s ROWS UNBOUNDED PRECEDING) AS cum FROM h),
auc AS (SELECT month_start, strftime(month_start, '%b') AS month, CAST(sum(pos) + sum(neg) AS BIGINT) AS n,
   CAST(sum(pos) AS BIGINT) AS positives,
   CASE WHEN sum(pos) > 0 AND sum(neg) > 0
        THEN sum(pos * (cum - neg + neg * 0.5)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) END AS auc
   FROM c GROUP BY 1)"""
ORACLE["monthly_auc"] = with_mon("SELECT * REPLACE (round(auc, 6) AS auc), auc < 0.65 AS below_alert FROM auc", AUC_CTE)
ORACLE["auc_summary"] = with_mon("""
SELECT CAST(count(*) AS BIGINT) AS months, round(avg(auc), 6) AS mean_auc, round(min(auc), 6) AS min_auc,
  round(max(auc), 6) AS max_auc, CAST(count_if(auc < 0.65) AS BIGINT) AS months_below_alert,
  avg(auc) >= 0.8 AS passes
FROM auc WHERE auc IS NOT NULL""", AUC_CTE)
ORACLE["deciles"] = with_mon(f"""
SELECT feature, month_start, CAST(i - 1 AS INTEGER) AS q_idx, CAST(round(({DECILES})[i], 2) AS DOUBLE) AS prob, round(q[i], 6) AS value
FROM (SELECT feature, month_start, quantile_cont(value, {DECILES}) AS q FROM vals
      WHERE value IS NOT NULL GROUP BY 1, 2), range(1, 12) t(i)""")

PSI_CTE = f""",
b AS (SELECT min(month_start) AS bm FROM mon),
base AS (SELECT v.* FROM vals v, b WHERE v.month_start = b.bm AND v.value IS NOT NULL),
e0 AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, {DECILES}))) AS e FROM base GROUP BY 1),
edges AS (SELECT feature, len(e) - 1 AS nb, CASE WHEN len(e) > 2 THEN e[2:len(e) - 1] ELSE [] END AS inner_e FROM e0),
binned AS (SELECT v.feature, v.month_start, len(list_filter(ed.inner_e, lambda x: x < v.value)) AS bin
           FROM vals v JOIN edges ed ON v.feature = ed.feature WHERE v.value IS NOT NULL),
counts AS (SELECT feature, month_start, bin, count(*) AS cnt FROM binned GROUP BY 1, 2, 3),
totals AS (SELECT feature, month_start, sum(cnt) AS t FROM counts GROUP BY 1, 2),
grid AS (SELECT t.feature, t.month_start, t.t, unnest(range(0, ed.nb)) AS bin
         FROM totals t JOIN edges ed ON t.feature = ed.feature WHERE ed.nb >= 1),
share AS (SELECT g.feature, g.month_start, g.bin, coalesce(c.cnt, 0) / g.t AS a
          FROM grid g LEFT JOIN counts c ON g.feature = c.feature AND g.month_start = c.month_start AND g.bin = c.bin),
bshare AS (SELECT s.feature, s.bin, s.a AS e FROM share s, b WHERE s.month_start = b.bm),
terms AS (SELECT s.feature, s.month_start,
            (CASE WHEN s.a = 0 THEN 0.0001 ELSE s.a END - CASE WHEN coalesce(x.e, 0) = 0 THEN 0.0001 ELSE x.e END)
            * ln(CASE WHEN s.a = 0 THEN 0.0001 ELSE s.a END / CASE WHEN coalesce(x.e, 0) = 0 THEN 0.0001 ELSE x.e END)
            AS term
          FROM share s LEFT JOIN bshare x ON s.feature = x.feature AND s.bin = x.bin),
psi AS (SELECT m.feature, m.month_start, coalesce(sum(t.term), 0.0) AS psi
        FROM (SELECT DISTINCT feature, month_start FROM vals WHERE value IS NOT NULL) m
        LEFT JOIN terms t ON m.feature = t.feature AND m.month_start = t.month_start GROUP BY 1, 2)"""
ORACLE["psi_report"] = with_mon("""
SELECT feature, month_start, strftime(month_start, '%b') AS month, round(psi, 6) AS psi,
  CASE WHEN psi > 0.25 THEN 'critical' WHEN psi > 0.1 THEN 'warning' ELSE 'stable' END AS status
FROM psi, b WHERE month_start > b.bm""", PSI_CTE)


def _kde_sql(feature: str) -> str:
    return with_mon(f"""
SELECT g.feature, g.month_start, CAST(g.point AS INTEGER) AS point,
  round(CASE WHEN g.point = 199 THEN g.g1 ELSE g.x END, 6) AS x,
  round(sum(h.c * exp(-0.5 * pow((g.x - h.value) / g.bw, 2))) / (g.n * g.bw * sqrt(2 * pi())), 6) AS density
FROM (SELECT s.*, p AS point, s.g0 + p * (s.g1 - s.g0) / 199 AS x
      FROM (SELECT feature, month_start, n, bw, lo - bw * 3 AS g0, hi + bw * 3 AS g1
            FROM (SELECT feature, month_start, count(*) AS n, stddev_samp(value) * pow(count(*), -0.2) AS bw,
                         min(value) AS lo, max(value) AS hi
                  FROM vals WHERE feature = '{feature}' AND value IS NOT NULL GROUP BY 1, 2
                  HAVING count(*) >= 2 AND stddev_samp(value) > 0)) s, range(0, 200) r(p)) g
JOIN (SELECT feature, month_start, value, count(*) AS c FROM vals WHERE feature = '{feature}' AND value IS NOT NULL
      GROUP BY 1, 2, 3) h ON g.feature = h.feature AND g.month_start = h.month_start
GROUP BY g.feature, g.month_start, g.point, g.x, g.g1, g.n, g.bw""")


ORACLE["kde_scores"] = _kde_sql("churn_probability")
ORACLE["kde_charges"] = _kde_sql("monthly_charges")

PRED = ", pred AS (SELECT actual_churn AS y, CAST(churn_probability > 0.5 AS INTEGER) AS p FROM mon)"
ORACLE["confusion_matrix"] = with_mon("""
SELECT g.label, g.prediction, CAST(count(pred.y) AS BIGINT) AS n
FROM (SELECT CAST(a AS INTEGER) AS label, CAST(b AS INTEGER) AS prediction FROM range(0, 2) r1(a), range(0, 2) r2(b)) g
LEFT JOIN pred ON pred.y = g.label AND pred.p = g.prediction GROUP BY 1, 2""", PRED)
REPORT_CTE = PRED + """,
cm AS (SELECT CAST(count_if(y = 0 AND p = 0) AS DOUBLE) c00, CAST(count_if(y = 0 AND p = 1) AS DOUBLE) c01,
              CAST(count_if(y = 1 AND p = 0) AS DOUBLE) c10, CAST(count_if(y = 1 AND p = 1) AS DOUBLE) c11 FROM pred),
k AS (SELECT *, CASE WHEN c00 + c10 > 0 THEN c00 / (c00 + c10) ELSE 0 END AS p0,
             CASE WHEN c00 + c01 > 0 THEN c00 / (c00 + c01) ELSE 0 END AS r0,
             CASE WHEN c01 + c11 > 0 THEN c11 / (c01 + c11) ELSE 0 END AS p1,
             CASE WHEN c10 + c11 > 0 THEN c11 / (c10 + c11) ELSE 0 END AS r1,
             c00 + c01 AS s0, c10 + c11 AS s1, c00 + c01 + c10 + c11 AS tot FROM cm),
f AS (SELECT *, CASE WHEN p0 + r0 <> 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0 END AS f0,
             CASE WHEN p1 + r1 <> 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0 END AS f1,
             CASE WHEN tot > 0 THEN (c00 + c11) / tot ELSE 0 END AS acc FROM k),
rep AS (
  SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM f
  UNION ALL SELECT '1', p1, r1, f1, s1 FROM f
  UNION ALL SELECT 'accuracy', acc, acc, acc, tot FROM f
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, tot FROM f
  UNION ALL SELECT 'weighted avg', CASE WHEN tot > 0 THEN (p0 * s0 + p1 * s1) / tot ELSE 0 END,
    CASE WHEN tot > 0 THEN (r0 * s0 + r1 * s1) / tot ELSE 0 END,
    CASE WHEN tot > 0 THEN (f0 * s0 + f1 * s1) / tot ELSE 0 END, tot FROM f)"""
ORACLE["classification_report"] = with_mon("""
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM rep""", REPORT_CTE)
ORACLE["accuracy_f1"] = with_mon("""
SELECT max(CASE WHEN class = 'accuracy' THEN round(precision, 6) END) AS accuracy,
  max(CASE WHEN class = '1' THEN round(f1, 6) END) AS f1 FROM rep""", REPORT_CTE)

# ---- sources / quality -----------------------------------------------------------------
for _feed in ["features", "meta", "labels"]:
    ORACLE[f"bronze_snapshot_{_feed}"] = with_base(
        f"SELECT * FROM raw_{_feed} WHERE TRY_STRPTIME(Snapshot_Date, '%Y-%m-%d') IS NOT NULL")

LAYERS = [("raw", "features", "raw_features"), ("raw", "meta", "raw_meta"), ("raw", "labels", "raw_labels"),
          ("silver", "features", "silver_features"), ("silver", "meta", "silver_meta"),
          ("silver", "labels", "silver_labels"), ("gold", "feature_store", "gold_features"),
          ("gold", "label_store", "gold_labels")]


def _snap(layer: str) -> str:
    return _date("Snapshot_Date") if layer == "raw" else "Snapshot_Date"


ORACLE["snapshot_row_counts"] = with_base(" UNION ALL ".join(
    f"SELECT '{l}' AS layer, '{f}' AS feed, {_snap(l)} AS snapshot_date, CAST(count(*) AS BIGINT) AS rows "
    f"FROM {t} GROUP BY 3" for l, f, t in LAYERS))
ORACLE["readiness_gaps"] = with_base(f"""
SELECT e.layer, e.feed, e.snapshot_date FROM (
  SELECT l.layer, l.feed, c.snapshot_date FROM
   (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 MONTH)) AS DATE) AS snapshot_date
    FROM (SELECT CAST(date_trunc('month', {_date('Snapshot_Date')}) AS DATE) AS d FROM raw_features)) c,
   (VALUES {', '.join(f"('{l}', '{f}')" for l, f, _ in LAYERS)}) l(layer, feed)) e
WHERE NOT EXISTS (SELECT 1 FROM ({' UNION ALL '.join(
    f"SELECT DISTINCT '{l}' AS layer, '{f}' AS feed, CAST(date_trunc('month', {_snap(l)}) AS DATE) AS d FROM {t}"
    for l, f, t in LAYERS)}) p
  WHERE p.layer = e.layer AND p.feed = e.feed AND p.d = e.snapshot_date)""")


def _funnel_sql(table: str, rules: list[tuple[str, str]]) -> str:
    names = ["input"] + [n for n, _ in rules]
    conds = ["TRUE"]
    acc = "TRUE"
    for _, r in rules:
        acc = f"{acc} AND coalesce({r}, FALSE)"
        conds.append(acc)
    sums = ", ".join(f"count_if({c}) AS s{i}" for i, c in enumerate(conds))
    rows = " UNION ALL ".join(
        f"SELECT {i} AS step_no, '{n}' AS step, CAST(s{i} AS BIGINT) AS rows, CAST(s0 - s{i} AS BIGINT) AS dropped FROM agg"
        for i, n in enumerate(names))
    return with_base(rows, f",\nagg AS (SELECT {sums} FROM {table})")


ORACLE["cleaning_funnel_features"] = _funnel_sql("raw_features", feature_rules_sql())
ORACLE["cleaning_funnel_meta"] = _funnel_sql("raw_meta", meta_rules_sql())

# ---- modelling set, splits, imputation ----------------------------------------------------
NUMERIC = ["tenure", "MonthlyCharges", "TotalCharges", "PhoneService", "PaperlessBilling", "gender",
           "SeniorCitizen", "Partner", "Dependents"]
CATEGORICAL = SIMPLE + ["PaymentMethod"]
FEATURE_COLS = ["tenure", "PhoneService"] + SIMPLE + ["PaperlessBilling", "PaymentMethod", "MonthlyCharges",
                                                     "TotalCharges", "gender", "SeniorCitizen", "Partner", "Dependents"]
SPLIT = f""",
ms AS (SELECT l.customerID, l.Snapshot_Date, l.Churn, {', '.join('g.' + c for c in FEATURE_COLS)}
       FROM gold_labels l LEFT JOIN gold_features g ON l.customerID = g.customerID AND l.Snapshot_Date = g.Snapshot_Date
       WHERE l.Snapshot_Date BETWEEN DATE '1998-04-01' AND DATE '1998-07-31'),
ts AS (SELECT * FROM (SELECT *, CASE WHEN Snapshot_Date BETWEEN DATE '1998-07-01' AND DATE '1998-07-31' THEN 'oot'
         WHEN Snapshot_Date BETWEEN DATE '1998-04-01' AND DATE '1998-06-30' THEN 'train_test' END AS part
       FROM ms WHERE Churn IS NOT NULL) WHERE part IS NOT NULL),
tt AS (SELECT * EXCLUDE (part), ('0x' || substr(md5(customerID || '|' || CAST(Snapshot_Date AS VARCHAR) || '|88'), 1, 15))::BIGINT AS h
       FROM ts WHERE part = 'train_test'),
ss AS (SELECT * EXCLUDE (h, rn, n), CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS part
       FROM (SELECT *, row_number() OVER (PARTITION BY Churn ORDER BY h, customerID, Snapshot_Date) AS rn,
                    count(*) OVER (PARTITION BY Churn) AS n FROM tt)),
parts AS (SELECT * FROM ss UNION ALL BY NAME SELECT * FROM ts WHERE part = 'oot')"""


def with_split(select: str, extra: str = "") -> str:
    return with_base(select, SPLIT + extra)


ORACLE["modelling_set"] = with_split("SELECT * FROM ms")
ORACLE["null_counts"] = with_split(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS nulls FROM ms"
    for c in ["customerID", "Snapshot_Date", "Churn"] + FEATURE_COLS))
ORACLE["train_calendar"] = with_base("""
SELECT d AS model_train_date, CAST(d - INTERVAL 1 DAY AS DATE) AS oot_end_date,
  CAST(d - INTERVAL 1 MONTH AS DATE) AS oot_start_date,
  CAST(d - INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS train_test_end_date,
  CAST(d - INTERVAL 4 MONTH AS DATE) AS train_test_start_date
FROM (SELECT DISTINCT CAST(date_trunc('month', Snapshot_Date) AS DATE) AS d FROM gold_labels) WHERE d IS NOT NULL""")
ORACLE["temporal_split"] = with_split("SELECT customerID, Snapshot_Date, Churn, part FROM ts")
ORACLE["stratified_split"] = with_split("SELECT customerID, Snapshot_Date, Churn, part FROM ss")
ORACLE["split_summary"] = with_split("""
SELECT part, CAST(count(*) AS BIGINT) AS rows, round(avg(CAST(Churn AS DOUBLE)), 2) AS label_mean FROM parts GROUP BY 1""")
ORACLE["median_impute"] = with_split(
    "SELECT customerID, Snapshot_Date, part, "
    + ", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont({c}, 0.5) FROM parts WHERE part = 'train')) AS {c}"
                for c in NUMERIC) + " FROM parts")


def _mode_sql(c: str, src: str, where: str = "TRUE", corr: str = "") -> str:
    return (f"coalesce((SELECT v FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {src} "
            f"WHERE {where} AND {c} IS NOT NULL {corr} GROUP BY 1 ORDER BY n DESC, v ASC LIMIT 1)), 'Unknown')")


TRAIN_ONLY = "part = 'train'"
ORACLE["mode_impute"] = with_split(
    "SELECT customerID, Snapshot_Date, part, "
    + ", ".join(f"coalesce({c}, {_mode_sql(c, 'parts', TRAIN_ONLY)}) AS {c}" for c in CATEGORICAL)
    + " FROM parts")
ORACLE["batch_impute"] = with_base(
    "SELECT g.customerID, g.Snapshot_Date, "
    + ", ".join(f"coalesce(CAST(g.{c} AS DOUBLE), med.{c}) AS {c}" for c in NUMERIC) + ", "
    + ", ".join(f"coalesce(g.{c}, md_{c}.v, 'Unknown') AS {c}" for c in CATEGORICAL)
    + " FROM gold_features g JOIN med ON med.d = g.Snapshot_Date "
    + " ".join(f"LEFT JOIN md_{c} ON md_{c}.d = g.Snapshot_Date" for c in CATEGORICAL),
    ",\nmed AS (SELECT Snapshot_Date AS d, " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in NUMERIC)
    + " FROM gold_features GROUP BY 1)"
    + "".join(f",\nmd_{c} AS (SELECT Snapshot_Date AS d, {c} AS v FROM gold_features WHERE {c} IS NOT NULL GROUP BY 1, 2 "
              f"QUALIFY row_number() OVER (PARTITION BY Snapshot_Date ORDER BY count(*) DESC, {c}) = 1)" for c in CATEGORICAL))
ORACLE["constant_fill"] = with_base(
    "SELECT customerID, Snapshot_Date, coalesce(CAST(tenure AS DOUBLE), 12.0) AS tenure, "
    "coalesce(MonthlyCharges, 50.0) AS MonthlyCharges, coalesce(TotalCharges, 600.0) AS TotalCharges, "
    + ", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT coalesce(quantile_cont({c}, 0.5), 0.0) FROM eda)) AS {c}"
                for c in NUMERIC if c not in ("tenure", "MonthlyCharges", "TotalCharges"))
    + " FROM eda")
ORACLE["tenure_groups"] = with_base(
    f"SELECT customerID, Snapshot_Date, tenure, {tenure_group_sql()} AS tenure_group FROM gold_features")

# ---- encoders / scalers ---------------------------------------------------------------------
BINARY = ["gender", "SeniorCitizen", "Partner", "Dependents", "PhoneService", "PaperlessBilling"]
ORACLE["label_encode"] = with_base(
    "SELECT customerID, Snapshot_Date, "
    + ", ".join(
        f"CAST(CASE WHEN g.{c} IS NULL THEN (SELECT count(DISTINCT CAST(x.{c} AS VARCHAR)) FROM gold_features x) "
        f"ELSE (SELECT count(DISTINCT CAST(x.{c} AS VARCHAR)) FROM gold_features x "
        f"WHERE CAST(x.{c} AS VARCHAR) < CAST(g.{c} AS VARCHAR)) END AS INTEGER) AS {c}" for c in BINARY)
    + " FROM gold_features g")
ORACLE["onehot"] = with_split(" UNION ALL ".join(
    f"SELECT customerID, Snapshot_Date, '{c}' AS column_name, {c} AS category, "
    f"CASE WHEN {c} IN (SELECT {c} FROM parts WHERE part = 'train' AND {c} IS NOT NULL) "
    f"THEN CAST((SELECT count(DISTINCT x.{c}) FROM parts x WHERE x.part = 'train' AND x.{c} < p.{c}) AS INTEGER) END AS slot, "
    f"CAST((SELECT count(DISTINCT x.{c}) FROM parts x WHERE x.part = 'train') AS INTEGER) AS width FROM parts p"
    for c in CATEGORICAL))
SCALED = ["tenure", "MonthlyCharges", "TotalCharges"]
ORACLE["standard_scale"] = with_split(
    "SELECT customerID, Snapshot_Date, part, "
    + ", ".join(f"round((CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM parts WHERE part = 'train')) / "
                f"(SELECT stddev_samp({c}) FROM parts WHERE part = 'train'), 6) AS {c}" for c in SCALED)
    + " FROM parts")
ORACLE["minmax_scale"] = with_split(
    "SELECT customerID, Snapshot_Date, part, "
    + ", ".join(f"round(CASE WHEN {c} IS NULL THEN NULL WHEN mx_{c} = mn_{c} THEN 0.5 "
                f"ELSE (CAST({c} AS DOUBLE) - mn_{c}) / (mx_{c} - mn_{c}) END, 6) AS {c}" for c in SCALED)
    + " FROM parts, (SELECT " + ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in SCALED)
    + " FROM parts WHERE part = 'train') st")

# ---- factorize / correlation -----------------------------------------------------------------
EDA_COLUMNS = ["customerID", "tenure", "PhoneService"] + SIMPLE + [
    "PaperlessBilling", "PaymentMethod", "MonthlyCharges", "TotalCharges", "Snapshot_Date",
    "gender", "SeniorCitizen", "Partner", "Dependents", "Churn"]
CODES = """,
eda_once AS MATERIALIZED (SELECT * FROM eda),
long AS MATERIALIZED (""" + " UNION ALL ".join(
    f"SELECT customerID AS k_id, Snapshot_Date AS k_date, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM eda_once"
    for c in EDA_COLUMNS) + """),
firsts AS (SELECT column_name, value, k_date, k_id FROM (
   SELECT *, row_number() OVER (PARTITION BY column_name, value ORDER BY k_date, k_id) AS rn FROM long
   WHERE value IS NOT NULL) WHERE rn = 1),
coded AS (SELECT column_name, value, CAST(row_number() OVER (PARTITION BY column_name ORDER BY k_date, k_id) - 1 AS INTEGER)
          AS code FROM firsts),
codes AS (SELECT l.k_id AS customerID, l.k_date AS Snapshot_Date, l.column_name, coalesce(c.code, -1) AS code
          FROM long l LEFT JOIN coded c ON l.column_name = c.column_name AND l.value = c.value)"""
ORACLE["factorize_codes"] = with_base("SELECT * FROM codes", CODES)
_pivot = ", ".join(f"max(CASE WHEN column_name = '{c}' THEN code END) AS c{i}" for i, c in enumerate(EDA_COLUMNS))
_pairs = " UNION ALL ".join(
    f"SELECT '{EDA_COLUMNS[i]}' AS row, '{EDA_COLUMNS[j]}' AS col, round(CASE WHEN stddev_pop(c{i}) = 0 "
    f"OR stddev_pop(c{j}) = 0 THEN NULL ELSE corr(c{i}, c{j}) END, 6) AS corr FROM wide"
    for i in range(len(EDA_COLUMNS)) for j in range(i))
ORACLE["correlation_lower"] = with_base(
    _pairs, CODES + f",\nwide AS (SELECT {_pivot} FROM codes GROUP BY customerID, Snapshot_Date)")

# ---- exports -------------------------------------------------------------------------------------
ORACLE["merged_analysis_set"] = with_base("SELECT * FROM eda")
ORACLE["colocated_analysis_set"] = ORACLE["merged_analysis_set"]
ORACLE["evolved_store"] = with_base(
    "SELECT * REPLACE (CAST(tenure AS BIGINT) AS tenure, CASE WHEN Snapshot_Date < DATE '1994-01-01' "
    "THEN 'not recorded' ELSE PaymentMethod END AS PaymentMethod) FROM gold_features")
ORACLE["schema_drift"] = with_base("""
SELECT Snapshot_Date AS snapshot_date, 'PaymentMethod' AS column_name, CAST(NULL AS VARCHAR) AS stored_type,
       'string' AS declared_type, 'added' AS state
FROM (SELECT DISTINCT Snapshot_Date FROM gold_features WHERE Snapshot_Date < DATE '1994-01-01')
UNION ALL
SELECT Snapshot_Date, 'tenure', 'smallint', 'bigint', 'widened'
FROM (SELECT DISTINCT Snapshot_Date FROM gold_features WHERE Snapshot_Date < DATE '1996-01-01')""")
ORACLE["label_map"] = with_base(
    "SELECT customerID, Snapshot_Date, CAST(CASE Churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS INTEGER) AS Churn "
    "FROM raw_labels")
for _feed in ("features", "meta", "labels"):
    ORACLE[f"bronze_stream_{_feed}"] = ORACLE[f"bronze_snapshot_{_feed}"]
ORACLE["onehot_drop_first"] = with_base(" UNION ALL ".join(
    f"SELECT g.customerID, g.Snapshot_Date, '{c}_' || v.v AS dummy, CAST(g.{c} = v.v AS INTEGER) AS value "
    f"FROM gold_features g, (SELECT DISTINCT {c} AS v FROM gold_features WHERE {c} IS NOT NULL "
    f"AND {c} > (SELECT min({c}) FROM gold_features)) v" for c in CATEGORICAL))


# ---- layers, previews, incremental state ----------------------------------------------------------
ORACLE["layer_funnel"] = with_base("""
SELECT c.d AS snapshot_date, features_raw, CASE WHEN c.d IS NULL THEN features_raw - features_silver ELSE 0 END AS features_date_lost,
  CASE WHEN c.d IS NULL THEN 0 ELSE features_raw - features_silver END AS features_rules_lost, features_silver,
  meta_raw, CASE WHEN c.d IS NULL THEN meta_raw - meta_silver ELSE 0 END AS meta_date_lost,
  CASE WHEN c.d IS NULL THEN 0 ELSE meta_raw - meta_silver END AS meta_rules_lost, meta_silver,
  labels_raw, CASE WHEN c.d IS NULL THEN labels_raw - labels_silver ELSE 0 END AS labels_date_lost,
  CASE WHEN c.d IS NULL THEN 0 ELSE labels_raw - labels_silver END AS labels_rules_lost, labels_silver,
  (SELECT count(*) FROM silver_features f WHERE f.Snapshot_Date = c.d AND NOT EXISTS (
     SELECT 1 FROM silver_meta m WHERE m.customerID = f.customerID AND m.Snapshot_Date = f.Snapshot_Date)) AS features_without_meta,
  (SELECT count(*) FROM silver_meta m WHERE m.Snapshot_Date = c.d AND NOT EXISTS (
     SELECT 1 FROM silver_features f WHERE m.customerID = f.customerID AND m.Snapshot_Date = f.Snapshot_Date)) AS meta_without_features,
  (SELECT count(*) FROM gold_features g WHERE g.Snapshot_Date = c.d) AS gold_rows,
  (SELECT count(*) FROM gold_features g WHERE g.Snapshot_Date = c.d AND NOT EXISTS (
     SELECT 1 FROM silver_labels l WHERE l.customerID = g.customerID AND l.Snapshot_Date = g.Snapshot_Date)) AS gold_without_label,
  (SELECT count(*) FROM silver_labels l WHERE l.Snapshot_Date = c.d AND NOT EXISTS (
     SELECT 1 FROM gold_features g WHERE l.customerID = g.customerID AND l.Snapshot_Date = g.Snapshot_Date)) AS labels_without_gold
FROM counted c""", ",\ncounted AS (SELECT d, " + ", ".join(
    f"CAST(count_if(t = '{f}_{x}') AS BIGINT) AS {f}_{x}" for f in ("features", "meta", "labels") for x in ("raw", "silver"))
    + " FROM (" + " UNION ALL ".join(
        [f"SELECT {_date('Snapshot_Date')} AS d, '{f}_raw' AS t FROM raw_{f}" for f in ("features", "meta", "labels")]
        + [f"SELECT Snapshot_Date, '{f}_silver' FROM silver_{f}" for f in ("features", "meta", "labels")]) + ") GROUP BY d)")
ORACLE["preview_rows"] = with_base(f"""
SELECT layer, feed, d AS snapshot_date, CAST(place AS INTEGER) AS place, customerID FROM (
  SELECT *, row_number() OVER (PARTITION BY layer, feed, d ORDER BY customerID) AS place FROM (
    {" UNION ALL ".join(f"SELECT '{l}' AS layer, '{f}' AS feed, {_snap(l)} AS d, customerID FROM {t}" for l, f, t in LAYERS)}))
WHERE place <= 5""")
ORACLE["psi_incremental"] = ORACLE["psi_report"]
ORACLE["auc_incremental"] = ORACLE["monthly_auc"]
ORACLE["kde_binned_charges"] = with_mon("""
SELECT feature, month_start, CAST(p AS INTEGER) AS point, round(g0 + p * step, 6) AS x,
  round((SELECT sum(b.m * exp(-0.5 * pow((s.g0 + p * s.step - (s.lo + b.bin * s.w)) / s.bw, 2))) FROM bins b
         WHERE b.month_start = s.month_start) / (n * bw * sqrt(2 * pi())), 6) AS density
FROM stats s, range(0, 200) r(p)""", """,
stats AS (SELECT feature, month_start, n, bw, lo, bw / 32 AS w, lo - bw * 3.0 AS g0, (hi - lo + 2 * bw * 3.0) / 199 AS step
  FROM (SELECT feature, month_start, count(*) AS n, stddev_samp(value) * pow(count(*), -0.2) AS bw, min(value) AS lo, max(value) AS hi
        FROM vals WHERE feature = 'monthly_charges' AND value IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 2 AND stddev_samp(value) > 0)),
placed AS (SELECT v.month_start, (v.value - s.lo) / s.w AS q FROM vals v JOIN stats s USING (feature, month_start) WHERE v.value IS NOT NULL),
bins AS (SELECT month_start, bin, sum(m) AS m FROM (
  SELECT month_start, floor(q) AS bin, 1 - (q - floor(q)) AS m FROM placed
  UNION ALL SELECT month_start, floor(q) + 1, q - floor(q) FROM placed) GROUP BY 1, 2)""")

# ---- change-driven backfill, drops delivered again ---------------------------------------------------
_RAW_ORDER = {
    "features": ["customerID", "tenure", "PhoneService", *SIMPLE, "PaperlessBilling", "PaymentMethod", "MonthlyCharges",
                 "TotalCharges", "Snapshot_Date"],
    "meta": ["customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "Snapshot_Date"],
    "labels": ["customerID", "Churn", "Snapshot_Date"]}


def _digest_sql(feed: str, table: str) -> str:
    text = " || chr(31) || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE '=' || {c} END" for c in _RAW_ORDER[feed])
    return (f"SELECT '{feed}' AS feed, d, count(*) AS n, CAST(sum(('0x' || substr(h, 1, 15))::BIGINT) AS VARCHAR) || ':' || "
            f"CAST(sum(('0x' || substr(h, 16, 15))::BIGINT) AS VARCHAR) AS digest "
            f"FROM (SELECT {_date('Snapshot_Date')} AS d, md5({text}) AS h FROM {table}) WHERE d IS NOT NULL GROUP BY d")


_DELIVERIES = """,
f1 AS (SELECT * FROM raw_features WHERE Snapshot_Date < '1998-06-01'),
f2 AS (SELECT * REPLACE (CASE WHEN substr(Snapshot_Date, 6, 2) = '05' AND CAST(substr(customerID, 2) AS INTEGER) % 10 = 0
                         THEN '1' ELSE tenure END AS tenure) FROM raw_features),
m2 AS (SELECT * FROM raw_meta WHERE Snapshot_Date NOT LIKE '1993%')"""
ORACLE["backfill_plan"] = with_base("""
SELECT CAST(step AS INTEGER) AS step, layer, feed, d AS snapshot_date,
  CASE s WHEN 'missing' THEN 'wait' WHEN 'removed' THEN 'keep' WHEN 'unchanged' THEN 'skip' ELSE 'rebuild' END AS action, s AS reason
FROM seen, (VALUES (1, 'bronze'), (2, 'silver')) t(step, layer)
UNION ALL
SELECT 3, 'gold', 'feature_store', d, CASE WHEN 'missing' IN (f, m) THEN 'wait' WHEN 'removed' IN (f, m) THEN 'keep'
    WHEN 'new' IN (f, m) OR 'changed' IN (f, m) THEN 'rebuild' ELSE 'skip' END,
  CASE WHEN f = 'unchanged' AND m = 'unchanged' THEN 'unchanged'
    ELSE concat_ws(', ', CASE WHEN f <> 'unchanged' THEN 'features ' || f END, CASE WHEN m <> 'unchanged' THEN 'meta ' || m END) END
FROM wide
UNION ALL
SELECT 3, 'gold', 'label_store', d, CASE l WHEN 'missing' THEN 'wait' WHEN 'removed' THEN 'keep' WHEN 'unchanged' THEN 'skip' ELSE 'rebuild' END,
  CASE WHEN l = 'unchanged' THEN l ELSE 'labels ' || l END
FROM wide""", _DELIVERIES + f""",
now_ AS MATERIALIZED ({_digest_sql('features', 'f2')} UNION ALL {_digest_sql('meta', 'm2')} UNION ALL {_digest_sql('labels', 'raw_labels')}),
was_ AS MATERIALIZED ({_digest_sql('features', 'f1')} UNION ALL {_digest_sql('meta', 'raw_meta')} UNION ALL {_digest_sql('labels', 'raw_labels')}),
cal AS (SELECT CAST(unnest(generate_series(min(d), max(d) + INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS DATE) AS d
        FROM (SELECT CAST(date_trunc('month', {_date('Snapshot_Date')}) AS DATE) AS d FROM raw_features)),
months AS (SELECT d, feed FROM cal, (VALUES ('features'), ('meta'), ('labels')) x(feed) UNION SELECT d, feed FROM now_ UNION SELECT d, feed FROM was_),
seen AS (SELECT k.feed, k.d, CASE WHEN n.digest IS NULL AND w.digest IS NULL THEN 'missing' WHEN n.digest IS NULL THEN 'removed'
           WHEN w.digest IS NULL THEN 'new' WHEN n.digest = w.digest AND n.n = w.n THEN 'unchanged' ELSE 'changed' END AS s
         FROM months k LEFT JOIN now_ n USING (feed, d) LEFT JOIN was_ w USING (feed, d)),
wide AS (SELECT d, max(s) FILTER (feed = 'features') AS f, max(s) FILTER (feed = 'meta') AS m, max(s) FILTER (feed = 'labels') AS l
         FROM seen GROUP BY d)""")
# months whose meta rows are gone keep what the first delivery built
ORACLE["backfill_changed"] = (
    "SELECT * FROM (" + with_base("SELECT * FROM gold_features") + ") WHERE year(Snapshot_Date) = 1993 UNION ALL BY NAME SELECT * FROM ("
    + with_base("SELECT * FROM gold_features").replace(
        "FROM raw_features WHERE", "FROM (SELECT * REPLACE (CASE WHEN substr(Snapshot_Date, 6, 2) = '05' AND "
        "CAST(substr(customerID, 2) AS INTEGER) % 10 = 0 THEN '1' ELSE tenure END AS tenure) FROM raw_features) WHERE")
    + ") WHERE year(Snapshot_Date) <> 1993")
ORACLE["bronze_stream_redelivery"] = with_base("""
SELECT customerID, Churn, Snapshot_Date FROM raw_labels
WHERE TRY_STRPTIME(Snapshot_Date, '%Y-%m-%d') IS NOT NULL AND Snapshot_Date NOT IN (SELECT Snapshot_Date FROM redelivered)
UNION ALL SELECT customerID, Churn, Snapshot_Date FROM redelivered""", """,
redelivered AS (SELECT customerID, CASE WHEN Churn = 'Yes' THEN 'No' ELSE 'Yes' END AS Churn, Snapshot_Date FROM raw_labels
  WHERE substr(Snapshot_Date, 6, 2) IN ('01', '04', '07', '10') AND CAST(substr(customerID, 2) AS INTEGER) % 2 = 0)""")
