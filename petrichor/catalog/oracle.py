"""The same queries as plain SQL over the same tables."""

from __future__ import annotations

ROW = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

OBS = """obs AS (
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS obs_date,
  'S' || CAST(l_suppkey % 49 AS VARCHAR) AS location,
  CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_extendedprice END AS price,
  CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_quantity END AS quantity,
  CASE WHEN l_partkey % 7 = 0 THEN 'NA' WHEN l_partkey % 17 = 0 THEN NULL ELSE l_returnflag END AS flag,
  CASE WHEN l_partkey % 19 = 0 THEN 99 WHEN l_partkey % 23 = 0 THEN NULL ELSE l_linenumber END AS code,
  CASE WHEN l_suppkey % 23 = 0 THEN NULL ELSE l_linestatus END AS target
FROM lineitem)"""

SCORED = """scored AS (
SELECT l_orderkey, l_linenumber,
  CAST(l_linestatus = 'O' AS DOUBLE) AS label,
  CAST(l_discount >= 0.05 AS DOUBLE) AS prediction,
  round(l_discount * 7 + l_tax * 3 + l_quantity / 50.0, 6) AS score,
  l_extendedprice AS price
FROM lineitem)"""

MONTH = "CAST(split_part(obs_date, '-', 2) AS INTEGER)"


def _obs(body: str) -> str:
    return f"WITH {OBS}\n{body}"


def _scored(body: str) -> str:
    return f"WITH {SCORED}\n{body}"


def _quartiles(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", quantile_disc(CAST({c} AS DOUBLE), 0.25) AS q1, "
        f"quantile_disc(CAST({c} AS DOUBLE), 0.5) AS median, "
        f"quantile_disc(CAST({c} AS DOUBLE), 0.75) AS q3 FROM obs"
        for c in columns
    )


def _modes(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"(SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS mode, count(*) AS n FROM obs "
        f"WHERE {c} IS NOT NULL AND CAST({c} AS VARCHAR) NOT IN ('null', 'NA') "
        f"GROUP BY 2 ORDER BY n DESC, mode LIMIT 1)"
        for c in columns
    )


#: Observations whose price is NaN in some rows.
_NAN = """, nans AS (
SELECT * REPLACE (CASE WHEN l_suppkey % 29 = 0 THEN CAST('NaN' AS DOUBLE) ELSE price END AS price) FROM obs)"""


def _correlations(columns: list[str]) -> str:
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    return " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", count(*) AS n, round(corr({a}, {b}), 9) AS correlation FROM nans "
        f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL AND NOT isnan(CAST({a} AS DOUBLE)) AND NOT isnan(CAST({b} AS DOUBLE))"
        for a, b in pairs
    )


def _profiles(columns: list[str]) -> str:
    def one(c: str) -> str:
        text = f"CAST({c} AS VARCHAR)"
        nan, sentinel = (f"count(*) FILTER (WHERE {text} = '{t}')" for t in ("nan", "NA"))
        rates = ", ".join(
            f"round(CAST({n} AS DOUBLE) / count(*), 9) AS {name}"
            for n, name in ((f"count(*) FILTER (WHERE {c} IS NULL)", "null_rate"), (nan, "nan_rate"), (sentinel, "sentinel_rate"))
        )
        held = f"count(DISTINCT {c}) FILTER (WHERE {text} NOT IN ('nan', 'NA'))"
        return f"SELECT '{c}' AS \"column\", count(*) AS \"rows\", {rates}, {held} AS n_distinct, true AS distinct_within_error FROM nans"

    return " UNION ALL ".join(map(one, columns))


def _dedupe(keys: list[str]) -> str:
    key = " || '-' || ".join(keys)
    order = "l_orderkey, l_linenumber, l_partkey, l_suppkey, obs_date, location, price, quantity, flag, code, target"
    nulls_first = ", ".join(f"{c} ASC NULLS FIRST" for c in order.split(", "))
    return f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {nulls_first}) AS nth FROM obs),
kept AS (SELECT * EXCLUDE (nth) FROM ranked WHERE nth = 1)"""


def _points(source: str, score: str, bins: int, label: str = "label") -> str:
    """CTEs ending in ``pts``: one row per curve point."""
    size = f"CASE WHEN {bins} = 0 OR k // greatest({bins}, 1) < 2 THEN 1 ELSE k // greatest({bins}, 1) END"
    return f"""groups AS (
SELECT {score} AS s, CAST(sum({label}) AS BIGINT) AS p, CAST(sum(1 - {label}) AS BIGINT) AS n
FROM {source} WHERE {score} IS NOT NULL AND {label} IS NOT NULL GROUP BY 1),
placed AS (SELECT *, row_number() OVER (ORDER BY s DESC) AS rn, count(*) OVER () AS k FROM groups),
binned AS (SELECT (rn - 1) // ({size}) AS bin, p, n FROM placed),
sums AS (SELECT bin, sum(p) AS p, sum(n) AS n FROM binned GROUP BY bin),
pts AS (
SELECT bin, p, n,
  CAST(sum(p) OVER (ORDER BY bin) AS DOUBLE) AS tp, CAST(sum(n) OVER (ORDER BY bin) AS DOUBLE) AS fp,
  CAST(sum(p) OVER () AS DOUBLE) AS pos, CAST(sum(n) OVER () AS DOUBLE) AS neg
FROM sums)"""


_ROC = """SELECT CAST(0 AS BIGINT) AS position, CAST(0 AS DOUBLE) AS x, CAST(0 AS DOUBLE) AS y
UNION ALL SELECT CAST(bin + 1 AS BIGINT), round(fp / neg, 9), round(tp / pos, 9) FROM pts
UNION ALL SELECT CAST(max(bin) + 2 AS BIGINT), 1.0, 1.0 FROM pts"""

_PR = """SELECT CAST(0 AS BIGINT) AS position, CAST(0 AS DOUBLE) AS x, round(tp / (tp + fp), 9) AS y FROM pts WHERE bin = 0
UNION ALL SELECT CAST(bin + 1 AS BIGINT), round(tp / pos, 9), round(tp / (tp + fp), 9) FROM pts"""

_AUC_ROC = """, steps AS (
SELECT fp / neg AS x, tp / pos AS y,
  coalesce(lag(fp / neg) OVER (ORDER BY bin), 0) AS x0, coalesce(lag(tp / pos) OVER (ORDER BY bin), 0) AS y0
FROM pts)
SELECT round(sum((x - x0) * (y + y0) / 2), 9) AS auc_roc FROM steps"""

_AUC_PR = """, steps AS (
SELECT tp / pos AS x, tp / (tp + fp) AS y,
  coalesce(lag(tp / pos) OVER (ORDER BY bin), 0) AS x0,
  coalesce(lag(tp / (tp + fp)) OVER (ORDER BY bin), tp / (tp + fp)) AS y0
FROM pts)
SELECT round(sum((x - x0) * (y + y0) / 2), 9) AS auc_pr FROM steps"""

_CLASSES = """, classes AS (
SELECT c.label,
  (SELECT count(*) FROM scored s WHERE s.label = c.label) AS support,
  (SELECT count(*) FROM scored s WHERE s.prediction = c.label) AS predicted,
  (SELECT count(*) FROM scored s WHERE s.label = c.label AND s.prediction = c.label) AS tp,
  (SELECT count(*) FROM scored) AS total
FROM (SELECT label FROM scored UNION SELECT prediction FROM scored) c)"""

_CELLS = """count(*) FILTER (WHERE prediction = 1 AND label = 1) AS tp,
count(*) FILTER (WHERE prediction = 1 AND label <> 1) AS fp,
count(*) FILTER (WHERE prediction <> 1 AND label <> 1) AS tn,
count(*) FILTER (WHERE prediction <> 1 AND label = 1) AS fn"""


def _labels(column: str, order: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", value, n, CAST(row_number() OVER (ORDER BY {order}) - 1 AS DOUBLE) AS \"index\" "
        f"FROM (SELECT CAST({column} AS VARCHAR) AS value, count(*) AS n FROM src WHERE {column} IS NOT NULL GROUP BY 1)"
    )


_SRC = f"src AS (SELECT {ROW}, obs_date, location, price, quantity, target, nullif(flag, 'NA') AS flag, {MONTH} AS \"Month\" FROM obs)"


def _chi(feature: str, digits: int = 6) -> str:
    return f"""SELECT '{feature}' AS feature,
  round((SELECT sum((coalesce(o, 0) - r * c / n) * (coalesce(o, 0) - r * c / n) / (r * c / n))
    FROM (SELECT v, CAST(count(*) AS DOUBLE) AS r FROM x WHERE f = '{feature}' GROUP BY v) rs
    CROSS JOIN (SELECT t, CAST(count(*) AS DOUBLE) AS c FROM x WHERE f = '{feature}' GROUP BY t) cs
    CROSS JOIN (SELECT CAST(count(*) AS DOUBLE) AS n FROM x WHERE f = '{feature}') ns
    LEFT JOIN (SELECT v, t, CAST(count(*) AS DOUBLE) AS o FROM x WHERE f = '{feature}' GROUP BY v, t) os USING (v, t)), {digits}) AS statistic,
  (SELECT CAST((count(DISTINCT v) - 1) * (count(DISTINCT t) - 1) AS INTEGER) FROM x WHERE f = '{feature}') AS degrees_of_freedom"""


def _place(prefix: str) -> str:
    """A key's number in [0, 1) for one purpose and seed."""
    return f"""(CAST('0x' || substr(md5('{prefix}|' || CAST(l_orderkey AS VARCHAR) || '|' ||
  CAST(l_linenumber AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0)"""


_SIDE = """CASE WHEN CAST('0x' || substr(md5('0|' || CAST(l_orderkey AS VARCHAR) || '|' ||
  CAST(l_linenumber AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < 0.7 THEN 'train' ELSE 'test' END"""

_ORDER = ", ".join(
    f"{c} ASC NULLS FIRST"
    for c in (*ROW.split(", "), "obs_date", "location", "price", "quantity", "flag", "code", "target")
)

# One row per order line, with a class, the sentinel nulled, the month, a side.
_SIDES = f"""nulled AS (SELECT * REPLACE (nullif(flag, 'NA') AS flag, nullif(target, 'NA') AS target,
  nullif(obs_date, 'NA') AS obs_date, nullif(location, 'NA') AS location) FROM obs),
placed AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER}) AS nth FROM nulled),
sided AS (SELECT * EXCLUDE (nth), {MONTH} AS "Month", {_SIDE} AS side FROM placed
  WHERE nth = 1 AND target IS NOT NULL)"""


def _train_codes(column: str) -> str:
    value = f"CAST({column} AS VARCHAR)"
    return (
        f"SELECT {value} AS v, CAST(row_number() OVER (ORDER BY {value} DESC) - 1 AS DOUBLE) AS i "
        f"FROM filled WHERE side = 'train' GROUP BY 1"
    )


def _train_cap(column: str) -> str:
    q1, q2, q3 = (
        f"(SELECT quantile_disc({column}, {p}) FROM sided WHERE side = 'train')" for p in (0.25, 0.5, 0.75)
    )
    return (
        f"CASE WHEN {column} IS NULL THEN {q2} WHEN {column} > {q3} + 1.5 * ({q3} - {q1}) THEN {q3} + 1.5 * ({q3} - {q1}) "
        f"WHEN {column} < {q1} - 1.5 * ({q3} - {q1}) THEN {q1} - 1.5 * ({q3} - {q1}) ELSE {column} END"
    )


def _train_mode(column: str) -> str:
    return (
        f"(SELECT {column} FROM sided WHERE side = 'train' AND {column} IS NOT NULL "
        f"GROUP BY 1 ORDER BY count(*) DESC, CAST({column} AS VARCHAR) LIMIT 1)"
    )


_PREPARED = f""", {_SIDES},
filled AS (SELECT {ROW}, side, "Month", location, target, coalesce(flag, {_train_mode('flag')}) AS flag,
  CASE WHEN code BETWEEN 0 AND 8 THEN code ELSE {_train_mode('code')} END AS code,
  {_train_cap('price')} AS price, {_train_cap('quantity')} AS quantity FROM sided),
m AS ({_train_codes('"Month"')}), l AS ({_train_codes('location')}), f AS ({_train_codes('flag')}),
t AS (SELECT target AS v, CAST(row_number() OVER (ORDER BY target) - 1 AS DOUBLE) AS i FROM filled WHERE side = 'train' GROUP BY 1)
SELECT {ROW}, code, t.i AS label, price AS f0, quantity AS f1, m.i AS f2, l.i AS f3, f.i AS f4
FROM filled JOIN m ON CAST("Month" AS VARCHAR) = m.v JOIN l ON location = l.v JOIN f ON flag = f.v JOIN t ON target = t.v
WHERE side = 'test'"""

#: Line items with a class that discount and tax decide; ``kept`` has one row per key, as cleaning leaves it.
_PLANTED_ROWS = """rows AS (
SELECT l_orderkey, l_linenumber, l_discount AS discount, l_tax AS tax, l_discount > 0.045 AND l_tax > 0.035 AS large,
  l_returnflag = 'R' OR l_suppkey % 49 = 7 AS hot, l_returnflag AS flag, 'S' || (l_suppkey % 49) AS place,
  CASE WHEN l_suppkey % 23 = 0 THEN NULL WHEN l_discount > 0.045 AND l_tax > 0.035 THEN 'O' ELSE 'F' END AS target FROM lineitem)"""

_BINARY_ROWS = f"""rows AS (SELECT l_orderkey, l_linenumber, l_discount > 0.045 AS large, l_linestatus AS target FROM lineitem),
kept AS (SELECT *, {_SIDE} AS side FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY large, target) AS nth FROM rows) WHERE nth = 1)"""


def _planted(body: str) -> str:
    order = {"one-hot": "discount, flag, place, hot", "logistic": "discount > 0.045"}
    order = next((o for name, o in order.items() if name in body), "discount, tax, target NULLS FIRST")
    return f"""WITH {_PLANTED_ROWS},
kept AS (SELECT *, {_SIDE} AS side FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS nth FROM rows) WHERE nth = 1)
{body}"""


def _perfect(learner: str, positive: str = "large", extra: str = "target IS NOT NULL", source: str = "kept") -> str:
    """The report of a learner that makes no mistake on the test side."""
    side = "side = 'test'" if source == "kept" else f"{_SIDE} = 'test'"
    return f"""SELECT '{learner}' AS learner, count(*) FILTER (WHERE {positive}) AS tp, CAST(0 AS BIGINT) AS fp,
  count(*) FILTER (WHERE NOT ({positive})) AS tn, CAST(0 AS BIGINT) AS fn, CAST(1 AS DOUBLE) AS accuracy,
  CAST(1 AS DOUBLE) AS auc_roc, CAST(1 AS DOUBLE) AS auc_pr FROM {source} WHERE {side} AND ({extra})"""


ORACLE: dict[str, str] = {
    # Scans and cleaning
    "csv_scan_typed": _obs(
        f"SELECT {ROW}, obs_date, location, price, quantity, coalesce(flag, 'NA') AS flag, code, "
        "coalesce(target, 'NA') AS target FROM obs"
    ),
    "drop_columns": _obs("SELECT * EXCLUDE (quantity, code) FROM obs"),
    "replace_sentinel": _obs("SELECT * REPLACE (nullif(flag, 'NA') AS flag, nullif(target, 'NA') AS target) FROM obs"),
    "drop_empty_rows": _obs(
        "SELECT price, quantity, target FROM obs "
        "WHERE price IS NOT NULL OR quantity IS NOT NULL OR target IS NOT NULL"
    ),
    "drop_unlabelled": _obs("SELECT * FROM obs WHERE target IS NOT NULL"),
    "dedupe_by_key": _obs(f", {_dedupe(['obs_date', 'location'])} SELECT * FROM kept"),
    "dedupe_null_keys": _obs(f", {_dedupe(['obs_date', 'flag'])} SELECT * FROM kept"),
    "dedupe_keep_null_keys": _obs(
        f", {_dedupe(['obs_date', 'flag'])} SELECT * FROM kept WHERE flag IS NOT NULL "
        "UNION ALL SELECT * FROM obs WHERE flag IS NULL"
    ),
    "cleaning_audit": _obs(
        f""", {_dedupe(['obs_date', 'location'])},
counts AS (SELECT (SELECT count(*) FROM obs) AS total_rows, count(*) AS unique_rows,
  count(*) FILTER (WHERE target IS NULL) AS unlabelled_rows FROM kept)
SELECT total_rows, total_rows - unique_rows AS duplicate_rows, CAST(0 AS BIGINT) AS empty_rows,
  total_rows - unique_rows AS empty_rows_cumulative, unlabelled_rows,
  total_rows - unique_rows + unlabelled_rows AS unlabelled_rows_cumulative,
  unique_rows - unlabelled_rows AS kept_rows,
  round(CAST(total_rows - unique_rows + unlabelled_rows AS DOUBLE) / total_rows, 9) AS unclassified_rate
FROM counts"""
    ),
    "train_audits": f"""WITH {OBS}, nulled AS (SELECT * REPLACE (nullif(target, 'NA') AS target, nullif(location, 'NA') AS location) FROM obs),
counted AS (SELECT *, count(*) OVER k AS copies, row_number() OVER (k ORDER BY {_ORDER}) AS nth FROM nulled WINDOW k AS (PARTITION BY obs_date || '|' || flag)),
sided AS (SELECT *, CASE WHEN CAST('0x' || substr(md5('0|' || coalesce(obs_date, '') || '|' || coalesce(flag, '')), 1, 8) AS BIGINT) / 4294967296.0 < 0.7
  THEN 0 ELSE 1 END AS side FROM counted WHERE nth = 1),
counts AS (SELECT side, CAST(sum(copies) AS BIGINT) AS total_rows, count(*) AS unique_rows, count(*) FILTER (WHERE target IS NULL) AS unlabelled_rows FROM sided GROUP BY side)
SELECT side, total_rows, total_rows - unique_rows AS duplicate_rows, CAST(0 AS BIGINT) AS empty_rows, total_rows - unique_rows AS empty_rows_cumulative,
  unlabelled_rows, total_rows - unique_rows + unlabelled_rows AS unlabelled_rows_cumulative, unique_rows - unlabelled_rows AS kept_rows,
  round(CAST(total_rows - unique_rows + unlabelled_rows AS DOUBLE) / total_rows, 9) AS unclassified_rate, unique_rows - unlabelled_rows AS rows_left
FROM counts""",
    "extract_month": _obs(f'SELECT * EXCLUDE (obs_date), {MONTH} AS "Month" FROM obs'),
    "first_observation": _obs(f"SELECT * FROM obs ORDER BY obs_date, location, {ROW} LIMIT 1"),
    "split_by_key": _obs(
        f"""SELECT {ROW}, CASE WHEN CAST('0x' || substr(md5('0|' || CAST(l_orderkey AS VARCHAR) || '|' ||
  CAST(l_linenumber AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < 0.7 THEN 'train' ELSE 'test' END AS side FROM obs"""
    ),
    "fold_counts": _obs(
        f"""SELECT CAST(floor({_place('fold|0')} * 5) AS INTEGER) AS fold, count(*) AS n
FROM obs WHERE {_place('0')} < 0.7 GROUP BY 1"""
    ),
    "nested_split_counts": _obs(
        f"""SELECT CASE WHEN {_place('level 1|0')} < 0.7 THEN 0 ELSE 1 END AS side, count(*) AS n
FROM obs WHERE {_place('0')} < 0.7 GROUP BY 1"""
    ),
    "split_random": _obs("SELECT *, TRUE AS share_is_right FROM obs"),
    "clean_and_split": _obs(f", {_SIDES} SELECT * FROM sided"),
    "prepare_features": _obs(_PREPARED),
    # Statistics and imputation
    "value_counts": _obs("SELECT flag AS value, count(*) AS n FROM obs GROUP BY 1"),
    "mode_per_column": _obs(_modes(["flag", "target", "location", "code", "obs_date"])),
    "quartiles_exact": _obs(_quartiles(["price", "quantity", "code", "l_partkey"])),
    "quartiles_narrowed": _obs(_quartiles(["price", "quantity", "code", "l_partkey"])),
    "correlation_matrix": f"WITH {OBS}{_NAN} " + _correlations(["price", "quantity", "code", "l_partkey", "l_linenumber"]),
    "null_rate_profile": f"WITH {OBS}{_NAN} "
    + _profiles([*ROW.split(", "), "obs_date", "location", "price", "quantity", "flag", "code", "target"]),
    "quartiles_approx": _obs(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, count({c}) AS n, true AS occurs, true AS within_error FROM obs"
            for c in ("price", "quantity", "code", "l_partkey")
            for p in (0.25, 0.5, 0.75)
        )
    ),
    "iqr_bounds": _obs(
        f", q AS ({_quartiles(['price', 'quantity', 'code'])}) "
        "SELECT *, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q"
    ),
    "iqr_cap_impute": _obs(
        f""", q AS ({_quartiles(['price', 'quantity', 'code'])}),
b AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT {ROW}, {", ".join(
            f"CASE WHEN o.{c} > {c[0]}.hi THEN {c[0]}.hi WHEN o.{c} < {c[0]}.lo THEN {c[0]}.lo "
            f"WHEN o.{c} IS NULL THEN {c[0]}.median ELSE CAST(o.{c} AS DOUBLE) END AS {c}"
            for c in ("price", "quantity", "code"))}
FROM obs o, (SELECT * FROM b WHERE "column" = 'price') p, (SELECT * FROM b WHERE "column" = 'quantity') q,
  (SELECT * FROM b WHERE "column" = 'code') c"""
    ),
    "mode_impute": _obs(
        f""", m AS ({_modes(['flag', 'target'])})
SELECT {ROW}, coalesce(nullif(flag, 'NA'), (SELECT mode FROM m WHERE "column" = 'flag')) AS flag,
  coalesce(nullif(target, 'NA'), (SELECT mode FROM m WHERE "column" = 'target')) AS target FROM obs"""
    ),
    "mode_domain_impute": _obs(
        f""", m AS ({_modes(['code'])})
SELECT {ROW}, CASE WHEN code BETWEEN 0 AND 8 THEN code
  ELSE (SELECT CAST(mode AS INTEGER) FROM m) END AS code FROM obs"""
    ),
    "distinct_labels": _obs("SELECT DISTINCT target FROM obs"),
    "prediction_stddev": _scored("SELECT round(stddev_samp(prediction), 9) AS stddev FROM scored"),
    "topk_scores": _scored(
        "SELECT l_orderkey, l_linenumber, score, price, label FROM scored "
        "ORDER BY score DESC, price DESC, l_orderkey, l_linenumber LIMIT 17"
    ),
    # Encoding
    "string_index_alpha_desc": _obs(
        f""", {_SRC}, lm AS ({_labels('"Month"', 'value DESC')}), ll AS ({_labels('location', 'value DESC')})
SELECT {ROW}, "Month", location, lm."index" AS "Month_num", ll."index" AS location_num
FROM src JOIN lm ON CAST(src."Month" AS VARCHAR) = lm.value JOIN ll ON src.location = ll.value"""
    ),
    "string_index_freq": _obs(
        f", {_SRC} "
        + " UNION ALL ".join(f"({_labels(c, 'n DESC, value')})" for c in ("flag", "location", "target"))
    ),
    "label_index": _obs(
        f"""SELECT {ROW}, target, CAST(k - rank AS DOUBLE) AS once, CAST(rank - 1 AS DOUBLE) AS twice
FROM obs JOIN (SELECT target AS t, row_number() OVER (ORDER BY target) AS rank, count(*) OVER () AS k
  FROM (SELECT DISTINCT target FROM obs WHERE target IS NOT NULL)) ON target = t"""
    ),
    "index_skip_invalid": _obs(
        f""", {_SRC}, lf AS ({_labels('flag', 'value DESC')})
SELECT {ROW}, flag, lf."index" AS flag_num FROM src JOIN lf ON flag = value"""
    ),
    "index_keep_invalid": _obs(
        f""", {_SRC}, lf AS ({_labels('flag', 'value DESC')})
SELECT {ROW}, flag, coalesce(lf."index", (SELECT CAST(count(*) AS DOUBLE) FROM lf)) AS flag_num
FROM src LEFT JOIN lf ON flag = value"""
    ),
    "one_hot_cells": _obs(
        f""", {_SRC}, lf AS ({_labels('flag', 'value DESC')}), ll AS ({_labels('location', 'value DESC')}),
sizes AS (SELECT (SELECT count(*) FROM lf) - 1 AS kf, (SELECT count(*) FROM ll) - 1 AS kl)
SELECT {ROW}, CAST(kf AS INTEGER) AS flag_length,
  CAST(CASE WHEN lf."index" < kf THEN lf."index" ELSE -1 END AS INTEGER) AS flag_place,
  CAST(kl AS INTEGER) AS location_length,
  CAST(CASE WHEN ll."index" < kl THEN ll."index" ELSE -1 END AS INTEGER) AS location_place
FROM src JOIN lf ON flag = lf.value JOIN ll ON location = ll.value CROSS JOIN sizes"""
    ),
    "assemble_features": _obs(
        f""", all_rows AS (SELECT {ROW}, price, quantity, location, nullif(flag, 'NA') AS flag, {MONTH} AS "Month" FROM obs),
src AS (SELECT * FROM all_rows WHERE price IS NOT NULL AND quantity IS NOT NULL AND flag IS NOT NULL),
lm AS ({_labels('"Month"', 'value DESC')}), ll AS ({_labels('location', 'value DESC')}),
lf AS ({_labels('flag', 'value DESC')})
SELECT {ROW}, price AS f0, quantity AS f1, lm."index" AS f2, ll."index" AS f3, lf."index" AS f4
FROM src JOIN lm ON CAST(src."Month" AS VARCHAR) = lm.value JOIN ll ON location = ll.value JOIN lf ON flag = lf.value"""
    ),
    "index_to_string": _obs(
        "SELECT CAST(row_number() OVER (ORDER BY target DESC) - 1 AS DOUBLE) AS label, target AS original "
        "FROM (SELECT DISTINCT target FROM obs WHERE target IS NOT NULL)"
    ),
    "chi_square": _obs(
        ", x AS ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS f, CAST({e} AS VARCHAR) AS v, target AS t FROM obs WHERE {e} IS NOT NULL AND target IS NOT NULL"
            for c, e in (("flag", "nullif(flag, 'NA')"), ("code", "code"), ("location", "location"))
        )
        + ") "
        + " UNION ALL ".join(_chi(c) for c in ("flag", "code", "location"))
    ),
    "chi_square_p_values": _obs(
        ", x AS ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS f, CAST({e} AS VARCHAR) AS v, target AS t FROM obs WHERE {e} IS NOT NULL AND target IS NOT NULL"
            for c, e in (("flag", "nullif(flag, 'NA')"), ("location", "location"))
        )
        + "), c AS ("
        + " UNION ALL ".join(_chi(c, digits=12) for c in ("flag", "location"))
        + """) SELECT feature, degrees_of_freedom, round(statistic, 6) AS statistic,
  round(exp(-statistic / 2) * (SELECT sum(exp(i * ln(statistic / 2) - lgamma(i + 1)))
    FROM range(0, degrees_of_freedom // 2) t(i)), 9) AS p_value FROM c"""
    ),
    "tokenize_counts": r"""SELECT doc_id, CAST(CASE WHEN text = '' THEN 1
  WHEN regexp_full_match(text, '[ \t\n\x0B\f\r]+') THEN 0
  ELSE len(string_split_regex(regexp_replace(lower(text), '[ \t\n\x0B\f\r]+$', ''), '[ \t\n\x0B\f\r]')) END AS INTEGER) AS n_words
FROM documents""",
    "hashing_tf": r"""SELECT doc_id, CAST(CASE WHEN text = '' THEN 1
  WHEN regexp_full_match(text, '[ \t\n\x0B\f\r]+') THEN 0
  ELSE len(string_split_regex(regexp_replace(lower(text), '[ \t\n\x0B\f\r]+$', ''), '[ \t\n\x0B\f\r]')) END AS BIGINT) AS n_terms
FROM documents""",
    # Evaluation
    "accuracy_error": _scored(
        "SELECT round(avg(CAST(label = prediction AS DOUBLE)), 9) AS accuracy, "
        "round(1 - avg(CAST(label = prediction AS DOUBLE)), 9) AS error FROM scored"
    ),
    "error_rate": _scored(
        "SELECT count(*) FILTER (WHERE label <> prediction) AS errors, count(*) AS n, "
        "round(CAST(count(*) FILTER (WHERE label <> prediction) AS DOUBLE) / count(*), 9) AS error_rate FROM scored"
    ),
    "weighted_f1": _scored(
        f"""{_CLASSES}
SELECT round(sum(support * coalesce(CAST(tp AS DOUBLE) / nullif(predicted, 0), 0)) / sum(support), 9) AS weighted_precision,
  round(sum(support * coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0)) / sum(support), 9) AS weighted_true_positive_rate,
  round(sum(support * coalesce(CAST(predicted - tp AS DOUBLE) / nullif(total - support, 0), 0)) / sum(support), 9) AS weighted_false_positive_rate,
  round(sum(support * coalesce(2.0 * tp / nullif(support + predicted, 0), 0)) / sum(support), 9) AS weighted_f1
FROM classes"""
    ),
    "tpr_by_label": _scored(
        f"{_CLASSES} SELECT label, support, tp, round(CAST(tp AS DOUBLE) / nullif(support, 0), 9) AS true_positive_rate FROM classes"
    ),
    "fpr_by_label": _scored(
        f"{_CLASSES} SELECT label, predicted, tp, "
        "round(CAST(predicted - tp AS DOUBLE) / nullif(total - support, 0), 9) AS false_positive_rate FROM classes"
    ),
    "confusion_matrix": _scored(f"SELECT {_CELLS} FROM scored"),
    "confusion_rates": _scored(
        f""", cells AS (SELECT {_CELLS} FROM scored)
SELECT tp, fp, tn, fn, round(CAST(tp + tn AS DOUBLE) / (tp + fp + tn + fn), 9) AS accuracy,
  round(CAST(tp AS DOUBLE) / (tp + fn), 9) AS recall,
  round(CAST(fp AS DOUBLE) / (fp + tn), 9) AS false_positive_rate,
  round(CAST(tp AS DOUBLE) / (tp + fp), 9) AS precision FROM cells"""
    ),
    "error_confidence": _scored(
        """, e AS (SELECT count(*) AS n, avg(CAST(label <> prediction AS DOUBLE)) AS err FROM scored)
SELECT n, round(err, 9) AS error_rate,
  round(err - sqrt(err * (1 - err) / CAST(1.96 AS DOUBLE)), 9) AS ci_ref_low,
  round(err + sqrt(err * (1 - err) / CAST(1.96 AS DOUBLE)), 9) AS ci_ref_high,
  round(err - CAST(1.96 AS DOUBLE) * sqrt(err * (1 - err) / n), 9) AS ci95_low,
  round(err + CAST(1.96 AS DOUBLE) * sqrt(err * (1 - err) / n), 9) AS ci95_high FROM e"""
    ),
    "auc_hard_labels": _scored(f", {_points('scored', 'prediction', 1000)} {_AUC_ROC}"),
    "auc_roc": _scored(f", {_points('scored', 'price', 1000)} {_AUC_ROC}"),
    "auc_pr": _scored(f", {_points('scored', 'score', 15)} {_AUC_PR}"),
    "auc_pr_single_feature": _obs(
        ", rows AS (SELECT price, CAST(target = 'O' AS DOUBLE) AS label FROM obs), "
        f"{_points('rows', 'price', 0)} {_AUC_PR}"
    ),
    "areas_by_group": _scored(
        """, c AS (SELECT l_linenumber, score, sum(label) AS p, sum(1 - label) AS n FROM scored GROUP BY ALL),
r AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER g AS pos, sum(n) OVER g AS neg FROM c
  WINDOW w AS (PARTITION BY l_linenumber ORDER BY score DESC), g AS (PARTITION BY l_linenumber)),
t AS (SELECT *, tp / (tp + fp) AS prec, tp - p AS btp, fp - n AS bfp FROM r)
SELECT l_linenumber, round(sum(n * (tp + btp)) / 2 / (max(pos) * max(neg)), 9) AS auc_roc,
  round(sum(p * (prec + CASE WHEN btp + bfp > 0 THEN btp / (btp + bfp) ELSE prec END)) / 2 / max(pos), 9) AS auc_pr
FROM t GROUP BY l_linenumber"""
    ),
    "threshold_cells": _scored(
        """, t AS (SELECT unnest([0.0, 0.25, 0.5, 0.75, 1.0, 1.25, 1e6]::DOUBLE[]) AS threshold)
SELECT l_linenumber % 2 AS half, threshold, count(*) FILTER (WHERE score > threshold AND label = 1) AS tp,
  count(*) FILTER (WHERE score > threshold AND label = 0) AS fp, count(*) FILTER (WHERE score <= threshold AND label = 0) AS tn,
  count(*) FILTER (WHERE score <= threshold AND label = 1) AS fn FROM scored, t GROUP BY half, threshold"""
    ),
    "all_but_label": "SELECT l_orderkey, l_linenumber, l_tax AS f0, l_discount AS f1, l_quantity AS f2 FROM lineitem",
    # Learners on planted classes
    "dt_train_score": _planted(_perfect("decision tree")),
    "rf_train_score": _planted(_perfect("random forest")),
    "lr_train_score": _planted(_perfect("logistic regression", "discount > 0.045", "target IS NOT NULL OR true")),
    "pipeline_rf": f"WITH {_PLANTED_ROWS} " + _perfect("pipeline forest", source="rows", extra="target IS NOT NULL"),
    "one_hot_train_score": _planted(_perfect("one-hot tree", "hot", "true")),
    "cv_metrics": """SELECT CAST(row_number() OVER (ORDER BY params) AS INTEGER) AS rank, params, CAST(1 AS DOUBLE) AS avg_metric, CAST(0 AS DOUBLE) AS std_metric
FROM (SELECT 'impurity=gini, maxBins=' || b || ', maxDepth=' || d AS params FROM (SELECT unnest([42, 70]) AS b), (SELECT unnest([6, 10]) AS d))""",
    "search_best_model": f"""WITH {_PLANTED_ROWS} SELECT 'impurity=gini, maxDepth=2' AS params, CAST(1 AS DOUBLE) AS avg_metric,
  count(*) FILTER (WHERE target = 'O') AS tp, CAST(0 AS BIGINT) AS fp, count(*) FILTER (WHERE target = 'F') AS tn, CAST(0 AS BIGINT) AS fn,
  6 AS preparations_fitted, 16 AS learners_fitted FROM rows WHERE target IS NOT NULL""",
    "lr_coefficients": f"""WITH {_BINARY_ROWS}, c AS (
SELECT CAST(count(*) FILTER (WHERE large AND target = 'O') AS DOUBLE) AS a, CAST(count(*) FILTER (WHERE large AND target = 'F') AS DOUBLE) AS b,
  CAST(count(*) FILTER (WHERE NOT large AND target = 'O') AS DOUBLE) AS c, CAST(count(*) FILTER (WHERE NOT large AND target = 'F') AS DOUBLE) AS d
FROM kept WHERE side = 'train')
SELECT -1 AS position, 'intercept' AS feature, round(ln(c / d), 5) AS coefficient FROM c
UNION ALL SELECT 0, 'large', round(ln(a * d / (b * c)), 5) FROM c""",
    "score_unlabelled": _planted(
        """SELECT CASE target WHEN 'O' THEN 1.0 WHEN 'F' THEN 0.0 END::DOUBLE AS label, large::DOUBLE AS prediction, count(*) AS n,
  sum(large::DOUBLE) AS score FROM kept GROUP BY 1, 2"""
    ),
    "model_roundtrip": _planted(
        """SELECT pipeline, large::DOUBLE AS label, large::DOUBLE AS prediction, count(*) AS n, sum(large::DOUBLE) AS score
FROM kept, (SELECT unnest(['fitted', 'loaded']) AS pipeline) WHERE side = 'test' AND target IS NOT NULL GROUP BY 1, 2, 3"""
    ),
    "roc_curve_exact": _scored(f", {_points('scored', 'price', 0)} {_ROC}"),
    "roc_curve_binned": _scored(f", {_points('scored', 'price', 15)} {_ROC}"),
    "pr_curve": _scored(f", {_points('scored', 'score', 15)} {_PR}"),
    "roc_sink_roundtrip": _scored(f", {_points('scored', 'score', 15)} {_ROC}"),
}
ORACLE = {name: sql.replace(")\n, ", "),\n").replace(")\n\n, ", "),\n") for name, sql in ORACLE.items()}
