"""DuckDB statements returning the same rows as the registered queries; the
driver tables are views named after the tables."""

from __future__ import annotations

from tabmine.plans.bindings import AGE_BRACKETS_SQL, CODED_LINEITEMS_SQL, ENCOUNTERS_SQL

ENC = f"enc AS ({ENCOUNTERS_SQL})"
CODED = f"coded AS ({CODED_LINEITEMS_SQL})"
AGES = f"ages AS ({AGE_BRACKETS_SQL})"

FIRST_BODY = """first AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM enc) WHERE rn = 1)"""
FILTER_BODY = """filtered AS (SELECT * FROM first
  WHERE NOT coalesce(c_nationkey IN (11, 13, 14, 19, 20, 21), false)
    AND c_mktsegment IS DISTINCT FROM 'AUTOMOBILE')"""
FIRST = f"{ENC},\n{FIRST_BODY}"
FILTERED = f"{FIRST},\n{FILTER_BODY}"


def _nzv_sql(source: str, cols: list[str], numeric: set[str] = frozenset(), exempt: bool = False) -> str:
    """A1/A2 in SQL: unpivot -> counts -> top two counts per column."""
    unions = " UNION ALL ".join(
        f"SELECT '{c}' AS col, {i} AS pos, CAST({c} AS VARCHAR) AS v FROM {source}" for i, c in enumerate(cols))
    names = " UNION ALL ".join(f"SELECT '{c}' AS col, {i} AS pos, {'true' if c in numeric else 'false'} AS is_num"
                               for i, c in enumerate(cols))
    below = "var < 0.95::DOUBLE * (1 - 0.95::DOUBLE)"
    if exempt:
        below = f"CASE WHEN is_num AND NOT empty THEN false ELSE {below} END"
    return f"""
long AS ({unions}),
vc AS (SELECT col, v, count(*) AS cnt FROM long WHERE v IS NOT NULL GROUP BY col, v),
ranked AS (SELECT col, cnt, row_number() OVER (PARTITION BY col ORDER BY cnt DESC, v) AS rk FROM vc),
agg AS (SELECT col, count(*) AS n_unique, sum(cnt) AS n,
               max(cnt) AS top, max(CASE WHEN rk = 2 THEN cnt END) AS second FROM ranked GROUP BY col),
names AS ({names}),
m AS (SELECT names.col, pos, is_num, coalesce(n, 0) = 0 AS empty, top, coalesce(second, 0) AS second,
             n_unique, n FROM names LEFT JOIN agg ON names.col = agg.col),
f AS (SELECT *, CASE WHEN empty OR second = 0 THEN NULL ELSE top::DOUBLE / second END AS fr,
             CASE WHEN empty THEN 0.0 ELSE n_unique * 100.0 / n END AS up,
             CASE WHEN empty THEN 1.0 ELSE top::DOUBLE / n END AS p FROM m),
g AS (SELECT *, CASE WHEN empty THEN 0.0 ELSE p * (1 - p) END AS var FROM f),
h AS (SELECT *, CASE WHEN empty THEN true ELSE coalesce(fr > 20, true) AND up < 10 END AS is_nzv,
             CASE WHEN empty THEN true ELSE {below} END AS below FROM g)
SELECT col AS "column", round(fr, 2) AS fr, round(up, 4) AS up, round(var, 6) AS variance,
       round(p, 6) AS dominant_p, {"is_num AS is_numeric, " if exempt else ""}is_nzv,
       below AS below_var_thresh, is_nzv OR below AS "drop"
FROM h ORDER BY pos"""


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["first_encounter"] = f"WITH {FIRST} SELECT * FROM first"

ORACLE_SQL["clean_nzv"] = f"WITH {FILTERED}, " + _nzv_sql("filtered", ["st_price", "st_balance", "st_rush"])

ORACLE_SQL["clean_encounters"] = f"""WITH {FILTERED}
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, coalesce(o_orderpriority, 'Unknown') AS o_orderpriority,
       c_nationkey, c_mktsegment, c_acctbal, st_price, st_balance
FROM filtered"""

ORACLE_SQL["class_balance"] = f"""WITH {FILTERED}
SELECT count(*) AS n_rows, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_pos,
       count(*) - CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_neg,
       round(avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 6) AS positive_rate,
       round(coalesce((count(*) - sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END))::DOUBLE
                      / nullif(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 0), 1.0), 6) AS scale_pos_weight
FROM filtered"""

TAGGED = f"""{ENC},
firsts AS (SELECT o_custkey AS k, min(o_orderkey) AS f FROM enc GROUP BY o_custkey),
t AS (SELECT e.*, coalesce(e.o_orderkey <> firsts.f, false) AS dup,
             coalesce(e.c_nationkey IN (11, 13, 14, 19, 20, 21), false) AS term,
             e.c_mktsegment IS NOT DISTINCT FROM 'AUTOMOBILE' AS inv, n.n_name AS lbl
      FROM enc e JOIN firsts ON e.o_custkey IS NOT DISTINCT FROM firsts.k
      LEFT JOIN nation n ON CAST(e.c_nationkey AS VARCHAR) = CAST(n.n_nationkey AS VARCHAR)),
r AS (SELECT *, CASE WHEN dup THEN 'Duplicate key (keeping first only)'
                     WHEN term THEN 'Terminal code: ' || coalesce(lbl, 'Unknown')
                     WHEN inv THEN 'Invalid value: AUTOMOBILE' END AS del FROM t),
tagged AS (SELECT *, del IS NULL AND o_orderpriority IS NULL AS modified,
                  CASE WHEN del IS NOT NULL THEN 'deleted' WHEN o_orderpriority IS NULL THEN 'modified'
                       ELSE 'kept' END AS status,
                  CASE WHEN del IS NOT NULL THEN del WHEN o_orderpriority IS NULL THEN 'Missing values replaced'
                       ELSE '' END AS reason FROM r)"""

ORACLE_SQL["deletion_audit"] = f"WITH {TAGGED} SELECT o_orderkey, status, reason, modified FROM tagged"

ORACLE_SQL["deletion_stats"] = f"""WITH {TAGGED}
SELECT count(*) AS original_rows, count(*) FILTER (WHERE del IS NOT NULL) AS deleted_rows,
       count(*) FILTER (WHERE dup) AS deleted_duplicates, count(*) FILTER (WHERE term AND NOT dup) AS deleted_terminal,
       count(*) FILTER (WHERE inv AND NOT dup AND NOT term) AS deleted_invalid,
       count(*) FILTER (WHERE modified) AS modified_rows, count(*) FILTER (WHERE del IS NULL) AS kept_rows
FROM tagged"""

ORACLE_SQL["deletion_reasons"] = f"""WITH {TAGGED}
SELECT del AS reason, count(*) AS n_rows FROM tagged WHERE del IS NOT NULL GROUP BY del
ORDER BY n_rows DESC, reason LIMIT 20"""

ORACLE_SQL["audit_sample"] = f"""WITH {TAGGED},
d AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn FROM tagged WHERE del IS NOT NULL),
k AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn FROM tagged WHERE del IS NULL),
nd AS (SELECT count(*) AS n FROM d WHERE rn <= 1000)
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, c_nationkey, c_mktsegment, c_acctbal,
       st_price, st_balance, st_rush, status, reason FROM d WHERE rn <= 1000
UNION ALL
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, c_nationkey, c_mktsegment, c_acctbal,
       st_price, st_balance, st_rush, status, reason FROM k WHERE rn <= 2000 - (SELECT n FROM nd)"""

ORACLE_SQL["cleaned_head"] = f"""WITH {FILTERED}
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice,
       coalesce(o_orderpriority, 'Unknown') AS o_orderpriority, c_nationkey, c_mktsegment,
       round(c_acctbal, 6) AS c_acctbal, st_price, st_balance
FROM filtered ORDER BY o_orderkey LIMIT 2000"""

ORACLE_SQL["drill_down"] = f"""WITH {ENC},
m AS (SELECT * FROM enc WHERE coalesce(CAST(o_orderpriority AS VARCHAR), 'null') = '2-HIGH')
SELECT *, (SELECT count(*) FROM m) AS match_count FROM m ORDER BY o_orderkey LIMIT 100"""

ORACLE_SQL["audit_browser"] = f"""WITH {TAGGED}, {FIRST_BODY}, {FILTER_BODY},
u AS (SELECT o_orderkey, o_orderpriority, c_mktsegment, del AS reason FROM tagged WHERE del IS NOT NULL
      UNION ALL
      SELECT o_orderkey, coalesce(o_orderpriority, 'Unknown'), c_mktsegment, NULL FROM filtered)
SELECT * FROM u WHERE coalesce(CAST(c_mktsegment AS VARCHAR), 'null') = 'BUILDING' ORDER BY o_orderkey LIMIT 100"""

ORACLE_SQL["active_status"] = f"""WITH {ENC}
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target,
       (CASE WHEN st_price IN ('Up', 'Down') THEN 1 ELSE 0 END) + (CASE WHEN st_balance IN ('Up', 'Down') THEN 1 ELSE 0 END)
         + (CASE WHEN st_rush IN ('Up', 'Down') THEN 1 ELSE 0 END) AS n_changed,
       concat_ws(', ', CASE WHEN st_price IS NOT NULL AND st_price <> 'No' THEN 'st_price: ' || st_price END,
                       CASE WHEN st_balance IS NOT NULL AND st_balance <> 'No' THEN 'st_balance: ' || st_balance END,
                       CASE WHEN st_rush IS NOT NULL AND st_rush <> 'No' THEN 'st_rush: ' || st_rush END) AS active_status
FROM enc"""


def icd9_sql(code: str) -> str:
    s = f"regexp_replace({code}, '^\\s+|\\s+$', '', 'g')"
    n = f"TRY_CAST({s} AS DOUBLE)"
    return f"""CASE WHEN {code} IS NULL OR {s} = '' OR lower({s}) IN ('nan', 'unknown') OR {s} LIKE 'V%' OR {s} LIKE 'E%'
         OR NOT regexp_matches({s}, '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$') THEN 'Other'
    WHEN {n} BETWEEN 390 AND 459 OR {n} = 785 THEN 'Circulatory'
    WHEN {n} BETWEEN 460 AND 519 OR {n} = 786 THEN 'Respiratory'
    WHEN {n} BETWEEN 520 AND 579 OR {n} = 787 THEN 'Digestive'
    WHEN floor({n}) = 250 THEN 'Diabetes'
    WHEN {n} BETWEEN 800 AND 999 THEN 'Injury'
    WHEN {n} BETWEEN 710 AND 739 THEN 'Musculoskeletal'
    WHEN {n} BETWEEN 580 AND 629 OR {n} = 788 THEN 'Genitourinary'
    WHEN {n} BETWEEN 140 AND 239 THEN 'Neoplasms' ELSE 'Other' END"""


ORACLE_SQL["diagnosis_groups"] = f"""WITH {CODED}
SELECT l_orderkey, l_linenumber, diag_code, {icd9_sql('diag_code')} AS diag_group FROM coded"""

ORACLE_SQL["age_midpoints"] = f"""WITH {AGES}
SELECT p_partkey, age, CASE age WHEN '[0-10)' THEN 5.0 WHEN '[10-20)' THEN 15.0 WHEN '[20-30)' THEN 25.0
  WHEN '[30-40)' THEN 35.0 WHEN '[40-50)' THEN 45.0 WHEN '[50-60)' THEN 55.0 WHEN '[60-70)' THEN 65.0
  WHEN '[70-80)' THEN 75.0 WHEN '[80-90)' THEN 85.0 WHEN '[90-100)' THEN 95.0 END AS age_mid FROM ages"""


def _stay(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'unknown' WHEN {x} <= 3 THEN '1-3' WHEN {x} <= 6 THEN '4-6' ELSE '7+' END"


def _visit(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'unknown' WHEN {x} <= 0 THEN '0' WHEN {x} = 1 THEN '1' ELSE '2+' END"


ORACLE_SQL["count_buckets"] = f"""SELECT l_orderkey, l_linenumber, {_stay('(l_quantity / 5)')} AS stay_bucket,
  {_visit('(l_linenumber - 1)')} AS visit_bucket, {_visit('(l_discount * 20)')} AS discount_bucket FROM lineitem"""

ORACLE_SQL["code_labels"] = f"""WITH {ENC}
SELECT o_orderkey, c_nationkey, n.n_name AS code_label
FROM enc LEFT JOIN nation n ON CAST(enc.c_nationkey AS VARCHAR) = CAST(n.n_nationkey AS VARCHAR)"""

ORACLE_SQL["prefix_labels"] = """WITH x AS (SELECT lpad(CAST(l_partkey AS VARCHAR), 5, '0') AS x, l_linenumber FROM lineitem),
codes AS (SELECT DISTINCT CASE WHEN l_linenumber > 4 THEN substr(x, 1, 3) || '.' || substr(x, 4, 1)
                               ELSE substr(x, 1, 3) || '.' || substr(x, 4, 2) END AS code FROM x),
d AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 5, '0') AS k, p_name AS l FROM part),
c AS (SELECT code, replace(code, '.', '') AS key FROM codes),
ex AS (SELECT c.code, c.key, d.l FROM c LEFT JOIN d ON c.key = d.k),
pre AS (SELECT ex.key, arg_min(d.l, d.k) AS l FROM (SELECT DISTINCT key FROM ex WHERE l IS NULL) ex
        JOIN d ON starts_with(d.k, ex.key) GROUP BY ex.key)
SELECT ex.code, coalesce(ex.l, pre.l || ' (category)') AS description FROM ex LEFT JOIN pre ON ex.key = pre.key"""

ORACLE_SQL["zscore_bands"] = """WITH s AS (SELECT round(avg(l_extendedprice), 4) AS m, round(stddev_samp(l_extendedprice), 4) AS sd
           FROM lineitem),
z AS (SELECT l_orderkey, l_linenumber, (l_extendedprice - m) / nullif(sd, 0) AS z FROM lineitem, s)
SELECT l_orderkey, l_linenumber, CASE WHEN z > 1 THEN 'high' WHEN z < -1 THEN 'low' END AS band FROM z"""

ORACLE_SQL["itemized_rows"] = f"""WITH {ENC}
SELECT o_orderkey, concat_ws('|', 'o_orderstatus=' || o_orderstatus, 'o_orderpriority=' || o_orderpriority,
  'c_mktsegment=' || c_mktsegment, 'st_price=' || st_price,
  CASE WHEN c_nationkey IS NOT NULL THEN 'c_nationkey=' || {_visit('c_nationkey')} END) AS items FROM enc"""

ORACLE_SQL["run_signatures"] = """SELECT event_id, event_type || '::' || 'k=' || json_extract_string(props, '$.k')
  || '|user=' || CAST(user_id AS VARCHAR) AS signature FROM events"""

LINES_NZV = """lines AS (SELECT *, CASE WHEN l_quantity >= 49 THEN 'Up' ELSE 'No' END AS big_qty FROM lineitem)"""
LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINE_NUMERIC = {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                "l_tax"}

ORACLE_SQL["nzv_lines"] = f"WITH {LINES_NZV}, " + _nzv_sql(
    "lines", ["l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_tax", "l_quantity", "big_qty"])

ORACLE_SQL["nzv_all_columns"] = "WITH " + _nzv_sql("lineitem", LINE_COLS, LINE_NUMERIC, exempt=True)

ORACLE_SQL["nzv_summary"] = """SELECT count(*) AS n_columns, count(*) FILTER (WHERE "drop") AS n_drop,
       count(*) FILTER (WHERE NOT "drop") AS n_keep FROM (WITH """ + _nzv_sql("lineitem", LINE_COLS, LINE_NUMERIC,
                                                                             exempt=True) + ")"

ENC_ALL = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "c_nationkey",
           "c_mktsegment", "c_acctbal", "st_price", "st_balance", "st_rush"]
ENC_NUMERIC = {"o_orderkey", "o_custkey", "o_totalprice", "c_nationkey", "c_acctbal"}

ORACLE_SQL["dataset_overview"] = f"""WITH {ENC},
p AS (SELECT {', '.join(ENC_ALL)} FROM enc),
g AS (SELECT count(*) AS n FROM p GROUP BY {', '.join(ENC_ALL)})
SELECT (SELECT count(*) FROM p) AS total_rows, {len(ENC_ALL)} AS total_cols,
       CAST((SELECT {' + '.join(f'count(*) FILTER (WHERE {c} IS NULL)' for c in ENC_ALL)} FROM p) AS BIGINT)
         AS total_missing_cells,
       CAST((SELECT coalesce(sum(n - 1), 0) FROM g) AS BIGINT) AS duplicate_rows"""


def _missing_sql(cols: list[str], numeric: set[str], source: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS col, {'true' if c in numeric else 'false'} AS is_numeric, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS missing_count, count(*) AS n, count(DISTINCT CAST({c} AS VARCHAR)) AS u "
        f"FROM {source}" for c in cols)
    return f"""SELECT col AS "column", is_numeric, missing_count, round(missing_count * 100.0 / n, 2) AS missing_pct,
       u AS unique_count FROM ({parts})"""


ORACLE_SQL["missing_profile"] = f"WITH {ENC} " + _missing_sql(ENC_ALL, ENC_NUMERIC, "enc")

ORACLE_SQL["column_search"] = f"WITH {ENC}, mp AS ({_missing_sql(ENC_ALL, ENC_NUMERIC, 'enc')}) " \
    "SELECT * FROM mp WHERE contains(lower(\"column\"), 'order')"

NUM_LINE = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORACLE_SQL["numeric_summary"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       round(min({c})::DOUBLE, 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25,
       round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q75,
       round(max({c})::DOUBLE, 6) AS max FROM lineitem""" for c in NUM_LINE)


def _dist_sql(cols: list[str], numeric: set[str], source: str) -> str:
    unions = " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS label, {'true' if c in numeric else 'false'} AS isnum "
        f"FROM {source}" for c in cols)
    return f"""long AS ({unions}),
vc AS (SELECT col, label, isnum, count(*) AS n FROM long WHERE label IS NOT NULL GROUP BY col, label, isnum)
SELECT col AS "column", label, n,
       CAST(row_number() OVER (PARTITION BY col ORDER BY CASE WHEN isnum THEN coalesce(TRY_CAST(label AS DOUBLE),
            'inf'::DOUBLE) ELSE 0.0 END, label) AS INTEGER) AS ord FROM vc"""


ORACLE_SQL["value_distribution"] = f"WITH {ENC}, " + _dist_sql(ENC_ALL, ENC_NUMERIC, "enc")

CLEAN_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "c_nationkey",
              "c_mktsegment", "c_acctbal", "st_price", "st_balance"]
ORACLE_SQL["cleaned_distribution"] = f"""WITH {FILTERED},
cleaned AS (SELECT * REPLACE (coalesce(o_orderpriority, 'Unknown') AS o_orderpriority) FROM filtered), """ + \
    _dist_sql(CLEAN_COLS, ENC_NUMERIC, "cleaned")

ORACLE_SQL["log_scale_hints"] = f"WITH {ENC}, d AS (WITH " + _dist_sql(ENC_ALL, ENC_NUMERIC, "enc") + """)
SELECT "column", max(n) / coalesce(min(n) FILTER (WHERE n > 0), 1) > 50 AS use_log FROM d GROUP BY "column" """


DESCRIPTIONS_SQL = """VALUES
  ('o_orderkey', 'Order key; one row per order (the encounter key).'),
  ('o_custkey', 'Customer key; repeats across a customer''s orders (the patient key).'),
  ('o_orderstatus', 'Order status; ''F'' is the positive class.'),
  ('o_totalprice', 'Total order price.'),
  ('o_orderpriority', 'Order priority; ''4-NOT SPECIFIED'' is read as missing.'),
  ('c_nationkey', 'Customer nation code; labels come from the nation table.'),
  ('c_mktsegment', 'Customer market segment.'),
  ('c_acctbal', 'Customer account balance.')"""

_STATS = " UNION ALL ".join(
    f"""SELECT '{c}' AS col, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       round(min({c})::DOUBLE, 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25,
       round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q75,
       round(max({c})::DOUBLE, 6) AS max FROM enc""" for c in ["o_orderkey", "o_custkey", "o_totalprice", "c_nationkey",
                                                              "c_acctbal"])

ORACLE_SQL["column_profile"] = f"""WITH {ENC}, mp AS ({_missing_sql(ENC_ALL, ENC_NUMERIC, 'enc')}),
st AS ({_STATS}),
descr(col, description) AS ({DESCRIPTIONS_SQL}),
maps AS (SELECT 'c_nationkey' AS col, count(*) AS k FROM nation)
SELECT mp."column", CASE WHEN is_numeric THEN 'Numeric' ELSE 'Categorical' END AS type, missing_count, missing_pct,
  unique_count, st.mean, st.std, st.min, st.q25, st.median, st.q75, st.max,
  CASE WHEN mp."column" = 'o_orderstatus' THEN 'Binarize (Target)'
       WHEN mp."column" IN ('o_orderkey', 'o_custkey') THEN 'Drop'
       WHEN mp."column" = 'o_orderpriority' THEN 'Missing Category'
       WHEN missing_pct > 40 THEN 'Drop' WHEN unique_count = 1 THEN 'Drop'
       WHEN mp."column" = 'c_nationkey' THEN 'Group & Encode'
       WHEN is_numeric AND missing_pct > 0 THEN 'Median Impute'
       WHEN NOT is_numeric AND missing_pct > 0 THEN 'Mode Impute / ''Missing'' Category'
       WHEN NOT is_numeric AND unique_count > 10 THEN 'Target / Frequency Encode'
       WHEN NOT is_numeric THEN 'One-Hot Encode' ELSE 'Scale / Standardize' END AS treatment,
  coalesce(descr.description, 'No detailed description available.') AS description,
  coalesce(maps.k, 0) AS value_mapping_size
FROM mp LEFT JOIN st ON mp."column" = st.col LEFT JOIN descr ON mp."column" = descr.col
LEFT JOIN maps ON mp."column" = maps.col"""

ORACLE_SQL["column_actions"] = f"""WITH {FILTERED}, nz AS (WITH """ + _nzv_sql(
    "filtered", ["st_price", "st_balance", "st_rush"]) + f"""),
cols(col) AS (VALUES {', '.join(f"('{c}')" for c in ENC_ALL)}),
mods(col, why) AS (VALUES ('o_orderpriority', 'Missing token replaced with ''Unknown''.'),
  ('c_nationkey', 'Rows with terminal codes removed.'), ('c_mktsegment', 'Rows with the invalid segment removed.'),
  ('o_orderstatus', 'Target; binarised (''F'' = 1).')),
j AS (SELECT cols.col, nz.fr, coalesce(nz.variance, 0.0) AS var, nz."drop" AS nd, mods.why,
             cols.col IN ('st_price', 'st_balance', 'st_rush') AS is_status
      FROM cols LEFT JOIN nz ON cols.col = nz."column" LEFT JOIN mods ON cols.col = mods.col)
SELECT col AS "column",
  CASE WHEN col = 'o_custkey' THEN 'DROP' WHEN is_status AND coalesce(nd, false) THEN 'DROP' WHEN is_status THEN 'KEEP'
       WHEN why IS NOT NULL THEN 'MODIFY' ELSE 'KEEP' END AS action,
  CASE WHEN col = 'o_custkey' THEN 'an identifier or mostly missing: no feature'
       WHEN is_status AND coalesce(nd, false) THEN 'near-constant: frequency ratio ' || CASE WHEN fr IS NULL OR fr > 999999 THEN '∞'
            ELSE printf('%.1f', fr) END || ', variance ' || printf('%.5f', var) || ', 0.0475 is asked for'
       WHEN is_status THEN 'varies enough: variance ' || printf('%.4f', var)
       WHEN why IS NOT NULL THEN why ELSE 'nothing found' END AS reason
FROM j"""

# ---- encoding and splitting ----------------------------------------------------------------------
from tabmine.plans.bindings import MODEL_SOURCE_SQL, PREDICTIONS_SQL, RUNS_SQL  # noqa: E402

MR_NUM = ["o_totalprice", "c_acctbal", "c_nationkey", "n_changed", "bal_mid"]
MR_CAT = ["o_orderpriority", "c_mktsegment", "st_price"]
SRC = f"{FIRST}, src AS ({MODEL_SOURCE_SQL})"
MR_BODY = (
    "med AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS med_{c}" for c in MR_NUM) + " FROM src),\n"
    "imp AS (SELECT src.*, " + ", ".join(f"coalesce({c}::DOUBLE, med_{c}) AS i_{c}" for c in MR_NUM)
    + " FROM src, med),\n"
    "mom AS (SELECT " + ", ".join(f"avg(i_{c}) AS m_{c}, stddev_pop(i_{c}) AS s_{c}" for c in MR_NUM) + " FROM imp),\n"
    + ",\n".join(f"mode_{c} AS (SELECT CAST({c} AS VARCHAR) AS v FROM src WHERE {c} IS NOT NULL GROUP BY 1 "
                 f"ORDER BY count(*) DESC, 1 LIMIT 1)" for c in MR_CAT) + ",\n"
    "mr AS (" + "\nUNION ALL\n".join(
        [f"SELECT row_id, '{c}' AS feature, CASE WHEN s_{c} > 0 THEN (i_{c} - m_{c}) / s_{c} ELSE 0.0 END AS value "
         f"FROM imp, mom" for c in MR_NUM]
        + [f"SELECT row_id, '{c}_' || coalesce(CAST({c} AS VARCHAR), (SELECT v FROM mode_{c})) AS feature, 1.0 AS value "
           f"FROM src" for c in MR_CAT]) + ")")

ORACLE_SQL["model_ready"] = f"WITH {SRC}, {MR_BODY} SELECT row_id, feature, round(value, 6) AS value FROM mr"

# P5 fitted on the training split, applied to the test split
_EN_NUM = ["o_totalprice", "c_nationkey", "c_acctbal", "bal_bracket", "n_changed"]
_EN_CAT = ["o_orderpriority", "c_mktsegment", "diag_code"]
_EN_STATUS = ["st_price", "st_balance", "st_rush"]


def _encoded(feature_sql: str, level: str, column: str) -> str:
    """One-hot rows of the test split for levels that the training split has."""
    return (f"SELECT o_orderkey, label, {feature_sql} AS feature, 1.0 AS value FROM (SELECT *, coalesce({level}, (SELECT v FROM "
            f"(SELECT {level} AS v, count(*) AS n FROM tr WHERE {level} IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1))) AS lv FROM te) "
            f"WHERE lv IN (SELECT {level} FROM tr)"
            + (f" AND NOT (SELECT \"drop\" FROM nz WHERE \"column\" = '{column}')" if column in _EN_STATUS else ""))


ORACLE_SQL["encoded_test_split"] = f"""WITH {FIRST},
h AS (SELECT *, ('0x' || substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT AS u FROM first),
q AS (SELECT o_orderstatus AS st, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS quota FROM h GROUP BY 1),
s AS (SELECT h.*, row_number() OVER (PARTITION BY o_orderstatus ORDER BY u, o_orderkey) <= quota AS test
      FROM h JOIN q ON o_orderstatus IS NOT DISTINCT FROM st),
src AS (SELECT o_orderkey, test, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label, o_totalprice, c_nationkey, c_acctbal,
    CASE '[' || CAST(floor(c_acctbal / 1000) * 10 AS BIGINT) || '-' || CAST(floor(c_acctbal / 1000) * 10 + 10 AS BIGINT) || ')'
      WHEN '[0-10)' THEN 5.0 WHEN '[10-20)' THEN 15.0 WHEN '[20-30)' THEN 25.0 WHEN '[30-40)' THEN 35.0
      WHEN '[40-50)' THEN 45.0 WHEN '[50-60)' THEN 55.0 WHEN '[60-70)' THEN 65.0 WHEN '[70-80)' THEN 75.0
      WHEN '[80-90)' THEN 85.0 WHEN '[90-100)' THEN 95.0 END AS bal_bracket,
    (CASE WHEN st_price IN ('Up', 'Down') THEN 1 ELSE 0 END) + (CASE WHEN st_balance IN ('Up', 'Down') THEN 1 ELSE 0 END)
      + (CASE WHEN st_rush IN ('Up', 'Down') THEN 1 ELSE 0 END) AS n_changed,
    o_orderpriority, c_mktsegment, {icd9_sql("CAST(o_orderkey % 1000 AS VARCHAR)")} AS diag_code, st_price, st_balance, st_rush FROM s),
tr AS (SELECT * FROM src WHERE NOT test), te AS (SELECT * FROM src WHERE test),
nz AS (WITH """ + _nzv_sql("tr", _EN_STATUS) + """),
med AS (SELECT """ + ", ".join(f"quantile_cont({c}, 0.5) AS med_{c}" for c in _EN_NUM) + """ FROM tr),
mom AS (SELECT """ + ", ".join(f"avg(coalesce({c}::DOUBLE, med_{c})) AS m_{c}, stddev_pop(coalesce({c}::DOUBLE, med_{c})) AS s_{c}" for c in _EN_NUM) \
    + """ FROM tr, med),
enc_rows AS (""" + "\nUNION ALL\n".join(
        [f"SELECT o_orderkey, label, '{c}' AS feature, CASE WHEN s_{c} > 0 THEN (coalesce({c}::DOUBLE, med_{c}) - m_{c}) / s_{c} ELSE 0.0 END AS value "
         f"FROM te, med, mom" for c in _EN_NUM] + [_encoded(f"'{c}_' || lv", c, c) for c in _EN_CAT + _EN_STATUS]) + """)
SELECT o_orderkey, label, feature, round(value, 6) AS value FROM enc_rows"""

ORACLE_SQL["encoded_groups"] = f"WITH {SRC} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_encoded FROM src" for c in MR_CAT)

ORACLE_SQL["model_ready_summary"] = f"""WITH {SRC}
SELECT count(*) AS model_ready_rows,
       CAST(1 + {len(MR_NUM)} + {' + '.join(f'(SELECT count(DISTINCT {c}) FROM src)' for c in MR_CAT)} AS BIGINT)
         AS model_ready_columns,
       round(avg(target), 6) AS positive_class_rate, '{",".join(MR_NUM)}' AS numeric_columns,
       '{",".join(MR_CAT)}' AS categorical_columns FROM src"""

_MM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORACLE_SQL["minmax_scaled"] = "WITH s AS (SELECT " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _MM) \
    + " FROM lineitem) SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"round(CASE WHEN hi_{c} <> lo_{c} THEN ({c} - lo_{c}) / (hi_{c} - lo_{c}) ELSE 0.0 END, 6) AS {c}"
        for c in _MM) + " FROM lineitem, s"


def _u(key: str, seed: int) -> str:
    return f"('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT"


ORACLE_SQL["stratified_split"] = f"""WITH {ENC},
r AS (SELECT o_orderkey, o_orderstatus, {_u('o_orderkey', 42)} AS h FROM enc),
q AS (SELECT o_orderstatus, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS quota FROM r GROUP BY 1),
k AS (SELECT r.*, row_number() OVER (PARTITION BY r.o_orderstatus ORDER BY h, o_orderkey) AS rk FROM r)
SELECT o_orderkey, k.o_orderstatus, CASE WHEN rk <= quota THEN 'test' ELSE 'train' END AS split
FROM k JOIN q ON k.o_orderstatus = q.o_orderstatus"""

ORACLE_SQL["stratified_sample"] = f"""WITH {ENC},
r AS (SELECT o_orderkey, o_orderstatus, {_u('o_orderkey', 101)} AS h FROM enc),
c AS (SELECT o_orderstatus, count(*) AS cnt FROM r GROUP BY 1),
e AS (SELECT *, cnt * 1800 / sum(cnt) OVER () AS ex FROM c),
b AS (SELECT *, CAST(floor(ex) AS BIGINT) AS base, ex - floor(ex) AS rem FROM e),
a AS (SELECT *, 1800 - sum(base) OVER () AS left_n, row_number() OVER (ORDER BY rem DESC, o_orderstatus) AS rk FROM b),
q AS (SELECT o_orderstatus, base + CASE WHEN rk <= left_n THEN 1 ELSE 0 END AS quota FROM a),
k AS (SELECT r.*, row_number() OVER (PARTITION BY r.o_orderstatus ORDER BY h, o_orderkey) AS rn FROM r)
SELECT o_orderkey, k.o_orderstatus FROM k JOIN q ON k.o_orderstatus = q.o_orderstatus WHERE rn <= quota"""

ORACLE_SQL["uniform_sample"] = f"""WITH {ENC}
SELECT o_orderkey, o_orderstatus FROM enc ORDER BY {_u('o_orderkey', 42)}, o_orderkey LIMIT 5000"""

# ---- evaluation ------------------------------------------------------------------------------------
PRED = f"pred AS ({PREDICTIONS_SQL})"
CM = """cm AS (SELECT model, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
                   count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp,
                   count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn,
                   count(*) FILTER (WHERE label <> 1 AND prediction <> 1) AS tn FROM pred GROUP BY model)"""
GS = """g AS (SELECT model, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
      FROM pred GROUP BY model, score)"""
AUC = f"""{GS},
ga AS (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum_neg FROM g),
auc AS (SELECT model, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
          THEN sum(pos * (cum_neg - neg + neg / 2.0)) / (sum(pos) * sum(neg)) END AS roc_auc FROM ga GROUP BY model)"""


def _sd(a: str, b: str) -> str:
    return f"coalesce(({a})::DOUBLE / nullif({b}, 0), 0.0)"


ORACLE_SQL["prediction_metrics"] = f"""WITH {PRED}, {CM}, {AUC}
SELECT cm.model, round({_sd('tp + tn', 'tp + fp + fn + tn')}, 6) AS accuracy, round({_sd('tp', 'tp + fp')}, 6) AS precision,
       round({_sd('tp', 'tp + fn')}, 6) AS recall, round({_sd('2 * tp', '2 * tp + fp + fn')}, 6) AS f1,
       round(roc_auc, 6) AS roc_auc
FROM cm LEFT JOIN auc ON cm.model = auc.model"""

ORACLE_SQL["confusion_matrix"] = f"""WITH {PRED},
cells(actual, predicted) AS (VALUES (0, 0), (0, 1), (1, 0), (1, 1)),
m AS (SELECT DISTINCT model FROM pred),
c AS (SELECT model, label AS actual, prediction AS predicted, count(*) AS n FROM pred GROUP BY ALL)
SELECT m.model, cells.actual, cells.predicted, coalesce(c.n, 0) AS n
FROM m CROSS JOIN cells LEFT JOIN c ON c.model = m.model AND c.actual = cells.actual AND c.predicted = cells.predicted"""

ORACLE_SQL["roc_curve"] = f"""WITH {PRED}, {GS},
c AS (SELECT model, score, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps, row_number() OVER w AS idx
      FROM g WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
t AS (SELECT model, max(tps) AS p, max(fps) AS n, max(idx) AS last FROM c GROUP BY model),
j AS (SELECT c.*, t.p, t.n, t.last,
             lag(tps) OVER (PARTITION BY c.model ORDER BY idx) AS tp_prev, lag(fps) OVER (PARTITION BY c.model ORDER BY idx) AS fp_prev,
             lead(tps) OVER (PARTITION BY c.model ORDER BY idx) AS tp_next, lead(fps) OVER (PARTITION BY c.model ORDER BY idx) AS fp_next
      FROM c JOIN t ON c.model = t.model)
SELECT model, CAST(0 AS BIGINT) AS idx, CAST(NULL AS DOUBLE) AS threshold, CASE WHEN n > 0 THEN 0.0 END AS fpr,
       CASE WHEN p > 0 THEN 0.0 END AS tpr FROM t
UNION ALL
SELECT model, idx, round(score, 6), round(fps::DOUBLE / nullif(n, 0), 6), round(tps::DOUBLE / nullif(p, 0), 6) FROM j
WHERE idx = 1 OR idx = last OR (fp_next - 2 * fps + fp_prev) <> 0 OR (tp_next - 2 * tps + tp_prev) <> 0"""

ORACLE_SQL["mcnemar_test"] = f"""WITH {PRED},
a AS (SELECT row_id, label, prediction AS pa FROM pred WHERE model = 'discount'),
b AS (SELECT row_id, prediction AS pb FROM pred WHERE model = 'tax'),
bc AS (SELECT count(*) FILTER (WHERE pa = label AND pb <> label) AS b1,
              count(*) FILTER (WHERE pa <> label AND pb = label) AS c1 FROM a JOIN b ON a.row_id = b.row_id),
k AS (SELECT b1, c1, b1 + c1 AS n, least(b1, c1) AS k FROM bc),
p AS (SELECT CASE WHEN n = 0 OR 2 * k = n THEN 1.0 ELSE least(1.0, 2 * (
        SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + n * ln(0.5))) FROM range(0, k + 1) r(i)))
      END AS p FROM k)
SELECT 'discount' AS best_model, 'tax' AS competitor, b1 AS best_only_correct, c1 AS competitor_only_correct,
       n AS discordant_pairs, round(p, 6) AS exact_p_value, p < 0.05 AS significant FROM k, p"""

RUNS = f"runs AS ({RUNS_SQL})"
HIST = f"""{RUNS},
latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY algorithm, signature
           ORDER BY ts DESC, event_id DESC) AS rn FROM runs) WHERE rn = 1),
hist AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY algorithm ORDER BY ts DESC, event_id DESC) AS rank
         FROM latest) WHERE rank <= 12)"""

ORACLE_SQL["run_history"] = f"WITH {HIST} SELECT algorithm, signature, event_id, round(value, 6) AS value, rank FROM hist"

ORACLE_SQL["run_store"] = ORACLE_SQL["run_history"]

ORACLE_SQL["run_selection"] = f"""WITH {HIST},
live AS (SELECT algorithm, signature, value, 'live' AS source FROM hist),
ref AS (SELECT algorithm, signature, avg(value) AS value, 'reference' AS source FROM runs GROUP BY algorithm, signature),
merged AS (SELECT * FROM live UNION ALL SELECT * FROM ref WHERE NOT EXISTS (
             SELECT 1 FROM live WHERE live.algorithm = ref.algorithm AND live.signature = ref.signature)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY algorithm ORDER BY (signature = 'click::k=1') DESC,
             coalesce(value, 0.0) DESC, signature DESC) AS rn FROM merged)
SELECT algorithm, signature, round(value, 6) AS value, source FROM ranked WHERE rn = 1"""

# ---- association rules -----------------------------------------------------------------------------
from tabmine.plans.bindings import BASKETS_SQL  # noqa: E402

FI = f"""{ENC}, b AS (SELECT DISTINCT tid, item FROM ({BASKETS_SQL})),
tot AS (SELECT count(*)::DOUBLE AS n FROM enc),
l1 AS (SELECT [item] AS items, count(*) AS cnt FROM b GROUP BY item),
l2 AS (SELECT [x.item, y.item] AS items, count(*) AS cnt FROM b x JOIN b y ON x.tid = y.tid AND x.item < y.item
       GROUP BY x.item, y.item),
l3 AS (SELECT [x.item, y.item, z.item] AS items, count(*) AS cnt FROM b x JOIN b y ON x.tid = y.tid AND x.item < y.item
       JOIN b z ON y.tid = z.tid AND y.item < z.item GROUP BY x.item, y.item, z.item),
fi AS (SELECT items, len(items) AS n_items, cnt, cnt / n AS support
       FROM (SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3), tot WHERE cnt / n >= 0.08)"""

ORACLE_SQL["frequent_itemsets"] = f"""WITH {FI}
SELECT array_to_string(items, '|') AS items, n_items, cnt AS count, round(support, 6) AS support FROM fi"""

ORACLE_SQL["itemset_report"] = f"""WITH {FI}
SELECT array_to_string(items, '|') AS items, n_items, cnt AS count, round(support, 6) AS support FROM fi
ORDER BY n_items DESC, support DESC, items LIMIT 50"""

RULES = f"""{FI},
splits AS (
  SELECT items, cnt, support, [items[1]] AS a, [items[2]] AS c FROM fi WHERE n_items = 2
  UNION ALL SELECT items, cnt, support, [items[2]], [items[1]] FROM fi WHERE n_items = 2
  UNION ALL SELECT items, cnt, support, [items[1]], [items[2], items[3]] FROM fi WHERE n_items = 3
  UNION ALL SELECT items, cnt, support, [items[2]], [items[1], items[3]] FROM fi WHERE n_items = 3
  UNION ALL SELECT items, cnt, support, [items[3]], [items[1], items[2]] FROM fi WHERE n_items = 3
  UNION ALL SELECT items, cnt, support, [items[1], items[2]], [items[3]] FROM fi WHERE n_items = 3
  UNION ALL SELECT items, cnt, support, [items[1], items[3]], [items[2]] FROM fi WHERE n_items = 3
  UNION ALL SELECT items, cnt, support, [items[2], items[3]], [items[1]] FROM fi WHERE n_items = 3),
rules AS (SELECT s.a AS antecedent, s.c AS consequent, s.support, s.cnt / fa.cnt AS confidence,
                 (s.cnt / fa.cnt) / fc.support AS lift, s.cnt AS count
          FROM splits s JOIN fi fa ON fa.items = s.a JOIN fi fc ON fc.items = s.c
          WHERE s.cnt / fa.cnt >= 0.6)"""

ORACLE_SQL["association_rules"] = f"""WITH {RULES}
SELECT array_to_string(antecedent, '|') AS antecedent, array_to_string(consequent, '|') AS consequent,
       round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift, count FROM rules"""

ORACLE_SQL["rules_report"] = f"""WITH {RULES}
SELECT array_to_string(antecedent, '|') AS antecedent, array_to_string(consequent, '|') AS consequent,
       round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift, count FROM rules
ORDER BY lift DESC, confidence DESC, support DESC, antecedent, consequent LIMIT 25"""

# ---- feature scoring ----------------------------------------------------------------------------------
SCORES = f"""{SRC}, {MR_BODY},
lab AS (SELECT row_id, target AS label FROM src),
classes AS (SELECT label, count(*) AS n_c FROM lab GROUP BY label),
tot AS (SELECT sum(n_c) AS N FROM classes),
j AS (SELECT mr.*, lab.label FROM mr JOIN lab ON mr.row_id = lab.row_id),
fc AS (SELECT feature, label, count(*) AS cnt_c, sum(value) AS s_c FROM j GROUP BY feature, label),
fx AS (SELECT feature, count(*) AS cnt, min(value) AS min_p, max(value) AS max_p FROM mr GROUP BY feature),
feat AS (SELECT feature, cnt, N, CASE WHEN cnt < N THEN least(min_p, 0.0) ELSE min_p END AS lo,
                CASE WHEN cnt < N THEN greatest(max_p, 0.0) ELSE max_p END AS hi FROM fx, tot),
grid AS (SELECT feat.*, classes.label, classes.n_c, coalesce(fc.cnt_c, 0) AS cnt_c, coalesce(fc.s_c, 0.0) AS s_c
         FROM feat CROSS JOIN classes LEFT JOIN fc ON fc.feature = feat.feature AND fc.label = classes.label),
o AS (SELECT *, CASE WHEN hi - lo > 0 THEN (s_c - n_c * lo) / (hi - lo) ELSE 0.0 END AS O FROM grid),
e AS (SELECT *, n_c / N * sum(O) OVER (PARTITION BY feature) AS E FROM o),
chi AS (SELECT feature, CASE WHEN count(*) FILTER (WHERE E > 0) = count(*)
          THEN sum(CASE WHEN E > 0 THEN (O - E) ^ 2 / E END) ELSE 0.0 END AS score FROM e GROUP BY feature),
binned AS (SELECT j.feature, j.label, CASE WHEN hi - lo > 0 THEN least(floor(round((value - lo) / (hi - lo) * 10, 9)), 9) ELSE 0 END AS b
           FROM j JOIN feat ON j.feature = feat.feature),
present AS (SELECT feature, label, b, count(*) AS n_bc FROM binned GROUP BY ALL),
absent AS (SELECT feature, label, CASE WHEN hi - lo > 0 THEN least(floor(round((0.0 - lo) / (hi - lo) * 10, 9)), 9) ELSE 0 END AS b,
                  n_c - cnt_c AS n_bc FROM grid WHERE n_c - cnt_c > 0),
cells AS (SELECT feature, label, b, sum(n_bc) AS n_bc FROM (SELECT * FROM present UNION ALL SELECT * FROM absent) GROUP BY ALL),
nb AS (SELECT feature, b, sum(n_bc) AS n_b FROM cells GROUP BY ALL),
mi AS (SELECT cells.feature, coalesce(sum(n_bc / N * ln(n_bc * N / (n_b * n_c))), 0.0) AS score
       FROM cells JOIN nb ON cells.feature = nb.feature AND cells.b = nb.b JOIN classes ON cells.label = classes.label, tot
       GROUP BY cells.feature),
scores AS (SELECT 'mutual_information' AS method, feature, score FROM mi
           UNION ALL SELECT 'chi_square', feature, score FROM chi),
top AS (SELECT * FROM (SELECT method, CAST(row_number() OVER (PARTITION BY method ORDER BY score DESC, feature) AS INTEGER)
          AS rank, feature, round(score, 6) AS score FROM scores) WHERE rank <= 20)"""

ORACLE_SQL["feature_scores"] = f"WITH {SCORES} SELECT * FROM top"

ORACLE_SQL["feature_summary"] = f"""WITH {SCORES}
SELECT method, arg_min(feature, rank) AS best_feature, arg_min(score, rank) AS best_score,
       string_agg(feature, ', ' ORDER BY rank) FILTER (WHERE rank <= 5) AS top_features FROM top GROUP BY method"""

# ---- Gaussian naive Bayes on the split (M6) ------------------------------------------------------
NB = f"""{SRC}, {MR_BODY},
sp AS (SELECT row_id, target, {_u('row_id', 42)} AS h FROM src),
q AS (SELECT target, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS quota FROM sp GROUP BY 1),
rk AS (SELECT sp.row_id, sp.target, row_number() OVER (PARTITION BY sp.target ORDER BY h, row_id) AS r FROM sp),
split AS (SELECT rk.row_id, rk.target AS label, CASE WHEN r <= quota THEN 'test' ELSE 'train' END AS part
          FROM rk JOIN q ON rk.target = q.target),
lg AS (SELECT mr.row_id, split.label, split.part, mr.feature, mr.value FROM mr JOIN split ON mr.row_id = split.row_id),
tr AS (SELECT * FROM lg WHERE part = 'train'), te AS (SELECT * FROM lg WHERE part = 'test'),
cls AS (SELECT label, count(DISTINCT row_id) AS n_c FROM tr GROUP BY label),
tot AS (SELECT sum(n_c) AS N FROM cls),
feats AS (SELECT DISTINCT feature FROM tr),
sums AS (SELECT label, feature, sum(value) AS s1, sum(value * value) AS s2 FROM tr GROUP BY label, feature),
nbg AS (SELECT cls.label, feats.feature, cls.n_c, tot.N, coalesce(s1, 0.0) AS s1, coalesce(s2, 0.0) AS s2
      FROM feats CROSS JOIN cls CROSS JOIN tot LEFT JOIN sums ON sums.label = cls.label AND sums.feature = feats.feature),
nbg2 AS (SELECT *, s1 / n_c AS mu, greatest(s2 / n_c - (s1 / n_c) ^ 2, 0.0) AS var FROM nbg),
ov AS (SELECT feature, sum(s1) AS t1, sum(s2) AS t2, any_value(N) AS N FROM nbg GROUP BY feature),
eps AS (SELECT max(t2 / N - (t1 / N) ^ 2) * 1e-9 AS e FROM ov),
par AS (SELECT label, feature, mu, var + e AS v, n_c, N FROM nbg2, eps),
base AS (SELECT label, ln(any_value(n_c) / any_value(N)) - 0.5 * sum(ln(2 * pi() * v)) - 0.5 * sum(mu * mu / v) AS b
         FROM par GROUP BY label),
corr AS (SELECT te.row_id, par.label, sum((mu * mu - (value - mu) ^ 2) / (2 * v)) AS c
         FROM te JOIN par ON te.feature = par.feature GROUP BY te.row_id, par.label),
rows_ AS (SELECT DISTINCT row_id, label AS y FROM te),
nbper AS (SELECT rows_.row_id, rows_.y, base.label, base.b + coalesce(corr.c, 0.0) AS jll
        FROM rows_ CROSS JOIN base LEFT JOIN corr ON corr.row_id = rows_.row_id AND corr.label = base.label),
mx AS (SELECT row_id, max(jll) AS m FROM nbper GROUP BY row_id),
pe AS (SELECT nbper.*, exp(jll - m) AS e FROM nbper JOIN mx ON nbper.row_id = mx.row_id),
pred AS (SELECT row_id, 'Naive Bayes' AS model, y AS label,
                round(sum(CASE WHEN label = 1 THEN e ELSE 0.0 END) / sum(e), 10) AS score,
                arg_max(label, (jll, -label)) AS prediction FROM pe GROUP BY row_id, y)"""

ORACLE_SQL["naive_bayes"] = f"""WITH {NB}, {CM}, {AUC}
SELECT cm.model, round({_sd('tp + tn', 'tp + fp + fn + tn')}, 6) AS accuracy, round({_sd('tp', 'tp + fp')}, 6) AS precision,
       round({_sd('tp', 'tp + fn')}, 6) AS recall, round({_sd('2 * tp', '2 * tp + fp + fn')}, 6) AS f1,
       round(roc_auc, 6) AS roc_auc
FROM cm LEFT JOIN auc ON cm.model = auc.model"""

# K5: all pairs
ORACLE_SQL["class_silhouette"] = """WITH e AS (
  SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, label FROM embeddings
), p AS (
  SELECT vec_id, x, y, 'label' AS run, label AS l FROM e UNION ALL SELECT vec_id, x, y, 'label % 2', label % 2 FROM e
), n AS (SELECT run, l, count(*) AS c FROM p GROUP BY ALL),
d AS (
  SELECT a.run, a.vec_id, a.l, b.l AS other, sum(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) AS s
  FROM p a JOIN p b ON a.run = b.run GROUP BY ALL
), m AS (
  SELECT d.run, vec_id, max(CASE WHEN other = d.l THEN s / nullif(c - 1, 0) END) AS a, min(CASE WHEN other <> d.l THEN s / c END) AS b
  FROM d JOIN n ON n.run = d.run AND n.l = d.other GROUP BY ALL
)
SELECT run, round(avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM m GROUP BY run"""

# A15 as one nested document
_SAMPLE_COLS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "c_nationkey", "c_mktsegment", "c_acctbal", "st_price", "st_balance",
                "st_rush", "status", "reason"]


def _section(name: str, cols: list[str], order: str | None) -> str:
    packed = "struct_pack(" + ", ".join(f'"{c}" := "{c}"' for c in cols) + ")"
    value = f"to_json(list({packed} ORDER BY {order}))" if order else f"to_json(any_value({packed}))"
    return f"""(SELECT '"{name}":' || CAST({value} AS VARCHAR) FROM ({ORACLE_SQL[{"stats": "deletion_stats", "deletion_reasons": "deletion_reasons",
        "column_actions": "column_actions", "sample": "audit_sample"}[name]]}))"""


ORACLE_SQL["cleaning_report"] = "SELECT '{' || " + " || ',' || ".join([
    _section("stats", ["original_rows", "deleted_rows", "deleted_duplicates", "deleted_terminal", "deleted_invalid", "modified_rows", "kept_rows"], None),
    _section("deletion_reasons", ["reason", "n_rows"], "n_rows DESC, reason"),
    _section("column_actions", ["column", "action", "reason"], '"column"'),
    _section("sample", _SAMPLE_COLS, "status <> 'deleted', o_orderkey")]) + " || '}' AS document"

# M5: all pairs
ORACLE_SQL["knn_classes"] = f"""WITH h AS (
  SELECT vec_id, label, list_transform(embedding[1:3], lambda v: CAST(v AS DOUBLE)) AS e, {_u('vec_id', 42)} AS u FROM embeddings
), q AS (SELECT label, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS quota FROM h GROUP BY 1),
s AS (SELECT h.*, row_number() OVER (PARTITION BY h.label ORDER BY u, vec_id) <= quota AS test FROM h JOIN q ON h.label = q.label),
p AS (
  SELECT a.vec_id AS row_id, a.label % 2 AS label, b.vec_id AS other, b.label % 2 AS vote, list_distance(a.e, b.e) AS d,
    row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.e, b.e), b.vec_id) AS r
  FROM s a JOIN s b ON a.test AND NOT b.test
)
SELECT row_id, label, round(avg(vote), 6) AS score, CAST(avg(vote) > 0.5 AS INTEGER) AS prediction,
  max(CASE WHEN r = 1 THEN other END) AS nearest, round(max(d), 6) AS kth_distance
FROM p WHERE r <= 7 GROUP BY row_id, label"""

ORACLE_SQL["runs_by_metric"] = f"""WITH {HIST}
SELECT algorithm, signature, round(value, 6) AS value,
  row_number() OVER (PARTITION BY algorithm ORDER BY coalesce(value, 0.0) DESC, signature) AS rank FROM hist"""

ORACLE_SQL["runs_by_params"] = f"""WITH {HIST},
m AS (SELECT *, signature LIKE '%::k=1' AS matched FROM hist),
o AS (SELECT *, row_number() OVER (PARTITION BY algorithm ORDER BY matched DESC, coalesce(value, 0.0) DESC, signature DESC) AS rn FROM m)
SELECT algorithm, signature, round(value, 6) AS value, matched FROM o WHERE rn = 1"""

# The exact split by hash
ORACLE_SQL["split_balance"] = f"""WITH {SRC},
h AS (SELECT row_id, target, {_u('row_id', 42)} AS u FROM src),
q AS (SELECT target, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS quota FROM h GROUP BY 1),
s AS (SELECT h.target AS label, row_number() OVER (PARTITION BY h.target ORDER BY u, row_id) <= quota AS test FROM h JOIN q ON h.target = q.target),
n AS (SELECT CASE WHEN test THEN 'test' ELSE 'train' END AS split, label, count(*) AS n_rows FROM s GROUP BY ALL)
SELECT split, label, n_rows, round(n_rows / sum(n_rows) OVER (PARTITION BY split), 6) AS share FROM n"""

# K4: neighbours by all pairs, core points joined by reach, border points by their lowest cluster
ORACLE_SQL["dbscan_clusters"] = """WITH RECURSIVE p AS (
  SELECT vec_id AS i, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings
), near AS (
  SELECT a.i, b.i AS j FROM p a JOIN p b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.02::DOUBLE * 0.02::DOUBLE
), core AS (SELECT i FROM near GROUP BY i HAVING count(*) >= 5),
link AS (SELECT near.i, near.j FROM near JOIN core a ON a.i = near.i JOIN core b ON b.i = near.j),
reach AS (SELECT i, i AS top FROM core UNION SELECT l.j, r.top FROM reach r JOIN link l ON l.i = r.i),
comp AS (SELECT i, min(top) AS comp FROM reach GROUP BY i),
border AS (SELECT n.i, min(c.comp) AS comp FROM near n JOIN comp c ON c.i = n.j GROUP BY n.i),
lab AS (SELECT p.i, coalesce(comp.comp, border.comp) AS comp FROM p LEFT JOIN comp ON comp.i = p.i LEFT JOIN border ON border.i = p.i),
num AS (SELECT comp, row_number() OVER (ORDER BY comp) - 1 AS label FROM (SELECT DISTINCT comp FROM lab WHERE comp IS NOT NULL))
SELECT lab.i AS vec_id, CAST(coalesce(label, -1) AS INTEGER) AS cluster FROM lab LEFT JOIN num ON num.comp = lab.comp"""
