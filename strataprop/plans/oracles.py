"""DuckDB SQL that states the expected result of each query over the same tables."""

from __future__ import annotations

PROFILE = """
SELECT o_orderkey AS id, o_custkey AS cust_id, o_orderpriority AS priority,
       {price} AS total_price
FROM orders"""
PRICE = "o_totalprice"
PRICE_WITH_NULLS = "CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END"

PERFORMANCE = """
SELECT l_orderkey AS id, CAST(count(*) AS BIGINT) AS n_lines,
       round(sum(l_quantity), 2) AS sum_qty, round(avg(l_discount), 6) AS avg_discount,
       max(l_extendedprice) AS max_price
FROM lineitem GROUP BY l_orderkey"""

DIMENSION = """
SELECT c_custkey AS cust_id, c_mktsegment AS segment, c_acctbal AS acctbal,
       c_nationkey AS nation_id, n_regionkey AS region_id
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

TARGET = """
SELECT o_orderkey AS id, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS label
FROM orders"""


def _hash(key: str) -> str:
    """First 32 bits of the md5 of seed and key, compared with 0.7 of their range."""
    digest = f"substring(md5(concat('123:', CAST({key} AS VARCHAR))), 1, 8)"
    return f"CAST('0x' || {digest} AS BIGINT) < 0.7 * 4294967296"


def _features(nulls: bool = False) -> str:
    price = PRICE_WITH_NULLS if nulls else PRICE
    return f"""
profile AS ({PROFILE.format(price=price)}),
performance AS ({PERFORMANCE}),
dimension AS ({DIMENSION}),
target AS ({TARGET}),
features AS (
  SELECT p.id, p.cust_id, p.priority, p.total_price, f.n_lines, f.sum_qty, f.avg_discount,
         f.max_price, d.segment, d.acctbal, d.nation_id, d.region_id, t.label
  FROM profile p
  LEFT JOIN performance f ON p.id = f.id
  LEFT JOIN dimension d ON p.cust_id = d.cust_id
  LEFT JOIN target t ON p.id = t.id)"""


SPLIT = f"""
target AS ({TARGET}),
split AS (SELECT id, label, CASE WHEN {_hash('id')} THEN 'train' ELSE 'val' END AS split
          FROM target)"""

REPEATED_NATIONS = """
nations AS (
  SELECT n_nationkey AS nation_id, n_name, 1 AS version FROM nation
  UNION ALL
  SELECT n_nationkey, n_name, 2 FROM nation WHERE n_nationkey = 1)"""

SUPPLIERS = """
suppliers AS (
  SELECT s_suppkey, CASE WHEN s_suppkey % 9 > 0 THEN s_nationkey END AS nation_id FROM supplier)"""

SPARSE_NATIONS = f"""{SUPPLIERS},
sellers AS (SELECT s_suppkey, nation_id * 2 AS nation_id FROM suppliers),
buyers AS (SELECT c_custkey, c_nationkey * 3 AS nation_id FROM customer)"""

FEATURE_NAMES = ("id", "cust_id", "priority", "total_price", "n_lines", "sum_qty", "avg_discount", "max_price",
                 "segment", "acctbal", "nation_id", "region_id", "label")

# One fitted value per column, or per column and stratum, from the rows of `fit`.
FITTED = """
by_priority AS (SELECT priority, round(avg(total_price)) AS v FROM fit
                WHERE priority IS NOT NULL GROUP BY priority),
by_region AS (SELECT region_id, round(avg(sum_qty)) AS v FROM fit
              WHERE region_id IS NOT NULL GROUP BY region_id),
by_segment AS (SELECT segment, avg(avg_discount) AS v, quantile_disc(max_price, 0.5) AS m
               FROM fit WHERE segment IS NOT NULL GROUP BY segment),
overall AS (SELECT avg(n_lines) AS v FROM fit)"""

SPLIT_FEATURES = f"""
rows AS (SELECT *, CASE WHEN {_hash('id')} THEN 'train' ELSE 'val' END AS split FROM features),
fit AS (SELECT * FROM rows WHERE split = 'train')"""

FILLED = """
SELECT r.id, r.split, r.label,
       coalesce(r.total_price, p.v) AS total_price, coalesce(r.sum_qty, g.v) AS sum_qty,
       coalesce(CAST(r.n_lines AS DOUBLE), o.v) AS n_lines,
       coalesce(r.avg_discount, s.v) AS avg_discount, coalesce(r.max_price, s.m) AS max_price
FROM rows r
LEFT JOIN by_priority p ON r.priority = p.priority
LEFT JOIN by_region g ON r.region_id = g.region_id
LEFT JOIN by_segment s ON r.segment = s.segment
CROSS JOIN overall o"""


def _impute(value: str, stratified: bool) -> str:
    profile = PROFILE.format(price=PRICE_WITH_NULLS)
    group, join = ("GROUP BY priority", "p.priority = v.priority") if stratified else ("", "true")
    key = "priority, " if stratified else ""
    return f"""
WITH profile AS ({profile}), v AS (SELECT {key}{value} AS v FROM profile {group})
SELECT p.id, p.priority, round(coalesce(p.total_price, v.v), 4) AS total_price
FROM profile p LEFT JOIN v ON {join}"""


def _metrics(source: str, group: str | None = None) -> str:
    lead = f"{group}, " if group else ""
    tail = f"GROUP BY {group}" if group else ""
    return f"""
counts AS (
  SELECT {lead}CAST(count(*) AS BIGINT) AS n,
         CAST(count(*) FILTER (y_true = 1 AND y_pred = 1) AS BIGINT) AS tp,
         CAST(count(*) FILTER (y_true = 0 AND y_pred = 1) AS BIGINT) AS fp,
         CAST(count(*) FILTER (y_true = 1 AND y_pred = 0) AS BIGINT) AS fn,
         CAST(count(*) FILTER (y_true = 0 AND y_pred = 0) AS BIGINT) AS tn
  FROM {source} {tail}),
metrics AS (
  SELECT {lead}tp, fp, fn, tn, n - tp - fp - fn - tn AS n_ungraded,
         round(coalesce((tp + tn)::DOUBLE / nullif(tp + fp + fn + tn, 0), 0), 6) AS accuracy,
         round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS precision,
         round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 6) AS recall,
         round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
  FROM counts)"""


def _box(rows: str, group: str) -> str:
    """Quartiles, whiskers and outliers of column v of `rows` per column g."""
    return f"""
rows AS ({rows}),
boxes AS (
  SELECT g, CAST(count(v) AS BIGINT) AS n, min(v) AS lo, max(v) AS hi,
         quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3
  FROM rows GROUP BY g),
fenced AS (
  SELECT b.*, r.v,
         r.v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
  FROM boxes b JOIN rows r ON b.g = r.g)
SELECT {group} n, round(lo, 4) AS min, round(q1, 4) AS q1, round(q2, 4) AS median,
       round(q3, 4) AS q3, round(hi, 4) AS max,
       round(min(v) FILTER (inside), 4) AS lower_whisker,
       round(max(v) FILTER (inside), 4) AS upper_whisker,
       CAST(count(v) FILTER (NOT inside) AS BIGINT) AS n_outliers
FROM fenced GROUP BY g, n, lo, hi, q1, q2, q3"""


CORRELATED = ("total_price", "n_lines", "sum_qty", "max_price", "acctbal")


def _correlations() -> str:
    kept = " AND ".join(f"{c} IS NOT NULL" for c in CORRELATED)
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS col_i, '{b}' AS col_j, round(corr({a}, {b}), 6) AS corr FROM kept"
        for a in CORRELATED for b in CORRELATED)
    return f"WITH {_features()}, kept AS (SELECT * FROM features WHERE {kept}) {pairs}"


def _wide_correlations() -> str:
    made = [f"total_price * {k} + id % {k + 2} * 1000 AS x{k}" for k in range(11)]
    names = [*CORRELATED, *[f"x{k}" for k in range(11)], "constant"]
    kept = " AND ".join(f"{c} IS NOT NULL" for c in CORRELATED)

    def cell(a: str, b: str) -> str:
        corr = "CAST(NULL AS DOUBLE)" if "constant" in (a, b) else f"round(corr({a}, {b}), 6)"
        return f"SELECT '{a}' AS col_i, '{b}' AS col_j, {corr} AS corr FROM kept"

    pairs = " UNION ALL ".join(cell(a, b) for a in names for b in names)
    return (f"WITH {_features()}, kept AS (SELECT *, {', '.join(made)} FROM features WHERE {kept}) "
            f"SELECT DISTINCT * FROM ({pairs})")


HASH_PART = _hash("id")
DATE_PART = "day(o_orderdate) <= 20"
LONG_METRICS = """
SELECT sample, 'accuracy' AS metric, accuracy AS value FROM metrics
UNION ALL SELECT sample, 'precision', precision FROM metrics
UNION ALL SELECT sample, 'recall', recall FROM metrics
UNION ALL SELECT sample, 'f1', f1 FROM metrics"""


def _by_level(in_training: str) -> str:
    """Rows with their split, and each level's share of positives among the training rows."""
    return f"""
target AS ({TARGET}),
rows AS (
  SELECT id, label, o_orderpriority AS priority,
         CASE WHEN {in_training} THEN 'train' ELSE 'val' END AS split
  FROM target JOIN orders ON o_orderkey = id),
shares AS (SELECT priority, avg(label) AS share FROM rows WHERE split = 'train' GROUP BY priority)"""


LINE_SCORES = """
scores AS (
  SELECT *, 1 / (1 + exp(-(0.04 * l_quantity - 9.0 * l_discount
         - 0.6 * CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE -1 END - 0.2))) AS p
  FROM lineitem)"""

LEVELS = """
levels AS (
  SELECT o_orderpriority AS level, CAST(count(*) AS BIGINT) AS n,
         CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS BIGINT) AS index
  FROM orders GROUP BY o_orderpriority)"""

CHI_SQUARE = f"""
WITH target AS ({TARGET}),
cells AS (
  SELECT o_orderpriority AS a, label AS b, count(*) AS o
  FROM orders JOIN target ON o_orderkey = id GROUP BY 1, 2),
a AS (SELECT a, sum(o) AS t FROM cells GROUP BY a),
b AS (SELECT b, sum(o) AS t FROM cells GROUP BY b),
total AS (SELECT sum(o)::DOUBLE AS n FROM cells),
filled AS (
  SELECT coalesce(c.o, 0)::DOUBLE AS o, a.t::DOUBLE * b.t / n AS e
  FROM a CROSS JOIN b CROSS JOIN total LEFT JOIN cells c ON c.a = a.a AND c.b = b.b),
test AS (
  SELECT sum((o - e) ^ 2 / e) AS x,
         CAST(((SELECT count(*) FROM a) - 1) * ((SELECT count(*) FROM b) - 1) AS BIGINT) AS dof
  FROM filled)
-- With 4 degrees of freedom the upper tail has this closed form.
SELECT round(x, 6) AS statistic, dof,
       round(CASE dof WHEN 4 THEN exp(-x / 2) * (1 + x / 2) END, 6) AS p_value
FROM test"""

UNIT_PRICES = ("SELECT l_returnflag AS g, l_extendedprice / l_quantity / l_quantity AS v "
               "FROM lineitem")
ALL_PRICES = f"SELECT 0 AS g, {PRICE_WITH_NULLS} AS v FROM orders"

ORACLES = {
    "scan_table": "SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders",
    "delimited_dimension": DIMENSION,
    "feature_table": f"WITH {_features()} SELECT * FROM features",
    "feature_table_no_target": f"WITH {_features()} SELECT * EXCLUDE (label) FROM features",
    "join_composite_key": """
WITH supplied AS (
  SELECT l_partkey, l_suppkey, CAST(count(*) AS BIGINT) AS pair_lines,
         round(sum(l_quantity), 2) AS pair_qty
  FROM lineitem GROUP BY l_partkey, l_suppkey)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, s.pair_lines, s.pair_qty
FROM lineitem l LEFT JOIN supplied s ON l.l_partkey = s.l_partkey AND l.l_suppkey = s.l_suppkey""",
    "join_duplicate_dimension": f"""
WITH {REPEATED_NATIONS}
SELECT c_custkey, nation_id, n_name, version
FROM customer LEFT JOIN nations ON c_nationkey = nation_id""",
    "join_first_of_duplicates": f"""
WITH {REPEATED_NATIONS}, newest AS (
  SELECT * FROM nations
  QUALIFY row_number() OVER (PARTITION BY nation_id ORDER BY version DESC) = 1)
SELECT c_custkey, nation_id, n_name, version
FROM customer LEFT JOIN newest ON c_nationkey = nation_id""",
    "join_semi": f"""
WITH profile AS ({PROFILE.format(price=PRICE)})
SELECT * FROM profile WHERE id IN (SELECT l_orderkey FROM lineitem)""",
    "join_hot_left": """
SELECT l_orderkey, l_linenumber, l_suppkey AS supp_id, s_name
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""",
    "join_hot_right": """
SELECT n_nationkey AS nation_id, n_name, c_custkey
FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey""",
    "join_hot_both": f"""
WITH {SUPPLIERS}
SELECT s.nation_id, s_suppkey, c_custkey
FROM suppliers s LEFT JOIN customer ON s.nation_id = c_nationkey""",
    "join_right": f"""
WITH {SPARSE_NATIONS}
SELECT b.nation_id, s_suppkey, c_custkey FROM sellers s RIGHT JOIN buyers b ON s.nation_id = b.nation_id""",
    "join_full": f"""
WITH {SPARSE_NATIONS}
SELECT coalesce(s.nation_id, b.nation_id) AS nation_id, s_suppkey, c_custkey
FROM sellers s FULL JOIN buyers b ON s.nation_id = b.nation_id""",
    "join_bucketed": f"""
WITH profile AS ({PROFILE.format(price=PRICE)}), performance AS ({PERFORMANCE}), target AS ({TARGET})
SELECT p.*, n_lines, sum_qty, avg_discount, max_price, label
FROM profile p LEFT JOIN performance f ON p.id = f.id LEFT JOIN target t ON p.id = t.id""",
    "merged_medians": f"""
WITH profile AS ({PROFILE.format(price=PRICE_WITH_NULLS)})
SELECT priority, CAST(count(total_price) AS BIGINT) AS n, round(avg(total_price), 4) AS mean, 0.5::DOUBLE AS rank_share
FROM profile GROUP BY priority""",
    "null_checks": f"WITH {_features(nulls=True)} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS holes FROM features" for c in FEATURE_NAMES),
    "impute_global_mean": _impute("avg(total_price)", False),
    "impute_global_median": _impute("quantile_disc(total_price, 0.5)", False),
    "impute_stratified_mean": _impute("round(avg(total_price))", True),
    "impute_stratified_median": _impute("quantile_disc(total_price, 0.5)", True),
    "impute_given_values": f"""
WITH profile AS ({PROFILE.format(price=PRICE_WITH_NULLS)})
SELECT id, priority,
       coalesce(total_price, CASE priority WHEN '1-URGENT' THEN 100.0::DOUBLE
                                           WHEN '5-LOW' THEN 50.0::DOUBLE END) AS total_price
FROM profile""",
    "median_sketch_error": f"""
WITH profile AS ({PROFILE.format(price=PRICE_WITH_NULLS)})
SELECT priority, CAST(count(total_price) AS BIGINT) AS n,
       round(quantile_disc(total_price, 0.5), 4) AS median
FROM profile GROUP BY priority""",
    "impute_global_sketch": _impute("quantile_disc(total_price, 0.5)", False),
    "impute_unknown_stratum": f"""
WITH profile AS ({PROFILE.format(price=PRICE_WITH_NULLS)}),
fit AS (SELECT * FROM profile WHERE priority <> '1-URGENT'),
v AS (SELECT priority, round(avg(total_price)) AS v FROM fit GROUP BY priority)
SELECT id, p.priority, round(coalesce(total_price, v.v,
       (SELECT round(avg(total_price)) FROM fit)), 4) AS total_price
FROM profile p LEFT JOIN v ON p.priority = v.priority""",
    "quantiles_narrow": """
SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n,
       round(quantile_disc(l_extendedprice, 0.1), 4) AS q10,
       round(quantile_disc(l_extendedprice, 0.5), 4) AS q50,
       round(quantile_disc(l_extendedprice, 0.9), 4) AS q90
FROM lineitem GROUP BY l_returnflag""",
    "imputation_params": f"""
WITH {_features(nulls=True)}, fit AS (SELECT * FROM features), {FITTED}
SELECT 'total_price' AS "column", 'mean' AS method, 'priority' AS stratum_column,
       'string' AS stratum_type, priority AS stratum_value, round(v, 4) AS value FROM by_priority
UNION ALL SELECT 'sum_qty', 'mean', 'region_id', 'int', CAST(region_id AS VARCHAR), round(v, 4)
FROM by_region
UNION ALL SELECT 'n_lines', 'mean', NULL, NULL, NULL, round(v, 4) FROM overall
UNION ALL SELECT 'avg_discount', 'mean', 'segment', 'string', segment, round(v, 4) FROM by_segment
UNION ALL SELECT 'max_price', 'median', 'segment', 'string', segment, round(m, 4)
FROM by_segment""",
    "impute_out_of_sample": f"""
WITH {_features(nulls=True)}, {SPLIT_FEATURES}, {FITTED}, filled AS ({FILLED})
SELECT id, split, round(total_price, 6) AS total_price, round(sum_qty, 6) AS sum_qty,
       round(n_lines, 6) AS n_lines, round(avg_discount, 6) AS avg_discount,
       round(max_price, 6) AS max_price
FROM filled""",
    "split_hash": f"WITH {SPLIT} SELECT id, label, split FROM split",
    "split_validation_anti": f"""
WITH {SPLIT}
SELECT id, label FROM target WHERE id NOT IN (SELECT id FROM split WHERE split = 'train')""",
    "split_validation_filtered": f"""
WITH {SPLIT}
SELECT id, label FROM target WHERE id NOT IN (SELECT id FROM split WHERE split = 'train')""",
    "split_union": f"""
WITH {SPLIT} SELECT id, label, 'train' AS sample FROM split WHERE split = 'train'
UNION ALL SELECT id, label, 'val' FROM split WHERE split = 'val'""",
    "split_counts": f"""
WITH {SPLIT} SELECT split, label, CAST(count(*) AS BIGINT) AS n FROM split GROUP BY split, label""",
    "split_bernoulli_counts": f"""
WITH target AS ({TARGET})
SELECT label, CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS in_both,
       CAST(0.7 AS DOUBLE) AS share
FROM target GROUP BY label""",
    "contingency": """
SELECT o_orderpriority, o_orderstatus, CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY o_orderpriority, o_orderstatus""",
    "chi_square": CHI_SQUARE,
    "correlation_matrix": _correlations(),
    "correlation_matrix_wide": _wide_correlations(),
    "correlation_pairwise": f"WITH {_features(nulls=True)} " + " UNION ALL ".join(
        f"SELECT '{a}' AS col_i, '{b}' AS col_j, round(corr({a}, {b}), 6) AS corr FROM features"
        for a in CORRELATED for b in CORRELATED),
    "box_stats": f"WITH {_box(UNIT_PRICES, 'g AS l_returnflag,')}",
    "box_stats_overall": f"WITH {_box(ALL_PRICES, '')}",
    "bin_2d": """
SELECT CAST(floor(l_quantity / 5) AS BIGINT) AS x_bin,
       CAST(floor(l_extendedprice / 10000) AS BIGINT) AS y_bin, l_returnflag,
       CAST(count(*) AS BIGINT) AS n
FROM lineitem GROUP BY 1, 2, 3""",
    "category_index": f"WITH {LEVELS} SELECT level, n, index FROM levels",
    "one_hot": f"""
WITH {LEVELS}
SELECT o_orderkey AS id, o_totalprice AS total_price,
       CAST(index = 0 AS INTEGER)::DOUBLE AS level_0,
       CAST(index = 1 AS INTEGER)::DOUBLE AS level_1,
       CAST(index = 2 AS INTEGER)::DOUBLE AS level_2,
       CAST(index = 3 AS INTEGER)::DOUBLE AS level_3
FROM orders JOIN levels ON o_orderpriority = level""",
    "one_hot_table": f"""
WITH {LEVELS}
SELECT o_orderkey AS id, o_totalprice AS total_price,
       CAST(index = 0 AS INTEGER)::DOUBLE AS level_0,
       CAST(index = 1 AS INTEGER)::DOUBLE AS level_1,
       CAST(index = 2 AS INTEGER)::DOUBLE AS level_2,
       CAST(index = 3 AS INTEGER)::DOUBLE AS level_3
FROM orders JOIN levels ON o_orderpriority = level""",
    "target_means_before": f"""
WITH target AS ({TARGET}),
rows AS (
  SELECT id, label, o_custkey AS cust_id, o_orderpriority AS priority,
         CAST('0x' || substring(md5(concat('123:', CAST(id AS VARCHAR))), 1, 8) AS BIGINT) AS place
  FROM target JOIN orders ON o_orderkey = id)
SELECT id, round((coalesce(sum(label) OVER c, 0) + 0.5) / (count(label) OVER c + 2), 9) AS by_customer,
       round((coalesce(sum(label) OVER p, 0) + 0.5) / (count(label) OVER p + 2), 9) AS by_priority
FROM rows
WINDOW c AS (PARTITION BY cust_id ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
       p AS (PARTITION BY priority ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "table_score_by_level": f"""
WITH {_by_level(HASH_PART)}
SELECT id, priority, round(share, 3) AS share FROM rows JOIN shares USING (priority)""",
    "train_sampled_copies": f"""
WITH {_by_level('TRUE')}, copied AS (
  SELECT rows.*, share FROM rows JOIN shares USING (priority)),
graded AS (
  SELECT 'train_sample' AS sample, label AS y_true, CASE WHEN share >= 0.33 THEN 1 ELSE 0 END AS y_pred
  FROM copied), {_metrics('graded', 'sample')} {LONG_METRICS}""",
    "scored_batches_written": """
SELECT o_orderkey % 3 AS batch, CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) FILTER (WHERE o_orderkey % 3 = 1) AS BIGINT) AS rerun
FROM orders GROUP BY 1""",
    "logistic_calibration": f"""
WITH {_features()}, {SPLIT_FEATURES}
SELECT segment, CAST(count(*) AS BIGINT) AS n, CAST(sum(label) AS BIGINT) AS positives,
       round(avg(label), 2) AS share
FROM fit GROUP BY segment""",
    "train_metrics_by_level": f"""
WITH {_by_level(HASH_PART)}, graded AS (
  SELECT split || '_sample' AS sample, label AS y_true,
         CASE WHEN share >= 0.5 THEN 1 ELSE 0 END AS y_pred
  FROM rows JOIN shares USING (priority)), {_metrics('graded', 'sample')} {LONG_METRICS}""",
    "train_given_split": f"""
WITH {_by_level(DATE_PART)}, graded AS (
  SELECT split || '_sample' AS sample, label AS y_true,
         CASE WHEN share >= 0.5 THEN 1 ELSE 0 END AS y_pred
  FROM rows JOIN shares USING (priority)), {_metrics('graded', 'sample')} {LONG_METRICS}""",
    "pipeline_score_by_level": f"""
WITH {_by_level(HASH_PART)}
SELECT id, priority, round(share, 3) AS share FROM rows JOIN shares USING (priority)""",
    "gbt_one_tree": f"""
WITH {_by_level(HASH_PART)}
SELECT id, priority, round(1 / (1 + exp(-2 * (2 * share - 1))), 4) AS probability
FROM rows JOIN shares USING (priority)""",
    "scored_rows_written": f"""
WITH {_by_level(HASH_PART)}
SELECT priority, CAST(count(*) AS BIGINT) AS n, round(avg(share), 3) AS share
FROM rows JOIN shares USING (priority) GROUP BY priority""",
    "python_model_score": f"""
WITH {LINE_SCORES}
SELECT l_orderkey, l_linenumber, round(1 - p, 6) AS Probs_0, round(p, 6) AS Probs_1
FROM scores""",
    "threshold_metrics": f"""
WITH {LINE_SCORES}, graded AS (
  SELECT l_linestatus, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y_true,
         CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS y_pred
  FROM scores), {_metrics('graded', 'l_linestatus')}
SELECT * FROM metrics""",
    "binary_metrics": f"""
WITH graded AS (SELECT quality AS y_true, toxic AS y_pred FROM labels), {_metrics('graded')}
SELECT * FROM metrics""",
    "metrics_by_sample": f"""
WITH {_features()}, {SPLIT_FEATURES}, graded AS (
  SELECT split || '_sample' AS sample, label AS y_true,
         CASE WHEN coalesce(sum_qty, 0) >= 100 THEN 1 ELSE 0 END AS y_pred
  FROM rows), {_metrics('graded', 'sample')}
SELECT sample, 'accuracy' AS metric, accuracy AS value FROM metrics
UNION ALL SELECT sample, 'precision', precision FROM metrics
UNION ALL SELECT sample, 'recall', recall FROM metrics
UNION ALL SELECT sample, 'f1', f1 FROM metrics""",
    "flagship": f"""
WITH {_features(nulls=True)}, {SPLIT_FEATURES}, {FITTED}, filled AS ({FILLED})
SELECT split, label, CAST(count(*) AS BIGINT) AS n,
       CAST(count(total_price) AS BIGINT) AS n_price,
       CAST(count(max_price) AS BIGINT) AS n_max_price,
       round(avg(total_price), 2) AS avg_price, round(avg(n_lines), 4) AS avg_lines
FROM filled GROUP BY split, label""",
}
