"""Registered source, integrity-check and cleaning queries (S, P, C rows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import month_start, parse_mixed_date
from ..operators import quality
from ..sources import star
from ..sources.tables import read_table
from .oracle import with_prelude
from .registry import register

FACT_INT_COLUMNS = ["fact_id", "customer_id", "plan_id", "date_key", "seats", "support_tickets"]


@register("s1_master_join", with_prelude("SELECT * FROM master_raw"))
def s1_master_join(spark, sf_dir):
    """S1 + J1 + P1: the flat star join over raw (un-deduplicated) facts."""
    return star.master(spark, sf_dir, dedupe=False)


@register("s8_month_start", with_prelude("""
SELECT DISTINCT date_key, make_date(date_key // 100, date_key % 100, 1) AS month_start
FROM fact_raw"""))
def s8_month_start(spark, sf_dir):
    f = star.fact(spark, sf_dir, dedupe=False, with_plan=False)
    return f.select("date_key").distinct().select("date_key", month_start("date_key").alias("month_start"))


@register("s10_month_dim", with_prelude("""
SELECT DISTINCT m.date_key, month_name, month_num, quarter, year, is_quarter_end
FROM (SELECT DISTINCT date_key FROM fact_raw) m,
LATERAL (SELECT
      strftime(make_date(cast(m.date_key // 100 as integer), cast(m.date_key % 100 as integer), 1), '%B')
        AS month_name,
      cast(m.date_key % 100 as integer) AS month_num,
      cast((m.date_key % 100 - 1) // 3 + 1 as integer) AS quarter,
      cast(m.date_key // 100 as integer) AS year,
      cast(m.date_key % 100 in (3, 6, 9, 12) as integer) AS is_quarter_end)"""))
def s10_month_dim(spark, sf_dir):
    f = star.fact(spark, sf_dir, dedupe=False, with_plan=False)
    cols = [c for c in star.date_columns("date_key") if "month_start" not in str(c)]
    return f.select("date_key").distinct().select("date_key", *cols)


@register("s9_enforce_ints", with_prelude("""
SELECT "column", count(*) AS rows, count(v) AS non_null,
       count(*) FILTER (WHERE v IS NOT NULL AND TRY_CAST(v AS BIGINT) IS NULL) AS coerced_to_null
FROM s9_src UNPIVOT INCLUDE NULLS
      (v FOR "column" IN (fact_id, customer_id, plan_id, date_key, seats, support_tickets))
GROUP BY "column\"""", [("s9_src", """SELECT cast(fact_id as varchar) AS fact_id,
      cast(customer_id as varchar) AS customer_id, cast(plan_id as varchar) AS plan_id,
      CASE WHEN fact_id % 131 = 7 THEN '199x' ELSE cast(date_key as varchar) END AS date_key,
      CASE WHEN fact_id % 97 = 11 THEN 'n/a' ELSE cast(seats as varchar) END AS seats,
      cast(support_tickets as varchar) AS support_tickets FROM fact_raw""")]))
def s9_enforce_ints(spark, sf_dir):
    """Coerce declared integer columns from text; unparseable → null, counted.

    Some rows get text that is no number, so that the check has what to find."""
    f = star.fact(spark, sf_dir, dedupe=False, with_plan=False)
    text = f.select(*[F.col(c).cast("string").alias(c) for c in FACT_INT_COLUMNS]).withColumns({
        "date_key": F.when(F.col("fact_id").cast("long") % 131 == 7, F.lit("199x")).otherwise(F.col("date_key")),
        "seats": F.when(F.col("fact_id").cast("long") % 97 == 11, F.lit("n/a")).otherwise(F.col("seats"))})
    long = text.unpivot([], FACT_INT_COLUMNS, "column", "v")
    coerced = F.expr("try_cast(v AS BIGINT)")
    return long.groupBy("column").agg(
        F.count("*").alias("rows"), F.count("v").alias("non_null"),
        F.count_if(F.col("v").isNotNull() & coerced.isNull()).alias("coerced_to_null"))


@register("p2_null_region", with_prelude("""
SELECT count(*) AS customers_with_no_region FROM dim_customer WHERE region_id IS NULL"""))
def p2_null_region(spark, sf_dir):
    c = star.dim_customer(spark, sf_dir)
    return c.where(F.col("region_id").isNull()).agg(F.count("*").alias("customers_with_no_region"))


@register("p4_listwise_drop", with_prelude("""
SELECT count(*) AS rows_in,
       count(*) FILTER (WHERE usage_events IS NOT NULL AND nps_score IS NOT NULL) AS rows_kept,
       count(*) FILTER (WHERE usage_events IS NULL OR nps_score IS NULL) AS rows_dropped
FROM clean"""))
def p4_listwise_drop(spark, sf_dir):
    """Listwise deletion on a named subset; the dropped count comes from the
    same aggregate (no second scan)."""
    c = quality.clean(spark, sf_dir, label=False)
    subset = ["usage_events", "nps_score"]
    complete = reduce(lambda a, b: a & b, [F.col(s).isNotNull() for s in subset])
    return c.agg(F.count("*").alias("rows_in"), F.count_if(complete).alias("rows_kept"),
                 F.count_if(~complete).alias("rows_dropped"))


@register("p6_pk_unique", with_prelude("""
SELECT 'dim_customer' AS table_name, count(*) FILTER (WHERE n > 1) AS duplicated_keys
  FROM (SELECT customer_id, count(*) AS n FROM dim_customer GROUP BY customer_id)
UNION ALL SELECT 'dim_plan', count(*) FILTER (WHERE n > 1)
  FROM (SELECT plan_id, count(*) AS n FROM dim_plan GROUP BY plan_id)
UNION ALL SELECT 'dim_region', count(*) FILTER (WHERE n > 1)
  FROM (SELECT region_id, count(*) AS n FROM dim_region GROUP BY region_id)
UNION ALL SELECT 'dim_rep', count(*) FILTER (WHERE n > 1)
  FROM (SELECT rep_id, count(*) AS n FROM dim_rep GROUP BY rep_id)
UNION ALL SELECT 'fact', count(*) FILTER (WHERE n > 1)
  FROM (SELECT fact_id, count(*) AS n FROM fact_raw GROUP BY fact_id)"""))
def p6_pk_unique(spark, sf_dir):
    """Keys appearing more than once per table (fact shown, not asserted)."""
    tables = {
        "dim_customer": (star.dim_customer(spark, sf_dir), "customer_id"),
        "dim_plan": (star.dim_plan(spark, sf_dir), "plan_id"),
        "dim_region": (star.dim_region(spark, sf_dir), "region_id"),
        "dim_rep": (star.dim_rep(spark, sf_dir), "rep_id"),
        "fact": (star.fact(spark, sf_dir, dedupe=False, with_plan=False), "fact_id"),
    }
    parts = [df.groupBy(k).count().agg(F.count_if(F.col("count") > 1).alias("duplicated_keys"))
               .select(F.lit(name).alias("table_name"), "duplicated_keys")
             for name, (df, k) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


@register("p7_fk_resolve", with_prelude("""
SELECT 'orders.customer_id' AS check_name,
       (SELECT count(*) FROM orders ANTI JOIN customer ON o_custkey = c_custkey) AS violations
UNION ALL SELECT 'lines.order_id',
       (SELECT count(*) FROM lineitem ANTI JOIN orders ON l_orderkey = o_orderkey)
UNION ALL SELECT 'lines.plan_id',
       (SELECT count(*) FROM (SELECT CASE WHEN (l_orderkey * 10 + l_linenumber) % 211 = 9 THEN -1
                                     ELSE l_partkey END AS plan_id FROM lineitem) l
        ANTI JOIN part ON plan_id = p_partkey)
UNION ALL SELECT 'orders.date_key',
       (SELECT count(*) FROM (SELECT CASE WHEN o_orderkey % 307 = 1 THEN 13
                                     ELSE month(o_orderdate) END AS m FROM orders)
        WHERE m IS NULL OR m NOT BETWEEN 1 AND 12)
UNION ALL SELECT 'dim_customer.rep_id',
       (SELECT count(*) FROM dim_customer c ANTI JOIN dim_rep r USING (rep_id))
UNION ALL SELECT 'dim_customer.region_id is null',
       (SELECT count(*) FROM dim_customer WHERE region_id IS NULL)"""))
def p7_fk_resolve(spark, sf_dir):
    """Foreign-key resolution by anti joins, plus null region keys.

    Keys are checked as they stand in the raw tables, before any inner join
    could hide a broken one; some plan and month keys are broken on purpose."""
    line = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"])
    line = line.withColumn("plan_id", F.when(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")) % 211 == 9, F.lit(-1)).otherwise(
            F.col("l_partkey")))
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    month = F.when(F.col("o_orderkey") % 307 == 1, F.lit(13)).otherwise(F.month("o_orderdate"))
    c = star.dim_customer(spark, sf_dir)
    p = star.dim_plan(spark, sf_dir)
    rep = star.dim_rep(spark, sf_dir)
    checks = [
        ("orders.customer_id", orders.join(c, orders["o_custkey"] == c["customer_id"], "left_anti")),
        ("lines.order_id", line.join(orders, line["l_orderkey"] == orders["o_orderkey"], "left_anti")),
        ("lines.plan_id", line.join(p, "plan_id", "left_anti")),
        ("orders.date_key", orders.where(~F.coalesce(month.between(1, 12), F.lit(False)))),
        ("dim_customer.rep_id", c.join(rep, "rep_id", "left_anti")),
        ("dim_customer.region_id is null", c.where(F.col("region_id").isNull())),
    ]
    parts = [df.agg(F.count("*").alias("violations")).select(F.lit(n).alias("check_name"), "violations")
             for n, df in checks]
    return reduce(DataFrame.unionByName, parts)


@register("p8_integer_check", with_prelude("""
SELECT "column", count(*) FILTER (WHERE v IS NOT NULL AND v % 1 <> 0) AS fractional_rows
FROM p8_src UNPIVOT INCLUDE NULLS
      (v FOR "column" IN (fact_id, customer_id, plan_id, date_key, seats, support_tickets))
GROUP BY "column\"""", [("p8_src", """SELECT cast(fact_id as double) AS fact_id,
      cast(customer_id as double) AS customer_id, cast(plan_id as double) AS plan_id,
      cast(date_key as double) AS date_key,
      cast(seats as double) + CASE WHEN fact_id % 89 = 3 THEN 0.5 ELSE 0 END AS seats,
      cast(support_tickets as double) AS support_tickets FROM fact_raw""")]))
def p8_integer_check(spark, sf_dir):
    """Rows whose declared integer isn't whole; half a seat is put into some rows."""
    f = star.fact(spark, sf_dir, dedupe=False, with_plan=False).withColumn(
        "seats", F.col("seats") + F.when(F.col("fact_id") % 89 == 3, 0.5).otherwise(0.0))
    long = f.select(*[F.col(c).cast("double").alias(c) for c in FACT_INT_COLUMNS]) \
            .unpivot([], FACT_INT_COLUMNS, "column", "v")
    return long.groupBy("column").agg(
        F.count_if(F.col("v").isNotNull() & (F.col("v") % 1 != 0)).alias("fractional_rows"))


@register("p11_baseline_coverage", with_prelude("""
SELECT (SELECT count(DISTINCT customer_id) FROM dim_customer) AS customers,
       (SELECT count(DISTINCT customer_id) FROM fact
         WHERE period_key IN (SELECT DISTINCT period_key FROM fact ORDER BY period_key LIMIT 2))
         AS with_baseline,
       (SELECT count(*) FROM dim_customer c ANTI JOIN (SELECT DISTINCT customer_id FROM fact
         WHERE period_key IN (SELECT DISTINCT period_key FROM fact ORDER BY period_key LIMIT 2)) b
         USING (customer_id)) AS uncovered"""))
def p11_baseline_coverage(spark, sf_dir):
    """Customers with rows in the baseline window vs all customers."""
    from ..operators.churn import baseline_periods
    f = quality.dedup_panel(spark, sf_dir)
    c = star.dim_customer(spark, sf_dir).select("customer_id")
    base = f.where(F.col("period_key").isin(baseline_periods(f))).select("customer_id").distinct()
    total = c.agg(F.countDistinct("customer_id").alias("customers"))
    cov = base.agg(F.count("*").alias("with_baseline"))
    unc = c.join(base, "customer_id", "left_anti").agg(F.count("*").alias("uncovered"))
    return total.crossJoin(cov).crossJoin(unc)


@register("c1_dedupe", with_prelude("SELECT * FROM fact"))
def c1_dedupe(spark, sf_dir):
    """One row per fact_id, the first by the line tie-break order."""
    return star.fact(spark, sf_dir, dedupe=True)


@register("c2_c3_usage_impute", with_prelude("""
SELECT count(*) FILTER (WHERE usage_events IS NULL) AS blank_usage,
       count(*) FILTER (WHERE usage_events < 0) AS negative_usage,
       round((SELECT med FROM clean_params), 6) AS median_usage,
       round(sum(coalesce(CASE WHEN usage_events < 0 THEN NULL ELSE usage_events END,
                          (SELECT med FROM clean_params))), 2) AS filled_usage_total
FROM master"""))
def c2_c3_usage_impute(spark, sf_dir):
    """C2 + C3: blanks and negatives counted before repair (audit columns),
    both filled with the median taken after negatives are nulled."""
    c = quality.clean(spark, sf_dir, label=False)
    params = quality.session_clean_params(spark, sf_dir)
    return c.agg(
        F.count_if(F.col("usage_events_raw").isNull()).alias("blank_usage"),
        F.count_if(F.col("usage_events_raw") < 0).alias("negative_usage"),
        F.round(F.lit(params.median_usage), 6).alias("median_usage"),
        F.round(F.sum("usage_events_filled"), 2).alias("filled_usage_total"))


@register("c4_discount_repair", with_prelude("""
SELECT count(*) FILTER (WHERE discount_pct > 1.0) AS rows_over,
       round(max(CASE WHEN discount_pct > 1.0 THEN discount_pct - 1.0 ELSE discount_pct END), 6)
         AS max_after,
       round(sum(CASE WHEN discount_pct > 1.0 THEN discount_pct - 1.0 ELSE discount_pct END), 6)
         AS sum_after
FROM master"""))
def c4_discount_repair(spark, sf_dir):
    c = quality.clean(spark, sf_dir, label=False)
    return c.agg(F.count_if(F.col("discount_pct_raw") > 1.0).alias("rows_over"),
                 F.round(F.max("discount_pct"), 6).alias("max_after"),
                 F.round(F.sum("discount_pct"), 6).alias("sum_after"))


@register("c5_industry_unknown", with_prelude("""
SELECT industry, count(DISTINCT customer_id) AS customers FROM clean GROUP BY industry"""))
def c5_industry_unknown(spark, sf_dir):
    c = quality.clean(spark, sf_dir, label=False)
    return c.groupBy("industry").agg(F.countDistinct("customer_id").alias("customers"))


@register("c6_region_mode", with_prelude("""
SELECT region_name, count(DISTINCT customer_id) AS customers,
       count(*) FILTER (WHERE country = 'Unknown') AS rows_country_unknown,
       (SELECT modal FROM clean_params) AS modal_region
FROM clean GROUP BY region_name"""))
def c6_region_mode(spark, sf_dir):
    c = quality.clean(spark, sf_dir, label=False)
    params = quality.session_clean_params(spark, sf_dir)
    per = c.groupBy("customer_id", "region_name").agg(
        F.count_if(F.col("country") == "Unknown").alias("u"))
    return per.groupBy("region_name").agg(
        F.count("*").alias("customers"), F.sum("u").alias("rows_country_unknown"),
    ).withColumn("modal_region", F.lit(params.modal_region))


@register("c7_date_formats", with_prelude("""
SELECT customer_id, signup_date,
  CASE WHEN regexp_matches(signup_date, '^\\d{4}-\\d{2}-\\d{2}$')
         THEN try_strptime(signup_date, '%Y-%m-%d')::date
       WHEN regexp_matches(signup_date, '^\\d{2}/\\d{2}/\\d{4}$')
         THEN try_strptime(signup_date, '%d/%m/%Y')::date END AS signup_date_parsed,
  regexp_matches(signup_date, '^\\d{2}/\\d{2}/\\d{4}$') AS was_day_first
FROM dim_customer"""))
def c7_date_formats(spark, sf_dir):
    c = star.dim_customer(spark, sf_dir)
    return c.select("customer_id", "signup_date",
                    parse_mixed_date(F.col("signup_date")).alias("signup_date_parsed"),
                    F.col("signup_date").rlike(quality.SLASH_DATE).alias("was_day_first"))


@register("c8_rep_valid", with_prelude("""
SELECT c.customer_id, c.rep_id, r.hire_date,
  NOT coalesce(CASE WHEN regexp_matches(c.signup_date, '^\\d{4}-\\d{2}-\\d{2}$')
         THEN try_strptime(c.signup_date, '%Y-%m-%d')::date
       WHEN regexp_matches(c.signup_date, '^\\d{2}/\\d{2}/\\d{4}$')
         THEN try_strptime(c.signup_date, '%d/%m/%Y')::date END < cast(r.hire_date as date), false)
    AS rep_assignment_valid
FROM dim_customer c LEFT JOIN dim_rep r USING (rep_id)"""))
def c8_rep_valid(spark, sf_dir):
    """Signup before the rep's hire date is flagged invalid (null dates are valid)."""
    c = star.dim_customer(spark, sf_dir)
    rep = star.dim_rep(spark, sf_dir).select("rep_id", "hire_date")
    j = c.join(rep, "rep_id", "left")
    impossible = F.coalesce(parse_mixed_date(F.col("signup_date")) < F.to_date("hire_date"),
                            F.lit(False))
    return j.select("customer_id", "rep_id", "hire_date", (~impossible).alias("rep_assignment_valid"))


_REPAIR_SQL_ROWS = []
for _i, (_d, _s, _a, _w) in enumerate(quality.REPAIR_LOG):
    _REPAIR_SQL_ROWS.append((_i + 1, _d, _s, _a, _w))


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_C9_COUNTERS = ["(SELECT count(*) FROM fact_raw) - (SELECT count(*) FROM fact)",
                "(SELECT count(*) FROM master WHERE usage_events IS NULL)",
                "(SELECT count(*) FROM master WHERE usage_events < 0)",
                "(SELECT count(*) FROM master WHERE discount_pct > 1.0)",
                "(SELECT count(DISTINCT customer_id) FROM master WHERE nullif(trim(industry), '') IS NULL)",
                "(SELECT count(DISTINCT customer_id) FROM master WHERE region_name IS NULL)",
                "(SELECT count(DISTINCT customer_id) FROM master"
                " WHERE regexp_matches(signup_date, '^\\d{2}/\\d{2}/\\d{4}$'))",
                "(SELECT count(DISTINCT customer_id) FROM clean WHERE NOT rep_assignment_valid)"]


def _c9_action(i, action):
    if "{median}" in action:
        pre, post = action.split("{median}")
        return f"{_sq(pre)} || printf('%.1f', (SELECT med FROM clean_params)) || {_sq(post)}"
    if "{region}" in action:
        pre, post = action.split("{region}")
        return (f"CASE WHEN {_C9_COUNTERS[i]} > 0 THEN {_sq(pre)} || (SELECT modal FROM clean_params)"
                f" || {_sq(post)} ELSE {_sq(quality.NOTHING_TO_FIX)} END")
    return _sq(action)


_C9_SQL = "\nUNION ALL\n".join(
    f"SELECT {i + 1} AS step, {_sq(d)} AS defect, cast({_C9_COUNTERS[i]} as bigint) AS rows, "
    f"{_sq(s)} AS scope, {_c9_action(i, a)} AS action, {_sq(w)} AS why, "
    f"cast({' + '.join('(' + c + ')' for c in _C9_COUNTERS)} as bigint) AS total_rows_touched"
    for i, (d, s, a, w) in enumerate(quality.REPAIR_LOG))


@register("c9_repair_log", with_prelude(_C9_SQL))
def c9_repair_log(spark, sf_dir):
    return quality.repair_log(spark, sf_dir)


@register("c10_usage_per_seat", with_prelude("""
SELECT fact_id, seats, round(usage_per_seat, 6) AS usage_per_seat FROM clean"""))
def c10_usage_per_seat(spark, sf_dir):
    c = quality.clean(spark, sf_dir, label=False)
    return c.select("fact_id", "seats", F.round("usage_per_seat", 6).alias("usage_per_seat"))


@register("c11_min_clean", with_prelude("""
SELECT fact_id, customer_id, date_key, period_key, seats,
       CASE WHEN usage_events < 0 THEN NULL ELSE usage_events END AS usage_events,
       CASE WHEN discount_pct > 1.0 THEN discount_pct - 1.0 ELSE discount_pct END AS discount_pct,
       CASE WHEN usage_events < 0 THEN NULL ELSE usage_events END / greatest(seats, 1) AS usage_per_seat
FROM fact"""))
def c11_min_clean(spark, sf_dir):
    return quality.minimal_clean(spark, sf_dir)


LEAKAGE_NOTE = ("a customer has churned if the last month seen lies before the panel's last one; "
                "no fact column says so, and the reason for leaving is known only afterwards, so it is no feature")
# the report's counters of defects, and the grains of its tables
_S6_DEFECTS = ["bu", "nu", "do", "dup", "bi", "br", "dd", "rs"]
_S6_TABLES = ["n", "nc", "s0", "s1", "s2"]


@register("s6_quality_report", with_prelude(f"""
SELECT metric, value, CASE WHEN metric = 'churn.rate' THEN {_sq(LEAKAGE_NOTE)} END AS note FROM s6_metrics
UNION ALL SELECT 'defect.total_rows_touched', sum(value), NULL FROM s6_metrics WHERE metric LIKE 'defect.%'
UNION ALL SELECT 'rows.cap', {quality.ROW_CAP}.0, NULL
UNION ALL SELECT 'rows.under_cap', cast(max(value) <= {quality.ROW_CAP} as double), NULL
  FROM s6_metrics WHERE metric LIKE 'rows.%'""", [("s6_metrics", """
SELECT metric, value FROM (
  SELECT 'rows.fact' AS metric, cast(count(*) as double) AS value FROM fact_raw
  UNION ALL SELECT 'rows.fact_unique', cast(count(*) as double) FROM fact
  UNION ALL SELECT 'rows.dim_customer', cast(count(*) as double) FROM dim_customer
  UNION ALL SELECT 'rows.dim_plan', cast(count(*) as double) FROM dim_plan
  UNION ALL SELECT 'rows.dim_region', cast(count(*) as double) FROM dim_region
  UNION ALL SELECT 'rows.dim_rep', cast(count(*) as double) FROM dim_rep
  UNION ALL SELECT 'defect.blank_usage', cast(count(*) FILTER (WHERE usage_events IS NULL) as double) FROM fact_raw
  UNION ALL SELECT 'defect.negative_usage', cast(count(*) FILTER (WHERE usage_events < 0) as double) FROM fact_raw
  UNION ALL SELECT 'defect.discount_over_1', cast(count(*) FILTER (WHERE discount_pct > 1.0) as double) FROM fact_raw
  UNION ALL SELECT 'defect.duplicated_rows', cast((SELECT count(*) FROM fact_raw) - (SELECT count(*) FROM fact) as double)
  UNION ALL SELECT 'defect.blank_industry', cast(count(*) FILTER (WHERE industry = '') as double) FROM dim_customer
  UNION ALL SELECT 'defect.blank_region', cast(count(*) FILTER (WHERE region_id IS NULL) as double) FROM dim_customer
  UNION ALL SELECT 'defect.day_first_dates', cast(count(*) FILTER (WHERE regexp_matches(signup_date, '^\\d{2}/\\d{2}/\\d{4}$')) as double) FROM dim_customer
  UNION ALL SELECT 'defect.rep_after_signup', cast(count(DISTINCT customer_id) as double) FROM clean WHERE NOT rep_assignment_valid
  UNION ALL SELECT 'churn.churned_customers', cast(sum(is_churned) as double) FROM cust_label
  UNION ALL SELECT 'churn.rate', round(avg(is_churned), 4) FROM cust_label)""")]))
def s6_quality_report(spark, sf_dir):
    """Row counts, the eight defects (raw rows) and all rows they touch, whether
    every table is under the cap, churn count and rate with the note on leakage; long format."""
    raw = star.fact(spark, sf_dir, dedupe=False, with_plan=False)
    ded = quality.dedup_panel(spark, sf_dir)
    cust = star.dim_customer(spark, sf_dir)
    labels = quality.customer_labels(ded)
    fa = raw.agg(F.count("*").alias("n"), F.count_if(F.col("usage_events").isNull()).alias("bu"),
                 F.count_if(F.col("usage_events") < 0).alias("nu"),
                 F.count_if(F.col("discount_pct") > 1.0).alias("do"))
    da = ded.agg(F.count("*").alias("nd"))
    ca = cust.agg(F.count("*").alias("nc"), F.count_if(F.col("industry") == "").alias("bi"),
                  F.count_if(F.col("region_id").isNull()).alias("br"),
                  F.count_if(F.col("signup_date").rlike(quality.SLASH_DATE)).alias("dd"))
    la = labels.agg(F.sum("is_churned").alias("ch"), F.avg("is_churned").alias("rate"))
    ra = quality.clean(spark, sf_dir, label=False).where(~F.col("rep_assignment_valid")) \
        .groupBy("customer_id").agg(F.lit(1)).agg(F.count("*").alias("rs"))
    small = {
        "rows.dim_plan": star.dim_plan(spark, sf_dir),
        "rows.dim_region": star.dim_region(spark, sf_dir),
        "rows.dim_rep": star.dim_rep(spark, sf_dir),
    }
    one = fa.crossJoin(da).crossJoin(ca).crossJoin(la).crossJoin(ra) \
        .withColumn("dup", F.col("n") - F.col("nd"))
    for i, (name, df) in enumerate(small.items()):
        one = one.crossJoin(df.agg(F.count("*").alias(f"s{i}")))
    metrics = [("rows.fact", "n"), ("rows.fact_unique", "nd"), ("rows.dim_customer", "nc"),
               ("rows.dim_plan", "s0"), ("rows.dim_region", "s1"), ("rows.dim_rep", "s2"),
               ("defect.blank_usage", "bu"), ("defect.negative_usage", "nu"),
               ("defect.discount_over_1", "do"), ("defect.duplicated_rows", "dup"),
               ("defect.blank_industry", "bi"), ("defect.blank_region", "br"),
               ("defect.day_first_dates", "dd"), ("defect.rep_after_signup", "rs"),
               ("churn.churned_customers", "ch"), ("churn.rate", "rate")]
    values = [(name, F.round("rate", 4) if c == "rate" else F.col(c)) for name, c in metrics]
    values += [("defect.total_rows_touched", reduce(Column.__add__, [F.col(c) for c in _S6_DEFECTS])),
               ("rows.cap", F.lit(quality.ROW_CAP)),
               ("rows.under_cap", F.greatest(*_S6_TABLES) <= quality.ROW_CAP)]
    entries = [F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"),
                        F.lit(LEAKAGE_NOTE if name == "churn.rate" else None).cast("string").alias("note"))
               for name, value in values]
    return one.select(F.inline(F.array(*entries)))
