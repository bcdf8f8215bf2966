"""DuckDB spelling of the star panel: the CTE prelude every oracle shares.

The oracle only sees the driver's raw tables, so the fixture mapping of
``sources/star.py`` is restated here in SQL. ``with_prelude(ctes, final)``
joins the prelude, query-specific CTEs and the final SELECT into one
statement. DuckDB inlines CTEs that are not used.
"""

from __future__ import annotations

from ..functions.hashing import u_sql


def _fact_sql(src: str) -> str:
    fid = "li.fact_id"
    seats = "cast(li.l_quantity as integer)"
    uu = u_sql("u", fid)
    um = u_sql("m", fid)
    un = u_sql("n", fid)
    usage_clean = f"({seats} * (10.0 + 10.0 * {uu}))"
    return f"""SELECT
      {fid} AS fact_id,
      o.o_custkey AS customer_id,
      li.l_partkey AS plan_id,
      cast(year(o.o_orderdate) * 100 + month(o.o_orderdate) as integer) AS date_key,
      cast(year(o.o_orderdate) as integer) AS period_key,
      {seats} AS seats,
      {seats} * p.p_retailprice * (1.0 - li.l_discount) * (1.0 + ({um} - 0.5) * 0.12) AS mrr,
      CASE WHEN {fid} % 41 = 3 THEN NULL
           WHEN {fid} % 187 = 5 THEN -{usage_clean}
           ELSE {usage_clean} END AS usage_events,
      cast(CASE li.l_returnflag WHEN 'R' THEN 2 WHEN 'A' THEN 1 ELSE 0 END as integer)
        AS support_tickets,
      CASE WHEN {fid} % 150 = 7 THEN li.l_discount + 1.0 ELSE li.l_discount END AS discount_pct,
      45.0 + (10.0 * {uu} - 5.0) * 1.5 + ({un} - 0.5) * 40.0 AS nps_score,
      p.p_type AS primary_ticket_topic,
      p.p_name AS plan_name,
      cast(p.p_size as integer) AS tier_rank,
      p.p_retailprice AS list_price_per_seat
    FROM {src} li
    JOIN orders o ON li.l_orderkey = o.o_orderkey
    JOIN part p ON li.l_partkey = p.p_partkey"""


_DATE_COLS = """
      strftime(make_date(cast(m.date_key // 100 as integer), cast(m.date_key % 100 as integer), 1), '%B')
        AS month_name,
      cast(m.date_key % 100 as integer) AS month_num,
      cast((m.date_key % 100 - 1) // 3 + 1 as integer) AS quarter,
      cast(m.date_key // 100 as integer) AS year,
      cast(m.date_key % 100 in (3, 6, 9, 12) as integer) AS is_quarter_end,
      make_date(cast(m.date_key // 100 as integer), cast(m.date_key % 100 as integer), 1)
        AS month_start"""

_MASTER_COLS = """m.fact_id, m.customer_id, m.plan_id, m.date_key, m.period_key, m.seats, m.mrr,
      m.usage_events, m.support_tickets, m.discount_pct, m.nps_score, m.primary_ticket_topic,
      c.company_name, c.industry, c.segment, c.signup_date, c.rep_id, c.is_annual_contract,
      m.plan_name, m.tier_rank, m.list_price_per_seat, c.region_id, r.region_name,
      CASE WHEN c.region_id IS NOT NULL THEN c.nation_name END AS country,"""

PRELUDE_CTES = [
    ("li_raw", "SELECT l.*, l.l_orderkey * 10 + l.l_linenumber AS fact_id FROM lineitem l"),
    ("li_dedup", """SELECT * EXCLUDE (rn_) FROM (
      SELECT *, row_number() OVER (PARTITION BY fact_id ORDER BY l_partkey, l_suppkey,
        l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
        l_shipdate) AS rn_ FROM li_raw) WHERE rn_ = 1"""),
    ("fact_raw", _fact_sql("li_raw")),
    ("fact", _fact_sql("li_dedup")),
    ("dim_region", "SELECT cast(r_regionkey as integer) AS region_id, r_name AS region_name FROM region"),
    ("dim_rep", """SELECT cast(s_suppkey as integer) AS rep_id, s_name AS rep_name,
      strftime(date '1995-03-01' + cast(s_suppkey % 10 * 120 as integer), '%Y-%m-%d') AS hire_date
      FROM supplier"""),
    ("dim_plan", """SELECT p_partkey AS plan_id, p_name AS plan_name,
      p_retailprice AS list_price_per_seat, cast(p_size as integer) AS tier_rank FROM part"""),
    ("industry_risk", """SELECT n_name AS industry,
      (n_nationkey % 8) / 10.0 - 0.35 AS industry_risk FROM nation"""),
    ("dim_customer", """SELECT
      c.c_custkey AS customer_id,
      c.c_name AS company_name,
      CASE WHEN c.c_custkey % 33 = 4 THEN '' ELSE n.n_name END AS industry,
      CASE WHEN c.c_custkey % 67 = 5 THEN NULL ELSE cast(n.n_regionkey as integer) END AS region_id,
      c.c_mktsegment AS segment,
      CASE WHEN c.c_custkey % 25 = 6
           THEN strftime(date '1998-01-01' - cast(30 + (c.c_custkey * 37) % 420 as integer), '%d/%m/%Y')
           ELSE strftime(date '1998-01-01' - cast(30 + (c.c_custkey * 37) % 420 as integer), '%Y-%m-%d')
      END AS signup_date,
      cast(c.c_custkey % (SELECT max(s_suppkey) + 1 FROM supplier) as integer) AS rep_id,
      cast(c.c_acctbal > 4000.0 as integer) AS is_annual_contract,
      n.n_name AS nation_name
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""),
    ("master_raw", f"""SELECT {_MASTER_COLS} {_DATE_COLS}
    FROM fact_raw m JOIN dim_customer c ON m.customer_id = c.customer_id
    LEFT JOIN dim_region r ON c.region_id = r.region_id"""),
    ("master", f"""SELECT {_MASTER_COLS} {_DATE_COLS}
    FROM fact m JOIN dim_customer c ON m.customer_id = c.customer_id
    LEFT JOIN dim_region r ON c.region_id = r.region_id"""),
    ("clean_params", """SELECT
      (SELECT median(CASE WHEN usage_events < 0 THEN NULL ELSE usage_events END) FROM master) AS med,
      (SELECT region_name FROM (SELECT region_name, count(*) AS n FROM master
        WHERE region_name IS NOT NULL GROUP BY region_name) ORDER BY n DESC, region_name LIMIT 1)
        AS modal"""),
    ("clean", """SELECT m.* EXCLUDE (usage_events, discount_pct, industry, region_name, country),
      CASE WHEN m.usage_events < 0 THEN NULL ELSE m.usage_events END AS usage_events,
      coalesce(CASE WHEN m.usage_events < 0 THEN NULL ELSE m.usage_events END, cp.med)
        AS usage_events_filled,
      CASE WHEN m.discount_pct > 1.0 THEN m.discount_pct - 1.0 ELSE m.discount_pct END AS discount_pct,
      CASE WHEN nullif(trim(m.industry), '') IS NULL THEN 'Unknown' ELSE m.industry END AS industry,
      CASE WHEN m.region_name IS NULL THEN cp.modal ELSE m.region_name END AS region_name,
      CASE WHEN m.region_name IS NULL THEN 'Unknown' ELSE m.country END AS country,
      CASE WHEN regexp_matches(m.signup_date, '^\\d{4}-\\d{2}-\\d{2}$')
             THEN try_strptime(m.signup_date, '%Y-%m-%d')::date
           WHEN regexp_matches(m.signup_date, '^\\d{2}/\\d{2}/\\d{4}$')
             THEN try_strptime(m.signup_date, '%d/%m/%Y')::date END AS signup_date_parsed,
      NOT coalesce(CASE WHEN regexp_matches(m.signup_date, '^\\d{4}-\\d{2}-\\d{2}$')
             THEN try_strptime(m.signup_date, '%Y-%m-%d')::date
           WHEN regexp_matches(m.signup_date, '^\\d{2}/\\d{2}/\\d{4}$')
             THEN try_strptime(m.signup_date, '%d/%m/%Y')::date END < cast(rp.hire_date as date), false)
        AS rep_assignment_valid,
      coalesce(CASE WHEN m.usage_events < 0 THEN NULL ELSE m.usage_events END, cp.med)
        / greatest(m.seats, 1) AS usage_per_seat
    FROM master m LEFT JOIN dim_rep rp ON m.rep_id = rp.rep_id CROSS JOIN clean_params cp"""),
    ("cust_label", """SELECT customer_id, max(period_key) AS last_period,
      cast(max(period_key) < (SELECT max(period_key) FROM master) as integer) AS is_churned
    FROM master GROUP BY customer_id"""),
    ("clean_lab", """SELECT c.*, l.is_churned FROM clean c JOIN cust_label l USING (customer_id)"""),
    ("baseline_periods", "SELECT DISTINCT period_key FROM fact ORDER BY period_key LIMIT 2"),
    ("cust_first", """SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER (
      PARTITION BY customer_id ORDER BY date_key, fact_id) AS rn_ FROM clean_lab) WHERE rn_ = 1"""),
    ("model_frame", """SELECT b.*, coalesce(ir.industry_risk, 0.0) AS industry_risk,
      cast(b.segment = 'BUILDING' as integer) AS is_smb
    FROM (SELECT customer_id, avg(usage_per_seat) AS usage_per_seat,
            avg(support_tickets) AS support_tickets, avg(discount_pct) AS discount_pct,
            avg(seats) AS seats, avg(nps_score) AS nps_score, avg(mrr) AS mrr,
            max(is_annual_contract) AS is_annual_contract, max(segment) AS segment,
            max(industry) AS industry, max(company_name) AS company_name,
            max(region_name) AS region_name, max(is_churned) AS is_churned
          FROM clean_lab WHERE period_key IN (SELECT period_key FROM baseline_periods)
          GROUP BY customer_id) b
    LEFT JOIN industry_risk ir USING (industry)"""),
    ("scored", f"""SELECT *, 1.0 / (1.0 + exp(-logit)) AS probability,
      cast(row_number() OVER (ORDER BY logit DESC, customer_id)
           <= round_even(count(*) OVER () * 0.2, 0) as integer) AS label
    FROM (SELECT *, 13.0 + -0.85 * usage_per_seat + 0.28 * support_tickets
                 + 2.1 * discount_pct + -0.045 * nps_score + 0.55 * is_smb
                 + 0.85 * industry_risk + -0.7 * is_annual_contract
                 + ({u_sql('c', 'customer_id')} - 0.5) * 1.9 AS logit
          FROM model_frame)"""),
    ("cluster_base", """SELECT customer_id, avg(usage_per_seat) AS usage_per_seat, avg(support_tickets) AS support_tickets, avg(discount_pct) AS discount_pct, avg(seats) AS seats, avg(nps_score) AS nps_score, avg(mrr) AS mrr,
      max(segment) AS segment, max(is_churned) AS is_churned, max(company_name) AS company_name
    FROM clean_lab WHERE period_key IN (SELECT period_key FROM baseline_periods)
    GROUP BY customer_id"""),
    ("cluster_frame", """SELECT *,
      (usage_per_seat - avg(usage_per_seat) OVER ()) / coalesce(nullif(stddev_pop(usage_per_seat) OVER (), 0), 1) AS z_usage_per_seat,
      (support_tickets - avg(support_tickets) OVER ()) / coalesce(nullif(stddev_pop(support_tickets) OVER (), 0), 1) AS z_support_tickets,
      (discount_pct - avg(discount_pct) OVER ()) / coalesce(nullif(stddev_pop(discount_pct) OVER (), 0), 1) AS z_discount_pct,
      (seats - avg(seats) OVER ()) / coalesce(nullif(stddev_pop(seats) OVER (), 0), 1) AS z_seats,
      (nps_score - avg(nps_score) OVER ()) / coalesce(nullif(stddev_pop(nps_score) OVER (), 0), 1) AS z_nps_score,
      (mrr - avg(mrr) OVER ()) / coalesce(nullif(stddev_pop(mrr) OVER (), 0), 1) AS z_mrr
    FROM cluster_base WHERE usage_per_seat IS NOT NULL AND support_tickets IS NOT NULL AND discount_pct IS NOT NULL AND seats IS NOT NULL AND nps_score IS NOT NULL AND mrr IS NOT NULL"""),
    ("centres", f"""SELECT row_number() OVER (ORDER BY cu, customer_id) - 1 AS cid, z_usage_per_seat, z_support_tickets, z_discount_pct, z_seats, z_nps_score, z_mrr
    FROM (SELECT *, {u_sql('centre', 'customer_id')} AS cu FROM cluster_frame)
    ORDER BY cu, customer_id LIMIT 3"""),
    ("cluster_dists", """SELECT f.customer_id, c.cid, (f.z_usage_per_seat - c.z_usage_per_seat) * (f.z_usage_per_seat - c.z_usage_per_seat) + (f.z_support_tickets - c.z_support_tickets) * (f.z_support_tickets - c.z_support_tickets) + (f.z_discount_pct - c.z_discount_pct) * (f.z_discount_pct - c.z_discount_pct) + (f.z_seats - c.z_seats) * (f.z_seats - c.z_seats) + (f.z_nps_score - c.z_nps_score) * (f.z_nps_score - c.z_nps_score) + (f.z_mrr - c.z_mrr) * (f.z_mrr - c.z_mrr) AS d
    FROM cluster_frame f CROSS JOIN centres c"""),
    ("cluster_labelled", """SELECT f.*, cast(l.cid as integer) AS cluster FROM cluster_frame f JOIN (
      SELECT customer_id, cid FROM (SELECT *, row_number() OVER (
        PARTITION BY customer_id ORDER BY d, cid) AS rn_ FROM cluster_dists) WHERE rn_ = 1) l
      USING (customer_id)"""),
]


def with_prelude(final: str, ctes: list[tuple[str, str]] | None = None) -> str:
    parts = PRELUDE_CTES + list(ctes or [])
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in parts)
    return f"WITH {body}\n{final}"


def wilson_sql(k: str, n: str, z: float = 1.96) -> tuple[str, str]:
    """Wilson interval bounds as DuckDB expressions (same arithmetic as Spark's)."""
    z2 = repr(z * z)
    p = f"(({k}) * 1.0 / ({n}))"
    denom = f"(1.0 + {z2} / ({n}))"
    centre = f"(({p} + {z2} / (2.0 * ({n}))) / {denom})"
    spread = f"({z!r} * sqrt({p} * (1.0 - {p}) / ({n}) + {z2} / (4.0 * ({n}) * ({n}))) / {denom})"
    low = f"(CASE WHEN ({n}) <= 0 THEN 0.0 ELSE greatest(0.0, {centre} - {spread}) END)"
    high = f"(CASE WHEN ({n}) <= 0 THEN 0.0 ELSE least(1.0, {centre} + {spread}) END)"
    return low, high
