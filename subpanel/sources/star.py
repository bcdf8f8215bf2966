"""The star panel built from the driver's TPC-H-style tables (FIXTURES §2).

Fact grain: one line item = one customer-month observation.  Dimensions:
customer (with nation/region/rep), plan (= part), date (derived from the
month key), region, rep.  Corruptions are deterministic rules on keys and
hash-derived noise, so the SQL oracle reproduces every value.

Plan shape (what ``explain`` should show):
* the panel's lines are shuffled twice, narrow: to the parts on the part key,
  and to the orders on the order key. Customer attributes come with the
  orders, which have met the customers on the customer key; measures made of
  hashes are computed after the last shuffle.
* nation / region / rep are bounded (25 / 5 / 10 rows) and broadcast.
* the month dimension is a pure function of ``date_key`` and is computed as
  expressions instead of a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import u
from ..functions.scalar import month_start
from .tables import read_table

# Fixed values of the fixture mapping.
DEDUPE_TIEBREAK = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                   "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
REP_HIRE_BASE = "1995-03-01"
REP_HIRE_STEP_DAYS = 120
REP_HIRE_STEPS = 10  # hire dates repeat after so many suppliers
SIGNUP_BASE = "1998-01-01"
ANNUAL_ACCTBAL = 4000.0

LINE_COLUMNS = ["l_orderkey", "l_linenumber"] + DEDUPE_TIEBREAK


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", LINE_COLUMNS)
    return li.withColumn("fact_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))


def keep_first(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """One row per ``key``, the smallest by ``order_cols`` (then the rest).

    Rows meet their key's others in one exchange and are reduced there as
    ``min_by(struct(row), struct(order))``. That aggregate sorts its rows by
    key; behind the exchange these are partitions sized by AQE, while ahead of
    it a partial aggregate would sort all rows of a scan task, which spills
    and, with few repeats, takes little off the exchange. A null key is a key
    like others.
    """
    rest = [c for c in df.columns if c != key]
    order = F.struct(*[F.col(c) for c in order_cols + [c for c in rest if c not in order_cols]])
    packed = F.min_by(F.struct(*[F.col(c) for c in rest]), order).alias("_first")
    return df.repartition(F.col(key)).groupBy(key).agg(packed).select(key, "_first.*").select(*df.columns)


def lines(spark: SparkSession, sf_dir: str, dedupe: bool) -> DataFrame:
    li = _lines(spark, sf_dir)
    return keep_first(li, "fact_id", DEDUPE_TIEBREAK) if dedupe else li


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])


def _with_part(li: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part",
                      ["p_partkey", "p_name", "p_type", "p_size", "p_retailprice"])
    return li.join(part, li["l_partkey"] == part["p_partkey"])


def _fact_columns(with_plan: bool = True) -> list:
    """The fact's columns as expressions over lines, orders and parts."""
    fid = F.col("fact_id")
    seats = F.col("l_quantity").cast("int")
    u_m, u_u, u_n = u("m", fid), u("u", fid), u("n", fid)
    usage_clean = seats * (F.lit(10.0) + F.lit(10.0) * u_u)
    usage = (F.when(fid % 41 == 3, F.lit(None).cast("double"))
              .when(fid % 187 == 5, -usage_clean)
              .otherwise(usage_clean))
    tickets = (F.when(F.col("l_returnflag") == "R", 2)
                .when(F.col("l_returnflag") == "A", 1).otherwise(0)).cast("int")
    discount = F.when(fid % 150 == 7, F.col("l_discount") + 1.0).otherwise(F.col("l_discount"))
    mrr = (seats * F.col("p_retailprice") * (F.lit(1.0) - F.col("l_discount"))
           * (F.lit(1.0) + (u_m - F.lit(0.5)) * F.lit(0.12)))
    nps = (F.lit(45.0) + (F.lit(10.0) * u_u - F.lit(5.0)) * F.lit(1.5)
           + (u_n - F.lit(0.5)) * F.lit(40.0))
    year = F.year("o_orderdate")
    cols = [
        fid.alias("fact_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("plan_id"),
        (year * 100 + F.month("o_orderdate")).cast("int").alias("date_key"),
        year.cast("int").alias("period_key"),
        seats.alias("seats"),
        mrr.alias("mrr"),
        usage.alias("usage_events"),
        tickets.alias("support_tickets"),
        discount.alias("discount_pct"),
        nps.alias("nps_score"),
        F.col("p_type").alias("primary_ticket_topic"),
    ]
    if with_plan:
        cols += [F.col("p_name").alias("plan_name"),
                 F.col("p_size").cast("int").alias("tier_rank"),
                 F.col("p_retailprice").alias("list_price_per_seat")]
    return cols


def fact(spark: SparkSession, sf_dir: str, dedupe: bool = False,
         with_plan: bool = True) -> DataFrame:
    """``fact_subscription_monthly`` stand-in (raw, or de-duplicated by C1).

    The dedupe is pushed below the dimension joins: all joins are many-to-one
    on keys that resolve (checked by P7), so de-duplicating first yields the
    same rows while shuffling the narrow line table instead of the wide
    master frame.
    """
    li = lines(spark, sf_dir, dedupe)
    orders = _orders(spark, sf_dir)
    j = _with_part(li.join(orders, li["l_orderkey"] == orders["o_orderkey"]), spark, sf_dir)
    return j.select(*_fact_columns(with_plan))


def dim_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return r.select(F.col("r_regionkey").cast("int").alias("region_id"),
                    F.col("r_name").alias("region_name"))


def dim_rep(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    hire = F.date_add(F.lit(REP_HIRE_BASE).cast("date"),
                      (F.col("s_suppkey") % REP_HIRE_STEPS * REP_HIRE_STEP_DAYS).cast("int"))
    return s.select(F.col("s_suppkey").cast("int").alias("rep_id"),
                    F.col("s_name").alias("rep_name"),
                    F.date_format(hire, "yyyy-MM-dd").alias("hire_date"))


def dim_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_size", "p_retailprice"])
    return p.select(F.col("p_partkey").alias("plan_id"), F.col("p_name").alias("plan_name"),
                    F.col("p_retailprice").alias("list_price_per_seat"),
                    F.col("p_size").cast("int").alias("tier_rank"))


def industry_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup industry → churn risk index (25 rows, bounded: one per nation)."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return n.select(F.col("n_name").alias("industry"),
                    ((F.col("n_nationkey") % 8) / 10.0 - 0.35).alias("industry_risk"))


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dim_customer`` stand-in with its injected defects.

    Broken region keys stay null here; the region join is done by the master
    so that J1's left-join semantics hold.
    """
    c = read_table(spark, sf_dir, "customer",
                   ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    # nation has one row per country: bounded, broadcast.
    j = c.join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"], "left")
    # every supplier is a rep; one row, the number of rep keys
    reps = read_table(spark, sf_dir, "supplier", ["s_suppkey"]).agg(
        (F.max("s_suppkey") + 1).alias("rep_keys"))
    j = j.crossJoin(F.broadcast(reps))
    key = F.col("c_custkey")
    signup = F.date_sub(F.lit(SIGNUP_BASE).cast("date"), (30 + (key * 37) % 420).cast("int"))
    return j.select(
        key.alias("customer_id"),
        F.col("c_name").alias("company_name"),
        F.when(key % 33 == 4, F.lit("")).otherwise(F.col("n_name")).alias("industry"),
        F.when(key % 67 == 5, F.lit(None).cast("int"))
         .otherwise(F.col("n_regionkey").cast("int")).alias("region_id"),
        F.col("c_mktsegment").alias("segment"),
        F.when(key % 25 == 6, F.date_format(signup, "dd/MM/yyyy"))
         .otherwise(F.date_format(signup, "yyyy-MM-dd")).alias("signup_date"),
        (key % F.col("rep_keys")).cast("int").alias("rep_id"),
        (F.col("c_acctbal") > ANNUAL_ACCTBAL).cast("int").alias("is_annual_contract"),
        F.col("n_name").alias("nation_name"),
    )


def date_columns(date_key: str = "date_key") -> list:
    """Month-dimension attributes (S10) as expressions of the key."""
    k = F.col(date_key)
    month = F.pmod(k, F.lit(100)).cast("int")
    start = month_start(k)
    return [
        F.date_format(start, "MMMM").alias("month_name"),
        month.alias("month_num"),
        (((month - 1) / 3).cast("int") + 1).alias("quarter"),
        (k / 100).cast("int").alias("year"),
        month.isin(3, 6, 9, 12).cast("int").alias("is_quarter_end"),
        start.alias("month_start"),
    ]


def master(spark: SparkSession, sf_dir: str, dedupe: bool = True, hire: bool = False) -> DataFrame:
    """J1 + P1: the flat star join. Inner to customer/plan/date, left to region.

    Customers (with region, broadcast and left-joined so broken keys survive,
    and with their rep's ``hire_date`` if asked for) meet the orders, of which
    there are fewer than lines; lines meet parts; the two sides meet on the
    order key. Measures are computed after that last shuffle, from the keys.
    """
    cust = dim_customer(spark, sf_dir).join(F.broadcast(dim_region(spark, sf_dir)), "region_id", "left")
    if hire:    # AQE broadcasts the reps if it finds them small
        cust = cust.join(dim_rep(spark, sf_dir).select("rep_id", "hire_date"), "rep_id", "left")
    orders = _orders(spark, sf_dir)
    bought = orders.join(cust, orders["o_custkey"] == cust["customer_id"]).drop("customer_id")
    li = _with_part(lines(spark, sf_dir, dedupe), spark, sf_dir)
    attributes = ["company_name", "industry", "segment", "signup_date", "rep_id", "is_annual_contract",
                  "region_id", "region_name", "nation_name", *(["hire_date"] if hire else [])]
    m = li.join(bought, li["l_orderkey"] == bought["o_orderkey"]).select(*_fact_columns(), *attributes)
    return m.select(
        "fact_id", "customer_id", "plan_id", "date_key", "period_key", "seats", "mrr",
        "usage_events", "support_tickets", "discount_pct", "nps_score",
        "primary_ticket_topic", "company_name", "industry", "segment", "signup_date",
        "rep_id", "is_annual_contract", "plan_name", "tier_rank", "list_price_per_seat",
        "region_id", "region_name",
        F.when(F.col("region_id").isNotNull(), F.col("nation_name")).alias("country"),
        *date_columns("date_key"), *(["hire_date"] if hire else []),
    )
