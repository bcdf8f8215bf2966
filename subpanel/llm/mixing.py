"""Mixing sources to target weights by entropy balancing (operator 8), in DataFrame functions.

Among all rates that give each source its target number of words, the ones
nearest to 1 in relative entropy tilt a document exponentially by its size:
rate = min(2, exp(lambda * size / mean size)). Each source's lambda is the
minimum of the convex dual; Newton steps on log(words) - log(target), kept
within a bracket, find it. A step is one distributed sum over *cells*, the
distinct (source, size) pairs with their counts, so its cost follows the
number of different sizes and a hot source is summed before any shuffle. Sums
are exact decimals: the order of rows can't change them, and reruns agree.

Rates become whole copies (0, 1 or 2) by cell: whole parts are taken as they
are, the fractions of a source's cells are dealt systematically in order of
size, and what is still missing is made up by single copies of fitting sizes.
Within a cell the documents of smallest id hash get the odd copies; cells of
many documents are ranked in salted parts, so no task holds a hot group.

Targets: sources by code point, null last, weigh 5, 2, 1, repeating, and share
``SHARE`` of all words; a source stops at ``MOST`` times its own words and the
excess is shared again by weight.

Defined results: a null text has size 0, and documents of size 0 keep rate 1
and take 0 words; a source without words has target 0; a null source is a
source of its own; repeated rows and null ids count as documents; an empty
table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2            # copies of a document, and of a source's words
STEPS = 60          # Newton steps at most; about ten are usual
TOLERANCE = 1e-9    # relative miss of a target at which Newton stops
RANK_ROWS = 20_000  # documents of one cell ranked together
FIX_ROUNDS = 3
WORD = r"[^\x20\x09-\x0D]+"


def sized(documents: DataFrame, doc_id: str, text: str, source: str, carry: dict) -> DataFrame:
    """doc_id, source, size and hash of every document, and what is to be carried along."""
    return documents.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.col(doc_id).cast("string")).alias("hash"),
        *[v.alias(k) for k, v in carry.items()])


def source_targets(cells: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   most: int = MOST) -> DataFrame:
    """One row per source: sid, source, source_size, n_docs, target, full (stops at ``most``).

    A source is full if its limit per weight is no more than what the sources
    that fill up later (or never) get per weight; in order of limit per weight
    that is one running sum, without rounds.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("sid") % len(weights) + 1).cast("int"))
    totals = cells.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("n_docs"))
    per = totals.withColumn("sid", F.row_number().over(by_name) - 1) \
        .withColumn("weight", weight).withColumn("limit", F.col("source_size") * most)
    fill = Window.orderBy(F.col("limit") / F.col("weight"), "sid")
    before, everything = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    zero = F.lit(0.0)
    words = F.sum("source_size").over(everything) * F.lit(share)
    left = words - F.coalesce(F.sum("limit").over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero)
    full = F.col("limit") / F.col("weight") <= left / weight_left
    marked = per.withColumn("words", words).withColumn("full", full)
    rest_words = F.col("words") - F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0)).over(everything)
    rest_weight = F.sum(F.when(F.col("full"), zero).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(
        rest_words * F.col("weight") / rest_weight)
    return marked.withColumn("target", target).select(
        "sid", "source", "source_size", "n_docs", "target", "full")


def _rate(tilt, most: int):
    """Copies a document's size calls for; the exponent is kept where exp can't overflow."""
    return F.least(F.lit(float(most)), F.exp(F.least(tilt, F.lit(50.0))))


def balance(cells: DataFrame, sources: DataFrame, most: int = MOST) -> DataFrame:
    """lambda of each source that isn't full: sid, lambda. Newton, one sum over cells a step."""
    open_ = sources.where(~F.col("full") & (F.col("source_size") > 0))
    state = written(open_.select(
        "sid", "target", F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("lo"),
        F.lit(None).cast("double").alias("hi"), F.lit(1.0).alias("miss")))
    exact = lambda x: F.sum(x.cast("decimal(38,6)")).cast("double")
    for _ in range(STEPS):
        tilt = F.col("lam") * F.col("x")
        rate = _rate(tilt, most)
        got = F.col("n") * F.col("size") * rate
        grows = F.when(rate < most, got * F.col("x")).otherwise(F.lit(0.0))
        sums = cells.join(state.select("sid", "lam"), "sid").groupBy("sid").agg(
            exact(got).alias("got"), exact(grows).alias("slope"))
        miss = F.col("got") / F.col("target") - 1
        low = F.when(miss <= 0, F.col("lam")).otherwise(F.col("lo"))
        high = F.when(miss >= 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - F.log(F.greatest(F.col("got"), F.lit(1e-6)) / F.col("target")) \
            * F.col("got") / F.col("slope")
        inside = (F.col("slope") > 0) & F.coalesce(newton > F.col("lo"), F.lit(True)) & \
            F.coalesce(newton < F.col("hi"), F.lit(True))
        other = F.when(F.col("lo").isNull(), F.col("hi") * 2 - 1) \
            .when(F.col("hi").isNull(), F.col("lo") * 2 + 1) \
            .otherwise((F.col("lo") + F.col("hi")) / 2)
        state = written(
            state.drop("miss").join(sums, "sid").withColumn("miss", F.abs(miss))
            .withColumn("lo", low).withColumn("hi", high)
            .withColumn("lam", F.when(F.col("miss") <= TOLERANCE, F.col("lam"))
                        .when(inside, newton).otherwise(other))
            .select("sid", "target", "lam", "lo", "hi", "miss"))
        worst = state.agg(F.max("miss")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
    return state.select("sid", "lam")


def whole_copies(cells: DataFrame, sources: DataFrame, lambdas: DataFrame,
                 most: int = MOST) -> DataFrame:
    """Copies of each cell's documents in all: sid, size, n, copies (0 to most * n)."""
    rated = cells.join(lambdas, "sid", "left").join(
        sources.select("sid", "target", "full"), "sid")
    rate = F.when(F.col("full") & (F.col("size") > 0), F.lit(float(most))).otherwise(
        F.round(_rate(F.coalesce("lam", F.lit(0.0)) * F.col("x"), most), 9))
    want = (F.col("n") * rate).cast("decimal(30,9)")
    by_size = Window.partitionBy("sid").orderBy(F.col("size").desc())
    run = by_size.rowsBetween(Window.unboundedPreceding, 0)
    dealt = rated.withColumn("want", want).withColumn("copies", F.floor("want")) \
        .withColumn("part", F.when(F.col("size") > 0, F.col("want") - F.col("copies")).otherwise(F.lit(0))) \
        .withColumn("run", F.sum("part").over(run) + F.lit(0.5).cast("decimal(2,1)")) \
        .withColumn("copies", F.least(
            F.col("n") * most,
            F.col("copies") + F.floor("run") - F.floor(F.col("run") - F.col("part"))).cast("long"))
    for _ in range(FIX_ROUNDS):
        lacks = F.col("target") - F.sum(F.col("copies") * F.col("size")).over(Window.partitionBy("sid"))
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs("lacks")) & F.when(
            F.col("lacks") > 0, F.col("copies") < F.col("n") * most).otherwise(F.col("copies") > 0)
        dealt = dealt.withColumn("lacks", lacks) \
            .withColumn("step", F.when(fits, F.col("size")).otherwise(0)) \
            .withColumn("used", F.sum("step").over(run)) \
            .withColumn("copies", F.col("copies") + F.when(
                (F.col("step") > 0) & (F.col("used") <= F.abs("lacks")),
                F.signum("lacks").cast("long")).otherwise(F.lit(0)))
    return dealt.select("sid", "size", "n", "copies")


def mix(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, share: float = SHARE, most: int = MOST,
        carry: dict | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate in copies, taken.

    ``carry`` names further columns to keep, as expressions over ``documents``.
    """
    carry = carry or {}
    narrow = written(sized(documents, doc_id, text, source, carry))
    cells = narrow.groupBy("source", "size").agg(F.count("*").alias("n"))
    sources = written(source_targets(cells, weights, share, most))
    cells = written(cells.join(sources, cells["source"].eqNullSafe(sources["source"])).select(
        "sid", "size", "n",
        (F.col("size") * F.col("n_docs") / F.greatest("source_size", F.lit(1))).alias("x")))
    copies = whole_copies(cells, sources, balance(cells, sources, most), most)
    named = sources.select("sid", F.col("source").alias("named"), "source_size", "target")
    plan = written(copies.join(named, "sid"))
    parts = F.ceil(F.col("n") / RANK_ROWS)
    unit = F.pmod(F.col("hash"), F.lit(1 << 30))
    rows = narrow.join(plan.withColumnRenamed("size", "cell_size"),
                       narrow["source"].eqNullSafe(F.col("named"))
                       & (narrow["size"] == F.col("cell_size"))) \
        .withColumn("unit", unit).withColumn("part", F.floor(F.col("unit") * parts / (1 << 30)))
    before = Window.partitionBy("sid", "size").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    ahead = rows.groupBy("sid", "size", "part").agg(F.count("*").alias("in_part")).select(
        "sid", "size", "part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("ahead"))
    place = F.row_number().over(
        Window.partitionBy("sid", "size", "part").orderBy("unit", "hash", "doc_id"))
    ranked = rows.withColumn("place", place).join(ahead, ["sid", "size", "part"])
    given = F.floor(F.col("copies") / F.col("n")) + (
        F.col("ahead") + F.col("place") <= F.col("copies") % F.col("n")).cast("long")
    return ranked.withColumn("given", given).select(
        "doc_id", "source", "size", "source_size", "target", F.col("given").alias("copies"),
        (F.col("given") * F.col("size")).alias("taken"), *carry)
