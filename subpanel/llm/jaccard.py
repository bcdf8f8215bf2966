"""N-gram Jaccard join by universe partitioning (operator 7).

Documents are sets of word-shingle hashes; two link when 100 * intersection
>= ``PERCENT`` * union. For a pair whose smaller set lies in size band b the
symmetric difference is at most h(b). The hash universe is cut into m(b)
segments, each with a capacity of one (its part of the set must agree) or two
(it may also differ by one token: the part's one-deletion neighbourhood is
indexed too). Capacities of at least h(b) + 1 mean that some segment matches
(pigeonhole). A cost model chooses segments and capacity by band: fewer large
segments with neighbourhoods for small sets, many small ones for large sets.

Signatures of parts without a telling token (empty, or only shingles that a
sample shows to be frequent) would meet in long lists. They are left out, and
m(b) has spare segments for that; a set with more such parts than spares
emits all of its signatures. Of any two linking sets either one has enough
telling parts, or both emit everything, so no link is lost: the sample and
the spares change costs, never results.

The allocation of a set to segments follows the cost of their lists as well: a
linking pair shares at least c = telling parts - h signatures, h for the set's
own size, so a set can do without c - 1 of its signatures and emits h + 1 of
them. Those of the largest parts go first, whose lists are shortest; since
that order depends on a part's content alone, the first signature that a
linking pair shares in it is emitted by both.

Equal sets are one class. Classes that share a signature are verified exactly
on their whole sets, in four steps that skip what is already connected: each
class with its most central partner; then with every bucket's most central
member, its hub; then the pairs of short buckets that are still in different
components and that neither the sets' support (tokens any other component has)
nor bitmaps of the two sets rule out; then those of long buckets, as
differences from one central set (``_pairs_by_difference``). Large groups of near
copies are thus joined through their centre instead of through all pairs, and
families of texts that are alike but not enough leave few pairs.

Defined results: null and empty texts and texts without words have no
shingles and link with nothing; a text of fewer than k words is one shingle;
repeated rows share a class; null ids count as documents and sort last; an
empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, release, sample_texts, stored, written
from .textops import Words, mix, shingles, slices

K = 4
PERCENT = 85
SAMPLE_ROWS = 2_000     # texts that show which shingles are frequent
FREQUENT = 5            # in how many of them a frequent shingle is, at least
SHORT_COST = 20.0       # a signature of one token or none costs as much as so many others
SURE_DIFFERENCE = 16    # from here on the signatures a set does without are allowed for
UNTELLING_COST = 200.0  # and one of an untelling part, which meets in long lists
FILTER_BITS = 24        # of the bitmap that tells which sets will be verified
SHORT_LIST = 32         # members of a bucket whose pairs are looked at one by one
BANDS = 4               # of f (see _pairs_by_difference) in the hub's allowance
BITMAP_BITS = 4         # per token, of the bitmaps that bound a pair's difference

_SEGMENT, _TOKEN, _CLASS, _BITMAP = (np.uint64(x) for x in (
    0x51ED270B, 0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47, 0xC2B2AE3D27D4EB4F))


@dataclass(frozen=True)
class Band:
    """Sizes low … high; segments m; capacity 1 or 2 each; untelling parts borne without loss."""

    low: int
    high: int
    difference: int
    segments: int
    capacity: int
    spare: int


def _allocate(low: int, high: int, difference: int) -> Band:
    """The cheaper of capacities 1 and 2, by signatures emitted and lists met."""
    best = None
    for capacity in (1, 2):
        need = -(-(difference + 1) // capacity)
        for segments in range(need, need + need // 4 + 5):
            part = low / segments
            weak = math.exp(-part) * (1 if capacity == 1 else 1 + part)
            deviation = math.sqrt(segments * weak * (1 - weak)) + 1e-9
            over = 0.5 * math.erfc((segments - need + 0.5 - segments * weak) / deviation / math.sqrt(2))
            signatures = segments * (1 if capacity == 1 else 1 + part)
            short = segments * math.exp(-part) * (1 + part)
            if capacity == 1 and difference >= SURE_DIFFERENCE:
                signatures = difference * low / high + 1
                short = max(0.0, short - (segments - signatures))
            cost = signatures + SHORT_COST * short + UNTELLING_COST * over * segments * weak
            band = Band(low, high, difference, segments, capacity, segments - need)
            if best is None or cost < best[0]:
                best = (cost, band)
    return best[1]


def bands(largest: int, percent: int = PERCENT) -> list[Band]:
    """Bands up to a set size; a linking partner is in the same band or a neighbouring one."""
    out, low = [], 1
    while not out or out[-1].high < largest:
        high = max(low, int(low * (100 / percent) ** 2))
        partner = high * 100 // percent
        out.append(_allocate(low, high, (100 - percent) * (high + partner) // (100 + percent)))
        low = high + 1
    return out


@dataclass
class Sets:
    """Distinct shingles of the texts of a slice: text t owns token[bounds[t]:bounds[t+1]], sorted."""

    token: np.ndarray
    text: np.ndarray
    bounds: np.ndarray
    cls: np.ndarray

    @property
    def size(self) -> np.ndarray:
        return np.diff(self.bounds)


def sets_of(words: Words, k: int = K) -> Sets:
    text, _, token = shingles(words, k, whole_if_short=True)
    order = np.argsort(token)
    small = text[order].astype(np.uint16 if words.n <= 0xFFFF else np.int64)
    order = order[np.argsort(small, kind="stable")]
    text, token = text[order], token[order]
    fresh = np.ones(len(token), dtype=bool)
    fresh[1:] = (token[1:] != token[:-1]) | (text[1:] != text[:-1])
    text, token = text[fresh], token[fresh]
    bounds = np.searchsorted(text, np.arange(words.n + 1))
    total = np.zeros(words.n, dtype=np.uint64)
    np.add.at(total, text, mix(token ^ _CLASS))
    cls = mix(total + np.diff(bounds).astype(np.uint64) * _CLASS).view(np.int64)
    return Sets(token, text, bounds, cls)


def signatures(sets: Sets, plan: list[Band], frequent: np.ndarray, chosen: np.ndarray,
               percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the chosen texts' sets, and the class of each."""
    highs = np.array([b.high for b in plan])
    own = np.searchsorted(highs, sets.size)
    segments, capacity, spare, difference = (np.array([getattr(b, x) for b in plan]) for x in (
        "segments", "capacity", "spare", "difference"))
    spot = mix(sets.token ^ _SEGMENT) >> np.uint64(32)
    value = mix(sets.token ^ _TOKEN)
    at = np.minimum(np.searchsorted(frequent, sets.token), max(len(frequent) - 1, 0))
    telling = frequent[at] != sets.token if len(frequent) else np.ones(len(value), dtype=bool)
    out_sig, out_cls = [], []
    for back in (0, 1):  # as the smaller set in its own band, as the larger in the one below
        band = own - back
        takes = chosen & (sets.size > 0) & (band >= 0)
        if back:
            takes &= percent * sets.size <= 100 * highs[np.maximum(band, 0)]
        band = np.maximum(band, 0)
        takes &= difference[band] > 0  # else only equal sets link
        if not takes.any():
            continue
        m = np.where(takes, segments[band], 0)
        first = np.concatenate(([0], np.cumsum(m)))
        mine = takes[sets.text]
        text, token_value, tells = sets.text[mine], value[mine], telling[mine]
        segment = ((spot[mine] * m[text].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        cell = first[text] + segment
        total = np.zeros(first[-1], dtype=np.uint64)
        np.add.at(total, cell, token_value)
        told = np.bincount(cell[tells], minlength=first[-1])
        owner = np.repeat(np.arange(len(m)), m)
        two = capacity[band][owner] == 2
        weak = np.bincount(owner[told < np.where(two, 2, 1)], minlength=len(m))
        everything = weak > spare[band]
        partner = highs[band] if back else sets.size * 100 // percent
        differs = (100 - percent) * (sets.size + partner) // (100 + percent)
        without = np.where((capacity[band] == 1) & ~everything,
                           np.maximum(m - weak - differs - 1, 0), 0)
        key = mix((band[owner].astype(np.uint64) << np.uint64(32))
                  + (np.arange(first[-1]) - first[owner]).astype(np.uint64) + _SEGMENT)
        emit = (told > 0) | everything[owner]
        value_of = mix(total + key)
        order = np.lexsort((value_of, -told, ~emit, owner))  # by text: telling parts, large ones first
        place = np.arange(len(order)) - first[owner[order]]
        goes = np.bincount(owner[emit], minlength=len(m)) - without
        emit[order] &= place < goes[owner[order]]
        out_sig.append(value_of[emit])
        out_cls.append(sets.cls[owner[emit]])
        near = two[cell]
        if near.any():  # one-deletion neighbourhoods
            cell, token_value, tells = cell[near], token_value[near], tells[near]
            emit = (told[cell] - tells > 0) | everything[owner[cell]]
            out_sig.append(mix(total[cell] - token_value + key[cell])[emit])
            out_cls.append(sets.cls[owner[cell[emit]]])
    if not out_sig:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_sig).view(np.int64), np.concatenate(out_cls)


def _frequent_shingles(documents: DataFrame, doc_id: str, text: str, k: int) -> np.ndarray:
    """Shingles that several of a bounded sample of texts hold; they steer costs alone."""
    texts = pa.array(sample_texts(documents, doc_id, text, SAMPLE_ROWS, 10_000), pa.string())
    tokens = [np.unique(sets.token[sets.bounds[t]:sets.bounds[t + 1]])
              for words in slices(texts) for sets in [sets_of(words, k)] for t in range(words.n)]
    if not tokens:
        return np.zeros(0, np.uint64)
    token, count = np.unique(np.concatenate(tokens), return_counts=True)
    return token[count >= FREQUENT]


def _signature_rows(documents: DataFrame, doc_id: str, text: str, k: int,
                    percent: int) -> DataFrame:
    """(sig, cls) of every class, at most once a task and signature."""
    frequent = documents.sparkSession.sparkContext.broadcast(
        _frequent_shingles(documents, doc_id, text, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        plan = bands(1 << 10, percent)
        for batch in batches:
            for words in slices(batch.column(0)):
                sets = sets_of(words, k)
                if sets.size.max(initial=0) > plan[-1].high:
                    plan = bands(int(sets.size.max()), percent)
                chosen = np.zeros(words.n, dtype=bool)
                for t, cls in enumerate(sets.cls.tolist()):
                    if cls not in seen:
                        seen.add(cls)
                        chosen[t] = True
                found = signatures(sets, plan, frequent.value, chosen, percent)
                yield pa.RecordBatch.from_arrays(list(map(pa.array, found)), names=["sig", "cls"])

    return documents.select(F.col(text)).mapInArrow(run, "sig long, cls long")


def _bitmap(classes: DataFrame) -> np.ndarray:
    """A bitmap of 2 ** FILTER_BITS bits (2 MB) with a bit for each class, by its low bits."""
    words = classes.selectExpr(
        f"shiftright(cls & {(1 << FILTER_BITS) - 1}, 6) as word",
        "shiftleft(1L, cast(cls & 63 as int)) as bit").groupBy("word").agg(
            F.bit_or("bit").alias("bits")).toPandas()
    bitmap = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    bitmap[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return bitmap


def _described(documents: DataFrame, doc_id: str, text: str, k: int, bitmap: np.ndarray) -> DataFrame:
    """doc_id, cls, n, and the set where the bitmap has its class (once a task)."""
    id_type = documents.select(doc_id).schema[0].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        wanted = shared.value
        for batch in batches:
            for words in slices(batch.column(1)):
                sets = sets_of(words, k)
                slot = sets.cls & ((1 << FILTER_BITS) - 1)
                hit = (wanted[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)
                tokens: list[np.ndarray | None] = [None] * words.n
                for t in np.flatnonzero((hit > 0) & (sets.size > 0)):
                    if int(sets.cls[t]) not in seen:
                        seen.add(int(sets.cls[t]))
                        tokens[t] = sets.token[sets.bounds[t]:sets.bounds[t + 1]].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(words.first, words.n), pa.array(sets.cls),
                     pa.array(sets.size.astype(np.int64)), pa.array(tokens, pa.list_(pa.int64()))],
                    names=["doc_id", "cls", "n", "tokens"])

    return documents.select(doc_id, text).mapInArrow(
        run, f"doc_id {id_type}, cls long, n long, tokens array<long>")


def _components(edges: DataFrame) -> DataFrame:
    """(node, comp) of the edges' (a, b) nodes; comp is the smallest node reachable.

    Every round each node takes its neighbours' least label and then that
    label's own label, so paths shorten by half; rounds grow with the
    logarithm of the longest path.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    # files, not checkpoints: those hand on size estimates that multiply with every round's joins
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.col("node")).alias("comp")).withColumn("old", F.col("node")), "labels")
    both = stored(both, "edges")
    while True:
        labels, last = labels.select("node", "comp"), labels
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(
            F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        taken = labels.join(near, "node").select(
            "node", F.col("comp").alias("old"), F.least("comp", "near").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("comp").alias("jump"))
        moved = stored(taken.join(jump, "via", "left").select(
            "node", F.least("via", F.coalesce("jump", "via")).alias("comp"), "old"), "labels")
        changed = moved.where("comp < old").limit(1).count()
        discard(last)
        labels = moved
        if not changed:
            discard(both)
            return labels.select("node", "comp")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs whose whole sets link."""
    left = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("ta", "tb"))
    return both.where(100 * common >= percent * (F.size("ta") + F.size("tb") - common)).select("a", "b")


def linked_classes(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K,
                   percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """``(described, labels)``: doc_id, cls, n of every document; (cls, comp) of candidate classes."""
    by_sig = Window.partitionBy("sig")
    met = lambda rows: rows.withColumn("low", F.min("cls").over(by_sig)).withColumn(
        "high", F.max("cls").over(by_sig)).where("low < high").drop("low", "high")
    rows = _signature_rows(documents, doc_id, text, k, percent).repartition("sig")
    met_rows = stored(met(rows).withColumn("members", F.count("*").over(by_sig)), "buckets")
    shared = met_rows.distinct()
    del rows
    release(documents.sparkSession)
    degree = shared.groupBy("cls").agg(F.sum("members").alias("degree"))
    classes = written(degree)
    whole = stored(_described(documents, doc_id, text, k, _bitmap(classes)), "sets")
    sets = stored(whole.where("tokens is not null").select("cls", "tokens").join(
        classes.select("cls"), "cls", "left_semi").groupBy("cls").agg(
            F.first("tokens").alias("tokens")), "class-sets")
    described = stored(whole.select("doc_id", "cls", "n"), "described")
    discard(whole)
    release(documents.sparkSession)
    sizes = sets.select("cls", F.size("tokens").alias("size"))
    shared = shared.select("sig", "cls").join(classes, "cls").join(sizes, "cls")
    central = F.max(F.struct("degree", F.col("cls").alias("id"), F.col("size").alias("n"))).over(by_sig)
    buckets = stored(shared.withColumn("top", central).select(
        "sig", "cls", "size", F.col("top.degree").alias("hub_degree"), F.col("top.id").alias("hub"),
        F.col("top.n").alias("hub_size")), "hubs")
    discard(met_rows)
    release(documents.sparkSession)
    fits = lambda x, y: (100 * F.least(x, y) >= percent * F.greatest(x, y))

    spokes = buckets.where(F.col("cls") != F.col("hub")).groupBy("cls", "hub").agg(
        F.first("hub_degree").alias("hub_degree"), F.first("size").alias("size"),
        F.first("hub_size").alias("hub_size"))
    spokes = written(spokes.where(fits(F.col("size"), F.col("hub_size"))))
    best = spokes.groupBy("cls").agg(F.max(F.struct("hub_degree", "hub")).alias("x"))
    central_of = classes.join(best, "cls", "left").select("cls", F.greatest(
        F.struct("degree", F.col("cls").alias("id")),
        F.coalesce(F.struct(F.col("x.hub_degree").alias("degree"), F.col("x.hub").alias("id")),
                   F.struct("degree", F.col("cls").alias("id")))).alias("central"))
    best = best.select(F.col("cls").alias("a"), F.col("x.hub").alias("b"))
    labels = classes.select("cls", F.col("cls").alias("comp"))
    labels = _merged(labels, _verified(best, sets, percent))

    def apart(pairs: DataFrame) -> DataFrame:
        """Pairs whose classes are in different components so far."""
        la = labels.select(F.col("cls").alias("a"), F.col("comp").alias("ca"))
        lb = labels.select(F.col("cls").alias("b"), F.col("comp").alias("cb"))
        return pairs.join(la, "a").join(lb, "b").where("ca <> cb").select("a", "b")

    others = spokes.select(F.col("cls").alias("a"), F.col("hub").alias("b")).join(
        best, ["a", "b"], "left_anti")
    labels = _merged(labels, _verified(apart(others), sets, percent))

    member = buckets.select("sig", "cls", "size", "hub").join(labels, "cls")
    split = member.groupBy("sig").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y")
    member = written(_supported(written(member.join(split.select("sig"), "sig", "left_semi")), sets, percent))
    listed = written(member.withColumn("members", F.count("*").over(by_sig)))
    short = listed.where(F.col("members") <= SHORT_LIST)
    rest = _pairs_of_short_lists(short, sets, percent)
    labels = _merged(labels, _verified(rest, sets, percent))
    long = listed.where(F.col("members") > SHORT_LIST).select("sig", "cls", "size")
    long = _with_reference(long, central_of).join(sets.select(
        F.col("cls").alias("hub"), F.size("tokens").alias("hub_size")), "hub")
    tried = long.where((F.col("cls") != F.col("hub")) & fits(F.col("size"), F.col("hub_size"))).select(
        F.col("cls").alias("a"), F.col("hub").alias("b"))
    labels = _merged(labels, _verified(apart(tried), sets, percent))
    long = long.join(labels, "cls")
    by_hub = Window.partitionBy("hub")
    long = long.withColumn("low", F.min("comp").over(by_hub)).withColumn("high", F.max("comp").over(by_hub)).where(
        "low < high").select("cls", "size", "hub", "comp")
    labels = _merged(labels, _verified(_pairs_by_difference(long, sets, percent), sets, percent))
    return described, labels


def _pairs_of_short_lists(member: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket that neither support nor bitmaps rule out; lists are at most SHORT_LIST long."""
    member = member.join(written(_bitmaps(member.select("cls").distinct(), sets, percent)), "cls")
    side = lambda x: member.select("sig", *[F.col(c).alias(f"{c}_{x}") for c in (
        "cls", "size", "comp", "support", "hub", "bits", "wide")])
    common, total = F.least("support_a", "support_b"), F.col("size_a") + F.col("size_b")
    return side("a").join(side("b"), "sig").where(
        (F.col("cls_a") < F.col("cls_b")) & (F.col("comp_a") != F.col("comp_b"))
        & (100 * common >= percent * (total - common))
        & (F.col("cls_a") != F.col("hub_a")) & (F.col("cls_b") != F.col("hub_b"))
        & _bitmaps_allow(total, percent)).select(
            F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).distinct()


def _bitmaps_allow(total: Column, percent: int) -> Column:
    """Whether the bitmaps (bits, wide; _a and _b) leave a link possible between sets of ``total`` tokens.

    Bitmaps of sets more than a length apart (percent below 50) bound nothing.
    """
    of = lambda x, y: F.when(F.size(f"bits_{x}") < F.size(f"bits_{y}"), F.col(f"wide_{x}")).otherwise(
        F.col(f"bits_{x}"))
    unlike = F.aggregate(F.zip_with(of("a", "b"), of("b", "a"), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                         F.lit(0), lambda n, x: n + x)
    return F.coalesce((100 + percent) * unlike <= (100 - percent) * total, F.lit(True))


def _with_reference(member: DataFrame, central_of: DataFrame) -> DataFrame:
    """Distinct (cls, size, hub): the most central partner of any member of a bucket is its reference.

    A family's buckets have many hubs of their own but nearly all one
    reference, so that a set is described by its difference once.
    """
    by_sig = Window.partitionBy("sig")
    return written(member.join(central_of, "cls").withColumn("top", F.max("central").over(by_sig)).select(
        "cls", "size", F.col("top.id").alias("hub")).distinct())


def _pairs_by_difference(member: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of long lists that can link although the list's reference doesn't connect them.

    Each set X is taken as its difference d(X) from the reference H, a hub that
    all sets of the list were tried with, as |A ^ B| =
    |d(A) ^ d(B)|. With f(X) = (100 + p) |d(X)| - (100 - p) |X|, two sets link
    exactly if f(A) + f(B) <= 2 (100 + p) |d(A) & d(B)|. No set's f is below
    the hub's, so where f(A) + f(B) <= 0 both link to the hub, which is known
    by now. All others need a common difference of t = (f(A) + f(B)) /
    (2 (100 + p)) tokens or more, at least one; so they share one of the first
    |d| - t + 1 tokens of either difference in any common order (prefix
    filter). Bitmaps rule out most pairs that share one by chance. The order is: tokens that the hub lacks, which few sets share,
    then the hub's own. f is cut into bands, so that t is known when a set
    emits its prefix for the partners of a band; a partner's f is within
    2 (100 - p) times the larger set.
    """
    up, down = 100 + percent, 100 - percent
    member = member.where(F.col("cls") != F.col("hub"))
    member = member.join(_bitmaps(member.select("cls").distinct(), sets, percent), "cls")
    tokens = lambda name, to: sets.select(F.col("cls").alias(name), F.col("tokens").alias(to))
    differing = member.join(tokens("cls", "own"), "cls").join(tokens("hub", "top"), "hub").select(
        "hub", "cls", "comp", "size", "bits", "wide", F.size("top").alias("hub_size"), F.concat(
            F.sort_array(F.array_except("own", "top")), F.sort_array(F.array_except("top", "own"))).alias("d"))
    f = F.lit(up) * F.size("d") - F.lit(down) * F.col("size")
    width = F.greatest(F.lit(1), F.floor(F.lit(down) * F.col("hub_size") / F.lit(BANDS)))
    differing = written(differing.withColumn("f", f).withColumn("width", width).withColumn(
        "own", F.floor(F.col("f") / F.col("width"))))
    reach = F.ceil(F.lit(2 * down) * F.ceil(F.col("size") * F.lit(100 / percent)) / F.col("width")) + 1
    there = differing.select("hub", F.col("own").alias("partner")).distinct()
    aimed = differing.withColumn("partner", F.explode(F.sequence(F.col("own") - reach, F.col("own") + reach))) \
        .join(there, ["hub", "partner"])
    # the least f of a partner in the band; it must lift the sum above 0, else the hub has joined the two
    needed = F.greatest(F.lit(1), F.ceil(
        (F.col("f") + F.col("partner") * F.col("width")) / F.lit(2 * up))).cast("int")
    facts = ["cls", "comp", "size", "f", "bits", "wide"]
    prefix = aimed.withColumn("needed", needed).where(
        (F.col("needed") <= F.size("d")) & (F.col("f") + (F.col("partner") + 1) * F.col("width") > 0)).select(
            "hub", "own", "partner", *facts, F.size("d").alias("n"),
            F.explode(F.slice(F.col("d"), F.lit(1), F.size("d") - F.col("needed") + 1)).alias("token"))
    keys = ["hub", "token", "own", "partner"]
    side = lambda x, own, partner: prefix.select(
        "hub", "token", F.col(own).alias("own"), F.col(partner).alias("partner"),
        *[F.col(c).alias(f"{c}_{x}") for c in [*facts, "n"]])
    total, both = F.col("f_a") + F.col("f_b"), F.col("size_a") + F.col("size_b")
    return side("a", "own", "partner").join(side("b", "partner", "own"), keys).where(
        (F.col("cls_a") < F.col("cls_b")) & (F.col("comp_a") != F.col("comp_b")) & (total > 0)
        & (total <= F.lit(2 * up) * F.least("n_a", "n_b"))
        & (100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b"))
        & _bitmaps_allow(both, percent)).select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).distinct()


def _supported(member: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Bucket members that can still link to another component, with their support.

    A set's support is how many of its tokens some set of another component
    holds, among the sets still in question: no intersection with such a set
    is larger. Near copies that each went their own way have little of it.
    """
    open_ = member.select("cls", "comp").distinct()
    by_token = Window.partitionBy("token")
    support = sets.join(open_, "cls").select("cls", "comp", F.explode("tokens").alias("token")) \
        .withColumn("low", F.min("comp").over(by_token)).withColumn("high", F.max("comp").over(by_token)) \
        .where("low < high").groupBy("cls").agg(F.count("*").alias("support"))
    able = member.join(support, "cls").where(100 * F.col("support") >= percent * F.col("size"))
    by_sig = Window.partitionBy("sig")
    return able.withColumn("low", F.min("comp").over(by_sig)).withColumn(
        "high", F.max("comp").over(by_sig)).where("low < high").drop("low", "high")


def _bitmap_of(token: np.ndarray, level: int) -> np.ndarray:
    """A hashed bitmap of BITMAP_BITS * 2 ** level bits, in words of 64."""
    words = max(1, (BITMAP_BITS << level) // 64)
    place = mix(token ^ _BITMAP) % np.uint64(64 * words)
    bits = np.zeros(words, dtype=np.uint64)
    np.bitwise_or.at(bits, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return bits.view(np.int64)


def _bitmaps(wanted: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(cls, bits, wide): hashed bitmaps of sets, as long as their size asks for.

    A bit that one set has and another lacks stands for at least one token of
    the difference, so two bitmaps bound the difference of their sets from
    below; at BITMAP_BITS bits a token or more the bound is close. Lengths
    double with the size; a set that can link to one of the next length has a
    bitmap of that length as well.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, wide = [], []
            for tokens in batch.column(1):
                token = tokens.values.to_numpy(zero_copy_only=False).view(np.uint64)
                level = len(token).bit_length()
                bits.append(_bitmap_of(token, level))
                near = 100 * len(token) >= percent * (1 << level) - 100
                wide.append(_bitmap_of(token, level + 1) if near else None)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bits, kind), pa.array(wide, kind)], names=["cls", "bits", "wide"])

    return wanted.join(sets, "cls").select("cls", "tokens").mapInArrow(
        run, "cls long, bits array<long>, wide array<long>")


def _merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels after the edges join components."""
    edges = written(edges)
    la = labels.select(F.col("cls").alias("a"), F.col("comp").alias("ca"))
    lb = labels.select(F.col("cls").alias("b"), F.col("comp").alias("cb"))
    between = edges.join(la, "a").join(lb, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    joined = _components(between).select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    labels = stored(labels.join(joined, "comp", "left").select(
        "cls", F.coalesce("to", "comp").alias("comp")), "labels")
    del edges, between, joined, la, lb
    release(labels.sparkSession)
    return labels


def jaccard_components(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       k: int = K, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (its least doc_id), cls."""
    described, labels = linked_classes(documents, doc_id, text, k, percent)
    rows = described.select("doc_id", "cls", "n").join(labels, "cls", "left").select(
        "doc_id", "cls", "n", F.coalesce("comp", "cls").alias("comp"))
    least = rows.where("n > 0").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "comp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"), "cls")
