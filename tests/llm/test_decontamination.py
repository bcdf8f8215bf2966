import random

import numpy as np
import pytest

from subpanel.llm import decontamination as d

WORDS = [a + b for a in "ba be bi bo bu da de di do du".split() for b in "na ne ni no nu ra re ri ro ru".split()]


def edited(words, edits, rng):
    out = list(words)
    for _ in range(edits):
        at, what = rng.randrange(len(out)), rng.random()
        if what < 0.34:
            out[at] = rng.choice(WORDS)
        elif what < 0.67:
            out.insert(at, rng.choice(WORDS))
        else:
            out.pop(at)
    return out


def levenshtein_fit(item, region):
    cost = [0] * (len(region) + 1)
    for i, w in enumerate(item, 1):
        last, cost[0] = cost[0], i
        for j, x in enumerate(region, 1):
            last, cost[j] = cost[j], min(cost[j] + 1, cost[j - 1] + 1, last + (w != x))
    return min(cost)


def test_fit_distance_is_exact():
    rng = random.Random(5)
    for _ in range(200):
        item = np.array([rng.randrange(6) for _ in range(rng.randrange(1, 12))])
        region = np.array([rng.randrange(6) for _ in range(rng.randrange(0, 20))])
        cost, a, b = d.fit_distance(item, region)
        assert cost == levenshtein_fit(item, region)
        whole = [0, *range(1, len(item) + 1)]  # the run that is named has that distance itself
        for j in range(a, b):
            last, whole[0] = whole[0], whole[0] + 1
            for i in range(1, len(item) + 1):
                last, whole[i] = whole[i], min(whole[i] + 1, whole[i - 1] + 1,
                                               last + (item[i - 1] != region[j]))
        assert whole[-1] == cost


@pytest.fixture(scope="module")
def planted(spark, docs_of):
    rng = random.Random(11)
    items = [(i, " ".join(rng.choices(WORDS, k=rng.randrange(15, 50)))) for i in range(30)]
    docs = []
    for i in range(300):
        around = [rng.choices(WORDS, k=rng.randrange(0, 60)) for _ in range(2)]
        body = edited(items[i % 30][1].split(), int(0.3 * (i % 7) / 6 * len(items[i % 30][1].split())), rng) \
            if i % 2 else []
        docs.append((i, " ".join(around[0] + body + around[1]).capitalize() + "."))
    return items, docs, spark.createDataFrame(items, "item_id long, text string"), docs_of(docs)


def test_recall_against_brute_force(planted):
    items, docs, benchmark, frame = planted
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in d.contaminated_pairs(frame, benchmark).collect()}
    want = {}
    for i, text in docs:
        words = text.lower().rstrip(".").split()
        for item, passage in items:
            n = len(passage.split())
            cost = levenshtein_fit(passage.split(), words)
            if cost <= int(d.MAX_EDITS * n):
                want[i, item] = cost
    assert set(got) <= set(want) and all(got[k] >= want[k] for k in got)
    assert len(got) >= 0.95 * len(want) > 50
    exact = {k for k, cost in want.items() if cost == 0}
    assert exact and exact <= set(got)


def test_clean_rows_stay(planted):
    _, docs, benchmark, frame = planted
    dirty = {r["doc_id"] for r in d.contaminated_pairs(frame, benchmark).collect()}
    left = d.decontaminated(frame, benchmark)
    assert left.columns == frame.columns
    assert {r["doc_id"] for r in left.collect()} == {i for i, _ in docs} - dirty


def test_large_benchmark_takes_more_passes(planted, monkeypatch):
    _, _, benchmark, frame = planted
    pairs = lambda: {tuple(r) for r in d.contaminated_pairs(frame, benchmark).collect()}
    whole = pairs()
    monkeypatch.setattr(d, "PART_WORDS", 1_000)
    assert pairs() == whole


def test_messy_and_empty(spark, messy, planted):
    _, _, benchmark, frame = planted
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "the quick brown fox jumps over the lazy dog"),
                                 (3, "one two"), (4, "the quick brown fox jumps over the lazy dog")],
                                "item_id long, text string")
    rows = d.contaminated_pairs(messy, odd).collect()
    assert sorted((r["doc_id"], r["item_id"] or 0) for r in rows) == [(1, 0), (1, 0), (1, 4), (1, 4)]
    assert d.decontaminated(messy, odd).count() == messy.count() - 2
    assert d.contaminated_pairs(messy, odd.limit(0)).count() == 0
    assert d.contaminated_pairs(messy.limit(0), odd).count() == 0


def test_scripts_without_blanks(spark, docs_of):
    benchmark = spark.createDataFrame([(1, "光合作用把二氧化碳和水变成糖和氧气。"),
                                       (2, "ภาษาไทยไม่มีช่องว่างระหว่างคำ")], "item_id long, text string")
    documents = docs_of([(1, "问题：光合作用把二氧化碳和水变成糖和氧气，对吗？"), (2, "天气很好，我们去公园散步，然后回家吃饭。"),
                         (3, "เขาพูดว่าภาษาไทยไม่มีช่องว่างระหว่างคำเสมอ"), (4, "x光合作用把二氧化碳及水变成糖和氧气x")])
    rows = d.contaminated_pairs(documents, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"], r["edits"]) for r in rows) == [(1, 1, 0), (3, 2, 0), (4, 1, 1)]
    assert {r["doc_id"] for r in d.decontaminated(documents, benchmark).collect()} == {2}


def test_short_items_against_brute_force(spark, docs_of):
    rng = random.Random(9)
    few = WORDS[:3]
    items = [(i, " ".join(rng.choices(few, k=1 + i % 5))) for i in range(25)]
    docs = [(i, " ".join(rng.choices(few, k=rng.randrange(0, 14)))) for i in range(60)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for least in (1, 3):
        got = {(r["doc_id"], r["item_id"]): r["edits"]
               for r in d.contaminated_pairs(docs_of(docs), benchmark, least_words=least).collect()}
        want = {(i, item): cost for i, text in docs for item, passage in items
                if len(passage.split()) >= least
                and (cost := levenshtein_fit(passage.split(), text.split())) <= int(d.MAX_EDITS * len(passage.split()))}
        assert got == want and len(want) > 50
