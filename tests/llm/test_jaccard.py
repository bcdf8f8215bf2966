import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from subpanel.llm import jaccard
from subpanel.llm.textops import slices

from ..conftest import SF_SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if 0 < len(words) < k:
        return {tuple(words)}
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, percent):
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, j in {p for h in holders.values() for p in itertools.combinations(h, 2)}:
        if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = defaultdict(list)
    for i, s in enumerate(sets):
        groups[root(i) if s else ("none", i)].append(rows[i][0])
    return {rows[i][0]: (len(s), min(groups[root(i) if s else ("none", i)])) for i, s in enumerate(sets)}


def near_copies(seed):
    """Families of near copies of many sizes, edited around the threshold, and chains."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for size in [1, 2, 3, 4, 5, 7, 9, 12, 16, 22, 30, 45, 60, 90, 140, 200, 320]:
        base = rng.choices(vocabulary, k=size)
        for copy in range(12):
            words = list(base)
            for _ in range(rng.randrange(0, 2 + size // 25)):
                at = rng.randrange(len(words))
                words[at:at + rng.randrange(0, 2)] = rng.choices(vocabulary, k=rng.randrange(0, 3))
            if copy % 4 == 3:
                words += rng.choices(vocabulary, k=max(1, size // 12))
                base = words  # drifts on
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,percent,short", [(4, 85, 32), (5, 80, 32), (5, 80, 1), (4, 85, 0), (3, 40, 32), (3, 40, 2)])
def test_components_match_brute_force(docs_of, monkeypatch, k, percent, short):
    monkeypatch.setattr(jaccard, "SHORT_LIST", short)
    rows = near_copies(k)
    got = jaccard.jaccard_components(docs_of(rows), k=k, percent=percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows, k, percent)


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in jaccard.jaccard_components(docs).collect()}
    assert got == brute([tuple(r) for r in docs.collect()], 4, 85)


def test_linking_sets_share_a_signature_whatever_is_frequent():
    rng = np.random.default_rng(3)
    for trial in range(150):
        n = int(rng.integers(2, 400))
        words = [f"t{x}" for x in rng.integers(0, 10 ** 6, n + 3)]
        texts = [" ".join(words), " ".join(words[int(rng.integers(0, 2)):len(words) - int(rng.integers(0, n // 14 + 2))])]
        (w,) = slices(pa.array(texts))
        sets = jaccard.sets_of(w)
        a, b = (set(sets.token[sets.bounds[t]:sets.bounds[t + 1]].tolist()) for t in (0, 1))
        if a == b or not a or not b or 100 * len(a & b) < 85 * len(a | b):
            continue
        frequent = np.sort(rng.choice(sets.token, len(sets.token) // 3))
        sig, cls = jaccard.signatures(sets, jaccard.bands(1000), frequent, np.ones(2, bool))
        first, second = (set(sig[cls == c].tolist()) for c in sets.cls.tolist())
        assert first & second


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(6)
    for _ in range(100):
        pool = rng.integers(0, 2 ** 63, 300).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(2))
        level = max(len(a), len(b)).bit_length()
        both = jaccard._bitmap_of(a, level) ^ jaccard._bitmap_of(b, level)
        unlike = np.bitwise_count(both.view(np.uint64)).sum()
        assert unlike <= len(np.setxor1d(a, b))


def test_bands_keep_the_pigeonhole():
    for band in jaccard.bands(20_000):
        assert (band.segments - band.spare) * band.capacity >= band.difference + 1
        partner = band.high * 100 // 85
        worst = max(a + b - 2 * -(-85 * (a + b) // 185) for a in (band.high,) for b in range(a, partner + 1))
        assert worst <= band.difference


def test_large_family_of_near_copies(docs_of):
    rng = random.Random(9)
    base = [f"v{i}" for i in range(160)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(rng.randrange(1, 9)):
            words[rng.randrange(160)] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    got = jaccard.jaccard_components(docs_of(rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows, 4, 85)


def test_pairs_by_difference_leave_no_link_out(spark):
    """Of sets about a hub, every link between sets that the hub doesn't join is among the pairs."""
    rng = random.Random(4)
    for percent in (85, 80, 60):
        hub = frozenset(range(100))
        sets = {0: hub}
        for i in range(1, 120):
            base = sets[rng.randrange(i)]
            gone = set(rng.sample(sorted(base), rng.randrange(0, 14)))
            sets[i] = frozenset(base - gone | {rng.randrange(1000, 1400) for _ in range(rng.randrange(0, 14))})
        frame = spark.createDataFrame([(i, list(s)) for i, s in sets.items()], "cls long, tokens array<long>")
        member = spark.createDataFrame([(i, len(s), 0, i) for i, s in sets.items()], "cls long, size int, hub long, comp long")
        pairs = {tuple(r) for r in jaccard._pairs_by_difference(member, frame, percent).collect()}
        link = lambda a, b: 100 * len(a & b) >= percent * len(a | b)
        need = {(i, j) for i, j in itertools.combinations(range(1, 120), 2) if link(sets[i], sets[j])
                and not (link(sets[i], hub) and link(sets[j], hub))}
        assert need and need <= pairs
        if percent == 85:
            assert len(pairs) < 0.2 * 120 * 119 / 2


def test_messy_and_empty(messy):
    rows = jaccard.jaccard_components(messy).collect()
    assert len(rows) == messy.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["component_id"] == 1 and by_id[3]["n_shingles"] == 0 == by_id[4]["n_shingles"]
    assert by_id[3]["component_id"] == 3 and by_id[5]["n_shingles"] == 5
    assert jaccard.jaccard_components(messy.limit(0)).count() == 0
