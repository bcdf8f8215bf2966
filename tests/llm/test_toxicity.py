import math

import numpy as np
import pandas as pd

from subpanel.llm import queries, toxicity


def test_neighbours_are_exact():
    rng = np.random.default_rng(4)
    vocabulary = np.sort(rng.integers(1, 2 ** 60, 50).astype(np.uint64))
    idf = rng.uniform(1, 5, 50)
    examples = pd.DataFrame([
        {"doc_id": i, "toxic": int(rng.random() < 0.3), "terms": np.sort(rng.choice(50, n, replace=False)),
         "counts": rng.integers(1, 6, n)} for i, n in enumerate(rng.integers(0, 8, 700))])
    index = toxicity.build_index(vocabulary, idf, examples, 0.3)
    kept = examples[examples["terms"].map(len) > 0].reset_index(drop=True)
    dense = np.zeros((len(kept), 50))
    for i, r in kept.iterrows():
        dense[i, r["terms"]] = (1 + np.log(r["counts"])) * idf[r["terms"]]
    dense /= np.sqrt((dense ** 2).sum(axis=1, keepdims=True))
    for _ in range(60):
        terms = np.sort(rng.choice(50, rng.integers(1, 9), replace=False))
        counts = rng.integers(1, 5, len(terms))
        query = np.zeros(50)
        query[terms] = (1 + np.log(counts)) * idf[terms]
        cosine = dense @ query / math.sqrt((query ** 2).sum())
        _, best = index.neighbours(terms, counts, k=25)
        want = np.sort(cosine[cosine > 0])[::-1][:25]
        np.testing.assert_allclose(best, want, atol=1e-12)


def test_isotonic_is_monotone_and_keeps_the_order():
    x, y = toxicity._isotonic(np.array([0.1, 0.2, 0.2, 0.5, 0.9]), np.array([0, 1, 0, 0, 1.0]))
    assert (np.diff(x) > 0).all() and (np.diff(y) >= 0).all() and y[0] > 0 and y[-1] < 1


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op5_toxicity(spark, sf).join(labels, "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(toxic) >= 0.6 * len(toxic) > 5 and sum(clean) <= 0.03 * len(clean)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_messy_and_empty(spark, messy):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1), (5, 0), (7, 0)],
                                   "doc_id long, toxic int")
    rows = toxicity.toxicity(messy, labels).collect()
    assert len(rows) == messy.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.toxicity(messy.limit(0), labels).count() == 0
    none = toxicity.toxicity(messy, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0}


def test_all_terms_take_part(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "HEAD", 8)
    plain = [f"w{i}x w{i}y w{i}z shared word{i % 3}" for i in range(12)]
    rows = [(i, x) for i, x in enumerate(plain)]
    # a copy of a toxic example of ordinary words; a long text that shares one term with an example
    rows += [(100, plain[4].upper()), (101, "w5x " + " ".join(f"other{i}" for i in range(60)))]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i == 4)) for i in range(12)], "doc_id long, toxic int")
    fitted = toxicity.train(documents, labels)
    got = {r["doc_id"]: r for r in toxicity.score(documents, fitted).collect()}
    assert got[100]["nearest_id"] == 4 and abs(got[100]["nearest_cosine"] - 1) < 1e-9
    assert got[101]["nearest_id"] == 5 and got[101]["nearest_cosine"] < 0.5


def test_postings_and_matrix_give_one_cosine(monkeypatch):
    rng = np.random.default_rng(8)
    idf = rng.uniform(1, 5, 60)
    examples = pd.DataFrame([
        {"doc_id": i, "toxic": 0, "terms": np.sort(rng.choice(60, n, replace=False)),
         "counts": rng.integers(1, 6, n)} for i, n in enumerate(rng.integers(1, 12, 300))])
    vocabulary = np.arange(60, dtype=np.uint64)
    whole = toxicity.build_index(vocabulary, idf, examples, 0.3)
    monkeypatch.setattr(toxicity, "HEAD", 5)
    split = toxicity.build_index(vocabulary, idf, examples, 0.3)
    for _ in range(40):
        terms = np.sort(rng.choice(60, 9, replace=False))
        counts = rng.integers(1, 5, 9)
        np.testing.assert_allclose(split.neighbours(terms, counts)[1], whole.neighbours(terms, counts)[1],
                                   atol=1e-12)


def test_own_votes_by_tasks(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TASK_EXAMPLES", 7)
    rng = np.random.default_rng(3)
    vocabulary = np.arange(1, 41, dtype=np.uint64)
    rows = [(int(i), int(rng.random() < 0.4), np.sort(rng.choice(40, n, replace=False)).tolist(),
             rng.integers(1, 5, n).tolist()) for i, n in enumerate(rng.integers(0, 9, 60))]
    index = toxicity.build_index(vocabulary, np.ones(40), pd.DataFrame(
        rows, columns=["doc_id", "toxic", "terms", "counts"]), 0.4)
    votes = toxicity.own_votes(spark, spark.sparkContext.broadcast(index), len(index.ids))
    place = {x: i for i, x in enumerate(index.ids)}
    want = [(index.vote(*index.neighbours(np.array(terms), np.array(counts), without=place[i])), t)
            for i, t, terms, counts in rows if terms]
    np.testing.assert_allclose(sorted(map(tuple, votes[["vote", "toxic"]].to_numpy())), sorted(want), atol=1e-12)


def test_blocks_are_skipped_and_neighbours_stay_exact(monkeypatch):
    monkeypatch.setattr(toxicity, "HEAD", 40)
    rng = np.random.default_rng(12)
    # 20 vocabularies that hardly meet, as languages do; each text takes its terms from one
    rows = []
    for i in range(2000):
        of = rng.integers(0, 20)
        terms = np.unique(np.concatenate((of * 30 + rng.choice(30, 8, replace=False), rng.choice(600, 1))))
        rows.append({"doc_id": i, "toxic": int(rng.random() < 0.1), "terms": terms,
                     "counts": rng.integers(1, 4, len(terms))})
    examples, idf = pd.DataFrame(rows), rng.uniform(1, 5, 600)
    index = toxicity.build_index(np.arange(600, dtype=np.uint64), idf, examples, 0.1)
    dense = np.zeros((2000, 600))
    for r in rows:
        dense[r["doc_id"], r["terms"]] = (1 + np.log(r["counts"])) * idf[r["terms"]]
    dense /= np.sqrt((dense ** 2).sum(axis=1, keepdims=True))
    for i in range(0, 2000, 40):
        ids, best = index.neighbours(rows[i]["terms"], rows[i]["counts"], without=index.ids.index(i))
        cosine = dense @ dense[i]
        cosine[i] = -1
        np.testing.assert_allclose(best, np.sort(cosine)[::-1][:25], atol=1e-12)
        np.testing.assert_allclose([cosine[index.ids[x]] for x in ids], best, atol=1e-12)
    assert 0 < index.visited < index.met


def _trained_scores(spark, texts, toxic):
    """Scores of texts 0, 1, ... of which all are labelled."""
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in range(len(texts))], "doc_id long, toxic int")
    fitted = toxicity.train(documents, labels)
    return fitted, {r["doc_id"]: r["score"] for r in toxicity.score(documents, fitted).collect()}


def test_one_toxic_label_of_many_equal_texts(spark):
    fitted, scores = _trained_scores(spark, ["the same words every time"] * 40, {7})
    index = fitted.index.value
    assert index.held.tolist() == [40] and index.toxic.tolist() == [1]
    assert all(x < toxicity.PREDICT_AT for x in scores.values())


def test_one_toxic_label_of_many_empty_texts(spark):
    fitted, scores = _trained_scores(spark, [""] * 39 + [None], {7})
    assert abs(fitted.index.value.none_rate - 1 / 40) < 1e-9
    assert all(abs(x - 1 / 40) < 1e-9 for x in scores.values())


def test_texts_that_merely_resemble_each_other_stay_apart(spark):
    base = " ".join(f"word{i}" for i in range(60))
    fitted, _ = _trained_scores(spark, [base, base + " more", base.upper(), base + " again"], {1})
    index = fitted.index.value
    assert sorted(zip(index.ids, index.held.tolist(), index.toxic.tolist(), strict=True)) == \
        [(0, 2, 0), (1, 1, 1), (3, 1, 0)]


def test_packed_index_equals_a_plain_one(spark):
    rng = np.random.default_rng(21)
    texts = [" ".join(f"t{x}" for x in rng.zipf(1.4, 30) % 300) for _ in range(200)]
    fitted, _ = _trained_scores(spark, texts, set(range(0, 200, 9)))
    index = fitted.index.value
    total = 0
    for place, doc in enumerate(index.ids):
        words = texts[doc].split()
        terms = words + ["$" + w[:4] for w in words if len(w) > 4]
        want = sorted(terms.count(t) for t in set(terms))
        at = np.flatnonzero(index.example == place)
        total += len(at)
        assert sorted(index.count[at].tolist()) == want
    assert total == len(index.example) == index.bounds[-1]
    held = index.rows_of[0]
    assert (held == np.diff(index.bounds)).all()


def test_a_label_has_no_part_in_its_own_weights():
    held, toxic = np.array([30.0, 30.0]), np.array([12.0, 1.0])
    index = toxicity.build_index(np.arange(2, dtype=np.uint64), np.ones(2), pd.DataFrame(
        [{"doc_id": i, "toxic": 0, "terms": [0, 1], "counts": [1, 1]} for i in range(3)]), 0.05)
    index.rows_of = held, toxic
    clean, bad = index.own_ratio
    whole = toxicity._relevance(held, toxic, 0.05)
    np.testing.assert_allclose(bad * whole, toxicity._relevance(held - 1, toxic - 1, 0.05))
    assert bad[0] < 1 < clean[0] and bad[1] == clean[1] == 1


def test_places_are_those_of_a_whole_search():
    rng = np.random.default_rng(6)
    wide = rng.integers(0, 2 ** 64, 3000, dtype=np.uint64)
    near = np.uint64(2 ** 63) + rng.integers(0, 500, 300).astype(np.uint64)  # all of equal first bits
    for vocabulary in (np.unique(wide), np.unique(near), np.unique(np.concatenate((wide, near))), wide[:1]):
        asked = np.concatenate((vocabulary, vocabulary + np.uint64(1), vocabulary - np.uint64(1),
                                rng.integers(0, 2 ** 64, 500, dtype=np.uint64),
                                np.array([0, 2 ** 64 - 1], dtype=np.uint64)))
        got = toxicity._places(vocabulary, toxicity._starts(vocabulary), asked)
        np.testing.assert_array_equal(got, np.searchsorted(vocabulary, asked))


def test_single_counts_lead_and_large_ones_keep_their_weight(monkeypatch):
    monkeypatch.setattr(toxicity, "HEAD", 3)
    rng = np.random.default_rng(15)
    for most, small in ((4, 1 << 16), (90_000, 1 << 16), (4, 2)):  # with and without a table of logarithms
        monkeypatch.setattr(toxicity, "SMALL", small)
        rows = [{"doc_id": i, "toxic": 0, "terms": np.sort(rng.choice(30, n, replace=False)),
                 "counts": rng.choice([1, 1, 2, most], n)} for i, n in enumerate(rng.integers(1, 12, 200))]
        index = toxicity.build_index(np.arange(30, dtype=np.uint64), rng.uniform(1, 5, 30), pd.DataFrame(rows), 0.3)
        for t in range(30):
            counts = index.count[index.bounds[t]:index.bounds[t + 1]]
            assert (counts[:index.single[t]] == 1).all() and (counts[index.single[t]:] > 1).all()
        dense = np.zeros((200, 30))
        for r in rows:
            dense[r["doc_id"], r["terms"]] = (1 + np.log(r["counts"])) * index.idf[r["terms"]]
        dense /= np.sqrt((dense ** 2).sum(axis=1, keepdims=True))
        for r in rows[::10]:
            cosine = dense @ dense[r["doc_id"]]
            np.testing.assert_allclose(index.neighbours(r["terms"], r["counts"])[1],
                                       np.sort(cosine[cosine > 0])[::-1][:25], atol=1e-12)
