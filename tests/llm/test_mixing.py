import random
import re

import pytest

from subpanel.llm import mixing

from ..conftest import SF_SMALL


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Water filling in rounds: sources above their limit stop there, the excess is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        per = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if per * weight[s] >= most * sizes[s]}
        if not full:
            return out | {s: per * weight[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def check(rows, source_of, near):
    sizes, taken = {}, {}
    for r in rows:
        s = source_of[r["doc_id"]]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    want = targets(sizes)
    for r in rows:
        s = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s], rel=1e-9)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= near * max(want[s], 1) + 5, (s, taken[s], want[s])


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source")
    rows = mixing.mix(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"]: r["size"] for r in rows} == {
        d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in texts.items()}
    check(rows, {r["doc_id"]: r["source"] for r in docs.collect()}, 0.05)


def test_hot_source_cells_and_reruns(docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "RANK_ROWS", 50)  # cells are ranked in parts
    rng = random.Random(2)
    rows = [(i, "w " * (30 if i % 3 == 0 else rng.randrange(1, 200)), None,
             "hot" if i % 3 == 0 else f"s{i % 7}" if i % 5 else None) for i in range(2000)]
    docs = docs_of(rows)
    got = mixing.mix(docs).collect()
    check(got, {r[0]: r[3] for r in rows}, 0.01)
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}


def test_rates_tilt_exponentially(spark, docs_of):
    # below its own size a source gives its long documents up first
    rows = [(i, "w " * (1 + i % 100), None, "a" if i < 3000 else "b") for i in range(3300)]
    got = {r["doc_id"]: r["copies"] for r in mixing.mix(docs_of(rows), weights=(1, 20)).collect()}
    short = [got[i] for i in range(3000) if i % 100 < 20]
    long = [got[i] for i in range(3000) if i % 100 >= 80]
    assert sum(short) / len(short) != sum(long) / len(long)


def test_messy_and_empty(messy):
    rows = mixing.mix(messy).collect()
    assert len(rows) == messy.count()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert mixing.mix(messy.limit(0)).count() == 0
    only_empty = mixing.mix(messy.where("text is null or text = ''")).collect()
    assert all(r["taken"] == 0 and r["target"] == 0 for r in only_empty)
