from collections import Counter

import pytest

import corpus_pipeline

from ..conftest import SF_SMALL
from .test_decontamination import levenshtein_fit
from .test_jaccard import brute


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1][1], SF_SMALL).write.parquet(str(folder / name))
        out.append((name, spark.read.parquet(str(folder / name))))
    return dict(out)


def test_columns_and_order(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "decontamination", "mixing", "sharding"]
    for name in ["documents", *names[:-1]]:
        assert stages[name].columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_rejects_texts_without_letters_alone(stages):
    kept = {r["doc_id"] for r in stages["language"].collect()}
    for r in stages["documents"].collect():
        assert (r["doc_id"] in kept) == any(c.isalpha() for c in r["text"] or "")


def test_one_of_each_group_stays(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages["language"].collect()]
    want = {d for d, (n, least) in brute(rows, 5, 80).items() if n == 0 or d == least}
    assert {r["doc_id"] for r in stages["near_duplicates"].collect()} == want


def test_documents_with_benchmark_items_go(stages, spark):
    import re

    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in stages["decontamination"].collect()}
    for r in stages["near_duplicates"].collect():
        own = words(r["text"])
        near = [i for i in items if len(i) >= 6 and any(tuple(i[k:k + 3]) in set(zip(own, own[1:], own[2:]))
                                                       for k in range(len(i) - 2))]
        found = any(levenshtein_fit(i, own) <= int(0.2 * len(i)) for i in near) if len(own) < 2_000 else \
            any(" ".join(i) in " ".join(own) for i in near)
        assert (r["doc_id"] not in kept) == found or len(own) >= 2_000


def test_mixed_rows_are_whole_copies_and_sharded(stages):
    before = {r["doc_id"] for r in stages["decontamination"].collect()}
    after = Counter(r["doc_id"] for r in stages["mixing"].collect())
    assert set(after) <= before and set(after.values()) <= {1, 2}
    shards = stages["sharding"].collect()
    assert Counter(r["doc_id"] for r in shards) == after
    assert len({(r["shard"], r["slot"]) for r in shards}) == len(shards)


def test_messy_rows_pass_all_stages(spark, messy, tmp_path):
    docs = messy.select("doc_id", "text", "lang", "source", "n_chars", "score", "cls", "shard")
    spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id long, text string") \
        .write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert name == "sharding" or docs.columns == columns
    assert Counter(r["doc_id"] for r in docs.collect())[1] in (1, 2)


def test_empty_tables(spark, messy, tmp_path):
    messy.select("doc_id", "text", "lang", "source", "n_chars").limit(0).write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_language_stage_decides_by_the_prediction(spark, docs_of, monkeypatch):
    en = "the cat sat on the mat and looked at the dog that was in the house with the other one "
    de = "der hund lag auf der matte und sah die katze an die mit der anderen im haus war und schlief "
    rows = [(i, (en if i % 2 else de) * 2 + f"{i}", "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, "the dog and the cat in the house", None), (101, "die katze und der hund im haus", None),
             (102, "中文中文中文", None), (103, "12345 !!", None), (104, None, None)]
    docs = docs_of(rows)
    kept = {r["doc_id"] for r in corpus_pipeline.language_stage(spark, docs, "").collect()}
    assert kept == {*range(60), 100, 101}
    monkeypatch.setattr(corpus_pipeline, "LANGUAGES", ("en",))
    assert {r["doc_id"] for r in corpus_pipeline.language_stage(spark, docs, "").collect()} == {*range(1, 60, 2), 100}


def test_unlabelled_corpora_pass_the_language_stage(spark, docs_of):
    docs = docs_of([(i, f"some english text number {i}", None) for i in range(5)] + [(9, None, "en"), (10, "12", "en")])
    assert corpus_pipeline.language_stage(spark, docs, "").count() == 7
