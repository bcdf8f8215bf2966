import public_tokenizers
import pytest

from subpanel.llm import token_counts

from ..conftest import SF_SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")
HARD = ["", " ", "  \n\n a  b", "it's 'sx ''ll I'VE don't", "<|endoftext|> x <|endoftext|>", "x\x1c\x85y",
        "é² ½ ª  b", "中文 ок ok", "a" * 5000, "  …—“q”", "!!?? $5.00\t\r\n", "\U0001F600" * 3,
        "ǅ ſ İ", "'", " '", "' s", "­"]


@pytest.mark.parametrize("cache", [5, 1_000_000])
def test_lookup_counts_as_the_library_does(spark, cache):
    texts = HARD + [r[0] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()]
    counter = token_counts.Counter2Tier(PATH, {" the": 1, "a": 1}, cache_entries=cache)
    assert counter.count(texts) == counter.encode(texts)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_every_kind_of_file(docs_of, name):
    path = public_tokenizers.path(name)
    rows = token_counts.token_counts(docs_of(list(enumerate(HARD))), path, limit=3).collect()
    want = token_counts.Counter2Tier(path, {}).encode(HARD)
    assert [r["n_tokens"] for r in sorted(rows)] == want
    assert all(r["over_limit"] == (r["n_tokens"] > 3) and r["n_bytes"] == len(HARD[r["doc_id"]].encode())
               for r in rows)


def test_messy_and_empty(messy):
    rows = token_counts.token_counts(messy, PATH).collect()
    assert len(rows) == messy.count()
    assert all(r["n_tokens"] == 0 and r["n_bytes"] == 0 for r in rows if r["doc_id"] in (2, 3))
    assert token_counts.token_counts(messy.limit(0), PATH).count() == 0
