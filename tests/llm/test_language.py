import numpy as np

from subpanel.llm import language, queries


def naive_phrases(sample, text):
    """Greedy longest substrings of the sample; a symbol it lacks is a phrase."""
    at = count = 0
    while at < len(text):
        size = 0
        while at + size < len(text) and text[at:at + size + 1] in sample:
            size += 1
        at, count = at + max(size, 1), count + 1
    return count


def test_phrases_match_naive_parsing():
    rng = np.random.default_rng(1)
    samples = {"x": "".join(rng.choice(list("abc "), 300)), "y": "".join(rng.choice(list("abd "), 300))}
    parser = language.build_parser(samples)
    parser_table = np.zeros(0x110000, dtype=np.int32)
    parser_table[parser.alphabet] = np.arange(1, parser.width)
    texts = ["".join(rng.choice(list("abcde "), n)) for n in (1, 2, 17, 60, 300)]
    got = language.phrase_counts(parser, [parser_table[language.symbols_of(t)] for t in texts])
    for row, text in zip(got, texts, strict=True):
        # a symbol no sample has ends the phrase before it and begins one of its own
        assert list(row) == [naive_phrases(samples[x], text) for x in ("x", "y")], text


def test_pieces_are_whole_texts():
    parser = language.build_parser({"en": "the cat sat on the mat and the dog " * 30,
                                    "de": "der hund und die katze auf dem stuhl " * 30})
    labels, scores = language.identify(parser, ["the dog sat " * 500 + "der", None, "12", "die katze"],
                                       piece=64, lanes=16)
    assert labels == ["en", "und", "und", "de"] and scores[1] == 0.0 and 0.5 < scores[0] <= 1


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op9_language_id(spark, sf).join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where(
            "held_out and lang is not null").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.95 * len(rows) > 200


def test_messy_and_empty(messy):
    rows = language.identify_languages(messy, messy).collect()
    assert len(rows) == messy.count()
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (2, 3, 4, 6)} == {"und"}
    assert {r["lang_pred"] for r in rows} <= {"en", "tr", "und"}
    assert language.identify_languages(messy.limit(0), messy).count() == 0
    nothing = language.identify_languages(messy, messy.limit(0)).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


def test_a_language_of_one_sentence_weakens_itself_alone(docs_of):
    rng = np.random.default_rng(2)
    words = {"en": "the cat sat on mat and dog with house river stone which under never".split(),
             "de": "der hund und die katze auf dem stuhl nicht haus fluss stein welche unter".split()}
    rows = [(i, " ".join(rng.choice(words[x], 30)), x) for i, x in enumerate(["en", "de"] * 40)]
    training = docs_of([*rows, (1000, "bu kedi çok iyi", "tr")])
    new = [(i, " ".join(rng.choice(words[x], 12)), x) for i, x in enumerate(["en", "de"] * 40, 2000)]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify_languages(docs_of(new), training).collect()}
    assert got == {i: x for i, _, x in new}
    samples = language.training_samples(training)
    parser = language.build_parser(samples)
    assert language.identify(parser, ["bu kedi çok iyi"])[0] == ["tr"]
    assert language.identify(parser, ["жж шш"])[0] == ["de"]  # no known letter: a tie
