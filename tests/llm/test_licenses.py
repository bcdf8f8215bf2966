from subpanel.llm import licenses


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_places_labels_and_edits(docs_of):
    rows = by_id(licenses.scan(docs_of([
        (1, "Released under the MIT License. And again: UNDER THE MIT-LICENSE!"),
        (2, "under the very mit license"),
        (3, "Licensed under the Apache License, Version 2.0 (the text)"),
        (4, "x " * 30 + "you can redistribute it and or modify it all under the terms of the gnu general "
            "public license as published by the free software foundation" + " y" * 30),
        (5, "cc by nc cc by nc"), (6, "permission to use is fine"),
        (7, "you can redistribute it as published by the free software foundation")])))
    assert (rows[1]["n_base"], rows[1]["first_word"], rows[1]["last_word"]) == (2, 1, 7)
    assert rows[1]["base_labels"] == rows[1]["labels"] == "mit" and rows[1]["score"] == 1.0
    assert rows[2]["n_base"] == 0 and rows[2]["labels"] == "" and rows[2]["first_word"] is None
    assert rows[3]["base_labels"] == "apache-2" and rows[3]["first_word"] == 3
    assert rows[4]["labels"] == "gpl" and rows[4]["base_labels"] == "" and 0.8 <= rows[4]["score"] <= 1
    assert rows[5]["n_base"] == 2 and rows[5]["last_word"] == 3
    assert rows[6]["labels"] == "" and rows[6]["score"] == 0.0
    assert rows[7]["labels"] == ""


def test_kelvin_sign_is_no_k(docs_of):
    words = docs_of([(1, "AKB K É")]).select(licenses.words_of(licenses.F.col("text"))).first()[0]
    assert words == ["aKb", "k", "É"]


def test_messy_and_empty(messy):
    rows = licenses.scan(messy).collect()
    assert len(rows) == messy.count() and all(r["labels"] == "" and r["n_base"] == 0 for r in rows)
    assert sorted(r["n_words"] for r in rows)[-1] == 100_000
    assert licenses.scan(messy.limit(0)).count() == 0
