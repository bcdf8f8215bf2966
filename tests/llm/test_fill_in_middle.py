import hashlib

from subpanel.llm import fill_in_middle as fim

from .conftest import LONG


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def whole(doc_id, text):
    """Output of one text, stated plainly."""
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return "plain", text, None, None
    if h4 % 100 < 20:
        return "spm", f"<S>{s}<P>{p}<M>{m}", a, b - a
    return "psm", f"<P>{p}<S>{s}<M>{m}", a, b - a


def test_digests_and_outputs_against_brute_force(spark, docs_of, monkeypatch):
    texts = ["", "x", "ab", "a<P>b", "<S>", "tail<", "<<P", "\U0001F600é中" * 40, LONG, "line\n\nline\x00", "S>M>P>"]
    rows = [(i, texts[i % len(texts)] + ("" if i < len(texts) else "~" * (i % 7))) for i in range(150)]
    docs = docs_of(rows + [(3, None), (None, "no id"), (7, "again"), (7, "again")])
    want = sorted(((i, len(t or ""), *whole(i, t or ""), sha(t or "")) for i, t, *_ in docs.collect()), key=repr)
    got = fim.digests(docs).collect()
    assert sorted(((r["doc_id"], r["n"], r["form"], r["output_sha256"], r["prefix_chars"], r["middle_chars"],
                    r["restored_sha256"]) for r in got), key=repr) == sorted(
        ((i, n, f, sha(out), a, m, back) for i, n, f, out, a, m, back in want), key=repr)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    outputs = sorted(((r["doc_id"], r["form"], r["output"]) for r in fim.fill_in_middle(docs).collect()), key=repr)
    assert outputs == sorted(((i, f, out) for i, _, f, out, *_ in want), key=repr)


def test_partition_layout_does_not_matter(spark, docs_of):
    docs = docs_of([(i, f"text {i} " * (i % 50)) for i in range(200)])
    one = sorted(map(tuple, fim.digests(docs.coalesce(1)).collect()))
    assert one == sorted(map(tuple, fim.digests(docs.repartition(7)).collect()))


def test_pieces_are_small_and_in_order(spark, docs_of):
    rows = fim.pieces(docs_of([(1, LONG), (2, LONG)])).collect()
    assert max(len(r["piece"]) for r in rows) <= fim.PIECE_CHARS
    assert len(rows) > 2 * len(LONG) // fim.PIECE_CHARS
    by_row = {}
    for r in rows:
        by_row.setdefault(r["row"], []).append(r["place"])
    assert all(p == list(range(len(p))) for p in by_row.values())


def test_messy_and_empty(messy):
    rows = fim.digests(messy).collect()
    assert len(rows) == messy.count()
    assert all(r["form"] == "plain" and r["n"] == 0 and r["output_sha256"] == sha("")
               for r in rows if r["doc_id"] in (2, 3))
    assert fim.digests(messy.limit(0)).count() == 0
