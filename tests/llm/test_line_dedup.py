import hashlib

import numpy as np
import pytest

from subpanel.llm import line_dedup as ld


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def whole(rows, others=()):
    """Kept texts, stated plainly; others: further rows that count but aren't returned."""
    big = 1 << 63
    first = {}
    split = [(i, (t or "").split("\n")) for i, t in [*rows, *others]]
    key = lambda line: lower(line.strip("\x20\x09\x0a\x0b\x0c\x0d"))
    for i, lines in split:
        for line in lines:
            first[key(line)] = min(first.get(key(line), big), big - 1 if i is None else i)
    out = []
    for i, lines in split[:len(rows)]:
        mine = big - 1 if i is None else i
        keep = [x for x in lines if len(key(x)) < 10 or first[key(x)] >= mine]
        out.append((i, len(lines), len(lines) - len(keep), sha("\n".join(keep)), "\n".join(keep)))
    return sorted(out, key=repr)


def found(docs, index, **kw):
    return sorted((tuple(r) for r in ld.deduplicate(docs, index, **kw).collect()), key=repr)


def table(n=300, step=1):
    shared = [f"Shared passage number {j} of many" for j in range(12)]
    rows = []
    for i in range(0, n, step):
        lines = [f"own line of document {i} at {j}" for j in range(i % 4)]
        lines.insert(i % (len(lines) + 1), shared[i % 12] if i % 3 else "  THE hot LINE of a third of all\t")
        lines += ["short", "", "ÄÖÜ äöü", "中文" * 5 if i % 2 else "中文" * 4]
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("filter_bytes", [48 << 20, 0])
def test_whole_table_against_brute_force(docs_of, monkeypatch, filter_bytes):
    monkeypatch.setattr(ld, "FILTER_BYTES", filter_bytes)
    monkeypatch.setattr(ld, "SHARD_KEYS", 5)
    rows = table() + [(None, "own line of document 5 at 0\nnobody else has this"), (7, "THE HOT line OF a third of all"),
                      (7, "THE HOT line OF a third of all"), (-5, "shared passage number 4 of many\n\n x")]
    docs = docs_of(rows)
    index = ld.build(docs)
    assert found(docs, index) == whole(rows)
    assert found(docs, index, texts=False) == [r[:4] for r in whole(rows)]
    assert index.shards > 1 and index.filters.count() > 1


def test_insertions_and_deletions_are_reversible(docs_of, monkeypatch):
    monkeypatch.setattr(ld, "SHARD_KEYS", 5)
    old, new = table(step=2), [r for r in table() if r[0] % 2] + [(-1, "the hot line of a third of all\nown line of document 2 at 0")]
    base = ld.build(docs_of(old))
    grown = ld.insert(base, docs_of(new))
    assert found(docs_of(old + new), grown) == whole(old + new)
    assert found(docs_of(old), grown) == whole(old, new)
    back = ld.delete(grown, docs_of(new).select("doc_id"))
    assert found(docs_of(old), back) == whole(old)
    for name, key in (("references", ("k1", "k2", "id")), ("shared", ("k1", "k2"))):
        same = [sorted(map(tuple, getattr(x, name).collect())) for x in (base, back)]
        assert same[0] == same[1], name
    # every shared key and none that was taken out is in its filter
    tables = {r["shard"]: ld.CuckooFilter(r["buckets"], bytes(r["bytes"])) for r in back.filters.collect()}
    for r in back.shared.collect():
        assert tables[r["k1"] % back.shards].holds(np.array([r["k2"]]))[0]
    assert sum(int((t > 0).sum()) for f in tables.values() for t in f.tables) == back.shared.count()
    least = ld.delete(base, docs_of([(0, "")]).select("doc_id"))     # the least holder goes: the next one keeps the line
    assert found(docs_of(old[1:]), least) == whole(old[1:])


@pytest.mark.parametrize("keys, laid_out", [(0, 10), (1, 10), (20_000, 20_000), (3000, 100)])
def test_cuckoo_filter(keys, laid_out):
    rng = np.random.default_rng(keys)
    k2 = rng.integers(-1 << 62, 1 << 62, keys)
    f = ld.CuckooFilter.for_keys(laid_out)
    f.insert(k2)
    f = ld.CuckooFilter(f.buckets, f.bytes())
    assert f.holds(k2).all()
    other = rng.integers(-1 << 62, 1 << 62, 50_000)
    assert f.holds(other).mean() < 0.0002 * max(1, len(f.tables))
    f.delete(k2[::2])
    assert f.holds(k2[1::2]).all() and f.holds(k2[::2]).sum() <= 0.01 * keys
    f.insert(k2[::2])
    assert f.holds(k2).all() and sum(int((t > 0).sum()) for t in f.tables) == keys
    f.delete(k2)
    assert not f.tables


def test_equal_fingerprints_are_counted():
    f = ld.CuckooFilter.for_keys(10)
    f.insert(np.array([77] * 11))
    f.delete(np.array([77] * 10))
    assert f.holds(np.array([77]))[0]
    f.delete(np.array([77]))
    assert not f.holds(np.array([77]))[0]
    with pytest.raises(KeyError):
        f.delete(np.array([77]))


def test_messy_and_empty(messy):
    index = ld.build(messy)
    assert found(messy, index) == whole([tuple(r) for r in messy.select("doc_id", "text").collect()])
    none = ld.build(messy.limit(0))
    assert ld.deduplicate(messy.limit(0), none).count() == 0
    assert found(messy, ld.insert(none, messy)) == found(messy, index)
