import hashlib
import math
import random
import re

from subpanel.llm import secrets

from ..conftest import SF_SMALL

BASE = {
    "assign": r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
              r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}


def brute(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            size, least = {"assign": (len(m[2]) if kind == "assign" else 0, 8),
                           "access": (len(m[0]), 16), "hex": (len(m[0]), 32)}[kind]
            if size >= least:
                out.append((m.start(), list(BASE).index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def test_base_spans_match_brute_force(spark, docs_of):
    hard = docs_of([(-1, "secret: token:12345678 Password='abcdefgh' ſecret=12345678 toKen=12345678"),
                    (-2, "AKIA AKIAABCDEFGHIJKL é" + "ab" * 16 + "g" + "0" * 31),
                    (-3, "token = short api_key:\"" + "f" * 40 + "\" apikey==x passwd=aaaaaaaa.")])
    docs = hard.select("doc_id", "text").union(
        spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text"))
    texts = {r[0]: r[1] for r in docs.collect()}
    found = secrets.scan_digest(docs).collect()
    assert len(found) == len(texts)
    for row in found:
        want = brute(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        kinds = [x.split(":")[0] for x in want.split(",") if x]
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == tuple(map(kinds.count, BASE))
        assert set(filter(None, want.split(","))) <= set(row["spans"].split(","))


def test_guess_cost_orders_weak_before_strong():
    weak = ["password", "password1234", "qwertyuiop", "2019-12-31", "aaaaaaaaaaaaaaa", "abcabcabcabc",
            "the-placeholder", "changeme123"]
    strong = ["zX9$kQ2!mW7p", "v8Qe-2Lr_7TzP0wd", "04dbebab91ab85687d33eeaaf9ac699e"]
    assert max(map(secrets.guess_log10, weak)) < secrets.MIN_LOG10 < min(map(secrets.guess_log10, strong))


def test_guess_cost_is_the_least_over_all_segmentations():
    # brute force of whole values can't be beaten by parts that aren't patterns
    assert abs(secrets.guess_log10("zqxj") - 4 * 1.414973347970818) < 1e-9
    assert secrets.guess_log10("dragonmonkey") < secrets.guess_log10("dragon") + 12 * 1.415


def test_context_values(docs_of):
    rows = {r["doc_id"]: r["spans"] for r in secrets.scan_digest(docs_of([
        (1, "Authorization: Bearer zX9$kQ2!mW7pL4"), (2, "pwd is changeme123"),
        (3, "her password was forgotten yesterday"), (4, "passphrase: v8Qe-2Lr_7TzP0wd."),
        (5, "token: abcdefghij")])).collect()}
    assert rows[1] == "guess:22:36" and rows[2] == "" and rows[3] == ""
    assert rows[4] == "guess:12:28" and rows[5] == "assign:0:17"


def test_messy_and_empty(messy):
    rows = secrets.scan_digest(messy).collect()
    assert len(rows) == messy.count()
    assert all(r["spans"] == "" and r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in rows)
    assert secrets.scan_digest(messy.limit(0)).count() == 0


def test_context_values_end_at_their_field():
    def guesses(text):
        return [text[x[3]:x[4]] for x in secrets.scan_text(text) if x[0] == "guess"]

    assert guesses('{"pwd":"zX9$kQ2!mW7p","token":"abcdefgh12"}') == ["zX9$kQ2!mW7p"]
    assert guesses("pwd=zX9$kQ2!mW7p&token=abcdefgh12") == ["zX9$kQ2!mW7p"]
    assert guesses('{"pwd":"short","passphrase":"zX9$kQ2!mW7p","pwd":"v8Qe-2Lr_7TzP0wd"}') == [
        "zX9$kQ2!mW7p", "v8Qe-2Lr_7TzP0wd"]
    assert guesses("pwd=zX9$kQ2!mW7p;passphrase=v8Qe-2Lr_7TzP0wd;x=1") == ["zX9$kQ2!mW7p", "v8Qe-2Lr_7TzP0wd"]
    # separators within a value don't cut it
    assert guesses("pwd: zX9$k&2,mW;7p") == ["zX9$k&2,mW;7p"]


def test_values_of_letters():
    def guesses(text):
        return [text[x[3]:x[4]] for x in secrets.scan_text(text) if x[0] == "guess"]

    assert guesses("pwd: QxZvKjWpRtLmNbGh") == ["QxZvKjWpRtLmNbGh"]
    assert guesses("Authorization: Bearer QxZvKjWpRtLmNbGh") == ["QxZvKjWpRtLmNbGh"]
    assert guesses("pwd=oxakitulorenabi") == ["oxakitulorenabi"]
    assert guesses("the pwd is unforgettable, of basic principles") == []
    assert guesses("pwd: changeme") == []


def enumerated(value):
    """Least cost over every segmentation of a short value, each part tried as every kind."""
    per_char = math.log10(secrets._alphabet(value))
    near = lambda part: all(map(secrets._adjacent, part, part[1:]))

    def parts(i, j):
        part, steps = value[i:j], {ord(b) - ord(a) for a, b in zip(value[i:j], value[i + 1:j], strict=False)}
        if len(part) >= 3 and steps == {0}:
            yield per_char + math.log10(len(part))
        if len(part) >= 3 and steps in ({1}, {-1}):
            yield per_char + math.log10(2 * len(part))
        if len(part) >= 4 and near(part):
            yield math.log10(47 * len(part) * 4.6) + 0.3 * len(part)
        if len(part) >= 2 and (cost := secrets._word_log10(part)) is not None:
            yield cost
        if len(part) >= 4 and secrets._DATE.fullmatch(part):
            yield math.log10(365.0 * 120 if len(part) > 4 else 120.0)

    def least(j):
        if j == 0:
            return 0.0
        best = least(j - 1) + per_char
        for i in range(j):
            for cost in parts(i, j):
                best = min(best, least(i) + cost + (math.log10(2) if i else 0.0))
            if j - i >= 2 and value[max(0, 2 * i - j):i] == value[i:j]:
                best = min(best, least(i) + math.log10(2))
        return best
    return least(len(value))


def test_guess_cost_equals_an_enumeration():
    rng = random.Random(6)
    values = ["dragonnnn", "dragonmlk", "mayyyy", "1999999", "redfgh", "test345", "abcdcba", "keyuiop", "oneeerty"]
    pieces = ["nnn", "abc", "321", "may", "red", "rty", "1999", "yui", "key", "x", "7", "ee", "dfgh", "aa"]
    values += ["".join(rng.choices(pieces, k=3))[:9] for _ in range(150)]
    for value in values:
        assert abs(secrets.guess_log10(value) - enumerated(value)) < 1e-9, value
    assert secrets.guess_log10("dragonnnn") < secrets.guess_log10("dragonqzx")
