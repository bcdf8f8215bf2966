"""Secret scan with password guess costs (operator 1).

Pattern secrets (assignments, access keys, long hex runs) are found in every
whole text. The method adds values that stand in a wider credential context
("pwd is …", "Authorization: Bearer …", "--password …") and would be hard to
guess: a dynamic program finds each value's cheapest segmentation into
dictionary words, dates, repeats, keyboard walks, sequences and brute-force
spans; the product of the parts' guesses (times the orders of that many parts)
is the number of guesses an attacker needs. A value is a secret from
``MIN_LOG10`` on.

Offsets are code points, ends exclusive. Kinds: assign, access, hex, and
``guess`` for the method's own spans; a guess that overlaps a base span isn't
listed again. Each kind's matches are leftmost, without overlap; failing
matches are dropped after matching. A context value ends at its closing quote,
before a separator that another field's name follows, or at the next blank; the
search goes on right behind it. The guess cost alone decides on it, except
that letters that read like words ("password is unforgettable", "basic
principles") are no secret where only a blank stands before them.

Defined results: null and empty texts hold nothing; each input row gives one
output row (repeated rows and null ids too); an empty table gives an empty
result; other columns aren't read. Values of any length are scored: the
program looks back at most ``WINDOW`` characters for one part (and at the
whole of a longer repeat, sequence or walk), so its work and memory per value
grow only in proportion to its length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "guess")
MIN_LOG10 = 10.0   # a value that takes 10^10 guesses or more is a secret
MIN_CHARS = 8      # of a value
WINDOW = 40        # longest part of a segmentation
CONSONANTS = 5     # in a row: not a word

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
# RE2 finds the texts that can hold a match; the patterns above decide.
MAY_ASSIGN = r"(?i:password|passwd|secret|token|api_?key)"
MAY_ACCESS = r"AKIA"
MAY_HEX = r"[0-9a-f]{32}"
CONTEXT = re.compile(
    r"""(?:(?<![A-Za-z])(?:pwd|passphrase|pass[_ -]?word|passwd|secret(?:[_ -]?key)?"""
    r"""|access[_ -]?key|private[_ -]?key|client[_ -]?secret|api[_ -]?key|auth[_ -]?token|token"""
    r"""|credentials?)["']?\x20*(?:=>|:=|[:=]|\x20is\x20|\x20)\x20*["'`]?"""
    r"""|(?<![A-Za-z])(?:bearer|basic)\x20+)([!-~]{%d,})""" % MIN_CHARS,
    re.IGNORECASE | re.ASCII)
_QUOTES = "\"'`"
# A quote that closes the value, or a separator with the next field's name behind it.
_NEXT_FIELD = re.compile(
    r"""["'`](?=[,;&}\])]|$)|["'`]?[,;&]["'`{\[]*[A-Za-z_][A-Za-z0-9_.-]*["'`]?[=:]""", re.ASCII)
_BARE = re.compile(r"[A-Za-z]\x20+$", re.ASCII)  # nothing but a blank, or "is", before the value
MAY_CONTEXT = (r"(?i:pwd|passphrase|pass[_ -]?word|passwd|secret|access[_ -]?key|private[_ -]?key"
               r"|api[_ -]?key|auth[_ -]?token|token|credential|bearer|basic)")

# Common password words, most frequent first; a word's place is
# its number of guesses.
COMMON_WORDS = (
    "password", "admin", "welcome", "letmein", "qwerty", "dragon", "monkey", "master", "secret",
    "login", "user", "test", "guest", "root", "default", "changeme", "example", "pass", "token",
    "key", "love", "hello", "sunshine", "princess", "football", "baseball", "shadow", "super",
    "hunter", "iloveyou", "access", "server", "database", "demo", "sample", "summer", "winter",
    "spring", "autumn", "company", "internet", "computer", "system", "service", "public",
    "private", "client", "account", "value", "string", "number", "your", "here", "the", "my",
    "null", "none", "true", "false", "undefined", "placeholder", "xxxx", "todo", "insert",
    "enter", "required", "optional", "config", "environment", "variable", "production",
    "staging", "development", "local", "localhost", "home", "office", "work", "school",
    "january", "february", "march", "april", "may", "june", "july", "august", "september",
    "october", "november", "december", "monday", "tuesday", "wednesday", "thursday", "friday",
    "saturday", "sunday", "michael", "jordan", "thomas", "robert", "daniel", "andrew", "charlie",
    "jessica", "ashley", "michelle", "george", "killer", "trust", "no", "one", "and", "for",
    "with", "this", "that", "new", "old", "black", "white", "red", "blue", "green", "star",
    "angel", "tiger", "eagle", "apple", "orange", "banana", "cookie", "coffee", "cheese",
    "chocolate", "correct", "horse", "battery", "staple",
)
# Rows of a keyboard, left to right, unshifted and shifted.
KEYBOARD = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = ("~!@#$%^&*()_+", "QWERTYUIOP{}|", 'ASDFGHJKL:"', "ZXCVBNM<>?")
LEET = str.maketrans("430157@$!", "aeoistasi")

_RANK = {w: i + 1 for i, w in enumerate(COMMON_WORDS)}
_LONGEST_WORD = max(map(len, COMMON_WORDS))
_DATE = re.compile(
    r"(?:19|20)\d\d(?:[-/._]?(?:0?[1-9]|1[0-2])(?:[-/._]?(?:0?[1-9]|[12]\d|3[01]))?)?"
    r"|(?:0?[1-9]|[12]\d|3[01])[-/._](?:0?[1-9]|1[0-2])[-/._](?:(?:19|20)?\d\d)", re.ASCII)


def _places() -> dict[str, tuple[int, float]]:
    """Each key's row and column; lower rows lean to the right by half a key."""
    return {key: (row, column + 0.5 * row)
            for rows in (KEYBOARD, SHIFTED) for row, keys in enumerate(rows)
            for column, key in enumerate(keys)}


_PLACE = _places()


def _adjacent(a: str, b: str) -> bool:
    if a not in _PLACE or b not in _PLACE or a == b:
        return False
    (row, column), (row2, column2) = _PLACE[a], _PLACE[b]
    return abs(row - row2) <= 1 and abs(column - column2) <= 1


def _alphabet(value: str) -> float:
    """Size of the alphabet that brute force has to try, by the kinds of characters present."""
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value):
        return 16.0 if re.search("[a-fA-F]", value) else 10.0
    size = 0
    for pattern, n in (("[a-z]", 26), ("[A-Z]", 26), ("[0-9]", 10), (r"[^a-zA-Z0-9]", 33)):
        size += n if re.search(pattern, value) else 0
    return float(max(size, 10))


def _word_log10(part: str) -> float | None:
    """Guesses of a dictionary word: its rank, times case and leet variants."""
    low = part.lower()
    plain = low if low in _RANK else low.translate(LEET)
    if plain not in _RANK:
        return None
    guesses = float(_RANK[plain])
    if part != low:
        upper = sum(a != b for a, b in zip(part, low, strict=True))
        guesses *= 2 if upper in (1, len(part)) and part[0] != low[0] else math.comb(
            len(part), min(upper, len(part) // 2))
    if plain != low:
        guesses *= 2 ** sum(a != b for a, b in zip(plain, low, strict=True))
    return math.log10(guesses)


def _sizes(least: int, run: int) -> list[int]:
    """Sizes of parts that end a run: all up to WINDOW, and the whole run."""
    return [*range(least, min(run, WINDOW) + 1), *([run] if run > WINDOW else [])]


@lru_cache(maxsize=100_000)
def guess_log10(value: str) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` takes.

    best[j] is the least over parts value[i:j] of best[i] plus the part's own
    guesses; a part after the first doubles the guesses, since attackers try
    few parts before many.
    """
    n = len(value)
    per_char = math.log10(_alphabet(value))
    walk_run, best = 0, [0.0] + [math.inf] * n
    repeat_run, sequence_run, step = 1, 1, 0
    for j in range(1, n + 1):
        if j > 1:
            gap = ord(value[j - 1]) - ord(value[j - 2])
            repeat_run = repeat_run + 1 if gap == 0 else 1
            sequence_run = sequence_run + 1 if gap == step and abs(gap) == 1 else \
                (2 if abs(gap) == 1 else 1)
            step = gap
            walk_run = walk_run + 1 if _adjacent(value[j - 2], value[j - 1]) else 0
        joint = lambda i, cost: best[i] + cost + (math.log10(2) if i else 0.0)
        cheapest = best[j - 1] + per_char           # brute force goes on by one character
        for size in _sizes(3, repeat_run):
            cheapest = min(cheapest, joint(j - size, per_char + math.log10(size)))
        for size in _sizes(3, sequence_run):
            cheapest = min(cheapest, joint(j - size, per_char + math.log10(2 * size)))
        for keys in _sizes(4, walk_run + 1):        # a walk of walk_run steps has one key more
            cheapest = min(cheapest, joint(j - keys, math.log10(47 * keys * 4.6) + 0.3 * keys))
        for size in range(2, min(j, _LONGEST_WORD) + 1):
            cost = _word_log10(value[j - size:j])
            if cost is not None:
                cheapest = min(cheapest, joint(j - size, cost))
        if value[j - 1].isdigit():
            for size in range(4, min(j, 10) + 1):
                if _DATE.fullmatch(value, j - size, j):
                    cheapest = min(cheapest, joint(j - size, math.log10(365.0 * 120 if size > 4 else 120.0)))
        for size in range(2, min(j // 2, WINDOW) + 1):   # a block said twice
            if value[j - size:j] == value[j - 2 * size:j - size]:
                cheapest = min(cheapest, best[j - size] + math.log10(2))
        best[j] = cheapest
    return best[n]


def _context_value(text: str, m: re.Match) -> str:
    """A context match's value: up to its closing quote or the next field, without closing punctuation."""
    run, opening = m[1], text[m.start(1) - 1]
    if opening in _QUOTES:
        closing = re.search(r"(?<!\\)" + opening, run)
        if closing:
            return run[:closing.start()]
    following = _NEXT_FIELD.search(run)
    return (run[:following.start()] if following else run).rstrip("\"'`,;.)]}>")


def _word_like(value: str) -> bool:
    """Letters alone that may be words: each part between capitals has a vowel and three letters."""
    letters = value.rstrip(".,;:!?")
    parts = re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+", letters)
    return bool(re.fullmatch(r"[A-Za-z]+", letters)) and all(
        len(x) >= 3 and re.search("[aeiouy]", x, re.IGNORECASE)
        and not re.search("[^aeiouy]{%d}" % CONSONANTS, x, re.IGNORECASE) for x in parts)


def scan_text(text: str, base: bool = True, context: bool = True) -> list[tuple]:
    """All spans of one text: (kind, start, end, value start, value end, log10 guesses)."""
    spans: list[tuple] = []
    if base:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= MIN_CHARS:
                spans.append(("assign", m.start(), m.end(), m.start(2), m.end(2),
                              guess_log10(m[2])))
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 16:
                spans.append(("access", m.start(), m.end(), m.start(), m.end(), guess_log10(m[0])))
        for m in HEX.finditer(text):
            spans.append(("hex", m.start(), m.end(), m.start(), m.end(), guess_log10(m[0])))
    if context:
        taken = sorted((x[1], x[2]) for x in spans)
        at = 0
        while m := CONTEXT.search(text, at):
            value = _context_value(text, m)
            start = m.start(1)
            end = at = start + len(value)  # the search goes on behind the value, not behind its line
            if len(value) < MIN_CHARS or any(a < end and start < b for a, b in taken):
                continue
            cost = guess_log10(value)
            if cost >= MIN_LOG10 and not (_BARE.search(m[0][:start - m.start()]) and _word_like(value)):
                spans.append(("guess", start, end, start, end, cost))
    spans.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    return spans


SPAN = "struct<kind:string,start:int,stop:int,value:string,log10_guesses:double>"


def scan(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id and ``found``, an array of its spans by place."""
    id_type = documents.select(doc_id).schema[0].dataType.simpleString()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()),
                               ("value", pa.string()), ("log10_guesses", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            may = {}
            for name, pattern in (("assign", MAY_ASSIGN), ("access", MAY_ACCESS), ("hex", MAY_HEX),
                                  ("context", MAY_CONTEXT)):
                may[name] = pc.fill_null(pc.match_substring_regex(texts, pattern), False)
            base = pc.or_(pc.or_(may["assign"], may["access"]), may["hex"]).to_numpy(False)
            context = may["context"].to_numpy(False)
            found: list[list] = [[] for _ in range(len(texts))]
            for i in (base | context).nonzero()[0]:
                value = texts[int(i)].as_py()
                found[i] = [{"kind": k, "start": a, "stop": b, "value": value[va:vb],
                             "log10_guesses": cost}
                            for k, a, b, va, vb, cost in scan_text(value, base[i], context[i])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, type=kind)],
                                             names=["doc_id", "found"])

    return documents.selectExpr(f"`{doc_id}` as doc_id", f"`{text}` as text").mapInArrow(
        run, f"doc_id {id_type}, found array<{SPAN}>")



def spans_text(found: str, base_only: bool) -> Column:
    """kind:start:end of an array of spans, joined by commas."""
    spans = F.col(found)
    if base_only:
        spans = F.filter(spans, lambda x: x["kind"] != F.lit("guess"))
    return F.array_join(F.transform(
        spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def scan_digest(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: span counts by kind, their digest, and the largest guess cost."""
    found = scan(documents, doc_id, text)
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == F.lit(kind))).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(spans_text("found", True).cast("binary"), 256).alias("base_sha256"),
        spans_text("found", False).alias("spans"),
        F.round(F.array_max(F.transform("found", lambda x: x["log10_guesses"])), 6)
        .alias("max_log10_guesses"))
