"""Token counts by a map-side two-tier lookup (operator 10).

A byte-level BPE never merges across pre-tokens, so a text's count is the sum
of its pre-tokens' counts. Tier one is a broadcast hash table, pre-token →
token count, of the pre-tokens most frequent in a bounded sample of texts;
tier two is a cache per Python worker that encodes each pre-token it misses
once. Counts never depend on either tier's contents, and no pre-token is
shuffled.

Texts that the lookup can't split exactly as the library does go to the
library whole: texts with code points outside Latin and common punctuation
(Unicode versions may differ there), and texts holding a special token's
string. Tokenizers of another kind (sentencepiece, or a .json without plain
byte-level pre-tokens) are always asked for whole texts.

Defined results: null and empty texts have 0 tokens; every input row gives one
output row, repeated rows and null ids included; an empty table gives an
empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import sample_texts, utf8_bytes

SAMPLE_ROWS = 2_000        # texts that tier one is drawn from
TABLE_ENTRIES = 60_000     # pre-tokens in tier one: about 1 MB to broadcast
CACHE_ENTRIES = 1_000_000  # pre-tokens a worker keeps; a full cache starts anew
ENCODE_CHARS = 4 << 20     # characters given to the library in one call

# Letters, numbers and white space of the code points the lookup takes by itself.
_VETTED_END = 0x250
_PLAIN = re.compile("[^\t\n\r\x20-\x7e\xa0-ɏ‐-‧‰-›€™]")


def _class_of(*categories: str) -> str:
    import unicodedata

    points = [*range(0x20, 0x7F), *range(0xA0, _VETTED_END)]
    return "".join(f"\\u{p:04x}" for p in points if unicodedata.category(chr(p))[0] in categories)


def _pre_token_pattern() -> re.Pattern:
    """The byte-level pre-token rule, over the vetted code points."""
    letter, number = _class_of("L"), _class_of("N")
    space = "\\t\\n\\r \\u00a0"
    return re.compile(
        f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+"
        f"| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


class Counter2Tier:
    """Counts tokens of texts; one per Python worker and tokenizer file."""

    def __init__(self, path: str, table: dict[str, int], cache_entries: int = CACHE_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.table, self.cache, self.most = table, {}, cache_entries
        self.special: list[str] = []
        self.split = None
        if path.endswith(".model"):
            import sentencepiece

            library = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [len(x) for x in library.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        self.encode = lambda texts: [
            len(x.ids) for x in library.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec.get("pre_tokenizer") or {}
        if (pre.get("type"), pre.get("use_regex", True), pre.get("add_prefix_space"),
                spec.get("normalizer")) == ("ByteLevel", True, False, None):
            self.special = [x["content"] for x in spec.get("added_tokens", [])]
            self.split = _pre_token_pattern().findall

    def _learn(self, missing: set[str]) -> None:
        if len(self.cache) + len(missing) > self.most:
            self.cache = {}
        words = list(missing)
        self.cache.update(zip(words, self.encode(words), strict=True))

    def _plain(self, text: str) -> bool:
        return self.split is not None and not _PLAIN.search(text) and \
            not any(x in text for x in self.special)

    def count(self, texts: list[str | None]) -> list[int]:
        out = [0] * len(texts)
        whole: list[int] = []
        for i, text in enumerate(texts):
            if not text:
                continue
            if not self._plain(text):
                whole.append(i)
                continue
            words = self.split(text)
            first = list(map(self.table.get, words))
            total = sum(filter(None, first))
            left = [w for w, n in zip(words, first, strict=True) if n is None]
            if left:
                missing = set(left).difference(self.cache)
                if missing:
                    self._learn(missing | (set(left) if len(self.cache) + len(missing) > self.most
                                           else set()))
                total += sum(map(self.cache.__getitem__, left))
            out[i] = total
        at = 0
        while at < len(whole):  # bounded calls of the library
            stop, chars = at, 0
            while stop < len(whole) and (stop == at or chars + len(texts[whole[stop]]) <= ENCODE_CHARS):
                chars += len(texts[whole[stop]])
                stop += 1
            for i, n in zip(whole[at:stop], self.encode([texts[i] for i in whole[at:stop]]),
                            strict=True):
                out[i] = n
            at = stop
        return out


_COUNTERS: dict[str, Counter2Tier] = {}


def frequent_pre_tokens(documents: DataFrame, path: str, doc_id: str = "doc_id",
                        text: str = "text",
                        sample_rows: int = SAMPLE_ROWS,
                        entries: int = TABLE_ENTRIES) -> dict[str, int]:
    """Tier one: counts of the most frequent pre-tokens of ``sample_rows`` texts.

    The sample is chosen by row hash, so it doesn't depend on the layout. It is
    only a cache: other contents give the same counts.
    """
    counter = Counter2Tier(path, {})
    if counter.split is None:
        return {}
    tally: Counter = Counter()
    for some in sample_texts(documents, doc_id, text, sample_rows, 4_000):
        if counter._plain(some):
            tally.update(counter.split(some))
    words = sorted(tally, key=lambda w: (-tally[w], w))[:entries]
    return dict(zip(words, counter.encode(words), strict=True)) if words else {}


def count_tokens(documents: DataFrame, tokenizer: str, doc_id: str = "doc_id",
                 text: str = "text", sample_rows: int = SAMPLE_ROWS, entries: int = TABLE_ENTRIES):
    """A column expression: tokens of ``text`` under the tokenizer file, as long.

    ``tokenizer`` must be readable on every executor (an installed package's
    file, or one that the cluster distributes).
    """
    table = documents.sparkSession.sparkContext.broadcast(
        frequent_pre_tokens(documents, tokenizer, doc_id, text, sample_rows, entries))

    @F.pandas_udf(LongType())
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if tokenizer not in _COUNTERS or _COUNTERS[tokenizer].table is not table.value:
            _COUNTERS[tokenizer] = Counter2Tier(tokenizer, table.value)
        counter = _COUNTERS[tokenizer]
        for batch in batches:
            yield pd.Series(counter.count(batch.tolist()), dtype="int64")

    return tokens(F.col(text))


def token_counts(documents: DataFrame, tokenizer: str, limit: int = 512,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    counted = documents.select(
        F.col(doc_id).alias("doc_id"), utf8_bytes(text).alias("n_bytes"),
        F.coalesce(count_tokens(documents, tokenizer, doc_id, text), F.lit(0)).cast("long").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
