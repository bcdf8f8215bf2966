"""Language identification by cross-parsing (operator 9).

For each language a suffix automaton of a sample of its labelled text gives,
from any place of a new text, the longest string that also occurs in the
sample. Parsing the new text greedily into such longest matches needs few
phrases where the languages agree and many where they don't. Phrases times
the logarithm of the sample's length (and of the symbols there are), per
character, is the Ziv-Merhav cross-parsing estimate of cross entropy; the
language with the least wins.

Training text is a bounded sample: per language the ``SAMPLE_DOCS`` labelled
documents of smallest id hash, up to ``SAMPLE_CHARS`` characters in all. Each
automaton is built from its language's whole sample, so a language with little
text weakens itself alone. Every
text to label is parsed whole, in pieces of ``PIECE`` characters (a phrase
ends at a piece's end), all languages and many pieces in step.

Defined results: ``und`` with score 0 for a null text, a text without a
letter, and any text if nothing is labelled. Symbols that no sample has count
the same for all languages; a text of no other letters is a tie. Ties go to
the language first by code point. Each input row gives one output row; other columns aren't read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_DOCS = 64        # labelled documents a language's automaton is built from
SAMPLE_CHARS = 40_000   # their characters, all told
PIECE = 1_024           # characters of a piece
LANES = 4_096           # pieces parsed in step
SLICE_ROWS = 1_000      # texts held as strings at a time
UNDETERMINED = "und"


def symbols_of(text: str) -> np.ndarray:
    """Lower-cased code points; white space, digits and punctuation are all one blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return _fold(points)


def _fold(points: np.ndarray) -> np.ndarray:
    letter = ((points >= 97) & (points <= 122)) | (points >= 0xAA)
    return np.where(letter, points, np.uint32(32))


@dataclass
class Parser:
    """Automata of all languages as one table of moves.

    Row r of ``moves`` is a state, column c a symbol; the entry is the next
    state times the number of symbols, 0 where the string doesn't occur.
    ``roots`` are the languages' first rows (row 0 is never a state);
    ``costs`` are the bits a phrase of each language takes.
    """

    languages: list[str]
    alphabet: np.ndarray
    moves: np.ndarray
    roots: np.ndarray
    costs: np.ndarray

    @property
    def width(self) -> int:
        return len(self.alphabet) + 1


def _automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Moves of the suffix automaton of a string: every path from 0 spells a substring."""
    moves: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for symbol in symbols:
        state = len(moves)
        moves.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = state
            at = link[at]
        if at >= 0:
            target = moves[at][symbol]
            if longest[target] == longest[at] + 1:
                link[state] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                link.append(link[target])
                longest.append(longest[at] + 1)
                while at >= 0 and moves[at].get(symbol) == target:
                    moves[at][symbol] = copy
                    at = link[at]
                link[target] = link[state] = copy
        last = state
    return moves


def _phrase_costs(lengths: np.ndarray, alphabet: int) -> np.ndarray:
    """Bits of naming a place in each sample or a symbol outright."""
    return np.log2(np.maximum(lengths + alphabet, 2))


def build_parser(samples: dict[str, str]) -> Parser:
    """The parser of the languages' sample texts, each of its own length."""
    languages = sorted(samples)
    texts = [symbols_of(samples[x]) for x in languages]
    alphabet = np.unique(np.concatenate(texts))
    width = len(alphabet) + 1
    # a suffix automaton has at most two states a symbol; untouched rows of the table take no memory
    moves = np.zeros((1 + sum(2 * len(x) + 1 for x in texts)) * width, dtype=np.int32)
    roots, first = [], 1
    for text in texts:      # one language's automaton at a time
        automaton = _automaton((np.searchsorted(alphabet, text) + 1).tolist())
        roots.append(first * width)
        for state, out in enumerate(automaton, first):
            for symbol, target in out.items():
                moves[state * width + symbol] = (target + first) * width
        first += len(automaton)
        del automaton
    costs = _phrase_costs(np.array([len(x) for x in texts]), len(alphabet))
    return Parser(languages, alphabet, moves, np.array(roots, dtype=np.int32), costs)


def phrase_counts(parser: Parser, pieces: list[np.ndarray]) -> np.ndarray:
    """Phrases of each piece (rows) under each language (columns).

    ``pieces`` hold column numbers of the move table; 0 stands for a symbol no
    sample has, a phrase of its own. Longest pieces first: the lanes still
    running are always a prefix.
    """
    count = len(pieces)
    lengths = np.array([len(x) for x in pieces])
    order = np.argsort(-lengths, kind="stable")
    steps = int(lengths.max(initial=0))
    text = np.zeros((steps, count), dtype=np.int32)
    for lane, i in enumerate(order):
        text[:lengths[i], lane] = pieces[i]
    running = np.searchsorted(-lengths[order], -np.arange(steps), side="left")
    out = np.zeros((count, len(parser.roots)), dtype=np.int64)
    for language, root in enumerate(parser.roots):
        state = np.full(count, root, dtype=np.int32)  # at the root no phrase is open
        phrases = np.zeros(count, dtype=np.int32)
        first = parser.moves[root:root + parser.width].copy()
        lacks = first == 0
        first[lacks] = root
        for step in range(steps):
            n = running[step]
            symbol = text[step, :n]
            to = parser.moves[state[:n] + symbol]
            stop = to == 0
            phrases[:n] += stop & (state[:n] != root)
            phrases[:n] += lacks[symbol]
            state[:n] = np.where(stop, first[symbol], to)
        out[order, language] = phrases + (state != root)
    return out


def identify(parser: Parser | None, texts: list[str | None],
             piece: int = PIECE, lanes: int = LANES) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    labels, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if parser is None:
        return labels, scores
    table = np.zeros(0x110000, dtype=np.int32) if not hasattr(parser, "_table") else parser._table
    if not hasattr(parser, "_table"):
        table[parser.alphabet] = np.arange(1, parser.width, dtype=np.int32)
        parser._table = table
    total = np.zeros((len(texts), len(parser.languages)), dtype=np.int64)
    pieces: list[np.ndarray] = []
    owner: list[int] = []

    def flush():
        if pieces:
            np.add.at(total, np.array(owner), phrase_counts(parser, pieces))
            pieces.clear()
            owner.clear()

    size, unseen, letters = np.zeros((3, len(texts)), dtype=np.int64)
    blank = table[32]
    for i, text in enumerate(texts):
        if not text or not any(map(str.isalpha, text)):
            continue
        symbols = table[symbols_of(text)]
        size[i], unseen[i] = len(symbols), np.count_nonzero(symbols == 0)
        letters[i] = np.count_nonzero((symbols != 0) & (symbols != blank))
        for at in range(0, len(symbols), piece):
            pieces.append(symbols[at:at + piece])
            owner.append(i)
            if len(pieces) >= lanes:
                flush()
    flush()
    for i in np.flatnonzero(size):
        bits = (total[i] - unseen[i]) * parser.costs + unseen[i] * parser.costs.max()
        rate = (bits if letters[i] else np.full(len(bits), parser.costs.max())) / size[i]
        order = np.lexsort((np.arange(len(rate)), rate))
        labels[i] = parser.languages[order[0]]
        second = rate[order[1]] if len(order) > 1 else parser.costs[0]
        scores[i] = float(second / (rate[order[0]] + second))
    return labels, scores


def training_samples(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     lang: str = "lang", docs: int = SAMPLE_DOCS,
                     chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Up to ``chars`` characters of labelled text a language.

    The ids come from a narrow pass (id and label only; Spark keeps ``docs``
    rows a language and task before it shuffles); texts of these few rows
    follow in a second one.
    """
    by_hash = Window.partitionBy("lang").orderBy("hash", "doc_id")
    usable = documents.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"),
        F.xxhash64(F.col(doc_id).cast("string")).alias("hash")).where(
            "doc_id is not null and lang is not null and text is not null")
    chosen = usable.select("doc_id", "lang", "hash").withColumn(
        "place", F.row_number().over(by_hash)).where(F.col("place") <= docs)
    chosen = chosen.groupBy("doc_id", "lang").agg(F.min("place").alias("place"))
    some = usable.select("doc_id", "lang", F.substring("text", 1, chars).alias("text")).join(
        F.broadcast(chosen), ["doc_id", "lang"]).groupBy("lang", "place").agg(
            F.min("text").alias("text"))
    rows = some.orderBy("lang", "place").collect()  # docs x languages rows at most
    parts: dict[str, list[str]] = {}
    share = max(1, -(-chars // docs)) * 2
    for row in rows:
        parts.setdefault(row["lang"], []).append(row["text"])
    samples = {}
    for name, texts in parts.items():
        joined = "\n".join(x[:share] for x in texts)
        if len(joined) < chars:
            joined = "\n".join([joined, *[x[share:] for x in texts if len(x) > share]])
        if symbols_of(joined).size and any(map(str.isalpha, joined)):
            samples[name] = joined[:chars]
    return samples


_PARSERS: dict[str, Parser | None] = {}  # a task's, by fit


def identify_languages(documents: DataFrame, training: DataFrame, doc_id: str = "doc_id",
                       text: str = "text", lang: str = "lang",
                       keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of every document (doc_id by default), lang_pred and score.

    ``training`` has labelled rows alone; nothing else of a document than its
    text takes part in its prediction.
    """
    samples = training_samples(training, doc_id, text, lang)
    shared = documents.sparkSession.sparkContext.broadcast(samples)
    fit = uuid.uuid4().hex
    keep = [doc_id] if keep is None else keep
    source = documents.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
                              F.col(text).alias("text"))
    kinds = [source.schema[i].dataType.simpleString() for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if fit not in _PARSERS:
            _PARSERS.clear()
            _PARSERS[fit] = build_parser(shared.value) if shared.value else None
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    part = batch.slice(at, SLICE_ROWS)
                    labels, scores = identify(_PARSERS[fit], part.column(len(keep)).to_pylist())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(i) for i in range(len(keep))]
                        + [pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                        names=[*[f"k{i}" for i in range(len(keep))], "lang_pred", "score"])
        finally:
            _PARSERS.clear()    # an idle worker must not hold the tables while later stages run

    out = ", ".join([*(f"k{i} {kind}" for i, kind in enumerate(kinds)),
                     "lang_pred string, score double"])
    return source.mapInArrow(run, out).toDF(*keep, "lang_pred", "score")
