"""Benchmark decontamination by CGK embedding and bit sampling (operator 4).

A document is contaminated by a benchmark item if some run of its words is
within ``floor(MAX_EDITS * n)`` word edits of the item's n words. Words are
lower-cased runs of digits, letters a-z and non-ASCII characters, so case,
punctuation and line breaks make no difference; in scripts without blanks
(Chinese, Japanese, Thai, ...) every character is a word.

The CGK walk reads a sequence of words with a pointer; at step j a random bit
of (repetition, j, word) says whether the pointer moves on. Sequences a few
edits apart fall into step again after each edit, so the words read at equal
steps mostly agree: edit distance became Hamming distance. Each of ``REPEATS``
repetitions samples ``SAMPLED`` steps; windows of the item's size that agree
with the item on all sampled steps of some repetition are candidates, and an
exact edit distance (the item against the window and its surroundings, ends
free) decides.

Windows without any three words in a row of an item at the right place are
not walked: at that many edits an item of ``MIN_WORDS`` or more words keeps
three words in a row intact, so such windows can't match.

Items of fewer words keep no such run; they are looked up by the hash of all
their words, and items of five words, which may have one edit, also by the
hashes of what one edit leaves.

The benchmark is broadcast in parts of ``PART_WORDS`` words at most; a larger
one takes more passes over the documents, not more memory.

Defined results: pairs alone are returned, so null, empty and clean texts give
no row; an item without a word matches nothing, and so does one of fewer than
``least_words`` words (``LEAST_WORDS`` unless the caller says otherwise; the
registered query and the pipeline say 1); equal
items and repeated rows each give their own pairs; null ids are kept; with an
empty table of either kind the result is empty; other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import ALNUM, Words, mix, shingles, slices

MAX_EDITS = 0.2
MIN_WORDS = 6        # from here on three words in a row survive MAX_EDITS
LEAST_WORDS = 3      # of an item, unless the caller says otherwise
GRAM = 3
REPEATS = 32
SAMPLED = 3
READ_STEPS = 1.5     # steps are sampled from the first READ_STEPS * n
PART_WORDS = 500_000
WALKED = 4_096       # windows walked at a time

_KEY = np.uint64(0xE7037ED1A0B428DB)


@dataclass
class Items:
    """A part of the benchmark: item i has words[first[i]:first[i] + size[i]]."""

    ids: list
    words: np.ndarray
    first: np.ndarray
    size: np.ndarray
    seeds: np.ndarray        # sorted hashes of all runs of GRAM words
    seed_item: np.ndarray
    seed_place: np.ndarray
    keys: np.ndarray         # sorted sampled-step keys of all repetitions
    key_item: np.ndarray
    short: dict[tuple, tuple[np.ndarray, np.ndarray]]  # (run's words, word left out, edits): sorted hashes, items


def sampled_steps(sizes: np.ndarray, repeat: int) -> np.ndarray:
    """The steps repetition ``repeat`` samples for windows of each size: sizes x SAMPLED."""
    places = (np.arange(SAMPLED) + np.random.default_rng([repeat, 77]).random(SAMPLED)) / SAMPLED
    return (places[None, :] * np.maximum(READ_STEPS * sizes, 1)[:, None]).astype(np.int64)


def walk_keys(windows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Keys of windows (rows of word hashes, 0 past the end): repetitions x windows.

    All repetitions walk in step. A word's bit at a step is one bit of its
    hash, which one being drawn for the step and repetition; past the end the
    word is 0 and the pointer stays.
    """
    count, width = windows.shape
    steps = [sampled_steps(size, r) for r in range(REPEATS)]
    last = max(int(x.max(initial=0)) for x in steps)
    shift = np.random.default_rng(4242).integers(0, 64, (last + 1, REPEATS)).astype(np.uint64)
    flat = windows.ravel()
    row = np.tile(np.arange(count) * width, (REPEATS, 1))
    at = row.copy()
    read = np.empty((last + 1, REPEATS, count), dtype=np.int32)
    for step in range(last + 1):
        read[step] = at
        at += ((flat[at] >> shift[step][:, None]) & np.uint64(1)).astype(np.int64)
    keys = np.empty((REPEATS, count), dtype=np.uint64)
    lane = np.arange(count)
    for r in range(REPEATS):
        key = mix(size.astype(np.uint64) * _KEY + np.uint64(r))
        for sample in range(SAMPLED):
            key = mix(key + flat[read[steps[r][:, sample], r, lane]])
        keys[r] = key
    return keys


def window_rows(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """words[start:start + size] as rows, each ending in at least one 0."""
    column = np.arange(int(size.max(initial=0)) + 1)
    place = np.minimum(start[:, None] + column[None, :], len(words))
    return np.where(column[None, :] < size[:, None], np.append(words, np.uint64(0))[place], np.uint64(0))


def _run_hashes(words: np.ndarray, start: np.ndarray, size: int, without: int | None) -> np.ndarray:
    """Hashes of words[start:start + size], one place of them left out."""
    total = np.full(len(start), size - (without is not None), dtype=np.uint64)
    for j in range(size):
        if j != without:
            total = mix(total * _KEY + words[start + j])
    return total


def _short_keys(words: np.ndarray, first: np.ndarray, size: np.ndarray,
                least_words: int) -> dict[tuple, tuple[np.ndarray, np.ndarray]]:
    """Keys of items under MIN_WORDS words by the kind of run they are compared with.

    A kind is (words of the run, place of the run's word that is left out, edits).
    """
    kinds: dict[tuple, list[tuple[np.ndarray, np.ndarray]]] = {}
    for n in range(max(least_words, 1), MIN_WORDS):
        item = np.flatnonzero(size == n)
        if not len(item):
            continue
        whole = _run_hashes(words, first[item], n, None)
        kinds.setdefault((n, None, 0), []).append((whole, item))
        if int(MAX_EDITS * n):  # one edit
            for j in range(n):
                less = _run_hashes(words, first[item], n, j)
                kinds.setdefault((n - 1, None, 1), []).append((less, item))  # word j is missing
                kinds.setdefault((n, j, 1), []).append((less, item))         # another word at j
                kinds.setdefault((n + 1, j + 1, 1), []).append((whole, item))  # one more word at j + 1
    out = {}
    for kind, found in kinds.items():
        key, item = map(np.concatenate, zip(*found, strict=True))
        order = np.argsort(key, kind="stable")
        out[kind] = key[order], item[order]
    return out


def _short_matches(words: Words, items: Items,
                   best: dict[tuple[int, int], tuple[int, int, int]]) -> None:
    """Adds the best runs of items under MIN_WORDS words to ``best``."""
    count, text_of = len(words.hash), words.text_of
    for (size, without, edits), (keys, item) in items.short.items():
        start = np.arange(max(count - size + 1, 0))
        start = start[text_of[start] == text_of[start + size - 1]]
        window, key = _expand(keys, _run_hashes(words.hash, start, size, without))
        # each text's and item's first run of the kind
        owner, found = text_of[start[window]], item[key]
        at = start[window] - words.bounds[owner]
        order = np.lexsort((at, found, owner))
        owner, found, at = owner[order], found[order], at[order]
        new = np.flatnonzero(np.concatenate((
            [True], (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])))[:len(owner)])
        for o, i, a in zip(owner[new].tolist(), found[new].tolist(), at[new].tolist(), strict=True):
            run = (edits, a, a + size)
            best[o, i] = min(best.get((o, i), run), run)


def prepare(ids: list, texts: list[str], least_words: int = LEAST_WORDS) -> Items:
    parts = list(slices(pa.array(texts, pa.string()), ALNUM, single=True))
    words = np.concatenate([np.zeros(0, np.uint64), *[p.hash for p in parts]])
    size = np.concatenate([np.zeros(0, np.int64), *[np.diff(p.bounds) for p in parts]])
    first = np.cumsum(size) - size
    usable = np.flatnonzero(size >= MIN_WORDS)
    seed, item, place, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for part in parts:
        text, position, token = shingles(part, GRAM)
        keep = np.isin(text + at, usable)
        seed.append(token[keep])
        item.append(text[keep] + at)
        place.append(position[keep] - part.bounds[text[keep]])
        at += part.n
    seed, item, place = map(np.concatenate, (seed, item, place))
    order = np.argsort(seed, kind="stable")
    keys = walk_keys(window_rows(words, first[usable], size[usable]), size[usable]).ravel()
    by_key = np.argsort(keys, kind="stable")
    return Items(ids, words, first, size, seed[order], item[order], place[order], keys[by_key],
                 np.tile(usable, REPEATS)[by_key], _short_keys(words, first, size, least_words))


def _expand(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in wanted, place in sorted_keys) of all equal pairs."""
    low = np.searchsorted(sorted_keys, wanted)
    count = np.searchsorted(sorted_keys, wanted, "right") - low
    which = np.repeat(np.arange(len(wanted)), count)
    within = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    return which, low[which] + within


def fit_distance(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """Least edits that turn some run region[a:b] into the item, with that run's a and b."""
    ramp = np.arange(len(region) + 1)
    cost = np.zeros(len(region) + 1, dtype=np.int64)
    origin = ramp.copy()
    for i, word in enumerate(item, 1):
        change = cost[:-1] + (region != word)
        down = cost + 1
        best = np.concatenate(([i], np.minimum(change, down[1:])))
        source = np.concatenate(([origin[0]], np.where(change <= down[1:], origin[:-1], origin[1:])))
        # words of the region left out: the least of best[j] + distance, carried to the right
        lead = (best - ramp) * (len(ramp) + 1) - ramp  # ties to the nearest
        carried = np.minimum.accumulate(lead)
        holder = np.maximum.accumulate(np.where(lead == carried, ramp, 0))
        cost, origin = best[holder] + ramp - holder, source[holder]
    end = int(np.argmin(cost))
    return int(cost[end]), int(origin[end]), end


def matches(words: Words, items: Items) -> list[tuple[int, int, int, int, int]]:
    """(text, item, first word, end word, edits): each item's best run in each text."""
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    _short_matches(words, items, best)
    _long_matches(words, items, best)
    return [(t, int(i), a, b, cost) for (t, i), (cost, a, b) in sorted(best.items())]


def _long_matches(words: Words, items: Items,
                  best: dict[tuple[int, int], tuple[int, int, int]]) -> None:
    """Adds the best runs of items of MIN_WORDS words or more to ``best``."""
    text, position, token = shingles(words, GRAM)
    place = np.minimum(np.searchsorted(items.seeds, token), max(len(items.seeds) - 1, 0))
    hit = np.flatnonzero(items.seeds[place] == token) if len(items.seeds) else np.zeros(0, np.int64)
    if not len(hit):
        return
    which, seed = _expand(items.seeds, token[hit])
    at, owner = position[hit][which], text[hit][which]
    start = np.maximum(at - items.seed_place[seed], words.bounds[owner])
    widest = int(items.size.max()) + 1
    distinct = np.unique(start * widest + items.size[items.seed_item[seed]])
    start, size = distinct // widest, distinct % widest
    owners = np.searchsorted(words.bounds, start, "right") - 1
    # a window cut by the text's end keeps its size, the words it lacks read as nothing
    inside = np.minimum(size, words.bounds[owners + 1] - start)
    pairs = []
    for at in range(0, len(start), WALKED):
        some = slice(at, at + WALKED)
        for keys in walk_keys(window_rows(words.hash, start[some], inside[some]), size[some]):
            window, key = _expand(items.keys, keys)
            pairs.append(np.stack((window + at, items.key_item[key]), axis=1))
    candidates, agreeing = np.unique(np.concatenate(pairs), axis=0, return_counts=True)
    for window, item in candidates[np.argsort(-agreeing, kind="stable")]:  # likeliest first
        owner, n = int(owners[window]), int(items.size[item])
        known = best.get((owner, item))
        if known and known[0] == 0:
            continue
        edits = int(MAX_EDITS * n)
        low = max(int(start[window]) - edits, int(words.bounds[owner]))
        high = min(int(start[window]) + n + edits, int(words.bounds[owner + 1]))
        cost, a, b = fit_distance(items.words[items.first[item]:items.first[item] + n], words.hash[low:high])
        found = (cost, low + a - int(words.bounds[owner]), low + b - int(words.bounds[owner]))
        if cost <= edits and (known is None or found < known):
            best[owner, item] = found


def _parts(benchmark: DataFrame, item_id: str, item_text: str, least_words: int) -> Iterator[Items]:
    """The benchmark in parts of bounded size, each prepared for matching."""
    items = benchmark.select(F.col(item_id).alias("item_id"), F.coalesce(item_text, F.lit("")).alias("t"))
    # a word and its separator are two characters at least, in scripts without blanks one of three bytes or more
    characters = items.agg(F.sum(F.length("t") + F.octet_length("t") / 3)).first()[0] or 0
    count = max(1, math.ceil(characters / (2 * PART_WORDS)))
    for part in range(count):
        rows = items.where(F.pmod(F.xxhash64("item_id", "t"), F.lit(count)) == part).collect()
        rows = sorted(rows, key=lambda r: (r[0] is None, r[0], r[1]))
        yield prepare([r[0] for r in rows], [r[1] for r in rows], least_words)


def contaminated_pairs(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
                       text: str = "text", item_id: str = "item_id",
                       item_text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, first_word, end_word, edits, similarity."""
    kinds = [documents.select(doc_id).schema[0].dataType.simpleString(),
             benchmark.select(item_id).schema[0].dataType.simpleString()]
    schema = (f"doc_id {kinds[0]}, item_id {kinds[1]}, first_word long, end_word long, edits long, "
              "similarity double")
    item_type = {"string": pa.string(), "int": pa.int32()}.get(kinds[1], pa.int64())
    out = None
    for part in _parts(benchmark, item_id, item_text, least_words):
        shared = documents.sparkSession.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in batches:
                for words in slices(batch.column(1), ALNUM, single=True):
                    found = matches(words, items)
                    if found:
                        owner, item, first, end, edits = map(np.array, zip(*found, strict=True))
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(owner + words.first)),
                             pa.array([items.ids[i] for i in item], item_type), pa.array(first),
                             pa.array(end), pa.array(edits), pa.array(1 - edits / items.size[item])],
                            names=["doc_id", "item_id", "first_word", "end_word", "edits", "similarity"])

        found = documents.select(doc_id, text).mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def decontaminated(documents: DataFrame, benchmark: DataFrame, text: str = "text",
                   item_id: str = "item_id", item_text: str = "text",
                   least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of ``documents`` in which no item is found, as they are and where they are."""
    names = documents.columns
    out = documents.toDF(*[f"c{i}" for i in range(len(names))])
    at = names.index(text)
    for part in _parts(benchmark, item_id, item_text, least_words):
        shared = documents.sparkSession.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                for words in slices(batch.column(at), ALNUM, single=True):
                    for owner, *_ in matches(words, shared.value):
                        clean[owner + words.first] = False
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(run, out.schema)
    return out.toDF(*names)
