"""Problem 9: evaluation texts inside training texts, by suffix arrays of the training text.

Each shard (an Arrow batch of documents) gets a suffix array over its words: the
suffixes, sorted by prefix doubling until no more of them differ.  Every suffix of
every test item is searched in it by binary search on growing prefixes, which gives
the places of its verbatim matches of three words or more, and the length of each.
Copies with many single words replaced may have no such match.  So every document
that shares enough words with an item, in any order, is a candidate; windows of the
item's length and some slack that hold enough of its words are aligned exactly.
Documents that hold an item are left out of the clean corpus.

Words are compared after NFKC, case folding and removal of markup, punctuation,
invisible characters and hyphens at line ends.

Size: shards are searched where they lie and nothing is shuffled but the found
pairs.  The items go to every shard, in parts of a checked size, each in a pass of
its own; more than one block of a part is searched block by block.

Defined cases: null and empty texts or items match nothing; an item of fewer than
three words is found only whole, one of up to five by three words in order; repeated rows give one pair.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frame, read, strings

SHARE = 0.5
SEED = 3
EXPANDED = 2_000_000
BLOCK_WORDS = 200_000
MAX_ITEM_BYTES = 64 << 20

_WORD = re.compile(r"[^\W_]+")
_HYPHEN = re.compile(r"(?<=\w)[-‐‑]\s*\n\s*(?:>\s*)*(?=\w)")
_HIDDEN = re.compile("[­​-‏⁠﻿‪-‮]")
_TAG = re.compile(r"</?[a-zA-Z][^<>\n]{0,200}>")
_CHARS = re.compile("[぀-ヿ㐀-鿿฀-๿]")


def words_of(text: str) -> list[str]:
    """Words as compared; scripts without spaces give one word for each character."""
    if not text.isascii():
        text = _HIDDEN.sub("", unicodedata.normalize("NFKC", text))
        text = _CHARS.sub(lambda m: f" {m[0]} ", text)
    if "-" in text or "‐" in text:
        text = _HYPHEN.sub("", text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    return _WORD.findall(text.casefold())


class Items:
    """The test items of one block: their words as numbers from 1, end to end."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.vocabulary: dict[str, int] = {}
        self.words: dict[int, list[int]] = {}
        for item, text in rows:
            words = words_of(text or "")
            if words:
                self.words[item] = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
        self.ids = list(self.words)
        self.length = np.array([len(self.words[i]) for i in self.ids], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int64)
        self.flat = np.array([w for i in self.ids for w in self.words[i]], np.int32)
        self.owner = np.repeat(np.arange(len(self.ids)), self.length)
        # the first words of each suffix, 0 behind the item's end
        self.suffix = np.stack([self.word(np.arange(len(self.flat)), d) for d in range(SEED)], axis=1)

        self.kinds = [np.unique(self.words[i], return_counts=True) for i in self.ids]
        # by the half power of two that holds an item's span: for each word, the items that have it and how often
        spans, number = np.array([span_of(n) for n in self.length.tolist()], np.int64), max(1, len(self.ids))
        key, times = np.unique(self.flat.astype(np.int64) * number + self.owner, return_counts=True)
        power = np.ceil(2 * np.log2(spans)).astype(np.int64)
        self.postings: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        for e in np.unique(power).tolist():
            mine = power[key % number] == e
            self.postings.append((math.ceil(2 ** (e / 2 - 1)), np.searchsorted(key[mine] // number, np.arange(len(self.vocabulary) + 2)), key[mine] % number, times[mine]))

    def word(self, suffix: np.ndarray, d: int) -> np.ndarray:
        """Word ``d`` of each suffix, 0 behind its item's end."""
        inside = suffix + d < self.start[self.owner[suffix] + 1]
        return np.where(inside, self.flat[np.where(inside, suffix + d, 0)], 0) if len(suffix) else np.zeros(0, np.int32)


class Shard:
    """The suffix array of some documents' words; words that no item has are 0, which ends every match."""

    def __init__(self, texts: list[str | None] | list[list[str]], vocabulary: dict[str, int]):
        """Of texts, or of their words, where several blocks of items look at them."""
        get = vocabulary.get
        parts, self.doc_start = [], np.zeros(len(texts) + 1, np.int64)
        total = 0
        for i, text in enumerate(texts):
            if text:
                part = [get(w, 0) for w in (words_of(text) if isinstance(text, str) else text)]
                part.append(0)
                parts.append(np.array(part, np.int32))
                total += len(part)
            self.doc_start[i + 1] = total
        self.words = np.concatenate([*parts, np.zeros(SEED, np.int32)]) if parts else np.zeros(SEED, np.int32)
        self.array = self._sorted(len(vocabulary).bit_length())

    def _sorted(self, bits: int) -> np.ndarray:
        """The suffixes in order: by as many words as a key holds, then, where they tie, by prefix doubling until no more of them differ."""
        at = np.flatnonzero(self.words > 0)
        if not len(at):
            return at
        ends = np.flatnonzero(self.words == 0)
        rest = ends[np.searchsorted(ends, at)] - at
        width, key = 62 // bits, np.zeros(len(at), np.int64)
        for d in range(width):
            key = (key << bits) | np.where(d < rest, self.words[np.minimum(at + d, len(self.words) - 1)], 0)
        order = np.argsort(key, kind="stable")
        array, rest, key = at[order], rest[order], key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank = np.zeros(len(self.words), np.int64)
        while True:
            rank[array] = np.maximum.accumulate(np.where(new, np.arange(1, len(new) + 1), 0))
            tied = np.flatnonzero(~(new & np.append(new[1:], True)) & (rest >= width))
            if not len(tied):
                return array
            second = rank[array[tied] + width]  # 0 where the suffix ends there; what ended before is in order
            key = rank[array[tied]] * (len(array) + 1) + second
            order = np.argsort(key, kind="stable")
            array[tied], rest[tied], key = array[tied][order], rest[tied][order], key[order]
            new[tied[1:]] |= key[1:] != key[:-1]
            width *= 2

    def narrow(self, low: np.ndarray, high: np.ndarray, d: int, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By binary search, the parts of ranges of the suffix array, alike in their first ``d`` words, that go on with ``word``."""
        ends = []
        for above in (False, True):
            a, b = low, high
            while (open_ := a < b).any():
                middle = (a + b) // 2
                at = self.array[np.minimum(middle, len(self.array) - 1)] + d
                there = self.words[np.minimum(at, len(self.words) - 1)]
                right = open_ & ((there <= word) if above else (there < word))
                a, b = np.where(right, middle + 1, a), np.where(open_ & ~right, middle, b)
            ends.append(a)
        return ends[0], ends[1]

    def longest(self, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(test position, text position, words) of every verbatim match of at least SEED words (all of an item's words, if it has fewer), each as long as it goes."""
        rest = items.start[items.owner + 1] - np.arange(len(items.owner))
        least = np.minimum(SEED, items.length[items.owner])
        open_ = np.flatnonzero((rest >= least) & ((least == SEED) | (rest == items.length[items.owner])))
        low, high = np.zeros(len(open_), np.int64), np.full(len(open_), len(self.array), np.int64)
        first, count = np.zeros(len(items.owner), np.int64), np.zeros(len(items.owner), np.int64)
        width, offset = 0, None
        while len(open_) or width < SEED:  # prefixes of 1, 2, 3, ... words, each searched in the range of the one before
            low, high = self.narrow(low, high, width, items.word(open_, width))
            width += 1
            there = low < high
            open_, low, high = open_[there], low[there], high[there]
            if width <= SEED:
                now = least[open_] == width
                first[open_[now]], count[open_[now]] = low[now], (high - low)[now]
            if width == SEED:
                offset = np.cumsum(count) - count
                length = np.repeat(least, count)
            elif width > SEED:
                length[_ranges(offset[open_] + low - first[open_], high - low)] = width
            on = rest[open_] > width
            open_, low, high = open_[on], low[on], high[on]
        return np.repeat(np.arange(len(count)), count), self.array[_ranges(first, count)], length

    def matches(self, items: Items) -> tuple[np.ndarray, np.ndarray]:
        """(test position, text position) of every verbatim match of SEED words (all of an item's words, if it has fewer)."""
        test, text, _ = self.longest(items)
        return test, text


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers of ranges, end to end."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def common_length(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    places: dict[int, int] = defaultdict(int)
    for i, word in enumerate(a):
        places[word] |= 1 << i
    mask = (1 << len(a)) - 1
    state = mask
    for word in b:
        hit = state & places.get(word, 0)
        state = ((state + hit) | (state - hit)) & mask
    return len(a) - state.bit_count()


def needed(n: int, share: float) -> int:
    """Words that must be held of an item of ``n``; a few words in order are a short phrase, so at least three (all, if it has fewer)."""
    return max(math.ceil(share * n), min(n, SEED))


def span_of(n: int) -> int:
    """One place: as many words of text as the item has, and the slack on both sides."""
    return n + 2 * max(4, n // 4)


def aligned(words: np.ndarray, item: list[int], need: int, kinds: np.ndarray, limit: np.ndarray) -> int:
    """Most words of the item in order within one place; 0 if no place holds ``need`` of them in any order.  ``kinds`` and ``limit`` are the item's words and how often it has each."""
    span = span_of(len(item))
    found = kinds.searchsorted(words)
    found[found == len(kinds)] = 0
    at = (kinds[found] == words).nonzero()[0]
    if len(at) < need:
        return 0
    # how many of the item's words the place from each of them on holds, a word at most as often as the item has it
    kind = found[at]
    order = kind.argsort(kind="stable")
    mine = np.arange(len(at)) - limit[kind[order]]
    same = (mine >= 0) & (kind[order[np.maximum(mine, 0)]] == kind[order])
    earlier = np.full(len(at), -1)
    earlier[order[same]] = at[order[mine[same]]]
    begin = np.sort(np.maximum(at - span, earlier) + 1)
    held = begin.searchsorted(at, side="right") - np.arange(len(at))
    best = 0
    for i in (-held).argsort(kind="stable").tolist():
        if held[i] < max(need, best + 1):
            break
        best = max(best, common_length(item, words[at[i : at.searchsorted(at[i] + span)]].tolist()))
    return best


def candidates(shard: Shard, items: Items, share: float):
    """(document's place, item's place, first and last text position) of all stretches that share, in any order, as many words as an item needs; no leak lies outside them."""
    at = np.flatnonzero(shard.words > 0)
    if not len(at):
        return
    size, number = len(items.vocabulary) + 1, len(items.ids)
    need = np.array([needed(n, share) for n in items.length.tolist()])
    doc = np.searchsorted(shard.doc_start, at, side="right") - 1
    for step, start, item, has in items.postings:
        # stretches of three steps, one from each step; a place has two at most, so it lies whole in one of them
        stretches = np.maximum(-(-np.diff(shard.doc_start) // step) - 2, 1)
        base = np.cumsum(stretches) - stretches
        local = (at - shard.doc_start[doc]) // step
        inside = [(local - back >= 0) & (local - back < stretches[doc]) for back in range(3)]
        key = np.concatenate([(base[doc] + local - back)[i] * size + shard.words[at][i] for back, i in enumerate(inside)])
        key, times = np.unique(key, return_counts=True)
        block, word = key // size, key % size
        count = start[word + 1] - start[word]
        total = np.cumsum(count)
        first = 0
        while first < len(block):  # as many stretches at a time as have EXPANDED postings, or one
            last = int(np.searchsorted(total, (total[first - 1] if first else 0) + EXPANDED, side="right"))
            if last < len(block):
                last = int(np.searchsorted(block, max(block[last], block[first] + 1)))
            some = slice(first, last)
            place = _ranges(start[word[some]], count[some])
            pair = np.repeat((block[some] - block[first]) * number, count[some]) + item[place]
            shared = np.bincount(pair, np.minimum(np.repeat(times[some], count[some]), has[place]), minlength=number)
            hit = np.flatnonzero(shared)
            hit = hit[shared[hit] >= need[hit % number]]
            owner = np.searchsorted(base, hit // number + block[first], side="right") - 1
            begin = shard.doc_start[owner] + (hit // number + block[first] - base[owner]) * step
            yield from zip(owner.tolist(), (hit % number).tolist(), begin.tolist(), np.minimum(begin + 3 * step, shard.doc_start[owner + 1]).tolist())
            first = last


def find(shard: Shard, items: Items, share: float = SHARE) -> list[tuple[int, int, int, int]]:
    """(document's place in the shard, item id, words held, longest verbatim match) of each leak."""
    test, text, length = shard.longest(items)
    pair = (np.searchsorted(shard.doc_start, text, side="right") - 1) * len(items.ids) + items.owner[test]
    order = np.lexsort((length, pair))
    last = order[np.append(pair[order][1:] != pair[order][:-1], True)] if len(pair) else order
    longest = dict(zip(pair[last].tolist(), length[last].tolist()))
    best: dict[tuple[int, int], int] = defaultdict(int)
    for d, k, begin, end in candidates(shard, items, share):
        n = int(items.length[k])
        if n < SEED:
            held = n if d * len(items.ids) + k in longest else 0
        else:
            held = aligned(shard.words[begin:end], items.words[items.ids[k]], needed(n, share), *items.kinds[k])
        if held >= needed(n, share):
            best[d, k] = max(best[d, k], held)
    found = []
    for (d, k), held in sorted(best.items()):
        run = longest.get(d * len(items.ids) + k)
        if run is None:  # no three words stand side by side
            item, words = items.words[items.ids[k]], shard.words[shard.doc_start[d] : shard.doc_start[d + 1]].tolist()
            run = 1 + (not set(zip(item, item[1:])).isdisjoint(zip(words, words[1:])))
        found.append((d, items.ids[k], held, run))
    return found


def item_parts(items: DataFrame, most: int = MAX_ITEM_BYTES) -> list[DataFrame]:
    """The held-out items in parts of about ``most`` bytes, by a hash of their ids; each is searched in a pass of its own."""
    rows = items.where("item_text IS NOT NULL AND item_id IS NOT NULL")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("item_text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // most))
    return [rows.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part) for part in range(parts)] if parts > 1 else [rows]


def item_blocks(items: DataFrame) -> list[list[tuple[int, str]]]:
    """The items of a part in blocks of at most BLOCK_WORDS words."""
    rows = items.where("item_text IS NOT NULL AND item_id IS NOT NULL")
    blocks: list[list] = [[]]
    words = 0
    for row in rows.select("item_id", "item_text").distinct().orderBy("item_id", "item_text").collect():  # about MAX_ITEM_BYTES
        words += len(row.item_text) // 4
        if words > BLOCK_WORDS and blocks[-1]:
            blocks.append([])
            words = len(row.item_text) // 4
        blocks[-1].append((row.item_id, row.item_text))
    return blocks


def _split(texts: list[str | None], blocks: int) -> list:
    """The texts' words, if more than one block of items asks for them; the texts as they are otherwise."""
    return [words_of(t) if t else [] for t in texts] if blocks > 1 else texts


def leaks(documents: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, words_held, longest_match) of every document and item leaked into it."""
    return reduce(DataFrame.union, [_leaks(documents, item_blocks(part), share) for part in item_parts(items)])


def _leaks(documents: DataFrame, blocks: list[list[tuple[int, str]]], share: float) -> DataFrame:
    names, types = ["doc_id", "item_id", "words_held", "longest_match"], [pa.int64(), pa.int64(), pa.int32(), pa.int32()]

    def run(it):
        made = [Items(block) for block in blocks]
        for batch in it:
            ids, out = strings(batch, "doc_id"), []
            texts = _split(strings(batch, "text"), len(made))
            for block in made:
                if block.ids:
                    out += [(ids[d], *rest) for d, *rest in find(Shard(texts, block.vocabulary), block, share)]
            yield frame(names, list(zip(*out)) or [[] for _ in names], types)

    rows = documents.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL AND text <> ''")
    return rows.mapInArrow(run, "doc_id bigint, item_id bigint, words_held int, longest_match int")


def unaffected(documents: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """The rows of the documents that no item leaked into, with all their columns; they are filtered where they lie, once for each part of the items."""
    for part in item_parts(items):
        documents = _unaffected(documents, item_blocks(part), share)
    return documents


def _unaffected(documents: DataFrame, blocks: list[list[tuple[int, str]]], share: float) -> DataFrame:
    def run(it):
        made = [Items(block) for block in blocks]
        for batch in it:
            texts = _split(strings(batch, "text"), len(made))
            keep = np.ones(len(texts), bool)
            for block in made:
                if block.ids:
                    keep[[d for d, *_ in find(Shard(texts, block.vocabulary), block, share)]] = False
            yield batch.filter(pa.array(keep))

    return documents.mapInArrow(run, documents.schema)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the evaluation items leaked into them."""
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "eval_items")).select("doc_id", "item_id").distinct()


def p9_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every evaluation item, whether and where it leaked."""
    found = leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "eval_items")).distinct()
    documents = read(spark, sf_dir, "documents").select("doc_id", "source")
    per_item = found.join(documents, "doc_id").groupBy("item_id").agg(
        F.count_distinct("doc_id").alias("documents"), F.count_distinct("source").alias("sources"), F.max("words_held").alias("most_words"), F.max("longest_match").alias("longest_match")
    )
    items = read(spark, sf_dir, "eval_items").select("item_id", "suite").distinct()
    return items.join(per_item, "item_id", "left").select("item_id", "suite", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("sources", F.lit(0)).alias("sources"), "most_words", "longest_match")


def p9_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus without the documents that an evaluation item leaked into; those without an id or a text stay."""
    return unaffected(read(spark, sf_dir, "documents"), read(spark, sf_dir, "eval_items"))
