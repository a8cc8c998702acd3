"""Problem 8: token ids of every text by a byte-level BPE vocabulary.

The words (pre-tokens) frequent in the whole corpus are compiled, with their ids,
into a minimal acyclic automaton: common suffixes are shared, the number of words
accepted below each node turns a path into the word's index, and the index leads
to its ids.  The arrays are written once to the shared folder and memory-mapped
by every worker.  A word that the automaton lacks is merged exactly, by ranks.
The lexicon therefore decides only the speed, never an id.

Defined cases: null and empty texts give an empty list; the strings of special
tokens are ordinary text; a repeated row is encoded again; one huge word costs
O(n log n) merges.
"""

from __future__ import annotations

import base64
import heapq
import os
import uuid
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import local_path, read, shared_dir, strings

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEXICON_WORDS = 50_000
LEXICON_COUNT = 5
MAX_VOCABULARY_BYTES = 64 << 20
MAX_WORD_BYTES = 64


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def load_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Exact BPE: the adjacent pair of lowest rank first, the leftmost of equals."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    parts: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, word[i : i + 2]) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else n
        if j >= n or parts[i] + parts[j] != pair:
            continue  # one of the two was merged since
        parts[i], parts[j] = pair, None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(both := pair + parts[k])) is not None:
                heapq.heappush(heap, (r, i, both))
        if (h := before[i]) >= 0 and (r := ranks.get(both := parts[h] + pair)) is not None:
            heapq.heappush(heap, (r, h, both))
    return [ranks[p] for p in parts if p is not None]


class Lexicon:
    """A minimal acyclic automaton over bytes whose words are numbered in byte order."""

    FIELDS = ("edge_key", "edge_to", "edge_skip", "final", "id_start", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, words: dict[bytes, list[int]]) -> Lexicon:
        """Words are added in order; a node that no later word can touch is replaced by its equal, if there is one."""
        order = sorted(words)
        register: dict[tuple, int] = {}
        nodes: list[tuple[bool, tuple]] = []

        def freeze(final: bool, edges: list) -> int:
            key = final, tuple(edges)
            if key not in register:
                register[key] = len(nodes)
                nodes.append(key)
            return register[key]

        path: list[list] = [[False, []]]  # nodes of the last word that may still grow
        letters: list[int] = []
        for word in order:
            shared = 0
            while shared < min(len(word), len(letters)) and word[shared] == letters[shared]:
                shared += 1
            while len(letters) > shared:
                final, edges = path.pop()
                path[-1][1].append((letters.pop(), freeze(final, edges)))
            for letter in word[shared:]:
                letters.append(letter)
                path.append([False, []])
            path[-1][0] = True
        while letters:
            final, edges = path.pop()
            path[-1][1].append((letters.pop(), freeze(final, edges)))
        root = len(nodes)
        nodes.append((path[0][0], tuple(path[0][1])))

        below = []  # a node's edges lead to earlier nodes only
        for final, edges in nodes:
            below.append(int(final) + sum(below[to] for _, to in edges))
        keys, targets, skips = [], [], []
        for node, (final, edges) in enumerate(nodes):
            skip = int(final)
            for letter, to in edges:
                keys.append((root - node) * 256 + letter)  # the root becomes node 0
                targets.append(root - to)
                skips.append(skip)
                skip += below[to]
        by_key = np.argsort(np.array(keys, np.int64), kind="stable")
        outputs = [words[w] for w in order]
        return cls({
            "edge_key": np.array(keys, np.int64)[by_key],
            "edge_to": np.array(targets, np.int64)[by_key],
            "edge_skip": np.array(skips, np.int64)[by_key],
            "final": np.array([final for final, _ in reversed(nodes)], bool),
            "id_start": np.concatenate([[0], np.cumsum([len(x) for x in outputs])]).astype(np.int64),
            "ids": np.fromiter(chain.from_iterable(outputs), np.int32),
        })

    def save(self, folder: str) -> None:
        os.makedirs(folder, exist_ok=True)
        for name in self.FIELDS:
            np.save(f"{folder}/{name}.npy", getattr(self, name))

    @classmethod
    def mapped(cls, folder: str) -> Lexicon:
        return cls({name: np.load(f"{folder}/{name}.npy", mmap_mode="r") for name in cls.FIELDS})

    def index(self, words: list[bytes]) -> np.ndarray:
        """Each word's number, -1 for words the automaton doesn't accept; all words walk it together, byte by byte."""
        found = np.full(len(words), -1, np.int64)
        if not len(self.edge_key) or not words:
            return found
        length = np.fromiter(map(len, words), np.int64, len(words))
        start = np.concatenate([[0], np.cumsum(length)[:-1]])
        letters = np.frombuffer(b"".join(words), np.uint8)
        alive = np.flatnonzero((length > 0) & (length <= MAX_WORD_BYTES))
        node, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        step = 0
        while len(alive):
            key = node[alive] * 256 + letters[start[alive] + step]
            at = np.minimum(np.searchsorted(self.edge_key, key), len(self.edge_key) - 1)
            hit = self.edge_key[at] == key
            alive, at = alive[hit], at[hit]
            node[alive] = self.edge_to[at]
            number[alive] += self.edge_skip[at]
            step += 1
            over = length[alive] == step
            done = alive[over]
            done = done[self.final[node[done]]]
            found[done] = number[done]
            alive = alive[~over]
        return found

    def output(self, number: int) -> np.ndarray:
        return self.ids[self.id_start[number] : self.id_start[number + 1]]


class Encoder:
    """Encodes batches of texts; one per worker process."""

    _made: dict[str, Encoder] = {}

    def __init__(self, ranks: dict[bytes, int], lexicon: Lexicon):
        self.ranks, self.lexicon, self.words = ranks, lexicon, regex.compile(PATTERN).findall

    @classmethod
    def of(cls, name: str, vocabulary, lexicon) -> Encoder:
        """From a broadcast vocabulary and a folder, or a broadcast dict of arrays; kept for the worker's later tasks."""
        if name not in cls._made:
            cls._made.clear()
            cls._made[name] = cls(load_ranks(vocabulary.value), Lexicon.mapped(lexicon) if isinstance(lexicon, str) else Lexicon(lexicon.value))
        return cls._made[name]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(start of each text's ids, ids of all texts)."""
        split = [self.words(t) if t else () for t in texts]
        distinct = list(set(chain.from_iterable(split)))
        raw = [w.encode("utf-8", "surrogatepass") for w in distinct]
        numbers = self.lexicon.index(raw)
        ids = {w: self.lexicon.output(n).tolist() if n >= 0 else merge(b, self.ranks) for w, b, n in zip(distinct, raw, numbers.tolist())}
        per_text = [list(chain.from_iterable(map(ids.__getitem__, words))) for words in split]
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, per_text), np.int64, len(per_text)))])
        return starts, np.fromiter(chain.from_iterable(per_text), np.int32, int(starts[-1]))


def word_counts(texts: DataFrame, column: str = "text", longest: int = MAX_WORD_BYTES) -> DataFrame:
    """(word, n) of the words of at most ``longest`` bytes over all texts; each batch is counted before the shuffle."""

    def run(it):
        words = regex.compile(PATTERN).findall
        for batch in it:
            counts: Counter = Counter()
            for text in strings(batch, column):
                if text:
                    counts.update(words(text))
            for word in [w for w in counts if 4 * len(w) > longest and len(w.encode("utf-8", "surrogatepass")) > longest]:
                del counts[word]  # before the shuffle: the automaton takes no such word
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    return texts.select(column).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def compile_lexicon(texts: DataFrame, ranks: dict[bytes, int], size: int = LEXICON_WORDS, least: int = LEXICON_COUNT) -> Lexicon:
    """The ``size`` most frequent words of the corpus; this bound keeps what reaches the driver small."""
    frequent = word_counts(texts).where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(size)
    words = [row.word.encode("utf-8", "surrogatepass") for row in frequent.select("word").collect()]
    return Lexicon.build({w: merge(w, ranks) for w in words})


def encode_texts(texts: DataFrame, key: str = "doc_id", column: str = "text", vocabulary: str | None = None, size: int = LEXICON_WORDS) -> DataFrame:
    """(key, ids) of each row."""
    spark = texts.sparkSession
    path = vocabulary or default_vocabulary()
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError("the vocabulary is too large to be sent to every worker")
    with open(path, "rb") as file:
        content = file.read()
    lexicon = compile_lexicon(texts.select(F.col(column).alias("text")), load_ranks(content), size)
    name = f"lexicon-{uuid.uuid4().hex}"
    if folder := local_path(shared_dir(spark)):
        where = f"{folder}/{name}"
        lexicon.save(where)
    else:  # a shared folder that can't be mapped as a file: at most ``size`` words go to the workers by broadcast
        where = spark.sparkContext.broadcast({name: getattr(lexicon, name) for name in Lexicon.FIELDS})
    sent = spark.sparkContext.broadcast(content)
    rows = texts.select(F.col(key).alias("doc_id"), F.col(column).alias("text"))

    def run(it):
        for batch in it:
            starts, ids = Encoder.of(name, sent, where).encode(strings(batch, "text"))
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "ids"])

    return rows.mapInArrow(run, "doc_id bigint, ids array<int>")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k."""
    return encode_texts(read(spark, sf_dir, "documents"))  # doc_id is unique
