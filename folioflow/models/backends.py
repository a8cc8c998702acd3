"""Model backends behind Arrow UDFs.

No model files are at hand, so the defaults are deterministic stand-ins: they keep
the interfaces and what is done with the scores, and make no claim to a model's
quality.  A backend is any object with the methods below; it is made once in each
Python worker and kept.
"""

from __future__ import annotations

import functools
import math
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

_TOKEN = re.compile(r"\w\w+")


class Encoder(Protocol):
    dimension: int

    def encode(self, texts: list[str]) -> np.ndarray: ...


class Scorer(Protocol):
    def logits(self, texts: list[str], hypothesis: str) -> np.ndarray: ...


class Generator(Protocol):
    def generate(self, prompts: list[str], max_tokens: int) -> list[tuple[str, int, int]]: ...


class HashingEncoder:
    """Hashed term frequencies, mean-pooled over token windows for long texts, of length 1."""

    def __init__(self, dimension: int = 256, window: int = 512):
        self.dimension, self.window = dimension, window

    def _one(self, tokens: list[str]) -> np.ndarray:
        vector = np.zeros(self.dimension, np.float32)
        for token in tokens:
            h = xxhash.xxh64_intdigest(token)
            vector[h % self.dimension] += 1.0 if h >> 63 else -1.0
        size = np.linalg.norm(vector)
        return vector / size if size else vector

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension), np.float32)
        for row, text in zip(out, texts):
            tokens = _TOKEN.findall((text or "").lower())
            parts = [self._one(tokens[i : i + self.window]) for i in range(0, len(tokens), self.window)]
            if parts:
                pooled = np.mean(parts, axis=0)
                size = np.linalg.norm(pooled)
                row[:] = pooled / size if size else pooled
        return out


class TruncatingEncoder:
    """Hashed character trigrams of a text's first tokens; what follows the window is left out, not pooled."""

    def __init__(self, dimension: int = 256, window: int = 512):
        self.dimension, self.window = dimension, window

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension), np.float32)
        for row, text in zip(out, texts):
            head = f" {' '.join(_TOKEN.findall((text or '').lower())[: self.window])} "
            for i in range(len(head) - 2):
                row[xxhash.xxh64_intdigest(head[i : i + 3]) % self.dimension] += 1.0
            row[:] = unit(row)
        return out


def unit(v: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(v)
    return v / size if size else v


def masked_mean(hidden: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Means of token vectors over the tokens that aren't padding, each of length 1."""
    weights = mask[:, :, None].astype(hidden.dtype)
    pooled = (hidden * weights).sum(axis=1) / np.maximum(weights.sum(axis=1), 1e-9)
    size = np.linalg.norm(pooled, axis=1, keepdims=True)
    return pooled / np.where(size > 0, size, 1)


class OnnxModel:
    """A model of a local folder with ``model.onnx`` and ``tokenizer.json``, cut at ``window`` tokens; needs onnxruntime and tokenizers."""

    def __init__(self, folder: str, window: int = 512, threads: int = 1):
        import onnxruntime
        from tokenizers import Tokenizer

        options = onnxruntime.SessionOptions()
        options.intra_op_num_threads = threads
        self.session = onnxruntime.InferenceSession(f"{folder}/model.onnx", options, providers=["CPUExecutionProvider"])
        self.tokenizer = Tokenizer.from_file(f"{folder}/tokenizer.json")
        self.tokenizer.enable_truncation(window)
        self.tokenizer.enable_padding()
        self.inputs = [i.name for i in self.session.get_inputs()]

    def run(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(first output, attention mask) of texts or pairs of texts."""
        made = self.tokenizer.encode_batch(texts)
        given = {"input_ids": [e.ids for e in made], "attention_mask": [e.attention_mask for e in made], "token_type_ids": [e.type_ids for e in made]}
        arrays = {k: np.array(v, np.int64) for k, v in given.items()}
        return self.session.run(None, {k: arrays[k] for k in self.inputs})[0], arrays["attention_mask"]


class OnnxEncoder:
    """Sentence vectors by the masked mean of an encoder's last layer; texts beyond the window are cut."""

    def __init__(self, folder: str):
        self.model = OnnxModel(folder)

    def encode(self, texts: list[str]) -> np.ndarray:
        return masked_mean(*self.model.run([t or "" for t in texts]))


class OnnxScorer:
    """Entailment logits of an inference model for (text, hypothesis); ``entails`` is the place of that class."""

    def __init__(self, folder: str, entails: int = 0, contradicts: int = -1):
        self.model, self.entails, self.contradicts = OnnxModel(folder), entails, contradicts

    def logits(self, texts: list[str], hypothesis: str) -> np.ndarray:
        out, _ = self.model.run([(t or "", hypothesis) for t in texts])
        return out[:, self.entails] - out[:, self.contradicts]


class LexicalScorer:
    """Scores a hypothesis by the cosine of its encoding with the text's, scaled to a logit."""

    def __init__(self, encoder: Encoder | None = None, scale: float = 8.0):
        self.encoder, self.scale = encoder or HashingEncoder(), scale

    def logits(self, texts: list[str], hypothesis: str) -> np.ndarray:
        return self.encoder.encode(texts) @ self.encoder.encode([hypothesis])[0] * self.scale


class LeadingSentence:
    """Answers with the first sentence between the fences, cut at the token limit."""

    def generate(self, prompts: list[str], max_tokens: int) -> list[tuple[str, int, int]]:
        out = []
        for prompt in prompts:
            inner = re.search(r"<<<BEGIN_SOURCE>>>\n(.*)\n<<<END_SOURCE>>>|one sentence:\n(.*)\n", prompt, re.S)
            source = next((g for g in inner.groups() if g is not None), "") if inner else prompt
            sentence = re.split(r"(?<=[.!?])\s", source.strip(), maxsplit=1)[0]
            words = sentence.split()[:max_tokens]
            out.append((" ".join(words), len(prompt.split()), len(words)))
        return out


class OverlapScorer:
    """Scores a hypothesis by the share of its content words that the text holds, as a logit around one half."""

    _COMMON = frozenset("this example is a an of the and or to for in".split())

    def logits(self, texts: list[str], hypothesis: str) -> np.ndarray:
        wanted = set(_TOKEN.findall(hypothesis.lower())) - self._COMMON
        shares = [len(wanted & set(_TOKEN.findall((t or "").lower()))) / max(1, len(wanted)) for t in texts]
        return 8.0 * (np.array(shares) - 0.5)


@dataclass(frozen=True)
class Backend:
    """The models that a run's setting ``backend`` names."""

    encoder: str
    scorer: str
    generator: str = "leading"


FACTORIES: dict[str, Callable[[], object]] = {"hashing": HashingEncoder, "truncating": TruncatingEncoder, "lexical": LexicalScorer, "overlap": OverlapScorer, "leading": LeadingSentence}
BACKENDS = {"hashing": Backend("hashing", "lexical"), "lexical": Backend("truncating", "overlap")}


def register(name: str, factory: Callable[[], object]) -> None:
    FACTORIES[name] = factory


def backend(name: str) -> Backend:
    """The models of a setting; ``onnx:FOLDER`` has an encoder in FOLDER/encoder and an inference model in FOLDER/nli, on every worker."""
    if name.startswith("onnx:"):
        folder = name.removeprefix("onnx:")
        register(f"encoder {name}", functools.partial(OnnxEncoder, f"{folder}/encoder"))
        register(f"scorer {name}", functools.partial(OnnxScorer, f"{folder}/nli"))
        return Backend(f"encoder {name}", f"scorer {name}")
    if name not in BACKENDS:
        raise ValueError(f"no backend {name!r}; there are {sorted(BACKENDS)} and onnx:FOLDER")
    return BACKENDS[name]


_LIVE: dict[str, object] = {}
#: seconds that loading each live model took in this process
LOADED: dict[str, float] = {}


def live(name: str, factory: Callable[[], object] | None = None) -> object:
    """The worker's one instance of a model; the others are released first, so that a worker holds one at a time."""
    if name not in _LIVE:
        release_all()
        began = time.monotonic()
        _LIVE[name] = (factory or FACTORIES[name])()
        LOADED[name] = time.monotonic() - began
    return _LIVE[name]


def release_all() -> None:
    """Drops the live models; one that has a method ``close`` is closed."""
    while _LIVE:
        _, model = _LIVE.popitem()
        if close := getattr(model, "close", None):
            close()


def encoded(text: Column, name: str = "hashing") -> Column:
    factory = FACTORIES[name]

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = live(name, factory)
        for batch in batches:
            yield pd.Series(list(encoder.encode(batch.fillna("").tolist())))

    return run(text)


def scores(scorer: Scorer, texts: list[str], labels: tuple[str, ...], template: str, exclusive: bool) -> np.ndarray:
    """[text, label]: a softmax across labels if they exclude each other, else each for itself."""
    if not texts:
        return np.zeros((0, len(labels)))
    logits = np.stack([scorer.logits(texts, template.replace("{}", label)) for label in labels], axis=1).astype(float)
    if exclusive:
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)
    return 1 / (1 + np.exp(-logits))


def label_scores(text: Column, labels: tuple[str, ...], template: str, exclusive: bool, name: str = "lexical") -> Column:
    """label -> score of one text."""
    factory = FACTORIES[name]

    @F.pandas_udf("map<string,double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = live(name, factory)
        for batch in batches:
            found = scores(scorer, batch.fillna("").tolist(), labels, template, exclusive)
            yield pd.Series([dict(zip(labels, map(float, row))) for row in found])

    return run(text)


def generate(self, prompts: list[str], max_tokens: int) -> list[tuple[str, int, int]]: ...


class Known(dict):
    """What a function gives for each key, kept; all is forgotten when there are ``most``."""

    def __init__(self, f: Callable[[str], object], most: int = 500_000):
        super().__init__()
        self.f, self.most = f, most

    def __missing__(self, key: str) -> object:
        value = self.f(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


class HashingEncoder:
    """Hashed term frequencies, mean-pooled over token windows for long texts, of length 1."""

    #: a text within the window is encoded by the sum of its tokens' slots
    of_words = True

    def __init__(self, dimension: int = 256, window: int = 512):
        self.dimension, self.window, self._slots = dimension, window, Known(self._slot)

    def _slot(self, token: str) -> int:
        h = xxhash.xxh64_intdigest(token)
        return h % self.dimension * 2 + (h >> 63)

    def slots(self, text: str) -> list[int]:
        """For each token twice its place in the vector, and one more if it counts up there."""
        return [self._slots[token] for token in _TOKEN.findall(text.lower())]

    def _one(self, tokens: list[str]) -> np.ndarray:
        counts = np.bincount(np.fromiter(map(self._slots.__getitem__, tokens), np.int64, len(tokens)), minlength=2 * self.dimension)
        vector = (counts[1::2] - counts[::2]).astype(np.float32)
        size = np.linalg.norm(vector)
        return vector / size if size else vector

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension), np.float32)
        for row, text in zip(out, texts):
            tokens = _TOKEN.findall((text or "").lower())
            parts = [self._one(tokens[i : i + self.window]) for i in range(0, len(tokens), self.window)]
            if parts:
                pooled = np.mean(parts, axis=0) if len(parts) > 1 else parts[0]
                size = np.linalg.norm(pooled)
                row[:] = pooled / size if size else pooled
        return out


class TruncatingEncoder:
    """Hashed character trigrams of a text's first tokens; what follows the window is left out, not pooled."""

    def __init__(self, dimension: int = 256, window: int = 512):
        self.dimension, self.window = dimension, window

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension), np.float32)
        for row, text in zip(out, texts):
            head = f" {' '.join(_TOKEN.findall((text or '').lower())[: self.window])} "
            for i in range(len(head) - 2):
                row[xxhash.xxh64_intdigest(head[i : i + 3]) % self.dimension] += 1.0
            row[:] = unit(row)
        return out


def unit(v: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(v)
    return v / size if size else v


def masked_mean(hidden: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Means of token vectors over the tokens that aren't padding, each of length 1."""
    weights = mask[:, :, None].astype(hidden.dtype)
    pooled = (hidden * weights).sum(axis=1) / np.maximum(weights.sum(axis=1), 1e-9)
    size = np.linalg.norm(pooled, axis=1, keepdims=True)
    return pooled / np.where(size > 0, size, 1)


class OnnxModel:
    """A model of a local folder with ``model.onnx`` and ``tokenizer.json``, cut at ``window`` tokens; needs onnxruntime and tokenizers."""

    def __init__(self, folder: str, window: int = 512, threads: int = 1):
        import onnxruntime
        from tokenizers import Tokenizer

        options = onnxruntime.SessionOptions()
        options.intra_op_num_threads = threads
        self.session = onnxruntime.InferenceSession(f"{folder}/model.onnx", options, providers=["CPUExecutionProvider"])
        self.tokenizer = Tokenizer.from_file(f"{folder}/tokenizer.json")
        self.tokenizer.enable_truncation(window)
        self.tokenizer.enable_padding()
        self.inputs = [i.name for i in self.session.get_inputs()]

    def run(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(first output, attention mask) of texts or pairs of texts."""
        made = self.tokenizer.encode_batch(texts)
        given = {"input_ids": [e.ids for e in made], "attention_mask": [e.attention_mask for e in made], "token_type_ids": [e.type_ids for e in made]}
        arrays = {k: np.array(v, np.int64) for k, v in given.items()}
        return self.session.run(None, {k: arrays[k] for k in self.inputs})[0], arrays["attention_mask"]


class OnnxEncoder:
    """Sentence vectors by the masked mean of an encoder's last layer; texts beyond the window are cut."""

    def __init__(self, folder: str):
        self.model = OnnxModel(folder)

    def encode(self, texts: list[str]) -> np.ndarray:
        return masked_mean(*self.model.run([t or "" for t in texts]))


class OnnxScorer:
    """Entailment logits of an inference model for (text, hypothesis); ``entails`` is the place of that class."""

    def __init__(self, folder: str, entails: int = 0, contradicts: int = -1):
        self.model, self.entails, self.contradicts = OnnxModel(folder), entails, contradicts

    def logits(self, texts: list[str], hypothesis: str) -> np.ndarray:
        out, _ = self.model.run([(t or "", hypothesis) for t in texts])
        return out[:, self.entails] - out[:, self.contradicts]


class LexicalScorer:
    """Scores a hypothesis by the cosine of its encoding with the text's, scaled to a logit."""

    def __init__(self, encoder: Encoder | None = None, scale: float = 8.0):
        self.encoder, self.scale = encoder or HashingEncoder(), scale

    def logits(self, texts: list[str], hypothesis: str) -> np.ndarray:
        return self.encoder.encode(texts) @ self.encoder.encode([hypothesis])[0] * self.scale


class LeadingSentence:
    """Answers with the first sentence between the fences, cut at the token limit."""

    def generate(self, prompts: list[str], max_tokens: int) -> list[tuple[str, int, int]]:
        out = []
        for prompt in prompts:
            inner = re.search(r"<<<BEGIN_SOURCE>>>\n(.*)\n<<<END_SOURCE>>>|one sentence:\n(.*)\n", prompt, re.S)
            source = next((g for g in inner.groups() if g is not None), "") if inner else prompt
            sentence = re.split(r"(?<=[.!?])\s", source.strip(), maxsplit=1)[0]
            words = sentence.split()[:max_tokens]
            out.append((" ".join(words), len(prompt.split()), len(words)))
        return out


class OverlapScorer:
    """Scores a hypothesis by the share of its content words that the text holds, as a logit around one half."""

    _COMMON = frozenset("this example is a an of the and or to for in".split())

    def logits(self, texts: list[str], hypothesis: str) -> np.ndarray:
        wanted = set(_TOKEN.findall(hypothesis.lower())) - self._COMMON
        shares = [len(wanted & set(_TOKEN.findall((t or "").lower()))) / max(1, len(wanted)) for t in texts]
        return 8.0 * (np.array(shares) - 0.5)


@dataclass(frozen=True)
class Backend:
    """The models that a run's setting ``backend`` names."""

    encoder: str
    scorer: str
    generator: str = "leading"


FACTORIES: dict[str, Callable[[], object]] = {"hashing": HashingEncoder, "truncating": TruncatingEncoder, "lexical": LexicalScorer, "overlap": OverlapScorer, "leading": LeadingSentence}
BACKENDS = {"hashing": Backend("hashing", "lexical"), "lexical": Backend("truncating", "overlap")}


def register(name: str, factory: Callable[[], object]) -> None:
    FACTORIES[name] = factory


def backend(name: str) -> Backend:
    """The models of a setting; ``onnx:FOLDER`` has an encoder in FOLDER/encoder and an inference model in FOLDER/nli, on every worker."""
    if name.startswith("onnx:"):
        folder = name.removeprefix("onnx:")
        register(f"encoder {name}", functools.partial(OnnxEncoder, f"{folder}/encoder"))
        register(f"scorer {name}", functools.partial(OnnxScorer, f"{folder}/nli"))
        return Backend(f"encoder {name}", f"scorer {name}")
    if name not in BACKENDS:
        raise ValueError(f"no backend {name!r}; there are {sorted(BACKENDS)} and onnx:FOLDER")
    return BACKENDS[name]


_LIVE: dict[str, object] = {}
#: seconds that loading each live model took in this process
LOADED: dict[str, float] = {}


def live(name: str, factory: Callable[[], object] | None = None) -> object:
    """The worker's one instance of a model; the others are released first, so that a worker holds one at a time."""
    if name not in _LIVE:
        release_all()
        began = time.monotonic()
        _LIVE[name] = (factory or FACTORIES[name])()
        LOADED[name] = time.monotonic() - began
    return _LIVE[name]


def release_all() -> None:
    """Drops the live models; one that has a method ``close`` is closed."""
    while _LIVE:
        _, model = _LIVE.popitem()
        if close := getattr(model, "close", None):
            close()


def encoded(text: Column, name: str = "hashing") -> Column:
    factory = FACTORIES[name]

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = live(name, factory)
        for batch in batches:
            yield pd.Series(list(encoder.encode(batch.fillna("").tolist())))

    return run(text)


def label_scores(text: Column, labels: tuple[str, ...], template: str, exclusive: bool, name: str = "lexical") -> Column:
    """label -> score of one text: a softmax across labels if they exclude each other, else each for itself."""
    factory = FACTORIES[name]

    @F.pandas_udf("map<string,double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        backend = live(name, factory)
        for batch in batches:
            texts = batch.fillna("").tolist()
            logits = np.stack([backend.logits(texts, template.replace("{}", label)) for label in labels], axis=1).astype(float)
            if exclusive:
                e = np.exp(logits - logits.max(axis=1, keepdims=True))
                scores = e / e.sum(axis=1, keepdims=True)
            else:
                scores = 1 / (1 + np.exp(-logits))
            yield pd.Series([dict(zip(labels, map(float, row))) for row in scores])

    return run(text)


def generate(df: DataFrame, prompt: str, max_tokens: int, name: str = "leading") -> DataFrame:
    """Adds summary, prompt_tokens, generated_tokens and error; a failure becomes the row's error.

    An opaque plan node: no filter behind it makes the model answer twice.
    """
    factory, columns = FACTORIES[name], [c for c in df.columns if c != prompt]
    new = StructType([StructField("summary", StringType()), StructField("prompt_tokens", IntegerType()), StructField("generated_tokens", IntegerType()), StructField("error", StringType())])
    schema = StructType([*(df.schema[c] for c in columns), *new.fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generator = live(name, factory)
        for batch in batches:
            rows = []
            for text in batch[prompt]:
                try:
                    rows.append((*generator.generate([text or ""], max_tokens)[0], None))
                except Exception as e:  # noqa: BLE001 - one bad document must not end the job
                    rows.append((None, None, None, f"{type(e).__name__}: {e}"))
            answers = pd.DataFrame(rows, columns=new.names, dtype=object)
            yield pd.concat([batch[columns].reset_index(drop=True), answers], axis=1)

    return df.mapInPandas(run, schema)


def cosine(a: list[float], b: list[float]) -> float:
    size = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
    return sum(x * y for x, y in zip(a, b)) / size if size else 0.0
