"""Run configuration: a frozen record, overridable by environment variables, with fingerprints of its parts."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import UTC, datetime

PREFIX = "NLP_"
_TRUE = {"1", "true", "yes", "on"}
#: how the text of a variable becomes a value of the default's type
_PARSERS = {bool: lambda raw, default: raw.strip().lower() in _TRUE if raw else default, int: lambda raw, _: int(raw), str: lambda raw, _: raw}


@dataclass(frozen=True)
class Config:
    max_pages: int = 0
    max_pdfs: int = 0
    injection_guard: bool = False
    backend: str = "hashing"
    device: str = "cpu"
    dtype: str = "fp32"
    workers: int = 1
    cpu_threads: int = 1
    batch_size: int = 1
    summary_max_new_tokens: int = 64
    reduced_context_chars: int = 2000
    zeroshot_max_chunks: int = 3
    min_words: int = 120
    min_chars: int = 0
    protocol: str = "A"
    taxonomy: str = "both"
    hypothesis_template: str = "This example is {}."

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Config:
        """The defaults, and what the environment sets in NLP_<FIELD>; an empty string keeps a boolean's default."""
        given = {name.removeprefix(PREFIX).lower(): raw for name, raw in (os.environ if env is None else env).items() if name.startswith(PREFIX)}
        return cls(**{name: _PARSERS[type(default)](given[name], default) for name, default in vars(cls()).items() if name in given})

    def settings(self) -> dict[str, object]:
        """All settings by their names in the environment, without the prefix."""
        return {name.upper(): value for name, value in vars(self).items()}

    def fingerprint(self, keys: Iterable[str]) -> str:
        """SHA-256 over the canonical JSON of the settings named; an unknown name is an error."""
        mine, wanted = self.settings(), frozenset(keys)
        if missing := wanted - mine.keys():
            raise KeyError(f"no such settings: {sorted(missing)}")
        return sha256(canonical_json({name: value for name, value in mine.items() if name in wanted}))

    def snapshot(self) -> str:
        return canonical_json(vars(self))


#: name -> settings of a run mode, for comparing runs
MODES = {
    "full": {"NLP_MAX_PAGES": "0"},
    "page1": {"NLP_MAX_PAGES": "1"},
    "guard-on": {"NLP_INJECTION_GUARD": "1"},
    "guard-off": {"NLP_INJECTION_GUARD": "0"},
    "hashing": {"NLP_BACKEND": "hashing"},
    "lexical": {"NLP_BACKEND": "lexical"},
}

#: settings under which first pages are judged by few words and characters
FIRST_PAGE = {"NLP_MAX_PAGES": "1", "NLP_MIN_WORDS": "20", "NLP_MIN_CHARS": "100"}


def canonical_json(value: object) -> str:
    return json.dumps(value, sort_keys=True, default=str)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def new_run_id(now: datetime | None = None) -> str:
    return (now or datetime.now(UTC)).strftime("%Y-%m-%dT%H-%M-%SZ")


def load_tree(path: str) -> dict:
    """The nested settings of a YAML or JSON file; an empty file has none."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    if path.endswith(".json"):
        tree = json.loads(text or "{}")
    else:
        import yaml  # only files in YAML need it

        tree = yaml.safe_load(text)
    if not isinstance(tree or {}, Mapping):
        raise ValueError(f"{path} holds no mapping")
    return dict(tree or {})


def lookup(tree: Mapping, path: str, default: object = None) -> object:
    """A dotted path into nested mappings; a missing or null value gives the default."""
    at: object = tree
    for part in path.split("."):
        if not isinstance(at, Mapping) or at.get(part) is None:
            return default
        at = at[part]
    return at


def assign(tree: dict, path: str, value: object) -> dict:
    """The tree with the value set at a dotted path."""
    head, _, rest = path.partition(".")
    return {**tree, head: assign(dict(tree.get(head) or {}), rest, value) if rest else value}
