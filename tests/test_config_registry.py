import datetime

import pytest

from folioflow.config import Config, assign, lookup, new_run_id
from folioflow.plans import registry


def test_environment_overrides():
    c = Config.from_env({"NLP_MAX_PAGES": "3", "NLP_INJECTION_GUARD": "Yes", "NLP_BACKEND": "lexical"})
    assert (c.max_pages, c.injection_guard, c.backend, c.min_words) == (3, True, "lexical", 120)
    assert Config.from_env({"NLP_INJECTION_GUARD": ""}).injection_guard is False
    assert Config.from_env({"NLP_INJECTION_GUARD": "0"}).injection_guard is False


def test_fingerprint_follows_only_its_keys():
    a, b = Config(), Config(min_words=5)
    assert a.fingerprint(["MAX_PAGES"]) == b.fingerprint(["MAX_PAGES"])
    assert a.fingerprint(["MIN_WORDS"]) != b.fingerprint(["MIN_WORDS"])


def test_run_id_and_paths():
    assert new_run_id(datetime.datetime(2026, 1, 5, 9, 40, 14)) == "2026-01-05T09-40-14Z"
    tree = assign({}, "a.b", 1)
    assert lookup(tree, "a.b") == 1 and lookup(tree, "a.c", 7) == 7 and lookup({"a": None}, "a", 2) == 2


def test_order_and_closure():
    assert [s.name for s in registry.ordered()] == ["extract", "clean", "validate", "keywords", "classify", "context", "summarize"]
    assert registry.downstream(["context"]) == {"context", "summarize"}
    assert registry.downstream(["clean"]) == {"clean", "validate", "keywords", "classify", "context", "summarize"}


def test_selection():
    stages, forced = registry.select(through="clean", only=["summarize"])
    assert [s.name for s in stages] == ["extract", "clean"] and forced == set()
    assert registry.select(only=["context"])[1] == {"context", "summarize"}
    with pytest.raises(ValueError):
        registry.select(only=["nothing"])


def test_cycles_are_refused():
    with pytest.raises(ValueError):
        registry.ordered({"a": registry.Stage("a", "1", ("b",)), "b": registry.Stage("b", "1", ("a",))})


def test_recursive_query_agrees(spark):
    got = {(r.stage, r.affected) for r in registry.closure(spark).collect()}
    assert got == {(s.name, x) for s in registry.ordered() for x in registry.downstream([s.name])}
