"""The stage graph: order, closure and selection."""

from __future__ import annotations

import functools
import graphlib
import importlib.util
from collections.abc import Iterable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..config import sha256


@functools.lru_cache
def source_of(module: str) -> str:
    """The source text of a module of this package, or of a file."""
    if module.endswith(".py"):
        return Path(module).read_text(encoding="utf-8")
    found = importlib.util.find_spec(module)
    return found.loader.get_source(module)


@dataclass(frozen=True)
class Stage:
    name: str
    version: str
    needs: tuple[str, ...] = ()
    config_keys: tuple[str, ...] = ()
    #: the modules whose source decides what the stage computes
    modules: tuple[str, ...] = ()

    def code_fingerprint(self) -> str:
        """Of the stage's version and the source of its modules: an edited stage is computed anew."""
        return sha256("\x00".join([self.version, *map(source_of, self.modules)]))


def _of(*names: str) -> tuple[str, ...]:
    return tuple(f"folioflow.{n}" for n in names)


_MODEL = ("BACKEND", "DEVICE", "DTYPE")
STAGES = {
    s.name: s
    for s in (
        Stage("extract", "1", (), ("MAX_PAGES",), _of("sources.corpus")),
        Stage("clean", "1", ("extract",), (), _of("operators.clean", "functions.text")),
        Stage("validate", "1", ("clean",), ("MIN_WORDS", "MIN_CHARS"), _of("operators.validate", "functions.text")),
        Stage("keywords", "1", ("validate",), _MODEL, _of("operators.keywords", "functions.text", "models.backends")),
        Stage("classify", "1", ("keywords",), (*_MODEL, "ZEROSHOT_MAX_CHUNKS", "HYPOTHESIS_TEMPLATE", "TAXONOMY"), _of("operators.classify", "operators.windows", "models.backends")),
        Stage("context", "1", ("keywords", "clean"), ("REDUCED_CONTEXT_CHARS",), _of("operators.context", "functions.text")),
        Stage("summarize", "1", ("context",), ("SUMMARY_MAX_NEW_TOKENS", "REDUCED_CONTEXT_CHARS", "INJECTION_GUARD", "DEVICE"), _of("operators.summarize", "models.backends")),
    )
}
INFERENCE = ("keywords", "classify", "summarize")


def ordered(stages: dict[str, Stage] | None = None) -> list[Stage]:
    """Stages after all they need; of those that are ready together, by name."""
    every = STAGES if stages is None else stages
    graph = graphlib.TopologicalSorter({name: stage.needs for name, stage in every.items()})
    try:
        graph.prepare()
    except graphlib.CycleError as error:
        raise ValueError(f"stages need each other: {error.args[1]}") from error
    out: list[Stage] = []
    while graph.is_active():
        ready = sorted(graph.get_ready())
        graph.done(*ready)
        out.extend(every[name] for name in ready if name in every)
    return out


def downstream(names: Iterable[str], stages: dict[str, Stage] | None = None) -> set[str]:
    """The stages named and all that need one of them, directly or not."""
    found = set(names)
    for stage in ordered(stages):
        if found & set(stage.needs):
            found.add(stage.name)
    return found


def select(only: list[str] | None = None, through: str | None = None) -> tuple[list[Stage], set[str]]:
    """(stages to run, stages to compute anew); ``through`` wins and takes a prefix, ``only`` forces a closure."""
    every = ordered()
    names = [s.name for s in every]
    if unknown := sorted(set([through] if through else only or ()) - set(names)):
        raise ValueError(f"unknown stages: {unknown}")
    if through:
        return every[: names.index(through) + 1], set()
    return every, downstream(only) if only else set()


def edges_sql() -> str:
    """The graph as SQL values, (stage, needed)."""
    return ", ".join(f"('{s.name}', '{n}')" for s in ordered() for n in s.needs)


def closure(spark: SparkSession) -> DataFrame:
    """(stage, affected): for each stage, itself and everything downstream, by a recursive query."""
    return spark.sql(closure_sql())


def closure_sql() -> str:
    names = ", ".join(f"('{s.name}')" for s in ordered())
    return f"""
WITH RECURSIVE names(stage) AS (SELECT * FROM (VALUES {names}) AS n(stage)),
edges(stage, needed) AS (SELECT * FROM (VALUES {edges_sql()}) AS e(stage, needed)),
reach(stage, affected, steps) AS (
  SELECT stage, stage, 0 FROM names
  UNION ALL
  SELECT r.stage, e.stage, r.steps + 1 FROM reach r JOIN edges e ON e.needed = r.affected WHERE r.steps < {len(STAGES)}
)
SELECT DISTINCT stage, affected FROM reach"""
