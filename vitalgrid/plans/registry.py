"""Registry of derived tables: a function per table, its dependencies and its DuckDB SQL.

``Context`` resolves names to DataFrames once each.  Nothing runs until a result is written; tables
that several others read may be kept with ``persist_shared``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Concept:
    name: str
    build: Callable[[Context], DataFrame]
    deps: tuple[str, ...]
    sql: str | None


CONCEPTS: dict[str, Concept] = {}


def concept(name: str, deps: Sequence[str], sql: str | None = None):
    def register(build):
        CONCEPTS[name] = Concept(name, build, tuple(deps), sql)
        return build

    return register


class Context:
    """Source tables and derived tables by name, each built once."""

    def __init__(self, spark: SparkSession, sources: Callable[[str], DataFrame], persist_shared: bool = False):
        self.spark, self.sources, self.persist_shared = spark, sources, persist_shared
        self.built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.built:
            if name in CONCEPTS:
                df = CONCEPTS[name].build(self)
                if self.persist_shared and sum(name in c.deps for c in CONCEPTS.values()) > 1:
                    df = df.persist(StorageLevel.MEMORY_AND_DISK)
            else:
                df = self.sources(name)
            self.built[name] = df
        return self.built[name]


def write_chain(ctx: Context, names: Sequence[str], save: Callable[[str, DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """Derived tables written in dependency order, each read by the next ones from where ``save`` put it.

    ``save`` writes a table under its name and returns what to read instead; every shared table is computed once.
    """
    out = {}
    for name in order(names, {}):
        if name in CONCEPTS:
            ctx.built[name] = out[name] = save(name, ctx[name])
    return {n: out[n] for n in names}


def order(names: Sequence[str], sources: dict[str, str]) -> list[str]:
    """``names`` with all they need, dependencies first; source tables by the names their SQL mentions."""
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in CONCEPTS[n].deps if n in CONCEPTS else [s for s in sources if "{" + s + "}" in sources.get(n, "")]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out
