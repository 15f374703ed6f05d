"""Flat rows from nested resources, declared as views.

A view is a dict as JSON holds it: ``resource``, ``where`` (paths that must be true) and ``select``, a list of parts.  A
part may unnest an array (``forEach``; ``forEachOrNull`` keeps a row where there is none), has ``column``s of path
and name, and may hold further parts in ``select``, which see the unnested element, or ``unionAll``.  Parts side by
side multiply.  Each level becomes one generator over the array its paths are read from, so Spark prunes the nested
columns that no path mentions.

Paths are names joined by dots with these calls: ``where(field = 'value' and ...)``, ``first()``, ``exists()``,
``ofType(Type)``, ``getResourceKey()`` and ``getReferenceKey(Type)``.  A name after an array is read from each of its
elements; a column holds the first element of what its path finds, or all with ``collection``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEP = re.compile(r"(\w+)(?:\(((?:[^()']|'[^']*')*)\))?(?:\.|$)")
TEST = re.compile(r"\s*([\w.]+)\s*=\s*'([^']*)'\s*(?:and|$)")


@dataclass(frozen=True)
class Found:
    """A column and what it holds."""

    value: Column
    kind: T.DataType

    def field(self, name: str) -> Found:
        many = isinstance(self.kind, T.ArrayType)
        inner = self.kind.elementType if many else self.kind
        if not isinstance(inner, T.StructType) or name not in inner.names:
            raise ValueError(f"no field {name} in {self.kind.simpleString()}")
        kind = inner[name].dataType
        if not many:
            return Found(self.value[name], kind)
        each = F.transform(self.value, lambda x: x[name])
        return Found(F.flatten(each), kind) if isinstance(kind, T.ArrayType) else Found(each, T.ArrayType(kind))

    def where(self, tests: list[tuple[str, str]]) -> Found:
        def holds(x: Column, kind: T.DataType) -> Column:
            each = [_first(_read(Found(x, kind), name)).value == value for name, value in tests]
            return F.coalesce(_all(each), F.lit(False))

        if isinstance(self.kind, T.ArrayType):
            return Found(F.filter(self.value, lambda x: holds(x, self.kind.elementType)), self.kind)
        return Found(F.when(holds(self.value, self.kind), self.value), self.kind)


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _first(found: Found) -> Found:
    return Found(F.get(found.value, 0), found.kind.elementType) if isinstance(found.kind, T.ArrayType) else found


def _read(at: Found, path: str, resource: str = "") -> Found:
    """What ``path`` finds below ``at``."""
    done = 0
    steps = []
    for m in STEP.finditer(path):
        if m.start() != done:
            break
        steps.append((m[1], m[2]))
        done = m.end()
    if done != len(path) or not steps:
        raise ValueError(f"cannot read the path {path}")
    for i, (name, argument) in enumerate(steps):
        if argument is None:
            if i + 1 < len(steps) and steps[i + 1][0] == "ofType":  # one of several fields that begin alike
                kind = steps[i + 1][1].strip()
                name += kind[0].upper() + kind[1:]
            at = at.field(name)
        elif name == "where":
            tests = TEST.findall(argument)
            if not tests or TEST.sub("", argument).strip():
                raise ValueError(f"cannot read the condition {argument}")
            at = at.where(tests)
        elif name == "first":
            at = _first(at)
        elif name == "exists":
            one = _first(at)
            at = Found(one.value.isNotNull(), T.BooleanType())
        elif name == "getResourceKey":
            at = Found(F.concat(F.lit(f"{resource}/"), at.field("id").value), T.StringType())
        elif name == "getReferenceKey":
            at = _first(at.field("reference"))
            if argument.strip():
                at = Found(F.when(at.value.startswith(f"{argument.strip()}/"), at.value), at.kind)
        elif name != "ofType":
            raise ValueError(f"unknown call {name} in {path}")
    return at


class _View:
    def __init__(self, resource: str):
        self.resource, self.levels = resource, 0

    def parts(self, df: DataFrame, at: Found, parts: list[dict]) -> tuple[DataFrame, list[str]]:
        names: list[str] = []
        for part in parts:
            df, new = self.part(df, at, part)
            names += new
        return df, names

    def part(self, df: DataFrame, at: Found, part: dict) -> tuple[DataFrame, list[str]]:
        if each := part.get("forEach") or part.get("forEachOrNull"):
            self.levels += 1
            level = f"_level{self.levels}"
            items = _read(at, each, self.resource)
            many = items.value if isinstance(items.kind, T.ArrayType) else F.array(items.value)
            kind = items.kind.elementType if isinstance(items.kind, T.ArrayType) else items.kind
            if not isinstance(items.kind, T.ArrayType) or items.kind.containsNull:
                many = F.filter(many, lambda x: x.isNotNull())
            df = df.withColumn(level, (F.explode if "forEach" in part else F.explode_outer)(many))
            at = Found(F.col(level), kind)
        own = {}
        for column in part.get("column", []):
            found = _read(at, column["path"], self.resource)
            value = found.value if column.get("collection") else _first(found).value
            own[column["name"]] = value.cast(column["type"]) if "type" in column else value
        df = df.withColumns({f"_out_{n}": c for n, c in own.items()})
        df, deeper = self.parts(df, at, part.get("select", []))
        names = [*own, *deeper]
        if branches := part.get("unionAll"):
            made = [self.part(df, at, b) for b in branches]
            keep = [*df.columns, *[f"_out_{n}" for n in made[0][1]]]
            df = made[0][0].select(keep)
            for other, _ in made[1:]:
                df = df.unionByName(other.select(keep))
            names += made[0][1]
        return df, names


def view(df: DataFrame, spec: dict) -> DataFrame:
    """The rows of a view over ``df``, one row a resource."""
    resource = spec.get("resource", "")
    paths = [_read(_Root(df), w["path"], resource).value for w in spec.get("where", [])]
    if paths:
        df = df.filter(_all(paths))
    out, names = _View(resource).parts(df, _Root(df), spec["select"])
    return out.select(*[F.col(f"_out_{n}").alias(n) for n in names])


class _Root(Found):
    """The resource itself, whose fields are the columns."""

    def __init__(self, df: DataFrame):
        super().__init__(F.lit(None), df.schema)

    def field(self, name: str) -> Found:
        if name not in self.kind.names:
            raise ValueError(f"no field {name} in {self.kind.simpleString()}")
        return Found(F.col(name), self.kind[name].dataType)


def crosswalk(rows: DataFrame, codes: DataFrame, system: str = "system", code: str = "code", item: str = "itemid") -> DataFrame:
    """``rows`` under the ``item`` that ``codes`` (system, code, item) gives their code; rows of other systems or codes go.

    A code that stands in several systems of one row's coding is taken from each that is listed; the list is the
    dictionary of a vocabulary, which Spark broadcasts where its statistics say that it is small.
    """
    own = codes.select(F.col(system).alias("_system"), F.col(code).alias("_code"), F.col(item).alias(item)).distinct()
    return rows.join(own, (rows[system] == own["_system"]) & (rows[code] == own["_code"])).drop("_system", "_code")


def typed_values(rows: DataFrame, quantity: str, texts: list[str]) -> DataFrame:
    """``valuenum`` from the quantity, ``value`` from the first of ``texts`` that is there, else the quantity as text."""
    number = F.col(quantity).cast("double")
    return rows.withColumns({"valuenum": number, "value": F.coalesce(*texts, F.when(number.isNotNull(), number.cast("string")))})
