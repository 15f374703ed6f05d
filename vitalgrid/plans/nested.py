"""Derived tables over nested resources: views flatten them, codes and typed values become the plain tables' rows.

The resources that queries read are built here from the plain tables: people, encounters, specimens, and
observations whose components carry a local code beside one of another vocabulary.  From the views on nothing
knows of the plain tables; every derived table runs over the flattened rows as it does over plain ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.operators.resources import crosswalk, typed_values, view
from vitalgrid.plans import catalog  # noqa: F401  registers the derived tables
from vitalgrid.plans.adapter import CHART_CODES, LAB_CODES, LAB_TEXTS, TEXT_CODES, oracle, table
from vitalgrid.plans.registry import Context

PEOPLE, HOSPITAL, UNIT, SPECIMENS, LABS, CHART, OTHER = (f"urn:hospital:{x}" for x in ("person", "admission", "stay", "specimen", "lab-items", "chart-items", "other-items"))


def _id(system: str, value: Column) -> Column:
    return F.struct(F.lit(system).alias("system"), value.cast("string").alias("value"))


def _reference(kind: str, *parts) -> Column:
    return F.struct(F.concat_ws("-", F.lit(f"{kind}/{parts[0]}"), *parts[1:]).alias("reference"))


def _observation(rows: DataFrame, keys: list[str], system: str, at: str, extra: dict[str, Column]) -> DataFrame:
    """One resource for each of ``keys`` with a component a reading; a reading has a number or a text or neither."""
    def component(x: Column) -> Column:
        coding = F.array(F.struct(F.lit(OTHER).alias("system"), F.concat(F.lit("x"), x["itemid"]).alias("code")), F.struct(F.lit(system).alias("system"), x["itemid"].cast("string").alias("code")))
        quantity = F.when(x["valuenum"].isNotNull(), F.struct(x["valuenum"].alias("value")))
        return F.struct(F.struct(coding.alias("coding")).alias("code"), quantity.alias("valueQuantity"), x["value"].alias("valueString"), x["storetime"].alias("issued"))

    # bare readings are shuffled; they are wrapped where the resource is put together, and only once
    readings = F.collect_list(F.struct("itemid", "valuenum", "value", "storetime"))
    found = rows.groupBy(*keys).agg(F.transform(readings, component).alias("component"))
    return found.select(F.concat_ws("-", F.lit(system), *keys).alias("id"), F.col(at).alias("effectiveDateTime"), *[c.alias(n) for n, c in extra.items()], "component")


def resources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Nested resources from the plain tables."""
    plain = lambda n: table(spark, sf_dir, n)
    hospital = plain("admissions").select(F.concat(F.lit("h"), "hadm_id").alias("id"), F.array(_id(OTHER, F.lit(0)), _id(HOSPITAL, F.col("hadm_id"))).alias("identifier"), _reference("Patient", "p", "subject_id").alias("subject"), F.struct(F.col("admittime").alias("start"), F.col("dischtime").alias("end")).alias("period"), F.lit(None).cast("struct<reference:string>").alias("partOf"))
    unit = plain("icustays").select(F.concat(F.lit("u"), "stay_id").alias("id"), F.array(_id(UNIT, F.col("stay_id"))).alias("identifier"), _reference("Patient", "p", "subject_id").alias("subject"), F.struct(F.col("intime").alias("start"), F.col("outtime").alias("end")).alias("period"), F.struct(F.concat(F.lit("Encounter/h"), "hadm_id").alias("reference")).alias("partOf"))
    labs, chart = plain("labevents"), plain("chartevents")
    return {
        "patient": plain("patients").select(F.concat(F.lit("p-"), "subject_id").alias("id"), F.array(_id(PEOPLE, F.col("subject_id"))).alias("identifier"), "gender"),
        "encounter": hospital.unionByName(unit),
        "specimen": labs.select("specimen_id").distinct().select(F.concat(F.lit("s"), "specimen_id").alias("id"), F.array(_id(SPECIMENS, F.col("specimen_id"))).alias("identifier")),
        "lab": _observation(labs, ["specimen_id", "subject_id", "hadm_id", "charttime"], LABS, "charttime", {"subject": _reference("Patient", "p", "subject_id"), "encounter": F.struct(F.concat(F.lit("Encounter/h"), "hadm_id").alias("reference")), "specimen": F.struct(F.concat(F.lit("Specimen/s"), "specimen_id").alias("reference"))}),
        "chart": _observation(chart, ["stay_id", "subject_id", "hadm_id", "charttime"], CHART, "charttime", {"subject": _reference("Patient", "p", "subject_id"), "encounter": F.struct(F.concat(F.lit("Encounter/u"), "stay_id").alias("reference"))}),
    }


def _keyed(resource: str, system: str, name: str, *columns: dict) -> dict:
    return {"resource": resource, "select": [
        {"column": [{"path": "getResourceKey()", "name": f"{name}_key"}, *columns]},
        {"forEach": f"identifier.where(system='{system}')", "column": [{"path": "value", "name": name, "type": "bigint"}]},
    ]}


def _readings(*references: tuple[str, str, str]) -> dict:
    """A row for each code of each component: two levels of arrays, of which the second may be empty."""
    keys = [{"path": f"{field}.getReferenceKey({kind})", "name": f"{name}_key"} for field, kind, name in references]
    return {"resource": "Observation", "where": [{"path": "component.exists()"}], "select": [
        {"column": [*keys, {"path": "effectiveDateTime", "name": "charttime"}]},
        {"forEach": "component", "column": [{"path": "value.ofType(quantity).value", "name": "quantity"}, {"path": "value.ofType(string)", "name": "text"}, {"path": "issued", "name": "storetime"}],
         "select": [{"forEachOrNull": "code.coding", "column": [{"path": "system", "name": "system"}, {"path": "code", "name": "code"}]}]},
    ]}


VIEWS = {
    "patient": ("patient", _keyed("Patient", PEOPLE, "subject_id", {"path": "gender", "name": "gender"})),
    "admission": ("encounter", _keyed("Encounter", HOSPITAL, "hadm_id", {"path": "subject.getReferenceKey(Patient)", "name": "subject_id_key"}, {"path": "period.start", "name": "admittime"}, {"path": "period.end", "name": "dischtime"})),
    "stay": ("encounter", _keyed("Encounter", UNIT, "stay_id", {"path": "subject.getReferenceKey(Patient)", "name": "subject_id_key"}, {"path": "partOf.getReferenceKey(Encounter)", "name": "hadm_id_key"}, {"path": "period.start", "name": "intime"}, {"path": "period.end", "name": "outtime"})),
    "specimen": ("specimen", _keyed("Specimen", SPECIMENS, "specimen_id")),
    "lab": ("lab", _readings(("subject", "Patient", "subject_id"), ("encounter", "Encounter", "hadm_id"), ("specimen", "Specimen", "specimen_id"))),
    "chart": ("chart", _readings(("subject", "Patient", "subject_id"), ("encounter", "Encounter", "stay_id"))),
}


class Flattened:
    """The plain tables' columns by name, from the views over ``held`` resources."""

    def __init__(self, held: dict[str, DataFrame], codes: DataFrame):
        self.codes = codes  # system, code, itemid
        self.views = {name: view(held[source], spec) for name, (source, spec) in VIEWS.items()}

    def _with(self, rows: DataFrame, view_name: str, name: str, how: str = "inner") -> DataFrame:
        """``rows`` with the number behind a reference."""
        return rows.join(self.views[view_name].select(f"{name}_key", name), f"{name}_key", how)

    def _codes(self, rows: DataFrame) -> DataFrame:
        return crosswalk(rows, self.codes)

    def __call__(self, name: str) -> DataFrame:
        if name == "icustays":
            return self._with(self._with(self.views["stay"], "admission", "hadm_id"), "patient", "subject_id").select("subject_id", "hadm_id", "stay_id", "intime", "outtime")
        if name == "labevents":
            rows = typed_values(self._codes(self.views["lab"]), "quantity", ["text"])
            rows = self._with(self._with(self._with(rows, "patient", "subject_id"), "specimen", "specimen_id"), "admission", "hadm_id", "left")
            return rows.select("subject_id", "hadm_id", "specimen_id", "itemid", "charttime", "storetime", "value", "valuenum")
        if name == "chartevents":
            rows = typed_values(self._codes(self.views["chart"]), "quantity", ["text"])
            stays = self.views["stay"].select("stay_id_key", "stay_id", "hadm_id_key")
            rows = self._with(rows.join(stays, "stay_id_key", "left"), "patient", "subject_id")
            rows = self._with(rows, "admission", "hadm_id", "left")
            return rows.select("subject_id", "hadm_id", "stay_id", "charttime", "storetime", "itemid", "value", "valuenum")
        raise KeyError(f"no view gives {name}")


def nested_context(spark: SparkSession, sf_dir: str) -> Context:
    listed = {(system, str(c[0]), c[0]) for system, codes in ((LABS, [*LAB_CODES, *LAB_TEXTS]), (CHART, [*CHART_CODES, *TEXT_CODES])) for c in codes}
    rows = ", ".join(f"('{system}', '{code}', {item})" for system, code, item in sorted(listed))
    return Context(spark, Flattened(resources(spark, sf_dir), spark.sql(f"SELECT * FROM VALUES {rows} AS c(system, code, itemid)")))


#: Derived tables that are registered over nested resources as well.
NAMES = ("bg", "icustay_hourly", "vitalsign", "chemistry")
QUERIES = {f"nested_{n}": lambda spark, sf_dir, n=n: nested_context(spark, sf_dir)[n] for n in NAMES}
SQL = {f"nested_{n}": oracle(n) for n in NAMES}
