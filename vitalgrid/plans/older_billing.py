"""Comorbidity of the older generation that counts only where the billing group does not explain it, and its scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.plans.older_scores import _AHRQ, ELIXHAUSER, _ranges, ahrq_groups
from vitalgrid.plans.registry import concept

# Billing groups by the ranges of the two systems' codes.
BILLING = {
    "MS": {
        "card": "1-2 215-238 242-252 253-254 258-262 265-267 280-293 296-298 302-303 306-313", "peri": "299-301", "renal": "652 656-661 673-675 682-700", "nerv": "20-42 52-103", "cere": "20-22 34-39 64-72", "pulm": "190-192 202-203",
        "diab": "637-639", "hypo": "625-627 643-645", "liver": "420-425 432-434 441-446", "ulce": "377-384", "hiv": "969-970 974-977", "leuk": "820-830 834-849",
        "canc": "54 55 146-148 180-182 374-376 435-437 542-544 582-585 597-599 656-658 686-688 715-716 722-724 736-741 754-756 826-830 843-849", "arth": "545-547", "nutr": "640-641", "anem": "808-812", "alc": "894-897", "coag": "813",
        "htncx": "77 78 304", "htn": "79 305", "psy": "885", "obese": "619-621", "deprs": "881",
    },
    "HCFA": {
        "card": "103-112 115-118 121-127 129 132 133 135-143 514-518 525-527 535-536 547-550 551-558", "peri": "130 131", "renal": "302-305 315-333", "nerv": "1-35 524 528-534 543 559-564 577", "cere": "5 14-17 524 528 533-534 577", "pulm": "88 96-98",
        "diab": "294 295", "hypo": "290 300 301", "liver": "199-202 205-208", "ulce": "174-178", "hiv": "488 489 490", "leuk": "400-414 473 492 539-540",
        "canc": "10 11 64 82 172 173 199 203 239 257-260 274 275 303 318 319 338 344 346 347 354 355 357 363 366 367 406-414", "arth": "240 241", "nutr": "296-298", "anem": "395 396 574", "alc": "433-437 521-523", "coag": "397",
        "htncx": "22 134", "htn": "134", "psy": "430", "obese": "288", "deprs": "426",
    },
}
#: Comorbidity: the diagnosis groups that make it, the billing groups that explain it, a graver group that replaces it.
RULES = {
    "congestive_heart_failure": ("chf htnwchf hhrwchf hhrwhrf", "card", ""), "cardiac_arrhythmias": ("cardiac_arrhythmias", "card", ""), "valvular_disease": ("valvular_disease", "card", ""), "pulmonary_circulation": ("pulmonary_circulation", "card pulm", ""),
    "peripheral_vascular": ("peripheral_vascular", "peri", ""), "paralysis": ("paralysis", "cere", ""), "other_neurological": ("other_neurological", "nerv", ""), "chronic_pulmonary": ("chronic_pulmonary", "pulm", ""),
    "diabetes_uncomplicated": ("dm", "diab", "dmcx"), "diabetes_complicated": ("dmcx", "diab", ""), "hypothyroidism": ("hypothyroidism", "hypo", ""), "renal_failure": ("renlfail hrenwrf hhrwrf hhrwhrf", "renal", ""), "liver_disease": ("liver_disease", "liver", ""),
    "peptic_ulcer": ("peptic_ulcer", "ulce", ""), "aids": ("aids", "hiv", ""), "lymphoma": ("lymphoma", "leuk", ""), "metastatic_cancer": ("mets", "canc", ""), "solid_tumor": ("tumor", "canc", "mets"), "rheumatoid_arthritis": ("rheumatoid_arthritis", "arth", ""),
    "coagulopathy": ("coagulopathy", "coag", ""), "obesity": ("obesity", "nutr obese", ""), "weight_loss": ("weight_loss", "nutr", ""), "fluid_electrolyte": ("fluid_electrolyte", "nutr", ""), "blood_loss_anemia": ("blood_loss_anemia", "anem", ""),
    "deficiency_anemias": ("deficiency_anemias", "anem", ""), "alcohol_abuse": ("alcohol_abuse", "alc", ""), "drug_abuse": ("drug_abuse", "alc", ""), "psychoses": ("psychoses", "psy", ""), "depression": ("depression", "deprs", ""),
}
#: Complicated hypertension: a form counts for nothing, and hides the others, where one of these groups explains it.
HYPERTENSION = {
    "htncx": "htncx", "htnpreg": "htncx", "htnwochf": "htncx card", "htnwchf": "htncx card", "hrenworf": "htncx renal", "hrenwrf": "htncx renal", "hhrwohrf": "htncx card renal", "hhrwchf": "htncx card renal", "hhrwrf": "htncx card renal",
    "hhrwhrf": "htncx card renal", "ohtnpreg": "htncx card renal",
}
_GROUPS_SQL = ", ".join(f"('{system}', '{name}', {int(a)}, {int(b)})" for system, groups in BILLING.items() for name, codes in groups.items() for a, b in _ranges(codes))


def _quoted(names: str) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names.split()) + "]"


def _any_sql(flags: str) -> str:
    return "(" + " + ".join(f"coalesce({f}, 0)" for f in flags.split()) + ") > 0"


@concept("elixhauser_ahrq_v37", ["older_admissions", "older_diagnoses", "drgcodes"], f"""
WITH f AS (SELECT hadm_id, {', '.join(f"max(CAST({' OR '.join(f"(icd9_code >= '{a}' AND icd9_code <= '{b}')" for a, b in _ranges(codes))} AS INT)) AS {n}" for n, codes in _AHRQ.items())} FROM older_diagnoses WHERE seq_num = 1 GROUP BY hadm_id),
g AS (SELECT * FROM (VALUES {_GROUPS_SQL}) AS g(drg_type, name, low, high)),
d AS (SELECT c.hadm_id, coalesce(list(DISTINCT g.name) FILTER (WHERE g.name IS NOT NULL), []) AS names FROM drgcodes c LEFT JOIN g ON g.drg_type = c.drg_type AND CAST(c.drg_code AS INT) >= g.low AND CAST(c.drg_code AS INT) <= g.high WHERE c.drg_type IN ('MS', 'HCFA') GROUP BY 1),
j AS (SELECT a.subject_id, a.hadm_id, d.hadm_id IS NOT NULL AS billed, coalesce(d.names, CAST([] AS VARCHAR[])) AS names, f.* EXCLUDE (hadm_id) FROM older_admissions a LEFT JOIN f ON f.hadm_id = a.hadm_id LEFT JOIN d ON d.hadm_id = a.hadm_id)
SELECT subject_id, hadm_id, {', '.join(f"CAST({_any_sql(flags)} AND NOT list_has_any(names, {_quoted(groups)}){f' AND coalesce({graver}, 0) = 0' if graver else ''} AS INT) AS {n}" for n, (flags, groups, graver) in RULES.items())},
 CAST((coalesce(htn, 0) = 1 AND (NOT billed OR list_contains(names, 'htn'))) OR ({_any_sql(' '.join(HYPERTENSION))} AND NOT ({' OR '.join(f"(coalesce({f}, 0) = 1 AND list_has_any(names, {_quoted(g)}))" for f, g in HYPERTENSION.items())})) AS INT) AS hypertension FROM j""")
def elixhauser_ahrq_v37(ctx):
    """Comorbidity by the first diagnosis; each rule has the billing groups against which it does not count."""
    has = lambda c: F.coalesce(F.col(c), F.lit(0)) == 1
    j = ctx["older_admissions"].select("subject_id", "hadm_id").join(ahrq_groups(ctx), "hadm_id", "left").join(billing_groups(ctx), "hadm_id", "left")
    within = lambda groups: F.coalesce(F.arrays_overlap("_groups", F.array(*[F.lit(g) for g in groups.split()])), F.lit(False))

    def one_of(conditions: list[Column]) -> Column:
        out = F.lit(False)
        for c in conditions:
            out = out | c
        return out

    flags = {}
    for name, (groups, explained, graver) in RULES.items():
        held = one_of([has(x) for x in groups.split()]) & ~within(explained)
        flags[name] = (held & ~has(graver)) if graver else held
    plain = has("htn") & (F.col("_groups").isNull() | within("htn"))
    complicated = one_of([has(x) for x in HYPERTENSION]) & ~one_of([has(x) & within(g) for x, g in HYPERTENSION.items()])
    flags["hypertension"] = plain | complicated
    return j.select("subject_id", "hadm_id", *[c.cast("int").alias(n) for n, c in flags.items()])


def billing_groups(ctx) -> DataFrame:
    """``hadm_id`` and ``_groups``, the billing groups of an admission's codes; empty where no group has them.

    The distinct codes meet the ranges of their system, a small table, once.
    """
    rules = ctx.spark.createDataFrame([(system, name, int(a), int(b)) for system, groups in BILLING.items() for name, codes in groups.items() for a, b in _ranges(codes)], "drg_type string, name string, low int, high int")
    codes = ctx["drgcodes"].filter(F.col("drg_type").isin(list(BILLING))).select("hadm_id", "drg_type", F.col("drg_code").cast("int").alias("_code"))
    inside = (F.col("c.drg_type") == F.col("r.drg_type")) & F.col("_code").between(F.col("low"), F.col("high"))
    names = codes.select("drg_type", "_code").distinct().alias("c").join(F.broadcast(rules).alias("r"), inside).groupBy("c.drg_type", "_code").agg(F.collect_set("name").alias("_names"))
    return codes.join(names, ["drg_type", "_code"], "left").groupBy("hadm_id").agg(F.array_distinct(F.flatten(F.collect_set("_names"))).alias("_groups"))


@concept("elixhauser_score_ahrq", ["elixhauser_ahrq_v37"], f"""
WITH p AS (SELECT * FROM (VALUES {', '.join(f"('{score}', '{c}', {n})" for score, points in ELIXHAUSER.items() for c, n in points.items())}) AS p(score, name, n)),
u AS (UNPIVOT elixhauser_ahrq_v37 ON COLUMNS(* EXCLUDE (subject_id, hadm_id)) INTO NAME name VALUE held)
SELECT subject_id, hadm_id, {', '.join(f"CAST(sum(n * held) FILTER (WHERE score = '{score}') AS BIGINT) AS {score}" for score in ELIXHAUSER)} FROM u JOIN p USING (name) GROUP BY 1, 2""")
def elixhauser_score_ahrq(ctx):
    return ctx["elixhauser_ahrq_v37"].select("subject_id", "hadm_id", *[sum((F.col(c) * n for c, n in points.items()), F.lit(0)).cast("long").alias(name) for name, points in ELIXHAUSER.items()])
