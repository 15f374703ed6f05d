"""Acute physiology score III, from a table of steps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitalgrid.functions.dt import days
from vitalgrid.functions.scalar import logistic
from vitalgrid.operators.joins import interval_join
from vitalgrid.plans.comorbidity import prefix_flags, rules_sql
from vitalgrid.plans.registry import concept

# Fixed values: (upper bound, points) in order, the points beyond, and the normal point from which the worse of
# the day's minimum and maximum is told (None: the maximum counts).
STEPS = {
    "hr": ("heart_rate", [(40, 8), (50, 5), (100, 0), (110, 1), (120, 5), (140, 7), (155, 13)], 17, 75),
    "mbp": ("mbp", [(40, 23), (60, 15), (70, 7), (80, 6), (100, 0), (120, 4), (130, 7), (140, 9)], 10, 90),
    "temp": ("temperature", [(33, 20), (33.5, 16), (34, 13), (35, 8), (36, 2), (40, 0)], 4, 38),
    "resp_rate": ("resp_rate", [(6, 17), (12, 8), (14, 7), (25, 0), (35, 6), (40, 9), (50, 11)], 18, 19),
    "hematocrit": ("hematocrit", [(41, 3), (50, 0)], 3, 45.5),
    "wbc": ("wbc", [(1, 19), (3, 5), (20, 0), (25, 1)], 5, 11.5),
    "creatinine": ("creatinine", [(0.5, 3), (1.5, 0), (1.95, 4)], 7, 1),
    "bun": ("bun", [(17, 0), (20, 2), (40, 7), (80, 11)], 12, None),
    "sodium": ("sodium", [(120, 3), (135, 2), (155, 0)], 4, 145.5),
    "albumin": ("albumin", [(2, 11), (2.5, 6), (4.5, 0)], 4, 3.5),
    "bilirubin": ("bilirubin_total", [(2, 0), (3, 5), (5, 6), (8, 8)], 16, None),
    "glucose": ("glucose", [(40, 8), (60, 9), (200, 0), (350, 3)], 5, 130),
}
URINE = [(400, 15), (600, 8), (900, 7), (1500, 5), (2000, 4), (4000, 0)], 1
OXYGEN = [(50, 15), (70, 5), (80, 2)], 0
GRADIENT = [(100, 0), (250, 7), (350, 9), (500, 11)], 14
# acid-base grid: (pH below, steps of carbon dioxide pressure, points beyond)
ACID = [
    (7.2, [(50, 12)], 4), (7.3, [(30, 9), (40, 6), (50, 3)], 2), (7.35, [(30, 9), (45, 0)], 1), (7.45, [(30, 5), (45, 0)], 1), (7.5, [(30, 5), (35, 0), (45, 2)], 12), (7.6, [(40, 3)], 12),
    (99, [(25, 0), (40, 3)], 12),
]
# coma grid: (eyes closed, verbal answers, motor answers, points)
COMA = [
    (True, (1,), (1, 2), 48), (True, (1,), (3, 4), 33), (True, (1,), (5, 6), 16), (True, (2, 3), (1, 2), 29), (True, (2, 3), (3, 4), 24), (False, (1,), (1, 2), 29), (False, (1,), (3, 4), 24),
    (False, (1,), (5, 6), 15), (False, (2, 3), (1, 2), 29), (False, (2, 3), (3, 4), 24), (False, (2, 3), (5,), 13), (False, (2, 3), (6,), 10), (False, (4,), (1, 2, 3, 4), 13), (False, (4,), (5,), 8),
    (False, (4,), (6,), 3), (False, (5,), (1, 2, 3, 4, 5), 3), (False, (5,), (6,), 0),
]
SEVERE = {"ckd": {9: "5854 5855 5856", 10: "N184 N185 N186"}}
NAMES = ["hr", "mbp", "temp", "resp_rate", "pao2_aado2", "hematocrit", "wbc", "creatinine", "uo", "bun", "sodium", "albumin", "bilirubin", "glucose", "acidbase", "gcs"]


def steps(x: Column, table, beyond: int, first: list[tuple[Column, int]] = ()) -> Column:
    out = F.when(x.isNull(), F.lit(None))
    for cond, p in first:
        out = out.when(cond, p)
    for bound, p in table:
        out = out.when(x < bound, p)
    return out.otherwise(beyond)


def steps_sql(x: str, table, beyond: int, first: str = "") -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL {first} {' '.join(f'WHEN {x} < {b} THEN {p}' for b, p in table)} ELSE {beyond} END"


# rules that come before the steps
FIRST_SQL = {"resp_rate": "WHEN vent = 1 AND {x} < 14 THEN 0", "creatinine": "WHEN arf = 1 AND {x} < 1.5 THEN 0 WHEN arf = 1 THEN 10"}


def _first(name: str, x: Column) -> list[tuple[Column, int]]:
    if name == "resp_rate":
        return [((F.col("vent") == 1) & (x < 14), 0)]
    return [((F.col("arf") == 1) & (x < 1.5), 0), (F.col("arf") == 1, 10)] if name == "creatinine" else []


def _score(name: str) -> Column:
    source, table, beyond, normal = STEPS[name]
    lo, hi = F.col(f"{source}_min"), F.col(f"{source}_max")
    low, high = (steps(x, table, beyond, _first(name, x)) for x in (lo, hi))
    if normal is None:
        return high
    far = F.abs(hi - normal) - F.abs(lo - normal)
    pick = F.when(hi.isNull(), None)
    if name == "creatinine":
        pick = pick.when(F.col("arf") == 1, high)
    return pick.when(far > 0, high).when(far < 0, low).otherwise(F.greatest(low, high))


def _score_sql(name: str) -> str:
    source, table, beyond, normal = STEPS[name]
    special = FIRST_SQL.get(name, "")
    low, high = (steps_sql(f"{source}_{e}", table, beyond, special.format(x=f"{source}_{e}")) for e in ("min", "max"))
    if normal is None:
        return f"{high} AS {name}_score"
    far = f"abs({source}_max - {normal}) - abs({source}_min - {normal})"
    first = f"WHEN arf = 1 THEN {high}" if name == "creatinine" else ""
    return f"CASE WHEN {source}_max IS NULL THEN NULL {first} WHEN {far} > 0 THEN {high} WHEN {far} < 0 THEN {low} ELSE greatest({low}, {high}) END AS {name}_score"


def _acid(ph: Column, co: Column) -> Column:
    out = F.when(ph.isNull() | co.isNull(), F.lit(None))
    for bound, table, beyond in ACID:
        out = out.when(ph < bound, steps(co, table, beyond))
    return out


ACID_SQL = "CASE " + " ".join(f"WHEN ph < {b} THEN {steps_sql('pco2', t, e)}" for b, t, e in ACID) + " END"
_tuple = lambda v: ", ".join(map(str, v))
COMA_SQL = "CASE WHEN gcs_unable = 1 THEN 0 " + " ".join(f"WHEN gcs_eyes {'= 1' if closed else '> 1'} AND gcs_verbal IN ({_tuple(v)}) AND gcs_motor IN ({_tuple(m)}) THEN {p}" for closed, v, m, p in COMA) + " END"
HELD = "EXISTS (SELECT 1 FROM ventilation v WHERE v.stay_id = i.stay_id AND v.ventilation_status = 'InvasiveVent' AND b.charttime BETWEEN v.starttime AND v.endtime)"


@concept("apsiii", ["icustays", "bg", "ventilation", "diagnoses_icd", "first_day_lab", "first_day_vitalsign", "first_day_urine_output", "first_day_gcs"], f"""
WITH b AS (SELECT i.stay_id, ph, pco2, po2, aado2, coalesce(fio2, fio2_chartevents) AS fi, {HELD} AS held FROM icustays i JOIN bg b ON b.hadm_id = i.hadm_id AND b.charttime >= i.intime AND b.charttime < i.outtime WHERE specimen = 'ART.'),
g AS (SELECT stay_id, max(po2) FILTER (WHERE NOT held AND coalesce(fi, 21) < 50) AS pao2, max(aado2) FILTER (WHERE held AND fi >= 50) AS grad, max(CASE WHEN ph IS NOT NULL AND pco2 IS NOT NULL THEN {ACID_SQL} END) AS acidbase_score FROM b GROUP BY 1),
d AS (SELECT hadm_id, {rules_sql(SEVERE)} FROM diagnoses_icd GROUP BY 1),
j AS (SELECT i.subject_id, i.hadm_id, i.stay_id, pao2, grad, acidbase_score, v.* EXCLUDE (subject_id, stay_id, glucose_min, glucose_max), l.* EXCLUDE (subject_id, stay_id, glucose_min, glucose_max),
        least(l.glucose_min, v.glucose_min) AS glucose_min, greatest(l.glucose_max, v.glucose_max) AS glucose_max, urineoutput, gcs_motor, gcs_verbal, gcs_eyes, gcs_unable,
        CASE WHEN creatinine_max >= 1.5 AND urineoutput < 410 AND ckd = 0 THEN 1 ELSE 0 END AS arf,
        CASE WHEN EXISTS (SELECT 1 FROM ventilation x WHERE x.stay_id = i.stay_id AND x.ventilation_status = 'InvasiveVent' AND x.starttime <= i.intime + INTERVAL '1' DAY AND x.endtime >= i.intime) THEN 1 ELSE 0 END AS vent
      FROM icustays i LEFT JOIN g USING (stay_id) LEFT JOIN d ON d.hadm_id = i.hadm_id LEFT JOIN first_day_vitalsign v ON v.stay_id = i.stay_id LEFT JOIN first_day_lab l ON l.stay_id = i.stay_id
      LEFT JOIN first_day_urine_output u ON u.stay_id = i.stay_id LEFT JOIN first_day_gcs c ON c.stay_id = i.stay_id),
s AS (SELECT subject_id, hadm_id, stay_id, {', '.join(_score_sql(n) for n in STEPS)}, {steps_sql('urineoutput', *URINE)} AS uo_score, {COMA_SQL} AS gcs_score,
        CASE WHEN pao2 IS NOT NULL THEN {steps_sql('pao2', *OXYGEN)} ELSE {steps_sql('grad', *GRADIENT)} END AS pao2_aado2_score, acidbase_score FROM j),
t AS (SELECT *, {' + '.join(f'coalesce({n}_score, 0)' for n in NAMES)} AS apsiii FROM s)
SELECT *, round(1 / (1 + exp(-(CAST(-4.436 AS DOUBLE) + CAST(0.04726 AS DOUBLE) * apsiii))), 9) AS apsiii_prob FROM t""")
def apsiii(ctx):
    """Sixteen components; oxygenation by pressure without and by gradient with ventilation."""
    stays = ctx["icustays"].select("subject_id", "hadm_id", "stay_id", "intime", "outtime")
    gas = ctx["bg"].filter("specimen = 'ART.'").select("hadm_id", "charttime", "ph", "pco2", "po2", "aado2", F.coalesce("fio2", "fio2_chartevents").alias("fi"))
    own = interval_join(gas, stays.select("hadm_id", "stay_id", "intime", "outtime"), ["hadm_id"], "charttime", "intime", "outtime", closed="left")
    runs = ctx["ventilation"].filter("ventilation_status = 'InvasiveVent'").select("stay_id", "starttime", "endtime", F.lit(1).alias("held"))
    own = interval_join(own, runs, ["stay_id"], "charttime", "starttime", "endtime", how="left")
    free = F.col("held").isNull() & (F.coalesce("fi", F.lit(21.0)) < 50)
    worst = own.groupBy("stay_id").agg(
        F.max(F.when(free, F.col("po2"))).alias("pao2"), F.max(F.when((F.col("held") == 1) & (F.col("fi") >= 50), F.col("aado2"))).alias("grad"), F.max(_acid(F.col("ph"), F.col("pco2"))).alias("acidbase_score")
    )
    first = runs.select(F.col("stay_id").alias("_s"), "starttime", "endtime")
    held = stays.join(first, (F.col("stay_id") == F.col("_s")) & (F.col("starttime") <= F.col("intime") + days(1)) & (F.col("endtime") >= F.col("intime")), "left_semi").select("stay_id", F.lit(1).alias("vent"))
    vital = ctx["first_day_vitalsign"].withColumnsRenamed({"glucose_min": "_g1", "glucose_max": "_g2"}).drop("subject_id")
    j = stays.join(worst, "stay_id", "left").join(held, "stay_id", "left").join(prefix_flags(ctx["diagnoses_icd"], "hadm_id", SEVERE), "hadm_id", "left")
    had = ctx["diagnoses_icd"].select("hadm_id").distinct().withColumn("coded", F.lit(1))
    j = j.join(had, "hadm_id", "left").join(vital, "stay_id", "left").join(ctx["first_day_lab"].drop("subject_id"), "stay_id", "left")
    j = j.join(ctx["first_day_urine_output"].drop("subject_id"), "stay_id", "left").join(ctx["first_day_gcs"].drop("subject_id"), "stay_id", "left")
    no_disease = (F.col("coded") == 1) & (F.coalesce("ckd", F.lit(0)) == 0)
    arf = (F.col("creatinine_max") >= 1.5) & (F.col("urineoutput") < 410) & no_disease
    j = j.withColumns({
        "glucose_min": F.least("glucose_min", "_g1"), "glucose_max": F.greatest("glucose_max", "_g2"), "vent": F.coalesce("vent", F.lit(0)), "arf": F.when(arf, 1).otherwise(0),
    })
    c = F.col
    coma = F.when(c("gcs_unable") == 1, 0)
    for closed, verbal, motor, p in COMA:
        coma = coma.when(((c("gcs_eyes") == 1) if closed else (c("gcs_eyes") > 1)) & c("gcs_verbal").isin(list(verbal)) & c("gcs_motor").isin(list(motor)), p)
    s = j.select(
        "subject_id", "hadm_id", "stay_id", *[_score(n).alias(f"{n}_score") for n in STEPS], steps(c("urineoutput"), *URINE).alias("uo_score"), coma.alias("gcs_score"),
        F.when(c("pao2").isNotNull(), steps(c("pao2"), *OXYGEN)).otherwise(steps(c("grad"), *GRADIENT)).alias("pao2_aado2_score"), "acidbase_score",
    )
    s = s.withColumn("apsiii", sum((F.coalesce(f"{n}_score", F.lit(0)) for n in NAMES), F.lit(0)))
    return s.withColumn("apsiii_prob", F.round(logistic(-4.436 + 0.04726 * F.col("apsiii")), 9))
