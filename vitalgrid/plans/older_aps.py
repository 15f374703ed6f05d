"""Acute physiology score III of the older generation: the newer one's steps over the first day's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalgrid.functions.scalar import logistic
from vitalgrid.operators.joins import interval_join
from vitalgrid.plans.aps import _acid, _score, _score_sql, ACID_SQL, COMA, COMA_SQL, GRADIENT, OXYGEN, STEPS, URINE, steps, steps_sql
from vitalgrid.plans.older_measurement import STAY
from vitalgrid.plans.registry import concept

#: What the older tables call the readings of the steps, and the names of their scores.
READINGS = {"heart_rate": "heartrate", "mbp": "meanbp", "temperature": "tempc", "resp_rate": "resprate", "bilirubin_total": "bilirubin"}
RENAMED = {"mbp": "meanbp", "resp_rate": "resprate"}
VITAL, LAB = ["hr", "mbp", "temp", "resp_rate"], ["hematocrit", "wbc", "creatinine", "bun", "sodium", "albumin", "bilirubin"]
NAMES = [*[RENAMED.get(n, n) for n in STEPS], "uo", "gcs", "pao2_aado2", "acidbase"]
_extremes = lambda names: {f"{STEPS[n][0]}_{e}": f"{READINGS.get(STEPS[n][0], STEPS[n][0])}_{e}" for n in names for e in ("min", "max")}
_coma = {"gcs_motor": "gcsmotor", "gcs_verbal": "gcsverbal", "gcs_eyes": "gcseyes", "gcs_unable": "endotrachflag"}
_HELD = "EXISTS (SELECT 1 FROM ventilation_durations v WHERE v.icustay_id = b.icustay_id AND b.charttime >= v.starttime AND b.charttime <= v.endtime)"


@concept("older_apsiii", ["older_icustays", "blood_gas_first_day_arterial", "ventilation_durations", "ventilation_first_day", "older_diagnoses", "labs_first_day", "vitals_first_day", "urine_output_first_day", "gcs_first_day"], f"""
WITH b AS (SELECT icustay_id, ph, pco2, po2, aado2, coalesce(fio2, fio2_chartevents) AS fi, {_HELD} AS held FROM blood_gas_first_day_arterial b),
g AS (SELECT icustay_id, max(po2) FILTER (WHERE NOT held AND coalesce(fi, 21) < 50) AS pao2, max(aado2) FILTER (WHERE held AND fi >= 50) AS grad, max(CASE WHEN ph IS NOT NULL AND pco2 IS NOT NULL THEN {ACID_SQL} END) AS acidbase_score FROM b GROUP BY 1),
d AS (SELECT hadm_id, max(CASE WHEN icd9_code IN ('5854', '5855', '5856') THEN 1 ELSE 0 END) AS ckd FROM older_diagnoses GROUP BY 1),
j AS (SELECT i.subject_id, i.hadm_id, i.icustay_id, pao2, grad, acidbase_score, {', '.join(f'{old} AS {new}' for new, old in (_extremes(VITAL) | _extremes(LAB)).items())}, {', '.join(f'{old} AS {new}' for new, old in _coma.items())},
  greatest(l.glucose_max, v.glucose_max) AS glucose_max, least(l.glucose_min, v.glucose_min) AS glucose_min, vent, urineoutput, CASE WHEN creatinine_max >= 1.5 AND urineoutput < 410 AND ckd = 0 THEN 1 ELSE 0 END AS arf
  FROM older_icustays i LEFT JOIN g ON g.icustay_id = i.icustay_id LEFT JOIN d ON d.hadm_id = i.hadm_id LEFT JOIN ventilation_first_day f ON f.icustay_id = i.icustay_id LEFT JOIN vitals_first_day v ON v.icustay_id = i.icustay_id LEFT JOIN labs_first_day l ON l.icustay_id = i.icustay_id
  LEFT JOIN urine_output_first_day u ON u.icustay_id = i.icustay_id LEFT JOIN gcs_first_day c ON c.icustay_id = i.icustay_id),
s AS (SELECT subject_id, hadm_id, icustay_id, {', '.join(_score_sql(n).rpartition(' AS ')[0] + f' AS {RENAMED.get(n, n)}_score' for n in STEPS)}, {steps_sql('urineoutput', *URINE)} AS uo_score, {COMA_SQL} AS gcs_score,
  CASE WHEN pao2 IS NOT NULL THEN {steps_sql('pao2', *OXYGEN)} ELSE {steps_sql('grad', *GRADIENT)} END AS pao2_aado2_score, acidbase_score FROM j),
t AS (SELECT *, {' + '.join(f'coalesce({n}_score, 0)' for n in NAMES)} AS apsiii FROM s)
SELECT *, round(1 / (1 + exp(-(CAST(-4.436 AS DOUBLE) + CAST(0.04726 AS DOUBLE) * apsiii))), 9) AS apsiii_prob FROM t""")
def older_apsiii(ctx):
    """Sixteen parts of the first day; oxygen by pressure without ventilation, else by gradient."""
    c = F.col
    runs = ctx["ventilation_durations"].select("icustay_id", "starttime", "endtime", F.lit(1).alias("held"))
    gas = ctx["blood_gas_first_day_arterial"].select("icustay_id", "charttime", "ph", "pco2", "po2", "aado2", F.coalesce("fio2", "fio2_chartevents").alias("fi"))
    own = interval_join(gas, runs, ["icustay_id"], "charttime", "starttime", "endtime", how="left")
    free = c("held").isNull() & (F.coalesce("fi", F.lit(21.0)) < 50)
    worst = own.groupBy("icustay_id").agg(F.max(F.when(free, c("po2"))).alias("pao2"), F.max(F.when((c("held") == 1) & (c("fi") >= 50), c("aado2"))).alias("grad"), F.max(_acid(c("ph"), c("pco2"))).alias("acidbase_score"))
    disease = ctx["older_diagnoses"].groupBy("hadm_id").agg(F.max(c("icd9_code").isin("5854", "5855", "5856").cast("int")).alias("ckd"))
    renamed = lambda table, names: ctx[table].select("icustay_id", *[c(old).alias(new) for new, old in names.items()])
    vital = renamed("vitals_first_day", _extremes(VITAL) | {"_g1": "glucose_min", "_g2": "glucose_max"})
    lab = renamed("labs_first_day", _extremes(LAB) | {"_g3": "glucose_min", "_g4": "glucose_max"})
    j = ctx["older_icustays"].select(*STAY).join(disease, "hadm_id", "left")
    for part in (worst, vital, lab, ctx["ventilation_first_day"].select("icustay_id", "vent"), ctx["urine_output_first_day"].select("icustay_id", "urineoutput"), renamed("gcs_first_day", _coma)):
        j = j.join(part, "icustay_id", "left")
    arf = (c("creatinine_max") >= 1.5) & (c("urineoutput") < 410) & (c("ckd") == 0)
    j = j.withColumns({"glucose_min": F.least("_g1", "_g3"), "glucose_max": F.greatest("_g2", "_g4"), "arf": F.when(arf, 1).otherwise(0)})
    coma = F.when(c("gcs_unable") == 1, 0)
    for closed, verbal, motor, points in COMA:
        coma = coma.when(((c("gcs_eyes") == 1) if closed else (c("gcs_eyes") > 1)) & c("gcs_verbal").isin(list(verbal)) & c("gcs_motor").isin(list(motor)), points)
    s = j.select(
        *STAY, *[_score(n).alias(f"{RENAMED.get(n, n)}_score") for n in STEPS], steps(c("urineoutput"), *URINE).alias("uo_score"), coma.alias("gcs_score"),
        F.when(c("pao2").isNotNull(), steps(c("pao2"), *OXYGEN)).otherwise(steps(c("grad"), *GRADIENT)).alias("pao2_aado2_score"), "acidbase_score",
    )
    s = s.withColumn("apsiii", sum((F.coalesce(f"{n}_score", F.lit(0)) for n in NAMES), F.lit(0)))
    return s.withColumn("apsiii_prob", F.round(logistic(-4.436 + 0.04726 * F.col("apsiii")), 9))
