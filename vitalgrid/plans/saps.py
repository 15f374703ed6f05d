"""Simplified acute physiology score of the first 24 hours."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalgrid.functions.dt import hours
from vitalgrid.functions.scalar import logistic, step_score
from vitalgrid.operators.joins import interval_join
from vitalgrid.plans.comorbidity import prefix_flags, rules_sql
from vitalgrid.plans.registry import concept

# Code prefixes of the chronic diseases that count.
CHRONIC = {
    "aids": {9: "042-044", 10: "B20-B22 B24"},
    "hem": {9: "20000-20238 20240-20248 20250-20302 20310-20312 20302-20382 20400-20522 20580-20702 20720-20892 2386 2733", 10: "C81-C96"},
    "mets": {9: "1960-1991 20970-20975 20979 78951", 10: "C77-C79 C800"},
}
_win = lambda t, key, at="charttime": f"{t} t ON t.{key} = i.{key} AND t.{at} > i.intime AND t.{at} <= i.intime + INTERVAL '24' HOUR"
SCORES = ["age_score", "hr_score", "sysbp_score", "temp_score", "pao2fio2_score", "uo_score", "bun_score", "wbc_score", "potassium_score", "sodium_score", "bicarbonate_score", "bilirubin_score", "gcs_score", "comorbidity_score", "admissiontype_score"]


@concept("sapsii", ["icustays", "admissions", "services", "age", "chartevents", "bg", "ventilation", "gcs", "vitalsign", "urine_output", "chemistry", "complete_blood_count", "enzyme", "diagnoses_icd"], f"""
WITH m AS (SELECT i.subject_id, greatest(min(t.charttime) - INTERVAL '1' HOUR, i.intime) AS s, least(max(t.charttime) + INTERVAL '4' HOUR, i.intime + INTERVAL '24' HOUR) AS e FROM icustays i JOIN {_win('chartevents', 'stay_id')}
      WHERE t.itemid = 226732 AND regexp_matches(lower(t.value), 'cpap mask|bipap') GROUP BY i.subject_id, i.stay_id, i.intime),
g AS (SELECT hadm_id, arg_min(CASE WHEN lower(curr_service) LIKE '%surg%' THEN 1 ELSE 0 END, transfertime) AS sg FROM services GROUP BY 1),
d AS (SELECT hadm_id, {rules_sql(CHRONIC)} FROM diagnoses_icd GROUP BY 1),
pf AS (SELECT i.stay_id, min(pao2fio2ratio) AS pf FROM icustays i JOIN {_win('bg', 'subject_id')} AND t.specimen = 'ART.'
      WHERE EXISTS (SELECT 1 FROM ventilation v WHERE v.stay_id = i.stay_id AND v.ventilation_status = 'InvasiveVent' AND t.charttime > v.starttime AND t.charttime <= v.endtime)
         OR EXISTS (SELECT 1 FROM m WHERE m.subject_id = t.subject_id AND t.charttime > m.s AND t.charttime <= m.e) GROUP BY 1),
gc AS (SELECT i.stay_id, min(t.gcs) AS gcs FROM icustays i JOIN {_win('gcs', 'stay_id')} GROUP BY 1),
vs AS (SELECT i.stay_id, min(heart_rate) AS hl, max(heart_rate) AS hh, min(sbp) AS sl, max(sbp) AS sh, min(temperature) AS tl, max(temperature) AS th FROM icustays i JOIN {_win('vitalsign', 'subject_id')} GROUP BY 1),
uo AS (SELECT i.stay_id, sum(urineoutput) AS u FROM icustays i JOIN {_win('urine_output', 'stay_id')} GROUP BY 1),
ch AS (SELECT i.stay_id, max(bun) AS bun, min(potassium) AS kl, max(potassium) AS kh, min(sodium) AS nl, max(sodium) AS nh, min(bicarbonate) AS bl, max(bicarbonate) AS bh FROM icustays i JOIN {_win('chemistry', 'subject_id')} GROUP BY 1),
cb AS (SELECT i.stay_id, min(wbc) AS wl, max(wbc) AS wh FROM icustays i JOIN {_win('complete_blood_count', 'subject_id')} GROUP BY 1),
en AS (SELECT i.stay_id, max(bilirubin_total) AS bi FROM icustays i JOIN {_win('enzyme', 'subject_id')} GROUP BY 1),
j AS (SELECT i.*, a.admission_type, age, sg, aids, hem, mets, pf, gcs, hl, hh, sl, sh, tl, th, u, bun, kl, kh, nl, nh, bl, bh, wl, wh, bi FROM icustays i JOIN admissions a ON a.hadm_id = i.hadm_id
      LEFT JOIN age ON age.hadm_id = i.hadm_id LEFT JOIN g ON g.hadm_id = i.hadm_id LEFT JOIN d ON d.hadm_id = i.hadm_id LEFT JOIN pf USING (stay_id) LEFT JOIN gc USING (stay_id) LEFT JOIN vs USING (stay_id)
      LEFT JOIN uo USING (stay_id) LEFT JOIN ch USING (stay_id) LEFT JOIN cb USING (stay_id) LEFT JOIN en USING (stay_id)),
s AS (SELECT subject_id, hadm_id, stay_id, intime AS starttime, intime + INTERVAL '24' HOUR AS endtime,
  CASE WHEN age < 40 THEN 0 WHEN age < 60 THEN 7 WHEN age < 70 THEN 12 WHEN age < 75 THEN 15 WHEN age < 80 THEN 16 WHEN age >= 80 THEN 18 END AS age_score,
  CASE WHEN hl < 40 THEN 11 WHEN hh >= 160 THEN 7 WHEN hh >= 120 THEN 4 WHEN hl < 70 THEN 2 WHEN hh IS NOT NULL THEN 0 END AS hr_score,
  CASE WHEN sl < 70 THEN 13 WHEN sl < 100 THEN 5 WHEN sh >= 200 THEN 2 WHEN sl IS NOT NULL THEN 0 END AS sysbp_score, CASE WHEN th >= 39 THEN 3 WHEN tl < 39 THEN 0 END AS temp_score,
  CASE WHEN pf < 100 THEN 11 WHEN pf < 200 THEN 9 WHEN pf >= 200 THEN 6 END AS pao2fio2_score, CASE WHEN u < 500 THEN 11 WHEN u < 1000 THEN 4 WHEN u >= 1000 THEN 0 END AS uo_score,
  CASE WHEN bun < 28 THEN 0 WHEN bun < 84 THEN 6 WHEN bun >= 84 THEN 10 END AS bun_score, CASE WHEN wl < 1 THEN 12 WHEN wh >= 20 THEN 3 WHEN wh IS NOT NULL THEN 0 END AS wbc_score,
  CASE WHEN kl < 3 OR kh >= 5 THEN 3 WHEN kh IS NOT NULL THEN 0 END AS potassium_score, CASE WHEN nl < 125 THEN 5 WHEN nh >= 145 THEN 1 WHEN nh IS NOT NULL THEN 0 END AS sodium_score,
  CASE WHEN bl < 15 THEN 6 WHEN bl < 20 THEN 3 WHEN bh IS NOT NULL THEN 0 END AS bicarbonate_score, CASE WHEN bi < 4 THEN 0 WHEN bi < 6 THEN 4 WHEN bi >= 6 THEN 9 END AS bilirubin_score,
  CASE WHEN gcs < 3 THEN NULL WHEN gcs < 6 THEN 26 WHEN gcs < 9 THEN 13 WHEN gcs < 11 THEN 7 WHEN gcs < 14 THEN 5 WHEN gcs <= 15 THEN 0 END AS gcs_score,
  CASE WHEN aids = 1 THEN 17 WHEN hem = 1 THEN 10 WHEN mets = 1 THEN 9 ELSE 0 END AS comorbidity_score,
  CASE WHEN sg = 1 AND admission_type = 'ELECTIVE' THEN 0 WHEN sg = 1 AND admission_type <> 'ELECTIVE' THEN 8 ELSE 6 END AS admissiontype_score FROM j),
t AS (SELECT *, {' + '.join(f'coalesce({x}, 0)' for x in SCORES)} AS sapsii FROM s)
SELECT *, round(1 / (1 + exp(-(CAST(-7.7631 AS DOUBLE) + CAST(0.0737 AS DOUBLE) * sapsii + CAST(0.9971 AS DOUBLE) * ln(sapsii + 1)))), 9) AS sapsii_prob FROM t""")
def sapsii(ctx):
    """Fifteen components from the first 24 hours, start excluded and end included."""
    stays = ctx["icustays"].select("subject_id", "hadm_id", "stay_id", F.col("intime").alias("starttime"), (F.col("intime") + hours(24)).alias("endtime"))

    def day(table: str, key: str, *columns: str, where: str = "TRUE"):
        rows = ctx[table].filter(where).select(key, "charttime", *columns)
        own = stays.select("stay_id", "starttime", "endtime") if key == "stay_id" else stays.select("stay_id", key, "starttime", "endtime")
        return interval_join(rows, own, [key], "charttime", "starttime", "endtime", closed="right")

    def ends(table: str, key: str, **columns: str):
        aggs = [a for c, n in columns.items() for a in (F.min(c).alias(f"{n}_l"), F.max(c).alias(f"{n}_h"))]
        return day(table, key, *columns).groupBy("stay_id").agg(*aggs)

    masked = day("chartevents", "stay_id", "value", where="itemid = 226732").filter(F.lower("value").rlike("cpap mask|bipap"))
    masked = masked.groupBy("stay_id", "starttime", "endtime").agg(
        (F.min("charttime") - hours(1)).alias("a"), (F.max("charttime") + hours(4)).alias("b")
    ).select("stay_id", F.greatest("a", "starttime").alias("m_start"), F.least("b", "endtime").alias("m_end"))
    masked = masked.join(stays.select("stay_id", "subject_id"), "stay_id").select("subject_id", "m_start", "m_end")
    gas = day("bg", "subject_id", "pao2fio2ratio", where="specimen = 'ART.'").select("subject_id", "stay_id", "charttime", "pao2fio2ratio")
    vent = ctx["ventilation"].filter("ventilation_status = 'InvasiveVent'").select("stay_id", F.col("starttime").alias("m_start"), F.col("endtime").alias("m_end"))
    held = interval_join(gas, vent, ["stay_id"], "charttime", "m_start", "m_end", closed="right").select("stay_id", "pao2fio2ratio")
    under = interval_join(gas, masked, ["subject_id"], "charttime", "m_start", "m_end", closed="right").select("stay_id", "pao2fio2ratio")
    oxygen = held.unionByName(under).groupBy("stay_id").agg(F.min("pao2fio2ratio").alias("pf"))
    first = ctx["services"].groupBy("hadm_id").agg(F.min_by(F.lower("curr_service").contains("surg"), "transfertime").alias("surgical"))
    chronic = prefix_flags(ctx["diagnoses_icd"], "hadm_id", CHRONIC)
    j = stays.join(ctx["admissions"].select("hadm_id", "admission_type"), "hadm_id")
    for t in (ctx["age"].select("hadm_id", "age"), first, chronic):
        j = j.join(t, "hadm_id", "left")
    for t in (
        oxygen, day("gcs", "stay_id", "gcs").groupBy("stay_id").agg(F.min("gcs").alias("gcs")), day("urine_output", "stay_id", "urineoutput").groupBy("stay_id").agg(F.sum("urineoutput").alias("u")),
        ends("vitalsign", "subject_id", heart_rate="hr", sbp="bp", temperature="t"), ends("chemistry", "subject_id", bun="bun", potassium="k", sodium="na", bicarbonate="co"),
        ends("complete_blood_count", "subject_id", wbc="w"), ends("enzyme", "subject_id", bilirubin_total="bi"),
    ):
        j = j.join(t, "stay_id", "left")
    c = F.col
    known = lambda x: (c(x).isNotNull(), 0)
    rising = lambda x, *steps: step_score([*[(c(x) < b, p) for b, p in steps[:-1]], (c(x) >= steps[-1][0], steps[-1][1])], None)
    surgery, elective = F.coalesce("surgical", F.lit(False)), c("admission_type") == "ELECTIVE"
    points = {
        "age_score": rising("age", (40, 0), (60, 7), (70, 12), (75, 15), (80, 16), (80, 18)),
        "hr_score": step_score([(c("hr_l") < 40, 11), (c("hr_h") >= 160, 7), (c("hr_h") >= 120, 4), (c("hr_l") < 70, 2), known("hr_h")], None),
        "sysbp_score": step_score([(c("bp_l") < 70, 13), (c("bp_l") < 100, 5), (c("bp_h") >= 200, 2), known("bp_l")], None),
        "temp_score": step_score([(c("t_h") >= 39, 3), (c("t_l") < 39, 0)], None),
        "pao2fio2_score": rising("pf", (100, 11), (200, 9), (200, 6)), "uo_score": rising("u", (500, 11), (1000, 4), (1000, 0)), "bun_score": rising("bun_h", (28, 0), (84, 6), (84, 10)),
        "wbc_score": step_score([(c("w_l") < 1, 12), (c("w_h") >= 20, 3), known("w_h")], None), "potassium_score": step_score([((c("k_l") < 3) | (c("k_h") >= 5), 3), known("k_h")], None),
        "sodium_score": step_score([(c("na_l") < 125, 5), (c("na_h") >= 145, 1), known("na_h")], None), "bicarbonate_score": step_score([(c("co_l") < 15, 6), (c("co_l") < 20, 3), known("co_h")], None),
        "bilirubin_score": rising("bi_h", (4, 0), (6, 4), (6, 9)),
        "gcs_score": step_score([(c("gcs") < 6, 26), (c("gcs") < 9, 13), (c("gcs") < 11, 7), (c("gcs") < 14, 5), (c("gcs") <= 15, 0)], None, c("gcs") < 3),
        "comorbidity_score": step_score([(c("aids") == 1, 17), (c("hem") == 1, 10), (c("mets") == 1, 9)], 0),
        "admissiontype_score": step_score([(surgery & elective, 0), (surgery & ~elective, 8)], 6),
    }
    s = j.select("subject_id", "hadm_id", "stay_id", "starttime", "endtime", *[x.alias(n) for n, x in points.items()])
    s = s.withColumn("sapsii", sum((F.coalesce(n, F.lit(0)) for n in points), F.lit(0)))
    return s.withColumn("sapsii_prob", F.round(logistic(-7.7631 + 0.0737 * F.col("sapsii") + 0.9971 * F.log(F.col("sapsii") + 1)), 9))
