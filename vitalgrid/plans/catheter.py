"""Arterial catheter study: a cohort around an index event, covariates at the start of ventilation, the final join.

Every table of covariates holds all candidates; the final join takes the included ones.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from vitalgrid.functions.dt import hours, micros
from vitalgrid.functions.scalar import step_score
from vitalgrid.operators.cohort import cohort_flags, flag_within, last_at_anchor
from vitalgrid.operators.joins import anchored_join, asof_join, interval_join, previous_within
from vitalgrid.plans.registry import concept

# Codes of the charting systems, the laboratory and the infusions.
ARTERIAL = [51, 6701, 220050, 8368, 8555, 220051, 52, 6702, 220052, 225312]
PULSE = [211, 220045]
PRESSORS_CV = [30047, 30120, 30044, 30119, 30309, 30127, 30128, 30051, 30043, 30307, 30125, 30046]
PRESSORS_MV = [221906, 221289, 221749, 222315, 221662, 227692]
SEDATIVES = {"midazolam": ([30124], [221668]), "fentanyl": ([30150, 30308, 30118, 30149], [221744, 225972, 225942]), "propofol": ([30131], [222168])}
LABS = {
    "bun_first": [51006], "chloride_first": [50806, 50902], "creatinine_first": [50912], "hgb_first": [50811, 51222], "platelet_first": [51265], "potassium_first": [50822, 50971], "sodium_first": [50824, 50983],
    "tco2_first": [50803, 50804, 50882], "wbc_first": [51300, 51301],
}
MEAN_PRESSURE = [456, 52, 6702, 443, 220052, 220181, 225312]
FAHRENHEIT, CELSIUS, SATURATION = [223761, 678], [223762, 676], [646, 220277]
VITALS = {"map": MEAN_PRESSURE, "temperature": [*CELSIUS, *FAHRENHEIT], "heartrate": PULSE, "spo2": SATURATION}
URINE = [40055, 43175, 40069, 40094, 40715, 40473, 40085, 40057, 40056, 40405, 40428, 40086, 40096, 40651, 226559, 226560, 226561, 226584, 226563, 226564, 226565, 226567, 226557, 226558, 227488, 227489]
HEART_SURGERY = ["CMED", "CSURG", "VSURG", "TSURG"]
# Diagnoses as whole codes, prefixes and ranges of text.
DIAGNOSES = {
    "endocarditis": ("03642 07422 09320 09321 09322 09323 09324 09884 11281 11504 11514 11594 3911 4210 4211 4219 42490 42491 42499", "", []),
    "chf": ("39891 40201 40291 40491 40413 40493 4280 4281 42820 42821 42822 42823 42830 42831 42832 42833 42840 42841 42842 42843 4289 428 4282 4283 4284", "", []),
    "afib": ("", "4273", []), "renal": ("", "585", []), "liver": ("", "571", []),
    "copd": ("4660 490 4910 4911 49120 49121 4918 4919 4920 4928 494 4940 4941 496", "", []), "cad": ("", "414", []), "stroke": ("", "430 431 432 433 434", []), "malignancy": ("", "", [("140", "239")]),
    "respfail": ("", "518", []), "ards": ("51882 5185", "", []), "pneumonia": ("", "", [("486", "48881"), ("480", "48099"), ("482", "48299"), ("506", "5078")]),
}
DAY = 86_400_000_000


def _in(codes) -> str:
    return ", ".join(map(str, codes))


def _days(end: str, start: str) -> Column:
    return (micros(F.col(end)) - micros(F.col(start))) / DAY


@concept("catheter_vaso_flag", ["older_icustays", "inputevents_cv", "inputevents_mv"], f"""
SELECT subject_id, hadm_id, icustay_id, CAST(icustay_id IN (SELECT icustay_id FROM inputevents_cv WHERE itemid IN ({_in(PRESSORS_CV)}) AND rate > 0)
  OR icustay_id IN (SELECT icustay_id FROM inputevents_mv WHERE itemid IN ({_in(PRESSORS_MV)}) AND rate > 0 AND statusdescription <> 'Rewritten') AS INT) AS vaso_flag FROM older_icustays""")
def catheter_vaso_flag(ctx):
    """Whether a stay ever had a pressor."""
    cv = ctx["inputevents_cv"].filter(F.col("itemid").isin(PRESSORS_CV) & (F.col("rate") > 0)).select("icustay_id")
    mv = ctx["inputevents_mv"].filter(F.col("itemid").isin(PRESSORS_MV) & (F.col("rate") > 0) & (F.col("statusdescription") != "Rewritten")).select("icustay_id")
    given = cv.unionByName(mv).distinct().withColumn("vaso_flag", F.lit(1))
    return ctx["older_icustays"].select("subject_id", "hadm_id", "icustay_id").join(given, "icustay_id", "left").withColumn("vaso_flag", F.coalesce("vaso_flag", F.lit(0)))


@concept("catheter_cohort_all", ["older_icustays", "older_chartevents", "admissions", "older_patients", "services", "ventilation_durations", "catheter_vaso_flag", "angus"], f"""
WITH a AS (SELECT icustay_id, min(charttime) AS starttime_aline FROM older_chartevents WHERE icustay_id IS NOT NULL AND valuenum IS NOT NULL AND itemid IN ({_in(ARTERIAL)}) GROUP BY 1),
t AS (SELECT i.icustay_id, min(charttime) AS intime, max(charttime) AS outtime FROM older_icustays i LEFT JOIN older_chartevents c ON c.icustay_id = i.icustay_id AND c.itemid IN ({_in(PULSE)}) AND c.charttime BETWEEN i.intime - INTERVAL '12' HOUR AND i.outtime + INTERVAL '12' HOUR GROUP BY 1),
v AS (SELECT icustay_id, sum(CAST(epoch_us(endtime) - epoch_us(starttime) AS BIGINT)) / CAST({DAY} AS DOUBLE) AS vent_day, min(starttime) AS vent_starttime, max(endtime) AS vent_endtime FROM ventilation_durations GROUP BY 1),
s AS (SELECT icustay_id, arg_max(curr_service, (transfertime, curr_service)) AS service_unit FROM older_icustays i JOIN services s ON s.hadm_id = i.hadm_id AND s.transfertime < i.intime + INTERVAL '2' HOUR GROUP BY 1),
d AS (SELECT i.subject_id, i.hadm_id, i.icustay_id, t.intime, t.outtime, lower(dayname(t.intime)) AS day_icu_intime, CAST(extract(dow FROM t.intime) AS INT) AS day_icu_intime_num, CAST(extract(hour FROM t.intime) AS INT) AS hour_icu_intime,
  CAST(row_number() OVER (PARTITION BY i.subject_id ORDER BY m.admittime, t.intime, i.icustay_id) AS INT) AS stay_num, (epoch_us(t.intime) - epoch_us(p.dob)) / CAST({DAY} AS DOUBLE) / CAST(365.242 AS DOUBLE) AS age, p.gender, CAST(p.gender = 'M' AS INT) AS gender_num,
  f.vaso_flag, g.angus, a.starttime_aline, CAST(a.starttime_aline IS NOT NULL AS INT) AS aline_flag, (epoch_us(a.starttime_aline) - epoch_us(t.intime)) / CAST({DAY} AS DOUBLE) AS aline_time_day, CAST(coalesce(a.starttime_aline <= t.intime, false) AS INT) AS initial_aline_flag,
  CAST(v.icustay_id IS NOT NULL AS INT) AS vent_flag, CAST(coalesce(v.vent_starttime < t.intime + INTERVAL '12' HOUR, false) AS INT) AS vent_1st_12hr, CAST(coalesce(v.vent_starttime < t.intime + INTERVAL '24' HOUR, false) AS INT) AS vent_1st_24hr,
  CASE WHEN a.starttime_aline > t.intime + INTERVAL '1' HOUR THEN CAST(v.vent_starttime <= a.starttime_aline AS INT) END AS vent_b4_aline, v.vent_day, (epoch_us(i.outtime) - epoch_us(v.vent_endtime)) / CAST({DAY} AS DOUBLE) AS vent_free_day,
  (epoch_us(i.outtime) - epoch_us(t.intime)) / CAST({DAY} AS DOUBLE) - v.vent_day AS vent_off_day, v.vent_starttime, v.vent_endtime, (epoch_us(i.outtime) - epoch_us(t.intime)) / CAST({DAY} AS DOUBLE) AS icu_los_day, (epoch_us(m.dischtime) - epoch_us(m.admittime)) / CAST({DAY} AS DOUBLE) AS hospital_los_day,
  s.service_unit, CASE WHEN s.service_unit LIKE '%SURG' OR s.service_unit LIKE '%ORTHO%' THEN 1 WHEN s.service_unit = 'CMED' THEN 2 WHEN s.service_unit IN ('CSURG', 'VSURG', 'TSURG') THEN 3 ELSE 0 END AS service_num,
  CAST(m.deathtime IS NOT NULL AS INT) AS hosp_exp_flag, CAST(coalesce(m.deathtime <= i.outtime, false) AS INT) AS icu_exp_flag, CAST(coalesce(CAST(p.dod AS TIMESTAMP) <= t.intime + INTERVAL '28' DAY, false) AS INT) AS day_28_flag, (epoch_us(CAST(p.dod AS TIMESTAMP)) - epoch_us(m.admittime)) / CAST({DAY} AS DOUBLE) AS mort_day,
  coalesce((epoch_us(CAST(p.dod AS TIMESTAMP)) - epoch_us(m.admittime)) / CAST({DAY} AS DOUBLE), CAST(150 AS DOUBLE)) AS mort_day_censored, CAST(p.dod IS NULL AS INT) AS censor_flag
  FROM t JOIN older_icustays i ON i.icustay_id = t.icustay_id JOIN admissions m ON m.hadm_id = i.hadm_id JOIN older_patients p ON p.subject_id = i.subject_id LEFT JOIN a ON a.icustay_id = i.icustay_id LEFT JOIN v ON v.icustay_id = i.icustay_id LEFT JOIN s ON s.icustay_id = i.icustay_id
  LEFT JOIN catheter_vaso_flag f ON f.icustay_id = i.icustay_id LEFT JOIN angus g ON g.hadm_id = i.hadm_id WHERE t.intime > p.dob + INTERVAL '16' YEAR),
x AS (SELECT *, CAST(stay_num > 1 AS INT) AS exclusion_readmission, CAST(coalesce(icu_los_day < 1, false) AS INT) AS exclusion_shortstay, CAST(coalesce(vaso_flag = 1, false) AS INT) AS exclusion_vasopressors, CAST(coalesce(angus = 1, false) AS INT) AS exclusion_septic, initial_aline_flag AS exclusion_aline_before_admission,
  CAST(vent_starttime IS NULL OR vent_starttime > intime + INTERVAL '24' HOUR AS INT) AS exclusion_not_ventilated_first24hr, CAST(coalesce(service_unit IN ('CMED', 'CSURG', 'VSURG', 'TSURG'), false) AS INT) AS exclusion_service_surgical FROM d)
SELECT *, CAST(exclusion_readmission + exclusion_shortstay + exclusion_vasopressors + exclusion_septic + exclusion_aline_before_admission + exclusion_not_ventilated_first24hr + exclusion_service_surgical = 0 AS INT) AS included FROM x""")
def catheter_cohort_all(ctx):
    """Adult stays with the first arterial pressure as index event, ventilation around it, outcomes and exclusions."""
    c = F.col
    one = lambda x: F.coalesce(x, F.lit(False)).cast("int")
    stays = ctx["older_icustays"].select("subject_id", "hadm_id", "icustay_id", c("intime").alias("_in"), c("outtime").alias("_out"))
    chart = ctx["older_chartevents"].select("icustay_id", "charttime", "itemid", "valuenum")
    index = chart.filter(c("icustay_id").isNotNull() & c("valuenum").isNotNull() & c("itemid").isin(ARTERIAL)).groupBy("icustay_id").agg(F.min("charttime").alias("starttime_aline"))
    seen = interval_join(chart.filter(c("itemid").isin(PULSE)).select("icustay_id", "charttime"), stays.select("icustay_id", (c("_in") - hours(12)).alias("_s"), (c("_out") + hours(12)).alias("_e")), ["icustay_id"], "charttime", "_s", "_e")
    seen = seen.groupBy("icustay_id").agg(F.min("charttime").alias("intime"), F.max("charttime").alias("outtime"))
    vent = ctx["ventilation_durations"].groupBy("icustay_id").agg((F.sum(micros(c("endtime")) - micros(c("starttime"))) / DAY).alias("vent_day"), F.min("starttime").alias("vent_starttime"), F.max("endtime").alias("vent_endtime"))
    wards = ctx["services"].select("hadm_id", "transfertime", "curr_service").join(stays.select("hadm_id", "icustay_id", "_in"), "hadm_id").filter(c("transfertime") < c("_in") + hours(2))
    wards = wards.groupBy("icustay_id").agg(F.max(F.struct("transfertime", "curr_service"))["curr_service"].alias("service_unit"))
    j = stays.join(seen, "icustay_id").join(ctx["admissions"].select("hadm_id", "admittime", "dischtime", "deathtime"), "hadm_id").join(ctx["older_patients"].select("subject_id", "gender", "dob", c("dod").cast("timestamp_ntz").alias("dod")), "subject_id")
    j = j.join(index, "icustay_id", "left").join(vent, "icustay_id", "left").join(wards, "icustay_id", "left").join(ctx["catheter_vaso_flag"].select("icustay_id", "vaso_flag"), "icustay_id", "left").join(ctx["angus"].select("hadm_id", "angus"), "hadm_id", "left")
    j = j.filter(c("intime") > F.add_months("dob", 16 * 12))
    order = Window.partitionBy("subject_id").orderBy("admittime", "intime", "icustay_id")
    aline, ward = c("starttime_aline"), c("service_unit")
    out = j.select(
        "subject_id", "hadm_id", "icustay_id", "intime", "outtime", F.lower(F.date_format("intime", "EEEE")).alias("day_icu_intime"), (F.dayofweek("intime") - 1).alias("day_icu_intime_num"), F.hour("intime").alias("hour_icu_intime"),
        F.row_number().over(order).alias("stay_num"), (_days("intime", "dob") / 365.242).alias("age"), "gender", one(c("gender") == "M").alias("gender_num"), "vaso_flag", "angus", "starttime_aline", aline.isNotNull().cast("int").alias("aline_flag"),
        _days("starttime_aline", "intime").alias("aline_time_day"), one(aline <= c("intime")).alias("initial_aline_flag"), c("vent_starttime").isNotNull().cast("int").alias("vent_flag"), *[one(c("vent_starttime") < c("intime") + hours(h)).alias(f"vent_1st_{h}hr") for h in (12, 24)],
        F.when(aline > c("intime") + hours(1), (c("vent_starttime") <= aline).cast("int")).alias("vent_b4_aline"), "vent_day", _days("_out", "vent_endtime").alias("vent_free_day"), (_days("_out", "intime") - c("vent_day")).alias("vent_off_day"), "vent_starttime", "vent_endtime",
        _days("_out", "intime").alias("icu_los_day"), _days("dischtime", "admittime").alias("hospital_los_day"), "service_unit",
        F.when(ward.endswith("SURG") | ward.contains("ORTHO"), 1).when(ward == "CMED", 2).when(ward.isin("CSURG", "VSURG", "TSURG"), 3).otherwise(0).alias("service_num"), c("deathtime").isNotNull().cast("int").alias("hosp_exp_flag"), one(c("deathtime") <= c("_out")).alias("icu_exp_flag"),
        one(c("dod") <= c("intime") + hours(28 * 24)).alias("day_28_flag"), _days("dod", "admittime").alias("mort_day"), F.coalesce(_days("dod", "admittime"), F.lit(150.0)).alias("mort_day_censored"), c("dod").isNull().cast("int").alias("censor_flag"),
    )
    return cohort_flags(out, {
        "readmission": c("stay_num") > 1, "shortstay": c("icu_los_day") < 1, "vasopressors": c("vaso_flag") == 1, "septic": c("angus") == 1, "aline_before_admission": c("initial_aline_flag") == 1,
        "not_ventilated_first24hr": c("vent_starttime").isNull() | (c("vent_starttime") > c("intime") + hours(24)), "service_surgical": ward.isin(HEART_SURGERY),
    })


@concept("catheter_cohort", ["catheter_cohort_all"], "SELECT * FROM catheter_cohort_all WHERE included = 1")
def catheter_cohort(ctx):
    return ctx["catheter_cohort_all"].filter("included = 1")


@concept("catheter_bmi", ["catheter_cohort_all", "heightweight"], """
SELECT c.icustay_id, weight_first / (height_first * height_first) AS bmi, height_first AS height, weight_first AS weight FROM catheter_cohort_all c LEFT JOIN heightweight h ON h.icustay_id = c.icustay_id""")
def catheter_bmi(ctx):
    body = ctx["heightweight"].select("icustay_id", F.col("height_first").alias("height"), F.col("weight_first").alias("weight"))
    return ctx["catheter_cohort_all"].select("icustay_id").join(body, "icustay_id", "left").select("icustay_id", (F.col("weight") / (F.col("height") * F.col("height"))).alias("bmi"), "height", "weight")


def _coded_sql(whole: str, prefixes: str, ranges) -> str:
    tests = [f"icd9_code IN ({', '.join(repr(x) for x in whole.split())})"] if whole else []
    tests += [f"icd9_code LIKE '{x}%'" for x in prefixes.split()] + [f"icd9_code BETWEEN '{a}' AND '{b}'" for a, b in ranges]
    return " OR ".join(tests)


def _coded(whole: str, prefixes: str, ranges) -> Column:
    code, out = F.col("icd9_code"), F.lit(False)
    if whole:
        out = out | code.isin(whole.split())
    for x in prefixes.split():
        out = out | code.startswith(x)
    for a, b in ranges:
        out = out | code.between(a, b)
    return out


@concept("catheter_icd", ["catheter_cohort_all", "older_diagnoses"], f"""
SELECT c.hadm_id, {', '.join(f"CAST(coalesce(bool_or({_coded_sql(*r)}), false) AS INT) AS {n}" for n, r in DIAGNOSES.items())}
FROM (SELECT DISTINCT hadm_id FROM catheter_cohort_all) c LEFT JOIN older_diagnoses d ON d.hadm_id = c.hadm_id GROUP BY 1""")
def catheter_icd(ctx):
    """Comorbidities of the admission: diagnoses are flagged before they meet the cohort."""
    found = ctx["older_diagnoses"].groupBy("hadm_id").agg(*[F.max(_coded(*r).cast("int")).alias(n) for n, r in DIAGNOSES.items()])
    return ctx["catheter_cohort_all"].select("hadm_id").distinct().join(found, "hadm_id", "left").select("hadm_id", *[F.coalesce(n, F.lit(0)).alias(n) for n in DIAGNOSES])


def _labelled_sql(groups: dict) -> str:
    return "CASE " + " ".join(f"WHEN itemid IN ({_in(codes)}) THEN '{n}'" for n, codes in groups.items()) + " END"


def _last_sql(groups: dict, on: str, source: str, value: str, before: str, where: str) -> str:
    return f"""
WITH n AS (SELECT c.icustay_id, {_labelled_sql(groups)} AS label, {value} AS v, e.charttime AS t, CAST(e.charttime > c.vent_starttime AS INT) AS late FROM catheter_cohort_all c JOIN {source} e ON e.{on} = c.{on} AND e.charttime <= c.vent_starttime + INTERVAL '4' HOUR
  AND e.charttime >= c.vent_starttime - INTERVAL {before} WHERE valuenum IS NOT NULL AND itemid IN ({_in(sum(groups.values(), []))}) {where}),
r AS (SELECT *, row_number() OVER (PARTITION BY icustay_id, label, late ORDER BY t DESC, v DESC NULLS LAST) AS rn FROM n)
SELECT c.icustay_id, {', '.join(f"coalesce(max(v) FILTER (WHERE rn = 1 AND late = 0 AND label = '{n}'), max(v) FILTER (WHERE rn = 1 AND late = 1 AND label = '{n}')) AS {n}" for n in groups)} FROM catheter_cohort_all c LEFT JOIN r ON r.icustay_id = c.icustay_id GROUP BY 1"""


def _label(groups: dict) -> Column:
    out = F.lit(None).cast("string")
    for n, codes in groups.items():
        out = F.when(F.col("itemid").isin(codes), n).otherwise(out)
    return out


def _last(ctx, events, groups: dict, on: str, value: Column, before: Column):
    cohort = ctx["catheter_cohort_all"]
    rows = events.filter(F.col("itemid").isin(sum(groups.values(), [])) & F.col("valuenum").isNotNull()).select(on, "charttime", _label(groups).alias("label"), value.alias("v"))
    found = last_at_anchor(cohort, rows, on, "vent_starttime", "charttime", "label", "v", list(groups), before, hours(4), "icustay_id")
    return cohort.select("icustay_id").join(found, "icustay_id", "left")


@concept("catheter_labs", ["catheter_cohort_all", "older_labevents"], _last_sql(LABS, "subject_id", "older_labevents", "valuenum", "'2' DAY", ""))
def catheter_labs(ctx):
    """The last value of each test before ventilation, or of the four hours after."""
    return _last(ctx, ctx["older_labevents"], LABS, "subject_id", F.col("valuenum"), hours(48))


@concept("catheter_vitals", ["catheter_cohort_all", "older_chartevents"], _last_sql(
    VITALS, "icustay_id", "older_chartevents",
    f"CASE WHEN itemid IN ({_in(FAHRENHEIT)}) AND (valuenum - 32) / CAST(1.8 AS DOUBLE) < 10 THEN NULL WHEN itemid IN ({_in(CELSIUS)}) AND valuenum < 10 THEN NULL WHEN itemid IN ({_in(FAHRENHEIT)}) THEN (valuenum - 32) / CAST(1.8 AS DOUBLE) WHEN itemid IN ({_in(SATURATION)}) AND valuenum <= 25 THEN NULL ELSE valuenum END",
    "'1' DAY", "AND coalesce(error, 0) <> 1"))
def catheter_vitals(ctx):
    code, v = F.col("itemid"), F.col("valuenum")
    warmth = F.when(code.isin(FAHRENHEIT), (v - 32) / 1.8).otherwise(v)
    value = F.when(code.isin([*FAHRENHEIT, *CELSIUS]), F.when(warmth >= 10, warmth)).when(code.isin(SATURATION), F.when(v > 25, v)).otherwise(v)
    return _last(ctx, ctx["older_chartevents"].filter("coalesce(error, 0) <> 1"), VITALS, "icustay_id", value, hours(24))


@concept("catheter_sedatives", ["catheter_cohort_all", "inputevents_cv", "inputevents_mv"], f"""
WITH g AS (SELECT icustay_id, itemid, charttime AS s, NULL AS e FROM inputevents_cv WHERE itemid IN ({_in(c for cv, _ in SEDATIVES.values() for c in cv)}) AND (rate > 0 OR amount > 0)
  UNION ALL SELECT icustay_id, itemid, starttime, endtime FROM inputevents_mv WHERE itemid IN ({_in(c for _, mv in SEDATIVES.values() for c in mv)}) AND (rate > 0 OR amount > 0) AND statusdescription <> 'Rewritten')
SELECT c.subject_id, c.hadm_id, c.icustay_id, CAST(count(g.icustay_id) > 0 AS INT) AS sedative_flag, {', '.join(f"CAST(count(*) FILTER (WHERE g.itemid IN ({_in([*cv, *mv])})) > 0 AS INT) AS {n}_flag" for n, (cv, mv) in SEDATIVES.items())}
FROM catheter_cohort_all c LEFT JOIN g ON g.icustay_id = c.icustay_id AND c.starttime_aline > g.s AND (g.e IS NULL OR c.starttime_aline <= g.e) GROUP BY ALL""")
def catheter_sedatives(ctx):
    """Sedatives that ran when the catheter was placed; charted doses have no end and count from then on."""
    code, given = F.col("itemid"), (F.col("rate") > 0) | (F.col("amount") > 0)
    cv = ctx["inputevents_cv"].filter(code.isin([c for cv, _ in SEDATIVES.values() for c in cv]) & given).select("icustay_id", "itemid", F.col("charttime").alias("_s"), F.lit(None).cast("timestamp_ntz").alias("_e"))
    mv = ctx["inputevents_mv"].filter(code.isin([c for _, mv in SEDATIVES.values() for c in mv]) & given & (F.col("statusdescription") != "Rewritten")).select("icustay_id", "itemid", F.col("starttime").alias("_s"), F.col("endtime").alias("_e"))
    flags = {"sedative_flag": code.isNotNull(), **{f"{n}_flag": code.isin([*cvs, *mvs]) for n, (cvs, mvs) in SEDATIVES.items()}}
    cohort = ctx["catheter_cohort_all"].select("subject_id", "hadm_id", "icustay_id", "starttime_aline")
    found = flag_within(cohort, cv.unionByName(mv), "icustay_id", "starttime_aline", "_s", "_e", flags, "icustay_id")
    return cohort.drop("starttime_aline").join(found, "icustay_id", "left").withColumns({n: F.coalesce(n, F.lit(0)) for n in flags})


@concept("catheter_sofa", ["catheter_cohort_all", "older_chartevents", "older_labevents", "older_outputevents"], f"""
WITH co AS (SELECT subject_id, icustay_id, intime, vent_starttime - INTERVAL '1' DAY AS s, vent_starttime + INTERVAL '2' HOUR AS e FROM catheter_cohort_all),
f AS (SELECT co.icustay_id, c.charttime, max(CASE WHEN itemid = 223835 THEN CASE WHEN valuenum > 0 AND valuenum <= 1 THEN valuenum * 100 WHEN valuenum >= 21 AND valuenum <= 100 THEN valuenum END WHEN itemid IN (3420, 3422) THEN valuenum WHEN itemid = 190 AND valuenum > CAST(0.2 AS DOUBLE) AND valuenum < 1 THEN valuenum * 100 END) AS charted
  FROM co JOIN older_chartevents c ON c.icustay_id = co.icustay_id WHERE itemid IN (3420, 190, 223835, 3422) GROUP BY 1, 2),
b AS (SELECT co.icustay_id, l.charttime, max(CASE WHEN itemid = 50800 THEN value END) AS specimen, max(CASE WHEN itemid = 50816 AND valuenum > 0 AND valuenum <= 100 THEN valuenum END) AS fio2, max(CASE WHEN itemid = 50821 AND valuenum > 0 AND valuenum <= 800 THEN valuenum END) AS po2
  FROM co JOIN older_labevents l ON l.subject_id = co.subject_id AND l.charttime BETWEEN co.s AND co.e WHERE itemid IN (50800, 50816, 50821) GROUP BY 1, 2),
p AS (SELECT b.icustay_id, b.po2, coalesce(b.fio2, f.charted) AS share, row_number() OVER (PARTITION BY b.icustay_id ORDER BY b.charttime DESC, f.charttime DESC) AS rn FROM b LEFT JOIN f ON f.icustay_id = b.icustay_id AND f.charttime BETWEEN b.charttime - INTERVAL '4' HOUR AND b.charttime
  WHERE po2 IS NOT NULL AND coalesce(specimen, 'ART') = 'ART'),
l AS (SELECT co.icustay_id, max(CASE WHEN itemid = 50885 AND valuenum <= 150 THEN valuenum END) AS bilirubin, max(CASE WHEN itemid = 50912 AND valuenum <= 150 THEN valuenum END) AS creatinine, min(CASE WHEN itemid = 51265 AND valuenum <= 10000 THEN valuenum END) AS platelet
  FROM co JOIN older_labevents l ON l.subject_id = co.subject_id AND l.charttime BETWEEN co.s AND co.e WHERE valuenum > 0 GROUP BY 1),
m AS (SELECT co.icustay_id, min(valuenum) AS pressure FROM co JOIN older_chartevents c ON c.subject_id = co.subject_id AND c.charttime BETWEEN co.s AND co.e WHERE itemid IN ({_in(MEAN_PRESSURE)}) GROUP BY 1),
u AS (SELECT co.icustay_id, sum(CASE WHEN itemid = 227488 THEN -value ELSE value END) / (CASE WHEN max(charttime) < min(co.intime) AND max(charttime) <= min(charttime) THEN 1 ELSE (epoch_us(max(charttime)) - epoch_us(min(charttime))) / CAST(3600000000 AS DOUBLE) + 1 END) * 24 AS urine
  FROM co JOIN older_outputevents o ON o.subject_id = co.subject_id AND o.charttime BETWEEN co.s AND co.e WHERE itemid IN ({_in(URINE)}) GROUP BY 1),
g0 AS (SELECT co.icustay_id, charttime, max(CASE WHEN itemid IN (454, 223901) THEN valuenum END) AS motor, max(CASE WHEN itemid IN (723, 223900) THEN valuenum END) AS verbal, max(CASE WHEN itemid IN (184, 220739) THEN valuenum END) AS eyes
  FROM co JOIN older_chartevents c ON c.subject_id = co.subject_id AND c.charttime BETWEEN co.s AND co.e WHERE itemid IN (184, 454, 723, 223900, 223901, 220739) GROUP BY 1, 2),
g1 AS (SELECT *, lag(charttime) OVER w > charttime - INTERVAL '6' HOUR AS near, lag(motor) OVER w AS m0, lag(verbal) OVER w AS v0, lag(eyes) OVER w AS e0 FROM g0 WINDOW w AS (PARTITION BY icustay_id ORDER BY charttime)),
g AS (SELECT icustay_id, min(CASE WHEN verbal = 0 THEN 15 WHEN verbal IS NULL AND near AND v0 = 0 THEN 15 WHEN near AND v0 = 0 THEN coalesce(motor, 6) + coalesce(verbal, 5) + coalesce(eyes, 4)
  ELSE coalesce(motor, CASE WHEN near THEN m0 END, 6) + coalesce(verbal, CASE WHEN near THEN v0 END, 5) + coalesce(eyes, CASE WHEN near THEN e0 END, 4) END) AS gcs FROM g1 GROUP BY 1),
j AS (SELECT co.icustay_id, CASE WHEN share > 0 AND share < 100 THEN 100 * po2 / share END AS pf, platelet, bilirubin, creatinine, pressure, urine, gcs FROM co LEFT JOIN p ON p.icustay_id = co.icustay_id AND rn = 1 LEFT JOIN l ON l.icustay_id = co.icustay_id
  LEFT JOIN m ON m.icustay_id = co.icustay_id LEFT JOIN u ON u.icustay_id = co.icustay_id LEFT JOIN g ON g.icustay_id = co.icustay_id),
s AS (SELECT icustay_id, CASE WHEN pf < 300 THEN 2 WHEN pf < 400 THEN 1 WHEN pf IS NOT NULL THEN 0 END AS respiration, CASE WHEN platelet < 20 THEN 4 WHEN platelet < 50 THEN 3 WHEN platelet < 100 THEN 2 WHEN platelet < 150 THEN 1 WHEN platelet IS NOT NULL THEN 0 END AS coagulation,
  CASE WHEN bilirubin >= 12 THEN 4 WHEN bilirubin >= 6 THEN 3 WHEN bilirubin >= 2 THEN 2 WHEN bilirubin >= CAST(1.2 AS DOUBLE) THEN 1 WHEN bilirubin IS NOT NULL THEN 0 END AS liver, CASE WHEN pressure < 70 THEN 1 WHEN pressure IS NOT NULL THEN 0 END AS cardiovascular,
  CASE WHEN gcs >= 13 AND gcs <= 14 THEN 1 WHEN gcs >= 10 AND gcs <= 12 THEN 2 WHEN gcs >= 6 AND gcs <= 9 THEN 3 WHEN gcs < 6 THEN 4 WHEN gcs IS NOT NULL THEN 0 END AS cns,
  CASE WHEN creatinine >= 5 OR urine < 200 THEN 4 WHEN creatinine >= CAST(3.5 AS DOUBLE) OR urine < 500 THEN 3 WHEN creatinine >= 2 THEN 2 WHEN creatinine >= CAST(1.2 AS DOUBLE) THEN 1 WHEN coalesce(urine, creatinine) IS NOT NULL THEN 0 END AS renal FROM j)
SELECT *, coalesce(respiration, 0) + coalesce(coagulation, 0) + coalesce(liver, 0) + coalesce(cardiovascular, 0) + coalesce(cns, 0) + coalesce(renal, 0) AS sofa FROM s""")
def catheter_sofa(ctx):
    """Organ failure in the day before ventilation and two hours after; nobody had pressors then."""
    c = F.col
    cohort = ctx["catheter_cohort_all"].select("subject_id", "icustay_id", "intime", "vent_starttime")
    around = lambda rows, on: anchored_join(cohort, rows, [on], "vent_starttime", "charttime", hours(24), hours(2), how="inner")
    code, v = c("itemid"), c("valuenum")
    of = lambda codes, value=v: F.when(code.isin(codes), value)
    chart = ctx["older_chartevents"].select("subject_id", c("icustay_id"), "charttime", "itemid", "value", "valuenum")
    by_subject = chart.drop("icustay_id")
    own = F.when((v > 0) & (v <= 1), v * 100).when(v.between(21, 100), v)
    charted = chart.filter(code.isin(3420, 190, 223835, 3422)).groupBy("icustay_id", c("charttime").alias("_seen")).agg(F.max(F.when(code == 223835, own).when(code.isin(3420, 3422), v).when((code == 190) & (v > 0.2) & (v < 1), v * 100)).alias("charted"))
    gas = around(ctx["older_labevents"].filter(code.isin(50800, 50816, 50821)).select("subject_id", "charttime", "itemid", "value", "valuenum"), "subject_id").groupBy("icustay_id", "charttime").agg(
        F.max(of([50800], c("value"))).alias("specimen"), F.max(of([50816], F.when((v > 0) & (v <= 100), v))).alias("fio2"), F.max(of([50821], F.when((v > 0) & (v <= 800), v))).alias("po2"))
    gas = gas.filter("po2 IS NOT NULL AND coalesce(specimen, 'ART') = 'ART'").groupBy("icustay_id").agg(F.max(F.struct("charttime", "po2", "fio2")).alias("g")).select("icustay_id", "g.*")
    gas = asof_join(gas, charted, ["icustay_id"], "charttime", "_seen", ["charted"], 4)
    share = F.coalesce("fio2", "charted")
    gas = gas.select("icustay_id", F.when((share > 0) & (share < 100), 100 * c("po2") / share).alias("pf"))
    labs = around(ctx["older_labevents"].filter(code.isin(50885, 50912, 51265) & (v > 0)).select("subject_id", "charttime", "itemid", "valuenum"), "subject_id").groupBy("icustay_id").agg(
        F.max(of([50885], F.when(v <= 150, v))).alias("bilirubin"), F.max(of([50912], F.when(v <= 150, v))).alias("creatinine"), F.min(of([51265], F.when(v <= 10000, v))).alias("platelet"))
    pressure = around(by_subject.filter(code.isin(MEAN_PRESSURE)), "subject_id").groupBy("icustay_id").agg(F.min(v).alias("pressure"))
    span = (micros(F.max("charttime")) - micros(F.min("charttime"))) / 3_600_000_000 + 1
    over = F.when((F.max("charttime") < F.min("intime")) & (F.max("charttime") <= F.min("charttime")), 1.0).otherwise(span)
    urine = around(ctx["older_outputevents"].filter(code.isin(URINE)).select("subject_id", "charttime", "itemid", c("value").alias("_ml")), "subject_id").groupBy("icustay_id").agg((F.sum(F.when(code == 227488, -c("_ml")).otherwise(c("_ml"))) / over * 24).alias("urine"))
    parts = {"motor": ([454, 223901], 6), "verbal": ([723, 223900], 5), "eyes": ([184, 220739], 4)}
    coma = around(by_subject.filter(code.isin(sum((p for p, _ in parts.values()), []))), "subject_id").groupBy("icustay_id", "charttime").agg(*[F.max(of(p)).alias(n) for n, (p, _) in parts.items()])
    coma = previous_within(coma, ["icustay_id"], "charttime", list(parts), hours(6))
    total = lambda *sources: sum((F.coalesce(*[c(f"{s}{n}") for s in sources], F.lit(float(best))) for n, (_, best) in parts.items()), F.lit(0.0))
    tube = (c("verbal") == 0) | (c("verbal").isNull() & (c("prev_verbal") == 0))
    coma = coma.groupBy("icustay_id").agg(F.min(F.when(tube, 15.0).when(c("prev_verbal") == 0, total("")).otherwise(total("", "prev_"))).alias("gcs"))
    j = cohort.select("icustay_id")
    for part in (gas, labs, pressure, urine, coma):
        j = j.join(part, "icustay_id", "left")
    steps = {
        "respiration": ("pf", [(c("pf") < x, p) for x, p in ((300, 2), (400, 1))]), "coagulation": ("platelet", [(c("platelet") < x, p) for x, p in ((20, 4), (50, 3), (100, 2), (150, 1))]),
        "liver": ("bilirubin", [(c("bilirubin") >= x, p) for x, p in ((12, 4), (6, 3), (2, 2), (1.2, 1))]), "cardiovascular": ("pressure", [(c("pressure") < 70, 1)]),
        "cns": ("gcs", [(c("gcs") < 6, 4), (c("gcs").between(6, 9), 3), (c("gcs").between(10, 12), 2), (c("gcs").between(13, 14), 1)]),
        "renal": (None, [((c("creatinine") >= x) | (c("urine") < y), p) for x, y, p in ((5, 200, 4), (3.5, 500, 3))] + [(c("creatinine") >= 2, 2), (c("creatinine") >= 1.2, 1)]),
    }
    known = lambda x: c(x).isNull() if x else F.coalesce("urine", "creatinine").isNull()
    out = j.select("icustay_id", *[step_score([*cases, (known(x), None)], 0).alias(n) for n, (x, cases) in steps.items()])
    return out.withColumn("sofa", sum((F.coalesce(n, F.lit(0)) for n in steps), F.lit(0)))


_JOINED = {"catheter_bmi": ["bmi", "height", "weight"], "catheter_labs": list(LABS), "catheter_vitals": list(VITALS), "catheter_sedatives": ["sedative_flag", *[f"{n}_flag" for n in SEDATIVES]], "catheter_sofa": ["sofa"]}
_KEPT = ["subject_id", "hadm_id", "icustay_id", "age", "gender_num", "day_icu_intime_num", "hour_icu_intime", "service_num", "aline_flag", "aline_time_day", "vent_b4_aline", "vent_day", "icu_los_day", "hospital_los_day", "hosp_exp_flag", "icu_exp_flag", "day_28_flag", "mort_day_censored", "censor_flag"]


@concept("catheter_final", ["catheter_cohort", *_JOINED, "catheter_icd"], f"""
SELECT {', '.join('c.' + k for k in _KEPT)}, {', '.join(f't{i}.{x}' for i, cols in enumerate(_JOINED.values()) for x in cols)}, {', '.join('d.' + n for n in DIAGNOSES)}
FROM catheter_cohort c {' '.join(f'LEFT JOIN {t} t{i} ON t{i}.icustay_id = c.icustay_id' for i, t in enumerate(_JOINED))} LEFT JOIN catheter_icd d ON d.hadm_id = c.hadm_id""")
def catheter_final(ctx):
    """The included stays with all covariates."""
    out = ctx["catheter_cohort"].select(_KEPT)
    for name, columns in _JOINED.items():
        out = out.join(ctx[name].select("icustay_id", *columns), "icustay_id", "left")
    return out.join(ctx["catheter_icd"], "hadm_id", "left")
