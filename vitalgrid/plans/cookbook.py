"""Small descriptive queries: value histograms, code counts, patient counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalgrid.functions.dt import days
from vitalgrid.operators.cohort import histogram
from vitalgrid.operators.episodes import day_spine
from vitalgrid.operators.joins import anchored_join, cooccurrence
from vitalgrid.plans.registry import concept


def _bucket_sql(value: str, low: float, high: float, bins: int) -> str:
    v, lo, hi = f"CAST({value} AS DOUBLE)", f"CAST({low} AS DOUBLE)", f"CAST({high} AS DOUBLE)"
    return f"CAST(CASE WHEN {v} < {lo} THEN 0 WHEN {v} >= {hi} THEN {bins + 1} ELSE floor(({v} - {lo}) * {bins} / ({hi} - {lo})) + 1 END AS BIGINT)"


# Codes, range and number of bins of each histogram.
HISTOGRAMS = {
    "bun": ("labevents", (51006,), 0, 280, 280), "glucose": ("labevents", (50809, 50931), 0.5, 1000, 1000), "hco": ("labevents", (50803, 50804, 50882), 0, 231, 231),
    "heart_rate": ("chartevents", (211, 220045), 0, 300, 301), "potassium": ("labevents", (50822, 50971), 0, 10, 100), "rr": ("chartevents", (219, 615, 618, 220210, 224690), 0, 130, 1400),
    "sbp": ("chartevents", (6, 51, 455, 6701, 220179, 220050), 0, 300, 300), "sodium": ("labevents", (50824, 50983), 0, 180, 180), "wbc": ("labevents", (51300, 51301), 0, 100, 1001),
    "gcs": ("chartevents", (454, 223900, 223901), 1, 30, 30),
}


def _histogram(name: str, table: str, codes: tuple[int, ...], low: float, high: float, bins: int) -> None:
    @concept(f"cookbook_{name}", [table, "age"], f"""
SELECT {_bucket_sql('t.valuenum', low, high, bins)} AS bucket, count(*) AS freq FROM {table} t
WHERE t.itemid IN ({', '.join(map(str, codes))}) AND t.valuenum IS NOT NULL AND t.subject_id IN (SELECT subject_id FROM age WHERE age > 15) GROUP BY 1""")
    def build(ctx):
        adults = ctx["age"].filter("age > 15").select("subject_id").distinct()
        rows = ctx[table].filter(F.col("itemid").isin(list(codes))).select("subject_id", "valuenum").join(adults, "subject_id", "left_semi")
        return histogram(rows, "valuenum", low, high, bins)


for _name, _spec in HISTOGRAMS.items():
    _histogram(_name, *_spec)


@concept("cookbook_temp", ["chartevents"], f"""
SELECT {_bucket_sql('v', 30, 45, 160)} AS bucket, count(*) AS freq FROM (SELECT CASE itemid WHEN 223762 THEN valuenum ELSE (valuenum - 32) * 5 / 9 END AS v FROM chartevents WHERE itemid IN (223762, 223761) AND valuenum IS NOT NULL) q GROUP BY 1""")
def temp(ctx):
    rows = ctx["chartevents"].filter(F.col("itemid").isin(223762, 223761))
    return histogram(rows.select(F.when(F.col("itemid") == 223762, F.col("valuenum")).otherwise((F.col("valuenum") - 32) * 5 / 9).alias("v")), "v", 30, 45, 160)


@concept("cookbook_height", ["chartevents"], f"SELECT {_bucket_sql('valuenum', 1, 200, 200)} AS bucket, count(*) AS freq FROM chartevents WHERE itemid IN (920, 226730) AND valuenum > 0 AND valuenum < 500 GROUP BY 1")
def height(ctx):
    return histogram(ctx["chartevents"].filter("itemid IN (920, 226730) AND valuenum > 0 AND valuenum < 500"), "valuenum", 1, 200, 200)


@concept("cookbook_age_histogram", ["age"], f"SELECT {_bucket_sql('age', 15, 100, 85)} AS bucket, count(*) AS freq FROM age GROUP BY 1")
def age_histogram(ctx):
    return histogram(ctx["age"].withColumn("age", F.col("age").cast("double")), "age", 15, 100, 85)


@concept("cookbook_uo", ["icustays", "outputevents"], f"""
WITH s AS (SELECT i.stay_id, sum(o.value) AS u FROM icustays i JOIN outputevents o ON o.stay_id = i.stay_id AND o.charttime BETWEEN i.intime AND i.intime + INTERVAL '1' DAY GROUP BY 1)
SELECT {_bucket_sql('u', 0, 5000, 50)} AS bucket, count(*) AS freq FROM s GROUP BY 1""")
def uo(ctx):
    stays = ctx["icustays"].select("stay_id", "intime")
    near = anchored_join(stays, ctx["outputevents"].select("stay_id", "charttime", "value"), ["stay_id"], "intime", "charttime", days(0), days(1), how="inner")
    return histogram(near.groupBy("stay_id").agg(F.sum("value").alias("u")), "u", 0, 5000, 50)


@concept("cookbook_min_surviving_bp", ["patients", "chartevents"], f"""
WITH m AS (SELECT c.stay_id, min(c.valuenum) AS v FROM chartevents c JOIN patients p ON p.subject_id = c.subject_id AND p.dod IS NULL WHERE c.itemid IN (220179, 220050) GROUP BY 1)
SELECT {_bucket_sql('v', 0, 300, 300)} AS bucket, count(*) AS freq FROM m WHERE v IS NOT NULL GROUP BY 1""")
def min_surviving_bp(ctx):
    alive = ctx["patients"].filter("dod IS NULL").select("subject_id")
    low = ctx["chartevents"].filter("itemid IN (220179, 220050)").join(alive, "subject_id", "left_semi").groupBy("stay_id").agg(F.min("valuenum").alias("v"))
    return histogram(low, "v", 0, 300, 300)


@concept("cookbook_icd9count", ["diagnoses_icd"], "SELECT count(DISTINCT subject_id) AS patients FROM diagnoses_icd WHERE icd_code LIKE '401%'")
def icd9count(ctx):
    return ctx["diagnoses_icd"].filter(F.col("icd_code").startswith("401")).agg(F.count_distinct("subject_id").alias("patients"))


@concept("cookbook_icd9agelimited", ["diagnoses_icd", "age"], "SELECT count(DISTINCT d.subject_id) AS patients FROM diagnoses_icd d JOIN age a ON a.subject_id = d.subject_id WHERE icd_code LIKE '401%' AND age > 30")
def icd9agelimited(ctx):
    older = ctx["age"].filter("age > 30").select("subject_id")
    return ctx["diagnoses_icd"].filter(F.col("icd_code").startswith("401")).join(older, "subject_id", "left_semi").agg(F.count_distinct("subject_id").alias("patients"))


def _pair(ctx):
    code = F.col("icd_code")
    family = F.when(code.startswith("401"), "a").when(code.startswith("250"), "b")
    return cooccurrence(ctx["diagnoses_icd"].withColumn("family", family), "subject_id", "family", "a", "b")


@concept("cookbook_icd9vicd9count", ["diagnoses_icd"], "SELECT count(*) AS patients FROM (SELECT subject_id FROM diagnoses_icd WHERE icd_code LIKE '401%' INTERSECT SELECT subject_id FROM diagnoses_icd WHERE icd_code LIKE '250%') q")
def icd9vicd9count(ctx):
    return _pair(ctx).agg(F.count("*").alias("patients"))


@concept("cookbook_icd9vicd9agelimited", ["diagnoses_icd", "age"], "SELECT count(*) AS patients FROM (SELECT subject_id FROM diagnoses_icd WHERE icd_code LIKE '401%' INTERSECT SELECT subject_id FROM diagnoses_icd WHERE icd_code LIKE '250%' INTERSECT SELECT subject_id FROM age WHERE age > 30) q")
def icd9vicd9agelimited(ctx):
    return _pair(ctx).join(ctx["age"].filter("age > 30").select("subject_id"), "subject_id", "left_semi").agg(F.count("*").alias("patients"))


BANDS = [(0, 16), (16, 21), (21, 26), (26, 31), (31, 36), (36, 41), (41, 46), (46, 51), (51, 56), (56, 61), (61, 66), (66, 71), (71, 76), (76, 81), (81, 91), (91, 500)]


@concept("cookbook_icd9vagehistogram", ["diagnoses_icd", "age"], f"""
SELECT count(*) AS total, {', '.join(f'count(*) FILTER (WHERE age >= {a} AND age < {b}) AS age_{a}' for a, b in BANDS)}
FROM (SELECT subject_id, min(age) AS age FROM age WHERE subject_id IN (SELECT subject_id FROM diagnoses_icd WHERE icd_code LIKE '401%') GROUP BY 1) q""")
def icd9vagehistogram(ctx):
    having = ctx["diagnoses_icd"].filter(F.col("icd_code").startswith("401")).select("subject_id").distinct()
    ages = ctx["age"].join(having, "subject_id", "left_semi").groupBy("subject_id").agg(F.min("age").alias("age"))
    a = F.col("age")
    return ages.agg(F.count("*").alias("total"), *[F.count_if((a >= lo) & (a < hi)).alias(f"age_{lo}") for lo, hi in BANDS])


@concept("cookbook_icustay_days", ["icustays"], """
WITH g AS (SELECT *, unnest(range(0, date_diff('day', intime, outtime) + 1)) AS day FROM icustays)
SELECT stay_id, day, date_diff('day', intime, outtime) - day AS days_left, greatest(CAST(CAST(intime AS DATE) AS TIMESTAMP) + day * INTERVAL '1' DAY, intime) AS day_start,
       least(CAST(CAST(intime AS DATE) AS TIMESTAMP) + (day + 1) * INTERVAL '1' DAY, outtime) AS day_end FROM g""")
def icustay_days(ctx):
    return day_spine(ctx["icustays"], "intime", "outtime", ["stay_id"])


@concept("cookbook_mortality", ["admissions", "patients", "age"], """
SELECT count(*) AS admissions, round(100.0 * count(deathtime) / count(*), 4) AS hospital, round(100.0 * count(*) FILTER (WHERE dod < admittime + INTERVAL '30' DAY) / count(*), 4) AS day30,
       round(100.0 * count(*) FILTER (WHERE dod < admittime + INTERVAL '365' DAY) / count(*), 4) AS year1
FROM admissions a JOIN patients p ON p.subject_id = a.subject_id WHERE a.hadm_id IN (SELECT hadm_id FROM age WHERE age > 15)""")
def mortality(ctx):
    adm = ctx["admissions"].join(ctx["patients"].select("subject_id", "dod"), "subject_id").join(ctx["age"].filter("age > 15").select("hadm_id"), "hadm_id", "left_semi")
    share = lambda n: F.round(F.lit(100.0) * n / F.count("*"), 4)
    died = lambda k: F.count_if(F.col("dod") < F.col("admittime") + days(k))
    return adm.agg(F.count("*").alias("admissions"), share(F.count("deathtime")).alias("hospital"), share(died(30)).alias("day30"), share(died(365)).alias("year1"))


@concept("cookbook_basic_patient_info", ["patients", "admissions"], "SELECT p.subject_id, p.gender, p.dod, a.hadm_id, a.admittime, a.admission_type FROM patients p JOIN admissions a ON a.subject_id = p.subject_id")
def basic_patient_info(ctx):
    return ctx["patients"].select("subject_id", "gender", "dod").join(ctx["admissions"].select("subject_id", "hadm_id", "admittime", "admission_type"), "subject_id")


@concept("cookbook_number_of_patients", ["admissions"], "SELECT count(*) AS admissions, count(DISTINCT subject_id) AS patients FROM admissions")
def number_of_patients(ctx):
    return ctx["admissions"].agg(F.count("*").alias("admissions"), F.count_distinct("subject_id").alias("patients"))
