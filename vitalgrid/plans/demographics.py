"""Stays, ages, hourly grids and weights."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vitalgrid.functions.dt import dt_diff, hours
from vitalgrid.functions.scalar import num
from vitalgrid.operators.episodes import hourly_spine
from vitalgrid.plans.registry import concept


@concept("age", ["admissions", "patients"], """
SELECT a.subject_id, hadm_id, admittime, anchor_age, anchor_year, anchor_age + year(admittime) - anchor_year AS age
FROM admissions a JOIN patients p ON p.subject_id = a.subject_id""")
def age(ctx):
    j = ctx["admissions"].select("subject_id", "hadm_id", "admittime").join(ctx["patients"].select("subject_id", "anchor_age", "anchor_year"), "subject_id")
    return j.withColumn("age", F.col("anchor_age") + F.year("admittime") - F.col("anchor_year")).withColumn("age", F.col("age").cast("long"))


@concept("icustay_times", ["icustays", "chartevents"], """
SELECT i.subject_id, i.hadm_id, i.stay_id, min(c.charttime) AS intime_hr, max(c.charttime) AS outtime_hr
FROM icustays i LEFT JOIN chartevents c ON c.stay_id = i.stay_id AND c.itemid = 220045 GROUP BY ALL""")
def icustay_times(ctx):
    """First and last heart rate of each stay."""
    seen = ctx["chartevents"].filter("itemid = 220045").groupBy("stay_id").agg(F.min("charttime").alias("intime_hr"), F.max("charttime").alias("outtime_hr"))
    return ctx["icustays"].select("subject_id", "hadm_id", "stay_id").join(seen, "stay_id", "left")


@concept("icustay_hourly", ["icustay_times"], """
SELECT stay_id, unnest(range(-24, date_diff('hour', intime_hr, outtime_hr) + 1)) AS hr,
       CASE WHEN date_trunc('hour', intime_hr) = intime_hr THEN intime_hr ELSE date_trunc('hour', intime_hr) + INTERVAL '1' HOUR END
         + unnest(range(-24, date_diff('hour', intime_hr, outtime_hr) + 1)) * INTERVAL '1' HOUR AS endtime
FROM icustay_times WHERE intime_hr IS NOT NULL""")
def icustay_hourly(ctx):
    return hourly_spine(ctx["icustay_times"], "intime_hr", "outtime_hr", ["stay_id"])


@concept("icustay_detail", ["icustays", "admissions", "patients"], """
SELECT i.subject_id, i.hadm_id, i.stay_id, p.gender, p.dod, a.admittime, a.dischtime, date_diff('day', a.admittime, a.dischtime) AS los_hospital,
       p.anchor_age + year(a.admittime) - p.anchor_year AS admission_age, a.race, a.hospital_expire_flag,
       dense_rank() OVER (PARTITION BY a.subject_id ORDER BY a.admittime) AS hospstay_seq, dense_rank() OVER (PARTITION BY a.subject_id ORDER BY a.admittime) = 1 AS first_hosp_stay,
       i.intime AS icu_intime, i.outtime AS icu_outtime, CAST(round(CAST(date_diff('hour', i.intime, i.outtime) / CAST(24 AS DOUBLE) AS DECIMAL(38,9)), 2) AS DOUBLE) AS los_icu,
       dense_rank() OVER (PARTITION BY i.hadm_id ORDER BY i.intime) AS icustay_seq, dense_rank() OVER (PARTITION BY i.hadm_id ORDER BY i.intime) = 1 AS first_icu_stay
FROM icustays i JOIN admissions a ON a.hadm_id = i.hadm_id JOIN patients p ON p.subject_id = i.subject_id""")
def icustay_detail(ctx):
    adm = ctx["admissions"].select("hadm_id", "admittime", "dischtime", "race", "hospital_expire_flag")
    pat = ctx["patients"].select("subject_id", "gender", "dod", "anchor_age", "anchor_year")
    j = ctx["icustays"].join(adm, "hadm_id").join(pat, "subject_id")
    hosp = F.dense_rank().over(Window.partitionBy("subject_id").orderBy("admittime")).cast("long")
    unit = F.dense_rank().over(Window.partitionBy("hadm_id").orderBy("intime")).cast("long")
    return j.select(
        "subject_id", "hadm_id", "stay_id", "gender", "dod", "admittime", "dischtime", dt_diff(F.col("dischtime"), F.col("admittime"), "DAY").alias("los_hospital"),
        (F.col("anchor_age") + F.year("admittime") - F.col("anchor_year")).cast("long").alias("admission_age"), "race", "hospital_expire_flag",
        hosp.alias("hospstay_seq"), (hosp == 1).alias("first_hosp_stay"), F.col("intime").alias("icu_intime"), F.col("outtime").alias("icu_outtime"),
        num(dt_diff(F.col("outtime"), F.col("intime"), "HOUR") / 24, 2).alias("los_icu"), unit.alias("icustay_seq"), (unit == 1).alias("first_icu_stay"),
    )


@concept("weight_durations", ["icustays", "chartevents"], """
WITH r AS (SELECT stay_id, charttime, CASE itemid WHEN 226512 THEN 'admit' ELSE 'daily' END AS weight_type, CAST(round(CAST(valuenum AS DECIMAL(38,9)), 3) AS DOUBLE) AS weight,
        row_number() OVER (PARTITION BY stay_id, itemid ORDER BY charttime, valuenum) AS n
      FROM chartevents WHERE itemid IN (226512, 224639) AND valuenum > 0 AND valuenum < 1500),
s AS (SELECT i.stay_id, i.intime, i.outtime, weight_type, weight, CASE WHEN weight_type = 'admit' AND n = 1 THEN i.intime - INTERVAL '2' HOUR ELSE charttime END AS starttime
      FROM r JOIN icustays i USING (stay_id)),
t AS (SELECT *, coalesce(lead(starttime) OVER w, outtime + INTERVAL '2' HOUR) AS endtime, row_number() OVER w AS k FROM s
      WINDOW w AS (PARTITION BY stay_id ORDER BY starttime, weight_type, weight))
SELECT stay_id, starttime, endtime, weight, weight_type FROM t
UNION ALL SELECT stay_id, intime - INTERVAL '2' HOUR, starttime, weight, weight_type FROM t WHERE k = 1 AND intime < starttime""")
def weight_durations(ctx):
    """Weights as a step function: each holds until the next; the first also reaches back to admission."""
    kind = F.when(F.col("itemid") == 226512, "admit").otherwise("daily")
    rows = ctx["chartevents"].filter(F.col("itemid").isin(226512, 224639) & (F.col("valuenum") > 0) & (F.col("valuenum") < 1500))
    rows = rows.select("stay_id", "charttime", kind.alias("weight_type"), num(F.col("valuenum"), 3).alias("weight"))
    first = F.row_number().over(Window.partitionBy("stay_id", "weight_type").orderBy("charttime", "weight")) == 1
    early = F.col("intime") - hours(2)
    started = rows.withColumn("first", first).join(ctx["icustays"].select("stay_id", "intime", "outtime"), "stay_id").withColumn(
        "starttime", F.when(F.col("first") & (F.col("weight_type") == "admit"), early).otherwise(F.col("charttime"))
    )
    w = Window.partitionBy("stay_id").orderBy("starttime", "weight_type", "weight")
    steps = started.withColumns({"endtime": F.coalesce(F.lead("starttime").over(w), F.col("outtime") + hours(2)), "k": F.row_number().over(w)})
    out = ["stay_id", "starttime", "endtime", "weight", "weight_type"]
    head = steps.filter((F.col("k") == 1) & (F.col("intime") < F.col("starttime"))).select(
        "stay_id", early.alias("starttime"), F.col("starttime").alias("endtime"), "weight", "weight_type"
    )
    return steps.select(*out).unionByName(head)
