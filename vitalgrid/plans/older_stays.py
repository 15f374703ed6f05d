"""Stays of the older generation: times, grids, weights, ventilation, notes, codes and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.dt import dt_diff, hours
from vitalgrid.functions.scalar import contains_any, extract, num
from vitalgrid.operators.episodes import hourly_spine
from vitalgrid.operators.joins import interval_join
from vitalgrid.plans.older_measurement import STAY, admission_windows, windows_sql
from vitalgrid.plans.registry import concept


def _in(codes) -> str:
    return ", ".join(f"'{c}'" if isinstance(c, str) else str(c) for c in codes)


@concept("older_icustay_times", ["older_icustays", "older_chartevents", "older_admissions"], f"""
WITH a AS ({windows_sql('older_admissions', 'hadm_id', 'admittime', 'dischtime')}),
t AS (SELECT c.icustay_id, min(charttime) AS intime_hr, max(charttime) AS outtime_hr FROM older_chartevents c JOIN a ON a.hadm_id = c.hadm_id AND c.charttime >= a.data_start AND c.charttime < a.data_end WHERE itemid IN (211, 220045) GROUP BY 1)
SELECT i.subject_id, i.hadm_id, i.icustay_id, intime_hr, outtime_hr FROM older_icustays i LEFT JOIN t ON t.icustay_id = i.icustay_id""")
def older_icustay_times(ctx):
    """First and last heart rate of each stay, inside its admission's window."""
    pulse = ctx["older_chartevents"].filter(F.col("itemid").isin(211, 220045)).select("hadm_id", "icustay_id", "charttime")
    inside = interval_join(pulse, admission_windows(ctx).drop("subject_id"), ["hadm_id"], "charttime", "data_start", "data_end", closed="left")
    seen = inside.groupBy("icustay_id").agg(F.min("charttime").alias("intime_hr"), F.max("charttime").alias("outtime_hr"))
    return ctx["older_icustays"].select(*STAY).join(seen, "icustay_id", "left")


@concept("icustay_hours", ["older_icustay_times"], """
SELECT icustay_id, unnest(range(-24, date_diff('hour', intime_hr, outtime_hr) + 1)) AS hr, CASE WHEN date_trunc('hour', intime_hr) = intime_hr THEN intime_hr ELSE date_trunc('hour', intime_hr) + INTERVAL '1' HOUR END
  + unnest(range(-24, date_diff('hour', intime_hr, outtime_hr) + 1)) * INTERVAL '1' HOUR AS endtime FROM older_icustay_times WHERE intime_hr IS NOT NULL""")
def icustay_hours(ctx):
    return hourly_spine(ctx["older_icustay_times"], "intime_hr", "outtime_hr", ["icustay_id"])


# Groups of the recorded ethnicities.
ETHNICITY = {
    "white": ["WHITE", "WHITE - RUSSIAN", "WHITE - OTHER EUROPEAN", "WHITE - BRAZILIAN", "WHITE - EASTERN EUROPEAN"],
    "black": ["BLACK/AFRICAN AMERICAN", "BLACK/CAPE VERDEAN", "BLACK/HAITIAN", "BLACK/AFRICAN", "CARIBBEAN ISLAND"],
    "hispanic": [
        "HISPANIC OR LATINO", "HISPANIC/LATINO - PUERTO RICAN", "HISPANIC/LATINO - DOMINICAN", "HISPANIC/LATINO - GUATEMALAN", "HISPANIC/LATINO - CUBAN", "HISPANIC/LATINO - SALVADORAN",
        "HISPANIC/LATINO - CENTRAL AMERICAN (OTHER)", "HISPANIC/LATINO - MEXICAN", "HISPANIC/LATINO - COLOMBIAN", "HISPANIC/LATINO - HONDURAN",
    ],
    "asian": ["ASIAN", "ASIAN - CHINESE", "ASIAN - ASIAN INDIAN", "ASIAN - VIETNAMESE", "ASIAN - FILIPINO", "ASIAN - CAMBODIAN", "ASIAN - OTHER", "ASIAN - KOREAN", "ASIAN - JAPANESE", "ASIAN - THAI"],
    "native": ["AMERICAN INDIAN/ALASKA NATIVE", "AMERICAN INDIAN/ALASKA NATIVE FEDERALLY RECOGNIZED TRIBE"], "unknown": ["UNKNOWN/NOT SPECIFIED", "UNABLE TO OBTAIN", "PATIENT DECLINED TO ANSWER"],
}


@concept("older_icustay_detail", ["older_icustays", "older_admissions", "older_patients"], f"""
SELECT i.subject_id, i.hadm_id, i.icustay_id, gender, dod, admittime, dischtime, date_diff('day', admittime, dischtime) AS los_hospital, date_diff('year', dob, intime) AS admission_age, ethnicity,
  CASE {' '.join(f"WHEN ethnicity IN ({_in(v)}) THEN '{k}'" for k, v in ETHNICITY.items())} ELSE 'other' END AS ethnicity_grouped, hospital_expire_flag,
  dense_rank() OVER (PARTITION BY a.subject_id ORDER BY admittime) AS hospstay_seq, dense_rank() OVER (PARTITION BY a.subject_id ORDER BY admittime) = 1 AS first_hosp_stay, intime, outtime, date_diff('day', intime, outtime) AS los_icu,
  dense_rank() OVER (PARTITION BY i.hadm_id ORDER BY intime) AS icustay_seq, dense_rank() OVER (PARTITION BY i.hadm_id ORDER BY intime) = 1 AS first_icu_stay
FROM older_icustays i JOIN older_admissions a ON a.hadm_id = i.hadm_id JOIN older_patients p ON p.subject_id = i.subject_id WHERE has_chartevents_data = 1""")
def older_icustay_detail(ctx):
    adm = ctx["older_admissions"].filter("has_chartevents_data = 1").drop("subject_id", "has_chartevents_data")
    j = ctx["older_icustays"].join(adm, "hadm_id").join(ctx["older_patients"], "subject_id")
    group = F.lit("other")
    for name, values in ETHNICITY.items():
        group = F.when(F.col("ethnicity").isin(values), name).otherwise(group)
    hosp = F.dense_rank().over(Window.partitionBy("subject_id").orderBy("admittime")).cast("long")
    unit = F.dense_rank().over(Window.partitionBy("hadm_id").orderBy("intime")).cast("long")
    return j.select(
        *STAY, "gender", "dod", "admittime", "dischtime", dt_diff(F.col("dischtime"), F.col("admittime"), "DAY").alias("los_hospital"), dt_diff(F.col("intime"), F.col("dob"), "YEAR").alias("admission_age"), "ethnicity",
        group.alias("ethnicity_grouped"), "hospital_expire_flag", hosp.alias("hospstay_seq"), (hosp == 1).alias("first_hosp_stay"), "intime", "outtime",
        dt_diff(F.col("outtime"), F.col("intime"), "DAY").alias("los_icu"), unit.alias("icustay_seq"), (unit == 1).alias("first_icu_stay"),
    )


ECHO_NUMBERS = {"height": r"Height: \(in\) ([0-9]+)", "weight": r"Weight \(lb\): ([0-9]+)\n", "bsa": r"BSA \(m2\): ([0-9]+) m2\n", "bpsys": r"BP \(mm Hg\): ([0-9]+)/[0-9]+?\n", "bpdias": r"BP \(mm Hg\): [0-9]+/([0-9]+?)\n", "hr": r"HR \(bpm\): ([0-9]+?)\n"}
ECHO_TEXTS = {"indication": "Indication", "status": "Status", "test": "Test", "doppler": "Doppler", "contrast": "Contrast", "technicalquality": "Technical Quality"}


@concept("echo_data", ["noteevents"], f"""
SELECT row_id, subject_id, hadm_id, chartdate, chartdate + CAST(regexp_extract(text, 'Date/Time: .+? at ([0-9]+):[0-9]{{2}}', 1) AS BIGINT) * INTERVAL '1' HOUR + CAST(regexp_extract(text, 'Date/Time: .+? at [0-9]+:([0-9]{{2}})', 1) AS BIGINT) * INTERVAL '1' MINUTE AS charttime,
 {', '.join(f"nullif(regexp_extract(text, '{t}: (.*?)' || chr(10), 1), '') AS {c}" for c, t in ECHO_TEXTS.items())}, nullif(regexp_extract(text, 'BP \\(mm Hg\\): (.+)' || chr(10), 1), '') AS bp,
 {', '.join(f"TRY_CAST(nullif(regexp_extract(text, '{p[:-2] if p.endswith(chr(92) + 'n') else p}'{' || chr(10)' if p.endswith(chr(92) + 'n') else ''}, 1), '') AS DOUBLE) AS {c}" for c, p in ECHO_NUMBERS.items())}
FROM noteevents WHERE category = 'Echo'""")
def echo_data(ctx):
    """Measurements and time from the headers of echo reports."""
    notes, t = ctx["noteevents"].filter("category = 'Echo'"), F.col("text")
    part = lambda pattern: extract(t, pattern).cast("int")
    at = F.col("chartdate") + F.make_dt_interval(hours=part(r"Date/Time: .+? at ([0-9]+):[0-9]{2}"), mins=part(r"Date/Time: .+? at [0-9]+:([0-9]{2})"))
    return notes.select(
        "row_id", "subject_id", "hadm_id", "chartdate", at.alias("charttime"), *[extract(t, rf"{name}: (.*?)\n").alias(c) for c, name in ECHO_TEXTS.items()], extract(t, r"BP \(mm Hg\): (.+)\n").alias("bp"),
        *[extract(t, p).try_cast("double").alias(c) for c, p in ECHO_NUMBERS.items()],
    )


_SURE = "coalesce(error, 0) = 0"


@concept("older_weight_durations", ["older_icustays", "older_chartevents", "echo_data"], f"""
WITH c AS (SELECT * FROM older_chartevents WHERE icustay_id IS NOT NULL AND {_SURE}),
n AS (SELECT icustay_id, charttime, max(CASE WHEN itemid = 3580 THEN valuenum END) AS kg, max(CASE WHEN itemid = 3581 THEN valuenum END) AS lb, max(CASE WHEN itemid = 3582 THEN valuenum END) AS oz FROM c WHERE itemid IN (3580, 3581, 3582) AND valuenum > 0 GROUP BY 1, 2),
b AS (SELECT icustay_id, charttime, max(CASE WHEN itemid = 4183 THEN CASE WHEN regexp_matches(value, '[^0-9\\.]') THEN NULL WHEN TRY_CAST(value AS DOUBLE) > 100 THEN TRY_CAST(value AS DOUBLE) / 1000 WHEN TRY_CAST(value AS DOUBLE) < 10 THEN TRY_CAST(value AS DOUBLE) END
  WHEN itemid = 3723 AND valuenum < 10 THEN valuenum END) AS kg FROM c WHERE itemid IN (3723, 4183) GROUP BY 1, 2),
w AS (SELECT icustay_id, charttime, CASE WHEN itemid IN (762, 226512) THEN 'admit' ELSE 'daily' END AS kind, valuenum AS weight FROM c WHERE itemid IN (762, 226512, 763, 224639) AND valuenum > 0
  UNION ALL SELECT icustay_id, charttime, 'daily', coalesce(kg, lb * CAST(0.45359237 AS DOUBLE) + oz * CAST(0.0283495231 AS DOUBLE)) FROM n UNION ALL SELECT icustay_id, charttime, 'admit', kg FROM b),
a AS (SELECT * FROM w UNION ALL SELECT i.icustay_id, e.charttime, 'echo', CAST(0.453592 AS DOUBLE) * e.weight FROM older_icustays i JOIN echo_data e ON e.hadm_id = i.hadm_id WHERE e.weight IS NOT NULL AND i.icustay_id NOT IN (SELECT DISTINCT icustay_id FROM w)),
r AS (SELECT *, row_number() OVER (PARTITION BY icustay_id, kind ORDER BY charttime, weight) AS n FROM a WHERE weight IS NOT NULL),
s AS (SELECT r.icustay_id, i.intime, i.outtime, CASE WHEN kind = 'admit' AND n = 1 THEN i.intime - INTERVAL '2' HOUR ELSE charttime END AS starttime, weight FROM r JOIN older_icustays i ON i.icustay_id = r.icustay_id),
d AS (SELECT icustay_id, intime, starttime, coalesce(lead(starttime) OVER v, greatest(outtime, starttime) + INTERVAL '2' HOUR) AS endtime, weight, row_number() OVER v AS n FROM s WINDOW v AS (PARTITION BY icustay_id ORDER BY starttime, weight))
SELECT icustay_id, starttime, endtime, weight FROM d UNION ALL SELECT icustay_id, intime - INTERVAL '2' HOUR, starttime, weight FROM d WHERE n = 1 AND intime < starttime""")
def older_weight_durations(ctx):
    """Each weight until the next one; the first also counts from before the stay, and echo reports only for stays without any other."""
    c = ctx["older_chartevents"].filter("icustay_id IS NOT NULL").filter(_SURE)
    when = lambda code, v: F.max(F.when(F.col("itemid") == code, v))
    v = F.col("valuenum")
    infant = c.filter(F.col("itemid").isin(3580, 3581, 3582) & (v > 0)).groupBy("icustay_id", "charttime").agg(when(3580, v).alias("kg"), when(3581, v).alias("lb"), when(3582, v).alias("oz"))
    infant = infant.select("icustay_id", "charttime", F.lit("daily").alias("kind"), F.coalesce("kg", F.col("lb") * 0.45359237 + F.col("oz") * 0.0283495231).alias("weight"))
    given = F.col("value").try_cast("double")
    written = F.when(F.col("value").rlike(r"[^0-9\.]"), None).when(given > 100, given / 1000).when(given < 10, given)
    birth = c.filter(F.col("itemid").isin(3723, 4183)).groupBy("icustay_id", "charttime").agg(
        F.max(F.when(F.col("itemid") == 4183, written).when((F.col("itemid") == 3723) & (v < 10), v)).alias("weight")
    ).select("icustay_id", "charttime", F.lit("admit").alias("kind"), "weight")
    adult = c.filter(F.col("itemid").isin(762, 226512, 763, 224639) & (v > 0)).select(
        "icustay_id", "charttime", F.when(F.col("itemid").isin(762, 226512), "admit").otherwise("daily").alias("kind"), v.alias("weight")
    )
    all_ = adult.unionByName(infant).unionByName(birth)
    stays = ctx["older_icustays"].select("hadm_id", "icustay_id", "intime", "outtime")
    without = stays.join(all_.select("icustay_id").distinct(), "icustay_id", "left_anti")
    echo = ctx["echo_data"].filter("weight IS NOT NULL").select("hadm_id", "charttime", (0.453592 * F.col("weight")).alias("weight"))
    all_ = all_.unionByName(without.join(echo, "hadm_id").select("icustay_id", "charttime", F.lit("echo").alias("kind"), "weight")).filter("weight IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy("icustay_id", "kind").orderBy("charttime", "weight"))
    s = all_.withColumn("n", rank).join(stays, "icustay_id")
    s = s.withColumn("starttime", F.when((F.col("kind") == "admit") & (F.col("n") == 1), F.col("intime") - hours(2)).otherwise(F.col("charttime")))
    w = Window.partitionBy("icustay_id").orderBy("starttime", "weight")
    d = s.withColumns({"endtime": F.coalesce(F.lead("starttime").over(w), F.greatest("outtime", "starttime") + hours(2)), "n": F.row_number().over(w)})
    early = d.filter("n = 1 AND intime < starttime").select("icustay_id", (F.col("intime") - hours(2)).alias("starttime"), F.col("starttime").alias("endtime"), "weight")
    return d.select("icustay_id", "starttime", "endtime", "weight").unionByName(early)


INCHES, CENTIMETRES = [920, 1394, 4187, 3486], [3485, 4188]


@concept("heightweight", ["older_icustays", "older_chartevents", "older_patients", "older_weight_durations"], f"""
WITH h0 AS (SELECT c.icustay_id, charttime, charttime <= dob + INTERVAL '1' YEAR AS infant, CASE WHEN itemid IN ({_in(INCHES)}, 226707) THEN valuenum * CAST(2.54 AS DOUBLE) ELSE valuenum END AS h
  FROM older_chartevents c JOIN older_patients p ON p.subject_id = c.subject_id WHERE valuenum IS NOT NULL AND valuenum <> 0 AND {_SURE} AND itemid IN ({_in(INCHES + CENTIMETRES)}, 226707)),
h1 AS (SELECT icustay_id, charttime, CASE WHEN infant AND h < 80 THEN h WHEN NOT infant AND h > 120 AND h < 230 THEN h END AS h FROM h0),
h2 AS (SELECT *, row_number() OVER (PARTITION BY icustay_id ORDER BY charttime, h) AS n FROM h1), w2 AS (SELECT *, row_number() OVER (PARTITION BY icustay_id ORDER BY starttime, endtime, weight) AS n FROM older_weight_durations),
h AS (SELECT icustay_id, min(CASE WHEN n = 1 THEN h END) AS hf, min(h) AS hl, max(h) AS hm FROM h2 GROUP BY 1), w AS (SELECT icustay_id, min(CASE WHEN n = 1 THEN weight END) AS wf, min(weight) AS wl, max(weight) AS wm FROM w2 GROUP BY 1)
SELECT i.icustay_id, {', '.join(f"CAST(round(CAST({x} AS DECIMAL(38,9)), 2) AS DOUBLE) AS {n}" for x, n in (('wf', 'weight_first'), ('wl', 'weight_min'), ('wm', 'weight_max'), ('hf', 'height_first'), ('hl', 'height_min'), ('hm', 'height_max')))}
FROM older_icustays i LEFT JOIN w ON w.icustay_id = i.icustay_id LEFT JOIN h ON h.icustay_id = i.icustay_id""")
def heightweight(ctx):
    """First, smallest and largest plausible weight and height of each stay."""
    rows = ctx["older_chartevents"].filter(F.col("itemid").isin([*INCHES, *CENTIMETRES, 226707])).filter(f"valuenum IS NOT NULL AND valuenum <> 0 AND {_SURE}")
    rows = rows.join(ctx["older_patients"].select("subject_id", "dob"), "subject_id")
    h, infant = F.when(F.col("itemid").isin([*INCHES, 226707]), F.col("valuenum") * 2.54).otherwise(F.col("valuenum")), F.col("charttime") <= F.col("dob") + F.expr("INTERVAL '1' YEAR")
    heights = rows.select("icustay_id", "charttime", F.when(infant & (h < 80), h).when(~infant & (h > 120) & (h < 230), h).alias("height"))

    def three(df: DataFrame, value: str, order: list) -> DataFrame:
        ranked = df.withColumn("n", F.row_number().over(Window.partitionBy("icustay_id").orderBy(*order)))
        return ranked.groupBy("icustay_id").agg(num(F.min(F.when(F.col("n") == 1, F.col(value))), 2).alias(f"{value}_first"), num(F.min(value), 2).alias(f"{value}_min"), num(F.max(value), 2).alias(f"{value}_max"))

    weight = three(ctx["older_weight_durations"], "weight", ["starttime", "endtime", "weight"])
    height = three(heights, "height", ["charttime", F.col("height").asc_nulls_last()])
    return ctx["older_icustays"].select("icustay_id").join(weight, "icustay_id", "left").join(height, "icustay_id", "left")


# Readings and texts that show mechanical ventilation, oxygen therapy and extubation.
SETTINGS = [
    445, 448, 449, 450, 1340, 1486, 1600, 224687, 639, 654, 681, 682, 683, 684, 224685, 224684, 224686, 218, 436, 535, 444, 224697, 224695, 224696, 224746, 224747, 221, 1, 1211, 1655, 2000, 226873, 224738, 224419, 224750,
    227187, 543, 5865, 5866, 224707, 224709, 224705, 224706, 60, 437, 505, 506, 686, 220339, 224700, 3459, 501, 502, 503, 224702, 223, 667, 668, 669, 670, 671, 672, 224701,
]
OXYGEN_READINGS = [468, 469, 470, 471, 227287, 223834]
OXYGEN_NEW = ["Nasal cannula", "Face tent", "Aerosol-cool", "Trach mask ", "High flow neb", "Non-rebreather", "Venti mask ", "Medium conc mask ", "T-piece", "High flow nasal cannula", "Ultrasonic neb", "Vapomist"]
OXYGEN_OLD = [
    "Cannula", "Nasal Cannula", "Face Tent", "Aerosol-Cool", "Trach Mask", "Hi Flow Neb", "Non-Rebreather", "Venti Mask", "Medium Conc Mask", "Vapotherm", "T-Piece", "Hood", "Hut", "TranstrachealCat", "Heated Neb", "Ultrasonic Neb",
]
EXTUBATIONS = [227194, 225468, 225477]


@concept("ventilation_classification", ["older_chartevents", "procedureevents_mv"], f"""
SELECT icustay_id, charttime, max(CASE WHEN (itemid = 720 AND value <> 'Other/Remarks') OR (itemid = 223848 AND value <> 'Other') OR itemid = 223849 OR (itemid = 467 AND value = 'Ventilator') OR itemid IN ({_in(SETTINGS)}) THEN 1 ELSE 0 END) AS mechvent,
 max(CASE WHEN (itemid = 226732 AND value IN ({_in(OXYGEN_NEW)})) OR (itemid = 467 AND value IN ({_in(OXYGEN_OLD)})) THEN 1 ELSE 0 END) AS oxygentherapy,
 max(CASE WHEN itemid = 640 AND value IN ('Extubated', 'Self Extubation') THEN 1 ELSE 0 END) AS extubated, max(CASE WHEN itemid = 640 AND value = 'Self Extubation' THEN 1 ELSE 0 END) AS selfextubated
FROM older_chartevents WHERE value IS NOT NULL AND (error <> 1 OR error IS NULL) AND itemid IN ({_in(SETTINGS + OXYGEN_READINGS)}, 720, 223848, 223849, 467, 640, 226732) GROUP BY icustay_id, charttime
UNION SELECT icustay_id, starttime, 0, 0, 1, CASE WHEN itemid = 225468 THEN 1 ELSE 0 END FROM procedureevents_mv WHERE itemid IN ({_in(EXTUBATIONS)})""")
def ventilation_classification(ctx):
    code, value = F.col("itemid"), F.col("value")
    rows = ctx["older_chartevents"].filter(code.isin([*SETTINGS, *OXYGEN_READINGS, 720, 223848, 223849, 467, 640, 226732])).filter("value IS NOT NULL AND (error <> 1 OR error IS NULL)")
    machine = ((code == 720) & (value != "Other/Remarks")) | ((code == 223848) & (value != "Other")) | (code == 223849) | ((code == 467) & (value == "Ventilator")) | code.isin(SETTINGS)
    oxygen = ((code == 226732) & value.isin(OXYGEN_NEW)) | ((code == 467) & value.isin(OXYGEN_OLD))
    out = (code == 640) & value.isin("Extubated", "Self Extubation")
    flag = lambda c: F.max(c.cast("int"))
    charted = rows.groupBy("icustay_id", "charttime").agg(flag(machine).alias("mechvent"), flag(oxygen).alias("oxygentherapy"), flag(out).alias("extubated"), flag((code == 640) & (value == "Self Extubation")).alias("selfextubated"))
    done = ctx["procedureevents_mv"].filter(code.isin(EXTUBATIONS)).select(
        "icustay_id", F.col("starttime").alias("charttime"), F.lit(0).alias("mechvent"), F.lit(0).alias("oxygentherapy"), F.lit(1).alias("extubated"), (code == 225468).cast("int").alias("selfextubated")
    )
    return charted.unionByName(done).distinct()


@concept("ventilation_durations", ["ventilation_classification"], """
WITH a AS (SELECT *, CASE WHEN mechvent = 1 THEN lag(charttime) OVER (PARTITION BY icustay_id, mechvent ORDER BY charttime) END AS before FROM ventilation_classification),
b AS (SELECT *, CASE WHEN lag(extubated) OVER (PARTITION BY icustay_id, CASE WHEN mechvent = 1 OR extubated = 1 THEN 1 ELSE 0 END ORDER BY charttime, extubated, selfextubated) = 1 THEN 1 WHEN mechvent = 0 AND oxygentherapy = 1 THEN 1
  WHEN charttime > before + INTERVAL '8' HOUR THEN 1 ELSE 0 END AS new FROM a),
c AS (SELECT *, CASE WHEN mechvent = 1 OR extubated = 1 THEN sum(new) OVER (PARTITION BY icustay_id ORDER BY charttime) END AS k FROM b),
d AS (SELECT icustay_id, k, min(charttime) AS starttime, max(charttime) AS endtime FROM c GROUP BY 1, 2 HAVING min(charttime) <> max(charttime) AND max(mechvent) = 1)
SELECT icustay_id, row_number() OVER (PARTITION BY icustay_id ORDER BY k) AS ventnum, starttime, endtime, date_diff('minute', starttime, endtime) / CAST(60 AS DOUBLE) AS duration_hours FROM d""")
def ventilation_durations(ctx):
    """Ventilation episodes: a new one after an extubation, oxygen therapy, or eight hours without a ventilator reading.

    The row before is looked up among rows of the same kind only (ventilated, or ventilated and extubated ones).
    """
    v = ctx["ventilation_classification"]
    on, of_note = F.col("mechvent") == 1, ((F.col("mechvent") == 1) | (F.col("extubated") == 1)).cast("int")
    v = v.withColumn("before", F.when(on, F.lag("charttime").over(Window.partitionBy("icustay_id", "mechvent").orderBy("charttime"))))
    out = F.lag("extubated").over(Window.partitionBy("icustay_id", "note").orderBy("charttime", "extubated", "selfextubated"))
    new = F.when(out == 1, 1).when(~on & (F.col("oxygentherapy") == 1), 1).when(F.col("charttime") > F.col("before") + hours(8), 1).otherwise(0)
    v = v.withColumn("note", of_note).withColumn("new", new)
    k = F.sum("new").over(Window.partitionBy("icustay_id").orderBy("charttime").rangeBetween(Window.unboundedPreceding, 0))
    d = v.withColumn("k", F.when(F.col("note") == 1, k)).groupBy("icustay_id", "k").agg(F.min("charttime").alias("starttime"), F.max("charttime").alias("endtime"), F.max("mechvent").alias("top"))
    d = d.filter("starttime <> endtime AND top = 1")
    number = F.row_number().over(Window.partitionBy("icustay_id").orderBy("k")).cast("long")
    return d.select("icustay_id", number.alias("ventnum"), "starttime", "endtime", (dt_diff(F.col("endtime"), F.col("starttime"), "MINUTE") / 60).alias("duration_hours"))


@concept("ventilation_first_day", ["older_icustays", "ventilation_durations"], """
SELECT i.subject_id, i.hadm_id, i.icustay_id, max(CASE WHEN v.icustay_id IS NOT NULL THEN 1 ELSE 0 END) AS vent FROM older_icustays i LEFT JOIN ventilation_durations v ON v.icustay_id = i.icustay_id
 AND ((v.starttime <= i.intime AND v.endtime >= i.intime) OR (v.starttime >= i.intime AND v.starttime <= i.intime + INTERVAL '1' DAY)) GROUP BY ALL""")
def ventilation_first_day(ctx):
    stays, v = ctx["older_icustays"], ctx["ventilation_durations"].select(F.col("icustay_id").alias("_i"), "starttime", "endtime")
    s = F.col("intime")
    near = ((F.col("starttime") <= s) & (F.col("endtime") >= s)) | ((F.col("starttime") >= s) & (F.col("starttime") <= s + hours(24)))
    return stays.join(v, (F.col("icustay_id") == F.col("_i")) & near, "left").groupBy(*STAY).agg(F.max(F.col("_i").isNotNull().cast("int")).alias("vent"))


_AGE_1 = "i.intime > p.dob + INTERVAL '1' YEAR"


def _grown(ctx) -> DataFrame:
    return ctx["older_icustays"].join(ctx["older_patients"].select("subject_id", "dob"), "subject_id").filter(F.col("intime") > F.col("dob") + F.expr("INTERVAL '1' YEAR"))


def _around(ctx, codes: list[int]) -> DataFrame:
    """Readings from a day before to a day after the stay began."""
    rows = ctx["older_chartevents"].filter(F.col("itemid").isin(codes)).filter("valuenum IS NOT NULL AND valuenum <> 0 AND (error IS NULL OR error = 0)")
    stays = ctx["older_icustays"].select("icustay_id", (F.col("intime") - hours(24)).alias("_s"), (F.col("intime") + hours(24)).alias("_e"))
    return interval_join(rows.select("icustay_id", "charttime", "itemid", "valuenum"), stays, ["icustay_id"], "charttime", "_s", "_e", closed="right")


_AROUND = "older_chartevents c JOIN older_icustays i ON i.icustay_id = c.icustay_id AND c.charttime <= i.intime + INTERVAL '1' DAY AND c.charttime > i.intime - INTERVAL '1' DAY WHERE valuenum IS NOT NULL AND valuenum <> 0 AND (error IS NULL OR error = 0)"


@concept("weight_first_day", ["older_icustays", "older_patients", "older_chartevents", "echo_data"], f"""
WITH a AS (SELECT c.icustay_id, avg(valuenum) FILTER (WHERE itemid IN (762, 226512)) AS wa, avg(valuenum) FILTER (WHERE itemid IN (763, 224639)) AS wd FROM {_AROUND} AND itemid IN (762, 226512, 763, 224639) GROUP BY 1),
e AS (SELECT i.icustay_id, CAST(0.453592 AS DOUBLE) * avg(weight) AS w FROM echo_data e JOIN older_icustays i ON i.hadm_id = e.hadm_id AND e.charttime < i.intime + INTERVAL '1' DAY WHERE weight IS NOT NULL GROUP BY 1),
n AS (SELECT i.icustay_id, CAST(0.453592 AS DOUBLE) * avg(weight) AS w FROM echo_data e JOIN older_icustays i ON i.subject_id = e.subject_id AND i.intime < e.charttime + INTERVAL '1' MONTH AND i.intime > e.charttime WHERE e.hadm_id IS NULL AND weight IS NOT NULL GROUP BY 1)
SELECT i.icustay_id, CAST(round(CAST(coalesce(wa, wd, e.w, n.w) AS DECIMAL(38,9)), 2) AS DOUBLE) AS weight, wa AS weight_admit, wd AS weight_daily, e.w AS weight_echoinhosp, n.w AS weight_echoprehosp
FROM older_icustays i JOIN older_patients p ON p.subject_id = i.subject_id AND {_AGE_1} LEFT JOIN a ON a.icustay_id = i.icustay_id LEFT JOIN e ON e.icustay_id = i.icustay_id LEFT JOIN n ON n.icustay_id = i.icustay_id""")
def weight_first_day(ctx):
    """Weight at admission, else of the day, else of an echo report in this or shortly before the admission."""
    code = F.col("itemid")
    near = _around(ctx, [762, 226512, 763, 224639]).groupBy("icustay_id").agg(
        F.avg(F.when(code.isin(762, 226512), F.col("valuenum"))).alias("weight_admit"), F.avg(F.when(code.isin(763, 224639), F.col("valuenum"))).alias("weight_daily")
    )
    echo, stays = ctx["echo_data"].filter("weight IS NOT NULL").select("subject_id", "hadm_id", "charttime", "weight"), ctx["older_icustays"].select(*STAY, "intime")
    mean = 0.453592 * F.avg("weight")
    inside = stays.join(echo.drop("subject_id"), "hadm_id").filter(F.col("charttime") < F.col("intime") + hours(24)).groupBy("icustay_id").agg(mean.alias("weight_echoinhosp"))
    before = stays.drop("hadm_id").join(echo.filter("hadm_id IS NULL").drop("hadm_id"), "subject_id")
    before = before.filter((F.col("intime") < F.col("charttime") + F.expr("INTERVAL '1' MONTH")) & (F.col("intime") > F.col("charttime"))).groupBy("icustay_id").agg(mean.alias("weight_echoprehosp"))
    j = _grown(ctx).select("icustay_id")
    for side in (near, inside, before):
        j = j.join(side, "icustay_id", "left")
    return j.withColumn("weight", num(F.coalesce("weight_admit", "weight_daily", "weight_echoinhosp", "weight_echoprehosp"), 2))


@concept("height_first_day", ["older_icustays", "older_patients", "older_chartevents", "echo_data"], f"""
WITH a AS (SELECT c.icustay_id, CASE WHEN itemid IN ({_in(INCHES)}) THEN valuenum * CAST(2.54 AS DOUBLE) ELSE valuenum END AS h FROM {_AROUND} AND itemid IN ({_in(INCHES + CENTIMETRES)}, 226730)),
c AS (SELECT icustay_id, CAST(round(CAST(avg(h) AS DECIMAL(38,9)), 6) AS DOUBLE) AS height_chart FROM a WHERE h > 100 GROUP BY 1),
e AS (SELECT e.subject_id, CAST(2.54 AS DOUBLE) * avg(height) AS height_echo FROM echo_data e JOIN older_icustays i ON i.subject_id = e.subject_id AND e.charttime < i.intime + INTERVAL '1' DAY WHERE height IS NOT NULL AND height * CAST(2.54 AS DOUBLE) > 100 GROUP BY 1)
SELECT i.icustay_id, coalesce(height_chart, height_echo) AS height, height_chart, height_echo FROM older_icustays i JOIN older_patients p ON p.subject_id = i.subject_id AND {_AGE_1} LEFT JOIN c ON c.icustay_id = i.icustay_id LEFT JOIN e ON e.subject_id = i.subject_id""")
def height_first_day(ctx):
    h = F.when(F.col("itemid").isin(INCHES), F.col("valuenum") * 2.54).otherwise(F.col("valuenum"))
    chart = _around(ctx, [*INCHES, *CENTIMETRES, 226730]).withColumn("h", h).filter("h > 100").groupBy("icustay_id").agg(num(F.avg("h"), 6).alias("height_chart"))
    echo = ctx["echo_data"].filter("height * 2.54D > 100").select("subject_id", "charttime", "height")
    seen = ctx["older_icustays"].select("subject_id", "intime").join(echo, "subject_id").filter(F.col("charttime") < F.col("intime") + hours(24))
    seen = seen.groupBy("subject_id").agg((2.54 * F.avg("height")).alias("height_echo"))
    j = _grown(ctx).select("subject_id", "icustay_id").join(chart, "icustay_id", "left").join(seen, "subject_id", "left")
    return j.select("icustay_id", F.coalesce("height_chart", "height_echo").alias("height"), "height_chart", "height_echo")


# Texts of the code status.
STATUS = {
    "fullcode": ["Full Code", "Full code"], "cmo": ["Comfort Measures", "Comfort measures only"], "dnr": ["Do Not Resuscita", "DNR (do not resuscitate)", "DNR / DNI"], "dni": ["Do Not Intubate", "DNI (do not intubate)", "DNR / DNI"],
    "dncpr": ["CPR Not Indicate"],
}
_FIRST = {"dnr_first_charttime": "dnr", "dni_first_charttime": "dni", "dncpr_first_charttime": "dncpr", "timecmo_chart": "cmo"}


@concept("older_code_status", ["older_icustays", "older_chartevents"], f"""
WITH t AS (SELECT icustay_id, charttime, row_number() OVER (PARTITION BY icustay_id ORDER BY charttime, value) AS a, row_number() OVER (PARTITION BY icustay_id ORDER BY charttime DESC, value DESC) AS z, {', '.join(f"CASE WHEN value IN ({_in(v)}) THEN 1 ELSE 0 END AS {k}" for k, v in STATUS.items())}
  FROM older_chartevents WHERE itemid IN (128, 223758) AND value IS NOT NULL AND value <> 'Other/Remarks' AND (error IS NULL OR error = 0))
SELECT i.subject_id, i.hadm_id, i.icustay_id, {', '.join(f"max(CASE WHEN a = 1 THEN {k} END) AS {k}_first, max(CASE WHEN z = 1 THEN {k} END) AS {k}_last, max({k}) AS {k}" for k in STATUS)}, {', '.join(f"min(CASE WHEN {k} = 1 THEN charttime END) AS {c}" for c, k in _FIRST.items())}
FROM older_icustays i LEFT JOIN t ON t.icustay_id = i.icustay_id GROUP BY i.subject_id, i.hadm_id, i.icustay_id""")
def older_code_status(ctx):
    """First, last and any code status of a stay, and when each limit was first charted."""
    rows = ctx["older_chartevents"].filter(F.col("itemid").isin(128, 223758)).filter("value IS NOT NULL AND value <> 'Other/Remarks' AND (error IS NULL OR error = 0)")
    w = Window.partitionBy("icustay_id")
    rows = rows.withColumns({"a": F.row_number().over(w.orderBy("charttime", "value")), "z": F.row_number().over(w.orderBy(F.desc("charttime"), F.desc("value")))})
    rows = rows.withColumns({k: F.col("value").isin(v).cast("int") for k, v in STATUS.items()})
    at = lambda c, k: F.max(F.when(F.col(c) == 1, F.col(k)))
    status = rows.groupBy("icustay_id").agg(
        *[x for k in STATUS for x in (at("a", k).alias(f"{k}_first"), at("z", k).alias(f"{k}_last"), F.max(k).alias(k))],
        *[F.min(F.when(F.col(k) == 1, F.col("charttime"))).alias(c) for c, k in _FIRST.items()],
    )
    return ctx["older_icustays"].select(*STAY).join(status, "icustay_id", "left")


# Names of antibiotics, and of forms and routes that do not count.
ANTIBIOTICS = (
    "adoxa ala-tet alodox amikacin amikin amoxicillin clavulanate ampicillin augmentin avelox avidoxy azactam azithromycin aztreonam axetil bactocill bactrim bethkis biaxin cayston cefazolin cedax cefoxitin ceftazidime cefaclor "
    "cefadroxil cefdinir cefditoren cefepime cefotetan cefotaxime cefpodoxime cefprozil ceftibuten ceftin cefuroxime cephalexin chloramphenicol cipro claforan clarithromycin cleocin clindamycin cubicin dicloxacillin doryx doxycycline "
    "duricef dynacin ery-tab eryped eryc erythrocin erythromycin factive flagyl fortaz furadantin garamycin gentamicin kanamycin keflex ketek levaquin levofloxacin lincocin macrobid macrodantin maxipime mefoxin metronidazole minocin "
    "minocycline monodox monurol morgidox moxatag moxifloxacin myrac nitrofurantoin noroxin ocudox ofloxacin omnicef oracea oraxyl oxacillin panixine pediazole penicillin periostat pfizerpen piperacillin tazobactam primsol proquin "
    "raniclor rifadin rifampin rocephin smz-tmp septra solodyn spectracef sulfadiazine sulfamethoxazole trimethoprim sulfatrim sulfisoxazole suprax synercid tazicef tetracycline timentin tobi tobramycin unasyn vancocin vancomycin "
    "vantin vibativ vibra-tabs vibramycin zinacef zithromax zmax zosyn zyvox"
).split() + ["bicillin l-a", "nafcillin sodium", "nicazel doxy 30", "pc pen vk", "pce dispertab", "streptomycin sulfate"]
FORMS, ROUTES = ["cream", "desensitization", "ophth oint", "gel"], ["OU", "OS", "OD", "AU", "AS", "AD", "TP"]


@concept("abx_prescriptions_list", ["older_prescriptions"], f"""
SELECT drug, count(*) AS numobs FROM older_prescriptions WHERE drug_type IN ('MAIN', 'ADDITIVE') AND route NOT IN ({_in(ROUTES)}) AND lower(route) NOT LIKE '%ear%' AND lower(route) NOT LIKE '%eye%'
 AND {' AND '.join(f"lower(drug) NOT LIKE '%{f}%'" for f in FORMS)} AND ({' OR '.join(f"contains(lower(drug), '{a}')" for a in ANTIBIOTICS)}) GROUP BY drug""")
def abx_prescriptions_list(ctx):
    """Names of prescribed systemic antibiotics; the patterns meet each distinct drug and route once."""
    rows = ctx["older_prescriptions"].filter(F.col("drug_type").isin("MAIN", "ADDITIVE") & ~F.col("route").isin(ROUTES))
    names = rows.groupBy("drug", "route").agg(F.count("*").alias("n")).filter(~contains_any(F.col("route"), ["ear", "eye"]) & ~contains_any(F.col("drug"), FORMS) & contains_any(F.col("drug"), ANTIBIOTICS))
    return names.groupBy("drug").agg(F.sum("n").alias("numobs"))


@concept("older_suspicion_of_infection", ["older_icustays", "older_prescriptions", "abx_prescriptions_list", "microbiologyevents"], """
WITH x AS (SELECT p.hadm_id, p.drug, p.startdate FROM older_prescriptions p JOIN abx_prescriptions_list l ON l.drug = p.drug),
b AS (SELECT i.icustay_id, i.hadm_id, x.drug AS antibiotic_name, x.startdate AS t FROM older_icustays i LEFT JOIN x ON x.hadm_id = i.hadm_id),
m AS (SELECT hadm_id, chartdate, charttime, spec_type_desc, max(CASE WHEN org_name IS NOT NULL AND org_name <> '' THEN 1 ELSE 0 END) AS positive FROM microbiologyevents GROUP BY ALL),
f AS (SELECT b.*, coalesce(a.charttime, a.chartdate) AS last72_charttime, coalesce(z.charttime, z.chartdate) AS next24_charttime, a.spec_type_desc AS s72, z.spec_type_desc AS s24, a.positive AS p72, z.positive AS p24 FROM b
  LEFT JOIN m a ON a.hadm_id = b.hadm_id AND ((t >= a.charttime AND t <= a.charttime + INTERVAL '72' HOUR) OR (a.charttime IS NULL AND t >= a.chartdate AND t <= a.chartdate + INTERVAL '96' HOUR))
  LEFT JOIN m z ON z.hadm_id = b.hadm_id AND ((t <= z.charttime AND t >= z.charttime - INTERVAL '24' HOUR) OR (z.charttime IS NULL AND t <= z.chartdate AND t >= z.chartdate - INTERVAL '24' HOUR)))
SELECT icustay_id, antibiotic_name, t AS antibiotic_time, last72_charttime, next24_charttime, coalesce(last72_charttime, next24_charttime) AS suspected_infection_time,
 CASE WHEN last72_charttime IS NOT NULL THEN s72 WHEN next24_charttime IS NOT NULL THEN s24 END AS specimen, CASE WHEN last72_charttime IS NOT NULL THEN p72 WHEN next24_charttime IS NOT NULL THEN p24 END AS positiveculture FROM f""")
def older_suspicion_of_infection(ctx):
    """Antibiotics with the cultures up to three days before and one day after; every pair is a row."""
    drugs = ctx["older_prescriptions"].join(ctx["abx_prescriptions_list"].select("drug"), "drug").select("hadm_id", F.col("drug").alias("antibiotic_name"), F.col("startdate").alias("antibiotic_time"))
    rows = ctx["older_icustays"].select("hadm_id", "icustay_id").join(drugs, "hadm_id", "left")
    positive = F.max((F.coalesce("org_name", F.lit("")) != "").cast("int")).alias("positive")
    cultures = ctx["microbiologyevents"].groupBy("hadm_id", "chartdate", "charttime", "spec_type_desc").agg(positive)
    t = F.col("antibiotic_time")

    def side(name: str, cond) -> DataFrame:
        c, d = F.col(f"{name}_c"), F.col(f"{name}_d")
        held = cultures.toDF(f"{name}_h", f"{name}_d", f"{name}_c", f"{name}_s", f"{name}_p")
        return rows.join(held, (F.col("hadm_id") == F.col(f"{name}_h")) & (cond(c, 72) | (c.isNull() & cond(d, 96))), "left")

    rows = side("a", lambda x, h: (t >= x) & (t <= x + hours(h)))
    rows = side("z", lambda x, h: (t <= x) & (t >= x - hours(24)))
    last, following = F.coalesce("a_c", "a_d"), F.coalesce("z_c", "z_d")
    pick = lambda x: F.when(last.isNotNull(), F.col(f"a_{x}")).when(following.isNotNull(), F.col(f"z_{x}"))
    return rows.select(
        "icustay_id", "antibiotic_name", "antibiotic_time", last.alias("last72_charttime"), following.alias("next24_charttime"), F.coalesce(last, following).alias("suspected_infection_time"),
        pick("s").alias("specimen"), pick("p").alias("positiveculture"),
    )


# Codes of line types in the charting system, and of placed lines in the ordering system.
LINE_TYPES = [229, 235, 241, 247, 253, 259, 265, 271]
ARTERIAL_TYPES = ["A-Line", "IABP"]
CENTRAL_TYPES = ["Multi-lumen", "PICC line", "Dialysis Line", "Introducer", "Trauma Line", "Portacath", "Venous Access", "Hickman", "PacerIntroducer", "TripleIntroducer"]
ARTERIAL_PLACED, CENTRAL_PLACED = [224263, 224267, 224268, 225199, 225752, 225789, 224272], [224263, 224264, 224267, 224268, 225199, 225202, 225203, 225315, 225752, 227719, 224270]
_IS_ARTERIAL = "(itemid IN (225752, 224272) OR locationcategory = 'Invasive Arterial' OR (itemid = 225789 AND locationcategory IS NULL))"
_IS_CENTRAL = "(locationcategory <> 'Invasive Arterial' OR locationcategory IS NULL)"


def _line(name: str, types: list[str], placed: list[int], which: str) -> None:
    @concept(f"{name}_line_durations", ["older_chartevents", "procedureevents_mv"], f"""
WITH a AS (SELECT DISTINCT icustay_id, charttime FROM older_chartevents WHERE itemid IN ({_in(LINE_TYPES)}) AND value IN ({_in(types)})),
b AS (SELECT *, CASE WHEN date_diff('hour', lag(charttime) OVER (PARTITION BY icustay_id ORDER BY charttime), charttime) > 16 THEN 1 ELSE 0 END AS new FROM a),
c AS (SELECT *, sum(new) OVER (PARTITION BY icustay_id ORDER BY charttime) AS k FROM b)
SELECT icustay_id, min(charttime) AS starttime, max(charttime) AS endtime, date_diff('hour', min(charttime), max(charttime)) AS duration_hours FROM c GROUP BY icustay_id, k HAVING min(charttime) <> max(charttime)
UNION ALL SELECT icustay_id, starttime, endtime, date_diff('hour', starttime, endtime) FROM procedureevents_mv WHERE itemid IN ({_in(placed)}) AND {which}""")
    def build(ctx):
        """Time with a line: charted runs without a gap of more than 16 hours, and placed lines."""
        at = ctx["older_chartevents"].filter(F.col("itemid").isin(LINE_TYPES) & F.col("value").isin(types)).select("icustay_id", "charttime").distinct()
        w = Window.partitionBy("icustay_id").orderBy("charttime")
        new = F.coalesce((dt_diff(F.col("charttime"), F.lag("charttime").over(w), "HOUR") > 16).cast("int"), F.lit(0))
        runs = at.withColumn("new", new).withColumn("k", F.sum("new").over(w)).groupBy("icustay_id", "k").agg(F.min("charttime").alias("starttime"), F.max("charttime").alias("endtime")).filter("starttime <> endtime")
        done = ctx["procedureevents_mv"].filter(F.col("itemid").isin(placed)).filter(which).select("icustay_id", "starttime", "endtime")
        both = runs.select("icustay_id", "starttime", "endtime").unionByName(done)
        return both.withColumn("duration_hours", dt_diff(F.col("endtime"), F.col("starttime"), "HOUR"))


_line("arterial", ARTERIAL_TYPES, ARTERIAL_PLACED, _IS_ARTERIAL)
_line("central", CENTRAL_TYPES, CENTRAL_PLACED, _IS_CENTRAL)

# Signs of renal replacement in every source; of the charts some count for the first day as well.
_CHART_ANY, _CHART_LINE = [152, 148, 149, 146, 147, 151, 150], LINE_TYPES
_CHART_582 = ["CAVH Start", "CAVH D/C", "CVVHD Start", "CVVHD D/C", "Hemodialysis st", "Hemodialysis end"]
_CHART_917 = [
    "+ INITIATE DIALYSIS", "BLEEDING FROM DIALYSIS CATHETER", "FAILED DIALYSIS CATH.", "FEBRILE SYNDROME;DIALYSIS", "HYPOTENSION WITH HEMODIALYSIS", "HYPOTENSION.GLOGGED DIALYSIS", "INFECTED DIALYSIS CATHETER",
]
_RRT_DAY = f"(itemid IN ({_in(_CHART_ANY)}) OR (itemid IN ({_in(_CHART_LINE)}) AND value = 'Dialysis Line') OR (itemid = 582 AND value IN ({_in(_CHART_582)})))"
_RRT_STAY = f"({_RRT_DAY} OR (itemid = 466 AND value = 'Dialysis RN') OR (itemid = 927 AND value = 'Dialysis Solutions') OR (itemid = 6250 AND value = 'dialys') OR (itemid = 917 AND value IN ({_in(_CHART_917)})))"
_MV_DAY = [226118, 227357, 225725, 226499, 224154, 225810, 227639, 225183, 227438, 224191, 225806, 225807, 228004, 228005, 228006, 224144, 224145, 224149, 224150, 224151, 224152, 224153, 224404, 224406, 226457]
_MV_STAY = [*_MV_DAY, 225959, 224135, 224139, 224146, 225323, 225740, 225776, 225951, 225952, 225953, 225954, 225956, 225958, 225961, 225963, 225965, 225976, 225977, 227124, 227290, 227638, 227640, 227753]
_CV_IN = [
    40788, 40907, 41063, 41147, 41307, 41460, 41620, 41711, 41791, 41792, 42562, 43829, 44037, 44188, 44526, 44527, 44584, 44591, 44698, 44927, 44954, 45157, 45268, 45352, 45353, 46012, 46013, 46172, 46173, 46250, 46262, 46292,
    46293, 46311, 46389, 46574, 46681, 46720, 46769, 46773,
]
_CV_OUT = [
    40386, 40425, 40426, 40507, 40613, 40624, 40690, 40745, 40789, 40881, 40910, 41016, 41034, 41069, 41112, 41250, 41374, 41417, 41500, 41527, 41623, 41635, 41713, 41750, 41829, 41842, 41897, 42289, 42388, 42464, 42524, 42536,
    42868, 42928, 42972, 43016, 43052, 43098, 43115, 43687, 43941, 44027, 44085, 44193, 44199, 44216, 44286, 44567, 44843, 44845, 44857, 44901, 44943, 45479, 45828, 46230, 46232, 46394, 46464, 46712, 46713, 46715, 46741,
]
_MV_IN, _MV_DATES, _MV_DONE = [227536, 227525], [225318, 225319, 225321, 225322, 225324], [225441, 225802, 225803, 225805, 224270, 225809, 225955, 225436]
_OLD_SYSTEM = "icustay_id IN (SELECT icustay_id FROM older_icustays WHERE dbsource = 'carevue')"


def _rrt(name: str, first_day: bool) -> None:
    sources = [  # table, time, condition, whether it counts for stays of the charting system only
        ("older_chartevents", "charttime", f"{_RRT_DAY if first_day else _RRT_STAY} AND value IS NOT NULL" + ("" if first_day else " AND (error IS NULL OR error = 0)"), True),
        ("older_chartevents", "charttime", f"itemid IN ({_in(_MV_DAY if first_day else _MV_STAY)}) AND valuenum > 0" + ("" if first_day else " AND (error IS NULL OR error = 0)"), False),
        ("inputevents_mv", "starttime", f"itemid IN ({_in(_MV_IN)}) AND amount > 0", False), ("datetimeevents", "charttime", f"itemid IN ({_in(_MV_DATES)})", False),
        ("procedureevents_mv", "starttime", f"itemid IN ({_in(_MV_DONE)})", False),
    ]
    if not first_day:
        sources += [("older_fluids_cv", "charttime", f"itemid IN ({_in(_CV_IN)}) AND amount > 0", False), ("older_outputevents", "charttime", f"itemid IN ({_in(_CV_OUT)}) AND value > 0", False)]
    rows_sql = " UNION ALL ".join(f"SELECT icustay_id, {at} AS t FROM {t} WHERE {cond}{f' AND {_OLD_SYSTEM}' if old else ''}" for t, at, cond, old in sources)
    within = " AND r.t BETWEEN i.intime AND i.intime + INTERVAL '1' DAY" if first_day else ""

    @concept(name, ["older_icustays", *dict.fromkeys(t for t, *_ in sources)], f"""
WITH r AS ({rows_sql}) SELECT i.subject_id, i.hadm_id, i.icustay_id, max(CASE WHEN r.icustay_id IS NOT NULL THEN 1 ELSE 0 END) AS rrt FROM older_icustays i LEFT JOIN r ON r.icustay_id = i.icustay_id{within} GROUP BY ALL""")
    def build(ctx):
        """Whether any source shows renal replacement."""
        stays = ctx["older_icustays"].select(*STAY, "intime", "dbsource")
        found = None
        for table, at, cond, old in sources:
            rows = ctx[table].filter(cond).select("icustay_id", F.col(at).alias("t"))
            kept = rows.join(stays.drop("subject_id", "hadm_id"), "icustay_id")
            kept = kept.filter("dbsource = 'carevue'") if old else kept
            kept = kept.filter(F.col("t").between(F.col("intime"), F.col("intime") + hours(24))) if first_day else kept
            found = kept.select("icustay_id") if found is None else found.unionByName(kept.select("icustay_id"))
        return stays.select(*STAY).join(found.distinct().withColumn("rrt", F.lit(1)), "icustay_id", "left").withColumn("rrt", F.coalesce("rrt", F.lit(0)))


_rrt("older_rrt", False)
_rrt("rrt_first_day", True)
