"""Cleaned and pivoted measurements."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vitalgrid.functions.dt import dt_diff, hours, micros
from vitalgrid.functions.scalar import num
from vitalgrid.operators.joins import asof_join, interval_join, previous_within
from vitalgrid.operators.pivot import Item, Part, column, column_sql, item, pivot, pivot_sql
from vitalgrid.plans.registry import concept

SPECIMEN = ("specimen_id",), ("subject_id", "hadm_id", "charttime")

# Codes and plausible ranges of the laboratory panels.
CHEMISTRY = [
    item("albumin", 50862, most=10), item("globulin", 50930, most=10), item("total_protein", 50976, most=20), item("aniongap", 50868, most=10000),
    item("bicarbonate", 50882, most=10000), item("bun", 51006, most=300), item("calcium", 50893, most=10000), item("chloride", 50902, most=10000),
    item("creatinine", 50912, most=150), item("glucose", 50931, most=10000), item("sodium", 50983, most=200), item("potassium", 50971, most=30),
]
BLOOD_COUNT = [
    item("hematocrit", 51221), item("hemoglobin", 51222), item("mch", 51248), item("mchc", 51249), item("mcv", 51250), item("platelet", 51265),
    item("rbc", 51279), item("rdw", 51277), item("rdwsd", 52159), item("wbc", 51301),
]
COAGULATION = [item("d_dimer", 51196), item("fibrinogen", 51214), item("thrombin", 51297), item("inr", 51237), item("pt", 51274), item("ptt", 51275)]
ENZYME = [
    item("alt", 50861), item("alp", 50863), item("ast", 50878), item("amylase", 50867), item("bilirubin_total", 50885), item("bilirubin_direct", 50883),
    item("bilirubin_indirect", 50884), item("ck_cpk", 50910), item("ck_mb", 50911), item("ggt", 50927), item("ld_ldh", 50954),
]
CARDIAC = [item("troponin_t", 51003), item("ck_mb", 50911), item("ntprobnp", 50963)]
INFLAMMATION = [item("crp", 50889)]
DIFFERENTIAL = [
    item("wbc", 51300, 51301, 51755), item("basophils_abs", 52069), Item("eosinophils_abs", (Part((52073,)), Part((51199,), over=1000.0))),
    Item("lymphocytes_abs", (Part((51133,)), Part((52769,), over=1000.0))), Item("monocytes_abs", (Part((52074,)), Part((51253,), over=1000.0))),
    item("neutrophils_abs", 52075), item("granulocytes_abs", 51218, over=1000.0), item("basophils", 51146), item("eosinophils", 51200), item("lymphocytes", 51244, 51245),
    item("monocytes", 51254), item("neutrophils", 51256), item("atypical_lymphocytes", 51143), item("bands", 51144), item("immature_granulocytes", 52135),
    item("metamyelocytes", 51251), item("nrbc", 51257), item("_percent", 51146, 51200, 51244, 51245, 51254, 51256, agg="sum"),
]
BLOOD_GAS = [
    item("specimen", 52033, field="value"), item("aado2", 50801), item("baseexcess", 50802), item("bicarbonate", 50803), item("totalco2", 50804),
    item("carboxyhemoglobin", 50805), item("chloride", 50806), item("calcium", 50808), item("glucose", 50809, most=10000), item("hematocrit", 50810, most=100),
    item("hemoglobin", 50811), item("lactate", 50813, most=10000), item("methemoglobin", 50814), item("o2flow", 50815),
    Item("fio2", (Part((50816,), above=20, most=100), Part((50816,), above=0.2, most=1.0, times=100.0))), item("so2", 50817, most=100), item("pco2", 50818),
    item("peep", 50819), item("ph", 50820), item("po2", 50821), item("potassium", 50822), item("requiredo2", 50823), item("sodium", 50824), item("temperature", 50825),
    item("comments", 50807, field="value"),
]
# Codes and plausible ranges of bedside readings.
VITALS = [
    item("heart_rate", 220045, agg="avg", above=0, below=300), item("sbp", 220179, 220050, 225309, agg="avg", above=0, below=400),
    item("dbp", 220180, 220051, 225310, agg="avg", above=0, below=300), item("mbp", 220052, 220181, 225312, agg="avg", above=0, below=300),
    item("sbp_ni", 220179, agg="avg", above=0, below=400), item("dbp_ni", 220180, agg="avg", above=0, below=300), item("mbp_ni", 220181, agg="avg", above=0, below=300),
    item("resp_rate", 220210, 224690, agg="avg", above=0, below=70),
    Item("temperature", (Part((223761,), above=70, below=120, add=-32.0, over=1.8), Part((223762,), above=10, below=50)), "avg", digits=2),
    item("temperature_site", 224642, field="value"), item("spo2", 220277, agg="avg", above=0, most=100), item("glucose", 225664, 220621, 226537, agg="avg", above=0),
]
VENTILATOR = [
    item("respiratory_rate_set", 224688), item("respiratory_rate_total", 224690), item("respiratory_rate_spontaneous", 224689), item("minute_volume", 224687),
    item("tidal_volume_set", 224684), item("tidal_volume_observed", 224685), item("tidal_volume_spontaneous", 224686), item("plateau_pressure", 224696),
    item("peep", 220339, 224700, least=0, most=100), Item("fio2", (Part((223835,), least=0.2, most=1, times=100.0), Part((223835,), least=20, most=100))),
    item("flow_rate", 224691), item("ventilator_mode", 223849, field="value"), item("ventilator_mode_hamilton", 229314, field="value"), item("ventilator_type", 223848, field="value"),
]
RHYTHM = [
    item("ectopy_type", 224650, field="value"), item("ectopy_frequency", 224651, field="value"), item("ectopy_type_secondary", 226479, field="value"),
    item("ectopy_frequency_secondary", 226480, field="value"),
]
URINE_CODES = [226559, 226560, 226561, 226584, 226563, 226564, 226565, 226567, 226557, 226558, 227488, 227489]


def _panel(name: str, items: list[Item], where: str) -> None:
    keys, carry = SPECIMEN

    @concept(name, ["labevents"], pivot_sql("labevents", keys, carry, items, where))
    def build(ctx):
        return pivot(ctx["labevents"], keys, carry, items, F.expr(where))


_panel("chemistry", CHEMISTRY, "valuenum IS NOT NULL AND (valuenum > 0 OR itemid = 50868)")
_panel("complete_blood_count", BLOOD_COUNT, "valuenum > 0")
_panel("coagulation", COAGULATION, "valuenum IS NOT NULL")
_panel("enzyme", ENZYME, "valuenum > 0")
_panel("cardiac_marker", CARDIAC, "valuenum IS NOT NULL")
_panel("inflammation", INFLAMMATION, "valuenum > 0")

CELLS = ["basophils", "eosinophils", "lymphocytes", "monocytes", "neutrophils"]
REST = ["basophils", "eosinophils", "lymphocytes", "monocytes", "neutrophils", "atypical_lymphocytes", "bands", "immature_granulocytes", "metamyelocytes", "nrbc"]


@concept("blood_differential", ["labevents"], f"""
SELECT subject_id, hadm_id, charttime, specimen_id, wbc,
       {', '.join(f"CAST(round(CAST(coalesce({c}_abs, CASE WHEN wbc > 0 AND _percent > 0 THEN {c} * wbc / 100 END) AS DECIMAL(38,9)), 4) AS DOUBLE) AS {c}_abs" for c in CELLS)},
       {', '.join(REST)}
FROM ({pivot_sql('labevents', *SPECIMEN, DIFFERENTIAL, 'valuenum >= 0')}) d""")
def blood_differential(ctx):
    d = pivot(ctx["labevents"], *SPECIMEN, DIFFERENTIAL, F.expr("valuenum >= 0"))
    imputable = (F.col("wbc") > 0) & (F.col("_percent") > 0)
    absolute = [
        num(F.coalesce(f"{c}_abs", F.when(imputable, F.col(c) * F.col("wbc") / 100)), 4).alias(f"{c}_abs") for c in CELLS
    ]
    return d.select("subject_id", "hadm_id", "charttime", "specimen_id", "wbc", *absolute, *REST)


GAS_OUT = [
    "ph", "baseexcess", "bicarbonate", "totalco2", "hematocrit", "hemoglobin", "carboxyhemoglobin", "methemoglobin", "chloride", "calcium", "temperature",
    "potassium", "sodium", "lactate", "glucose",
]
CHART_FIO2 = Item("fio2_chartevents", (Part((223835,), above=0.2, most=1, times=100.0), Part((223835,), least=20, most=100)))
CHART_SPO2 = item("spo2", 220277, agg="avg", above=0, most=100)


@concept("bg", ["labevents", "chartevents"], f"""
WITH g AS ({pivot_sql('labevents', *SPECIMEN, BLOOD_GAS)}),
f AS (SELECT subject_id, charttime, {column_sql(CHART_FIO2)} FROM chartevents WHERE itemid = 223835 AND valuenum > 0 AND valuenum <= 100 GROUP BY ALL),
j AS (SELECT g.*, (SELECT max_by(f.fio2_chartevents, f.charttime) FROM f WHERE f.subject_id = g.subject_id AND f.fio2_chartevents > 0
        AND f.charttime BETWEEN g.charttime - INTERVAL '4' HOUR AND g.charttime) AS fio2_chartevents
      FROM g WHERE po2 IS NOT NULL)
SELECT subject_id, hadm_id, charttime, specimen_id, specimen, so2, po2, pco2, fio2_chartevents, fio2, aado2,
       CAST(round(CAST(coalesce(fio2, fio2_chartevents) / 100 * (760 - 47) - pco2 / CAST(0.8 AS DOUBLE) - po2 AS DECIMAL(38,9)), 4) AS DOUBLE) AS aado2_calc,
       100 * po2 / coalesce(fio2, fio2_chartevents) AS pao2fio2ratio, {', '.join(GAS_OUT)}
FROM j""")
def bg(ctx):
    """Blood gases with an arterial pressure; the inspired fraction charted last within four hours fills in."""
    gas = pivot(ctx["labevents"], *SPECIMEN, BLOOD_GAS).filter("po2 IS NOT NULL")
    charted = (
        ctx["chartevents"].filter("itemid = 223835 AND valuenum > 0 AND valuenum <= 100").groupBy("subject_id", F.col("charttime").alias("chart_at"))
        .agg(column(CHART_FIO2)).filter("fio2_chartevents > 0")
    )
    both = asof_join(gas, charted, ["subject_id"], "charttime", "chart_at", ["fio2_chartevents"], 4)
    fraction = F.coalesce("fio2", "fio2_chartevents")
    gradient = fraction / 100 * (760 - 47) - F.col("pco2") / 0.8 - F.col("po2")
    return both.select(
        "subject_id", "hadm_id", "charttime", "specimen_id", "specimen", "so2", "po2", "pco2", "fio2_chartevents", "fio2", "aado2",
        num(gradient, 4).alias("aado2_calc"), (100 * F.col("po2") / fraction).alias("pao2fio2ratio"), *GAS_OUT,
    )


@concept("vitalsign", ["chartevents"], pivot_sql("chartevents", ["subject_id", "stay_id", "charttime"], [], VITALS, "stay_id IS NOT NULL"))
def vitalsign(ctx):
    return pivot(ctx["chartevents"], ["subject_id", "stay_id", "charttime"], [], VITALS, F.col("stay_id").isNotNull())


@concept("ventilator_setting", ["chartevents"], pivot_sql("chartevents", ["subject_id", "charttime"], ["stay_id"], VENTILATOR, "value IS NOT NULL AND stay_id IS NOT NULL"))
def ventilator_setting(ctx):
    return pivot(ctx["chartevents"], ["subject_id", "charttime"], ["stay_id"], VENTILATOR, F.expr("value IS NOT NULL AND stay_id IS NOT NULL"))


@concept("icp", ["chartevents"], pivot_sql("chartevents", ["subject_id", "stay_id", "charttime"], [], [item("icp", 220765, 227989, above=0, below=100)]))
def icp(ctx):
    return pivot(ctx["chartevents"], ["subject_id", "stay_id", "charttime"], [], [item("icp", 220765, 227989, above=0, below=100)])


@concept("rhythm", ["chartevents"], f"""
SELECT subject_id, charttime, string_agg(DISTINCT CASE WHEN itemid = 220048 THEN value END, '; ' ORDER BY CASE WHEN itemid = 220048 THEN value END) AS heart_rhythm,
       {', '.join(column_sql(i) for i in RHYTHM)}
FROM chartevents WHERE stay_id IS NOT NULL AND itemid IN (220048, 224650, 224651, 226479, 226480) GROUP BY subject_id, charttime""")
def rhythm(ctx):
    rows = ctx["chartevents"].filter(F.col("itemid").isin(220048, 224650, 224651, 226479, 226480) & F.col("stay_id").isNotNull())
    rhythms = F.array_sort(F.collect_set(F.when(F.col("itemid") == 220048, F.col("value"))))
    return rows.groupBy("subject_id", "charttime").agg(
        F.when(F.size(rhythms) > 0, F.array_join(rhythms, "; ")).alias("heart_rhythm"), *[column(i) for i in RHYTHM]
    )


@concept("height", ["chartevents"], """
WITH c AS (SELECT subject_id, stay_id, charttime, CAST(round(CAST(valuenum AS DECIMAL(38,9)), 2) AS DOUBLE) AS height FROM chartevents WHERE itemid = 226730 AND valuenum IS NOT NULL),
i AS (SELECT subject_id, stay_id, charttime, CAST(round(CAST(valuenum * CAST(2.54 AS DOUBLE) AS DECIMAL(38,9)), 2) AS DOUBLE) AS height FROM chartevents WHERE itemid = 226707 AND valuenum IS NOT NULL)
SELECT coalesce(c.subject_id, i.subject_id) AS subject_id, coalesce(c.stay_id, i.stay_id) AS stay_id, coalesce(c.charttime, i.charttime) AS charttime,
       coalesce(c.height, i.height) AS height
FROM c FULL JOIN i ON c.subject_id = i.subject_id AND c.charttime = i.charttime
WHERE coalesce(c.height, i.height) > 120 AND coalesce(c.height, i.height) < 230""")
def height(ctx):
    """Heights in centimetres, or converted from inches where only those were charted."""
    rows = ctx["chartevents"].filter("valuenum IS NOT NULL")
    cm = rows.filter("itemid = 226730").select("subject_id", "charttime", F.col("stay_id").alias("s1"), num(F.col("valuenum"), 2).alias("h1"))
    inch = rows.filter("itemid = 226707").select("subject_id", "charttime", F.col("stay_id").alias("s2"), num(F.col("valuenum") * 2.54, 2).alias("h2"))
    both = cm.join(inch, ["subject_id", "charttime"], "full")
    out = both.select("subject_id", F.coalesce("s1", "s2").alias("stay_id"), "charttime", F.coalesce("h1", "h2").alias("height"))
    return out.filter("height > 120 AND height < 230")


@concept("urine_output", ["outputevents"], f"""
SELECT stay_id, charttime, sum(CASE WHEN itemid = 227488 THEN -abs(value) ELSE value END) AS urineoutput
FROM outputevents WHERE itemid IN ({', '.join(map(str, URINE_CODES))}) GROUP BY stay_id, charttime""")
def urine_output(ctx):
    signed = F.when((F.col("itemid") == 227488) & (F.col("value") > 0), -F.col("value")).otherwise(F.col("value"))
    return ctx["outputevents"].filter(F.col("itemid").isin(URINE_CODES)).groupBy("stay_id", "charttime").agg(F.sum(signed).alias("urineoutput"))


@concept("urine_output_rate", ["icustays", "chartevents", "urine_output", "weight_durations"], """
WITH h AS (SELECT i.stay_id, min(c.charttime) AS first_hr FROM icustays i JOIN chartevents c ON c.stay_id = i.stay_id AND c.itemid = 220045
        AND c.charttime > i.intime - INTERVAL '1' MONTH AND c.charttime < i.outtime + INTERVAL '1' MONTH GROUP BY 1),
u AS (SELECT u.*, date_diff('minute', coalesce(lag(u.charttime) OVER (PARTITION BY u.stay_id ORDER BY u.charttime), h.first_hr), u.charttime) AS mins
      FROM urine_output u JOIN h USING (stay_id)),
s AS (SELECT a.stay_id, a.charttime, a.urineoutput AS uo,
        sum(b.urineoutput) FILTER (WHERE date_diff('hour', b.charttime, a.charttime) <= 5) AS u6, sum(b.mins) FILTER (WHERE date_diff('hour', b.charttime, a.charttime) <= 5) AS m6,
        sum(b.urineoutput) FILTER (WHERE date_diff('hour', b.charttime, a.charttime) <= 11) AS u12, sum(b.mins) FILTER (WHERE date_diff('hour', b.charttime, a.charttime) <= 11) AS m12,
        sum(b.urineoutput) AS u24, sum(b.mins) AS m24
      FROM u a JOIN u b ON a.stay_id = b.stay_id AND b.charttime BETWEEN a.charttime - INTERVAL '23' HOUR AND a.charttime GROUP BY ALL),
r AS (SELECT s.*, CAST(round(CAST(m6 / CAST(60 AS DOUBLE) AS DECIMAL(38,9)), 6) AS DOUBLE) AS t6, CAST(round(CAST(m12 / CAST(60 AS DOUBLE) AS DECIMAL(38,9)), 6) AS DOUBLE) AS t12,
        CAST(round(CAST(m24 / CAST(60 AS DOUBLE) AS DECIMAL(38,9)), 6) AS DOUBLE) AS t24 FROM s)
SELECT r.stay_id, r.charttime, w.weight, uo, u6 AS urineoutput_6hr, u12 AS urineoutput_12hr, u24 AS urineoutput_24hr,
       CASE WHEN t6 >= 6 THEN CAST(round(CAST(u6 / w.weight / t6 AS DECIMAL(38,9)), 4) AS DOUBLE) END AS uo_mlkghr_6hr,
       CASE WHEN t12 >= 12 THEN CAST(round(CAST(u12 / w.weight / t12 AS DECIMAL(38,9)), 4) AS DOUBLE) END AS uo_mlkghr_12hr,
       CASE WHEN t24 >= 24 THEN CAST(round(CAST(u24 / w.weight / t24 AS DECIMAL(38,9)), 4) AS DOUBLE) END AS uo_mlkghr_24hr,
       CAST(round(CAST(t6 AS DECIMAL(38,9)), 2) AS DOUBLE) AS uo_tm_6hr, CAST(round(CAST(t12 AS DECIMAL(38,9)), 2) AS DOUBLE) AS uo_tm_12hr,
       CAST(round(CAST(t24 AS DECIMAL(38,9)), 2) AS DOUBLE) AS uo_tm_24hr
FROM r LEFT JOIN weight_durations w ON w.stay_id = r.stay_id AND r.charttime > w.starttime AND r.charttime <= w.endtime AND w.weight > 0""")
def urine_output_rate(ctx):
    """Trailing output per weight and observed time.

    The 23-hour frame is an exact range window; the 6 and 12 hour sums count hour boundaries, so they
    are taken inside the frame's rows instead of by a self-join.
    """
    stays = ctx["icustays"].select("stay_id", "intime", "outtime")
    pulse = ctx["chartevents"].filter("itemid = 220045").select("stay_id", "charttime")
    month = F.expr("INTERVAL '1' MONTH")
    near = (F.col("charttime") > F.col("intime") - month) & (F.col("charttime") < F.col("outtime") + month)
    begin = stays.join(pulse, "stay_id").filter(near).groupBy("stay_id").agg(F.min("charttime").alias("first_hr"))
    w = Window.partitionBy("stay_id").orderBy("charttime")
    rows = ctx["urine_output"].join(begin, "stay_id")
    before = F.coalesce(F.lag("charttime").over(w), F.col("first_hr"))
    rows = rows.withColumn("mins", dt_diff(F.col("charttime"), before, "MINUTE"))
    frame = Window.partitionBy("stay_id").orderBy("at").rangeBetween(-23 * 3_600_000_000, 0)
    seen = F.collect_list(F.struct("charttime", "urineoutput", "mins")).over(frame)
    rows = rows.withColumn("at", micros(F.col("charttime"))).withColumn("seen", seen)

    def total(field: str, within: int):
        kept = F.filter("seen", lambda x: dt_diff(F.col("charttime"), x["charttime"], "HOUR") <= within)
        return F.when(F.size(kept) > 0, F.aggregate(kept, F.lit(0.0), lambda a, x: a + F.coalesce(x[field].cast("double"), F.lit(0.0))))

    rows = rows.select(
        "stay_id", "charttime", F.col("urineoutput").alias("uo"),
        *[total("urineoutput", n - 1).alias(f"urineoutput_{n}hr") for n in (6, 12, 24)], *[num(total("mins", n - 1) / 60, 6).alias(f"t{n}") for n in (6, 12, 24)],
    )
    weights = ctx["weight_durations"].filter("weight > 0").select(F.col("stay_id"), F.col("starttime").alias("_s"), F.col("endtime").alias("_e"), "weight")
    out = interval_join(rows, weights, ["stay_id"], "charttime", "_s", "_e", closed="right", how="left")
    rate = lambda n: F.when(F.col(f"t{n}") >= n, num(F.col(f"urineoutput_{n}hr") / F.col("weight") / F.col(f"t{n}"), 4))
    return out.select(
        "stay_id", "charttime", "weight", "uo", *[f"urineoutput_{n}hr" for n in (6, 12, 24)], *[rate(n).alias(f"uo_mlkghr_{n}hr") for n in (6, 12, 24)],
        *[num(F.col(f"t{n}"), 2).alias(f"uo_tm_{n}hr") for n in (6, 12, 24)],
    )


COMA = [
    item("motor", 223901), Item("verbal", (Part((223900,), text="No Response-ETT", const=0.0), Part((223900,)))), item("eyes", 220739),
    Item("tube", (Part((223900,), text="No Response-ETT", const=1.0),)),
]


@concept("gcs", ["chartevents"], f"""
WITH b AS ({pivot_sql('chartevents', ['subject_id', 'stay_id', 'charttime'], [], COMA)}),
p AS (SELECT *, lag(charttime) OVER w > charttime - INTERVAL '6' HOUR AS near, lag(motor) OVER w AS lm, lag(verbal) OVER w AS lv, lag(eyes) OVER w AS le
      FROM b WINDOW w AS (PARTITION BY stay_id ORDER BY charttime)),
q AS (SELECT *, CASE WHEN near THEN lm END AS pm, CASE WHEN near THEN lv END AS pv, CASE WHEN near THEN le END AS pe FROM p)
SELECT subject_id, stay_id, charttime,
       CASE WHEN verbal = 0 OR (verbal IS NULL AND pv = 0) THEN CAST(15 AS DOUBLE)
            WHEN pv = 0 THEN coalesce(motor, 6) + coalesce(verbal, 5) + coalesce(eyes, 4)
            ELSE coalesce(motor, pm, 6) + coalesce(verbal, pv, 5) + coalesce(eyes, pe, 4) END AS gcs,
       coalesce(motor, pm) AS gcs_motor, coalesce(verbal, pv) AS gcs_verbal, coalesce(eyes, pe) AS gcs_eyes, CAST(coalesce(tube, 0) AS INT) AS gcs_unable
FROM q""")
def gcs(ctx):
    """Coma scale with components carried forward for at most six hours; a tube counts as fully alert."""
    base = pivot(ctx["chartevents"], ["subject_id", "stay_id", "charttime"], [], COMA)
    p = previous_within(base, ["stay_id"], "charttime", ["motor", "verbal", "eyes"], hours(6))
    normal = {"motor": 6.0, "verbal": 5.0, "eyes": 4.0}
    fresh = sum((F.coalesce(c, F.lit(n)) for c, n in normal.items()), F.lit(0.0))
    carried = sum((F.coalesce(c, f"prev_{c}", F.lit(n)) for c, n in normal.items()), F.lit(0.0))
    tubed = (F.col("verbal") == 0) | (F.col("verbal").isNull() & (F.col("prev_verbal") == 0))
    total = F.when(tubed, 15.0).when(F.col("prev_verbal") == 0, fresh).otherwise(carried)
    return p.select(
        "subject_id", "stay_id", "charttime", total.alias("gcs"), *[F.coalesce(c, f"prev_{c}").alias(f"gcs_{c}") for c in normal],
        F.coalesce("tube", F.lit(0)).cast("int").alias("gcs_unable"),
    )


@concept("oxygen_delivery", ["chartevents"], """
WITH f AS (SELECT subject_id, stay_id, charttime, CASE WHEN itemid = 227582 THEN 223834 ELSE itemid END AS code, valuenum,
        row_number() OVER (PARTITION BY subject_id, charttime, CASE WHEN itemid = 227582 THEN 223834 ELSE itemid END ORDER BY storetime DESC NULLS LAST, valuenum DESC NULLS LAST) AS n
      FROM chartevents WHERE value IS NOT NULL AND itemid IN (223834, 227582, 227287)),
d AS (SELECT subject_id, charttime, value, row_number() OVER (PARTITION BY subject_id, charttime ORDER BY storetime DESC NULLS LAST, value DESC NULLS LAST) AS n
      FROM chartevents WHERE itemid = 226732)
SELECT f.subject_id, max(f.stay_id) AS stay_id, f.charttime, max(valuenum) FILTER (WHERE code = 223834) AS o2_flow, max(valuenum) FILTER (WHERE code = 227287) AS o2_flow_additional,
       max(d.value) FILTER (WHERE d.n = 1) AS o2_delivery_device_1, max(d.value) FILTER (WHERE d.n = 2) AS o2_delivery_device_2,
       max(d.value) FILTER (WHERE d.n = 3) AS o2_delivery_device_3, max(d.value) FILTER (WHERE d.n = 4) AS o2_delivery_device_4
FROM f LEFT JOIN d ON d.subject_id = f.subject_id AND d.charttime = f.charttime
WHERE f.n = 1 GROUP BY f.subject_id, f.charttime""")
def oxygen_delivery(ctx):
    """Oxygen flows (the reading stored last) and up to four devices; devices charted without a flow have no row."""
    rows = ctx["chartevents"]
    code = F.when(F.col("itemid") == 227582, 223834).otherwise(F.col("itemid"))
    flows = rows.filter(F.col("itemid").isin(223834, 227582, 227287) & F.col("value").isNotNull()).withColumn("code", code)
    last = Window.partitionBy("subject_id", "charttime", "code").orderBy(F.desc_nulls_last("storetime"), F.desc_nulls_last("valuenum"))
    flows = flows.withColumn("n", F.row_number().over(last)).filter("n = 1")
    flow = flows.groupBy("subject_id", "charttime").agg(
        F.max("stay_id").alias("stay_id"), F.max(F.when(F.col("code") == 223834, F.col("valuenum"))).alias("o2_flow"),
        F.max(F.when(F.col("code") == 227287, F.col("valuenum"))).alias("o2_flow_additional"),
    )
    rank = Window.partitionBy("subject_id", "charttime").orderBy(F.desc_nulls_last("storetime"), F.desc_nulls_last("value"))
    devices = rows.filter("itemid = 226732").withColumn("n", F.row_number().over(rank)).groupBy("subject_id", "charttime").agg(
        *[F.max(F.when(F.col("n") == i, F.col("value"))).alias(f"o2_delivery_device_{i}") for i in (1, 2, 3, 4)]
    )
    return flow.join(devices, ["subject_id", "charttime"], "left")


@concept("creatinine_baseline", ["age", "patients", "chemistry", "diagnoses_icd"], """
WITH l AS (SELECT hadm_id, min(creatinine) AS scr_min FROM chemistry GROUP BY 1),
k AS (SELECT DISTINCT hadm_id FROM diagnoses_icd WHERE (icd_version = 9 AND icd_code LIKE '585%') OR (icd_version = 10 AND icd_code LIKE 'N18%')),
b AS (SELECT a.hadm_id, p.gender, a.age, l.scr_min, CASE WHEN k.hadm_id IS NULL THEN 0 ELSE 1 END AS ckd,
        power(CAST(75.0 AS DOUBLE) / 186 / power(CAST(a.age AS DOUBLE), CAST(-0.203 AS DOUBLE)) / CASE WHEN p.gender = 'F' THEN CAST(0.742 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END, -1 / CAST(1.154 AS DOUBLE)) AS est
      FROM age a LEFT JOIN patients p USING (subject_id) LEFT JOIN l ON l.hadm_id = a.hadm_id LEFT JOIN k ON k.hadm_id = a.hadm_id WHERE a.age >= 18)
SELECT hadm_id, gender, age, scr_min, ckd, round(est, 6) AS mdrd_est, CASE WHEN scr_min <= CAST(1.1 AS DOUBLE) OR ckd = 1 THEN scr_min ELSE round(est, 6) END AS scr_baseline FROM b""")
def creatinine_baseline(ctx):
    """Lowest creatinine where it is normal or kidney disease is known, else back-calculated from age and sex."""
    adults = ctx["age"].filter("age >= 18").join(ctx["patients"].select("subject_id", "gender"), "subject_id", "left")
    lowest = ctx["chemistry"].groupBy("hadm_id").agg(F.min("creatinine").alias("scr_min"))
    code = F.col("icd_code")
    known = ctx["diagnoses_icd"].filter(
        ((F.col("icd_version") == 9) & code.startswith("585")) | ((F.col("icd_version") == 10) & code.startswith("N18"))
    ).select("hadm_id").distinct().withColumn("ckd", F.lit(1))
    j = adults.join(lowest, "hadm_id", "left").join(known, "hadm_id", "left").withColumn("ckd", F.coalesce("ckd", F.lit(0)))
    sex = F.when(F.col("gender") == "F", 0.742).otherwise(1.0)
    estimate = F.round(F.pow(F.lit(75.0) / 186 / F.pow(F.col("age").cast("double"), F.lit(-0.203)) / sex, F.lit(-1 / 1.154)), 6)
    j = j.withColumn("mdrd_est", estimate)
    pick = F.when((F.col("scr_min") <= 1.1) | (F.col("ckd") == 1), F.col("scr_min")).otherwise(F.col("mdrd_est"))
    return j.select("hadm_id", "gender", "age", "scr_min", "ckd", "mdrd_est", pick.alias("scr_baseline"))
