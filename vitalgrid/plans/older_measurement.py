"""Measurements of the older generation: both bedside systems' codes side by side, per time and per first day."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.dt import dt_diff, hours
from vitalgrid.functions.scalar import logistic, num
from vitalgrid.operators.episodes import ownership_windows
from vitalgrid.operators.joins import anchored_join, asof_join, interval_join, previous_within
from vitalgrid.operators.pivot import Item, Part, item, pivot, pivot_sql
from vitalgrid.plans.registry import concept

RIGHT = "(error IS NULL OR error <> 1)"
STAY = ["subject_id", "hadm_id", "icustay_id"]

# Codes and plausible ranges of bedside readings in both systems.
VITALS = [
    item("heartrate", 211, 220045, agg="avg", above=0, below=300), item("sysbp", 51, 442, 455, 6701, 220179, 220050, agg="avg", above=0, below=400),
    item("diasbp", 8368, 8440, 8441, 8555, 220180, 220051, agg="avg", above=0, below=300), item("meanbp", 456, 52, 6702, 443, 220052, 220181, 225312, agg="avg", above=0, below=300),
    item("resprate", 615, 618, 220210, 224690, agg="avg", above=0, below=70),
    Item("tempc", (Part((223761, 678), above=70, below=120, add=-32.0, over=1.8), Part((223762, 676), above=10, below=50)), "avg", digits=6),
    item("spo2", 646, 220277, agg="avg", above=0, most=100), item("glucose", 807, 811, 1529, 3745, 3744, 225664, 220621, 226537, agg="avg", above=0),
]
PRESSURE = item("icp", 226, 1374, 2045, 2635, 2660, 2733, 2745, 2870, 2956, 2985, 5856, 7116, 8218, 8298, 8299, 8305, 220765, 227989, above=0, below=100)
URINE = [40055, 43175, 40069, 40094, 40715, 40473, 40085, 40057, 40056, 40405, 40428, 40086, 40096, 40651, 226559, 226560, 226561, 226584, 226563, 226564, 226565, 226567, 226557, 226558, 227488, 227489]
# Laboratory codes with upper limits; the codes of the second list count in the first day only.
LABS = {
    "aniongap": ([50868], [], 10000), "albumin": ([50862], [], 10), "bands": ([51144], [], 100), "bicarbonate": ([50882], [], 10000), "bilirubin": ([50885], [], 150), "creatinine": ([50912], [], 150),
    "chloride": ([50902], [50806], 10000), "glucose": ([50931], [50809], 10000), "hematocrit": ([51221], [50810], 100), "hemoglobin": ([51222], [50811], 50), "lactate": ([50813], [], 50), "platelet": ([51265], [], 10000),
    "potassium": ([50971], [50822], 30), "ptt": ([51275], [], 150), "inr": ([51237], [], 50), "pt": ([51274], [], 150), "sodium": ([50983], [50824], 200), "bun": ([51006], [], 300), "wbc": ([51300, 51301], [], 1000),
}
# Codes of a blood gas, with bounds.
GAS = {
    "aado2": 50801, "baseexcess": 50802, "bicarbonate": 50803, "totalco2": 50804, "carboxyhemoglobin": 50805, "chloride": 50806, "calcium": 50808, "glucose": 50809, "hematocrit": 50810, "hemoglobin": 50811, "intubated": 50812,
    "lactate": 50813, "methemoglobin": 50814, "o2flow": 50815, "fio2": 50816, "so2": 50817, "pco2": 50818, "peep": 50819, "ph": 50820, "po2": 50821, "potassium": 50822, "requiredo2": 50823, "sodium": 50824,
    "temperature": 50825, "tidalvolume": 50826, "ventilationrate": 50827, "ventilator": 50828,
}
GAS_BOUNDS = {"hematocrit": {"most": 100}, "fio2": {"least": 20, "most": 100}, "so2": {"most": 100}, "o2flow": {"most": 70}, "po2": {"most": 800}}


def _gas(agg: str, signed: tuple[str, ...] = ()) -> list[Item]:
    """Columns of a gas; codes without a column of their own still make a row."""
    named = [item(n, c, agg="max" if n.startswith("ventilat") else agg, **({} if n in signed else {"above": 0}), **GAS_BOUNDS.get(n, {})) for n, c in GAS.items()]
    return [item("specimen", 50800, field="value"), *named, item("_other", 50807, 51545), Item("_specimens", (Part((50800,), const=1.0),), "sum")]


@concept("pivoted_vital", ["older_chartevents"], pivot_sql("older_chartevents", ["icustay_id", "charttime"], [], VITALS, f"{RIGHT} AND icustay_id IS NOT NULL"))
def pivoted_vital(ctx):
    return pivot(ctx["older_chartevents"], ["icustay_id", "charttime"], [], VITALS, F.expr(f"{RIGHT} AND icustay_id IS NOT NULL"))


@concept("pivoted_icp", ["older_chartevents"], pivot_sql("older_chartevents", ["icustay_id", "charttime"], [], [PRESSURE], f"{RIGHT} AND icustay_id IS NOT NULL"))
def pivoted_icp(ctx):
    return pivot(ctx["older_chartevents"], ["icustay_id", "charttime"], [], [PRESSURE], F.expr(f"{RIGHT} AND icustay_id IS NOT NULL"))


_URINE_IN = f"itemid IN ({', '.join(map(str, URINE))})"


@concept("pivoted_uo", ["older_outputevents"], f"""
SELECT icustay_id, charttime, sum(CASE WHEN itemid = 227488 AND value > 0 THEN -value ELSE value END) AS urineoutput FROM older_outputevents
WHERE (iserror IS NULL OR iserror <> '1') AND {_URINE_IN} GROUP BY icustay_id, charttime""")
def pivoted_uo(ctx):
    rows = ctx["older_outputevents"].filter(F.col("itemid").isin(URINE)).filter("iserror IS NULL OR iserror <> '1'")
    signed = F.when((F.col("itemid") == 227488) & (F.col("value") > 0), -F.col("value")).otherwise(F.col("value"))
    return rows.groupBy("icustay_id", "charttime").agg(F.sum(signed).alias("urineoutput"))


@concept("older_urine_output", ["older_outputevents"], f"""
SELECT icustay_id, charttime, sum(CASE WHEN itemid = 227488 THEN -1 * value ELSE value END) AS value FROM older_outputevents
WHERE {_URINE_IN} AND value < 5000 AND icustay_id IS NOT NULL GROUP BY icustay_id, charttime""")
def older_urine_output(ctx):
    rows = ctx["older_outputevents"].filter(F.col("itemid").isin(URINE) & (F.col("value") < 5000) & F.col("icustay_id").isNotNull())
    return rows.groupBy("icustay_id", "charttime").agg(F.sum(F.when(F.col("itemid") == 227488, -F.col("value")).otherwise(F.col("value"))).alias("value"))


def windows_sql(table: str, id_: str, start: str, end: str, before: str = "second", after: str = "second") -> str:
    """Ownership windows; half a gap is counted in ``before`` and ``after``, rounded."""
    half = lambda unit, a, b: f"CAST(round(date_diff('{unit}', {a}, {b}) / CAST(2 AS DOUBLE)) AS BIGINT) * INTERVAL '1' {unit.upper()}"
    return f"""SELECT subject_id, {id_}, CASE WHEN po > {start} - INTERVAL '24' HOUR THEN {start} - {half(before, 'po', start)} ELSE {start} - INTERVAL '12' HOUR END AS data_start,
 CASE WHEN ni < {end} + INTERVAL '24' HOUR THEN {end} + {half(after, end, 'ni')} ELSE {end} + INTERVAL '12' HOUR END AS data_end
 FROM (SELECT *, lag({end}) OVER w AS po, lead({start}) OVER w AS ni FROM {table} WINDOW w AS (PARTITION BY subject_id ORDER BY {start}, {id_})) x"""


def stay_windows(ctx, before: str = "SECOND", after: str = "SECOND") -> DataFrame:
    return ownership_windows(ctx["older_icustays"], "subject_id", "icustay_id", "intime", "outtime", units=(before, after)).select("subject_id", "icustay_id", "data_start", "data_end")


def admission_windows(ctx) -> DataFrame:
    return ownership_windows(ctx["older_admissions"], "subject_id", "hadm_id", "admittime", "dischtime").select("subject_id", "hadm_id", "data_start", "data_end")


_LABS = [item(n, *codes, agg="avg", most=top) for n, (codes, _, top) in LABS.items()]


@concept("pivoted_lab", ["older_labevents", "older_icustays", "older_admissions"], f"""
WITH a AS ({windows_sql('older_admissions', 'hadm_id', 'admittime', 'dischtime')}), i AS ({windows_sql('older_icustays', 'icustay_id', 'intime', 'outtime')}),
l AS ({pivot_sql('older_labevents', ['subject_id', 'charttime'], [], _LABS, 'valuenum > 0')})
SELECT i.icustay_id, a.hadm_id, l.* FROM l LEFT JOIN a ON a.subject_id = l.subject_id AND l.charttime >= a.data_start AND l.charttime < a.data_end
LEFT JOIN i ON i.subject_id = l.subject_id AND l.charttime >= i.data_start AND l.charttime < i.data_end""")
def pivoted_lab(ctx):
    """Laboratory values per time, given to the admission and the stay whose window they fall in."""
    labs = pivot(ctx["older_labevents"], ["subject_id", "charttime"], [], _LABS, F.expr("valuenum > 0"))
    for windows in (admission_windows(ctx), stay_windows(ctx)):
        labs = interval_join(labs, windows, ["subject_id"], "charttime", "data_start", "data_end", closed="left", how="left").drop("data_start", "data_end")
    return labs


_GAS_MEAN = _gas("avg")


@concept("pivoted_bg", ["older_labevents", "older_icustays", "older_admissions"], f"""
WITH i AS ({windows_sql('older_icustays', 'icustay_id', 'intime', 'outtime', 'hour', 'minute')}),
g AS ({pivot_sql('older_labevents', ['hadm_id', 'charttime'], [], _GAS_MEAN)})
SELECT i.icustay_id, g.hadm_id, g.charttime, specimen, {', '.join(GAS)} FROM g JOIN older_admissions a ON a.hadm_id = g.hadm_id
LEFT JOIN i ON i.subject_id = a.subject_id AND g.charttime >= i.data_start AND g.charttime < i.data_end WHERE coalesce(_specimens, 0) < 2""")
def pivoted_bg(ctx):
    """Blood gases per admission and time, except times with two specimens."""
    gas = pivot(ctx["older_labevents"], ["hadm_id", "charttime"], [], _GAS_MEAN).filter("coalesce(_specimens, 0) < 2")
    gas = gas.join(ctx["older_admissions"].select("hadm_id", "subject_id"), "hadm_id")
    out = interval_join(gas, stay_windows(ctx, "HOUR", "MINUTE"), ["subject_id"], "charttime", "data_start", "data_end", closed="left", how="left")
    return out.select("icustay_id", "hadm_id", "charttime", "specimen", *GAS)


#: Inspired fraction in per cent from either system.
CHART_FIO2 = Item("fio2_chartevents", (Part((223835,), above=0, most=1, times=100.0), Part((223835,), least=21, most=100), Part((3420, 3422)), Part((190,), above=0.2, below=1, times=100.0)))
_SPO2 = item("spo2", 646, 220277, agg="avg", above=0, most=100)
# Weights of the model that tells arterial samples, and of its terms where a value is missing.
ARTERIAL = {
    "spo2": (-0.15356, 97.49420, 0.13429), "fio2_chartevents": (0.00621, 51.49550, -0.24958), "hemoglobin": (0.10559, 10.32307, 0.05954), "so2": (0.13251, 93.66539, -0.23172), "pco2": (-0.01511, 42.08866, -0.01630),
    "fio2": (0.01480, 63.97836, -0.31142), "aado2": (-0.00200, 442.21186, -0.01328), "bicarbonate": (-0.03220, 22.96894, -0.06535), "totalco2": (0.05384, 24.72632, -0.01405), "lactate": (0.08202, 3.06436, 0.06038),
    "ph": (0.10956, 7.36233, -0.00617), "o2flow": (0.00848, 7.59362, -0.35803),
}
_TERMS_SQL = "CAST(-0.02544 AS DOUBLE) + CAST(0.04598 AS DOUBLE) * po2" + "".join(
    f" + coalesce(CAST({w} AS DOUBLE) * {c}, CAST({w} AS DOUBLE) * CAST({m} AS DOUBLE) + CAST({r} AS DOUBLE))" for c, (w, m, r) in ARTERIAL.items()
)
_PRED_SQL = f"round(1 / (1 + exp(-({_TERMS_SQL}))), 9)"


def _arterial(gas: DataFrame, keys: list[str], row: list[str], spo2: DataFrame, fio2: DataFrame, ratio: str, first: list[str]) -> DataFrame:
    """Gases known or predicted to be arterial, with the saturation and fraction charted last before them."""
    gas = gas.filter("po2 IS NOT NULL")
    gas = asof_join(gas, spo2.withColumnRenamed("charttime", "_at"), keys, "charttime", "_at", ["spo2"], 2)
    gas = asof_join(gas, fio2.withColumnRenamed("charttime", "_at"), keys, "charttime", "_at", ["fio2_chartevents"], 4)
    terms = F.lit(-0.02544) + 0.04598 * F.col("po2")
    for c, (weight, mean, rest) in ARTERIAL.items():
        terms = terms + F.coalesce(weight * F.col(c), F.lit(weight) * F.lit(mean) + F.lit(rest))
    gas = gas.withColumn("specimen_prob", F.round(logistic(terms), 9)).filter("specimen = 'ART' OR specimen_prob > 0.75")
    fraction = F.coalesce("fio2", "fio2_chartevents")
    return gas.select(
        *first, "charttime", "specimen", F.coalesce("specimen", F.when(F.col("specimen_prob") > 0.75, "ART")).alias("specimen_pred"), "specimen_prob", "so2", "spo2", "po2", "pco2", "fio2_chartevents", "fio2", "aado2",
        num(fraction / 100 * (760 - 47) - F.col("pco2") / 0.8 - F.col("po2"), 6).alias("aado2_calc"), num(100 * F.col("po2") / fraction, 6).alias(ratio), *ARTERIAL_OUT,
    )


ARTERIAL_OUT = [
    "ph", "baseexcess", "bicarbonate", "totalco2", "hematocrit", "hemoglobin", "carboxyhemoglobin", "methemoglobin", "chloride", "calcium", "temperature", "potassium", "sodium", "lactate", "glucose",
    "intubated", "tidalvolume", "ventilationrate", "ventilator", "peep", "o2flow", "requiredo2",
]


def _arterial_sql(gas: str, key: str, first: str, spo2: str, fio2: str, ratio: str) -> str:
    latest = lambda t, v, h: f"(SELECT max_by(s.{v}, s.charttime) FROM (SELECT charttime, coalesce({v}, -1) AS {v}, {key} FROM {t}) s WHERE s.{key} = g.{key} AND s.charttime BETWEEN g.charttime - INTERVAL '{h}' HOUR AND g.charttime)"
    frac = "coalesce(fio2, fio2_chartevents)"
    dec = lambda x: f"CAST(round(CAST({x} AS DECIMAL(38,9)), 6) AS DOUBLE)"
    return f"""
WITH s AS ({spo2}), f AS ({fio2}),
b AS (SELECT g.*, nullif({latest('s', 'spo2', 2)}, -1) AS spo2, nullif({latest('f', 'fio2_chartevents', 4)}, -1) AS fio2_chartevents FROM {gas} g WHERE po2 IS NOT NULL),
p AS (SELECT *, {_PRED_SQL} AS specimen_prob FROM b)
SELECT {first}, charttime, specimen, coalesce(specimen, CASE WHEN specimen_prob > CAST(0.75 AS DOUBLE) THEN 'ART' END) AS specimen_pred, specimen_prob, so2, spo2, po2, pco2, fio2_chartevents, fio2, aado2,
 {dec(f"{frac} / 100 * (760 - 47) - pco2 / CAST(0.8 AS DOUBLE) - po2")} AS aado2_calc, {dec(f"100 * po2 / {frac}")} AS {ratio}, {', '.join(ARTERIAL_OUT)}
FROM p WHERE specimen = 'ART' OR specimen_prob > CAST(0.75 AS DOUBLE)"""


_FIO2_ROWS = f"{RIGHT} AND valuenum > 0 AND valuenum < 100"


@concept("pivoted_bg_art", ["pivoted_bg", "older_chartevents"], _arterial_sql(
    "pivoted_bg", "hadm_id", "hadm_id, icustay_id", pivot_sql("older_chartevents", ["hadm_id", "charttime"], [], [_SPO2], "valuenum > 0 AND valuenum <= 100"),
    f"SELECT * FROM ({pivot_sql('older_chartevents', ['hadm_id', 'charttime'], [], [CHART_FIO2], _FIO2_ROWS)}) x WHERE fio2_chartevents > 0", "pao2fio2ratio"))
def pivoted_bg_art(ctx):
    charted = ctx["older_chartevents"]
    spo2 = pivot(charted, ["hadm_id", "charttime"], [], [_SPO2], F.expr("valuenum > 0 AND valuenum <= 100"))
    fio2 = pivot(charted, ["hadm_id", "charttime"], [], [CHART_FIO2], F.expr(_FIO2_ROWS)).filter("fio2_chartevents > 0")
    return _arterial(ctx["pivoted_bg"], ["hadm_id"], ["hadm_id", "charttime"], spo2, fio2, "pao2fio2ratio", ["hadm_id", "icustay_id"])


_LAB_FIO2 = item("fio2", 50816, least=20, most=100, digits=2)
_ROUND_FIO2 = replace(CHART_FIO2, digits=2)


@concept("pivoted_fio2", ["older_labevents", "older_chartevents", "older_icustays"], f"""
WITH l AS ({pivot_sql('older_labevents', ['hadm_id', 'charttime'], [], [_LAB_FIO2])}), c AS ({pivot_sql('older_chartevents', ['hadm_id', 'charttime'], [], [_ROUND_FIO2], _FIO2_ROWS)})
SELECT i.icustay_id, coalesce(l.charttime, c.charttime) AS charttime, coalesce(fio2, fio2_chartevents) AS fio2 FROM l FULL JOIN c ON c.hadm_id = l.hadm_id AND c.charttime = l.charttime
JOIN older_icustays i ON i.hadm_id = coalesce(l.hadm_id, c.hadm_id) AND coalesce(l.charttime, c.charttime) BETWEEN i.intime - INTERVAL '12' HOUR AND i.outtime + INTERVAL '12' HOUR""")
def pivoted_fio2(ctx):
    """Inspired fraction of the gas or, without one, of the chart, in and twelve hours around each stay."""
    lab = pivot(ctx["older_labevents"], ["hadm_id", "charttime"], [], [_LAB_FIO2])
    chart = pivot(ctx["older_chartevents"], ["hadm_id", "charttime"], [], [_ROUND_FIO2], F.expr(_FIO2_ROWS))
    both = lab.join(chart, ["hadm_id", "charttime"], "full").select("hadm_id", "charttime", F.coalesce("fio2", "fio2_chartevents").alias("fio2"))
    stays = ctx["older_icustays"].select("hadm_id", "icustay_id", (F.col("intime") - hours(12)).alias("_s"), (F.col("outtime") + hours(12)).alias("_e"))
    return interval_join(both, stays, ["hadm_id"], "charttime", "_s", "_e").select("icustay_id", "charttime", "fio2")


_TUBED = (Part((723,), text="1.0 ET/Trach", const=0.0), Part((223900,), text="No Response-ETT", const=0.0))
COMA = [
    item("gcsmotor", 454, 223901), Item("gcsverbal", (*_TUBED, Part((723, 223900)))), item("gcseyes", 184, 220739), Item("tube", tuple(replace(p, const=1.0) for p in _TUBED)),
]
_COMA_NORMAL = {"gcsmotor": 6.0, "gcsverbal": 5.0, "gcseyes": 4.0}
_COMA_SQL = """p AS (SELECT *, lag(charttime) OVER w > charttime - INTERVAL '6' HOUR AND icustay_id IS NOT NULL AS near, lag(gcsmotor) OVER w AS lm, lag(gcsverbal) OVER w AS lv, lag(gcseyes) OVER w AS le FROM b WINDOW w AS (PARTITION BY icustay_id ORDER BY charttime)),
q AS (SELECT *, CASE WHEN near THEN lm END AS pm, CASE WHEN near THEN lv END AS pv, CASE WHEN near THEN le END AS pe FROM p),
g AS (SELECT icustay_id, charttime, CASE WHEN gcsverbal = 0 OR (gcsverbal IS NULL AND pv = 0) THEN CAST(15 AS DOUBLE) WHEN pv = 0 THEN coalesce(gcsmotor, 6) + coalesce(gcsverbal, 5) + coalesce(gcseyes, 4)
  ELSE coalesce(gcsmotor, pm, 6) + coalesce(gcsverbal, pv, 5) + coalesce(gcseyes, pe, 4) END AS gcs,
  coalesce(gcsmotor, pm) AS gcsmotor, coalesce(gcsverbal, pv) AS gcsverbal, coalesce(gcseyes, pe) AS gcseyes, {flag} AS endotrachflag FROM q)"""


def _coma(base: DataFrame, flag: Column) -> DataFrame:
    """Coma scale with components carried forward for at most six hours; a tube counts as fully alert."""
    p = previous_within(base, ["icustay_id"], "charttime", list(_COMA_NORMAL), hours(6))
    p = p.withColumns({f"prev_{c}": F.when(F.col("icustay_id").isNotNull(), F.col(f"prev_{c}")) for c in _COMA_NORMAL})
    fresh = sum((F.coalesce(c, F.lit(n)) for c, n in _COMA_NORMAL.items()), F.lit(0.0))
    carried = sum((F.coalesce(c, f"prev_{c}", F.lit(n)) for c, n in _COMA_NORMAL.items()), F.lit(0.0))
    tubed = (F.col("gcsverbal") == 0) | (F.col("gcsverbal").isNull() & (F.col("prev_gcsverbal") == 0))
    total = F.when(tubed, 15.0).when(F.col("prev_gcsverbal") == 0, fresh).otherwise(carried)
    return p.select("icustay_id", "charttime", total.alias("gcs"), *[F.coalesce(c, f"prev_{c}").alias(c) for c in _COMA_NORMAL], flag.cast("int").alias("endotrachflag"))


@concept("pivoted_gcs", ["older_chartevents"], f"WITH b AS ({pivot_sql('older_chartevents', ['icustay_id', 'charttime'], [], COMA, RIGHT)}), {_COMA_SQL.format(flag='CAST(coalesce(tube, 0) AS INT)')} SELECT * FROM g")
def pivoted_gcs(ctx):
    return _coma(pivot(ctx["older_chartevents"], ["icustay_id", "charttime"], [], COMA, F.expr(RIGHT)), F.coalesce("tube", F.lit(0)))


# the first day of a stay


def first_day(ctx, table: str, on: list[str], hours_before: int = 0) -> DataFrame:
    """Rows of ``table`` within a day after the stay began, and ``hours_before``; all of the stay's columns."""
    return anchored_join(ctx["older_icustays"], ctx[table], on, "intime", "charttime", hours(hours_before), hours(24), how="inner")


def _all_stays(ctx, rows: DataFrame) -> DataFrame:
    return ctx["older_icustays"].select(*STAY).join(rows.drop("subject_id", "hadm_id"), "icustay_id", "left")


_DAY_VITALS = [replace(it, name=f"{it.name}_{name}", agg=agg, digits=6 if it.name == "tempc" else None) for it in VITALS for name, agg in (("min", "min"), ("max", "max"), ("mean", "avg"))]
_DAY_LABS = [item(f"{n}_{agg}", *codes, *more, agg=agg, most=top) for n, (codes, more, top) in LABS.items() for agg in ("min", "max")]
_KEYED = "i.subject_id, i.hadm_id, i.icustay_id"


@concept("vitals_first_day", ["older_icustays", "older_chartevents"], f"""
WITH r AS (SELECT {_KEYED}, c.itemid, c.value, c.valuenum FROM older_icustays i JOIN older_chartevents c ON c.icustay_id = i.icustay_id AND c.charttime BETWEEN i.intime AND i.intime + INTERVAL '1' DAY
  AND date_diff('second', i.intime, c.charttime) > 0 AND date_diff('hour', i.intime, c.charttime) <= 24 AND (error IS NULL OR error = 0)) {pivot_sql('r', STAY, [], _DAY_VITALS)}""")
def vitals_first_day(ctx):
    rows = first_day(ctx, "older_chartevents", ["subject_id", "hadm_id", "icustay_id"]).filter("error IS NULL OR error = 0")
    t, s = F.col("charttime"), F.col("intime")
    return pivot(rows.filter((dt_diff(t, s, "SECOND") > 0) & (dt_diff(t, s, "HOUR") <= 24)), STAY, [], _DAY_VITALS)


@concept("labs_first_day", ["older_icustays", "older_labevents"], f"""
WITH r AS (SELECT {_KEYED}, l.itemid, l.value, l.valuenum FROM older_icustays i JOIN older_labevents l ON l.subject_id = i.subject_id AND l.hadm_id = i.hadm_id AND l.charttime BETWEEN i.intime - INTERVAL '6' HOUR AND i.intime + INTERVAL '1' DAY AND valuenum > 0),
p AS ({pivot_sql('r', STAY, [], _DAY_LABS)}) SELECT {_KEYED}, p.* EXCLUDE (subject_id, hadm_id, icustay_id) FROM older_icustays i LEFT JOIN p ON p.icustay_id = i.icustay_id""")
def labs_first_day(ctx):
    return _all_stays(ctx, pivot(first_day(ctx, "older_labevents", ["subject_id", "hadm_id"], 6).filter("valuenum > 0"), STAY, [], _DAY_LABS))


@concept("urine_output_first_day", ["older_icustays", "older_outputevents"], f"""
SELECT {_KEYED}, sum(CASE WHEN itemid = 227488 AND value > 0 THEN -1 * value ELSE value END) AS urineoutput FROM older_icustays i JOIN older_outputevents o ON o.icustay_id = i.icustay_id AND o.charttime BETWEEN i.intime AND i.intime + INTERVAL '1' DAY
WHERE {_URINE_IN} GROUP BY ALL""")
def urine_output_first_day(ctx):
    rows = first_day(ctx, "older_outputevents", ["subject_id", "hadm_id", "icustay_id"]).filter(F.col("itemid").isin(URINE))
    return rows.groupBy(*STAY).agg(F.sum(F.when((F.col("itemid") == 227488) & (F.col("value") > 0), -F.col("value")).otherwise(F.col("value"))).alias("urineoutput"))


@concept("gcs_first_day", ["older_icustays", "older_chartevents"], f"""
WITH r AS (SELECT c.icustay_id, c.charttime, c.itemid, c.value, c.valuenum FROM older_icustays i JOIN older_chartevents c ON c.icustay_id = i.icustay_id AND c.charttime BETWEEN i.intime AND i.intime + INTERVAL '1' DAY AND (error IS NULL OR error = 0)),
b AS ({pivot_sql('r', ['icustay_id', 'charttime'], [], COMA)}), {_COMA_SQL.format(flag='CASE WHEN gcsverbal = 0 THEN 1 ELSE 0 END')},
m AS (SELECT *, row_number() OVER (PARTITION BY icustay_id ORDER BY gcs, charttime) AS n FROM g)
SELECT {_KEYED}, gcs AS mingcs, gcsmotor, gcsverbal, gcseyes, endotrachflag FROM older_icustays i LEFT JOIN m ON m.icustay_id = i.icustay_id AND n = 1""")
def gcs_first_day(ctx):
    """The lowest coma scale of the first day."""
    rows = first_day(ctx, "older_chartevents", ["subject_id", "hadm_id", "icustay_id"]).filter("error IS NULL OR error = 0")
    base = pivot(rows, ["icustay_id", "charttime"], [], COMA)
    coma = _coma(base, F.coalesce(F.col("gcsverbal") == 0, F.lit(False)))
    low = coma.withColumn("n", F.row_number().over(Window.partitionBy("icustay_id").orderBy("gcs", "charttime"))).filter("n = 1")
    return _all_stays(ctx, low.drop("n", "charttime").withColumnRenamed("gcs", "mingcs"))


_GAS_MOST = _gas("max", ("baseexcess",))


@concept("blood_gas_first_day", ["older_icustays", "older_labevents"], f"""
WITH r AS (SELECT i.icustay_id, l.charttime, l.itemid, l.value, l.valuenum FROM older_icustays i JOIN older_labevents l ON l.subject_id = i.subject_id AND l.hadm_id = i.hadm_id AND l.charttime BETWEEN i.intime - INTERVAL '6' HOUR AND i.intime + INTERVAL '1' DAY),
p AS ({pivot_sql('r', ['icustay_id', 'charttime'], [], _GAS_MOST)}) SELECT {_KEYED}, charttime, specimen, {', '.join(GAS)} FROM older_icustays i LEFT JOIN p ON p.icustay_id = i.icustay_id""")
def blood_gas_first_day(ctx):
    gas = pivot(first_day(ctx, "older_labevents", ["subject_id", "hadm_id"], 6), ["icustay_id", "charttime"], [], _GAS_MOST)
    return _all_stays(ctx, gas.select("icustay_id", "charttime", "specimen", *GAS))


_DAY_SPO2 = replace(_SPO2, agg="max")


@concept("blood_gas_first_day_arterial", ["blood_gas_first_day", "older_chartevents"], _arterial_sql(
    "blood_gas_first_day", "icustay_id", "subject_id, hadm_id, icustay_id", pivot_sql("older_chartevents", ["icustay_id", "charttime"], [], [_DAY_SPO2]),
    pivot_sql("older_chartevents", ["icustay_id", "charttime"], [], [CHART_FIO2], "(error IS NULL OR error = 0)"), "pao2fio2"))
def blood_gas_first_day_arterial(ctx):
    charted = ctx["older_chartevents"]
    spo2 = pivot(charted, ["icustay_id", "charttime"], [], [_DAY_SPO2])
    fio2 = pivot(charted, ["icustay_id", "charttime"], [], [CHART_FIO2], F.expr("error IS NULL OR error = 0"))
    return _arterial(ctx["blood_gas_first_day"], ["icustay_id"], ["icustay_id", "charttime"], spo2, fio2, "pao2fio2", STAY)


# fluids: transfusions, their running totals, and boluses

# Codes of transfused products, before the stay as well, and what an uncharted unit holds.
TRANSFUSIONS = {
    "rbc": ([30179, 30001, 30004], 225168, [42324, 42588, 42239, 46407, 46612, 46124, 42740], 227070, 375, False),
    "ffp": ([30005, 30180], 220970, [44172, 44236, 46410, 46418, 46684, 44819, 46530, 44044, 46122, 45669, 42323], 227072, 200, True),
}


def _in(codes) -> str:
    return ", ".join(map(str, codes))


def _transfusion(name: str, charted, ordered, before, before_ordered, unit, positive) -> None:
    dec = lambda x: f"CAST(round(CAST({x} AS DECIMAL(38,9)), 2) AS DOUBLE)"

    @concept(f"{name}_transfusion", ["older_fluids_cv", "older_fluids_mv"], f"""
WITH r AS (SELECT CASE WHEN amount IS NOT NULL THEN amount WHEN stopped IS NOT NULL THEN 0 ELSE {unit} END AS amount, amountuom, icustay_id, charttime FROM older_fluids_cv WHERE itemid IN ({_in(charted)}) AND icustay_id IS NOT NULL {'AND amount > 0' if positive else ''}
  UNION ALL SELECT amount, amountuom, icustay_id, endtime FROM older_fluids_mv WHERE itemid = {ordered} AND amount > 0 AND icustay_id IS NOT NULL),
b AS (SELECT icustay_id, sum(amount) AS before FROM older_fluids_cv WHERE itemid IN ({_in(before)}) AND amount > 0 AND icustay_id IS NOT NULL GROUP BY 1
  UNION ALL SELECT icustay_id, sum(amount) FROM older_fluids_mv WHERE itemid = {before_ordered} AND amount > 0 AND icustay_id IS NOT NULL GROUP BY 1),
c AS (SELECT *, sum(amount) OVER (PARTITION BY icustay_id ORDER BY charttime DESC) AS total, date_diff('hour', charttime, lag(charttime) OVER (PARTITION BY icustay_id ORDER BY charttime, amount)) AS delta FROM r),
d AS (SELECT c.icustay_id, c.charttime, total, amountuom, before FROM c LEFT JOIN b ON b.icustay_id = c.icustay_id WHERE delta IS NULL OR delta < -1)
SELECT icustay_id, charttime, {dec("total - coalesce(lag(total) OVER (PARTITION BY icustay_id ORDER BY charttime DESC, total, before), 0)")} AS amount, {dec('total + coalesce(before, 0)')} AS totalamount, amountuom FROM d""")
    def build(ctx):
        """Running totals from the end of the stay back; readings within an hour of the one before count as one."""
        cv, mv = ctx["older_fluids_cv"], ctx["older_fluids_mv"]
        cv_rows = cv.filter(F.col("itemid").isin(charted) & F.col("icustay_id").isNotNull() & ((F.col("amount") > 0) if positive else F.lit(True)))
        given = F.when(F.col("amount").isNotNull(), F.col("amount")).when(F.col("stopped").isNotNull(), 0.0).otherwise(float(unit))
        mv_rows = mv.filter((F.col("itemid") == ordered) & (F.col("amount") > 0) & F.col("icustay_id").isNotNull())
        rows = cv_rows.select(given.alias("amount"), "amountuom", "icustay_id", "charttime").unionByName(mv_rows.select("amount", "amountuom", "icustay_id", F.col("endtime").alias("charttime")))
        held = lambda df, codes: df.filter(F.col("itemid").isin(codes) & (F.col("amount") > 0) & F.col("icustay_id").isNotNull()).groupBy("icustay_id").agg(F.sum("amount").alias("before"))
        early = held(cv, before).unionByName(held(mv, [before_ordered]))
        w = Window.partitionBy("icustay_id")
        rows = rows.withColumn("total", F.sum("amount").over(w.orderBy(F.desc("charttime")).rangeBetween(Window.unboundedPreceding, 0)))
        rows = rows.withColumn("delta", dt_diff(F.lag("charttime").over(w.orderBy("charttime", "amount")), F.col("charttime"), "HOUR"))
        kept = rows.filter("delta IS NULL OR delta < -1").join(early, "icustay_id", "left")
        later = F.lag("total").over(w.orderBy(F.desc("charttime"), "total", F.col("before").asc_nulls_last()))
        return kept.select("icustay_id", "charttime", num(F.col("total") - F.coalesce(later, F.lit(0.0)), 2).alias("amount"), num(F.col("total") + F.coalesce("before", F.lit(0.0)), 2).alias("totalamount"), "amountuom")


for _name, _rule in TRANSFUSIONS.items():
    _transfusion(_name, *_rule)

# Codes of colloids and of crystalloids in the ordering and in the charting system.
COLLOID_ORDERS, COLLOIDS = [220864, 220862, 225174, 225795, 225796], [30008, 30009, 42832, 40548, 45403, 44203, 30181, 46564, 43237, 43353, 30012, 46313, 30011, 30016, 42975, 42944, 46336, 46729, 40033, 45410, 42731]
COLLOID_READINGS = [2510, 3087, 6937, 3088]


@concept("colloid_bolus", ["older_fluids_cv", "older_fluids_mv", "older_chartevents"], f"""
WITH a AS (SELECT icustay_id, starttime AS charttime, round(CASE WHEN amountuom = 'L' THEN amount * 1000 WHEN amountuom = 'ml' THEN amount END) AS amount FROM older_fluids_mv WHERE itemid IN ({_in(COLLOID_ORDERS)}) AND statusdescription <> 'Rewritten'
  AND ((rateuom = 'mL/hour' AND rate > 100) OR (rateuom = 'mL/min' AND rate > 100 / CAST(60 AS DOUBLE)) OR (rateuom = 'mL/kg/hour' AND rate * patientweight > 100))),
b AS (SELECT icustay_id, charttime, round(amount) AS amount FROM older_fluids_cv WHERE itemid IN ({_in(COLLOIDS)}) AND amount > 100 AND amount < 2000),
c AS (SELECT icustay_id, charttime, round(valuenum) AS amount FROM older_chartevents WHERE itemid IN ({_in(COLLOID_READINGS)}) AND valuenum > 100 AND valuenum < 2000)
SELECT icustay_id, charttime, sum(amount) AS colloid_bolus FROM a WHERE amount > 100 GROUP BY 1, 2 UNION ALL SELECT icustay_id, charttime, sum(amount) FROM b GROUP BY 1, 2 UNION ALL SELECT icustay_id, charttime, sum(amount) FROM c GROUP BY 1, 2""")
def colloid_bolus(ctx):
    fast = "(rateuom = 'mL/hour' AND rate > 100) OR (rateuom = 'mL/min' AND rate > 100 / 60D) OR (rateuom = 'mL/kg/hour' AND rate * patientweight > 100)"
    ordered = _bolus_orders(ctx["older_fluids_mv"], COLLOID_ORDERS, fast).filter("amount > 100")
    charted = ctx["older_fluids_cv"].filter(F.col("itemid").isin(COLLOIDS)).filter("amount > 100 AND amount < 2000").select("icustay_id", "charttime", F.round("amount").alias("amount"))
    read = ctx["older_chartevents"].filter(F.col("itemid").isin(COLLOID_READINGS)).filter("valuenum > 100 AND valuenum < 2000").select("icustay_id", "charttime", F.round("valuenum").alias("amount"))
    total = lambda df: df.groupBy("icustay_id", "charttime").agg(F.sum("amount").alias("colloid_bolus"))
    return total(ordered).unionByName(total(charted)).unionByName(total(read))


def _bolus_orders(mv: DataFrame, codes: list[int], fast: str) -> DataFrame:
    amount = F.when(F.col("amountuom") == "L", F.col("amount") * 1000).when(F.col("amountuom") == "ml", F.col("amount"))
    rows = mv.filter(F.col("itemid").isin(codes) & (F.col("statusdescription") != "Rewritten")).filter(fast)
    return rows.select("icustay_id", F.col("starttime").alias("charttime"), F.round(amount).alias("amount"))


CRYSTALLOID_ORDERS = [225158, 225828, 225944, 225797, 225159, 225823, 225825, 225827, 225941, 226089]
CRYSTALLOIDS = [
    30015, 30018, 30020, 30021, 30058, 30060, 30061, 30063, 30065, 30159, 30160, 30169, 30190, 40850, 41491, 42639, 42187, 43819, 41430, 40712, 44160, 42383, 42297, 42453, 40872, 41915, 41490, 46501, 45045, 41984, 41371, 41582,
    41322, 40778, 41896, 41428, 43936, 44200, 41619, 40424, 41457, 41581, 42844, 42429, 41356, 40532, 42548, 44184, 44521, 44741, 44126, 44110, 44633, 44983, 44815, 43986, 45079, 46781, 45155, 43909, 41467, 44367, 41743, 40423,
    44263, 42749, 45480, 44491, 41695, 46169, 41580, 41392, 45989, 45137, 45154, 44053, 41416, 44761, 41237, 44426, 43975, 44894, 41380, 42671,
]
_FAST = "((rateuom = 'mL/hour' AND rate > 248) OR (rateuom = 'mL/min' AND rate > 248 / CAST(60 AS DOUBLE)) OR (rate IS NULL AND amountuom = 'L' AND amount > 0.248) OR (rate IS NULL AND amountuom = 'ml' AND amount > 248))"


@concept("crystalloid_bolus", ["older_fluids_cv", "older_fluids_mv"], f"""
WITH a AS (SELECT icustay_id, starttime AS charttime, round(CASE WHEN amountuom = 'L' THEN amount * 1000 WHEN amountuom = 'ml' THEN amount END) AS amount FROM older_fluids_mv WHERE itemid IN ({_in(CRYSTALLOID_ORDERS)}) AND statusdescription <> 'Rewritten' AND {_FAST}),
b AS (SELECT icustay_id, charttime, round(amount) AS amount FROM older_fluids_cv WHERE itemid IN ({_in(CRYSTALLOIDS)}) AND amount > 248 AND amount <= 2000 AND amountuom = 'ml')
SELECT icustay_id, charttime, sum(amount) AS crystalloid_bolus FROM a WHERE amount > 248 GROUP BY 1, 2 UNION SELECT icustay_id, charttime, sum(amount) FROM b GROUP BY 1, 2""")
def crystalloid_bolus(ctx):
    ordered = _bolus_orders(ctx["older_fluids_mv"], CRYSTALLOID_ORDERS, _FAST).filter("amount > 248")
    charted = ctx["older_fluids_cv"].filter(F.col("itemid").isin(CRYSTALLOIDS)).filter("amount > 248 AND amount <= 2000 AND amountuom = 'ml'").select("icustay_id", "charttime", F.round("amount").alias("amount"))
    total = lambda df: df.groupBy("icustay_id", "charttime").agg(F.sum("amount").alias("crystalloid_bolus"))
    return total(ordered).unionByName(total(charted)).distinct()
