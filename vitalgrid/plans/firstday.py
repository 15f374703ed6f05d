"""Summaries of the first day of each stay."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.dt import days, hours
from vitalgrid.functions.scalar import num, step_score
from vitalgrid.operators.joins import anchored_join, interval_join
from vitalgrid.operators.pivot import summary, summary_sql
from vitalgrid.plans.registry import concept

STAY = ["subject_id", "stay_id"]
VITALS = ["heart_rate", "sbp", "dbp", "mbp", "resp_rate", "temperature", "spo2", "glucose"]
GAS = [
    "lactate", "ph", "so2", "po2", "pco2", "aado2", "aado2_calc", "pao2fio2ratio", "baseexcess", "bicarbonate", "totalco2", "hematocrit", "hemoglobin", "carboxyhemoglobin",
    "methemoglobin", "temperature", "chloride", "calcium", "glucose", "potassium", "sodium",
]
LABS = {
    "complete_blood_count": {"hematocrit": "hematocrit", "hemoglobin": "hemoglobin", "platelet": "platelets", "wbc": "wbc"},
    "chemistry": {c: c for c in ("albumin", "globulin", "total_protein", "aniongap", "bicarbonate", "bun", "calcium", "chloride", "creatinine", "glucose", "sodium", "potassium")},
    "blood_differential": {f"{c}_abs": f"abs_{c}" for c in ("basophils", "eosinophils", "lymphocytes", "monocytes", "neutrophils")}
    | {"atypical_lymphocytes": "atyps", "bands": "bands", "immature_granulocytes": "imm_granulocytes", "metamyelocytes": "metas", "nrbc": "nrbc"},
    "coagulation": {c: c for c in ("d_dimer", "fibrinogen", "thrombin", "inr", "pt", "ptt")},
    "enzyme": {c: c for c in ("alt", "alp", "ast", "amylase", "bilirubin_total", "bilirubin_direct", "bilirubin_indirect", "ck_cpk", "ck_mb", "ggt", "ld_ldh")},
}


def _stays(ctx) -> DataFrame:
    return ctx["icustays"].select("subject_id", "hadm_id", "stay_id", "intime", "outtime")


def first_day(ctx, table: str, on: str, at: str = "charttime", *, before=None, where=None) -> DataFrame:
    """Stays with their rows of ``table`` from six hours before to a day after admission; stays without rows survive."""
    rows = ctx[table] if where is None else ctx[table].filter(where)
    rows = rows.drop(*[c for c in ("subject_id", "hadm_id", "stay_id") if c != on])
    return anchored_join(_stays(ctx), rows, [on], "intime", at, hours(6) if before is None else before, days(1))


def _on(table: str, key: str, at: str = "charttime", extra: str = "", before: str = "i.intime - INTERVAL '6' HOUR") -> str:
    return f"icustays i LEFT JOIN {table} t ON t.{key} = i.{key} AND t.{at} BETWEEN {before} AND i.intime + INTERVAL '1' DAY{extra}"


def _same(columns) -> dict[str, str]:
    return {c: c for c in columns}


@concept("first_day_vitalsign", ["icustays", "vitalsign"], f"SELECT i.subject_id, i.stay_id, {summary_sql(_same(VITALS), ('min', 'max', 'mean'))} FROM {_on('vitalsign', 'stay_id')} GROUP BY ALL")
def first_day_vitalsign(ctx):
    return summary(first_day(ctx, "vitalsign", "stay_id"), STAY, _same(VITALS), ("min", "max", "mean"))


def _gas(name: str, where_sql: str, where) -> None:
    @concept(name, ["icustays", "bg"], f"SELECT i.subject_id, i.stay_id, {summary_sql(_same(GAS))} FROM {_on('bg', 'subject_id', extra=where_sql)} GROUP BY ALL")
    def build(ctx):
        return summary(first_day(ctx, "bg", "subject_id", where=where), STAY, _same(GAS))


_gas("first_day_bg", "", None)
_gas("first_day_bg_art", " AND t.specimen = 'ART.'", "specimen = 'ART.'")


def _lab_sql() -> str:
    parts = [f"{t}_d AS (SELECT i.stay_id, {summary_sql(cols)} FROM {_on(t, 'subject_id')} GROUP BY 1)" for t, cols in LABS.items()]
    out = ", ".join(f"{n}_min, {n}_max" for cols in LABS.values() for n in cols.values())
    return f"WITH {', '.join(parts)} SELECT i.subject_id, i.stay_id, {out} FROM icustays i {' '.join(f'LEFT JOIN {t}_d USING (stay_id)' for t in LABS)}"


@concept("first_day_lab", ["icustays", *LABS], _lab_sql())
def first_day_lab(ctx):
    """Extremes of five panels, each summarised on its own and joined on the stay, so that no panel multiplies another."""
    out = _stays(ctx).select(*STAY)
    for table, columns in LABS.items():
        out = out.join(summary(first_day(ctx, table, "subject_id"), ["stay_id"], columns), "stay_id", "left")
    return out.select(*STAY, *[c for c in out.columns if c not in STAY])


@concept("first_day_gcs", ["icustays", "gcs"], f"""
SELECT i.subject_id, i.stay_id, arg_min(struct_pack(g := t.gcs, m := gcs_motor, v := gcs_verbal, e := gcs_eyes, u := gcs_unable), struct_pack(a := t.gcs, b := -epoch_us(t.charttime))) AS r
FROM {_on('gcs', 'stay_id')} GROUP BY 1, 2""".replace("SELECT i.subject_id", "SELECT subject_id, stay_id, r.g AS gcs_min, r.m AS gcs_motor, r.v AS gcs_verbal, r.e AS gcs_eyes, r.u AS gcs_unable FROM (SELECT i.subject_id", 1) + ") q")
def first_day_gcs(ctx):
    """The lowest score of the day, the latest of equals, with its components."""
    w = Window.partitionBy("stay_id").orderBy(F.asc_nulls_last("gcs"), F.desc_nulls_last("charttime"))
    rows = first_day(ctx, "gcs", "stay_id").withColumn("n", F.row_number().over(w)).filter("n = 1")
    return rows.select(*STAY, F.col("gcs").alias("gcs_min"), "gcs_motor", "gcs_verbal", "gcs_eyes", "gcs_unable")


@concept("first_day_height", ["icustays", "height"], f"SELECT i.subject_id, i.stay_id, CAST(round(CAST(avg(height) AS DECIMAL(38,9)), 2) AS DOUBLE) AS height FROM {_on('height', 'stay_id')} GROUP BY ALL")
def first_day_height(ctx):
    return first_day(ctx, "height", "stay_id").groupBy(*STAY).agg(num(F.avg("height"), 2).alias("height"))


@concept("first_day_weight", ["icustays", "weight_durations"], """
SELECT i.subject_id, i.stay_id, round(avg(weight) FILTER (WHERE weight_type = 'admit'), 6) AS weight_admit, round(avg(weight), 6) AS weight, min(weight) AS weight_min, max(weight) AS weight_max
FROM icustays i LEFT JOIN weight_durations w ON w.stay_id = i.stay_id AND w.starttime <= i.intime + INTERVAL '1' DAY GROUP BY ALL""")
def first_day_weight(ctx):
    stays, w = _stays(ctx), ctx["weight_durations"]
    rows = stays.join(w, (stays["stay_id"] == w["stay_id"]) & (w["starttime"] <= stays["intime"] + days(1)), "left").drop(w["stay_id"])
    admit = F.when(F.col("weight_type") == "admit", F.col("weight"))
    return rows.groupBy(*STAY).agg(F.round(F.avg(admit), 6).alias("weight_admit"), F.round(F.avg("weight"), 6).alias("weight"), F.min("weight").alias("weight_min"), F.max("weight").alias("weight_max"))


@concept("first_day_urine_output", ["icustays", "urine_output"], f"SELECT i.subject_id, i.stay_id, sum(urineoutput) AS urineoutput FROM {_on('urine_output', 'stay_id', before='i.intime')} GROUP BY ALL")
def first_day_urine_output(ctx):
    return first_day(ctx, "urine_output", "stay_id", before=hours(0)).groupBy(*STAY).agg(F.sum("urineoutput").alias("urineoutput"))


@concept("first_day_rrt", ["icustays", "rrt"], f"""
SELECT i.subject_id, i.stay_id, max(dialysis_present) AS dialysis_present, max(dialysis_active) AS dialysis_active, string_agg(DISTINCT dialysis_type, ', ' ORDER BY dialysis_type) AS dialysis_type
FROM {_on('rrt', 'stay_id')} GROUP BY ALL""")
def first_day_rrt(ctx):
    kinds = F.array_sort(F.collect_set("dialysis_type"))
    return first_day(ctx, "rrt", "stay_id").groupBy(*STAY).agg(
        F.max("dialysis_present").alias("dialysis_present"), F.max("dialysis_active").alias("dialysis_active"), F.when(F.size(kinds) > 0, F.array_join(kinds, ", ")).alias("dialysis_type")
    )


def organ_points(pafi_low, pafi_any, mbp, urine) -> dict:
    """Points of the six organ systems; the oxygen rules differ between uses and are given."""
    c = F.col
    pressors = [c(f"rate_{d}") for d in ("dopamine", "dobutamine", "epinephrine", "norepinephrine")]
    dop, dob, epi, nor = pressors
    gcs, cr = c("gcs_min"), c("creatinine_max")
    return {
        "respiration": step_score(pafi_low, 0, pafi_any.isNull()),
        "coagulation": step_score([(c("platelet_min") < b, p) for b, p in ((20, 4), (50, 3), (100, 2), (150, 1))], 0, c("platelet_min").isNull()),
        "liver": step_score([(c("bilirubin_max") >= b, p) for b, p in ((12.0, 4), (6.0, 3), (2.0, 2), (1.2, 1))], 0, c("bilirubin_max").isNull()),
        "cardiovascular": step_score(
            [((dop > 15) | (epi > 0.1) | (nor > 0.1), 4), ((dop > 5) | (epi <= 0.1) | (nor <= 0.1), 3), ((dop > 0) | (dob > 0), 2), (mbp < 70, 1)], 0, F.coalesce(mbp, *pressors).isNull()
        ),
        "cns": step_score([(gcs < 6, 4), (gcs.between(6, 9), 3), (gcs.between(10, 12), 2), (gcs.between(13, 14), 1)], 0, gcs.isNull()),
        "renal": step_score([((cr >= 5.0) | (urine < 200), 4), ((cr >= 3.5) | (urine < 500), 3), (cr >= 2.0, 2), (cr >= 1.2, 1)], 0, F.coalesce(urine, cr).isNull()),
    }


ORGAN_SQL = """
CASE WHEN platelet_min IS NULL THEN NULL WHEN platelet_min < 20 THEN 4 WHEN platelet_min < 50 THEN 3 WHEN platelet_min < 100 THEN 2 WHEN platelet_min < 150 THEN 1 ELSE 0 END AS coagulation,
CASE WHEN bilirubin_max IS NULL THEN NULL WHEN bilirubin_max >= 12 THEN 4 WHEN bilirubin_max >= 6 THEN 3 WHEN bilirubin_max >= 2 THEN 2 WHEN bilirubin_max >= 1.2 THEN 1 ELSE 0 END AS liver,
CASE WHEN greatest(rate_epinephrine, rate_norepinephrine) > 0.1 OR rate_dopamine > 15 THEN 4 WHEN rate_dopamine > 5 OR coalesce(rate_epinephrine, rate_norepinephrine) IS NOT NULL THEN 3
     WHEN rate_dopamine > 0 OR rate_dobutamine > 0 THEN 2 WHEN mbp_min < 70 THEN 1 WHEN coalesce(mbp_min, rate_dopamine, rate_dobutamine) IS NOT NULL THEN 0 END AS cardiovascular,
CASE WHEN gcs_min IS NULL THEN NULL WHEN gcs_min < 6 THEN 4 WHEN gcs_min <= 9 AND gcs_min >= 6 THEN 3 WHEN gcs_min BETWEEN 10 AND 12 THEN 2 WHEN gcs_min BETWEEN 13 AND 14 THEN 1 ELSE 0 END AS cns,
CASE WHEN creatinine_max >= 5 OR urine < 200 THEN 4 WHEN creatinine_max >= 3.5 OR urine < 500 THEN 3 WHEN creatinine_max >= 2 THEN 2 WHEN creatinine_max >= 1.2 THEN 1
     WHEN coalesce(urine, creatinine_max) IS NOT NULL THEN 0 END AS renal"""
ORGANS = ["respiration", "coagulation", "liver", "cardiovascular", "cns", "renal"]
PRESSORS = ["norepinephrine", "epinephrine", "dobutamine", "dopamine"]


@concept("first_day_sofa", ["icustays", "bg", "ventilation", "first_day_vitalsign", "first_day_lab", "first_day_urine_output", "first_day_gcs", *PRESSORS], f"""
WITH v AS ({' UNION ALL '.join(f"SELECT i.stay_id, '{d}' AS d, t.vaso_rate FROM icustays i JOIN {d} t ON t.stay_id = i.stay_id AND t.starttime BETWEEN i.intime - INTERVAL '6' HOUR AND i.intime + INTERVAL '1' DAY" for d in PRESSORS)}),
m AS (SELECT stay_id, {', '.join(f"max(vaso_rate) FILTER (WHERE d = '{d}') AS rate_{d}" for d in PRESSORS)} FROM v GROUP BY 1),
p AS (SELECT i.stay_id, min(pao2fio2ratio) FILTER (WHERE x.stay_id IS NULL) AS pn, min(pao2fio2ratio) FILTER (WHERE x.stay_id IS NOT NULL) AS pv
      FROM {_on('bg', 'subject_id', extra=" AND t.specimen = 'ART.'")} LEFT JOIN ventilation x ON x.stay_id = i.stay_id AND t.charttime BETWEEN x.starttime AND x.endtime AND x.ventilation_status = 'InvasiveVent' GROUP BY 1),
j AS (SELECT i.*, mbp_min, {', '.join(f'rate_{d}' for d in PRESSORS)}, creatinine_max, bilirubin_total_max AS bilirubin_max, platelets_min AS platelet_min, pn, pv, urineoutput AS urine, gcs_min
      FROM icustays i LEFT JOIN m USING (stay_id) LEFT JOIN p USING (stay_id) LEFT JOIN first_day_vitalsign USING (stay_id) LEFT JOIN first_day_lab USING (stay_id)
      LEFT JOIN first_day_urine_output USING (stay_id) LEFT JOIN first_day_gcs USING (stay_id)),
s AS (SELECT subject_id, hadm_id, stay_id, CASE WHEN pv < 100 THEN 4 WHEN pv < 200 THEN 3 WHEN pn < 300 THEN 2 WHEN pn < 400 THEN 1 WHEN coalesce(pv, pn) IS NULL THEN NULL ELSE 0 END AS respiration, {ORGAN_SQL} FROM j)
SELECT subject_id, hadm_id, stay_id, {' + '.join(f'coalesce({o}, 0)' for o in ORGANS)} AS sofa, {', '.join(ORGANS)} FROM s""")
def first_day_sofa(ctx):
    """Organ failure points from the first day's extremes."""
    given = None
    for d in PRESSORS:
        one = ctx[d].select("stay_id", "starttime", F.lit(d).alias("drug"), "vaso_rate")
        given = one if given is None else given.unionByName(one)
    near = anchored_join(_stays(ctx).select("stay_id", "intime"), given, ["stay_id"], "intime", "starttime", hours(6), days(1), how="inner")
    rates = near.groupBy("stay_id").agg(*[F.max(F.when(F.col("drug") == d, F.col("vaso_rate"))).alias(f"rate_{d}") for d in PRESSORS])
    gas = first_day(ctx, "bg", "subject_id", where="specimen = 'ART.'").select("stay_id", "charttime", "pao2fio2ratio")
    vent = ctx["ventilation"].filter("ventilation_status = 'InvasiveVent'").select("stay_id", "starttime", "endtime", F.lit(1).alias("vent"))
    gas = interval_join(gas, vent, ["stay_id"], "charttime", "starttime", "endtime", how="left")
    pafi = gas.groupBy("stay_id").agg(
        F.min(F.when(F.col("vent").isNull(), F.col("pao2fio2ratio"))).alias("pn"), F.min(F.when(F.col("vent") == 1, F.col("pao2fio2ratio"))).alias("pv")
    )
    j = _stays(ctx).join(rates, "stay_id", "left").join(pafi, "stay_id", "left")
    for table, cols in (
        ("first_day_vitalsign", ["mbp_min"]), ("first_day_lab", ["creatinine_max", F.col("bilirubin_total_max").alias("bilirubin_max"), F.col("platelets_min").alias("platelet_min")]),
        ("first_day_urine_output", ["urineoutput"]), ("first_day_gcs", ["gcs_min"]),
    ):
        j = j.join(ctx[table].select("stay_id", *cols), "stay_id", "left")
    pv, pn = F.col("pv"), F.col("pn")
    points = organ_points([(pv < 100, 4), (pv < 200, 3), (pn < 300, 2), (pn < 400, 1)], F.coalesce(pv, pn), F.col("mbp_min"), F.col("urineoutput"))
    s = j.select("subject_id", "hadm_id", "stay_id", *[c.alias(n) for n, c in points.items()])
    return s.withColumn("sofa", sum((F.coalesce(o, F.lit(0)) for o in ORGANS), F.lit(0)).cast("int"))
