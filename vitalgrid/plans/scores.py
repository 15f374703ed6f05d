"""Kidney stages, severity scores, infection and sepsis."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vitalgrid.functions.dt import ceil_hour, days, dt_diff, dt_trunc, hour_at, hours
from vitalgrid.functions.scalar import logistic, num, pack_points, step_score, unpack_points
from vitalgrid.operators.episodes import trailing_window
from vitalgrid.operators.joins import anchored_join, bucket_of, covered_hours, hour_summary, interval_join, trailing_hours
from vitalgrid.plans.firstday import ORGAN_SQL, ORGANS, organ_points
from vitalgrid.plans.registry import concept


def _stays(ctx):
    return ctx["icustays"].select("subject_id", "hadm_id", "stay_id", "intime", "outtime")


@concept("kdigo_creatinine", ["icustays", "labevents"], """
WITH c AS (SELECT i.hadm_id, i.stay_id, l.charttime, avg(l.valuenum) AS creat FROM icustays i LEFT JOIN labevents l ON l.subject_id = i.subject_id AND l.itemid = 50912
      AND l.valuenum <= 150 AND l.charttime BETWEEN i.intime - INTERVAL '7' DAY AND i.outtime GROUP BY ALL)
SELECT *, (SELECT min(creat) FROM c d WHERE d.stay_id = c.stay_id AND d.charttime < c.charttime AND d.charttime >= c.charttime - INTERVAL '48' HOUR) AS creat_low_past_48hr,
       (SELECT min(creat) FROM c d WHERE d.stay_id = c.stay_id AND d.charttime < c.charttime AND d.charttime >= c.charttime - INTERVAL '7' DAY) AS creat_low_past_7day FROM c""")
def kdigo_creatinine(ctx):
    """Creatinine from a week before the stay, with the lowest of the two days and the week before, now excluded."""
    labs = ctx["labevents"].filter("itemid = 50912 AND valuenum <= 150").select("subject_id", "charttime", "valuenum")
    stays = _stays(ctx)
    cond = (stays["subject_id"] == labs["subject_id"]) & (labs["charttime"] >= stays["intime"] - days(7)) & (labs["charttime"] <= stays["outtime"])
    cr = stays.join(labs, cond, "left").groupBy("hadm_id", "stay_id", "charttime").agg(F.avg("valuenum").alias("creat"))
    low = lambda h: F.min("creat").over(trailing_window(["stay_id"], "charttime", h * 3600, include_now=False))
    past = F.when(F.col("charttime").isNotNull(), low(48)), F.when(F.col("charttime").isNotNull(), low(168))
    return cr.withColumns({"creat_low_past_48hr": past[0], "creat_low_past_7day": past[1]})


@concept("kdigo_uo", ["icustays", "urine_output", "weight_durations"], """
WITH u AS (SELECT u.*, date_diff('second', i.intime, u.charttime) AS s,
        coalesce(date_diff('second', lag(u.charttime) OVER (PARTITION BY u.stay_id ORDER BY u.charttime), u.charttime) / CAST(3600 AS DOUBLE), 1) AS h
      FROM urine_output u JOIN icustays i USING (stay_id)),
""" + """t AS (SELECT stay_id, charttime, """ + ", ".join(f"sum(urineoutput) OVER w{n} AS urineoutput_{n}hr, CAST(round(CAST(sum(h) OVER w{n} AS DECIMAL(38,9)), 6) AS DOUBLE) AS uo_tm_{n}hr" for n in (6, 12, 24)) + """
      FROM u WINDOW """ + ", ".join(f"w{n} AS (PARTITION BY stay_id ORDER BY s RANGE BETWEEN {n * 3600} PRECEDING AND CURRENT ROW)" for n in (6, 12, 24)) + """)
SELECT t.stay_id, t.charttime, w.weight, urineoutput_6hr, urineoutput_12hr, urineoutput_24hr,
       CASE WHEN uo_tm_6hr >= 6 AND uo_tm_6hr < 12 THEN CAST(round(CAST(urineoutput_6hr / w.weight / uo_tm_6hr AS DECIMAL(38,9)), 4) AS DOUBLE) END AS uo_rt_6hr,
       CASE WHEN uo_tm_12hr >= 12 THEN CAST(round(CAST(urineoutput_12hr / w.weight / uo_tm_12hr AS DECIMAL(38,9)), 4) AS DOUBLE) END AS uo_rt_12hr,
       CASE WHEN uo_tm_24hr >= 24 THEN CAST(round(CAST(urineoutput_24hr / w.weight / uo_tm_24hr AS DECIMAL(38,9)), 4) AS DOUBLE) END AS uo_rt_24hr, uo_tm_6hr, uo_tm_12hr, uo_tm_24hr
FROM t LEFT JOIN weight_durations w ON w.stay_id = t.stay_id AND t.charttime >= w.starttime AND t.charttime < w.endtime""")
def kdigo_uo(ctx):
    """Urine output per weight in trailing windows of 6, 12 and 24 hours."""
    rows = ctx["urine_output"].join(_stays(ctx).select("stay_id", "intime"), "stay_id")
    w = Window.partitionBy("stay_id").orderBy("charttime")
    since = dt_diff(F.col("charttime"), F.lag("charttime").over(w), "SECOND") / 3600
    rows = rows.withColumns({"s": dt_diff(F.col("charttime"), F.col("intime"), "SECOND"), "h": F.coalesce(since, F.lit(1.0))})
    frames = {n: Window.partitionBy("stay_id").orderBy("s").rangeBetween(-n * 3600, 0) for n in (6, 12, 24)}
    rows = rows.select(
        "stay_id", "charttime", *[F.sum("urineoutput").over(f).alias(f"urineoutput_{n}hr") for n, f in frames.items()],
        *[num(F.sum("h").over(f), 6).alias(f"uo_tm_{n}hr") for n, f in frames.items()],
    )
    weights = ctx["weight_durations"].select("stay_id", F.col("starttime").alias("_s"), F.col("endtime").alias("_e"), "weight")
    out = interval_join(rows, weights, ["stay_id"], "charttime", "_s", "_e", closed="left", how="left")
    rate = lambda n: num(F.col(f"urineoutput_{n}hr") / F.col("weight") / F.col(f"uo_tm_{n}hr"), 4)
    enough = {6: (F.col("uo_tm_6hr") >= 6) & (F.col("uo_tm_6hr") < 12), 12: F.col("uo_tm_12hr") >= 12, 24: F.col("uo_tm_24hr") >= 24}
    return out.select(
        "stay_id", "charttime", "weight", *[f"urineoutput_{n}hr" for n in frames], *[F.when(enough[n], rate(n)).alias(f"uo_rt_{n}hr") for n in frames], *[f"uo_tm_{n}hr" for n in frames]
    )


@concept("kdigo_stages", ["icustays", "kdigo_creatinine", "kdigo_uo", "crrt"], """
WITH c AS (SELECT *, CASE WHEN creat >= creat_low_past_7day * 3 OR (creat >= 4 AND (creat >= creat_low_past_48hr + CAST(0.3 AS DOUBLE) OR creat >= creat_low_past_7day * 1.5)) THEN 3
        WHEN creat >= creat_low_past_7day * 2 THEN 2 WHEN creat >= creat_low_past_48hr + CAST(0.3 AS DOUBLE) OR creat >= creat_low_past_7day * 1.5 THEN 1 ELSE 0 END AS aki_stage_creat FROM kdigo_creatinine),
u AS (SELECT k.*, CASE WHEN uo_rt_6hr IS NULL THEN NULL WHEN charttime <= i.intime + INTERVAL '6' HOUR THEN 0 WHEN uo_tm_24hr >= 24 AND uo_rt_24hr < 0.3 THEN 3 WHEN uo_tm_12hr >= 12 AND uo_rt_12hr = 0 THEN 3
        WHEN uo_tm_12hr >= 12 AND uo_rt_12hr < 0.5 THEN 2 WHEN uo_tm_6hr >= 6 AND uo_rt_6hr < 0.5 THEN 1 ELSE 0 END AS aki_stage_uo FROM kdigo_uo k JOIN icustays i USING (stay_id)),
r AS (SELECT stay_id, charttime, CASE WHEN charttime IS NOT NULL THEN 3 END AS aki_stage_crrt FROM crrt WHERE crrt_mode IS NOT NULL),
t AS (SELECT stay_id, charttime FROM c UNION SELECT stay_id, charttime FROM u UNION SELECT stay_id, charttime FROM r),
j AS (SELECT i.subject_id, i.hadm_id, i.stay_id, i.intime, t.charttime, creat_low_past_7day, creat_low_past_48hr, creat, aki_stage_creat, uo_rt_6hr, uo_rt_12hr, uo_rt_24hr, aki_stage_uo, aki_stage_crrt,
        greatest(coalesce(aki_stage_creat, 0), coalesce(aki_stage_uo, 0), coalesce(aki_stage_crrt, 0)) AS aki_stage
      FROM icustays i LEFT JOIN t ON t.stay_id = i.stay_id LEFT JOIN c ON c.stay_id = i.stay_id AND c.charttime = t.charttime LEFT JOIN u ON u.stay_id = i.stay_id AND u.charttime = t.charttime
      LEFT JOIN r ON r.stay_id = i.stay_id AND r.charttime = t.charttime)
SELECT * EXCLUDE (intime), max(aki_stage) OVER (PARTITION BY subject_id ORDER BY date_diff('second', intime, charttime) NULLS FIRST RANGE BETWEEN 21600 PRECEDING AND CURRENT ROW) AS aki_stage_smoothed FROM j""")
def kdigo_stages(ctx):
    """Worst of the stages by creatinine, urine and dialysis, and its maximum over six hours.

    The smoothing window runs over the subject while its clock starts anew with each stay, as published.
    """
    c, low7, low48 = F.col("creat"), F.col("creat_low_past_7day"), F.col("creat_low_past_48hr")
    rise = (c >= low48 + 0.3) | (c >= low7 * 1.5)
    cr = ctx["kdigo_creatinine"].select("stay_id", "charttime", "creat_low_past_7day", "creat_low_past_48hr", "creat", step_score([((c >= low7 * 3) | ((c >= 4) & rise), 3), (c >= low7 * 2, 2), (rise, 1)]).alias("aki_stage_creat"))
    early = F.col("charttime") <= F.col("intime") + hours(6)
    reached = lambda n, cond: (F.col(f"uo_tm_{n}hr") >= n) & cond(F.col(f"uo_rt_{n}hr"))
    by_urine = step_score([
        (early, 0), (reached(24, lambda r: r < 0.3), 3), (reached(12, lambda r: r == 0), 3), (reached(12, lambda r: r < 0.5), 2), (reached(6, lambda r: r < 0.5), 1),
    ], 0, F.col("uo_rt_6hr").isNull())
    uo = ctx["kdigo_uo"].join(_stays(ctx).select("stay_id", "intime"), "stay_id").select("stay_id", "charttime", "uo_rt_6hr", "uo_rt_12hr", "uo_rt_24hr", by_urine.alias("aki_stage_uo"))
    dialysed = ctx["crrt"].filter("crrt_mode IS NOT NULL").select("stay_id", "charttime", F.when(F.col("charttime").isNotNull(), 3).alias("aki_stage_crrt"))
    at = cr.select("stay_id", "charttime").unionByName(uo.select("stay_id", "charttime")).unionByName(dialysed.select("stay_id", "charttime")).distinct()
    j = _stays(ctx).drop("outtime").join(at, "stay_id", "left")
    for t in (cr, uo, dialysed):
        j = j.join(t, ["stay_id", "charttime"], "left")
    stages = [F.coalesce(s, F.lit(0)) for s in ("aki_stage_creat", "aki_stage_uo", "aki_stage_crrt")]
    j = j.withColumn("aki_stage", F.greatest(*stages))
    w = Window.partitionBy("subject_id").orderBy(dt_diff(F.col("charttime"), F.col("intime"), "SECOND")).rangeBetween(-21600, 0)
    return j.withColumn("aki_stage_smoothed", F.max("aki_stage").over(w)).drop("intime")


@concept("meld", ["icustays", "first_day_lab", "first_day_rrt"], """
WITH j AS (SELECT i.subject_id, i.hadm_id, i.stay_id, dialysis_present AS rrt, creatinine_max, bilirubin_total_max, inr_max, sodium_min,
        CASE WHEN sodium_min IS NULL THEN 0 ELSE 137 - greatest(125, least(137, sodium_min)) END AS na,
        CAST(0.957 AS DOUBLE) * ln(CASE WHEN dialysis_present = 1 OR creatinine_max > 4 THEN 4 ELSE greatest(coalesce(creatinine_max, 1), 1) END)
        + CAST(0.378 AS DOUBLE) * ln(greatest(coalesce(bilirubin_total_max, 1), 1)) + CAST(1.12 AS DOUBLE) * ln(greatest(coalesce(inr_max, 1), 1)) + CAST(0.643 AS DOUBLE) AS raw
      FROM icustays i LEFT JOIN first_day_lab USING (stay_id) LEFT JOIN first_day_rrt USING (stay_id)),
k AS (SELECT *, CASE WHEN raw > 4 THEN 40 ELSE CAST(round(CAST(raw AS DECIMAL(38,9)), 1) * 10 AS DOUBLE) END AS meld_initial FROM j)
SELECT subject_id, hadm_id, stay_id, meld_initial, round(CASE WHEN meld_initial > 11 THEN meld_initial + CAST(1.32 AS DOUBLE) * na - CAST(0.033 AS DOUBLE) * meld_initial * na ELSE meld_initial END, 6) AS meld,
       rrt, creatinine_max, bilirubin_total_max, inr_max, sodium_min FROM k""")
def meld(ctx):
    """Liver score from logarithms of three labs floored at one, corrected for low sodium."""
    lab = ctx["first_day_lab"].select("stay_id", "creatinine_max", "bilirubin_total_max", "inr_max", "sodium_min")
    j = _stays(ctx).drop("intime", "outtime").join(lab, "stay_id", "left").join(ctx["first_day_rrt"].select("stay_id", F.col("dialysis_present").alias("rrt")), "stay_id", "left")
    floor1 = lambda c: F.greatest(F.coalesce(c, F.lit(1.0)), F.lit(1.0))
    kidney = F.when((F.col("rrt") == 1) | (F.col("creatinine_max") > 4), 4.0).otherwise(floor1("creatinine_max"))
    raw = 0.957 * F.log(kidney) + 0.378 * F.log(floor1("bilirubin_total_max")) + 1.12 * F.log(floor1("inr_max")) + 0.643
    sodium = F.when(F.col("sodium_min").isNull(), 0.0).otherwise(137.0 - F.greatest(F.lit(125.0), F.least(F.lit(137.0), F.col("sodium_min"))))
    first = F.when(raw > 4, 40.0).otherwise((F.round(raw.cast("decimal(38,9)"), 1) * 10).cast("double"))
    j = j.withColumns({"na": sodium, "meld_initial": first})
    m = F.col("meld_initial")
    final = F.when(m > 11, m + 1.32 * F.col("na") - 0.033 * m * F.col("na")).otherwise(m)
    return j.select("subject_id", "hadm_id", "stay_id", "meld_initial", F.round(final, 6).alias("meld"), "rrt", "creatinine_max", "bilirubin_total_max", "inr_max", "sodium_min")


@concept("sirs", ["icustays", "first_day_bg_art", "first_day_vitalsign", "first_day_lab"], """
WITH j AS (SELECT i.subject_id, i.hadm_id, i.stay_id, v.temperature_min AS tl, v.temperature_max AS th, heart_rate_max AS hr, resp_rate_max AS rr, pco2_min AS co, wbc_min AS wl, wbc_max AS wh, bands_max AS b
      FROM icustays i LEFT JOIN first_day_bg_art USING (stay_id) LEFT JOIN first_day_vitalsign v USING (stay_id) LEFT JOIN first_day_lab USING (stay_id)),
s AS (SELECT subject_id, hadm_id, stay_id, CASE WHEN tl < 36 OR th > 38 THEN 1 WHEN tl IS NOT NULL THEN 0 END AS temp_score, CASE WHEN hr > 90 THEN 1 WHEN hr IS NOT NULL THEN 0 END AS heart_rate_score,
        CASE WHEN rr > 20 OR co < 32 THEN 1 WHEN coalesce(rr, co) IS NOT NULL THEN 0 END AS resp_score, CASE WHEN wl < 4 OR wh > 12 OR b > 10 THEN 1 WHEN coalesce(wl, b) IS NOT NULL THEN 0 END AS wbc_score FROM j)
SELECT subject_id, hadm_id, stay_id, coalesce(temp_score, 0) + coalesce(heart_rate_score, 0) + coalesce(resp_score, 0) + coalesce(wbc_score, 0) AS sirs, temp_score, heart_rate_score, resp_score, wbc_score FROM s""")
def sirs(ctx):
    j = _stays(ctx).join(ctx["first_day_bg_art"].select("stay_id", "pco2_min"), "stay_id", "left")
    j = j.join(ctx["first_day_vitalsign"].select("stay_id", "temperature_min", "temperature_max", "heart_rate_max", "resp_rate_max"), "stay_id", "left")
    j = j.join(ctx["first_day_lab"].select("stay_id", "wbc_min", "wbc_max", "bands_max"), "stay_id", "left")
    c = F.col
    points = {
        "temp_score": step_score([((c("temperature_min") < 36) | (c("temperature_max") > 38), 1), (c("temperature_min").isNotNull(), 0)], None),
        "heart_rate_score": step_score([(c("heart_rate_max") > 90, 1), (c("heart_rate_max").isNotNull(), 0)], None),
        "resp_score": step_score([((c("resp_rate_max") > 20) | (c("pco2_min") < 32), 1), (F.coalesce("resp_rate_max", "pco2_min").isNotNull(), 0)], None),
        "wbc_score": step_score([((c("wbc_min") < 4) | (c("wbc_max") > 12) | (c("bands_max") > 10), 1), (F.coalesce("wbc_min", "bands_max").isNotNull(), 0)], None),
    }
    s = j.select("subject_id", "hadm_id", "stay_id", *[x.alias(n) for n, x in points.items()])
    return s.withColumn("sirs", sum((F.coalesce(n, F.lit(0)) for n in points), F.lit(0)))


@concept("lods", ["icustays", "chartevents", "bg", "ventilation", "first_day_gcs", "first_day_vitalsign", "first_day_urine_output", "first_day_lab"], """
WITH m AS (SELECT i.stay_id, min(charttime) - INTERVAL '1' HOUR AS s, max(charttime) + INTERVAL '4' HOUR AS e FROM icustays i JOIN chartevents c ON c.stay_id = i.stay_id AND c.itemid = 226732
        AND c.charttime BETWEEN i.intime AND i.intime + INTERVAL '1' DAY AND regexp_matches(lower(c.value), 'cpap|bipap mask') GROUP BY 1),
p AS (SELECT i.stay_id, min(pao2fio2ratio) AS pf FROM bg b JOIN icustays i ON i.hadm_id = b.hadm_id AND b.charttime >= i.intime AND b.charttime < i.outtime
      WHERE EXISTS (SELECT 1 FROM ventilation v WHERE v.stay_id = i.stay_id AND v.ventilation_status = 'InvasiveVent' AND b.charttime BETWEEN v.starttime AND v.endtime)
         OR EXISTS (SELECT 1 FROM m WHERE m.stay_id = i.stay_id AND b.charttime BETWEEN m.s AND m.e) GROUP BY 1),
j AS (SELECT i.subject_id, i.hadm_id, i.stay_id, pf, gcs_min, heart_rate_min AS hl, heart_rate_max AS hh, sbp_min AS sl, sbp_max AS sh, bun_max AS bun, creatinine_max AS cr, urineoutput AS u, wbc_min AS wl, wbc_max AS wh,
        platelets_min AS pl, bilirubin_total_max AS bi, pt_min AS ptl, pt_max AS pth
      FROM icustays i LEFT JOIN p USING (stay_id) LEFT JOIN first_day_gcs USING (stay_id) LEFT JOIN first_day_vitalsign USING (stay_id) LEFT JOIN first_day_urine_output USING (stay_id) LEFT JOIN first_day_lab USING (stay_id)),
s AS (SELECT subject_id, hadm_id, stay_id, CASE WHEN gcs_min < 3 OR gcs_min IS NULL THEN NULL WHEN gcs_min <= 5 THEN 5 WHEN gcs_min <= 8 THEN 3 WHEN gcs_min <= 13 THEN 1 ELSE 0 END AS neurologic,
        CASE WHEN hh IS NULL AND sl IS NULL THEN NULL WHEN hl < 30 OR sl < 40 THEN 5 WHEN sl < 70 OR sh >= 270 THEN 3 WHEN hh >= 140 OR sh >= 240 OR sl < 90 THEN 1 ELSE 0 END AS cardiovascular,
        CASE WHEN bun IS NULL OR u IS NULL OR cr IS NULL THEN NULL WHEN u < 500 OR bun >= 56 THEN 5 WHEN cr >= 1.6 OR u < 750 OR bun >= 28 OR u >= 10000 THEN 3 WHEN cr >= 1.2 OR bun >= 7.5 THEN 1 ELSE 0 END AS renal,
        CASE WHEN pf IS NULL THEN 0 WHEN pf >= 150 THEN 1 ELSE 3 END AS pulmonary,
        CASE WHEN wh IS NULL AND pl IS NULL THEN NULL WHEN wl < 1 THEN 3 WHEN wl < 2.5 OR pl < 50 OR wh >= 50 THEN 1 ELSE 0 END AS hematologic,
        CASE WHEN pth IS NULL AND bi IS NULL THEN NULL WHEN bi >= 2 OR pth > 15 OR ptl < 3 THEN 1 ELSE 0 END AS hepatic FROM j)
SELECT subject_id, hadm_id, stay_id, coalesce(neurologic, 0) + coalesce(cardiovascular, 0) + coalesce(renal, 0) + coalesce(pulmonary, 0) + coalesce(hematologic, 0) + coalesce(hepatic, 0) AS lods,
       neurologic, cardiovascular, renal, pulmonary, hematologic, hepatic FROM s""")
def lods(ctx):
    """Organ dysfunction of the first day; oxygenation counts only under ventilation or a pressure mask."""
    stays = _stays(ctx)
    masks = ctx["chartevents"].filter((F.col("itemid") == 226732) & F.lower("value").rlike("cpap|bipap mask")).select("stay_id", "charttime")
    masks = anchored_join(stays.select("stay_id", "intime"), masks, ["stay_id"], "intime", "charttime", hours(0), days(1), how="inner")
    masks = masks.groupBy("stay_id").agg((F.min("charttime") - hours(1)).alias("starttime"), (F.max("charttime") + hours(4)).alias("endtime"))
    support = ctx["ventilation"].filter("ventilation_status = 'InvasiveVent'").select("stay_id", "starttime", "endtime").unionByName(masks)
    gas = interval_join(ctx["bg"].select("hadm_id", "charttime", "pao2fio2ratio"), stays.select("hadm_id", "stay_id", "intime", "outtime"), ["hadm_id"], "charttime", "intime", "outtime", closed="left")
    worst = interval_join(gas, support, ["stay_id"], "charttime", "starttime", "endtime").groupBy("stay_id").agg(F.min("pao2fio2ratio").alias("pf"))
    j = stays.join(worst, "stay_id", "left")
    for t, cols in (
        ("first_day_gcs", ["gcs_min"]), ("first_day_vitalsign", ["heart_rate_min", "heart_rate_max", "sbp_min", "sbp_max"]), ("first_day_urine_output", ["urineoutput"]),
        ("first_day_lab", ["bun_max", "creatinine_max", "wbc_min", "wbc_max", "platelets_min", "bilirubin_total_max", "pt_min", "pt_max"]),
    ):
        j = j.join(ctx[t].select("stay_id", *cols), "stay_id", "left")
    c = F.col
    u, cr, bun, gcs = c("urineoutput"), c("creatinine_max"), c("bun_max"), c("gcs_min")
    points = {
        "neurologic": step_score([(gcs <= 5, 5), (gcs <= 8, 3), (gcs <= 13, 1)], 0, gcs.isNull() | (gcs < 3)),
        "cardiovascular": step_score([
            ((c("heart_rate_min") < 30) | (c("sbp_min") < 40), 5), ((c("sbp_min") < 70) | (c("sbp_max") >= 270), 3), ((c("heart_rate_max") >= 140) | (c("sbp_max") >= 240) | (c("sbp_min") < 90), 1),
        ], 0, c("heart_rate_max").isNull() & c("sbp_min").isNull()),
        "renal": step_score([((u < 500) | (bun >= 56), 5), ((cr >= 1.6) | (u < 750) | (bun >= 28) | (u >= 10000), 3), ((cr >= 1.2) | (bun >= 7.5), 1)], 0, bun.isNull() | u.isNull() | cr.isNull()),
        "pulmonary": step_score([(c("pf") >= 150, 1), (c("pf") < 150, 3)], 0),
        "hematologic": step_score([(c("wbc_min") < 1, 3), ((c("wbc_min") < 2.5) | (c("platelets_min") < 50) | (c("wbc_max") >= 50), 1)], 0, c("wbc_max").isNull() & c("platelets_min").isNull()),
        "hepatic": step_score([((c("bilirubin_total_max") >= 2) | (c("pt_max") > 15) | (c("pt_min") < 3), 1)], 0, c("pt_max").isNull() & c("bilirubin_total_max").isNull()),
    }
    s = j.select("subject_id", "hadm_id", "stay_id", *[x.alias(n) for n, x in points.items()])
    return s.withColumn("lods", sum((F.coalesce(n, F.lit(0)) for n in points), F.lit(0)))


GRID = "SELECT h.stay_id, i.hadm_id, h.hr, h.endtime - INTERVAL '1' HOUR AS starttime, h.endtime FROM icustay_hourly h JOIN icustays i USING (stay_id)"
_hour = lambda t, key, agg, name, where="TRUE": f"SELECT g.stay_id, g.hr, {agg} AS {name} FROM g JOIN {t} t ON t.{key} = g.{key} AND t.charttime > g.starttime AND t.charttime <= g.endtime WHERE {where} GROUP BY ALL"
RATES = ["epinephrine", "norepinephrine", "dopamine", "dobutamine"]


@concept("sofa", ["icustays", "icustay_times", "icustay_hourly", "bg", "ventilation", "vitalsign", "gcs", "enzyme", "chemistry", "complete_blood_count", "urine_output_rate", *RATES], f"""
WITH g AS ({GRID}),
vs AS ({_hour('vitalsign', 'stay_id', 'min(mbp)', 'mbp_min')}), gc AS ({_hour('gcs', 'stay_id', 'min(gcs)', 'gcs_min')}), bi AS ({_hour('enzyme', 'hadm_id', 'max(bilirubin_total)', 'bilirubin_max')}),
cr AS ({_hour('chemistry', 'hadm_id', 'max(creatinine)', 'creatinine_max')}), pl AS ({_hour('complete_blood_count', 'hadm_id', 'min(platelet)', 'platelet_min')}),
uo AS ({_hour('urine_output_rate', 'stay_id', 'max(urineoutput_24hr / uo_tm_24hr * 24)', 'urine', 'uo_tm_24hr BETWEEN 22 AND 30')}),
a AS (SELECT i.stay_id, b.charttime, pao2fio2ratio AS r, EXISTS (SELECT 1 FROM ventilation v WHERE v.stay_id = i.stay_id AND v.ventilation_status = 'InvasiveVent' AND b.charttime BETWEEN v.starttime AND v.endtime) AS v
      FROM icustays i JOIN bg b USING (subject_id) WHERE specimen = 'ART.'),
pf AS (SELECT g.stay_id, g.hr, min(r) FILTER (WHERE NOT v) AS pn, min(r) FILTER (WHERE v) AS pv FROM g JOIN a ON a.stay_id = g.stay_id AND a.charttime > g.starttime AND a.charttime <= g.endtime GROUP BY ALL),
{', '.join(f"r_{d} AS (SELECT g.stay_id, g.hr, max(vaso_rate) AS rate_{d} FROM g JOIN {d} t ON t.stay_id = g.stay_id AND g.endtime > t.starttime AND g.endtime <= t.endtime GROUP BY ALL)" for d in RATES)},
j AS (SELECT g.stay_id, g.hr, g.starttime, g.endtime, pn, pv, {', '.join(f'rate_{d}' for d in RATES)}, mbp_min, gcs_min, urine, bilirubin_max, creatinine_max, platelet_min FROM g
      {' '.join(f'LEFT JOIN {t} USING (stay_id, hr)' for t in ['vs', 'gc', 'bi', 'cr', 'pl', 'uo', 'pf', *[f'r_{d}' for d in RATES]])}),
s AS (SELECT *, CASE WHEN pv < 100 THEN 4 WHEN pv < 200 THEN 3 WHEN pn < 300 OR pv < 300 THEN 2 WHEN pn < 400 OR pv < 400 THEN 1 WHEN coalesce(pv, pn) IS NULL THEN NULL ELSE 0 END AS respiration, {ORGAN_SQL} FROM j),
w AS (SELECT *, {', '.join(f'coalesce(max({o}) OVER w, 0) AS {o}_24hours' for o in ORGANS)} FROM s WINDOW w AS (PARTITION BY stay_id ORDER BY hr ROWS BETWEEN 23 PRECEDING AND CURRENT ROW))
SELECT stay_id, hr, starttime, endtime, {', '.join(ORGANS)}, {', '.join(f'{o}_24hours' for o in ORGANS)}, {' + '.join(f'{o}_24hours' for o in ORGANS)} AS sofa_24hours FROM w WHERE hr >= 0""")
def sofa(ctx):
    """Organ failure points for every hour of a stay and their worst over 24 hours.

    Measurements are dealt to the hours that they fall in and all kinds are summarised together, one row per stay and
    hour; only these rows are sorted, and the hours of the stay are made from what holds between two of them.
    """
    c, ids = F.col, ctx["icustays"].select("stay_id", "hadm_id", "subject_id")
    vent = ctx["ventilation"].filter("ventilation_status = 'InvasiveVent'").select("stay_id", "starttime", "endtime", F.lit(1).alias("vent"))
    gas = ctx["bg"].filter("specimen = 'ART.'").select("subject_id", "charttime", "pao2fio2ratio").filter("pao2fio2ratio IS NOT NULL").join(ids.select("subject_id", "stay_id"), "subject_id")
    gas = interval_join(gas, vent, ["stay_id"], "charttime", "starttime", "endtime", how="left")
    labs = None
    for table, value, name in (("enzyme", "bilirubin_total", "bilirubin_max"), ("chemistry", "creatinine", "creatinine_max"), ("complete_blood_count", "platelet", "platelet_min")):
        one = ctx[table].filter(c(value).isNotNull()).select("hadm_id", "charttime", c(value).alias(name))
        labs = one if labs is None else labs.unionByName(one, allowMissingColumns=True)
    measured = [
        ctx["vitalsign"].filter("mbp IS NOT NULL").select("stay_id", "charttime", c("mbp").alias("mbp_min")), ctx["gcs"].select("stay_id", "charttime", c("gcs").alias("gcs_min")),
        labs.join(ids.select("hadm_id", "stay_id"), "hadm_id").drop("hadm_id"),
        ctx["urine_output_rate"].filter("uo_tm_24hr BETWEEN 22 AND 30").select("stay_id", "charttime", (c("urineoutput_24hr") / c("uo_tm_24hr") * 24).alias("urine")),
        gas.select("stay_id", "charttime", F.when(c("vent").isNull(), c("pao2fio2ratio")).alias("pn"), F.when(c("vent") == 1, c("pao2fio2ratio")).alias("pv")),
    ]
    running = None
    for d in RATES:
        one = ctx[d].select("stay_id", "starttime", "endtime", c("vaso_rate").alias(f"rate_{d}"))
        running = one if running is None else running.unionByName(one, allowMissingColumns=True)
    # an infusion counts in every hour whose end it covers
    measured.append(covered_hours(running, dt_trunc(c("starttime"), "HOUR") + hours(1), dt_trunc(c("endtime"), "HOUR"), "at").select("stay_id", c("at").alias("endtime"), *[f"rate_{d}" for d in RATES]))
    lowest, highest = ("mbp_min", "gcs_min", "platelet_min", "pn", "pv"), ("bilirubin_max", "creatinine_max", "urine", *[f"rate_{d}" for d in RATES])
    hour = hour_summary(measured, "stay_id", "charttime", "endtime", **{n: F.min(n) for n in lowest}, **{n: F.max(n) for n in highest})
    pv, pn = c("pv"), c("pn")
    oxygen = [(pv < 100, 4), (pv < 200, 3), ((pn < 300) | (pv < 300), 2), ((pn < 400) | (pv < 400), 1)]
    points = organ_points(oxygen, F.coalesce(pv, pn), c("mbp_min"), c("urine"))
    hour = hour.select("stay_id", "endtime", *[p.alias(n) for n, p in points.items()]).select("stay_id", "endtime", pack_points(ORGANS).alias("now"))
    spans = ctx["icustay_times"].filter("intime_hr IS NOT NULL").select("stay_id", ceil_hour(c("intime_hr")).alias("first"), dt_diff(c("outtime_hr"), c("intime_hr"), "HOUR").alias("n"))
    s = trailing_hours(spans, hour, "stay_id", "first", "n", "endtime", "now", 24).select(
        "stay_id", "hr", (c("endtime") - hours(1)).alias("starttime"), "endtime", *[unpack_points(c("now"), i).alias(o) for i, o in enumerate(ORGANS)],
        *[F.coalesce(unpack_points(c("last_now"), i), F.lit(0)).alias(f"{o}_24hours") for i, o in enumerate(ORGANS)],
    )
    return s.withColumn("sofa_24hours", sum((c(f"{o}_24hours") for o in ORGANS), F.lit(0)))


@concept("suspicion_of_infection", ["antibiotic", "microbiologyevents"], """
WITH a AS (SELECT *, date_trunc('day', starttime) AS d, row_number() OVER (PARTITION BY subject_id ORDER BY starttime, stoptime, antibiotic, hadm_id, stay_id NULLS FIRST, route) AS ab_id FROM antibiotic),
m AS (SELECT micro_specimen_id, max(subject_id) AS subject_id, CAST(max(chartdate) AS DATE) AS cd, max(charttime) AS ct, max(spec_type_desc) AS sp,
        max(CASE WHEN org_name <> '' AND org_itemid <> 90856 THEN 1 ELSE 0 END) AS pos FROM microbiologyevents GROUP BY 1),
b AS (SELECT a.subject_id, a.ab_id, m.*, row_number() OVER (PARTITION BY a.subject_id, a.ab_id ORDER BY cd, ct NULLS LAST, pos DESC, micro_specimen_id) AS n FROM a JOIN m ON m.subject_id = a.subject_id
      AND CASE WHEN ct IS NULL THEN d BETWEEN cd AND cd + INTERVAL '3' DAY ELSE a.starttime > ct AND a.starttime <= ct + INTERVAL '72' HOUR END),
f AS (SELECT a.subject_id, a.ab_id, m.*, row_number() OVER (PARTITION BY a.subject_id, a.ab_id ORDER BY cd, ct NULLS LAST, pos DESC, micro_specimen_id) AS n FROM a JOIN m ON m.subject_id = a.subject_id
      AND CASE WHEN ct IS NULL THEN d BETWEEN cd - INTERVAL '1' DAY AND cd ELSE a.starttime >= ct - INTERVAL '24' HOUR AND a.starttime < ct END)
SELECT a.subject_id, a.stay_id, a.hadm_id, a.ab_id, a.antibiotic, a.starttime AS antibiotic_time, CASE WHEN b.sp IS NULL AND f.sp IS NULL THEN 0 ELSE 1 END AS suspected_infection,
       CASE WHEN b.sp IS NULL AND f.sp IS NULL THEN NULL ELSE coalesce(b.ct, CAST(b.cd AS TIMESTAMP), a.starttime) END AS suspected_infection_time,
       coalesce(b.ct, CAST(b.cd AS TIMESTAMP), f.ct, CAST(f.cd AS TIMESTAMP)) AS culture_time, coalesce(b.sp, f.sp) AS specimen, coalesce(b.pos, f.pos) AS positive_culture
FROM a LEFT JOIN b ON b.subject_id = a.subject_id AND b.ab_id = a.ab_id AND b.n = 1 LEFT JOIN f ON f.subject_id = a.subject_id AND f.ab_id = a.ab_id AND f.n = 1""")
def suspicion_of_infection(ctx):
    """Antibiotics with the first culture of the three days before, else of the day after.

    Both sides come from one range join: a culture serves as earlier or later one, and the first of
    each kind per antibiotic is taken by one aggregation.
    """
    order = Window.partitionBy("subject_id").orderBy("starttime", "stoptime", "antibiotic", "hadm_id", "stay_id", "route")
    ab = ctx["antibiotic"].withColumns({"ab_id": F.row_number().over(order).cast("long"), "day": dt_trunc(F.col("starttime"), "DAY")})
    grown = (F.col("org_name") != "") & (F.col("org_itemid") != 90856)
    me = ctx["microbiologyevents"].groupBy("micro_specimen_id").agg(
        F.max("subject_id").alias("subject"), F.max("chartdate").cast("date").cast("timestamp_ntz").alias("cd"), F.max("charttime").alias("ct"), F.max("spec_type_desc").alias("sp"),
        F.max(F.when(grown, 1).otherwise(0)).alias("pos"),
    )
    t, d, ct, cd = F.col("starttime"), F.col("day"), F.col("ct"), F.col("cd")
    # a culture's bounds are worked out once, not for every pair
    me = me.withColumns({"until": F.when(ct.isNull(), cd + days(3)).otherwise(ct + hours(72)), "since": F.when(ct.isNull(), cd - days(1)).otherwise(ct - hours(24))})
    before = F.when(ct.isNull(), (d >= cd) & (d <= F.col("until"))).otherwise((t > ct) & (t <= F.col("until")))
    after = F.when(ct.isNull(), (d >= F.col("since")) & (d <= cd)).otherwise((t >= F.col("since")) & (t < ct))
    slim = ab.select("subject_id", "ab_id", "starttime", "day")
    pairs = slim.join(me, (slim["subject_id"] == me["subject"]) & (before | after))
    rank = F.struct(cd.alias("cd"), ct.isNull().alias("late"), ct.alias("ct"), (-F.col("pos")).alias("neg"), F.col("micro_specimen_id").alias("id"), F.col("sp").alias("sp"), F.col("pos").alias("pos"))
    first = pairs.groupBy("subject_id", "ab_id").agg(F.min(F.when(before, rank)).alias("b"), F.min(F.when(after, rank)).alias("f"))
    j = ab.join(first, ["subject_id", "ab_id"], "left")
    at = lambda s: F.coalesce(F.col(f"{s}.ct"), F.col(f"{s}.cd"))
    found = F.col("b.sp").isNotNull() | F.col("f.sp").isNotNull()
    return j.select(
        "subject_id", "stay_id", "hadm_id", "ab_id", "antibiotic", F.col("starttime").alias("antibiotic_time"), found.cast("int").alias("suspected_infection"),
        F.when(found, F.coalesce(at("b"), "starttime")).alias("suspected_infection_time"), F.coalesce(at("b"), at("f")).alias("culture_time"),
        F.coalesce("b.sp", "f.sp").alias("specimen"), F.coalesce("b.pos", "f.pos").alias("positive_culture"),
    )


@concept("sepsis3", ["suspicion_of_infection", "sofa"], f"""
WITH p AS (SELECT s.subject_id, s.stay_id, antibiotic_time, culture_time, suspected_infection_time, f.endtime AS sofa_time, sofa_24hours AS sofa_score, {', '.join(f'{o}_24hours AS {o}' for o in ORGANS)},
        suspected_infection = 1 AS sepsis3, row_number() OVER (PARTITION BY s.stay_id ORDER BY suspected_infection_time NULLS FIRST, antibiotic_time, culture_time NULLS FIRST, f.endtime, ab_id) AS n
      FROM suspicion_of_infection s JOIN sofa f ON f.stay_id = s.stay_id AND f.sofa_24hours >= 2 AND f.endtime BETWEEN s.suspected_infection_time - INTERVAL '48' HOUR AND s.suspected_infection_time + INTERVAL '24' HOUR)
SELECT * EXCLUDE (n) FROM p WHERE n = 1""")
def sepsis3(ctx):
    """First hour of organ failure around a suspected infection of each stay.

    Antibiotics with one time of suspicion meet the same hours, so each time stands once, with the first of its antibiotics.
    An hour's number and its points are one number, so pairs of times and hours go straight into a minimum, unsorted.
    """
    first = ("antibiotic_time", "culture_time", "ab_id", "subject_id", "suspected_infection")
    s = ctx["suspicion_of_infection"].filter("stay_id IS NOT NULL AND suspected_infection_time IS NOT NULL").select("stay_id", "suspected_infection_time", *first)
    s = s.repartition("stay_id").groupBy("stay_id", "suspected_infection_time").agg(F.min(F.struct(*first)).alias("first")).select("stay_id", "suspected_infection_time", "first.*")
    bits = 3 * len(ORGANS)
    points = sum((F.shiftleft(F.col(f"{o}_24hours").cast("long"), 3 * i) for i, o in enumerate(ORGANS)), F.lit(0).cast("long"))
    f = ctx["sofa"].filter("sofa_24hours >= 2").select("stay_id", F.col("endtime").alias("sofa_time"), (F.shiftleft(bucket_of(F.col("endtime"), 1), bits) + points).alias("hour"))
    near = anchored_join(s, f, ["stay_id"], "suspected_infection_time", "sofa_time", hours(48), hours(24), how="inner")
    near = near.groupBy(*s.columns).agg(F.min("hour").alias("hour"))
    best = near.groupBy("stay_id").agg(F.min(F.struct("suspected_infection_time", "antibiotic_time", "culture_time", "hour", *first[2:])).alias("best")).select("stay_id", "best.*")
    organs = [F.shiftright("hour", 3 * i).bitwiseAND(F.lit(7)).cast("int") for i in range(len(ORGANS))]
    return best.select(
        "subject_id", "stay_id", "antibiotic_time", "culture_time", "suspected_infection_time", hour_at(F.shiftright("hour", bits)).alias("sofa_time"), sum(organs, F.lit(0)).alias("sofa_score"),
        *[x.alias(o) for o, x in zip(ORGANS, organs)], (F.col("suspected_infection") == 1).alias("sepsis3"),
    )


def _points(cases, null_if):
    return step_score([(c, p) for c, p in cases], 0, null_if)


@concept("oasis", ["icustays", "admissions", "services", "ventilation", "age", "first_day_gcs", "first_day_vitalsign", "first_day_urine_output"], """
WITH g AS (SELECT i.stay_id, max(CASE WHEN lower(curr_service) LIKE '%surg%' OR curr_service = 'ORTHO' THEN 1 ELSE 0 END) AS sg FROM icustays i LEFT JOIN services s ON s.hadm_id = i.hadm_id AND s.transfertime < i.intime + INTERVAL '1' DAY GROUP BY 1),
j AS (SELECT i.*, a.admission_type, date_diff('minute', a.admittime, i.intime) AS pre, age, gcs_min AS gcs, heart_rate_min AS hl, heart_rate_max AS hh, mbp_min AS ml, mbp_max AS mh, resp_rate_min AS rl, resp_rate_max AS rh,
        temperature_min AS tl, temperature_max AS th, urineoutput AS u, sg,
        CASE WHEN EXISTS (SELECT 1 FROM ventilation v WHERE v.stay_id = i.stay_id AND v.ventilation_status = 'InvasiveVent' AND v.starttime <= i.intime + INTERVAL '1' DAY AND v.endtime >= i.intime) THEN 1 ELSE 0 END AS mv
      FROM icustays i JOIN admissions a ON a.hadm_id = i.hadm_id LEFT JOIN age g ON g.hadm_id = i.hadm_id LEFT JOIN g USING (stay_id) LEFT JOIN first_day_gcs USING (stay_id) LEFT JOIN first_day_vitalsign USING (stay_id) LEFT JOIN first_day_urine_output USING (stay_id)),
s AS (SELECT subject_id, hadm_id, stay_id,
        CASE WHEN pre < 10.2 THEN 5 WHEN pre < 297 THEN 3 WHEN pre < 1440 THEN 0 WHEN pre < 18708 THEN 2 ELSE 1 END AS preiculos_score,
        CASE WHEN age IS NULL THEN NULL WHEN age < 24 THEN 0 WHEN age <= 53 THEN 3 WHEN age <= 77 THEN 6 WHEN age <= 89 THEN 9 ELSE 7 END AS age_score,
        CASE WHEN gcs IS NULL THEN NULL WHEN gcs <= 7 THEN 10 WHEN gcs < 14 THEN 4 WHEN gcs = 14 THEN 3 ELSE 0 END AS gcs_score,
        CASE WHEN hh IS NULL THEN NULL WHEN hh > 125 THEN 6 WHEN hl < 33 THEN 4 WHEN hh BETWEEN 107 AND 125 THEN 3 WHEN hh BETWEEN 89 AND 106 THEN 1 ELSE 0 END AS heart_rate_score,
        CASE WHEN ml IS NULL THEN NULL WHEN ml < 20.65 THEN 4 WHEN ml < 51 OR mh > 143.44 THEN 3 WHEN ml < 61.33 THEN 2 ELSE 0 END AS mbp_score,
        CASE WHEN rl IS NULL THEN NULL WHEN rl < 6 THEN 10 WHEN rh > 44 THEN 9 WHEN rh > 30 THEN 6 WHEN rh > 22 OR rl < 13 THEN 1 ELSE 0 END AS resp_rate_score,
        CASE WHEN th IS NULL THEN NULL WHEN th > 39.88 THEN 6 WHEN tl BETWEEN 33.22 AND 35.93 OR th BETWEEN 33.22 AND 35.93 THEN 4 WHEN tl < 33.22 THEN 3 WHEN tl > 35.93 AND tl <= 36.39 THEN 2 WHEN th BETWEEN 36.89 AND 39.88 THEN 2 ELSE 0 END AS temp_score,
        CASE WHEN u IS NULL THEN NULL WHEN u < 671.09 THEN 10 WHEN u > 6896.8 THEN 8 WHEN u <= 1426.99 THEN 5 WHEN u >= 1427 AND u <= 2544.14 THEN 1 ELSE 0 END AS urineoutput_score,
        mv * 9 AS mechvent_score, CASE WHEN admission_type IS NULL OR sg IS NULL THEN NULL WHEN admission_type = 'ELECTIVE' AND sg = 1 THEN 0 ELSE 6 END AS electivesurgery_score, mv AS mechvent, pre AS preiculos FROM j)
SELECT *, coalesce(age_score, 0) + coalesce(preiculos_score, 0) + coalesce(gcs_score, 0) + coalesce(heart_rate_score, 0) + coalesce(mbp_score, 0) + coalesce(resp_rate_score, 0) + coalesce(temp_score, 0)
  + coalesce(urineoutput_score, 0) + coalesce(mechvent_score, 0) + coalesce(electivesurgery_score, 0) AS oasis,
  round(1 / (1 + exp(-(CAST(-6.1746 AS DOUBLE) + CAST(0.1275 AS DOUBLE) * (coalesce(age_score, 0) + coalesce(preiculos_score, 0) + coalesce(gcs_score, 0) + coalesce(heart_rate_score, 0) + coalesce(mbp_score, 0) + coalesce(resp_rate_score, 0)
  + coalesce(temp_score, 0) + coalesce(urineoutput_score, 0) + coalesce(mechvent_score, 0) + coalesce(electivesurgery_score, 0))))), 9) AS oasis_prob FROM s""")
def oasis(ctx):
    """Acute severity of illness: ten components of the first day and the stay's circumstances."""
    stays = _stays(ctx)
    surgical = F.lower("curr_service").contains("surg") | (F.col("curr_service") == "ORTHO")
    served = stays.select("stay_id", "hadm_id", "intime").join(ctx["services"].select("hadm_id", "transfertime", "curr_service"), "hadm_id", "left")
    timely = F.col("transfertime") < F.col("intime") + days(1)
    surg = served.groupBy("stay_id").agg(F.max(F.when(timely & surgical, 1).otherwise(0)).alias("sg"))
    vent = ctx["ventilation"].filter("ventilation_status = 'InvasiveVent'").select(F.col("stay_id").alias("_s"), F.col("starttime").alias("_a"), F.col("endtime").alias("_b"))
    held = stays.join(vent, (F.col("stay_id") == F.col("_s")) & (F.col("_a") <= F.col("intime") + days(1)) & (F.col("_b") >= F.col("intime")), "left_semi").select("stay_id", F.lit(1).alias("mv"))
    j = stays.join(ctx["admissions"].select("hadm_id", "admission_type", "admittime"), "hadm_id").join(ctx["age"].select("hadm_id", "age"), "hadm_id", "left")
    j = j.join(surg, "stay_id", "left").join(held, "stay_id", "left")
    for t, cols in (("first_day_gcs", ["gcs_min"]), ("first_day_vitalsign", [f"{v}_{s}" for v in ("heart_rate", "mbp", "resp_rate", "temperature") for s in ("min", "max")]), ("first_day_urine_output", ["urineoutput"])):
        j = j.join(ctx[t].select("stay_id", *cols), "stay_id", "left")
    c = F.col
    pre = dt_diff(c("intime"), c("admittime"), "MINUTE")
    age, gcs, u = c("age"), c("gcs_min"), c("urineoutput")
    hl, hh, ml, mh, rl, rh, tl, th = (c(f"{v}_{s}") for v in ("heart_rate", "mbp", "resp_rate", "temperature") for s in ("min", "max"))
    cold = tl.between(33.22, 35.93) | th.between(33.22, 35.93)
    points = {
        "preiculos_score": step_score([(pre < 10.2, 5), (pre < 297, 3), (pre < 1440, 0), (pre < 18708, 2)], 1),
        "age_score": step_score([(age < 24, 0), (age <= 53, 3), (age <= 77, 6), (age <= 89, 9)], 7, age.isNull()),
        "gcs_score": _points([(gcs <= 7, 10), (gcs < 14, 4), (gcs == 14, 3)], gcs.isNull()),
        "heart_rate_score": _points([(hh > 125, 6), (hl < 33, 4), (hh.between(107, 125), 3), (hh.between(89, 106), 1)], hh.isNull()),
        "mbp_score": _points([(ml < 20.65, 4), ((ml < 51) | (mh > 143.44), 3), (ml < 61.33, 2)], ml.isNull()),
        "resp_rate_score": _points([(rl < 6, 10), (rh > 44, 9), (rh > 30, 6), ((rh > 22) | (rl < 13), 1)], rl.isNull()),
        "temp_score": _points([(th > 39.88, 6), (cold, 4), (tl < 33.22, 3), ((tl > 35.93) & (tl <= 36.39), 2), (th.between(36.89, 39.88), 2)], th.isNull()),
        "urineoutput_score": _points([(u < 671.09, 10), (u > 6896.8, 8), (u <= 1426.99, 5), (u.between(1427, 2544.14), 1)], u.isNull()),
        "mechvent_score": F.when(c("mv") == 1, 9).otherwise(0),
        "electivesurgery_score": step_score([((c("admission_type") == "ELECTIVE") & (c("sg") == 1), 0)], 6, c("admission_type").isNull() | c("sg").isNull()),
    }
    s = j.select("subject_id", "hadm_id", "stay_id", *[x.alias(n) for n, x in points.items()], F.coalesce("mv", F.lit(0)).alias("mechvent"), pre.alias("preiculos"))
    s = s.withColumn("oasis", sum((F.coalesce(n, F.lit(0)) for n in points), F.lit(0)))
    return s.withColumn("oasis_prob", F.round(logistic(-6.1746 + 0.1275 * F.col("oasis")), 9))

