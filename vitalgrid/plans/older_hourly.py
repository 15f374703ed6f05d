"""Hourly severity scores of the older generation.

An hour is one row, whichever number of gases or doses touches it; of several doses the largest counts.  Measurements
are dealt to hours and summarised before they meet the grid, which is made where its stay is and not shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.dt import ceil_hour, dt_diff, dt_trunc, hours
from vitalgrid.functions.scalar import pack_points, step_score, unpack_points
from vitalgrid.operators.joins import covered_hours, grid_merge, hour_summary, interval_join
from vitalgrid.plans.older_measurement import STAY
from vitalgrid.plans.older_scores import _OASIS, _OASIS_SQL, _points
from vitalgrid.plans.registry import concept

RATES = ("epinephrine", "norepinephrine", "dopamine", "dobutamine")
ORGANS = ("respiration", "coagulation", "liver", "cardiovascular", "cns", "renal")
# Codes of mean arterial pressure.
MEAN_PRESSURE = [456, 52, 6702, 443, 220052, 220181, 225312]
_GRID_SQL = "SELECT h.icustay_id, i.hadm_id, h.hr, h.endtime - INTERVAL '1' HOUR AS starttime, h.endtime FROM icustay_hours h JOIN older_icustays i ON i.icustay_id = h.icustay_id"


def _hour_sql(table: str, key: str, aggs: str, where: str = "true") -> str:
    return f"SELECT g.icustay_id, g.hr, {aggs} FROM g JOIN {table} t ON t.{key} = g.{key} AND t.charttime > g.starttime AND t.charttime <= g.endtime WHERE {where} GROUP BY 1, 2"


def _grid(ctx) -> DataFrame:
    """The hours as they were made: every stay of theirs is one of ``older_icustays``, so nothing is joined."""
    return ctx["icustay_hours"].select("icustay_id", "hr", "endtime")


@concept("pivoted_sofa", ["icustay_hours", "older_icustays", "older_chartevents", "pivoted_gcs", "pivoted_lab", "pivoted_bg_art", "ventilation_durations", "pivoted_uo", *[f"{d}_dose" for d in RATES]], f"""
WITH g AS ({_GRID_SQL}),
bp AS ({_hour_sql('older_chartevents', 'icustay_id', 'min(valuenum) AS bp', f'coalesce(error, 0) <> 1 AND valuenum > 0 AND valuenum < 300 AND itemid IN ({", ".join(map(str, MEAN_PRESSURE))})')}), gc AS ({_hour_sql('pivoted_gcs', 'icustay_id', 'min(gcs) AS gc')}),
la AS ({_hour_sql('pivoted_lab', 'hadm_id', 'max(bilirubin) AS bi, max(creatinine) AS cr, min(platelet) AS pl')}), uo AS ({_hour_sql('pivoted_uo', 'icustay_id', 'sum(urineoutput) AS urine')}),
b AS (SELECT icustay_id, charttime, pao2fio2ratio AS r, EXISTS (SELECT 1 FROM ventilation_durations v WHERE v.icustay_id = b.icustay_id AND b.charttime BETWEEN v.starttime AND v.endtime) AS held FROM pivoted_bg_art b),
pf AS ({_hour_sql('b', 'icustay_id', 'min(r) FILTER (WHERE NOT held) AS pn, min(r) FILTER (WHERE held) AS pv')}),
{', '.join(f"r_{d} AS (SELECT g.icustay_id, g.hr, max(vaso_rate) AS {d} FROM g JOIN {d}_dose t ON t.icustay_id = g.icustay_id AND g.endtime > t.starttime AND g.endtime <= t.endtime GROUP BY 1, 2)" for d in RATES)},
j AS (SELECT g.icustay_id, g.hr, g.starttime, g.endtime, pn, pv, bp, gc, bi, cr, pl, {', '.join(RATES)}, sum(urine) OVER (PARTITION BY g.icustay_id ORDER BY g.hr ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS uo FROM g
  {' '.join(f'LEFT JOIN {t} ON {t}.icustay_id = g.icustay_id AND {t}.hr = g.hr' for t in ['bp', 'gc', 'la', 'uo', 'pf', *[f'r_{d}' for d in RATES]])}),
s AS (SELECT icustay_id, hr, starttime, endtime, CASE WHEN coalesce(pv, pn) IS NOT NULL THEN coalesce(list_max([4 * CAST(pv < 100 AS INT), 3 * CAST(pv < 200 AS INT), 2 * CAST(pn < 300 AS INT), CAST(pn < 400 AS INT)]), 0) END AS respiration,
  CAST(pl < 150 AS INT) + CAST(pl < 100 AS INT) + CAST(pl < 50 AS INT) + CAST(pl < 20 AS INT) AS coagulation, CAST(bi >= CAST(1.2 AS DOUBLE) AS INT) + CAST(bi >= 2 AS INT) + CAST(bi >= 6 AS INT) + CAST(bi >= 12 AS INT) AS liver,
  CASE WHEN coalesce(bp, dopamine, dobutamine, epinephrine, norepinephrine) IS NOT NULL THEN coalesce(list_max([4 * CAST(dopamine > 15 AS INT), 4 * CAST(greatest(epinephrine, norepinephrine) > CAST(0.1 AS DOUBLE) AS INT), 3 * CAST(dopamine > 5 AS INT), 3 * CAST(coalesce(epinephrine, norepinephrine) IS NOT NULL AS INT),
    2 * CAST(dopamine > 0 AS INT), 2 * CAST(dobutamine > 0 AS INT), CAST(bp < 70 AS INT)]), 0) END AS cardiovascular,
  CASE WHEN gc < 6 THEN 4 WHEN gc BETWEEN 6 AND 9 THEN 3 WHEN gc BETWEEN 10 AND 12 THEN 2 WHEN gc BETWEEN 13 AND 14 THEN 1 WHEN gc IS NOT NULL THEN 0 END AS cns,
  CASE WHEN coalesce(uo, cr) IS NOT NULL THEN coalesce(list_max([4 * CAST(cr >= 5 AS INT), 4 * CAST(uo < 200 AS INT), 3 * CAST(cr >= CAST(3.5 AS DOUBLE) AS INT), 3 * CAST(uo < 500 AS INT), 2 * CAST(cr >= 2 AS INT), CAST(cr >= CAST(1.2 AS DOUBLE) AS INT)]), 0) END AS renal FROM j),
w AS (SELECT *, {', '.join(f'coalesce(max({o}) OVER w, 0) AS {o}_24hours' for o in ORGANS)} FROM s WINDOW w AS (PARTITION BY icustay_id ORDER BY hr ROWS BETWEEN 24 PRECEDING AND CURRENT ROW))
SELECT *, {' + '.join(f'{o}_24hours' for o in ORGANS)} AS sofa_24hours FROM w WHERE hr >= 0""")
def pivoted_sofa(ctx):
    """Organ failure of every hour and its worst over the last 24."""
    c, own = F.col, Window.partitionBy("icustay_id").orderBy("endtime")
    chart = ctx["older_chartevents"].filter(c("itemid").isin(MEAN_PRESSURE)).filter("coalesce(error, 0) <> 1 AND valuenum > 0 AND valuenum < 300").select("icustay_id", "charttime", c("valuenum").alias("bp"))
    runs = ctx["ventilation_durations"].select("icustay_id", c("starttime").alias("_s"), c("endtime").alias("_e"), F.lit(1).alias("held"))
    gas = interval_join(ctx["pivoted_bg_art"].filter("icustay_id IS NOT NULL AND pao2fio2ratio IS NOT NULL").select("icustay_id", "charttime", "pao2fio2ratio"), runs, ["icustay_id"], "charttime", "_s", "_e", how="left")
    labs = ctx["pivoted_lab"].select("hadm_id", "charttime", "bilirubin", "creatinine", "platelet").join(ctx["older_icustays"].select("hadm_id", "icustay_id"), "hadm_id").drop("hadm_id")
    doses = None
    for d in RATES:
        one = ctx[f"{d}_dose"].select("icustay_id", "starttime", "endtime", c("vaso_rate").alias(d))
        doses = one if doses is None else doses.unionByName(one, allowMissingColumns=True)
    covered = covered_hours(doses, dt_trunc(c("starttime"), "HOUR") + hours(1), dt_trunc(c("endtime"), "HOUR"), "at").select("icustay_id", c("at").alias("endtime"), *RATES)
    readings = [
        chart, ctx["pivoted_gcs"].select("icustay_id", "charttime", "gcs"), labs, ctx["pivoted_uo"].select("icustay_id", "charttime", c("urineoutput").alias("urine")), covered,
        gas.select("icustay_id", "charttime", F.when(c("held").isNull(), c("pao2fio2ratio")).alias("pn"), F.when(c("held") == 1, c("pao2fio2ratio")).alias("pv")),
    ]
    lowest, highest = ("bp", "gcs", "platelet", "pn", "pv"), ("bilirubin", "creatinine", *RATES)
    hour = hour_summary(readings, "icustay_id", "charttime", "endtime", urine=F.sum("urine"), **{n: F.min(n) for n in lowest}, **{n: F.max(n) for n in highest})
    dop, epi, nor, dob, cr, uo, gcs = (c(x) for x in ("dopamine", "epinephrine", "norepinephrine", "dobutamine", "creatinine", "uo", "gcs"))
    points = {
        "respiration": ([(c("pv") < 100, 4), (c("pv") < 200, 3), (c("pn") < 300, 2), (c("pn") < 400, 1)], F.coalesce("pv", "pn")), "coagulation": ([(c("platelet") < v, p) for v, p in ((20, 4), (50, 3), (100, 2), (150, 1))], c("platelet")),
        "liver": ([(c("bilirubin") >= v, p) for v, p in ((12, 4), (6, 3), (2, 2), (1.2, 1))], c("bilirubin")),
        "cardiovascular": ([((dop > 15) | (epi > 0.1) | (nor > 0.1), 4), ((dop > 5) | (epi <= 0.1) | (nor <= 0.1), 3), ((dop > 0) | (dob > 0), 2), (c("bp") < 70, 1)], F.coalesce("bp", *RATES)),
        "cns": ([(gcs.between(13, 14), 1), (gcs.between(10, 12), 2), (gcs.between(6, 9), 3), (gcs < 6, 4)], gcs), "renal": ([((cr >= 5) | (uo < 200), 4), ((cr >= 3.5) | (uo < 500), 3), (cr >= 2, 2), (cr >= 1.2, 1)], F.coalesce("uo", "creatinine")),
    }
    scored = {n: step_score([*cases, (known.isNull(), None)], 0) for n, (cases, known) in points.items()}
    # the kidneys' points need the day's urine, so they are given on the grid
    *others, kidneys = ORGANS
    hour = hour.select("icustay_id", "endtime", "urine", "creatinine", *[scored[o].alias(o) for o in others]).withColumn("others", pack_points(others))
    s = grid_merge(_grid(ctx), hour, "icustay_id", "endtime", ["urine", "creatinine", "others"]).withColumn("uo", F.sum("urine").over(own.rowsBetween(-23, 0)))
    now = F.coalesce("others", F.lit(0).cast("long")).bitwiseOR(pack_points([kidneys], first=len(others)))
    s = s.withColumn(kidneys, scored[kidneys]).withColumn("now", now).withColumn("day", F.bit_or("now").over(own.rowsBetween(-24, 0))).filter("hr >= 0")
    s = s.select(
        "icustay_id", "hr", (c("endtime") - hours(1)).alias("starttime"), "endtime", *[unpack_points(c("now"), i).alias(o) for i, o in enumerate(ORGANS)],
        *[F.coalesce(unpack_points(c("day"), i), F.lit(0)).alias(f"{o}_24hours") for i, o in enumerate(ORGANS)],
    )
    return s.withColumn("sofa_24hours", sum((c(f"{o}_24hours") for o in ORGANS), F.lit(0)))


# The time before the stay in seconds; the other parts are those of the first day.
_BEFORE = {"known": ["preiculos"], "otherwise": 2, "tests": [("preiculos", "<", 612, 5), ("preiculos", "<", 17820, 3), ("preiculos", "<", 86400, 0), ("preiculos", "<", 1123680, 1)]}
_PARTS = {"preiculos_score": _BEFORE, **{n: p for n, p in _OASIS.items() if n != "preiculos_score"}}
_PARTS_SQL = {"preiculos_score": "CASE WHEN preiculos IS NOT NULL THEN [5, 3, 0, 1, 2][1 + CAST(preiculos >= 612 AS INT) + CAST(preiculos >= 17820 AS INT) + CAST(preiculos >= 86400 AS INT) + CAST(preiculos >= 1123680 AS INT)] END", **{n: e for n, e in _OASIS_SQL.items() if n != "preiculos_score"}}
_FIXED = ("preiculos_score", "electivesurgery_score")
_MOVING = [n for n in _PARTS if n not in _FIXED]
# Parts that the readings of an hour decide alone, and the most points of any part; age is the same in every hour.
_HOURLY, _TOP = ["gcs_score", "heartrate_score", "meanbp_score", "resprate_score", "temp_score", "mechvent_score"], 10
_READINGS = ("heartrate", "tempc", "meanbp", "resprate")


@concept("pivoted_oasis", ["icustay_hours", "older_icustays", "admissions", "older_patients", "services", "pivoted_vital", "pivoted_gcs", "ventilation_durations", "pivoted_uo"], f"""
WITH g AS ({_GRID_SQL}), v AS ({_hour_sql('pivoted_vital', 'icustay_id', ', '.join(f'min({x}) AS {x}_min, max({x}) AS {x}_max' for x in _READINGS))}), c AS ({_hour_sql('pivoted_gcs', 'icustay_id', 'min(gcs) AS mingcs')}), u AS ({_hour_sql('pivoted_uo', 'icustay_id', 'sum(urineoutput) AS urine')}),
e AS (SELECT i.icustay_id, max(CAST(contains(lower(curr_service), 'surg') OR curr_service = 'ORTHO' AS INT)) AS surgical FROM older_icustays i JOIN services s ON s.hadm_id = i.hadm_id AND s.transfertime < i.intime + INTERVAL '1' DAY GROUP BY 1),
j AS (SELECT g.icustay_id, g.hr, g.starttime, g.endtime, {', '.join(f'{x}_min, {x}_max' for x in _READINGS)}, mingcs, date_diff('year', p.dob, i.intime) AS age, date_diff('second', a.admittime, i.intime) AS preiculos,
  CAST(EXISTS (SELECT 1 FROM ventilation_durations d WHERE d.icustay_id = g.icustay_id AND (g.starttime BETWEEN d.starttime AND d.endtime OR g.endtime BETWEEN d.starttime AND d.endtime)) AS INT) AS mechvent,
  CASE WHEN a.admission_type IS NOT NULL THEN CAST(a.admission_type = 'ELECTIVE' AND coalesce(surgical, 0) = 1 AS INT) END AS electivesurgery, sum(urine) OVER (PARTITION BY g.icustay_id ORDER BY g.hr ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS urineoutput
  FROM g JOIN older_icustays i ON i.icustay_id = g.icustay_id JOIN admissions a ON a.hadm_id = g.hadm_id JOIN older_patients p ON p.subject_id = i.subject_id LEFT JOIN e ON e.icustay_id = g.icustay_id
  LEFT JOIN v ON v.icustay_id = g.icustay_id AND v.hr = g.hr LEFT JOIN c ON c.icustay_id = g.icustay_id AND c.hr = g.hr LEFT JOIN u ON u.icustay_id = g.icustay_id AND u.hr = g.hr),
s AS (SELECT icustay_id, hr, starttime, endtime, {', '.join(f'CAST({x} AS INT) AS {n}' for n, x in _PARTS_SQL.items())} FROM j),
w AS (SELECT *, {', '.join(f'{n} AS {n}_24hours' for n in _FIXED)}, {', '.join(f'coalesce(max({n}) OVER w, 0) AS {n}_24hours' for n in _MOVING)} FROM s WINDOW w AS (PARTITION BY icustay_id ORDER BY hr ROWS BETWEEN 23 PRECEDING AND CURRENT ROW))
SELECT *, {' + '.join(f'{n}_24hours' for n in _PARTS)} AS oasis_24hours FROM w WHERE hr >= 0""")
def pivoted_oasis(ctx):
    """Acute illness of every hour and the worst of each part over the last 24."""
    c, stays, day = F.col, ctx["older_icustays"], Window.partitionBy("icustay_id").orderBy("endtime").rowsBetween(-23, 0)
    surgical = F.max((F.lower("curr_service").contains("surg") | (c("curr_service") == "ORTHO")).cast("int")).alias("surgical")
    wards = stays.select("hadm_id", "icustay_id", "intime").join(ctx["services"].select("hadm_id", "transfertime", "curr_service"), "hadm_id").filter(c("transfertime") < c("intime") + hours(24)).groupBy("icustay_id").agg(surgical)
    people = stays.select(*STAY, "intime").join(ctx["admissions"].select("hadm_id", "admittime", "admission_type"), "hadm_id").join(ctx["older_patients"].select("subject_id", "dob"), "subject_id").join(wards, "icustay_id", "left")
    planned = F.when(c("admission_type").isNotNull(), ((c("admission_type") == "ELECTIVE") & (F.coalesce("surgical", F.lit(0)) == 1)).cast("int"))
    people = people.select("icustay_id", dt_diff(c("intime"), c("dob"), "YEAR").alias("age"), dt_diff(c("intime"), c("admittime"), "SECOND").alias("preiculos"), planned.alias("electivesurgery"))
    # an hour is ventilated if a run covers its start or its end
    runs = covered_hours(ctx["ventilation_durations"].select("icustay_id", "starttime", "endtime"), ceil_hour(c("starttime")), dt_trunc(c("endtime"), "HOUR"), "at", after=1)
    readings = [
        ctx["pivoted_vital"].select("icustay_id", "charttime", *_READINGS), ctx["pivoted_gcs"].select("icustay_id", "charttime", "gcs"),
        ctx["pivoted_uo"].select("icustay_id", "charttime", c("urineoutput").alias("urine")), runs.select("icustay_id", c("at").alias("endtime"), F.lit(1).alias("held")),
    ]
    extremes = {f"{x}_{n}": f(x) for x in _READINGS for n, f in (("min", F.min), ("max", F.max))}
    hour = hour_summary(readings, "icustay_id", "charttime", "endtime", **extremes, mingcs=F.min("gcs"), urine=F.sum("urine"), mechvent=F.max("held"))
    # what an hour's own readings decide is packed before the merge; the day's urine and the stay's circumstances follow
    hour = hour.select("icustay_id", "endtime", "urine", *[_points(_PARTS[n]).alias(n) for n in _HOURLY]).select("icustay_id", "endtime", "urine", pack_points(_HOURLY[:4], _TOP).alias("a"), pack_points(_HOURLY[4:], _TOP).alias("b"))
    s = grid_merge(_grid(ctx), hour, "icustay_id", "endtime", ["urine", "a", "b"]).withColumn("urineoutput", F.sum("urine").over(day)).withColumn("urineoutput_score", _points(_PARTS["urineoutput_score"]))
    s = s.withColumn("b", F.coalesce("b", F.lit(0).cast("long")).bitwiseOR(pack_points(["urineoutput_score"], _TOP, first=len(_HOURLY) - 4)))
    s = s.withColumns({"a_day": F.bit_or("a").over(day), "b_day": F.bit_or("b").over(day)}).filter("hr >= 0").join(people, "icustay_id")
    at = {n: (x, i) for x, names in (("a", _HOURLY[:4]), ("b", [*_HOURLY[4:], "urineoutput_score"])) for i, n in enumerate(names)}
    own = {n: unpack_points(c(at[n][0]), at[n][1], _TOP) if n in at else _points(part) for n, part in _PARTS.items()}
    # an hour without readings is one without ventilation, which has 0 points
    own["mechvent_score"] = F.coalesce(own["mechvent_score"], F.lit(0))
    worst = {n: F.coalesce(unpack_points(c(f"{at[n][0]}_day"), at[n][1], _TOP), F.lit(0)) if n in at else own[n] if n in _FIXED else F.coalesce(own[n], F.lit(0)) for n in _PARTS}
    s = s.select("icustay_id", "hr", (c("endtime") - hours(1)).alias("starttime"), "endtime", *[x.alias(n) for n, x in own.items()], *[x.alias(f"{n}_24hours") for n, x in worst.items()])
    return s.withColumn("oasis_24hours", sum((c(f"{n}_24hours") for n in _PARTS), F.lit(0)))
