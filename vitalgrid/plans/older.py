"""Derived tables of the older generation: two bedside systems side by side.

One system charts rates at points in time, the other orders with start and end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.dt import MICROS, dt_diff, micros
from vitalgrid.functions.scalar import step_score
from vitalgrid.operators.episodes import merge_adjacent_equal, merge_overlaps
from vitalgrid.operators.joins import interval_join
from vitalgrid.plans.comorbidity import prefix_flags, rules_sql
from vitalgrid.plans.registry import concept

# Codes of each drug in the charting and in the ordering system.
DRUGS = {
    "adenosine": ((4649,), 221282), "dobutamine": ((30042, 30306), 221653), "dopamine": ((30043, 30307), 221662), "epinephrine": ((30044, 30119, 30309), 221289), "isuprel": ((30046,), 227692),
    "milrinone": ((30125,), 221986), "norepinephrine": ((30047, 30120), 221906), "phenylephrine": ((30127, 30128), 221749), "vasopressin": ((30051,), 222315),
}
PRESSORS = ["norepinephrine", "epinephrine", "phenylephrine", "vasopressin", "dopamine", "dobutamine", "milrinone"]


def charted_runs(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Readings with ``run``, the number of the infusion they belong to, and ``off`` where it ends.

    ``known`` is the last rate that was charted.  A run starts with the first positive rate, with a rate
    above zero after a known zero, and after a stop; a reading after a zero that is zero itself does not.
    """
    stop = F.col("stopped").like("D/C%") | (F.col("stopped") == "Stopped")
    at = rows.groupBy(*keys, "charttime").agg(F.max("rate").alias("rate"), F.max("amount").alias("amount"), F.max(F.coalesce(stop, F.lit(False))).alias("stop"))
    w = Window.partitionBy(*keys).orderBy("charttime")
    at = at.withColumn("known", F.last("rate", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    was, stopped = F.lag("known").over(w), F.lag("stop").over(w)
    start = F.when(was.isNull() & (F.col("rate") > 0), 1).when(was == 0, F.when(F.col("known") == 0, 0).otherwise(1)).when(stopped, 1)
    at = at.withColumns({"start": start, "last": F.lead("charttime").over(w).isNull()})
    numbered = at.withColumn("run", F.sum("start").over(w))
    return numbered.withColumn("off", F.col("stop") | F.coalesce(F.col("rate") == 0, F.lit(False)) | F.col("last"))


def charted_episodes(rows: DataFrame, keys: list[str]) -> DataFrame:
    runs = charted_runs(rows, keys).filter("run > 0")
    ends = runs.groupBy(*keys, "run").agg(
        F.min(F.when(F.col("rate").isNotNull(), F.col("charttime"))).alias("starttime"), F.min(F.when(F.col("off"), F.col("charttime"))).alias("endtime"),
        F.min("charttime").alias("first"), F.max("rate").alias("top"),
    )
    return ends.filter("first <> endtime AND top > 0").select(*keys, "starttime", "endtime")


def numbered(df: DataFrame, id_: str = "icustay_id") -> DataFrame:
    w = Window.partitionBy(id_).orderBy("starttime", "endtime")
    return df.select(id_, F.row_number().over(w).cast("long").alias("vasonum"), "starttime", "endtime", dt_diff(F.col("endtime"), F.col("starttime"), "HOUR").alias("duration_hours"))


RUNS_SQL = """c1 AS (SELECT {keys}, charttime, max(rate) AS rate, max(amount) AS amount, max(CASE WHEN stopped = 'Stopped' OR stopped LIKE 'D/C%' THEN 1 ELSE 0 END) AS stop FROM inputevents_cv WHERE itemid IN ({codes}) GROUP BY ALL),
c2 AS (SELECT *, last_value(rate IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY charttime ROWS UNBOUNDED PRECEDING) AS known FROM c1),
c3 AS (SELECT *, lag(known) OVER w AS was, lag(stop) OVER w AS halted, lead(charttime) OVER w IS NULL AS fin FROM c2 WINDOW w AS (PARTITION BY {keys} ORDER BY charttime)),
c4 AS (SELECT *, sum(CASE WHEN was IS NULL AND rate > 0 THEN 1 WHEN was = 0 AND known = 0 THEN 0 WHEN was = 0 THEN 1 WHEN halted = 1 THEN 1 END) OVER (PARTITION BY {keys} ORDER BY charttime) AS run FROM c3),
c5 AS (SELECT *, CASE WHEN stop = 1 OR rate = 0 OR fin THEN 1 ELSE 0 END AS off FROM c4)"""
EPISODES_SQL = RUNS_SQL + """,
c6 AS (SELECT {keys}, run, min(charttime) FILTER (WHERE rate IS NOT NULL) AS starttime, min(charttime) FILTER (WHERE off = 1) AS endtime FROM c5 WHERE run > 0 GROUP BY ALL
       HAVING min(charttime) <> min(charttime) FILTER (WHERE off = 1) AND max(rate) > 0)"""
NUMBER_SQL = "SELECT icustay_id, row_number() OVER (PARTITION BY icustay_id ORDER BY starttime, endtime) AS vasonum, starttime, endtime, date_diff('hour', starttime, endtime) AS duration_hours FROM {}"


def _in(codes) -> str:
    return ", ".join(map(str, codes))


def _durations(name: str, charted: tuple[int, ...], ordered: int) -> None:
    @concept(f"{name}_durations", ["inputevents_cv", "inputevents_mv"], f"""
WITH {EPISODES_SQL.format(keys='icustay_id', codes=_in(charted))},
m AS (SELECT icustay_id, linkorderid, min(starttime) AS starttime, max(endtime) AS endtime FROM inputevents_mv WHERE itemid = {ordered} AND statusdescription <> 'Rewritten' GROUP BY 1, 2)
{NUMBER_SQL.format('c6')} UNION ALL {NUMBER_SQL.format('m')}""")
    def build(ctx):
        points = ctx["inputevents_cv"].filter(F.col("itemid").isin(list(charted)))
        orders = ctx["inputevents_mv"].filter((F.col("itemid") == ordered) & (F.col("statusdescription") != "Rewritten"))
        whole = orders.groupBy("icustay_id", "linkorderid").agg(F.min("starttime").alias("starttime"), F.max("endtime").alias("endtime"))
        return numbered(charted_episodes(points, ["icustay_id"])).unionByName(numbered(whole))


def _dose(name: str, charted: tuple[int, ...], ordered: int) -> None:
    hourly = name == "vasopressin"
    rate_sql = "CASE WHEN rateuom = 'units/min' THEN rate * 60 ELSE rate END" if hourly else "rate"

    @concept(f"{name}_dose", ["inputevents_cv", "inputevents_mv"], f"""
WITH {RUNS_SQL.format(keys='icustay_id', codes=_in(charted))},
d AS (SELECT icustay_id, charttime AS starttime, lead(charttime) OVER (PARTITION BY icustay_id, run ORDER BY charttime) AS endtime, rate, amount FROM c5 WHERE run > 0),
e AS (SELECT *, lag(endtime) OVER w AS pe, lag(rate) OVER w AS pr FROM d WHERE endtime IS NOT NULL AND rate > 0 WINDOW w AS (PARTITION BY icustay_id ORDER BY starttime, endtime)),
f AS (SELECT *, sum(CASE WHEN pe = starttime AND pr = rate THEN 0 ELSE 1 END) OVER (PARTITION BY icustay_id ORDER BY starttime, endtime) AS n FROM e)
SELECT icustay_id, min(starttime) AS starttime, max(endtime) AS endtime, rate AS vaso_rate, sum(amount) AS vaso_amount FROM f GROUP BY icustay_id, n, rate
UNION ALL SELECT icustay_id, starttime, endtime, {rate_sql}, amount FROM inputevents_mv WHERE itemid = {ordered} AND statusdescription <> 'Rewritten'""")
    def build(ctx):
        runs = charted_runs(ctx["inputevents_cv"].filter(F.col("itemid").isin(list(charted))), ["icustay_id"]).filter("run > 0")
        until = F.lead("charttime").over(Window.partitionBy("icustay_id", "run").orderBy("charttime"))
        steps = runs.select("icustay_id", F.col("charttime").alias("starttime"), until.alias("endtime"), F.col("rate").alias("vaso_rate"), F.col("amount").alias("vaso_amount"))
        glued = merge_adjacent_equal(steps.filter("endtime IS NOT NULL AND vaso_rate > 0"), ["icustay_id"], "starttime", "endtime", "vaso_rate", "vaso_amount")
        orders = ctx["inputevents_mv"].filter((F.col("itemid") == ordered) & (F.col("statusdescription") != "Rewritten"))
        rate = F.when(F.col("rateuom") == "units/min", F.col("rate") * 60).otherwise(F.col("rate")) if hourly else F.col("rate")
        return glued.unionByName(orders.select("icustay_id", "starttime", "endtime", rate.alias("vaso_rate"), F.col("amount").alias("vaso_amount")))


def _weighted_dose(name: str, whole: int, per: tuple[int, ...], ordered: int, usual: float = 80.0) -> None:
    """A dose per kilogram: readings of the code ``whole`` are divided by the weight then known, or by a usual one."""
    codes = (whole, *per)
    runs = RUNS_SQL.format(keys="icustay_id", codes=_in(codes)).replace("FROM inputevents_cv", "FROM w0")

    @concept(f"{name}_dose", ["inputevents_cv", "inputevents_mv", "older_weight_durations"], f"""
WITH w0 AS (SELECT c.icustay_id, c.charttime, c.itemid, c.amount, c.stopped, CASE WHEN itemid = {whole} THEN rate / coalesce(w.weight, {usual}) ELSE rate END AS rate FROM inputevents_cv c LEFT JOIN older_weight_durations w ON w.icustay_id = c.icustay_id AND c.charttime BETWEEN w.starttime AND w.endtime WHERE itemid IN ({_in(codes)})),
{runs}, d AS (SELECT icustay_id, charttime AS starttime, lead(charttime) OVER (PARTITION BY icustay_id, run ORDER BY charttime) AS endtime, rate, amount FROM c5 WHERE run > 0),
e AS (SELECT *, lag(endtime) OVER w AS pe, lag(rate) OVER w AS pr FROM d WHERE endtime IS NOT NULL AND rate > 0 WINDOW w AS (PARTITION BY icustay_id ORDER BY starttime, endtime)),
f AS (SELECT *, sum(CASE WHEN pe = starttime AND pr = rate THEN 0 ELSE 1 END) OVER (PARTITION BY icustay_id ORDER BY starttime, endtime) AS n FROM e)
SELECT icustay_id, min(starttime) AS starttime, max(endtime) AS endtime, rate AS vaso_rate, sum(amount) AS vaso_amount FROM f GROUP BY icustay_id, n, rate
UNION ALL SELECT icustay_id, starttime, endtime, rate, amount FROM inputevents_mv WHERE itemid = {ordered} AND statusdescription <> 'Rewritten'""")
    def build(ctx):
        rows = ctx["inputevents_cv"].filter(F.col("itemid").isin(list(codes))).select("icustay_id", "charttime", "itemid", "rate", "amount", "stopped")
        weights = ctx["older_weight_durations"].select("icustay_id", F.col("starttime").alias("_s"), F.col("endtime").alias("_e"), "weight")
        rows = interval_join(rows, weights, ["icustay_id"], "charttime", "_s", "_e", how="left")
        rows = rows.withColumn("rate", F.when(F.col("itemid") == whole, F.col("rate") / F.coalesce("weight", F.lit(usual))).otherwise(F.col("rate")))
        runs = charted_runs(rows, ["icustay_id"]).filter("run > 0")
        until = F.lead("charttime").over(Window.partitionBy("icustay_id", "run").orderBy("charttime"))
        steps = runs.select("icustay_id", F.col("charttime").alias("starttime"), until.alias("endtime"), F.col("rate").alias("vaso_rate"), F.col("amount").alias("vaso_amount"))
        glued = merge_adjacent_equal(steps.filter("endtime IS NOT NULL AND vaso_rate > 0"), ["icustay_id"], "starttime", "endtime", "vaso_rate", "vaso_amount")
        orders = ctx["inputevents_mv"].filter((F.col("itemid") == ordered) & (F.col("statusdescription") != "Rewritten"))
        return glued.unionByName(orders.select("icustay_id", "starttime", "endtime", F.col("rate").alias("vaso_rate"), F.col("amount").alias("vaso_amount")))


_weighted_dose("norepinephrine", 30047, (30120,), 221906)
_weighted_dose("epinephrine", 30044, (30119, 30309), 221289)

for _name, (_charted, _ordered) in DRUGS.items():
    _durations(_name, _charted, _ordered)
for _name in ("dobutamine", "dopamine", "phenylephrine", "vasopressin"):
    _dose(_name, *DRUGS[_name])

# Codes of neuromuscular blockers: fluids, chart entries, orders; fluids from 40000 on give their amount as rate.
BLOCKER_FLUIDS, BLOCKER_CHART, BLOCKER_ORDERS = [30114, 30138, 30113, 42174, 42385, 41916, 42100, 42045, 42246, 42291, 42590, 42284, 45096], [1856, 2164, 2548, 2285, 2290, 2670, 2546, 1098, 2390, 2511, 1028, 1858], [222062, 221555]


@concept("neuroblock_dose", ["older_blockers", "inputevents_mv"], f"""
WITH a AS (SELECT icustay_id, charttime, max(CAST(stopped IN ('Stopped', 'D/C''d') AS INT)) AS stop, max(CASE WHEN itemid >= 40000 THEN CAST(amount IS NOT NULL AS INT) ELSE CAST(rate IS NOT NULL AS INT) END) AS told, max(CASE WHEN itemid >= 40000 THEN coalesce(rate, amount) ELSE rate END) AS rate, max(amount) AS amount
    FROM older_blockers WHERE side = 'fluid' AND itemid IN ({_in(BLOCKER_FLUIDS)}) GROUP BY 1, 2
  UNION SELECT icustay_id, charttime, max(CAST(stopped IN ('Stopped', 'D/C''d') AS INT)), max(CASE WHEN valuenum <= 10 THEN 0 ELSE 1 END), max(CASE WHEN valuenum <= 10 THEN valuenum END), max(CASE WHEN valuenum > 10 THEN valuenum END) FROM older_blockers WHERE side = 'chart' AND itemid IN ({_in(BLOCKER_CHART)}) GROUP BY 1, 2),
b AS (SELECT *, sum(told) OVER (PARTITION BY icustay_id ORDER BY charttime) AS part FROM a), c AS (SELECT *, first_value(rate) OVER (PARTITION BY icustay_id, part ORDER BY charttime) AS known FROM b),
d AS (SELECT *, lag(known) OVER (PARTITION BY icustay_id, told ORDER BY charttime) AS alike, lag(known) OVER w AS was, coalesce(lag(stop) OVER w, 0) AS halted, lag(charttime) OVER w AS before FROM c WINDOW w AS (PARTITION BY icustay_id ORDER BY charttime)),
e AS (SELECT *, sum(CASE WHEN rate > 0 AND alike IS NULL THEN 1 WHEN was = 0 AND (rate = 0 OR known = 0) THEN 0 WHEN was = 0 OR halted = 1 OR charttime - before > INTERVAL '8' HOUR THEN 1 END) OVER (PARTITION BY icustay_id ORDER BY charttime) AS run FROM d),
f AS (SELECT *, lead(charttime) OVER (PARTITION BY icustay_id, run ORDER BY charttime) AS until FROM e WHERE run > 0 AND icustay_id IS NOT NULL),
g AS (SELECT *, CASE WHEN lag(until) OVER w = charttime AND lag(rate) OVER w = rate THEN 0 ELSE 1 END AS fresh FROM f WHERE until IS NOT NULL AND rate > 0 AND until <> charttime WINDOW w AS (PARTITION BY icustay_id ORDER BY charttime, until)),
h AS (SELECT *, sum(fresh) OVER (PARTITION BY icustay_id ORDER BY charttime, until) AS n FROM g)
SELECT icustay_id, min(charttime) AS starttime, max(until) AS endtime, rate AS drug_rate, sum(amount) AS drug_amount FROM h GROUP BY icustay_id, n, rate
UNION SELECT icustay_id, starttime, endtime, rate, amount FROM inputevents_mv WHERE itemid IN ({_in(BLOCKER_ORDERS)}) AND statusdescription <> 'Rewritten' AND rate IS NOT NULL""")
def neuroblock_dose(ctx):
    """Times at one rate of a blocker: runs as for other infusions, also ended by eight hours without an entry."""
    c, code = F.col, F.col("itemid")
    stop = F.max(c("stopped").isin("Stopped", "D/C'd").cast("int")).alias("stop")
    swapped = code >= 40000
    fluids = ctx["older_blockers"].filter((c("side") == "fluid") & code.isin(BLOCKER_FLUIDS)).groupBy("icustay_id", "charttime").agg(
        stop, F.max(F.when(swapped, c("amount").isNotNull()).otherwise(c("rate").isNotNull()).cast("int")).alias("told"), F.max(F.when(swapped, F.coalesce("rate", "amount")).otherwise(c("rate"))).alias("rate"), F.max("amount").alias("amount"))
    low = c("valuenum") <= 10
    chart = ctx["older_blockers"].filter((c("side") == "chart") & code.isin(BLOCKER_CHART)).groupBy("icustay_id", "charttime").agg(
        stop, F.max(F.when(low, 0).otherwise(1)).alias("told"), F.max(F.when(low, c("valuenum"))).alias("rate"), F.max(F.when(c("valuenum") > 10, c("valuenum"))).alias("amount"))
    at = fluids.unionByName(chart).distinct()
    own = Window.partitionBy("icustay_id").orderBy("charttime")
    at = at.withColumn("part", F.sum("told").over(own)).withColumn("known", F.first("rate").over(Window.partitionBy("icustay_id", "part").orderBy("charttime")))
    alike = F.lag("known").over(Window.partitionBy("icustay_id", "told").orderBy("charttime"))
    was, far = F.lag("known").over(own), (micros(c("charttime")) - micros(F.lag("charttime").over(own))) > 8 * MICROS["HOUR"]
    start = F.when((c("rate") > 0) & alike.isNull(), 1).when((was == 0) & ((c("rate") == 0) | (c("known") == 0)), 0).when((was == 0) | (F.lag("stop").over(own) == 1) | far, 1)
    runs = at.withColumn("_start", start).withColumn("run", F.sum("_start").over(own)).filter("run > 0 AND icustay_id IS NOT NULL")
    until = F.lead("charttime").over(Window.partitionBy("icustay_id", "run").orderBy("charttime"))
    steps = runs.select("icustay_id", c("charttime").alias("starttime"), until.alias("endtime"), c("rate").alias("drug_rate"), c("amount").alias("drug_amount")).filter("endtime IS NOT NULL AND drug_rate > 0 AND endtime <> starttime")
    glued = merge_adjacent_equal(steps, ["icustay_id"], "starttime", "endtime", "drug_rate", "drug_amount")
    orders = ctx["inputevents_mv"].filter(code.isin(BLOCKER_ORDERS) & (c("statusdescription") != "Rewritten") & c("rate").isNotNull())
    return glued.unionByName(orders.select("icustay_id", "starttime", "endtime", c("rate").alias("drug_rate"), c("amount").alias("drug_amount"))).distinct()


_codes = [c for d in PRESSORS for c in DRUGS[d][0]] + [42273, 42802]
_orders = [DRUGS[d][1] for d in PRESSORS]
_MERGE = """{o}1 AS (SELECT *, max(endtime) OVER (PARTITION BY icustay_id ORDER BY starttime, endtime ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM (SELECT DISTINCT icustay_id, starttime, endtime FROM {i}) d),
{o}2 AS (SELECT *, sum(CASE WHEN r >= starttime THEN 0 ELSE 1 END) OVER (PARTITION BY icustay_id ORDER BY starttime, endtime ROWS UNBOUNDED PRECEDING) AS k FROM {o}1), {o} AS (SELECT icustay_id, min(starttime) AS starttime, max(endtime) AS endtime FROM {o}2 GROUP BY icustay_id, k)"""


@concept("vasopressor_durations", ["inputevents_cv", "inputevents_mv"], f"""
WITH {EPISODES_SQL.format(keys='icustay_id, itemid', codes=_in(_codes))}, {_MERGE.format(i='c6', o='cg')},
m AS (SELECT icustay_id, linkorderid, min(starttime) AS starttime, max(endtime) AS endtime FROM inputevents_mv WHERE itemid IN ({_in(_orders)}) AND statusdescription <> 'Rewritten' GROUP BY 1, 2), {_MERGE.format(i='m', o='mg')}
{NUMBER_SQL.format('cg')} UNION ALL {NUMBER_SQL.format('mg')}""")
def vasopressor_durations(ctx):
    """Time under any pressor: episodes of each drug merged where they touch.  Two codes have rate and amount swapped."""
    swapped = F.col("itemid").isin(42273, 42802)
    points = ctx["inputevents_cv"].filter(F.col("itemid").isin(_codes)).withColumns({"rate": F.when(swapped, F.col("amount")).otherwise(F.col("rate")), "amount": F.when(swapped, F.col("rate")).otherwise(F.col("amount"))})
    charted = merge_overlaps(charted_episodes(points, ["icustay_id", "itemid"]).drop("itemid"), ["icustay_id"], "starttime", "endtime")
    orders = ctx["inputevents_mv"].filter(F.col("itemid").isin(_orders) & (F.col("statusdescription") != "Rewritten"))
    whole = orders.groupBy("icustay_id", "linkorderid").agg(F.min("starttime").alias("starttime"), F.max("endtime").alias("endtime")).drop("linkorderid")
    return numbered(charted).unionByName(numbered(merge_overlaps(whole, ["icustay_id"], "starttime", "endtime")))


# Diagnosis prefixes of the code-based sepsis definitions.
EXPLICIT = {"severe_sepsis": {9: "99592"}, "septic_shock": {9: "78552"}}
ANGUS = {
    "infection": {9: "001 002 003 004 005 008 009 010 011 012 013 014 015 016 017 018 020 021 022 023 024 025 026 027 030 031 032 033 034 035 036 037 038 039 040 041 090 091 092 093 094 095 096 097 098 100 101 102 103 104 110 111 112 114 115 116 117 118 320 322 324 325 420 421 451 461 462 463 464 465 481 482 485 486 494 510 513 540 541 542 566 567 590 597 601 614 615 616 681 682 683 686 730 5695 5720 5721 5750 5990 7110 7907 9966 9985 9993 49121 56201 56203 56211 56213 56983"},
    "explicit_sepsis": {9: "99592 78552"}, "organ_dysfunction": {9: "458 293 570 584 7855 3483 3481 2874 2875 2869 2866 5734"},
}
MARTIN = {
    "sepsis": {9: "038 0202 7907 1179 1125 11281"}, "dx_respiratory": {9: "7991 51881 51882 51885 78609"}, "cardiovascular": {9: "4580 7855 4588 4589 7963"}, "dx_renal": {9: "584 580 585"},
    "hepatic": {9: "570 5722 5733"}, "hematologic": {9: "2862 2866 2869 2873 2874 2875"}, "metabolic": {9: "2762"}, "dx_neurologic": {9: "293 3481 3483 78001 78009"},
}


def _coded(rules) -> str:
    return f"c AS (SELECT a.subject_id, a.hadm_id, {rules_sql(rules)} FROM admissions a LEFT JOIN diagnoses_icd d ON d.hadm_id = a.hadm_id GROUP BY ALL)"


def _flags(ctx, rules) -> DataFrame:
    found = prefix_flags(ctx["diagnoses_icd"], "hadm_id", rules)
    j = ctx["admissions"].select("subject_id", "hadm_id").join(found, "hadm_id", "left")
    return j.withColumns({c: F.coalesce(c, F.lit(0)) for c in rules})


def _done(ctx, **codes) -> DataFrame:
    return ctx["procedures_icd"].groupBy("hadm_id").agg(*[F.max(F.col("icd9_code").isin(v).cast("int")).alias(k) for k, v in codes.items()])


@concept("explicit", ["admissions", "diagnoses_icd"], f"WITH {_coded(EXPLICIT)} SELECT *, greatest(severe_sepsis, septic_shock) AS sepsis FROM c")
def explicit(ctx):
    return _flags(ctx, EXPLICIT).withColumn("sepsis", F.greatest("severe_sepsis", "septic_shock"))


@concept("angus", ["admissions", "diagnoses_icd", "procedures_icd"], f"""
WITH {_coded(ANGUS)}, p AS (SELECT c.*, CASE WHEN hadm_id IN (SELECT hadm_id FROM procedures_icd WHERE icd9_code IN ('9670', '9671', '9672')) THEN 1 ELSE 0 END AS mech_vent FROM c)
SELECT *, CASE WHEN explicit_sepsis = 1 OR (infection = 1 AND (organ_dysfunction = 1 OR mech_vent = 1)) THEN 1 ELSE 0 END AS angus FROM p""")
def angus(ctx):
    """Infection with organ dysfunction or ventilation, or sepsis coded outright."""
    j = _flags(ctx, ANGUS).join(_done(ctx, mech_vent=["9670", "9671", "9672"]), "hadm_id", "left").withColumn("mech_vent", F.coalesce("mech_vent", F.lit(0)))
    on = lambda c: F.col(c) == 1
    return j.withColumn("angus", (on("explicit_sepsis") | (on("infection") & (on("organ_dysfunction") | on("mech_vent")))).cast("int"))


@concept("martin", ["admissions", "diagnoses_icd", "procedures_icd"], f"""
WITH {_coded(MARTIN)}, p AS (SELECT hadm_id, max(CASE WHEN icd9_code = '967' THEN 1 ELSE 0 END) AS pr, max(CASE WHEN icd9_code = '3995' THEN 1 ELSE 0 END) AS pn, max(CASE WHEN icd9_code = '8914' THEN 1 ELSE 0 END) AS pe FROM procedures_icd GROUP BY 1),
q AS (SELECT subject_id, hadm_id, sepsis, greatest(dx_respiratory, coalesce(pr, 0)) AS respiratory, cardiovascular, greatest(dx_renal, coalesce(pn, 0)) AS renal, hepatic, hematologic, metabolic, greatest(dx_neurologic, coalesce(pe, 0)) AS neurologic FROM c LEFT JOIN p USING (hadm_id))
SELECT *, greatest(respiratory, cardiovascular, renal, hepatic, hematologic, metabolic, neurologic) AS organ_failure FROM q""")
def martin(ctx):
    j = _flags(ctx, MARTIN).join(_done(ctx, pr=["967"], pn=["3995"], pe=["8914"]), "hadm_id", "left")
    either = lambda d, p: F.greatest(d, F.coalesce(p, F.lit(0)))
    out = j.select(
        "subject_id", "hadm_id", "sepsis", either("dx_respiratory", "pr").alias("respiratory"), "cardiovascular", either("dx_renal", "pn").alias("renal"), "hepatic", "hematologic", "metabolic",
        either("dx_neurologic", "pe").alias("neurologic"),
    )
    return out.withColumn("organ_failure", F.greatest("respiratory", "cardiovascular", "renal", "hepatic", "hematologic", "metabolic", "neurologic"))


@concept("qsofa", ["icustays", "first_day_vitalsign", "first_day_gcs"], """
WITH s AS (SELECT i.subject_id, i.hadm_id, i.stay_id, CASE WHEN sbp_min <= 100 THEN 1 WHEN sbp_min IS NOT NULL THEN 0 END AS sysbp_score, CASE WHEN gcs_min <= 13 THEN 1 WHEN gcs_min IS NOT NULL THEN 0 END AS gcs_score,
  CASE WHEN resp_rate_max >= 22 THEN 1 WHEN resp_rate_max IS NOT NULL THEN 0 END AS resprate_score FROM icustays i LEFT JOIN first_day_vitalsign USING (stay_id) LEFT JOIN first_day_gcs USING (stay_id))
SELECT *, coalesce(sysbp_score, 0) + coalesce(gcs_score, 0) + coalesce(resprate_score, 0) AS qsofa FROM s""")
def qsofa(ctx):
    j = ctx["icustays"].select("subject_id", "hadm_id", "stay_id").join(ctx["first_day_vitalsign"].select("stay_id", "sbp_min", "resp_rate_max"), "stay_id", "left")
    j = j.join(ctx["first_day_gcs"].select("stay_id", "gcs_min"), "stay_id", "left")
    tests = {"sysbp_score": ("sbp_min", F.col("sbp_min") <= 100), "gcs_score": ("gcs_min", F.col("gcs_min") <= 13), "resprate_score": ("resp_rate_max", F.col("resp_rate_max") >= 22)}
    s = j.select("subject_id", "hadm_id", "stay_id", *[step_score([(c, 1)], 0, F.col(x).isNull()).alias(n) for n, (x, c) in tests.items()])
    return s.withColumn("qsofa", sum((F.coalesce(n, F.lit(0)) for n in tests), F.lit(0)))
