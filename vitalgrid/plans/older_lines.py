"""Invasive lines and continuous dialysis of the older generation, and heights from charts and notes."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from vitalgrid.functions.dt import dt_diff
from vitalgrid.functions.scalar import extract, num
from vitalgrid.operators.episodes import slot_episodes
from vitalgrid.operators.joins import interval_join
from vitalgrid.plans.registry import concept

# Codes of the eight numbered lines' types and sites, of placed lines, and common names.
LINE_TYPES, LINE_SITES = [229, 235, 241, 247, 253, 259, 265, 271], [8392, 8393, 8394, 8395, 8396, 8397, 8398, 8399]
PLACED = [227719, 225752, 224269, 224267, 224270, 224272, 226124, 228169, 225202, 228286, 225204, 224263, 224560, 224264, 225203, 224273, 225789, 225761, 228201, 228202, 224268, 225199, 225315, 225205]
TYPE_NAMES = {
    "Arterial": ["Arterial Line", "A-Line"], "Continuous Cardiac Output PA": ["CCO PA Line", "CCO PAC"], "Dialysis": ["Dialysis Catheter", "Dialysis Line"], "Hickman": ["Hickman", "Tunneled (Hickman) Line"], "IABP": ["IABP", "IABP line"],
    "Multi Lumen": ["Multi Lumen", "Multi-lumen"], "PA": ["PA Catheter", "PA line"], "PICC": ["PICC Line", "PICC line"], "Pre-Sep": ["Pre-Sep Catheter", "Presep Catheter"], "Trauma": ["Trauma Line", "Trauma line"],
    "Triple Introducer": ["Triple Introducer", "TripleIntroducer"], "Portacath": ["Portacath", "Indwelling Port (PortaCath)"],
}
SITE_NAMES = {f"{side} {site}": [f"{side} {x}" for x in written] for side in ("Left", "Right") for site, written in (("Antecube", ["Antecub", "Antecube"]), ("Axilla", ["Axilla", "Axilla."]), ("Brachial", ["Brachial", "Brachial."]), ("Femoral", ["Femoral", "Femoral."]))}


def _in(codes) -> str:
    return ", ".join(map(str, codes))


def _renamed(column: str, names: dict[str, list[str]]) -> Column:
    table = F.create_map(*[F.lit(x) for name, written in names.items() for w in written for x in (w, name)])
    return F.coalesce(F.try_element_at(table, F.col(column)), F.col(column))


def _names_sql(column: str, names: dict[str, list[str]]) -> str:
    rows = ", ".join(f"('{w}', '{name}')" for name, written in names.items() for w in written)
    return f"coalesce((SELECT name FROM (VALUES {rows}) AS v(written, name) WHERE written = {column}), {column})"


@concept("pivoted_invasive_lines", ["older_line_events", "older_line_procedures"], f"""
WITH a AS (SELECT icustay_id, charttime, itemid, value, stopped, list_position([{_in(LINE_TYPES)}], CASE WHEN itemid < 8000 THEN itemid ELSE CASE itemid {' '.join(f'WHEN {s} THEN {t}' for s, t in zip(LINE_SITES, LINE_TYPES))} END END) AS slot,
  row_number() OVER (PARTITION BY icustay_id, charttime, itemid ORDER BY storetime DESC, value DESC NULLS LAST, stopped DESC NULLS LAST) AS n FROM older_line_events WHERE itemid IN ({_in(LINE_TYPES + LINE_SITES)}) AND icustay_id IS NOT NULL AND coalesce(error, 0) = 0),
b AS (SELECT icustay_id, slot, charttime, max(value) FILTER (WHERE itemid < 8000) AS kind, max(value) FILTER (WHERE itemid > 8000) AS site, max(CASE stopped WHEN 'D/C''d' THEN 1 WHEN 'NotStopd' THEN 0 END) AS gone FROM a WHERE n = 1 GROUP BY ALL),
c AS (SELECT *, lag(gone) OVER w = 1 AS was_gone, lag(kind) OVER w = kind AND date_diff('hour', lag(charttime) OVER w, charttime) < 16 AS goes_on FROM b WINDOW w AS (PARTITION BY icustay_id, slot ORDER BY charttime)),
d AS (SELECT *, sum(CASE WHEN coalesce(was_gone, false) OR NOT coalesce(goes_on, false) THEN 1 ELSE 0 END) OVER (PARTITION BY icustay_id, slot ORDER BY charttime) AS episode FROM c),
e AS (SELECT icustay_id, kind, site, min(charttime) AS starttime, max(charttime) AS endtime FROM d WHERE gone = 0 GROUP BY icustay_id, slot, episode, kind, site
  UNION SELECT icustay_id, label, location, starttime, endtime FROM older_line_procedures WHERE itemid IN ({_in(PLACED)}) AND icustay_id IS NOT NULL AND statusdescription <> 'Rewritten')
SELECT icustay_id, {_names_sql('kind', TYPE_NAMES)} AS line_type, {_names_sql('site', SITE_NAMES)} AS line_site, starttime, endtime FROM e""")
def pivoted_invasive_lines(ctx):
    """Episodes of the numbered lines (type and site are charted apart) and of placed lines, under common names."""
    code = F.col("itemid")
    rows = ctx["older_line_events"].filter(code.isin(LINE_TYPES + LINE_SITES) & F.col("icustay_id").isNotNull() & (F.coalesce("error", F.lit(0)) == 0))
    last = Window.partitionBy("icustay_id", "charttime", "itemid").orderBy(F.desc("storetime"), F.desc_nulls_last("value"), F.desc_nulls_last("stopped"))
    rows = rows.withColumn("_n", F.row_number().over(last)).filter("_n = 1")
    slot = F.create_map(*[F.lit(x) for t, s in zip(LINE_TYPES, LINE_SITES) for x in (t, t, s, t)])[code]
    gone = F.when(F.col("stopped") == "D/C'd", 1).when(F.col("stopped") == "NotStopd", 0)
    aligned = rows.groupBy("icustay_id", slot.alias("slot"), "charttime").agg(F.max(F.when(code < 8000, F.col("value"))).alias("kind"), F.max(F.when(code > 8000, F.col("value"))).alias("site"), F.max(gone).alias("gone"))
    charted = slot_episodes(aligned, ["icustay_id", "slot"], "charttime", "kind", "gone", ["kind", "site"], 16).select("icustay_id", "kind", "site", "starttime", "endtime")
    placed = ctx["older_line_procedures"].filter(code.isin(PLACED) & F.col("icustay_id").isNotNull() & (F.col("statusdescription") != "Rewritten")).select("icustay_id", F.col("label").alias("kind"), F.col("location").alias("site"), "starttime", "endtime")
    both = charted.unionByName(placed).distinct()
    return both.select("icustay_id", _renamed("kind", TYPE_NAMES).alias("line_type"), _renamed("site", SITE_NAMES).alias("line_site"), "starttime", "endtime")


# Codes of heights, and of the formula for the ideal weight.
INCHES, CENTIMETRES = [920, 1394, 4187, 3486, 226707], [3485, 4188, 226730]
_CM = "CAST(round(CAST({} AS DECIMAL(38,9)), 2) AS DOUBLE)"


@concept("pivoted_height", ["older_chartevents", "older_patients", "older_notes"], f"""
WITH i AS (SELECT subject_id, charttime, {_CM.format('valuenum * CAST(2.54 AS DOUBLE)')} AS h FROM older_chartevents WHERE valuenum <> 0 AND coalesce(error, 0) = 0 AND itemid IN ({_in(INCHES)})),
c AS (SELECT subject_id, charttime, {_CM.format('valuenum')} AS h FROM older_chartevents WHERE valuenum <> 0 AND coalesce(error, 0) = 0 AND itemid IN ({_in(CENTIMETRES)})),
m AS (SELECT coalesce(c.subject_id, i.subject_id) AS subject_id, coalesce(c.charttime, i.charttime) AS charttime, coalesce(c.h, i.h) AS h FROM c FULL JOIN i ON c.subject_id = i.subject_id AND c.charttime = i.charttime),
a AS (SELECT m.subject_id, charttime, 'chartevents' AS source, h FROM m JOIN older_patients p ON p.subject_id = m.subject_id WHERE CASE WHEN date_diff('year', dob, charttime) <= 1 THEN h < 80 ELSE h > 120 AND h < 230 END),
e AS (SELECT subject_id, chartdate + CAST(regexp_extract(text, 'Date/Time: [][0-9*-]+ at ([0-9]{{2}}):', 1) AS INT) * INTERVAL '1' HOUR + CAST(regexp_extract(text, 'Date/Time: [][0-9*-]+ at [0-9]{{2}}:([0-9]{{2}})', 1) AS INT) * INTERVAL '1' MINUTE AS charttime, 'noteevents - echo' AS source,
  {_CM.format("try_cast(split_part(split_part(text, 'Height: (in) ', 2), chr(10), 1) AS DOUBLE) * CAST(2.54 AS DOUBLE)")} AS h FROM older_notes WHERE category = 'Echo'),
w AS (SELECT n.subject_id, charttime, 'noteevents - ibw' AS source, TRY_CAST(nullif(regexp_extract(text, 'Ideal body weight: ([0-9]+[.]?[0-9]*)', 1), '') AS DOUBLE) AS ibw, gender FROM older_notes n JOIN older_patients p ON p.subject_id = n.subject_id WHERE contains(text, 'Ideal body weight:') AND category <> 'Echo'),
x AS (SELECT subject_id, charttime, source, {_CM.format("(ibw - CASE WHEN gender = 'F' THEN CAST(45.5 AS DOUBLE) ELSE 50 END) / CAST(0.91 AS DOUBLE) + CAST(152.4 AS DOUBLE)")} AS h FROM w WHERE ibw <> 0),
t AS (SELECT subject_id, charttime, 'noteevents - nutrition' AS source, TRY_CAST(nullif(regexp_extract(text, '([0-9]+) cm', 1), '') AS DOUBLE) AS h FROM older_notes WHERE category = 'Nutrition' AND contains(lower(text), 'height')),
u AS (SELECT * FROM a UNION ALL SELECT * FROM e UNION ALL SELECT * FROM x UNION ALL SELECT subject_id, charttime, source, {_CM.format('CASE WHEN h < 80 THEN h * CAST(2.54 AS DOUBLE) ELSE h END')} FROM t)
SELECT subject_id, charttime, source, h AS height FROM u WHERE h > 0""")
def pivoted_height(ctx):
    """Heights in centimetres from charts, echo reports, ideal weights and nutrition notes, with the unit that the text states."""
    c, text = F.col, F.col("text")
    cm = lambda x: num(x, 2).alias("height")
    charted = ctx["older_chartevents"].filter("valuenum <> 0 AND coalesce(error, 0) = 0").select("subject_id", "charttime", "itemid", "valuenum")
    metric = charted.filter(c("itemid").isin(CENTIMETRES)).select("subject_id", "charttime", num(c("valuenum"), 2).alias("_cm"))
    inches = charted.filter(c("itemid").isin(INCHES)).select("subject_id", "charttime", num(c("valuenum") * 2.54, 2).alias("_in"))
    merged = metric.join(inches, ["subject_id", "charttime"], "full").withColumn("height", F.coalesce("_cm", "_in"))
    people = ctx["older_patients"].select("subject_id", "gender", "dob")
    infant = dt_diff(c("charttime"), c("dob"), "YEAR") <= 1
    merged = merged.join(people.drop("gender"), "subject_id").filter(F.when(infant, c("height") < 80).otherwise((c("height") > 120) & (c("height") < 230)))
    notes = ctx["older_notes"]
    at = F.to_timestamp(F.concat_ws(" ", F.date_format("chartdate", "yyyy-MM-dd"), extract(text, r"Date/Time: [\[\]0-9*-]+ at ([0-9]{2}:[0-9]{2})")), "yyyy-MM-dd HH:mm").cast("timestamp_ntz")
    echo = notes.filter("category = 'Echo'").select("subject_id", at.alias("charttime"), F.lit("noteevents - echo").alias("source"), cm(extract(text, r"Height: \(in\) (.*?)\n").try_cast("double") * 2.54))
    ideal = extract(text, r"Ideal body weight: ([0-9]+\.?[0-9]*)").try_cast("double")
    weighed = notes.filter((c("category") != "Echo") & text.contains("Ideal body weight:")).select("subject_id", "charttime", ideal.alias("_kg")).filter("_kg <> 0").join(people.drop("dob"), "subject_id")
    weighed = weighed.select("subject_id", "charttime", F.lit("noteevents - ibw").alias("source"), cm((c("_kg") - F.when(c("gender") == "F", 45.5).otherwise(50.0)) / 0.91 + 152.4))
    stated = extract(text, "([0-9]+) cm").try_cast("double")
    fed = notes.filter((c("category") == "Nutrition") & F.lower(text).contains("height")).select("subject_id", "charttime", F.lit("noteevents - nutrition").alias("source"), cm(F.when(stated < 80, stated * 2.54).otherwise(stated)))
    out = merged.select("subject_id", "charttime", F.lit("chartevents").alias("source"), "height")
    for part in (echo, weighed, fed):
        out = out.unionByName(part)
    return out.filter("height > 0")


# Codes of continuous dialysis and the texts that start, hold and end it.
RUNNING = [224149, 224144, 228004, 225183, 225977, 224154, 224151, 224150, 225958, 224145, 224191, 228005, 228006, 225976, 224153, 224152, 226457, 29, 173, 192, 624, 79, 142, 146, 611, 5683]
SYSTEM, OLD_SYSTEM, INFUSING, CHANGED = 224146, 665, 147, 225956
RUNNING_TEXTS, STARTING, ENDING = ["Active", "Clot Increasing", "Clots Present", "No Clot Present"], ["New Filter", "Reinitiated"], ["Discontinued", "Recirculating"]


def _texts(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


@concept("crrt_durations", ["older_dialysis_events"], f"""
WITH a AS (SELECT icustay_id, charttime, bool_or(itemid IN ({_in(RUNNING)}) OR (itemid = {OLD_SYSTEM} AND value IN ({_texts(RUNNING_TEXTS)})) OR (itemid = {INFUSING} AND value = 'Yes')) AS runs,
  bool_or((itemid = {SYSTEM} AND value IN ({_texts(STARTING)})) OR (itemid = {OLD_SYSTEM} AND value = 'Initiated')) AS starts, bool_or((itemid = {SYSTEM} AND value IN ({_texts(ENDING)})) OR (itemid = {OLD_SYSTEM} AND (value = 'Clotted' OR starts_with(value, 'DC'))) OR itemid = {CHANGED}) AS ends
  FROM older_dialysis_events WHERE value IS NOT NULL AND (valuenum IS NULL OR valuenum <> 0) AND itemid IN ({_in([SYSTEM, OLD_SYSTEM, INFUSING, CHANGED, 612, *RUNNING])}) GROUP BY 1, 2),
b AS (SELECT *, lag(charttime) OVER w AS before, coalesce(lag(ends) OVER w, false) AS ended FROM a WINDOW w AS (PARTITION BY icustay_id, runs OR ends ORDER BY charttime)),
c AS (SELECT *, sum(CAST(starts OR (NOT ends AND (ended OR before IS NULL OR date_diff('hour', before, charttime) > 2)) AS INT)) OVER (PARTITION BY icustay_id ORDER BY charttime) AS n FROM b WHERE starts OR runs OR ends),
d AS (SELECT icustay_id, min(charttime) AS starttime, max(charttime) AS endtime FROM c GROUP BY icustay_id, n HAVING min(charttime) <> max(charttime))
SELECT icustay_id, row_number() OVER (PARTITION BY icustay_id ORDER BY starttime) AS num, starttime, endtime, date_diff('hour', starttime, endtime) AS duration_hours FROM d""")
def crrt_durations(ctx):
    """Runs of continuous dialysis: a start, the row after an end and a gap of more than two hours each begin one."""
    code, value = F.col("itemid"), F.col("value")
    rows = ctx["older_dialysis_events"].filter(code.isin([SYSTEM, OLD_SYSTEM, INFUSING, CHANGED, 612, *RUNNING]) & value.isNotNull() & (F.coalesce("valuenum", F.lit(1.0)) != 0))
    marks = {
        "runs": code.isin(RUNNING) | ((code == OLD_SYSTEM) & value.isin(RUNNING_TEXTS)) | ((code == INFUSING) & (value == "Yes")), "starts": ((code == SYSTEM) & value.isin(STARTING)) | ((code == OLD_SYSTEM) & (value == "Initiated")),
        "ends": ((code == SYSTEM) & value.isin(ENDING)) | ((code == OLD_SYSTEM) & ((value == "Clotted") | value.startswith("DC"))) | (code == CHANGED),
    }
    at = rows.groupBy("icustay_id", "charttime").agg(*[F.max(m).alias(n) for n, m in marks.items()])
    alike = Window.partitionBy("icustay_id", F.col("runs") | F.col("ends")).orderBy("charttime")
    far = F.coalesce(dt_diff(F.col("charttime"), F.lag("charttime").over(alike), "HOUR") > 2, F.lit(True))
    begins = F.col("starts") | (~F.col("ends") & (F.coalesce(F.lag("ends").over(alike), F.lit(False)) | far))
    own = Window.partitionBy("icustay_id")
    runs = at.withColumn("_begins", begins.cast("int")).filter("starts OR runs OR ends").withColumn("_run", F.sum("_begins").over(own.orderBy("charttime")))
    spans = runs.groupBy("icustay_id", "_run").agg(F.min("charttime").alias("starttime"), F.max("charttime").alias("endtime")).filter("starttime <> endtime")
    return spans.select("icustay_id", F.row_number().over(own.orderBy("starttime")).cast("long").alias("num"), "starttime", "endtime", dt_diff(F.col("endtime"), F.col("starttime"), "HOUR").alias("duration_hours"))


# What shows dialysis, what shows that it runs, and its kinds, by code of charts, fluids, outputs and orders.
PRESENT = [
    146, 147, 148, 149, 150, 151, 152, 226118, 227357, 225725, 226499, 224154, 225810, 225959, 227639, 225183, 227438, 224191, 225806, 225807, 228004, 228005, 228006, 224144, 224145, 224149, 224150, 224151, 224152, 224153, 224404, 224406, 226457,
    224135, 224139, 224146, 225323, 225740, 225776, 225951, 225952, 225953, 225954, 225956, 225958, 225961, 225963, 225965, 225976, 225977, 227124, 227290, 227638, 227640, 227753,
]
ACTIVE = [146, 226499, 224154, 225183, 227438, 224191, 225806, 225807, 228004, 228005, 228006, 224144, 224145, 224153, 226457]
PERITONEAL = [225810, 225806, 225807, 227639, 225959, 225951, 225952, 225961, 225953, 225963, 225965, 227638, 227640]
PROCEDURE_STARTS, PROCEDURE_ENDS = ["CAVH Start", "CVVHD Start", "Hemodialysis st", "Peritoneal Dial"], ["CAVH D/C", "CVVHD D/C", "Hemodialysis end"]
MODES = ["CVVH", "CVVHD", "CVVHDF", "SCUF", "Peritoneal"]
FLUIDS_IN = [
    40788, 40907, 41063, 41147, 41307, 41460, 41620, 41711, 41791, 41792, 42562, 43829, 44037, 44188, 44526, 44527, 44584, 44591, 44698, 44927, 44954, 45157, 45268, 45352, 45353, 46012, 46013, 46172, 46173, 46250, 46262, 46292, 46293, 46311, 46389, 46574,
    46681, 46720, 46769, 46773,
]
FLUIDS_OUT = [
    40386, 40425, 40426, 40507, 40613, 40624, 40690, 40745, 40789, 40881, 40910, 41016, 41034, 41069, 41112, 41250, 41374, 41417, 41500, 41527, 41623, 41635, 41713, 41750, 41829, 41842, 41897, 42289, 42388, 42464, 42524, 42536, 42868, 42928, 42972, 43016,
    43052, 43098, 43115, 43687, 43941, 44027, 44085, 44193, 44199, 44216, 44286, 44567, 44843, 44845, 44857, 44901, 44943, 45479, 45828, 46230, 46232, 46394, 46464, 46712, 46713, 46715, 46741,
]
FLUID_KINDS = {"Peritoneal": [40788, 41063, 41307, 43829, 44698, 46720, 40789, 40910, 41069, 44843, 46394], "CVVH": [45352, 45353], "CVVHD": [45268, 46769, 46773], "CVVHDF": [46012, 46013, 46172, 46173]}
ONLY_PRESENT, ORDERS = [44954, 41897], [227536, 227525]
PLACED_KINDS = {225441: "IHD", 225802: "CRRT", 225803: "CVVHD", 225805: "Peritoneal", 225809: "CVVHDF", 225955: "SCUF", 224270: None, 225436: None}
_KINDS_SQL = ", ".join(f"({c}, '{k}')" for k, codes in FLUID_KINDS.items() for c in codes)
_PLACED_SQL = ", ".join(f"({c}, {repr(k) if k else 'CAST(NULL AS VARCHAR)'})" for c, k in PLACED_KINDS.items())


def _charted() -> tuple[dict, dict]:
    """What a charted code means, as whether dialysis runs and its kind: by code alone, and by code and text where the text decides."""
    kind = lambda c: "Peritoneal" if c in PERITONEAL else "IHD" if c == 226499 else None
    always = {c: (int(c in ACTIVE), kind(c)) for c in PRESENT}
    special = {(c, "Dialysis Line"): always.get(c, (0, None)) for c in LINE_TYPES}
    special |= {(582, t): (int(t in PROCEDURE_STARTS), next((k for k in ("CAVH", "CVVHD") if t.startswith(k)), None)) for t in PROCEDURE_STARTS + PROCEDURE_ENDS}
    special |= {(c, t): (1, kind(c)) for c, t in ((147, "Yes"), (225965, "In use")) if c in always}
    special |= {(c, t): (always[c][0], t) for c in (152, 227290) if c in always for t in MODES}
    return always, special


def _sql(meaning: tuple) -> str:
    active, kind = meaning
    return f"named_struct('active', {active}, 'kind', {repr(kind) if kind else 'CAST(NULL AS STRING)'})"


@concept("pivoted_rrt", ["older_dialysis_events", "older_dialysis_fluids", "inputevents_mv", "older_line_procedures"], f"""
WITH e AS (SELECT icustay_id, charttime, itemid, value, itemid = 582 AND value IN ({_texts(PROCEDURE_STARTS)}) AS begun, itemid = 582 AND value IN ({_texts(PROCEDURE_ENDS)}) AS over FROM older_dialysis_events WHERE value IS NOT NULL AND icustay_id IS NOT NULL AND coalesce(error, 0) = 0),
c AS (SELECT icustay_id, charttime, CAST(begun OR itemid IN ({_in(ACTIVE)}) OR (itemid = 147 AND value = 'Yes') OR (itemid = 225965 AND value = 'In use') AS INT) AS active,
  CASE WHEN itemid IN (152, 227290) AND list_contains([{_texts(MODES)}], value) THEN value WHEN itemid IN ({_in(PERITONEAL)}) THEN 'Peritoneal' WHEN itemid = 226499 THEN 'IHD' WHEN itemid = 582 AND starts_with(value, 'CAVH') THEN 'CAVH' WHEN itemid = 582 AND starts_with(value, 'CVVHD') THEN 'CVVHD' END AS kind
  FROM e WHERE begun OR over OR itemid IN ({_in(PRESENT)}) OR (itemid IN ({_in(LINE_TYPES)}) AND value = 'Dialysis Line')),
f AS (SELECT icustay_id, charttime, CAST(itemid NOT IN ({_in(ONLY_PRESENT)}) AS INT) AS active, k.kind FROM older_dialysis_fluids t LEFT JOIN (VALUES {_KINDS_SQL}) AS k(code, kind) ON k.code = t.itemid WHERE amount > 0 AND itemid IN ({_in(FLUIDS_IN + FLUIDS_OUT)})),
r AS (SELECT icustay_id, starttime, endtime, 1 AS active, 'CRRT' AS kind FROM inputevents_mv WHERE itemid IN ({_in(ORDERS)}) AND amount > 0
  UNION SELECT icustay_id, starttime, endtime, CAST(itemid NOT IN (224270, 225436) AS INT), k.kind FROM older_line_procedures p JOIN (VALUES {_PLACED_SQL}) AS k(code, kind) ON k.code = p.itemid),
s AS (SELECT * FROM c UNION SELECT * FROM f UNION SELECT icustay_id, starttime, active, kind FROM r UNION SELECT icustay_id, endtime, active, kind FROM r)
SELECT s.icustay_id, s.charttime, 1 AS dialysis_present, coalesce(r.active, s.active) AS dialysis_active, coalesce(r.kind, s.kind) AS dialysis_type FROM s LEFT JOIN r ON r.icustay_id = s.icustay_id AND s.charttime >= r.starttime AND s.charttime <= r.endtime""")
def pivoted_rrt(ctx):
    """When dialysis was seen, whether it ran and which kind: charts, fluids and outputs, and the orders that cover them."""
    code, value = F.col("itemid"), F.col("value")
    always, special = _charted()
    named = lambda rows, cols: ctx.spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({cols})")
    chart = ctx["older_dialysis_events"].filter(value.isNotNull() & F.col("icustay_id").isNotNull() & (F.coalesce("error", F.lit(0)) == 0)).filter(code.isin(sorted({*always, *(c for c, _ in special)})))
    chart = chart.join(F.broadcast(named([f"({c}, {_sql(v)})" for c, v in always.items()], "itemid, by_code")), "itemid", "left")
    chart = chart.join(F.broadcast(named([f"({c}, '{t}', {_sql(v)})" for (c, t), v in special.items()], "itemid, value, by_text")), ["itemid", "value"], "left")
    chart = chart.withColumn("_means", F.coalesce("by_text", "by_code")).filter("_means IS NOT NULL").select("icustay_id", "charttime", F.col("_means.active").alias("active"), F.col("_means.kind").alias("kind"))
    kinds = F.create_map(*[F.lit(x) for k, codes in FLUID_KINDS.items() for c in codes for x in (c, k)])
    fluids = ctx["older_dialysis_fluids"].filter((F.col("amount") > 0) & code.isin(FLUIDS_IN + FLUIDS_OUT)).select("icustay_id", "charttime", (~code.isin(ONLY_PRESENT)).cast("int").alias("active"), F.try_element_at(kinds, code).alias("kind"))
    ordered = ctx["inputevents_mv"].filter(code.isin(ORDERS) & (F.col("amount") > 0)).select("icustay_id", "starttime", "endtime", F.lit(1).alias("active"), F.lit("CRRT").alias("kind"))
    placed_kinds = F.create_map(*[F.lit(x) for c, k in PLACED_KINDS.items() if k for x in (c, k)])
    placed = ctx["older_line_procedures"].filter(code.isin(list(PLACED_KINDS))).select("icustay_id", "starttime", "endtime", (~code.isin(224270, 225436)).cast("int").alias("active"), F.try_element_at(placed_kinds, code).alias("kind"))
    spans = ordered.unionByName(placed).distinct()
    at = chart.unionByName(fluids)
    for edge in ("starttime", "endtime"):
        at = at.unionByName(spans.select("icustay_id", F.col(edge).alias("charttime"), "active", "kind"))
    covering = spans.withColumnsRenamed({"starttime": "_s", "endtime": "_e", "active": "_active", "kind": "_kind"})
    out = interval_join(at.distinct(), covering, ["icustay_id"], "charttime", "_s", "_e", how="left")
    return out.select("icustay_id", "charttime", F.lit(1).alias("dialysis_present"), F.coalesce("_active", "active").alias("dialysis_active"), F.coalesce("_kind", "kind").alias("dialysis_type"))
