"""Lines, dialysis, ventilation and code status."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vitalgrid.functions.dt import dt_diff
from vitalgrid.operators.joins import interval_join
from vitalgrid.operators.pivot import Item, Part, item, pivot, pivot_sql
from vitalgrid.plans.registry import concept

# Codes of renal replacement settings.
CRRT = [
    item("crrt_mode", 227290, field="value"), item("access_pressure", 224149), item("blood_flow", 224144), item("citrate", 228004), item("current_goal", 225183),
    item("dialysate_fluid", 225977, field="value"), item("dialysate_rate", 224154), item("effluent_pressure", 224151), item("filter_pressure", 224150),
    item("heparin_concentration", 225958, field="value"), item("heparin_dose", 224145), item("hourly_patient_fluid_removal", 224191), item("prefilter_replacement_rate", 228005),
    item("postfilter_replacement_rate", 228006), item("replacement_fluid", 225976, field="value"), item("replacement_rate", 224153), item("return_pressure", 224152),
    item("ultrafiltrate_output", 226457),
    Item("system_active", tuple(Part((224146,), text=t, const=c) for t, c in (("Active", 1.0), ("Initiated", 1.0), ("Reinitiated", 1.0), ("New Filter", 1.0), ("Recirculating", 0.0), ("Discontinued", 0.0)))),
    Item("clots", (Part((224146,), text="Clots Present", const=1.0), Part((224146,), text="No Clot Present", const=0.0))),
    Item("clots_increasing", (Part((224146,), text="Clots Increasing", const=1.0), Part((224146,), text="Clot Increasing", const=1.0))),
    Item("clotted", (Part((224146,), text="Clotted", const=1.0),)),
]


@concept("crrt", ["chartevents"], pivot_sql("chartevents", ["stay_id", "charttime"], [], CRRT, "value IS NOT NULL"))
def crrt(ctx):
    return pivot(ctx["chartevents"], ["stay_id", "charttime"], [], CRRT, F.col("value").isNotNull())


# Codes that show dialysis, those that show it running, and their kinds.
PRESENT = [
    226118, 227357, 225725, 226499, 224154, 225810, 225959, 227639, 225183, 227438, 224191, 225806, 225807, 228004, 228005, 228006, 224144, 224145, 224149, 224150, 224151, 224152, 224153,
    224404, 224406, 226457, 224135, 224139, 224146, 225323, 225740, 225776, 225951, 225952, 225953, 225954, 225956, 225958, 225961, 225963, 225965, 225976, 225977, 227124, 227290, 227638, 227640, 227753,
]
RUNNING = [226499, 224154, 225183, 227438, 224191, 225806, 225807, 228004, 228005, 228006, 224144, 224145, 224153, 226457]
PERITONEAL = [225810, 225806, 225807, 227639, 225959, 225951, 225952, 225961, 225953, 225963, 225965, 227638, 227640]
PROCEDURES = {225441: "IHD", 225802: "CRRT", 225803: "CVVHD", 225805: "Peritoneal", 225809: "CVVHDF", 225955: "SCUF", 224270: None, 225436: None}
IDLE = [224270, 225436]
_in = lambda codes: ", ".join(map(str, codes))


@concept("rrt", ["chartevents", "inputevents", "procedureevents"], f"""
WITH c AS (SELECT DISTINCT stay_id, charttime, 1 AS p, CASE WHEN itemid IN ({_in(RUNNING)}) OR (itemid = 225965 AND value = 'In use') THEN 1 ELSE 0 END AS a,
        CASE WHEN itemid = 227290 THEN value WHEN itemid IN ({_in(PERITONEAL)}) THEN 'Peritoneal' WHEN itemid = 226499 THEN 'IHD' END AS k
      FROM chartevents WHERE itemid IN ({_in(PRESENT)}) AND value IS NOT NULL),
m AS (SELECT stay_id, starttime, endtime, 1 AS a, 'CRRT' AS k FROM inputevents WHERE itemid IN (227536, 227525) AND amount > 0
      UNION SELECT stay_id, starttime, endtime, CASE WHEN itemid IN ({_in(IDLE)}) THEN 0 ELSE 1 END,
        CASE itemid {' '.join(f"WHEN {c} THEN '{k}'" for c, k in PROCEDURES.items() if k)} END FROM procedureevents WHERE itemid IN ({_in(PROCEDURES)}) AND value IS NOT NULL),
s AS (SELECT * FROM c UNION SELECT stay_id, starttime, 1, a, k FROM m)
SELECT s.stay_id, s.charttime, 1 AS dialysis_present, coalesce(m.a, s.a) AS dialysis_active, coalesce(m.k, s.k) AS dialysis_type
FROM s LEFT JOIN m ON m.stay_id = s.stay_id AND s.charttime BETWEEN m.starttime AND m.endtime""")
def rrt(ctx):
    """Signs of dialysis from charts and procedures; a procedure that covers the time overrides the chart."""
    code = F.col("itemid")
    charted = ctx["chartevents"].filter(code.isin(PRESENT) & F.col("value").isNotNull()).select(
        "stay_id", "charttime", F.when(code.isin(RUNNING) | ((code == 225965) & (F.col("value") == "In use")), 1).otherwise(0).alias("active"),
        F.when(code == 227290, F.col("value")).when(code.isin(PERITONEAL), "Peritoneal").when(code == 226499, "IHD").alias("kind"),
    )
    fluids = ctx["inputevents"].filter("itemid IN (227536, 227525) AND amount > 0").select("stay_id", "starttime", "endtime", F.lit(1).alias("m_active"), F.lit("CRRT").alias("m_kind"))
    kinds = F.create_map(*[F.lit(x) for c, k in PROCEDURES.items() if k for x in (c, k)])
    done = ctx["procedureevents"].filter(code.isin(list(PROCEDURES)) & F.col("value").isNotNull()).select(
        "stay_id", "starttime", "endtime", F.when(code.isin(IDLE), 0).otherwise(1).alias("m_active"), F.try_element_at(kinds, code).alias("m_kind")
    )
    ranges = fluids.unionByName(done).distinct()
    at = charted.unionByName(ranges.select("stay_id", F.col("starttime").alias("charttime"), F.col("m_active").alias("active"), F.col("m_kind").alias("kind"))).distinct()
    out = interval_join(at, ranges, ["stay_id"], "charttime", "starttime", "endtime", closed="both", how="left")
    return out.select(
        "stay_id", "charttime", F.lit(1).alias("dialysis_present"), F.coalesce("m_active", "active").alias("dialysis_active"), F.coalesce("m_kind", "kind").alias("dialysis_type")
    )


# Devices and modes of each kind of support.
TRACH = ["Tracheostomy tube", "Trach mask "]
MODES = [
    "(S) CMV", "APRV", "APRV/Biphasic+ApnPress", "APRV/Biphasic+ApnVol", "APV (cmv)", "Ambient", "Apnea Ventilation", "CMV", "CMV/ASSIST", "CMV/ASSIST/AutoFlow", "CMV/AutoFlow", "CPAP/PPS",
    "CPAP/PSV", "CPAP/PSV+Apn TCPL", "CPAP/PSV+ApnPres", "CPAP/PSV+ApnVol", "MMV", "MMV/AutoFlow", "MMV/PSV", "MMV/PSV/AutoFlow", "P-CMV", "PCV+", "PCV+/PSV", "PCV+Assist", "PRES/AC", "PRVC/AC",
    "PRVC/SIMV", "PSV/SBT", "SIMV", "SIMV/AutoFlow", "SIMV/PRES", "SIMV/PSV", "SIMV/PSV/AutoFlow", "SIMV/VOL", "SYNCHRON MASTER", "SYNCHRON SLAVE", "VOL/AC",
]
HAMILTON = ["APRV", "APV (cmv)", "Ambient", "(S) CMV", "P-CMV", "SIMV", "APV (simv)", "P-SIMV", "VS", "ASV"]
MASKS = ["Bipap mask ", "CPAP mask "]
HAMILTON_MASK = ["DuoPaP", "NIV", "NIV-ST"]
OXYGEN = ["Non-rebreather", "Face tent", "Aerosol-cool", "Venti mask ", "Medium conc mask ", "Ultrasonic neb", "Vapomist", "Oxymizer", "High flow neb", "Nasal cannula"]
_q = lambda values: ", ".join(f"'{v}'" for v in values)
DEVICES = [f"o2_delivery_device_{i}" for i in (1, 2, 3, 4)]


@concept("ventilation", ["ventilator_setting", "oxygen_delivery"], f"""
WITH t AS (SELECT stay_id, charttime FROM ventilator_setting UNION SELECT stay_id, charttime FROM oxygen_delivery),
x AS (SELECT t.stay_id, t.charttime, CASE WHEN o2_delivery_device_1 IN ({_q(TRACH)}) THEN 'Tracheostomy'
        WHEN o2_delivery_device_1 = 'Endotracheal tube' OR ventilator_mode IN ({_q(MODES)}) OR ventilator_mode_hamilton IN ({_q(HAMILTON)}) THEN 'InvasiveVent'
        WHEN {' OR '.join(f'{d} IN ({_q(MASKS)})' for d in DEVICES)} OR ventilator_mode_hamilton IN ({_q(HAMILTON_MASK)}) THEN 'NonInvasiveVent'
        WHEN o2_delivery_device_1 = 'High flow nasal cannula' THEN 'HFNC' WHEN o2_delivery_device_1 IN ({_q(OXYGEN)}) THEN 'SupplementalOxygen'
        WHEN o2_delivery_device_1 = 'None' THEN 'None' END AS s
      FROM t LEFT JOIN ventilator_setting v ON v.stay_id = t.stay_id AND v.charttime = t.charttime LEFT JOIN oxygen_delivery o ON o.stay_id = t.stay_id AND o.charttime = t.charttime),
y AS (SELECT *, lag(charttime) OVER (PARTITION BY stay_id, s ORDER BY charttime) AS same_before, lead(charttime) OVER w AS nxt, lag(s) OVER w AS prev FROM x WHERE s IS NOT NULL
      WINDOW w AS (PARTITION BY stay_id ORDER BY charttime)),
z AS (SELECT *, sum(CASE WHEN prev IS NULL OR prev <> s OR date_diff('hour', same_before, charttime) >= 14 THEN 1 ELSE 0 END) OVER (PARTITION BY stay_id ORDER BY charttime) AS n FROM y)
SELECT stay_id, min(charttime) AS starttime, max(CASE WHEN nxt IS NULL OR date_diff('hour', charttime, nxt) >= 14 THEN charttime ELSE nxt END) AS endtime, max(s) AS ventilation_status
FROM z GROUP BY stay_id, n HAVING min(charttime) <> max(charttime)""")
def ventilation(ctx):
    """Kind of support at each observation, joined to episodes: broken by a change or 14 hours without that kind."""
    settings, devices = ctx["ventilator_setting"], ctx["oxygen_delivery"]
    both = settings.select("stay_id", "charttime", "ventilator_mode", "ventilator_mode_hamilton").join(
        devices.select("stay_id", "charttime", *DEVICES), ["stay_id", "charttime"], "full"
    )
    first, hamilton = F.col(DEVICES[0]), F.col("ventilator_mode_hamilton")
    mask = hamilton.isin(HAMILTON_MASK)
    for d in DEVICES:
        mask = mask | F.col(d).isin(MASKS)
    kind = (
        F.when(first.isin(TRACH), "Tracheostomy")
        .when((first == "Endotracheal tube") | F.col("ventilator_mode").isin(MODES) | hamilton.isin(HAMILTON), "InvasiveVent")
        .when(mask, "NonInvasiveVent").when(first == "High flow nasal cannula", "HFNC").when(first.isin(OXYGEN), "SupplementalOxygen").when(first == "None", "None")
    )
    seen = both.select("stay_id", "charttime", kind.alias("status")).filter("status IS NOT NULL")
    w = Window.partitionBy("stay_id").orderBy("charttime")
    own = F.lag("charttime").over(Window.partitionBy("stay_id", "status").orderBy("charttime"))
    stepped = seen.withColumns({"own": own}).withColumns({"next": F.lead("charttime").over(w), "before": F.lag("status").over(w)})
    new = F.col("before").isNull() | (F.col("before") != F.col("status")) | F.coalesce(dt_diff(F.col("charttime"), F.col("own"), "HOUR") >= 14, F.lit(False))
    gap = F.col("next").isNull() | (dt_diff(F.col("next"), F.col("charttime"), "HOUR") >= 14)
    numbered = stepped.withColumn("new", new.cast("int")).withColumn("episode", F.sum("new").over(w))
    return (
        numbered.groupBy("stay_id", "episode")
        .agg(F.min("charttime").alias("starttime"), F.max(F.when(gap, F.col("charttime")).otherwise(F.col("next"))).alias("endtime"), F.max("status").alias("ventilation_status"), F.max("charttime").alias("last"))
        .filter("starttime <> last").select("stay_id", "starttime", "endtime", "ventilation_status")
    )


# Line codes and the names that are one line or one site.
LINES = [227719, 225752, 224269, 224267, 224270, 224272, 226124, 228169, 225202, 228286, 225204, 224263, 224560, 224264, 225203, 224273, 225789, 225761, 228201, 228202, 224268, 225199, 225315, 225205]
LINE_NAMES = {
    "Arterial Line": "Arterial", "A-Line": "Arterial", "CCO PA Line": "Continuous Cardiac Output PA", "CCO PAC": "Continuous Cardiac Output PA", "Dialysis Catheter": "Dialysis", "Dialysis Line": "Dialysis",
    "Tunneled (Hickman) Line": "Hickman", "IABP line": "IABP", "Multi-lumen": "Multi Lumen", "PA Catheter": "PA", "PA line": "PA", "PICC Line": "PICC", "PICC line": "PICC",
    "Pre-Sep Catheter": "Pre-Sep", "Presep Catheter": "Pre-Sep", "Trauma Line": "Trauma", "Trauma line": "Trauma", "TripleIntroducer": "Triple Introducer", "Indwelling Port (PortaCath)": "Portacath",
}
SITE_NAMES = {
    "Left Antecub": "Left Antecube", "Left Axilla.": "Left Axilla", "Left Brachial.": "Left Brachial", "Left Femoral.": "Left Femoral",
    "Right Antecub": "Right Antecube", "Right Axilla.": "Right Axilla", "Right Brachial.": "Right Brachial", "Right Femoral.": "Right Femoral",
}
_case = lambda col, names: f"CASE {col} {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in names.items())} ELSE {col} END"


@concept("invasive_line", ["procedureevents", "d_items"], f"""
SELECT stay_id, {_case('d.label', LINE_NAMES)} AS line_type, {_case('p.location', SITE_NAMES)} AS line_site, starttime, endtime
FROM procedureevents p JOIN d_items d USING (itemid) WHERE itemid IN ({_in(LINES)})""")
def invasive_line(ctx):
    rename = lambda c, names: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col(c)), F.col(c))
    lines = ctx["procedureevents"].filter(F.col("itemid").isin(LINES)).join(ctx["d_items"].select("itemid", "label"), "itemid")
    return lines.select("stay_id", rename("label", LINE_NAMES).alias("line_type"), rename("location", SITE_NAMES).alias("line_site"), "starttime", "endtime")


# Texts of code status in charts and in orders.
CHARTED = {"fullcode": ["Full code"], "cmo": ["Comfort measures only"], "dni": ["DNI (do not intubate)", "DNR / DNI"], "dnr": ["DNR (do not resuscitate)", "DNR / DNI"]}
ORDERED = {
    "fullcode": ["Resuscitate (Full code)", "Full code  (attempt resuscitation)"], "cmo": [], "dni": ["Do not resuscitate (DNR/DNI)"],
    "dnr": ["DNAR (DO NOT attempt resuscitation for cardiac arrest) ", "Do not resuscitate (DNR/DNI)"],
}
_flags = lambda col, kinds: ", ".join(f"CAST({col} IN ({_q(v)}) AS INT) AS {k}" if v else f"0 AS {k}" for k, v in kinds.items())


@concept("code_status", ["chartevents", "poe", "poe_detail", "icustays"], f"""
SELECT subject_id, hadm_id, stay_id, charttime, {_flags("coalesce(value, '')", CHARTED)} FROM chartevents WHERE itemid = 223758
UNION ALL SELECT p.subject_id, p.hadm_id, i.stay_id, p.ordertime, {_flags("coalesce(d.field_value, '')", ORDERED)}
FROM poe p JOIN poe_detail d USING (poe_id) LEFT JOIN icustays i ON i.hadm_id = p.hadm_id AND p.ordertime BETWEEN i.intime AND i.outtime
WHERE p.order_type = 'General Care' AND p.order_subtype = 'Code status'""")
def code_status(ctx):
    flags = lambda c, kinds: [F.coalesce(F.col(c).isin(v), F.lit(False)).cast("int").alias(k) for k, v in kinds.items()]
    charted = ctx["chartevents"].filter("itemid = 223758").select("subject_id", "hadm_id", "stay_id", "charttime", *flags("value", CHARTED))
    orders = ctx["poe"].filter("order_type = 'General Care' AND order_subtype = 'Code status'").join(ctx["poe_detail"].select("poe_id", "field_value"), "poe_id")
    stays = ctx["icustays"].select("hadm_id", "stay_id", "intime", "outtime")
    placed = interval_join(orders, stays, ["hadm_id"], "ordertime", "intime", "outtime", how="left")
    return charted.unionByName(placed.select("subject_id", "hadm_id", "stay_id", F.col("ordertime").alias("charttime"), *flags("field_value", ORDERED)))
