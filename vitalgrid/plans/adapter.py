"""The driver's star-schema tables in the shape of clinical source tables.

Every mapping is a plain projection in SQL that Spark and DuckDB both read, so a plan and its oracle
start from the same rows.  Values are multiples of a quarter, so sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitalgrid.plans.registry import CONCEPTS, Context, order

# code, lowest value, step of the values, texts of coded readings
CHART_CODES = [
    (220045, 30, 4), (220045, 40, 3), (220045, 50, 2), (220179, 60, 5), (220050, 50, 5), (225309, 80, 4), (220180, 20, 4), (220051, 30, 3), (225310, 30, 2),
    (220052, 40, 3), (220181, 30, 3), (225312, 45, 2), (220210, 4, 1), (224690, 6, 1), (220277, 70, 1), (225664, 60, 10), (220621, 50, 12), (226537, 40, 9),
    (223762, 30, 0.5), (223761, 88, 0.75), (223900, 1, 0.25), (223901, 1, 0.25), (220739, 1, 0.25), (223900, 2, 0.25), (223835, 18, 2.25), (223835, 0.25, 0.25),
    (224688, 8, 1), (224689, 5, 1), (224687, 4, 0.5), (224685, 300, 10), (224684, 300, 8), (224686, 200, 10), (224696, 10, 1), (220339, 0, 0.5), (224700, -5, 4),
    (220765, -10, 4), (227989, 0, 3), (226707, 55, 0.75), (226730, 115, 4), (226512, 40, 3.5), (224639, 45, 2.5), (223834, 1, 0.5), (227582, 2, 0.5), (227287, 1, 1),
    (224149, 20, 3), (224144, 100, 5), (228004, 50, 5), (225183, 10, 4), (224154, 200, 50), (224151, 10, 3), (224150, 50, 3), (224145, 100, 20), (224191, 10, 6),
    (228005, 100, 30), (228006, 100, 20), (224153, 200, 30), (224152, 20, 4), (226457, 30, 12), (224404, 1, 1), (226499, 50, 25), (225810, 100, 20), (225806, 10, 5),
]
TEXT_CODES = [
    (224642, ("Oral", "Axillary", "Rectal", "Temporal")), (223849, ("CMV", "PSV/SBT", "SIMV", "Standby")), (229314, ("ASV", "NIV", "APRV", "VS")),
    (223848, ("Drager", "Hamilton", "Avea", "Other")), (226732, ("Nasal cannula", "None", "Endotracheal tube", "High flow nasal cannula")),
    (226732, ("Tracheostomy tube", "CPAP mask ", "Bipap mask ", "Face tent")), (220048, ("SR (Sinus Rhythm)", "AF (Atrial Fibrillation)", "ST (Sinus Tachycardia)", "SB (Sinus Bradycardia)")),
    (224650, ("None", "PVCs", "PACs", "PJCs")), (224651, ("Rare", "Occasional", "Frequent", "Runs Vtach")), (226479, ("PVCs", "PACs", "None", "PJCs")), (226480, ("Rare", "Frequent", "Occasional", "Rare")),
    (227290, ("CVVH", "CVVHD", "CVVHDF", "SCUF")), (224146, ("Active", "Clots Present", "Clotted", "Clots Increasing")), (225977, ("Normocarb", "Prismasate K0", "Prismasate K2", "Other")),
    (225958, ("Heparin 20 units/mL", "None", "1000 units/mL", "Other")), (225976, ("Prismasate K4", "Normal saline", "None", "Other")), (225965, ("In use", "Capped", "Not in use", "Draining")),
    (223758, ("Full code", "DNR (do not resuscitate)", "DNI (do not intubate)", "Comfort measures only")), (223758, ("DNR / DNI", "Full code", "DNAR (Do Not Attempt Resuscitation)  [DNR]", "Full code")),
    (223900, ("No Response-ETT", "Oriented", "Confused", "No Response-ETT")), (225740, ("Yes", "No", "Yes", "No")), (226118, ("Placed", "Removed", "Placed", "In situ")),
]
LAB_CODES = [
    (50862, 1, 0.25), (50930, 1, 0.5), (50976, 3, 0.5), (50868, -4, 1), (50882, 8, 1), (51006, 3, 8), (50893, 5, 0.25), (50902, 80, 2), (50912, 0.25, 0.25), (50912, 0.5, 0.5),
    (50931, 40, 12), (50983, 110, 2.5), (50971, 2, 0.25), (51221, 15, 1), (51222, 5, 0.5), (51248, 20, 0.5), (51249, 28, 0.25), (51250, 70, 1), (51265, 5, 12), (51279, 2, 0.25),
    (51277, 11, 0.5), (52159, 30, 1), (51301, 0.5, 1), (51300, 1, 1.5), (51755, 2, 1), (51196, 100, 60), (51214, 80, 15), (51297, 10, 1), (51237, 0.75, 0.25), (51274, 9, 1), (51275, 20, 3),
    (50861, 5, 20), (50863, 30, 10), (50878, 8, 20), (50867, 10, 9), (50885, 0.25, 0.5), (50883, 0, 0.25), (50884, 0.25, 0.25), (50910, 20, 60), (50911, 1, 3), (50927, 5, 12), (50954, 80, 30),
    (51003, 0, 0.25), (50963, 50, 250), (50889, 0, 6), (52069, 0, 0.25), (52073, 0, 0.25), (51199, 0, 250), (51133, 0.25, 0.25), (52769, 500, 250), (52074, 0, 0.25), (51253, 0, 250),
    (52075, 1, 0.5), (51218, 500, 250), (51146, 0, 0.25), (51200, 0, 0.5), (51244, 5, 1.5), (51245, 4, 1), (51254, 1, 0.5), (51256, 30, 1.5), (51143, 0, 1), (51144, 0, 1), (52135, 0, 0.5), (51251, 0, 0.5),
    (51257, 0, 1), (50801, 50, 12), (50802, -15, 1), (50803, 8, 1), (50804, 10, 1), (50805, 0, 1), (50806, 85, 1.5), (50808, 0.75, 0.25), (50809, 50, 20), (50810, 15, 2.5), (50811, 5, 0.5), (50813, 0.25, 0.5),
    (50814, 0, 0.25), (50815, 1, 1), (50816, 20, 2), (50816, 0.25, 0.25), (50817, 60, 1.25), (50818, 20, 1.5), (50818, 22, 1.25), (50819, 0, 0.5), (50820, 6.75, 0.25), (50821, 40, 6), (50821, 45, 5), (50821, 50, 4), (50822, 2, 0.25), (50823, 20, 2),
    (50824, 115, 1.25), (50825, 33, 0.25),
]
LAB_TEXTS = [(52033, ("ART.", "VEN.", "ART.", "MIX.")), (52033, ("ART.", "ART.", "VEN.", "CENTRAL VENOUS.")), (50807, ("INTUBATED", "NOT INTUBATED", "", "VENTED"))]
INPUT_CODES = [(221653, "mcg/kg/min"), (221662, "mcg/kg/min"), (221289, "mcg/kg/min"), (221986, "mcg/kg/min"), (222062, "mg/hour"), (221555, "mg/hour"), (221906, "mg/kg/min"), (221906, "mcg/kg/min"), (221749, "mcg/min"), (221749, "mcg/kg/min"), (222315, "units/min"), (222315, "units/hour"), (227536, "mEq/hour"), (227525, "mL/hour")]
OLDER_CODES = [4649, 30042, 30306, 30043, 30307, 30044, 30119, 30309, 30046, 30125, 30047, 30120, 30127, 30128, 30051, 30124, 30150, 30131]
OUTPUT_CODES = [226559, 226560, 226561, 226584, 226563, 226564, 226565, 226567, 226557, 226558, 227488, 227489, 226559, 226559, 226560, 226573]
LINE_CODES = [
    (225752, "Arterial Line"), (225789, "Sheath"), (225761, "Sheath Insertion"), (224263, "Multi Lumen"), (224264, "PICC Line"), (224267, "Cordis/Introducer"), (224268, "Trauma line"),
    (224269, "CCO PAC"), (224270, "Dialysis Catheter"), (224272, "IABP line"), (224273, "PA Catheter"), (226124, "ICP Catheter"), (228169, "Impella Line"), (225202, "Indwelling Port (PortaCath)"),
    (225199, "Triple Introducer"), (225441, "Hemodialysis"), (225802, "Dialysis - CRRT"), (225803, "Dialysis - CVVHD"), (225805, "Peritoneal Dialysis"), (225809, "Dialysis - CVVHDF"), (225955, "Dialysis - SCUF"), (225436, "CRRT Filter Change"), (225792, "Invasive Ventilation"),
]
DRUGS = [
    ("Lisinopril", "PO"), ("Captopril", "PO/NG"), ("Enalapril Maleate", "PO"), ("Losartan Potassium", "PO"), ("Valsartan", "PO"), ("Entresto", "PO"), ("Aspirin EC", "PO"), ("Ibuprofen", "PO"),
    ("Ketorolac", "IV"), ("Naproxen", "PO"), ("Vancomycin", "IV"), ("Vancomycin Oral Liquid", "PO"), ("CefePIME", "IV"), ("Piperacillin-Tazobactam", "IV"), ("Ciprofloxacin 0.3% Ophth Soln", "OU"),
    ("Meropenem", "IV"), ("Erythromycin", "OU"), ("Acetaminophen", "PO"), ("Heparin", "SC"), ("Furosemide", "IV"), ("Azithromycin", "PO"), ("Levofloxacin", "IV"), ("CeFAZolin", "IV"), ("Tobramycin Inhalation Soln", "IH"), ("Insulin", "SC"), ("Metoprolol", "PO"), ("MetRONIDAZOLE (FLagyl)", "IV"), ("Ampicillin Desensitization", "IV"),
]
ICD_CODES = [
    ("41001", 9), ("I214", 10), ("42822", 9), ("39891", 9), ("4255", 9), ("I5023", 10), ("4401", 9), ("I7001", 10), ("4349", 9), ("I639", 10), ("2900", 9), ("F0150", 10), ("4929", 9), ("J449", 10), ("7100", 9), ("M069", 10), ("53140", 9), ("K259", 10), ("5712", 9),
    ("K7030", 10), ("25000", 9), ("E1165", 10), ("25040", 9), ("E1121", 10), ("3420", 9), ("G8190", 10), ("5855", 9), ("N186", 10), ("1629", 9), ("C349", 10), ("4560", 9), ("I8501", 10), ("1970", 9), ("C7951", 10), ("042", 9), ("B20", 10), ("20200", 9), ("C8331", 10), ("2386", 9), ("V420", 9), ("Z992", 10), ("99591", 9), ("4019", 9), ("I10", 10),
    ("78552", 9), ("99592", 9), ("0389", 9), ("5849", 9), ("51881", 9), ("2874", 9),
]

# The older generation: two bedside systems with codes of their own.
OLDER_CHART_CODES = [
    (211, 30, 4), (220045, 40, 3), (51, 60, 4), (442, 50, 5), (455, 60, 3), (220179, 60, 5), (8368, 20, 4), (8441, 30, 3), (220051, 30, 3), (456, 40, 3), (52, 30, 4), (220052, 40, 3),
    (220181, 30, 3), (615, 4, 1), (618, 6, 1), (220210, 4, 1), (678, 92, 0.75), (676, 33, 0.5), (223761, 88, 0.75), (223762, 30, 0.5), (646, 70, 1), (220277, 72, 1), (807, 40, 12), (811, 50, 9),
    (220621, 50, 12), (1529, 45, 10), (226, -4, 2), (1374, -2, 3), (220765, -10, 4), (227989, 0, 3), (454, 1, 0.25), (184, 1, 0.25), (723, 1, 0.25), (223901, 1, 0.25), (220739, 1, 0.25),
    (223900, 2, 0.25), (190, 0, 0.25), (3420, 15, 3), (3422, 18, 3), (223835, 18, 2.25), (223835, 0.25, 0.25), (762, 40, 3.5), (763, 45, 2.5), (226512, 50, 2), (224639, 45, 2.5), (3580, 1, 0.25),
    (3581, 2, 0.5), (3582, 1, 1), (3723, 1, 0.5), (920, 50, 0.75), (1394, 55, 0.5), (3485, 140, 3), (4188, 130, 4), (226707, 55, 0.75), (226730, 115, 4), (445, 3, 0.5), (639, 200, 10), (682, 300, 10),
    (535, 10, 1), (543, 8, 1), (505, 0, 0.5), (220339, 0, 0.5), (224687, 4, 0.5), (224685, 300, 10), (223834, 1, 0.5), (227287, 1, 1), (470, 1, 1), (2510, 50, 60), (3087, 80, 60),
]
OLDER_TEXT_CODES = [
    (720, ("Drager", "Other/Remarks", "Drager", "7200A")), (223848, ("Drager", "Hamilton", "Avea", "Other")), (223849, ("CMV", "PSV/SBT", "SIMV", "Standby")),
    (467, ("Ventilator", "Nasal Cannula", "Face Tent", "Trach Mask")), (467, ("Cannula", "Ventilator", "None", "T-Piece")), (640, ("Extubated", "Self Extubation", "Intubated", "Extubated")),
    (226732, ("Nasal cannula", "None", "Venti mask ", "High flow nasal cannula")), (723, ("1.0 ET/Trach", "5 Oriented", "1.0 ET/Trach", "2.0 Incomp sounds")),
    (223900, ("No Response-ETT", "Oriented", "Confused", "No Response-ETT")), (128, ("Full Code", "Do Not Resuscita", "Comfort Measures", "CPR Not Indicate")),
    (223758, ("Full code", "DNR (do not resuscitate)", "DNI (do not intubate)", "DNR / DNI")), (128, ("Do Not Intubate", "Other/Remarks", "Full Code", "Full Code")), (4183, ("3.25", "2100", "about 3", "0.75")),
    (229, ("A-Line", "Dialysis Line", "Multi-lumen", "IABP")), (235, ("PICC line", "A-Line", "Swan", "Venous Access")), (271, ("None", "Portacath", "None", "None")), (582, ("CVVHD Start", "Procedure", "OR", "Imaging")), (466, ("Primary RN", "Dialysis RN", "Primary RN", "Resident")),
]
_GAS_LAST = [c for c in LAB_CODES if 50813 <= c[0] <= 50821]  # beside the specimen's text
OLDER_LAB_CODES = [*[c for c in LAB_CODES if c not in _GAS_LAST], (50812, 0, 0.25), (50826, 300, 10), (50827, 8, 1), (50828, 0, 1), *_GAS_LAST]
OLDER_LAB_TEXTS = [(50800, ("ART", "VEN", "ART", "MIX")), (50807, ("INTUBATED", "NOT INTUBATED", "", "VENTED"))]
OLDER_OUTPUT_CODES = [40055, 43175, 40069, 40094, 40715, 40473, 226559, 226560, 226561, 227488, 227489, 40056, 226573, 40428]
OLDER_FLUID_CODES = [30179, 30001, 30004, 30005, 30180, 44172, 46410, 42324, 42588, 30008, 30009, 42832, 30018, 30021, 41491, 30012]
OLDER_FLUID_ORDERS = [(225168, "ml", "mL/hour"), (220970, "ml", "mL/hour"), (227072, "ml", "mL/hour"), (227070, "ml", "mL/hour"), (220862, "ml", "mL/hour"), (220864, "L", "mL/min"), (225158, "ml", "mL/hour"), (225828, "L", "mL/min"), (225159, "ml", "mL/kg/hour")]
ICD9_CODES = [
    "39891", "40201", "4254", "4280", "42610", "4273", "7850", "0932", "394", "4240", "4150", "416", "0930", "440", "4439", "4019", "4039", "40301", "3341", "342", "33392", "3320", "345", "4168", "491", "25000", "2504", "2409",
    "243", "585", "V420", "40493", "07022", "0706", "571", "5317", "5349", "042", "2030", "200", "196", "1970", "140", "1950", "72889", "714", "2871", "286", "2780", "7832", "260", "2536", "276", "2800", "2801", "281", "2652", "980",
    "V6542", "3052", "292", "29604", "295", "2962", "311", "0389", "99591",
]


def _numbers(codes) -> str:
    rows = ", ".join(f"({i}, {c}, CAST({lo} AS DOUBLE), CAST({step} AS DOUBLE), CAST(NULL AS VARCHAR(60)), CAST(NULL AS VARCHAR(60)), CAST(NULL AS VARCHAR(60)), CAST(NULL AS VARCHAR(60)))" for i, (c, lo, step) in codes)
    return rows


def _texts(codes) -> str:
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    return ", ".join(f"({i}, {c}, CAST(1 AS DOUBLE), CAST(1 AS DOUBLE), {', '.join(map(quoted, t))})" for i, (c, t) in codes)


def _code_rows(numbers, texts) -> str:
    n = [*enumerate(numbers)]
    t = [*enumerate(texts, len(numbers))]
    return f"(VALUES {_numbers(n)}, {_texts(t)}) AS c(idx, itemid, lo, step, t0, t1, t2, t3)"


def _readings(numbers, texts, slots: int, mult: int, stride: int = 13) -> str:
    """One row per event and slot: its code, text and value."""
    n = len(numbers) + len(texts)
    return f"""
SELECT e.event_id, e.user_id, e.ts, s.slot, c.itemid,
       CASE WHEN c.t0 IS NOT NULL THEN CASE e.event_id % 4 WHEN 0 THEN c.t0 WHEN 1 THEN c.t1 WHEN 2 THEN c.t2 ELSE c.t3 END
            WHEN (e.event_id + s.slot) % 53 = 0 THEN NULL ELSE 'v' END AS value,
       CASE WHEN c.t0 IS NOT NULL THEN CAST(NULL AS DOUBLE)
            WHEN (e.event_id + s.slot) % 59 = 0 THEN CAST(NULL AS DOUBLE)
            WHEN (e.event_id * 3 + s.slot) % 61 = 0 THEN CAST(99999 AS DOUBLE)
            ELSE c.lo + c.step * CAST((e.event_id * 7 + s.slot * 3) % 37 AS DOUBLE) END AS valuenum
FROM {{events}} e
CROSS JOIN (VALUES {', '.join(f'({i})' for i in range(slots))}) AS s(slot)
JOIN {_code_rows(numbers, texts)} ON c.idx = (e.event_id * {mult} + s.slot * {stride}) % {n}"""


def _list(values, cols: str) -> str:
    quoted = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    rows = ", ".join(f"({i}, {', '.join(quoted(x) for x in (v if isinstance(v, tuple) else (v,)))})" for i, v in enumerate(values))
    return f"(VALUES {rows}) AS c(idx, {cols})"


HALF = "CASE WHEN CAST({t} AS DATE) >= CAST('2024-01-15' AS DATE) THEN 1 ELSE 0 END"
_stay = "e.user_id * 100 + " + HALF.format(t="e.ts")

TABLES = {
    "patients": """
SELECT user_id AS subject_id, CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender, CAST(18 + user_id % 70 AS INT) AS anchor_age,
       CAST(2024 - user_id % 5 AS INT) AS anchor_year, CASE WHEN user_id % 6 = 0 THEN CAST('2024-06-01' AS DATE) END AS dod
FROM {events} GROUP BY user_id""",
    "admissions": """
SELECT user_id AS subject_id, user_id * 10 AS hadm_id, min(ts) - INTERVAL '6' HOUR AS admittime, max(ts) + INTERVAL '6' HOUR AS dischtime,
       CASE WHEN user_id % 9 = 0 THEN max(ts) - INTERVAL '1' HOUR END AS deathtime,
       CASE user_id % 3 WHEN 0 THEN 'ELECTIVE' WHEN 1 THEN 'EW EMER.' ELSE 'URGENT' END AS admission_type,
       CASE WHEN user_id % 9 = 0 THEN 'DEAD/EXPIRED' ELSE 'HOME' END AS discharge_location,
       CASE user_id % 4 WHEN 0 THEN 'WHITE' WHEN 1 THEN 'ASIAN' WHEN 2 THEN 'BLACK' ELSE 'OTHER' END AS race,
       CAST(CASE WHEN user_id % 9 = 0 THEN 1 ELSE 0 END AS INT) AS hospital_expire_flag
FROM {events} GROUP BY user_id""",
    "icustays": f"""
SELECT user_id AS subject_id, user_id * 10 AS hadm_id, user_id * 100 + half AS stay_id, min(ts) AS intime, max(ts) AS outtime
FROM (SELECT user_id, ts, {HALF.format(t='ts')} AS half FROM {{events}}) x GROUP BY user_id, half""",
    "services": """
SELECT user_id AS subject_id, user_id * 10 AS hadm_id, min(ts) - INTERVAL '5' HOUR AS transfertime,
       CASE user_id % 4 WHEN 0 THEN 'SURG' WHEN 1 THEN 'MED' WHEN 2 THEN 'ORTHO' ELSE 'NSURG' END AS curr_service
FROM {events} GROUP BY user_id""",
    "chartevents": f"""
SELECT e.user_id AS subject_id, e.user_id * 10 AS hadm_id, {_stay} AS stay_id, e.ts AS charttime,
       e.ts + (e.slot % 3) * INTERVAL '1' MINUTE AS storetime, e.itemid, e.value, e.valuenum, CAST(NULL AS VARCHAR(20)) AS valueuom
FROM ({_readings(CHART_CODES, TEXT_CODES, 8, 5)}) e""",
    "labevents": f"""
SELECT e.event_id * 10 + e.slot AS labevent_id, e.user_id AS subject_id, e.user_id * 10 AS hadm_id, e.event_id AS specimen_id, e.itemid,
       e.ts AS charttime, e.ts + INTERVAL '1' HOUR AS storetime, e.value, e.valuenum
FROM ({_readings(LAB_CODES, LAB_TEXTS, 10, 7)}) e""",
    "inputevents": f"""
SELECT e.user_id AS subject_id, e.user_id * 10 AS hadm_id, {_stay} AS stay_id, e.ts AS starttime, e.ts + (e.event_id % 12 + 1) * INTERVAL '1' HOUR AS endtime,
       c.itemid, CAST(e.event_id % 41 AS DOUBLE) * CAST(0.25 AS DOUBLE) AS amount,
       CASE WHEN e.event_id % 23 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(e.event_id % 29 AS DOUBLE) * CAST(0.25 AS DOUBLE) END AS rate,
       c.rateuom, e.event_id AS orderid, CAST(floor(e.event_id / 2) AS BIGINT) AS linkorderid,
       CASE WHEN e.event_id % 31 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(64 AS DOUBLE) END AS patientweight,
       CASE e.event_id % 5 WHEN 0 THEN 'Stopped' WHEN 1 THEN 'Paused' ELSE 'FinishedRunning' END AS statusdescription
FROM {{events}} e JOIN {_list(INPUT_CODES, 'itemid, rateuom')} ON c.idx = e.event_id % {len(INPUT_CODES)}""",
    "outputevents": f"""
SELECT e.user_id AS subject_id, e.user_id * 10 AS hadm_id, {_stay} AS stay_id, e.ts AS charttime, c.itemid, CAST(e.event_id % 83 AS DOUBLE) * CAST(5 AS DOUBLE) AS value
FROM {{events}} e JOIN {_list(OUTPUT_CODES, 'itemid')} ON c.idx = e.event_id % {len(OUTPUT_CODES)}""",
    "procedureevents": f"""
SELECT e.user_id AS subject_id, e.user_id * 10 AS hadm_id, {_stay} AS stay_id, e.ts AS starttime, e.ts + (e.event_id % 17 + 1) * INTERVAL '1' HOUR AS endtime,
       c.itemid, CASE WHEN e.event_id % 19 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(e.event_id % 7 AS DOUBLE) END AS value,
       CASE e.event_id % 6 WHEN 0 THEN 'Left Antecub' WHEN 1 THEN 'Left Brachial' WHEN 2 THEN 'Right Femoral.' WHEN 3 THEN 'Right Radial' WHEN 4 THEN 'Left IJ' ELSE NULL END AS location
FROM {{events}} e JOIN {_list(LINE_CODES, 'itemid, label')} ON c.idx = e.event_id % {len(LINE_CODES)}""",
    "d_items": f"SELECT itemid, label FROM {_list(LINE_CODES, 'itemid, label')}",
    "prescriptions": f"""
SELECT e.user_id AS subject_id, e.user_id * 10 AS hadm_id, e.event_id AS pharmacy_id, e.ts AS starttime, e.ts + (e.event_id % 5) * INTERVAL '1' DAY AS stoptime,
       CASE WHEN e.event_id % 37 = 0 THEN 'BASE' ELSE 'MAIN' END AS drug_type, c.drug, c.route
FROM {{events}} e JOIN {_list(DRUGS, 'drug, route')} ON c.idx = e.event_id % {len(DRUGS)}""",
    "microbiologyevents": """
SELECT event_id AS microevent_id, user_id AS subject_id, user_id * 10 AS hadm_id, CAST(floor(event_id / 2) AS BIGINT) AS micro_specimen_id,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS chartdate, CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END AS charttime,
       CASE event_id % 3 WHEN 0 THEN 'BLOOD CULTURE' WHEN 1 THEN 'URINE' ELSE 'SPUTUM' END AS spec_type_desc,
       CAST(CASE WHEN event_id % 7 = 0 THEN 90856 ELSE 80002 END AS INT) AS org_itemid,
       CASE WHEN event_id % 2 = 0 THEN 'ESCHERICHIA COLI' WHEN event_id % 11 = 0 THEN '' END AS org_name
FROM {events}""",
    "diagnoses_icd": f"""
SELECT DISTINCT e.user_id AS subject_id, e.user_id * 10 AS hadm_id, c.icd_code, CAST(c.icd_version AS INT) AS icd_version
FROM {{events}} e JOIN {_list(ICD_CODES, 'icd_code, icd_version')} ON c.idx = (e.user_id * 11 + e.event_id % 5) % {len(ICD_CODES)}""",
    "inputevents_cv": f"""
SELECT {_stay} AS icustay_id, e.ts AS charttime, c.itemid,
       CASE WHEN e.event_id % 7 = 0 THEN CAST(NULL AS DOUBLE) WHEN e.event_id % 5 = 0 OR e.user_id % 2 = 1 THEN CAST(0 AS DOUBLE) ELSE CAST(floor(e.event_id / 3) % 4 AS DOUBLE) * CAST(0.5 AS DOUBLE) END AS rate,
       CAST(e.event_id % 9 AS DOUBLE) AS amount, CASE WHEN e.event_id % 13 = 0 THEN 'Stopped' WHEN e.event_id % 17 = 0 THEN 'D/C''d' WHEN e.event_id % 3 = 0 THEN 'Restart' END AS stopped
FROM {{events}} e CROSS JOIN (VALUES (0), (1), (2), (3), (4)) AS s(slot) JOIN {_list(OLDER_CODES, 'itemid')} ON c.idx = (e.event_id + s.slot * 4) % {len(OLDER_CODES)}""",
    "inputevents_mv": f"""
SELECT {_stay} AS icustay_id, e.ts AS starttime, e.ts + (e.event_id % 12 + 1) * INTERVAL '1' HOUR AS endtime, c.itemid, CAST(floor(e.event_id / 4) AS BIGINT) AS linkorderid,
       CASE WHEN e.user_id % 2 = 1 THEN CAST(0 AS DOUBLE) ELSE CAST(e.event_id % 29 AS DOUBLE) * CAST(0.25 AS DOUBLE) END AS rate, c.rateuom, CAST(e.event_id % 41 AS DOUBLE) AS amount, CASE WHEN e.event_id % 6 = 0 THEN 'Rewritten' ELSE 'FinishedRunning' END AS statusdescription
FROM {{events}} e JOIN {_list([*INPUT_CODES, (227692, 'mcg/min'), (221282, 'mg'), (221668, 'mg/hour'), (222168, 'mcg/kg/min'), (221744, 'mcg/hour')], 'itemid, rateuom')} ON c.idx = e.event_id % {len(INPUT_CODES) + 5}""",
    "procedures_icd": f"""
SELECT DISTINCT e.user_id AS subject_id, e.user_id * 10 AS hadm_id, c.icd9_code FROM {{events}} e JOIN {_list(['9670', '967', '3995', '8914', '9672', '0001'], 'icd9_code')} ON c.idx = (e.user_id + e.event_id % 2) % 6""",
    "poe": """
SELECT 'p' || CAST(event_id AS VARCHAR(20)) AS poe_id, user_id AS subject_id, user_id * 10 AS hadm_id, ts AS ordertime,
       CASE WHEN event_id % 4 = 0 THEN 'General Care' ELSE 'Medications' END AS order_type,
       CASE WHEN event_id % 8 = 0 THEN 'Code status' ELSE 'Other' END AS order_subtype
FROM {events}""",
    "poe_detail": """
SELECT 'p' || CAST(event_id AS VARCHAR(20)) AS poe_id, user_id AS subject_id, CASE WHEN event_id % 8 = 0 THEN 'Code status' ELSE 'Other' END AS field_name,
       CASE event_id % 32 WHEN 0 THEN 'Resuscitate (Full code)' WHEN 8 THEN 'DNAR (DO NOT attempt resuscitation for cardiac arrest) ' WHEN 16 THEN 'Full code  (attempt resuscitation)' ELSE 'Do not resuscitate (DNR/DNI)' END AS field_value
FROM {events}""",
    "older_icustays": f"""
SELECT user_id AS subject_id, user_id * 10 AS hadm_id, user_id * 100 + half AS icustay_id, min(ts) AS intime, max(ts) AS outtime, CASE WHEN user_id % 2 = 0 THEN 'carevue' ELSE 'metavision' END AS dbsource
FROM (SELECT user_id, ts, {HALF.format(t='ts')} AS half FROM {{events}}) x GROUP BY user_id, half""",
    "older_patients": """
SELECT user_id AS subject_id, CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender, CASE WHEN user_id % 6 = 0 THEN CAST('2024-06-01' AS DATE) END AS dod,
       CAST(make_date(CAST(2024 - CASE WHEN user_id % 17 = 0 THEN 0 ELSE 18 + user_id % 70 END AS INT), 1, CAST(1 + user_id % 20 AS INT)) AS TIMESTAMP) AS dob
FROM {events} GROUP BY user_id""",
    "older_admissions": """
SELECT user_id AS subject_id, user_id * 10 AS hadm_id, min(ts) - INTERVAL '6' HOUR AS admittime, max(ts) + INTERVAL '6' HOUR AS dischtime,
       CASE user_id % 9 WHEN 0 THEN 'WHITE' WHEN 1 THEN 'BLACK/AFRICAN AMERICAN' WHEN 2 THEN 'HISPANIC OR LATINO' WHEN 3 THEN 'ASIAN - CHINESE' WHEN 4 THEN 'AMERICAN INDIAN/ALASKA NATIVE'
         WHEN 5 THEN 'UNKNOWN/NOT SPECIFIED' WHEN 6 THEN 'PORTUGUESE' WHEN 7 THEN 'WHITE - RUSSIAN' ELSE 'CARIBBEAN ISLAND' END AS ethnicity,
       CAST(CASE WHEN user_id % 9 = 0 THEN 1 ELSE 0 END AS INT) AS hospital_expire_flag, CAST(CASE WHEN user_id % 13 = 0 THEN 0 ELSE 1 END AS INT) AS has_chartevents_data
FROM {events} GROUP BY user_id""",
    "older_chartevents": f"""
SELECT e.user_id AS subject_id, e.user_id * 10 AS hadm_id, CASE WHEN e.event_id % 71 = 0 THEN NULL ELSE {_stay} END AS icustay_id, e.ts AS charttime, e.itemid, e.value, e.valuenum,
       CAST(CASE WHEN (e.event_id + e.slot) % 47 = 0 THEN 1 WHEN e.event_id % 2 = 0 THEN 0 END AS INT) AS error
FROM ({_readings(OLDER_CHART_CODES, OLDER_TEXT_CODES, 8, 5, 1)}) e""",
    "older_labevents": f"""
SELECT e.user_id AS subject_id, e.user_id * 10 AS hadm_id, e.itemid, e.ts AS charttime, e.value, e.valuenum
FROM ({_readings(OLDER_LAB_CODES, OLDER_LAB_TEXTS, 10, 7, 1)}) e""",
    "older_outputevents": f"""
SELECT e.user_id AS subject_id, e.user_id * 10 AS hadm_id, CASE WHEN e.event_id % 71 = 0 THEN NULL ELSE {_stay} END AS icustay_id, e.ts AS charttime, c.itemid,
       CASE WHEN e.event_id % 97 = 0 THEN CAST(6000 AS DOUBLE) ELSE CAST(e.event_id % 83 AS DOUBLE) * CAST(5 AS DOUBLE) END AS value, CASE WHEN e.event_id % 43 = 0 THEN '1' END AS iserror
FROM {{events}} e CROSS JOIN (VALUES (0), (1)) AS s(slot) JOIN {_list(OLDER_OUTPUT_CODES, 'itemid')} ON c.idx = (e.event_id + s.slot * 5) % {len(OLDER_OUTPUT_CODES)}""",
    "procedureevents_mv": f"""
SELECT {_stay} AS icustay_id, e.ts + INTERVAL '20' MINUTE AS starttime, e.ts + (e.event_id % 90 + 1) * INTERVAL '1' HOUR AS endtime, c.itemid, CASE e.event_id % 3 WHEN 0 THEN 'Invasive Arterial' WHEN 1 THEN 'Invasive Venous' END AS locationcategory
FROM {{events}} e JOIN {_list([227194, 225468, 225477, 225792, 224263, 225752, 225789, 224272, 224267, 225202, 227719], 'itemid')} ON c.idx = e.event_id % 11""",
    "datetimeevents": f"""
SELECT {_stay} AS icustay_id, e.ts AS charttime, c.itemid FROM {{events}} e JOIN {_list([224183, 224186, 225318, 225343, 224288, 225319, 224290, 225344, 224187, 224284, 224285], 'itemid')} ON c.idx = (e.user_id + e.event_id % 2) % 11""",
    "older_diagnoses": f"""
SELECT subject_id, hadm_id, icd9_code, CAST(row_number() OVER (PARTITION BY hadm_id ORDER BY icd9_code) AS INT) AS seq_num FROM (
SELECT DISTINCT e.user_id AS subject_id, e.user_id * 10 AS hadm_id, c.icd9_code FROM {{events}} e JOIN {_list(ICD9_CODES, 'icd9_code')} ON c.idx = (e.user_id * 11 + e.event_id % 9) % {len(ICD9_CODES)}) d""",
    "older_prescriptions": f"""
SELECT e.user_id AS subject_id, e.user_id * 10 AS hadm_id, CAST(CAST(e.ts AS DATE) AS TIMESTAMP) AS startdate, CAST(CAST(e.ts AS DATE) AS TIMESTAMP) + (e.event_id % 5) * INTERVAL '1' DAY AS enddate,
       CASE WHEN e.event_id % 37 = 0 THEN 'BASE' ELSE 'MAIN' END AS drug_type, c.drug, c.route
FROM {{events}} e JOIN {_list(DRUGS, 'drug, route')} ON c.idx = e.event_id % {len(DRUGS)}""",
    "older_fluids_cv": f"""
SELECT {_stay} AS icustay_id, e.ts AS charttime, c.itemid, CASE WHEN e.event_id % 11 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(e.event_id % 41 AS DOUBLE) * CAST(25 AS DOUBLE) END AS amount, 'ml' AS amountuom,
       CASE WHEN e.event_id % 22 = 0 THEN 'Stopped' END AS stopped
FROM {{events}} e CROSS JOIN (VALUES (0), (1), (2)) AS s(slot) JOIN {_list(OLDER_FLUID_CODES, 'itemid')} ON c.idx = (e.event_id + s.slot * 5) % {len(OLDER_FLUID_CODES)}""",
    "older_fluids_mv": f"""
SELECT {_stay} AS icustay_id, e.ts AS starttime, e.ts + (e.event_id % 3 + 1) * INTERVAL '1' HOUR AS endtime, c.itemid, c.amountuom, c.rateuom, CAST(64 AS DOUBLE) AS patientweight,
       CASE WHEN c.amountuom = 'L' THEN CAST(e.event_id % 9 AS DOUBLE) * CAST(0.25 AS DOUBLE) ELSE CAST(e.event_id % 41 AS DOUBLE) * CAST(25 AS DOUBLE) END AS amount,
       CASE WHEN e.event_id % 7 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(e.event_id % 53 AS DOUBLE) * CAST(8 AS DOUBLE) END AS rate,
       CASE WHEN e.event_id % 6 = 0 THEN 'Rewritten' ELSE 'FinishedRunning' END AS statusdescription
FROM {{events}} e JOIN {_list(OLDER_FLUID_ORDERS, 'itemid, amountuom, rateuom')} ON c.idx = e.event_id % {len(OLDER_FLUID_ORDERS)}""",
    "ccs_multi_dx": """
SELECT 'c' || CAST(p_partkey AS VARCHAR(20)) AS icd9_code, CAST(p_partkey % 18 + 1 AS VARCHAR(9)) AS ccs_level1, 'Group ' || p_brand || CASE WHEN p_partkey % 3 = 0 THEN ' [' || CAST(p_partkey % 90 AS VARCHAR(9)) || '.]' ELSE '' END AS ccs_group1,
       CAST(p_partkey % 18 + 1 AS VARCHAR(9)) || '.' || CAST(p_partkey % 7 AS VARCHAR(9)) AS ccs_level2, p_type || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE ' [' || CAST(p_partkey % 250 AS VARCHAR(9)) || '.]' END AS ccs_group2,
       CASE WHEN p_partkey % 2 = 0 THEN '1.' || CAST(p_partkey % 11 AS VARCHAR(9)) END AS ccs_level3, CASE WHEN p_partkey % 2 = 0 THEN p_name || CASE WHEN p_partkey % 4 = 0 THEN ' [' || CAST(p_partkey % 300 AS VARCHAR(9)) || '.]' ELSE '' END END AS ccs_group3,
       CASE WHEN p_partkey % 6 = 0 THEN '1.2.3' END AS ccs_level4, CASE WHEN p_partkey % 6 = 0 THEN p_name || ' deep' END AS ccs_group4
FROM {part}""",
    "noteevents": """
SELECT event_id AS row_id, user_id AS subject_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id * 10 END AS hadm_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS chartdate,
       CASE WHEN event_id % 2 = 0 THEN 'Echo' ELSE 'Nutrition' END AS category,
       'Indication: chest pain ' || CAST(event_id % 7 AS VARCHAR(9)) || chr(10) || 'Height: (in) ' || CASE WHEN event_id % 8 = 0 THEN '[** Numeric Identifier **]' ELSE CAST(50 + event_id % 30 AS VARCHAR(9)) END || chr(10) ||
       'Weight (lb): ' || CAST(90 + event_id % 150 AS VARCHAR(9)) || chr(10) || 'BSA (m2): ' || CASE WHEN event_id % 3 = 0 THEN '2' ELSE '1.87' END || ' m2' || chr(10) || 'BP (mm Hg): ' || CAST(90 + event_id % 60 AS VARCHAR(9)) ||
       '/' || CAST(50 + event_id % 40 AS VARCHAR(9)) || chr(10) || 'HR (bpm): ' || CAST(50 + event_id % 60 AS VARCHAR(9)) || chr(10) || 'Status: Inpatient' || chr(10) || 'Date/Time: [**2024-1-5**] at ' ||
       lpad(CAST(event_id % 24 AS VARCHAR(9)), 2, '0') || ':30' || chr(10) || 'Test: TTE (Complete)' || chr(10) || 'Doppler: Full Doppler' || chr(10) || 'Contrast: None' || chr(10) ||
       CASE WHEN event_id % 6 = 0 THEN '' ELSE 'Technical Quality: Adequate' || chr(10) END AS text
FROM {events}""",
    "older_line_events": f"""
SELECT {_stay} AS icustay_id, e.ts AS charttime, e.ts + s.slot * INTERVAL '3' MINUTE AS storetime, c.itemid,
       CASE WHEN c.itemid > 8000 THEN CASE (e.event_id + s.slot) % 5 WHEN 0 THEN 'Left Antecub' WHEN 1 THEN 'Right Femoral.' WHEN 2 THEN 'Left IJ' WHEN 3 THEN 'Right Brachial' ELSE NULL END
            ELSE CASE CAST(floor(e.event_id / 40) AS BIGINT) % 5 WHEN 0 THEN 'A-Line' WHEN 1 THEN 'Dialysis Line' WHEN 2 THEN 'Multi-lumen' WHEN 3 THEN 'IABP' ELSE 'Portacath' END END AS value,
       CASE WHEN e.event_id % 6 = 0 THEN 'D/C''d' WHEN e.event_id % 11 = 0 THEN NULL ELSE 'NotStopd' END AS stopped, CAST(CASE WHEN e.event_id % 47 = 0 THEN 1 WHEN e.event_id % 2 = 0 THEN 0 END AS INT) AS error
FROM {{events}} e CROSS JOIN (VALUES (0), (1), (2), (3)) AS s(slot) JOIN {_list([229, 8392, 229, 8392, 235, 8393, 8399, 271], 'itemid')} ON c.idx = (e.user_id + s.slot * CASE WHEN e.event_id % 2 = 0 THEN 1 ELSE 2 END) % 8""",
    "older_line_procedures": f"""
SELECT {_stay} AS icustay_id, e.ts AS starttime, e.ts + (e.event_id % 90 + 1) * INTERVAL '1' HOUR AS endtime, c.itemid, c.label,
       CASE e.event_id % 5 WHEN 0 THEN 'Left Antecube' WHEN 1 THEN 'Left Axilla.' WHEN 2 THEN 'Right Brachial.' WHEN 3 THEN 'Right IJ' ELSE NULL END AS location, CASE WHEN e.event_id % 6 = 0 THEN 'Rewritten' ELSE 'FinishedRunning' END AS statusdescription
FROM {{events}} e JOIN {_list(LINE_CODES, 'itemid, label')} ON c.idx = e.event_id % {len(LINE_CODES)}""",
    "older_dialysis_events": f"""
SELECT {_stay} AS icustay_id, e.ts + s.slot * INTERVAL '90' MINUTE AS charttime, c.itemid, CAST(CASE WHEN e.event_id % 53 = 0 THEN 1 WHEN e.event_id % 2 = 0 THEN 0 END AS INT) AS error,
       CASE WHEN c.itemid = 224146 THEN CASE e.event_id % 6 WHEN 0 THEN 'New Filter' WHEN 1 THEN 'Discontinued' WHEN 2 THEN 'Active' WHEN 3 THEN 'Reinitiated' WHEN 4 THEN 'Recirculating' ELSE NULL END
            WHEN c.itemid = 665 THEN CASE e.event_id % 6 WHEN 0 THEN 'Initiated' WHEN 1 THEN 'DC''d' WHEN 2 THEN 'Active' WHEN 3 THEN 'Clotted' WHEN 4 THEN 'Clots Present' ELSE 'Other' END
            WHEN c.itemid = 147 THEN CASE WHEN e.event_id % 2 = 0 THEN 'Yes' ELSE 'No' END WHEN c.itemid = 225956 THEN 'Clotted'
            WHEN c.itemid IN (152, 227290) THEN CASE e.event_id % 6 WHEN 0 THEN 'CVVH' WHEN 1 THEN 'CVVHD' WHEN 2 THEN 'CVVHDF' WHEN 3 THEN 'SCUF' WHEN 4 THEN 'Peritoneal' ELSE 'Unknown' END
            WHEN c.itemid = 582 THEN CASE e.event_id % 6 WHEN 0 THEN 'CAVH Start' WHEN 1 THEN 'CVVHD D/C' WHEN 2 THEN 'Hemodialysis st' WHEN 3 THEN 'Hemodialysis end' WHEN 4 THEN 'Peritoneal Dial' ELSE 'OR' END
            WHEN c.itemid = 235 THEN CASE WHEN e.event_id % 2 = 0 THEN 'Dialysis Line' ELSE 'A-Line' END WHEN c.itemid = 225965 THEN CASE WHEN e.event_id % 2 = 0 THEN 'In use' ELSE 'Capped' END ELSE 'v' END AS value,
       CASE WHEN c.itemid IN (224146, 665, 147, 225956, 152, 227290, 582, 235, 225965) THEN NULL ELSE CAST((e.event_id + s.slot) % 7 AS DOUBLE) END AS valuenum
FROM {{events}} e CROSS JOIN (VALUES (0), (1), (2), (3), (4)) AS s(slot)
JOIN {_list([224149, 224144, 665, 29, 79, 224146, 147, 5683, 224191, 612, 225956, 152, 227290, 582, 235, 225965, 226499, 225810, 226118, 146], 'itemid')} ON c.idx = (e.event_id * 3 + s.slot) % 20""",
    "older_blockers": f"""
SELECT {_stay} AS icustay_id, e.ts AS charttime, c.itemid, c.side, CASE WHEN c.side = 'chart' THEN CAST(e.event_id % 16 AS DOUBLE) END AS valuenum,
       CASE WHEN c.side = 'chart' OR e.event_id % 7 = 0 THEN NULL WHEN e.event_id % 5 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(floor(e.event_id / 6) % 3 AS DOUBLE) * CAST(0.5 AS DOUBLE) END AS rate,
       CASE WHEN c.side = 'chart' OR e.event_id % 4 = 0 THEN NULL ELSE CAST(e.event_id % 9 AS DOUBLE) END AS amount, CASE WHEN e.event_id % 13 = 0 THEN 'Stopped' WHEN e.event_id % 17 = 0 THEN 'D/C''d' WHEN e.event_id % 3 = 0 THEN 'Restart' END AS stopped
FROM {{events}} e JOIN {_list([(30114, 'fluid'), (30138, 'fluid'), (42174, 'fluid'), (30114, 'fluid'), (2164, 'chart'), (30113, 'fluid'), (30018, 'fluid')], 'itemid, side')} ON c.idx = e.event_id % 7""",
    "older_dialysis_fluids": f"""
SELECT {_stay} AS icustay_id, e.ts AS charttime, c.itemid, c.side, CASE WHEN e.event_id % 9 = 0 THEN NULL ELSE CAST(e.event_id % 5 AS DOUBLE) END AS amount
FROM {{events}} e JOIN {_list([(40788, 'in'), (40907, 'in'), (44954, 'in'), (45353, 'in'), (45268, 'in'), (46013, 'in'), (30018, 'in'), (40386, 'out'), (40789, 'out'), (41897, 'out'), (44843, 'out'), (40055, 'out')], 'itemid, side')} ON c.idx = e.event_id % 12""",
    "drgcodes": """
SELECT DISTINCT user_id * 10 AS hadm_id, CASE WHEN user_id % 4 = 3 THEN 'APR' WHEN event_id % 2 = 0 THEN 'MS' ELSE 'HCFA' END AS drg_type,
       lpad(CAST(CASE WHEN event_id % 2 = 0 THEN (user_id * 37 + event_id % 3 * 200) % 999 + 1 ELSE (user_id * 53 + event_id % 3 * 150) % 579 + 1 END AS VARCHAR(9)), 3, '0') AS drg_code
FROM {events}""",
    "older_notes": """
SELECT event_id AS row_id, user_id AS subject_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS chartdate, CASE WHEN event_id % 13 = 0 THEN NULL ELSE ts END AS charttime, CASE event_id % 4 WHEN 0 THEN 'Echo' WHEN 1 THEN 'Nutrition' WHEN 2 THEN 'Physician ' ELSE 'Nutrition' END AS category,
       CASE event_id % 4 WHEN 0 THEN 'Indication: pain' || chr(10) || 'Height: (in) ' || CASE WHEN event_id % 8 = 0 THEN '[**Numeric Identifier **]' ELSE CAST(50 + event_id % 30 AS VARCHAR(9)) END || chr(10) || 'Date/Time: [**2024-1-5**] at ' || lpad(CAST(event_id % 24 AS VARCHAR(9)), 2, '0') || ':30' || chr(10)
         WHEN 1 THEN 'Weight 70 kg, ' || CASE WHEN event_id % 3 = 0 THEN 'height ' WHEN event_id % 3 = 1 THEN 'Height: ' ELSE '' END || CAST(60 + event_id % 130 AS VARCHAR(9)) || CASE WHEN event_id % 7 = 0 THEN ' in' ELSE ' cm' END || ' (5 ft)'
         WHEN 2 THEN 'Assessment. Ideal body weight: ' || CASE WHEN event_id % 5 = 0 THEN CAST(event_id % 40 + 45 AS VARCHAR(9)) || '.5' WHEN event_id % 5 = 1 THEN '0' ELSE CAST(event_id % 40 + 45 AS VARCHAR(9)) END || ' kg' ELSE 'Ideal body weight: none' END AS text
FROM {events}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An adapted table, or a driver table of that name."""
    if name not in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    given = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("events", "part") if "{" + t + "}" in TABLES[name]}
    df = spark.sql(TABLES[name], **given)
    zoned = [c for c, t in df.dtypes if t == "timestamp"]
    return df.withColumns({c: df[c].cast("timestamp_ntz") for c in zoned}) if zoned else df


def context(spark: SparkSession, sf_dir: str) -> Context:
    return Context(spark, lambda name: table(spark, sf_dir, name))


def oracle(name: str) -> str | None:
    """DuckDB SQL of a derived table: everything it needs as common table expressions."""
    names = order([name], TABLES)
    parts = []
    for n in names:
        body = CONCEPTS[n].sql if n in CONCEPTS else TABLES[n].format(events="events", part="part") if n in TABLES else None
        if n in CONCEPTS and body is None:
            return None
        if body is not None:
            parts.append(f"{n} AS MATERIALIZED (\n{body}\n)")
    return "WITH " + ", ".join(parts) + f"\nSELECT * FROM {name}"
