"""Infusions and prescriptions."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalgrid.functions.scalar import contains_any, num
from vitalgrid.operators.episodes import attach_values, elementary_segments
from vitalgrid.operators.joins import interval_join
from vitalgrid.plans.registry import concept

# Codes of infused drugs.
INFUSIONS = {"dobutamine": 221653, "dopamine": 221662, "epinephrine": 221289, "milrinone": 221986, "norepinephrine": 221906, "phenylephrine": 221749, "vasopressin": 222315}
_rate = {
    "norepinephrine": ("CASE WHEN rateuom = 'mg/kg/min' AND patientweight <> 1 THEN rate * 1000 ELSE rate END", "CASE WHEN rateuom = 'mg/kg/min' AND NOT (patientweight <=> 1) THEN rate * 1000 ELSE rate END"),
    "phenylephrine": ("CASE WHEN rateuom = 'mcg/min' THEN rate / patientweight ELSE rate END", "CASE WHEN rateuom = 'mcg/min' THEN try_divide(rate, patientweight) ELSE rate END"),
    "vasopressin": ("CASE WHEN rateuom = 'units/min' THEN rate * 60 ELSE rate END", "CASE WHEN rateuom = 'units/min' THEN rate * 60 ELSE rate END"),
}


def _infusion(name: str, code: int) -> None:
    sql, col = _rate.get(name, ("rate", "rate"))

    @concept(name, ["inputevents"], f"SELECT stay_id, linkorderid, {sql} AS vaso_rate, amount AS vaso_amount, starttime, endtime FROM inputevents WHERE itemid = {code}")
    def build(ctx):
        rows = ctx["inputevents"].filter(F.col("itemid") == code)
        return rows.select("stay_id", "linkorderid", F.expr(col).alias("vaso_rate"), F.col("amount").alias("vaso_amount"), "starttime", "endtime")


for _name, _code in INFUSIONS.items():
    _infusion(_name, _code)


@concept("neuroblock", ["inputevents"], "SELECT stay_id, orderid, rate AS drug_rate, amount AS drug_amount, starttime, endtime FROM inputevents WHERE itemid IN (222062, 221555) AND rate IS NOT NULL")
def neuroblock(ctx):
    rows = ctx["inputevents"].filter(F.col("itemid").isin(222062, 221555) & F.col("rate").isNotNull())
    return rows.select("stay_id", "orderid", F.col("rate").alias("drug_rate"), F.col("amount").alias("drug_amount"), "starttime", "endtime")


AGENTS = ["dopamine", "epinephrine", "norepinephrine", "phenylephrine", "vasopressin", "dobutamine", "milrinone"]
_cuts = " UNION ".join(f"SELECT stay_id, {e} AS starttime FROM {n}" for n in AGENTS for e in ("starttime", "endtime"))


@concept("vasoactive_agent", list(INFUSIONS), f"""
WITH c AS ({_cuts}), s AS (SELECT stay_id, starttime, lead(starttime) OVER (PARTITION BY stay_id ORDER BY starttime) AS endtime FROM c)
SELECT s.*, {', '.join(f'{n}.vaso_rate AS {n}' for n in AGENTS)} FROM s
{' '.join(f'LEFT JOIN {n} ON {n}.stay_id = s.stay_id AND s.starttime >= {n}.starttime AND s.endtime <= {n}.endtime' for n in AGENTS)}
WHERE s.endtime IS NOT NULL""")
def vasoactive_agent(ctx):
    """Segments between all starts and stops, with the rate of each drug that runs through them."""
    segments = elementary_segments([ctx[n] for n in AGENTS], "stay_id")
    return attach_values(segments, {n: ctx[n] for n in AGENTS}, "stay_id", "vaso_rate")


# Micrograms of norepinephrine that equal one unit of each drug's rate.
@concept("norepinephrine_equivalent_dose", ["vasoactive_agent"], """
SELECT stay_id, starttime, endtime, CAST(round(CAST(coalesce(norepinephrine, 0) + coalesce(epinephrine, 0) + coalesce(phenylephrine / 10, 0) + coalesce(dopamine / 100, 0)
  + coalesce(vasopressin * CAST(2.5 AS DOUBLE) / 60, 0) AS DECIMAL(38,9)), 4) AS DOUBLE) AS norepinephrine_equivalent_dose
FROM vasoactive_agent WHERE coalesce(norepinephrine, epinephrine, phenylephrine, dopamine, vasopressin) IS NOT NULL""")
def norepinephrine_equivalent_dose(ctx):
    unit = {"norepinephrine": F.col("norepinephrine"), "epinephrine": F.col("epinephrine"), "phenylephrine": F.col("phenylephrine") / 10, "dopamine": F.col("dopamine") / 100, "vasopressin": F.col("vasopressin") * 2.5 / 60}
    total = sum((F.coalesce(c, F.lit(0.0)) for c in unit.values()), F.lit(0.0))
    return ctx["vasoactive_agent"].filter(F.coalesce(*unit).isNotNull()).select("stay_id", "starttime", "endtime", num(total, 4).alias("norepinephrine_equivalent_dose"))


# Drug names of the prescription classes.
CLASSES = {
    "acei": ["benazepril", "captopril", "enalapril", "fosinopril", "lisinopril", "moexipril", "perindopril", "quinapril", "ramipril", "trandolapril"],
    "arb": ["azilsartan", "edarbi", "candesartan", "atacand", "irbesartan", "avapro", "losartan", "cozaar", "olmesartan", "benicar", "telmisartan", "micardis", "valsartan", "diovan", "sacubitril", "entresto"],
    "nsaid": ["aspirin", "bromfenac", "celecoxib", "diclofenac", "diflunisal", "etodolac", "fenoprofen", "flurbiprofen", "ibuprofen", "indomethacin", "ketoprofen", "mefenamic acid", "meloxicam", "nabumetone", "naproxen", "nepafenac", "oxaprozin", "piroxicam", "sulindac", "tolmetin"],
}


def flagged(rows, columns: list[str], cond):
    """Rows whose dictionary entry (distinct ``columns``) satisfies ``cond``: the pattern runs once per entry."""
    entries = rows.select(*columns).distinct().filter(cond)
    return rows.join(entries, columns, "left_semi")


def _class(name: str, terms: list[str]) -> None:
    test = " OR ".join(f"lower(drug) LIKE '%{t}%'" for t in terms)

    @concept(name, ["prescriptions"], f"SELECT subject_id, hadm_id, drug AS {name}, starttime, stoptime FROM prescriptions WHERE {test}")
    def build(ctx):
        rows = flagged(ctx["prescriptions"], ["drug"], contains_any(F.col("drug"), terms))
        return rows.select("subject_id", "hadm_id", F.col("drug").alias(name), "starttime", "stoptime")


for _name, _terms in CLASSES.items():
    _class(_name, _terms)


# Drug names that count as antibiotics, and routes and forms that do not.
ANTIBIOTICS = (
    "adoxa ala-tet alodox amikacin amikin amoxicill amphotericin anidulafungin ancef clavulanate ampicillin augmentin avelox avidoxy azactam azithromycin aztreonam axetil "
    "bactocill bactrim bactroban bethkis biaxin cayston cefazolin cedax cefoxitin ceftazidime cefaclor cefadroxil cefdinir cefditoren cefepime cefotan cefotetan cefotaxime "
    "ceftaroline cefpodoxime cefpirome cefprozil ceftibuten ceftin ceftriaxone cefuroxime cephalexin cephalothin cephapririn chloramphenicol cipro ciprofloxacin claforan "
    "clarithromycin cleocin clindamycin cubicin dicloxacillin dirithromycin doryx doxycy duricef dynacin ery-tab eryped eryc erythrocin erythromycin factive flagyl fortaz "
    "furadantin garamycin gentamicin kanamycin keflex kefzol ketek levaquin levofloxacin lincocin linezolid macrobid macrodantin maxipime mefoxin metronidazole meropenem "
    "methicillin minocin minocycline monodox monurol morgidox moxatag moxifloxacin mupirocin myrac nafcillin neomycin nitrofurantoin norfloxacin noroxin ocudox ofloxacin "
    "omnicef oracea oraxyl oxacillin panixine pediazole penicillin periostat pfizerpen piperacillin tazobactam primsol proquin raniclor rifadin rifampin rocephin smz-tmp septra "
    "solodyn spectracef streptomycin sulfadiazine sulfamethoxazole trimethoprim sulfatrim sulfisoxazole suprax synercid tazicef tetracycline timentin tobramycin unasyn vancocin "
    "vancomycin vantin vibativ vibra-tabs vibramycin zinacef zithromax zosyn zyvox"
).split() + ["bicillin l-a", "nicazel doxy 30", "pc pen vk", "pce dispertab"]
NOT_ROUTES = ["OU", "OS", "OD", "AU", "AS", "AD", "TP"]
NOT_FORMS = ["cream", "desensitization", "ophth oint", "gel"]


@concept("antibiotic", ["prescriptions", "icustays"], f"""
SELECT p.subject_id, p.hadm_id, i.stay_id, p.drug AS antibiotic, p.route, p.starttime, p.stoptime
FROM prescriptions p LEFT JOIN icustays i ON i.hadm_id = p.hadm_id AND p.starttime >= i.intime AND p.starttime < i.outtime
WHERE EXISTS (SELECT 1 FROM prescriptions q WHERE q.drug = p.drug AND q.route = p.route AND q.drug_type <> 'BASE')
  AND p.route NOT IN ({', '.join(f"'{r}'" for r in NOT_ROUTES)}) AND NOT regexp_matches(lower(p.route), 'ear|eye')
  AND regexp_matches(lower(p.drug), '{'|'.join(ANTIBIOTICS)}') AND NOT regexp_matches(lower(p.drug), '{'|'.join(NOT_FORMS)}')""")
def antibiotic(ctx):
    """Antibiotic prescriptions, with the stay in which they began if any."""
    rows = ctx["prescriptions"]
    drug, route = F.col("drug"), F.col("route")
    wanted = contains_any(drug, ANTIBIOTICS) & ~contains_any(drug, NOT_FORMS) & ~route.isin(NOT_ROUTES) & ~contains_any(route, ["ear", "eye"])
    entries = rows.filter("drug_type <> 'BASE'").select("drug", "route").distinct().filter(wanted)
    found = rows.join(entries, ["drug", "route"], "left_semi")
    stays = ctx["icustays"].select("hadm_id", "stay_id", "intime", "outtime")
    out = interval_join(found, stays, ["hadm_id"], "starttime", "intime", "outtime", closed="left", how="left")
    return out.select("subject_id", "hadm_id", "stay_id", F.col("drug").alias("antibiotic"), "route", "starttime", "stoptime")
