"""Comorbidity indices from diagnosis code prefixes, driven by a rule table."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalgrid.plans.registry import concept

# Per condition, code prefixes by version; "a-b" is a range of prefixes of that length.
CHARLSON = {
    "myocardial_infarct": {9: "410 412", 10: "I21 I22 I252"},
    "congestive_heart_failure": {9: "428 39891 40201 40211 40291 40401 40403 40411 40413 40491 40493 4254-4259", 10: "I43 I50 I099 I110 I130 I132 I255 I420 I425 I426 I427 I428 I429 P290"},
    "peripheral_vascular_disease": {9: "440 441 0930 4373 4471 5571 5579 V434 4431-4439", 10: "I70 I71 I731 I738 I739 I771 I790 I792 K551 K558 K559 Z958 Z959"},
    "cerebrovascular_disease": {9: "430-438 36234", 10: "G45 G46 I60-I69 H340"},
    "dementia": {9: "290 2941 3312", 10: "F00 F01 F02 F03 G30 F051 G311"},
    "chronic_pulmonary_disease": {9: "490-505 4168 4169 5064 5081 5088", 10: "J40-J47 J60-J67 I278 I279 J684 J701 J703"},
    "rheumatic_disease": {9: "725 4465 7100 7101 7102 7103 7104 7140 7141 7142 7148", 10: "M05 M06 M32 M33 M34 M315 M351 M353 M360"},
    "peptic_ulcer_disease": {9: "531 532 533 534", 10: "K25 K26 K27 K28"},
    "mild_liver_disease": {9: "570 571 0706 0709 5733 5734 5738 5739 V427 07022 07023 07032 07033 07044 07054", 10: "B18 K73 K74 K700 K701 K702 K703 K709 K713 K714 K715 K717 K760 K762 K763 K764 K768 K769 Z944"},
    "diabetes_without_cc": {9: "2500 2501 2502 2503 2508 2509", 10: "E100 E101 E106 E108 E109 E110 E111 E116 E118 E119 E120 E121 E126 E128 E129 E130 E131 E136 E138 E139 E140 E141 E146 E148 E149"},
    "diabetes_with_cc": {9: "2504 2505 2506 2507", 10: "E102 E103 E104 E105 E107 E112 E113 E114 E115 E117 E122 E123 E124 E125 E127 E132 E133 E134 E135 E137 E142 E143 E144 E145 E147"},
    "paraplegia": {9: "342 343 3341 3440 3441 3442 3443 3444 3445 3446 3449", 10: "G81 G82 G041 G114 G801 G802 G830 G831 G832 G833 G834 G839"},
    "renal_disease": {9: "582 585 586 V56 5880 V420 V451 5830-5837 40301 40311 40391 40402 40403 40412 40413 40492 40493", 10: "N18 N19 I120 I131 N032 N033 N034 N035 N036 N037 N052 N053 N054 N055 N056 N057 N250 Z490 Z491 Z492 Z940 Z992"},
    "malignant_cancer": {9: "140-172 1740-1958 200-208 2386", 10: "C43 C88 C00-C26 C30-C34 C37-C41 C45-C58 C60-C76 C81-C85 C90-C97"},
    "severe_liver_disease": {9: "4560 4561 4562 5722-5728", 10: "I850 I859 I864 I982 K704 K711 K721 K729 K765 K766 K767"},
    "metastatic_solid_tumor": {9: "196 197 198 199", 10: "C77 C78 C79 C80"},
    "aids": {9: "042 043 044", 10: "B20 B21 B22 B24"},
}


def prefix_rules(rules: dict[str, dict[int, str]]) -> list[tuple[str, int, int, str, str]]:
    """Rows (condition, version, prefix length, lowest, highest prefix)."""
    rows = []
    for name, versions in rules.items():
        for version, codes in versions.items():
            for code in codes.split():
                low, _, high = code.partition("-")
                rows.append((name, version, len(low), low, high or low))
    return rows


def prefix_flags(diagnoses, key: str, rules: dict[str, dict[int, str]]):
    """One row per ``key`` with a 0/1 column per condition.

    Distinct codes meet the rules once (both small and broadcast by size); flags are then one pivoting
    aggregation over the diagnoses.
    """
    spark = diagnoses.sparkSession
    table = spark.createDataFrame(prefix_rules(rules), "condition string, version int, n int, low string, high string")
    codes = diagnoses.select("icd_code", "icd_version").distinct()
    part = F.substring(F.col("icd_code"), F.lit(1), F.col("n"))
    cond = (F.col("icd_version") == F.col("version")) & (part >= F.col("low")) & (part <= F.col("high"))
    hits = codes.join(F.broadcast(table), cond).groupBy("icd_code", "icd_version").agg(F.collect_set("condition").alias("conditions"))
    flagged = diagnoses.join(hits, ["icd_code", "icd_version"])
    return flagged.groupBy(key).agg(*[F.max(F.array_contains("conditions", c).cast("int")).alias(c) for c in rules])


def rules_sql(rules: dict[str, dict[int, str]]) -> str:
    out = []
    for name, versions in rules.items():
        tests = [f"(icd_version = {v} AND substr(icd_code, 1, {n}) BETWEEN '{a}' AND '{b}')" for c, v, n, a, b in prefix_rules({name: versions})]
        out.append(f"coalesce(max(CASE WHEN {' OR '.join(tests)} THEN 1 ELSE 0 END), 0) AS {name}")
    return ", ".join(out)


SINGLE = ["myocardial_infarct", "congestive_heart_failure", "peripheral_vascular_disease", "cerebrovascular_disease", "dementia", "chronic_pulmonary_disease", "rheumatic_disease", "peptic_ulcer_disease"]


@concept("charlson", ["admissions", "diagnoses_icd", "age"], f"""
WITH f AS (SELECT a.subject_id, a.hadm_id, {rules_sql(CHARLSON)} FROM admissions a LEFT JOIN diagnoses_icd d ON d.hadm_id = a.hadm_id GROUP BY ALL),
g AS (SELECT f.*, CASE WHEN age <= 50 THEN 0 WHEN age <= 60 THEN 1 WHEN age <= 70 THEN 2 WHEN age <= 80 THEN 3 ELSE 4 END AS age_score FROM f LEFT JOIN age USING (hadm_id))
SELECT g.*, age_score + {' + '.join(SINGLE)} + greatest(mild_liver_disease, 3 * severe_liver_disease) + greatest(2 * diabetes_with_cc, diabetes_without_cc)
  + greatest(2 * malignant_cancer, 6 * metastatic_solid_tumor) + 2 * paraplegia + 2 * renal_disease + 6 * aids AS charlson_comorbidity_index FROM g""")
def charlson(ctx):
    flags = prefix_flags(ctx["diagnoses_icd"], "hadm_id", CHARLSON)
    j = ctx["admissions"].select("subject_id", "hadm_id").join(flags, "hadm_id", "left").join(ctx["age"].select("hadm_id", "age"), "hadm_id", "left")
    j = j.withColumns({c: F.coalesce(c, F.lit(0)) for c in CHARLSON})
    a = F.col("age")
    j = j.withColumn("age_score", F.when(a <= 50, 0).when(a <= 60, 1).when(a <= 70, 2).when(a <= 80, 3).otherwise(4))
    c = F.col
    worse = lambda x, y: F.greatest(x, y)
    total = (
        c("age_score") + sum((c(s) for s in SINGLE), F.lit(0)) + worse(c("mild_liver_disease"), 3 * c("severe_liver_disease")) + worse(2 * c("diabetes_with_cc"), c("diabetes_without_cc"))
        + worse(2 * c("malignant_cancer"), 6 * c("metastatic_solid_tumor")) + 2 * c("paraplegia") + 2 * c("renal_disease") + 6 * c("aids")
    )
    return j.drop("age").withColumn("charlson_comorbidity_index", total)
