"""Registered queries against their SQL in DuckDB."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = [
    "chemistry", "bg", "vitalsign", "gcs", "oxygen_delivery", "urine_output_rate", "weight_durations", "icustay_hourly", "vasoactive_agent", "antibiotic", "rrt", "ventilation", "code_status",
    "first_day_lab", "first_day_sofa", "charlson", "kdigo_stages", "sofa", "suspicion_of_infection", "keyed_diff", "sessionize_gap_state", "asof_latest_before", "merge_overlaps", "dt_diff_hour",
    "pivoted_vital", "pivoted_lab", "pivoted_bg_art", "pivoted_gcs", "vitals_first_day", "rbc_transfusion", "older_weight_durations", "ventilation_durations", "kdigo_stages_7day", "older_sofa", "elixhauser_score_quan", "echo_data",
    "nested_bg", "nested_icustay_hourly", "section_split", "section_select", "section_overrides", "section_table", "wall_clock_shift", "catheter_cohort_all", "catheter_labs", "catheter_vitals", "catheter_sedatives", "catheter_sofa", "catheter_icd",
    "mlods", "older_oasis", "older_lods", "older_sapsii", "older_apsiii", "saps", "older_kdigo_uo", "pivoted_sofa", "pivoted_oasis", "pivoted_invasive_lines", "pivoted_height", "pivoted_rrt", "crrt_durations", "neuroblock_dose", "elixhauser_ahrq_v37",
    "elixhauser_score_ahrq", "diff_samples", "two_variant_probe", "label_evals", "length_of_stay_distribution", "demographics_mortality", "residual_pairing", "auroc",
]


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return float(f"{float(v):.9g}")
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cur = duck.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    want = Counter(tuple(plain(v) for _, v in sorted(zip(cols, r))) for r in cur.fetchall())
    got = Counter(tuple(plain(v) for _, v in sorted(zip(df.columns, r))) for r in df.collect())
    assert got == want and got


@pytest.mark.parametrize(("name", "key"), [("sofa", ["stay_id", "hr"]), ("sepsis3", ["stay_id"]), ("first_day_lab", ["stay_id"]), ("bg", ["specimen_id"]), *[(n, ["icustay_id"]) for n in ("older_oasis", "older_lods", "mlods", "older_sapsii", "older_apsiii", "saps", "older_sofa", "catheter_cohort_all", "catheter_sofa")], ("pivoted_sofa", ["icustay_id", "hr"]), ("pivoted_oasis", ["icustay_id", "hr"])])
def test_one_row_per_key(spark, name, key):
    df = entry.queries()[name](spark, SF)
    assert df.groupBy(*key).count().filter("count > 1").isEmpty()


def test_a_written_chain_equals_the_queries(spark, tmp_path):
    from vitalgrid.plans.adapter import context
    from vitalgrid.plans.registry import write_chain
    from vitalgrid.sources.io import parquet_folder

    done = []
    put = parquet_folder(f"file://{tmp_path}")
    out = write_chain(context(spark, SF), ["older_sirs", "older_qsofa"], lambda n, df: done.append(n) or put(n, df))
    assert done.index("blood_gas_first_day") < done.index("blood_gas_first_day_arterial") < done.index("older_sirs") and len(done) == len(set(done))
    for name, df in out.items():
        assert df.exceptAll(entry.queries()[name](spark, SF)).isEmpty() and df.count() == spark.table(name).count() > 0


def test_every_dependency_is_known():
    from vitalgrid.plans.adapter import TABLES
    from vitalgrid.plans.catalog import CONCEPTS

    assert all(d in CONCEPTS or d in TABLES for c in CONCEPTS.values() for d in c.deps)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
