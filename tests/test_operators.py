import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vitalgrid.functions.dt import ceil_hour, dt_trunc, hours
from vitalgrid.functions.scalar import pack_points, unpack_points
from vitalgrid.operators import cohort, compare, episodes, joins, text
from vitalgrid.operators.resources import crosswalk, typed_values, view
from vitalgrid.sources import io

T0 = dt.datetime(2150, 1, 1)


def at(h):
    return T0 + dt.timedelta(hours=h)


def frame(spark, rows, names):
    df = spark.createDataFrame(rows, names)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"})


def test_sessionize_breaks_at_gap_and_change(spark):
    rows = [(1, at(0), "a"), (1, at(5), "a"), (1, at(6), "b"), (1, at(30), "b"), (2, at(0), "a")]
    got = episodes.sessionize(frame(spark, rows, ["k", "t", "s"]), ["k"], "t", gap_hours=14, state="s").orderBy("k", "starttime").collect()
    assert [(r.k, r.starttime, r.endtime, r.s) for r in got] == [(1, at(0), at(6), "a"), (1, at(6), at(6), "b"), (1, at(30), at(30), "b"), (2, at(0), at(0), "a")]


def test_intervals_merge_and_split(spark):
    rows = [(1, at(0), at(5)), (1, at(1), at(2)), (1, at(5), at(7)), (1, at(9), at(10)), (2, at(0), at(1))]
    df = frame(spark, rows, ["k", "starttime", "endtime"])
    merged = episodes.merge_overlaps(df, ["k"], "starttime", "endtime").orderBy("k", "starttime").collect()
    assert [tuple(r) for r in merged] == [(1, at(0), at(7)), (1, at(9), at(10)), (2, at(0), at(1))]
    cuts = episodes.elementary_segments([df.filter("k = 1")], "k").orderBy("starttime").collect()
    assert [(r.starttime, r.endtime) for r in cuts] == [(at(a), at(b)) for a, b in ((0, 1), (1, 2), (2, 5), (5, 7), (7, 9), (9, 10))]


def test_infusion_states(spark):
    rows = [(1, at(0), 0.0, 0), (1, at(1), 2.0, 0), (1, at(2), None, 0), (1, at(3), 0.0, 0), (1, at(5), 3.0, 0), (1, at(6), 3.0, 1), (1, at(8), 1.0, 0)]
    got = episodes.infusion_episodes(frame(spark, rows, "k int, t timestamp, rate double, stopped int"), ["k"], "t", "rate", "stopped").orderBy("episode").collect()
    assert [(r.starttime, r.endtime, r.max_rate) for r in got] == [(at(1), at(3), 2.0), (at(5), at(6), 3.0), (at(8), at(8), 1.0)]


def test_attached_values_keep_every_combination(spark):
    seg = frame(spark, [(1, at(0), at(1)), (1, at(1), at(2))], ["k", "starttime", "endtime"])
    drug = frame(spark, [(1, at(0), at(1), 5.0), (1, at(0), at(2), 7.0)], ["k", "starttime", "endtime", "rate"])
    got = episodes.attach_values(seg, {"x": drug, "y": drug.filter("rate > 9")}, "k", "rate").collect()
    assert sorted((r.starttime, r.x, r.y) for r in got) == [(at(0), 5.0, None), (at(0), 7.0, None), (at(1), 7.0, None)]


def test_ownership_windows(spark):
    rows = [(1, 10, at(0), at(10)), (1, 11, at(20), at(30)), (1, 12, at(100), at(110))]
    got = episodes.ownership_windows(frame(spark, rows, ["subject_id", "stay_id", "intime", "outtime"]), "subject_id", "stay_id", "intime", "outtime").orderBy("stay_id").collect()
    assert [(r.data_start, r.data_end) for r in got] == [(at(-12), at(15)), (at(15), at(42)), (at(88), at(122))]


def test_joins_on_time(spark):
    p = frame(spark, [(1, at(1)), (1, at(5)), (2, at(1))], ["k", "t"])
    iv = frame(spark, [(1, at(1), at(5), "i")], ["k", "s", "e", "v"])
    count = lambda closed: joins.interval_join(p, iv, ["k"], "t", "s", "e", closed=closed).count()
    assert [count(c) for c in ("both", "left", "right", "neither")] == [2, 1, 1, 0]
    left = frame(spark, [(1, "r1", at(5)), (1, "r2", at(20)), (3, "r3", at(5))], ["k", "id", "t"])
    right = frame(spark, [(1, at(3), 1.0), (1, at(4), 2.0), (1, at(6), 3.0)], ["k", "seen", "v"])
    got = joins.asof_join(left, right, ["k"], "t", "seen", ["v"], 4)
    assert {r.id: r.v for r in got.collect()} == {"r1": 2.0, "r2": None, "r3": None}


def test_range_joins_have_an_equality(spark):
    p = frame(spark, [(1, at(1))], ["k", "t"])
    iv = frame(spark, [(1, at(1), at(5))], ["k", "s", "e"])
    plan = joins.interval_join(p, iv, ["k"], "t", "s", "e")._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def _random_rows(seed, n, hot):
    r = random.Random(seed)
    return [(1 if r.random() < hot else r.randint(2, 9), at(r.randint(0, 400)) if r.random() > 0.02 else None, float(i)) for i in range(n)]


def test_as_of_join_equals_brute_force_without_a_join(spark):
    left, right = _random_rows(1, 300, 0.5), _random_rows(2, 300, 0.5) + [(None, at(1), 1.0)]
    l, r = frame(spark, left, ["k", "t", "id"]), frame(spark, right, ["k", "seen", "v"])
    for tolerance, wide in ((4, 24), (30, 1), (3, 3)):
        out = joins.asof_join(l, r, ["k"], "t", "seen", ["v"], tolerance, bucket_hours=wide)
        plan = out._jdf.queryExecution().executedPlan().toString()
        want = {}
        for k, t, i in left:
            near = [(s, v) for q, s, v in right if q == k and t and s and t - dt.timedelta(hours=tolerance) <= s <= t]
            want[i] = max(near)[1] if near else None
        assert {x.id: x.v for x in out.collect()} == want and out.columns == ["k", "t", "id", "v"]
        assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_interval_join_spreads_a_hot_key(spark):
    points = _random_rows(3, 600, 0.5)
    r = random.Random(4)
    spans = [(1 if r.random() < 0.5 else r.randint(2, 9), s := at(r.randint(0, 400)), s + dt.timedelta(hours=r.choice([0, 1, 30, 100, -5])), i) for i in range(80)] + [(1, None, at(5), 98), (1, at(5), None, 99)]
    p, iv = frame(spark, points, ["k", "t", "id"]), frame(spark, spans, ["k", "s", "e", "n"])
    for how in ("inner", "left"):
        out = joins.interval_join(p, iv, ["k"], "t", "s", "e", closed="left", how=how)
        want = []
        for k, t, i in points:
            own = [n for q, s, e, n in spans if q == k and t and s and e and s <= t < e]
            want += [(i, n) for n in own] or ([(i, None)] if how == "left" else [])
        assert sorted((x.id, -1 if x.n is None else x.n) for x in out.collect()) == sorted((i, -1 if n is None else n) for i, n in want)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    hot = joins.interval_join(p.filter("k = 1"), iv, ["k"], "t", "s", "e").groupBy(F.spark_partition_id()).count().collect()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(hot) >= 4  # one key's rows are in several tasks


NESTED = "id string, status string, tags array<struct<system:string,use:string,value:string>>, subject struct<reference:string>, valueQuantity struct<value:double>, valueString string, parts array<struct<name:string,codes:array<struct<system:string,code:string>>>>"


def test_views_of_nested_resources(spark):
    rows = [
        ("a", "final", [("s", "x", "1"), ("s", "y", "2"), ("t", "x", "3")], ("Patient/p1",), (1.5,), None, [("n1", [("s", "c1"), ("t", "c2")]), ("n2", []), ("n3", None)]),
        ("b", "final", [], ("Group/g1",), None, "text", []),
        ("c", "draft", [("s", "x", "9")], None, None, None, None),
        ("d", "final", None, None, None, None, [("n4", [("s", "c3")])]),
    ]
    df = spark.createDataFrame(rows, NESTED)
    got = lambda spec: sorted((tuple(r) for r in view(df, {"resource": "Thing", **spec}).collect()), key=str)
    final = [{"path": "status.where(x = 'y')"}]
    with pytest.raises(ValueError, match="no field"):
        view(df, {"where": final, "select": [{"column": [{"path": "id", "name": "i"}]}]})
    deep = {"select": [{"column": [{"path": "getResourceKey()", "name": "key"}]}, {"forEach": "parts", "column": [{"path": "name", "name": "n"}], "select": [{"forEachOrNull": "codes", "column": [{"path": "code", "name": "c"}]}]}]}
    assert sorted(map(str, got(deep))) == sorted(map(str, [("Thing/a", "n1", "c1"), ("Thing/a", "n1", "c2"), ("Thing/a", "n2", None), ("Thing/a", "n3", None), ("Thing/d", "n4", "c3")]))
    inner = {"select": [{"forEach": "parts", "select": [{"forEach": "codes.where(system='s')", "column": [{"path": "code", "name": "c"}]}]}]}
    assert got(inner) == [("c1",), ("c3",)]
    several = {"where": [{"path": "tags.where(system = 's' and use = 'x').exists()"}], "select": [{"column": [{"path": "id", "name": "i"}, {"path": "tags.where(system='s' and use='x').value", "name": "v", "type": "int"}, {"path": "tags.value", "name": "all", "collection": True}]}]}
    assert got(several) == [("a", 1, ["1", "2", "3"]), ("c", 9, ["9"])]
    typed = {"where": [{"path": "subject.exists()"}], "select": [{"column": [{"path": "subject.getReferenceKey(Patient)", "name": "p"}, {"path": "value.ofType(quantity).value", "name": "q"}, {"path": "value.ofType(string)", "name": "s"}, {"path": "tags.first().value", "name": "t"}]}]}
    assert sorted(got(typed), key=str) == sorted([("Patient/p1", 1.5, None, "1"), (None, None, "text", None)], key=str)
    side = {"select": [{"forEach": "tags", "column": [{"path": "value", "name": "v"}]}, {"forEach": "parts", "column": [{"path": "name", "name": "n"}]}]}
    assert len(got(side)) == 9  # parts side by side multiply
    both = {"select": [{"column": [{"path": "id", "name": "i"}]}, {"unionAll": [{"forEach": "tags", "column": [{"path": "value", "name": "v"}]}, {"forEach": "parts", "column": [{"path": "name", "name": "v"}]}]}]}
    assert got(both) == sorted([("a", x) for x in ("1", "2", "3", "n1", "n2", "n3")] + [("c", "9"), ("d", "n4")], key=str)
    for bad in ("parts.nothing", "parts.where(name)", "id.sum()", "a b"):
        with pytest.raises(ValueError):
            view(df, {"select": [{"column": [{"path": bad, "name": "x"}]}]})
    lean = view(df, {"select": [{"forEach": "parts", "column": [{"path": "name", "name": "n"}]}]})
    assert lean.columns == ["n"] and "valueString" not in lean._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]


def test_codes_and_typed_values(spark):
    rows = spark.createDataFrame([("s", "1", 2.5, None), ("s", "1", None, "t"), ("u", "1", 9.0, None), ("s", "7", 1.0, None), ("u", "k", None, None)], "system string, code string, q double, x string")
    codes = spark.createDataFrame([("s", "1", 100), ("u", "k", 200), ("s", "1", 100)], "system string, code string, itemid int")
    got = typed_values(crosswalk(rows, codes), "q", ["x"]).select("itemid", "valuenum", "value").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(100, 2.5, "2.5"), (100, None, "t"), (200, None, None)], key=str)


def test_comparison(spark):
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, "y"), (3, None, "z"), (4, 4.0, "w")], "k int, v double, s string")
    b = spark.createDataFrame([(1, 1.0000001, "x"), (2, 2.5, "y"), (3, 3.0, "z"), (5, 5.0, "q")], "k int, v double, s string")
    d = compare.keyed_diff(a, b, ["k"]).first().asDict()
    assert d == {"only_left": 1, "only_right": 1, "identical": 1, "differing_null_only": 1, "differing_conflict": 1, "differs_v": 2, "differs_s": 0}
    assert compare.classify(d) == "mismatch"
    assert compare.natural_key(a, ["k"]) == ["k"] and compare.natural_key(a.unionByName(a), ["k"]) is None
    h = lambda df: compare.content_hash(df).first().hash
    assert h(a) == h(a.orderBy(F.desc("k"))) != h(a.unionByName(a.limit(1)))
    assert compare.residual_columns(a, a.withColumn("s", F.lit("?"))) == ["s"]
    assert compare.schema_differences(a, a.withColumn("k", F.col("k").cast("double")).drop("s")) == [("s", "string", "missing")]


REPORTS = [
    "no headers", "", None, "one\n \ntwo\n \nthree ", "intro\n FINDINGS: heart normal\n IMPRESSION:\n\n IMPRESSIONS: fine now\n", "\n COMPARISON: none\n \nall\n is well\n \nbye", "\n CHEST, PA LATERAL:\n\n INDICATION:\tpain\n TECHNIQUE: x",
    "\n FINDINGS: \n HISTORY OF FINDINGS: a\n Conclusion: b", "x\n ADDENDUM (LATE):y z\n BONE WINDOW: c\n RECOMMENDATION(S): d\n REASON:e", "\n IMPRESSION: é\u3000ü\n COMPARISON:\n \n last", "\n EXAM: k\n IMPRESSION: one\n IMPRESSION: two \n FINDINGS:\n",
]


def _plain_sections(report):
    """Sections by scanning the text once."""
    import re

    found = [*re.finditer(r"\n ([A-Z ()/,-]+):\s", report)]
    out = [["preamble" if found else "full report", 0, report[: found[0].start(1)] if found else report]]
    for m, n in zip(found, [*found[1:], None]):
        name = m[1].lower().strip()
        plain = text.SECTION_NAMES.get(name) or next((x for x in text.MAIN_SECTIONS if x in name), None) or ("findings" if any(v in name for v in text.VIEWS) else name)
        out.append([plain, m.end(), report[m.end() : n.start() if n else len(report)]])
    out = [x for x in out if x[0] not in ("impression", "findings") or x[2].strip()]
    if not any(x[0] in ("impression", "findings") for x in out) and "\n \n" in out[-1][2]:
        name, start, body = out.pop()
        head, _, rest = body.partition("\n \n")
        out += [[name, start, head], ["last_paragraph", start + len(head) + 3, rest]]
    return out


def test_sections(spark):
    r = random.Random(8)
    pieces = ["\n ", "\n", " ", "\n \n", "FINDINGS:", "IMPRESSION: ", "CHEST (AP): ", "HISTORY:\n", "word", "é:", "ONE/TWO,-: ", "COMPARISON FILM: "]
    reports = REPORTS + ["".join(r.choices(pieces, k=r.randint(1, 25))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(reports)), "id int, t string")
    got = {}
    for x in text.section_split(df, "id", "t").orderBy("id", "pos").collect():
        got.setdefault(x.id, []).append([x.name, x.start, x.body])
    want = {i: _plain_sections(x or "") for i, x in enumerate(reports)}
    assert got == want
    table = {x.id: x for x in text.section_table(df, "id", "t").collect()}
    chosen = {x.id: x for x in text.section_select(df, "id", "t").collect()}
    for i, found in want.items():
        last = {n: b.strip() for n, _, b in found}
        assert [table[i][n] for n in text.CONCLUSIONS] == [last.get(n) for n in text.CONCLUSIONS]
        name = next((n for n in text.CONCLUSIONS if n in last), None)
        assert (chosen[i].section, chosen[i].body) == (name, last.get(name, ""))


def test_stated_sections(spark):
    df = spark.createDataFrame([(1, "\n HISTORY: h\n IMPRESSION: i"), (2, "\n HISTORY: h\n IMPRESSION: i"), (3, "0123456789"), (4, "\n IMPRESSION: i"), (5, None)], "id int, t string")
    by_name = spark.createDataFrame([(1, "history"), (4, "history"), (3, "history")], "id int, name string")
    by_place = spark.createDataFrame([(3, 2, 5), (5, 0, 0)], "id int, start int, stop int")
    got = text.section_select(df, "id", "t", by_name=by_name, by_place=by_place).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "history", "h"), (2, "impression", "i"), (3, "given place", "234"), (4, "history", ""), (5, "given place", "")]


def test_curve_area_counts_ties_half(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)], "y int, s double")
    assert abs(cohort.auroc(df, "y", "s").first().auroc - (1 + 1 + 0.5 + 1) / 4) < 1e-12


def test_sources(spark, tmp_path):
    (tmp_path / "hosp").mkdir()
    f = tmp_path / "hosp" / "labs.csv"
    f.write_text('subject_id,charttime,value\n1,2150-01-01 02:30:00,"a ""q"", b"\n2,,\n')
    df = io.read_csv(spark, str(f), io.schema("subject_id int, charttime ts, value str"))
    assert [tuple(r) for r in df.orderBy("subject_id").collect()] == [(1, dt.datetime(2150, 1, 1, 2, 30), 'a "q", b'), (2, None, None)]
    assert io.table_name(str(f)) == "hosp.labs" and io.table_name("/a/b/readme.md") is None
    io.csv_to_parquet(spark, str(f), str(tmp_path / "out"), io.schema("subject_id int, charttime ts, value str"), cluster_by="subject_id")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    kept = io.first_subjects({"a": df, "b": spark.range(3)}, df, 1)
    assert kept["a"].count() == 1 and kept["b"].count() == 3


def test_folder_of_tables(spark, tmp_path):
    import pytest

    from vitalgrid.sources import io

    (tmp_path / "hosp").mkdir()
    (tmp_path / "other").mkdir()
    (tmp_path / "hosp" / "labs.csv").write_text("subject_id,charttime,value\n1,2031-01-02 03:04:05,\n2,2031-01-02 03:04:05,x\n")
    (tmp_path / "hosp" / "readme.txt").write_text("no table")
    (tmp_path / "other" / "labs.csv").write_text("a\n1\n")
    known = {"hosp.labs": io.schema("subject_id int, charttime timestamp, value str"), "hosp.missing": None}
    with pytest.warns(UserWarning, match="hosp.missing"):
        tables = io.open_folder(spark, f"file://{tmp_path}", known, folders=["hosp"])
    assert list(tables) == ["hosp.labs"] and [r.value for r in spark.table("hosp_labs").orderBy("subject_id").collect()] == [None, "x"]
    tables["hosp.labs"].write.parquet(f"{tmp_path}/stored")
    assert io.open_table(spark, f"{tmp_path}/stored", "stored").count() == spark.table("stored").count() == 2
    assert io.read_lookup(spark, f"{tmp_path}/hosp/labs.csv", known["hosp.labs"]).count() == 2
    assert all(len(io.schema(x)) > 3 for x in [*io.EMERGENCY.values(), *io.NOTES.values()])


def test_tiers_and_missing_tables(spark):
    from vitalgrid.operators import compare

    row = {"only_left": 0, "only_right": 0, "differing_conflict": 0, "differing_null_only": 1, "identical": 999}
    assert (compare.classify(row), compare.tier(row)) == ("review", "minor")
    assert compare.tier(row | {"identical": 9}) == "major" and compare.tier(row | {"differing_null_only": 0}) is None
    df = spark.range(3)
    got = {r.tbl: r.status for r in compare.missing_or_empty(["a", "b", "c"], {"a": df, "b": df.filter("id < 0")}).collect()}
    assert got == {"a": "present", "b": "empty", "c": "missing"}


def test_natural_key_and_residual(spark):
    from pyspark.sql import functions as F

    from vitalgrid.operators import compare

    df = spark.range(2000).select((F.col("id") % 50).alias("a"), F.floor(F.col("id") / 50).alias("b"), F.lit(1).alias("c"))
    assert sorted(compare.natural_key(df, ["a"], 3)) == ["a", "b"] and compare.natural_key(df.unionByName(df), ["a"], 3) is None
    assert compare.residual_columns(df, df.withColumn("c", F.when(F.col("a") == 3, 2).otherwise(1))) == ["c"]
    assert compare.residual_columns(df, df) == [] and compare.residual_columns(df, df.limit(5)) is None


def test_auroc_over_ranges(spark):
    import random

    from vitalgrid.operators.cohort import auroc

    rng = random.Random(9)
    rows = [(int(rng.random() < 0.3), rng.choice([0.25, 0.5, rng.random(), None])) for _ in range(3000)]
    seen = [(y, x) for y, x in rows if x is not None]
    good, bad = [x for y, x in seen if y], [x for y, x in seen if not y]
    want = sum((g > b) + (g == b) / 2 for g in good for b in bad) / len(good) / len(bad)
    df = spark.createDataFrame(rows, "y int, x double")
    assert all(abs(auroc(df, "y", "x", parts).first().auroc - want) < 1e-9 for parts in (2, 200))


def test_values_at_an_anchor(spark):
    anchors = frame(spark, [(1, at(10)), (2, at(10)), (3, None)], ["id", "t0"])
    events = frame(spark, [(1, at(8), "a", 1.0), (1, at(9), "a", 2.0), (1, at(9), "a", 3.0), (1, at(11), "a", 9.0), (1, at(11), "b", 5.0), (1, at(12), "b", 6.0), (2, at(1), "a", 1.0), (2, at(9), "b", 7.0), (3, at(9), "a", 1.0)], ["id", "t", "label", "v"])
    got = cohort.last_at_anchor(anchors, events, "id", "t0", "t", "label", "v", ["a", "b"], hours(4), hours(2), "id").collect()
    assert sorted(map(tuple, got)) == [(1, 3.0, 6.0), (2, None, 7.0)]
    spans = frame(spark, [(1, at(9), at(10), 7), (1, at(10), at(12), 8), (2, at(1), None, 8), (2, at(1), at(9), 7)], ["id", "s", "e", "code"])
    flags = cohort.flag_within(anchors, spans, "id", "t0", "s", "e", {"any": F.col("code").isNotNull(), "seven": F.col("code") == 7}, "id").collect()
    assert sorted(map(tuple, flags)) == [(1, 1, 1), (2, 1, 0)]


def test_code_layout_prunes_partitions(spark, tmp_path):
    rows = [(c, i, None if i % 7 else "x") for i in range(60) for c in (5, 51, 211, 400, 615, 700, 220045, None)] + [(211, i, "hot") for i in range(500)]
    df = spark.createDataFrame(rows, "itemid int, n int, value string")
    layout = io.write_by_code(df, f"{tmp_path}/chart", "itemid", (161, 428, 615, 220000), hot=(211, 220045))
    assert [layout.number(c) for c in (5, 161, 211, 427, 428, 615, 700, 220045, 230000)] == [1, 2, 0, 2, 3, 4, 4, 0, 5]
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    chosen = layout.read(spark, f"{tmp_path}/chart", [51, 615, 211, 999])
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "code_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert same(chosen.select(df.columns), df.filter("itemid IN (51, 615, 211)")) and chosen.columns == df.columns
    numbers = {f.split("code_bucket=")[1].split("/")[0] for f in layout.read(spark, f"{tmp_path}/chart", [51, 700]).inputFiles() if "code_bucket=" in f}
    assert numbers >= {"1", "4"}
    whole = layout.read(spark, f"{tmp_path}/chart")
    assert same(whole.select(df.columns), df)
    for low, high in ((161, 428), (None, 52), (600, None), (211, 212), (161, 162)):
        got = layout.read(spark, f"{tmp_path}/chart", low=low, high=high)
        cond = " AND ".join(x for x in (f"itemid >= {low}" if low is not None else "", f"itemid < {high}" if high is not None else "") if x)
        assert same(got.select(df.columns), df.filter(cond))
    metrics = layout.read(spark, f"{tmp_path}/chart", [5])
    assert metrics.count() == 60


def test_line_episodes_of_slots(spark):
    rows = [(1, at(0), "a", 0), (1, at(10), "a", 0), (1, at(30), "a", 0), (1, at(31), "b", 0), (1, at(32), "b", 1), (1, at(33), "b", 0), (1, at(34), None, 0), (1, at(35), None, None)]
    got = episodes.slot_episodes(frame(spark, rows, ["slot", "t", "kind", "gone"]), ["slot"], "t", "kind", "gone", ["kind"], 16).orderBy("starttime").collect()
    assert [(r.kind, r.starttime, r.endtime) for r in got] == [("a", at(0), at(10)), ("a", at(30), at(30)), ("b", at(31), at(31)), ("b", at(33), at(33)), (None, at(34), at(34))]


def test_readings_meet_the_grid_in_one_merge(spark):
    """An hour's readings are summarised once; hours off the grid and unknown keys are left out, and no join is formed."""
    at = dt.datetime(2024, 1, 1, 0, 0)
    hour = lambda h, m=0: at + dt.timedelta(hours=h, minutes=m)
    stays = spark.createDataFrame([(1, hour(0), hour(5)), (2, hour(3), hour(4))], "k long, a timestamp_ntz, b timestamp_ntz")
    grid = episodes.hourly_spine(stays, "a", "b", ["k"], lead_hours=2)
    x = spark.createDataFrame([(1, hour(1, 1), 4.0), (1, hour(2), 3.0), (1, hour(40), 9.0), (None, hour(1), 1.0), (2, hour(3), 7.0)], "k long, t timestamp_ntz, x double")
    spans = spark.createDataFrame([(1, hour(-9), hour(0)), (2, hour(3, 1), hour(3, 50))], "k long, s timestamp_ntz, e timestamp_ntz")
    y = joins.covered_hours(spans, ceil_hour(F.col("s")), dt_trunc(F.col("e"), "HOUR"), "end").select("k", F.col("end").alias("endtime"), F.lit(1).alias("y"))
    summary = joins.hour_summary([x, y], "k", "t", "endtime", x=F.min("x"), y=F.max("y"))
    got = joins.grid_merge(grid, summary, "k", "endtime", ["x", "y"])
    rows = {(r.k, r.hr): (r.x, r.y) for r in got.collect()}
    assert len(rows) == got.count() == 8 + 4
    assert {k: v for k, v in rows.items() if v != (None, None)} == {(1, -2): (None, 1), (1, -1): (None, 1), (1, 0): (None, 1), (1, 2): (3.0, None), (2, 0): (7.0, None)}
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_packed_points_keep_the_largest_of_each_part(spark):
    rows = [(None, 3, 10), (4, None, 0), (1, 0, None)]
    packed = spark.createDataFrame(rows, "a int, b int, c int").select(pack_points(["a", "b", "c"], 10).alias("p"))
    parts = [unpack_points(F.col("p"), i, 10) for i in range(4)]
    assert sorted(map(tuple, packed.select(*parts).collect()), key=str) == sorted([(*r, None) for r in rows], key=str)
    assert tuple(packed.agg(F.bit_or("p").alias("p")).select(*parts).first()) == (4, 3, 10, None)


@pytest.mark.parametrize("name", ["sofa", "sepsis3", "pivoted_sofa", "pivoted_oasis"])
def test_the_hours_of_a_stay_are_not_shuffled_by_hour(spark, name):
    import re

    import __spark_entry__ as entry

    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\([^)]*\b(hr|endtime)#", plan)


def test_charted_dialysis_looks_at_a_text_once(spark):
    import __spark_entry__ as entry

    plan = entry.queries()["pivoted_rrt"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Recirculating") <= 2  # a text of the source's own expression: once in a filter, once as the value


def test_trailing_hours_equal_a_loop_over_the_grid(spark):
    at = dt.datetime(2024, 1, 1, 0, 0)
    hour = lambda h: at + dt.timedelta(hours=h)
    spans = [(1, hour(2), 60), (2, hour(0), 3), (3, hour(5), 0), (4, hour(0), 2)]
    found = [(1, -30, 64), (1, -21, 16), (1, -2, 1), (1, 2, 2), (1, 3, 4), (1, 26, 8), (1, 27, 2), (1, 62, 32), (1, 63, 64), (2, 1, 1), (2, 2, 6), (4, 9, 1), (9, 1, 1)]
    rows = spark.createDataFrame([(k, hour(h), v) for k, h, v in found], "k long, endtime timestamp_ntz, now long")
    got = joins.trailing_hours(spark.createDataFrame(spans, "k long, a timestamp_ntz, n long"), rows, "k", "a", "n", "endtime", "now", 24).collect()
    want = []
    for k, a, n in spans:
        for i in range(n + 1):
            seen = {t: v for key, h, v in found for t in [hour(h)] if key == k}
            now, day = a + dt.timedelta(hours=i), None
            for back in range(24):
                if (v := seen.get(now - dt.timedelta(hours=back))) is not None:
                    day = (day or 0) | v
            want.append((k, i, now, seen.get(now), day))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_sepsis_takes_the_first_of_equal_suspicions(spark):
    """Ties, unknown culture times, hours at both bounds, a first suspicion without an hour and a stay without any."""
    from vitalgrid.plans.firstday import ORGANS
    from vitalgrid.plans.registry import Context

    at = dt.datetime(2024, 1, 10, 0, 0)
    t = lambda h, m=0: at + dt.timedelta(hours=h, minutes=m)
    infections = [
        (1, 10, 5, t(2), t(1), 1, t(1)), (1, 10, 3, t(2), t(1), 1, t(1)), (1, 10, 4, t(2), None, 1, t(1)), (1, 10, 1, t(3), t(1), 1, t(1)), (1, 10, 9, t(0), t(0), 1, t(90)),
        (2, 20, 1, t(0), t(-200), 1, t(-200)), (2, 20, 2, t(1), t(0, 30), 1, t(0, 30)), (3, 30, 1, t(0), None, 1, t(0)), (4, None, 1, t(0), t(0), 1, t(0)), (5, 50, 1, t(0), None, 0, None), (6, 60, 1, t(0), t(0), 1, t(0)),
    ]
    totals = {10: {-47: 1, -46: 3, -45: 9}, 20: {-48: 5, -47: 4, 24: 7}, 30: {-48: 2}, 50: {0: 8}, 60: {-49: 9, 25: 9}}
    sofa = []
    for stay, by_hour in totals.items():
        for h, total in by_hour.items():
            parts = [min(4, max(0, total - 4 * i)) for i in range(6)]
            sofa.append((stay, h, t(h - 1), t(h), *parts, *parts, total))
    s = spark.createDataFrame(infections, "subject_id long, stay_id long, ab_id long, antibiotic_time timestamp_ntz, culture_time timestamp_ntz, suspected_infection int, suspected_infection_time timestamp_ntz")
    f = spark.createDataFrame(sofa, "stay_id long, hr long, starttime timestamp_ntz, endtime timestamp_ntz, " + ", ".join(f"{o} int" for o in ORGANS) + ", " + ", ".join(f"{o}_24hours int" for o in ORGANS) + ", sofa_24hours int")
    ctx = Context(spark, {"suspicion_of_infection": s, "sofa": f}.__getitem__)
    ctx.built |= {"suspicion_of_infection": s, "sofa": f}
    got = sorted(map(tuple, ctx["sepsis3"].collect()))
    organs = lambda total: tuple(min(4, max(0, total - 4 * i)) for i in range(6))
    assert got == [
        (1, 10, t(2), None, t(1), t(-46), 3, *organs(3), True), (2, 20, t(1), t(0, 30), t(0, 30), t(-47), 4, *organs(4), True), (3, 30, t(0), None, t(0), t(-48), 2, *organs(2), True),
    ]


def test_pairs_of_sepsis_are_compared_with_ready_bounds_and_not_sorted(spark):
    import re

    import __spark_entry__ as entry

    plan = entry.queries()["sepsis3"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Window(GroupLimit)? [^\n]*sofa_time", plan)
    joins_of = [line for line in plan.splitlines() if "Join " in line]
    assert any("sofa_time" in line for line in joins_of)
    assert not [line for line in joins_of if "INTERVAL" in line and re.search(r"sofa_time|\bday#", line)]


def test_nested_readings_are_wrapped_after_the_shuffle_and_not_filtered_by_element(spark):
    import __spark_entry__ as entry
    from vitalgrid.operators.resources import view

    plan = entry.queries()["nested_bg"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    partial = [line for line in plan.splitlines() if "partial_collect_list" in line]
    assert partial and not [line for line in partial if "urn:hospital" in line]
    assert "lambdafunction(true" not in plan
    spec = {"select": [{"forEachOrNull": "a", "column": [{"path": "x", "name": "x"}]}]}
    holes = spark.sql("SELECT array(named_struct('x', 1), NULL, named_struct('x', 2)) AS a UNION ALL SELECT array(CAST(NULL AS STRUCT<x: INT>))")
    assert sorted(map(tuple, view(holes, spec).collect()), key=str) == [(1,), (2,), (None,)]
