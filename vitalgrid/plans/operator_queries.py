"""One query per generic operator, over the driver's tables, with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalgrid.functions.dt import days, dt_diff, dt_trunc, hours
from vitalgrid.functions.scalar import clean, contains_any, extract, logistic, num, round_int, step_score, strict_greatest
from vitalgrid.operators import cohort, compare, episodes, joins, text
from vitalgrid.plans.adapter import TABLES, context
from vitalgrid.plans.comorbidity import prefix_flags, rules_sql
from vitalgrid.sources import io

QUERIES: dict = {}
SQL: dict[str, str] = {}


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.ctx = spark, sf_dir, context(spark, sf_dir)

    def __getattr__(self, name: str) -> DataFrame:
        return self.ctx[name]


def query(sql: str | None = None, adapted: str = ""):
    """Register a function of the tables under its name; ``adapted`` names clinical tables its SQL reads."""

    def register(f):
        name = f.__name__
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            parts = [f"{t} AS MATERIALIZED ({TABLES[t].format(events='events')})" for t in adapted.split()]
            SQL[name] = f"WITH {', '.join(parts)} SELECT * FROM ({sql}) q" if parts else sql
        return f

    return register


DEC = "CAST(round(CAST({} AS DECIMAL(38,9)), {}) AS DOUBLE)"
D = "CAST({} AS DOUBLE)"

# ---- sources and checks


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_projection(t):
    return t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT DISTINCT o_custkey FROM orders ORDER BY 1 LIMIT 50)")
def first_n_subjects(t):
    return io.first_subjects({"orders": t.orders}, t.orders, 50, "o_custkey")["orders"].select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT 'region' AS tbl, CAST(5 AS BIGINT) AS expected, count(*) AS observed, CASE WHEN count(*) = 5 THEN 'PASSED' ELSE 'FAILED' END AS status FROM region UNION ALL SELECT 'nation', 26, count(*), CASE WHEN count(*) = 26 THEN 'PASSED' ELSE 'FAILED' END FROM nation")
def row_count_validation(t):
    expected = t.spark.createDataFrame([("region", 5), ("nation", 26)], "tbl string, expected long")
    return compare.expected_row_counts(expected, {"region": t.region, "nation": t.nation})


@query("SELECT count(*) AS orphans FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')")
def orphan_check(t):
    return compare.orphans(t.lineitem, t.orders.filter("o_orderstatus <> 'P'"), "l_orderkey", "o_orderkey")


@query("SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def uniqueness(t):
    return compare.duplicates(t.lineitem, ["l_orderkey", "l_returnflag"])


@query("SELECT 'quantity' AS rule, count(*) FILTER (WHERE NOT l_quantity < 45) AS broken FROM lineitem UNION ALL SELECT 'discount', count(*) FILTER (WHERE NOT l_discount <= 0.05) FROM lineitem")
def range_assertions(t):
    return compare.violations(t.lineitem, {"quantity": F.col("l_quantity") < 45, "discount": F.col("l_discount") <= 0.05})


@query("""WITH n AS (SELECT count(*) AS rows, count(DISTINCT l_orderkey) AS a, count(DISTINCT (l_orderkey, l_linenumber)) AS b, count(DISTINCT (l_orderkey, l_returnflag)) AS c FROM lineitem)
SELECT CASE WHEN a = rows THEN 'l_orderkey' WHEN b = rows THEN 'l_linenumber,l_orderkey' WHEN c = rows THEN 'l_orderkey,l_returnflag' ELSE 'none' END AS key, rows, CASE WHEN a = rows OR b = rows OR c = rows THEN rows END AS distinct_keys FROM n""")
def natural_key(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    found = compare.natural_key(rows, ["l_orderkey"], 2)
    distinct = F.count_distinct(*found) if found else F.lit(None).cast("long")
    return rows.agg(F.lit(",".join(sorted(found)) if found else "none").alias("key"), F.count("*").alias("rows"), distinct.alias("distinct_keys"))


@query()
def table_manifest(t):
    return compare.manifest({"orders": t.orders, "customer": t.customer, "nation": t.nation}, ["o_orderkey", "c_custkey", "n_nationkey"])


def _altered(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    price = F.when(F.col("o_orderkey") % 10 == 0, F.col("o_totalprice") * 1.01).when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.col("o_totalprice"))
    status = F.when(F.col("o_orderkey") % 15 == 0, "X").otherwise(F.col("o_orderstatus"))
    return o, o.filter("o_orderkey % 11 <> 0").withColumns({"o_totalprice": price, "o_orderstatus": status})


@query("""WITH a AS (SELECT o_orderkey k, o_custkey c, o_orderstatus s, o_totalprice p FROM orders), b AS (SELECT k, c, CASE WHEN k % 15 = 0 THEN 'X' ELSE s END AS s, CASE WHEN k % 10 = 0 THEN p * 1.01 WHEN k % 7 = 0 THEN NULL ELSE p END AS p FROM a WHERE k % 11 <> 0),
j AS (SELECT b.k IS NOT NULL AS there, a.s = b.s AS es, coalesce(abs(a.p - b.p) <= greatest(1e-6, 1e-3 * greatest(abs(a.p), abs(b.p))), FALSE) AS ep, b.p IS NULL AS pn FROM a LEFT JOIN b USING (k))
SELECT count(*) FILTER (WHERE NOT there) AS only_left, CAST(0 AS BIGINT) AS only_right, count(*) FILTER (WHERE there AND es AND ep) AS identical, count(*) FILTER (WHERE there AND es AND NOT ep AND pn) AS differing_null_only,
       count(*) FILTER (WHERE there AND (NOT es OR (NOT ep AND NOT pn))) AS differing_conflict, CAST(0 AS BIGINT) AS differs_o_custkey, count(*) FILTER (WHERE there AND NOT es) AS differs_o_orderstatus, count(*) FILTER (WHERE there AND NOT ep) AS differs_o_totalprice FROM j""")
def keyed_diff(t):
    a, b = _altered(t)
    return compare.keyed_diff(a, b, ["o_orderkey"])


@query("""WITH a AS (SELECT o_custkey, o_orderstatus FROM orders), b AS (SELECT o_custkey, CASE WHEN o_orderkey % 15 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 11 <> 0)
(SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) UNION ALL (SELECT *, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))""")
def multiset_diff(t):
    a, b = _altered(t)
    return compare.multiset_diff(a.select("o_custkey", "o_orderstatus"), b.select("o_custkey", "o_orderstatus"))


@query("""WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders), b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders),
d AS ((SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT ALL SELECT * FROM a)),
k AS (SELECT 'o_orderkey' AS dropped, 1 AS n, count(*) AS rest FROM ((SELECT o_custkey, o_orderstatus FROM a EXCEPT ALL SELECT o_custkey, o_orderstatus FROM b) UNION ALL (SELECT o_custkey, o_orderstatus FROM b EXCEPT ALL SELECT o_custkey, o_orderstatus FROM a)) x
 UNION ALL SELECT 'o_custkey', 2, count(*) FROM ((SELECT o_orderkey, o_orderstatus FROM a EXCEPT ALL SELECT o_orderkey, o_orderstatus FROM b) UNION ALL (SELECT o_orderkey, o_orderstatus FROM b EXCEPT ALL SELECT o_orderkey, o_orderstatus FROM a)) x
 UNION ALL SELECT 'o_orderstatus', 3, count(*) FROM ((SELECT o_orderkey, o_custkey FROM a EXCEPT ALL SELECT o_orderkey, o_custkey FROM b) UNION ALL (SELECT o_orderkey, o_custkey FROM b EXCEPT ALL SELECT o_orderkey, o_custkey FROM a)) x)
SELECT CASE WHEN (SELECT count(*) FROM d) = 0 THEN '' ELSE (SELECT min_by(dropped, n) FROM k WHERE rest = 0) END AS dropped, (SELECT count(*) FROM d) AS differing_rows""")
def residual_pairing(t):
    a = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    b = a.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 3 == 0, "X").otherwise(F.col("o_orderstatus")))
    found = compare.residual_columns(a, b)
    return compare.multiset_diff(a, b).agg(F.lit(",".join(found or [])).alias("dropped"), F.count("*").alias("differing_rows"))


_DIFF_SQL = """WITH a AS (SELECT o_orderkey k, o_custkey c, o_orderstatus s, o_totalprice p FROM orders), b AS (SELECT k, c, CASE WHEN k % 15 = 0 THEN 'X' ELSE s END AS s, CASE WHEN k % 10 = 0 THEN p * 1.01 WHEN k % 7 = 0 THEN NULL ELSE p END AS p FROM a WHERE k % 11 <> 0),
j AS (SELECT a.k, b.k IS NOT NULL AS there, a.s = b.s AS es, coalesce(abs(a.p - b.p) <= greatest(1e-6, 1e-3 * greatest(abs(a.p), abs(b.p))), FALSE) AS ep, b.p IS NULL AS pn FROM a LEFT JOIN b USING (k)),
m AS (SELECT k, CASE WHEN NOT there THEN 'only_left' WHEN es AND ep THEN NULL WHEN es AND pn THEN 'null_only' ELSE 'conflict' END AS difference FROM j)"""


@query(f"{_DIFF_SQL} SELECT k AS o_orderkey, difference FROM (SELECT *, row_number() OVER (PARTITION BY difference ORDER BY k) AS n FROM m WHERE difference IS NOT NULL) x WHERE n <= 5")
def diff_samples(t):
    a, b = _altered(t)
    return compare.diff_samples(a, b, ["o_orderkey"], 5)


@query(f"""{_DIFF_SQL}, n AS (SELECT count(*) FILTER (WHERE difference IS NULL) AS same, count(*) FILTER (WHERE difference IN ('only_left', 'conflict')) AS hard, count(*) FILTER (WHERE difference = 'null_only') AS soft, count(*) AS total FROM m)
SELECT CASE WHEN hard > 0 THEN 'mismatch' WHEN soft > 0 THEN 'review' ELSE 'match' END AS verdict, CASE WHEN hard + soft = 0 THEN NULL WHEN (hard + soft) / total <= 0.001 THEN 'minor' WHEN (hard + soft) / total <= 0.01 THEN 'moderate' ELSE 'major' END AS tier, same AS identical FROM n""")
def divergence_classes(t):
    a, b = _altered(t)
    one = compare.keyed_diff(a, b, ["o_orderkey"])
    row = one.first().asDict()
    return one.select(F.lit(compare.classify(row)).alias("verdict"), F.lit(compare.tier(row)).cast("string").alias("tier"), "identical")


@query("SELECT o_custkey, p, 'left' AS side FROM (SELECT o_custkey, round(o_totalprice, 2) AS p FROM orders EXCEPT ALL SELECT o_custkey, round(o_totalprice + CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0.000000001 END, 2) FROM orders) x UNION ALL SELECT o_custkey, p, 'right' FROM (SELECT o_custkey, round(o_totalprice + CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0.000000001 END, 2) AS p FROM orders EXCEPT ALL SELECT o_custkey, round(o_totalprice, 2) FROM orders) x")
def two_variant_probe(t):
    price = F.col("o_totalprice").cast("double")
    moved = price + F.when(F.col("o_orderkey") % 9 == 0, 1.0).otherwise(1e-9)
    return compare.rounded_diff(t.orders.select("o_custkey", price.alias("p")), t.orders.select("o_custkey", moved.alias("p")), 2)


@query("SELECT 'orders' AS tbl, CASE WHEN count(*) = 0 THEN 'empty' ELSE 'present' END AS status FROM orders UNION ALL SELECT 'customer', CASE WHEN count(*) = 0 THEN 'empty' ELSE 'present' END FROM customer WHERE c_custkey < -1 UNION ALL SELECT 'returns', 'missing'")
def missing_or_empty(t):
    return compare.missing_or_empty(["orders", "customer", "returns"], {"orders": t.orders, "customer": t.customer.filter("c_custkey < -1")})


@query("""WITH s AS (SELECT event_id, TIMESTAMP '2024-03-10 00:00:00' + (ts - date_trunc('day', ts)) AS a FROM events), m AS (SELECT a, a + (CASE WHEN event_id % 3 = 0 THEN INTERVAL '1' HOUR WHEN event_id % 3 = 1 THEN INTERVAL '30' MINUTE ELSE INTERVAL '0' HOUR END) AS b FROM s)
SELECT count(*) FILTER (WHERE a <> b) AS conflicts, count(*) FILTER (WHERE extract(hour FROM a) = 2 AND b - a = INTERVAL '1' HOUR) AS explained FROM m""")
def wall_clock_shift(t):
    """Conflicts that a zone's missing hour explains: events at their hours on the day its clocks go forward, some an hour off."""
    at = F.lit("2024-03-10").cast("timestamp_ntz") + (F.col("ts").cast("timestamp_ntz") - F.date_trunc("day", "ts").cast("timestamp_ntz"))
    a = t.events.select("event_id", at.alias("a"))
    b = F.when(F.col("event_id") % 3 == 0, F.col("a") + hours(1)).when(F.col("event_id") % 3 == 1, F.col("a") + F.expr("INTERVAL '30' MINUTE")).otherwise(F.col("a"))
    rows = a.select("a", b.alias("b"))
    return rows.agg(F.count_if(F.col("a") != F.col("b")).alias("conflicts"), F.count_if(compare.zone_shift_explains(F.col("a"), F.col("b"), "America/New_York")).alias("explained"))


@query()
def content_hash(t):
    return compare.content_hash(t.orders)


@query("SELECT 'o_orderstatus' AS \"column\", count(CASE WHEN o_orderkey < 0 THEN o_orderstatus END) AS present FROM orders")
def declared_null_check(t):
    emptied = t.orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") < 0, F.col("o_orderstatus")))
    return compare.all_null(emptied, ["o_orderstatus"])


# ---- projections and predicates


@query("SELECT event_id, CASE WHEN value > 10 AND value < 400 THEN value END AS v, CASE WHEN value >= 100 AND value <= 300 THEN (value - 32) / 1.8 END AS c FROM events WHERE event_type IN ('view', 'purchase')")
def code_filter_clamp(t):
    v = F.col("value")
    kept = t.events.filter(F.col("event_type").isin("view", "purchase"))
    return kept.select("event_id", clean(v, 10, 400).alias("v"), F.when((v >= 100) & (v <= 300), (v - 32) / 1.8).alias("c"))


@query("SELECT p_partkey, CASE WHEN p_size > 40 THEN p_size / 100.0 WHEN p_size BETWEEN 20 AND 40 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS f FROM part".replace("p_size / 100.0", "p_size / CAST(100 AS DOUBLE)"))
def unit_normalise(t):
    s = F.col("p_size")
    return t.part.select("p_partkey", F.when(s > 40, s / 100).when(s.between(20, 40), None).otherwise(s.cast("double")).alias("f"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem JOIN part ON p_partkey = l_partkey WHERE (lower(p_type) LIKE '%steel%' OR lower(p_type) LIKE '%tin%') AND lower(p_type) NOT LIKE '%small%'")
def text_dictionary_flag(t):
    kind = F.col("p_type")
    named = t.part.select("p_type").distinct().filter(contains_any(kind, ["steel", "tin"]) & ~contains_any(kind, ["small"]))
    parts = t.part.join(named, "p_type", "left_semi").select(F.col("p_partkey").alias("l_partkey"))
    return t.lineitem.join(parts, "l_partkey").select("l_orderkey", "l_linenumber")


RULES = {"cardiac": {9: "410 428 42822-42833", 10: "I21 I50"}, "tumour": {9: "140-172 196", 10: "C00-C26 C77"}}


@query(f"SELECT hadm_id, {rules_sql(RULES)} FROM diagnoses_icd GROUP BY hadm_id HAVING cardiac + tumour > 0", "diagnoses_icd")
def prefix_rules(t):
    return prefix_flags(t.diagnoses_icd, "hadm_id", RULES).filter("cardiac + tumour > 0")


@query("SELECT event_id, CASE WHEN value IS NULL THEN NULL WHEN value >= 400 THEN 4 WHEN value >= 200 THEN 2 WHEN value >= 50 THEN 1 ELSE 0 END AS points FROM events")
def step_scores(t):
    v = F.col("value")
    return t.events.select("event_id", step_score([(v >= 400, 4), (v >= 200, 2), (v >= 50, 1)], 0, v.isNull()).alias("points"))


@query("SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'other') AS segment, c_acctbal >= 0 AND c_nationkey < 10 AS flag FROM customer")
def null_defaults(t):
    return t.customer.select("c_custkey", F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("other")).alias("segment"), ((F.col("c_acctbal") >= 0) & (F.col("c_nationkey") < 10)).alias("flag"))


@query("SELECT event_id, CASE WHEN regexp_matches(s, '^[0-9]+$') THEN CAST(s AS DOUBLE) END AS n FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'x' || event_id ELSE CAST(event_id AS VARCHAR) END AS s FROM events) e".replace("CASE WHEN regexp_matches(s, '^[0-9]+$') THEN CAST(s AS DOUBLE) END", "TRY_CAST(s AS DOUBLE)"))
def numeric_text_guard(t):
    s = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("x"), F.col("event_id"))).otherwise(F.col("event_id").cast("string"))
    return t.events.select("event_id", s.alias("s")).select("event_id", F.when(F.col("s").rlike("^[0-9]+$"), F.col("s").try_cast("double")).alias("n"))


# ---- joins


def _spans(t):
    return t.procedureevents.select("stay_id", "starttime", "endtime", "itemid")


def _interval(closed: str, low: str, high: str) -> None:
    name = f"interval_join_{closed}"

    def f(t):
        points = t.outputevents.select("stay_id", "charttime", "value")
        return joins.interval_join(points, _spans(t), ["stay_id"], "charttime", "starttime", "endtime", closed=closed)

    f.__name__ = name
    query(f"SELECT o.stay_id, o.charttime, o.value, p.starttime, p.endtime, p.itemid FROM outputevents o JOIN procedureevents p ON p.stay_id = o.stay_id AND o.charttime {low} p.starttime AND o.charttime {high} p.endtime", "outputevents procedureevents")(f)


_interval("left", ">=", "<")
_interval("right", ">", "<=")
_interval("both", ">=", "<=")


@query("SELECT i.stay_id, i.intime, o.charttime, o.value FROM icustays i LEFT JOIN outputevents o ON o.stay_id = i.stay_id AND o.charttime BETWEEN i.intime - INTERVAL '6' HOUR AND i.intime + INTERVAL '1' DAY", "icustays outputevents")
def anchored_join(t):
    return joins.anchored_join(t.icustays.select("stay_id", "intime"), t.outputevents.select("stay_id", "charttime", "value"), ["stay_id"], "intime", "charttime", hours(6), days(1))


@query("SELECT p.stay_id, p.starttime AS s, p.endtime AS e, i.itemid FROM procedureevents p LEFT JOIN inputevents i ON i.stay_id = p.stay_id AND p.starttime >= i.starttime AND p.endtime <= i.endtime", "procedureevents inputevents")
def interval_containment(t):
    inner = t.procedureevents.select("stay_id", F.col("starttime").alias("s"), F.col("endtime").alias("e"))
    return joins.containment_join(inner, t.inputevents.select("stay_id", "starttime", "endtime", "itemid"), ["stay_id"], ("s", "e"), ("starttime", "endtime")).select("stay_id", "s", "e", "itemid")


@query("SELECT p.stay_id, p.starttime AS s, p.endtime AS e, i.starttime, i.endtime FROM procedureevents p JOIN inputevents i ON i.stay_id = p.stay_id AND p.starttime <= i.endtime AND p.endtime >= i.starttime", "procedureevents inputevents")
def interval_overlap(t):
    a = t.procedureevents.select("stay_id", F.col("starttime").alias("s"), F.col("endtime").alias("e"))
    return joins.overlap_join(a, t.inputevents.select("stay_id", "starttime", "endtime"), ["stay_id"], ("s", "e"), ("starttime", "endtime"))


@query("""WITH g AS (SELECT stay_id, unnest(range(date_trunc('hour', intime), outtime + INTERVAL '1' HOUR, INTERVAL '1' HOUR)) AS hour_end FROM icustays)
SELECT g.stay_id, g.hour_end, sum(o.value) AS total FROM g JOIN outputevents o ON o.stay_id = g.stay_id AND o.charttime > g.hour_end - INTERVAL '1' HOUR AND o.charttime <= g.hour_end GROUP BY ALL""", "icustays outputevents")
def hour_grid_join(t):
    grid = t.icustays.select("stay_id", F.explode(F.sequence(dt_trunc(F.col("intime"), "HOUR"), F.col("outtime") + hours(1), F.expr("INTERVAL '1' HOUR"))).alias("hour_end"))
    return joins.hour_grid_join(grid, t.outputevents.select("stay_id", "charttime", "value"), ["stay_id"], "hour_end", "charttime", how="inner").groupBy("stay_id", "hour_end").agg(F.sum("value").alias("total"))


@query("""SELECT p.event_id, p.user_id, p.ts, (SELECT max_by(v.value, v.ts) FROM events v WHERE v.event_type = 'view' AND v.user_id = p.user_id AND v.ts <= p.ts AND v.ts >= p.ts - INTERVAL '12' HOUR) AS last_view
FROM events p WHERE p.event_type = 'purchase'""")
def asof_latest_before(t):
    left = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = t.events.filter("event_type = 'view'").select("user_id", F.col("ts").alias("seen"), F.col("value").alias("last_view"))
    return joins.asof_join(left, right, ["user_id"], "ts", "seen", ["last_view"], 12)


@query("""SELECT p.event_id, min(v.ts) FILTER (WHERE v.ts > p.ts AND v.ts <= p.ts + INTERVAL '24' HOUR) AS first_after, max(v.ts) FILTER (WHERE v.ts < p.ts AND v.ts >= p.ts - INTERVAL '72' HOUR) AS last_before
FROM events p LEFT JOIN events v ON v.user_id = p.user_id AND v.event_type = 'click' WHERE p.event_type = 'purchase' GROUP BY ALL""")
def first_after_last_before(t):
    p = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    v = t.events.filter("event_type = 'click'").select("user_id", F.col("ts").alias("at"))
    j = joins.anchored_join(p, v, ["user_id"], "ts", "at", hours(72), hours(24))
    return j.groupBy("event_id").agg(F.min(F.when(F.col("at") > F.col("ts"), F.col("at"))).alias("first_after"), F.max(F.when(F.col("at") < F.col("ts"), F.col("at"))).alias("last_before"))


@query("SELECT event_id, CASE WHEN lag(ts) OVER w > ts - INTERVAL '6' HOUR THEN lag(value) OVER w END AS prev_value FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)")
def prev_row_tolerance(t):
    return joins.previous_within(t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], "ts", ["value"], hours(6)).select("event_id", "prev_value")


@query("SELECT a.event_id, count(*) AS n, max(b.value) AS top FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts - INTERVAL '23' HOUR AND a.ts GROUP BY 1")
def trailing_self_join(t):
    w = episodes.trailing_window(["user_id"], "ts", 23 * 3600)
    return t.events.select("event_id", F.count("*").over(w).alias("n"), F.max("value").over(w).alias("top"))


@query("SELECT p.stay_id, p.starttime, p.endtime, p.itemid FROM procedureevents p WHERE NOT EXISTS (SELECT 1 FROM procedureevents q WHERE q.stay_id = p.stay_id AND q.starttime < p.starttime AND q.endtime > p.endtime)", "procedureevents")
def anti_theta(t):
    """Intervals not inside an earlier one: the running maximum of ends decides, no theta join is needed."""
    rows = t.procedureevents.select("stay_id", "starttime", "endtime", "itemid").withColumn("at", F.unix_micros(F.col("starttime").cast("timestamp")))
    reach = F.max("endtime").over(Window.partitionBy("stay_id").orderBy("at").rangeBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("reach", reach).filter("reach IS NULL OR reach <= endtime").select("stay_id", "starttime", "endtime", "itemid")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def anti_not_in(t):
    return joins.anti_join(t.customer.select("c_custkey", "c_name"), t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000) THEN 1 ELSE 0 END AS big FROM customer")
def semi_flag(t):
    keys = t.orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.flag_join(t.customer.select("c_custkey"), keys, ["c_custkey"], "big")


@query("WITH a AS (SELECT o_custkey k, max(o_totalprice) v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey k, max(o_totalprice) v FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) SELECT coalesce(a.k, b.k) AS k, coalesce(a.v, b.v) AS v FROM a FULL JOIN b ON a.k = b.k")
def full_outer_merge(t):
    top = lambda s: t.orders.filter(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_totalprice").alias("v"))
    return joins.full_outer_merge(top("F"), top("O"), ["k"], "v")


@query("SELECT DISTINCT a.user_id FROM events a JOIN events b ON a.user_id = b.user_id WHERE a.event_type = 'error' AND b.event_type = 'signup'")
def cooccurrence(t):
    return joins.cooccurrence(t.events, "user_id", "event_type", "error", "signup")


@query("SELECT n_name, r_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def inner_dimension_join(t):
    counted = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"))
    return counted.join(t.nation, "n_nationkey").join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name", "customers")


@query("SELECT user_id, unnest(range(0, 3)) AS k FROM (SELECT DISTINCT user_id FROM events) u")
def cross_unnest(t):
    return t.events.select("user_id").distinct().select("user_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))).alias("k"))


# ---- aggregates


@query("SELECT user_id, max(CASE WHEN event_type = 'view' THEN value END) AS view_max, max(CASE WHEN event_type = 'click' THEN value END) AS click_max FROM events GROUP BY 1")
def pivot_max(t):
    return t.events.groupBy("user_id").agg(*[F.max(F.when(F.col("event_type") == e, F.col("value"))).alias(f"{e}_max") for e in ("view", "click")])


@query("SELECT l_returnflag, min(l_quantity) AS q_min, max(l_quantity) AS q_max, min(l_extendedprice) AS p_min, max(l_extendedprice) AS p_max FROM lineitem GROUP BY 1")
def minmax_summary(t):
    from vitalgrid.operators.pivot import summary

    return summary(t.lineitem, ["l_returnflag"], {"l_quantity": "q", "l_extendedprice": "p"})


@query("SELECT l_orderkey, sum(DISTINCT l_quantity) AS q, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1")
def sum_distinct(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.sum_distinct("l_quantity").alias("q"), F.count_distinct("l_suppkey").alias("suppliers"))


@query("SELECT user_id, string_agg(DISTINCT event_type, '; ' ORDER BY event_type) AS kinds FROM events GROUP BY 1")
def listagg_distinct(t):
    return t.events.groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), "; ").alias("kinds"))


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING min(o_orderdate) <> max(o_orderdate)")
def having_filter(t):
    g = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return g.filter("a <> b").select("o_custkey", "n")


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1")
def distinct_on(t):
    first = t.orders.groupBy("o_custkey").agg(F.min(F.struct("o_orderdate", "o_orderkey")).alias("s"))
    return first.select("o_custkey", "s.o_orderkey", "s.o_orderdate")


@query("SELECT CASE WHEN value < 0 THEN 0 WHEN value >= 300 THEN 31 ELSE CAST(floor(value / 10) AS BIGINT) + 1 END AS bucket, count(*) AS freq FROM events WHERE value IS NOT NULL GROUP BY 1")
def histogram_width_bucket(t):
    return cohort.histogram(t.events, "value", 0, 300, 30)


@query("SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'O') AS \"O\", count(*) FILTER (WHERE l_linestatus = 'F') AS \"F\" FROM lineitem GROUP BY 1")
def crosstab_count(t):
    return t.lineitem.groupBy("l_returnflag").pivot("l_linestatus", ["O", "F"]).count().na.fill(0)


@query("SELECT o_custkey, max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS any_p FROM orders GROUP BY 1")
def existence_flag(t):
    return t.orders.groupBy("o_custkey").agg(F.max(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("any_p"))


# ---- windows


@query("SELECT event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS n FROM events) WHERE n = 1")
def rownum_dedupe(t):
    return t.events.groupBy("user_id", "event_type").agg(F.min_by("event_id", F.struct((-F.unix_micros(F.col("ts").cast("timestamp"))).alias("a"), F.col("event_id").alias("b"))).alias("event_id")).select("event_id")


@query("SELECT o_orderkey, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS seq, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS r FROM orders")
def dense_rank_seq(t):
    by = Window.partitionBy("o_custkey")
    return t.orders.select("o_orderkey", F.dense_rank().over(by.orderBy("o_orderdate")).cast("long").alias("seq"), F.rank().over(by.orderBy("o_orderpriority")).cast("long").alias("r"))


@query("SELECT event_id, lag(event_type) OVER w AS before, lead(event_type) OVER w AS after FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)")
def lag_lead(t):
    w = Window.partitionBy("user_id").orderBy("ts")
    return t.events.select("event_id", F.lag("event_type").over(w).alias("before"), F.lead("event_type").over(w).alias("after"))


@query("SELECT event_id, first_value(value) OVER (PARTITION BY user_id ORDER BY ts) AS first_value FROM events")
def first_value(t):
    return t.events.select("event_id", F.first("value").over(Window.partitionBy("user_id").orderBy("ts")).alias("first_value"))


@query("SELECT l_orderkey, l_linenumber, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC) AS left_to_ship FROM lineitem")
def running_sum_desc(t):
    w = Window.partitionBy("l_orderkey").orderBy(F.desc("l_linenumber"))
    return t.lineitem.select("l_orderkey", "l_linenumber", F.sum("l_quantity").over(w).alias("left_to_ship"))


@query("SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 21600000000 PRECEDING AND CURRENT ROW) AS n6 FROM events")
def range_seconds_count(t):
    return t.events.select("event_id", F.count("*").over(episodes.trailing_window(["user_id"], "ts", 21600)).alias("n6"))


@query("SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS worst FROM events")
def rows_23_max(t):
    return t.events.select("event_id", F.max("value").over(Window.partitionBy("user_id").orderBy("ts").rowsBetween(-23, 0)).alias("worst"))


@query("SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 21600000000 PRECEDING AND CURRENT ROW) AS smoothed FROM events")
def range_max_smooth(t):
    return t.events.select("event_id", F.max("value").over(episodes.trailing_window(["user_id"], "ts", 21600)).alias("smoothed"))


@query("""WITH s AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_quantity AS x FROM lineitem), g AS (SELECT x, sum(y) AS p, sum(1 - y) AS n FROM s GROUP BY 1),
r AS (SELECT *, coalesce(sum(n) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM g) SELECT CAST(sum(p * (b + n / 2)) AS DOUBLE) / CAST(sum(p) * sum(n) AS DOUBLE) AS auroc FROM r""")
def auroc(t):
    return cohort.auroc(t.lineitem.select(F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"), F.col("l_quantity").alias("x")), "y", "x")


# ---- episodes


@query("""WITH s AS (SELECT user_id, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1), g AS (SELECT user_id, CASE WHEN date_trunc('hour', a) = a THEN a ELSE date_trunc('hour', a) + INTERVAL '1' HOUR END AS c, unnest(range(-24, date_diff('hour', a, b) + 1)) AS hr FROM s)
SELECT user_id, hr, c + hr * INTERVAL '1' HOUR AS endtime FROM g""")
def hourly_spine(t):
    s = t.events.groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return episodes.hourly_spine(s, "a", "b", ["user_id"])


@query("""WITH s AS (SELECT user_id, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1), g AS (SELECT *, unnest(range(0, date_diff('day', a, b) + 1)) AS day FROM s)
SELECT user_id, day, date_diff('day', a, b) - day AS days_left, greatest(CAST(CAST(a AS DATE) AS TIMESTAMP) + day * INTERVAL '1' DAY, a) AS day_start, least(CAST(CAST(a AS DATE) AS TIMESTAMP) + (day + 1) * INTERVAL '1' DAY, b) AS day_end FROM g""")
def day_spine(t):
    s = t.events.groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return episodes.day_spine(s, "a", "b", ["user_id"])


@query("""WITH a AS (SELECT user_id, ts, event_type, lag(ts) OVER w AS p, lead(ts) OVER w AS x, lag(event_type) OVER w AS q FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
b AS (SELECT *, sum(CASE WHEN p IS NULL OR date_diff('hour', p, ts) >= 14 OR q <> event_type THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS episode FROM a)
SELECT user_id, episode, min(ts) AS starttime, max(CASE WHEN x IS NULL OR date_diff('hour', ts, x) >= 14 THEN ts ELSE x END) AS endtime, max(event_type) AS event_type FROM b GROUP BY 1, 2""")
def sessionize_gap_state(t):
    return episodes.sessionize(t.events.select("user_id", "ts", "event_type"), ["user_id"], "ts", gap_hours=14, state="event_type")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM events")
def forward_fill(t):
    rows = t.events.select("event_id", "user_id", "ts", F.when(F.col("event_type") == "view", F.col("value")).alias("v"))
    return episodes.forward_fill(rows, ["user_id"], ["ts"], "v", "carried").select("event_id", "carried")


@query("""WITH r AS (SELECT user_id, ts, CASE WHEN event_id % 5 = 0 THEN 0 WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 11 END AS rate, CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END AS stopped FROM events),
a AS (SELECT *, last_value(rate IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM r), b AS (SELECT *, CASE WHEN coalesce(f, 0) > 0 AND stopped = 0 THEN 1 ELSE 0 END AS o FROM a),
c AS (SELECT *, coalesce(lag(o) OVER (PARTITION BY user_id ORDER BY ts), 0) AS w FROM b), d AS (SELECT *, sum(CASE WHEN o = 1 AND w = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS episode FROM c)
SELECT user_id, episode, min(ts) AS starttime, max(ts) AS endtime, CAST(max(f) AS DOUBLE) AS max_rate FROM d WHERE o = 1 OR w = 1 GROUP BY 1, 2""")
def infusion_state_machine(t):
    i = F.col("event_id")
    rate = F.when(i % 5 == 0, 0).when(i % 7 == 0, None).otherwise(i % 11).cast("double")
    rows = t.events.select("user_id", "ts", rate.alias("rate"), F.when(i % 13 == 0, 1).otherwise(0).alias("stopped"))
    return episodes.infusion_episodes(rows, ["user_id"], "ts", "rate", "stopped")


@query("""WITH a AS (SELECT stay_id, starttime, endtime, max(endtime) OVER (PARTITION BY stay_id ORDER BY starttime, endtime ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM procedureevents),
b AS (SELECT *, sum(CASE WHEN r >= starttime THEN 0 ELSE 1 END) OVER (PARTITION BY stay_id ORDER BY starttime, endtime ROWS UNBOUNDED PRECEDING) AS i FROM a) SELECT stay_id, min(starttime) AS starttime, max(endtime) AS endtime FROM b GROUP BY stay_id, i""", "procedureevents")
def merge_overlaps(t):
    return episodes.merge_overlaps(t.procedureevents.select("stay_id", "starttime", "endtime"), ["stay_id"], "starttime", "endtime")


@query("""WITH s AS (SELECT user_id, ts AS a, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS b, event_id % 2 AS rate, CAST(event_id % 10 AS DOUBLE) AS amount FROM events), x AS (SELECT * FROM s WHERE b IS NOT NULL),
y AS (SELECT *, sum(CASE WHEN lag_b = a AND lag_r = rate THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY a ROWS UNBOUNDED PRECEDING) AS n FROM (SELECT *, lag(b) OVER w AS lag_b, lag(rate) OVER w AS lag_r FROM x WINDOW w AS (PARTITION BY user_id ORDER BY a)))
SELECT user_id, min(a) AS a, max(b) AS b, max(rate) AS rate, sum(amount) AS amount FROM y GROUP BY user_id, n""")
def merge_adjacent_equal(t):
    w = Window.partitionBy("user_id").orderBy("ts")
    s = t.events.select("user_id", F.col("ts").alias("a"), F.lead("ts").over(w).alias("b"), (F.col("event_id") % 2).alias("rate"), (F.col("event_id") % 10).cast("double").alias("amount"))
    return episodes.merge_adjacent_equal(s.filter("b IS NOT NULL"), ["user_id"], "a", "b", "rate", "amount")


@query("""WITH c AS (SELECT stay_id, starttime FROM inputevents UNION SELECT stay_id, endtime FROM inputevents UNION SELECT stay_id, starttime FROM procedureevents UNION SELECT stay_id, endtime FROM procedureevents),
s AS (SELECT *, lead(starttime) OVER (PARTITION BY stay_id ORDER BY starttime) AS endtime FROM c) SELECT * FROM s WHERE endtime IS NOT NULL""", "inputevents procedureevents")
def elementary_segments(t):
    return episodes.elementary_segments([t.inputevents, t.procedureevents], "stay_id")


@query("SELECT stay_id, charttime AS starttime, coalesce(lead(charttime) OVER (PARTITION BY stay_id ORDER BY charttime, value), charttime + INTERVAL '2' HOUR) AS endtime, value FROM outputevents", "outputevents")
def step_function(t):
    w = Window.partitionBy("stay_id").orderBy("charttime", "value")
    return t.outputevents.select("stay_id", F.col("charttime").alias("starttime"), F.coalesce(F.lead("charttime").over(w), F.col("charttime") + hours(2)).alias("endtime"), "value")


@query("""WITH n AS (SELECT *, lag(outtime) OVER w AS po, lead(intime) OVER w AS ni FROM icustays WINDOW w AS (PARTITION BY subject_id ORDER BY intime, stay_id))
SELECT subject_id, stay_id, intime, outtime, CASE WHEN po > intime - INTERVAL '24' HOUR THEN intime - CAST(round(date_diff('second', po, intime) / 2) AS BIGINT) * INTERVAL '1' SECOND ELSE intime - INTERVAL '12' HOUR END AS data_start,
       CASE WHEN ni < outtime + INTERVAL '24' HOUR THEN outtime + CAST(round(date_diff('second', outtime, ni) / 2) AS BIGINT) * INTERVAL '1' SECOND ELSE outtime + INTERVAL '12' HOUR END AS data_end FROM n""", "icustays")
def midpoint_ownership(t):
    return episodes.ownership_windows(t.icustays, "subject_id", "stay_id", "intime", "outtime")


@query("SELECT stay_id, linkorderid, min(starttime) AS starttime, max(endtime) AS endtime FROM inputevents GROUP BY 1, 2", "inputevents")
def order_consolidation(t):
    return episodes.consolidate_orders(t.inputevents, ["stay_id"], "linkorderid", "starttime", "endtime")


@query("SELECT event_id, CASE WHEN value < lag(value) OVER w OR lag(value) OVER w IS NULL THEN value ELSE value - lag(value) OVER w END AS step FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)")
def cumulative_to_increment(t):
    return episodes.to_increments(t.events, ["user_id"], "ts", "value", "step").select("event_id", "step")


@query("SELECT event_id, coalesce(date_diff('minute', lag(ts) OVER (PARTITION BY user_id ORDER BY ts), ts), 60) AS mins FROM events")
def time_since_previous(t):
    return episodes.since_previous(t.events, ["user_id"], "ts", "MINUTE", "mins", F.lit(60)).select("event_id", "mins")


@query("SELECT stay_id, sum(value) / 64 / nullif(date_diff('hour', min(charttime), max(charttime)), 0) AS rate FROM outputevents GROUP BY 1", "outputevents")
def rate_per_weight(t):
    span = dt_diff(F.max("charttime"), F.min("charttime"), "HOUR")
    return t.outputevents.groupBy("stay_id").agg(F.try_divide(F.sum("value") / 64, span).alias("rate"))


# ---- set operations, functions


@query("SELECT o_custkey AS k FROM orders UNION ALL SELECT c_custkey FROM customer")
def union_all(t):
    return t.orders.select(F.col("o_custkey").alias("k")).unionByName(t.customer.select(F.col("c_custkey").alias("k")))


@query("SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer")
def union_distinct(t):
    return union_all(t).distinct()


@query("SELECT l_suppkey AS k FROM lineitem EXCEPT ALL SELECT o_custkey FROM orders")
def except_all(t):
    return t.lineitem.select(F.col("l_suppkey").alias("k")).exceptAll(t.orders.select(F.col("o_custkey").alias("k")))


@query("SELECT l_suppkey AS k FROM lineitem INTERSECT SELECT c_custkey FROM customer")
def intersect_keys(t):
    return t.lineitem.select(F.col("l_suppkey").alias("k")).intersect(t.customer.select(F.col("c_custkey").alias("k")))


def _diff(unit: str) -> None:
    def f(t):
        w = Window.partitionBy("user_id").orderBy("ts")
        rows = t.events.select("event_id", "ts", F.lead("ts").over(w).alias("b")).filter("b IS NOT NULL")
        return rows.select("event_id", dt_diff(F.col("b"), F.col("ts"), unit).alias("n"))

    f.__name__ = f"dt_diff_{unit.lower()}"
    query(f"SELECT event_id, date_diff('{unit.lower()}', ts, b) AS n FROM (SELECT event_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS b FROM events) WHERE b IS NOT NULL")(f)


for _unit in ("SECOND", "MINUTE", "HOUR", "DAY", "MONTH", "YEAR"):
    _diff(_unit)


@query("SELECT event_id, date_trunc('hour', ts) AS h, date_trunc('day', ts) AS d, ts + INTERVAL '3' HOUR AS plus FROM events")
def dt_trunc_add(t):
    return t.events.select("event_id", dt_trunc(F.col("ts"), "HOUR").alias("h"), dt_trunc(F.col("ts"), "DAY").alias("d"), (F.col("ts") + hours(3)).alias("plus"))


@query("SELECT event_id, regexp_extract(props, '\"([a-z]+)\"', 1) AS field, nullif(regexp_extract(props, 'zz([0-9]+)', 1), '') AS missing FROM events")
def regexp_fields(t):
    return t.events.select("event_id", extract(F.col("props"), '"([a-z]+)"').alias("field"), extract(F.col("props"), "zz([0-9]+)").alias("missing"))


@query(f"SELECT event_id, round(1 / (1 + exp(-({D.format(-3)} + value / 100))), 9) AS p, {DEC.format('value / 3', 4)} AS r, CAST(round(value) AS BIGINT) AS i FROM events")
def logistic_prob(t):
    v = F.col("value")
    return t.events.select("event_id", F.round(logistic(-3 + v / 100), 9).alias("p"), num(v / 3, 4).alias("r"), round_int(v).alias("i"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 40 THEN NULL ELSE greatest(l_quantity, 10) END AS g FROM lineitem")
def strict_extremes(t):
    q = F.when(F.col("l_quantity") <= 40, F.col("l_quantity"))
    return t.lineitem.select("l_orderkey", "l_linenumber", strict_greatest(q, F.lit(10).cast(t.lineitem.schema["l_quantity"].dataType)).alias("g"))


# ---- text, cohort, nested


#: Reports from whole texts, in the forms that radiology notes have: no header, one header and paragraphs, findings with or without text, odd headers.
_NOTE = """CASE doc_id % 6 WHEN 0 THEN coalesce(text, '') WHEN 1 THEN chr(10) || ' COMPARISON: ' || lang || '. ' || replace(text, chr(10), chr(10) || ' ' || chr(10))
  WHEN 2 THEN 'Report ' || lang || chr(10) || ' EXAMINATION:  CHEST' || chr(10) || chr(10) || ' FINDINGS: ' || text || chr(10) || ' IMPRESSION: ' || source
  WHEN 3 THEN chr(10) || ' CHEST, PA LATERAL:' || chr(10) || chr(10) || ' FINDINGS AND IMPRESSIONS:  ' || text || chr(10) || ' IMPRESSON: ' || chr(10) || ' TECHNIQUE: ' || lang
  WHEN 4 THEN chr(10) || ' INDICATION: ' || text || chr(10) || ' ' || chr(10) || ' second ' || source || chr(10) || ' WET READ (OLD): x' || chr(10) || ' ' || chr(10) || 'rest' || chr(10) || ' ' || chr(10) || 'end '
  ELSE chr(10) || ' CLINICAL INFORMATION: ' || source || chr(10) || ' IMPRESSION: first' || chr(10) || ' REASON FOR EXAM:' || chr(10) || text || chr(10) || ' CONCLUSION: ' || text || chr(10) || ' FINDINGS:   ' END"""
_NOTES_SQL = f"""n AS (SELECT doc_id, coalesce({_NOTE}, '') AS t FROM documents),
a AS (SELECT doc_id, t, regexp_split_to_array(t, '\\n [A-Z ()/,-]+:[\\s\\x{{1c}}-\\x{{1f}}\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]') AS parts,
  regexp_extract_all(t, '\\n [A-Z ()/,-]+:[\\s\\x{{1c}}-\\x{{1f}}\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]') AS heads FROM n),
b AS (SELECT doc_id, len(heads) AS heads_n, unnest(range(len(parts))) AS i, unnest(parts) AS part, unnest(list_concat([''], heads)) AS head FROM a),
c AS (SELECT *, sum(length(part) + length(head)) OVER (PARTITION BY doc_id ORDER BY i) - length(part) AS start, trim(lower(regexp_extract(head, '\\n ([A-Z ()/,-]+):', 1))) AS h FROM b),
v AS (SELECT * FROM (VALUES {', '.join(f"('{k}', '{v}')" for k, v in text.SECTION_NAMES.items())}) AS v(h, name)),
d AS (SELECT doc_id, i, start, CASE WHEN i = 0 AND heads_n > 0 THEN part || chr(10) || ' ' ELSE part END AS body,
  CASE WHEN i = 0 THEN CASE WHEN heads_n > 0 THEN 'preamble' ELSE 'full report' END WHEN v.name IS NOT NULL THEN v.name WHEN contains(c.h, 'impression') THEN 'impression' WHEN contains(c.h, 'findings') THEN 'findings' WHEN contains(c.h, 'history') THEN 'history' WHEN contains(c.h, 'comparison') THEN 'comparison'
    WHEN contains(c.h, 'addendum') THEN 'addendum' WHEN {' OR '.join(f"contains(c.h, '{x}')" for x in text.VIEWS)} THEN 'findings' ELSE c.h END AS name FROM c LEFT JOIN v ON v.h = c.h),
e AS (SELECT * FROM d WHERE NOT (name IN ('impression', 'findings') AND trim(body, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') = '')),
f AS (SELECT *, max(i) OVER w = i AND NOT bool_or(name IN ('impression', 'findings')) OVER w AND contains(body, chr(10) || ' ' || chr(10)) AS ends, instr(body, chr(10) || ' ' || chr(10)) AS cut FROM e WINDOW w AS (PARTITION BY doc_id)),
g AS (SELECT doc_id, i, start, name, CASE WHEN ends THEN left(body, cut - 1) ELSE body END AS body FROM f UNION ALL SELECT doc_id, i + 1, start + cut + 2, 'last_paragraph', substr(body, cut + 3) FROM f WHERE ends),
s AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INT) AS pos, name, CAST(start AS INT) AS start, body FROM g)"""
_LAST_SQL = lambda name: f"trim(arg_max(body, pos) FILTER (WHERE name = '{name}'), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')"
_SECTIONS_SQL = f"r AS (SELECT doc_id, {', '.join(f'{_LAST_SQL(n)} AS {n}' for n in text.CONCLUSIONS)}, {_LAST_SQL('examination')} AS examination FROM s GROUP BY 1)"
_CHOSEN_SQL = "CASE WHEN impression IS NOT NULL THEN 'impression' WHEN findings IS NOT NULL THEN 'findings' WHEN last_paragraph IS NOT NULL THEN 'last_paragraph' WHEN comparison IS NOT NULL THEN 'comparison' END AS section, coalesce(impression, findings, last_paragraph, comparison, '') AS body"


def _notes(t):
    return t.documents.select("doc_id", F.coalesce(F.expr(_NOTE), F.lit("")).alias("note"))


@query(f"WITH {_NOTES_SQL} SELECT * FROM s")
def section_split(t):
    return text.section_split(_notes(t), "doc_id", "note")


@query(f"WITH {_NOTES_SQL}, {_SECTIONS_SQL} SELECT doc_id, {', '.join(text.CONCLUSIONS)} FROM r")
def section_table(t):
    return text.section_table(_notes(t), "doc_id", "note")


@query(f"WITH {_NOTES_SQL}, {_SECTIONS_SQL} SELECT doc_id, {_CHOSEN_SQL} FROM r")
def section_select(t):
    return text.section_select(_notes(t), "doc_id", "note")


@query(f"""WITH {_NOTES_SQL}, {_SECTIONS_SQL}, o AS (SELECT doc_id, {_CHOSEN_SQL}, examination FROM r)
SELECT o.doc_id, CASE WHEN o.doc_id % 11 = 0 THEN 'given place' WHEN o.doc_id % 4 = 2 THEN 'examination' ELSE section END AS section, CASE WHEN o.doc_id % 11 = 0 THEN substr(n.t, 4, 40) WHEN o.doc_id % 4 = 2 THEN coalesce(examination, '') ELSE body END AS body FROM o JOIN n ON n.doc_id = o.doc_id""")
def section_overrides(t):
    """Some reports state the section or the characters that hold their conclusion."""
    by_name = t.documents.filter("doc_id % 4 = 2").select("doc_id", F.lit("examination").alias("name"))
    by_place = t.documents.filter("doc_id % 11 = 0").select("doc_id", F.lit(3).alias("start"), F.lit(43).alias("stop"))
    return text.section_select(_notes(t), "doc_id", "note", by_name=by_name, by_place=by_place)


@query("SELECT *, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall, 2 * tp / nullif(2 * tp + fp + fn, 0) AS f1 FROM (SELECT count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS tp, count(*) FILTER (WHERE quality <> 1 AND toxic = 0) AS fp, count(*) FILTER (WHERE quality = 1 AND toxic <> 0) AS fn, count(*) FILTER (WHERE quality = 1) AS positives FROM labels) q")
def label_eval(t):
    return text.label_eval(t.labels.withColumn("guess", 1 - F.col("toxic")), "quality", "guess")


@query("SELECT subject_id, stay_id, CASE WHEN anchor_age < 30 THEN 1 ELSE 0 END AS exclusion_young, CASE WHEN outtime < intime + INTERVAL '5' DAY THEN 1 ELSE 0 END AS exclusion_short, CASE WHEN anchor_age < 30 OR outtime < intime + INTERVAL '5' DAY THEN 0 ELSE 1 END AS included FROM icustays JOIN patients USING (subject_id)", "icustays patients")
def cohort_flags(t):
    stays = t.icustays.join(t.patients.select("subject_id", "anchor_age"), "subject_id")
    rules = {"young": F.col("anchor_age") < 30, "short": F.col("outtime") < F.col("intime") + days(5)}
    return cohort.cohort_flags(stays, rules).select("subject_id", "stay_id", "exclusion_young", "exclusion_short", "included")


@query("SELECT 'all' AS step, count(*) AS remaining FROM icustays UNION ALL SELECT 'young', count(*) FILTER (WHERE anchor_age >= 30) FROM icustays JOIN patients USING (subject_id) UNION ALL SELECT 'short', count(*) FILTER (WHERE anchor_age >= 30 AND outtime >= intime + INTERVAL '5' DAY) FROM icustays JOIN patients USING (subject_id)", "icustays patients")
def cohort_funnel(t):
    return cohort.funnel(cohort_flags(t), ["young", "short"])


@query("""SELECT 'c_nationkey' AS variable, NULL AS level, count(c_nationkey) AS n, round(avg(c_nationkey), 9) AS mean, round(stddev_samp(CAST(c_nationkey AS DOUBLE)), 6) AS sd, count(*) - count(c_nationkey) AS missing FROM customer
UNION ALL SELECT 'c_mktsegment', c_mktsegment, count(*), NULL, NULL, count(*) - count(c_mktsegment) FROM customer GROUP BY c_mktsegment""")
def table_one(t):
    one = cohort.table_one(t.customer, ["c_nationkey"], ["c_mktsegment"])
    return one.withColumns({"mean": F.round("mean", 9), "sd": F.round("sd", 6)})


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'user-' || user_id AS reference FROM events")
def flatten_resources(t):
    ids = F.array(F.struct(F.lit("urn:user").alias("system"), F.concat(F.lit("user-"), "user_id").alias("value")), F.struct(F.lit("urn:other").alias("system"), F.lit("x").alias("value")))
    nested = t.events.select("event_id", F.from_json("props", "k long").alias("props"), ids.alias("identifier"))
    return cohort.flatten_resources(nested, {"for_each": "identifier", "where": {"system": "urn:user"}, "select": {"event_id": "event_id", "k": "props.k", "reference": "$.value"}})


@query("SELECT hadm_id, count(DISTINCT drug) AS drugs FROM prescriptions WHERE drug_type <> 'BASE' AND drug NOT IN ('Heparin', 'Insulin') GROUP BY 1", "prescriptions")
def polypharmacy(t):
    plain = t.prescriptions.filter(F.col("drug").isin("Heparin", "Insulin")).select("drug").distinct()
    return t.prescriptions.filter("drug_type <> 'BASE'").join(plain, "drug", "left_anti").groupBy("hadm_id").agg(F.count_distinct("drug").alias("drugs"))


@query("SELECT stay_id, min(value) FILTER (WHERE charttime = first_at) AS first_value, max(expired) AS expired FROM (SELECT o.stay_id, o.charttime, o.value, min(o.charttime) OVER (PARTITION BY o.stay_id) AS first_at, a.hospital_expire_flag AS expired FROM outputevents o JOIN admissions a ON a.hadm_id = o.hadm_id) GROUP BY 1", "outputevents admissions")
def first_value_by_outcome(t):
    rows = t.outputevents.join(t.admissions.select("hadm_id", F.col("hospital_expire_flag").alias("expired")), "hadm_id")
    return rows.groupBy("stay_id").agg(F.min(F.struct("charttime", "value")).alias("s"), F.max("expired").alias("expired")).select("stay_id", F.col("s.value").alias("first_value"), "expired")


@query("""WITH p AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN -1 END AS quality, CASE doc_id % 3 WHEN 0 THEN 1 WHEN 1 THEN -1 END AS toxic FROM labels),
b AS (SELECT doc_id, CASE WHEN quality = -1 THEN 1 ELSE coalesce(CAST(quality = 1 AS INT), 0) END AS quality, CASE WHEN toxic = -1 THEN 1 ELSE coalesce(CAST(toxic = 1 AS INT), 0) END AS toxic FROM p),
r AS (SELECT 'quality' AS label, l.quality AS t, b.quality AS p FROM labels l JOIN b USING (doc_id) UNION ALL SELECT 'toxic', l.toxic, b.toxic FROM labels l JOIN b USING (doc_id)),
n AS (SELECT label, count(*) FILTER (WHERE t = 1 AND p = 1) AS tp, count(*) FILTER (WHERE t = 0 AND p = 1) AS fp, count(*) FILTER (WHERE t = 1 AND p = 0) AS fn, count(*) FILTER (WHERE t = 1) AS positives FROM r GROUP BY 1)
SELECT *, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall, 2 * tp / nullif(2 * tp + fp + fn, 0) AS f1 FROM n""")
def label_evals(t):
    d = F.col("doc_id")
    given = t.labels.select("doc_id", F.when(d % 4 == 0, 1).when(d % 4 == 1, 0).when(d % 4 == 2, -1).alias("quality"), F.when(d % 3 == 0, 1).when(d % 3 == 1, -1).alias("toxic"))
    return text.label_evals(t.labels, text.binarize_labels(given, ["quality", "toxic"]), "doc_id", ["quality", "toxic"])


@query("SELECT a.quality AS first, b.quality AS second, count(*) AS studies FROM labels a FULL JOIN (SELECT doc_id, toxic AS quality FROM labels WHERE doc_id % 5 <> 0) b ON a.doc_id = b.doc_id GROUP BY 1, 2")
def labeler_agreement(t):
    return text.agreement(t.labels, t.labels.filter("doc_id % 5 <> 0").select("doc_id", F.col("toxic").alias("quality")), "doc_id", "quality")


@query("SELECT source, count(*) AS rows, count(DISTINCT doc_id) AS subjects, count(*) FILTER (WHERE lang = 'en') AS view_en, count(*) FILTER (WHERE lang = 'de') AS view_de FROM documents GROUP BY 1")
def split_statistics(t):
    return text.split_statistics(t.documents, "source", "lang", "doc_id", ["en", "de"])


@query("SELECT drug, count(*) AS n FROM prescriptions GROUP BY 1", "prescriptions")
def drug_name_frequency(t):
    return t.prescriptions.groupBy("drug").agg(F.count("*").alias("n"))


@query("SELECT stay_id, charttime, value, date_diff('hour', admittime, charttime) AS hours_since_admission FROM outputevents o JOIN admissions a ON a.hadm_id = o.hadm_id", "outputevents admissions")
def relative_time(t):
    adm = t.admissions.select("hadm_id", "admittime")
    return t.outputevents.join(adm, "hadm_id").select("stay_id", "charttime", "value", dt_diff(F.col("charttime"), F.col("admittime"), "HOUR").alias("hours_since_admission"))


@query("""WITH l AS (SELECT CAST(date_diff('hour', intime, outtime) AS DOUBLE) / 24 AS los FROM icustays), h AS (SELECT CASE WHEN los < 0 THEN 0 WHEN los >= 40 THEN 21 ELSE CAST(floor(los / 2) AS BIGINT) + 1 END AS bucket, count(*) AS freq FROM l GROUP BY 1)
SELECT bucket, freq, repeat('=', CAST(round(freq * 30 / CAST((SELECT max(freq) FROM h) AS DOUBLE)) AS INT)) AS bar FROM h""", "icustays")
def length_of_stay_distribution(t):
    los = dt_diff(F.col("outtime"), F.col("intime"), "HOUR").cast("double") / 24
    return cohort.scaled_histogram(t.icustays.select(los.alias("los")), "los", 0.0, 40.0, 20, 30)


@query("SELECT d.itemid, label, coalesce(n, 0) AS rows FROM d_items d LEFT JOIN (SELECT itemid, count(*) AS n FROM procedureevents GROUP BY 1) p ON p.itemid = d.itemid", "d_items procedureevents")
def item_counts(t):
    return cohort.item_counts(t.procedureevents, t.d_items, "itemid", "label")


@query("SELECT subject_id, hadm_id, starttime AS charttime, p.itemid, label FROM procedureevents p JOIN d_items d ON d.itemid = p.itemid AND lower(label) LIKE '%dialysis%' UNION ALL SELECT subject_id, hadm_id, charttime, o.itemid, label FROM outputevents o JOIN d_items d ON d.itemid = o.itemid AND lower(label) LIKE '%dialysis%'", "d_items procedureevents outputevents")
def labelled_intake(t):
    return cohort.labelled_events(t.d_items, [(t.procedureevents, "starttime"), (t.outputevents, "charttime")], "itemid", "label", "dialysis")


@query("""SELECT i.subject_id, i.hadm_id, i.stay_id, dense_rank() OVER (PARTITION BY i.subject_id ORDER BY i.intime) AS stay_seq, first_value(curr_service) OVER (PARTITION BY i.subject_id ORDER BY transfertime, i.intime) AS first_service, hospital_expire_flag,
 CASE WHEN dod <= CAST(dischtime + INTERVAL '1' YEAR AS DATE) THEN 1 ELSE 0 END AS died_within_year FROM icustays i JOIN admissions a ON a.hadm_id = i.hadm_id JOIN patients p ON p.subject_id = i.subject_id JOIN services s ON s.hadm_id = i.hadm_id""", "icustays admissions patients services")
def demographics_mortality(t):
    j = t.icustays.select("subject_id", "hadm_id", "stay_id", "intime").join(t.admissions.select("hadm_id", "dischtime", "hospital_expire_flag"), "hadm_id").join(t.patients.select("subject_id", "dod"), "subject_id")
    j = j.join(t.services.select("hadm_id", "transfertime", "curr_service"), "hadm_id")
    w = Window.partitionBy("subject_id")
    late = F.col("dod") <= (F.col("dischtime") + F.expr("INTERVAL '1' YEAR")).cast("date")
    return j.select(
        "subject_id", "hadm_id", "stay_id", F.dense_rank().over(w.orderBy("intime")).cast("long").alias("stay_seq"), F.first_value("curr_service").over(w.orderBy("transfertime", "intime")).alias("first_service"),
        "hospital_expire_flag", F.when(late, 1).otherwise(0).alias("died_within_year"),
    )


@query("SELECT 'event/' || CAST(event_id AS VARCHAR) AS path, 'k' AS tag, json_extract_string(props, '$.k') AS value FROM events WHERE length(json_extract_string(props, '$.k')) <= 100")
def image_metadata(t):
    rows = t.events.select(F.concat(F.lit("event/"), F.col("event_id").cast("string")).alias("path"), F.col("props").alias("tags"))
    return io.image_metadata(rows).filter("tag = 'k'")
