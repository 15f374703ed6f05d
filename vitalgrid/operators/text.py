"""Report texts: sections, fields and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.scalar import extract

#: White space, spelt out as it means more to other engines than to this one's patterns.
BLANK = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
HEADER = rf"\n ([A-Z ()/,-]+):{BLANK}"
PARAGRAPH = "\n \n"

# Names under which the same section is written.
SECTION_NAMES = {
    "comparison": "comparison", "comparisons": "comparison", "reference exam": "comparison", "comparison exam": "comparison", "comparison film": "comparison", "comparision": "comparison", "comparsion": "comparison", "comparrison": "comparison",
    "comparisions": "comparison", "indication": "indication", "reason for examination": "indication", "reason for exam": "indication", "clinical indication": "indication", "idication": "indication", "history": "history", "clinical history": "history",
    "clinical information": "history", "patient history": "history", "pfi": "history", "examination": "examination", "exam": "examination", "type of examination": "examination", "technique": "technique", "notification": "notification",
    "recommendations": "recommendations", "recommendation": "recommendations", "recommendation(s)": "recommendations", "addendum": "addendum", "date": "date", "comment": "comment", "wet read": "wet read", "wetread": "wet read", "preamble": "preamble",
    "findings": "findings", "finding": "findings", "chest, two views": "findings", "findins": "findings", "findindgs": "findings", "findgings": "findings", "findngs": "findings", "findnings": "findings", "finidngs": "findings", "reference findings": "findings",
    "impression": "impression", "conclusion": "impression", "findings and impression": "impression", "findings/impression": "impression", "findings/ impression": "impression", "ndication": "impression", "impresson": "impression",
    "imprression": "impression", "imoression": "impression", "impressoin": "impression", "imprssion": "impression", "impresion": "impression", "imperssion": "impression", "mpression": "impression", "impession": "impression",
}
# Names that other headers are taken for where they contain them, in this order; views that stand over findings.
MAIN_SECTIONS = ("impression", "findings", "history", "comparison", "addendum")
VIEWS = (
    "chest", "portable", "pa and lateral", "lateral and pa", "ap and lateral", "lateral and ap", "frontal and", "two views", "frontal view", "pa view", "ap view", "one view", "lateral view", "bone window", "frontal upright", "frontal semi-upright",
    "ribs", "pa and lat",
)
#: Sections that hold a report's conclusion, best first.
CONCLUSIONS = ("impression", "findings", "last_paragraph", "comparison")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{BLANK}+|{BLANK}+\z", "")


def section_name(header: Column) -> Column:
    """The common name of a section from its header."""
    plain = strip(F.lower(header))
    table = F.create_map(*[F.lit(x) for kv in SECTION_NAMES.items() for x in kv])
    out = F.when(plain.rlike("|".join(VIEWS)), "findings").otherwise(plain)
    for name in reversed(MAIN_SECTIONS):
        out = F.when(plain.contains(name), name).otherwise(out)
    return F.coalesce(F.try_element_at(table, plain), out)


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def sections(text: Column) -> Column:
    """Array of a report's sections: ``name``, ``start`` (place of its text, from 0) and ``body``, as it stands.

    A section begins under a header in capitals that starts its line after one blank; what stands before the first is
    the preamble, a text without headers one full report.  Findings and impressions without text are left out.  Where
    neither is left, the last section ends with its first paragraph, and the rest is the ``last_paragraph``.
    """
    whole = F.coalesce(text, F.lit(""))
    parts = F.struct(F.split(whole, HEADER, -1).alias("body"), F.regexp_extract_all(whole, F.lit(HEADER), F.lit(0)).alias("header"), F.transform(F.regexp_extract_all(whole, F.lit(HEADER), F.lit(1)), section_name).alias("name"))
    size = lambda items, n: F.aggregate(F.slice(items, 1, n), F.lit(0), lambda a, x: a + F.length(x))
    main = lambda x: x["name"].isin("impression", "findings")

    def placed(p: Column) -> Column:
        n = F.size(p["name"])
        first = lambda b: F.when(n == 0, b).otherwise(F.concat(b, F.lit("\n ")))
        return F.transform(p["body"], lambda b, i: F.struct(
            F.when(i > 0, F.get(p["name"], i - 1)).when(n == 0, "full report").otherwise("preamble").alias("name"),
            (size(p["body"], i) + size(p["header"], i)).alias("start"), F.when(i > 0, b).otherwise(first(b)).alias("body"),
        ))

    def ended(s: Column) -> Column:
        def cut(last: Column) -> Column:
            at = F.instr(last["body"], PARAGRAPH)
            end, rest = F.substring(last["body"], F.lit(1), at - 1), F.substring(last["body"], at + len(PARAGRAPH), F.length(last["body"]))
            pair = F.array(
                F.struct(last["name"].alias("name"), last["start"].alias("start"), end.alias("body")),
                F.struct(F.lit("last_paragraph").alias("name"), (last["start"] + at - 1 + len(PARAGRAPH)).alias("start"), rest.alias("body")),
            )
            return F.when(F.exists(s, main) | (at == 0), s).otherwise(F.concat(F.slice(s, 1, F.size(s) - 1), pair))

        return _let(F.element_at(s, -1), cut)

    return _let(_let(parts, lambda p: F.filter(placed(p), lambda x: ~(main(x) & (strip(x["body"]) == "")))), ended)


def section_split(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, pos, name, start, body`` of all ``sections``, one row each."""
    return df.select(key, F.posexplode(sections(F.col(text))).alias("pos", "s")).select(key, "pos", "s.*")


def _last(found: Column, name) -> Column:
    """The text of the last section of that name, null if there is none."""
    return strip(F.try_element_at(F.filter(found, lambda x: x["name"] == name), F.lit(-1))["body"])


def section_table(df: DataFrame, key: str, text: str, names=CONCLUSIONS) -> DataFrame:
    """``key`` and the last section of each of ``names``, null where a report has none."""
    held = df.select(key, sections(F.col(text)).alias("_s"))
    return held.select(key, *[_last(F.col("_s"), n).alias(n) for n in names])


def section_select(df: DataFrame, key: str, text: str, priority=CONCLUSIONS, by_name: DataFrame | None = None, by_place: DataFrame | None = None) -> DataFrame:
    """``key, section, body``: each report's conclusion, from the first name of ``priority`` it has; empty if it has none.

    ``by_name`` (key, name) states another section for some reports, ``by_place`` (key, start, stop) the characters
    themselves; places come first.  A stated section that the report lacks leaves it empty.
    """
    held = df.select(key, F.col(text).alias("_text"), sections(F.col(text)).alias("_s"))
    found = [_last(F.col("_s"), n) for n in priority]
    which = F.coalesce(*[F.when(x.isNotNull(), n) for n, x in zip(priority, found)])
    body = F.coalesce(*found)
    if by_name is not None:
        held = held.join(by_name.select(key, F.col("name").alias("_name")), key, "left")
        stated = F.col("_name").isNotNull()
        which, body = F.when(stated, F.col("_name")).otherwise(which), F.when(stated, _last(F.col("_s"), F.col("_name"))).otherwise(body)
    if by_place is not None:
        held = held.join(by_place.select(key, F.col("start").alias("_start"), F.col("stop").alias("_stop")), key, "left")
        stated = F.col("_start").isNotNull()
        span = F.substring(F.coalesce("_text", F.lit("")), F.col("_start") + 1, F.greatest(F.col("_stop") - F.col("_start"), F.lit(0)))
        which, body = F.when(stated, "given place").otherwise(which), F.when(stated, span).otherwise(body)
    return held.select(key, which.alias("section"), F.coalesce(body, F.lit("")).alias("body"))


def label_eval(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall and F1 of 0/1 labels, with the counts."""
    t, p = F.col(truth) == 1, F.col(predicted) == 1
    n = df.agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"), F.count_if(t).alias("positives"))
    n = n.withColumns({"precision": F.try_divide("tp", F.col("tp") + F.col("fp")), "recall": F.try_divide("tp", F.col("tp") + F.col("fn"))})
    return n.withColumn("f1", F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))


def echo_fields(df: DataFrame, text: str) -> DataFrame:
    """Measurements and time from echo report headers."""
    t = F.col(text)
    field = lambda pattern: extract(t, pattern)
    when = F.concat_ws(" ", field(r"Date/Time: \[\*\*(\d{4}-\d{1,2}-\d{1,2})\*\*\]"), field(r"at (\d{2}:\d{2})"))
    return df.withColumns({
        "test": field(r"Test: ([^\n]*?)\n"), "status": field(r"Status: ([^\n]*?)\n"), "indication": field(r"Indication: ([^\n]*?)\n"),
        "height": F.expr(f"try_cast(nullif(regexp_extract({text}, 'Height: \\\\(in\\\\) ([0-9]+)', 1), '') AS double)"),
        "weight": F.expr(f"try_cast(nullif(regexp_extract({text}, 'Weight \\\\(lb\\\\): ([0-9]+)', 1), '') AS double)"),
        "bsa": F.expr(f"try_cast(nullif(regexp_extract({text}, 'BSA \\\\(m2\\\\): ([0-9.]+)', 1), '') AS double)"),
        "bp": field(r"BP \(mm Hg\): ([0-9/]+)"), "charttime": F.try_to_timestamp(when, F.lit("yyyy-M-d HH:mm")).cast("timestamp_ntz"),
    })


def binarize_labels(df: DataFrame, labels, uncertain: int | None = 1) -> DataFrame:
    """Labels 1 (mentioned), 0 (denied), -1 (uncertain) or null (not mentioned) as 0 and 1; ``uncertain`` None drops these."""
    return df.withColumns({c: F.when(F.col(c) == -1, F.lit(uncertain)).otherwise(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))) for c in labels})


def label_evals(truth: DataFrame, predicted: DataFrame, key: str, labels) -> DataFrame:
    """``label_eval`` of each label, one row each, in one pass over the joined tables."""
    both = truth.select(key, *[F.col(c).alias(f"t_{c}") for c in labels]).join(predicted.select(key, *labels), key)
    rows = both.select(F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(f"t_{c}").alias("t"), F.col(c).alias("p")) for c in labels])).alias("x")).select("x.*").dropna()
    n = rows.groupBy("label").agg(*[F.count_if((F.col("t") == t) & (F.col("p") == p)).alias(name) for name, t, p in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0))], F.count_if(F.col("t") == 1).alias("positives"))
    n = n.withColumns({"precision": F.try_divide("tp", F.col("tp") + F.col("fp")), "recall": F.try_divide("tp", F.col("tp") + F.col("fn"))})
    return n.withColumn("f1", F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))


def agreement(a: DataFrame, b: DataFrame, key: str, label: str) -> DataFrame:
    """Counts of each pair of the values two labelers gave; a study that one of them lacks counts as null."""
    both = a.select(key, F.col(label).alias("first")).join(b.select(key, F.col(label).alias("second")), key, "full")
    return both.groupBy("first", "second").agg(F.count("*").alias("studies"))


def split_statistics(df: DataFrame, split: str, view: str, subject: str, views) -> DataFrame:
    """Per split: rows, distinct subjects, and rows of each view."""
    return df.groupBy(split).agg(F.count("*").alias("rows"), F.count_distinct(subject).alias("subjects"), *[F.count_if(F.col(view) == v).alias(f"view_{v}") for v in views])
