"""Typed readers, subset loads and table sinks."""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TYPES = {
    "int": T.LongType(), "integer": T.LongType(), "short": T.LongType(), "float": T.DoubleType(), "double": T.DoubleType(), "numeric": T.DoubleType(), "str": T.StringType(), "string": T.StringType(),
    "ts": T.TimestampNTZType(), "timestamp": T.TimestampNTZType(), "datetime": T.TimestampNTZType(), "date": T.DateType(), "boolean": T.BooleanType(),
}


def schema(columns: str) -> T.StructType:
    """Schema from ``"name type, name type"``."""
    fields = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(n, TYPES[t.lower()]) for n, t in fields])


def schema_from_json(text: str) -> T.StructType:
    """Schema from a JSON list of ``{"name": .., "type": ..}``."""
    return T.StructType([T.StructField(f["name"], TYPES[f["type"].lower()]) for f in json.loads(text)])


def read_csv(spark: SparkSession, path: str | Sequence[str], shape: T.StructType) -> DataFrame:
    """CSV (plain or gz) with a declared schema; an empty field is null."""
    return (
        spark.read.schema(shape).option("header", True).option("quote", '"').option("escape", '"').option("nullValue", "").option("emptyValue", "").option("mode", "FAILFAST").csv(path)
    )


def csv_to_parquet(spark: SparkSession, source: str, target: str, shape: T.StructType, *, cluster_by: str | None = None) -> None:
    """Typed copy of a CSV; ``cluster_by`` sorts within files, so that code filters skip row groups."""
    df = read_csv(spark, source, shape)
    if cluster_by:
        df = df.repartitionByRange(cluster_by).sortWithinPartitions(cluster_by)
    df.write.mode("overwrite").parquet(target)


def table_name(path: str) -> str | None:
    """``.../hosp/labevents.csv.gz`` is ``hosp.labevents``; None for other files."""
    parts = path.rstrip("/").split("/")
    stem, dot, end = parts[-1].partition(".")
    if len(parts) < 2 or end not in ("csv", "csv.gz", "parquet"):
        return None
    return f"{parts[-2]}.{stem}".lower()


def open_folder(spark: SparkSession, root: str, known: dict[str, T.StructType | None], *, folders: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Tables of the files under ``root/folder/`` by name, also registered as views (``hosp_labevents``).

    ``known`` names the expected tables with their CSV schemas (None for Parquet). Files of other names and folders are
    skipped, expected tables without a file are warned about and skipped. Only names are listed on the driver.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = {}
    for folder in fs.listStatus(path):
        if not folder.isDirectory() or (folders is not None and folder.getPath().getName() not in folders):
            continue
        for file in fs.listStatus(folder.getPath()):
            where = file.getPath().toString()
            name = table_name(where)
            if name in known:
                out[name] = spark.read.parquet(where) if known[name] is None else read_csv(spark, where, known[name])
                out[name].createOrReplaceTempView(name.replace(".", "_"))
    for name in known.keys() - out.keys():
        warnings.warn(f"no file for table {name}", stacklevel=2)
    return out


def open_table(spark: SparkSession, path: str, name: str, *, fmt: str = "parquet") -> DataFrame:
    """A stored table (``parquet``, or ``delta`` where that source is installed) as DataFrame and view."""
    df = spark.read.format(fmt).load(path)
    df.createOrReplaceTempView(name)
    return df


def read_lookup(spark: SparkSession, path: str, shape: T.StructType, max_bytes: int = 32_000_000) -> DataFrame:
    """A code table, marked for broadcast if its rows take at most ``max_bytes``."""
    df = read_csv(spark, path, shape)
    row = sum((16 + F.coalesce(F.octet_length(c), F.lit(0)) if t == "string" else F.lit(8) for c, t in df.dtypes), F.lit(16))
    return F.broadcast(df) if (df.agg(F.sum(row)).first()[0] or 0) <= max_bytes else df


#: Further source tables: emergency department and notes.
EMERGENCY = {
    "ed.edstays": "subject_id int, hadm_id int, stay_id int, intime timestamp, outtime timestamp, gender str, race str, arrival_transport str, disposition str",
    "ed.diagnosis": "subject_id int, stay_id int, seq_num int, icd_code str, icd_version int, icd_title str",
    "ed.medrecon": "subject_id int, stay_id int, charttime timestamp, name str, gsn str, ndc str, etc_rn int, etccode str, etcdescription str",
    "ed.pyxis": "subject_id int, stay_id int, charttime timestamp, med_rn int, name str, gsn_rn int, gsn str",
    "ed.triage": "subject_id int, stay_id int, temperature numeric, heartrate numeric, resprate numeric, o2sat numeric, sbp numeric, dbp numeric, pain str, acuity numeric, chiefcomplaint str",
    "ed.vitalsign": "subject_id int, stay_id int, charttime timestamp, temperature numeric, heartrate numeric, resprate numeric, o2sat numeric, sbp numeric, dbp numeric, rhythm str, pain str",
}
NOTES = {
    "note.discharge": "note_id str, subject_id int, hadm_id int, note_type str, note_seq int, charttime timestamp, storetime timestamp, text str",
    "note.discharge_detail": "note_id str, subject_id int, field_name str, field_value str, field_ordinal int",
    "note.radiology": "note_id str, subject_id int, hadm_id int, note_type str, note_seq int, charttime timestamp, storetime timestamp, text str",
    "note.radiology_detail": "note_id str, subject_id int, field_name str, field_value str, field_ordinal int",
}


def image_metadata(rows: DataFrame, longest: int = 100) -> DataFrame:
    """``path, tag, value`` of extracted image headers (``path``, and ``tags`` as JSON text); longer values are left out."""
    tags = F.from_json("tags", "map<string,string>")
    return rows.select("path", F.explode(F.map_filter(tags, lambda k, v: F.length(v) <= longest)).alias("tag", "value"))


def first_subjects(tables: dict[str, DataFrame], subjects: DataFrame, n: int, key: str = "subject_id") -> dict[str, DataFrame]:
    """Every table with that column, kept to the ``n`` smallest subjects (a bounded side, broadcast)."""
    chosen = F.broadcast(subjects.select(key).distinct().orderBy(key).limit(n))
    return {name: df.join(chosen, key, "left_semi") if key in df.columns else df for name, df in tables.items()}


def coerce_times(df: DataFrame) -> DataFrame:
    """Text columns named ``...time`` or ``...date`` as wall-clock timestamps or dates; unreadable ones null."""
    texts = [c for c, t in df.dtypes if t == "string"]
    out = {c: F.try_to_timestamp(c).cast("timestamp_ntz") for c in texts if c.endswith("time")}
    out |= {c: F.try_to_timestamp(c).cast("date") for c in texts if c.endswith("date")}
    return df.withColumns(out) if out else df


def save_concept(df: DataFrame, name: str, *, fmt: str = "parquet") -> None:
    """Replace the table of that name."""
    df.write.mode("overwrite").format(fmt).saveAsTable(name)


def parquet_folder(root: str) -> Callable[[str, DataFrame], DataFrame]:
    """A sink for ``write_chain``: ``root/name`` as Parquet, also a view of that name."""

    def save(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        stored = df.sparkSession.read.schema(df.schema).parquet(f"{root}/{name}")
        stored.createOrReplaceTempView(name)
        return stored

    return save


def save_metadata(spark: SparkSession, values: dict[str, str], name: str) -> None:
    spark.createDataFrame(list(values.items()), "attribute string, value string").write.mode("overwrite").saveAsTable(name)


def copy_schema(spark: SparkSession, tables: Sequence[str], version: str) -> None:
    """Copy derived tables into a versioned database."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{version}`")
    for t in tables:
        spark.table(t).write.mode("overwrite").saveAsTable(f"`{version}`.`{t.split('.')[-1]}`")


@dataclass(frozen=True)
class CodeLayout:
    """Where an event table's rows lie: one partition for the ``hot`` codes, one for each range between ``bounds``.

    Rows without a code lie with the hot ones, at number 0; number 1 is the range below the first bound.
    """

    code: str
    bounds: tuple[int, ...]
    hot: tuple[int, ...] = ()
    column: str = "code_bucket"

    def number(self, code: int) -> int:
        return 0 if code in self.hot else 1 + sum(code >= b for b in self.bounds)

    def write(self, df: DataFrame, path: str) -> None:
        """Partitioned by number and sorted by code, so that files and row groups hold few codes each.

        Ranges are cut by code and then by the row's hash: a code with very many rows is several tasks' and files'.
        """
        code = F.col(self.code)
        between = sum((F.when(code >= b, 1).otherwise(0) for b in sorted(self.bounds)), F.lit(1))
        number = F.when(code.isNull() | code.isin(list(self.hot)), 0).otherwise(between) if self.hot else F.when(code.isNull(), 0).otherwise(between)
        dealt = df.withColumn(self.column, number)
        dealt = dealt.repartitionByRange(self.column, self.code, F.xxhash64(*df.columns)).sortWithinPartitions(self.column, self.code)
        dealt.write.mode("overwrite").partitionBy(self.column).parquet(path)

    def read(self, spark: SparkSession, path: str, codes: Sequence[int] | None = None, *, low: int | None = None, high: int | None = None) -> DataFrame:
        """The rows of a list of codes, or of codes from ``low`` up to but not including ``high``; only their partitions are listed and read."""
        df, code = spark.read.parquet(path), F.col(self.code)
        if codes is not None:
            numbers, wanted = {self.number(c) for c in codes}, code.isin(list(codes))
        elif low is None and high is None:
            return df.drop(self.column)
        else:
            first = 1 if low is None else 1 + sum(low >= b for b in self.bounds)
            last = 1 + len(self.bounds) if high is None else 1 + sum(high - 1 >= b for b in self.bounds)
            hot = any((low is None or c >= low) and (high is None or c < high) for c in self.hot)
            numbers = {*range(first, last + 1), *([0] if hot else [])}
            wanted = (code >= low if low is not None else F.lit(True)) & (code < high if high is not None else F.lit(True))
        return df.filter(F.col(self.column).isin(sorted(numbers)) & wanted).drop(self.column)


def write_by_code(df: DataFrame, path: str, code: str, bounds: Sequence[int], hot: Sequence[int] = ()) -> CodeLayout:
    """Partition an event table by code range, sorted by code within each file; returns the layout to read it by."""
    layout = CodeLayout(code, tuple(bounds), tuple(hot))
    layout.write(df, path)
    return layout


def write_texts(df: DataFrame, path: str, per_file: int = 10_000) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", per_file).parquet(path)
