"""Sources: records of a repository and its runs as typed tables with an ordinal where order has a meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as tx

#: Schemas of the records.
COMMIT = "ord bigint, sha string, parents array<string>, message string, is_merge boolean, pr_number int, files_changed array<string>, insertions int, deletions int, test_files_touched array<string>, touches_manifest boolean, touched_functions array<string>"
REPORT = "root string, exitcode int, tests array<struct<nodeid:string,outcome:string,setup:struct<outcome:string,longrepr:string>,call:struct<outcome:string,longrepr:string>,teardown:struct<outcome:string,longrepr:string>>>, collectors array<struct<nodeid:string,outcome:string,longrepr:string>>"
COVERAGE = "files map<string, struct<executed_lines:array<int>, missing_lines:array<int>, contexts:map<string, array<string>>>>"
#: Outcomes of a test run and the status they stand for.
STATUS = {"passed": "pass", "failed": "fail", "error": "error", "skipped": "skip", "xfailed": "skip", "xpassed": "skip"}


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document per file; a missing path or a document that does not parse gives no row."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON record per line; blank and broken lines are left out."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_texts(spark: SparkSession, path: str, glob: str = "*", strict: bool = False) -> DataFrame:
    """path, content: whole files, line ends untouched; strict raises on bytes that are no UTF-8."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    text = F.decode("content", "UTF-8") if strict else F.make_valid_utf8(F.col("content").cast("string"))
    return raw.select("path", text.alias("content"))


def read_binary(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path).select("path", "content")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """path, fields, body of Markdown pages with a leading block of fields."""
    fields, body = tx.frontmatter(F.col("content"))
    return read_texts(spark, path, "*.md").select("path", fields.alias("fields"), body.alias("body"))


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """Commits as exported, newest first; `ord` counts from 0 there."""
    return spark.read.schema(COMMIT).json(path)


def commit_record(raw: DataFrame, manifest: str, pr: str = r"\(#(\d+)\)") -> DataFrame:
    """Commits from (ord, sha, parents, message, numstat): what the export leaves out is derived."""
    from tessera.functions.diffs import numstat
    from tessera.functions.paths import is_test_path

    files = numstat(F.col("numstat"))
    subject = F.substring_index("message", "\n", 1)
    return raw.withColumn("__files", files).select(
        "ord", "sha", "parents", "message", (F.size("parents") > 1).alias("is_merge"),
        F.nullif(F.regexp_extract(subject, pr, 1), F.lit("")).try_cast("int").alias("pr_number"),
        F.transform("__files", lambda f: f["path"]).alias("files_changed"),
        F.aggregate("__files", F.lit(0), lambda a, f: a + f["added"]).alias("insertions"),
        F.aggregate("__files", F.lit(0), lambda a, f: a + f["deleted"]).alias("deletions"),
        F.filter(F.transform("__files", lambda f: f["path"]), lambda p: is_test_path(p)).alias("test_files_touched"),
        F.exists("__files", lambda f: F.element_at(F.split(f["path"], "/"), -1).rlike(manifest)).alias("touches_manifest"),
    )


def test_results(reports: DataFrame, keep: list[str]) -> DataFrame:
    """keep, nodeid, status, reason: a row per test; failed collectors count where no test has their id."""
    from pyspark.sql import Window

    status = F.coalesce(F.create_map(*[F.lit(x) for kv in STATUS.items() for x in kv])[F.col("t.outcome")], F.lit("error"))
    longest = F.coalesce(F.col("t.call.longrepr"), F.col("t.setup.longrepr"), F.col("t.teardown.longrepr"))
    tests = reports.select(*keep, F.explode("tests").alias("t")).select(*keep, F.col("t.nodeid").alias("nodeid"), status.alias("status"), F.substring(longest, 1, 2000).alias("reason"), F.lit(0).alias("__from"))
    broken = reports.select(*keep, F.explode("collectors").alias("c")).where("c.outcome = 'failed'").select(*keep, F.col("c.nodeid").alias("nodeid"), F.lit("error").alias("status"), F.substring(F.col("c.longrepr"), 1, 2000).alias("reason"), F.lit(1).alias("__from"))
    w = Window.partitionBy(*keep, "nodeid").orderBy("__from")
    return tests.unionByName(broken).withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", "__from")


def covered_lines(coverage: DataFrame) -> DataFrame:
    """file, line, test of a coverage document's contexts; empty contexts are no tests."""
    files = coverage.select(F.explode("files").alias("file", "f"))
    lines = files.select("file", F.explode("f.contexts").alias("line", "tests"))
    return lines.select("file", F.col("line").cast("int").alias("line"), F.explode("tests").alias("test")).where("test <> ''")


def line_states(coverage: DataFrame) -> DataFrame:
    """file, line, executed."""
    files = coverage.select(F.explode("files").alias("file", "f"))
    one = lambda c, v: files.select("file", F.explode(f"f.{c}").alias("line"), F.lit(v).alias("executed"))
    return one("executed_lines", True).union(one("missing_lines", False))


def exit_code(text_col):
    """Code behind the last `__exit=` mark, -1 without one."""
    return F.coalesce(F.nullif(F.regexp_extract(text_col, r"(?s).*__exit=(-?\d+)", 1), F.lit("")).try_cast("int"), F.lit(-1))
