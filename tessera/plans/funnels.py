"""The funnels that pick tasks from a repository: commits, functions, test targets, builds, and test verdicts.

Each is one ordered chain of reject rules over a table; every row stays, with its reason and status. Reason
texts, thresholds and weights are fixed values of the domain. Everything is joins and expressions; ancestry is walked
for all repositories at once (operators.ancestry).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import paths as pt
from tessera.operators import ancestry as an
from tessera.operators import joins as jn
from tessera.operators import sequences
from tessera.operators.rules import Rule, additive_score, first_reason, funnel


@dataclass(frozen=True)
class CommitLimits:
    """Thresholds and weights of the commit funnel."""

    min_lines: int = 3
    max_lines: int = 300
    max_files: int = 6
    ignored: tuple[str, ...] = ("docs/", "*.md", "*.rst", ".github/", "CHANGELOG*", "*_version.py")
    fix_words: str = r"(?i)fix|bug|GH-\d+|#\d+|error|incorrect|regression|edge case"
    revert: str = r"(?m)^Revert\b|This reverts commit ([0-9a-f]{7,40})"
    keep_kinds: tuple[str, ...] = ("bugfix", "feature")
    weights: tuple[float, float, float, float] = (1.0, 2.0, 1.0, 1.0)


@dataclass(frozen=True)
class FunctionLimits:
    """Thresholds of the function funnel."""

    min_tests: int = 2
    max_tests: int = 40
    min_lines: int = 8
    max_lines: int = 80
    min_complexity: int = 3


def _under(n: Column, limit: int) -> Column:
    return F.concat(n.cast("string"), F.lit(f"<{limit}"))


def _over(n: Column, limit: int) -> Column:
    return F.concat(n.cast("string"), F.lit(f">{limit}"))


def commit_funnel(commits: DataFrame, covered: DataFrame, limits: CommitLimits = CommitLimits()) -> DataFrame:
    """commits (ord, sha, parents, message, is_merge, pr_number, files_changed, source_lines, test_files_touched,
    touches_manifest, touched_functions, parses) with covered_functions, reason, status and reverted_by.

    covered holds qualnames that some test reaches.
    """
    ignored = lambda f: pt.matches_any(f, list(limits.ignored))
    rows = commits.select("sha", F.explode("touched_functions").alias("qualname")).join(covered.select("qualname").distinct(), "qualname").groupBy("sha").agg(F.array_sort(F.collect_set("qualname")).alias("covered_functions"))
    df = commits.join(rows, "sha", "left").withColumn("covered_functions", F.coalesce("covered_functions", F.array().cast("array<string>")))
    source = F.filter("files_changed", lambda f: F.endswith(f, F.lit(".py")) & ~F.array_contains("test_files_touched", f) & ~ignored(f))
    df = df.withColumn("source_files", source)
    n_files, n_lines = F.size("source_files"), F.col("source_lines")
    rules = [
        Rule("root-commit", F.size("parents") == 0),
        Rule("non-pr-merge", F.col("is_merge") & F.col("pr_number").isNull()),
        Rule("docs-or-ci-only", F.forall("files_changed", ignored)),
        Rule("dependency-changing", F.col("touches_manifest")),
        Rule("no-source-change", n_files == 0),
        Rule("too-many-files", n_files > limits.max_files, _over(n_files, limits.max_files)),
        Rule("too-small", n_lines < limits.min_lines, _under(n_lines, limits.min_lines)),
        Rule("too-large", n_lines > limits.max_lines, _over(n_lines, limits.max_lines)),
        Rule("uncovered-and-no-tests", (F.size("covered_functions") == 0) & (F.size("test_files_touched") == 0)),
        Rule("unparseable", ~F.col("parses")),
    ]
    judged = funnel(df, rules, kept="considered").join(reverted(commits, limits), "sha", "left")
    drop = (F.col("status") == "considered") & F.col("reverted_by").isNotNull()
    named = F.concat(F.lit("reverted-by("), pt.short_sha(F.col("reverted_by")), F.lit(")"))
    return judged.withColumn("reason", F.when(drop, named).otherwise(F.col("reason"))).withColumn("status", F.when(drop, "rejected").otherwise(F.col("status")))


def reverted(commits: DataFrame, limits: CommitLimits = CommitLimits()) -> DataFrame:
    """sha, reverted_by: commits that a revert message names, or (with patch ids) a later commit undoes.

    Of several messages the oldest commit's counts, being the last in newest-first order.
    """
    hits = commits.where(F.col("message").rlike(limits.revert))
    targets = hits.select(F.col("sha").alias("by"), F.col("ord").alias("by_ord"), F.explode(F.regexp_extract_all("message", F.lit(limits.revert), F.lit(1))).alias("target")).where("target <> ''")
    named = jn.prefix_join(targets, commits.select("sha"), "target", "sha", 7).groupBy("sha").agg(F.max_by("by", "by_ord").alias("named"))
    if "patch_id" not in commits.columns:
        return named.withColumnRenamed("named", "reverted_by")
    a, b = commits.select("sha", "ord", "reverse_id").alias("a"), commits.select(F.col("sha").alias("by"), F.col("ord").alias("by_ord"), "patch_id").alias("b")
    undone = a.join(b, (F.col("reverse_id") == F.col("patch_id")) & (F.col("by_ord") < F.col("ord"))).groupBy("sha").agg(F.min_by("by", "by_ord").alias("undone"))
    return named.join(undone, "sha", "full").select("sha", F.coalesce("named", "undone").alias("reverted_by"))


def score_commits(kept: DataFrame, public: DataFrame, limits: CommitLimits = CommitLimits()) -> DataFrame:
    """kept commits with score and score_breakdown; public holds qualnames with is_public, others go by their name."""
    fix, tests, fn, single = limits.weights
    seen = kept.select("sha", F.explode("touched_functions").alias("qualname")).join(public.select("qualname", "is_public"), "qualname", "left")
    shown = F.coalesce("is_public", ~F.exists(F.slice(F.split("qualname", r"\."), 2, 100), lambda p: F.startswith(p, F.lit("_"))))
    some = seen.groupBy("sha").agg(F.bool_or(shown).alias("__public"))
    df = kept.join(some, "sha", "left")
    total, parts = additive_score({"fix_keyword": (F.col("message").rlike(limits.fix_words), fix), "adds_tests": (F.size("test_files_touched") > 0, tests), "public_fn": (F.coalesce("__public", F.lit(False)), fn), "single_function": (F.size("touched_functions") == 1, single)})
    return df.withColumn("score", total).withColumn("score_breakdown", parts).drop("__public")


def classify_commits(commits: DataFrame, decisions: DataFrame, limits: CommitLimits = CommitLimits()) -> DataFrame:
    """considered commits with the status that external decisions (sha, kind, self_contained, verifiable) give."""
    d = commits.join(decisions.withColumn("__there", F.lit(True)), "sha", "left")
    rules = [
        Rule("classify-no-answer", F.col("__there").isNull()),
        Rule("kind:", ~F.col("kind").isin(list(limits.keep_kinds))),
        Rule("not-self-contained", ~F.col("self_contained")),
        Rule("not-verifiable-via-tests", ~F.col("verifiable")),
    ]
    text = F.when(first_reason(rules) == "kind:", F.concat(F.lit("kind:"), "kind")).otherwise(first_reason(rules))
    return d.withColumn("reason", text).withColumn("status", F.when(F.col("reason").isNull(), "kept").otherwise("rejected")).drop("__there")


def superseded(commits: DataFrame, by: str = "repo", level: Column | None = None) -> DataFrame:
    """by, sha, merge: commits that a kept merge brings in (reachable from its second parent, not from its first).

    commits has by, ord, sha, parents, is_merge, status; of several merges the last in order counts. `level` is higher in
    a commit than in its parents; where none is given, a parent comes later in order.
    """
    merges = commits.where((F.col("status") == "kept") & F.col("is_merge") & (F.size("parents") > 1))
    wanted = merges.select(by, F.col("sha").alias("range"), F.col("parents")[0].alias("a"), F.col("parents")[1].alias("b"))
    found = an.ranges(commits.withColumn("level", -F.col("ord") if level is None else level), wanted, by)
    merge = merges.select(by, F.col("sha").alias("range"), F.col("ord").alias("__ord"))
    return found.join(merge, [by, "range"]).groupBy(by, "sha").agg(F.max_by("range", "__ord").alias("merge"))


def supersede(commits: DataFrame, by: str = "repo") -> DataFrame:
    """commits with constituents of kept merges rejected as superseded-by-merge."""
    gone = superseded(commits, by)
    hit = F.col("merge").isNotNull() & F.col("status").isin("considered", "kept", "surplus")
    reason = F.concat(F.lit("superseded-by-merge("), pt.short_sha(F.col("merge")), F.lit(")"))
    return commits.join(gone, [by, "sha"], "left").withColumn("reason", F.when(hit, reason).otherwise(F.col("reason"))).withColumn("status", F.when(hit, "rejected").otherwise(F.col("status"))).drop("merge")


def function_funnel(functions: DataFrame, tests: DataFrame, modules: DataFrame, classes: DataFrame, private_imports: DataFrame, limits: FunctionLimits = FunctionLimits()) -> DataFrame:
    """functions (qualname, module, file, name, parent, is_method, line, end_line, complexity) with covering_tests, reason,
    status and score.

    tests: qualname, test (base ids of passing tests); modules: module, is_test, is_source; classes: qualname, is_public;
    private_imports: test_file, names (private names that a test file imports).
    """
    cover = tests.groupBy("qualname").agg(F.array_sort(F.collect_set("test")).alias("covering_tests"))
    files = tests.select("qualname", F.substring_index("test", "::", 1).alias("test_file")).distinct().join(private_imports, "test_file")
    first = files.groupBy("qualname").agg(F.min(F.struct("test_file", "names")).alias("__bad"))
    hidden = classes.where(~F.col("is_public")).select(F.col("qualname").alias("parent"), F.lit(True).alias("__hidden"))
    df = functions.join(cover, "qualname", "left").join(modules, "module", "left").join(hidden, "parent", "left").join(first, "qualname", "left")
    df = df.withColumn("covering_tests", F.coalesce("covering_tests", F.array().cast("array<string>"))).withColumn("span", F.col("end_line") - F.col("line") + 1)
    n, span, depth = F.size("covering_tests"), F.col("span"), F.col("complexity")
    rules = [
        Rule("test-code", F.col("is_test")),
        Rule("init-module", F.element_at(F.split("file", "/"), -1) == "__init__.py"),
        Rule("private", F.startswith(F.element_at(F.split("qualname", r"\."), -1), F.lit("_"))),
        Rule("private-parent", F.col("is_method") & F.col("__hidden")),
        Rule("uncovered", n == 0),
        Rule("few-covering-tests", n < limits.min_tests, _under(n, limits.min_tests)),
        Rule("too-central", n > limits.max_tests, _over(n, limits.max_tests)),
        Rule("too-short", span < limits.min_lines, _under(span, limits.min_lines)),
        Rule("too-long", span > limits.max_lines, _over(span, limits.max_lines)),
        Rule("low-complexity", depth < limits.min_complexity, _under(depth, limits.min_complexity)),
        Rule("non-source-module", ~F.col("is_source")),
        Rule("verifier-imports-private", F.col("__bad").isNotNull(), F.concat(F.col("__bad.test_file"), F.lit(": "), F.array_join("__bad.names", ", "))),
    ]
    out = funnel(df, rules, kept="considered")
    return out.withColumn("score", F.when(F.col("status") == "considered", n * depth)).drop("__hidden", "__bad")


def test_target_reason(min_lines: int, private_complexity: int) -> Column:
    """Why a function (name, is_method, file, module, line, end_line, is_public, complexity, measurable) is no test target."""
    span = F.col("end_line") - F.col("line") + 1
    return first_reason([
        Rule("dunder", pt.is_dunder(F.col("name"))),
        Rule("init_reexport", F.endswith(F.col("file"), F.lit("__init__.py"))),
        Rule("cli_main", (F.col("name") == "main") | F.endswith(F.col("module"), F.lit(".__main__"))),
        Rule("too_small", span < min_lines),
        Rule("private_low_complexity", ~F.col("is_public") & (F.col("complexity") < private_complexity)),
        Rule("no_executable_lines", F.col("measurable") == 0),
    ])


def build_gate_reason(min_failing: int) -> Column:
    """Why a built task is dropped: (has_tests, private_imports, drifted, missing_symbol, solution_failed, input_reasons,
    n_failing, neutral, rewritten, source)."""
    return first_reason([
        Rule("no-tests-in-commit", ~F.col("has_tests")),
        Rule("verifier-imports-non-public-or-missing", F.col("private_imports")),
        Rule("env-drift", F.col("drifted")),
        Rule("verifier-imports-symbol-missing-in-input", F.col("missing_symbol")),
        Rule("verifier-fails-on-solution", F.col("solution_failed")),
        Rule("verifier-on-input", F.size("input_reasons") > 0, F.array_join("input_reasons", ",")),
        Rule("tests-pass-on-input", F.col("n_failing") < min_failing),
        Rule("neutrality-rewrite-failed", ~F.col("neutral") & F.col("rewritten")),
        Rule("verifier-not-implementation-neutral", ~F.col("neutral")),
    ])


#: Reasons that a failing test may have.
VALID_FAILURES = ["AssertionError", "pytest.raises", "NotImplementedError", "exception_in_repo_code"]
INVALID_FAILURES = ["ImportError", "ModuleNotFoundError", "SyntaxError", "AttributeError@import", "collection_error", "collected_0_items", "fixture_not_found", "error_before_repo_call", "no_failing_test", "no_report"]


def failure_reason(text: Column, crash: Column, phase: Column, repo_frames: Column, test_crash: Column) -> Column:
    """Reason of a failed test phase.

    text: its report; crash: the crash message; phase: setup, call or teardown; repo_frames: how many of its frames lie
    in the repository and outside of tests; test_crash: whether it broke off in a test file.
    """
    says = lambda s: F.contains(F.coalesce(text, F.lit("")), F.lit(s)) | F.contains(F.coalesce(crash, F.lit("")), F.lit(s))
    return first_reason([
        Rule("fixture_not_found", F.contains(F.coalesce(text, F.lit("")), F.lit("fixture '")) & says("not found")),
        Rule("pytest.raises", says("DID NOT RAISE")),
        Rule("ModuleNotFoundError", says("ModuleNotFoundError")),
        Rule("ImportError", says("ImportError")),
        Rule("SyntaxError", says("SyntaxError")),
        Rule("NotImplementedError", says("NotImplementedError")),
        Rule("exception_in_repo_code", repo_frames > 0),
        Rule("AssertionError", test_crash & (says("AssertionError") | F.startswith(F.coalesce(crash, F.lit("")), F.lit("assert")))),
        Rule("error_before_repo_call", F.lit(True)),
    ])


def verdicts(reasons: DataFrame, reports: DataFrame, by: str = "report") -> DataFrame:
    """by, n_failing, n_passing, invalid (sorted reasons), ok.

    reasons: by, nodeid, reason of failing tests; reports: by, collected, n_passing. Reasons outside of the vocabulary raise.
    """
    known = F.col("reason").isin([*VALID_FAILURES, *INVALID_FAILURES])
    checked = reasons.withColumn("reason", F.when(known, F.col("reason")).otherwise(F.raise_error(F.concat(F.lit("unknown reason "), "reason"))))
    tally = checked.groupBy(by).agg(F.count("*").alias("n_failing"), F.array_sort(F.collect_set(F.when(F.col("reason").isin(INVALID_FAILURES), F.col("reason")))).alias("invalid"))
    df = reports.join(tally, by, "left")
    n = F.coalesce("n_failing", F.lit(0)).cast("long")
    alone = F.when(F.col("collected").isNull(), F.array(F.lit("no_report"))).when(F.col("collected") == 0, F.array(F.lit("collected_0_items"))).when(n == 0, F.array(F.lit("no_failing_test")))
    invalid = F.coalesce(alone, "invalid")
    return df.select(by, n.alias("n_failing"), F.coalesce("n_passing", F.lit(0)).cast("long").alias("n_passing"), invalid.alias("invalid"), (F.size(invalid) == 0).alias("ok"))


def outcomes_identical(runs: DataFrame, by: list[str]) -> DataFrame:
    """by, identical: whether all runs (by, run, nodeid, outcome) of a phase have the same outcomes."""
    one = runs.groupBy(*by, "run").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("nodeid", "outcome"))))).alias("all"))
    return one.groupBy(*by).agg((F.count_distinct("all") == 1).alias("identical"))


def order_candidates(scored: DataFrame) -> DataFrame:
    """scored commits with their place: by score, the newest of equals first."""
    ranked = sequences.with_ordinals(scored.withColumn("__low", -F.col("score")), ["__low", "ord"], "place")
    return ranked.drop("__low")
