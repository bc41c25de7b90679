"""Golden cases of scalar functions, sources, ledger and specifications."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import binary as bn
from tessera.functions import diffs as df_
from tessera.functions import hashing as hs
from tessera.functions import maps as mp
from tessera.functions import paths as pt
from tessera.functions import pyast as pa_
from tessera.functions import text as tx
from tessera.functions import versions as vs
from tessera.plans import ledger as lg
from tessera.plans import spec as sp
from tessera.sources import readers as rd
from tessera.sources import sinks as sk


@pytest.fixture(scope="module")
def one(spark):
    df = spark.range(1)
    return lambda c: df.select(c.alias("x")).first()["x"]


def test_hunks(one):
    diff = F.lit("@@ -3 +4,0 @@\n@@ -10,2 +12,3 @@ def f\n")
    assert one(df_.hunk_lines(diff, "old")) == [3, 10, 11] and one(df_.hunk_lines(diff, "new")) == [12, 13, 14]


def test_numstat(one):
    got = one(df_.numstat(F.lit("3\t1\tb.py\n-\t-\ta.bin\nbroken")))
    assert [tuple(r) for r in got] == [("a.bin", 0, 0), ("b.py", 3, 1)]


def test_patch_ids(spark):
    d = spark.createDataFrame([("a\nb", "a\nc")], "old string, new string")
    d = d.withColumn("go", df_.unified_diff("old", "new")).withColumn("back", df_.unified_diff("new", "old"))
    r = d.select(hs.normalised_patch(F.col("go")).alias("go"), hs.normalised_patch(F.col("back")).alias("back"), hs.normalised_patch(F.lit("")).alias("none")).first()
    assert r["go"] != r["back"] and r["none"] is None


def test_paths(one):
    assert one(pt.path_to_module(F.lit("src/pkg/a/__init__.py"), ["src"])) == "pkg.a"
    assert one(pt.prefixes(F.lit("a.b.c"))) == ["a", "a.b", "a.b.c"]
    assert one(pt.relative_link(F.lit("functions/m/a.md"), F.lit("modules/m.md"))) == "../../modules/m.md"
    assert one(pt.relative_link(F.lit("x/a.md"), F.lit("x/b.md"))) == "b.md"
    assert one(pt.matches_any(F.lit("docs/a.md"), ["docs/", "*.txt"])) and not one(pt.matches_any(F.lit("src/docs.py"), ["docs/", "*.txt"]))
    assert one(pt.is_test_path(F.lit("a/tests/b.py"))) and one(pt.is_test_path(F.lit("test_x.py"))) and not one(pt.is_test_path(F.lit("a/b.py")))
    assert one(pt.relative_base(F.lit("a.b.c"), F.lit(1), F.lit(False))) == "a.b" and one(pt.relative_base(F.lit("a"), F.lit(3), F.lit(False))) is None
    assert one(pt.relative_to(F.lit("/r/a.py"), "/r")) == "a.py" and one(pt.relative_to(F.lit("/x/a.py"), "/r")) is None


def test_text(one):
    assert one(tx.slug(F.lit("  My Repo__x!"))) == "my-repo-x"
    assert one(tx.repo_name(F.lit("https://example.org/o/My_Repo.git/"))) == "my-repo"
    assert one(tx.name_tokens(F.lit("parseHTTPValue_of"), 2)) == ["parse", "httpvalue", "of"]
    fields, body = tx.frontmatter(F.lit("---\na: 1\nb: x: y\n---\nrest"))
    assert one(fields) == {"a": "1", "b": "x: y"} and one(body) == "rest"
    none, same = tx.frontmatter(F.lit("plain"))
    assert one(none) == {} and one(same) == "plain"
    assert one(tx.pairs_text(F.create_map(F.lit("b"), F.lit(2), F.lit("a"), F.lit(1)))) == "a=1, b=2"


def test_maps(one):
    m = lambda **kw: F.create_map(*[F.lit(x) for kv in kw.items() for x in kv])
    assert one(mp.merge(m(a=1, b=2), m(a=3), m(c=4))) == {"a": 3, "b": 2, "c": 4}
    assert one(mp.merge_with(lambda v: F.aggregate(v, F.lit(0), lambda a, x: a + x), m(a=1, b=2), m(a=3))) == {"a": 4, "b": 2}
    assert one(mp.key_map(m(aa=1, ab=2), lambda k: F.substring(k, 1, 1))) == {"a": 2}


def test_binary(one):
    data = F.lit(bytes([1, 2, 1, 2, 1]))
    assert one(bn.find_all(data, bytes([1, 2, 1]))) == [0, 2] and one(bn.find_all(data, bytes([1, 2, 1]), skip_last=True)) == [0]
    assert one(bn.unsigned(F.lit(bytes([0, 1, 2, 0])), 1, 2)) == 513
    assert one(bn.hexdump(F.lit(b"ab\x00"))).split("  ")[-1].strip() == "ab."
    text = "hi".encode("utf-16le")
    assert one(bn.prefixed_text(F.lit(len(text).to_bytes(4, "little") + text), F.lit(0))) == "hi"
    assert one(bn.prefixed_text(F.lit(b"\xff\xff\x00\x00"), F.lit(0))) == "<unreadable>"
    with pytest.raises(Exception, match="outside"):
        one(bn.read_range(data, F.lit(3), F.lit(5)))


def test_versions(one):
    assert one(vs.caret_range(F.lit("^1.2.3"))) == ">=1.2.3,<2" and one(vs.caret_range(F.lit("^0.2.3"))) == ">=0.2.3,<0.3" and one(vs.caret_range(F.lit("~1.2"))) == ">=1.2,<1.3"
    assert one(vs.requirement_name(F.lit("My_Pkg[x]>=1"))) == "my-pkg"
    assert one(vs.is_requirement(F.lit("a>=1,<2"))) and not one(vs.is_requirement(F.lit("a b")))


SOURCE = "import os\n\n\nclass A:\n    def m(self, x):\n        if x and x > 1:\n            return x + 1\n        raise KeyError(x)\n"


def test_source_facts(spark):
    df = spark.createDataFrame([(1, "p.m", SOURCE), (2, "p.n", "def (")], "id int, module string, source string")
    (f,) = pa_.function_table(df, ["id"], "source", "module").collect()
    assert (f["qualname"], f["complexity"], f["raises"], f["line"], f["end_line"]) == ("p.m.A.m", 3, ["KeyError"], 5, 8)
    assert [(r["id"], r["p"]) for r in df.select("id", pa_.parses("source").alias("p")).orderBy("id").collect()] == [(1, True), (2, False)]
    found = pa_.mutant_table(df, ["id"], "source", "module").collect()
    assert {r["operator"] for r in found} == {"comparison_flip", "comparison_boundary", "arithmetic_swap", "and_or_swap", "return_none", "constant_tweak", "statement_delete"}
    assert len({r["mutant"] for r in found}) == len(found) and all(r["id"] == 1 and r["qualname"] == "p.m.A.m" for r in found)


def test_complexity_and_mutants():
    import ast

    count = lambda s: pa_.complexity(ast.parse(s).body[0])
    assert count("def f(xs):\n    return [x for x in xs if x > 0 if x < 10]\n") == 4
    assert count("def f():\n    assert 1\n    with a:\n        pass\n") == 1
    assert count("def f():\n    def g():\n        if a:\n            pass\n") == 1
    assert count("def f(x):\n    return 1 if x and y or z else 2\n") == 4
    text = "def f(x):\n    'Doc.'\n    try:\n        a = x is None\n    finally:\n        b = x in a\n    return (yield)\n"
    made = {}
    for kind, _, new in pa_.mutants(text):
        ast.parse(new)
        made.setdefault(kind, []).append(new)
    assert any("x is not None" in m for m in made["comparison_flip"]) and any("x not in a" in m for m in made["comparison_flip"])
    assert len(made["statement_delete"]) == 3 and all("Doc." in m for m in made["statement_delete"]) and len(made["return_none"]) == 1
    assert any("finally:\n        pass" in m for m in made["statement_delete"])
    assert list(pa_.mutants("def (")) == []
    inner = [m for _, _, m in pa_.mutants("    def f(x):\n        return x < 1\n")]
    assert inner and all(m.startswith("    def f(x):\n        return") for m in inner)


def test_excise():
    assert pa_.excise(SOURCE, ["A", "m"], "pass") == SOURCE[: SOURCE.index("        if")] + "        pass\n"
    assert pa_.excise(SOURCE, ["A", "x"], "pass") is None


def test_results_from_reports(spark):
    report = {"root": "/r", "exitcode": 1, "tests": [{"nodeid": "t::a", "outcome": "xfailed"}, {"nodeid": "t::b", "outcome": "failed", "call": {"longrepr": "boom"}}], "collectors": [{"nodeid": "t::b", "outcome": "failed", "longrepr": "x"}, {"nodeid": "u", "outcome": "failed", "longrepr": "y"}]}
    df = spark.createDataFrame([(json.dumps(report),)], "j string").select(F.from_json("j", rd.REPORT).alias("r")).select("r.*")
    assert {r["nodeid"]: (r["status"], r["reason"]) for r in rd.test_results(df, ["root"]).collect()} == {"t::a": ("skip", None), "t::b": ("fail", "boom"), "u": ("error", "y")}


def test_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"n": 1}\n\nbroken\n{"n": 2}\n')
    assert sorted(r["n"] for r in rd.read_jsonl(spark, f"{tmp_path}/a.jsonl", "n int").where("n is not null").collect()) == [1, 2]
    assert rd.read_json(spark, f"{tmp_path}/none.json", "n int").count() == 0
    (tmp_path / "p.md").write_text("---\nid: 3\n---\nbody\r\n")
    page = rd.read_pages(spark, str(tmp_path)).first()
    assert page["fields"] == {"id": "3"} and page["body"] == "body\r\n"
    df = spark.createDataFrame([(2, "b"), (1, "a")], "id int, v string")
    out = []
    for k, frame in enumerate((df, df.repartition(3).orderBy("v"))):
        sk.write_artifact(frame, f"{tmp_path}/w{k}", ["id"])
        out.append("".join(p.read_text() for p in sorted((tmp_path / f"w{k}").glob("part-*"))))
    assert out[0] == out[1] == '{"id":1,"v":"a"}\n{"id":2,"v":"b"}\n'
    sk.append_records(df, f"{tmp_path}/log")
    sk.append_records(df, f"{tmp_path}/log")
    assert spark.read.json(f"{tmp_path}/log").count() == 4


def test_calls_of_methods_of_nested_classes():
    source = "class A:\n    class B:\n        def f(self):\n            self.g()\n            open(self)\n\n        def g(self):\n            pass\n"
    got = sorted((c["caller"], c["enclosing"], c["text"], c["line"]) for c in pa_.calls(pa_.parse(source), "m"))
    assert got == [("m.A.B.f", "m.A.B", "open", 5), ("m.A.B.f", "m.A.B", "self.g", 4)]


def test_ledger(spark):
    steps = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "step string, input_hash string")
    ledger = lg.mark(spark.createDataFrame([], lg.SCHEMA), steps, "done", 1)
    names = lambda df: sorted(r["step"] for r in df.collect())
    assert names(lg.stale(steps, ledger)) == [] and names(lg.stale(steps, ledger, fresh=True)) == ["a", "b", "c"]
    assert names(lg.stale(steps, lg.mark(ledger, steps.where("step = 'b'"), "failed", 2), forced=["c"])) == ["b", "c"]
    assert names(lg.stale(steps.withColumn("input_hash", F.when(F.col("step") == "a", "2").otherwise(F.col("input_hash"))), ledger)) == ["a"]


def test_batches_stop_after_a_whole_batch(spark):
    rows = spark.createDataFrame([(i, i % 2 == 0) for i in range(10)], "ord long, good boolean")
    assert sorted(r["ord"] for r in lg.batches_until(rows, "ord", "good", 4, 3, 100).where("ran").collect()) == list(range(8))


def test_specifications(spark):
    df = spark.createDataFrame([({"a": 1}, [{"x": 1, "y": [1, 2]}, {"x": 5, "y": [3]}])], "m map<string,int>, l array<struct<x:int,y:array<int>>>").withColumn("r", F.struct("m", "l"))
    value = lambda s, c="r": sp.project(df, c, s).first()["result"]
    assert value("l.*.x") == [1, 5] and value("m.a") == 1 and value("l.-1.x") == 5
    assert value(("l", [sp.Where(lambda e: e["x"] > 3, "x")])) == [5] and value(("l", [sp.Where(lambda e: e["x"] < 3, "x", sp.STOP)])) == [1]
    assert value(sp.Coalesce(("l.7.x", "l.0.x"))) == 1 and value(sp.Coalesce(("l.7.x",), default=9)) == 9
    assert value(("l.*.y", sp.Flatten())) == [1, 2, 3] and value(sp.Sum("l.*.x")) == 6
    with pytest.raises(Exception, match="check failed: big"):
        value(sp.Check({"big": lambda r: r["m"]["a"] > 3}))
    with pytest.raises(ValueError, match="negative"):
        sp.Flatten(levels=-1)
    assert sp.parse_path(r"a.b\.c.0.*") == ["a", "b.c", 0, "*"] and sp.starts_with("a.b.c", "a.b")


def test_git_sources(spark, tmp_path):
    import subprocess

    from tessera.sources import gitlog as gl

    repo = str(tmp_path / "r")
    run = lambda *a: subprocess.run(["git", "-C", repo, "-c", "user.name=a", "-c", "user.email=a@example.org", *a], check=True, capture_output=True)
    subprocess.run(["git", "init", "-q", repo], check=True)
    for k, text in enumerate(("one\n", "one\ntwo\n", "two\n")):
        (tmp_path / "r" / "a.py").write_text(text)
        run("add", "-A")
        run("commit", "-qm", f"Change {k} (#{k})\n\nbody")
    spark.dataSource.register(gl.GitLog)
    raw = spark.read.format("gitlog").option("partitionSize", 2).load(repo)
    got = rd.commit_record(raw, "^setup.py$").orderBy("ord").collect()
    assert [(r["ord"], r["pr_number"], r["insertions"], r["deletions"], list(r["files_changed"])) for r in got] == [(0, 2, 0, 1, ["a.py"]), (1, 1, 1, 0, ["a.py"]), (2, 0, 1, 0, ["a.py"])]
    assert gl.show(repo, "HEAD~1", "a.py") == "one\ntwo\n" and gl.show(repo, "HEAD", "b.py") is None and dict(gl.tree(repo, "HEAD")) == {"a.py": "two\n"}
    assert "+two" in gl.diff(repo, "HEAD~2", "HEAD") and gl.export_commits(repo, "HEAD", f"{tmp_path}/log.jsonl") == 3
    assert rd.read_commits(spark, f"{tmp_path}/log.jsonl").count() == 3


def test_configuration_files(one):
    from tessera.sources import gitlog as gl

    assert json.loads(one(gl.toml_json(F.lit("[a]\nb = [1, 2]")))) == {"a": {"b": [1, 2]}} and one(gl.toml_json(F.lit("= x"))) is None
    assert json.loads(one(gl.ini_json(F.lit("[metadata]\nname = x")))) == {"metadata": {"name": "x"}} and one(gl.ini_json(F.lit("x"))) is None


def test_tools_and_command_line(spark, capsys, tmp_path):
    from tessera import cli
    from tessera.plans import tools as tl

    files = tl.file_tools(spark.createDataFrame([("a.py", "x = 1\ny = 2\nx = 3")], "path string, content string"))
    assert [r["no"] for r in files["grep"](pattern="^x").collect()] == [1, 3] and files["read_file"](path="a.py", first=2, last=2).first()["text"] == "y = 2"
    with pytest.raises(TypeError, match="missing"):
        files["read_file"]()
    cli.main(["a.b", '{"a": {"b": [1, 2]}}', "--indent", "0"])
    cli.main(['{"x": "a.0", "y": "none"}', "{'a': ['s']}", "--target-format", "python"])
    cli.main(["a", "a = 's'", "--target-format", "toml", "--scalar"])
    assert capsys.readouterr().out.split("\n")[:1] == ["[1, 2]"]
    with pytest.raises(SystemExit):
        cli.load("", "xml")
