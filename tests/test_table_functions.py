"""Tools as table functions."""

from __future__ import annotations

from tessera.plans import table_functions as tf


def test_graph_functions(spark):
    nodes = spark.createDataFrame([("m", "module"), ("m.f", "function"), ("m.g", "function"), ("mm.h", "function")], "id string, type string")
    edges = spark.createDataFrame([("calls", "m.f", "m.g"), ("calls", "m.f", "m.g"), ("calls", "mm.h", "m.g"), ("tested_by", "m.g", "t::a"), ("imports", "m.f", "x")], "type string, source string, target string")
    commits = spark.createDataFrame([(2, "ab1", "old"), (1, "ab2", "new"), (0, "c", "other")], "ord long, sha string, message string")
    assert tf.register_graph(spark, nodes, edges, commits, "tools_test") == list(tf.GRAPH)
    rows = lambda sql: sorted(tuple(r) for r in spark.sql(sql).collect())
    assert rows("SELECT * FROM show_symbol('m.f')") == [("m.f", "function")] and rows("SELECT * FROM show_symbol('none')") == []
    assert rows("SELECT * FROM callers('m.g')") == [("m.f",), ("mm.h",)] and rows("SELECT * FROM callees('m.f')") == [("m.g",)]
    assert rows("SELECT * FROM tests_for('m.g')") == [("t::a",)] and rows("SELECT * FROM show_commit('ab')") == [(1, "ab2", "new")]
    assert rows("SELECT * FROM module_members('m')") == [("m.f",), ("m.g",)]
    assert rows("SELECT n.id, c.source FROM tools_test_nodes n, LATERAL callers(n.id) c") == [("m.g", "m.f"), ("m.g", "mm.h")]
    plan = spark.sql("SELECT n.id, c.source FROM tools_test_nodes n, LATERAL callers(n.id) c")._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Python" not in plan and "Cartesian" not in plan


def test_file_functions(spark):
    spark.createDataFrame([("x", "a\nb\naa\nca"), ("y", "za"), ("z", None)], "path string, content string").createOrReplaceTempView("files_test")
    assert tf.register_files(spark) == ["grep_file", "read_file"]
    rows = lambda sql: sorted(tuple(r) for r in spark.sql(sql).collect())
    assert rows("SELECT * FROM grep_file(TABLE(files_test) PARTITION BY (path), 'a', 2)") == [("x", 1, "a"), ("x", 3, "aa"), ("y", 1, "za")]
    assert rows("SELECT * FROM read_file(TABLE(files_test) PARTITION BY (path), 2, 3)") == [("x", 2, "b"), ("x", 3, "aa")]
