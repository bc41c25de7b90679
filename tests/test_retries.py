"""Bounded retries: streams against a plain loop and against the windowed form, killed and restarted."""

from __future__ import annotations

import json
import time
from pathlib import Path

import pytest

from tessera.streaming import retries as rt

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TASKS = [f"t{i}" for i in range(8)]


def plain(task, attempt, feedback):
    """Task i is accepted at attempt i mod 5 + 1, if it was told why the last one failed; task 7 always raises."""
    i = int(task[1:])
    if i == 7:
        raise ValueError("no service")
    if attempt > 1 and feedback != f"issue {attempt - 1}":
        return "feedback lost", 1.0, None
    return (None if attempt == i % 5 + 1 else f"issue {attempt}"), float(i), f"p{attempt}"


def loop(attempts, budget):
    out = []
    for task in TASKS:
        spent, feedback = 0.0, None
        for attempt in range(1, attempts + 1):
            try:
                issue, cost, payload = plain(task, attempt, feedback)
            except ValueError as e:
                issue, cost, payload = f"ValueError: {e}", 0.0, None
            spent += cost
            status, feedback = rt.status_of(attempt, issue, spent, attempts, budget)
            out.append((task, attempt, status, feedback, spent, payload))
            if status != "retry":
                break
    return sorted(out, key=repr)


@pytest.fixture
def store(spark):
    new = {"spark.sql.streaming.stateStore.providerClass": STORE, "spark.sql.shuffle.partitions": "1"}
    old = {key: spark.conf.get(key) for key in new}
    for key, value in new.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in old.items():
        spark.conf.set(key, value)


def _tasks(path: Path, names, part="a"):
    path.mkdir(exist_ok=True)
    (path / f"{part}.json").write_text("\n".join(json.dumps({"task": t}) for t in names))
    return str(path)


def _logged(log: str):
    def answer(task, attempt, feedback):
        with open(f"{log}/{task}-{attempt}-{time.time_ns()}", "w"):
            pass
        return plain(task, attempt, feedback)

    return answer


def test_settle_survives_a_kill(store, tmp_path):
    """Killed after a micro-batch's answers were written and before its end was noted: nothing is asked twice."""
    log = tmp_path / "log"
    log.mkdir()
    tasks, folder = _tasks(tmp_path / "tasks", TASKS), str(tmp_path / "run")
    rt.prepare(store, folder)
    rt.ask(rt.requests_of(store, tasks, folder), _logged(str(log)), f"{folder}/answers", f"{folder}/checkpoints/ask").awaitTermination()
    assert len(list(log.iterdir())) == len(TASKS)
    noted = tmp_path / "run" / "checkpoints" / "ask" / "commits"
    for name in ("0", ".0.crc"):
        (noted / name).unlink()
    got = sorted((tuple(r) for r in rt.settle(store, tasks, folder, _logged(str(log)), 2, 5.0).collect()), key=repr)
    assert got == loop(2, 5.0)
    calls = [p.name.rsplit("-", 1)[0] for p in log.iterdir()]
    assert sorted(calls) == sorted(f"{t}-{a}" for t, a, *_ in got)
    # called again it asks nothing; new tasks alone are asked, without those decided elsewhere
    _tasks(tmp_path / "tasks", ["t100", "t3"], "b")
    done = store.createDataFrame([("t3",)], "task string")
    again = rt.settle(store, tasks, folder, _logged(str(log)), 2, 5.0, done)
    assert again.count() == len(got) + 1 and again.where("task = 't100' AND status = 'final'").count() == 1
    assert len(list(log.iterdir())) == len(calls) + 1


def _answers(spark):
    rows = [("a", 2, "y", 1.0, "p2"), ("a", 1, "x", None, "p1"), ("a", 3, None, 1.0, "p3"), ("a", 4, None, 1.0, "late"), ("b", 1, None, 0.0, None), (None, 1, None, 0.0, None)]
    rows += [("c", i, "no", 4.0, None) for i in range(1, 9)] + [("d", 1, "", 0.0, "q"), ("d", 1, None, 0.0, "r"), ("e", 1, "z", 30.0, None)]
    return spark.createDataFrame(rows, rt.ANSWERS)


def test_stream_equals_table(store, tmp_path):
    src = str(tmp_path / "in")
    _answers(store).coalesce(1).write.parquet(src)
    stream = rt.decide(store.readStream.schema(rt.ANSWERS).parquet(src), 4, 20.0)
    rt.write_batches(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = sorted((tuple(r) for r in store.read.schema(rt.DECISIONS).parquet(f"{tmp_path}/out/batch=*").collect()), key=repr)
    want = sorted((tuple(r) for r in rt.decide_table(_answers(store), 4, 20.0).collect()), key=repr)
    assert got == want
    assert [(r[0], r[2], r[3]) for r in want if r[2] != "retry"] == [("a", "final", None), ("b", "final", None), ("c", "failed", "no"), ("d", "final", None), ("e", "failed", "budget spent")]
    assert rt.decide_table(_answers(store).limit(0), 4).count() == 0


def test_silence_fails(store, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    store.createDataFrame([("a", 1, "x", 1.0, None), ("b", 1, None, 1.0, None)], rt.ANSWERS).coalesce(1).write.parquet(src)
    stream = rt.decide(store.readStream.schema(rt.ANSWERS).parquet(src), 4, None, patience_ms=1)
    query = rt.write_batches(stream, out, str(tmp_path / "check"), every="1 second")
    got, end = [], time.time() + 40
    while len(got) < 3 and time.time() < end:
        query.awaitTermination(1)
        done = [str(p) for p in Path(out).glob("batch=*") if (p / "_SUCCESS").exists()]
        got = sorted((r["task"], r["status"], r["feedback"]) for r in store.read.schema(rt.DECISIONS).parquet(*done).collect()) if done else []
    query.stop()
    assert got == [("a", "failed", "no answer"), ("a", "retry", "x"), ("b", "final", None)]
