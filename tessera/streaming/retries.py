"""Bounded retries with feedback as streams: what a gate rejects is asked again with the reason, up to a bound.

Tasks and requests for another attempt come in as files. One query (`ask`) has them answered by the caller's function
and gated, each micro-batch in a folder of its own. Another (`decide`) keeps a task's attempts, cost and status as keyed
state and says of each answer: final, retry with the reason as feedback, or failed. A retry is the next request.

Both queries restart from their checkpoints. A micro-batch that ended is not answered again, even if its query was
killed before Spark noted its end: its folder is complete. One that was killed half-way is answered again under the same
keys (task, attempt), by which a paid service knows a repeated call; the answers that were written in part count once,
as a task's state passes over attempts that it has seen.

State is one small row per task. A micro-batch of one task's answers is read in one pass that keeps at most
`attempts` of them, so a task with very many answers takes no more memory than one with few. Tasks that wait for an
answer longer than `patience_ms` fail when the timer of their state runs out.

Defined cases: a null task takes no part; answers after a decision that is final or failed are dropped; a null cost is 0; a null issue is no
issue, an empty one is; of equal (task, attempt) one counts, the one with the smaller issue (null first).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import nsmallest

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

ANSWERS = "task string, attempt int, issue string, cost double, payload string"
DECISIONS = "task string, attempt int, status string, feedback string, spent double, payload string"
REQUESTS = "task string, attempt int, feedback string"

#: Answers to one (task, attempt, feedback): issue (null: accepted), cost, payload.
Answer = Callable[[str, int, str | None], tuple[str | None, float, str | None]]


def status_of(attempt: int, issue: str | None, spent: float, attempts: int, budget: float | None) -> tuple[str, str | None]:
    """Status after an answer, and what the next attempt, or the reader, is told."""
    if issue is None:
        return "final", None
    if attempt >= attempts:
        return "failed", issue
    if budget is not None and spent >= budget:
        return "failed", "budget spent"
    return "retry", issue


class Attempts(StatefulProcessor):
    """Keyed state of one task: the attempt it is at, what it spent, and whether it is open."""

    def __init__(self, attempts: int, budget: float | None, patience_ms: int | None):
        self.attempts, self.budget, self.patience_ms = attempts, budget, patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("task", "attempt int, spent double, status string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        at, spent, status = self.state.get() or (0, 0.0, "retry")
        out = []
        if status == "retry":
            order = lambda r: (r[0], r[1] is not None, r[1] or "")
            first: dict[int, tuple] = {}
            for pdf in rows:
                pdf = pdf.astype(object).where(pdf.notna(), None)
                for r in pdf[["attempt", "issue", "cost", "payload"]].itertuples(index=False, name=None):
                    if r[0] is not None and r[0] > at and (r[0] not in first or order(r) < order(first[r[0]])):
                        first[r[0]] = r
                if len(first) > self.attempts:
                    first = {k: first[k] for k in nsmallest(self.attempts, first)}
            for attempt, issue, cost, payload in sorted(first.values(), key=order):
                at, spent = int(attempt), spent + (cost or 0.0)
                status, feedback = status_of(at, issue, spent, self.attempts, self.budget)
                out.append((key[0], at, status, feedback, spent, payload))
                if status != "retry":
                    break
            self.state.update((at, spent, status))
            if self.patience_ms is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                if status == "retry":
                    self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience_ms)
        yield pd.DataFrame(out, columns=["task", "attempt", "status", "feedback", "spent", "payload"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        at, spent, status = self.state.get()
        out = []
        if status == "retry":
            self.state.update((at, spent, "failed"))
            out.append((key[0], at, "failed", "no answer", spent, None))
        yield pd.DataFrame(out, columns=["task", "attempt", "status", "feedback", "spent", "payload"])

    def close(self) -> None:
        pass


def decide(answers: DataFrame, attempts: int, budget: float | None = None, patience_ms: int | None = None) -> DataFrame:
    """DECISIONS for a stream of ANSWERS, in the order of a task's attempts. The session's state store is RocksDB."""
    keyed = answers.where("task IS NOT NULL").groupBy("task")
    return keyed.transformWithStateInPandas(Attempts(attempts, budget, patience_ms), outputStructType=DECISIONS, outputMode="Append", timeMode="ProcessingTime" if patience_ms is not None else "None")


def decide_table(answers: DataFrame, attempts: int, budget: float | None = None) -> DataFrame:
    """The same decisions for a whole table of answers, by windows."""
    task = Window.partitionBy("task")
    first = answers.where("task IS NOT NULL AND attempt > 0").withColumn("__rn", F.row_number().over(Window.partitionBy("task", "attempt").orderBy(F.col("issue").asc_nulls_first(), "cost", "payload")))
    so_far = task.orderBy("attempt").rowsBetween(Window.unboundedPreceding, 0)
    got = first.where("__rn = 1").withColumn("spent", F.sum(F.coalesce("cost", F.lit(0.0))).over(so_far))
    over = F.col("spent") >= F.lit(budget) if budget is not None else F.lit(False)
    status = F.when(F.col("issue").isNull(), "final").when((F.col("attempt") >= attempts) | over, "failed").otherwise("retry")
    feedback = F.when((F.col("attempt") < attempts) & F.col("issue").isNotNull() & over, "budget spent").otherwise(F.col("issue"))
    got = got.withColumn("status", status).withColumn("feedback", feedback)
    closed = F.coalesce(F.count_if(F.col("status") != "retry").over(task.orderBy("attempt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return got.withColumn("__closed", closed).where("__closed = 0").select("task", "attempt", "status", "feedback", "spent", "payload")


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a job that wrote to a folder ended."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def write_batches(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """What is there now of a stream, each micro-batch in its folder path/batch=id, written once.

    With `every` it goes on until it is stopped. Decisions with a patience need that: while timers may run out, Spark
    has always another micro-batch.
    """
    spark = stream.sparkSession

    def sink(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch={batch_id}"
        if not complete(spark, folder):
            batch.write.mode("overwrite").parquet(folder)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def ask(requests: DataFrame, answer: Answer, path: str, checkpoint: str) -> StreamingQuery:
    """Requests answered once each; a failing call is an answer with the error as its issue."""

    def answered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for task, attempt, feedback in pdf.astype(object).where(pdf.notna(), None).itertuples(index=False, name=None):
                try:
                    issue, cost, payload = answer(task, attempt, feedback)
                except Exception as error:  # noqa: BLE001 - whatever a service raises is told to the next attempt
                    issue, cost, payload = f"{type(error).__name__}: {error}", 0.0, None
                out.append((task, attempt, issue, cost, payload))
            yield pd.DataFrame(out, columns=["task", "attempt", "issue", "cost", "payload"])

    return write_batches(requests.select("task", "attempt", "feedback").mapInPandas(answered, ANSWERS), path, checkpoint)


def requests_of(spark: SparkSession, tasks: str, folder: str, done: DataFrame | None = None, files_per_batch: int = 100) -> DataFrame:
    """A stream of REQUESTS: the first attempt of each task in JSON files (task string), but those with a decision in
    `done`, and the next attempt of each retry."""
    read = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    new = read.schema("task string").json(tasks).where("task IS NOT NULL")
    new = new if done is None else new.join(done.select("task"), "task", "left_anti")
    again = read.schema(DECISIONS).parquet(f"{folder}/decisions/batch=*").where("status = 'retry'")
    return new.selectExpr("task", "1 AS attempt", "CAST(NULL AS string) AS feedback").unionByName(again.selectExpr("task", "attempt + 1 AS attempt", "feedback"))


def prepare(spark: SparkSession, folder: str) -> None:
    """Empty folders of answers and decisions, where there are none yet."""
    spark.createDataFrame([], DECISIONS).write.mode("ignore").parquet(f"{folder}/decisions/batch=start")
    spark.createDataFrame([], ANSWERS).write.mode("ignore").parquet(f"{folder}/answers/batch=start")


def settle(spark: SparkSession, tasks: str, folder: str, answer: Answer, attempts: int, budget: float | None = None, done: DataFrame | None = None) -> DataFrame:
    """All decisions on the tasks that are there now: at most `attempts` rounds of the two queries, in `folder`.

    Called again, after a crash or for new tasks, it goes on where the checkpoints are.
    """
    prepare(spark, folder)
    for _ in range(attempts):
        asked = ask(requests_of(spark, tasks, folder, done), answer, f"{folder}/answers", f"{folder}/checkpoints/ask")
        asked.awaitTermination()
        answers = spark.readStream.schema(ANSWERS).parquet(f"{folder}/answers/batch=*")
        decided = write_batches(decide(answers, attempts, budget), f"{folder}/decisions", f"{folder}/checkpoints/decide")
        decided.awaitTermination()
        if not any(p.numInputRows for q in (asked, decided) for p in q.recentProgress):
            break
    return spark.read.schema(DECISIONS).parquet(f"{folder}/decisions/batch=*")
