"""Operator 13: scoring of texts by a Brown class-based bigram model, trained here on the corpus by exchange clustering.

Tokens are a text's words and one end. A token's probability after another is that of its class after the other's class
times its own in its class:

    p(w | v) = (N(cv, cw) + PRIOR * p(cw)) / (N(cv) + PRIOR) * p(w in cw)        p(c) = (N(c) + 1) / (N + classes)

Words of a relative frequency of FREQUENT and more, at most 1 / FREQUENT of them, are the frequent words. They are dealt over CLASSES
classes by exchange: in each round a share of the words is tried in every class, and a word moves where the likelihood
of the class bigrams grows most. All moves of a round are judged against the same counts, so the result does not depend on
how rows are partitioned; a round that lowers the likelihood is taken back. Every other word belongs to the open class of
its shape, as do words that training has not seen: there a word has its count, and the unseen together one more
than the words seen once. The end has a class of its own. The probabilities of all known words, the end, and the unseen of each shape
sum to one after every token.

All counts cover the whole training text: words and pairs of words are counted by task and added up by key. Broadcast are the
frequent words with their numbers, at most 1 / FREQUENT of them, and the classes' counts. Counts of all other words stay tables, which the
words of the scored texts join, document by document, at one row per word and document.

Defined cases: null and empty texts are their end alone; a null id counts as the empty text, which is a training text; texts of any
length are read whole, at a few times their size in memory; repeated rows are trained on and scored each; ties of the
exchange go to the lower class, of equally frequent words to the smaller one; without a training text every count is 0
and the same formulas hold; an empty table gives an empty table; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BATCH_ROWS, bound_batches, cut_table, slices, table, tree_sum

#: Relative frequency from which a word is dealt over the classes; its reciprocal bounds their number.
FREQUENT = 2.0**-18
#: Classes of frequent words, rounds of exchange, share of the words that a round tries, weight of a class's own probability.
CLASSES, ROUNDS, SHARES, PRIOR = 64, 12, 4, 16.0
#: Training takes the documents whose crc32 of the id modulo HOLD is not HELD.
HOLD, HELD = 7, 2
#: Words and pairs that a task counts before it passes them on: they bound memory, not results.
COUNT_ROWS, PAIRS_HELD = 400_000, 2_000_000

#: Open classes: letters, with a digit, before a full stop, before another stop, other signs. Then comes the end's class.
SHAPES = 5
END = SHAPES


class Tokens:
    """The words of a slice of texts: its distinct words, and of each token, text after text, its text and its place among them.

    Arrow knows A to Z and ASCII blanks only in these functions, as is wanted here.
    """

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        text, flat = pc.list_parent_indices(lists), lists.flatten()
        there = pc.greater(pc.binary_length(flat), 0)  # blanks at either side of a text leave an empty word
        coded = flat.filter(there).dictionary_encode()
        self.texts, self.text = len(texts), text.filter(there).to_numpy()
        self.code, self.words = coded.indices.to_numpy(), coded.dictionary

    def numbered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts' token numbers one after another, each text closed by END, and the text of each."""
        n = np.bincount(self.text, minlength=self.texts)
        ends = np.cumsum(n + 1) - 1
        out, text = np.empty(len(self.code) + self.texts, np.int64), np.repeat(np.arange(self.texts), n + 1)
        word = np.ones(len(out), bool)
        word[ends] = False
        out[ends], out[word] = END, numbers[self.code]
        return out, text


def shapes(words: pa.Array) -> np.ndarray:
    """Open class of each word by its last sign, then by what it holds."""
    last = pc.utf8_slice_codeunits(words, -1)
    of = lambda values: values.to_numpy(zero_copy_only=False)
    stop, pause = (of(pc.is_in(last, pa.array(list(signs)))) for signs in (".!?", ",;:"))
    return np.select([stop, pause, of(pc.ascii_is_alpha(words)), of(pc.match_substring_regex(words, "[0-9]"))], [2, 3, 0, 1], 4)


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % HOLD == HELD


def count_words(texts: DataFrame) -> DataFrame:
    """word (empty: the end), shape int, n long of the texts of a one-column table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        ends, held, kept = 0, 0, 0

        def merged() -> pa.Table:
            made = pa.concat_tables(waiting).group_by("word").aggregate([("n", "sum")])
            return pa.table({"word": made.column("word"), "n": made.column("n_sum")})

        def out(made: pa.Table) -> Iterator[pa.RecordBatch]:
            for part in made.combine_chunks().to_batches(max_chunksize=COUNT_ROWS):
                of = np.where(pc.binary_length(part.column(0)).to_numpy() == 0, END, shapes(part.column(0)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(of.astype(np.int32)), part.column(1)], names=["word", "shape", "n"])

        for batch in batches:
            for part in slices(batch, BATCH_ROWS):
                t = Tokens(part.column(0))
                waiting.append(pa.table({"word": t.words, "n": np.bincount(t.code, minlength=len(t.words))}))
                ends, held = ends + t.texts, held + len(t.words)
                if held > max(COUNT_ROWS, 2 * kept):
                    waiting = [merged()]
                    held = kept = len(waiting[0])
                    if kept > 2 * COUNT_ROWS:
                        yield from out(waiting[0])
                        waiting, held, kept = [], 0, 0
        waiting.append(pa.table({"word": pa.array([""] if ends else [], pa.string()), "n": pa.array([ends] if ends else [], pa.int64())}))
        yield from out(merged())

    return texts.mapInArrow(run, "word string, shape int, n long").groupBy("word", "shape").agg(F.sum("n").alias("n"))


class Numbers:
    """Numbers of words: 0 to SHAPES - 1 any other word by shape, END the end, then the frequent words."""

    def __init__(self, words: list[str]):
        self.known = {w.encode(): END + 1 + i for i, w in enumerate(words)}

    def __call__(self, words: pa.Array) -> np.ndarray:
        at = np.fromiter(map(self.known.get, words.cast(pa.binary()).to_pylist(), repeat(-1)), np.int64, len(words))
        return np.where(at < 0, shapes(words), at)


#: Pairs of tokens travel and rest in blocks of so many records.
PAIR, PAIR_ROWS = np.dtype([("a", "<i4"), ("b", "<i4"), ("n", "<i8")]), 1_024


def _added(keys: np.ndarray, counts: np.ndarray, new: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their counts, after one more for each of the new ones."""
    found = np.sort(np.concatenate([keys[:0], *new]))
    starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.empty(0, np.int64)
    keys = np.concatenate([keys, found[starts]])
    counts = np.concatenate([counts, np.diff(np.concatenate([starts, [len(found)]]))])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else starts
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def count_pairs(texts: DataFrame, numbers) -> DataFrame:
    """pairs binary: blocks of PAIR records that tell how often token b follows token a in the texts of a one-column
    table; the end starts a text. A pair stands in one record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value
        waiting: list[np.ndarray] = []
        keys, counts, held = np.empty(0, np.int64), np.empty(0, np.int64), 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])

        for batch in batches:
            for part in slices(batch, BATCH_ROWS):
                t = Tokens(part.column(0))
                at, _ = t.numbered(number(t.words))
                waiting.append((np.concatenate([[END], at[:-1]]) << 32) | at)
                held += len(at)
                if held > max(COUNT_ROWS, len(keys)):
                    keys, counts = _added(keys, counts, waiting)
                    waiting, held = [], 0
                    if len(keys) > PAIRS_HELD:
                        yield out()
                        keys, counts = keys[:0], counts[:0]
        keys, counts = _added(keys, counts, waiting)
        yield out()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = batch.column(0).to_numpy()
            made = np.empty(len(pair), PAIR)
            made["a"], made["b"], made["n"] = pair >> 32, pair & 0xFFFFFFFF, batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array([made[i : i + PAIR_ROWS].tobytes() for i in range(0, len(made), PAIR_ROWS)], pa.binary())], names=["pairs"])

    return texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).mapInArrow(pack, "pairs binary")


def _records(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """a, b, n of the blocks of a batch."""
    made = np.frombuffer(b"".join(batch.column(0).to_pylist()), PAIR)
    return made["a"], made["b"], made["n"]


def class_pairs(pairs: DataFrame, classes: np.ndarray, k: int) -> np.ndarray:
    """How often a class follows a class: k x k numbers, exact below 2**53."""
    shared = pairs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = shared.value, np.zeros(k * k)
        for batch in batches:
            a, b, n = _records(batch)
            total += np.bincount(of[a] * k + of[b], weights=n, minlength=k * k)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    total = tree_sum(pairs.mapInArrow(run, "total binary"), np.zeros(k * k)).reshape(k, k)
    shared.destroy()
    return total


def _log_sum(x: np.ndarray) -> np.ndarray:
    """x ln x, 0 at 0."""
    return x * np.log(np.where(x > 0, x, 1.0))


def likelihood(m: np.ndarray) -> float:
    """Log likelihood of the class bigrams, but for what no exchange changes."""
    return float(_log_sum(m).sum() - _log_sum(m.sum(axis=0)).sum() - _log_sum(m.sum(axis=1)).sum())


def best_class(m: np.ndarray, own: int, left: np.ndarray, right: np.ndarray, itself: float, first: int) -> tuple[int, float]:
    """The class from `first` on in which a word of class `own` makes the likelihood of m largest, and by how much.

    left and right are its neighbours by class, itself the times that it follows itself, counted in neither.
    """
    rest = m.copy()
    rest[:, own] -= left
    rest[own, :] -= right
    rest[own, own] -= itself
    # its neighbours stay in their classes' sums wherever the word goes
    rows, cols = rest.sum(axis=1) + left, rest.sum(axis=0) + right
    after, before = left.sum() + itself, right.sum() + itself
    into = _log_sum(rest + left[:, None]) - _log_sum(rest)
    out = _log_sum(rest + right[None, :]) - _log_sum(rest)
    corner = np.arange(len(m))
    at = rest[corner, corner]
    both = _log_sum(at + left + right + itself) - _log_sum(at)
    gain = into.sum(axis=0) - into[corner, corner] + out.sum(axis=1) - out[corner, corner] + both
    gain -= _log_sum(cols + after) - _log_sum(cols) + _log_sum(rows + before) - _log_sum(rows)
    to = first + int(gain[first:].argmax())
    return to, float(gain[to] - gain[own])


def moves(pairs: DataFrame, classes: np.ndarray, m: np.ndarray, share: int, shares: int) -> list[tuple[int, int]]:
    """Words (numbers) of a share of the frequent ones that should move, and where to: at most one row per frequent word.

    A task adds a word's neighbours up by class before they are brought together, so it sends at most 2 k + 1 rows of a word.
    """
    spark = pairs.sparkSession
    shared = spark.sparkContext.broadcast((classes, m))
    k = len(m)

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, _ = shared.value
        # left neighbours, right ones and itself of each word of this share: at most 1 / frequent / shares rows
        total = np.zeros((-(-len(of) // shares), 2 * k + 1))
        for batch in batches:
            a, b, n = _records(batch)
            same = a == b
            for word, side, use in ((b, of[a], ~same), (a, k + of[b], ~same), (a, np.full(len(a), 2 * k), same)):
                use = use & (word > END) & (word % shares == share)
                at = (word[use] // shares).astype(np.int64) * (2 * k + 1) + side[use]
                np.add.at(total.reshape(-1), at, n[use])
        word, side = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array((word * shares + share).astype(np.int32)), pa.array(side.astype(np.int32)), pa.array(total[word, side].astype(np.int64))], names=["word", "side", "n"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, m = shared.value
        word, counts = -1, np.zeros(2 * k + 1)
        out: list[tuple[int, int]] = []

        def judge() -> None:
            if word >= 0:
                to, gain = best_class(m, int(of[word]), counts[:k], counts[k : 2 * k], counts[-1], END + 1)
                if to != of[word] and gain > 1e-6:
                    out.append((word, to))

        for batch in batches:
            for w, side, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if w != word:
                    judge()
                    word, counts = w, np.zeros(2 * k + 1)
                counts[side] += n
        judge()
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int32()) for i in (0, 1)], names=["word", "class"])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # dealt by word once: adding up by word and side and judging a word need no other shuffle
    added = pairs.mapInArrow(sides, "word int, side int, n long").repartition(tasks, "word").groupBy("word", "side").agg(F.sum("n").alias("n"))
    found = added.sortWithinPartitions("word", "side").mapInArrow(choose, "word int, class int").collect()
    shared.destroy()
    return sorted((r[0], r[1]) for r in found)


def exchange(pairs: DataFrame, n_words: int, k: int, rounds: int, shares: int = SHARES) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Class of each token number, counts of class pairs, and the likelihood after each round; words are given by falling frequency."""
    first = END + 1
    classes = np.concatenate([np.arange(first), first + np.arange(n_words) % k]).astype(np.int64)
    m = class_pairs(pairs, classes, first + k)
    told = [likelihood(m)]
    for r in range(rounds if n_words else 0):
        found = moves(pairs, classes, m, r % shares, shares)
        while found:
            tried = classes.copy()
            tried[[w for w, _ in found]] = [c for _, c in found]
            counted = class_pairs(pairs, tried, first + k)
            if likelihood(counted) > told[-1]:
                classes, m = tried, counted
                break
            found = found[::2] if len(found) > 1 else []  # together they went too far
        told.append(likelihood(m))
    return classes, m, told


class Model:
    """What scoring a frequent token takes, by number, and the open classes' sizes."""

    def __init__(self, counts: np.ndarray, classes: np.ndarray, m: np.ndarray, total: int, distinct: int, once: np.ndarray, open_sizes: np.ndarray, prior: float):
        k = len(m)
        size = np.bincount(classes, weights=counts, minlength=k)
        size[:SHAPES] = open_sizes
        own = (size + 1) / (total + k)
        self.classes = classes
        self.follows = np.log10((m + prior * own) / (m.sum(axis=1, keepdims=True) + prior))
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.where(size[classes] > 0, counts / size[classes], 1.0)
        share[:SHAPES] = 1.0  # comes with the word's own count
        self.emits = np.log10(share)
        self.base = np.log10((counts + 1) / (total + distinct + 1))
        self.base[:SHAPES] = 0.0
        self.end_known = bool(counts[END])
        #: An open class holds its words and, for the unseen, one more than the words seen once.
        self.unseen = once + 1.0
        self.open = open_sizes + self.unseen


def score_texts(df: DataFrame, id_col: str, text_col: str, counts: DataFrame, numbers, model: Model, total: int, distinct: int) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = "row long, doc_id long, word string, shape int, n long, n_known long, base double, score double"
    names = [f.strip().split()[0] for f in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, model = numbers.value, shared.value
        for batch in batches:
            for part in slices(batch, BATCH_ROWS):
                t, rows = Tokens(part.column(2)), part.column(0)
                of_word = number(t.words)
                at, text = t.numbered(of_word)
                step = model.emits[at] + model.follows[model.classes[np.concatenate([[END], at[:-1]])], model.classes[at]]
                known = (at > END) | ((at == END) & model.end_known)
                add = lambda values: np.bincount(text, weights=values, minlength=t.texts)  # noqa: B023, E731
                # a row for each text: no word holds a blank, so its key meets none; and a row for each of its rare words
                own = [pa.array([f" {r}" for r in rows.to_pylist()], pa.string()), pa.array(np.full(t.texts, END, np.int32))]
                values = [np.bincount(text, minlength=t.texts), add(known).astype(np.int64), add(model.base[at]), add(step)]
                yield pa.RecordBatch.from_arrays([rows, part.column(1), *own, *map(pa.array, values)], names=names)
                rare = of_word[t.code] < SHAPES
                keys, counts = np.unique(t.text[rare] * len(t.words) + t.code[rare], return_counts=True)
                n = len(keys)
                if n:
                    by_row, word = keys // len(t.words), keys % len(t.words)
                    made = [rows.take(pa.array(by_row)), pa.nulls(n, pa.int64()), t.words.take(pa.array(word)), pa.array(of_word[word].astype(np.int32)), pa.array(counts)]
                    yield pa.RecordBatch.from_arrays([*made, pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64())], names=names)

    text = F.col(f"`{text_col}`").cast("string")
    fed = df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    known = counts.where("word <> ''").select("word", F.col("n").alias("c")).hint("shuffle_hash")  # a word is one row
    rows = fed.mapInArrow(run, schema).join(known, "word", "left")
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("shape") + 1)
    whole = F.col("shape") == END
    c = F.coalesce("c", F.lit(0))
    base = F.when(whole, F.col("base")).otherwise(F.col("n") * F.log10((c + 1) / F.lit(float(total + distinct + 1))))
    score = F.when(whole, F.col("score")).otherwise(F.col("n") * F.log10(F.when(c > 0, c.cast("double")).otherwise(pick([*model.unseen, 1])) / pick([*model.open, 1])))
    summed = rows.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum(F.when(whole, F.col("n")).otherwise(0)).alias("n_tokens"),
        F.sum(F.when(whole, F.col("n_known")).when(c > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(base).alias("base_score"),
        F.sum(score).alias("score"),
    )
    return summed.select("doc_id", held_out("doc_id").alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def score_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: int = CLASSES, rounds: int = ROUNDS, frequent: float = FREQUENT, prior: float = PRIOR) -> DataFrame:
    """Train on the rows that are not held out, and score all rows of df."""
    spark = df.sparkSession
    bound_batches(spark)
    texts = df.where(~held_out(f"`{id_col}`")).select(F.col(f"`{text_col}`").cast("string").alias("text"))
    counts = cut_table(count_words(texts))
    seen = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("distinct"), F.coalesce(F.sum(F.when(F.col("shape") == END, F.col("n"))), F.lit(0)).alias("ends")).first()
    common = (F.col("shape") != END) & (F.col("n") >= F.lit(seen.total * frequent))
    head = counts.where(common).orderBy(F.desc("n"), "word").toArrow()  # at most 1 / frequent words
    rest = counts.where(~common & (F.col("shape") != END)).groupBy("shape").agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") == 1, 1)).alias("once")).collect()
    sizes, once = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in rest:
        sizes[r["shape"]], once[r["shape"]] = r["n"], r["once"]
    words = head.column("word").to_pylist()
    numbers = spark.sparkContext.broadcast(Numbers(words))
    pairs = cut_table(count_pairs(texts, numbers))
    of, m, _ = exchange(pairs, len(words), classes, rounds)
    by_number = np.concatenate([np.zeros(SHAPES), [seen.ends], head.column("n").to_numpy()]).astype(np.float64)
    model = Model(by_number, of, m, seen.total, seen.distinct, once, sizes, prior)
    others = counts.where(~common)
    return score_texts(df, id_col, text_col, others, numbers, model, seen.total, seen.distinct)


def op13_brown_lm(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document's log probability under a model of the documents that are not held out."""
    return score_corpus(table(spark, sf_dir, "documents").select("doc_id", "text"))
