"""Operator 10: SimHash near-duplicates, linked by covering locality-sensitive hashing.

Each fingerprint bit i is dealt a vector m(i) of radius + 1 bits. The table of a non-zero vector v keeps the
bits with <m(i), v> = 1. Any `radius` bits have vectors of rank <= radius, so some v is orthogonal to all of
them and its table hides every differing bit: each pair within the radius meets in a table, with certainty.

Equal fingerprints are one node, so copies cost nothing. Within a table's bucket the links are reduced to a
spanning forest while they are found: never all pairs of a group. Buckets beyond BUCKET_ROWS are dealt over
pairs of blocks, so no task holds an unbounded group, and nothing is capped. Joins of fingerprints are by merging: a broadcast
would build its side in the driver.

Defined cases: null and empty texts, and texts of white space, have fingerprint zero and link like any other;
fewer words than a shingle are one shingle; repeated rows keep their rows; an empty table gives an empty
table; rows with a null id keep their fingerprint, join their group and never name it (a group of such rows
only has a null id).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import add_columns, cut
from tessera.llm.components import components

#: Fingerprints of a bucket compared in one block; larger buckets are dealt over pairs of blocks.
BUCKET_ROWS = 8_192
#: Rows of all tables that a task makes.
TASK_ROWS = 500_000
#: Tables that are searched first.
TABLES_AT_ONCE = 31
BITS = 64
#: Characters of a candidate group's texts that are compared in one block; larger groups are dealt over pairs of blocks.
BLOCK_CHARS = 16_000_000
#: Shingles that are looked up at a time.
LOOKUPS = 4_000_000


def shingles(text: str, words: int) -> list[bytes]:
    """Word shingles of the ASCII-lower-cased text; fewer words than a shingle are one shingle."""
    parts = text.encode().lower().split()
    if not parts:
        return []
    whole = b" ".join(parts)
    n = len(parts)
    if n <= words:
        return [whole]
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, n) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: n - words + 1]
    return [whole[a:b] for a, b in zip(starts.tolist(), (ends[words - 1 :] - 1).tolist(), strict=True)]


def fingerprint(text: str | None, words: int, seed: int) -> int:
    """Bit i is set if it is set in over half the shingles' XXH64."""
    from xxhash import xxh64_intdigest

    parts = shingles(text or "", words)
    if not parts:
        return 0
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(parts), 65_536):
        h = np.fromiter((xxh64_intdigest(p, seed) for p in parts[at : at + 65_536]), np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > len(parts)).tolist())


def fingerprints(df: DataFrame, text: Column | str = "text", words: int = 5, seed: int = 42, out: str = "fp") -> DataFrame:
    """df plus out long: the 64-bit fingerprint of each whole text, as a signed number."""
    text = F.col(text) if isinstance(text, str) else text

    def make():
        return lambda texts: [[f - (1 << 64) if f >> 63 else f for f in (fingerprint(t, words, seed) for t in texts)]]

    return add_columns(df, [text], [T.StructField(out, T.LongType(), False)], make)


def bit_vectors(width: int, bits: int = BITS) -> list[int]:
    """The vector dealt to each bit: such that every table keeps about half the bits.

    Up to six dimensions the non-zero vectors take turns. Beyond, bit i has a one, the six digits of i, the bent
    function i0 i1 + i2 i3 + i4 i5, and hashed digits for the rest: the tables are then words of the first-order
    Reed-Muller code and its cosets, of 28 to 36 bits (one keeps all 64).
    """
    if width <= 6:
        return [i % ((1 << width) - 1) + 1 for i in range(bits)]
    out = []
    for i in range(bits):
        bent = (i & i >> 1 & 1) ^ (i >> 2 & i >> 3 & 1) ^ (i >> 4 & i >> 5 & 1)
        mixed = (i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
        more = (mixed ^ mixed >> 29) * 0xBF58476D1CE4E5B9 >> 23 & 0xFFFFFFFF
        out.append((64 | i % 64 | bent << 7 | more << 8) & ((1 << width) - 1))
    return out


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """2 ** (radius + 1) - 1 masks such that any `radius` bits are all hidden by one of them."""
    width = radius + 1
    m = bit_vectors(width, bits)
    return [sum(1 << i for i in range(bits) if (m[i] & v).bit_count() % 2) for v in range(1, 1 << width)]


def _forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[list[int], list[int]]:
    """Edges of a spanning forest of the links within a (b None), or between a and b. Values are distinct in each.

    Breadth first over what is unvisited: a value leaves the pool when it is reached, so a dense group costs
    little more than its size.
    """
    left, right = [], []
    if b is None:
        pool = a.copy()
        while len(pool):
            queue, pool = [pool[0]], pool[1:]
            while queue and len(pool):
                x = queue.pop()
                near = np.bitwise_count(pool ^ x) <= radius
                if near.any():
                    got = pool[near]
                    pool = pool[~near]
                    left += [int(x)] * len(got)
                    right += got.tolist()
                    queue += list(got)
        return left, right
    pools = [a.copy(), b.copy()]
    while len(pools[0]):
        queue, pools[0] = [(0, pools[0][0])], pools[0][1:]
        while queue:
            side, x = queue.pop()
            other = pools[1 - side]
            near = np.bitwise_count(other ^ x) <= radius
            if near.any():
                got = other[near]
                pools[1 - side] = other[~near]
                left += [int(x)] * len(got)
                right += got.tolist()
                queue += [(1 - side, y) for y in got]
    return left, right


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Spanning links, between different roots, of the groups in sorted rows (key, i, j, block, fp, root); a group may
    run over batches."""
    carry: pa.Table | None = None
    names = ["key", "i", "j"]

    def solve(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        cols = [rows.column(n).to_numpy() for n in names]
        fp, block, root = rows.column("fp").to_numpy().view(np.uint64), rows.column("block").to_numpy(), rows.column("root").to_numpy()
        new = np.ones(len(fp), bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(fp)))
        lefts, rights = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        # groups of a few rows, the bulk, all at once: each row against the next, the one after, ...
        few = sizes <= 16
        row_group = np.repeat(np.arange(len(starts)), sizes)
        small = np.flatnonzero(few[row_group] & (cols[1] == cols[2]))
        f, g, r = fp[small], row_group[small], root[small]
        for d in range(1, 16):
            if len(f) <= d:
                break
            hit = (g[d:] == g[:-d]) & (r[d:] != r[:-d]) & (np.bitwise_count(f[d:] ^ f[:-d]) <= radius)
            lefts.append(r[:-d][hit])
            rights.append(r[d:][hit])
        for k in np.flatnonzero(~few | (cols[1][starts] != cols[2][starts])).tolist():
            at = slice(starts[k], starts[k] + sizes[k])
            if (root[at] == root[at.start]).all():
                continue
            if cols[1][at.start] == cols[2][at.start]:
                x, y = _forest(fp[at], None, radius)
            else:
                own = block[at] == cols[1][at.start]
                x, y = _forest(fp[at][own], fp[at][~own], radius)
            order = np.argsort(fp[at], kind="stable")
            to_root = lambda v: root[at][order][np.searchsorted(fp[at][order], np.array(v, np.uint64))]  # noqa: E731, B023
            x, y = to_root(x), to_root(y)
            lefts.append(x[x != y])
            rights.append(y[x != y])
        return np.concatenate(lefts), np.concatenate(rights)

    def out(rows: pa.Table) -> pa.RecordBatch:
        a, b = solve(rows)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if carry is None else pa.concat_tables([carry, rows]).combine_chunks()
        cols = [rows.column(n).to_numpy() for n in names]
        same = np.all([c == c[-1] for c in cols], axis=0)
        last = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        carry = rows.slice(last)
        if last:
            yield out(rows.slice(0, last).combine_chunks())
    if carry is not None:
        yield out(carry.combine_chunks())


def links(nodes: DataFrame, radius: int, bucket_rows: int = BUCKET_ROWS, first: int = 0, last: int | None = None) -> DataFrame:
    """a, b: pairs of roots that links within the radius, found in tables first..last, connect.

    nodes has fp (each once) and root (what it is known to be connected with, at first itself).
    """
    kept = covering_masks(radius)[first:last]
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in kept])
    # few fingerprints make many rows: tasks of a bounded number of rows keep the counting in memory
    parts = max(1, -(-nodes.count() * len(kept) // TASK_ROWS))
    tables = nodes.select("fp", "root").repartition(parts, "fp").select("fp", "root", F.explode(F.sequence(F.lit(0), F.lit(len(kept) - 1))).alias("v"))
    # a bucket goes by the hash of its table and its kept bits; buckets that share a hash are compared together
    bucket = F.xxhash64("v", F.col("fp").bitwiseAND(F.element_at(masks, F.col("v") + 1)))
    # of use are only buckets that hold different roots
    sizes = tables.groupBy(bucket.alias("key")).agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key", "n")
    blocks = F.ceil(F.col("n") / F.lit(bucket_rows)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    met = tables.select("fp", "v").join(sizes.hint("merge"), bucket == F.col("key")).withColumn("blocks", blocks).withColumn("block", own).join(nodes.select("fp", "root").hint("merge"), "fp")
    dealt = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "fp", "root")
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = dealt.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j", "fp")
    return sorted_rows.mapInArrow(lambda it: _links(it, radius), "a long, b long")


def connect(distinct: DataFrame, radius: int, bucket_rows: int = BUCKET_ROWS, step: int = TABLES_AT_ONCE) -> DataFrame:
    """fp, root: each fingerprint (once) with a number that it shares with those that links reach.

    The first tables are searched apart: what they connect, the others need not link again, so that a dense group does
    not cost its size in links once for every table. Roots are small numbers, which cost few bytes in a shuffle.
    """
    nodes = cut(distinct.select("fp", F.monotonically_increasing_id().alias("root")))
    tables = (1 << (radius + 1)) - 1
    for first, last in ((0, min(step, tables)), (step, tables)):
        if first < last:
            found = components(links(nodes, radius, bucket_rows, first, last)).withColumnRenamed("root", "to")
            nodes = cut(nodes.join(found.hint("merge"), nodes.root == found.node, "left").select("fp", F.coalesce("to", "root").alias("root")))
    return nodes


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: Column | str = "text", words: int = 5, seed: int = 42, radius: int = 4) -> DataFrame:
    """doc_id, fp, component_id per row of df."""
    text = F.col(text) if isinstance(text, str) else text
    prints = cut(fingerprints(df.select(F.col(id_col).alias("doc_id"), text.alias("text")), "text", words, seed).drop("text"))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    rooted = distinct.join(connect(distinct, radius).hint("merge"), "fp").select("fp", "least", "root")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named.hint("merge"), "root").select("fp", "component_id")
    return prints.join(classes.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def shingle_set(text: str | None, words: int, seed: int) -> np.ndarray:
    """The distinct XXH64 of a text's shingles, sorted."""
    from xxhash import xxh64_intdigest

    return np.unique(np.fromiter((xxh64_intdigest(p, seed) for p in shingles(text or "", words)), np.uint64))


def similar_forest(sets: list[np.ndarray], fp: np.ndarray, side: np.ndarray | None, radius: int, least: tuple[int, int]) -> tuple[list[int], list[int]]:
    """Edges, as positions, of a spanning forest of the pairs within the radius whose sets have at least the Jaccard
    similarity least (a fraction); of pairs of different sides only, if sides are given.

    Breadth first as in _forest: what is reached leaves the pool.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(sizes)
    values, flat = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_inverse=True)
    marked = np.zeros(len(values), bool)
    share = least[0] + least[1]

    def alike(x: int, others: np.ndarray) -> np.ndarray:
        own = flat[ends[x] - sizes[x] : ends[x]]
        marked[own] = True
        common = np.array([np.count_nonzero(marked[flat[ends[y] - sizes[y] : ends[y]]]) for y in others.tolist()], np.int64) if len(others) < 8 else _counts(others)
        marked[own] = False
        # |x & y| / |x | y| >= least, two empty sets being alike
        return common * share >= least[0] * (sizes[x] + sizes[others])

    def _counts(others: np.ndarray) -> np.ndarray:
        out = np.zeros(len(others), np.int64)
        total = np.cumsum(sizes[others])
        at = 0
        while at < len(others):
            done = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + LOOKUPS, "right")))
            part = others[at:to]
            n = sizes[part]
            where = np.repeat(ends[part] - np.cumsum(n), n) + np.arange(n.sum())
            out[at:to] = np.bincount(np.repeat(np.arange(len(part)), n), weights=marked[flat[where]], minlength=len(part)).astype(np.int64)
            at = to
        return out

    left, right = [], []
    pool = np.arange(len(sets))
    while len(pool):
        queue, pool = [int(pool[0])], pool[1:]
        while queue and len(pool):
            x = queue.pop()
            near = np.bitwise_count(fp[pool] ^ fp[x]) <= radius
            small, large = np.minimum(sizes[pool], sizes[x]), np.maximum(sizes[pool], sizes[x])
            near &= small * least[1] >= large * least[0]
            if side is not None:
                near &= side[pool] != side[x]
            at = np.flatnonzero(near)
            if len(at):
                at = at[alike(x, pool[at])]
                got = pool[at].tolist()
                pool = np.delete(pool, at)
                left += [x] * len(got)
                right += got
                queue += got
    return left, right


def _similar(batches: Iterator[pa.RecordBatch], radius: int, least: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Spanning links of the groups in sorted rows (root, i, j, block, node, fp, hashes); a group may run over batches."""

    def solve(key: tuple, rows: dict[int, tuple]) -> pa.RecordBatch:
        nodes = np.array(list(rows), np.int64)
        sets = [np.frombuffer(s, np.uint64) for _, _, s in rows.values()]
        fp = np.array([f for _, f, _ in rows.values()], np.int64).view(np.uint64)
        side = None if key[1] == key[2] else np.array([b for b, _, _ in rows.values()])
        a, b = similar_forest(sets, fp, side, radius, least)
        return pa.RecordBatch.from_arrays([pa.array(nodes[np.array(x, np.int64)]) for x in (a, b)], names=["a", "b"])

    key, rows = None, {}
    for batch in batches:
        for root, i, j, block, node, fp, hashes in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (root, i, j) != key:
                if len(rows) > 1:
                    yield solve(key, rows)
                key, rows = (root, i, j), {}
            rows[node] = (block, fp, hashes)
    if len(rows) > 1:
        yield solve(key, rows)


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, seed: int = 42, radius: int = 7, least: tuple[int, int] = (4, 5), block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, digest, leader (doc_id, digest) per row of df: of the texts that links connect, the row of the least id.

    Texts are linked if their fingerprints lie within the radius and their sets of shingles have at least the Jaccard
    similarity least. Fingerprints only propose: what they connect is compared by the sets, in groups that no task
    holds beyond two blocks of block_chars. Equal texts are one node, told by digest (see text_digest).
    """
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).withColumn("digest", text_digest("text")).withColumn("size", F.coalesce(F.length("text"), F.lit(0)))
    prints = cut(fingerprints(rows, "text", words, seed).drop("text"))
    texts = prints.groupBy("digest").agg(F.first("fp").alias("fp"), F.min("doc_id").alias("least"), F.first("size").alias("size"))
    texts = cut(texts.withColumn("node", F.monotonically_increasing_id()))
    rooted = texts.join(connect(texts.select("fp").distinct(), radius).hint("merge"), "fp")
    groups = rooted.groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("chars")).where("n > 1").select("root", F.ceil(F.col("chars") / F.lit(block_chars)).cast("int").alias("blocks"))
    groups = groups.withColumn("blocks", F.greatest("blocks", F.lit(1)))
    members = cut(rooted.join(groups.hint("merge"), "root").select("digest", F.col("least").alias("doc_id"), "fp", "node", "root", "blocks"))
    # one row of each text is enough; rows that share id and text are told apart by nothing and met again as one node
    fed = rows.select("doc_id", "digest", "text").alias("r").join(members.hint("merge").alias("m"), (F.col("r.digest") == F.col("m.digest")) & F.col("r.doc_id").eqNullSafe(F.col("m.doc_id"))).select("m.node", "m.fp", "m.root", "m.blocks", "r.text")

    def make():
        return lambda given: [[shingle_set(t, words, seed).tobytes() for t in given]]

    sets = add_columns(fed, [F.col("text")], [T.StructField("hashes", T.BinaryType(), False)], make).drop("text")
    dealt = sets.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "fp", "hashes")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = components(dealt.repartition(n, "root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(lambda it: _similar(it, radius, least), "a long, b long"))
    named = texts.join(found.hint("merge"), "node", "left").select("digest", "least", F.coalesce("root", "node").alias("root"))
    leaders = named.where("least IS NOT NULL").groupBy("root").agg(F.min(F.struct(F.col("least").alias("doc_id"), "digest")).alias("leader"))
    return prints.select("doc_id", "digest").join(named.join(leaders.hint("merge"), "root", "left").select("digest", "leader").hint("merge"), "digest")


def text_digest(text: str) -> Column:
    """SHA-256 of a text; a null text is an empty one."""
    return F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"), 256))


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    """Contract query: fingerprint of 4-word shingles, links within 4 bits, smallest reachable doc_id."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs, words=4, radius=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
