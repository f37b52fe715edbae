"""N-gram Jaccard join over count-vector R-trees.

A document's set holds its distinct ``k``-word shingles (64-bit hashes). Documents with one
set are one *node* (named by a 64-bit hash of the set), so copies cost one comparison.

Which nodes meet in a tree: similar sets share a member of their prefixes under any common
order, the prefix of n members being the first n - ceil(t n) + 1. The order is by rarity:
shingles are counted over all documents in a sketch of fixed size, and those with the least
counters come first. So the lists of nodes by prefix shingle, *runs*, stay short, and
passages that many documents share hardly get into prefixes. Then:

1. each node joins the run centre of another component with which it shares most prefix
   shingles, ROUNDS times; the nodes of a centre are indexed by an R-tree, searched, and surviving pairs verified on their sets.
   Only a spanning forest of the links found leaves the task, not all pairs of a group;
2. components of those links; what is left are runs that touch two components or more.
   Their nodes (of runs over the same components together) are searched for pairs over
   components by R-trees again, and every surviving pair is verified. A larger set is cut by
   bands of set size, of which similar sets are in one or in neighbours, and those into
   blocks, each searched with each. This step alone is complete, so the first may miss pairs
   and only saves work.

The run of a shingle that the sketch counts more than ``LIST`` times is cut into parts by
node, so that no list, and no task's share of one, grows with the most frequent shingle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, WordHash, kept, list_array, materialize, mix, near, text_blocks, text_bytes
from .components import components
from .rtree import RTree, Union, needed, overlap, point, points_of

#: Counters of the sketch (two bytes each when it is broadcast) and of one row of it.
SKETCH, CHUNK = 1 << 22, 1 << 16
#: Shingles that a task holds before it counts them.
FLUSH = 2_000_000
#: Postings of a bucket, about; nodes of a tree at most.
BUCKET, CELL = 1_000_000, 2048
#: Prefix shingles that a node shares with its centre at least, or it waits for step 2.
VOTES = 3
#: Nodes of a list at most, about.
LIST = 50_000
#: Tasks over which the cells around one component are spread at least, and rows of such a task about.
SPREAD, SHARE = 8, 50_000
#: Times that nodes are sent to centres before the complete step.
ROUNDS = 1


def sets_of(texts: list[bytes], k: int, words: WordHash) -> list[np.ndarray]:
    """The ascending distinct shingle hashes of each text."""
    split = [x.translate(LOWER).split() for x in texts]
    lengths = np.array([len(x) for x in split], "i8")
    flat = np.fromiter(map(words.__getitem__, chain.from_iterable(split)), np.uint64, int(lengths.sum()))
    # windows of all texts at once; those over a text's end are left out below
    grams = np.full(max(len(flat) - k + 1, 0), k, np.uint64)
    for i in range(k):
        grams = mix(grams + flat[i : i + len(grams)] + np.uint64(0x632BE59BD9B4E019))
    out, start = [], 0
    for n in lengths.tolist():
        if n >= k:
            out.append(np.unique(grams[start : start + n - k + 1]))
        elif n:
            h = np.full(1, n, np.uint64)
            for i in range(n):
                h = mix(h + flat[start + i] + np.uint64(0x632BE59BD9B4E019))
            out.append(h)
        else:
            out.append(np.zeros(0, np.uint64))
        start += n
    return out


def name_of(members: np.ndarray) -> int:
    """The node of a set: a 64-bit hash of its members and size, as a signed integer."""
    total = np.add.reduce(mix(members ^ np.uint64(0xA0761D6478BD642F)), keepdims=True) + np.uint64(len(members))
    return int(mix(total).view("i8")[0])


def _given(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def _profiles(given: DataFrame, k: int) -> DataFrame:
    """``id, n, node, point`` of every row; and rows with n = -1: chunk number (node) and counters (point) of a task's sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("jaccard")
        words, held, size = WordHash(), [], 0
        names, kind = ["id", "n", "node", "point"], pa.int64()
        counts = np.zeros(SKETCH, "u4")

        def count() -> None:
            counts[:] += np.bincount(_cell(np.concatenate(held)), minlength=SKETCH).astype("u4")

        for batch in text_blocks(batches, 2 << 20):
            kind = batch.column("id").type
            sets = sets_of(text_bytes(batch), k, words)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([name_of(s) for s in sets], pa.int64()), pa.array([point(s) for s in sets], pa.binary())], names)
            held += sets
            size += sum(map(len, sets))
            if size > FLUSH:
                count()
                held, size = [], 0
        if held:
            count()
        packed = np.minimum(counts, 65_535).astype("<u2").reshape(-1, CHUNK)
        for i in np.flatnonzero(packed.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.array([-1], pa.int64()), pa.array([i], pa.int64()), pa.array([packed[i].tobytes()], pa.binary())], names)

    schema = T.StructType([T.StructField("id", given.schema["id"].dataType), *[T.StructField(x, T.LongType()) for x in ("n", "node")], T.StructField("point", T.BinaryType())])
    return given.mapInArrow(run, schema)


def _cell(members: np.ndarray) -> np.ndarray:
    return (members >> np.uint64(20)).astype("i8") & SKETCH - 1


def _sketch(profiles: DataFrame) -> np.ndarray:
    """The tasks' sketches summed up, in logarithmic steps (u2): SKETCH counters whatever the input.

    Those of some files are summed first, then these sums: a task reads as many as the
    square root of the number of files.
    """

    def total(table: pa.Table) -> pa.Table:
        counts = np.zeros(CHUNK, "i8")
        for x in table.column("point"):
            counts += np.frombuffer(x.as_buffer(), "<i8" if len(x.as_buffer()) == 8 * CHUNK else "<u2")
        return pa.Table.from_arrays([table.column("node")[:1].combine_chunks(), pa.array([counts.tobytes()], pa.binary())], ["node", "point"])

    parts = profiles.where("n = -1").select("node", "point", F.input_file_name().alias("file"))
    files = parts.select("file").distinct().count()
    some = F.pmod(F.xxhash64("file"), F.lit(max(1, math.isqrt(files))))
    near_ = parts.groupBy("node", some.alias("some")).applyInArrow(total, "node long, point binary")
    out = np.zeros((SKETCH // CHUNK, CHUNK), "u2")
    for r in near_.groupBy("node").applyInArrow(total, "node long, point binary").collect():
        out[r.node] = np.round(128 * np.log2(1.0 + np.frombuffer(r.point, "<i8")))
    return out.ravel()


def prefix(members: np.ndarray, percent: int, sketch: np.ndarray) -> np.ndarray:
    n = len(members)
    size = n - -(-percent * n // 100) + 1
    return members[np.argsort(sketch[_cell(members)], kind="stable")[:size]]


def _postings(given: DataFrame, k: int, percent: int, sketch: np.ndarray, buckets: int) -> DataFrame:
    """``bucket, part, hashes, nodes``: packed (32-bit shingle, node) pairs of the prefixes.

    ``part`` is 0, or that of a shingle whose list is cut.
    """
    shared, list_size = given.sparkSession.sparkContext.broadcast(sketch), LIST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("jaccard")
        words, done, held, nodes, size = WordHash(), set(), [], [], 0
        order_of = shared.value

        def flush() -> pa.RecordBatch:
            h = np.concatenate(held)
            v = np.repeat(np.array(nodes, "i8"), [len(x) for x in held])
            b = ((h >> np.uint64(32)) % np.uint64(buckets)).astype("i8")
            parts = np.ceil(np.exp2(order_of[_cell(h)] / 128.0) / list_size).astype("i8")
            part = np.where(parts > 1, 1 + (mix(v.view(np.uint64)) % np.maximum(parts, 1).astype(np.uint64)).astype("i8"), 0)
            order = np.lexsort((part, b))
            b, part, low, v = b[order], part[order], h[order].astype("<u4"), v[order]
            new = np.ones(len(b), bool)
            new[1:] = (b[1:] != b[:-1]) | (part[1:] != part[:-1])
            first = np.flatnonzero(new)
            cuts = [*first.tolist(), len(b)]
            return pa.RecordBatch.from_arrays(
                [pa.array(b[first], pa.int32()), pa.array(part[first], pa.int32()), pa.array([low[s:e].tobytes() for s, e in zip(cuts, cuts[1:], strict=False)], pa.binary()), pa.array([v[s:e].tobytes() for s, e in zip(cuts, cuts[1:], strict=False)], pa.binary())],
                ["bucket", "part", "hashes", "nodes"],
            )

        for batch in text_blocks(batches, 2 << 20):
            for s in sets_of(text_bytes(batch), k, words):
                if not len(s) or (node := name_of(s)) in done:
                    continue
                if len(done) > 100_000:
                    done.clear()
                done.add(node)
                held.append(prefix(s, percent, order_of))
                nodes.append(node)
                size += len(held[-1])
            if size > 500_000:
                yield flush()
                held, nodes, size = [], [], 0
        if held:
            yield flush()

    return given.select("text").mapInArrow(run, "bucket int, part int, hashes binary, nodes binary")


def _runs(postings: DataFrame) -> DataFrame:
    """``run, part, nodes array<long>, weight``: the distinct lists of two nodes or more with a prefix shingle in common.

    Equal lists are one run (named by its nodes), of the weight of their number. The parts of
    a list that is cut make one run, named by its shingle; it may have one node alone.
    """

    def reduce(table: pa.Table) -> pa.Table:
        h = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("hashes").to_pylist()])
        v = np.concatenate([np.frombuffer(x, "<i8") for x in table.column("nodes").to_pylist()])
        bucket, part = table.column("bucket")[0].as_py(), table.column("part")[0].as_py()
        order = np.argsort(h, kind="stable")
        h, v = h[order], v[order]
        if not part:
            many = np.zeros(len(h), bool)  # most shingles occur once: they go before anything else is sorted
            same = h[1:] == h[:-1]
            many[1:] |= same
            many[:-1] |= same
            h, v = h[many], v[many]
        order = np.lexsort((v, h))
        h, v = h[order], v[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (v[1:] != v[:-1])
        h, v = h[new], v[new]
        starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, "i8")
        sizes = np.diff(np.append(starts, len(h)))
        if part:
            runs = mix(h[starts].astype(np.uint64) | np.uint64(bucket << 32))
            good, weight = np.arange(len(starts)), np.ones(len(starts), "i8")
        else:
            runs = np.add.reduceat(mix(v.view(np.uint64)), starts) if len(starts) else np.zeros(0, np.uint64)
            good = np.flatnonzero(sizes > 1)
            _, first, weight = np.unique(runs[good], return_index=True, return_counts=True)
            good = good[first]
        keep = np.zeros(len(starts), bool)
        keep[good] = True
        flat = v[np.repeat(keep, sizes)] if len(starts) else v
        by_place = np.argsort(good, kind="stable")
        names = ["run", "part", "nodes", "weight"]
        return pa.Table.from_arrays([pa.array(runs[good[by_place]].view("i8"), pa.int64()), pa.array([part] * len(good), pa.int32()), list_array(flat, sizes[good[by_place]], pa.int64()), pa.array(weight[by_place], pa.int64())], names)

    found = postings.groupBy("bucket", "part").applyInArrow(reduce, "run long, part int, nodes array<long>, weight long")
    return found.groupBy("run", "part").agg(F.first("nodes").alias("nodes"), F.sum("weight").alias("weight"))


def _packed_sets(cands: DataFrame, k: int) -> DataFrame:
    """``cands`` (text and other columns) with ``node, n, members`` (packed) in place of the text."""
    others = [c for c in cands.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("jaccard")
        words = WordHash()
        for batch in text_blocks(batches, 1 << 20):
            sets = sets_of(text_bytes(batch), k, words)
            made = [pa.array([name_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], *made], [*others, "node", "n", "members"])

    schema = T.StructType([*[cands.schema[c] for c in others], T.StructField("node", T.LongType()), T.StructField("n", T.LongType()), T.StructField("members", T.BinaryType())])
    return cands.mapInArrow(run, schema)


def _by_cell(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each value of ``key``, from batches in which its rows follow one another."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for s, e in zip(cuts, cuts[1:], strict=False):
            if held and values[s] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(s, e - s))
            last = values[s]
    if held:
        yield pa.Table.from_batches(held)


def _forest(cells: DataFrame, percent: int) -> DataFrame:
    """``a, b``: a spanning forest of the verified links within each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("jaccard")
        for table in _by_cell(batches, "cell"):
            if table.num_rows < 2:
                continue
            nodes = table.column("node").to_numpy()
            sizes = table.column("n").to_numpy()
            members = [np.frombuffer(x, "<u8") for x in table.column("members").to_pylist()]
            points = points_of([point(s) for s in members])
            tree, joined, out = RTree(points, sizes), Union(len(nodes)), []
            for i in np.argsort(nodes, kind="stable").tolist():
                for j in tree.search(points[i], int(sizes[i]), percent).tolist():
                    if joined.find(i) != joined.find(j) and overlap(members[i], members[j]) >= needed(int(sizes[i]), int(sizes[j]), percent):
                        joined.join(i, j)
                        out.append((i, j))
            if out:
                a, b = np.array(out).T
                yield pa.RecordBatch.from_arrays([pa.array(nodes[a], pa.int64()), pa.array(nodes[b], pa.int64())], ["a", "b"])

    return cells.select("cell", "node", "n", "members").mapInArrow(run, "a long, b long")


def _survivors(cells: DataFrame, percent: int) -> DataFrame:
    """``a, b`` (a < b): pairs over components of a cell that the R-tree's bound lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("jaccard")
        given: set[tuple[int, int]] = set()
        for table in _by_cell(batches, "cell"):
            nodes, roots = table.column("node").to_numpy(), table.column("root").to_numpy()
            if table.num_rows < 2 or (roots == roots[0]).all():
                continue
            sizes, points, side = table.column("n").to_numpy(), points_of(table.column("point").to_pylist()), table.column("side").to_numpy()
            both = bool((side == 0).all())
            tree, out = RTree(points, sizes), []
            for i in range(len(nodes)) if both else np.flatnonzero(side == 1).tolist():
                alive = (roots != roots[i]) & ((nodes > nodes[i]) if both else (side == 2))
                found = tree.search(points[i], int(sizes[i]), percent, alive)
                if len(found):
                    out.append(np.stack([np.full(len(found), nodes[i]), nodes[found]]))
            if out:
                a, b = np.concatenate(out, axis=1)
                pairs = set(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True)) - given
                if len(given) > 300_000:
                    given.clear()  # what comes again then goes in distinct()
                given |= pairs
                if pairs:
                    a, b = zip(*pairs, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return cells.select("cell", "side", "node", "root", "n", "point").mapInArrow(run, "a long, b long").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar by their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("jaccard")
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                p, q = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                good.append(overlap(p, q) >= needed(len(p), len(q), percent))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    left = sets.select(F.col("node").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def join(docs: DataFrame, *, k: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_shingles, component_id`` for every row of ``docs``.

    Two rows link when 100 * intersection >= percent * union of their shingle sets; a
    component is named by its least id. A null or empty text, or one without words, has the
    empty set and is alone (component_id is its own id). A row with a null id has a place in
    its component but never names it, unless all ids there are null. Repeated rows stay.
    Other columns are ignored; an empty table gives an empty result.
    """
    given = _given(docs, id_col, text_col)
    profiles = materialize(_profiles(given, k), "jaccard-profiles")
    rows = profiles.where("n >= 0").select("id", "n", "node")
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(8, -(-total * (101 - percent) // 100 // BUCKET))
    sketch = _sketch(profiles)
    runs = materialize(_runs(_postings(given, k, percent, sketch, buckets)), "jaccard-runs")
    stars = _stars(given, profiles, runs, k, percent)
    # one row for each node: its least id; then for each component; then back to the rows
    ids = rows.where("n > 0").groupBy("node").agg(F.min("id").alias("id")).join(stars, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = ids.groupBy("root").agg(F.min("id").alias("component_id"))
    named = ids.select("node", "root").join(least, "root").select("node", "component_id")
    out = rows.where("n > 0").join(named, "node").select("id", "n", "component_id").union(rows.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _texts(given: DataFrame, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``nodes`` (column node, now ``_node``) with the text of one row of each.

    Where ids repeat, texts of other nodes come along: ``node = _node`` once sets are made.
    """
    chosen = rows.where("n > 0").groupBy("node").agg(F.min("id").alias("_id")).join(nodes, "node").withColumnRenamed("node", "_node")
    chosen = materialize(chosen, "jaccard-chosen")
    return given.join(near(chosen), given["id"].eqNullSafe(F.col("_id"))).drop("id", "_id")


def _votes(met: DataFrame) -> DataFrame:
    """``node, centre``: the centre of another component with which a node shares most, VOTES shingles at least."""
    votes = met.where("root <> theirs").groupBy("node", "centre").agg(F.sum("weight").alias("w")).where(F.col("w") >= VOTES)
    return materialize(votes.groupBy("node").agg(F.max_by("centre", F.struct("w", "centre")).alias("centre")), "jaccard-votes")


def _linked(given: DataFrame, rows: DataFrame, votes: DataFrame, k: int, percent: int) -> DataFrame:
    """``a, b``: a forest of the verified links among the nodes of one centre."""
    sizes = votes.groupBy("centre").agg(F.count(F.lit(1)).alias("of")).withColumn("parts", F.ceil(F.col("of") / CELL).cast("int"))
    # a large cell is cut; the centre goes to each part
    own = sizes.select(F.col("centre").alias("node"), "centre", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    others = votes.join(sizes, "centre").select("node", "centre", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"))
    cells = own.union(others).groupBy("node").agg(F.collect_list(F.xxhash64("centre", "part")).alias("cells"))
    sets = _packed_sets(_texts(given, rows, cells), k).where("node = _node")
    dealt = sets.select(F.explode("cells").alias("cell"), "node", "n", "members").repartition("cell").sortWithinPartitions("cell")
    return _forest(dealt, percent)


def _stars(given: DataFrame, rows: DataFrame, runs: DataFrame, k: int, percent: int) -> DataFrame:
    """``node, root`` of the nodes that link with another."""
    # 1: every node to the centre with which it shares most; twice, the second time over components
    members = materialize(runs.select("run", "part", "weight", F.size("nodes").alias("of"), F.explode("nodes").alias("node")), "jaccard-members")
    parts = runs.select("run", "part")  # what is known of a run goes to each of its parts
    # a node that shares much with many is a good centre of its runs
    known = members.groupBy("node").agg(F.sum(F.col("weight") * F.col("of")).alias("known"))
    members = members.join(known, "node")
    first, links = None, None
    for step in range(ROUNDS):
        rooted = members if first is None else members.join(first, "node", "left")
        rooted = rooted.withColumn("root", F.col("node") if first is None else F.coalesce("root", "node"))
        best = F.max(F.struct("known", "node", "root")).alias("best")
        centred = rooted.groupBy("run").agg(best, F.max("root").alias("hi"), F.min("root").alias("lo")).where("lo <> hi").select("run", F.col("best.node").alias("centre"), F.col("best.root").alias("theirs"))
        met = rooted.join(parts.join(centred, "run"), ["run", "part"])
        forest = materialize(_linked(given, rows, _votes(met), k, percent), f"jaccard-forest{step}")
        links = forest if links is None else links.union(forest)
        first = materialize(components(links), f"jaccard-first{step}")
    # 2: runs over more than one component, completely
    inside = members.select("run", "part", "node").join(first, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # runs over the same components are searched as one: they mostly repeat each other's nodes
    touched = inside.select("run", "root").distinct().groupBy("run").agg(F.count(F.lit(1)).alias("c"), F.min("root").alias("home"), F.bit_xor(F.xxhash64("root")).alias("x"), F.bit_xor(F.xxhash64("root", F.lit(1))).alias("y"))
    open_ = touched.where("c > 1").select("run", F.xxhash64("c", "home", "x", "y").alias("group"), "home")
    inside = inside.join(parts.join(open_, "run"), ["run", "part"]).select("group", "home", "node", "root").distinct()
    points = rows.where("n > 0").select("node", "n", "point").dropDuplicates(["node"])
    inside = materialize(inside.join(points.select("node", "n"), "node"), "jaccard-open")
    sizes = lambda t, *by: t.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("parts"))
    # similar sets are in one band of sizes or in neighbours: a node goes to its own and the next
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent)).cast("int") if percent < 100 else F.col("n")
    bands = F.when(F.col("parts") > 1, F.array(band, band + 1)).otherwise(F.array(F.lit(-1).cast("int" if percent < 100 else "long")))
    banded = inside.join(sizes(inside, "group"), "group").select("group", "home", "node", "root", F.explode(bands).alias("band"))
    inside = banded.join(sizes(banded, "group", "band"), ["group", "band"])
    blocks = inside.withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).select("group", "band", "home", "node", "root", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    blocks = materialize(blocks.select(F.xxhash64("group", "band", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), side.alias("side"), "home", "node", "root"), "jaccard-blocks")
    # cells of one neighbourhood repeat pairs: they go to a few tasks, each of which gives a pair once
    wide = blocks.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / SHARE).alias("spread")).where(F.col("spread") > SPREAD)
    wide = materialize(wide, "jaccard-homes")
    spread = F.coalesce("spread", F.lit(SPREAD))
    deal = F.xxhash64("home", F.pmod("cell", spread))
    dealt = blocks.join(near(wide), "home", "left").withColumn("deal", deal).drop("spread").join(points, "node").repartition("deal").sortWithinPartitions("deal", "cell")
    pairs = materialize(_survivors(dealt, percent), "jaccard-pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = materialize(_packed_sets(_texts(given, rows, wanted), k).where("node = _node").select("node", "members"), "jaccard-sets")
    links = _verified(pairs, sets, percent)
    stars = first.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))
    return materialize(components(stars.union(links)), "jaccard-stars")


def one_of_each(docs: DataFrame, *, k: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that name their component: one document of each group stays.

    Rows without words are alone, and stay. Rows that repeat with id and text leave one. A
    null id is the name only of components without any other; where there is such a
    component, all rows with a null id stay. Other columns stay, whatever their names; an
    empty table gives an empty result. What meets the texts is the list of ids that go.
    """
    found = join(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), k=k, percent=percent, id_col="id")
    named = found.groupBy("id").agg(F.count(F.lit(1)).alias("c"), F.max(F.col("id").eqNullSafe(F.col("component_id"))).alias("names"))
    named = materialize(named.where("c > 1 OR NOT names"), "jaccard-named")
    gone = materialize(named.where("NOT names").select(F.col("id").alias("_gone")), "jaccard-gone")
    again = materialize(named.where("names").select(F.col("id").alias("_again")), "jaccard-again")
    given = docs.select(F.col(f"`{id_col}`").alias("_id"), F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"))
    left = given.join(near(gone), F.col("_id").eqNullSafe(F.col("_gone")), "left_anti")
    if again.isEmpty():
        return left.select("_row.*")
    repeats = F.col("_id").eqNullSafe(F.col("_again"))
    once = left.join(near(again), repeats, "left_anti")
    first = left.join(near(again), repeats, "left_semi").withColumn("_t", F.col("_row")[text_col]).dropDuplicates(["_id", "_t"])
    return once.select("_row").union(first.select("_row")).select("_row.*")
