"""Documents whose sets of word shingles are alike: 100 * intersection >= `PERCENT` * union.

A set is known by 64-bit hashes of its shingles, and equal sets, however many documents have them, are one node.

**Lists.** A pass over the texts packs (shingle, node) pairs by a bucket of the shingle; a bucket counts the nodes of
each shingle and hands back those that two or more nodes have. What two sets share is among these, so no text is read
again, and a set of which fewer than `PERCENT` are handed back is alike to none. The number of buckets grows with the
texts. A shingle that many nodes of one task have is not gathered: its pairs go by node, and its bucket gets a mark.

**Who may meet.** Alike sets of n and m shingles share T = ceil(n * PERCENT / 100) or more. Under one order of all
shingles, rarest first, they meet in one of their first n - T + 1. Each node is joined to the smallest node of each such
list (a star: as many rows as nodes), and what stars connect is a hood; alike sets are in one hood.

**Stars first.** The pairs of a star are compared and the links contracted. Often that makes the hood one group, and
nothing is left to find, so a large group of near copies costs a row per copy.

**T-occurrence search.** In a hood with several groups, all nodes outside its largest group search the hood: the lists of
the hood's nodes that hold T or more of the query's shingles in common are asked for. DivideSkip: the longest lists are
set aside, the short ones are merged by a heap, which skips ahead to ids that may still occur T - L times, and these
are probed in the L long lists by bisection. A shingle that a whole family has makes a long list, so families of texts
that share much, but too little, are not compared pair by pair. A hood is cut into blocks of about `BLOCK`
shingles by a hash of the node, and its queries likewise, so a task holds one block and one part of the queries. It hands
on only links between groups that it has not joined yet, so two large groups that are alike do not make all their pairs.

A null text or one without words has the empty set and is linked with nothing; with fewer words than a shingle has, the
whole sequence is the one shingle. ASCII letters only are lower-cased. Repeated rows are one node and have a row each;
a null id belongs to its group but never names it. Whole texts are read, and an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennyflow.llm.common import arrow_map, own_columns, stored
from pennyflow.llm.simhash import contracted
from pennyflow.session import shared_folder

WORDS = 5
PERCENT = 80
#: Pairs that a task holds before it hands them on.
PAIRS = 3_000_000
#: Characters of text per bucket of shingles.
CHARS = 24 << 20
#: Nodes with a shingle among the pairs a task holds, from which on it is marked instead of gathered.
MANY = 64
#: Stands for the number of nodes of marked shingles, in the order of shingles.
MARKED = 1 << 30
#: Shingles of nodes searched, and of nodes searching, in one task at a time, about.
BLOCK = 100_000
#: Weight of a probe in a long list against a step in a short one, as in the published method.
MU = 0.01


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The hashes of the text's distinct shingles, ordered."""
    own = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not own:
        return np.array([], np.uint64)
    every = map(b" ".join, zip(*(own[i:] for i in range(words)))) if len(own) >= words else [b" ".join(own)]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(s) for s in every), np.uint64))


def least_shared(n, percent: int = PERCENT):
    """What a set of n shares with any set alike to it, at least."""
    return -(-n * percent // 100)


# --- lists -------------------------------------------------------------------------------


def _buckets(of: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places) of hashes, by their upper bits."""
    bucket = ((of >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for k in range(buckets):
        if ends[k] < ends[k + 1]:
            yield k, order[ends[k] : ends[k + 1]]


def _pack(sets: list[tuple[int, np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of (bucket, shingles, marked, nodes, at): buckets from 0 by shingle, below 0 by node for marked shingles."""
    sets = list({node: (node, own) for node, own in sets}.values())
    names = np.array([node for node, _ in sets], np.int64)
    every = np.concatenate([own for _, own in sets])
    of = np.repeat(np.arange(len(sets)), [len(own) for _, own in sets])
    order = np.argsort(every, kind="stable")
    every, of = every[order], of[order]
    starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    counts = np.diff(np.append(starts, len(every)))
    many = np.repeat(counts > MANY, counts)
    marked = every[starts[counts > MANY]]

    def row(bucket: int, found: np.ndarray, nodes: np.ndarray, marks: np.ndarray) -> dict:
        own, at = np.unique(nodes, return_inverse=True)
        at = at.astype(np.uint16 if len(own) < 1 << 16 else np.uint32)
        return {"bucket": bucket, "shingles": found.tobytes(), "marked": marks.tobytes(), "nodes": names[own].tobytes(), "at": at.tobytes()}

    marks = {k: marked[places] for k, places in _buckets(marked, buckets)}
    rows = []
    few, few_of = every[~many], of[~many]
    for k, places in _buckets(few, buckets):
        rows.append(row(k, few[places], few_of[places], marks.pop(k, marked[:0])))
    rows += [row(k, few[:0], few_of[:0], own) for k, own in marks.items()]
    far, far_of = every[many], of[many]
    for k, places in _buckets(names[far_of].view(np.uint64), buckets):
        rows.append(row(-1 - k, far[places], far_of[places], marked[:0]))
    schema = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("shingles", "marked", "nodes", "at"))])
    yield from pa.Table.from_pylist(rows, schema).to_batches(max_chunksize=64)


def _node(own: np.ndarray) -> int | None:
    """A signed 64-bit hash of a set; none of the empty one."""
    h = xxhash.xxh3_64_intdigest(own.tobytes())
    return None if not len(own) else h - (1 << 64) if h >> 63 else h


def signed(df: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, node) of each document."""
    kept = own_columns(df, id_col, text_col).toDF("id", "text")

    def start():
        def step(piece: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingles(t, words) for t in piece.column("text").to_pylist()]
            columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array(map(_node, sets), pa.int64())]
            return pa.RecordBatch.from_arrays([piece.column("id"), *columns], ["id", "n", "node"])

        return step

    return arrow_map(kept, "text", f"id {dict(kept.dtypes)['id']}, n bigint, node bigint", start)


def packed(df: DataFrame, buckets: int, words: int = WORDS, text_col: str = "text") -> DataFrame:
    """(bucket, shingles, marked, nodes, at): the pairs of shingles and nodes, many to a row."""
    kept = own_columns(df, text_col).toDF("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                own = shingles(text, words)
                if len(own):
                    held.append((_node(own), own))
                    size += len(own)
                if size > PAIRS:
                    yield from _pack(held, buckets)
                    held, size = [], 0
        if held:
            yield from _pack(held, buckets)

    return kept.mapInArrow(run, "bucket int, shingles binary, marked binary, nodes binary, at binary")


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    found, nodes = [], []
    for own, names, at in zip(*(table.column(c).to_pylist() for c in ("shingles", "nodes", "at"))):
        own, names = np.frombuffer(own, np.uint64), np.frombuffer(names, np.int64)
        found.append(own)
        nodes.append(names[np.frombuffer(at, np.uint32 if len(names) >= 1 << 16 else np.uint16)])
    return np.concatenate(found), np.concatenate(nodes)


def shared_shingles(pairs: DataFrame) -> DataFrame:
    """(node, shingle, times): the shingles of each node that another node has too, and of how many nodes."""

    def count(table: pa.Table) -> pa.Table:
        found, nodes = _unpacked(table)
        order = np.lexsort((nodes, found))
        found, nodes = found[order], nodes[order]
        other = np.concatenate([[True], (found[1:] != found[:-1]) | (nodes[1:] != nodes[:-1])]) if len(found) else np.array([], bool)
        found, nodes = found[other], nodes[other]
        if table.column("bucket")[0].as_py() < 0:
            times = np.full(len(found), MARKED)
        else:
            starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.array([], np.int64)
            times = np.diff(np.append(starts, len(found)))
            times = np.repeat(times, times)
            marked = np.unique(np.concatenate([np.frombuffer(m, np.uint64) for m in table.column("marked").to_pylist()]))
            times = np.where(np.isin(found, marked), MARKED, times)
        shared = times > 1
        columns = [nodes[shared], found[shared].view(np.int64), times[shared].astype(np.int32)]
        return pa.table(dict(zip(("node", "shingle", "times"), columns)))

    return pairs.groupBy("bucket").applyInArrow(count, "node bigint, shingle bigint, times int")


def shared_sets(nodes: DataFrame, shared: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, n, own): of the nodes that share enough, the shared shingles from the rarest on."""
    enough = shared.groupBy("node").agg(F.count("*").alias("held")).join(nodes, "node").where(F.col("held") * 100 >= F.col("n") * percent)
    kept = shared.join(enough.select("node", "n"), "node")
    # At most the set of one document to a row. A marked shingle of copies in two tasks may come twice.
    kept = kept.groupBy("node", "n").agg(F.array_sort(F.collect_set(F.struct("times", "shingle"))).alias("own"))
    kept = kept.where(F.size("own") * 100 >= F.col("n") * percent)
    return kept.select("node", "n", F.transform("own", lambda s: s["shingle"]).alias("own"))


# --- links -------------------------------------------------------------------------------


def stars(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b), a < b: each node with the smallest node of every list it may meet another in."""
    # n - T + 1 of all shingles, less those that nobody else has.
    first = F.size("own") - F.ceil(F.col("n") * percent / 100).cast("int") + 1
    met = sets.select(F.explode(F.slice("own", 1, first)).alias("shingle"), "node")
    least = met.groupBy("shingle").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z").select("shingle", "a")
    return met.join(least, "shingle").where("a < node").select("a", F.col("node").alias("b")).distinct()


def _alike(shared, n_a, n_b, percent):
    return shared * 100 >= (n_a + n_b - shared) * percent


def compared(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs that are alike."""
    a, b = (sets.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("own").alias(f"own_{x}")) for x in "ab")
    # Lengths first, so that only pairs that may be alike fetch their sets.
    near = pairs.join(a.drop("own_a"), "a").join(b.drop("own_b"), "b")
    near = near.where((F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent))
    whole = near.select("a", "b").join(a, "a").join(b, "b")
    shared = F.size(F.array_intersect("own_a", "own_b"))
    return whole.where(_alike(shared, F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def occurring(lists: list[list[int]], least: int, mu: float = MU) -> dict[int, int]:
    """{id: occurrences} of the ids that stand in `least` of the ordered lists or more, by DivideSkip."""
    if not 0 < least <= len(lists):
        return {}
    lists = sorted(lists, key=len)
    aside = min(least - 1, int(least / (mu * max(1, len(lists[-1]).bit_length()) + 1)), len(lists))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    need, found = least - aside, {}
    heap = [(own[0], k, 0) for k, own in enumerate(short)]
    heapq.heapify(heap)
    while len(heap) >= need:
        smallest, top = heap[0][0], []
        while heap and heap[0][0] == smallest:
            top.append(heapq.heappop(heap))
        if len(top) >= need:
            found[smallest] = len(top)
            onward = smallest + 1
        else:
            # No id before the one that is then smallest can stand in enough lists.
            while heap and len(top) < need - 1:
                top.append(heapq.heappop(heap))
            if not heap:
                break
            onward = heap[0][0]
        for _, k, at in top:
            at = bisect_left(short[k], onward, at + (onward > short[k][at]))
            if at < len(short[k]):
                heapq.heappush(heap, (short[k][at], k, at))
    for own in long:
        for one in found:
            at = bisect_left(own, one)
            found[one] += at < len(own) and own[at] == one
    return {one: n for one, n in found.items() if n >= least}


def _search(table: pa.Table, percent: int) -> pa.Table:
    """(a, b): links of the searching nodes of a block with those of other groups in it, as many as bring these together.

    Of the links between two groups, or between groups that other links of the task join, the first is kept: fewer
    links than groups leave a task, however many pairs are alike.
    """
    rows = table.to_pylist()
    held = sorted((r for r in rows if not r["searching"]), key=lambda r: r["node"])
    lists: dict[int, list[int]] = {}
    for i, r in enumerate(held):
        for shingle in r["own"]:
            lists.setdefault(shingle, []).append(i)
    out, above = [], {}

    def top(root: int) -> int:
        while root in above:
            above[root] = above.get(above[root], above[root])
            root = above[root]
        return root

    for q in rows:
        if q["searching"]:
            own = [lists[s] for s in q["own"] if s in lists]
            for i, n in occurring(own, least_shared(q["n"], percent)).items():
                r = held[i]
                one, other = top(q["root"]), top(r["root"])
                if one != other and _alike(n, q["n"], r["n"], percent):
                    above[one] = other
                    out.append((min(q["node"], r["node"]), max(q["node"], r["node"])))
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def searched(sets: DataFrame, hoods: DataFrame, roots: DataFrame, block: int = BLOCK, percent: int = PERCENT) -> DataFrame:
    """(a, b): links that bring groups of one hood together. `hoods` and `roots` have (b, a), a node and the smallest it reaches."""
    of = sets.select("node", "n").join(hoods.toDF("node", "hood"), "node").join(roots.toDF("node", "root"), "node", "left")
    # The smallest node of a hood or group stands in neither table as b.
    heads = hoods.select(F.col("a").alias("node")).distinct().withColumn("hood", F.col("node"))
    heads = heads.join(sets.select("node", "n"), "node").join(roots.toDF("node", "root"), "node", "left")
    of = of.union(heads.select("node", "n", "hood", "root")).withColumn("root", F.coalesce("root", "node"))
    sizes = of.groupBy("hood", "root").agg(F.sum("n").alias("size"))
    mixed = sizes.groupBy("hood").agg(F.count("*").alias("groups"), F.sum("size").alias("all"), F.max(F.struct("size", "root")).alias("main"))
    mixed = mixed.where("groups > 1")
    mixed = mixed.select("hood", F.col("main.root").alias("main"), F.ceil(F.col("all") / block).cast("int").alias("blocks"),
                         F.ceil((F.col("all") - F.col("main.size")) / block).cast("int").alias("parts"))
    rows = of.drop("n").join(mixed, "hood").join(sets, "node")
    part = lambda seed, n: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["hood", "block", "part", "node", "n", "root", "own"]
    index = rows.withColumn("block", part(1, "blocks")).withColumn("part", every("parts")).select(*columns, F.lit(False).alias("searching"))
    queries = rows.where("root <> main").withColumn("part", part(2, "parts")).withColumn("block", every("blocks"))
    both = index.union(queries.select(*columns, F.lit(True).alias("searching")))
    return both.groupBy("hood", "block", "part").applyInArrow(lambda t: _search(t, percent), "a bigint, b bigint").distinct()


def bucket_number(df: DataFrame, text_col: str = "text") -> int:
    """Buckets of shingles: one for `CHARS` characters, and one for each task at least."""
    chars = df.agg(F.sum(F.char_length(F.col(f"`{text_col}`")))).first()[0] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), chars // CHARS)


def joined(
    df: DataFrame, words: int = WORDS, percent: int = PERCENT, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row per row of `df`: its id, n_shingles and component_id, the smallest id that links reach."""
    folder = shared_folder(df.sparkSession, "jaccard")
    docs = stored(signed(df, words, id_col, text_col), folder, "docs")
    # The texts are read once more here: the pairs are larger than the texts, and so they are shuffled but not stored.
    shared = stored(shared_shingles(packed(df, bucket_number(df, text_col), words, text_col)), folder, "shared")
    nodes = docs.where("node IS NOT NULL").groupBy("node").agg(F.max("n").alias("n"))
    sets = stored(shared_sets(nodes, shared, percent), folder, "sets")
    star = stored(stars(sets, percent), folder, "stars")
    hoods = contracted(star, f"{folder}/hoods")
    links = stored(compared(star, sets, percent), folder, "links")
    roots = contracted(links, f"{folder}/roots")
    more = searched(sets, hoods, roots, block, percent)
    roots = contracted(links.union(more), f"{folder}/all")
    groups = docs.groupBy("node").agg(F.min("id").alias("least")).where("node IS NOT NULL")
    named = groups.join(roots.toDF("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = named.join(smallest, "root").select("node", "component_id")
    rows = docs.join(labels, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


#: The same in DuckDB: shared shingles of every two documents counted, links followed to all that they reach.
SQL = f"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), places AS (
    SELECT r, w, unnest(range(1, greatest(len(w) - {WORDS - 2}, 2))) AS i FROM docs WHERE len(w) > 0
), held AS (
    SELECT DISTINCT r, array_to_string(w[i:i + {WORDS - 1}], ' ') AS shingle FROM places
), sizes AS (
    SELECT r, count(*) AS n FROM held GROUP BY r
), links AS (
    SELECT a.r AS a, b.r AS b FROM held a JOIN held b ON a.shingle = b.shingle AND a.r <> b.r
        JOIN sizes x ON x.r = a.r JOIN sizes y ON y.r = b.r
    GROUP BY a.r, b.r, x.n, y.n HAVING 100 * count(*) >= {PERCENT} * (x.n + y.n - count(*))
), reached AS (
    SELECT r, r AS other FROM docs
    UNION
    SELECT c.r, l.b FROM reached c JOIN links l ON l.a = c.other
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least_id AS component_id
FROM docs d LEFT JOIN sizes USING (r)
    JOIN (SELECT c.r, min(o.doc_id) AS least_id FROM reached c JOIN docs o ON o.r = c.other GROUP BY c.r) m ON m.r = d.r
"""
