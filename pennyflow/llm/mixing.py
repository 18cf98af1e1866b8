"""Mixing sources to target weights by a min-cost flow over membership patterns.

A document may belong to several sources; the sources it belongs to are its pattern. Words are summed per
pattern, and a flow routes the words of patterns to the quotas of sources. The words of a pattern may be
used `MOST` times; each further use costs more (`REPEAT_COST`, convex), so nothing is repeated while unused
words could serve. What the flow sends through a pattern then decides its documents: whole passes over all
of them, and for the rest those that come first in a seeded order. The document at the border is
taken if at least half of it fits, so a pattern misses its flow by half a document at most.

Weights share `budget` times all words. A source gets at most `MOST` times its own words; what it
cannot take is shared again by weight among the others (`targets`). With overlapping sources the flow may
serve less than a quota where sources compete for the same words; the plan says how much.

The driver sees sums per pattern only. Their number is checked against `most_patterns`, and beyond it the
operator raises an error, so nothing is dropped. The seeded order is that of an MD5 of the
seed and the id. Its first three hex digits are a bucket; running sums go over buckets first and then
inside each bucket, so no pattern is ordered in one task, even if it holds all rows.

A null or empty text has size 0 and is taken 0 times. Rows with equal ids are rows of their own and stand
next to each other in the order; if their sizes differ the smaller comes first. A null id is an id like
others. A null source is a source; with a null or empty list of sources a document is not taken. Runs repeat.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennyflow.session import shared_folder

MOST = 2
REPEAT_COST = (1, 3)
SEED = "mix-1"
WEIGHTS = (5, 2, 1)


def size_of(text: Column) -> Column:
    """Words of a text: runs of anything but ASCII white space; 0 for null."""
    parts = F.split(text, r"[\x20\x09-\x0D]+")
    empty = F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0)
    last = F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return F.coalesce(F.size(parts) - empty - last, F.lit(0)).cast("bigint")


def targets(sizes: Mapping[str | None, int], weights: Mapping[str | None, float], budget: float) -> dict[str | None, float]:
    """Words per source: by weight, at most MOST times the source's size, the excess shared again by weight.

    All sources below their most get the same words per weight, so those that reach it are the
    ones with the least size per weight, and one pass in that order finds them.
    """
    rest, weight, out = budget * sum(sizes.values()), sum(weights[s] for s in sizes), {}
    for source in sorted(sizes, key=lambda s: (MOST * sizes[s] / weights[s], s is None, s or "")):
        share = rest / weight if weight else 0.0
        out[source] = float(min(share * weights[source], MOST * sizes[source]))
        if out[source] < MOST * sizes[source]:
            # From here on nobody reaches the most, and the share stays as it is.
            return out | {s: float(share * weights[s]) for s in sizes if s not in out}
        rest, weight = rest - out[source], weight - weights[source]
    return out


def cheapest_flow(
    supplies: Sequence[tuple[tuple[int, ...], int]], quotas: Sequence[int]
) -> tuple[list[int], list[int]]:
    """Words used of each pattern and words got by each source, at full flow and least cost.

    `supplies` holds (numbers of its sources, words) per pattern. Paths of least cost are added one by
    one (Dijkstra with potentials), each until an edge is full.
    """
    n, m = len(supplies), len(quotas)
    start, end = n + m, n + m + 1
    graph: list[list[int]] = [[] for _ in range(n + m + 2)]
    to, room, cost = [], [], []

    def edge(a: int, b: int, capacity: int, price: int) -> None:
        for x, y, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            graph[x].append(len(to))
            to.append(y), room.append(c), cost.append(p)

    for i, (sources, words) in enumerate(supplies):
        for price in REPEAT_COST[:MOST]:
            edge(start, i, words, price)
        for source in sources:
            edge(i, n + source, MOST * words, 0)
    for j, quota in enumerate(quotas):
        edge(n + j, end, quota, 0)
    potential = [0] * len(graph)
    while True:
        far, came = {start: 0}, {}
        heap, done = [(0, start)], set()
        while heap:
            d, x = heapq.heappop(heap)
            if x in done:
                continue
            done.add(x)
            for e in graph[x]:
                y, length = to[e], d + cost[e] + potential[x] - potential[to[e]]
                if room[e] and length < far.get(y, length + 1):
                    far[y], came[y] = length, e
                    heapq.heappush(heap, (length, y))
        if end not in far:
            break
        for x in range(len(graph)):
            potential[x] += min(far.get(x, far[end]), far[end])
        path, x = [], end
        while x != start:
            path.append(came[x])
            x = to[came[x] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount
    used = [sum(room[e] for e in graph[i] if to[e] == start) for i in range(n)]
    got = [sum(room[e] for e in graph[end] if to[e] == n + j) for j in range(m)]
    return used, got


def mix(
    df: DataFrame,
    sources: Column,
    weights: Mapping[str | None, float] | None = None,
    budget: float = 1.5,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_patterns: int = 100_000,
) -> tuple[DataFrame, DataFrame]:
    """Per row: its id, `key` (a hash of the text), `size`, `sources` and `taken` (words, repeats counted); and the plan
    per source.

    `sources` is the column with the list of a document's sources. Without `weights`, sources in order of
    code points, null last, weigh WEIGHTS in turn. The text is read once; sizes are kept in the shared folder.
    """
    spark, folder = df.sparkSession, shared_folder(df.sparkSession, "mix")
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null"))))
    sized = df.select(
        F.col(f"`{id_col}`").alias("id"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("key"),
        size_of(F.col(f"`{text_col}`")).alias("size"),
        F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>")))).alias("sources"),
        order.alias("place"),
    ).withColumn("pattern", F.to_json("sources"))
    sized.write.parquet(f"{folder}/sizes")
    sized = spark.read.schema(sized.schema).parquet(f"{folder}/sizes")

    sums = sized.groupBy("pattern").agg(F.first("sources").alias("sources"), F.sum("size").alias("words"))
    patterns = sorted(sums.limit(most_patterns + 1).collect(), key=lambda r: r["pattern"] or "")
    if len(patterns) > most_patterns:
        raise ValueError(f"more than {most_patterns} patterns of sources")
    names = sorted({s for r in patterns for s in r["sources"] or []}, key=lambda s: (s is None, s or ""))
    weights = weights or {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(names)}
    sizes = {s: sum(r["words"] for r in patterns if s in (r["sources"] or [])) for s in names}
    total = sum(r["words"] for r in patterns if r["sources"])
    wanted = targets(sizes, weights, budget * total / max(1, sum(sizes.values())))
    used, got = cheapest_flow(
        [([names.index(s) for s in r["sources"] or []], r["words"]) for r in patterns], [round(wanted[s]) for s in names]
    )
    flows = spark.createDataFrame(
        [(r["pattern"], f // r["words"] if r["words"] else 0, f % r["words"] if r["words"] else 0) for r, f in zip(patterns, used)],
        "pattern string, passes bigint, rest bigint",
    )
    plan = spark.createDataFrame(
        [(s, sizes[s], wanted[s], g) for s, g in zip(names, got)],
        "source string, source_size bigint, target double, routed bigint",
    )

    bucket = F.substring("place", 1, 3)
    sums = sized.groupBy("pattern", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # 4096 buckets per pattern at most, and the number of patterns is checked above.
    begins = sums.select("pattern", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("begin"))
    begins = begins.join(F.broadcast(flows), "pattern")
    inside = (
        Window.partitionBy("pattern", "bucket").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = sized.withColumn("bucket", bucket).withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(begins, ["pattern", "bucket"])
    extra = ((F.col("begin") + F.col("before")) * 2 + F.col("size") <= F.col("rest") * 2) & (F.col("rest") > 0)
    taken = F.col("size") * (F.col("passes") + extra.cast("bigint"))
    return rows.select(F.col("id").alias(id_col), "key", "size", "sources", taken.alias("taken")), plan


#: The same in DuckDB for documents of one source each, where every source's flow is its rounded target.
SQL = f"""
WITH sized AS (
    SELECT doc_id, source, md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS place,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS s,
        [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
    FROM sized GROUP BY source
), ranked AS (
    SELECT *, 1.5::DOUBLE * sum(s) OVER () AS budget, row_number() OVER o AS r,
        coalesce(sum({MOST} * s) OVER before, 0) AS capped, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS open
    FROM sources
    WINDOW o AS (ORDER BY {MOST} * s / w::DOUBLE, source NULLS LAST),
        before AS (ORDER BY {MOST} * s / w::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shares AS (
    SELECT *, (budget - capped) / open AS share FROM ranked
), level AS (
    SELECT min(r) AS r, arg_min(share, r) AS share FROM shares WHERE share * w < {MOST} * s
), aims AS (
    SELECT source, s, w, (CASE WHEN x.r >= l.r THEN l.share * w ELSE {MOST} * s END)::DOUBLE AS target
    FROM shares x, level l
), flows AS (
    SELECT source, s, target, round_even(target, 0)::BIGINT AS f FROM aims
), ordered AS (
    SELECT doc_id, size, z.s AS source_size, z.target, z.f,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized d JOIN flows z ON d.source IS NOT DISTINCT FROM z.source
)
SELECT doc_id, size, source_size, target,
    (CASE WHEN source_size = 0 THEN 0 ELSE size * (f // source_size + (f % source_size > 0
        AND before * 2 + size <= (f % source_size) * 2)::BIGINT) END)::BIGINT AS taken
FROM ordered
"""
