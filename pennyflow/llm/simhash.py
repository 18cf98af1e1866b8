"""Near-duplicates by SimHash, found at the anchors of a covering code.

A fingerprint has a bit for every place at which over half of the hashes of the text's shingles have one.
Two fingerprints of `bits` bits are linked if they differ in `threshold` places or fewer.

**Anchors.** A fingerprint is cut into blocks of 32 bits. In every block the anchors are the words of the
Hamming code of length 31 (covering radius 1, and perfect: each point has exactly one anchor within 1) with
the 32nd bit as it is (radius 0). If two blocks differ in t bits, then the anchor nearest to the one is
within radius + t of the other; if both are handed to the anchors within radius + t/2, they meet as well.
So `home` hands a block to the anchors within radius + near, `away` to those within radius + far, where
near + far = `reach`, and every pair of blocks that differ in `reach` bits or fewer meets at an anchor.
With threshold // blocks <= reach (64 bits, 3 differing bits: reach 1) some block of a linked pair
differs that little, so no link is lost. A block is handed to 1 and 17 anchors out of 2**27.

**Comparing.** Only different fingerprints are compared, so exact copies, however many, are one row. The
pair is made by an equality join on the anchor with the distance as its condition: Spark splits anchors
with many rows, and only true links leave the join. Links are brought together by alternating star
contraction, with the links of each round in the shared folder.

A text without words (null, empty, only white space) has the fingerprint zero and is linked like any other.
With fewer words than a shingle has, the whole sequence is the shingle. Rows with equal ids or texts are
rows of their own; a null id belongs to its group but never names it. ASCII letters only are lower-cased.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennyflow.llm.common import arrow_map, own_columns, stored
from pennyflow.session import shared_folder

SEED = 42
BLOCK = 32
#: Seeds of the further 64-bit words of longer fingerprints.
SEED_STEP = 1_000_003


def _word_of(hashes: np.ndarray) -> int:
    """64 bits, the highest first, each set if over half of the hashes have it."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)).tobytes(), "big")


def fingerprint(text: str | None, words: int = 3, bits: int = 64) -> list[int]:
    """The fingerprint as 64-bit words."""
    own = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not own:
        return [0] * (bits // 64)
    shingles = map(b" ".join, zip(*(own[i:] for i in range(words)))) if len(own) >= words else [b" ".join(own)]
    out, shingles = [], list(shingles)
    for k in range(bits // 64):
        seed, digest = SEED + k * SEED_STEP, xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(s, seed) for s in shingles), np.uint64, len(shingles))
        out.append(_word_of(hashes))
    return out


def fingerprints(df: DataFrame, words: int = 3, bits: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of `df`: its id, `key`, the hash of its text, and `print`, an array of 64-bit words as signed longs."""
    kept = own_columns(df, id_col, text_col)
    kept = kept.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.xxhash64(f"`{text_col}`").alias("key"))

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            prints = [
                np.array(fingerprint(t, words, bits), np.uint64).view(np.int64) for t in batch.column(text_col).to_pylist()
            ]
            return pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("key"), pa.array(prints, pa.list_(pa.int64()))], [id_col, "key", "print"]
            )

        return step

    return arrow_map(kept, text_col, f"`{id_col}` {dict(kept.dtypes)[id_col]}, key bigint, print array<bigint>", start)


def bits_for(similarity: float, bits: int) -> int:
    """Differing bits to expect between texts whose shingle sets have this Jaccard similarity."""
    cosine = 2 * similarity / (1 + similarity)
    return math.floor(bits * math.acos(cosine) / math.pi)


def nearest_anchor(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The only anchor within distance 1 of each block, and the syndrome: the place (1 to 31) in which they
    differ, or 0."""
    syndrome = np.zeros_like(block)
    for place in range(1, BLOCK):
        syndrome ^= np.where(block >> (place - 1) & 1, place, 0)
    return np.where(syndrome > 0, block ^ (1 << np.maximum(syndrome - 1, 0)), block), syndrome


def anchors(block: np.ndarray, extra: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor): the anchors within covering radius + extra (0, 1 or 2) of each block.

    The code is linear, so anchors near a block are its nearest anchor plus words of the code with few
    bits: no bit, or three bits at places p, q, p ^ q, or four. Distance is counted in the first 31 places
    beyond the radius, and in the 32nd place from zero.
    """
    near, syndrome = nearest_anchor(block)
    rows = np.arange(len(block))
    found = [(rows, near)]
    if extra >= 1:
        off = syndrome > 0
        # Two flips at p and p ^ syndrome lead to an anchor at distance 2; each pair is met at its smaller place.
        for p in range(1, BLOCK):
            q = p ^ syndrome
            take = off & (q > p)
            found.append((rows[take], block[take] ^ (1 << (p - 1)) ^ (1 << (q[take] - 1))))
        found.append((rows, near ^ (1 << (BLOCK - 1))))
    if extra >= 2:
        for p in range(1, BLOCK):
            for q in range(p + 1, BLOCK):
                r = p ^ q ^ syndrome
                take = r > q
                found.append((rows[take], block[take] ^ (1 << (p - 1)) ^ (1 << (q - 1)) ^ (1 << (r[take] - 1))))
        for p in range(1, BLOCK):
            q = p ^ syndrome
            take = (syndrome > 0) & (q > p)
            found.append((rows[take], block[take] ^ (1 << (p - 1)) ^ (1 << (q[take] - 1)) ^ (1 << (BLOCK - 1))))
    if extra >= 3:
        raise ValueError("anchors are listed up to two beyond the covering radius")
    return np.concatenate([r for r, _ in found]), np.concatenate([a for _, a in found])


def _at_anchors(prints: DataFrame, words: int, extra: int, name: str) -> DataFrame:
    """(`name`, `name`0, ...): every anchor of every block, with the number of the block in its upper bits, and the
    words of the fingerprint that is there."""
    columns = [f"{name}{i}" for i in range(words)]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = np.array(batch.column("print").to_pylist(), np.int64)
            for k in range(2 * words):
                block = (whole[:, k // 2].view(np.uint64) >> np.uint64(BLOCK * (1 - k % 2)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
                rows, found = anchors(block, extra)
                for i in range(0, len(rows), 100_000):
                    part = slice(i, i + 100_000)
                    of = whole[rows[part]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found[part] | k << BLOCK), *(pa.array(of[:, w]) for w in range(words))], [name, *columns]
                    )

    return prints.select("print").mapInArrow(run, ", ".join(f"{c} bigint" for c in [name, *columns]))


def links(prints: DataFrame, bits: int = 64, threshold: int = 3, reach: int | None = None) -> DataFrame:
    """(a, b), a < b: different fingerprints that differ in `threshold` bits or fewer, and, where `reach` is
    below threshold // blocks, in `reach` or fewer in some block. `prints` has each fingerprint once."""
    words = bits // 64
    reach = threshold // (bits // BLOCK) if reach is None else reach
    near, far = reach // 2, reach - reach // 2
    # A fingerprint becomes many rows, so its few bytes are dealt to all tasks first.
    spread = prints.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "print")
    home, away = _at_anchors(spread, words, near, "a"), _at_anchors(spread, words, far, "b")
    a, b = ([F.col(f"{side}{i}") for i in range(words)] for side in "ab")
    distance = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b)), F.lit(0))
    ordered = F.struct(*a) < F.struct(*b) if words > 1 else a[0] < b[0]
    found = home.join(away, (F.col("a") == F.col("b")) & ordered & (distance <= threshold))
    return found.select(F.array(*a).alias("a"), F.array(*b).alias("b")).distinct()


def contracted(edges: DataFrame, folder: str) -> DataFrame:
    """(b, a): every linked node with the smallest node reachable, unless it is the smallest itself.

    Alternates two steps until nothing changes. Large star: a node hands its larger neighbours to its
    smallest neighbour. Small star: a node hands its smaller neighbours, and itself, to the smallest of
    them. Both keep the components; rounds grow with the logarithm of the longest path. Minima are taken
    with partial aggregates and joined back, so no neighbourhood is gathered in one task.
    """
    edges, turn, before = stored(edges, folder, "edges0"), 0, None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select("m", "b")
        large = large.where("m <> b").select(F.col("m").alias("a"), "b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b")
        small = small.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a <> b").union(low.select(F.col("m").alias("a"), "b"))
        turn += 1
        edges = stored(small.distinct(), folder, f"edges{turn}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            return edges.select("b", "a")
        before = now


def near_duplicates(
    df: DataFrame,
    words: int = 5,
    bits: int = 64,
    threshold: int = 3,
    reach: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per row of `df`: its id, the hash of its text as `key`, its `print`, the fingerprint `root` that names
    its group, and `component_id`, the smallest id that links reach (null where all ids of the group are).

    Fingerprints are made once and kept in the shared folder, as three steps read them.
    """
    folder = shared_folder(df.sparkSession, "simhash")
    prints = stored(fingerprints(df, words, bits, id_col, text_col), folder, "prints")
    groups = prints.groupBy("print").agg(F.min(id_col).alias("first"))
    roots = contracted(links(groups.select("print"), bits, threshold, reach), folder)
    named = groups.join(roots.withColumnRenamed("b", "print"), "print", "left").withColumn("root", F.coalesce("a", "print"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = named.join(smallest, "root").select("print", "root", "component_id")
    return prints.join(labels, "print").select(id_col, "key", "print", "root", "component_id")


def hexadecimal(print_col: str = "print") -> Column:
    return F.array_join(F.transform(print_col, lambda w: F.lpad(F.lower(F.hex(w)), 16, "0")), "")
