"""Document fingerprints from prefix polynomial hashes.

For a text c[0], c[1], ... the prefix array holds H[i] = c[0] B^0 + ... + c[i-1] B^(i-1) modulo a prime, for two
primes. From it, the hash of any span follows in one step: (H[b] - H[a]) B^(-a). So two spans, of one text or of two,
are compared without reading them, and the longest common extension of two places is found by binary search.

A fingerprint has the length and the two hashes of the whole text, and a sketch: the `SKETCH` smallest
hashes of its spans of `SPAN` code points. The likeness of two fingerprints is the share of common hashes
among the smallest of both, an estimate of the Jaccard similarity of their sets of spans. It is 1 if
the whole hashes are equal. A text shorter than a span is its own span; an empty one has none and is like
empty ones alone. Null counts as empty.

`with_next` puts documents beside the next one in descending order of ids without a global sort in one task:
documents are dealt to ranges of ids, sorted within, and the first document of each range is also sent to the end
of the range before. Rows with equal ids stand together, ordered by text; null ids come last; a
single document is its own next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennyflow.llm.common import pieces

# The two largest primes below 2**31, and a base for each.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
SPAN = 16
SKETCH = 64
MIX = np.uint64(0x9E3779B97F4A7C15)

_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _table(base: int, prime: int, n: int) -> np.ndarray:
    """base^0 to base^(n-1), by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime)])
    return out


def powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of the bases and of their inverses, at least n of each; kept and grown as needed."""
    if not _powers or len(_powers[0][0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        _powers[:] = [(_table(b, p, size), _table(pow(b, -1, p), p, size)) for b, p in zip(BASES, PRIMES)]
    return _powers


class PrefixHashes:
    """Prefix arrays of a text, possibly continuing those of another text's first characters."""

    def __init__(self, codes: np.ndarray, start: "PrefixHashes | None" = None, shared: int = 0):
        self.n = len(codes)
        tail = codes[shared:].astype(np.uint64) + np.uint64(1)
        self.sums = []
        for k, (prime, (up, _)) in enumerate(zip(PRIMES, powers(self.n + 1))):
            p = np.uint64(prime)
            terms = np.cumsum(tail * up[shared : self.n] % p)
            head = start.sums[k][: shared + 1] if start else np.zeros(1, np.uint64)
            self.sums.append(np.concatenate([head, (terms + head[-1]) % p]))

    def span(self, a, b, which: int = 0):
        """Hash of the characters from a up to b, wherever they stand; a and b may be arrays."""
        p, down = np.uint64(PRIMES[which]), powers(self.n + 1)[which][1]
        return (self.sums[which][b] + p - self.sums[which][a]) % p * down[a] % p

    def equal(self, a: int, b: int, other: "PrefixHashes", c: int, d: int) -> bool:
        """Whether the span from a up to b equals the other text's from c up to d."""
        return b - a == d - c and all(self.span(a, b, k) == other.span(c, d, k) for k in range(2))

    def common(self, a: int, other: "PrefixHashes", c: int) -> int:
        """How many characters from place a on equal the other text's from place c on."""
        low, high = 0, min(self.n - a, other.n - c)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(a, a + middle, other, c, c + middle):
                low = middle
            else:
                high = middle - 1
        return low

    def spans(self, first: int = 0) -> np.ndarray:
        """Mixed hashes of the spans of SPAN characters that start at `first` or later."""
        if self.n < SPAN:
            values = self.span(np.zeros(1, np.int64), np.full(1, self.n)) if self.n else np.empty(0, np.uint64)
        else:
            at = np.arange(first, self.n - SPAN + 1)
            values = self.span(at, at + SPAN)
        return (values * MIX) >> np.uint64(32)

    def whole(self) -> str:
        return f"{self.n:x}-{int(self.sums[0][-1]):08x}{int(self.sums[1][-1]):08x}"


def smallest(values: np.ndarray, n: int = SKETCH) -> np.ndarray:
    """The n smallest distinct values, in order."""
    few = 4 * n
    if len(values) > few:
        first = np.unique(np.partition(values, few)[:few])
        if len(first) >= n:
            return first[:n]
    return np.unique(values)[:n]


def likeness(whole_a: str, a: np.ndarray, whole_b: str, b: np.ndarray) -> float:
    if whole_a == whole_b:
        return 1.0
    union = np.union1d(a, b)[:SKETCH]
    if not len(union):
        return 1.0
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True)).mean())


def print_of(whole: str, sketch: np.ndarray) -> str:
    return whole + "-" + sketch.astype(">u4").tobytes().hex()


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class Document:
    """A text with its prefix arrays and sketch."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.codes = codes_of(self.text)
        self.hashes = PrefixHashes(self.codes)
        self.spans = self.hashes.spans()
        self.sketch, self.whole = smallest(self.spans), self.hashes.whole()

    def edited(self, following: "Document") -> tuple:
        """The end replaced by the beginning of the next document, and all that is asked of it."""
        n = len(self.codes)
        keep = n - n // 3
        codes = np.concatenate([self.codes[:keep], following.codes[: n - keep]])
        hashes = PrefixHashes(codes, self.hashes, keep)
        unchanged = keep - SPAN + 1
        if unchanged > 0 and len(codes) >= SPAN:
            spans = np.concatenate([self.spans[:unchanged], hashes.spans(unchanged)])
        else:
            spans = hashes.spans()
        sketch, whole = smallest(spans), hashes.whole()
        text = codes.tobytes().decode("utf-32-le")
        return (
            n,
            hashlib.sha256(text.encode()).hexdigest(),
            print_of(self.whole, self.sketch),
            print_of(whole, sketch),
            likeness(self.whole, self.sketch, whole, sketch),
            likeness(self.whole, self.sketch, following.whole, following.sketch),
            self.hashes.common(0, hashes, 0),
        )


RESULT = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, common_prefix bigint"
)
NAMES = [x.split()[0] for x in RESULT.split(", ")]
TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]


def dealt(df: DataFrame, id_col: str, text_col: str, per_partition: int = 4) -> DataFrame:
    """(id, text, part, extra): ranges of descending ids, each followed by a copy of the first document of the next range.

    Ranges are cut at quantiles of the ids. The driver sees a row per range.
    """
    spark = df.sparkSession
    own = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = partitions * per_partition
    cuts = own.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 100 * n)).first()[0] or []
    bounds = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def part(ids: pd.Series) -> pd.Series:
        known = ids.fillna(0).astype("int64").to_numpy()
        place = len(bounds) - np.searchsorted(bounds, known, side="right")
        return pd.Series(np.where(ids.isna(), len(bounds) + 1, place).astype("int32"))

    ids = own.select("id", part("id").alias("part")).groupBy("part").agg(F.max("id").alias("first"))
    firsts = sorted((r["part"], r["first"]) for r in ids.collect())
    if not firsts:
        return own.select("*", F.lit(0).alias("part"), F.lit(False).alias("extra"))
    follow = [(firsts[(i + 1) % len(firsts)][0], firsts[(i + 1) % len(firsts)][1], p) for i, (p, _) in enumerate(firsts)]
    schema = f"of int, first {dict(own.dtypes)['id']}, after int"
    heads = F.broadcast(spark.createDataFrame(follow, schema))
    rows = own.withColumn("part", part("id"))
    # Each row stays in its range; the rows with the first id of a range go to the range before as well.
    goes = rows.join(heads, (F.col("part") == F.col("of")) & F.col("id").eqNullSafe(F.col("first")), "left")
    copies = F.when(F.col("after").isNull(), F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("extra")))).otherwise(
        F.array(
            F.struct(F.col("part").alias("part"), F.lit(False).alias("extra")),
            F.struct(F.col("after").alias("part"), F.lit(True).alias("extra")),
        )
    )
    sent = goes.select("id", "text", F.explode(copies).alias("to")).select("id", "text", "to.part", "to.extra")
    return sent.repartition(partitions, "part").sortWithinPartitions("part", "extra", F.desc_nulls_last("id"), "text")


def edited_prints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of `df`: its id and RESULT, for the text, its edited form and the next document's text."""
    rows = dealt(df, id_col, text_col)

    def out(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), *(pa.array(c, t) for c, t in zip(columns[1:], TYPES))], [id_col, *NAMES]
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, int, Document] | None = None  # a document that waits for the next of its range
        for batch in batches:
            for piece in pieces(batch, "text"):
                done = []
                for key, text, part, extra in zip(*(piece.column(c).to_pylist() for c in ("id", "text", "part", "extra"))):
                    if extra and (held is None or held[0] != part):
                        continue  # a further copy of the first id of the next range
                    following = Document(text)
                    if held is not None:
                        done.append((held[1], *held[2].edited(following)))
                    held = None if extra else (part, key, following)
                if done:
                    yield out(done)

    kind = dict(rows.dtypes)["id"]
    if kind != "bigint":
        raise TypeError("ids must be of type bigint")
    return rows.mapInArrow(run, f"`{id_col}` bigint, {RESULT}")
