"""SentencePiece encoding and decoding by suffix-array matching.

A text gets a leading "▁", spaces become "▁", and it falls into stretches (a run of "▁" with what follows up to
the next "▁") that no piece of the model crosses; that is checked when a model is loaded. The stretches of a
batch that are not remembered yet are encoded together:

1. they are concatenated, with a mark between them that no piece holds, and the suffixes are sorted by their
   first `longest piece` characters (prefix doubling);
2. every piece is looked up in the sorted suffixes by binary search; the range found holds all its
   occurrences, each of which is an edge from its start to its end;
3. the edges are sorted by end and relaxed from left to right, all stretches side by side.

The model is a BPE model, so edges are not relaxed for the best sum of scores. A sequence of pieces is
the BPE encoding of a text exactly if every two neighbours stay as they are when their own text is encoded. So
an edge that ends at a place is taken if it fits the piece that was taken at its start, and exactly one does.
Whether two pieces fit is found by merging their text once, and remembered. A character that the model lacks is an
edge of its own, given as its UTF-8 bytes, and fits everything, as it never merges.

Decoding joins pieces and bytes, turns "▁" into spaces and drops the first. It returns the text exactly, unless
the text held "▁" itself, which comes back as a space. Bytes that are not UTF-8 become U+FFFD.

A null text has null ids and decodes to null; an empty text has no ids. Rows are independent of each other, so
repeated rows and ids give repeated results. Long texts are handled whole.
"""

from __future__ import annotations

import heapq
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pennyflow.llm.common import arrow_map, own_columns

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Stretches and pairs of pieces that a Python worker remembers; beyond it starts anew.
REMEMBERED = 200_000
STRETCH = re.compile("▁*[^▁]+|▁+")
MARK = 0x1FFFFE  # above all characters, below END
END = 0x1FFFFF
UNKNOWN = -1

_models: dict[str, "Model"] = {}


def model(path: str = MODEL) -> "Model":
    """The model at a path, kept for the next task of the same Python worker."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


class Model:
    def __init__(self, path: str):
        import sentencepiece

        source = sentencepiece.SentencePieceProcessor(model_file=path)
        size = source.get_piece_size()
        self.byte_ids = {int(source.id_to_piece(i)[3:5], 16): i for i in range(size) if source.is_byte(i)}
        special = [source.is_byte(i) or source.is_control(i) or source.is_unknown(i) or source.is_unused(i) for i in range(size)]
        texts = [source.id_to_piece(i) for i in range(size)]
        self.score = {t: source.get_score(i) for i, t in enumerate(texts) if not special[i]}
        self.id = {t: i for i, t in enumerate(texts) if not special[i]}
        self.text = texts
        if any(SPACE in t.lstrip(SPACE) for t in self.id):
            raise ValueError("a piece goes beyond a space")
        # A piece that is not the encoding of its own text never occurs in an encoding.
        usable = sorted(t for t in self.id if self.merged(t) == [t])
        self.longest = max(map(len, usable))
        self.length = np.ones(size + 1, np.int64)  # the last stands for UNKNOWN
        self.length[[self.id[t] for t in usable]] = [len(t) for t in usable]
        self._piece_ids = np.array([self.id[t] for t in usable], np.int64)
        keys = np.zeros((len(usable), self.longest), np.uint32)
        for i, t in enumerate(usable):
            keys[i, : len(t)] = [ord(c) + 1 for c in t]
        self._low = self._as_text(keys)
        self._high = self._as_text(np.where(keys == 0, END, keys))
        self._fits: dict[int, bool] = {}
        self._known: dict[str, bytes] = {}
        self._bytes = [
            bytes([int(t[3:5], 16)]) if source.is_byte(i) else b"" if source.is_control(i) else
            " ⁇ ".encode() if source.is_unknown(i) else t.replace(SPACE, " ").encode()
            for i, t in enumerate(texts)
        ]

    def _as_text(self, codes: np.ndarray) -> np.ndarray:
        """Rows of characters as NumPy texts, which are compared character by character."""
        return np.ascontiguousarray(codes, np.uint32).view(f"U{self.longest}").ravel()

    def merged(self, text: str) -> list[str]:
        """The BPE encoding of a short text: neighbours with the best score are merged, the left ones first."""
        parts: list[str | None] = list(text)
        before, after = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < len(parts) and (both := parts[i] + parts[j]) in self.score:
                heapq.heappush(heap, (-self.score[both], i, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j], after[i] = both, None, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in parts if p is not None]

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether pieces can stand next to each other, for pairs of ids."""
        size = len(self.text)
        keys, where = np.unique(left * size + right, return_inverse=True)
        out = np.empty(len(keys), bool)
        for i, key in enumerate(keys.tolist()):
            known = self._fits.get(key)
            if known is None:
                a, b = self.text[key // size], self.text[key % size]
                known = self._fits[key] = self.merged(a + b) == [a, b]
            out[i] = known
        return out[where]

    def _suffixes(self, codes: np.ndarray) -> np.ndarray:
        """Places of the suffixes in order of their first `longest` characters."""
        # Marks behind the end: no suffix of the batch then looks beyond what follows it.
        padded = np.concatenate([codes, np.full(4 * self.longest, MARK, np.uint32)])
        there = np.zeros(END, bool)
        there[padded] = True
        small = (np.cumsum(there) - 1)[padded]  # characters numbered in order, so that several fit a number
        bits = max(1, int(there.sum() - 1).bit_length())
        width, rank = 1, small
        while width * 2 * bits <= 62 and width < self.longest:
            rank = rank << (width * bits) | self._after(rank, width)
            width *= 2
        while True:
            order = np.argsort(rank)
            if width >= self.longest:
                return order[order < len(codes)]
            ordered = rank[order]
            place = np.empty_like(rank)
            place[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]]))
            rank = place * len(padded) + self._after(place, width)
            width *= 2

    @staticmethod
    def _after(rank: np.ndarray, width: int) -> np.ndarray:
        return np.concatenate([rank[width:], np.zeros(width, rank.dtype)])

    def _edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, piece) of every occurrence of every usable piece."""
        order = self._suffixes(codes)
        padded = np.concatenate([codes, np.full(self.longest, MARK, np.uint32)])
        windows = np.lib.stride_tricks.sliding_window_view(padded, self.longest)
        ordered = self._as_text(windows[order])
        low, high = np.searchsorted(ordered, self._low), np.searchsorted(ordered, self._high, "right")
        times = high - low
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
        return order[at], np.repeat(self._piece_ids, times)

    def learn(self, stretches: set[str]) -> None:
        """Encode the stretches that are not remembered."""
        if len(self._known) > REMEMBERED:  # what is frequent is in this batch, too
            self._known = {s: self._known[s] for s in stretches if s in self._known}
        if len(self._fits) > 3 * REMEMBERED:
            self._fits.clear()
        new = [s for s in stretches if s not in self._known]
        if not new:
            return
        lengths = np.fromiter(map(len, new), np.int64, len(new))
        starts = np.cumsum(lengths + 1) - lengths - 1
        codes = np.frombuffer("\n".join(new).encode("utf-32-le"), np.uint32) + 1
        codes[starts[1:] - 1] = MARK
        offset = np.arange(len(codes)) - np.repeat(starts, lengths + 1)[: len(codes)]
        start, piece = self._edges(codes)
        # Characters without a piece of their own are edges, too.
        single = np.zeros(len(codes), bool)
        single[start[self.length[piece] == 1]] = True
        lone = np.flatnonzero(~single & (codes != MARK))
        start, piece = np.concatenate([start, lone]), np.concatenate([piece, np.full(len(lone), UNKNOWN)])
        end = start + self.length[piece]
        step = offset[end - 1] + 1
        by_step = np.argsort(step)
        start, piece, end = start[by_step], piece[by_step], end[by_step]
        cuts = np.searchsorted(step[by_step], np.arange(1, int(lengths.max()) + 2))
        taken = np.full(len(codes) + 1, UNKNOWN, np.int64)
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            s, p = start[a:b], piece[a:b]
            left = taken[s]
            fits = (offset[s] == 0) | (left == UNKNOWN) | (p == UNKNOWN)
            ask = np.flatnonzero(~fits)
            fits[ask] = self._fit(left[ask], p[ask])
            taken[end[a:b][fits]] = p[fits]
        self._remember(new, starts, lengths, taken)

    def _remember(self, new: list[str], starts: np.ndarray, lengths: np.ndarray, taken: np.ndarray) -> None:
        """Walk back from the ends of all stretches at once, and keep each one's ids as bytes."""
        at, row = starts + lengths, np.arange(len(new))
        rows, ids, ends = [], [], []
        while len(row):
            piece = taken[at]
            rows.append(row), ids.append(piece), ends.append(at)
            at = at - self.length[piece]
            more = at > starts[row]
            at, row = at[more], row[more]
        rows, ids, ends = np.concatenate(rows), np.concatenate(ids), np.concatenate(ends)
        order = np.argsort(ends)  # stretches lie one after the other
        rows, ids, ends = rows[order], ids[order].astype(np.int32), ends[order]
        data = ids.tobytes()
        bounds = (np.searchsorted(rows, np.arange(len(new) + 1)) * 4).tolist()
        self._known.update((text, data[a:b]) for text, a, b in zip(new, bounds[:-1], bounds[1:]))
        for row in np.unique(rows[ids == UNKNOWN]).tolist():
            text, own = new[row], []
            for k in range(bounds[row] // 4, bounds[row + 1] // 4):
                lone = text[ends[k] - starts[row] - 1]
                own += [int(ids[k])] if ids[k] != UNKNOWN else [self.byte_ids[b] for b in lone.encode()]
            self._known[text] = np.array(own, np.int32).tobytes()

    def encode_packed(self, texts: list[str | None]) -> list[bytes | None]:
        """The ids of each text as 32-bit integers one after the other."""
        cut = [None if t is None else STRETCH.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        self.learn(set(chain.from_iterable(c for c in cut if c)))
        known = self._known.__getitem__
        return [None if c is None else b"".join(map(known, c)) for c in cut]

    def encode(self, texts: list[str | None]) -> list[list[int] | None]:
        return [None if p is None else np.frombuffer(p, np.int32).tolist() for p in self.encode_packed(texts)]

    def decode(self, ids: list[int] | None) -> str | None:
        if ids is None:
            return None
        text = b"".join(map(self._bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def encoded(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL) -> DataFrame:
    """A row per row of `df`: its id, `n_tokens`, `ids`, and whether decoding them gives the text back."""
    kept = own_columns(df, id_col, text_col)

    def start():
        own = model(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(text_col).to_pylist()
            packed = own.encode_packed(texts)
            ids = [None if p is None else np.frombuffer(p, np.int32) for p in packed]
            back = [None if t is None else own.decode(i.tolist()) == t for t, i in zip(texts, ids)]
            counts = np.array([0 if i is None else len(i) for i in ids], np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), mask=np.array([*(i is None for i in ids), False]))
            values = pa.array(np.frombuffer(b"".join(p for p in packed if p), np.int32))
            return pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(counts), pa.ListArray.from_arrays(offsets, values), pa.array(back, pa.bool_())],
                [id_col, "n_tokens", "ids", "round_trip"],
            )

        return step

    kind = dict(kept.dtypes)[id_col]
    return arrow_map(kept, text_col, f"`{id_col}` {kind}, n_tokens bigint, ids array<int>, round_trip boolean", start)


def decoded(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str = MODEL) -> DataFrame:
    """A row per row of `df`: its id and the `text` of its ids."""
    kept = own_columns(df, id_col, ids_col)

    def run(batches):
        own = model(path)
        for batch in batches:
            texts = [own.decode(i) for i in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(texts, pa.string())], [id_col, "text"])

    return kept.mapInArrow(run, f"`{id_col}` {dict(kept.dtypes)[id_col]}, text string")
