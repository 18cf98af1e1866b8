"""Token counts that follow edits: a segment tree of pre-tokens per document.

A byte-level BPE vocabulary counts the tokens of a text. A text is cut into leaves of whole pre-tokens: a
leaf ends where a space or newline follows a letter or digit, which always starts a new pre-token, at the
first such place after `LEAF` characters. Over the leaves stands a binary tree of two sums, characters and tokens.

An edit replaces the characters from `start` up to `end`. The leaves that hold the character before the edit, the edit,
and the character after it are found by descending the tree along character sums; these contain the boundary context,
as the cuts at their two outer ends depend on untouched characters only. Their text alone is cut and encoded
again, the first leaf takes its sums, the others become empty, and the sums up to the root follow.

Edits are given in places of the original text and must not overlap. Edits whose leaves touch are done together. A null
text counts as empty, an empty text has one empty leaf. A text without any place to cut is one leaf,
however long. Rows are independent of each other, so repeated rows and ids give repeated results.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from pennyflow.llm.common import arrow_map, own_columns

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LEAF = 512
CUT = re.compile(r"(?<=[^\W_])[ \n]")
# Fixed value: how the vocabulary's texts were cut into pre-tokens.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: What the registered query edits: addresses and long runs of digits are masked.
MASKED = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+|[0-9][0-9 -]{6,}[0-9]")
MASK = "<MASK>"

Edit = tuple[int, int, str]
_counters: dict[str, Callable[[str], int]] = {}


def counter(path: str = VOCABULARY) -> Callable[[str], int]:
    """A function that counts tokens, kept for the next task of the same Python worker."""
    if path not in _counters:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("counts", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
        _counters[path] = lambda text: len(encoding.encode_ordinary(text))
    return _counters[path]


def leaves(text: str) -> list[str]:
    cuts = [0]
    while found := CUT.search(text, cuts[-1] + LEAF):
        cuts.append(found.start())
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]


class CountTree:
    """Leaves of a text with their sums of characters and tokens; node 1 is the root."""

    def __init__(self, text: str, count: Callable[[str], int]):
        self._count, self.leaves, self.encoded = count, leaves(text), len(text)
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, leaf in enumerate(self.leaves):
            self.chars[self.width + i], self.tokens[self.width + i] = len(leaf), count(leaf)
        for node in range(self.width - 1, 0, -1):
            self._add_up(node)

    def _add_up(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and the place where that leaf starts."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if place - begin >= self.chars[node]:
                begin += self.chars[node]
                node += 1
        return node - self.width, begin

    def _put(self, leaf: int, text: str) -> None:
        self.leaves[leaf], node = text, leaf + self.width
        self.chars[node], self.tokens[node] = len(text), self._count(text) if text else 0
        self.encoded += len(text)
        while node > 1:
            node //= 2
            self._add_up(node)

    def edit(self, edits: Iterable[Edit]) -> None:
        """Apply edits that are given in places of the text as it is now and do not overlap."""
        length, groups = self.chars[1], []
        for start, end, new in sorted(edits):
            if not length:
                groups.append((0, 0, 0, [(start, end, new)]))
                continue
            first, begin = self.leaf_at(max(0, start - 1))
            last, _ = self.leaf_at(min(end, length - 1))
            if groups and first <= groups[-1][1]:
                before = groups.pop()
                groups.append((before[0], max(before[1], last), before[2], [*before[3], (start, end, new)]))
            else:
                groups.append((first, last, begin, [(start, end, new)]))
        for first, last, begin, own in groups:
            old, parts, at = "".join(self.leaves[first : last + 1]), [], 0
            for start, end, new in own:
                parts += [old[at : start - begin], new]
                at = end - begin
            parts.append(old[at:])
            for leaf in range(first + 1, last + 1):
                if self.leaves[leaf]:
                    self._put(leaf, "")
            self._put(first, "".join(parts))


def masks(text: str) -> list[Edit]:
    return [(m.start(), m.end(), MASK) for m in MASKED.finditer(text)]


def counted(
    df: DataFrame,
    edits: Callable[[str], list[Edit]] = masks,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str = VOCABULARY,
) -> DataFrame:
    """A row per row of `df`: its id, characters and tokens before and after `edits`, the number of edits, and how many
    characters were encoded again for them."""
    kept = own_columns(df, id_col, text_col)

    def start():
        count = counter(path)

        def row(text: str) -> tuple[int, ...]:
            tree = CountTree(text, count)
            tokens, changes = tree.total, edits(text)
            tree.edit(changes)
            return len(text), tokens, len(changes), tree.chars[1], tree.total, tree.encoded - len(text)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [row(t or "") for t in batch.column(text_col).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(id_col), *(pa.array(c, pa.int64()) for c in zip(*rows))], [id_col, *names]
            )

        return step

    names = ("n_chars", "n_tokens", "n_edits", "edited_chars", "edited_tokens", "encoded_again")
    schema = f"`{id_col}` {dict(kept.dtypes)[id_col]}, " + ", ".join(f"{n} bigint" for n in names)
    return arrow_map(kept, text_col, schema, start)
