"""Quality rules by tokeniser fertility: how well public vocabularies take a text apart.

A vocabulary trained on ordinary prose needs few tokens for prose and many for noise. Every document is cut
by each vocabulary, and three figures follow: characters (letters and digits) per token, the share of
tokens that are single fallback bytes, and the entropy of the token distribution. `BANDS` gives the range
in which they must lie, by the language that the row names or else by the script of the text; a document
outside is rejected. Texts of fewer than `LEAST_TOKENS` tokens have no stable figures: the base rules alone
judge them.

Words are cut one by one and remembered, so a word that is frequent in the corpus is cut once per task;
when it holds over `REMEMBERED` words, those of the next batch stay.

A null text has no words; a text without words fails the base rules (fewer than 50 words). A null or
unlisted language falls back to the script. Rows are independent of each other, so repeated rows and ids
give repeated results. Whole texts are read.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennyflow.llm.common import arrow_map, own_columns

VOCABULARIES = ("/opt/tokenizers/piece_bpe_32k.model", "/opt/tokenizers/byte_bpe_50k.tiktoken")
REMEMBERED = 250_000
LEAST_TOKENS = 50
#: Fixed values. Per language or script: least and most letters and digits per token (of any vocabulary),
#: most share of byte tokens, least entropy in bits. Too little entropy is a text that repeats few tokens.
BANDS = {
    "en": (1.7, 8.0, 0.10, 4.0),
    "de": (1.7, 8.0, 0.10, 4.0),
    "fr": (1.52, 8.0, 0.10, 4.0),
    "es": (1.48, 8.0, 0.10, 4.0),
    "latin": (1.4, 8.0, 0.10, 4.0),
    "cyrillic": (0.4, 8.0, 0.20, 4.0),
    "greek": (0.4, 8.0, 0.30, 4.0),
    "cjk": (0.2, 4.0, 0.80, 4.0),
    "other": (0.05, 8.0, 0.95, 3.0),
}
# First and last code points of the letters of each script.
SCRIPTS = (
    ("latin", ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF))),
    ("greek", ((0x370, 0x3FF),)),
    ("cyrillic", ((0x400, 0x52F),)),
    ("cjk", ((0x3040, 0x30FF), (0x3400, 0x9FFF), (0xAC00, 0xD7AF))),
)
SCRIPT_RUNS = [(name, re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in spans) + "]+")) for name, spans in SCRIPTS]
LATIN = SCRIPT_RUNS[0][1]


def script(text: str) -> str:
    """The script with the most letters; the one listed first on a tie; `other` without any of them."""
    if text.isascii():
        return "latin" if LATIN.search(text) else "other"
    counts = [(sum(map(len, runs.findall(text))), name) for name, runs in SCRIPT_RUNS]
    most = max(n for n, _ in counts)
    letters = sum(c.isalpha() for c in text) if most < len(text) // 3 else 0
    return "other" if not most or letters - sum(n for n, _ in counts) > most else next(name for n, name in counts if n == most)


def _cutter(path: str):
    """A function from words to their lists of token ids, the number of ids, the ids of fallback bytes."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        return lambda words: model.encode(words, num_threads=1), size, [i for i in range(size) if model.is_byte(i)]
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    # Words come without white space, so a pattern that takes everything leaves them whole.
    model = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    return lambda words: [model.encode_ordinary(" " + w) for w in words], len(ranks), []


class Fertility:
    """How the vocabularies cut words. The first gives tokens, byte share and entropy, others tokens only."""

    def __init__(self, paths: tuple[str, ...]):
        self._cut, self._size, self._fallback = _cutter(paths[0])
        self._others = [_cutter(path)[0] for path in paths[1:]]
        self._known: dict[bytes, tuple] = {}

    def learn(self, counts: list[Counter]) -> None:
        """Cut the words that are not known yet. Called before `measure`, once per batch."""
        if len(self._known) > REMEMBERED:  # what is frequent is in this batch, too
            self._known = {w: self._known[w] for count in counts for w in count if w in self._known}
        new = list({w for count in counts for w in count if w not in self._known})
        words = [w.decode() for w in new]
        others = zip(*(map(len, cut(words)) for cut in self._others)) if self._others else [()] * len(new)
        alnum = (sum(map(str.isalnum, w)) for w in words)
        packed = (array("I", ids).tobytes() for ids in self._cut(words))  # a fourth of the memory of lists
        self._known.update(zip(new, zip(packed, alnum, others)))

    def measure(self, count: Counter) -> tuple[int, float, float, int, list[int]]:
        """Of a text with these word counts: tokens, share of byte tokens, entropy in bits, letters and
        digits, tokens of the other vocabularies."""
        if not count:
            return 0, 0.0, 0.0, 0, [0] * len(self._others)
        cuts, alnum, others = zip(*map(self._known.__getitem__, count))
        times = np.fromiter(count.values(), np.int64, len(cuts))
        each = np.repeat(times, np.fromiter(map(len, cuts), np.int64, len(cuts)) // array("I").itemsize)
        tokens = np.frombuffer(b"".join(cuts), np.uintc)
        per_token = np.bincount(tokens, each, self._size)
        total = int(each.sum())
        share = per_token[per_token > 0] / total
        return (
            total,
            float(per_token[self._fallback].sum() / total),
            float(-(share * np.log2(share)).sum()),
            int(times @ np.array(alnum)),
            (times @ np.array(others, np.int64).reshape(len(cuts), -1)).tolist(),
        )


def repeated_words(words: list[bytes], count: Counter) -> int:
    """Words in windows of three words that occur twice or more in the text, first ones included."""
    if len(words) < 4:
        return 0
    number, base = dict(zip(count, range(len(count)))), len(count)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    lead = ids[:-2] * base + ids[1:-1]
    if base >= 1 << 20:  # three numbers do not fit 63 bits
        lead = np.unique(lead, return_inverse=True)[1]
        base = max(base, len(words))
    windows = lead * base + ids[2:]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    hit = np.flatnonzero(np.isin(windows, twice))
    marked = np.zeros(len(words), bool)
    for shift in range(3):
        marked[hit + shift] = True
    return int(marked.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split("\n")
    if len(lines) == len(set(lines)):
        return 0
    return sum(n - 1 for line, n in Counter(lines).items() if n > 1 and line.encode().split())


def within_bands(band: str, alnum: int, tokens: list[int], byte_share: float, entropy: float) -> bool:
    if min(tokens) < LEAST_TOKENS:
        return True
    low, high, most_bytes, least_bits = BANDS[band]
    return all(low <= alnum / n <= high for n in tokens) and byte_share <= most_bytes and entropy >= least_bits


FIGURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "band string, n_tokens bigint, chars_per_token double, byte_share double, entropy double, in_bands boolean"
)
NAMES = [x.split()[0] for x in FIGURES.split(", ")]
TYPES = [pa.int64()] * 5 + [pa.string(), pa.int64()] + [pa.float64()] * 3 + [pa.bool_()]
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"


def _starter(text_col: str, lang_col: str | None, vocabularies: tuple[str, ...]):
    """What a task starts with: a function from a batch to the columns of FIGURES."""
    model = Fertility(vocabularies)

    def step(batch: pa.RecordBatch) -> list[list]:
        texts = [t or "" for t in batch.column(text_col).to_pylist()]
        langs = batch.column(lang_col).to_pylist() if lang_col else [None] * len(texts)
        data = [t.encode() for t in texts]
        words = [d.split() for d in data]  # bytes are split at ASCII white space only
        counts = [Counter(w) for w in words]
        model.learn(counts)
        rows = []
        for text, raw, own, count, lang in zip(texts, data, words, counts, langs):
            tokens, share, bits, alnum, others = model.measure(count)
            band = lang if lang in BANDS else script(text)
            chars = len(text) - (len(raw) - len(raw.translate(None, SPACES)))
            symbols = len(raw) - len(raw.translate(None, SYMBOLS))
            rows.append(
                (len(own), chars, symbols, duplicate_lines(text), repeated_words(own, count), band, tokens,
                 alnum / tokens if tokens else 0.0, share, bits, within_bands(band, alnum, [tokens, *others], share, bits))
            )
        return [list(column) for column in zip(*rows)]

    return step


def base_failed() -> F.Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def measured(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    vocabularies: tuple[str, ...] = VOCABULARIES,
) -> DataFrame:
    """A row per row of `df`: its id, the figures, `base_failed` and `kept`."""
    kept = own_columns(df, id_col, text_col, *([lang_col] if lang_col else []))

    def start():
        step = _starter(text_col, lang_col, vocabularies)
        return lambda batch: pa.RecordBatch.from_arrays(
            [batch.column(id_col), *(pa.array(c, k) for c, k in zip(step(batch), TYPES))], [id_col, *NAMES]
        )

    out = arrow_map(kept, text_col, f"`{id_col}` {dict(kept.dtypes)[id_col]}, {FIGURES}", start)
    return out.withColumn("base_failed", base_failed()).withColumn("kept", F.col("in_bands") & ~F.col("base_failed"))


def good_documents(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str | None = "lang",
    vocabularies: tuple[str, ...] = VOCABULARIES,
) -> DataFrame:
    """The rows of `df` that are kept, with all their columns, in one pass."""

    def start():
        step = _starter(text_col, lang_col, vocabularies)

        def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
            figures = dict(zip(NAMES, step(batch)))
            mask = [
                ok and n >= 50 and 100 * repeated <= 50 * n
                for ok, n, repeated in zip(figures["in_bands"], figures["n_words"], figures["n_repeat_words"])
            ]
            return batch.filter(pa.array(mask, pa.bool_()))

        return keep

    return arrow_map(df, text_col, df.schema, start)
