"""Quality rules by repetition: how much of a text stands in n-grams and lines that it has already had.

Words become numbers, and a rolling hash over them names the n-grams of several lengths at once: the hash of n words
is the hash of n - 1 words times a constant plus the next word. Equal hashes that come back mark their words as
repeated, and the characters of the marked words, as a share of all, are compared with a limit for each length.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batch_of, quoted, releasing, text_bytes, with_fields, without

# Base rules: least words, and most percent of words in 3-word windows that occur twice or more.
MIN_WORDS, BASE_WINDOW, MAX_REPEAT_PERCENT = 50, 3, 50

# Most percent of word characters in n-grams that occurred before, and in lines that occurred before.
MAX_GRAM_PERCENT = {5: 15, 7: 13, 10: 10}
MAX_LINE_PERCENT = 20

SPACES, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"

# Odd multipliers of 64-bit mixing.
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _numbers(words: list[bytes]) -> np.ndarray:
    """A well-mixed 64-bit number for each different word."""
    ids: dict[bytes, int] = {}
    x = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    x = (x + np.uint64(1)) * _MIX
    x ^= x >> np.uint64(32)
    x *= _MIX
    return x ^ (x >> np.uint64(29))


def _marked(hashes: np.ndarray, length: int, words: int, first_too: bool) -> np.ndarray:
    """Which words stand in a window whose hash occurs more than once; without `first_too`, in its later ones only."""
    order = np.argsort(hashes, kind="stable")
    in_order = hashes[order]
    same = in_order[1:] == in_order[:-1]
    if not same.any():
        return np.zeros(words, bool)
    again = np.zeros(len(hashes), bool)
    again[order[1:][same]] = True
    if first_too:
        again[order[:-1][same]] = True
    edges = np.zeros(words + 1, np.int32)
    starts = np.flatnonzero(again)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + length, -1)
    return np.cumsum(edges[:-1]) > 0


def measure(text: bytes | None, lengths: tuple[int, ...] = tuple(MAX_GRAM_PERCENT)) -> dict:
    """The measures of a UTF-8 text (null: as empty). Characters are code points; percent is of word characters."""
    text = text or b""
    words = text.split()
    n = len(words)
    joined = text.translate(None, SPACES)
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    seen: set[bytes] = set()
    again = [line for line in lines if line in seen or seen.add(line)]
    sizes = np.fromiter(map(_code_points, words), np.int64, n) if not text.isascii() else np.fromiter(map(len, words), np.int64, n)
    chars = int(sizes.sum())
    out = {"n_words": n, "word_chars": chars, "n_symbols": len(text) - len(text.translate(None, SYMBOLS)),
           "n_dup_lines": len(again), "n_repeat_words": 0,
           "dup_line_chars": sum(_code_points(line.translate(None, SPACES)) for line in again)}
    out |= {f"dup_chars_{k}": 0 for k in lengths}
    rolled = numbers = _numbers(words)
    for k in range(2, max(*lengths, BASE_WINDOW) + 1):
        if n < k:
            break
        rolled = rolled[:-1] * _STEP + numbers[k - 1 :]
        if k == BASE_WINDOW:
            out["n_repeat_words"] = int(_marked(rolled, k, n, True).sum())
        if k in lengths:
            out[f"dup_chars_{k}"] = int(sizes[_marked(rolled, k, n, False)].sum())
        if not out["n_repeat_words"] and k >= BASE_WINDOW:
            break  # no 3-word window comes back, so no longer one does
    return out


def _code_points(word: bytes) -> int:
    return len(word) if word.isascii() else len(word.decode("utf-8", "replace"))


def judge(
    docs: DataFrame,
    text: str = "text",
    gram_percent: Mapping[int, float] = MAX_GRAM_PERCENT,
    line_percent: float = MAX_LINE_PERCENT,
) -> DataFrame:
    """Add the measures of each whole text, base_failed and kept to `docs`; nothing is shuffled.

    base_failed: under 50 words, or over half of the words in 3-word windows that occur twice or more. kept: not
    base_failed, and within the limit of every length and of lines. A null text is judged as an empty one and fails;
    columns of these names, in upper or lower case, are replaced. A text is held whole by one task."""
    lengths = tuple(sorted(gram_percent))
    limits = dict(gram_percent)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars",
              *(f"dup_chars_{k}" for k in lengths)]
    kept = without(docs, *counts, "base_failed", "kept")
    plain = docs.select(*map(quoted, kept))
    added = [(c, pa.int64()) for c in counts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t, lengths) for t in text_bytes(batch.column(text))]
            more = batch_of(added, [[f[c] for f in found] for c in counts])
            yield pa.RecordBatch.from_arrays([*batch.columns, *more.columns], names=[*kept, *counts])

    measured = plain.mapInArrow(releasing(run), with_fields(plain.schema, ", ".join(f"{c} bigint" for c in counts)))
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    good = F.col("dup_line_chars") * 100 <= F.col("word_chars") * line_percent
    for k, percent in limits.items():
        good &= F.col(f"dup_chars_{k}") * 100 <= F.col("word_chars") * percent
    return measured.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & good)
