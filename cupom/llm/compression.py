"""Quality rules: basic text counts, then compression bands.

A text is squeezed with Zstandard as a whole and in fixed chunks; ratio = compressed / raw bytes. Text
that repeats itself has a low ratio, noise (encoded data, random characters) a high one. The natural
ratio depends on length, since short texts have little to refer back to, so each limit holds for
a range of lengths (``BANDS``; ``CHUNK_BANDS`` for chunks). Below 200 bytes a frame's own bytes outweigh what noise adds, so that
range has only a lower limit. A last chunk below ``LEAST_CHUNK`` bytes is joined to the one before it; a text below it has one chunk, itself,
which the limits for whole texts judge. A text passes if its whole ratio is within its band, and if the share of chunks outside theirs is
at most ``chunk_share``.

Words are maximal runs of bytes other than ASCII white space. Defined results: a null text is empty;
an empty text has ratio 0 and fails the base rules (fewer than ten words); rows are judged one by one, so repeated
rows, ties and null ids need no rule; all given columns stay except those named like a result column,
which are replaced. Memory is bounded by one Arrow batch and a few times the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cupom.llm.common import text_bytes

WHITE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
LEVEL, CHUNK, LEAST_CHUNK = 3, 4096, 1000
#: (least bytes, lowest ratio, highest ratio): the last line whose length is reached holds.
BANDS = ((0, 0.5, np.inf), (100, 0.45, np.inf), (200, 0.4, 0.95), (1000, 0.33, 0.75), (5000, 0.28, 0.65), (20000, 0.22, 0.62))
CHUNK_BANDS = ((0, 0.0, np.inf), (LEAST_CHUNK, 0.3, 0.75))

FIELDS = (
    ("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()), ("n_dup_lines", T.LongType()),
    ("n_repeat_words", T.LongType()), ("base_failed", T.BooleanType()), ("ratio", T.DoubleType()),
    ("n_chunks", T.LongType()), ("n_odd_chunks", T.LongType()), ("kept", T.BooleanType()),
)


def repeat_words(words: list[bytes], span: int = 5) -> int:
    """Words inside windows of ``span`` words that occur at least twice in the list."""
    n = len(words) - span + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    # Rank windows of 1, 2, 4 ... words, each from two shorter ones, so equal ranks mean equal windows.
    ranks, width = codes, 1
    while width < span:
        step = min(width, span - width)
        pairs = ranks[: len(ranks) - step] * (int(ranks.max()) + 1) + ranks[step:]
        ranks, width = np.unique(pairs, return_inverse=True)[1], width + step
    often = np.bincount(ranks)[ranks] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += often
    edges[span : span + n] -= often
    return int(np.count_nonzero(np.cumsum(edges)[:-1]))


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a UTF-8 text."""
    words = text.split()  # of bytes: splits at ASCII white space alone
    trails = np.frombuffer(text, np.uint8)
    chars = int(np.count_nonzero((trails & 0xC0) != 0x80)) - sum(text.count(c) for c in (WHITE[i : i + 1] for i in range(6)))
    symbols = sum(text.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeat_words(words)


def band(bands, size: int) -> tuple[float, float]:
    return next((low, high) for least, low, high in reversed(bands) if size >= least)


def compression(text: bytes, squeeze: zstd.ZstdCompressor, bands, chunk_bands, chunk: int, chunk_share: float) -> tuple[float, int, int, bool]:
    """(whole ratio, chunks, chunks outside their band, verdict)."""
    if not text:
        return 0.0, 0, 0, True
    ratio = len(squeeze.compress(text)) / len(text)
    low, high = band(bands, len(text))
    cuts = list(range(0, len(text), chunk))
    if len(cuts) > 1 and len(text) - cuts[-1] < LEAST_CHUNK:
        cuts.pop()
    n, odd = len(cuts), 0
    for start, end in zip(cuts, [*cuts[1:], len(text)], strict=True):
        part = text[start:end]
        least, most = band(chunk_bands, len(part))
        odd += not least <= len(squeeze.compress(part)) / len(part) <= most
    return ratio, n, odd, low <= ratio <= high and odd <= chunk_share * n


def quality(docs: DataFrame, text: str = "text", bands=BANDS, chunk_bands=CHUNK_BANDS, chunk: int = CHUNK, chunk_share: float = 0.25, keep_text: bool = True) -> DataFrame:
    """``docs`` with base counts, ratios and the verdict ``kept``."""
    results = {name for name, _ in FIELDS}
    stay = [c for c in docs.columns if c.lower() not in results and (keep_text or c != text)]
    schema = T.StructType([docs.schema[c] for c in stay] + [T.StructField(n, t) for n, t in FIELDS])
    # The text goes last under a name of its own, so a text column that is replaced can still be read.
    source = docs.select(*stay, docs[text].cast("string").alias("_quality_text"))
    types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()]

    def task(batches):
        squeeze = zstd.ZstdCompressor(level=LEVEL, write_content_size=False)
        for batch in batches:
            data, offsets = text_bytes(batch.column(batch.num_columns - 1))
            rows = []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                body = data[a:b].tobytes()
                counts = base_counts(body)
                failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
                ratio, n, odd, fine = compression(body, squeeze, bands, chunk_bands, chunk, chunk_share)
                rows.append((*counts, failed, ratio, n, odd, fine and not failed))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*stay, *(n for n, _ in FIELDS)])

    return source.mapInArrow(task, schema)
