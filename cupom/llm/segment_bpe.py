"""Byte-level BPE by a segment tree over the ranks of adjacent pairs, for tokenizer files in JSON.

A piece of text is a row of byte tokens. The leaves of a segment tree hold the merge ranks of neighbouring tokens (none:
``NONE``) and each inner node the lower of its two: the root's rank is the next merge, and going down by the left child
where both agree finds its leftmost place. A merge changes three leaves (its own pair, the one before, the one of the token that
is gone), each a logarithmic walk to the root; a piece is done when the root has no rank. The short pieces that a worker meets
for the first time are merged side by side, a tree to a row (``Forest``), longer ones alone (``merge_piece``).

Around it stands what the tokenizer file asks for: strings of added tokens are cut out of the text first (longest one where
several begin), the rest is split by the byte-level pattern, and each piece is merged on its own. The tokenizer
library's pattern knows an older Unicode than ``regex``: spans with a character that they class differently (found by
probing the library, ``differing``) are split by the library's own pre-tokenizer. Its encoder isn't used.

``encode`` gives ids as little-endian unsigned 32-bit integers in a binary column; ``decode`` turns them back into
text as the library does with ``skip_special_tokens=False`` (bytes that are no UTF-8 are replaced). Text is worked on in spans that
end where white space follows another character, so memory doesn't grow beyond a text and its ids.

Defined results: a null text counts as empty and has no ids; null ids decode to empty text; rows are independent, so ties, repeated
rows and null keys need no rule; an empty table gives an empty result; given columns stay except those named like a
result, which are replaced; an id outside the vocabulary is an error, and so is a file that asks for other steps (a normalizer,
a prefix space, dropout, stripping added tokens).
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import json
import struct
import sys

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cupom.llm.bpe import SPAN, _batched, spans
from cupom.llm.common import claim, texts

#: Rank of a pair that no merge joins.
NONE = 1 << 40
#: Pieces whose ids a worker remembers (about 0.2 kB each); bytes of the longest piece that is remembered and merged beside others.
MAX_PIECES, MAX_BYTES = 400_000, 64
#: Characters whose pieces are looked up together, and trees that are worked on together.
GROUP, ROWS = 1 << 18, 1 << 14


def byte_letters() -> list[str]:
    """Letter that stands for each byte in byte-level files: printable Latin-1 stands for itself, the rest follows from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in set(own) else chr(next(others)) for b in range(256)]


def merge_piece(tokens: list[int], rank_of, made: list[int]) -> list[int]:
    """Token ids of a piece after all merges. ``rank_of(left << 32 | right, NONE)`` is a pair's rank, ``made[rank]`` its joint id."""
    n = len(tokens)
    if n < 2:
        return tokens
    width = 1 << (n - 1).bit_length()
    tree = [NONE] * (2 * width)
    for i in range(n - 1):
        tree[width + i] = rank_of(tokens[i] << 32 | tokens[i + 1], NONE)
    for k in range(width - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a <= b else b
    # Places of the tokens before and after; none is n, whose leaf isn't read.
    before, after = [n, *range(n - 1)], [*range(1, n + 1)]
    while (rank := tree[1]) < NONE:
        k = 1
        while k < width:
            k *= 2
            if tree[k] != rank:
                k += 1
        left = k - width
        gone = after[left]
        right, prev = after[gone], before[left]
        token = tokens[left] = made[rank]
        after[left] = right
        if right < n:
            before[right] = left
            changes = [(gone, NONE), (left, rank_of(token << 32 | tokens[right], NONE))]
        else:
            changes = [(gone, NONE), (left, NONE)]
        if prev < n:
            changes.append((prev, rank_of(tokens[prev] << 32 | token, NONE)))
        for leaf, rank in changes:
            k = width + leaf
            tree[k] = rank
            while k > 1:
                other = tree[k ^ 1]
                k >>= 1
                if other < rank:
                    rank = other
                if tree[k] == rank:
                    break
                tree[k] = rank
    out, at = [], 0
    while at < n:
        out.append(tokens[at])
        at = after[at]
    return out


class Forest:
    """Segment trees of many short pieces, of equal width, merged in step: every round takes each tree's leftmost lowest rank."""

    def __init__(self, ranks: dict[int, int], made: list[int]):
        self.keys = np.array(sorted(ranks), np.int64)
        self.ranks = np.array([ranks[k] for k in self.keys.tolist()], np.int64)
        self.made = np.array(made, np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray, there: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens; ``NONE`` where no merge joins them, or the pair isn't ``there``."""
        out = np.full(len(left), NONE, np.int64)
        if len(self.keys):
            wanted = left << 32 | right
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = there & (self.keys[at] == wanted)
            out[hit] = self.ranks[at[hit]]
        return out

    def merge(self, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of pieces end to end, and how many each has; the pieces' first tokens come end to end, too."""
        n, width = len(sizes), 1 << max(1, int(sizes.max() - 1).bit_length())
        # Rows have one more place than tokens, which stands for "none", and trees one more node, for the leaf of none.
        place = np.arange(width + 1)
        alive = place < sizes[:, None]
        token = np.zeros((n, width + 1), np.int64)
        token[alive] = tokens
        after = np.where(place + 1 < sizes[:, None], place + 1, width).ravel()
        before = np.where((place > 0) & (place < sizes[:, None]), place - 1, width).ravel()
        tree = np.full((n, 2 * width + 1), NONE, np.int64)
        pair = alive[:, 1:]
        tree[:, width : 2 * width][pair] = self.rank(token[:, :-1][pair], token[:, 1:][pair], np.ones(int(pair.sum()), bool))
        level = width // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2
        alive, token, tree = alive.ravel(), token.ravel(), tree.ravel()
        rows = np.flatnonzero(tree[1 :: 2 * width + 1] < NONE)
        while len(rows):
            at, root = rows * (width + 1), rows * (2 * width + 1)
            rank = tree[root + 1]
            k = np.ones(len(rows), np.int64)
            for _ in range(width.bit_length() - 1):
                k *= 2
                k += tree[root + k] != rank
            left = k - width
            gone = after[at + left]
            right, prev = after[at + gone], before[at + left]
            new = self.made[rank]
            token[at + left], alive[at + gone] = new, False
            after[at + left], before[at + right] = right, left
            tree[root + width + gone] = NONE
            tree[root + width + prev] = self.rank(token[at + prev], new, prev < width)
            tree[root + width + left] = self.rank(new, token[at + right], right < width)
            for leaf in (gone, left, np.where(prev < width, prev, left)):
                k = width + leaf
                for _ in range(width.bit_length() - 1):
                    k >>= 1
                    tree[root + k] = np.minimum(tree[root + 2 * k], tree[root + 2 * k + 1])
            rows = rows[tree[root + 1] < NONE]
        return token[alive], alive.reshape(n, -1).sum(axis=1)


@functools.cache
def differing(pattern: str) -> str:
    """Characters that the library's byte-level pre-tokenizer and ``regex`` split differently, as the inside of a character class.

    Each assigned character is probed between a letter, a digit, a sign and blanks; unassigned ones are in no class of either.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    library, find = ByteLevel(add_prefix_space=False, use_regex=True), regex.compile(pattern).findall
    known = regex.compile(r"[^\p{Cn}\p{Co}\p{Cs}]").findall("".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)])))

    def agree(characters: list[str]) -> bool:
        probe = "\n".join(f"a{c}1{c}!{c} {c}{c}" for c in characters)
        return [probe[a:b] for _, (a, b) in library.pre_tokenize_str(probe)] == find(probe)

    def search(characters: list[str]) -> list[str]:
        if not characters or agree(characters):
            return []
        half = len(characters) // 2
        return search(characters[:half]) + search(characters[half:]) if half else characters

    found = [c for at in range(0, len(known), 256) for c in search(known[at : at + 256])]
    ranges: list[list[int]] = []
    for point in map(ord, found):
        if ranges and ranges[-1][1] == point - 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "".join(rf"\U{a:08X}-\U{b:08X}" for a, b in ranges)


class Tokenizer:
    """A tokenizer file (JSON text): texts to ids and back."""

    def __init__(self, content: str, pattern: str, odd: str, pieces: int = MAX_PIECES):
        spec = json.loads(content)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = all(not model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
        if spec["normalizer"] or model["type"] != "BPE" or not plain or pre.get("type") != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("not a plain byte-level BPE tokenizer file")
        vocab = model["vocab"]
        self.whole = vocab if model.get("ignore_merges") else None
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.ranks = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in reversed(list(enumerate(pairs)))}
        self.made = [vocab[a + b] for a, b in pairs]
        self.letters = byte_letters()
        self.bytes_ = [vocab[letter] for letter in self.letters]
        self.pieces, self.seen = pieces, {}
        self.forest, self.first = Forest(self.ranks, self.made), np.array(self.bytes_, np.int64)
        self.find, self.odd = regex.compile(pattern).findall, regex.compile(f"[{odd}]") if odd else None
        self.least_odd = min(int(x, 16) for x in odd.replace("-", "").split(r"\U")[1:]) if odd else 0
        self.library = None
        added = spec.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens with single_word, lstrip, rstrip or normalized are not supported")
        self.added = {t["content"]: t["id"] for t in added}
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        byte_of = {letter: b for b, letter in enumerate(self.letters)}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        self.tokens: list[bytes | None] = [None] * (max(names, default=-1) + 1)
        for i, name in names.items():
            self.tokens[i] = bytes(byte_of[c] for c in name) if all(c in byte_of for c in name) else name.encode()

    def learn(self, pieces: list[str]) -> None:
        """Find and remember the ids of pieces."""
        short: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            body = piece.encode()
            if self.whole is not None and (name := "".join(self.letters[b] for b in body)) in self.whole:
                self.seen[piece] = struct.pack("<I", self.whole[name])
            elif len(body) <= MAX_BYTES:
                short.setdefault(max(1, (len(body) - 1).bit_length()), []).append((piece, body))
            else:
                ids = merge_piece([self.bytes_[b] for b in body], self.ranks.get, self.made)
                self.seen[piece] = struct.pack(f"<{len(ids)}I", *ids)
        for group in short.values():
            for at in range(0, len(group), ROWS):
                part = group[at : at + ROWS]
                first = self.first[np.frombuffer(b"".join([body for _, body in part]), np.uint8)]
                ids, counts = self.forest.merge(first, np.array([len(body) for _, body in part]))
                packed, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
                for (piece, _), start, end in zip(part, [0, *ends], ends, strict=False):
                    self.seen[piece] = packed[start:end]

    def split(self, span: str) -> list[str]:
        """Pieces of a span, as the library's pre-tokenizer cuts them."""
        if self.odd is None or span.isascii() or np.frombuffer(span.encode("utf-32-le"), np.uint32).max() < self.least_odd or self.odd.search(span) is None:
            return self.find(span)
        if self.library is None:
            from tokenizers.pre_tokenizers import ByteLevel

            self.library = ByteLevel(add_prefix_space=False, use_regex=True)
        return [span[a:b] for _, (a, b) in self.library.pre_tokenize_str(span)]

    def encode_all(self, texts):
        """Ids of each text, packed. Pieces are looked up for ``GROUP`` characters at a time, of one text or several."""
        waiting: list[list] = []  # per text: ids, or pieces to look up
        held: list[tuple[list, int]] = []
        size = 0

        def look_up() -> None:
            if len(self.seen) > self.pieces:
                self.seen.clear()
            seen = self.seen
            new = {p for parts, at in held for p in parts[at] if p not in seen}
            self.learn(list(new))
            for parts, at in held:
                parts[at] = b"".join([seen[p] for p in parts[at]])
            for long in [p for p in new if len(p) > MAX_BYTES]:
                del seen[long]
            held.clear()

        for text in texts:
            parts: list = []
            waiting.append(parts)
            # Every second part is an added token's string.
            for k, part in enumerate(self.cut.split(text) if self.cut else (text,)):
                if k % 2:
                    parts.append(struct.pack("<I", self.added[part]))
                    continue
                for span in spans(part):
                    parts.append(self.split(span))
                    held.append((parts, len(parts) - 1))
                    size += len(span)
                    if size >= GROUP:
                        look_up()
                        size = 0
            if not held:
                yield from map(b"".join, waiting)
                waiting = []
        look_up()
        yield from map(b"".join, waiting)

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def decode(self, ids: bytes) -> str:
        machine, parts = codecs.getincrementaldecoder("utf-8")("replace"), []
        for at in range(0, len(ids), 4 * SPAN):
            parts.append(machine.decode(b"".join([self.tokens[i] for i in np.frombuffer(ids[at : at + 4 * SPAN], "<u4").tolist()])))
        return "".join(parts) + machine.decode(b"", final=True)


class Vocabulary:
    """A tokenizer file, read by the driver and broadcast (some megabytes, whatever the data), with the byte-level pattern."""

    def __init__(self, spark: SparkSession, path: str, pattern: str, pieces: int = MAX_PIECES):
        with open(path, encoding="utf-8") as f:
            content = f.read()
        self.content, self.pattern, self.odd, self.pieces = spark.sparkContext.broadcast(content), pattern, differing(pattern), pieces
        self.name = hashlib.sha256(content.encode()).hexdigest()

    def tokenizer(self) -> Tokenizer:
        claim("segment_bpe", _TOKENIZERS.clear)
        key = (self.name, self.pattern, self.pieces)
        if key not in _TOKENIZERS:
            _TOKENIZERS[key] = Tokenizer(self.content.value, self.pattern, self.odd, self.pieces)
        return _TOKENIZERS[key]


#: Per worker: tokenizers by their parameters.
_TOKENIZERS: dict = {}


def _mapped(given: DataFrame, column: str, kind: str, keep: bool, results: dict[str, tuple[T.DataType, pa.DataType]], vocabulary: Vocabulary, make) -> DataFrame:
    """``given`` with ``results``, which ``make(tokenizer, values)`` gives row by row with their size in bytes; ``column`` stays if ``keep``."""
    stay = [c for c in given.columns if c.lower() not in results and (keep or c != column)]
    schema = T.StructType([given.schema[c] for c in stay] + [T.StructField(n, spark_type) for n, (spark_type, _) in results.items()])
    source = given.select(*stay, given[column].cast(kind).alias("_segment_value"))

    def task(batches):
        tokenizer = vocabulary.tokenizer()
        for batch in batches:
            last = batch.column(batch.num_columns - 1)
            values = texts(last) if kind == "string" else last.to_pylist()
            yield from _batched(make(tokenizer, values), [*stay, *results], [arrow for _, arrow in results.values()], batch.columns[:-1])

    return source.mapInArrow(task, schema)


_IDS = {"n_tokens": (T.LongType(), pa.int64()), "ids": (T.BinaryType(), pa.binary())}
_DECODED = {"decoded": (T.StringType(), pa.string())}


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids`` (binary, little-endian unsigned 32-bit integers)."""

    def make(tokenizer: Tokenizer, values: list[str]):
        return ((len(ids) // 4, ids, len(ids)) for ids in tokenizer.encode_all(values))

    return _mapped(docs, text, "string", keep_text, _IDS, vocabulary, make)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", keep_ids: bool = True) -> DataFrame:
    """``encoded`` with ``decoded`` (text)."""

    def make(tokenizer: Tokenizer, values: list[bytes | None]):
        return ((body, 4 * len(body)) for body in (tokenizer.decode(value or b"") for value in values))

    return _mapped(encoded, ids, "binary", keep_ids, _DECODED, vocabulary, make)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``docs`` with ``n_tokens``, ``ids`` and ``decoded`` (text, from the ids alone)."""

    def make(tokenizer: Tokenizer, values: list[str]):
        for ids in tokenizer.encode_all(values):
            body = tokenizer.decode(ids)
            yield len(ids) // 4, ids, body, len(ids) + 4 * len(body)

    return _mapped(docs, text, "string", keep_text, _IDS | _DECODED, vocabulary, make)
