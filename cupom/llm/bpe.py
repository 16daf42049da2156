"""Byte-level BPE as a lazily determinised finite-state transducer.

Merges come as a rank file (token bytes -> rank). A token sequence is the BPE encoding of its bytes if
and only if every two neighbours are the encoding of their own joint bytes, so a transducer can guess
token ends and check neighbours: its configurations are (last token, place in the token trie, output
not yet emitted). ``Transducer`` determinises it byte by byte as texts need it: a state is the set
of live configurations, the output they share is emitted at once, and the rest waits for the few
bytes of lookahead that decide it. States and transitions are kept up to ``MAX_STATES``, then built afresh
(the output doesn't depend on it).

Text is first cut into pieces by the tokenizer's pattern. It is read in spans that end where white
space follows a character that isn't white space, where no piece can reach across, so memory doesn't grow
with the length of a text beyond the text itself.

``encode`` gives ids as little-endian unsigned 32-bit integers in a binary column; ``decode`` turns them
back into bytes and text, through an incremental UTF-8 decoder that carries an unfinished character from one span of
ids to the next.

Defined results: a null text counts as empty and has no ids; null ids decode to nothing; rows are
independent, so ties, repeated rows and null keys need no rule; given columns stay except those named
like a result, which are replaced; an id outside the vocabulary is an error.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cupom.llm.common import claim, texts

SPAN, MAX_STATES, MAX_PIECES, MAX_NEIGHBOURS = 1 << 16, 300_000, 400_000, 150_000
#: Rows and bytes that one output batch holds at most (a single longer row aside).
BATCH_ROWS, BATCH_BYTES = 1_000, 4 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return parse_ranks(f.read())


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


class Vocabulary:
    """A rank file, read by the driver and broadcast (a megabyte or so, whatever the data), and the pattern.

    ``states`` and ``pieces`` bound what each worker's encoder keeps (about 0.6 and 0.2 kB each): fewer take longer, with the same ids.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str, states: int | None = None, pieces: int | None = None):
        self.sizes = (states, pieces)
        with open(path, "rb") as f:
            content = f.read()
        self.content, self.pattern, self.name = spark.sparkContext.broadcast(content), pattern, hashlib.sha256(content).hexdigest()

    def encoder(self) -> Encoder:
        claim("bpe", _forget)
        key = (self.name, self.pattern, self.sizes)
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(parse_ranks(self.content.value), self.pattern, *self.sizes)
        return _ENCODERS[key]

    def library(self):
        """The tokenizer library's own encoder for the same vocabulary: text to an array of ids."""
        import tiktoken

        claim("bpe", _forget)
        if (self.name, self.pattern) not in _LIBRARY:
            _LIBRARY[self.name, self.pattern] = tiktoken.Encoding(self.name, pat_str=self.pattern, mergeable_ranks=parse_ranks(self.content.value), special_tokens={})
        encode = _LIBRARY[self.name, self.pattern].encode_ordinary
        return lambda text: np.concatenate([np.array(encode(s), np.uint32) for s in spans(text)])

    def decoder(self) -> Decoder:
        if self.name not in _DECODERS:
            _DECODERS[self.name] = Decoder(parse_ranks(self.content.value))
        return _DECODERS[self.name]


#: Per worker: encoders and decoders by their parameters.
_ENCODERS: dict = {}
_DECODERS: dict = {}
_LIBRARY: dict = {}


def _forget() -> None:
    for cache in (_ENCODERS, _DECODERS, _LIBRARY):
        cache.clear()


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Encoding by definition: join the adjacent pair of lowest rank, leftmost first, until none is left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """Bytes of one piece to token ids."""

    def __init__(self, ranks: dict[bytes, int], states: int | None = None):
        self.ranks, self.most = ranks, states
        self.tokens = {rank: token for token, rank in ranks.items()}
        # Trie: child by (node, byte), token that ends at a node, and whether a node has children.
        self.child: dict[int, int] = {}
        self.ends: list[int] = [-1]
        self.inner = bytearray(1)
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                step = self.child.get(node << 8 | byte)
                if step is None:
                    step = self.child[node << 8 | byte] = len(self.ends)
                    self.ends.append(-1)
                    self.inner.append(0)
                    self.inner[node] = 1
                node = step
            self.ends[node] = rank
        self.halves: dict[int, tuple[int, int] | None | bool] = {}
        self.neighbours: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        # A state is its configurations, flat: last token, node, how many tokens are held, those tokens.
        start = (-1, 0, 0)
        self.states: dict[tuple, int] = {start: 0}
        self.configurations, self.final = [start], [()]
        #: state << 8 | byte -> next state, or (next state, tokens to emit).
        self.steps: dict[int, int | tuple[int, tuple[int, ...]]] = {}

    def _halves(self, token: int):
        """The two tokens whose merge makes ``token`` last; None for a byte; False if merging its bytes doesn't make it."""
        if token not in self.halves:
            piece = self.tokens[token]
            parts = [piece[i : i + 1] for i in range(len(piece))]
            while len(parts) > 2:
                best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
                if parts[best] + parts[best + 1] not in self.ranks:
                    break
                parts[best : best + 2] = [parts[best] + parts[best + 1]]
            self.halves[token] = None if len(parts) == 1 else (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else False
        return self.halves[token]

    def _fits(self, last: int, token: int) -> bool:
        """Whether ``token`` may follow ``last`` in an encoding (-1: it begins the piece).

        Merges happen by rank, so the two sides are taken apart from the latest merge back; the tokens
        that then touch must not be a merge that would have come before the one just undone (at the same rank the one
        further left comes first).
        """
        if last < 0:
            return self._halves(token) is not False
        pair = last << 20 | token
        fits = self.neighbours.get(pair)
        if fits is None:
            if len(self.neighbours) >= MAX_NEIGHBOURS:
                self.neighbours.clear()
            fits = self.neighbours[pair] = self._halves(token) is not False and self._apart(last, token)
        return fits

    def _apart(self, left: int, right: int) -> bool:
        before = 1 << 60
        while True:
            joint = self.ranks.get(self.tokens[left] + self.tokens[right])
            if joint is not None and joint < before:
                return False
            of_left, of_right = self._halves(left), self._halves(right)
            made_left, made_right = left if of_left else -1, right if of_right else -1
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                left, before = of_left[1], made_left
            else:
                right, before = of_right[0], made_right + 1

    def _step(self, state: int, byte: int):
        """Determinise one transition: the next state, and the tokens that all its configurations share."""
        child, ends, inner, fits = self.child, self.ends, self.inner, self._fits
        after, flat, at = [], self.configurations[state], 0
        while at < len(flat):
            last, node, n = flat[at : at + 3]
            held = flat[at + 3 : at + 3 + n]
            at += 3 + n
            node = child.get(node << 8 | byte)
            if node is None:
                continue
            if inner[node]:
                after.append((last, node, held))
            token = ends[node]
            if token >= 0 and fits(last, token):
                after.append((token, 0, (*held, token)))
        shared, first = min(len(held) for _, _, held in after), after[0][2]
        for _, _, held in after:
            while first[:shared] != held[:shared]:
                shared -= 1
        key = []
        final = ()
        for last, node, held in sorted(after):
            key += (last, node, len(held) - shared, *held[shared:])
            if node == 0:  # one configuration has just ended a token: the piece may end here
                final = held[shared:]
        key = tuple(key)
        number = self.states.get(key)
        if number is None:
            number = self.states[key] = len(self.configurations)
            self.configurations.append(key)
            self.final.append(final)
        step = self.steps[state << 8 | byte] = (number, first[:shared]) if shared else number
        return step

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.configurations) > (self.most or MAX_STATES):
            self._reset()
        state, out, step_of = 0, [], self.steps.get
        for byte in piece:
            step = step_of(state << 8 | byte)
            if step is None:
                step = self._step(state, byte)
            if step.__class__ is int:
                state = step
            else:
                state, shared = step
                out += shared
        out += self.final[state]
        return out


_CUT = regex.compile(r"(?<=\S)\s")


def spans(text: str, size: int = SPAN):
    """Consecutive parts of a text that no piece reaches across."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class Encoder:
    """Texts to ids; remembers the ids of the pieces it met last."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, states: int | None = None, pieces: int | None = None):
        self.transducer, self.find, self.most = Transducer(ranks, states), regex.compile(pattern).findall, pieces
        self.seen: dict[str, bytes] = {}

    def piece(self, piece: str) -> bytes:
        if len(self.seen) >= (self.most or MAX_PIECES):
            self.seen.clear()
        ids = self.transducer.encode(piece.encode())
        ids = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            self.seen[piece] = ids
        return ids

    def stream(self, text: str):
        """Ids of each span, as little-endian unsigned 32-bit integers."""
        seen, make = self.seen, self.piece
        for span in spans(text):
            yield b"".join([seen.get(p) or make(p) for p in self.find(span)])

    def encode(self, text: str) -> bytes:
        return b"".join(self.stream(text))


class Decoder:
    """Ids to bytes and text, a span at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def stream(self, ids: bytes, span: int = SPAN):
        """(bytes, text) of each span; a character whose bytes two spans share comes with the second."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for at in range(0, len(ids), 4 * span):
            part = b"".join([self.tokens[i] for i in np.frombuffer(ids[at : at + 4 * span], "<u4").tolist()])
            yield part, machine.decode(part, final=at + 4 * span >= len(ids))


def _batched(rows, names: list[str], kinds: list[pa.DataType], columns):
    """Output batches of (row number, values ..., size) tuples beside the given columns, bounded in bytes."""
    at, values, held = 0, [], 0

    def batch(end: int) -> pa.RecordBatch:
        made = [pa.array(c, k) for c, k in zip(zip(*values, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*(c.slice(at, end - at) for c in columns), *made], names=names)

    for n, (*row, size) in enumerate(rows):
        values.append(row)
        held += size
        if len(values) >= BATCH_ROWS or held >= BATCH_BYTES:
            yield batch(n + 1)
            at, values, held = n + 1, [], 0
    if values:
        yield batch(at + len(values))


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids`` (binary, little-endian unsigned 32-bit integers)."""
    stay = [c for c in docs.columns if c.lower() not in ("n_tokens", "ids") and (keep_text or c != text)]
    schema = T.StructType([docs.schema[c] for c in stay] + [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    source = docs.select(*stay, docs[text].cast("string").alias("_bpe_text"))

    def task(batches):
        make = vocabulary.encoder().encode
        for batch in batches:
            rows = ((len(ids) // 4, ids, len(ids)) for ids in map(make, texts(batch.column(batch.num_columns - 1))))
            yield from _batched(rows, [*stay, "n_tokens", "ids"], [pa.int64(), pa.binary()], batch.columns[:-1])

    return source.mapInArrow(task, schema)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", keep_ids: bool = True) -> DataFrame:
    """``encoded`` with ``decoded`` (bytes) and ``decoded_text`` (undecodable bytes replaced)."""
    stay = [c for c in encoded.columns if c.lower() not in ("decoded", "decoded_text") and (keep_ids or c != ids)]
    schema = T.StructType([encoded.schema[c] for c in stay] + [T.StructField("decoded", T.BinaryType()), T.StructField("decoded_text", T.StringType())])
    source = encoded.select(*stay, encoded[ids].alias("_bpe_ids"))

    def task(batches):
        read = vocabulary.decoder().stream

        def row(value):
            parts = list(read(value or b""))
            body = b"".join(b for b, _ in parts)
            return body, "".join(t for _, t in parts), 2 * len(body)

        for batch in batches:
            rows = map(row, batch.column(batch.num_columns - 1).to_pylist())
            yield from _batched(rows, [*stay, "decoded", "decoded_text"], [pa.binary(), pa.string()], batch.columns[:-1])

    return source.mapInArrow(task, schema)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``docs`` with ``n_tokens``, ``ids`` and ``decoded`` (bytes, from the ids alone)."""
    results = ("n_tokens", "ids", "decoded")
    stay = [c for c in docs.columns if c.lower() not in results and (keep_text or c != text)]
    schema = T.StructType([docs.schema[c] for c in stay] + [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])
    source = docs.select(*stay, docs[text].cast("string").alias("_bpe_text"))

    def task(batches):
        write, read = vocabulary.encoder().encode, vocabulary.decoder().stream

        def row(body):
            ids = write(body)
            decoded = "".join(part for _, part in read(ids)).encode()
            return len(ids) // 4, ids, decoded, len(ids) + len(decoded)

        for batch in batches:
            rows = map(row, texts(batch.column(batch.num_columns - 1)))
            yield from _batched(rows, [*stay, *results], [pa.int64(), pa.binary(), pa.binary()], batch.columns[:-1])

    return source.mapInArrow(task, schema)
