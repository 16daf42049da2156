"""Prefix trie of conversations by splitter skeleton.

A conversation is the sequence of its turns; each distinct sequence of first d turns (role and text) is a node at depth d,
and the conversations that start with it are its members. Turns travel as 16-byte digests (of SHA-256; two
different turns are taken for one with a probability of 2^-128 a pair), so a path is the digests end to end and paths sort bytewise
like sequences.

Paths are dealt to shards by ranges of (path, conversation): splitters come from a bounded sample, each cut to the
first turn in which it differs from the one before. The trie of the splitters' paths, the skeleton, is broadcast. A node whose
members lie in two shards has a splitter between them that starts with its path, so every other node lies in one
shard, which finishes it in one sorted pass. Of skeleton nodes a shard gives partial aggregates; these are reduced by node,
then up the skeleton by prefix sums over its preorder. Splitters carry the conversation's id, so a path with any number of copies is
split, too.

Bounds: the sample has ``SAMPLES`` paths for each shuffle partition, each cut to ``SAMPLE_TURNS`` turns; every second
splitter is dropped while the skeleton exceeds ``SKELETON_BYTES`` (results don't depend on the splitters). A shard holds the
nodes on its current path and the unfinished children of the innermost ones; one conversation's digests are one row. The ids
that end at a skeleton node go through one task as text in chunks, in order, since a SHA-256 has to read them so; nothing is collected.

Defined results: null role or text counts as empty; turns sort by (turn, digest), null first, so ties have one order and repeated
rows are turns each; rows without a conv_id belong to no conversation and are left out; a conversation may end up without turns and is then a member of
the root alone; an empty table gives no rows, not even a root; other columns are ignored. Very long texts are read where they are
and not moved.
"""

from __future__ import annotations

import bisect
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cupom.llm.common import claim, stored

#: Bytes of a turn's digest; sampled paths for each shard, and turns of them that count; bytes of the broadcast skeleton.
DIGEST, SAMPLES, SAMPLE_TURNS, SKELETON_BYTES = 16, 16, 256, 64 << 20
#: Characters of decimal ids that one row carries.
CHUNK = 1 << 16
_BATCH = 5_000


def digest_of(role: Column, text: Column) -> Column:
    """Digest of a turn in hex: 2 * DIGEST letters."""
    return F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * DIGEST)


def sequences(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns) per conversation: array of (turn, digest, words) in order, without the texts."""
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_count(text_, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    narrow = rows.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv_id"), F.struct(F.col(turn).alias("turn"), digest_of(role_, text_).alias("digest"), words.alias("words")).alias("_turn"))
    return narrow.groupBy("conv_id").agg(F.array_sort(F.collect_list("_turn")).alias("turns"))


def rebuilt(convs: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """``convs`` with the first ``head`` (at most ``most``) turns of every one replaced by those of conversation ``base``; an absent base gives none."""
    heads = convs.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_heads"))
    n = head.cast("int")
    rest = F.slice("turns", n + 1, F.size("turns"))
    joined = convs.withColumn("_base", base).join(heads, "_base", "left")
    return joined.select("conv_id", F.when(F.col("_heads").isNull(), rest).otherwise(F.concat(F.slice("_heads", 1, n), rest)).alias("turns"))


def paths_of(convs: DataFrame) -> DataFrame:
    """(conv_id, path, words) per conversation: digests end to end, and words of each turn."""
    return convs.select("conv_id", F.unhex(F.array_join("turns.digest", "")).alias("path"), F.col("turns.words").alias("words"))


def shared(a: bytes, b: bytes) -> int:
    """Number of first turns that two paths have in common."""
    n, low, high = min(len(a), len(b)) // DIGEST, 0, min(len(a), len(b)) // DIGEST
    if a[: n * DIGEST] == b[: n * DIGEST]:
        return n
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * DIGEST] == b[: middle * DIGEST]:
            low = middle
        else:
            high = middle - 1
    return low


Splitter = tuple[bytes, int]
#: Below every id.
LOWEST = -(1 << 63)


def splitters_from(sample: list[Splitter], count: int) -> list[Splitter]:
    """At most ``count`` splitters at equal distances of a sorted sample, cut to the first turn that differs from the one before."""
    picked = [sample[len(sample) * k // (count + 1)] for k in range(1, count + 1)] if sample else []
    out: list[Splitter] = []
    for before, (path, conv) in zip([(b"", LOWEST), *picked], picked, strict=False):
        cut = path[: (shared(before[0], path) + 1) * DIGEST]
        key = (path, conv) if before[0] == path else (cut, LOWEST)
        if key > ((b"", LOWEST) if not out else out[-1]):
            out.append(key)
    return out


class Skeleton:
    """Trie of the splitters' paths: nodes numbered in preorder (0 is the root), each with its path, parent and last descendant."""

    def __init__(self, splitters: list[Splitter]):
        self.splitters, self.numbers, self.parents, self.last = splitters, {b"": 0}, [-1], [0]
        for path, _ in splitters:
            for end in range(DIGEST, len(path) + 1, DIGEST):
                if path[:end] not in self.numbers:
                    self.numbers[path[:end]] = len(self.parents)
                    self.parents.append(self.numbers[path[: end - DIGEST]])
                    self.last.append(0)
        for node in range(len(self.parents) - 1, -1, -1):
            self.last[node] = max(self.last[node], node)
            if node:
                self.last[self.parents[node]] = max(self.last[self.parents[node]], self.last[node])

    def size(self) -> int:
        return sum(len(path) + 100 for path in self.numbers)

    def shard(self, path: bytes, conv: int) -> int:
        return bisect.bisect_right(self.splitters, (path, conv))


def skeleton_of(paths: DataFrame, shards: int) -> Skeleton:
    """Skeleton of ``shards`` ranges, from the rows with the lowest hashes of their ids."""
    cut = F.substring(F.col("path"), 1, SAMPLE_TURNS * DIGEST)
    some = paths.select(F.xxhash64("conv_id").alias("h"), cut.alias("path"), "conv_id").orderBy("h", "conv_id").limit(SAMPLES * shards)
    sample = sorted((bytes(r.path), r.conv_id) for r in some.collect())
    splitters = splitters_from(sample, shards - 1)
    while (made := Skeleton(splitters)).size() > SKELETON_BYTES and splitters:
        splitters = splitters[1::2]
    return made


class _Node:
    """A node on the current path of a shard."""

    __slots__ = ("depth", "digest", "words", "number", "least", "members", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, depth: int, digest: bytes, words: int, number: int):
        self.depth, self.digest, self.words, self.number = depth, digest, words, number
        self.least, self.members, self.children, self.leaves, self.saved = 1 << 63, 0, 0, 0, 0
        self.ends, self.waiting = None, []


_NODES = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("kind", "shard", "number", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "words")]
    + [T.StructField("ends_sha256", T.StringType()), T.StructField("turn", T.BinaryType()), T.StructField("ids", T.StringType())]
)
_ARROW = pa.schema([(f.name, {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in _NODES])
#: Kinds of a shard's rows: a finished node, one whose parent is skeleton node ``number``, partial aggregates of ``number``, a chunk of ids that end there.
DONE, HANGING, PARTIAL, ENDS = range(4)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _finished(node: _Node, parent: _Node, shard: int):
    """Rows that a node gives when the path leaves it, after its values have gone into its parent."""
    parent.least, parent.members = min(parent.least, node.least), parent.members + node.members
    for row in node.waiting:
        yield (DONE, shard, None, *row[:2], node.least, *row[2:])
    if node.number >= 0:
        return
    leaves, saved = node.leaves if node.children else 1, node.saved + (node.members - 1) * node.words
    parent.children, parent.leaves, parent.saved = parent.children + 1, parent.leaves + leaves, parent.saved + saved
    ends = NO_ENDS if node.ends is None else node.ends.hexdigest()
    row = (node.least, node.depth, node.members, node.children, leaves, saved, node.words, ends, node.digest, None)
    if parent.number >= 0:
        yield (HANGING, shard, parent.number, *row[:2], None, *row[2:])
    else:
        parent.waiting.append(row)


def _partial(node: _Node, shard: int):
    return (PARTIAL, shard, node.number, node.least, node.depth, None, node.members, node.children, node.leaves, node.saved, node.words, None, node.digest, None)


def walk(rows, numbers: dict[bytes, int]):
    """Rows of ``_NODES`` for (shard, path, conv_id, words) sorted by the first three."""
    stack: list[_Node] = []
    shard, last, ids, held = None, b"", [], 0

    def leave(depth: int):
        while len(stack) > depth:
            node = stack.pop()
            if stack:
                yield from _finished(node, stack[-1], shard)
            else:
                for row in node.waiting:
                    yield (DONE, shard, None, *row[:2], node.least, *row[2:])
            if node.number >= 0:
                yield _partial(node, shard)

    def chunk():
        # The order of chunks is that of their first ids.
        return (ENDS, shard, stack[-1].number, ids[0], None, None, len(ids), None, None, None, None, None, None, ",".join(map(str, ids)))

    for shard_, path, conv, words in rows:
        if shard_ != shard or path != last:
            if ids:
                yield chunk()
                ids, held = [], 0
            common = shared(last, path) if shard_ == shard else -1
            yield from leave(common + 1)
            shard, last = shard_, path
            for depth in range(common + 1, len(path) // DIGEST + 1):
                at = depth * DIGEST
                inner = not stack or stack[-1].number >= 0  # a skeleton node's parent is one
                stack.append(_Node(depth, path[at - DIGEST : at] if depth else b"", words[depth - 1] if depth else 0, numbers.get(path[:at], -1) if inner else -1))
        node = stack[-1]
        node.least, node.members = min(node.least, conv), node.members + 1
        if node.number >= 0:
            ids.append(conv)
            held += len(str(conv)) + 1
            if held >= CHUNK:
                yield chunk()
                ids, held = [], 0
        elif node.ends is None:
            node.ends = hashlib.sha256(b"%d" % conv)
        else:
            node.ends.update(b",%d" % conv)
    if ids:
        yield chunk()
    yield from leave(0)


def _in_batches(rows, schema: pa.Schema):
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + len(row[-1] or "")
        if len(held) >= _BATCH or size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _ends(chunks: DataFrame) -> DataFrame:
    """(number, ends_sha256) of the skeleton nodes at which conversations end: chunks of one node are read in order, a batch at a time."""
    schema = pa.schema([("number", pa.int64()), ("ends_sha256", pa.string())])

    def task(batches):
        claim("prefix_trie")

        def rows():
            number, state = None, None
            for batch in batches:
                for at, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if at != number:
                        if state is not None:
                            yield number, state.hexdigest()
                        number, state = at, hashlib.sha256()
                    else:
                        state.update(b",")
                    state.update(ids.encode())
            if state is not None:
                yield number, state.hexdigest()

        yield from _in_batches(rows(), schema)

    return chunks.repartition("number").sortWithinPartitions("number", "shard", "conv_id").select("number", "ids").mapInArrow(task, "number long, ends_sha256 string")


def trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """Nodes of the trie over ``paths`` (conv_id, path, words): the aggregates of the module's contract and each node's ``turn`` digest.

    One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, words
    (of its last turn), ends_sha256, turn. Every path is read twice: for the sample, and for the shards.
    """
    spark = paths.sparkSession
    paths = stored(paths, "trie-paths")
    skeleton = skeleton_of(paths, max(1, shards or int(spark.conf.get("spark.sql.shuffle.partitions"))))
    known = spark.sparkContext.broadcast((skeleton.splitters, skeleton.numbers))

    def deal(batches):
        claim("prefix_trie")
        splitters = known.value[0]
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([bisect.bisect_right(splitters, k) for k in keys], pa.int32()), *batch.columns], names=["shard", *batch.schema.names])

    def local(batches):
        claim("prefix_trie")
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("shard", "path", "conv_id", "words")), strict=True))
        yield from _in_batches(walk(rows, known.value[1]), _ARROW)

    dealt = paths.mapInArrow(deal, T.StructType([T.StructField("shard", T.IntegerType()), *paths.schema]))
    in_order = dealt.repartitionById(len(skeleton.splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    made = stored(in_order.mapInArrow(local, _NODES), "trie-nodes")

    bones = spark.createDataFrame([(n, skeleton.parents[n], skeleton.last[n]) for n in range(len(skeleton.parents))], "number long, _parent long, _last long")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    own = made.where(F.col("kind") == PARTIAL).groupBy("number").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("words").alias("words"), F.max("turn").alias("turn"), *sums)
    own = stored(own.join(F.broadcast(bones), "number"), "trie-skeleton")
    inner = own.where("_parent >= 0").groupBy(F.col("_parent").alias("number")).agg(F.count("*").alias("_inner"))
    children = F.col("n_children") + F.coalesce("_inner", F.lit(0))
    own = own.join(inner, "number", "left").withColumn("n_children", children)
    own = own.withColumn("n_leaves", F.when(children == 0, 1).otherwise(F.col("n_leaves"))).withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"))
    # A subtree is a run of numbers: its sum is the difference of two prefix sums. The window has the skeleton's rows alone.
    upto = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    summed = stored(own.withColumn("_leaves", F.sum("n_leaves").over(upto)).withColumn("_saved", F.sum("saved_tokens").over(upto)), "trie-sums")
    ends_at = summed.select(F.col("number").alias("_last"), F.col("_leaves").alias("_leaves_to"), F.col("_saved").alias("_saved_to"))
    # Each skeleton node is a prefix of some conversation, so the last one of a subtree always has a row.
    whole = summed.join(ends_at, "_last").withColumn("n_leaves", F.col("_leaves_to") - F.col("_leaves") + F.col("n_leaves")).withColumn("saved_tokens", F.col("_saved_to") - F.col("_saved") + F.col("saved_tokens"))
    bone = whole.join(_ends(made.where(F.col("kind") == ENDS).select("number", "shard", "conv_id", "ids")), "number", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    bone = stored(bone, "trie-bones")
    parent = bone.select(F.col("number").alias("_of"), F.col("conv_id").alias("parent_conv_id"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "words", "ends_sha256", "turn"]
    bones_out = bone.join(F.broadcast(parent), F.col("_parent") == F.col("_of"), "left").select(*out)
    hanging = made.where(F.col("kind") == HANGING).drop("parent_conv_id").join(F.broadcast(parent), F.col("number") == F.col("_of")).select(*out)
    return made.where(F.col("kind") == DONE).select(*out).unionByName(hanging).unionByName(bones_out)
