"""Near-duplicates by ProbMinHash, banding and exact verification.

Texts become weighted sets of ``SHINGLE``-word shingles (a shorter text is one shingle), weight
1 + ln(count). Each element sends a Poisson process of arrivals with its weight as rate, each to a random
register; a register keeps the element that arrived first, and an element stops once its next arrival is later than
all registers of its text. Two texts agree in a register with their probability Jaccard similarity. ``BANDS``
bands of ``ROWS`` registers make buckets. Pairs are accepted by the plain Jaccard similarity of their shingle sets, which may be
far above the weighted one where shingles repeat, so such texts have a second set of bands with all weights 1 (elsewhere the two
are the same). A pair at 0.8 in either measure fails to meet with probability (1 - 0.8^4)^32 < 1e-7.

No bucket is paired up. Equal texts are one node. Every bucket has a hub, the member that meets most texts over all its bands,
and each member is verified against its hubs alone (Jaccard similarity of the shingle sets, on the texts). That leaves pairs of one
bucket of which a member isn't similar to the hub. Verification has also stored how each member differs from its
hub (shingles it has besides, hub's shingles it lacks), which is enough to compute the similarity of any two
members: those not linked to the hub are compared with all members of the hub's group, in blocks of
``BLOCK`` by ``BLOCK`` members, and only links between different classes leave the task. Classes are connected components.

Words are runs of anything but ASCII white space. Defined results: a text without words (null too) is a class of its own;
a class is named by its smallest doc_id (null only if all its doc_ids are null); rows that repeat are one class; ties need no rule;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cupom.llm.common import claim, stored, text_bytes
from cupom.llm.graph import components
from cupom.llm.words import groups, split

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
BATCH_BYTES, BATCH_TEXTS, BLOCK = 2 << 20, 8192, 2048
#: Bits that tell the texts of a batch apart, above those of a shingle's hash.
TEXT_BITS = 14
#: Arrivals drawn in one round, at least.
ROUND = 16_384


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(data: np.ndarray, offsets: np.ndarray, span: int = SHINGLE) -> np.ndarray:
    """text << 50 | hash of every shingle of at most 2^14 texts, repeated ones too, in no order."""
    words = split(data, offsets, "dark", False)
    counts = words.counts()
    n = len(words.hashes)
    if n == 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        # A window that begins late in its text stops at the text's end; all but the first of those go, unless it is a short text's only one.
        place = np.arange(n) - np.repeat(words.firsts[:-1], counts)
        left = np.repeat(counts, counts) - place
        keep = (left >= span) | (place == 0)
        padded = np.concatenate([words.hashes, np.zeros(span, np.uint64)])
        total = np.zeros(n, np.uint64)
        for i in range(span):
            total = total * np.uint64(0xD6E8FEB86659FD93) + np.where(left > i, padded[i : i + n], np.uint64(i + 1))
        total = _mix(total[keep])
    text = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)[keep]
    return text << np.uint64(64 - TEXT_BITS) | total >> np.uint64(TEXT_BITS)


def signatures(keys: np.ndarray, n_texts: int, registers: int = REGISTERS) -> np.ndarray:
    """Register contents, an element's hash each, of texts whose shingles ``keys`` holds; 0 in texts without any."""
    found = np.zeros(n_texts * registers, np.uint64)
    if len(keys) == 0:
        return found.reshape(n_texts, registers)
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.concatenate([first, [len(keys)]]))
    keys = keys[first]
    text = (keys >> np.uint64(64 - TEXT_BITS)).astype(np.int64)
    element = keys & np.uint64((1 << (64 - TEXT_BITS)) - 1)
    rate = 1 + np.log(counts)
    times = np.full(n_texts * registers, np.inf)
    clock = np.zeros(len(keys))
    live, drawn = np.arange(len(keys)), 0
    with np.errstate(over="ignore"):
        while len(live):
            # The next ``width`` arrivals of all live elements: waits are exponential, drawn from the element's own hash.
            width = max(1, ROUND // len(live))
            number = np.arange(drawn, drawn + width, dtype=np.uint64)
            draw = _mix(element[live][:, None] + _mix(number + np.uint64(1))[None, :])
            wait = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate[live][:, None]
            arrival = clock[live][:, None] + np.cumsum(wait, axis=1)
            register = (_mix(draw + np.uint64(0x632BE59BD9B4E019)) % np.uint64(registers)).astype(np.int64)
            slot = (text[live][:, None] * registers + register).ravel()
            flat = arrival.ravel()
            better = np.flatnonzero(flat < times[slot])
            slot, flat = slot[better], flat[better]
            np.minimum.at(times, slot, flat)
            won = flat == times[slot]
            found[slot[won]] = element[live][better[won] // width]
            clock[live] = arrival[:, -1]
            drawn += width
            latest = times.reshape(n_texts, registers).max(axis=1)
            live = live[clock[live] < latest[text[live]]]
    return found.reshape(n_texts, registers)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One bucket key per text and band."""
    n, registers = signature.shape
    parts = signature.reshape(n, bands, registers // bands)
    with np.errstate(over="ignore"):
        key = np.tile(_mix(np.arange(1, bands + 1, dtype=np.uint64)), (n, 1))
        for i in range(parts.shape[2]):
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key.astype(np.int64)


def all_bands(keys: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of bucket keys of each text, keys): those of weights 1, and those of weights 1 + ln(count) that differ."""
    place = lambda x: (x >> np.uint64(64 - TEXT_BITS)).astype(np.int64)
    elements, counts = np.unique(keys, return_counts=True)
    wordy, repeats = np.zeros(n_texts, bool), np.zeros(n_texts, bool)
    wordy[place(elements)] = True
    repeats[place(elements[counts > 1])] = True
    plain = band_keys(signatures(elements, n_texts))
    bands, chosen = plain, np.repeat(wordy[:, None], plain.shape[1], axis=1)
    if repeats.any():
        rows = np.flatnonzero(repeats)
        weighted = np.zeros_like(plain)
        # Texts with repeated shingles alone, under numbers of their own.
        mine = keys[repeats[place(keys)]]
        number = (np.cumsum(repeats) - 1).astype(np.uint64)[place(mine)]
        element = mine & np.uint64((1 << (64 - TEXT_BITS)) - 1)
        weighted[rows] = band_keys(signatures(number << np.uint64(64 - TEXT_BITS) | element, len(rows)))
        bands, chosen = np.concatenate([plain, weighted], axis=1), np.concatenate([chosen, repeats[:, None] & (weighted != plain)], axis=1)
    return chosen.sum(axis=1), bands[chosen]


def text_key(text: Column) -> Column:
    """Node of a text: 128 bits of digest."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def sign(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, node, n_shingles, bands) per row; rows without words have no bands."""

    def task(batches):
        claim("probminhash")
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for a, b in _small(offsets):
                keys = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                sizes, bands = all_bands(keys, b - a)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(bands))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), lists], names=["doc_id", "node", "bands"])

    source = docs.select(docs[key].cast("long").alias("doc_id"), text_key(docs[text]).alias("node"), docs[text].cast("string").alias("text"))
    return source.mapInArrow(task, "doc_id long, node binary, bands array<bigint>")


def _small(offsets: np.ndarray):
    """Ranges of texts with bounded bytes and number."""
    for a, b in groups(offsets, BATCH_BYTES):
        for at in range(a, b, BATCH_TEXTS):
            yield at, min(at + BATCH_TEXTS, b)


def compare(left: pa.Array, right: pa.Array):
    """Per pair of texts: (similarity, size of left, size of right, extra, lacks).

    ``extra``: 32-bit hashes of the shingles that left has and right has not; ``lacks``: a bit per
    shingle of right, in order of hash, set where left lacks it.
    """
    data, offsets = text_bytes(left)
    other, other_offsets = text_bytes(right)
    n, a = len(offsets) - 1, 0
    while a < n:
        # As many pairs as both sides' bytes allow.
        b = a + 1
        while b < n and b - a < BATCH_TEXTS and offsets[b + 1] - offsets[a] <= BATCH_BYTES and other_offsets[b + 1] - other_offsets[a] <= BATCH_BYTES:
            b += 1
        mine = np.unique(shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
        hubs = np.unique(shingles(other[other_offsets[a] : other_offsets[b]], other_offsets[a : b + 1] - other_offsets[a]))
        pair_of = lambda x: (x >> np.uint64(64 - TEXT_BITS)).astype(np.int64)
        at = np.searchsorted(hubs, mine)
        shared = hubs[np.minimum(at, max(len(hubs) - 1, 0))] == mine if len(hubs) else np.zeros(len(mine), bool)
        have = np.zeros(len(hubs), bool)
        have[at[shared]] = True
        sizes, hub_sizes = np.bincount(pair_of(mine), minlength=b - a), np.bincount(pair_of(hubs), minlength=b - a)
        both = np.bincount(pair_of(mine[shared]), minlength=b - a)
        similarity = both / np.maximum(sizes + hub_sizes - both, 1)
        extra = (mine[~shared] & np.uint64(0xFFFFFFFF)).astype("<u4")
        extra_ends = np.concatenate([[0], np.cumsum(sizes - both)])
        hub_ends = np.concatenate([[0], np.cumsum(hub_sizes)])
        for i in range(b - a):
            lacks = np.packbits(~have[hub_ends[i] : hub_ends[i + 1]], bitorder="little").tobytes()
            yield float(similarity[i]), int(sizes[i]), int(hub_sizes[i]), extra[extra_ends[i] : extra_ends[i + 1]].tobytes(), lacks
        a = b


def verify(pairs: DataFrame, nodes: DataFrame, detail: bool = True) -> DataFrame:
    """Pairs (a, b) of nodes with their exact similarity; with ``detail``, how a differs from b."""

    def task(batches):
        claim("probminhash")
        for batch in batches:
            rows = list(compare(batch.column(2), batch.column(3)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            out = [batch.column(0), batch.column(1), pa.array(columns[0], pa.float64())]
            if detail:
                out += [pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.binary()), pa.array(columns[4], pa.binary())]
            yield pa.RecordBatch.from_arrays(out, names=[n for n, _ in fields])

    fields = [("a", "binary"), ("b", "binary"), ("similarity", "double")]
    if detail:
        fields += [("size", "long"), ("hub_size", "long"), ("extra", "binary"), ("lacks", "binary")]
    first = nodes.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    second = nodes.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(task, ", ".join(f"{n} {t}" for n, t in fields))


def hub_links(signed: DataFrame) -> DataFrame:
    """Distinct (a, b): every node with the hubs of its buckets."""
    nodes = signed.groupBy("node").agg(F.first("bands").alias("bands"))  # equal texts have equal bands
    members = nodes.where(F.size("bands") > 0).select("node", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(members.join(sizes, "bucket"), "buckets")
    reach = members.groupBy("node").agg(F.sum("n").alias("reach"))
    hubs = members.join(reach, "node").groupBy("bucket").agg(F.max_by("node", F.struct("reach", "node")).alias("hub"))
    return members.join(hubs, "bucket").where(F.col("node") != F.col("hub")).select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()


def block_links(rows: list[dict], others: list[dict], same: bool, similarity: float = SIMILARITY) -> list[tuple[bytes, bytes]]:
    """Links between classes: each of ``rows`` with all of ``others``, both known by their difference from one hub.

    |u and x| = |hub| - |u lacks or x lacks| + |extra of both|, so one pass over the shingles that a row
    has besides gives its similarity with a whole block.
    """
    hub_size = (rows or others)[0]["hub_size"]
    words = -(-hub_size // 64)
    pad = lambda b: np.frombuffer(b.ljust(8 * words, b"\0"), "<u8")
    lacks = np.stack([pad(x["lacks"]) for x in others])
    size = np.array([x["size"] for x in others])
    klass = [x["class"] for x in others]
    numbers: dict[bytes, int] = {}
    classes = np.array([numbers.setdefault(c, len(numbers)) for c in klass])
    extras = [np.frombuffer(x["extra"], "<u4") for x in others]
    owner = np.repeat(np.arange(len(others)), [len(e) for e in extras])
    joined = np.concatenate(extras) if extras else np.zeros(0, "<u4")
    order = np.argsort(joined, kind="stable")
    joined, owner = joined[order], owner[order]
    links, joined_classes = [], set()
    for i, u in enumerate(rows):
        own = np.frombuffer(u["extra"], "<u4")
        low, high = np.searchsorted(joined, own, "left"), np.searchsorted(joined, own, "right")
        n = high - low
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        besides = np.bincount(owner[at], minlength=len(others))
        missing = np.bitwise_count(lacks | pad(u["lacks"])[None, :]).sum(axis=1, dtype=np.int64)
        shared = hub_size - missing + besides
        alike = shared >= similarity * (size + u["size"] - shared) - 1e-9
        mine = numbers.get(u["class"], -1)
        alike &= classes != mine
        if same:
            alike[: i + 1] = False
        for c in np.unique(classes[alike]).tolist():
            pair = (mine, c)
            if pair in joined_classes and mine >= 0:
                continue
            joined_classes.update((pair, pair[::-1]))
            x = others[int(np.flatnonzero(alike & (classes == c))[0])]
            links.append((u["a"], x["a"]))
    return links


def rest_links(checked: DataFrame, classes: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """(a, b) for links between classes inside hub groups that the hub's own links don't give."""
    linked = F.col("similarity") >= similarity
    sizes = checked.groupBy("b").agg(F.count_if(~linked).alias("n_free"), F.count_if(linked).alias("n_linked"))
    # A group with one free member and no other has nothing left to compare.
    open_ = sizes.where((F.col("n_free") > 0) & (F.col("n_free") + F.col("n_linked") > 1))
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / block)).cast("int")
    members = (
        checked.join(open_, "b")
        .join(classes.select(F.col("node").alias("a"), F.col("root").alias("class")), "a", "left")
        .withColumn("class", F.coalesce("class", "a"))
        .withColumn("free", ~linked)
    )
    hashed = F.xxhash64("a", "b")
    free_blocks, linked_blocks = blocks("n_free"), F.when(F.col("n_linked") > 0, blocks("n_linked")).otherwise(F.lit(0))
    mine = F.pmod(hashed, F.when(F.col("free"), free_blocks).otherwise(blocks("n_linked"))).cast("int")
    # Block pairs: free i with free j (i <= j), and free i with linked j (numbered after the free blocks).
    own = members.withColumn("mine", mine)
    all_free = F.sequence(F.lit(0), free_blocks - 1)
    meets = F.when(
        F.col("free"),
        F.concat(
            F.transform(all_free, lambda j: F.struct(F.least(F.col("mine"), j).alias("i"), F.greatest(F.col("mine"), j).alias("j"))),
            F.transform(F.when(linked_blocks > 0, F.sequence(F.lit(0), linked_blocks - 1)).otherwise(F.expr("cast(array() as array<int>)")), lambda j: F.struct(F.col("mine").alias("i"), (free_blocks + j).alias("j"))),
        ),
    ).otherwise(F.transform(all_free, lambda i: F.struct(i.alias("i"), (free_blocks + F.col("mine")).alias("j"))))
    dealt = own.withColumn("meet", F.explode(meets)).select("b", "meet.i", "meet.j", "mine", "free", "a", "class", "size", "hub_size", "extra", "lacks")

    def task(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        i, j = (rows[0]["i"], rows[0]["j"]) if rows else (0, 0)
        left = [x for x in rows if x["free"] and x["mine"] == i]
        right = left if i == j else [x for x in rows if not (x["free"] and x["mine"] == i)]
        found = block_links(left, right, i == j, similarity) if left and right else []
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    return dealt.groupBy("b", "i", "j").applyInArrow(task, "a binary, b binary").distinct()


def classify(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, node, root, class_id) per row: rows of one class, which ``root`` marks, are near-duplicates or connected by such."""
    signed = stored(sign(docs, key, text), "signed")
    pairs = stored(hub_links(signed), "hub-links")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = docs.select(text_key(docs[text]).alias("node"), docs[text].cast("string").alias("text"))
    # One row for each text that is to be compared; equal texts meet in a map-side aggregation.
    # As a merge join at any size: the wanted texts grow with the input, so they are never broadcast.
    nodes = stored(texts.join(wanted.hint("merge"), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")), "compared")
    checked = stored(verify(pairs, nodes), "checked")
    links = checked.where(F.col("similarity") >= similarity).select("a", "b")
    classes = components(links)
    rest = stored(verify(rest_links(checked, classes, similarity), nodes, detail=False).where(F.col("similarity") >= similarity).select("a", "b"), "rest-links")
    classes = components(links.unionByName(rest))
    rows = signed.select("doc_id", "node", F.size("bands").alias("n_bands"))
    roots = rows.join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = roots.where("n_bands > 0").groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return roots.join(names, "root", "left").select("doc_id", "node", "root", F.when(F.col("n_bands") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class: that with the smallest doc_id (null last), then the smallest digest, then the smallest hash of its columns.

    Texts without words are in no class and all stay.
    """
    wordy = F.coalesce(docs[text].rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    last = F.lit(np.iinfo(np.int64).max)
    first = (
        classify(docs.where(wordy), key, text, similarity)
        .groupBy("root")
        .agg(F.min(F.struct(F.coalesce("doc_id", last).alias("id"), F.col("node"))).alias("first"))
        .select(F.col("first.id").alias("_pm_id"), F.col("first.node").alias("_pm_node"))
    )
    rows = docs.withColumns({"_pm_id": F.coalesce(docs[key].cast("long"), last), "_pm_node": text_key(docs[text])})
    # Both keys are those of the join: rows that repeat id and text are told apart without another shuffle.
    twins = Window.partitionBy("_pm_id", "_pm_node").orderBy(F.xxhash64(*[docs[c] for c in docs.columns if c != text]))
    kept = rows.where(wordy).join(first, ["_pm_id", "_pm_node"], "left_semi").withColumn("_pm_row", F.row_number().over(twins)).where("_pm_row = 1")
    return kept.select(*docs.columns).unionByName(docs.where(~wordy))
