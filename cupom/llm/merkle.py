"""Merkle manifest of a dataset: a hash tree per source over its documents, and one over the sources.

A leaf is the hash of a row's fields, each as ``-`` if null, else its UTF-8 length, ``:`` and the value. Leaves of a source ascend
by document id; every ``FANOUT`` consecutive nodes become the hash of their hashes end to end (lowercase hex), level by
level, until one is left (a lone leaf stays as it is): the source's subroot. Subroots in the order of their sources
(null first, then by UTF-8 bytes) give the root in the same way.

Levels are slot pivots: one conditional aggregate per slot spreads a parent's children over ``FANOUT`` columns. Concatenating
the columns hashes the parent, and leaving out a child's own column gives its siblings, so proofs come from the parents
alone, from the top down: a parent's row becomes its children's rows, each with its siblings before the proof that the parent has.
Levels are written to the shared folder; at most log16 of the largest source are there.

Places within a source come from a range partitioning by (source, id, hash): rows are numbered inside their partition and the
counts of the partitions before are added, so no source, however large, meets in one task. Only the largest source's
size and the root reach the driver.

Defined results: null and empty fields are different leaves; a null source is a source of its own and comes first; a null id comes
first in its source; rows with one id stand in the order of their leaf hashes, and repeated rows are leaves each; an
empty table has no root and gives no rows; columns other than the fields are ignored, whatever their names. Long texts
are hashed where they are read and not moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cupom.llm.common import stored

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_hash(**replaced: Column) -> Column:
    """Hash of a row's fields, with some of them ``replaced``."""

    def field(name: str) -> Column:
        value = replaced.get(name, F.col(name)).cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return digest(F.concat(*map(field, FIELDS)))


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their ``place`` (from 0) in their ``group`` by ``order``, and the number of its ``peers``."""
    at = F.monotonically_increasing_id()
    ordered = stored(rows.repartitionByRange("group", *order).sortWithinPartitions("group", *order).withColumn("_at", at), "merkle-order")
    part = F.shiftright("_at", 33).alias("_part")
    runs = ordered.groupBy("group", part).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    of_group = Window.partitionBy("group")
    before = F.coalesce(F.sum("_n").over(of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("group", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(of_group).alias("peers"))
    return ordered.withColumn("_part", part).join(runs, ["group", "_part"]).withColumn("place", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def _parents(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """One row per parent: its place, its number of peers, its hash and its children in the columns c0, c1, ..."""
    child = F.struct("hash", *payload)
    slots = [F.max(F.when(F.col("place") % FANOUT == s, child)).alias(f"c{s}") for s in range(FANOUT)]
    spread = nodes.where("peers > 1").groupBy("group", F.expr(f"place div {FANOUT}").alias("_parent")).agg(F.max("peers").alias("_below"), *slots)
    children = [f"c{s}" for s in range(FANOUT)]
    joint = digest(F.concat_ws("", *[F.col(c)["hash"] for c in children]))
    return spread.select("group", F.col("_parent").alias("place"), F.expr(f"(_below + {FANOUT - 1}) div {FANOUT}").alias("peers"), joint.alias("hash"), *children)


def grow(leaves: DataFrame, payload: list[str]) -> list[DataFrame]:
    """Levels of parents above ``leaves`` (group, place, peers, hash, payload), lowest first; the lowest carries the payload."""
    levels, nodes, most = [], leaves, leaves.agg(F.max("peers")).first()[0] or 0
    while most > 1:
        levels.append(stored(_parents(nodes, payload), "merkle-level"))
        nodes, payload, most = levels[-1].select("group", "place", "peers", "hash"), [], -(-most // FANOUT)
    return levels


def roots(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(group, hash) of the last node of every group."""
    ends = [nodes.where("peers = 1").select("group", "hash") for nodes in (leaves, *levels)]
    out = ends[0]
    for more in ends[1:]:
        out = out.unionByName(more)
    return out


def _children(parents: DataFrame, carried: list[str]) -> DataFrame:
    """Every child of ``parents`` with its siblings put before the proof of its parent."""
    hashes = [F.col(f"c{s}")["hash"] for s in range(FANOUT)]
    step = lambda s: F.struct(F.concat_ws("", *hashes[:s]).alias("left"), F.concat_ws("", *hashes[s + 1 :]).alias("right"))
    slots = F.array(*[F.when(hashes[s].isNotNull(), F.struct(F.lit(s).alias("slot"), F.col(f"c{s}").alias("node"), step(s).alias("step"))) for s in range(FANOUT)])
    rows = parents.select("group", "place", *carried, "proof", F.explode(F.filter(slots, lambda x: x.isNotNull())).alias("_child"))
    place = F.col("place") * FANOUT + F.col("_child.slot")
    return rows.select("group", place.alias("place"), *carried, "_child.node.*", F.concat(F.array("_child.step"), "proof").alias("proof"))


def proofs(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Each leaf with its columns, those of its group in ``tops`` and ``proof``: array of (left, right) siblings up to the root.

    ``tops`` (group, proof, ...) has the proof that goes on above each group's last node.
    """
    carried = [c for c in tops.columns if c not in ("group", "proof")]
    above = None
    for level in reversed(levels):
        with_proof = level.where("peers = 1").join(tops, "group")
        if above is not None:
            inner = level.where("peers > 1").join(above.select("group", "place", *carried, "proof"), ["group", "place"])
            with_proof = with_proof.unionByName(inner)
        above = _children(with_proof, carried)
    lone = leaves.where("peers = 1").drop("peers").join(tops, "group")
    return lone if above is None else lone.unionByName(above)


def fold(leaf: Column, proof: Column) -> Column:
    """Root that a leaf hash and its siblings lead to."""
    return F.aggregate(proof, leaf, lambda h, p: digest(F.concat(p["left"], h, p["right"])))


def siblings(proof: Column) -> Column:
    return F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), "")


def manifest(rows: DataFrame, **checked: Column) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, proof, checked ...) of every row; ``checked`` columns are made of a row's fields where it is read."""
    group = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    extra = list(checked)
    narrow = rows.select(*FIELDS).select("doc_id", "source", leaf_hash().alias("hash"), group.alias("group"), *[c.alias(n) for n, c in checked.items()])
    payload = ["doc_id", "source", *extra]
    leaves = numbered(stored(narrow, "merkle-leaves"), ["doc_id", "hash"])
    levels = grow(leaves, payload)
    subroots = stored(roots(leaves, levels), "merkle-subroots")
    sources = numbered(subroots.select(F.lit("").alias("group"), F.col("group").alias("name"), "hash"), ["name"])
    upper = grow(sources, ["name"])
    last = roots(sources, upper).first()
    root = F.lit(last["hash"] if last else None).cast("string")
    none = F.expr("cast(array() as array<struct<left:string,right:string>>)")
    whole = sources.sparkSession.range(1).select(F.lit("").alias("group"), none.alias("proof"))
    tops = stored(proofs(sources, upper, whole).select(F.col("name").alias("group"), F.col("hash").alias("subroot"), "proof"), "merkle-tops")
    return proofs(leaves, levels, tops).select("doc_id", "source", F.col("hash").alias("leaf"), "subroot", root.alias("root"), "proof", *extra)
