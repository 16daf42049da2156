"""Merkle manifest and prefix trie against plain Python over whole rows."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cupom.llm import merkle, prefix_trie

DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, place int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc, source, lang, n, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def tree(leaves):
    """(root, siblings of each leaf level by level as (before, after))."""
    levels, paths = [leaves], [[] for _ in leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        for i, path in enumerate(paths):
            at = i // 16 ** (len(levels) - 1)
            run = at // 16 * 16
            path.append(("".join(below[run:at]), "".join(below[at + 1 : run + 16])))
        levels.append([h("".join(below[k : k + 16])) for k in range(0, len(below), 16)])
    return levels[-1][0], paths


def manifest_of(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf_of(*r[:5]), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in names}
    root, tops = tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops, strict=True):
        for (_, _, leaf, r), path in zip(sorted(sources[s], key=lambda x: x[:3]), trees[s][1], strict=True):
            now = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                lower = None if r[4] is None else re.sub("[A-Z]", lambda m: m.group().lower(), r[4])
                now = leaf_of(*r[:4], lower)
            for before, after in path + top:
                now = h(before + now + after)
            out.append((r[0], leaf, trees[s][0], root, h("".join(a + b for a, b in path + top)), now, now == root))
    return out


def documents(spark, rows, parts):
    return spark.createDataFrame([(*r, "given", 3) for r in rows], DOCS).repartition(parts)


@pytest.mark.parametrize(("sizes", "parts"), [((1,), 1), ((2,), 2), ((300, 1, 17, 16, 5), 5), ((4200, 3), 7), ((1,) * 40, 3)])
def test_manifest_by_brute_force(shipped, tmp_path, sizes, parts):
    from cupom.llm.queries import REGISTRY

    r = random.Random(len(sizes))
    rows = []
    for s, n in enumerate(sizes):
        source = None if s == 1 else f"src{s}é" if s % 3 else f"S{s}"
        rows += [(len(rows) + i, source, r.choice([None, "en", ""]), r.choice([None, 0, -5, 123456]), r.choice([None, "", "ABC déf É", "x" * 50, "Z" * r.randint(1, 9)])) for i in range(n)]
    rows += [(None, rows[0][1], None, None, None), rows[0], rows[0], (rows[0][0], rows[0][1], "zz", 1, "other Text"), (10**15, "", "", 0, "LONG " * 50_000)]
    r.shuffle(rows)
    documents(shipped, rows, parts).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(x) for x in REGISTRY["op12_merkle_manifest"][0](shipped, str(tmp_path)).collect()]
    key = lambda x: tuple(map(str, x))
    assert sorted(got, key=key) == sorted(manifest_of(rows), key=key)


def test_manifest_finds_one_changed_field(shipped):
    rows = [(i, f"s{i % 3}", "en", 4, f"Text {i}") for i in range(50)]
    made = merkle.manifest(documents(shipped, rows, 3), seen=F.when(F.col("doc_id") == 7, merkle.leaf_hash(lang=F.lit("fr"))).otherwise(merkle.leaf_hash()))
    got = made.select("doc_id", (merkle.fold(F.col("seen"), F.col("proof")) == F.col("root")).alias("same")).collect()
    assert [r.doc_id for r in got if not r.same] == [7] and len(got) == 50


def test_manifest_of_no_rows(shipped):
    assert merkle.manifest(documents(shipped, [], 2)).count() == 0


TURNS = "conv_id long, turn long, role string, text string, depth string"


def trie_of(paths):
    """Rows per node of {conv_id: [(role, text), ...]}."""
    nodes = {}
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append(conv)
    out = []
    for node, members in nodes.items():
        below = [n for n in nodes if n[: len(node)] == node]
        children = lambda n: [c for c in nodes if len(c) == len(n) + 1 and c[: len(n)] == n]
        words = lambda n: len(re.findall("[^\x20\x09-\x0d]+", n[-1][1])) if n else 0
        ends = ",".join(map(str, sorted(c for c in members if len(paths[c]) == len(node))))
        out.append((min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), len(children(node)), sum(not children(n) for n in below), sum((len(nodes[n]) - 1) * words(n) for n in below), h(ends)))
    return out


def rebuild(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own.setdefault(conv, []).append((turn is not None, turn or 0, h(f"{len(role.encode())}:{role}{text}"), role, text))
    own = {c: [x[3:] for x in sorted(turns)] for c, turns in own.items()}
    n = lambda c: zlib.crc32(str(c).encode()) % 4
    return {c: own.get(c - c % 20, [])[: n(c)] + turns[n(c) :] for c, turns in own.items()}


def conversations(seed, convs, hot):
    r = random.Random(seed)
    said = ["hello there", "ok", "", None, "two\twords\n", "é é é", "x " * 2000]
    rows = []
    for c in convs:
        if r.random() < hot:  # copies
            rows += [(c, 0, "user", "hello there"), (c, 1, "assistant", "the same"), (c, 2, "user", "bye"), (c, 3, "assistant", "bye")]
            continue
        for t in range(r.randint(1, 9)):
            rows.append((c, r.choice([t, t, t, None, 1]), r.choice(["user", "assistant", None]), r.choice(said)))
    return rows + rows[:3] + [(None, 0, "user", "nobody")]


@pytest.mark.parametrize(("seed", "convs", "hot"), [(1, range(0, 60), 0.4), (2, range(17, 90, 3), 0.1), (3, [5], 0.0), (4, range(0, 300), 0.9)])
@pytest.mark.parametrize("shards", [1, 3, 40])
def test_trie_by_brute_force(shipped, monkeypatch, tmp_path, seed, convs, hot, shards):
    from cupom.llm.queries import REGISTRY

    monkeypatch.setattr(prefix_trie, "CHUNK", 40)
    rows = conversations(seed, convs, hot)
    shipped.createDataFrame([(*x, "given") for x in rows], TURNS).repartition(4).write.parquet(str(tmp_path / "conversations.parquet"))
    shipped.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        got = [tuple(x) for x in REGISTRY["op13_prefix_trie"][0](shipped, str(tmp_path)).collect()]
    finally:
        shipped.conf.set("spark.sql.shuffle.partitions", "8")
    key = lambda x: tuple(map(str, x))
    assert sorted(got, key=key) == sorted(trie_of(rebuild(rows)), key=key)


def test_shards_of_any_splitters_agree():
    """Every choice of splitters gives the same nodes, partial ones added up."""
    r = random.Random(8)
    turn = [bytes([65 + i]) * prefix_trie.DIGEST for i in range(3)]
    rows = sorted((b"".join(r.choice(turn) for _ in range(r.choice([0, 1, 2, 2, 3, 5]))), c) for c in range(200))
    for count in (0, 1, 5, 60, 199):
        splitters = prefix_trie.splitters_from(rows, count)
        assert splitters == sorted(set(splitters)) and len(splitters) <= count
        skeleton = prefix_trie.Skeleton(splitters)
        dealt = [(skeleton.shard(p, c), p, c, [1] * (len(p) // prefix_trie.DIGEST)) for p, c in rows]
        assert dealt == sorted(dealt)
        made = list(prefix_trie.walk(dealt, skeleton.numbers))
        done = [x for x in made if x[0] in (prefix_trie.DONE, prefix_trie.HANGING)]
        bones = {x[2] for x in made if x[0] == prefix_trie.PARTIAL}
        assert len(done) + len(bones) == len({p[: k * prefix_trie.DIGEST] for p, _ in rows for k in range(len(p) // prefix_trie.DIGEST + 1)})
        assert bones == set(range(len(skeleton.parents)))


def test_skeleton_is_bounded(shipped, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SKELETON_BYTES", 600)
    rows = conversations(5, range(100), 0.2)
    convs = prefix_trie.sequences(shipped.createDataFrame([(*x, "") for x in rows], TURNS))
    paths = prefix_trie.paths_of(convs)
    assert prefix_trie.skeleton_of(paths, 30).size() <= 600
    few, many = (sorted(map(str, prefix_trie.trie(paths, n).drop("turn").collect())) for n in (30, 2))
    assert few == many


def test_trie_of_no_rows(shipped):
    assert prefix_trie.trie(prefix_trie.paths_of(prefix_trie.sequences(shipped.createDataFrame([], TURNS)))).count() == 0
