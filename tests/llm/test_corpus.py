"""Near-duplicates, repeated passages, training order, archives and the pipeline."""

import random
from collections import defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from cupom.llm import graph, order, probminhash, suffix_dedup, warc
from cupom.session import scratch_path

# ---------------------------------------------------------------- near-duplicates


def edit(text, n, seed):
    r, words = random.Random(seed), text.split()
    for _ in range(n):
        words[r.randrange(len(words))] = f"edit{r.randrange(10**6)}"
    return " ".join(words)


def brute_classes(rows, threshold=0.8):
    sets = [brute.shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and find(i) != find(j) and brute.jaccard(sets[i], sets[j]) >= threshold:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    names = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            names[i] = min(ids, default=None)
    return [names[i] for i in range(len(rows))]


def test_classes_by_brute_force(docs, prose):
    rows = [(i, prose(i, 60)) for i in range(40)]
    for b in range(4):  # families around the threshold, so that many members aren't similar to the hub
        rows += [(1000 + 100 * b + k, edit(prose(900 + b, 120), 1 + k % 6, 7 * k + b)) for k in range(40)]
    rows += [(5000, prose(3, 60)), (3, prose(3, 60)), (None, prose(4, 60)), (6000, ""), (6001, None), (6002, " \n"), (6003, "a b"), (6004, "a b"), (6005, "a b c"), (None, "solo words here"), (7000, "la " * 20000)]
    got = probminhash.classify(docs(rows)).collect()
    want = sorted(map(str, zip([r[0] for r in rows], brute_classes(rows), strict=True)))
    assert sorted(str((r.doc_id, r.class_id)) for r in got) == want


def test_blocks_of_a_large_group_lose_no_link(docs, prose, shipped, monkeypatch):
    monkeypatch.setattr(probminhash.rest_links, "__defaults__", (probminhash.SIMILARITY, 5))
    rows = [(k, edit(prose(77, 100), 2 + k % 5, k)) for k in range(60)]
    got = probminhash.classify(docs(rows)).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == sorted(zip([r[0] for r in rows], brute_classes(rows), strict=True))


def test_registers_estimate_probability_jaccard():
    r = np.random.Generator(np.random.PCG64(1))
    common, mine, other = (r.integers(0, 1 << 50, n).astype(np.uint64) for n in (300, 100, 100))
    left, right = np.concatenate([common, mine]), np.concatenate([common, other])
    sig = probminhash.signatures(np.concatenate([left, right | np.uint64(1 << 50)]), 2, 4096)
    assert abs((sig[0] == sig[1]).mean() - 300 / 500) < 0.04
    # Weight 1 + ln(count) draws more registers.
    heavy = np.concatenate([left, np.repeat(mine[:1], 50)])
    sig = probminhash.signatures(heavy, 1, 8192)
    share = (1 + np.log(51)) / (399 + 1 + np.log(51))
    assert abs((sig[0] == mine[0]).mean() - share) < 0.006


def test_pairs_with_repeated_phrases_meet(docs):
    rows = []
    for i in range(60):  # plain similarity 41 / 50, weighted 0.49
        single = " ".join(f"w{i}x{j}" for j in range(45))
        rows += [(2 * i, single), (2 * i + 1, single + f" a{i} b{i} c{i} d{i} e{i}" * 1000)]
    # Equal shingle sets, of which 60 occur 200 times in one text.
    words = " ".join(f"v{j}" for j in range(140)) + " " + " ".join(f"u{j}" for j in range(60))
    rows += [(1000, words + " " + " ".join(f"u{j}" for j in range(60))), (1001, words + (" " + " ".join(f"u{j}" for j in range(60))) * 200)]
    got = {r.doc_id: r.class_id for r in probminhash.classify(docs(rows)).collect()}
    assert got == {key: key - key % 2 for key, _ in rows}


def test_keep_one(docs, prose):
    rows = [(5, prose(1, 60)), (2, edit(prose(1, 60), 1, 1)), (2, edit(prose(1, 60), 1, 1)), (9, prose(2, 60)), (None, prose(1, 60)), (11, ""), (11, ""), (12, None)]
    got = probminhash.keep_one(docs(rows)).collect()
    assert sorted((r.doc_id, r.kept) for r in got) == [(2, "given"), (9, "given"), (11, "given"), (11, "given"), (12, "given")]
    assert probminhash.keep_one(docs([])).count() == 0


def test_components(spark):
    links = [(1, 2), (2, 3), (7, 3), (10, 11), (5, 5), (None, 1), (11, 10), *[(100, 100 + i) for i in range(1, 40)], *[(200 + i, 201 + i) for i in range(30)]]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 1, 10: 10, 11: 10} | {100 + i: 100 for i in range(40)} | {200 + i: 200 for i in range(31)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- repeated passages


@pytest.mark.parametrize("seed", range(12))
def test_deep_shallow_sorts(seed):
    r = random.Random(seed)
    base = bytes(r.choice(r.choice([b"ab", b"abc", b"abcdefgh"])) for _ in range(r.randint(60, 400)))
    text = base + base[: r.randint(0, len(base))] + b"a" * r.randint(0, 120) + base
    starts = list(range(len(text) - 49))
    r.shuffle(starts)
    places, group = suffix_dedup.deep_shallow(np.frombuffer(text + bytes(8), np.uint8), np.array(starts))
    strings = [text[starts[i] : starts[i] + 50] for i in places.tolist()]
    assert strings == sorted(strings)
    assert [a == b for a, b in zip(group[1:], group, strict=False)] == [a == b for a, b in zip(strings[1:], strings, strict=False)]


@pytest.mark.parametrize("alphabet", [1, 2, 26, 256])
def test_multikey_quicksort_at_any_depth(alphabet):
    r = np.random.default_rng(alphabet)
    for n, length, shallow in ((1, 50, 24), (3, 50, 24), (700, 50, 24), (700, 27, 20), (700, 13, 24), (700, 5, 24), (700, 12, 8)):
        data = np.concatenate([r.integers(0, alphabet, n + length).astype(np.uint8), np.zeros(8, np.uint8)])
        starts = np.concatenate([r.permutation(n), np.arange(n)])  # every place twice
        order, group = suffix_dedup.deep_shallow(data, starts, length, shallow)
        strings = [data[s : s + length].tobytes() for s in starts]
        assert sorted(order.tolist()) == list(range(len(starts)))
        assert [strings[i] for i in order] == sorted(strings)
        ranks = {x: i for i, x in enumerate(sorted(set(strings)))}
        assert [ranks[strings[i]] for i in order] == group.tolist()


def test_posts_stay_and_lost_ones_are_errors(spark, tmp_path):
    folder = str(tmp_path / "post")
    suffix_dedup.post(folder, "shared", 7, b"first")
    suffix_dedup.post(folder, "shared", 7, b"first")
    assert suffix_dedup.fetch(folder, "shared", 7) == b"first" and len(list((tmp_path / "post").iterdir())) == 1
    with pytest.raises(OSError):
        suffix_dedup.fetch(folder, "shared", 8)


def test_blind_trie():
    r = random.Random(1)
    for _ in range(50):
        strings = list({bytes(r.choice(b"abc") for _ in range(12)) for _ in range(r.randint(1, 60))})
        assert [strings[i] for i in suffix_dedup.blind_trie(strings)] == sorted(strings)


@pytest.mark.parametrize("block", [200, 1000, 1 << 20])
def test_removal_by_brute_force(docs, prose, block):
    r = random.Random(block)
    shared = [prose(500 + i, 40) for i in range(6)]
    rows = [(i, prose(i, 20) + r.choice(shared)[: r.randint(20, 200)] + prose(i + 300, 10) + r.choice(shared)) for i in range(60)]
    rows += [(100, prose(3, 20)), (101, "a" * 700), (102, "a" * 60), (103, "ab" * 200), (104, ""), (105, None), (106, "x" * 49), (107, "x" * 50), (108, "x" * 50), (109, "éü" * 100), (110, "é" + "üé" * 99)]
    out = suffix_dedup.dedup(docs(rows, 4), block_bytes=block).collect()
    import hashlib

    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in out}
    assert got == brute.repeated_bytes(rows)
    given = dict(rows)
    for r in out:
        body = (given[r.doc_id] or "").encode()
        assert r.text == bytes(r.kept).decode("utf-8", "ignore") and sum(s.end - s.start for s in r.spans) == r.n_removed
        gone = b"".join(body[s.start : s.end] for s in r.spans)
        assert len(gone) + len(r.kept) == len(body)


def test_equal_and_null_ids_and_columns(docs, prose):
    t = prose(1, 30)
    out = suffix_dedup.dedup(docs([(1, t), (1, t), (None, t), (None, t)])).collect()
    assert sorted(((r.doc_id or 9, r.n_removed > 0) for r in out)) == [(1, False), (1, False), (9, True), (9, True)]
    assert out[0].n_words == 7  # a column of its own; ``kept`` is replaced
    empty = suffix_dedup.dedup(docs([]))
    assert empty.count() == 0 and "n_spans" in empty.columns


# ---------------------------------------------------------------- training order


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 1000, 4097])
def test_permutation_is_a_bijection_and_invertible(n):
    p = order.Permutation(n, 99)
    slots = p.slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert p.numbers(slots).tolist() == list(range(n))
    if n > 100:
        assert (slots != order.Permutation(n, 100).slots(np.arange(n))).mean() > 0.9
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.2


def test_shards_hold_every_sequence_in_slot_order(docs, prose):
    public = pytest.importorskip("public_tokenizers")
    from cupom.llm import bpe

    rows = [(i, prose(i, i)) for i in range(60)] + [(70, None), (71, ""), (None, "null id"), (3, prose(3, 3)), (72, "long " * 4000)]
    table = docs(rows, 5)
    spark = table.sparkSession
    words = bpe.Vocabulary(spark, public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    make = lambda t, size=3000: order.write_shards(t, words.library, 50256, scratch_path(spark, "order-test"), 5, 32, range_bytes=size)
    manifest = make(table)
    shards = {r.shard: r for r in manifest.collect()}
    got = sorted(order.read_sequences(spark, manifest, 32).collect(), key=lambda r: r.slot)
    assert len(shards) > 5 and [r.slot for r in got] == list(range(len(got)))
    assert all(r.offset == (r.slot - shards[r.shard].first_slot) * (16 + 64) for r in got)
    plain = lambda rows_: [(r.slot, r.doc_id, r.part, bytes(r.ids)) for r in rows_]
    # The order doesn't depend on how the input is split.
    distinct = table.where("doc_id is null or doc_id <> 3").unionByName(docs([(3, prose(100, 200)), (3, prose(101, 200)), (3, prose(102, 9))]))
    one, two = (sorted(plain(order.read_sequences(spark, make(t), 32).collect())) for t in (distinct, distinct.repartition(2)))
    assert one == two
    encoder, want = words.encoder(), defaultdict(int)
    for doc, text in rows:
        ids = encoder.encode(text or "") + np.array([50256], "<u4").tobytes()
        for part, at in enumerate(range(0, len(ids), 128)):
            want[doc, part, ids[at : at + 128]] += 1
    have = defaultdict(int)
    for r in got:
        have[r.doc_id, r.part, bytes(r.ids)] += 1
    assert have == want
    tail = order.read_sequences(spark, manifest, 32, from_slot=55).collect()
    assert sorted(r.slot for r in tail) == list(range(55, len(got)))
    assert order.read_sequences(spark, make(docs([])), 32).count() == 0


# ---------------------------------------------------------------- archives

PAGES = "page_id long, url string, html string, digest string"


def test_archives_hold_their_dictionary_and_every_payload(shipped, prose, monkeypatch):
    spark = shipped
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 5000)
    page = "<html>" + prose(1, 60) + "</html>"
    rows = [(i, f"http://h/{i}", f"<p>{prose(i, 50)}", "d") for i in range(80)]
    rows += [(200, "u\r\nX: y%41", page, "d"), (150, None, page, "d"), (150, None, page, "d"), (None, "n", page, "d"), (201, "u", None, "d"), (202, "u", "", "d"), (203, "u", "tiny", "d"), (204, "u", "tiny", "d"), (205, "u", "é\r\n\r\n" * 9000, "d")]
    manifest = warc.write_archives(warc.plan_records(spark.createDataFrame(rows, PAGES).repartition(3)), scratch_path(spark, "warc-test"), file_bytes=4000)
    listed = manifest.collect()
    assert sum(r.records for r in listed) == len(rows) and len(listed) > 1
    from cupom.llm.files import open_store

    for r in listed:
        fs, name = open_store(r.path)
        with fs.open_input_stream(name, compression=None) as f:
            assert int.from_bytes(f.read(4), "little") == warc.SKIPPABLE
    got = warc.read_archives(spark, manifest).collect()
    responses = sorted((r.page_id, r.target_uri or "", bytes(r.payload).decode()) for r in got if r.record_type == "response")
    revisits = sorted((-1 if r.page_id is None else r.page_id, r.refers_to, r.payload_bytes) for r in got if r.record_type == "revisit")
    assert revisits == [(-1, 150, len(page)), (200, 150, len(page))]
    want = [(k, u or "", h or "") for k, u, h, _ in rows if k not in (200, None)]
    assert responses == sorted(want)
    assert [r.target_uri for r in got if r.page_id == 200] == ["u\r\nX: y%41"]
    empty = warc.write_archives(warc.plan_records(spark.createDataFrame([], PAGES)), scratch_path(spark, "warc-test"))
    assert empty.count() == 0 and warc.read_archives(spark, empty).count() == 0


# ---------------------------------------------------------------- pipeline


def test_pipeline_by_brute_force(shipped, prose, tmp_path):
    import corpus_pipeline

    pytest.importorskip("public_tokenizers")
    spark, r = shipped, random.Random(4)
    passage, item = prose(9001, 60), prose(9002, 30)
    rows = [[i, prose(i, 70)] for i in range(120)]
    for i in range(0, 40, 2):  # toxic
        words = rows[i][1].split()
        for _ in range(5):
            words.insert(r.randrange(60), r.choice(["idiot", "m0ron", "scum", "pathetic"]))
        rows[i][1] = " ".join(words)
    rows += [[200, rows[41][1]], [201, edit(rows[43][1], 1, 1)]]  # copies
    rows[50][1] += " " + passage
    rows[60][1] += " " + passage
    rows[70][1] += " " + item  # contaminated
    rows += [[300, None], [301, ""]]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i < 40 and i % 2 == 0)) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    sf = str(tmp_path)
    seen = docs
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, seen, sf)
        if n < 4:
            assert out.columns == docs.columns, name
        out.write.parquet(f"{sf}/{n}")
        seen = spark.read.parquet(f"{sf}/{n}")
        if n == 0:
            assert {x.doc_id for x in seen.collect()} == {i for i, _ in rows} - set(range(0, 40, 2))
        if n == 1:
            before = {x.doc_id for x in spark.read.parquet(f"{sf}/0").collect()}
            assert before - {x.doc_id for x in seen.collect()} == {200, 201}
        if n == 2:
            texts = {x.doc_id: x for x in seen.collect()}
            given = {x.doc_id: x.text for x in spark.read.parquet(f"{sf}/1").collect()}
            want = brute.repeated_bytes(list(given.items()))
            import hashlib

            assert {i: hashlib.sha256(x.text.encode()).hexdigest() for i, x in texts.items()} == {i: w[3] for i, w in want.items()}
            assert passage in texts[50].text and passage not in texts[60].text and texts[60].n_chars == len(texts[60].text)
        if n == 3:
            assert {i for i in texts} - {x.doc_id for x in seen.collect()} == {70}
    assert all(x.round_trip for x in seen.collect())
    assert sorted(x.doc_id for x in corpus_pipeline.run(spark, sf).collect()) == sorted(x.doc_id for x in seen.collect())
    assert spark.read.parquet(f"{sf}/4").agg(F.sum("n_tokens")).first()[0] > 1000
