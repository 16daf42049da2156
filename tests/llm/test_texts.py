"""Compression bands, toxicity, decontamination and BPE against brute force and edge cases."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
import zstandard as zstd

from cupom.llm import bpe, compression, fm_index, toxicity
from cupom.llm.common import text_bytes
from cupom.llm.words import split

EDGE = ["", None, " \n\t ", "one", "a b c d", "x" * 5000, "word " * 3000, "é🙂 ñ\n" * 40, "a b c d e a b c d e f g h i j k l m", "l\nl\n\nl\r\nl", "## <b> $5 %& *|"]


def test_base_counts_by_brute_force(prose):
    texts = EDGE + [prose(i, i * 3) for i in range(40)] + [prose(1, 30) + "\n" + prose(1, 30) + "\n\n" + prose(2, 5)]
    r = random.Random(3)
    texts += ["".join(r.choice("ab \n  #é") for _ in range(r.randint(0, 120))) for _ in range(200)]
    for t in texts:
        got = compression.base_counts((t or "").encode())
        assert (*got, got[0] < 10 or 100 * got[4] > 20 * got[0]) == brute.base_counts(t), repr(t)


def test_quality_verdicts_and_columns(docs, prose):
    noise = "".join(chr(random.Random(5).randint(33, 126)) for _ in range(1))
    r = random.Random(5)
    noise = " ".join("".join(chr(r.randint(33, 126)) for _ in range(12)) for _ in range(400))
    stutter = " ".join(f"{w} {w} {w} {w}" for w in (f"w{i % 37}q{i % 11}" for i in range(900)))
    rows = [(1, prose(1, 300)), (2, noise), (3, stutter), (4, None), (5, "")] + [(1, prose(1, 300))]
    got = compression.quality(docs(rows)).collect()
    kept = {(r.doc_id, r.kept) for r in got}
    assert len(got) == 6 and kept == {(1, True), (2, False), (3, False), (4, False), (5, False)}
    squeeze = zstd.ZstdCompressor(level=compression.LEVEL, write_content_size=False)
    for r in got:
        body = (r.text or "").encode()
        assert r.ratio == (len(squeeze.compress(body)) / len(body) if body else 0.0)
    assert compression.quality(docs([])).count() == 0


def test_short_texts_and_last_chunks(docs, prose):
    # Ten words in each; few letters over and over, though no five words recur next to each other.
    stutter = " ".join("ab" * n for n in range(1, 13))
    rows = [(1, stutter), (2, prose(3, 20)[:150]), (3, prose(4, 14)[:80])]
    assert len(stutter) < 200
    got = {r.doc_id: r for r in compression.quality(docs(rows)).collect()}
    assert not got[1].base_failed and not got[1].kept and got[2].kept and got[3].kept
    size = compression.CHUNK
    long = (prose(1, 3000) * 2)[: 3 * size].ljust(3 * size, "a")
    tails = {0: 3, 1: 3, compression.LEAST_CHUNK - 1: 3, compression.LEAST_CHUNK: 4, size: 4}
    rows = [(n, long + "q" * n) for n in tails] + [(-1, "q" * (compression.LEAST_CHUNK - 1))]
    got = {r.doc_id: r.n_chunks for r in compression.quality(docs(rows)).collect()}
    assert got == {**tails, -1: 1}


def test_folding():
    assert toxicity.fold("You ІDIОT, ｉｄｉｏｔ i​diot 1d10t $tup!d!!") == " you idiot idiot idiot idiot stupid "
    assert toxicity.fold("") == "  " and toxicity.fold("...") == "  "


def test_lexicon_hits_words_beginnings_and_exceptions():
    lex = toxicity.Lexicon({" idiot ": 2.0, " vequ": 1.0, " vequta ": 3.0, toxicity.fold("clown"): 2.0})
    assert lex.weigh(toxicity.fold("an idiot; idiots idiotic"))[:2] == (2.0, 1)
    assert lex.weigh(toxicity.fold("vequta vequmo"))[:2] == (4.0, 2)
    assert lex.weigh(toxicity.fold("a clown fish, a clown"))[:2] == (2.0, 1)
    assert lex.weigh(toxicity.fold("c1own"))[1] == 1
    assert lex.weigh("  ") == (0.0, 0, 0) and 0 <= lex.score(0.0, 0) < 0.5


def test_held_out_accuracy_and_edges(docs, prose):
    r = random.Random(2)
    slurs = [f"zorg{x}" for x in ("ta", "mo", "ke", "lu")]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 3 == 0
        words = prose(i, 60).split()
        for _ in range(4 if toxic else 0):
            words.insert(r.randint(0, 60), r.choice(slurs))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    table = docs([*rows, (None, "zorgta zorgmo"), (900, None), (901, ""), (0, rows[0][1])])
    marks = table.sparkSession.createDataFrame([*labels, (0, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    lexicon = toxicity.learn(table, marks)
    out = toxicity.score(table, lexicon).collect()
    assert len(out) == 404
    truth = dict(labels) | {None: 1, 900: 0, 901: 0}
    assert sum(r.predicted == truth[r.doc_id] for r in out) >= 400
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert toxicity.score(docs([]), lexicon).count() == 0
    plain = toxicity.learn(docs([]), marks.limit(0))
    assert plain.weights == {} and plain.curve == toxicity.CURVE
    assert toxicity.learn(docs([]), marks.limit(0), prior={"Clown": 3.0}).weights == {toxicity.fold("clown"): 3.0}
    assert len(toxicity.learn(table, marks, max_terms=2).weights) == 2


def test_terms_are_kept_by_rates_not_counts(docs):
    # 1 % toxic; the word stands in 18 toxic and 24 other texts: fewer toxic ones, but odds of 74.
    rows = [(i, "common words " + ("gronk" if (i < 18 or 60 <= i < 84) else "calm")) for i in range(6000)]
    marks = docs([(1, "")]).sparkSession.createDataFrame([(i, int(i < 60)) for i in range(6000)], "doc_id long, toxic int")
    weights = toxicity.learn(docs(rows), marks).weights
    assert " gronk " in weights and " calm " not in weights and " common " not in weights


def test_labels_reduce_the_prior():
    clown, trash, scum, idiot = (toxicity.fold(w) for w in ("clown", "trash", "scum", "idiot"))
    got = toxicity._lexicon([(clown, 1, 400), (trash, 10, 15), (scum, 50, 0)], (1000, 9000), dict.fromkeys((clown, trash, scum, idiot), 3.0), None)
    assert clown not in got and got[trash] < 3.0 < got[scum]
    assert got[idiot] == 3.0  # no labelled text has it


def test_matcher_by_plain_scan():
    """Every entry and exception looked for at every place of the folded text."""
    r = random.Random(6)
    for _ in range(300):
        word = lambda n: "".join(r.choice("abc") for _ in range(r.randint(1, n)))
        weights = {(f" {word(4)} " if r.random() < 0.5 else f" {word(3)}"): r.choice([0.5, 1.0, 2.0]) for _ in range(r.randint(0, 8))}
        exceptions = tuple(" ".join(word(3) for _ in range(r.randint(1, 3))) for _ in range(r.randint(0, 3)))
        text = toxicity.fold(" ".join(word(5) for _ in range(r.randint(0, 25))))
        places = lambda term: [i for i in range(len(text)) if text.startswith(term, i)]
        exempt = [(i, i + len(f) - 1) for f in map(toxicity.fold, exceptions) if f.strip() for i in places(f)] if weights else []
        best = {}
        for term, weight in weights.items():
            for i in places(term):
                if not any(a <= i < b for a, b in exempt):
                    best[i] = max(best.get(i, 0.0), weight)
        got = toxicity.Lexicon(weights, exceptions).weigh(text)
        assert got == (pytest.approx(sum(best.values())), len(best), len(text.split()))


def test_labels_of_the_held_out_fold_are_not_used(docs):
    from zlib import crc32

    held = [i for i in range(300) if crc32(str(i).encode()) % 5 == 0]
    rows = [(i, f"plain words and {'gronk' if i % 2 else 'gentle'} ones") for i in held]
    marks = docs([(1, "")]).sparkSession.createDataFrame([(i, i % 2) for i in held], "doc_id long, toxic int")
    assert toxicity.learn(docs(rows), marks).weights == {}


# ---------------------------------------------------------------- decontamination


def letters(words, levels=3):
    return np.array(words, np.int32), levels


@pytest.mark.parametrize("seed", range(25))
def test_fm_index_counts_and_locates(seed):
    r = np.random.Generator(np.random.PCG64(seed))
    text = r.integers(0, r.integers(2, 8), r.integers(1, 400)).astype(np.int32)
    if seed % 5 == 0:
        text = np.tile(np.array([1, 2, 1, 2, 3], np.int32), 60)
    text = np.append(text, 0).astype(np.int32)
    index = fm_index.FMIndex(text, 3, sample=4)
    for length in (1, 2, 5, 13):
        phrases = [text[i : i + length] for i in range(len(text) - length) if text[i : i + length].all()][:30] + [r.integers(1, 8, length).astype(np.int32) for _ in range(5)]
        low, high = index.search(np.array(phrases))
        for p, a, b in zip(phrases, low, high, strict=True):
            want = [i for i in range(len(text) - length + 1) if (text[i : i + length] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_contamination_by_brute_force(docs, prose):
    items = [(1, prose(100, 40)), (2, prose(101, 13)), (3, "Short item Here"), (4, ""), (5, None), (None, prose(102, 14)), (7, prose(100, 40)), (7, prose(103, 20))]
    w = prose(100, 40).split()
    rows = [(i, prose(i, 90)) for i in range(20)] + [
        (30, " ".join(prose(31, 20).split() + w[3:30] + prose(32, 20).split())),
        (31, " ".join(w[3:15])),
        (32, prose(101, 13).upper().replace(" ", " -- ")),
        (33, "x short-ITEM\nhere y " + prose(34, 100)),
        (34, prose(102, 14)),
        (35, None), (36, ""), (37, "..."), (None, prose(103, 20) * 2), (30, " ".join(w)), (38, ("short item here " * 4000)), (39, "short item", ), (40, "here short item"),
    ]
    table = docs(rows, 2)
    benchmark = table.sparkSession.createDataFrame([(*x, 1) for x in items], "item_id long, text string, n_hit int")
    want = sorted(map(str, brute.contamination(rows, items)))
    import hashlib

    def got(df):
        sha = lambda ids: hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
        return sorted(str((r.doc_id, r.n_words, r.n_hit, r.n_items, sha(r.item_ids), r.contaminated)) for r in df.collect())

    found = fm_index.decontaminate(table, benchmark)
    assert got(found) == want
    for r in found.collect():  # spans cover the hit words and nothing else
        body = (r.text or "").encode()
        assert sum(len(brute.item_words(body[s.start : s.end].decode())) for s in r.spans) == r.n_hit
    assert fm_index.decontaminate(docs([]), benchmark).count() == 0
    assert not any(r.n_hit for r in fm_index.decontaminate(table, benchmark.limit(0)).collect())


def test_benchmark_in_many_blocks(docs, prose, monkeypatch):
    monkeypatch.setattr(fm_index, "BLOCK_WORDS", 30)
    items = [(i, prose(i, 25)) for i in range(8)]
    rows = [(i, prose(i + 50, 10) + " " + prose(i % 10, 25) + " " + prose((i + 1) % 10, 25)) for i in range(10)]
    table = docs(rows)
    found = fm_index.decontaminate(table, table.sparkSession.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_hit, r.n_items) for r in found) == sorted((d, h, k) for d, _, h, k, _, _ in brute.contamination(rows, items))


def test_words_of_joined_texts():
    texts = ["Ab c", "", "d,e", "é9", None]
    data, offsets = text_bytes(pa.array(texts))
    w = split(data, offsets, "alnum", True)
    assert [bytes(data[a:b]) for a, b in zip(w.starts, w.ends, strict=True)] == [b"Ab", b"c", b"d", b"e", "é9".encode()]
    assert w.counts().tolist() == [2, 0, 2, 1, 0]
    same = split(*text_bytes(pa.array(["AB x aB"])), "alnum", True).hashes
    assert same[0] == same[2] != same[1]


# ---------------------------------------------------------------- BPE

public = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def pair():
    ranks = bpe.load_ranks(public.path("byte_bpe_50k.tiktoken"))
    return bpe.Encoder(ranks, public.PATTERN), tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={}), bpe.Decoder(ranks)


def test_same_ids_as_the_library(pair, prose):
    ours, theirs, decoder = pair
    r = random.Random(7)
    texts = [t or "" for t in EDGE] + [prose(i, 40) for i in range(20)] + ["".join(r.choice("aabbe thingóñ'ſs  \n\t0123中🙂<|>sThe") for _ in range(r.randint(0, 60))) for _ in range(1500)]
    texts += ["a" * 4000, "ab" * 3000, " " * 3000 + "x", "\n" * 70000 + "a b" * 30000, "<|endoftext|>", "it's we'll 'S"]
    for t in texts:
        ids = ours.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(t)
        assert "".join(x for _, x in decoder.stream(ids, 3)) == t


def test_transducer_is_the_same_after_a_reset(pair, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 20)
    monkeypatch.setattr(bpe, "MAX_PIECES", 5)
    ours = bpe.Encoder(pair[0].transducer.ranks, public.PATTERN)
    text = "Unbelievably, antidisestablishmentarianism reconsidered seventeen hypotheses; quietly."
    assert np.frombuffer(ours.encode(text * 3), "<u4").tolist() == pair[1].encode_ordinary(text * 3)


def test_encode_and_decode_tables(docs):
    rows = [(1, "hello world"), (2, None), (3, ""), (None, "é" * 9000), (1, "hello world")]
    table = docs(rows)
    words = bpe.Vocabulary(table.sparkSession, public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    out = bpe.decode(bpe.encode(table, words), words).collect()
    assert sorted((r.doc_id or 0, r.decoded_text) for r in out) == sorted((d or 0, t or "") for d, t in rows)
    assert all(r.n_tokens == len(r.ids) // 4 and r.kept == "given" for r in out)
    assert bpe.decode(bpe.encode(docs([]), words), words).count() == 0
    both = bpe.round_trip(table, words).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded).decode(), bytes(r.ids)) for r in both) == sorted((r.doc_id or 0, r.decoded_text, bytes(r.ids)) for r in out)
    assert bpe.round_trip(docs([]), words).count() == 0
