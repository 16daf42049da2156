"""Segment-tree BPE against the tokenizer library and merging by definition."""

import random
import sys

import numpy as np
import public_tokenizers
import pytest
import regex

from cupom.llm import bpe, segment_bpe


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def own():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return segment_bpe.Tokenizer(f.read(), public_tokenizers.PATTERN, segment_bpe.differing(public_tokenizers.PATTERN))


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_merges_by_definition():
    r = random.Random(4)
    for _ in range(300):
        base = {bytes([b]): b for b in b"abc"}
        ranks, tokens = dict(base), list(base)
        for rank in range(r.randint(0, 12)):
            joint = r.choice(tokens) + r.choice(tokens)
            if joint not in ranks:
                ranks[joint] = 1000 + rank
                tokens.append(joint)
        pairs, made = {}, []
        for joint, token in sorted(ranks.items(), key=lambda x: x[1]):
            if token >= 1000:
                for cut in range(1, len(joint)):
                    a, b = ranks.get(joint[:cut]), ranks.get(joint[cut:])
                    if a is not None and b is not None:
                        pairs[a << 32 | b] = len(made)
                made.append(token)
        piece = bytes(r.choice(b"abc") for _ in range(r.randint(0, 40)))
        if piece:
            forest = segment_bpe.Forest(pairs, made)
            ids, counts = forest.merge(np.frombuffer(piece * 2, np.uint8).astype(np.int64), np.array([len(piece)] * 2))
            assert ids.tolist() == 2 * bpe.merge(piece, ranks) and counts.tolist() == [len(ids) // 2] * 2
        assert segment_bpe.merge_piece([base[bytes([b])] for b in piece], pairs.get, made) == (bpe.merge(piece, ranks) if piece else [])


def test_as_the_library_does(own, library):
    r = random.Random(9)
    end = "<|endoftext|>"
    some = ["", " ", "  \n\t x", "it's they'LL I'm  don't", end, f"a{end}b", f"{end}{end} ", f" {end}\n", "<|endoftext|", "<|endoftext|><|endoftext|", "x" * 3000, "ab" * 2500, "é🙂 ñ\r\n\u0085  　 ١٢ Ⅷ²", "\x00\x1c\x1f​᠎", "ǅ中文字 かな" * 30]
    some += ["".join(r.choice(["a", "the", " ", "\n", "'s", "é", "中", "1", "½", "!", " ", end, "́", "🙂"]) for _ in range(r.randint(1, 60))) for _ in range(500)]
    some += ["".join(chr(r.choice([c for c in (r.randint(1, 0xD7FF), r.randint(0xE000, sys.maxunicode))])) for _ in range(30)) for _ in range(300)]
    odd = regex.findall(f"[{own.odd.pattern[1:-1]}]", "".join(map(chr, range(0xD800))))
    assert odd
    some += [f"a{c}b {c}1 {c}{c}" for c in r.sample(odd, min(20, len(odd)))]
    for text in some:
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(own.encode(text)) == want, repr(text)
        assert own.decode(own.encode(text)) == library.decode(want, skip_special_tokens=False) == text
    assert [ids(x) for x in own.encode_all(some)] == [library.encode(t, add_special_tokens=False).ids for t in some]
    parts = [[r.randint(0, 50256) for _ in range(20)] for _ in range(200)]
    for part in parts:
        assert own.decode(np.array(part, "<u4").tobytes()) == library.decode(part, skip_special_tokens=False)


def test_splitting_of_every_character(own, library):
    """Unassigned and private characters too, which the probe takes for agreed."""
    points = [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]
    for at in range(0, len(points), 5000):
        text = "\n".join(f"a{c} {c}1" for c in map(chr, points[at : at + 5000]))
        assert own.split(text) == own.find(text) or own.odd.search(text)
        if own.odd.search(text) is None:
            assert own.find(text) == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_long_texts_are_cut_where_no_piece_reaches(own, library, monkeypatch):
    monkeypatch.setattr(bpe.spans, "__defaults__", (50,))
    monkeypatch.setattr(segment_bpe, "GROUP", 200)
    text = "word  two\n\n three's ՘ x" * 60
    assert ids(own.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_other_files_are_refused(own):
    import json

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    for path, value in ((("normalizer",), {"type": "NFC"}), (("pre_tokenizer", "add_prefix_space"), True), (("model", "dropout"), 0.1), (("added_tokens", 0, "lstrip"), True)):
        changed = json.loads(json.dumps(spec))
        at = changed
        for key in path[:-1]:
            at = at[key]
        at[path[-1]] = value
        with pytest.raises(ValueError):
            segment_bpe.Tokenizer(json.dumps(changed), public_tokenizers.PATTERN, "")


def test_table(docs, shipped, library):
    vocabulary = segment_bpe.Vocabulary(shipped, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, pieces=3)
    rows = [(1, "Hello <|endoftext|> world"), (1, "Hello <|endoftext|> world"), (2, None), (3, ""), (None, "x y " * 40_000), (4, "é🙂՘")]
    given = docs(rows).withColumnRenamed("kept", "ids")
    got = segment_bpe.decode(segment_bpe.encode(given, vocabulary), vocabulary).collect()
    assert len(got) == 6 and set(got[0].asDict()) == {"doc_id", "text", "n_words", "n_tokens", "ids", "decoded"}
    for row in got:
        want = library.encode(row.text or "", add_special_tokens=False).ids
        assert ids(row.ids) == want and row.n_tokens == len(want) and row.decoded == (row.text or "")
    both = segment_bpe.round_trip(given, vocabulary, keep_text=False).collect()
    assert sorted((r.doc_id or -1, bytes(r.ids), r.decoded) for r in both) == sorted((r.doc_id or -1, bytes(r.ids), r.decoded) for r in got)
    assert segment_bpe.round_trip(docs([]), vocabulary).count() == 0


def test_query_matches_the_library(shipped, library, tmp_path):
    import hashlib

    from cupom.llm.queries import REGISTRY

    shipped.createDataFrame([(7, "a<|endoftext|>b's"), (8, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in REGISTRY["op11_segment_bpe"][0](shipped, str(tmp_path)).collect()}
    want = library.encode("a<|endoftext|>b's", add_special_tokens=False).ids
    assert got[7].n_tokens == len(want) and got[7].ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
    assert got[7].decoded_sha256 == hashlib.sha256(b"a<|endoftext|>b's").hexdigest()
    assert got[8].n_tokens == 0 and got[8].ids_sha256 == got[8].decoded_sha256 == hashlib.sha256(b"").hexdigest()
