"""Toxicity by a weighted lexicon.

A text is folded (lower case; homoglyphs to Latin letters; digits and signs that stand for letters to
those letters; ``l``, ``1`` and ``i`` to one letter), other characters become single spaces, and one
Aho-Corasick pass finds lexicon entries at word starts: whole words and word beginnings. A word counts
once, with its heaviest entry; hits inside an exception phrase don't count. The score is logistic in
the log of the summed weights and in their share of the length.

Entries and weights are learned: log-odds of a term between toxic and other labelled texts. A caller's own list (``prior``: word ->
weight; none by default) counts as ``PRIOR_TEXTS`` texts of evidence for each of its words, which labelled texts outweigh. The
sample of labelled rows is bounded (``sample_rows``, the lowest hashes of their ids), so its ids are broadcast and no text is
shuffled; term counts are summed by Spark. All terms that pass the odds are entries: their number is bounded by the sample's
words, and ``max_terms`` keeps only the heaviest for callers who want fewer. One fold of the sample calibrates the logistic curve on a
lexicon learned from the others, so the curve sees unknown texts. A word is used only through its letters: language, source and
id are never inputs.

Defined results: a null text is empty; an empty text has no hits and so the lowest score; a null id is never labelled;
of several labels for one id the largest counts, null labels none; without labels of
both kinds only ``prior`` counts, and the curve is ``CURVE``; repeated rows are scored alike; given columns stay except
those named like a result, which are replaced. Memory is bounded by one Arrow batch plus the lexicon.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cupom.llm.common import claim, stored, texts

SAMPLE_ROWS = 200_000
#: A learned term stands in at least so many toxic texts, and its odds are at least so many times the usual ones.
LEAST_TEXTS, LEAST_ODDS = 3, 30.0
#: A beginning is an entry if so many times more texts have it than have any one of its words.
LEAST_SPREAD = 1.5
PREFIXES = (4, 5)
FLUSH_TERMS = 200_000
#: Labelled texts that each word of a caller's list counts for.
PRIOR_TEXTS = 3

# Exception phrases, and characters that stand for Latin letters.
EXCEPTIONS = ("clown fish", "trash can", "trash bin", "sore loser board", "idiot proof", "class clown award")
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "ɡ": "g", "ո": "n", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "l": "i",
}
SIGNS = {"$": "s", "@": "a", "!": "i"}
#: Curve without labels: intercept, log of the weight, log of the weight per thousand words.
CURVE = (-3.0, 1.2, 0.6)
#: Words that a length of zero would otherwise divide by.
SPARE_WORDS = 20

# Full-width letters and digits fold to plain ones first, zero-width characters vanish.
_WIDE = {0xFF01 + i: chr(0x21 + i) for i in range(94)} | dict.fromkeys((0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD))
_FOLD = str.maketrans(HOMOGLYPHS)
_HAS_WIDE = re.compile("[­​-‍⁠﻿！-～]")
_SIGN = re.compile(r"[$@!](?=\w)")
_GAP = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    """Folded text: words of letters and digits, one space before, between and after them."""
    if _HAS_WIDE.search(text):
        text = text.translate(_WIDE)
    text = _SIGN.sub(lambda m: SIGNS[m[0]], text).lower().translate(_FOLD)
    return f" {_GAP.sub(' ', text).strip()} " if text else "  "


def terms(folded: str) -> set[str]:
    """Lexicon candidates of a folded text: " word " and " beginning"."""
    words = set(folded.split())
    found = {f" {w} " for w in words}
    for n in PREFIXES:
        found.update(f" {w[:n]}" for w in words if len(w) > n)
    return found


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = CURVE
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "curve": self.curve, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            a = ahocorasick.Automaton()
            for term, weight in self.weights.items():
                a.add_word(term, (len(term), weight))
            for phrase in self.exceptions:
                term = fold(phrase)
                if term.strip():
                    a.add_word(term, (len(term), None))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def weigh(self, folded: str) -> tuple[float, int, int]:
        """(summed weight, hits, words) of a folded text."""
        words = folded.count(" ") - 1 if folded.strip() else 0
        if not self.weights:
            return 0.0, 0, words
        best: dict[int, float] = {}
        exempt = []
        for end, (length, weight) in self.automaton().iter(folded):
            at = end - length + 1
            if weight is None:
                exempt.append((at, end))
            elif weight > best.get(at, 0.0):
                best[at] = weight
        if exempt:
            best = {at: w for at, w in best.items() if not any(a <= at < b for a, b in exempt)}
        return float(sum(best.values())), len(best), words

    def score(self, weight: float, words: int) -> float:
        z = self.curve[0] + float(np.dot(self.curve[1:], shape(weight, words)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def shape(weight: float, words: int) -> tuple[float, float]:
    return float(np.log1p(weight)), float(np.log1p(1000 * weight / (words + SPARE_WORDS)))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, float, float]:
    """Logistic regression by Newton steps; slopes are not let below 0, so more hits never lower a score."""
    if len(y) == 0 or y.min() == y.max():
        return CURVE
    design, beta = np.c_[np.ones(len(y)), x], np.zeros(x.shape[1] + 1)
    penalty = np.diag([1e-3, *[ridge] * x.shape[1]])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + penalty, design.T @ (y - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    if (beta[1:] < 0).any():
        keep = int(np.argmax(beta[1:]))
        if x.shape[1] > 1:
            b = fit_curve(x[:, [keep]], y, ridge)
            return (b[0], *(b[1] if i == keep else 0.0 for i in range(x.shape[1])))
        return (float(beta[0]), max(0.0, float(beta[1])))
    return tuple(float(b) for b in beta)


def _lexicon(rows: list[tuple[str, float, float]], totals: tuple[float, float], prior: Mapping[str, float], max_terms: int | None) -> dict[str, float]:
    """Weights of terms by their smoothed log-odds; words of the prior list by the mean of their log-odds and the list's weight.

    A word of the list goes once its mean is below the least weight that a learned term can have.
    """
    weights = dict(prior)
    toxic, other = totals
    if toxic == 0 or other == 0:
        return weights
    listed = dict(weights)
    least = float(np.log(LEAST_ODDS)) * LEAST_TEXTS / (LEAST_TEXTS + 3)
    whole: dict[str, float] = {}  # of each beginning: texts with the commonest of its words
    for term, t, _ in rows:
        if term.endswith(" "):
            for n in PREFIXES:
                whole[term[: n + 1]] = max(whole.get(term[: n + 1], 0), t)
    learned = {}
    for term, t, c in rows:
        if not term.endswith(" ") and t < LEAST_SPREAD * whole.get(term, 0):
            continue  # it stands for one word, which is an entry itself
        odds = ((t + 0.5) / (toxic + 1)) / ((c + 0.5) / (other + 1))
        if term in listed:
            mean = (PRIOR_TEXTS * listed[term] + (t + c) * float(np.log(odds))) / (PRIOR_TEXTS + t + c) if t + c else listed[term]
            if mean >= least:
                weights[term] = mean
            else:
                del weights[term]
            continue
        if t >= LEAST_TEXTS and odds >= LEAST_ODDS:
            learned[term] = float(np.log(odds)) * t / (t + 3)  # few texts say less
    heavy = sorted(learned.items(), key=lambda x: (-x[1], x[0]))[:max_terms]
    return weights | dict(heavy)


def fold_of(key):
    """Fold 0 to 4 of an id; fold 0 is held out, the others may be learned from."""
    return F.crc32(key.cast("string").cast("binary")) % 5


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample_rows: int = SAMPLE_ROWS,
          prior: Mapping[str, float] | None = None, max_terms: int | None = None) -> Lexicon:
    """Lexicon and curve from the labelled rows outside fold 0."""
    listed_words = {fold(w): weight for w, weight in (prior or {}).items()}
    marks = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_tox_id"))
        .agg(F.max(F.col(label).cast("int")).alias("_tox_label"))
        .withColumn("_tox_fold", fold_of(F.col("_tox_id")))
        .where("_tox_fold <> 0")
        .orderBy(F.xxhash64("_tox_id"), "_tox_id")
        .limit(sample_rows)
    )
    body = docs.select(docs[key].alias("_tox_id"), docs[text].cast("string").alias("_tox_text"))
    # At most ``sample_rows`` ids: the bound of the broadcast.
    sample = body.join(F.broadcast(marks), "_tox_id").select("_tox_text", "_tox_label", "_tox_fold")

    def count(batches):
        claim("toxicity")
        sums: dict[str, list[int]] = {}
        kinds = Counter()

        def flush():
            columns = list(zip(*([k, *v] for k, v in sums.items()), strict=True)) or [[]] * 5
            return pa.RecordBatch.from_pydict({"term": pa.array(columns[0], pa.string()), **{n: pa.array(c, pa.int64()) for n, c in zip(("t", "c", "t4", "c4"), columns[1:], strict=True)}})

        for batch in batches:
            for body_, mark, part in zip(texts(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                slot = (0 if mark else 1) + (2 if part == 4 else 0)
                kinds[slot] += 1
                for term in terms(fold(body_)):
                    row = sums.get(term)
                    if row is None:
                        row = sums[term] = [0, 0, 0, 0]
                    row[slot] += 1
            if len(sums) >= FLUSH_TERMS:
                yield flush()
                sums = {}
        sums[""] = [kinds[i] for i in range(4)]  # the empty term counts texts
        yield flush()

    counts = sample.mapInArrow(count, "term string, t long, c long, t4 long, c4 long")
    listed = F.col("term").isin(list(listed_words)) if listed_words else F.lit(False)
    summed = counts.groupBy("term").agg(*[F.sum(n).alias(n) for n in ("t", "c", "t4", "c4")])
    summed = stored(summed.where((F.col("term") == "") | listed | (F.col("t") + F.col("t4") >= LEAST_TEXTS)), "toxic-terms")
    totals = tuple(summed.where("term = ''").select("t", "c", "t4", "c4").first() or (0, 0, 0, 0))
    # A term that either lexicon may want. A word that a beginning could stand for has odds of at least the beginning's by LEAST_SPREAD.
    odds = lambda t, c, toxic, other: ((t + 0.5) / (toxic + 1)) / ((c + 0.5) / (other + 1))
    best = F.greatest(odds(F.col("t"), F.col("c"), *totals[:2]), odds(F.col("t") + F.col("t4"), F.col("c") + F.col("c4"), totals[0] + totals[2], totals[1] + totals[3]))
    rows = (
        summed.where(F.col("term") != "")
        .where(listed | (best >= LEAST_ODDS / LEAST_SPREAD))
        .collect()  # terms of at least LEAST_TEXTS sampled texts, far commoner in toxic ones: bounded by the sample
    )
    early = Lexicon(_lexicon([(r.term, r.t, r.c) for r in rows], totals[:2], listed_words, max_terms))

    def measure(batches):
        for batch in batches:
            seen = [early.weigh(fold(x)) for x in texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _, _ in seen], pa.float64()), pa.array([n for _, _, n in seen], pa.int64()), batch.column(1).cast(pa.int32())], names=["weight", "words", "label"])

    # An id may have many rows: at most ``sample_rows`` of them come, those with the lowest hashes.
    measured = sample.where("_tox_fold = 4").mapInArrow(measure, "weight double, words long, label int")
    shapes = measured.orderBy(F.xxhash64("weight", "words", "label"), "weight", "words", "label").limit(sample_rows).collect()
    x = np.array([shape(r.weight, r.words) for r in shapes]).reshape(-1, 2)
    y = np.array([float(r.label > 0) for r in shapes])
    everything = _lexicon([(r.term, r.t + r.t4, r.c + r.c4) for r in rows], (totals[0] + totals[2], totals[1] + totals[3]), listed_words, max_terms)
    return Lexicon(everything, curve=fit_curve(x, y))


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (1 from 0.5 on), ``n_hits`` and ``hit_weight``."""
    results = ("score", "predicted", "n_hits", "hit_weight")
    stay = [c for c in docs.columns if c.lower() not in results and (keep_text or c != text)]
    schema = T.StructType([docs.schema[c] for c in stay] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("n_hits", T.LongType()), T.StructField("hit_weight", T.DoubleType())])
    source = docs.select(*stay, docs[text].cast("string").alias("_tox_text"))

    def task(batches):
        claim("toxicity")
        for batch in batches:
            seen = [lexicon.weigh(fold(x)) for x in texts(batch.column(batch.num_columns - 1))]
            points = [lexicon.score(w, n) for w, _, n in seen]
            columns = [pa.array(points, pa.float64()), pa.array([int(p >= 0.5) for p in points], pa.int32()), pa.array([h for _, h, _ in seen], pa.int64()), pa.array([w for w, _, _ in seen], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*stay, *results])

    return source.mapInArrow(task, schema)
