"""Operator 2: toxicity from the nearest labelled examples.

Examples: up to ``EXAMPLES`` labelled documents of each class with at most
``EXAMPLE_CHARS`` characters, those with the smallest hash; equal texts count
once. Terms: all words of the examples. Document frequencies of the terms come
from all documents. A text is its vector of ``(1 + log tf) * idf * t`` over all its
words. ``t`` is 1 for a term that doesn't tell the classes apart; beyond
``MIN_Z`` standard errors it grows with the excess times the term's log odds.
A word that no example holds weighs as a word of one document with ``t`` 1: it
adds to the length of a text, so the cosines are those of whole texts.

Search: exact cosine against the examples, by an inverted index with block
maxima. The examples lie in blocks of ``BLOCK``. The lists of rare terms are
read in full. A term that ``1 / COMMON`` of the examples hold has a column over all of
them and its largest weight in each block: by these maxima, or by the lengths of
both texts' common parts where that is less, an example's score has an upper
bound. The examples with the best bounds are scored first; of all others only
those whose bound reaches the ``NEIGHBOURS``-th best score, so no neighbour is lost.

Score: neighbours vote with their cosine as weight; the vote becomes a
probability by a logistic fit on the examples' own leave-one-out votes, taken in
tasks and weighted to the share of toxic labels among all labelled rows. A text
without a neighbour (empty, null or without a word of any example) gets the rate
of such texts. ``evidence`` names up to three nearest examples with their cosines.

Labels of rows whose ``crc32(doc_id) mod 3`` is 1 are never read, nor are lang,
source and doc_id inputs of a score. A null id is not held out. Labels that
repeat: the larger counts; null labels are left out. Without examples of both
classes every score is the share of toxic labels (0 without labels). An empty
table gives an empty table. All columns of the documents pass; score, predicted
and evidence are replaced where they exist.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, materialise, ship

EXAMPLES = 4_096
#: Longer texts are scored, but no examples: with EXAMPLES this bounds what the driver and each task hold.
EXAMPLE_CHARS = 16_384
NEIGHBOURS = 20
BLOCK = 64
#: As many examples as these blocks hold are scored first, those with the best bounds.
FIRST_BLOCKS = 1
#: A term that one in COMMON examples holds has a column instead of a list.
COMMON = 8
MIN_Z = 3.0
CACHE_ENTRIES = 500_000
THRESHOLD = 0.7
SHOWN = 3
#: How strongly the calibration is drawn to slope 1.
PULL = 0.01

_EDGE = ".,;:!?\"'()[]{}<>|*_-"


def held_out(doc_id: Column | str) -> Column:
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % 3 == 1, F.lit(False))


def terms_of(text: str | None) -> Counter:
    """Lower-case words without the punctuation at their ends, counted."""
    return Counter(w.strip(_EDGE) for w in text.lower().split()) if text else Counter()


class RawTerms(dict):
    """Word as it stands in a text -> number of its term, -1 for an unknown word, -2 for none; remembers what it has met."""

    def __init__(self, number: dict[str, int]):
        self.number = number

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        term = word.strip(_EDGE)
        i = self[word] = self.number.get(term, -1 if term else -2)
        return i

    def numbers(self, text: str | None) -> tuple[list[str], np.ndarray]:
        words = text.lower().split() if text else []
        return words, np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))

    def terms(self, text: str | None) -> np.ndarray:
        """Numbers of the terms in a text."""
        ids = np.unique(self.numbers(text)[1])
        return ids[ids >= 0]

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Numbers of the terms in a text, how often each is there, and how often each unknown word."""
        words, every = self.numbers(text)
        ids, n = np.unique(every, return_counts=True)
        known = ids >= 0
        unknown = Counter(words[i].strip(_EDGE) for i in np.flatnonzero(every == -1))
        return ids[known], n[known], list(unknown.values())


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of all stretches, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Index:
    """Inverted index of the examples: lists of rare terms, columns and block maxima of common ones."""

    def __init__(self, terms: list[str], weight_of: np.ndarray, unknown: float, docs: np.ndarray, keys: np.ndarray,
                 toxic: np.ndarray, rows: np.ndarray, ids: np.ndarray, counts: np.ndarray):
        """``weight_of``: a factor for each term; ``unknown``: that of words outside; ``keys``: hashes of the examples' texts;
        ``rows``, ``ids``, ``counts``: example, term and frequency of each posting."""
        self.number = {t: i for i, t in enumerate(terms)}
        self.weight_of, self.unknown = weight_of, unknown
        w = (1 + np.log(counts)) * weight_of[ids]
        rows, ids, w = rows[w > 0], ids[w > 0], w[w > 0]
        w = w / np.sqrt(np.bincount(rows, w * w, minlength=len(docs)))[rows]
        # Examples that lean on the same term lie together: their blocks have telling bounds.
        shared = np.where(np.bincount(ids, minlength=len(terms))[ids] >= BLOCK // 4, w, 0)
        lead = np.full(len(docs), -1, dtype=np.int64)
        by = np.argsort(shared, kind="stable")
        lead[rows[by]] = ids[by]
        order = np.lexsort((docs, lead, toxic))
        order = order[lead[order] >= 0]  # the others have no vector
        place = np.full(len(docs), -1, dtype=np.int64)
        place[order] = np.arange(len(order))
        self.docs, self.toxic = docs[order], toxic[order].astype(np.float64)
        self.place_of = dict(zip(keys[order].tolist(), range(len(order))))
        rows = place[rows]
        by = np.lexsort((rows, ids))
        rows, ids, w = rows[by], ids[by], w[by]
        held = np.bincount(ids, minlength=len(terms))
        often = held * COMMON >= len(order) if len(order) else held > 0
        self.column = np.where(often, np.cumsum(often) - 1, -1)  # of each common term
        common = often[ids]
        self.dense = np.zeros((len(order), int(often.sum())))
        self.dense[rows[common], self.column[ids[common]]] = w[common]
        self.block = np.arange(len(order)) // BLOCK
        self.top = np.maximum.reduceat(self.dense, np.arange(0, len(order), BLOCK)) if len(order) else self.dense
        self.length = np.sqrt(np.einsum("ij,ij->i", self.dense, self.dense))  # of each example's common part
        self.place, self.weight = rows[~common], w[~common]
        self.first = np.searchsorted(ids[~common], np.arange(len(terms) + 1))
        self.raw = RawTerms(self.number)
        self.slope, self.offset, self.none = 1.0, 0.0, 0.0

    @property
    def own(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Terms and weights of each example."""
        rare = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        common = np.flatnonzero(self.column >= 0)
        return [(np.append(rare[self.place == j], common[self.dense[j] > 0]),
                 np.append(self.weight[self.place == j], self.dense[j][self.dense[j] > 0])) for j in range(len(self.docs))]

    def weigh(self, ids: np.ndarray, counts: np.ndarray, unknown: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of a text of length 1; ``unknown``: how often it has each word outside the terms."""
        w = (1 + np.log(counts)) * self.weight_of[ids]
        keep = w > 0
        ids, w = ids[keep], w[keep]
        outside = (self.unknown * (1 + np.log(unknown))) if unknown else np.zeros(0)
        return ids, w / math.sqrt((w * w).sum() + (outside * outside).sum()) if len(w) else w

    def nearest(self, ids: np.ndarray, w: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the nearest examples, nearest first; only those above zero."""
        if not len(ids) or not len(self.docs):
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        column = self.column[ids]
        common = np.zeros(self.dense.shape[1])
        common[column[column >= 0]] = w[column >= 0]
        starts = self.first[ids]
        sizes = self.first[ids + 1] - starts  # none for common terms
        post = spans(starts, sizes)
        got = np.bincount(self.place[post], np.repeat(w, sizes) * self.weight[post], minlength=len(self.docs))
        # einsum, not @: a task has one core, and BLAS would start threads.
        tops = np.einsum("ij,j->i", self.top, common)[self.block]
        bound = got + np.minimum(tops, self.length * (math.sqrt((common * common).sum()) * (1 + 1e-12)))
        if skip >= 0:
            bound[skip] = -1.0
        # The most promising examples first; then, at once, all whose bound reaches the worst score kept.
        first = FIRST_BLOCKS * BLOCK
        some = np.argpartition(-bound, first)[:first] if first < len(bound) else np.arange(len(bound))
        some = some[bound[some] > 0]
        scores = got[some] + np.einsum("ij,j->i", self.dense[some], common)
        scores = scores[scores > 0]
        worst = np.partition(scores, len(scores) - NEIGHBOURS)[len(scores) - NEIGHBOURS] if len(scores) >= NEIGHBOURS else 0.0
        places = np.flatnonzero((bound > 0) & (bound + 1e-12 >= worst))
        scores = got[places] + np.einsum("ij,j->i", self.dense[places], common)
        good = (scores > 0) & (scores + 1e-12 >= worst)
        places, scores = places[good], scores[good]
        best = np.lexsort((self.docs[places], -scores))[:NEIGHBOURS]
        return places[best], scores[best]

    def vote(self, places: np.ndarray, scores: np.ndarray) -> float:
        """Log odds of the distance-weighted vote."""
        yes = (scores * self.toxic[places]).sum()
        return math.log((yes + 0.05) / (scores.sum() - yes + 0.05))

    def calibrate(self, x: np.ndarray, y: np.ndarray, share: float, n0: int, n1: int) -> None:
        """Fit the logistic curve to leave-one-out votes ``x`` of examples of class ``y``. ``share``: of toxic labels among
        all; ``n0``, ``n1``: examples of each class, those without a vector included."""
        if not 0 < y.sum() < len(y):
            return
        weight = np.where(y == 1, share / n1, (1 - share) / n0) * (n0 + n1)
        a, b = 1.0, math.log(share / (1 - share))
        for _ in range(50):  # Newton steps with a light pull to slope 1
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            g = np.array([(weight * (p - y) * x).sum() + PULL * (a - 1), (weight * (p - y)).sum()])
            h = weight * p * (1 - p)
            step = np.linalg.solve([[(h * x * x).sum() + PULL, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]], g)
            a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.offset = float(a), float(b)

    def judge(self, text: str | None) -> tuple[float | None, list[int], list[float]]:
        """The vote on a text (None: no neighbour), the nearest examples and their cosines."""
        places, scores = self.nearest(*self.weigh(*self.raw.counts(text)))
        if not len(places):
            return None, [], []
        return self.vote(places, scores), self.docs[places[:SHOWN]].tolist(), scores[:SHOWN].tolist()


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        bags = [[(t, n) for t, n in terms_of(x).items() if t] for x in b["t"]]
        yield pd.DataFrame({"k": np.repeat(b["k"].to_numpy(), [len(x) for x in bags]),
                            "term": pd.Series([t for x in bags for t, _ in x], dtype=object),
                            "n": np.array([n for x in bags for _, n in x], dtype=np.int32)})


def telling(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """How much more a term weighs that ``a`` of ``n1`` toxic and ``b`` of ``n0`` other examples hold; 1 at least."""
    rate = (a + b) / (n0 + n1)
    z = np.abs(a / n1 - b / n0) / np.sqrt(rate * (1 - rate) * (1 / n1 + 1 / n0) + 1e-12)
    return 1 + np.maximum(z - MIN_Z, 0) * np.abs(np.log((a + 0.5) / (n1 + 1) / ((b + 0.5) / (n0 + 1))))


def _fitted(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> tuple[Index, Broadcast]:
    """The calibrated index, and its broadcast from before the calibration."""
    spark = docs.sparkSession
    ship(spark)
    known = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("toxic"))
             .where("id IS NOT NULL AND toxic IS NOT NULL").where(~held_out("id"))
             .groupBy("id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic")))
    known = materialise(known, "tox-labels")
    n, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = toxic / n if n else 0.0
    none = np.zeros(0, dtype=np.int64)
    nothing = Index([], np.zeros(0), 0.0, none, none, none, none, none, none)
    nothing.none = share
    if not 0 < toxic < n:
        return nothing, spark.sparkContext.broadcast(nothing)
    hashed = F.xxhash64("id")
    short = (docs.where(F.length(text) <= EXAMPLE_CHARS).select(F.col(doc_id).alias("id")).distinct()
             .join(known, "id"))
    short = materialise(short, "tox-candidates")
    chosen = [short.where(F.col("toxic") == c).orderBy(hashed, "id").limit(EXAMPLES) for c in (0, 1)]
    # At most 2 * EXAMPLES ids: small enough to send to every task.
    picked = (docs.where(F.length(text) <= EXAMPLE_CHARS).select(F.col(doc_id).alias("id"), F.col(text).alias("t"))
              .join(F.broadcast(chosen[0].union(chosen[1])), "id"))
    bags = materialise(picked.groupBy(F.xxhash64("t").alias("k")).agg(F.min(F.struct("id", "toxic", "t")).alias("x"))
                       .select("k", "x.id", "x.toxic", "x.t"), "tox-examples")
    examples = bags.select("k", "id", "toxic").orderBy("id", "k").toArrow()  # 2 * EXAMPLES rows, more where ids repeat
    keys, ids, toxics = (examples[c].to_numpy().astype(np.int64) for c in ("k", "id", "toxic"))
    n0, n1 = int((toxics == 0).sum()), int((toxics == 1).sum())
    # The words of the examples, and nothing that grows with the table.
    words = bags.select("k", "t").mapInPandas(_words, "k bigint, term string, n int").toArrow()
    coded = pa.concat_arrays(words["term"].chunks or [pa.array([], pa.string())]).dictionary_encode()
    met = coded.dictionary.to_pylist()
    terms = sorted(met)
    if not n0 or not n1 or not terms:
        return nothing, spark.sparkContext.broadcast(nothing)
    number = {t: i for i, t in enumerate(terms)}
    by_key = np.argsort(keys)
    rows = by_key[np.searchsorted(keys[by_key], words["k"].to_numpy())]
    places = np.array([number[t] for t in met])[coded.indices.to_numpy()]
    # Documents that hold each term, over the whole table: a count for each term and task.

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, total, raw = np.zeros(len(number) + 1, dtype=np.int64), 0, RawTerms(number)
        for b in batches:
            for t in b["t"]:
                total += 1
                counts[raw.terms(t)] += 1
        counts[-1] = total
        some = np.flatnonzero(counts)
        yield pd.DataFrame({"term": some, "n": counts[some]})

    found = (docs.select(F.col(text).alias("t")).mapInPandas(frequencies, "term int, n bigint")
             .groupBy("term").agg(F.sum("n").alias("n")).toArrow())  # a row for each word of the examples
    df = np.zeros(len(terms) + 1)
    df[found["term"].to_numpy()] = found["n"].to_numpy()
    idf = np.log((1 + df[-1]) / (1 + df[:-1]))
    a, m = np.bincount(places, toxics[rows], minlength=len(terms)), np.bincount(places, minlength=len(terms))
    index = Index(terms, idf * telling(a, m - a, n1, n0), math.log((1 + df[-1]) / 2), ids, keys, toxics, rows, places,
                  words["n"].to_numpy().astype(np.float64))
    shared = spark.sparkContext.broadcast(index)  # bounded by the examples

    def left_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ix = shared.value
        for b in batches:
            got = []
            for k, toxic, t in zip(b["k"], b["toxic"], b["t"]):
                if k in ix.place_of:
                    places, scores = ix.nearest(*ix.weigh(*ix.raw.counts(t)), skip=ix.place_of[k])
                    if len(places):
                        got.append((ix.vote(places, scores), toxic))
            yield pd.DataFrame(got, columns=["vote", "toxic"])

    spread = bags.select("k", "toxic", "t").repartition(max(1, spark.sparkContext.defaultParallelism), "k")
    votes = spread.mapInPandas(left_out, "vote double, toxic int").toArrow()  # a row an example
    votes = votes.sort_by([("vote", "ascending"), ("toxic", "ascending")])
    index.calibrate(votes["vote"].to_numpy(), votes["toxic"].to_numpy().astype(np.float64), share, n0, n1)
    # Rate of toxic rows among examples without a vector.
    bare1 = n1 - int(index.toxic.sum())
    bare0 = n0 - (len(index.docs) - int(index.toxic.sum()))
    yes, no = bare1 / n1 * share, bare0 / n0 * (1 - share)
    index.none = yes / (yes + no) if yes + no else share
    return index, shared


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Index:
    """The index and its calibration, from the labels that may be learned from."""
    return _fitted(docs, labels, doc_id, text, label)[0]


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score, predicted and evidence."""
    index, shared = _fitted(docs, labels, doc_id, text, label)

    @F.pandas_udf("struct<vote: double, ids: array<bigint>, cosines: array<double>>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            got = [shared.value.judge(t) for t in texts]
            yield pd.DataFrame({"vote": pd.Series([g[0] for g in got], dtype="float64"),
                                "ids": [g[1] for g in got], "cosines": [g[2] for g in got]})

    docs, back = apart(docs, "_j")
    judged = docs.withColumn("_j", judge(F.col(text)))
    log_odds = F.lit(index.slope) * F.col("_j.vote") + F.lit(index.offset)
    curve = F.when(F.size("_j.ids") == 0, F.lit(index.none)).otherwise(
        1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), log_odds)))))
    return (judged.withColumn("score", curve)
            .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
            .withColumn("evidence", F.arrays_zip(F.col("_j.ids").alias("doc_id"), F.col("_j.cosines").alias("cosine")))
            .drop("_j").withColumnsRenamed(back))
