"""Toxicity by a counterfactual-regularised classifier.

A logistic model scores a document by which words occur in its whole text, and how many different ones share a beginning. It is fitted on a bounded sample
of labelled documents. In their sentences each identity term is swapped for the others of its kind and for neutral ones, and the
squared change of the score is part of the loss, so that naming a group moves no score while abuse around it does.

Cases: a null or empty text has no words and gets the model's base score; labels that are null or whose document is missing are left out, of
repeated labels the highest counts; without any label everything scores low; a null doc_id is never held out and never learnt from;
repeated rows score alike; an empty table gives an empty one. Extra columns pass through ``filtered``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import prepare, stored, text_of
from tidewatch.llm.vocab import unload

#: Bounds of the fit: labelled documents (those of the smallest hashes), and features kept (those that tell the classes apart best).
FIT_ROWS, FEATURES = 20_000, 4_000
#: Least distance of a feature's shares in standard errors, least documents with a feature, strengths of the two penalties, and steps of the fit.
LEAST_APART, LEAST_DOCS, RIDGE, SWAP, STEPS = 4.0, 3, 2e-4, 1.0, 300
#: Beginnings of words that are features, in characters.
BEGINNINGS = range(3, 7)
#: A beginning counts when so many different words of a text have it (one digit each).
SHARED = (1, 2, 3, 5)
EDGES = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum()) + "¡¿«»–—‘’“”…"
SENTENCE = re.compile(r"[.!?\n]+")

#: Terms for groups of people by kind, and neutral ones that any of them may be swapped for.
IDENTITY = {
    "gender": "man men woman women boy girl male female transgender mann frau männer frauen homme femme hommes femmes hombre mujer hombres mujeres",
    "orientation": "gay lesbian bisexual straight heterosexual homosexual queer schwul lesbisch gai lesbienne lesbiana",
    "religion": "christian christians muslim muslims jew jews jewish hindu buddhist atheist catholic protestant christ muslime juden juif juifs musulman musulmans judío judíos musulmán",
    "origin": "black white asian african european latino hispanic arab american german french spanish chinese mexican indian immigrant immigrants refugee "
              "schwarz weiß deutsch ausländer flüchtling noir blanc arabe immigré étranger negro blanco inmigrante extranjero",
    "age and ability": "old young elderly disabled blind deaf autistic alt jung behindert vieux jeune handicapé viejo joven discapacitado",
}
NEUTRAL = "person people someone leute jemand personne gens persona gente"


def stems_of(word: str) -> list[str]:
    """The word, and its beginnings marked by a caret."""
    return [word, *("^" + word[:n] for n in BEGINNINGS if len(word) > n)]


def words_of(text: str) -> set[str]:
    return {w for w in (x.strip(EDGES) for x in set(text.lower().split())) if w}


def features_of(words: set[str]) -> list[str]:
    """A text's features: each word, and each beginning with how many different words share it at least."""
    counts = Counter(stem for word in words for stem in stems_of(word))
    return [f"{stem}{n}" for stem, count in counts.items() for n in (SHARED if stem[0] == "^" else SHARED[:1]) if count >= n]


class Presence:
    """Which of the known features a text has, by looking each distinct word up; words met before are remembered."""

    def __init__(self, known: dict[str, int], limit: int = 200_000):
        self.limit, self.met, self.levels = limit, {}, {}
        for feature, i in known.items():
            self.levels.setdefault(feature[:-1], []).append((int(feature[-1]), i))

    def of(self, words: set[str]) -> set[int]:
        if len(self.met) > self.limit:
            self.met = {}
        counts: dict[str, int] = {}
        for word in words:
            own = self.met.get(word)
            if own is None:
                own = tuple(s for s in stems_of(word) if s in self.levels)
                if len(word) <= 64:
                    self.met[word] = own
            for stem in own:
                counts[stem] = counts.get(stem, 0) + 1
        return {i for stem, count in counts.items() for n, i in self.levels[stem] if count >= n}


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """``text``, ``toxic`` of at most ``rows`` labelled documents that are not held out, stored. The ids sent out are at most ``rows``."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    chosen = stored(chosen, "labelled")
    return stored(documents.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "sample")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each feature, by label, of one partition."""
    unload()
    counts = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[toxic > 0].update(features_of(words_of(text)))
    names = list(counts[0] | counts[1])
    for at in range(0, len(names), 50_000):
        own = names[at:at + 50_000]
        yield pa.RecordBatch.from_pydict({"feature": pa.array(own, pa.string()), "clean": pa.array([counts[0][n] for n in own], pa.int64()), "toxic": pa.array([counts[1][n] for n in own], pa.int64())})


def choose(rows: DataFrame, n_clean: int, n_toxic: int, features: int = FEATURES) -> list[str]:
    """The features whose shares among toxic and clean documents differ most, in standard errors."""
    counts = rows.mapInArrow(_count, "feature string, clean bigint, toxic bigint").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    both, all_docs = F.col("clean") + F.col("toxic"), n_clean + n_toxic
    share = both / all_docs
    apart = (F.col("toxic") / n_toxic - F.col("clean") / n_clean) / F.sqrt((share * (1 - share) + 1e-9) * (1 / n_toxic + 1 / n_clean))
    best = counts.where(both >= LEAST_DOCS).select("feature", F.abs(apart).alias("apart")).where(F.col("apart") >= LEAST_APART).orderBy(F.col("apart").desc(), "feature").limit(features)
    return [r[0] for r in best.collect()]


def swaps() -> dict[str, list[str]]:
    """What each identity term may be swapped for."""
    kinds = [terms.split() for terms in IDENTITY.values()]
    return {term: [t for t in kind if t != term] + NEUTRAL.split() for kind in kinds for term in kind}


def _examples(known: dict[str, int]):
    """Per document its features (``swap`` null), and per swap in a sentence the features that it adds and takes away."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence, other = Presence(known), swaps()
        for batch in batches:
            labels, added, taken = [], [], []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                labels.append(toxic)
                added.append(sorted(presence.of(words)))
                taken.append(None)
                if words.isdisjoint(other):
                    continue
                for sentence in map(words_of, SENTENCE.split(text)):
                    for term in sentence & other.keys():
                        before = presence.of(sentence)
                        for new in other[term]:
                            after = presence.of((sentence - {term}) | {new})
                            if after != before:
                                labels.append(None)
                                added.append(sorted(after - before))
                                taken.append(sorted(before - after))
            yield pa.RecordBatch.from_pydict({"toxic": pa.array(labels, pa.int32()), "added": pa.array(added, pa.list_(pa.int32())), "taken": pa.array(taken, pa.list_(pa.int32()))})

    return run


def _sparse(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return rows, np.fromiter((i for x in lists for i in x), np.int64, len(rows))


def fit(lists: list[list[int]], toxic: np.ndarray, changes: list[tuple[list[int], list[int], int]], n: int) -> tuple[float, np.ndarray]:
    """Base and weights: logistic loss, ridge, and the mean squared change of the logit over the swaps."""
    rows, columns = _sparse(lists)
    up, down, times = ([c[i] for c in changes] for i in range(3))
    (ur, uc), (dr, dc), times = _sparse(up), _sparse(down), np.array(times, np.float64)
    weights, base = np.zeros(n), math.log((toxic.sum() + 0.5) / (len(toxic) - toxic.sum() + 1.5))
    mean, spread, first, second = np.zeros(n + 1), np.zeros(n + 1), 0.9, 0.999
    total = max(times.sum(), 1.0)
    for step in range(1, STEPS + 1):  # Adam
        logit = base + np.bincount(rows, weights[columns], len(toxic))
        wrong = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - toxic) / len(toxic)
        gradient = np.bincount(columns, wrong[rows], n) + RIDGE * weights
        if len(times):
            moved = (np.bincount(ur, weights[uc], len(times)) - np.bincount(dr, weights[dc], len(times))) * times * (2 * SWAP / total)
            gradient += np.bincount(uc, moved[ur], n) - np.bincount(dc, moved[dr], n)
        whole = np.append(gradient, wrong.sum())
        mean, spread = first * mean + (1 - first) * whole, second * spread + (1 - second) * whole * whole
        move = 0.1 * (1 - step / (STEPS + 1)) * (mean / (1 - first**step)) / (np.sqrt(spread / (1 - second**step)) + 1e-8)
        weights, base = weights - move[:-1], base - move[-1]
    return base, weights


def train(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[float, dict[str, float]]:
    """Base score (a logit) and the weight of each feature."""
    prepare(documents.sparkSession)
    labelled = sample(documents, labels, rows)
    counts = {bool(r[0]): r[1] for r in labelled.groupBy(F.col("toxic") > 0).count().collect()}
    n_clean, n_toxic = counts.get(False, 0), counts.get(True, 0)
    if not n_clean or not n_toxic:
        return math.log((n_toxic + 0.5) / (n_clean + 1.5)), {}
    known = {f: i for i, f in enumerate(choose(labelled, n_clean, n_toxic))}
    found = labelled.mapInArrow(_examples(known), "toxic int, added array<int>, taken array<int>")
    # At most ``rows`` lists of at most FEATURES numbers, and each kind of swap once with its count.
    grouped = stored(found, "examples")
    docs = grouped.where("taken is null").select("toxic", "added").collect()
    changes = grouped.where("taken is not null").groupBy("added", "taken").count().collect()
    base, weights = fit([r[1] for r in docs], np.array([r[0] > 0 for r in docs], np.float64), [(r[0], r[1], r[2]) for r in changes], len(known))
    return base, {f: float(weights[i]) for f, i in known.items()}


def score(frame: DataFrame, model: tuple[float, dict[str, float]], text: str = "text") -> Column:
    """The score of each whole text, 0 to 1."""
    spark = prepare(frame.sparkSession)
    base, weights = model
    shared = spark.sparkContext.broadcast((base, list(weights), np.array(list(weights.values()), np.float64)))

    @F.arrow_udf("double")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        unload()
        start, names, values = shared.value
        presence = Presence({f: i for i, f in enumerate(names)})
        for batch in texts:
            logits = [start + float(values[sorted(presence.of(words_of(t)))].sum()) if t else start for t in batch.to_pylist()]
            yield pa.array(1 / (1 + np.exp(-np.clip(np.array(logits, np.float64), -40, 40))), pa.float64())

    return run(text_of(text))


def report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    model = train(documents, labels)
    scored = documents.select("doc_id", "text").withColumn("score", score(documents, model))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def filtered(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below 0.5, with their columns."""
    model = train(documents, labels)
    scored = documents.withColumn("__score", score(documents, model)).where("__score < 0.5")
    return scored.select(*[F.col(f"`{c}`") for c in documents.columns])
