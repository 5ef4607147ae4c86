"""Operator 5: toxicity by weak supervision.

Features are words, their first 4, 5 and 6 bytes and their last 5 (A-Z lower-cased, ASCII marks part
words), hashed to ``KIND_BUCKETS`` for each of these five kinds; a feature counts once a text.

1. *Lexicons.* On a bounded sample of labelled rows outside the held-out fold, features much more frequent
   in toxic rows are candidates. Each kind's are dealt to ``TIERS`` word lists by how telling they are.
2. *Voters* (``VOTERS``). Each list votes toxic where its features occur at least once in ``SPARSE`` words and abstains elsewhere. Pattern voters look
   at hits (several, dense, of all kinds, repeated, none) and at the writing (capitals, exclamation marks, masked words).
3. *Label model.* Vote patterns are counted over all documents and stay in a table. Expectation-maximisation passes over it
   fit the share of toxic texts and each voter's rates given the class. Annotated rows outside the held-out fold
   anchor the rates; others count by their posterior and weigh ``UNLABELLED_MASS`` of the annotated ones at most. Voters
   that agree beyond what the classes explain are correlated; each vote's evidence is divided by the voter's summed
   correlations, and the fit goes on with these weights. A posterior comes from votes alone: annotators are no voters.
4. *Classifier.* A logistic regression on the lexicon features and hit counts is trained on the posteriors of a
   bounded sample of all documents, labelled or not, and scores every whole text. Only the text enters a score.

``SAMPLE`` bounds the labelled rows of step 1 and the rows of step 4, chosen by a hash. The driver gets sums by
class, voter and vote, never the patterns.

Defined results: null and empty texts have no feature and get the score of a text without hits. Null,
contradicting or missing labels are unknown. Without toxic or without clean labels, and for an empty table, every score is 0.
Repeated rows score alike and are in the sample once; a null doc_id is never held out. Equally telling features go by their
bucket. Texts of any length are read whole; other columns are not read, so they may have any name.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolake.llm.common import agreed, as_text, fold_of, own_name, stored
from ludolake.llm.wordhash import WHITE_AND_MARKS, mix, words

KINDS = ("word", "first_4", "first_5", "first_6", "last_5")
KIND_BUCKETS = 1 << 18
BUCKETS = len(KINDS) * KIND_BUCKETS
SAMPLE = 20_000          # labelled rows for the lexicons, and rows of all documents for the classifier
LEXICON_SIZE = 4096      # features in all lexicons together
TIERS = 4                # lexicons of a kind
LEXICONS = len(KINDS) * TIERS
LEAST_TOXIC = 4          # toxic rows that have a lexicon feature
LEAST_RATIO = 20.0       # its rate in toxic rows to its rate in clean rows
FOLDS, HELD_OUT = 4, 2
CHUNKS = 64
SPARSE = 300             # words a hit; rarer ones, as chance brings them into long texts, are no vote for toxic
ROUNDS = 8               # passes of the label model
LINKED = (2, 5)          # those that measure correlations, too
UNLABELLED_MASS = 0.5    # most that rows without a label weigh in the fit, against those with one
PATTERNS = ("several_hits", "dense_hits", "very_dense_hits", "no_hit", "all_kinds", "repeated_hit", "shouting", "exclaiming",
            "masked")
VOTERS = (*[f"{kind}_{tier}" for kind in KINDS for tier in range(TIERS)], *PATTERNS)

_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32


def _features(own) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the features of a group of rows, repeated as they occur."""
    data = np.zeros(len(own.data) + 16, dtype=np.uint8)
    data[8:8 + len(own.data)] = _FOLDED[own.data]
    eight = np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    size = own.ends - own.starts
    row = np.repeat(np.arange(len(own.bounds) - 1, dtype=np.int64), np.diff(own.bounds))
    rows, found = [row], [own.hashes]
    begin, end = eight[own.starts + 8], eight[own.ends]  # first eight bytes, and last eight
    for k in (4, 5, 6):
        longer = size > k
        rows.append(row[longer])
        found.append(mix((begin[longer] & np.uint64((1 << 8 * k) - 1)) * np.uint64(k | 1)))
    longer = size > 5
    rows.append(row[longer])
    found.append(mix((end[longer] >> np.uint64(24)) ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    buckets = [(h >> np.uint64(46)).astype(np.int64) + kind * KIND_BUCKETS for kind, h in enumerate(found)]
    return np.concatenate(rows), np.concatenate(buckets)


def _groups(texts: pa.Array):
    for own in words(texts, fold=True, separators=WHITE_AND_MARKS):
        row, bucket = _features(own)
        yield own, row, bucket


def _hits_of(texts: pa.Array, buckets: np.ndarray):
    """For each row: its word count, its lexicon features (places in ``buckets``), once for each occurrence, and its bytes."""
    chosen = np.full(BUCKETS, -1, dtype=np.int32)  # made here, so that functions travel without it
    chosen[buckets] = np.arange(len(buckets), dtype=np.int32)
    for own, row, bucket in _groups(texts):
        place = chosen[bucket]
        at = np.flatnonzero(place >= 0)
        row, place = row[at], place[at]
        order = np.argsort(row, kind="stable")
        cuts = np.searchsorted(row[order], np.arange(len(own.bounds)))
        place = place[order]
        for i, (n, b, e) in enumerate(zip(np.diff(own.bounds).tolist(), cuts[:-1].tolist(), cuts[1:].tolist())):
            yield n, place[b:e], own.data[own.offsets[i]:own.offsets[i + 1]]


@dataclass
class ToxicityModel:
    """Lexicon buckets, their lexicons and weights, and what the label model found."""

    buckets: np.ndarray        # of lexicon features
    lexicon: np.ndarray        # lexicon of each
    weights: np.ndarray        # of each feature, then of the count features, then the bias
    accuracies: dict[str, tuple[float, float]]
    correlations: np.ndarray
    prior: float



def _counts_of(n: int, hits: int, distinct: int) -> tuple[float, float, float]:
    """Count features of a text: distinct features hit, hits, and hits a hundred words, all damped."""
    return (float(np.log1p(distinct)), float(np.log1p(hits)), float(np.log1p(100.0 * hits / max(n, 1))))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """Probability that a text is toxic."""
    if not len(model.weights):
        return F.when(text.isNull(), 0.0).otherwise(0.0)
    buckets, weights, k = model.buckets, model.weights, len(model.buckets)

    def score(texts: pa.Array) -> pa.Array:
        out = []
        for n, places, _ in _hits_of(texts, buckets):
            distinct = np.unique(places)
            out.append(float(weights[distinct].sum()) + float(weights[-1])
                       + float(np.dot(weights[k:-1], _counts_of(n, len(places), len(distinct)))))
        return pa.array(_logistic(np.array(out, dtype=np.float64)), pa.float64())

    return F.arrow_udf(score, "double")(text)


_UPPER, _LETTER, _MASK = (np.isin(np.arange(256), list(x)) for x in (
    range(65, 91), [*range(65, 91), *range(97, 123)], b"*@$#"))


def _writing(data: np.ndarray, n: int) -> list[int]:
    """Votes on how a text of ``n`` words is written, whatever the words."""
    letters, upper = np.count_nonzero(_LETTER[data]), np.count_nonzero(_UPPER[data])
    letter, loud = _LETTER[data], np.count_nonzero(data == 33)
    masked = len(data) > 2 and bool((letter[:-2] & _MASK[data[1:-1]] & letter[2:]).any())
    return [2 if letters >= 20 and 2 * upper > letters else 0, 2 if loud >= 3 and 50 * loud > n else 0, 2 if masked else 0]


def _vote_list(n: int, places: np.ndarray, data: np.ndarray, lexicon: np.ndarray) -> list[int]:
    """The vote of each of ``VOTERS``: 1 clean, 2 toxic, 0 none."""
    hits = len(places)
    if not hits:
        return [0] * LEXICONS + [1, 1, 1, 1, 0, 0, *_writing(data, n)]
    distinct, often = np.unique(places, return_counts=True)
    lists = np.bincount(lexicon[places], minlength=LEXICONS)[:LEXICONS] * SPARSE >= n
    return [*[2 if c else 0 for c in lists.tolist()],
            2 if len(distinct) >= 4 else 0,
            2 if hits * 150 >= n and len(distinct) >= 2 else 0 if hits * SPARSE >= n else 1,
            2 if hits * 30 >= n else 0 if hits * 150 >= n else 1,
            0,
            2 if lists.reshape(len(KINDS), TIERS).any(axis=1).all() else 0,
            2 if int(often.max()) >= 3 else 0,
            *_writing(data, n)]


def _votes(text: Column, buckets: np.ndarray, lexicon: np.ndarray) -> Column:
    """All votes as one number of two bits a voter."""
    def vote(texts: pa.Array) -> pa.Array:
        return pa.array([sum(v << (2 * i) for i, v in enumerate(_vote_list(n, places, data, lexicon)))
                         for n, places, data in _hits_of(texts, buckets)], pa.int64())

    return F.arrow_udf(vote, "long")(text)


def _unpacked(votes: np.ndarray) -> np.ndarray:
    return (votes[:, None] >> (2 * np.arange(len(VOTERS)))) & 3


def _lexicon(sample: DataFrame) -> list:
    """(bucket, toxic rows, clean rows) of the features that single out toxic rows."""
    def read(batches):
        counts = np.zeros((2, BUCKETS), dtype=np.int32)
        totals = np.zeros(2, dtype=np.int64)
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            first = 0
            for own, row, bucket in _groups(batch.column("text")):
                once = np.unique(row * BUCKETS + bucket)
                hit = toxic[first + once // BUCKETS]
                for y in (0, 1):
                    at, many = np.unique((once % BUCKETS)[hit == bool(y)], return_counts=True)
                    counts[y, at] += many.astype(np.int32)
                first += own.last - own.first
            totals += np.bincount(toxic, minlength=2)
        if totals.sum():
            step = BUCKETS // CHUNKS
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(CHUNKS), pa.int32()),
                 *[pa.array([counts[y, c * step:(c + 1) * step].tobytes() for c in range(CHUNKS)], pa.binary()) for y in (0, 1)],
                 *[pa.array([int(totals[y])] * CHUNKS, pa.int64()) for y in (0, 1)]],
                names=["chunk", "clean", "toxic", "n_clean", "n_toxic"])

    def select(t: pa.Table) -> pa.Table:
        clean, toxic = (sum(np.frombuffer(x, np.int32) for x in t[c].to_pylist()) for c in ("clean", "toxic"))
        n_clean, n_toxic = (sum(t[c].to_pylist()) for c in ("n_clean", "n_toxic"))
        ratio = ((toxic + 0.5) / (n_toxic + 1)) / ((clean + 0.5) / (n_clean + 1))
        at = np.flatnonzero((toxic >= LEAST_TOXIC) & (ratio >= LEAST_RATIO))
        return pa.table({"bucket": pa.array(at + t["chunk"][0].as_py() * (BUCKETS // CHUNKS), pa.int64()),
                         "toxic": pa.array(toxic[at], pa.int64()), "clean": pa.array(clean[at], pa.int64())})

    found = (sample.select("text", "toxic").mapInArrow(read, "chunk int, clean binary, toxic binary, n_clean long, n_toxic long")
             .groupBy("chunk").applyInArrow(select, "bucket long, toxic long, clean long"))
    return found.orderBy(F.col("toxic").desc(), "clean", "bucket").limit(LEXICON_SIZE).collect()


@dataclass
class LabelModel:
    """Share of toxic rows, rates by (class, voter, vote), correlations of the voters and weight of each one's evidence."""

    share: float
    rate: np.ndarray
    link: np.ndarray

    @property
    def weight(self) -> np.ndarray:
        return 1.0 / self.link.sum(axis=1)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of toxic for each row of votes (0 none, 1 clean, 2 toxic)."""
        evidence = self.weight[:, None] * np.log(self.rate[1] / self.rate[0])
        return _logistic(np.log(self.share / (1 - self.share)) + evidence[np.arange(patterns.shape[1]), patterns].sum(axis=1))


def _masses(patterns: np.ndarray, annotated: np.ndarray, counts: np.ndarray, model: LabelModel | None, lightness: float) -> np.ndarray:
    """Mass of the rows in either class: annotated ones in the annotators', others by their posterior."""
    guess = np.zeros(len(counts)) if model is None else model.posterior(patterns)
    toxic = np.where(annotated > 0, annotated == 2, guess)
    mass = counts * np.where(annotated > 0, 1.0, 0.0 if model is None else lightness)
    return np.stack([mass * (1 - toxic), mass * toxic])


def _vote_sums(patterns, mass) -> np.ndarray:
    """Mass by (class, voter, vote)."""
    return np.stack([[np.bincount(column, weights=m, minlength=3) for column in patterns.T] for m in mass])


def _pair_sums(patterns, mass) -> np.ndarray:
    """Mass by (class, vote, voter, voter) where both gave that vote (1 or 2)."""
    voted = [(patterns == vote).astype(float) for vote in (1, 2)]
    return np.stack([[(v * m[:, None]).T @ v for v in voted] for m in mass])


def _links(pairs: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The largest correlation of two voters' votes within a class, above a tenth."""
    link = np.eye(pairs.shape[-1])
    for own, total in zip(pairs, totals):
        for together in own / max(total, 1e-9):
            mean = np.diag(together)
            deviation = np.sqrt(np.clip(mean - mean ** 2, 0, None))
            both = np.outer(deviation, deviation)
            corr = np.where(both > 1e-6, (together - np.outer(mean, mean)) / np.maximum(both, 1e-12), 0)
            link = np.maximum(link, np.where(corr > 0.1, np.clip(corr, 0, 1), 0))
    np.fill_diagonal(link, 1.0)
    return link


def fit_label_model(total: Callable, labelled: float, rows: float, rounds: int = ROUNDS) -> LabelModel:
    """The model of votes whose sums ``total`` returns.

    ``total(f)`` is the sum of ``f(patterns, annotated, counts)`` over all parts of the votes: a row of votes for each pattern,
    0 (unknown), 1 (clean) or 2 (toxic) by the annotators, and how many rows have both. ``labelled`` of ``rows`` are annotated.
    """
    lightness = min(1.0, UNLABELLED_MASS * labelled / max(rows - labelled, 1.0))
    model = None
    for step in range(rounds):
        def sums(patterns, annotated, counts, model=model, linked=step in LINKED):
            mass = _masses(patterns, annotated, counts, model, lightness)
            found = _vote_sums(patterns, mass)
            return np.concatenate([found.ravel(), _pair_sums(patterns, mass).ravel()]) if linked else found.ravel()

        found = total(sums)
        if model is None:  # sums by class, voter and vote
            voters = len(found) // 6
        pairs, found = found[6 * voters:], found[:6 * voters].reshape(2, voters, 3)
        mass = found[:, 0].sum(axis=1)
        rate = (found + 0.5) / (found + 0.5).sum(axis=2, keepdims=True)
        link = np.eye(voters) if model is None else model.link
        if step in LINKED:
            link = _links(pairs.reshape(2, 2, voters, voters), mass)
        model = LabelModel(float(np.clip(mass[1] / max(mass.sum(), 1.0), 1e-4, 0.9)), np.round(rate, 9), np.round(link, 9))
    return model


def _total_of(patterns: DataFrame) -> Callable:
    """Sums over a stored table (votes, annotated, n): an array's places and sums are all that leaves a task."""
    def total(f: Callable) -> np.ndarray:
        shape = f(np.zeros((1, len(VOTERS)), np.int64), np.zeros(1, np.int64), np.zeros(1)).shape

        def read(batches):
            own = np.zeros(shape)
            for batch in batches:
                votes, annotated, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("votes", "annotated", "n"))
                own += f(_unpacked(votes), annotated, n.astype(float))
            flat = own.ravel()
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(flat[at], pa.float64())], names=["place", "mass"])

        out = np.zeros(shape).ravel()
        for r in patterns.mapInArrow(read, "place long, mass double").groupBy("place").agg(F.sum("mass").alias("mass")).collect():
            out[r["place"]] = r["mass"]
        return out.reshape(shape)

    return total


def _train(rows: list, y: np.ndarray, size: int, steps: int = 400) -> np.ndarray:
    """Logistic regression on the posteriors ``y``, by accelerated gradient steps with an L2 penalty."""
    distinct = [np.array(r["places"], dtype=np.int64) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(d) for d in distinct])
    feature = np.concatenate(distinct) if rows else np.zeros(0, np.int64)
    dense = np.array([[*_counts_of(r["n"], r["hits"], len(d)), 1.0] for r, d in zip(rows, distinct)])
    penalty = np.r_[np.full(size, 2e-4), np.full(3, 1e-4), 0.0]
    w = np.zeros(size + 4)
    w[-1] = -3.0
    ahead, momentum = w.copy(), 1.0
    rate = 1.0 / (0.25 * max(1.0, float((dense ** 2).sum(axis=1).mean() + len(feature) / max(1, len(rows)))) + 1e-3)
    for _ in range(steps):
        z = dense @ ahead[size:]
        if len(feature):
            z = z + np.bincount(row, weights=ahead[feature], minlength=len(rows))
        error = (_logistic(z) - y) / len(rows)
        grad = np.r_[np.bincount(feature, weights=error[row], minlength=size)[:size], error @ dense] + penalty * ahead
        new = ahead - rate * grad
        step = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        ahead = new + (momentum - 1) / step * (new - w)
        w, momentum = new, step
    return w


def held_out(key: Column) -> Column:
    return fold_of(key, FOLDS) == HELD_OUT


def _tiers(found: list) -> np.ndarray:
    """List of each lexicon feature: by kind, and within a kind by how telling it is."""
    buckets = np.array([r["bucket"] for r in found], dtype=np.int64)
    odds = np.array([np.log((r["toxic"] + 0.5) / (r["clean"] + 0.5)) for r in found])
    order = np.lexsort((buckets, -odds))
    lexicon = np.empty(len(buckets), dtype=np.int64)
    for kind in range(len(KINDS)):
        own = order[buckets[order] // KIND_BUCKETS == kind]
        for tier, at in enumerate(np.array_split(own, TIERS)):
            lexicon[at] = kind * TIERS + tier
    return lexicon


def fit_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
                 label: str = "toxic", sample_rows: int = SAMPLE) -> ToxicityModel:
    """The model from the labelled rows outside the held-out fold and the votes on all rows of ``docs``."""
    empty = ToxicityModel(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), {}, np.zeros((0, 0)), 0.0)
    known = agreed(labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("toxic")), "__key", "toxic")
    known = known.filter(~held_out(F.col("__key")) & F.col("toxic").isin(0, 1))
    picked = stored(known.orderBy(F.xxhash64("__key"), "__key").limit(sample_rows), "sample")
    plain = docs.select(F.col(f"`{key}`").alias("__key"), as_text(text).alias("text"))
    found = _lexicon(plain.join(F.broadcast(picked), "__key"))  # at most ``sample_rows`` numbers
    totals = {r["toxic"]: r["n"] for r in picked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not found or not totals.get(0) or not totals.get(1):
        return empty
    buckets, lexicon = np.array([r["bucket"] for r in found], dtype=np.int64), _tiers(found)
    # Votes on all rows; the annotators' labels only where they are in use.
    voted = plain.select("__key", _votes(F.col("text"), buckets, lexicon).alias("votes"))
    voted = stored(voted.join(known, "__key", "left").groupBy(
        "votes", F.coalesce(F.col("toxic") + 1, F.lit(0)).cast("long").alias("annotated")).agg(F.count(F.lit(1)).alias("n")), "votes")
    sizes = {r["annotated"]: r["n"] for r in voted.groupBy(F.col("annotated") > 0).agg(F.sum("n")).toDF("annotated", "n").collect()}
    label_model = fit_label_model(_total_of(voted), sizes.get(True, 0), sum(sizes.values()))

    def places(texts: pa.Array) -> pa.Array:
        rows = [(n, p, sum(v << (2 * i) for i, v in enumerate(_vote_list(n, p, data, lexicon))))
                for n, p, data in _hits_of(texts, buckets)]
        return pa.StructArray.from_arrays(
            [pa.array([int(n) for n, _, _ in rows], pa.int64()), pa.array([len(p) for _, p, _ in rows], pa.int64()),
             pa.array([np.unique(p) for _, p, _ in rows], pa.list_(pa.int32())), pa.array([v for *_, v in rows], pa.int64())],
            ["n", "hits", "places", "votes"])

    # A row has at most LEXICON_SIZE places, and there are at most ``sample_rows`` rows.
    hashed = plain.select(F.xxhash64("__key", "text").alias("h"), "text")
    last = hashed.select("h").orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    rows = (hashed.filter(F.col("h") <= last)  # their texts stay where they are
            .select("h", F.arrow_udf(places, "n long, hits long, places array<int>, votes long")("text").alias("p"))
            .dropDuplicates(["h"]).select("h", "p.*").collect())
    rows.sort(key=lambda r: r["h"])
    posterior = label_model.posterior(_unpacked(np.array([r["votes"] for r in rows], dtype=np.int64)))
    weights = _train(rows, posterior, len(buckets))
    return ToxicityModel(buckets, lexicon, weights,
                         {v: (float(label_model.rate[0, j, 1]), float(label_model.rate[1, j, 2])) for j, v in enumerate(VOTERS)},
                         label_model.link, label_model.share)


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, text: str = "text",
                   key: str = "doc_id") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    out = docs.select(F.col(f"`{key}`").alias("doc_id"), held_out(F.col(f"`{key}`")).alias("held_out"),
                      toxicity_score(as_text(text), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def remove_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with their columns."""
    model = fit_toxicity(docs, labels, text=text, **options)
    name = own_name("score")
    return docs.withColumn(name, toxicity_score(as_text(text), model)).filter(F.col(name) < threshold).drop(name)
