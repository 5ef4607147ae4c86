"""Operator 1: masked pseudo-likelihood of documents by a bidirectional window network.

1. *Vocabulary.* All words of all documents are counted, without a limit; the most frequent get an id each, and
   the others are dealt by hash to ``OTHERS`` classes, each with an id.
2. *Network.* Each word is masked and predicted from the two words on either side: their embeddings, one
   table for each position, are summed and passed through tanh; the output is a softmax over groups of ids
   and one over the ids of the group. It is trained in numpy by mini-batches: each task trains a copy on its part of
   a round's documents, the copies are averaged by their words, and the next round goes on from there. Every
   document is used in one round.
3. *Score.* The conditional log-probabilities of all words of a text, given both sides, are summed. That of a word
   of a class is the class's, by the network, plus the logarithm of the word's share in the class, by the counts
   (``log_shares``). So the probabilities of all words, and of meeting one not yet seen, sum to 1.

The network (some 170 kB), the words with an id of their own and two sums a class travel through the driver; all have a
fixed size. The counts of all words stay in ``COUNT_PARTS`` parts by hash. Words to be looked up travel there packed,
once for each group of texts, and their shares travel back.

Defined results: null and empty texts have 0 words, log-likelihood 0 and a null mean. Words beyond a
text's ends count as a mark of their own. Repeated rows score alike. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludolake.llm.common import as_text, fold_of, stored
from ludolake.llm.wordhash import mix, words

GROUPS = 32
SIZE = GROUPS * GROUPS      # ids
OTHERS = 64                 # ids of classes, for words without one of their own
EDGE = SIZE                 # id of positions beyond a text
WIDTH = 8                   # of an embedding
REACH = (-2, -1, 1, 2)
BATCH = 8192
ROUNDS = 2
RATE = 0.5
SLICES = 16                 # of the network, averaged apart
FLUSH = 2_000_000           # words counted at once by a task
COUNT_PARTS = 256

_SHAPES = {"embed": (len(REACH), SIZE + 1, WIDTH), "outer": (WIDTH, GROUPS), "outer_bias": (GROUPS,),
           "inner": (GROUPS, WIDTH, GROUPS), "inner_bias": (GROUPS, GROUPS)}


def _part_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(COUNT_PARTS - 1)).astype(np.int64)


def _word_counts(docs: DataFrame) -> DataFrame:
    """(part, hashes, counts): packed counts of words by task, dealt by hash."""
    def read(batches):
        held, total = [], 0

        def flush():
            found, many = np.unique(np.concatenate(held), return_counts=True)
            part = _part_of(found)
            order = np.argsort(part, kind="stable")
            found, many, cuts = found[order], many[order], np.searchsorted(part[order], np.arange(COUNT_PARTS + 1))
            spans = [(p, slice(cuts[p], cuts[p + 1])) for p in range(COUNT_PARTS) if cuts[p + 1] > cuts[p]]
            return pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in spans], pa.int32()), pa.array([found[s].tobytes() for _, s in spans], pa.binary()),
                 pa.array([many[s].astype(np.int32).tobytes() for _, s in spans], pa.binary())], names=["part", "hashes", "counts"])

        for batch in batches:
            for own in words(batch.column(0), fold=True):
                held.append(own.hashes)
                total += len(own.hashes)
                if total >= FLUSH:
                    yield flush()
                    held, total = [], 0
        if total:
            yield flush()

    return docs.select("text").mapInArrow(read, "part int, hashes binary, counts binary")


def count_words(docs: DataFrame) -> DataFrame:
    """(part, hashes, counts): every word of all documents with its number, a row for each part, ascending hashes."""
    def add(t: pa.Table) -> pa.Table:
        hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in t["hashes"].to_pylist()])
        counts = np.concatenate([np.frombuffer(x, np.int32) for x in t["counts"].to_pylist()]).astype(np.int64)
        order = np.argsort(hashes, kind="stable")
        hashes, counts = hashes[order], counts[order]
        first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
        return pa.table({"part": pa.array([t["part"][0].as_py()], pa.int32()), "hashes": pa.array([hashes[first].tobytes()], pa.binary()),
                         "counts": pa.array([np.add.reduceat(counts, first).tobytes()], pa.binary())})

    return stored(_word_counts(docs).groupBy("part").applyInArrow(add, "part int, hashes binary, counts binary"), "words")


def _parts_of(batches):
    for batch in batches:
        for hashes, counts in zip(batch.column("hashes"), batch.column("counts")):
            yield np.frombuffer(hashes.as_py(), np.uint64), np.frombuffer(counts.as_py(), np.int64)


def frequent_words(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words that get an id of their own, most frequent first, and their counts."""
    def most(batches):
        for hashes, counts in _parts_of(batches):
            top = np.argsort(-counts, kind="stable")[:SIZE - OTHERS]
            yield pa.RecordBatch.from_arrays([pa.array(hashes[top].view(np.int64)), pa.array(counts[top])], names=["hash", "many"])

    rows = counted.mapInArrow(most, "hash long, many long").orderBy(F.col("many").desc(), "hash").limit(SIZE - OTHERS).collect()
    return (np.array([r["hash"] for r in rows], dtype=np.int64).view(np.uint64),
            np.array([r["many"] for r in rows], dtype=np.int64))


def class_sums(counted: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """(2, class): number of words, and of different words, in each class."""
    def add(batches):
        for hashes, counts in _parts_of(batches):
            own = vocabulary(hashes) - (SIZE - OTHERS)
            rare = own >= 0
            many = np.zeros(OTHERS, np.int64)
            np.add.at(many, own[rare], counts[rare])
            yield pa.RecordBatch.from_arrays([pa.array(range(OTHERS), pa.int32()), pa.array(many),
                                              pa.array(np.bincount(own[rare], minlength=OTHERS).astype(np.int64))],
                                             names=["class", "words", "kinds"])

    out = np.zeros((2, OTHERS), dtype=np.int64)
    for r in counted.mapInArrow(add, "class int, words long, kinds long").groupBy("class").agg(
            F.sum("words").alias("words"), F.sum("kinds").alias("kinds")).collect():
        out[:, r["class"]] = r["words"], r["kinds"]
    return out


def log_shares(ids: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Logarithm of each word's share in its class; 0 for words with an id of their own.

    Of a class with n words of k kinds, a word seen c times has c / (n + k) and all words not yet seen (count 0)
    have k / (n + k) together, as new kinds came up k times so far. All of a class without words is unseen.
    """
    own = np.maximum(ids - (SIZE - OTHERS), 0)
    many, kinds = sums[0][own], np.maximum(sums[1][own], 1)
    return np.where(ids < SIZE - OTHERS, 0.0, np.log(np.where(counts > 0, counts, kinds) / (many + kinds)))


class Vocabulary:
    """Ids of word hashes: frequent words first, then classes of the others."""

    def __init__(self, hashes: np.ndarray):
        order = np.argsort(hashes)
        self.sorted, self.ids = hashes[order], order.astype(np.int32)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        shared = (SIZE - OTHERS + (mix(hashes) & np.uint64(OTHERS - 1)).astype(np.int64)).astype(np.int32)
        if not len(self.sorted):
            return shared
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.ids[at], shared)


def start_network(counts: np.ndarray, total: int) -> dict[str, np.ndarray]:
    """Small embeddings by a fixed rule, and biases that give each word its share of all words."""
    noise = {k: (mix(np.arange(int(np.prod(s)), dtype=np.uint64) + np.uint64(len(k) << 40)) >> np.uint64(40)).astype(
        np.float32).reshape(s) / np.float32(1 << 24) - np.float32(0.5) for k, s in _SHAPES.items()}
    rest = max(0, total - int(counts.sum()))
    share = np.full(SIZE, 0.5)
    share[:len(counts)] += counts
    share[SIZE - OTHERS:] += rest / OTHERS
    share = share.reshape(GROUPS, GROUPS) / share.sum()
    return {"embed": noise["embed"] * 0.4, "outer": noise["outer"] * 0.2, "inner": noise["inner"] * 0.2,
            "outer_bias": np.log(share.sum(axis=1)).astype(np.float32),
            "inner_bias": np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)}


def _softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def _contexts(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(position, word): ids around each word; positions beyond its text are the edge."""
    n = len(ids)
    out = np.full((len(REACH), n), EDGE, dtype=np.int32)
    for k, r in enumerate(REACH):
        if abs(r) < n:
            if r < 0:
                out[k, -r:] = ids[:r]
            else:
                out[k, :-r] = ids[r:]
    for b, e in ((bounds[:-1], bounds[1:]),):
        for k, r in enumerate(REACH):
            for step in range(abs(r)):
                at = b + step if r < 0 else e - 1 - step
                out[k, at[(at >= b) & (at < e)]] = EDGE
    return out


def _hidden(net: dict, around: np.ndarray) -> np.ndarray:
    return np.tanh(sum(net["embed"][k][around[k]] for k in range(len(REACH))))


def log_probabilities(net: dict, ids: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Conditional log-probability of each word."""
    out = np.empty(len(ids), dtype=np.float64)
    for begin in range(0, len(ids), BATCH):
        t, c = ids[begin:begin + BATCH], around[:, begin:begin + BATCH]
        h = _hidden(net, c)
        group, inside = t // GROUPS, t % GROUPS
        outer = _softmax(h @ net["outer"] + net["outer_bias"])
        p = outer[np.arange(len(t)), group]
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(GROUPS + 1))
        for g in range(GROUPS):
            at = order[cuts[g]:cuts[g + 1]]
            if len(at):
                q = _softmax(h[at] @ net["inner"][g] + net["inner_bias"][g])
                p[at] *= q[np.arange(len(at)), inside[at]]
        out[begin:begin + BATCH] = np.log(np.maximum(p, 1e-12))
    return out


def train_batch(net: dict, speed: dict, t: np.ndarray, around: np.ndarray, rate: float) -> None:
    """One step on a batch, with step sizes by past gradients (Adagrad)."""
    h = _hidden(net, around)
    n = len(t)
    group, inside = t // GROUPS, t % GROUPS
    outer = _softmax(h @ net["outer"] + net["outer_bias"])
    outer[np.arange(n), group] -= 1
    grad = {"outer": h.T @ outer / n, "outer_bias": outer.mean(axis=0),
            "inner": np.zeros(_SHAPES["inner"], np.float32), "inner_bias": np.zeros(_SHAPES["inner_bias"], np.float32)}
    back = outer @ net["outer"].T
    order = np.argsort(group, kind="stable")
    cuts = np.searchsorted(group[order], np.arange(GROUPS + 1))
    for g in range(GROUPS):
        at = order[cuts[g]:cuts[g + 1]]
        if len(at):
            own = h[at]
            q = _softmax(own @ net["inner"][g] + net["inner_bias"][g])
            q[np.arange(len(at)), inside[at]] -= 1
            grad["inner"][g], grad["inner_bias"][g] = own.T @ q / n, q.sum(axis=0) / n
            back[at] += q @ net["inner"][g].T
    back *= (1 - h * h) / n
    embed = np.empty(_SHAPES["embed"], np.float32)
    for k in range(len(REACH)):
        for d in range(WIDTH):
            embed[k, :, d] = np.bincount(around[k], weights=back[:, d], minlength=SIZE + 1)
    grad["embed"] = embed
    for name, g in grad.items():
        speed[name] += g * g
        net[name] -= (rate * g / (np.sqrt(speed[name]) + 1e-3)).astype(np.float32)


def _flat(net: dict) -> np.ndarray:
    return np.concatenate([net[k].ravel() for k in _SHAPES]).astype(np.float32)


def _net(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in _SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at:at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def _averaged(copies: DataFrame) -> DataFrame:
    """(slice, weight, values) summed to one row a slice, first by 64 groups of tasks, then over all."""
    def add(t: pa.Table) -> pa.Table:
        weights = np.array(t["weight"].to_pylist(), dtype=np.float64)
        total = sum(np.frombuffer(v, np.float64) for v in t["values"].to_pylist())
        return pa.table({"slice": pa.array([t["slice"][0].as_py()], pa.int32()), "salt": pa.array([0], pa.int32()),
                         "weight": pa.array([weights.sum()]), "values": pa.array([total.tobytes()], pa.binary())})

    kind = "slice int, salt int, weight double, values binary"
    return copies.groupBy("slice", "salt").applyInArrow(add, kind).groupBy("slice").applyInArrow(add, kind)


def train_network(docs: DataFrame, net: dict, vocabulary: Vocabulary, rounds: int = ROUNDS, rate: float = RATE) -> dict:
    """The network after all rounds; ``docs`` has text and round."""
    spark = docs.sparkSession
    for number in range(rounds):
        start, step = spark.sparkContext.broadcast(_flat(net)), rate / (1 + number)

        def train(batches, start=start, step=step):
            own, speed = _net(start.value), {k: np.full(s, 1e-4, np.float32) for k, s in _SHAPES.items()}
            seen = 0
            for batch in batches:
                for group in words(batch.column(0), fold=True):
                    ids = vocabulary(group.hashes)
                    around = _contexts(ids, group.bounds)
                    # Positions are dealt to batches by stride, so each mixes many texts.
                    parts = max(1, -(-len(ids) // BATCH))
                    for p in range(parts if len(ids) else 0):
                        train_batch(own, speed, ids[p::parts], around[:, p::parts], step)
                    seen += len(ids)
            if seen:
                import hashlib

                slices = np.array_split(_flat(own).astype(np.float64) * seen, SLICES)
                salt = int(hashlib.sha256(slices[0].tobytes()).hexdigest()[:6], 16) % 64
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(SLICES), pa.int32()), pa.array([salt] * SLICES, pa.int32()),
                     pa.array([float(seen)] * SLICES), pa.array([s.tobytes() for s in slices], pa.binary())],
                    names=["slice", "salt", "weight", "values"])

        copies = docs.filter(F.col("round") == number).select("text").mapInArrow(
            train, "slice int, salt int, weight double, values binary")
        rows = {r["slice"]: r for r in _averaged(copies).collect()}
        if rows:
            net = _net(np.concatenate([np.frombuffer(rows[i]["values"], np.float64) / rows[i]["weight"] for i in range(SLICES)]))
        start.unpersist()
    return net


def _scored_groups(docs: DataFrame, net: dict, vocabulary: Vocabulary) -> DataFrame:
    """A row for each group of texts: their ids, numbers of words and sums by the network's ids; the different words of
    classes, by part, and for each such word of the texts its place among them."""
    def score(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for group in words(batch.column(1), fold=True):
                ids = vocabulary(group.hashes)
                logs = np.r_[0.0, np.cumsum(log_probabilities(net, ids, _contexts(ids, group.bounds)))]
                at = np.flatnonzero(ids >= SIZE - OTHERS)
                found, places = np.unique(group.hashes[at], return_inverse=True)
                order = np.argsort(_part_of(found), kind="stable")
                moved = np.empty(len(order), np.int32)
                moved[order] = np.arange(len(order), dtype=np.int32)
                keys, n = batch.column(0).slice(group.first, group.last - group.first), group.last - group.first
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), keys),
                     pa.array([np.diff(group.bounds).astype(np.int64).tobytes()], pa.binary()),
                     pa.array([(logs[group.bounds[1:]] - logs[group.bounds[:-1]]).tobytes()], pa.binary()),
                     pa.array([np.searchsorted(at, group.bounds).astype(np.int64).tobytes()], pa.binary()),
                     pa.array([moved[places].astype(np.int32).tobytes()], pa.binary()), pa.array([found[order].tobytes()], pa.binary())],
                    names=["group", "ids", "sizes", "sums", "bounds", "places", "hashes"])
                number += 1

    kind = T.StructType([T.StructField("group", T.LongType()), T.StructField("ids", T.ArrayType(docs.schema["doc_id"].dataType)),
                         *[T.StructField(n, T.BinaryType()) for n in ("sizes", "sums", "bounds", "places", "hashes")]])
    return stored(docs.select("doc_id", "text").mapInArrow(score, kind), "groups")


def _shares_of(groups: DataFrame, counted: DataFrame, vocabulary: Vocabulary, sums: np.ndarray) -> DataFrame:
    """(group, part, shares): ``log_shares`` of the words of each group, in their order within the part."""
    def deal(batches):
        for batch in batches:
            for group, packed in zip(batch.column("group"), batch.column("hashes")):
                hashes = np.frombuffer(packed.as_py(), np.uint64)
                cuts = np.searchsorted(_part_of(hashes), np.arange(COUNT_PARTS + 1))
                parts = [p for p in range(COUNT_PARTS) if cuts[p + 1] > cuts[p]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts, pa.int32()), pa.array([group.as_py()] * len(parts), pa.int64()),
                     pa.array([hashes[cuts[p]:cuts[p + 1]].tobytes() for p in parts], pa.binary())], names=["part", "group", "hashes"])

    def look_up(asked: pa.Table, known: pa.Table) -> pa.Table:
        hashes, counts = next(_parts_of(known.to_batches()), (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
        shares = []
        for packed in asked["hashes"]:
            own = np.frombuffer(packed.as_py(), np.uint64)
            many = np.zeros(len(own), np.int64)
            if len(hashes):
                at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                many = np.where(hashes[at] == own, counts[at], 0)
            shares.append(log_shares(vocabulary(own), many, sums).tobytes())
        return pa.table({"group": asked["group"], "part": asked["part"], "shares": pa.array(shares, pa.binary())})

    asked = groups.select("group", "hashes").mapInArrow(deal, "part int, group long, hashes binary")
    return asked.groupBy("part").cogroup(counted.groupBy("part")).applyInArrow(look_up, "group long, part int, shares binary")


def score_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", rounds: int = ROUNDS) -> DataFrame:
    """Per row: doc_id, n_words, log_likelihood (sum over the words) and mean_log_likelihood."""
    plain = docs.select(F.col(f"`{key}`").alias("doc_id"), as_text(text).alias("text"))
    plain = plain.withColumn("round", fold_of(F.xxhash64("doc_id", F.length("text")), rounds))
    counted = count_words(plain)
    frequent, counts = frequent_words(counted)
    vocabulary = Vocabulary(frequent)
    sums = class_sums(counted, vocabulary)
    net = train_network(plain, start_network(counts, int(counts.sum() + sums[0].sum())), vocabulary, rounds)
    groups = _scored_groups(plain, net, vocabulary)
    shares = _shares_of(groups, counted, vocabulary, sums)

    def add(own: pa.Table, found: pa.Table) -> pa.Table:
        parts = sorted(zip(found["part"].to_pylist(), found["shares"].to_pylist()))
        share = np.frombuffer(b"".join(s for _, s in parts), np.float64)
        sizes, logs, bounds, places = (np.frombuffer(own[n][0].as_py(), kind) for n, kind in (
            ("sizes", np.int64), ("sums", np.float64), ("bounds", np.int64), ("places", np.int32)))
        more = np.r_[0.0, np.cumsum(share[places])]
        return pa.table({"doc_id": own["ids"].combine_chunks().flatten(), "n_words": pa.array(sizes),
                         "log_likelihood": pa.array(logs + more[bounds[1:]] - more[bounds[:-1]])})

    kind = T.StructType([T.StructField("doc_id", plain.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()),
                         T.StructField("log_likelihood", T.DoubleType())])
    scored = groups.drop("hashes").groupBy("group").cogroup(shares.groupBy("group")).applyInArrow(add, kind)
    return scored.select("doc_id", "n_words", "log_likelihood", F.when(
        F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")).alias("mean_log_likelihood"))
