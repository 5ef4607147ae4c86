"""Operator 10: documents linked by the Jaccard similarity of their word shingles, by token-combination prefixes.

A document's set holds its distinct shingles (hashes of ``size`` consecutive words, A-Z lower-cased; with
fewer words the whole sequence as one). Documents with equal sets are one *node*. The work per node:

1. ``nodes``: one pass over the texts gives each document its set's size and its node.
2. ``_postings``: shingles travel to buckets of their hash, packed into binary columns, so one row carries
   thousands, in 7 bytes each and 9 for each node that a bucket meets. A bucket knows which nodes have a shingle and how many (its frequency), and sends back only
   shingles of two nodes or more. Shingles that are frequent already within one task's share of the texts
   (``_frequent``) are known to all tasks and don't travel, so no bucket gets a hot list.
3. ``_prefixes``: shingles are ordered from rare to frequent; those of a single node come first. Two sets
   with similarity t share all but ``n - ceil(t n)`` shingles of either. Rare shingles (frequency up to
   ``RARE``) form class 1 and are indexed alone. Frequent ones are dealt by hash into classes of pairs: a
   class of which the prefix holds m shingles is indexed by its m(m-1)/2 combinations of two, and one of its
   shingles counts as no evidence. The prefix is extended until single shingles plus (m - 1) of each pair
   class exceed the possible mismatches; so two similar sets share a combination. A node whose prefix has
   only shingles of its own is linked with nothing and leaves here; most texts do.
4. Nodes that share a combination are candidates. First each is verified against one centre of the
   combination's nodes, the one with the smallest share of own shingles, then against its neighbours of
   other components in a hash order of the nodes; verified links are contracted to components. Then only
   pairs in different components that share a combination are left; a parity sketch, whose Hamming
   distance is a lower bound of the symmetric difference, drops hopeless ones, and the rest are verified by their
   sets. Every pair that could be linked is thus verified or already joined by links.

Verification is exact: ``100 * intersection >= percent * union`` on 64-bit shingle hashes.

Defined results: texts that are null, empty or without words have an empty set and no links. Repeated rows
stay repeated. A null ``doc_id`` takes part in links; a component whose ids are all null has a null id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludolake.llm.bloom import without
from ludolake.llm.common import as_text, stored
from ludolake.llm.wordhash import mix, windows, words

FLUSH = 1_000_000        # shingles packed at once by a task
PER_BUCKET = 1_000_000   # shingles a bucket gets on average
FREQUENT_SHARE = 0.005   # of a task's documents, from which a shingle counts as frequent there
MOST_FREQUENT = 1 << 16  # frequent shingles known to all tasks: 1 MB
RARE = 64                # frequency up to which a shingle is indexed alone
GROUP_BYTES = 16 << 20   # of sets that one verification group holds
LEAST_BUCKET_BITS = 8    # of the number of buckets; so many bits of a shingle need not travel
BLOCK_NODES = 512        # of one combination that are compared in one group
CELL_ROWS = 128          # of small combinations that share a group, on average
NEIGHBOURS = 1           # that a node meets in the hash order of a combination; it has many combinations



def document_sets(texts: pa.Array, size: int):
    """For each row of a column, in order: the sorted distinct shingle hashes."""
    for own in words(texts, fold=True):
        spans = windows(own.hashes, size)
        for b, e in zip(own.bounds[:-1].tolist(), own.bounds[1:].tolist()):
            if e - b >= size:
                yield np.unique(spans[b:e - size + 1])
            elif e > b:
                yield windows(own.hashes[b:e], e - b) ^ np.uint64(e - b)
            else:
                yield np.zeros(0, np.uint64)


def node_of(shingles: np.ndarray) -> int:
    """64-bit hash of a set, as a signed number."""
    if not len(shingles):
        return 0
    total = np.array([mix(shingles).sum(dtype=np.uint64)]) + np.uint64(len(shingles))
    return int(mix(total).view(np.int64)[0])


def _packed(values, kind) -> bytes:
    return np.ascontiguousarray(values, dtype=kind).tobytes()


def _frequent_of(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in many of these sets, and in how many."""
    if not sets:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    shingles, counts = np.unique(np.concatenate(sets), return_counts=True)
    many = counts >= max(32, int(FREQUENT_SHARE * len(sets)))
    return shingles[many], counts[many]


_NODES = "doc_id long, n_shingles long, node long, frequent array<long>, seen array<long>"


def nodes(docs: DataFrame, size: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per document its set's size and node (0 for the empty set); rows without node list a task's frequent shingles."""
    def read(batches):
        sets, known, total = [], set(), 0

        def flush():
            shingles, counts = _frequent_of(sets)
            return pa.RecordBatch.from_arrays(
                [pa.array([None], pa.int64())] * 3 +
                [pa.array([shingles.view(np.int64)], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "node", "frequent", "seen"])

        for batch in batches:
            sizes, ids = [], []
            for own in document_sets(batch.column(1), size):
                node = node_of(own)
                sizes.append(len(own))
                ids.append(node)
                if node not in known and len(own):
                    known.add(node)
                    sets.append(own)
                    total += len(own)
                if total > FLUSH:
                    yield flush()
                    sets, known, total = [], set(), 0
            empty = pa.nulls(len(ids), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), empty, empty],
                names=["doc_id", "n_shingles", "node", "frequent", "seen"])
        if sets:
            yield flush()

    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), as_text(text).alias("text")).mapInArrow(read, _NODES)


def _frequent(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that some task found frequent, sorted, and the rank of each: at most ``MOST_FREQUENT``."""
    rows = (found.filter("node is null").select(F.arrays_zip("frequent", "seen").alias("z")).select(F.inline("z"))
            .groupBy("frequent").agg(F.sum("seen").alias("seen"))
            .orderBy(F.col("seen").desc(), "frequent").limit(MOST_FREQUENT).collect())
    shingles = np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64)
    counts = np.array([r[1] for r in rows], dtype=np.int64)
    order = np.argsort(shingles)
    return shingles[order], counts[order]


def _known(shingles: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Place of each shingle in the sorted table, or -1."""
    if not len(table):
        return np.full(len(shingles), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(table, shingles), len(table) - 1)
    return np.where(table[at] == shingles, at, -1)


def _buckets(total: int) -> int:
    """A power of two, so that a bucket gets ``PER_BUCKET`` of ``total`` shingles or fewer on average."""
    return 1 << max(LEAST_BUCKET_BITS, int(np.ceil(np.log2(max(1, total / PER_BUCKET)))))


_PACKED = "part int, nodes binary, counts binary, shingles binary, seen binary"
_PACKED_NAMES = ["part", "nodes", "counts", "shingles", "seen"]
_KINDS = (pa.int32(), *[pa.binary()] * 4)


def _pack(node, shingle, part, parts: int, seen=None):
    """Rows of ``_PACKED``: entries grouped by part, then by node, in runs of up to 255 entries.

    A run is 8 bytes of node and 1 of length. Without ``seen`` the part is the shingle's own bucket, whose number
    gives the top ``LEAST_BUCKET_BITS`` bits, and an entry is the other 7 bytes; with it, an entry has 8 bytes and 4 of frequency.
    """
    order = np.lexsort((shingle, node, part))
    node, shingle, part = node[order], shingle[order], part[order]
    seen = seen[order] if seen is not None else None
    cuts = np.searchsorted(part, np.arange(parts + 1))
    raw = shingle.astype("<u8").view(np.uint8).reshape(-1, 8)
    rows = []
    for p in np.flatnonzero(np.diff(cuts)):
        b, e = cuts[p], cuts[p + 1]
        fresh = np.r_[True, node[b + 1:e] != node[b:e - 1]]
        at = np.arange(e - b)
        since = at - np.maximum.accumulate(np.where(fresh, at, 0))
        first = np.flatnonzero(since % 255 == 0)
        rows.append((int(p), _packed(node[b:e][first], np.int64), _packed(np.diff(np.r_[first, e - b]), np.uint8),
                     raw[b:e, :7 if seen is None else 8].tobytes(),
                     _packed(seen[b:e], np.int32) if seen is not None else None))
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _KINDS)], names=_PACKED_NAMES) if rows else None


def _unpack(t: pa.Table, buckets: int | None = None):
    """Entry columns (node, shingle, seen) of packed rows; with ``buckets``, rows of one bucket, without frequencies."""
    def flat(name, kind):
        return np.concatenate([np.frombuffer(x, dtype=kind) for x in t[name].to_pylist()] or [np.zeros(0, kind)])

    counts = flat("counts", np.uint8)
    node = np.repeat(flat("nodes", np.int64), counts)
    if buckets is None:
        return node, flat("shingles", np.uint64), flat("seen", np.int32).astype(np.int64)
    raw = np.zeros((len(node), 8), np.uint8)
    raw[:, :7] = flat("shingles", np.uint8).reshape(-1, 7)
    part = t["part"][0].as_py() if len(t) else 0
    raw[:, 7] = part >> (buckets.bit_length() - 1 - LEAST_BUCKET_BITS)
    return node, raw.view("<u8").ravel(), None


def _bucket_of(shingle: np.ndarray, buckets: int) -> np.ndarray:
    return (shingle >> np.uint64(64 - buckets.bit_length() + 1)).astype(np.int64)


def _node_part(node: np.ndarray, parts: int) -> np.ndarray:
    return (mix(node.view(np.uint64)) & np.uint64(parts - 1)).astype(np.int64)


def _spread(docs: DataFrame, frequent, size: int, buckets: int, text: str, rare: bool) -> DataFrame:
    """Packed (node, shingle) entries: the others by bucket if ``rare``, else the frequent ones by node."""
    table, counts = frequent

    def read(batches):
        parts, known, total = [], set(), 0

        def flush():
            node = np.repeat(np.array([p[0] for p in parts], np.int64), [len(p[1]) for p in parts])
            shingle = np.concatenate([p[1] for p in parts])
            if rare:
                return _pack(node, shingle, _bucket_of(shingle, buckets), buckets)
            seen = counts[_known(shingle, table)]
            return _pack(node, shingle, _node_part(node, buckets), buckets, np.minimum(seen, 1 << 30))

        for batch in batches:
            for own in document_sets(batch.column(0), size):
                node = node_of(own)
                if not len(own) or node in known:
                    continue
                at = _known(own, table)
                mine = own[at < 0] if rare else own[at >= 0]
                if len(mine):
                    known.add(node)
                    parts.append((node, mine))
                    total += len(mine)
                if total > FLUSH:
                    yield flush()
                    parts, known, total = [], set(), 0
        if parts:
            yield flush()

    return docs.select(as_text(text).alias("text")).mapInArrow(read, _PACKED)


def _postings(packed: DataFrame, buckets: int) -> DataFrame:
    """Per bucket the shingles of two nodes or more, sent on to the parts of their nodes with their frequency."""
    def count(t: pa.Table) -> pa.Table:
        node, shingle, _ = _unpack(t, buckets)
        order = np.lexsort((node, shingle))
        node, shingle = node[order], shingle[order]
        once = np.r_[True, (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1])][:len(node)]
        node, shingle = node[once], shingle[once]
        first = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]][:len(node)])
        seen = np.diff(np.r_[first, len(node)])
        seen = np.repeat(seen, seen)
        many = seen > 1
        out = _pack(node[many], shingle[many], _node_part(node[many], buckets), buckets, seen[many])
        return pa.Table.from_batches([out] if out is not None else [], schema=pa.schema(list(zip(_PACKED_NAMES, _KINDS))))

    return packed.groupBy("part").applyInArrow(count, _PACKED)


def _sizes(own: DataFrame, buckets: int) -> DataFrame:
    """(node_part, size_of, n): the sets' sizes at the parts of their nodes."""
    def read(batches):
        for batch in batches:
            part = _node_part(batch.column(0).to_numpy(), buckets) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), batch.column(0), batch.column(1)],
                                             names=["node_part", "size_of", "n"])

    distinct = own.filter("n_shingles > 0").select("node", "n_shingles").distinct()
    return distinct.mapInArrow(read, "node_part int, size_of long, n long")


def _allowed(size: int, percent: int) -> int:
    """Shingles of a set of this size that a similar set may lack."""
    return size - -(-size * percent // 100)


def _pair_classes(size: int) -> int:
    """Number of pair classes for sets of this size: a power of two, one for about twenty shingles."""
    return 1 << max(0, (size // 20).bit_length())


def prefix_combinations(size: int, shingles: np.ndarray, seen: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of the combinations that index a set, given its shingles that other sets have too, in any order.

    Sets of similar size may have different numbers of pair classes; each is indexed under all numbers
    that a partner can have, so the two always share one. From 60 percent on, a set that can have a
    partner has shingles enough for the evidence, as ``ceil(t n) - 1`` is at least the number of classes.
    """
    if 100 * size < percent * (size + 1):
        return np.zeros(0, np.uint64)  # only an equal set is similar
    order = np.lexsort((shingles, seen))
    shingles, seen = shingles[order], seen[order]
    need = _allowed(size, percent) + 1 - (size - len(shingles))
    if need <= 0:
        return np.zeros(0, np.uint64)
    single = int(np.searchsorted(seen, RARE, side="right"))
    if need <= single:
        return mix(shingles[:need])
    out = [mix(shingles[:single])]
    rest, short = shingles[single:], need - single
    for classes in sorted({_pair_classes(size), _pair_classes(size * 100 // percent),
                           _pair_classes(-(-size * percent // 100))}):
        own = (mix(rest ^ np.uint64(0x5BD1E995)) & np.uint64(classes - 1)).astype(np.int64)
        by_class = np.argsort(own, kind="stable")
        new = np.ones(len(rest), dtype=bool)
        new[by_class[np.r_[True, own[by_class][1:] != own[by_class][:-1]]]] = False
        end = int(np.searchsorted(np.cumsum(new), short)) + 1
        tag = np.uint64(classes) * np.uint64(0x9E3779B9)
        for c in np.unique(own[:end]):
            a = np.sort(rest[:end][own[:end] == c])
            i, j = np.triu_indices(len(a), 1)
            out.append(mix(mix(a[i] + tag) + a[j]))
    return np.unique(np.concatenate(out))


def _sketch(size: int, shingles: np.ndarray) -> bytes:
    """Parity bits of the shingles; once or twice as many bits as the set has members, a power of two."""
    bits = 1 << max(6, size.bit_length())
    at = (mix(shingles) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


_INDEXED = "node long, n long, own long, shared binary, sketch binary, combinations array<long>"


def _prefixes(entries: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Indexed nodes: size, number of shingles of their own, the shared shingles, sketch and combinations."""
    def build(t: pa.Table, known: pa.Table) -> pa.Table:
        node, shingle, seen = _unpack(t)
        order = np.lexsort((shingle, node))
        node, shingle, seen = node[order], shingle[order], seen[order]
        once = np.r_[True, (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1])][:len(node)]
        node, shingle, seen = node[once], shingle[once], seen[once]
        first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]][:len(node)])
        names_of, n_of = known["size_of"].to_numpy(), known["n"].to_numpy()
        by_name = np.argsort(names_of)
        size = n_of[by_name][np.searchsorted(names_of[by_name], node[first])]
        rows = []
        for n, b, e in zip(size.tolist(), first.tolist(), [*first[1:].tolist(), len(node)]):
            if n - (e - b) > _allowed(n, percent):
                continue
            found = prefix_combinations(n, shingle[b:e], seen[b:e], percent)
            if len(found):
                rows.append((int(node[b]), n, n - (e - b), _packed(shingle[b:e], np.uint64),
                             _sketch(n, shingle[b:e]), found.view(np.int64)))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        names = ["node", "n", "own", "shared", "sketch", "combinations"]
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return entries.groupBy("part").cogroup(sizes.groupBy("node_part")).applyInArrow(build, _INDEXED)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The distinct ``pairs`` (a, b) that are similar.

    A set ``a`` that meets many others is copied to as many cells as their sets need, so no cell grows
    with the number of partners of one set.
    """
    pairs = stored(pairs, "pairs")
    small = sets.select("node", F.octet_length("shared").alias("bytes"))
    load = stored(pairs.join(small.withColumnRenamed("node", "b"), "b").groupBy("a")
                  .agg((F.floor(F.sum("bytes") / GROUP_BYTES) + 1).cast("int").alias("salts"),
                       F.sum("bytes").alias("bytes")), "load")
    total = load.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("salts"), F.lit(0))).first()
    cells = max(12, int(2 * total[0] / GROUP_BYTES) + 1)

    def cell(a, salt):
        return F.pmod(F.xxhash64(a, salt), F.lit(cells)).cast("int").alias("cell")

    full = sets.select("node", "n", "shared")
    centres = (full.join(load, F.col("node") == F.col("a"))
               .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
               .select(cell("a", "salt"), "a", F.lit(None).cast("long").alias("b"), "n", "shared"))
    members = (pairs.join(load, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
               .select(cell("a", "salt"), "a", "b").join(full.withColumnRenamed("node", "b"), "b")
               .select("cell", "a", "b", "n", "shared"))

    def compare(t: pa.Table) -> pa.Table:
        a, b, n = (t[c].to_pylist() for c in ("a", "b", "n"))
        sets_here = [np.frombuffer(x, dtype=np.uint64) for x in t["shared"].to_pylist()]
        at = {x: i for i, x in enumerate(a) if b[i] is None}
        hits = []
        for i, other in enumerate(b):
            if other is not None:
                c = at[a[i]]
                both = len(np.intersect1d(sets_here[c], sets_here[i], assume_unique=True))
                if 100 * both >= percent * (n[c] + n[i] - both):
                    hits.append((a[i], other))
        return pa.table({"a": pa.array([h[0] for h in hits], pa.int64()),
                         "b": pa.array([h[1] for h in hits], pa.int64())})

    return centres.unionByName(members).groupBy("cell").applyInArrow(compare, "a long, b long")


def _sizes_fit(m, n, percent: int):
    return (m * 100 >= n * percent) & (n * 100 >= m * percent)


def _central_pairs(indexed: DataFrame, percent: int) -> DataFrame:
    """(a, b): each node with the centre of each of its combinations, where their sizes allow a link."""
    rows = indexed.select("node", "n", (F.col("own") / F.col("n")).alias("share"),
                          F.explode("combinations").alias("combination"))
    centres = (rows.groupBy("combination").agg(F.min(F.struct("share", "node", "n")).alias("centre"),
                                               F.count(F.lit(1)).alias("many")).filter("many > 1"))
    return (rows.join(centres, "combination").filter(F.col("node") != F.col("centre.node"))
            .filter(_sizes_fit(F.col("n"), F.col("centre.n"), percent))
            .select(F.col("centre.node").alias("a"), F.col("node").alias("b")).distinct())


def _partly_joined(indexed: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label): nodes with one label are joined by links; the reverse need not hold."""
    best = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label"))
    up = stored(indexed.select("node").join(best, "node", "left")
                .select("node", F.least("node", "label").alias("label")), "label")
    return (up.join(up.select(F.col("node").alias("label"), F.col("label").alias("next")), "label", "left")
            .select("node", F.coalesce("next", "label").alias("label")))


def _open_rows(indexed: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """Nodes of the combinations that still hold several labels, one row for each node and combination, and how many.

    A combination of two nodes is settled by its central pair. One with more than ``BLOCK_NODES`` nodes says
    in how many blocks it is to be worked on.
    """
    rows = (indexed.join(labels, "node")
            .select("node", "n", "own", "sketch", "label", F.explode("combinations").alias("combination")))
    open_ = stored(rows.groupBy("combination").agg(F.min("label").alias("least"), F.max("label").alias("most"),
                                                   F.count(F.lit(1)).alias("many"))
                   .filter("least <> most and many > 2")
                   .select("combination", "many", (F.floor(F.col("many") / BLOCK_NODES) + 1).cast("int").alias("blocks")), "open")
    total = open_.agg(F.coalesce(F.sum("many"), F.lit(0))).first()[0]
    return rows.join(open_.drop("many"), "combination"), total


def _near_pairs(indexed: DataFrame, labels: DataFrame, percent: int, ring: bool) -> DataFrame:
    """(a, b): pairs of an open combination that differ in label and may be similar by size and sketch.

    With ``ring`` each node meets the next ``NEIGHBOURS`` of a hash order of the combination's nodes (of each
    block, where there are several), so pairs are as many as rows; a large group of sets that are similar, but not all
    to one centre, hangs together by them. Otherwise each node meets all others, block by block. Combinations of
    one block share as many groups as their rows fill; two blocks that meet are a group of their own.
    """
    rows, total = _open_rows(indexed, labels)
    cells = max(12, total // CELL_ROWS + 1)
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.array("mine") if ring else F.sequence(F.lit(0), F.col("blocks") - 1)
    rows = rows.withColumn("other", F.explode(other))
    cell = F.when(F.col("blocks") == 1, F.pmod("combination", F.lit(cells))).otherwise(
        F.xxhash64("combination", F.least("mine", "other"), F.greatest("mine", "other")))
    rows = rows.withColumn("cell", cell).withColumn("crossed", F.col("mine") != F.col("other"))

    def compare(t: pa.Table) -> pa.Table:
        combination, node, n, own, label, mine = (
            t[c].to_numpy() for c in ("combination", "node", "n", "own", "label", "mine"))
        crossed = t["crossed"].to_numpy(zero_copy_only=False)
        bits = [np.frombuffer(x, np.uint64) for x in t["sketch"].to_pylist()]
        turn = mix(mix(node.view(np.uint64)) ^ combination.view(np.uint64))
        order, pairs = np.lexsort((turn, combination)), set()
        first = np.flatnonzero(np.r_[True, np.diff(combination[order]) != 0][:len(order)])

        def meet(i: int, others: np.ndarray, folded: np.ndarray, own_bits: np.ndarray) -> None:
            apart = np.bitwise_count(folded ^ own_bits).sum(axis=1, dtype=np.int64) + own[i] + own[others]
            near = (100 + percent) * apart <= (100 - percent) * (n[i] + n[others])
            pairs.update((min(int(node[i]), x), max(int(node[i]), x)) for x in node[others[near]].tolist())

        def fold(i: int, width: int) -> np.ndarray:
            return np.bitwise_xor.reduce(bits[i].reshape(-1, width), axis=0)

        def fitting(i: int, others: np.ndarray) -> np.ndarray:
            return ((label[others] != label[i]) & (100 * n[others] >= percent * n[i])
                    & (100 * n[i] >= percent * n[others]) & (~crossed[i] | (mine[others] != mine[i])))

        for group in np.split(order, first[1:]):
            if ring:
                for step in range(1, min(NEIGHBOURS, len(group) - 1) + 1):
                    for i, o in zip(group, np.roll(group, -step)):
                        if fitting(i, np.array([o]))[0]:
                            width = min(len(bits[i]), len(bits[o]))
                            meet(i, np.array([o]), fold(o, width)[None], fold(i, width))
                continue
            for width in {len(bits[i]) for i in group}:
                wide = np.array([i for i in group if len(bits[i]) >= width])
                folded = np.stack([fold(i, width) for i in wide])
                for k, i in enumerate(wide):
                    if len(bits[i]) == width:
                        at = np.flatnonzero(fitting(i, wide))
                        if len(at):
                            meet(i, wide[at], folded[at], folded[k])
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()),
                         "b": pa.array([p[1] for p in pairs], pa.int64())})

    columns = ["cell", "combination", "node", "n", "own", "label", "mine", "crossed", "sketch"]
    return rows.select(*columns).groupBy("cell").applyInArrow(compare, "a long, b long").distinct()


def _contracted(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after joining those that ``links`` (a, b) connect."""
    edges = links
    for side in ("a", "b"):
        edges = edges.join(labels.withColumnRenamed("node", side), side).drop(side).withColumnRenamed("label", side)
    joined = components(edges.select("a", "b"))
    return stored(labels.join(joined.withColumnRenamed("node", "label"), "label", "left")
                  .select("node", F.coalesce("component", "label").alias("label")), "labels")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b), for nodes with an edge.

    Large-star and small-star steps by turns; every step is written to the shared folder.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(edges.join(least, "u").filter("v = m").select("u", "v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = stored(large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*").filter("u <> v").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = now


def link_documents(docs: DataFrame, size: int = 4, percent: int = 85, text: str = "text",
                   key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id reachable over links)."""
    if not 60 <= percent <= 100:
        raise ValueError("percent must be from 60 to 100")
    found = stored(nodes(docs, size, text, key), "nodes")
    own = found.filter("node is not null").select("doc_id", "n_shingles", "node")
    total = own.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    buckets, frequent = _buckets(total), _frequent(found)
    shared = _postings(_spread(docs, frequent, size, buckets, text, rare=True), buckets)
    if len(frequent[0]):
        shared = shared.unionByName(_spread(docs, (frequent[0], np.maximum(frequent[1], RARE + 1)),
                                            size, buckets, text, rare=False))
    indexed = stored(_prefixes(shared, _sizes(own, buckets), percent), "indexed")
    links = stored(_verified(_central_pairs(indexed, percent), indexed, percent), "links")
    labels = stored(_partly_joined(indexed, links), "labels")
    ring = _verified(_near_pairs(indexed, labels, percent, ring=True), indexed, percent)
    labels = _contracted(labels, links.unionByName(ring))
    late = stored(_verified(_near_pairs(indexed, labels, percent, ring=False), indexed, percent), "late")
    if late.limit(1).collect():
        labels = _contracted(labels, late)
    joined = labels.withColumnRenamed("label", "component")
    group = F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")).otherwise(F.xxhash64("doc_id", F.lit("empty")))
    own = own.join(joined, "node", "left").select("doc_id", "n_shingles", group.alias("group"))
    least = stored(own.filter("n_shingles > 0").groupBy("group").agg(F.min("doc_id").alias("least")), "least")
    return own.join(least, "group", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
        .alias("component_id"))


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """One row of each group of linked documents, that with the smallest ``doc_id``, with its columns.

    Rows without words are linked with nothing and all stay, and so do rows with a null id. Rows with the same
    id are one document, of which the first by text stays if it has words. Only ids are joined with the texts, and only texts
    that may go travel.
    """
    id_ = F.col(f"`{key}`").cast("long")
    linked = stored(link_documents(docs.filter(id_.isNotNull()), text=text, key=key, **options).filter("n_shingles > 0"), "linked")
    kept = without(docs, id_, linked.filter("doc_id <> component_id").select("doc_id").distinct())
    again = stored(linked.filter("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("many"))
                   .filter("many > 1").select(F.col("doc_id").alias("__again")), "again")
    if not again.limit(1).collect():
        return kept
    order = Window.partitionBy(id_).orderBy(as_text(text).desc(), *[F.col(f"`{c}`").cast("string") for c in docs.columns])
    first = (kept.join(again, id_ == F.col("__again"), "left_semi").withColumn("__nth", F.row_number().over(order))
             .filter("__nth = 1").drop("__nth"))
    return kept.join(again, id_ == F.col("__again"), "left_anti").unionByName(first)


#: The same by brute force: all pairs that share a shingle, and paths over the links.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
      ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingle FROM w),
n AS (SELECT w.doc_id, count(s.shingle) AS n_shingles FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
      GROUP BY ALL),
links AS (SELECT x, y FROM p JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id
          WHERE 100 * shared >= 85 * (a.n_shingles + b.n_shingles - shared)),
reach AS (SELECT doc_id, doc_id AS other FROM n UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.other = l.x)
SELECT n.doc_id, n.n_shingles, min(reach.other) AS component_id
FROM n JOIN reach ON n.doc_id = reach.doc_id GROUP BY n.doc_id, n.n_shingles
"""
