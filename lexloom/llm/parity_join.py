"""N-gram Jaccard join by parity sketches.

A document's set is the 64-bit hashes of its distinct word shingles.  Tokens
are dealt over the blocks of a sketch and XORed together there.  A token that
only one of two documents has changes one block, so the number of blocks that
differ, and the Hamming distance of a sketch with a bit for a token, are at
most the size of the symmetric difference, and a link bounds that:

    J >= p / q   <=>   |A - B| + |B - A| <= (q - p) (|A| + |B|) / (q + p) = D

Candidates.  Sets are compared within bands of size; a band fixes the number
of blocks n > D.  At least n - D blocks of linked sets agree, with all their
tokens.  Each set joins on its D + 1 blocks of most tokens: whichever order
blocks have, the top one of those that agree is among the D + 1 of both sides.
So no link is lost, and blocks that few tokens, and so many sets, share stay
out.  Equal keys give edges to the least document of the key, not pairs.

Verification.  Connected candidates form clusters that no link leaves.  A
cluster that fits a task, by its sets' number and bytes, is searched there.  A
larger one is dealt over tasks by hash, and each searches its part.  Of what is
linked by then one set each goes on to a next round, dealt anew, until rounds
find little more.  So a large group of near copies costs about its size.  What
may still be linked are sets that share a key and aren't of one class: those
clusters are searched whole, cut into chunks, each pair of chunks a task.  A
task compares bit sketches, then sets, and returns a spanning forest of the
links it finds, not all links.  The components of those forests are the classes.
Sets that are equal are one from the start.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, discard, made, stored, tidy
from .components import components
from .tokens import SPACES, Words, groups, mix

#: Documents of a cluster that one side of a task has, and bytes of their sets; and the share of
#: them that a task has of a larger cluster.
CHUNK, CHUNK_BYTES, PARTS = 1024, 1 << 24, 4
#: Documents of a side where all pairs of a cluster's chunks are compared: each set goes to as many tasks as there are chunks.
PAIRED = 2048
#: Nodes of large clusters up to which their ids (8 bytes each) are broadcast; more are joined by shuffle.
BROADCAST = 1 << 20
#: Keys of a task that are combined at a time before they are dealt out.
COMBINED = 1 << 19
#: Words of 64 bits of the sketch that verification looks at first.
SKETCH = 32
_STEP = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Link:
    """Shingles of ``words`` words; a link is a Jaccard similarity of ``p / q`` or more."""

    words: int = 4
    p: int = 85
    q: int = 100

    def distance(self, a: int, b: int) -> int:
        """The greatest symmetric difference of linked sets of sizes ``a`` and ``b``."""
        return (self.q - self.p) * (a + b) // (self.q + self.p)

    def bands(self, size: int) -> list[tuple[int, int]]:
        """(band, blocks to join on) of a set: one for each band that a partner of
        its size or less may be the smaller side in, and its own."""
        low = -(-self.p * size // self.q)
        out = []
        for k in range(band_of(low), band_of(size) + 1):
            begin, end = band_bounds(k)
            # as the larger side, with the largest partner in the band ...
            d = self.distance(min(size, end - 1), size)
            if begin <= size < end:  # ... or as the smaller one
                d = max(d, self.distance(size, size * self.q // self.p))
            out.append((k, d + 1))
        return out

    def blocks(self, band: int) -> int:
        """Blocks of a sketch in a band: more than any distance, 4 tokens each or less."""
        end = band_bounds(band)[1] - 1
        return max(self.distance(end, end * self.q // self.p) + 2, -(-end // 4))


@lru_cache(maxsize=None)
def band_bounds(k: int) -> tuple[int, int]:
    """Sizes from, up to: 1, 2, 3, 4, then steps of a half."""
    low = 1
    for _ in range(k):
        low = max(low + 1, low * 3 // 2)
    return low, max(low + 1, low * 3 // 2)


def band_of(size: int) -> int:
    k = 0
    while band_bounds(k)[1] <= size:
        k += 1
    return k


def shingles(texts: Sequence[str], link: Link) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the sorted set of every text, one after the other."""
    w = Words(texts, SPACES)
    k, n = link.words, len(w.hash)
    whole = np.flatnonzero(w.row[k - 1 :] == w.row[: n - k + 1]) if n >= k else np.empty(0, np.int64)
    h = np.zeros(len(whole), np.uint64)
    for j in range(k):
        h = h * _STEP + w.hash[whole + j]
    rows = w.row[whole]
    # fewer words: the whole sequence as one
    short = np.flatnonzero((w.count > 0) & (w.count < k))
    if len(short):
        own = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            has = w.count[short] > j
            own[has] = own[has] * _STEP + w.hash[w.first[short[has]] + j]
        h = np.concatenate([mix(h), mix(own + w.count[short].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))])
        rows = np.concatenate([rows, short])
    else:
        h = mix(h)
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    h, rows = h[new], rows[new]
    return h, np.searchsorted(rows, np.arange(len(texts) + 1))


def join_keys(h: np.ndarray, offsets: np.ndarray, link: Link, plans: dict[int, list[tuple[int, int]]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(set, key): the keys by which every set joins."""
    plans = {} if plans is None else plans
    sizes = np.diff(offsets)
    for s in np.unique(sizes).tolist():
        if s and s not in plans:
            plans[s] = link.bands(s)
    in_band: dict[int, list[tuple[int, int]]] = {}
    for i, s in enumerate(sizes.tolist()):
        for band, count in plans[s] if s else ():
            if count > 1:  # else equal sets only, and those are one
                in_band.setdefault(band, []).append((i, count))
    out_set, out_key = [], []
    for band, members in in_band.items():
        n = link.blocks(band)
        ids, counts = np.array(members, np.int64).T
        length = sizes[ids]
        place = np.repeat(np.arange(len(ids)), length)
        at = np.arange(len(place)) - np.repeat(np.cumsum(length) - length, length) + np.repeat(offsets[ids], length)
        token = h[at]
        slot = place * n + (token % np.uint64(n)).astype(np.int64)
        value = np.zeros(len(ids) * n, np.uint64)
        np.bitwise_xor.at(value, slot, mix(token + np.uint64(band)))
        weight = np.bincount(slot, minlength=len(ids) * n).reshape(len(ids), n)
        # the blocks of most tokens, of equal ones the first
        rank = np.argsort(-weight, axis=1, kind="stable")
        chosen = np.arange(n)[None] < counts[:, None]
        who = np.repeat(np.arange(len(ids)), counts)
        block = rank[chosen]
        key = mix(value[who * n + block] + np.uint64(band) * np.uint64(1 << 40) + block.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out_set.append(ids[who])
        out_key.append(key)
    if not out_set:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(out_set), np.concatenate(out_key)


def _signatures(docs: DataFrame, link: Link) -> DataFrame:
    """(doc_id, n, f1, f2, keys): set size, 128-bit fingerprint and join keys of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans: dict[int, list[tuple[int, int]]] = {}
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for low, high in groups(texts):
                h, offsets = shingles(texts[low:high], link)
                sizes = np.diff(offsets)
                sums = np.concatenate([[np.uint64(0)], np.cumsum(h, dtype=np.uint64)])
                more = np.concatenate([[np.uint64(0)], np.cumsum(mix(h + np.uint64(1)), dtype=np.uint64)])
                who, key = join_keys(h, offsets, link, plans)
                order = np.argsort(who, kind="stable")
                ends = np.searchsorted(who[order], np.arange(high - low + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(sizes.astype(np.int64)),
                        pa.array((sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64)),
                        pa.array((more[offsets[1:]] - more[offsets[:-1]]).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(key[order].view(np.int64))),
                    ],
                    names=["doc_id", "n", "f1", "f2", "keys"],
                )

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), work, "doc_id long, n long, f1 long, f2 long, keys array<long>")


def _combined(reps: DataFrame) -> DataFrame:
    """(key, node): the keys of ``reps`` (node, keys), each once for as many rows as fit a buffer, with its least node.

    The other nodes of a buffer that have a key are connected to that least one
    by a key which those two alone have, once for all the keys that they share.  So a key
    that a third of all documents have comes from each task a few times,
    whatever their number.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: list[np.ndarray] = []
        keys: list[np.ndarray] = []
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            node, key = np.concatenate(nodes), np.concatenate(keys)
            order = np.lexsort((node, key))
            node, key = node[order], key[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            least = np.repeat(node[new], np.diff(np.append(np.flatnonzero(new), len(key))))
            other = node != least
            pairs = np.unique(np.stack([node[other], least[other]], 1), axis=0)
            own = mix(pairs[:, 0].astype(np.uint64) * _STEP + mix(pairs[:, 1].astype(np.uint64))).view(np.int64)
            key, node = np.concatenate([key[new], own, own]), np.concatenate([node[new], pairs[:, 0], pairs[:, 1]])
            for low in range(0, len(key), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(key[low : low + (1 << 16)]), pa.array(node[low : low + (1 << 16)])], names=["key", "node"])

        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            nodes.append(np.repeat(batch.column(0).to_numpy(), np.diff(offsets)))
            keys.append(lists.values.to_numpy()[offsets[0] : offsets[-1]])
            held += len(keys[-1])
            if held >= COMBINED:
                yield from out()
                nodes, keys, held = [], [], 0
        if held:
            yield from out()

    return arrow_map(reps.select("node", "keys"), work, "key long, node long")


def _edges(reps: DataFrame) -> DataFrame:
    """(u, v): every document of a key with the least one of it.

    Keys come sorted, so a task holds one document of the key at hand, however
    many share it.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last_first = None, None
        for batch in batches:
            key, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(key):
                continue
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            starts = np.flatnonzero(new)
            first = node[starts]
            if key[0] == last_key:
                first[0] = last_first
            least = np.repeat(first, np.diff(np.append(starts, len(key))))
            last_key, last_first = key[-1], least[-1]
            pairs = np.unique(np.stack([node, least], 1)[node != least], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

    rows = _combined(reps).repartition("key").sortWithinPartitions("key", "node")
    return arrow_map(rows, work, "u long, v long").distinct()


def _forest(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, link: Link) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets of different ``side``, or of all
    links where every side is 0."""
    n = len(ids)
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    sizes = np.array([len(x) for x in sets], np.int64)
    order = np.argsort(sizes, kind="stable")
    sizes, side = sizes[order], side[order]
    sets = [sets[i] for i in order]
    flat = np.concatenate(sets)
    sketch = np.zeros((n, SKETCH), np.uint64)
    bit = flat % np.uint64(SKETCH * 64)
    row = np.repeat(np.arange(n), sizes)
    np.bitwise_xor.at(sketch.reshape(-1), row * SKETCH + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    lows = np.searchsorted(sizes, -(-link.p * sizes // link.q))
    root = np.arange(n)  # as of the last union, for whole arrays
    crossing = bool(side.any())
    out = []
    for i in range(1, n):
        low = int(lows[i])
        if low >= i:
            continue
        ok = root[low:i] != root[i]
        if crossing:
            ok &= side[low:i] != side[i]
        near = np.flatnonzero(ok) + low
        if not len(near):
            continue
        limit = (link.q - link.p) * (sizes[near] + sizes[i]) // (link.q + link.p)
        apart = np.bitwise_count(sketch[near] ^ sketch[i]).sum(1, dtype=np.int64)
        keep = apart <= limit
        # the nearest first: one link of a tree is enough
        near, apart = near[keep], apart[keep]
        for j in near[np.argsort(apart, kind="stable")].tolist():
            if find(i) == find(j):
                continue
            union = len(np.union1d(sets[i], sets[j]))
            if link.q * (sizes[i] + sizes[j] - union) >= link.p * union:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
                root[(root == root[i]) | (root == root[j])] = min(a, b)
                out.append((int(ids[order[i]]), int(ids[order[j]])))
    return out


def _sets(docs: DataFrame, nodes: DataFrame, link: Link) -> DataFrame:
    """(node, cluster, chunks, tokens): the set of every node (node, cluster, n, chunks), made once and stored."""
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column(3).to_pylist()]
            for low, high in groups(texts):
                h, offsets = shingles(texts[low:high], link)
                sets = [h[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(sets, pa.binary())], names=["node", "cluster", "chunks", "tokens"])

    rows = texts.join(nodes, "node").select("node", "cluster", "chunks", "text")
    return stored(arrow_map(rows, work, "node long, cluster long, chunks int, tokens binary"), "sets")


def _searched(tasks: DataFrame, link: Link) -> DataFrame:
    """(u, v): a spanning forest of the links in each task.

    ``tasks``: cluster, a, b, node, side, tokens; a and b number the task within its cluster, and links
    are sought between sides, or where all are 0 among all nodes.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, sides, sets, seen = None, [], [], [], set()

        def done() -> pa.RecordBatch:
            found = _forest(np.array(ids, np.int64), sets, np.array(sides, np.int64), link) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], names=["u", "v"])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for row, (group, node, side) in enumerate(zip(zip(*columns[:3]), *columns[3:])):
                if group != held:
                    if ids:
                        yield done()
                    held, ids, sides, sets = group, [], [], []
                tokens = batch.column(5)[row].as_py()
                if not ids or node != ids[-1]:
                    seen = set()
                if tokens not in seen:  # rows may repeat
                    seen.add(tokens)
                    ids.append(node)
                    sides.append(side)
                    sets.append(np.frombuffer(tokens, np.uint64))
        if ids:
            yield done()

    rows = tasks.select("cluster", "a", "b", "node", "side", "tokens").repartition("cluster", "a", "b").sortWithinPartitions("cluster", "a", "b", "node")
    return arrow_map(rows, search, "u long, v long")


def _sized(nodes: DataFrame, chunk: int | None = None) -> DataFrame:
    """``nodes`` (node, cluster, n) with the number of ``chunks`` that the cluster needs; clusters of one node are left out."""
    need = F.greatest(F.ceil(F.count("*") / (chunk or CHUNK)), F.ceil(F.sum("n") * 8 / CHUNK_BYTES)).cast("int")
    sizes = nodes.groupBy("cluster").agg(need.alias("chunks"), F.count("*").alias("_nodes")).where("_nodes > 1").drop("_nodes")
    return nodes.join(sizes, "cluster")


def _dealt(sets: DataFrame, round_: int) -> DataFrame:
    """Tasks that each have one part of a cluster, dealt by a hash that ``round_`` changes."""
    parts = F.when(F.col("chunks") > 1, F.col("chunks") * PARTS).otherwise(1)
    own = F.pmod(F.xxhash64("node", F.lit(round_)), parts).cast("int")
    return sets.select("cluster", own.alias("a"), F.lit(-1).alias("b"), "node", F.lit(0).alias("side"), "tokens")


def _all_pairs(sets: DataFrame) -> DataFrame:
    """A task for each pair of chunks of a cluster, and one for each chunk."""
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    rows = sets.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return rows.select("cluster", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "node", (F.col("own") > F.col("other")).cast("int").alias("side"), "tokens")


def _linked(docs: DataFrame, signed: DataFrame, reps: DataFrame, clusters: DataFrame, known: DataFrame, link: Link) -> DataFrame:
    """(node, component) of what is linked within the clusters (node, component), or in ``known`` (u, v).

    ``signed``: doc_id and keys of every row; ``reps``: node and n of every set.
    """
    nodes = cut(_sized(clusters.select("node", F.col("component").alias("cluster")).join(reps.select("node", "n"), "node")))
    sets = _sets(docs, nodes, link)
    tidy(docs.sparkSession)
    found = cut(_searched(_dealt(sets, 0), link).unionByName(known))
    tidy(docs.sparkSession)
    classed = components(found)
    large = nodes.where("chunks > 1")
    if large.isEmpty():
        return classed
    # from here on the sets of large clusters alone
    tokens = sets.where("chunks > 1").select("node", "tokens")
    # of each class one set goes on, dealt anew, as long as a round halves them and they don't all fit a task
    before = total = large.count()
    for round_ in range(1, 60):
        heads = large.join(classed, "node", "left").where("coalesce(component, node) = node").select("node", "cluster", "n")
        heads = cut(_sized(heads))
        left, chunks = heads.agg(F.count("*"), F.max("chunks")).first()
        if not left or left > before // 2:
            break
        found = cut(found.unionByName(_searched(_dealt(tokens.join(heads, "node"), round_), link)))
        classed = components(found)
        tidy(docs.sparkSession)
        if chunks == 1:
            break
        before = left
    # keys whose sets aren't all of one class by now
    ids = large.select("node").distinct()
    own = signed.select(F.col("doc_id").alias("node"), "keys").join(F.broadcast(ids) if total <= BROADCAST else ids, "node")
    own = cut(own.join(classed, "node", "left").select("node", "keys", F.coalesce("component", "node").alias("class")))
    keyed = own.select(F.explode("keys").alias("key"), "node", "class")
    undecided = keyed.groupBy("key").agg(F.min("class").alias("least"), F.max("class").alias("most")).where("least <> most").select("key")
    rest = cut(keyed.join(undecided, "key").groupBy("node").agg(F.collect_set("key").alias("keys")))
    tidy(docs.sparkSession)
    if rest.isEmpty():
        return classed
    pairs = components(_edges(rest)).select("node", F.col("component").alias("cluster")).join(reps.select("node", "n"), "node")
    return components(found.unionByName(_searched(_all_pairs(tokens.join(_sized(pairs, PAIRED), "node")), link)))


def classes(docs: DataFrame, link: Link = Link()) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    component_id is the least doc_id that links reach, the row's own included.
    A text without words, or null, has no shingles and links with nothing; a
    null doc_id links with nothing and has a null class.  Rows that repeat a
    doc_id share its class.  Other columns are ignored.
    """
    signed = stored(_signatures(docs, link), "signatures")
    named = signed.where("n > 0 AND doc_id IS NOT NULL")
    # copies are one set: the least of them stands for all
    reps = named.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("node"), F.first("keys").alias("keys"))
    clusters = cut(components(_edges(reps)))
    tidy(docs.sparkSession)
    least = named.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("node"))
    # an id with several texts is one document
    of = F.struct("n", "f1", "f2")
    several = named.groupBy("doc_id").agg(F.min(of).alias("a"), F.max(of).alias("b")).where("a <> b").select("doc_id")
    same = named.join(several, "doc_id").join(least, ["n", "f1", "f2"]).select(F.col("node").alias("u"), F.col("doc_id").alias("v"))
    linked = _linked(docs, signed, reps, clusters, same, link)
    classed = least.join(linked, "node", "left").select(F.col("n"), "f1", "f2", F.coalesce("component", "node").alias("class"))
    return signed.select("doc_id", "n", "f1", "f2").join(classed, ["n", "f1", "f2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("class")).otherwise(F.col("doc_id")).alias("component_id")
    )


def deduplicate(docs: DataFrame, link: Link = Link(words=5, p=80)) -> DataFrame:
    """One row of each class, that of the least doc_id; columns stay, whatever their names.

    Rows without a doc_id, a text or a word are copies of nothing and stay; of
    rows that repeat a doc_id one stays.  An empty table gives no rows.
    """
    first = len(made(docs.sparkSession))
    found = cut(classes(docs, link))
    # what the search has stored and shuffled isn't needed any more
    discard(docs.sparkSession, made(docs.sparkSession)[first:])
    tidy(docs.sparkSession)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti")
    if found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").limit(1).count():
        named = left.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
        left = named.unionByName(left.where("doc_id IS NULL"))
    return left
