"""Byte-level BPE encoding and decoding.

A word (a match of the split pattern) is an array of byte strings.  A Spark
higher-order function folds merges over it: at every step the adjacent pair
whose concatenation has the least rank becomes one part, until no pair has a
rank.  Ranks come from a literal in the plan: maps of byte strings to ranks,
dealt over an array by crc32, so that a lookup reads one array slot and a map
of an entry or two.  Byte strings are Latin-1 strings, a character for a byte.

Words repeat, so each distinct word is folded once as far as memory allows:

1. count the distinct words of the whole corpus, pre-aggregated by task;
2. fold the most frequent (always ``CACHE`` of them where there are so many, a
   proven bound whatever the corpus) and broadcast their ids;
3. split every text again; words of the broadcast become its entries, the
   others are folded by the same expression in the row where they occur.

Which words are in the broadcast decides speed, never results.  Nothing but
counts of words is shuffled.  Decoding concatenates the byte strings of ids.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import json
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, release, stored
from .tokens import hashes

#: Words that may be broadcast with their ids (about 60 MB), the bytes that such a word may
#: have, and how many of them, the most frequent, are looked up one by one; the others in arrays.
CACHE, CACHE_BYTES, HOT = 1_000_000, 64, 1 << 17
#: Words of more bytes are merged by a heap in Python: the fold copies its arrays at every merge.
LONG = 1024
_SLOTS = 1 << 14  # Spark keeps descriptions of plans, and so of the literal
_NONE = 2**31 - 1
_AT = 1 << 20


@functools.lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks, which are their ids, from a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@functools.lru_cache(maxsize=4)
def _literal(path: str) -> str:
    slots: list[dict[str, int]] = [{} for _ in range(_SLOTS)]
    for token, rank in load_ranks(path).items():
        text = token.decode("latin-1")
        slots[zlib.crc32(text.encode()) % _SLOTS][text] = rank
    return json.dumps(slots, separators=(",", ":"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once; of an orderable type.

    ``array_min`` takes the one element out: unlike an index it knows its type
    beforehand, where an index asks the whole expression below for it each time.
    """
    return F.array_min(F.transform(F.array(value), body))


def fold_merges(words: Column, path: str) -> Column:
    """For an array of words, the array of their arrays of ids; null for a null word."""
    table = F.from_json(F.lit(_literal(path)), "array<map<string,int>>")
    return let(table, lambda t: F.transform(words, lambda w: _fold(w, t)))


def _fold(word: Column, table: Column) -> Column:
    """Parts are kept as the array of their bounds, so that a merge removes a bound.
    ``ways`` has, for every inner bound, rank * 2**20 + bound of the merge across
    it; its least element is the merge of least rank, of equal ones the first."""

    def lookup(part: Column) -> Column:
        # bound, as it is the slot and the key
        return let(part, lambda p: F.try_element_at(F.get(table, (F.crc32(p.cast("binary")) % _SLOTS).cast("int")), p))

    def fold(text: Column) -> Column:
        none = F.array().cast("array<bigint>")

        def way(low: Column, bound: Column, high: Column) -> Column:
            rank = F.coalesce(lookup(F.substring(text, low, high - low)), F.lit(_NONE)).cast("long")
            return rank * _AT + bound

        def merge(state: Column) -> Column:
            bounds, ways = state.getField("bounds"), state.getField("ways")

            def across(k: Column) -> Column:
                # bound k goes: the part before it and its neighbours are low, start | end, high
                start, end = F.get(bounds, k - 2), F.get(bounds, k)
                return F.struct(
                    F.array_remove(bounds, F.get(bounds, k - 1)).alias("bounds"),
                    F.concat(
                        F.slice(ways, 1, F.greatest(k - 3, F.lit(0))),
                        F.when(k > 2, F.array(way(F.get(bounds, k - 3), start, end))).otherwise(none),
                        F.when(k + 1 < F.size(bounds), F.array(way(start, end, F.get(bounds, k + 1)))).otherwise(none),
                        F.slice(ways, k + 1, F.size(ways)),
                    ).alias("ways"),
                )

            def step(least: Column) -> Column:
                # the first way belongs to the second bound
                return F.when(least < _NONE * _AT, let((F.array_position(ways, least) + 1).cast("int"), across)).otherwise(state)

            return let(F.array_min(ways), step)

        n = F.length(text)
        start = F.struct(
            F.sequence(F.lit(1), n + 1).alias("bounds"),
            F.transform(F.sequence(F.lit(2), n), lambda b: way(b - 1, b, b + 1)).alias("ways"),
        )
        bounds = F.aggregate(F.sequence(F.lit(2), n), start, lambda s, _: merge(s), lambda s: s.getField("bounds"))
        return let(
            bounds,
            lambda x: F.transform(F.sequence(F.lit(0), F.size(x) - 2), lambda i: lookup(F.substring(text, F.get(x, i), F.get(x, i + 1) - F.get(x, i)))),
        )

    def encode(text: Column) -> Column:
        whole = let(lookup(text), lambda r: F.when(r.isNotNull(), F.array(r)))
        return F.coalesce(whole, F.when(F.length(text) > 1, fold(text)), F.when(text == "", F.array().cast("array<int>")))

    return let(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), encode)


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges by a heap and links: n log n for a word of n bytes."""
    parts: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap: list[tuple[int, int, bytes]] = []

    def offer(i: int) -> None:
        if i >= 0 and (j := after[i]) < len(parts) and (r := ranks.get(pair := parts[i] + parts[j])) is not None:
            heapq.heappush(heap, (r, i, pair))

    for i in range(len(parts)):
        offer(i)
    while heap:
        _, i, pair = heapq.heappop(heap)
        if parts[i] is None or (j := after[i]) >= len(parts) or parts[i] + parts[j] != pair:
            continue  # an older offer
        parts[i], parts[j] = pair, None
        after[i] = after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [ranks[p] for p in parts if p is not None]


#: White space as Unicode has it; the library's own classes add control characters.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters and numbers below U+0250.
_LATIN = {r"\p{L}": r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", r"\p{N}": r"0-9\xb2\xb3\xb9\xbc-\xbe"}


def _classes(pattern: str, known: dict[str, str]) -> str:
    """``pattern`` with its classes (``known`` ones, white space) spelt out."""
    out, within, i = [], False, 0
    while i < len(pattern):
        for name, what in ((r"\s", SPACE), *known.items()):
            if pattern.startswith(name, i):
                out.append(what if within else f"[{what}]")
                i += len(name)
                break
        else:
            if pattern.startswith(r"\S", i) and not within:
                out.append(f"[^{SPACE}]")
                i += 2
            elif pattern[i] == "\\":
                out.append(pattern[i : i + 2])
                i += 2
            else:
                within = {"[": True, "]": False}.get(pattern[i], within)
                out.append(pattern[i])
                i += 1
    return "".join(out)


@functools.lru_cache(maxsize=4)
def splitter(pattern: str) -> Callable[[str], list[str]]:
    """The matches of ``pattern`` in a text; twice as fast where it is all Latin."""
    full = regex.compile(_classes(pattern, {})).findall
    spelt = _classes(pattern, _LATIN)
    # no other branch starts with an apostrophe and a letter; the frequent ones first
    short, letters = "'s|'t|'re|'ve|'m|'ll|'d|", _classes(r" ?\p{L}+| ?\p{N}+|", _LATIN)
    if spelt.startswith(short + letters):
        spelt = letters + short + spelt.removeprefix(short + letters)
    if r"\p" in spelt or r"\P" in spelt:
        return full
    latin, other = re.compile(spelt).findall, re.compile("[^\0-\u024f]").search
    return lambda text: full(text) if other(text) else latin(text)


class _Codes(dict):
    """Codes of words; a word that has none gets the next of its row's own."""

    own: dict[str, int]

    def __missing__(self, word: str) -> int:
        return -1 - self.own.setdefault(word, len(self.own))


def distinct_words(docs: DataFrame, pattern: str, text: str = "text", flush: int = 1 << 18) -> DataFrame:
    """(word, n): every distinct word of the corpus and how often it occurs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = splitter(pattern), Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for x in batch.column(0):
                if (x := x.as_py()):
                    seen.update(split(x))
                    if len(seen) > flush:
                        yield out()
                        seen.clear()
        if seen:
            yield out()

    return arrow_map(docs.select(F.col(text)), work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(words: DataFrame, most: int) -> DataFrame:
    """The most frequent words, ``most`` at most and nearly as many wherever there are more: no sort of all words.

    Counts are taken in steps, exact ones below 4096 and of a hundredth above.
    Of the step that no longer fits whole, the words of least hash fill up the rest.
    """
    words = words.where(F.octet_length("word") <= CACHE_BYTES)
    step = F.when(F.col("n") < 4096, F.col("n")).otherwise(4096 + F.floor(F.log2(F.col("n") / 4096) * 64)).cast("int")

    def fitting(places: DataFrame, room: int) -> tuple[int | None, int | None, int]:
        """The last place that fits when they are taken in order, the first that doesn't, and the room that is left; places are a few thousand."""
        fits = None
        for at, count in places.collect():
            if count > room:
                return fits, at, room
            fits, room = at, room - count
        return fits, None, room

    _, split, room = fitting(words.groupBy(step.alias("at")).count().orderBy(F.desc("at")), most)
    if split is None:
        return words
    place = F.pmod(F.xxhash64("word"), F.lit(4096)).cast("int")
    fits, _, _ = fitting(words.where(step == split).groupBy(place.alias("at")).count().orderBy("at"), room)
    return words.where((step > split) | (step == split) & (place <= (-1 if fits is None else fits)))


def encode(docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text", cache: int = CACHE, digests: bool = False) -> DataFrame:
    """(id, n_tokens, ids, decoded_sha256): ``ids`` is binary, little-endian unsigned
    32-bit integers; the digest is of the bytes that decoding them gives.  With
    ``digests`` there is ids_sha256 in place of ids.

    A null or empty text has no tokens.  Repeated rows give repeated results;
    a null id stays.  Other columns are ignored, whatever their names; an empty
    table gives no rows.
    ``path`` is a rank file that every executor can read at the same place.
    """
    ids_name = "ids_sha256" if digests else "ids"
    # plans hold the literal: their descriptions, which Spark keeps, are better without it
    docs.sparkSession.conf.set("spark.sql.maxPlanStringLength", "20000")
    words = stored(distinct_words(docs, pattern, text), "words")
    top = frequent(words, cache).select("word", "n")
    # a task reads the literal anew, so not too many of them
    folded = top.repartition(12).select("word", "n", fold_merges(F.array("word"), path)[0].alias("ids"))
    sc = docs.sparkSession.sparkContext
    cached, table = (sc.broadcast(x) for x in _tables(folded))
    release()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Codes of words, as bytes (arrays of them are slow to pass): n >= 0 is
        word n of the broadcast, -1 - k is word k of ``rare``."""
        findall, found = splitter(pattern), _Lookup(cached.value)
        ranks = load_ranks(path)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                codes, own = found.codes([findall(x) if x else [] for x in part.column(1).to_pylist()])
                # a long word has its ids beside it, and is empty for the fold
                long = [{k: merge_long(w.encode(), ranks) for k, w in enumerate(x) if len(w) * 4 > LONG and len(w.encode()) > LONG} for x in own]
                rare = [["" if k in over else w for k, w in enumerate(x)] for x, over in zip(own, long)]
                long = [[over.get(k) for k in range(len(x))] if over else None for x, over in zip(own, long)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x.tobytes() for x in codes], pa.binary()), pa.array(rare, pa.list_(pa.string())), pa.array(long, pa.list_(pa.list_(pa.int32())))],
                    names=["id", "codes", "rare", "long"],
                )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pieces = (table.value[0].astype(np.int64), table.value[1]), decoder(path)
        for batch in _slices(batches):
            ids, ends = _ids_of(batch, known)
            raw, raw_ends = decode(ids, ends, pieces)
            parts = [ids[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
            decoded = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip([0, *raw_ends[:-1].tolist()], raw_ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) // 4 for x in parts], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in parts], pa.string()) if digests else pa.array(parts, pa.binary()),
                    pa.array(decoded, pa.string()),
                ],
                names=["id", "n_tokens", ids_name, "decoded_sha256"],
            )

    kind = docs.schema[id].dataType.simpleString()
    parts = arrow_map(docs.select(F.col(id).alias("id"), F.col(text)), split, f"id {kind}, codes binary, rare array<string>, long array<array<int>>")
    folded = parts.select("id", "codes", fold_merges(F.col("rare"), path).alias("rare"), "long")
    ids_kind = "string" if digests else "binary"
    return arrow_map(folded, join, f"id {kind}, n_tokens long, {ids_name} {ids_kind}, decoded_sha256 string").withColumnRenamed("id", id)


def _slices(batches: Iterator[pa.RecordBatch], most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Batches cut to rows of ``most`` bytes of codes together; a longer row is alone."""
    for batch in batches:
        sizes = np.diff(np.frombuffer(batch.column(1).buffers()[1], np.int32, batch.num_rows + 1, batch.column(1).offset * 4)) if batch.num_rows else np.zeros(0)
        low = total = 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > most:
                yield batch.slice(low, i - low)
                low, total = i, 0
            total += size
        if low < batch.num_rows:
            yield batch.slice(low)


def _tables(folded: DataFrame) -> tuple[tuple, tuple]:
    """What is broadcast of the folded words (word, n, ids), the most frequent first.

    For splitting: the first words, and of the others sorted hashes, their
    codes, and the words themselves as bytes.  For joining: offsets into the
    ids of all words, and those ids.
    """
    got = folded.toArrow()
    order = np.argsort(-got.column("n").to_numpy(), kind="stable")
    got = got.take(pa.array(order))
    words, ids = got.column("word").combine_chunks(), got.column("ids").combine_chunks()
    rest = words.slice(HOT)
    raw = pa.concat_arrays([rest.cast(pa.binary())])  # its buffers begin at the first word
    starts = np.frombuffer(raw.buffers()[1], np.int32, len(raw) + 1) if len(raw) else np.zeros(1, np.int32)
    data = np.frombuffer(raw.buffers()[2], np.uint8, int(starts[-1])) if len(raw) and starts[-1] else np.zeros(0, np.uint8)
    h = hashes(data, starts[:-1].astype(np.int64), starts[1:].astype(np.int64))
    by_hash = np.argsort(h, kind="stable")
    lists = pa.concat_arrays([ids])
    offsets = np.frombuffer(lists.buffers()[1], np.int32, len(lists) + 1).copy() if len(lists) else np.zeros(1, np.int32)
    values = lists.values.to_numpy(zero_copy_only=False).astype("<u4") if len(lists) else np.zeros(0, "<u4")
    return (words.slice(0, HOT).to_pylist(), h[by_hash], by_hash.astype(np.int32), starts.copy(), data.tobytes()), (offsets, values)


class _Lookup:
    """Codes of words by what :func:`_tables` gives."""

    def __init__(self, sent: tuple) -> None:
        hot, self.hashes, self.index, self.starts, self.data = sent
        self.hot = len(hot)
        self.place = _Codes(zip(hot, range(self.hot)))

    def codes(self, texts: list[list[str]]) -> tuple[list[np.ndarray], list[list[str]]]:
        """For each text the codes of its words, and its words that have none."""
        place, codes, own = self.place, [], []
        for words in texts:
            place.own = {}
            codes.append(np.array([place[w] for w in words], np.int32))
            own.append(list(place.own))
        wanted = [w.encode() for x in own for w in x]
        found = self.others(wanted)
        at, left = 0, []
        for i, x in enumerate(own):
            # codes of the words of this text that weren't among the first
            mine = found[at : at + len(x)]
            at += len(x)
            rare = mine < 0
            mine = np.where(rare, -np.cumsum(rare), mine).astype(np.int32)
            low = codes[i] < 0
            codes[i][low] = mine[-1 - codes[i][low]]
            left.append([w for w, r in zip(x, rare.tolist()) if r])
        return codes, left

    def others(self, wanted: list[bytes]) -> np.ndarray:
        """Codes of words beyond the first, or -1; hashes find them, bytes decide."""
        out = np.full(len(wanted), -1, np.int64)
        if not wanted or not len(self.hashes):
            return out
        ends = np.cumsum([len(w) for w in wanted]).astype(np.int64)
        starts = np.concatenate([[0], ends[:-1]])
        h = hashes(np.frombuffer(b"".join(wanted), np.uint8), starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        for i in np.flatnonzero(self.hashes[at] == h).tolist():
            j = int(self.index[at[i]])
            if self.data[self.starts[j] : self.starts[j + 1]] == wanted[i]:
                out[i] = self.hot + j
        return out


def _gather(offsets: np.ndarray, values: np.ndarray, codes: np.ndarray, block: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values`` that ``codes`` name, one after the other, and their ends.

    A block of codes at a time, so that the indexes in between stay small.
    """
    ends = np.cumsum(offsets[codes + 1] - offsets[codes], dtype=np.int64)
    out = np.empty(int(ends[-1]) if len(ends) else 0, values.dtype)
    for low in range(0, len(codes), block):
        part = codes[low : low + block]
        begin = int(ends[low - 1]) if low else 0
        stop = ends[low : low + block] - begin
        sizes = np.diff(stop, prepend=0)
        at = np.arange(int(stop[-1]), dtype=np.int64)
        at += np.repeat(offsets[part] - (stop - sizes), sizes)
        out[begin : begin + len(at)] = values[at]
    return out, ends


def _ids_of(batch: pa.RecordBatch, known: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows of (id, codes, rare, long), and where each row's end."""
    offsets, values = known
    n = len(offsets) - 1
    rare, long = batch.column(2), batch.column(3).to_pylist()
    base = rare.offsets.to_numpy()
    lists = rare.values.slice(int(base[0]), int(base[-1] - base[0])) if batch.num_rows else rare.values
    base = (base - base[0]).astype(np.int64)
    own_offsets = lists.offsets.to_numpy().astype(np.int64) if len(lists) else np.zeros(1, np.int64)
    own = lists.values.to_numpy(zero_copy_only=False)[own_offsets[0] : own_offsets[-1]].astype("<u4") if len(lists) else np.zeros(0, "<u4")
    own_offsets = own_offsets - own_offsets[0]
    if any(long):
        parts = [own[a:b] for a, b in zip(own_offsets[:-1].tolist(), own_offsets[1:].tolist())]
        for row, x in enumerate(long):
            for k, ids in enumerate(x or ()):
                if ids is not None:
                    parts[base[row] + k] = np.asarray(ids, "<u4")
        own = np.concatenate(parts)
        own_offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
    codes = [np.frombuffer(x.as_py(), np.int32).astype(np.int64) for x in batch.column(1)]
    for row, x in enumerate(codes):
        low = x < 0
        x[low] = n + base[row] - 1 - x[low]
    flat = np.concatenate(codes) if codes else np.zeros(0, np.int64)
    # words of the broadcast, and the batch's own
    common = flat < n
    sizes = np.empty(len(flat), np.int64)
    sizes[common] = offsets[flat[common] + 1] - offsets[flat[common]]
    sizes[~common] = own_offsets[flat[~common] - n + 1] - own_offsets[flat[~common] - n]
    ends = np.cumsum(sizes)
    ids = np.empty(int(ends[-1]) if len(ends) else 0, "<u4")
    for mask, (o, v), c in ((common, (offsets, values), flat[common]), (~common, (own_offsets, own), flat[~common] - n)):
        run, _ = _gather(o, v, c)
        if mask.all():
            ids = run
        elif len(c):
            begin = (ends - sizes)[mask]
            at = np.arange(len(run), dtype=np.int64)
            inner = np.cumsum(sizes[mask]) - sizes[mask]
            at += np.repeat(begin - inner, sizes[mask])
            ids[at] = run
    words = np.cumsum([len(x) for x in codes])
    total = np.concatenate([[0], ends])
    return ids, total[words] if len(words) else np.zeros(0, np.int64)


@functools.lru_cache(maxsize=4)
def decoder(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Offsets by id into the byte strings of all ids, and those."""
    ranks = load_ranks(path)
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int64), np.frombuffer(b"".join(out), np.uint8)


def decode(ids: np.ndarray, ends: np.ndarray, pieces: tuple[np.ndarray, np.ndarray]) -> tuple[bytes, np.ndarray]:
    """The byte strings of ``ids`` concatenated, and where the rows that end at ``ends`` end in them."""
    raw, stops = _gather(*pieces, ids.astype(np.int64))
    return raw.tobytes(), np.concatenate([[0], stops])[ends]
