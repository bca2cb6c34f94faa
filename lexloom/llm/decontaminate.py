"""Benchmark decontamination by template canonicalisation.

Words of a text become canonical tokens: numbers, units after numbers and
names (capitalised words within a sentence) become typed placeholders, other
words their lower-case selves.  Windows of tokens are templates; windows of
documents join those of benchmark items by hash.  For the windows that match,
the values in the slots are compared: one value of the item has to stand for
one value of the document throughout an occurrence, so that a question with
other numbers or names is found, and a text that is alike by chance is not.  An
occurrence is the windows at one offset of document and item, or about one.
Windows of little but placeholders, as in arithmetic, tables and lists of
names, join by their words with the values.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, stored
from .tokens import Words, groups, hashes, mix, separators, spans

#: Tokens of a window; a shorter item is one window, of ``SHORTEST`` tokens at least.
WINDOW, SHORTEST = 8, 3
#: A template needs so many tokens that aren't placeholders; a window of fewer
#: (or just so many) is compared with the values in its slots.
LITERALS = 3
#: An item is in a document if so many of its windows are, and this part of them.
LEAST, COVERAGE = 3, 0.3
#: Or so many windows in a row, whatever part of the item they are: 32 tokens.
RUN = 25
#: Part of the slots that has to be consistent.
CONSISTENT = 0.75
#: Windows of items that are broadcast at most; more are joined by shuffle.
BROADCAST = 2_000_000

#: Units of measurement and currencies.
UNITS = (
    "am bytes cent cents cl cm day days degrees dl dollar dollars eur euro euros feet foot ft g gallon gallons gb ghz gram grams h hour hours hz inch"
    " inches kb kg khz kilogram kilograms kilometer kilometers km kmh kw kwh l lb lbs liter liters litre litres m mb meter meters metre metres mg mhz"
    " mi mile miles min minute minutes ml mm month months mph ms ounce ounces oz percent pence pm pound pounds s sec second seconds t tb ton tonne"
    " tonnes tons usd v volt volts w watt watts week weeks yard yards year years"
)
_ALNUM = separators(keep=bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_NUMBER, _UNIT, _NAME = (np.uint64(x) for x in (0x1111, 0x2222, 0x3333))


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_DIGIT = _flags(b"0123456789")
_UPPER, _LOWER = _flags(bytes(range(65, 91))), _flags(bytes([*range(97, 123), *range(128, 256)]))
_ENDS = _flags(b".!?:;\n\r\"'()[]-*#|")
_JOINS = _flags(b".,:/-")


def _two_bytes() -> tuple[np.ndarray, np.ndarray]:
    """Of the characters that UTF-8 writes in two bytes: which are capitals, and their small letters."""
    chars = [chr(i) for i in range(0x800)]
    capital = np.array([i >= 0x80 and c.isupper() for i, c in enumerate(chars)])
    small = np.array([ord(c.lower()) if capital[i] and len(c.lower()) == 1 and 0x80 <= ord(c.lower()) < 0x800 else i for i, c in enumerate(chars)], np.uint16)
    return capital, small


_CAPITAL, _SMALL = _two_bytes()


def _point(lead: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The character of two bytes, or 0 where they are none."""
    both = (lead >= 0xC2) & (lead < 0xE0) & (after >= 0x80) & (after < 0xC0)
    return np.where(both, ((lead & 0x1F).astype(np.uint16) << 6) | (after & 0x3F), 0)


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 with the capitals of one or two bytes (Latin, Greek, Cyrillic) in lower case."""
    out = data + (_UPPER[data] * np.uint8(32))
    lead = np.flatnonzero((data[:-1] >= 0xC2) & (data[:-1] < 0xE0)) if len(data) > 1 else np.empty(0, np.int64)
    point = _point(data[lead], data[lead + 1]) if len(lead) else np.empty(0, np.uint16)
    own = _CAPITAL[point]
    lead, small = lead[own], _SMALL[point[own]]
    out[lead], out[lead + 1] = 0xC0 | (small >> 6), 0x80 | (small & 0x3F)
    return out


class Canonical:
    """Canonical tokens of texts: ``row``, ``token`` (hash), ``value`` (hash of the word in a slot, else 0)."""

    def __init__(self, texts: Sequence[str]) -> None:
        words = Words(texts, _ALNUM, lower=False)
        data, s, e = words.data, words.start, words.end
        low = lowered(data)
        h = hashes(low, s, e)
        number = _DIGIT[data[s]] if len(s) else np.zeros(0, bool)
        # 3.14 and 1/2 are one number
        joined = np.zeros(len(s), bool)
        joined[1:] = number[1:] & number[:-1] & (s[1:] - e[:-1] == 1) & _JOINS[data[e[:-1]]]
        unit = np.zeros(len(s), bool)
        unit[1:] = number[:-1] & ~number[1:] & (words.row[1:] == words.row[:-1]) & (s[1:] - e[:-1] <= 1) & np.isin(h[1:], _unit_hashes())
        # a capital and a small letter, after a space that doesn't follow the end of a sentence
        last = np.maximum(e - 1, 0)
        if len(s):
            wide = _CAPITAL[_point(data[s], data[np.minimum(s + 1, last)])]
            third = np.minimum(s + np.where(wide, 2, 1), last)
            title = (_UPPER[data[s]] | wide) & _LOWER[data[third]] & (third > s)
        else:
            title = number
        inner = (s >= 2) & (data[np.maximum(s - 1, 0)] == 32) & ~_ENDS[data[np.maximum(s - 2, 0)]]
        begin = words.begins[words.row]
        name = title & inner & (s - 2 >= begin)
        slot = number | unit | name
        token = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, h)))
        kept = ~joined
        # the value of a joined number is all of its parts
        lead = np.flatnonzero(kept)
        value = np.add.reduceat(h, lead) if len(lead) else h[:0]
        self.row, self.token = words.row[kept], token[kept]
        self.value = np.where(slot[kept], value | np.uint64(1), np.uint64(0))
        self.first = np.searchsorted(self.row, np.arange(len(texts) + 1))

    def windows(self, size: int, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of the windows of ``size`` tokens with enough that aren't placeholders.

        With ``exact``, of those with too few or just enough of them, by their
        words: the first word of a text may be a name elsewhere, so the two overlap.
        """
        n = len(self.token)
        if n < size:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        start = np.flatnonzero(self.row[size - 1 :] == self.row[: n - size + 1])
        literal = np.concatenate([[0], np.cumsum(self.value == 0)])
        literal = literal[start + size] - literal[start]
        start = start[literal <= LITERALS] if exact else start[literal >= min(LITERALS, size)]
        token = np.where(self.value != 0, self.value, self.token) | np.uint64(1) if exact else self.token
        h = np.full(len(start), np.uint64(size + 2 * WINDOW * exact))
        for j in range(size):
            h = h * _STEP + token[start + j]
        return start, mix(h)


_UNIT_HASHES: list[np.ndarray] = []


def _unit_hashes() -> np.ndarray:
    if not _UNIT_HASHES:
        data = np.frombuffer(UNITS.encode(), np.uint8)
        _UNIT_HASHES.append(hashes(data, *spans(data, _ALNUM)))
    return _UNIT_HASHES[0]


_FOUND = "id long, hash long, pos int, size int, total int, tokens int, exact boolean, slots array<long>"


def _rows(ids: pa.Array, found: list[tuple[np.ndarray, ...]], c: Canonical, n: int) -> pa.RecordBatch:
    """Windows as rows of ``_FOUND``: (start, hash, size, total, exact) of each."""
    start, h, size, total, exact = (np.concatenate([x[i] for x in found]) if found else np.empty(0, np.int64) for i in range(5))
    width = int(size.max()) if len(size) else 0
    slots = np.zeros((len(start), width), np.uint64)
    for j in range(width):
        own = size > j
        slots[own, j] = c.value[start[own] + j]
    any_slot = slots.any(1) if width else np.zeros(0, bool)
    row = c.row[start] if len(start) else np.empty(0, np.int64)
    sizes = np.where(any_slot, width, 0)
    flat = slots[any_slot].reshape(-1).view(np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(row)),
            pa.array(h.view(np.int64) if len(h) else np.empty(0, np.int64)),
            pa.array((start - (c.first[row] if len(row) else 0)).astype(np.int32)),
            pa.array(size.astype(np.int32)),
            pa.array(total.astype(np.int32)),
            pa.array(np.diff(c.first)[row].astype(np.int32)),
            pa.array(exact.astype(bool)),
            lists,
        ],
        names=["id", "hash", "pos", "size", "total", "tokens", "exact", "slots"],
    )


def item_windows(items: DataFrame, id: str, text: str) -> DataFrame:
    """The windows of every item; ``total`` is how many templates it has, ``tokens`` its tokens."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for low, high in groups(texts):
                c = Canonical(texts[low:high])
                count = np.diff(c.first)
                found = []
                for size in range(SHORTEST, WINDOW + 1):
                    templates = np.zeros(high - low, np.int64)
                    for exact in (False, True):
                        start, h = c.windows(size, exact)
                        own = count[c.row[start]]
                        mine = own == size if size < WINDOW else own >= size
                        start, h = start[mine], h[mine]
                        if not exact:
                            templates = np.bincount(c.row[start], minlength=high - low)
                        found.append((start, h, np.full(len(start), size), templates[c.row[start]], np.full(len(start), exact)))
                yield _rows(batch.column(0).slice(low, high - low), found, c, high - low)

    return arrow_map(items.select(F.col(id).cast("long"), F.col(text)), work, _FOUND)


def document_windows(docs: DataFrame, sizes: Sequence[int], known: np.ndarray | None, id: str, text: str) -> DataFrame:
    """The windows of documents, of which only those in ``known`` (sorted) if it is given."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(known) if known is not None else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = sent.value if sent is not None else None
        if keys is not None:
            # a bit table first: most windows are in no item
            bits = np.zeros(1 << 22, bool)
            bits[keys >> np.uint64(42)] = True
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for low, high in groups(texts):
                c = Canonical(texts[low:high])
                found = []
                for size, exact in product(sizes, (False, True)):
                    start, h = c.windows(size, exact)
                    if keys is not None:
                        near = np.flatnonzero(bits[h >> np.uint64(42)])
                        at = np.minimum(np.searchsorted(keys, h[near]), max(0, len(keys) - 1))
                        near = near[keys[at] == h[near]] if len(keys) else near[:0]
                        start, h = start[near], h[near]
                    found.append((start, h, np.full(len(start), size), np.zeros(len(start), np.int64), np.full(len(start), exact)))
                if sum(len(x[0]) for x in found):
                    yield _rows(batch.column(0).slice(low, high - low), found, c, high - low)

    return arrow_map(docs.select(F.col(id).cast("long"), F.col(text)), work, _FOUND)


def matches(docs: DataFrame, items: DataFrame, id: str = "doc_id", item_id: str = "item_id", text: str = "text", most: int = BROADCAST) -> DataFrame:
    """(doc_id, item_id, n_windows, coverage, n_slots, consistency, kind): the items in
    each document; kind is exact, or re-parameterised where a slot's value differs.
    Figures are those of one occurrence, an exact one if there is any.

    Null and empty texts, and items of under ``SHORTEST`` tokens, match
    nothing; rows without an id take no part.  Repeated rows of a document
    count as one document, those of an item as one item; of an id with several
    texts each text is an item, and a document has the item if it has one of
    them.  Other columns are ignored.  The windows of items are broadcast if
    there are at most ``most``, else joined by shuffle.
    """
    named = items.where(F.col(item_id).isNotNull() & F.col(text).isNotNull())
    named = named.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"), F.xxhash64(F.col(item_id).cast("long"), text).alias("key"))
    wanted = stored(item_windows(named.dropDuplicates(["key"]), "key", "text"), "templates")
    n, sizes = wanted.count(), sorted(r[0] for r in wanted.select("size").distinct().collect())
    known = None
    if n <= most:
        known = np.unique(wanted.select("hash").toArrow().column(0).to_numpy().view(np.uint64)) if n else np.empty(0, np.uint64)
    seen = document_windows(docs.where(F.col(id).isNotNull()), sizes, known, id, text)
    d = seen.select(F.col("id").alias("doc"), "hash", F.col("slots").alias("doc_slots"), F.col("pos").alias("doc_pos"))
    i = wanted.select(F.col("id").alias("item"), "hash", "pos", "total", "tokens", (F.col("tokens") - F.col("size") + 1).alias("all_windows"), "exact", F.col("slots").alias("item_slots"))
    pairs = (
        d.join(F.broadcast(i) if n <= most // 20 else i, "hash")
        .withColumn("shift", F.col("doc_pos") - F.col("pos"))
        # all that follows is by document and item: one shuffle, one scan of the documents
        .repartition("doc", "item")
        # a run is one value of pos less its rank at the same offset
        .withColumn("run", F.col("pos") - F.dense_rank().over(Window.partitionBy("doc", "item", "shift").orderBy("pos")))
    )
    # what each pair says: its window, and the values in its slots
    says = F.concat(
        F.array(F.struct(F.lit(False).alias("slot"), F.col("pos").cast("long").alias("a"), (~F.col("exact")).cast("long").alias("b"))),
        F.transform(
            F.filter(F.arrays_zip("item_slots", "doc_slots"), lambda x: (x["item_slots"] != 0) & (x["doc_slots"] != 0)),
            lambda x: F.struct(F.lit(True).alias("slot"), x["item_slots"].alias("a"), x["doc_slots"].alias("b")),
        ),
    )
    keys = ["doc", "item", "total", "all_windows"]
    said = pairs.select(*keys, "tokens", "shift", "run", F.explode(says).alias("s")).groupBy(*keys, "tokens", "shift", "run", "s.slot", "s.a", "s.b").count()
    counted = (
        said.withColumn("place", F.explode(_places()))
        .groupBy(*keys, "place", "slot", "a", "b")
        .agg(F.sum("count").alias("count"))
        # one value of the item, one of the document
        .groupBy(*keys, "place", "slot", "a")
        .agg(F.max("count").alias("best"), F.sum("count").alias("all"), F.max(F.col("a") != F.col("b")).alias("changed"), F.max("b").alias("template"))
        .groupBy(*keys, "place")
        .agg(
            F.count_if(~F.col("slot")).alias("n_windows"),
            F.count_if(~F.col("slot") & (F.col("template") == 1)).alias("n_templates"),
            F.count_if("slot").alias("n_slots"),
            F.coalesce(F.sum(F.when(F.col("slot"), F.col("best"))) / F.sum(F.when(F.col("slot"), F.col("all"))), F.lit(1.0)).alias("consistency"),
            F.coalesce(F.max(F.when(F.col("slot"), F.col("changed"))), F.lit(False)).alias("changed"),
        )
    )

    def enough(n: str, of: str) -> Column:
        return (F.col(n) >= F.least(F.lit(LEAST), of)) & (F.col(n) >= COVERAGE * F.col(of))

    found = (
        counted.where(
            # so much of the templates, whose values may differ, or of all windows, or a long run
            F.when(F.col("place.how") == RUNS, F.col("n_windows") >= RUN).otherwise(
                enough("n_templates", "total") & (F.col("total") > 0) | enough("n_windows", "all_windows")
            )
        )
        .where(F.col("consistency") >= CONSISTENT)
        # an exact occurrence before others, then the one with most windows
        .join(named.select(F.col("key").alias("item"), "item_id").distinct(), "item")
        .groupBy("doc", "item_id")
        .agg(F.max(F.struct(~F.col("changed"), "n_windows", "consistency", "n_slots", "all_windows")).alias("x"))
    )
    return found.select(
        F.col("doc").alias(id),
        F.col("item_id").alias(item_id),
        "x.n_windows",
        F.round(F.col("x.n_windows") / F.col("x.all_windows"), 4).alias("coverage"),
        "x.n_slots",
        "x.consistency",
        F.when(F.col("x.col1"), "exact").otherwise("re-parameterised").alias("kind"),
    )


#: The last way of ``_places``.
RUNS = 4


def _places() -> Column:
    """The places of a pair of windows that may be one occurrence of the item, as (how, at, run).

    All pairs at one offset are one; so are those at about one offset, as words
    may be put in or left out (two rows of ranges, half an item wide and half of
    that apart); and so is the whole document, whose copy may be in pieces.  The
    last way is a run of windows, which counts by its length alone.
    """
    half = F.greatest(F.col("tokens") / 2, F.lit(1))
    ways = [F.lit(0), F.col("shift"), F.floor(F.col("shift") / half), F.floor(F.col("shift") / half + 0.5), F.col("shift")]
    return F.array(
        *[F.struct(F.lit(how).alias("how"), at.cast("long").alias("at"), (F.col("run") if how == RUNS else F.lit(0)).cast("long").alias("run")) for how, at in enumerate(ways)]
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold an item; columns stay.

    Rows that share an id are one document and go together; a row without an
    id is judged by its own text.  Null and empty texts stay, and so does
    everything where there are no items.
    """
    key = F.coalesce(F.col(id).cast("long"), F.xxhash64(text, F.lit("no id")))
    keyed = docs.withColumn("_decontaminated_by", key)
    found = matches(keyed.select("_decontaminated_by", F.col(text).alias("text")), items.withColumnsRenamed({text: "text"}), "_decontaminated_by")
    return keyed.join(found.select("_decontaminated_by").distinct(), "_decontaminated_by", "left_anti").select(docs.columns)
