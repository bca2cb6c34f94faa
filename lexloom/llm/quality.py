"""Quality by weak labels.

Heuristic labellers look at a document's case, symbols, repeats, separators,
word lengths, sentences and lines; each votes good, bad or abstains, and they
overlap.  Expectation-maximisation estimates their accuracies without any
label, from how often each pattern of votes occurs in the whole corpus.  The
posteriors of a bounded sample train a hashed linear scorer on the shapes of
words and how common each is in the document, which alone scores documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import arrow_map, bounded_sample, held_out, not_held_out, release
from .tokens import SPACES, Words, groups, mix
from .weak import Features, LabelModel, LinearScorer, fit_label_model, fit_linear

#: Bounds of the scorer's training sample: rows, and bytes of each.
SAMPLE, LONGEST = 8000, 16_384
#: A document is kept from this score on.
THRESHOLD = 0.3
#: Part of good documents that EM starts from.
PRIOR = 0.85


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(chars)] = 1
    return out


_UPPER = _table(bytes(range(65, 91)))
_LETTER = _table(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_LEAD = _table(bytes(range(0xC0, 256)))
_DIGIT = _table(b"0123456789")
_SYMBOL = _table(b"!#$%&*+/<=>@\\^_`{|}~[]")
_STOP = _table(b".!?")
#: Kinds of bytes for shapes: other, lower case, upper case, digit, and marks one by one.
_KIND = np.zeros(256, np.int64)
_KIND[97:123] = 1
_KIND[128:] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
for _i, _c in enumerate(b".,;:!?\"'()-|%$#&*@/=_+<>[]{}~"):
    _KIND[_c] = 4 + _i


class Stats:
    """Measures of every text, vectorised over the texts."""

    def __init__(self, texts: Sequence[str]) -> None:
        n = len(texts)
        words = Words(texts, SPACES, lower=False)
        self.words, self.n = words, n

        def share(table: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(table[words.data])])
            return (sums[words.begins[1:]] - sums[words.begins[:-1]]).astype(float)

        self.count = words.count.astype(float)
        safe = np.maximum(self.count, 1)
        letters = np.maximum(share(_LETTER), 1)
        size = np.maximum(np.bincount(words.row, words.end - words.start, n), 1)
        self.upper = share(_UPPER) / letters
        self.symbols = share(_SYMBOL) / size
        self.digits = share(_DIGIT) / size
        same = np.zeros(len(words.row), bool)
        same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])
        self.repeats = np.bincount(words.row, same, n) / safe
        # rows of the distinct (row, word) pairs
        order = np.lexsort((words.hash, words.row))
        new = np.ones(len(order), bool)
        new[1:] = (words.row[order][1:] != words.row[order][:-1]) | (words.hash[order][1:] != words.hash[order][:-1])
        self.unique = np.bincount(words.row[order][new], minlength=n) / safe
        alone = (words.end - words.start == 1) & (_SYMBOL[words.data[words.start]] == 1) if len(words.row) else np.zeros(0, bool)
        self.separators = np.bincount(words.row, alone, n) / safe
        self.length = size / safe
        last = words.data[words.end - 1] if len(words.row) else np.zeros(0, np.uint8)
        self.stops = np.bincount(words.row, _STOP[last], n) / safe
        self.shouts = np.bincount(words.row, last == ord("!"), n) / safe
        self.lines = np.array([self._repeated_lines(x) for x in texts])

    @staticmethod
    def _repeated_lines(text: str) -> float:
        lines = [x for x in text.split("\n") if x.strip()]
        return 1 - len(set(lines)) / len(lines) if lines else 0.0


def votes(s: Stats) -> np.ndarray:
    """Rows x labellers: 1 good, -1 bad, 0 abstains.

    Junk comes in kinds, and a labeller knows one kind; so all but one, which
    wants several measures to be plain, abstain rather than vouch for a document.  Thresholds are such as published
    filters of web text use.
    """
    long = s.count >= 20

    def bad(where: np.ndarray) -> np.ndarray:
        return np.where(where, -1, 0)

    return np.stack(
        [
            bad(s.upper > 0.5),
            bad(s.symbols > 0.06),
            bad(s.digits > 0.25),
            bad((s.repeats > 0.15) & (s.repeats * s.count >= 3)),
            bad(long & (s.unique < 0.25)),
            bad(s.separators > 0.1),
            bad((s.length < 2) | (s.length > 16)),
            bad(long & (s.stops < 0.01)),
            np.where(~((s.upper > 0.2) | (s.symbols > 0.03) | (s.repeats > 0.03) | (s.separators > 0.02)) & (s.count >= 3), 1, 0),
            bad(s.shouts > 0.2),
            bad(s.lines > 0.5),
            bad(s.count < 1),
        ],
        1,
    ).astype(np.int8)


def features(s: Stats) -> tuple[np.ndarray, np.ndarray]:
    """(rows, hashes): shapes of words with how common they are, and measures in steps."""
    w = s.words
    size = w.end - w.start
    first = _KIND[w.data[w.start]]
    last = _KIND[w.data[w.end - 1]]
    before = _KIND[w.data[np.maximum(w.end - 2, w.start)]]
    second = _KIND[w.data[np.minimum(w.start + 1, w.end - 1)]]
    same = np.zeros(len(size), np.int64)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])
    # a word or two twice says nothing, however short the text
    same &= np.bincount(w.row, same, s.n)[w.row] >= 3
    shapes = [
        (first * 64 + second) * 64 + last,
        (1 << 20) + before * 64 + last,
        (2 << 20) + np.minimum(size, 15) * 2 + same,
        (3 << 20) + same,
    ]
    rows, hashes = [], []
    for shape in shapes:
        pairs, counts = np.unique(w.row * np.int64(1 << 24) + shape, return_counts=True)
        row = pairs >> 24
        share = counts / np.maximum(s.count[row], 1)
        step = np.searchsorted([0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75], share)
        for k in range(9):  # how common it is, and every step below
            up = step >= k
            rows.append(row[up])
            hashes.append(mix(((pairs & ((1 << 24) - 1)) * 16 + k).astype(np.uint64)[up]))
    for i, measure in enumerate((s.unique, s.lines, s.stops)):
        step = np.searchsorted([0.01, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8], measure)
        rows.append(np.arange(s.n))
        hashes.append(mix(((9 << 24) + i * 64 + step).astype(np.uint64)))
    return np.concatenate(rows), np.concatenate(hashes)


#: Labellers; a pattern of their votes is a number of so many digits to base 3.
LABELLERS = 12


def encoded(cast: np.ndarray) -> np.ndarray:
    """A number for each row of votes."""
    return (cast.astype(np.int64) + 1) @ 3 ** np.arange(LABELLERS, dtype=np.int64)


def decoded(codes: np.ndarray) -> np.ndarray:
    """The votes that numbers stand for."""
    return (codes[:, None] // 3 ** np.arange(LABELLERS, dtype=np.int64) % 3 - 1).astype(np.int8)


def estimate(cast: np.ndarray, counts: np.ndarray) -> LabelModel | None:
    """The label model of patterns of votes and how often each occurs."""
    if not len(cast):
        return None
    return fit_label_model(cast, PRIOR, counts, start=np.where((cast < 0).any(1), 0.05, 0.97))


def train(texts: Sequence[str], model: LabelModel | None = None) -> tuple[LinearScorer, LabelModel | None]:
    """Fit the scorer on the posteriors of some texts; their votes give the model where none is given."""
    if not len(texts):
        return LinearScorer(0.0, np.empty(0, np.uint64), np.empty(0), np.zeros(1 << 20, bool)), model
    s = Stats(texts)
    cast = votes(s)
    model = model or estimate(cast, np.ones(len(cast)))
    return fit_linear(len(texts), Features(*features(s)), model.posterior(cast)), model


def scores(texts: Sequence[str | None], scorer: LinearScorer) -> np.ndarray:
    """The score of every text, a probability of being good; null counts as empty."""
    texts = [x or "" for x in texts]
    out = np.empty(len(texts))
    for low, high in groups(texts):
        rows, hashes = features(Stats(texts[low:high]))
        used = scorer.used(hashes)
        x = scorer.score(high - low, rows[used], hashes[used])
        out[low:high] = 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))
    return out


def patterns(docs: DataFrame, text: str = "text") -> DataFrame:
    """(votes, n): how often each pattern of votes occurs in ``docs``; null counts as empty.

    At most 3 ** LABELLERS rows, and a few hundred in practice: summed by task before the shuffle.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column(0).to_pylist()]
            for low, high in groups(texts):
                codes, n = np.unique(encoded(votes(Stats(texts[low:high]))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["votes", "n"])

    return arrow_map(docs.select(F.col(text)), work, "votes long, n long").groupBy("votes").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> LinearScorer:
    """The model from the votes of all rows; the scorer from at most ``sample`` that are not held out, those of least hash."""
    counted = patterns(docs).orderBy("votes").toArrow()
    model = estimate(decoded(counted.column("votes").to_numpy()), counted.column("n").to_numpy())
    ids = bounded_sample(docs.where(not_held_out() & F.col("doc_id").isNotNull()).select("doc_id"), ["doc_id"], sample).distinct()
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").where(F.octet_length("text") <= longest).toArrow()
    got = sorted(zip(*(c.to_pylist() for c in rows.columns)))[:sample]
    scorer = train([t for _, t in got], model)[0]
    release()
    return scorer


def score(docs: DataFrame, scorer: LinearScorer, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with a column ``into``, a probability of being good; one of that name is replaced.

    Empty and null texts have a score as any other.  No shuffle.
    """
    docs = docs.drop(into)
    place = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scores(batch.column(place).to_pylist(), scorer)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, into])

    return arrow_map(docs, work, StructType([*docs.schema.fields, StructField(into, DoubleType())]))


def classify(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and keep (1 or 0) of every row of ``docs``.

    Null and empty texts are scored as texts without words; a null doc_id is
    not held out; repeated rows are scored each for itself; other columns are
    ignored.  An empty table gives no rows.
    """
    scored = score(docs.select("doc_id", "text"), fit(docs))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("keep"))
