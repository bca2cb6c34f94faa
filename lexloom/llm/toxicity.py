"""Toxicity by weak supervision.

Voters are lexicons of insults, profanity, threats and slurs in four
languages, patterns (an address with an insult, a wish of harm), and lexicons
mined from training rows: words and stems that go with the label in the other half
of them.  A generative model estimates the voters' accuracies and correlations
by expectation-maximisation.  Labels mine lexicons and give accuracies that count
beside EM's own; the posterior of a row comes from its votes alone, so that voters
can overrule its label.  The posteriors train a hashed linear classifier on
words and stems, which alone scores documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import arrow_map, held_out, not_held_out, release
from .tokens import NOT_LETTERS, Words, groups
from .weak import Features, LabelModel, LinearScorer, fit_label_model, fit_linear, promising

#: Bounds of the training sample: labelled rows, and bytes of each.
SAMPLE, LONGEST = 5000, 8192
#: A document is toxic from this score on.
THRESHOLD = 0.3
#: How much the accuracies that labels give count beside those of EM, and how much correlations discount a voter.
KNOWN, DISCOUNT = 1.0, 0.3
#: Bytes of the stems that are features.
STEMS = (3, 4, 5, 6, 8)

#: The lexicons, one voter each.
LEXICONS = {
    "insults_en": "airhead bonehead buffoon clown coward creep cretin degenerate dimwit dolt dumb dumbass fool freak halfwit idiot imbecile jerk"
    " loser lowlife moron nitwit oaf pathetic pig scum scumbag simpleton sleazy slob stupid twit weasel weirdo wimp worthless",
    "contempt_en": "abomination despicable disgrace disgusting filth filthy garbage gross hideous loathsome parasite pest repulsive revolting rotten"
    " sickening trash ugly useless vermin vile",
    "profanity_en": "arse arsehole ass asshole bastard bitch bollocks bullshit crap cunt damn dick dickhead fuck fucker fucking motherfucker piss"
    " prick pussy shit shitty slut twat wanker whore",
    "threats_en": "die hang kill murder rape shoot slaughter stab strangle",
    "de": "arsch arschloch abschaum bastard blödmann depp drecksau dumm dummkopf ekelhaft fotze hurensohn hure idiot mistkerl miststück müll"
    " nutte penner sau schlampe schwachkopf schwein scheiße trottel versager vollidiot wertlos wichser widerlich",
    "fr": "abruti bâtard bouffon connard connasse con crétin débile dégueulasse enculé idiot imbécile merde minable nul ordure pathétique"
    " pouffiasse pute racaille raté salaud salope stupide",
    "es": "asqueroso basura bastardo cabrón estúpido gilipollas hijoputa idiota imbécil inútil mierda pendejo payaso perdedor perra puta puto"
    " repugnante tarado tonto zorra escoria",
}
ADDRESS = re.compile(
    r"\b(?:you(?:'re| are)|du bist|tu es|eres)\s+(?:\w+\s+){0,2}(?:idiot|moron|loser|scum|clown|trash|stupid|worthless|pathetic|disgusting|dumm|nul|tonto)", re.I
)
WISH = re.compile(r"\b(?:shut up|go to hell|drop dead|kill yourself|halt die klappe|ta gueule|cállate|vete al infierno)\b", re.I)


def _lower(texts: Sequence[str | None]) -> list[str]:
    return [(x or "").lower() for x in texts]


def features(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, hashes) of words and stems."""
    out = [(words.row, words.hash)]
    for size in STEMS:
        long, stem = words.prefix(size)
        out.append((words.row[long], stem))
    return out


def gather(texts: Sequence[str], least: int = 4) -> list[Features]:
    """The features of all texts by kind, each once a text, a group of texts at a time.

    A first pass counts features by the top bits of their hashes; those that
    can't be in ``least`` texts are not kept by the second.
    """
    kinds = 1 + len(STEMS)
    counts = np.zeros((kinds, 1 << 21), np.uint16)
    rows: list[list[np.ndarray]] = [[] for _ in range(kinds)]
    hashes: list[list[np.ndarray]] = [[] for _ in range(kinds)]
    for keep in (False, True):
        for low, high in groups(texts):
            for i, (r, h) in enumerate(features(Words(texts[low:high], NOT_LETTERS, lower=False))):
                part = Features(r, h)
                slot = part.hashes >> np.uint64(43)
                if keep:
                    often = counts[i][slot] >= least
                    rows[i].append((part.rows[often] + low).astype(np.int32))
                    hashes[i].append(part.hashes[often])
                else:
                    np.add.at(counts[i], slot, 1)
    return [Features(np.concatenate(r), np.concatenate(h)) for r, h in zip(rows, hashes)]


def votes(texts: Sequence[str], found: list[Features], labels: np.ndarray) -> np.ndarray:
    """Rows x voters.  The learnt lexicons judge a row by the labels of the other
    half of the rows, so that no row votes on itself."""
    n = len(texts)
    keys = [Words(entries.split(), NOT_LETTERS).hash for entries in LEXICONS.values()]
    hits = np.zeros((len(keys), n), np.int64)
    for low, high in groups(texts):
        words = Words(texts[low:high], NOT_LETTERS, lower=False)
        for i, own in enumerate(keys):
            hits[i, low:high] = np.bincount(words.row[np.isin(words.hash, own)], minlength=high - low)
    columns = [np.where(row > 0, 1, 0) for row in hits]
    total = hits.sum(0)
    columns.append(np.where(total == 0, -1, np.where(total > 1, 1, 0)))
    for pattern in (ADDRESS, WISH):
        columns.append(np.array([1 if pattern.search(x) else 0 for x in texts]))
    half = np.arange(n) % 2 == 0
    for kind in found:
        keys_of, place = np.unique(kind.hashes, return_inverse=True)
        place = place.reshape(-1)
        vote = np.zeros(n, np.int64)
        for train in (half, ~half):
            mine = train[kind.rows]
            seen = np.bincount(place[mine], minlength=len(keys_of))
            ones = np.bincount(place[mine], labels[kind.rows[mine]], len(keys_of))
            learnt = (ones >= 6) & (ones >= 0.9 * seen)
            hit = np.bincount(kind.rows[~mine], learnt[place[~mine]], n)
            vote = np.where(train, vote, np.where(hit > 0, 1, -1))
        columns.append(vote)
    return np.stack(columns, 1).astype(np.int8)


def train(texts: Sequence[str], labels: np.ndarray) -> tuple[LinearScorer, LabelModel | None]:
    """Fit on some texts with labels 0 or 1."""
    texts = _lower(texts)
    if not len(texts) or labels.min() == labels.max():  # nothing to tell apart
        always = bool(len(texts)) and bool(labels.max())
        empty = np.empty(0, np.uint64)
        return LinearScorer(8.0 if always else -8.0, empty, np.empty(0), np.zeros(1 << 20, bool)), None
    found = gather(texts)
    cast = votes(texts, found, labels)
    model = fit_label_model(cast, labels.mean(), start=np.where(labels > 0, 0.95, 0.05), weight=KNOWN, discount=DISCOUNT)
    target = model.posterior(cast)
    found = [promising(x, target) for x in found]
    both = Features(np.concatenate([x.rows for x in found]), np.concatenate([x.hashes for x in found]))
    return fit_linear(len(texts), both, target), model


def scores(texts: Sequence[str | None], scorer: LinearScorer) -> np.ndarray:
    """The score of every text, a probability; texts are read whole."""
    out = np.empty(len(texts))
    lowered = _lower(texts)
    for low, high in groups(lowered):
        words = Words(lowered[low:high], NOT_LETTERS, lower=False)
        rows, hashes = [], []
        for r, h in features(words):
            used = scorer.used(h)
            rows.append(r[used])
            hashes.append(h[used])
        x = scorer.score(high - low, np.concatenate(rows), np.concatenate(hashes))
        out[low:high] = 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))
    return out


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> tuple[list[str], np.ndarray]:
    """At most ``sample`` labelled rows that are not held out, those of least hash.

    Of an id with several labels the greatest counts, of several texts the
    least; rows without a text, of more than ``longest`` bytes or without a
    label take no part.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & not_held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    # bounded by ``sample`` ids, whatever the input
    chosen = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").where(F.octet_length("text") <= longest).select("doc_id", "text", "_toxic").toArrow()
    first: dict[int, tuple[str, int]] = {}
    for d, t, y in zip(*(rows.column(i).to_pylist() for i in range(3))):
        first[d] = min(first.get(d, (t, y)), (t, y))
    got = sorted(first.items())[:sample]
    return [t for _, (t, _) in got], np.array([float(y > 0) for _, (_, y) in got])


def fit(docs: DataFrame, labels: DataFrame) -> LinearScorer:
    scorer = train(*training_rows(docs, labels))[0]
    release()
    return scorer


def score(docs: DataFrame, scorer: LinearScorer, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with a column ``into``, a probability of being toxic.

    Null and empty texts get the score of a text without any feature.  A
    column of that name that exists already is replaced.  No shuffle.
    """
    docs = docs.drop(into)
    place = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scores(batch.column(place).to_pylist(), scorer)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, into])

    return arrow_map(docs, work, StructType([*docs.schema.fields, StructField(into, DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Null and empty texts get the score of a text without any feature; a null
    doc_id is not held out.  Repeated rows are scored each for itself.  Without
    a labelled row, or if all labels are alike, every row gets one and the same
    score.  Other columns are ignored; an empty table gives no rows.
    """
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``; columns stay, whatever their names.

    Rows are judged by their text alone: null and empty texts, null ids and
    repeated rows as in :func:`classify`.
    """
    into = "_toxicity"
    while into in docs.columns:
        into += "_"
    scored = score(docs, fit(docs, labels), into=into)
    return scored.where(F.col(into) < threshold).drop(into)
