"""Language identification by a byte convolutional network.

Bytes of lower-cased text become symbols; filters of widths 2, 3 and 4 over
their embeddings, rectified, max-pooled over a window of fixed length, and a
softmax.  The network is trained in numpy on windows of labelled rows.

A filter's response is a sum of what each of its bytes contributes, so for
prediction the filters are folded into tables by pairs of symbols: a few
lookups and additions a byte.  Every window of a text is scored; a text's
probabilities are the mean over its windows, weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, bounded_sample, held_out, not_held_out, release

#: Bytes of a window.
WINDOW = 256
#: Bounds of the training sample: labelled rows, bytes read of each, windows of each.
SAMPLE, LONGEST, EACH = 4000, 65_536, 2
WIDTHS, FILTERS, EMBED = (2, 3, 4), 16, 8
#: A letter by Unicode's categories: numbers such as ², ½ and Ⅷ are none.
_LETTER = regex.compile(r"\p{L}")


def _symbols() -> np.ndarray:
    """The symbol of each byte: one each for letters, bytes of UTF-8, white space, digits and the rest."""
    out = np.full(256, 2, np.uint8)
    out[[9, 10, 11, 12, 13, 32]] = 0
    out[48:58] = 1
    out[97:123] = np.arange(3, 29)
    out[128:192] = np.arange(29, 93)
    out[192:224] = np.arange(93, 125)
    out[224:240] = 125
    out[240:] = 126
    return out


SYMBOL = _symbols()
SYMBOLS = 127


def windows(texts: Sequence[str], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols (n x size, padded with white space), the text of each window, its bytes."""
    raw = [x.lower().encode("utf-8", "surrogatepass") for x in texts]
    data = b"".join(x + b" " * (-len(x) % size) for x in raw)
    counts = np.array([-(-len(x) // size) for x in raw], np.int64)
    row = np.repeat(np.arange(len(raw)), counts)
    used = np.full(len(row), size, np.int64)
    if len(row):
        last = np.cumsum(counts)[counts > 0] - 1
        used[last] -= np.array([-len(x) % size for x in raw], np.int64)[counts > 0]
    return SYMBOL[np.frombuffer(data, np.uint8)].reshape(-1, size), row, used


@dataclass
class Network:
    langs: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]  # width x EMBED x FILTERS
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Max-pooled responses, and where they were."""
        e = self.embed[x]
        parts, where = [], []
        for w, b in zip(self.filters, self.bias):
            n = x.shape[1] - len(w) + 1
            response = sum(e[:, k : k + n] @ w[k] for k in range(len(w))) + b
            at = response.argmax(1)
            where.append(at)
            parts.append(np.take_along_axis(response, at[:, None], 1)[:, 0])
        return np.maximum(np.concatenate(parts, 1), 0), where

    def tables(self) -> list[list[np.ndarray]]:
        """For each width: contributions of pairs of symbols, and of a last single one."""
        out = []
        for w, b in zip(self.filters, self.bias):
            single = [self.embed @ w[k] for k in range(len(w))]
            parts = [(single[k][:, None] + single[k + 1][None]).reshape(-1, FILTERS) for k in range(0, len(w) - 1, 2)]
            parts[0] = parts[0] + b
            out.append([np.ascontiguousarray(p, np.float32) for p in parts + ([single[-1]] if len(w) % 2 else [])])
        return out

    def probabilities(self, x: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """Softmax of every window; a few windows at a time, so that all stays in a cache."""
        out = np.empty((len(x), len(self.langs)))
        for low in range(0, len(x), 32):
            part = x[low : low + 32].astype(np.int32)
            pairs = part[:, :-1] * SYMBOLS + part[:, 1:]
            pooled = []
            for width, table in zip(WIDTHS, tables):
                n = x.shape[1] - width + 1
                response = table[0].take(pairs[:, :n], 0)
                if width >= 4:
                    response += table[1].take(pairs[:, 2 : 2 + n], 0)
                if width % 2:
                    response += table[-1].take(part[:, width - 1 : width - 1 + n], 0)
                pooled.append(response.max(1))
            z = np.maximum(np.concatenate(pooled, 1), 0) @ self.out + self.out_bias
            z = np.exp(z - z.max(1, keepdims=True))
            out[low : low + 32] = z / z.sum(1, keepdims=True)
        return out


def train(texts: Sequence[str], langs: Sequence[str], epochs: int = 10, rate: float = 0.004, seed: int = 7) -> Network | None:
    """Fit the network; None without any labelled text."""
    names = sorted(set(langs))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    xs, ys = [], []
    for text, lang in zip(texts, langs):
        x, _, used = windows([text])
        for k in rng.permutation(len(x))[:EACH]:
            # short texts have to be told apart as well
            cut = int(rng.integers(12, WINDOW + 1)) if rng.random() < 0.5 else WINDOW
            row = x[k].copy()
            row[min(cut, int(used[k])) :] = 0
            xs.append(row)
            ys.append(names.index(lang))
    if not xs:
        return None
    x, y = np.stack(xs), np.array(ys)
    share = np.bincount(y, minlength=len(names))
    balance = (len(y) / (len(names) * np.maximum(share, 1))) ** 0.5
    net = Network(
        names,
        rng.normal(0, 0.5, (SYMBOLS, EMBED)).astype(np.float32),
        [rng.normal(0, (2 / (w * EMBED)) ** 0.5, (w, EMBED, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(names))).astype(np.float32),
        np.zeros(len(names), np.float32),
    )
    params = [net.embed, *net.filters, *net.bias, net.out, net.out_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step, total = 0, epochs * -(-len(x) // 64)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for low in range(0, len(x), 64):
            ids = order[low : low + 64]
            xb, yb = x[ids], y[ids]
            pooled, where = net.pooled(xb)
            z = pooled @ net.out + net.out_bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(ids)), yb] -= 1
            p *= (balance[yb] / len(ids))[:, None]
            g_out, g_bias = pooled.T @ p, p.sum(0)
            g_pool = (p @ net.out.T) * (pooled > 0)
            g_embed = np.zeros_like(net.embed)
            g_filters, g_biases = [], []
            for i, (w, at) in enumerate(zip(net.filters, where)):
                g = g_pool[:, i * FILTERS : (i + 1) * FILTERS]
                grad = np.empty_like(w)
                for k in range(len(w)):
                    # only the place of each maximum has a gradient
                    seen = np.take_along_axis(xb, at + k, 1)
                    grad[k] = np.einsum("bfd,bf->df", net.embed[seen], g)
                    np.add.at(g_embed, seen, g[:, :, None] * w[k].T[None])
                g_filters.append(grad)
                g_biases.append(g.sum(0))
            step += 1
            lr = rate * (1 - step / (total + 1))
            for p_, g_, m, v in zip(params, [g_embed, *g_filters, *g_biases, g_out, g_bias], first, second):
                m += 0.1 * (g_ - m)
                v += 0.001 * (g_ * g_ - v)
                p_ -= (lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def predict(texts: Sequence[str | None], net: Network | None, tables: list[list[np.ndarray]] | None = None) -> tuple[list[str], np.ndarray]:
    """Language and score of every text; `und` and 0 without a letter."""
    langs, score = ["und"] * len(texts), np.zeros(len(texts))
    todo = [i for i, x in enumerate(texts) if x and _LETTER.search(x)]
    if net is None or not todo:
        return langs, score
    tables = tables or net.tables()
    x, row, used = windows([texts[i] for i in todo])
    p = net.probabilities(x, tables) * used[:, None]
    total = np.zeros((len(todo), len(net.langs)))
    np.add.at(total, row, p)
    total /= total.sum(1, keepdims=True)
    best = total.argmax(1)
    for k, i in enumerate(todo):
        langs[i] = net.langs[best[k]]
    score[todo] = total.max(1)
    return langs, np.clip(score, 0, 1)


def fit(docs: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> Network | None:
    """Train on at most ``sample`` labelled rows that are not held out, those of least hash."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & not_held_out())
    ids = bounded_sample(known.select("doc_id"), ["doc_id"], sample)
    rows = known.join(F.broadcast(ids.distinct()), "doc_id").where(F.octet_length("text") <= longest)
    got = sorted(zip(*(c.to_pylist() for c in rows.select("doc_id", "lang", "text").toArrow().columns)))[:sample]
    net = train([t for _, _, t in got], [lang for _, lang, _ in got])
    release()
    return net


def identify(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs``.

    Fits a network first unless one is given.  Only the text enters a
    prediction.  Null texts and texts without a letter are `und`, score 0, as
    is everything if no row has a language to learn from.  No shuffle.
    """
    net = net or fit(docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables() if net else None
        for batch in batches:
            langs, score = [], []
            for low in range(0, batch.num_rows, 128):
                a, b = predict(batch.column(1).slice(low, 128).to_pylist(), net, tables)
                langs += a
                score.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(np.concatenate(score) if score else [], pa.float64())], names=["doc_id", "lang_pred", "score"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = arrow_map(docs.select("doc_id", "text"), work, f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
