"""Secret scans with one deterministic automaton for all rules.

Rule regexes are parsed, turned into one NFA over bytes, made deterministic by
subset construction, minimised by partition refinement and stored as a
transition array over byte classes.  Many stretches of text step through the
array side by side, one byte each per step, so a batch is scanned once for all
rules.  A stretch begins after two bytes that lead every state back to the
start (as a letter that ends no keyword, then a space), so cutting there loses
no match; which pairs do so is read off the transition array.  A stretch that is
long, as an encoded file, is cut anywhere: what its pieces make of every state
is worked out first, and gives the states that they begin in.

The automaton reports where strings of a rule end.  The last end of a row of
them is the end of a match; from there the minimal automaton of the reversed rule
steps back to its leftmost start, and one of the rule's prefix gives the start of
the value, whose length is checked.  Counted repeats multiply in the subset
construction of all rules, so that one counts to 8 or less, and the automata
of the single rules to the end.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map
from .tokens import groups


@dataclass(frozen=True)
class Rule:
    """``prefix`` and ``value``: a match is both; ``least``: bytes that its value
    needs; ``scan``: what ends where a match does, with lower counts or the end of it
    alone, for the automaton of all rules; ``rest``: how a span goes on after a match, over line ends too, within its text.

    Python's leftmost match has to be the longest from its start, and to go on
    with every byte that could prolong it.
    """

    kind: str
    prefix: str
    value: str
    least: int = 1
    scan: str = ""
    rest: str = ""

    @property
    def spans(self) -> str:
        """The match as one regex, its value a group."""
        return f"{self.prefix}({self.value})"


#: The rest of a PEM key: to its end mark, or as far as its base64 goes where there is none before
#: the next key or the end.  Line ends may be escaped, lines quoted or indented.
_GAP = r"""(?:[\s"'+,;>|#*]|\\[nrt])*"""
PEM = (
    r"(?:(?!-----BEGIN )[\s\S])*?-----END [A-Z ]*PRIVATE KEY-----"
    rf"|(?:{_GAP}(?:Proc-Type|DEK-Info|Version|Comment):[^\n\\]*)*(?:{_GAP}(?:\\/|[A-Za-z0-9+/=]){{16,}})*"
    rf"(?:{_GAP}[A-Za-z0-9+/]+={{1,2}}|(?:[ \t>|#*]*\r?\n|\\n)[ \t>|#*]*[A-Za-z0-9+/]+[ \t]*(?=[\r\n\\]|\Z))?"
)


#: The rules, the three base ones first, in the order of their listing.
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
RULES = (
    Rule("assign", _ASSIGN, r"[A-Za-z0-9+/_.=-]+", 12),
    Rule("access", "", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", "", r"[0-9a-f]+", 16, r"[0-9a-f]{8,}"),
    Rule("private_key", "", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", rest=PEM),
    Rule("github", "", r"gh[oprsu]_[A-Za-z0-9]{36,}", scan=r"gh[oprsu]_[A-Za-z0-9]+"),
    Rule("slack", "", r"xox[abprs]-[A-Za-z0-9-]{10,}", scan=r"xox[abprs]-[A-Za-z0-9-]+"),
    Rule("jwt", "", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", scan=r"\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)


class _Parser:
    """A regex of literals, classes, groups, |, ?, *, + and {m,n} as an NFA over bytes."""

    def __init__(self) -> None:
        self.eps: list[list[int]] = []
        self.steps: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.eps.append([])
        self.steps.append(None)
        return len(self.eps) - 1

    def compile(self, pattern: str, backwards: bool = False) -> tuple[int, int]:
        self.p, self.i, self.backwards = pattern, 0, backwards
        tree = self.alternatives(False)
        if self.i < len(pattern):
            raise ValueError(f"unbalanced ) in {pattern!r}")
        return self.build(tree)

    def alternatives(self, fold: bool):
        options = [self.sequence(fold)]
        while self.i < len(self.p) and self.p[self.i] == "|":
            self.i += 1
            options.append(self.sequence(fold))
        return ("or", options)

    def sequence(self, fold: bool):
        items = []
        while self.i < len(self.p) and self.p[self.i] not in "|)":
            item = self.atom(fold)
            while self.i < len(self.p) and self.p[self.i] in "?*+{":
                c = self.p[self.i]
                if c == "{":
                    end = self.p.index("}", self.i)
                    low, comma, high = self.p[self.i + 1 : end].partition(",")
                    bounds = (int(low), int(high) if high else (None if comma else int(low)))
                    self.i = end + 1
                else:
                    bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
                    self.i += 1
                item = ("repeat", item, *bounds)
            items.append(item)
        return ("seq", items)

    def atom(self, fold: bool):
        c = self.p[self.i]
        if c == "(":
            self.i += 1
            if self.p.startswith("?i:", self.i):
                self.i, fold = self.i + 3, True
            elif self.p.startswith("?:", self.i):
                self.i += 2
            tree = self.alternatives(fold)
            if self.p[self.i : self.i + 1] != ")":
                raise ValueError(f"unbalanced ( in {self.p!r}")
            self.i += 1
            return tree
        if c == "[":
            self.i += 1
            found: set[int] = set()
            negated = self.p[self.i] == "^"
            self.i += negated
            while self.p[self.i] != "]":
                low = self.char()
                if self.p[self.i] == "-" and self.p[self.i + 1] != "]":
                    self.i += 1
                    found.update(range(low, self.char() + 1))
                else:
                    found.add(low)
            self.i += 1
            return ("byte", self.folded(frozenset(range(256)) - found if negated else found, fold))
        if c == ".":
            self.i += 1
            return ("byte", frozenset(range(256)) - {10})
        return ("byte", self.folded({self.char()}, fold))

    def char(self) -> int:
        c = self.p[self.i]
        if c == "\\":
            c = self.p[self.i + 1]
            if c == "x":
                value = int(self.p[self.i + 2 : self.i + 4], 16)
                self.i += 4
                return value
            if c.isalnum():
                raise ValueError(f"\\{c} is not supported")
            self.i += 1
        self.i += 1
        if ord(c) > 127:
            raise ValueError("rules are over ASCII")
        return ord(c)

    @staticmethod
    def folded(found, fold: bool) -> frozenset[int]:
        return frozenset(found) | {ord(x) for b in found if b < 128 for x in chr(b).swapcase()} if fold else frozenset(found)

    def build(self, tree) -> tuple[int, int]:
        kind = tree[0]
        if kind == "byte":
            a, b = self.state(), self.state()
            self.steps[a] = (tree[1], b)
            return a, b
        if kind == "seq":
            first = last = self.state()
            for item in tree[1][::-1] if self.backwards else tree[1]:
                a, b = self.build(item)
                self.eps[last].append(a)
                last = b
            return first, last
        if kind == "or":
            a, b = self.state(), self.state()
            for item in tree[1]:
                x, y = self.build(item)
                self.eps[a].append(x)
                self.eps[y].append(b)
            return a, b
        _, item, low, high = tree
        first = last = self.state()
        for _ in range(low):
            a, b = self.build(item)
            self.eps[last].append(a)
            last = b
        if high is None:
            a, b = self.build(item)
            end = self.state()
            self.eps[last] += [a, end]
            self.eps[b] += [a, end]
            return first, end
        end = self.state()
        for _ in range(high - low):
            a, b = self.build(item)
            self.eps[last] += [a, end]
            last = b
        self.eps[last].append(end)
        return first, end


@dataclass(frozen=True)
class Automaton:
    """``table[state * classes + classes_of[byte]]`` is the next state times classes.

    States are numbered so that those from ``accepting`` on accept; ``rules``
    has their bit sets.  State 0 is the start; ``resets[c, d]`` tells that bytes
    of classes c and d lead every state there.
    """

    classes_of: bytes
    classes: int
    table: np.ndarray
    accepting: int
    rules: np.ndarray
    resets: np.ndarray

    @property
    def states(self) -> int:
        return len(self.table) // self.classes


def compile_rules(patterns: Sequence[str], search: bool = True, backwards: bool = False) -> Automaton:
    """Subset construction and minimisation of the search for any of ``patterns``.

    Without ``search`` strings are read from their start, ``backwards`` from
    their end; what can't become a match any more is then state -1 times classes.
    """
    nfa = _Parser()
    parts = [nfa.compile(p, backwards) for p in patterns]
    n = len(nfa.eps)
    closures: list[frozenset[int]] = []
    for s in range(n):
        seen, todo = {s}, [s]
        while todo:
            for t in nfa.eps[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        closures.append(frozenset(x for x in seen if nfa.steps[x] or any(x == e for _, e in parts)))
    # bytes that every step treats alike are one class
    sets = list({step[0] for step in nfa.steps if step})
    groups: dict[tuple, int] = {}
    classes_of = bytes(groups.setdefault(tuple(b in x for x in sets), len(groups)) for b in range(256))
    sample = [classes_of.index(k) for k in range(len(groups))]
    begin = frozenset().union(*(closures[a] for a, _ in parts))
    ends = {e: i for i, (_, e) in enumerate(parts)}
    # per NFA state and class: where it leads
    leads = [[closures[step[1]] if step and sample[k] in step[0] else None for k in range(len(groups))] for step in nfa.steps]
    index, order, rows = {begin: 0}, [begin], []
    for now in order:
        row = []
        for k in range(len(groups)):
            # the search may begin anew at every byte
            after = (begin if search else frozenset()).union(*(x for s in now if (x := leads[s][k])))
            if after not in index:
                index[after] = len(order)
                order.append(after)
            row.append(index[after])
        rows.append(row)
    delta = np.array(rows, np.int64)
    masks = np.array([sum(1 << ends[s] for s in now if s in ends) for now in order], np.int64)
    # Moore's refinement: split blocks until all successors agree
    _, block = np.unique(masks, return_inverse=True)
    while True:
        rows = np.ascontiguousarray(np.column_stack([block, block[delta]]).astype(np.int32))
        _, finer = np.unique(rows.view(f"V{rows.shape[1] * 4}").reshape(-1), return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    kept = np.unique(block, return_index=True)[1]
    # the start first, accepting states last
    rank = sorted(range(len(kept)), key=lambda b: (bool(masks[kept[b]]), b != block[0], b))
    number = np.empty(len(kept), np.int64)
    number[rank] = np.arange(len(kept))
    small = number[block[delta[kept[rank]]]]
    small_masks = masks[kept[rank]]
    if not search:
        small = np.where(number[block[index[frozenset()]]] == small, -1, small) if frozenset() in index else small
    resets = np.array([[not small[small[:, c], d].any() for d in range(len(groups))] for c in range(len(groups))])
    return Automaton(classes_of, len(groups), (small * len(groups)).astype(np.int32).reshape(-1), int((small_masks == 0).sum()), small_masks, resets)


@functools.lru_cache(maxsize=8)
def automaton(rules: tuple[Rule, ...] = RULES) -> Automaton:
    return compile_rules([r.scan or r.prefix + r.value for r in rules])


class _Walk:
    """An automaton of one rule, for the few places that the scan reports."""

    def __init__(self, pattern: str, backwards: bool) -> None:
        a = compile_rules([pattern], search=False, backwards=backwards)
        self.classes_of, self.table, self.limit = a.classes_of, a.table.tolist(), a.accepting * a.classes

    def last(self, data: bytes, places: range) -> int | None:
        """The last of ``places`` whose byte completes a match."""
        table, classes_of, limit, state, found = self.table, self.classes_of, self.limit, 0, None
        for at in places:
            state = table[state + classes_of[data[at]]]
            if state < 0:
                break
            if state >= limit:
                found = at
        return found


@functools.lru_cache(maxsize=8)
def _walks(rules: tuple[Rule, ...]) -> list[tuple[_Walk, _Walk | None]]:
    """For each rule the way back to the start of a match, and on to the start of its value."""
    return [(_Walk(r.prefix + r.value, True), _Walk(r.prefix, False) if r.prefix else None) for r in rules]


#: Bytes of a piece of a stretch, and bytes after which states are looked at for the few that are left.
PIECE, SETTLED = 4096, 32


def _states(a: Automaton, kinds: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Pieces x states: the state that each piece leads each state to (times classes)."""
    out = np.empty((len(starts), a.states), np.int32)
    for low in range(0, len(starts), 256):
        begin, size = starts[low : low + 256], lengths[low : low + 256]
        state = np.repeat((np.arange(a.states, dtype=np.int32) * a.classes)[None], len(begin), 0)
        first = min(SETTLED, int(size.min()))
        for step in range(first):
            state = a.table[state + kinds[begin + step][:, None]]
        # by now most states have become one: go on with the different ones of each piece
        order = np.argsort(state, axis=1, kind="stable")
        ranked = np.take_along_axis(state, order, 1)
        new = np.ones(state.shape, bool)
        new[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
        place = np.cumsum(new, 1) - 1
        few = np.zeros((len(begin), int(place.max()) + 1), np.int32)
        np.put_along_axis(few, place, ranked, 1)
        for step in range(first, int(size.max())):
            live = size > step
            few[live] = a.table[few[live] + kinds[begin[live] + step][:, None]]
        which = np.empty_like(place)
        np.put_along_axis(which, order, place, 1)
        out[low : low + 256] = np.take_along_axis(few, which, 1)
    return out


def accepted(a: Automaton, kinds: np.ndarray, resets: np.ndarray, lanes: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """Ends (exclusive) in ``kinds``, the classes of some bytes, at which some rule
    accepts, with their bit sets.  At ``resets``, the last of them the end, no
    match is under way."""
    n = len(kinds)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # lanes of about equal length that end at resets
    cuts = np.searchsorted(resets, np.linspace(0, n, min(lanes, max(1, n // 256)) + 1)[1:])
    stops = np.unique(resets[np.minimum(cuts, len(resets) - 1)])
    starts = np.concatenate([[0], stops[:-1]])
    begins = np.zeros(len(starts), np.int32)
    if (stops - starts).max() > 2 * PIECE:
        # a long one in pieces; the state carries over from one to the next
        pieces = np.maximum(1, (stops - starts) // PIECE)
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.repeat(starts, pieces) + within * PIECE
        ends = np.append(starts[1:], n)
        begins = np.zeros(len(starts), np.int32)
        cut = np.flatnonzero(np.append(within[1:] > 0, False))
        leads = _states(a, kinds, starts[cut], ends[cut] - starts[cut])
        for row, k in enumerate(cut.tolist()):
            begins[k + 1] = leads[row, begins[k] // a.classes]
        stops = ends
    by_length = np.argsort(starts - stops, kind="stable")
    starts, lengths, state = starts[by_length], (stops - starts)[by_length], begins[by_length]
    limit = a.accepting * a.classes
    at, what = [], []
    live = len(starts)
    for step in range(int(lengths[0])):
        while live and lengths[live - 1] <= step:
            live -= 1
        state = a.table[state[:live] + kinds[starts[:live] + step]]
        if (hit := state >= limit).any():
            at.append(starts[:live][hit] + step + 1)
            what.append(a.rules[state[hit] // a.classes])
    if not at:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(at), np.concatenate(what)


def _resets(a: Automaton, kinds: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """Places after two bytes that lead every state to the start, and the end; a block at a time."""
    leads, out = a.resets.reshape(-1), []
    for low in range(0, max(0, len(kinds) - 1), block):
        part = kinds[low : low + block + 1].astype(np.int16)
        out.append(np.flatnonzero(leads[part[:-1] * a.classes + part[1:]]) + low + 2)
    found = np.concatenate(out) if out else np.empty(0, np.int64)
    return found if len(found) and found[-1] == len(kinds) else np.append(found, len(kinds))


def spans_of(texts: Sequence[str], rules: tuple[Rule, ...] = RULES, a: Automaton | None = None) -> dict[int, list[tuple[int, int, int]]]:
    """For texts with secrets: their index, and (start, rule, end) in code points, sorted."""
    a = a or automaton(rules)
    walks = _walks(rules)
    rests = [re.compile(r.rest.encode()) if r.rest else None for r in rules]
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    joined = b"\n".join(raw) + b"\n"
    if not a.resets[:, a.classes_of[10]].all():
        raise ValueError("a rule matches line ends; texts can't be joined by them")
    kinds = np.frombuffer(joined.translate(a.classes_of), np.uint8)
    ends, masks = accepted(a, kinds, _resets(a, kinds))
    if not len(ends):
        return {}
    begins = np.concatenate([[0], np.cumsum([len(x) + 1 for x in raw])])
    found: dict[int, list[tuple[int, int, int]]] = {}
    for i, r in enumerate(rules):
        own = np.sort(ends[masks >> i & 1 == 1])
        # the last of each row of ends
        own = own[np.append(own[1:] != own[:-1] + 1, True)] if len(own) else own
        rows = np.searchsorted(begins, own, side="right") - 1
        rows -= begins[rows] == own  # an end at the begin of a text would be the line end before it
        back, on = walks[i]
        done = 0
        for end, row in zip(own.tolist(), rows.tolist()):
            begin = int(begins[row])
            low = max(done, begin)
            if end <= low or (start := back.last(joined, range(end - 1, low - 1, -1))) is None:
                continue
            value = start if on is None else on.last(joined, range(start, end)) + 1
            done = end
            if end - value >= r.least:
                if rests[i] and (rest := rests[i].match(joined, end, int(begins[row + 1]) - 1)):
                    done = rest.end()
                found.setdefault(row, []).append((start - begin, i, done - begin))
    out = {}
    for row in sorted(found):
        spans = found[row]
        if len(raw[row]) != len(texts[row]):  # bytes to code points
            inner = np.flatnonzero((np.frombuffer(raw[row], np.uint8) & 0xC0) == 0x80)
            points = np.array([(s, e) for s, _, e in spans])
            points -= np.searchsorted(inner, points)
            spans = [(s, i, e) for (s, e), (_, i, _) in zip(points.tolist(), spans)]
        out[row] = sorted(spans)
    return out


def _grouped(texts: Sequence[str | None], rules: tuple[Rule, ...], a: Automaton) -> dict[int, list[tuple[int, int, int]]]:
    """The spans of many texts, a group of bounded size at a time."""
    texts, out = [x or "" for x in texts], {}
    for low, high in groups(texts):
        out |= {low + row: spans for row, spans in spans_of(texts[low:high], rules, a).items()}
    return out


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, spans) of every row; spans: array of (kind, start, end) by start, then rule.

    Offsets are in code points, ends exclusive; spans of different kinds may
    overlap.  A null or empty text has no spans.  No shuffle; repeated rows are
    scanned each for itself; texts are scanned in groups of about half a million characters,
    a longer one alone.  Other columns are ignored; an empty table gives no rows.
    """
    a = automaton(rules)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _grouped(batch.column(1).to_pylist(), rules, a)
            spans = [[{"kind": rules[i].kind, "start": s, "end": e} for s, i, e in found.get(row, ())] for row in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, SPANS)], names=["id", "spans"])

    kind = docs.schema[id].dataType.simpleString()
    return arrow_map(docs.select(F.col(id), F.col(text)), work, f"id {kind}, spans array<struct<kind:string,start:int,end:int>>").withColumnRenamed("id", id)


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def redact(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, mask: str = "[{}]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by its kind; other columns stay.

    Overlapping spans become one, named after the first.  Null stays null, and
    so does every other column, whatever its name.
    """
    a = automaton(rules)
    place = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for row, spans in _grouped(texts, rules, a).items():
                parts, at, until = [], 0, 0
                for s, i, e in spans:
                    if s >= until:
                        parts += [texts[row][at:s], mask.format(rules[i].kind)]
                    at = until = max(until, e)
                texts[row] = "".join(parts) + texts[row][at:]
            yield pa.RecordBatch.from_arrays([*batch.columns[:place], pa.array(texts, pa.string()), *batch.columns[place + 1 :]], schema=batch.schema)

    return arrow_map(docs, work, docs.schema)


def joined(spans: Column, kinds: Sequence[str] | None = None) -> Column:
    """``kind:start:end`` of the spans (of ``kinds``), comma-joined."""
    if kinds is not None:
        spans = F.filter(spans, lambda x: x["kind"].isin(list(kinds)))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """The columns that the query returns, from what :func:`scan` returns."""
    base = [r.kind for r in RULES[:3]]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        id,
        *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(joined(F.col("spans"), base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
