"""Second implementations and held-out rows for what SQL can't express; odd and empty tables through the pipeline."""

import hashlib
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import decontaminate, lang_id, quality, toxicity, weak

corpus_pipeline = pytest.importorskip("corpus_pipeline")
P = pytest.importorskip("public_tokenizers")
#: More rows than the other tests have, as a quarter is held out.
LARGE = "/root/testdata/sf0.1" if os.path.isdir("/root/testdata/sf0.1") else os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# --- held-out rows ---------------------------------------------------------------------------------


def held_out(spark, scored, column, answer):
    """(answered, true) of the labelled rows that no model has seen."""
    labels = spark.read.parquet(f"{LARGE}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").select(column, answer).collect()
    return np.array([tuple(r) for r in rows])


def test_quality_of_held_out_rows(spark):
    got = held_out(spark, quality.classify(spark.read.parquet(f"{LARGE}/documents.parquet")), "keep", "quality")
    keep, good = got.T
    assert len(got) > 200 and keep[good == 1].mean() >= 0.98 and (1 - keep[good == 0]).mean() >= 0.95


def test_toxicity_of_held_out_rows(spark):
    """Where there are few labels, few words of a language are seen often enough to be mined."""
    folder = "/root/testdata/check_s" if os.path.isdir("/root/testdata/check_s") else LARGE
    docs, labels = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "labels"))
    many = labels.count() > 15_000
    rows = toxicity.classify(docs, labels).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    predicted, toxic = np.array([tuple(r) for r in rows]).T
    assert len(toxic) > 200 and predicted[toxic == 1].mean() >= (0.97 if many else 0.4) and predicted[toxic == 0].mean() <= 0.01


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{LARGE}/documents.parquet")
    rows = lang_id.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").where("lang IS NOT NULL AND lang_pred <> 'und'").select("lang_pred", "lang").collect()
    assert len(rows) > 200 and sum(r.lang_pred == r.lang for r in rows) / len(rows) >= 0.97


# --- the label model of op10 -----------------------------------------------------------------------


def labelled(spark, most=2500):
    docs, labels = (spark.read.parquet(f"{LARGE}/{x}.parquet") for x in ("documents", "labels"))
    return toxicity.training_rows(docs, labels, sample=most)


def test_voters_overrule_labels(spark):
    """Of labels that are turned round, the posteriors of the votes turn most back."""
    texts, y = labelled(spark)
    rng = np.random.default_rng(1)
    turned = rng.random(len(y)) < 0.05
    wrong = np.where(turned, 1 - y, y)
    texts = toxicity._lower(texts)
    cast = toxicity.votes(texts, toxicity.gather(texts), wrong)
    model = weak.fit_label_model(cast, wrong.mean(), start=np.where(wrong > 0, 0.95, 0.05), weight=toxicity.KNOWN, discount=toxicity.DISCOUNT)
    posterior = model.posterior(cast) > 0.5
    assert (posterior == y)[turned].mean() > 0.85 and (posterior == wrong)[turned].mean() < 0.15


def test_random_voters_say_nothing(spark):
    _, y = labelled(spark)
    cast = np.random.default_rng(2).integers(-1, 2, (len(y), 12)).astype(np.int8)
    model = weak.fit_label_model(cast, y.mean(), start=np.where(y > 0, 0.95, 0.05), weight=toxicity.KNOWN, discount=toxicity.DISCOUNT)
    assert abs(((model.posterior(cast) > 0.5) == y).mean() - (1 - y.mean())) < 0.05


def test_counted_patterns_give_the_model_of_the_rows():
    rng = np.random.default_rng(3)
    cast = rng.integers(-1, 2, (600, quality.LABELLERS)).astype(np.int8)
    cast[:300] = cast[0]
    codes, n = np.unique(quality.encoded(cast), return_counts=True)
    assert (quality.encoded(quality.decoded(codes)) == codes).all()
    rows, counted = quality.estimate(cast, np.ones(600)), quality.estimate(quality.decoded(codes), n)
    assert np.allclose(rows.log_odds, counted.log_odds) and np.allclose(rows.correlation, counted.correlation) and abs(rows.prior - counted.prior) < 1e-9


# --- op7 by plain loops ----------------------------------------------------------------------------

UNITS = set(decontaminate.UNITS.split())


def canonical(text):
    """(token, value) of every word; the value is None for a literal."""
    out, last = [], None  # the word before: its match and whether it was a number
    for m in re.finditer("[0-9A-Za-z\x80-\U0010ffff]+", text):
        w, low = m[0], m[0].lower()
        number = w[0].isascii() and w[0].isdigit()
        gap = m.start() - last[0].end() if last else 99
        if number and last and last[1] and gap == 1 and text[m.start() - 1] in ".,:/-":
            out[-1] = ("<number>", (*out[-1][1], low))
        elif number:
            out.append(("<number>", (low,)))
        elif last and last[1] and gap <= 1 and low in UNITS:
            out.append(("<unit>", (low,)))
        elif len(w) > 1 and w[0].isupper() and ("a" <= w[1] <= "z" or w[1] >= "\x80") and m.start() >= 2 and text[m.start() - 1] == " " and text[m.start() - 2] not in ".!?:;\n\r\"'()[]-*#|":
            out.append(("<name>", (low,)))
        else:
            out.append((low, None))
        last = (m, number)
    return out


def windows(tokens, size):
    """(kind, content) -> positions: templates of enough literals, and words of few."""
    found = {}
    for i in range(len(tokens) - size + 1):
        part = tokens[i : i + size]
        literals = sum(v is None for _, v in part)
        if literals >= min(3, size):
            found.setdefault((False, tuple(t for t, _ in part)), []).append(i)
        if literals <= 3:
            found.setdefault((True, tuple((t,) if v is None else v for t, v in part)), []).append(i)
    return found


def brute_matches(docs, items):
    out = {}
    for item, text in items:
        own = canonical(text)
        if len(own) < 3:
            continue
        size = min(8, len(own))
        wanted = windows(own, size)
        total, every, half = sum(len(p) for (exact, _), p in wanted.items() if not exact), len(own) - size + 1, max(1, len(own) / 2)
        for doc, body in docs:
            tokens = canonical(body)
            seen = windows(tokens, size)
            pairs = [(p, q, exact) for (exact, c), ps in wanted.items() for q in seen.get((exact, c), ()) for p in ps]
            runs = {}
            for shift in {q - p for p, q, _ in pairs}:
                at = sorted({p for p, q, _ in pairs if q - p == shift})
                runs[shift] = {p: p - i - 1 for i, p in enumerate(at)}
            places = {}
            for p, q, exact in pairs:
                s = q - p
                for place in ((0, 0), (1, s), (2, s // half), (3, np.floor(s / half + 0.5)), (4, s, runs[s][p])):
                    places.setdefault(place, []).append((p, q, exact))
            for place, held in places.items():
                positions = {p for p, _, _ in held}
                templates = {p for p, _, exact in held if not exact}
                slots = [(own[p + j][1], tokens[q + j][1]) for p, q, _ in held for j in range(size) if own[p + j][1] is not None and tokens[q + j][1] is not None]
                counts = {}
                for a, b in slots:
                    counts.setdefault(a, {}).setdefault(b, 0)
                    counts[a][b] += 1
                consistency = sum(max(c.values()) for c in counts.values()) / len(slots) if slots else 1.0
                enough = lambda n, of: n >= min(3, of) and n >= 0.3 * of
                hit = len(positions) >= 25 if place[0] == 4 else total > 0 and enough(len(templates), total) or enough(len(positions), every)
                if hit and consistency >= 0.75:
                    exact = all(a == b for a, b in slots)
                    out[doc, item] = max(out.get((doc, item), (False, 0)), (exact, len(positions)))
    return {k: ("exact" if exact else "re-parameterised", n) for k, (exact, n) in out.items()}


def small_corpus(spark, sf_dir, most=60):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").collect()]
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text IS NOT NULL AND length(text) < 1500").orderBy("doc_id").limit(most).collect()
    rng = random.Random(4)
    rows = [(r.doc_id, r.text) for r in texts]
    for n, (_, text) in enumerate(items[:12]):
        words = text.split(" ")
        cut = rng.randrange(len(words))
        rows += [(10_000 + n, f"Before it all. {text} And after."), (20_000 + n, " ".join(words[:cut])), (30_000 + n, re.sub("[0-9]+", lambda m: str(int(m[0]) + 7), f"It says: {text}"))]
    return rows, items


@pytest.mark.parametrize("most", [10**6, 5000, 0])
def test_templates_equal_plain_loops(spark, sf_dir, most):
    rows, items = small_corpus(spark, sf_dir)
    more = "Tom has 12 apples and Ann Smith buys 30 kg of flour from Őrs Vezér for 3.50 euros, so how many apples has Tom after 4 days in Łódź?"
    items = [*items, (901, more), (902, "What is 17 + 25?"), (903, " ".join(str(i * 37 % 91) for i in range(40)))]
    other = more.replace("12", "19").replace("Ann Smith", "Eva Braun").replace("Łódź", "Štítnik").replace("3.50", "7")
    rows += [(91, f"See: {more}"), (92, other), (93, f"{more} {other}"), (94, "So What is 17 + 25? It is."), (95, "So What is 18 + 25? It is."), (96, f"x {items[-1][1]} y"), (97, other.replace("Tom after", "Jim after"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.kind, r.n_windows) for r in decontaminate.matches(docs, table, most=most).collect()}
    assert got == brute_matches(rows, items)
    assert {(91, 901), (92, 901), (94, 902), (96, 903)} <= set(got) and (95, 902) not in got


def test_items_with_one_id_and_documents_without(spark):
    first, second = ("the quick brown fox jumps over the lazy dog and runs away from it", "a slow green turtle walks under the busy bee and stays where it is now")
    items = spark.createDataFrame([(1, first), (1, second)], "item_id long, text string")
    rows = [(1, first), (2, second), (None, f"so {second} it is"), (None, "nothing of the kind is said here at all, not a word"), (3, "quite another text about other matters of no importance")]
    left = decontaminate.drop_contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items)
    assert sorted((str(r.doc_id), r.text) for r in left.collect()) == sorted([("3", rows[4][1]), ("None", rows[3][1])])


# --- the pipeline ----------------------------------------------------------------------------------


def brute_classes(rows, words, p):
    def shingles(text):
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])

    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= p * len(a | b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i, _ in sets}


BASE = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{12,})"""),
    ("access", r"AKIA[A-Z0-9]{14,}"),
    ("hex", r"[0-9a-f]{16,}"),
]


def test_pipeline_equals_plain_python(spark, tmp_path, sf_dir):
    """Each stage by a second implementation, on what the one before has kept."""
    tiktoken = pytest.importorskip("tiktoken")
    rows, items = small_corpus(spark, sf_dir, 100)
    rows += [(40_000 + i, t.replace(" the ", "  the ")) for i, t in rows[:15]]
    folder = str(tmp_path / "t")
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.read.parquet(f"{LARGE}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    kept = {r.doc_id: r.text for r in spark.createDataFrame(rows, "doc_id long, text string").collect()}
    scorer = toxicity.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    ids = list(kept)
    kept = {i: kept[i] for i, s in zip(ids, toxicity.scores([kept[i] for i in ids], scorer)) if s < toxicity.THRESHOLD}
    classes = brute_classes(sorted(kept.items()), 5, 80)
    kept = {i: t for i, t in kept.items() if classes[i] == i}
    found = {doc for doc, _ in brute_matches(list(kept.items()), items)}
    kept = {i: t for i, t in kept.items() if i not in found}
    assert 0 < len(found) and len(classes) < len(rows) + 1
    encoder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=corpus_pipeline.bpe.load_ranks(P.path(corpus_pipeline.VOCABULARY)), special_tokens={})
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(got) == set(kept)
    for i, text in kept.items():
        spans = sorted((m.start(), n, m.end(), kind) for n, (kind, rule) in enumerate(BASE) for m in re.finditer(rule, text))
        if any(x in text for x in ("gho_", "ghp_", "xox", "eyJ", "-----BEGIN")):
            continue  # the method's own rules are held to theirs elsewhere
        out, at, until = [], 0, 0
        for s, _, e, kind in spans:
            if s >= until:
                out += [text[at:s], f"[{kind}]"]
            at = until = max(until, e)
        clean = "".join(out) + text[at:]
        tokens = encoder.encode_ordinary(clean)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(tokens), hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest(), hashlib.sha256(clean.encode()).hexdigest())


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "long words all along the way " * 3000), (5, "a"), (5, "a"), (None, "no id here at all"), (None, None), (6, "ünï çødé 日本 🎉"), (7, "x" * 5000), (8, "same text here, as in the next row"), (9, "same text here, as in the next row")]


@pytest.mark.parametrize("empty", ["none", "labels", "benchmark", "documents", "all"])
def test_pipeline_of_odd_and_empty_tables(spark, tmp_path, empty):
    """Columns keep their names, even such as the stages use; rows without a text or an id stay."""
    folder, schema = str(tmp_path / "t"), DOCS + ", score double, component_id long, _toxicity string, tokens int, hash string"
    docs = [] if empty in ("documents", "all") else [(i, t, None, None, None, 1.0, 5, "t", 3, "h") for i, t in ODD]
    spark.createDataFrame(docs, schema).write.parquet(f"{folder}/documents.parquet")
    labels = [] if empty in ("labels", "all") else [(1, 1, 1), (5, None, 0), (None, 1, 1), (6, 0, None), (8, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [] if empty in ("benchmark", "all") else [(1, None), (None, "an item of no name and of no consequence to anyone"), (2, ""), (3, "tiny")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    table = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = corpus_pipeline.stored(stage(spark, table, folder), name)
        assert table.columns == spark.read.parquet(f"{folder}/documents.parquet").columns, name
    got = sorted(str(r.doc_id) for r in corpus_pipeline.run(spark, folder).collect())
    if not docs:
        assert got == []
    elif empty in ("labels",):
        assert got == sorted(["1", "2", "3", "4", "5", "6", "7", "8", "None", "None"])
    else:
        assert set(got) <= {"1", "2", "3", "4", "5", "6", "7", "8", "None"} and "9" not in got
