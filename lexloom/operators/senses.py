"""Definition facts, their clusters, and near duplicates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T

#: Weights of the scoring model.
RIGHTS = {"public-domain": 35, "open": 28, "documented-unclear": -18}
QUALITY = {"học thuật": 30, "cộng đồng": 16, "tổng hợp": 8, "OCR cần soát": 2}
ENTITY_RISKS = ("proper-name-candidate", "place-name-candidate", "domain-or-encyclopedic-candidate", "punctuation-headword-candidate")
STATUSES = ("auto_accepted", "machine_clustered", "machine_retained", "needs_review", "quarantined", "entity_or_encyclopedic", "reference_non_vi")
NEAR, CANDIDATE, SAFE, MIN_TOKENS = 0.82, 0.94, 0.98, 4


def _weight(table: dict[str, int], key: Column) -> Column:
    out = F.lit(0)
    for name, value in table.items():
        out = F.when(key == name, F.lit(value)).otherwise(out)
    return out


def base_score(rights: Column, quality: Column) -> Column:
    return _weight(RIGHTS, rights) + _weight(QUALITY, quality)


def risk_tags(m: Column, key: Column, rights: Column, labels: Column, confidence: Column, pos: Column, language: Column) -> Column:
    """The distinct rule tags of a definition with the clean meaning ``m``, in the order of the rules."""

    def tag(when: Column, name: str) -> Column:
        return F.when(when, F.lit(name))

    rules = F.array_compact(
        F.array(
            tag((rights == "documented-unclear") | F.array_contains(labels, "documented-unclear"), "documented-unclear-source"),
            tag(confidence < 0.75, "low-confidence"),
            tag(F.size(pos) == 0, "missing-pos"),
            tag(F.exists(pos, lambda p: p.rlike("^[A-Z]$")), "raw-pos-code"),
            tag(language != "vi", "non-vi-definition"),
            tag((F.length(m) < 12) | (T.token_count(key) < 2), "too-short"),
            tag(F.length(m) > 500, "too-long"),
            tag(m.rlike(r"^ *[0-9]+[.)] +") | m.rlike(r"^ *[0-9]+[.)]? *$"), "leading-sense-marker"),
        )
    )
    return F.array_distinct(F.concat(rules, F.filter(labels, lambda x: x.isin(*ENTITY_RISKS))))


def has_hard_risk(tags: Column) -> Column:
    return F.exists(tags, lambda t: t.isin(*ENTITY_RISKS))


def canonical_score(rights: Column, quality: Column, language: Column, confidence: Column, review: Column, labels: Column, tags: Column) -> Column:
    penalty = F.aggregate(
        tags,
        F.lit(0),
        lambda s, t: s
        + F.when(t.isin(*ENTITY_RISKS), 45).when(t == "documented-unclear-source", 25).when(t == "low-confidence", 12).when(t == "non-vi-definition", 15).otherwise(4),
    )
    score = base_score(rights, quality) + F.when(language == "vi", 18).otherwise(-20) + confidence * 25
    score = score + F.when(review == "human-reviewed", 20).when(review == "machine-checked", 6).otherwise(0) + F.when(F.size(labels) > 0, 2).otherwise(0)
    return F.round(score - penalty, 4)


def definition_facts(defs: DataFrame) -> DataFrame:
    """One row for each definition with its key, tokens, ids, tags, score and trust.

    Needs word, meaning, source, entry_id, definition_index, record_hash,
    language, review_status, confidence, labels, part_of_speech, rights and
    quality; ``clean`` and ``key`` are taken as they are where a reader has made
    them, once for each definition.  Narrow: no shuffle.
    """
    keyed = defs if "clean" in defs.columns else defs.withColumn("clean", T.clean(F.col("meaning")))
    keyed = keyed if "key" in defs.columns else keyed.withColumn("key", T.key_of_clean(F.col("clean")))
    keyed = keyed.withColumn("tokens", T.content_tokens(F.col("key"))).withColumn(
        "risk_tags", risk_tags(F.col("clean"), F.col("key"), F.col("rights"), F.col("labels"), F.col("confidence"), F.col("part_of_speech"), F.col("language"))
    )
    raw = F.concat_ws(":", F.lower(T.clean(F.col("word"))), "source", F.coalesce(F.col("entry_id").cast("string"), F.lit("")), "record_hash", "definition_index", "key")
    uid = F.concat_ws(":", F.col("entry_id").cast("string"), "definition_index", "source", "record_hash")
    return (
        keyed.drop("clean").withColumn("sense_id", F.concat(F.lit("sense-"), T.slug(F.col("word")), F.lit("-"), T.short_hash(raw)))
        .withColumn("definition_uid", F.concat(F.lit("def-"), T.short_hash(uid)))
        .withColumn("hard_risk", has_hard_risk(F.col("risk_tags")))
        .withColumn(
            "score",
            canonical_score(*[F.col(c) for c in ("rights", "quality", "language", "confidence", "review_status", "labels", "risk_tags")]),
        )
        .withColumn("trusted", (F.col("language") == "vi") & F.col("rights").isin("open", "public-domain") & (F.col("confidence") >= 0.75) & ~F.col("hard_risk"))
    )


def brief(facts: DataFrame, *more: str | Column) -> DataFrame:
    """What clusters are made of: hashes, lengths and marks in place of a definition's texts, and what is wanted ``more``.

    A row has a tenth of the room of a fact, so that it is dealt, sorted and kept in its place.
    """
    has = lambda tag: F.array_contains("risk_tags", tag)
    own = ["sense_id", "source", "confidence", "score", "hard_risk", "trusted"]
    return facts.select(
        *_names(),
        *own,
        (F.col("language") == "vi").alias("vi"),
        F.length("meaning").alias("size"),
        F.length("key").alias("key_size"),
        F.size("tokens").alias("n_tokens"),
        has("documented-unclear-source").alias("unclear"),
        has("low-confidence").alias("low"),
        has("missing-pos").alias("no_pos"),
        *[c for c in more if not isinstance(c, str) or c not in own],
    )


def _names() -> list[Column]:
    """What a cluster is found and named by."""
    exact = T.short_hash(F.concat_ws(":", "word", "key"))
    return [*key_ids(), (F.col("key") != "").alias("keyed"), T.slug(F.col("word")).alias("slug"), exact.alias("exact_hash")]


def clustered(facts: DataFrame) -> DataFrame:
    """``facts``, whole or as :func:`brief` gives them, with cluster_id and cluster_type: equal keys of a headword
    from two sources or more are one exact cluster, any other fact is a singleton.

    One aggregation and a join back on the same keys, both by hashes of them.
    """
    rows = facts if "exact_hash" in facts.columns else facts.select("*", *_names())
    source = F.when(F.col("source").isNotNull(), F.xxhash64("source"))
    groups = rows.where("keyed").groupBy("k1", "k2").agg(F.min(source).alias("_least"), F.max(source).alias("_most"))
    joined = rows.join(groups.where("_least <> _most").select("k1", "k2", F.lit(True).alias("_exact")), ["k1", "k2"], "left")
    is_exact = F.coalesce("_exact", F.lit(False))
    name = F.when(is_exact, F.concat(F.lit("cluster-exact-"), "slug", F.lit("-"), "exact_hash")).otherwise(F.concat(F.lit("cluster-single-"), "slug", F.lit("-"), T.short_hash(F.col("sense_id"))))
    named = joined.withColumn("cluster_type", F.when(is_exact, "exact").otherwise("singleton")).withColumn("cluster_id", name)
    return named.drop("_exact", "k1", "k2", "keyed", "slug", "exact_hash")


def canonical_order() -> list[Column]:
    return [F.col("score").desc(), F.col("confidence").desc(), F.col("size"), F.col("source"), F.col("sense_id")]


def clusters(facts: DataFrame) -> DataFrame:
    """One row for each cluster: canonical definition, evidence, status, tier, confidence.

    ``facts``: whole, or members as :func:`clustered` makes them of :func:`brief` ones, without the word, the key and
    what of the canonical definition isn't among their columns.

    The canonical row and the runner-up come from a window that Spark limits
    to two rows of a cluster before its shuffle's sort; all else are sums, of a
    cluster's sources first.  What isn't read of the result isn't dealt.
    """
    members = facts if "cluster_id" in facts.columns else clustered(brief(facts, "word", "key", "language", "meaning", "tokens"))
    rank = F.row_number().over(Window.partitionBy("cluster_id").orderBy(*canonical_order()))
    top = members.withColumn("_rank", rank).where("_rank <= 2")
    first = F.col("_rank") == 1
    of_first = lambda c, name: F.max(F.when(first, F.col(c))).alias(name)
    given = [c for c in ("sense_id", "source", "language", "meaning", "confidence", "score", "hard_risk", "trusted", "tokens", "size") if c in members.columns]
    named = [c for c in ("word", "key") if c in members.columns]
    best = top.groupBy("cluster_id").agg(
        *[of_first(c, c) for c in (*named, "cluster_type", "key_size", "n_tokens")],
        *[of_first(c, f"_{c}") for c in given],
        F.max(F.when(~first, F.col("score"))).alias("runner_up"),
    )
    best = best.withColumn("canonical", F.struct(*[F.col(f"_{c}").alias(c) for c in given])).drop(*[f"_{c}" for c in given])
    marks = {"trusted_count": "trusted", "risky": "hard_risk", "unclear": "unclear", "low": "low", "no_pos": "no_pos"}
    by_source = members.groupBy("cluster_id", "source").agg(F.count("*").alias("n"), F.bool_or("vi").alias("vi"), *[F.count_if(F.col(c)).alias(f"n_{c}") for c in marks.values()])
    sums = by_source.groupBy("cluster_id").agg(
        F.sum("n").alias("member_count"),
        F.count("source").alias("source_count"),
        F.count_if((F.col("n_trusted") > 0) & F.col("source").isNotNull()).alias("trusted_source_count"),
        F.bool_or("vi").alias("has_vi"),
        *[F.sum(f"n_{c}").alias(name) for name, c in marks.items()],
    )
    c = best.join(sums, "cluster_id")
    n_tokens = F.col("n_tokens")
    safe = (n_tokens >= 3) | ((n_tokens >= 2) & (F.col("key_size") >= 10) & (F.col("trusted_count") >= 3))
    exact, some_risk = F.col("cluster_type") == "exact", (F.col("risky") > 0) & (F.col("risky") < F.col("member_count"))
    several = F.col("source_count") >= 2
    # the first rule that holds decides
    status = (
        F.when(~F.col("has_vi"), "reference_non_vi")
        .when(F.col("canonical.hard_risk") | (F.col("risky") == F.col("member_count")), "entity_or_encyclopedic")
        .when(exact & (F.col("trusted_source_count") >= 2) & safe, "auto_accepted")
        .when(exact & several & safe & F.col("canonical.trusted") & some_risk, "machine_clustered")
        .when(exact & several & safe & (F.col("risky") == 0), "machine_clustered")
        .when(exact & several & some_risk, "needs_review")
        .when(F.col("risky") > 0, "quarantined")
        .when((F.col("unclear") > 0) | (F.col("low") > 0) | (F.col("no_pos") > 0), "needs_review")
        .otherwise("machine_retained")
    )
    reasons = _reasons(safe, exact, several, some_risk)
    margin = F.greatest(F.lit(0.0), F.col("canonical.score") - F.col("runner_up"))
    agreement = 0.56 + F.least(F.lit(0.18), (F.col("source_count") - 1) * 0.06) + F.least(F.lit(0.2), F.col("trusted_source_count") * 0.08)
    selection = 0.45 + F.col("canonical.confidence") * 0.3 + F.least(F.lit(0.24), F.coalesce(margin, F.lit(0.0)) / 80)
    # a sum of products is often a tie in decimals: round the binary value
    unit = lambda x: F.floor(F.least(F.lit(1.0), F.greatest(F.lit(0.0), x)) * 10000 + 0.5) / 10000
    return (
        c.withColumn("status", status)
        .withColumn("reasons", reasons)
        .withColumn(
            "tier",
            F.when(F.col("status") == "auto_accepted", "high")
            .when(F.col("status").isin("machine_clustered", "machine_retained"), "medium")
            .when(F.col("status") == "needs_review", "low")
            .when(F.col("status") == "quarantined", "quarantine")
            .when(F.col("status") == "entity_or_encyclopedic", "entity")
            .otherwise("reference"),
        )
        .withColumn("source_confidence", unit(F.col("canonical.confidence")))
        .withColumn("cluster_confidence", F.when(exact, unit(agreement)).otherwise(1.0))
        .withColumn("selection_confidence", F.when(exact, unit(selection)).otherwise(1.0))
    )


def _reasons(safe: Column, exact: Column, several: Column, some_risk: Column) -> Column:
    """Why a cluster has its status, as an array of names."""

    def names(*xs: str) -> Column:
        return F.array(*[F.lit(x) for x in xs])

    def given(*pairs: tuple[Column, str]) -> Column:
        return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in pairs]))

    canon, whole = F.col("canonical.hard_risk"), F.col("risky") == F.col("member_count")
    key = "exact-normalized-definition"
    return (
        F.when(~F.col("has_vi"), names("no-vietnamese-definition"))
        .when(
            canon | whole,
            F.concat(names("entity-or-encyclopedic-layer"), given((canon, "canonical-definition-has-entity-risk"), (whole, "all-source-definitions-have-entity-risk"))),
        )
        .when(
            exact & (F.col("trusted_source_count") >= 2) & safe,
            F.concat(names(key, "trusted-source-agreement"), given((F.col("risky") > 0, "risky-members-routed-to-entity-review"))),
        )
        .when(
            exact & several & safe & F.col("canonical.trusted") & some_risk,
            names(key, "trusted-canonical-with-member-level-entity-risk", "risky-members-routed-to-entity-review"),
        )
        .when(exact & several & safe & (F.col("risky") == 0), names(key, "source-agreement-but-not-enough-trusted-sources"))
        .when(exact & several & some_risk, names(key, "low-information-definition-kept-for-review", "risky-members-routed-to-entity-review"))
        .when(F.col("risky") > 0, names("hard-risk-label"))
        .when(
            (F.col("unclear") > 0) | (F.col("low") > 0) | (F.col("no_pos") > 0),
            given((F.col("unclear") > 0, "documented-unclear-source"), (F.col("low") > 0, "low-confidence"), (F.col("no_pos") > 0, "missing-pos")),
        )
        .otherwise(names("singleton-or-unmerged-machine-retained"))
    )


def key_ids() -> list[Column]:
    """Two hashes that together stand for a headword's key where only equality counts."""
    return [F.xxhash64("word", "key").alias("k1"), F.xxhash64(F.lit(1), "key", "word").alias("k2")]


def near_keys(facts: DataFrame, least: float = NEAR, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(a1, a2, b1, b2, word, raw): pairs of a headword's different keys whose tokens are alike, by :func:`key_ids`; ``a`` has
    no more definitions than ``b``."""
    return _near(facts, least, min_tokens)[0]


def _near(facts: DataFrame, least: float, min_tokens: int, again: Again | None = None, columns: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Pairs as :func:`near_keys` has them, and word, key and ``columns`` of the facts that may be in one, kept.

    A prefix filter: sets of n tokens with a Jaccard similarity of ``least`` or
    more share one of the first ``n - ceil(least * n) + 1`` tokens in any fixed
    order, here the longest first, as long words are rare as a rule.  So the
    join is on (headword, token), not on headwords alone, its keys are shared by
    few, and common headwords don't meet all with all.  Equal definitions are
    one row here, and the join has hashes in place of texts: hashes choose,
    the keys themselves decide.

    A parity sketch, one bit for a token, differs in no more bits than two sets
    in tokens, and a likeness bounds those: most pairs that aren't alike go
    before a text is read.  Texts of all facts are gone through once, then once
    more for those that may be in a pair; ``again`` makes facts of their entries alone.
    """

    def brief_of(tokens: Column) -> Column:
        # a token is a number, longer ones less, so that the order is that of numbers; equal ones of different tokens do no harm
        ids = F.sort_array(F.transform(F.array_distinct(tokens), lambda t: F.shiftleft(-F.length(t).cast("long"), 32) + F.hash(t)))
        return F.transform(F.array(ids), lambda x: F.struct(F.size(tokens).alias("all"), F.size(x).alias("n"), prefix(x).alias("first"), sketch(x).alias("bits")))

    prefix = lambda x: F.slice(x, F.lit(1), (F.size(x) - F.ceil(F.size(x) * F.lit(least)) + 1).cast("int"))
    sketch = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda s, t: s.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(t, F.lit(64)).cast("int"))))
    # what an array of one holds is made once, and a filter isn't pushed below the generator
    sets = F.explode(F.flatten(F.transform(F.array("tokens"), brief_of))).alias("x")
    entry = F.xxhash64("entry_id").alias("e")
    brief = facts.select(*key_ids(), F.xxhash64("word").alias("w"), entry, sets).select("k1", "k2", "w", "e", "x.*").where(F.col("all") >= min_tokens)
    own = F.struct("k1", "k2")
    of_word = Window.partitionBy("w")
    several = brief.repartition("w").withColumn("_least", F.min(own).over(of_word)).withColumn("_most", F.max(own).over(of_word)).where("_least <> _most")
    several = several.select("k1", "k2", "w", "e", "n", "first", "bits").persist(StorageLevel.MEMORY_AND_DISK)
    keys = several.groupBy("w", "k1", "k2").agg(F.first("n").alias("n"), F.first("first").alias("first"), F.first("bits").alias("bits"), F.count("*").alias("m"))
    rows = keys.select("k1", "k2", "w", "n", "m", "bits", F.posexplode("first").alias("i", "t"))
    a, b = rows.alias("a"), rows.alias("b")
    # each pair once, the key with fewer definitions first
    before = F.struct("a.m", "a.k1", "a.k2") < F.struct("b.m", "b.k1", "b.k2")
    # tokens before and after the common one bound what is common
    most = F.least("a.i", "b.i") + F.least(F.col("a.n") - F.col("a.i"), F.col("b.n") - F.col("b.i"))
    both_n = F.col("a.n") + F.col("b.n")
    alike = (F.least("a.n", "b.n") >= F.greatest("a.n", "b.n") * F.lit(least)) & (most >= (both_n - most) * F.lit(least))
    # tokens that one of both has: a share of all of at most 1 - least, with room for a rounded number
    alike = alike & (F.bit_count(F.col("a.bits").bitwiseXOR(F.col("b.bits"))) <= both_n * F.lit((1 - least) / (1 + least)) + 0.001)
    pairs = a.join(b, (F.col("a.w") == F.col("b.w")) & (F.col("a.t") == F.col("b.t")) & before & alike)
    hits = pairs.select(*[F.col(f"{x}.k{i}").alias(f"{x}{i}") for x in "ab" for i in (1, 2)]).distinct().persist(StorageLevel.MEMORY_AND_DISK)
    few = facts if again is None else again(among(several.select("k1", "e"), hits).select(entry_bucket(F.col("e")).alias("bucket")).distinct())
    members = among(few.select(*key_ids(), "word", "key", *columns), hits).persist(StorageLevel.MEMORY_AND_DISK)
    texts = members.groupBy("k1", "k2").agg(F.first("word").alias("word"), F.first("key").alias("key"))
    side = lambda s: texts.select(F.col("k1").alias(f"{s}1"), F.col("k2").alias(f"{s}2"), *[F.col(c).alias(f"{s}_{c}") for c in ("word", "key")])
    both = hits.join(side("a"), ["a1", "a2"]).join(side("b"), ["b1", "b2"]).where("a_word = b_word")
    raw = T.jaccard(T.content_tokens(F.col("a_key")), T.content_tokens(F.col("b_key")))
    found = both.select("a1", "a2", "b1", "b2", F.col("a_word").alias("word"), raw.alias("raw")).where(F.col("raw") >= least)
    # pairs of keys are few beside definitions; they choose members, and are joined with them
    return found.persist(StorageLevel.MEMORY_AND_DISK), members.drop("k1", "k2")


#: What :func:`among` broadcasts at most.
BUCKETS = 1 << 21
#: What makes facts anew, of the entries in given buckets (bucket, as :func:`entry_bucket` has it of the hash of their ids) alone.
Again = Callable[[DataFrame], DataFrame]


def entry_bucket(hashed: Column) -> Column:
    """One of at most ``BUCKETS``, which are broadcast, of xxhash64 of an entry's id."""
    return F.pmod(hashed, F.lit(BUCKETS))


def among(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """``rows`` (k1, ...) without most of those whose key is in none of ``pairs`` (a1, b1): by buckets of the hash, of which
    at most ``BUCKETS`` are broadcast, so that what isn't needed isn't dealt.  Those that stay need a join yet."""
    bucket = lambda c: F.pmod(c, F.lit(BUCKETS))
    wanted = pairs.select(F.explode(F.array("a1", "b1")).alias("k")).select(bucket(F.col("k")).alias("_bucket")).distinct()
    return rows.withColumn("_bucket", bucket(F.col("k1"))).join(F.broadcast(wanted), "_bucket", "left_semi").drop("_bucket")


def of_members(pairs: DataFrame, members: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Pairs of definitions for pairs of keys as :func:`near_keys` gives them: word, raw, left and right id and ``columns``
    of both; the lesser id is the left one.  ``members``: word, key, sense_id and the columns.

    The side with fewer definitions is looked up first, so that what is dealt
    once more is small; all pairs come only from the last join.
    """
    wanted = ("sense_id", *columns)
    rows = among(members.select(*key_ids(), *wanted), pairs)
    side = lambda s: rows.select(F.col("k1").alias(f"{s}1"), F.col("k2").alias(f"{s}2"), *[F.col(c).alias(f"{s}_{c}") for c in wanted])
    both = pairs.join(side("a"), ["a1", "a2"]).join(side("b"), ["b1", "b2"]).where("a_sense_id <> b_sense_id")
    less = F.col("a_sense_id") < F.col("b_sense_id")
    named = [(f"{s}_{'id' if c == 'sense_id' else c}", F.when(less, F.col(f"{x}_{c}")).otherwise(F.col(f"{y}_{c}"))) for s, x, y in (("left", "a", "b"), ("right", "b", "a")) for c in wanted]
    return both.select("word", "raw", *[c.alias(name) for name, c in named])


def near_pairs(facts: DataFrame, least: float = NEAR, min_tokens: int = MIN_TOKENS, again: Again | None = None) -> DataFrame:
    """Pairs of facts of a headword with different keys whose tokens are alike; ``again``: see :data:`Again`."""
    columns = ("source", "meaning", "trusted")
    both = of_members(*_near(facts, least, min_tokens, again, ("sense_id", *columns)), columns)
    return (
        both.withColumn("action", F.when((F.col("raw") >= CANDIDATE) & F.col("left_trusted") & F.col("right_trusted"), "machine_cluster_candidate").otherwise("review_only"))
        .withColumn("score", F.round("raw", 4))
        .select("word", "score", "left_id", "right_id", "left_source", "right_source", "left_meaning", "right_meaning", "action")
    )


def triage(pairs: DataFrame) -> DataFrame:
    candidate = F.col("action") == "machine_cluster_candidate"
    safe = candidate & (F.col("score") >= SAFE) & (F.col("left_source") != F.col("right_source"))
    return pairs.withColumn("triage_group", F.when(safe, "auto_safe_candidate").when(candidate, "machine_cluster_candidate").otherwise("blocked_review_only"))


def score_bucket(score: Column) -> Column:
    return F.when(score == 1, "1.00").when(score >= 0.98, "0.98-0.9999").when(score >= 0.94, "0.94-0.9799").when(score >= 0.9, "0.90-0.9399").otherwise("0.82-0.8999")


def entity_layer(facts: DataFrame) -> DataFrame:
    """Copies of risky members of clusters that are themselves not of the entity layer, and whole entity clusters.

    ``facts``: whole, or members as :func:`clustered` makes them of :func:`brief` ones with their risk_tags.
    """
    status = clusters(facts).select("cluster_id", "status")
    rows = (facts if "cluster_id" in facts.columns else clustered(facts)).join(status, "cluster_id")
    scope = F.when(F.col("status") == "entity_or_encyclopedic", "cluster").when(F.col("hard_risk"), "member")
    kinds = F.filter("risk_tags", lambda t: t.isin(*ENTITY_RISKS))
    kind = F.when(F.size(kinds) == 1, kinds[0]).otherwise("mixed")
    return rows.withColumn("scope", scope).where(F.col("scope").isNotNull()).withColumn("entity_type", kind)
