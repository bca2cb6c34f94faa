"""Audits of definitions: flags, priorities, queues, groups, quotas, reasons."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from . import evaluate, senses

#: What a flag adds to a review's priority; others add 1.
FLAG_WEIGHTS = {"documented-unclear-source": 14, "non-vi-definition": 10, "low-confidence": 8, "missing-pos": 6, "too-short": 5, "too-long": 4}
#: How many rows of each category a set of pairs to label has.
GOLD_QUOTAS = {"exact_cross_source_duplicate": 334, "near_duplicate": 333, "distant_same_headword": 333}
#: Pairs of each bucket of scores in a benchmark, and exact controls beside them.
SILVER_QUOTAS = {"1.00": 150, "0.98-0.9999": 1, "0.94-0.9799": 200, "0.90-0.9399": 200, "0.82-0.8999": 249}
SILVER_CONTROLS = 200


def vi(column: str) -> Column:
    """A sort key in Vietnamese order."""
    return F.collate(F.col(column), "vi")


def flags() -> Column:
    """What an audit notes of a definition, in the order of the rules.

    Needs rights, labels, confidence, review_status, part_of_speech, examples
    (their number), language, meaning and key.
    """
    m = T.clean(F.col("meaning"))

    def tag(when: Column, name: str) -> Column:
        return F.when(when, F.lit(name))

    rules = F.array_compact(
        F.array(
            tag((F.col("rights") == "documented-unclear") | F.array_contains("labels", "documented-unclear"), "documented-unclear-source"),
            tag(F.col("confidence") < 0.75, "low-confidence"),
            tag(F.col("review_status") != "human-reviewed", "not-human-reviewed"),
            tag(F.size("part_of_speech") == 0, "missing-pos"),
            tag(F.exists("part_of_speech", lambda p: p.rlike("^[A-Z]$")), "raw-pos-code"),
            tag(F.size("labels") == 0, "missing-labels"),
            tag(F.col("examples") == 0, "no-example"),
            tag(F.col("language") != "vi", "non-vi-definition"),
            tag((F.length(m) < 12) | (T.token_count(F.col("key")) < 2), "too-short"),
            tag(F.length(m) > 500, "too-long"),
            # looser than the rule for risks: a number alone is enough
            tag(m.rlike("^[0-9]+"), "leading-sense-marker"),
        )
    )
    return F.array_distinct(F.concat(rules, F.filter("labels", lambda x: x.isin(*senses.ENTITY_RISKS))))


def priority(tags: Column | str) -> Column:
    weight = lambda t: F.coalesce(*[F.when(t == k, v) for k, v in FLAG_WEIGHTS.items()], F.lit(1))
    return F.aggregate(tags, F.lit(0), lambda a, t: a + weight(t))


def flagged(facts: DataFrame) -> DataFrame:
    rows = facts.withColumn("flags", flags())
    return rows.withColumn("priority", priority("flags").cast("long"))


def review_queue(facts: DataFrame, most: int) -> DataFrame:
    """The ``most`` urgent definitions: by priority, number of flags, word, place; a top-k, no sort of all."""
    order = [F.col("priority").desc(), F.size("flags").desc(), vi("word"), F.col("definition_index"), F.col("sense_id")]
    return flagged(facts).where("priority > 0").orderBy(*order).limit(most)


def source_audit(facts: DataFrame) -> DataFrame:
    """Twelve measures of every source in one pass."""
    return flagged(facts).groupBy("source").agg(
        F.max("rights").alias("rights"),
        F.count_distinct("word").alias("headwords"),
        F.count("*").alias("definitions"),
        F.count_if(F.col("language") == "vi").alias("vi"),
        F.count_if(F.col("language") == "en").alias("en"),
        F.count_if(F.col("examples") > 0).alias("with_examples"),
        F.count_if(F.size("labels") > 0).alias("with_labels"),
        F.count_if(F.col("confidence") < 0.75).alias("low_confidence"),
        F.count_if(F.col("review_status") == "human-reviewed").alias("human_reviewed"),
        F.count_if(F.col("review_status") == "machine-checked").alias("machine_checked"),
        F.count_if(F.col("review_status") == "unreviewed").alias("unreviewed"),
        F.sum(F.size("flags").cast("long")).alias("flags"),
        evaluate.mean("confidence").alias("confidence"),
    )


def exact_groups(facts: DataFrame, most: int | None = None) -> DataFrame:
    """Equal definitions of a headword in several sources, the largest groups first."""
    groups = facts.where("key <> ''").groupBy("word", "key").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("source")).alias("sources")).where("n > 1 AND size(sources) > 1")
    return groups if most is None else groups.orderBy(F.col("n").desc(), vi("word"), "word", "key").limit(most)


def exact_pairs(facts: DataFrame) -> DataFrame:
    """The first definition of every exact group, and the first of another source."""
    at = F.struct(F.struct("entry_id", "definition_index").alias("ord"), "sense_id", "source", "definition_index", "word")
    # a group's first definition of each source; the least of them is the left one, the next is of another source.
    # Keys are hashed, as equality is all that counts
    first = facts.where("key <> ''").groupBy(*senses.key_ids(), "source").agg(F.min(at).alias("at"), F.count("*").alias("n"))
    w = Window.partitionBy("k1", "k2")
    two = first.withColumn("_rank", F.row_number().over(w.orderBy("at"))).withColumn("n", F.sum("n").over(w)).where("_rank <= 2")
    one = lambda i: F.max(F.when(F.col("_rank") == i, F.col("at")))
    pairs = two.groupBy("k1", "k2").agg(F.max("n").alias("n"), one(1).alias("left"), one(2).alias("right")).where(F.col("right").isNotNull())
    return pairs.select(F.col("left.word").alias("word"), "n", "left", "right")


def gold_todo(exact: DataFrame, near: DataFrame, distant: DataFrame) -> DataFrame:
    """(category, word, score, left_id, right_id): pairs to label, each category by its quota.

    ``exact``: word, n, left, right; the others: word, score, left_id, right_id.
    Large groups, high scores and low scores come first.
    """
    a = exact.select("word", F.lit(None).cast("double").alias("score"), F.col("left.sense_id").alias("left_id"), F.col("right.sense_id").alias("right_id"), F.col("n").cast("double").alias("first"))
    parts = []
    for (category, quota), rows in zip(GOLD_QUOTAS.items(), (a, near.withColumn("first", F.col("score")), distant.withColumn("first", -F.col("score")))):
        rows = rows.select(F.lit(category).alias("category"), "word", "score", "left_id", "right_id", "first")
        # a pair is wanted once
        rows = rows.dropDuplicates(["left_id", "right_id"])
        parts.append(rows.orderBy(F.col("first").desc(), vi("word"), "word", "left_id", "right_id").limit(quota).drop("first"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def distant_pairs(facts: DataFrame, most: int, least_words: int = 1000) -> DataFrame:
    """(word, score, left_id, right_id): the first ``most`` pairs of a headword, by word and ids, from different sources, with
    different keys and little in common.

    Pairs are made of the first headwords only, in order; where these have too few, of eight times as many, up to all.
    """
    own = facts.where(F.size("tokens") >= senses.MIN_TOKENS).select("word", "sense_id", "source", "key", F.array_distinct("tokens").alias("t"))
    several = own.groupBy("word").agg(*[f(F.xxhash64(c)).alias(f"{n}_{c}") for c in ("source", "key") for n, f in (("least", F.min), ("most", F.max))])
    words = several.where("least_source <> most_source AND least_key <> most_key").select("word").persist(StorageLevel.MEMORY_AND_DISK)
    total = words.count()
    while True:
        rows = own if least_words >= total else own.join(words.orderBy("word").limit(least_words), "word", "left_semi")
        a, b = rows.alias("a"), rows.alias("b")
        pairs = a.join(b, (F.col("a.word") == F.col("b.word")) & (F.col("a.sense_id") < F.col("b.sense_id")) & (F.col("a.key") != F.col("b.key")) & (F.col("a.source") != F.col("b.source")))
        score = T.jaccard(F.col("a.t"), F.col("b.t"))
        far = pairs.where(score <= 0.2).select("a.word", F.round(score, 4).alias("score"), F.col("a.sense_id").alias("left_id"), F.col("b.sense_id").alias("right_id"))
        first = far.orderBy("word", "left_id", "right_id").limit(most)
        if least_words >= total:
            return first
        first = first.persist(StorageLevel.MEMORY_AND_DISK)  # ``most`` rows
        if first.count() >= most:
            return first
        least_words *= 8


def least_alike(facts: DataFrame, most: int, least_words: int = 1000) -> DataFrame:
    """(word, score, left_id, right_id): of all pairs as :func:`distant_pairs` has them the ``most`` of least score, by score,
    headword in Vietnamese order, and ids.

    Tokens that all definitions of a headword share, as those of the headword itself, bound its scores from below.  Pairs
    are made of the headwords that are first by that bound and in order; the last of the pairs wanted then tells which
    others may have one before it, and if there are any, pairs are made of all of those.  No pair is left out unseen.
    """
    own = facts.where(F.size("tokens") >= senses.MIN_TOKENS).select("word", "sense_id", "source", "key", F.array_distinct("tokens").alias("t"))
    # which of the headword's tokens a definition has, a bit each
    named = F.slice(F.array_distinct(F.split(F.lower("word"), r"[^\p{L}\p{N}]+")), 1, 62)
    has = F.aggregate(named, F.lit(0).cast("long"), lambda bits, w: bits * 2 + F.when(F.array_contains("t", w), 1).otherwise(0))
    stats = own.withColumn("has", has).groupBy("word").agg(
        *[f(F.xxhash64(c)).alias(f"{n}_{c}") for c in ("source", "key") for n, f in (("least", F.min), ("most", F.max))], F.bit_count(F.bit_and("has")).alias("common"), F.max(F.size("t")).alias("size")
    )
    bound = F.col("common") / (2 * F.col("size") - F.col("common"))
    words = stats.where("least_source <> most_source AND least_key <> most_key").withColumn("bound", bound).where("bound <= 0.2")
    words = words.select("word", F.round("bound", 4).alias("bound")).persist(StorageLevel.MEMORY_AND_DISK)
    order = [F.col("score"), vi("word"), F.col("word"), F.col("left_id"), F.col("right_id")]

    def first_of_words(chosen: DataFrame) -> DataFrame:
        # a definition that is there twice makes no pair twice
        rows = own.join(chosen.select("word"), "word", "left_semi").dropDuplicates(["word", "sense_id"])
        a, b = rows.alias("a"), rows.alias("b")
        pairs = a.join(b, (F.col("a.word") == F.col("b.word")) & (F.col("a.sense_id") < F.col("b.sense_id")) & (F.col("a.key") != F.col("b.key")) & (F.col("a.source") != F.col("b.source")))
        score = T.jaccard(F.col("a.t"), F.col("b.t"))
        far = pairs.where(score <= 0.2).select("a.word", F.round(score, 4).alias("score"), F.col("a.sense_id").alias("left_id"), F.col("b.sense_id").alias("right_id"))
        return far.orderBy(*order).limit(most).persist(StorageLevel.MEMORY_AND_DISK)  # ``most`` rows

    total = words.count()
    while least_words < total:
        taken = words.orderBy("bound", vi("word"), "word").limit(least_words).persist(StorageLevel.MEMORY_AND_DISK)
        first = first_of_words(taken)
        found = first.agg(F.count("*").alias("n"), F.max(F.struct("score", vi("word").alias("v"), "word")).alias("last")).select("n", "last.score", "last.word").first()
        if found.n >= most:
            word = F.lit(found.word)
            later = (F.collate("word", "vi") > F.collate(word, "vi")) | ((F.collate("word", "vi") == F.collate(word, "vi")) & (F.col("word") > word))
            needed = words.where((F.col("bound") < found.score) | ((F.col("bound") == found.score) & ~later))
            return first if needed.join(taken, "word", "left_anti").isEmpty() else first_of_words(needed)
        least_words *= 8
    return first_of_words(words)


def chosen_controls(pairs: DataFrame) -> DataFrame:
    """The controls of a benchmark, with their id: pairs (left_id, right_id, ...) of least hash."""
    rows = pairs.withColumn("id", F.concat_ws(":", "left_id", "right_id"))
    return rows.orderBy(evaluate.hash_rank("id"), "id").limit(SILVER_CONTROLS)


def benchmark(controls: DataFrame, near: DataFrame) -> DataFrame:
    """(category, id, word, score, left_id, right_id): controls and pairs of each bucket of scores, those of least hash."""
    ids = lambda rows: rows.withColumn("id", F.concat_ws(":", "left_id", "right_id"))
    own = chosen_controls(controls).withColumn("category", F.lit("exact_cross_source_duplicate"))
    rows = ids(near).withColumn("bucket", senses.score_bucket(F.col("score")))
    quota = F.coalesce(*[F.when(F.col("bucket") == k, v) for k, v in SILVER_QUOTAS.items()])
    chosen = evaluate.top_by_hash(rows, ["bucket"], "id", quota).withColumn("category", F.lit("near_duplicate"))
    columns = ["category", "id", "word", "score", "left_id", "right_id", "left_meaning", "right_meaning"]
    return own.select(*columns).unionByName(chosen.select(*columns))


def resolve(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """``pairs`` (word, left_source, left_index, right_source, right_index) with the sense ids that both
    sides stand for, null where none does, and ``resolvable``; of several senses at one place the last."""
    known = facts.groupBy("word", "source", "definition_index").agg(F.max_by("sense_id", F.struct("entry_id", "sense_id")).alias("sense_id"))

    def side(name: str) -> DataFrame:
        return known.select("word", F.col("source").alias(f"{name}_source"), F.col("definition_index").alias(f"{name}_index"), F.col("sense_id").alias(f"{name}_sense"))

    out = pairs
    for name in ("left", "right"):
        out = out.join(side(name), ["word", f"{name}_source", f"{name}_index"], "left")
    return out.withColumn("resolvable", F.col("left_sense").isNotNull() & F.col("right_sense").isNotNull())


#: How many of a headword's definitions meet as many others in one piece of work, on average.
CHUNK = 2048
#: Pairs that a task goes through, on average.
TASK_PAIRS = 1 << 24


def cross_source_pairs(facts: DataFrame, most: int) -> DataFrame:
    """Pairs of a headword's definitions from different sources, those of least hash of their ids.

    The order is that of a hash of both ids, so that every pair is hashed, once.  A headword's definitions are parted by a
    hash of their ids and parts meet in pairs, dealt over all tasks.  How many pairs there are is counted first, which
    tells below which bound ``most`` hashes are as good as certainly found: what is above makes no row.  If fewer are
    found, the bound is raised, up to none.
    """
    own = facts.select("word", "sense_id", "source").where("word IS NOT NULL AND sense_id IS NOT NULL AND source IS NOT NULL").persist(StorageLevel.MEMORY_AND_DISK)
    n = own.groupBy("word", "source").agg(F.count("*").alias("n"))
    sizes = n.groupBy("word").agg(F.sum("n").alias("n"), F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"), F.count("*").alias("sources")).where("sources > 1")
    sizes = sizes.persist(StorageLevel.MEMORY_AND_DISK)
    total = sizes.agg(F.sum((F.col("n").cast("double") * F.col("n") - F.col("squares")) / 2)).first()[0] or 0.0
    # large headwords are broadcast, one in CHUNK rows at most; any other is one part
    large = sizes.where(F.col("n") > CHUNK).select("word", F.ceil(F.col("n") / CHUNK).cast("int").alias("parts"))
    rows = own.join(F.broadcast(large), "word", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.pmod(F.xxhash64("sense_id"), F.col("parts")).cast("int"))
    # bytes don't tell the work, which is a square of them: the number of tasks is given, else small ones would be joined
    tasks = max(int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / TASK_PAIRS))
    side = lambda i, j: rows.select("word", "sense_id", "source", i.alias("i"), j.alias("j")).repartition(tasks, "word", "i", "j")
    part = F.col("part")
    a = side(part, F.explode(F.sequence(part, F.col("parts") - 1))).alias("a")
    b = side(F.explode(F.sequence(F.lit(0), part)), part).alias("b")
    left, right = F.least("a.sense_id", "b.sense_id"), F.greatest("a.sense_id", "b.sense_id")
    rank = F.sha2(F.concat(left, F.lit(":"), right), 256)  # evaluate.hash_rank, in a form that takes less time
    # equal ids are in one part
    met = (F.col("a.word") == F.col("b.word")) & (F.col("a.i") == F.col("b.i")) & (F.col("a.j") == F.col("b.j"))
    met = met & (F.col("a.source") != F.col("b.source")) & ((F.col("a.i") < F.col("a.j")) | (F.col("a.sense_id") < F.col("b.sense_id")))
    share = 4 * most / max(total, 1.0)
    while True:
        # a condition of the join, the last one: a pair that doesn't count isn't hashed
        bound = rank < f"{int(share * 16**15):015x}" if share < 1 else F.lit(True)
        found = a.join(b, met & bound).select("a.word", left.alias("left_id"), right.alias("right_id"), rank.alias("_hash"))
        first = found.orderBy("_hash", "left_id", "right_id").limit(most).drop("_hash")
        if share >= 1:
            return first
        first = first.persist(StorageLevel.MEMORY_AND_DISK)  # ``most`` rows
        if first.count() >= most:
            return first
        share *= 8


# --- reasons ---------------------------------------------------------------------------------------


def reasons(facts: DataFrame) -> DataFrame:
    """(reason, cluster_id, status, word, source, sense_id): every reason of every definition, once."""
    status = senses.clusters(facts).select("cluster_id", "status", "reasons")
    rows = senses.clustered(facts).join(status, "cluster_id")
    none = F.array().cast("array<string>")
    derived = F.when((F.col("status") == "reference_non_vi") & (F.col("language") != "vi"), F.array(F.lit("non-vi-definition"))).otherwise(none)
    every = F.array_union(F.array_union("risk_tags", "reasons"), derived)
    return rows.select(F.explode(every).alias("reason"), "cluster_id", "status", "word", "source", "sense_id")


def reason_by_status(rows: DataFrame) -> DataFrame:
    """Clusters and definitions of each reason, and definitions by status as columns."""
    by = [F.count_if(F.col("status") == s).alias(s) for s in senses.STATUSES]
    return rows.groupBy("reason").agg(F.count_distinct("cluster_id").alias("clusters"), F.count("*").alias("definitions"), *by)


def reason_by_source(rows: DataFrame, most: int = 10) -> DataFrame:
    """(reason, source, n, rank): the sources that a reason is most frequent in."""
    n = rows.groupBy("reason", "source").agg(F.count("*").alias("n"))
    w = Window.partitionBy("reason").orderBy(F.col("n").desc(), "source")
    return n.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def first_of(rows: DataFrame, group: list[str], order: list[str], most: int) -> DataFrame:
    """The first ``most`` rows of each group in a stated order: a limit of the window, not a list."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def members(facts: DataFrame) -> DataFrame:
    """(cluster_id, rank, sense_id, ...): a cluster's definitions in its order, a row each."""
    w = Window.partitionBy("cluster_id").orderBy(F.col("score").desc(), "source", "sense_id")
    return senses.clustered(facts).withColumn("rank", F.row_number().over(w))


def representatives(facts: DataFrame) -> DataFrame:
    """Risky members of clusters that aren't of the entity layer, one row a cluster, with the member that stands for them."""
    status = senses.clusters(facts).select("cluster_id", "status")
    risky = senses.clustered(facts).where("hard_risk").join(status, "cluster_id").where(~F.col("status").isin("entity_or_encyclopedic", "reference_non_vi"))
    best = F.min(F.struct(-F.col("confidence"), "source", "sense_id"))
    kinds = F.filter("risk_tags", lambda t: t.isin(*senses.ENTITY_RISKS))
    return risky.withColumn("kinds", kinds).groupBy("cluster_id", "status", "word").agg(F.count("*").alias("n"), best["sense_id"].alias("sense_id"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("kinds")))).alias("kinds"))


def sorted_distinct(values: Column, keep_null: bool = False) -> Column:
    """The distinct texts of an array in Vietnamese order, empty ones dropped; ``keep_null``: null first, where there is one."""
    texts = F.array_sort(
        F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != ""))),
        lambda a, b: F.when(F.collate(a, "vi") < F.collate(b, "vi"), -1).when(F.collate(a, "vi") > F.collate(b, "vi"), 1).when(a < b, -1).when(a > b, 1).otherwise(0),
    )
    if not keep_null:
        return texts
    return F.when(F.exists(values, lambda x: x.isNull()), F.concat(F.array(F.lit(None).cast("string")), texts)).otherwise(texts)
