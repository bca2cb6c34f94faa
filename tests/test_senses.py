"""Clusters: the ladder of statuses, canonical choice, confidence; and what holds for all of them."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lexloom.operators import audit, checks, evaluate, search, senses
from lexloom.plans import mapping

COLUMNS = "word string, meaning string, source string, entry_id long, definition_index int, record_hash string, language string, review_status string, confidence double, labels array<string>, part_of_speech array<string>, rights string, quality string"


def definition(meaning, source, word="từ", language="vi", confidence=0.9, labels=(), rights="open", quality="học thuật", review="machine-checked", pos=("danh từ",), i=0):
    return (word, meaning, source, i, 0, "a" * 64, language, review, confidence, list(labels), list(pos), rights, quality)


def clusters(spark, *rows):
    rows = [r[:3] + (k,) + r[4:] for k, r in enumerate(rows)]
    return senses.clusters(senses.definition_facts(spark.createDataFrame(rows, COLUMNS))).collect()


TEXT = "đồ vật dùng hàng ngày"
NAME = ["proper-name-candidate"]


@pytest.mark.parametrize(
    "rows,status,reason",
    [
        ([definition(TEXT, "a"), definition(TEXT, "b")], "auto_accepted", "trusted-source-agreement"),
        ([definition("rất tốt", "a"), definition("rất tốt", "b")], "machine_retained", None),
        ([definition(TEXT, "a"), definition(TEXT, "b", confidence=0.6, labels=NAME)], "machine_clustered", "risky-members-routed-to-entity-review"),
        ([definition("tin tức", "a"), definition("tin tức", "b", confidence=0.6, labels=NAME)], "needs_review", "low-information-definition-kept-for-review"),
        ([definition(TEXT, "a", labels=NAME), definition(TEXT, "b", labels=NAME)], "entity_or_encyclopedic", "all-source-definitions-have-entity-risk"),
        ([definition(TEXT, "a", language="en")], "reference_non_vi", "no-vietnamese-definition"),
        ([definition(TEXT, "a", confidence=0.5)], "needs_review", "low-confidence"),
        ([definition(TEXT, "a", pos=())], "needs_review", "missing-pos"),
        ([definition(TEXT, "a")], "machine_retained", "singleton-or-unmerged-machine-retained"),
        ([definition(TEXT, "a"), definition(TEXT, "b", rights="documented-unclear")], "machine_clustered", "source-agreement-but-not-enough-trusted-sources"),
    ],
)
def test_status(spark, rows, status, reason):
    got = clusters(spark, *rows)
    assert len(got) == 1 and got[0].status == status
    assert reason is None or reason in got[0].reasons


def test_canonical_by_score_then_confidence(spark):
    high, sure = definition(TEXT, "b", confidence=0.8, review="human-reviewed"), definition(TEXT, "a", confidence=0.99, quality="tổng hợp")
    got = clusters(spark, high, sure)[0]
    assert got.canonical.source == "b" and got.source_confidence == 0.8


def test_singleton_confidence(spark):
    got = clusters(spark, definition(TEXT, "a", confidence=0.65))[0]
    assert (got.source_confidence, got.cluster_confidence, got.selection_confidence) == (0.65, 1.0, 1.0)


def test_same_source_is_no_cluster(spark):
    assert len(clusters(spark, definition(TEXT, "a"), definition(TEXT, "a"))) == 2


def test_near_pairs(spark):
    near = [definition("một hai ba bốn năm sáu bảy tám chín mười", "a"), definition("một hai ba bốn năm sáu bảy tám chín", "b"), definition("hoàn toàn khác hẳn đi thôi", "c")]
    facts = senses.definition_facts(spark.createDataFrame([r[:3] + (k,) + r[4:] for k, r in enumerate(near)], COLUMNS))
    got = senses.near_pairs(facts).collect()
    assert len(got) == 1 and got[0].score >= 0.82 and {got[0].left_source, got[0].right_source} == {"a", "b"}


def test_copies_are_one_key_in_the_search_for_near_pairs(spark):
    """Forty equal definitions and two others alike: three pairs of keys, and a pair of definitions for each copy."""
    a, b = "một hai ba bốn năm sáu bảy tám chín mười", "một hai ba bốn năm sáu bảy tám chín"
    rows = [definition(a, f"s{i % 3}") for i in range(40)] + [definition(b, "s1"), definition("hai một ba bốn năm sáu bảy tám chín mười", "s2"), definition("chín " * 9, "s2")]
    facts = senses.definition_facts(spark.createDataFrame([r[:3] + (k,) + r[4:] for k, r in enumerate(rows)], COLUMNS))
    keys = senses.near_keys(facts).collect()
    assert sorted(round(r.raw, 4) for r in keys) == [0.8889, 0.8889, 1.0]
    got = senses.near_pairs(facts).collect()
    # the copies with each of two others, and those with each other
    assert len(got) == 40 + 40 + 1 and all(r.left_id < r.right_id for r in got)
    assert len({(r.left_id, r.right_id) for r in got}) == len(got)


def test_only_entries_of_near_pairs_are_made_again(spark):
    """Members of pairs are made of the entries that have one, not of all: before, of all, once for each use."""
    near = ["một loài cây thân gỗ mọc trong rừng già nhiệt đới", "một loài cây thân gỗ mọc trong rừng già nhiệt đới xanh"]
    texts = near + [" ".join(f"xa{i}b{j}" for j in range(6)) for i in range(10)]
    rows = [definition(t, f"s{i}") for i, t in enumerate(texts)]
    facts = senses.definition_facts(spark.createDataFrame([r[:3] + (k,) + r[4:] for k, r in enumerate(rows)], COLUMNS))
    asked = []

    def again(buckets):
        asked.append(buckets.count())
        return facts.withColumn("bucket", senses.entry_bucket(F.xxhash64("entry_id"))).join(buckets, "bucket", "left_semi").drop("bucket")

    got = sorted((r.left_id, r.right_id, r.score) for r in senses.near_pairs(facts, again=again).collect())
    everything = sorted((r.left_id, r.right_id, r.score) for r in senses.near_pairs(facts).collect())
    assert got == everything and len(got) == 1 and asked == [2]


def test_exact_pairs_are_the_first_of_two_sources(spark):
    rows = [definition(TEXT, s) for s in "bbac"] + [definition("rất tốt", "a"), definition("rất tốt", "a")]
    facts = senses.definition_facts(spark.createDataFrame([r[:3] + (k,) + r[4:] for k, r in enumerate(rows)], COLUMNS))
    got = audit.exact_pairs(facts).collect()
    assert [(r.n, r.left.ord.entry_id, r.right.ord.entry_id) for r in got] == [(4, 0, 2)]


def test_distant_pairs_of_the_first_headwords_only(spark):
    """Whether the first headwords have enough pairs or more are needed, the first pairs are those of all."""
    texts = ["một hai ba bốn năm sáu", "đồ vật dùng hàng ngày", "cây cao bóng mát quanh"]
    rows = [definition(t, f"s{i}", word=f"w{w}") for w in range(20) for i, t in enumerate(texts)]
    facts = senses.definition_facts(spark.createDataFrame([r[:3] + (k,) + r[4:] for k, r in enumerate(rows)], COLUMNS))
    of = lambda most, words: [(r.word, r.left_id, r.right_id) for r in audit.distant_pairs(facts, most, words).collect()]
    everything = of(1000, 1000)
    assert len(everything) == 60
    assert sorted(of(5, 1)) == everything[:5] and sorted(of(30, 1)) == everything[:30] and sorted(of(1000, 1)) == everything


def test_least_alike_are_of_all_pairs_not_of_the_first(spark):
    """The least score is that of the last headword, which no number of first pairs holds; bounds leave out no pair."""
    near, far = ["w%d một hai ba bốn năm sáu", "w%d một đồ vật dùng hàng ngày"], ["cây cao bóng mát quanh", "máy bay đường dài"]
    texts = lambda w: [t % w for t in near] if w < 19 else far
    rows = [definition(t, f"s{i}", word=f"w{w:02d}") for w in range(20) for i, t in enumerate(texts(w))]
    facts = senses.definition_facts(spark.createDataFrame([r[:3] + (k,) + r[4:] for k, r in enumerate(rows)], COLUMNS))
    of = lambda most, words: [(r.score, r.word, r.left_id, r.right_id) for r in audit.least_alike(facts, most, words).collect()]
    everything = of(1000, 1000)
    assert len(everything) == 20 and everything[0][:2] == (0.0, "w19") and everything == sorted(everything)
    assert sorted(of(1, 1)) == everything[:1] and sorted(of(3, 1)) == everything[:3] and sorted(of(1000, 1)) == everything


def test_every_definition_is_in_one_cluster(spark, sf_dir):
    facts = mapping.facts(spark, sf_dir)
    c = senses.clusters(facts)
    assert c.agg(F.sum("member_count")).first()[0] == facts.count()
    assert checks.duplicates(c, ["cluster_id"]).isEmpty()
    assert set(r.status for r in c.select("status").distinct().collect()) <= set(senses.STATUSES)
    assert c.where("status = 'auto_accepted' AND trusted_source_count < 2").isEmpty()
    assert c.where("status = 'reference_non_vi' AND has_vi").isEmpty()


def test_removal_of_a_source_and_back(spark, sf_dir):
    facts = mapping.facts(spark, sf_dir)
    before = senses.clusters(facts).select("cluster_id", "status").collect()
    rest = senses.clusters(facts.where("source <> 'src3'"))
    assert rest.where("canonical.source = 'src3'").isEmpty()
    assert sorted(before) == sorted(senses.clusters(facts).select("cluster_id", "status").collect())


def test_clusters_don_t_depend_on_partitions(spark, sf_dir):
    facts = mapping.facts(spark, sf_dir)
    assert checks.stable(lambda: senses.clusters(facts.repartition(5)).select("cluster_id", "status", "canonical.sense_id", "selection_confidence"), spark)


def test_confusion_adds_up(spark):
    rows = spark.createDataFrame([(i / 100, i % 3 == 0) for i in range(100)], "score double, y boolean")
    got = evaluate.confusion(rows, "score", F.col("y")).collect()
    assert all(r.tp + r.fp + r.tn + r.fn == 100 for r in got) and len(got) == 5
    nothing = evaluate.confusion(rows.where("score < 0"), "score", F.col("y")).collect()
    assert nothing == []


def test_even_quota(spark):
    rows = spark.createDataFrame([(f"s{i % 3}", i) for i in range(300)], "source string, id int")
    got = {r.source: r["count"] for r in evaluate.even_quota(rows, "source", "id", 20).groupBy("source").count().collect()}
    assert got == {"s0": 7, "s1": 7, "s2": 6}


def test_search_tiers(spark):
    words = spark.createDataFrame([(1, "ba"), (2, "Ba"), (3, "bà"), (4, "ba lô"), (5, "cái ba"), (6, "cái bao"), (7, "xbay"), (8, "字")], "id int, w string")
    shards = search.shards(search.index(words, "id", "w", F.lit(2)))
    got = [(r.i, r.score) for r in search.search(shards, "ba").collect()]
    assert set(got[:2]) == {(1, 210), (2, 210)} and got[2] == (3, 200) and dict(got)[4] == 140 and dict(got)[5] == 130 and dict(got)[6] == 120 and 7 not in dict(got)
    assert [r.i for r in shards.where("shard = 'other'").collect()] == [8]
    assert search.search(shards, "ba", mask=search.HAN).isEmpty()


def test_clusters_of_brief_rows_are_those_of_whole_facts(spark):
    """No text of a definition is dealt: clusters come the same of hashes, lengths and marks."""
    rows = [definition(TEXT, "a"), definition(TEXT, "b", labels=NAME), definition(TEXT, "b"), definition("rất tốt", "a"), definition("rất tốt", "a"), definition("!", "a"), definition("!", "b"), definition(TEXT, "a", word="khác")]
    facts = senses.definition_facts(spark.createDataFrame([r[:3] + (k,) + r[4:] for k, r in enumerate(rows)], COLUMNS))
    members = senses.clustered(senses.brief(facts))
    assert not {"word", "meaning", "key", "tokens", "record_hash", "risk_tags"} & set(members.columns)
    of = lambda c: sorted(c.select("cluster_id", "cluster_type", "status", "member_count", "source_count", "canonical.sense_id", "selection_confidence").collect())
    got = of(senses.clusters(members))
    assert got == of(senses.clusters(facts)) and sorted(r.member_count for r in got) == [1, 1, 1, 1, 1, 3]
    plan = senses.clusters(members).select("cluster_id", "status")._jdf.queryExecution().optimizedPlan().toString()
    # what nobody reads isn't dealt, and no distinct count makes rows of its own
    assert "Expand" not in plan and "runner_up" not in plan


def test_same_rows_counts_repeats(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "a int, b string")
    assert checks.same_rows(a, a.orderBy("a", ascending=False))
    assert not checks.same_rows(a, a.distinct()) and not checks.same_rows(a.distinct(), a)
    plan = []
    run = type(a).isEmpty
    type(a).isEmpty = lambda self: plan.append(self) or run(self)
    try:
        checks.same_rows(a, a)
    finally:
        type(a).isEmpty = run
    assert len(plan) == 1  # one pass for both directions


def test_cross_source_pairs_of_one_headword(spark, monkeypatch):
    """The pairs of one headword are dealt over tasks, and are those that all pairs, hashed in Python, give."""
    monkeypatch.setattr(audit, "CHUNK", 25, raising=False)
    monkeypatch.setattr(audit, "TASK_PAIRS", 1000, raising=False)
    rows = [("w", f"id-{i * 7919 % 1000:03d}", f"s{i % 3}") for i in range(200)]
    rows += [("w", "id-000", "s1"), ("w", "id-001", None), ("w", None, "s1"), (None, "id-002", "s0"), (None, "id-003", "s1"), ("one", "id-004", "s0"), ("two", "id-005", "s0"), ("two", "id-006", "s1")]
    known = [r for r in rows if None not in r]
    pairs = [(w, a, b) for w, a, s in known for v, b, t in known if w == v and a < b and s != t]
    pairs.sort(key=lambda r: (hashlib.sha256(f"{r[1]}:{r[2]}".encode()).hexdigest(), *r[1:]))
    facts = spark.createDataFrame(rows, "word string, sense_id string, source string")
    was, sc = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.sparkContext
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    sc.setJobGroup("pairs", "")
    try:
        for most in (50, len(pairs), len(pairs) + 9):
            got = [tuple(r) for r in audit.cross_source_pairs(facts, most).select("word", "left_id", "right_id").collect()]
            assert got == pairs[:most]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    # the stages that join have read the most rows; no task of theirs has read most of them
    tracker, store = sc.statusTracker(), sc._jsc.sc().statusStore()
    stages = {i for j in tracker.getJobIdsForGroup("pairs") for i in tracker.getJobInfo(j).stageIds}
    read = []
    for i in stages:
        tasks = store.taskList(i, 0, 1000)
        tasks = [tasks.apply(k) for k in range(tasks.size())]
        read.append([t.taskMetrics().get().shuffleReadMetrics().recordsRead() for t in tasks if t.taskMetrics().isDefined()])
    joins = [x for x in read if sum(x) >= 2 * 200]
    assert joins and all(max(x) < sum(x) / 2 for x in joins)
    assert audit.cross_source_pairs(facts.where("word = 'one'"), 5).count() == 0
