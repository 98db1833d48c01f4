import math
import random
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from loanlens.llm import quality as op
from tests.llm.helpers import by_id, documents, edge_texts, sentence

SMALL = op.Training(rows=2000, trees=5, depth=3)


def corpus(n):
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(n):
        words = sentence(i, rng.randrange(20, 200))
        good = i % 3 != 0
        texts.append(" ".join(words) + "." if good else "%% ".join(words) if i % 2 else " ".join(words[:2] * 40))
        labels.append((i, int(good)))
    return texts, labels


def test_held_out_accuracy(spark):
    texts, labels = corpus(400)
    labels += [(i, None) for i in range(5)] + [(9999, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    found = by_id(op.quality_scores(documents(spark, texts), table, training=SMALL))
    assert len(found) == 400
    for i, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [i for i, r in found.items() if r["held_out"]]
    assert sum(found[i]["predicted"] == (i % 3 != 0) for i in held) >= 0.97 * len(held)
    kept = op.keep_good(documents(spark, texts), table, training=SMALL)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in found.items() if r["predicted"]}
    assert kept.columns == documents(spark, texts).columns


def test_held_out_labels_are_not_learnt_from(spark):
    texts, labels = corpus(300)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    scores = [
        by_id(op.quality_scores(documents(spark, texts), spark.createDataFrame(x, "doc_id long, quality int"), training=SMALL))
        for x in (labels, flipped)
    ]
    assert {i: r["score"] for i, r in scores[0].items()} == {i: r["score"] for i, r in scores[1].items()}


def test_without_labels_all_scores_are_equal(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = op.quality_scores(documents(spark, edge_texts()), none).collect()
    assert len(rows) == len(edge_texts()) and {r["score"] for r in rows} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in range(10)], "doc_id long, quality int")
    assert {r["predicted"] for r in op.quality_scores(documents(spark, edge_texts()), one).collect()} == {1}
    assert op.quality_scores(documents(spark, []), one).count() == 0


def test_statistics():
    rows = list(op.text_statistics(pa.array(["Ab ab\nab\n", None, "!!|5"])))
    first, empty, last = (dict(zip(op.STATISTICS, r)) for r in rows)
    assert math.isclose(first["distinct_words"], 1 / 3)
    assert math.isclose(first["repeated_words"], 1.0) and math.isclose(first["share_upper"], 1 / 9)
    assert math.isclose(first["log_words"], math.log1p(3)) and math.isclose(first["lines"], math.log1p(2))
    assert first["longest_word"] == 2 and first["distinct_lines"] == 1.0
    assert empty["log_bytes"] == 0 and empty["distinct_words"] == 1.0
    assert last["share_shout"] == 0.5 and last["share_bar"] == 0.25 and last["share_digit"] == 0.25


def test_rules_are_conjunctions(spark):
    rule = op.Rule((("a", 1.0, 3.0), ("b", -math.inf, 0.5)))
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 0.0), (3.0, 0.5), (3.0, 0.6), (4.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(rule.column()).collect()] == [False, True, True, False, False]
    ensemble = op.Ensemble(0.5, ((rule, -1.5),))
    scores = [r[0] for r in df.select(ensemble.score().alias("s")).collect()]
    assert math.isclose(scores[1], 1 / (1 + math.exp(1.0))) and math.isclose(scores[0], 1 / (1 + math.exp(-0.5)))


def test_tree_paths_become_rules(spark):
    nodes = [(0, 0, 1, 2, 0, 5.0), (0, 1, 3, 4, 0, 2.0), (0, 2, -1, -1, -1, None), (0, 3, -1, -1, -1, None),
             (0, 4, -1, -1, -1, None)]
    df = spark.createDataFrame(nodes, "tree int, id int, left int, right int, feature int, threshold double")
    inf = math.inf
    assert {r.conditions[0] for r in op.tree_rules(df.withColumn("x", F.lit(1)), ("a",))} == {
        ("a", -inf, 5.0), ("a", 5.0, inf), ("a", -inf, 2.0), ("a", 2.0, 5.0),
    }


def test_rule_flags_are_the_rules_columns(spark):
    rng = random.Random(3)
    rows = [[rng.choice([0.0, 0.25, 0.5, 1.0, math.nan]) for _ in op.STATISTICS] for _ in range(40)]
    df = spark.createDataFrame(rows, ", ".join(f"{s} double" for s in op.STATISTICS))
    inf, (a, b, *_) = math.inf, op.STATISTICS
    rules = [op.Rule(((a, -inf, 0.25),)), op.Rule(((a, 0.25, inf),)), op.Rule(((a, 0.0, 0.5), (b, 0.25, inf)))]
    flags = op.rule_flags(rules).alias("flags")
    found = df.select(flags, *[r.column().cast("int").alias(f"r{k}") for k, r in enumerate(rules)]).collect()
    assert [list(r[0]) for r in found] == [list(r[1:]) for r in found]
    assert len({tuple(r[0]) for r in found}) > 3
    assert df.limit(0).select(flags).collect() == []


def test_the_fit_has_short_plans_and_a_stage_per_evaluation(spark, monkeypatch):
    # Seven files are seven tasks; sums over so many go in three stages per evaluation.
    n = 350
    labelled = spark.range(0, n, 1, 7).select(
        (F.col("id") % 2).cast("double").alias("label"),
        *[((F.col("id") * (k + 3) + F.col("id") % 2 * 40) % 101).cast("double").alias(s) for k, s in enumerate(op.STATISTICS)],
    )
    written = []
    monkeypatch.setattr(op, "cut_lineage", lambda df, cut=op.cut_lineage: written.append(df) or cut(df))
    spark.conf.set("spark.sql.files.openCostInBytes", "512m")
    context = spark.sparkContext
    context.setJobGroup("fit", "fit")
    try:
        ensemble = op.fit_rules(labelled, SMALL)
    finally:
        context.setJobGroup("none", "none")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert ensemble.rules
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup("fit")]
    assert len(jobs) > 20 and sum(len(job.stageIds) for job in jobs) < 1.5 * len(jobs)
    # The rules are data: the plan of their flags doesn't grow with them.
    assert len(written[-1]._jdf.queryExecution().analyzed().toJSON()) < 60_000
