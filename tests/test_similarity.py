"""Similar sets against all pairs, with a token that every set holds, and the replay of recorded decisions."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from layerwright.operators import evaluate, similarity


@pytest.mark.parametrize(("split", "threshold"), [(5_000, 0.5), (7, 0.5), (3, 0.25)])
def test_hot_tokens_lose_no_pair(spark, monkeypatch, split, threshold):
    monkeypatch.setattr(similarity, "SPLIT", split)
    rng = random.Random(split)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(6)]
    texts = [" ".join(["everywhere", *rng.sample(words, rng.randrange(6))]) for _ in range(120)]
    df = spark.createDataFrame([(t, rng.choice(["x", "y"])) for t in texts], "text string, kind string")
    sets = similarity.distinct_sets(similarity.token_sets(df, "text"))
    rows = {r.set_id: (r.kind, set(r.tokens)) for r in sets.collect()}
    got = {(r.probe_id, r.index_id): round(r.similarity, 9) for r in similarity.similar_sets(sets, sets, threshold).collect()}
    want = {(a, b): round(len(s & t) / len(s | t), 9) for a, (k, s) in rows.items() for b, (m, t) in rows.items() if k == m and len(s & t) >= threshold * len(s | t)}
    assert got == want


def test_pairs_with_too_few_common_tokens_stay_inside_the_join(spark):
    """Long sets of one vocabulary share rare tokens, but no two of them enough; only planted near copies come out."""
    rng = random.Random(5)
    words = ["w" + "".join(chr(97 + i // 26**k % 26) for k in range(3)) for i in range(1500)]
    texts = [rng.sample(words, 300) for _ in range(60)]
    texts += [t[:290] + rng.sample(words, 5) for t in texts[:4]]
    df = spark.createDataFrame([(" ".join(t), "x") for t in texts], "text string, kind string")
    sets = similarity._narrow(similarity.distinct_sets(similarity.token_sets(df, "text")))
    assert similarity._candidates(sets, sets, 0.5).count() == len(texts) + 2 * 4


def _shuffled(spark):
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty(30_000)
    executors = sc.statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def test_a_token_travels_as_numbers(spark):
    """Ranking tokens and letting them meet moves a few numbers for each, whatever else is known of their set."""
    rng = random.Random(11)
    words = ["w" + "".join(chr(97 + i // 26**k % 26) for k in range(3)) for i in range(8000)]
    texts = [" ".join(rng.sample(words, 250)) for _ in range(200)]
    texts += [t.rsplit(" ", 9)[0] for t in texts[:20]]
    spark.createDataFrame([(t, "x") for t in texts], "text string, kind string").write.parquet(folder := tempfile.mkdtemp() + "/texts")
    sets = similarity.token_sets(spark.read.parquet(folder), "text")
    before, broadcast = _shuffled(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert similarity.similar_sets(similarity.distinct_sets(sets), similarity.distinct_sets(sets), 0.5).count() == 220 + 2 * 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    used = _shuffled(spark) - before
    assert used < 150 * 250 * len(texts), used


def test_sets_of_two_sides_meet_across_only(spark):
    """Sets that stand on one side only, on both, and alike sets of no kind: every pair in every wanted direction, once."""
    rng = random.Random(3)
    rows = [(rng.choice(["x", "y", None]), " ".join(rng.sample("aa bb cc dd ee ff gg hh ii jj kk ll".split(), rng.randrange(1, 9)))) for _ in range(140)]
    one, two = (spark.createDataFrame(part * 2, "kind string, text string") for part in (rows[:90], rows[60:]))
    a, b = (similarity.distinct_sets(similarity.token_sets(df, "text")) for df in (one, two))
    left, right = ({r.set_id: (r.kind, set(r.tokens)) for r in df.collect()} for df in (a, b))
    for threshold in (0.3, 0.5, 0.8):
        got = [(r.probe_id, r.index_id, round(r.similarity, 9)) for r in similarity.similar_sets(a, b, threshold).collect()]
        want = [(i, j, round(len(s & t) / len(s | t), 9)) for i, (k, s) in left.items() for j, (m, t) in right.items()
                if k is not None and k == m and len(s & t) >= threshold * len(s | t)]
        assert sorted(got) == sorted(want)


def test_cells_bound_what_meets(spark, monkeypatch):
    monkeypatch.setattr(similarity, "SPLIT", 50)
    rows = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("id"), F.lit("hot").alias("token"), F.lit(3000).alias("df"))
    cells = similarity._cells(rows, "a", "b").groupBy("a", "b").count().agg(F.max("count").alias("most"), F.count("*").alias("cells"), F.percentile("count", 0.5).alias("mid")).first()
    assert cells.cells == 60 * 60 and cells.most < 2 * cells.mid + 20


def test_replay_leaves_its_own_decision_out(spark):
    m = "kind string, subject string, confidence double, original map<string,string>, final map<string,string>, correct boolean"
    rows = spark.createDataFrame([("k", "leaky tap", .9, {"c": "Plumbing"}, {"c": "plumbing"}, True), ("k", "leaky tap again", .8, {"c": "hvac"}, {"c": "plumbing"}, False),
                                  ("k", "nothing like it", .7, {"c": "hvac"}, {"c": "hvac"}, True)], m)
    verdicts = spark.createDataFrame([("k", "leaky tap", .95, True), ("k", "leaky tap again", .9, False)], "kind string, subject string, p_correct double, agrees boolean")
    scored = evaluate.replay(rows, verdicts)
    got = {r.subject: r for r in scored.collect()}
    assert (got["leaky tap"].human_signal, got["leaky tap again"].human_signal, got["nothing like it"].human_signal) == (1.0, 0.0, None)
    assert (got["leaky tap again"].judge_p, got["nothing like it"].judge_p) == (0.5, None)
    assert got["leaky tap"].trust == pytest.approx(0.6 + 0.3 * .95 + 0.1 * .9) and got["nothing like it"].trust == pytest.approx(.7)
    assert got["leaky tap again"].trust_no_human == pytest.approx((.3 * .5 + .1 * .8) / .4)
    top = {(r.ordering, r.k): r for r in evaluate.ranking_with_base(scored, depths=[1, 2]).collect()}
    assert (top["trust", 1].precision, top["trust", 1].recall, top["agent", 1].precision) == (1.0, 1.0, 0.0)
    assert {(r["items"], r.wrong, r.random_precision) for r in top.values()} == {(3, 1, 0.333)}
