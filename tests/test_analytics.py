import random

import pytest
from pyspark.sql import functions as F

from layerwright import fixed_values as fv
from layerwright.operators import evaluate, metrics, profile, review, similarity


def test_trust(spark):
    def trust(a, j, h):
        row = spark.createDataFrame([(a, j, h)], "a double, j double, h double")
        return row.select(review.trust_score(F.col("a"), F.col("j"), F.col("h"))).first()[0]
    assert trust(0.95, 0.1, 1.0) > 0.6 and trust(0.99, 0.1, 0.0) < 0.15
    assert trust(None, 0.8, None) == pytest.approx(0.8) and trust(None, None, None) == 0


def words(text):
    import re
    return {w for w in re.findall("[a-z]+", text.lower()) if len(w) > 1 and w not in fv.STOP_WORDS}


def test_similarity_against_brute_force(spark):
    rng = random.Random(11)
    vocab = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    texts = [" ".join(rng.choices(vocab, weights=[1 / (i + 1) for i in range(60)], k=rng.randint(1, 14))) for _ in range(150)]
    texts += texts[:10] * 5
    data = [("k" + str(i % 2), t, rng.choice("xy")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "kind string, text string, answer string")
    # a decision holds two fields, a question asks for one; one question is about a text that is like nothing
    decided = df.withColumn("answer", F.create_map(F.lit("a"), F.upper("answer"), F.lit("b"), F.lit("other")))
    alone = spark.createDataFrame([("k0", "qqq zzz", "x"), ("k0", "", "x")], "kind string, text string, answer string")
    asked = df.unionAll(alone).withColumn("answer", F.create_map(F.lit("a"), F.col("answer")))
    want = {("k0", "qqq zzz", "x"): None, ("k0", "", "x"): None}
    for kind, text, answer in set(data):
        votes = [b == answer for k, t, b in data if k == kind and t != text and words(t) and words(text)
                 and len(words(t) & words(text)) / len(words(t) | words(text)) >= 0.5]
        want[kind, text, answer] = sum(votes) / len(votes) if votes else None
    got = {(r.kind, r.text, r.answer["a"]): r.human_signal for r in similarity.human_signal(asked, decided).collect()}
    assert {k: pytest.approx(v) if v is not None else None for k, v in want.items()} == got
    for t in (0.25, 0.6):
        s = similarity.token_sets(df, "text")
        pairs = {(r.probe_id, r.index_id) for r in similarity.similar_sets(similarity.distinct_sets(s), similarity.distinct_sets(s), t).collect()}
        sets = {r.set_id: (r.kind, set(r.tokens)) for r in s.collect()}
        brute = {(a, b) for a, (ka, x) in sets.items() for b, (kb, y) in sets.items() if ka == kb and len(x & y) / len(x | y) >= t}
        assert pairs == brute


def test_recall_finds_the_same_text_unless_it_is_left_out(spark):
    eps = spark.createDataFrame([("t", "drain clogged in cleaner cupboard"), ("t", "paint peeling in lobby")], "kind string, text string")
    ask = spark.createDataFrame([(1, "t", "kitchen drain clogged again"), (2, "t", "drain clogged in cleaner cupboard")], "batch_id int, kind string, text string")
    same = "drain clogged in cleaner cupboard"
    assert sorted((r.batch_id, r.episode, r.similarity == 1) for r in similarity.recall(ask, eps).collect()) == [(1, same, False), (2, same, True)]
    assert [(r.batch_id, r.episode) for r in similarity.recall(ask, eps, exclude=ask.select("batch_id", "text")).collect()] == [(1, same)]


def test_a_word_in_every_text_makes_no_pairs_of_all(spark):
    rows = spark.createDataFrame([("k", f"common a{chr(97 + i % 26)} b{chr(97 + i // 26 % 26)}x{chr(97 + i % 7)}") for i in range(600)], "kind string, text string")
    sets = similarity.distinct_sets(similarity.token_sets(rows, "text"))
    found = similarity.similar_sets(sets, sets, 0.9)
    assert found.count() == sets.count()


def test_leak_anchor_is_the_rarest_inner_word(spark):
    docs = spark.createDataFrame([(i, f"the longestcommonword of text number{i} ends") for i in range(50)], "doc_id int, text string")
    items = spark.createDataFrame([(1, "longestcommonword of text number7 ends"), (2, "of TEXT  number8 ends"), (3, "a nowhere b")], "item_id int, text string")
    assert sorted((r.item_id, r.doc_id) for r in similarity.leaked_items(items, docs).collect()) == [(1, 7), (2, 8)]


def test_leakage_against_brute_force(spark):
    items = ["ac", "fire alarm", "water leak in the roof", "it", "Roof  Leak", "x"]
    docs = ["the ac is access", "big fire  alarms", "A water leak in THE roof again", "with", "proof leaking", "campfire alarm", "", "roof leak"]
    i = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id int, text string")

    def plain(t):
        return " ".join(t.lower().split())
    want = {(a, b) for a, x in enumerate(items) for b, y in enumerate(docs) if plain(x) in plain(y)}
    assert {tuple(r) for r in similarity.leaked_items(i, d).collect()} == want


def test_category_report(spark):
    rows = spark.createDataFrame([("hvac", "hvac"), ("hvac|it", "plumbing"), ("plumbing|x", "plumbing"), ("plumbing", None)], "expected string, predicted string")
    rows = rows.withColumn("id", F.monotonically_increasing_id())
    full = evaluate.with_truth(rows.select("id", "expected"), rows.select("id", "predicted"), "id")
    rep = {r.category: (r.precision, r.recall, r.f1, r.support) for r in evaluate.category_report(full).collect()}
    assert rep == {"hvac": (1.0, 0.5, 0.667, 2), "plumbing": (0.5, 0.5, 0.5, 2)}
    assert evaluate.macro_f1(evaluate.category_report(full)).first().macro_f1 == round((0.667 + 0.5) / 2, 4)


def test_queue_ranking(spark):
    rows = [(i, c, a) for i, (c, a) in enumerate([(False, .1), (False, .2), (True, .3), (True, .9), (True, .95)])]
    df = spark.createDataFrame(rows, "item int, correct boolean, agent_conf double").withColumns({"judge_p": F.col("agent_conf"), "trust": F.col("agent_conf")})
    got = {(r.ordering, r.k): (r.precision, r.recall) for r in evaluate.queue_ranking(df, "item", [2, 3]).collect()}
    assert got["trust", 2] == (1.0, 1.0) and got["trust", 3] == (0.667, 1.0)


def test_tags_and_groundedness(spark):
    def prof(name, values, **extra):
        rows = [(v,) for v, n in values for _ in range(n)]
        return profile.full_profile(profile.value_counts(spark.createDataFrame(rows, f"{name} string"), [name]))

    def tag(p):
        r = profile.tag_columns(p).first()
        return r.semantic_type, r.sensitivity, r.tags
    assert tag(prof("submitted_by", [("John Smith", 5), ("J. Doe", 4)]))[:2] == ("person_name", "pii")
    assert tag(prof("ticket_id", [("TKT-1", 1)]))[0] == "identifier"
    assert tag(prof("created_at", [("2024-03-15 10:30:00", 2), ("03/15/2024", 1)]))[1] == "internal"
    assert "pii:contact" in tag(prof("contact", [("+91 98765 43210", 9)]))[2]
    assert "may_contain_pii" in tag(prof("notes", [("Pipe burst in the kitchen, water everywhere", 2)]))[2]
    numbers = profile.profile_numbers(spark.createDataFrame([("cost", 10280, 2637, "N/A", 494, "-999", 3)],
                                                            "column string, total int, empty int, v1 string, n1 int, v2 string, n2 int"), {"total_rows": 10280})
    claims = spark.createDataFrame([("a", "cost", "Cost has 2,637 empty (25.65%), 494 N/A, -999 sentinels and 8 formats"),
                                    ("b", "cost", "Cost has 3,100 empty values and 494 N/A")], "check_id string, column string, text string")
    got = {r.check_id: r for r in profile.groundedness(claims, numbers, F.lit(10280)).collect()}
    assert (got["a"].cited, got["a"].score) == (4, 1.0)
    assert got["b"].ungrounded == ["3,100"] and got["b"].score == 0.5
    big = spark.createDataFrame([("size", 2.5e9, [("about 77", 40)])], "column string, total double, top array<struct<value:string,n:int>>")
    said = spark.createDataFrame([("none", "size", "no numbers"), ("big", "size", "2,500,000,000 rows, 77 and 40 seen, 41 not"),
                                  ("other", "nowhere", "40 of them"), ("null", "size", None)], "check_id string, column string, text string")
    got = {r.check_id: (r.cited, r.score, r.ungrounded) for r in
           profile.groundedness(said, profile.profile_numbers(big, {}), F.lit(100)).collect()}
    assert got == {"none": (0, None, []), "big": (4, 0.75, ["41"]), "other": (1, 1.0, []), "null": (0, None, [])}


def test_cost_and_latency(spark):
    prices = spark.createDataFrame([("m1", 2.0, 10.0)], "model string, price_in double, price_out double")
    calls = spark.createDataFrame([("ollama", "zz", 1, 1), ("h", "vendor/m1", 1000, 100), ("h", "other", 5, 5)],
                                  "provider string, model string, input_tokens int, output_tokens int")
    assert [r.cost_usd for r in metrics.with_cost(calls, prices).orderBy("input_tokens").collect()] == [0.0, None, pytest.approx(0.003)]
    for n in (1, 19, 20, 21, 100):
        vals = [random.Random(n + i).randrange(30) for i in range(n)]
        df = spark.createDataFrame([("p", "ok", v) for v in vals], "provider string, status string, latency_ms long")
        assert metrics.latency(df, ["provider"]).first().p95 == sorted(vals)[min(n - 1, int(0.95 * n))]


def test_policy(spark):
    rows = spark.createDataFrame([("rules", 1.0, 1.0, 0.9), ("model", .99, .2, 0.1), ("model", .99, .9, None), ("model", .5, .9, .9)],
                                 "source string, confidence double, trust double, judge_p double")
    assert [r.approve for r in review.policy(rows, True).collect()] == [False, False, False, True]
    assert [r.approve for r in review.policy(rows, False).collect()] == [False, True, True, False]
    assert "judge" in review.policy(rows, True).collect()[2].reason
