"""Token-set similarity without comparing everything with everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from layerwright import fixed_values as fv
from layerwright import session
from layerwright.functions import clean

# sets of one token that meet in one cell of its grid
SPLIT = 5_000
# one in so many of the common tokens that a prefix holds beyond the first must be seen before a pair is measured
COUNTED = 4


def token_sets(df: DataFrame, text: str) -> DataFrame:
    """Add `tokens` (sorted distinct words) and `set_id`, equal for equal sets of one kind."""
    # the generator keeps the optimizer from copying the search for words into everything that reads `tokens`
    once = F.explode(F.array(F.array_sort(clean.tokens(F.col(text)))))
    return (df.withColumn("tokens", once).filter(F.size("tokens") > 0)
            .withColumn("set_id", F.sha2(F.concat_ws("\u001f", F.col("kind"), F.array_join("tokens", " ")), 256)))


def distinct_sets(df: DataFrame) -> DataFrame:
    """One row per different token set: copies of a text, however many, are compared once."""
    # as one text: a list of words takes several times the room in a shuffle, and words have no spaces
    one = df.groupBy("set_id").agg(F.min("kind").alias("kind"), F.min(F.array_join("tokens", " ")).alias("words"))
    return one.select("set_id", "kind", F.split("words", " ").alias("tokens"))


def _narrow(sets: DataFrame) -> DataFrame:
    """Sets with 64-bit token ids, which differ between kinds. A set without a kind is like no other."""
    ids = F.transform("tokens", lambda t: F.xxhash64("kind", t))
    return sets.filter(F.col("kind").isNotNull()).select("set_id", F.size("tokens").alias("n"), F.explode(F.array(ids)).alias("ids"))  # hashed once, see token_sets


def _both(probe: DataFrame, index: DataFrame) -> DataFrame:
    """The sets of both sides, each once and by a number: id, set_id, n, ids, asked (a probe), given (in the index)."""
    asked, given = (rows.withColumn("asked", F.lit(side)).withColumn("given", F.lit(not side)) for rows, side in ((probe, True), (index, False)))
    one = asked.unionByName(given).groupBy("set_id").agg(
        F.first("n").alias("n"), F.first("ids").alias("ids"), F.max("asked").alias("asked"), F.max("given").alias("given"))
    return session.staged(one.withColumn("id", F.monotonically_increasing_id()), "sets")


def _prefix(both: DataFrame, threshold: float) -> DataFrame:
    """The rarest tokens of each set with their places, enough that two sets with the wanted overlap must share one.

    Tokens that no two sets of different sides share come first: they take places and need no row.
    """
    words = both.select("id", "asked", "given", F.explode("ids").alias("token"))
    shared = words.groupBy("token").agg(F.count("*").alias("df"), F.max("asked").alias("asked"), F.max("given").alias("given")).filter("df > 1 AND asked AND given")
    order = F.array_sort(F.collect_list(F.struct("df", "token")))
    ranked = words.select("id", "token").join(shared.select("token", "df"), "token").groupBy("id").agg(order.alias("order"))
    alone = F.col("n") - F.size("order")
    keep = F.col("n") - F.ceil(F.col("n") * threshold - F.lit(1e-9)) + 1 - alone
    head = F.slice("order", F.lit(1), F.greatest(keep, F.lit(0)).cast("int"))
    return (ranked.join(both.select("id", "n", "asked", "given"), "id").select("id", "n", "asked", "given", alone.alias("alone"), F.posexplode(head).alias("place", "t"))
            .select("id", "n", "asked", "given", (F.col("alone") + F.col("place") + 1).alias("r"), "t.token", "t.df"))


def _cells(rows: DataFrame, own: str, other: str) -> DataFrame:
    """Deal the rows of a frequent token over a grid: both sides fall into parts of some SPLIT rows, and every part of one side
    meets every part of the other in a cell of its own. How many parts there are follows from the token's count alone."""
    parts = F.ceil(F.greatest("df", F.lit(1)) / SPLIT)
    return rows.withColumn(own, F.pmod(F.xxhash64("id"), parts)).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("df")


def _met(both: DataFrame, threshold: float) -> DataFrame:
    """pid, iid: different sets that lengths, places and the number of common rare tokens leave. Of sets that stand on both sides, each
    two come once.

    A pair needs `needed` common tokens, and `spare` may be missing before the end of a prefix is reached. So of the first
    part of `spare` plus one common tokens, each has `needed` less that part from its place on, on both sides: tokens without that don't
    count, and the others must be that many. Nothing but two numbers and that count leaves the join for a common token.
    """
    rows = _prefix(both, threshold)
    p = _cells(rows.filter("asked"), "a", "b").select(
        F.col("id").alias("pid"), "token", "a", "b", F.col("n").alias("pn"), F.col("r").alias("pr"), F.col("given").alias("also"))
    i = _cells(rows.filter("given"), "b", "a").select(
        F.col("id").alias("iid"), "token", "a", "b", F.col("n").alias("i_n"), F.col("r").alias("ir"), F.col("asked").alias("too"))
    lengths = (F.col("pn") >= F.col("i_n") * threshold) & (F.col("i_n") >= F.col("pn") * threshold)
    needed = F.ceil((F.col("pn") + F.col("i_n")) * (threshold / (1 + threshold)) - F.lit(1e-9))
    spare = needed - F.ceil(F.greatest("pn", "i_n") * threshold - F.lit(1e-9))
    more = F.greatest(F.floor(spare / COUNTED), F.lit(0))
    left_over = 1 + F.least(F.col("pn") - F.col("pr"), F.col("i_n") - F.col("ir"))
    once = (F.col("pid") != F.col("iid")) & (~F.col("also") | ~F.col("too") | (F.col("pid") < F.col("iid")))
    met = p.join(i, ["token", "a", "b"]).filter(once & lengths & (left_over >= needed - more)).select("pid", "iid", (more + 1).alias("least"))
    # by one side: what a set meets stays together and packs well
    return met.repartition("pid").groupBy("pid", "iid").agg(F.count("*").alias("c"), F.first("least").alias("least")).filter("c >= least").select("pid", "iid")


def _candidates(probe: DataFrame, index: DataFrame, threshold: float) -> DataFrame:
    """probe_id, index_id, both, common: the pairs with enough common tokens, measured by their token ids, and every set of both sides with itself."""
    sets = _both(probe, index)
    left = sets.select(F.col("id").alias("pid"), F.col("set_id").alias("probe_id"), F.col("ids").alias("pt"), F.col("given").alias("also"))
    right = sets.select(F.col("id").alias("iid"), F.col("set_id").alias("index_id"), F.col("ids").alias("it"), F.col("asked").alias("too"))
    common = F.explode(F.array(F.size(F.array_intersect("pt", "it")))).alias("common")  # measured once, see token_sets
    met = (_met(sets, threshold).join(left, "pid").join(right, "iid")
           .select("probe_id", "index_id", (F.size("pt") + F.size("it")).alias("both"), (F.col("also") & F.col("too")).alias("mutual"), common))
    ways = F.when(F.col("mutual"), F.array(F.struct("probe_id", "index_id"), F.struct(F.col("index_id").alias("probe_id"), F.col("probe_id").alias("index_id"))))
    way = F.explode(F.coalesce(ways, F.array(F.struct("probe_id", "index_id")))).alias("way")
    enough = met.filter(F.col("common") >= F.col("both") * (threshold / (1 + threshold)) - F.lit(1e-9)).select(way, "both", "common").select("way.*", "both", "common")
    own = sets.filter("asked AND given").select(F.col("set_id").alias("probe_id"), F.col("set_id").alias("index_id"), (2 * F.col("n")).alias("both"), F.col("n").alias("common"))
    return enough.unionByName(own)


def similar_sets(probe: DataFrame, index: DataFrame, threshold: float) -> DataFrame:
    """probe_id, index_id, similarity for all pairs of distinct sets of one kind with Jaccard >= threshold.

    Pairs come from an equality join on rare tokens (prefix filter) with two conditions: the lengths can
    reach the threshold, and so can the tokens left from the match on (both sides are in the same order,
    so the first common tokens of a wanted pair always pass). A token that many sets hold is split over a grid of
    tasks. Rows are numbers only: of pairs, those with enough common rare tokens are left, and only for them token ids are
    fetched and measured.
    """
    pairs = _candidates(_narrow(probe), _narrow(index), threshold)
    similarity = F.col("common") / (F.col("both") - F.col("common"))
    return pairs.select("probe_id", "index_id", similarity.alias("similarity")).filter(F.col("similarity") >= threshold)


def recall(batch: DataFrame, episodes: DataFrame, k: int = fv.RECALL_K, min_similarity: float = fv.RECALL_MIN_SIMILARITY,
           exclude: DataFrame | None = None) -> DataFrame:
    """Best precedents per batch: batch_id, kind, text on one side, kind, text on the other.

    An episode counts with its best similarity to any text of the batch. `exclude` (batch_id, text) names episodes
    that a batch must not see, as in leave-one-out evaluation; by default a precedent with the very same text is
    the best answer there is.
    """
    # the token sets are read by several steps: written once, so that no text is cut into words twice
    q = session.staged(token_sets(batch, "text"), "batch-tokens")
    e = session.staged(token_sets(episodes.select("kind", "text").distinct(), "text"), "episode-tokens")
    pairs = similar_sets(distinct_sets(q), distinct_sets(e), min_similarity)
    texts = q.select("batch_id", "kind", F.col("text").alias("q_text"), F.col("set_id").alias("probe_id")).distinct()
    found = texts.join(pairs, "probe_id").join(
        e.select(F.col("set_id").alias("index_id"), F.col("text").alias("episode")), "index_id")
    best = found.groupBy("batch_id", "episode").agg(F.max("similarity").alias("similarity"))
    if exclude is not None:
        best = best.join(exclude.select("batch_id", F.col("text").alias("episode")), ["batch_id", "episode"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("batch_id").orderBy(F.desc("similarity"), "episode"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k)


def _fields(answer: Column) -> Column:
    """Fields of an answer with lower-case values."""
    return F.transform_values(answer, lambda k, v: F.lower(v))


def _as_key(answer: Column) -> Column:
    """Text that is equal for equal answers: maps cannot be grouped."""
    return F.to_json(F.array_sort(F.map_entries(answer)))


def human_signal(asked: DataFrame, decisions: DataFrame, min_similarity: float = fv.HUMAN_MIN_SIMILARITY) -> DataFrame:
    """kind, text, answer (a map of fields) -> share of similar human decisions that have all the asked fields.

    One row per asked (kind, text, answer). The signal is NULL with 0 votes where no similar decision exists. Decisions
    on the very same text do not vote. Votes are counted per (set, answer) and the same-text part is
    subtracted, so a text decided a million times is one row here and not a million pairs.
    """
    fields, key = _fields(F.col("answer")), _as_key(F.col("fields"))
    question = (asked.select("kind", "text", fields.alias("fields")).withColumn("answer_key", key)
                .groupBy("kind", "text", "answer_key").agg(F.first("fields").alias("fields")))
    # texts travel twice only, to find equal questions and into the result: between, a question is a number and a text its hash
    text_id = F.unhex(F.sha2("text", 256)).alias("text_id")
    question = session.staged(question.select(F.monotonically_increasing_id().alias("question"), "kind", "text", text_id, "fields"), "questions")
    a = session.staged(token_sets(question, "text").select("question", "kind", "fields", "tokens", "set_id"), "asked-tokens")
    d = session.staged(token_sets(decisions.withColumn("fields", fields).withColumn("answer_key", key), "text")
                       .select("kind", text_id, "fields", "answer_key", "tokens", "set_id"), "decision-tokens")
    votes = d.groupBy("set_id", "answer_key").agg(F.first("fields").alias("fields"), F.count("*").alias("n"))
    per_set = votes.groupBy("set_id").agg(F.sum("n").alias("all_n"), F.collect_list(F.struct("fields", "n")).alias("answers"))
    pairs = similar_sets(distinct_sets(a), distinct_sets(d), min_similarity)
    near = (a.select("question", "fields", F.col("set_id").alias("probe_id")).join(pairs, "probe_id")
            .join(per_set.withColumnRenamed("set_id", "index_id"), "index_id"))

    def same(given: Column) -> Column:
        return F.forall(F.map_keys("fields"), lambda f: F.try_element_at(given, f).eqNullSafe(F.try_element_at("fields", f)))

    agree = F.aggregate("answers", F.lit(0).cast("long"), lambda n, x: n + F.when(same(x["fields"]), x["n"]).otherwise(0))
    total = near.groupBy("question").agg(F.sum("all_n").alias("all_n"), F.sum(agree).alias("agree_n"))
    own = (d.groupBy("kind", "text_id", "answer_key").agg(F.first("fields").alias("given"), F.count("*").alias("n"))
           .groupBy("kind", "text_id").agg(F.sum("n").alias("own_n"), F.collect_list(F.struct(F.col("given").alias("fields"), "n")).alias("answers")))
    counted = question.select("question", "kind", "text_id", "fields").join(total, "question").join(own, ["kind", "text_id"], "left")
    n = F.col("all_n") - F.coalesce("own_n", F.lit(0))
    ok = F.col("agree_n") - F.coalesce(agree, F.lit(0))
    counted = counted.select("question", F.when(n > 0, ok / n).alias("human_signal"), n.alias("votes"))
    return question.join(counted, "question", "left").select(
        "kind", "text", F.col("fields").alias("answer"), "human_signal", F.coalesce("votes", F.lit(0)).cast("long").alias("votes"))


# ------------------------------------------------------------------ leakage
def _plain(text: Column) -> Column:
    return F.lower(clean.collapse(text))


def leaked_items(items: DataFrame, corpus: DataFrame) -> DataFrame:
    """item_id, doc_id: items whose text occurs inside a corpus text (case and white space ignored).

    An inner word of an item must be a whole word of the corpus text, so the inner word that the fewest texts hold
    is the join key; the containment test then runs on those few candidates. Items of one or two words have
    no inner word: they meet the corpus by their first word's letters, as an ending of a corpus word.
    """
    it = items.select("item_id", _plain(F.col("text")).alias("needle")).filter(F.length("needle") > 0)
    keyed = it.withColumn("words", F.split("needle", " "))
    docs = corpus.select("doc_id", _plain(F.col("text")).alias("hay"))
    terms = docs.select("doc_id", F.explode(F.array_distinct(F.split("hay", " "))).alias("word"))
    inner = keyed.filter(F.size("words") >= 3).select("item_id", F.explode(F.array_distinct(
        F.slice("words", 2, F.size("words") - 2))).alias("word"))
    # the inner word that fewest texts hold: an item with an inner word that no text holds is in none
    uses = terms.groupBy("word").agg(F.count("*").alias("uses"))
    rarest = (inner.join(uses, "word", "left").withColumn("uses", F.coalesce("uses", F.lit(0)))
              .withColumn("r", F.row_number().over(Window.partitionBy("item_id").orderBy("uses", "word"))).filter("r = 1 AND uses > 0"))
    by_word = terms.join(rarest.select("item_id", "word"), "word").select("doc_id", "item_id")
    short = keyed.filter(F.size("words") < 3).select(
        "item_id", F.element_at("words", 1).alias("part"), (F.size("words") == 1).alias("single"))
    # one number per different word length: bounded by the longest first word of an item
    lengths = [r[0] for r in short.select(F.length("part")).distinct().collect()]
    pairs = by_word
    if lengths:
        # a single word may sit anywhere inside a corpus word, a first word only at its end
        pieces = (terms.select("doc_id", "word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("i"))
                  .filter(F.length("word") > 0)
                  .select("doc_id", "word", "i", F.explode(F.array(*[F.lit(n) for n in lengths])).alias("len"))
                  .filter(F.col("i") + F.col("len") - 1 <= F.length("word"))
                  .select("doc_id", F.col("word").substr(F.col("i"), F.col("len")).alias("part"),
                          (F.col("i") + F.col("len") - 1 == F.length("word")).alias("ends")))
        pairs = by_word.unionByName(pieces.join(short, "part").filter(F.col("single") | F.col("ends")).select("doc_id", "item_id"))
    pairs = pairs.distinct()
    return (pairs.join(docs, "doc_id").join(it, "item_id").filter(F.contains(F.col("hay"), F.col("needle")))
            .select("item_id", "doc_id"))
