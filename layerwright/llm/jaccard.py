"""Set similarity join on word shingles by PartEnum signatures.

Two sets link when the size of their intersection is at least 85/100 of that of their union. For sets of a known range of sizes
this bounds the number of shingles that only one of them has, say by k. Cut the space of shingles into p partitions by
hash: at most k partitions can then differ, so at least p - k of them are equal. Every set emits a signature for each
choice of m <= p - k partitions; two sets that link share one at least, and only sets that share one are compared.

* Sizes fall into bands that grow by `GROWTH`. The scheme of a band takes the sets of the band and those up to 100/85 times
  as large, so any two sets that can link meet in the scheme of the smaller one.
* Empty partitions say nothing and would be shared by strangers. A scheme has some partitions more than it needs, and sets
  with no more empty ones than that only emit signatures of partitions that hold something. The few with more of them also
  emit the others, in a name space of their own, where only such sets meet.
* Within a signature's sets not all pairs are compared. First all sets are compared with one of them, the pivot. Signatures of up to
  `SMALL` sets that this leaves unconnected then give their remaining pairs. Larger ones are cut down by how their sets
  differ from a common pivot (`difference_keys`): two sets that link share such a key. So no link is lost, and a group
  of thousands of near copies costs a few comparisons for each, also where most of them do not link.
* Before two sets are compared, their sketches are: 512 bits, each the parity of a share of the elements. Every bit that differs
  stands for an element that only one set has, so too many of them rule a link out.

Shingles are 64-bit hashes; copies (equal sets) are compared by a 128-bit digest and then stand for one.

Cases: null, empty and blank texts have an empty set, which links with nothing. Rows that share a key are one document, linked by all
its texts; a null key gets a null component and takes no part. Further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwright import session
from layerwright.llm.common import map_batches
from layerwright.llm.components import components

WORDS = 4
NUM, DEN = 85, 100
GROWTH = 1.3
SMALL = 32           # sets of one signature whose pairs are compared one by one
VOTES = 3            # rounds in which large signatures agree on pivots
SKETCH = 8           # longs
_PAIRS_BELOW = 48    # sets this small sign choices of two partitions, larger ones single partitions
_ENUMERATE = 3       # up to this difference all choices of p - k partitions are signed
_TAIL = 1e-4         # share of sets that may have more empty partitions than the scheme has to spare
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """Hash of each word, kept for the words that come again."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """The sorted, distinct hashes of all runs of `size` words; of the whole text if it has fewer."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.array([_HASHES[w] for w in words], np.uint64)
    runs = max(1, len(codes) - size + 1)
    out = np.full(runs, min(len(codes), size), np.uint64) * _ODD[-1]
    for i in range(min(size, len(codes))):
        out += mix(codes[i:i + runs] + np.uint64(i)) * _ODD[i % 4]
    return np.unique(mix(out))


class Scheme:
    """How the sets of one band are signed."""

    def __init__(self, number: int, low: int, high: int) -> None:
        self.number, self.low = number, low
        self.last = high * DEN // NUM                              # the largest set that links with one of the band
        self.k = (high + self.last) * (DEN - NUM) // (DEN + NUM)   # shingles that only one of two linked sets has, at most
        self.sparse_above = None
        if self.k == 0:
            self.p, self.m = 1, 1
        elif self.k <= _ENUMERATE:
            self.p, self.m = self.k + 3, 3
        else:
            self.m = 2 if low < _PAIRS_BELOW else 1
            spare = 0
            while spare < self.k // 3 + 2 and self._tail(self.k + self.m + spare, spare) > _TAIL:
                spare += 1
            self.p, self.sparse_above = self.k + self.m + spare, spare
        self.choices = np.array(list(combinations(range(self.p), self.m)), np.int64) if self.m > 1 else None
        self.salt = mix(np.array([number], np.uint64) * _ODD[0])[0]

    def _tail(self, p: int, spare: int) -> float:
        """Share of the smallest sets with more than `spare` empty partitions."""
        mean = p * (1 - 1 / p) ** self.low
        return 1 - sum(math.exp(-mean) * mean ** i / math.factorial(i) for i in range(spare + 1))

    def sign(self, grams: np.ndarray) -> list[np.ndarray]:
        own = mix(grams ^ self.salt)
        part = (own >> np.uint64(33)).astype(np.int64) % self.p
        sums = np.zeros(self.p, np.uint64)
        np.add.at(sums, part, mix(own))
        sums = mix(sums + np.bincount(part, minlength=self.p).astype(np.uint64) * _ODD[1])
        full = np.bincount(part, minlength=self.p) > 0
        if self.m == 1:
            signed, all_full = mix(sums + np.arange(self.p, dtype=np.uint64) * _ODD[2] + self.salt), full
        else:
            signed = np.arange(len(self.choices), dtype=np.uint64) * _ODD[2] + self.salt
            for i in range(self.m):
                signed = mix(signed + sums[self.choices[:, i]])
            all_full = full[self.choices].all(axis=1)
        if self.sparse_above is None:
            return [signed]
        if self.p - int(full.sum()) <= self.sparse_above:
            return [signed[all_full]]
        return [signed[all_full], mix(signed ^ _ODD[3])]


@lru_cache(maxsize=1024)
def _band(number: int) -> tuple[int, int]:
    if number == 0:
        return 1, 1
    low = _band(number - 1)[1] + 1
    return low, max(low, math.ceil(low * GROWTH) - 1)


@lru_cache(maxsize=1024)
def _scheme(number: int) -> Scheme:
    return Scheme(number, *_band(number))


def schemes(size: int) -> list[Scheme]:
    """The schemes that sets of this size take part in: that of their band and those below that reach up to it."""
    number = 0
    while _band(number)[1] < size:
        number += 1
    out = [_scheme(number)]
    while number and _scheme(number - 1).last >= size:
        number -= 1
        out.append(_scheme(number))
    return out


def signatures(grams: np.ndarray) -> np.ndarray:
    if not len(grams):
        return np.empty(0, np.int64)
    return np.unique(np.concatenate([s for scheme in schemes(len(grams)) for s in scheme.sign(grams)])).view(np.int64)


def sketch(grams: np.ndarray) -> np.ndarray:
    """Bit i of all is the parity of the elements that fall to i: sketches of two sets differ in no more bits than the sets do in elements."""
    place = (mix(grams ^ _ODD[4]) >> np.uint64(40)).astype(np.int64) % (64 * SKETCH)
    odd = np.bincount(place, minlength=64 * SKETCH).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def most_different(size: int) -> int:
    """How many elements can at most be in only one of two sets that link, if one has this size."""
    return (size + size * DEN // NUM) * (DEN - NUM) // (DEN + NUM)


def difference(grams: np.ndarray, pivot_grams: np.ndarray) -> np.ndarray:
    """What only one of a set and a pivot has, in an order that all sets with this pivot follow.

    What a set has beyond the pivot comes first, as few others will have it.
    """
    beyond = np.setdiff1d(grams, pivot_grams, assume_unique=True)
    lacking = np.setdiff1d(pivot_grams, grams, assume_unique=True)
    return np.concatenate((np.sort(beyond), np.sort(lacking)))


def difference_keys(grams: np.ndarray, pivot_grams: np.ndarray, pivot: int) -> np.ndarray:
    """Keys of a set by how it differs from a pivot.

    Let X and Y be the differences of two sets from the pivot. The sets differ from each other in |X| + |Y| - 2 |X & Y| elements,
    so if that is at most k, |Y| is at least |X| - k, and X and Y share at least t = (|X| + |Y| - k) / 2 >= |X| - k
    elements. In an order that both follow, the first |X| - t + 1 elements of X and the first |Y| - t + 1 of Y have one in common if t
    is positive; the first k + 1 of each hold these. If t is not, X and Y have at most k elements each; sets that differ so
    little from the pivot have one more key, the same for all.
    """
    k, own = most_different(len(grams)), difference(grams, pivot_grams)
    salt = mix(np.array([pivot], np.int64).view(np.uint64) * _ODD[1])
    out = [mix(own[:k + 1] ^ salt)]
    if len(own) <= k:
        out.append(mix(salt * _ODD[3]))
    return np.unique(np.concatenate(out)).view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *parts])))


def join(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per row of `docs`: the key, `n_shingles` and `component_id`, the smallest key reachable by links."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))

    def sized(batch: pa.RecordBatch) -> dict[str, object]:
        sets = [shingles(t) for t in batch.column(1).to_pylist()]
        return {"id": batch.column(0), "n": pa.array([len(s) for s in sets], pa.int64()),
                "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                "sketch": _lists([sketch(s) for s in sets]), "sigs": _lists([signatures(s) for s in sets])}

    # one pass over the texts: sizes and signatures come from the same sets
    sizes = session.staged(map_batches(rows, sized, "id long, n long, digest binary, sketch array<long>, sigs array<long>"), "set-sizes")
    known = sizes.filter(F.col("id").isNotNull() & (F.col("n") > 0))
    # equal sets stand for one: the smallest id among them
    first = known.groupBy("digest").agg(F.min("id").alias("rep"))
    reps = session.staged(known.select("id", "n", "digest").join(first, "digest").select("id", "rep", "n").distinct(), "set-reps")
    # the sketch of a set is the same in all its copies: that of the smallest key with that set
    info = session.staged(known.join(first, "digest").filter(F.col("id") == F.col("rep"))
                          .select("rep", "n", "digest", *[F.col("sketch")[i].alias(f"s{i}") for i in range(SKETCH)])
                          .dropDuplicates(["rep", "digest"]).drop("digest"), "set-sketches")

    each = sizes.filter(F.col("id").isNotNull()).select("id", F.explode("sigs").alias("sig"))
    shared = each.withColumn("other", F.min("id").over(Window.partitionBy("sig"))).withColumn(
        "last", F.max("id").over(Window.partitionBy("sig"))).filter(F.col("other") != F.col("last")).select("sig", "id")
    met = session.staged(shared, "shared-signatures")
    met = met.join(reps, "id").select("sig", "rep", "n").distinct()
    many = met.groupBy("sig").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter(F.col("a") != F.col("b")).select("sig")
    met = session.staged(met.join(many, "sig", "left_semi"), "shared-by-others")

    wanted = met.select(F.col("rep").alias("id")).distinct()

    def listed(batch: pa.RecordBatch) -> dict[str, object]:
        return {"id": batch.column(0), "grams": _lists([shingles(t).view(np.int64) for t in batch.column(1).to_pylist()])}

    # a key with several texts has a set for each, and is linked by any of them
    sets = map_batches(rows.join(wanted, "id", "left_semi"), listed, "id long, grams array<long>")
    several = reps.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter(F.col("a") != F.col("b"))
    sets = session.staged(sets, "sets")
    own_links = reps.join(several.select("id", "a"), "id").select("a", F.col("rep").alias("b")).filter(F.col("a") != F.col("b"))
    labels = _linked(met, info, sets, own_links)
    done = (reps.select("id", "rep").join(labels, F.col("rep") == F.col("node"), "left")
            .groupBy("id").agg(F.min(F.coalesce("component", "rep")).alias("component_id")))
    return sizes.select("id", "n").join(done, "id", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def _linked(met: DataFrame, info: DataFrame, sets: DataFrame, own_links: DataFrame) -> DataFrame:
    """Components of the representatives, from the signatures they share: `met` (sig, rep, n)."""
    stars = session.staged(_stars(met), "stars")
    first = session.staged(_pair(stars, "rep", "pivot").distinct(), "pairs")
    edges = session.staged(own_links.unionByName(_verified(first, info, sets)), "links")
    labels = session.staged(components(edges), "components")
    # signatures whose sets are not all connected yet
    here = _with_component(met, labels)
    open_ = here.groupBy("sig").agg(F.count(F.lit(1)).alias("m"), F.min("component").alias("low"), F.max("component").alias("high")).filter(
        F.col("low") != F.col("high")).select("sig", "m")
    here = session.staged(here.join(open_, "sig"), "open-signatures")
    other = here.filter(F.col("m") <= SMALL).select("sig", F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("of_b"))
    fit = (F.least("n", "n_b") * DEN >= F.greatest("n", "n_b") * NUM) & (F.col("component") != F.col("of_b")) & (F.col("rep") < F.col("b"))
    small = here.filter(F.col("m") <= SMALL).join(other, "sig").filter(fit)
    large = _by_differences(here.filter(F.col("m") > SMALL), stars, info, sets)
    more = _pair(small, "rep", "b").unionByName(_pair(large, "rep", "b")).distinct().join(first, ["a", "b"], "left_anti")
    found = _verified(session.staged(more, "pairs"), info, sets)
    return session.staged(components(edges.unionByName(found)), "components")


def _pair(rows: DataFrame, x: str, y: str) -> DataFrame:
    return rows.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def _with_component(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def _stars(met: DataFrame) -> DataFrame:
    """sig, rep, pivot: in every signature the set that meets most others is the pivot of the rest."""
    sizes = met.groupBy("sig").agg(F.count(F.lit(1)).alias("m"))
    degree = met.select("sig", "rep").join(sizes, "sig").groupBy("rep").agg(F.sum("m").alias("degree"))
    best = Window.partitionBy("sig").orderBy(F.desc("degree"), "rep")
    pivots = (met.select("sig", "rep").join(degree, "rep").withColumn("place", F.row_number().over(best)).filter(F.col("place") == 1)
              .select("sig", F.col("rep").alias("pivot")))
    return met.select("sig", "rep").join(pivots, "sig").filter(F.col("rep") != F.col("pivot")).groupBy("rep", "pivot").agg(
        F.count(F.lit(1)).alias("times"))


def _bits_apart() -> Column:
    return sum((F.bit_count(F.col(f"s{i}").bitwiseXOR(F.col(f"t{i}"))) for i in range(SKETCH)), F.lit(0))


def _may_link() -> Column:
    """FALSE where the sketches rule it out that two sets of n and n_b elements link."""
    return _bits_apart() * (DEN + NUM) <= (F.col("n") + F.col("n_b")) * (DEN - NUM)


def _other_side(info: DataFrame) -> DataFrame:
    return info.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), *[F.col(f"s{i}").alias(f"t{i}") for i in range(SKETCH)])


def _first_by(*order: str) -> Column:
    """The pivot that is largest in `order`."""
    return F.max(F.struct(*order, "pivot"))["pivot"].alias("pivot")


def _few_pivots(rows: DataFrame, stars: DataFrame) -> DataFrame:
    """sig, pivot: one pivot for each signature, such that a set meets few of them.

    Any pivot is right, as all sets of a signature take the same. Sets vote: a signature takes the pivot that most of its sets name. At
    first a set names the pivot with which it shares most signatures, then the one of its signatures that most sets have, so
    signatures with many sets in common come to share one.
    """
    names = stars.groupBy("rep").agg(_first_by("times"))
    for vote in range(VOTES):
        named = rows.select("sig", "rep").join(names, "rep", "left").withColumn("pivot", F.coalesce("pivot", "rep"))
        counts = named.groupBy("sig", "pivot").agg(F.count(F.lit(1)).alias("times"))
        chosen = session.staged(counts.groupBy("sig").agg(_first_by("times")), "pivots")
        if vote + 1 < VOTES:
            each = rows.select("sig", "rep").join(chosen, "sig").groupBy("rep", "pivot").agg(F.count(F.lit(1)).alias("times"))
            sets = each.groupBy("pivot").agg(F.count(F.lit(1)).alias("sets"))
            names = session.staged(each.join(sets, "pivot").groupBy("rep").agg(_first_by("sets", "times")), "named-pivots")
    return chosen


def _by_differences(rows: DataFrame, stars: DataFrame, info: DataFrame, sets: DataFrame) -> DataFrame:
    """rep, b: pairs of different components in large signatures that share a difference key and whose sketches allow a link."""
    members = rows.join(_few_pivots(rows, stars), "sig").select("rep", "n", "component", "pivot").distinct()

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        x, c = ([np.array(v.as_py(), np.int64).view(np.uint64) for v in batch.column(i)] for i in (3, 4))
        keys = [difference_keys(*args) for args in zip(x, c, batch.column(2).to_pylist(), strict=True)]
        return {"rep": batch.column(0), "component": batch.column(1), "apart": pa.array([len(difference(*pair)) for pair in zip(x, c, strict=True)], pa.int32()),
                "keys": _lists(keys)}

    own, center = sets.toDF("rep", "grams"), sets.toDF("pivot", "grams_pivot")
    both = members.join(own, "rep").join(center, "pivot").select("rep", "component", "pivot", "grams", "grams_pivot")
    keyed = map_batches(both, run, "rep long, component long, apart int, keys array<long>").select("rep", "component", "apart", F.explode("keys").alias("key"))
    per = Window.partitionBy("key")
    shared = (keyed.withColumn("low", F.min("component").over(per)).withColumn("high", F.max("component").over(per))
              .filter(F.col("low") != F.col("high")).select("key", "rep", "component", "apart").distinct())
    shared = session.staged(shared, "difference-keys").join(info, "rep")
    other = shared.select("key", F.col("rep").alias("b"), F.col("component").alias("of_b"), F.col("apart").alias("apart_b"), F.col("n").alias("n_b"),
                          *[F.col(f"s{i}").alias(f"t{i}") for i in range(SKETCH)])
    fit = (F.least("n", "n_b") * DEN >= F.greatest("n", "n_b") * NUM) & (F.col("component") != F.col("of_b")) & (F.col("rep") < F.col("b"))
    # sets that differ from the pivot by numbers too far apart differ from each other by more than links allow
    size = F.abs(F.col("apart") - F.col("apart_b")) * (DEN + NUM) <= (F.col("n") + F.col("n_b")) * (DEN - NUM)
    return shared.join(other, (shared["key"] == other["key"]) & fit & size & _may_link()).select("rep", "b")


def _verified(pairs: DataFrame, info: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose sets are alike enough; the sketches say which need to be compared."""
    near = (pairs.join(info.withColumnRenamed("rep", "a"), "a").join(_other_side(info), "b").filter(_may_link())
            .select("a", "b").distinct())
    left, right = sets.toDF("a", "grams_a"), sets.toDF("b", "grams_b")
    both = F.size(F.array_intersect("grams_a", "grams_b"))
    alike = both * DEN >= (F.size("grams_a") + F.size("grams_b") - both) * NUM
    return near.join(left, "a").join(right, "b").filter(alike).select("a", "b").distinct()


def keep_one(docs: DataFrame, key: str, text: str) -> DataFrame:
    """`docs` with one row of each component, that of the smallest key; rows with a null key all stay."""
    found = join(docs, key, text).filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("component_id").alias("_component"))
    kept = found.filter(F.col("_component") == F.col("_key"))
    single, repeated = kept.filter(F.col("_rows") == 1), kept.filter(F.col("_rows") > 1)
    on = lambda side: docs[key] == side["_key"]
    return (docs.join(single, on(single), "left_semi")
            .unionByName(docs.join(repeated, on(repeated), "left_semi").dropDuplicates([key]))
            .unionByName(docs.filter(docs[key].isNull())))
