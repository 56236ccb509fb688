"""MinHash near-dedup with circulant signatures.

A document's set holds the distinct ``width``-word shingles of its lower-cased
text (A-Z only), as 64-bit names.  A first permutation (an invertible scrambling
of the names, cut to a circle of 2**32 places) sends the set to places of the
circle; a second permutation of the circle, applied to the places shifted by k,
gives coordinate k of the signature as the least value over the set.  Two
permutations thus make every coordinate.  Six coordinates form a band; 50 bands
miss a pair at similarity 0.8 with probability (1 - 0.8**6)**50 = 3e-7, and meet
a pair at 0.3 with 4 %.  Sets without a common shingle meet as rarely as two
64-bit names collide, however large they are.

Links are confirmed on the full sets.  Equal sets are one *class* from the
start, so copies cost one partial aggregate.  Inside a bucket not all pairs are
formed:

1. every class is compared with one hub, the class with the most bucket mates
   that it meets in any bucket; this joins most of a group of copies;
2. buckets whose classes are all in one component are done.  In the others the
   classes outside of the bucket's largest component are compared with that
   component's hub, its class with the most mates; a component has one hub for
   all its buckets, so a group of copies has one, whatever its size;
3. buckets that are still open form a *star* around that hub.  Of two members in
   different components only pairs that can possibly be linked are compared.
   Relative to the hub, member x has ``common`` elements and some additions;
   additions that more than ``MANY`` members of the star share count as common
   too.  Two members then share at most ``min(common) + shared additions``.  So a
   linked pair either

   * reaches the threshold with ``min(common)`` alone: it is found by joining on
     star and size, as the bound leaves a narrow range of sizes; or
   * shares a rare addition: it is found by joining on star and addition, each
     member with its rarest additions only, as many as a link must hit once
     (prefix filtering); such an addition has at most ``MANY`` members.

Both bounds are exact, so no link between classes of one bucket that could join
two components is skipped.  Additions are stored and exploded for the members of
open buckets only, once per hub.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.components import connected_components
from riverbed.llm.frames import fresh, materialize, ready, row_key
from riverbed.llm.words import U64, Words, mix, row_slices, text_bytes

BANDS, ROWS = 50, 6
#: An addition that more members of a star share counts as part of its hub.
MANY = 64
#: Bytes of keys sent to every executor instead of shuffling whole texts; beyond it the texts are shuffled.
BROADCAST_BYTES = 32 << 20
_U32 = np.uint32
_SHIFT = np.arange(BANDS * ROWS, dtype=_U32)


def shingle_sets(words: Words, width: int):
    """Sorted distinct shingle names of each row; fewer words than ``width``: the
    whole sequence as one; none: empty."""
    spans = words.spans(0)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if a == b:
            yield np.zeros(0, U64)
            continue
        start = np.arange(a, max(b - width, a) + 1)
        end = np.minimum(start + width, b)
        yield np.unique(mix(spans.of(start, end) + (end - start).astype(U64)))


def signature(names: np.ndarray) -> np.ndarray:
    """All coordinates of a non-empty set."""
    place = (mix(names ^ U64(0x5851F42D4C957F2D)) >> U64(32)).astype(_U32)
    out = np.full(BANDS * ROWS, np.iinfo(_U32).max, _U32)
    for i in range(0, len(place), 256):
        # the second permutation of the circle: products with odd numbers and a folded shift are invertible
        x = place[i:i + 256, None] + _SHIFT
        x *= _U32(0x9E3779B1)
        x ^= x >> _U32(15)
        x *= _U32(0x85EBCA77)
        x ^= x >> _U32(13)
        x *= _U32(0xC2B2AE3D)
        np.minimum(out, x.min(axis=0), out=out)
    return out


def band_names(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(BANDS, ROWS).astype(U64)
    name = np.arange(BANDS, dtype=U64)
    for k in range(0, ROWS, 2):
        name = mix(name ^ (rows[:, k] << U64(32) | rows[:, k + 1]))
    return name


def _each(batch: pa.RecordBatch, text: str, width: int):
    """Runs of rows of a batch with their sets."""
    data, offs = text_bytes(batch.column(text))
    for lo, hi in row_slices(offs):
        words = Words(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], lower=True)
        yield batch.slice(lo, hi - lo), shingle_sets(words, width)


def _class_name(names: np.ndarray) -> bytes | None:
    return hashlib.blake2b(names.tobytes(), digest_size=16).digest() if len(names) else None


def _sign(width: int):
    def run(batches):
        for batch in batches:
            for rows, sets in _each(batch, "text", width):
                n, name, bands = [], [], []
                for names in sets:
                    n.append(len(names))
                    name.append(_class_name(names))
                    bands.append(band_names(signature(names)).view(np.int64) if len(names) else None)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in ("doc_id", "k1", "k2")), pa.array(n, pa.int64()),
                     pa.array(name, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "k1", "k2", "n", "name", "bands"])
    return run


def _sets(width: int):
    def run(batches):
        for batch in batches:
            for rows, sets in _each(batch, "text", width):
                yield pa.RecordBatch.from_arrays(
                    [rows.column("node"), rows.column("again"),
                     pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))],
                    names=["node", "again", "items"])
    return run


def _small(keys: DataFrame, width: int) -> DataFrame:
    """A table of keys, ``width`` bytes a row at most, broadcast if its rows are counted to be few."""
    return F.broadcast(keys) if keys.count() * width <= BROADCAST_BYTES else keys


def _met(pairs: DataFrame, sets: DataFrame, *more) -> DataFrame:
    """``pairs`` (a, b and other columns) with the sizes n and m of their sets, the
    number ``both`` of common elements, and columns made of the sets x and y."""
    pairs = materialize(pairs, "pairs")
    one = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    two = two.join(_small(pairs.select("b").distinct(), 16), "b", "left_semi")
    return _small(pairs, 16 * len(pairs.columns)).join(one, "a").join(two, "b").select(
        *pairs.columns, F.size("x").alias("n"), F.size("y").alias("m"),
        F.size(F.array_intersect("x", "y")).alias("both"), *more)


def _linked(met: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union."""
    return met.filter(100 * F.col("both") >= percent * (F.col("n") + F.col("m") - F.col("both"))).select("a", "b")


def _open_buckets(members: DataFrame, label: DataFrame) -> DataFrame:
    """``band, node, root, hub, hub_root`` of the buckets with more than one
    component: the hub is the class with the most mates of the largest component."""
    rows = members.join(label, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = materialize(rows.select("band", "node", "score", "root"), "labelled")
    hubs = rows.groupBy("root").agg(F.max(F.struct("score", "node")).alias("top")).select("root", F.col("top.node").alias("hub"))
    most = rows.groupBy("band", "root").agg(F.count("*").alias("size")).groupBy("band").agg(
        F.count("*").alias("roots"), F.max(F.struct("size", "root")).alias("top"))
    most = most.filter("roots > 1").select("band", F.col("top.root").alias("root")).join(hubs, "root")
    most = most.select("band", "hub", F.col("root").alias("hub_root"))
    return rows.drop("score").join(most, "band")


def _possible(stars: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b of one star, in different components, that can be linked."""
    rows = materialize(stars, "stars")
    # two members in different components: at least one is not in the hub's, so only what such a member holds counts
    items = rows.select("hub", "node", (F.col("root") != F.col("hub_root")).alias("apart"), F.explode("added").alias("item"))
    often = items.groupBy("hub", "item").agg(F.count("*").alias("f"), F.max("apart").alias("apart")).filter(
        "f > 1 and apart").drop("apart")
    known = items.join(often, ["hub", "item"]).groupBy("hub", "node").agg(
        F.sum((F.col("f") > MANY).cast("int")).alias("hot"),
        F.sort_array(F.collect_list(F.when(F.col("f") <= MANY, F.struct("f", "item")))).alias("rare"))
    rows = rows.drop("added").join(known, ["hub", "node"], "left")
    rows = rows.withColumn("common", F.col("common") + F.coalesce("hot", F.lit(0)))
    must = F.greatest(F.lit(1), F.ceil((percent * F.col("n") - 100 * F.col("common")) / 100))
    rows = materialize(rows.select("hub", "node", "n", "common", "root", "hub_root", F.slice(
        "rare", F.lit(1), F.greatest(F.lit(0), F.size("rare") - must + 1).cast("int")).alias("rare")), "bounded")

    def side(of: DataFrame, tag: str, keys: list[str]) -> DataFrame:
        return of.select(*keys, *[F.col(c).alias(c + tag) for c in ("node", "n", "common", "root")])

    listed = rows.filter("size(rare) > 0").withColumn("item", F.explode("rare.item"))
    keys = ["hub", "item"]
    shared = (side(listed, "1", keys).join(side(listed, "2", keys).withColumnRenamed("n2", "m"), keys)
              .filter("root1 < root2").filter(_alike("n1", "m", percent)))
    low = F.ceil(percent * F.col("n") / 100)
    high = F.floor((100 + percent) * F.col("common") / percent) - F.col("n")
    apart = rows.filter("root <> hub_root").withColumn(
        "m", F.explode(F.when(low <= high, F.sequence(low.cast("long"), high.cast("long")))))
    keys = ["hub", "m"]
    alone = (side(apart, "1", keys).join(side(rows.withColumn("m", F.col("n")), "2", keys), keys)
             .filter("root1 <> root2")
             .filter((100 + percent) * F.least("common1", "common2") >= percent * (F.col("n1") + F.col("m"))))
    pair = [F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b")]
    return shared.select(*pair).unionByName(alone.select(*pair)).distinct()


def _alike(n: str, m: str, percent: int):
    """Sizes that a link allows: the smaller set holds the intersection, the larger lies in the union."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``.

    component_id is the least id reachable over links; kept is true where the
    row's id is that id.  Null, empty and blank texts have no shingles and are
    linked with nothing: their component is their own id and they are kept.
    Rows with a null id take part; a component of null ids only has a null
    component and its rows are kept.  Repeated rows are separate documents of
    one class and share the flag.  Columns other than the two named are
    ignored.  An empty table gives an empty result."""
    return _components(docs, width, percent, id_col, text_col).drop("k1", "k2", "root")


def _components(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    docs = ready(docs)
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), k1.alias("k1"), k2.alias("k2"))
    rows = materialize(base.mapInArrow(
        _sign(width), "doc_id long, k1 long, k2 long, n long, name binary, bands array<long>"), "signatures")
    some = rows.filter("n > 0")
    # written once, so the short numbers that stand for classes from here on are fixed
    classes = materialize(some.groupBy("name").agg(
        F.first("n").alias("n"), F.first("bands").alias("bands"), F.min(F.struct("k1", "k2")).alias("one"),
        F.min("doc_id").alias("least")).withColumn("node", F.monotonically_increasing_id()), "classes")
    bucketed = classes.select("node", F.explode("bands").alias("band"))
    shared = bucketed.groupBy("band").agg(F.count("*").alias("mates")).filter("mates > 1")
    members = bucketed.join(shared, "band")
    score = members.groupBy("node").agg(F.sum("mates").alias("score"))
    members = materialize(members.select("band", "node").join(score, "node"), "buckets")

    again = some.groupBy("k1", "k2").agg(F.count("*").alias("times"))
    wanted = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "one.*")
    wanted = materialize(wanted.join(again, ["k1", "k2"]).select("node", "k1", "k2", (F.col("times") > 1).alias("again")),
                         "wanted")
    sets = materialize(base.select("k1", "k2", "text").join(_small(wanted, 32), ["k1", "k2"]).select("node", "again", "text")
                       .mapInArrow(_sets(width), "node long, again boolean, items array<long>"), "sets")
    sets = sets.filter("not again").unionByName(sets.filter("again").dropDuplicates(["node"])).drop("again")

    best = members.groupBy("band").agg(F.max(F.struct("score", "node")).alias("top"))
    best = members.join(best, "band").groupBy("node").agg(F.max("top").alias("top")).select(
        F.col("node").alias("a"), F.col("top.node").alias("b")).filter("a <> b")
    links = materialize(_linked(_met(best, sets), percent), "links")
    outside = _open_buckets(members, connected_components(links)).filter("root <> hub_root")
    outside = outside.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    links = materialize(links.unionByName(_linked(_met(outside, sets), percent)), "links")
    # the hub too, if it lies in the bucket: it may be another than the one compared before
    open_ = _open_buckets(members, connected_components(links))
    open_ = open_.select(F.col("node").alias("a"), F.col("hub").alias("b"), "root", "hub_root").distinct()
    stars = _met(open_, sets, F.array_except("x", "y").alias("added")).select(
        F.col("b").alias("hub"), F.col("a").alias("node"), "n", F.col("both").alias("common"), "added", "root", "hub_root")
    pairs = _possible(stars, percent)
    label = connected_components(links.unionByName(_linked(_met(pairs, sets), percent)))

    placed = classes.select("name", "node", "least").join(label, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    group = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = placed.join(group, "root").select("name", "component_id", "root")
    linked = some.select("doc_id", "n", "name", "k1", "k2").join(of_class, "name").select(
        "doc_id", "n", "component_id", "k1", "k2", "root")
    alone = rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), "k1", "k2",
                                        F.lit(None).cast("long").alias("root"))
    return linked.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "k1", "k2", "root")


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without near copies: of each group one
    row stays, that with the least id, null ids last; of several rows with that id
    the one with the least row key, and one row of it, if the row is repeated.
    Rows without words all stay, but repeated ones."""
    key = fresh(docs, "_k1", "_k2")
    # the least id of a group is what kept marks; a row without a root is a group of its own
    kept = _components(docs, width, percent, id_col, text_col).filter("kept")
    own = [F.when(F.col("root").isNull(), F.col(c)) for c in ("k1", "k2")]
    kept = kept.groupBy("root", *own).agg(F.min(F.struct("k1", "k2")).alias("one")).select(
        F.col("one.k1").alias(key[0]), F.col("one.k2").alias(key[1]))
    texts = ready(docs).withColumns(dict(zip(key, row_key(F.col(id_col), F.col(text_col)), strict=True)))
    return texts.join(kept, key, "left_semi").dropDuplicates(key).select(*docs.columns)
