"""Ranked lexical search with common subexpressions of many queries.

Every item is a query; its score of a document is a sum over its terms.  Items
share terms, so their sums share parts.  The parts are mined per block of items:

* terms that occur in exactly the same items, equally often, are one set;
* an item's sets lie in order of falling number of items; sets that are
  neighbours there in more than one item become a larger set, the most shared
  first, round by round until no two neighbours are shared.

This gives a graph: a set is the sum of two smaller ones, an item the sum of the
sets left to it.  A task holds accumulators of a run of documents, one row per
set; each shared set is added up once, level by level, and every item that
needs it reads it there.

A first pass over the texts writes, per document, its length and its counts of
the block's terms.  Document frequencies are a partial aggregate over that
table, the second pass scores it.  A task keeps each item's best rows only;
these meet in two steps, so no task sees the best rows of all others.  Scores
are 64-bit integers throughout, so the order of additions does not matter.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverbed.llm.frames import materialize, ready
from riverbed.llm.terms import Vocabulary, each
from riverbed.llm.words import U64

#: Distinct terms of all items of a block, accumulator cells that a task holds, groups of the first step of the ranking.
BLOCK, CELLS, SPREAD = 1 << 16, 1 << 22, 64


def _names(batches):
    """Items with the names of their terms, in order."""
    for batch in batches:
        for rows, terms in each(batch, "text"):
            names = np.stack(terms.names, 1)
            found = [names[a:b].tobytes() for a, b in zip(terms.first[:-1], terms.first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column("item_id"), pa.array(found, pa.binary())], names=["item_id", "names"])


def _counts(vocabulary: Vocabulary):
    def run(batches):
        size = len(vocabulary)
        for batch in batches:
            for rows, terms in each(batch, "text"):
                n = np.diff(terms.first)
                number = vocabulary.numbers(terms.names)
                row = np.repeat(np.arange(len(n)), n)
                cell, tf = np.unique(row[number >= 0] * size + number[number >= 0], return_counts=True)
                first = np.searchsorted(cell, np.arange(len(n) + 1) * size).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(first), pa.array(x.astype(np.int32))) for x in (cell % max(size, 1), tf)]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n, pa.int64()), *lists],
                                                 names=["doc_id", "n", "terms", "tf"])
    return run


class SharedSums:
    """A graph of sums: ``leaves`` are (term, times), ``levels`` of shared sets as
    (numbers, left, right), and the sets that each item adds up."""

    def __init__(self, items: list[list[int]]):
        bags = [Counter(terms) for terms in items]
        holders = defaultdict(list)
        for i, bag in enumerate(bags):
            for pair in bag.items():
                holders[pair].append(i)
        self.leaves = sorted(holders)
        number = {leaf: j for j, leaf in enumerate(self.leaves)}
        self.pairs, depth = [], [0] * len(self.leaves)

        def add(a: int, b: int) -> int:
            self.pairs.append((a, b))
            depth.append(1 + max(depth[a], depth[b]))
            return len(depth) - 1

        by_items = defaultdict(list)
        for leaf in self.leaves:
            by_items[tuple(holders[leaf])].append(number[leaf])
        parts, shared = [[] for _ in items], {}
        for group, members in sorted(by_items.items()):
            if len(group) == 1:
                parts[group[0]] += members
                continue
            while len(members) > 1:
                members = [add(*members[j:j + 2]) if j + 1 < len(members) else members[j] for j in range(0, len(members), 2)]
            shared[members[0]] = len(group)
            for i in group:
                parts[i].append(members[0])
        order = lambda s: (-shared[s], s)
        lists = [sorted((s for s in p if s in shared), key=order) for p in parts]
        while True:
            seen = Counter(pair for s in lists for pair in zip(s, s[1:], strict=False))
            often = {pair: c for pair, c in seen.items() if c > 1}
            if not often:
                break
            made, after, used = {}, [], Counter()
            rank = {pair: (-c, pair) for pair, c in often.items()}
            chosen = [self._chosen(s, rank) for s in lists]
            for picks in chosen:
                used.update(picks)
            made = {pair: add(*pair) for pair in sorted(used) if used[pair] > 1}
            if not made:
                break
            shared.update({made[pair]: used[pair] for pair in made})
            for s, picks in zip(lists, chosen, strict=True):
                gone, new = set(), []
                for pair in picks:
                    if pair in made:
                        gone |= set(pair)
                        new.append(made[pair])
                after.append(sorted([x for x in s if x not in gone] + new, key=order))
            lists = after
        self.tops = [s + [x for x in p if x not in shared] for s, p in zip(lists, parts, strict=True)]
        self.size = len(depth)
        by_depth = defaultdict(list)
        for j, (a, b) in enumerate(self.pairs, len(self.leaves)):
            by_depth[depth[j]].append((j, a, b))
        self.levels = [np.array(by_depth[x], np.int64).T for x in sorted(by_depth)]

    @staticmethod
    def _chosen(s: list[int], rank: dict) -> list[tuple[int, int]]:
        """Neighbours to be put together, the most shared first, each set in one pair."""
        out, taken = [], set()
        for pair in sorted((p for p in zip(s, s[1:], strict=False) if p in rank), key=rank.get):
            if not taken & set(pair):
                out.append(pair)
                taken |= set(pair)
        return out

    def additions(self) -> int:
        """Additions per document, an item's first term not counted."""
        return len(self.pairs) + sum(max(len(t) - 1, 0) for t in self.tops)

    def scores(self, leaf_values: np.ndarray) -> np.ndarray:
        """Sums of the items (rows) for leaf values of some documents (columns)."""
        acc = np.empty((self.size, leaf_values.shape[1]), np.int64)
        acc[:len(self.leaves)] = leaf_values
        for made, a, b in self.levels:
            acc[made] = acc[a] + acc[b]
        out = np.zeros((len(self.tops), leaf_values.shape[1]), np.int64)
        for i, top in enumerate(self.tops):
            if top:
                acc[top].sum(axis=0, out=out[i])
        return out


class _Best:
    """The k best rows of each item so far: score down, id up (null last)."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.zeros(items, np.int64)
        none = np.zeros(0, np.int64)
        self.item, self.score, self.doc, self.null = none, none, none, none

    def add(self, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        item, at = np.nonzero((scores > 0) & (scores >= self.least[:, None]))
        if not len(item):
            return
        item, score = np.concatenate((self.item, item)), np.concatenate((self.score, scores[item, at]))
        doc, null = np.concatenate((self.doc, doc[at])), np.concatenate((self.null, null[at]))
        order = np.lexsort((doc, null, -score, item))
        first = np.searchsorted(item[order], np.arange(len(self.least)))
        place = np.arange(len(order)) - first[item[order]]
        order = order[place < self.k]
        last = place[place < self.k] == self.k - 1
        self.item, self.score, self.doc, self.null = item[order], score[order], doc[order], null[order]
        self.least[self.item[last]] = self.score[last]


def _scored(sums: SharedSums, weight: np.ndarray, documents: int, length: int, k: int):
    term = np.array([t for t, _ in sums.leaves], np.int64)
    factor = np.array([c for _, c in sums.leaves], np.int64) * weight[term] if len(term) else term

    def run(batches):
        best, rows = _Best(len(sums.tops), k), max(16, CELLS // max(sums.size, 1))
        place = np.empty(len(weight), np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                part = batch.slice(lo, rows)
                n = part.column("n").to_numpy()
                m = 100 - 25 + (25 * n * documents) // length
                terms, tf = (part.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "tf"))
                row = np.repeat(np.arange(len(n)), np.diff(part.column("terms").offsets.to_numpy()))
                used, at = np.unique(terms, return_inverse=True)
                gain = np.zeros((len(used) + 1, len(n)), np.int64)
                gain[at, row] = (1_000_000_000 * tf) // (1000 * tf + 12 * m[row])
                place[:] = len(used)
                place[used] = np.arange(len(used))
                scores = sums.scores(gain[place[term]] * factor[:, None])
                doc = part.column("doc_id")
                best.add(scores, doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False).astype(np.int64))
        if len(best.item):
            yield pa.RecordBatch.from_arrays(
                [pa.array(best.item), pa.array(best.doc, mask=best.null.astype(bool)), pa.array(best.score)],
                names=["item", "doc_id", "score"])
    return run


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
                   item_id: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k documents with the highest score above
    0 for each item (all, if fewer), equal scores by rising id, null ids last.

    Null and empty texts have no terms, count for nothing and are never found; an
    item without terms finds nothing.  Repeated documents are ranked one by one;
    items equal in id and text are one item, items equal in id alone are ranked
    apart.  Other columns are ignored; without documents or items the result is
    empty.  Ids of documents are integers."""
    asked = ready(items).select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).distinct()
    kind = dict(asked.dtypes)["item_id"]
    asked = materialize(asked.mapInArrow(_names, f"item_id {kind}, names binary").filter("length(names) > 0"), "items")
    # blocks of items by hash, of about so many terms; the terms of one item stay together
    blocks = max(1, -(-(asked.agg(F.sum(F.length("names"))).first()[0] or 0) // (16 * block)))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = None
    for number in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("names"), F.lit(blocks)) == number).collect()
        part = _ranked(texts, rows, kind, k)
        found = part if found is None else found.unionByName(part)
    return found


def _ranked(texts: DataFrame, rows: list, kind: str, k: int) -> DataFrame:
    spark = texts.sparkSession
    names = [np.frombuffer(r["names"], U64).reshape(-1, 2) for r in rows]
    vocabulary = Vocabulary(np.concatenate(names) if names else np.zeros((0, 2), U64))
    counts = texts.mapInArrow(_counts(vocabulary), "doc_id long, n long, terms array<int>, tf array<int>")
    counts = materialize(counts.filter("n > 0"), "counts")
    documents, length = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for term, c in counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*")).collect():
        df[term] = c
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(c) + 1))) for c in df], np.int64)
    split = [vocabulary.numbers([np.ascontiguousarray(n[:, 0]), np.ascontiguousarray(n[:, 1])]).tolist() for n in names]
    best = counts.filter(F.size("terms") > 0).mapInArrow(
        _scored(SharedSums(split), weight, documents, max(length, 1), k), "item long, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    best = best.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(SPREAD)))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).filter(F.col("rank") <= k)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    # one small row per item of this block, whose size is bounded
    ids = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item long, item_id {kind}")
    return best.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
