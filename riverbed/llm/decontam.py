"""Benchmark decontamination by an FM-index per training shard.

Test phrases are the windows of ``window`` consecutive terms of the items; an
item of fewer terms, but not none, is one phrase.  A shard is a run of
documents of one task.  Terms that no phrase holds end a run of the shard's
sequence, as the ends of documents do; a run shorter than the shortest phrase
can't hold one and is left out, all others are indexed whole (``fm_index``).
All distinct phrases are searched backward at once, their occurrences located
from sampled suffix positions, and the term places that they cover merged into
removal spans.

The phrase set is dealt into blocks of about ``BLOCK`` terms by hash, each sent
with the tasks and searched in all shards, so what a task holds is bounded by one
block and one shard however large set and corpus are.  Copies of documents are
searched where they lie; nothing is grouped or shuffled by key, so there is no
hot key.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.fm_index import FMIndex
from riverbed.llm.frames import fresh, materialize, ready, row_key
from riverbed.llm.terms import Terms, Vocabulary, each
from riverbed.llm.words import U64

WINDOW = 10
#: Terms of a block of phrases, symbols of a shard's index, phrases of a piece of a long item.
BLOCK, SHARD, PIECE = 1 << 18, 1 << 20, 1 << 12
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _pieces(window: int):
    """Items as runs of terms that hold at most PIECE windows each and lose none."""
    def run(batches):
        for batch in batches:
            for rows, terms in each(batch, "text"):
                ids = rows.column("item").to_pylist()
                item, names = [], []
                for i, (a, b) in enumerate(zip(terms.first[:-1].tolist(), terms.first[1:].tolist(), strict=True)):
                    for lo in range(a, max(b - window + 1, a + 1) if b > a else a, PIECE):
                        item.append(ids[i])
                        names.append(np.stack([n[lo:min(lo + PIECE + window - 1, b)] for n in terms.names], 1).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(names, pa.binary())], names=["item", "names"])
    return run


class Phrases:
    """A block of distinct phrases as numbers of a vocabulary, and the items that hold each."""

    def __init__(self, rows: list, window: int):
        names = [np.frombuffer(r["names"], U64).reshape(-1, 2) for r in rows]
        self.vocabulary = Vocabulary(np.concatenate(names) if names else np.zeros((0, 2), U64))
        self.items = sorted({r["item"] for r in rows if r["item"] is not None})
        number = {v: i for i, v in enumerate(self.items)}
        found, owner = [], []
        for r, n in zip(rows, names, strict=True):
            at = self.vocabulary.numbers([np.ascontiguousarray(n[:, 0]), np.ascontiguousarray(n[:, 1])]) + 1
            if len(at) < window:
                at = np.concatenate((np.full(window - len(at), -1), at))
            view = np.lib.stride_tricks.sliding_window_view(at, window)
            found.append(view)
            owner.append(np.full(len(view), number.get(r["item"], -1)))
        every = np.concatenate(found) if found else np.zeros((0, window), np.int64)
        self.terms, of = np.unique(every, axis=0, return_inverse=True)
        self.length = (self.terms > 0).sum(axis=1)
        self.least = int(self.length.min(initial=window))
        pairs = np.unique(np.stack((of.ravel(), np.concatenate(owner) if owner else np.zeros(0, np.int64)), 1), axis=0)
        pairs = pairs[pairs[:, 1] >= 0]
        self.first = np.searchsorted(pairs[:, 0], np.arange(len(self.terms) + 1))
        self.holder = pairs[:, 1]

    def holders(self, phrase: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``phrase`` and the items that hold the phrase there."""
        count = self.first[phrase + 1] - self.first[phrase]
        at = np.repeat(np.arange(len(phrase)), count)
        return at, self.holder[np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + self.first[phrase[at]]]


def _runs(symbols: np.ndarray, row: np.ndarray, least: int) -> np.ndarray:
    """Places of the symbols that lie in runs of at least ``least`` known terms of one row."""
    n = len(symbols)
    known = symbols > 0
    new = np.ones(n, bool)
    new[1:] = ~known[1:] | ~known[:-1] | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, n))
    return np.flatnonzero(known & np.repeat(size >= least, size))


class _Shard:
    """Rows of documents and the indexed part of their terms."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.rows, self.counts, self.size = phrases, [], [], 0
        self.text, self.place, self.total = [], [], 0

    def add(self, rows: pa.RecordBatch, terms: Terms) -> None:
        symbols = self.phrases.vocabulary.numbers(terms.names) + 1
        count = np.diff(terms.first)
        at = _runs(symbols, np.repeat(np.arange(len(count)), count), self.phrases.least)
        if len(at):
            row = np.searchsorted(terms.first, at, side="right")
            end = np.append((at[1:] != at[:-1] + 1) | (row[1:] != row[:-1]), True)
            to = np.arange(len(at)) + np.concatenate(([0], np.cumsum(end)[:-1]))
            text = np.zeros(to[-1] + 2, np.int64)
            place = np.zeros(len(text), np.int64)
            text[to], place[to] = symbols[at], at + self.total
            self.text.append(text)
            self.place.append(place)
            self.size += len(text)
        self.rows.append(rows)
        self.counts.append(count)
        self.total += len(symbols)

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        """Phrases and the terms of the shard where they begin."""
        if not self.text or not len(self.phrases.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        text, place = np.concatenate(self.text), np.concatenate(self.place)
        index = FMIndex(text, len(self.phrases.vocabulary) + 1)
        phrase, at = index.locate(*index.search(self.phrases.terms))
        return phrase, place[at]

    def result(self):
        """``n_words, hits, spans, items`` of each row."""
        phrases, (phrase, at) = self.phrases, self.found()
        count = np.concatenate(self.counts)
        first = np.concatenate(([0], np.cumsum(count)))
        cover = np.zeros(self.total + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + phrases.length[phrase], -1)
        hit = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
        row = np.searchsorted(first, hit, side="right") - 1
        n_hit = np.bincount(row, minlength=len(count))
        new = np.ones(len(hit), bool)
        new[1:] = (hit[1:] != hit[:-1] + 1) | (row[1:] != row[:-1])
        begin = np.flatnonzero(new)
        stop = np.append(begin, len(hit))[1:] - 1
        spans = np.stack((hit[begin], hit[stop] + 1), 1) - first[row[begin]][:, None]
        span_first = np.searchsorted(row[begin], np.arange(len(count) + 1))
        doc = np.searchsorted(first, at, side="right") - 1
        seen = np.unique(np.stack((doc, phrase), 1), axis=0)
        of, item = phrases.holders(seen[:, 1])
        pairs = np.unique(np.stack((seen[of, 0], item), 1), axis=0)
        item_first = np.searchsorted(pairs[:, 0], np.arange(len(count) + 1))
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(spans) + 1, dtype=np.int32) * 2), pa.array(spans.ravel()))
        names = pa.array([phrases.items[i] for i in pairs[:, 1].tolist()], pa.string())
        lists = [pa.array(count, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(span_first.astype(np.int32)), flat),
                 pa.ListArray.from_arrays(pa.array(item_first.astype(np.int32)), names)]
        lo = 0
        for rows in self.rows:
            yield pa.RecordBatch.from_arrays([*rows.columns, *(x.slice(lo, rows.num_rows) for x in lists)],
                                             names=[*rows.schema.names, "n_words", "n_hit", "spans", "items"])
            lo += rows.num_rows


def _mark(phrases: Phrases, only_hits: bool):
    def run(batches):
        for batch in batches:
            shard = _Shard(phrases)
            keys = [i for i, c in enumerate(batch.schema.names) if c != "text"]
            for rows, terms in each(batch, "text"):
                shard.add(rows.select(keys), terms)
                if shard.size >= SHARD:
                    yield from _wanted(shard, only_hits)
                    shard = _Shard(phrases)
            if shard.rows:
                yield from _wanted(shard, only_hits)
    return run


def _wanted(shard: _Shard, only_hits: bool):
    for out in shard.result():
        yield out.filter(pa.compute.greater(out.column("n_hit"), 0)) if only_hits else out


_MARKS = "n_words long, n_hit long, spans array<array<long>>, items array<string>"


def _merged(batches):
    """Spans and items that several blocks of phrases found in one document."""
    for batch in batches:
        n_hit, spans, items = [], [], []
        for s, i in zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True):
            out = []
            for a, b in sorted(s):
                if out and a <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], b)
                else:
                    out.append([a, b])
            n_hit.append(sum(b - a for a, b in out))
            spans.append(out)
            items.append(sorted(set(i)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("k1"), batch.column("k2"), pa.array(n_hit, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))),
             pa.array(items, pa.list_(pa.string()))], names=["k1", "k2", "n_hit", "spans", "items"])


def mark(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """Per document ``doc_id, n_words, n_hit, spans, items, k1, k2``: its terms, those
    inside any occurrence of a phrase, the merged spans of these (first term, end),
    the ids of the items whose phrases occur (strings, sorted), and its row key.

    Null and empty texts have no terms.  Items of one id are one item; an item
    without id marks terms but isn't listed.  Repeated rows count one by one, rows
    with a null id like any others.  No items: nothing is marked.  Other columns are
    ignored; no documents: an empty table."""
    pieces = materialize(ready(items).select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
                         .mapInArrow(_pieces(window), "item string, names binary"), "phrases")
    total = pieces.agg(F.sum(F.length("names"))).first()[0] or 0
    blocks = max(1, -(-total // (16 * block)))
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), k1.alias("k1"), k2.alias("k2"))
    schema = f"doc_id {dict(base.dtypes)['doc_id']}, k1 long, k2 long, " + _MARKS

    def searched(number: int, only_hits: bool) -> DataFrame:
        part = pieces.filter(F.pmod(F.xxhash64("item", "names"), F.lit(blocks)) == number)
        return base.mapInArrow(_mark(Phrases(part.collect(), window), only_hits), schema)

    out = searched(0, False)
    if blocks == 1:
        return out.select("doc_id", "n_words", "n_hit", "spans", "items", "k1", "k2")
    out = materialize(out, "marked")
    hits = out.filter("n_hit > 0").select("k1", "k2", "spans", "items")
    for number in range(1, blocks):
        hits = hits.unionByName(materialize(searched(number, True).select("k1", "k2", "spans", "items"), "marked"))
    # rows equal in id and text have the same hits: each block gives a key one list
    hits = hits.distinct().groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                                   F.flatten(F.collect_list("items")).alias("items"))
    hits = hits.mapInArrow(_merged, "k1 long, k2 long, n_hit long, spans array<array<long>>, items array<string>")
    both = out.select("doc_id", "n_words", "k1", "k2").join(hits, ["k1", "k2"], "left")
    none = F.array()
    return both.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                       F.coalesce("spans", none.cast("array<array<bigint>>")).alias("spans"),
                       F.coalesce("items", none.cast("array<string>")).alias("items"), "k1", "k2")


def digest(marked: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of what ``mark`` returns."""
    return marked.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
                         (F.col("n_hit") > 0).alias("contaminated"))


def _cut(text: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for t, marked in zip(text, spans, strict=True):
        if marked is None:
            out.append(t)
            continue
        terms = [m.span() for m in _TERM.finditer(t)]
        kept, at = [], 0
        for a, b in marked:
            kept.append(t[at:terms[a][0]])
            at = terms[b - 1][1]
        out.append("".join([*kept, t[at:]]))
    return pd.Series(out, dtype=object)


def remove(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
           **options) -> DataFrame:
    """``docs``, all rows and columns, with the marked spans cut out of the text
    (from the first character of their first term to the last of their last)."""
    k1, k2, spans = fresh(docs, "_k1", "_k2", "_spans")
    hits = mark(docs, items, window, id_col, text_col, **options).filter("n_hit > 0")
    hits = hits.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("spans").alias(spans)).dropDuplicates([k1, k2])
    keys = dict(zip((k1, k2), row_key(F.col(id_col), F.col(text_col)), strict=True))
    both = docs.withColumns(keys).join(hits, [k1, k2], "left")
    return both.withColumn(text_col, F.pandas_udf(_cut, "string")(F.col(text_col), F.col(spans))).select(*docs.columns)
