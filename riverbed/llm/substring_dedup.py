"""Substring dedup by recompression.

Every text is parsed into symbols in rounds that look at content only: two
rounds name adjacent pairs (a symbol whose name falls in the left half of the
alphabet joins a following one of the right half), a last round joins runs of
equal symbols.  Names are hashes of content, so the naming is global without
coordination: equal substrings get equal interior symbols in every document,
and after these rounds a symbol boundary depends on at most ``REACH`` words on
either side.  Every window of ``window`` words therefore meets the same
boundaries inside its margin wherever it occurs.

Each window is charged to one boundary of its interior (its *anchor*, the one
with the smallest name of the ``2 * REACH`` words about it; inside a long run,
which has no boundary, the window's own first interior word).  Consecutive
windows with the same anchor form one *stretch*.  Then, in Spark:

1. anchors whose name occurs once are dropped (a partial aggregate by name);
   an unshared anchor proves that none of its windows repeats;
2. a stretch whose words equal another stretch's proves all its windows repeat;
3. where an anchor has several different stretches, one copy of each is taken
   apart into windows, whose 128-bit names are counted; the repeated ones are
   marked.

Marked windows come back to their document by row key and its covered words go.
Nothing is collected, no pairs are formed, hot names meet only partial
aggregates and joins that adaptive execution can split.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.frames import materialize, ready, row_key
from riverbed.llm.words import U64, Words, mix, row_slices, text_bytes

#: Words on either side that can decide whether a symbol boundary stands.
REACH = 7
_TOP = U64(2**64 - 1)


def boundaries(names: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Word indices where symbols start after two pair rounds and one run round."""
    at, x = np.arange(len(names)), names
    for turn in (1, 2):
        if len(x) < 2:
            return at
        right = (mix(x + U64(turn)) >> U64(63)).astype(bool)
        join = ~right[:-1] & right[1:] & (row[at[:-1]] == row[at[1:]])
        x = x.copy()
        first = np.flatnonzero(join)
        x[first] = mix(x[first] * U64(0x9E3779B97F4A7C15) + x[first + 1])
        keep = np.concatenate(([True], ~join))
        at, x = at[keep], x[keep]
    if len(x) < 2:
        return at
    run = (x[1:] == x[:-1]) & (row[at[1:]] == row[at[:-1]])
    return at[np.concatenate(([True], ~run))]


def _least(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimum of each window of ``width`` values and its leftmost place."""
    v, p, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left = v[:-step] <= v[step:]
        p = np.where(left, p[:-step], p[step:])
        v = np.where(left, v[:-step], v[step:])
        have += step
    return v, p


class Stretches:
    """Runs of windows with a common anchor: first window, count, names."""

    def __init__(self, words: Words, window: int):
        n = len(words.start)
        empty = np.zeros(0, np.int64)
        self.first, self.count, self.row = empty, empty, empty
        self.anchor = self.name = np.zeros(0, U64)
        sizes = np.diff(words.first)
        if n < window or sizes.max(initial=0) < window:
            return
        spans = words.spans(0)
        at = boundaries(words.names[0], words.row)
        at = at[(at >= REACH) & (at + REACH <= n)]
        value = np.full(n, _TOP, U64)
        value[at] = np.minimum(mix(spans.of(at - REACH, at + REACH)), _TOP - U64(1))
        place = _least(value[REACH:n - REACH + 1], window - 2 * REACH + 1)[1] + REACH
        starts = np.arange(n - window + 1)
        starts = starts[words.row[:n - window + 1] == words.row[window - 1:]]
        place, row = place[starts], words.row[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(starts)) - 1
        self.first, self.count, self.row = starts[head], tail - head + 1, row[head]
        anchor = place[head]
        self.anchor = mix(spans.of(anchor - REACH, anchor + REACH) + U64(3))
        self.name = mix(spans.of(self.first, starts[tail] + window) + self.count.astype(U64))


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == U64 else x.astype(np.int64))


def _sliced(batch: pa.RecordBatch, text: str):
    data, offs = text_bytes(batch.column(text))
    for lo, hi in row_slices(offs):
        yield lo, hi, Words(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])


def _stretch_rows(window: int):
    def run(batches):
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
            for lo, _, words in _sliced(batch, "text"):
                s = Stretches(words, window)
                rows = s.row + lo
                yield pa.RecordBatch.from_arrays(
                    [_longs(s.anchor), _longs(s.name), _longs(k1[rows]), _longs(k2[rows]),
                     _longs((s.first - words.first[s.row]) * 64 + s.count)],
                    names=["anchor", "name", "k1", "k2", "place"])
    return run


def _window_rows(window: int):
    """128-bit names of the windows listed in ``places`` (first * 64 + count)."""
    def run(batches):
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
            places = batch.column("places")
            for lo, hi, words in _sliced(batch, "text"):
                at, row = [], []
                for r in range(lo, hi):
                    p = np.asarray(places[r].values, np.int64)
                    first, count = p >> 6, p & 63
                    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    at.append(np.repeat(first, count) + within + words.first[r - lo])
                    row.append(np.full(len(within), r))
                at = np.concatenate(at) if at else np.zeros(0, np.int64)
                row = np.concatenate(row) if row else np.zeros(0, np.int64)
                w = [words.spans(k).of(at, at + window) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [_longs(mix(w[0])), _longs(mix(w[1])), _longs(k1[row]), _longs(k2[row]),
                     _longs(at - words.first[row - lo])], names=["w1", "w2", "k1", "k2", "first"])
    return run


def kept_mask(n_words: int, places: np.ndarray, window: int) -> np.ndarray:
    """Words not covered by any marked window (places: first * 64 + count)."""
    if len(places) == 0:
        return np.ones(n_words, bool)
    first, count = places >> 6, places & 63
    step = np.zeros(n_words + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, first + count + window - 1, -1)
    return np.cumsum(step)[:n_words] == 0


def _apply(window: int):
    def run(batches):
        for batch in batches:
            places = batch.column("places")
            n_words, n_gone, sha, kept_text = [], [], [], []
            for lo, hi, words in _sliced(batch, "text"):
                raw = words.data.tobytes()
                for r in range(lo, hi):
                    a, b = words.first[r - lo], words.first[r - lo + 1]
                    p = np.asarray(places[r].values, np.int64) if places[r].is_valid else np.zeros(0, np.int64)
                    keep = kept_mask(b - a, p, window)
                    out = b" ".join([raw[s:e] for s, e in zip(words.start[a:b][keep].tolist(),
                                                              words.end[a:b][keep].tolist(), strict=True)])
                    n_words.append(b - a)
                    n_gone.append(int((~keep).sum()))
                    sha.append(hashlib.sha256(out).hexdigest())
                    kept_text.append(out.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()),
                 pa.array(sha, pa.string()), pa.array(kept_text, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])
    return run


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_words, n_removed, kept_sha256, kept_text`` after
    every word covered by a repeated window of ``window`` words is gone.

    A window repeats if its word sequence also starts anywhere else in the
    table, the same document included; overlapping places count.  Windows are
    judged on the input.  Null text and texts without words: no words, the
    hash of the empty string.  Repeated rows are two documents with equal
    texts.  A null id is a document like any other.  Columns other than the
    two named are ignored.  An empty table gives an empty result."""
    if not 2 * REACH + 1 <= window <= 64 + 2 * REACH - 2:
        raise ValueError("window must be 15 to 76 words")
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    keyed = ready(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                               k1.alias("k1"), k2.alias("k2"))
    found = keyed.select("k1", "k2", "text").mapInArrow(
        _stretch_rows(window), "anchor long, name long, k1 long, k2 long, place long")
    shared = found.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    shared = materialize(found.join(shared, "anchor"), "stretches")
    kinds = shared.groupBy("anchor", "name").agg(
        F.count("*").alias("n"), F.min(F.struct("k1", "k2", "place")).alias("one"))
    full = kinds.filter("n > 1").select("anchor", "name")
    whole = shared.join(full, ["anchor", "name"], "left_semi").select("k1", "k2", "place")
    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("anchor")
    apart = (kinds.join(mixed, "anchor", "left_semi").select("one.*")
             .groupBy("k1", "k2").agg(F.collect_list("place").alias("places")))
    windows = keyed.join(apart, ["k1", "k2"]).select("k1", "k2", "doc_id", "text", "places").mapInArrow(
        _window_rows(window), "w1 long, w2 long, k1 long, k2 long, first long")
    twice = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1").select("w1", "w2")
    single = windows.join(twice, ["w1", "w2"], "left_semi").select(
        "k1", "k2", (F.col("first") * 64 + 1).alias("place"))
    # equal rows share a key and all marks, so repeated marks go before any list is made
    marks = whole.unionByName(single).dropDuplicates(["k1", "k2", "place"]).groupBy("k1", "k2").agg(
        F.collect_list("place").alias("places"))
    out = keyed.join(marks, ["k1", "k2"], "left").select("doc_id", "text", "places")
    return out.mapInArrow(_apply(window),
                          "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
