"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent character n-grams (one to
three characters of lower-cased words set off by blanks), most frequent first.
A document's own list is compared with each profile by out-of-place distance:
the sum, over the document's n-grams, of how far the two ranks lie apart, or of
the profile's length where the profile lacks the n-gram.  The least distance
wins.  Profiles are learned from a bounded sample per language; every document
is predicted from its whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverbed.llm.frames import materialize, parts, ready

#: Length of a profile, and labelled documents that a language's profile is learned from.
PROFILE, SAMPLE = 300, 1000
#: Least score of a text whose language counts as found: the tables' texts have 0.41 and more,
#: random letters about 0.16, a script of which no language was learned 0.
LEAST_SCORE = 0.2
UNKNOWN = "und"
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text (three 21-bit characters each) and their counts."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32).astype(np.int64)
    letter = _letters()[c]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = np.where(letter, c, 32)
    before = np.concatenate(([False], letter[:-1]))
    c = np.concatenate(([32], c[letter | before], [32]))
    if c[-2] == 32:
        c = c[:-1]
    two = c[:-1] << 21 | c[1:]
    three = two[:-1] << 21 | c[2:]
    grams, count = np.unique(np.concatenate((c[c != 32], two, three)), return_counts=True)
    return grams, count


def ranked(grams: np.ndarray, count: np.ndarray, length: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, ties by value."""
    return grams[np.lexsort((grams, -count))[:length]]


class Profiles:
    """The learned languages; ``predict`` gives the nearest and a score in 0..1."""

    def __init__(self, lists: dict[str, list[int]], length: int = PROFILE):
        self.names, self.length = sorted(lists), length
        self.lookup = []
        for name in self.names:
            grams = np.array(lists[name], np.int64)
            order = np.argsort(grams)
            self.lookup.append((grams[order], order))

    def predict(self, text: str | None) -> tuple[str, float]:
        own = ranked(*ngrams(text), self.length)
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        place, far = np.arange(len(own)), []
        for grams, rank in self.lookup:
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            out = np.where(grams[at] == own, np.abs(rank[at] - place), self.length)
            far.append(int(np.minimum(out, self.length).sum()))
        best = int(np.argmin(far))
        return self.names[best], 1.0 - far[best] / (self.length * len(own))


def _counts(batches):
    for batch in batches:
        total: dict[str, dict[int, int]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            into = total.setdefault(lang, {})
            for g, n in zip(*(x.tolist() for x in ngrams(text.as_py())), strict=True):
                into[g] = into.get(g, 0) + n
        rows = [(lang, g, n) for lang, into in total.items() for g, n in into.items()]
        lang, gram, n = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(gram, pa.int64()), pa.array(n, pa.int64())],
            names=["lang", "gram", "n"])


def held_out(id_col: str):
    """True for the fold whose labels are never learned from (null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, sample: int = SAMPLE, length: int = PROFILE, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Profiles from at most ``sample`` documents per language: those with the
    least hash of their text among the labelled ones outside the held-out fold
    (ties all).  Rows without id, label or text teach nothing.  The driver
    receives ``length`` n-grams per language and no more."""
    rows = ready(docs).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                              F.xxhash64(F.col(text_col)).alias("h")).filter(
        F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    first = Window.partitionBy("lang").orderBy("h")
    cut = rows.select("lang", "h").withColumn("r", F.row_number().over(first)).filter(F.col("r") <= sample)
    cut = materialize(cut.groupBy("lang").agg(F.max("h").alias("cut")), "cuts")
    taught = rows.join(cut, "lang").filter("h <= cut").select("lang", "text")
    grams = taught.mapInArrow(_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = grams.withColumn("r", F.row_number().over(top)).filter(F.col("r") <= length)
    lists: dict[str, list[int]] = {}
    for lang, gram, _ in sorted(best.select("lang", "gram", "r").collect(), key=lambda x: (x[0], x[2])):
        lists.setdefault(lang, []).append(gram)
    return Profiles(lists, length)


def _predict(profiles: Profiles):
    def run(batches):
        for batch in parts(batches):
            got = [profiles.predict(x.as_py()) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, held_out, lang_pred, score``.

    lang_pred is ``und`` with score 0 where the text is null, empty or has no
    letter, or nothing was learned; equal distances go to the language first in
    code point order.  Repeated rows and null ids (never held out) are rows like
    any other; other columns are ignored.  No rows: an empty table."""
    return ready(docs).select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                              F.col(text_col).alias("text")).mapInArrow(
        _predict(profiles), "doc_id long, held_out boolean, lang_pred string, score double")


def _known(profiles: Profiles, text: str, least: float):
    def run(batches):
        for batch in parts(batches):
            got = [profiles.predict(x.as_py()) for x in batch.column(text)]
            yield batch.filter(pa.array([g[0] != UNKNOWN and g[1] >= least for g in got], pa.bool_()))
    return run


def keep_known(docs: DataFrame, profiles: Profiles, least: float = LEAST_SCORE, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is found with a score of
    ``least`` or more; texts without letters (null ones too), of letters in no order that
    a language has, or of a language that was not learned go.  Where nothing
    was learned, nothing can be told of any text and all rows stay."""
    if not profiles.names:
        return docs
    return ready(docs).mapInArrow(_known(profiles, text_col, least), docs.schema)
