"""Byte-level BPE encoding and decoding as a reduction over a tree.

The encodings of texts form a monoid: an element is the token sequence of a
text, the product of two elements is the encoding of the joined text.  A text
is encoded by halves; two neighbours are joined by encoding a window about the
boundary anew and widening it until what lies outside provably stays:

* pieces (matches of the splitting pattern): a match looks at most
  ``LOOK`` characters past its end, so a piece with that much unchanged text
  behind it stays, and from any common piece start on, the right side stays;
* tokens inside a piece: a token sequence is the encoding of its bytes exactly
  if each adjacent pair is the encoding of its own bytes, so the outside stays
  once the two pairs at the window's edges hold.

Decoding concatenates the tokens' bytes up the same kind of tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.frames import parts, ready

#: Characters a match of the pattern may look at past its end.
LOOK = 3
#: Leaves of the trees: characters of a text, bytes of a piece, tokens to decode.
TEXT_LEAF, PIECE_LEAF, TOKEN_LEAF = 1 << 14, 6, 1 << 14
#: Bytes from which a piece isn't remembered and is merged with a heap.
LONG = 64
#: Repeated pieces and token pairs that a worker remembers, in each of two generations.
MEMORY = 1 << 17


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a vocabulary file of lines "base64 rank"."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Pieces(dict):
    """Results by piece, worked out on first use.  When full, the young entries
    become the old ones; an old entry that is used again becomes young."""

    def __init__(self, work, most: int = MEMORY):
        super().__init__()
        self.work, self.most, self.old = work, most, {}

    def __missing__(self, piece):
        out = self.old.get(piece)
        if out is None:
            out = self.work(piece)
            if len(piece) > LONG:
                return out
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[piece] = out
        return out


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str, memory: int = MEMORY):
        self.ranks = ranks
        self.bytes = {i: b for b, i in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.pieces = Pieces(lambda p: tuple(self.encode_piece(p.encode())), memory)
        self.leaves = Pieces(lambda p: tuple(self.merge(p)), memory)
        self.pairs = Pieces(lambda p: tuple(self.merge(self.bytes[p[0]] + self.bytes[p[1]])), memory)

    def merge(self, data: bytes) -> list[int]:
        """Leaf: join the pair of lowest rank, the leftmost first, while there is one."""
        ranks = self.ranks
        if len(data) > LONG:
            return self._merge_long(data)
        parts = [data[i:i + 1] for i in range(len(data))]
        get, none = ranks.get, len(ranks) << 1
        near = [get(data[i:i + 2], none) for i in range(len(data) - 1)]
        while near and (low := min(near)) < none:
            i = near.index(low)
            parts[i] += parts.pop(i + 1)
            del near[i]
            if i < len(near):
                near[i] = get(parts[i] + parts[i + 1], none)
            if i:
                near[i - 1] = get(parts[i - 1] + parts[i], none)
        return [ranks[p] for p in parts]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same with a heap of pairs, for windows that had to grow."""
        ranks = self.ranks
        end = list(range(1, len(data) + 1))
        before = list(range(-1, len(data) - 1))
        heap = [(r, i) for i in range(len(data) - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        size = len(data)
        live = [True] * size
        while heap:
            rank, i = heapq.heappop(heap)
            if not live[i] or end[i] >= size:
                continue
            mid = end[i]
            if ranks.get(data[i:end[mid]]) != rank:
                continue  # one of the two has grown since
            live[mid], end[i] = False, end[mid]
            if end[i] < size:
                before[end[i]] = i
                if (r := ranks.get(data[i:end[end[i]]])) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := ranks.get(data[before[i]:end[i]])) is not None:
                heapq.heappush(heap, (r, before[i]))
        return [ranks[data[i:end[i]]] for i in range(size) if live[i]]

    def _halves(self, data: bytes) -> list[int]:
        if len(data) <= PIECE_LEAF:
            return list(self.leaves[data])
        mid = len(data) // 2
        return self.join_tokens(self._halves(data[:mid]), self._halves(data[mid:]))

    def _holds(self, a: int, b: int) -> bool:
        """Whether two tokens in a row are the encoding of their own bytes."""
        return self.pairs[a, b] == (a, b)

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring byte strings of one piece."""
        wide = 1
        while left and right:
            i, j = max(len(left) - wide, 0), min(wide, len(right))
            if wide == 1:
                new = list(self.pairs[left[-1], right[0]])
            else:
                new = self.merge(b"".join(map(self.bytes.__getitem__, chain(left[i:], right[:j]))))
            if (i == 0 or self._holds(left[i - 1], new[0])) and (j == len(right) or self._holds(new[-1], right[j])):
                return left[:i] + new + right[j:]
            wide *= 2
        return left + right

    def encode_piece(self, data: bytes) -> list[int]:
        """A whole piece in the vocabulary is one token, any other is merged."""
        rank = self.ranks.get(data)
        return [rank] if rank is not None else self._halves(data)

    def split_tree(self, text: str) -> list[str]:
        """The pieces of a text, by halves."""
        if len(text) <= TEXT_LEAF:
            return self.split(text)
        mid = len(text) // 2
        return self.join_pieces(self.split_tree(text[:mid]), self.split_tree(text[mid:]))

    def join_pieces(self, left: list[str], right: list[str]) -> list[str]:
        wide = 2
        while True:
            i, j = max(len(left) - wide, 0), min(wide, len(right))
            head, tail = "".join(left[i:]), "".join(right[:j])
            new = self.split(head + tail)
            if i == 0 and j == len(right):
                return new
            if i == 0 or len(head) >= LOOK:
                starts, at = {}, len(head)
                for k, piece in enumerate(right[:j]):
                    starts[at] = k
                    at += len(piece)
                if j == len(right):
                    return left[:i] + new
                at = 0
                for k, piece in enumerate(new):
                    if at in starts and at + LOOK <= len(head) + len(tail):
                        return left[:i] + new[:k] + right[starts[at]:]
                    at += len(piece)
            wide *= 2

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.split_tree(text))))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= TOKEN_LEAF:
            return b"".join(map(self.bytes.__getitem__, ids))
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


_MADE: dict[tuple, Bpe] = {}


def bpe_for(ranks, pattern: str, memory: int = MEMORY) -> Bpe:
    """One encoder per worker process and vocabulary, so that its memory is used
    by later tasks.  ``ranks``: a broadcast of the ranks."""
    key = (ranks.id if hasattr(ranks, "id") else id(ranks), pattern, memory)
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = Bpe(ranks.value, pattern, memory)
    return _MADE[key]


def _encode(ranks, pattern: str, with_ids: bool, memory: int):
    def run(batches):
        bpe = bpe_for(ranks, pattern, memory)
        names = [str(i) for i in range(max(bpe.bytes, default=-1) + 1)]
        for batch in parts(batches):
            rows = []
            for x in batch.column("text"):
                ids = bpe.encode(x.as_py() or "")
                rows.append((len(ids), hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest(),
                             hashlib.sha256(bpe.decode(ids)).hexdigest(), array("i", ids).tobytes() if with_ids else None))
            count, sha, back, raw = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(sha, pa.string()),
                 pa.array(back, pa.string()), pa.array(raw, pa.binary())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"])
    return run


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = True, memory: int = MEMORY) -> DataFrame:
    """Per row ``doc_id, n_tokens, ids_sha256, decoded_sha256, ids``: the token ids
    (little-endian int32) of the whole text, the hash of the ids in decimal and
    of the bytes that decoding them gives (``with_ids`` false: ids is null).
    ``memory`` bounds what a worker remembers; it changes the speed, not the result.

    ``vocabulary`` is a file of ranks that the driver reads and broadcasts (its
    size is that of the file: under 1 MB).  Special tokens in a text are
    ordinary text.  Null text is empty text: no tokens.  Repeated rows and null
    ids are rows like any other; columns other than the two named are ignored.
    No rows: an empty table."""
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))
    return ready(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _encode(ranks, pattern, with_ids, memory),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary")


def _decode(ranks, pattern: str):
    def run(batches):
        import numpy as np
        bpe = bpe_for(ranks, pattern)
        for batch in parts(batches):
            out = [bpe.decode(np.frombuffer(x.as_py() or b"", "<i4").tolist()) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())],
                                             names=["doc_id", "bytes"])
    return run


def decode(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``doc_id, bytes`` of the ids column that ``encode`` returns (null: empty)."""
    ranks = encoded.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))
    return ready(encoded).select("doc_id", "ids").mapInArrow(_decode(ranks, pattern), "doc_id long, bytes binary")
