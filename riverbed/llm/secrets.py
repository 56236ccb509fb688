"""Secret scans with one combined deterministic automaton.

A rule is a lead (a small regular expression over bytes) followed by a run of
body bytes.  All rules together become one automaton: a position automaton of
"anything, then any rule", determinised by subset construction, minimised by
partition refinement and laid out as one transition array.  A text is read
byte by byte once; a state with an accepting rule says that a match of the rule
is under way.  Only there a small automaton of the reversed rule walks back to
the leftmost start (not before the end of the rule's previous match), and the
body run is followed to its end.  A rule for keys goes on over the key data that
follows, up to the key's own END line.
"""

from __future__ import annotations

import hashlib
import re
from collections import namedtuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.frames import parts, ready

#: kind; lead and body as regular expressions over bytes; least body bytes of a
#: finding (a shorter match is passed over whole and not reported); whether key
#: data follows that belongs to the finding.
Rule = namedtuple("Rule", "kind lead body least key", defaults=(False,))

_KEYWORD = "(" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
                          for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
BASE = (
    Rule("assign", _KEYWORD + r"""["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]", 8),
    Rule("access", "AKIA", "[A-Z0-9]", 12),
    Rule("hex", "", "[0-9a-f]", 32),
)
EXTRA = (
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]", 36),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]", 20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", "[A-Za-z0-9_-]", 16),
    Rule("pem", r"-----BEGIN\x20([A-Z0-9]+\x20)*PRIVATE\x20KEY(\x20BLOCK)?", "-", 5, True),
)
RULES = BASE + EXTRA

_MARK = re.compile(rb"-----(?:BEGIN|END\x20(?:[A-Z0-9]+\x20)*PRIVATE\x20KEY(?:\x20BLOCK)?-*)").search
#: Between lines of a key: line ends (escaped ones too), indents, quotes, comment marks.
_GAP = rb"""(?:\\+[nrt]|[\s\\"'`>|#*+,;])*+"""
#: A key without END: its header lines, base64 of 16 and more characters in a row, a short last line, a checksum.
_CUT = re.compile(rb"(?:GAP(?:(?:Proc-Type|DEK-Info):\x20[^\s\\]*+|(?:Version|Comment|Hash|Charset|MessageID):\x20[^\r\n\\]*+))*+"
                  rb"(?:(?:GAP[A-Za-z0-9+/=]{16,}+)++(?:GAP[A-Za-z0-9+/]{1,15}+=*+)?(?:GAP=[A-Za-z0-9+/]{4})?)?"
                  .replace(b"GAP", _GAP)).match


def key_end(data: bytes, at: int) -> int:
    """End of the key whose header ends at ``at``: after its END line, whatever
    stands between; without one before the next BEGIN, the end of the key data."""
    mark = _MARK(data, at)
    if mark and mark[0].startswith(b"-----END"):
        return mark.end()
    cut = _CUT(data, at, mark.start() if mark else len(data))
    return cut.end()


class _Parser:
    """Regular expressions of literals, escapes, classes, groups, ``|``, ``?``, ``*``, ``+``."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def peek(self) -> str:
        return self.text[self.at] if self.at < len(self.text) else ""

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def choice(self):
        parts = [self.chain()]
        while self.peek() == "|":
            self.take()
            parts.append(self.chain())
        return ("or", parts) if len(parts) > 1 else parts[0]

    def chain(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            node = self.atom()
            while self.peek() in ("?", "*", "+") and self.peek():
                node = (self.take(), node)
            parts.append(node)
        return ("then", parts)

    def char(self) -> int:
        c = self.take()
        if c != "\\":
            return ord(c)
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2:self.at], 16)
        return ord(c)

    def atom(self):
        if self.peek() == "(":
            self.take()
            node = self.choice()
            self.take()
            return node
        if self.peek() != "[":
            return ("bytes", frozenset([self.char()]))
        self.take()
        found = set()
        while self.peek() != "]":
            low = self.char()
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                found.update(range(low, self.char() + 1))
            else:
                found.add(low)
        self.take()
        return ("bytes", frozenset(found))


def _flip(node):
    """The same expression read backwards."""
    kind, arg = node
    if kind == "then":
        return (kind, [_flip(x) for x in reversed(arg)])
    if kind == "or":
        return (kind, [_flip(x) for x in arg])
    return node if kind == "bytes" else (kind, _flip(arg))


class _Positions:
    """Position automaton of several expressions: ``classes[p]`` are the bytes
    position p takes, ``after[p]`` the positions that may come next, ``ends[p]``
    the rules complete at p."""

    def __init__(self, nodes):
        self.classes, self.after, self.ends, self.starts = [], [], [], set()
        for rule, node in enumerate(nodes):
            _, first, last = self.build(node)
            self.starts |= first
            for p in last:
                self.ends[p] = rule

    def build(self, node):
        """Whether it matches nothing, its first and its last positions."""
        kind, arg = node
        if kind == "bytes":
            self.classes.append(arg)
            self.after.append(set())
            self.ends.append(None)
            p = {len(self.classes) - 1}
            return False, p, p
        if kind == "or":
            parts = [self.build(x) for x in arg]
            return any(x[0] for x in parts), set().union(*(x[1] for x in parts)), set().union(*(x[2] for x in parts))
        if kind == "then":
            empty, first, last = True, set(), set()
            for x in arg:
                e, f, end = self.build(x)
                for p in last:
                    self.after[p] |= f
                first = first | f if empty else first
                last = last | end if e else set(end)
                empty = empty and e
            return empty, first, last
        e, f, end = self.build(arg)
        if kind in "*+":
            for p in end:
                self.after[p] |= f
        return e or kind in "?*", f, end


def _determinise(auto: _Positions, anywhere: bool):
    """Subset construction.  Returns transitions per state and byte (-1: none) and
    the rules accepting in each state."""
    by_byte = [frozenset(p for p, c in enumerate(auto.classes) if b in c) for b in range(256)]
    kinds = {}
    for b, x in enumerate(by_byte):
        kinds.setdefault(x, []).append(b)
    fresh = frozenset(auto.starts)
    start = frozenset([-1])
    number, todo, rows, accept = {start: 0}, [start], [], []
    while todo:
        state = todo.pop(0)
        may = set(fresh) if anywhere or state == start else set()
        for p in state:
            if p >= 0:
                may |= auto.after[p]
        row = [-1] * 256
        for allowed, some in kinds.items():
            into = frozenset(may & allowed)
            if not into and not anywhere:
                continue
            into = into or start
            if into not in number:
                number[into] = len(number)
                todo.append(into)
            for b in some:
                row[b] = number[into]
        rows.append(row)
        accept.append(frozenset(auto.ends[p] for p in state if p >= 0 and auto.ends[p] is not None))
    return np.array(rows, np.int64), accept


def _minimise(table: np.ndarray, accept: list):
    """Merge states that no input tells apart (partition refinement); state 0 stays first."""
    names = {a: i for i, a in enumerate(dict.fromkeys(accept))}
    group = np.array([names[a] for a in accept])
    while True:
        look = np.where(table < 0, -1, group[table])
        _, first, new = np.unique(np.column_stack((group, look)), axis=0, return_index=True, return_inverse=True)
        new = new.reshape(-1)
        if len(first) == len(set(group.tolist())):
            break
        group = new
    order = sorted(range(len(first)), key=lambda g: first[g])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    rep = first[order]
    return np.where(table[rep] < 0, -1, rank[new[table[rep]]]), [accept[s] for s in rep]


class Scanner:
    """All rules in one transition array, one byte pass per text."""

    def __init__(self, rules=RULES):
        self.rules = tuple(rules)
        nodes, self.back, self.body = [], [], []
        for r in self.rules:
            body = _Parser(r.body).atom()
            # without a lead a short run can't be part of a longer match, so the run is awaited whole
            node = ("then", [_Parser(r.lead).choice(), *[body] * (1 if r.lead else r.least)])
            nodes.append(node)
            table, accept = _determinise(_Positions([_flip(node)]), anywhere=False)
            self.back.append((table.tolist(), [bool(a) for a in accept]))
            self.body.append(frozenset(body[1]))
        table, accept = _minimise(*_determinise(_Positions(nodes), anywhere=True))
        quiet = [s for s, a in enumerate(accept) if not a]
        order = quiet + [s for s, a in enumerate(accept) if a]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.states = len(order)
        self.limit = 256 * len(quiet)
        names = [256 * i for i in range(len(order))]
        self.table = [names[t] for t in place[table[order]].reshape(-1).tolist()]
        self.accept = [tuple(sorted(accept[s])) for s in order]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, by start, then rule."""
        table, limit, found = self.table, self.limit, []
        done = [0] * len(self.rules)
        state = 0
        for at, byte in enumerate(data):
            state = table[state + byte]
            if state >= limit:
                for rule in self.accept[state >> 8]:
                    if at >= done[rule]:
                        self._take(data, at, rule, done, found)
        return sorted(found)

    def _take(self, data: bytes, at: int, rule: int, done: list, found: list) -> None:
        rows, accept = self.back[rule]
        start, state, i = -1, 0, at
        while i >= done[rule]:
            state = rows[state][data[i]]
            if state < 0:
                break
            if accept[state]:
                start = i
            i -= 1
        if start < 0:
            return
        body, r, end = self.body[rule], self.rules[rule], at + 1
        while end < len(data) and data[end] in body:
            end += 1
        # at is the first place where the rule is complete, so the body begins there (or ``least`` before)
        whole = end - at >= r.least or not r.lead
        if whole and r.key:
            end = key_end(data, end)
        done[rule] = end
        if whole:
            found.append((start, rule, end))


def _code_points(data: bytes, spans: list) -> list:
    if data.isascii():
        return spans
    before = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
    return [(int(before[s]), r, int(before[e])) for s, r, e in spans]


def _texts(col: pa.Array):
    for x in col:
        yield (x.as_py() or "").encode()


def _scan(rules):
    def run(batches):
        scanner = Scanner(rules)
        kinds = [r.kind for r in scanner.rules]
        for batch in parts(batches):
            spans = [_code_points(d, scanner.spans(d)) for d in _texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.array([[{"kind": kinds[r], "start": s, "end": e} for s, r, e in x] for x in spans],
                          pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "found"])
    return run


def find_secrets(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, found``: an array of ``kind, start, end`` (code points, end
    exclusive), by start, then in the order of the rules.

    Matches of one kind are leftmost and don't overlap; kinds may.  Null text is
    empty text; repeated rows and null ids are rows like any other; columns other
    than the two named are ignored.  No rows: an empty table."""
    return ready(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _scan(rules), "doc_id long, found array<struct<kind:string,start:long,end:long>>")


def digest(found: DataFrame, base=BASE) -> DataFrame:
    """The counts and joined spans of ``find_secrets``."""
    say = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    kinds = [r.kind for r in base]
    of = lambda some: F.filter("found", lambda x: x["kind"].isin(some))
    count = [F.size(of([k])).cast("long").alias(f"n_{k}") for k in kinds]
    own = of(kinds)
    return found.select("doc_id", *count, F.sha2(say(own).cast("binary"), 256).alias("base_sha256"),
                        say(F.col("found")).alias("spans"))


def _mask(rules, text: str, count: str | None):
    def run(batches):
        scanner = Scanner(rules)
        for batch in parts(batches):
            old = batch.column(text).to_pylist()
            new = []
            for x in old:
                data, out, at = (x or "").encode(), [], 0
                for s, r, e in scanner.spans(data):
                    if e > at:
                        out += [data[at:s], b"[" + scanner.rules[r].kind.encode() + b"]"] if s >= at else []
                        at = e
                new.append(None if x is None else b"".join([*out, data[at:]]).decode())
            cols = [batch.column(i) for i in range(batch.num_columns)]
            names = batch.schema.names
            cols[names.index(text)] = pa.array(new, batch.schema.field(text).type)
            if count:
                was = cols[names.index(count)].to_pylist()
                cols[names.index(count)] = pa.array(
                    [w if a == b else len(b) for w, a, b in zip(was, old, new, strict=True)],
                    batch.schema.field(count).type)
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def mask_secrets(docs: DataFrame, rules=RULES, text_col: str = "text", count_col: str = "n_chars") -> DataFrame:
    """``docs`` with every finding replaced by its kind in brackets (findings that
    overlap by the first one's); ``count_col``, if there, follows the new length.
    All rows and columns stay; texts without findings and null texts are unchanged."""
    count = count_col if count_col in docs.columns else None
    return ready(docs).mapInArrow(_mask(rules, text_col, count), docs.schema)
