"""License scans: passages against licence templates by Dice coefficient.

Text is normalised (lower case, letters and digits only, version numbers kept)
to one sequence of words.  A passage is any run of words; it is compared with a
template as a multiset of word bigrams, ``2 * common / (size + size)``.  A
coefficient of t or more needs sizes within a factor ``t / (2 - t)`` of each
other and that share of the template's bigrams in common, and the best passage
begins and ends with a bigram of its template (without another one at its rim
it is better).  So runs are formed only where a template's bigrams lie close
enough, from one of them to another, with the counts updated step by step.

The best passage of a text comes first (the longer of equals, then the first),
then the best of the words left on both sides of it.  A coefficient tells the
family; which licence of the family it is, version and variant, is read from the
words that decide it.  If they aren't there, the passage is ``ambiguous``.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect
from collections import Counter
from itertools import accumulate
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.frames import parts, ready

_GNU = (("GPL", "General Public License", "2.0"), ("GPL", "General Public License", "3.0"),
        ("LGPL", "Lesser General Public License", "2.1"), ("LGPL", "Lesser General Public License", "3.0"),
        ("AGPL", "Affero General Public License", "3.0"))
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution.")
_BSD_THIRD = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written permission.")
# Wording of common licence notices, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of "
                         "the GNU General Public License as published by the Free Software Foundation, either version 3 "
                         "of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the "
                   "terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of "
                   "this document."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", _BSD),
    ("BSD-3-Clause", _BSD + " " + _BSD_THIRD),
    *[(f"{short}-{v}", f"This work is licensed under the GNU {long}, version {v.removesuffix('.0')}.")
      for short, long, v in _GNU if (short, v) in (("AGPL", "3.0"), ("LGPL", "2.1"))],
    *[(f"{short}-{v}-or-later", f"This program is free software: you can redistribute it and/or modify it under the terms of "
       f"the GNU {long} as published by the Free Software Foundation, either version {v.removesuffix('.0')} of the License, "
       "or (at your option) any later version.") for short, long, v in _GNU if (short, v) != ("GPL", "3.0")],
    *[(f"{short}-{v}", f"under the terms of the GNU {long} version {v.removesuffix('.0')} as published by the Free Software "
       "Foundation") for short, long, v in _GNU],
    *[(f"{short}-{v}", f"This License refers to version {v.removesuffix('.0')} of the GNU {long}.")
      for short, long, v in _GNU if v == "3.0"],
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software "
                 "Foundation, Inc."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, "
                 "Inc."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software "
                 "Foundation, Inc."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0"),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License v1.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
                "rights to this software to the public domain worldwide."),
    *[(f"CC-BY-{k}-4.0", f"Licensed under CC BY-{k} 4.0.") for k in ("ND", "NC-SA", "NC-ND")],
    *[(f"CC-BY-{k}-4.0", f"This work is licensed under a Creative Commons Attribution-{long} 4.0 International License.")
      for k, long in (("SA", "ShareAlike"), ("NC", "NonCommercial"), ("ND", "NoDerivatives"),
                      ("NC-SA", "NonCommercial-ShareAlike"), ("NC-ND", "NonCommercial-NoDerivatives"))],
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted."),
)
LEAST = 0.85
_WORDS = re.compile(r"[^\W_]+(?:\.[0-9]+)*").findall


def bigrams(text: str) -> Counter:
    """Word bigrams of the normalised text; a single word stands for itself."""
    words = _WORDS(text.lower())
    return Counter(zip(words, words[1:], strict=False)) if len(words) > 1 else Counter((w,) for w in words)


def dice(a: Counter, b: Counter) -> float:
    size = a.total() + b.total()
    return 2 * (a & b).total() / size if size else 0.0


AMBIGUOUS = "ambiguous"
#: Words after a passage that may still decide it: "or any later version", the next condition; for BSD, its clauses.
AFTER, CLAUSES = 12, 200
_NUMBER = re.compile(r"v?([0-9]+(?:\.[0-9]+)*)").fullmatch


def _numbers(words: list[str], after=None) -> set[str]:
    """Version numbers as 2.0 for 2, those that follow one of the words ``after`` only, if given, or bear a v."""
    got = set()
    for was, w in zip([""] + words, words, strict=False):
        m = _NUMBER(w)
        if m and (after is None and "." in w or after and was in after or w[0] == "v"):
            got.add(m[1] if "." in m[1] else m[1] + ".0")
    return got


def decided(name: str, words: list[str], start: int, end: int) -> str:
    """The licence of a passage ``words[start:end]`` that is like a template of ``name``."""
    own = words[start:end]
    says = f" {' '.join(own)} "
    beyond = f" {' '.join(words[start:end + AFTER])} "
    family = name.split("-")[0]
    if family in ("GPL", "LGPL", "AGPL"):
        near = f" {' '.join(words[max(0, start - 2):end])} "
        kinds = {k for k, w in (("AGPL", " affero "), ("LGPL", " lesser "), ("LGPL", " library general ")) if w in near}
        version = _numbers(own, ("version", "license", "v"))
        if len(kinds) > 1 or len(version) != 1 or " general public license " not in says:
            return AMBIGUOUS
        later = " any later version " in beyond or " or later " in beyond
        return f"{min(kinds, default='GPL')}-{min(version)}" + ("-or-later" if later else "")
    if family == "BSD":
        if " bsd " in says:
            n = [w for w in own if w in ("2", "3", "4")]
            return f"BSD-{n[0]}-Clause" if len(n) == 1 else AMBIGUOUS
        clauses, end_of_clauses, _ = f" {' '.join(words[start:max(end, start + CLAUSES)])} ".partition(" software is provided ")
        if " advertising materials " in clauses:
            return "BSD-4-Clause"
        if " endorse or promote " in clauses:
            return "BSD-3-Clause"
        return "BSD-2-Clause" if end_of_clauses and " in binary form must reproduce " in clauses else AMBIGUOUS
    if family == "CC":
        version = _numbers(own)
        if len(version) != 1 or not {"by", "attribution"} & set(own):
            return AMBIGUOUS
        kinds = [k for k, some in (("NC", ("nc", "noncommercial")), ("SA", ("sa", "sharealike")),
                                   ("ND", ("nd", "noderivatives", "noderivs"))) if set(some) & set(own)]
        return "-".join(["CC-BY", *kinds, min(version)])
    if family in ("Apache", "MPL", "EPL"):
        if " sections 1 through 9 of this document " in says:
            return name
        version = _numbers(own)
        known = {"Apache": " apache ", "MPL": " mozilla ", "EPL": " eclipse "}[family] in says
        return f"{family}-{min(version)}" if known and len(version) == 1 else AMBIGUOUS
    if family in ("ISC", "0BSD"):
        if " provided that the above copyright notice " in beyond:
            return "ISC"
        return "0BSD" if " hereby granted " in says else AMBIGUOUS
    if family == "MIT":
        if " mit " in says:
            return name
        if " sublicense " not in says:
            return AMBIGUOUS
        return "MIT-0" if " the software is provided " in beyond and " subject to " not in beyond else name
    if name == "CC0-1.0":
        return name if " cc0 1.0 " in says or " dedicated all copyright " in says else AMBIGUOUS
    if name == "Unlicense":
        return name if " unencumbered " in says else AMBIGUOUS
    return name


class Templates:
    def __init__(self, templates=TEMPLATES, least: float = LEAST):
        self.least = least
        self.names = [n for n, _ in templates]
        self.grams = [bigrams(t) for _, t in templates]
        self.sizes = [g.total() for g in self.grams]
        #: Most bigrams of a passage, and least in common with it.
        self.most = [s * (2 - least) / least + 1e-9 for s in self.sizes]
        self.must = [max(1, ceil(s * least / (2 - least) - 1e-9)) for s in self.sizes]
        self.known: dict[tuple, list[int]] = {}
        for i, grams in enumerate(self.grams):
            for g in grams:
                self.known.setdefault(g, []).append(i)
        self.single = any(len(g) == 1 for g in self.known)

    def _best(self, t: int, hits: list, k: int, stop: int):
        """Best run from the template's k-th hit on, up to the word ``stop``: key
        (less is better), word after its end; none: None."""
        grams, size, most, at = self.grams[t], self.sizes[t], self.most[t], hits[k][0]
        seen: dict[tuple, int] = {}
        common, top = 0, None
        for p, gram in hits[k:] if len(hits) - k <= most else hits[k:k + int(most)]:
            if p + len(gram) > stop or p - at + 1 > most or len(gram) == 1 and p > at:
                break
            seen[gram] = seen.get(gram, 0) + 1
            common += seen[gram] <= grams[gram]
            d = 2 * common / (p - at + 1 + size)
            if d >= self.least and (top is None or d >= top[0]):
                top = (d, p + len(gram))
        return top and ((-top[0], at - top[1], at, t), top[1])

    def runs(self, words: list[str]) -> list[tuple[int, int, int, float]]:
        """Passages (first word, word after the last, template, coefficient) in order."""
        hits: dict[int, list] = {}
        known = self.known
        for p, g in enumerate(zip(words, words[1:], strict=False)):
            if g in known:
                for t in known[g]:
                    hits.setdefault(t, []).append((p, g))
        if self.single:
            for p, w in enumerate(words):
                for t in known.get((w,), ()):
                    hits.setdefault(t, []).append((p, (w,)))
        heap = []
        for t, some in hits.items():
            must, most = self.must[t], self.most[t]
            for k in range(len(some) - must + 1):
                if some[k + must - 1][0] - some[k][0] + 1 <= most:
                    got = self._best(t, some, k, len(words))
                    if got:
                        heap.append((*got, k))
        heapq.heapify(heap)
        begins, ends, taken = [], [], {}
        while heap:
            key, end, k = heapq.heappop(heap)
            start, t = key[2:]
            i = bisect(begins, start)
            if i and ends[i - 1] > start:
                continue
            if i < len(begins) and begins[i] < end:
                # cut by a better passage: the best run before it
                got = self._best(t, hits[t], k, begins[i])
                if got:
                    heapq.heappush(heap, (*got, k))
                continue
            begins.insert(i, start)
            ends.insert(i, end)
            taken[start] = (t, -key[0])
        return [(a, b, *taken[a]) for a, b in zip(begins, ends, strict=True)]

    def find(self, text: str) -> list[tuple[int, int, str, float]]:
        """Passages (first line, line after the last, licence, coefficient) in order; two may share a line."""
        words = _WORDS(text.lower())
        found = self.runs(words)
        if not found:
            return []
        upto = list(accumulate(len(_WORDS(x.lower())) for x in text.split("\n")))
        return [(bisect(upto, a), bisect(upto, b - 1) + 1, decided(self.names[t], words, a, b), d)
                for a, b, t, d in found]


_FOUND = "found array<struct<first_line:int,end_line:int,licence:string,dice:double>>"


def _scan(templates, least: float):
    def run(batches):
        known = Templates(templates, least)
        kind = pa.list_(pa.struct([("first_line", pa.int32()), ("end_line", pa.int32()), ("licence", pa.string()),
                                   ("dice", pa.float64())]))
        for batch in parts(batches):
            rows = [[{"first_line": a, "end_line": b, "licence": n, "dice": d} for a, b, n, d in known.find(x.as_py() or "")]
                    for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "found"])
    return run


def find_licences(docs: DataFrame, templates=TEMPLATES, least: float = LEAST, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, found``: non-overlapping runs of words that reach
    ``least``, by their lines (from 0, end exclusive), with licence and
    coefficient, in order.  Two runs may share a line.  The licence is
    ``ambiguous`` where the words that tell licences of a family apart are missing.

    Null and empty texts have none; repeated rows and null ids are rows like any
    other; other columns are ignored.  No rows: an empty table."""
    return ready(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _scan(templates, least), f"doc_id long, {_FOUND}")
