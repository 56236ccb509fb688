"""Signatures and large groups of near copies."""

import random

import numpy as np

from riverbed.llm import minhash
from riverbed.llm.words import U64


def test_long_unrelated_sets_share_no_band():
    r = np.random.Generator(np.random.PCG64(8))
    names = [minhash.band_names(minhash.signature(r.integers(0, 2**63, 20_000, dtype=np.uint64).astype(U64))) for _ in range(200)]
    every = np.concatenate(names)
    assert len(np.unique(every)) == len(every) == 200 * minhash.BANDS


def test_meeting_follows_similarity():
    """Pairs at 0.8 and more always meet, pairs at 0.3 about as rarely as (1 - (1 - 0.3**6)**50) says."""
    r, met = np.random.Generator(np.random.PCG64(9)), {0.3: 0, 0.8: 0}
    for similarity in met:
        for _ in range(300):
            n = 400
            both = round(2 * n * similarity / (1 + similarity))
            x = r.integers(0, 2**63, 2 * n - both, dtype=np.uint64).astype(U64)
            a, b = (set(minhash.band_names(minhash.signature(s)).tolist()) for s in (x[:n], x[n - both:]))
            met[similarity] += bool(a & b)
    assert met[0.8] == 300 and met[0.3] < 30


def test_ten_thousand_near_copies_are_one_group(spark):
    r = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*base[:-1], f"u{i}"])) for i in range(9000)]
    rows += [(9000 + i, " ".join(base[:60] + [f"v{i}_{j}" for j in range(r.randrange(60, 80))])) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(df, 4, 80).collect()}
    assert got == {i: 0 if i < 9000 else i for i in range(10_000)}
