"""Results that no cap, sample or short cut may change."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_operators import ROWS, SCHEMA, SPACE, lower

from glossa.llm import scoring, secrets, toxicity, words


def whole_model_scores():
    """Score of each row by the bigram model with every pair that is seen twice."""
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = [(i, [*re.findall(SPACE, lower(t)), "\0end"]) for i, t, *_ in ROWS]
    c, pairs, seen = Counter(), Counter(), Counter()
    for i, ws in tokens:
        if not held(i):
            c.update(ws)
            pairs.update(zip(["\0begin", *ws], ws))
            seen.update(["\0begin", *ws[:-1]])
    n = sum(c.values())
    unknown = (sum(x == 1 for x in c.values()) + 1) / (n + 2)
    root = lambda w: (1 - unknown) * c[w] / n if c[w] else unknown
    arcs, left, below = {}, defaultdict(lambda: 1.0), defaultdict(lambda: 1.0)
    for (x, w), m in pairs.items():
        if m >= 2:
            arcs[x, w] = (m - 0.5) / seen[x]
            left[x] -= arcs[x, w]
            below[x] -= root(w)
    p = lambda x, w: arcs.get((x, w)) or (left[x] / below[x] if x in left else 1) * root(w)
    return sorted((i if i is not None else -1, len(ws), round(sum(math.log10(p(x, w)) for x, w in zip(["\0begin", *ws], ws)), 5)) for i, ws in tokens)


@pytest.mark.parametrize("held", [scoring.ARCS, 1 << 9, 1])
def test_every_repeated_pair_has_its_arc(spark, monkeypatch, held):
    monkeypatch.setattr(scoring, "WORDS", held)
    monkeypatch.setattr(scoring, "ARCS", held)
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = scoring.score(docs, scoring.in_part(F.col("doc_id"), 7, 2)).collect()
    for a, b in zip(sorted((r["key"] if r["key"] is not None else -1, r["n_tokens"], round(r["score"], 5)) for r in got), whole_model_scores(), strict=True):
        assert a[:2] == b[:2]
        assert a[2] == pytest.approx(b[2], abs=1e-4)


def test_misspellings_of_all_lexicon_terms_are_found():
    rng = random.Random(8)
    terms = ["".join(rng.choices("bcdfghklmnprstvwz", k=9)) for _ in range(400)] + ["größenwahn"]
    lexicon = toxicity.Lexicon({**dict.fromkeys(toxicity.SEED, 3.0), **{t: 2.0 for t in terms}}, {})
    wrong = [t[:3] + "x" + t[4:] for t in terms] + ["grossenwahn", "cretin", "enculè", "imbécill"]
    (c,) = words.chunks(pa.array([f"{w} é" for w in wrong]), words.ALNUM)
    near = lexicon.features(c)[:, 4]
    assert [w for w, x in zip(wrong, near, strict=True) if not x] == ["grossenwahn"]  # three edits
    (c,) = words.chunks(pa.array(["harmless", "crtn", "imbaacill"]), words.ALNUM)
    assert not np.any(lexicon.features(c)[:, 4])


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("the secret for AbstractFactoryController is q8Zt1LwX0vR5nYb2KpM7", ["q8Zt1LwX0vR5nYb2KpM7"]),
        ("q8Zt1LwX0vR5nYb2KpM7 is the secret", ["q8Zt1LwX0vR5nYb2KpM7"]),
        ("token kQzTbWxRvNpLsJdHgFmC or q8Zt1LwX0vR5nYb2KpM7", ["kQzTbWxRvNpLsJdHgFmC", "q8Zt1LwX0vR5nYb2KpM7"]),
        ("token" + " far" * 20 + " q8Zt1LwX0vR5nYb2KpM7" + " far" * 20 + " token", []),
    ],
)
def test_every_candidate_near_a_sensitive_word_is_measured(text, want):
    assert [text[a:b] for a, _, b in secrets.novel_spans(text, text.lower(), [], secrets.Novelty())] == want
