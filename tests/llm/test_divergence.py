import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tablewarden.llm import divergence as dv

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})
DOCS = "doc_id bigint, text string, lang string, source string, term string, n bigint, bucket string, tile int"


def brute(rows, least, top):
    """(lang, source, part, item, value) by plain loops."""
    held, every, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        words = TERM.findall((text or "").translate(LOWER))
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        held[lang, source].update(words)
        every[lang].update(words)
        seen[lang].update(set(words))
    out = set()
    for lang, source in groups:
        terms = sorted((t for t, n in seen[lang].items() if n >= least), key=str.encode)

        def shares(counts):
            under = sum(counts[t] for t in terms) + 5 * len(terms)  # noqa: B023
            return {t: 1 + 10**9 * (counts[t] + 5) // under for t in terms}  # noqa: B023

        p, q = shares(held[lang, source]), shares(every[lang])
        for other in sorted(s for g, s in groups if g == lang and s != source):
            r = shares(held[lang, other])
            out.add((lang, source, "pair", other, sum(abs(p[t] - r[t]) for t in terms)))
        lead = [(q[t] - p[t], t.encode()) for t in terms if held[lang, source][t] and p[t] > q[t]]
        out |= {(lang, source, "term", t.decode(), -v) for v, t in sorted(lead)[:top]}
    return out


def rows_of(found):
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, n=150):
    draw = random.Random(seed)
    words = ["Zebra", "zebra", "été", "ÉTÉ", "a", "b1c", "x-y", "漢字", "it's", *(f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(6))]
    texts = [" ".join(draw.choices(words, k=draw.randint(0, 40))) for _ in range(n)]
    langs, sources = ["en", "de", None, ""], ["s1", "s2", "s3", "é", None, "", "s1"]
    return [(t if draw.random() > 0.05 else None, draw.choice(langs), draw.choice(sources)) for t in texts]


@pytest.mark.parametrize(("leaves", "tile"), [(2048, 32), (7, 2), (1, 1)])
def test_equals_plain_loops(frame, leaves, tile):
    rows = corpus(5)
    docs = frame([(i, t, g, s, "x", 1, "b", 2) for i, (t, g, s) in enumerate(rows)], DOCS)
    got = rows_of(dv.divergence(docs, least_docs=8, top=6, leaves=leaves, tile=tile))
    assert got == brute(rows, 8, 6)


def test_no_term_is_kept(frame):
    rows = [("one two", "en", "a"), ("1 2", "en", "b"), (None, "en", "c"), ("one", "xx", "a")]
    docs = frame([(i, t, g, s, "x", 1, "b", 2) for i, (t, g, s) in enumerate(rows)], DOCS)
    got = rows_of(dv.divergence(docs))
    assert got == brute(rows, 30, 50) and {r[4] for r in got} == {0} and len(got) == 6


def test_odd_documents(odd_docs, no_docs):
    rows = [(r.text, r.lang, r.source) for r in odd_docs.collect()]
    assert rows_of(dv.divergence(odd_docs, least_docs=2, top=3)) == brute(rows, 2, 3)
    assert dv.divergence(no_docs).count() == 0


def test_equal_subtrees_are_one_node():
    counts = np.zeros((50, 1000), np.int64)
    counts[:, 3] = 1
    forest = dv.Forest(counts)
    assert len(set(forest.roots.tolist())) == 1 and max(map(len, forest.left)) <= 4
    assert forest.positions(7).tolist() == [3]


def test_shares_are_exact_beyond_64_bits():
    counts = np.array([-1, 0, 10**15 + 7])
    assert dv.share(counts, 10**16, 3).tolist() == [0, 1, 1 + 10**9 * (10**15 + 12) // (10**16 + 15)]


def test_prices_of_random_trees():
    draw = np.random.default_rng(3)
    counts = draw.integers(0, 4, (6, 37))
    forest = dv.Forest(counts)
    totals, kinds = np.unique(counts.sum(1), return_inverse=True)
    shares = np.stack([dv.share(forest.counts, int(t), 37) for t in totals])
    one, other = np.triu_indices(6, 1)
    got = forest.prices(shares, kinds, one, other)
    p = [[1 + 10**9 * (int(c) + 5) // (int(row.sum()) + 185) for c in row] for row in counts]
    assert got.tolist() == [sum(abs(x - y) for x, y in zip(p[a], p[b], strict=True)) for a, b in zip(one, other, strict=True)]
