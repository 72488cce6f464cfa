import hashlib
import re

import pytest

from tablewarden.llm import decontaminate as dc

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def expected(docs, items, width=13):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(width, len(w))
        if w and item is not None:
            for i in range(len(w) - size + 1):
                windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                for item in windows.get(tuple(w[i : i + size]), ()):
                    hit |= set(range(i, i + size))
                    found.add(item)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


ITEMS = [
    ("long", " ".join(f"w{i}" for i in range(30))), ("short", "alpha Beta, gamma!"), ("one", "Zebra"), ("none", " ?!"), (None, "alpha beta"),
    ("again", "ALPHA beta gamma"), ("bare", None), ("repeat", "na " * 20), ("word7", "word7 word8 word9 word10 word11"),
]
DOCS = [
    (1, " ".join(f"w{i}" for i in range(5, 25)) + " and more"), (2, "so alpha beta gamma it is " + "x " * 500), (3, "a zebra"), (4, None), (5, ""),
    (6, "na " * 30), (None, "alpha beta gamma"), (7, "w1 w2 w3"), (8, "alpha beta" + " gamma" * 3), (2, "zebra zebra"), (9, "alpha\x00beta\x00gamma"),
]


@pytest.mark.parametrize("block_chars", [1 << 20, 40])
def test_against_brute_force(frame, block_chars):
    items = frame(ITEMS, "item_id string, text string")
    docs = frame(DOCS, "doc_id bigint, text string")
    got = dc.contamination(docs, items, block_chars=block_chars, carry=["doc_id"])
    got = got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted(map(tuple, got), key=repr) == expected(DOCS, ITEMS)


def test_odd_and_empty_tables(odd_docs, no_docs, frame):
    items = frame(ITEMS, "item_id string, text string")
    none = frame([], "item_id string, text string")
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    fields = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = dc.contamination(odd_docs, items)
    assert sorted(map(tuple, got.select(*fields).collect()), key=repr) == expected(rows, ITEMS)
    assert got.select("row.*").columns == odd_docs.columns
    assert sorted(map(tuple, dc.contamination(odd_docs, none).select(*fields).collect()), key=repr) == expected(rows, [])
    assert dc.contamination(no_docs, items).count() == 0
    assert dc.contamination(no_docs, none).count() == 0


def test_several_blocks_keep_repeated_rows(frame):
    docs = frame([(1, "zebra alpha"), (1, "zebra alpha"), (None, None)], "doc_id bigint, text string")
    items = frame(ITEMS, "item_id string, text string")
    assert dc.contamination(docs, items, block_chars=30).count() == 3


def test_repeated_and_very_long_items_are_bounded(frame):
    long = " ".join(f"Long{i}" for i in range(4000))
    items = frame([("long", long), ("tiny", "a b c")] + [("same", "x y z")] * 300, "item string, text string")
    cut = dc.pieces(items.selectExpr("item", "cast(text as binary) as text").distinct(), 13, 4000).collect()
    assert max(len(r.text) for r in cut) < 1500 and len(cut) > 20
    assert sum(r.item == "same" for r in cut) == 1
    windows = [set(zip(*[words(t)[k:] for k in range(13)])) for t in ([r.text.decode() for r in cut if r.item == "long"])]
    assert all(windows) and set().union(*windows) == set(zip(*[words(long)[k:] for k in range(13)]))
    docs = [(1, "long7 " + " ".join(f"long{i}" for i in range(990, 1040))), (2, "so x y z it is"), (3, "long3 long5")]
    got = dc.contamination(frame(docs, "doc_id bigint, text string"), items, item_col="item", block_chars=4000, carry=["doc_id"])
    got = got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted(map(tuple, got), key=repr) == expected(docs, [("long", long), ("tiny", "a b c"), ("same", "x y z")])
