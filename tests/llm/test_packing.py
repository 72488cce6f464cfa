import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tablewarden.llm import packing
from tablewarden.llm.common import read

VOCABULARY = packing.vocabulary()


def used(plan):
    """Sequences with their (offset, length) slots; ranks of a length must be used once each."""
    ranks, sequences = Counter(), {}
    for size, first, n, sequence, offset in plan.rows:
        assert first == ranks[size]
        ranks[size] += n
        for k in range(n):
            sequences.setdefault(sequence + k, []).append((offset, size))
    return ranks, sequences


def best_by_search(sizes, capacity):
    """The fewest sequences for a few pieces."""
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(rooms)
            return
        for i in sorted({r: i for i, r in enumerate(rooms)}.values()):
            if rooms[i] >= sizes[k]:
                place(k + 1, [*rooms[:i], rooms[i] - sizes[k], *rooms[i + 1 :]])
        place(k + 1, [*rooms, capacity - sizes[k]])

    place(0, [])
    return best[0]


def test_plans_are_gapless_and_whole():
    draw = random.Random(2)
    for _ in range(200):
        capacity = draw.choice([10, 30, 100])
        counts = Counter(draw.choices(range(1, capacity + 1), k=draw.randint(0, 60)))
        plan = packing.plan(dict(counts), capacity)
        ranks, sequences = used(plan)
        assert ranks == counts and sorted(sequences) == list(range(plan.sequences))
        for slots in sequences.values():
            end = 0
            for offset, size in sorted(slots):
                assert offset == end
                end += size
            assert end <= capacity


def test_reduction_keeps_the_best_packing():
    """What dominance fixes must be part of some best packing."""
    draw = random.Random(4)
    for _ in range(120):
        counts = Counter(draw.choices(range(2, 21), k=draw.randint(1, 9)))
        plan = packing.Plan(dict(counts), 20)
        plan.reduce()
        left = [s for s, n in plan.left.items() for _ in range(n)]
        assert plan.sequences + best_by_search(left, 20) == best_by_search(list(counts.elements()), 20)


def test_many_pieces_stay_near_the_lower_bound():
    draw = np.random.default_rng(1)
    counts = Counter(np.clip(draw.lognormal(5.5, 1, 50_000).astype(int), 1, 1024).tolist())
    plan = packing.plan(dict(counts), 1024)
    assert plan.sequences <= 1.002 * sum(s * n for s, n in counts.items()) / 1024 + 1


TEXTS = [
    "plain words, with marks; and it's\n\nlines\nhere", "  two  blanks \t tabs \n", "", "   ", " x", "<|endoftext|> hi<|endoftext|>",
    "ünï çödé \U0001f600  non-breaking　wide", "1234 5.6e7 a_b __ 'tis 's", "a" * 300, "\x00 nul", "tab\tx y\r\nz",
]


def test_ids_are_those_of_the_tokenizer(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_str(VOCABULARY)
    texts = TEXTS + [r.text for r in read(spark, "/root/testdata/sf0.001", "documents").collect()]
    ids, edges = packing.Encoder(VOCABULARY).ids([t.encode() for t in texts])
    got = [ids[a:b].tolist() for a, b in zip(edges, edges[1:], strict=False)]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_vocabularies_encode_whole_texts():
    from tokenizers import Tokenizer

    other = packing.vocabulary("word_bpe_49k.json")
    texts = ["Some Words, 12 and more words.", "", "x y", "ünï çödé"]
    ids, edges = packing.Encoder(other).ids([t.encode() for t in texts])
    plain = Tokenizer.from_str(other)
    assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:], strict=False)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_the_cache_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 40_000)
    encoder = packing.Encoder(VOCABULARY)
    for k in range(30):
        texts = [f"w{k}x{i} z{i * k}" for i in range(40)] + ["漢字" * 1000 + str(k)]
        encoder.ids([t.encode() for t in texts])
        held = sum(len(w) + len(x) + packing.ENTRY for w, x in encoder.known.items())
        assert held == encoder.held <= packing.CACHE and max(map(len, encoder.known)) <= packing.SHORT


def pieces_of(text, capacity):
    from tokenizers import Tokenizer

    ids = np.array([*Tokenizer.from_str(VOCABULARY).encode(text or "", add_special_tokens=False).ids, 2], "<u4")
    stop, start, out = (len(ids) - 1) % capacity + 1, 0, []
    while start < len(ids):
        out.append((len(out), start, stop - start, zlib.crc32(ids[start:stop].tobytes())))
        start, stop = stop, stop + capacity
    return out


@pytest.mark.parametrize("capacity", [1024, 16])
def test_pieces_and_places(odd_docs, capacity):
    got = packing.pack(odd_docs, VOCABULARY, capacity=capacity).collect()
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    expected = sorted(((i, *p) for i, t in rows for p in pieces_of(t, capacity)), key=repr)
    assert sorted(((r.row.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == expected
    slots = {}
    for r in got:
        slots.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in slots.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(slots) >= sum(r.length for r in got) / capacity


def test_no_documents(no_docs):
    assert packing.pack(no_docs, VOCABULARY).count() == 0


def test_a_worker_encodes_on_its_own_core(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    packing.encoder.cache_clear()
    packing.encoder(VOCABULARY, packing.CACHE)
    assert packing.os.environ["TOKENIZERS_PARALLELISM"] == "false"
    packing.encoder.cache_clear()


def test_borders_by_class_bits():
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"  \n\naZ.,<|>0\t\x80\xc3\xe2", np.uint8)
    for size in [1, 2, 3, *rng.integers(4, 80, 200)]:
        data = rng.choice(letters, size)
        offsets = np.unique([0, *rng.integers(0, size, 2), size])
        expected = set(offsets.tolist())
        for i in range(1, size):
            if i + 1 < size and data[i] == 0x20 and packing.SOLID[data[i + 1]]:
                expected.add(i)
            if packing.LETTER[data[i - 1]] and packing.MARK[data[i]]:
                expected.add(i)
            if i + 1 < size and data[i] == 0x0A and packing.PLAIN[data[i - 1]] and packing.PLAIN[data[i + 1]]:
                expected |= {i, i + 1}
        assert packing.borders(data, offsets).tolist() == sorted(expected)
