import hashlib
from math import floor, inf, nan

import numpy as np
import pytest

from tablewarden.llm import codes


def lloyd(rows, parts=16, entries=64, rounds=2):
    """(codes, error) of each row and the codebooks, by plain loops over (id, vector) rows."""
    whole = [(i, [floor(256 * float(np.float32(x))) for x in v]) for i, v in rows]
    width = len(whole[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in whole]
    first = sorted(range(len(whole)), key=lambda k: (whole[k][0] is None, whole[k][0], whole[k][1]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for x in cut:
                held.setdefault(nearest(x[p], books[p])[1], []).append(x[p])
            books[p] = [[sum(c) // len(held[k]) for c in zip(*held[k], strict=True)] if k in held else e for k, e in enumerate(books[p])]
    found = [[nearest(x[p], books[p]) for p in range(parts)] for x in cut]
    return [([k for _, k in f], sum(d for d, _ in f)) for f in found], books


def vectors(seed, n, width, copies=0):
    draw = np.random.default_rng(seed)
    found = draw.normal(0, 0.2, (n, width)).astype(np.float32)
    found[: copies] = found[0]
    return found


SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, codes int, error string, v int, id int"


def rows_of(frame, found, ids=None):
    ids = ids if ids is not None else range(len(found))
    return frame([(i, [float(x) for x in v], k % 3, "r", 1, "e", 2, 3) for k, (i, v) in enumerate(zip(ids, found, strict=True))], SCHEMA)


def same(df, expected, books, **options):
    found, got = codes.compress(df, **options)
    key = lambda r: (r.row.vec_id is None, r.row.vec_id, tuple(r.row.embedding), tuple(r.codes))
    found = sorted(found.collect(), key=key)
    assert got.tolist() == books
    assert [(r.codes, r.error) for r in found] == expected


@pytest.mark.parametrize(("n", "width", "copies"), [(700, 32, 0), (700, 16, 300), (40, 64, 0), (1, 16, 0), (300, 16, 300)])
def test_equals_plain_loops(frame, monkeypatch, n, width, copies):
    monkeypatch.setattr(codes, "BLOCK", 256)
    points = vectors(n, n, width, copies)
    expected, books = lloyd(list(enumerate(points)))
    same(rows_of(frame, points), expected, books)


def test_repeated_and_missing_ids(frame):
    points = vectors(3, 120, 16)
    ids = [None if k % 7 == 0 else k // 3 for k in range(120)]
    order = sorted(range(120), key=lambda k: (ids[k] is None, ids[k] or 0, points[k].tolist()))
    expected, books = lloyd([((ids[k] is None, ids[k] or 0), points[k]) for k in order], entries=8)
    found, got = codes.compress(rows_of(frame, points, ids), entries=8)
    assert got.tolist() == books
    by = {tuple(r.row.embedding): (r.codes, r.error) for r in found.collect()}
    assert [by[tuple(float(x) for x in points[k])] for k in order] == expected


def test_unfit_vectors(frame):
    good = vectors(5, 30, 16)
    odd = [None, [None] * 16, [nan] * 16, [inf] * 16, [-inf, *[0.0] * 15], [], [1.0] * 8, [1e30] * 16, [1.0] * 32]
    rows = [(k, [float(x) for x in v], 1, "r", 1, "e", 2, 3) for k, v in enumerate(good)] + [(100 + k, v, None, None, None, None, None, None) for k, v in enumerate(odd)]
    found, books = codes.compress(frame(rows, SCHEMA))
    got = {r.row.vec_id: (r.codes, r.error) for r in found.collect()}
    expected, plain = lloyd(list(enumerate(good)))
    assert books.tolist() == plain
    assert got == dict(enumerate(expected)) | {k: (None, None) for k in (105, 106, 107, 108)}


def test_no_vectors(frame):
    for rows in ([], [(1, [1.0] * 5, 1, "r", 1, "e", 2, 3)]):
        found, books = codes.compress(frame(rows, SCHEMA))
        assert found.count() == len(rows) and books.size == 0


def test_large_numbers_stay_exact(frame):
    points = np.round(vectors(9, 200, 16) * 5e5).astype(np.float32)
    expected, books = lloyd(list(enumerate(points)))
    same(rows_of(frame, points), expected, books)


def test_balls_hold_their_points_and_sums():
    points = np.floor(256 * vectors(1, 900, 4, 50)).astype(np.int64)
    trees = codes.Trees(points, 1)
    assert sorted(trees.order.tolist()) == list(range(900)) and trees.first[-1] == 0 and trees.last[-1] == 900
    for k in range(len(trees.first)):
        own = points[trees.order[trees.first[k] : trees.last[k]]]
        assert (own.sum(0) == trees.sums[k]).all()
        assert np.sqrt(((own - trees.centre[k]) ** 2).sum(1)).max() <= trees.radius[k] * (1 + 1e-9)


def test_whole_balls_are_owned_without_their_points(monkeypatch):
    points = np.repeat(np.array([[0, 0], [1000, 1000]]), 400, axis=0) + np.tile(np.arange(20), 40)[:, None] % 5
    trees = codes.Trees(points, 1)
    monkeypatch.setattr(codes.Trees, "compare", lambda *_, **__: pytest.fail("a point was compared") if len(_[2]) else None)
    code, count, sums = trees.owned(np.array([[[0, 0], [1000, 1000]]]))
    assert count.tolist() == [[400, 400]] and sums[0].tolist() == [points[:400].sum(0).tolist(), points[400:].sum(0).tolist()]
    assert code[:, 0].tolist() == [0] * 400 + [1] * 400


def test_query_digest(spark, frame):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    expected, books = lloyd([(r.vec_id, r.embedding) for r in rows])
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    labels = {}
    for r, (_, error) in zip(rows, expected, strict=True):
        labels[r.label] = labels.get(r.label, 0) + error
    got = {r.vec_id: tuple(r)[1:] for r in codes.op12(spark, folder).collect()}
    sha = hashlib.sha256(text.encode()).hexdigest()
    assert got == {r.vec_id: ("".join(f"{k:02x}" for k in c), e, labels[r.label], sha) for r, (c, e) in zip(rows, expected, strict=True)}
