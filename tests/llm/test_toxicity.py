import numpy as np
from pyspark.sql import functions as F

from tablewarden.llm import toxicity as tx
from tablewarden.llm.common import read

SMALL = tx.Settings(rows=600, steps=120)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    found = tx.op3(spark, folder).join(labels, "doc_id").where("held_out").select("toxic", "predicted", "score").toPandas()
    hit = (found.predicted == 1) & (found.toxic == 1)
    assert hit.sum() / (found.toxic == 1).sum() >= 0.7
    assert hit.sum() / (found.predicted == 1).sum() >= 0.9
    assert ((found.score >= 0.5) == (found.predicted == 1)).all() and found.score.between(0, 1).all()
    assert docs.count() == tx.op3(spark, folder).count()


def test_held_out_remainder(frame):
    rows = frame([(0,), (17,), (None,)], "doc_id bigint").select(tx.held_out(F.col("doc_id")).alias("h")).collect()
    import zlib

    assert [r.h for r in rows] == [zlib.crc32(b"0") % 5 == 0, zlib.crc32(b"17") % 5 == 0, False]


def test_labels_of_held_out_rows_change_nothing(spark, frame):
    folder = "/root/testdata/sf0.01"
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    may = ~tx.held_out(F.col("doc_id"))
    changed = labels.withColumn("toxic", F.when(tx.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (
        {r.row.doc_id: r.score for r in tx.score_toxicity(docs, x, may, settings=SMALL, carry=["doc_id"]).collect()}
        for x in (labels, changed)
    )
    assert one == two


def test_gradients_fit_a_planted_word():
    draw = np.random.default_rng(0)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(draw.choice(words, 40)) + (" vile" if k % 2 else "") for k in range(300)]
    model = tx.train([t.encode() for t in texts], np.arange(300) % 2, 0.5, SMALL)
    got = tx.scores(model, [b"w1 w2 vile w3", b"w1 w2 w3 w4", b"", None])
    assert got[0] >= 0.5 and (got[1:] < 0.5).all()


def test_scores_do_not_depend_on_the_batch():
    model = tx.train([b"good day", b"vile day"] * 40, np.array([0, 1] * 40), 0.5, SMALL)
    texts = [b"vile", b"", b"good day " * 30, "vile ünï".encode(), None]
    together = tx.scores(model, texts)
    assert np.allclose(together, [tx.scores(model, [t])[0] for t in texts], atol=1e-5)


def test_odd_and_empty_tables(odd_docs, no_docs, frame):
    labels = frame([(1, 1), (2, 0), (2, 0), (3, None), (None, 1), (7, 0), (9, 1)], "doc_id bigint, toxic int")
    none = frame([], "doc_id bigint, toxic int")
    for marks in (labels, none):
        got = tx.score_toxicity(odd_docs, marks, F.lit(True), settings=SMALL)
        assert got.count() == odd_docs.count() and got.where("score IS NULL OR score NOT BETWEEN 0 AND 1").count() == 0
        assert got.select("row.*").columns == odd_docs.columns
    assert tx.score_toxicity(no_docs, labels, F.lit(True), settings=SMALL).count() == 0


def test_thresholds_see_every_labelled_row_outside_of_the_fit(spark, frame, monkeypatch):
    """A language whose toxic rows are few in the fitted sample but many among the labels."""
    draw = np.random.default_rng(3)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(900):
        tongue = "le la les des et une du dans est" if i % 3 == 0 else "the of and to in is that for with"
        rows.append((i, f"{tongue} {' '.join(draw.choice(words, 20))}{' vile' if i % 2 else ''}", int(i % 2)))
    docs = frame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = frame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    seen = []
    inner = tx.calibrate
    monkeypatch.setattr(tx, "calibrate", lambda model, counts, totals, s: (seen.append((counts.copy(), totals.copy())), inner(model, counts, totals, s))[1])
    got = tx.score_toxicity(docs, labels, F.lit(True), settings=tx.Settings(rows=100, steps=60), carry=["doc_id"]).collect()
    counts, totals = seen[-1]
    assert counts.n.sum() == 900 - 80 and totals.n.sum() == 900
    assert totals[totals.language == tx.LANGUAGES.index("fr")].n.sum() == 300
    assert np.mean([(r.score >= 0.5) == bool(r.row.doc_id % 2) for r in got]) > 0.9


def test_labelled_texts_of_any_length_are_learned(frame):
    rows = [(i, ("good day " * 6000) + ("vile " if i % 2 else "fine ") + "good day", i % 2) for i in range(60)]
    assert min(len(r[1]) for r in rows) > 40_000
    docs, labels = frame([r[:2] for r in rows], "doc_id bigint, text string"), frame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    got = tx.score_toxicity(docs, labels, F.lit(True), settings=tx.Settings(rows=60, steps=40), carry=["doc_id"]).collect()
    assert all((r.score >= 0.5) == bool(r.row.doc_id % 2) for r in got)


def test_pieces_give_the_answers_of_the_whole(monkeypatch):
    draw = np.random.default_rng(1)
    texts = [" ".join(draw.choice([f"w{i}" for i in range(90)], n)).encode() for n in (1, 300, 0, 64, 65, 7)] + [b"x" * 50 + b" end"]
    model = tx.train(texts * 4, np.arange(28) % 2, 0.5, tx.Settings(steps=5))
    sample = tx.Sample()
    sample.add(texts)
    whole = tx.strongest(model, sample, np.arange(7), 3)
    monkeypatch.setattr(tx, "PIECE", 32)
    monkeypatch.setattr(tx, "BATCH_BYTES", 40)
    again = tx.Sample()
    again.add(texts)
    assert again.sizes == sample.sizes
    for (a, p), (b, q) in zip(whole, tx.strongest(model, again, np.arange(7), 3), strict=True):
        assert np.allclose(a, b, atol=1e-5) and (p == q).mean() > 0.99
