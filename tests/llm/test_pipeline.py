import random

import corpus_pipeline as cp

from test_decontaminate import expected as contaminated  # noqa: E402
from test_near_duplicates import expected_components, expected_lines
from test_packing import pieces_of
from test_quality_chat_licences import counts


def brute_force(rows, items):
    """The kept documents of all stages but the last."""
    kept = []
    for doc, text in rows:
        n, chars, symbols, dup, repeated = counts(text)
        lines = sum(1 for x in text.split("\n") if x.strip())
        if not (n < 50 or 100 * repeated > 50 * n or 10 * symbols > chars or 10 * dup > 3 * lines or chars > 20 * n):
            kept.append((doc, text))
    left = [(d, t) for d, _, gone, t in expected_lines(kept) if not gone or t.strip()]
    first = [(d, t) for d, t in left if any(d == i == c for i, _, c in expected_components(left))]
    bad = {r[0] for r in contaminated(first, items) if r[5]}
    return [(d, t) for d, t in first if d not in bad]


def test_against_brute_force(spark, tmp_path):
    draw = random.Random(9)
    words = [f"word{i}" for i in range(900)]
    prose = [" ".join(draw.choices(words, k=70)) + "\n" + " ".join(draw.choices(words, k=40)) for _ in range(25)]
    items = [(f"i{k}", " ".join(draw.choices(words, k=20))) for k in range(3)]
    rows = list(enumerate(prose))
    rows += [(100, prose[3]), (101, prose[4].replace("word1", "word2", 1)), (102, prose[5] + "\n" + items[0][1]), (103, "too few"),
             (104, "# $ % " * 60), (105, "say it again " * 40), (106, prose[6][:-1]), (107, prose[7] + " " + items[1][1])]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame([(d, t, "en", f"s{d % 3}", len(t)) for d, t in rows], schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = docs
    for _, function in cp.STAGES[:-1]:
        stage = cp.settled(function(spark, stage, str(tmp_path)), "test-stage")
        assert stage.columns == docs.columns
    expected = brute_force(rows, items)
    got = [(r.doc_id, r.text) for r in stage.collect()]
    assert sorted(got) == sorted(expected)
    assert stage.where("n_chars != length(text)").count() == 0
    packed = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in cp.run(spark, str(tmp_path)).collect())
    assert packed == sorted((d, *p) for d, t in expected for p in pieces_of(t, 1024))


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd_docs, no_docs):
        for name, function in cp.STAGES[:-1]:
            out = function(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
        assert cp.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= docs.count()
