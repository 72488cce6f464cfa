from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tablewarden.llm import lines, simhash
from tablewarden.llm.common import read
from tablewarden.llm.components import components


def expected_print(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected_components(rows, distance=4):
    prints = [expected_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= distance:
            root[find(j)] = find(i)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, f"{prints[i]:016x}", min(ids, default=None)))
    return sorted(out, key=repr)


def found(docs, **options):
    got = simhash.near_duplicates(docs, **options).select(
        "doc_id", simhash.hexadecimal(F.col("print")).alias("p"), "component_id"
    )
    return sorted((tuple(r) for r in got.collect()), key=repr)


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_smallest_table(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    assert found(docs) == expected_components(pairs(docs))
    assert sorted(map(tuple, simhash.op4(spark, "/root/testdata/sf0.001").collect()), key=repr) == expected_components(pairs(docs))


def test_odd_documents(odd_docs, no_docs):
    assert found(odd_docs) == expected_components(pairs(odd_docs))
    assert found(no_docs) == []
    carried = simhash.near_duplicates(odd_docs, carry=odd_docs.columns)
    assert carried.select("row.*").columns == odd_docs.columns and carried.count() == odd_docs.count()


def linked(spark, prints, **options):
    frame = spark.createDataFrame([(int(x),) for x in prints], "print bigint")
    got = components(simhash.links(frame, 4, **options)).collect()
    return {r.node: r.root for r in got}


def expected_links(prints):
    root = {x: x for x in prints}
    changed = True
    while changed:
        changed = False
        for a, b in combinations(prints, 2):
            if (int(a) ^ int(b)) & (2**64 - 1) and ((int(a) ^ int(b)) & (2**64 - 1)).bit_count() <= 4 and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return {x: r for x, r in root.items()}


def test_links_of_dense_and_crowded_lists(spark):
    draw = np.random.default_rng(5)
    centre = draw.integers(-(2**63), 2**63 - 1, 3)
    prints = set()
    for c in centre.tolist():
        for _ in range(25):
            x = c
            for bit in draw.choice(64, draw.integers(0, 6), replace=False).tolist():
                x ^= (1 << bit) if bit < 63 else -(1 << 63)
            prints.add(x)
    prints = sorted(prints)
    expected = expected_links(prints)
    for crowd in (4096, 3):
        got = linked(spark, prints, crowd=crowd)
        assert {x: got.get(x, x) for x in prints} == expected


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(40)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def distance_within(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected_lines(rows, min_chars=lines.MIN_CHARS):
    """Kept lines of each row by comparing every line with every earlier one."""
    places = []
    for doc, text in rows:
        for at, raw in enumerate(text.split("\n") if text is not None else []):
            line = raw.strip(" \t\x0b\x0c\r")
            if line:
                places.append(((doc is None, doc or 0, at), line))
    first = {}
    for place, line in places:
        first[line] = min(place, first.get(line, place))
    out = []
    for doc, text in rows:
        if text is None:
            out.append((doc, 0, 0, None))
            continue
        kept, raws = [], text.split("\n")
        for at, raw in enumerate(raws):
            line, place = raw.strip(" \t\x0b\x0c\r"), (doc is None, doc or 0, at)
            near = [p for x, p in first.items() if len(x) >= min_chars <= len(line) and x != line and distance_within(line, x)]
            early = line and (first[line] < place or any(p < first[line] for p in near))
            if not early:
                kept.append(raw)
        out.append((doc, len(raws), len(raws) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def lines_found(docs, **options):
    found = lines.dedup_lines(docs, **options).collect()
    return sorted(((r.row.doc_id, r.n_lines, r.n_removed, r.text) for r in found), key=repr)


def test_lines_of_odd_documents(odd_docs, no_docs, frame):
    # Rows under one id but with unlike texts are ordered by line and content; the brute force knows ids only.
    docs = odd_docs.where("text IS NULL OR text NOT LIKE 'another%'")
    assert lines_found(docs) == expected_lines(pairs(docs))
    assert lines_found(no_docs) == []


def test_lines_within_one_edit(frame):
    base = "the quick brown fox jumps over the lazy dog and then it runs far away from here"
    edits = [base, base[:-1], base[1:], base + "!", "X" + base, base[:40] + "#" + base[41:], base[:40] + base[41:], base[:30] + "zz" + base[30:],
             base[:20] + "Q" + base[21:60] + "W" + base[61:], "short line", "short line", "x" * 20, "x" * 21, "x" * 23]
    rows = [(i, text + "\nline number with its own words " + str(i) * 5) for i, text in enumerate(edits)]
    docs = frame(rows, "doc_id bigint, text string")
    assert lines_found(docs) == expected_lines(rows)


def test_short_lines_go_for_equal_lines(frame):
    rows = [(1, "Read more\n\nfirst text"), (2, "Read more\n \nsecond text\n}"), (3, "Read mare\n  Read more\n}\n}"), (4, "")]
    docs = frame(rows, "doc_id bigint, text string")
    assert lines_found(docs) == expected_lines(rows)
    assert [x[2] for x in lines_found(docs)] == [0, 1, 3, 0]
    assert lines_found(docs, min_chars=4) == expected_lines(rows, 4)
    assert [x[2] for x in lines_found(docs, min_chars=4)] == [0, 1, 4, 0]


def test_order_of_lines_for_any_ids(frame):
    """The first line of the smallest id stays: negative and largest ids, NULL ids last, ids of text, repeated ids."""
    line = "one line that stands in every document"
    rows = [(x, line) for x in (2**63 - 1, 0, None, -5, -(2**63), None, 7)]
    assert {x[0]: x[2] for x in lines_found(frame(rows, "doc_id bigint, text string"))}[-(2**63)] == 0
    assert sum(x[2] for x in lines_found(frame(rows, "doc_id bigint, text string"))) == 6
    late = lines_found(frame([(None, "a\n" + line), (None, line + "\nb")], "doc_id bigint, text string"))
    assert late == [(None, 2, 0, line + "\nb"), (None, 2, 1, "a")]
    named = lines_found(frame([("b", line), ("a", line), (None, line)], "doc_id string, text string"))
    assert sorted((str(x[0]), x[2]) for x in named) == [("None", 1), ("a", 0), ("b", 1)]
    again = lines_found(frame([(3, line), (3, line), (3, line + "\nand one of its own")], "doc_id int, text string"))
    assert sum(x[1] - x[2] for x in again) in (2, 3)  # by content, all equal rows alike


def test_minima_of_lines_are_hash_aggregates(frame, capsys):
    docs = frame([(1, "a line")], "doc_id bigint, text string")
    own = docs.select(F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash")).alias("doc"), "text")
    rows = lines.lines_of(own)
    rows.groupBy("digest").agg(F.min("place"), F.first(F.length("line"))).explain()
    assert "SortAggregate" not in capsys.readouterr().out


def test_odd_distances_in_crowded_lists(spark):
    draw = np.random.default_rng(6)
    prints = set()
    for c in draw.integers(-(2**62), 2**62, 3).tolist():
        for _ in range(20):
            x = c
            for bit in draw.choice(60, draw.integers(0, 5), replace=False).tolist():
                x ^= 1 << bit
            prints.add(x)
    frame = spark.createDataFrame([(x,) for x in sorted(prints)], "print bigint")
    for distance in (1, 3):
        found = {}
        for crowd in (4096, 2):
            rows = simhash.links(frame, distance, crowd=crowd).collect()
            assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= distance for r in rows)
            linked = spark.createDataFrame(rows, "a bigint, b bigint")
            found[crowd] = {r.node: r.root for r in components(linked).collect()}
        assert found[4096] and found[2] == found[4096]
