import re

import pytest
from pyspark.sql import functions as F

from tablewarden.llm import chat, licences, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


TEXTS = [
    None, "", " \n ", "a b c a b c a b c", "x y z w x y z", "one two three four", "# $ | <>& * %", "l1\nl1\n\n \nl2\nl1", "ünï çödé \U0001f600 word\x0bnext\x0cpage\rend",
    "to be or not to be that is the question to be or not to be", "a a", "a a a", "a a a a", "p q r s p q t q r s",
]


def test_measures_against_plain_python(frame):
    rows = frame([(i, t) for i, t in enumerate(TEXTS)], "doc_id bigint, text string")
    text = F.coalesce("text", F.lit(""))
    got = rows.select("doc_id", *[c.alias(n) for n, c in quality.measures(text).items()]).orderBy("doc_id").collect()
    for r, t in zip(got, TEXTS, strict=True):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(t), t


def test_rates_are_drawn_to_the_pooled_rate(frame):
    rows = [(f"h{i}", 1000, 100 + 100 * (i % 2)) for i in range(10)] + [("tiny", 1, 1), (None, 2, 0)]
    got = {r.host: r.rate for r in quality.shrunk_rates(frame(rows, "host string, n bigint, failed bigint")).collect()}
    assert abs(got["h0"] - 0.1) < 0.01 and abs(got["h1"] - 0.2) < 0.01
    assert 0.14 < got["tiny"] < 0.3 and 0.1 < got[None] < 0.16
    alike = [(f"h{i}", 100, 10) for i in range(5)]
    assert {round(r.rate, 9) for r in quality.shrunk_rates(frame(alike, "host string, n bigint, failed bigint")).collect()} == {0.1}


def test_host_verdicts(frame):
    good = " ".join(f"word{i}" for i in range(80))
    marks = " ".join(f"w{i}#%$" for i in range(80))
    rows = [(i, good, "clean") for i in range(200)] + [(300, marks, "clean")]
    rows += [(400 + i, marks if i % 10 else good, "spam") for i in range(100)]
    rows += [(600 + i, marks if i % 4 == 0 else good, "mixed") for i in range(100)] + [(900, "few", "clean")]
    got = {r.row.doc_id: r for r in quality.judge(frame(rows, "doc_id bigint, text string, source string")).collect()}
    assert {got[0].host_verdict, got[400].host_verdict, got[600].host_verdict} == {"trusted", "rejected", "mixed"}
    assert got[300].kept and not got[400].kept and not got[600].kept and got[601].kept
    assert got[900].base_failed and not got[900].kept


def test_quality_of_odd_tables(odd_docs, no_docs):
    got = quality.judge(odd_docs)
    assert got.count() == odd_docs.count() and got.select("row.*").columns == odd_docs.columns
    assert quality.judge(no_docs).count() == 0
    assert got.where("kept IS NULL OR base_failed IS NULL").count() == 0


TURNS = "conv_id bigint, turn bigint, role string, text string, perspective string, chunk int"


def rebuilt(rows):
    """The text of each (dialogue, perspective), and its loss as text."""
    seen = {}
    for r in sorted(rows, key=lambda r: r.position):
        text, loss = seen.get((r.conv_id, r.perspective), ("", []))
        assert r.seg_start == len(text) and r.seg_end == len(text + r.segment)
        text += r.segment
        if r.loss_start is not None:
            loss = [*loss, text[r.loss_start : r.loss_end]]
        seen[r.conv_id, r.perspective] = (text, loss)
    return seen


def test_every_party_is_the_assistant_once(frame):
    rows = [(1, 0, "system", "rules"), (1, 1, "anna", "hi <|im_end|>"), (1, 2, "bob b", None), (1, 3, "anna", "bye"), (1, None, None, "late"),
            (2, 0, "system", "alone"), (None, 5, "x", "y"), (None, 5, "x", "y")]
    got = rebuilt(chat.rotate(frame([(*r, "p", 1) for r in rows], TURNS)).collect())
    assert set(got) == {(1, "anna"), (1, "bob b"), (1, "unknown"), (None, "x")}
    text, loss = got[1, "anna"]
    assert text == (
        "<|im_start|>system\nrules<|im_end|>\n<|im_start|>assistant\nhi <| im_end|><|im_end|>\n<|im_start|>user name=bob_b\n<|im_end|>\n"
        "<|im_start|>assistant\nbye<|im_end|>\n<|im_start|>user name=unknown\nlate<|im_end|>\n"
    )
    assert loss == ["hi <| im_end|><|im_end|>\n", "bye<|im_end|>\n"]
    assert got[1, "bob b"][1] == ["<|im_end|>\n"] and got[None, "x"][1] == ["y<|im_end|>\n"] * 2


def test_long_dialogues_and_none(frame):
    rows = [(1, i, "a" if i % 2 else "b", "t" * (i % 7), "p", 1) for i in range(2500)]
    got = rebuilt(chat.rotate(frame(rows, TURNS)).collect())
    assert len(got[1, "a"][1]) == 1250
    assert chat.rotate(frame([], TURNS)).count() == 0


FILES = "path string, text string, key string, licence string, folder string"


def test_nearest_licence_above(frame):
    mit = "Released under the MIT License."
    apache = "Licensed under the Apache License, Version 2.0."
    rows = [("LICENSE", mit), ("a/LICENSE.txt", apache), ("a/b/c/x.py", "code"), ("a/y.py", "# " + apache + "\ncode"), ("z.py", ""), ("q/w.py", None),
            (None, mit), (None, None), ("a/b/COPYING", "no known words at all"), ("a/y2.py", "code\n" * 50 + mit), ("dup", "x"), ("dup", "x")]
    got = [(r.path, r.licence, r.origin, r.licence_path) for r in licences.scan(frame([(*r, "k", "l", "f") for r in rows], FILES)).collect()]
    assert sorted(got, key=repr) == sorted([
        ("LICENSE", "mit", "file", "LICENSE"), ("a/LICENSE.txt", "apache-2.0", "file", "a/LICENSE.txt"),
        ("a/b/c/x.py", "apache-2.0", "inherited", "a/LICENSE.txt"), ("a/y.py", "apache-2.0", "header", "a/y.py"),
        ("z.py", "mit", "inherited", "LICENSE"), ("q/w.py", "mit", "inherited", "LICENSE"), (None, "mit", "header", None), (None, None, None, None),
        ("a/b/COPYING", "apache-2.0", "inherited", "a/LICENSE.txt"), ("a/y2.py", "mit", "header", "a/y2.py"),
        ("dup", "mit", "inherited", "LICENSE"), ("dup", "mit", "inherited", "LICENSE"),
    ], key=repr)


def test_statements_of_the_documents(frame):
    said = {
        "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0", "Released under the MIT License.": "mit",
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    }
    rows = [(f"d/{i}", "prose words\n" * 30 + line + "\nmore prose") for i, line in enumerate(said)]
    got = licences.scan(frame([(*r, "", "", "") for r in rows], FILES)).orderBy("path").collect()
    assert [r.licence for r in got] == list(said.values())


@pytest.mark.parametrize("columns", [["path"], None])
def test_no_files(frame, columns):
    assert licences.scan(frame([], FILES), carry=columns).count() == 0


def commented(text, mark="# "):
    return "".join(f"{mark}{line}".rstrip() + "\n" for line in text.splitlines())


def test_whole_texts_and_standard_headers(frame):
    known = licences.standards()
    assert {"apache-2.0", "bsd-3-clause", "gpl-3.0", "mit", "mpl-2.0"} <= set(known)
    rows, expected = [], {}
    for name, texts in known.items():
        for i, text in enumerate(texts):
            filled = text.replace("<year>", "2019").replace("[yyyy]", "2019").replace("<copyright holders>", "Anna Example")
            for path, body in ((f"{name}/{i}/LICENSE", filled), (f"h/{name}{i}.py", "#!/bin/sh\n" + commented(filled) + "\nimport os\n" + "x = 1\n" * 400)):
                rows.append((path, body))
                expected[path] = name
        rows.append((f"{name}/0/src/code.py", "code"))
        expected[f"{name}/0/src/code.py"] = name
    for said, name in (("MIT", "mit"), ("GPL-3.0-or-later", "gpl-3.0"), ("(Apache-2.0 OR MIT)", "apache-2.0"), ("No-Such-1.0", None)):
        rows.append((f"spdx/{said}.c", f"/* SPDX-License-Identifier: {said} */\nint x;"))
        expected[f"spdx/{said}.c"] = name
    found = licences.scan(frame([(*r, "k", "l", "f") for r in rows], FILES)).collect()
    assert {r.path: r.licence for r in found} == expected


def test_other_files_do_not_change_a_similarity(frame):
    header = ("h.py", commented(licences.standards()["gpl-3.0"][0]))
    others = [(f"o{i}", "the software license of a program is provided to any person\n" * (i + 1)) for i in range(30)]
    alone, among = (
        {r.path: r.similarity for r in licences.scan(frame([(*r, "k", "l", "f") for r in rows], FILES)).collect()}["h.py"]
        for rows in ([header], [header, *others])
    )
    assert alone == among


def test_one_id_in_two_sources(frame):
    mit = "Released under the MIT License."
    rows = [(1, mit, "en", "a"), (1, mit, "en", "b"), (1, mit, "de", "a"), (2, mit, "en", "a"), (2, mit, "de", "b"), (2, "prose", "en", "b")]
    found = licences.document_files(frame(rows, "doc_id bigint, text string, lang string, source string")).collect()
    assert sorted((r.doc_id, r.path) for r in found) == [
        (1, "a/LICENSE"), (1, "a/en/LICENSE"), (1, "b/LICENSE"), (2, "a/en/2"), (2, "b/de/LICENSE"), (2, "b/en/2"),
    ]
