import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, block int, id string, key string, gone string"


@pytest.fixture
def odd_docs(frame):
    """NULLs in every column, empty and very long texts, ties, repeated rows, and columns named like inner ones."""
    long = " ".join(f"word{i % 4000}" for i in range(30_000))
    line = "One line that several of the documents have in common, word by word."
    near = "One line that several of the documents have in commOn, word by word."
    texts = [
        (1, f"{line}\nA line of its own for the first of the documents here.\n"), (2, f"{near}\nshort"), (2, f"{near}\nshort"),
        (3, line), (3, line), (4, None), (5, ""), (6, " \t\n\x0b "), (7, long), (8, long + " tail"), (None, line), (None, None),
        (9, "a a a a a a a a a a a a a a a a a a a a"), (10, "ünï çödé \U0001f600 " * 40), (3, "another text under the same id"),
    ]
    rows = [(i, t, None if i == 4 else "en", None if i in (2, None) else f"src{(i or 0) % 2}", None if t is None else len(t), "r", 1, "x", "k", "g") for i, t in texts]
    return frame(rows, DOCS)


@pytest.fixture
def no_docs(frame):
    return frame([], DOCS)
