import pytest

from consult.llm.words import Words

EDGE = ("doc_id long, text string, lang string, source string, n_chars long, SHA string, kept string, lang_pred string, score string, held_id string, node string")


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, repeated rows, ties, and columns whose names the operators use too."""
    near = " ".join(f"word{i} of passage" for i in range(60))
    long = " ".join(f"w{i * 7 % 9973}x{i % 13}" for i in range(30_000))
    texts = {1: None, 2: "", 3: "same text here", 4: "same text here", 5: "SAME text here", 6: near, 7: near.replace("word30", "other"), 8: long, 9: "one two", 10: "!!! 123 ???",
             11: "released under the MIT License, see Apache License and the GNU General Public License", None: "same text here", 12: "x" + near}
    rows = [(i, t, None if i in (3, None) else "en", None, len(t) if t else None, "s", "k", "l", "c", "h", "n") for i, t in texts.items()]
    rows.append(rows[3])
    return spark.createDataFrame(rows, EDGE)


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)


def word_list(text):
    w = Words([(text or "").encode()])
    return [w.buf[a:b].decode().translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for a, b in zip(w.start, w.end, strict=True)]


def shingle_set(text):
    w = word_list(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
