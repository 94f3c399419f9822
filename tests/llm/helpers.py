"""Fixtures and brute-force versions shared by the operator tests."""

import re

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"long{i % 977}x{i % 31}" for i in range(30_000))

# null and empty texts, blanks only, a null id, one long text, repeated rows, ties
EDGE = [(1, None), (2, ""), (3, " \n\t "), (None, "a text without an id but with some words in it"), (4, LONG),
        (5, "same words here again and again\nsame words here again and again"),
        (6, "same words here again and again\nsame words here again and again"), (6, "same words here again and again\nsame words here again and again"),
        (7, "Ünïcödé ▁ <s> \U0001f600 中文字 \x00 ~ <0x41>"), (8, "x")]


def edge(spark, extra=False):
    """The edge rows; ``extra`` adds columns whose names clash with the operators' own."""
    if not extra:
        return spark.createDataFrame(EDGE, "doc_id long, text string")
    names = ["n", "w_", "t", "row_", "score", "word", "ids", "n_words", "lines__", "held_out", "found", "token", "k1", "label"]
    return spark.createDataFrame([(*r, *(["z"] * len(names))) for r in EDGE],
                                 "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))


def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def words(text):
    return SPACE_WORDS.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


class Groups(dict):
    def root(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)
