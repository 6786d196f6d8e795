"""Small inputs and brute-force twins shared by the operator tests."""

from __future__ import annotations

import random
import re

SPACE = "\x20\x09-\x0D"


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    words = ["the", "Of", "and", "éau", "straße", "ont", "ING", "ciónue", "x1", "9", "日本", "wh."]
    return "".join(r.choice(words) + str(r.randrange(400)) + r.choice([" ", " ", " ", "\n", "  ", ", "]) for _ in range(n))


def edge_documents() -> list[tuple]:
    """(doc_id, text): nulls, blanks, ties, repeats, a very long text, control characters, no letters."""
    base = prose(1, 120)
    long = prose(2, 9000) + "\n" + "x" * 30000
    near = base.split(" ")
    near[3] = "changed"
    return [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n \x0b\x0c\r"),
        (7, long), (8, long + " tail"), (9, "one two three"), (10, "ONE two  three"), (11, "one two three four five"),
        (12, "\0 a\0b \x1c \x1f c"), (13, "### <|endoftext|> </turn> \\ \\n"), (14, "ÉCOLE école"),
        (15, "shared line\n" * 12 + "mine"), (16, "  Shared Line \nother"), (None, base), (None, "no id at all"),
        (18, "same row"), (18, "same row"), (19, "same id, one text"), (19, "same id, another text"),
        *[(100 + k, f"header line\n{prose(50 + k, 30)}\nFooter  \n\n") for k in range(11)],
    ]


def words(text: str | None) -> list[str]:
    return re.findall(f"[^{SPACE}]+", text or "")


def with_extras(df):
    """The same rows with columns whose names an operator may use inside or in its result."""
    from pyspark.sql import functions as F
    names = ("n", "key", "doc", "mark", "items", "rule", "kept", "n_words", "n_hit", "h1", "h2", "line", "token", "cid",
             "n_lines", "n_dropped", "label", "root", "words", "host", "path", "verdict", "ids", "base_failed")
    return df.withColumns({c: F.lit("extra") for c in names})


DOCS = "doc_id long, text string"
