from __future__ import annotations

import random
import re

BLANK = r"[^\x20\x09-\x0D]+"


def words(text):
    return re.findall(BLANK, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def prose(seed, n, pool=4000):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(pool)}" for _ in range(n))


def edited(text, seed, share):
    """The text with a share of its words replaced."""
    rnd = random.Random(seed)
    return " ".join(w if rnd.random() >= share else f"x{rnd.randrange(10**6)}" for w in text.split())


#: Texts every operator has to take: nothing, blanks, one word, line ends, control characters, a very long one.
ODD = [None, "", "  \t\n ", "a", "\n\n", "a\x00b \x1c c", "é" * 70, "ab " * 20_000, "z" * 40_000]
