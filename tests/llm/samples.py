"""Small fixtures shared by the tests of this package."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, component_id long"


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def frame(spark, rows, partitions=3):
    """(doc_id, text) rows with the other columns of documents and some whose names clash with results."""
    full = [(i, t, None, None, None, "x", 7) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions) if full else spark.createDataFrame([], SCHEMA)


def near_copies(seed=3, families=12, size=9):
    """Families of edited copies, exact copies, short and empty texts, a shared passage, repeated rows and missing ids."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(45)]
    texts = []
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 160))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 9))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                copy[rng.randrange(len(copy)):0] = passage
            texts.append((" " if rng.random() < 0.8 else "\n").join(copy))
        texts.append(texts[-1])
        texts.append(texts[-2].upper())
    texts += ["", None, "one", "one", "One", "two words", "  \t ", "a b " * 60, " ".join(passage), " ".join(passage * 2), "ünï çödé"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + [rows[0], rows[5]]
