"""Small tables for the tests."""

import random
import re

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, texts, sources=("a", "b", None)):
    """Rows of documents from texts; their ids are their places."""
    rows = [(i, t, "en", sources[i % len(sources)], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def prose(seed, count, vocabulary=4000):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}x" for _ in range(count))


def edited(text, changes, seed):
    pick, parts = random.Random(seed), text.split(" ")
    for _ in range(changes):
        parts[pick.randrange(len(parts))] = f"new{pick.randrange(10**6)}"
    return " ".join(parts)


#: Nulls, empty texts, white space only, one word, a repeated text and one without a space.
ODD = [None, "", " \n\t ", "one", "one", "x" * 50_000, "Ünï cödé ÀÉ"]
