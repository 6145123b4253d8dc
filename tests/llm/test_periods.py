"""Periodic runs against a comparison of all words with all others."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from frames import ODD, documents
from topicwright.llm import runs as r
from topicwright.llm.queries import QUERIES, with_repeats
from topicwright.llm.text_arrays import mix


def split(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def plain_runs(words):
    """(start, length, period) of all runs: each stretch with the smallest of its periods."""
    found = {}
    for period in range(1, len(words) // 4 + 1):
        start = 0
        while start + period < len(words):
            end = start
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end > start and end + period - start >= max(6, 4 * period):
                found.setdefault((start, end + period), period)
            start = end + 1
    return sorted((start, end - start, period) for (start, end), period in found.items())


def plain_collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repeated(doc_id, text):
    words = split(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def planted(pick, size, letters, times):
    words = [pick.randrange(letters) for _ in range(size)]
    for _ in range(times if size else 0):
        a = pick.randrange(size)
        b, p = pick.randrange(a, size + 1), pick.randrange(1, max(2, (size - a) // 3 + 1))
        words[a:b] = [words[a + (i - a) % p] for i in range(a, b)]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_words(seed):
    pick = random.Random(seed)
    for _ in range(120):
        texts = [planted(pick, pick.choice([0, 1, 5, 40, 250]), pick.choice([1, 2, 3, 60]), pick.randrange(4)) for _ in range(4)]
        hashes = mix(np.array([w + 1 for t in texts for w in t], np.uint64))
        expected, base = [], 0
        for words in texts:
            expected += [(base + s, base + s + n, p) for s, n, p in plain_runs(words)]
            base += len(words)
        assert [tuple(x) for x in r.find_runs(hashes, np.array([len(t) for t in texts])).tolist()] == expected


def test_nested_runs_and_fibonacci_words():
    a, b = [1], [1, 2]
    while len(b) < 900:
        a, b = b, b + a
    nested = ([7] * 9 + [8]) * 7 + [9]
    for words in (b, nested * 5, [1] * 3000, ([1] * 50 + [2]) * 8 + [1] * 51):
        hashes = mix(np.array(words, np.uint64))
        found = [(s, e - s, p) for s, e, p in r.find_runs(hashes, np.array([len(words)])).tolist()]
        assert found == plain_runs(words)


def test_places_depend_on_the_next_words_alone():
    pick = random.Random(9)
    piece = [pick.randrange(4) for _ in range(200)]
    made = [[pick.randrange(4) for _ in range(k)] + piece for k in (60, 131)]
    for scale in (4, 8, 16):
        sets = []
        for words in made:
            whole = r._Words(mix(np.array(words, np.uint64) + np.uint64(1)), np.zeros(len(words), int), np.full(len(words), len(words)))
            known = np.concatenate([r._regions_of(whole, p) for p in range(1, scale // 4 + 1)])
            places = r.synchronising_set(whole, scale, known) - (len(words) - 200)
            sets.append(set(places[places >= 0].tolist()))
        assert sets[0] == sets[1] and sets[0]
        gaps = np.diff(sorted(sets[0]))
        assert gaps.max() <= scale


def test_a_long_text_is_fast(spark):
    words = [f"w{i % 9973}" for i in range(120_000)]
    words[30_000:60_000] = [words[30_000 + i % 7000] for i in range(30_000)]
    rows = r.periodic_runs(documents(spark, [" ".join(words)])).collect()
    assert sorted((x.start, x.length, x.period) for x in rows[0].runs)[:1] == plain_long(words)
    assert len(rows[0].collapsed.split()) < 120_000


def plain_long(words):
    period, start, end = 7000, 30_000, 60_000
    while start and words[start - 1] == words[start - 1 + period]:
        start -= 1
    while end < len(words) and words[end] == words[end - period]:
        end += 1
    return [(start, end - start, period)]


def test_texts_of_all_kinds(spark):
    pick = random.Random(4)
    texts = [*ODD, "a  b\tA b\na b a b", "x x x x x x", "x x x x x", "é é é é é é\n\n.", " lead a a a a a a a tail "]
    texts += [" ".join(f"w{w}" for w in planted(pick, 120, 3, 2)) for _ in range(20)]
    frame = documents(spark, texts).selectExpr("doc_id", "text", "lang as runs", "source as collapsed", "1 as start")
    found = {x.doc_id: x for x in r.periodic_runs(frame).collect()}
    for i, text in enumerate(texts):
        expected = plain_runs(split(text))
        assert [tuple(x) for x in found[i].runs] == expected
        assert found[i].collapsed == plain_collapsed(split(text), expected)
    assert r.periodic_runs(frame.limit(0)).collect() == []


def test_repeated_words_and_nulls(spark):
    texts = [f"{i} b c d e f g h i j k l m n o p" for i in range(200)] + ODD
    rows = documents(spark, texts).union(documents(spark, ["q q q q q q"]).selectExpr("null", "text", "lang", "source", "n_chars"))
    for row in with_repeats(rows).collect():
        given = texts[row.doc_id] if row.doc_id is not None else "q q q q q q"
        assert split(row.text) == repeated(row.doc_id, given)


def test_query_against_plain_runs(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = {x.doc_id: x for x in QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    source = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(source)
    for doc_id, text in source:
        words = repeated(doc_id, text)
        expected, got = plain_runs(words), rows[doc_id]
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in expected)
        assert got.n_runs == len(expected)
        assert got.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert got.collapsed_sha256 == hashlib.sha256(plain_collapsed(words, expected).encode()).hexdigest()
        best = None
        for run in expected:
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        if best is None:
            assert (got.start, got.length, got.period, got.exponent_milli) == (None,) * 4
        else:
            assert (got.start, got.length, got.period, got.exponent_milli) == (*best, 1000 * best[1] // best[2])
