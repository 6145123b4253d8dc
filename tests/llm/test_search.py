"""Ranked search against a plain count of terms."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from frames import LOWER, ODD, documents
from topicwright.llm import search as s
from topicwright.llm.text_arrays import texts_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(rows, queries, top=10):
    held = [(i, Counter(terms(t))) for i, t in rows if terms(t)]
    number, length = len(held), sum(sum(c.values()) for _, c in held)
    holding = Counter(t for _, c in held for t in c)
    found = []
    for item, text in sorted(set(queries), key=repr):
        scored = []
        for doc_id, count in held:
            m = 25 + (75 * sum(count.values()) * number) // length
            score = 0
            for term in terms(text):
                if tf := count.get(term):
                    w = math.floor(1000 * math.log((2 * number + 2) / (2 * holding[term] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        found += [(item, r + 1, doc_id, -x) for r, (x, _, doc_id) in enumerate(scored[:top])]
    return found


def ranked(frame):
    return sorted(map(tuple, frame.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(seed, count):
    pick, rows = random.Random(seed), []
    for i in range(count):
        size = pick.choice([1, 5, 40, 40, 300])
        rows.append((i, " ".join(f"T{min(pick.randrange(900), pick.randrange(900))}," for _ in range(size))))
    return rows


@pytest.mark.parametrize("block_bytes,group_terms", [(1 << 20, 4096), (8000, 20)])
def test_search_ranks_as_a_plain_count_does(spark, monkeypatch, block_bytes, group_terms):
    monkeypatch.setattr(s, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(s, "GROUP_TERMS", group_terms)
    rows = corpus(1, 400)
    rows += [(1000 + i, rows[7][1]) for i in range(60)] + [(i, t) for i, t in zip(range(2000, 2007), ODD)]
    rows += [(None, rows[7][1]), (3, rows[7][1]), (3, rows[7][1]), (None, None), (4000, "t1 " * 30_000)]
    queries = [(i, rows[i][1]) for i in range(0, 12)] + [(5, rows[5][1]), (7, "t1 t1 t2"), (None, "t3 t4"), (90, None), (91, "?!"), (92, "nowhere")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, item_id string, score int").repartition(5)
    asked = spark.createDataFrame(queries, "item_id bigint, text string")
    assert ranked(s.search(frame, asked)) == sorted(plain_search(rows, queries), key=repr)


def test_empty_tables(spark):
    docs, asked = documents(spark, ODD), spark.createDataFrame([(1, "one")], "item_id bigint, text string")
    assert s.search(docs.limit(0), asked).collect() == []
    assert s.search(docs, asked.limit(0)).collect() == []
    assert len(s.search(docs, asked).collect()) == 2


def test_a_sketch_bounds_every_impact_from_above():
    texts = ["a " * k + " ".join(f"b{i}" for i in range(k)) for k in (1, 3, 170, 5000)]
    hashes, times, begins, n = s.counted_terms(texts_of(pa.array(texts)))
    cells, offsets = s.sketches(hashes, times, begins)
    for d in range(len(texts)):
        own = slice(begins[d], begins[d + 1])
        size = offsets[d + 1] - offsets[d]
        least = np.min([cells[offsets[d] + (s._cells(hashes[own], k) & np.uint64(size - 1)).astype(np.int64)] for k in range(s.HASHES)], axis=0)
        assert (s.CODES[least] >= times[own]).all()
        assert size >= s.CELLS * (begins[d + 1] - begins[d])


def test_bounds_are_near_the_scores():
    """A bound is never too low, and few terms that a document lacks seem to be there."""
    rows = corpus(3, 600)
    hashes, times, begins, n = s.counted_terms(texts_of(pa.array([t for _, t in rows])))
    cells, offsets = s.sketches(hashes, times, begins)
    queries = s.Queries.of([(0, rows[3][1]), (1, rows[4][1])])
    vocabulary = queries.vocabulary.tolist()
    group = s.grouped(queries, dict.fromkeys(vocabulary, 1000))[0]
    norm = s.length_norm(n, len(rows), int(n.sum()))
    lacking = seeming = 0
    for d in range(0, 600, 20):
        own = cells[offsets[d] : offsets[d + 1]]
        impacts = s.impact(s.CODES[None, :], norm[d : d + 1, None]).astype(float)
        bounds = group.bounds(own[None, :], impacts)[0]
        held = dict(zip(hashes[begins[d] : begins[d + 1]].tolist(), times[begins[d] : begins[d + 1]].tolist()))
        for q in range(2):
            asked = zip(queries.terms[q].tolist(), queries.times[q].tolist())
            assert sum(1000 * k * int(s.impact(held[t], norm[d])) for t, k in asked if t in held) <= bounds[q]
        places = [(s._cells(group.terms, k) & np.uint64(len(own) - 1)).astype(np.int64) for k in range(s.HASHES)]
        there = np.min([own[p] for p in places], axis=0) > 0
        missing = np.array([t not in held for t in group.terms.tolist()])
        lacking, seeming = lacking + int(missing.sum()), seeming + int((there & missing).sum())
    assert seeming < 0.15 * lacking
