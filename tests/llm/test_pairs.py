"""Exact dedup, the Jaccard join, line dedup and decontamination against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from frames import DOCUMENTS, LOWER, ODD, documents, edited, prose, words
from pyspark.sql import functions as F

from topicwright.llm import decontaminate, digest_dedup, edit_join, jaccard_join, line_dedup
from topicwright.llm.edits import within
from topicwright.llm.text_arrays import Texts


def groups_of(nodes, links):
    parent = {x: x for x in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        parent[high] = low
    return {x: top(x) for x in nodes}


def shingles(text, length=5):
    w = words(text)
    return {tuple(w[i : i + length]) for i in range(len(w) - length + 1)} or ({tuple(w)} if w else set())


def family():
    """Copies, chains of edits, a passage in many texts, short texts and odd ones."""
    texts = list(ODD)
    for i in range(12):
        base = prose(i, 60 + 20 * i)
        texts += [base, base.upper(), edited(base, 1, i), edited(base, 2, i + 50), edited(base, 6, i + 100)]
    chain = prose(99, 200)
    for i in range(15):
        chain = edited(chain, 2, i)
        texts.append(chain)
    hub = prose(77, 120)
    texts += [edited(hub, 2, i) for i in range(80)]
    passage = prose(1234, 60)
    texts += [f"{passage} {prose(500 + i, 15 + i)}" for i in range(40)]
    texts += ["a b c", "A B C", "a b c d", "a b c d e f", "a b c d e f g"]
    random.Random(5).shuffle(texts)
    return texts


@pytest.mark.parametrize("frequent", [2, 8, 10**6])
def test_jaccard_components_match_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    texts = family()
    sets = [shingles(t) for t in texts]
    links = []
    for i, x in enumerate(sets):
        for j in range(i):
            common = len(x & sets[j])
            if common and 100 * common >= 80 * (len(x) + len(sets[j]) - common):
                links.append((j, i))
    wanted = groups_of(range(len(texts)), links)
    frame = documents(spark, texts).withColumn("component", F.lit("clash")).withColumn("n", F.lit(1))
    found = jaccard_join.jaccard_components(frame).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {i: (len(sets[i]), wanted[i]) for i in range(len(texts))}
    assert len(set(wanted.values())) < len(texts) - 80
    kept = jaccard_join.without_near_copies(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(wanted.values()))


def test_jaccard_of_null_ids_repeated_rows_and_no_rows(spark):
    text = prose(1, 50)
    frame = spark.createDataFrame([(None, text, "en", "a", 1), (3, text, "en", "a", 1), (3, text, None, None, None), (None, edited(text, 1, 1), "en", "a", 1)], DOCUMENTS)
    found = jaccard_join.jaccard_components(frame).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in found) == [(0, 3), (0, 3), (3, 3), (3, 3)]
    assert jaccard_join.jaccard_components(documents(spark, [])).collect() == []


def test_prefix_tree_finds_the_partners(spark):
    pick = random.Random(3)
    order = list(range(1, 200))
    sets = []
    for _ in range(60):
        base = sorted(pick.sample(order, pick.randrange(1, 60)))
        sets += [base, sorted(set(base) - set(pick.sample(base, len(base) // 8))) or base, base]
    arrays = [np.array(x, np.uint64) for x in sets]
    tree = jaccard_join.PrefixTree(arrays)
    for x, a in zip(sets, arrays):
        wanted = [j for j, y in enumerate(sets) if 100 * len(set(x) & set(y)) >= 80 * len(set(x) | set(y))]
        assert sorted(tree.partners(a, 80)) == wanted


def test_exact_groups_match_brute_force(spark):
    texts = [*ODD, *("Some TEXT", "some text", "ÀB", "àb", "Àb") * 30, *(prose(i % 40, 20) for i in range(120))]
    frame = documents(spark, texts).withColumn("winner", F.lit(0)).withColumn("digest", F.lit(0))
    found = digest_dedup.exact_groups(frame, digest_dedup.first_half(frame)).collect()
    same = defaultdict(list)
    for i, t in enumerate(texts):
        same[(t or "").translate(LOWER)].append(i)
    wanted = {}
    for text, ids in same.items():
        for i in ids:
            wanted[i] = (max(ids), len(ids), i == max(ids), hashlib.sha256(text.encode()).digest())
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, bytes(r.digest)) for r in found} == wanted
    kept = digest_dedup.without_copies(frame, digest_dedup.first_half(frame))
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(max(x) for x in same.values())


@pytest.mark.parametrize("history", ["true", "false", "cast(null as boolean)"])
def test_exact_groups_of_null_ids_repeated_rows_and_no_rows(spark, history):
    rows = [(None, "a", "en", "s", 1), (None, "A", "en", "s", 1), (7, "b", "en", "s", 1), (7, "b", "en", "s", 1), (None, "b", "en", "s", 1), (8, None, None, None, None)]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    found = digest_dedup.exact_groups(frame, F.expr(history)).collect()
    assert sorted((r.keep_id or 0, r.group_size, r.kept) for r in found) == [(0, 2, False), (0, 2, True), (7, 3, False), (7, 3, False), (7, 3, True), (8, 1, True)]
    kept = digest_dedup.without_copies(frame, F.expr(history)).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 7, 8]
    clash = frame.toDF("doc_id", "text", "digest", "_of", "c0").withColumn("doubtful", F.lit(3)).withColumn("of", F.lit("x"))
    kept = digest_dedup.without_copies(clash, F.expr(history))
    assert kept.columns == clash.columns
    assert sorted((r.doc_id or 0, r.digest, r.c0, r.doubtful, r.of) for r in kept.collect())[:2] == [(0, "en", 1, 3, "x"), (7, "en", 1, 3, "x")]
    assert digest_dedup.exact_groups(documents(spark, []), F.expr(history)).collect() == []
    assert digest_dedup.without_copies(documents(spark, []), F.expr(history)).collect() == []


def test_perfect_hash_is_minimal_and_turns_others_away():
    pick = np.random.default_rng(1)
    keys = pick.integers(0, 2**63, (5000, 4)).astype(np.uint64)
    made = digest_dedup.PerfectHash.unpack(digest_dedup.PerfectHash.of(keys).pack())
    assert sorted(made.slots(keys)) == list(range(5000))
    others = made.slots(pick.integers(0, 2**63, (1000, 4)).astype(np.uint64))
    assert ((others >= -1) & (others < 5000)).all()
    assert list(digest_dedup.PerfectHash.of(keys[:0]).slots(keys[:3])) == [-1, -1, -1]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_lines(text):
    lines = []
    for line in (text or "").split("\n"):
        line = "".join("0" if c in "0123456789" else c for c in line.translate(LOWER))
        lines.append(" ".join("".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in line).split()))
    return lines


def plain_links(names):
    """The links by the definition, and all pairs within the edit distance."""
    bits, blocks = {}, {}
    for name in names:
        hashes = [int(_texts([w]).hashes(np.array([0]), np.array([len(w.encode())]))[0]) for w in name.split()]
        bits[name] = sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))
        w = name.split()
        runs = {" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))}
        # A run alone has one block, its hash.
        blocks[name] = set(sorted(int(line_dedup.blocks_of(_texts([r]), 4, 4)[0][0]) for r in runs)[:4])
    links, true = [], []
    for i, a in enumerate(names):
        for b in names[:i]:
            size = max(len(a), len(b))
            apart = max((Counter(a) - Counter(b)).total(), (Counter(b) - Counter(a)).total())
            if apart <= 0.2 * size + 1e-9 and distance(a, b) <= int(0.2 * size + 1e-9):
                true.append((a, b))
                if blocks[a] & blocks[b] and (bits[a] ^ bits[b]).bit_count() <= 14:
                    links.append((a, b))
    return links, true


def test_line_dedup_matches_brute_force(spark):
    base = [prose(i, 25) for i in range(30)]
    texts = [*ODD, "a 1\n\nB 22\na 7!\n", *("\n".join([base[i % 30], edited(base[(i * 7) % 30], i % 2, i), f"Line {i} of many", "common line here"]) for i in range(90))]
    texts += [edited(base[0], 1, 900 + i) for i in range(40)]
    found = line_dedup.dropped_lines(documents(spark, texts).withColumn("node", F.lit(1))).collect()
    first, lines = {}, [plain_lines(t) for t in texts]
    for i, each in enumerate(lines):
        for k, line in enumerate(each):
            if line:
                first.setdefault(line, (i, k))
    names = list(first)
    links, true = plain_links(names)
    assert len(links) >= 0.9 * len(true)
    # Also those that the blocks miss.
    links = [(first[a], first[b]) for a, b in true]
    group = groups_of(first.values(), links)
    wanted = {i: [k for k, line in enumerate(each) if line and group[first[line]] != (i, k)] for i, each in enumerate(lines)}
    assert {r.doc_id: (r.n_lines, r.dropped) for r in found} == {i: (len(lines[i]), wanted[i]) for i in wanted}
    assert links
    frame = documents(spark, texts)
    cleaned = {r.doc_id: r.text for r in line_dedup.without_lines(frame).collect()}
    assert cleaned == {i: t if not wanted[i] else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in wanted[i]) for i, t in enumerate(texts)}
    assert line_dedup.dropped_lines(documents(spark, [])).collect() == []


def test_line_dedup_links_long_lines_and_counts_characters(spark):
    spam = " ".join(["spam"] * 60)
    long = prose(5, 3000)
    run = "x" * 200_000
    texts = [spam, f"{spam} {'漢' * 40}", long, edited(long, 3, 1), run, run + "y", "漢字 " * 20, "", None]
    found = {r.doc_id: r.dropped for r in line_dedup.dropped_lines(documents(spark, texts)).collect()}
    # A run of letters is one word: two of them share no block, and are near all the same.
    assert found == {0: [], 1: [0], 2: [], 3: [0], 4: [], 5: [0], 6: [], 7: [], 8: []}


def test_line_dedup_joins_a_large_family_whatever_its_centre_is(spark):
    base = prose(8, 16)
    texts = [edited(base, 1 + i % 4, i) for i in range(70)]
    names = list(dict.fromkeys(plain_lines("\n".join(texts))))
    _, parts = line_dedup.fuzzy_groups(documents(spark, texts))
    group = groups_of(names, plain_links(names)[0])
    sizes = sorted(n for n in Counter(group.values()).values() if n > 1)
    assert sorted(r["count"] for r in parts.groupBy("component").count().collect()) == sizes


def lettered(seed, count):
    """Prose without digits, which are all one in a normalised line."""
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefghiklmnoprstuvw") for _ in range(pick.randint(2, 9))) for _ in range(count))


def scattered(text, share, seed):
    """Edits at single characters, spread over the whole text."""
    pick, letters = random.Random(seed), list(text)
    for _ in range(int(share * len(letters))):
        at, kind = pick.randrange(len(letters)), pick.randrange(3)
        letters[at : at + (kind != 1)] = [] if kind == 0 else [pick.choice("abcdeéw漢")]
    return "".join(letters)


@pytest.mark.parametrize("lines", [5, 1 << 12])
def test_line_dedup_leaves_out_no_link(spark, monkeypatch, lines):
    monkeypatch.setattr(edit_join, "CHUNK_LINES", lines)
    texts = ["colour", "color", "an apple", "an aple", "abcd", "abce", "漢字漢字漢", "漢字漢字字", "no"]
    for i in range(16):
        base = lettered(i, 2 + 3 * i)
        texts += [base, scattered(base, 0.1 + 0.02 * (i % 8), i), scattered(base, 0.17, 100 + i)]
    # Of every three words one has another letter, so no run of four is shared.
    base = lettered(70, 30).split(" ")
    texts += [" ".join(base), " ".join(w[:-1] + "y" if i % 3 == 0 else w for i, w in enumerate(base))]
    texts += ["x" * 300, "x" * 260 + "y" * 20]
    names = list(dict.fromkeys(n for n in plain_lines("\n".join(texts)) if n))
    blocked, true = plain_links(names)
    group = groups_of(names, true)
    assert group != groups_of(names, blocked)
    found, parts = line_dedup.fuzzy_groups(documents(spark, texts))
    sizes = sorted(n for n in Counter(group.values()).values() if n > 1)
    assert sorted(r["count"] for r in parts.groupBy("component").count().collect()) == sizes
    first = {}
    kept = [first.setdefault(group[n], i) == i for i, t in enumerate(texts) for n in plain_lines(t)]
    dropped = {r.doc_id: r.dropped for r in line_dedup.dropped_lines(documents(spark, texts)).collect()}
    assert dropped == {i: [] if stays else [0] for i, stays in enumerate(kept)}


@pytest.mark.parametrize("lines", [3, 1 << 12])
def test_edit_links_ship_a_text_once_however_many_chunks_it_meets(spark, monkeypatch, capsys, lines):
    monkeypatch.setattr(edit_join, "CHUNK_LINES", lines)
    chunks, write = [], edit_join.written

    def written(frame, *more):
        chunks.append(write(frame, *more))
        return chunks[-1]

    monkeypatch.setattr(edit_join, "written", written)
    texts = [lettered(i, 6) for i in range(30)]
    texts += [scattered(t, 0.1, i) for i, t in enumerate(texts)] + ["x" * 700, "漢" * 9 + "a", "漢" * 10]
    frame = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "node bigint, text string, component bigint")
    links = edit_join.edit_links(frame, 0.8)
    size = np.array([len(t) for t in texts])
    low, high = np.triu_indices(len(texts), 1)
    near = within([texts[i] for i in low], [texts[j] for j in high], edit_join.allowed(np.maximum(size[low], size[high]), 0.8))
    group = groups_of(range(len(texts)), zip(low[near].tolist(), high[near].tolist()))
    assert groups_of(range(len(texts)), [(r.a, r.b) for r in links.collect()]) == group
    (rows,) = chunks
    assert sorted(line.node for r in rows.collect() for line in r.lines) == list(range(len(texts)))
    assert all(len(r.lines) <= 3 * lines and r.least <= r.most for r in rows.collect())
    # Cells read the chunks where they lie: nothing is shuffled for them.
    links.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" in plan and "Exchange" not in plan


def test_chunks_of_bands():
    told = [(0, 3, 9), (1, 4, 9), (2, 30, 9), (5, 1, 45), (6, 1, 5)]
    assert edit_join._chunks(told, 8, 20) == [(0, 0, 1), (1, 0, 1), (2, 1, 4), (5, 5, 3), (6, 8, 1)]
    assert edit_join._chunks([], 8, 20) == []


@pytest.mark.parametrize("setting", [None, "false", "true"])
def test_line_dedup_leaves_the_setting_for_shuffle_files_as_it_was(spark, setting):
    before = spark.conf.get(line_dedup.DROP_SHUFFLES)
    try:
        spark.conf.unset(line_dedup.DROP_SHUFFLES)
        if setting is not None:
            spark.conf.set(line_dedup.DROP_SHUFFLES, setting)
        with pytest.raises(ValueError), line_dedup._shuffles_dropped(spark):
            assert spark.conf.get(line_dedup.DROP_SHUFFLES) == "true"
            raise ValueError
        assert spark.conf.get(line_dedup.DROP_SHUFFLES) == (setting or before)
    finally:
        spark.conf.unset(line_dedup.DROP_SHUFFLES)


def test_bounds_of_the_edit_join_pass_all_near_pairs():
    pick = random.Random(4)
    texts = []
    for size in [3, 6, 12, 40, 70, 130, 200, 300, 520, 700] * 3:
        base = "".join(pick.choice("abcdefgh é漢") for _ in range(size))
        texts += [base, *(scattered(base, pick.choice([0.05, 0.15, 0.2, 0.22, 0.25]), pick.random()) for _ in range(4))]
    texts = [t for t in dict.fromkeys(texts) if t]
    number, size = np.arange(len(texts)), np.array([len(t) for t in texts])
    low, high = np.triu_indices(len(texts), 1)
    near = within([texts[i] for i in low], [texts[j] for j in high], edit_join.allowed(np.maximum(size[low], size[high]), 0.8))
    group = groups_of(range(len(texts)), zip(low[near].tolist(), high[near].tolist()))
    chunk = lambda taken: edit_join._Chunk(taken, [texts[i] for i in taken], taken)
    whole, even, odd = chunk(number), chunk(number[::2]), chunk(number[1::2])
    linked = edit_join._links_of(whole, whole, True, 0.8)
    assert groups_of(range(len(texts)), zip(*(x.tolist() for x in linked))) == group
    parts = [edit_join._links_of(*x, 0.8) for x in ((even, even, True), (odd, odd, True), (even, odd, False))]
    links = [link for x in parts for link in zip(x[0].tolist(), x[1].tolist())]
    assert groups_of(range(len(texts)), links) == group


def test_edit_distance_within_a_bound():
    rng = random.Random(3)
    pairs = []
    for _ in range(600):
        letters = rng.choice(["ab", "abcdefgh ", "aé漢😀"])
        a = [rng.choice(letters) for _ in range(rng.randint(0, 40))]
        b = list(a)
        for _ in range(rng.randint(0, 9)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = [rng.choice(letters)] * rng.randint(0, 1)
        pairs.append(("".join(a), "".join(b), rng.randint(0, 8)))
    one, other, allowed = zip(*pairs)
    found = within(one, other, np.array(allowed))
    assert found.tolist() == [distance(a, b) <= k for a, b, k in pairs]
    assert 100 < found.sum() < 590
    assert within([], [], np.zeros(0, np.int64)).tolist() == []


def _texts(strings):
    raw = [s.encode() for s in strings]
    return Texts(np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(x) for x in raw])))


def inside(pattern, text, most):
    """Whether a part of the text turns into the pattern by at most so many edits."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row) <= most


def test_leaks_match_brute_force(spark):
    pick = random.Random(8)
    letters = lambda n: "".join(pick.choice("abcdefgh ") for _ in range(n))
    items = [letters(n) for n in (35, 60, 100, 130, 240)]

    def noisy(text, edits):
        chars = list(text)
        for _ in range(edits):
            at = pick.randrange(len(chars))
            kind = pick.randrange(3)
            chars[at : at + (kind != 1)] = [] if kind == 2 else [pick.choice("abcdefgh")]
        return "".join(chars)

    texts = [*ODD, *(letters(150) for _ in range(10))]
    for item in items:
        for edits in (0, 1, 2, 4, 6, 9, 14):
            texts.append(letters(40) + noisy(item, edits) + letters(40))
    texts += [items[3][:110], items[0].upper() + "!!", "  ".join(items[1].split(" ")), items[4][70:175], items[2], items[2]]
    bench = spark.createDataFrame([*enumerate(items), (10, None), (11, "short"), (12, "")], "item_id bigint, text string")
    frame = documents(spark, texts).withColumn("item_id", F.lit("clash"))
    found = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(frame, bench).collect()}
    windows = decontaminate.Windows.of(list(range(len(items))), items)
    wanted = set()
    plain = [" ".join(plain_without_digits(t).split()) for t in texts]
    for i, text in enumerate(plain):
        if len(text) > 5000:
            continue
        for item, window, budget in zip(windows.items, windows.texts, windows.budgets):
            if inside(window.tobytes().decode(), text, int(budget)):
                wanted.add((i, int(item)))
    assert set(found) == wanted and len(wanted) > 20
    for (doc, _), r in found.items():
        assert 0 <= r.first_byte < r.last_byte <= len(texts[doc].encode())
    clean = decontaminate.without_leaks(frame, bench)
    assert clean.columns == frame.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(set(range(len(texts))) - {d for d, _ in wanted})
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.leaks(frame, empty).collect() == [] and decontaminate.without_leaks(frame, empty).count() == len(texts)
    assert decontaminate.leaks(documents(spark, []), bench).collect() == []


def plain_without_digits(text):
    return "".join(c if c.isalnum() or not c.isascii() else " " for c in (text or "").translate(LOWER))


def test_leaks_do_not_depend_on_blocks(spark, monkeypatch):
    items = [(i, prose(i, 30)) for i in range(20)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    frame = documents(spark, [f"{prose(100 + i, 20)} {items[i][1]} {prose(200 + i, 20)}" for i in range(20)])
    wanted = sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(frame, bench).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 500)
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(frame, bench).collect()) == wanted == [(i, i) for i in range(20)]


def test_runs_of_an_item_are_found_wherever_they_begin(spark):
    item = prose(41, 40)
    cyrillic = " ".join("".join(chr(0x430 + random.Random(100 * i + k).randrange(32)) for k in range(7)) for i in range(30))
    texts, wanted = [], set()
    for number, text in enumerate((item, cyrillic)):
        for begin in range(len(text) - 59 + 1):
            run = text[begin : begin + 59].strip()
            if len(run) == 59:
                wanted.add((len(texts), number))
                texts.append(f"Qq zz {run} zz qq")
    bench = spark.createDataFrame(list(enumerate((item, cyrillic))), "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents(spark, texts), bench).collect()}
    assert found == wanted and len(wanted) > 200


def test_short_items_are_whole_lines(spark):
    texts = ["What is it?\nAN  answer, here\nmore", "say an answer here", "an\nanswer here", "an answer here", None, "\n\n"]
    bench = spark.createDataFrame([(1, "An answer here!"), (2, "an answer here"), (3, "?!")], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): (r.windows, r.edits, r.first_byte, r.last_byte) for r in decontaminate.leaks(documents(spark, texts), bench).collect()}
    assert found == {(d, i): (1, 0, *x) for i in (1, 2) for d, x in ((0, (12, 28)), (2, (0, 14)), (3, (0, 14)))}
    assert sorted(r.doc_id for r in decontaminate.without_leaks(documents(spark, texts), bench).collect()) == [1, 4, 5]


def test_leaks_of_items_without_an_id(spark):
    items = [(None, prose(51, 30)), (None, prose(52, 30)), (7, prose(53, 30)), (None, "short one")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    frame = documents(spark, [*(f"{prose(60, 9)} {t}" for _, t in items), "Short one!"])
    found = sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(frame, bench).collect())
    assert found == [(0, None), (1, None), (2, 7), (4, None)]
    assert [r.doc_id for r in decontaminate.without_leaks(frame, bench).collect()] == [3]


@pytest.mark.parametrize("members, many", [(60, 20), (300, 20), (120, 0)])
def test_links_of_a_family_grow_with_its_size(spark, monkeypatch, members, many):
    """Variants of one text: most link, some only through others. Whichever is asked first, few links are kept."""
    monkeypatch.setattr(jaccard_join, "MANY_PAIRS", many)
    base = prose(77, 150)
    texts = [edited(base, 1 + (i % 5), 500 + i) for i in range(members)] + [edited(base, 9, 9000 + i) for i in range(4)]
    kept, asked = [], []
    plain = jaccard_join.checked

    def spy(pairs, *others):
        found = plain(pairs, *others)
        asked.append(pairs.count())
        kept.append(found.count())
        return found

    monkeypatch.setattr(jaccard_join, "checked", spy)
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(documents(spark, texts)).collect()}
    sets = [shingles(t) for t in texts]
    expected = list(range(len(texts)))

    def root(x):
        while expected[x] != x:
            x = expected[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and root(i) != root(j):
                a, b = sorted((root(i), root(j)))
                expected[b] = a
    assert found == {i: root(i) for i in range(len(texts))}
    assert sum(kept) <= 12 * members and sum(asked) <= 40 * members


def test_near_copies_are_told_by_id_and_text(spark):
    one, other = prose(1, 60), prose(2, 60)
    rows = [(1, one, 1), (2, one + " end", 2), (2, other, 3), (None, one, 4), (3, None, 5), (4, edited(other, 1, 3), 6)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, _gone int")
    frame = frame.selectExpr("doc_id", "text", "_gone", "_gone as key", "_gone as `a.b`", "_gone as c0")
    left = jaccard_join.without_near_copies(frame)
    assert left.columns == frame.columns
    assert sorted(r["_gone"] for r in left.collect()) == [1, 3, 4, 5]


def syllables(seed, size):
    """Text of few syllables, of which any two have many pairs of letters in common."""
    pick, parts = random.Random(seed), ("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "or", "ti", "st", "ing ", "tion", " of ", "the ")
    text = ""
    while len(text) < size:
        text += pick.choice(parts)
    return text[:size].strip()


def drifted(text, edits):
    """As many edits, at the places from which an alignment leaves the diagonal furthest."""
    half = edits // 2
    yield text[edits:]
    yield text[:-edits] if edits else text
    yield "q" * edits + text
    yield text + "q" * edits
    yield "q" * half + text[: len(text) - half]
    yield text[half:] + "q" * half
    yield "".join("q" if i % 5 == 4 else c for i, c in enumerate(text))


def test_subsequences_rule_out_no_near_pair():
    texts = []
    for i, size in enumerate([2, 5, 9, 30, 62, 63, 64, 65, 126, 127, 190, 330, 700, 1500]):
        base = syllables(i, size)
        texts += [base, *drifted(base, int(0.2 * len(base))), *drifted(base, int(0.166 * len(base)))]
        texts += [scattered(base, share, i) for share in (0.1, 0.2, 0.25)]
    texts = [t for t in dict.fromkeys(texts) if t]
    number = np.arange(len(texts))
    chunk = edit_join._Chunk(number, texts, number)
    size = chunk.sizes
    most = edit_join.allowed(np.maximum(size[:, None], size[None, :]), 0.8)
    fits = np.abs(size[:, None] - size[None, :]) <= most
    low, high = np.nonzero(fits)
    near = np.zeros(fits.shape, bool)
    near[low, high] = within([chunk.texts[i] for i in low], [chunk.texts[j] for j in high], most[low, high])
    assert near.sum() > 4 * len(texts)
    for i, j in zip(*np.nonzero(near)):
        x, y = np.array([i]), np.array([j])
        # A pair alone goes on to the last word.
        assert edit_join._by_subsequences(chunk, chunk, x, y, np.ones((1, 1), bool), most[i : i + 1, j : j + 1]).all()
    # Texts of one length, then of very different ones, at once.
    for x in [np.flatnonzero((size > 50) & (size < 90)), np.flatnonzero(size > 300), number]:
        left = edit_join._by_subsequences(chunk, chunk, x, number, fits[x], most[x])
        assert left[near[x]].all() and not left[~fits[x]].any()


@pytest.mark.parametrize("size", [40, 90, 200])
def test_few_pairs_that_are_not_near_are_compared_whole(monkeypatch, size):
    texts = [syllables(i, size) for i in range(400)]
    texts += [scattered(t, 0.1, i) for i, t in enumerate(texts[:20])]
    number, whole = np.arange(len(texts)), []
    chunk = edit_join._Chunk(number, texts, number)

    def counted(one, other, most):
        whole.append(len(one))
        return within(one, other, most)

    def no_pieces(one, other, x, y, most):
        whole.append(len(x))
        return np.ones(len(x), bool)

    monkeypatch.setattr(edit_join, "within", counted)
    monkeypatch.setattr(edit_join, "_by_pieces", no_pieces)
    a, b = edit_join._links_of(chunk, chunk, True, 0.8)
    assert {(i, 400 + i) for i in range(20)} <= set(zip(a.tolist(), b.tolist()))
    assert sum(whole) < 0.02 * len(texts) ** 2 / 2
