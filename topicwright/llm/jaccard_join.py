"""N-gram Jaccard join by prefix trees: all links between texts whose word n-grams overlap enough, and their components.

The n-grams of a text are a set. All sets follow one global order: n-grams that few texts hold come first, by their
hash, and n-grams that many texts hold come last, by their number of texts. Two sets that link then share an n-gram among the
first `n - ceil(share * n) + 1` of either, so sets only meet at such an n-gram. Where they meet, the places bound what they
can still share; that bound decides which pairs are checked. The check stores the partners of a set in a prefix tree
over the global order, walks it once with the overlap counted so far, and leaves a subtree as soon as what remains of
the longest set in it, or of the set that asks, cannot reach the overlap needed. Before that, the parities of the sets'
n-grams in BITS classes bound from below how many n-grams only one of the two has.

Equal sets are one class from the start. At each n-gram one set is then checked against all others there: the one with the most n-grams
that many texts hold among its first ones, since a text that was changed much has n-grams of its own first, and is far from most others. The
components that the links found so far make are contracted, and all pairs of different components that still meet and
may link are checked. Should these be many, rounds go before it in which every component at an n-gram asks a few representatives
of others, and components are contracted again. So a group of n texts that link with most others costs a multiple of n, not its
square. Every pair of different components that meets anywhere and passes the bound is checked, so no link between
components is missed. A task that checks pairs returns a spanning forest of the links that it finds, not all of them.

Null or empty texts have no n-grams and link with nothing. Equal rows, and rows with an equal or a null id, are rows of
their own; a null id is never a component's smallest id unless the component has no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicwright.llm.shared import components, written
from topicwright.llm.sieve import passes, sieve
from topicwright.llm.text_arrays import Texts, mix, shingle_sets, slices

#: N-grams held by so many texts at least are counted as frequent. It and MOST_FREQUENT only shape the order, not the result.
FREQUENT = 8
#: So many frequent n-grams at most have a place of their own in the order: 12 bytes each on every executor.
MOST_FREQUENT = 1 << 19
#: N-gram hashes that a task counts at once.
AT_ONCE = 1 << 20
#: Classes of n-grams whose parities are kept of each set.
BITS = 512
#: Sets of one side in a cell of the grid in which pairs are checked.
CELL_SETS = 2048
#: With more pairs than this for each set that is left, another round is made first, so many at most.
MANY_PAIRS = 20
ROUNDS = 12
#: Representatives of an n-gram in such a round.
REPRESENTATIVES = 4


def set_keys(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """One 64-bit key of each set, from the sum of its hashes."""
    total = np.append(np.uint64(0), np.cumsum(mix(values + np.uint64(1)), dtype=np.uint64))
    return mix(total[begins[1:]] - total[begins[:-1]] + np.diff(begins).astype(np.uint64)).view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.RecordBatch, Texts, np.ndarray, np.ndarray]]:
    for batch in batches:
        for rows, texts in slices(batch, "text"):
            values, begins = shingle_sets(texts.lowered(), words)
            yield rows, texts, values, begins


def parities(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """For each set, whether it has an odd number of n-grams of each class, as 64-bit numbers."""
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    cells = owner * BITS + (values % np.uint64(BITS)).astype(np.int64)
    odd = (np.bincount(cells, minlength=(len(begins) - 1) * BITS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(-1, BITS), axis=1).view(np.int64)


def text_sets(documents: DataFrame, words: int) -> DataFrame:
    """(doc_id, set_key, n, odd) of every text."""

    def run(batches):
        for rows, _, values, begins in _sets(batches, words):
            odd = pa.FixedSizeListArray.from_arrays(pa.array(parities(values, begins).ravel()), BITS // 64)
            odd = odd.cast(pa.list_(pa.int64()))
            columns = [rows.column("doc_id"), pa.array(set_keys(values, begins)), pa.array(np.diff(begins)), odd]
            yield pa.record_batch(columns, ["doc_id", "set_key", "n", "odd"])

    return documents.mapInArrow(run, "doc_id bigint, set_key bigint, n bigint, odd array<bigint>")


def _pack(values: np.ndarray, size: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def _unpack(packed: bytes, size: int) -> np.ndarray:
    wide = np.zeros((len(packed) // size, 8), np.uint8)
    wide[:, :size] = np.frombuffer(packed, np.uint8).reshape(-1, size)
    return wide.view("<u8").ravel()


def pack_run(values: np.ndarray) -> bytes:
    """Ascending 40-bit numbers: the first one, then steps of 3 bytes, or of 5 where one is larger."""
    steps = np.diff(values)
    size = 3 if not len(steps) or steps.max() < 1 << 24 else 5
    return bytes([size]) + _pack(values[:1], 5) + _pack(steps, size)


def unpack_run(packed: bytes) -> np.ndarray:
    return np.cumsum(np.concatenate([_unpack(packed[1:6], 5), _unpack(packed[6:], packed[0])]), dtype=np.uint64)


def frequent_grams(documents: DataFrame, words: int, grams: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 40 bits of the hashes of the n-grams that most texts hold, in ascending order, and their numbers of texts.

    Counted over all texts. Hashes go to the counting tasks in packed runs, and each task counts one range of hashes.
    """
    ranges = 1 << max(4, min(16, int(np.ceil(np.log2(max(1, grams / AT_ONCE))))))
    shift = np.uint64(48 - int(np.log2(ranges)))

    def packed(values: list[np.ndarray]) -> pa.RecordBatch:
        joined = np.sort(np.concatenate(values))
        cuts = np.searchsorted(joined, np.arange(ranges + 1, dtype=np.uint64) << shift)
        held = np.flatnonzero(np.diff(cuts))
        runs = [pack_run(joined[cuts[i] : cuts[i + 1]] >> np.uint64(8)) for i in held]
        return pa.record_batch([pa.array(held), pa.array(runs, pa.binary())], ["range", "hashes"])

    def deal(batches):
        waiting, size = [], 0
        for _, _, values, _ in _sets(batches, words):
            waiting.append(values)
            size += len(waiting[-1])
            if size >= AT_ONCE:
                yield packed(waiting)
                waiting, size = [], 0
        if size:
            yield packed(waiting)

    def count(batches):
        parts = {}
        for batch in batches:
            for key, run in zip(batch.column("range").to_pylist(), batch.column("hashes")):
                parts.setdefault(key, []).append(unpack_run(run.as_py()))
        for key in list(parts):
            hashes, texts = np.unique(np.concatenate(parts.pop(key)), return_counts=True)
            many = texts >= FREQUENT
            yield pa.record_batch([pa.array(hashes[many].view(np.int64)), pa.array(texts[many])], ["gram", "texts"])

    counted = documents.select("text").mapInArrow(deal, "range bigint, hashes binary").repartition(ranges, "range")
    counted = counted.mapInArrow(count, "gram bigint, texts bigint")
    most = counted.orderBy(F.desc("texts"), "gram").limit(MOST_FREQUENT).toPandas().sort_values("gram")
    return most["gram"].to_numpy(np.uint64), most["texts"].to_numpy(np.int64)


def global_order(
    values: np.ndarray, begins: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Each set in the global order, and how many n-grams of each are not among the frequent ones, which come last."""
    grams, texts = frequent
    rank = np.zeros(len(values), np.int64)
    if len(grams) and len(values):
        first = values >> np.uint64(8)
        at = np.minimum(np.searchsorted(grams, first), len(grams) - 1)
        rank = np.where(grams[at] == first, texts[at], 0)
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    rare = np.bincount(owner[rank == 0], minlength=len(begins) - 1)
    late = np.flatnonzero(rank)
    if not len(late):
        return values, rare
    moved = owner[late]
    early = np.flatnonzero(rank == 0)
    order = np.concatenate([early, late[np.lexsort((values[late], rank[late], moved))]])
    return values[order[np.argsort(owner[order], kind="stable")]], rare


def _first_places(n: np.ndarray, share: int) -> np.ndarray:
    return n - (share * n + 99) // 100 + 1


def postings(documents: DataFrame, words: int, share: int, frequent) -> DataFrame:
    """(gram, set_key, n, place, common): the first places of each set in the global order; of equal sets in a task, one.

    `common` is how many of a set's first places hold frequent n-grams.
    """

    def run(batches):
        grams = frequent.value
        seen: set[tuple[int, int]] = set()
        for _, _, values, begins in _sets(batches, words):
            n, keys = np.diff(begins), set_keys(values, begins)
            fresh = np.zeros(len(n), bool)
            for i, key in enumerate(zip(keys.tolist(), n.tolist())):
                if n[i] and key not in seen:
                    seen.add(key)
                    fresh[i] = True
            ordered, rare = global_order(values, begins, grams)
            owner = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(values)) - begins[owner]
            first = _first_places(n, share)
            taken = fresh[owner] & (place < first[owner])
            owner, place = owner[taken], place[taken]
            common = np.maximum(first - rare, 0)[owner]
            columns = [ordered[taken].view(np.int64), keys[owner], *(x.astype(np.int32) for x in (n[owner], place, common))]
            yield pa.record_batch([pa.array(x) for x in columns], ["gram", "set_key", "n", "place", "common"])

    return documents.select("text").mapInArrow(run, "gram bigint, set_key bigint, n int, place int, common int")


def _may_link(a: str, b: str, share: int) -> str:
    """Whether two sets that meet at these places can still reach the overlap: the bound by what remains of either."""
    rest = f"least({a}.n - {a}.place, {b}.n - {b}.place)"
    return f"{100 + share} * cast({rest} as bigint) >= {share} * (cast({a}.n as bigint) + {b}.n)"


def _few_apart(a: str, b: str, share: int) -> str:
    """Whether the parities of two sets leave it open that they link: each that differs is an n-gram of only one."""
    apart = " + ".join(f"bit_count({a}.odd[{i}] ^ {b}.odd[{i}])" for i in range(BITS // 64))
    return f"{100 + share} * cast({apart} as bigint) <= {100 - share} * (cast({a}.n as bigint) + {b}.n)"


def ordered_sets(documents: DataFrame, words: int, frequent, keys: DataFrame) -> DataFrame:
    """(set_key, grams): the sets with these keys, and some others, in the global order, packed; of equal sets in a task, one."""
    held = documents.sparkSession.sparkContext.broadcast(sieve(keys))

    def run(batches):
        seen: set[int] = set()
        for _, _, values, begins in _sets(batches, words):
            own = set_keys(values, begins)
            taken = [i for i in np.flatnonzero(passes(held.value, own)).tolist() if own[i] not in seen]
            seen.update(own[taken].tolist())
            ordered, _ = global_order(values, begins, frequent.value)
            grams = [_pack(ordered[begins[i] : begins[i + 1]], 6) for i in taken]
            yield pa.record_batch([pa.array(own[taken]), pa.array(grams, pa.binary())], ["set_key", "grams"])

    return documents.select("text").mapInArrow(run, "set_key bigint, grams binary")


def spanning_forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those of the pairs that connect what the ones before them don't."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (above := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[above]
        return x

    kept = []
    for a, b in pairs:
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


class PrefixTree:
    """Sets in a global order, stored once for each shared beginning.

    Sets are sorted; a node is the part of a set that it does not share with the one before it. `under` are the longest
    and the shortest set below a node, which bound the overlap that any of them needs and can still reach.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = [len(x) for x in sets]
        self.roots: list[list] = []
        path: list[list] = []
        before = np.zeros(0, np.uint64)
        for i in sorted(range(len(sets)), key=lambda i: sets[i].byteswap().tobytes()):
            grams = sets[i]
            size = min(len(before), len(grams))
            differ = np.flatnonzero(before[:size] != grams[:size])
            shared = int(differ[0]) if len(differ) else size
            while path and path[-1][0] >= shared:
                path.pop()
            if path and path[-1][0] + len(path[-1][1]) > shared:
                node = path[-1]
                cut = shared - node[0]
                rest = [shared, node[1][cut:], node[2], node[3], 0, 0]
                node[1], node[2], node[3] = node[1][:cut], [rest], []
            if path and shared == len(grams):
                path[-1][3].append(i)
            else:
                node = [shared, grams[shared:], [], [i], 0, 0]
                (path[-1][2] if path else self.roots).append(node)
                path.append(node)
            before = grams
        for root in self.roots:
            self._bound(root)

    def _bound(self, root: list) -> None:
        walk, seen = [root], []
        while walk:
            node = walk.pop()
            seen.append(node)
            walk.extend(node[2])
        for node in reversed(seen):
            sizes = [self.sizes[i] for i in node[3]] + [x[k] for x in node[2] for k in (4, 5)]
            node[4], node[5] = max(sizes), min(sizes)

    def partners(self, grams: np.ndarray, share: int) -> list[int]:
        """The stored sets that link with this one."""
        held = np.sort(grams)
        at = {g: k for k, g in enumerate(grams.tolist())}
        n, found = len(grams), []
        walk = [(node, 0, 0) for node in self.roots]
        while walk:
            node, overlap, used = walk.pop()
            part = node[1]
            place = np.minimum(np.searchsorted(held, part), n - 1)
            common = part[held[place] == part]
            overlap += len(common)
            if len(common):
                used = max(used, max(at[g] for g in common.tolist()) + 1)
            depth = node[0] + len(part)
            most = overlap + min(node[4] - depth, n - used)
            if (100 + share) * most < share * (n + node[5]):
                continue
            found += [i for i in node[3] if (100 + share) * overlap >= share * (n + self.sizes[i])]
            walk += [(child, overlap, used) for child in node[2]]
        return found


def checked(pairs: DataFrame, documents: DataFrame, words: int, share: int, frequent) -> DataFrame:
    """Of the pairs (a, b) that link, enough to connect all that do.

    Pairs are dealt to the cells of a grid over their two sets, so that a set with many partners goes to as many cells as
    the grid is wide, not to as many as it has partners. In a cell the partners of each `a` form one prefix tree.
    """
    pairs = written(pairs, "pairs")
    ends = pairs.select(F.approx_count_distinct("a"), F.approx_count_distinct("b")).first()
    wide = max(8, max(ends) // CELL_SETS + 1)
    row, column = (F.pmod(F.xxhash64(x), F.lit(wide)) for x in ("a", "b"))
    cells = pairs.select((row * wide + column).alias("cell"), "a", "b")

    def run(batches):
        cell, asks, stored = None, [], {}

        def links():
            found = []
            asks.sort()
            for a, group in groupby(asks, lambda x: x[0]):
                keys = [b for _, b in group]
                tree = PrefixTree([stored[b] for b in keys])
                found += [(a, keys[i]) for i in tree.partners(stored[a], share)]
            found = spanning_forest(found)
            return pa.record_batch([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            for at, a, b, grams in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if at != cell:
                    if asks:
                        yield links()
                    cell, asks, stored = at, [], {}
                if grams is None:
                    asks.append((a, b))
                else:
                    stored[a] = _unpack(grams, 6)
        if asks:
            yield links()

    needed = cells.select("cell", "a").union(cells.select("cell", "b")).distinct()
    sets = ordered_sets(documents, words, frequent, needed.select("a")).dropDuplicates(["set_key"])
    shipped = needed.join(sets.selectExpr("set_key as a", "grams"), "a").selectExpr("cell", "a", "null as b", "grams")
    rows = cells.selectExpr("cell", "a", "b", "cast(null as binary) as grams").union(shipped)
    dealt = rows.repartition("cell").sortWithinPartitions("cell")
    return written(dealt.mapInArrow(run, "a bigint, b bigint"), "links")


def _placed(met: DataFrame, parts: DataFrame) -> DataFrame:
    """The postings with the component of their set, at n-grams where several components meet."""
    placed = met.join(parts.withColumnRenamed("node", "set_key"), "set_key", "left")
    placed = placed.withColumn("component", F.coalesce("component", "set_key"))
    several = placed.groupBy("gram").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most")
    return placed.join(several.select("gram"), "gram", "left_semi")


def _asked(placed: DataFrame, number: int, share: int) -> DataFrame:
    """Pairs (a, b) of the representatives of some components at each n-gram with the sets of other components there."""
    closest = F.max(F.struct("common", F.xxhash64("set_key", F.lit(number)).alias("order"), "set_key", "n", "place"))
    chosen = placed.groupBy("gram", "component").agg(closest.alias("first"))
    place = F.row_number().over(Window.partitionBy("gram").orderBy(F.desc("first")))
    chosen = chosen.select("gram", F.col("component").alias("own"), "first", place.alias("at"))
    chosen = chosen.where(F.col("at") <= REPRESENTATIVES)
    asked = placed.join(chosen, "gram").where("own <> component").where(_may_link("first", "x", share).replace("x.", ""))
    return asked.selectExpr("least(first.set_key, set_key) as a", "greatest(first.set_key, set_key) as b").distinct()


def _rest(placed: DataFrame, rows: DataFrame, share: int) -> DataFrame:
    """All pairs (a, b) of sets of different components that meet and may link."""
    # Of the components that meet at an n-gram, all but the largest ask the others.
    sizes = placed.groupBy("gram", "component").agg(F.count("*").alias("sets"))
    largest = sizes.groupBy("gram").agg(F.max(F.struct("sets", "component")).getField("component").alias("largest"))
    odd = rows.groupBy("set_key").agg(F.first("odd").alias("odd"))
    placed = written(placed.join(largest, "gram").join(odd, "set_key"), "mixed")
    meet = "x.gram = y.gram and x.component <> y.component and (y.component = y.largest or x.set_key < y.set_key)"
    pairs = placed.where("component <> largest").alias("x").join(placed.alias("y"), F.expr(meet))
    pairs = pairs.where(_may_link("x", "y", share)).where(_few_apart("x", "y", share))
    return pairs.selectExpr("least(x.set_key, y.set_key) as a", "greatest(x.set_key, y.set_key) as b").distinct()


def text_components(documents: DataFrame, words: int, share: int) -> DataFrame:
    """(doc_id, set_key, n, component) of every row of documents (doc_id, text): the key and size of its set, and a key of its component."""
    spark = documents.sparkSession
    rows = written(text_sets(documents, words), "sets")
    total = rows.agg(F.sum("n")).first()[0] or 0
    frequent = spark.sparkContext.broadcast(frequent_grams(documents, words, int(total)))

    met = postings(documents, words, share, frequent)
    met = met.repartition("gram").distinct().selectExpr(
        "*",
        "max(struct(common, set_key, n, place)) over (partition by gram) as first",
        "lag(n) over (partition by gram order by n, set_key) as below",
        "lead(n) over (partition by gram order by n, set_key) as above",
    )
    near = f"100 * cast(below as bigint) >= {share} * cast(n as bigint) or 100 * cast(n as bigint) >= {share} * cast(above as bigint)"
    met = written(met.where(near).drop("below", "above"), "met")
    asked = met.where(f"first.set_key <> set_key and {_may_link('first', 'met', share)}".replace("met.", ""))
    asked = written(asked.selectExpr("least(first.set_key, set_key) as a", "greatest(first.set_key, set_key) as b").distinct(), "asked")
    met = met.drop("first")

    links = checked(asked, documents, words, share, frequent)
    parts = components(links)
    placed = written(_placed(met, parts), "open")
    pairs = written(_rest(placed, rows, share).join(asked, ["a", "b"], "left_anti"), "rest")
    for number in range(ROUNDS):
        if pairs.count() <= MANY_PAIRS * placed.select("set_key").distinct().count():
            break
        more = written(_asked(placed, number, share).join(asked, ["a", "b"], "left_anti"), "asked")
        asked = asked.union(more)
        links = links.union(checked(more, documents, words, share, frequent))
        parts = components(links)
        placed = written(_placed(placed.drop("component"), parts), "open")
        pairs = written(_rest(placed, rows, share).join(asked, ["a", "b"], "left_anti"), "rest")
    links = links.union(checked(pairs, documents, words, share, frequent))
    parts = components(links).select(F.col("node").alias("set_key"), "component")
    rows = rows.drop("odd").join(parts, "set_key", "left")
    return rows.withColumn("component", F.coalesce("component", "set_key"))


def jaccard_components(documents: DataFrame, words: int = 5, share: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of documents (doc_id bigint, text string; others are left alone).

    Words are runs of other characters than white space, with A-Z lower-cased. Two texts link when 100 times their common
    distinct n-grams are at least `share` times those of both. `component_id` is the smallest id reachable by links.
    """
    rows = text_components(documents.select("doc_id", "text"), words, share)
    smallest = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    alone = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.join(smallest, "component").select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id"))


def without_near_copies(documents: DataFrame, words: int = 5, share: int = 80) -> DataFrame:
    """The rows of documents of which one of each component stays: that with the smallest id, of several the one with the smallest key.

    A row is told by its id and its set of n-grams, so of rows that share an id each is decided on for itself; rows with
    equal ids and equal sets stay or go together. Rows with a null id stay. Other columns may have any name.
    """
    rows = text_components(documents.select("doc_id", "text"), words, share).where("n > 0 and doc_id is not null")
    rows = written(rows.select("doc_id", "set_key", "component").distinct(), "rows")
    stays = rows.groupBy("component").agg(F.min(F.struct("doc_id", "set_key")).alias("stays")).select("stays.*")
    # By id and key, as copies of a component would all meet at its key.
    gone = written(rows.select("doc_id", "set_key").join(stays, ["doc_id", "set_key"], "left_anti"), "gone")
    held = documents.sparkSession.sparkContext.broadcast(sieve(gone.select("set_key").distinct()))
    names = documents.columns
    # Columns by number on the way, so that no name clashes.
    numbered = documents.toDF(*(f"c{i}" for i in range(len(names))))
    text = f"c{names.index('text')}"
    kind = numbered.select("*", F.lit(0).cast("bigint").alias("key")).schema

    def sieved(passing: bool):
        def run(batches):
            for batch in batches:
                for rows, texts in slices(batch, text):
                    keys = set_keys(*shingle_sets(texts.lowered(), words))
                    made = pa.record_batch([*rows.columns, pa.array(keys)], names=kind.names)
                    yield made.filter(pa.array(passes(held.value, keys) == passing))

        return numbered.mapInArrow(run, kind)

    # Most texts pass without a shuffle; only those that may have to go are compared.
    gone = gone.toDF(f"c{names.index('doc_id')}", "key")
    doubtful = sieved(True).join(gone, gone.columns, "left_anti").select(*kind.names)
    return sieved(False).union(doubtful).drop("key").toDF(*names)
