"""Documents linked by the Jaccard similarity of their word n-grams: a size-aware heavy-light join.

Equal sets are one node from the start, so copies cost nothing further. Nodes are then split by the size of their sets:

* *Light* sets enumerate subsets of fixed size. Two sets of sizes x and y link exactly if they share a subset of ``overlap(x, y)``
  elements, so what meets in a subset is a link, and nothing is left to verify. Those that meet are linked to the smallest of
  them alone, which reaches all that any of them does.
* *Heavy* sets are put into inverted lists, one for an element and a level of sizes, and the lists are scanned. Elements have one order for all
  sets, rare ones first; two linked sets have their first common element near the begin of both, so a set is put into the lists of its first
  elements alone. Texts of one template that differ too much to link have their own elements there, and never meet.

The boundary is the size with the least cost for the small sets there are: rows of subsets against rows of lists and what
scanning the shared ones takes, from counts of these sets and their elements.

The order comes from counts of all elements, in a table of fixed size by hash; it need not be exact to be the same for all.

In each list every member is compared with a leader, and a member that cannot link with any leader yet becomes the next one;
links to leaders settle nearly everything. Members of one list that are still in different components are then compared
pair by pair, so no link between components is lost; pairs inside a component need none. Pairs are ruled out by size, by their
places in the list's order and by a parity bitmap, which bounds the difference of two sets from below, and are decided on the
sets themselves.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .shared import fitted, stored, unused
from .text import LOWER, flat, hashes, mixed, pieces, words

#: Bits of a parity bitmap; members of a list that are compared as one block.
BITS, BLOCK = 1024, 512
#: Largest set that may be light, and most subsets it may have.
SMALL, MOST_SUBSETS = 40, 1_000
#: Counters for the order of elements (a power of two), and the chunks and tasks in which they are added up.
COUNTERS, CHUNKS, MERGED = 1 << 20, 16, 16
_GOLD = np.uint64(0x9E3779B97F4A7C15)


class Threshold:
    """Integer arithmetic for ``100 * |A & B| >= percent * |A | B|``."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.starts = [1]  # of size levels

    def overlap(self, x, y):
        """Fewest common elements of linked sets of these sizes."""
        return -(-self.percent * (x + y) // (100 + self.percent))

    def partners(self, x: int) -> range:
        """Sizes of sets that can link with one of size x."""
        return range(max(1, -(-self.percent * x // 100)), 100 * x // self.percent + 1)

    def sizes(self, x: int, light: int) -> list[int]:
        """Sizes of the subsets by which a set of size x meets others up to ``light``; equal sets are one node and need none."""
        return sorted({self.overlap(x, y) for y in self.partners(x) if y <= light and (y != x or self.overlap(x, y) < x)} if x <= light else ())

    def subsets(self, x: int, light: int) -> int:
        return sum(comb(x, c) for c in self.sizes(x, light))

    def level(self, x: int) -> int:
        """The size level of a set: partners lie in its own level or a neighbouring one."""
        while self.starts[-1] <= x:
            self.starts.append(100 * self.starts[-1] // self.percent + 1)
        return bisect_right(self.starts, x) - 1

    def prefixes(self, x: int, light: int) -> list[tuple[int, int]]:
        """Levels and, for each, how many of a set's first elements have a list there that it must be in. Two sets meet at the
        higher of their levels; pairs up to ``light`` need no lists."""
        own, found = self.level(x), []
        for at in (own, own + 1):
            wanted = (y for y in self.partners(x) if max(self.level(y), own) == at and max(x, y) > light)
            least = next(wanted, None)
            if least is not None:
                found.append((at, x - self.overlap(x, least) + 1))
        return found

    def lists(self, x: int, light: int) -> int:
        return sum(k for _, k in self.prefixes(x, light))


def boundary(rule: Threshold, held: dict[int, tuple[int, float]]) -> int:
    """The largest light size with the least cost, in bytes moved. ``held`` has for each size the number of sets and the share
    of their elements that other small sets have too."""

    def cost(light: int) -> float:
        total = 0.0
        for n, (sets_, share) in held.items():
            total += sets_ * (24 * rule.subsets(n, light) + rule.lists(n, light) * (28 + share * (BITS // 8 + 28 + 16 * n)))
        return total

    able = [0]
    while able[-1] < SMALL and all(rule.subsets(n, able[-1] + 1) <= MOST_SUBSETS for n in range(1, able[-1] + 2)):
        able.append(able[-1] + 1)
    return min(reversed(able), key=cost)


def sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its word n-grams; the whole sequence if it has fewer words."""
    data = LOWER[data]
    starts, ends, of = words(data, offsets)
    h = hashes(data, starts, ends)
    grown = h.copy()
    for k in range(1, size):
        if len(h) > k:
            grown[:-k] = mixed(grown[:-k] * _GOLD + h[k:])
    out = []
    for a, b in zip(of[:-1].tolist(), of[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(grown[a : b - size + 1]))
        elif b > a:
            whole = mixed(h[a : a + 1] + np.array([b - a], np.uint64))
            for k in range(a + 1, b):
                whole = mixed(whole * _GOLD + h[k : k + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _identity(s: np.ndarray) -> int:
    """A node's id: a hash of the set."""
    total = np.add.reduce(mixed(s ^ _GOLD), keepdims=True) + mixed(np.array([len(s)], np.uint64))
    return int(mixed(total).view(np.int64)[0]) if len(s) else 0


def parity_bitmap(s: np.ndarray) -> bytes:
    return np.packbits(np.bincount((s >> np.uint64(7)).astype(np.int64) % BITS, minlength=BITS).astype(np.uint8) & 1).tobytes()


def counter(s: np.ndarray) -> np.ndarray:
    """The counter of each element."""
    return (mixed(s + _GOLD) >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def scanned(docs: DataFrame, size: int, key: str, text: str) -> DataFrame:
    """One reading of all texts: ``key, n_shingles, node`` of each row, with ``bitmap`` and, for small sets, ``small`` (the elements) where a
    task meets a node for the first time; and rows with ``task, chunk, counts``, each task's counts of the elements of its nodes."""
    kept = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    schema = kept.limit(0).selectExpr("key", "0L n_shingles", "0L node", "cast('' as binary) bitmap", "cast('' as binary) small", "0 task", "0 chunk", "cast('' as binary) counts").schema
    for field in schema:
        field.nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        total = np.zeros(COUNTERS, np.int64)
        kind = None
        for batch in pieces(batches, "body"):
            kind = batch.schema.field(0).type
            ids, bitmaps, smalls, fresh = [], [], [], []
            found = sets(*flat(batch.column(1)), size)
            for s in found:
                ids.append(_identity(s))
                new = len(s) > 0 and ids[-1] not in done
                if new:
                    done.add(ids[-1])
                    fresh.append(s)
                bitmaps.append(parity_bitmap(s) if new else None)
                smalls.append(s.tobytes() if new and len(s) <= SMALL else None)
            if fresh:
                total += np.bincount(counter(np.concatenate(fresh)), minlength=COUNTERS)
            none = pa.nulls(batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array(ids, pa.int64()), pa.array(bitmaps, pa.binary()), pa.array(smalls, pa.binary()), none, none, pa.nulls(batch.num_rows, pa.binary())], names=schema.names)
        if kind is not None:
            count, none = TaskContext.get().partitionId(), pa.nulls(CHUNKS, pa.int64())
            chunks = [x.astype(np.min_scalar_type(int(x.max()))).tobytes() for x in np.split(total, CHUNKS)]
            yield pa.RecordBatch.from_arrays([pa.nulls(CHUNKS, kind), none, none, pa.nulls(CHUNKS, pa.binary()), pa.nulls(CHUNKS, pa.binary()), pa.array([count] * CHUNKS, pa.int32()), pa.array(range(CHUNKS), pa.int32()), pa.array(chunks, pa.binary())], names=schema.names)

    return kept.mapInArrow(run, schema)


def _wide(counts: bytes) -> np.ndarray:
    """A chunk of counts, which are stored in as few bytes as the largest takes."""
    return np.frombuffer(counts, f"<u{len(counts) // (COUNTERS // CHUNKS)}").astype(np.int64)


def element_counts(scan: DataFrame) -> np.ndarray:
    """All tasks' counts added up, some tasks at a time and again, so that no group holds more than ``MERGED`` rows."""

    def added(table: pa.Table) -> pa.Table:
        total = sum(_wide(x) for x in table["counts"].to_pylist())
        return pa.table({"task": pa.array([table["task"][0].as_py() // MERGED], pa.int32()), "chunk": table["chunk"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

    rows, tasks = scan.where("chunk is not null").select("task", "chunk", "counts"), MERGED
    while tasks > 1:
        rows = stored(rows.groupBy("chunk", F.expr(f"task div {MERGED}")).applyInArrow(added, "task int, chunk int, counts binary"), "element-counts")
        tasks = rows.agg(F.coalesce(F.max("task"), F.lit(0))).first()[0] + 1
    total = np.zeros((CHUNKS, COUNTERS // CHUNKS), np.int64)
    for row in rows.collect():
        total[row.chunk] = _wide(row.counts)
    return np.minimum(total.ravel(), np.iinfo(np.uint32).max).astype(np.uint32)


def small_sets(nodes: DataFrame) -> dict[int, tuple[int, float]]:
    """For each size of the small sets their number, and the share of their elements that another one has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x, np.int64) for x in batch.column(0).to_pylist()]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat([len(x) for x in found], [len(x) for x in found]).astype(np.int32)), pa.array(np.concatenate(found))], names=["n", "element"])

    each = nodes.where("small is not null").select("small").mapInArrow(run, "n int, element long")
    spread = each.groupBy("element", "n").agg(F.count("*").alias("held"))  # a row for each size at most
    shared = spread.groupBy("element").agg(F.sum("held").alias("all"), F.collect_list(F.struct("n", "held")).alias("by"))
    by_size = shared.select("all", F.explode("by").alias("x")).groupBy(F.col("x.n").alias("n")).agg(F.sum("x.held").alias("rows"), F.sum(F.when(F.col("all") > 1, F.col("x.held")).otherwise(0)).alias("shared"))
    return {r.n: (r.rows // r.n, r.shared / r.rows) for r in by_size.collect()}


def light_links(nodes: DataFrame, rule: Threshold, light: int) -> DataFrame:
    """``a, b``: links between light sets, each to the smallest set that shares its subset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                subsets, size, n, of = [], [], [], []
                for node, packed in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    s = mixed(np.frombuffer(packed, np.uint64))
                    for c in rule.sizes(len(s), light):
                        chosen = np.array(list(combinations(range(len(s)), c)))
                        subsets.append(mixed(np.add.reduce(s[chosen], axis=1) * _GOLD + np.uint64(c)))
                        size.append(np.full(len(chosen), c, np.int32))
                        n.append(np.full(len(chosen), len(s), np.int32))
                        of.append(np.full(len(chosen), node, np.int64))
                if subsets:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in ([y.view(np.int64) for y in subsets], size, n, of)], names=["subset", "c", "n", "node"])

    rows = nodes.where((F.col("n") <= light) & F.col("small").isNotNull()).select("node", "small").mapInArrow(run, "subset long, c int, n int, node long")
    rows = stored(rows, "subsets")
    first = rows.groupBy("subset").agg(F.min(F.struct("n", "node")).alias("first"), F.count("*").alias("held")).where("held > 1").select("subset", "first")
    least = F.expr(f"({rule.percent} * (n + first.n) + {99 + rule.percent}) div {100 + rule.percent}")
    met = rows.join(first, "subset").where((F.col("node") != F.col("first.node")) & (least <= F.col("c")))
    return met.select(F.least("node", "first.node").alias("a"), F.greatest("node", "first.node").alias("b")).distinct()


def postings(docs: DataFrame, size: int, rule: Threshold, light: int, order, text: str) -> DataFrame:
    """``list_id, node, n, at``: the lists of every set that can have a heavy partner, one for each of its first elements and level, with the element's
    place. A task emits those of equal sets once."""
    prefixes: dict[int, list[tuple[int, int]]] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        often = order.value
        for batch in pieces(batches, text):
            lists, ids, sizes, places = [], [], [], []
            for s in sets(*flat(batch.column(0)), size):
                n = len(s)
                if n not in prefixes:
                    prefixes[n] = rule.prefixes(n, light) if n else []
                if prefixes[n] and (node := _identity(s)) not in done:
                    done.add(node)
                    first = s[np.argsort(often[counter(s)], kind="stable")]  # of equally frequent ones the lower hash comes first
                    for level, k in prefixes[n]:
                        lists.append(mixed(first[:k] + _GOLD * np.uint64(level)))
                        places.append(np.arange(k, dtype=np.int32))
                    ids.append(node)
                    sizes.append(n)
            if lists:
                each = [sum(k for _, k in prefixes[n]) for n in sizes]
                of, n = np.repeat(np.array(ids, np.int64), each), np.repeat(np.array(sizes, np.int32), each)
                at = np.concatenate(places)
                every = np.concatenate(lists).view(np.int64)
                for a in range(0, len(every), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(x[a : a + 50_000]) for x in (every, of, n, at)], names=["list_id", "node", "n", "at"])

    return docs.select(text).mapInArrow(run, "list_id long, node long, n int, at int")


def shared_lists(rows: DataFrame) -> DataFrame:
    """The rows of lists with two members at least. Lists come one after the other in a sorted partition and are passed on as they are read."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a row belongs to a shared list if its neighbour before or after has the same list and another node
        held = np.zeros((0, 4), np.int64)
        open_list = None  # the list of which earlier rows were passed on

        def settled(rows: np.ndarray, last: bool) -> np.ndarray | None:
            nonlocal held, open_list
            if not len(rows):
                return None
            fresh = np.ones(len(rows), bool)
            fresh[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
            rows = rows[fresh]
            cut = len(rows) if last else len(rows) - 1
            same = np.zeros(len(rows), bool)
            equal = rows[1:, 0] == rows[:-1, 0]
            same[1:] |= equal
            same[:-1] |= equal
            if open_list is not None:
                same |= rows[:, 0] == open_list
            out, held = rows[:cut][same[:cut]], rows[cut:]
            open_list = int(rows[cut - 1, 0]) if cut else open_list
            return out if len(out) else None

        def packed(rows: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array(rows[:, 2].astype(np.int32)), pa.array(rows[:, 3].astype(np.int32))], names=["list_id", "node", "n", "at"])

        for batch in batches:
            rows = np.column_stack([c.to_numpy() for c in batch.columns])
            if (out := settled(np.concatenate([held, rows]), False)) is not None:
                yield packed(out)
        if (out := settled(held, True)) is not None:
            yield packed(out)

    return rows.repartition(parts, "list_id").sortWithinPartitions("list_id", "node").mapInArrow(run, "list_id long, node long, n int, at int")


def described(docs: DataFrame, chosen: DataFrame, size: int, key: str, text: str) -> DataFrame:
    """``node, elements`` for the nodes of ``chosen`` (columns ``key, node``: one row of each node): their sets, made from the texts again."""
    own = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    mine = own.join(fitted(chosen.select("key").distinct()), own["key"].eqNullSafe(chosen["key"]), "left_semi").select("body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in pieces(batches, "body"):
            found = {i: s for s in sets(*flat(batch.column(0)), size) if (i := _identity(s)) not in done}
            done |= set(found)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([s.tobytes() for s in found.values()], pa.binary())], names=["node", "elements"])

    return mine.mapInArrow(run, "node long, elements binary").join(chosen.select("node"), "node", "left_semi").dropDuplicates(["node"])


class Members:
    """Rows of lists as arrays: ``list_id, node, n, at`` and bitmap words, with ``component`` if there is one."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        self.list, self.node, self.n, self.at = (column[x].to_numpy().astype(np.int64) for x in ("list_id", "node", "n", "at"))
        self.component = column["component"].to_numpy() if "component" in column else None
        self.maps = np.frombuffer(b"".join(column["bitmap"].to_pylist()), np.uint64).reshape(-1, BITS // 64)

    def may_link(self, rule: Threshold, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the pairs of rows can link."""
        total = self.n[i] + self.n[j]
        need = rule.overlap(self.n[i], self.n[j])
        # if it is the first common element of two linked sets, enough must be left from it on; if it isn't, the pair meets in the first one's list
        fits = (need <= np.minimum(self.n[i] - self.at[i], self.n[j] - self.at[j])).nonzero()[0]
        if self.component is not None:
            fits = fits[self.component[i[fits]] != self.component[j[fits]]]
        out = np.zeros(len(i), bool)
        for a in range(0, len(fits), 1 << 16):  # bounds the bitmaps' copies
            part = fits[a : a + (1 << 16)]
            apart = np.bitwise_count(self.maps[i[part]] ^ self.maps[j[part]]).sum(axis=1, dtype=np.int64)
            out[part[apart <= total[part] - 2 * need[part]]] = True
        return out


def _whole_lists(batches: Iterator[pa.RecordBatch], by: int, most: int) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Sorted rows in batches that end where a list (the first ``by`` columns) does, and whether the list goes on: one of more than ``most`` rows is cut."""
    held: list[pa.RecordBatch] = []

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(k).to_numpy() for k in range(by)]
        same = np.logical_and.reduce([k == k[-1] for k in keys])
        begin = batch.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if begin or held and any(held[-1].column(k)[-1].as_py() != keys[k][0] for k in range(by)):
            held.append(batch.slice(0, begin))
            held = [x for x in held if x.num_rows]
            yield joined(), False
            held = []
        held.append(batch.slice(begin))
        if sum(x.num_rows for x in held) > most:
            yield joined(), True
            held = []
    if held:
        yield joined(), False


def _pairs(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
    a, b = np.concatenate(left), np.concatenate(right)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def leader_pairs(members: DataFrame, rule: Threshold) -> DataFrame:
    """``a, b``: each member of a list with the first leader that it can link with. ``members``: ``list_id, node, n, at, bitmap``.

    All lists of a batch are worked on together, a leader of each in turn. Of a list that spans batches the leaders are held, at most ``BLOCK`` of them, also for any other list;
    a member that fits none of those is left to :func:`rest_pairs`.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead: pa.RecordBatch | None = None  # leaders of the list that went on
        for batch, goes_on in _whole_lists(batches, 1, 10_000):
            first = 0
            if lead is not None and lead.column(0)[0].as_py() == batch.column(0)[0].as_py():
                batch, first = pa.Table.from_batches([lead, batch]).combine_chunks().to_batches()[0], lead.num_rows
            rows = Members(batch)
            left, right = [], []
            rest = np.arange(first, len(rows.node))
            leaders = list(range(first)) if rows.list[0] == rows.list[-1] else []  # of the last list
            for turn in range(BLOCK):
                if not len(rest):
                    break
                fresh = np.ones(len(rest), bool)
                fresh[1:] = rows.list[rest[1:]] != rows.list[rest[:-1]]
                if turn < first:  # the one list's held leaders come first
                    others = rest[rows.list[rest] == rows.list[0]]
                    chosen = np.full(len(others), turn)
                    away = rest[rows.list[rest] != rows.list[0]]
                else:
                    heads = rest[fresh]
                    leaders += heads[rows.list[heads] == rows.list[-1]].tolist()
                    each = np.diff(np.append(np.flatnonzero(fresh), len(rest)))
                    chosen, others, away = np.repeat(heads, each)[~fresh], rest[~fresh], rest[:0]
                fits = rows.may_link(rule, chosen, others)
                left.append(rows.node[chosen[fits]])
                right.append(rows.node[others[fits]])
                rest = np.sort(np.concatenate([others[~fits], away]))
            if left and sum(map(len, left)):
                yield _pairs(left, right)
            lead = batch.take(pa.array(leaders[:BLOCK])) if goes_on else None

    ordered = members.select("list_id", "node", "n", "at", "bitmap").repartition(parts, "list_id").sortWithinPartitions("list_id", "node")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def rest_pairs(members: DataFrame, bitmaps: DataFrame, rule: Threshold) -> DataFrame:
    """``a, b``: all pairs of a list's members in different components that can link. ``members``: ``list_id, node, n, at, component``; their
    ``bitmaps`` (``node, bitmap``) are joined to the rows that are left to compare.

    Blocks of a list's members are paired with each other, each pair of blocks a group of bounded size, and one block with
    all of its own; a list in one component has no rows here.
    """
    split = members.groupBy("list_id").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("held")).where("low != high")
    split = stored(split.select("list_id", F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks")), "split-lists")
    mine = members.join(fitted(split), "list_id").withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = mine.withColumn("with", other).select("list_id", F.least("block", "with").alias("x"), F.greatest("block", "with").alias("y"), "node", "n", "at", "component")
    placed = placed.join(bitmaps, "node").select("list_id", "x", "y", "node", "n", "at", "component", "bitmap")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in _whole_lists(batches, 3, 1 << 30):  # a group is two blocks at most
            rows = Members(batch)
            x, y = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            fresh = np.ones(len(x), bool)
            fresh[1:] = (rows.list[1:] != rows.list[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            ends = np.append(np.flatnonzero(fresh)[1:], len(x)).repeat(np.diff(np.append(np.flatnonzero(fresh), len(x))))
            after = ends - np.arange(len(x)) - 1  # rows of its group that follow each row
            a = 0
            while a < len(x):  # as many rows at once as have some thousand pairs
                b = max(a + 1, int(np.searchsorted(np.cumsum(after[a:]), 200_000, "right")) + a)
                i = np.repeat(np.arange(a, b), after[a:b])
                j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after[a:b]) - after[a:b], after[a:b])
                fits = rows.may_link(rule, i, j)
                if fits.any():
                    yield _pairs([rows.node[i[fits]]], [rows.node[j[fits]]])
                a = b

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartition(parts, "list_id", "x", "y").sortWithinPartitions("list_id", "x", "y")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, rule: Threshold, size: int, key: str, text: str) -> DataFrame:
    """The pairs that do link. Whole sets are made from the texts again, for the nodes of ``pairs`` alone: few members of
    lists are left by then."""
    pairs = stored(pairs, "candidates")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stored(nodes.select("key", "node").join(ends, "node", "left_semi"), "wanted")
    sets_of = stored(described(docs, wanted, size, key, text), "sets")
    mine = pairs.join(sets_of.select(F.col("node").alias("a"), F.col("elements").alias("first")), "a")
    both = mine.join(sets_of.select(F.col("node").alias("b"), F.col("elements").alias("second")), "b").select("a", "b", "first", "second")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                joint = np.sort(np.concatenate([x, y]))
                common = int((joint[1:] == joint[:-1]).sum())
                keep.append(100 * common >= rule.percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def links(docs: DataFrame, scan: DataFrame, rule: Threshold, size: int, key: str, text: str, light: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``a, b, side``: links between nodes that connect all of each component, found by ``light`` or ``heavy`` sets; and the components of them all."""
    nodes = scan.where("bitmap is not null").groupBy("node").agg(F.min("key").alias("key"), F.first("n_shingles").cast("int").alias("n"), F.first("bitmap").alias("bitmap"), F.first("small").alias("small"))
    nodes = stored(nodes, "nodes")
    if light is None:
        light = boundary(rule, small_sets(nodes))
    order = docs.sparkSession.sparkContext.broadcast(element_counts(scan))
    near = stored(light_links(nodes, rule, light), "light-links")
    lists = stored(shared_lists(postings(docs, size, rule, light, order, text)), "lists")
    bitmaps = nodes.select("node", "bitmap")
    lead = stored(verified(leader_pairs(lists.join(bitmaps, "node"), rule), docs, nodes, rule, size, key, text), "leader-links")
    parts = stored(components(near.union(lead)), "components")
    placed = lists.join(fitted(parts), "node", "left").withColumn("component", F.coalesce("component", "node"))
    more = stored(verified(rest_pairs(placed, bitmaps, rule), docs, nodes, rule, size, key, text), "rest-links")
    if not more.isEmpty():
        parts = stored(components(near.union(lead).union(more)), "components")
    return near.withColumn("side", F.lit("light")).union(lead.union(more).withColumn("side", F.lit("heavy"))), parts


def linked_documents(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key, n_shingles, component_id``, the smallest key reachable by links.

    Words are lower-cased (A to Z). Null and empty texts have an empty set and link with nothing: they are their own
    component. A null key is never a component's id; a set held by rows of null key alone links its copies alone if it isn't linked to others. Rows that repeat a
    text are copies and linked. An empty table gives an empty result; other columns are ignored, whatever their names. The
    result is exact but for collisions of 64-bit hashes.
    """
    scan = stored(scanned(docs, size, key, text), "scan")
    _, parts = links(docs, scan, Threshold(percent), size, key, text)
    rows = scan.where("chunk is null").select("key", "n_shingles", "node")
    full = rows.where("n_shingles > 0")
    # copies are combined before anything is joined, and components before their nodes
    own = stored(full.groupBy("node").agg(F.min("key").alias("low")), "node-keys")
    linked = own.join(parts, "node")
    low = stored(linked.groupBy("component").agg(F.min("low").alias("component_id")), "component-keys")
    moved = linked.join(fitted(low), "component").select("node", "component_id")
    ids = stored(own.join(moved, "node", "left").select("node", F.coalesce("component_id", "low").alias("component_id")), "component-ids")
    out = full.join(fitted(ids), "node").select("key", "n_shingles", "component_id").union(rows.where("n_shingles = 0").select("key", "n_shingles", "key"))
    return out.withColumnRenamed("key", key)


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose key is the smallest of their component, with all their columns, whatever their names.

    Rows of null key stay, and so do those with empty or null texts; rows that repeat the smallest key stay together.
    """
    at = unused(docs.columns, "lost_id")
    lost = stored(linked_documents(docs, size, percent, key, text).where(F.col("component_id") < F.col(key)).select(F.col(key).alias(at)).distinct(), "lost")
    return docs.join(fitted(lost), F.col(key) == F.col(at), "left_anti")
