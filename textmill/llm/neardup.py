"""Near-duplicates by an LSH forest over MinHash signatures.

Texts with equal word sequences are one node. Each node has ``TREES`` short MinHash signatures. For each tree, nodes are
dealt by their first ``MIN_DEPTH`` values and sorted by the whole signature. In this order, a node meets its
neighbours of the longest common prefix and, for every depth down to that prefix, the first node of the region of that
depth. So a region of many nodes is searched at the depth that its own signatures allow, the number of
candidates stays linear in the number of nodes, and no region is expanded into pairs.

Candidates are confirmed on full shingle sets (64-bit hashes cut to 48 bits; counts are exact). Links to the first
nodes of regions are confirmed first; of the neighbour pairs only those that would join two components are then
looked at, until none is left. Links are joined to components by star contraction.

Of a region of more nodes than a node's neighbours, not all pairs have been tried. Where such a region still has several
components, the nodes outside its main one are compared with all nodes of the region by an exact prefix-filtered
search: they are an index in blocks of bounded size, which the region's nodes pass by in slices. Each block with each slice is a task's cell, so no region is gathered
in one task, nothing goes through the driver, only links are returned, and regions do not meet each other's nodes.

A very large region (more rows than ``LEAST_LARGE``, and than rows / ``PARTS``) is dealt to several tasks by a hash of the node. Its nodes meet their neighbours
there and the first node of the whole region, by a broadcast of at most about ``PARTS`` rows; the exact search covers the rest.

At similarity 0.75, a pair shares a tree's first three values with probability 0.42, and none of 24 with two in a million; that is the chance that a pair is missed by
a region's exact search. A pair of a small region is always tried.

Cases: texts that are null or without words have no shingles and link with nothing; equal or repeated rows are
linked to each other; rows with one id and different texts are different documents, and each has its own component; a row with a null id
cannot be named by a component: it is linked with nothing, its component is null and it stays; ties in signatures are ordered by node, and do not change
links; a very long text has a set of as many shingles; further columns, whatever their names, are not read by ``forest_components`` and kept by ``deduplicated``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import base_documents, materialize, remove
from textmill.llm.graph import components

WIDTH = 5
TREES, DEPTH, MIN_DEPTH = 24, 5, 3
NEIGHBOURS = 8
NUMERATOR, DENOMINATOR = 75, 100
#: Word hashes kept by a Python worker.
CACHED_WORDS = 500_000
#: Bytes of the shingle sets of one block of a region's exact search, which a task holds.
SEARCH_BYTES = 32 << 20

#: Bits of a region's hash by which rows are counted, and what makes a region very large.
PART_BITS = 20
LEAST_LARGE, PARTS = 2_048, 20_000

_RNG = np.random.default_rng(20240601)
_MULTIPLY = _RNG.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)
_POSITION = _RNG.integers(1, 1 << 63, WIDTH, dtype=np.uint64) | np.uint64(1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_WORDS = _Hashes()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(text: str | None, width: int = WIDTH) -> tuple[np.ndarray, bytes]:
    """Sorted distinct hashes of the text's word shingles, and a 128-bit hash of its word sequence."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64), b""
    if len(_WORDS) > CACHED_WORDS:
        _WORDS.clear()
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    if len(words) < width:
        size = np.uint64(len(words))
        grams = np.array([_mix(np.array([np.bitwise_xor.reduce(h * _POSITION[: len(h)]) + size], np.uint64))[0]], np.uint64)
    else:
        n = len(h) - width + 1
        grams = h[:n] * _POSITION[0]
        for j in range(1, width):
            grams += h[j : j + n] * _POSITION[j]
        grams = _mix(grams)
    return np.unique(grams), xxhash.xxh3_128_digest(b" ".join(words))


def signature(shingles: np.ndarray) -> bytes:
    """``TREES * DEPTH`` minima as big-endian 32-bit integers, tree by tree."""
    out = np.empty(TREES * DEPTH, ">u4")
    for k in range(TREES * DEPTH):
        out[k] = ((shingles * _MULTIPLY[k] + _ADD[k]) >> np.uint64(32)).min()
    return out.tobytes()


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ns, seqs, sigs = [], [], []
        for text in batch.column(2):
            grams, seq = shingle_hashes(text.as_py())
            ns.append(len(grams))
            seqs.append(seq or None)
            sigs.append(signature(grams) if len(grams) else None)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(ns, pa.int64()), pa.array(seqs, pa.binary()), pa.array(sigs, pa.binary())], names=["id", "own", "n", "seq", "sig"])


def _parts(sigs: list[bytes]) -> np.ndarray:
    """Hashes of tree and first values, of each tree of each signature."""
    import xxhash

    size = 4 * DEPTH
    return np.array([xxhash.xxh3_64_intdigest(sig[t * size : t * size + 4 * MIN_DEPTH], t) >> 1 for sig in sigs for t in range(TREES)], np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << PART_BITS, np.int64)
    for batch in batches:
        total += np.bincount(_parts(batch.column(0).to_pylist()) >> (63 - PART_BITS), minlength=1 << PART_BITS)
    here = np.flatnonzero(total)
    yield pa.record_batch([pa.array(here), pa.array(total[here])], names=["bucket", "rows"])


def large_regions(nodes: DataFrame) -> dict[int, int]:
    """Parts of the hash with very large regions, and into how many each of these is dealt; at most ``PARTS``."""
    counts = materialize(nodes.select("sig").mapInArrow(_counts, "bucket long, rows long").groupBy("bucket").agg(F.sum("rows").alias("rows")), "regions")
    total = counts.agg(F.sum("rows")).first()[0] or 0
    most = max(LEAST_LARGE, total // PARTS)
    found = {r["bucket"]: -(-r["rows"] // most) for r in counts.where(F.col("rows") > most).collect()}
    remove(counts)
    return found


def _trees(large: dict[int, int], only: bool = False):
    """A row for each node and tree: where it is dealt, the tree's whole signature, node, size, and its region; ``only`` those of very large regions."""
    buckets, dealt = np.array(list(large), np.int64), np.array(list(large.values()), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 4 * DEPTH
        turns = np.ones(1 << PART_BITS, np.int64)  # made here: the driver sends the few large ones
        turns[buckets] = dealt
        for batch in batches:
            sigs = batch.column(2).to_pylist()
            part = _parts(sigs)
            key = np.array([sig[t * size : (t + 1) * size] for sig in sigs for t in range(TREES)], object)
            node, n = (np.repeat(batch.column(i).to_numpy(), TREES) for i in (0, 1))
            turn = turns[part >> (63 - PART_BITS)]
            spread = (_mix(node.astype(np.int64).view(np.uint64)) % turn.astype(np.uint64)) + np.uint64(1)
            deal = np.where(turn > 1, (_mix(part.view(np.uint64) ^ spread * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1)).view(np.int64), part)
            here = np.flatnonzero(turn > 1) if only else slice(None)
            yield pa.record_batch([pa.array(deal[here]), pa.array(key[here].tolist(), pa.binary()), pa.array(node[here]), pa.array(n[here]), pa.array(part[here])], names=["deal", "key", "node", "n", "part"])

    return run


TREE = "deal long, key binary, node long, n long, part long"


def region_firsts(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of each node of the very large regions and the first node of its region, from all their rows."""
    # The smallest node, not the first by signature: it is mostly the same in all trees, so these pairs are found once.
    first = rows.groupBy("part").agg(F.min(F.struct("node", "n")).alias("first"))
    pairs = rows.join(F.broadcast(first), "part").where(F.col("node") != F.col("first.node"))  # a row for each very large region
    fits = DENOMINATOR * F.least("n", "first.n") >= NUMERATOR * F.greatest("n", "first.n")
    return pairs.where(fits).select(F.least("node", "first.node").alias("a"), F.greatest("node", "first.node").alias("b"))


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs from rows sorted by deal, key and node; kind 0: with the first node of a region, 1: with others.

    Kind 2: part and node of each row of a region of more than ``NEIGHBOURS + 1``, whose pairs are not all tried.
    Held: the last row, one row for each depth, and the last ``NEIGHBOURS`` rows of the region.
    """
    last: tuple | None = None
    firsts: list[tuple[int, int]] = []
    recent: list[tuple[int, int]] = []
    size = 0  # rows of the region so far
    open_at = None  # index of the row that firsts and recent end with
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        deal, node, n, part = (batch.column(i).to_numpy() for i in (0, 2, 3, 4))
        key = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u4").reshape(rows, DEPTH)
        same = np.zeros((rows, DEPTH), bool)
        same[1:] = (key[1:] == key[:-1]) & (deal[1:] == deal[:-1])[:, None]
        if last is not None:
            same[0] = (key[0] == last[1]) & (deal[0] == last[0])
        depth = np.logical_and.accumulate(same, axis=1).sum(axis=1)
        a, b, kind = [], [], []
        for i in np.flatnonzero(depth >= MIN_DEPTH).tolist():
            if open_at != i - 1:  # the region begins with the row before
                before = (int(node[i - 1]), int(n[i - 1])) if i else (last[2], last[3])
                firsts, recent, size = [before] * (DEPTH + 1), [before], 1
            me, d = (int(node[i]), int(n[i])), int(depth[i])
            tried = set()
            main = (firsts[MIN_DEPTH], firsts[d]) if deal[i] == part[i] else ()  # region_firsts has those of a very large region
            for k, other in [(0, x) for x in main] + [(1, x) for x in firsts[MIN_DEPTH : d + 1]] + [(1, x) for x in recent]:
                if other[0] != me[0] and other[0] not in tried and DENOMINATOR * min(me[1], other[1]) >= NUMERATOR * max(me[1], other[1]):
                    tried.add(other[0])
                    a.append(min(me[0], other[0]))
                    b.append(max(me[0], other[0]))
                    kind.append(k)
            size += 1
            for other in [firsts[MIN_DEPTH], *recent, me] if size == NEIGHBOURS + 2 else [me] if size > NEIGHBOURS + 2 else []:
                a.append(int(part[i]))
                b.append(other[0])
                kind.append(2)
            firsts = [*firsts[: d + 1], *[me] * (DEPTH - d)]
            recent = [*recent[1 - NEIGHBOURS :], me]
            open_at = i
        open_at = -1 if open_at == rows - 1 else None
        last = (deal[-1], key[-1].copy(), int(node[-1]), int(n[-1]))
        yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(kind, pa.int32())], names=["a", "b", "kind"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and its shingle hashes, six bytes each, sorted."""
    for batch in batches:
        out = []
        for text in batch.column(1):
            grams = np.unique(shingle_hashes(text.as_py())[0] >> np.uint64(16))
            out.append(grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
        yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], names=["node", "grams"])


def _unpacked(grams: bytes) -> np.ndarray:
    wide = np.zeros((len(grams) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(grams, np.uint8).reshape(-1, 6)
    return wide.reshape(-1).view("<u8")


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = _unpacked(x.as_py()), _unpacked(y.as_py())
            x, y = (x, y) if len(x) < len(y) else (y, x)
            at = np.searchsorted(y, x)
            both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
            keep.append(DENOMINATOR * both >= NUMERATOR * (len(x) + len(y) - both))
        mask = pa.array(keep, pa.bool_())
        yield pa.record_batch([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("node").alias("b"), F.col("grams").alias("x"))
    right = sets.select(F.col("node").alias("a"), F.col("grams").alias("y"))
    return pairs.select("a", "b").join(left, "b").join(right, "a").select("a", "b", "x", "y").mapInArrow(_linked, "a long, b long")


def _prefix(grams: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Places of the rarest shingles, of which two linked sets share one at least."""
    n = len(grams)
    return np.lexsort((grams, seen))[: n + (-NUMERATOR * n) // DENOMINATOR + 1]


class _Index:
    """Nodes with their roots and shingle sets, found by the rarest shingles."""

    def __init__(self, nodes: list[int], roots: list[int], grams: list[bytes]):
        self.nodes, self.roots = nodes, roots
        sets = [_unpacked(g) for g in grams]
        self.sizes = np.array([len(x) for x in sets])
        self.start = np.cumsum([0, *self.sizes])
        self.grams, self.place, self.seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        keys, owners = [], []
        for i, x in enumerate(sets):
            own = self.place[self.start[i] : self.start[i + 1]]
            keys.append(own[_prefix(x, self.seen[own])])
            owners.append(np.full(len(keys[-1]), i))
        key, owner = np.concatenate(keys), np.concatenate(owners)
        self.owner = owner[np.argsort(key, kind="stable")]
        self.bounds = np.cumsum([0, *np.bincount(key, minlength=len(self.grams))])
        self.mark = np.zeros(len(self.grams), bool)
        self.up: dict[int, int] = {}

    def find(self, root: int) -> int:
        while (up := self.up.get(root, root)) != root:
            self.up[root] = self.up.get(up, up)
            root = up
        return root

    def links(self, node: int, root: int, grams: np.ndarray) -> Iterator[tuple[int, int]]:
        """Pairs with the node that join two components; roots joined by earlier calls count as one."""
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        hit = self.grams[at] == grams
        rare = _prefix(grams, np.where(hit, self.seen[at], 0))
        found = [self.owner[self.bounds[k] : self.bounds[k + 1]] for k in at[rare[hit[rare]]]]
        if not found:
            return
        near, n = np.unique(np.concatenate(found)), len(grams)
        least, most = np.minimum(self.sizes[near], n), np.maximum(self.sizes[near], n)
        self.mark[at[hit]] = True
        for i in near[DENOMINATOR * least >= NUMERATOR * most].tolist():
            x, y = self.find(root), self.find(self.roots[i])
            if x == y:
                continue
            both = int(np.count_nonzero(self.mark[self.place[self.start[i] : self.start[i + 1]]]))
            if DENOMINATOR * both >= NUMERATOR * (n + int(self.sizes[i]) - both):
                self.up[max(x, y)] = min(x, y)
                yield node, self.nodes[i]
        self.mark[at[hit]] = False


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) from rows (home, block, slice, kind, node, root, grams) sorted by cell (the first three) and kind.

    Kinds 0 and 1 are a cell's index, of kind 0 compared with each other as well; those of kind 2 pass by it. One cell's index is held.
    """
    cell, held, index, among = None, [], None, False

    def opened() -> tuple[_Index | None, list[tuple[int, int]]]:
        if not held:
            return None, []
        made = _Index(*map(list, zip(*held, strict=True)))
        return made, [p for node, root, grams in held for p in made.links(node, root, _unpacked(grams))] if among else []

    for batch in batches:
        found: list[tuple[int, int]] = []
        for home, block, part, kind, node, root, grams in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (home, block, part) != cell:
                if index is None and among:
                    found += opened()[1]
                cell, held, index, among = (home, block, part), [], None, kind == 0
            if kind < 2:
                held.append((node, root, grams))
                continue
            if index is None:
                index, own = opened()
                found += own
            if index is not None:
                found += index.links(node, root, _unpacked(grams))
        yield _pairs(found)
    if index is None and among:
        yield _pairs(opened()[1])


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _beside(rows: DataFrame, facts: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` (``total`` in all) with the columns of ``facts`` (key, rows: how many have it, ...); rows without facts go.

    Keys of very many rows, fewer than ``PARTS``, come to them by broadcast, so no such key is gathered in one task.
    """
    most = max(LEAST_LARGE, total // PARTS)
    many = facts.where(F.col("rows") > most).drop("rows")
    if not many.head(1):
        return rows.join(facts.drop("rows"), key)
    many = F.broadcast(many)  # each has more than total / PARTS rows
    few = rows.join(many.select(key), key, "left_anti").join(facts.where(F.col("rows") <= most).drop("rows"), key)
    return few.unionByName(rows.join(many, key))


def rest_of_regions(members: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame | None:
    """Links (a, b) between components of the regions in ``members`` (part, node), of which not all pairs were tried; None if there are none to try.

    Regions with one smallest node are searched together (they are mostly the same nodes, from several trees). Of such a group the nodes outside its main component
    are the index, in blocks of ``SEARCH_BYTES``, and all its nodes pass by each block, in slices; a block with a slice is a cell, and cells spread over the tasks.
    """
    rooted = members.join(roots, "node", "left").join(sets.select("node", "size"), "node").where("size > 0")
    rooted = materialize(rooted.select("part", "node", F.coalesce("root", "node").alias("root"), "size"), "regions")
    parts = rooted.groupBy("part", "root").agg(F.count(F.lit(1)).alias("rows"), F.min("node").alias("home"))
    parts = parts.groupBy("part").agg(F.sum("rows").alias("rows"), F.min("home").alias("home"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    parts = materialize(parts.select("part", "rows", "home"), "regions")
    if not parts.head(1):
        remove(rooted, parts)
        return None
    inside = _beside(rooted.select("part", "node", "root", "size"), parts, "part", parts.agg(F.sum("rows")).first()[0])
    inside = materialize(inside.groupBy("home", "node").agg(F.first("root").alias("root"), F.first("size").alias("size")), "inside")
    of_root = inside.groupBy("home", "root").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))
    main = F.max(F.struct("rows", "root", "bytes")).alias("main")
    homes = of_root.groupBy("home").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), main).withColumn("outer", F.col("bytes") - F.col("main.bytes"))
    blocks = F.ceil(F.col("outer") / SEARCH_BYTES)
    homes = homes.select("home", "rows", F.col("main.root").alias("main"), blocks.cast("int").alias("blocks"), "bytes", "outer")
    # A slice has LEAST_LARGE rows or so, but is not smaller than the block that it passes by.
    slices = F.greatest(F.lit(1), F.least(F.ceil(F.col("rows") / LEAST_LARGE), F.floor(F.col("blocks") * F.col("bytes") / F.col("outer"))))
    homes = materialize(homes.select("home", "rows", "main", "blocks", slices.cast("int").alias("slices")), "homes")
    cells = _beside(inside.select("home", "node", "root"), homes, "home", homes.agg(F.sum("rows")).first()[0])
    block, part = (F.pmod(F.xxhash64("node", F.lit(k)), F.col(n)).cast("int") for k, n in ((1, "blocks"), (2, "slices")))
    cell = lambda b, s, kind: F.struct(b.alias("block"), s.alias("slice"), kind.cast("int").alias("kind"))
    # With one block, its nodes are compared with each other in the first slice; with several, they pass by all blocks as the others do.
    among = lambda s: F.when((F.col("blocks") == 1) & (s == 0), 0).otherwise(1)
    index = F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda s: cell(block, s, among(s)))
    passing = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: cell(b, part, F.lit(2)))
    outside = F.col("root") != F.col("main")
    places = F.when(~outside, passing).when(F.col("blocks") == 1, index).otherwise(F.concat(index, passing))
    cells = cells.select("home", "node", "root", F.explode(places).alias("cell")).select("home", "cell.block", "cell.slice", "cell.kind", "node", "root")
    dealt = cells.join(sets.select("node", "grams"), "node").repartition("home", "block", "slice").sortWithinPartitions("home", "block", "slice", "kind", "node")
    links = materialize(dealt.select("home", "block", "slice", "kind", "node", "root", "grams").mapInArrow(_search, "a long, b long"), "links")
    remove(rooted, parts, inside, homes)
    return links


def _named(nodes: DataFrame) -> tuple[DataFrame, bool]:
    """``nodes`` with a name (node) for each: its smallest id, and where several have the same, a free number for all but one; whether there are such."""
    again = materialize(nodes.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.min("seq").alias("main")).where("rows > 1"), "names")
    if not again.head(1):
        return nodes.withColumn("node", F.col("id")), False
    low, high = nodes.agg(F.min("id"), F.max("id")).first()
    turn = F.monotonically_increasing_id()
    free = F.lit(high + 1) + turn if high < 1 << 62 else F.lit(low - 1) - turn
    rest = nodes.join(again.select("id", "main"), "id").where("seq != main").select("seq", free.alias("free"))
    rest = materialize(rest, "names")
    return nodes.join(rest, "seq", "left").withColumn("node", F.coalesce("free", "id")).drop("free"), True


def forest_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, own (hash of the text), n (size of the shingle set), component and root (a number for each component): a row for each row of ``docs``."""
    docs = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("own"), F.col(text).alias("text"))
    signed = materialize(docs.mapInArrow(_signed, "id long, own long, n long, seq binary, sig binary"), "signatures")
    alike = signed.where("n > 0 AND id IS NOT NULL").groupBy("seq").agg(F.min(F.struct("id", "own")).alias("one"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    nodes, renamed = _named(alike.select("seq", "one.id", "one.own", "n", "sig"))
    large = large_regions(signed.where("n > 0 AND id IS NOT NULL"))  # copies count as well; no shuffle of signatures
    rows = nodes.select("node", "n", "sig").mapInArrow(_trees(large), TREE)
    ordered = rows.repartition(F.col("deal")).sortWithinPartitions("deal", "key", "node")
    found = ordered.mapInArrow(_candidates, "a long, b long, kind int")
    wide = None
    if large:
        wide = materialize(nodes.select("node", "n", "sig").mapInArrow(_trees(large, only=True), TREE).select("part", "node", "n"), "wide")
        found = found.union(region_firsts(wide).withColumn("kind", F.lit(0))).union(wide.select("part", "node", F.lit(2)))
    found = found.groupBy("a", "b", (F.col("kind") == 2).alias("member")).agg(F.min("kind").alias("kind"))
    found = materialize(found.select("a", "b", "kind"), "candidates")
    if wide is not None:
        remove(wide)
    pairs = found.where("kind < 2")
    members = found.where("kind = 2").select(F.col("a").alias("part"), F.col("b").alias("node"))
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(members.select("node")).distinct()
    # The node's own text: an id may have several.
    wanted = wanted.join(nodes.select("node", "id", "own"), "node")
    sets = docs.join(wanted.hint("merge"), ["id", "own"]).select("node", "text").mapInArrow(_sets, "node long, grams binary").groupBy("node").agg(F.first("grams").alias("grams"))
    sets = materialize(sets.withColumn("size", F.length("grams").cast("long")), "shingles")
    first = components(confirmed(pairs.where("kind = 0"), sets))
    root = lambda side: first.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
    rest = pairs.where("kind = 1").join(root("a"), "a", "left").join(root("b"), "b", "left")
    rest = rest.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
    final = components(confirmed(rest, sets).union(first.select("node", "root")))
    more = rest_of_regions(members, final, sets)
    if more is not None:
        if more.head(1):
            before, final = final, components(more.union(final.select("node", "root")))
            remove(before)
        remove(more)
    remove(found, sets, first)
    whole = nodes.select("seq", "id", "node").join(final, "node", "left").select("seq", "id", F.coalesce("root", "node").alias("root"))
    if renamed:  # the smallest name need not be the smallest id
        whole = whole.join(whole.groupBy("root").agg(F.min("id").alias("component")), "root")
    else:
        whole = whole.withColumn("component", F.col("root"))
    out = signed.select("id", "own", "n", F.when(F.col("id").isNotNull(), F.col("seq")).alias("seq")).join(whole.drop("id"), "seq", "left")
    return out.select("id", "own", "n", F.coalesce("component", "id").alias("component"), "root")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` of which one stays for each component: the one of the smallest id. Rows with a null id or without words stay."""
    names = docs.columns
    held = docs.withColumnsRenamed({c: f"c{i}" for i, c in enumerate(names)})
    id_, value = (F.col(f"c{names.index(c)}") for c in (key, text))
    held = held.withColumns({"id": id_.cast("long"), "own": F.xxhash64(value)})
    found = forest_components(docs.where(F.col(key).isNotNull()), key, text).where("id = component")
    texts = found.where("n > 0").groupBy("root", "id", "own").agg(F.count(F.lit(1)).alias("rows")).groupBy("root").agg(F.min(F.struct("own", "id", "rows")).alias("one"))
    stay = materialize(texts.select("one.id", "one.own", "one.rows").union(found.where("n = 0").select("id", "own", F.lit(1)).distinct()), "kept")
    out = held.join(stay.select("id", "own"), ["id", "own"], "left_semi")
    again = stay.where("rows > 1")
    if again.head(1):  # rows with equal id and text are copies as well
        again = again.select("id", "own")
        one = out.join(again, ["id", "own"], "left_semi").dropDuplicates(["id", "own"])
        out = out.join(again, ["id", "own"], "left_anti").unionByName(one)
    out = out.unionByName(held.where(id_.isNull()))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def op10_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = forest_components(base_documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


#: DuckDB twin of op10_lsh_forest: exact set similarity through an inverted index.
OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + 4], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM w UNION SELECT e.b, r.root FROM r JOIN e ON r.doc_id = e.a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.root AS component_id, m.root = w.doc_id AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) m ON w.doc_id = m.doc_id
"""
