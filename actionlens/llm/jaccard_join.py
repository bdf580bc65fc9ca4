"""Exact n-gram Jaccard join as a metric-space join.

The distance is the Jaccard distance of distinct word-shingle sets; documents
link when ``100 * |x & y| >= percent * |x | y|``.  Documents with equal sets are
one class, so copies cost nothing beyond their own row.

1. *Singleton pivots.*  Shingles are ranked (frequent ones last, the others by
   hash).  A set may lose at most ``n - ceil(t n)`` shingles to a partner, so it
   is replicated to the regions of that many of its first shingles plus one:
   two linked sets meet in at least one region.  Where they meet first, the rest of
   both sets must still suffice for a link, so a place far down a set has small
   partners only; members without a partner that suits are dropped.  Plain document pivots cannot
   do this step: all but a few documents lie at distance ~1 from any pivot, and
   windows would replicate everything everywhere.
2. *Pivot distances.*  A set's counts in hash classes of shingles are its
   distances to as many pivots: 64, or for large sets the power of two from n / 8
   on (a class splits in two at the next power, so sets of unlike size are
   compared on the coarser classes).  By the triangle inequality two sets differ in at
   least the sum of their differences there; members of a region that this
   proves unlinked are separated.  A large region is split into Voronoi cells
   around leaders (radius R), and a member is replicated to every cell whose
   leader is within R plus the link distance.  Whatever shares a cell is one
   cluster (connected components over all regions).
3. *Recursive join.*  Each cluster's sets meet once and are joined exactly:
   documents as pivots, Voronoi cells by Jaccard distance, windows of twice the
   link distance, recursion on the cells, and all pairs compared in the leaves.
   A cluster of more than ``BLOCK`` classes or ``SHINGLES`` shingles is dealt out in
   pairs of blocks, so memory stays bounded.  Spanning links and each class's number
   of linked documents leave a task, never all pairs: a task marks its links in a
   table, so a pair that shares several cells counts once, and links inside
   a block count in the task of that block alone.

The ranking only decides how much work there is, not the result.  Null and
empty texts have an empty set and link with nothing; repeated rows and doc_ids
are copies of each other or not by their text alone; the smallest non-null
doc_id names a component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionlens.llm.common import documents, pin, unpin
from actionlens.llm.components import connected_components
from actionlens.llm.textops import distinct_per_row, lowered, mix, shingle_hash, slices, span_hash, words

CLASSES = 64            # least number of hash classes whose counts are the pivot distances (one byte each, cut at 255: still a lower bound)
LEVELS = 10             # 64 to 65,536 classes
FREQUENT = 1 << 16      # ranked shingles sent to the tasks (8 bytes each)
SEEN = 3                # times a shingle is met in one slice of text to be counted as frequent
LEAF = 64               # members compared directly
RUN = 2048              # members of a region compared directly by pivot distances
BLOCK = 2048            # classes of a cluster joined in one task, on average
SHINGLES = 1 << 22      # shingles of such a block (8 bytes each), on average

PROFILE = "doc_id long, n long, k1 long, k2 long, vec binary, shingle long, seen long"


class Sets:
    """Distinct shingles of the documents of one slice, with each document's class key."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, k: int) -> None:
        buf = lowered(buf)
        start, end, row = words(buf, off)
        self.hash, self.row = distinct_per_row(*shingle_hash(span_hash(buf, start, end), row, k))
        self.rows = len(off) - 1
        self.n = np.bincount(self.row, minlength=self.rows).astype(np.int64)
        self.first = np.cumsum(self.n) - self.n
        self.k1, self.k2 = (self._sum(mix(self.hash ^ np.uint64(salt))) for salt in (0x243F6A8885A308D3, 0x13198A2E03707344))

    def _sum(self, h: np.ndarray) -> np.ndarray:
        total = np.r_[np.uint64(0), np.cumsum(h)]
        return mix(total[self.first + self.n] - total[self.first] + self.n.astype(np.uint64)).view(np.int64)

    def vectors(self) -> list[bytes]:
        """Counts by hash class (uint8), as many classes as the size asks for."""
        classes = CLASSES << level(self.n)
        begin = np.cumsum(classes) - classes
        bits = np.log2(classes).astype(np.uint64)
        cell = begin[self.row] + (mix(self.hash ^ np.uint64(0xA4093822299F31D0)) >> (np.uint64(64) - bits[self.row])).astype(np.int64)
        flat = np.minimum(np.bincount(cell, minlength=int(classes.sum())), 255).astype(np.uint8)
        return [flat[i:i + c].tobytes() for i, c in zip(begin, classes)]


def level(n: np.ndarray) -> np.ndarray:
    """0 for 64 classes, 1 for 128, ...: at most eight shingles a class on average."""
    return np.clip(np.ceil(np.log2(np.maximum(n, 1) / (8 * CLASSES))), 0, LEVELS).astype(np.int64)


def _profile(docs: DataFrame, k: int) -> DataFrame:
    """A row a document (size, class key, pivot distances), and rows (shingle, seen) for shingles met often in a slice."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in PROFILE.split(", ")]
        for batch in batches:
            for a, b, buf, off in slices(batch.column("text")):
                s = Sets(buf, off, k)
                none = pa.nulls(b - a, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(s.n), pa.array(s.k1), pa.array(s.k2),
                                                  pa.array(s.vectors(), pa.binary()), none, none], names=names)
                h, seen = np.unique(s.hash, return_counts=True)
                h, seen = h[seen >= SEEN].view(np.int64), seen[seen >= SEEN]
                if len(h):
                    none = pa.nulls(len(h), pa.int64())
                    yield pa.RecordBatch.from_arrays([none] * 4 + [pa.nulls(len(h), pa.binary()), pa.array(h), pa.array(seen)], names=names)

    return documents(docs).mapInArrow(rows, PROFILE)


def kept_shingles(n: np.ndarray, percent: int) -> np.ndarray:
    """Regions a set of n shingles is replicated to: n - ceil(t n) + 1."""
    return n - -(-n * percent // 100) + 1


def largest_partner(n: np.ndarray, nth: np.ndarray, percent: int) -> np.ndarray:
    """Largest size of a set that may link with one of n shingles, if the nth (from 0) is the first they share.

    They share n - nth shingles at most, and a link of sizes n and m needs percent * (n + m) / (100 + percent).
    """
    return (n - nth) * (100 + percent) // percent - n


def reach(n: np.ndarray, nth: np.ndarray, percent: int) -> np.ndarray:
    """The largest partner's place among the sizes of partners, in 255ths, rounded up."""
    low, span = _partners(n, percent)
    return -((largest_partner(n, nth, percent) - low) * -255 // np.maximum(span, 1))


def reached(n: np.ndarray, reach: np.ndarray, percent: int) -> np.ndarray:
    """A largest partner that is not below the real one."""
    low, span = _partners(n, percent)
    return low + reach * span // 255


def _partners(n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Least size of a partner, and how much larger the largest is."""
    low = -(-n * percent // 100)
    return low, n * 100 // percent - low


def _regions(docs: DataFrame, k: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """(spot, k1, n): the regions of every class (once a slice); a spot is the shingle without its last byte, which
    holds the ``reach`` instead, so that a row has no further column."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, buf, off in slices(batch.column("text")):
                s = Sets(buf, off, k)
                _, first = np.unique(s.k1, return_index=True)
                new = np.zeros(s.rows, bool)
                new[first] = True
                keep = new[s.row]
                h, row = s.hash[keep], s.row[keep]
                at = np.searchsorted(by_hash, h)
                at[at == len(by_hash)] = 0
                rank = np.where(by_hash[at] == h, place[at] + 1, 0) if len(by_hash) else np.zeros(len(h), np.int64)
                order = np.lexsort((h, rank, row))
                h, row = h[order], row[order]
                n = np.bincount(row, minlength=s.rows)
                nth = np.arange(len(row)) - (np.cumsum(n) - n)[row]
                chosen = nth < kept_shingles(s.n, percent)[row]
                h, row, nth = h[chosen], row[chosen], nth[chosen]
                spot = h.view(np.int64) & ~255 | reach(s.n[row], nth, percent)
                yield pa.RecordBatch.from_arrays([pa.array(spot), pa.array(s.k1[row]), pa.array(s.n[row])], names=["spot", "k1", "n"])

    order = np.argsort(frequent.view(np.uint64))
    by_hash, place = frequent.view(np.uint64)[order], order[...]     # place: the rarest of the frequent ones first
    return documents(docs).mapInArrow(rows, "spot long, k1 long, n long")


def _runs(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)


def _by_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Sorted batches regrouped so that no run of equal keys is split."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        start = _runs(batch.column(key).to_numpy())
        if held and batch.column(key)[0].as_py() != held[-1].column(key)[-1].as_py():
            yield pa.Table.from_batches(held)
            held = []
        if len(start) > 1:
            yield pa.Table.from_batches([*held, batch.slice(0, int(start[-1]))])
            held = [batch.slice(int(start[-1]))]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def with_partner(region: np.ndarray, n: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Whether each member (sorted by region number and n) has another one of its region such that neither
    is larger than the other's ``most``."""
    if not len(n):
        return np.zeros(0, bool)
    base = region.astype(np.int64) * (int(max(n.max(), most.max())) + 1)
    largest = np.maximum.accumulate(base + most)                        # of the region's members so far, and the next to it
    before = np.r_[0, largest[:-1]]
    second = np.maximum.accumulate(np.maximum(base, np.minimum(before, base + most)))
    last = np.searchsorted(base + n, base + most, "right") - 1          # the last member that is not larger than ``most``
    own = (last >= np.arange(len(n))) & (largest[last] == base + most)
    return (last >= 0) & (np.where(own, second[last], largest[last]) >= base + n)


def _shared(regions: DataFrame, percent: int) -> DataFrame:
    """(shingle, k1) of the classes that have another one of their region that suits them in size and place.

    A class without one has no partner there at all, or shares an earlier shingle with it, and the
    pivot distances are only fetched for the others.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _by_runs(batches, "shingle"):
            h, k1, n, far = (t.column(c).to_numpy() for c in ("shingle", "k1", "n", "reach"))
            new = np.r_[True, (h[1:] != h[:-1]) | (k1[1:] != k1[:-1]) | (far[1:] != far[:-1])]
            h, k1, n, far = h[new], k1[new], n[new], far[new]
            some = with_partner(np.cumsum(np.r_[False, h[1:] != h[:-1]]), n, reached(n, far, percent))
            yield pa.RecordBatch.from_arrays([pa.array(h[some]), pa.array(k1[some])], names=["shingle", "k1"])

    shingle = F.shiftright("spot", 8)
    dealt = regions.repartition(shingle).select(shingle.alias("shingle"), "k1", "n", F.col("spot").bitwiseAND(255).alias("reach"))
    return dealt.sortWithinPartitions("shingle", "n", "k1", "reach").mapInArrow(rows, "shingle long, k1 long")


class Forest:
    """Union-find over class keys; yields star edges."""

    def __init__(self) -> None:
        self.up: dict = {}

    def find(self, x):
        path = []
        while (u := self.up.setdefault(x, x)) != x:
            path.append(x)
            x = u
        for p in path:
            self.up[p] = x
        return x

    def union(self, x, y) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)

    def stars(self) -> list[tuple]:
        return [(x, r) for x in self.up if (r := self.find(x)) != x]


def _join_region(n: np.ndarray, vec: list[bytes], key: list, percent: int, forest: Forest) -> None:
    """Unite the members of a region that pivot distances do not prove unlinked."""
    lev = level(n)
    for at in np.unique(lev):
        own, next_ = np.flatnonzero(lev == at), np.flatnonzero(lev == at + 1)       # partners differ by one level at most
        mine = np.concatenate([own[np.argsort(n[own], kind="stable")], next_[np.argsort(n[next_], kind="stable")]])
        rows = [np.frombuffer(vec[i], np.uint8).reshape(-1, 1 << int(lev[i] - at)).sum(1, dtype=np.int16) for i in mine]
        if len(rows) > 1:
            _join_level(n[mine], np.stack(rows), [key[i] for i in mine], len(own), percent, forest)


def _join_level(n: np.ndarray, vec: np.ndarray, key: list, own: int, percent: int, forest: Forest) -> None:
    """Members in ascending size; the first ``own`` are compared with all, the rest among themselves at their own level."""
    m = len(n)
    if m <= RUN:
        for i in range(own):
            hi = int(np.searchsorted(n, n[i] * 100 // percent, "right"))        # partners are at most n / t long
            if hi > i + 1:
                apart = np.abs(vec[i + 1:hi] - vec[i]).sum(1)
                for j in np.flatnonzero(apart * (100 + percent) <= (n[i + 1:hi] + n[i]) * (100 - percent)):
                    forest.union(key[i], key[i + 1 + int(j)])
        return
    left = np.ones(m, bool)
    for i in range(m):
        if left[i]:
            apart = np.abs(vec - vec[i]).sum(1)
            radius = int(n[i]) * (100 - percent) / percent / 2
            left &= ~(apart <= radius)
            for j in np.flatnonzero(apart <= radius + (n[i] + radius) * (100 - percent) / percent):
                forest.union(key[i], key[int(j)])


def _clusters(members: DataFrame, percent: int) -> DataFrame:
    """(u, v): star edges between classes that may link; members: shingle, k1, n, pivot distances."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for t in _by_runs(batches, "shingle"):
            h, k1, n = (t.column(c).to_numpy() for c in ("shingle", "k1", "n"))
            vec = t.column("vec").to_pylist()
            start = _runs(h)
            for a, b in zip(start, np.r_[start[1:], len(h)]):
                _join_region(n[a:b], vec[a:b], k1[a:b].tolist(), percent, forest)
            if len(forest.up) > 1 << 20:
                yield _edges(forest)
                forest = Forest()
        yield _edges(forest)

    def _edges(forest: Forest) -> pa.RecordBatch:
        e = forest.stars()
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in e], pa.int64()), pa.array([x for _, x in e], pa.int64())], names=["u", "v"])

    return members.repartition("shingle").sortWithinPartitions("shingle").mapInArrow(rows, "u long, v long")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """k1, k2, shingles (sorted, 8 bytes each) of every document with a set."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, buf, off in slices(batch.column("text")):
                s = Sets(buf, off, k)
                some = np.flatnonzero(s.n)
                blob = [s.hash[s.first[i]:s.first[i] + s.n[i]].tobytes() for i in some]
                yield pa.RecordBatch.from_arrays([pa.array(s.k1[some]), pa.array(s.k2[some]), pa.array(blob, pa.binary())], names=["k1", "k2", "shingles"])

    return documents(docs).mapInArrow(rows, "k1 long, k2 long, shingles binary")


class MetricJoin:
    """Exact links among sets held in one task, by recursive Voronoi partitioning with windows."""

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.sets, self.percent = sets, percent
        self.n = np.array([len(s) for s in sets], np.int64)
        self.eps = (100 - percent) / 100
        self.up = np.arange(len(sets))
        self.linked = np.zeros((len(sets), len(sets)), bool)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of sets a with sets b (where a is b, of different sets)."""
        pool, held = np.unique(np.concatenate([self.sets[i] for i in b]), return_counts=True)
        if a is b:
            pool = pool[held > 1]                           # shingles of one set alone add nothing
        else:
            pool = np.intersect1d(pool, np.concatenate([self.sets[i] for i in a]))
        out = np.zeros((len(a), len(b)), np.int64)
        for lo in range(0, len(pool), 4096):                # a slice of the shingles at a time bounds the matrices
            part = pool[lo:lo + 4096]
            out += (self._matrix(a, part) @ self._matrix(b, part).T).astype(np.int64)
        return out

    def _matrix(self, rows: np.ndarray, part: np.ndarray) -> np.ndarray:
        x = np.zeros((len(rows), len(part)), np.float32)
        for r, i in enumerate(rows):
            s = self.sets[i]
            s = s[np.searchsorted(s, part[0]):np.searchsorted(s, part[-1], "right")]
            at = np.searchsorted(part, s)
            x[r, at[part[at] == s]] = 1
        return x

    def compare(self, a: np.ndarray, b: np.ndarray) -> None:
        both = self.shared(a, b)
        union = self.n[a][:, None] + self.n[b][None, :] - both
        if a is b:
            np.fill_diagonal(both, 0)
        link = 100 * both >= self.percent * union
        self.linked[np.ix_(a, b)] |= link
        self.linked[np.ix_(b, a)] |= link.T
        for i in np.flatnonzero(link.any(1)).tolist():
            for r in np.unique(self.up[b[link[i]]]).tolist():       # most partners are united already
                x, y = self.find(a[i]), self.find(r)
                if x != y:
                    self.up[max(x, y)] = min(x, y)

    def linked_copies(self, copies: np.ndarray, side: np.ndarray) -> np.ndarray:
        """Documents (``copies`` a set) that each set links to; with two sides, those of the other side."""
        two = len(np.unique(side)) > 1
        return np.array([copies[(row & (side != mine)) if two else row].sum() for row, mine in zip(self.linked, side)], np.int64)

    def join(self, members: np.ndarray | None = None) -> "MetricJoin":
        members = np.arange(len(self.sets)) if members is None else members
        if len(members) <= LEAF:
            self.compare(members, members)
            return self
        pivots = members[:: max(1, len(members) // 16)][:16]
        both = self.shared(members, pivots)
        away = 1 - both / (self.n[members][:, None] + self.n[pivots][None, :] - both)
        near = away.min(1)
        cells = [members[away[:, p] <= near + 2 * self.eps + 1e-9] for p in range(len(pivots)) if (away.argmin(1) == p).any()]
        if sum(map(len, cells)) > 2 * len(members) or max(map(len, cells)) > 0.8 * len(members):
            for a in range(0, len(members), 4 * LEAF):      # too close together for cells: all blocks
                one = members[a:a + 4 * LEAF]
                self.compare(one, one)
                for b in range(a + 4 * LEAF, len(members), 4 * LEAF):
                    self.compare(one, members[b:b + 4 * LEAF])
            return self
        for cell in cells:
            self.join(cell)
        return self


def _link_clusters(sets: DataFrame, percent: int) -> DataFrame:
    """Star links (u, v) of the classes of each (cluster, pair of blocks), and the documents that u links to there."""

    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("node").sort_values("node")
        node, pair = group["node"].to_numpy(), group["bi"].iat[0] != group["bj"].iat[0]
        found = MetricJoin([np.frombuffer(b, np.uint64) for b in group["shingles"]], percent).join()
        root = np.array([found.find(i) for i in range(len(node))], np.int64)
        links = found.linked_copies(group["copies"].to_numpy(), group["b"].to_numpy())
        if pair and group["b"].nunique() == 1:          # the other block is empty: its links count in its own task
            links[:] = 0
        return pd.DataFrame({"u": node, "v": node[root], "links": links})

    return sets.groupBy("cluster", "bi", "bj").applyInPandas(join, "u string, v string, links long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links (other rows linked to it, copies included) of every row
    (k-word shingles; linked when 100 * shared >= percent * union)."""
    if percent < 50:
        raise ValueError("sets of one region are compared over one level of sizes: links need a similarity of 0.5 at least")
    node = F.concat_ws(":", F.lpad(F.hex("k1"), 16, "0"), F.lpad(F.hex("k2"), 16, "0"))
    profile = pin(_profile(docs, k), "join-profile")
    rows = profile.where(F.col("n").isNotNull()).select("doc_id", "n", "k1", "k2", "vec")
    counted = profile.where(F.col("shingle").isNotNull()).groupBy("shingle").agg(F.sum("seen").alias("seen"))
    top = counted.orderBy(F.desc("seen"), "shingle").limit(FREQUENT).collect()
    frequent = np.array([r["shingle"] for r in reversed(top)], np.int64)

    classes = pin(rows.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("first_doc"), F.max("n").alias("n"), F.max("vec").alias("vec"), F.count("*").alias("copies")), "join-classes")
    shared = pin(_shared(_regions(docs, k, percent, frequent), percent), "join-regions")
    members = shared.join(classes.select("k1", "n", "vec"), "k1")
    cluster_of = pin(connected_components(_clusters(members, percent)).select(F.col("node").alias("k1"), F.col("root").alias("cluster")), "join-clusters")
    unpin(shared)

    inside = pin(classes.join(cluster_of, "k1").select("k1", "k2", "n", "copies", "first_doc", "cluster"), "join-inside")
    size = inside.groupBy("cluster").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / SHINGLES)).cast("int").alias("blocks"))
    dealt = (inside.join(size, "cluster").withColumn("b", F.pmod(F.xxhash64("k1", "k2"), "blocks").cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("k1", "k2", "copies", "cluster", "b", F.least("b", "o").alias("bi"), F.greatest("b", "o").alias("bj")))
    wanted = inside.select("first_doc").distinct()
    text = documents(docs)
    fetched = text.join(wanted, text.doc_id.eqNullSafe(wanted.first_doc), "left_semi")
    sets = dealt.join(_sets(fetched, k), ["k1", "k2"]).select("cluster", "b", "bi", "bj", "copies", node.alias("node"), "shingles")
    links = pin(_link_clusters(sets, percent), "join-links")
    known = links.select(F.col("u").alias("node"), F.col("v").alias("root"), "links")
    if size.where("blocks > 1").limit(1).count():       # else a class is in one task
        known = connected_components(links).join(links.groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links")), "node")

    named = classes.select("k1", "k2", "copies", "first_doc", node.alias("node")).join(known, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    linked = (F.col("copies") - 1 + F.coalesce("links", F.lit(0).cast("long"))).alias("n_links")
    component = pin(named.join(least, "root").select("k1", "k2", "component_id", linked), "join-components")
    full = rows.where("n > 0").join(component, ["k1", "k2"])
    empty = rows.where("n = 0").withColumn("component_id", F.col("doc_id")).withColumn("n_links", F.lit(0).cast("long"))
    cols = ["doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links"]
    return full.select(*cols).unionByName(empty.select(*cols))
