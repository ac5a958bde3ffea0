"""N-gram Jaccard join through count vectors.

A document's shingles are hashed into m groups; the group counts are its point.  Two sets that differ
in D shingles at most differ in D groups at most, so with more than D groups they hold the same
shingles in at least one: that group's content is the cell in which the pair meets.  Points that meet
are kept in a packed R-tree, where the sum of coordinate minima (of boxes, then of points) bounds the overlap from
above; the pairs that survive are verified on the words.  No threshold on group or cell sizes exists.

Cells travel packed: a task sorts the cells of some megabytes of text and sends each part of the cell space one
blob, with one member of each cell; what else the task holds of a cell it knows to be met without asking.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Ids, by_few_rows, discard, discard_part, drop_shuffles, lean, materialize, release, text_or_empty
from .components import components
from .textcols import MIX, SEQ, U, WHITE, chunks, mix, prefix, ranges, tokenize

#: Ratio of the sizes at the ends of a band; sets in one band have the same number of groups.
BAND = 1.4
#: Points in a leaf of the R-tree, and rows of a cell that one task compares with as many others.
LEAF, BLOCK = 32, 512
#: Cells by which a pair is given to one of the cells in which it meets.
LEAST = 8
#: Surviving pairs a row up to which a task's pairs are verified one by one, beyond it together in the task.
SPARSE = 16
#: Groups of a point where the cells of its band need fewer (4 times the largest size if that is less).
FINE = 256
#: Bytes of text, and rows, whose cells are packed together.
GATHER_BYTES, GATHER_ROWS = 3 << 20, 60_000
#: A cell is its part, LOW_BITS of a hash, and its band in the lowest BAND_BITS.
LOW_BITS, BAND_BITS = 40, 7
MOST_PARTS = 1 << 16


def needed(a, b, percent: int):
    """Least intersection of sets of sizes a and b with 100 * intersection >= percent * union."""
    return -((-percent * (a + b)) // (100 + percent))


class Bands:
    """Bands of set sizes and the groups of each."""

    def __init__(self, percent: int):
        if not 50 < percent <= 100:
            raise ValueError("percent must be above 50 and 100 at most")  # below, similar sets may share no group
        self.percent = percent
        ratio = max(BAND, 100 / percent + 0.01)
        edges = [1]
        while edges[-1] < 2**40:
            edges.append(max(edges[-1] + 1, math.ceil(edges[-1] * ratio)))
        self.edges = np.array(edges, np.int64)

    def of(self, n: int) -> list[int]:
        """The band of n, and the next if a set there can be similar to one of n."""
        k = int(np.searchsorted(self.edges, n, side="right")) - 1
        return [k] if 100 * n < self.percent * int(self.edges[k + 1]) else [k, k + 1]

    def differ(self, k: int, n):
        """Most shingles in which a set of size n differs from a similar one of band k."""
        return (n + np.minimum(100 * n // self.percent, self.edges[k + 1] - 1)) * (100 - self.percent) // (100 + self.percent)

    def groups(self, k: int) -> int:
        """Groups of band k: few, but so many that most sets of its largest size fill more groups than can differ."""
        most = int(self.edges[k + 1]) - 1
        least = int(self.differ(k, most)) + 1
        m = least
        while True:
            empty = math.exp(-most / m)
            if m * (1 - (1 - 1 / m) ** most) >= min(least + 2 * math.sqrt(m * empty * max(0.0, 1 - (1 + most / m) * empty)), most - 0.3):
                return m
            m += max(1, m // 64)


class Cells:
    """Cells and count vectors of many sets at once, band by band.

    ``cell``, ``owner``: the cells, and the set of each.  ``vectors``: (set, band, counts) rows.

    A set that fills more groups than can differ (a good one) has a group in common with any similar set of the band
    that is not empty.  One that fills fewer also sends the cells of a further hashing, and so on until it is good in
    one.  Of two sets the one that is good first shares that hashing with the other: no pair is lost, and no cell stands
    for emptiness.
    """

    def __init__(self, sets: list[np.ndarray], bands: Bands):
        by_band: dict[int, list[int]] = {}
        for i, s in enumerate(sets):
            for k in bands.of(len(s)) if len(s) else []:
                by_band.setdefault(k, []).append(i)
        cell, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        self.vectors: list[tuple[int, int, bytes]] = []
        for k, members in sorted(by_band.items()):
            m = bands.groups(k)
            self._add_vectors(sets, members, k, max(m, min(FINE, 4 * (int(bands.edges[k + 1]) - 1))))
            left, seed = np.array(members), 0
            while len(left):
                shingles = np.concatenate([sets[i] for i in left.tolist()])
                sizes = np.array([len(sets[i]) for i in left.tolist()])
                group = (mix(shingles + U((k + 1 + seed * 131) * MIX % 2**64)) % U(m)).astype(np.int64) + np.repeat(np.arange(len(left)) * m, sizes)
                counts = np.bincount(group, minlength=m * len(left))
                content = np.zeros(m * len(left), np.uint64)
                order = np.argsort(group, kind="stable")
                some = np.flatnonzero(counts)
                content[some] = np.add.reduceat(mix(shingles ^ U(SEQ))[order], np.append(0, np.cumsum(counts[some])[:-1]))
                place = mix(mix(content[some] + U(MIX) * (some % m).astype(np.uint64)) + U((k + 1 + 131 * seed) * SEQ % 2**64))
                cell.append((place & ~U((1 << BAND_BITS) - 1)) | U(k))
                owner.append(left[some // m])
                left, seed = left[(counts > 0).reshape(-1, m).sum(axis=1) <= bands.differ(k, sizes)], seed + 1
        self.cell, self.owner = np.concatenate(cell), np.concatenate(owner)

    def _add_vectors(self, sets: list[np.ndarray], members: list[int], k: int, groups: int) -> None:
        """Points of a band: small sets have as many groups as keep their shingles apart, which sharpens the bound."""
        step = max(1, (8 << 20) // groups)
        for at in range(0, len(members), step):
            some = members[at : at + step]
            shingles = np.concatenate([sets[i] for i in some])
            group = (mix(shingles ^ U((k + 1) * MIX % 2**64)) % U(groups)).astype(np.int64) + np.repeat(np.arange(len(some)) * groups, [len(sets[i]) for i in some])
            counts = np.minimum(np.bincount(group, minlength=groups * len(some)), 255).astype(np.uint8).reshape(-1, groups)
            self.vectors += [(i, k, c.tobytes()) for i, c in zip(some, counts, strict=True)]


def named_cells(cell: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(part, cell within 2**63) of 64-bit cells whose lowest bits are the band."""
    band = cell & U((1 << BAND_BITS) - 1)
    part = (cell >> U(64 - 16)) % U(parts)
    low = (cell >> U(BAND_BITS)) & U((1 << LOW_BITS) - 1)
    return part.astype(np.int64), (part << U(LOW_BITS + BAND_BITS) | low << U(BAND_BITS) | band).view(np.int64)


def _planes(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each number, first bytes first: the high bytes of sorted numbers compress well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width][:, ::-1].T).tobytes()


def _from_planes(raw: np.ndarray, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = raw.reshape(width, n)[::-1].T
    return out.view("<u8").ravel()


CELL_BYTES = (LOW_BITS + BAND_BITS + 7) // 8


def pack(cell: np.ndarray, key: np.ndarray) -> bytes:
    """One part's sorted cells, each with a key: cells and places of keys by bytes, then the distinct keys."""
    keys, at = np.unique(key, return_inverse=True)
    local = cell.view(np.uint64) & U((1 << (LOW_BITS + BAND_BITS)) - 1)
    # Bands are the lowest bits, so planes of the sorted rest stay sorted.
    return np.array([len(cell), len(keys)], "<u4").tobytes() + _planes(local, CELL_BYTES) + _planes(at, 2) + keys.astype("<i8").tobytes()


def unpack(raw: pa.Buffer, part: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(raw, np.uint8)
    n, k = data[:8].view("<u4").tolist()
    cell = _from_planes(data[8 : 8 + n * CELL_BYTES], n, CELL_BYTES)
    at = _from_planes(data[8 + n * CELL_BYTES : 8 + n * (CELL_BYTES + 2)], n, 2)
    keys = np.frombuffer(data[8 + n * (CELL_BYTES + 2) :].tobytes(), "<i8", k)
    return (cell | U(part << (LOW_BITS + BAND_BITS))).view(np.int64), keys[at]


def shingle_sets(part: pa.RecordBatch, column: int, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles; of all words where there are fewer."""
    w = tokenize(part.column(column), WHITE, lower=True)
    n = len(w.hash)
    size = np.diff(w.at)
    pre = prefix(w.hash, SEQ)
    end = np.repeat(w.at[1:], size)
    at = np.flatnonzero(np.arange(n) + k <= end)
    hashes = ranges(pre, at, at + k, SEQ)
    place = np.searchsorted(at, w.at)
    out = []
    for i, words in enumerate(size.tolist()):
        if words >= k:
            out.append(np.unique(hashes[place[i] : place[i + 1]]))
        elif words:
            out.append(ranges(pre, w.at[i : i + 1], w.at[i + 1 : i + 2], SEQ))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _key(s: np.ndarray) -> int:
    """One number for a set: equal sets have equal keys."""
    total = mix(np.array([int(np.sum(mix(s), dtype=np.uint64)), int(np.bitwise_xor.reduce(s)) if len(s) else 0, len(s)], np.uint64))
    return int(mix(np.array([(int(total[0]) * 3 + int(total[1]) * 5 + int(total[2]) * 7) % 2**64], np.uint64)).view(np.int64)[0])


def overlap_bound(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sums of coordinate minima of the rows of x and y; a count of 255 stands for any above it."""
    out = np.empty(len(x), np.int64)
    step = max(1, (4 << 20) // max(1, x.shape[1]))
    for i in range(0, len(x), step):
        low = np.minimum(x[i : i + step], y[i : i + step])
        out[i : i + step] = low.sum(axis=1, dtype=np.int64)
        if len(low) and low.max() == 255:
            out[i : i + step][(low == 255).any(axis=1)] = 2**40
    return out


class RTree:
    """A packed R-tree of count vectors: points ordered by size, LEAF to a leaf, with each leaf's upper corner."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        self.order = np.argsort(sizes, kind="stable")
        self.counts, self.sizes, self.labels = counts[self.order], sizes[self.order].astype(np.int64), labels[self.order]
        self.head = np.arange(0, len(sizes), LEAF)
        self.top = np.maximum.reduceat(self.counts, self.head, axis=0)
        self.least, self.most = np.minimum.reduceat(self.sizes, self.head), np.maximum.reduceat(self.sizes, self.head)

    def pairs(self, other: "RTree", percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions (in the two inputs) of points with different labels whose overlap can reach what their sizes need."""
        i, j = np.nonzero(needed(self.least[:, None], other.least[None, :], percent) <= np.minimum(self.most[:, None], other.most[None, :]))
        if self is other:
            i, j = i[i <= j], j[i <= j]
        near = overlap_bound(self.top[i], other.top[j]) >= needed(self.least[i], other.least[j], percent)
        for x, y in zip(i[near], j[near], strict=True):
            a, b = np.meshgrid(np.arange(self.head[x], min(self.head[x] + LEAF, len(self.sizes))), np.arange(other.head[y], min(other.head[y] + LEAF, len(other.sizes))), indexing="ij")
            a, b = a.ravel(), b.ravel()
            need = needed(self.sizes[a], other.sizes[b], percent)
            use = (need <= np.minimum(self.sizes[a], other.sizes[b])) & (self.labels[a] != other.labels[b])
            if self is other:
                use &= a < b
            a, b, need = a[use], b[use], need[use]
            hit = overlap_bound(self.counts[a], other.counts[b]) >= need
            yield self.order[a[hit]], other.order[b[hit]]


class Forest:
    """Union-find over keys."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[a] = b
        return a != b


def shingle_words(text: str, k: int) -> set[bytes]:
    """The shingles of a text themselves."""
    w = tokenize(pa.array([text]), WHITE, lower=True)
    words = [w.data[a:b].tobytes() for a, b in zip(w.start.tolist(), w.end.tolist(), strict=True)]
    if len(words) < k:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)}


class Verifier:
    """Whether two texts are similar enough: by hashed shingles, which never say no wrongly, then by the words."""

    def __init__(self, k: int, percent: int):
        self.k, self.percent = k, percent

    def similar(self, a: pa.Scalar, b: pa.Scalar, hashed_a: np.ndarray, hashed_b: np.ndarray) -> bool:
        need = needed(len(hashed_a), len(hashed_b), self.percent)
        if need > min(len(hashed_a), len(hashed_b)):
            return False
        both = np.concatenate([hashed_a, hashed_b])
        both.sort()
        if np.count_nonzero(both[1:] == both[:-1]) < need:
            return False
        x, y = shingle_words(a.as_py(), self.k), shingle_words(b.as_py(), self.k)
        return 100 * len(x & y) >= self.percent * len(x | y)

    def hashed(self, names: np.ndarray, texts: pa.Array) -> dict[int, np.ndarray]:
        """The hashed sets of texts by their names; texts of one name are equal in words."""
        known, first = np.unique(names, return_index=True)
        once = pa.RecordBatch.from_arrays([texts.take(pa.array(first))], ["text"])
        return dict(zip(known.tolist(), (s for part in chunks(once, 0) for s in shingle_sets(part, 0, self.k)), strict=True))


def _sent(a, b) -> tuple[int, int]:
    return int(max(a, b)), int(min(a, b))


class Gathered:
    """Some megabytes of documents: their keys, count vectors, cells by part, and what they show by themselves."""

    def __init__(self, k: int, percent: int, parts: int, id_type: pa.DataType):
        self.k, self.percent, self.parts, self.id_type = k, percent, parts, id_type
        self.docs, self.txt, self.keys, self.sizes, self.sets, self.texts = [], [], [], [], {}, {}
        self.bytes = self.rows = 0

    def add(self, part: pa.RecordBatch) -> None:
        sets = shingle_sets(part, 2, self.k)
        keys = [_key(s) for s in sets]
        for i, (key, s) in enumerate(zip(keys, sets, strict=True)):
            if len(s) and key not in self.sets:
                self.sets[key], self.texts[key] = s, part.column(2)[i]
        self.docs.append(part.column(0))
        self.txt.append(part.column(1))
        self.keys += keys
        self.sizes += [len(s) for s in sets]
        self.bytes += part.column(2).nbytes
        self.rows += part.num_rows

    def batches(self) -> Iterator[pa.RecordBatch]:
        """One row with the blobs alone (``kind`` 0), one with all else (1): the first are deleted when the cells have met."""
        names = np.array(list(self.sets), np.int64)
        found = Cells(list(self.sets.values()), Bands(self.percent))
        part, cell = named_cells(found.cell, self.parts)
        key = names[found.owner] if len(names) else np.zeros(0, np.int64)
        order = np.lexsort((key, cell))
        cell, key = cell[order], key[order]
        head = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])[: len(cell)])
        size = np.diff(np.append(head, len(cell)))
        many = np.repeat(size > 1, size)
        links = self._links(key[many], np.repeat(key[head], size)[many]) if many.any() else []
        # Parts are the high bits of cells, so each part's cells stand together.
        first, of = cell[head], cell[head] >> (LOW_BITS + BAND_BITS)
        limit = np.searchsorted(of, np.arange(self.parts + 1))
        blobs = [pack(first[a:b], key[head][a:b]) if b > a else None for a, b in zip(limit[:-1].tolist(), limit[1:].tolist(), strict=True)]
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        struct = lambda **c: one(pa.StructArray.from_arrays(list(c.values()), list(c)))
        columns = ["kind", "docs", "vectors", "met", "links", "blobs"]
        vectors = found.vectors
        sizes = [len(s) for s in self.sets.values()]
        rest = [
            struct(doc=pa.chunked_array(self.docs).combine_chunks(), txt=pa.chunked_array(self.txt).combine_chunks(), key=pa.array(self.keys, pa.int64()), n=pa.array(self.sizes, pa.int32())),
            struct(key=pa.array([names[v[0]] for v in vectors], pa.int64()), n=pa.array([sizes[v[0]] for v in vectors], pa.int32()), band=pa.array([v[1] for v in vectors], pa.int32()), counts=pa.array([v[2] for v in vectors], pa.binary())),
            struct(cell=pa.array(cell[many]), key=pa.array(key[many])),
            struct(a=pa.array([x[0] for x in links], pa.int64()), b=pa.array([x[1] for x in links], pa.int64())),
        ]
        blobs = one(pa.array(blobs, pa.binary()))
        kind = lambda k: pa.array([k], pa.int32())
        yield pa.RecordBatch.from_arrays([kind(0), *(pa.nulls(1, x.type) for x in rest), blobs], columns)
        yield pa.RecordBatch.from_arrays([kind(1), *rest, pa.nulls(1, blobs.type)], columns)

    def _links(self, key: np.ndarray, pivot: np.ndarray) -> list[tuple[int, int]]:
        """Links between sets and the pivot that they share most cells with."""
        apart = key != pivot
        pairs, shared = np.unique(np.stack([key[apart], pivot[apart]]), axis=1, return_counts=True)
        order = np.lexsort((-shared, pairs[0]))
        best = order[np.append(True, pairs[0][order][1:] != pairs[0][order][:-1])] if len(order) else order
        verifier, forest, out = Verifier(self.k, self.percent), Forest(), []
        for a, b in pairs[:, best].T.tolist():
            if forest.root(a) != forest.root(b) and verifier.similar(self.texts[a], self.texts[b], self.sets[a], self.sets[b]):
                forest.join(a, b)
                out.append(_sent(a, b))
        return out


def _gathered(k: int, percent: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            for part in chunks(batch, 2):
                now = now or Gathered(k, percent, parts, part.schema.field(0).type)
                now.add(part)
                if now.bytes >= GATHER_BYTES or now.rows >= GATHER_ROWS:
                    yield from now.batches()
                    now = None
        if now:
            yield from now.batches()

    return run


def _meetings(table: pa.Table) -> pa.Table:
    """(cell, key, pivot) of one part's cells that have more than one key; pivot is the least of them."""
    part = table.column("part")[0].as_py()
    both = [unpack(x.as_buffer(), part) for chunk in table.column("blob").chunks for x in chunk]
    cell, key = np.concatenate([x[0] for x in both]), np.concatenate([x[1] for x in both])
    del both, table
    order = np.lexsort((key, cell))
    cell = cell[order]
    key = key[order]
    del order
    new = np.append(True, (cell[1:] != cell[:-1]) | (key[1:] != key[:-1]))
    cell, key = cell[new], key[new]
    head = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    size = np.diff(np.append(head, len(cell)))
    keep = np.repeat(size > 1, size)
    out = pa.table({"cell": cell[keep], "key": key[keep], "pivot": np.repeat(key[head], size)[keep]})
    del cell, key, new, head, size, keep
    release()
    return out


PAIR = "a long, b long"


def _task_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Table]]:
    """Rows of one task (cell, lo, hi) after another, from rows sorted so.

    A task has 2 * BLOCK rows at most, so an unfinished one is kept until the next batch.
    """
    rest = None
    for batch in _with_end(batches):
        both = [x for x in (rest, batch) if x is not None]
        if not both:
            continue
        table = pa.Table.from_batches(both).combine_chunks()
        cell, lo, hi = (table.column(c).to_numpy() for c in ("cell", "lo", "hi"))
        new = np.append(True, (cell[1:] != cell[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]))
        head = np.append(np.flatnonzero(new), len(cell))
        done = len(head) - 1 if batch is None else len(head) - 2
        rest = table.take(pa.array(np.arange(head[done], len(cell)))).combine_chunks().to_batches()[0] if batch is not None else None
        yield [table.slice(head[i], head[i + 1] - head[i]) for i in range(done)]


def _near_pairs(task: pa.Table, points: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the task's pairs across components that its trees leave."""
    block, labels, sizes = (task.column(c).to_numpy() for c in ("block", "component", "n"))
    sides = [np.flatnonzero(block == x) for x in np.unique(block)]
    trees = [RTree(points[x], sizes[x], labels[x]) for x in sides]
    for x, y in trees[0].pairs(trees[-1], percent):
        yield sides[0][x], sides[-1][y]


def _points_of(task: pa.Table) -> np.ndarray:
    return _flat(task.column("counts").combine_chunks()).reshape(task.num_rows, -1)


def _least_of(task: pa.Table) -> np.ndarray:
    """The least open cells of each row, LEAST of them at most, filled up with -1."""
    column = task.column("least").combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.full((len(sizes), LEAST), -1, np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _first_meeting(a: np.ndarray, b: np.ndarray, cell: int) -> np.ndarray:
    """Which pairs are looked at in this cell: the least in which they meet, if their least cells show it, else every one.

    If two rows have a cell in common among their least ones, the least such is the least they have in common at all.
    """
    none = np.iinfo(np.int64).max
    first = np.full(len(a), none)
    for i in range(LEAST):
        same = (a[:, i : i + 1] == b).any(axis=1) & (a[:, i] >= 0)
        first = np.minimum(first, np.where(same, a[:, i], none))
    return (first == none) | (first == cell)


SURVIVOR = "cell long, lo int, hi int, key long, component long, other long"


def _survivors(percent: int, sparse: int):
    """What the trees of each task leave; needs no texts.

    A task with ``sparse`` pairs a row at most sends them as (key, other), so that a pair which meets in many tasks is verified
    once.  One with more sends its rows that are in a pair, to be verified together: so never more than a bounded number a row.
    """

    names = ["cell", "lo", "hi", "key", "component", "other"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tasks in _task_lists(batches):
            pairs, rows = [], []
            for task in tasks:
                if pa.compute.count_distinct(task.column("component")).as_py() < 2:
                    continue
                left, few, n = np.zeros(task.num_rows, bool), [], 0
                least, cell = _least_of(task), task.column("cell")[0].as_py()
                for x, y in _near_pairs(task, _points_of(task), percent):
                    own = _first_meeting(least[x], least[y], cell)
                    x, y = x[own], y[own]
                    left[x] = left[y] = True
                    n += len(x)
                    if n <= sparse * task.num_rows:
                        few.append((x, y))
                if n > sparse * task.num_rows:
                    rows.append(task.select(["cell", "lo", "hi", "key", "component"]).filter(pa.array(left)))
                elif n:
                    key = task.column("key").to_numpy()
                    a, b = (key[np.concatenate(side)] for side in zip(*few, strict=True))
                    pairs.append(np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1))
            if pairs:
                a, b = np.unique(np.concatenate(pairs, axis=1), axis=1)
                none = [pa.nulls(len(a), t) for t in (pa.int64(), pa.int32(), pa.int32(), pa.int64())]
                yield pa.RecordBatch.from_arrays([*none[:3], pa.array(a), none[3], pa.array(b)], names)
            if rows:
                dense = pa.concat_tables(rows)
                columns = [dense.column(c).combine_chunks() for c in names[:-1]]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(dense.num_rows, pa.int64())], names)

    return run


def _tree_links(k: int, percent: int):
    """Links from rows sorted by task.

    Pairs that the trees leave are verified here, best bound first, and pairs that links found so far connect
    are skipped: what comes out of a task is a forest over its rows.
    """
    verifier = Verifier(k, percent)

    def links(task: pa.Table, sets: dict[int, np.ndarray]) -> list[tuple[int, int]]:
        keys, labels = (task.column(c).to_numpy().tolist() for c in ("key", "component"))
        texts, points, forest = task.column("text").combine_chunks(), _points_of(task), Forest()
        out = []
        for x, y in _near_pairs(task, points, percent):
            order = np.argsort(-overlap_bound(points[x], points[y]), kind="stable")
            for i, j in zip(x[order].tolist(), y[order].tolist(), strict=True):
                if forest.root(labels[i]) != forest.root(labels[j]) and verifier.similar(texts[i], texts[j], sets[keys[i]], sets[keys[j]]):
                    forest.join(labels[i], labels[j])
                    out.append(_sent(keys[i], keys[j]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tasks in _task_lists(batches):
            if not tasks:
                continue
            rows = pa.concat_tables(tasks)
            sets = verifier.hashed(rows.column("key").to_numpy(), rows.column("text").combine_chunks())
            found = np.unique(np.array([x for task in tasks for x in links(task, sets)], np.int64).reshape(-1, 2), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], ["a", "b"])

    return run


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    for batch in batches:
        if batch.num_rows:
            yield batch
    yield None


def _verified(k: int, percent: int):
    """Pairs (a, b) whose texts are similar enough."""
    verifier = Verifier(k, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = batch.columns
            sets = verifier.hashed(np.concatenate([np.asarray(a), np.asarray(b)]), pa.concat_arrays([x, y]))
            keep = [i for i, (p, q) in enumerate(zip(a.to_pylist(), b.to_pylist(), strict=True)) if verifier.similar(x[i], y[i], sets[p], sets[q])]
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return run


def _flat(values: pa.Array) -> np.ndarray:
    """The bytes of a binary array without nulls, in its own memory."""
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(values.buffers()[2], np.uint8)[ends[0] : ends[-1]]


def classes(docs: DataFrame, k: int = 3, percent: int = 90, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, set_key.

    Words are lower-cased in A-Z only.  Sets are the distinct k-word shingles, or the whole sequence where a text
    has fewer words; two link when 100 * intersection >= percent * union; component_id is the least doc_id reachable.
    Null and empty texts have no shingles and link with nothing.  A null doc_id counts as larger than any other and
    comes back null (so does 2**63 - 1 among integers); ids other than integers order as strings; repeated rows, or rows
    with one id, are documents of their own that share what they are linked with; an empty table gives no rows.

    Equal sets are one node, known by a 64-bit hash.  Each node is tested against one node that it shares most cells with;
    what is then still in different components goes, with all pairs across components, through the R-tree.
    """
    ids = Ids(docs, id_col)
    Bands(percent)  # refuses a percentage here, not in a task
    tasks_ = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(MOST_PARTS, 2 * tasks_)
    base = docs.select(ids.encode().alias("doc"), F.xxhash64(text_or_empty(text_col)).alias("txt"), text_or_empty(text_col).alias("text"))
    schema = f"kind int, docs array<struct<doc:{ids.type},txt:long,key:long,n:int>>, vectors array<struct<key:long,n:int,band:int,counts:binary>>, met array<struct<cell:long,key:long>>, links array<struct<a:long,b:long>>, blobs array<binary>"
    both = materialize(base.mapInArrow(lean(_gathered(k, percent, parts)), schema), "jaccard-gathered", "kind")
    gathered = both.where("kind = 1")
    points = gathered.select(F.inline("docs"))
    nodes = points.where("n > 0").groupBy("key").agg(F.min(F.struct("doc", "txt")).alias("rep"))
    blobs = both.where("kind = 0").select(F.posexplode("blobs").alias("part", "blob")).where("blob IS NOT NULL")
    across = materialize(blobs.repartition(parts, "part").groupBy("part").applyInArrow(_meetings, "cell long, key long, pivot long"), "jaccard-across")
    discard_part(both, "kind=0")
    cell_keys = materialize(across.select("cell", "key").unionByName(gathered.select(F.inline("met"))).distinct(), "jaccard-cells")
    # Each node's best star, by the cells it shares.
    shared = across.where("key <> pivot").groupBy("key", "pivot").agg(F.count("*").alias("shared"))
    stars = materialize(shared.groupBy("key").agg(F.max(F.struct("shared", "pivot")).alias("best")).select(F.col("key").alias("a"), F.col("best.pivot").alias("b")), "jaccard-stars")
    wanted = cell_keys.select("key").distinct().join(nodes, "key").select("rep.doc", "rep.txt", "key")
    texts = materialize(base.join(wanted, ["doc", "txt"]).select("key", "text"), "jaccard-texts")
    drop_shuffles(docs.sparkSession)  # those of all texts, before those of the pairs' texts
    links = materialize(_check(stars, texts, k, percent).unionByName(gathered.select(F.inline("links"))).distinct(), "jaccard-links")
    discard(across, stars)
    now = materialize(components(links), "jaccard-components")
    # What is still open goes through the tree: in each cell all pairs across components, one cell for each set of nodes.
    placed, largest = _placed(cell_keys, now)
    state = placed.groupBy("cell").agg(*_signature())
    inside = placed.join(largest, ["cell", "component"]).groupBy("cell").agg(F.count("*").alias("inside"))
    state = state.join(inside, "cell").join(largest.withColumnRenamed("component", "main"), "cell").where("inside < size")
    open_ = state.groupBy("size", "sum", "xor").agg(F.min(F.struct("cell", "inside", "main")).alias("s")).select(F.col("s.cell").alias("cell"), F.col("s.main").alias("main"), F.ceil(F.col("s.inside") / F.lit(BLOCK)).cast("int").alias("main_blocks"), F.ceil((F.col("size") - F.col("s.inside")) / F.lit(BLOCK)).cast("int").alias("blocks"))
    open_ = materialize(open_, "jaccard-open")
    # First the counts alone; the texts then go only to rows that are in a pair which the trees leave.
    in_open = placed.join(open_, "cell").withColumn("band", _band())
    vectors = gathered.select(F.inline("vectors")).join(in_open.select("key", "band").distinct(), ["key", "band"], "left_semi").dropDuplicates(["key", "band"])
    vectors = materialize(vectors, "jaccard-vectors")
    drop_shuffles(docs.sparkSession)
    least = in_open.groupBy("key").agg(F.slice(F.array_sort(F.collect_set("cell")), 1, LEAST).alias("least"))  # a key's cells are bounded by its size
    rows = in_open.join(vectors, ["key", "band"]).join(least, "key")
    # Blocks of the largest component meet the blocks of the others, never each other.
    is_main = F.col("component") == F.col("main")
    rows = rows.withColumn("block", F.when(is_main, F.pmod(F.xxhash64("key"), "main_blocks")).otherwise(F.col("main_blocks") + F.pmod(F.xxhash64("key"), "blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.when(is_main, F.expr("sequence(main_blocks, main_blocks + blocks - 1)")).otherwise(F.expr("sequence(0, main_blocks + blocks - 1)"))))
    tasks = rows.select("cell", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "key", "component", F.col("n").cast("long").alias("n"), "counts", "least")
    near = materialize(_dealt(tasks, tasks_).mapInArrow(lean(_survivors(percent, SPARSE)), SURVIVOR), "jaccard-survivors")
    drop_shuffles(docs.sparkSession)
    pairs = near.where("other IS NOT NULL").select(F.col("key").alias("a"), F.col("other").alias("b")).distinct()
    dense = near.where("other IS NULL").drop("other")
    # One task for each set of rows left.
    state = dense.groupBy("cell", "lo", "hi").agg(*_signature())
    once = state.groupBy("size", "sum", "xor").agg(F.min(F.struct("cell", "lo", "hi")).alias("s")).select("s.cell", "s.lo", "s.hi")
    rows = dense.join(once, ["cell", "lo", "hi"]).withColumn("band", _band()).join(vectors, ["key", "band"]).join(texts, "key")
    tasks = rows.select("cell", "lo", "hi", F.lit(0).alias("block"), "key", "component", F.col("n").cast("long").alias("n"), "counts", "text")
    together = by_few_rows(_dealt(tasks, tasks_), _tree_links(k, percent), PAIR)
    more = materialize(together.unionByName(_check(pairs, texts, k, percent)).distinct(), "jaccard-more")
    final = materialize(components(links.unionByName(more)), "jaccard-components")
    named = nodes.join(final, F.col("key") == F.col("node"), "left").select("key", "rep.doc", F.coalesce("component", "key").alias("component"))
    least = materialize(named.groupBy("component").agg(F.min("doc").alias("least")), "jaccard-least")
    of_key = materialize(named.join(least, "component").select("key", "least"), "jaccard-classes")
    out = materialize(points.select("doc", "key", "n").join(of_key, "key", "left"), "jaccard-documents")
    discard(both, cell_keys, texts, links, now, placed, largest, open_, vectors, near, more, final, least, of_key)
    return out.select(ids.decode("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), ids.decode(F.coalesce(F.when(F.col("n") > 0, F.col("least")), F.col("doc"))).alias("component_id"), F.col("key").alias("set_key"))


def _band():
    return F.col("cell").bitwiseAND(F.lit((1 << BAND_BITS) - 1)).cast("int")


def _signature() -> list:
    """Aggregates that tell sets of keys apart."""
    return [F.count("*").alias("size"), F.sum(F.pmod(F.xxhash64("key"), F.lit(2**40))).alias("sum"), F.expr("bit_xor(xxhash64(key, 7))").alias("xor")]


def _dealt(tasks: DataFrame, parts: int) -> DataFrame:
    return tasks.repartition(parts, "cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi")


def _placed(cells_: DataFrame, now: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cell, key, component) with more than one component in the cell, and (cell, component) of its largest one."""
    placed = materialize(cells_.join(now, F.col("key") == F.col("node"), "left").select("cell", "key", F.coalesce("component", "key").alias("component")), "jaccard-placed")
    sizes = placed.groupBy("cell", "component").agg(F.count("*").alias("n")).groupBy("cell").agg(F.max(F.struct("n", "component")).alias("m"), F.count("*").alias("parts"))
    largest = materialize(sizes.where("parts > 1").select("cell", F.col("m.component").alias("component")), "jaccard-largest")
    return placed, largest


def _check(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of keys whose texts are similar enough."""
    side = lambda s: texts.select(F.col("key").alias(s), F.col("text").alias(f"text_{s}"))
    return by_few_rows(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b"), _verified(k, percent), PAIR)


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near copies: the one with the least id.

    Documents without words (null and empty texts) stay.  Rows with equal ids stay or go together, those without an id as
    well, so exact repeats of a row stay; columns may have any names; an empty table gives an empty table.
    """
    group = classes(docs, k, percent, id_col=id_col, text_col=text_col)
    gone = group.groupBy("doc_id").agg(F.bool_or(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("first")).where("NOT first").select(F.col("doc_id").alias("its_id"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(gone, F.col(f"row.`{id_col}`").eqNullSafe(F.col("its_id")), "left_anti").select("row.*")
