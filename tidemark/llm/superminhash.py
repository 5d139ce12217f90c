"""Near duplicates by SuperMinHash signatures, banding, exact verification and union-find.

Signature: an element of a document's shingle set visits the components in an order of its own, one per level,
and leaves ``level + fraction`` there if that is smaller. As no two levels of an element share a component, the
components are negatively correlated and the estimate varies less than with independent permutations. Levels stop
as soon as every component holds a value no later level can undercut: after one or two for long documents.

Documents with equal sets form a class first. Classes that share a band key are drawn together into groups, and
within a group all pairs of classes of like size are compared on their full sets, inside tasks of bounded size:
a group beyond the bound is dealt out by size class and hash, each pair of blocks being one task. A task emits a
spanning forest of the links it finds, not the pairs, so no group makes more rows than it has members per block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Scratch, components, small_batches
from .textbatch import mixed, shingle_sets, slices

COMPONENTS, ROWS = 127, 6
BANDS = COMPONENTS // ROWS
#: Links need 100 * intersection >= SIMILAR * union.
SIMILAR = 85
#: Shingles of a block of a task, and how many blocks a group is cut into before they grow towards the larger bound.
SMALL_BLOCK, LARGE_BLOCK, BLOCKS = 1 << 14, 1 << 18, 16
#: Bytes of a task's bit sets; beyond them pairs are counted from posting lists.
BIT_BYTES = 64 << 20
_FRACTION = np.uint64(32)


def signatures(sets: np.ndarray, at: np.ndarray, m: int = COMPONENTS) -> np.ndarray:
    """SuperMinHash signatures (documents x m) of ``sets[at[d]:at[d+1]]``; m is prime. Empty sets keep the maximum.

    The order of an element is an affine permutation of the residues modulo m drawn from its hash.
    """
    docs = len(at) - 1
    top = np.iinfo(np.uint64).max
    out = np.full(docs * m, top, np.uint64)
    owner = np.repeat(np.arange(docs), np.diff(at))
    element = sets
    stride = (element % np.uint64(m - 1)).astype(np.int64) + 1
    place = ((element >> np.uint64(24)) % np.uint64(m)).astype(np.int64)
    for level in range(m):
        if not len(element):
            break
        fraction = mixed(element + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> _FRACTION
        np.minimum.at(out, owner * m + place, (np.uint64(level) << _FRACTION) | fraction)
        open_docs = out.reshape(docs, m).max(axis=1) >= np.uint64(level + 1) << _FRACTION
        live = open_docs[owner]
        if not live.all():
            element, owner, stride, place = element[live], owner[live], stride[live], place[live]
        place = (place + stride) % m
    return out.reshape(docs, m)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One hash per band of ROWS components (documents x BANDS)."""
    parts = signature[:, : BANDS * ROWS].reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key


def _fingerprints(sets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits per set, equal for equal sets."""
    running = [np.concatenate(([np.uint64(0)], np.cumsum(x, dtype=np.uint64))) for x in (sets, mixed(sets + np.uint64(77)))]
    return tuple((r[at[1:]] - r[at[:-1]]).view(np.int64) for r in running)


def _lists(flat: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat.view(np.int64)))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, texts in slices(batch.column(1)):
            sets, at = shingle_sets(texts)
            one, two = _fingerprints(sets, at)
            keys = band_keys(signatures(sets, at))
            n = np.diff(at)
            filled = np.concatenate(([0], np.cumsum(np.where(n > 0, BANDS, 0))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(start, len(texts)), pa.array(n), pa.array(one), pa.array(two), _lists(keys[n > 0].ravel(), filled)],
                names=["doc_id", "n", "one", "two", "bands"],
            )


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, one, two, bands): set size, fingerprint and band keys of every document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_sketch, "doc_id long, n long, one long, two long, bands array<long>")


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, texts in slices(batch.column("text")):
            sets, at = shingle_sets(texts)
            one, two = _fingerprints(sets, at)
            rows = batch.slice(start, len(texts))
            out = pa.RecordBatch.from_arrays(
                [rows.column("rep"), rows.column("tasks"), _lists(sets, at)], names=["rep", "tasks", "shingles"]
            )
            same = (one == rows.column("one").to_numpy(zero_copy_only=False)) & (two == rows.column("two").to_numpy(zero_copy_only=False))
            yield out.filter(pa.array(same))


def _tasks(groups: DataFrame, scratch: Scratch, block: int) -> DataFrame:
    """(rep, tasks) of ``groups`` (rep, grp, n): the comparisons each class takes part in, and on which side.

    A group of at most ``block`` shingles is one task. A larger one is cut by size class, as linked sets differ
    by less than one class, and each size class by hash into blocks; blocks meet blocks of the same and the next.
    """
    size = F.least(F.greatest(F.sum("n") / BLOCKS, F.lit(block)), F.lit(max(block, LARGE_BLOCK)))
    whole = groups.groupBy("grp").agg((F.sum("n") > block).alias("large"), size.alias("block"))
    member = groups.join(whole, "grp").withColumn("c", F.floor(F.log("n") / math.log(100 / (SIMILAR - 0.1))).cast("int"))
    classes = member.where("large").groupBy("grp", "c").agg(F.ceil(F.sum("n") / F.max("block")).cast("int").alias("nb"))
    classes = scratch.keep(classes)
    for name, step in (("nb", 0), ("after", 1), ("before", -1)):
        member = member.join(classes.select("grp", (F.col("c") - step).alias("c"), F.col("nb").alias(name)), ["grp", "c"], "left")
    member = member.withColumn("i", F.expr("cast(pmod(xxhash64(rep), nb) as int)"))
    tasks = F.expr(
        """case when not large then array(struct(concat(grp, '') as task, 0 as side)) else concat(
            array(struct(concat_ws(':', grp, c, i) as task, 0 as side)),
            transform(filter(sequence(0, nb - 1), j -> j <> i),
                j -> struct(concat_ws(':', grp, c, least(i, j), c, greatest(i, j)) as task, if(i < j, 1, 2) as side)),
            if(after is null, array(), transform(sequence(0, after - 1), j -> struct(concat_ws(':', grp, c, i, c + 1, j) as task, 1 as side))),
            if(before is null, array(), transform(sequence(0, before - 1), j -> struct(concat_ws(':', grp, c - 1, j, c, i) as task, 2 as side)))
        ) end"""
    )
    return member.select("rep", tasks.alias("tasks"))


class _Forest:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def linked(sizes_a, sizes_b, common) -> np.ndarray:
    return 100 * common >= SIMILAR * (sizes_a + sizes_b - common)


def _counter(sets: list[np.ndarray], sizes: np.ndarray):
    """common(i, j): sizes of the intersections of set i with the sets j."""
    _, code, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = df[code] > 1  # a shingle of one set is in no intersection
    owner = np.repeat(np.arange(len(sets)), sizes)[shared]
    code = (np.cumsum(df > 1) - 1)[code[shared]]
    distinct = int((df > 1).sum())
    words = distinct // 64 + 1
    if len(sets) * words * 8 <= BIT_BYTES:
        bits = np.zeros((len(sets), words), np.uint64)
        np.bitwise_or.at(bits, (owner, code >> 6), np.uint64(1) << (code & 63).astype(np.uint64))
        step = max(1, (4 << 20) // words)

        def common(i, j):
            return np.concatenate([np.bitwise_count(bits[j[a : a + step]] & bits[i]).sum(axis=1, dtype=np.int64) for a in range(0, len(j), step)])

        return common
    holders = owner[np.argsort(code, kind="stable")]
    edge = np.concatenate(([0], np.cumsum(np.bincount(code, minlength=distinct))))
    begin = np.searchsorted(owner, np.arange(len(sets) + 1))

    def listed(i, j):
        lists = [holders[edge[c] : edge[c + 1]] for c in code[begin[i] : begin[i + 1]]]
        return np.bincount(np.concatenate(lists), minlength=len(sets))[j] if lists else np.zeros(len(j), np.int64)

    return listed


def _links(reps: np.ndarray, sides: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the linked pairs of a task: all pairs, or those of side 1 with side 2."""
    k, sizes = len(sets), np.array([len(s) for s in sets])
    crossed = bool(sides.any())
    forest, out = _Forest(k), []
    if k <= 6:
        for i in range(k):
            for j in range(i + 1, k):
                if (not crossed or sides[i] != sides[j]) and 100 * min(sizes[i], sizes[j]) >= SIMILAR * max(sizes[i], sizes[j]):
                    common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if linked(sizes[i], sizes[j], common) and forest.join(i, j):
                        out.append((int(reps[i]), int(reps[j])))
        return out
    order = np.argsort(sizes, kind="stable")
    sets, sizes, reps, sides = [sets[i] for i in order], sizes[order], reps[order], sides[order]
    common = _counter(sets, sizes)
    label = np.arange(k)
    for i in range(k - 1):
        end = int(np.searchsorted(sizes, sizes[i] * 100 // SIMILAR, "right"))
        j = np.arange(i + 1, end)
        j = j[label[j] != label[i]]
        if crossed:
            j = j[sides[j] != sides[i]]
        if len(j):
            for x in j[linked(sizes[j], sizes[i], common(i, j))]:
                if label[x] != label[i]:
                    out.append((int(reps[i]), int(reps[x])))
                    label[label == label[x]] = label[i]
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by task: each run of a task is compared as soon as it is complete."""

    def compared(rows):
        found = _links(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), [r[2] for r in rows])
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    task, rows = None, []
    for batch in batches:
        names, reps, sides = batch.column("task").to_pylist(), batch.column("rep").to_pylist(), batch.column("side").to_pylist()
        shingles = batch.column("shingles")
        flat = shingles.flatten().to_numpy().view(np.uint64)
        at = np.concatenate(([0], np.cumsum(shingles.value_lengths().to_numpy(zero_copy_only=False))))
        for k, name in enumerate(names):
            if name != task:
                if len(rows) > 1:
                    yield compared(rows)
                task, rows = name, []
            rows.append((reps[k], sides[k], flat[at[k] : at[k + 1]].copy()))
    if len(rows) > 1:
        yield compared(rows)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = SMALL_BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, class_id) of every row of ``docs``.

    Documents link when 100 * intersection >= SIMILAR * union of their distinct five-word shingles; ``component_id``
    is the smallest doc_id reachable, ``class_id`` the smallest with the same set. Null and blank texts have an empty
    set and link with nothing. Rows that repeat a doc_id count as one document. A row without a doc_id takes the
    component of its class, null if no document of the class has one. Other columns of ``docs`` are not looked at.
    Candidates come from BANDS bands of ROWS components: a pair just at the threshold is missed once in 10,000 times.
    """
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    sketched = scratch.keep(sketches(docs, doc_id, text))
    filled = sketched.where("n > 0")
    classes = scratch.keep(filled.groupBy("one", "two", "n").agg(F.min("doc_id").alias("rep")).where("rep is not null"))
    bands = filled.join(classes, [filled.doc_id == classes.rep, *(filled[c] == classes[c] for c in ("one", "two", "n"))], "left_semi")
    bands = scratch.keep(bands.select("doc_id", F.explode("bands").alias("band")))
    buckets = bands.groupBy("band").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z").select("band", "a")
    drawn = components(bands.join(buckets, "band").where("a <> doc_id").select("a", F.col("doc_id").alias("b")), scratch)
    groups = scratch.keep(classes.join(drawn, classes.rep == drawn.node).select("rep", F.col("component").alias("grp"), "n", "one", "two"))
    tasks = _tasks(groups.select("rep", "grp", "n"), scratch, block).join(groups.select("rep", "one", "two"), "rep").distinct()
    rows = docs.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).cast("string").alias("text")).join(tasks, "rep")
    held = rows.mapInArrow(_with_sets, "rep long, tasks array<struct<task:string,side:int>>, shingles array<long>")
    held = held.select("rep", F.explode("tasks").alias("t"), "shingles").select("rep", "t.task", "t.side", "shingles")
    links = held.repartition("task").sortWithinPartitions("task").mapInArrow(_verify, "a long, b long")
    found = components(links, scratch)
    labelled = classes.join(found, classes.rep == found.node, "left").select("one", "two", "n", "rep", F.coalesce("component", "rep").alias("component_id"))
    out = sketched.join(labelled, ["one", "two", "n"], "left")
    own = F.col("n") == 0
    component = F.when(own, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.when(own, F.col("doc_id")).otherwise(F.col("rep")).alias("class_id"),
    )
