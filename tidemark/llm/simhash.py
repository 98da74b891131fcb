"""SimHash near-duplicates: all pairs within a Hamming distance, by segments.

A text's fingerprint has 256 bits: for each bit, the majority of that bit among the hashes of its
distinct word pairs (its word, where it has one only). Pairs keep function words from making unrelated
texts of a language alike. Two fingerprints are near if they differ in at most 52 bits, and all such pairs are found,
at every size of table. Every fingerprint meets every other: many are split into blocks, each pair of blocks is a
meeting place, and where there are few, each pair has several, among which the segments are dealt. A place needn't compare all its
members with all. The bits are cut into segments, of 14 bits for some 200,000 members, and longer for more; by the pigeonhole
principle two near ones are within 2 bits or so in a segment, and (layout) within some more in the segments that follow it.
So members are grouped by the value of a segment, and a group is compared with those groups alone whose value is that near, by
one word of that segment and the next, and on all 256 bits if those are near as well. No key or index is part of what counts as near.
Equal fingerprints are collapsed before. What a meeting place verifies leaves it as a star of edges, so
a group of n copies costs n edges and not n * n; groups are the connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, narrow
from tidemark.llm.textvec import chunks, counts, mix, words

FP = ["f0", "f1", "f2", "f3"]
#: Fingerprints beyond which they are split into blocks; blocks at most, and where a place holds its pair of blocks.
CROWD, MOST_BLOCKS, SHIFT = 1 << 20, 2896, 40
#: Fingerprints beyond which they are compared by segments, and not all with all.
REFINE = 1 << 12
#: About as many places there are at least (of few blocks, each pair has several, among which the segments are dealt), and tasks at most.
LEAST_PLACES, MOST_TASKS = 24, 20_000
SALTS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89)


def features(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every pair of neighbouring words, or of the word of a row with one only."""
    if not len(row):
        return row, h
    same = row[1:] == row[:-1]
    alone = ~np.concatenate((same, [False])) & ~np.concatenate(([False], same))
    pair = mix(h[:-1] * np.uint64(3) + h[1:])[same]
    return np.concatenate((row[:-1][same], row[alone])), np.concatenate((pair, h[alone]))


def fingerprints(col) -> np.ndarray:
    """n x 4 uint64 of a string column. A text without words hashes as its bytes; so does ""."""
    out = []
    spread = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    for lo, hi, data, offs in chunks(col):
        n = hi - lo
        row, key, _ = counts(*features(*words(data, offs)))
        sums, total = np.zeros((n, 256), np.int32), np.zeros(n, np.int32)
        has = np.unique(row)
        if len(row):
            cuts = np.append(np.searchsorted(row, has), len(row))
            bits = np.empty((len(key), 4), np.uint64)
            for k, salt in enumerate(SALTS):
                bits[:, k] = mix(key ^ np.uint64(salt))
            # eight byte counters to a uint64, over runs of at most 255 pairs of one row
            runs = -(-np.diff(cuts) // 255)
            first = np.cumsum(runs) - runs
            start = np.repeat(cuts[:-1], runs) + 255 * (np.arange(int(runs.sum())) - np.repeat(first, runs))
            part = np.empty((len(start), 256), np.uint8)
            i = 0
            while i < len(start):  # about 50,000 pairs at a time
                j = max(i + 1, int(np.searchsorted(start, start[i] + 50_000)))
                x = spread[bits[start[i] : start[j] if j < len(start) else len(key)].view(np.uint8)]
                part[i:j] = np.add.reduceat(x, start[i:j] - start[i], axis=0).view(np.uint8)
                i = j
            sums[has] = np.add.reduceat(part, first, axis=0, dtype=np.int32)
            total[has] = np.diff(cuts)
        fp = np.packbits(2 * sums > total[:, None], axis=1, bitorder="little").view(np.uint64)
        for r in np.setdiff1d(np.arange(n), has):
            h = np.uint64(len(SALTS))
            for b in data[offs[r] : offs[r + 1]].tolist():
                h = np.uint64((int(h) ^ b) * 0x100000001B3 & (2**64 - 1))
            fp[r] = [mix(np.array([h ^ np.uint64(s)]))[0] for s in SALTS]
        out.append(fp)
    return np.concatenate(out) if out else np.zeros((0, 4), np.uint64)


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = fingerprints(b.column("text")).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), *(pa.array(fp[:, k]) for k in range(4))], names=["doc_id", *FP])


def segment(fp: np.ndarray, at: int, width: int) -> np.ndarray:
    """Bits `at` to `at` + `width` - 1 of n x 4 uint64, the first following the last; 64 at most."""
    w, o = divmod(at, 64)
    v = fp[:, w] >> np.uint64(o)
    if o + width > 64:
        v = v | fp[:, (w + 1) % 4] << np.uint64(64 - o)
    return v & np.uint64((1 << width) - 1)


def layout(n: int, other: int, most: int) -> list[tuple[int, int, int, int, int]]:
    """(first bit, width, bits that may differ, width of it with those that follow, bits of these that may differ) of the
    segments by which n fingerprints are compared with `other`.

    The segments share most + 1 among them. A pair that differs in no more than `most` bits has less than its share in
    some segment, and, from one such segment on, in each run of segments in a ring (else there were runs
    with all of their share, one after the other, all around). So whatever the number of segments, the same pairs are
    found; the one with the least estimated time is taken.
    """
    best, least = [], float("inf")
    for m in range(10, 33):
        (width, wide), (base, extra) = divmod(256, m), divmod(most + 1, m)
        ws, shares = [width + (k < wide) for k in range(m)] * 2, [base + (k < extra) for k in range(m)] * 2
        segs, at, cost = [], 0, 0.0
        for k, (w, t) in enumerate(zip(ws[:m], shares, strict=False)):
            if t:
                run = max(r for r in range(1, m + 1) if sum(ws[k : k + r]) <= 64)
                segs.append((at, w, t - 1, sum(ws[k : k + run]), sum(shares[k : k + run]) - 1))
                ball = sum(comb(w, i) for i in range(t))
                groups, met = min(n, 1 << w), other * ball / (1 << w)
                cost += 1e-3 * (1 << w) + groups * (80 + 0.02 * ball + 0.02 * met) + 0.006 * n * met  # microseconds, roughly
            at += w
        if cost < least:
            best, least = segs, cost
    return best


def whole(most: int) -> list[tuple[int, int, int, int, int]]:
    """A layout by which all are compared with all, word by word."""
    base, extra = divmod(most + 1, 4)
    shares = [base + (k < extra) for k in range(4)]
    return [(64 * k, 0, 0, 64, t - 1) for k, t in enumerate(shares) if t]


def masks(width: int, differ: int) -> np.ndarray:
    """All words of at most `differ` of `width` bits."""
    out = [np.zeros(1, np.int64)]
    for k in range(1, differ + 1):
        bits = np.array(list(combinations(range(width), k)), np.int64)
        out.append((1 << bits).sum(axis=1))
    return np.concatenate(out)


def key_rows(fp: np.ndarray, together: int) -> tuple[np.ndarray, np.ndarray]:
    """(row of fp, key): every row has every key, so that all rows meet; the segments are dealt out to the `together` keys."""
    return np.tile(np.arange(len(fp)), together), np.repeat(np.arange(together, dtype=np.int64), len(fp))


def places(row: np.ndarray, key: np.ndarray, rep: np.ndarray, crowded: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(row, place): a key is a place; a member of a crowded key goes to the places of its block with every block."""
    if not crowded:
        return row, key
    full = np.isin(key, np.fromiter(crowded, np.int64))
    rows, out = [row[~full]], [key[~full]]
    for k in np.unique(key[full]):
        r, n = row[key == k], crowded[int(k)]
        own = block_of(rep[r], n)[:, None]
        other = np.arange(n)
        pair = np.minimum(own, other) * n + np.maximum(own, other)
        rows.append(np.repeat(r, n))
        out.append((pair << SHIFT | k).ravel())
    return np.concatenate(rows), np.concatenate(out)


def block_of(rep: np.ndarray, n: int) -> np.ndarray:
    return (mix(rep.astype(np.int64).view(np.uint64)) % np.uint64(n)).astype(np.int64)


def _keys(together: int, crowded: dict[int, int], tasks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                fp = np.stack([part.column(c).to_numpy().view(np.uint64) for c in FP], axis=1)
                row, key = places(*key_rows(fp, together), part.column("rep").to_numpy(), crowded)
                lo, hi = np.divmod(key >> SHIFT, crowded.get(0, 1))
                task = ((hi * (hi + 1) // 2 + lo) * together + (key & (1 << SHIFT) - 1)) % tasks
                yield pa.RecordBatch.from_arrays([pa.array(task.astype(np.int32)), pa.array(key), part.column("rep").take(pa.array(row)), *(pa.array(fp[row, k].view(np.int64)) for k in range(4))], names=["task", "key", "rep", *FP])

    return run


def find(fp: np.ndarray, most: int, split: int | None, segs: list[tuple[int, int, int, int, int]], known: list[np.ndarray], tile: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of close_pairs in pieces, some more than once.
    Members that the labels in `known`, to which some may be added meanwhile, give one label needn't be compared."""
    end, begin = (len(fp), 0) if split is None else (split, split)
    if not end or begin == len(fp):
        return
    for at, width, differ, bits, allowed in segs:
        v = segment(fp, at, width).astype(np.int64)
        turn = masks(width, differ)
        right = np.argsort(v[begin:], kind="stable") + begin
        left = right if split is None else np.argsort(v[:end], kind="stable")
        window = segment(fp, at, bits)
        x, y = window[left], window[right]
        cuts = np.zeros((1 << width) + 1, np.int64)
        np.cumsum(np.bincount(v[right], minlength=1 << width), out=cuts[1:])
        lv = v[left]
        edge = np.flatnonzero(np.concatenate(([True], lv[1:] != lv[:-1], [True])))
        for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            near = turn ^ lv[lo]
            if split is None:  # each pair of values once
                near = near[near >= lv[lo]]
            start = cuts[near]
            n = cuts[near + 1] - start
            stop = np.cumsum(n)
            if not stop[-1]:
                continue
            col = np.repeat(start - stop + n, n) + np.arange(stop[-1])
            if known:
                one = known[-1][left[lo]]
                if (known[-1][right[col]] == one).all() and (known[-1][left[lo:hi]] == one).all():
                    continue
            for c in range(0, len(col), tile):
                part = col[c : c + tile]
                z, high = y[part], max(1, tile // len(part))
                for r in range(lo, hi, high):
                    hit = np.flatnonzero(np.bitwise_count(x[r : min(r + high, hi), None] ^ z) <= allowed)
                    if len(hit):
                        i, j = np.divmod(hit, len(part))
                        i, j = i + r, part[j]
                        if split is None:
                            i, j = i[i < j], j[i < j]
                        i, j = left[i], right[j]
                        k = np.bitwise_count(fp[i] ^ fp[j]).sum(axis=1, dtype=np.int64) <= most
                        yield np.minimum(i[k], j[k]), np.maximum(i[k], j[k])


def _sorted_pairs(found: Iterator[tuple[np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *(i * n + j for i, j in found)]))
    return pairs // max(n, 1), pairs % max(n, 1)


def close_pairs(fp: np.ndarray, most: int, split: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All i < j whose fingerprints differ in at most `most` bits; with split, those with i < split <= j."""
    return _sorted_pairs(find(fp, most, split, whole(most), []), len(fp))


def near_pairs(fp: np.ndarray, most: int, used: tuple[int, ...], refine: int, split: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """close_pairs, of more than `refine` members by segments. `used` has no effect: whatever segments a pair shares, it is found."""
    n, half = len(fp), len(fp) if split is None else split
    return _sorted_pairs(find(fp, most, split, layout(half, n - half or n, most) if n > refine else whole(most), []), n)


def labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member of each one's component."""
    lab = np.arange(n)
    while True:
        new = lab.copy()
        np.minimum.at(new, i, lab[j])
        np.minimum.at(new, j, lab[i])
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def joined(fp: np.ndarray, most: int, split: int | None, segs: list[tuple[int, int, int, int, int]], pending: int = 1 << 20) -> np.ndarray:
    """labels() of all pairs, of which about `pending` at most are held at once."""
    n = len(fp)
    known: list[np.ndarray] = []
    held, count = [], 0
    for i, j in find(fp, most, split, segs, known):
        if known:
            k = known[-1][i] != known[-1][j]
            i, j = i[k], j[k]
        if len(i):
            held.append((i, j))
            count += len(i)
        if count > pending:
            known[:] = [_merge(n, known, held)]
            held, count = [], 0
    return _merge(n, known, held)


def _merge(n: int, known: list[np.ndarray], held: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The labels of the pairs held and of the labels known."""
    old = known[-1] if known else np.arange(n)
    moved = np.flatnonzero(old != np.arange(n))
    i, j = (np.concatenate(x) for x in zip((old[moved], moved), *held, strict=True))
    return labels(n, i, j)


def _meet(most: int, together: int, crowded: dict[int, int], segs: list[tuple[int, int, int, int, int]]):
    """Sorted (place, rep, fingerprint) rows, each place in one partition -> edges (a, b)."""

    def grouped(place: int, rep: np.ndarray, fp: np.ndarray) -> np.ndarray:
        """The label of each member, where rep ascends."""
        n, pair, part = crowded.get(0, 1), place >> SHIFT, place & (1 << SHIFT) - 1
        own = segs[part::together]
        if pair // n == pair % n:
            return joined(fp, most, None, own)
        first = block_of(rep, n) == pair // n  # of two blocks, only pairs across
        o = np.argsort(~first, kind="stable")
        lab = o[joined(fp[o], most, int(first.sum()), own)]
        least = np.full(len(rep), len(rep))
        np.minimum.at(least, lab, o)
        out = np.empty_like(o)
        out[o] = least[lab]
        return out

    def solve(x: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key, rep = x[:, 0], x[:, 1]
        cuts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi - lo > 1:
                o = np.argsort(rep[lo:hi], kind="stable")
                r = rep[lo:hi][o]
                lab = grouped(int(key[lo]), r, fp[lo:hi][o])
                moved = np.flatnonzero(lab != np.arange(len(o)))
                a.append(r[lab[moved]])
                b.append(r[moved])
        return np.concatenate(a), np.concatenate(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([batch.column(c).to_numpy() for c in ("key", "rep", *FP)], axis=1)
            kept.append(x)
            if x[0, 0] == x[-1, 0] and (len(kept) == 1 or kept[0][0, 0] == x[0, 0]):
                continue  # one key so far
            whole = np.concatenate(kept)
            last = int(np.searchsorted(whole[:, 0], whole[-1, 0]))
            kept = [whole[last:]]
            a, b = solve(whole[:last, :2], whole[:last, 2:].view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        if kept:
            whole = np.concatenate(kept)
            a, b = solve(whole[:, :2], np.ascontiguousarray(whole[:, 2:]).view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges -> id, label: the least id of each one's component. Each round takes the least label
    of the neighbours and then that label's own label, until nothing changes."""
    e = cut(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct().toDF("id", "other"))
    lab = cut(e.groupBy("id").agg(F.min("other").alias("o")).select("id", F.least("id", "o").alias("label")))
    while True:
        seen = e.join(lab.toDF("other", "l"), "other").groupBy("id").agg(F.min("l").alias("l"))
        new = cut(lab.join(seen, "id").select("id", F.least("label", "l").alias("label"), F.col("label").alias("was")))
        up = new.select(F.col("id").alias("label"), F.col("label").alias("top"))
        new = cut(new.join(up, "label").select("id", F.col("top").alias("label"), "was"))
        if not new.filter("label <> was").limit(1).count():
            return new.select("id", "label")
        lab = new.select("id", "label")


def near_duplicates(docs: DataFrame, most: int = 52, together: int = 1, crowd: int = CROWD, refine: int = REFINE) -> DataFrame:
    """doc_id, duplicate_of: every document that is a near copy of a kept one; the least doc_id of a
    group is kept.

    Near: fingerprints differ in at most `most` of 256 bits, directly or through others. Texts without
    words (only punctuation, or "") are duplicates only of byte-equal texts. Null texts and null doc_ids
    take no part. Very long texts count whole. Rows that share a doc_id are one document (their texts count as near each other).
    Other columns are ignored. An empty table gives no rows. Whatever the size of the table, all pairs within `most` are found.
    `crowd`: fingerprints of a block at most; `refine`: fingerprints beyond which they are compared by segments;
    `together`: places of a pair of blocks at least. The result depends on none of these.
    """
    d = narrow(docs, "doc_id", "text").filter("doc_id is not null and text is not null")
    fps = cut(d.mapInArrow(_fingerprint, "doc_id long, f0 long, f1 long, f2 long, f3 long"))
    uniq = cut(fps.groupBy(*FP).agg(F.min("doc_id").alias("rep")))
    n = uniq.count()
    blocks = max(1, min(MOST_BLOCKS, -(-n // crowd)))
    side = -(-n // blocks)
    segs = layout(side, side, most) if n > refine else whole(most)
    together = max(together, min(len(segs), -(-LEAST_PLACES // blocks**2)))
    crowded = dict.fromkeys(range(together), blocks) if blocks > 1 else {}
    tasks = min(MOST_TASKS, blocks * (blocks + 1) // 2 * together)
    keys = uniq.mapInArrow(_keys(together, crowded, tasks), "task int, key long, rep long, f0 long, f1 long, f2 long, f3 long")
    keys = keys.repartitionById(tasks, "task").drop("task").sortWithinPartitions("key")
    edges = keys.mapInArrow(_meet(most, together, crowded, segs), "a long, b long")
    same = fps.join(uniq, FP).filter("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    lab = components(cut(edges.distinct()).union(same))
    return lab.filter("id <> label").select(F.col("id").alias("doc_id"), F.col("label").alias("duplicate_of"))


def keep_one(docs: DataFrame, most: int = 52) -> DataFrame:
    """docs without the near copies: one document of each group stays, all columns as they were.

    Of rows that share a doc_id one stays (the first by text; of equal rows any). Rows with a null text or doc_id
    stay. Very long texts count whole. An empty table gives no rows.
    """
    gone = cut(near_duplicates(docs, most).select(F.col("doc_id").alias("_tm_gone")))
    names = docs.columns
    tmp = docs.toDF(*[f"_tm{i}" for i in range(len(names))])
    ident = F.col(f"_tm{names.index('doc_id')}")
    repeated = cut(tmp.select(ident.alias("_tm_rep")).filter("_tm_rep is not null").groupBy("_tm_rep").count().filter("count > 1").select("_tm_rep"))
    left = tmp.join(gone, ident == F.col("_tm_gone"), "left_anti")
    if repeated.count():
        from pyspark.sql import Window

        w = Window.partitionBy(ident).orderBy(F.col(f"_tm{names.index('text')}"))
        again = left.join(repeated, ident == F.col("_tm_rep"), "left_semi").withColumn("_tm_nth", F.row_number().over(w)).filter("_tm_nth = 1").drop("_tm_nth")
        left = left.join(repeated, ident == F.col("_tm_rep"), "left_anti").unionByName(again)
    return left.toDF(*names)
