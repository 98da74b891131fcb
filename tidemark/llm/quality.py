"""Quality classifier: similarity-weighted votes of the nearest labelled documents in a latent space.

A bounded, balanced sample of labelled documents is turned into hashed feature counts: words, runs of
punctuation, upper-case words, and how much the text repeats itself. Features are weighted by rarity and
by how well they tell the labels apart, and a truncated singular value decomposition gives the latent
space. The sample's unit vectors (bounded: about 1.3 MB) travel to all tasks, where every document is
projected and compared with all of them in blocks of exact products; its nearest neighbours vote with
the fourth power of their similarities as weights, so that the nearest count most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, narrow
from tidemark.llm.textvec import chunks, counts, hashes, mix, spans, tables, words


LOW48 = np.uint64((1 << 48) - 1)


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, feature) with counts, by row. A feature is a 48-bit hash."""
    n = len(offs) - 1
    row, h = words(data, offs)
    lower, word = tables()
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    s, e, prow = spans(~word[data] & ~space[data], offs)
    punct = mix(hashes(data, s, e) ^ np.uint64(1))
    upper = (data >= 65) & (data <= 90)
    us, ue, urow = spans(upper, offs)
    shout = (ue - us) >= 4
    extra = [np.bincount(urow[shout], minlength=n)]
    # how much repeats: the share of words that are new, in eighths
    drow, _, times = counts(row, h)
    new, all_ = np.bincount(drow, minlength=n), np.bincount(row, minlength=n)
    eighth = np.where(all_ > 0, new * 8 // np.maximum(all_, 1), 9)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, drow, times)
    share = np.where(all_ > 0, most * 8 // np.maximum(all_, 1), 9)
    size = np.minimum(np.log2(all_ + 1).astype(np.int64), 15)
    every = np.arange(n)
    special = lambda kind, x: mix((np.uint64(kind) << np.uint64(32)) + x.astype(np.uint64))
    loud = special(2, np.zeros(n, np.int64))  # once a row with shouted words, whose number is put in below
    rows = [every, row, prow, np.flatnonzero(extra[0]), every, every, every]
    keys = [np.zeros(n, np.uint64), h, punct, loud[extra[0] > 0], special(3, eighth * 16 + size // 2), special(4, share), special(5, size)]
    row, key, times = counts(np.concatenate(rows), np.concatenate(keys))
    if n:
        at = np.flatnonzero(key == loud[0] & LOW48)
        times[at] = extra[0][row[at]]
    return row, key.astype(np.int64), times


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column("doc_id").cast(pa.int64())
        for lo, hi, data, offs in chunks(b.column("text")):
            row, feature, n = features(data, offs)
            split = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=hi - lo)))).astype(np.int32))
            yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.ListArray.from_arrays(split, pa.array(feature)), pa.ListArray.from_arrays(split, pa.array(n.astype(np.int32)))], names=["doc_id", "keys", "counts"])


class Space:
    """keys: the features in use, sorted; basis: features x dimensions, weights included; vectors and label
    (0 or 1) of the labelled documents."""

    def __init__(self, keys: np.ndarray, basis: np.ndarray, label: np.ndarray) -> None:
        self.keys, self.basis, self.label, self.vectors = keys, basis, label, np.zeros((0, 0), np.float32)

    def embed(self, row: np.ndarray, feature: np.ndarray, n: np.ndarray, rows: int) -> np.ndarray:
        """Unit vectors; a row without known features is 0."""
        at = np.minimum(np.searchsorted(self.keys, feature), len(self.keys) - 1)
        ok = self.keys[at] == feature
        row, at, w = row[ok], at[ok], 1 + np.log(n[ok].astype(np.float32))
        out = np.zeros((rows, self.basis.shape[1]), np.float32)
        for i in range(0, len(row), 200_000):  # a block of products at a time
            j = min(len(row), i + 200_000)
            first = np.flatnonzero(np.concatenate(([True], row[i + 1 : j] != row[i : j - 1])))
            out[row[i:j][first]] += np.add.reduceat(self.basis[at[i:j]] * w[i:j, None], first, axis=0)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


class Model:
    """The labelled documents' ids, sorted, and a latent space for each of the two labels."""

    def __init__(self, ids: np.ndarray, quality: Space, toxic: Space) -> None:
        self.ids, self.quality, self.toxic = ids, quality, toxic


def sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """doc_id, quality, toxic of at most per_class documents of each pair of labels, those with the least hash."""
    here = narrow(docs, "doc_id", "text").filter("doc_id is not null and text is not null").select("doc_id")
    lab = narrow(labels, "doc_id", "quality", "toxic").filter("doc_id is not null and quality is not null and toxic is not null")
    lab = lab.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")).join(here, "doc_id", "left_semi")
    w = Window.partitionBy("quality", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    return lab.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= per_class).drop("nth")


def distinct(row: np.ndarray, key: np.ndarray, n: np.ndarray, rows: int, width: int = 512, alike: float = 0.7) -> np.ndarray:
    """Rows of which no earlier kept row is a near copy, by cosine of signed random sums of features."""
    _, number = np.unique(key, return_inverse=True)
    w = (1 + np.log(n)) * np.log(1 + rows / np.bincount(number))[number]
    h = mix(key.astype(np.uint64) ^ np.uint64(0xA5A5))
    x = np.bincount(row * width + (h % np.uint64(width)).astype(np.int64), np.where(h >> np.uint64(63), w, -w), rows * width).reshape(rows, width).astype(np.float32)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    kept = np.zeros(0, np.int64)
    for a in range(0, rows, 256):
        b = np.arange(a, min(a + 256, rows))
        b = b[(x[b] @ x[kept].T).max(axis=1, initial=0) < alike]
        near = np.tril(x[b] @ x[b].T, -1) >= alike
        ok = np.ones(len(b), bool)
        for i in range(len(b)):
            ok[i] = not (near[i] & ok).any()
        kept = np.append(kept, b[ok])
    return kept


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1200, dims: int = 64, most_features: int = 4096, pool: int = 2500, chance: tuple[float, float] = (2.0, 4.5), seed: int = 5) -> Model | None:
    """None where no labelled document is in docs. pool bounds the labelled documents that
    are looked at, of each pair of labels, and per_class those of them that vote, near copies of which are
    left out (else a text with many copies would seem to tell labels apart); chance: standard
    errors below which a feature hardly counts, for quality (which shows in many features) and toxicity (in few)."""
    few = cut(sample(docs, labels, pool))  # at most pool a pair of labels
    lab = {r["doc_id"]: (r["quality"], r["toxic"]) for r in few.collect()}
    if not lab:
        return None
    d = narrow(docs, "doc_id", "text").filter("text is not null").join(F.broadcast(few.select("doc_id")), "doc_id", "left_semi")
    got = d.mapInArrow(_count, "doc_id long, keys array<long>, counts array<int>").toArrow()
    ids, nth = np.unique(got.column("doc_id").to_numpy(), return_index=True)
    got = got.take(pa.array(nth))  # rows that share a doc_id: the first
    each = got.column("keys").combine_chunks().value_lengths().to_numpy()
    row = np.repeat(np.arange(len(ids)), each)
    feature, n = got.column("keys").combine_chunks().flatten().to_numpy(), got.column("counts").combine_chunks().flatten().to_numpy()
    y = np.array([lab[i] for i in ids.tolist()])
    kept = distinct(row, feature, n, len(ids))
    kind = 2 * y[kept, 0] + y[kept, 1]
    kept = np.sort(np.concatenate([kept[kind == k][:per_class] for k in np.unique(kind)]))
    new = np.full(len(ids), -1)
    new[kept] = np.arange(len(kept))
    ok = new[row] >= 0
    row, feature, n, ids, y = new[row[ok]], feature[ok], n[ok], ids[kept], y[kept]
    keys, number = np.unique(feature, return_inverse=True)
    df = np.bincount(number).astype(np.float64)
    spaces = []
    for k in (0, 1):
        # log odds of a feature by this label, pooled over the values of the other one, in standard errors
        up, down = np.zeros(len(keys)), np.zeros(len(keys))
        for other in (0, 1):
            part = y[:, 1 - k] == other
            pos, neg = part & (y[:, k] == 1), part & (y[:, k] == 0)
            na, nb = int(pos.sum()), int(neg.sum())
            if na and nb:
                a, b = (np.bincount(number[m[row]], minlength=len(keys)) for m in (pos, neg))
                z = np.log((a + 0.5) / (na - a + 0.5)) - np.log((b + 0.5) / (nb - b + 0.5))
                var = 1 / (a + 0.5) + 1 / (na - a + 0.5) + 1 / (b + 0.5) + 1 / (nb - b + 0.5)
                up, down = up + z / var, down + 1 / var
        apart = np.abs(up) / np.sqrt(np.maximum(down, 1e-9))
        top = np.argsort(-(apart * (df > 1)), kind="stable")[:most_features]
        top = np.unique(np.append(top[(df[top] > 0) & (apart[top] > chance[k])], 0))
        place = np.full(len(keys), -1)
        place[top] = np.arange(len(top))
        weight = (np.log(1 + len(ids) / df[top]) * np.maximum(apart[top] - chance[k], 0)).astype(np.float32)
        weight[top == 0] = 1.0  # feature 0, in every text: one that has no telling feature resembles others without any
        x = np.zeros((len(ids), len(top)), np.float32)
        ok = place[number] >= 0
        x[row[ok], place[number[ok]]] = (1 + np.log(n[ok])) * weight[place[number[ok]]]
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        rng = np.random.default_rng(seed)
        width = min(dims + 16, *x.shape)
        q = np.linalg.qr(x @ rng.standard_normal((x.shape[1], width), np.float32))[0]
        for _ in range(3):
            q = np.linalg.qr(x @ np.linalg.qr(x.T @ q)[0])[0]
        vt = np.linalg.svd(q.T @ x, full_matrices=False)[2]
        space = Space(keys[top], np.ascontiguousarray(vt[:dims].T * weight[:, None]), y[:, k].astype(np.float32))
        space.vectors = space.embed(row, feature, n, len(ids))
        spaces.append(space)
    return Model(ids, *spaces)


def votes(model: Model, space: Space, x: np.ndarray, ids: np.ndarray, k: int, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """The label's share among the k nearest labelled documents, weighted by similarity, and the similarity
    of the nearest. A labelled document has no vote on itself. nan: no similar neighbour."""
    share, top = np.full(len(x), np.nan), np.full(len(x), np.nan)
    own = np.searchsorted(model.ids, ids)
    own[own >= len(model.ids)] = 0
    is_own = model.ids[own] == ids
    k = min(k, len(model.ids))
    for a in range(0, len(x), block):
        sim = x[a : a + block] @ space.vectors.T
        r = np.flatnonzero(is_own[a : a + block])
        sim[r, own[a : a + block][r]] = -2
        least = np.partition(sim, sim.shape[1] - k, axis=1)[:, [sim.shape[1] - k]]
        w = np.where(sim >= least - 1e-5, np.maximum(sim, 0), 0) ** 4  # the nearest count most
        total = w.sum(axis=1)
        some = np.flatnonzero(total > 0)
        share[a + some] = (w[some] @ space.label) / total[some]
        top[a + some] = sim.max(axis=1)[some]
    return share, top


SCHEMA = "doc_id long, quality_score double, toxic_score double, similarity double, neighbours int, good boolean, toxic boolean, keep boolean"


def classify(docs: DataFrame, labels: DataFrame, neighbours: int = 25, per_class: int = 1200, dims: int = 64, good_from: float = 0.5, toxic_from: float = 0.5) -> DataFrame:
    """doc_id, quality_score, toxic_score (shares of the votes), similarity (of the nearest, in quality), neighbours,
    good (quality_score >= good_from), toxic (toxic_score >= toxic_from), keep (good and not toxic).

    A text without features in the model (empty, null), and every text where no labelled document is at
    hand, has null scores and is neither good nor toxic; keep is then true, as nothing speaks against it.
    Repeated rows are judged alike. Null doc_ids keep their rows. Conflicting labels of one doc_id count
    as low quality and as toxic. A neighbour's vote weighs the fourth power of its similarity. Very long texts are read whole. All that tie with the last neighbour vote. Other columns are ignored. An empty table gives no rows.
    """
    model = train(docs, labels, per_class, dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").cast(pa.int64())
            filled = ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            for lo, hi, data, offs in chunks(b.column("text")):
                q = t = s = np.full(hi - lo, np.nan)
                if model is not None:
                    row, feature, n = features(data, offs)
                    got = []
                    for space in (model.quality, model.toxic):
                        x = space.embed(row, feature, n, hi - lo)
                        x[offs[1:] == offs[:-1]] = 0
                        got.append(votes(model, space, x, filled[lo:hi], neighbours))
                    (q, s), (t, _) = got
                none = np.isnan(q) | np.isnan(t)
                good, toxic = np.where(none, False, q >= good_from), np.where(none, False, t >= toxic_from)
                k = 0 if model is None else min(neighbours, len(model.ids))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), *(pa.array(v, mask=none) for v in (q, t, s)), pa.array(np.where(none, 0, k).astype(np.int32)), pa.array(good), pa.array(toxic), pa.array(none | (good & ~toxic))],
                    names=["doc_id", "quality_score", "toxic_score", "similarity", "neighbours", "good", "toxic", "keep"],
                )

    return narrow(docs, "doc_id", "text").mapInArrow(run, SCHEMA)
