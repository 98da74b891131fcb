"""Exact top-k search by no-random-access aggregation.

Every query is a set of words; a document's score is the sum, over the words they share, of an integer
impact (BM25 times 1000, rounded down). Documents are indexed where they lie: each partition holds, for
each query word, the list of its documents by falling impact. The lists of a query are read in step from
the top. What has been read of a document is its lower bound; adding, for each list where it hasn't been
met, the impact last read there gives its upper bound, and the sum of all these last impacts bounds
documents not met at all. Reading stops when no outsider can reach the k-th lower bound; the lists are
then read on for the final scores of those that are left. No list is ever probed by document. The k best
of each partition meet in one small top-k by query.

Work on a partition doesn't depend on the size of the corpus, so that the whole follows it in proportion.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, narrow
from tidemark.llm.textvec import chunks, counts, words

K1, B = 1.2, 0.75


def distinct_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, word hash) of the distinct words of every text."""
    rows, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for lo, _, data, offs in chunks(texts):
        row, key, _ = counts(*words(data, offs))
        rows.append(row + lo)
        keys.append(key)
    return np.concatenate(rows), np.concatenate(keys)


def _index(vocab: np.ndarray):
    """Documents -> doc_id, length in words, and the numbers and frequencies of the vocabulary's words in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").cast(pa.int64())
            for lo, hi, data, offs in chunks(b.column("text")):
                row, h = words(data, offs)
                length = np.bincount(row, minlength=hi - lo)
                row, key, n = counts(row, h)
                at = np.minimum(np.searchsorted(vocab, key), max(0, len(vocab) - 1))
                hit = vocab[at] == key if len(vocab) else np.zeros(len(key), bool)
                row, at, n = row[hit], at[hit], n[hit]
                split = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=hi - lo)))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(length), pa.ListArray.from_arrays(split, pa.array(at.astype(np.int32))), pa.ListArray.from_arrays(split, pa.array(n.astype(np.int32)))],
                    names=["doc_id", "length", "terms", "tfs"],
                )

    return run


def _statistics(n_terms: int):
    """Document frequencies: (term, n); term -1 has the documents, -2 their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, length = np.zeros(n_terms, np.int64), 0, 0
        for b in batches:
            df += np.bincount(b.column("terms").flatten().to_numpy(), minlength=n_terms)
            docs += b.num_rows
            length += int(b.column("length").to_numpy().sum()) if b.num_rows else 0
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((at, [-1, -2]))), pa.array(np.concatenate((df[at], [docs, length])))], names=["term", "n"])

    return run


def impact(tf: np.ndarray, length: np.ndarray, idf: np.ndarray, mean: float) -> np.ndarray:
    return np.floor(1000.0 * idf * (tf * (K1 + 1.0)) / (tf + K1 * (1.0 - B + B * length / mean))).astype(np.int64)


def best(lists: list[tuple[np.ndarray, np.ndarray]], n: int, order: np.ndarray, k: int, step: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """The k documents with the highest sums, and the sums, by falling sum and rising order.

    lists: (documents, impacts) with impacts falling, above 0. Documents are numbers under n. Documents in no list
    aren't results. Reading proceeds in blocks that double, from step on.
    """
    lower = np.zeros(n, np.int64)
    depth = 0
    live: np.ndarray | None = None  # once outsiders are shut out: who is left
    deepest = max((len(d) for d, _ in lists), default=0)
    while True:
        to = depth + step
        for d, w in lists:
            if depth < len(d):
                lower[d[depth:to]] += w[depth:to]
        depth, step = to, to
        last = np.array([int(w[depth - 1]) if depth < len(w) else 0 for _, w in lists], np.int64)
        met = np.flatnonzero(lower) if live is None else live
        if len(met) >= k or not last.any():
            own = lower[met]
            kth = int(np.partition(own, len(own) - k)[len(own) - k]) if len(own) >= k else 0
            if last.sum() < kth or not last.any():
                # what lists already read of a document can't add; the prefixes double, so this reads each list twice at most
                unread = np.full(n, last.sum())
                for (d, _), x in zip(lists, last, strict=True):
                    if x:
                        unread[d[:depth]] -= x
                upper = own + unread[met]
                live = met[upper >= kth]  # an equal bound can still win by order
                if depth >= deepest or (len(live) <= k and (upper[upper >= kth] == lower[live]).all()):
                    break
    o = np.lexsort((order[live], -lower[live]))[:k]
    return live[o], lower[live[o]]


def _search(queries: list[tuple[int, np.ndarray]], idf: np.ndarray, mean: float, k: int):
    """queries: (number, terms)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(got: list[pa.RecordBatch]) -> pa.RecordBatch:
            ids = pa.concat_arrays([b.column("doc_id") for b in got])
            length = np.concatenate([b.column("length").to_numpy() for b in got])
            term = np.concatenate([b.column("terms").flatten().to_numpy() for b in got])
            tf = np.concatenate([b.column("tfs").flatten().to_numpy() for b in got])
            each = np.concatenate([b.column("terms").value_lengths().to_numpy() for b in got])
            doc = np.repeat(np.arange(len(ids)), each)
            w = impact(tf, length[doc], idf[term], mean)
            keep = w > 0
            o = np.lexsort((-w[keep], term[keep]))
            doc, w, term = doc[keep][o], w[keep][o], term[keep][o]
            ends = np.searchsorted(term, np.arange(len(idf) + 1))
            order = np.argsort(np.argsort(ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
            rows, found, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for q, terms in queries:
                lists = [(doc[ends[t] : ends[t + 1]], w[ends[t] : ends[t + 1]]) for t in terms if ends[t] < ends[t + 1]]
                if lists:
                    d, s = best(lists, len(ids), order, k)
                    rows.append(np.full(len(d), q))
                    found.append(d)
                    score.append(s)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(rows)), ids.take(pa.array(np.concatenate(found))), pa.array(np.concatenate(score))], names=["q", "doc_id", "score"])

        got, size = [], 0
        for b in batches:
            got.append(b)
            size += b.num_rows
            if size >= 50_000:
                yield solve(got)
                got, size = [], 0
        if size:
            yield solve(got)

    return run


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(distinct_words(b.column("text"))[1]).view(np.int64))], names=["word"])


def search(queries: DataFrame, docs: DataFrame, k: int = 10, block: int = 20_000, id_col: str = "item_id", most_words: int = 8_000_000) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of every query, exactly.

    Ties in score go to the lower doc_id; null doc_ids come last. Documents with score 0 aren't results, so a
    query whose words are nowhere (a null, empty or wordless one with them) has no rows. Repeated queries
    each have their rows; repeated documents are results each. Null texts count as empty documents. Other
    columns are ignored. Empty tables give no rows. Very long texts and queries count whole: a task's memory follows its
    documents' and the query's words one by one, not their product. The documents are indexed once, for the distinct words of all queries,
    which travel to the tasks (8 bytes a word); only where these are more than most_words each block of about `block` queries has an index of
    its own, with the same results.
    """
    q = narrow(queries, id_col, "text")
    blocks = max(1, -(-q.count() // block))
    d = narrow(docs, "doc_id", "text")

    def index_for(vocab: np.ndarray) -> tuple[DataFrame, np.ndarray, float]:
        index = cut(d.mapInArrow(_index(vocab), "doc_id long, length long, terms array<int>, tfs array<int>"))
        stats = index.mapInArrow(_statistics(len(vocab)), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas().set_index("term")["n"]  # a row a word
        total = int(stats.get(-1, 0))
        df = np.zeros(len(vocab))
        df[stats.index[stats.index >= 0]] = stats[stats.index >= 0]
        return index, np.log(1.0 + (total - df + 0.5) / (df + 0.5)), max(1.0, float(stats.get(-2, 0)) / max(1, total))

    shared = None
    if blocks > 1:
        all_words = cut(q.mapInArrow(_words, "word long").distinct())
        if all_words.count() <= most_words:
            vocab = np.sort(all_words.toArrow().column("word").to_numpy().view(np.uint64))
            shared = vocab, *index_for(vocab)
    out = None
    for i in range(blocks):
        own = q.filter(F.pmod(F.xxhash64(id_col, "text"), F.lit(blocks)) == i).orderBy(id_col, "text").toArrow()
        row, key = distinct_words(own.column("text"))
        vocab, index, idf, mean = shared or (v := np.unique(key), *index_for(v))
        term = np.searchsorted(vocab, key)
        ids = own.column(id_col).to_pylist()
        cuts = np.searchsorted(row, np.arange(len(ids) + 1))  # rows are in order
        asked = [(n, term[cuts[n] : cuts[n + 1]]) for n in range(len(ids)) if cuts[n] < cuts[n + 1]]
        hits = index.mapInArrow(_search(asked, idf, mean, k), "q long, doc_id long, score long")
        w = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        top = hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        names = q.sparkSession.createDataFrame([(n, x) for n, x in enumerate(ids)], f"q long, `{id_col}` {dict(queries.dtypes)[id_col]}")
        part = top.join(names, "q").select(id_col, "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    return out


SQL = r"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS w FROM documents),
tf AS (SELECT doc_id, w, count(*)::DOUBLE AS tf FROM words GROUP BY ALL),
len AS (SELECT doc_id, sum(tf) AS n FROM tf GROUP BY ALL),
stat AS (SELECT (SELECT count(*) FROM documents)::DOUBLE AS docs, (SELECT sum(n) FROM len) / (SELECT count(*) FROM documents)::DOUBLE AS mean),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS w FROM benchmark),
df AS (SELECT w, count(*)::DOUBLE AS df FROM tf WHERE w IN (SELECT w FROM asked) GROUP BY ALL),
impact AS (SELECT doc_id, w, floor(1000.0::DOUBLE * ln(1.0::DOUBLE + (docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * (tf * 2.2::DOUBLE) / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n / mean)))::BIGINT AS s
  FROM tf JOIN df USING (w) JOIN len USING (doc_id), stat),
total AS (SELECT item_id, doc_id, sum(s)::BIGINT AS score FROM asked JOIN impact USING (w) GROUP BY ALL HAVING sum(s) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM total QUALIFY rank <= 10
"""
