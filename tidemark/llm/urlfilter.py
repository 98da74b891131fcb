"""URL filter over a sorted digest array.

The list's entries are hashed to 64-bit xxhash keys (seed 42), sorted, and written as shards of three
flat files each: keys, offsets and the entries' bytes. Tasks map the files into memory, so that a list
larger than memory works and the tasks of a machine share its pages, and probe all names of a batch by
vectorised binary search. A key that is found counts only if the stored entry equals the name.

An entry is a host (blocks it and all its subdomains), host/path (blocks the page and all below it), or
host/path?query, all without scheme, user, port, fragment and trailing slash, host in lower case.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_dir, narrow


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and query (with its ?) of a URL, in the form of the entries."""
    u = F.regexp_replace(F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://", ""), r"(?s)#.*\z", "")
    raw = F.regexp_extract(u, r"^([^/?]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(raw, r"^.*@", ""), r":[0-9]*\z", ""))
    rest = F.substring(u, F.length(raw) + 1, F.length(u) + 1)
    path = F.regexp_replace(F.regexp_extract(rest, r"^([^?]*)", 1), r"/+\z", "")
    return host, path, F.regexp_extract(rest, r"(?s)(\?.+)\z", 1)


def names(url: Column) -> Column:
    """All entries that would block a URL, the most specific first."""
    host, path, query = parts(url)
    steps = F.split(path, "/")  # the first is empty
    prefix = F.transform(F.sequence(F.size(steps), F.lit(2), F.lit(-1)), lambda i: F.concat(host, F.array_join(F.slice(steps, 1, i), "/")))
    labels = F.split(host, r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    none = F.array().cast("array<string>")
    return F.filter(F.array_distinct(F.concat(F.when(query != "", F.array(F.concat(host, path, query))).otherwise(none), F.when(F.size(steps) > 1, prefix).otherwise(none), hosts)), lambda x: x != "")


def _local(path: str) -> str:
    """A shared folder as a path that can be mapped into memory: on a mounted file system."""
    for head in ("file://", "file:"):
        if path.startswith(head):
            return path[len(head) :]
    if "://" in path:
        raise ValueError(f"{path}: memory mapping needs spark.checkpoint.dir on a mounted file system")
    return path


def build(entries: DataFrame, shard_entries: int = 1_000_000) -> list[tuple[str, int, int, int]]:
    """Writes column entry as sorted digest shards to the shared folder -> (path, count, least and
    largest key) of each. Null and empty entries are left out; repeated ones count once. Keys are hashes, so equal
    ranges of them are shards of equal size: entries go to their shard in one shuffle, and repeats meet there."""
    e = entries.select("entry").filter("entry is not null and entry <> ''")
    shards = max(1, -(-e.count() // shard_entries))
    key = F.xxhash64("entry")
    at = F.least(F.floor((key.cast("double") / 2.0**64 + 0.5) * shards), F.lit(shards - 1)).cast("int")
    where = _local(fresh_dir(e.sparkSession, "digests"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # batch by batch, so that a shard never lies in memory whole; whole files appear at once, the same on a retry
        own, mine = f"{where}/{TaskContext.get().partitionId():05d}", TaskContext.get().taskAttemptId()
        n, size, lo, hi, last = 0, 0, 0, 0, None
        os.makedirs(where, exist_ok=True)
        names = {kind: f"{own}.{kind}.{mine}" for kind in ("keys", "offs", "text")}
        with open(names["keys"], "wb") as keys, open(names["offs"], "wb") as offs, open(names["text"], "wb") as text:
            np.zeros(1, np.int64).tofile(offs)
            for b in batches:
                if not b.num_rows:
                    continue
                entry = b.column("entry").cast(pa.large_binary())
                new = np.ones(b.num_rows, bool)
                new[1:] = pc.not_equal(entry[1:], entry[:-1]).to_numpy(zero_copy_only=False)
                new[0] = entry[0].as_py() != last
                last = entry[-1].as_py()
                k, entry = b.column("key").to_numpy()[new], entry.filter(pa.array(new))
                if len(k):
                    o = np.frombuffer(entry.buffers()[1], np.int64)[entry.offset : entry.offset + len(entry) + 1]
                    k.tofile(keys)
                    (o[1:] - o[0] + size).tofile(offs)
                    np.frombuffer(entry.buffers()[2], np.uint8)[o[0] : o[-1]].tofile(text)
                    lo, hi, n, size = (lo if n else int(k[0])), int(k[-1]), n + len(k), size + int(o[-1] - o[0])
        for kind, tmp in names.items():
            os.replace(tmp, f"{own}.{kind}") if n else os.remove(tmp)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([own]), pa.array([n]), pa.array([lo]), pa.array([hi])], names=["path", "n", "lo", "hi"])

    placed = e.select(key.alias("key"), "entry", at.alias("at")).repartitionById(shards, "at").select("key", "entry").sortWithinPartitions("key", "entry")
    done = placed.mapInArrow(write, "path string, n long, lo long, hi long")
    return sorted((r["path"], r["n"], r["lo"], r["hi"]) for r in done.collect())  # a row a shard


class Shard:
    def __init__(self, path: str, n: int) -> None:
        self.keys = np.memmap(f"{path}.keys", np.int64, "r", shape=(n,))
        self.offs = np.memmap(f"{path}.offs", np.int64, "r", shape=(n + 1,))
        self.text = np.memmap(f"{path}.text", np.uint8, "r")

    def holds(self, keys: np.ndarray, name) -> np.ndarray:
        """Whether each key's name is an entry. name(i): the UTF-8 bytes of name i."""
        out = np.zeros(len(keys), bool)
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        live = np.flatnonzero(at < len(self.keys))
        while len(live):  # more than one round only where stored keys collide
            live = live[self.keys[at[live]] == keys[order[live]]]
            for j in live:
                i, k = order[j], at[j]
                out[i] |= self.text[self.offs[k] : self.offs[k + 1]].tobytes() == name(i)
            live = live[~out[order[live]]]
            at[live] += 1
            live = live[at[live] < len(self.keys)]
        return out


def filter_urls(pages: DataFrame, shards: list[tuple[str, int, int, int]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, url, blocked, entry: one row for each page; entry is the most specific that blocks it, or null.

    Null and empty URLs aren't blocked, null ids keep their rows. Repeated rows are judged alike. Of entries that tie
    in length none can be equal. Very long URLs are probed whole, once a step of their path. Other columns are ignored. An
    empty list blocks nothing; an empty table gives no rows.
    """
    p = narrow(pages, id_col, url_col)
    n = names(F.coalesce(F.col(url_col), F.lit("")))
    p = p.select(id_col, url_col, n.alias("names")).select("*", F.transform("names", lambda x: F.xxhash64(x)).alias("keys"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, Shard] = {}  # mapped when first needed
        for b in batches:
            lists = b.column("keys")
            keys, name = lists.flatten().to_numpy(), b.column("names").flatten()
            hit = np.zeros(len(keys), bool)
            order = np.argsort(keys, kind="stable")
            up = keys[order]
            for path, count, lo, hi in shards:
                own = order[np.searchsorted(up, lo, "left") : np.searchsorted(up, hi, "right")]
                if len(own):
                    if path not in open_:
                        open_[path] = Shard(path, count)
                    hit[own] |= open_[path].holds(keys[own], lambda i, own=own: name[int(own[i])].as_py().encode())
            offs = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            row = np.repeat(np.arange(len(lists)), np.diff(offs))
            at = np.flatnonzero(hit)
            _, first = np.unique(row[at], return_index=True)
            pick = np.full(len(lists), -1)
            pick[row[at[first]]] = at[first]
            yield pa.RecordBatch.from_arrays([b.column(id_col), b.column(url_col), pa.array(pick >= 0), name.take(pa.array(pick, mask=pick < 0))], names=[id_col, url_col, "blocked", "entry"])

    kind = dict(pages.dtypes)[id_col]
    return p.mapInArrow(run, f"`{id_col}` {kind}, `{url_col}` string, blocked boolean, entry string")


#: Hosts of the standing list: gambling, drugs, tracking, spam and adult sites, under each of the three domains.
HOSTS = [f"{name}.example.{tld}" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm") for tld in ("com", "net", "org")]
PER_PAGE = 40


def standing_list(pages: DataFrame, per_page: int = PER_PAGE) -> DataFrame:
    """The entries of the query: HOSTS, and for each page per_page made-up addresses that no page has, so that the
    list is as large against the table as lists in use are (sf0.1: 100,018 entries), without blocking clean pages."""
    made = narrow(pages, "page_id").filter("page_id is not null").distinct().select("page_id", F.explode(F.sequence(F.lit(1), F.lit(per_page))).alias("k"))
    made = made.select(F.concat(F.lit("listed-"), F.col("page_id").cast("string"), F.lit(".invalid/"), F.col("k").cast("string")).alias("entry"))
    return made.union(pages.sparkSession.createDataFrame([(h,) for h in HOSTS], "entry string"))


SQL = r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.\-]*://', ''), '(?s)#.*$', '') AS u FROM pages),
b AS (SELECT *, regexp_extract(u, '^([^/?]*)', 1) AS raw FROM a),
c AS (SELECT *, lower(regexp_replace(regexp_replace(raw, '^.*@', ''), ':[0-9]*$', '')) AS host, substr(u, length(raw) + 1) AS rest FROM b),
d AS (SELECT page_id, url, host, regexp_replace(regexp_extract(rest, '^([^?]*)', 1), '/+$', '') AS path, regexp_extract(rest, '(\?.+)$', 1) AS query FROM c),
list AS (SELECT DISTINCT 'listed-' || page_id || '.invalid/' || k AS entry FROM pages, range(1, 41) t(k) UNION ALL SELECT n || '.example.' || t FROM (SELECT unnest(['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) AS n), (SELECT unnest(['com', 'net', 'org']) AS t)),
steps AS (SELECT *, string_split(path, '/') AS s, string_split(host, '.') AS l FROM d),
names AS (
  SELECT page_id, url, 0 AS rank, host || path || query AS entry FROM steps WHERE query <> ''
  UNION ALL SELECT page_id, url, 1000 - n, host || array_to_string(s[1:n], '/') FROM (SELECT *, unnest(range(2, len(s) + 1)) AS n FROM steps)
  UNION ALL SELECT page_id, url, 1000 + n, array_to_string(l[n:], '.') FROM (SELECT *, unnest(range(1, len(l) + 1)) AS n FROM steps)),
hit AS (SELECT page_id, arg_min(entry, rank) AS entry FROM names JOIN list USING (entry) GROUP BY page_id)
SELECT page_id, url, hit.entry IS NOT NULL AS blocked, hit.entry FROM pages LEFT JOIN hit USING (page_id)
"""
