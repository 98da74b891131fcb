"""Secret scan: which long tokens look random?

A candidate is a run of at least 16 characters of the base-64 alphabets. Its encoding is the narrowest
of hex, base 32, base 36, base 62 and base 64 that holds it, and three tests ask whether it is a uniform
draw from that alphabet: chi-squared over the symbols, runs of the alphabet's two halves (digits and
letters, or lower case and the rest), and serial correlation of neighbouring codes. Fisher's method
joins them to one statistic, small for random tokens.

The hypothesis to reject is that the token is ordinary text. Its distribution of the statistic is
simulated for each length class from the corpus's own letter-to-letter transitions, counted over all
documents, so that a short token, which text can imitate, needs more evidence than a long one. Its tail
is sampled by importance, so p-values have no floor, and one certain token among millions passes. The
Benjamini-Hochberg procedure runs inside each length class over all candidates of the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, narrow
from tidemark.llm.textvec import chunks

SYMBOLS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/-_"
STRATA = (16, 18, 20, 22, 24, 28, 32, 40, 48, 64, 96)
CANDIDATE = r"[A-Za-z0-9+/_\-]{16,}"
_D, _U, _L = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Name, symbols in code order, and those of the first half for the runs test; narrowest first.
ENCODINGS = [
    ("hex", _D + "abcdef", _D), ("HEX", _D + "ABCDEF", _D), ("base32", _U + "234567", "234567"), ("base36", _D + _L, _D), ("BASE36", _D + _U, _D),
    ("base62", _D + _U + _L, _L), ("base64", _U + _L + _D + "+/", _L), ("base64url", _U + _L + _D + "-_", _L), ("any", SYMBOLS, _L),
]


def _encoding_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """member, code and half by (encoding, symbol)."""
    member = np.zeros((len(ENCODINGS), len(SYMBOLS)), bool)
    code, half = np.zeros(member.shape, np.int64), np.zeros(member.shape, bool)
    for i, (_, symbols, first) in enumerate(ENCODINGS):
        for k, c in enumerate(symbols):
            j = SYMBOLS.index(c)
            member[i, j], code[i, j], half[i, j] = True, k, c in first
    return member, code, half


def _two_sided(z: np.ndarray) -> np.ndarray:
    """P(|Z| >= |z|), by Abramowitz and Stegun 7.1.26."""
    x = np.abs(z) / np.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return np.clip(poly * np.exp(-x * x), 1e-300, 1)


def battery(sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """m x n symbol numbers -> encoding of each row, and m x 4: p of chi-squared, runs and serial
    correlation, and Fisher's statistic."""
    member, code, half = _encoding_tables()
    m, n = sym.shape
    step = max(1, (1 << 20) // max(1, m))  # symbols of a row at a time, so that memory doesn't follow a token's length
    used = np.zeros((m, len(SYMBOLS)), bool)
    for a in range(0, n, step):
        used[np.arange(m)[:, None], sym[:, a : a + step]] = True
    enc = (used[:, None, :] <= member[None]).all(axis=2).argmax(axis=1)
    size = member.sum(axis=1)[enc].astype(float)
    middle = (size[:, None] - 1) / 2
    count, turns, product = np.zeros((m, 128)), np.zeros(m), np.zeros(m)
    for a in range(0, n, step):
        part = sym[:, a : a + step + 1]  # and the next one's first
        v, h = code[enc[:, None], part], half[enc[:, None], part]
        count += np.bincount((np.arange(m)[:, None] * 128 + v[:, :step]).ravel(), minlength=m * 128).reshape(m, 128)
        turns += (h[:, 1:] != h[:, :-1]).sum(axis=1)
        c = v - middle
        product += (c[:, 1:] * c[:, :-1]).sum(axis=1)
    chi = size / n * (count**2).sum(axis=1) - n
    df = size - 1
    z = ((np.maximum(chi, 1e-9) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / np.sqrt(2 / (9 * df))  # Wilson-Hilferty
    p_chi = np.where(z > 0, _two_sided(z) / 2, 1 - _two_sided(z) / 2)
    p = half.sum(axis=1)[enc] / size
    pq = p * (1 - p)
    var = (n - 1) * 2 * pq * (1 - 2 * pq) + 2 * (n - 2) * pq * (1 - 4 * pq)
    p_runs = _two_sided((turns - (n - 1) * 2 * pq) / np.sqrt(var))
    p_serial = _two_sided(product / ((size**2 - 1) / 12) / np.sqrt(n - 1))
    tests = np.stack([p_chi, p_runs, p_serial], axis=1)
    return enc, np.column_stack((tests, -2 * np.log(tests).sum(axis=1)))


def transitions(docs: DataFrame) -> np.ndarray:
    """Counts of neighbouring symbols over all texts; the last row holds those that begin a token."""
    k = len(SYMBOLS)
    number = np.full(256, k, np.int64)
    for i, c in enumerate(SYMBOLS):
        number[ord(c)] = i

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1) * (k + 1), np.int64)
        for b in batches:
            for _, _, data, offs in chunks(b.column("text")):
                s = number[data]
                before = np.concatenate(([k], s[:-1])) if len(s) else s
                before[offs[:-1][offs[:-1] < len(s)]] = k
                total += np.bincount(before * (k + 1) + s, minlength=total.size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    t = narrow(docs, "text").filter("text is not null").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()  # at most 67 * 67
    out = np.zeros((k + 1) * (k + 1))
    out[t["pair"]] = t["n"]
    return out.reshape(k + 1, k + 1)[:, :k]


#: Powers of the text's transitions in the simulated chains: 0 is a uniform draw, 1 is text.
HEATS = (0.0, 0.25, 0.5, 0.75, 1.0)
Null = dict[int, tuple[np.ndarray, np.ndarray]]


def null_of(counts: np.ndarray, draws: int = 20_000, seed: int = 7) -> Null:
    """For each length class, at its least length: sorted statistics, and P(statistic <= each) for text tokens.

    Importance sampling: besides `draws` tokens of the text's own chain, draws / 20 each of chains between
    text and uniform draws in every encoding. A token weighs its chance as text over its chance in the
    whole mixture (at most about 2), so the far tail is estimated from tokens that do reach it.
    """
    rng = np.random.default_rng(seed)
    begin = counts[-1] + counts.sum(axis=0) * 1e-6 + 1e-9
    step = counts[:-1] + 0.01 * begin / begin.sum()
    step, begin = step / step.sum(axis=1, keepdims=True), begin / begin.sum()
    begins, steps = [begin], [step]
    for inside in _encoding_tables()[0]:
        for heat in HEATS:
            if heat < 1 or not inside.all():
                begins.append(begin**heat * inside / (begin**heat * inside).sum())
                steps.append(step**heat * inside / (step**heat * inside).sum(axis=1, keepdims=True))
    each = np.array([draws] + [max(1, draws // 20)] * (len(begins) - 1))
    chain, n, last = np.repeat(np.arange(len(each)), each), int(each.sum()), len(begin) - 1
    b, t = np.array(begins), np.array(steps)
    up_b, up_t = np.cumsum(b, axis=1), np.cumsum(t, axis=2)
    up_b[:, -1:], up_t[:, :, -1:] = 2, 2
    with np.errstate(divide="ignore"):
        log_b, log_t = np.log(b), np.log(t)
    x = np.zeros((n, max(STRATA)), np.int64)
    x[:, 0] = np.minimum((up_b[chain] <= rng.random(n)[:, None]).sum(axis=1), last)
    like = log_b[:, x[:, 0]]  # chains x tokens
    out = {}
    for k in range(1, x.shape[1]):
        x[:, k] = np.minimum((up_t[chain, x[:, k - 1]] <= rng.random(n)[:, None]).sum(axis=1), last)
        like += log_t[:, x[:, k - 1], x[:, k]]
        if k + 1 in STRATA:
            top = like.max(axis=0)
            weight = np.exp(like[0] - top) / (each[:, None] * np.exp(like - top)).sum(axis=0)
            stat = battery(x[:, : k + 1])[1][:, 3]
            o = np.argsort(stat, kind="stable")
            p = np.clip(np.cumsum(weight[o]), 1e-300, 1)
            keep = np.append(np.diff(np.floor(100 * np.log(p))) > 0, True)  # to 1 %, rounded up
            out[k + 1] = stat[o][keep], p[keep]
    return out


def p_values(null: tuple[np.ndarray, np.ndarray], stat: np.ndarray) -> np.ndarray:
    """The chance of the next sampled statistic, so a token beyond all samples isn't given 0."""
    at = np.searchsorted(null[0], stat, "left")
    return np.append(null[1], 1.0)[at]


def candidates_in(texts: list[str | None], null: Null) -> pd.DataFrame:
    """at, start, end, encoding, length_class, p_chi2, p_runs, p_serial, p_value of every candidate.

    Runs of digits alone (ids, amounts, card numbers) are no candidates."""
    find, rows, tokens = re.compile(CANDIDATE).finditer, [], []
    for i, t in enumerate(texts):
        if t:
            for m in find(t):
                if not m.group().isdigit():
                    rows.append((i, m.start(), m.end()))
                    tokens.append(m.group())
    x = pd.DataFrame(rows, columns=["at", "start", "end"]).astype("int64")
    number = np.zeros(128, np.uint8)
    for i, c in enumerate(SYMBOLS):
        number[ord(c)] = i
    n = (x["end"] - x["start"]).to_numpy()
    enc, stat, p = np.zeros(len(x), np.int64), np.zeros((len(x), 4)), np.ones(len(x))
    cls = np.array(STRATA)[np.searchsorted(STRATA, n, "right") - 1] if len(x) else np.zeros(0, np.int64)
    for size in np.unique(n):
        own = np.flatnonzero(n == size)
        for part in np.array_split(own, -(-len(own) * int(size) // 1_000_000)):
            sym = number[np.frombuffer("".join(tokens[i] for i in part).encode(), np.uint8)].reshape(len(part), size)
            enc[part], stat[part] = battery(sym)
    for c in np.unique(cls):
        own = cls == c
        p[own] = p_values(null[int(c)], stat[own, 3])
    x["encoding"] = [ENCODINGS[e][0] for e in enc]
    x["length_class"], x["p_chi2"], x["p_runs"], x["p_serial"], x["p_value"] = cls.astype("int32"), stat[:, 0], stat[:, 1], stat[:, 2], p
    return x


def _scan(null: Null):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = candidates_in(b.column("text").to_pylist(), null)
            ids = b.column("doc_id").cast(pa.int64()).take(pa.array(x.pop("at")))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(x[c]) for c in x)], names=["doc_id", *x])

    return run


def cutoffs(found: DataFrame, rate: float) -> dict[int, float]:
    """The Benjamini-Hochberg cutoff of each length class. The p-values have a level for each 1 % at most."""
    c = found.groupBy("length_class", "p_value").count().toPandas().sort_values(["length_class", "p_value"])
    out = {}
    for k, g in c.groupby("length_class"):
        rank = g["count"].cumsum().to_numpy()
        ok = np.flatnonzero(g["p_value"].to_numpy() <= rate * rank / rank[-1])
        out[int(k)] = float(g["p_value"].iloc[ok[-1]]) if len(ok) else -1.0
    return out


SCHEMA = "doc_id long, start long, end long, encoding string, length_class int, p_chi2 double, p_runs double, p_serial double, p_value double"


def scan(docs: DataFrame, rate: float = 0.01) -> tuple[DataFrame, Null, dict[int, float]]:
    null = null_of(transitions(docs))
    found = cut(narrow(docs, "doc_id", "text").filter("text is not null").mapInArrow(_scan(null), SCHEMA))
    return found, null, cutoffs(found, rate)


def find_secrets(docs: DataFrame, rate: float = 0.01) -> DataFrame:
    """doc_id, start, end (code points), encoding, length_class, p_chi2, p_runs, p_serial, p_value: the
    tokens held to be secrets, with a false-discovery rate of at most rate in each length class.

    Null and empty texts have none. A null doc_id keeps its rows. Repeated rows give repeated results and
    count as often. Ties in p_value are accepted or rejected together. Very long texts and tokens are read whole. Other columns are ignored. An
    empty table gives no rows.
    """
    found, _, least = scan(docs, rate)
    ok = F.lit(False)
    for k, v in least.items():
        ok = ok | ((F.col("length_class") == k) & (F.col("p_value") <= v))
    return found.filter(ok)


def redact(docs: DataFrame, rate: float = 0.01, mask: str = "[SECRET]") -> DataFrame:
    """docs with each secret replaced by mask; n_chars, where it is a column, follows a changed text.

    All other columns (those with clashing names, too) and all rows stay, null and empty texts as they are.
    Repeated rows are masked alike, and tokens that tie are masked together. Very long texts and tokens are read
    whole. An empty table gives no rows."""
    _, null, least = scan(docs, rate)

    @F.arrow_udf("string")
    def masked(col: pa.Array) -> pa.Array:
        texts = col.to_pylist()
        x = candidates_in(texts, null)
        x = x[x["p_value"] <= x["length_class"].map(least).fillna(-1.0)]
        for at, start, end in sorted(zip(x["at"], x["start"], x["end"], strict=True), reverse=True):
            texts[at] = texts[at][:start] + mask + texts[at][end:]
        return pa.array(texts, pa.string())

    names = docs.columns
    tmp = docs.toDF(*[f"_tm{i}" for i in range(len(names))])
    old = f"_tm{names.index('text')}"
    new = tmp.withColumn("_tm_new", masked(F.col(old)))
    cols = []
    for i, c in enumerate(names):
        x = F.col(f"_tm{i}")
        if c == "text":
            x = F.col("_tm_new")
        elif c == "n_chars":
            x = F.when(F.col(old).eqNullSafe(F.col("_tm_new")), x).otherwise(F.length("_tm_new")).cast(dict(docs.dtypes)[c])
        cols.append(x.alias(c))
    return new.select(*cols)
