"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are the 2- to 4-byte pieces of lower-cased words with their edges. Each hashes to one
of ``BUCKETS`` embeddings, a text is the mean of its subwords' embeddings, and a softmax layer gives the
language. Both are trained by stochastic gradient descent in numpy on about ``SAMPLE`` distinct labelled texts, dealt evenly
to all languages, or ``LEAST`` of each where there are more than ``SAMPLE / LEAST`` languages; each text trains
as a whole and as a short piece, so short texts are known too. Since the mean is linear, embeddings and
layer of up to ``DIM`` languages fold into one table of ``BUCKETS x languages`` numbers. With more they are sent to tasks
as they are: 4 MB and 64 bytes a language. On the driver the sample grows with the languages, and the logits that
set the temperature with their square (``LEAST / 5`` rows of each by all languages: 0.2 GB a copy at 2,000 languages).

A part of the sample is kept from training: it sets the temperature of the probabilities, and the least
probability, under which a text is rejected: that below which ``LOST`` of the rightly named rows lie.

Nulls and texts without any letter are ``und`` with score 0 and rejected. Whole texts count, however long.
Repeated rows get equal answers. Without labelled rows every text is ``und``. Columns that a result would
clash with get an underscore before the new name in ``identify``; ``keep`` returns the columns it was given.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .tables import fresh
from .words import slices, text_bytes

BUCKETS = 1 << 16
SIZES = (2, 3, 4)
SAMPLE = 2000
LEAST = 31
LOST = 0.001
DIM = 16
PIECE = 1 << 18

_KIND = np.full(256, 32, np.uint8)  # letters as they are, small; anything else is an edge
_KIND[97:123] = np.arange(97, 123)
_KIND[65:91] = np.arange(97, 123)
_KIND[128:] = np.arange(128, 256)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # of each subword the logits by language, or the embedding if there is a layer
    bias: np.ndarray
    least: float  # rejected below
    layer: np.ndarray | None = None

    def scores(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Most likely language (its number) and calibrated probability of each text."""
        total = np.zeros((len(col), self.table.shape[1]))
        count = np.zeros(len(col))
        for doc, sub in subwords(col):
            if len(doc):
                at = np.flatnonzero(np.diff(doc, prepend=-1))
                total[doc[at]] += np.add.reduceat(self.table[sub], at, axis=0)
                count[doc[at]] += np.diff(at, append=len(doc))
        total /= np.maximum(count, 1)[:, None]
        best, sure = np.zeros(len(col), np.int64), np.zeros(len(col))
        step = max(1, (1 << 20) // len(self.langs))  # texts whose probabilities are held at once
        for lo in range(0, len(col), step):
            z = (total[lo:lo + step] if self.layer is None else total[lo:lo + step] @ self.layer) + self.bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            best[lo:lo + step], sure[lo:lo + step] = p.argmax(1), p.max(1)
        return best, sure


def subwords(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of all subwords, in runs of whole texts or pieces of long ones."""
    data, off = text_bytes(col)
    n, most = len(data), max(SIZES)
    for lo in range(0, n, PIECE):
        hi = min(lo + PIECE, n)
        # one byte before and some after the piece belong to its pieces' edges
        b = _KIND[data[max(0, lo - 1):min(n, hi + most)]].astype(np.uint32)
        if lo == 0:
            b = np.append(np.uint32(32), b)
        b = np.append(b, np.full(most, 32, np.uint32))
        edge = np.zeros(len(b) + 1, bool)  # a new text starts here; nothing spans it
        cuts = off[np.searchsorted(off, lo, "left"):np.searchsorted(off, hi + most, "right")] - lo + 1
        edge[cuts[cuts < len(b)]] = True
        m = hi - lo
        doc = np.searchsorted(off, np.arange(lo, hi), "right") - 1
        docs, subs = [], []
        word = b != 32
        for size in SIZES:
            # starts at the byte before (an edge) or at a byte of the word; inner bytes are the word's
            v = np.zeros(m, np.uint32)
            ok = word[1:m + 1].copy()
            for k in range(size):
                part = b[k:k + m].copy()
                if k == 0:
                    part[edge[1:m + 1]] = 32
                else:
                    for j in range(2, k + 1):  # beyond a text's end all is edge
                        part[edge[j:j + m]] = 32
                v = v * np.uint32(0x01000193) + part
                if 0 < k < size - 1:
                    ok &= part != 32
            h = (v ^ np.uint32(size)) * np.uint32(0x9E3779B1)
            at = np.flatnonzero(ok)
            docs.append(doc[at])
            subs.append((h[at] >> np.uint32(16)).astype(np.int64) & (BUCKETS - 1))
        d, s = np.concatenate(docs), np.concatenate(subs)
        order = np.argsort(d, kind="stable")
        yield d[order], s[order]


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def sample(docs: DataFrame, rows: int = SAMPLE) -> list[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """About ``rows`` distinct labelled texts, or ``LEAST`` of each language, as subword counts: (lang, buckets, counts, and both of a short piece)."""
    d = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).filter(F.col("lang").isNotNull() & has_letter(F.col("text")))
    d = d.withColumn("th", F.xxhash64("text"))
    counts = d.select("lang", "th").distinct().groupBy("lang").count().collect()
    if not counts:
        return []
    quota = max(rows / len(counts), LEAST)
    shares = docs.sparkSession.createDataFrame([(r[0], min(1.0, quota / r[1])) for r in counts], "lang string, share double")
    u = F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 30)) / (1 << 30)
    picked = d.join(F.broadcast(shares), "lang").filter(u < F.col("share")).select("lang", "th", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # of the sample's texts only
        for whole in batches:
            known = list(zip(whole.column("lang").to_pylist(), whole.column("th").to_pylist()))
            first = [k not in seen and not seen.add(k) for k in known]
            for b in slices(whole.filter(pa.array(first, pa.bool_())), "text"):
                out: list[list] = [[], []]
                texts = b.column("text").to_pylist()
                for i, t in enumerate(texts):
                    parts = t.split()
                    rng = np.random.default_rng(len(t))
                    k = int(rng.integers(1, 7))
                    at = int(rng.integers(0, max(1, len(parts) - k + 1)))
                    for o, x in zip(out, (t, " ".join(parts[at:at + k]))):
                        got = [s for _, s in subwords(pa.array([x]))]
                        h, n = np.unique(np.concatenate(got) if got else np.zeros(0, np.int64), return_counts=True)
                        o.append((h.astype(np.uint32).tobytes(), n.astype(np.float32).tobytes()))
                yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("th"), *[pa.array([x[j] for x in o], pa.binary()) for o in out for j in (0, 1)]], names=["lang", "th", "h", "n", "sh", "sn"])

    got = picked.mapInArrow(run, "lang string, th bigint, h binary, n binary, sh binary, sn binary").dropDuplicates(["lang", "th"]).toArrow().to_pydict()
    dec = lambda x, t: np.frombuffer(x, t)
    rows_ = [(la, dec(a, np.uint32), dec(b, np.float32), dec(c, np.uint32), dec(e, np.float32)) for la, a, b, c, e in zip(*(got[k] for k in ("lang", "h", "n", "sh", "sn")))]
    return sorted(rows_, key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))


def fit(docs: DataFrame, rows: int = SAMPLE, epochs: int = 8, seed: int = 3) -> Model:
    """Learn from ``text`` and non-null ``lang``; the caller leaves out rows not to be learnt from."""
    got = sample(docs, rows)
    langs = sorted({r[0] for r in got})
    if not langs:
        return Model(["und"], np.zeros((BUCKETS, 1), np.float32), np.zeros(1), 0.0)
    rng = np.random.default_rng(seed)
    number = {x: k for k, x in enumerate(langs)}
    whole = [(number[r[0]], r[1], r[2] / max(1, r[2].sum())) for r in got]
    short = [(number[r[0]], r[3], r[4] / max(1, r[4].sum())) for r in got if len(r[3])]
    held = set(rng.permutation(len(whole))[:len(whole) // 5].tolist()) if len(whole) >= 25 else set()
    kept = [x for i, x in enumerate(whole) if i in held]
    train = [x for i, x in enumerate(whole) if i not in held] + [x for i, x in enumerate(short) if i % 5]
    emb = rng.normal(0, 0.3, (BUCKETS, DIM)).astype(np.float32)
    lin = rng.normal(0, 0.3, (DIM, len(langs))).astype(np.float32)
    bias = np.zeros(len(langs), np.float32)
    steps, at = epochs * len(train), 0
    for _ in range(epochs):
        for i in rng.permutation(len(train)):
            y, h, share = train[i]
            rate = np.float32(0.5 * (1 - at / steps))
            at += 1
            x = share @ emb[h]
            z = x @ lin + bias
            g = np.exp(z - z.max())
            g /= g.sum()
            g[y] -= 1
            back = lin @ g
            lin -= rate * np.outer(x, g)
            bias -= rate * 0.1 * g
            emb[h] -= (rate * 20) * share[:, None] * back
    logits = np.array([share @ emb[h] for _, h, share in kept or train]) @ lin + bias
    y = np.array([k for k, _, _ in kept or train])

    def prob(t: float) -> np.ndarray:
        p = np.exp((logits - logits.max(1, keepdims=True)) * t)
        return p / p.sum(1, keepdims=True)

    scales = np.geomspace(0.1, 4, 25)
    best = min(scales, key=lambda t: -np.log(np.maximum(prob(t)[np.arange(len(y)), y], 1e-12)).mean())
    right = prob(best).max(1)[prob(best).argmax(1) == y]
    least = min(0.5, float(np.quantile(right, LOST))) if len(right) else 0.0
    lin *= np.float32(best)
    folded = len(langs) <= DIM
    return Model(langs, (emb @ lin).astype(np.float32) if folded else emb, bias.astype(float) * best, least, None if folded else lin)


def identify(docs: DataFrame, model: Model) -> tuple[DataFrame, str, str, str]:
    """``docs`` with the language, its probability and whether it is rejected; the names of the three columns."""
    pred, score, rejected, letter = fresh(docs, "lang_pred", "score", "rejected", "letter")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double")
    def ask(text: pa.Array) -> pa.Array:
        m: Model = sent.value
        parts = [m.scores(x.column("text")) for x in slices(pa.RecordBatch.from_arrays([text], names=["text"]), "text", 1 << 20)]
        k, p = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0))
        return pa.StructArray.from_arrays([pa.array(m.langs, pa.string()).take(pa.array(k)), pa.array(p, pa.float64())], ["lang", "score"])

    x = docs.withColumn(letter, has_letter(F.col("text").cast("string")))
    x = x.withColumn(pred, ask(F.col("text").cast("string")))
    named = F.when(F.col(letter), F.col(pred)["lang"]).otherwise("und")
    sure = F.when(F.col(letter), F.col(pred)["score"]).otherwise(0.0)
    out = x.select(*[F.col(f"`{c}`") for c in docs.columns], named.alias(pred), sure.alias(score), (~F.col(letter) | (sure < model.least)).alias(rejected))
    return out, pred, score, rejected


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that are not rejected, columns as they are."""
    out, _, _, rejected = identify(docs, model)
    return out.filter(~F.col(rejected)).select(*[F.col(f"`{c}`") for c in docs.columns])


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 4 (a null id as the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4
