"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's embedding is the sum of those of its hashed whole and its hashed beginnings (3 to 5 bytes),
filters of several widths slide over the words, each filter's largest response counts for the text, and
a logistic layer gives the score. Every labelled text outside the held-out fold is learnt from, equal texts of an id once: four fifths, by a hash of the id,
train the model, the others calibrate its thresholds.

Training is numpy in Spark tasks. Features (8 bytes a word, no texts) are written once, dealt into parts of about
``PART_BYTES`` of text. In a round each task runs stochastic gradients, through the positions of the largest responses, over its part from the
common model, and the parts' changes are averaged by Spark, weighted by rows: ``epochs`` rounds, however many parts there are. Embeddings start from the class odds of each hash
in all rows that train, in one dimension, so that rare telling words are found at once. The driver gets sums of fixed size (13 MB a round).

Thresholds are calibrated by language: the language is the one
that a language model (``language``, with its own sample of texts) predicts from the text, and a score's logit is moved so that each language's best
threshold lies at ``CUT``. Logits of all labelled rows are counted in steps of 1 / ``STEPS``. A language with fewer than ten toxic rows among those kept from training is calibrated on all its rows,
trained-on rows included, and one with fewer than five rows of a class takes the threshold of all. Tasks get the two models: tables of fixed size (about 6 MB).

Nulls and empty texts have no words and get the score of no evidence. Whole texts count, in slices
of words that overlap so that every window is seen whole; repeated rows get equal scores. Without labels, or with one class only, every text gets the class's share.
Rows of ``labels`` without a label are left out, of several for one id the largest counts. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import language as L
from .tables import written
from .words import ALNUM, _LOWER, slices, words

BITS = 15
FAMILIES = 4
DIM, FILTERS, WIDTHS = 12, 10, (1, 2, 3)
POSITIVES, NEGATIVES = 2500, 3500
CUT = 0.3
WORDS = 8 << 20
LONGEST = 200_000
SLICE = 1 << 16  # words scored at once
BATCH_WORDS = 400_000  # of one step of training
PART_BYTES = 24 << 20
STEPS = 256  # thresholds are known to this part of a logit
BLOCK = 1 << 14  # numbers of a model sent as one row


def features(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of every word (words x FAMILIES) and the first word of each text."""
    w = words(col, ALNUM, True)
    n = len(w.hash)
    out = np.zeros((n, FAMILIES), np.uint16)
    out[:, 0] = w.hash >> np.uint64(64 - BITS)
    v = np.zeros(n, np.uint64)
    for k in range(5):
        at = w.start + k
        inside = at < w.end
        v = v * np.uint64(257) + np.where(inside, _LOWER[w.data[np.minimum(at, len(w.data) - 1)]], 0).astype(np.uint64) if n else v
        if k >= 2:
            out[:, k - 1] = (v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
    return out, w.doc


@dataclass
class Model:
    emb: np.ndarray = field(default_factory=lambda: np.zeros((FAMILIES, 1 << BITS, DIM), np.float32))
    filters: np.ndarray = field(default_factory=lambda: np.zeros((DIM, sum(WIDTHS) * FILTERS), np.float32))  # width by width, place by place
    shift: np.ndarray = field(default_factory=lambda: np.zeros(len(WIDTHS) * FILTERS, np.float32))
    lin: np.ndarray = field(default_factory=lambda: np.zeros(len(WIDTHS) * FILTERS, np.float32))
    bias: float = 0.0
    cuts: np.ndarray = field(default_factory=lambda: np.zeros(1))  # best threshold (a logit) of each predicted language
    language: L.Model | None = None

    def embed(self, feats: np.ndarray) -> np.ndarray:
        x = self.emb[0][feats[:, 0]]
        for k in range(1, FAMILIES):
            x += self.emb[k][feats[:, k]]
        return x

    def pooled(self, feats: np.ndarray, doc: np.ndarray, where: bool = False, goes_on: bool = False) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
        """Largest responses (texts x filters, not below 0), the words where they start, and the words' embeddings.

        If the last text ``goes_on`` behind these words, windows that start in the last ``max(WIDTHS) - 1`` of them are left out.
        """
        x = self.embed(feats)
        r = x @ self.filters
        n, m = len(feats), len(doc) - 1
        size = np.diff(doc)
        full = np.flatnonzero(size)
        top = np.zeros((m, len(WIDTHS) * FILTERS), np.float32)
        at = np.zeros(top.shape, np.int64) if where else None
        if not n:
            return top, at, x
        left = np.repeat(doc[1:], size) - np.arange(n)  # words left in the text
        c = 0
        for k, width in enumerate(WIDTHS):
            resp = r[:, c:c + FILTERS].copy()
            for j in range(1, width):
                resp[:n - j] += np.where(left[:n - j, None] > j, r[j:, c + j * FILTERS:c + (j + 1) * FILTERS], 0)
            c += width * FILTERS
            if goes_on:
                resp[n - max(WIDTHS) + 1:] = -np.inf
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            best = np.maximum.reduceat(resp, doc[:-1][full], axis=0)
            top[full, cols] = np.maximum(best + self.shift[cols], 0)
            if where:
                for i, d in enumerate(full):
                    at[d, cols] = doc[d] + resp[doc[d]:doc[d + 1]].argmax(0)
        return top, at, x

    def peaks(self, feats: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest responses and the words where they start; a single long text is taken in slices."""
        if len(doc) > 2 or len(feats) <= BATCH_WORDS:
            return self.pooled(feats, doc, where=True)[:2]
        top = np.zeros((1, len(self.lin)), np.float32)
        at = np.zeros(top.shape, np.int64)
        for lo in range(0, len(feats), SLICE):
            hi = min(len(feats), lo + SLICE + max(WIDTHS) - 1)
            t, k, _ = self.pooled(feats[lo:hi], np.array([0, hi - lo]), where=True, goes_on=hi < len(feats))
            better = t > top
            top, at = np.where(better, t, top), np.where(better, k + lo, at)
        return top, at

    def logits(self, feats: np.ndarray, doc: np.ndarray) -> np.ndarray:
        out = np.zeros((len(doc) - 1, len(self.lin)), np.float32)
        more = max(WIDTHS) - 1
        d = 0
        while d < len(doc) - 1:
            e = max(d + 1, int(np.searchsorted(doc, doc[d] + SLICE, "right")) - 1)
            for lo in range(int(doc[d]), max(int(doc[d]) + 1, int(doc[e])), SLICE):  # several texts that fit, or slices of one
                hi = min(int(doc[e]), lo + SLICE + more)
                cut = np.clip(doc[d:e + 1], lo, hi) - lo
                out[d:e] = np.maximum(out[d:e], self.pooled(feats[lo:hi], cut, goes_on=hi < doc[e])[0])
            d = e
        return out @ self.lin + self.bias

    def scores(self, col: pa.Array) -> np.ndarray:
        z = self.logits(*features(col)).astype(float)
        if self.language is not None and len(self.cuts) > 1:
            z -= self.cuts[self.language.scores(col)[0]]
        else:
            z -= self.cuts[0]
        return 1 / (1 + np.exp(-np.clip(z + np.log(CUT / (1 - CUT)), -40, 40)))


def sample(docs: DataFrame, labels: DataFrame, positives: int, negatives: int, language: L.Model | None) -> list[tuple[int, np.ndarray, int]]:
    """(label, features, predicted language) of about that many labelled rows of either class, for a look at them; ``fit`` learns from all rows."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("doc_id")).agg(F.max("toxic").cast("int").alias("y"))
    known = known.filter(L.fold() != 2)
    n = dict(known.groupBy("y").count().collect())
    u = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / (1 << 30)
    p = F.when(F.col("y") == 1, min(1.0, positives / max(1, n.get(1, 0)))).otherwise(min(1.0, negatives / max(1, n.get(0, 0))))
    picked = known.filter(u < p).select(F.col("doc_id").cast("bigint").alias("id"), "y").toPandas().astype({"id": "int64", "y": "int32"})  # bounded by the two numbers
    spark = docs.sparkSession

    def rows_of(ids) -> DataFrame:
        table = spark.createDataFrame(ids, "id bigint, y int") if len(ids) else spark.createDataFrame([], "id bigint, y int")
        d = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        return d.join(F.broadcast(table), "id").groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # one text an id

    words_of = F.regexp_count("text", F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"))  # the words that ``features`` counts
    sizes = rows_of(picked).select("id", "y", words_of.alias("words")).toPandas().sort_values("id")
    sizes = sizes[sizes.words <= LONGEST].sample(frac=1, random_state=11)
    drawn = sizes[sizes.words.cumsum() <= WORDS][["id", "y"]]
    sent = spark.sparkContext.broadcast(language)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                feats, doc = features(b.column("text"))
                lang = sent.value.scores(b.column("text"))[0] if sent.value is not None else np.zeros(b.num_rows)
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), pa.array([feats[i:j].tobytes() for i, j in zip(doc[:-1], doc[1:])], pa.binary()), pa.array(np.asarray(lang, np.int32))], names=["id", "y", "f", "lang"])

    got = rows_of(drawn).select("id", "y", "text").mapInArrow(run, "id bigint, y int, f binary, lang int").toArrow().sort_by("id").to_pydict()
    return [(y, np.frombuffer(f, np.uint16).reshape(-1, FAMILIES), k) for y, f, k in zip(got["y"], got["f"], got["lang"])]


def learnt(docs: DataFrame, labels: DataFrame, language: L.Model | None) -> DataFrame:
    """part, at, y, held, lang, f (features) of every labelled text outside the held-out fold, equal ones of an id once, written once; rows of a part stand together."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").cast("int").alias("y"))
    known = known.filter(L.fold("id") != 2)
    rows = docs.filter(F.col("doc_id").isNotNull() & (L.fold() != 2)).select(F.col("doc_id").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = rows.select("id", F.octet_length("text").alias("n")).join(known, "id").agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    sent = docs.sparkSession.sparkContext.broadcast(language)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", 1 << 20):
                feats, doc = features(b.column("text"))
                lang = sent.value.scores(b.column("text"))[0] if sent.value is not None else np.zeros(b.num_rows)
                f = pa.array([feats[i:j].tobytes() for i, j in zip(doc[:-1], doc[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ("part", "at", "y", "held")), pa.array(np.asarray(lang, np.int32)), f], names=["part", "at", "y", "held", "lang", "f"])

    # Labels and texts meet in their part, so that texts are dealt once; Spark may deal them to more partitions, and small ones of a task train as one.
    one = rows.repartition(parts, "id").join(known.repartition(parts, "id"), "id").groupBy("id", "y", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"))
    one = one.withColumn("part", F.spark_partition_id().cast("bigint")).withColumn("at", F.xxhash64("id", F.lit(11))).withColumn("held", F.pmod("at", F.lit(5)) == 0).select("part", "at", "y", "held", "text")
    out = written(one.mapInArrow(run, "part bigint, at bigint, y int, held boolean, lang int, f binary").sortWithinPartitions("part", "at", "f"), "toxicity")
    return out.coalesce(parts)  # the size of the data, not the number of files, says how many models are trained


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Part, labels, held, languages and features of one part after the other; parts of a task that together are small are taken as one."""
    def packed() -> tuple:
        y, held, lang, f = zip(*rows)
        return part, np.array(y, np.float32), np.array(held, bool), np.array(lang), [np.frombuffer(x, np.uint16).reshape(-1, FAMILIES) for x in f]

    part, rows, size = None, [], 0
    for b in batches:
        for p, *row in zip(*(b.column(k).to_pylist() for k in ("part", "y", "held", "lang", "f"))):
            if p != part and size >= PART_BYTES:
                yield packed()
                rows, size = [], 0
            part = p
            rows.append(row)
            size += len(row[-1])
    if rows:
        yield packed()


def _over_parts(table: DataFrame, make, size: int) -> np.ndarray:
    """The sum of the vectors of ``size`` numbers that ``make`` gives for each part; only blocks that hold something are sent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, *rows in _parts(batches):
            v = make(part, *rows).astype(np.float32)
            use = [i for i in range(0, size, BLOCK) if v[i:i + BLOCK].any()]
            cut = [v[i:i + BLOCK].tobytes() for i in use]
            yield pa.RecordBatch.from_arrays([pa.array([i // BLOCK for i in use], pa.int32()), pa.array([part] * len(cut), pa.int64()), pa.array(cut, pa.binary())], names=["block", "part", "v"])

    def add(rows: pa.Table) -> pa.Table:
        out = sum(np.frombuffer(v.as_py(), np.float32).astype(float) for v in rows.sort_by("part").column("v"))
        return pa.table({"block": rows.column("block")[:1], "v": pa.array([out.astype(np.float32).tobytes()], pa.binary())})

    got = table.mapInArrow(run, "block int, part bigint, v binary").groupBy("block").applyInArrow(add, "block int, v binary").toArrow()
    out = np.zeros(size, np.float32)
    for i, v in zip(got.column("block").to_pylist(), got.column("v").to_pylist()):
        out[i * BLOCK:(i + 1) * BLOCK] = np.frombuffer(v, np.float32)
    return out


def fit(docs: DataFrame, labels: DataFrame, epochs: int = 6, seed: int = 5) -> Model:
    language = L.fit(docs.filter(L.fold() != 2)) if "lang" in docs.columns else None
    table = learnt(docs, labels, language)
    n = {(r.held, r.y): r.n for r in table.groupBy("held", "y").agg(F.count("*").alias("n")).collect()}
    pos, neg = (sum(k for (_, y), k in n.items() if (y > 0) == toxic) for toxic in (True, False))
    if not pos or not neg:
        share = float(np.clip(pos / max(1, pos + neg), 0.001, 0.999))
        return Model(bias=float(np.log(share / (1 - share))), cuts=np.array([np.log(CUT / (1 - CUT))]))
    calm = all(any(not h and (y > 0) == toxic for h, y in n) for toxic in (True, False))  # else too few rows to keep any from training
    if calm:
        pos, neg = (sum(k for (h, y), k in n.items() if not h and (y > 0) == toxic) for toxic in (True, False))
    m = _train(table, pos, neg, calm, epochs, seed)
    m.language = language
    bins = _logits(table, m)
    best = _threshold(bins)
    if m.language is not None:
        cuts = []
        for k in range(len(m.language.langs)):
            own = bins[bins.lang == k]
            kept = own[own.held] if calm else own[:0]  # rows not trained on, where they suffice
            use = kept if kept.hit.sum() >= 10 else own
            cuts.append(_threshold(use) if use.hit.sum() >= 5 and (use.n - use.hit).sum() >= 5 else best)
        m.cuts = np.array(cuts + ([cuts[0]] if len(cuts) == 1 else []))
    else:
        m.cuts = np.array([best])
    return m


def _logits(table: DataFrame, m: Model) -> pd.DataFrame:
    """Rows (``n``) and toxic rows (``hit``) by language, ``held`` and logit in steps, of all rows."""
    sent = table.sparkSession.sparkContext.broadcast(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, y, held, lang, f in _parts(batches):
            z = sent.value.logits(np.concatenate(f), np.append(0, np.cumsum([len(x) for x in f]))).astype(float)
            z = np.round(np.clip(z, -64, 64) * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(lang.astype(np.int32)), pa.array(z), pa.array((y > 0).astype(np.int64))], names=["held", "lang", "z", "y"])

    d = table.mapInArrow(run, "held boolean, lang int, z int, y bigint")
    return d.groupBy("held", "lang", "z").agg(F.count("*").alias("n"), F.sum("y").alias("hit")).toPandas()  # at most 2 * 128 * STEPS rows a language


def _threshold(bins: pd.DataFrame) -> float:
    """The middle of the gap between logits that parts the classes with the best F1."""
    b = bins.groupby("z")[["n", "hit"]].sum().sort_index(ascending=False)
    s = b.index.to_numpy() / STEPS
    k = int(np.argmax(2 * b.hit.cumsum().to_numpy() / (b.n.cumsum().to_numpy() + b.hit.sum())))
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k] - 1)


def _steps(order: np.ndarray, sizes: list[int]) -> Iterator[np.ndarray]:
    """Runs of at most 32 texts that hold at most ``BATCH_WORDS`` words together (or one text)."""
    lo, words = 0, 0
    for i, k in enumerate(order.tolist()):
        if i > lo and (i - lo == 32 or words + sizes[k] > BATCH_WORDS):
            yield order[lo:i]
            lo, words = i, 0
        words += sizes[k]
    if lo < len(order):
        yield order[lo:]


LEARNT = ("emb", "filters", "shift", "lin")


def _packed(m: Model, squares: dict) -> np.ndarray:
    return np.concatenate([*(getattr(m, k).ravel() for k in LEARNT), [m.bias], *(squares[k].ravel() for k in LEARNT), [squares["bias"]]]).astype(np.float32)


def _unpacked(v: np.ndarray) -> tuple[Model, dict]:
    m, squares, at = Model(), {}, 0
    for into in (lambda k, x: setattr(m, k, x), squares.__setitem__):
        for k in (*LEARNT, "bias"):
            size = np.size(getattr(m, k))
            into(k, v[at:at + size].reshape(getattr(m, k).shape).copy() if k != "bias" else float(v[at]))
            at += size
    return m, squares


def _train(table: DataFrame, pos: int, neg: int, calm: bool, epochs: int, seed: int) -> Model:
    rng = np.random.default_rng(seed)
    m = Model()
    m.emb = rng.normal(0, 0.02, m.emb.shape).astype(np.float32)
    m.filters = rng.normal(0, 0.3, m.filters.shape).astype(np.float32)
    m.lin = rng.normal(0.3, 0.1, m.lin.shape).astype(np.float32)
    use = table.filter(~F.col("held")) if calm else table

    def occurring(part, y, held, lang, f) -> np.ndarray:
        ab = np.zeros((2, FAMILIES, 1 << BITS))
        for x, t in zip(f, y):
            for k in range(FAMILIES):
                ab[0 if t > 0 else 1, k, np.unique(x[:, k])] += 1
        return ab.ravel()

    a, b = _over_parts(use, occurring, 2 * FAMILIES << BITS).reshape(2, FAMILIES, 1 << BITS)
    odds = np.log((a + 0.3) / (pos + 0.6)) - np.log((b + 0.3) / (neg + 0.6))
    m.emb[:, :, 0] = np.where(a + b > 0, np.clip(odds, -3, 3), 0) / FAMILIES
    m.filters[0] = np.abs(m.filters[0])
    m.bias = float(np.log(pos / neg)) - 1.0
    v = _packed(m, {**{k: np.full_like(getattr(m, k), 1e-2) for k in LEARNT}, "bias": 1e-2})
    weights = 0.5 * (pos + neg) / pos, 0.5 * (pos + neg) / neg
    for k in range(epochs):
        sent = table.sparkSession.sparkContext.broadcast(v)

        def run(part, y, held, lang, f, k=k, sent=sent) -> np.ndarray:
            m, squares = _unpacked(sent.value)
            _pass(m, squares, f, y, np.where(y > 0, *weights), np.random.default_rng([seed, k, part]), k / epochs)
            return (_packed(m, squares) - sent.value) * (len(y) / (pos + neg))  # nothing where no text of the part answers

        v = v + _over_parts(use, run, len(v))
    return _unpacked(v)[0]


def _pass(m: Model, squares: dict, feats: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rng: np.random.Generator, done: float) -> None:
    """Each text once, in random order; ``done`` is the share of the passes before."""
    rate = 0.05 * (1 - done) + 0.005
    for part in _steps(rng.permutation(len(y)), [len(f) for f in feats]):
        doc = np.append(0, np.cumsum([len(feats[i]) for i in part]))
        f = np.concatenate([feats[i] for i in part])
        top, at = m.peaks(f, doc)
        z = top @ m.lin + m.bias
        g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) * weight[part] / len(part)).astype(np.float32)
        back = g[:, None] * m.lin * (top > 0)
        grad_f, touched, grad_x = np.zeros_like(m.filters), [], []
        c = 0
        for k, width in enumerate(WIDTHS):
            cols = np.arange(k * FILTERS, (k + 1) * FILTERS)
            for j in range(width):
                row, col = np.nonzero(back[:, cols])
                start = at[row, cols[col]] + j
                ok = start < doc[row + 1]
                row, col, start = row[ok], col[ok], start[ok]
                gb = back[row, cols[col]]
                np.add.at(grad_f.T, c + j * FILTERS + col, gb[:, None] * m.embed(f[start]))
                touched.append(start)
                grad_x.append(gb[:, None] * m.filters[:, c + j * FILTERS + col].T)
            c += width * FILTERS
        _adagrad(m.lin, squares["lin"], top.T @ g, rate)
        _adagrad(m.shift, squares["shift"], back.sum(0), rate)
        _adagrad(m.filters, squares["filters"], grad_f, rate)
        gb = float(g.sum())
        squares["bias"] += gb * gb
        m.bias -= rate * gb / squares["bias"] ** 0.5
        t, gx = np.concatenate(touched), np.concatenate(grad_x)
        for k in range(FAMILIES):
            ids, back_to = np.unique(f[t, k], return_inverse=True)
            gs = np.zeros((len(ids), DIM), np.float32)
            np.add.at(gs, back_to, gx)
            squares["emb"][k][ids] += gs * gs
            m.emb[k][ids] -= rate * gs / np.sqrt(squares["emb"][k][ids])


def _adagrad(p: np.ndarray, sq: np.ndarray, g: np.ndarray, rate: float) -> None:
    sq += g * g
    p -= rate * g / np.sqrt(sq)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", 1 << 20):
                p = sent.value.scores(b.column("text"))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p), pa.array((p >= CUT).astype(np.int32))], names=["doc_id", "score", "predicted"])

    d = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
