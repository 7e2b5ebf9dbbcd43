"""The pipeline's stages against plain Python on a given table, and held-out accuracy of the classifiers."""

import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
SPACED, ALNUM = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(x):
    return re.sub("[A-Z]", lambda m: m[0].lower(), x or "")


def line_dedup(docs):
    """Later occurrences of three lines lose their lines; a text that loses all goes."""
    first, gone = {}, defaultdict(set)
    for i in sorted(docs):
        lines = docs[i].split("\n")
        for k in range(len(lines) - 2):
            w = tuple(lines[k:k + 3])
            if not re.search(r"\S", "".join(w)):
                continue
            d, p = first.setdefault(w, (i, k))
            if (d, p) != (i, k):
                gone[i] |= set(range(max(k, p + 3) if d == i else k, k + 3))
    left = {i: "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone[i]) for i, t in docs.items()}
    return {i: t for i, t in left.items() if not gone[i] or len(gone[i]) < len(docs[i].split("\n"))}


def near_copies(docs):
    sets = {}
    for i, t in docs.items():
        w = SPACED.findall(lower(t))
        sets[i] = {tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
    group = {i: i for i in docs}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = sorted((top(i), top(j)))
                group[b] = a
    return {i: t for i, t in docs.items() if top(i) == i}


def decontaminate(docs, items):
    wins = set()
    for t in items:
        w = ALNUM.findall(lower(t))
        wins |= {tuple(w[k:k + min(10, len(w))]) for k in range(len(w) - min(10, len(w)) + 1)} if w else set()
    sizes = {len(w) for w in wins}

    def clean(t):
        w = ALNUM.findall(lower(t))
        return not any(tuple(w[k:k + n]) in wins for n in sizes for k in range(len(w) - n + 1))

    return {i: t for i, t in docs.items() if clean(t)}


def test_pipeline_equals_plain_python_stage_by_stage(spark):
    rows = lambda d: {r.doc_id: r.text or "" for r in d.select("doc_id", "text").collect()}
    d = corpus_pipeline.written(corpus_pipeline.language_id(spark, spark.read.parquet(f"{SMALL}/documents.parquet"), SMALL), "language_id")
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for name, stage, brute in (("line_dedup", corpus_pipeline.line_dedup, line_dedup), ("near_copies", corpus_pipeline.near_copies, near_copies),
                               ("benchmark_decontamination", corpus_pipeline.benchmark_decontamination, lambda x: decontaminate(x, items))):
        want = brute(rows(d))
        d = corpus_pipeline.written(stage(spark, d, SMALL), name)
        assert rows(d) == want, name
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    have = defaultdict(list)
    for r in corpus_pipeline.pack(spark, d, SMALL).collect():
        assert r.length & (r.length - 1) == 0 and r.length <= 4096 and r.offset == 0
        have[r.doc_id].append((r.start, r.length, r.ids_crc32))
    for i, t in want.items():
        ids = [*tok.encode(t, add_special_tokens=False).ids, 2]
        pieces, at = sorted(have.pop(i)), 0
        for start, n, crc in pieces:
            assert start == at and crc == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[at:at + n]))
            at += n
        assert at == len(ids)
    assert not have


def test_languages_of_rows_not_learnt_from(spark):
    got = entry.queries()["op7_language"](spark, MIDDLE).filter("held_out").join(spark.read.parquet(f"{MIDDLE}/documents.parquet").filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang"), "doc_id")
    n, right = got.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert n > 1000 and right >= 0.98 * n


def test_toxic_rows_not_learnt_from(spark):
    lab = spark.read.parquet(f"{MIDDLE}/labels.parquet").filter("toxic IS NOT NULL").select("doc_id", "toxic")
    got = entry.queries()["op5_toxicity"](spark, MIDDLE).filter("held_out").join(lab, "doc_id").groupBy("toxic").agg(F.count("*").alias("n"), F.sum("predicted").alias("p")).collect()
    n, p = ({r.toxic: r[k] for r in got} for k in ("n", "p"))
    assert n[1] > 50 and p[1] >= 0.8 * n[1] and p[0] <= 0.03 * n[0]


def test_sharding_cuts_overfull_ranges_and_keeps_small_groups_whole(spark, monkeypatch):
    """Few draws make ranges uneven, so some are cut again; groups below a two-hundredth of a shard stay in one shard."""
    from varloom.llm import sharding

    monkeypatch.setattr(sharding, "DRAWS", 1)
    monkeypatch.setattr(sharding, "RANGES_A_SHARD", 64)
    cut = []
    real = sharding._boundaries
    monkeypatch.setattr(sharding, "_boundaries", lambda keyed, share, old: cut.append(len(old)) or real(keyed, share, old))
    d = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("group "), (F.col("id") % 5000).cast("string")).alias("text"))
    got = sharding.assign(d, 4).toPandas()
    assert len(cut) > 1 and any(cut[1:])  # boundaries were drawn again inside ranges
    assert got.groupby("text_crc32")["shard"].nunique().max() == 1
    size = got.groupby("shard")["size"].sum()
    assert len(size) == 4 and size.max() - size.min() < 0.02 * size.mean()
