"""Every operator on a small table with all odd rows, against brute force; on an empty one; with clashing columns."""

import gzip
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from varloom.llm import archives, decontamination, language, lines, nearcopies, packing, sharding, substrings, topk, toxicity


def key(r):
    return tuple((x is None, str(type(x)), x) for x in r)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


def small(x):
    return re.sub("[A-Z]", lambda m: m[0].lower(), x or "")


SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def test_sharding(docs, nothing):
    got = sharding.assign(docs, 4).toPandas()
    assert len(got) == docs.count()
    by = got.groupby("shard")
    assert (by.slot.max() + 1 == by.size()).all() if callable(by.size) else True
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    whole = sharding.assign(docs, 4, carry=True).select("size", "text_crc32", "record.text").collect()
    assert all(r["size"] == len((r["text"] or "").encode()) + 16 and r["text_crc32"] == zlib.crc32((r["text"] or "").encode()) for r in whole)
    assert sharding.assign(nothing, 4).count() == 0


def test_shards_are_equal_in_bytes_though_one_group_holds_half(spark):
    d = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.lit("copy " * 30)).otherwise(F.repeat(F.md5(F.col("id").cast("string")), 5)).alias("text"))
    got = sharding.assign(d, 10).toPandas()
    b = got.groupby("shard")["size"].sum()
    assert len(b) == 10 and b.max() - b.min() < 3 * got["size"].max() + 0.02 * b.mean()


def test_decontamination(spark, docs, rows, nothing):
    by = {r[0]: r[1] for r in rows}
    items = [(1, " ".join((by[18] or "").split()[5:25])), (2, "One"), (3, None), (4, "..."), (5, " ".join((by[0]).split()[:9])), (5, "absent words of no text at all in here for sure"), (6, by[2])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    pat = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wins = defaultdict(set)
    for i, t in items:
        w = pat.findall(small(t))
        for k in range(len(w) - min(10, len(w)) + 1 if w else 0):
            wins[tuple(w[k:k + min(10, len(w))])].add(str(i))
    want = []
    for d, t, *_ in rows:
        w, hit, ids = pat.findall(small(t)), set(), set()
        for size in {len(x) for x in wins}:
            for k in range(len(w) - size + 1):
                if found := wins.get(tuple(w[k:k + size])):
                    hit.update(range(k, k + size))
                    ids |= found
        want.append((d, len(w), len(hit), tuple(sorted(ids))))
    got = decontamination.find(docs, bench)
    same([(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got.collect()], want)
    clean = decontamination.clean(docs, bench)
    assert clean.columns == docs.columns
    same([(r.doc_id,) for r in clean.collect()], [(d,) for d, _, n, _ in want if not n])
    assert decontamination.find(nothing, bench).count() == 0
    assert decontamination.find(docs, bench.filter("false")).filter("n_hit > 0").count() == 0


def test_packing(docs, rows, nothing):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    got = packing.pack(docs, path, longest=64).toPandas()
    assert (got.length & (got.length - 1) == 0).all() and got.length.max() <= 64 and got.sequence_id.is_unique and (got.offset == 0).all()
    want = Counter((d, tuple(tok.encode(t or "", add_special_tokens=False).ids) + (2,)) for d, t, *_ in rows)
    have = Counter()
    for _, n in Counter(got.doc_id.fillna(-1).astype(int)).items():
        assert n
    for d, g in got.groupby(got.doc_id.fillna(-1).astype(int)):
        copies = (g.start == 0).sum()
        if len(set(g.doc_tokens)) > 1:
            continue  # rows without an id
        g = g.drop_duplicates("start").sort_values("start")
        ids = b"".join(g.ids)
        assert (g.start + g.length).tolist()[-1] == g.doc_tokens.iloc[0] and all(zlib.crc32(i) == c for i, c in zip(g.ids, g.ids_crc32))
        have[(None if d == -1 else d, tuple(int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)))] += copies
    same([(d, ids, n) for (d, ids), n in have.items()], [(d, ids, n) for (d, ids), n in want.items() if d is not None])
    assert packing.pack(nothing, path).count() == 0


@pytest.mark.parametrize("batch", [300, 16 << 20])
def test_substrings(monkeypatch, docs, rows, nothing, batch):
    monkeypatch.setattr(substrings, "BATCH", batch)
    monkeypatch.setattr(substrings, "BUCKET", batch)
    split = [SPACED.findall(r[1] or "") for r in rows]
    n = Counter(tuple(w[k:k + 35]) for w in split for k in range(len(w) - 34))
    want = []
    for r, w in zip(rows, split):
        gone = {k + j for k in range(len(w) - 34) if n[tuple(w[k:k + 35])] > 1 for j in range(35)}
        want.append((r[0], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    got = substrings.remove_repeats(docs)
    same([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()], want)
    assert all(sum(s.length for s in r.spans) == r.n_removed for r in got.collect())
    assert substrings.remove_repeats(nothing).count() == 0


def test_lines(docs, rows, nothing):
    first, lined = {}, [(r[0], r[1], None if r[1] is None else r[1].split("\n")) for r in rows]
    windows = [(d, t, k, tuple(ls[k:k + 3])) for d, t, ls in lined if ls for k in range(len(ls) - 2) if "".join(ls[k:k + 3]).strip()]
    order = lambda d, t, k: (d is not None, d or 0, k)  # noqa: E731  ids differ wherever windows repeat here
    for d, t, k, w in sorted(windows, key=lambda x: order(*x[:3])):
        first.setdefault(w, (d, t, k))
    want = []
    for d, t, ls in lined:
        gone = set()
        for k in range(len(ls or []) - 2):
            w = tuple(ls[k:k + 3])
            if "".join(w).strip() and first[w] != (d, t, k):
                gone |= set(range(max(k, first[w][2] + 3) if first[w][:2] == (d, t) else k, k + 3))
        want.append((d, len(ls or []), len(gone), None if t is None else "\n".join(x for i, x in enumerate(ls) if i not in gone)))
    got = lines.dedup_lines(docs)
    n, lost, kept = got.columns[-3:]
    assert n == "_n_lines" and kept == "_kept"
    same([(r["doc_id"], r[n], r[lost], r[kept]) for r in got.collect()], want)
    left = lines.keep(docs)
    assert left.columns == docs.columns
    same([(r.doc_id, r.text) for r in left.collect()], [(d, t) for d, size, lost, t in want if not lost or lost < size])
    assert lines.keep(nothing).count() == 0


def brute_components(rows, size, percent=80):
    sets = []
    for r in rows:
        w = SPACED.findall(small(r[1]))
        sets.append({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None and sets[i]:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    comp = [r[0] if not sets[i] else least.get(find(i)) for i, r in enumerate(rows)]
    return [(r[0], len(sets[i]), comp[i], r[0] == comp[i]) for i, r in enumerate(rows)]


@pytest.mark.parametrize("hot,tile", [(1, 100), (8192, 1 << 20)])
def test_near_copies(monkeypatch, docs, rows, nothing, hot, tile):
    monkeypatch.setattr(nearcopies, "HOT", hot)
    monkeypatch.setattr(nearcopies, "TILE", tile)
    want = brute_components(rows, 4)
    same(nearcopies.near_copies(docs, 4).collect(), want)
    if hot > 1:
        left = nearcopies.keep(docs, 4)
        assert left.columns == docs.columns
        same([(r.doc_id,) for r in left.collect()], [(r[0],) for r in want if r[3]])
        assert nearcopies.near_copies(nothing).count() == 0


def linked_by_all_pairs(sets, percent):
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root = [root[j] if r == root[i] else r for r in root]
    return {frozenset(k for k, r in enumerate(root) if r == x) for x in root}


def linked(sets, percent):
    import numpy as np

    root = nearcopies._linked([np.array(sorted(s), np.uint64) for s in sets], percent)
    return {frozenset(np.flatnonzero(root == x).tolist()) for x in root}


def test_two_largest_components_are_joined_by_members_of_both():
    new = iter(range(100, 1000))
    more = lambda s, n: s | {next(new) for _ in range(n)}
    core = set(range(90))
    i, j = more(core, 10), more(core, 10)
    sets = [i, j, more(i, 20), more(j, 20)]
    assert linked(sets, 80) == {frozenset(range(4))} == linked_by_all_pairs(sets, 80)


@pytest.mark.parametrize("seed", range(60))
def test_random_chains_are_linked_as_by_all_pairs(seed):
    import random

    rng = random.Random(seed)
    sets = []
    for chain in range(rng.randrange(2, 5)):
        at = [set(range(1000 * chain, 1000 * chain + 60))]
        for _ in range(rng.randrange(2, 25)):
            s = set(rng.choice(at))
            s -= set(rng.sample(sorted(s), rng.randrange(0, 8)))
            at.append(s | {rng.randrange(10_000, 10_000_000) for _ in range(rng.randrange(0, 14))})
        sets += at
    rng.shuffle(sets)
    assert linked(sets, 80) == linked_by_all_pairs(sets, 80)


def test_language(docs, nothing, spark):
    d = spark.createDataFrame([(i, ("the house and the garden " if i % 2 else "das haus und der garten ") + f"x{i}", "en" if i % 2 else "de") for i in range(200)], "doc_id bigint, text string, lang string")
    model = language.fit(d.filter(language.fold() != 2))
    out, pred, score, rejected = language.identify(d, model)
    held = out.filter(language.fold() == 2).toPandas()
    assert (held.lang == held[pred]).mean() == 1 and held[score].between(0, 1).all() and not held[rejected].any()
    out, pred, score, rejected = language.identify(docs, model)
    assert pred == "_lang_pred" and score == "_score"
    got = {r.doc_id: (r[pred], r[score], r[rejected]) for r in out.filter("text IS NULL OR text = '' OR trim(text) = ''").collect()}
    assert set(got.values()) == {("und", 0.0, True)}
    assert language.keep(docs, model).columns == docs.columns and language.keep(nothing, model).count() == 0
    assert language.identify(d, language.fit(d.filter("false")))[0].filter("lang_pred <> 'und'").count() == 0


def test_all_of_many_languages_are_learnt(spark):
    import random

    rng = random.Random(4)
    pools = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for _ in range(70)]
    rows = [(k * 100 + i, " ".join(rng.choices(pool, k=20)), f"l{k:02}") for k, pool in enumerate(pools) for i in range(60 if k < 64 else 40)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit(d.filter(language.fold() != 2))
    assert len(model.langs) == 70
    out, pred, _, rejected = language.identify(d, model)
    held = out.filter(language.fold() == 2).toPandas()
    rare = held[held.lang >= "l64"]
    assert len(rare) > 20 and (rare.lang == rare[pred]).mean() > 0.95 and (held.lang == held[pred]).mean() > 0.95 and held[rejected].mean() < 0.1


def test_a_drawn_text_with_many_copies_is_sampled_once(spark):
    d = spark.range(3000).select(F.concat(F.lit("text number "), "id").alias("text"), F.lit("en").alias("lang"))
    drawn = d.orderBy(F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 30))).first()["text"]
    copies = spark.range(1500).select(F.lit(drawn).alias("text"), F.lit("en").alias("lang"))
    got = language.sample(d.union(copies).repartition(5), 100)
    assert 50 < len(got) < 160
    assert len(language.sample(copies, 100)) == 1


def test_toxicity(spark, docs, nothing):
    import random

    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(40)) + (f" vile{rng.randrange(9)} " if i % 4 == 0 else " ") + "end" for i in range(600)]
    d = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    lab = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(d, lab)
    got = toxicity.score(d, model).withColumn("held", language.fold() == 2).toPandas()
    held = got[got.held]
    assert ((held.predicted == 1) == (held.doc_id % 4 == 0)).mean() > 0.97
    assert (got.predicted == (got.score >= 0.3)).all() and got.score.between(0, 1).all()
    odd = toxicity.score(docs, model).toPandas()
    assert len(odd) == docs.count() and odd.score.between(0, 1).all()
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.score(d, toxicity.fit(d, lab.filter("false"))).agg(F.max("score")).first()[0] < 0.3


def test_a_long_text_scores_like_its_pieces():
    import numpy as np
    import pyarrow as pa

    m = toxicity.Model()
    rng = np.random.default_rng(0)
    m.emb, m.filters, m.lin = rng.normal(size=m.emb.shape).astype(np.float32), rng.normal(size=m.filters.shape).astype(np.float32), np.ones_like(m.lin)
    long = " ".join(f"w{x}" for x in rng.integers(0, 5000, 150_000))
    feats, doc = toxicity.features(pa.array([long, "", "a"]))
    assert np.allclose(m.logits(feats, doc), m.pooled(feats, doc)[0] @ m.lin, atol=1e-2)


@pytest.mark.parametrize("width", toxicity.WIDTHS)
def test_a_window_scores_alike_on_either_side_of_a_cut(monkeypatch, width):
    """One filter of a width answers to one word only, at each of its places, alone or beside a word that spoils what is cut short."""
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(toxicity, "SLICE", 10)
    k = toxicity.WIDTHS.index(width)
    for place in range(width):
        m = toxicity.Model()
        hot, cold = (toxicity.features(pa.array([w]))[0][0, 0] for w in ("hot", "cold"))
        m.emb[0, hot, 0], m.emb[0, cold, 1] = 1.0, 1.0
        c = sum(toxicity.WIDTHS[:k]) * toxicity.FILTERS
        m.filters[0, c + place * toxicity.FILTERS] = 1.0
        m.filters[1, c + (width - 1) * toxicity.FILTERS] = -1.0  # a window cut short before its last word would score more
        m.lin[k * toxicity.FILTERS] = 1.0
        for at in range(30):
            for spoiled in (-1, *range(max(0, at - 2), min(30, at + 3))):
                words = ["x"] * 30
                words[at] = "hot"
                if spoiled >= 0 and spoiled != at:
                    words[spoiled] = "cold"
                feats, doc = toxicity.features(pa.array([" ".join(words), "hot"]))
                assert np.array_equal(m.logits(feats, doc), m.pooled(feats, doc)[0] @ m.lin + m.bias), (place, at, spoiled)


def test_training_rows_are_bounded_by_words(spark, monkeypatch):
    """One text an id, none over LONGEST words, WORDS in all; copies of an id don't multiply."""
    monkeypatch.setattr(toxicity, "LONGEST", 50)
    monkeypatch.setattr(toxicity, "WORDS", 1000)
    d = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a,b "), F.when(F.col("id") % 5 == 0, 40).otherwise(10)).alias("text"))
    d = d.unionByName(d.filter("doc_id = 1").crossJoin(spark.range(300)).select("doc_id", F.lit("other text").alias("text")))
    got = toxicity.sample(d, spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic")), 1000, 1000, None)
    assert 0 < sum(len(f) for _, f, _ in got) <= 1000 and max(len(f) for _, f, _ in got) <= 50 and len(got) >= 45


def test_every_labelled_row_is_learnt_from(spark, monkeypatch):
    """More rows than any sample held, a text longer than any was, copies of an id once, in several parts."""
    monkeypatch.setattr(toxicity, "PART_BYTES", 200_000)
    monkeypatch.setattr(toxicity, "LONGEST", 50)  # bounds of the sample don't bind the fit
    monkeypatch.setattr(toxicity, "WORDS", 1000)
    monkeypatch.setattr(toxicity, "BATCH_WORDS", 100)
    monkeypatch.setattr(toxicity, "SLICE", 64)
    text = F.concat(F.repeat(F.lit("calm words "), F.when(F.col("id") == 1, 100).otherwise(9)), F.when(F.col("id") % 3 == 0, "vile ").otherwise(""), F.concat(F.lit("end"), F.col("id") % 50))
    d = spark.range(8000).select(F.col("id").alias("doc_id"), text.alias("text"))
    d = d.unionByName(d.filter("doc_id = 2").crossJoin(spark.range(20)).select("doc_id", "text"))
    lab = spark.range(8000).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("toxic"))
    rows = toxicity.learnt(d, lab, None)
    assert rows.select("part").distinct().count() > 2
    assert rows.count() == lab.filter(language.fold() != 2).count() > toxicity.POSITIVES + toxicity.NEGATIVES - 100
    assert rows.agg(F.max(F.length("f"))).first()[0] == 201 * 2 * toxicity.FAMILIES
    seen = toxicity._logits(rows, toxicity.fit(d, lab))
    assert seen.n.sum() == rows.count()
    got = toxicity.score(d, toxicity.fit(d, lab)).filter(language.fold() == 2)
    assert got.filter((F.col("predicted") == 1) != (F.col("doc_id") % 3 == 0)).count() == 0


@pytest.mark.parametrize("block,queries", [(16384, 2048), (20, 3)])
def test_top_k(monkeypatch, spark, block, queries):
    import math
    import random

    for k, v in (("BLOCK", block), ("QUERY_BLOCK", queries), ("RUN", 8), ("SAMPLE", 30)):
        monkeypatch.setattr(topk, k, v)
    rng = random.Random(3)
    vecs = [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(90)]
    vecs[7] = vecs[8] = vecs[9] = vecs[20]  # ties
    rows = [(i, v) for i, v in enumerate(vecs)] + [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [1.0, float("nan"), 0.0, 0.0]), (203, [float("inf")] * 4), (None, [1.0] * 4), (5, vecs[5]), (400, [0.5, 0.5])]
    d = spark.createDataFrame([(a, b, 1) for a, b in rows], "vec_id bigint, embedding array<double>, score int")
    use = {i: [math.floor(64 * x) for x in v] for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in use:
        if q % 20 == 0:
            best = sorted(((-sum(a * b for a, b in zip(use[q], use[c])), c) for c in use if c != q and len(use[c]) == len(use[q])))[:20]
            want += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    same(topk.top_k(d, F.col("vec_id") % 20 == 0).collect(), want)
    assert topk.top_k(d.filter("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_archives(spark, tmp_path):
    big = "héllo\n" * 40_000
    pages = [(1, "u\nv", big), (2, None, big), (None, "x", big), (3, "a", "short"), (4, "a", "short"), (5, "z", None), (1, "u\nv", big), (6, "y", "q" * 100), (0, "y", "q" * 100)]
    d = spark.createDataFrame([(*p, "clash") for p in pages], "page_id bigint, url string, html string, record_type string")
    first = {}
    for p, _, h in pages:
        if p is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, p), p)
    want = [(p, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(), *(("revisit", first[h]) if h in first and first[h] != p else ("response", None))) for p, _, h in pages]
    files = archives.write(d.repartition(3), f"file://{tmp_path}/warc")
    back = archives.read(files)
    same(back.filter("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect(), want)
    parts = back.filter("record_type = 'response'").orderBy("file", "record", "chunk").collect()
    whole = defaultdict(bytes)
    for r in parts:
        assert len(r.data) <= archives.CHUNK
        whole[r.file, r.record] += r.data
        assert r.payload_digest == hashlib.sha256(whole[r.file, r.record]).hexdigest() and r.payload_bytes == len(whole[r.file, r.record])
    assert Counter(whole.values()) == Counter((h or "").encode() for (p, _, h), w in zip(pages, want) if w[3] == "response")
    ids = [h for f in files.collect() for h in re.findall(rb"WARC-Record-ID: (\S+)", gzip.open(f.file.removeprefix("file://")).read())]
    assert len(ids) == len(set(ids)) == len(pages)
    none = d.filter("false")
    assert archives.read(archives.write(none, f"file://{tmp_path}/none")).count() == 0


def test_no_payload_travels_by_its_digest(spark):
    """Above the first pass there is no payload: decisions are made on rows of (page, bytes, digest)."""
    d = spark.range(300).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 == 0, F.repeat(F.lit("copy"), 500)).otherwise(F.repeat(F.col("id").cast("string"), 200)).alias("html"))
    told = archives.decide(archives.digests(archives.chunks(d)))
    assert set(told.columns) == {"record", "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"}
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert "data" not in plan and "payload#" not in plan
    assert told.filter("record_type = 'revisit'").count() == 99


def test_top_k_ships_only_blocks_that_can_serve(monkeypatch, spark):
    """Eight groups of vectors far apart: a query block meets the candidates of its own group; results are those of brute force."""
    import random

    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rng, pairs = random.Random(8), []
    real = topk.meetings
    monkeypatch.setattr(topk, "meetings", lambda c, q, n: pairs.append((c.count() * q.count(), real(c, q, n).count())) or real(c, q, n))
    vecs = [[(30.0 if j == i % 8 else 0.0) + rng.uniform(-1, 1) for j in range(8)] for i in range(640)]
    d = spark.createDataFrame(list(enumerate(vecs)), "vec_id bigint, embedding array<double>")
    got = topk.top_k(d, F.col("vec_id") % 20 == 0, k=5).collect()
    use = [[int(64 * x // 1) for x in v] for v in vecs]
    want = []
    for q in range(0, 640, 20):
        best = sorted((-sum(a * b for a, b in zip(use[q], use[c])), c) for c in range(640) if c != q)[:5]
        want += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    same([tuple(r) for r in got], want)
    assert pairs and pairs[0][1] * 3 <= pairs[0][0]


def test_toxicity_learns_in_full_from_several_parts(spark, monkeypatch):
    """All rounds are made however many parts there are (before, half of them), and all texts of a repeated id are learnt from (before, one)."""
    passes = []
    over = toxicity._over_parts
    monkeypatch.setattr(toxicity, "_over_parts", lambda *a: passes.append(1) or over(*a))
    monkeypatch.setattr(toxicity, "PART_BYTES", 4000)
    d = spark.range(600).select((F.col("id") % 300).alias("doc_id"), F.concat_ws(" ", F.lit("some words of row"), F.when(F.col("id") % 2 == 0, F.lit("vile")), (F.col("id") % 450).cast("string")).alias("text"))
    d = d.unionByName(d.limit(50)).unionByName(spark.createDataFrame([(None, "vile"), (4, None), (4, None)], "doc_id bigint, text string"))
    lab = spark.range(250).select(F.col("id").alias("doc_id"), (F.col("id") % 2 == 0).cast("int").alias("toxic"))
    rows = toxicity.learnt(d, lab, None)
    want = d.join(lab, "doc_id").filter(language.fold() != 2).select("doc_id", F.coalesce("text", F.lit(""))).distinct().count()
    assert rows.count() == want > lab.filter(language.fold() != 2).count() and rows.rdd.getNumPartitions() > 1
    toxicity.fit(d, lab, epochs=4)
    assert len(passes) == 1 + 4
