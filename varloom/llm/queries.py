"""The registered queries of this folder: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    out = pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), ids=False)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


QUERIES["op3_packing"] = op3_packing


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    from .sharding import assign

    return assign(table(spark, folder, "documents"), 40)


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from .decontamination import find

    out = find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE["op2_decontamination"] = """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item, n, array_to_string(w[k:k + n - 1], ' ') AS s
  FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
dw AS (
  SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hit AS (SELECT r, k, n, item FROM dw JOIN iw USING (n, s)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT r, k, n FROM hit)) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
QUERIES |= {"op1_sharding": op1_sharding, "op2_decontamination": op2_decontamination}


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from .substrings import remove_repeats

    return remove_repeats(table(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES["op4_substring_dedup"] = op4_substring_dedup
ORACLE["op4_substring_dedup"] = """
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT r, k, array_to_string(w[k:k + 34], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS k FROM d WHERE len(w) >= 35)),
again AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(k, k + 35)) AS p FROM win SEMI JOIN again USING (s))),
word AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS s FROM word ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)
"""


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    from .archives import read, write
    from .tables import shared_folder

    back = read(write(table(spark, folder, "pages"), shared_folder(spark, "archives")), data=False)
    return back.filter("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES["op9_warc"] = op9_warc
ORACLE["op9_warc"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY h)
SELECT page_id, n AS payload_bytes, h AS payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (h)
"""


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    from . import language as L

    docs = table(spark, folder, "documents")
    model = L.fit(docs.filter(L.fold() != 2))
    out, pred, score, _ = L.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (L.fold() == 2).alias("held_out"), F.col(pred).alias("lang_pred"), F.col(score).alias("score"))


QUERIES["op7_language"] = op7_language


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from . import toxicity as T
    from .language import fold

    docs = table(spark, folder, "documents")
    model = T.fit(docs, table(spark, folder, "labels"))
    return T.score(docs, model).select("doc_id", (fold() == 2).alias("held_out"), "score", "predicted")


QUERIES["op5_toxicity"] = op5_toxicity


def op10_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    from .nearcopies import near_copies

    return near_copies(table(spark, folder, "documents"), size=4)


QUERIES["op10_near_copies"] = op10_near_copies
ORACLE["op10_near_copies"] = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 3], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM common JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * x >= 80 * (na.n + nb.n - x)),
e AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a, a AS b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


def op8_top_k(spark: SparkSession, folder: str) -> DataFrame:
    from .topk import top_k

    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES["op8_top_k"] = op8_top_k
ORACLE["op8_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from .lines import dedup_lines

    out = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


QUERIES["op6_line_dedup"] = op6_line_dedup
ORACLE["op6_line_dedup"] = """
WITH d AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS l FROM documents),
w AS (
  SELECT doc_id, k, l[k] || chr(10) || l[k + 1] || chr(10) || l[k + 2] AS s
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS k FROM d WHERE len(l) >= 3) WHERE trim(l[k] || l[k + 1] || l[k + 2], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
f AS (SELECT s, min({'d': doc_id, 'k': k}) AS first FROM w GROUP BY s HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = first.d THEN greatest(k, first.k + 3) ELSE k END, k + 3)) AS p
  FROM w JOIN f USING (s) WHERE doc_id <> first.d OR k <> first.k),
line AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS p, unnest(l) AS x FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, chr(10) ORDER BY p) AS s FROM line ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, len(l) - coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""


def op11_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    from .fingerprints import edited

    return edited(table(spark, folder, "documents"))


QUERIES["op11_fingerprints"] = op11_fingerprints


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    from .whitening import whiten

    out = whiten(table(spark, folder, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))  # null where it needs more than 64 bits: from some millions of unit vectors on


QUERIES["op12_whitening"] = op12_whitening


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    from .negatives import mine

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


QUERIES["op13_hard_negatives"] = op13_hard_negatives
ORACLE["op13_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, c.vec_id AS c, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT a, c, score FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, c) AS r FROM s WHERE same) WHERE r <= 5),
n AS (SELECT p.a, p.c AS p, p.score AS ps, s.c AS n, s.score AS ns, row_number() OVER (PARTITION BY p.a, p.c ORDER BY s.score DESC, s.c) AS r
      FROM p JOIN s ON p.a = s.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT a AS anchor_id, p AS positive_id, CAST(r AS INTEGER) AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score FROM n WHERE r <= 5
"""
