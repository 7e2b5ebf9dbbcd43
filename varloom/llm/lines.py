"""Line dedup over overlapping windows of three lines.

Every three consecutive lines are hashed (128 bits). Windows are counted over the corpus with partial
aggregates that also keep the first place, by doc_id, text hash and line; repeated ones are joined back, and the lines of
every later occurrence go, but for those that the first occurrence itself covers (so a line that
repeats in a row leaves three). What is shuffled are hashes, and the texts once.

Lines end at ``\\n``; windows of blank lines only count for nothing, and texts of fewer than three lines have no
windows. Nulls: a null text stays null, null ids sort first. Rows equal in id and text are one document: both keep
what one keeps. Empty tables give no rows. Other columns are kept, and ``n_chars`` is counted anew by ``keep``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .tables import fresh, settled

SPAN = 3


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with n_lines, n_removed and kept (the text that is left); names that are taken get an underscore."""
    n_lines, n_removed, kept, lines, doc, th, gone = fresh(docs, "n_lines", "n_removed", "kept", "lines", "doc", "th", "gone")
    low = F.lit(-(1 << 63))
    keyed = docs.withColumns({lines: F.split(F.col("text").cast("string"), "\n", -1), doc: F.coalesce(F.col("doc_id").cast("bigint"), low), th: F.xxhash64("text")})
    windows = (
        keyed.select(F.col(doc).alias("doc"), F.col(th).alias("th"), F.col(lines).alias("lines"))
        .filter(F.size("lines") >= SPAN)
        .select("doc", "th", F.posexplode(F.expr(f"transform(sequence(0, size(lines) - {SPAN}), i -> slice(lines, i + 1, {SPAN}))")).alias("pos", "w"))
        .filter(F.exists("w", lambda x: x.rlike(r"\S")))
        .select("doc", "th", "pos", F.xxhash64("w").alias("h1"), F.xxhash64(F.lit(1), "w").alias("h2"))
    )
    firsts = windows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("doc", "th", "pos")).alias("first")).filter("n > 1")
    firsts = settled(firsts.select("h1", "h2", "first"))
    same = (F.col("doc") == F.col("first.doc")) & (F.col("th") == F.col("first.th"))
    later = (
        windows.join(firsts, ["h1", "h2"])
        .filter(~(same & (F.col("pos") == F.col("first.pos"))))
        .select("doc", "th", F.when(same, F.greatest("pos", F.col("first.pos") + SPAN)).otherwise(F.col("pos")).alias("a"), (F.col("pos") + SPAN - 1).alias("b"))
        .filter("a <= b")
    )
    spans = later.distinct().groupBy("doc", "th").agg(F.collect_list(F.struct("a", "b")).alias(gone))  # at most one a line
    spans = spans.withColumnsRenamed({"doc": doc, "th": th})
    out = keyed.join(spans, [doc, th], "left")
    size = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines))
    covered = F.flatten(F.transform(gone, lambda s: F.sequence(s["a"], s["b"])))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
    text = F.when(F.col(gone).isNull(), F.col("text").cast("string")).otherwise(F.array_join(F.transform(left, lambda i: F.get(F.col(lines), i)), "\n"))
    lost = F.when(F.col(gone).isNull(), F.lit(0)).otherwise(F.size(lines) - F.size(left))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], size.cast("bigint").alias(n_lines), lost.cast("bigint").alias(n_removed), text.alias(kept))


def keep(docs: DataFrame) -> DataFrame:
    """``docs`` with the text that is left; rows that lose every line go."""
    n_lines, n_removed, kept = fresh(docs, "n_lines", "n_removed", "kept")
    out = dedup_lines(docs).filter(~((F.col(n_removed) > 0) & (F.col(n_removed) == F.col(n_lines))))
    new = {"text": F.col(kept), "n_chars": F.char_length(kept).cast("bigint")}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
