"""Row-wise edits and filters of site and call tables.

Site columns used by default: ``chrom, pos, id, ref, alt`` (or ``alts``),
``allele_type, allele_length, filters``. All are projections or filters and
push down to the scan, except the id operators, which rank rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import genotype as g
from ..functions.alleles import c, contig_sort, id_base, id_suffix, size_similarity, trim_alleles
from .positions import number_rows

# ------------------------------------------------------------------ subsets


def subset_by_expr(df: DataFrame, include: str | None = None, exclude: str | None = None) -> DataFrame:
    """Keep rows where ``include`` holds and ``exclude`` does not (NULL counts as not holding)."""
    if include:
        df = df.filter(F.expr(include))
    if exclude:
        df = df.filter(~F.coalesce(F.expr(exclude), F.lit(False)))
    return df


def subset_by_length(df: DataFrame, field="allele_length", minimum=None, maximum=None) -> DataFrame:
    size = F.abs(c(field))
    if minimum is not None:
        df = df.filter(size >= minimum)
    if maximum is not None:
        df = df.filter(size <= maximum)
    return df


def subset_to_contig(df: DataFrame, *contigs: str) -> DataFrame:
    return df.filter(F.col("chrom").isin(*contigs))


def subset_to_region(df: DataFrame, chrom: str, start: int, end: int, by_span: bool = True) -> DataFrame:
    """1-based inclusive region; ``by_span`` tests the REF span, otherwise POS alone."""
    last = F.col("pos") + F.length("ref") - 1 if by_span else F.col("pos")
    return df.filter((F.col("chrom") == chrom) & (F.col("pos") <= end) & (last >= start))


def subset_to_samples(calls: DataFrame, samples: DataFrame, key, keep: bool = True, min_ac: int = 0) -> DataFrame:
    """Keep or drop the listed samples; sites left with fewer than ``min_ac`` alt alleles go too."""
    out = calls.join(samples.select("sample").distinct(), "sample", "left_semi" if keep else "left_anti")
    if min_ac > 0:
        sites = out.groupBy(*key).agg(F.sum(g.n_alt("gt")).alias("_ac")).filter(F.col("_ac") >= min_ac).select(*key)
        out = out.join(sites, list(key), "left_semi")
    return out


def extract_sample(calls: DataFrame, sample=None, trim_alts: bool = False) -> DataFrame:
    """Calls carrying an alt allele, for one sample or for all (write with ``partitionBy('sample')``).

    ``trim_alts`` keeps only the ALTs the call uses and renumbers its alleles.
    """
    out = calls if sample is None else calls.filter(F.col("sample") == sample)
    out = out.filter(g.is_carrier("gt"))
    if trim_alts:
        used = F.array_sort(F.array_distinct(F.filter("gt", lambda a: a > 0)))
        alts = F.transform(used, lambda i: F.element_at(F.col("alts"), i))
        gt = F.transform("gt", lambda a: F.when(a > 0, F.array_position(used, a).cast("int")).otherwise(a))
        out = out.withColumn("_gt", gt).withColumn("alts", alts).withColumn("gt", F.col("_gt")).drop("_gt")
    return out


def strip_genotypes(df: DataFrame) -> DataFrame:
    return df.drop("genotypes", "sample", "gt", "ad", "pl", "dp", "gq", "ps", "phased", "ev", "bev")


def drop_fields(df: DataFrame, *fields: str) -> DataFrame:
    return df.drop(*fields)


def rename_info_fields(df: DataFrame, old: list[str], new: list[str]) -> DataFrame:
    if len(old) != len(new):
        raise ValueError("old and new names differ in number")
    return df.withColumnsRenamed(dict(zip(old, new)))


def rename_contigs(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Map contig names; bare names get ``chr``. Ids of SNVs are rebuilt from the new name."""
    x = F.col("chrom")
    named = x
    if mapping:
        named = F.coalesce(F.create_map(*[F.lit(z) for kv in mapping.items() for z in kv])[x], x)
    named = F.when(named.startswith("chr"), named).otherwise(F.concat(F.lit("chr"), named))
    snv = (F.length("ref") == 1) & (F.length("alt") == 1)
    vid = F.when(snv, F.concat_ws("-", named, "pos", "ref", "alt")).otherwise(F.col("id"))
    return df.withColumns({"chrom": named, "id": vid})


def swap_sample_ids(calls: DataFrame, mapping: DataFrame) -> DataFrame:
    """``mapping(sample, new_sample)``; unmapped samples stay."""
    return (calls.join(mapping.select("sample", "new_sample"), "sample", "left")
            .withColumn("sample", F.coalesce("new_sample", "sample")).drop("new_sample"))


def select_columns(df: DataFrame, cols: list[str], allowed: dict[str, list] | None = None) -> DataFrame:
    """Named columns of rows whose values lie in every allowed list."""
    for name, values in (allowed or {}).items():
        df = df.filter(F.col(name).isin(values))
    return df.select(*cols)


def drop_by_filter(df: DataFrame, names: list[str]) -> DataFrame:
    return df.filter(~F.arrays_overlap("filters", F.array(*[F.lit(n) for n in names])))


def filter_tr(df: DataFrame, min_unit=None, min_len_diff=None, max_catalog_len=None) -> DataFrame:
    """Repeat rows pass on shortest motif, largest ALT-REF difference and REF length; others always pass."""
    ok = F.lit(True)
    if min_unit is not None:
        ok = ok & (F.array_min(F.transform(F.split("motifs", ","), F.length)) >= min_unit)
    if min_len_diff is not None:
        ok = ok & (F.array_max(F.transform("alts", lambda a: F.abs(F.length(a) - F.length("ref")))) >= min_len_diff)
    if max_catalog_len is not None:
        ok = ok & (F.length("ref") <= max_catalog_len)
    return df.filter((F.col("allele_type") != "trv") | ok)


def remove_tr_enveloped(df: DataFrame) -> DataFrame:
    return df.filter(~F.coalesce("tr_enveloped", F.lit(False)))


# Phasing priority by call source, repeats last or first to give way.
REPEATS_FIRST = {"DeepVariant": 1, "HPRC_SV_Integration": 10, "TRGT": 100}
CALLERS_FIRST = {"DeepVariant": 10, "HPRC_SV_Integration": 100, "TRGT": 1}


def priority_scores(df: DataFrame, tables: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """One score column per table; a source without a score is an error."""
    tables = tables or {"score_trgt_prio": REPEATS_FIRST, "score_dvsv_prio": CALLERS_FIRST}
    bad = F.raise_error(F.concat(F.lit("no priority for source "), F.coalesce("source", F.lit("null")))).cast("int")
    for out, table in tables.items():
        known = F.create_map(*[F.lit(z) for kv in table.items() for z in kv])[F.col("source")]
        df = df.withColumn(out, F.when(known.isNotNull(), known).otherwise(bad))
    return df


def classify_sites(df: DataFrame, edges=(1, 30, 50, 501, 5001, 50001)) -> DataFrame:
    """``site_class`` DEL / INS (with DUP) / SNV / OTHER and ``size_bin``."""
    t, n = F.lower("allele_type"), F.abs("allele_length")
    cls = (F.when(n == 0, "SNV").when(t.contains("del"), "DEL")
           .when(t.contains("ins") | t.contains("dup"), "INS").otherwise("OTHER"))
    labels = [f"{a}-{b - 1}" for a, b in zip(edges, edges[1:])] + [f"{edges[-1]}+"]
    bin_ = F.when(n.isNull(), "unknown").when(n == 0, "SNV")
    for hi, lab in zip(edges[1:], labels):
        bin_ = bin_.when(n < hi, lab)
    return df.withColumns({"site_class": cls, "size_bin": bin_.otherwise(labels[-1])})


# ------------------------------------------------------------------ filters and info

def add_filter(df: DataFrame, name: str, expr: str) -> DataFrame:
    """Append ``name`` to the filters of matching rows; PASS gives way to it."""
    others = F.filter(F.coalesce("filters", F.array().cast("array<string>")), lambda f: f != "PASS")
    hit = F.array_union(others, F.array(F.lit(name)))
    return df.withColumn("filters", F.when(F.expr(expr), hit).otherwise(F.col("filters")))


def reset_filters(df: DataFrame) -> DataFrame:
    return df.withColumn("filters", F.array(F.lit("PASS")))


def missing_filter_to_pass(df: DataFrame) -> DataFrame:
    empty = F.col("filters").isNull() | (F.size("filters") == 0) | (F.col("filters") == F.array(F.lit(".")))
    return df.withColumn("filters", F.when(empty, F.array(F.lit("PASS"))).otherwise(F.col("filters")))


def add_info(df: DataFrame, tag: str, constant=None, expr: str | None = None) -> DataFrame:
    return df.withColumn(tag, F.expr(expr) if expr else F.lit(constant))


def variant_attributes(df: DataFrame, ref="ref", alt="alt") -> DataFrame:
    """Fill ``allele_length`` (ALT-REF length) and ``allele_type``; present values win."""
    n = (F.length(alt) - F.length(ref)).cast("int")
    kind = F.when(n == 0, "snv").when(n > 0, "ins").otherwise("del")
    have = set(df.columns)
    out = {"allele_length": F.coalesce("allele_length", n) if "allele_length" in have else n,
           "allele_type": F.coalesce("allele_type", kind) if "allele_type" in have else kind}
    return df.withColumns(out)


# ------------------------------------------------------------------ alleles

def split_multiallelics(df: DataFrame, trim: bool = True) -> DataFrame:
    """One row per ALT (``alt_index`` from 1). Calls keep their copies of that ALT as 1,
    other alleles become 0, missing stays missing. Shared trailing, then leading bases go."""
    out = df.select("*", F.posexplode("alts").alias("_i", "alt")).withColumn("alt_index", F.col("_i") + 1).drop("_i", "alts")
    if "gt" in df.columns:
        out = out.withColumn("gt", F.transform("gt", lambda a: F.when(a.isNull(), F.lit(None).cast("int"))
                                               .when(a == F.col("alt_index"), 1).otherwise(0)))
    if trim:
        out = out.withColumn("_t", trim_alleles("pos", "ref", "alt"))
        out = out.withColumns({"pos": F.col("_t.pos"), "ref": F.col("_t.ref"), "alt": F.col("_t.alt")}).drop("_t")
    return out


def trim_sites(df: DataFrame, order: str = "suffix_first", keep: int = 1) -> DataFrame:
    out = df.withColumn("_t", trim_alleles("pos", "ref", "alt", order, keep))
    return out.withColumns({"pos": F.col("_t.pos"), "ref": F.col("_t.ref"), "alt": F.col("_t.alt")}).drop("_t")


def find_untrimmed(df: DataFrame) -> DataFrame:
    """Non-repeat, non-symbolic, ``*``-free biallelic sites that trimming changes, trimmed,
    with ``original_id``; ids are assigned anew in file order."""
    plain = ((F.lower("allele_type") != "trv") & ~F.col("alt").contains("<") & ~F.col("alt").contains("*")
             & ~F.col("alt").contains(","))
    t = df.filter(plain).withColumn("_t", trim_alleles("pos", "ref", "alt"))
    t = t.filter((F.col("_t.ref") != F.col("ref")) | (F.col("_t.alt") != F.col("alt")))
    t = t.withColumns({"pos": F.col("_t.pos"), "ref": F.col("_t.ref"), "alt": F.col("_t.alt"),
                       "original_id": F.col("id")}).drop("_t")
    return assign_ids(t)


def add_end_tr(df: DataFrame) -> DataFrame:
    return df.withColumn("end", F.col("pos") + F.length("ref") - 1)


def fix_end(df: DataFrame) -> DataFrame:
    """Missing END: POS for INS/BND, POS+|SVLEN| for DUP/DEL/INV."""
    t = F.col("svtype")
    made = F.when(t.isin("INS", "BND"), F.col("pos")).when(t.isin("DUP", "DEL", "INV"), F.col("pos") + F.abs("svlen"))
    return df.withColumn("end", F.coalesce("end", made))


def abs_svlen(df: DataFrame) -> DataFrame:
    return df.withColumn("svlen", F.abs("svlen"))


# ------------------------------------------------------------------ ids

def _suffix_repeats(df: DataFrame, base: Column, order: str | list[str]) -> DataFrame:
    n = number_rows(df.withColumn("_base", base), ["_base"], order, "_k", count="_n")
    vid = F.when(F.col("_n") > 1, F.concat_ws("_", "_base", F.col("_k").cast("string"))).otherwise(F.col("_base"))
    return n.withColumn("id", vid).drop("_base", "_k", "_n")


def assign_ids(df: DataFrame, order: str | list[str] = "file_pos") -> DataFrame:
    """SNV ``chrom-pos-ref-alt``, others ``chrom-pos-TYPE-|len|``; repeats get ``_1.._n`` in file order."""
    snv = F.lower("allele_type") == "snv"
    base = F.when(snv, F.concat_ws("-", "chrom", "pos", "ref", "alt")).otherwise(
        F.concat_ws("-", "chrom", "pos", F.upper("allele_type"), F.abs("allele_length")))
    return _suffix_repeats(df, base, order)


def assign_tr_ids(df: DataFrame, less: int = 0, order: str = "file_pos") -> DataFrame:
    """``chrom-pos-TRV-len(ref)``; ``less=1`` counts the REF without its anchor base."""
    return _suffix_repeats(df, F.concat_ws("-", "chrom", "pos", F.lit("TRV"), F.length("ref") - less), order)


def set_id(df: DataFrame, template: list[str], sep: str = "-", strip_chr: bool = False) -> DataFrame:
    """Id from columns, e.g. ``["chrom", "pos", "ref", "alt"]``."""
    parts = [F.regexp_replace("chrom", "^chr", "") if strip_chr and x == "chrom" else F.col(x) for x in template]
    return df.withColumn("id", F.concat_ws(sep, *parts))


def lowered_tr_id(vid) -> Column:
    """``…-TRV-n`` with n reduced by one; other ids unchanged."""
    n = F.regexp_extract(c(vid), r"-TRV-(\d+)$", 1).try_cast("bigint")
    return F.when(n.isNotNull(), F.concat(F.regexp_replace(c(vid), r"\d+$", ""), (n - 1).cast("string"))).otherwise(c(vid))


def decrement_tr_ids(df: DataFrame) -> DataFrame:
    """Repeat rows change ``id``; other rows change ``trid``."""
    trv = F.col("allele_type") == "trv"
    return df.withColumns({"id": F.when(trv, lowered_tr_id("id")).otherwise(F.col("id")),
                           "trid": F.when(~trv, lowered_tr_id("trid")).otherwise(F.col("trid"))})


def reassign_suffixes(df: DataFrame, order: str = "file_pos") -> DataFrame:
    """Per position: a lone base id loses its suffix, repeated ones are numbered by old suffix, then file order.

    Rows are ranked among those of their suffix and shifted by the counts of smaller suffixes.
    """
    key = ["chrom", "pos", "_base"]
    d = df.withColumn("_base", id_base("id")).withColumn("_o", id_suffix("id").cast("bigint"))
    n = number_rows(d, [*key, "_o"], order, "_k")
    per = d.groupBy(*key, "_o").agg(F.count("*").alias("_c"))
    w = W.partitionBy(*key)
    shift = per.select(*key, "_o", F.coalesce(F.sum("_c").over(w.orderBy("_o").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_s"), F.sum("_c").over(w).alias("_n"))
    n = n.join(shift, [*key, "_o"])
    vid = F.when(F.col("_n") > 1, F.concat_ws("_", "_base", (F.col("_k") + F.col("_s")).cast("string"))).otherwise(F.col("_base"))
    return n.withColumn("id", vid).select(*df.columns)


def sort_same_position(df: DataFrame) -> DataFrame:
    """Contig order, position, |allele_length| (missing as 0), base id, numeric suffix."""
    return df.orderBy(*contig_sort("chrom"), "pos", F.coalesce(F.abs("allele_length"), F.lit(0)), id_base("id"), id_suffix("id"))


def sort_contigs(df: DataFrame) -> DataFrame:
    return df.orderBy(*contig_sort("chrom"), "pos")


# ------------------------------------------------------------------ symbolic forms

def symbolic_type(raw, move_all_dups: bool = False) -> Column:
    t = F.upper(c(raw))
    dup = t.contains("DUP") if move_all_dups else t == "DUP"
    bad = F.raise_error(F.concat(F.lit("unrecognised allele type "), F.coalesce(c(raw), F.lit("null")))).cast("string")
    return (F.when(dup, "DUP").when(t.contains("DEL"), "DEL")
            .when(t.contains("INS") | t.contains("DUP") | t.contains("NUMT"), "INS").otherwise(bad))


def origin_span(text) -> Column:
    """Struct(chrom, start, end) of one ``contig:start-end`` entry with anything behind it; NULL bounds where it does not read so."""
    place = F.substring_index(c(text), ":", -1)
    number = lambda i: F.regexp_extract(place, "^([0-9]+)-([0-9]+)", i).try_cast("int")
    return F.struct(F.substring_index(F.substring_index(c(text), ":", -2), ":", 1).alias("chrom"), number(1).alias("start"), number(2).alias("end"))


def longest_origin(origin) -> Column:
    """Struct(chrom, start, end) of the longest ``chr:s-e`` listed; the first of equals."""
    items = F.transform(F.split(c(origin), ","), origin_span)
    items = F.transform(items, lambda o: F.struct(F.regexp_extract(o["chrom"], "chr.+", 0).alias("chrom"), o["start"].alias("start"), o["end"].alias("end")))
    ok = F.filter(items, lambda o: o["start"].isNotNull() & (o["chrom"] != ""))
    first = F.lit(None).cast("struct<chrom:string,start:int,end:int>")
    return F.aggregate(ok, first, lambda best, o: F.when(
        best.isNull() | (F.abs(o["end"] - o["start"]) > F.abs(best["end"] - best["start"])), o).otherwise(best))


def convert_symbolic(df: DataFrame, move_all_dups: bool = False) -> DataFrame:
    """REF ``N``, ALT ``<TYPE>``, SVTYPE/SVLEN/END; DUPs move to their longest ORIGIN, keeping
    their place in ``original_chrom``/``original_pos``."""
    d = df.withColumn("svtype", symbolic_type("allele_type", move_all_dups))
    dup = F.col("svtype") == "DUP"
    d = d.withColumn("_o", F.when(dup, longest_origin("origin")))
    lost = F.raise_error(F.concat(F.lit("no origin for DUP "), F.coalesce("id", F.lit("null")))).cast("int")
    o_start = F.when(F.col("_o").isNull(), lost).otherwise(F.col("_o.start"))
    size = F.abs("allele_length")
    cols = {
        "original_chrom": F.when(dup, F.col("chrom")), "original_pos": F.when(dup, F.col("pos")),
        "svlen": F.when(dup, F.col("_o.end") - o_start).otherwise(size),
        "end": F.when(dup, F.col("_o.end")).when(F.col("svtype") == "INS", F.col("pos") + 1).otherwise(F.col("pos") + size),
        "ref": F.lit("N"), "alt": F.concat(F.lit("<"), "svtype", F.lit(">")),
        "chrom": F.when(dup, F.col("_o.chrom")).otherwise(F.col("chrom")),
        "pos": F.when(dup, o_start).otherwise(F.col("pos")),
    }
    return d.withColumns(cols).drop("_o")


def restore_alleles(df: DataFrame, originals: DataFrame) -> DataFrame:
    """REF and ALT taken back by id where ``originals`` has them."""
    o = originals.select("id", F.col("ref").alias("_ref"), F.col("alt").alias("_alt"))
    return (df.join(o, "id", "left").withColumns({"ref": F.coalesce("_ref", "ref"), "alt": F.coalesce("_alt", "alt")})
            .drop("_ref", "_alt"))


def revert_symbolic(df: DataFrame, originals: DataFrame) -> DataFrame:
    """Undo ``convert_symbolic``: alleles by id, moved DUPs back to their recorded place."""
    back = df.withColumns({"chrom": F.coalesce("original_chrom", "chrom"), "pos": F.coalesce("original_pos", "pos")})
    return restore_alleles(back, originals).drop("original_chrom", "original_pos")


def _recast(df: DataFrame, rows: Column, kind: str, end: Column) -> DataFrame:
    alt = F.when(rows & F.col("alt").isin("<DUP>", "<INS>"), F.lit(f"<{kind}>")).otherwise(F.col("alt"))
    return df.withColumns({"alt": alt, "end": F.when(rows, end).otherwise(F.col("end")),
                           "svtype": F.when(rows, F.lit(kind)).otherwise(F.col("svtype"))})


def dup_to_ins(df: DataFrame) -> DataFrame:
    """DUP rows become one-base INS rows, remembered in ``orig_dup``."""
    dup = F.col("svtype") == "DUP"
    return _recast(df.withColumn("orig_dup", dup), F.col("orig_dup"), "INS", F.col("pos") + 1)


def ins_to_dup(df: DataFrame) -> DataFrame:
    """Every INS stays and gains a DUP copy ending at ``pos + svlen``."""
    ins = df.filter("svtype = 'INS'")
    return df.unionByName(_recast(ins, F.lit(True), "DUP", F.col("pos") + F.col("svlen")))


def orig_dup_to_dup(df: DataFrame) -> DataFrame:
    """INS rows that carry ``orig_dup`` become DUP again."""
    was = (F.col("svtype") == "INS") & F.coalesce("orig_dup", F.lit(False))
    return _recast(df, was, "DUP", F.col("pos") + F.col("svlen"))


def absolute_origin(df: DataFrame, origin="origin", flank: int = 100) -> DataFrame:
    """``flank_…_<chr>:<…>:s-e_strand`` offsets become genome coordinates counted from
    ``max(1, pos - |len(ref)-len(alt)| - flank)``; other entries are kept."""
    base = F.greatest(F.lit(1), F.col("pos") - F.abs(F.length("ref") - F.length("alt")) - flank)
    pat = r"^flank_.*?([^_:]+):[^:]*:(\d+)-(\d+)(_[+-])$"

    def one(x):
        s, e = F.regexp_extract(x, pat, 2).try_cast("int"), F.regexp_extract(x, pat, 3).try_cast("int")
        made = F.concat(F.regexp_extract(x, pat, 1), F.lit(":"), (base + s).cast("string"), F.lit("-"),
                        (base + e).cast("string"), F.regexp_extract(x, pat, 4))
        return F.when(s.isNotNull(), made).otherwise(x)

    return df.withColumn(origin, F.array_join(F.transform(F.split(origin, ","), one), ","))


# Subtypes that collapse to insertions or deletions.
INS_SUBTYPES = ["complex_dup", "dup_interspersed", "inv_dup", "alu_ins", "line_ins", "sva_ins", "numt"]
DEL_SUBTYPES = ["alu_del", "line_del", "sva_del"]


def transform_allele_type(df: DataFrame, window: int = 10, size_sim: float = 0.9, min_size: int = 50) -> DataFrame:
    """Collapse subtypes to ins/del, kept in ``allele_subtype``. A dup stays dup only when tandem:
    one ORIGIN of similar size with POS in or near it (the origin's contig is not compared)."""
    n = F.abs("allele_length")
    behind = F.regexp_replace(F.substring_index("origin", ":", -1), "^[0-9]+-[0-9]+", "")
    span, stranded = origin_span("origin"), behind.isin("+", "-", "_+", "_-")  # nothing but the strand follows the end
    s, e = (F.when(stranded, span[x]) for x in ("start", "end"))
    near = F.col("pos").between(s, e) | (F.abs(s - F.col("pos")) <= window) | (F.abs(e - F.col("pos")) <= window)
    tandem = ((n >= min_size) & ~F.col("origin").contains(",") & s.isNotNull()
              & (size_similarity(n, e - s) >= size_sim) & near)
    tandem = F.coalesce(tandem, F.lit(False))
    t = F.col("allele_type")
    sub = F.when(t == "dup", F.lit("tandem_dup")).when(t.isin(INS_SUBTYPES + DEL_SUBTYPES), t)
    new = (F.when((t == "dup") & ~tandem, F.lit("ins")).when(t.isin(INS_SUBTYPES), F.lit("ins"))
           .when(t.isin(DEL_SUBTYPES), F.lit("del")).otherwise(t))
    return df.withColumns({"allele_subtype": sub, "allele_type": new})


def prune_meis(df: DataFrame) -> DataFrame:
    """Mobile elements outside their size range become ins/del without a sub family."""
    t, n = F.col("allele_type"), F.abs("allele_length")
    out = (t.isin("alu_ins", "alu_del") & ~n.between(250, 350)) | (t.isin("sva_ins", "sva_del") & ~n.between(1000, 4000))
    out = F.coalesce(out, F.lit(False))
    return df.withColumns({"sub_family": F.when(~out, F.col("sub_family")),
                           "allele_type": F.when(out, F.when(t.contains("ins"), "ins").otherwise("del")).otherwise(t)})


def flag_homopolymer_tr(df: DataFrame) -> DataFrame:
    parts = F.filter(F.split("motifs", ","), lambda m: (m != "") & (m != "."))
    one = F.array_min(F.transform(parts, F.length)) == 1
    return df.withColumn("homopolymer_trv", F.coalesce((F.col("allele_type") == "trv") & one, F.lit(False)))


def collapse_multiallelics(df: DataFrame, value="value", order="file_pos") -> DataFrame:
    """Repeat rows sharing an id become one row: ALTs and values joined in file order; others pass."""
    trv = F.col("allele_type") == "trv"
    items = F.array_sort(F.collect_list(F.struct(order, "alt", value)))
    merged = df.filter(trv).groupBy("chrom", "pos", "id", "ref", "allele_type").agg(
        F.array_join(F.transform(items, lambda x: x["alt"]), ",").alias("alt"),
        F.array_join(F.transform(items, lambda x: x[value].cast("string")), ",").alias(value))
    rest = df.filter(~trv).select("chrom", "pos", "id", "ref", "allele_type", "alt", F.col(value).cast("string").alias(value))
    return merged.unionByName(rest)
