"""Coordinates, alleles and genotypes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Canonical contigs in karyotype order, and RefSeq accessions of the two human assemblies by rule.
CANONICAL = [*(f"chr{n}" for n in range(1, 23)), "chrX", "chrY", "chrM"]
BUILDS = {"grch38": ["grch38", "hg38", "b38"], "grch37": ["grch37", "hg19", "b37"]}


def contig(raw: Column, style: str = "ucsc") -> Column:
    """Canonical contig name in UCSC or Ensembl style; NULL if it is none."""
    bare = F.upper(F.regexp_replace(F.trim(raw), r"^(?i)chr", ""))
    bare = F.when(bare == "MT", "M").otherwise(bare)
    name = F.concat(F.lit("chr"), bare)
    known = F.when(name.isin(CANONICAL), name)
    return known if style == "ucsc" else F.when(known == "chrM", "MT").otherwise(F.substring(known, 4, 2))


def contig_order(name: Column) -> Column:
    """0 to 24 in karyotype order; 25 for others."""
    at = F.array_position(F.array(*[F.lit(c) for c in CANONICAL]), name)
    return F.when(at > 0, at.cast("int") - 1).otherwise(25)


def build(raw: Column) -> Column:
    low = F.lower(F.trim(raw))
    return F.when(low.isin(BUILDS["grch38"]), "GRCh38").when(low.isin(BUILDS["grch37"]), "GRCh37")


def variant_id(build_: Column, contig_: Column, position: Column, ref: Column, alt: Column) -> Column:
    return F.concat_ws(":", build_, contig_, position.cast("string"), ref, alt)


def parsed_id(variant: Column) -> Column:
    """(build, contig, position, ref, alt) of an id; all NULL if it has other than five parts."""
    parts = F.split(variant, ":")
    ok = F.size(parts) == 5
    pick = lambda k: F.when(ok, F.get(parts, F.lit(k)))
    return F.struct(pick(0).alias("build"), pick(1).alias("contig"), pick(2).cast("long").alias("position"), pick(3).alias("ref"), pick(4).alias("alt"))


def refseq_contig(accession: Column) -> Column:
    """Contig of a RefSeq chromosome accession (NC_000001.x .. NC_000024.x, NC_012920.x); NULL for others."""
    n = F.nullif(F.regexp_extract(accession, r"^NC_0000(\d\d)\.\d+$", 1), F.lit("")).cast("int")
    return F.when(accession.rlike(r"^NC_012920\.\d+$"), "chrM").when(n.between(1, 24), F.get(F.array(*[F.lit(c) for c in CANONICAL[:24]]), n - 1))


def unusable_allele(ref: Column, alt: Column) -> Column:
    """Why an allele cannot be used; NULL if it can."""
    return (
        F.when(alt.isNull() | (alt == "") | (alt == "."), "missing_allele")
        .when(alt == "*", "spanning_deletion")
        .when(alt.rlike(r"[<>\[\]]"), "symbolic_allele")
        .when(~F.upper(ref).rlike("^[ACGTN]+$") | ~F.upper(alt).rlike("^[ACGTN]+$"), "non_acgtn_allele")
    )


def filter_status(raw: Column) -> Column:
    text = F.trim(raw)
    return F.when(raw.isNull() | text.isin("", "."), "missing").when(F.upper(text) == "PASS", "pass").otherwise("filtered")


def zygosity(genotype: Column, allele: Column) -> Column:
    """Of one allele (its index as text) in a GT text."""
    calls = F.split(F.translate(genotype, "|", "/"), "/")
    missing = genotype.isNull() | F.exists(calls, lambda x: x.isin(".", ""))
    own, n = F.size(F.filter(calls, lambda x: x == allele)), F.size(calls)
    return (
        F.when(missing, "unknown")
        .when(n == 1, F.when(own == 1, "hemi").otherwise("hom_ref"))
        .when(own == n, "hom_alt")
        .when(own > 0, "het")
        .otherwise("hom_ref")
    )


def allele_depths(ad: Column, dp: Column, index: Column, alleles: Column) -> Column:
    """(depth, ref_reads, alt_reads) of one allele; AD of the wrong length is unknown, DP falls back to its sum."""
    parts = F.transform(F.split(ad, ","), lambda x: x.try_cast("int"))
    ok = ad.isNotNull() & (F.size(parts) == alleles) & ~F.exists(parts, lambda x: x.isNull())
    total = F.aggregate(parts, F.lit(0), lambda a, x: a + x)
    return F.struct(
        F.coalesce(dp.try_cast("int"), F.when(ok, total)).alias("depth"),
        F.when(ok, F.get(parts, F.lit(0))).alias("ref_reads"),
        F.when(ok, F.get(parts, index)).alias("alt_reads"),
    )


def rounded_quality(qual: Column) -> Column:
    """Six significant digits."""
    scale = F.pow(F.lit(10.0), 5 - F.floor(F.log10(F.abs(qual))))
    return F.when(qual == 0, F.lit(0.0)).otherwise(F.rint(qual * scale) / scale)


def common_suffix(a: Column, b: Column, most: Column) -> Column:
    """Length of the longest common suffix, at most `most`."""
    same = F.transform(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), lambda i: (i <= most) & (F.substring(a, F.length(a) - i + 1, F.lit(1)) == F.substring(b, F.length(b) - i + 1, F.lit(1))))
    at = F.array_position(same, False)
    return F.when(at == 0, most).otherwise(at.cast("int") - 1)


def common_prefix(a: Column, b: Column, most: Column) -> Column:
    same = F.transform(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), lambda i: (i <= most) & (F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1))))
    at = F.array_position(same, False)
    return F.when(at == 0, most).otherwise(at.cast("int") - 1)


def trimmed(position: Column, ref: Column, alt: Column) -> Column:
    """(position, ref, alt) with common suffix, then common prefix cut, keeping a base of each."""
    s = common_suffix(ref, alt, F.least(F.length(ref), F.length(alt)) - 1)
    ref1, alt1 = F.substring(ref, F.lit(1), F.length(ref) - s), F.substring(alt, F.lit(1), F.length(alt) - s)
    p = common_prefix(ref1, alt1, F.least(F.length(ref1), F.length(alt1)) - 1)
    return F.struct((position + p).alias("position"), F.substring(ref1, p + 1, F.length(ref1)).alias("ref"), F.substring(alt1, p + 1, F.length(alt1)).alias("alt"))


def run_length(a: Column, b: Column, most: Column) -> Column:
    """Length of the common prefix of two texts, at most `most`, in one pass over both."""
    letters = lambda x: F.split(F.substring(x, F.lit(1), most), "")
    at = F.array_position(F.zip_with(letters(a), letters(b), lambda x, y: F.coalesce(x == y, F.lit(False))), False)
    return F.when(at == 0, most).otherwise(F.least(at.cast("int") - 1, most))


def left_shift(flank: Column, ref: Column, alt: Column, position: Column, cap: int = 1_000) -> Column:
    """How far an anchored indel moves left. `flank` is the reference up to and with the anchor base, of up to cap + 1 bases.

    It moves one base for each base that agrees, going back from the anchor, with the inserted or deleted unit written backwards
    over and over.
    """
    longer = F.when(F.length(ref) > F.length(alt), ref).otherwise(alt)
    unit = F.reverse(F.substring(longer, F.lit(2), F.length(longer)))
    most = F.least(F.length(flank), F.lit(cap), position - 1).cast("int")
    over = F.call_function("repeat", unit, F.ceil(most / F.greatest(F.length(unit), F.lit(1))).cast("int"))
    indel = (F.least(F.length(ref), F.length(alt)) == 1) & (F.length(ref) != F.length(alt)) & (F.substring(ref, F.lit(1), F.lit(1)) == F.substring(alt, F.lit(1), F.lit(1)))
    return F.when(~F.coalesce(indel & (most >= 1), F.lit(False)), 0).otherwise(run_length(F.reverse(flank), over, most))


def left_aligned(flank: Column, position: Column, ref: Column, alt: Column, cap: int = 1_000, shift: Column | None = None) -> Column:
    """(position, ref, alt, shift, status) after moving an anchored indel to its left-most place; `shift` if it is known already."""
    n = left_shift(flank, ref, alt, position, cap) if shift is None else shift
    longer = F.when(F.length(ref) > F.length(alt), ref).otherwise(alt)
    unit = F.substring(longer, F.lit(2), F.length(longer))
    k = F.length(unit)
    turn = F.pmod(n, F.greatest(k, F.lit(1)))
    anchor = F.substring(flank, F.length(flank) - n, F.lit(1))
    turned = F.concat(F.substring(unit, k - turn + 1, turn), F.substring(unit, F.lit(1), k - turn))
    whole = F.concat(anchor, turned)
    moved = n > 0
    return F.struct(
        (position - n).alias("position"),
        F.when(moved, F.when(F.length(ref) > F.length(alt), whole).otherwise(anchor)).otherwise(ref).alias("ref"),
        F.when(moved, F.when(F.length(ref) > F.length(alt), anchor).otherwise(whole)).otherwise(alt).alias("alt"),
        n.alias("shift"),
        F.when(flank.isNull(), "not_supplied").when(n >= cap, "shift_limit_reached").otherwise("usable").alias("status"),
    )


def right_shift(flank: Column, ref: Column, alt: Column, cap: int = 1_000) -> Column:
    """How far an anchored indel may move right. `flank` is the reference after the REF allele."""
    longer = F.when(F.length(ref) > F.length(alt), ref).otherwise(alt)
    unit = F.substring(longer, F.lit(2), F.length(longer))
    most = F.least(F.length(flank), F.lit(cap)).cast("int")
    over = F.call_function("repeat", unit, F.ceil(most / F.greatest(F.length(unit), F.lit(1))).cast("int"))
    return F.when((F.length(ref) == F.length(alt)) | F.coalesce(most < 1, F.lit(True)), 0).otherwise(run_length(flank, over, most))


def reference_matches(found: Column, ref: Column) -> Column:
    """Whether REF is what the reference has; NULL where it was not looked up."""
    return F.when(found.isNotNull() & (F.length(found) == F.length(ref)), F.upper(found) == F.upper(ref))


def allele_balance(ref_reads: Column, alt_reads: Column) -> Column:
    total = ref_reads + alt_reads
    return F.when(total > 0, alt_reads / total)


def allele_fraction(depth: Column, ref_reads: Column, alt_reads: Column, was_split: Column) -> Column:
    """Balance, or for a record split from a multiallelic site the share of its whole depth."""
    balance = allele_balance(ref_reads, alt_reads)
    return F.when(~was_split, balance).when(depth.isNull() | alt_reads.isNull(), None).when((depth <= 0) | (depth < ref_reads + alt_reads), balance).otherwise(alt_reads / depth)


def phase_consistent(phased: Column, genotype: Column) -> Column:
    """A phased call must be written with bars."""
    return F.when(phased, F.coalesce(genotype.contains("|"), F.lit(False))).otherwise(True)
