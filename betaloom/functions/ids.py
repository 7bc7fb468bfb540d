"""Column functions over site ids, barcodes, categories and coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The chromosome names in order, and the spellings of clinical categories.
CHROMOSOMES = [f"chr{c}" for c in [*range(1, 23), "X", "Y", "M"]]
CATEGORIES = ["CRC", "Control", "polyps", "HGD", "other_cancer", "excluded"]
CATEGORY_SYNONYMS = {
    "crc": "CRC",
    "colorectal cancer": "CRC",
    "colorectal": "CRC",
    "control": "Control",
    "ctrl": "Control",
    "normal": "Control",
    "healthy": "Control",
    "polyps": "polyps",
    "polyp": "polyps",
    "adenoma": "polyps",
    "hgd": "HGD",
    "other cancer": "other_cancer",
    "excluded": "excluded",
    "pending": "excluded",
}
ASPECTS = {"F": "molecular_function", "P": "biological_process", "C": "cellular_component"}

SITE_ID = r"^(chr(?:[1-9]|1[0-9]|2[0-2]|X|Y|M))_([0-9]+)$"
UNKNOWN_CHROMOSOME = 99


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_site_id(site: Column | str) -> Column:
    """Whether an id is a known chromosome, "_" and a position; null for null."""
    return col(site).rlike(SITE_ID)


def site_chrom(site: Column | str) -> Column:
    """The chromosome of a valid site id, else null."""
    return F.when(is_site_id(site), F.regexp_extract(col(site), SITE_ID, 1))


def site_pos(site: Column | str) -> Column:
    """The 1-based position of a valid site id, else null."""
    return F.when(is_site_id(site), F.regexp_extract(col(site), SITE_ID, 2).try_cast("bigint"))


def split_site(site: Column | str) -> tuple[Column, Column]:
    """Chromosome and position by the last "_", without validation; a position that is no number is null."""
    pos = F.substring_index(col(site), "_", -1)
    return F.left(col(site), F.length(col(site)) - F.length(pos) - 1), pos.try_cast("bigint")


def make_site_id(chrom: Column | str, pos: Column | str) -> Column:
    """chrom_pos; fails the query for an unknown chromosome or a position below 1."""
    good = col(chrom).isin(CHROMOSOMES) & (col(pos) >= 1)
    return F.when(good, F.concat_ws("_", col(chrom), col(pos).cast("string"))).otherwise(F.raise_error(F.concat(F.lit("not a site: "), F.coalesce(col(chrom), F.lit("null")))))


def chrom_index(chrom: Column | str) -> Column:
    """0 for chr1 to 24 for chrM; 99 for any other name."""
    return F.coalesce(F.nullif(F.array_position(F.lit(CHROMOSOMES), col(chrom)), F.lit(0)) - 1, F.lit(UNKNOWN_CHROMOSOME)).cast("int")


def site_order(site: Column | str) -> list[Column]:
    """Sort keys: chromosome order, position; invalid ids last, by name."""
    return [(~is_site_id(site)).asc(), chrom_index(site_chrom(site)).asc(), site_pos(site).asc(), col(site).asc()]


def overlaps(start1, end1, start2, end2) -> Column:
    """Whether two half-open intervals share a position."""
    return (col(start1) < col(end2)) & (col(start2) < col(end1))


def strip(text: Column | str) -> Column:
    """text without white space of any kind at its ends: that of Unicode, and the four separator controls."""
    return F.regexp_replace(col(text), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def normalize_barcode(barcode: Column | str) -> Column:
    return F.upper(strip(barcode))


def is_barcode(barcode: Column | str) -> Column:
    return col(barcode).rlike(r"^[A-Za-z0-9_\-]{3,}$")


def normalize_category(category: Column | str) -> Column:
    """The canonical spelling; an unknown category stays, stripped."""
    plain = strip(category)
    known = F.create_map(*[F.lit(x) for pair in CATEGORY_SYNONYMS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(plain)), plain)


def strip_version(identifier: Column | str) -> Column:
    return F.substring_index(col(identifier), ".", 1)


def aspect_name(letter: Column | str) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ASPECTS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, col(letter)), col(letter))


def present(value: Column | str) -> Column:
    """value as double, NaN turned to null, so that all aggregates skip it."""
    v = col(value).cast("double")
    return F.when(~F.isnan(v), v)


def quoted(text: Column | str) -> Column:
    """text with backslash, quote, LF, CR and tab escaped by a backslash, for text exports of a graph."""
    out = col(text)
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    return out


def file_label(quantile: float) -> str:
    return str(quantile).replace(".", "_")


def percent(part: Column | str, whole: Column | str) -> Column:
    return F.bround(F.try_divide(col(part) * F.lit(100.0), col(whole)), 1)
