"""Names, labels and keys built from record fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted years and the two accession forms.
YEAR_PATTERN = r"\b(1[89]\d{2}|20\d{2})\b"
ACCESSION_PATTERN = r"\b([A-Z]{1,3}_?\d+(?:\.\d+)?)\b"
DB_SOURCE_PATTERN = r"(?i)accession\s+([A-Z]{1,3}_?\d+(?:\.\d+)?)"


def year_of(date: Column) -> Column:
    """First plausible year in a free-form date, "" when there is none."""
    return F.regexp_extract(F.coalesce(date, F.lit("")), YEAR_PATTERN, 1)


def _clean(value: Column) -> Column:
    return F.coalesce(F.nullif(F.replace(value, F.lit(" "), F.lit("_")), F.lit("")), F.lit("unknown"))


def display_name(species: Column, strain: Column, accession: Column, host: Column) -> Column:
    """species|strain|accession, with the host appended only when known."""
    return F.concat_ws("|", _clean(species), _clean(strain), _clean(accession), F.nullif(_clean(host), F.lit("unknown")))


def genome_display_name(species: Column, genome: Column) -> Column:
    return F.concat_ws("|", _clean(species), _clean(genome))


def family_prefix(family: Column) -> Column:
    """First four consonants, or the first four characters when there are fewer."""
    consonants = F.regexp_replace(F.upper(family), "[^A-Z]|[AEIOU]", "")
    return F.when(F.length(consonants) >= 4, F.substring(consonants, 1, 4)).otherwise(
        F.upper(F.substring(family, 1, 4))
    )


def molecule_region(molecule: Column, region: Column, segment: Column) -> Column:
    kind = F.when(molecule == "protein", "protein").otherwise("nucleotide")
    part = (
        F.when(F.length(segment) > 0, segment)
        .when(region == "whole_genome", "whole genome")
        .otherwise(F.concat(F.lit("gene: "), region))
    )
    return F.concat_ws(", ", kind, part)


def _slug(name: Column, unwanted: str) -> Column:
    slug = F.regexp_replace(F.regexp_replace(name, unwanted, "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("marker"))


def marker_slug(name: Column) -> Column:
    return _slug(name, "[^A-Za-z0-9_-]+")


def charset_name(name: Column) -> Column:
    return _slug(name, "[^A-Za-z0-9_]+")


def lineage_string(names: Column) -> Column:
    return F.array_join(names, "; ")


def request_key(taxid: Column, region: Column, segment: Column, max_rows: Column) -> Column:
    seg = F.coalesce(F.replace(F.nullif(segment, F.lit("")), F.lit(" "), F.lit("_")), F.lit("none"))
    reg = F.translate(region, " /", "__")
    return F.concat_ws("_", F.concat(F.lit("txid"), taxid), reg, seg, max_rows.cast("string"))


def first_of(values: Column) -> Column:
    """First element of an array, NULL for an empty or missing one."""
    return F.get(values, F.lit(0))


def source_feature(features: Column) -> Column:
    return first_of(F.filter(features, lambda f: f["type"] == "source"))


def _qualifier(feature: Column, key: str) -> Column:
    return F.nullif(first_of(feature["qualifiers"][key]), F.lit(""))


def source_metadata(organism: Column, features: Column) -> dict[str, Column]:
    """Metadata columns of the first source feature."""
    src = source_feature(features)
    unknown = F.lit("unknown")
    xref = F.coalesce(_qualifier(src, "db_xref"), F.lit(""))
    return {
        "species": F.coalesce(F.nullif(F.trim(organism), F.lit("")), unknown),
        "strain": F.coalesce(
            _qualifier(src, "strain"),
            _qualifier(src, "isolate"),
            F.when(src.isNull(), F.lit("")),
            unknown,
        ),
        "host": F.coalesce(_qualifier(src, "host"), _qualifier(src, "lab_host"), unknown),
        "collection_date": F.coalesce(_qualifier(src, "collection_date"), unknown),
        "location": F.coalesce(_qualifier(src, "country"), unknown),
        "taxon_id": F.regexp_extract(xref, "^taxon:((?:(?!taxon:).)*)", 1),
    }


def source_accession(features: Column, db_source: Column) -> Column:
    """Accession of the nucleotide record a protein was translated from, "" when unknown."""
    coded = F.flatten(F.transform(features, lambda f: F.coalesce(f["qualifiers"]["coded_by"], F.array().cast("array<string>"))))
    hits = F.filter(F.transform(coded, lambda c: F.regexp_extract(c, ACCESSION_PATTERN, 1)), lambda a: a != "")
    return F.coalesce(
        first_of(hits), F.regexp_extract(F.coalesce(db_source, F.lit("")), DB_SOURCE_PATTERN, 1)
    )


def isolate_of(features: Column) -> Column:
    """First non-blank isolate or strain over the source features, "" when none."""
    sources = F.filter(features, lambda f: f["type"] == "source")
    names = F.transform(
        sources,
        lambda f: F.coalesce(
            F.nullif(F.trim(first_of(f["qualifiers"]["isolate"])), F.lit("")),
            F.nullif(F.trim(first_of(f["qualifiers"]["strain"])), F.lit("")),
        ),
    )
    return F.coalesce(first_of(F.filter(names, lambda n: n.isNotNull())), F.lit(""))
