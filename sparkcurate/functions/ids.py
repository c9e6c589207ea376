"""Row-local predicates and identifier expressions. All are plain Columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ambiguity codes and absolute length floors per molecule.
AMBIGUOUS_NUCLEOTIDE = "RYSWKMBDHVN"
AMBIGUOUS_PROTEIN = "XBZJOU"
FLOOR_NUCLEOTIDE = 200
FLOOR_PROTEIN = 100


def ambiguity_codes(molecule: str) -> str:
    return AMBIGUOUS_NUCLEOTIDE if molecule == "nucleotide" else AMBIGUOUS_PROTEIN


def length_floor(molecule: str) -> int:
    return FLOOR_NUCLEOTIDE if molecule == "nucleotide" else FLOOR_PROTEIN


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def mentions_any(fields: Sequence[Column], terms: Iterable[str]) -> Column:
    """Any term inside any field, case-insensitive; fields cannot match across their border."""
    text = F.lower(F.concat_ws("\n", *[F.coalesce(f, F.lit("")) for f in fields]))
    wanted = [term.lower() for term in terms]

    def hit(low: Column) -> Column:
        out = F.lit(False)
        for term in wanted:
            out = out | F.contains(low, F.lit(term))
        return out

    return bound(text, hit) if wanted else F.lit(False)


def ambiguous_fraction(seq: Column, codes: str) -> Column:
    """Share of ambiguity codes, in either case."""
    both = "".join(dict.fromkeys(codes.upper() + codes.lower()))
    return F.regexp_count(seq, F.lit(f"[\\Q{both}\\E]")) / F.greatest(F.length(seq), F.lit(1))


def mentions(field: Column, keyword: Column | str) -> Column:
    word = F.lit(keyword) if isinstance(keyword, str) else keyword
    return F.contains(F.lower(field), F.lower(word))


def is_protected_id(accession: Column) -> Column:
    """Reference-style identifier: two capitals followed by an underscore."""
    return F.coalesce(F.trim(accession).rlike("^[A-Z]{2}_"), F.lit(False))


def named_species(name: Column, family: Column) -> Column:
    """False for placeholder taxa of a family."""
    low = F.lower(name)
    return ~(
        F.contains(low, F.lit("environmental samples"))
        | F.contains(low, F.concat(F.lit("unclassified "), F.lower(family)))
    )


def known(value: Column) -> Column:
    """NULL for blank values and for the placeholder "unknown"."""
    trimmed = F.nullif(F.trim(value), F.lit(""))
    return F.nullif(trimmed, F.lit("unknown"))


def all_of(conditions: Iterable[Column]) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & condition
    return out


def record_selection(
    molecule: str,
    region: str,
    *,
    title: Column,
    gene: Column,
    protein_name: Column,
    organism: Column,
    reference: Column,
    patent: Column,
    segment: str | None = None,
    reference_only: bool = False,
    exclude: Iterable[str] = (),
) -> Column:
    """Which records of a taxon's subtree belong to the wanted region."""
    genome, sequence, cds = (mentions(title, f"complete {w}") for w in ("genome", "sequence", "cds"))
    if segment:
        wanted = mentions(title, segment) & (sequence | cds | genome)
    elif region == "whole_genome":
        wanted = (genome | sequence) if molecule == "nucleotide" else F.lit(True)
    elif molecule == "protein":
        wanted = mentions(protein_name, region) | (F.lower(gene) == region.lower())
    else:
        wanted = (F.lower(gene) == region.lower()) & ~genome & ~sequence
    parts = [wanted, ~patent, *[~mentions(organism, term) for term in exclude]]
    if reference_only:
        parts.append(reference)
    return F.coalesce(all_of(parts), F.lit(False))


def marker_selection(
    names: Column,
    *,
    protein_name: Column,
    organism: Column,
    reference: Column,
    patent: Column,
    reference_only: bool = False,
    exclude: Iterable[str] = (),
) -> Column:
    """Which proteins carry one of a marker's names (an array column)."""
    wanted = F.exists(F.filter(names, lambda n: F.length(n) > 0), lambda n: mentions(protein_name, n))
    parts = [wanted, ~patent, *[~mentions(organism, term) for term in exclude]]
    if reference_only:
        parts.append(reference)
    return F.coalesce(all_of(parts), F.lit(False))
