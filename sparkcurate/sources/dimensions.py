"""Domain tables: segmented families, single-marker families, marker presets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Segmented families and the segment used for each.
SEGMENTED_FAMILIES = [
    ("Arenaviridae", "segment L"),
    ("Hantaviridae", "segment L"),
    ("Nairoviridae", "segment L"),
    ("Peribunyaviridae", "segment L"),
    ("Phenuiviridae", "segment L"),
    ("Tospoviridae", "segment L"),
    ("Leishbuviridae", "segment L"),
    ("Phasmaviridae", "segment L"),
    ("Wupedeviridae", "segment L"),
    ("Discoviridae", "segment L"),
    ("Cruliviridae", "segment L"),
    ("Blumeviridae", "segment L"),
    ("Konkoviridae", "segment L"),
    ("Mypoviridae", "segment L"),
    ("Tulasviridae", "segment L"),
    ("Steitzviridae", "segment L"),
    ("Birnaviridae", "segment B"),
    ("Picobirnaviridae", "segment 1"),
    ("Reoviridae", "segment 1"),
    ("Sedoreoviridae", "segment 1"),
    ("Spinareoviridae", "segment 1"),
    ("Partitiviridae", "RNA1"),
    ("Amalgaviridae", "RNA1"),
    ("Megabirnaviridae", "RNA1"),
    ("Fimoviridae", "RNA1"),
    ("Chrysoviridae", "RNA1"),
    ("Quadriviridae", "RNA1"),
    ("Orthomyxoviridae", "PB1"),
]

# DNA families and the single region used for each.
DNA_FAMILIES = [
    ("Circoviridae", "Rep"),
    ("Smacoviridae", "Rep"),
    ("Anelloviridae", "ORF1"),
    ("Hepadnaviridae", "whole_genome"),
    ("Parvoviridae", "NS1"),
    ("Polyomaviridae", "large T antigen"),
    ("Papillomaviridae", "L1"),
    ("Adenoviridae", "hexon"),
    ("Orthoherpesviridae", "DNA polymerase"),
    ("Herpesviridae", "DNA polymerase"),
    ("Alloherpesviridae", "DNA polymerase"),
    ("Malacoherpesviridae", "DNA polymerase"),
    ("Nimaviridae", "DNA polymerase"),
    ("Hytrosaviridae", "DNA polymerase"),
    ("Phycodnaviridae", "DNA polymerase"),
    ("Mimiviridae", "DNA polymerase"),
    ("Marseilleviridae", "DNA polymerase"),
    ("Pandoraviridae", "DNA polymerase"),
    ("Pithoviridae", "DNA polymerase"),
    ("Medusaviridae", "DNA polymerase"),
    ("Poxviridae", "rpo147"),
    ("Iridoviridae", "major capsid protein"),
    ("Asfarviridae", "B646L"),
    ("Baculoviridae", "lef-8"),
    ("Nudiviridae", "lef-8"),
    ("Ascoviridae", "lef-8"),
]

# Families of a preset.
PRESET_FAMILIES = [
    ("Poxviridae", "Poxviridae"),
    ("Orthoherpesviridae", "Orthoherpesviridae"),
    ("Herpesviridae", "Orthoherpesviridae"),
    ("Alloherpesviridae", "Orthoherpesviridae"),
    ("Malacoherpesviridae", "Orthoherpesviridae"),
    ("Asfarviridae", "Asfarviridae"),
    ("Iridoviridae", "Iridoviridae"),
    ("Baculoviridae", "Baculoviridae"),
    ("Nudiviridae", "Baculoviridae"),
    ("Ascoviridae", "Baculoviridae"),
    ("Mimiviridae", "Mimiviridae"),
    ("Phycodnaviridae", "Mimiviridae"),
    ("Marseilleviridae", "Mimiviridae"),
    ("Pithoviridae", "Mimiviridae"),
    ("Pandoraviridae", "Mimiviridae"),
    ("Medusaviridae", "Mimiviridae"),
]

# Markers of each preset in order: preset, name, aliases, locus tag hint.
PRESET_MARKERS = [
    ("Poxviridae", "DNA polymerase", ["DNA-directed DNA polymerase", "DNA pol"], "E9L|polB"),
    ("Poxviridae", "DNA-directed RNA polymerase 147 kDa subunit", ["RPO147", "RNA polymerase subunit RPO147"], "A24R|RPO147|rpo147"),
    ("Poxviridae", "DNA-directed RNA polymerase 132 kDa subunit", ["RPO132", "RNA polymerase subunit RPO132"], "J6R|RPO132|rpo132"),
    ("Poxviridae", "mRNA capping enzyme large subunit", ["capping enzyme large subunit"], "D1R"),
    ("Poxviridae", "DNA helicase", ["NPH-II", "transcript release factor"], "A18R|NPH2"),
    ("Poxviridae", "poly(A) polymerase catalytic subunit", ["poly(A) polymerase large subunit"], "E1L|VP55"),
    ("Poxviridae", "late transcription factor VLTF-3", ["VLTF3", "late transcription factor 3"], "A1L|VLTF"),
    ("Poxviridae", "uracil-DNA glycosylase", ["UNG"], "D4R|UNG"),
    ("Poxviridae", "single-stranded DNA-binding protein", ["ssDNA binding protein"], "I3L|ssb"),
    ("Orthoherpesviridae", "DNA polymerase catalytic subunit", ["DNA-directed DNA polymerase catalytic subunit", "DNA polymerase"], "UL30"),
    ("Orthoherpesviridae", "helicase-primase helicase subunit", ["DNA helicase"], "UL5\\b"),
    ("Orthoherpesviridae", "helicase-primase primase subunit", ["primase"], "UL52"),
    ("Orthoherpesviridae", "major capsid protein", ["MCP", "capsid protein VP5"], "UL19|VP5\\b"),
    ("Orthoherpesviridae", "capsid triplex subunit 2", ["VP23", "minor capsid protein"], "UL18|VP23"),
    ("Orthoherpesviridae", "DNA packaging terminase subunit 1", ["terminase ATPase subunit", "DNA packaging terminase ATPase"], "UL15"),
    ("Orthoherpesviridae", "single-stranded DNA-binding protein", ["major DNA-binding protein", "ICP8"], "UL29|ICP8"),
    ("Asfarviridae", "DNA polymerase B", ["DNA polymerase", "DNA-directed DNA polymerase"], "polB"),
    ("Asfarviridae", "major capsid protein p72", ["major capsid protein", "p72", "capsid protein p72"], "B646L|p72"),
    ("Asfarviridae", "packaging ATPase", ["A32-like ATPase", "FtsK-like ATPase"], "A32"),
    ("Asfarviridae", "primase-helicase", ["D5-like helicase", "superfamily 3 helicase"], "D5|A18"),
    ("Asfarviridae", "late transcription factor 3", ["VLTF-3"], "VLTF"),
    ("Asfarviridae", "DNA-directed RNA polymerase subunit", ["RPB1-like subunit", "RNA polymerase largest subunit"], "NP1450L|RPB1"),
    ("Iridoviridae", "major capsid protein", ["MCP"], "MCP"),
    ("Iridoviridae", "DNA polymerase", ["DNA-directed DNA polymerase"], "polB"),
    ("Iridoviridae", "packaging ATPase", ["A32-like ATPase"], "A32"),
    ("Iridoviridae", "ribonuclease III", ["RNase III"], "rnc"),
    ("Iridoviridae", "DNA helicase", ["D5-like helicase"], "D5|helicase"),
    ("Iridoviridae", "late transcription factor 3", ["VLTF-3"], "VLTF"),
    ("Iridoviridae", "immediate-early protein ICP-46", ["ICP46"], "ICP46"),
    ("Baculoviridae", "DNA polymerase", ["DNA-directed DNA polymerase"], "polB"),
    ("Baculoviridae", "late expression factor 8", ["LEF-8", "RNA polymerase subunit LEF-8"], "lef-?8"),
    ("Baculoviridae", "late expression factor 9", ["LEF-9", "RNA polymerase subunit LEF-9"], "lef-?9"),
    ("Baculoviridae", "DNA helicase P143", ["p143", "helicase"], "p143|helicase"),
    ("Baculoviridae", "per os infectivity factor 1", ["PIF-1", "P74"], "pif-?1|p74"),
    ("Baculoviridae", "per os infectivity factor 2", ["PIF-2"], "pif-?2"),
    ("Baculoviridae", "major capsid protein", ["VP39", "capsid protein VP39"], "vp39|MCP"),
    ("Mimiviridae", "DNA polymerase", ["DNA-directed DNA polymerase", "polymerase B", "DNA polymerase B"], "polB"),
    ("Mimiviridae", "major capsid protein", ["MCP", "capsid protein"], "MCP"),
    ("Mimiviridae", "packaging ATPase", ["A32-like ATPase", "FtsK-like ATPase"], "A32"),
    ("Mimiviridae", "primase-helicase", ["D5-like helicase", "superfamily 3 helicase"], "D5"),
    ("Mimiviridae", "late transcription factor 3", ["VLTF-3"], "VLTF"),
    ("Mimiviridae", "mRNA capping enzyme", ["capping enzyme large subunit"], None),
    ("Mimiviridae", "DNA-directed RNA polymerase subunit alpha", ["RNA polymerase RPB1", "largest subunit RNA polymerase"], "RPB1"),
    ("Mimiviridae", "DNA-directed RNA polymerase subunit beta", ["RNA polymerase RPB2", "second-largest subunit RNA polymerase"], "RPB2"),
]
# Aliases used by one subfamily only.
SUBFAMILY_ALIASES = {("Poxviridae", "DNA polymerase"): {"Entomopoxvirinae": ["DNA polymerase B"]}}

MARKER_SCHEMA = (
    "family STRING, marker_order INT, name STRING, aliases ARRAY<STRING>, sub_aliases MAP<STRING,ARRAY<STRING>>, "
    "len_min INT, len_max INT, locus_tag_hint STRING"
)


def segmented_families(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEGMENTED_FAMILIES, "family STRING, segment STRING")


def dna_families(spark: SparkSession) -> DataFrame:
    rows = [(f, region, "nucleotide" if region == "whole_genome" else "protein") for f, region in DNA_FAMILIES]
    return spark.createDataFrame(rows, "family STRING, region STRING, molecule STRING")


def preset_markers(family: str) -> list[tuple]:
    """Name, aliases and hint of the markers of a family, in order."""
    preset = dict(PRESET_FAMILIES)[family]
    return [(name, aliases, hint) for key, name, aliases, hint in PRESET_MARKERS if key == preset]


def marker_presets(spark: SparkSession) -> DataFrame:
    rows = []
    for family, _ in PRESET_FAMILIES:
        for order, (name, aliases, hint) in enumerate(preset_markers(family), start=1):
            rows.append((family, order, name, aliases, SUBFAMILY_ALIASES.get((family, name), {}), None, None, hint))
    return spark.createDataFrame(rows, MARKER_SCHEMA)
