"""Column functions on names, ranks, hosts and genome types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The parts of a read header that name the mate or the run.
MATE_PATTERN = r"^@|\s+[12]:[NnYy]:\d+:.*$|#0/[12]$|[/._][12]$"
# File name parts to cut off, in this order.
FILE_PARTS = [".mmseqs", ".tsv", ".txt", ".gz", ".fastq", ".fasta", ".blast6", "_R1", "_R2", ".R1", ".R2", "_1", "_2", "/1", "/2"]
# Rank names that mean no rank, levels, report codes, and the ranks that are commonly reported.
NO_RANKS = ["clade", "genotype", "isolate", "serogroup", "serotype", "unranked"]
RANK_LEVELS = {
    "acellular root": 0, "realm": 1, "kingdom": 2, "phylum": 3, "subphylum": 4, "class": 5, "subclass": 6, "order": 7,
    "suborder": 8, "family": 9, "subfamily": 10, "genus": 11, "subgenus": 12, "species": 13, "subspecies": 14, "strain": 15,
}
RANK_CODES = {
    "superkingdom": "D", "realm": "D", "kingdom": "K", "phylum": "P", "class": "C", "order": "O", "family": "F",
    "genus": "G", "species": "S", "subspecies": "SS", "strain": "S1",
}
MAJOR_RANKS = ["acellular root", "realm", "kingdom", "phylum", "class", "order", "family", "genus", "species"]
# Phage clades (lower case), clades with a known host, and words of environmental sources.
PHAGE_CLADES = [
    "caudoviricetes", "caudovirales", "microviridae", "inoviridae", "leviviricetes", "microviricetes", "tectiviridae",
    "corticoviridae", "tubulavirales", "faserviricetes",
]
CLADE_HOSTS = {"crassvirales": "Bacteroides", "suoliviridae": "Bacteroides"}
STEM_HOSTS = {"cyano": "Cyanobacteria", "mycobacterio": "Mycobacterium"}
ENVIRONMENTS = ["metagenome", "sludge", "seawater", "sediment", "environment", "soil", "wastewater", "uncultured"]


def normalize_read_id(header: Column) -> Column:
    """The header without `@`, run part and mate suffix, each cut once in one pass."""
    return F.regexp_replace(header, MATE_PATTERN, "")


def sample_name(file_name: Column) -> Column:
    """The sample's name from a FASTQ or hit file's name: directories, extensions and mate marks go, wherever they stand."""
    out = F.regexp_extract(file_name, "([^/]*)$", 1)
    for part in FILE_PARTS:
        out = F.replace(out, F.lit(part), F.lit(""))
    return out


def _lookup(key: Column, table: dict, default) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[key], F.lit(default))


def normalize_rank(rank: Column) -> Column:
    low = F.lower(F.trim(rank))
    return F.when(F.coalesce(rank, F.lit("")) == "", "no rank").when(low.isin(NO_RANKS), "no rank").otherwise(low)


def rank_level(rank: Column) -> Column:
    """0 at the top; 99 without a rank."""
    return _lookup(normalize_rank(rank), RANK_LEVELS, 99)


def rank_code(rank: Column) -> Column:
    return _lookup(normalize_rank(rank), RANK_CODES, "-")


def is_major_rank(rank: Column) -> Column:
    return normalize_rank(rank).isin(MAJOR_RANKS)


def compare_ranks(a: Column, b: Column) -> Column:
    """-1 if a stands higher, 1 if lower, 0 if level."""
    return F.signum(rank_level(a) - rank_level(b)).cast("int")


def unversioned(accession: Column) -> Column:
    return F.substring_index(accession, ".", 1)


def host_genus(host: Column, environmental: str | None = None) -> Column:
    """The host's first word; null if empty or human, and `environmental` for environmental sources."""
    low = F.lower(host)
    env = F.lit(False)
    for word in ENVIRONMENTS:
        env = env | F.contains(low, F.lit(word))
    return (
        F.when(F.coalesce(F.trim(host), F.lit("")) == "", None)
        .when(env, F.lit(environmental))
        .when(F.startswith(low, F.lit("homo ")), None)
        .otherwise(F.split(F.trim(host), r"\s+")[0])
    )


def host_from_title(title: Column) -> Column:
    """A phage's host genus from its title: `<Stem>phage ...` is no genus by itself, `<Host> phage ...` is; else null."""
    return F.nullif(F.regexp_extract(title, r"^([A-Z][a-z]+) (?:[a-z]+ )?(?:phage|virus)\b", 1), F.lit(""))


def phage_stem(title: Column) -> Column:
    """X of a title whose first word is `<X>phage`, in lower case; null if there is none, or if X says nothing of the host."""
    stem = F.lower(F.regexp_extract(title, r"^([A-Za-z]{3,})phages?\b", 1))
    return F.when(~stem.isin("", "bacterio", "pro", "viro", "macro"), stem)


def stem_key(name: Column) -> Column:
    """A genus or the stem of a phage's name without its ending."""
    return F.regexp_replace(F.lower(name), "(ium|um|us|ia|a|is|es|io|o)$", "")


def is_phage(title: Column, lineage_names: Column) -> Column:
    """The title has `phage`, or the lineage meets a phage clade."""
    names = F.transform(lineage_names, F.lower)
    return F.coalesce(F.contains(F.lower(title), F.lit("phage")), F.lit(False)) | F.coalesce(F.arrays_overlap(names, F.lit(PHAGE_CLADES)), F.lit(False))


def genome_type(composition: Column) -> Column:
    """A genome composition or molecule text as one of RT, dsRNA, ssRNA, ssDNA, dsDNA and Other."""
    has = lambda s: F.contains(composition, F.lit(s))
    return (
        F.when(F.coalesce(composition, F.lit("")).isin("", "Viroid", "Unassigned"), "Other")
        .when(has("RT"), "RT").when(has("dsRNA"), "dsRNA").when(has("ssRNA"), "ssRNA")
        .when(has("ssDNA") & ~has("dsDNA"), "ssDNA").when(has("dsDNA") & ~has("ssDNA"), "dsDNA").otherwise("Other")
    )
