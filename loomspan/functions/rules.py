"""Ordered rules as column expressions: paths, domains, layouts, file kinds (STR-22 to STR-26, FLT-15)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomspan.functions.strings import any_contains

# A part of a path and what it says of the file: folder, kind of data, priority; the first that fits counts.
PATH_RULES = [
    ("tcga", "tcga", "genomic_clinical", 1), ("gse", "geo_gse", "gene_expression_series", 2), ("ncl-", "cananolab", "nanoparticle_characterization", 1),
    ("zenodo", "zenodo", "supplementary_data", 2), ("depmap", "depmap_ccle", "drug_sensitivity", 1), ("gdsc", "gdsc", "drug_sensitivity", 1), ("clinical", "misc_clinical", "clinical_data", 4),
]
NO_PATH_RULE = ("uncategorized", "unknown", 99)
# Words of terms that belong to a domain, as substrings.
GENOMIC_WORDS = ["gene", "rna", "mutation", "gse", "gsm", "tcga", "expression", "tumor", "somatic", "omics"]
NANO_WORDS = ["nano", "particle", "drug", "liposome", "delivery", "chemistry", "payload"]
# Words of a table's header that tell what it is about.
BREAST_TAGS = ["breast cancer", "brca", "tnbc", "triple-negative", "her2", "er+", "pr+", "luminal", "basal", "mda-mb-231", "mcf-7", "t47d", "bt-474", "sk-br-3", "4t1", "pdx", "xenograft"]
NANO_TAGS = [
    "nanoparticle", "nanomedicine", "liposome", "lnp", "exosome", "micelle", "dendrimer", "plga", "peg", "spion", "iron oxide", "gold nanoparticle", "aunp", "silver nanoparticle", "agnp",
    "quantum dot", "qd", "graphene", "mof", "silica", "sio2", "chitosan", "albumin", "nanocapsule", "biodistribution", "pk", "zeta potential", "hydrodynamic diameter", "pdi",
]


def first_rule(c: Column, rules: Sequence[tuple[str, object]], default: object) -> Column:
    """The value of the first rule whose word the text holds, in lower case."""
    low, out = F.lower(c), None
    for word, value in rules:
        test = F.contains(low, F.lit(word))
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def path_rules(path: Column) -> list[Column]:
    """Folder, kind of data and priority of a path (STR-22)."""
    names = ("destination_folder", "data_type", "priority")
    return [first_rule(path, [(r[0], r[i + 1]) for r in PATH_RULES], NO_PATH_RULE[i]).alias(name) for i, name in enumerate(names)]


def term_domain(term: Column, genomic: Sequence[str] = GENOMIC_WORDS, nano: Sequence[str] = NANO_WORDS) -> Column:
    """Genomic, Nanomedicine, both, or Other, by substrings of the term (FLT-15)."""
    low = F.lower(term)
    g, n = any_contains(low, genomic), any_contains(low, nano)
    return F.when(g & n, "Genomic & Nanomedicine").when(g, "Genomic").when(n, "Nanomedicine").otherwise("Other")


def header_tags(text: Column) -> Column:
    """What a header is about, as a list of tags (STR-25)."""
    low = F.lower(text)
    return F.array_compact(F.array(F.when(any_contains(low, BREAST_TAGS), "breast"), F.when(any_contains(low, NANO_TAGS), "nano")))


def layout_status(path: Column, allowed: Mapping[str, Mapping[str, Sequence[str]]], noisy: Sequence[str]) -> Column:
    """How a path scope/bucket/.../file.ext fits the layout (STR-24).

    NOISY: a part of the file's name marks it as a portal's or temporary; OUT_OF_TREE: not under a scope; MISPLACED: no
    bucket of the scope; EXT_MISMATCH: an extension that the bucket doesn't take; else OK.
    """
    parts = F.split(path, "/")
    scope, bucket, name = parts[0], F.when(F.size(parts) > 2, F.get(parts, F.lit(1))), F.element_at(parts, -1)
    ext = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    status = F.when(any_contains(F.lower(name), noisy), "NOISY").when(~scope.isin(list(allowed)), "OUT_OF_TREE")
    fits = F.lit(False)
    for s, buckets in allowed.items():
        for b, exts in buckets.items():
            here = (scope == s) & (bucket == b)
            fits = fits | here
            status = status.when(here & (ext != "") & ~ext.isin(list(exts)), "EXT_MISMATCH")
    return status.when(~F.coalesce(fits, F.lit(False)), "MISPLACED").otherwise("OK")


def modality(path: Column, header: Column, by_extension: Mapping[str, str], markers: Sequence[tuple[str, str]], header_words: Mapping[str, Sequence[str]], least: int = 2) -> Column:
    """A file's modality: by its extension, else by a mark in its name, else by at least ``least`` words of its header (STR-23)."""
    ext = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    out = F.when(F.lit(False), F.lit(""))
    for e, kind in by_extension.items():
        out = out.when(ext == e, kind)
    low = F.lower(path)
    for mark, kind in markers:
        out = out.when(F.contains(low, F.lit(mark)), kind)
    words = F.split(F.lower(header), r"[^a-z0-9_]+")
    for kind, wanted in header_words.items():
        out = out.when(F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in wanted]))) >= least, kind)
    return out.otherwise("unknown")


def table_kind(n_columns: Column, n_rows: Column, has_id: Column, is_case_list: Column) -> Column:
    """What a file is: empty, caselist, wide_matrix (1000 columns or more), metadata (with an id column), or table (STR-26)."""
    return F.when((n_rows == 0) | (n_columns == 0), "empty").when(is_case_list, "caselist").when(n_columns >= 1000, "wide_matrix").when(has_id, "metadata").otherwise("table")
