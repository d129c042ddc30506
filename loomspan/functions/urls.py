"""URLs, DOIs and accessions: harvest, repair, parts, trust and relevance (STR-14 to STR-21)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of an address and their weight for this domain.
RELEVANCE = {
    ".csv": 5, ".tsv": 5, ".json": 5, ".parquet": 8, ".gz": 3, ".zip": 3, "ncbi": 10, "geo": 10, "tcga": 10, "metabric": 10, "zenodo": 8, "figshare": 8, "brca": 8,
    "breast-cancer": 8, "cancer": 3, "tumor": 3, "nanoparticle": 10, "nanomedicine": 10, "drug-delivery": 5, "gene": 5, "expression": 5, "dataset": 8, "download": 5,
    "size_nm": 30, "zeta_potential": 30, "surface_chemistry": 25, "core_material": 25, "drug_load": 20, "payload": 20, "encapsulation": 20, "particle": 15,
    "google.com": -10, "github.com": -5, "doi.org": -5, "about": -8, "contact": -8, "privacy": -15, "terms": -15, "policy": -15, "login": -10, "search": -8, "help": -8,
    "documentation": -8, "html": -3,
}
#: Addresses of at least this relevance are kept (FLT-16).
KEEP_RELEVANCE = 15
# Trust in hosts and those below them, from 0 (ignored) to 5.
TRUST = {
    5: ["ncbi.nlm.nih.gov", "pubchem.ncbi.nlm.nih.gov", "ebi.ac.uk", "pride.ebi.ac.uk", "proteomexchange.org", "biostudies.ebi.ac.uk", "metabolomicsworkbench.org", "reactome.org", "wikipathways.org",
        "clinicaltrials.gov", "cancer.gov", "cananolab.cancer.gov", "europepmc.org", "api.unpaywall.org", "openalex.org", "api.datacite.org", "doi.org"],
    4: ["zenodo.org", "figshare.com", "datadryad.org", "osf.io", "massive.ucsd.edu", "jpostdb.org", "uniprot.org", "kegg.jp", "nist.gov", "epa.gov", "comptox.epa.gov", "ngdc.cncb.ac.cn",
        "data.enanomapper.net", "infrastructure.nanocommons.eu"],
    3: ["nanocommons.github.io", "github.com", "raw.githubusercontent.com", "gitlab.com", "arxiv.org", "biorxiv.org", "medrxiv.org", "nature.com", "sciencemag.org", "pnas.org", "cell.com",
        "pubs.acs.org", "rsc.org", "link.springer.com", "onlinelibrary.wiley.com", "sciencedirect.com", "nanohub.org"],
    1: ["researchgate.net", "academia.edu", "medium.com", "quora.com", "reddit.com", "ncihub.org", "nbi.oregonstate.edu", "nanominer.cs.tut.fi"],
    0: ["pinterest.com", "facebook.com", "twitter.com", "t.co", "bit.ly", "goo.gl", "tinyurl.com"],
}
#: Trust in hosts of which nothing is known.
UNKNOWN_TRUST = 1
# A part of an address and the repository it belongs to; the first that fits counts.
REPOSITORIES = [
    ("ncbi.nlm.nih.gov/geo", "NCBI GEO"), ("ncbi.nlm.nih.gov/sra", "NCBI SRA"), ("sra-download", "NCBI SRA"), ("gdc.cancer.gov", "NCI GDC"), ("ebi.ac.uk", "EBI"), ("arrayexpress", "EBI"),
    ("proteomexchange", "ProteomeXchange/PRIDE"), ("zenodo", "Zenodo"), ("figshare", "Figshare"), ("osf.io", "OSF"),
]


def urls_in(text: Column) -> Column:
    """All addresses of a text, without the signs that end a sentence (STR-14, STR-15)."""
    found = F.regexp_extract_all(text, F.lit(r"((?:https?|ftp)://[^ \t\n\r<>\"')]+)"), F.lit(1))
    return F.transform(found, lambda u: F.regexp_replace(u, r"[.,;:)\]]+$", ""))


def dois_in(text: Column) -> Column:
    """All DOIs of a text, without the signs that end a sentence (STR-18)."""
    found = F.regexp_extract_all(text, F.lit(r"(10\.[0-9]{4,9}/[A-Za-z0-9._;()/:-]+)"), F.lit(1))
    return F.transform(found, lambda u: F.regexp_replace(u, r"[).,;\]]+$", ""))


def repaired(url: Column) -> Column:
    """An address with its scheme's signs put right, blanks taken out, and a bare DOI resolved (STR-15)."""
    tight = F.regexp_replace(url, r"[ \t\n\r]+", "")
    schemed = F.regexp_replace(F.regexp_replace(tight, "^(https?)(?=www[.])", "$1://"), "^(https?)(?!s?:)(?=[A-Za-z0-9-]+[.])", "$1://")
    ended = F.regexp_replace(schemed, r"[).,;\]]+$", "")
    return F.when(ended.rlike(r"^10\.[0-9]{4,9}/"), F.concat(F.lit("https://doi.org/"), ended)).otherwise(ended)


def host(url: Column) -> Column:
    """The host of an address in lower case, without user and port; null without one (STR-16)."""
    h = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(h != "", h)


def leaf(url: Column) -> Column:
    """The last part of an address's path, without query and fragment (STR-16)."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    return F.substring_index(path, "/", -1)


def extension(url: Column) -> Column:
    """The extension of the last part, in lower case, without the point; empty without one (STR-16)."""
    return F.lower(F.regexp_extract(leaf(url), r"\.([A-Za-z0-9]+)$", 1))


def relevance(url: Column, weights: Mapping[str, int] = RELEVANCE) -> Column:
    """The sum of the weights of all words that an address holds (STR-20)."""
    low = F.lower(url)
    return reduce(lambda a, b: a + b, [F.when(F.contains(low, F.lit(w)), F.lit(n)).otherwise(F.lit(0)) for w, n in weights.items()], F.lit(0))


def trust(url: Column) -> Column:
    """Trust in an address: that of the longest known name among its host and those above it (STR-19)."""
    h = host(url)
    known = F.create_map(*[F.lit(x) for level, names in TRUST.items() for name in names for x in (name, level)])
    parts = F.split(h, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))
    levels = F.filter(F.transform(suffixes, lambda s: F.try_element_at(known, s)), lambda x: x.isNotNull())
    return F.coalesce(F.try_element_at(levels, F.lit(1)), F.lit(UNKNOWN_TRUST))


def repository(url: Column) -> Column:
    """The repository an address belongs to (STR-21)."""
    low = F.lower(url)
    out = F.when(low.isNull(), F.lit(None).cast("string"))
    for part, name in REPOSITORIES:
        out = out.when(F.contains(low, F.lit(part)), name)
    return out.when(low.startswith("ftp://"), "FTP (generic)").when(low.rlike(r"^https://(github\.com|raw\.githubusercontent\.com)"), "GitHub").otherwise("Web (generic)")


def access(url: Column) -> Column:
    """How an address is fetched, by its scheme (STR-21)."""
    scheme = F.upper(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    return F.when(scheme.isin("HTTP", "HTTPS"), "HTTP").when(scheme == "", "UNKNOWN").otherwise(scheme)


def series_folder(accession: Column) -> Column:
    """The folder in which a series' files lie on the public server: its number's last three digits as nnn (STR-17)."""
    stem = F.concat(F.substring(accession, F.lit(1), F.greatest(F.length(accession) - 3, F.lit(3))), F.lit("nnn"))
    return F.concat(F.lit("ftp://ftp.ncbi.nlm.nih.gov/geo/series/"), stem, F.lit("/"), accession, F.lit("/"))


def url_manifest(lines: DataFrame, text: str, source: str, line: str) -> DataFrame:
    """One row per distinct address with its parts, a stable id and where it was first seen (STR-14 to STR-16, ID-13, SET-04)."""
    rows = lines.select(F.col(source).alias("source_file"), F.col(line).alias("source_line"), F.explode(urls_in(F.col(text))).alias("url"))
    first = rows.groupBy("url").agg(F.min(F.struct("source_file", "source_line")).alias("at"), F.count("*").alias("n"))
    return first.select("url", host(F.col("url")).alias("domain"), leaf(F.col("url")).alias("leaf"), extension(F.col("url")).alias("ext_hint"), "at.source_file", "at.source_line", F.substring(F.sha2("url", 256), 1, 8).alias("uid"), "n")
