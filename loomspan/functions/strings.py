"""Scalar text, hash and number functions as column expressions (STR-01 to STR-13, FN-01 to FN-07)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Greek letters and their names.
GREEK = {
    "α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "ε": "epsilon", "κ": "kappa", "λ": "lambda", "μ": "mu", "ν": "nu", "π": "pi", "ρ": "rho",
    "σ": "sigma", "τ": "tau", "φ": "phi", "χ": "chi", "ψ": "psi", "ω": "omega",
}
# Words that are no vocabulary terms.
STOP_TERMS = ["the", "and", "of", "to", "in", "for", "with", "by", "on", "as", "at", "or", "an", "patient", "sample", "case", "unknown", "na", "n/a"]
# Cells that stand for nothing.
JUNK_TOKENS = ["", "na", "n/a", "null", "none", "unknown"]


def tidy(c: Column) -> Column:
    """Trimmed, with each run of white space as one blank (STR-01)."""
    return F.trim(F.regexp_replace(c, r"[ \t\n\r\f\x0B]+", " "))


def casefold(c: Column) -> Column:
    """A key without case: ß and ss are alike, and so are the two small sigmas (STR-02)."""
    return F.replace(F.replace(F.lower(c), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


@F.pandas_udf(T.StringType())
def nfkc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Unicode compatibility composition (STR-03): the one text function that the engine lacks."""
    import unicodedata

    for texts in batches:
        yield texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def greek_names(c: Column) -> Column:
    """Greek letters spelled out (STR-04)."""
    return reduce(lambda text, letter: F.replace(text, F.lit(letter), F.lit(GREEK[letter])), GREEK, c)


def surface_forms(c: Column) -> Column:
    """The spellings under which a term is looked for: hyphens and blanks exchanged, Greek letters spelled out (STR-05)."""
    folded = greek_names(c)
    forms = F.array(c, F.replace(c, F.lit("-"), F.lit(" ")), F.replace(c, F.lit(" "), F.lit("-")), folded, F.replace(folded, F.lit("-"), F.lit(" ")))
    return F.array_sort(F.array_distinct(F.filter(forms, lambda x: F.length(x) >= 3)))


def alias_list(c: Column) -> Column:
    """A cell with several aliases as a list of them, quotes and outer white space off; itself if nothing remains (STR-06)."""
    whole = F.trim(c)
    parts = F.filter(F.transform(F.split(whole, r"[|;,/]"), lambda p: tidy(F.regexp_replace(F.trim(p), "^[\"']+|[\"']+$", ""))), lambda p: p != "")
    return F.when(whole == "", F.array().cast("array<string>")).when(F.size(parts) > 0, parts).otherwise(F.array(whole))


def safe_name(c: Column, fill: str = "_") -> Column:
    """A name for files and columns: anything but letters, digits and the underscore replaced (STR-07)."""
    return F.regexp_replace(c, r"[^A-Za-z0-9_]+", fill)


def token_set(c: Column) -> Column:
    """The distinct words of a text in lower case, in order of appearance (STR-08)."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(c), r"[^a-z0-9_]+", " "), " "), lambda w: w != ""))


def window_around(c: Column, start: Column, end: Column, width: int) -> Column:
    """What stands up to width characters around a span (STR-09); positions count from 0."""
    left = F.greatest(start - width, F.lit(0))
    return F.substring(c, left + 1, end + width - left)


def joined(c: Column, by: str = "|") -> Column:
    """A list as one cell (STR-10)."""
    return F.array_join(c, by)


def any_contains(c: Column, words: Sequence[str]) -> Column:
    """Whether a text holds any of the words as a substring; false for null (STR-11)."""
    return F.coalesce(reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in words], F.lit(False)), F.lit(False))


def is_upper(c: Column) -> Column:
    """Whether a text has letters and all of them are capitals (STR-13)."""
    return (c == F.upper(c)) & (F.upper(c) != F.lower(c))


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """c within limits (FN-01)."""
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def short_hash(c: Column, kind: str = "sha256", length: int = 8) -> Column:
    """The first hexadecimal digits of a digest: sha256[:8] for links, md5[:12] for files, sha1[:12] for persons (ID-13, FN-02)."""
    digest = {"sha256": F.sha2(c, 256), "md5": F.md5(c), "sha1": F.sha1(c)}[kind]
    return F.substring(digest, 1, length)


def head_digest(content: Column, size: int = 4 << 20) -> Column:
    """sha1 of a file's first size bytes (FN-02)."""
    return F.sha1(F.substring(content, 1, size))


def age_in_days(at: Column, now: Column) -> Column:
    """Whole days from at to now (FN-03)."""
    return F.datediff(now, at)


def stamp(at: Column) -> Column:
    """A point in time as text, to the second (FN-03)."""
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss")


def as_json(c: Column) -> Column:
    """A map or struct as JSON (FN-04)."""
    return F.to_json(c)


def json_field(c: Column, path: str) -> Column:
    """One field of a JSON text, null where it is missing or the text is no JSON (FN-04)."""
    return F.get_json_object(c, path)


def url_quote(c: Column) -> Column:
    """A text as a query parameter, blanks as plus signs (FN-07)."""
    return F.url_encode(c)


def human_size(size: Column) -> Column:
    """Bytes with the unit that suits them (STR-27)."""
    units = ["B", "KB", "MB", "GB", "TB"]
    out = None
    for i, unit in enumerate(units):
        text = F.concat(F.round(size / (1024.0**i), 1).cast("string"), F.lit(f" {unit}"))
        below = size < 1024.0 ** (i + 1)
        out = F.when(below, text) if out is None else out.when(below, text)
    return out.otherwise(F.concat(F.round(size / (1024.0**4), 1).cast("string"), F.lit(" TB")))
