"""Text mining: cleaning, sections, sentences, vocabulary mentions, relations (TXT-01 to TXT-23, FLT-06)."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.functions.strings import any_contains, clamp
from loomspan.operators.shape import q
from loomspan.session import cut
from loomspan.skew import salted_join

#: A vocabulary of more terms than this isn't broadcast; its tokens are joined instead.
BROADCAST_TERMS = 500_000

# Headings of sections.
SECTIONS = ["ABSTRACT", "BACKGROUND", "INTRODUCTION", "METHODS?", "MATERIALS AND METHODS", "RESULTS", "DISCUSSION", "CONCLUSIONS?", "ACKNOWLEDGE?MENTS?", "REFERENCES"]
# How much a statement counts by its section.
SECTION_WEIGHTS = {
    "ABSTRACT": 1.0, "RESULTS": 1.0, "INTRODUCTION": 0.8, "DISCUSSION": 0.8, "METHODS": 0.5, "METHOD": 0.5, "CONCLUSION": 0.9, "CONCLUSIONS": 0.9, "BACKGROUND": 0.7, "REFERENCES": 0.1,
    "ACKNOWLEDGEMENTS": 0.1, "UNKNOWN": 0.7, "PREFACE": 0.7,
}
# Predicates of relations and the words that state them; the first that fits counts.
PREDICATES = [
    ("inhibits", "inhibit(?:s|ed|ion)?|block(?:s|ed|ade)?"), ("activates", "activate(?:s|d|ion)?"), ("binds", "bind(?:s|ing)?"), ("phosphorylates", "phosphorylat(?:es|ed|ion)"),
    ("induces", "induce(?:s|d|ment)?"), ("suppresses", "suppress(?:es|ed|ion)?"), ("sensitizes", "sensiti[sz]e(?:s|d|ation)?"), ("synergizes", "synerg(?:y|istic|izes?)"),
    ("antagonizes", "antagonis(?:m|t|es?)"), ("targets", "target(?:s|ed|ing)?"), ("associated_with", "associat(?:ed|ion) +with"), ("mutation", "mutant|mutation|mutations|mutated"),
    ("overexpression", "over[- ]?express(?:ion|ed)"), ("knockdown", "knock[- ]?down|silenc(?:e|ing)|shrna"), ("pathway_activation", "(?:pathway|cascade).{0,12}activat(?:e|ion|ed)"),
]
# The shorter list of predicates, for texts whose sentences have sections.
PREDICATES_SHORT = [
    ("inhibits", "inhibit(?:s|ed|ion)?|block(?:s|ed|ade)?"), ("activates", "activate(?:s|d|ion)?"), ("targets", "target(?:s|ed|ing)?"), ("binds", "bind(?:s|ing)?"), ("resistant_to", "resistan(?:t|ce) +to"),
    ("sensitizes", "sensiti[sz]e(?:s|d|ation)?"), ("associated_with", "associat(?:ed|ion) +with"),
]
# Words that deny a statement.
NEGATIONS = "no|not|lack(?:ing)?|fails? +to|did +not|without"
# Confidence in a relation by its predicate.
STRONG = ["inhibits", "activates", "binds", "phosphorylates", "targets", "synergizes", "antagonizes"]
MEDIUM = ["suppresses", "induces", "sensitizes", "pathway_activation"]
WEAK = ["associated_with", "mutation", "overexpression", "knockdown"]
# Quantities in sentences and how they are written.
QUANTITIES = {
    "IC50": r"\bIC50 *(?:=|:|of)? *([0-9]+(?:\.[0-9]+)?(?: *(?:pM|nM|uM|mM))?)\b", "EC50": r"\bEC50 *(?:=|:|of)? *([0-9]+(?:\.[0-9]+)?(?: *(?:pM|nM|uM|mM))?)\b",
    "GI50": r"\bGI50 *(?:=|:|of)? *([0-9]+(?:\.[0-9]+)?(?: *(?:pM|nM|uM|mM))?)\b", "Kd": r"\bK[di] *(?:=|:)? *([0-9]+(?:\.[0-9]+)?(?: *(?:pM|nM|uM|mM))?)\b", "Ki": r"\bKi *(?:=|:)? *([0-9]+(?:\.[0-9]+)?(?: *(?:pM|nM|uM|mM))?)\b",
    "HR": r"\bHR *(?:=|:)? *([0-9]+(?:\.[0-9]+)?)\b", "OR": r"\bOR *(?:=|:)? *([0-9]+(?:\.[0-9]+)?)\b", "CI95": r"\b95%? *CI *(?:=|:)? *\(? *([0-9]+(?:\.[0-9]+)?[,–-] *[0-9]+(?:\.[0-9]+)?)",
    "p": r"\bp *(?:=|<|≤) *([0-9]+(?:\.[0-9]+)?(?:e-?[0-9]+)?)\b", "dose": r"\b([0-9]+(?:\.[0-9]+)? *(?:mg/kg|mg/m2|ug/mL|mg|uM|nM))\b",
}
# Parts of term types and the role they stand for; the first that fits counts.
ROLES = [
    ("drug", "drug"), ("compound", "drug"), ("inhibitor", "drug"), ("antibody", "drug"), ("therapy", "drug"), ("treatment", "drug"), ("gene", "gene"), ("symbol", "gene"), ("protein", "gene"), ("target", "gene"),
    ("biomarker", "gene"), ("pathway", "pathway"), ("reactome", "pathway"), ("go", "pathway"), ("kegg", "pathway"), ("cascade", "pathway"), ("disease", "disease"), ("cancer", "disease"), ("phenotype", "disease"),
]
# Words that are no unknown terms.
STOPWORDS = """the and for that with this from were have has had but are was be by not into than then over under onto also such can could should would may might our their there where which while within between
each per via using used based""".split()
# Parts of terms, in lower case, that tell their kind.
PATHWAY_WORDS = [" pathway", " signaling", "signalling"]
DISEASE_WORDS = [" carcinoma", " cancer", " tumor", " tumour", " neoplasm", " syndrome"]
DRUG_WORDS = [" inhibitor", " antibody", " drug", " therapeutic", " therapy"]

#: A word that could be a term: five signs or more, as names of genes and compounds have them.
TOKEN = r"[A-Za-z][A-Za-z0-9+/_.-]{4,}"


def cleaned(c: Column) -> Column:
    """Words split at line ends joined, carriage returns out, blanks and empty lines single (TXT-05)."""
    whole = F.regexp_replace(c, r"([A-Za-z0-9_])-\n([A-Za-z0-9_])", "$1$2")
    return F.regexp_replace(F.regexp_replace(F.replace(whole, F.lit("\r"), F.lit("")), r"[ \t]+", " "), r"\n\n+", "\n\n")


def lines_of(df: DataFrame, text: str) -> DataFrame:
    """One row per line, numbered from 0 within its text."""
    return df.select("*", F.posexplode(F.split(F.col(q(text)), "\n")).alias("line_no", "line"))


def sections_of(df: DataFrame, key: str, text: str, headings: Sequence[str] = SECTIONS) -> DataFrame:
    """(key, section_no, section, body): a text cut at lines that are headings (TXT-06).

    What precedes the first heading is PREFACE; a text without headings is UNKNOWN as a whole. The text is cut where it
    lies, without a shuffle: headings are marked, then the marked text is split.
    """
    mark = "\x01"
    strip = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    marked = F.regexp_replace(F.concat(F.lit("\n"), F.col(q(text))), rf"(?i)\n[ \t]*({'|'.join(headings)})[ \t]*(?=\n|$)", f"{mark}$1{mark}")
    parts = F.split(marked, mark)
    none = F.array(F.struct(F.lit("UNKNOWN").alias("section"), F.col(q(text)).alias("body")))
    some = F.transform(F.sequence(F.lit(1), F.greatest(F.floor((F.size(parts) - 1) / 2), F.lit(1))), lambda i: F.struct(F.upper(F.get(parts, i.cast("int") * 2 - 1)).alias("section"), strip(F.get(parts, i.cast("int") * 2)).alias("body")))
    preface = F.filter(F.array(F.struct(F.lit("PREFACE").alias("section"), strip(parts[0]).alias("body"))), lambda x: x["body"] != "")
    cut = F.when(F.size(parts) < 3, none).otherwise(F.concat(preface, some))
    return df.filter(F.col(q(text)).isNotNull()).select(F.col(q(key)), F.posexplode(cut)).select(key, F.col("pos").alias("section_no"), "col.section", "col.body")


def sentences(c: Column, guard: bool = False, least: int = 0, abbreviations: bool = False) -> Column:
    """A text's sentences (TXT-04): cut after . ! ? before white space, and at line ends; shorter ones than ``least`` go.

    guard: cut only before capitals, and not after initials and two-letter titles; abbreviations: nor after et al., Fig. and
    Ref.
    """
    more = r"(?<!\bet al\.)(?<!\bFig\.)(?<!\bRef\.)" if abbreviations else ""
    pattern = r"(?<!\b[A-Z]\.)(?<!\b[A-Z][a-z]\.)" + more + r"(?<=[.!?])\s+(?=[A-Z])" if guard else r"(?<=[.!?])\s+|\n+"
    return F.filter(F.transform(F.split(c, pattern), lambda s: F.trim(s)), lambda s: F.length(s) >= max(1, least))


def sentence_rows(df: DataFrame, key: str, text: str, guard: bool = False, least: int = 0) -> DataFrame:
    """(key, sentence_id, sentence) (WIN-07)."""
    return df.select(F.col(q(key)), F.posexplode(sentences(F.col(q(text)), guard, least)).alias("sentence_id", "sentence"))


def tokens(df: DataFrame, key: str, text: str, pattern: str = TOKEN) -> DataFrame:
    """(key, token): every word of a text that the pattern finds, in lower case."""
    return df.select(F.col(q(key)), F.explode(F.regexp_extract_all(F.col(q(text)), F.lit(f"({pattern})"), F.lit(1))).alias("token")).withColumn("token", F.lower("token"))


def unknown_tokens(df: DataFrame, key: str, text: str, known: DataFrame, term: str, least: int = 1) -> DataFrame:
    """(term, n): words that are neither known nor common, counted over texts that have them at least so often (TXT-10, AGG-16)."""
    counts = tokens(df, key, text).filter(~F.col("token").isin(STOPWORDS)).groupBy(F.col("token").alias("term"), key).agg(F.count("*").alias("n"))
    vocabulary = known.select(F.lower(F.col(q(term))).alias("_t")).filter("_t is not null").distinct()
    return counts.filter(F.col("n") >= least).groupBy("term").agg(F.sum("n").alias("n")).join(vocabulary, F.col("term") == F.col("_t"), "left_anti")


_automata: dict[str, object] = {}


def _automaton(name: str, entries: Sequence[tuple], ignore_case: bool):
    """The automaton of a vocabulary, made once a worker; only the last one is kept."""
    import ahocorasick

    if name not in _automata:
        made = ahocorasick.Automaton()
        for term, canonical, kind in entries:
            made.add_word(term.lower() if ignore_case else term, (len(term), canonical, kind))
        if entries:
            made.make_automaton()
        _automata.clear()
        _automata[name] = made
    return _automata[name]


def _mention_batches(shared, name: str, ignore_case: bool, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from loomspan.operators import text as own  # the worker's own module, which outlives the task

        automaton = own._automaton(name, shared.value, ignore_case)
        word = lambda c: c.isalnum() or c == "_"
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text or not shared.value:
                    continue
                low = (text.lower() if text.isascii() else "".join(x if len(x) == 1 else c for c, x in ((c, c.lower()) for c in text))) if ignore_case else text
                spans = []
                for end, (length, canonical, kind) in automaton.iter(low):
                    start = end + 1 - length
                    if (start == 0 or not word(text[start - 1])) and (end + 1 == len(text) or not word(text[end + 1])):
                        spans.append((start, -(end + 1), canonical, kind))
                last = 0
                for start, end, canonical, kind in sorted(spans):
                    if start >= last:
                        last = -end
                        rows.append((key, start, last, text[start:last], canonical, kind, text[max(0, start - width) : last + width]))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            yield pa.record_batch([pa.array(columns[0], batch.column(0).type), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()), *[pa.array(c, pa.string()) for c in columns[3:]]], names=["key", "char_start", "char_end", "surface", "normalized", "entity", "snippet"])

    return run


def mentions_in_context(df: DataFrame, key: str, text: str, vocabulary: DataFrame, term: str, canonical: str, kind: str, ignore_case: bool = True, width: int = 60) -> DataFrame:
    """(key, char_start, char_end, surface, normalized, entity, snippet): terms that stand in a text as words, with up to width
    characters on either side (TXT-01 to TXT-03, TXT-07, TXT-09, TXT-11).

    Matches don't overlap: of those that begin first the longest, then on from its end, as an alternation of the terms from
    the longest on would match (SRT-05). A term of several canonical forms has the least. One automaton, made once a worker,
    holds all terms, so that a text is read once whatever their number; the vocabulary is broadcast and refused beyond
    BROADCAST_TERMS (use token_hits there). Null and empty texts have none.
    """
    rows = vocabulary.filter(F.length(F.trim(F.col(q(term)))) > 0).groupBy((F.lower(F.trim(F.col(q(term)))) if ignore_case else F.trim(F.col(q(term)))).alias("t"))
    entries = rows.agg(F.min(F.struct(F.coalesce(F.col(q(canonical)), F.col(q(term))).alias("c"), F.col(q(kind)).alias("k"))).alias("x")).select("t", "x.c", "x.k").limit(BROADCAST_TERMS + 1).collect()
    if len(entries) > BROADCAST_TERMS:
        raise ValueError(f"more than {BROADCAST_TERMS} terms; join tokens instead")
    shared = df.sparkSession.sparkContext.broadcast([tuple(r) for r in entries])
    schema = f"key {df.schema[key].dataType.simpleString()}, char_start int, char_end int, surface string, normalized string, entity string, snippet string"
    found = df.select(F.col(q(key)).alias("key"), F.col(q(text)).alias("text")).mapInArrow(_mention_batches(shared, uuid.uuid4().hex, ignore_case, width), schema)
    return found.withColumnRenamed("key", key)


def mentions(df: DataFrame, key: str, text: str, vocabulary: DataFrame, term: str, canonical: str, kind: str, ignore_case: bool = True) -> DataFrame:
    """(key, char_start, char_end, surface, normalized, entity): as mentions_in_context, without the context."""
    return mentions_in_context(df, key, text, vocabulary, term, canonical, kind, ignore_case, 0).drop("snippet")


def annotated(df: DataFrame, key: str, columns: Sequence[str], vocabulary: DataFrame, term: str, canonical: str, kind: str) -> DataFrame:
    """The rows with what their texts mention: mentions and normalized_terms, as sorted lists (TXT-07, ABS-02); empty lists without any."""
    text = F.concat_ws(" ", *[F.col(q(c)) for c in columns])
    found = mentions(df.select(F.col(q(key)), text.alias("_text")), key, "_text", vocabulary, term, canonical, kind)
    lists = found.groupBy(key).agg(F.array_sort(F.collect_set("surface")).alias("mentions"), F.array_sort(F.collect_set("normalized")).alias("normalized_terms"))
    none = F.array().cast("array<string>")
    return df.join(lists, key, "left").withColumns({c: F.coalesce(c, none) for c in ("mentions", "normalized_terms")})


class Backend(Protocol):
    """A finder of entities: (start, end, text, kind, score) for a sentence."""

    def __call__(self, sentence: str) -> list[tuple[int, int, str, str, float]]: ...


def pattern_backend(patterns: Mapping[str, str], score: float) -> Backend:
    """Entities by regular expressions, one a kind."""

    def find(sentence: str) -> list[tuple[int, int, str, str, float]]:
        return [(m.start(), m.end(), m.group(), kind, score) for kind, p in patterns.items() for m in re.finditer(p, sentence)]

    return find


def entities(df: DataFrame, keys: Sequence[str], sentence: str, backends: Sequence[Backend]) -> DataFrame:
    """(keys, start, end, text, kind, score): what several finders find, without overlaps (TXT-11, TXT-03).

    Of overlapping entities the first counts, of those the longest, of those the surest. Finders run on batches of rows.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema}

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for *key, text in batch[[*keys, sentence]].itertuples(index=False):
                spans, last = sorted((s, -e, -score, t, kind) for b in backends for s, e, t, kind, score in (b(text) if text else [])), 0
                for s, e, score, t, kind in spans:
                    if s >= last:
                        last = -e
                        rows.append((*key, s, -e, t, kind, -score))
            yield pd.DataFrame(rows, columns=[*keys, "start", "end", "text", "kind", "score"])

    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", start int, end int, text string, kind string, score double"
    return df.select(*[F.col(q(k)) for k in keys], F.col(q(sentence))).mapInPandas(find, schema)


def token_hits(df: DataFrame, key: str, text: str, vocabulary: DataFrame, term: str, show: int | None = None, most: int | None = None) -> DataFrame:
    """(key, hit_count, hits): distinct one-word terms of any vocabulary in each text, by a join of words (TXT-08, ABS-01).

    hit_count is cut at ``most`` and the list at ``show``, if given. A word that many texts have is a hot key of the join:
    its texts are spread (the vocabulary has it once).
    """
    words = df.select(F.col(q(key)), F.explode(F.array_distinct(F.split(F.regexp_replace(F.lower(F.col(q(text))), r"[^a-z0-9_]+", " "), " "))).alias("w")).filter("w <> ''")
    known = vocabulary.select(F.lower(F.col(q(term))).alias("w")).filter("w is not null").distinct()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    often = cut(words.groupBy("w").agg(F.count("*").alias("n")).join(known, "w"))
    hits = salted_join(words, often, "w", F.col(q(key)), "n", often.agg(F.sum("n")).first()[0] or 0, salts=parts)
    hits = hits.groupBy(key).agg(F.count("*").alias("n"), F.array_sort(F.collect_set("w")).alias("hits"))
    return hits.select(key, (F.least("n", F.lit(most)) if most else F.col("n")).alias("hit_count"), (F.slice("hits", 1, show) if show else F.col("hits")).alias("hits"))


def _word(pattern: str) -> str:
    return rf"(?i)(^|[^a-zA-Z0-9_])({pattern})($|[^a-zA-Z0-9_])"


def _stems(pattern: str) -> list[str]:
    """The letters that the pattern's alternatives begin with; none if one of them begins otherwise."""
    if re.search(r"\([^?]", pattern) or pattern.startswith("(") or re.search(r"\|[^|]*\(\?:[^)]*$", pattern):
        return []
    heads = [re.match(r"[a-z]*", part).group() for part in re.split(r"\|(?![^(]*\))", pattern)]
    return heads if all(len(h) >= 3 for h in heads) else []


def predicate(c: Column, rules: Sequence[tuple[str, str]] = PREDICATES) -> Column:
    """The relation that a sentence states: the first whose words it has, else empty (TXT-12).

    A pattern is tried only on sentences that hold the letters its words begin with.
    """
    out, low = None, F.lower(c)
    for name, pattern in rules:
        test, stems = c.rlike(_word(pattern)), _stems(pattern)
        if stems:
            test = any_contains(low, stems) & test
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("")


def negated(c: Column) -> Column:
    """Whether a sentence has a word that denies (TXT-13)."""
    return F.coalesce(c.rlike(_word(NEGATIONS)), F.lit(False))


def quantities(c: Column, patterns: Mapping[str, str] = QUANTITIES) -> Column:
    """A map of the quantities that a sentence states (TXT-14); µ counts as u."""
    plain = F.replace(F.replace(c, F.lit("µ"), F.lit("u")), F.lit("μ"), F.lit("u"))
    found = F.create_map(*[x for name, p in patterns.items() for x in (F.lit(name), F.nullif(F.regexp_extract(plain, f"(?i){p}", 1), F.lit("")))])
    return F.map_filter(found, lambda k, v: v.isNotNull())


def role(term: Column, kind: Column) -> Column:
    """A term's role by its type; a term with / or - is a gene, else it is unknown (TXT-15)."""
    low, out = F.lower(kind), None
    for part, name in ROLES:
        out = F.when(F.contains(low, F.lit(part)), name) if out is None else out.when(F.contains(low, F.lit(part)), name)
    return out.when(term.rlike("[/-]"), "gene").otherwise("unknown")


def confidence(stated: Column, found: Column, n_entities: Column) -> Column:
    """Confidence in a relation: by its predicate, more with a measured quantity and with three entities (TXT-16)."""
    base = F.when(stated.isin(STRONG), 0.9).when(stated.isin(MEDIUM), 0.7).when(stated.isin(WEAK), 0.6).otherwise(0.4)
    measured = F.arrays_overlap(F.map_keys(found), F.array(*[F.lit(k) for k in ("IC50", "EC50", "GI50", "Ki", "Kd", "HR", "OR", "p")]))
    return clamp(base + F.when(measured, 0.05).otherwise(0.0) + F.when(n_entities >= 3, 0.05).otherwise(0.0))


def section_confidence(base: Column, section: Column, denied: Column) -> Column:
    """Confidence weighed by section, less if denied (TXT-17)."""
    weight = None
    for name, w in SECTION_WEIGHTS.items():
        weight = F.when(section == name, w) if weight is None else weight.when(section == name, w)
    return clamp(base * weight.otherwise(0.7) - F.when(denied, 0.3).otherwise(0.0))


def code_label_pairs(df: DataFrame, key: str, text: str, least: int = 5, share: float = 0.05) -> DataFrame:
    """(key, code, label): lines of the form code: label, of texts that have enough of them (TXT-18)."""
    rows = lines_of(df.select(q(key), q(text)), text).filter(F.length(F.trim("line")) > 0)
    pattern = r"^[ \t]*([A-Za-z][A-Za-z0-9._/-]{1,24})[ \t]*(?:=|:|--?|–|—)[ \t]+([^ \t].{1,199})$"
    rows = rows.select(key, F.regexp_extract("line", pattern, 1).alias("code"), F.trim(F.regexp_extract("line", pattern, 2)).alias("label"))
    pairs = rows.withColumn("ok", (F.length("code") >= 2) & (F.length("label") >= 2))
    enough = pairs.groupBy(key).agg(F.sum(F.col("ok").cast("int")).alias("n"), F.count("*").alias("lines")).filter(F.col("n") >= F.greatest(F.lit(least), F.floor(F.col("lines") * share)))
    return pairs.filter("ok").join(enough.select(key), key, "left_semi").select(key, "code", "label")


def records_about(df: DataFrame, columns: Sequence[str], pattern: str, terms: DataFrame | None = None, key: str | None = None, term: str | None = None) -> DataFrame:
    """Records whose texts match, or whose key is among the terms (TXT-21, FLT-06)."""
    text = F.concat_ws(" ", *[F.col(q(c)) for c in columns])
    if terms is None or key is None or term is None:
        return df.filter(text.rlike(pattern))
    wanted = terms.select(F.lower(F.col(q(term))).alias("_w")).filter("_w is not null").distinct().withColumn("_in", F.lit(True))
    return df.join(wanted, F.lower(F.col(q(key))) == F.col("_w"), "left").filter(text.rlike(pattern) | F.col("_in")).drop("_w", "_in")


def guessed_type(term: Column) -> Column:
    """What kind of thing a term names, by its words (TXT-22); short all-capital terms are genes."""
    low = F.lower(term)
    return (
        F.when(any_contains(low, PATHWAY_WORDS) | low.startswith("pi3k"), "pathway").when(any_contains(low, DISEASE_WORDS), "disease").when(any_contains(low, DRUG_WORDS), "drug")
        .when(term.rlike("^[A-Z0-9-]{1,6}$") & term.rlike("[A-Z]"), "gene").otherwise("unknown")
    )


def candidate_terms(df: DataFrame, source: str, columns: Sequence[str], most: int | None = None) -> DataFrame:
    """(term, origin, source): column names and distinct values that could be vocabulary (TXT-23).

    With ``most``, a column with more distinct values than that holds no vocabulary and gives none.
    """
    cells = df.select(*[F.col(q(c)).cast("string").alias(c) for c in columns]).unpivot([], [F.col(q(c)) for c in columns], "column_name", "value")
    values = cells.filter("value is not null").groupBy("column_name", "value").agg(F.count("*").alias("n"))
    if most is not None:
        few = values.groupBy("column_name").agg(F.count("*").alias("n_values")).filter(F.col("n_values") <= most)
        values = values.join(F.broadcast(few), "column_name")  # one row a column
    terms = values.select(F.col("value").alias("term"), F.lit("value").alias("origin"))
    names = df.sparkSession.createDataFrame([(c, "colname") for c in df.columns], "term string, origin string")
    return names.unionByName(terms).filter(F.length(F.trim("term")) >= 3).distinct().withColumn("source", F.lit(source))


def sentence_relations(found: DataFrame, key: str) -> DataFrame:
    """(key, sentence_id, subject, object, predicate): pairs of mentions of one sentence by their roles (JN-14, TXT-12).

    For predicates of action, drugs act on genes, pathways and diseases; for those of state, genes on diseases and pathways;
    where that gives no pair, every ordered pair of distinct mentions counts. found has (key, sentence_id, normalized, role,
    predicate); a sentence's mentions, few by nature, are paired within the row.
    """
    cells = F.struct("normalized", "role")
    rows = found.groupBy(key, "sentence_id", "predicate").agg(F.array_sort(F.collect_set(cells)).alias("m"))
    action = F.col("predicate").isin([*STRONG, "suppresses", "induces", "sensitizes"])
    state = F.col("predicate").isin([*WEAK, "pathway_activation"])
    pairs = F.flatten(F.transform("m", lambda s: F.transform("m", lambda o: F.struct(s.alias("s"), o.alias("o")))))
    pairs = F.filter(pairs, lambda p: p["s"]["normalized"] != p["o"]["normalized"])
    typed = F.filter(pairs, lambda p: (action & (p["s"]["role"] == "drug") & p["o"]["role"].isin("gene", "pathway", "disease")) | (state & (p["s"]["role"] == "gene") & p["o"]["role"].isin("disease", "pathway")))
    chosen = F.when(F.size(typed) > 0, typed).otherwise(pairs)
    return rows.select(key, "sentence_id", "predicate", F.size("m").alias("n_entities"), F.explode(chosen).alias("p")).select(key, "sentence_id", F.col("p.s.normalized").alias("subject"), F.col("p.s.role").alias("subject_role"), "predicate", F.col("p.o.normalized").alias("object"), F.col("p.o.role").alias("object_role"), "n_entities")
