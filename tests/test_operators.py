import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspan.functions import rules, strings, urls
from loomspan.operators import aggregates, identifiers, joins, reports, shape, text, windows
from loomspan.skew import salted_join


def one(spark, expr, **values):
    schema = ", ".join(f"{k} string" for k in values) or "x string"
    return spark.createDataFrame([tuple(values.values()) or (None,)], schema).select(expr.alias("y")).first()["y"]


def test_binarized(spark):
    rows = spark.createDataFrame([(0.0,), (2.5,), (None,)], "x double").select(shape.binarized(F.col("x")).alias("a"), shape.binarized(F.col("x"), None).alias("b")).collect()
    assert [tuple(r) for r in rows] == [(0, 0), (1, 1), (1, None)]


def test_null_safe_join(spark):
    a = spark.createDataFrame([(None, 1), ("k", 2)], "k string, v int")
    b = spark.createDataFrame([(None, 3), ("k", 4)], "k string, v int")
    assert [tuple(r) for r in joins.keyed(a, b, ["k"]).collect()] == [("k", 2, 4)]
    assert sorted(map(tuple, joins.keyed(a, b, ["k"], null_safe=True).collect()), key=str) == sorted([("k", 2, 4), (None, 1, 3)], key=str)


def test_domains(spark):
    terms = ["gene_count", "nano_size", "nano_gene_panel", "zzz", None]
    got = [r["d"] for r in spark.createDataFrame([(t,) for t in terms], "t string").select(rules.term_domain(F.col("t")).alias("d")).collect()]
    assert got == ["Genomic", "Nanomedicine", "Genomic & Nanomedicine", "Other", "Other"]


def test_surfaces_and_aliases(spark):
    assert one(spark, strings.surface_forms(F.col("t")), t="TNF-α") == sorted({"TNF-α", "TNF α", "TNF-alpha", "TNF alpha"})
    assert one(spark, strings.alias_list(F.col("t")), t="a|b; c ,d/e") == list("abcde")
    assert one(spark, strings.alias_list(F.col("t")), t=" ;, ") == [";,"]
    assert one(spark, strings.casefold(F.col("t")), t="STRAßE") == "strasse"
    assert one(spark, strings.nfkc(F.col("t")), t="ﬁ ①") == "fi 1"


def test_key_rules(spark):
    keys = lambda v, c: {tuple(k) for k in one(spark, identifiers.derived_keys(F.col("v"), F.col("c")), v=v, c=c) or []}
    assert keys("TCGA-A1-A0SB-01A-11R", "x") == {("TCGA-A1-A0SB", "tcga_patient_from_value")}
    assert keys("tcga-a1-a0sb", "patient_id") == {("TCGA-A1-A0SB", "tcga_patient_from_value"), ("TCGA-A1-A0SB", "patient_col_value")}
    assert keys("ach 001234", "note") == {("ACH-001234", "depmap_ach")}
    assert keys("", "patient") == set() and keys(None, "patient") == set()
    assert keys("q1", "attach") == set() or all(r != "depmap_ach" for _, r in keys("q1", "attach"))
    level = one(spark, identifiers.barcode_level(F.col("v")), v="TCGA-A1-A0SB-01A-11R")
    assert tuple(level) == ("TCGA-A1-A0SB-01A", "sample", 0.95)


def test_conflicts_and_winners(spark):
    rows = spark.createDataFrame([("HER2", "ERBB2", "base", 1), ("her2", "HER-2", "scan", 2), ("Her2", "", "seed", 3), (None, "x", "seed", 4)], "alias string, normalized string, source string, id int")
    assert [tuple(r) for r in aggregates.conflicts(rows, "alias", "normalized").collect()] == [("her2", ["ERBB2", "HER-2"])]
    assert [(r["alias_key"], r["id"]) for r in windows.alias_winners(rows, "alias", "source", "id").collect()] == [("her2", 3)]


def test_budget(spark):
    rows = spark.createDataFrame([("g", i, 4) for i in range(3)], "g string, i int, n int")
    assert [r["taken"] for r in windows.within_budget(rows, ["g"], [F.col("i")], "n", 10).orderBy("i").collect()] == [4, 4, 2]


def test_edges(spark):
    rows = [("a", "p", "b", 0.9, True, "S", "d1"), ("a", "p", "b", 0.7, False, "T", "d2"), ("a", "p", "a", 0.9, False, "S", "d1"), ("a", "p", None, 0.9, False, "S", "d1")]
    df = spark.createDataFrame(rows, "subject string, predicate string, object string, confidence double, negated boolean, section string, doc string")
    e = aggregates.relations_to_edges(df).collect()
    assert [(r["sentence_count"], r["doc_count"], r["mean_conf"], r["neg_frac"], r["sections"]) for r in e] == [(2, 2, 0.8, 0.5, ["S", "T"])]


def test_typed_aggregate(spark):
    rows = spark.createDataFrame([("k", 1, 1.0, False, None, ["a"]), ("k", 2, 3.0, True, "x", ["b", "a"]), ("k", 3, None, None, "y", None)], "id string, o int, n double, b boolean, s string, l array<string>")
    r = aggregates.typed_aggregate(rows, "id", [F.col("o")]).first()
    assert (r["n"], r["b"], r["s"], r["l"]) == (2.0, True, "x", ["a", "b"])


def test_urls(spark):
    assert one(spark, urls.host(F.col("u")), u="https://a.ncbi.nlm.nih.gov/x.csv?q=1") == "a.ncbi.nlm.nih.gov"
    assert one(spark, urls.leaf(F.col("u")), u="https://a.ncbi.nlm.nih.gov/y/x.csv?q=1") == "x.csv"
    assert one(spark, urls.trust(F.col("u")), u="https://a.ncbi.nlm.nih.gov/x.csv?q=1") == 5
    assert one(spark, urls.trust(F.col("u")), u="https://nowhere.example/") == 1
    assert one(spark, urls.repaired(F.col("u")), u="httpswww.x.org") == "https://www.x.org"
    assert one(spark, urls.repaired(F.col("u")), u="10.1000/xyz") == "https://doi.org/10.1000/xyz"
    assert one(spark, urls.urls_in(F.col("u")), u="see http://x.org/a).") == ["http://x.org/a"]


def test_sentences(spark):
    assert one(spark, text.sentences(F.col("t")), t="Ab c. De f! gh. Ij") == ["Ab c.", "De f!", "gh.", "Ij"]
    said = "x et al. Yz. See Fig. Two. J. Smith said. Dr. Who left."
    assert one(spark, text.sentences(F.col("t"), True), t=said) == ["x et al.", "Yz. See Fig.", "Two.", "J. Smith said.", "Dr. Who left."]
    assert one(spark, text.sentences(F.col("t"), True, 0, True), t=said) == ["x et al. Yz. See Fig. Two.", "J. Smith said.", "Dr. Who left."]
    assert one(spark, text.sentences(F.col("t")), t="") == []
    assert one(spark, text.cleaned(F.col("t")), t="acti-\nvation\r\n\n\n\nx  y") == "activation\n\nx y"


def test_sections(spark):
    df = spark.createDataFrame([(1, "pre\nABSTRACT\nbody one\nMethods\nbody two"), (2, "nothing"), (3, None), (4, "RESULTS\nx")], "id int, text string")
    got = sorted((r["id"], r["section_no"], r["section"], r["body"]) for r in text.sections_of(df, "id", "text").collect())
    assert got == [(1, 0, "PREFACE", "pre"), (1, 1, "ABSTRACT", "body one"), (1, 2, "METHODS", "body two"), (2, 0, "UNKNOWN", "nothing"), (4, 0, "RESULTS", "x")]


def brute_mentions(doc, terms):
    spans = []
    for t in terms:
        at = doc.lower().find(t)
        while at >= 0:
            end = at + len(t)
            if (at == 0 or not (doc[at - 1].isalnum() or doc[at - 1] == "_")) and (end == len(doc) or not (doc[end].isalnum() or doc[end] == "_")):
                spans.append((at, -end))
            at = doc.lower().find(t, at + 1)
    out, last = [], 0
    for s, e in sorted(spans):
        if s >= last:
            out.append((s, -e))
            last = -e
    return out


def test_mentions(spark):
    rng = random.Random(1)
    terms = ["ab", "ab c", "c d", "d", "er+", "é x"]
    docs = ["".join(rng.choice("abcd eré+x_,") for _ in range(60)) for _ in range(200)] + ["", "ab " * 5000]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)] + [(999, None)], "id int, text string")
    vocabulary = spark.createDataFrame([(t, t.upper(), "k") for t in terms] + [(None, None, None), (" ", "x", "y")], "term string, canonical string, entity string")
    got: dict = {}
    for r in text.mentions(df, "id", "text", vocabulary, "term", "canonical", "entity").collect():
        got.setdefault(r["id"], []).append((r["char_start"], r["char_end"]))
    for i, d in enumerate(docs):
        assert sorted(got.get(i, [])) == brute_mentions(d, terms)


def test_relations(spark):
    assert one(spark, text.predicate(F.col("t")), t="X inhibits and activates Y") == "inhibits"
    assert one(spark, text.negated(F.col("t")), t="it did not work") is True
    assert one(spark, text.quantities(F.col("t")), t="IC50 = 12.5 µM, p < 0.05") == {"IC50": "12.5 uM", "dose": "12.5 uM", "p": "0.05"}
    rows = spark.createDataFrame([(1, 0, "inhibits", "d", "drug"), (1, 0, "inhibits", "g", "gene"), (1, 1, "", "x", "unknown"), (1, 1, "", "y", "unknown")], "id int, sentence_id int, predicate string, normalized string, role string")
    got = sorted((r["sentence_id"], r["subject"], r["object"]) for r in text.sentence_relations(rows, "id").collect())
    assert got == [(0, "d", "g"), (1, "x", "y"), (1, "y", "x")]


def brute_components(edges):
    up: dict = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            ra, rb = find(a), find(b)
            up[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in up}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(edges=st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components(spark, edges):
    df = spark.createDataFrame([(f"n{a:02}", f"n{b:02}") for a, b in edges] + [(None, "n00")], "src string, dst string")
    got = {r["node"]: r["root"] for r in identifiers.connected(df).collect()}
    assert got == brute_components([(f"n{a:02}", f"n{b:02}") for a, b in edges])


def test_component_chain_and_star(spark):
    edges = [(f"c{i:03}", f"c{i + 1:03}") for i in range(120)] + [("hub", f"leaf{i}") for i in range(2000)]
    got = {r["node"]: r["root"] for r in identifiers.connected(spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert got == brute_components(edges)


def test_master_ids(spark):
    components = spark.createDataFrame([("a", "a"), ("b", "a"), ("z", "z")], "node string, root string")
    assert {(r["master_patient_id"], r["patient_key"]) for r in identifiers.master_index(components).collect()} == {("P00000001", "a"), ("P00000001", "b"), ("P00000002", "z")}


def test_salted_join(spark):
    big = spark.createDataFrame([("hot", i) for i in range(5000)] + [("k%d" % i, i) for i in range(50)] + [(None, 1)], "k string, i int")
    small = big.filter("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    got = salted_join(big, small, "k", F.col("i"), "n", 5000)
    assert got.count() == 5050 and got.filter("k = 'hot'").agg(F.count_distinct("i")).first()[0] == 5000


def test_overlaps_and_pairs(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "p int, q string"), spark.createDataFrame([("1", "n"), ("2", "n")], "r string, s string")
    assert [tuple(r) for r in joins.best_column_pairs(a, b).collect()] == [("p", "r", 2, 1.0, "ok")]
    attempts = [(b, F.col("q"), F.col("s")), (b, F.col("p").cast("string"), F.col("r"))]
    got = {r["p"]: (r["attempt"], r["match"]) for r in joins.first_of_matches(a, "p", attempts, "r").collect()}
    assert got == {1: (1, "1"), 2: (1, "2")}


def test_balanced_and_numbered(spark):
    rows = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(300)] + [(999, None)], "id int, label string")
    counts = {r["label"]: r["n"] for r in windows.balanced(rows, "label", "id").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert counts == {"a": 100, "b": 100}
    assert shape.resolve_columns(["Cell Line", "dose", "zz"], ["cell_line", "drug_dose_um"]) == {"Cell Line": "cell_line", "dose": "drug_dose_um", "zz": None}


@pytest.mark.parametrize("size,out", [("512", "512.0 B"), ("2048", "2.0 KB"), (None, None)])
def test_sizes(spark, size, out):
    assert one(spark, strings.human_size(F.col("x").cast("bigint")), x=size) == out


def test_gaps(spark):
    u = spark.createDataFrame([("BRCA1", 3), ("known", 5)], "term string, n bigint")
    s = spark.createDataFrame([("xyz pathway", 2), ("BRCA1", 1)], "term string, n bigint")
    v = spark.createDataFrame([("Known",), (None,)], "t string")
    got = {(r["candidate"], r["suggested_type"], r["total_count"], r["sources"]) for r in reports.vocabulary_gaps(u, s, v, "t").collect()}
    assert got == {("brca1", "gene", 4, "structured|unstructured"), ("xyz pathway", "pathway", 2, "structured")}
