import pytest

from loomspan.llm import canonical

ENTRIES = [
    (1, "Oraopnunov", "ORV-100", "drug"), (2, "warenkaxil receptor", "ORV-100", "gene"), (3, "nazeljoda metabolism", None, "pathway"), (4, "pahynovmel metabolism", None, "pathway"), (5, "Nasoopsel hydrochloride", "NAL-310", "drug"),
    (6, "draxazita tumour", None, "disease"), (7, "gorbucaldy tumour", None, "disease"), (8, "larizelmo-gold nanoshell", "NPL99", "nanoparticle"), (9, "kelcallalu receptor", "KELL3", "gene"), (10, "fiilmasa receptor", "FIA1", "gene"),
    (11, "Ilmosoty hydrochloride", "ILY-195", "drug"), (12, "Waoragorta hydrochloride", "WAA-160", "drug"), (13, "navadawen tumour", None, "disease"), (14, "ulgorzaop metabolism", None, "pathway"), (15, "perlonda-gold nanoshell", "NPP1", "nanoparticle"),
    (16, "zortemba-gold nanoshell", "NPZ2", "nanoparticle"), (17, "mekrilda-gold nanoshell", None, "nanoparticle"), (18, "sorvandil metabolism", None, "pathway"), (19, "trusojoza kinase", "TRUZ1", "gene"), (20, "vafiyorgli kinase", None, "gene"), (21, "yormelgorren kinase", None, "gene"),
]
CASES = [
    ("oraopnunov", None, 1), (" ORAOPNUNOV tablets", None, 1), ("ORV 100", "drugs", 1), ("orv100", "GENE", 2), ("ORV-100", None, -1), ("the Nazeljoda  Metabolism map", None, 3), ("metabolism, nazeljoda", None, 3), ("nazeljda metabolism", None, 3),
    ("nzaeljoda metabolism", "pathway", 3), ("naze1j0da metabolism", None, 3), ("názeljoda metabolism", None, 3), ("nazelj. metabolism", None, 3), ("naz-eljoda metabolism", None, 3), ("Nasoopsel HCl", None, 5), ("draxazita tumor", None, 6),
    ("larizelmo_gold_nanoshell (PEG)", None, 8), ("NPL 99", None, 8), ("NPL991", None, -1), ("draxazita kinase of somebody", None, -1), ("zzzzzz metabolism", None, -1), ("metabolism", None, -1), ("???", None, -1), ("12345", None, -1), ("nazeljoda receptor", None, -1),
]


def frames(spark, values, entries=ENTRIES):
    a = spark.createDataFrame([(i, v, e, "clash", 0.5) for i, (v, e) in enumerate(values)], "alias_id bigint, alias string, entity string, canonical_id string, score double")
    return a, spark.createDataFrame(entries, "canonical_id bigint, canonical string, short_form string, entity string")


@pytest.mark.parametrize(("value", "hint", "entry"), CASES)
def test_match(value, hint, entry):
    assert canonical.Reference(ENTRIES).match(value, hint)[0] == entry


def test_rows(spark):
    values = [("oraopnunov", None), (None, "drug"), ("", None), (" \t", None), ("oraopnunov", None), ("x" * 200_000, None), ("nazeljoda " * 5000, None)]
    a, c = frames(spark, values)
    got = {r["alias_id"]: r["canonical_id"] for r in canonical.match_values(a, c).collect()}
    assert got == {0: 1, 4: 1, 5: -1, 6: 3}
    assert {tuple(r) for r in canonical.unmatched(a, canonical.match_values(a, c)).collect()} == {("x" * 200_000, 1)}


def test_empty(spark):
    a, c = frames(spark, [])
    assert canonical.match_values(a, c).count() == 0
    a, c = frames(spark, [("oraopnunov", None)], [])
    assert [r["canonical_id"] for r in canonical.match_values(a, c).collect()] == [-1]
    a, c = frames(spark, [("only short", None), ("S-1", None)], [(1, None, "S1", None), (None, "x", None, None)])
    assert {r["alias_id"]: r["canonical_id"] for r in canonical.match_values(a, c).collect()} == {0: -1, 1: 1}


def test_edit_distance():
    import random

    def plain(a, b):
        d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    rng = random.Random(6)
    for _ in range(400):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(7))) for _ in range(2))
        assert canonical.edit_distance(a, b, 2) == min(3, plain(a, b))


def test_held_out_typos(spark, data):
    """One random edit in the naming word of each entry still finds that entry."""
    import random

    from loomspan.session import table

    rng = random.Random(7)
    rows = [tuple(r) for r in table(spark, data, "canonical_terms").select("canonical_id", "canonical", "short_form", "entity").orderBy("canonical_id").collect()]
    reference, right = canonical.Reference(rows), 0
    for i, name, _, kind in rows:
        at = rng.randrange(1, 5)
        typed = name[:at] + rng.choice(["", "x", name[at] * 2]) + name[at + 1 :]
        right += reference.match(typed, kind)[0] == i
    assert right >= 0.97 * len(rows)


NOISE = {
    "case": lambda n, r: n.upper() if r.random() < 0.5 else n.title(),
    "white space": lambda n, r: f"  {n.replace(' ', r.choice(['  ', chr(9), chr(160)]))} ",
    "separators": lambda n, r: n.replace(" ", r.choice("_-/")),
    "marks": lambda n, r: n.replace("a", "á").replace("o", "ö"),
    "order": lambda n, r: ", ".join(r.sample(n.split(), len(n.split()))),
    "left out": lambda n, r: n[: (at := r.randrange(1, 5))] + n[at + 1 :],
    "doubled": lambda n, r: n[: (at := r.randrange(1, 5))] + n[at - 1] + n[at:],
    "swapped": lambda n, r: n[: (at := r.randrange(1, 5))] + n[at + 1] + n[at] + n[at + 2 :],
    "two edits": lambda n, r: n[:1] + "x" + n[2:4] + n[5:],
    "scanned": lambda n, r: n.replace("o", "0", 1).replace("l", "1", 1),
    "cut off": lambda n, r: f"{n.split()[0][:-2]}. {' '.join(n.split()[1:])}",
    "written apart": lambda n, r: f"{n[:4]}{r.choice(' -')}{n[4:]}",
    "American": lambda n, r: n.replace("our", "or").replace("ae", "e").replace("lling", "ling"),
    "kind abbreviated": lambda n, r: " ".join([n.split()[0], *[w[:4] if len(w) > 6 else w for w in n.split()[1:]]]),
    "words around": lambda n, r: f"the {n} (see note 7)",
}


@pytest.mark.parametrize("kind", NOISE)
def test_held_out_noise(spark, data, kind):
    """Of each kind of noise at least nine of ten forms find their entry, and hardly any finds another."""
    import random

    from loomspan.session import table

    rng = random.Random(kind)
    rows = [tuple(r) for r in table(spark, data, "canonical_terms").select("canonical_id", "canonical", "short_form", "entity").orderBy("canonical_id").collect()]
    reference = canonical.Reference(rows)
    got = [(i, reference.match(NOISE[kind](name, rng), None)[0]) for i, name, _, _ in rows]
    assert sum(i == j for i, j in got) >= 0.9 * len(rows), kind
    assert sum(j not in (i, -1) for i, j in got) <= 0.01 * len(rows), kind


def test_neighbours_equal_brute_force():
    import random

    rng = random.Random(8)
    listed = sorted({"".join(rng.choice("abü😀") for _ in range(rng.randrange(1, 9))) for _ in range(200)})
    asked = ["".join(rng.choice("abü😀") for _ in range(rng.randrange(1, 12))) for _ in range(200)] + ["", "a" * 100_000]
    near = canonical._Neighbours(listed, canonical._allowed)
    for w, found in near.of(asked).items():
        most = lambda t: min(canonical._allowed(w), canonical._allowed(t))  # noqa: B023, E731
        assert found == ([(t, d) for t in listed if (d := canonical.edit_distance(w, t, most(t))) <= most(t)] if w else [])


def test_large_list():
    """A list of many entries stays small and quick enough for every worker."""
    import pickle
    import random

    rng = random.Random(4)
    syllables = [a + b for a in "bdfgklmnprstvz" for b in "aeiou"]
    names = sorted({"".join(rng.choices(syllables, k=5)) for _ in range(10_000)})
    reference = canonical.Reference([(i, f"{n} kinase", None, "gene") for i, n in enumerate(names)])
    assert len(pickle.dumps(reference)) < 4096 * len(names)
    tried = rng.sample(range(len(names)), 300)
    assert sum(reference.match(f"{names[i][:3]}x{names[i][3:]} kinase", None)[0] == i for i in tried) >= 0.95 * len(tried)
