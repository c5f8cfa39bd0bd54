import random

import pytest

from cedarloom.llm.names import Reader, distance, neighbours, same_name, trie, trie_join

R = Reader()


@pytest.mark.parametrize(
    "name,want",
    [
        ("1124644 Ontario Inc. o/a Puntarzu Fanfpsser Supp. Ctr", ("o", "puntarzu", "fanfpsser", "", "centre support", "")),
        ("South FoldehurRontunwel Day Care Center Ltd. (formerly Wergilmon Hensizar)", ("o", "foldehur", "rontunwel", "south", "care centre day", "")),
        ("No. 2 Forzolde Lelurtur Residence Management", ("o", "forzolde", "lelurtur", "2", "management residence", "")),
        ("Binlaldel-Seszosdul S.C.*", ("o", "binlaldel", "seszosdul", "", "~sc", "")),
        ("YOUTH ZOSNINMOR ROZAGL YOUTH PROGRAMS, LTD", ("o", "zosninmor", "rozagl", "youth", "programs youth", "")),
        ("Fanniginzu, L. C.", ("p", "fanniginzu", "l", "", "", "c")),
        ("Dr. TONY D. Lasropulkir - Tattoo Studio", ("p", "lasropulkir", "anthony", "", "studio tattoo", "d")),
    ],
)
def test_read(name, want):
    assert R.read(name) == want


@pytest.mark.parametrize("name", [None, "", "N/A", "tbd", "Unknown", "-", "Inc."])
def test_no_name(name):
    assert R.read(name) is None


def test_automaton_against_brute_force():
    random.seed(0)
    words = list({"".join(random.choice("abc") for _ in range(random.randint(1, 7))) for _ in range(200)})
    root = trie(words)
    for w in words[:60]:
        assert dict(neighbours(root, w, 2)) == {v: distance(w, v, 9) for v in words if distance(w, v, 9) <= 2}


def test_trie_join_against_brute_force(spark):
    random.seed(5)
    syl = lambda k: "".join(random.choice("bdfg") + random.choice("ae") + random.choice("ln") for _ in range(k))
    base = [(syl(3), syl(3)) for _ in range(25)]

    def typo(w):
        i = random.randrange(len(w) - 1)
        return random.choice([w[:i] + w[i + 1 :], w[:i] + "x" + w[i:], w[:i] + w[i + 1] + w[i] + w[i + 2 :]])

    names = list({*base, *((typo(a), b) for a, b in base), *((a, typo(typo(b))) for a, b in base), *((typo(a), typo(b)) for a, b in base), *((b, a) for a, b in base)})
    df = spark.createDataFrame([(i, *n) for i, n in enumerate(names)], "id bigint, first string, second string")
    want = {}
    for i, (a, b) in enumerate(names):
        for j, (c, d) in enumerate(names[i + 1 :], i + 1):
            k = min(distance(a + b, c + d), distance(a + b, d + c))
            # edits that stay within words: the bound the shards promise
            if k <= 2 and min(distance(a, c) + distance(b, d), distance(a, d) + distance(b, c)) <= 2:
                want[i, j] = k
    got = {(r["id_a"], r["id_b"]): r["d"] for r in trie_join(df).collect()}
    assert set(want) <= set(got)
    assert got == {(r["id_a"], r["id_b"]): r["d"] for r in trie_join(df, block=4).collect()}


SCHEMA = "operator_id bigint, est_name string, organization_name string, shelter_name string, city string"


def test_pairs(spark):
    rows = [
        (1, "Hepulsi Lelunbil Catering", None, None, "Tamsley"), (2, None, "The Catering of Hepulsi Lelunbil, Ltd.", None, None), (3, None, None, "HEPULSI LELNUBIL", "Tamsley"),
        (4, "Hepulsi Lelunbil Catering - North", None, None, "Tamsley"), (5, "N/A", None, None, None), (6, None, None, None, None),
        (7, "Leonard Lunzuvofan Tattoo Studio", None, None, "Harlowen"), (8, "LUNZUVOFAN, LEN B.", None, None, None), (9, "William Lunzuvofan", None, None, None), (10, "L. Lunzuvofan", None, None, None),
        (11, "z" * 10_000, None, None, None), (12, "Lelunbil Hepulsi Catering", None, None, "Tamsley"),
    ]
    got = {tuple(r) for r in same_name(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, 2), (1, 3), (2, 3), (1, 12), (2, 12), (3, 12), (7, 8), (7, 10), (8, 10)}


def test_empty(spark):
    assert same_name(spark.createDataFrame([], SCHEMA)).count() == 0


def test_trie_join_keeps_its_bound_for_every_length(spark):
    random.seed(7)
    word = lambda lo, hi: "".join(random.choice("abdefilnorstuz") for _ in range(random.randint(lo, hi)))

    def typo(w):
        i = random.randrange(len(w))
        return random.choice([w[:i] + w[i + 1 :], w[:i] + "x" + w[i:], w[:i] + "y" + w[i + 1 :], w[:i] + w[i + 1 : i + 2] + w[i : i + 1] + w[i + 2 :]]) or w

    names = []
    for k in range(90):
        a, b = (word(2, 9), word(2, 9)) if k < 60 else (word(14, 19), word(14, 19))
        whole = typo(a + b)
        at = random.randrange(1, len(whole))
        names += [(a, b), (typo(typo(a)), b), (typo(b), typo(a)), (a + b, ""), (whole, ""), (typo(whole), ""), (typo(b + a), ""), (whole[:at], whole[at:])]
    names = sorted(set(names))
    want = {}
    for i, (a, b) in enumerate(names):
        for j, (c, d) in enumerate(names[i + 1 :], i + 1):
            k = min(distance(x, y) for x in {a + b, b + a} for y in {c + d, d + c})
            if k <= 2:
                want[i, j] = k
    df = spark.createDataFrame([(i, *n) for i, n in enumerate(names)], "id bigint, first string, second string")
    assert want == {(r["id_a"], r["id_b"]): r["d"] for r in trie_join(df).collect()}
    assert want == {(r["id_a"], r["id_b"]): r["d"] for r in trie_join(df, block=4).collect()}


def test_typos_in_surnames_with_an_initial(spark):
    rows = [
        (1, "BINTUNTALFA, H", None, None, "Tamsley"), (2, "Binuntalfa, H, Catering", None, None, "Tamsley"), (3, "Folfosbirwes Jo Home Day Care", None, None, "Harlowen"),
        (4, "J Folfosibrwes Home Day Care", None, None, "Harlowen"), (5, "K Folfosibrwes", None, None, "Harlowen"), (6, "L. Bintuntalfa", None, None, "Tamsley"),
    ]
    assert {tuple(r) for r in same_name(spark.createDataFrame(rows, SCHEMA)).collect()} == {(1, 2), (3, 4)}


def test_copies_change_no_pairs(spark):
    names = [("Hepulsi Lelunbil Catering", "Tamsley"), ("Hepuxsi Lelunbli Catering", "Tamsley"), ("Durzanfol Wesketgil Lodge", "Harlowen"), ("Durzanfol Wesketgll Lodge", "Harlowen")]
    rows = [(10 * k + i, n, None, None, c) for k, (n, c) in enumerate(names) for i in range(4 + k % 2)]
    got = {tuple(r) for r in same_name(spark.createDataFrame(rows, SCHEMA)).collect()}
    ids = [r[0] for r in rows]
    assert got == {(a, b) for a in ids for b in ids if a < b and a // 20 == b // 20}


def test_names_beyond_the_shelters(spark):
    pairs = [("Smith, Jonathan", "Jonathan Smith"), ("Jenny Clarkson", "Jennifer Clarkson"), ("Jon Walters Plumbing", "John Walters Plumbing"), ("Acme Insurance", "Acme Ins."), ("University Hospital", "Univ. Hosp."), ("J. Bartholomew", "Jonathan Bartholomew"), ("Family Food Bar", "Family Food Bar")]
    rows = [(10 * i + k, n, None, None, None) for i, p in enumerate(pairs) for k, n in enumerate(p)]
    assert {tuple(r) for r in same_name(spark.createDataFrame(rows, SCHEMA)).collect()} == {(10 * i, 10 * i + 1) for i in range(len(pairs))}
