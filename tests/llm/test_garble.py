import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from cedarloom.llm.garble import CHAINS, SENTENCE, WORD, Judge, bucket, garble, invert, judged, lose, train, words_of

TEXTS = [
    "Le comité a discuté de l’été prochain à l’hôtel.", "La comisión aprobó la petición número 12 mañana.", "A inspeção encontrou água à noite, não é?",
    "Die Prüferin stellte fest, dass die Küche für Gäste größer ist.", "Komisja przyjęła wniosek, żaden łóżko nie było wolne.", "The café’s report was “carried” – 5 votes.",
]
CLEAN = ["ÂGE MINIMUM 62 ANS – ENTRÉE À CÔTÉ", "Увага: пункт 2 тимчасово зачинено", "├── north.csv\n└── notes", "Ðórunn’s Þing Hall", "KleenAir® cost £15 (§ 2) • ½ × ¾", "plain ascii text", "", None]


@given(st.text(alphabet="abcéèàçñüößłężą’“” ", max_size=40), st.sampled_from(CHAINS))
@settings(deadline=None, max_examples=200)
def test_round_trip(text, chain):
    bad = garble(text, chain)
    assert bad is None or invert(bad, chain) == text


def test_found_and_restored(spark):
    random.seed(4)
    rows = [(i, " ".join(random.sample(TEXTS, 3))) for i in range(1500)]
    rows += [(10_000 + i, CLEAN[i % len(CLEAN)]) for i in range(160)]
    bad = {}
    for i, chain in enumerate(CHAINS[:7] + [(("utf-8", "cp1252"),) * 2]):
        t = TEXTS[i % 6] if garble(TEXTS[i % 6], chain) else TEXTS[0]
        bad[20_000 + i] = (t, garble(t, chain))
    lost = (30_000, lose(TEXTS[0], "latin-1"))
    long = (30_001, "x " * 60_000 + bad[20_000][1])
    rows += [(k, f"{v[1]} {TEXTS[5]}") for k, v in bad.items()] + [lost, long, long]
    got = judged(spark.createDataFrame(rows, "doc_id bigint, text string"), texts=True).collect()
    assert {r["doc_id"] for r in got} == {*bad, 30_000, 30_001}
    by = {r["doc_id"]: r for r in got}
    assert not by[30_000]["restorable"]
    right = sum(by[k]["restored"] == f"{v[0]} {TEXTS[5]}" for k, v in bad.items())
    assert right >= len(bad) - 1


def test_empty(spark):
    assert judged(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_copies_of_a_garbled_text_are_found(spark):
    random.seed(5)
    rows = [(i, " ".join(random.sample(TEXTS, 3))) for i in range(300)]
    bad = garble("Le comité a discuté à l'école de l'été prochain.", (("cp1252", "cp437"),))
    rows += [(10_000 + i, bad) for i in range(200)]
    got = {r["doc_id"] for r in judged(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {10_000 + i for i in range(200)}


def test_very_long_words_are_trained_on_and_judged(spark):
    rows = [(i, " ".join(TEXTS)) for i in range(50)] + [(90, "é" * 30_000), (91, garble("é" * 30_000, CHAINS[0]))]
    assert {r["doc_id"] for r in judged(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()} == {91}


def test_held_out_restoration(spark):
    """Trained on one half of the notes; sentences of the other half, garbled by each chain in turn,
    are found and restored exactly."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").where("text is not null")
    bad = {r["doc_id"] for r in judged(docs).collect()}
    judge = Judge(*train(docs.where("doc_id % 2 = 0")))
    whole = [s for r in docs.where("doc_id % 2 = 1").collect() if r["doc_id"] not in bad for s in SENTENCE.split(r["text"]) if len(re.findall(r"\w*[éèêàçñáíóúãõäöüßąćęłńśźż]\w*", s)) >= 3][: 40 * len(CHAINS)]
    found, right, n = 0, 0, 0
    for i, s in enumerate(whole):
        g = garble(s, CHAINS[i % len(CHAINS)])
        if g is not None and g != s and invert(g, CHAINS[i % len(CHAINS)]) == s:
            back, chains, _ = judge.restore(g)
            n, found, right = n + 1, found + bool(chains), right + (back == s)
    print("sentences", n, "found", found, "restored exactly", right)
    assert n > 300 and found >= 0.98 * n and right >= 0.9 * n


def test_all_texts_are_trained_on(spark):
    """Every distinct text counts once, copies add nothing, however many documents there are."""
    docs = spark.range(45_000).selectExpr("id as doc_id", "concat('La reunión de mañana número ', id) as text")
    seen = train(docs.union(docs.where("doc_id < 500")))[1]
    assert seen[bucket("mañana")] == seen[bucket("reunión")] == 45_000


def test_a_clean_sign_garbled_once_elsewhere_stays_clean(spark):
    """In cp850 read as cp1252 the clean name would be the garbled one of the other text."""
    random.seed(6)
    rows = [(i, " ".join(random.sample(TEXTS, 3)) + f" Bring KleenAir® {i}.") for i in range(400)]
    bad = garble("Le comité a discuté à l'école de l'été prochain, avec KleenAir®.", (("cp1252", "cp850"),))
    got = judged(spark.createDataFrame([*rows, (1000, bad)], "doc_id bigint, text string")).collect()
    assert "KleenAir«" in bad and {r["doc_id"] for r in got} == {1000}


@given(st.text(alphabet="ab?é \n\t\u00a0ß\x85", max_size=60))
@settings(deadline=None, max_examples=300)
def test_words_are_those_of_the_pattern(text):
    assert words_of(text) == WORD.findall(text)
