from __future__ import annotations

import random

import pytest

from veredas.llm.truncation import BY_DESIGN, COMPLETE, NAMES, OPEN, alignment, closing, truncated_texts, truncation_rates

BODY = "La comisión citó a los alcaldes para explicar el fallo parcial del siete de febrero. El contratista entregó la obra. "


@pytest.mark.parametrize(
    ("end", "state"),
    [
        ("El auditor publicó el saldo de 38,", OPEN),
        ("El auditor publicó el sal", OPEN),
        ("El auditor publicó el saldo…", OPEN),
        ("El auditor publicó el [...]", OPEN),
        ("El auditor publicó el (…)", OPEN),
        ("El auditor publicó el sal�", OPEN),
        ("El auditor publicó Qu <a hre", OPEN),
        ("El auditor publicó sus &nbs", OPEN),
        ("El auditor publicó el  \n\n", OPEN),
        ("El auditor publicó el saldo.", COMPLETE),
        ("«El auditor publicó el saldo»", COMPLETE),
        ("¿Y mañana?", COMPLETE),
        ("\n(Fin del comunicado)", COMPLETE),
        ("\nhttps://a.example/nota/1", BY_DESIGN),
        ("\nTotal\t12.400", BY_DESIGN),
        ("\nPlazo: 5 días", BY_DESIGN),
        ("\nAna Ruiz", NAMES),
        ("\nOficina de Prensa de Lubbock", NAMES),
    ],
)
def test_closings(end, state):
    assert closing(BODY + end)[0] == state


def test_odd_closings():
    for text in ("", " \n", ".", "…", "�" * 500, "Sin texto", "x" * 200_000, "<" * 300):
        closing(text)
    assert closing("Sin texto")[0] == BY_DESIGN and closing("")[0] == COMPLETE


def test_alignment_of_near_copies():
    base = BODY * 6
    assert alignment(base + "El saldo fue", base + "El saldo fue de nueve millones.") == "early"
    assert alignment(base + "El saldo.", base + "El saldo. Y más.") == "boundary"
    assert alignment(base, base) == "end"
    assert alignment("uno dos", base) == "none"


def test_operator(spark):
    long = " ".join(f"palabra{i} de la nota" for i in range(60)) + ". "
    rows = [
        (1, long + "Firmado por Ana Ruiz de la Torre y los vecinos.", "s"),
        (2, long + "Firmado por\nAna Ruiz", "s"),
        (3, long + "El auditor publicó", "s"),
        (4, None, "s"),
        (5, "", None),
        (6, "Sin texto", None),
        (7, "x " * 100_000, "t"),
        (8, long, "t"),
        (9, long, "t"),
        (None, "El auditor", "t"),
    ]
    df = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, source string, state int, truncated boolean")
    out = truncated_texts(df)
    assert sorted(r.doc_id for r in out.where("truncated").collect()) == [3, 7]
    assert out.count() == 9
    rates = {r.source: (r.documents, r.truncated) for r in truncation_rates(out).collect()}
    assert rates == {"s": (4, 1), "t": (3, 1), None: (2, 0)}
    assert truncated_texts(df.limit(0)).count() == 0


def test_a_copy_that_goes_on_decides(spark):
    long = " ".join(f"palabra{i} de la nota" for i in range(80)) + ". "
    rows = [(1, long + "\nCurtontar Korhepola", "s"), (2, long + "\nCurtontar Korhepola dijo que el saldo es alto.", "s")]
    out = {r.doc_id: (r.truncated, r.evidence) for r in truncated_texts(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out == {1: (True, "copy"), 2: (False, "closing")}


def test_words_are_counted_over_all_batches(spark):
    rows = [(i, f"Nota {i} de la alcaldía.", "s") for i in range(10)]
    rows += [(i, f"La alcaldía pagó la obra {i}.", "s") for i in range(10, 60)]
    rows += [(60, BODY + "\nen la alcaldía", "s")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        out = truncated_texts(spark.createDataFrame(rows, "doc_id long, text string, source string"))
        assert [r.doc_id for r in out.where("truncated").collect()] == [60]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("variant", ["longer", "same tail"])
def test_a_copy_behind_longer_texts_of_its_buckets(spark, variant):
    words = [f"palabra{i}" for i in range(240)]
    name, more = "\nCurtontar Korhepola", "\nCurtontar Korhepola dijo que el saldo es alto."
    rows = [(1, " ".join(words) + name, "s"), (2, " ".join(words) + more, "s")]
    for k in range(200):
        if variant == "longer":
            text = " ".join(words + [f"otra{k}x{i}" for i in range(66)]) + "."
        else:
            text = " ".join(words[:k] + [f"otra{k}x{i}" for i in range(27)] + words[k + 27 :]) + more + " Fue ayer."
        rows.append((10 + k, text, "s"))
    out = truncated_texts(spark.createDataFrame(rows, "doc_id long, text string, source string")).where("truncated")
    assert [(r.doc_id, r.evidence) for r in out.collect()] == [(1, "copy")]


def test_short_texts_find_their_copies(spark):
    rows = [(1, "a b c d e f g h Ana Ruiz", "s"), (2, "a b c d e f g h Ana Ruiz ha", "s")]
    out = truncated_texts(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {r.doc_id: r.evidence for r in out.collect()}[1] == "copy"


@pytest.mark.parametrize(
    ("end", "more", "verdict"),
    [
        ("por 3.", "500 pesos.", "early"),
        ("según el art.", " 5 de la ley.", "early"),
        ("dijo el Sr.", " Pérez ayer.", "early"),
        ("de EE.", "UU. y otros.", "early"),
        ("en 2023.", " Después siguió.", "boundary"),
        ("en 2023.", " 15 vecinos.", "boundary"),
        ("este mar.", " 15 vecinos.", "boundary"),
    ],
)
def test_points_of_abbreviations_and_numbers(spark, end, more, verdict):
    base = " ".join(f"palabra{i} de la nota" for i in range(60)) + ". El auditor respondió "
    assert alignment(base + end, base + end + more) == verdict
    rows = [(1, base + end, "s"), (2, base + end + more, "s")]
    out = truncated_texts(spark.createDataFrame(rows, "doc_id long, text string, source string")).where("truncated")
    assert [r.doc_id for r in out.collect()] == [1] * (verdict == "early")


def test_recall_of_planted_cut_copies(spark):
    draw = random.Random(8)
    words = [f"{a}{b}" for a in "bra cru dal fen gor hil jun kas lom mir".split() for b in "ado era ino uba oste".split()]
    rows, cut = [], []
    for i in range(60):
        sentences = [" ".join(draw.choice(words) for _ in range(draw.randint(8, 14))).capitalize() + "." for _ in range(9)]
        text = " ".join(sentences)
        at = draw.randint(int(len(text) * 0.88), int(len(text) * 0.97))
        while text[at - 1] in ". " or text[at] in ". ":
            at -= 1
        rows += [(2 * i, "s", text), (2 * i + 1, "t", text[:at])]
        cut.append(2 * i + 1)
    out = {r.doc_id: r for r in truncated_texts(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert sum(out[d].truncated and out[d].evidence == "copy" for d in cut) >= 0.9 * len(cut)
    assert not any(out[d].truncated for d in out if d % 2 == 0)
