import random

import pytest

from lodegraph.llm import codetext, langid
from lodegraph.llm import queries as q

SAY = {
    "en": ["The program reads the account file and checks every balance.", "This paragraph closes all files before the day is over.", "Nothing was printed because the limit is too small."],
    "de": ["Das Programm liest die Kontodatei und prüft jeden Saldo.", "Dieser Absatz schließt alle Dateien, bevor der Tag endet.", "Nichts wurde gedruckt, weil die Grenze zu klein ist."],
    "fr": ["Le programme lit le fichier des comptes et vérifie chaque solde.", "Ce paragraphe ferme tous les fichiers avant la fin du jour.", "Rien n'a été imprimé parce que la limite est trop petite."],
    "ja": ["プログラムは口座ファイルを読み込んで残高を確認します。", "この段落はすべてのファイルを閉じます。", "上限が小さいため何も印刷されません。"],
}
DOC = "doc_id long, text string, lang string, k string, t string, seg_no int"


@pytest.fixture(scope="module")
def model(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(160):
        lang = list(SAY)[i % 4]
        label = rnd.choice(list(SAY)) if i % 10 == 0 else rnd.choice([lang, lang.upper(), f"{lang}-XX", langid.LABELS[lang][-1].title()])
        rows.append((i, " ".join(rnd.sample(SAY[lang], 2)), label, "a", "b", 1))
    return langid.fitted(spark.createDataFrame(rows, DOC), "doc_id", "text", "lang")


def test_found_cases(spark, model):
    en, de, ja = SAY["en"], SAY["de"], SAY["ja"]
    rows = [
        (1, en[0], "en-US"), (2, en[0], "de"), (3, de[1], None), (4, de[1], " "), (5, ja[0], "Japanese"), (6, f"{en[0]} {en[1]}\n{de[0]}\r\n{ja[1]}{ja[2]} {en[2]}", "en"),
        (7, "WS-CUST-SW WS-TOTAL-IDX", None), (8, None, None), (9, "", "zz"), (10, "       MOVE WS-A TO WS-B.\n           PERFORM X-1 UNTIL WS-C = 'Y'", None),
        (11, f"# PAY01 summary\n[PAY01] {de[0]}\n       MOVE WS-A TO WS-B.\n{de[2]} → Σ", "deu"), (12, de[0].upper().replace("Ü", "UE"), "GERMAN"), (13, f"{en[0]} " * 2000, "eng"), (14, en[0], "??"), (15, "PAY01.CBL", "en"),
    ]
    df = spark.createDataFrame([(*r, "x", "y", 9) for r in rows], DOC)
    got = {tuple(r) for r in langid.mislabelled(df, "doc_id", "text", "lang", model).collect()}
    assert got == {(2, 1, "en"), (3, 1, "de"), (4, 1, "de"), (6, 1, "en"), (6, 2, "de"), (6, 3, "ja"), (6, 4, "en"), (14, 1, "en")}
    by = {r.doc_id: r for r in langid.documents(df, "doc_id", "text", "lang", model).collect()}
    assert len(by) == len(rows)
    assert [by[i].label_status for i in (1, 2, 3, 6, 7, 8)] == ["right", "wrong", "missing", "mixed", "none", "none"]
    assert all(0 < r.confidence <= 1 for r in by.values() if r.lang)


def test_unseen_words_fall_back_to_grams(model):
    for word, lang in (("kontodateien", "de"), ("printing", "en"), ("imprimerie", "fr")):
        assert word not in model.words
        assert model.languages[int(model.score(word).argmax())] == lang


def test_empty_and_unlabelled(spark):
    none = spark.createDataFrame([], DOC)
    m = langid.fitted(none, "doc_id", "text", "lang")
    assert langid.mislabelled(none, "doc_id", "text", "lang", m).count() == 0
    some = spark.createDataFrame([(1, SAY["en"][0], "en", "", "", 0)], DOC)
    assert langid.mislabelled(some, "doc_id", "text", "lang", m).count() == 0
    assert langid.documents(some, "doc_id", "text", "lang", m).first().lang is None


def test_labels(spark):
    rows = [(x,) for x in ("EN", "en_GB", "pt-BR", "Portuguese", "fre", "zh", "cobol", "", None, "zz-ZZ")]
    got = [r.x for r in spark.createDataFrame(rows, "l string").select(langid.label_language("l").alias("x")).collect()]
    assert got == ["en", "en", "pt", "pt", "fr", None, None, None, None, None]


def spans(text, jcl=False):
    return {(s.start_line, s.kind, " ".join(x.strip() for x in s.lines)) for s in codetext.spans(text, jcl)}


def test_fixed_form_spans():
    text = "\r\n".join(
        [
            "000100 MAIN-1.                                                          CR1",
            "000200* first line of a block                                           CR2",
            "000300/ second line of it",
            "000400     MOVE 'IT''S HERE' TO A. *> behind code",
            "000500* alone after code",
            "000600     DISPLAY \"a literal that goes on to the very end of the l".ljust(71) + "i",
            "000700-    \"ne and closes here\".",
            "           EXEC SQL",
            "             -- note in sql",
            "             SELECT 'x' FROM T -- behind",
            "           END-EXEC. DISPLAY A -- B.",
        ]
    )
    assert spans(text) == {
        (2, "comment", "first line of a block second line of it"), (4, "literal", "IT'S HERE"), (4, "comment", "behind code"), (5, "comment", "alone after code"),
        (6, "literal", "a literal that goes on to the very end of the l    ine and closes here"), (9, "comment", "note in sql"), (10, "literal", "x"), (10, "comment", "behind"),
    }


def test_free_form_and_fragments():
    text = ">>SOURCE FORMAT IS FREE\n*> a note\n  DISPLAY 'a text that is longer than a fixed line could ever be, as free form has no end of it'. *> end\n*> one more"
    got = spans(text)
    assert (2, "comment", "a note") in got and (3, "comment", "end") in got and (4, "comment", "one more") in got
    assert any(k == "literal" and x.endswith("no end of it") for _, k, x in got)
    assert spans("             -- inside\n           END-EXEC.") == {(1, "comment", "inside")}
    assert spans("") == set() and spans("           DISPLAY 'never closed") == {(1, "literal", "never closed")}


def test_jcl_spans():
    text = "//* one\n//* two\n//S1 EXEC PGM=P,PARM='it''s a value' a remark\n// SET M='text'\n//D DD *\nit's data\n/*\n//* three"
    assert spans(text, True) == {(1, "comment", "one two"), (3, "literal", "it's a value"), (3, "comment", "a remark"), (4, "literal", "text"), (8, "comment", "three")}


def test_code_lines_are_not_natural():
    for t in (" MOVE WS-A TO WS-B.", " IF WS-A = 'Y'", " END-IF.", " INC6139 04.08.2019 KMT", " CR294", "SELECT C1 FROM T9 WHERE K=?", " ====", " EXEC CICS RETURN END-EXEC.", " PERFORM A-1 THRU A-EXIT."):
        assert codetext.natural_lines(codetext.Span(1, "comment", (t,))) == [] or len(codetext.folded_words(t)) < codetext.LEAST_WORDS, t
    assert codetext.natural_lines(codetext.Span(1, "comment", (" The job moves the customer address.",)))


def test_natural_language_in_source(spark):
    rnd = random.Random(4)
    docs = spark.createDataFrame([(i, " ".join(rnd.sample(SAY[lang], 2)), lang, "", "", 0) for i, lang in enumerate(["en", "de", "fr"] * 30)], DOC)
    src = lambda c, l: f"000100 A-1.\n000200* ****\n000300* {c}\n000400     MOVE WS-A TO WS-B.\n000500     DISPLAY '{l}'.\n000600* MOVE WS-C TO WS-D."
    rows = [(1, "paragraph_logic", "P", src(SAY["de"][0], "Nothing was printed because")), (2, " DEAD_CODE", None, src(SAY["fr"][1], "A01 B02 C03 D04")), (3, "comments", "P", src(SAY["en"][0], "x")), (4, "paragraph_logic", "P", None), (5, "paragraph_logic", "P", ""), (6, None, "P", "x")]
    chunks = spark.createDataFrame([(*r, True, "z") for r in rows], "row_id long, chunk_type string, program string, text string, is_jcl boolean, _type string")
    types = spark.createDataFrame([("paragraph_logic", "cobol", True), ("dead_code", "cobol", True), ("comments", "cobol", False)], "chunk_type string, family string, holds_source boolean")
    catalog = spark.createDataFrame([("P", "DE"), ("Q", None)], "program string, house_lang string")
    strings = codetext.labelled_strings(docs, chunks, types, catalog)
    cases = codetext.natural_language(chunks, types, codetext.fitted(strings))
    got = {(r.row_id, r.start_line, r.kind, r.lang) for r in cases.collect()}
    assert got == {(1, 2, "comment", "de"), (1, 5, "literal", "en"), (2, 2, "comment", "fr")}
    shares = {(r.row_id, r.lang): r.share for r in codetext.shares(cases).collect()}
    assert 0 < shares[1, "de"] < 1 and set(shares) == {(1, "de"), (1, "en"), (2, "fr")}
    empty = codetext.natural_language(chunks.filter("false"), types, codetext.fitted(codetext.labelled_strings(docs.filter("false"), chunks.filter("false"), types, catalog)))
    assert empty.count() == 0


def test_held_out_accuracy(spark):
    """The word model agrees with the right labels of documents it was not fitted on."""
    sf = "/root/testdata/sf0.01"
    docs, model = q._language_model(spark, sf)
    held = docs.filter("doc_id % 5 = 1")
    fit = langid.fitted(docs.filter("doc_id % 5 <> 1"), "doc_id", "text", "lang")
    rows = langid.documents(held, "doc_id", "text", "lang", fit).filter("n_segments = 1 and label_status in ('right', 'wrong')").collect()
    assert sum(r.label_status == "right" for r in rows) / len(rows) > 0.9
    same = {r.doc_id: r.lang for r in langid.documents(held, "doc_id", "text", "lang", model).collect()}
    assert all(same[r.doc_id] == r.lang for r in rows)


def test_queries_run(spark, sf):
    for name in ("p1_found", "p1_pieces", "p3_token_budget", "p3_chunk_tokens", "p4_found", "p4_shares", "p7_ids", "p8_containers", "p8_fill", "p9_found", "p9_documents"):
        assert q.QUERIES[name](spark, sf).count() > 0, name


def test_comments_have_the_shortest_encoding_whatever_stood_before(spark):
    from lodegraph.llm import codetext

    left, right = "zorba quelim vanto brusk dapper wixon", "plimth ogre yuslak terrno fabix junder"
    said = "hermod kasli bovent truska limpar odwen"
    dictionaries = {"de": f"{said} . {left} . mumble . {right}".encode(), "fr": f"other . {left} {right}".encode()}, b"code"
    rows = [(1, "comments", "P", f"000100* {said}\n000200 A-1.\n000300* {left}\n000400* {right}")]
    chunks = spark.createDataFrame(rows, "row_id long, chunk_type string, program string, text string")
    types = spark.createDataFrame([("comments", "cobol", True)], "chunk_type string, family string, holds_source boolean")
    got = {(r.start_line, r.lang) for r in codetext.natural_language(chunks, types, dictionaries).collect()}
    assert got == {(1, "de"), (3, "fr")}


def test_lines_with_words_are_no_rules():
    from lodegraph.llm import codetext

    line = "- the job moves the customer address"
    assert codetext.natural_lines(codetext.Span(1, "comment", (line, "- - - -", "====", "** **"))) == [line]
