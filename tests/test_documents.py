"""Generated documents that SQL cannot state, over a small corpus."""

import pytest

import __spark_entry__ as entry
from lodegraph.session import table

SOURCE = """000100 MAIN-PARA.
000200     MOVE 'A' TO WS-X WS-Y. MOVE 5 TO WS-X.
000300     EXEC CICS SEND MAP('M1') MAPSET('S1') RESP(WS-R) END-EXEC.
000400     EXEC CICS HANDLE CONDITION NOTFND(ERR-PARA) DUPKEY(ERR-PARA)
000500     END-EXEC
000600     IF WS-X = 1 PERFORM NEXT-PARA END-IF.
000700*    EXEC CICS READ DATASET('CUST') INTO(WS-REC) END-EXEC.
000800 NEXT-PARA.
000900     EXEC CICS RECEIVE MAP('M1') END-EXEC. EXEC CICS XCTL PROGRAM(WS-PGM)
001000     COMMAREA(WS-C) END-EXEC.
001100* THE LAST WORD OF THE CHUNK
"""


@pytest.fixture(scope="module")
def corpus(spark, sf, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    schema = table(spark, sf, "chunk").schema
    texts = [("p1 ", "paragraph_logic", SOURCE), (None, "paragraph_logic", SOURCE), ("P2", " Paragraph_Logic", ""), ("P2", "paragraph_logic", None), ("P2", "workflow", SOURCE), ("P3", None, SOURCE)]
    rows = [{"row_id": i, "chunk_id": f"c{i}", "program": p, "chunk_type": t, "text": x} for i, (p, t, x) in enumerate(texts)]
    spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema).write.parquet(f"{root}/chunk.parquet")
    n = table(spark, sf, "code_node").schema
    node = {"row_id": 1, "id": "n1", "program": "P9", "flow_type": "DIALECT", "sourceline": 12, "metadata": '{"cics_command": "SEND MAP", "cics_target_program": "M9"}'}
    spark.createDataFrame([tuple(node.get(f.name) for f in n)], n).write.parquet(f"{root}/code_node.parquet")
    table(spark, sf, "chunk_type_ref").write.parquet(f"{root}/chunk_type_ref.parquet")
    return root


def rows_of(spark, corpus, name, *cols):
    return sorted((tuple(r[c] for c in cols) for r in entry.queries()[name](spark, corpus).collect()), key=repr)


def test_cics_fact_tables(spark, corpus):
    assert ("node", 12, "SEND", "MAP", "M9") in rows_of(spark, corpus, "cics_facts", "origin", "line", "command", "target_kind", "target")
    facts = [r[1:] for r in rows_of(spark, corpus, "cics_facts", "row_id", "line", "active", "command", "type", "target_kind", "target", "target_source", "file_group") if r[0] == 0]
    assert facts == [
        (3, True, "SEND", "other", "MAP", "M1", "literal", None), (4, True, "HANDLE", "other", None, None, None, None), (7, False, "READ", "file_read", "DATASET", "CUST", "literal", "cics_files_read"),
        (9, True, "RECEIVE", "other", "MAP", "M1", "literal", None), (9, True, "XCTL", "program_transfer", "PROGRAM", "WS-PGM", "identifier", None),
    ]
    assert {r[1:] for r in rows_of(spark, corpus, "cics_resources", "row_id", "kind", "target") if r[0] == 0} == {("MAP", "M1"), ("MAPSET", "S1")}
    assert {r[1:] for r in rows_of(spark, corpus, "cics_handlers", "row_id", "key", "target", "action") if r[0] == 0} == {("RESP", "WS-R", "capture"), ("NOTFND", "ERR-PARA", "set"), ("DUPKEY", "ERR-PARA", "set")}


def test_documents_of_cics_statements(spark, corpus):
    said = lambda name: [t for c, t in rows_of(spark, corpus, name, "program", "text") if c == "P1"]
    assert said("doc_screen") == ["Map M1 of P1 is sent 1 times and received 1 times."]
    assert said("doc_error_path") == ["Errors DUPKEY, NOTFND lead to ERR-PARA."]
    assert said("doc_cics_resource") == ["Map M1 (literal) is used 2 times by P1.", "Mapset S1 (literal) is used 1 times by P1."]
    assert "Line 9: XCTL on program WS-PGM." in said("doc_cics_operation") and len(said("doc_cics_operation")) == 4
    assert "CONDITION NOTFND at line 4 leads to ERR-PARA." in said("doc_cics_error_handler")


def test_documents_of_source(spark, corpus):
    values = rows_of(spark, corpus, "doc_static_values", "chunk_id", "text")
    assert values == [("P1:static_values:WS-X", "Variable WS-X of P1 takes 2 values: 'A', 5."), ("P1:static_values:WS-Y", "Variable WS-Y of P1 takes 1 values: 'A'.")]
    logic = dict(rows_of(spark, corpus, "doc_paragraph_logic", "chunk_id", "text"))
    assert set(logic) == {"P1:paragraph_logic:0.MAIN-PARA.1", "P1:paragraph_logic:0.NEXT-PARA.8"}
    assert logic["P1:paragraph_logic:0.MAIN-PARA.1"].split("\n")[1:3] == ["- sets 'A' TO WS-X WS-Y", "- sets 5 TO WS-X"] and "    - performs NEXT-PARA" in logic["P1:paragraph_logic:0.MAIN-PARA.1"]
    comments = {(k, t) for p, k, t in rows_of(spark, corpus, "doc_comments", "program", "chunk_type", "text") if p == "P3"}
    # One line of deactivated source without a label makes no block of code.
    assert comments == {("comments", "Before NEXT-PARAGRAPH:\nTHE LAST WORD OF THE CHUNK"), ("comments", "Before NEXT-PARA:\nEXEC CICS READ DATASET('CUST') INTO(WS-REC) END-EXEC.")}
