"""Statement trees, their runs, and programs without GO TO."""

import random

import pytest

from lodegraph.operators import cobol, interpret

DATA = """       IDENTIFICATION DIVISION.
       PROGRAM-ID. TESTP.
       DATA DIVISION.
       FILE SECTION.
       FD  IN-FILE.
       WORKING-STORAGE SECTION.
       01  WS-REC.
           05 WS-A PIC 9(3)V99 VALUE 1.5.
           05 WS-B PIC X(10) VALUE 'ab.c'.
              88 IS-GOOD VALUE 'Y' 'Z'.
       77  I PIC 9(4) VALUE 0.
       77  J PIC 9(4) VALUE 0.
       77  K PIC 9(4) VALUE 0.
       PROCEDURE DIVISION.
"""


def shown(source):
    return [d for _, _, t, d in interpret.traced(source, 3000) if t == "DISPLAY"]


def nodes(source):
    return {i: n for i, _, _, n in cobol.walk(cobol.parse(source))}


def test_tree_of_a_program():
    source = DATA + """       MAIN SECTION.
       A100.
      * IF A COMMENT THEN NOTHING
           MOVE 1 TO I. IF I > 3
              DISPLAY 'X' IF IS-GOOD GO TO A200 ELSE NEXT SENTENCE
              END-IF
           ELSE PERFORM A200 THRU A200-EXIT UNTIL I = 9
           END-IF
           READ IN-FILE AT END MOVE 'A
      -    'B' TO WS-B NOT AT END ADD 1 TO I END-READ.
       A200.
           EXEC SQL SELECT A.B INTO :C FROM T END-EXEC
           CALL 'SUBP' USING WS-A. GO TO NOWHERE.
       A200-EXIT. EXIT.
"""
    root = cobol.parse(source)
    assert root.name == "TESTP" and [d.name for d in root.children] == ["IDENTIFICATION", "DATA", "PROCEDURE"]
    rec = next(n for n in nodes(source).values() if n.name == "WS-REC")
    assert [c.name for c in rec.children] == ["WS-A", "WS-B"] and rec.children[1].children[0].name == "IS-GOOD"
    kinds = [n.type for n in nodes(source).values() if n.type not in ("DIVISION", "DATA", "DATA_88", "FILE", "PROGRAM", "SENTENCE")]
    assert kinds == ["SECTION", "PARAGRAPH", "MOVE", "IF_BRANCH", "THEN", "DISPLAY", "IF_BRANCH", "THEN", "GOTO", "ELSE", "NEXT_SENTENCE", "ELSE", "PERFORM", "READ", "PHRASE", "MOVE", "PHRASE", "ADD", "PARAGRAPH", "EXEC_SQL", "CALL", "GOTO", "PARAGRAPH", "EXIT"]
    read = next(n for n in nodes(source).values() if n.type == "READ")
    assert read.children[0].children[0].text.startswith("MOVE 'A") and read.line_end == 24
    assert cobol.defects(source) == [(27, "unresolved label", "NOWHERE")]
    edges = cobol.flow_edges(source)
    at = {n.name: i for i, n in nodes(source).items() if n.type == "PARAGRAPH"}
    assert {d for _, d, k in edges if k == "JUMPS_TO"} == {at["A200"]} and (at["A100"], at["A200"], "FOLLOWED_BY") in edges
    assert ("A200", "ref_label") in {(n, k) for n, k, _, _ in cobol.symbols(source)} and ("IN-FILE", "file") in {(n, k) for n, k, _, _ in cobol.symbols(source)}


@pytest.mark.parametrize("source", ["", " ", "\n\n", "       .", "       IF", "       IF A", "       PERFORM", "      * ONLY", "       END-IF.", "       MOVE 'X", "       EVALUATE WHEN WHEN.", "x" * 5000, "       A. GO TO A."])
def test_broken_texts_do_no_harm(source):
    assert cobol.tree_rows(source)[0][4] == "PROGRAM"
    for f in (cobol.flow_edges, cobol.symbols, cobol.defects, interpret.ir_rows, interpret.restructured):
        list(f(source))
    assert len(interpret.traced(source, 50)) <= 51


def test_statements_do_what_they_say():
    body = """       A.
           ADD 1 2 TO I. DISPLAY I. SUBTRACT 1 FROM I GIVING J.
           MULTIPLY I BY J. DIVIDE 4 INTO J. DISPLAY J.
           COMPUTE K = (I + 2) * 3 ** 2 - -1. DISPLAY K.
           IF I = 1 OR 2 OR 3 DISPLAY 'SHORT'.
           IF I > 1 AND < 9 AND NOT = 4 DISPLAY 'RANGE'.
           IF NOT (I = 3 AND J = 1) DISPLAY 'NO' ELSE
              DISPLAY 'NOT'.
           SET IS-GOOD TO TRUE. IF IS-GOOD DISPLAY WS-B.
           IF WS-B IS ALPHABETIC DISPLAY 'ALPHA'.
           IF WS-A IS POSITIVE DISPLAY WS-A.
           EVALUATE I ALSO J WHEN 1 ALSO ANY DISPLAY 'NO'
              WHEN 3 ALSO 0 THRU 3 DISPLAY 'EV'
              WHEN OTHER DISPLAY 'OTHER' END-EVALUATE.
           EVALUATE TRUE WHEN I > 5 CONTINUE WHEN J < 9
              DISPLAY 'TRUE' END-EVALUATE.
           PERFORM VARYING I FROM 1 BY 1 UNTIL I > 2
              AFTER J FROM 5 BY -1 UNTIL J < 4 DISPLAY I J
           END-PERFORM.
           PERFORM B 2 TIMES. PERFORM B THRU C.
           GO TO B C DEPENDING ON I. STOP RUN.
       B. DISPLAY 'B'.
       C. DISPLAY 'C'. STOP RUN.
"""
    want = ["3", "1.5", "46", "SHORT", "RANGE", "NO", "Y", "ALPHA", "1.5", "EV", "TRUE", "15", "14", "25", "24", "B", "B", "B", "C"]
    assert shown(DATA + body) == want


def test_programs_without_gotos_show_the_same():
    def program(seed):
        r = random.Random(seed)
        n, out = r.randint(3, 6), []
        for k in range(n):
            out += [f"       P{k}.", "           ADD 1 TO I. IF I > 40 STOP RUN."]
            for _ in range(r.randint(1, 4)):
                to, cond = f"P{r.randrange(n)}", r.choice([f"I > {r.randint(1, 20)}", f"J = {r.randint(0, 3)}", f"NOT I = {r.randint(0, 9)} AND J < 5"])
                a = r.randrange(n)
                kind = r.randrange(6)
                if kind == 0:
                    out.append(f"           DISPLAY 'P{k}' I J.")
                elif kind == 1:
                    out += [f"           IF {cond} DISPLAY 'T' GO TO {to} ELSE", "             ADD 1 TO J END-IF DISPLAY 'AFTER' I."]
                elif kind == 2 and a > k:
                    out.append(f"           PERFORM P{a} THRU P{r.randrange(a, n)}.")
                elif kind == 3:
                    out.append(f"           GO TO {to}.")
                elif kind == 4:
                    out += ["           PERFORM UNTIL K > 3 ADD 1 TO K", f"             IF {cond} DISPLAY 'L' K GO TO {to}", "             END-IF END-PERFORM MOVE 0 TO K."]
                else:
                    out += ["           EVALUATE J WHEN 1 ADD 2 TO J WHEN 2", f"             GO TO {to} WHEN OTHER ADD 1 TO J", "             END-EVALUATE DISPLAY 'E' J."]
        return DATA + "\n".join(out) + "\n"

    seen = 0
    for seed in range(150):
        source = program(seed)
        tree = interpret.without_gotos(cobol.parse(source))
        assert not any(n.type == "GOTO" for _, _, _, n in cobol.walk(tree))
        got = [d for _, _, t, d in interpret.Machine(tree, 3000).run().trace if t == "DISPLAY"]
        assert got == shown(source)
        seen += len(got)
    assert seen > 500


def test_breakpoints_and_endless_runs_are_in_the_trace():
    machine = interpret.Machine(cobol.parse(DATA + "       A. MOVE 5 TO I.\n       B. GO TO B.\n"), 20, frozenset({"B"})).run()
    assert [t for _, _, t, _ in machine.trace].count("break") >= 1 and "I=5" in next(d for _, _, t, d in machine.trace if t == "break")
    assert machine.trace[-1][2] == "limit"


def test_expressions_in_function_notation():
    rows = interpret.ir_rows("       A. IF X > 3 AND NOT Y = 'Q' MOVE X TO Z ELSE GO TO A.\n")
    said = {k: t for _, _, k, t in rows if k in ("if", "set", "jump")}
    assert said == {"if": "and(gt(ref('X'), primitive(3)), not(eq(ref('Y'), primitive('Q'))))", "set": "set(ref('Z'), ref('X'))", "jump": "jump(loc(A))"}


def test_over_batches(spark):
    df = spark.createDataFrame([(1, "       A. GO TO A."), (2, None), (3, "")], "row_id long, text string")
    rows = cobol.rows_of(df, "row_id", "text", cobol.flow_edges, "src string, dst string, edge_type string").collect()
    assert {(r.row_id, r.edge_type) for r in rows} == {(1, "CONTAINS_CODE"), (1, "STARTS_WITH"), (1, "JUMPS_TO")}


def test_forms_of_source():
    free = ">>SOURCE FORMAT IS FREE\nA. DISPLAY 'a literal that goes on well beyond the seventy-second column of its line'. *> MOVE X\n*> MOVE Y\nEXEC SQL SELECT A -- IF 'B\nFROM T END-EXEC.\n"
    assert [n.type for n in nodes(free).values() if n.head] == ["PARAGRAPH", "DISPLAY", "EXEC_SQL"] and cobol.defects(free) == []
    assert [t.upper for t in cobol.tokens("       MOVE A-B TO C. *> NO\n000100D    DISPLAY X.\n           ADD 1 TO WS-\n      -    LONG.")][:5] == ["MOVE", "A-B", "TO", "C", "."]
