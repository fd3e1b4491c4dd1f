import pytest
from pyspark.sql import functions as F

from lodegraph.functions import cics, jcl, records, text
from lodegraph.functions import statements as st


def one(spark, c, value=None):
    return spark.createDataFrame([(value,)], "v string").select(c.alias("x")).first().x


@pytest.mark.parametrize("value,want", [("12.34", "1234"), ("512.34", "1234"), ("2.3", "0230"), ("4523", "2300"), (".5678", "0056"), ("678.", "7800"), (".", "0000")])
def test_decimal_alignment(spark, value, want):
    assert one(spark, records.align_decimal(F.col("v"), 2, 2), value) == want


@pytest.mark.parametrize("value,pic,want", [("4321", "S9(4)", "F4F3F2C1"), ("-4321", "S9(4)", "F4F3F2D1"), ("4321", "9(4)", "F4F3F2F1"), ("123", "9(5)", "F0F0F1F2F3")])
def test_zoned(spark, value, pic, want):
    assert one(spark, records.encode_zoned(F.col("v"), records.parse_picture(pic)), value) == want


def test_zoned_truncates_left(spark):
    p = records.parse_picture("9(5)")
    assert one(spark, records.decode_zoned(records.encode_zoned(F.col("v"), p), p), "123456") == 23456.0


@pytest.mark.parametrize("value,n,want", [("1A", 2, 20), ("1A0", 3, 200), ("2E0", 3, 340)])
def test_overflow_digits(spark, value, n, want):
    assert one(spark, records.overflow_digits(F.col("v"), n), value) == want


@pytest.mark.parametrize("pic", ["S9(3)V99", "S9(4)V99", "9(7)", "S9V9(4)"])
def test_packed_round_trip(spark, pic):
    p = records.parse_picture(pic, "COMP-3")
    for v in ("1.25", "-7.5", "0"):
        want = abs(float(v)) if not p.signed else float(v)
        got = one(spark, records.decode_packed(records.encode_packed(F.col("v"), p), p), v)
        assert got == pytest.approx(int(want * 10**p.right) / 10**p.right)


def test_text_pictures(spark):
    assert one(spark, records.adjust_text(F.col("v"), 5), "ABCDEFGH") == "ABCDE"
    assert one(spark, records.adjust_text(F.col("v"), 5), "ABC") == "ABC  "
    assert one(spark, records.to_ebcdic(F.col("v")), "A1 ") == "C1F140"
    assert one(spark, records.to_ebcdic(F.col("v"))) is None
    with pytest.raises(ValueError):
        records.parse_picture("Q9")


def test_table_bounds(spark):
    items = records.occurs(F.lit("F1F2F3"), 0, 1, 3)
    assert one(spark, records.occurrence(items, F.lit(3))) == "F3" and one(spark, records.occurrence(items, F.lit(4))) is None


@pytest.mark.parametrize("value,want", [("PAY01", True), ("ZERO", False), ("123", False), ("A", False), ("A B", False), (None, False)])
def test_program_targets(spark, value, want):
    assert one(spark, text.is_program_target("v"), value) is want


def test_names(spark):
    assert one(spark, text.program_name("v"), " pay01.cbl ") == "PAY01"
    assert one(spark, text.call_target("v"), "A-1 THROUGH A-9") == "A-1"
    assert one(spark, text.sql_tables("v"), "WITH c AS (SELECT 1) SELECT * FROM c JOIN t1 ON 1 = 1") == ["T1"]
    assert one(spark, text.json_in_text("v"), 'answer: {"a": 1} ok') == '{"a":1}'
    assert one(spark, text.integer(F.col("v")), "1,234") == 1234
    assert one(spark, text.call_using("v"), "CALL 'X' USING BY REFERENCE A B.") == ["A", "B"]
    loops = one(spark, text.perform_varying("v"), "PERFORM P THRU P-EXIT VARYING I FROM 1 BY 2 UNTIL I > 9\n AFTER J FROM I BY 1 UNTIL J = 3.")
    assert [tuple(x) for x in loops] == [("I", "1", "2", "I > 9"), ("J", "I", "1", "J = 3")]
    assert one(spark, text.perform_varying("v"), "PERFORM P UNTIL X = 1.") == []


@pytest.mark.parametrize("value,want", [("NULLFILE", "nullfile"), ("&&T", "temporary"), ("A.B(+1)", "generation"), ("A.B(M)", "member"), ("A.B", "plain")])
def test_dsn(spark, value, want):
    assert one(spark, jcl.dsn(F.col("v")), value)["kind"] == want


def test_operands(spark):
    assert one(spark, jcl.split_operand(F.col("v")), "A=(1,2),B='x,y',C") == ["A=(1,2)", "B='x,y'", "C"]
    assert one(spark, jcl.operands(F.col("v")), "A=(1,2),C") == {"A": "(1,2)", "2": "C"}
    assert one(spark, jcl.disp(F.col("v")), "(,CATLG)").asDict() == {"status": None, "normal": "CATLG", "abnormal": None, "access": "special"}
    assert one(spark, jcl.cond_text(F.col("v")), "(4,LT)") == "runs only if RC >= 4"
    assert one(spark, jcl.substitute(F.col("v"), {"A": "x", "AB": "y"}), "&AB..&A.&Z") == "y.x&Z"


def test_statements_of_a_job(spark):
    t = "//J JOB (1),\n//     CLASS=A\n//* note\n//S1 EXEC PGM=P1\n//D DD *\ndata line\n/*\n"
    rows = jcl.statements(spark.createDataFrame([(1, t), (2, None), (3, "")], "k int, t string"), "k", "t").orderBy("line_no").collect()
    assert [(r.line_no, r.kind, r.operation) for r in rows] == [(1, "statement", "JOB"), (3, "comment", None), (4, "statement", "EXEC"), (5, "statement", "DD"), (6, "data", None), (7, "delimiter", None)]
    assert rows[0].operand == "(1),CLASS=A"


def test_statement_effects(spark):
    d = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    fields = {k: F.col(k) for k in "abc"}
    out = st.apply(d, fields, [st.add(["a"], ["b", "c"]), st.move("b", "a"), st.divide("c", ["b"]), st.subtract(["a"], ["c"]), st.divide("c", ["a"])], []).first()
    assert (out.a, out.b, out.c) == (None, 1.0, 0.0)
    assert one(spark, st.number(F.col("v")), "1,5") == 1.5 and one(spark, st.number(F.col("v")), " ") == 0.0


def test_comment_blocks_part_prose_from_deactivated_code(spark):
    """Expected results of the rules' own published cases."""
    source = "\n".join(
        [
            "       IDENTIFICATION DIVISION.", "       PROGRAM-ID. TESTPROG.", "      * BEFORE ALL   ***", "      * -------", "      * EJECT", "       PROCEDURE DIVISION.",
            "      * SENDS THE SCREEN", "       SEND-MAP.", "           EXIT.", "      * OLD DATASET BROWSE", "      * BROWSE-OLD.", "      * EXEC CICS STARTBR DATASET('OLDDS')",
            "      * END-EXEC.", "       ACTIVE-PARA.", "           EXIT.", "      * LOST", "           MOVE A TO B.", "       LAST-PARA.",
        ]
    )
    rows = spark.createDataFrame([(source,), (None,), ("",)], "v string").select(F.inline(text.comment_blocks(F.col("v")))).withColumn("code", text.is_commented_out(F.col("lines"))).collect()
    assert [(r.target, r.line_start, r.line_end, r.lines, r.code) for r in rows] == [
        ("_PROGRAM_SUMMARY", 3, 3, ["BEFORE ALL"], False),
        ("SEND-MAP", 7, 7, ["SENDS THE SCREEN"], False),
        ("ACTIVE-PARA", 10, 13, ["OLD DATASET BROWSE", "BROWSE-OLD.", "EXEC CICS STARTBR DATASET('OLDDS')", "END-EXEC."], True),
    ]
    block = lambda *x: one(spark, text.is_commented_out(F.split("v", "\n")), "\n".join(x))
    assert block("OLD.", "MOVE 'X' TO FIELD-A.", "EXEC CICS LINK PROGRAM('OLDPGM') END-EXEC.") and block("old-para.", "exec sql commit")
    assert not block("Moves the row", "to the next page") and not block("start of day", "prose", "more prose", "rest")


def test_markers_of_the_network_database(spark):
    for marked in ("BIND RUN-UNIT", "IDMS-STATUS", "OBTAIN FIRST X", "obtain owner", "READY USAGE-MODE IS UPDATE"):
        assert one(spark, text.dialect(F.col("v")), f"x {marked} y") == "IDMS"
    assert one(spark, text.dialect(F.col("v")), "EXEC CICS LINK") == "COBOL"


def test_data_definition_operands(spark):
    """Expected results of the operands' own published cases."""
    v = F.col("v")
    assert one(spark, jcl.vol(v), "SER=(VOL1,VOL2,VOL3)").ser == ["VOL1", "VOL2", "VOL3"] and one(spark, jcl.vol(v), "REF=*.PREVDD").ref == "PREVDD" and one(spark, jcl.vol(v), "(PRIVATE,SER=A)").is_private
    assert tuple(one(spark, jcl.disp(v), "(NEW,UNCATLG,DELETE)")) == ("NEW", "UNCATLG", "DELETE", "write") and tuple(one(spark, jcl.disp(v), "(,CATLG)")) == (None, "CATLG", None, "special")
    assert tuple(one(spark, jcl.disp(v), "MOD")) == ("MOD", None, None, "append")
    assert tuple(one(spark, jcl.space(v), "(CYL,(5,1),RLSE,CONTIG)")) == ("CYL", "5", "1", True, True, False) and tuple(one(spark, jcl.space(v), "(TRK,5)")) == ("TRK", "5", None, False, False, False)
    assert one(spark, jcl.dcb(v), "(RECFM=FB,LRECL=80,BLKSIZE=32720)").parameters == {"recfm": "FB", "lrecl": "80", "blksize": "32720"} and one(spark, jcl.dcb(v), "*.S1.DD1").backreference == "S1.DD1"
    assert tuple(one(spark, jcl.cond(v), "((4,LT),EVEN)")) == ("((4,LT))", "EVEN") and tuple(one(spark, jcl.cond(v), "ONLY")) == (None, "ONLY")
    dd = one(spark, jcl.dd_fields(F.lit("SYSOUT"), v), "SYSOUT=(,),OUTPUT=(*.MYOUT)")
    assert dd.role == "system_output" and dd.outputs == ["MYOUT"] and dd.dsn is None
    dd = one(spark, jcl.dd_fields(F.lit("X"), v), "DSN='A.B(+1)',DISP=SHR")
    assert (dd.dsn.kind, dd.dsn.base, dd.disp.access, dd.role) == ("generation", "A.B", "read", None)


def test_cics_statements_and_their_facts(spark):
    source = "\n".join(
        [
            "000100 A.", "000200     EXEC CICS SEND MAP('M1') MAPSET(WS-SET)", "000300       RESP(WS-R) END-EXEC. EXEC CICS RETURN TRANSID('T1') END-EXEC",
            "000400*    EXEC CICS READ FILE('F')", "000500*      INTO(X).", "000600     EXEC CICS HANDLE CONDITION NOTFND(NF) ERROR END-EXEC.",
            "000700     EXEC CICS HANDLE ABEND LABEL(AB) END-EXEC EXEC CICS IGNORE CONDITION LENGERR END-EXEC EXEC CICS XCTL PROGRAM(WS-PGM) END-EXEC",
        ]
    )
    found = one(spark, cics.statements(F.col("v")), source)
    assert [(s.line, s.active) for s in found] == [(2, True), (3, True), (6, True), (7, True), (7, True), (7, True), (4, False)]
    assert found[0].text == "EXEC CICS SEND MAP('M1') MAPSET(WS-SET) RESP(WS-R)" and found[-1].text == "EXEC CICS READ FILE('F') INTO(X)"
    texts = [s.text for s in found]
    assert [one(spark, cics.command(F.col("v")), t) for t in texts] == ["SEND", "RETURN", "HANDLE", "HANDLE", "IGNORE", "XCTL", "READ"]
    assert tuple(one(spark, cics.target(F.col("v")), texts[5])) == ("PROGRAM", "WS-PGM", "identifier") and tuple(one(spark, cics.target(F.col("v")), texts[0])) == ("MAP", "M1", "literal")
    assert [tuple(r) for r in one(spark, cics.resources(F.col("v")), texts[0])] == [("MAP", "M1", "literal"), ("MAPSET", "WS-SET", "identifier")]
    handled = [tuple(h) for t in texts for h in one(spark, cics.handlers(F.col("v")), t)]
    assert handled == [("RESPONSE_CAPTURE", "RESP", "WS-R", "capture"), ("CONDITION", "NOTFND", "NF", "set"), ("CONDITION", "ERROR", None, "reset"), ("ABEND", "LABEL", "AB", "set"), ("IGNORE CONDITION", "LENGERR", None, "ignore")]
    assert one(spark, cics.statements(F.col("v")), None) is None and one(spark, cics.statements(F.col("v")), "") == []
