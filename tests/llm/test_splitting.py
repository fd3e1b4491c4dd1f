import random
import re

import numpy as np
import pytest

from lodegraph.llm import splitting

WORD = re.compile(r"[^ \t\r\n]+")


def greedy(strength, limit, overlap):
    """Cuts one after the other."""
    n, reach, at, out = len(strength), limit - overlap, overlap, []
    while True:
        if at + reach >= n:
            return [*out, n]
        hi, cut = at + reach, None
        for level, lo in ((splitting.STATEMENT, at + reach // 2), (splitting.LINE, at)):
            fit = [p for p in range(lo + 1, hi + 1) if strength[p - 1] >= level]
            if fit:
                cut = fit[-1]
                break
        at = cut or hi
        out.append(at)


@pytest.mark.parametrize("seed", range(25))
def test_doubling_equals_one_by_one(seed):
    rnd = random.Random(seed)
    texts = []
    for _ in range(6):
        p = rnd.choice([0.0, 0.001, 0.02, 0.3])
        texts.append(np.array([rnd.choice([2, 3]) if rnd.random() < p else 0 for _ in range(rnd.randint(513, 6000))], dtype=np.int8))
    for s, (at, _) in zip(texts, splitting.cuts(texts, 512, 50)):
        assert at.tolist() == greedy(s, 512, 50)


def check(text, pieces, limit, overlap):
    words = WORD.findall(text)
    pieces.sort(key=lambda r: r.piece_no)
    back = ""
    for i, r in enumerate(pieces):
        own = WORD.findall(r.text)
        assert own == words[r.start_word : r.end_word] and len(own) <= limit and r.n_pieces == len(pieces)
        if i:
            assert r.start_word == pieces[i - 1].end_word - overlap == r.new_from - overlap
        back += r.text if i == 0 else r.text[[m.start() for m in WORD.finditer(r.text)][overlap] :] if overlap else r.text
    assert pieces[-1].end_word == len(words) and back == text


def test_pieces(spark):
    code = "\r\n".join(f"{i:06} {'  ' * (i % 3)}MOVE A{i} TO B{i}{'.' if i % 4 == 0 else ''}" if i % 5 else f"{i:06}-    'rest of {i}'" for i in range(1, 900))
    prose = " ".join(f"word{i}{'.' if i % 17 == 0 else ''}" for i in range(4000)) + "\n\n"
    jcl = "\n".join(f"//S{i} EXEC PGM=P{i}\n//    PARM='x'" for i in range(600))
    solid = "x " * 1300
    texts = {1: code, 2: prose, 3: jcl, 4: solid, 5: None, 6: "", 7: "w " * 512, 8: " " + "w w\t" * 513, 9: "é😀 " * 700}
    kinds = {1: " PARAGRAPH_LOGIC", 2: "comments", 3: "step_detail", 4: None, 8: "workflow"}
    df = spark.createDataFrame([(k, t, kinds.get(k, "x"), 1, "t") for k, t in texts.items()], "row_id long, text string, chunk_type string, k int, t string")
    got = {}
    for r in splitting.pieces(df, "row_id", "text", "chunk_type").collect():
        got.setdefault(r.row_id, []).append(r)
    assert sorted(got) == [1, 2, 3, 4, 8, 9]
    for k, rows in got.items():
        check(texts[k], rows, 512, 50)
    for r in got[1][:-1]:
        following = texts[1].split("\r\n")
        assert r.cut_kind in ("statement", "line") and r.text.endswith("\r\n0") is False and following
    assert {r.cut_kind for r in got[2][:-1]} == {"statement"} and all(r.text.rstrip().endswith(".") for r in got[2][:-1])
    assert {r.cut_kind for r in got[4][:-1]} == {"word"}
    assert all(r.text.rstrip().endswith("'x'") for r in got[3][:-1])
    assert splitting.pieces(df.filter("false"), "row_id", "text", "chunk_type").count() == 0


def test_continuation_is_no_boundary():
    text = "000100 MOVE 'a\n000200-    'b' TO C\n000300 EXIT."
    chars, first, end = splitting.word_spans(text)
    strength = splitting.boundaries(chars, first, end, "paragraph_logic")
    cut_after = [text[a:b] for a, b, s in zip(first, end, strength) if s]
    assert cut_after == ["C"]


def test_no_overlap_and_bad_parameters(spark):
    df = spark.createDataFrame([(1, "a b c d e f g", "x")], "row_id long, text string, chunk_type string")
    rows = splitting.pieces(df, "row_id", "text", "chunk_type", 3, 0).collect()
    check("a b c d e f g", rows, 3, 0)
    with pytest.raises(ValueError):
        splitting.pieces(df, "row_id", "text", "chunk_type", 5, 5)
