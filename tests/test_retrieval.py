"""Ranking by profiles of shared terms, against scores of every query and document."""

import random
from collections import Counter

import pytest

import __spark_entry__ as entry
from lodegraph.operators import retrieval as r
from lodegraph.session import table


def test_best_against_all_pairs(spark):
    rnd = random.Random(5)
    words = [f"W{i}" for i in range(12)]
    docs = {i: [rnd.choice(words) for _ in range(rnd.randint(0, 6))] for i in range(60)}
    queries = {f"q{i}": sorted(rnd.sample(words[:9], rnd.randint(0, 3))) for i in range(12)} | {"own": ["W9", "W1"], "only": ["W10"], "none": []}
    weight = {(d, t): n * (1 + int(t[1:]) % 3) / 4 for d, ts in docs.items() for t, n in Counter(ts).items()}
    weighted = spark.createDataFrame([(d, t, w) for (d, t), w in weight.items()], "id int, term string, weight double")
    q = spark.createDataFrame([(k, " ".join(ts)) for k, ts in queries.items()], "q string, text string")
    got = {(x.q, x["rank"]): (x.id, x.score) for x in r.best(weighted, q, "q", "text", "id", 4).collect()}
    want = {}
    for k, ts in queries.items():
        score = {d: sum(weight.get((d, t), 0) for t in ts) for d in docs if any((d, t) in weight for t in ts)}
        want |= {(k, i + 1): x for i, x in enumerate(sorted(score.items(), key=lambda x: (-x[1], x[0]))[:4])}
    assert got == want


@pytest.fixture(scope="module")
def many(spark, sf, tmp_path_factory):
    """1,500 programs and documents that all share their words: too many pairs to build, few rows to return."""
    out, n = tmp_path_factory.mktemp("many"), 1500

    def write(name, rows):
        schema = table(spark, sf, name).schema
        spark.createDataFrame([tuple(x.get(f.name) for f in schema) for x in rows], schema).repartition(1).write.parquet(f"{out}/{name}.parquet")

    write("program_catalog", [{"program": f"PGM{i:04}", "app_domain": "cards", "source_kind": "jcl" if i % 2 else "cobol"} for i in range(n)])
    write("documents", [{"doc_id": i, "program": f"PGM{i:04}", "text": f"summary batch cards PGM{i:04}"} for i in range(n)])
    write("code_node", [{"row_id": 1, "id": "a", "program": "PGM0000", "metadata": '{"cics_target_program": "PGM0001"}'}])
    return str(out)


def test_reranked_documents_of_many_programs(spark, many):
    rows = entry.queries()["rerank_proximity"](spark, many).collect()
    best = {x.qid: x for x in sorted(rows, key=lambda x: x.adjusted)}
    assert len(rows) == 5 * 1500 and all(x.doc_id == int(q[3:]) for q, x in best.items())
    of = {(x.qid, x.doc_id): x.adjusted for x in rows}
    assert of["PGM0001", 0] == pytest.approx(1.3 * of["PGM0001", 2], abs=1e-5) and of["PGM0000", 1] == pytest.approx(1.2 * of["PGM0000", 2], abs=1e-5)


def test_recall_of_many_programs(spark, many):
    rows = entry.queries()["retrieval_recall_mrr"](spark, many).collect()
    assert sorted(tuple(x) for x in rows) == [("cobol", 750, 1.0, 1.0, 1.0), ("jcl", 750, 1.0, 1.0, 1.0)]


def test_judged_queries_of_many_programs(spark, many):
    rows = entry.queries()["retrieval_judged"](spark, many).collect()
    assert len(rows) == 1500 and all(x.hit_1 and x.hit_5 and x.reciprocal_rank == 1 for x in rows)


@pytest.mark.parametrize("few", [0, 1, 3, 32])
def test_best_with_terms_of_a_few_queries(spark, few):
    rnd = random.Random(6)
    words = [f"W{i}" for i in range(12)]
    docs = {i: [rnd.choice(words) for _ in range(rnd.randint(0, 6))] for i in range(60)}
    queries = {f"q{i}": sorted({"W0", *rnd.sample(words[:9], rnd.randint(0, 3))}) for i in range(20)} | {"own": ["W9", "W1"], "none": []}
    weight = {(d, t): n * (1 + int(t[1:]) % 3) / 4 for d, ts in docs.items() for t, n in Counter(ts).items()}
    weighted = spark.createDataFrame([(d, t, w) for (d, t), w in weight.items()], "id int, term string, weight double")
    q = spark.createDataFrame([(k, " ".join(ts)) for k, ts in queries.items()], "q string, text string")
    got = {(x.q, x["rank"]): (x.id, x.score) for x in r.best(weighted, q, "q", "text", "id", 4, few).collect()}
    want = {}
    for k, ts in queries.items():
        score = {d: sum(weight.get((d, t), 0) for t in ts) for d in docs if any((d, t) in weight for t in ts)}
        want |= {(k, i + 1): x for i, x in enumerate(sorted(score.items(), key=lambda x: (-x[1], x[0]))[:4])}
    assert got == want


def test_queries_that_share_a_name_make_no_profile_of_it(spark):
    """Programs of five sites: each name is a term of five queries, all of which have two words in common."""
    q = spark.createDataFrame([(f"PGM{i:03}.{k}", f"PGM{i:03}.{k} summary batch") for i in range(100) for k in range(5)], "q string, text string")
    _, of = r.profiled(q, "q", "text")
    assert [tuple(x) for x in of.groupBy("_profile").count().collect()] == [("BATCH SUMMARY", 500)]


def test_queries_of_equal_terms_are_ranked_once(spark, monkeypatch):
    """40 copies of 50 programs: a name is a term of 40 queries, but of one set of terms, so it makes no profile."""
    q = spark.createDataFrame([(f"P{i:02}.{k}", f"P{i:02}.{k} summary batch") for i in range(50) for k in range(40)], "q string, text string")
    weighted = spark.createDataFrame([(d, t, 1.0) for d in range(50) for t in ("SUMMARY", "BATCH", f"P{d:02}")], "id int, term string, weight double")
    profiles, profiled = [], r.profiled

    def seen(*args):
        q, of = profiled(*args)
        profiles.extend(x["_profile"] for x in of.select("_profile").distinct().collect())
        return q, of

    monkeypatch.setattr(r, "profiled", seen)
    rows = r.best(weighted, q, "q", "text", "id", 2).collect()
    assert profiles == ["BATCH SUMMARY"]
    assert {(x.q, x["rank"]): (x.id, x.score) for x in rows} == {(f"P{i:02}.{k}", n + 1): ((i, 3.0), (int(i == 0), 2.0))[n] for i in range(50) for k in range(40) for n in range(2)}


def test_postings_of_the_terms_looked_for(spark, monkeypatch):
    """A bitmap of one word leaves terms that were not looked for; the counts are those of all postings."""
    docs = spark.createDataFrame([(1, "Pay pay PAY-1 straße 9abc ab"), (2, ""), (3, "x yy YY zz"), (4, "pay " * 500 + "other")], "id int, text string")
    only = spark.createDataFrame([("PAY",), ("YY",), ("ABC",), ("NONE",)], "term string")
    every = {tuple(x) for x in r.postings(docs, "id", "text").filter("term in ('PAY', 'YY', 'ABC')").collect()}
    for words in (1, r.MARK_WORDS):
        monkeypatch.setattr(r, "MARK_WORDS", words)
        assert {tuple(x) for x in r.postings(docs, "id", "text", only=only).collect()} == every
    assert (4, "PAY", 500, 501) in every and (1, "PAY", 2, 6) in every


def test_terms_not_looked_for_are_dropped_before_a_shuffle(spark):
    docs = spark.createDataFrame([(i, f"w{i}") for i in range(1000)], "id int, term string")
    left = {x.id for x in r.marked(docs, "term", docs.filter("id < 10").select("term")).collect()}
    assert set(range(10)) <= left and len(left) < 15
