"""Retrieval over documents: terms, postings, TF-IDF and BM25 ranking, reranking, evaluation.

Queries are a table; their terms are joined to the postings, so a term of the corpus that no query has is
never shuffled for scoring, and terms that many queries share are summed once for all of them. Ranking keeps the first k per query with a group limit before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodegraph.session import cut

#: Terms of the evaluator and of the index, and the parameters of Okapi BM25.
QUERY_TERM, INDEX_TERM = "[A-Za-z][A-Za-z0-9_-]{1,}", "[A-Za-z][A-Za-z0-9_-]{2,}"
K1, B = 1.2, 0.75
#: Multipliers of a chunk of the query's own program, of one that calls it, of one it calls.
SAME, CALLED_BY, CALLS = 2.0, 1.3, 1.2


def terms(text: str | Column, pattern: str = QUERY_TERM) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), F.upper)


def query_terms(queries: DataFrame, query: str, text: str) -> DataFrame:
    """(query, term), distinct."""
    return queries.select(query, F.explode(F.array_distinct(terms(text))).alias("term"))


def postings(docs: DataFrame, key: str, text: str, pattern: str = QUERY_TERM, only: DataFrame | None = None) -> DataFrame:
    """(key, term, tf, n_terms): one row per document and term.

    only: a table of terms; others are dropped before anything is shuffled, and since ranking reads the
    rest twice, it is cut from its lineage."""
    if only is not None:
        d = docs.select(key, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("_t"))
        d = d.select(key, "_t", F.size("_t").alias("n_terms"), F.explode(F.array_distinct("_t")).alias("_w")).withColumn("term", F.upper("_w"))
        d = marked(d, "term", only.select("term").distinct())
        d = d.select(key, "term", "n_terms", (F.size("_t") - F.size(F.array_remove("_t", F.col("_w")))).alias("tf"))
        kept = d.join(only.select("term").distinct(), "term", "left_semi")
        return cut(kept.groupBy(key, "term").agg(F.sum("tf").alias("tf"), F.first("n_terms").alias("n_terms")))
    d = docs.select(key, terms(text, pattern).alias("_t"))
    d = d.select(key, F.size("_t").alias("n_terms"), F.explode("_t").alias("term"))
    return d.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"), F.first("n_terms").alias("n_terms"))


#: Words of 64 bits in the bitmap of the terms that are looked for: 512 KB for any number of terms.
MARK_WORDS = 1 << 16


def marked(rows: DataFrame, column: str, only: DataFrame) -> DataFrame:
    """Rows whose value may be one of `only`, by a bitmap of hashes: all that are, and few others."""
    at = F.pmod(F.xxhash64(column), F.lit(64 * MARK_WORDS))
    bit, word = (at % 64).cast("int"), F.floor(at / 64).cast("int")
    held = only.select(word.alias("id"), F.expr(f"shiftleft(1L, int(pmod(xxhash64({column}), 64)))").alias("bits")).groupBy("id").agg(F.bit_or("bits").alias("bits"))
    dense = only.sparkSession.range(MARK_WORDS).join(held, "id", "left").select("id", F.coalesce("bits", F.lit(0)).alias("bits"))
    bitmap = dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "bits"))), lambda x: x["bits"]).alias("_bitmap"))
    return rows.filter(F.getbit(F.get(bitmap.scalar(), word), bit) == 1)


def document_frequency(post: DataFrame) -> DataFrame:
    return post.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def index_statistics(docs: DataFrame, text: str, pattern: str = INDEX_TERM) -> DataFrame:
    n = F.size(terms(text, pattern))
    return docs.select(n.alias("n")).agg(F.count(F.lit(1)).alias("total_chunks"), F.round(F.avg("n"), 1).alias("avg_doc_length"))


def tf_idf(post: DataFrame, key: str, docs: DataFrame) -> DataFrame:
    """(key, term, weight): tf (ln((1 + N) / (1 + df)) + 1)."""
    m = post.join(document_frequency(post), "term").withColumn("n_docs", _count(docs))
    return m.select(key, "term", (F.col("tf") * (F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1)).alias("weight"))


def bm25(post: DataFrame, key: str, docs: DataFrame, length: DataFrame) -> DataFrame:
    """(key, term, weight) by Okapi BM25; length: one row with avg_len."""
    m = post.join(document_frequency(post), "term").withColumn("n_docs", _count(docs)).withColumn("avg_len", length.scalar())
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    s = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("n_terms") / F.col("avg_len")))
    return m.select(key, "term", s.alias("weight"))


def _count(docs: DataFrame) -> Column:
    return docs.agg(F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()


#: Queries that a term may have to be scored for each of them; a term of more queries is scored for their profiles.
FEW_QUERIES = 32


def profiled(queries: DataFrame, query: str, text: str, few: int = FEW_QUERIES) -> tuple[DataFrame, DataFrame]:
    """(query, term, _many) of all terms, _many for those of more than `few` queries, and (query, _profile), the latter of each query."""
    q = query_terms(queries, query, text).distinct()
    q = q.join(q.groupBy("term").agg((F.count(F.lit(1)) > few).alias("_many")), "term")
    profile = F.array_join(F.array_sort(F.collect_list(F.when(F.col("_many"), F.col("term")))), " ")
    return q, cut(q.groupBy(query).agg(profile.alias("_profile")))


def best(weighted: DataFrame, queries: DataFrame, query: str, text: str, key: str, k: int, few: int = FEW_QUERIES) -> DataFrame:
    """(query, key, score, rank): the k best keys of each query by the sum of the weights of its terms.

    weighted: key, term, weight, none below zero. Queries with the same terms are ranked as one query. Queries
    with the same terms among those that more than `few` of these have are one profile. Documents are scored once per profile, and per query only where they
    hold one of its other terms: another document can be among the k best of a query only if it is among
    those of its profile, as other terms never lower a score. Pairs of every query with every document are
    not built, and terms that a few queries share make no profiles."""
    sets = query_terms(queries, query, text).distinct().groupBy(query).agg(F.array_join(F.array_sort(F.collect_list("term")), " ").alias("_set"))
    sets = cut(sets)
    q, of = profiled(sets.select("_set").distinct(), "_set", "_set", few)
    terms_of = of.select("_profile").distinct().select("_profile", F.explode(F.split("_profile", " ")).alias("term"))
    common = cut(terms_of.join(weighted, "term").groupBy("_profile", key).agg(F.sum("weight").alias("score")))
    own = q.filter("not _many").join(weighted, "term").groupBy("_set", key).agg(F.sum("weight").alias("_own"))
    held = own.join(of, "_set").join(common, ["_profile", key], "left").select("_set", key, (F.col("_own") + F.coalesce("score", F.lit(0.0))).alias("score"))
    led = top_k(common, "_profile", key, k).join(of, "_profile").select("_set", key, "score")
    ranked = top_k(held.unionByName(led).groupBy("_set", key).agg(F.max("score").alias("score")), "_set", key, k)
    return ranked.join(sets, "_set").select(query, key, "score", "rank")


def top_k(scored: DataFrame, query: str, key: str, k: int, score: str = "score") -> DataFrame:
    """The k best of each query, ties by key, with rank from 1. Scores are compared to 9 digits, as the
    order of summation differs between runs."""
    w = Window.partitionBy(query).orderBy(F.desc(F.round(score, 9)), key)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def judge(ranked: DataFrame, hits: DataFrame, queries: DataFrame, query: str, key: str) -> DataFrame:
    """(query, hit_1, hit_5, reciprocal_rank): where the first ranked document stands that is a hit."""
    first = ranked.join(hits.select(query, key).distinct(), [query, key]).groupBy(query).agg(F.min("rank").alias("r"))
    q = queries.select(query).distinct().join(first, query, "left")
    return q.select(query, F.coalesce(F.col("r") == 1, F.lit(False)).alias("hit_1"), F.coalesce(F.col("r") <= 5, F.lit(False)).alias("hit_5"), F.coalesce(1.0 / F.col("r"), F.lit(0.0)).alias("reciprocal_rank"))


def summary(judged: DataFrame, *by: str) -> DataFrame:
    return judged.groupBy(*by).agg(F.count(F.lit(1)).alias("n_queries"), F.avg(F.col("hit_1").cast("int")).alias("recall_1"), F.avg(F.col("hit_5").cast("int")).alias("recall_5"), F.round(F.avg("reciprocal_rank"), 4).alias("mrr"))


def rerank(ranked: DataFrame, target: DataFrame, calls: DataFrame, query: str, key: str) -> DataFrame:
    """Scores multiplied by how a document's program stands to the query's target program.

    ranked: query, key, program, score. target: query, target (null where none is known: scores stay).
    calls: source, target, distinct."""
    c = calls.select(F.col("source").alias("s"), F.col("target").alias("t")).distinct()
    r = ranked.join(target, query, "left")
    up = c.withColumnsRenamed({"s": "program", "t": "target"}).withColumn("up", F.lit(True))
    down = c.withColumnsRenamed({"t": "program", "s": "target"}).withColumn("down", F.lit(True))
    r = r.join(up, ["program", "target"], "left").join(down, ["program", "target"], "left")
    factor = F.when(F.col("program") == F.col("target"), SAME).when(F.col("up"), CALLED_BY).when(F.col("down"), CALLS).otherwise(1.0)
    return r.withColumn("adjusted", F.col("score") * factor).select(query, key, "program", "score", "adjusted")


def contains_fact(text: Column, fact: Column) -> Column:
    """Whether upper-case text holds the fact with no identifier character right before or behind it."""
    quoted = F.concat(F.lit("(?<![A-Z0-9_-])\\Q"), fact, F.lit("\\E(?![A-Z0-9_-])"))
    return F.regexp(F.upper(text), quoted)


#: What in a narrative shows that a node type was told, and the types that branch.
TYPE_MARKERS = {
    "GOTO": ("GO TO",), "GO_TO": ("GO TO",), "PERFORM": ("PERFORM",), "EVALUATE": ("EVALUATE BLOCK", "### EVALUATE"), "EVALUATE_BRANCH": ("WHEN",), "IF": ("DECISION POINT", "**CONDITION:**"),
    "IF_BRANCH": ("DECISION POINT", "**CONDITION:**"), "SEARCH": ("SEARCH",), "DIALECT": ("CICS",), "EXEC_CICS": ("CICS",), "EXEC_SQL": ("SQL",), "READ": ("READ",), "WRITE": ("WRITE",), "OPEN": ("OPEN",),
    "CLOSE": ("CLOSE",), "REWRITE": ("REWRITE",), "DELETE": ("DELETE",), "START": ("START",), "RETURN": ("RETURN",), "STOP": ("STOP",), "STOP_RUN": ("STOP RUN",), "GOBACK": ("GOBACK",), "EXIT": ("EXIT",),
}
BRANCH_TYPES = ("IF", "IF_BRANCH", "EVALUATE", "EVALUATE_BRANCH", "SEARCH")
HEADING = r"(?m)^#{2,6}\s+(.+?)\s*$"
BRANCH_MARKER = r"(?im)^(?:#{2,6}\s+(?:Decision Point|EVALUATE Block|EVALUATE)\b|\s*-\s+\*\*WHEN\*\*|\s*\*\*Condition:\*\*)"
#: Weights of headings, statements and branches in the coverage of a narrative.
COVERAGE_WEIGHTS = {"headings": 0.50, "statements": 0.40, "branches": 0.10}


def narrative_coverage(nodes: DataFrame, narratives: DataFrame) -> DataFrame:
    """(program, headings, statements, branches, composite): percentages of what a program's narratives tell.

    nodes: program, name, type; narratives: program, text. A program may have many narratives: each is
    read for itself, and what it tells is united. A part without anything to tell is null and left out of
    the composite, which is 0 without any part."""
    from lodegraph.operators.corpus import weighted_mean

    fact = lambda c: F.upper(F.trim(F.regexp_replace(c, r"\s+", " ")))
    n = nodes.select("program", fact(F.col("name")).alias("name"), fact(F.col("type")).alias("type"))
    said = F.upper("text")
    told = narratives.filter("text is not null").select("program", said.alias("said"), "text")
    headings = told.select("program", F.explode(F.array_distinct(F.regexp_extract_all("said", F.lit(HEADING), F.lit(1)))).alias("name")).distinct()
    marked = F.array_compact(F.array(*[F.when(F.greatest(*[F.contains("said", F.lit(m)) for m in (*ms, ms[0])]), t) for t, ms in TYPE_MARKERS.items()]))
    types = told.select("program", F.explode(marked).alias("type")).distinct()
    branches = told.groupBy("program").agg(F.sum(F.regexp_count("text", F.lit(BRANCH_MARKER))).alias("marks"))
    share = lambda df, key, other: df.join(other.withColumn("_t", F.lit(1)), ["program", key], "left").groupBy("program").agg(F.round(F.count("_t") / F.count(F.lit(1)) * 100, 2).alias("pct"))
    p = share(n.filter("type = 'PARAGRAPH'").select("program", "name").distinct(), "name", headings).withColumnRenamed("pct", "headings")
    s = share(n.filter(F.col("type").isin(*TYPE_MARKERS)).select("program", "type").distinct(), "type", types).withColumnRenamed("pct", "statements")
    expected = n.filter(F.col("type").isin(*BRANCH_TYPES)).groupBy("program").agg(F.count(F.lit(1)).alias("n"))
    b = expected.join(branches, "program", "left").select("program", F.round(F.least("n", F.coalesce("marks", F.lit(0))) / F.col("n") * 100, 2).alias("branches"))
    every = n.select("program").distinct().join(p, "program", "left").join(s, "program", "left").join(b, "program", "left")
    return every.withColumn("composite", F.round(F.coalesce(weighted_mean(COVERAGE_WEIGHTS), F.lit(0.0)), 2))
