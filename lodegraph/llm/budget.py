"""Token budget of a corpus by program, language, domain and chunk type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodegraph.llm import tokens

UNKNOWN = "unknown"


def _slice(c: str, fold: str) -> Column:
    v = F.trim(F.col(c))
    v = F.upper(v) if fold == "upper" else F.lower(v)
    return F.coalesce(F.when(v != "", v), F.lit(UNKNOWN))


def chunk_tokens(chunks: DataFrame, path: str | None = None) -> DataFrame:
    """(row_id, program, chunk_type, n_tokens, has_text): exact counts. Null and empty texts have 0."""
    rows = chunks.select("row_id", _slice("program", "upper").alias("program"), _slice("chunk_type", "lower").alias("chunk_type"), F.col("text").isNotNull().alias("has_text"), "text")
    return tokens.with_counts(rows, "text", ["row_id", "program", "chunk_type", "has_text"], path)


def token_budget(chunks: DataFrame, catalog: DataFrame, types: DataFrame, path: str | None = None) -> DataFrame:
    """(program, language, app_domain, chunk_type, n_chunks, n_null_texts, n_tokens, max_tokens).

    Every row of `chunks` is counted in exactly one slice. Programs, languages, domains and types are
    compared without letter case and outer blanks; what is null, blank or in neither reference table is
    `unknown`. Language and domain are the program's. Totals per program and type are made before the
    catalogue is joined, so a program that holds much of the corpus is one small row by then."""
    per = (
        chunk_tokens(chunks, path)
        .groupBy("program", "chunk_type")
        .agg(F.count(F.lit(1)).alias("n_chunks"), F.count_if(~F.col("has_text")).alias("n_null_texts"), F.sum("n_tokens").alias("n_tokens"), F.max("n_tokens").alias("max_tokens"))
    )
    programs = catalog.groupBy(_slice("program", "upper").alias("program")).agg(F.min(_slice("house_lang", "lower")).alias("language"), F.min(_slice("app_domain", "lower")).alias("app_domain"))
    known = types.select(_slice("chunk_type", "lower").alias("chunk_type"), F.lit(True).alias("known")).distinct()
    return (
        per.join(programs, "program", "left")
        .join(known, "chunk_type", "left")
        .groupBy(
            F.when(F.col("language").isNotNull(), F.col("program")).otherwise(UNKNOWN).alias("program"),
            F.coalesce("language", F.lit(UNKNOWN)).alias("language"),
            F.coalesce("app_domain", F.lit(UNKNOWN)).alias("app_domain"),
            F.when(F.col("known"), F.col("chunk_type")).otherwise(UNKNOWN).alias("chunk_type"),
        )
        .agg(F.sum("n_chunks").alias("n_chunks"), F.sum("n_null_texts").alias("n_null_texts"), F.sum("n_tokens").alias("n_tokens"), F.max("max_tokens").alias("max_tokens"))
    )
