"""Queries of the text operators: p1, p3, p4, p7, p8 and p9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodegraph.llm import budget, codetext, langid, packing, splitting, tokens
from lodegraph.session import table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return p1_pieces(spark, sf).filter("piece_no = 0").select("row_id").distinct()


def p1_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.pieces(table(spark, sf, "chunk"), "row_id", "text", "chunk_type")


def p3_token_budget(spark: SparkSession, sf: str) -> DataFrame:
    return budget.token_budget(table(spark, sf, "chunk"), table(spark, sf, "program_catalog"), table(spark, sf, "chunk_type_ref"))


def p3_chunk_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return budget.chunk_tokens(table(spark, sf, "chunk"))


def _natural_language(spark: SparkSession, sf: str) -> DataFrame:
    chunk, types = table(spark, sf, "chunk"), table(spark, sf, "chunk_type_ref")
    strings = codetext.labelled_strings(table(spark, sf, "documents"), chunk, types, table(spark, sf, "program_catalog"))
    return codetext.natural_language(chunk, types, codetext.fitted(strings))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _natural_language(spark, sf).select("row_id", "start_line", "kind", "lang").distinct()


def p4_shares(spark: SparkSession, sf: str) -> DataFrame:
    return codetext.shares(_natural_language(spark, sf))


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.with_ids(table(spark, sf, "documents"), "text", ["doc_id"])


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    return packing.containers(table(spark, sf, "documents"), "doc_id", "text")


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    return packing.fill(p8_containers(spark, sf))


def _language_model(spark: SparkSession, sf: str) -> tuple[DataFrame, langid.Model]:
    docs = table(spark, sf, "documents")
    return docs, langid.fitted(docs, "doc_id", "text", "lang")


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    docs, model = _language_model(spark, sf)
    return langid.mislabelled(docs, "doc_id", "text", "lang", model).distinct()


def p9_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs, model = _language_model(spark, sf)
    return langid.documents(docs, "doc_id", "text", "lang", model)


QUERIES = {f.__name__: f for f in (p1_found, p1_pieces, p3_token_budget, p3_chunk_tokens, p4_found, p4_shares, p7_ids, p8_containers, p8_fill, p9_found, p9_documents)}

ORACLES = {
    "p1_found": r"SELECT row_id FROM chunk WHERE len(regexp_extract_all(text, '[^ \t\r\n]+')) > 512",
}
