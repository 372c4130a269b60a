"""Queries of the operators for training data, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobloom.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def _descriptions(spark: SparkSession, d: str) -> DataFrame:
    from jobloom.llm.private import descriptions

    return descriptions(*(table(spark, d, t) for t in ("sources", "lever_postings", "ashby_jobs")))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    from jobloom.llm.private import found_values

    return found_values(_descriptions(spark, d)).select("row_id", "kind", "start_pos")


def p1_redacted(spark: SparkSession, d: str) -> DataFrame:
    from jobloom.llm.private import redacted

    return redacted(_descriptions(spark, d))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    from jobloom.llm.names import same_organisation

    columns = (("sources", "company"), ("boards_final", "company_name"), ("crm_companies", "Company"))
    return same_organisation([(table(spark, d, t), c) for t, c in columns])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    from jobloom.llm.incremental import redelivered

    return redelivered(table(spark, d, "sources"), table(spark, d, "greenhouse_jobs"))


def p5_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of p5_found with the confidence of each."""
    from jobloom.llm.openings import posting_rows, same_openings

    rows = posting_rows(table(spark, d, "sources"), table(spark, d, "greenhouse_jobs"), table(spark, d, "ashby_jobs"))
    return same_openings(rows, table(spark, d, "role_catalog"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_pairs(spark, d).select("row_id_a", "row_id_b")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    from jobloom.llm.canonical import TITLE_FIELDS, all_titles, map_values

    titles = all_titles({t: table(spark, d, t) for t, _ in TITLE_FIELDS})
    return map_values(titles, "row_id", "title", table(spark, d, "role_catalog"))


def p7_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The titles without an entry, with their number of rows."""
    from jobloom.llm.canonical import TITLE_FIELDS, all_titles, map_values, unmatched

    titles = all_titles({t: table(spark, d, t) for t, _ in TITLE_FIELDS})
    return unmatched(map_values(titles, "row_id", "title", table(spark, d, "role_catalog")), titles, "row_id", "title")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    from jobloom.llm.encoding import encode_texts

    return encode_texts(table(spark, d, "documents"), "doc_id", "text")


def p8_decoded(spark: SparkSession, d: str) -> DataFrame:
    """Every text encoded and decoded again; the SQL reads the texts themselves."""
    from jobloom.llm.encoding import decode_ids

    return decode_ids(p8_ids(spark, d), "doc_id", "ids")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    from jobloom.llm.leaks import leaked_items

    return leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    from jobloom.llm.quality import not_prose

    return not_prose(table(spark, d, "documents"))


def p10_stats(spark: SparkSession, d: str) -> DataFrame:
    from jobloom.llm.quality import text_statistics

    return text_statistics(table(spark, d, "documents"))


def queries() -> dict[str, Query]:
    return {"p1_found": p1_found, "p1_redacted": p1_redacted, "p2_found": p2_found, "p3_found": p3_found, "p5_found": p5_found, "p5_pairs": p5_pairs, "p7_found": p7_found, "p7_unmatched": p7_unmatched, "p8_ids": p8_ids, "p8_decoded": p8_decoded, "p9_found": p9_found, "p10_found": p10_found, "p10_stats": p10_stats}


def oracle_sql() -> dict[str, str]:
    from jobloom.llm.quality import COMMON

    common = ", ".join(f"'{w}'" for w in sorted(COMMON))
    share = "round(CASE WHEN {1} > 0 THEN {0} / {1} ELSE 0.0 END, 4)".format
    stats = (
        "SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, "
        + share("list_sum(list_transform(w, lambda x: length(x)))", "len(w)") + " AS mean_word_length, "
        + share("length(regexp_replace(t, '[\\p{L}\\p{N}\\s\\p{Z}]', '', 'g'))", "length(t)") + " AS symbol_ratio, "
        + share("len(list_filter(l, lambda x: regexp_matches(x, '[.!?:;]\\s*$')))", "len(l)") + " AS ended_lines, "
        + share(f"len(list_filter(w, lambda x: x IN ({common})))", "len(w)") + " AS common_words "
        "FROM (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w, "
        "list_filter(regexp_split_to_array(coalesce(text, ''), '\\r?\\n'), lambda x: length(trim(x)) > 0) AS l FROM documents)"
    )
    return {"p10_stats": stats, "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents"}
