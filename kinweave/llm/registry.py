"""The queries of this subpackage, one for each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from kinweave.llm import bpe, chat, contamination, html, langid, licences, media, secrets, simhash, substrings, tables

QUERIES = {
    "op1_decontaminate": contamination.op1_decontaminate,
    "op2_byte_bpe": bpe.op2_byte_bpe,
    "op3_simhash": simhash.op3_simhash,
    "op4_chat_format": chat.op4_chat_format,
    "op5_licences": licences.op5_licences,
    "op6_media": media.op6_media,
    "op7_language_id": langid.op7_language_id,
    "op8_html": html.op8_html,
    "op9_secrets": secrets.op9_secrets,
    "op10_substring_dedup": substrings.op10_substring_dedup,
}
SQL: dict[str, str] = {"op4_chat_format": chat.SQL, "op5_licences": licences.SQL, "op10_substring_dedup": substrings.SQL}


def _modest(f):
    def query(spark, sf_dir):
        tables.modest_batches(spark)
        return f(spark, sf_dir)

    return query


def queries() -> dict:
    return {name: _modest(f) for name, f in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
