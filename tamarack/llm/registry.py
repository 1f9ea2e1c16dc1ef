"""The queries of this subpackage by name, and the SQL that DuckDB can hold them against."""

from __future__ import annotations

from . import automaton, bpe, chunks, codes, decontaminate, licenses, lines, oracle, quality, search, simhash, suffixes, token_files, warc

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_substring_dedup": chunks.op3_substring_dedup,
    "op4_line_dedup": lines.op4_line_dedup,
    "op5_suffix_dedup": suffixes.op5_suffix_dedup,
    "op6_token_files": token_files.op6_token_files,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_byte_bpe": bpe.op8_byte_bpe,
    "op9_warc": warc.op9_warc,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op11_bpe_automaton": automaton.op11_bpe_automaton,
    "op12_lexical_search": search.op12_lexical_search,
    "op13_vector_codes": codes.op13_vector_codes,
}
ORACLE_SQL: dict[str, str] = {
    "op5_suffix_dedup": oracle.OP5,
    "op9_warc": oracle.OP9,
    "op10_decontamination": oracle.OP10,
    "op12_lexical_search": search.SQL,
    "op13_vector_codes": codes.SQL,
}
