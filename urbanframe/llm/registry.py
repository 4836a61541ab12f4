"""The operators' queries and the SQL of those that SQL can express."""

from urbanframe.llm import (
    chat_format,
    decontamination,
    exact_dedup,
    filter_audit,
    language_id,
    near_dedup,
    sentencepiece_codec,
    sharding,
    simhash,
    substring_dedup,
    token_store,
    url_filter,
    whitening,
)

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_sentencepiece": sentencepiece_codec.op3_sentencepiece,
    "op4_chat_format": chat_format.op4_chat_format,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_sharding": sharding.op6_sharding,
    "op7_substring_dedup": substring_dedup.op7_substring_dedup,
    "op8_decontamination": decontamination.op8_decontamination,
    "op9_near_dedup": near_dedup.op9_near_dedup,
    "op10_token_store": token_store.op10_token_store,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_simhash_dedup": simhash.op12_simhash_dedup,
    "op13_embedding_whitening": whitening.op13_embedding_whitening,
}

ORACLE_SQL = {
    "op2_url_filter": url_filter.ORACLE,
    "op4_chat_format": chat_format.ORACLE,
    "op5_exact_dedup": exact_dedup.ORACLE,
    "op6_sharding": sharding.ORACLE,
    "op7_substring_dedup": substring_dedup.ORACLE,
    "op9_near_dedup": near_dedup.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
}
