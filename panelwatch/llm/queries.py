"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelwatch.llm import (
    chat,
    decontamination,
    language,
    ledger,
    maxscore,
    mixing,
    prefixes,
    secrets,
    sharding,
    simhash,
    substrings,
    urls,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_format_chats": chat.op2_format_chats,
    "op3_url_filter": urls.op3_url_filter,
    "op4_repeated_substrings": substrings.op4_repeated_substrings,
    "op5_decontaminate": decontamination.op5_decontaminate,
    "op6_language": language.op6_language,
    "op7_top_k": maxscore.op7_top_k,
    "op8_near_duplicates": simhash.op8_near_duplicates,
    "op9_secrets": secrets.op9_secrets,
    "op10_shard_documents": sharding.op10_shard_documents,
    "op11_prefix_trie": prefixes.op11_prefix_trie,
    "op12_quality_rules": ledger.op12_quality_rules,
    "op13_whiten": whitening.op13_whiten,
}

SQL: dict[str, str] = {
    "op1_mix_sources": mixing.SQL,
    "op4_repeated_substrings": substrings.SQL,
    "op7_top_k": maxscore.SQL,
    "op11_prefix_trie": prefixes.SQL,
    "op12_quality_rules": ledger.SQL,
}
