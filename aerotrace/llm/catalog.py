"""Registered queries of the training-data operators and their SQL oracles."""

from __future__ import annotations

from aerotrace.llm import align, chat, decontam, license_scan, merkle, minhash, mixing, oracles, quality, secrets, substrings, tokens, warc

QUERIES = {
    "op1_minhash_dedup": minhash.op1_minhash_dedup,
    "op2_token_counts": tokens.op2_token_counts,
    "op3_secret_scan": secrets.op3_secret_scan,
    "op4_chat_formatting": chat.op4_chat_formatting,
    "op5_license_scan": license_scan.op5_license_scan,
    "op6_decontamination": decontam.op6_decontamination,
    "op7_source_mixing": mixing.op7_source_mixing,
    "op8_repeated_substrings": substrings.op8_repeated_substrings,
    "op9_token_files": tokens.op9_token_files,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_tokenizer_alignment": align.op11_tokenizer_alignment,
    "op12_warc_archive": warc.op12_warc_archive,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

ORACLE: dict[str, str] = {
    "op1_minhash_dedup": oracles.OP1_SQL,
    "op10_quality_rules": oracles.OP10_SQL,
    "op12_warc_archive": warc.OP12_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
    "op3_secret_scan": secrets.OP3_SQL,
    "op4_chat_formatting": chat.OP4_SQL,
    "op7_source_mixing": mixing.OP7_SQL,
}
