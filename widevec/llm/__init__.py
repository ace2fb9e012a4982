"""Operators for preparing training text: sharding, token files, near-duplicates, language,
decontamination, BPE, chat logs, quality rules, page text and WARC archives."""
