"""Training-data operators: tokenizing, chat formatting, packing, WARC, scoring and deduplication."""
