"""Readers and writers: tab-separated tables in two dialects, the corpus, and flattened node tables."""
