"""Corpus preparation for training data: ten operators over documents, pages and conversations.

Nothing outside this subpackage imports it; its queries are in :mod:`silverbrook.llm.queries`.
"""
