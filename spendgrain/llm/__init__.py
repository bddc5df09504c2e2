"""Operators for preparing training data: URLs, secrets, duplicates, chats, benchmarks, mixing, scoring, quality, language."""
