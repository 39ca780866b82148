"""Operators of a training-data pipeline: deduplication, filtering, archives, chats, tokens, scores."""
