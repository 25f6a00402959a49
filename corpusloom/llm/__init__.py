"""Operators for training data: scoring, deduplication, decontamination, secrets, packing, chat, archives, shards."""
