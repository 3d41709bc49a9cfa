"""Operators for training-data corpora: near-dedup, packing, search, substring dedup, encoding, archives, quality, licences, chats."""
