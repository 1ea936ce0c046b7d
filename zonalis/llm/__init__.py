"""Operators for training-data pipelines: scoring, rules, tokenizers, chat rendering, deduplication, sharding.

Nothing else in the package imports this folder. Each module is one operator; ``queries`` applies them to the tables.
"""
