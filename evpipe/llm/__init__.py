"""Operators for training-data pipelines: text, tokens, vectors and their near copies.

Nothing else in the library imports this folder. Every operator reads whole texts, leaves rows in
Spark and uses numpy inside tasks only.
"""
