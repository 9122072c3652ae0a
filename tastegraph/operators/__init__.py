"""Relational operators of the engine: pair self-join, similarities, ranking, prediction."""
