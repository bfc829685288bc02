"""Operators for building training corpora at scale (see README, section "llm")."""
