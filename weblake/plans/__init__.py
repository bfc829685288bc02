"""User-facing datasets composed from sources, functions and operators."""
