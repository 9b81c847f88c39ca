"""Phrase patterns: a vocabulary per language, rules that compose it, and matching expressions."""

from crawlprism.patterns.families import Family, Pattern, PatternSet, default_patterns

__all__ = ["Family", "Pattern", "PatternSet", "default_patterns"]
