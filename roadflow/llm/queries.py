"""Importing this module registers every query of the package."""

from roadflow.llm import chat, collocations, decontamination, embeddings, language, licenses, lines, mixing, ngram_join, packing, prefix_trie, toxicity, urls  # noqa: F401
from roadflow.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
