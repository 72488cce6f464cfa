"""Loads every module that registers a training-data query."""

from tablewarden.llm import bpe, chat, codes, decontaminate, divergence, licences, lines, packing, quality, simhash, suffixes, toxicity, windows  # noqa: F401
from tablewarden.llm.common import QUERIES  # noqa: F401
