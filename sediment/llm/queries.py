"""The numbered queries: each applies its operator to a whole table."""

from __future__ import annotations

from importlib import import_module

from sediment.llm.registry import ORACLES, QUERIES

MODULES = ("q_urls", "q_mixing", "q_decontaminate", "q_tokens", "q_ordermin", "q_licenses", "q_language", "q_simhash", "q_chat", "q_quality", "q_align", "q_radix", "q_negatives")

for _name in MODULES:
    import_module(f"sediment.llm.{_name}")

__all__ = ["ORACLES", "QUERIES"]
