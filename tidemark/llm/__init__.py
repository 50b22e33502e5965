"""Operators for preparing large-scale training data; see the README section on `llm`."""
