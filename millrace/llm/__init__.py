"""Operators for large language-model training corpora. Nothing outside this subpackage imports it."""
