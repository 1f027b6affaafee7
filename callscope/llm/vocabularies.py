"""Places of the public tokenizers' files. Executors have them installed at the same path."""

from __future__ import annotations


def vocabulary_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
