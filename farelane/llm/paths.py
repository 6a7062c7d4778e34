"""Places of the public vocabulary files; environment variables name others."""

from __future__ import annotations

import os


def _public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_path() -> str:
    """The byte-level BPE vocabulary (``FARELANE_BPE``)."""
    return os.environ.get("FARELANE_BPE") or _public("byte_bpe_50k.json")


def unigram_path() -> str:
    """The subword vocabulary of the lattices (``FARELANE_PIECES``)."""
    return os.environ.get("FARELANE_PIECES") or _public("piece_bpe_32k.model")
