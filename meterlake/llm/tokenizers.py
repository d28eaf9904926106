"""Where vocabulary files are. They are read in place and never copied."""

from __future__ import annotations

import os

VOCABULARY_DIR = "METERLAKE_TOKENIZERS"


def tokenizer_file(name: str) -> str:
    """The file in the folder that the environment names, or else in the installed package of public vocabularies."""
    folder = os.environ.get(VOCABULARY_DIR)
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
