"""Where the files of public tokenizers lie. Every operator takes the path as a parameter."""

from __future__ import annotations

import os


def vocabulary(name: str, folder: str | None = None) -> str:
    """Path of a vocabulary file: in ``folder``, or where the ``public_tokenizers`` package has it."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
