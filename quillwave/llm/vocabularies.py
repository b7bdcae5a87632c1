"""Where the public tokenizers' vocabulary files are."""

from __future__ import annotations

import os

FOLDER = "QUILLWAVE_TOKENIZERS"  #: environment variable that names another folder


def vocabulary(name: str, folder: str | None = None) -> str:
    """Path of a vocabulary file: in ``folder``, or that of the environment, or the installed package."""
    folder = folder or os.environ.get(FOLDER)
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
