"""Pre-tokens of the public tokenizers, as their own library cuts them.

Texts of common Latin characters are cut by an equal pattern of the standard library, which is much
faster; every other text is cut by the tokenizer's own pre-tokenizer. A pre-token is never joined
with its neighbours by either tokenizer, so its ids are those it has alone.
"""

from __future__ import annotations

import os
import re

# The letters and numbers among the characters of PLAIN.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_NUMBERS = "0-9²³¹¼-¾"
_REST = rf"[^\s{_LETTERS}{_NUMBERS}]+"

#: Any character outside the range in which the patterns below are known to agree.
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e¡-¬®-ÿ]")
BYTE_LEVEL = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?{_REST}|\s+(?!\S)|\s+")
WORD_LEVEL = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|{_REST}")


def load(path: str):
    """The tokenizer of a .json file, on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def specials(tokenizer) -> re.Pattern | None:
    """A pattern that cuts a text at the tokenizer's special strings and keeps them."""
    found = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, found)) + ")") if found else None


def byte_level_pieces(text: str, tokenizer, special: re.Pattern | None) -> list[str]:
    """The pre-tokens of a byte-level tokenizer; special strings stay whole."""
    if special is not None and special.search(text):
        out: list[str] = []
        for k, part in enumerate(special.split(text)):
            out += [part] if k % 2 else byte_level_pieces(part, tokenizer, None)
        return out
    if UNUSUAL.search(text) is None:
        return BYTE_LEVEL.findall(text)
    return [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def word_level_pieces(text: str) -> list[str] | None:
    """The pre-tokens of the word tokenizer's lower-cased text, or None where its library must cut it."""
    return WORD_LEVEL.findall(text.lower()) if UNUSUAL.search(text) is None else None
