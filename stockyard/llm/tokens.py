"""Token ids of whole texts by a byte-level BPE tokenizer."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from functools import cache

import numpy as np


def _bytes_of_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """The file's vocabulary as ranks of byte strings, and its added tokens, if it is plain byte-level BPE
    numbered in the order of its merges: then either library finds the same ids, and tiktoken several times sooner."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, before = told["model"], told.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not model.get("dropout") and not model.get("byte_fallback")
    plain &= not model.get("ignore_merges") and told.get("normalizer") is None and before.get("type") == "ByteLevel"
    if not plain or before.get("add_prefix_space") or not before.get("use_regex", True):
        return None
    letters, vocabulary = _bytes_of_letters(), model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(vocabulary["".join(pair)] != 256 + i for i, pair in enumerate(pairs)):
        return None
    added = told.get("added_tokens") or []
    if any(token.get(flag) for token in added for flag in ("lstrip", "rstrip", "single_word")):
        return None
    ordinary = {text: i for text, i in vocabulary.items() if i < 256 + len(pairs)}
    ranks = {bytes(letters[c] for c in text): i for text, i in ordinary.items()}
    return ranks, {token["content"]: token["id"] for token in added}


@cache
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """The ids of a text by the tokenizer in a file, as `encode` gives them: the string of an added token, such as
    `<|endoftext|>`, is that token wherever it stands. One encoder for each Python worker."""
    if found := _ranks(path):
        import public_tokenizers
        import tiktoken

        ranks, added = found
        fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
        return lambda text: fast.encode_to_numpy(text, allowed_special="all")
    return slow_encoder(path)


def slow_encoder(path: str) -> Callable[[str], np.ndarray]:
    """The same by the library whose file it is, whatever its tokenizer does."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    return lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
