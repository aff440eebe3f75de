"""Token ids by a public tokenizer, split into pieces that fit a sequence."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

#: Fixed value: how byte-level BPE splits a text before merging.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_names() -> dict[str, int]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _merge_ranks(settings: dict) -> dict[bytes, int] | None:
    """Bytes of each token with its id, if ids ascend in the order of merges and nothing else shapes the ids."""
    model, split = settings["model"], settings.get("pre_tokenizer") or {}
    plain = (
        settings.get("normalizer") is None
        and model.get("type") == "BPE"
        and not model.get("ignore_merges")
        and not model.get("dropout")
        and (split.get("type"), split.get("add_prefix_space"), split.get("use_regex")) == ("ByteLevel", False, True)
    )
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model.get("merges", [])]
    if not plain or merged != sorted(merged):
        return None
    names, added = _byte_names(), {t["content"] for t in settings.get("added_tokens", [])}
    return {bytes(names[c] for c in token): i for token, i in model["vocab"].items() if token not in added}


class Encoder:
    """Ids of texts by a tokenizer file; a special token's name in a text is plain text.

    Merges of a byte-level BPE run in the faster of the two libraries, on the vocabulary of the
    same file; any other tokenizer runs in its own.
    """

    def __init__(self, path: str, dtype: str = "<u4"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        self.dtype = np.dtype(dtype)
        if tokenizer.get_vocab_size() - 1 > np.iinfo(self.dtype).max:
            raise ValueError(f"ids of this tokenizer need more than {self.dtype}")
        with open(path, encoding="utf-8") as file:
            ranks = _merge_ranks(json.load(file))
        if ranks is None:
            self.encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        else:
            import tiktoken

            self.encode = tiktoken.Encoding("file", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(self, text: str) -> bytes:
        """Little-endian ids of a text."""
        return np.array(self.encode(text), dtype=self.dtype).tobytes()


@lru_cache(maxsize=4)
def encoder(path: str, dtype: str = "<u4") -> Encoder:
    return Encoder(path, dtype)


def pieces(ids: bytes, capacity: int, width: int) -> list[bytes]:
    """Cut ids of ``width`` bytes each into pieces of ``capacity`` ids; only the first may be shorter."""
    first = len(ids) % (capacity * width) or min(len(ids), capacity * width)
    return [ids[:first], *(ids[i : i + capacity * width] for i in range(first, len(ids), capacity * width))]
