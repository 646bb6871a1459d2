"""Encoders for public tokenizer files, as the library of each file gives the ids.

``encoder(path)`` returns an object with ``ids(text) -> numpy uint32``. Each Python
worker builds it once per file. The path is a parameter; every executor has the file.
"""

from __future__ import annotations

import base64
import hashlib
import json
from functools import lru_cache

import numpy as np


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for bytes."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class JsonEncoder:
    """A ``tokenizers`` file with default treatment of special strings, nothing added.

    A plain byte-level BPE file (the usual splitting pattern, no normaliser, ids in merge
    order) is encoded through its ranks, several times faster with the same ids (tested);
    anything else, and a text whose white space is too long for that library's pattern
    engine, through the ``tokenizers`` library itself.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.fast = self._by_rank(spec) if self._plain(spec) else None
        self._slow = None

    @staticmethod
    def _plain(spec: dict) -> bool:
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        return (model.get("type") == "BPE" and not spec.get("normalizer") and not spec.get("truncation")
                and not spec.get("padding") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                and not pre.get("add_prefix_space", True) and not model.get("dropout") and not model.get("ignore_merges")
                and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
                and len(model["vocab"]) == 256 + len(model["merges"])
                and all(model["vocab"].get("".join(m if isinstance(m, list) else m.split(" "))) == 256 + i
                        for i, m in enumerate(model["merges"]))
                and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or not t["special"]
                            for t in spec["added_tokens"]))

    @staticmethod
    def _by_rank(spec: dict):
        import tiktoken
        from public_tokenizers import PATTERN

        to_byte = _byte_of_char()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(map(to_byte.__getitem__, w)): i for w, i in spec["model"]["vocab"].items() if w not in special}
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # its pattern engine gave up on a very long run of white space
                pass
        return np.array(self._library().encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        if self.fast is not None:
            return self.fast.decode_bytes(ids.tolist()).decode("utf-8")
        return self._library().decode(ids.tolist(), skip_special_tokens=False)

    def _library(self):
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
            self._slow.no_truncation()
            self._slow.no_padding()
        return self._slow


class PieceEncoder:
    """A ``sentencepiece`` model, without begin and end."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, add_bos=False, add_eos=False), dtype=np.uint32)


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` file: byte string to id."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def encoder(path: str):
    return PieceEncoder(path) if path.endswith(".model") else JsonEncoder(path)


def version_digest(path: str) -> str:
    """SHA-256 over the tokenizer's file and how it is used: other ids, other digest."""
    with open(path, "rb") as f:
        return hashlib.sha256(b"no added tokens, default specials\0" + f.read()).hexdigest()
