"""Token ids of public vocabularies, as numpy arrays, inside tasks."""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np

#: Fixed value: how a byte-level vocabulary splits text into words before it merges.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte: printable bytes stand for themselves, the others
    for the code points from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteEncoder:
    """Ids of whole texts by a byte-level vocabulary file.

    A file that merges by rank alone (ids in the order of its merges, the usual words, no normalizing) is run by the
    faster of two libraries that read the same vocabulary; any other file by the one it was written for. ``special``
    decides whether the strings of special tokens inside a text are those tokens or ordinary text.
    """

    def __init__(self, path: str, special: bool = True):
        with open(path, encoding="utf-8") as file:
            found = json.load(file)
        letters = byte_letters()
        vocabulary = found["model"]["vocab"]
        added = {t["content"]: t["id"] for t in found["added_tokens"]}
        self.pieces: list[bytes] = [b""] * (1 + max([*vocabulary.values(), *added.values()]))
        for word, i in vocabulary.items():
            self.pieces[i] = bytes(letters[c] for c in word) if all(c in letters for c in word) else word.encode()
        for word, i in added.items():
            self.pieces[i] = word.encode()
        self.special = special and bool(added)
        self.fast = self._fast(found, {p: i for i, p in enumerate(self.pieces) if i not in added.values()}, added)
        self.slow = None
        if self.fast is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(path)
            self.slow.encode_special_tokens = not special

    @staticmethod
    def _fast(found: dict, ranks: dict[bytes, int], added: dict[str, int]):
        model, before = found["model"], found["pre_tokenizer"] or {}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        order = [model["vocab"].get(a + b, -1) for a, b in pairs]
        plain = (
            model["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
            and not any(found.get(k) for k in ("normalizer", "truncation", "padding"))
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and not any(t[k] for t in found["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
            and len(added) < 2 and order == sorted(set(order)) and len(ranks) == 256 + len(order) and all(len(p) == 1 or i in order[:1] or i > order[0] for p, i in ranks.items())
        )
        if not plain:
            return None
        import tiktoken

        return tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=added)

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        if self.fast is None:
            return [np.array(e.ids, np.uint32) for e in self.slow.encode_batch_fast(list(texts), add_special_tokens=False)]
        allowed = "all" if self.special else set()
        return [self.fast.encode_to_numpy(t, allowed_special=allowed, disallowed_special=()).astype(np.uint32, copy=False) for t in texts]


class PieceEncoder:
    """Ids of whole texts by a piece model, which sets a space before each text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.pieces = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        return [np.array(ids, np.uint32) for ids in self.model.encode(list(texts), num_threads=1)]
