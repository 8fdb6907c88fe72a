"""Token ids of texts by a public byte-level BPE vocabulary (a path, never copied)."""

from __future__ import annotations

import json

import numpy as np

_ENCODERS: dict[str, "Encoder"] = {}


class Encoder:
    """Ids as the ``tokenizers`` library gives them for a vocabulary file.

    A byte-level BPE whose ids follow its merge order has the same ids under
    ``tiktoken``, which is several times as fast; that is used where the file
    shows this order, for texts without any of the file's added tokens. All
    else goes through ``tokenizers``.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.fast = self._ranked(spec)

    def _ranked(self, spec: dict):
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if (model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer")
                or pre.get("use_regex") is False or model.get("ignore_merges")):
            return None
        import public_tokenizers
        import tiktoken

        # byte-level vocabularies write each byte as a printable character: the printable ones
        # of Latin-1 as themselves, the others in order from U+0100 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte_of = {chr(b): b for b in plain}
        byte_of |= {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        vocab = {t: i for t, i in model["vocab"].items() if t not in self.added}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)) or len(vocab) != 256 + len(merges):
            return None
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items()}
        return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and len(text) < 1 << 20 and not any(a in text for a in self.added):
            return np.array(self.fast.encode_ordinary(text), dtype=np.uint32)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, loaded once per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
