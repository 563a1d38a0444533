"""Reading a byte-level BPE vocabulary file (``tokenizers`` JSON format)."""

from __future__ import annotations

import json


def byte_alphabet() -> dict[str, int]:
    """The public byte-level alphabet: each byte's printable stand-in character.

    Printable Latin-1 bytes stand for themselves; the others are numbered
    from U+0100 in byte order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = {}, 0
    for b in range(256):
        if b in plain:
            out[chr(b)] = b
        else:
            out[chr(0x100 + extra)] = b
            extra += 1
    return out


class Vocabulary:
    """Token bytes by id, merge ranks by id pair, and the added special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of: dict[int, bytes] = {}
        for token, i in vocab.items():
            if token not in self.special:
                self.bytes_of[i] = bytes(alphabet[c] for c in token)
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.byte_id = [self.id_of[bytes([b])] for b in range(256)]
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for r, m in enumerate(merges):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank[vocab[a], vocab[b]] = (r, vocab[a + b])
