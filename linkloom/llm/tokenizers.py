"""Public tokenizers: token counts and token offsets of texts.

The folder is a parameter; vocabulary files are read on the executors and
never shipped. Loaded tokenizers are kept per Python worker.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache

FOLDER = "/opt/tokenizers"
NAME = "byte_bpe_50k.tiktoken"


class Tokens:
    """One tokenizer: ``count(text)`` and ``ends(text)``, the end of each token in code points."""

    def __init__(self, folder: str, name: str) -> None:
        path = os.path.join(folder, name)
        self.kind = name.rpartition(".")[2]
        if self.kind == "tiktoken":
            import public_tokenizers
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.own = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.size = [0] * (max(ranks.values()) + 1)
            for piece, rank in ranks.items():
                self.size[rank] = len(piece)
        elif self.kind == "json":
            from tokenizers import Tokenizer

            self.own = Tokenizer.from_file(path)
            self.own.encode_special_tokens = True
        elif self.kind == "model":
            import sentencepiece

            self.own = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            raise ValueError(f"no tokenizer of this kind: {name}")

    def count(self, text: str) -> int:
        if self.kind == "tiktoken":
            return len(self.own.encode_ordinary(text))
        if self.kind == "json":
            return len(self.own.encode(text, add_special_tokens=False).ids)
        return len(self.own.encode(text, num_threads=1))

    def ends(self, text: str) -> list[int]:
        """A token that ends inside a character ends where that character ends."""
        if self.kind == "json":
            return [end for _, end in self.own.encode(text, add_special_tokens=False).offsets]
        if self.kind == "tiktoken":
            at, ends = 0, []
            for t in self.own.encode_ordinary(text):
                at += self.size[t]
                ends.append(at)
        else:
            ends = [p.end for p in self.own.encode(text, return_type="proto").pieces]
        if text.isascii():
            return ends
        char_of, k = [0], 0
        for c in text:
            k += 1
            n = ord(c)
            char_of += [k] * (1 if n < 0x80 else 2 if n < 0x800 else 3 if n < 0x10000 else 4)
        return [char_of[e] for e in ends]


@lru_cache(maxsize=4)
def load(folder: str = FOLDER, name: str = NAME) -> Tokens:
    return Tokens(folder, name)


def byte_level(name: str) -> bool:
    """Whether every token stands for at least one byte of the text, so that a text has no more tokens than bytes."""
    return name.endswith(".tiktoken")
