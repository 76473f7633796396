"""Exact tokenizer work by pre-token: splitting texts as the tokenizer files do, and tokens per pre-token."""

from __future__ import annotations

import json
import os
import re
from functools import cached_property

import public_tokenizers

# Letters (all precomposed Latin, without U+0130) and marks for which the fast patterns below agree with the
# tokenizers' Unicode classes; a text with any other character goes through the library itself.
LATIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
OTHER = re.compile(rf"[^\t\n\x0b\x0c\r -~{LATIN}–—‘-”…«»¡¿]")
WORDS = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{LATIN}]+|[0-9]|[^\s{LATIN}0-9]+")


def load(name: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(name if "/" in name else public_tokenizers.path(name))


class WordSplitter:
    """Pre-tokens of the word_bpe file: normalised, split by its pattern; special strings count apart.

    Made on the driver; tasks get the patterns only and load the library's tokenizer when a text needs it."""

    def __init__(self, name: str):
        spec = json.loads(load(name).to_str())
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.name, self.pattern = name, split["pattern"]["Regex"]
        self.special = re.compile("|".join(re.escape(x["content"]) for x in spec["added_tokens"])) if spec["added_tokens"] else re.compile("(?!)")

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("name", "pattern", "special")}

    @cached_property
    def full(self):
        return load(self.name)

    @cached_property
    def split(self):
        from tokenizers import Regex, pre_tokenizers

        return pre_tokenizers.Split(Regex(self.pattern), "removed", invert=True)

    def words(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of the text, and how many special tokens stand in it."""
        if "<|" in text and (n := len(self.special.findall(text))):
            out: list[str] = []
            for part in self.special.split(text):
                out += self.words(part)[0]
            return out, n
        if OTHER.search(text):
            return [w for w, _ in self.split.pre_tokenize_str(self.full.normalizer.normalize_str(text))], 0
        return WORDS.findall(text.lower()), 0

    def counter(self):
        """A function from pre-tokens to their numbers of pieces, by the same model without normaliser and splitting."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core, and every thread of the library memory of its own
        from tokenizers import Tokenizer, pre_tokenizers

        plain = Tokenizer(self.full.model)  # the same model, not another copy of it
        plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # a thousand at a time: what the library makes of a word is far larger than the word
        return lambda words: [len(e) for k in range(0, len(words), 1024) for e in plain.encode_batch_fast(list(words[k : k + 1024]), add_special_tokens=False)]


def _byte_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteIds:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    Where ids and merges of the file are in the same order, merging by lowest rank over bytes gives the library's
    ids, and texts of the fast pattern's characters go that way; all other texts go through the library.
    """

    def __init__(self, name: str):
        import numpy as np
        import tiktoken

        self.np, self.full, self.fast = np, load(name), None
        spec = json.loads(self.full.to_str())
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges]
        in_order = [vocab[x] for x in joined]
        if in_order == list(range(in_order[0], in_order[0] + len(in_order))) and in_order[0] == 256:
            letters = _byte_letters()
            special = {x["content"] for x in spec["added_tokens"]}
            ranks = {bytes(letters[c] for c in w): k for w, k in vocab.items() if w not in special}
            self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def batch(self, texts: list[str]) -> list[bytes]:
        out = []
        for t in texts:
            if self.fast is None or "<|" in t or OTHER.search(t):
                out.append(self.np.asarray(self.full.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes())
            else:
                out.append(self.fast.encode_to_numpy(t, disallowed_special=()).astype("<u4", copy=False).tobytes())
        return out
