"""Exact token counts of a BPE tokenizer with the whole-token shortcut.

A vocabulary string that the merges turn into one token needs no merging when
it occurs as a pre-token. ``whole_tokens`` proves offline, string by string,
for which of them that holds; counting looks pre-tokens up in that set and
only merges the rest, whose counts are remembered in a bounded cache.
"""

from __future__ import annotations

import json

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import map_rows, process_cache

CACHE_WORDS = 200_000
# Text whose normal form, lower case and letter classes are certain to be the
# same here and in the tokenizer library; other texts go through the library.
PLAIN = regex.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-įĲ-ňŊ-žƀ-ǃ]*+")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level BPE: bytes that print
    stand for themselves, the others for the code points from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return [chr(b) if b in prints else chr(256 + rest.index(b)) for b in range(256)]


class BpeCounter:
    """Counts tokens as the library does without added begin or end tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.model = self.library.model
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.letters = byte_letters()
        self.counts = self.whole_tokens(spec["model"]["vocab"],
                                        spec["model"]["end_of_word_suffix"])
        self.proven = len(self.counts)

    def merged(self, word: str) -> int:
        """Tokens of one pre-token by running its merges."""
        letters = self.letters
        return len(self.model.tokenize("".join([letters[b] for b in word.encode()])))

    def whole_tokens(self, vocab: dict, suffix: str) -> dict[str, int]:
        """pre-token -> 1 for each vocabulary string that alone encodes as one
        token, shown by encoding it."""
        back = {c: b for b, c in enumerate(self.letters)}
        proven = {}
        for token in vocab:
            if not token.endswith(suffix):
                continue
            body = token[:-len(suffix)]
            try:
                word = bytes([back[c] for c in body]).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if word and len(self.model.tokenize(body)) == 1:
                proven[word] = 1
        return proven

    def count(self, text: str) -> int:
        plain = PLAIN.fullmatch(text) is not None
        if not plain or any(s in text for s in self.special):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        counts = self.counts
        words = self.split.findall(text.lower())
        try:
            return sum(map(counts.__getitem__, words))
        except KeyError:
            if len(counts) > self.proven + CACHE_WORDS:     # drop the remembered rest
                self.counts = counts = dict(list(counts.items())[:self.proven])
            for w in words:
                if w not in counts:
                    counts[w] = self.merged(w)
            return sum(map(counts.__getitem__, words))


def token_counts(df: DataFrame, *, path: str | None = None, limit: int = 2048,
                 id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit (> ``limit``).

    A null or empty text has 0 bytes and 0 tokens; a null id is kept, repeated
    rows stay, an empty table gives none, other columns are ignored. ``path``
    is the tokenizer file, readable on every executor."""
    path = path or tokenizer_file()

    def make():
        counter = process_cache(("bpe", path), lambda: BpeCounter(path))

        def fn(ids, texts):
            n = [0 if not t else counter.count(t) for t in texts]
            return [ids, [0 if t is None else len(t.encode()) for t in texts], n,
                    [x > limit for x in n]]
        return fn

    kind = df.schema[id_col].dataType.simpleString()
    return map_rows(df, [F.col(id_col), F.col(text).cast("string")],
                    f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean", make)
