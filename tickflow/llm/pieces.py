"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over the pieces reads a text once; at each position
its output links give every piece that ends there, longest first, and each
relaxes the best score at that position (Viterbi). The pieces and scores of
the model file are taken as a unigram model. Characters that are no piece
become byte pieces, as byte fallback asks.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import byte_slices, fresh, process_cache

SPACE = "▁"
CACHE_WORDS = 200_000
CACHED_LENGTH = 64
SLICE_BYTES = 1 << 20    # of a batch turned into Python texts at a time
UNKNOWN_BELOW = 10.0     # fixed value: an unknown character scores this far below the worst piece
CHUNKS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def model_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class PieceModel:
    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if sp.normalize(" a  b") != f"{SPACE}{SPACE}a{SPACE}{SPACE}b":
            raise ValueError(f"{path}: only models with the identity normalizer and a dummy "
                             "prefix are supported")
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.scores = [sp.get_score(i) for i in range(len(self.pieces))]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(len(self.pieces))
                      if sp.is_byte(i)}
        self.normal = [i for i in range(len(self.pieces)) if not (
            sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.unknown_id = sp.unk_id()
        self.unknown_score = min(self.scores[i] for i in self.normal) - UNKNOWN_BELOW
        self.single = {self.pieces[i] for i in self.normal if len(self.pieces[i]) == 1}
        self.automaton = ahocorasick.Automaton()
        for i in self.normal:
            self.automaton.add_word(self.pieces[i], (len(self.pieces[i]), self.scores[i], i))
        self.automaton.make_automaton()
        # No piece continues past a space sign that follows other characters,
        # so the best path over a text is the best paths over its chunks.
        self.chunked = not any(SPACE in self.pieces[i].lstrip(SPACE) for i in self.normal)
        raw = [b"" if sp.is_control(i) else p.replace(SPACE, " ").encode()
               for i, p in enumerate(self.pieces)]
        for b, i in self.bytes.items():
            raw[i] = bytes([b])
        self.raw_size = np.array([len(x) for x in raw])
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.raw_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.words: dict[str, bytes] = {}
        self.line_words: dict[str, bytes] = {}
        # Nor does a piece join a line end to anything: lines are chunks too.
        self.newline = b""
        if not any("\n" in self.pieces[i] and len(self.pieces[i]) > 1 for i in self.normal):
            self.newline = np.array(self.viterbi("\n"), np.int32).tobytes()

    def viterbi(self, chunk: str) -> list[int]:
        """Best ids of a normalized text; on equal scores the longest last piece."""
        n = len(chunk)
        best, back = [float("-inf")] * (n + 1), [(0, -1)] * (n + 1)
        best[0], at = 0.0, 0      # at: ends up to here are final
        single = self.single
        if single.issuperset(chunk):
            for end, (size, score, piece) in self.automaton.iter(chunk):
                end += 1
                score += best[end - size]
                if score > best[end]:
                    best[end] = score
                    back[end] = (end - size, piece)
            ids, end = [], n
            while end:
                end, piece = back[end]
                ids.append(piece)
            return ids[::-1]

        def close(upto: int) -> None:
            nonlocal at
            while at < upto:      # the unknown edge of a character that is no piece
                at += 1
                if chunk[at - 1] not in single:
                    score = best[at - 1] + self.unknown_score
                    if score > best[at]:
                        best[at], back[at] = score, (at - 1, -1)

        for end, (size, score, piece) in self.automaton.iter(chunk):
            close(end)
            score += best[end + 1 - size]
            if score > best[end + 1]:
                best[end + 1], back[end + 1] = score, (end + 1 - size, piece)
        close(n)
        ids, end = [], n
        while end:
            start, piece = back[end]
            if piece >= 0:
                ids.append(piece)
            elif self.bytes:
                ids.extend(self.bytes[b] for b in reversed(chunk[start:end].encode()))
            else:
                ids.append(self.unknown_id)
            end = start
        return ids[::-1]

    def word_ids(self, word: str, lead: str = SPACE) -> bytes:
        """Ids of a word after a space sign, or of a line's first word."""
        if self.newline and "\n" in word:
            first, *rest = word.split("\n")
            return self.known(first) + b"".join(
                [self.newline + (self.known(w, "") if w else b"") for w in rest])
        ids = np.array(self.viterbi(lead + word), np.int32).tobytes()
        if len(word) <= CACHED_LENGTH:
            table = self.words if lead else self.line_words
            if len(table) >= CACHE_WORDS:
                table.clear()
            table[word] = ids
        return ids

    def known(self, word: str, lead: str = SPACE) -> bytes:
        return (self.words if lead else self.line_words).get(word) or self.word_ids(word, lead)

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        words = text.split(" ")
        if self.chunked and "" not in words and SPACE not in text:
            known = self.words        # ids of a space sign and the word
            found = list(map(known.get, words))
            if None in found:
                found = [known.get(w) or self.word_ids(w) for w in words]
            return np.frombuffer(b"".join(found), np.int32)
        norm = SPACE + text.replace(" ", SPACE)
        chunks = CHUNKS.findall(norm) if self.chunked else [norm]
        return np.concatenate([self.viterbi(c) for c in chunks]).astype(np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """Bytes of all pieces are gathered at once from one table."""
        size = self.raw_size[ids]
        ends = np.cumsum(size)
        if not len(ends):
            return ""
        at = np.repeat(self.raw_start[ids] - (ends - size), size) + np.arange(ends[-1])
        text = self.raw_bytes[at].tobytes().decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


def _kept(df: DataFrame, carry) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in carry)


def _listed(ids: list[np.ndarray]) -> pa.Array:
    ends = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) for x in ids], out=ends[1:])
    return pa.ListArray.from_arrays(
        pa.array(ends), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32)))


def _coded(df: DataFrame, path: str | None, source, carry: list[str], schema: str, work) -> DataFrame:
    """The ``carry`` columns and what ``work(model, column)`` makes of ``source``,
    the last column of each slice. Columns are met by their places, so no name of
    the table can clash with one used here."""
    path, names = path or model_file(), [*carry, *[c.split()[0].strip("`") for c in schema.split(", ")]]

    def run(batches):
        model = process_cache(("pieces", path), lambda: PieceModel(path))
        for batch in byte_slices(batches, SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *work(model, batch.columns[-1])],
                                             names=names)

    kept = ", ".join([_kept(df, carry)] if carry else [])
    return df.select(*[F.col(f"`{c}`") for c in carry], source.alias(
        fresh("source", carry))).mapInArrow(run, f"{kept}, {schema}" if kept else schema)


def encode(df: DataFrame, *, path: str | None = None, text: str = "text",
           carry=("doc_id", "text"), out: str = "ids") -> DataFrame:
    """The ``carry`` columns and ``out`` array<int>, one row per input row.
    Null and empty texts give no ids. Whole texts of any length are encoded;
    other columns are dropped; repeated rows stay; empty tables stay empty."""
    def work(model, column):
        return [_listed([model.encode(t) for t in column.to_pylist()])]

    return _coded(df, path, F.col(f"`{text}`").cast("string"), list(carry), f"`{out}` array<int>",
                  work)


def decode(df: DataFrame, *, path: str | None = None, ids: str = "ids",
           carry=("doc_id",), out: str = "decoded") -> DataFrame:
    """The ``carry`` columns and the text of the ids (null ids: empty text).
    Decoding an encoded text gives it back, with each space sign U+2581 of the
    text as a space, since the model cannot tell the two apart."""
    def work(model, column):
        ends = np.cumsum([0 if n is None else n for n in
                          pa.compute.list_value_length(column).to_pylist()])
        flat = column.flatten().to_numpy(zero_copy_only=False)
        texts = [model.decode(x) for x in np.split(flat, ends[:-1])] if len(ends) else []
        return [pa.array(texts, pa.string())]

    return _coded(df, path, F.col(f"`{ids}`"), list(carry), f"`{out}` string", work)


def encode_and_decode(df: DataFrame, *, path: str | None = None, text: str = "text",
                      carry=("doc_id", "text"), ids: str = "ids", decoded: str = "decoded"
                      ) -> DataFrame:
    """``encode`` and ``decode`` of its ids in one pass, one worker a task; null
    and empty texts give no ids and an empty text."""
    def work(model, column):
        coded = [model.encode(t) for t in column.to_pylist()]
        return [_listed(coded), pa.array([model.decode(x) for x in coded], pa.string())]

    return _coded(df, path, F.col(f"`{text}`").cast("string"), list(carry),
                  f"`{ids}` array<int>, `{decoded}` string", work)


def round_trip(df: DataFrame, *, path: str | None = None) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, ids_xxhash64 (of the ids),
    round_trip (decoding gives the text back, by its 64-bit hash)."""
    text = F.coalesce("text", F.lit(""))
    rows = df.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"),
                     F.xxhash64(F.translate(text, SPACE, " ")).alias("text_hash"), "text")
    both = encode_and_decode(rows, path=path, carry=("doc_id", "n_bytes", "text_hash"))
    return both.select("doc_id", "n_bytes", F.size("ids").cast("long").alias("n_tokens"),
                       F.xxhash64("ids").alias("ids_xxhash64"),
                       (F.xxhash64("decoded") == F.col("text_hash")).alias("round_trip"))
