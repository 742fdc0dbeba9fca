"""Token ids and counts of whole texts, equal to the tokenizers library's, with the library called for rare pieces only.

Both encoders cut a text where no token can reach across, remember what the pieces give, and ask the
library for the merges of pieces not seen before. What is remembered has a bound: beyond it the pieces
learnt last are dropped, as frequent ones are learnt early.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from contextlib import contextmanager
from itertools import islice
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletgraph.llm.words import raw_bytes

#: Pieces remembered by a task, and as many words; together about 400 bytes each.
REMEMBERED = 800_000
#: And between tasks.
AT_REST = 20_000
#: Texts that are encoded together.
GROUP = 256
# Fixed value: the pattern that splits text before the merges of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that Python takes for white space and the library does not, or the other way round.
ODD_SPACE = re.compile("[\x1c-\x1f\x85᠎​]")


@contextmanager
def kept(key, make):
    """An encoder that a Python worker keeps from task to task; between tasks it remembers little."""
    held = sys.__dict__.setdefault("_walletgraph_kept", {})
    if key not in held:
        held[key] = make()
    try:
        yield held[key]
    finally:
        held[key].rest()


def _library(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation(), tokenizer.no_padding()
    return tokenizer


def _batch(tokenizer, texts: list[str]) -> list:
    return tokenizer.encode_batch_fast(texts, add_special_tokens=False)


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it is visible, else the next from U+0100."""
    spare = iter(range(256, 512))
    return {b: b if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else next(spare) for b in range(256)}


_LETTERS = _byte_letters()


def _model_word(word: str) -> str:
    return word.translate(_LETTERS) if word.isascii() else word.encode().decode("latin-1").translate(_LETTERS)


def _latin(word: str) -> bool:
    """Whether all characters are below U+0100: there composition changes nothing, and lower case is one for one."""
    if word.isascii():
        return True
    try:
        word.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Known(dict):
    """What pieces give; a new piece is learnt when it is asked for."""

    def __init__(self, learn, items=()):
        super().__init__(items)
        self.learn = learn

    def __missing__(self, piece):
        found = self[piece] = self.learn(piece)
        return found

    def bound(self, most: int) -> None:
        """If it has grown beyond `most`, drops the half that was learnt last."""
        if len(self) > most:
            for _ in range(len(self) - most // 2):
                self.popitem()

    def first(self, n: int) -> Known:
        return Known(self.learn, islice(self.items(), n))


class IdEncoder:
    """Ids of texts as bytes of little-endian integers of `width` bytes.

    For vocabularies that drop white space the pieces are what stands between white space; for others a
    piece is a whole text. A new piece that is a Latin word with punctuation after it is two pre-tokens, whose
    merges are asked for alone; others are encoded by the library as they are."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.tokenizer, self.remembered = _library(path), remembered
        self.known, self.words = Known(self._piece), Known(self._word)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.code = {2: "H", 4: "I"}[self.width]
        self.simple = False
        probes = ["one two", "a\n b\tc", " x  y ", "it's 12, no.\nÄ é"]
        self.apart = all(b"".join(map(self._whole, p.split())) == self._whole(p) for p in probes)
        plain = ["the", "unbelievably", "été", "naïveté", "straße", "...", "?!", "no."]
        self.simple = self.apart and all(self._simple(p) == self._whole(p) for p in plain)

    def rest(self) -> None:
        self.known, self.words = self.known.first(AT_REST), self.words.first(AT_REST)

    def _ids(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        return self._ids([t.id for t in self.tokenizer.model.tokenize(_model_word(word))])

    def _simple(self, piece: str) -> bytes | None:
        core = piece.rstrip(punctuation)
        if core.isalpha() and _latin(core):
            return self.words[core.lower()] + self.words[piece[len(core) :]] if len(core) < len(piece) else self.words[core.lower()]
        return None if core else self.words[piece]

    def _piece(self, piece: str) -> bytes:
        found = self._simple(piece) if self.simple else None
        return self._whole(piece) if found is None else found

    def _cut(self, text: str) -> list[str]:
        return text.split() if self.apart and not ODD_SPACE.search(text) else [text] if text else []

    def encode(self, texts: list[str]) -> list[bytes]:
        self.known.bound(self.remembered), self.words.bound(self.remembered)
        get = self.known.__getitem__
        return [b"".join(map(get, self._cut(x))) for x in texts]


def whole_tokens(path: str) -> frozenset[str]:
    """The strings of the vocabulary that are one token when they stand alone: proved by encoding each."""
    tokenizer = _library(path)
    strings = [tokenizer.decode([i], skip_special_tokens=False) for i in range(tokenizer.get_vocab_size())]
    strings = [s for s in strings if s and "�" not in s]
    return frozenset(s for s, x in zip(strings, _batch(tokenizer, strings), strict=True) if len(x.ids) == 1)


class Counter:
    """Token counts under a byte-level vocabulary: pre-tokens that are whole tokens count one, the rest are merged.

    A text is cut before spaces where that can't change its pre-tokens; elsewhere, by the pattern."""

    def __init__(self, path: str, whole: frozenset[str], remembered: int = REMEMBERED):
        import regex

        self.tokenizer, self.whole, self.remembered = _library(path), whole, remembered
        self.known, self.words = Known(self._piece), Known(self._word)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pattern, self.plain = regex.compile(PATTERN), regex.compile(r"[ \t\r\n!-~\p{Latin}]*")
        self.mixed = re.compile(r"\s \s|\s \Z")
        plain = ["the", " unbelievably", " été", "naïveté", " straße", "...", " ?!", "no.", " no,"]
        self.simple = all(self._simple(p) == len(self.tokenizer.encode(p, add_special_tokens=False).ids) for p in plain)

    def rest(self) -> None:
        self.known, self.words = self.known.first(AT_REST), self.words.first(AT_REST)

    def _cut(self, text: str) -> list[str]:
        if ODD_SPACE.search(text):
            return [text]
        if self.mixed.search(text):
            return self.pattern.findall(text) if self.plain.fullmatch(text) else [text]
        first, *rest = text.split(" ")
        return [first, *map(" ".__add__, rest)] if first else list(map(" ".__add__, rest))

    def _word(self, word: str) -> int:
        return 1 if word in self.whole else len(self.tokenizer.model.tokenize(_model_word(word)))

    def _simple(self, piece: str) -> int | None:
        """Of a Latin word, with a space before or punctuation after it, or of punctuation alone."""
        core = piece.rstrip(punctuation)
        if core.removeprefix(" ").isalpha() and _latin(core):
            return self.words[core] + self.words[piece[len(core) :]] if len(core) < len(piece) else self.words[core]
        return self.words[piece] if core in ("", " ") and len(core) < len(piece) else None

    def _piece(self, piece: str) -> int:
        """Pre-tokens of an odd piece that are no whole tokens are merged by the library."""
        found = self._simple(piece) if self.simple else None
        if found is not None:
            return found
        own = self.pattern.findall(piece) if self.plain.fullmatch(piece) else [piece]
        rest = [x for x in own if x not in self.whole]
        return len(own) - len(rest) + sum(len(x.ids) for x in _batch(self.tokenizer, rest))

    def count(self, texts: list[str]) -> list[int]:
        self.known.bound(self.remembered), self.words.bound(self.remembered)
        get, out = self.known.__getitem__, []
        for text in texts:
            parts = self.special.split(text) if self.special and self.special.search(text) else [text]
            out.append(sum(sum(map(get, self._cut(part))) for part in parts if part) + len(parts) - 1)
        return out


def groups(texts: pa.Array, size: int = GROUP, most: int = 1 << 20):
    """(first, list of texts): some texts at a time, few if they are long."""
    lengths = np.diff(raw_bytes(texts)[1])
    at, n = 0, len(texts)
    ends = np.cumsum(lengths)
    while at < n:
        to = min(at + size, max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right"))))
        yield at, [x or "" for x in texts[at:to].to_pylist()]
        at = to


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every document.

    Defined cases: null or empty texts have no bytes and no tokens; strings of special tokens inside texts
    are those tokens, as the library has it; a null doc_id or a repeated row is treated like any other.
    Very long texts are counted whole; an empty table gives no rows; further columns, whatever their names, are not read.
    """
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def run(batches):
        with kept(("count", path), lambda: Counter(path, whole.value)) as counter:
            for batch in batches:
                size = np.diff(raw_bytes(batch["text"])[1])
                count = np.array([n for _, texts in groups(batch["text"]) for n in counter.count(texts)], np.int64)
                yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(size.astype(np.int64)), pa.array(count), pa.array(count > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
