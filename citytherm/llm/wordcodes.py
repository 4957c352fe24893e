"""Token ids of many texts through the tokenizers, tiktoken and sentencepiece libraries, by distinct pieces.

Texts are cut where no token can cross: before a space that has a visible ASCII
character on one side, around a line feed between two of them, and between an ASCII letter and a
mark such as a comma.  The given tokenizers split there before they merge, so a text's
ids are those of its pieces in order.  A sentencepiece model is cut before spaces only, where
no entry of its vocabulary has a space behind another character.  Each distinct piece goes through the
library once per slice at most; a bounded table per worker keeps short ones.

Where blanks make no difference and the vocabulary marks the ends of words, short pieces share calls, a line feed
between them: a word of ASCII letters ends with the only closing id it has, others are told apart by ``MARK``.
"""

from __future__ import annotations

import base64
import os
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from citytherm.llm.common import utf8


@dataclass(frozen=True)
class Vocabulary:
    name: str                    # a file of public_tokenizers, read on each worker
    plain_specials: bool = False  # strings of special tokens inside texts are ordinary text
    pattern: str = public_tokenizers.PATTERN  # of a file of ranks
    blank: bool = False           # white space and the case of A-Z make no difference to the ids
    table_pieces: int = 800_000
    table_length: int = 48


GATHER = 1 << 16  # pieces whose ids are put in place at once
JOINED = 64  # short pieces that share a call of the library
MARK = "\x01"  # its id stands for this character alone

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[0x21:0x7F] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".,;:!?")] = True


def _pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start of every piece; rows start pieces of their own."""
    visible = _VISIBLE[data]
    first = np.zeros(len(data), dtype=bool)
    before, after = visible[:-1], np.append(visible[2:], False)
    first[1:] = (data[1:] == 0x20) & (before | after)
    line = data[1:] == 0x0A
    first[1:] |= line & before
    first[2:] |= line[:-1] & before[:-1] & visible[2:]
    first[1:] |= _LETTER[data[:-1]] & _STOP[data[1:]]
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(first)


def _words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start of every piece that begins with a space, for rows that begin with one:
    cut before a space whose last character is neither a space nor U+2581, which stands for it."""
    first = np.zeros(len(data), dtype=bool)
    first[1:] = (data[1:] == 0x20) & (data[:-1] != 0x20)
    if len(data) > 3:
        first[3:] &= ~((data[:-3] == 0xE2) & (data[1:-2] == 0x96) & (data[2:-1] == 0x81))
    first[np.maximum(offsets[1:] - 1, 0)] = False  # a last space alone would look like an empty text
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(first)


def _blank(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes without spaces and line feeds, the piece starts and the row
    offsets among them; every such blank ends a piece."""
    kept = (data != 0x20) & (data != 0x0A)
    first = np.zeros(len(data), dtype=bool)
    first[1:] = ~kept[:-1] | (_LETTER[data[:-1]] & _STOP[data[1:]])
    first[0] = True
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    place = np.zeros(len(data) + 1, np.int32 if len(data) < 1 << 31 else np.int64)
    np.cumsum(kept, out=place[1:])
    starts = place[np.flatnonzero(first & kept)]
    out = data[kept]
    if not ((out[:-1] == 0x3C) & (out[1:] == 0x7C)).any():  # "<|" may open a special token, whose case counts
        out = _LOWER[out]
    return out, starts, place[offsets]


def ranks(name: str) -> dict[bytes, int]:
    """The entries of a file of ranks."""
    with open(public_tokenizers.path(name), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _letters(pieces: pa.Array) -> np.ndarray:
    """Which pieces are ASCII letters alone."""
    data, offsets = utf8(pieces)
    other = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~_LETTER[data], out=other[1:])
    return other[offsets[1:]] == other[offsets[:-1]]


class Encoder:
    """ids of rows of UTF-8 bytes; one per vocabulary and worker process."""

    held: dict[Vocabulary, Encoder] = {}

    def __init__(self, v: Vocabulary):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.vocabulary = v
        self.words, self.ranks = v.name.endswith(".model"), v.name.endswith(".tiktoken")
        self.closing: np.ndarray | None = None  # ids that end a word, where the vocabulary marks them
        if self.words:
            from sentencepiece import SentencePieceProcessor
            self.tokenizer = SentencePieceProcessor(model_file=public_tokenizers.path(v.name))
            if any("\u2581" in self.tokenizer.id_to_piece(i).lstrip("\u2581") for i in range(self.tokenizer.get_piece_size())):
                raise ValueError("entries of this vocabulary cross spaces")
        elif self.ranks:
            import tiktoken
            self.tokenizer = tiktoken.Encoding(v.name, pat_str=v.pattern, mergeable_ranks=ranks(v.name), special_tokens={})
        else:
            from tokenizers import Tokenizer
            self.tokenizer = Tokenizer.from_file(public_tokenizers.path(v.name))
            self.tokenizer.encode_special_tokens = v.plain_specials
            suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
            mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
            if v.blank and suffix and len(mark) == 1:
                self.mark, vocabulary = mark[0], self.tokenizer.get_vocab()
                self.closing = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
                self.closing[[i for entry, i in vocabulary.items() if entry.endswith(suffix)]] = True
        self._clear()

    def _clear(self) -> None:
        self.table = pa.array([], pa.large_binary())
        self.ids = np.zeros(0, np.int32)
        self.ends = np.zeros(1, np.int64)

    def _library(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        flat, lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, len(pieces), 4096):
            part = [p.decode("utf-8", "replace") for p in pieces[at: at + 4096].to_pylist()]
            if self.words:  # the library puts the leading space there itself
                ids = self.tokenizer.encode([p[1:] for p in part], num_threads=1)
            elif self.ranks:
                ids = list(map(self.tokenizer.encode_ordinary, part))
            else:
                ids = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            lengths.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter(chain.from_iterable(ids), np.int32, int(lengths[-1].sum())))
        return np.concatenate(flat), np.concatenate(lengths)

    def _joined(self, pieces: pa.Array, marked: bool) -> tuple[np.ndarray, np.ndarray]:
        """``_library`` for many pieces to a call: words of ASCII letters, or others without ``MARK`` (``marked``)."""
        flat, lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        glue = f"\n{MARK}\n" if marked else "\n"
        for at in range(0, len(pieces), 4096):
            part = glue.encode().join(pieces[at: at + 4096].to_pylist()).decode("utf-8", "replace").split(glue)
            texts = [glue.join(part[i: i + JOINED]) + glue for i in range(0, len(part), JOINED)]
            ids = np.fromiter(chain.from_iterable(e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)), np.int32)
            ends = np.flatnonzero(ids == self.mark if marked else self.closing[ids]) + 1
            size, own = np.diff(ends, prepend=0) - marked, ids[ids != self.mark] if marked else ids
            if len(ends) != len(part) or size.sum() != len(own):  # characters that the vocabulary lacks
                own, size = self._library(pieces[at: at + 4096])
            flat.append(own)
            lengths.append(size)
        return np.concatenate(flat), np.concatenate(lengths)

    def _by_kind(self, pieces: pa.Array, short: np.ndarray) -> np.ndarray:
        """0 for words of ASCII letters, 1 for others that share calls, 2 for other short pieces, 3 for long ones."""
        kind = np.where(short, 2, 3)
        if self.closing is not None:  # "<|" may open a special token, which takes blanks for no border
            alone = pc.or_(pc.match_substring(pieces, MARK), pc.match_substring(pieces, "<|")).to_numpy(zero_copy_only=False)
            kind[short & ~alone] = 1
            kind[short & _letters(pieces)] = 0
        return kind

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and their row offsets.  For a sentencepiece model rows have the
        space in front that it adds to a text."""
        if self.vocabulary.blank and len(data):
            data, starts, offsets = _blank(data, offsets)
        elif len(data):
            starts = (_words if self.words else _pieces)(data, offsets)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        bounds = np.append(starts, len(data)).astype(np.int64)
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        coded = column.dictionary_encode()
        if len(self.table) > self.vocabulary.table_pieces:
            self._clear()
        known = pc.index_in(coded.dictionary, value_set=self.table)
        new = np.flatnonzero(known.is_null().to_numpy(zero_copy_only=False))
        place = known.fill_null(0).to_numpy().astype(np.int64)
        ids, ends = self.ids, self.ends
        if len(new):
            # short pieces first: only these go to the table
            pieces = coded.dictionary.take(pa.array(new))
            short = pc.less_equal(pc.binary_length(pieces), self.vocabulary.table_length).to_numpy(zero_copy_only=False)
            kind = self._by_kind(pieces, short)
            order = np.argsort(kind, kind="stable")
            pieces = pieces.take(pa.array(order))
            a, b = np.searchsorted(kind[order], [1, 2]).tolist()
            more, lengths = (np.concatenate(x) for x in zip(
                self._joined(pieces[:a], False), self._joined(pieces[a:b], True), self._library(pieces[b:])))
            ids = np.concatenate((ids, more))
            ends = np.concatenate((ends, ends[-1] + np.cumsum(lengths)))
            place[new[order]] = len(self.table) + np.arange(len(new))
            kept = int(short.sum())
            self.table = pa.concat_arrays([self.table, pieces[:kept]])
            self.ends = ends[: len(self.table) + 1]
            self.ids = ids[: self.ends[-1]]
        rank = place[coded.indices.to_numpy(zero_copy_only=False)]
        out = np.zeros(len(rank) + 1, np.int64)
        np.cumsum(np.diff(ends)[rank], out=out[1:])
        flat = np.empty(out[-1], np.int32)
        for at in range(0, len(rank), GATHER):
            part, to = rank[at: at + GATHER], out[at: at + GATHER + 1]
            flat[to[0]: to[-1]] = ids[np.repeat(ends[part] - to[:-1], np.diff(to)) + np.arange(to[0], to[-1])]
        return flat, out[np.searchsorted(starts, offsets)]

    @classmethod
    def of(cls, v: Vocabulary) -> Encoder:
        if v not in cls.held:
            cls.held[v] = cls(v)
        return cls.held[v]
