"""Token ids of texts by a public byte-level BPE, whose files are a parameter.

The ids are those of the ``tokenizers`` library without added special tokens.
Where its faster sibling ``tiktoken`` over the same vocabulary gives equal ids
(texts within U+0000 to U+024F that do not spell a special token, checked
code point by code point in the tests), that one is used.

Many texts are faster together: a space before anything but white space always
begins a pre-token, whatever stands around it, so texts are cut there and each
different piece is encoded once, those not met before in one call.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

#: Vocabulary of 50,257 ids; 50,256 ends a document.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: fixed values: texts that spell a special token of the vocabulary
SPECIAL = ("<|endoftext|>",)

_BEYOND = re.compile("[^\x00-ɏ]")

#: fixed values: white space of the pre-token pattern up to U+024F
_WHITE = "\t-\r \x85\xa0"
_CUT = re.compile(f" (?=[^{_WHITE}])")
_LOOSE = r" ([\t-\r \x{85}\x{a0}]|\z)"

#: Characters of texts that are encoded together, and bytes of pieces that a process remembers.
TOGETHER, REMEMBERED = 4_000_000, 2_500_000


@lru_cache(maxsize=1)
def _plain(vocabulary: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary)


@lru_cache(maxsize=1)
def _ordinary(vocabulary: str):
    """The same tokenizer without special tokens: text that spells one is text like any other."""
    from tokenizers import Tokenizer
    with open(vocabulary, encoding="utf-8") as f:
        parts = json.load(f)
    return Tokenizer.from_str(json.dumps(parts | {"added_tokens": []}))


@lru_cache(maxsize=1)
def _fast(ranks: str):
    import tiktoken
    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def encode(text: str, vocabulary: str = VOCABULARY, ranks: str | None = RANKS) -> np.ndarray:
    """Ids of the whole text as unsigned 32-bit numbers. Each library is loaded by the first text that needs it."""
    if ranks is not None and not _BEYOND.search(text) and not any(s in text for s in SPECIAL):
        return np.array(_fast(ranks).encode_ordinary(text), np.uint32)
    return np.array(_plain(vocabulary).encode(text, add_special_tokens=False).ids, np.uint32)


def encode_ordinary(text: str, vocabulary: str = VOCABULARY, ranks: str | None = RANKS) -> np.ndarray:
    """As ``encode``, but a special token that the text spells is encoded as ordinary text, so its id never occurs."""
    if ranks is not None and not _BEYOND.search(text):
        return np.array(_fast(ranks).encode_ordinary(text), np.uint32)
    tokenizer = _ordinary if any(s in text for s in SPECIAL) else _plain
    return np.array(tokenizer(vocabulary).encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=1)
def _widths(ranks: str) -> np.ndarray:
    """Bytes of each id."""
    table = _fast(ranks)._mergeable_ranks
    out = np.zeros(max(table.values()) + 1, np.int64)
    out[list(table.values())] = [len(token) for token in table]
    return out


class _Known:
    """Pieces that this process has met, the space before each left out, and their ids one after the other."""

    def __init__(self, ranks: str):
        self.ranks = ranks
        self.forget()

    def forget(self) -> None:
        self.words, self.ids, self.ends = pa.array([], pa.string()), np.empty(0, np.uint32), np.empty(0, np.int64)

    def ids_of(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all known pieces, where each piece's end, and which of them are the different ``words``."""
        if self.words.nbytes > REMEMBERED:
            self.forget()
        places = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(False).astype(np.int64)
        fresh = np.flatnonzero(places < 0)
        if len(fresh):
            places[fresh] = len(self.words) + np.arange(len(fresh))
            new = words.take(pa.array(fresh))
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(new)], pa.int32()), new), " ")[0].as_py()
            ids = np.array(_fast(self.ranks).encode_ordinary(" " + text), np.uint32)
            ends = np.cumsum(pc.binary_length(new).to_numpy() + np.int64(1))
            ends = np.searchsorted(np.cumsum(_widths(self.ranks)[ids]), ends) + 1 + len(self.ids)
            self.words = pa.concat_arrays([self.words, new])
            self.ids, self.ends = np.concatenate([self.ids, ids]), np.concatenate([self.ends, ends])
        return self.ids, self.ends, places


@lru_cache(maxsize=1)
def _known(ranks: str) -> _Known:
    return _Known(ranks)


def _by_pieces(pieces: pa.ListArray, ranks: str) -> list[np.ndarray]:
    """Ids of texts cut at spaces; all pieces but a text's first begin with the space that is left out."""
    fast = _fast(ranks)
    edges = pieces.offsets.to_numpy()
    every = pieces.values
    rest = np.ones(len(every), bool)
    rest[edges[:-1]] = False
    coded = every.filter(pa.array(rest)).dictionary_encode()
    ids, ends, places = _known(ranks).ids_of(coded.dictionary)
    sizes, which = np.diff(ends, prepend=0), places[coded.indices.to_numpy()]
    size = sizes[which]
    to = np.append(0, np.cumsum(size))
    at = np.repeat((ends - sizes)[which] - to[:-1], size)
    at += np.arange(len(at))
    spaced = ids[at]
    bounds = to[edges - np.arange(len(edges))].tolist()
    return [np.concatenate([np.array(fast.encode_ordinary(h), np.uint32), spaced[a:b]])
            for h, a, b in zip(every.take(pa.array(edges[:-1])).to_pylist(), bounds, bounds[1:])]


def _together(texts: list[str], vocabulary: str, ranks: str) -> Iterator[np.ndarray]:
    every = pa.array(texts, pa.string())
    other = pc.match_substring_regex(every, r"[^\x00-\x{24f}]").to_numpy(False)
    for special in SPECIAL:
        other = other | pc.match_substring(every, special).to_numpy(False)
    other = other | (pc.binary_length(every).to_numpy() > TOGETHER)
    spaced = pc.match_substring_regex(every, _LOOSE).to_numpy(False)
    plain, loose = np.flatnonzero(~other & ~spaced).tolist(), np.flatnonzero(~other & spaced).tolist()
    found: dict[int, np.ndarray] = {}
    if plain:
        found.update(zip(plain, _by_pieces(pc.split_pattern(every.take(pa.array(plain)), " "), ranks)))
    if loose:
        found.update(zip(loose, _by_pieces(pa.array([_CUT.split(texts[i]) for i in loose], pa.list_(pa.string())), ranks)))
    for i, t in enumerate(texts):
        yield found.pop(i) if i in found else encode(t, vocabulary, ranks)


def encode_all(texts: Iterable[str], vocabulary: str = VOCABULARY, ranks: str | None = RANKS) -> Iterator[np.ndarray]:
    """``encode`` of each text, in order."""
    some: list[str] = []
    held = 0
    for t in texts:
        if ranks is None:
            yield encode(t, vocabulary, ranks)
            continue
        some.append(t)
        held += len(t)
        if held >= TOGETHER:
            yield from _together(some, vocabulary, ranks)
            some, held = [], 0
    if some:
        yield from _together(some, vocabulary, ranks)
