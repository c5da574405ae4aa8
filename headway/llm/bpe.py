"""Exact byte-level BPE encoding with a cache of short units.

The ids are the ``tokenizers`` library's own.  Its pre-tokenizer never lets a
token cross from a non-space character into a following space or line feed, nor
from a letter or digit into a punctuation mark, so a text may be cut before each
single space, around each single line feed and before such a mark, the pieces
encoded once each, and their ids joined.  Corpora repeat most of their words,
which makes this several times faster than encoding every text from scratch.
The texts given at a time are cut together, as Arrow arrays, and each different
unit of them is looked up once.  A text where those cuts could change the result
(runs of white space, control characters, characters beyond Latin) is given to
the library whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from headway.llm.common import worker_state

#: Distinct units that one worker keeps, about; the others are encoded whenever they come.
CACHE_UNITS = 400_000

# Code points of a unit that is kept, at most.
_LONGEST = 64

# Places by hash for the units that came once: a power of two, less one.
_SEEN = (1 << 22) - 1

# Kinds of UTF-8 bytes. Printable Latin text (line feeds, U+0020 to U+007E, U+00A1 to U+024F) is cut; odd bytes
# are of other texts, which take the library's own path. U+0080 to U+00A0 and U+0250 to U+027F have leads in common with it.
_WHITE, _ODD, _LEAD, _ALNUM, _MARK = 1, 2, 3, 4, 5
_KINDS = np.zeros(256, dtype=np.uint8)
_KINDS[0x21:0x7F] = _MARK
_KINDS[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = _ALNUM
_KINDS[0x27] = 0  # an apostrophe may begin a token of letters
_KINDS[:0x20] = _KINDS[0x7F] = _KINDS[0xCA:] = _ODD
_KINDS[[0x20, 0x0A]] = _WHITE
_KINDS[[0xC2, 0xC9]] = _LEAD


class Encoder:
    """``encode(texts)`` gives one little-endian uint32 id buffer per text."""

    def __init__(self, tokenizer_path: str, cache_units: int = CACHE_UNITS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one thread for each Spark task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.encode_special_tokens = True  # special tokens' strings in a text are ordinary text
        size = self.tokenizer.get_vocab_size()
        self.opens = np.zeros(size, dtype=bool)  # tokens that start with a space
        for token, i in self.tokenizer.get_vocab().items():
            self.opens[i] = token.startswith("Ġ")
        self.line_feed = self.tokenizer.token_to_id("Ċ")
        self.cache_units = cache_units
        self.cache: dict[str, bytes] = {}
        self.seen = bytearray(_SEEN + 1)  # by hash, the units that came once

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _learn(self, units: list[str]) -> dict[str, bytes]:
        """The ids of units, most of them in joined runs that are cut again.

        Words with a space before them are cut where a token starts with a space, others where a line feed was put.
        """
        found: dict[str, bytes] = {}
        alone = [u for u in units if u in (" ", "\n")]
        spaced = [u for u in units if len(u) > 1 and u[0] == " "]
        rest = [u for u in units if u[0] not in " \n"]
        for words, between, skip in ((spaced, "", 0), (rest, "\n", 4)):
            for i in range(0, len(words), 4096):
                part = words[i : i + 4096]
                ids = np.array(self.tokenizer.encode_batch_fast([between.join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
                at = (np.flatnonzero(ids == self.line_feed if between else self.opens[ids]) * 4).tolist()
                at = [-skip, *at] if between else at
                if len(at) != len(part):  # not expected; the plain way is always right
                    found.update(zip(part, self._whole(part), strict=True))
                    continue
                raw = ids.tobytes()
                found.update(zip(part, [raw[j + skip : k] for j, k in zip(at, [*at[1:], len(raw)], strict=True)], strict=True))
        if alone:
            found.update(zip(alone, self._whole(alone), strict=True))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Every different unit of ``texts`` is looked up once; the ids of all texts are then taken by the units' numbers."""
        array = pa.array(texts, pa.large_string())
        at = np.frombuffer(array.buffers()[1], np.int64, len(texts) + 1) if texts else np.zeros(1, np.int64)
        if not at[-1]:
            return [b""] * len(texts)
        cuts, whole = _cuts(np.frombuffer(array.buffers()[2], np.uint8, at[-1]), at)
        coded = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), array.buffers()[2]).dictionary_encode()
        codes = coded.indices.to_numpy()
        units = np.searchsorted(cuts, at)  # each text's first
        ids = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), np.bincount(codes).tolist(), codes[units[whole]].tolist())
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(lengths) - lengths
        n = lengths[codes]
        ends = np.cumsum(n)
        places = np.repeat(first[codes] - (ends - n), n)
        places += np.arange(len(places))
        raw = np.frombuffer(b"".join(ids), "<u4")[places].tobytes()
        bounds = (np.concatenate([[0], ends])[units] * 4).tolist()
        return [raw[i:j] for i, j in zip(bounds, bounds[1:], strict=False)]

    def _ids(self, units: list[str], times: list[int], whole: list[int]) -> list[bytes]:
        """The ids of different units, which came so many times; those numbered ``whole`` are texts."""
        ids: list[bytes | None] = list(map(self.cache.get, units))
        for k in whole:
            ids[k] = self._whole([units[k]])[0]
        missing = [k for k, known in enumerate(ids) if known is None]
        if missing:
            found = self._learn([units[k] for k in missing])
            for k in missing:
                ids[k] = found[units[k]]
            if len(self.cache) < self.cache_units:
                self._keep([units[k] for k in missing if times[k] == 1], [units[k] for k in missing if times[k] > 1], found)
            elif 2 * len(missing) > len(units):  # other texts than those the cache was filled from
                self.cache, self.seen = {}, bytearray(_SEEN + 1)
        return ids

    def _keep(self, once: list[str], often: list[str], found: dict[str, bytes]) -> None:
        """Keep what came often, or once and before; most different words of a corpus never come again."""
        seen = self.seen
        for u in once:
            at = hash(u) & _SEEN
            if seen[at]:
                often.append(u)
            else:
                seen[at] = 1
        self.cache.update([(u, found[u]) for u in often if len(u) <= _LONGEST])


def _cuts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the units of texts begin, and the end; the numbers of the texts that stay whole.

    ``data`` are the texts' UTF-8 bytes and ``at`` where each begins, and the end.
    """
    kinds = _KINDS[data]
    white = kinds == _WHITE
    odd = kinds == _ODD
    if (leads := np.flatnonzero(kinds == _LEAD)).size:  # the next byte decides
        after = data[leads + 1]
        odd[leads] = np.where(data[leads] == 0xC2, after <= 0xA0, after > 0x8F)
    pairs = white[1:] & white[:-1]
    starts = at[(at > 0) & (at < len(data))]
    pairs[starts - 1] = False  # of two texts
    odd[1:] |= pairs
    whole = np.unique(np.searchsorted(at, np.flatnonzero(odd), side="right") - 1)
    mark = np.zeros(len(data) + 1, dtype=bool)
    mark[:-1] = white
    mark[1:] |= data == 0x0A
    marks = np.flatnonzero(kinds[1:] == _MARK) + 1
    mark[marks[kinds[marks - 1] == _ALNUM]] = True
    if (marks := marks[data[marks - 1] >= 0x80]).size:
        lead, last = data[marks - 2], data[marks - 1]
        mark[marks[(lead > 0xC3) | (lead == 0xC3) & (last != 0x97) & (last != 0xB7)]] = True  # all but the signs of times and division
    for k in whole.tolist():
        mark[at[k] + 1 : at[k + 1]] = False
    mark[at] = True
    return np.flatnonzero(mark), whole


def encoder(tokenizer_path: str) -> Encoder:
    """One encoder for each Python worker and vocabulary file."""
    return worker_state("bpe", tokenizer_path, lambda: Encoder(tokenizer_path))
