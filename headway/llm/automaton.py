"""BPE as a deterministic automaton over tokens.

The automaton begins with one state that loops on every base symbol.  Each merge
(u, v), in order, is one gadget: wherever u can be read and then v, the arc uv is
added, and the arcs of u are led to a copy of the state behind u that no longer
has the arc v.  What remains are exactly the token sequences that merging gives,
and each string has one path.  The state behind a token depends on that token
alone, and a state is its parent less one arc; with the arcs that were later made
from that arc these are one run of tokens, once tokens stand in the post-order of
their left parts.  So the transition table is, for each state, a sorted list of
runs of missing arcs, a few megabytes for a vocabulary of 50,000 tokens where a
full table would have 10**9 fields.

Encoding reads a pre-split word by that table: from each position, whose state is
known, it reads the tokens that begin there and keeps those that the state has an
arc for; the one path that ends with the word is the encoding.  No merge is ever
searched or ranked.  Decoding emits the labels of the arcs.

Normalisation and pre-splitting follow the tokenizer's own file.  Texts of plain
Latin characters are split at white space, and each distinct piece is split and
encoded once; all others take the library's normaliser and pre-tokenizer.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import ship_code, worker_state

#: Distinct pieces that a worker keeps; later ones are encoded each time they come.
CACHE_PIECES = 300_000
#: Longer pieces are not kept.
KEPT_LENGTH = 128

# Characters that NFC leaves alone and that lower-case alike everywhere; everything else takes the library's way.
_PLAIN = re.compile("[\t\n\r -~\u00a1-\u012f\u0131-\u024f]*")


class MergeAutomaton:
    """The deterministic token automaton of an ordered merge list.

    ``vocab`` maps tokens to ids, ``merges`` are pairs of tokens in their order, and
    every token that is no merge's result is a base symbol.  A merge whose parts do
    not exist yet, or a second merge with the same result, is an error: such a list
    is not one that training can give, and the gadgets would not be equal to it.
    """

    def __init__(self, vocab: dict[str, int], merges: Sequence[tuple[str, str]]):
        made = {a + b for a, b in merges}
        state = {t: 0 for t in vocab if t not in made}  # the state behind each token; 0 is the start
        parent, gone, since = [0], [""], [-1]  # of each state: the state it copies, less which arc, from which merge on
        children: dict[str, list[str]] = {}
        order: dict[str, int] = {}  # the merge that made a token
        left: dict[str, str] = {}  # the left part of a token
        never: set[str] = set()  # tokens that no path has, as an earlier merge always takes a part of them
        for k, (u, v) in enumerate(merges):
            if u + v in order or u + v in never or u + v not in vocab or not all(t in state or t in never for t in (u, v)):
                raise ValueError(f"merge {k} ({u!r}, {v!r}) does not follow from those before it")
            if u in never or v in never or self._lacks(state[u], v, left, order, parent, gone, since):
                never.add(u + v)
                continue
            before = state[u]
            order[u + v] = k
            left[u + v] = u
            children.setdefault(u, []).append(u + v)
            # The new arc ends where v ended; a pair of the same token ends behind it as it was, where it may be read again.
            state[u + v] = before if u == v else state[v]
            parent.append(before)
            gone.append(v)
            since.append(k)
            state[u] = len(parent) - 1
        orders = {u: [order[t] for t in made_from] for u, made_from in children.items()}
        place, begin = self._post_order([t for t in state if t not in order], children)
        self.ids = {t: vocab[t] for t in state}
        # Numbers of the states that are still behind some token; the others were copied and left.
        used = sorted({0, *state.values()})
        number = {s: n for n, s in enumerate(used)}
        self.row, self.low, self.high = array("q", [0]), array("i"), array("i")
        for s in used:
            for lo, hi in _joined(self._missing(s, parent, gone, since, children, orders, place, begin)):
                self.low.append(lo)
                self.high.append(hi)
            self.row.append(len(self.low))
        self.place = array("i", [0]) * (max(vocab.values(), default=-1) + 1)
        self.behind = array("i", [0]) * len(self.place)
        for t, s in state.items():
            self.place[vocab[t]] = place[t]
            self.behind[vocab[t]] = number[s]
        self.states = len(used)
        # The tokens as a table from strings; -1 for a string that only begins a longer token.
        self.reads: dict[str, int] = {}
        for t, i in self.ids.items():
            self.reads[t] = i
        for t in self.ids:
            for j in range(1, len(t)):
                self.reads.setdefault(t[:j], -1)

    @staticmethod
    def _lacks(s, token, left, order, parent, gone, since) -> bool:
        """Has state ``s`` no arc for ``token``: was it taken away, or one that it was made from, before it was made?"""
        made = {token: 1 << 62}  # each token that it begins with, and when that was last extended
        while token in left:
            made[left[token]] = order[token]
            token = left[token]
        while s:
            if gone[s] in made and made[gone[s]] >= since[s]:
                return True
            s = parent[s]
        return False

    @staticmethod
    def _post_order(roots: list[str], children: dict[str, list[str]]) -> tuple[dict[str, int], dict[str, int]]:
        """The place of each token after all tokens that begin from it, later-made ones last, and the first place below it."""
        place, begin, n = {}, {}, 0
        for root in roots:
            stack = [(root, False)]
            while stack:
                t, done = stack.pop()
                if done:
                    place[t] = n
                    n += 1
                    continue
                begin[t] = n
                stack.append((t, True))
                stack.extend((c, False) for c in reversed(children.get(t, ())))
        return place, begin

    @staticmethod
    def _missing(s, parent, gone, since, children, orders, place, begin) -> list[tuple[int, int]]:
        """Runs of places whose arcs state ``s`` lacks: an arc taken away, and all arcs made from it since."""
        runs = []
        while s:
            token = gone[s]
            later = bisect_left(orders.get(token, ()), since[s])
            own = children.get(token, ())
            runs.append((begin[own[later]] if later < len(own) else place[token], place[token]))
            s = parent[s]
        return sorted(runs)

    def has_arc(self, state: int, token: int) -> bool:
        at = self.place[token]
        k = bisect_right(self.low, at, self.row[state], self.row[state + 1]) - 1
        return k < self.row[state] or at > self.high[k]

    def encode(self, word: str) -> list[int]:
        """The ids of one pre-split word, in whose string the last character is its symbol at a word's end.

        Reads the longest tokens first and steps back where a path ends early.  A
        position is entered once at most, as one path leads to it.
        """
        n = len(word)
        reads, low, high, row, place, behind = self.reads.get, self.low, self.high, self.row, self.place, self.behind
        path: list[int] = []
        ahead: list[list[tuple[int, int]]] = []  # for each step of the path, shorter tokens not yet tried, longest last
        i, state = 0, 0
        while i < n:
            first, last = row[state], row[state + 1]
            arcs = []
            for j in range(i + 1, n + 1):
                token = reads(word[i:j])
                if token is None:
                    break
                if token >= 0:
                    arcs.append((token, j))
            ahead.append(arcs)
            while True:
                if not ahead:
                    raise ValueError(f"no path for {word!r}")
                arcs = ahead[-1]
                taken = -1
                while arcs:
                    token, j = arcs.pop()
                    k = bisect_right(low, place[token], first, last) - 1
                    if k < first or place[token] > high[k]:
                        taken = token
                        break
                if taken >= 0:
                    path.append(taken)
                    i, state = j, behind[taken]
                    break
                ahead.pop()
                if path:
                    path.pop()
                state = behind[path[-1]] if path else 0
                first, last = row[state], row[state + 1]
        return path


def _joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted runs without overlaps."""
    out: list[tuple[int, int]] = []
    for lo, hi in runs:
        if out and lo <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 bytes stand for
    themselves, the others for the characters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


#: Marks the last symbol of a word: its character plus this.
_ENDS = 0x10000


class Codec:
    """Texts to ids and back, with the automaton of a tokenizer file.

    Supported are BPE models without dropout, unknown tokens, prefixes or byte
    fallback, with a word-end suffix or none, whose pre-tokenizer ends in byte-level
    mapping without a decoder.  Anything else is an error, not a different result.
    """

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
        steps = pre.get("pretokenizers", [pre])
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
        if model["type"] != "BPE" or not plain or spec["decoder"] or not byte_level.items() <= steps[-1].items():
            raise ValueError(f"not a tokenizer that the automaton can stand for: {path}")
        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.suffix = model["end_of_word_suffix"] or ""
        mark = lambda t: t[: -len(self.suffix) - 1] + chr(ord(t[-len(self.suffix) - 1]) + _ENDS) if self._ends(t) else t
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.automaton = MergeAutomaton({mark(t): i for t, i in model["vocab"].items()}, [(mark(a), mark(b)) for a, b in merges])
        self.labels = {i: t for t, i in model["vocab"].items()}
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in spec["added_tokens"]):
            raise ValueError(f"added tokens with options: {path}")
        self.labels.update({i: t for t, i in self.added.items()})
        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.byte = _byte_characters()
        self.split = self._plain_split(spec)
        self.cache_pieces = cache_pieces
        self.cache: dict[str, bytes] = {}

    def _ends(self, token: str) -> bool:
        return bool(self.suffix) and len(token) > len(self.suffix) and token.endswith(self.suffix)

    @staticmethod
    def _plain_split(spec: dict) -> re.Pattern | None:
        """The file's own splitting pattern for plain lower-case Latin pieces; None where it is not of the known kind
        (white space collapsed, lower-cased, matches of one pattern kept), so that the library does all."""
        normalizer = spec["normalizer"] or {}
        kinds = [(n["type"], n.get("content")) for n in normalizer.get("normalizers", [normalizer] if normalizer else [])]
        steps = spec["pre_tokenizer"].get("pretokenizers", [])
        first = steps[0] if len(steps) == 2 else {}
        known = kinds == [("NFC", None), ("Replace", " "), ("Lowercase", None)]
        if not known or (first.get("type"), first.get("behavior"), first.get("invert")) != ("Split", "Removed", True):
            return None
        pattern = first["pattern"].get("Regex")
        if not pattern or re.search(r"\\p\{(?![LN]\})", pattern):
            return None
        letters, numbers = ("".join(re.escape(chr(c)) for c in range(0x21, 0x250) if unicodedata.category(chr(c))[0] == k) for k in "LN")
        for name, characters in ((r"\p{L}", letters), (r"\p{N}", numbers)):
            pattern = "".join(_in_class(pattern, name, characters))
        return re.compile(pattern)

    def _word(self, mapped: str) -> list[int]:
        """Ids of a word of byte characters."""
        if self.suffix:
            mapped = mapped[:-1] + chr(ord(mapped[-1]) + _ENDS)
        return self.automaton.encode(mapped)

    def _piece(self, piece: str) -> bytes:
        """Ids of a lower-case plain piece without white space."""
        out: list[int] = []
        byte = self.byte
        for word in self.split.findall(piece):
            out += self._word(word if word.isascii() else "".join([byte[b] for b in word.encode()]))
        return array("I", out).tobytes()

    def _segment(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        if self.split is not None and _PLAIN.fullmatch(text):
            pieces = text.lower().split()
            get = self.cache.get
            found = list(map(get, pieces))
            if None in found:
                for k, ids in enumerate(found):
                    if ids is None:
                        piece = pieces[k]
                        ids = get(piece)
                        if ids is None:
                            ids = self._piece(piece)
                            if len(piece) <= KEPT_LENGTH and len(self.cache) < self.cache_pieces:
                                self.cache[piece] = ids
                        found[k] = ids
            return b"".join(found)
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        out = array("I")
        for word, _ in self.pre_tokenizer.pre_tokenize_str(text):
            if word:
                out.extend(self._word(word))
        return out.tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text."""
        if self.special is None or not self.special.search(text):
            return self._segment(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [self._segment(text[at : m.start()]), array("I", [self.added[m[0]]]).tobytes()]
            at = m.end()
        return b"".join([*out, self._segment(text[at:])])

    def decode(self, ids: bytes) -> str:
        """The labels of the ids' arcs, joined as the library joins tokens where a file names no decoder; ids that the
        vocabulary lacks have none."""
        label = self.labels.get
        return " ".join([t for t in map(label, np.frombuffer(ids, dtype="<u4").tolist()) if t is not None])


def _in_class(pattern: str, name: str, characters: str) -> Iterator[str]:
    """``pattern`` with a named class written out, in brackets of its own where it stands outside of any."""
    depth = 0
    for k, part in enumerate(re.split(f"({re.escape(name)})", pattern)):
        if k % 2:
            yield characters if depth else f"[{characters}]"
        else:
            for c in re.findall(r"\\.|[\[\]]", part):
                depth += (c == "[") - (c == "]")
            yield part


def codec(path: str) -> Codec:
    """One codec for each Python worker and vocabulary file."""
    return worker_state("automaton", path, lambda: Codec(path))


def encode_documents(
    docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", digests: bool = False
) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit, packed).

    With ``digests`` the ids are decoded again in the same task, and instead of them
    come ``ids_sha256`` and ``decoded_sha256`` (of the UTF-8 text), so that neither
    leaves the task.  A null text counts as empty and has no ids; texts and words of
    any length are encoded whole, in time linear in their length; repeated rows and
    ids stay rows; an empty table gives no rows; other columns are not read, whatever
    their names.
    """
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer_path)
        for batch in batches:
            found = [own.encode(t or "") for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array([len(x) // 4 for x in found], pa.int64())]
            if digests:
                columns.append(pa.array([hashlib.sha256(x).hexdigest() for x in found], pa.string()))
                columns.append(pa.array([hashlib.sha256(own.decode(x).encode()).hexdigest() for x in found], pa.string()))
            else:
                columns.append(pa.array(found, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    sent = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = sent.schema["doc_id"].dataType.simpleString()
    given = "ids_sha256 string, decoded_sha256 string" if digests else "ids binary"
    names = ["doc_id", "n_tokens", *[x.split(" ")[0] for x in given.split(", ")]]
    return sent.mapInArrow(run, f"doc_id {kind}, n_tokens long, {given}")


def decode_documents(encoded: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id`` and ``decoded`` for each row of packed ids; null ids give an empty text."""
    ship_code(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer_path)
        for batch in batches:
            found = [own.decode(x or b"") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["doc_id", "decoded"])

    sent = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return sent.mapInArrow(run, f"doc_id {sent.schema['doc_id'].dataType.simpleString()}, decoded string")
