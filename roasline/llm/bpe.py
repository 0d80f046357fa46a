"""Byte-level BPE by a tokenization automaton.

The automaton accepts exactly the token sequences that BPE can produce.  Its states are the last
token read; the arc from state `a` labelled with token `b` exists when no merge would join across
the boundary.  It is compiled by adding one gadget per merge, in rank order: the gadget of merge
``u v -> w`` adds state w, records its two inner arcs, and forbids reading v after u at that rank.
An arc a -> b is decided by undoing the gadgets on both sides of the boundary, latest first, and
looking for a gadget that would have fired before; each decision is entered in the transition table
once, so encoding is table look-ups.  Every prefix of a word has one accepting path, so the search
for it reads the longest label first and never visits a dead position twice.  Decoding follows the ids and emits their arc labels (bytes).

The vocabulary and merges come from a tokenizer file (`path` is a parameter), read on the driver
and broadcast; its size does not grow with the input.

Edge cases: a null or empty text has no ids and decodes to the empty text; special tokens of the
file found in a text are their own ids; repeated rows are encoded each; null ids are carried; an
empty table gives an empty result; extra columns with other names are carried by `encode`.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

# Fixed value: the pre-split of byte-level BPE vocabularies of this family.
PRE_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Pieces between which no pre-split token reaches: a run without white space and one space before it, or
# white space.  The class is Unicode's White_Space.
SPACE = r" \t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
CACHE_WORDS = 500_000
CACHE_CHARS = 48


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte: printable Latin-1 for itself, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class Automaton:
    """States are token ids, -1 is the start."""

    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        model, self.split = spec["model"], regex.compile(PRE_SPLIT)
        of_char = byte_alphabet()
        vocab = {text: n for text, n in model["vocab"].items()}
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special = special
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.labels: dict[int, bytes] = {}
        self.by_label: dict[bytes, int] = {}
        for text, n in vocab.items():
            if text not in special:
                self.labels[n] = bytes(of_char[c] for c in text)
        for text, n in special.items():
            self.labels[n] = text.encode()
        self.texts = {n: str(n) for n in self.labels}
        # single-byte states, then one gadget a merge
        self.rank: dict[int, int] = {}
        self.inner: dict[int, tuple[int, int]] = {}
        self.fires: dict[tuple[int, int], int] = {}
        for n, label in self.labels.items():
            if len(label) == 1:
                self._state(n, -1)
        for rank, pair in enumerate(model["merges"]):
            u, v = pair if isinstance(pair, list) else pair.split(" ")
            self._gadget(rank, vocab[u], vocab[v], vocab[u + v])
        self.longest: dict[bytes, int] = {}
        for label in self.by_label:
            for head in (label[:1], label[:3]):
                self.longest[head] = max(len(label), self.longest.get(head, 0))
        self.arcs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}

    def _state(self, token: int, rank: int) -> None:
        self.rank[token] = rank
        self.by_label[self.labels[token]] = token

    def _gadget(self, rank: int, u: int, v: int, w: int) -> None:
        self.fires.setdefault((u, v), rank)
        # w becomes a state if the automaton so far still reads u and then v
        if w not in self.rank and u in self.rank and v in self.rank and self._decide(u, v, rank):
            self.inner[w] = (u, v)
            self._state(w, rank)

    def arc(self, a: int, b: int) -> bool:
        """May token b follow token a?"""
        if len(self.arcs) > 4 * CACHE_WORDS:
            self.arcs.clear()
        known = self.arcs.get((a, b))
        if known is None:
            known = self.arcs[(a, b)] = self._decide(a, b)
        return known

    def _decide(self, a: int, b: int, before: float = float("inf")) -> bool:
        # a merge across the boundary must fire before `before` (at the same rank the left one goes first)
        while True:
            fired = self.fires.get((a, b))
            if fired is not None and fired < before:
                return False
            ra, rb = self.rank[a], self.rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                before, a = min(before, ra), self.inner[a][1]
            else:
                before, b = min(before, rb + 0.5), self.inner[b][0]

    def path(self, word: bytes) -> list[int]:
        """Ids of one pre-split word: the automaton's accepting path.

        Reads the longest label first and steps back from dead ends; a position has one path at
        most, so one found dead is never tried again.
        """
        whole = self.by_label.get(word)
        if whole is not None:
            return [whole]
        size, find, longest, arcs = len(word), self.by_label.get, self.longest, self.arcs
        ids, ends, dead = [], [0], set()
        at = cut = 0
        while at < size:
            head = word[at : at + 3]
            end = min(size, at + max(longest.get(head, 2), 2))
            if cut:
                end, cut = cut, 0
            last = ids[-1] if ids else -1
            while end > at:
                token = find(word[at:end])
                if token is not None and end not in dead and (last < 0 or (arcs.get((last, token)) or self.arc(last, token))):
                    ids.append(token)
                    ends.append(end)
                    at = end
                    break
                end -= 1
            else:
                dead.add(at)
                ids.pop()
                cut = ends.pop() - 1
                at = ends[-1]
        return ids

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if self.at_special is not None and any(s in text for s in self.special):
            parts = self.at_special.split(text)
            return list(chain.from_iterable([self.special[p]] if p in self.special else self._words(p) for p in parts if p))
        return self._words(text)

    def _words(self, text: str) -> list[int]:
        pieces, found = self.pieces, PIECES.findall(text)
        missing = set(found).difference(pieces)
        if len(pieces) + len(missing) > CACHE_WORDS:
            pieces.clear()
            missing = set(found)
        for piece in missing:
            words = self.split.findall(piece)
            pieces[piece] = tuple(n for w in words for n in self.path(w.encode()))
        ids = list(chain.from_iterable(map(pieces.__getitem__, found)))
        for piece in missing:
            if len(piece) > CACHE_CHARS:
                del pieces[piece]
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


_compiled: dict[str, Automaton] = {}


def compiled(tokenizer_json: str) -> Automaton:
    """One automaton a Python process."""
    key = hashlib.sha256(tokenizer_json.encode()).hexdigest()
    if key not in _compiled:
        _compiled[key] = Automaton(tokenizer_json)
        gc.freeze()  # the tables stay: the collector need not walk them again
    return _compiled[key]


def encode(documents: DataFrame, path: str, with_ids: bool = True, text_col: str = "text") -> DataFrame:
    """All columns of `documents` but the text, plus n_tokens, ids_sha256, decoded_sha256 and, if asked, ids."""
    with open(path, encoding="utf-8") as file:
        tokenizer = documents.sparkSession.sparkContext.broadcast(file.read())
    own = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]
    carried = [c for c in documents.columns if c not in own and c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = compiled(tokenizer.value)
        texts = automaton.texts
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                count, ids_sha, decoded_sha, kept = [], [], [], []
                for text in part.column(text_col).to_pylist():
                    ids = automaton.encode(text or "")
                    count.append(len(ids))
                    ids_sha.append(hashlib.sha256(",".join(map(texts.__getitem__, ids)).encode()).hexdigest())
                    decoded_sha.append(hashlib.sha256(automaton.decode(ids).encode()).hexdigest())
                    if with_ids:
                        kept.append(ids)
                arrays = [pa.array(count, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)]
                arrays += [pa.array(kept, pa.list_(pa.int32()))] if with_ids else []
                yield pa.RecordBatch.from_arrays([part.column(c) for c in carried] + arrays, names=[*carried, *own])

    kinds = {f.name: f.dataType.simpleString() for f in documents.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in carried] + ["n_tokens long, ids_sha256 string, decoded_sha256 string"] + (["ids array<int>"] if with_ids else []))
    return documents.select(*[F.col(f"`{c}`") for c in carried], text_col).mapInArrow(run, schema)
