"""Byte-pair merges of many words at once.

The words' symbols lie in one array.  In every round each word that still has a known pair merges
its pair of lowest rank, the leftmost of equal ones, which is the order in which merges apply to a
single word; words without a known pair are done and leave the array.
"""

from __future__ import annotations

import json

import numpy as np

NONE = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The letter that byte-level files write for each byte: itself where it is printable, else the next from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Merges:
    """Merge ranks of a byte-level BPE file with a word-end suffix."""

    def __init__(self, text: str):
        model = json.loads(text)["model"]
        vocab, closing = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.inner, self.last = (np.array([vocab.get(c + end, -1) for c in byte_letters()], np.int64) for end in ("", closing))
        self.usable = bool(closing) and not model.get("continuing_subword_prefix") and not model.get("dropout") and not model.get("ignore_merges") and (self.inner >= 0).all() and (self.last >= 0).all()
        self.width = max(vocab.values()) + 1
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        code = left * self.width + right
        order = np.argsort(code, kind="stable")
        self.code, self.rank = code[order], order
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left * self.width + right
        place = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where(self.code[place] == code, self.rank[place], NONE)

    def encode(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, ids of each word) for words of `size` bytes, none empty."""
        ends = np.cumsum(size) - 1
        token = self.inner[data]
        token[ends] = self.last[data[ends]]
        word = np.repeat(np.arange(len(size)), size)
        out_token, out_word = [], []
        inside = word[1:] == word[:-1]
        rank = np.full(len(token), NONE)
        at = np.flatnonzero(inside)
        rank[at] = self.ranks(token[at], token[at + 1])
        while len(token):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, first)
            length = np.diff(np.append(first, len(token)))
            going = np.repeat(least < NONE, length)
            out_token.append(token[~going])
            out_word.append(word[~going])
            if not going.any():
                break
            best = np.repeat(least, length) == rank
            best &= going
            hit = np.flatnonzero(best)
            hit = hit[np.append(True, word[hit[1:]] != word[hit[:-1]])]  # the leftmost of each word
            token[hit] = self.merged[rank[hit]]
            keep = going
            keep[hit + 1] = False
            place = np.cumsum(keep) - 1
            token, word, rank = token[keep], word[keep], rank[keep]
            # pairs on both sides of a merged symbol are new
            hit = place[hit]
            for at in (hit, hit[hit > 0] - 1):
                pair = at[at + 1 < len(token)]
                joined = word[pair] == word[pair + 1]
                rank[at[at + 1 >= len(token)]] = NONE
                rank[pair] = np.where(joined, self.ranks(token[pair], token[pair + 1]), NONE)
        token, word = np.concatenate(out_token), np.concatenate(out_word)
        order = np.argsort(word, kind="stable")
        return token[order], np.bincount(word, minlength=len(size))
