"""Marginal probability of words over all their segmentations into pieces of a vocabulary.

A word is scored with a mark in front of it that pieces can begin with. Words of one
length are scored together: ``alpha[j]``, the log probability of all
segmentations of the first j characters, is the log-sum over the pieces that
end there. A character is also a piece by itself, worth its bytes' pieces, so
every word has a probability. Pieces are found by a hash of their characters.
"""

from __future__ import annotations

import numpy as np

MARK = "▁"
LONG = 64          # longer words are taken one at a time
_MUL, _ADD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def _roll(code: np.ndarray, chars: np.ndarray) -> np.ndarray:
    return (code ^ (chars + np.uint64(1))) * _MUL + _ADD


def _hash(piece: str) -> int:
    code = np.zeros(1, np.uint64)
    for c in np.frombuffer(piece.encode("utf-32-le"), "<u4").astype(np.uint64):
        code = _roll(code, np.array([c], np.uint64))
    return int(code[0])


class Lattice:
    """``pieces``, their natural-log ``scores``, and ``byte_scores`` of the 256 bytes."""

    def __init__(self, pieces: list[str], scores: np.ndarray, byte_scores: np.ndarray):
        self.pieces, self.scores, self.byte_scores = list(pieces), np.asarray(scores, float), np.asarray(byte_scores, float)
        # Hashes of all beginnings of pieces, in order, with the piece that one is, or -1.
        begins: dict[int, int] = {}
        for n, piece in enumerate(self.pieces):
            for k in range(1, len(piece)):
                begins.setdefault(_hash(piece[:k]), -1)
            begins[_hash(piece)] = n
        self.begins = np.array(sorted(begins), np.uint64)
        self.piece_of = np.array([begins[int(h)] for h in self.begins], np.int64)

    def _arcs(self, chars: np.ndarray, i: int):
        """For words (rows) of one length: per end of a piece that starts at ``i``, the rows that have one there, and the pieces."""
        rows, code = np.arange(len(chars)), np.zeros(len(chars), np.uint64)
        for j in range(i + 1, chars.shape[1] + 1):
            code = _roll(code, chars[rows, j - 1])
            at = np.minimum(np.searchsorted(self.begins, code), len(self.begins) - 1)
            goes = self.begins[at] == code
            rows, code, piece = rows[goes], code[goes], self.piece_of[at[goes]]
            if not len(rows):
                return
            ends = piece >= 0
            if ends.any():
                yield j, rows[ends], piece[ends]

    def _bytes(self, chars: np.ndarray) -> np.ndarray:
        """Log score of each character as its bytes."""
        distinct, place = np.unique(chars, return_inverse=True)
        worth = np.array([self.byte_scores[list(chr(int(c)).encode("utf-8", "replace"))].sum() for c in distinct])
        return worth[place].reshape(chars.shape)

    def run(self, words: list[str], counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log probability of each word; with ``counts``, also the expected uses of pieces and bytes."""
        out, uses, byte_uses = np.zeros(len(words)), np.zeros(len(self.scores)), np.zeros(256)
        sizes = np.array([min(len(w), LONG + 1) for w in words])
        for size in np.unique(sizes):
            group = np.flatnonzero(sizes == size)
            for part in ([group] if size <= LONG else [[i] for i in group]):
                chars = np.array([np.frombuffer((MARK + words[i]).encode("utf-32-le", "replace"), "<u4") for i in part]).astype(np.uint64)
                out[part] = self._group(chars, None if counts is None else counts[part], uses, byte_uses)
        return out, uses, byte_uses

    def _group(self, chars, counts, uses, byte_uses) -> np.ndarray:
        n, single = chars.shape[1], self._bytes(chars)
        arcs = [list(self._arcs(chars, i)) if len(self.begins) else [] for i in range(n)]
        alpha = np.full((n + 1, len(chars)), -np.inf)
        alpha[0] = 0.0
        for i in range(n):      # all that ends at i is in
            alpha[i + 1] = np.logaddexp(alpha[i + 1], alpha[i] + single[:, i])
            for j, rows, piece in arcs[i]:
                alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[i, rows] + self.scores[piece])
        if counts is not None:
            beta, used, much = np.full((n + 1, len(chars)), -np.inf), [], []
            beta[n] = 0.0
            for i in reversed(range(n)):
                beta[i] = single[:, i] + beta[i + 1]
                for j, rows, piece in arcs[i]:
                    onward = self.scores[piece] + beta[j, rows]
                    beta[i, rows] = np.logaddexp(beta[i, rows], onward)
                    used.append(piece)
                    much.append(np.exp(alpha[i, rows] + onward - alpha[n, rows]) * counts[rows])
            if used:
                uses += np.bincount(np.concatenate(used), weights=np.concatenate(much), minlength=len(uses))
            chance = np.exp(alpha[:-1].T + single + beta[1:].T - alpha[n][:, None]) * counts[:, None]
            distinct, place = np.unique(chars, return_inverse=True)
            for c, x in zip(distinct, np.bincount(place.ravel(), weights=chance.ravel())):
                for b in chr(int(c)).encode("utf-8", "replace"):
                    byte_uses[b] += x
        return alpha[n]
