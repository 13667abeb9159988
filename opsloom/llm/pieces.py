"""SentencePiece encoding and decoding: merges for BPE models, max-plus dynamic programming for unigram models.

The kind a model file names decides. In a BPE model scores are ranks of merges, and adding them up
means nothing: neighbouring pieces are merged in the order of their ranks. No merge joins two
characters that stand side by side in no piece, so giant documents are split there and the parts
encoded on their own.

In a unigram model the best segmentation of a text into pieces is a longest path: scores add along
a path, and the maximum is taken over paths. Both operations are associative as matrix products
over (max, +), so giant documents are split into chunks. A chunk gives one matrix: the best score
for each state at its left boundary (how far a piece reaches into it) and each at its right. The
matrices of a document are combined in order, which fixes the state at every boundary, and then
each chunk is traced back on its own.

Inside a chunk words are solved together: at a boundary between a character and a following blank
no piece of the vocabulary crosses, so the matrix there has one entry and a word's best path does
not depend on its neighbours.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import finish, map_batches, mix, staged, unused

# Fixed values of the model format: kinds of pieces, and the mark that stands for a blank.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BLANK = "▁"
UNIGRAM, BPE = 1, 2
# An unknown character scores this much less than the worst piece.
UNKNOWN_PENALTY = 10
# Characters of a chunk; documents of one chunk need no matrix.
CHUNK = 1 << 15
# Words a worker remembers, and characters of unknown words solved together.
REMEMBERED, SOLVED_CHARACTERS = 1 << 18, 1 << 16
NEVER = -(1 << 60)
# Merges of words up to this many characters are looked for in a list, of longer ones in a heap; where
# at least TOGETHER words of one length are new, they are merged together, a merge of each at a time.
LISTED_CHARACTERS, TOGETHER = 64, 16
_SLOT_BITS = 20
# Bits of the number of a part in a pair or a merge; no merge is worse than all.
_PART_BITS, _NO_MERGE = 31, (1 << 62) - 1


def _fields(raw: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, raw[at : at + size]
            at += size


class Vocabulary:
    """The pieces of a model file, and the search for best paths over them."""

    def __init__(self, model: bytes) -> None:
        self.pieces: list[str] = []
        scores, self.kinds = [], []
        self.blank_first = True
        for field, value in _fields(model):
            if field == 1:
                parts = dict(_fields(value))
                self.pieces.append(parts[1].decode())
                scores.append(struct.unpack("<f", parts[2])[0] if 2 in parts else 0.0)
                self.kinds.append(parts.get(3, NORMAL))
            elif field == 3:
                settings = dict(_fields(value))
                self.blank_first = bool(settings.get(3, 1))
                if settings.get(1, b"identity") != b"identity" or settings.get(4, 1) or not settings.get(5, 1):
                    raise ValueError("only models that keep the characters of a text as they are can be used")
        self.unknown = self.kinds.index(UNKNOWN)
        self.byte_ids = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        usable = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k in (NORMAL, USER)}
        self.ids = usable
        self.scores = np.array(scores, np.float64)
        self.unknown_score = float(min(scores[i] for i in usable.values()) - UNKNOWN_PENALTY)
        self.longest = max(map(len, usable))
        # Where a blank starts a word no piece may cross, or words could not be solved apart.
        self.splits = all(set(p) == {BLANK} or BLANK not in p[1:] for p in usable)
        self._index(list(usable), list(usable.values()))
        self._output = [self._bytes_of(i) for i in range(len(self.pieces))]
        self._words: dict[str, tuple[bytes, float]] = {}

    def _index(self, pieces: list[str], ids: list[int]) -> None:
        """Hashes of all beginnings of pieces in a table of slots, the few that collide in a list."""
        lengths = np.array([len(p) for p in pieces])
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        codes = np.frombuffer("".join(pieces[i] for i in order).encode("utf-32-le"), np.uint32)
        spread, starts = finish(codes.astype(np.uint64)), np.cumsum(lengths) - lengths
        numbers = np.array(ids, np.int32)[order]
        h = np.zeros(len(pieces), np.uint64)
        keys, values = [], []
        for n in range(self.longest):
            live = int((lengths > n).sum())
            h = mix(h[:live], spread[starts[:live] + n])
            keys.append(h)
            values.append(np.where(lengths[:live] == n + 1, numbers[:live], -1))
        key, value = np.concatenate(keys), np.concatenate(values)
        order = np.lexsort((-value, key))  # of equal beginnings the one that is a piece comes first
        key, value = key[order], value[order]
        new = np.append(True, key[1:] != key[:-1])
        key, value = key[new], value[new].astype(np.int32)
        slot = (key >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        self._slot_key, self._slot_value = np.zeros(1 << _SLOT_BITS, np.uint64), np.full(1 << _SLOT_BITS, -1, np.int32)
        self._slot_key[slot], self._slot_value[slot] = key, value
        lost = self._slot_key[slot] != key
        self._lost_key, self._lost_value = key[lost], value[lost]
        self._crowded = np.zeros(1 << _SLOT_BITS, bool)
        self._crowded[slot[lost]] = True

    def _look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is that of the beginning of a piece, and the piece it is, or -1."""
        slot = (h >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        known, value = self._slot_key[slot] == h, self._slot_value[slot]
        rest = np.flatnonzero(self._crowded[slot] & ~known)
        if len(rest):
            at = np.minimum(np.searchsorted(self._lost_key, h[rest]), len(self._lost_key) - 1)
            known[rest] = self._lost_key[at] == h[rest]
            value[rest] = self._lost_value[at]
        return known, value

    def _bytes_of(self, i: int) -> bytes:
        if self.kinds[i] == BYTE:
            return bytes([int(self.pieces[i][1:-1], 16)])
        if self.kinds[i] == CONTROL:
            return b""
        if self.kinds[i] == UNKNOWN:
            return " ⁇ ".encode()
        return self.pieces[i].replace(BLANK, " ").encode()

    def normalized(self, text: str) -> str:
        """Blanks as marks, one in front if the model wants it; an empty text stays empty."""
        return ((BLANK if self.blank_first else "") + text.replace(" ", BLANK)) if text else ""

    def words(self, text: str) -> list[str]:
        """Parts of a normalized text that no piece crosses."""
        return _WORD.findall(text) if self.splits else [text] * bool(text)

    def matches(self, codes: np.ndarray, remaining: np.ndarray) -> np.ndarray:
        """The piece of each length that starts at each character, -1 for none."""
        found = np.full((len(codes), self.longest), -1, np.int32)
        active = np.arange(len(codes))
        spread = finish(codes.astype(np.uint64))
        h = np.zeros(len(codes), np.uint64)
        for length in range(self.longest):
            h = mix(h, spread[active + length])
            known, value = self._look_up(h)
            active, h = active[known], h[known]
            found[active, length] = value[known]
            more = remaining[active] > length + 1
            active, h = active[more], h[more]
            if not len(active):
                break
        return found

    def solve(self, words: list[str]) -> None:
        """Best paths of many words, all advanced one character at a time together.

        Of equal scores the path whose last piece is longest is taken.
        """
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.array([len(w) for w in words])
        starts = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(len(words)), lengths)
        found = self.matches(codes, (starts + lengths)[word] - np.arange(len(codes)))
        score = np.where(found >= 0, self.scores[found], float(NEVER))
        alone = found[:, 0] < 0
        score[alone, 0] = self.unknown_score
        best = np.full(len(codes) + len(words), float(NEVER))
        taken = np.zeros(len(codes) + len(words), np.int64)
        first = starts + np.arange(len(words))  # place of each word's start among the boundaries
        best[first] = 0.0
        by_length = np.argsort(-lengths, kind="stable")
        sorted_lengths = -lengths[by_length]
        for end in range(1, int(lengths.max()) + 1):
            live = by_length[: np.searchsorted(sorted_lengths, -end, side="right")]
            sizes = np.arange(min(end, self.longest), 0, -1)
            before = best[(first[live] + end)[:, None] - sizes]
            paths = before + score[(starts[live] + end)[:, None] - sizes, sizes - 1]
            choice = paths.argmax(axis=1)
            best[first[live] + end] = paths[np.arange(len(live)), choice]
            taken[first[live] + end] = sizes[choice]
        live, at = np.arange(len(words)), lengths.copy()
        owners, places, steps = [], [], []
        while len(live):
            size = taken[first[live] + at[live]]
            at[live] -= size
            owners.append(live)
            places.append(starts[live] + at[live])
            steps.append(size)
            live = live[at[live] > 0]
        owner, place, size = (np.concatenate(c) for c in (owners, places, steps))
        order = np.lexsort((place, owner))
        owner, place, size = owner[order], place[order], size[order]
        ids = found[place, size - 1]
        bounds = np.searchsorted(owner, np.arange(len(words) + 1))
        unknown = np.zeros(len(words), bool)
        unknown[owner[ids < 0]] = True
        narrow = ids.astype(np.int32)
        totals = best[first + lengths]
        for w, text in enumerate(words):
            part = narrow[bounds[w] : bounds[w + 1]]
            if unknown[w]:
                part = self._with_bytes(part, place[bounds[w] : bounds[w + 1]] - starts[w], text)
            self._words[text] = part.tobytes(), float(totals[w])

    def _with_bytes(self, ids: np.ndarray, places: np.ndarray, text: str) -> np.ndarray:
        """Unknown characters as their bytes, or as the unknown piece in a model without bytes."""
        result: list[int] = []
        for i, at in zip(ids.tolist(), places.tolist(), strict=True):
            if i >= 0:
                result.append(i)
            elif self.byte_ids:
                result.extend(self.byte_ids[b] for b in text[at].encode("utf-8", "surrogatepass"))
            elif not result or result[-1] != self.unknown:
                result.append(self.unknown)
        return np.array(result, np.int32)

    def known(self, lists: list[list[str]]) -> dict[str, tuple[bytes, float]]:
        """Ids and score of every word of the lists."""
        missing = {w for words in lists for w in words if w not in self._words}
        if len(self._words) + len(missing) > REMEMBERED:
            self._words.clear()
            missing = {w for words in lists for w in words}
        held, size = [], 0
        for word in sorted(missing, key=len):
            held.append(word)
            size += len(word)
            if size >= SOLVED_CHARACTERS:
                self.solve(held)
                held, size = [], 0
        if held:
            self.solve(held)
        return self._words

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        lists = [self.words(self.normalized(t)) if t else [] for t in texts]
        known = self.known(lists)
        return [b"".join([known[w][0] for w in words]) for words in lists]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that form no character become the replacement character."""
        raw = b"".join(map(self._output.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return raw[1:] if self.blank_first and raw.startswith(" ") else raw

    def _paths(self, text: str, start: int, cut: int) -> tuple[list[float], list[int]]:
        """Best score of each boundary from ``start`` on, and the length of the piece before it.

        Pieces start before ``cut``, so boundaries after it are those a crossing piece can reach.
        """
        best, taken = [float(NEVER)] * (len(text) + 1), [0] * (len(text) + 1)
        best[start] = 0.0
        for at in range(start, min(cut, len(text))):
            if best[at] <= NEVER:
                continue
            for size in range(1, min(self.longest, len(text) - at) + 1):
                i = self.ids.get(text[at : at + size])
                score = float(self.scores[i]) if i is not None else self.unknown_score if size == 1 else None
                if score is not None and best[at] + score > best[at + size]:
                    best[at + size], taken[at + size] = best[at] + score, size
        return best, taken

    def safe_cuts(self, text: str, end: int) -> tuple[int, int] | None:
        """First and last place before ``end`` that no piece crosses."""
        if not self.splits:
            return None
        cuts = [m.start() + 1 for m in _CUT.finditer(text, 0, end + 1) if m.start() + 1 < end]
        return (cuts[0], cuts[-1]) if cuts else None

    def transfer(self, text: str, end: int) -> np.ndarray:
        """The chunk's matrix: state at place 0 to state at ``end``; ``text`` goes on past ``end``."""
        states = self.longest
        matrix = np.full((states, states), float(NEVER))
        cuts = self.safe_cuts(text, end)
        first, last = cuts or (end, end)
        reach = min(states - 1, len(text) - end)

        def leave(start: int) -> np.ndarray:
            best, _ = self._paths(text, start, end)
            return np.array([best[end + s] if s <= reach else float(NEVER) for s in range(states)])

        if cuts is None:
            for s in range(min(states, end + 1)):
                matrix[s] = leave(s)
            return matrix
        whole = self.words(text[first:last])
        known = self.known([whole])
        middle = sum(known[w][1] for w in whole)
        right = leave(last)
        for s in range(min(states, first + 1)):
            best, _ = self._paths(text[:first], s, first)
            if best[first] > NEVER:
                matrix[s] = np.maximum(best[first] + middle + right, float(NEVER))
        return matrix

    def trace(self, text: str, end: int, state_in: int, state_out: int) -> bytes:
        """The ids of a chunk whose states at both boundaries are known."""
        cuts = self.safe_cuts(text, end)
        last = max(state_in, cuts[1]) if cuts else state_in
        whole = self.words(text[state_in:last])
        known = self.known([whole])
        ids = b"".join([known[w][0] for w in whole])
        tail = text[last : end + state_out]
        _, taken = self._paths(tail, 0, end - last)
        return ids + self._tail(tail, taken)

    def _tail(self, tail: str, taken: list[int]) -> bytes:
        found, at = [], len(tail)
        while at > 0:
            size = taken[at]
            at -= size
            found.append((self.ids.get(tail[at : at + size], -1), at))
        found.reverse()
        ids, places = np.array([i for i, _ in found], np.int32), np.array([p for _, p in found], np.int64)
        return (self._with_bytes(ids, places, tail) if (ids < 0).any() else ids).tobytes()


_WORD = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
_CUT = re.compile(f"[^{BLANK}](?={BLANK})")


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The matrix of two neighbouring chunks: their product over (max, +); associative."""
    return np.maximum((left[:, :, None] + right[None, :, :]).max(axis=1), float(NEVER))


def boundary_states(matrices: list[np.ndarray]) -> list[int]:
    """The states at all boundaries of a document on its best path; both ends are in state 0."""
    row = np.full((1, len(matrices[0])), float(NEVER))
    row[0, 0] = 0.0
    reached = [row]
    for matrix in matrices:
        reached.append(combine(reached[-1], matrix))
    states = [0]
    for before, matrix in zip(reached[-2::-1], matrices[::-1], strict=True):
        states.append(int((before[0] + matrix[:, states[-1]]).argmax()))
    return states[::-1]


class MergeVocabulary(Vocabulary):
    """The pieces of a BPE model: of all neighbours the pair whose piece scores best is merged first."""

    def __init__(self, model: bytes) -> None:
        super().__init__(model)
        if USER in self.kinds or UNUSED in self.kinds:
            raise ValueError("BPE models with user-defined or unused pieces cannot be used")
        self._coded: dict[str, bytes] = {}
        self._ranks = {p: float(self.scores[i]) for p, i in self.ids.items()}
        pairs = {(ord(a) << 21) | ord(b) for p in self.ids for a, b in zip(p, p[1:])}
        self._pairs = np.array(sorted(pairs), np.int64)
        self._known_characters = np.array(sorted(ord(p) for p in self.ids if len(p) == 1), np.int64)
        self._number_merges()

    def _number_merges(self) -> None:
        """Numbers for all parts that merges can meet, and a sorted table of the merges between them.

        Part 0 is every character that no piece holds. A merge is its rank, best first, above the
        number of the merged part; equal scores share a rank.
        """
        parts = ["", *sorted({c for p in self.ids for c in p}.union(self.ids))]
        number = {p: i for i, p in enumerate(parts)}
        self._part_ids = np.array([self.ids.get(p, -1) for p in parts], np.int32)
        self._part_lengths = np.array([max(1, len(p)) for p in parts], np.int64)
        self._character_parts = np.zeros(0x110000, np.int32)
        for p in parts[1:]:
            if len(p) == 1:
                self._character_parts[ord(p)] = number[p]
        ranks = {score: rank for rank, score in enumerate(sorted(set(self._ranks.values()), reverse=True))}
        self._ties = len(ranks) < len(self._ranks)
        merges = {
            (number[p[:k]] << _PART_BITS) | number[p[k:]]: (ranks[score] << _PART_BITS) | number[p]
            for p, score in self._ranks.items()
            for k in range(1, len(p))
            if p[:k] in number and p[k:] in number
        }
        # The last entry is found for pairs beyond all others.
        self._merge_pairs = np.array([*sorted(merges), -1], np.int64)
        self._merges = np.array([*(merges[pair] for pair in sorted(merges)), _NO_MERGE], np.int64)

    def _index(self, pieces: list[str], ids: list[int]) -> None:
        """Merges look pieces up whole, so beginnings need no table."""

    def cuts(self, text: str) -> np.ndarray:
        """The places inside a normalized text that no merge crosses, in order."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        free = ~np.isin((codes[:-1] << 21) | codes[1:], self._pairs)
        if not self.byte_ids:
            # Unknown characters side by side become one unknown piece.
            known = np.isin(codes, self._known_characters)
            free &= known[:-1] | known[1:]
        return np.flatnonzero(free) + 1

    def words(self, text: str) -> list[str]:
        if self.splits or not text:
            return super().words(text)
        bounds = [0, *self.cuts(text).tolist(), len(text)]
        return [text[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return self.encode_lists([self.words(self.normalized(t)) if t else [] for t in texts])

    def encode_lists(self, lists: list[list[str]]) -> list[bytes]:
        """The ids of each list of words."""
        coded = self._coded
        missing = set().union(*lists).difference(coded)
        if len(coded) + len(missing) > REMEMBERED:
            coded.clear()
            missing = set().union(*lists)
        lengths: dict[int, list[str]] = {}
        for word in missing:
            lengths.setdefault(len(word), []).append(word)
        for length, alike in lengths.items():
            if 1 < length <= LISTED_CHARACTERS and len(alike) >= TOGETHER:
                self._code_together(alike, length)
            else:
                for word in alike:
                    coded[word] = self._code(word)
        return [b"".join(map(coded.__getitem__, words)) for words in lists]

    def _code(self, word: str) -> bytes:
        parts = self._listed(word) if len(word) <= LISTED_CHARACTERS else self._heaped(word)
        ids = [self.ids.get(p, -1) for p in parts]
        if -1 not in ids:
            return array("i", ids).tobytes()
        lengths = np.array([len(p) for p in parts])
        return self._with_bytes(np.array(ids, np.int32), np.cumsum(lengths) - lengths, word).tobytes()

    def _merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = (left.astype(np.int64) << _PART_BITS) | right
        found = np.searchsorted(self._merge_pairs[:-1], pairs)
        return np.where(self._merge_pairs[found] == pairs, self._merges[found], _NO_MERGE)

    def _code_together(self, words: list[str], length: int) -> None:
        """Codes words of one length: in each round every word makes its best merge, so all keep one length."""
        text = "".join(words).encode("utf-32-le", "surrogatepass")
        parts = self._character_parts[np.frombuffer(text, np.uint32)].reshape(len(words), length)
        merges = self._merge_of(parts[:, :-1], parts[:, 1:])
        names = np.arange(len(words))
        while len(names):
            # The leftmost of equal scores.
            at = (merges >> _PART_BITS if self._ties else merges).argmin(axis=1) if merges.shape[1] else None
            best = merges[np.arange(len(names)), at] if at is not None else np.full(len(names), _NO_MERGE)
            done = best == _NO_MERGE
            if done.any():
                self._keep_codes([words[n] for n in names[done].tolist()], parts[done])
                going = ~done
                names, parts, merges, best = names[going], parts[going], merges[going], best[going]
                at = at[going] if at is not None else None
                if not len(names):
                    break
            row, width = np.arange(len(names)), parts.shape[1] - 1
            kept = np.ones(parts.shape, bool)
            kept[row, at + 1] = False
            parts = parts[kept].reshape(len(names), width)
            parts[row, at] = best & ((1 << _PART_BITS) - 1)
            kept = np.ones(merges.shape, bool)
            kept[row, at] = False
            merges = merges[kept].reshape(len(names), width - 1)
            before, after = np.flatnonzero(at > 0), np.flatnonzero(at < width - 1)
            merges[before, at[before] - 1] = self._merge_of(parts[before, at[before] - 1], parts[before, at[before]])
            merges[after, at[after]] = self._merge_of(parts[after, at[after]], parts[after, at[after] + 1])

    def _keep_codes(self, words: list[str], parts: np.ndarray) -> None:
        ids = self._part_ids[parts]
        raw, size = ids.tobytes(), 4 * parts.shape[1]
        self._coded.update(zip(words, (raw[i : i + size] for i in range(0, len(raw), size))))
        for i in np.flatnonzero((ids < 0).any(axis=1)).tolist():
            lengths = self._part_lengths[parts[i]]
            self._coded[words[i]] = self._with_bytes(ids[i], np.cumsum(lengths) - lengths, words[i]).tobytes()

    def _listed(self, word: str) -> list[str]:
        parts, rank = list(word), self._ranks.get
        scores = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == NEVER:
                break
            i = scores.index(best)  # of equal scores the leftmost
            merged = parts[i] + parts.pop(i + 1)
            parts[i] = merged
            del scores[i]
            if i:
                scores[i - 1] = rank(parts[i - 1] + merged, NEVER)
            if i < len(scores):
                scores[i] = rank(merged + parts[i + 1], NEVER)
        return parts

    def _heaped(self, word: str) -> list[str]:
        parts: list[str] = list(word)
        before, after = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < len(parts):
                merged = parts[left] + parts[right]
                score = self._ranks.get(merged)
                if score is not None:
                    heapq.heappush(heap, (-score, left, right, merged))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, left, right, merged = heapq.heappop(heap)
            # One of the two has been merged with another part since.
            if not parts[left] or not parts[right] or parts[left] + parts[right] != merged:
                continue
            parts[left], parts[right] = merged, ""
            after[left] = after[right]
            if after[left] < len(parts):
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [p for p in parts if p]


def model_kind(model: bytes) -> int:
    """The kind of model the file was trained as; a file without it is a unigram model."""
    return next((int(dict(_fields(value)).get(3, UNIGRAM)) for field, value in _fields(model) if field == 2), UNIGRAM)


@lru_cache(maxsize=2)
def vocabulary(model: bytes) -> Vocabulary:
    kind = model_kind(model)
    if kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models can be used")
    return MergeVocabulary(model) if kind == BPE else Vocabulary(model)


def encode_texts(frame: DataFrame, model: bytes, *, text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``frame`` with ``pieces``, the ids of its texts as little-endian 32-bit numbers, and ``n_pieces``.

    Segmentations are those of the kind of model the file was trained as: by its merges for BPE, of
    greatest total score for unigram. Null and empty texts have no pieces. Texts longer than
    ``chunk`` characters are split, and their chunks dealt to all tasks; a stretch in which every
    place may be crossed by a merge stays in one chunk.
    Other columns are kept; columns of the two names are replaced. Repeated rows are encoded alike.
    """
    spark = frame.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kept = [c for c in frame.columns if c not in ("pieces", "n_pieces")]
    source = frame.select(*(F.col(f"`{c}`") for c in kept))
    place = kept.index(text)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)
    long = F.coalesce(F.length(F.col(f"`{text}`")) > chunk, F.lit(False))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(shared.value)
        for batch in batches:
            ids = pieces.encode(batch.column(place).to_pylist())
            counts = pa.array([len(i) // 4 for i in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary()), counts], names=[*kept, "pieces", "n_pieces"])

    short = map_batches(source.where(~long), encode, f"{fields}, pieces binary, n_pieces long")
    merging = model_kind(model) == BPE
    giants = source.where(long)
    if giants.isEmpty():
        return short
    one, two, joined_ids = unused(giants, "row_a", "row_b", "joined_ids")
    giants = giants.withColumns({one: F.xxhash64(F.col(f"`{text}`")), two: F.hash(F.col(f"`{text}`"))})
    texts = giants.select(F.col(one).alias("row_a"), F.col(two).alias("row_b"), F.col(f"`{text}`").alias("text"))

    def chunk_row(batch: pa.RecordBatch, i: int, number: int, part: str, size: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c).slice(i, 1) for c in (0, 1)), pa.array([number]), pa.array([part]), pa.array([size])],
            names=["row_a", "row_b", "chunk", "part", "size"],
        )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(shared.value)
        for batch in batches:
            for i, whole in enumerate(batch.column(2).to_pylist()):
                whole = pieces.normalized(whole)
                begin = number = 0
                free = pieces.cuts(whole) if merging else None
                while begin < len(whole):
                    end = min(len(whole), begin + chunk)
                    if merging:
                        if end < len(whole):
                            last = int(np.searchsorted(free, end, side="right")) - 1
                            if last >= 0 and free[last] > begin:
                                end = int(free[last])
                            else:
                                end = int(free[last + 1]) if last + 1 < len(free) else len(whole)
                        yield chunk_row(batch, i, number, whole[begin:end], end - begin)
                        begin, number = end, number + 1
                        continue
                    # At a place no piece crosses if there is one, so that ties fall as in one piece.
                    cuts = pieces.safe_cuts(whole[begin : end + 1], end - begin + 1) if end < len(whole) else None
                    end = begin + cuts[1] if cuts else end
                    part = whole[begin : end + pieces.longest - 1]
                    yield chunk_row(batch, i, number, part, end - begin)
                    begin, number = end, number + 1

    chunks = map_batches(texts, split, "row_a long, row_b int, chunk long, part string, size long")
    chunks = staged(chunks.repartition("row_a", "row_b", "chunk").dropDuplicates(["row_a", "row_b", "chunk"]), "chunks")

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(shared.value)
        for batch in batches:
            found = [pieces.transfer(p, n) for p, n in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
            matrices = pa.array([m.tobytes() for m in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], matrices], names=["row_a", "row_b", "chunk", "matrix"])

    def scan(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        size = int(np.sqrt(len(group["matrix"].iloc[0]) // 8))
        states = boundary_states([np.frombuffer(m, np.float64).reshape(size, size) for m in group["matrix"]])
        return group[["row_a", "row_b", "chunk"]].assign(state_in=states[:-1], state_out=states[1:])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(shared.value)
        for batch in batches:
            ids = pa.array(pieces.encode_lists([pieces.words(p) for p in batch.column(3).to_pylist()]), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], ids], names=["row_a", "row_b", "chunk", "ids"])

    matrices = map_batches(chunks, transfer, "row_a long, row_b int, chunk long, matrix binary")
    # A document's matrices are 2 KB a chunk, a small share of its text.
    states = matrices.groupBy("row_a", "row_b").applyInPandas(scan, "row_a long, row_b int, chunk long, state_in long, state_out long")

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(shared.value)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in range(3, 7)), strict=True)
            ids = pa.array([pieces.trace(*row) for row in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], ids], names=["row_a", "row_b", "chunk", "ids"])

    ordered = chunks.join(states, ["row_a", "row_b", "chunk"]).select("row_a", "row_b", "chunk", "part", "size", "state_in", "state_out")
    coded = "row_a long, row_b int, chunk long, ids binary"
    traced = map_batches(chunks, merge, coded) if merging else map_batches(ordered, trace, coded)
    lists = traced.groupBy("row_a", "row_b").agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [b"".join(p["ids"] for p in parts) for parts in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(whole, pa.binary())], names=["row_a", "row_b", "pieces"])

    joined = map_batches(lists, gather, "row_a long, row_b int, pieces binary")
    joined = joined.select(F.col("row_a").alias(one), F.col("row_b").alias(two), F.col("pieces").alias(joined_ids))
    encoded = giants.join(joined, [one, two]).select(
        *(F.col(f"`{c}`") for c in kept), F.col(joined_ids).alias("pieces"), (F.octet_length(joined_ids) / 4).cast("long").alias("n_pieces")
    )
    return short.union(encoded)


def decode_pieces(frame: DataFrame, model: bytes, *, pieces: str = "pieces") -> DataFrame:
    """``frame`` with ``decoded``, the text of its ids; null ids decode to an empty text."""
    shared = frame.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in frame.columns if c != "decoded"]
    source = frame.select(*(F.col(f"`{c}`") for c in kept))
    place = kept.index(pieces)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary(shared.value)
        for batch in batches:
            texts = [table.decode(np.frombuffer(ids or b"", np.int32)) for ids in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)
    return map_batches(source, decode, f"{fields}, decoded string")

