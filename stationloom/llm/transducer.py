"""A byte-pair tokenizer as a cascade of two deterministic transducers that emit token counts.

The first splits text into pieces, as the tokenizer's pattern does. Its states and
transitions are compiled into a table over classes of characters; a transition emits
where pieces end. Texts are cut into chunks. Each chunk is run from every state at
once, which gives a map from states to states; maps compose, so a parallel prefix scan
over chunks gives the state in which each chunk really begins, and a second run emits.

The second counts the tokens of a piece. Merging is local: tokens t1..tn are what the
merges make of their bytes exactly if each neighbouring pair is what they make of its
bytes. So, after any bytes, it is enough to know for each token that may still be under
way how many tokens precede it and which is the last of these. That is the state;
states and transitions are compiled when first met, and a transition emits the change
in the number of tokens, so that the sum along a path is the count.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np

#: Transitions kept at once; beyond, compilation starts anew.
MAX_TRANSITIONS = 400_000
#: Pieces kept in each of two generations.
MAX_PIECES = 300_000
CHUNK = 256
#: Characters after which the runs of one chunk are compared.
MEET = 8

# White space of the tokenizer's pattern, and the endings split off after an apostrophe.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]

# Classes of characters: letters that begin or continue an ending have classes of their own.
SPACE, BLANK, LETTER, NUMBER, OTHER, QUOTE, SINGLE, R, V, L, E, STOP = range(12)
N_CLASSES = 12
_LETTERS = {LETTER, SINGLE, R, V, L, E}
_ENDS_WITH = {R: E, V: E, L: L}
#: What stands for a special token inside the sequence of characters.
SPECIAL = 0x110000


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """Class of every code point, and of :data:`SPECIAL`."""
    out = np.full(SPECIAL + 1, OTHER, dtype=np.uint8)
    for c in range(SPECIAL):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    out[WHITE_SPACE] = BLANK
    out[32] = SPACE
    out[ord("'")] = QUOTE
    for ending in ENDINGS:
        out[ord(ending[0])] = SINGLE if len(ending) == 1 else {"r": R, "v": V, "l": L}[ending[0]]
    out[ord("e")] = E
    out[SPECIAL] = STOP
    return out


# States of the first transducer, by what has been read of the piece under way.
BEGIN, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ALONE, ALONE_R, ALONE_V, ALONE_L, ENDED, ONE_SPACE, SPACES, ONE_BLANK, BLANKS = range(13)
N_STATES = 13
#: Emitted: a piece ends before the character read, or before the one ahead of it.
CUT_HERE, CUT_BEFORE = 1, 2


def _enter(c: int) -> int:
    """State after the first character of a piece."""
    if c in _LETTERS:
        return IN_LETTERS
    return {NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, QUOTE: ALONE, SPACE: ONE_SPACE, BLANK: ONE_BLANK, STOP: BEGIN}[c]


def _step(state: int, c: int) -> tuple[int, int]:
    if state == BEGIN:
        return _enter(c), CUT_HERE
    if c == STOP:
        return BEGIN, CUT_HERE | (CUT_BEFORE if state in (ALONE_R, ALONE_V, ALONE_L) else 0)
    white = c in (SPACE, BLANK)
    if state in (ONE_SPACE, SPACES, ONE_BLANK, BLANKS):
        if white:
            return (SPACES if c == SPACE else BLANKS), 0
        before = CUT_BEFORE if state in (SPACES, BLANKS) else 0
        if state in (ONE_BLANK, BLANKS):
            return _enter(c), before | CUT_HERE
        return (IN_OTHERS if c == QUOTE else _enter(c)), before
    if state == ALONE:
        if c == SINGLE:
            return ENDED, 0
        if c in _ENDS_WITH:
            return {R: ALONE_R, V: ALONE_V, L: ALONE_L}[c], 0
        return (IN_OTHERS, 0) if c in (OTHER, QUOTE) else (_enter(c), CUT_HERE)
    if state in (ALONE_R, ALONE_V, ALONE_L):
        if c == (L if state == ALONE_L else E):
            return ENDED, 0
        return (IN_LETTERS, CUT_BEFORE) if c in _LETTERS else (_enter(c), CUT_BEFORE | CUT_HERE)
    if state == ENDED or white:
        return _enter(c), CUT_HERE
    same = {IN_LETTERS: c in _LETTERS, IN_NUMBERS: c == NUMBER, IN_OTHERS: c in (OTHER, QUOTE)}[state]
    return (state, 0) if same else (_enter(c), CUT_HERE)


@lru_cache(maxsize=1)
def compiled() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emission by state and class."""
    table = [[_step(s, c) for c in range(N_CLASSES)] for s in range(N_STATES)]
    return (np.array([[x[k] for x in row] for row in table], dtype=np.uint8) for k in (0, 1))


_NEXT, _EMIT = compiled()


def _scan(maps: np.ndarray) -> np.ndarray:
    """Of the maps of consecutive chunks, the state before each: an exclusive scan, in log steps, from BEGIN."""
    maps = maps.copy()
    step = 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].copy(), axis=1)
        step *= 2
    return np.concatenate([[BEGIN], maps[:-1, BEGIN]]).astype(np.uint8)


def piece_starts(points: np.ndarray) -> np.ndarray:
    """First characters of the pieces of a sequence of code points; :data:`SPECIAL` separates texts and is a piece."""
    classes = character_classes()[points]
    n = len(classes)
    chunks = -(-n // CHUNK)
    grid = np.full(chunks * CHUNK, STOP, dtype=np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T)
    following = _NEXT.T.copy().reshape(-1)
    maps = np.tile(np.arange(N_STATES, dtype=np.uint8), (chunks, 1))
    # whatever came before, nearly all chunks are in one state after a few characters; from there one run is enough
    for row in grid[:MEET]:
        maps = following[(row.astype(np.intp) * N_STATES)[:, None] + maps]
    apart = np.flatnonzero((maps != maps[:, :1]).any(axis=1))
    rest, meet = maps[apart], maps[:, 0]
    for row in grid[MEET:]:
        at = row.astype(np.intp) * N_STATES
        meet = following[at + meet]
        if len(apart):
            rest = following[at[apart][:, None] + rest]
    maps = np.repeat(meet[:, None], N_STATES, axis=1)
    maps[apart] = rest
    state = _scan(maps.astype(np.intp))
    emitted = np.empty((CHUNK, chunks), dtype=np.uint8)
    flat_next, flat_emit = _NEXT.reshape(-1), _EMIT.reshape(-1)
    for k, row in enumerate(grid):
        at = state.astype(np.intp) * N_CLASSES + row
        emitted[k] = flat_emit[at]
        state = flat_next[at]
    emitted = emitted.T.reshape(-1)[:n]
    cut = (emitted & CUT_HERE) > 0
    cut[:-1] |= (emitted[1:] & CUT_BEFORE) > 0
    return np.flatnonzero(cut)


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins for bytes in the vocabulary file: bytes that print stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Known(dict):
    """Values of pieces met before, in bounded memory: when it is full, what is not met again is forgotten."""

    def __init__(self, limit: int = MAX_PIECES) -> None:
        super().__init__()
        self.limit, self.old = limit, {}

    def turn(self) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()

    def __missing__(self, piece: str):
        value = self.old.get(piece)
        if value is not None:
            self[piece] = value
        return value


class Merges:
    """Vocabulary and merges of a byte-level tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {bytes(letters[c] for c in text): i for text, i in spec["model"]["vocab"].items() if text not in self.special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.rank = {tuple(bytes(letters[c] for c in half) for half in pair): k for k, pair in enumerate(pairs)}

    def spines(self) -> tuple[list[list[tuple[int, int, int]]], list[list[tuple[int, int, int]]], dict[tuple[int, int], int]]:
        """Of each token what is at its right and at its left end while it is made: token, rank that makes it, rank that uses it up.

        Also the rank of each pair of tokens.
        """
        size = len(self.ids)
        made, halves, pairs = [-1] * size, [None] * size, {}
        for (a, b), k in self.rank.items():
            i, j, t = self.ids[a], self.ids[b], self.ids[a + b]
            pairs[i, j] = k
            if halves[t] is None or k < made[t]:
                made[t], halves[t] = k, (i, j)
        ends = []
        for side in (1, 0):
            spine = []
            for t in range(size):
                at, used, rows = t, 1 << 60, []
                while True:
                    rows.append((at, made[at], used))
                    if halves[at] is None:
                        break
                    at, used = halves[at][side], made[at]
                spine.append(rows)
            ends.append(spine)
        return ends[0], ends[1], pairs


class TokenCounter:
    """The second transducer, compiled as far as it is used."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.children: list[dict[int, int]] = [{}]  # a tree of all tokens
        self.token: list[int] = [-1]
        self.bytes_of = sorted(merges.ids, key=merges.ids.get)
        for t, raw in enumerate(self.bytes_of):
            node = 0
            for b in raw:
                if b not in self.children[node]:
                    self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = self.children[node][b]
            self.token[node] = t
        self.right, self.left, self.pairs = merges.spines()
        self.fits: dict[int, bool] = {}
        self.known = Known()
        self._reset()

    def _reset(self) -> None:
        self.states: list[tuple] = [((0, -1, 0),)]  # of each token under way: place in the tree, token before it, tokens up to there
        self.number = {self.states[0]: 0}
        self.moves: dict[int, tuple[int, int]] = {}

    def _neighbours(self, left: int, right: int) -> bool:
        """Are these two tokens what the merges make of their bytes?

        They are not if some pair across the border merges while both its halves stand at the border. Equal ranks
        apply from the left: inside the left token first, and at the border before the right token.
        """
        if left < 0:
            return True
        key = left << 32 | right
        got = self.fits.get(key)
        if got is None:
            got, pairs, other = True, self.pairs, self.left[right]
            for x, made_x, used_x in self.right[left]:
                for y, made_y, used_y in other:
                    k = pairs.get((x, y))
                    if k is not None and made_x < k < used_x and made_y < k <= used_y:
                        got = False
                        break
                if not got:
                    break
            if len(self.fits) > MAX_TRANSITIONS:
                self.fits.clear()
            self.fits[key] = got
        return got

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        going, last, count = [], None, 0
        for place, before, tokens in self.states[state]:
            node = self.children[place].get(byte)
            if node is None:
                continue
            going.append((node, before, tokens))
            if last is None and self.token[node] >= 0 and self._neighbours(before, self.token[node]):
                last, count = self.token[node], tokens + 1
        reached = tuple((n, b, t - count) for n, b, t in going) + ((0, last, 0),)
        number = self.number.get(reached)
        if number is None:
            number = self.number[reached] = len(self.states)
            self.states.append(reached)
        self.moves[state << 8 | byte] = number, count
        return number, count

    def count(self, piece: bytes) -> int:
        if len(self.moves) > MAX_TRANSITIONS:
            self._reset()
        state = total = 0
        moves = self.moves
        for byte in piece:
            move = moves.get(state << 8 | byte)
            state, emitted = move if move is not None else self._compile(state, byte)
            total += emitted
        return total

    def count_pieces(self, pieces: list[str]) -> np.ndarray:
        known = self.known
        known.turn()
        found = list(map(known.__getitem__, pieces))
        if None in found:
            for i, n in enumerate(found):
                if n is None:
                    p = pieces[i]
                    n = known[p]
                    if n is None:
                        n = known[p] = self.count(p.encode("utf-8", "surrogatepass"))
                    found[i] = n
        return np.array(found, dtype=np.int64)
