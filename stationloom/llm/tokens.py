"""Token counts of whole texts by compiled transducers, and token ids for packing."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .transducer import SPECIAL, Merges, TokenCounter, byte_alphabet, piece_starts
from .words import kept, mix, spans

#: Characters taken together.
BATCH_CHARS = 1_000_000


def _counter(path: str) -> TokenCounter:
    counters = kept("counters")
    if path not in counters:
        counters[path] = TokenCounter(Merges(path))
    return counters[path]


class Pieces:
    """Pieces of all texts in order: code points ``begin`` to ``stop`` of the joined texts, ``doc`` of each, ``special`` tokens.

    Special strings inside a text are one piece, as the tokenizer library takes them by default.
    """

    def __init__(self, texts: list[str], special: list[str]) -> None:
        self.marked = "".join(texts)
        self.points = np.frombuffer(self.marked.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int32)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        pattern = re.compile("|".join(map(re.escape, special))) if special else None
        hits = [(end - len(t) + m.start(), end - len(t) + m.end()) for t, end in zip(texts, ends.tolist(), strict=True)
                for m in (pattern.finditer(t) if pattern else ())]
        # a separator stands after each text; a special string becomes one separator
        masked, drop = self.points.copy(), np.zeros(len(self.points), dtype=bool)
        for a, b in hits:
            masked[a] = SPECIAL
            drop[a + 1:b] = True
        where = np.flatnonzero(~drop)
        at_end = np.searchsorted(where, ends)
        origin = np.insert(where, at_end, -1)
        begin = origin[piece_starts(np.insert(masked[where], at_end, SPECIAL))]
        self.begin = begin[begin >= 0]
        self.doc = np.searchsorted(ends, self.begin, "right")
        stop = np.append(self.begin[1:], len(self.points))[:len(self.begin)]
        self.stop = np.minimum(stop, ends[self.doc]) if len(self.doc) else stop
        self.special = masked[self.begin] == SPECIAL

    def strings(self) -> list[str]:
        return [self.marked[a:b] for a, b in zip(self.begin.tolist(), self.stop.tolist(), strict=True)]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text of a byte-level ``vocabulary`` file.

    ``over_limit`` says whether a text has more than ``limit`` tokens. A null text is empty and has no tokens. One row
    for each row of ``docs``, repeated ids included; other columns are not read. The file must be at the same place on
    every executor.
    """
    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _counter(vocabulary)
        special = list(counter.merges.special)
        for frame in frames:
            texts = [t or "" for t in frame["text"]]
            totals = np.zeros(len(texts), dtype=np.int64)
            for a, b in spans(texts, BATCH_CHARS):
                pieces = Pieces(texts[a:b], special)
                counts = counter.count_pieces(pieces.strings())
                counts[pieces.special] = 1
                totals[a:b] = np.bincount(pieces.doc, weights=counts, minlength=b - a).astype(np.int64)
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64").array, "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in texts],
                                "n_tokens": totals, "over_limit": totals > limit})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


#: Bytes of a piece that is looked up by its hash; a longer one is encoded where it stands.
LONG_PIECE = 256
#: Pieces remembered in each of two generations, about 40 bytes each.
MAX_ENTRIES = 400_000


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``begin[i]`` to ``begin[i] + size[i]`` of all i, one after the other."""
    if not len(size):
        return np.zeros(0, dtype=np.int64)
    stop = np.cumsum(size)
    return np.arange(stop[-1]) + np.repeat(begin - stop + size, size)


class _Table:
    """Ids by two 64-bit hashes, as arrays in the order of the first hash."""

    def __init__(self) -> None:
        self.keys, self.checks = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
        self.begin, self.size, self.pool = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint32)

    def add(self, keys: np.ndarray, checks: np.ndarray, size: np.ndarray, pool: np.ndarray) -> None:
        begin = np.cumsum(size) - size + len(self.pool)
        keys, checks = np.concatenate([self.keys, keys]), np.concatenate([self.checks, checks])
        begin, size = np.concatenate([self.begin, begin]), np.concatenate([self.size, size])
        order = np.argsort(keys, kind="stable")
        self.keys, self.checks, self.begin, self.size = keys[order], checks[order], begin[order], size[order]
        self.pool = np.concatenate([self.pool, pool])

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Rows of known keys, -1 for others. Of keys that share the first hash only the first is known."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (self.checks[at] == checks), at, -1)


class Encoder:
    """Ids of texts by the ``tokenizers`` library; a piece that was met before is taken from memory.

    The library's model is asked for distinct pieces on their own, which is exact because merges never cross pieces.
    Pieces are told apart by two 64-bit hashes of their bytes, so only distinct ones become Python strings. Two
    generations of tables bound the memory: when one is full, pieces that are not met again are forgotten.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task on each core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.model, self.letters = self.tokenizer.model, {b: c for c, b in byte_alphabet().items()}
        rng = np.random.default_rng(7)
        self.bytes = rng.integers(1 << 64, size=(2, 256), dtype=np.uint64)
        self.places = rng.integers(1 << 63, size=(2, LONG_PIECE), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.new, self.old = _Table(), _Table()

    def piece_ids(self, piece: bytes) -> list[int]:
        """Ids of one piece of text, which is no special token."""
        return [t.id for t in self.model.tokenize(piece.decode("latin-1").translate(self.letters))]

    def _known(self, keys: np.ndarray, checks: np.ndarray, spell) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each of these distinct pieces, and all ids; ``spell`` gives the bytes of the i-th."""
        recent, before = self.new.find(keys, checks), self.old.find(keys, checks)
        before[recent >= 0] = -1
        size = np.zeros(len(keys), dtype=np.int64)
        size[recent >= 0] = self.new.size[recent[recent >= 0]]
        size[before >= 0] = self.old.size[before[before >= 0]]
        fresh = np.flatnonzero((recent < 0) & (before < 0))
        made = [self.piece_ids(spell(i)) for i in fresh.tolist()]
        size[fresh] = [len(x) for x in made]
        begin = np.cumsum(size) - size
        pool = np.empty(int(size.sum()), dtype=np.uint32)
        for table, row in ((self.new, recent), (self.old, before)):
            has = np.flatnonzero(row >= 0)
            pool[ranges(begin[has], size[has])] = table.pool[ranges(table.begin[row[has]], size[has])]
        pool[ranges(begin[fresh], size[fresh])] = [i for own in made for i in own]
        add = np.flatnonzero(recent < 0)
        if len(add):
            self.new.add(keys[add], checks[add], size[add], pool[ranges(begin[add], size[add])])
        if len(self.new.keys) > MAX_ENTRIES:
            self.new, self.old = _Table(), self.new
        return size, pool

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text."""
        pieces = Pieces(texts, list(self.special))
        if not len(pieces.begin):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
        raw = pieces.marked.encode("utf-8", "surrogatepass")
        data = np.frombuffer(raw, dtype=np.uint8)
        if len(data) == len(pieces.points):
            begin, stop = pieces.begin, pieces.stop
        else:
            place = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
            begin, stop = place[pieces.begin], place[pieces.stop]
        length = stop - begin
        offset = np.minimum(np.arange(begin[0], len(data)) - np.repeat(begin, np.diff(begin, append=len(data))), LONG_PIECE - 1)
        keys, checks = (mix(np.add.reduceat(self.bytes[k][data[begin[0]:]] * self.places[k][offset], begin - begin[0]) + length.astype(np.uint64)) for k in (0, 1))
        plain = np.flatnonzero(~pieces.special & (length <= LONG_PIECE))
        distinct, first, same = np.unique(keys[plain], return_index=True, return_inverse=True)
        alike = checks[plain] == checks[plain[first]][same]
        size, ids = self._known(distinct, checks[plain[first]], lambda i: raw[begin[plain[first[i]]]:stop[plain[first[i]]]])
        # those that the hashes do not settle follow after: special tokens, long pieces, pieces that share the first hash
        which = np.zeros(len(begin), dtype=np.int64)
        which[plain[alike]] = same[alike]
        odd = np.concatenate([np.flatnonzero(pieces.special | (length > LONG_PIECE)), plain[~alike]])
        own = [[self.special[pieces.marked[pieces.begin[i]:pieces.stop[i]]]] if pieces.special[i] else self.piece_ids(raw[begin[i]:stop[i]]) for i in odd.tolist()]
        which[odd] = len(distinct) + np.arange(len(odd))
        size = np.concatenate([size, np.array([len(x) for x in own], dtype=np.int64)])
        ids = np.concatenate([ids, np.array([i for x in own for i in x], dtype=np.uint32)])
        sizes = size[which]
        return ids[ranges((np.cumsum(size) - size)[which], sizes)], np.bincount(pieces.doc, weights=sizes, minlength=len(texts)).astype(np.int64)


def encoder(path: str) -> Encoder:
    encoders = kept("encoders")
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]
