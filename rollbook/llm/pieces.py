"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

A chunk of text (blanks and the word after them; no piece reaches further) is
split into characters.  An agenda holds the neighbours that make a piece of the
vocabulary, best score first; each merge taken from it is skipped when a keyed
hash of the merge falls below the dropout rate.  The hash takes the seed, the
document's key and the place in it, so every occurrence of a chunk has a draw of
its own, alike in every run.  Characters outside the vocabulary become bytes.

What is remembered is free of draws: for a chunk and the merges skipped so far,
which merges follow and what comes of it.  An occurrence looks for the first of
them that its own hash skips, and goes on from there.  Agendas of what is new
are worked off side by side, one entry of each chunk per round; a very long chunk
has a heap of its own, for each occurrence.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the public vocabulary lies on this machine; any BPE model with byte pieces will do.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"

_BLANK = "▁"
_MASK = (1 << 64) - 1


def read_model(path: str) -> tuple[list[str], list[float]]:
    """Pieces and scores by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids]


class Vocabulary:
    """What segmenting needs to know of a model, made once on the driver.

    A symbol is the rank of a piece by score, or a number from ``unknown`` on
    for a character that is no piece; ``pairs`` are all two symbols that make a
    piece, ``made`` the ranks of these.
    """

    def __init__(self, pieces: Sequence[str], scores: Sequence[float]) -> None:
        self.pieces = list(pieces)
        is_byte = [re.fullmatch(r"<0x([0-9A-F]{2})>", p) for p in pieces]
        self.byte_of = {i: int(m.group(1), 16) for i, m in enumerate(is_byte) if m}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        plain = [i for i, p in enumerate(pieces) if i not in self.byte_of and not re.fullmatch(r"<(?:unk|s|/s|pad)>", p)]
        plain.sort(key=lambda i: (-scores[i], i))
        self.ids = np.array(plain, np.int32)
        self.unknown = len(plain)
        rank = {pieces[i]: r for r, i in enumerate(plain)}
        symbol = lambda s: rank.get(s, self.unknown + ord(s) if len(s) == 1 else None)
        found = {}
        for piece, r in rank.items():
            for k in range(1, len(piece)):
                one, two = symbol(piece[:k]), symbol(piece[k:])
                if one is not None and two is not None:
                    found[one << 32 | two] = r
        keys = sorted(found)
        self.pairs = np.array(keys, np.int64)
        self.made = np.array([found[k] for k in keys], np.int64)
        self.singles = {ord(p): r for p, r in rank.items() if len(p) == 1}


class _Column:
    """Numbers to which others are added at the end."""

    def __init__(self, kind: type) -> None:
        self.room, self.size = np.empty(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self.room):
            room = np.empty(2 * (self.size + len(values)), self.room.dtype)
            room[: self.size] = self.all
            self.room = room
        self.room[self.size : self.size + len(values)] = values
        self.size += len(values)

    @property
    def all(self) -> np.ndarray:
        return self.room[: self.size]


class _Paths:
    """What became of chunks so far: a node is a chunk and the merges skipped in it.

    A node has the merges that are taken from the agenda after the last skipped
    one, and the piece ids if none of these is skipped; each of these merges has
    the node to go on from if it is the next one skipped, or -1.
    """

    def __init__(self) -> None:
        self.roots: dict[str, int] = {}
        self.chunks: list[str] = []
        self.parent, self.via = _Column(np.int32), _Column(np.int64)
        self.first, self.width = _Column(np.int32), _Column(np.int32)
        self.entry, self.child = _Column(np.int64), _Column(np.int32)
        self.start, self.size = _Column(np.int32), _Column(np.int32)
        self.ids = _Column(np.int32)


class Segmenter:
    """Encodes and decodes; skipping is drawn for every occurrence of a chunk.

    What is remembered of a chunk depends on neither draw nor seed: which merges
    are taken next after some are skipped.  About ``remember`` such paths are
    kept; how many are changes the work, never the ids.
    """

    #: The sign for a blank where it is itself in a text: not a piece, so it becomes bytes.
    _LITERAL = 0x110000
    #: Occurrences that are looked up at once.
    _BLOCK = 1 << 18

    def __init__(self, words: Vocabulary, rate: float, seed: int, remember: int = 600_000) -> None:
        self.words, self.seed, self.remember = words, seed, remember
        self.skip_below = int(rate * (1 << 32))
        self.symbols = np.arange(words.unknown, words.unknown + 0x110000, dtype=np.int64)
        for c, r in words.singles.items():
            self.symbols[c] = r
        self.symbols[ord(" ")] = self.symbols[ord(_BLANK)]
        self.symbols[ord(_BLANK)] = words.unknown + self._LITERAL
        self.is_byte = np.zeros(len(words.pieces), bool)
        self.is_byte[list(words.byte_of)] = True
        self.known = _Paths()
        self.pairs, self.made = np.append(words.pairs, -1), np.append(words.made, -1)
        self.slots = self._slots()
        self.merges: dict[int, int] = {}
        bytes_of = (bytes([words.byte_of[i]]) if i in words.byte_of else p.replace(_BLANK, " ").encode() for i, p in enumerate(words.pieces))
        self.bytes_of = pa.array(bytes_of, pa.binary())
        self._chunks = re.compile(" *[^ ]+| +").findall

    def _slot(self, keys: np.ndarray, bits: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    def _slots(self) -> np.ndarray:
        """Where pairs lie by their hash, each in the first free slot from its own on; a free slot has the place behind all pairs."""
        n = len(self.words.pairs)
        bits = (8 * n + 8).bit_length()
        slots = np.full(1 << bits, n, np.int32)
        left, own = np.arange(n), self._slot(self.words.pairs, bits)
        while len(left):
            free = slots[own] == n
            slots[own[free]] = left[free]
            lost = slots[own] != left
            left, own = left[lost], (own[lost] + 1) & (len(slots) - 1)
        return slots

    def _made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece that two symbols make, or -1."""
        keys = left << 32 | right
        own = self._slot(keys, len(self.slots).bit_length() - 1)
        at = self.slots[own]
        other = np.flatnonzero((self.pairs[at] != keys) & (at < len(self.words.pairs)))
        while len(other):
            own[other] = (own[other] + 1) & (len(self.slots) - 1)
            at[other] = self.slots[own[other]]
            other = other[(self.pairs[at[other]] != keys[other]) & (at[other] < len(self.words.pairs))]
        return self.made[at]

    def _skipped(self, entries: np.ndarray, keys: np.ndarray) -> np.ndarray:
        h = (entries.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ keys
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(32)) < np.uint64(self.skip_below)

    def _ids(self, symbols: list[int]) -> list[int]:
        """Piece ids of symbols of which some are no pieces."""
        out: list[int] = []
        for s in symbols:
            if s < self.words.unknown:
                out.append(int(self.words.ids[s]))
            else:
                c = s - self.words.unknown
                out += [self.words.id_of_byte[b] for b in (_BLANK if c == self._LITERAL else chr(c)).encode()]
        return out

    def _keys(self, draws: np.ndarray) -> np.ndarray:
        """The key of each occurrence, of its draw (any 64 bits) and the seed."""
        keys = (draws ^ (draws >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        keys = (keys ^ (keys >> np.uint64(29))) + np.uint64((self.seed + 1) * 0xA0761D6478BD642F & _MASK)
        keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0xE7037ED1A0B428DB)
        return keys ^ (keys >> np.uint64(29))

    def segment_long(self, chunk: str, draw: int) -> list[int]:
        """One chunk of any length under a draw, from a heap."""
        symbols = self.symbols[np.frombuffer(chunk.encode("utf-32-le"), np.uint32)]
        n = len(symbols)
        key = int(self._keys(np.array([draw & _MASK], np.uint64))[0])
        first = self._made(symbols[:-1], symbols[1:])
        agenda = [int(r) << 32 | i for i, r in enumerate(first.tolist()) if r >= 0]
        heapq.heapify(agenda)
        if not self.merges:
            self.merges = dict(zip(self.words.pairs.tolist(), self.words.made.tolist(), strict=True))
        made = self.merges
        left = symbols.tolist()
        after, prior = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            top = heapq.heappop(agenda)
            i, r = top & 0xFFFFFFFF, top >> 32
            if left[i] < 0 or (j := after[i]) >= n or made.get(left[i] << 32 | left[j]) != r:
                continue
            # as in _skipped, for one entry
            h = (top * 0x9E3779B97F4A7C15 & _MASK) ^ key
            if ((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 & _MASK) >> 32 < self.skip_below:
                continue
            left[i], left[j] = r, -1
            k = after[i] = after[j]
            if k < n:
                prior[k] = i
                if (found := made.get(r << 32 | left[k])) is not None:
                    heapq.heappush(agenda, found << 32 | i)
            if (p := prior[i]) >= 0 and (found := made.get(left[p] << 32 | r)) is not None:
                heapq.heappush(agenda, found << 32 | p)
        return self._ids([s for s in left if s >= 0])

    def segment(self, chunks: Sequence[str], draws: Sequence[int]) -> list[list[int]]:
        """Piece ids of many chunks, each under its draw."""
        keys = self._keys(np.array([d & _MASK for d in draws], np.uint64))
        ids, sizes, *_ = self._merged(chunks, lambda entry, owner: self._skipped(entry, keys[owner]))
        ends = np.cumsum(sizes).tolist()
        return [ids[a:b].tolist() for a, b in zip([0, *ends], ends, strict=False)]

    def _merged(self, chunks: Sequence[str], skips: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, ...]:
        """Piece ids of chunks side by side, how many each has, and what was taken from the agendas: chunk, entry, skipped.

        Every round takes the best entry of each chunk's agenda, and ``skips``
        says for entries and their chunks which are skipped.
        """
        none = np.iinfo(np.int64).max
        symbol = self.symbols[np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)]
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        who = np.flatnonzero(sizes)
        widths = sizes[who]
        ends = np.cumsum(widths)
        place = np.arange(len(symbol)) - np.repeat(ends - widths, widths)
        entry = np.full(len(symbol), none)
        made = self._made(symbol[:-1], symbol[1:])
        made[ends[:-1] - 1] = -1
        has = np.flatnonzero(made >= 0)
        entry[has] = made[has] << 32 | place[has]
        done_owner, done_symbol = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        taken: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))]
        while len(symbol):
            best = np.minimum.reduceat(entry, np.cumsum(widths) - widths)
            over = best == none
            # chunks that are done stay where they are until they are many
            if 4 * int(widths[over].sum()) >= len(symbol):
                gone = np.repeat(over, widths)
                done_owner.append(np.repeat(who[over], widths[over]))
                done_symbol.append(symbol[gone])
                left = np.flatnonzero(~gone)
                symbol, place, entry = symbol[left], place[left], entry[left]
                who, widths, best, over = who[~over], widths[~over], best[~over], over[~over]
                if not len(symbol):
                    break
            best[over] = -1
            busy = np.flatnonzero(~over)
            at = np.flatnonzero(entry == np.repeat(best, widths))
            skip = skips(best[busy], who[busy])
            taken.append((who[busy], best[busy], skip))
            entry[at[skip]] = none
            at, busy = at[~skip], busy[~skip]
            if not len(at):
                continue
            symbol[at] = best[busy] >> 32
            entry[at] = none
            # the merged symbol with the one after it, and the one before it with the merged symbol
            last = np.cumsum(widths)[busy]
            one, two = at[at + 2 < last], at[at > last - widths[busy]]
            made = self._made(symbol[np.concatenate([one, two - 1])], symbol[np.concatenate([one + 2, two])])
            one = np.concatenate([one, two - 1])
            entry[one] = np.where(made >= 0, made << 32 | place[one], none)
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            left = np.flatnonzero(keep)
            symbol, place, entry = symbol[left], place[left], entry[left]
            widths[busy] -= 1
        owner, symbol = np.concatenate(done_owner), np.concatenate(done_symbol)
        order = np.argsort(owner, kind="stable")
        owner, symbol = owner[order], symbol[order]
        sizes = np.bincount(owner, minlength=len(chunks))
        ids = self.words.ids[np.minimum(symbol, self.words.unknown - 1)]
        strange = np.flatnonzero(symbol >= self.words.unknown)
        if len(strange):
            kinds, which = np.unique(symbol[strange], return_inverse=True)
            of_kind = [self._ids([s]) for s in kinds.tolist()]
            bytes_ = [of_kind[k] for k in which.tolist()]
            more = np.fromiter(map(len, bytes_), np.int64, len(bytes_))
            widths = np.ones(len(symbol), np.int64)
            widths[strange] = more
            ids = np.repeat(ids, widths)
            ids[np.repeat(symbol >= self.words.unknown, widths)] = list(chain.from_iterable(bytes_))
            np.add.at(sizes, owner[strange], more - 1)
        whose, entries, skipped = (np.concatenate(x) for x in zip(*taken, strict=True))
        order = np.argsort(whose, kind="stable")
        return ids, sizes, whose[order], entries[order], skipped[order]

    def _add(self, chunks: list[str], parent: np.ndarray, via: np.ndarray) -> np.ndarray:
        """New nodes for chunks where, after what the parents skip, ``via`` is skipped; those without a parent (-1) skip nothing."""
        known, n = self.known, len(chunks)
        each, node, entry, forced = np.arange(n), parent, via, []
        while (held := node >= 0).any():
            each, node, entry = each[held], node[held], entry[held]
            forced.append((each, entry))
            node, entry = known.parent.all[node], known.via.all[node]
        # short chunks: the place takes 16 bits, the rank 24
        packed = lambda entry, owner: owner << 40 | (entry >> 32) << 16 | entry & 0xFFFF
        skip = np.sort(np.concatenate([np.empty(0, np.int64), *[packed(e, o) for o, e in forced]]))

        def skips(entry: np.ndarray, owner: np.ndarray) -> np.ndarray:
            if not len(skip):
                return np.zeros(len(entry), bool)
            own = packed(entry, owner)
            return skip[np.minimum(np.searchsorted(skip, own), len(skip) - 1)] == own

        ids, sizes, whose, entries, skipped = self._merged(chunks, skips)
        # entries after the last of those skipped
        so_far = np.cumsum(skipped)
        total = np.bincount(whose, skipped, minlength=n).astype(np.int64)
        open_ = (so_far == np.cumsum(total)[whose]) & ~skipped
        widths = np.bincount(whose[open_], minlength=n)
        nodes = np.arange(known.parent.size, known.parent.size + n)
        known.first.add(known.entry.size + np.cumsum(widths) - widths)
        known.width.add(widths)
        known.entry.add(entries[open_])
        known.child.add(np.full(int(widths.sum()), -1))
        known.start.add(known.ids.size + np.cumsum(sizes) - sizes)
        known.size.add(sizes)
        known.ids.add(ids)
        known.parent.add(parent)
        known.via.add(via)
        known.chunks += chunks
        return nodes

    def _found(self, chunks: list[str], keys: np.ndarray) -> np.ndarray:
        """The node at which each occurrence of a short chunk ends, by its key."""
        known = self.known
        node = np.fromiter(map(known.roots.get, chunks, repeat(-1)), np.int64, len(chunks))
        lacking = np.flatnonzero(node < 0).tolist()
        if lacking:
            new = list(dict.fromkeys([chunks[i] for i in lacking]))
            none = np.full(len(new), -1)
            known.roots.update(zip(new, self._add(new, none, none).tolist(), strict=True))
            node[lacking] = [known.roots[chunks[i]] for i in lacking]
        out, who = node.copy(), np.arange(len(chunks))
        while len(who):
            widths = known.width.all[node]
            ends = np.cumsum(widths)
            owner = np.repeat(np.arange(len(who)), widths)
            slot = np.arange(len(owner)) + np.repeat(known.first.all[node] - ends + widths, widths)
            hit = np.flatnonzero(self._skipped(known.entry.all[slot], keys[who][owner]))
            first = np.ones(len(hit), bool)
            first[1:] = owner[hit[1:]] != owner[hit[:-1]]
            hit = hit[first]
            slot, from_ = slot[hit], owner[hit]
            who, node = who[from_], node[from_]
            lacking, at = np.unique(slot[known.child.all[slot] < 0], return_index=True)
            if len(lacking):
                parent = node[known.child.all[slot] < 0][at]
                made = self._add([known.chunks[p] for p in parent.tolist()], parent, known.entry.all[lacking])
                known.child.all[lacking] = made
            node = known.child.all[slot]
            out[who] = node
        return out

    def encode(self, texts: Sequence[str], keys: Sequence[int], longest: int = 64) -> list[np.ndarray]:
        """Piece ids of each text; one blank is put before a text, an empty one has none."""
        out = []
        chunks: list[str] = []
        draws, counts = [], []
        for text, key in zip(texts, keys, strict=True):
            own = self._chunks(" " + text) if text else []
            place = np.arange(len(own), dtype=np.uint64) + np.uint64(1)
            draws.append(place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & _MASK))
            counts.append(len(own))
            chunks += own
        draw = np.concatenate([np.empty(0, np.uint64), *draws])
        for a in range(0, len(chunks), self._BLOCK):
            out.append(self._encoded(chunks[a : a + self._BLOCK], draw[a : a + self._BLOCK], longest))
        flat = np.concatenate([np.empty(0, np.int32), *[ids for ids, _ in out]])
        sizes = np.concatenate([np.empty(0, np.int64), *[n for _, n in out]])
        ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts, dtype=np.int64))].tolist()
        return [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def _encoded(self, chunks: list[str], draws: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of chunks one after the other, and how many each has."""
        if self.known.parent.size >= self.remember:
            self.known = _Paths()
        long = [i for i, c in enumerate(chunks) if len(c) > longest] if max(map(len, chunks)) > longest else []
        keys = self._keys(draws)
        if not long:
            node = self._found(chunks, keys)
            start, size, ids = self.known.start.all[node], self.known.size.all[node], self.known.ids.all
        else:
            short = np.ones(len(chunks), bool)
            short[long] = False
            start, size = np.empty(len(chunks), np.int64), np.empty(len(chunks), np.int64)
            node = self._found([c for c in chunks if len(c) <= longest], keys[short])
            start[short], size[short] = self.known.start.all[node], self.known.size.all[node]
            apart = [self.segment_long(chunks[i], int(draws[i])) for i in long]
            size[long] = [len(x) for x in apart]
            start[long] = self.known.ids.size + np.cumsum(size[long]) - size[long]
            ids = np.concatenate([self.known.ids.all, np.fromiter(chain.from_iterable(apart), np.int32)])
        ends = np.cumsum(size)
        at = np.arange(int(ends[-1])) + np.repeat(start - ends + size, size)
        return ids[at], size

    def lossless(self, found: list[np.ndarray], texts: pa.Array) -> pa.Array:
        """Whether the bytes of the pieces of each text, one after the other, are the text behind its blank."""
        ends = np.cumsum([0, *map(len, found)])
        flat = self.bytes_of.take(pa.array(np.concatenate([np.empty(0, np.int32), *found])))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), b"")
        texts = texts.cast(pa.binary())
        led = pc.binary_join_element_wise(pa.scalar(b""), texts, pa.scalar(b" "))
        return pc.equal(joined, pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, led))

    def decode(self, ids: Sequence[int]) -> str:
        """The text that was encoded, to the last character."""
        if not len(ids):
            return ""
        pieces, byte_of = self.words.pieces, self.words.byte_of
        bytes_in = self.is_byte[ids].any()
        ids = np.asarray(ids).tolist()
        if not bytes_in:
            return "".join([pieces[i] for i in ids]).replace(_BLANK, " ")[1:]
        parts = [bytes([byte_of[i]]) if i in byte_of else pieces[i].replace(_BLANK, " ").encode() for i in ids]
        return b"".join(parts).decode()[1:]


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of documents with at most about 1 MB of text."""
    sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + (1 << 20), "right")))
        yield a, b
        a = b


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model: str = MODEL,
    rate: float = 0.1,
    seed: int = 11,
    remember: int = 600_000,
) -> DataFrame:
    """One row per document: id, ids (piece ids), n_pieces, lossless (the ids decode to the text).

    A NULL or empty text has no pieces and decodes to an empty one.  Rows that
    follow one another with the same id and text, as copies of a mix do, are
    segmented differently; a NULL id is a key like others.  An empty table
    gives no rows.  Columns other than the two named ones are not read.
    ``remember`` bounds the paths that a task keeps (about 300 bytes each); fewer
    cost time and change nothing else.
    """
    words = Vocabulary(*read_model(model))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = Segmenter(words, rate, seed, remember)
        last, copy = None, 0
        for batch in batches:
            for a, b in _slices(batch.column("text")):
                part = batch.slice(a, b - a)
                texts, keys = part.column("text").to_pylist(), []
                for key in part.column("key").to_pylist():
                    copy = copy + 1 if key == last else 0
                    last = key
                    keys.append(key + copy * 0x5851F42D4C957F2D)
                found = work.encode(texts, keys)
                sizes = [len(ids) for ids in found]
                ends = np.cumsum([0, *sizes])
                values = pa.array(np.concatenate(found), pa.int32())
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": part.column("id"),
                        "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values),
                        "n_pieces": pa.array(sizes, pa.int64()),
                        "lossless": work.lossless(found, part.column("text")),
                    }
                )

    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    given = docs.select(F.col(id_col).alias("id"), text, F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"))
    out = given.mapInArrow(run, f"id {id_type}, ids array<int>, n_pieces long, lossless boolean")
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """``encoded`` with a column ``text`` made of its piece ids; NULL ids give a NULL text."""
    words = Vocabulary(*read_model(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = Segmenter(words, 0.0, 0)
        for batch in batches:
            texts = [None if ids is None else work.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "text": pa.array(texts, pa.string())})

    packed = encoded.select(F.struct("*").alias("row"), F.col(ids_col).alias("ids"))
    schema = packed.select("row").schema.add("text", "string")
    out = packed.mapInArrow(run, schema)
    return out.select(F.col("row").withField("text", F.col("text")).alias("row")).select("row.*")
