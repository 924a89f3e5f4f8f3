"""BPE with word ends: a priority queue of merge ranks over a doubly linked symbol list, and decoding.

A text is cut at the strings of special tokens, normalised (composed, lower
case) and split into words: contractions, runs of letters, single digits, runs of
other signs.  The UTF-8 bytes of a word are its first symbols, the last of them in
its word-end form.  All neighbours that have a merge wait in a heap by rank, then
place; the least is taken, its right symbol leaves the linked list, and the new
neighbours enter the heap.  Entries whose symbols have changed meanwhile are
skipped.  Decoding joins the vocabulary strings of the ids.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the public vocabulary lies on this machine; any file of the same kind will do.
MODEL = "/opt/tokenizers/word_bpe_49k.json"

# Fixed values of the file format: contractions, the word end, what counts as a blank, the kind of file handled here.
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_WORD_END = "</w>"
_BLANKS = "\t-\r \x85\xa0  -     　"
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = _CONTRACTIONS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: More than any symbol number.
_SYMBOLS = 1 << 20

#: The rank of two symbols that do not merge.
_NONE = 1 << 30

#: Below this code point the case rules of the interpreter and of the library are the same, and lead to no letter beyond its double.
_NEAR = 0x23A


def byte_signs() -> list[str]:
    """The printable character that stands for each byte in vocabulary strings."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    signs = {b: chr(b) for b in own}
    for n, b in enumerate(b for b in range(256) if b not in signs):
        signs[b] = chr(256 + n)
    return [signs[b] for b in range(256)]


def _class_of(kind: str) -> str:
    """The code points of a Unicode property as ranges of a character class, as the library's expressions see it."""
    from tokenizers import Regex, pre_tokenizers

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    cut = pre_tokenizers.Split(Regex(rf"\p{{{kind}}}+"), "removed", invert=True)
    return "".join(f"{re.escape(piece[0])}-{re.escape(piece[-1])}" for piece, _ in cut.pre_tokenize_str(every))


def _splitter(letters: str, digits: str) -> str:
    return f"{_CONTRACTIONS}|[{letters}]+|[{digits}]|[^{_BLANKS}{letters}{digits}]+"


class Vocabulary:
    """What encoding needs to know of a vocabulary file, read once on the driver."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        model, parts = given["model"], given["pre_tokenizer"]["pretokenizers"]
        ordinary = (
            model["type"] == "BPE"
            and model["end_of_word_suffix"] == _WORD_END
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
            and [n["type"] for n in given["normalizer"]["normalizers"]] == _NORMALIZERS
            and [p["type"] for p in parts] == ["Split", "ByteLevel"]
            and parts[0]["pattern"] == {"Regex": _SPLIT}
            and not (given["post_processor"] or given["decoder"])
        )
        if not ordinary:
            raise ValueError(f"{path} is not a BPE vocabulary with word ends")
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.strings = [""] * (1 + max(*ids.values(), *self.special.values()))
        for text, i in chain(ids.items(), self.special.items()):
            self.strings[i] = text
        signs = byte_signs()
        self.inner = np.array([ids[s] for s in signs])
        self.last = np.array([ids[s + _WORD_END] for s in signs])
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        left, right = np.array([[ids[a], ids[b]] for a, b in pairs]).T
        self.made = np.array([ids[a + b] for a, b in pairs])
        keys = left * _SYMBOLS + right
        self.rank_of = dict(zip(zip(left.tolist(), right.tolist(), strict=True), range(len(pairs)), strict=True))
        self.ranks = np.argsort(keys)
        self.pairs = keys[self.ranks]
        letters, digits = _class_of("L"), _class_of("N")
        near = lambda ranges: "".join(r for r in re.findall(r"(?s)\\?.-\\?.", ranges) if ord(r[-1]) < 2 * _NEAR)
        self.far_words, self.near_words = _splitter(letters, digits), _splitter(near(letters), near(digits))


class Encoder:
    """Encodes and decodes in one task; ``remember`` bounds how many words it keeps the ids of."""

    def __init__(self, words: Vocabulary, remember: int = 300_000) -> None:
        self.of, self.remember = words, remember
        self.near_words, self.far_words = re.compile(words.near_words).findall, re.compile(words.far_words).findall
        self.is_far = re.compile(f"[^\\x00-{chr(_NEAR - 1)}]").search
        self.cut = re.compile("(" + "|".join(map(re.escape, words.special)) + ")").split if words.special else lambda text: [text]
        self.library = None
        self.strings = pa.array(words.strings, pa.string())
        # numbers of words; the ids of word k are ids[cuts[k] : cuts[k + 1]]; special tokens come first
        self.known = {text: k for k, text in enumerate(words.special)}
        self.ids = np.array([*words.special.values()], np.int32)
        self.cuts = np.arange(len(words.special) + 1)
        self.letters = 0

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the merges of two symbols."""
        key = left * _SYMBOLS + right
        place = np.searchsorted(self.of.pairs, key)
        place[place == len(self.of.pairs)] = 0
        return np.where(self.of.pairs[place] == key, self.of.ranks[place], _NONE)

    def merged(self, word: str) -> list[int]:
        """Ids of one word: a heap of (rank, place) over a linked list of symbols."""
        ranks, made_of = self.of.rank_of.get, self.of.made
        data = np.frombuffer(word.encode(), np.uint8)
        n = len(data)
        symbols = [*self.of.inner[data[:-1]].tolist(), int(self.of.last[data[-1]]), -1]  # the last one merges with nothing
        after, before = list(range(1, n + 2)), list(range(-1, n))
        agenda = [(ranks(pair, -1), at) for at, pair in enumerate(zip(symbols, symbols[1:], strict=False))]
        agenda = [entry for entry in agenda if entry[0] >= 0]
        heapify(agenda)
        while agenda:
            rank, at = heappop(agenda)
            gone = after[at]
            if symbols[at] < 0 or ranks((symbols[at], symbols[gone])) != rank:
                continue  # stale: one of the two has gone or changed
            symbols[at], symbols[gone] = made, _ = int(made_of[rank]), -1
            after[at] = beyond = after[gone]
            before[beyond] = at
            for place, pair in ((at, (made, symbols[beyond])), (before[at], (symbols[before[at]], made))):
                if (rank := ranks(pair)) is not None:
                    heappush(agenda, (rank, place))
        return [s for s in symbols if s >= 0]

    def merged_together(self, words: list[str], width: int) -> list[tuple[int, ...]]:
        """Ids of words of at most ``width`` bytes, the queue of each one a row of ranks by place.

        In each round every word gives its least entry, the leftmost of equal
        ones.  An entry whose pair changes is overwritten at once, so none that
        is stale is left to skip.
        """
        data = [word.encode() for word in words]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        signs = np.frombuffer(b"".join(data), np.uint8)
        symbols = np.full((len(data), width + 1), -1)  # the last column merges with nothing
        symbols[np.arange(width + 1) < sizes[:, None]] = self.of.inner[signs]
        symbols[np.arange(len(data)), sizes - 1] = self.of.last[signs[np.cumsum(sizes) - 1]]
        after = np.tile(np.arange(1, width + 2), (len(data), 1))
        before = np.tile(np.arange(-1, width), (len(data), 1))
        before[:, 0] = width
        due = np.full(symbols.shape, _NONE)
        due[:, :-1] = self._ranks(symbols[:, :-1], symbols[:, 1:])
        row = np.arange(len(data))
        while len(row):
            at = due[row].argmin(axis=1)
            rank = due[row, at]
            row, at, rank = row[rank < _NONE], at[rank < _NONE], rank[rank < _NONE]
            made, gone = self.of.made[rank], after[row, at]
            beyond, ahead = after[row, gone], before[row, at]
            symbols[row, at], symbols[row, gone] = made, -1
            after[row, at], before[row, beyond], due[row, gone] = beyond, at, _NONE
            due[row, at] = self._ranks(made, symbols[row, beyond])
            due[row, ahead] = self._ranks(symbols[row, ahead], made)
        stay = symbols >= 0
        ids, cuts = symbols[stay].tolist(), np.cumsum(stay.sum(axis=1)).tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *cuts], cuts, strict=False)]

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if not self.is_far(text):
            return self.near_words(text.lower())  # composed as it is: combining marks lie beyond
        if self.library is None:
            from tokenizers import normalizers

            self.library = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        return self.far_words(self.library.normalize_str(text))

    def _learn(self, words: list[str]) -> None:
        """Numbers and ids for new words: short ones merged side by side, long ones by a heap each."""
        sizes = [len(word.encode()) for word in words]
        groups = [[w for w, n in zip(words, sizes, strict=True) if low < n <= width] for low, width in ((0, 16), (16, 48))]
        long = [w for w, n in zip(words, sizes, strict=True) if n > 48]
        found = [*self.merged_together(groups[0], 16), *self.merged_together(groups[1], 48), *map(self.merged, long)]
        self.known.update(zip(chain(*groups, long), range(len(self.cuts) - 1, len(self.cuts) - 1 + len(words)), strict=True))
        counts = np.fromiter(map(len, found), np.int64, len(found))
        self.cuts = np.append(self.cuts, self.cuts[-1] + np.cumsum(counts))
        self.ids = np.append(self.ids, np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum())))
        self.letters += sum(map(len, words))

    def _forget(self) -> None:
        """Where too much is remembered, the older half goes."""
        first, n = len(self.of.special), len(self.cuts) - 1
        if n <= self.remember and self.letters <= 20 * self.remember:
            return
        drop = (n - first + 1) // 2
        self.known = {w: k if k < first else k - drop for w, k in self.known.items() if k < first or k >= first + drop}
        self.ids = np.append(self.ids[: self.cuts[first]], self.ids[self.cuts[first + drop] :])
        later = self.cuts[first + drop + 1 :] - self.cuts[first + drop] + self.cuts[first]
        self.cuts = np.append(self.cuts[: first + 1], later)
        self.letters = sum(map(len, self.known))

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where those of each text end."""
        flat: list[str] = []
        ends = [0]
        for text in texts:
            for i, part in enumerate(self.cut(text or "")):
                if i % 2:
                    flat.append(part)
                else:
                    flat += self.words(part)
            ends.append(len(flat))
        number = np.fromiter(map(self.known.get, flat, repeat(-1)), np.int64, len(flat))
        new = np.flatnonzero(number < 0).tolist()
        if new:
            self._learn([*dict.fromkeys([flat[k] for k in new])])
            number[new] = [self.known[flat[k]] for k in new]
        counts = self.cuts[number + 1] - self.cuts[number]
        done = np.append(0, np.cumsum(counts))
        ids = self.ids[np.repeat(self.cuts[number] - done[:-1], counts) + np.arange(done[-1])]
        self._forget()
        return done[ends], ids

    def decode(self, ends: np.ndarray, ids: np.ndarray) -> pa.Array:
        """Texts from what ``encode`` gave: vocabulary strings one after the other, a blank between them."""
        words = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.strings.take(pa.array(ids)))
        return pc.binary_join(words, " ")


def _slices(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts with at most about ``most`` bytes, or one longer text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + most, "right")))
        yield a, b
        a = b


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """One row per document: id, ids (array of int), decoded (what the ids decode to).

    A NULL or empty text, and one of blanks only, has no ids and decodes to an
    empty text.  Whole texts are encoded, however long; a word of any length is
    one heap.  Repeated rows give equal results, NULL ids stay NULL, an empty
    table gives no rows.  Strings of special tokens in a text become their ids.
    Columns other than the two named ones are not read, so their names cannot
    clash.
    """
    words = Vocabulary(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = Encoder(words)
        for batch in batches:
            for a, b in _slices(batch.column("text")):
                part = batch.slice(a, b - a)
                ends, ids = work.encode(part.column("text").to_pylist())
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": part.column("id"),
                        "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                        "decoded": work.decode(ends, ids),
                    }
                )

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return given.mapInArrow(run, f"id {id_type}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ids_col: str = "ids", out_col: str = "decoded", model: str = MODEL) -> DataFrame:
    """``encoded`` with the column ``out_col`` made of its ids; NULL ids give NULL, ids outside the vocabulary are an error.

    Vocabulary strings are looked up in Spark, so all columns stay as they are.
    """
    strings = Vocabulary(model).strings
    known = F.from_json(F.lit(json.dumps(strings)), "array<string>")
    looked_up = F.transform(F.col(ids_col), lambda i: F.element_at(known, i + 1))
    return encoded.withColumn(out_col, F.array_join(looked_up, " "))
