"""BPE encoding by a prefix-sharing trie, and decoding.

The distinct pieces of a run of documents are walked in sorted order, which is a depth-first walk of their trie: what a
piece shares with the one before stays on the stack. Each trie node holds one state, the last token of its prefix's
encoding. That token is the longest token the prefix ends with which may follow the last token of the rest, so an
encoding is read off backwards, and that of a shared prefix is worked out once.

Text is cut at ASCII white space first, each distinct word is normalised and cut into pieces as the tokenizer file
says; words with characters beyond the Latin ones go through the library's own normaliser for that.

Defined cases: a null or empty text has no tokens; strings of special tokens in a text are those tokens; repeated rows
each get theirs; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from dayloom.llm.common import documents, per_slice, word_codes

#: Bytes of text whose words share one trie.
TRIE_BYTES = 32 << 20
#: Characters that normalising leaves as they are but for their case, and that every library classes alike.
FAST = r"^[\x21-\x7E\xA1-\xAC\xAE-\x{12F}\x{131}-\x{148}\x{14A}-\x{17E}]+$"
LETTERS = r"^[A-Za-z\xC0-\xD6\xD8-\xF6\xF8-\x{12F}\x{131}-\x{148}\x{14A}-\x{17E}]+$"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|\n|[^\s\p{L}\p{N}]+"


class Encoder:
    """A tokenizer file's vocabulary: byte symbols, merges in order of rank, and an automaton that finds tokens."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.pieces = regex.compile(PIECES)
        vocabulary: dict[str, int] = spec["model"]["vocab"]
        end = spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_words = regex.compile("|".join(f"({regex.escape(s)})" for s in self.special)) if self.special else None
        self.names = {i: t for t, i in vocabulary.items()} | {i: s for s, i in self.special.items()}
        letters = self._byte_letters(ByteLevel)
        self.byte_of = {letter: b for b, letter in enumerate(letters)}
        self.inner = [vocabulary[letter] for letter in letters]
        self.final = [vocabulary[letter + end] for letter in letters]
        self.merged: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for pair in spec["model"]["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, whole = vocabulary[a], vocabulary[b], vocabulary[a + b]
            self.merged.setdefault(left << 16 | right, whole)
            self.halves.setdefault(whole, (left, right))
        self.follows: dict[int, bool] = {}
        self._build_automaton()

    @staticmethod
    def _byte_letters(byte_level) -> list[str]:
        """The letter that stands for each byte: printable ones for themselves, the others from U+0100 on."""
        own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
        others = iter(range(256, 512))
        letters = [chr(b) if b in own else chr(next(others)) for b in range(256)]
        assert set(letters) == set(byte_level.alphabet())
        return letters

    def _symbols(self, token: int) -> list[int]:
        flat, stack = [], [token]
        while stack:
            top = stack.pop()
            if top in self.halves:
                stack += reversed(self.halves[top])
            else:
                flat.append(top)
        return flat

    def _may_follow(self, x: int, y: int, within: bool = False) -> bool:
        """Whether tokens x and y stand side by side in the encoding of their joined text.

        Merges are undone, the later first; a merge across the boundary that would have come before an undone one
        shows that they don't. ``within`` leaves the first look out: the two are halves of a token.
        """
        limit = 1 << 30
        while True:
            across = self.merged.get(x << 16 | y)
            if across is not None and across < limit and not within:
                return False
            within = False
            if x > y:
                if x not in self.halves:
                    return True
                limit, x = x, self.halves[x][1]
            else:
                if y not in self.halves:
                    return True
                limit, y = y + 1, self.halves[y][0]

    def _build_automaton(self) -> None:
        """Transitions by state and symbol, and per state the tokens its path ends with, the longest first."""
        goto: dict[int, int] = {}
        ends: list[tuple[tuple[int, int], ...]] = [()]
        children: list[list[tuple[int, int]]] = [[]]
        own: list[int] = [-1]
        tokens = [*self.inner, *self.final, *(t for t, (a, b) in self.halves.items() if self._may_follow(a, b, True))]
        self.length = {}
        for token in tokens:
            state, symbols = 0, self._symbols(token)
            self.length[token] = len(symbols)
            for symbol in symbols:
                key = state << 16 | symbol
                after = goto.get(key)
                if after is None:
                    after = goto[key] = len(own)
                    own.append(-1)
                    ends.append(())
                    children.append([])
                    children[state].append((symbol, after))
                state = after
            own[state] = token
        fail, queue = [0] * len(own), [0]
        for state in queue:
            for symbol, child in children[state]:
                back = fail[state]
                while state and back and back << 16 | symbol not in goto:
                    back = fail[back]
                fail[child] = goto.get(back << 16 | symbol, 0) if state else 0
                tail = ends[fail[child]]
                ends[child] = ((own[child], self.length[own[child]]), *tail) if own[child] >= 0 else tail
                queue.append(child)
        self.goto, self.fail, self.ends = goto, fail, ends

    def _step(self, state: int, symbol: int) -> int:
        first, goto = state, self.goto
        while True:
            after = goto.get(state << 16 | symbol)
            if after is not None or not state:
                break
            state = self.fail[state]
        after = after or 0
        goto[first << 16 | symbol] = after
        return after

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row and where each one's begin; the pieces are distinct, not empty and sorted."""
        goto, ends, follows, length = self.goto, self.ends, self.follows, self.length
        inner, final = self.inner, self.final
        deepest = max(map(len, pieces), default=0) + 1
        states, last = [0] * (deepest + 1), [0] * (deepest + 1)
        ids: list[int] = []
        offsets = np.zeros(len(pieces) + 1, np.int64)
        before, known = b"", 0  # the stack holds the first ``known`` bytes of the piece before
        for number, piece in enumerate(pieces):
            depth = len(piece) - 1
            j, most = 0, min(known, depth)
            while j < most and before[j] == piece[j]:
                j += 1
            while j <= depth:
                symbol = inner[piece[j]] if j < depth else final[piece[j]]
                state = goto.get(states[j] << 16 | symbol)
                if state is None:
                    state = self._step(states[j], symbol)
                j += 1
                for token, size in ends[state]:
                    if size == j:
                        break
                    key = last[j - size] << 16 | token
                    fits = follows.get(key)
                    if fits is None:
                        fits = follows[key] = self._may_follow(key >> 16, token)
                    if fits:
                        break
                if j <= depth:
                    states[j], last[j] = state, token
            known, before = depth, piece
            start = len(ids)
            ids.append(token)
            j -= length[token]
            while j:
                token = last[j]
                ids.append(token)
                j -= length[token]
            ids[start:] = ids[:start - 1 if start else None:-1]
            offsets[number + 1] = len(ids)
        if len(follows) > 500_000:
            follows.clear()
        return np.array(ids, np.int64), offsets

    def encode_words(self, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (without ASCII white space) in a row, and where each one's begin."""
        lowered = pc.utf8_lower(vocabulary)
        whole_word = pc.match_substring_regex(vocabulary, LETTERS)
        fast = pc.and_not(pc.match_substring_regex(vocabulary, FAST), whole_word)
        for content in self.special:
            fast = pc.and_not(fast, pc.match_substring(vocabulary, content))
        odd = pc.invert(pc.or_(fast, whole_word))
        rows = [np.flatnonzero(mask.to_numpy(zero_copy_only=False)) for mask in (whole_word, fast, odd)]
        joined = pc.binary_join(pa.array([lowered.filter(fast)], pa.list_(pa.string())), "\n")[0].as_py()
        cut = pa.array(self.pieces.findall(joined), pa.string())
        breaks = pc.equal(cut, "\n")
        after = breaks.to_numpy(zero_copy_only=False).astype(bool)
        owner = [rows[0], rows[1][np.cumsum(after)[~after]] if len(rows[1]) else rows[1]]
        found = [lowered.filter(whole_word), cut.filter(pc.invert(breaks))]
        odd_owner, odd_piece, odd_id = [], [], []
        for word in rows[2].tolist():
            for piece, token in self._odd_word(vocabulary[word].as_py()):
                odd_owner.append(word)
                odd_piece.append(piece)
                odd_id.append(token)
        owner.append(np.array(odd_owner, np.int64))
        found.append(pa.array([p or b"" for p in odd_piece], pa.binary()))
        coded = pa.concat_arrays([f.cast(pa.binary()) for f in found]).dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if odd_id:
            token = np.array(odd_id, np.int64)
            codes[len(codes) - len(token):][token >= 0] = -1 - token[token >= 0]
        order = pc.array_sort_indices(coded.dictionary).to_numpy()
        pieces = coded.dictionary.take(pa.array(order)).to_pylist()
        empty = int(bool(pieces) and not pieces[0])
        pieces = pieces[empty:]
        place = np.zeros(len(order) + 1, np.int64)
        place[order] = np.arange(len(order)) - empty
        owner = np.concatenate(owner)
        ids, offsets = self.encode_pieces(pieces)
        order = np.argsort(owner, kind="stable")
        owner, codes = owner[order], codes[order]
        whole = codes < 0  # a special token by itself
        at = place[np.where(whole, 0, codes)]
        sizes = np.where(whole, 1, np.diff(offsets)[at] if len(pieces) else 1)
        flat = gather(ids, offsets[at], np.where(whole, 0, sizes))
        made = np.empty(int(sizes.sum()), np.int64)
        spread = np.repeat(whole, sizes)
        made[~spread], made[spread] = flat, -1 - codes[whole]
        counts = np.bincount(owner, weights=sizes, minlength=len(vocabulary)).astype(np.int64)
        return made, np.concatenate([[0], np.cumsum(counts)])

    def _odd_word(self, word: str) -> list[tuple[bytes | None, int]]:
        """Pieces of a word as the library cuts it: bytes to encode, or None with the id of a special token."""
        parts = [p for p in self.special_words.split(word) if p] if self.special_words else [word]
        found: list[tuple[bytes | None, int]] = []
        for part in parts:
            if part in self.special:
                found.append((None, self.special[part]))
                continue
            normal = self.library.normalizer.normalize_str(part)
            for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(normal):
                found.append((bytes(self.byte_of[letter] for letter in piece), -1))
        return found


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``values[start:start + size]`` one after the other."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return values[:0]
    shift = np.repeat(starts - (ends - sizes), sizes)
    return values[shift + np.arange(ends[-1])]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of all texts, where each text's begin, ids of the distinct words, where each word's begin."""
    codes, offsets, vocabulary = word_codes(texts)
    ids, starts = encoder(path).encode_words(vocabulary)
    return codes, offsets, ids, starts


def text_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts in a row, and where each text's begin."""
    codes, offsets, ids, starts = encode_texts(texts, path)
    sizes = np.diff(starts)[codes] if len(codes) else np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return gather(ids, starts[codes], sizes), ends[offsets]


def expanded(texts: pa.Array, path: str, most: int = 2_000_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of some ``most`` tokens: number of the first, token ids in a row, where each text's begin.

    The words of all texts share one trie; their ids are written out run by run.
    """
    codes, offsets, ids, starts = encode_texts(texts, path)
    ids, size_of = ids.astype(np.uint32), np.diff(starts)
    ends = np.concatenate([[0], np.cumsum(size_of[codes])])[offsets] if len(codes) else np.zeros(len(offsets), np.int64)
    first = 0
    while first < len(texts):
        stop = max(first + 1, int(np.searchsorted(ends, ends[first] + most, side="right")) - 1)
        own = codes[offsets[first]:offsets[stop]]
        yield first, gather(ids, starts[own], size_of[own]), ends[first:stop + 1] - ends[first]
        first = stop


def decode(ids: np.ndarray, path: str) -> str:
    """The tokens' strings joined by a space, as a tokenizer without a decoder does."""
    names = encoder(path).names
    return " ".join(names[int(i)] for i in ids if int(i) in names)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids, an array of all token ids of each whole text."""
    frame = documents(docs)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, offsets = text_ids(part.column("text"), path)
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))], ["doc_id", "ids"])

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(per_slice(run, limit=TRIE_BYTES), f"doc_id {kind}, ids array<int>")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 and decoded_sha256 of the whole text, encoded and decoded again."""
    frame = documents(docs)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        codes, offsets, ids, starts = encode_texts(part.column("text"), path)
        names = encoder(path).names
        sizes = np.diff(starts)
        real = (sizes > 0)[codes] if len(codes) else np.zeros(0, bool)
        offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
        codes = codes[real]
        listed, ends = ids.tolist(), starts.tolist()
        numbers, strings = np.empty(len(sizes), object), np.empty(len(sizes), object)
        number_of = {i: str(i) for i in set(listed)}
        for word in range(len(sizes)):
            own = listed[ends[word]:ends[word + 1]]
            numbers[word] = " ".join([number_of[i] for i in own])
            strings[word] = " ".join([names[i] for i in own])
        n_tokens = np.add.reduceat(np.append(sizes[codes], 0), offsets[:-1]) * (np.diff(offsets) > 0)
        hashed: list[list[str]] = [[], []]
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            own = codes[a:b]
            for out, words in zip(hashed, (numbers, strings), strict=True):
                out.append(sha256(" ".join(words[own].tolist()).encode()).hexdigest())
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n_tokens, pa.int64()),
                                           *(pa.array(h, pa.string()) for h in hashed)],
                                          ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(per_slice(run, limit=TRIE_BYTES),
                            f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
