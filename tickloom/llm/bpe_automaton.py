"""Byte-pair encoding by a deterministic automaton over tokens.

The automaton accepts exactly the token sequences that the merges produce. It starts as one state with a loop for every
base symbol. The merge u v -> w, applied in rank order, is one gadget: the state r that u leads to is copied without its
arc v, u leads to the copy from now on, and w leads from wherever u does to where v led from r. A merge whose r has no
arc v can never apply, and changes nothing.

States share their arcs. A copy is its original less one arc, plus arcs for later tokens, which it has if it has their
left part. So the state behind a token is a chain: the copies made for the token, then those made for its right part
before the token existed, and so on; and whether it has an arc is a handful of table look-ups. Each transition is
looked up once and kept.

A path is found symbol by symbol. Each prefix of a word has exactly one path, so the token that ends at a symbol is the
one that has an arc from where its own start's path ends. What a reader must know of the symbols so far is which tokens
may be under way, each with the token before it; that is its state. Its moves are worked out once and kept in a table, so
most symbols cost one look-up. Decoding emits the labels of the arcs.

Defined cases: null text is empty and has no tokens; rows without doc_id and rows that repeat one are encoded each;
other columns are ignored. Special tokens in a text are read as such, before normalisation.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
import hashlib
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
import regex
from tokenizers import Tokenizer

#: Chunks of text, and moves, that a task keeps at hand; then it starts anew.
KEPT = 200_000
#: White space of Unicode besides the blank; fixed values.
_SPACES = "\t\n\x0b\x0c\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"


@lru_cache(maxsize=1)
def byte_signs() -> list[str]:
    """The printable sign that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Automaton:
    """States, arcs and labels of a vocabulary. ``merges`` are pairs of labels in rank order."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix = suffix
        self.label = {i: s for s, i in vocabulary.items()}
        size = max(self.label, default=-1) + 1
        self.time, self.left, self.right = [0] * size, [-1] * size, [-1] * size
        self.lacks: dict[int, int] = {}  # x * size + z -> when the copy for x lost its arc z
        self.size = size
        self.live = {s: i for s, i in vocabulary.items()}
        made = set()
        for k, (a, b) in enumerate(merges):
            u, v = vocabulary[a], vocabulary[b]
            whole = a + b
            if whole in made or whole not in vocabulary:
                raise ValueError(f"merge {k} makes no new token: {whole!r}")
            made.add(whole)
            w = vocabulary[whole]
            if a in self.live and b in self.live and self._arc(u, v):
                self.time[w], self.left[w], self.right[w] = k + 1, u, v
                self.lacks[u * size + v] = k + 1
            else:
                del self.live[whole]
        self.known: dict[int, bool] = {}
        self._grow_tree()

    def _grow_tree(self) -> None:
        """The labels that can be met, as a tree; nodes know the token that ends there, with and without the suffix."""
        self.kids: list[dict[str, int]] = [{}]
        self.ends, self.last_ends, self.depth = [-1], [-1], [0]
        for label, token in self.live.items():
            final = bool(self.suffix) and label.endswith(self.suffix)
            node = 0
            for sign in label[:-len(self.suffix)] if final else label:
                below = self.kids[node].get(sign)
                if below is None:
                    below = self.kids[node][sign] = len(self.kids)
                    self.kids.append({})
                    self.ends.append(-1)
                    self.last_ends.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = below
            if final:
                self.last_ends[node] = token
            else:
                self.ends[node] = token
        if not self.suffix:
            self.last_ends = self.ends
        self._forget()

    def _forget(self) -> None:
        """Begin the table of moves anew. State 0 stands before a word."""
        self.states: list[tuple[tuple[int, int], ...]] = [((0, -1),)]
        self.numbers = {self.states[0]: 0}
        self.moves: dict[int, tuple[int, int, int]] = {}
        self.final_moves: dict[int, tuple[int, int]] = {}

    def _arc(self, token: int, then: int) -> bool:
        """Whether the state behind ``token`` has an arc ``then``."""
        x, until = token, len(self.time) + 1 << 30
        while x >= 0:
            z, created = then, until
            while z >= 0:
                lost = self.lacks.get(x * self.size + z)
                if lost is not None and lost < until and lost <= created:
                    return False
                created = self.time[z]
                z = self.left[z]
            until = self.time[x]
            x = self.right[x]
        return True

    def arc(self, token: int, then: int) -> bool:
        """The same, from the table of transitions met so far."""
        key = token * self.size + then
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= 2 * KEPT:
                self.known.clear()
            found = self.known[key] = self._arc(token, then)
        return found

    def _move(self, state: int, sign: str, final: bool) -> tuple[int, int]:
        """The token that ends with ``sign``, and its length; keeps the move, and where it leads."""
        under_way, token, length = [], -1, 0
        ends = self.last_ends if final else self.ends
        for node, before in self.states[state]:
            below = self.kids[node].get(sign)
            if below is None:
                continue
            if token < 0 and ends[below] >= 0 and (before < 0 or self.arc(before, ends[below])):
                token, length = ends[below], self.depth[below]
            if self.kids[below] or self.last_ends[below] >= 0:
                under_way.append((below, before))
        if token < 0:
            raise ValueError(f"the sign {sign!r} is not in the vocabulary")
        key = state << 21 | ord(sign)
        if final:
            self.final_moves[key] = token, length
        else:
            reached = (*under_way, (0, token))
            number = self.numbers.setdefault(reached, len(self.states))
            if number == len(self.states):
                self.states.append(reached)
            self.moves[key] = number, token, length
        return token, length

    def encode_word(self, word: str) -> list[int]:
        """Tokens of a word in byte signs; the last sign carries the suffix."""
        if len(self.moves) + len(self.final_moves) > 2 * KEPT:
            self._forget()
        moves, state, path = self.moves, 0, []
        for sign in word[:-1]:
            move = moves.get(state << 21 | ord(sign))
            if move is None:
                self._move(state, sign, False)
                move = moves[state << 21 | ord(sign)]
            path.append(move)
            state = move[0]
        token, length = self.final_moves.get(state << 21 | ord(word[-1])) or self._move(state, word[-1], True)
        found, at = [token], len(word) - length
        while at:
            _, token, length = path[at - 1]
            found.append(token)
            at -= length
        found.reverse()
        return found


class _Classes(dict):
    """For ``str.translate``: a sign of the same class for the word split, as the library that wrote the file tells them.

    Each sign is asked for once: a letter clings to a letter, what is neither letter, number nor white space to a stop.
    """

    def __init__(self, pre_tokenizer):
        super().__init__((k, k) for k in range(128))
        self.pre_tokenizer = pre_tokenizer

    def __missing__(self, code: int) -> int:
        sign = chr(code)
        # what stands for a letter is no ASCII one, so that no contraction comes about
        if len(self.pre_tokenizer.pre_tokenize_str("a" + sign)) == 1:
            stands = "é"
        elif len(self.pre_tokenizer.pre_tokenize_str("!" + sign)) == 1:
            stands = "§"
        else:
            stands = "²"
        self[code] = ord(stands)
        return self[code]


class Encoder:
    """The tokenizer of a JSON file with a BPE model on byte signs: normaliser, word split, automaton, labels."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model = held["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        steps = [s["type"] for s in held["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or held["decoder"] is not None:
            raise ValueError("only the normalisers NFC, white space and lower case, and no decoder, are known")
        library = Tokenizer.from_file(path)
        self.normalizer, self.classes = library.normalizer, _Classes(library.pre_tokenizer)
        self.split = regex.compile(held["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.chunks: dict[str, tuple[bytes, str]] = {}
        self.met: set[str] = set()
        self.odd: set[str] = set()

    def _words(self, chunk: str) -> list[str]:
        if chunk.isascii():
            return [chunk] if chunk.isalpha() else self.split.findall(chunk)
        return [chunk[m.start():m.end()] for m in self.split.finditer(chunk.translate(self.classes))]

    def _chunk(self, chunk: str) -> tuple[bytes, str]:
        signs, ids = byte_signs(), []
        for word in self._words(chunk):
            ids += self.automaton.encode_word(word if word.isascii() and word.isprintable() else "".join([signs[b] for b in word.encode()]))
        label = self.automaton.label
        found = np.array(ids, "<u4").tobytes(), " ".join([label[i] for i in ids])
        if len(chunk) <= 64:
            if len(self.chunks) >= KEPT:
                self.chunks.clear()
            self.chunks[chunk] = found
        return found

    def _normal(self, text: str) -> str:
        """NFC, blanks for white space, lower case. The library does it for text with signs newer than Unicode 3.2.

        Normal forms of older signs never change, and their lower case is compared once.
        """
        if not text.isascii():
            signs = set(text)
            new = signs - self.met
            if new:
                self.met |= new
                self.odd |= {c for c in new if unicodedata.ucd_3_2_0.category(c) == "Cn" or (
                    c not in _SPACES and self.normalizer.normalize_str(c) != unicodedata.normalize("NFC", c).replace("Σ", "σ").lower())}
            if not self.odd.isdisjoint(signs):
                return self.normalizer.normalize_str(text)
            text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # lower case is sign by sign, without the final sigma
        for space in _SPACES:
            if space in text:
                text = text.replace(space, " ")
        return text.lower()

    def _plain(self, text: str) -> Iterator[tuple[bytes, str]]:
        known = self.chunks
        for chunk in self._normal(text).split(" "):
            if chunk:
                found = known.get(chunk)
                yield self._chunk(chunk) if found is None else found

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, and the text that their labels make."""
        if self.marks and "<" in text:
            found = []
            for k, part in enumerate(self.marks.split(text)):
                if k % 2:
                    found.append((np.array([self.special[part]], "<u4").tobytes(), part))
                else:
                    found += self._plain(part)
        else:
            found = list(self._plain(text))
        return b"".join([i for i, _ in found]), " ".join([s for i, s in found if i])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array), decoded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = encoder(path)
        for batch in batches:
            for k in range(batch.num_rows):
                ids, decoded = use.encode(batch.column(1)[k].as_py() or "")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, 1), pa.array([np.frombuffer(ids, "<u4").astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([decoded], pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, and SHA-256 of the ids' bytes and of the decoded text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = encoder(path)
        for batch in batches:
            count, first, second = [], [], []
            for text in batch.column(1):
                ids, decoded = use.encode(text.as_py() or "")
                count.append(len(ids) // 4)
                first.append(hashlib.sha256(ids).hexdigest())
                second.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
