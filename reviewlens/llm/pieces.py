"""SentencePiece encoding and decoding with a streaming Viterbi.

The lattice has a node per character boundary and an edge per piece. For each boundary the best way to
reach it is kept as a backpointer, in a window: whenever the backpointer paths of all boundaries from
which a piece can still start (the last ``longest`` ones) meet in one boundary, the ids before it are
final and are given out, and the window starts anew there.

Two kinds of models:

* unigram: the best way has the largest sum of piece scores;
* BPE: merging gives one segmentation, and every prefix of it is the segmentation of its own text. So
  each boundary has exactly one way: the piece whose neighbour to the left, the last piece of the
  shorter prefix, stays apart from it when the two are merged alone. This makes BPE ids exact too,
  where summed scores would not.

Characters outside the vocabulary become byte pieces, or the unknown id without byte fallback.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNIGRAM, BPE = 1, 2
_NORMAL, _UNKNOWN, _BYTE = 1, 2, 6
#: Entries of a worker's caches (words, pairs of pieces, word beginnings), and the length of words that
#: are cached and of the beginnings that words share. Words stand for the parts of a text that no piece leaves.
CACHE, PAIRS, HEADS, CACHED, HEAD = 200_000, 400_000, 40_000, 48, 6
#: Codes of pieces are their ids; those of characters outside the vocabulary start here.
_CHAR, _NONE = 1 << 20, (1 << 22) - 1
#: Parts of a text between which no piece stretches, for models that are so.
_WORDS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
#: The same for models in which letters and other characters never share a piece.
_RAISED = "\u00b2\u00b3\u00b9\u00bc-\u00be\u2070-\u2079\u2080-\u2089"
_LETTER = re.compile(rf"[^\W\d_{_RAISED}]")
_PARTS = re.compile(f"{SPACE}*{_LETTER.pattern}+|{SPACE}*(?:[^\\w{SPACE}\n]++|[\\d_{_RAISED}]++)++|{SPACE}+|\n")


@dataclass(frozen=True)
class Vocabulary:
    kind: int
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    types: tuple[int, ...]
    byte_fallback: bool
    dummy_prefix: bool


def read_vocabulary(model: bytes) -> Vocabulary:
    """Vocabulary of a serialized model; only what the codec can follow exactly is accepted."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    read = proto.ModelProto()
    read.ParseFromString(model)
    spec, normal = read.trainer_spec, read.normalizer_spec
    types = tuple(piece.type for piece in read.pieces)
    if spec.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models")
    if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces:
        raise ValueError("only models with the identity normalizer")
    if not set(types) <= {_NORMAL, _UNKNOWN, 3, _BYTE}:
        raise ValueError("no user-defined or unused pieces")
    return Vocabulary(
        spec.model_type,
        tuple(piece.piece for piece in read.pieces),
        tuple(piece.score for piece in read.pieces),
        types,
        spec.byte_fallback,
        normal.add_dummy_prefix,
    )


class _Memo(dict):
    """Answers of a function by key, ``size`` at most, half of them those asked for last; none for which ``keep`` is not."""

    def __init__(self, answer: Callable, size: int, keep: Callable = lambda key: True) -> None:
        self.answer, self.size, self.keep, self.older = answer, size // 2, keep, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.answer(key)
        if self.keep(key):
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[key] = found
        return found


class Codec:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        rows = list(zip(vocabulary.pieces, vocabulary.scores, vocabulary.types, strict=True))
        self.ids = {piece: i for i, (piece, _, kind) in enumerate(rows) if kind == _NORMAL}
        self.scores = {piece: score for piece, score, kind in rows if kind == _NORMAL}
        self.bytes = {int(piece[1:-1], 16): i for i, (piece, _, kind) in enumerate(rows) if kind == _BYTE}
        self.unknown = vocabulary.types.index(_UNKNOWN) if _UNKNOWN in vocabulary.types else 0
        self.longest = max(map(len, self.ids), default=1)
        self.unknown_score = min(self.scores.values(), default=0.0) - 10
        #: No piece goes on over a word start or a line end, so all paths meet there.
        self.words_apart = not any(SPACE in p.lstrip(SPACE) or ("\n" in p and len(p) > 1) for p in self.ids)
        self.text = [bytes([int(p[1:-1], 16)]) if t == _BYTE else b"" if t == 3 else p.replace(SPACE, " ").encode() for p, _, t in rows]
        letters_apart = not any(
            bool(_LETTER.match(a)) != bool(_LETTER.match(b)) for p in map(self.bare, self.ids) for a, b in zip(p, p[1:])
        )
        self.parts = _PARTS if letters_apart else _WORDS
        if vocabulary.kind == BPE:
            self.plant()
        self.known = _Memo(self.word, CACHE, lambda word: len(word) <= CACHED)
        self.heads = _Memo(self.head, HEADS)
        self.apart = _Memo(self.stay_apart, PAIRS)
        self.window = 0

    # segmentation

    @staticmethod
    def bare(piece: str) -> str:
        return piece.lstrip(SPACE)

    def plant(self) -> None:
        """An Aho-Corasick automaton: a state is the longest beginning of a piece that the text read ends with, and
        ``ending`` has the (length, id) of the pieces that it ends with, the longest first."""
        self.trie: dict[int, int] = {}
        own: dict[int, tuple[int, int]] = {}
        rows: list[list[tuple[int, int, int]]] = [[] for _ in range(self.longest + 1)]
        for piece, i in self.ids.items():
            state = 0
            for depth, char in enumerate(piece, 1):
                key = state << 21 | ord(char)
                if key not in self.trie:
                    self.trie[key] = len(self.trie) + 1
                    rows[depth].append((state, ord(char), self.trie[key]))
                state = self.trie[key]
            own[state] = len(piece), i
        self.shorter = [0] * (len(self.trie) + 1)
        self.ending: list[tuple[tuple[int, int], ...]] = [()] * (len(self.trie) + 1)
        self.steps = _Memo(self.step, len(self.trie) + PAIRS)
        for depth, row in enumerate(rows):
            for parent, char, state in row:
                if depth > 1:
                    self.shorter[state] = self.step(self.shorter[parent] << 21 | char)
                others = self.ending[self.shorter[state]]
                self.ending[state] = (own[state], *others) if state in own else others

    def step(self, key: int) -> int:
        """The state after one more character, given with the state before in one number."""
        state, char = key >> 21, key & (1 << 21) - 1
        while (found := self.trie.get(state << 21 | char)) is None and state:
            state = self.shorter[state]
        return found or 0

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging the best pair, the leftmost of equals, again and again."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stay_apart(self, key: int) -> bool:
        """Whether merging the text of two pieces, given by their codes in one number, leaves just the two."""
        left, right = key >> 22, key & _NONE
        pair = [self.spelled(left), self.spelled(right)] if left != _NONE else [self.spelled(right)]
        return self.merged("".join(pair)) == pair

    def spelled(self, code: int) -> str:
        return chr(code - _CHAR) if code >= _CHAR else self.vocabulary.pieces[code]

    def stream(self, text: str) -> Iterator[str]:
        """Pieces of a text in order, each as soon as it is final."""
        bpe, longest = self.vocabulary.kind == BPE, self.longest
        held, back, best, codes, state = "", [0], [0.0], [_NONE], 0  # codes: the piece that ends at each boundary
        for char in text:
            held += char
            end = len(held)
            if bpe:
                state = self.grow(char, back, codes, state)
            else:
                top = None
                back.append(end - 1)
                for start in range(max(0, end - longest), end):
                    score = self.scores.get(held[start:end])
                    if score is None:
                        if start < end - 1:
                            continue
                        score = self.unknown_score
                    if top is None or best[start] + score > top:
                        top, back[end] = best[start] + score, start
                best.append(top)
            self.window = max(self.window, end)
            if end % 32 == 0 and (meet := self.meeting(back, end)):
                yield from self.path(held, back, meet)
                held, back = held[meet:], [max(b - meet, 0) for b in back[meet:]]
                best, codes = best[meet:], codes[meet:]
        yield from self.path(held, back, len(held))

    def grow(self, more: str, back: list[int], codes: list[int], state: int) -> int:
        """Carry the BPE lattice on over the characters of ``more``: start and code of the last piece at each
        boundary. Gives the automaton's state behind them."""
        steps, ending, apart, end = self.steps, self.ending, self.apart, len(back) - 1
        for char in more:
            end += 1
            code = ord(char)
            state = steps[state << 21 | code]
            for size, code in ending[state]:
                if apart[codes[end - size] << 22 | code]:
                    break
            else:
                size, code = 1, _CHAR + ord(char)
            back.append(end - size)
            codes.append(code)
        return state

    def head(self, word: str) -> tuple[list[int], list[int], int]:
        back, codes = [0], [_NONE]
        state = self.grow(word, back, codes, 0)
        return back, codes, state

    def short(self, word: str) -> list[int]:
        """BPE ids of a short text: the same lattice, whose first columns words with one beginning share."""
        back, codes, state = self.heads[word[:HEAD]]
        back, codes = back.copy(), codes.copy()
        self.grow(word[HEAD:], back, codes, state)
        out, end = [], len(word)
        while end:
            code = codes[end]
            if code < _CHAR:
                out.append(code)
            else:
                out.extend(self.bytes[byte] for byte in reversed(word[end - 1].encode()))
            end = back[end]
        return out[::-1]

    def meeting(self, back: list[int], end: int) -> int:
        """The last boundary on the paths of all boundaries that a piece can still start from."""
        live = set(range(max(0, end - self.longest + 1), end + 1))
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(back[last])
        return live.pop()

    @staticmethod
    def path(text: str, back: list[int], end: int) -> list[str]:
        pieces = []
        while end > 0:
            pieces.append(text[back[end] : end])
            end = back[end]
        return pieces[::-1]

    # ids and texts

    def _ids(self, pieces: Iterator[str] | list[str]) -> list[int]:
        out: list[int] = []
        lost = False
        for piece in pieces:
            found = self.ids.get(piece)
            if found is not None:
                out.append(found)
                lost = False
            elif self.vocabulary.byte_fallback:
                out.extend(self.bytes[byte] for byte in piece.encode())
            elif not lost:
                out.append(self.unknown)
                lost = True
        return out

    def word(self, word: str) -> bytes:
        """Ids of a part of a text, four bytes each."""
        whole = len(word) > CACHED or self.vocabulary.kind != BPE
        return array("i", self._ids(self.stream(word)) if whole else self.short(word)).tobytes()

    def packed(self, text: str) -> bytes:
        """Ids of a text, four bytes each."""
        if not text:
            return b""
        text = (SPACE if self.vocabulary.dummy_prefix else "") + text.replace(" ", SPACE)
        if not self.words_apart or not self.vocabulary.byte_fallback:
            return array("i", self._ids(self.stream(text))).tobytes()
        known = self.known
        return b"".join([known[word] for word in self.parts.findall(text)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), dtype=np.intc).tolist()

    def decode(self, ids: list[int]) -> str:
        whole = b"".join(map(self.text.__getitem__, ids))
        if self.vocabulary.dummy_prefix and whole[:1] == b" ":
            whole = whole[1:]
        return whole.decode("utf-8", "replace")



def _codecs(model: bytes) -> Codec:
    """One codec per Python worker and model, so that its caches serve all tasks."""
    if model not in _HELD:
        _HELD.clear()
        _HELD[model] = Codec(read_vocabulary(model))
    return _HELD[model]


_HELD: dict[bytes, Codec] = {}


def _lists(packed: list[bytes | None]) -> pa.Array:
    """Lists of ids; a null for None."""
    ends = np.cumsum([0, *(len(ids or b"") // 4 for ids in packed)]).astype(np.int32)
    nulls = np.array([*(ids is None for ids in packed), False])
    values = np.frombuffer(b"".join([ids or b"" for ids in packed]), dtype=np.intc)
    return pa.ListArray.from_arrays(pa.array(ends, mask=nulls), pa.array(values))


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id_col, ids (array of int; null for a null text), window (longest stretch of characters
    that any text of the batch made wait for its final ids).

    ``model`` is a serialized SentencePiece model. Empty texts have no ids. Rows stay one to one,
    repeated ones too; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codecs(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                codec.window = 0
                ids = [None if text is None else codec.packed(text) for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        _lists(ids),
                        pa.array([codec.window] * len(ids), pa.int32()),
                    ],
                    [id_col, "ids", "window"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"`{id_col}` {kind}, ids array<int>, window int"
    )


def decode(encoded: DataFrame, model: bytes, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """The rows with the text of their ids in ``text_col``; null ids give a null text.

    A literal U+2581 in the text that was encoded comes back as a space, as the format stores both alike.
    """
    from pyspark.sql.types import StringType, StructField, StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codecs(model)
        for batch in batches:
            texts = [None if ids is None else codec.decode(ids) for ids in batch.column(ids_col).to_pylist()]
            columns = [batch.column(name) for name in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*batch.schema.names, text_col])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField(text_col, StringType())]))


def round_trip(
    docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """Encode every text, decode its ids in the same pass, and tell whether the text came back: id_col,
    n_ids, ids, window, round_trip (null texts have null ids and a null round_trip); then the columns of
    ``carry`` as they are."""
    carry = list(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codecs(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                codec.window = 0
                texts = part.column("text").to_pylist()
                packed = [None if text is None else codec.packed(text) for text in texts]
                ids = _lists(packed)
                back = [None if x is None else np.frombuffer(x, dtype=np.intc).tolist() for x in packed]
                same = [None if x is None else codec.decode(x) == text for x, text in zip(back, texts, strict=True)]
                columns = [
                    part.column("id"),
                    pa.array([None if x is None else len(x) // 4 for x in packed], pa.int64()),
                    ids,
                    pa.array([codec.window] * len(packed), pa.int32()),
                    pa.array(same, pa.bool_()),
                    *(part.column(2 + i) for i in range(len(carry))),
                ]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "n_ids", "ids", "window", "round_trip", *carry])

    kinds = {name: docs.schema[name].dataType.simpleString() for name in (id_col, *carry)}
    others = "".join(f", `{name}` {kinds[name]}" for name in carry)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *carry).mapInArrow(
        run, f"`{id_col}` {kinds[id_col]}, n_ids bigint, ids array<int>, window int, round_trip boolean{others}"
    )
