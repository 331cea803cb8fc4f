"""BPE encoding over a trie of distinct words, and decoding.

For byte-pair encoding the encoding of a prefix is fixed by its last token: it is the encoding of
what stands before that token, plus the token, and exactly one token that ends there forms a valid
pair with the last token before it. So a trie of the distinct words is walked depth first, and
each node gets its last token from its ancestors: shared prefixes are encoded once. A word's ids
are read back along the last tokens. Nothing is shuffled; a task's tries are as large as a chunk
of text.

Defined results: a NULL or empty text has no ids and decodes to the empty text; special tokens
written in a text become their ids; texts are encoded whole; other columns pass through. Input
columns named like an output column are replaced.
"""

from __future__ import annotations

import functools
import gc
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from foldcast.llm.words import chunks, coded, split, text_of

SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"
#: Text whose words share one trie: about 20 bytes of memory for each byte.
TRIE_BYTES = 4 << 20


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Tokens and merges of a word-level BPE file with word ends."""

    def __init__(self, text: str):
        model = json.loads(text)
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.ids: dict[str, int] = model["model"]["vocab"]
        size = 1 + max([*self.ids.values(), *self.special.values()])
        self.tokens = [""] * size
        for token, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = token
        self.rank, self.parts, self.merge = [-1] * size, [(-1, -1)] * size, {}
        for rank, pair in enumerate(model["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, whole = self.ids[a], self.ids[b], self.ids[a + b]
            self.rank[whole], self.parts[whole] = rank, (left, right)
            self.merge[left, right] = rank
        self.longest = max(len(t.removesuffix(END)) for t in self.ids)
        self.fits: dict[tuple[int, int], bool] = {}
        letters = byte_letters()
        self.letters = {i: c for i, c in enumerate(letters)}
        self.split = regex.compile(r"\n|" + SPLIT)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.whole = {i for i in self.ids.values() if self._whole(i)}
        self.inner = {t: i for t, i in self.ids.items() if i in self.whole and not t.endswith(END)}
        self.final = {t.removesuffix(END): i for t, i in self.ids.items()
                      if i in self.whole and t.endswith(END)}

    def pair_fits(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens stay apart when their text is encoded.

        The later of the two tokens' last merges is undone, over and over; the pair would have
        joined if the tokens at the border have a merge that comes before the one just undone.
        Equal merges run from left to right.
        """
        known = self.fits.get((left, right))
        if known is not None:
            return known
        a, b, before = left, right, len(self.merge) + 1
        fits = True
        while True:
            rank = self.merge.get((a, b))
            if rank is not None and rank < before:
                fits = False
                break
            if self.rank[a] > self.rank[b]:
                before, a = self.rank[a], self.parts[a][1]
            elif self.rank[b] >= 0:
                before, b = self.rank[b] + 1, self.parts[b][0]
            else:
                break
        if len(self.fits) > 500_000:  # memory only; a forgotten pair is worked out again
            self.fits.clear()
        self.fits[left, right] = fits
        return fits

    def _whole(self, token: int) -> bool:
        """Whether a token's own text is encoded as that token: its parts must be the ones met."""
        left, right = self.parts[token]
        if left < 0:
            return True
        rank, a, b, before = self.rank[token], left, right, self.rank[token]
        while True:
            if self.rank[a] > self.rank[b]:
                before, a = self.rank[a], self.parts[a][1]
            elif self.rank[b] >= 0:
                before, b = self.rank[b] + 1, self.parts[b][0]
            else:
                break
            met = self.merge.get((a, b))
            if met is not None and met < min(before, rank):
                return False
        return self._whole(left) and self._whole(right)

    def normal(self, text: str) -> str:
        """Composed and lower-cased letter by letter (no rule for the end of a word)."""
        text = unicodedata.normalize("NFC", text)
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def lettered(self, piece: str) -> str:
        """A piece in byte letters."""
        if piece.isascii() and piece.isprintable():
            return piece
        return piece.encode().decode("latin-1").translate(self.letters)


class Trie:
    """Words by their letters; a node is a dict of letters, words end at the mark ``""``."""

    def __init__(self, words):
        self.root: dict = {}
        for number, word in enumerate(words):
            node = self.root
            for letter in word[:-1]:
                node = node.setdefault(letter, {})
            # the last letter carries the word end, so it is a symbol of its own
            node.setdefault("", []).append((word[-1], number))

    def encode(self, vocabulary: Vocabulary, count: int) -> list[list[int]]:
        """Ids of every word: depth-first walk that hands last tokens down."""
        out: list[list[int]] = [[]] * count
        inner, final = vocabulary.inner, vocabulary.final
        fits, longest = vocabulary.pair_fits, vocabulary.longest
        last: list[int] = [-1]    # last token of the prefix of each length
        start: list[int] = [-1]   # where that token starts
        stack = [(self.root, 0, "")]
        while stack:
            node, depth, path = stack.pop()
            if depth:
                del last[depth:], start[depth:]
                # exactly one token fits; most often it lengthens the last one
                a = start[depth - 1] if depth > 1 else 0
                token = inner.get(path[a:])
                if token is None or a and not fits(last[a], token):
                    for a in range(depth - 1, max(-1, depth - 1 - longest), -1):
                        token = inner.get(path[a:])
                        if token is not None and (a == 0 or fits(last[a], token)):
                            break
                    else:
                        raise ValueError(f"no token ends {path!r}")
                last.append(token)
                start.append(a)
            for letter, below in node.items():
                if letter:
                    stack.append((below, depth + 1, path + letter))
                    continue
                for end, number in below:
                    text = path + end
                    a = start[depth] if depth else 0
                    token = final.get(text[a:])
                    if token is None or a and not fits(last[a], token):
                        for a in range(depth, max(-1, depth - longest), -1):
                            token = final.get(text[a:])
                            if token is not None and (a == 0 or fits(last[a], token)):
                                break
                        else:
                            raise ValueError(f"no token ends {text!r}")
                    ids = [token]
                    while a > 0:
                        ids.append(last[a])
                        a = start[a]
                    ids.reverse()
                    out[number] = ids
        return out


@functools.cache
def vocabulary_of(name: str) -> Vocabulary:
    """The vocabulary file that the driver added for the executors, read once per worker."""
    with open(SparkFiles.get(name), encoding="utf-8") as f:
        return Vocabulary(f.read())


def encode_pieces(pieces: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, pa.Array]:
    """Number of each piece in the list of different pieces, and the ids of those."""
    codes, distinct = coded(pieces)
    words = [vocabulary.lettered(p) for p in distinct.to_pylist()]
    gc.disable()  # millions of small live dicts; the collector would walk them again and again
    try:
        encoded = Trie(words).encode(vocabulary, len(words))
    finally:
        gc.enable()
    return codes, pa.array(encoded, pa.list_(pa.int32()))


def encode_words(words: pa.Array, vocabulary: Vocabulary) -> pa.Array:
    """Token ids of each of the words, none of which holds a line break or a special token."""
    found = vocabulary.split.findall(vocabulary.normal("\n".join(words.to_pylist())))
    found = pa.array(found, pa.string())
    breaks = pc.equal(found, "\n").to_numpy(zero_copy_only=False)
    word = np.cumsum(breaks)[~breaks]
    codes, encoded = encode_pieces(found.filter(pa.array(~breaks)), vocabulary)
    lengths = pc.list_value_length(encoded).to_numpy(zero_copy_only=False)
    per_word = np.bincount(word, weights=lengths[codes], minlength=len(words)).astype(np.int64)
    flat = encoded.take(pa.array(codes)).flatten()
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(per_word)]), pa.int32()), flat)


def encode_marked(word: str, vocabulary: Vocabulary) -> list[int]:
    """Token ids of a word in which special tokens are written."""
    ids: list[int] = []
    for part in vocabulary.specials.split(word):
        if part in vocabulary.special:
            ids.append(vocabulary.special[part])
        elif part:
            ids += encode_words(pa.array([part]), vocabulary)[0].as_py()
    return ids


def encode_texts(texts: pa.Array, vocabulary: Vocabulary) -> pa.Array:
    """Token ids of each text, as a list array."""
    words, offsets = split(texts)
    if not len(words):
        return pa.array([[]] * len(texts), pa.list_(pa.int32()))
    codes, distinct = coded(words)
    marked = pc.match_substring_regex(distinct, vocabulary.specials.pattern)
    marked = marked.to_numpy(zero_copy_only=False)
    plain = encode_words(distinct.filter(pa.array(~marked)), vocabulary)
    per_word = plain
    if marked.any():
        rest = [encode_marked(w, vocabulary) for w in distinct.filter(pa.array(marked)).to_pylist()]
        per_word = pa.concat_arrays([plain, pa.array(rest, pa.list_(pa.int32()))])
        places = np.where(marked, len(plain) + np.cumsum(marked) - 1, np.cumsum(~marked) - 1)
        codes = places[codes]
    lengths = pc.list_value_length(per_word).to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(lengths[codes], dtype=np.int64)])
    return pa.ListArray.from_arrays(
        pa.array(upto[offsets], pa.int32()), per_word.take(pa.array(codes)).flatten())


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays(
        [*[batch.column(n) for n in names], values], names=[*names, name])


def with_field(df: DataFrame, name: str, kind) -> StructType:
    return StructType([*df.schema.fields, StructField(name, kind)])


def _ship(docs: DataFrame, path: str) -> str:
    """Give the vocabulary file (a driver-side path, as a parameter) to every executor."""
    docs.sparkSession.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode(docs: DataFrame, path: str, into: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text``."""
    name = _ship(docs, path)
    rest = docs.drop(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(name)
        for batch in batches:
            for part in chunks(batch, "text", TRIE_BYTES):
                yield _with_column(part, into, encode_texts(text_of(part), vocabulary))

    return rest.mapInArrow(run, with_field(rest, into, ArrayType(IntegerType())))


def decode_ids(lists: pa.Array, tokens: pa.Array) -> pa.Array:
    """The text of each list of ids: their strings, joined by spaces."""
    strings = pa.ListArray.from_arrays(lists.offsets, tokens.take(lists.values))
    return pc.fill_null(pc.binary_join(strings, " "), "")


def decode(docs: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` with the text of its token ids."""
    name = _ship(docs, path)
    rest = docs.drop(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(vocabulary_of(name).tokens)
        for batch in batches:
            yield _with_column(batch, into, decode_ids(batch.column(ids), tokens))

    return rest.mapInArrow(run, with_field(rest, into, StringType()))


def round_trip(docs: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded",
               ) -> DataFrame:
    """``docs`` with the token ids of ``text`` and the text of those ids, in one pass."""
    name = _ship(docs, path)
    rest = docs.drop(ids, decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(name)
        tokens = pa.array(vocabulary.tokens)
        for batch in batches:
            for part in chunks(batch, "text", TRIE_BYTES):
                found = encode_texts(text_of(part), vocabulary)
                part = _with_column(part, ids, found)
                yield _with_column(part, decoded, decode_ids(found, tokens))

    schema = with_field(rest, ids, ArrayType(IntegerType()))
    return rest.mapInArrow(run, StructType([*schema.fields, StructField(decoded, StringType())]))
