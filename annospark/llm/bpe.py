"""Byte-level BPE encoding and decoding of whole texts.

The distinct pre-tokens of a slice of text form a trie. It is walked depth first (in sorted order, so only the path from the root to
the current word is held), and every node keeps one state: the last token of the encoding of its prefix (with the tokens that
may go on from there). A state follows from
those of shorter prefixes, hence a prefix shared by many words is encoded once. A word's encoding is read off by stepping
back from its last state.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import struct
from collections.abc import Iterator
from itertools import compress
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from .text import coded, flat, pieces

#: Fixed value: the pre-token pattern of byte-level BPE.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Strings whose encodings a Python worker keeps before it starts anew; bytes of text encoded at once.
CACHE_STRINGS, SLICE = 300_000, 3 << 20

# white space, control characters that count as white space for some, letters, and other visible characters, all ASCII
_WHITE, _DOUBT, _LETTER, _OTHER = (np.zeros(256, bool) for _ in range(4))
_WHITE[[*range(9, 14), 32]] = True
_DOUBT[28:32] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_OTHER[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def pre_token_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where a pre-token ends and another begins, whatever the text before and after.

    No pre-token holds a character before white space, so every run of white space begins one. None holds a letter before
    another visible character. Of white space only a plain space goes with what follows, so a single other one ends a pre-token.
    """
    white = _WHITE[data]
    wide = white | _DOUBT[data]  # and the bytes of white space outside ASCII: U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000
    if (data > 127).any():
        one, two = data[1:], data[2:]
        pair = (data[:-1] == 0xC2) & ((one == 0x85) | (one == 0xA0))
        x, y = data[:-2], one[:-1]
        three = ((x == 0xE2) & (y == 0x80) & ((two <= 0x8A) | (two == 0xA8) | (two == 0xA9) | (two == 0xAF))) | ((x == 0xE1) & (y == 0x9A) & (two == 0x80)) | ((x == 0xE2) & (y == 0x81) & (two == 0x9F)) | ((x == 0xE3) & (y == 0x80) & (two == 0x80))
        for k in range(2):
            wide[k : len(wide) - 1 + k] |= pair
        for k in range(3):
            wide[k : len(wide) - 2 + k] |= three
    cut = np.zeros(len(data), bool)
    cut[1:] = (white[1:] & ~wide[:-1]) | (_LETTER[data[:-1]] & _OTHER[data[1:]])
    if len(data) > 2:
        lone = white[1:-1] & (data[1:-1] != 32) & ~wide[:-2] & ~wide[2:]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        lone &= ~edge[1:-2] & ~edge[2:-1]  # with a neighbour on either side in the same row
        cut[2:] |= lone
    return cut


def _byte_letters() -> dict[str, int]:
    """The letter by which the vocabulary file writes each byte: printable ones stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class CachedBPE:
    """Byte-level BPE for the contents of a ``tokenizer.json``, by strings that don't influence each other.

    Texts are cut where pre-tokens are sure to end, equal strings are found by a dictionary over the whole slice, and each
    string is encoded once and kept; ids are then gathered for all of them together. Strings not seen for some time are forgotten: the cache
    has two generations, and what is found in the older one moves to the younger.
    """

    def __init__(self, contents: bytes) -> None:
        spec = json.loads(contents)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.whole = any(pre_token_cuts(np.frombuffer(x.encode(), np.uint8), np.array([0, len(x.encode())])).any() for x in self.special)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode_strings(self, strings: list[str]) -> list[bytes]:
        """Ids of each string as little-endian 32-bit integers."""
        raise NotImplementedError

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where texts are cut; those of rows with a special token that would be parted are kept whole."""
        cut = pre_token_cuts(data, offsets)
        if self.whole:
            body = data.tobytes()
            for x in map(str.encode, self.special):
                at = body.find(x)
                while at >= 0:
                    cut[at + 1 : at + len(x)] = False
                    cut[at] = True
                    at = body.find(x, at + 1)
        return cut

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all rows, and the n + 1 offsets of the rows into them. The strings of special tokens count as those tokens."""
        codes, strings, rows = coded(data, offsets, self.cuts(data, offsets))
        if len(self.young) > CACHE_STRINGS // 2:
            self.old, self.young = self.young, {}
        missed = [x for x in strings if x not in self.young]
        if missed:
            fresh = [x for x in missed if x not in self.old]
            self.young.update((x, self.old[x]) for x in missed if x in self.old)
            self.young.update(zip(fresh, self.encode_strings(fresh)))
        found = list(map(self.young.__getitem__, strings))
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin = np.cumsum(size) - size
        each = size[codes]
        upto = np.concatenate([[0], np.cumsum(each)])
        place = np.repeat(begin[codes] - upto[:-1], each)
        place += np.arange(len(place))
        return np.frombuffer(b"".join(found), "<u4")[place], upto[rows]


class TrieBPE(CachedBPE):
    """Encoder by a walk over the trie of distinct pre-tokens, and decoder."""

    def __init__(self, contents: bytes) -> None:
        super().__init__(contents)
        spec = json.loads(contents)
        letters = _byte_letters()
        vocabulary = spec["model"]["vocab"]
        special = {x["id"]: x["content"].encode() for x in spec["added_tokens"]}
        ids = {bytes(letters[c] for c in piece): i for piece, i in vocabulary.items() if i not in special and all(c in letters for c in piece)}
        self.pieces = [b""] * (1 + max(*ids.values(), *special))
        for i, piece in [*((i, piece) for piece, i in ids.items()), *special.items()]:
            self.pieces[i] = piece
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.merges = {(vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(merges)}
        self.made_of = {i: ((i, i), -1) for i in ids.values()} | {new: (pair, rank) for pair, (rank, new) in self.merges.items()}
        self.tokens: list = [None, {}]  # the tokens by their bytes: a token's id (if these bytes are one), and what may follow
        for piece, i in ids.items():
            node = self.tokens
            for byte in piece:
                node = node[1].setdefault(byte, [None, {}])
            node[0] = i
        self.find = regex.compile(PRE_TOKEN).findall
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.encoded: dict[str, bytes] = {}  # by pre-token, of one call
        self.adjacent: dict[int, bool] = {}

    def stands(self, a: int, b: int) -> bool:
        """Whether token ``b`` can follow ``a`` in an encoding.

        It can unless two parts on either side of the border would have been merged before one of them was used up on its
        own side. Going back in time, the side made last is undone first; of merges of one rank the left one comes first.
        """
        key, used, none = a << 20 | b, len(self.merges), (len(self.merges), -1)
        while True:
            if self.merges.get((a, b), none)[0] < used:
                self.adjacent[key] = False
                return False
            (before, made_a), (after, made_b) = self.made_of[a], self.made_of[b]
            if made_a < 0 and made_b < 0:
                self.adjacent[key] = True
                return True
            if made_a > made_b:
                a, used = before[1], made_a
            else:
                b, used = after[0], made_b + 1

    def walk(self, fresh: set[str]) -> None:
        """Encodes distinct pre-tokens in one depth-first walk over their trie."""
        if len(self.adjacent) > CACHE_STRINGS:
            self.adjacent.clear()
        known, stands, first = self.adjacent.get, self.stands, self.tokens[1]
        # of each prefix of the path: its last token, where that starts, and the tokens that may go on from it
        path, last, begin, open_tokens = b"", [], [], [[]]
        for word, text in sorted((t.encode(), t) for t in fresh):
            same = 0
            for x, y in zip(path, word):
                if x != y:
                    break
                same += 1
            del last[same:], begin[same:], open_tokens[same + 1 :]
            going = open_tokens[-1]
            for at in range(same, len(word)):
                byte = word[at]
                going = [(start, longer) for start, node in going if (longer := node[1].get(byte))]
                going.append((at, first[byte]))
                for start, node in going:
                    if (token := node[0]) is not None:
                        if not start:
                            break
                        fits = known(last[start - 1] << 20 | token)
                        if stands(last[start - 1], token) if fits is None else fits:
                            break
                last.append(token)
                begin.append(start)
                open_tokens.append(going)
            path, ids, end = word, [], len(word)
            while end:
                ids.append(last[end - 1])
                end = begin[end - 1]
            ids.reverse()
            self.encoded[text] = struct.pack(f"<{len(ids)}I", *ids)

    def parts(self, string: str) -> list[str]:
        """Pre-tokens and special tokens."""
        if self.split and any(x in string for x in self.special):
            return [p for i, x in enumerate(self.split(string)) for p in ([x] if i % 2 else self.find(x))]
        return self.find(string)

    def encode_strings(self, strings: list[str]) -> list[bytes]:
        found = [self.parts(x) for x in strings]
        self.encoded = {x: np.uint32(i).tobytes() for x, i in self.special.items()}
        self.walk({p for ps in found for p in ps}.difference(self.encoded))
        known = self.encoded.__getitem__
        return [known(ps[0]) if len(ps) == 1 else b"".join(map(known, ps)) for ps in found]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")


class LibraryBPE(CachedBPE):
    """Encoder that leaves the strings to the tokenizers library."""

    def __init__(self, contents: bytes) -> None:
        super().__init__(contents)
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.library = Tokenizer.from_buffer(contents)
        self.library.no_padding()
        self.library.no_truncation()

        self.spaced = regex.compile(r" \S+").fullmatch
        letters, special = _byte_letters(), set(self.special.values())
        vocabulary = json.loads(contents)["model"]["vocab"]
        self.length = np.zeros(1 + max(*vocabulary.values(), *special), np.int64)  # of tokens in bytes
        for piece, i in vocabulary.items():
            self.length[i] = len(piece) if i not in special and all(c in letters for c in piece) else 0

    def encode_strings(self, strings: list[str]) -> list[bytes]:
        """Strings that begin with one space and have no other white space are encoded as one text, in which they are as
        apart as by themselves, and parted again by the lengths of their tokens; so the library is called once for very many."""
        spaced = [self.spaced(x) is not None for x in strings]
        text = "".join(compress(strings, spaced))
        if any(x in text for x in self.special):
            spaced, text = [False] * len(strings), ""
        alone = self.library.encode_batch_fast([x for x, s in zip(strings, spaced) if not s], add_special_tokens=False)
        parted, alone = iter(self._parted(text)), (struct.pack(f"<{len(x.ids)}I", *x.ids) for x in alone)
        return [next(parted) if s else next(alone) for s in spaced]

    def _parted(self, text: str) -> list[bytes]:
        """Ids of each of the strings in the text; every space begins one."""
        if not text:
            return []
        ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        body = np.frombuffer(text.encode(), np.uint8)
        ends = np.append(np.flatnonzero(body == 32)[1:], len(body))
        cuts = np.searchsorted(np.cumsum(self.length[ids]), ends) + 1
        data, cuts = ids.tobytes(), (4 * cuts).tolist()
        return [data[a:b] for a, b in zip([0, *cuts], cuts)]


_loaded: dict[tuple[type, bytes], CachedBPE] = {}


def tokenizer(contents: bytes, kind: type[CachedBPE] = TrieBPE) -> CachedBPE:
    """The worker's encoder for these file contents; it stays with its cache from task to task."""
    key = kind, hashlib.sha256(contents).digest()
    if key not in _loaded:
        _loaded[key] = kind(contents)
        gc.freeze()  # the vocabulary stays, so collections needn't visit it
    return _loaded[key]


def vocabulary(spark: SparkSession, path: str):
    """The file's contents (of fixed size, some MB) as a broadcast, so that executors need no copy of it."""
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def encode_documents(docs: DataFrame, vocabulary_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` (array of int) and ``decoded`` (the text decoded from them again).

    No shuffle. A null or empty text gives an empty array and an empty string. Every row stays as it is, repeated ones and
    those with null ids too; columns of ``docs`` named like the new ones are replaced.
    """
    held = vocabulary(docs.sparkSession, vocabulary_path)
    kept = docs.drop("token_ids", "decoded")
    schema = kept.limit(0).selectExpr("*", "cast(null as array<int>) token_ids", "cast(null as string) decoded").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(held.value)
        for batch in pieces(batches, text, SLICE):
            ids, at = bpe.encode(*flat(batch.column(text)))
            decoded = [bpe.decode(ids[a:b]) for a, b in zip(at.tolist(), at[1:].tolist())]
            tokens = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, tokens, pa.array(decoded, pa.string())], names=[*batch.schema.names, "token_ids", "decoded"])

    return kept.mapInArrow(run, schema)


def digest_tokens(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``n_tokens``, and SHA-256 of the ids (little-endian, unsigned, 32 bits) and of the decoded text.

    The same encoder as :func:`encode_documents`, digested where it runs so that ids never leave the worker.
    """
    held = vocabulary(docs.sparkSession, vocabulary_path)
    kept = docs.select(key, text)
    schema = kept.limit(0).selectExpr(f"`{key}`", "0L n_tokens", "'' ids_sha256", "'' decoded_sha256").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(held.value)
        for batch in pieces(batches, text, SLICE):
            ids, at = bpe.encode(*flat(batch.column(1)))
            each = [ids[a:b] for a, b in zip(at.tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(at).astype(np.int64)),
                    pa.array([hashlib.sha256(x).hexdigest() for x in each], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in each], pa.string()),
                ],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return kept.mapInArrow(run, schema)
