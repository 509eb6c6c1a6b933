"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a byte string one token alone can end its encoding: the one that is
compatible with the last token of the prefix before it. A table of these tokens holds the
encodings of all prefixes; appending extends it, and an edit rewrites it only until it agrees
with the old table again. Pieces of text are taken in order, so that each goes on from the prefix it
shares with the one before.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from annualis.llm.common import forget_half, pieces

CACHE = 400_000  # pieces remembered by a worker
CHARACTERS = 1 << 20  # of the texts that are cut together
COMMON = [chr(c) for c in range(0x250)]
BEYOND = re.compile("[^\\0-\u024f]").search
PAIRS = 400_000  # pairs of tokens remembered
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
IDS = "doc_id long, n_tokens long, ids binary"


class Vocabulary:
    """Tokens by rank, with the pair of tokens each one is merged from."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {r: b for b, r in ranks.items()}
        self.longest = max(map(len, ranks))
        self.size = [0] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.size[rank] = len(token)
        self.shorter = [-1] * len(self.size)  # the longest token among those that end a token
        self._grow()
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.fits: dict[int, bool] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            self._learn(token, rank)

    def _grow(self) -> None:
        """The automaton whose node after a prefix stands for its longest end that begins a token.

        ``at`` is the longest token that ends there, -1 for none.
        """
        self.edges: dict[int, int] = {}  # node * 256 + byte to node
        own, above, deep = {}, [(0, 0)], [0]
        for token, rank in self.ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                after = self.edges.get(key)
                if after is None:
                    after = self.edges[key] = len(above)
                    above.append((node, byte))
                    deep.append(deep[node] + 1)
                node = after
            own[node] = rank
        self.fall, self.at = [0] * len(above), [-1] * len(above)
        for node in sorted(range(1, len(above)), key=deep.__getitem__):
            parent, byte = above[node]
            if parent:
                self.fall[node] = self.step(self.fall[parent], byte)
            below = self.at[self.fall[node]]
            self.at[node] = own.get(node, below)
            if node in own:
                self.shorter[own[node]] = below

    def step(self, node: int, byte: int) -> int:
        edges, fall = self.edges, self.fall
        after = edges.get(node << 8 | byte)
        while after is None and node:
            node = fall[node]
            after = edges.get(node << 8 | byte)
        return after or 0

    def node_after(self, data: bytes) -> int:
        """The automaton's node after ``data``; only as many bytes as the longest token has matter."""
        node = 0
        for byte in data[-self.longest:]:
            node = self.step(node, byte)
        return node

    def _learn(self, token: bytes, rank: int) -> None:
        """Find the two tokens that lower ranks leave of ``token``; a single byte is its own half."""
        if len(token) > 1:
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None and left < rank and right < rank and self.compatible(left, right):
                    self.halves[rank] = (left, right)
                    self.merged[left, right] = rank
                    self.fits[left << 20 | right] = False
                    return
        self.halves[rank] = (rank, rank)

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side are the encoding of their bytes.

        They are unless some merge across the border comes before a merge that made one of them;
        the merges are undone from the last to the first.
        """
        key = left << 20 | right
        known = self.fits.get(key)
        if known is not None:
            return known
        a, b, bound = left, right, 1 << 62
        while True:
            if self.merged.get((a, b), bound) < bound:
                fits = False
                break
            # The later of the two merges is undone; on the left side it must come strictly before.
            undo_left = a > b
            if undo_left and self.halves[a][1] == a:
                undo_left = False
            if not undo_left and self.halves[b][0] == b:
                undo_left = True
                if self.halves[a][1] == a:
                    fits = True
                    break
            if undo_left:
                bound, a = a, self.halves[a][1]
            else:
                bound, b = b + 1, self.halves[b][0]
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        self.fits[key] = fits
        return fits

    def extend(self, data: bytes, last: list[int], nodes: list[int]) -> None:
        """Fill ``last`` and ``nodes`` for the prefixes they lack; ``last[i]`` is the token that ends prefix i, ``nodes[i]`` the node after it."""
        edges, fall, at, size, shorter, fits = self.edges, self.fall, self.at, self.size, self.shorter, self.fits
        end, node = len(last) - 1, nodes[-1]
        for byte in data[end:]:
            end += 1
            after = edges.get(node << 8 | byte)
            while after is None and node:
                node = fall[node]
                after = edges.get(node << 8 | byte)
            node = after or 0
            token = at[node]
            while token >= 0:
                place = end - size[token]
                if not place:
                    break
                fit = fits.get(last[place] << 20 | token)
                if fit or fit is None and self.compatible(last[place], token):
                    break
                token = shorter[token]
            if token < 0:
                raise ValueError("the vocabulary lacks a byte")
            last.append(token)
            nodes.append(node)

    def last_token(self, last: list[int], end: int, node: int) -> int:
        """The token that ends prefix ``end``, of those that end at ``node``."""
        token = self.at[node]
        while token >= 0:
            place = end - self.size[token]
            if not place or self.compatible(last[place], token):
                return token
            token = self.shorter[token]
        raise ValueError("the vocabulary lacks a byte")

    def encode(self, data: bytes) -> list[int]:
        return self.encode_sorted([data])[0]

    def encode_sorted(self, strings: list[bytes]) -> list[list[int]]:
        """Tokens of each string; those that are no tokens go on from the prefix they share with the one before."""
        out, last, nodes, before = [], [-1], [0], b""
        for data in strings:
            whole = self.ranks.get(data)
            if whole is not None:
                out.append([whole])
                continue
            same = 0
            for a, b in zip(before, data):
                if a != b:
                    break
                same += 1
            del last[same + 1:], nodes[same + 1:]
            self.extend(data, last, nodes)
            out.append(self.unwind(last))
            before = data
        return out

    def unwind(self, last: list[int]) -> list[int]:
        out, at = [], len(last) - 1
        while at:
            out.append(last[at])
            at -= self.size[last[at]]
        return out[::-1]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class PrefixTable:
    """One byte string with the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        nodes = [self.vocabulary.node_after(self.data)]
        self.data += more
        self.vocabulary.extend(self.data, self.last, nodes)

    def replace(self, begin: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of bytes ``begin`` to ``end``; how many prefixes were computed anew.

        A token depends on at most ``longest`` prefixes before it. Once so many in a row are as
        they were, all that follow are too.
        """
        old, moved = self.last, len(new) - (end - begin)
        self.data = self.data[:begin] + new + self.data[end:]
        last, same, v = old[:begin + 1], 0, self.vocabulary
        node = v.node_after(self.data[:begin])
        for at in range(begin + 1, len(self.data) + 1):
            node = v.step(node, self.data[at - 1])
            token = v.last_token(last, at, node)
            last.append(token)
            same = same + 1 if at > begin + len(new) and old[at - moved] == token else 0
            if same >= v.longest:
                last.extend(old[at - moved + 1:])
                self.last = last
                return at - begin
        self.last = last
        return len(self.data) - begin

    def ids(self) -> list[int]:
        return self.vocabulary.unwind(self.last)


@lru_cache(maxsize=2)
def load_vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


def common_cut(pattern: str):
    """What cuts a text of ``COMMON`` characters alone by ``pattern``, with Python's own module, which is faster; none if it can't be had."""
    kinds = {kind: re.escape("".join(filter(regex.compile(kind).match, COMMON))) for kind in (r"\p{L}", r"\p{N}", r"\s", r"\S")}
    escapes = r"\\p\{[LN]\}|\\[sS]"
    if re.search(r"\\[a-zA-Z]|\(\?[a-zA-Z]|\[\[|&&|\|\||--|~~", re.sub(escapes, "", pattern)):
        return None
    kind = lambda m: kinds[m[0]]
    plain = re.sub(rf"\[(?:\\.|[^\]\\])*\]|{escapes}", lambda m: re.sub(escapes, kind, m[0]) if m[0][0] == "[" else f"[{kind(m)}]", pattern)
    return re.compile(plain).findall


class TextEncoder:
    """Whole texts, cut by the tokenizer's pattern; the ids of pieces seen are kept in bounded memory."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.cut, self.known = vocabulary, regex.compile(pattern).findall, {}
        self.common = common_cut(pattern) or self.cut

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """``encode`` of each text; pieces not seen before are encoded in order, those of many texts at once."""
        known = self.known
        for a, b in pieces([len(t) for t in texts], CHARACTERS):
            parts = [self.cut(t) if BEYOND(t) else self.common(t) for t in texts[a:b]]
            distinct = set().union(*parts)
            new = distinct.difference(known)
            if len(known) + len(new) > CACHE:
                forget_half(known)
                new = distinct.difference(known)
            listed = sorted((p.encode("utf-8", "replace"), p) for p in new)
            found = self.vocabulary.encode_sorted([data for data, _ in listed])
            known.update((p, array("I", ids).tobytes()) for (_, p), ids in zip(listed, found))
            yield from [b"".join(map(known.__getitem__, part)) for part in parts]


@lru_cache(maxsize=2)
def text_encoder(path: str, pattern: str) -> TextEncoder:
    return TextEncoder(load_vocabulary(path), pattern)


def vocabulary_file(name: str) -> tuple[str, str]:
    """Path and pattern of a public vocabulary; looked up where it is used, so every machine finds its own."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def _texts(frame: pd.DataFrame) -> Iterator[str]:
    for text in frame["text"]:
        yield text if isinstance(text, str) else ""


def encode_documents(docs: DataFrame, name: str) -> DataFrame:
    """doc_id, n_tokens and the ids (binary, little-endian unsigned 32-bit) of every document.

    Null and empty texts have no ids; repeated rows and null ids are encoded like any other.
    """
    def run(frames):
        encoder = text_encoder(*vocabulary_file(name))
        for frame in filter(len, frames):
            ids = list(encoder.encode_all(list(_texts(frame))))
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "n_tokens": [len(x) // 4 for x in ids], "ids": ids})

    return docs.select("doc_id", "text").mapInPandas(run, IDS)


def decode_documents(encoded: DataFrame, name: str) -> DataFrame:
    """doc_id and the bytes (binary) that the ids of ``encoded`` stand for."""
    def run(frames):
        vocabulary = load_vocabulary(vocabulary_file(name)[0])
        for frame in filter(len, frames):
            data = [vocabulary.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in frame["ids"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "data": data})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, name: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 (and ids): every text encoded and its ids decoded.

    Both steps run on a batch of rows in one task; null and empty texts have no ids, repeated rows
    and null ids are treated like any other. Only doc_id and text are read.
    """
    def run(frames):
        encoder = text_encoder(*vocabulary_file(name))
        vocabulary = encoder.vocabulary
        for frame in filter(len, frames):
            rows = []
            for ids in encoder.encode_all(list(_texts(frame))):
                decoded = vocabulary.decode(np.frombuffer(ids, "<u4").tolist())
                row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest())
                rows.append((*row, ids) if with_ids else row)
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 3 + with_ids])
            out.insert(0, "doc_id", frame["doc_id"].astype("Int64").to_numpy())
            yield out

    return docs.select("doc_id", "text").mapInPandas(run, DIGEST + ", ids binary" * with_ids)
