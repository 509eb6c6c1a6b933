"""Alignment of two tokenizers' tokens, and in how many documents each pair of token ids is linked.

Tokens of both tokenizers that share bytes of a text are linked; byte offsets where tokens of both end part a text into
groups. The first pass tokenizes, aligns and stores each batch's tokens with its distinct pairs. The distinct pairs of the
corpus get a minimal perfect hash: they are dealt to buckets, and in each a key takes the first level on
which no other key shares its place. Batches add their pairs up in dense vectors indexed by the hash, which are summed
as a tree; a stored key is compared at each look-up. The second pass aligns the stored tokens again and looks their pairs up.

Tables are held for ``CHUNK`` keys at a time; with more pairs than that both passes over the stored tokens are repeated for each chunk.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.llm.common import array_row, pieces, sum_arrays, tidy
from annualis.session import stored, stored_with

BYTES = 2 << 20  # of text in a batch
CACHE = 400_000  # stretches of text that a worker remembers
TOGETHER = 256  # new stretches that are tokenized as one text
BUCKET_KEYS = 1 << 15
CHUNK = 1 << 21  # pairs whose hash and counts a task holds at a time
LEVELS, ROOM = 64, 1.5  # places on a level for each key that is left
FLUSH = 1 << 20
MARK = "\u2581"  # what the piece tokenizer writes for a space
STIR = np.uint64(0x9E3779B97F4A7C15)
LATER = "\u0250"  # characters before it have the same classes in all versions of Unicode, so all libraries part them alike

#: Texts with white space that isn't space, tab, line feed, vertical tab or form feed are cut only at single spaces.
ODD_WHITE = "".join(map(chr, [0x0D, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
ODD = re.compile(f"[{ODD_WHITE}]")
COARSE = re.compile(r"(?s:.+?)(?:\Z|(?<=\S)(?= \S))")
#: Letters; signs and digits; a line break before a word; what else stands without white space; other white space with what follows.
STRETCH = re.compile(r" ?[A-Za-z]++(?![^\x00-\x7f])| ?[!-&(-@\[-`{-~]++(?=[A-Za-z\t\n\x0b\x0c ]|\Z)"
                     r"|[\t\n](?= ?[^\t-\r ])| ?[^\t-\r ]++|[\t-\r ]++[^\t-\r ]*+")
#: Two characters of a piece between which ``STRETCH`` may cut.
CUT = re.compile(rf"[A-Za-z][\x00-@\[-`{{-\x7f]|[!-&(-@\[-`{{-~][A-Za-z]|[^\s{MARK}][\t\n\x0b\x0c {MARK}]|[\t\n][\s\S]")


def stretches(text: str) -> list[str]:
    """Parts of a text at whose borders tokens of both tokenizers end whatever stands on the other side."""
    return (COARSE if ODD.search(text) else STRETCH).findall(text)


class TwoTokenizers:
    """Ids of stretches of text by a byte-level and by a piece tokenizer, each stretch tokenized once and remembered."""

    def __init__(self, byte_file: str, ranks_file: str, piece_file: str):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.by_bytes = Tokenizer.from_file(byte_file)
        self.by_bytes.encode_special_tokens = True
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.by_ranks = tiktoken.Encoding("pairs", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.by_pieces = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        size = self.by_bytes.get_vocab_size()
        self.byte_tokens: list[bytes] = [b""] * size
        for token, n in ranks.items():
            self.byte_tokens[n] = token
        self.piece_tokens = [self._piece(n) for n in range(self.by_pieces.get_piece_size())]
        self.byte_sizes = np.array([len(t) for t in self.byte_tokens], np.int64)
        self.piece_sizes = np.array([len(t) for t in self.piece_tokens], np.int64)
        self.known: dict[str, tuple[bytes, bytes] | None] = {}

    def _piece(self, n: int) -> bytes:
        piece, kind = self.by_pieces.id_to_piece(n), self.by_pieces
        if kind.is_byte(n):
            return bytes([int(piece[3:5], 16)])
        if not (kind.is_control(n) or kind.is_unknown(n)) and CUT.search(piece):
            raise ValueError(f"the piece {piece!r} goes over a border of stretches")
        return piece.replace(MARK, " ").encode()

    def _byte_ids(self, texts: list[str]) -> list[list[int]]:
        plain = [max(t, default="") < LATER for t in texts]
        found = iter(self.by_bytes.encode_batch_fast([t for t, p in zip(texts, plain) if not p], add_special_tokens=False))
        return [self.by_ranks.encode_ordinary(t) if p else next(found).ids for t, p in zip(texts, plain)]

    def _alone(self, word: str) -> tuple[bytes, bytes] | None:
        a = np.array(self._byte_ids([word])[0], "<u4")
        lead = self.by_pieces.encode("\n")
        b = np.array(self.by_pieces.encode("\n" + word)[len(lead):], "<u4")
        whole = word.encode()
        same = b"".join(self.byte_tokens[i] for i in a) == whole == b"".join(self.piece_tokens[i] for i in b)
        return (a.tobytes(), b.tobytes()) if same else None

    @staticmethod
    def _split(ids: list[int], sizes: np.ndarray, ends: np.ndarray, lead: int) -> list[bytes] | None:
        """Ids of each of the stretches that were joined by line feeds; null if a token goes over a border."""
        found = np.array(ids, "<u4")
        upto = np.cumsum(sizes[found]) - lead
        to = np.searchsorted(upto, ends)
        if not len(upto) or upto[-1] != ends[-1] or (upto[to] != ends).any():
            return None
        begin = np.concatenate([np.searchsorted(upto, 0, "right")[None] if lead else [0], to[:-1] + 2])
        if len(ends) > 1 and (upto[to[:-1] + 1] != ends[:-1] + 1).any():
            return None
        data = found.tobytes()
        return [data[4 * x:4 * y] for x, y in zip(begin.tolist(), (to + 1).tolist())]

    def learn(self, new: list[str]) -> None:
        known = self.known
        joint = []
        for word in new:
            if MARK in word:
                known[word] = None
            elif word.strip(" \t\n\r\x0b\x0c") == word.removeprefix(" ") and not ODD.search(word):
                joint.append(word)
            else:
                known[word] = self._alone(word)
        joint.sort(key=lambda w: max(w) >= LATER)
        groups = [joint[k:k + TOGETHER] for k in range(0, len(joint), TOGETHER)]
        texts = ["\n".join(g) for g in groups]
        lead = int(self.piece_sizes[self.by_pieces.encode("\n")].sum())  # bytes, with the space that is added
        for group, a, b in zip(groups, self._byte_ids(texts), self.by_pieces.encode(["\n" + t for t in texts], num_threads=1)):
            ends = np.cumsum([len(w.encode()) + 1 for w in group]) - 1
            firsts = self._split(a, self.byte_sizes, ends, 0)
            seconds = self._split(b, self.piece_sizes, ends, lead)
            if firsts and seconds:
                known.update(zip(group, zip(firsts, seconds)))
            else:
                known.update((w, self._alone(w)) for w in group)

    def ids_of(self, words) -> list[tuple[bytes, bytes] | None]:
        """Ids of stretches by both, as little-endian unsigned 32-bit integers; null where a tokenizer's bytes are not the stretch's."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > CACHE:
            self.known, new = {}, list(words)
        self.learn(new)
        return [self.known[w] for w in words]


@lru_cache(maxsize=1)
def tokenizers_of(byte_name: str, piece_name: str) -> TwoTokenizers:
    import public_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    place = public_tokenizers.path
    return TwoTokenizers(place(f"{byte_name}.json"), place(f"{byte_name}.tiktoken"), place(f"{piece_name}.model"))


class Codes(dict):
    """Numbers of stretches in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _squeeze(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).tobytes())


def _expand(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


class Aligned:
    """Links and groups of a batch's distinct stretches, side by side as one text of bytes.

    ``first`` and ``second`` are the ids of all stretches in turn, with how many of them each stretch has.
    """

    def __init__(self, first: np.ndarray, n_first: np.ndarray, second: np.ndarray, n_second: np.ndarray, tokenizers: TwoTokenizers):
        self.first, self.second, self.n_first, self.n_second = first, second, n_first, n_second
        self.first_ends = np.cumsum(tokenizers.byte_sizes[first])
        self.second_ends = np.cumsum(tokenizers.piece_sizes[second])
        starts = self.first_ends - tokenizers.byte_sizes[first]
        low = np.searchsorted(self.second_ends, starts, "right")
        times = np.searchsorted(self.second_ends, self.first_ends, "left") - low + 1
        upto = np.cumsum(times)
        left = np.repeat(np.arange(len(first)), times)
        right = np.arange(len(left)) - np.repeat(upto - times, times) + np.repeat(low, times)
        self.pairs = first[left].astype(np.int64) << 32 | second[right].astype(np.int64)
        until = np.concatenate([[0], upto])
        last = np.cumsum(n_first)
        self.link_ends = until[last]
        self.n_links = self.link_ends - until[last - n_first]

    def group_ends(self) -> np.ndarray:
        """The offsets at which tokens of both end."""
        return np.intersect1d(self.first_ends, self.second_ends, assume_unique=True)

    def groups(self) -> tuple[np.ndarray, list[bytes]]:
        """How many groups each stretch has, and their ids as text."""
        shared = self.group_ends()
        cuts = np.searchsorted(self.first_ends, shared, "right"), np.searchsorted(self.second_ends, shared, "right")
        a, b = list(map(str, self.first.tolist())), list(map(str, self.second.tolist()))
        texts, i, j = [], 0, 0
        for x, y in zip(cuts[0].tolist(), cuts[1].tolist()):
            texts.append((a[i] if x == i + 1 else ",".join(a[i:x])) + "|" + (b[j] if y == j + 1 else ",".join(b[j:y])))
            i, j = x, y
        last = np.searchsorted(cuts[0], np.cumsum(self.n_first), "right")
        n = np.diff(last, prepend=0)
        return n, [";".join(texts[y - x:y]).encode() for x, y in zip(n.tolist(), last.tolist())]


BATCHES = ("batch long, doc_ids binary, nulls binary, sizes binary, codes binary, first binary, n_first binary, second binary, n_second binary, "
           "pairs binary, counts binary")


def _codes_of(texts: list) -> tuple[Codes, np.ndarray, np.ndarray]:
    codes, flat, sizes = Codes(), [], np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        if isinstance(text, str) and text:
            own = stretches(" " + text)
            sizes[k] = len(own)
            flat.extend(map(codes.__getitem__, own))
    return codes, np.array(flat, np.int64), sizes


def _pairs_by_document(aligned: Aligned, codes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, upwards, and in how many of the documents each is linked."""
    pairs, number = np.unique(aligned.pairs, return_inverse=True)
    if not len(pairs):
        return pairs, np.zeros(0, np.int64)
    here = np.unique(docs * len(aligned.n_links) + codes)
    docs, codes = np.divmod(here, len(aligned.n_links))
    times = aligned.n_links[codes]
    upto = np.cumsum(times)
    at = np.arange(int(times.sum())) - np.repeat(upto - times, times) + np.repeat(aligned.link_ends[codes] - times, times)
    key = np.unique(np.repeat(docs, times) * len(pairs) + number[at])
    return pairs, np.bincount(key % len(pairs), minlength=len(pairs))


def _tokenize(byte_name: str, piece_name: str):
    """Documents to batches of tokens with their distinct pairs."""
    def run(frames):
        tokenizers, place, k = tokenizers_of(byte_name, piece_name), TaskContext.get().partitionId(), 0
        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in pieces([len(t) if isinstance(t, str) else 0 for t in texts], BYTES):
                codes, flat, sizes = _codes_of(texts[a:b])
                ids = tokenizers.ids_of(codes)
                sound = np.array([i is not None for i in ids], bool)
                docs = np.repeat(np.arange(b - a), sizes)
                broken = np.unique(docs[~sound[flat]]) if len(flat) else docs
                kept = ~np.isin(docs, broken)
                docs, flat = docs[kept], flat[kept]
                sizes[broken] = 0
                ids = [i or (b"", b"") for i in ids]
                first, second = (np.frombuffer(b"".join(i[n] for i in ids), "<u4") for n in (0, 1))
                counts = [np.array([len(i[n]) // 4 for i in ids], np.int64) for n in (0, 1)]
                pairs, seen = _pairs_by_document(Aligned(first, counts[0], second, counts[1], tokenizers), flat, docs)
                own = frame["doc_id"].iloc[a:b].astype("Int64")
                yield pd.DataFrame([((place << 33) + k, own.fillna(0).to_numpy(np.int64).tobytes(), own.isna().to_numpy().tobytes(), sizes.astype(np.uint32).tobytes(),
                                     _squeeze(flat.astype(np.uint32)), _squeeze(first), _squeeze(counts[0].astype(np.uint32)),
                                     _squeeze(second), _squeeze(counts[1].astype(np.uint32)), _squeeze(np.diff(pairs, prepend=0)), _squeeze(seen.astype(np.uint32)))],
                                   columns=[c.split()[0] for c in BATCHES.split(", ")])
                k += 1

    return run


def tokenized(docs: DataFrame, byte_name: str, piece_name: str) -> DataFrame:
    """The first pass: a stored table of batches (see ``BATCHES``), with each batch's distinct pairs and in how many of its documents they are."""
    return stored(docs.select("doc_id", "text").mapInPandas(tidy(_tokenize(byte_name, piece_name)), BATCHES), "tokens")


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    out = (keys.astype(np.uint64) + np.uint64(seed * int(STIR) & (1 << 64) - 1)) * STIR
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out * STIR >> np.uint64(16)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (_mixed(keys, LEVELS) % np.uint64(buckets)).astype(np.int64)


def minimal_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the levels, the slot at each place of all levels (-1: none), and the key of each slot.

    A key that shares its place on a level goes on to the next; slots are numbered in the order of places, so
    n distinct keys have the slots from 0 to n - 1.
    """
    left, sizes, taken, names = keys, [], [], []
    while len(left):
        if len(sizes) == LEVELS:
            raise RuntimeError("a minimal hash found no place for some keys")
        size = max(1, int(ROOM * len(left)))
        place = (_mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        own = np.full(size, -1, np.int64)
        mine = alone[place]
        own[place[mine]] = left[mine]
        sizes.append(size)
        taken.append(alone)
        names.append(own[alone])
        left = left[~mine]
    if not sizes:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), keys
    alone = np.concatenate(taken)
    return np.array(sizes), np.where(alone, np.cumsum(alone) - 1, -1).astype(np.int32), np.concatenate(names)


class PairTable:
    """The minimal hashes of some consecutive buckets, and what is known of each slot."""

    def __init__(self, rows, buckets: int):
        rows = sorted(rows, key=lambda r: r["bucket"])
        self.buckets = buckets
        self.low, self.high = (rows[0]["bucket"], rows[-1]["bucket"] + 1) if rows else (0, 0)
        sizes = {r["bucket"]: _expand(r["sizes"], np.int64) for r in rows}
        self.sizes = np.zeros((max([len(s) for s in sizes.values()], default=0), self.high - self.low), np.int64)
        for k, own in sizes.items():
            self.sizes[: len(own), k - self.low] = own
        n = np.array([r["n"] for r in rows], np.int64)
        self.keys = np.concatenate([_expand(r["keys"], np.int64) for r in rows]) if rows else np.zeros(0, np.int64)
        slots, before = [], np.cumsum(n) - n
        for r, more in zip(rows, before):
            own = _expand(r["slots"], np.int32)
            slots.append(np.where(own >= 0, own + more, -1).astype(np.int32))
        self.slots = np.concatenate(slots) if rows else np.zeros(0, np.int32)
        base = np.concatenate([[0], np.cumsum(self.sizes.sum(axis=0))])[:-1]
        self.base = np.cumsum(self.sizes, axis=0) - self.sizes + base

    def find(self, pairs: np.ndarray) -> np.ndarray:
        """The slot of each pair, -1 for those of other buckets and those that have none."""
        out = np.full(len(pairs), -1, np.int64)
        bucket = bucket_of(pairs, self.buckets)
        live = np.flatnonzero((bucket >= self.low) & (bucket < self.high))
        bucket = bucket - self.low
        for level in range(len(self.sizes)):
            live = live[self.sizes[level][bucket[live]] > 0]
            if not len(live):
                break
            size = self.sizes[level][bucket[live]]
            place = (_mixed(pairs[live], level) % size.astype(np.uint64)).astype(np.int64) + self.base[level][bucket[live]]
            out[live] = self.slots[place]
            live = live[out[live] < 0]
        there = out >= 0
        out[there] = np.where(self.keys[out[there]] == pairs[there], out[there], -1)
        return out


def _distinct_pairs(frames):
    waiting, size = [], 0
    for frame in frames:
        for data in frame["pairs"]:
            waiting.append(np.cumsum(_expand(data, np.int64)))
            size += len(waiting[-1])
            if size > FLUSH:
                waiting = [np.unique(np.concatenate(waiting))]
                size = len(waiting[0])
            if size > FLUSH // 2 and len(waiting) == 1:
                yield pd.DataFrame({"pair": waiting[0]})
                waiting, size = [], 0
    if waiting:
        yield pd.DataFrame({"pair": np.unique(np.concatenate(waiting))})


def _dealt(buckets: int):
    def run(frames):
        for frame in frames:
            yield pd.DataFrame({"bucket": bucket_of(frame["pair"].to_numpy(np.int64), buckets), "pair": frame["pair"]})

    return run


HASHES = "bucket long, n long, sizes binary, slots binary, keys binary"


def _hashed(frame: pd.DataFrame) -> pd.DataFrame:
    sizes, slots, keys = minimal_hash(np.sort(frame["pair"].to_numpy(np.int64)))
    return pd.DataFrame([(int(frame["bucket"].iloc[0]), len(keys), _squeeze(sizes), _squeeze(slots), _squeeze(keys))], columns=["bucket", "n", "sizes", "slots", "keys"])


def _added(table: PairTable):
    """Batches to one dense vector of their pairs' document counts."""
    def run(frames):
        total, some = np.zeros(len(table.keys)), False
        for frame in frames:
            for pairs, counts in zip(frame["pairs"], frame["counts"]):
                at = table.find(np.cumsum(_expand(pairs, np.int64)))
                here = at >= 0
                total[at[here]] += _expand(counts, np.uint32)[here]  # a batch has each pair once
                some = True
        if some:
            yield array_row(total)

    return run


class PairCounts:
    """Counts of the corpus's pairs: chunks of buckets with their dense vectors, and the highest count of each first id."""

    def __init__(self, batches: DataFrame):
        self.batches = batches
        pairs, seen = stored_with(batches.select("pairs").mapInPandas(tidy(_distinct_pairs), "pair long").distinct(), "pairs", n=F.count(F.lit(1)))
        self.buckets = max(1, -(-int(seen["n"] or 0) // BUCKET_KEYS))
        self.hashes = stored(pairs.mapInPandas(_dealt(self.buckets), "bucket long, pair long").groupBy("bucket").applyInPandas(tidy(_hashed), HASHES), "hashes")
        spans = max(1, CHUNK // BUCKET_KEYS)
        self.chunks = [(low, min(low + spans, self.buckets)) for low in range(0, self.buckets, spans)]
        self.best = np.zeros(0, np.int64)
        self.counts: list[DataFrame] = []
        for chunk in self.chunks:
            table = self.table(chunk)
            total = sum_arrays(batches.select("pairs", "counts").mapInPandas(tidy(_added(table)), "part int, data binary"))
            counts = np.zeros(len(table.keys), np.int64) if total is None else total.astype(np.int64)
            if len(counts):
                first = table.keys >> 32
                self.best = np.concatenate([self.best, np.zeros(max(0, int(first.max()) + 1 - len(self.best)), np.int64)])
                np.maximum.at(self.best, first, counts)
            self.counts.append(stored(batches.sparkSession.createDataFrame([(bytearray(_squeeze(counts)),)], "data binary"), "counts"))

    def table(self, chunk: tuple[int, int]) -> PairTable:
        return PairTable(self.hashes.filter(F.col("bucket").between(chunk[0], chunk[1] - 1)).collect(), self.buckets)

    def counted(self, k: int) -> tuple[PairTable, np.ndarray]:
        return self.table(self.chunks[k]), _expand(self.counts[k].first()["data"], np.int64)

    def rows(self) -> DataFrame:
        """a_id, b_id, n_docs of every pair."""
        out = None
        for k, chunk in enumerate(self.chunks):
            own = self.hashes.filter(F.col("bucket").between(chunk[0], chunk[1] - 1)).mapInPandas(_listed(*self.counted(k)), "a_id long, b_id long, n_docs long")
            out = own if out is None else out.unionAll(own)
        return out


def _listed(table: PairTable, counts: np.ndarray):
    def run(frames):
        for frame in frames:
            for data in frame["keys"]:
                keys = _expand(data, np.int64)
                yield pd.DataFrame({"a_id": keys >> 32, "b_id": keys & 0xFFFFFFFF, "n_docs": counts[table.find(keys)]})

    return run


FACTS = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"
NAMES = [c.split()[0] for c in FACTS.split(", ")]


def _looked_up(table: PairTable, counts: np.ndarray, best: np.ndarray, byte_name: str, piece_name: str, facts: bool, with_groups: bool):
    """Batches to their documents' links in a chunk, with all other facts of the documents if ``facts``."""
    def run(frames):
        tokenizers = tokenizers_of(byte_name, piece_name)
        for frame in frames:
            for r in frame.itertuples(index=False):
                sizes = np.frombuffer(r.sizes, np.uint32).astype(np.int64)
                codes = _expand(r.codes, np.uint32).astype(np.int64)
                n_first, n_second = (_expand(d, np.uint32).astype(np.int64) for d in (r.n_first, r.n_second))
                aligned = Aligned(_expand(r.first, "<u4"), n_first, _expand(r.second, "<u4"), n_second, tokenizers)
                at = table.find(aligned.pairs)
                n = np.where(at >= 0, counts[at], 0) if len(counts) else np.zeros(len(at), np.int64)
                top = (n > 0) & (n == best[aligned.pairs >> 32]) if len(best) else n > 0
                word = np.repeat(np.arange(len(n_first)), aligned.n_links)
                add = lambda x: np.bincount(word, x, len(n_first)).astype(np.int64)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                total = lambda x: np.bincount(doc, x[codes], len(sizes)).astype(np.int64)
                out = pd.DataFrame({"batch": r.batch, "place": np.arange(len(sizes)),
                                    "doc_id": pd.Series(np.frombuffer(r.doc_ids, np.int64), dtype="Int64").mask(np.frombuffer(r.nulls, bool)),
                                    "n_best": total(add(top)), "count_sum": total(add(n))})
                digests = [""] * len(sizes)
                if facts:
                    n_groups, texts = aligned.groups()
                    flat, ends = codes.tolist(), np.cumsum(sizes)
                    whole = [b";".join(map(texts.__getitem__, flat[y - x:y])) for x, y in zip(sizes.tolist(), ends.tolist())]
                    digests = [hashlib.sha256(w).hexdigest() if w else "" for w in whole]
                    if with_groups:
                        out["groups"] = [w.decode() for w in whole]
                    for name, x in (("n_a", n_first), ("n_b", n_second), ("n_groups", n_groups), ("n_links", aligned.n_links)):
                        out[name] = total(x)
                else:
                    for name in ("n_a", "n_b", "n_groups", "n_links"):
                        out[name] = 0
                    if with_groups:
                        out["groups"] = ""
                out["groups_sha256"] = digests
                yield out

    return run


def aligned_documents(docs: DataFrame, byte_name: str, piece_name: str, with_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of ``docs`` (doc_id, text); ``groups`` on demand.

    A space and the text are tokenized by the byte-level tokenizer, the text by the piece tokenizer, which adds the space. Texts that are
    null or empty, or whose tokens' bytes are not the space and the text, have no tokens: zeros and an empty digest. A pair counts a
    document once; repeated rows are documents of their own. A null doc_id is kept, other columns don't matter, an empty table
    gives no rows. Groups are written as ``a1,a2|b1;a3|b2,b3``.
    """
    batches = tokenized(docs, byte_name, piece_name)
    counts = PairCounts(batches)
    kinds = f"batch long, place long, doc_id long, {FACTS}, groups_sha256 string" + ", groups string" * with_groups
    fields = ["doc_id", *NAMES, "groups_sha256", *["groups"] * with_groups]
    lean = batches.drop("pairs", "counts")
    parts = [lean.mapInPandas(tidy(_looked_up(*counts.counted(k), counts.best, byte_name, piece_name, k == 0, with_groups)), kinds)
             for k in range(len(counts.chunks))]
    if len(parts) == 1:
        return parts[0].select(*fields)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    rest = [F.max(c).alias(c) for c in fields[len(NAMES) + 1:]]
    return whole.groupBy("batch", "place", "doc_id").agg(*[F.sum(c).alias(c) for c in NAMES], *rest).select(*fields)


def pair_counts(docs: DataFrame, byte_name: str, piece_name: str) -> DataFrame:
    """a_id, b_id, n_docs: in how many rows of ``docs`` each pair of token ids is linked."""
    return PairCounts(tokenized(docs, byte_name, piece_name)).rows()
