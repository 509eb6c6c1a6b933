"""Token files coded by a static range asymmetric numeral system.

One frequency table serves all blocks. A block holds a fixed number of tokens in interleaved lanes,
so each step codes one token of every lane; it needs nothing but the table. Saved lane states let a
block be decoded from several places at once, and a checksum is compared after decoding.

Files: ``table`` (symbol, frequency) and ``blocks`` (see ``BLOCKS``), as Parquet, so that any store Spark writes to will do.
"""

from __future__ import annotations

import gc
import re
import unicodedata
import zlib
from array import array
from functools import lru_cache
from itertools import compress

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annualis.llm.common import forget_half, pieces, tidy, utf8
from annualis.session import scratch_path, stored

SCALE = 20  # frequencies add up to 2 ** SCALE
LOWER = np.uint64(1 << 31)  # a state is between this and 2 ** 32 times as much
WORD = np.uint64(32)
LANES = 1024
BLOCK = 1 << 17  # tokens of a block
CHECKPOINT = 64  # steps between saved states
PART_TOKENS = 1 << 22
CACHE = 600_000  # stretches of text, and runs of them, that a worker remembers
BYTES = 2 << 20


class Table:
    """Frequencies of symbols in ascending order, scaled to add up to 2 ** SCALE."""

    def __init__(self, symbols: np.ndarray, frequencies: np.ndarray):
        self.symbols = symbols.astype(np.int64)
        self.frequency = frequencies.astype(np.uint64)
        self.before = np.cumsum(self.frequency) - self.frequency
        self.slot = np.repeat(np.arange(len(symbols), dtype=np.int32), frequencies)
        self.place = None
        if len(symbols) and self.symbols[-1] < 1 << SCALE:
            self.place = np.zeros(int(self.symbols[-1]) + 1, np.int32)
            self.place[self.symbols] = np.arange(len(symbols))

    @classmethod
    def of_counts(cls, symbols: np.ndarray, counts: np.ndarray) -> Table:
        """Every symbol gets a slot at least; what is over or missing is settled where it changes least."""
        size = 1 << SCALE
        if len(symbols) > size:
            raise ValueError("more symbols than slots")
        order = np.argsort(symbols)
        symbols, counts = symbols[order], counts[order].astype(np.float64)
        scaled = np.maximum(1, np.floor(counts * size / counts.sum())).astype(np.int64)
        over = int(scaled.sum()) - size
        if over < 0:
            scaled[np.argmax(scaled)] -= over
        while over > 0:
            cut = np.minimum(scaled - 1, np.maximum(1, (scaled * (over / scaled.sum())).astype(np.int64)))
            for k in np.argsort(-scaled, kind="stable"):
                take = min(int(cut[k]), over)
                scaled[k] -= take
                over -= take
                if not over:
                    break
        return cls(symbols, scaled)

    def index(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.symbols, ids) if self.place is None else self.place[ids]


def encode_block(ids: np.ndarray, table: Table) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(lanes, words, states, offsets): coded words, and the states and word offsets of each checkpoint.

    Tokens are coded from the last to the first, a row of lanes at a time; the words of a row come in lane order.
    """
    n = len(ids)
    lanes = max(1, min(LANES, n))
    rows = -(-n // lanes)
    symbol = table.index(ids)
    frequency, before = table.frequency.take(symbol), table.before.take(symbol)
    most = frequency << np.uint64(63 - SCALE)
    state, scale = np.full(lanes, LOWER), np.uint64(SCALE)
    out, states, sizes = [None] * rows, {}, np.zeros(rows, np.int64)
    for row in range(rows - 1, -1, -1):
        part = slice(row * lanes, min(n, (row + 1) * lanes))
        f, x = frequency[part], state[: part.stop - part.start]  # x is changed in place
        full = np.flatnonzero(x >= most[part])
        high = x[full]
        out[row] = high.astype(np.uint32)
        sizes[row] = len(full)
        x[full] = high >> WORD
        times = x // f
        x -= times * f
        x += times << scale
        x += before[part]
        if row % CHECKPOINT == 0:
            states[row] = state.copy()
    offsets = (np.cumsum(sizes) - sizes)[::CHECKPOINT]
    words = np.concatenate(out) if out else np.zeros(0, np.uint32)
    return lanes, words, np.concatenate([states[r] for r in range(0, rows, CHECKPOINT)]) if rows else np.zeros(0, np.uint64), offsets


def decode_rows(table: Table, n: int, lanes: int, words: np.ndarray, state: np.ndarray, first: int, offset: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of rows ``first`` up to ``last`` from a checkpoint's state, and the state after them."""
    state, mask, scale = state.copy(), np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
    out = []
    for row in range(first, last):
        x = state[: min(lanes, n - row * lanes)]  # changed in place
        slot = x & mask
        symbol = table.slot.take(slot.view(np.int64))
        out.append(symbol)
        x >>= scale
        x *= table.frequency.take(symbol)
        x += slot
        x -= table.before.take(symbol)
        low = np.flatnonzero(x < LOWER)
        x[low] = (x[low] << WORD) | words[offset:offset + len(low)]
        offset += len(low)
    return table.symbols[np.concatenate(out)] if out else np.zeros(0, np.int64), state


def decode_block(table: Table, n: int, lanes: int, words: np.ndarray, states: np.ndarray, offsets: np.ndarray, checksum: int) -> np.ndarray:
    """All tokens of a block, each stretch between checkpoints from its own state; raises if the checksum differs."""
    rows, parts = -(-n // lanes) if n else 0, []
    states = states.reshape(-1, lanes) if n else states
    for k, first in enumerate(range(0, rows, CHECKPOINT)):
        last = min(rows, first + CHECKPOINT)
        ids, state = decode_rows(table, n, lanes, words, states[k], first, int(offsets[k]), last)
        after = states[k + 1] if last < rows else np.full(lanes, LOWER)
        if not np.array_equal(state, after):
            raise ValueError("a block's states don't meet")
        parts.append(ids)
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    if zlib.crc32(ids.astype("<u4").tobytes()) != checksum:
        raise ValueError("a block's checksum differs")
    return ids


def joined_crc(first: int, second: int, size: int) -> int:
    """CRC-32 of two byte strings end to end, from that of each and the second's size."""
    blank = bytes(size)
    return zlib.crc32(blank, first) ^ zlib.crc32(blank) ^ second


WHITE = " \t\n\v\f\r"
_PLAIN = [c for c in map(chr, range(0x250)) if c != "\u0130" and not c.isspace() and unicodedata.category(c) != "Cc"]  # NFC leaves these as they are, and lower case makes one of one
_OF = {kind: re.escape("".join(c for c in _PLAIN if unicodedata.category(c)[0] == kind)) for kind in "LN"}
RUNS = re.compile(f"[{_OF['L']}]+|[{_OF['N']}]|'(?:[stmd]|re|ve|ll)|[^{_OF['L']}{_OF['N']}{WHITE}]+")
OTHER = re.compile(f"[^{re.escape(''.join(_PLAIN))}{WHITE}]")


class WordTokenizer:
    """A tokenizer that drops white space and case and parts words into English endings, runs of letters, single digits and runs of signs.

    No merge, normal form or case rule of such a tokenizer reaches over white space, so the ids of a text are those of its stretches without
    white space in turn. A text or a stretch of plain characters is made up from its runs: new ones are encoded together, parted by spaces, and
    the last token of a run is marked as such by the vocabulary. Other stretches are joined by a special token, whose id then parts their ids.
    Normal forms, case and parting have nothing left to do on runs of ASCII, so the library's model gets those parted at spaces alone.
    """

    MARK = "<|endoftext|>"
    LAST = "</w>"
    TOGETHER = 128

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Sequence
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.library, self.marked, self.lean = (Tokenizer.from_file(path) for _ in range(3))
        self.library.encode_special_tokens = self.lean.encode_special_tokens = True
        self.lean.normalizer, self.lean.pre_tokenizer = Sequence([]), CharDelimiterSplit(" ")
        signs = " ".join(c for c in map(chr, range(33, 127)) if c not in "'" and not c.isupper())
        if self.lean.encode(signs, add_special_tokens=False).ids != self.library.encode(signs, add_special_tokens=False).ids:
            self.lean = self.library
        self.mark = self.marked.token_to_id(self.MARK)
        names = self.library.get_vocab()
        self.last = np.zeros(max(names.values()) + 1, bool)
        self.last[[k for name, k in names.items() if name.endswith(self.LAST)]] = True
        self.known: dict[bytes, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def _learn(self, new: list[bytes]) -> None:
        odd = new if self.mark is None else [w for w in new if b"<|" in w]
        for word, found in zip(odd, self.library.encode_batch_fast([w.decode("utf-8", "replace") for w in odd], add_special_tokens=False)):
            self.known[word] = array("I", found.ids).tobytes()
        plain = [w for w in new if b"<|" not in w] if self.mark is not None else []
        groups = [plain[k:k + self.TOGETHER] for k in range(0, len(plain), self.TOGETHER)]
        texts = [self.MARK.encode().join(g).decode("utf-8", "replace") for g in groups]
        for group, found in zip(groups, self.marked.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            cuts = (np.flatnonzero(ids == self.mark) * 4).tolist()
            if len(cuts) != len(group) - 1:
                raise ValueError("a stretch holds the mark")
            data = ids.tobytes()
            for word, start, end in zip(group, [0, *[c + 4 for c in cuts]], [*cuts, len(data)]):
                self.known[word] = data[start:end]

    def _learn_runs(self, new: list[str]) -> None:
        plain = [t.isascii() for t in new]
        self._learn_by(self.lean, list(compress(new, plain)))
        self._learn_by(self.library, [t for t, one in zip(new, plain) if not one])

    def _learn_by(self, tokenizer, new: list[str]) -> None:
        groups = [new[k:k + self.TOGETHER] for k in range(0, len(new), self.TOGETHER)]
        for group, found in zip(groups, tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends = (np.flatnonzero(self.last[ids]) * 4 + 4).tolist()
            if len(ends) != len(group):
                raise ValueError("a run of letters or signs isn't a word of its own")
            data = ids.tobytes()
            self.runs.update((run, data[a:b]) for run, a, b in zip(group, [0, *ends], ends))

    def _learn_all(self, new: set[bytes]) -> None:
        """Learn stretches, plain ones from their runs."""
        listed = list(new)
        texts = b" ".join(listed).decode("utf-8", "replace").lower()
        words = texts.split(" ")
        found = [m.start() for m in OTHER.finditer(texts)]
        if found:
            ends = np.cumsum([len(t) + 1 for t in words])
            plain = np.ones(len(words), bool)
            plain[np.searchsorted(ends, found, side="right")] = False
            self._learn(list(compress(listed, ~plain)))
            listed, words = list(compress(listed, plain)), list(compress(words, plain))
        parts = [RUNS.findall(t) for t in words]
        self._know_runs(set().union(*parts))
        get = self.runs.__getitem__
        self.known.update((w, b"".join(map(get, part))) for w, part in zip(listed, parts) if w)

    def _know_runs(self, runs: set[str]) -> None:
        fresh = runs.difference(self.runs)
        if len(self.runs) + len(fresh) > CACHE:
            forget_half(self.runs)
            fresh = runs.difference(self.runs)
        self._learn_runs(list(fresh))

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        gc.disable()  # nothing here is cyclic, and the many lists would have it run over all that is remembered
        try:
            return self._encode_all(texts)
        finally:
            gc.enable()

    def _encode_all(self, texts: list[bytes]) -> list[bytes]:
        low = [t.decode("utf-8", "replace").lower() for t in texts]
        plain = [not OTHER.search(t) for t in low]
        parts = [RUNS.findall(t) for t in compress(low, plain)]
        del low
        self._know_runs(set().union(*parts))
        get = self.runs.__getitem__
        whole = iter([b"".join(map(get, part)) for part in parts])
        del parts
        mixed = iter(self._by_stretches([t for t, one in zip(texts, plain) if not one]))
        return [next(whole if one else mixed) for one in plain]

    def _by_stretches(self, texts: list[bytes]) -> list[bytes]:
        parts = [t.lower().split() for t in texts]
        words = set().union(*parts)
        new = words.difference(self.known)
        if len(self.known) + len(new) > CACHE:
            forget_half(self.known)
            new = words.difference(self.known)
        self._learn_all(new)
        known = self.known
        return [b"".join(map(known.__getitem__, part)) for part in parts]


@lru_cache(maxsize=2)
def tokenizer_of(name: str) -> WordTokenizer:
    import os

    import public_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordTokenizer(public_tokenizers.path(name))


def tokenize(docs: DataFrame, name: str, end_id: int, counts: bool = False) -> DataFrame:
    """doc_id, n, ids (compressed little-endian unsigned 32-bit) of every document, ``end_id`` last; null texts have it alone.

    With ``counts`` each task adds a row whose n is -1 and whose ids are how often it has seen each token (64-bit).
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(frames):
        tokenizer, squeeze = tokenizer_of(name), zstandard.ZstdCompressor(level=1).compress
        seen = np.zeros(len(tokenizer.last) + end_id, np.int64)
        for frame in frames:
            texts = utf8(frame["text"])
            for a, b in pieces([len(t) for t in texts], BYTES):
                ids = [x + end for x in tokenizer.encode_all(texts[a:b])]
                if counts:
                    seen += np.bincount(np.frombuffer(b"".join(ids), "<u4"), minlength=len(seen))
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[a:b].astype("Int64"), "n": [len(x) // 4 for x in ids], "ids": [squeeze(x) for x in ids]})

        if counts:
            yield pd.DataFrame({"doc_id": pd.array([None], "Int64"), "n": [-1], "ids": [squeeze(seen.tobytes())]})

    return docs.select("doc_id", "text").mapInPandas(tidy(run), "doc_id long, n long, ids binary")


def _ids(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u4")


def _histogram(frames):
    """Counts of tokens, from documents' ids and from rows that have counted them."""
    counts = np.zeros(0, np.int64)
    for frame in frames:
        for n, data in zip(frame["n"], frame["ids"]):
            own = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.int64) if n < 0 else np.bincount(_ids(data))
            if len(own) > len(counts):
                counts = np.pad(counts, (0, len(own) - len(counts)))
            counts[: len(own)] += own
    some = np.flatnonzero(counts)
    yield pd.DataFrame({"symbol": some, "n": counts[some]})


BLOCKS = ("part int, block int, first long, n int, lanes int, words binary, states binary, offsets binary, checksum long, "
          "first_doc long, doc_sizes binary, doc_ids binary, doc_nulls binary")


def _encode_parts(symbols: np.ndarray, frequencies: np.ndarray):
    """Sorted documents of a partition to its blocks. A document may go on in the next block."""
    def run(frames):
        from pyspark import TaskContext

        table, part = Table(symbols, frequencies), TaskContext.get().partitionId()
        waiting, docs, size, block, first, first_doc = [], [], 0, 0, 0, 0

        def flush(n):
            nonlocal waiting, docs, size, block, first, first_doc
            ids = np.concatenate(waiting)
            own, rest = ids[:n], ids[n:]
            lanes, words, states, offsets = encode_block(own, table)
            sizes, left, taken = [], n, 0
            while left:
                take = min(left, docs[taken][1])
                sizes.append(take)
                left -= take
                docs[taken] = (docs[taken][0], docs[taken][1] - take)
                taken += docs[taken][1] == 0
            own_docs = [d[0] for d in docs[: len(sizes)]]
            row = (part, block, first, n, lanes, words.tobytes(), states.tobytes(), offsets.astype(np.int64).tobytes(),
                   zlib.crc32(own.astype("<u4").tobytes()), first_doc, np.array(sizes, np.int32).tobytes(),
                   np.array([d or 0 for d in own_docs], np.int64).tobytes(), np.array([d is None for d in own_docs]).tobytes())
            block, first, first_doc = block + 1, first + n, first_doc + taken
            waiting, docs, size = [rest], docs[taken:], len(rest)
            return row

        columns = [c.split()[0] for c in BLOCKS.split(", ")]
        for frame in frames:
            rows = []
            for doc_id, data in zip(frame["doc_id"], frame["ids"]):
                ids = _ids(data)
                waiting.append(ids)
                docs.append((None if pd.isna(doc_id) else int(doc_id), len(ids)))
                size += len(ids)
                while size >= BLOCK:
                    rows.append(flush(BLOCK))
                    if len(rows) >= 16:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns)
        if size:
            yield pd.DataFrame([flush(size)], columns=columns)

    return run


def write_tokens(tokens: DataFrame, path: str, counted: bool = False) -> None:
    """Write ``tokens`` (doc_id, n, ids) under ``path`` in ascending doc_id order (nulls first).

    With ``counted`` rows with an n of -1 hold the counts of all tokens (see ``tokenize``). Equal doc_ids come in order of their ids. The frequencies count every token; the table is as long as the alphabet.
    """
    spark = tokens.sparkSession
    counting = tokens.filter("n < 0") if counted else tokens
    tokens = tokens.filter("n >= 0")
    rows = counting.select("n", "ids").mapInPandas(tidy(_histogram), "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect()
    symbols = np.array([r["symbol"] for r in rows], np.int64)
    counts = np.array([r["n"] for r in rows], np.int64)
    table = Table.of_counts(symbols, counts) if len(rows) else Table(symbols, counts)
    own = [(int(s), int(f)) for s, f in zip(table.symbols, table.frequency)]
    spark.createDataFrame(own, "symbol long, frequency long").coalesce(1).write.parquet(f"{path}/table")
    parts = max(1, -(-int(counts.sum()) // PART_TOKENS))
    order = ["doc_id", "n", F.xxhash64("ids")]
    ordered = tokens.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "ids")
    ordered.mapInPandas(_encode_parts(table.symbols, table.frequency.astype(np.int64)), BLOCKS).write.parquet(f"{path}/blocks")


def _decode_parts(symbols: np.ndarray, frequencies: np.ndarray, before: dict[int, int]):
    def run(frames):
        table = Table(symbols, frequencies)
        for frame in frames:
            for r in frame.itertuples(index=False):
                words, states = np.frombuffer(r.words, np.uint32), np.frombuffer(r.states, np.uint64)
                ids = decode_block(table, r.n, r.lanes, words, states, np.frombuffer(r.offsets, np.int64), r.checksum)
                data, sizes = ids.astype("<u4"), np.frombuffer(r.doc_sizes, np.int32).astype(np.int64)
                starts = np.cumsum(sizes) - sizes
                nulls, doc_ids = np.frombuffer(r.doc_nulls, bool), np.frombuffer(r.doc_ids, np.int64)
                border = np.zeros(len(sizes), bool)
                border[[0, -1]] = True
                yield pd.DataFrame({
                    "part": r.part, "doc": r.first_doc + np.arange(len(sizes)),
                    "doc_id": pd.Series(doc_ids, dtype="Int64").mask(nulls), "start": before[r.part] + r.first + starts, "n": sizes, "border": border,
                    "crc": [zlib.crc32(data[a:a + k].tobytes()) for a, k in zip(starts, sizes)]})

    return run


def _joined_crcs(first: pd.Series, parts: pd.Series) -> pd.Series:
    """Checksums of documents, from that of the only part or from all parts, where there are more."""
    out = []
    for crc, own in zip(first, parts):
        if len(own) > 1:
            own = sorted(own, key=lambda p: p["start"])
            crc = own[0]["crc"]
            for p in own[1:]:
                crc = joined_crc(crc, p["crc"], 4 * p["n"])
        out.append(crc)
    return pd.Series(out, dtype="int64")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files under ``path``.

    Blocks are decoded apart from each other; a document in several blocks, first or last in each, is joined from their checksums.
    """
    rows = spark.read.parquet(f"{path}/table").collect()
    rows.sort(key=lambda r: r["symbol"])
    symbols, frequencies = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
    blocks = spark.read.parquet(f"{path}/blocks")
    before, total = {}, 0
    for r in sorted(blocks.groupBy("part").agg(F.sum("n").alias("n")).collect(), key=lambda r: r["part"]):
        before[r["part"]] = total
        total += r["n"]
    found = blocks.mapInPandas(_decode_parts(symbols, frequencies, before), "part int, doc long, doc_id long, start long, n long, border boolean, crc long")
    join_crcs = F.pandas_udf(_joined_crcs, "long")
    docs = found.groupBy("part", "doc").agg(F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n").alias("n_tokens"),
                                            F.first("crc").alias("crc"), F.collect_list(F.when(F.col("border"), F.struct("start", "n", "crc"))).alias("parts"))
    return docs.select("doc_id", "start", "n_tokens", join_crcs("crc", "parts").alias("ids_crc32"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The token ids themselves: part, first (place of the block in its part) and ids (array) of every block."""
    rows = sorted(spark.read.parquet(f"{path}/table").collect(), key=lambda r: r["symbol"])
    symbols, frequencies = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)

    def run(frames):
        table = Table(symbols, frequencies)
        for frame in frames:
            for r in frame.itertuples(index=False):
                ids = decode_block(table, r.n, r.lanes, np.frombuffer(r.words, np.uint32), np.frombuffer(r.states, np.uint64),
                                   np.frombuffer(r.offsets, np.int64), r.checksum)
                yield pd.DataFrame({"part": [r.part], "first": [r.first], "ids": [ids.tolist()]})

    return spark.read.parquet(f"{path}/blocks").mapInPandas(run, "part int, first long, ids array<long>")


def document_tokens(docs: DataFrame, name: str, end_id: int) -> DataFrame:
    """Tokenize, write and read back; doc_id, start, n_tokens, ids_crc32 of every document row."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(stored(tokenize(docs, name, end_id, counts=True), "ids"), path, counted=True)
    return read_tokens(docs.sparkSession, path)
