"""Repeated passages by an enhanced suffix array, cut into tasks by anchors in the text.

Every ``SPAN`` bytes hold an anchor: the 16 bytes with the smallest hash among them. Equal strings have
equal anchors, so the stretches of text that share an anchor meet in one task, and no repeat is
lost. There a suffix array with common-prefix lengths is scanned with a stack; an interval whose
occurrences differ in the byte before them is a maximal repeat group (within the reach of the anchor).

Three passes read the texts. The first finds anchors that occur in more than one text, the second
sends the stretches around them, the third applies what was found. Equal texts travel once for
a batch, and equal stretches once for a block of texts, so neither copies nor common lines gather. An anchor
with more than ``HOT`` distinct stretches is common, but its surroundings differ: its stretches are cut into single spans,
which are dealt by all their bytes, if they occur twice. What is left to one task is a row of a span for each block.

``repeat_groups.py`` puts the repeats together to maximal ones of any length, with all their occurrences.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.llm.common import stored_once, tidy

SPAN = 50
GRAM = 16
WINDOWS = SPAN - GRAM + 1  # grams in a span
BLOCK_BYTES = 4 << 20  # texts that one task holds
PIECE = 1 << 20  # bytes whose anchors are found at a time
BATCH_ROWS = 2_000
HOT = 1 << 14  # distinct stretches with one anchor that may meet in a task
NEVER = 1 << 62
NO_ID = (1 << 63) - 1  # a null doc_id counts as larger than any other
SIDE = 9  # bits of a byte beside a stretch
PLACE = np.uint64((1 << 24) - 1)
HASH_BITS = np.uint64((1 << 40) - 1)
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                              0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def _words(data: bytes | np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as integers."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", data, 0, (1,)).copy()


def _stir(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(31)
    x *= MIX[3]
    x ^= x >> np.uint64(29)
    return x


def _squeeze(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def _expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    sizes = np.asarray(sizes, np.int64)
    if not len(sizes):
        return np.zeros(0, np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return np.repeat(np.asarray(starts, np.int64) - first, sizes) + np.arange(int(sizes.sum()))


class Block:
    """Distinct texts of one block in the order of their digests, end to end."""

    def __init__(self, packs: list[bytes]):
        tables = [pa.ipc.open_stream(p).read_all() for p in packs]
        frame = pa.concat_tables(tables).to_pandas().sort_values(["digest", "first"], kind="stable").drop_duplicates("digest")
        texts = frame["text"].tolist()
        self.digests, self.ids = frame["digest"].tolist(), frame["first"].to_numpy(np.int64)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self._runs()

    def _runs(self) -> None:
        """Runs of spans with one anchor: where they start, how many spans, hash of the anchor, text."""
        n, begins, counts, hashes = len(self.data), [], [], []
        valid = np.ones(n, bool)
        for start, end in zip(self.ends - self.sizes, self.ends):
            valid[max(start, end - SPAN + 1):end] = False
        for at in range(0, max(0, n - SPAN + 1), PIECE):
            part = self.data[at:at + PIECE + SPAN - 1]
            words = _words(part)
            gram = _stir(words[:-8] * MIX[0] + words[8:] * MIX[1])
            low = (gram & ~PLACE) | np.arange(len(gram), dtype=np.uint64)
            for step in (1, 2, 4, 8, 16, WINDOWS - 32):
                low = np.minimum(low[:-step], low[step:])
            place = (low & PLACE).astype(np.int64)
            ok = valid[at:at + len(place)]
            new = ok.copy()
            new[1:] &= ~ok[:-1] | (place[1:] != place[:-1])
            begin = np.flatnonzero(new)
            last = ok.copy()
            last[:-1] &= ~ok[1:] | new[1:]
            begins.append(begin + at)
            counts.append(np.flatnonzero(last) - begin + 1)
            hashes.append(gram[place[begin]])
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        self.begin, self.count, self.hash = join(begins, np.int64), join(counts, np.int64), join(hashes, np.uint64)
        self.text = np.searchsorted(self.ends, self.begin, side="right")

    def anchors(self, within: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the block's anchors, distinct stretches of each, and the anchors that occur in two of its texts.

        With ``within`` two places in one text are enough.
        """
        anchor = self.hash & HASH_BITS
        order = np.lexsort((self.text, anchor))
        ordered = anchor[order]
        new = np.diff(ordered, prepend=~ordered[:1]) != 0
        which, found = np.cumsum(new) - 1, ordered[new]
        again = ~new if within else ~new & (np.diff(self.text[order], prepend=-1) != 0)
        several = np.bincount(which)[which] > 1
        run = order[several]
        first, _ = distinct(which[several].astype(np.uint64), stretch_key(_words(self.data), self.begin[run], self.count[run]))
        return found, np.maximum(1, np.bincount(which[several][first], minlength=len(found))), found[np.unique(which[again])]

    def _sides(self) -> np.ndarray:
        """The bytes before and after each stretch, plus one and 0 at the ends of its text, in one number."""
        end, stop = self.ends[self.text], self.begin + self.count + SPAN - 1
        left = np.where(self.begin > end - self.sizes[self.text], self.data[np.maximum(self.begin - 1, 0)].astype(np.int64) + 1, 0)
        right = np.where(stop < end, self.data[np.minimum(stop, len(self.data) - 1)].astype(np.int64) + 1, 0)
        return left << SIDE | right

    def stretches(self, shared: np.ndarray, sides: bool = False) -> None:
        """Keep the runs with a shared anchor and number their distinct stretches of text.

        ``facts`` of each are its smallest and largest id; with ``sides``, where it differs by the bytes beside it too, how often
        it occurs and these bytes.
        """
        keep = np.isin(self.hash & HASH_BITS, shared)
        self.begin, self.count, self.hash, self.text = self.begin[keep], self.count[keep], self.hash[keep], self.text[keep]
        side = self._sides() if sides else np.zeros(len(self.begin), np.int64)
        self.first, self.stretch = distinct(*stretch_keys(_words(self.data), self.begin, self.count, side))
        if sides:
            self.facts = np.bincount(self.stretch, minlength=len(self.first)), side[self.first]
            return
        ids = self.ids[self.text]
        lowest, highest = np.full(len(self.first), NO_ID), np.full(len(self.first), -NO_ID)
        np.minimum.at(lowest, self.stretch, ids)
        np.maximum.at(highest, self.stretch, ids)
        self.facts = lowest, highest

    def placed(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(run, first span, spans, value) of what was found of the stretches, for every run that has one."""
        if not found:
            return (np.zeros(0, np.int64),) * 4
        fields = []
        for data in found:
            raw = _expand(data)
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            fields.append(np.frombuffer(raw, np.int64, 4 * n, 8).reshape(4, n))
        number, offset, size, value = np.concatenate(fields, axis=1)
        order = np.argsort(self.stretch, kind="stable")
        start = np.searchsorted(self.stretch[order], np.arange(len(self.first) + 1))
        times = np.diff(start)[number]
        run, of = order[ranges(start[number], times)], np.repeat(np.arange(len(number)), times)
        return run, self.begin[run] + offset[of], size[of], value[of]


def span_hash(words: np.ndarray, at: np.ndarray, turn: int = 0) -> np.ndarray:
    """Hash of the span at each place; another ``turn`` gives another hash."""
    out = np.zeros(len(at), np.uint64)
    for k, step in enumerate((0, 8, 16, 24, 32, 40, SPAN - 8)):
        out = _stir(out * MIX[6] + words[at + step] * MIX[(k + turn) % len(MIX)])
    return out


def stretch_key(words: np.ndarray, begin: np.ndarray, count: np.ndarray, side: np.ndarray | int = 0, turn: int = 0) -> np.ndarray:
    """Hash of each stretch, by its first and last span, how many it has and what is beside it."""
    size = (side << 8 | count).astype(np.uint64)
    return _stir(size * MIX[2] + span_hash(words, begin, turn) * MIX[0] + span_hash(words, begin + count - 1, turn))


def stretch_keys(words: np.ndarray, begin: np.ndarray, count: np.ndarray, side: np.ndarray | int = 0) -> list[np.ndarray]:
    """Two hashes, as equal stretches are told by 128 bits."""
    return [stretch_key(words, begin, count, side, turn) for turn in (0, 1)]


def distinct(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each different pair comes first, and which of these each pair is."""
    order = np.lexsort((two, one))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def suffix_array(data: np.ndarray, starts: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``starts``, each ``left`` bytes long, and the common prefix with the one before.

    Suffixes are at least ``SPAN`` and at most ``SPAN + WINDOWS`` bytes long; prefixes under ``SPAN`` count as 0.
    """
    words = _words(data).byteswap()  # big-endian value, so integers sort like bytes
    keys = [words[starts + k] for k in (0, 8, 16, 24, 32, 40, SPAN - 8)]
    tail = np.zeros((len(starts), 40), np.uint8)
    extra = left - SPAN
    for k in range(WINDOWS):
        more = extra > k
        tail[more, k] = data[starts[more] + SPAN + k]
    tails = [np.ascontiguousarray(tail[:, k:k + 8]).view(">u8").ravel().astype(np.uint64) for k in range(0, 40, 8)]
    order = np.lexsort((*tails[::-1], *keys[::-1]))
    same = np.ones(max(0, len(order) - 1), bool)
    for key in keys:
        sorted_key = key[order]
        same &= sorted_key[1:] == sorted_key[:-1]
    prefix = np.zeros(len(order), np.int64)
    at = np.flatnonzero(same) + 1
    a, b = order[at - 1], order[at]
    differ = tail[a, :WINDOWS] != tail[b, :WINDOWS]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), WINDOWS)
    prefix[at] = SPAN + np.minimum(common, np.minimum(extra[a], extra[b]))
    return order, prefix


def maximal_repeats(prefix: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Rows (first, last, length): intervals of the suffix array that are maximal repeat groups.

    ``prefix[k]`` is the common prefix of suffixes k-1 and k, 0 where they share no span; ``before[k]`` the
    byte before suffix k, or a number of its own. The intervals nest; a stack holds the open ones. Groups whose
    occurrences all have the same byte before them are part of a longer repeat and left out.
    """
    changes = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])])
    joined = np.concatenate([prefix > 0, [False]])
    heads = np.flatnonzero(~joined[:-1] & joined[1:])
    tails = np.flatnonzero(joined[:-1] & ~joined[1:])
    two = tails - heads == 1
    pairs = heads[two]
    pairs = pairs[changes[pairs + 1] != changes[pairs]]
    out = [np.stack([pairs, pairs + 1, prefix[pairs + 1]], axis=1)]
    for head, tail in zip(heads[~two].tolist(), tails[~two].tolist()):
        lengths, change = prefix[head + 1:tail + 1].tolist(), changes[head:tail + 1].tolist()
        stack, found = [], []
        for k, length in enumerate([*lengths, 0]):
            first = k
            while stack and stack[-1][0] > length:
                depth, first = stack.pop()
                if change[k] != change[first]:
                    found.append((head + first, head + k, depth))
            if length and (not stack or stack[-1][0] < length):
                stack.append((length, first))
        if found:
            out.append(np.array(found, np.int64))
    return np.concatenate(out)


def lowest_ids(data: np.ndarray, begin: np.ndarray, count: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For every span of every stretch (``begin``, ``count`` spans, smallest id) the smallest id its bytes occur with.

    Spans are numbered stretch by stretch.
    """
    starts = ranges(begin, count)
    owner = np.repeat(np.arange(len(begin)), count)
    best = ids[owner]
    hashes = span_hash(_words(data), starts)
    _, inverse, times = np.unique(hashes, return_inverse=True, return_counts=True)
    some = np.flatnonzero(times[inverse] > 1)
    if not len(some):
        return best
    left = (begin + count + SPAN - 1)[owner[some]] - starts[some]
    order, prefix = suffix_array(data, starts[some], left)
    suffix = some[order]
    inner = starts[suffix] > begin[owner[suffix]]
    before = np.where(inner, data[starts[suffix] - 1].astype(np.int64), -1 - np.arange(len(suffix)))
    groups = maximal_repeats(prefix, before)
    size = groups[:, 1] - groups[:, 0] + 1
    member = ranges(groups[:, 0], size)
    of = np.repeat(np.arange(len(groups)), size)
    low = np.full(len(groups), NO_ID)
    np.minimum.at(low, of, ids[owner[suffix[member]]])
    spans = (groups[:, 2] - SPAN + 1)[of]
    np.minimum.at(best, ranges(suffix[member], spans), np.repeat(low[of], spans))
    return best


def _pack(blocks: int):
    """Record batches to packs: the distinct texts of a batch, by block of their digest."""
    def run(batches):
        for batch in (b.slice(k, BATCH_ROWS) for b in batches for k in range(0, b.num_rows, BATCH_ROWS)):
            seen: dict[bytes, int] = {}
            digests, ids, texts = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or b""
                if len(text) < SPAN:
                    continue
                digest, doc_id = hashlib.md5(text).digest(), NO_ID if doc_id is None else doc_id
                if digest in seen:
                    ids[seen[digest]] = min(ids[seen[digest]], doc_id)
                else:
                    seen[digest] = len(ids)
                    digests.append(digest)
                    ids.append(doc_id)
                    texts.append(text)
            table = pa.table({"digest": pa.array(digests, pa.binary()), "first": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.large_binary())})
            block = np.array([int.from_bytes(d[:8], "big") % blocks for d in digests], np.int64)
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[order], prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(order)]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_table(table.take(pa.array(order[a:b])).combine_chunks())
                yield pa.RecordBatch.from_pydict({"block": pa.array([int(block[order[a]])], pa.int64()), "kind": pa.array(["text"]),
                                                  "part": pa.array([0], pa.int32()), "data": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    return run


ROWS = "block long, kind string, part int, data binary"


def _rows(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["block", "kind", "part", "data"])


def _of(frame: pd.DataFrame, kind: str) -> list[bytes]:
    return frame.loc[frame["kind"] == kind, "data"].tolist()


def _by_part(values: np.ndarray, parts: int):
    """(part, places of its values) by the remainder of the values."""
    part = (values % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(order)]):
        yield int(part[order[a]]), order[a:b]


def _numbers(frame: pd.DataFrame, kind: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(_expand(d), np.uint64) for d in _of(frame, kind)]])


def _anchor_rows(block: int, found: np.ndarray, stretches: np.ndarray, twice: np.ndarray, parts: int) -> pd.DataFrame:
    rows = [(block, "anchors", p, _squeeze(np.diff(found[at], prepend=np.uint64(0)), stretches[at].astype(np.uint64))) for p, at in _by_part(found, parts)]
    return _rows([*rows, (block, "shared", 0, _squeeze(twice))])


def _find_anchors(parts: int, sides: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return _anchor_rows(int(frame["block"].iloc[0]), *Block(_of(frame, "text")).anchors(within=sides), parts)

    return run


def _shared_anchors(hot: int):
    """Of one part of the hashes, those that occur in more than one block, and those with over ``hot`` stretches, for each block."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        fields = [np.frombuffer(_expand(d), np.uint64).reshape(2, -1) for d in frame["data"]]
        sets = [np.cumsum(f[0], dtype=np.uint64) for f in fields]
        found, which, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        many, common = found[n > 1], found[np.bincount(which, np.concatenate([f[1] for f in fields])) > hot]
        rows = [(b, kind, s[np.isin(s, chosen, assume_unique=True)]) for b, s in zip(frame["block"], sets) for kind, chosen in (("shared", many), ("hot", common))]
        return _rows([(b, kind, 0, _squeeze(s)) for b, kind, s in rows if len(s)])

    return run


def _block(frame: pd.DataFrame, sides: bool = False) -> Block:
    block = Block(_of(frame, "text"))
    block.stretches(_numbers(frame, "shared"), sides)
    return block


def _pack_stretches(number, skip, facts, count, data) -> bytes:
    """Stretches of a block: their numbers, spans of them left out before, two facts, spans, and bytes end to end."""
    return _squeeze(np.array([len(number)], np.int64), *[np.asarray(a).astype(np.int64) for a in (number, skip, *facts, count)], data)


def read_stretches(blobs) -> tuple[list[int], list[np.ndarray], np.ndarray]:
    """How many stretches each blob has, (number, skip, fact, fact, count, begin) of all, and their bytes."""
    sizes, fields, data = [], [], []
    for raw in map(_expand, blobs):
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        sizes.append(n)
        fields.append(np.frombuffer(raw, np.int64, 5 * n, 8).reshape(5, n))
        data.append(np.frombuffer(raw, np.uint8, -1, 8 + 40 * n))
    fields = list(np.concatenate(fields, axis=1))
    reach = fields[4] + SPAN - 1
    return sizes, [*fields, np.cumsum(reach) - reach], np.concatenate(data)


def _send_stretches(parts: int, sides: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if _of(frame, "text"):
            number, block = int(frame["block"].iloc[0]), _block(frame, sides)
            begin, count, anchor = block.begin[block.first], block.count[block.first], block.hash[block.first] & HASH_BITS

            def send(kind, part, at):
                data = block.data[ranges(begin[at], count[at] + SPAN - 1)]
                rows.append((number, kind, part, _pack_stretches(at, np.zeros(len(at)), [f[at] for f in block.facts], count[at], data)))

            hot = np.isin(anchor, _numbers(frame, "hot"))
            calm = np.flatnonzero(~hot)
            for part, at in _by_part(anchor[calm], parts):
                send("stretches", part, calm[at])
            if hot.any():
                send("hot", -1, np.flatnonzero(hot))
        return _rows(rows)

    return run


def beside(data: np.ndarray, starts: np.ndarray, offset: np.ndarray, count: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes before and after each span (``offset`` in a stretch of ``count`` spans), as in ``Block._sides``."""
    left = np.where(offset > 0, data[np.maximum(starts - 1, 0)].astype(np.int64) + 1, side >> SIDE)
    right = np.where(offset < count - 1, data[np.minimum(starts + SPAN, len(data) - 1)].astype(np.int64) + 1, side & ((1 << SIDE) - 1))
    return left, right


def _single_spans(blobs, sides: bool) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Hash, (number, skip, fact, fact) and begin of every span of the stretches, and the bytes."""
    _, (number, skip, one, two, count, begin), data = read_stretches(blobs)
    starts, offset, owner = ranges(begin, count), ranges(np.zeros(len(count)), count), np.repeat(np.arange(len(count)), count)
    two = two[owner]
    if sides:
        left, right = beside(data, starts, offset, count[owner], two)
        two = left << SIDE | right
    return span_hash(_words(data), starts) & HASH_BITS, [number[owner], skip[owner] + offset, one[owner], two], starts, data


def _hot_anchors(parts: int, sides: bool):
    """Spans of a block's stretches with hot anchors, in the place of anchors."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        name, (_, _, one, two), _, _ = _single_spans(frame["data"], sides)
        found, n = np.unique(name, return_counts=True)
        twice = np.union1d(found[n > 1], name[one > 1 if sides else one < two])
        return _anchor_rows(int(frame["block"].iloc[0]), found, np.ones(len(found)), twice, parts)

    return run


def _send_spans(parts: int, sides: bool):
    """Those of the spans that occur twice, each a stretch of its own, dealt by all their bytes."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if _of(frame, "hot"):
            name, fields, starts, data = _single_spans(_of(frame, "hot"), sides)
            shared = np.flatnonzero(np.isin(name, _numbers(frame, "shared")))
            for part, at in _by_part(name[shared], parts):
                number, skip, *facts = (f[shared[at]] for f in fields)
                ones = np.ones(len(at), np.int64)
                rows.append((int(frame["block"].iloc[0]), "stretches", part, _pack_stretches(
                    number, skip, facts, ones, data[ranges(starts[shared[at]], ones * SPAN)])))
        return _rows(rows)

    return run


def _answers(blocks, sizes: list[int], number, skip, same, count, value, wanted) -> pd.DataFrame:
    """Runs of spans with equal values, of distinct stretches (``count``), to each block for its stretches (``same``).

    ``wanted`` chooses by the runs' values and the stretches they are for.
    """
    owner, offset = np.repeat(np.arange(len(count)), count), ranges(np.zeros(len(count)), count)
    head = np.flatnonzero((np.diff(value, prepend=-1) != 0) | (offset == 0))
    run_size = np.diff(head, append=len(value))
    run_owner, run_offset, run_value = owner[head], offset[head], value[head]
    run_from = np.searchsorted(run_owner, np.arange(len(count) + 1))
    rows, at = [], 0
    for block, size in zip(blocks, sizes):
        mine = np.arange(at, at + size)
        at += size
        runs = np.diff(run_from)[same[mine]]
        run, who = ranges(run_from[same[mine]], runs), np.repeat(mine, runs)
        keep = wanted(run_value[run], who)
        run, who = run[keep], who[keep]
        if len(run):
            rows.append((block, "found", 0, _squeeze(np.array([len(run)], np.int64), number[who], skip[who] + run_offset[run], run_size[run], run_value[run])))
    return _rows(rows)


def _judge_stretches(frame: pd.DataFrame) -> pd.DataFrame:
    """Of the stretches of one part, which spans occur with a smaller id, for each block."""
    sizes, (number, skip, lowest, highest, count, begin), data = read_stretches(frame["data"])
    first, same = distinct(*stretch_keys(_words(data), begin, count))
    ids = np.full(len(first), NO_ID)
    np.minimum.at(ids, same, lowest)
    best = lowest_ids(data, begin[first], count[first], ids)
    return _answers(frame["block"], sizes, number, skip, same, count[first], best, lambda low, who: low < highest[who])


RESULT = "digest binary, first long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def covered(block: Block, found: list[bytes]) -> np.ndarray:
    """Which bytes of the block's texts are in a span that occurs with a smaller id."""
    marks = np.zeros(len(block.data) + 1, np.int32)
    run, begin, size, low = block.placed(found)
    hit = low < block.ids[block.text[run]]
    np.add.at(marks, begin[hit], 1)
    np.add.at(marks, begin[hit] + size[hit] + SPAN - 1, -1)
    return np.cumsum(marks[:-1]) > 0


def _cut_texts(with_text: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if _of(frame, "text"):
            block = _block(frame)
            gone = covered(block, _of(frame, "found"))
            for k, (start, end) in enumerate(zip(block.ends - block.sizes, block.ends)):
                mask = gone[start:end]
                kept = block.data[start:end][~mask].tobytes()
                spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                text = None
                if with_text:
                    # A character stays whole if any of its bytes stays.
                    data = block.data[start:end]
                    head = (data & 0xC0) != 0x80
                    char = np.maximum(np.cumsum(head) - 1, 0)
                    stays = np.zeros(int(char[-1]) + 1, bool)
                    np.logical_or.at(stays, char, ~mask)
                    text = data[stays[char]].tobytes()
                rows.append((block.digests[k], int(block.ids[k]), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest(), text))
        return pd.DataFrame(rows, columns=["digest", "first", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def _digest(text):
    return F.unhex(F.md5(text))


def _bytes():
    return F.coalesce(F.col("text"), F.lit("")).cast("binary")


def compared_blocks(docs: DataFrame, judge, sides: bool) -> DataFrame:
    """Rows of every block of texts, to be grouped by block: its texts, its shared anchors, and what ``judge`` found of its stretches."""
    texts = docs.select("doc_id", _bytes().alias("text"))
    total = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    blocks = parts = max(1, -(-int(total) // BLOCK_BYTES))
    packs = lambda: texts.mapInArrow(tidy(_pack(blocks)), ROWS)
    of = lambda rows, key, run: rows.groupBy(key).applyInPandas(tidy(run), ROWS)
    found = stored_once(of(packs(), "block", _find_anchors(parts, sides)), "anchors")
    shared = stored_once(of(found.filter("kind = 'anchors'"), "part", _shared_anchors(HOT)).unionAll(found.filter("kind = 'shared'")), "shared")
    sent = stored_once(of(packs().unionAll(shared), "block", _send_stretches(parts, sides)), "stretches")
    stretches, hot = sent.filter("kind = 'stretches'"), sent.filter("kind = 'hot'")
    if not hot.isEmpty():
        spans = stored_once(of(hot, "block", _hot_anchors(parts, sides)), "spans")
        twice = of(spans.filter("kind = 'anchors'"), "part", _shared_anchors(NEVER)).unionAll(spans.filter("kind = 'shared'"))
        stretches = stretches.unionAll(of(hot.unionAll(twice), "block", _send_spans(parts, sides)))
    judged = stored_once(of(stretches, "part", judge), "found")
    return packs().unionAll(shared.filter("kind = 'shared'")).unionAll(judged)


def repeated_bytes(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """digest, first, n_removed, n_spans, kept_sha256 (and kept) of each distinct text of ``SPAN`` bytes or more.

    ``first`` is the smallest doc_id with the text, for which the figures hold.
    """
    rows = compared_blocks(docs, _judge_stretches, sides=False)
    return rows.groupBy("block").applyInPandas(tidy(_cut_texts(with_text)), RESULT)


def _joined(docs: DataFrame, columns: list, with_text: bool) -> DataFrame:
    results = repeated_bytes(docs, with_text)
    if not with_text:
        results = stored_once(results.drop("kept"), "cut")
    rows = docs.select(*columns, F.octet_length(_bytes()).cast("long").alias("_n"), _digest(_bytes()).alias("digest"),
                       F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("_id"))
    return rows.join(results, "digest", "left").withColumn("_copy", (F.col("_n") >= SPAN) & (F.col("_id") > F.col("first")))


def document_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document.

    A byte is removed if a string of ``SPAN`` bytes over it also starts in a document with a smaller
    doc_id. A text that a smaller doc_id has too is removed whole, unless it is shorter. Null texts are empty; a null
    doc_id counts as the largest; rows that share a doc_id don't remove each other's bytes unless their texts are equal to
    a smaller one's.
    """
    rows = _joined(docs, ["doc_id", F.sha2(_bytes(), 256).alias("_whole")], False)
    n, copy = F.col("_n"), F.col("_copy")
    return rows.select(
        "doc_id", n.alias("n_bytes"),
        F.when(copy, n).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, hashlib.sha256(b"").hexdigest()).otherwise(F.coalesce("kept_sha256", "_whole")).alias("kept_sha256"))


def cut_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated bytes cut from ``text``; all rows and columns stay.

    A character is cut if all its bytes are; ``n_chars``, if there, is the new number of characters. Null texts stay null.
    """
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    row = F.struct(*[F.col(f"`{c}`") for c in others]).alias("_row")
    rows = _joined(docs, [row, F.when(F.octet_length("text") < SPAN, F.col("text")).alias("_short")], True)
    text = F.when(F.col("_copy"), "").when(F.col("_n") >= SPAN, F.col("kept").cast("string")).otherwise(F.col("_short"))
    cut = rows.select("_row", text.alias("_text"))
    pick = {"text": F.col("_text"), "n_chars": F.length("_text").cast(dict(docs.dtypes).get("n_chars", "bigint"))}
    return cut.select(*[pick.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
