"""Benchmark decontamination by latent semantic retrieval.

Passages of documents and of benchmark items are TF-IDF vectors over the items' words. A randomised
singular value decomposition, whose products with all passages are made by the executors, gives the
latent space. Windows of documents near a piece of an item there are candidates; the longest
common subsequence with the item, and its answer, decide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.llm.common import array_row, fresh, pieces, sum_arrays, tidy, utf8, without
from annualis.llm.tokens import PARTING, joined, unit_hashes
from annualis.session import stored

SEGMENT = 20  # words; a window is two segments
PASSAGE = 40
RANK, SPARE = 128, 8
NEAR = 0.4  # cosine in the latent space
LCS_SHARE = 0.8  # of an item's words in order, anywhere: a leak
PARTIAL_SHARE, CONTENT_SHARE, ANSWER_SHARE = 0.5, 0.6, 0.75  # or so much, with the answer
ANSWER = 8  # words at the end of an item
LEAST_WORDS = 5  # items with fewer words are found verbatim only
LEAST_PHRASE = 3  # and with fewer than that, as a whole text only
COMMON_ITEMS, COMMON_PASSAGES = 0.1, 0.05  # a word in more items and passages than that has no weight
ITEMS = 10_000  # items searched in one turn
BYTES = 1 << 20  # of text, or of word numbers, worked on at a time
RUN = 1 << 13  # words multiplied with the matrix at a time, so that the products stay in the cache
CELLS = 1 << 20  # cosines at a time
SIDE = 512  # groups added up side by side


@dataclass
class Items:
    """One turn's items as numbers of their distinct words, 1 up; 0 is any other word.

    ``open_end`` tells whose last word is a character that another one, put behind it, would change.
    """

    ids: list
    words: list[np.ndarray]
    vocabulary: np.ndarray
    open_end: list[bool]

    @property
    def size(self) -> int:
        return len(self.vocabulary) + 1


def number_words(texts: list[bytes], vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts, and how many words each text has."""
    data, ends = joined(texts)
    starts, hashes, _ = unit_hashes(data, PARTING)
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    if not len(vocabulary):
        return np.zeros(len(hashes), np.int32), counts
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at + 1, 0).astype(np.int32), counts


def read_items(rows) -> Items:
    texts = utf8([r["text"] for r in rows])
    data, ends = joined(texts)
    starts, hashes, alone = unit_hashes(data, PARTING)
    cuts = np.searchsorted(starts, ends)
    vocabulary = np.unique(hashes)
    numbers = (np.searchsorted(vocabulary, hashes) + 1).astype(np.int32)
    words = np.split(numbers, cuts[:-1]) if len(cuts) else []
    keep = [k for k, w in enumerate(words) if len(w)]
    return Items([rows[k]["item_id"] for k in keep], [words[k] for k in keep], vocabulary, [bool(alone[cuts[k] - 1]) for k in keep])


def _numbered(vocabulary: np.ndarray):
    """Documents to (doc_id, words): their word numbers as little-endian 32-bit integers."""
    def run(frames):
        for frame in frames:
            texts = utf8(frame["text"])
            for a, b in pieces([len(t) for t in texts], BYTES):
                numbers, counts = number_words(texts[a:b], vocabulary)
                parts = np.split(numbers, np.cumsum(counts)[:-1])
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[a:b].astype("Int64"), "words": [p.tobytes() for p in parts]})

    return run


def _flat(words) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all rows end to end, and their counts."""
    parts = [np.frombuffer(w or b"", np.int32) for w in words]
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), np.array([len(p) for p in parts], np.int64)


def _slots(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The piece of ``size`` words that each word is in, and how many pieces each row has."""
    n = -(-counts // size)
    place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(np.cumsum(n) - n, counts) + place // size, n


def _frames_of_words(frames):
    for frame in frames:
        for a, b in pieces([len(w or b"") for w in frame["words"]], BYTES):
            yield frame.iloc[a:b]


def _passages(numbers: np.ndarray, slot: np.ndarray):
    """The words in runs of whole passages, about ``RUN`` words each, so that a long text isn't a large matrix."""
    at = 0
    while at < len(numbers):
        end = len(numbers) if at + RUN >= len(numbers) else max(at + 1, int(np.searchsorted(slot, slot[at + RUN])))
        yield numbers[at:end], slot[at:end]
        at = end


def _passage_counts(size: int):
    """(term, n): in how many passages each term is; term 0: how many passages there are."""
    def run(frames):
        seen, passages = np.zeros(size, np.int64), 0
        for frame in _frames_of_words(frames):
            numbers, counts = _flat(frame["words"])
            slot, n = _slots(counts, PASSAGE)
            passages += int(n.sum())
            pairs = np.unique(slot * size + numbers)
            seen += np.bincount(pairs % size, minlength=size)
        seen[0] = passages
        some = np.flatnonzero(seen)
        yield pd.DataFrame({"term": some, "n": seen[some]})

    return run


def term_weights(items: Items, counts: np.ndarray) -> np.ndarray:
    """IDF over the documents' passages; 0 for word 0 and for words common in items and passages alike."""
    total = max(1, int(counts[0]))
    weights = np.log((total + 1) / (counts + 1.0)) + 0.1
    in_items = np.zeros(items.size)
    for words in items.words:
        in_items[np.unique(words)] += 1
    common = (in_items > max(3, COMMON_ITEMS * len(items.words))) & (counts > COMMON_PASSAGES * total)
    weights[common] = 0
    weights[0] = 0
    return weights


def tfidf(numbers: np.ndarray, slot: np.ndarray, weights: np.ndarray):
    """(passage, term, value) of normalised TF-IDF rows, by passage; passages are renumbered from 0."""
    keep = weights[numbers] > 0
    size = len(weights)
    pairs, times = np.unique(slot[keep] * size + numbers[keep], return_counts=True)
    passage, term = pairs // size, pairs % size
    value = times * weights[term]
    _, passage = np.unique(passage, return_inverse=True)
    norm = np.sqrt(np.bincount(passage, value**2))
    return passage, term, value / norm[passage]


def sum_rows(matrix: np.ndarray, of: np.ndarray, group: np.ndarray, value: np.ndarray | None = None, most: int = 64) -> np.ndarray:
    """For each group, from 0 up and in order, the sum of the rows ``of`` of ``matrix``, times ``value``.

    Groups are added up side by side: first the first row of each, then the second of those that have one. Groups of more
    than ``most`` rows are parted first.
    """
    n = int(group[-1]) + 1 if len(group) else 0
    out = np.empty((n, matrix.shape[1]), matrix.dtype)
    counts = np.bincount(group, minlength=n)
    starts = np.cumsum(counts) - counts
    if n and int(counts.max()) > most:
        place = np.arange(len(group)) - np.repeat(starts, counts)
        parts = -(-counts // most)
        first = np.cumsum(parts) - parts
        some = sum_rows(matrix, of, np.repeat(first, counts) + place // most, value, most)
        return sum_rows(some, np.arange(len(some)), np.repeat(np.arange(n), parts), None, most)
    for a in range(0, n, SIDE):
        order = np.argsort(-counts[a:a + SIDE], kind="stable")
        start, size = starts[a:a + SIDE][order], counts[a:a + SIDE][order]
        total = np.zeros((len(size), matrix.shape[1]), matrix.dtype)
        for j in range(int(size[0])):
            at = start[:int(np.searchsorted(-size, -j))] + j
            rows = matrix[of[at]]
            if value is not None:
                rows *= value[at][:, None]
            total[:len(at)] += rows
        out[a + order] = total
    return out


def gram_product(passage, term, value, matrix: np.ndarray, out: np.ndarray) -> None:
    """Add A' (A matrix) to ``out`` for the sparse rows A."""
    if not len(passage):
        return
    value = value.astype(matrix.dtype)
    rows = sum_rows(matrix, term, passage, value)
    order = np.argsort(term, kind="stable")
    terms, group = np.unique(term[order], return_inverse=True)
    out[terms] += sum_rows(rows, passage[order], group, value[order])


def _sums(weights: np.ndarray, matrix: np.ndarray):
    """One row (part, data) a task: its sum of A' (A matrix)."""
    def run(frames):
        total = np.zeros(matrix.shape)
        single = matrix.astype(np.float32)
        for frame in _frames_of_words(frames):
            numbers, counts = _flat(frame["words"])
            for part in _passages(numbers, _slots(counts, PASSAGE)[0]):
                gram_product(*tfidf(*part, weights), single, total)
        yield array_row(total)

    return run


def _total(numbered: DataFrame, weights: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Sum over all passages, of one array a task."""
    total = sum_arrays(numbered.mapInPandas(tidy(_sums(weights, matrix)), "part int, data binary"))
    return np.zeros(matrix.shape) if total is None else total.reshape(matrix.shape)


def _item_pieces(items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, piece of each word, and item of each piece; pieces are as long as a window and overlap by half."""
    words, slot, owner = [], [], []
    for k, w in enumerate(items.words):
        if len(w) < LEAST_WORDS:
            continue
        for a in range(0, max(1, len(w) - SEGMENT), SEGMENT):
            part = w[a:a + PASSAGE]
            words.append(part)
            slot.append(np.full(len(part), len(owner)))
            owner.append(k)
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(words), np.concatenate(slot), np.array(owner)


def latent_space(numbered: DataFrame, items: Items, weights: np.ndarray, passages: int) -> np.ndarray:
    """Right singular vectors (terms x rank) of the documents' passages and the items' pieces.

    Both sides weigh the same in sum: the items' own words are too rare among all passages to be seen else. One
    product G R of the Gram matrix with a random one gives them: G is near G R (R' G R)^-1 (G R)'.
    """
    words, slot, owner = _item_pieces(items)
    own = tfidf(words, slot, weights)
    n_own = max(1, int(own[0].max(initial=-1)) + 1)
    columns = min(RANK + SPARE, len(weights))
    matrix = np.random.default_rng(7).standard_normal((len(weights), columns))
    if not len(owner):
        return np.zeros_like(matrix)
    extra = np.zeros_like(matrix)
    gram_product(*own, matrix, extra)
    product = _total(numbered, weights, matrix) / max(1, passages) + extra / n_own
    core = matrix.T @ product
    size, turn = np.linalg.eigh((core + core.T) / 2)
    keep = size > 1e-6 * max(float(size.max()), 1e-300)
    left, strength, _ = np.linalg.svd(product @ (turn[:, keep] / np.sqrt(size[keep])), full_matrices=False)
    return left[:, strength > 1e-6 * strength.max(initial=0.0)][:, :RANK]


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.where(norm > 1e-12, rows / np.maximum(norm, 1e-12), 0)


def common_subsequence(item, region) -> int:
    """Length of the longest common subsequence, by one addition of long integers a word."""
    masks: dict[int, int] = {}
    for k, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << k
    full = state = (1 << len(item)) - 1
    for w in region:
        mask = masks.get(w)
        if mask:
            hit = state & mask
            state = ((state + hit) | (state - hit)) & full
    return len(item) - state.bit_count()


@dataclass
class Target:
    """An item's words, those with weight, and its answer, and how many of each a leak needs."""

    words: list[int]
    content: list[int]
    answer: list[int]

    @classmethod
    def of(cls, item: np.ndarray, heavy: np.ndarray) -> Target:
        return cls(item.tolist(), item[heavy[item]].tolist(), item[-ANSWER:].tolist())

    def leaks(self, count) -> bool:
        """Whether ``count``, of words found of a list, makes a leak."""
        share = count(self.words) / len(self.words)
        return share >= LCS_SHARE or share >= PARTIAL_SHARE and bool(self.content) and (
            count(self.content) >= CONTENT_SHARE * len(self.content) and count(self.answer) >= ANSWER_SHARE * len(self.answer))

    def share_in(self, region: np.ndarray) -> float:
        """Share of the item's words found in order in a document's words, or 0 if that is no leak.

        Words found in any order bound those found in order, and most candidates fail by them.
        """
        around = region[region > 0].tolist()
        there = set(around)
        if not self.leaks(lambda words: sum(w in there for w in words)):
            return 0.0
        if not self.leaks(lambda words: common_subsequence(words, around)):
            return 0.0
        return common_subsequence(self.words, around) / len(self.words)


def phrases(items: Items):
    """A function of (numbers, counts of each row) that gives (row, item) for items of under ``SEGMENT`` words there, word for word.

    Items of under ``LEAST_PHRASE`` words must be all of a row. Candidates have an item's first two words in place; their
    next words are compared by a hash and then one by one.
    """
    whole: dict[bytes, list[int]] = {}
    by_length: dict[int, dict[int, list[int]]] = {}
    first, second = np.zeros(items.size, bool), np.zeros(items.size, bool)
    spread = np.random.default_rng(11).integers(1, 1 << 63, items.size, dtype=np.uint64)

    def digest(words: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        out = np.zeros(len(at), np.uint64)
        for j in range(length):
            out = out * np.uint64(0x9E3779B97F4A7C15) + spread[words[at + j]]
        return out

    parts = {}
    for k, w in enumerate(items.words):
        if len(w) < LEAST_PHRASE:
            whole.setdefault(w.tobytes(), []).append(k)
        elif len(w) < SEGMENT:
            # The character before the last one tells the last one too.
            part = parts[k] = w[:-1] if items.open_end[k] else w
            first[part[0]] = second[part[1]] = True
            by_length.setdefault(len(part), {}).setdefault(int(digest(part, np.zeros(1, np.int64), len(part))[0]), []).append(k)
    known = {length: np.array(sorted(table), np.uint64) for length, table in by_length.items()}
    longest_whole = max((len(w) // 4 for w in whole), default=0)

    def find(numbers: np.ndarray, counts: np.ndarray) -> set[tuple[int, int]]:
        found = set()
        ends = np.cumsum(counts)
        if whole:
            for r in np.flatnonzero((counts > 0) & (counts <= longest_whole)):
                found.update((int(r), k) for k in whole.get(numbers[ends[r] - counts[r]:ends[r]].tobytes(), ()))
        if not by_length or len(numbers) < 2:
            return found
        at = np.flatnonzero(first[numbers[:-1]] & second[numbers[1:]])
        row = np.searchsorted(ends, at, side="right")
        left = ends[row] - at
        for length, table in by_length.items():
            there = at[left >= length]
            hashes = digest(numbers, there, length)
            for i in np.flatnonzero(np.isin(hashes, known[length])):
                place = int(there[i])
                for k in table[int(hashes[i])]:
                    if np.array_equal(numbers[place:place + length], parts[k]):
                        found.add((int(np.searchsorted(ends, place, side="right")), k))
        return found

    return find


def _enough_words(items: Items):
    """A function that tells which pairs (window, item) have half of the item's words around the window, in any order."""
    distinct = [np.unique(w) for w in items.words]
    flat = np.concatenate(distinct)
    sizes = np.array([len(d) for d in distinct])
    starts = np.cumsum(sizes) - sizes
    words = np.array([len(w) for w in items.words])

    def test(numbers: np.ndarray, low: np.ndarray, high: np.ndarray, window: np.ndarray, item: np.ndarray) -> np.ndarray:
        used, window = np.unique(window, return_inverse=True)
        low, reach = low[used], high[used] - low[used]
        there = np.zeros((len(used), items.size), bool)
        at = np.arange(int(reach.sum())) + np.repeat(low - (np.cumsum(reach) - reach), reach)
        there[np.repeat(np.arange(len(used)), reach), numbers[at]] = True
        out = np.zeros(len(item), bool)
        for a in range(0, len(item), RUN):
            k, w = item[a:a + RUN], window[a:a + RUN]
            n = sizes[k]
            head = np.cumsum(n) - n
            at = np.arange(int(n.sum())) + np.repeat(starts[k] - head, n)
            shared = np.add.reduceat(there[np.repeat(w, n), flat[at]].astype(np.int32), head)
            # Each word missing is missing once at least.
            out[a:a + RUN] = words[k] - n + shared >= PARTIAL_SHARE * words[k]
        return out

    return test


def _search(items: Items, weights: np.ndarray, space: np.ndarray):
    words, slot, owner = _item_pieces(items)
    vectors = (space * weights[:, None]).astype(np.float32)
    targets = _unit(sum_rows(vectors, words, slot)) if len(owner) else np.zeros((0, space.shape[1]), np.float32)
    heavy = weights > 0
    items_of = [Target.of(w, heavy) for w in items.words]
    longest = max(len(w) for w in items.words)
    enough, verbatim = _enough_words(items), phrases(items)

    def near_windows(numbers, counts, found):
        slot, n = _slots(counts, SEGMENT)
        windows = np.zeros((int(n.sum()), vectors.shape[1]), np.float32)
        at = np.flatnonzero(heavy[numbers])
        some, group = np.unique(slot[at], return_inverse=True)
        windows[some] = sum_rows(vectors, numbers[at], group)
        row = np.repeat(np.arange(len(n)), n)
        if len(windows) > 1:
            windows[:-1] += windows[1:] * (row[1:] == row[:-1])[:, None]
        windows /= np.maximum(np.sqrt(np.einsum("ij,ij->i", windows, windows)), 1e-12)[:, None]
        begin = (np.cumsum(counts) - counts)[row]
        place = (np.arange(len(windows)) - (np.cumsum(n) - n)[row]) * SEGMENT
        end = counts[row]
        low, high = begin + np.maximum(0, place - longest), begin + np.minimum(end, place + PASSAGE + longest)
        step = max(16, CELLS // max(len(targets), items.size))
        for a in range(0, len(windows), step):
            cosine = windows[a:a + step] @ targets.T
            at, piece = np.nonzero(cosine >= NEAR)
            if not len(at):
                continue
            keep = enough(numbers, low[a:a + step], high[a:a + step], at, owner[piece])
            for w, p in zip(at[keep].tolist(), piece[keep].tolist()):
                k, r, near = int(owner[p]), int(row[a + w]), float(cosine[w, p])
                known = found.get((r, k))
                if known and known[2] == 1.0:
                    continue
                reach, at_word = len(items_of[k].words), int(place[a + w])
                left, right = max(0, at_word - reach), min(int(end[a + w]), at_word + PASSAGE + reach)
                share = items_of[k].share_in(numbers[begin[a + w] + left:begin[a + w] + right])
                if share and (not known or (share, near) > (known[2], known[1])):
                    found[r, k] = [items.ids[k], near, share]

    def run(frames):
        for frame in _frames_of_words(frames):
            numbers, counts = _flat(frame["words"])
            found: dict[tuple[int, int], list] = {}
            for r, k in verbatim(numbers, counts):
                found[r, k] = [items.ids[k], 1.0, 1.0]
            if len(targets):
                near_windows(numbers, counts, found)
            ids = frame["doc_id"].tolist()
            yield pd.DataFrame([(ids[r], *v) for (r, _), v in sorted(found.items())], columns=["doc_id", "item_id", "cosine", "share"]).astype(
                {"doc_id": "Int64", "item_id": "Int64"})

    return run


LEAKS = "doc_id long, item_id long, cosine double, share double"


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, share) for each document row that holds a benchmark item.

    ``share`` is the part of the item's words found in order near the window, ``cosine`` the window's best. In scripts
    without spaces each character, with the next one, counts as a word. Items of under 20 words are also looked for word for
    word, whatever the window's cosine, and then have 1.0 in both; those under ``LEAST_WORDS`` words are found in no other
    way, and those under ``LEAST_PHRASE`` only where they are the whole text. Items are searched in turns of about ``ITEMS``,
    so what is sent to the tasks is bounded. Null or empty texts and items without words hold nothing. Repeated rows each give their rows; a null doc_id stays null.
    """
    items = benchmark.select("item_id", "text").filter("text is not null")
    turns = max(1, -(-items.count() // ITEMS))
    out = docs.sparkSession.createDataFrame([], LEAKS)
    for turn in range(turns):
        # Equal texts are one item, the smallest id; a turn's rows are bounded by the number of turns.
        rows = (items.filter(F.pmod(F.xxhash64("text"), F.lit(turns)) == turn).groupBy("text").agg(F.min("item_id").alias("item_id"))
                .orderBy("item_id", "text").collect())
        own = read_items(rows)
        if not own.words:
            continue
        numbered = stored(docs.select("doc_id", "text").mapInPandas(tidy(_numbered(own.vocabulary)), "doc_id long, words binary"), "numbered")
        counts = np.zeros(own.size, np.int64)
        for r in numbered.mapInPandas(_passage_counts(own.size), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
            counts[r["term"]] = r["n"]
        weights = term_weights(own, counts)
        space = latent_space(numbered, own, weights, int(counts[0]))
        out = out.unionAll(numbered.mapInPandas(tidy(_search(own, weights, space)), LEAKS))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose text holds no benchmark item, with their columns; the text of a row decides, whatever its doc_id."""
    key = fresh(docs, "text_key")
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text").filter("text is not null")
    leaking = stored(find_leaks(texts, benchmark).select("doc_id").distinct(), "leaking")
    kept = without(docs.withColumn(key, F.when(F.col("text").isNotNull(), F.xxhash64("text"))), key, leaking)
    return kept.drop(key)
