"""A hierarchical Pitman-Yor language model of words given the word before.

Each context, told by the 64-bit hash of the word before, has its own restaurant. Their parent is the restaurant
of single words, whose base is uniform over the known words and one unknown. A customer is a use of a word; a table of a context's restaurant is a
customer of the parent. Tables are sampled by Gibbs sweeps: in each, the customers of every dish of a restaurant
leave and sit down again given all other tables. Predictive probabilities are averaged over the last sweeps.

Words are dealt to parts by their hash, words of more than 1 in 4,096 uses by word and context. A part holds all uses of
its words, so it samples their tables and scores them. It numbers the contexts it has; after each sweep it sends their
tables to the contexts' buckets and gets back those of all parts. Only sums for the root and its hot words go through
the driver. A task that runs again draws the same numbers.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.llm.common import array_row, pieces, stored_once, sum_arrays, tidy, utf8
from annualis.llm.tokens import WHITE, joined, word_hashes
from annualis.llm.toxicity import held_out_fold

RESTAURANTS = 1 << 16  # restaurants of a part that 16 bits tell apart; its types keep their upper bits by the contexts
STRENGTH, ROOT_STRENGTH = 1.0, 1.0
SWEEPS, BURN_IN = 4, 2
SINGLY = 16  # customers of a dish that sit down one by one; later ones in groups of a sixteenth of those seated
HOT_SHARE, SEEN_SHARE = 4_096, 8_192
PART_TOKENS = 1_100_000
BYTES = 2 << 20
ALONE = 512  # bytes beyond which a plane of bytes is packed by codes of its own
FINE = 1e7  # scores are summed over parts as whole multiples of 1 / FINE, so their order doesn't matter
MANY_BUCKETS, PARTS_A_BUCKET = 512, 4  # contexts meet in as many buckets as there are parts; beyond 512, in one for four parts
BUCKET, LOW = 12, (1 << 12) - 1  # documents are gathered by row number without its last bits
END, START = np.uint64(1), np.uint64(2)
STIR = np.uint64(0x9E3779B97F4A7C15)


def _squeeze(*arrays: np.ndarray) -> bytes:
    """The arrays in one, by the first bytes of all numbers, then the second and so on.

    Hashes (unsigned, 64 bits) are kept as steps from one to the next: in ascending order these have fewer bits the more hashes there are.
    """
    arrays = [np.diff(a, prepend=np.uint64(0)) if a.dtype == np.uint64 else a for a in arrays]
    head = np.array([len(a) for a in arrays], np.int64).tobytes()
    planes = [p.tobytes() for a in arrays for p in np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T]
    packer = zstandard.ZstdCompressor(level=1).compressobj(size=len(head) + sum(map(len, planes)))
    out = [packer.compress(head)]
    for plane in planes:  # one with few different bytes should not share its codes with a random one
        out += (packer.compress(plane), packer.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK)) if len(plane) > ALONE else (packer.compress(plane),)
    return b"".join([*out, packer.flush()])


def _expand(data: bytes, *kinds) -> list[np.ndarray]:
    raw, out = zstandard.ZstdDecompressor().decompress(data), []
    sizes, at = np.frombuffer(raw, np.int64, len(kinds)), 8 * len(kinds)
    for size, kind in zip(sizes, kinds):
        wide = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, int(size) * wide, at).reshape(wide, int(size))
        own = np.ascontiguousarray(planes.T).view(kind).reshape(int(size))
        out.append(np.cumsum(own, dtype=kind) if own.dtype == np.uint64 else own)
        at += int(size) * wide
    return out


def stirred(words: np.ndarray) -> np.ndarray:
    """Hashes of contexts, by those of the words before; different words have different ones."""
    mixed = words * STIR
    mixed ^= mixed >> np.uint64(29)
    return mixed * STIR


def token_stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token, and tokens of each text; a text ends with one END."""
    data, ends = joined(texts)
    starts, hashes = word_hashes(data, WHITE)
    counts = np.diff(np.searchsorted(starts, ends), prepend=0) + 1
    tokens = np.empty(int(counts.sum()), np.uint64)
    tokens[np.arange(len(hashes)) + np.repeat(np.arange(len(texts)), counts - 1)] = hashes
    last = np.cumsum(counts) - 1
    tokens[last] = END
    return tokens, counts


def _batches(frame: pd.DataFrame):
    """Rows with up to ``BYTES`` characters of text, which are encoded when their turn comes."""
    sizes = [len(t) if isinstance(t, str) else 0 for t in frame["text"]]
    for a, b in pieces(sizes, BYTES):
        part = frame.iloc[a:b]
        yield part, utf8(part["text"])


def _frequent(frames):
    """(word, n): how many tokens there are (word 0), and words with a large share of a batch."""
    for frame in frames:
        for _, texts in _batches(frame):
            words, n = np.unique(token_stream(texts)[0], return_counts=True)
            some = n * SEEN_SHARE >= n.sum()
            yield pd.DataFrame({"word": np.concatenate([[0], words[some].view(np.int64)]), "n": np.concatenate([[n.sum()], n[some]])})


def part_of(words: np.ndarray, contexts: np.ndarray, hot: np.ndarray, parts: int) -> np.ndarray:
    """The part of each token: by its word, for hot words by word and context."""
    mixed = words * STIR
    if len(hot):
        at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
        mixed = np.where(hot[at] == words, (mixed ^ contexts) * STIR, mixed)
    return ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def bucket_of(contexts: np.ndarray, buckets: int) -> np.ndarray:
    return ((contexts * STIR >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


ROWS = "part long, bucket long, kind string, step int, contexts binary, types binary, uses binary"
NAMES = [c.split()[0] for c in ROWS.split(", ")]


def _deal(hot: np.ndarray, parts: int):
    """Documents to rows of tokens by part, and to rows of document facts."""
    def run(frames):
        for frame in frames:
            for batch, texts in _batches(frame):
                tokens, counts = token_stream(texts)
                names, word = np.unique(tokens, return_inverse=True)
                word = word.astype(np.int32)
                befores = np.concatenate([names, [START]]).astype(np.uint64)
                contexts = stirred(befores)
                before = np.concatenate([[0], word[:-1]]).astype(np.int32)
                before[np.cumsum(counts) - counts] = len(names)
                base = int(batch["row"].iloc[0])
                rows = base + np.arange(len(texts))  # rows are numbered upwards, so no other batch has these
                trains = ~batch["held_out"].to_numpy(bool)
                doc = np.repeat(np.arange(len(texts)), counts)
                part = part_of(tokens, contexts[before], hot, parts)
                order = np.argsort(part << 32 | word, kind="stable")
                word, before, part = word[order], before[order], part[order]
                marked = (2 * doc + trains[doc])[order].astype(np.uint32)
                # Uses of a word one after the other, with the same word before and in one document, are one entry.
                entry = np.flatnonzero((np.diff(word, prepend=-1) != 0) | (np.diff(before, prepend=-1) != 0) | (np.diff(marked.astype(np.int64), prepend=-1) != 0))
                times = np.diff(entry, append=len(word)).astype(np.uint32)
                word, before, part, marked = word[entry], before[entry], part[entry], marked[entry]
                cuts = np.flatnonzero(np.diff(part, prepend=-1))
                out = []
                for a, b in zip(cuts, [*cuts[1:], len(part)]):
                    head = np.flatnonzero(np.diff(word[a:b], prepend=-1))
                    some, room = np.unique(before[a:b], return_inverse=True)
                    out.append((int(part[a]), base, "tokens", 0, _squeeze(befores[some]), None, _squeeze(
                        names[word[a:b][head]], np.diff(head, append=b - a).astype(np.uint32), room.astype(np.uint32), marked[a:b], times[a:b])))
                ids = batch["doc_id"].astype("Int64")
                bucket = rows >> BUCKET
                for k in np.unique(bucket):
                    own = bucket == k
                    out.append((-1 - int(k) % parts, int(k), "docs", 0, None, None, _squeeze(
                        rows[own], ids.fillna(0).to_numpy(np.int64)[own], ids.isna().to_numpy()[own], ~trains[own], counts[own].astype(np.int64))))
                yield pd.DataFrame(out, columns=NAMES)

    return run


TOKENS = (np.uint64, np.uint32, np.uint32, np.uint32, np.uint32)
TYPES = (np.uint64, np.uint32, np.uint16, np.uint32)
WHOLE = (np.int64, np.uint16)  # a part's contexts in each bucket, and the upper bits of its types' rooms
USES = (np.uint32, np.int64, np.uint32, np.uint32)  # entries of each type, rows of documents, those of the entries, uses in each


def _sent(part: int, step: int, whole: bytes, buckets: int, tables: np.ndarray, *first: np.ndarray) -> list[tuple]:
    """Rows that take the tables of a part's contexts to their buckets; ``first`` are what the buckets know of them only once."""
    sizes, _ = _expand(whole, *WHOLE)
    ends = np.cumsum(sizes)
    return [(part, k, "sent", step, _squeeze(*[v[b - n:b] for v in first]) if first else None, _squeeze(tables[b - n:b].astype(np.uint32)), None)
            for k, (n, b) in enumerate(zip(sizes.tolist(), ends.tolist())) if n]


def _unique(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct numbers of all arrays, where each number is among them, and where each array begins."""
    sizes = np.array([len(a) for a in arrays])
    return *np.unique(np.concatenate(arrays), return_inverse=True), np.cumsum(sizes) - sizes


def _documents(bases, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct row numbers, upwards, and where that of each use is; a piece's rows are all those of its base on."""
    rows, at, total = [], [None] * len(docs), 0
    for k in np.argsort(bases):
        there = np.bincount(docs[k]) > 0
        at[k] = (np.cumsum(there) - 1 + total)[docs[k]]
        rows.append(bases[k] + np.flatnonzero(there))
        total += len(rows[-1])
    return np.concatenate(rows), np.concatenate(at)


def _gather(hot: np.ndarray, buckets: int):
    """One part's tokens to its types (word, restaurant, customers), their uses by document, and its first sums."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        if frame["kind"].iloc[0] == "docs":
            return pd.DataFrame({c: frame[c].tolist() for c in frame.columns})
        part = int(frame["part"].iloc[0])
        fields = [_expand(d, *TOKENS) for d in frame["uses"]]
        contexts, at, begin = _unique([stirred(_expand(d, np.uint64)[0]) for d in frame["contexts"]])
        bucket = bucket_of(contexts, buckets)
        order = np.argsort(bucket, kind="stable")
        number = np.empty(len(order), np.uint64)
        number[order] = np.arange(len(order), dtype=np.uint64)
        rooms = number[at[np.concatenate([b + f[2] for b, f in zip(begin, fields)])]]
        known, at, _ = _unique([f[0] for f in fields])
        word = np.repeat(at.astype(np.uint32), np.concatenate([f[1] for f in fields]))
        times = np.concatenate([f[4] for f in fields])
        trains = np.concatenate([f[3] & 1 for f in fields]) * times
        documents, docs = _documents(frame["bucket"].to_numpy(), [f[3] >> 1 for f in fields])
        del fields, begin
        key = word.astype(np.uint64) << np.uint64(32) | rooms
        by = np.argsort(key, kind="stable").astype(np.uint32)
        key = key[by]
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        del key
        customers = np.add.reduceat(trains[by].astype(np.int64), head)
        rooms = rooms[by[head]]
        types = _squeeze(known, np.bincount(word[by[head]], minlength=len(known)).astype(np.uint32),
                         (rooms % RESTAURANTS).astype(np.uint16), customers.astype(np.uint32))
        uses = _squeeze(np.diff(head, append=len(by)).astype(np.uint32), documents, docs[by].astype(np.uint32), times[by])
        whole = _squeeze(np.bincount(bucket, minlength=buckets), (rooms // RESTAURANTS).astype(np.uint16))
        cells = Cells(types, Plan(hot, np.zeros(len(hot)), np.zeros(len(contexts)), 0, 0, 0, 0), part, whole)
        seated = np.bincount(cells.rooms, cells.customers, len(contexts)).astype(np.uint32)
        out = [(part, -1, "cells", 0, whole, types, uses), (part, -1, "state", 0, None, cells.seating(), None),
               (part, -1, "totals", 0, None, array_row(cells.counts())["data"].iloc[0], None),
               *_sent(part, 0, whole, buckets, cells.room_tables(), contexts[order], seated)]
        return pd.DataFrame(out, columns=NAMES)

    return run


def _index(frame: pd.DataFrame) -> pd.DataFrame:
    """One bucket's first rows to the number of each part's contexts among its own, and the customers of all parts, back to each."""
    sent = [_expand(d, np.uint64, np.uint32) for d in frame["contexts"]]
    contexts, at, begin = _unique([s[0] for s in sent])
    seated = np.bincount(at, np.concatenate([s[1] for s in sent]), len(contexts)).astype(np.int64)[at]
    out = []
    for part, bucket, a, b in zip(frame["part"], frame["bucket"], begin, [*begin[1:], len(at)]):
        out.append((part, bucket, "index", 0, None, None, _squeeze(at[a:b].astype(np.uint32))))
        out.append((part, bucket, "seated", 0, None, _squeeze(seated[a:b]), None))
    return pd.DataFrame(out, columns=NAMES)


def _meet(frame: pd.DataFrame) -> pd.DataFrame:
    """The parts' tables of one bucket's contexts, summed over the parts, back to each of them."""
    rows = frame.sort_values("part")
    index, sent = rows[rows["kind"] == "index"], rows[rows["kind"] == "sent"]
    at = [_expand(d, np.uint32)[0] for d in index["uses"]]
    sums = np.bincount(np.concatenate(at), np.concatenate([_expand(d, np.uint32)[0] for d in sent["types"]])).astype(np.int64)
    return pd.DataFrame([(part, bucket, "met", step, None, _squeeze(sums[k]), None)
                         for part, bucket, step, k in zip(sent["part"], sent["bucket"], sent["step"], at)], columns=NAMES)


@dataclass
class State:
    """What is known after a sweep: tables of each restaurant of a part (none in the driver), customers and tables of the root, tables of hot words."""

    tables: np.ndarray | None
    customers: float
    root_tables: float
    hot_customers: np.ndarray
    hot_tables: np.ndarray


@dataclass
class Plan:
    """The corpus counts and the states so far."""

    hot: np.ndarray
    hot_uses: np.ndarray
    seated: np.ndarray | None  # customers of each restaurant of a part; none in the driver
    tokens: int
    words: int
    discount: float
    root_discount: float
    states: list[State] = field(default_factory=list)


def sit_down(customers: np.ndarray, weight, discount: float, tables_before: np.ndarray, rng) -> np.ndarray:
    """Tables of each dish after its customers have sat down; ``weight(k, tables)`` is that of a new table of dishes ``k``.

    With n customers at t tables the next one opens a table with odds weight : n - discount * t. The
    ``tables_before`` only seed the shape. Beyond ``SINGLY`` customers sit down in small groups with one probability.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    active, n = np.flatnonzero(customers > 1), 1
    while len(active):
        group = 1 if n < SINGLY else n // SINGLY
        come = np.minimum(group, customers[active] - n)
        new = weight(active, tables[active])
        chance = new / (new + n - discount * tables[active])
        tables[active] += rng.binomial(come, np.clip(chance, 0, 1)) if group > 1 else rng.random(len(active)) < chance
        n += group
        active = active[customers[active] > n]
    return tables


class Cells:
    """One part's words and types, followed through the sweeps."""

    def __init__(self, types: bytes, plan: Plan, part: int, whole: bytes | None = None):
        self.words, sizes, self.rooms, customers = _expand(types, *TYPES)
        if whole is not None:
            _, upper = _expand(whole, *WHOLE)
            self.rooms = self.rooms + RESTAURANTS * upper.astype(np.int64)
        self.customers, self.plan, self.part, sizes = customers.astype(np.int64), plan, part, sizes.astype(np.int64)
        self.word = np.repeat(np.arange(len(self.words)), sizes)
        self.first = np.cumsum(sizes) - sizes
        self.uses = np.add.reduceat(self.customers, self.first) if len(self.words) else np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(plan.hot, self.words), max(0, len(plan.hot) - 1))
        self.is_hot = plan.hot[at] == self.words if len(plan.hot) else np.zeros(len(self.words), bool)
        self.hot_at = at[self.is_hot]
        self.tables = np.minimum(self.customers, 1)
        self._count()
        self.root_tables = np.minimum(self.root_customers, 1)

    def _count(self) -> None:
        self.own = np.add.reduceat(self.tables, self.first) if len(self.words) else np.zeros(0, np.int64)
        self.root_customers = self.own.copy()

    def seating(self) -> bytes:
        """The tables, to go on from in another task."""
        return _squeeze(self.tables.astype(np.uint32), self.root_tables.astype(np.uint32))

    def seat(self, seating: bytes) -> None:
        self.tables, self.root_tables = (a.astype(np.int64) for a in _expand(seating, np.uint32, np.uint32))
        self._count()

    def room_tables(self) -> np.ndarray:
        return np.bincount(self.rooms, self.tables, len(self.plan.seated))

    def counts(self) -> np.ndarray:
        """Tokens, types used, words, types of one and two uses, words in one and two contexts; hot words' uses and contexts."""
        calm, uses, contexts = ~self.is_hot, np.zeros(len(self.plan.hot)), np.zeros(len(self.plan.hot))
        np.add.at(uses, self.hot_at, self.uses[self.is_hot])
        np.add.at(contexts, self.hot_at, self.own[self.is_hot])
        facts = [self.customers.sum(), self.tables.sum(), (self.uses[calm] > 0).sum(), (self.customers == 1).sum(), (self.customers == 2).sum(),
                 (self.own[calm] == 1).sum(), (self.own[calm] == 2).sum()]
        return np.concatenate([np.array(facts, float), uses, contexts])

    def parent(self, state: State) -> np.ndarray:
        """Probability of each word in the root restaurant, over all but its tables' share: (customers, rest)."""
        p = self.plan
        self.root_customers[self.is_hot] = state.hot_customers[self.hot_at]
        self.root_tables[self.is_hot] = state.hot_tables[self.hot_at]
        new = (ROOT_STRENGTH + p.root_discount * state.root_tables) / (p.words + 1)
        return (self.root_customers - p.root_discount * self.root_tables + new) / (ROOT_STRENGTH + state.customers)

    def sweep(self, k: int) -> None:
        """All customers sit down again, given the state before sweep ``k``; then the tables' customers of the root."""
        p, state = self.plan, self.plan.states[k]
        rng = np.random.default_rng([k, self.part])
        above, old = self.parent(state)[self.word], self.tables
        others = state.tables[self.rooms] - old
        step = 1 / (ROOT_STRENGTH + state.customers)

        def weight(types, tables):
            more = np.maximum(above[types] + (tables - old[types]) * step, step * 1e-3)
            return (STRENGTH + p.discount * (others[types] + tables)) * more

        self.tables = sit_down(self.customers, weight, p.discount, old, rng)
        self._count()
        base = 1 / (p.words + 1)
        rest = state.root_tables - self.root_tables
        self.root_tables = sit_down(self.root_customers, lambda w, t: (ROOT_STRENGTH + p.root_discount * (rest[w] + t)) * base,
                                    p.root_discount, self.root_tables, rng)

    def totals(self) -> np.ndarray:
        """Tables of each restaurant; root customers and tables of words that aren't hot; hot words' customers here."""
        calm = ~self.is_hot
        hot = np.zeros(len(self.plan.hot))
        np.add.at(hot, self.hot_at, self.own[self.is_hot])
        return np.concatenate([self.room_tables(), [self.own[calm].sum(), self.root_tables[calm].sum()], hot])

    def probabilities(self, state: State) -> np.ndarray:
        """Predictive probability of each type's word in its restaurant."""
        p = self.plan
        above = self.parent(state)[self.word]
        new = STRENGTH + p.discount * state.tables[self.rooms]
        return (self.customers - p.discount * self.tables + new * above) / (STRENGTH + p.seated[self.rooms])


def _part(frame: pd.DataFrame, plan: Plan) -> tuple[Cells, dict[int, bytes], pd.Series]:
    """One part's cells with the sums of its restaurants over all parts in its plan, seatings by step, and the row of cells.

    States whose sums are not among the rows, and customers where they are not, have none.
    """
    kinds = dict(list(frame.sort_values("bucket").groupby("kind")))
    own = kinds["cells"].iloc[0]
    whole = lambda rows: np.concatenate([_expand(d, np.int64)[0] for d in rows["types"]]).astype(float)
    seatings = {int(k): d for k, d in zip(kinds["state"]["step"], kinds["state"]["types"])}
    met = {int(k): whole(rows) for k, rows in kinds["met"].groupby("step")}
    seated = whole(kinds["seated"]) if "seated" in kinds else np.zeros(len(next(iter(met.values()))))
    here = replace(plan, seated=seated, states=[replace(s, tables=met.get(k)) for k, s in enumerate(plan.states)])
    return Cells(own["types"], here, int(own["part"]), own["contexts"]), seatings, own


def _swept(plan: Plan, buckets: int):
    """A part's seating after one more sweep, its totals, and the tables of its restaurants for the other parts."""
    k = len(plan.states) - 1

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        cells, seatings, own = _part(frame, plan)
        cells.seat(seatings[k])
        cells.sweep(k)
        out = [(cells.part, -1, "state", k + 1, None, cells.seating(), None),
               (cells.part, -1, "totals", k + 1, None, array_row(cells.totals()[len(cells.plan.seated):])["data"].iloc[0], None),
               *_sent(cells.part, k + 1, own["contexts"], buckets, cells.room_tables())]
        return pd.DataFrame(out, columns=NAMES)

    return run


def _totals(rows: DataFrame) -> np.ndarray | None:
    return sum_arrays(rows.filter("kind = 'totals'").select(F.col("part").cast("int").alias("part"), F.col("types").alias("data")))


def _exchanged(rows: DataFrame, index: DataFrame) -> DataFrame:
    """The tables of each part's restaurants over all parts."""
    sent = rows.filter("kind = 'sent'").withColumn("contexts", F.lit(None).cast("binary"))
    return stored_once(sent.unionAll(index).groupBy("bucket").applyInPandas(tidy(_meet), ROWS), "met")


def make_plan(total: np.ndarray | None, hot: np.ndarray) -> Plan:
    """Corpus counts, and the state with one table for each type, of the parts' added ``Cells.counts``."""
    if total is None:
        total = np.zeros(7 + 2 * len(hot))
    (tokens, tables, words, one, two, few, pair), rest = total[:7], total[7:]
    uses, contexts = rest[: len(hot)], rest[len(hot):]
    share = lambda a, b: float(np.clip(a / (a + 2 * b), 0.1, 0.95)) if a + b else 0.5
    words = int(words + (uses > 0).sum())
    plan = Plan(hot, uses, None, int(tokens), words, share(one, two), share(few, pair))
    plan.states.append(State(None, float(tables), float(words), contexts, np.minimum(contexts, 1)))
    return plan


def next_state(moved: DataFrame, plan: Plan) -> State:
    """The state after one more sweep of all parts; the hot words sit down at the root here, as parts share them."""
    total = _totals(moved)
    last, p = plan.states[-1], plan
    (customers, root), hot = total[:2], total[2:]
    rest = last.root_tables - last.hot_tables
    hot_tables = sit_down(hot.astype(np.int64), lambda w, t: (ROOT_STRENGTH + p.root_discount * (rest[w] + t)) / (p.words + 1),
                          p.root_discount, last.hot_tables, np.random.default_rng([len(p.states), 1 << 40]))
    return State(None, float(customers + hot.sum()), float(root + hot_tables.sum()), hot, hot_tables.astype(float))


def _score(plan: Plan):
    """A part's sums by document: known tokens, base score, and score by probabilities averaged over the seatings it is given."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        cells, seatings, own = _part(frame, plan)
        chance = np.zeros(len(cells.rooms))
        for k in sorted(seatings):
            cells.seat(seatings[k])
            chance += cells.probabilities(cells.plan.states[k])
        counts = cells.uses.copy().astype(np.float64)
        counts[cells.is_hot] = plan.hot_uses[cells.hot_at]
        base = np.log10((counts + 0.5) / (plan.tokens + 0.5 * (plan.words + 1)))[cells.word]
        score, known = np.log10(chance / len(seatings)), (counts > 0)[cells.word]
        entries, rows, doc, times = _expand(own["uses"], *USES)
        sums = [np.rint(np.bincount(doc, np.repeat(x, entries) * times, len(rows))).astype(np.int64) for x in (known, -base * FINE, -score * FINE)]
        bucket = rows >> BUCKET
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        return pd.DataFrame([(cells.part, int(bucket[a]), "sums", 0, None, None, _squeeze((rows[a:b] & LOW).astype(np.uint16), *[s[a:b] for s in sums]))
                             for a, b in zip(cuts, [*cuts[1:], len(rows)])], columns=NAMES)

    return run


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _add_documents(frame: pd.DataFrame) -> pd.DataFrame:
    facts = [_expand(d, np.int64, np.int64, bool, bool, np.int64) for d in frame.loc[frame["kind"] == "docs", "uses"]]
    rows, ids, nulls, held, tokens = (np.concatenate(f) for f in zip(*facts))
    order = np.argsort(rows)
    sums = np.zeros((3, len(rows)), np.int64)
    for data in frame.loc[frame["kind"] == "sums", "uses"]:
        own, *parts = _expand(data, np.uint16, np.int64, np.int64, np.int64)
        own = own.astype(np.int64) + (int(frame["bucket"].iloc[0]) << BUCKET)
        at = order[np.searchsorted(rows, own, sorter=order)]
        for total, part in zip(sums, parts):
            total[at] += part
    return pd.DataFrame({"doc_id": pd.Series(ids, dtype="Int64").mask(nulls), "held_out": held, "n_tokens": tokens,
                         "n_known": sums[0], "base_score": -sums[1] / FINE, "score": -sums[2] / FINE})


def score_documents(docs: DataFrame, fold: int = 1, sweeps: int = SWEEPS, burn_in: int = BURN_IN) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (both log10) of every document row.

    Learns from documents that aren't held out (see ``held_out_fold``). Tokens are stretches without white space,
    A-Z lower-cased, and one end. Null and empty texts are an end alone; repeated rows count each; a
    null doc_id is kept. ``docs`` should be a stored table: its rows are numbered where they are read.
    """
    text = docs.select("doc_id", "text", held_out_fold(F.col("doc_id"), fold).alias("held_out"), F.monotonically_increasing_id().alias("row"))
    seen = text.select("text").mapInPandas(tidy(_frequent), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    total = seen.filter("word = 0").first()
    total = int(total["n"]) if total else 0
    frequent = seen.filter((F.col("word") != 0) & (F.col("n") * HOT_SHARE >= total)).collect()
    hot = np.sort(np.array([r["word"] for r in frequent], np.int64).view(np.uint64))
    parts = max(1, -(-total // PART_TOKENS))
    buckets = max(min(parts, MANY_BUCKETS), parts // PARTS_A_BUCKET)
    dealt = stored_once(text.mapInPandas(tidy(_deal(hot, parts)), ROWS).groupBy("part").applyInPandas(tidy(_gather(hot, buckets)), ROWS), "dealt")
    cells, first = dealt.filter("kind = 'cells'"), dealt.filter("kind = 'state'")
    lean = cells.withColumn("uses", F.lit(None).cast("binary"))
    plan = make_plan(_totals(dealt), hot)
    indexed = stored_once(dealt.filter("kind = 'sent'").groupBy("bucket").applyInPandas(tidy(_index), ROWS), "indexed")
    index, seated = indexed.filter("kind = 'index'"), indexed.filter("kind = 'seated'")
    seatings, met = [first], [_exchanged(dealt, index)]
    for _ in range(sweeps if plan.tokens else 0):
        rows = lean.unionAll(seatings[-1]).unionAll(met[-1])
        moved = stored_once(rows.groupBy("part").applyInPandas(tidy(_swept(plan, buckets)), ROWS), "moved")
        plan.states.append(next_state(moved, plan))
        seatings.append(moved.filter("kind = 'state'"))
        met.append(_exchanged(moved, index))
    taken = [k for k in range(len(plan.states)) if k > burn_in] or [len(plan.states) - 1]
    rows = cells
    for table in [seated, *[seatings[k] for k in taken], *[met[k] for k in taken]]:
        rows = rows.unionAll(table)
    sums = rows.groupBy("part").applyInPandas(tidy(_score(plan)), ROWS)
    out = sums.unionAll(dealt.filter("kind = 'docs'")).groupBy("bucket").applyInPandas(tidy(_add_documents), SCORES)
    return out.withColumn("train_tokens", F.lit(plan.tokens).cast("long"))


def perplexity(scored: DataFrame) -> DataFrame:
    """One row for held-out and one for other documents: perplexity of the model and of the base."""
    power = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(F.sum("n_tokens").alias("n_tokens"), power("score").alias("perplexity"), power("base_score").alias("base_perplexity"))
