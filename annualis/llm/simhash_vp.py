"""Near-duplicates by SimHash, with exact search in a vantage-point structure.

Fingerprints are put into lists around vantage points by Hamming distance: the first point, in a
fixed order, within ``radius`` takes a fingerprint, and what no point takes goes to a last list. This is
the vantage-point tree whose inner branches are small balls: where nearly all distances are close
to half the bits, a branch at the median distance overlaps most queries, a small ball few. Triangle bounds
say which lists a fingerprint's neighbours can be in, so it is sent to these lists alone and no pair is lost.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.llm.common import connected_components, merge_labels, spread_work, utf8, without
from annualis.session import stored, stored_with

WORDS = 4
SEED = 42
MOST_APART = 4
SAMPLE = 8_192  # fingerprints that vantage points and the radius are chosen from
MOST_POINTS = 2_048
BALL_SHARE = 0.003  # share of all distances that the radius should hold
MEMBERS, ASKING = 16_384, 131_072  # fingerprints on either side of a comparing task
SHINGLES = 1 << 17  # shingles hashed at a time
CELLS = 1 << 22


def fingerprint(data: bytes) -> int:
    """SimHash of the four-word shingles of a text, repeats included; 0 without words."""
    words = data.lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - WORDS + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = (ends[WORDS - 1:] if len(words) >= WORDS else ends[-1:]).tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for k in range(0, n, SHINGLES):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[k:k + SHINGLES], ends[k:k + SHINGLES])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(frames):
    for frame in frames:
        prints = np.array([fingerprint(t) for t in utf8(frame["text"])], np.uint64).view(np.int64)
        yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "fp": prints})


def choose_points(sample: np.ndarray, n: int) -> tuple[np.ndarray, int]:
    """Vantage points and radius for ``n`` fingerprints, from a sample of them."""
    points = sample[: max(1, min(MOST_POINTS, int(4 * np.sqrt(n)), len(sample)))]
    others = sample[-512:]
    apart = np.bitwise_count(points[:, None] ^ others[None, :])
    seen = np.bincount(apart[apart > 2 * MOST_APART].ravel(), minlength=65)
    share = np.cumsum(seen) / max(1, seen.sum())
    return points, max(2 * MOST_APART, int(np.searchsorted(share, BALL_SHARE)))


def home_and_probes(prints: np.ndarray, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The list of each fingerprint, and a mask of the lists its neighbours can be in.

    A neighbour y of x has d(x, point) <= radius + MOST_APART at y's own list. If d(x, point) <= radius -
    MOST_APART, y is in that list or an earlier one. Lists before x's own are left to the other side.
    """
    apart = np.bitwise_count(prints[:, None] ^ points[None, :])
    last = len(points)
    inside = apart <= radius
    home = np.where(inside.any(axis=1), inside.argmax(axis=1), last)
    sure = apart <= radius - MOST_APART
    stop = np.where(sure.any(axis=1), sure.argmax(axis=1), last)
    order = np.arange(last + 1)
    near = np.concatenate([apart <= radius + MOST_APART, np.ones((len(prints), 1), bool)], axis=1)
    return home, near & (order >= home[:, None]) & (order <= stop[:, None])


def _router(points: np.ndarray, radius: int):
    def run(frames):
        for frame in frames:
            prints = frame["fp"].to_numpy(np.int64).view(np.uint64)
            for k in range(0, len(prints), 2_048):
                part = prints[k:k + 2_048]
                home, probes = home_and_probes(part, points, radius)
                row, to = np.nonzero(probes)
                by = np.argsort(to, kind="stable")
                row, to = row[by], to[by]
                cuts = np.flatnonzero(np.diff(to, prepend=-1))
                out = []
                for a, b in zip(cuts, [*cuts[1:], len(to)]):
                    rows = row[a:b]
                    own = part[rows[home[rows] == to[a]]]
                    out.append((int(to[a]), int(part[0] & np.uint64(0x7FFFFFFF)), len(own), b - a, own.tobytes(), part[rows].tobytes()))
                yield pd.DataFrame(out, columns=["list", "batch", "members", "asking", "own", "ask"])

    return run


def close_pairs(members: np.ndarray, asking: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A forest that joins what chains of close pairs (one of ``asking``, one of ``members``) join."""
    nodes, where = np.unique(np.concatenate([members, asking]), return_inverse=True)
    inner, outer = where[: len(members)], where[len(members):]
    label = np.arange(len(nodes))
    step = max(1, CELLS // max(1, len(members)))
    for k in range(0, len(asking), step):
        near = np.bitwise_count(asking[k:k + step, None] ^ members[None, :]) <= MOST_APART
        i, j = np.nonzero(near)
        left, right = outer[k + i], inner[j]
        apart = left != right
        label = merge_labels(label, left[apart], right[apart])
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _compare(frame: pd.DataFrame) -> pd.DataFrame:
    members = np.frombuffer(b"".join(x for x in frame["own"] if x), np.uint64)
    asking = np.frombuffer(b"".join(x for x in frame["ask"] if x), np.uint64)
    a, b = close_pairs(members, asking)
    return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})


def link_fingerprints(distinct: DataFrame, n: int) -> DataFrame:
    """Edges (a, b) between fingerprints, a forest of each comparing task, of ``distinct`` (fp), ``n`` rows."""
    sample = [r["fp"] for r in distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
    points, radius = choose_points(np.array(sample, np.int64).view(np.uint64), n)
    routed = stored(distinct.select("fp").mapInPandas(
        _router(points, radius), "list int, batch long, members long, asking long, own binary, ask binary"), "routed")
    work = spread_work(routed, MEMBERS, ASKING)
    return work.groupBy("list", "block", "turn").applyInPandas(_compare, "a long, b long")


def simhash_components(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a long) and component_id for every document.

    Documents are linked when their fingerprints differ in at most ``MOST_APART`` bits; equal fingerprints
    are one node, so copies are never compared with each other. component_id is the smallest doc_id that
    links reach. Null texts count as empty; texts without words have fingerprint 0. Null ids are ignored
    for the smallest one unless a component has no other (then component_id is null). Every row gives a row.
    """
    prints = stored(docs.select("doc_id", "text").mapInPandas(_fingerprints, "doc_id long, fp long"), "fingerprints")
    first, seen = stored_with(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct", n=F.count(F.lit(1)))
    if not seen["n"]:
        return prints.withColumn("component_id", F.col("doc_id"))
    joined = connected_components(link_fingerprints(first, int(seen["n"])))
    rooted = first.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = stored(rooted.join(lowest, "root").select("fp", "component_id"), "components")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp):
    """Sixteen lower-case hex digits of a long column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def document_simhash(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    return simhash_components(docs).select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest doc_id, with its columns.

    Of repeated rows with that doc_id one stays; rows without a doc_id stay, as nothing names them.
    """
    found = stored(simhash_components(docs).select("doc_id", "component_id"), "components")
    kept = without(docs, "doc_id", found.filter("doc_id <> component_id").select("doc_id").distinct())
    again = stored(found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    if again.isEmpty():
        return kept
    once = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(kept.columns)
    return without(kept, "doc_id", again).unionAll(once)
