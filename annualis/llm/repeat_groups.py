"""Maximal repeats of any length, with all their occurrences.

The stretches of ``repeats.py`` meet with the byte on either side of them. A suffix array of each task's spans tells
which spans occur twice, and whether the bytes before or behind their occurrences differ. Only where they do can a maximal
repeat begin or end, so the repeated parts of a text are cut there into units; a unit is the same wherever its first
span is. A maximal repeat is a row of whole units. Rows are extended by a unit a round, in Spark: a group of
occurrences with one unit before all of them is part of a longer repeat and goes, with all that extends it. After two rounds little is left;
groups that fit a task are finished there, by a stack scan of the suffix array of their units.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.llm.common import stored_once, tidy
from annualis.llm.repeats import (NO_ID, SIDE, SPAN, _answers, _block, _of, _words, beside, compared_blocks, distinct, maximal_repeats, ranges,
                                  read_stretches, span_hash, stretch_keys, suffix_array)
from annualis.session import attach

TWICE, LEFT, RIGHT = 1, 2, 4  # a span occurs twice; the bytes before its occurrences differ; those behind do
TASK_UNITS = 1 << 20  # units behind the occurrences of a group that a task takes
EARLY = 2  # rounds for groups of any size


def _flag_spans(frame: pd.DataFrame) -> pd.DataFrame:
    """The flags of one part's spans, for each block."""
    sizes, (number, skip, times, side, count, begin), data = read_stretches(frame["data"])
    first, same = distinct(*stretch_keys(_words(data), begin, count, side))
    begin, own, side, times = begin[first], count[first], side[first], np.bincount(same, times)
    starts, offset, owner = ranges(begin, own), ranges(np.zeros(len(own)), own), np.repeat(np.arange(len(own)), own)
    order, prefix = suffix_array(data, starts, (begin + own + SPAN - 1)[owner] - starts)
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(prefix == 0) - 1
    n = np.bincount(kind, times[owner])
    flags = np.where(n > 1, TWICE, 0)
    for flag, byte in zip((LEFT, RIGHT), beside(data, starts, offset, own[owner], side[owner])):
        low, high = np.full(len(n), 1 << SIDE), np.full(len(n), -1)
        np.minimum.at(low, kind, byte)
        np.maximum.at(high, kind, byte)
        flags[(n > 1) & ((low != high) | (low == 0))] |= flag
    return _answers(frame["block"], sizes, number, skip, same, own, flags[kind], lambda value, who: value > 0)


RUNS = "text binary, doc_id long, run long, names array<binary>, at array<long>, ends array<long>"


def _units(frame: pd.DataFrame) -> pd.DataFrame:
    """The units of a block's texts, a row for each run of adjacent ones: their names, and where their spans begin and end."""
    rows = []
    if _of(frame, "text"):
        block = _block(frame, sides=True)
        flags = np.zeros(len(block.data) + 1, np.int64)
        _, begin, size, value = block.placed(_of(frame, "found"))
        flags[ranges(begin, size)] = np.repeat(value, size)
        before = np.concatenate([[0], flags[:-1]])
        at = np.flatnonzero((flags & TWICE > 0) & ((before & TWICE == 0) | (before & RIGHT > 0) | (flags & LEFT > 0)))
        stops = np.flatnonzero(flags & TWICE == 0)
        ends = np.minimum(np.append(at[1:], len(flags)), stops[np.searchsorted(stops, at)]) if len(at) else at
        words = _words(block.data)
        names = np.stack([span_hash(words, at, turn) for turn in (0, 1)], axis=1).tobytes()
        text = np.searchsorted(block.ends, at, side="right")
        cuts = np.flatnonzero(before[at] & TWICE == 0)
        for a, b in zip(cuts, [*cuts[1:], len(at)]):
            k = text[a]
            start = block.ends[k] - block.sizes[k]
            rows.append((block.digests[k], None if block.ids[k] == NO_ID else int(block.ids[k]), int(at[a] - start),
                         [names[16 * j:16 * j + 16] for j in range(a, b)], (at[a:b] - start).tolist(), (ends[a:b] - start).tolist()))
    out = pd.DataFrame(rows, columns=["text", "doc_id", "run", "names", "at", "ends"])
    return out.astype({"doc_id": "Int64"})


GROUPS = "name binary, length long, doc_id long, text binary, at long"


def _finish(frame: pd.DataFrame) -> pd.DataFrame:
    """All maximal repeats that begin with what a group's occurrences have in common; ``names`` are the units behind it."""
    number: dict[bytes, int] = {}
    behind = [[number.setdefault(x, len(number)) for x in names] for names in frame["names"]]
    left = [-1 - k if x is None else number.setdefault(x, len(number)) for k, x in enumerate(frame["before"])]
    order = sorted(range(len(behind)), key=behind.__getitem__)
    common = [0]
    for a, b in zip(order, order[1:]):
        same, n = 0, min(len(behind[a]), len(behind[b]))
        while same < n and behind[a][same] == behind[b][same]:
            same += 1
        common.append(1 + same)
    own = frame.iloc[order].reset_index(drop=True)
    out = []
    for first, last, units in maximal_repeats(np.array(common), np.array(left)[order]).tolist():
        name = own["name"][first]
        for x in own["names"][first][:units - 1]:
            name = hashlib.md5(name + x).digest()
        end = own["end"][first] if units == 1 else own["ends"][first][units - 2]
        part = own.iloc[first:last + 1]
        out.append(pd.DataFrame({"name": [name] * len(part), "length": int(end - own["at"][first]) + SPAN - 1,
                                 "doc_id": part["doc_id"].astype("Int64"), "text": part["text"], "at": part["at"]}))
    return pd.concat(out) if out else pd.DataFrame(columns=["name", "length", "doc_id", "text", "at"])


def _differ(column: str):
    """Whether occurrences have different units there; where there is none, nothing else is like it."""
    return (F.count(column) < F.count(F.lit(1))) | (F.min(column) != F.max(column))


def repeat_groups(docs: DataFrame) -> DataFrame:
    """name, length, doc_id, text and at of every occurrence of every maximal repeat of ``SPAN`` bytes or more.

    A string is a maximal repeat if it occurs twice, and its occurrences differ in the byte before and in the byte behind (the ends
    of a text differ from all). ``name`` tells the repeats apart, ``length`` and ``at`` are UTF-8 bytes. Equal texts are one here, with their
    smallest doc_id, and ``text`` is their MD5 digest, by which all documents with them can be joined. Null and
    short texts and empty tables have no repeats; a null doc_id is kept only for texts that have no other.
    """
    runs = compared_blocks(docs, _flag_spans, sides=True).groupBy("block").applyInPandas(tidy(_units), RUNS)
    runs = stored_once(runs, "units")
    held = runs.select("text", "run", "names", "ends")
    place = F.col("place")
    found = runs.select("*", F.posexplode("names").alias("place", "name")).select(
        "text", "doc_id", "run", "place", "name", F.get("at", place).alias("at"), F.get("ends", place).alias("end"),
        F.get("names", place - 1).alias("before"), F.get("names", place + 1).alias("after"), (F.size("names") - place).alias("rest"))
    out, units = [], 1  # how many units all occurrences have in common by now
    while True:
        found = stored_once(found, "occurrences")
        fits = (F.sum("rest") <= TASK_UNITS) & F.lit(units > EARLY)
        facts = found.groupBy("name").agg(F.count(F.lit(1)).alias("n"), _differ("before").alias("left"), _differ("after").alias("right"), fits.alias("fits"))
        own = stored_once(attach(found, facts.filter("n > 1 and left").select("name", "right", "fits"), ["name"], "groups"), "kept")
        behind = lambda c: F.slice(c, F.col("place") + units + 1, F.greatest(F.lit(0), F.size(c) - F.col("place") - units)).alias(c)  # noqa: B023, E731
        small = own.filter("fits").join(held, ["text", "run"]).select("name", "doc_id", "text", "at", "end", "before", behind("names"), behind("ends"))
        large = own.filter("not fits")
        done = large.filter("right").select("name", (F.col("end") - F.col("at") + SPAN - 1).alias("length"), "doc_id", "text", "at")
        out.append(stored_once(done.unionAll(small.groupBy("name").applyInPandas(tidy(_finish), GROUPS)) if units > EARLY else done, "repeats"))
        longer = large.filter("after is not null")
        if longer.isEmpty():
            break
        found = longer.join(held, ["text", "run"]).select(
            "text", "doc_id", "run", "place", F.unhex(F.md5(F.concat("name", "after"))).alias("name"), "at",
            F.get("ends", place + units).alias("end"), "before", F.get("names", place + units + 1).alias("after"), (F.col("rest") - 1).alias("rest"))
        units += 1
    all_found = out[0]
    for table in out[1:]:
        all_found = all_found.unionAll(table)
    return all_found
