import random

import pytest

from annualis.llm import repeat_groups, repeats


def by_definition(texts):
    """{string: its places} of all maximal repeats of 50 bytes or more of distinct texts, a list of (id, bytes)."""
    uses = {}
    for i, t in texts:
        for k in range(len(t) - 49):
            uses.setdefault(t[k:k + 50], []).append((i, k))
    of, out = dict(texts), {}
    uses = {w: at for w, at in uses.items() if len(at) > 1}
    while uses:
        longer = {}
        for w, at in uses.items():
            left = {of[i][k - 1] if k else (i, k) for i, k in at}
            right = {of[i][k + len(w)] if k + len(w) < len(of[i]) else (i, k) for i, k in at}
            if len(left) > 1 and len(right) > 1:
                out[w] = sorted(at)
            for i, k in at:
                if k + len(w) < len(of[i]):
                    longer.setdefault(of[i][k:k + len(w) + 1], []).append((i, k))
        uses = {w: at for w, at in longer.items() if len(at) > 1}
    return out


def collected(df, texts):
    of, groups = dict(texts), {}
    for r in df.collect():
        groups.setdefault((bytes(r["name"]), of[r["doc_id"]][r["at"]:r["at"] + r["length"]]), []).append((r["doc_id"], r["at"]))
    assert len({name for name, _ in groups}) == len(groups) == len({w for _, w in groups})
    return {w: sorted(at) for (_, w), at in groups.items()}


def make_texts():
    """Texts of shared passages within passages, with copies that differ at an end, repeats within a text and a long row of one letter."""
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    lines = [word(60) for _ in range(4)]
    nested = lines[0] + lines[1] + word(30) + lines[2]
    texts = [word(rng.randint(0, 90)) + rng.choice([*lines, nested, ""]) + rng.choice([*lines, nested, word(9)]) + word(rng.randint(0, 40)) for _ in range(30)]
    chain = "".join(rng.choice(lines) + word(3) for _ in range(9))
    texts += [chain, chain + "x", "y" + chain, chain[:400] + "z" + chain[400:], "a" * 120, "b" + "a" * 90, nested + nested, lines[3], "short", ""]
    return [(k * 2 + 5, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("hot, blocks, task, early", [(1 << 14, 4 << 20, 1 << 20, 2), (1, 900, 1 << 20, 1), (1 << 14, 2_000, 0, 2)])
def test_maximal_repeats_with_all_occurrences(spark, monkeypatch, hot, blocks, task, early):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", blocks)
    monkeypatch.setattr(repeat_groups, "TASK_UNITS", task)
    monkeypatch.setattr(repeat_groups, "EARLY", early)
    rows = make_texts()
    texts = [(i, t.encode()) for i, t in rows]
    assert len({t for _, t in rows}) == len(rows)
    docs = spark.createDataFrame([*rows, (900, rows[3][1]), (901, None)], "doc_id long, text string")
    want = by_definition(texts)
    assert collected(repeat_groups.repeat_groups(docs), texts) == want and max(map(len, want)) > 400


def test_no_repeats(no_docs, spark):
    assert repeat_groups.repeat_groups(no_docs).isEmpty()
    assert repeat_groups.repeat_groups(spark.createDataFrame([(1, "x" * 49), (None, None)], "doc_id long, text string")).isEmpty()
