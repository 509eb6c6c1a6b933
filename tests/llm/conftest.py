import random

import pandas as pd
import pytest

WORDS = "alder birch cedar dogwood elm fir ginkgo hazel iris juniper kelp larch maple nettle oak pine quince rowan spruce teak".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 400)) for _ in range(n))


def make_rows():
    """Texts with copies, near copies, shared passages, nulls, empty and very long texts, repeated rows and null ids."""
    rng = random.Random(5)
    texts = [sentence(rng, rng.randint(1, 160)) for _ in range(60)]
    passage = sentence(rng, 30)
    long = sentence(rng, 6_000)
    near = long.split()
    near[100] = "changed"
    texts += [texts[3], texts[3], texts[7] + " more", passage + " " + texts[9], texts[11] + "\n" + passage, long, " ".join(near),
              "", "  \n\t ", None, None, "Üñïcode ß 漢字 🙂 " * 12, "Üñïcode ß 漢字 🙂 " * 12 + "x", "a", "ab" * 400, "ab" * 390 + "c", " ".join(["word"] * 500)]
    rows = [(k * 3 + 1, t) for k, t in enumerate(texts)]
    rows += [(4, texts[1]), (4, texts[1]), (None, texts[5]), (None, passage), (-9, texts[20]), (10**15, "UPPER lower " * 9)]
    rng.shuffle(rows)
    return rows


CLASHING = ("digest", "first", "fp", "part", "row", "word", "gone", "component_id", "shard", "slot", "block", "kept", "label", "entry")


@pytest.fixture(scope="session")
def rows_of_docs():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory, rows_of_docs):
    """The rows as a stored table of several files, with columns named like the operators' own."""
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    kinds = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    data = [(i, t, "en", None, None if t is None else len(t), *CLASHING) for i, t in rows_of_docs]
    spark.createDataFrame(data, kinds).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.filter("false")


@pytest.fixture
def frame():
    """Collect a frame as pandas with plain Python values."""
    def collect(df):
        return pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns, dtype=object)

    return collect
