import numpy as np
import pytest

from annualis.llm import toxicity

LEXICON = toxicity.Lexicon({"idiot": 5.0, "fool": 3.0}, {"vex": 4.0})


def kinds(text):
    return [toxicity.KINDS[k] for k, _ in toxicity.clauses(text, LEXICON)]


@pytest.mark.parametrize("text, want", [
    ("you are an idiot.", ["aimed_insult"]),
    ("an idiot, that one", ["insult"]),
    ("you are not an idiot.", ["denied"]),
    ("she said you are an idiot", ["reported"]),
    ("he wrote: nothing. you fool", ["aimed_insult"]),
    ("I will kill you!", ["aimed_threat"]),
    ("they kill time", ["aimed_threat"]),
    ("never kill", ["denied"]),
    ("vexatious words; more words", ["insult"]),
    ("idiot. idiot\nfool", ["insult", "insult", "insult"]),
    ("a quiet day", []),
    ("", []),
])
def test_clauses(text, want):
    assert kinds(text) == want


def test_a_denial_after_the_insult_does_not_undo_it():
    assert kinds("an idiot and not you") == ["aimed_insult"]


def test_product_reads_like_its_parts():
    for state, symbol in toxicity.MOVES:
        to = toxicity.MOVES[state, symbol]
        for s, t, machine in zip(state, to, (toxicity.INSULT, toxicity.THREAT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT)):
            assert t == machine[1].get((s, symbol), s)


def test_fit_separates():
    rng = np.random.default_rng(0)
    x = np.zeros((400, len(toxicity.MEANS)))
    x[:, 0] = 1
    x[:200, 3] = rng.uniform(1, 2, 200)
    y = np.r_[np.ones(200), np.zeros(200)]
    assert (((x @ toxicity.fit_weights(x, y)) > 0) == y).all()


def test_likelihood_ratio_by_definition():
    a, b, n, m = 9, 4, 20, 50
    table = np.array([[a, n - a], [b, m - b]], float)
    even = table.sum(axis=1, keepdims=True) * table.sum(axis=0) / table.sum()
    assert abs(toxicity.likelihood_ratio([a], [b], n, m)[0] - 2 * (table * np.log(table / even)).sum()) < 1e-9
    assert toxicity.likelihood_ratio([1], [30], 20, 50)[0] == 0


def planted(docs):
    """A third of the ids is toxic by a word beginning that no one lists; half of the rows are labelled."""
    from pyspark.sql import functions as F

    rows = docs.sparkSession.range(900).withColumnRenamed("id", "doc_id")
    toxic = F.col("doc_id") % 3 == 0
    bad = F.concat_ws(" ", *[F.concat(F.lit("qro"), F.col("doc_id") % (7 + k), F.lit(" w"), F.col("doc_id") % (11 + 2 * k)) for k in range(6)])
    clean = F.concat_ws(" ", *[F.concat(F.lit("w"), F.xxhash64("doc_id", F.lit(k)) % 50) for k in range(60)])
    texts = rows.withColumn("text", F.when(toxic, F.concat(bad, F.lit(" "), clean)).otherwise(clean)).withColumn("label", toxic.cast("int"))
    labels = texts.filter("doc_id % 2 = 0").select("doc_id", F.lit(1).alias("quality"), F.col("label").alias("toxic"))
    return texts, labels


def test_learns_unlisted_terms(docs, frame):
    texts, labels = planted(docs)
    out = frame(toxicity.document_toxicity(texts, labels)).merge(frame(texts.select("doc_id", "label")), on="doc_id")
    assert (out["predicted"].astype(int) == out["label"].astype(int)).mean() > 0.99
    assert out["score"].astype(float).between(0, 1).all()
    kept = frame(toxicity.keep_clean(texts, labels))
    assert set(kept.columns) == set(texts.columns) and len(kept) == (out["predicted"] == 0).sum()


def test_held_out_labels_are_not_read(docs, frame):
    from pyspark.sql import functions as F

    texts, labels = planted(docs)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out_fold(F.col("doc_id"), 0), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, other = (frame(toxicity.document_toxicity(texts, x)).sort_values("doc_id")["score"].tolist() for x in (labels, turned))
    assert one == other


def test_edges(docs, no_docs, rows_of_docs, spark, frame):
    none = spark.createDataFrame([(4, None, None), (None, 1, 1), (1, 1, 7)], "doc_id long, quality int, toxic int")
    out = frame(toxicity.document_toxicity(docs, none))
    assert len(out) == len(rows_of_docs) and (out["predicted"] == 0).all()
    assert toxicity.keep_clean(docs, none).columns == docs.columns
    assert frame(toxicity.document_toxicity(no_docs, none)).empty


def test_accuracy_on_the_given_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = toxicity.document_toxicity(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").toPandas()
    held = out[out["held_out"]]
    assert (held["predicted"] == held["toxic"]).mean() > 0.93
    assert held[held["toxic"] == 0]["predicted"].mean() < 0.03
