from pyspark.sql import functions as F

import corpus_pipeline
from linfold.llm import common
from linfold.llm.queries import QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    found = entry.queries()
    assert "pipeline" in found and QUERIES.items() <= found.items()
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_stages_hand_on_documents(spark):
    docs = common.table(spark, SF, "documents")
    names, seen = docs.columns, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = common.saved(stage(spark, docs, SF), name)
        seen.append(out.count())
        if i < 4:
            assert out.columns == names
        docs = out
    assert seen[0] <= 200 and seen[1] <= seen[0] and seen[2] < seen[1] and seen[3] <= seen[2]
    # The repeated bytes are those that brute force finds, the near-duplicates too.
    stages = dict(corpus_pipeline.STAGES)
    base = common.table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in base.collect()]
    prints = [brute.simhash(t) for _, t in rows]
    root = brute.classes(prints)
    least = {r: min(i for (i, _), q in zip(rows, root) if q == r) for r in set(root)}
    kept = {r.doc_id for r in stages["simhash_near_dedup"](spark, base, SF).select("doc_id").collect()}
    assert kept == set(least.values())
    left = {r.doc_id: r.text for r in stages["suffix_array_dedup"](spark, base, SF).collect()}
    assert left == brute.suffix_texts(rows)


def through(spark, docs):
    """The rows that each stage hands on, the last stage's too."""
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = common.saved(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def test_stages_of_empty_and_null_tables(spark):
    schema = common.table(spark, SF, "documents").schema
    names = schema.names
    empty = through(spark, spark.createDataFrame([], schema))
    assert [df.count() for df in empty] == [0] * 5
    assert all(df.columns == names for df in empty[:4])
    # Rows of nothing: no words, so the base rules turn all of them away, if the classifier has not.
    nulls = spark.createDataFrame([tuple(None for _ in names)] * 3, schema)
    kept = [df.count() for df in through(spark, nulls)]
    assert kept[0] in (0, 3) and kept[1:] == [0] * 4
    # Each stage alone: three equal rows are one class, an empty text holds no repeat and is one end id.
    stages = dict(corpus_pipeline.STAGES)
    assert stages["simhash_near_dedup"](spark, nulls, SF).count() == 1
    assert stages["suffix_array_dedup"](spark, nulls, SF).count() == 3
    pieces = stages["best_fit_packing"](spark, nulls, SF).collect()
    assert [(p.doc_id, p.piece, p.length) for p in pieces] == [(None, 0, 1)] * 3
    assert sorted(p.offset for p in pieces) == [0, 1, 2]


def test_stages_of_repeats_and_a_long_text(spark):
    """Rows twice and thrice, a text of 1.5 MB, columns of clashing names."""
    base = common.table(spark, SF, "documents").withColumn("n_chars", F.col("n_chars").cast("long"))
    good = [r.text for r in through(spark, base)[2].select("text").collect()]
    long = "\n".join(f"{t} {i}" for i, t in enumerate(good * 40))[:1_500_000]
    one = base.limit(1).withColumn("doc_id", F.lit(10**6).cast(base.schema["doc_id"].dataType)).withColumn("text", F.lit(long))
    docs = base.union(base).union(base.where("doc_id % 2 = 0")).union(one)
    for extra in ("k", "_k", "at", "label", "score", "found", "marks"):
        docs = docs.withColumn(extra, F.lit(extra))
    docs = common.saved(docs, "repeats")
    steps = through(spark, docs)
    assert all(df.columns == docs.columns and df.where("marks <> 'marks' OR label <> 'label'").count() == 0 for df in steps[:4])
    plain = through(spark, base)
    for got, want in zip(steps[2:4], plain[2:4], strict=True):   # of repeated rows one stays
        ids = [r.doc_id for r in got.select("doc_id").where("doc_id < 1000000").collect()]
        assert len(ids) == len(set(ids)) and set(ids) == {r.doc_id for r in want.select("doc_id").collect()}
    # Each stage is held against brute force on its own input.
    rows = [(r.doc_id, r.text) for r in steps[2].collect()]
    assert {r.doc_id: r.text for r in steps[3].collect()} == brute.suffix_texts(rows)
    placed = steps[4].collect()
    assert {p.doc_id for p in placed} == {r.doc_id for r in steps[3].select("doc_id").collect()}
    room = {}
    for p in sorted(placed, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == room.get(p.sequence_id, 0) and p.offset + p.length <= 2048
        room[p.sequence_id] = p.offset + p.length
